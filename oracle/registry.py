"""All check statements by query name."""


def all_statements() -> dict[str, str]:
    from oracle import dashboard, features, forecast, prep, proofs, sales, segments, tables_checks, trends

    out: dict[str, str] = {}
    for module in (tables_checks, sales, segments, trends, prep, features, forecast, dashboard, proofs):
        out.update(module.SQL)
    return out
