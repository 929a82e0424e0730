"""Every named query on the smallest tables, against its check statement where it has one."""

import pytest

from oracle.registry import all_statements
from tests.compare import difference, rows_of_duck, rows_of_spark
from tillwise.plans.present import present
from tillwise.plans.registry import all_plans

PLANS, CHECKS = all_plans(), all_statements()


def test_every_statement_has_a_query():
    assert not set(CHECKS) - set(PLANS)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_matches_statement(name, store, duck):
    got = rows_of_spark(present(PLANS[name](store)))
    assert difference(got, rows_of_duck(duck, CHECKS[name])) is None


@pytest.mark.parametrize("name", sorted(set(PLANS) - set(CHECKS)))
def test_model_queries_give_rows(name, store):
    assert present(PLANS[name](store)).count() > 0
