"""Customer segmentation queries over a store."""

from tillwise.operators import segments as seg

def base(s):
    return seg.rfm_base(s.baskets, s.customers, s.daily_sales)


def scaled(s):
    return seg.standardise(base(s), seg.MEASURES, "customer_id")


def effort(s):
    chosen = s.settings
    return {"seed": chosen.seed, "restarts": chosen.cluster_restarts, "iterations": chosen.cluster_iterations}


def labelled(s):
    return seg.cluster_labels(base(s), scaled(s), seg.MEASURES, "customer_id", k=4, **effort(s))


def crosstab(s):
    return seg.crosstab_share(labelled(s), "cluster", "customer_type", s.settings.customer_types)


def segment_crosstab(s):
    return seg.crosstab_share(seg.rfm_scored(base(s)), "rfm_segment", "customer_type", s.settings.customer_types)


PLANS = {
    "rfm_segments": lambda s: seg.rfm_segments(base(s)),
    "rfm_segment_summary": lambda s: seg.rfm_summary(base(s)),
    "rfm_temp_crosstab": lambda s: seg.temp_crosstab(
        s.transactions, s.daily_sales, "Cold snap (<15°C)", "Normal (>=15°C)"
    ),
    "rfm_event_crosstab": lambda s: seg.event_crosstab(s.transactions, s.daily_sales),
    "nb_rfm_base": base,
    "nb_describe": lambda s: seg.describe(base(s), seg.MEASURES, "customer_id"),
    "rfm_standardise": scaled,
    "kmeans_sweep": lambda s: seg.cluster_sweep(scaled(s), seg.MEASURES, **effort(s)),
    "kmeans_segments": lambda s: seg.cluster_means(labelled(s), seg.MEASURES),
    "sample_rows": lambda s: seg.sample_rows(s.transactions.drop("timestamp"), "transaction_id", 5000, s.settings.seed),
    "nb_cold_snap_segments": lambda s: seg.temp_crosstab(s.transactions, s.daily_sales, "Cold snap", "Normal"),
    "nb_event_segments": lambda s: seg.event_crosstab(s.transactions, s.daily_sales, events_only=False),
    "cluster_crosstab": crosstab,
    "crosstab_melt": lambda s: seg.melt(segment_crosstab(s), "rfm_segment", "customer_type"),
    "segment_crosstab": segment_crosstab,
}
