"""KPI layer: KPI-1 .. KPI-10 and MET-2 over the gold star schema.

Join strategy (the part that decides cost at scale): facts are never joined
to a dimension row by row.  Every KPI first aggregates its fact to the
dimension key (map-side partial aggregation absorbs hot keys before the
shuffle), so the join sees one row per key on both sides: it cannot skew and
it moves almost nothing.  No dimension is broadcast on assumption; AQE turns
the join into a broadcast at run time when the *measured* size allows.  The
result is then re-aggregated to the reported labels (a tiny shuffle).

All measures are sums and every dimension is unique on its key, so
aggregating below the join is exact.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions import metrics as m

KPI_NAMES = (
    "kpi_1_summary",
    "kpi_2_cpl_ranking",
    "kpi_3_top_keywords",
    "kpi_4_age_performance",
    "kpi_5_gender_performance",
    "kpi_6_monthly_trend",
    "kpi_7_adgroup_efficiency",
    "kpi_8_network_performance",
    "kpi_9_day_of_week",
    "kpi_10_ad_type_dist",
)

# The KPI titles of the report pack, in the reference's order.
KPI_TITLES = {
    "kpi_1_summary": "KPI 1: High-Level Performance Summary",
    "kpi_2_cpl_ranking": "KPI 2: Campaign Performance Ranking by CPL",
    "kpi_3_top_keywords": "KPI 3: Top 10 Keywords by Clicks",
    "kpi_4_age_performance": "KPI 4: Performance Breakdown by Age Group",
    "kpi_5_gender_performance": "KPI 5: Performance Breakdown by Gender",
    "kpi_6_monthly_trend": "KPI 6: Monthly Performance Trend",
    "kpi_7_adgroup_efficiency": "KPI 7: Ad Group Efficiency",
    "kpi_8_network_performance": "KPI 8: Performance by Ad Network",
    "kpi_9_day_of_week": "KPI 9: Performance by Day of the Week",
    "kpi_10_ad_type_dist": "KPI 10: Ad Type Distribution by Campaign",
}

# gold tables each KPI reads
KPI_INPUTS = {
    "kpi_1_summary": ("fact_campaign_perf", "dim_campaign"),
    "kpi_2_cpl_ranking": ("fact_campaign_perf", "dim_campaign"),
    "kpi_3_top_keywords": ("fact_keyword_perf", "dim_keyword"),
    "kpi_4_age_performance": ("fact_age_perf", "dim_age_range"),
    "kpi_5_gender_performance": ("fact_gender_perf", "dim_gender"),
    "kpi_6_monthly_trend": ("fact_campaign_perf", "dim_date"),
    "kpi_7_adgroup_efficiency": ("fact_keyword_perf", "dim_ad_group", "dim_campaign"),
    "kpi_8_network_performance": ("fact_campaign_network_perf", "dim_network"),
    "kpi_9_day_of_week": ("fact_campaign_perf", "dim_date"),
    "kpi_10_ad_type_dist": ("dim_ad", "dim_ad_group", "dim_campaign"),
}

TOP_KEYWORDS_K = 25  # the reference titles KPI 3 "Top 10" but keeps 25 rows


COST_DEC = "sum(CAST(cost_inr AS DECIMAL(20,6)))"  # exact, re-summable across levels
COST = "CAST(cost AS DOUBLE)"
MONEY = "CAST(round(cost, 2) AS DOUBLE)"


def _agg(df: DataFrame, keys: list[str], *exprs: str) -> DataFrame:
    """groupBy(keys).agg over SQL aggregate expressions (``"sum(x) AS y"``)."""
    return df.groupBy(*keys).agg(*[F.expr(e) for e in exprs])


def _sums(with_cost: bool = True, with_conv: bool = True) -> list[str]:
    """Fact-row sums: impressions i, clicks c, conversions v, exact cost."""
    out = ["sum(impressions) AS i", "sum(clicks) AS c"]
    if with_conv:
        out.append("sum(conversions) AS v")
    if with_cost:
        out.append(f"{COST_DEC} AS cost")
    return out


# ---------------------------------------------------------------- KPI 1, 2


def campaign_totals(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Sums per (campaign_name, campaign_status): fact -> per campaign_pk -> dim -> per label."""
    per_pk = _agg(gold["fact_campaign_perf"], ["campaign_pk"], *_sums())
    dim = gold["dim_campaign"].select("campaign_pk", "campaign_name", "campaign_status")
    return _agg(per_pk.join(dim, "campaign_pk"), ["campaign_name", "campaign_status"],
                "sum(i) AS i", "sum(c) AS c", "sum(v) AS v", "sum(cost) AS cost")


def kpi_1_summary(gold: Mapping[str, DataFrame]) -> DataFrame:
    return campaign_totals(gold).selectExpr(
        "campaign_name",
        "campaign_status",
        f"{MONEY} AS total_cost_inr",
        "i AS total_impressions",
        "c AS total_clicks",
        "v AS total_leads",
        f"{m.cpc_sql(COST, 'c')} AS average_cpc",
        f"{m.cpa_sql(COST, 'v')} AS average_cpl",
        f"{m.ctr_sql('c', 'i')} AS overall_ctr_pct",
        f"{m.cvr_sql('v', 'c')} AS overall_lead_rate_pct",
    ).orderBy(F.desc("total_cost_inr"), "campaign_name", "campaign_status")


def kpi_2_cpl_ranking(gold: Mapping[str, DataFrame], min_leads: float = 0) -> DataFrame:
    t = campaign_totals(gold).filter(F.col("v") > min_leads)  # HAVING total_leads > 0
    return t.selectExpr(
        "campaign_name",
        "campaign_status",
        f"{MONEY} AS total_cost_inr",
        "c AS total_clicks",
        "v AS total_leads",
        f"{m.cvr_sql('v', 'c')} AS lead_rate_pct",
        f"{m.cpa_sql(COST, 'v')} AS campaign_cpl",
    ).orderBy(F.asc("campaign_cpl"), "campaign_name", "campaign_status")


# ---------------------------------------------------------------- KPI 3


def kpi_3_top_keywords(gold: Mapping[str, DataFrame], k: int = TOP_KEYWORDS_K) -> DataFrame:
    """Top-k keywords by clicks; rows without clicks are dropped before aggregation."""
    per_pk = _agg(gold["fact_keyword_perf"].filter(F.col("clicks") > 0), ["keyword_pk"],
                  *_sums(with_conv=False))
    t = _agg(per_pk.join(gold["dim_keyword"], "keyword_pk"), ["keyword_text", "keyword_match_type"],
             "sum(i) AS i", "sum(c) AS c", "sum(cost) AS cost")
    out = t.selectExpr(
        "keyword_text",
        "keyword_match_type",
        "i AS total_impressions",
        "c AS total_clicks",
        f"{m.ctr_sql('c', 'i')} AS ctr_percentage",
        f"{m.cpc_sql(COST, 'c')} AS cost_per_click",
    )
    # top-k with a key tie-break: a per-partition top-k then one merge of k rows
    return out.orderBy(F.desc("total_clicks"), "keyword_text", "keyword_match_type").limit(k)


# ---------------------------------------------------------------- KPI 4, 5, 8


def _by_label(fact: DataFrame, dim: DataFrame, key: str, *labels: str, with_cost: bool = True) -> DataFrame:
    """Fact sums per dimension key (the only pass over the fact rows), joined to the
    dimension (one row per key on both sides), then re-summed per label."""
    per_key = _agg(fact, [key], *_sums(with_cost=with_cost))
    sums = ["sum(i) AS i", "sum(c) AS c", "sum(v) AS v"] + (["sum(cost) AS cost"] if with_cost else [])
    return _agg(per_key.join(dim.select(key, *labels), key), list(labels), *sums)


def _audience_kpi(fact: DataFrame, dim: DataFrame, pk: str, label: str) -> DataFrame:
    return _by_label(fact, dim, pk, label).selectExpr(
        label,
        "i AS total_impressions",
        "c AS total_clicks",
        "v AS total_leads",
        f"{MONEY} AS total_cost_inr",
        f"{m.ctr_sql('c', 'i')} AS ctr_pct",
        f"{m.cpc_sql(COST, 'c')} AS cpc_inr",
        f"{m.cpa_sql(COST, 'v')} AS cpl_inr",
    ).orderBy(F.desc("total_leads"), label)


def kpi_4_age_performance(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _audience_kpi(gold["fact_age_perf"], gold["dim_age_range"], "age_range_pk", "age_range")


def kpi_5_gender_performance(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _audience_kpi(gold["fact_gender_perf"], gold["dim_gender"], "gender_pk", "gender")


def kpi_8_network_performance(gold: Mapping[str, DataFrame]) -> DataFrame:
    t = _by_label(gold["fact_campaign_network_perf"], gold["dim_network"], "network_pk", "network_name",
                  with_cost=False)
    return t.selectExpr(
        "network_name",
        "i AS total_impressions",
        "c AS total_clicks",
        "v AS total_leads",
        f"{m.ctr_sql('c', 'i')} AS ctr_pct",
        f"{m.cvr_sql('v', 'c')} AS cvr_pct",
    ).orderBy(F.desc("total_leads"), "network_name")


# ---------------------------------------------------------------- KPI 6, 9 (date dim)


def _by_date(gold: Mapping[str, DataFrame], *labels: str) -> DataFrame:
    return _by_label(gold["fact_campaign_perf"], gold["dim_date"], "date_key", *labels)


def kpi_6_monthly_trend(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _by_date(gold, "year", "month").selectExpr(
        "year",
        "month",
        f"{MONEY} AS monthly_cost_inr",
        "v AS monthly_leads",
        f"{m.cpa_sql(COST, 'v')} AS monthly_cpl_inr",
    ).orderBy("year", "month")


def kpi_9_day_of_week(gold: Mapping[str, DataFrame]) -> DataFrame:
    return _by_date(gold, "day_of_week").selectExpr(
        f"{m.weekday_name_sql('day_of_week')} AS day_name",
        "day_of_week",
        "i AS total_impressions",
        "c AS total_clicks",
        f"{MONEY} AS total_cost_inr",
        "v AS total_leads",
        f"{m.cpa_sql(COST, 'v')} AS cpl_inr",
    ).orderBy("day_of_week")


# ---------------------------------------------------------------- KPI 7, 10 (growing dims)


def kpi_7_adgroup_efficiency(gold: Mapping[str, DataFrame]) -> DataFrame:
    per_pk = _agg(gold["fact_keyword_perf"], ["ad_group_pk", "campaign_pk"], *_sums(with_conv=False))
    ag = gold["dim_ad_group"].select("ad_group_pk", "ad_group_name")
    camp = gold["dim_campaign"].select("campaign_pk", "campaign_name")
    t = _agg(per_pk.join(ag, "ad_group_pk").join(camp, "campaign_pk"), ["ad_group_name", "campaign_name"],
             "sum(i) AS i", "sum(c) AS c", "sum(cost) AS cost")
    return t.selectExpr(
        "ad_group_name",
        "campaign_name",
        "i AS total_impressions",
        "c AS total_clicks",
        f"{MONEY} AS total_cost_inr",
        f"{m.ctr_sql('c', 'i')} AS ctr_pct",
        f"{m.cpc_sql(COST, 'c')} AS avg_cpc_inr",
    ).orderBy(F.desc("ctr_pct"), "ad_group_name", "campaign_name")


def kpi_10_ad_type_dist(gold: Mapping[str, DataFrame]) -> DataFrame:
    """Ads per (campaign, ad type): ad -> ad group by natural key -> campaign by surrogate key."""
    per_group = _agg(gold["dim_ad"], ["ad_group_id", "ad_type"], "count(ad_pk) AS n")
    ag = gold["dim_ad_group"].select("ad_group_id", "campaign_pk")
    camp = gold["dim_campaign"].select("campaign_pk", "campaign_name")
    t = _agg(per_group.join(ag, "ad_group_id").join(camp, "campaign_pk"), ["campaign_name", "ad_type"],
             "sum(n) AS number_of_ads")
    return t.orderBy("campaign_name", F.desc("number_of_ads"), "ad_type")


# ---------------------------------------------------------------- MET-2


def metric_roas(silver: Mapping[str, DataFrame], gold: Mapping[str, DataFrame]) -> DataFrame:
    """MET-2: revenue / cost per campaign of either side (both pre-aggregated per campaign, then joined)."""
    key = "coalesce(campaign_id, 'Unknown') AS campaign_id"
    cost = silver["campaigns"].selectExpr(key, "cost_inr").groupBy("campaign_id").agg(F.expr(f"{COST_DEC} AS cost"))
    rev = silver["conversions"].selectExpr(key, "conversions_value").groupBy("campaign_id").agg(
        F.expr("sum(CAST(conversions_value AS DECIMAL(20,6))) AS revenue"))
    names = gold["dim_campaign"].select("campaign_id", "campaign_name")
    t = cost.join(rev, "campaign_id", "full").join(names, "campaign_id", "left").withColumn(
        "cost", F.expr("coalesce(cost, CAST(0 AS DECIMAL(30,6)))"))
    revenue = "coalesce(revenue, CAST(0 AS DECIMAL(30,6)))"
    return t.selectExpr(
        "campaign_id",
        "campaign_name",
        f"{MONEY} AS total_cost_inr",
        f"CAST(round({revenue}, 2) AS DOUBLE) AS total_conversions_value",
        f"{m.roas_sql(f'CAST({revenue} AS DOUBLE)', COST)} AS roas",
    ).orderBy(F.desc("roas"), "campaign_id")


KPI_BUILDERS = {
    "kpi_1_summary": kpi_1_summary,
    "kpi_2_cpl_ranking": kpi_2_cpl_ranking,
    "kpi_3_top_keywords": kpi_3_top_keywords,
    "kpi_4_age_performance": kpi_4_age_performance,
    "kpi_5_gender_performance": kpi_5_gender_performance,
    "kpi_6_monthly_trend": kpi_6_monthly_trend,
    "kpi_7_adgroup_efficiency": kpi_7_adgroup_efficiency,
    "kpi_8_network_performance": kpi_8_network_performance,
    "kpi_9_day_of_week": kpi_9_day_of_week,
    "kpi_10_ad_type_dist": kpi_10_ad_type_dist,
}


def kpi(name: str, gold: Mapping[str, DataFrame], **params) -> DataFrame:
    return KPI_BUILDERS[name](gold, **params)
