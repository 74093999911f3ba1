"""Gold layer: star schema (GD-1 .. GD-14) built from silver DataFrames.

Keys are ``md5`` surrogate keys computed per row (``functions.keys``), so facts
never look their keys up in a dimension: no join, no shuffle for key assignment.
Dimensions that pick one row per natural key use ``max_by`` over a total order
(deterministic and partially aggregated map-side, so a hot key cannot pile up
in one task).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.keys import UNKNOWN, date_key_sql, surrogate_key_sql
from adlake.operators.layer import LazyLayer

DIMS = ("dim_campaign", "dim_ad_group", "dim_ad", "dim_keyword", "dim_age_range", "dim_gender", "dim_network",
        "dim_date")
FACTS = ("fact_campaign_perf", "fact_keyword_perf", "fact_age_perf", "fact_gender_perf",
         "fact_campaign_network_perf")


def _nk_sql(c: str) -> str:
    """Natural key as stored in a dimension (null -> 'Unknown', like its surrogate key)."""
    return f"coalesce(CAST({c} AS STRING), '{UNKNOWN}')"


def _nk(c: str):
    return F.expr(_nk_sql(c))


SK, DK = surrogate_key_sql, date_key_sql
#: Month of a date key (yyyyMM), by which saved facts can be partitioned.
MONTH_KEY = "month_key"
MONEY_DEC = "DECIMAL(20,6)"  # exact sums of currency values (micros / 1e6)


def dim_campaign(campaigns: DataFrame, conversions: DataFrame | None = None) -> DataFrame:
    """GD-1: one row per campaign with its latest name, status and channel (by date).

    A campaign that only conversions know is a row too (status and channel 'Unknown'), so that
    the inner joins with this dimension lose none of its leads.
    """
    attrs = ["campaign_name", "campaign_status", "campaign_advertising_channel_type"]
    rows = campaigns.select("campaign_id", "segments_date", *attrs, F.lit(1).alias("own"))
    if conversions is not None:
        rows = rows.unionByName(conversions.select(
            "campaign_id", "segments_date", "campaign_name", *[F.lit("Unknown").alias(a) for a in attrs[1:]], F.lit(0).alias("own")))
    # hash-aggregate to distinct attribute combinations first (fixed-width buffer,
    # map-side combine); only that small set goes through the sort-based max_by
    combos = rows.groupBy(_nk("campaign_id").alias("campaign_id"), "own", *attrs).agg(
        F.max("segments_date").alias("segments_date")
    )
    latest = F.max_by(F.struct(*attrs), F.struct("own", "segments_date", *attrs))
    return (
        combos.groupBy("campaign_id")
        .agg(latest.alias("l"))
        .selectExpr(
            f"{SK('campaign_id')} AS campaign_pk",
            "campaign_id",
            "l.campaign_name AS campaign_name",
            "l.campaign_status AS campaign_status",
            "l.campaign_advertising_channel_type AS advertising_channel_type",
        )
    )


def dim_ad_group(keywords: DataFrame, ads_data: DataFrame | None = None) -> DataFrame:
    """GD-2: one row per ad group (keyword and ad inventories), latest name and parent campaign.

    Dated keyword rows win over undated ad inventory rows.
    """
    cols = [
        _nk("ad_group_id").alias("ad_group_id"),
        F.col("ad_group_name"),
        _nk("campaign_id").alias("campaign_id"),
    ]
    parts = [keywords.select(*cols, F.col("segments_date"))]
    if ads_data is not None:
        parts.append(ads_data.select(*cols, F.lit(None).cast("date").alias("segments_date")))
    src = reduce(DataFrame.unionByName, parts)
    undated_first = F.coalesce(F.col("segments_date"), F.lit("0001-01-01").cast("date"))
    combos = src.groupBy("ad_group_id", "ad_group_name", "campaign_id").agg(F.max(undated_first).alias("d"))
    latest = F.max_by(F.struct("ad_group_name", "campaign_id"), F.struct("d", "ad_group_name", "campaign_id"))
    return (
        combos.groupBy("ad_group_id")
        .agg(latest.alias("l"))
        .selectExpr(
            f"{SK('ad_group_id')} AS ad_group_pk",
            "ad_group_id",
            "l.ad_group_name AS ad_group_name",
            "l.campaign_id AS campaign_id",
            f"{SK('l.campaign_id')} AS campaign_pk",
        )
    )


def dim_ad(ads_data: DataFrame) -> DataFrame:
    """GD-3: one row per ad (ad group, ad id), keeping the natural ad_group_id."""
    keys = [_nk("ad_group_id").alias("ad_group_id"), _nk("ad_group_ad_ad_id").alias("ad_id")]
    combos = ads_data.groupBy(*keys, "ad_group_ad_ad_type", "ad_group_ad_status").agg(F.count(F.lit(1)).alias("_n"))
    return (
        combos.groupBy("ad_group_id", "ad_id")
        .agg(F.max(F.struct("ad_group_ad_ad_type", "ad_group_ad_status")).alias("l"))
        .selectExpr(
            f"{SK('ad_group_id', 'ad_id')} AS ad_pk",
            "ad_id",
            "ad_group_id",
            "l.ad_group_ad_ad_type AS ad_type",
            "l.ad_group_ad_status AS ad_status",
        )
    )


def dim_keyword(keywords: DataFrame) -> DataFrame:
    """GD-4: distinct (keyword text, match type)."""
    return (
        keywords.selectExpr(f"{_nk_sql('keyword')} AS keyword_text",
                            f"{_nk_sql('keyword_match_type')} AS keyword_match_type")
        .distinct()
        .selectExpr(f"{SK('keyword_text', 'keyword_match_type')} AS keyword_pk", "keyword_text",
                    "keyword_match_type")
    )


def _enum_dim(df: DataFrame, src: str, name: str, pk: str) -> DataFrame:
    return df.selectExpr(f"{_nk_sql(src)} AS {name}").distinct().selectExpr(f"{SK(name)} AS {pk}", name)


def dim_age_range(ages: DataFrame) -> DataFrame:
    """GD-5."""
    return _enum_dim(ages, "age_range", "age_range", "age_range_pk")


def dim_gender(genders: DataFrame) -> DataFrame:
    """GD-6."""
    return _enum_dim(genders, "gender", "gender", "gender_pk")


def dim_network(networks: DataFrame) -> DataFrame:
    """GD-7."""
    return _enum_dim(networks, "ad_network", "network_name", "network_pk")


def dim_date(*dated: DataFrame) -> DataFrame:
    """GD-8: one row per date that occurs in the given tables.

    A distinct over the union of the date columns: each map task emits only
    its distinct dates (partial aggregation), so the shuffle is tiny.  (A
    min..max calendar would be generated by one task and explode on one bad
    outlier date.)
    """
    dates = reduce(DataFrame.unionByName, [d.select(F.col("segments_date").alias("full_date")) for d in dated])
    cal = dates.filter(F.col("full_date").isNotNull()).distinct()
    return cal.selectExpr(
        f"{DK('full_date')} AS date_key",
        "full_date",
        "year(full_date) AS year",
        "month(full_date) AS month",
        "dayofmonth(full_date) AS day_of_month",
        "dayofweek(full_date) AS day_of_week",
    )


def fact_campaign_perf(campaigns: DataFrame, conversions: DataFrame) -> DataFrame:
    """GD-9: campaign x day performance with that day's conversions, whichever side has the day.

    Both sides are first aggregated to the campaign x day grain (map-side
    partial aggregation, so a hot campaign is combined before the shuffle);
    the join is then between two unique-keyed inputs hash-partitioned on the
    same keys, so it needs no further exchange and cannot fan out cost.
    """
    key = f"{_nk_sql('campaign_id')} AS campaign_id"
    perf = campaigns.selectExpr(key, "segments_date", "metrics_impressions", "metrics_clicks", "cost_inr").groupBy(
        "campaign_id", "segments_date").agg(
        F.expr("sum(metrics_impressions) AS impressions"),
        F.expr("sum(metrics_clicks) AS clicks"),
        F.expr(f"CAST(sum(CAST(cost_inr AS {MONEY_DEC})) AS DOUBLE) AS cost_inr"),
    )
    conv = conversions.selectExpr(key, "segments_date", "conversions", "conversions_value").groupBy(
        "campaign_id", "segments_date").agg(
        F.expr("sum(conversions) AS conversions"),
        F.expr(f"CAST(sum(CAST(conversions_value AS {MONEY_DEC})) AS DOUBLE) AS conversions_value"),
    )
    j = perf.join(conv, ["campaign_id", "segments_date"], "full")
    return j.selectExpr(
        f"{SK('campaign_id')} AS campaign_pk",
        f"{DK('segments_date')} AS date_key",
        "campaign_id",
        "segments_date",
        "coalesce(impressions, CAST(0 AS BIGINT)) AS impressions",
        "coalesce(clicks, CAST(0 AS BIGINT)) AS clicks",
        "coalesce(cost_inr, CAST(0 AS DOUBLE)) AS cost_inr",
        "coalesce(conversions, CAST(0 AS DOUBLE)) AS conversions",
        "coalesce(conversions_value, CAST(0 AS DOUBLE)) AS conversions_value",
    )


def fact_keyword_perf(keywords: DataFrame) -> DataFrame:
    """GD-10: keyword rows with computed keys (narrow projection)."""
    return keywords.selectExpr(
        f"{SK('keyword', 'keyword_match_type')} AS keyword_pk",
        f"{SK('ad_group_id')} AS ad_group_pk",
        f"{SK('campaign_id')} AS campaign_pk",
        f"{DK('segments_date')} AS date_key",
        "metrics_impressions AS impressions",
        "metrics_clicks AS clicks",
        "cost_inr",
        "quality_score",
    )


def _audience_fact(df: DataFrame, attr: str, pk: str) -> DataFrame:
    return df.selectExpr(
        f"{SK(attr)} AS {pk}",
        f"{SK('campaign_id')} AS campaign_pk",
        f"{SK('ad_group_id')} AS ad_group_pk",
        f"{DK('segments_date')} AS date_key",
        "metrics_impressions AS impressions",
        "metrics_clicks AS clicks",
        "metrics_conversions AS conversions",
        "cost_inr",
    )


def fact_age_perf(ages: DataFrame) -> DataFrame:
    """GD-11."""
    return _audience_fact(ages, "age_range", "age_range_pk")


def fact_gender_perf(genders: DataFrame) -> DataFrame:
    """GD-12."""
    return _audience_fact(genders, "gender", "gender_pk")


def fact_campaign_network_perf(networks: DataFrame) -> DataFrame:
    """GD-13 (no cost at network grain)."""
    return networks.selectExpr(
        f"{SK('ad_network')} AS network_pk",
        f"{SK('campaign_id')} AS campaign_pk",
        f"{DK('segments_date')} AS date_key",
        "metrics_impressions AS impressions",
        "metrics_clicks AS clicks",
        "metrics_conversions AS conversions",
    )


GOLD_INPUTS = {
    "dim_campaign": ("campaigns", "conversions"),
    "dim_ad_group": ("keywords", "ads_data"),
    "dim_ad": ("ads_data",),
    "dim_keyword": ("keywords",),
    "dim_age_range": ("ages",),
    "dim_gender": ("genders",),
    "dim_network": ("networks",),
    "dim_date": ("campaigns", "conversions"),
    "fact_campaign_perf": ("campaigns", "conversions"),
    "fact_keyword_perf": ("keywords",),
    "fact_age_perf": ("ages",),
    "fact_gender_perf": ("genders",),
    "fact_campaign_network_perf": ("networks",),
}


def gold_table(name: str, silver: Mapping[str, DataFrame]) -> DataFrame:
    s = silver
    builders = {
        "dim_campaign": lambda: dim_campaign(s["campaigns"], s["conversions"]),
        "dim_ad_group": lambda: dim_ad_group(s["keywords"], s["ads_data"]),
        "dim_ad": lambda: dim_ad(s["ads_data"]),
        "dim_keyword": lambda: dim_keyword(s["keywords"]),
        "dim_age_range": lambda: dim_age_range(s["ages"]),
        "dim_gender": lambda: dim_gender(s["genders"]),
        "dim_network": lambda: dim_network(s["networks"]),
        "dim_date": lambda: dim_date(s["campaigns"], s["conversions"]),
        "fact_campaign_perf": lambda: fact_campaign_perf(s["campaigns"], s["conversions"]),
        "fact_keyword_perf": lambda: fact_keyword_perf(s["keywords"]),
        "fact_age_perf": lambda: fact_age_perf(s["ages"]),
        "fact_gender_perf": lambda: fact_gender_perf(s["genders"]),
        "fact_campaign_network_perf": lambda: fact_campaign_network_perf(s["networks"]),
    }
    return builders[name]()


def build_gold(silver: Mapping[str, DataFrame]) -> LazyLayer:
    """All 13 gold tables, each built lazily from the silver mapping."""
    return LazyLayer(lambda n: gold_table(n, silver), DIMS + FACTS)


def by_month(df: DataFrame, name: str) -> DataFrame:
    """A gold table to be saved by month: facts and ``dim_date`` get the month of their date key.

    Facts are dealt out by month before they are written, so that a month has few files; the hint lets AQE split
    a month that holds many rows.
    """
    if name != "dim_date" and name not in FACTS:
        return df
    out = df.withColumn(MONTH_KEY, F.expr("CAST(date_key DIV 100 AS INT)"))
    return out.hint("rebalance", MONTH_KEY) if name in FACTS else out


def in_period(gold: Mapping[str, DataFrame], period: str) -> LazyLayer:
    """The gold tables with facts and ``dim_date`` restricted to the days for which ``period``, a condition on ``dim_date``, holds.

    Facts keep their rows by a semi-join on the day and its month.  Where they were saved by month (``by_month``) and Spark
    broadcasts the days, which it decides by their bytes, only these months' files are read (dynamic partition pruning).
    """
    days = gold["dim_date"].where(period)

    def table(name: str) -> DataFrame:
        if name == "dim_date":
            return days
        if name not in FACTS:
            return gold[name]
        keys = ["date_key", *[k for k in (MONTH_KEY,) if k in gold[name].columns]]
        return gold[name].join(days.select(*keys), keys, "left_semi")

    return LazyLayer(table, DIMS + FACTS)
