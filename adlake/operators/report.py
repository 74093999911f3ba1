"""Report layer: RPT-1 .. RPT-11 as DataFrame jobs over the KPI tables.

The reference renders the KPI tables as text on the driver and leaves the
arithmetic to a text model.  Here each calculation is a distributed query
whose result is a small table; the markdown rendering (RPT-2) produces one row
per line and numbers the lines without gathering a table into one task.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlake.functions import metrics as m
from adlake.functions.keys import with_row_index
from adlake.operators.kpi import KPI_NAMES, KPI_TITLES
from adlake.plans.catalog import readable

# Fixed values of the report rules: table-size management, sample-size flags,
# the healthy target bands of the benchmark sheet, and the "no data" marker.
REPORT_MAX_ROWS = 15
REPORT_TOP_N = 10
COMPLETE_KPIS = ("kpi_1_summary", "kpi_6_monthly_trend")
TRUNCATED_KPIS = tuple(n for n in KPI_NAMES if n not in COMPLETE_KPIS)
TRUNCATION_NOTE = "*(Showing top {shown} of {total} total rows. Full data available in source system.)*"
ERROR_LINE = "Error fetching data: {}"
LIMITED_SAMPLE_BELOW = 3
NO_DATA = "No data available for this KPI."
BENCHMARK_BANDS = (
    ("CTR", "overall_ctr_pct", 6.5, 8.0, True),
    ("CPC", "average_cpc", 45.0, 65.0, False),
    ("CPL", "average_cpl", 1000.0, 1200.0, False),
    ("Lead Rate", "overall_lead_rate_pct", 8.0, 10.0, True),
)
CURRENCY_SYMBOL = "₹"
# Best against worst: KPI, its label, metric, whether less is better.
BEST_WORST = (
    ("kpi_2_cpl_ranking", "campaign_name", "campaign_cpl", True),
    ("kpi_2_cpl_ranking", "campaign_name", "lead_rate_pct", False),
    ("kpi_3_top_keywords", "keyword_text", "ctr_percentage", False),
    ("kpi_4_age_performance", "age_range", "cpl_inr", True),
    ("kpi_5_gender_performance", "gender", "cpl_inr", True),
    ("kpi_7_adgroup_efficiency", "ad_group_name", "ctr_pct", False),
    ("kpi_7_adgroup_efficiency", "ad_group_name", "avg_cpc_inr", True),
    ("kpi_8_network_performance", "network_name", "cvr_pct", False),
    ("kpi_9_day_of_week", "day_name", "cpl_inr", True),
)

# Each KPI's own ordering, plus its key columns as tie-break (a total order).
KPI_ORDER: dict[str, list[tuple[str, bool]]] = {
    "kpi_1_summary": [("total_cost_inr", True), ("campaign_name", False), ("campaign_status", False)],
    "kpi_2_cpl_ranking": [("campaign_cpl", False), ("campaign_name", False), ("campaign_status", False)],
    "kpi_3_top_keywords": [("total_clicks", True), ("keyword_text", False), ("keyword_match_type", False)],
    "kpi_4_age_performance": [("total_leads", True), ("age_range", False)],
    "kpi_5_gender_performance": [("total_leads", True), ("gender", False)],
    "kpi_6_monthly_trend": [("year", False), ("month", False)],
    "kpi_7_adgroup_efficiency": [("ctr_pct", True), ("ad_group_name", False), ("campaign_name", False)],
    "kpi_8_network_performance": [("total_leads", True), ("network_name", False)],
    "kpi_9_day_of_week": [("day_of_week", False)],
    "kpi_10_ad_type_dist": [("campaign_name", False), ("number_of_ads", True), ("ad_type", False)],
}


def _order_cols(kpi: str) -> list[Column]:
    # Spark's defaults: nulls first ascending, nulls last descending
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in KPI_ORDER[kpi]]


def _dec_sum(c: str, scale: int = 2) -> Column:
    return F.sum(F.col(c).cast(f"decimal(20,{scale})"))


# ---------------------------------------------------------------- RPT-3


def account_totals(kpi1: DataFrame) -> DataFrame:
    """Account totals over KPI 1: sums of sums and weighted (not averaged) rates."""
    t = kpi1.agg(
        F.count(F.lit(1)).alias("campaigns"),
        _dec_sum("total_cost_inr").alias("spend"),
        F.sum("total_impressions").alias("total_impressions"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_leads").alias("total_leads"),
    )
    spend = F.col("spend").cast("double")
    return t.select(
        "campaigns",
        spend.alias("total_spend_inr"),
        "total_impressions",
        "total_clicks",
        "total_leads",
        m.cpc(spend, F.col("total_clicks")).alias("average_cpc"),
        m.cpa(spend, F.col("total_leads")).alias("average_cpl"),
        m.ctr(F.col("total_clicks"), F.col("total_impressions")).alias("overall_ctr_pct"),
        m.cvr(F.col("total_leads"), F.col("total_clicks")).alias("overall_lead_rate_pct"),
    )


# ---------------------------------------------------------------- RPT-4


def truncate_for_report(df: DataFrame, kpi: str, max_rows: int = REPORT_MAX_ROWS, top_n: int = REPORT_TOP_N) -> DataFrame:
    """Tables over ``max_rows`` rows keep their top ``top_n`` by the KPI's own order.

    Adds ``total_rows`` (a scalar subquery: one count, no window), ``truncated`` and
    the ``note`` that says so.  KPI 1 and KPI 6 always stay complete.
    """
    n = df.select(F.count(F.lit(1))).scalar()
    if kpi in COMPLETE_KPIS:
        out = df
        truncated = F.lit(False)
    else:
        small = df.filter(n <= max_rows)
        top = df.orderBy(*_order_cols(kpi)).limit(top_n).filter(n > max_rows)
        out = small.unionByName(top)
        truncated = n > max_rows
    before, after = TRUNCATION_NOTE.format(shown=top_n, total="\n").split("\n")
    note = F.when(truncated, F.concat(F.lit(before), n.cast("string"), F.lit(after)))
    return out.withColumn("total_rows", n).withColumn("truncated", truncated).withColumn("note", note)


# ---------------------------------------------------------------- RPT-1, RPT-5


def _row_counts(kpis: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(i).alias("kpi_no"), F.lit(name).alias("kpi"), F.lit(KPI_TITLES[name]).alias("title"), "row_count"
        )
        for i, name in enumerate(KPI_NAMES, start=1)
        if name in kpis
        for df in [kpis[name]]
    ]
    return reduce(DataFrame.unionByName, parts)


def sample_flags(kpis: Mapping[str, DataFrame]) -> DataFrame:
    """RPT-5: empty / limited (< 3 rows) / ok per KPI table."""
    return _row_counts(kpis).withColumn(
        "sample_flag",
        F.when(F.col("row_count") == 0, "empty").when(F.col("row_count") < LIMITED_SAMPLE_BELOW, "limited").otherwise("ok"),
    )


def report_pack(kpis: Mapping[str, DataFrame], errors: Mapping[str, str] | None = None) -> DataFrame:
    """RPT-1: ordered registry of the KPI tables with status (ok / empty / error) and row count."""
    schema = "kpi_no int, kpi string, title string, status string, row_count long, error string"
    present = [n for n in KPI_NAMES if n in kpis]
    counts = None
    if present:
        counts = _row_counts(kpis).select(
            "kpi_no", "kpi", "title",
            F.when(F.col("row_count") == 0, "empty").otherwise("ok").alias("status"),
            "row_count",
            F.lit(None).cast("string").alias("error"),
        )
    if errors or counts is None:
        spark = kpis[present[0]].sparkSession if present else SparkSession.getActiveSession()
        rows = [(KPI_NAMES.index(k) + 1, k, KPI_TITLES[k], "error", None, msg) for k, msg in (errors or {}).items()]
        failed = spark.createDataFrame(rows, schema)
        counts = failed if counts is None else counts.unionByName(failed)
    return counts


# ---------------------------------------------------------------- RPT-6


def benchmark_bands(kpi1: DataFrame) -> DataFrame:
    """RPT-6: every campaign's CTR, CPC, CPL and lead rate against the target bands."""
    spark = kpi1.sparkSession
    bands = spark.createDataFrame(
        [(name, lo, hi, higher) for name, _, lo, hi, higher in BENCHMARK_BANDS],
        "metric string, band_low double, band_high double, higher_is_better boolean",
    )
    long = kpi1.select(
        "campaign_name",
        "campaign_status",
        F.explode(
            F.array(*[
                F.struct(F.lit(name).alias("metric"), F.col(col).cast("double").alias("value"))
                for name, col, *_ in BENCHMARK_BANDS
            ])
        ).alias("mv"),
    ).select("campaign_name", "campaign_status", "mv.metric", "mv.value")
    j = long.join(F.broadcast(bands), "metric")  # four fixed rows
    band = (
        F.when(F.col("value").isNull(), F.lit(None))
        .when(F.col("value") < F.col("band_low"), "below")
        .when(F.col("value") > F.col("band_high"), "above")
        .otherwise("within")
    )
    return j.select("campaign_name", "campaign_status", "metric", "value", "band_low", "band_high",
                    "higher_is_better", band.alias("band"))


# ---------------------------------------------------------------- RPT-7, RPT-11


def zero_conversion(kpi1: DataFrame) -> DataFrame:
    """RPT-7: campaigns with impressions but no conversions."""
    return kpi1.filter((F.col("total_impressions") > 0) & (F.col("total_leads") == 0))


def zero_conversion_spend_share(kpi1: DataFrame) -> DataFrame:
    """RPT-11: share of spend that went to zero-conversion campaigns."""
    zero = (F.col("total_impressions") > 0) & (F.col("total_leads") == 0)
    t = kpi1.agg(
        F.count(F.when(zero, 1)).alias("zero_conversion_campaigns"),
        F.sum(F.when(zero, F.col("total_cost_inr").cast("decimal(20,2)")).otherwise(F.lit(0).cast("decimal(20,2)")))
        .alias("zs"),
        _dec_sum("total_cost_inr").alias("ts"),
    )
    return t.select(
        "zero_conversion_campaigns",
        F.coalesce(F.col("zs"), F.lit(0)).cast("double").alias("zero_conversion_spend_inr"),
        F.col("ts").cast("double").alias("total_spend_inr"),
        m.ratio_of_sums(F.col("zs").cast("double"), F.col("ts").cast("double"), 100).alias("spend_share_pct"),
    )


# ---------------------------------------------------------------- RPT-8, RPT-9


def best_vs_worst(df: DataFrame, label: str, metric: str, lower_is_better: bool = True) -> DataFrame:
    """RPT-8: best and worst entry by ``metric`` and the gap relative to the worst (%).

    One global aggregate (partial per partition, then one row).  Ties on the
    metric are broken by the label: lowest label at the minimum, highest label
    at the maximum.
    """
    order = F.struct(F.col(metric), F.col(label))
    t = df.filter(F.col(metric).isNotNull()).agg(
        F.count(F.lit(1)).alias("entries"),
        F.min_by(label, order).alias("lo_label"),
        F.min(metric).alias("lo_value"),
        F.max_by(label, order).alias("hi_label"),
        F.max(metric).alias("hi_value"),
    )
    if lower_is_better:
        best_l, best_v, worst_l, worst_v = "lo_label", "lo_value", "hi_label", "hi_value"
    else:
        best_l, best_v, worst_l, worst_v = "hi_label", "hi_value", "lo_label", "lo_value"
    gap = F.round(F.abs(F.col(worst_v) - F.col(best_v)) / F.nullif(F.col(worst_v), F.lit(0)) * 100, 2)
    return t.select(
        F.lit(metric).alias("metric"),
        "entries",
        F.col(best_l).alias("best"),
        F.col(best_v).alias("best_value"),
        F.col(worst_l).alias("worst"),
        F.col(worst_v).alias("worst_value"),
        gap.alias("gap_pct"),
    )


def best_vs_worst_kpis(kpis: Mapping[str, DataFrame]) -> DataFrame:
    """RPT-8 for every KPI with a label and a rate: one row per KPI and metric."""
    return reduce(DataFrame.unionByName, [
        best_vs_worst(kpis[k], label, metric, lower).select(F.lit(k).alias("kpi"), "*") for k, label, metric, lower in BEST_WORST])


def by_status(kpi1: DataFrame) -> DataFrame:
    """RPT-9: KPI 1 rolled up per campaign status with weighted rates."""
    t = kpi1.groupBy("campaign_status").agg(
        F.count(F.lit(1)).alias("campaigns"),
        _dec_sum("total_cost_inr").alias("spend"),
        F.sum("total_impressions").alias("total_impressions"),
        F.sum("total_clicks").alias("total_clicks"),
        F.sum("total_leads").alias("total_leads"),
    )
    spend = F.col("spend").cast("double")
    return t.select(
        "campaign_status",
        "campaigns",
        spend.alias("total_cost_inr"),
        "total_impressions",
        "total_clicks",
        "total_leads",
        m.cpc(spend, F.col("total_clicks")).alias("average_cpc"),
        m.cpa(spend, F.col("total_leads")).alias("average_cpl"),
        m.ctr(F.col("total_clicks"), F.col("total_impressions")).alias("overall_ctr_pct"),
        m.cvr(F.col("total_leads"), F.col("total_clicks")).alias("overall_lead_rate_pct"),
    ).orderBy("campaign_status")


# ---------------------------------------------------------------- RPT-10


def currency_text(c: str | Column) -> Column:
    """Whole currency units with thousands separators: 12500.4 -> '₹12,500'."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(CURRENCY_SYMBOL), F.format_number(F.round(col, 0), 0))


def currency(kpi1: DataFrame) -> DataFrame:
    return kpi1.select("campaign_name", "campaign_status", "total_cost_inr",
                       currency_text("total_cost_inr").alias("total_cost_display"),
                       currency_text("average_cpc").alias("average_cpc_display"),
                       currency_text("average_cpl").alias("average_cpl_display"))


# ---------------------------------------------------------------- RPT-2


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _cell_sql(df: DataFrame, c: str) -> str:
    """One markdown cell: doubles with two decimals, everything else as text, null as ''."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        v = f"CASE WHEN {_q(c)} IS NOT NULL THEN format_string('%.2f', {_q(c)}) END"
    else:
        v = f"CAST({_q(c)} AS STRING)"
    return f"coalesce({v}, '')"


def _order_slots_sql(df: DataFrame, kpi: str, width: int) -> list[str]:
    """The KPI's order as ``width`` type-uniform slots (null rank, number, text).

    Sorting every slot ascending reproduces the KPI's own order, including
    Spark's null placement (first ascending, last descending), so tables with
    different order columns can share one sort.
    """
    out: list[str] = []
    order = KPI_ORDER[kpi]
    for i in range(width):
        if i >= len(order):
            out += ["0", "CAST(NULL AS DOUBLE)", "CAST(NULL AS STRING)"]
            continue
        c, desc = order[i]
        null_rank = f"CASE WHEN {_q(c)} IS NULL THEN {1 if desc else 0} ELSE {0 if desc else 1} END"
        if isinstance(df.schema[c].dataType, T.StringType):
            if desc:
                raise ValueError(f"descending text order is not supported: {kpi}.{c}")
            out += [null_rank, "CAST(NULL AS DOUBLE)", _q(c)]
        else:
            num = f"CAST({_q(c)} AS DOUBLE)"
            out += [null_rank, f"-{num}" if desc else num, "CAST(NULL AS STRING)"]
    return out


def markdown_lines(kpis: Mapping[str, DataFrame], errors: Mapping[str, str] | None = None) -> DataFrame:
    """RPT-2: every KPI table as markdown lines ``(kpi, line_no, line)``.

    Line 1 is the title; a non-empty table follows with a header and separator
    line, then one line per row in the KPI's order; an empty table gets the
    "no data" marker, a KPI in ``errors`` its error text.  All tables' rows are numbered by one
    distributed row index over a shared sort key (KPI number, then the KPI's own
    order); a KPI's lines count from its first row.
    """
    names = [n for n in KPI_NAMES if n in kpis]
    spark = kpis[names[0]].sparkSession if names else SparkSession.getActiveSession()
    failed = spark.createDataFrame(
        [(k, n, line) for k, msg in (errors or {}).items()
         for n, line in ((1, f"## {KPI_TITLES[k]}"), (2, ERROR_LINE.format(" ".join(msg.split()))))],
        "kpi string, line_no long, line string")
    if not names:
        return failed
    width = max(len(KPI_ORDER[n]) for n in names)
    slot_names = [f"_o{i}" for i in range(3 * width)]
    bodies = []
    for no, name in enumerate(KPI_NAMES, start=1):
        if name not in kpis:
            continue
        df = kpis[name]
        line = "concat('| ', concat_ws(' | ', " + ", ".join(_cell_sql(df, c) for c in df.columns) + "), ' |')"
        slots = _order_slots_sql(df, name, width)
        bodies.append(df.selectExpr(f"{no} AS kpi_no", f"'{name}' AS kpi", f"{line} AS line",
                                    *[f"{v} AS {n}" for v, n in zip(slots, slot_names)]))
    body = reduce(DataFrame.unionByName, bodies)
    numbered = with_row_index(body, [F.col("kpi_no")] + [F.col(n).asc() for n in slot_names], "_row")
    firsts = numbered.groupBy("kpi").agg(F.min("_row").alias("_first"))  # one row per KPI
    rows = numbered.join(F.broadcast(firsts), "kpi").select(
        "kpi", (F.col("_row") - F.col("_first") + 4).alias("line_no"), "line")

    registry = spark.createDataFrame(
        [(n, f"## {KPI_TITLES[n]}", "| " + " | ".join(kpis[n].columns) + " |",
          "|" + "|".join([" --- "] * len(kpis[n].columns)) + "|") for n in names],
        "kpi string, title string, header string, sep string",
    )
    counts = body.groupBy("kpi").agg(F.count(F.lit(1)).alias("n"))
    head = registry.join(F.broadcast(counts), "kpi", "left").select(
        "kpi",
        F.explode(
            F.when(F.col("n").isNull(), F.array(
                F.struct(F.lit(1).cast("long").alias("line_no"), F.col("title").alias("line")),
                F.struct(F.lit(2).cast("long").alias("line_no"), F.lit(NO_DATA).alias("line")),
            )).otherwise(F.array(
                F.struct(F.lit(1).cast("long").alias("line_no"), F.col("title").alias("line")),
                F.struct(F.lit(2).cast("long").alias("line_no"), F.col("header").alias("line")),
                F.struct(F.lit(3).cast("long").alias("line_no"), F.col("sep").alias("line")),
            ))
        ).alias("h"),
    ).select("kpi", "h.line_no", "h.line")
    return head.unionByName(rows).unionByName(failed) if errors else head.unionByName(rows)


# ---------------------------------------------------------------- report registry


def report(name: str, kpis: Mapping[str, DataFrame], errors: Mapping[str, str] | None = None) -> DataFrame:
    """One report table; ``errors`` has the KPIs that could not be read, with the cause."""
    if name.startswith("truncated_"):
        k = name.removeprefix("truncated_")
        return truncate_for_report(kpis[k], k)
    builders = {
        "account_totals": lambda: account_totals(kpis["kpi_1_summary"]),
        "truncated": lambda: truncate_for_report(kpis["kpi_7_adgroup_efficiency"], "kpi_7_adgroup_efficiency"),
        "sample_flags": lambda: sample_flags(kpis),
        "benchmark_bands": lambda: benchmark_bands(kpis["kpi_1_summary"]),
        "zero_conversion": lambda: zero_conversion(kpis["kpi_1_summary"]),
        "best_vs_worst": lambda: best_vs_worst(kpis["kpi_2_cpl_ranking"], "campaign_name", "campaign_cpl", True),
        "best_vs_worst_kpis": lambda: best_vs_worst_kpis(kpis),
        "by_status": lambda: by_status(kpis["kpi_1_summary"]),
        "currency": lambda: currency(kpis["kpi_1_summary"]),
        "zero_conv_spend_share": lambda: zero_conversion_spend_share(kpis["kpi_1_summary"]),
        "markdown": lambda: markdown_lines(kpis, errors),
        "pack": lambda: report_pack(kpis, errors),
    }
    return builders[name]()


def kpi_frames_from_catalog(spark: SparkSession, db: str) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Saved KPI tables that can be read whole; the others, missing or damaged, with their error (RPT-1)."""
    return readable(spark, {n: f"{db}.{n}" for n in KPI_NAMES}, whole=True)
