"""

Every query derives ads-shaped bronze tables from the supplied test tables
(``adlake.sources.fixtures``) and runs the library's silver -> gold -> KPI ->
report operators over them as one lazily composed DataFrame plan.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import reduce
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adlake.functions.names import flatten_names  # noqa: E402
from adlake.operators.gold import DIMS, FACTS, in_period  # noqa: E402
from adlake.operators.kpi import KPI_NAMES, kpi  # noqa: E402
from adlake.operators.report import kpi_frames_from_catalog, report_pack  # noqa: E402
from adlake.operators.spec import BRONZE_TABLES, SILVER_TABLES  # noqa: E402
from adlake.plans.catalog import (  # noqa: E402
    audit, audit_frames, list_columns, list_databases, list_tables, preview, save_layer, save_table, save_tables,
)
from adlake.plans.pipeline import REPORTS, Lakehouse, run  # noqa: E402
from adlake.session import shared_dir  # noqa: E402
from adlake.sources.bronze import (  # noqa: E402
    BRONZE_DDL, CORE_CAMPAIGN_DDL, check_bronze, land_csv, land_csv_quarantine, measure_bronze, read_bronze, write_csv,
)

FLAGSHIP_SF = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: KPI 1 (campaign performance summary) on sf0.001."""
    return Lakehouse.from_fixtures(spark, FLAGSHIP_SF).kpis["kpi_1_summary"]


def _silver(name: str):
    return lambda spark, sf: Lakehouse.from_fixtures(spark, sf).silver[name]


def _gold(name: str):
    return lambda spark, sf: Lakehouse.from_fixtures(spark, sf).gold[name]


def _kpi(name: str):
    return lambda spark, sf: Lakehouse.from_fixtures(spark, sf).kpis[name]


def _report(name: str):
    return lambda spark, sf: Lakehouse.from_fixtures(spark, sf).report(name)


def _audit_silver(spark: SparkSession, sf: str) -> DataFrame:
    return audit_frames(Lakehouse.from_fixtures(spark, sf).silver)


def _bronze_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Write the campaign report as headered CSV, land it as Parquet, read it back."""
    from adlake.sources.fixtures import bronze_frame

    base = shared_dir(spark, "adlake-landing")
    bronze_frame(spark, sf, "core_campaign_performance").write.mode("overwrite").option("header", True).csv(
        f"{base}/csv"
    )
    landed = land_csv(spark, f"{base}/csv", f"{base}/bronze", CORE_CAMPAIGN_DDL)
    return flatten_names(landed)


#: Bronze tables that the faulty run has broken and has not, and saved tables that are then damaged or emptied.
BROKEN_BRONZE, ABSENT_BRONZE = "search_keyword_performance", "audience_gender_performance"
DAMAGED_SILVER, DAMAGED_KPI, EMPTY_KPI = "networks", "kpi_8_network_performance", "kpi_2_cpl_ranking"
LAYERS = ("bronze", "silver", "gold", "analytics")
_RUNS: dict[tuple, tuple] = {}


def _once(make):
    """One run for each session and folder: several queries read the tables that it saved."""
    def call(spark: SparkSession, sf: str):
        key = (make.__name__, spark.sparkContext.applicationId, sf)
        if key not in _RUNS:
            _RUNS[key] = make(spark, sf)
        return _RUNS[key]

    return call


def _databases(spark: SparkSession) -> dict[str, str]:
    """New databases in the shared folder, one for each layer."""
    prefix = f"adlake_{uuid.uuid4().hex[:12]}"
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE {prefix}_{layer} LOCATION '{shared_dir(spark, prefix)}'")
    return {layer: f"{prefix}_{layer}" for layer in LAYERS}


@_once
def _saved(spark: SparkSession, sf: str) -> tuple[dict[str, str], DataFrame]:
    """All 22 bronze tables, then silver, gold (facts by month) and KPI tables, saved and read back layer by layer; the
    databases by layer and all outcomes."""
    dbs = _databases(spark)
    save_layer(spark, dbs["bronze"], {n: Lakehouse.from_fixtures(spark, sf).bronze[n] for n in BRONZE_TABLES})
    outcomes = run(spark, read_bronze(spark, dbs["bronze"]), dbs["silver"], dbs["gold"], dbs["analytics"], facts_by_month=True, reports=())
    return dbs, outcomes


@_once
def _faulty(spark: SparkSession, sf: str) -> tuple[dict[str, str], DataFrame]:
    """A run with one bronze table that breaks while it is read and one that is absent; its outcomes with the rows of every
    saved table.  After it one silver and one KPI table are damaged (text files take the place of theirs) and one KPI is emptied."""
    dbs = _databases(spark)
    fixtures = Lakehouse.from_fixtures(spark, sf).bronze
    bronze = {n: fixtures[n] for n in BRONZE_TABLES if n != ABSENT_BRONZE}
    broken = bronze[BROKEN_BRONZE]
    bronze[BROKEN_BRONZE] = broken.select(*[
        F.raise_error(F.lit("damaged block")).cast(kind).alias(c) if c == "metrics.clicks" else F.col(f"`{c}`") for c, kind in broken.dtypes])
    outcomes = run(spark, bronze, dbs["silver"], dbs["gold"], dbs["analytics"], reports=())
    counts = [audit(spark, dbs[x]).where("status = 'ok'").select(F.lit(dbs[x]).alias("db"), "table_name", "row_count") for x in LAYERS[1:]]
    layer = F.element_at(F.split("db", "_"), -1).alias("layer")
    told = outcomes.join(reduce(DataFrame.unionByName, counts), ["db", "table_name"], "left").select(layer, "table_name", "status", "cause", "row_count")
    gold = {n: spark.table(f"{dbs['gold']}.{n}") for n in ("fact_campaign_perf", "dim_campaign")}
    save_table(kpi(EMPTY_KPI, gold, min_leads=float("inf")), f"{dbs['analytics']}.{EMPTY_KPI}")
    for table in (f"{dbs['silver']}.{DAMAGED_SILVER}", f"{dbs['analytics']}.{DAMAGED_KPI}"):
        folder = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
        spark.range(3).selectExpr("CAST(id AS STRING) AS value").write.mode("overwrite").text(folder)
        spark.catalog.refreshTable(table)
    return dbs, told


def _saved_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Every saved bronze, silver and gold table, as the catalog lists it, with its rows counted and a preview's rows."""
    dbs, _ = _saved(spark, sf)
    assert set(dbs.values()) <= set(list_databases(spark))
    parts = [spark.table(f"{dbs[x]}.{t}").agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(x).alias("layer"), F.lit(t).alias("table_name"), "row_count",
        F.lit(preview(spark.table(f"{dbs[x]}.{t}"), 3).count()).cast("bigint").alias("preview_rows"))
        for x in ("bronze", "silver", "gold") for t in list_tables(spark, dbs[x])]
    return reduce(DataFrame.unionByName, parts)


def _saved_kpi_1(spark: SparkSession, sf: str) -> DataFrame:
    return spark.table(f"{_saved(spark, sf)[0]['analytics']}.kpi_1_summary")


def _saved_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns and schema of the saved silver tables, from the catalog."""
    db = _saved(spark, sf)[0]["silver"]
    rows = [(t, k, c, dict(spark.table(f"{db}.{t}").dtypes)[c]) for t in list_tables(spark, db)
            for k, c in enumerate(list_columns(spark, f"{db}.{t}"), start=1)]
    return spark.createDataFrame(rows, "table_name string, position bigint, column_name string, column_type string")


def _saved_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """The whole bronze database as it was saved: contract status, rows, empty cells and text of every table."""
    db = _saved(spark, sf)[0]["bronze"]
    return check_bronze(spark, db).select("table_name", "status", "n_columns").join(measure_bronze(read_bronze(spark, db)), "table_name")


def _bronze_contract(spark: SparkSession, sf: str) -> DataFrame:
    """The contract against a database with one table as declared, one that lacks, adds and retypes columns, and no others."""
    db, fixtures = _databases(spark)["bronze"], Lakehouse.from_fixtures(spark, sf).bronze
    odd = fixtures["asset"].drop("asset.source").withColumn("extra", F.lit(1)).withColumn("asset.id", F.col("`asset.id`").cast("bigint"))
    save_layer(spark, db, {"asset": odd, "network_performance": fixtures["network_performance"]})
    return check_bronze(spark, db)


def _digest(name: str, df: DataFrame) -> DataFrame:
    """One row for a KPI table: its rows, and the sum of a number that each row's text is hashed to (in any order)."""
    cells = ", ".join(f"coalesce(CAST({f'CAST(`{c}` AS DECIMAL(38,2))' if kind == 'double' else f'`{c}`'} AS STRING), '')" for c, kind in df.dtypes)
    one = f"CAST(conv(substring(md5(concat_ws('|', {cells})), 1, 8), 16, 10) AS BIGINT)"
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.expr(f"coalesce(sum({one}), 0)").alias("digest")).select(
        F.lit(name).alias("kpi"), "row_count", "digest")


def _saved_kpi_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The ten KPI tables, read back by name: rows and digest of each."""
    db = _saved(spark, sf)[0]["analytics"]
    return reduce(DataFrame.unionByName, [_digest(k, spark.table(f"{db}.{k}")) for k in KPI_NAMES])


def _saved_month_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Every KPI over the latest month, from saved gold tables whose facts are partitioned by month."""
    db = _saved(spark, sf)[0]["gold"]
    gold = {n: spark.table(f"{db}.{n}") for n in DIMS + FACTS}
    last = gold["dim_date"].agg(F.max("month_key")).first()[0]
    period = in_period(gold, f"year = {(last or 0) // 100} AND month = {(last or 0) % 100}")
    return reduce(DataFrame.unionByName, [_digest(k, kpi(k, period)) for k in KPI_NAMES])


def _audit_saved(spark: SparkSession, sf: str) -> DataFrame:
    """The audit of a saved silver layer with damaged and missing tables; what their errors say differs from engine to engine."""
    found = audit(spark, _faulty(spark, sf)[0]["silver"], SILVER_TABLES)
    return found.withColumn("columns", F.when(F.col("status").isin("ok", "total"), F.col("columns")))


def _report_pack_saved(spark: SparkSession, sf: str) -> DataFrame:
    """The registry over saved KPI tables, of which some were never saved, one is damaged and one is empty."""
    frames, errors = kpi_frames_from_catalog(spark, _faulty(spark, sf)[0]["analytics"])
    return report_pack(frames, errors).drop("error")


def _replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table as it is after four saves: networks; networks by campaign, with other columns; a save that fails; and one that cannot be planned."""
    db, silver = _databases(spark)["silver"], Lakehouse.from_fixtures(spark, sf).silver["networks"]
    second = silver.groupBy("campaign_id").agg(F.sum("metrics_clicks").alias("clicks"), F.countDistinct("ad_network").alias("networks"))
    fails = silver.select("campaign_id", F.raise_error(F.lit("lost")).cast("bigint").alias("clicks"))
    frames = [silver, second, fails, silver.selectExpr("campaign_id", "campaign_id AS CAMPAIGN_ID")]
    done = [save_tables(db, {"networks": f}, ["networks"])[0][1:3] for f in frames]
    assert list_tables(spark, db) == ["networks"]
    outcomes = ",".join(f"{status}:{cause or ''}" for status, cause in done)
    return spark.table(f"{db}.networks").withColumn("saves", F.lit(outcomes))


def _bronze_csv_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """The campaign report as CSV in which some dates are no dates and some records have a field too many or too few: by
    campaign, the records accepted and rejected, and the clicks of those accepted."""
    from adlake.sources.fixtures import bronze_frame

    base = shared_dir(spark, "adlake-landing")
    rows = bronze_frame(spark, sf, "core_campaign_performance")
    day, campaign = F.dayofmonth("`segments.date`"), F.col("`campaign.id`").cast("int") % 5
    dates = F.when((campaign == 1) & (day == 3), "no date").otherwise(F.col("`segments.date`").cast("string"))
    long, short = F.coalesce((campaign == 2) & (day == 4), F.lit(False)), F.coalesce((campaign == 3) & (day == 5), F.lit(False))
    plain = rows.where(~long & ~short)
    write_csv(plain.select(*[dates.alias(c) if c == "segments.date" else F.col(f"`{c}`") for c in rows.columns]), f"{base}/csv/plain")
    write_csv(rows.where(long).withColumn("more", F.lit("x")), f"{base}/csv/long")
    write_csv(rows.where(short).drop("metrics.average_cpc"), f"{base}/csv/short")
    good, bad = land_csv_quarantine(spark, [f"{base}/csv/{x}" for x in ("plain", "long", "short")], f"{base}/bronze", CORE_CAMPAIGN_DDL, rfc=True)
    both = good.select(F.col("`campaign.id`").alias("campaign_id"), F.lit(0).alias("bad"), F.col("`metrics.clicks`").alias("clicks")).unionByName(
        bad.select(F.regexp_extract("record", "^([^,]*)", 1).alias("campaign_id"), F.lit(1).alias("bad"), F.lit(None).cast("bigint").alias("clicks")))
    return both.groupBy("campaign_id").agg(
        F.sum(1 - F.col("bad")).alias("accepted"), F.sum("bad").alias("rejected"), F.count(F.lit(1)).alias("records"), F.sum("clicks").alias("clicks"))


#: Text columns that get quotes, commas and line breaks, and that get empty strings, in the multi-line round trips.
MULTILINE_TEXT = {"ads_data": ("ad_group_ad.ad.responsive_search_ad.headlines", "ad_group_ad.ad.responsive_search_ad.descriptions"),
                  "asset": ("asset.text_asset.text", "asset.sitelink_asset.link_text")}


def _bronze_csv_multiline(name: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        """A report with quotes, commas, line breaks and empty strings in its texts: written as CSV, landed, read back."""
        from adlake.sources.fixtures import bronze_frame

        base, rows, (broken, empty) = shared_dir(spark, "adlake-landing"), bronze_frame(spark, sf, name), MULTILINE_TEXT[name]
        rows = rows.withColumn(broken, F.concat(F.lit('"a", \n,,'), F.col(f"`{broken}`"), F.lit('\n\n "" ')))
        write_csv(rows.withColumn(empty, F.when(F.col(f"`{empty}`").isNull(), "")), f"{base}/csv")
        return flatten_names(land_csv(spark, f"{base}/csv", f"{base}/bronze", BRONZE_DDL[name], multiline=True, rfc=True))

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for s in SILVER_TABLES:
        q[f"silver_{s}"] = _silver(s)
    for g in DIMS + FACTS:
        q[g] = _gold(g)
    for k in KPI_NAMES:
        q[k] = _kpi(k)
    q["metric_roas"] = lambda spark, sf: Lakehouse.from_fixtures(spark, sf).roas()
    for r in REPORTS:
        q[f"report_{r}"] = _report(r)
    q["audit_silver"] = _audit_silver
    q["bronze_csv_roundtrip"] = _bronze_csv_roundtrip
    q["saved_tables"] = _saved_tables
    q["saved_kpi_1_summary"] = _saved_kpi_1
    q["saved_columns"] = _saved_columns
    q["saved_bronze"] = _saved_bronze
    q["saved_kpi_tables"] = _saved_kpi_tables
    q["saved_month_kpis"] = _saved_month_kpis
    q["saved_outcomes"] = lambda spark, sf: _faulty(spark, sf)[1]
    q["audit_saved_silver"] = _audit_saved
    q["report_pack_saved"] = _report_pack_saved
    q["replaced_table"] = _replaced_table
    q["bronze_contract"] = _bronze_contract
    q["bronze_csv_quarantine"] = _bronze_csv_quarantine
    for name in MULTILINE_TEXT:
        q[f"bronze_csv_multiline_{name}"] = _bronze_csv_multiline(name)
    q.update(_training_data()[0])
    return q


def _installed(module: str) -> bool:
    try:
        return find_spec(module) is not None
    except ModuleNotFoundError:
        return False


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators and their pipeline, where those are installed."""
    q, sql = {}, {}
    if _installed("adlake.llm.queries"):
        from adlake.llm.queries import ORACLE_SQL, QUERIES

        q.update(QUERIES)
        sql.update(ORACLE_SQL)
        if _installed("corpus_pipeline"):
            import corpus_pipeline

            q["pipeline"] = corpus_pipeline.run
            if corpus_pipeline.ORACLE_SQL:
                sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return q, sql


def oracle_sql() -> dict[str, str]:
    from oracle.sql import oracle_queries

    return {**oracle_queries(), **_training_data()[1]}
