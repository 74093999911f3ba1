"""Sinks, catalog, audit (SNK-*, CAT-*), bronze landing and incremental landing."""

import os
import tempfile

from pyspark.sql import functions as F

from adlake.functions.names import flatten_names
from adlake.operators.spec import SPEC_BY_SILVER
from adlake.plans import catalog as C
from adlake.plans.pipeline import Lakehouse, run
from adlake.sources.bronze import CORE_CAMPAIGN_DDL, land_csv, read_bronze
from adlake.sources.fixtures import bronze_frame
from adlake.streaming.landing import land_csv_incremental

from conftest import SF_SMALL


def test_save_layer_isolates_failures_and_audits(spark):
    good = spark.range(5).withColumnRenamed("id", "x")
    bad = spark.range(5).selectExpr("id", "id as id")  # duplicate column: write fails
    out = {r.table_name: r.status for r in C.save_layer(spark, "t_layer", {"good": good, "bad": bad}).collect()}
    assert out == {"good": "ok", "bad": "error"}
    assert "t_layer" in C.list_databases(spark)
    assert C.list_tables(spark, "t_layer") == ["good"]
    assert C.list_columns(spark, "t_layer.good") == ["x"]
    rows = {r.table_name: r.row_count for r in C.audit(spark, "t_layer").collect()}
    assert rows == {"good": 5, "__total__": 5}
    # overwrite replaces the schema (SNK-2) and is idempotent
    C.save_layer(spark, "t_layer", {"good": spark.range(3).selectExpr("id as y", "'a' as z")})
    assert C.list_columns(spark, "t_layer.good") == ["y", "z"]
    assert spark.table("t_layer.good").count() == 3
    assert C.preview(spark.table("t_layer.good"), 2).count() == 2
    assert "y:bigint" in C.schema_of(spark.table("t_layer.good"))


def test_csv_landing_roundtrip(spark):
    base = tempfile.mkdtemp(prefix="adlake-land-")
    src = bronze_frame(spark, SF_SMALL, "core_campaign_performance")
    src.write.option("header", True).csv(os.path.join(base, "csv"))
    landed = land_csv(spark, os.path.join(base, "csv"), os.path.join(base, "bronze"), CORE_CAMPAIGN_DDL)
    assert landed.schema == spark.createDataFrame([], CORE_CAMPAIGN_DDL).schema
    assert sorted(map(tuple, landed.collect()), key=str) == sorted(map(tuple, src.collect()), key=str)
    inferred = land_csv(spark, os.path.join(base, "csv"), os.path.join(base, "bronze2"))
    assert dict(inferred.dtypes)["campaign.id"] == "int"  # T3: inference makes ids numeric


def test_incremental_landing_exactly_once(spark):
    base = tempfile.mkdtemp(prefix="adlake-stream-")
    src = bronze_frame(spark, SF_SMALL, "core_campaign_performance")
    src.limit(100).write.option("header", True).csv(os.path.join(base, "in", "batch1"))
    inp = os.path.join(base, "in", "*")
    out, ck = os.path.join(base, "out"), os.path.join(base, "ck")
    land_csv_incremental(spark, inp, out, ck, CORE_CAMPAIGN_DDL)
    assert spark.read.parquet(out).count() == 100
    land_csv_incremental(spark, inp, out, ck, CORE_CAMPAIGN_DDL)  # nothing new: no duplicates
    assert spark.read.parquet(out).count() == 100


def test_pipeline_run_matches_lazy(spark):
    lake = Lakehouse.from_fixtures(spark, SF_SMALL)
    out = run(spark, lake.bronze, "t_silver", "t_gold", "t_analytics")
    assert out.filter("status <> 'ok'").count() == 0
    assert len(C.list_tables(spark, "t_silver")) == 22 and len(C.list_tables(spark, "t_gold")) == 13
    saved = spark.table("t_analytics.kpi_1_summary")
    lazy = lake.kpis["kpi_1_summary"]
    assert sorted(map(tuple, saved.collect())) == sorted(map(tuple, lazy.collect()))
    # two silver tables share their bronze names (ads_data, ads_performance)
    assert set(read_bronze(spark, "t_silver")) == {"ads_data", "ads_performance"}


def test_audit_survives_a_damaged_file(spark):
    from test_report import damage

    C.save_layer(spark, "t_audit", {"whole": spark.range(5), "broken": spark.range(7)})
    damage(spark, "t_audit", "broken")
    got = {r.table_name: r for r in C.audit(spark, "t_audit").collect()}
    assert got["whole"].row_count == 5 and got["whole"].columns == "id bigint" and got["__total__"].row_count == 5
    assert got["broken"].row_count is None and got["broken"].columns.startswith("ERROR: ")


def test_run_is_honest(spark):
    """Every planned table has an outcome; nothing of an earlier run is read; causes and whole errors are kept."""
    from adlake.operators.gold import DIMS, FACTS
    from adlake.operators.kpi import KPI_NAMES
    from adlake.operators.spec import SILVER_TABLES
    from adlake.plans.pipeline import REPORTS

    lake = Lakehouse.from_fixtures(spark, SF_SMALL)
    names = ("core_campaign_performance", "conversion_performance", "network_performance")
    bronze = {n: lake.bronze[n] for n in names}
    dbs = ("h_silver", "h_gold", "h_analytics")
    planned = {*SILVER_TABLES, *DIMS, *FACTS, *KPI_NAMES, *(f"report_{r}" for r in REPORTS)}
    first = {r.table_name: r for r in run(spark, bronze, *dbs, partition_by={"networks": ["segments_date"]}).collect()}
    assert set(first) == planned
    assert {n for n, r in first.items() if r.status == "ok"} >= {"campaigns", "fact_campaign_perf", "kpi_1_summary", "kpi_8_network_performance",
                                                                 "report_account_totals", "report_markdown", "report_pack"}
    assert first["keywords"].status == "skipped" and "search_keyword_performance" in first["keywords"].error
    assert first["kpi_3_top_keywords"].status == "skipped" and "fact_keyword_perf" in first["kpi_3_top_keywords"].error
    pack = {r.kpi: r.status for r in spark.table("h_analytics.report_pack").collect()}
    assert pack["kpi_1_summary"] == "ok" and pack["kpi_3_top_keywords"] == "error" and len(pack) == 10
    assert [c.name for c in spark.catalog.listColumns("h_silver.networks") if c.isPartition] == ["segments_date"]

    # the campaigns now fail while they are written; their table of the first run is still there, and must not be used
    bad = bronze[names[0]].withColumn("`metrics.clicks`", F.raise_error(F.lit("campaigns\nare broken")).cast("bigint"))
    bad = bronze[names[0]].select(*[F.raise_error(F.lit("campaigns\nare broken")).cast("bigint").alias(c) if c == "metrics.clicks" else F.col(f"`{c}`")
                                    for c in bronze[names[0]].columns])
    second = {r.table_name: r for r in run(spark, {**bronze, names[0]: bad}, *dbs).collect()}
    assert set(second) == planned
    assert second["campaigns"].status == "error" and "are broken" in second["campaigns"].error
    assert {second[n].status for n in ("fact_campaign_perf", "kpi_1_summary", "report_account_totals")} == {"skipped"}
    assert second["dim_network"].status == "ok"


def test_checkpointed_tables_are_kpis_only(spark):
    """Reports checkpoint aggregates (KPI tables), never a fact or dimension."""
    lake = Lakehouse.from_fixtures(spark, SF_SMALL)
    seen = []
    lake._checkpoint = lambda df: seen.append(df.columns) or df
    lake.report("pack")
    facts = [lake.gold[g].columns for g in lake.gold.names()]
    assert len(seen) == 10 and not any(c in facts for c in seen)


def test_geo_lookup_is_unique_and_salted(spark):
    from adlake.operators.silver import enrich_geo

    geo = spark.createDataFrame([("1", "b", "b, X", "X"), ("1", "a", "a, X", "X"), ("2", "c", "c", "Y")],
                                "constant_id string, name string, canonical_name string, country_code string")
    loc = spark.createDataFrame([("1", 1), ("1", 2), ("", 3), ("", 4), ("9", 5), (None, 6)], "city_id string, n int")
    rows = {r.n: r.city_name for r in enrich_geo(loc, geo).collect()}
    assert rows == {1: "a", 2: "a", 3: None, 4: None, 5: None, 6: None}
    empty = enrich_geo(loc, geo.union(spark.createDataFrame([("", "nowhere", "n", "N")], geo.schema)))
    assert {r.n: r.city_name for r in empty.collect()}[3] == "nowhere" and empty.count() == 6
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    enrich_geo(loc, geo)
    assert sorted(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == sorted(jobs)  # planning runs no job


def test_cluster_without_shared_folder_is_refused():
    import pytest

    from adlake.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_read_bronze_and_spec_contract(spark):
    bronze = bronze_frame(spark, SF_SMALL, "network_performance")
    C.save_layer(spark, "t_bronze", {"network_performance": bronze})
    got = read_bronze(spark, "t_bronze")
    assert list(got) == ["network_performance"]
    flat = flatten_names(got["network_performance"])
    assert set(SPEC_BY_SILVER["networks"].required_columns()) <= set(flat.columns)


def test_declared_bronze_contract(spark):
    """Every report type has a declared schema; fixtures conform; specs only read declared columns."""
    from pyspark.sql.types import _parse_datatype_string

    from adlake.operators.spec import SPEC_BY_BRONZE
    from adlake.sources.bronze import BRONZE_DDL
    from adlake.sources.fixtures import FIXTURES

    assert set(BRONZE_DDL) == set(FIXTURES) == set(SPEC_BY_BRONZE)
    for name, ddl in BRONZE_DDL.items():
        declared = _parse_datatype_string(ddl)
        got = bronze_frame(spark, SF_SMALL, name).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in declared], name
        spec = SPEC_BY_BRONZE[name]
        flat = {f.name.replace(".", "_").replace("__", "_") if spec.collapse_underscores else f.name.replace(".", "_")
                for f in declared}
        assert set(spec.required_columns()) <= flat, name


def test_cli_land_run_audit(spark, capsys):
    """python -m adlake land / run / audit on CSV exports of every report type."""
    from adlake.__main__ import main
    from adlake.sources.fixtures import FIXTURES

    base = tempfile.mkdtemp(prefix="adlake-cli-")
    for name in FIXTURES:
        bronze_frame(spark, SF_SMALL, name).write.option("header", True).csv(os.path.join(base, name))
    main(["land", "--csv", base, "--bronze-db", "cli_bronze"])
    assert len(C.list_tables(spark, "cli_bronze")) == 22
    main(["run", "--bronze-db", "cli_bronze", "--silver-db", "cli_silver", "--gold-db", "cli_gold",
          "--analytics-db", "cli_analytics"])
    main(["audit", "--db", "cli_analytics"])
    assert [len(C.list_tables(spark, d)) for d in ("cli_silver", "cli_gold", "cli_analytics")] == [22, 13, 30]
    md = spark.table("cli_analytics.report_markdown")
    assert md.filter("line_no = 1").count() == 10
    assert "kpi_10_ad_type_dist" in capsys.readouterr().out  # the audit listed the KPI tables
    lake = Lakehouse.from_fixtures(spark, SF_SMALL)
    landed = spark.table("cli_analytics.kpi_1_summary")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, lake.kpis["kpi_1_summary"].collect()))
