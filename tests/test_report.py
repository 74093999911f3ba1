"""Report operators (RPT-*) on literal KPI frames of 0, 1, 2, 3, 15 and 16 rows."""

import pytest
from pyspark.sql import functions as F

from adlake.functions.keys import with_row_index
from adlake.operators import report as R

K1 = ("campaign_name string, campaign_status string, total_cost_inr double, total_impressions long, "
      "total_clicks long, total_leads double, average_cpc double, average_cpl double, overall_ctr_pct double, "
      "overall_lead_rate_pct double")


@pytest.fixture()
def kpi1(spark):
    rows = [("A", "ENABLED", 1000.0, 100, 20, 2.0, 50.0, 500.0, 20.0, 10.0),
            ("B", "PAUSED", 3000.0, 300, 30, 0.0, 100.0, None, 10.0, 0.0),
            ("C", "ENABLED", 500.5, 0, 0, 0.0, None, None, None, None)]
    return spark.createDataFrame(rows, K1)


def test_account_totals_weighted(kpi1):
    r = R.account_totals(kpi1).first()
    assert r.campaigns == 3 and r.total_spend_inr == 4500.5 and r.total_clicks == 50
    assert r.average_cpc == round(4500.5 / 50, 2)  # weighted, not mean of CPCs
    assert r.overall_ctr_pct == 12.5 and r.average_cpl == round(4500.5 / 2, 2)


def test_zero_conversion_and_share(kpi1):
    assert [r.campaign_name for r in R.zero_conversion(kpi1).collect()] == ["B"]
    r = R.zero_conversion_spend_share(kpi1).first()
    assert r.zero_conversion_campaigns == 1 and r.spend_share_pct == round(3000 / 4500.5 * 100, 2)


def test_by_status(kpi1):
    got = {r.campaign_status: r for r in R.by_status(kpi1).collect()}
    assert got["ENABLED"].campaigns == 2 and got["ENABLED"].total_cost_inr == 1500.5


def test_best_vs_worst(spark):
    df = spark.createDataFrame([("x", 437.0), ("y", 607.0), ("z", None), ("w", 437.0)], "campaign_name string, cpl double")
    r = R.best_vs_worst(df, "campaign_name", "cpl").first()
    assert (r.best, r.worst, r.entries) == ("w", "y", 3)
    assert r.gap_pct == 28.01


def test_bands(kpi1):
    got = {(r.campaign_name, r.metric): r.band for r in R.benchmark_bands(kpi1).collect()}
    assert got[("A", "CPC")] == "within" and got[("A", "CTR")] == "above" and got[("B", "CPL")] is None
    assert got[("A", "CPL")] == "below"


def test_currency(kpi1):
    got = {r.campaign_name: r.total_cost_display for r in R.currency(kpi1).collect()}
    assert got == {"A": "₹1,000", "B": "₹3,000", "C": "₹501"}
    assert all((r.average_cpl_display is None) == (r.total_leads == 0) for r in R.currency(kpi1).join(
        kpi1.select("campaign_name", "total_leads"), "campaign_name").collect())


@pytest.mark.parametrize("n", [0, 1, 2, 3, 15, 16])
def test_sizes_flags_truncation_markdown(spark, n):
    rows = [(f"g{i:02d}", "c", 10, 1, 100.0, float(i), 1.0) for i in range(n)]
    schema = ("ad_group_name string, campaign_name string, total_impressions long, total_clicks long, "
              "total_cost_inr double, ctr_pct double, avg_cpc_inr double")
    df = spark.createDataFrame(rows, schema)
    kpis = {"kpi_7_adgroup_efficiency": df}
    flag = R.sample_flags(kpis).first()
    assert flag.row_count == n
    assert flag.sample_flag == ("empty" if n == 0 else "limited" if n < 3 else "ok")
    t = R.truncate_for_report(df, "kpi_7_adgroup_efficiency").collect()
    assert len(t) == (10 if n > 15 else n)
    note = f"*(Showing top 10 of {n} total rows. Full data available in source system.)*"
    assert all(r.note == (note if n > 15 else None) for r in t)
    if n > 15:
        assert sorted(r.ctr_pct for r in t) == [float(i) for i in range(6, 16)] and all(r.truncated for r in t)
    md = R.markdown_lines(kpis).orderBy("line_no").collect()
    if n == 0:
        assert [r.line for r in md] == ["## KPI 7: Ad Group Efficiency", R.NO_DATA]
    else:
        assert [r.line_no for r in md] == list(range(1, n + 4))
        assert md[3].line.startswith(f"| g{n - 1:02d} |")  # ordered by ctr desc


def test_row_index_dense(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    out = with_row_index(df, [F.col("k")]).collect()
    assert sorted(r.row_no for r in out) == list(range(1, 1001))
    assert all(r.row_no == r.k + 1 for r in out)


@pytest.mark.parametrize("n", [20_000, 150_000, 2_000_000])
def test_row_index_dense_with_payload(spark, tmp_path, n):
    """Beyond the sample of the range bounds, with a wide payload that is written out."""
    df = spark.range(0, n, numPartitions=20).withColumn("k", F.xxhash64("id")).withColumn("text", F.concat(F.lit("row "), F.col("id")))
    with_row_index(df, [F.col("k"), F.col("id")]).write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    got = out.agg(F.count("*"), F.countDistinct("row_no"), F.max("row_no"), F.countDistinct("text")).first()
    assert tuple(got) == (n, n, n, n)
    ends = out.orderBy("row_no").select("k").limit(1000).collect()
    assert [r.k for r in ends] == [r.k for r in df.orderBy("k").limit(1000).collect()]


def test_markdown_at_size(spark, tmp_path):
    """20,003 lines of one KPI, numbered from 1 without gap, in its order."""
    df = spark.range(20_000).selectExpr("concat('g', lpad(id, 6, '0')) AS ad_group_name", "'c' AS campaign_name", "id AS total_impressions",
                                        "id AS total_clicks", "cast(id AS double) AS total_cost_inr", "cast(id % 977 AS double) AS ctr_pct",
                                        "1.0D AS avg_cpc_inr")
    R.markdown_lines({"kpi_7_adgroup_efficiency": df, "kpi_1_summary": spark.createDataFrame([], K1)}).write.parquet(str(tmp_path / "md"))
    md = spark.read.parquet(str(tmp_path / "md")).filter("kpi = 'kpi_7_adgroup_efficiency'")
    assert tuple(md.agg(F.count("*"), F.countDistinct("line_no"), F.max("line_no")).first()) == (20_003,) * 3
    want = df.orderBy(F.desc("ctr_pct"), "ad_group_name").select("ad_group_name").limit(50).collect()
    got = md.filter("line_no BETWEEN 4 AND 53").orderBy("line_no").collect()
    assert [r.line.split(" | ")[0] for r in got] == [f"| {r.ad_group_name}" for r in want]


def test_markdown_names_failed_kpis(spark, kpi1):
    md = R.markdown_lines({"kpi_1_summary": kpi1}, {"kpi_2_cpl_ranking": "no such\ntable"}).filter("kpi = 'kpi_2_cpl_ranking'")
    assert [r.line for r in md.orderBy("line_no").collect()] == [
        "## KPI 2: Campaign Performance Ranking by CPL", "Error fetching data: no such table"]
    assert R.markdown_lines({}, {"kpi_1_summary": "gone"}).count() == 2


def test_complete_kpis_not_truncated(spark):
    df = spark.range(0, 20).selectExpr("2024 as year", "cast(id as int) as month")
    t = R.truncate_for_report(df, "kpi_6_monthly_trend")
    assert t.count() == 20


def test_pack_records_unreadable_tables(spark):
    """RPT-1 over saved tables: a missing KPI table is reported as an error row, not raised."""
    from adlake.operators.kpi import KPI_NAMES
    from adlake.plans.catalog import save_layer

    rows = [("A", "ENABLED", 1.0, 1, 1, 1.0, 1.0, 1.0, 100.0, 100.0)]
    save_layer(spark, "t_pack", {"kpi_1_summary": spark.createDataFrame(rows, K1),
                                 "kpi_2_cpl_ranking": spark.createDataFrame([], "campaign_name string")})
    frames, errors = R.kpi_frames_from_catalog(spark, "t_pack")
    assert set(frames) == {"kpi_1_summary", "kpi_2_cpl_ranking"} and set(errors) == set(KPI_NAMES) - set(frames)
    pack = {r.kpi: r for r in R.report_pack(frames, errors).collect()}
    assert pack["kpi_1_summary"].status == "ok" and pack["kpi_1_summary"].row_count == 1
    assert pack["kpi_2_cpl_ranking"].status == "empty"
    assert pack["kpi_9_day_of_week"].status == "error" and pack["kpi_9_day_of_week"].error
    assert [r.kpi_no for r in R.report_pack(frames, errors).orderBy("kpi_no").collect()] == list(range(1, 11))


def test_pack_survives_a_damaged_file(spark):
    """A KPI table whose file is damaged is found out when it is read, and is an error row."""
    from adlake.plans.catalog import save_layer

    rows = [("A", "ENABLED", 1.0, 1, 1, 1.0, 1.0, 1.0, 100.0, 100.0)]
    save_layer(spark, "t_damaged", {"kpi_1_summary": spark.createDataFrame(rows, K1), "kpi_5_gender_performance": spark.range(3)})
    damage(spark, "t_damaged", "kpi_5_gender_performance")
    frames, errors = R.kpi_frames_from_catalog(spark, "t_damaged")
    assert set(frames) == {"kpi_1_summary"} and "kpi_5_gender_performance" in errors
    assert {r.kpi: r.status for r in R.report_pack(frames, errors).collect()}["kpi_5_gender_performance"] == "error"


def damage(spark, db, table):
    """Overwrite the table's Parquet files with junk."""
    import glob
    import os

    base = spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:")
    files = glob.glob(os.path.join(base, f"{db}.db", table, "*.parquet"))
    assert files
    for f in files:
        with open(f, "wb") as out:
            out.write(b"junk" * 50)
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    spark.catalog.refreshTable(f"{db}.{table}")


def test_pack_when_no_kpi_table_is_readable(spark):
    pack = R.report_pack({}, {"kpi_1_summary": "missing"}).collect()
    assert [(r.kpi, r.status) for r in pack] == [("kpi_1_summary", "error")]
