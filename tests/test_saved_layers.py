"""Saves that keep the old table, outcomes, audits of damaged layers, facts by month, CSV quarantine and multi-line fields."""

import os
import re
import tempfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlake.functions.keys import surrogate_key, surrogate_key_sql
from adlake.operators.gold import DIMS, FACTS, in_period
from adlake.operators.kpi import KPI_NAMES, kpi
from adlake.plans import catalog as C
from adlake.plans.pipeline import Lakehouse, run
from adlake.sources import bronze as B
from adlake.sources.fixtures import bronze_frame
from adlake.streaming.landing import land_csv_incremental

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def stars(spark):
    """Gold tables saved with facts by month."""
    outcomes = run(spark, Lakehouse.from_fixtures(spark, SF_SMALL).bronze, "m_silver", "m_gold", "m_analytics", facts_by_month=True, reports=())
    assert outcomes.where("status <> 'ok'").count() == 0 and outcomes.count() == 22 + 13 + 10
    return {n: spark.table(f"m_gold.{n}") for n in DIMS + FACTS}


def failing(df):
    return df.select(F.raise_error(F.lit("no more")).cast("bigint").alias("x"), F.lit("p").alias("k"))


def folder(spark, table):
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")


def test_failed_save_keeps_the_old_table(spark):
    C.create_database(spark, "sw")
    C.save_table(spark.range(4).withColumnRenamed("id", "x"), "sw.t")
    before = set(os.listdir(os.path.dirname(folder(spark, "sw.t"))))
    for partition in (None, ["k"]):
        with pytest.raises(Exception, match="no more"):
            C.save_table(failing(spark.range(4)), "sw.t", partition_by=partition)
        assert C.list_tables(spark, "sw") == ["t"] and spark.table("sw.t").count() == 4 and C.list_columns(spark, "sw.t") == ["x"]
    assert set(os.listdir(os.path.dirname(folder(spark, "sw.t")))) == before  # nothing of the failed saves stays
    C.save_table(spark.range(6).selectExpr("id AS `a.b`", "id % 3 AS k", "'v' AS z"), "sw.t", partition_by=["k"])
    assert C.list_columns(spark, "sw.t") == ["a.b", "z", "k"] and spark.table("sw.t").where("k = 1").count() == 2
    C.save_table(spark.table("sw.t").where("k = 1"), "sw.t", partition_by=["k"])  # reads the table that it replaces
    assert [r.k for r in spark.table("sw.t").collect()] == [1, 1]
    C.save_table(spark.table("sw.t").limit(0), "sw.t")
    assert spark.table("sw.t").count() == 0


def test_a_swap_that_was_cut_short_is_mended(spark):
    C.create_database(spark, "cut")
    C.save_table(spark.range(4), "cut.t")
    spark.sql(f"ALTER TABLE cut.t RENAME TO cut.t{C.REPLACED}")  # the driver was lost between both renames
    assert C.list_tables(spark, "cut") == []
    C.restore_table(spark, "cut.t")
    assert C.list_tables(spark, "cut") == ["t"] and spark.table("cut.t").count() == 4
    C.save_table(spark.range(5), f"cut.t{C.REPLACED}")  # lost before the old table was dropped
    C.save_table(spark.range(6), "cut.t")
    assert spark.table("cut.t").count() == 6 and not spark.catalog.tableExists(f"cut.t{C.REPLACED}")


def test_a_failed_renaming_gives_the_name_back(spark):
    C.create_database(spark, "ren")
    C.save_table(spark.range(4), "ren.t")
    with pytest.raises(Exception):  # noqa: B017, PT011 - no such staged table
        C.swap_table(spark, "ren.nothing", "ren.t")
    assert spark.table("ren.t").count() == 4


def test_causes(spark):
    got = C.save_tables("sw", {"a": spark.range(1), "b": failing(spark.range(1)), "c": spark.range(1).selectExpr("id", "id AS ID")},
                        ["a", "b", "c", "d"], {"d": ("missing_input", "needs bronze x")})
    assert [o[:3] for o in got] == [("a", "ok", None), ("b", "error", "execution"), ("c", "error", "analysis"), ("d", "skipped", "missing_input")]


def test_audit_counts_each_table_once(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    C.save_layer(spark, "au", {f"t{k}": spark.range(k) for k in range(4)})
    counted, plain = [], DataFrame.count
    monkeypatch.setattr(DataFrame, "count", lambda self: counted.append(1) or plain(self))
    got = {r.table_name: (r.row_count, r.status) for r in C.audit(spark, "au", ["t0", "t3", "gone"]).collect()}
    assert got == {"t0": (0, "ok"), "t3": (3, "ok"), "gone": (None, "missing"), "__total__": (3, "total")} and len(counted) == 2
    C.create_database(spark, "au_empty")
    assert [tuple(r) for r in C.audit(spark, "au_empty").collect()] == [("__total__", 0, None, "0", "total")]


def plan_of(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_files(df, table):
    """Files that a plan's scans of a table read, by their metrics."""
    df.collect()
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        if node.nodeName().startswith("Scan ") and node.nodeName().endswith(f".{table}"):
            found.append(node.metrics().apply("numFiles").value())
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    return found


def test_one_month_reads_its_own_files(spark, stars):
    for name, fact in (("kpi_1_summary", "fact_campaign_perf"), ("kpi_3_top_keywords", "fact_keyword_perf"), ("kpi_9_day_of_week", "fact_campaign_perf")):
        filled = stars[fact].where("clicks > 0").agg(F.max("month_key"), F.countDistinct("month_key")).first()
        last, months = filled
        one, every = kpi(name, in_period(stars, f"year = {last // 100} AND month = {last % 100}")), kpi(name, stars)
        assert "dynamicpruning" in plan_of(one) and months > 5
        few, whole = scanned_files(one, fact), scanned_files(every, fact)
        assert len(few) == len(whole) == 1 and few[0] * (months - 1) <= whole[0], (few, whole, months)


def test_periods_add_up(spark, stars):
    """The months' sums are the whole's, and unpartitioned facts give the same rows."""
    whole = kpi("kpi_6_monthly_trend", stars).collect()
    for r in whole[:3]:
        part = kpi("kpi_6_monthly_trend", in_period(stars, f"year = {r.year} AND month = {r.month}")).collect()
        assert part == [r]
    plain = {n: df.drop("month_key") for n, df in stars.items()}
    for name in KPI_NAMES:
        same = [sorted(map(str, kpi(name, in_period(g, "month < 4")).collect())) for g in (stars, plain)]
        assert same[0] == same[1]
    assert kpi("kpi_1_summary", in_period(stars, "year = 1900")).count() == 0


def test_kpi_tables_are_replaced(spark, stars):
    for rows in (1, 10**6):
        C.save_layer(spark, "again", {k: kpi(k, stars).limit(rows) for k in KPI_NAMES})
    for k in KPI_NAMES:
        assert sorted(map(str, spark.table(f"again.{k}").collect())) == sorted(map(str, kpi(k, stars).collect()))


# -- CSV

TYPED = "id INT, text STRING, n BIGINT"


def files(spark, texts):
    base = tempfile.mkdtemp(prefix="adlake-csv-")
    for k, text in enumerate(texts):
        os.makedirs(f"{base}/in", exist_ok=True)
        with open(f"{base}/in/f{k}.csv", "w", newline="") as f:
            f.write(text)
    return base


BAD = 'id,text,n\n1,x,5\nbad,y,6\n2,short\n3,long,7,8\n4,"two\nlines",9\n'


def test_batch_and_incremental_landing_agree(spark):
    """Neither turns a record that does not fit into nulls; with quarantine both keep it as text."""
    base = files(spark, [BAD])
    with pytest.raises(Exception, match=r"(?i)malformed"):
        B.land_csv(spark, f"{base}/in", f"{base}/b", TYPED, multiline=True)
    with pytest.raises(Exception, match="STREAM_FAILED"):
        land_csv_incremental(spark, f"{base}/in", f"{base}/s", f"{base}/ck", TYPED, multiline=True)
    assert not any(f.endswith(".parquet") for _, _, names in os.walk(f"{base}/s") for f in names)
    want = {(1, "x", 5), (4, "two\nlines", 9)}
    good, bad = B.land_csv_quarantine(spark, f"{base}/in", f"{base}/q", TYPED, multiline=True)
    land_csv_incremental(spark, f"{base}/in", f"{base}/sq", f"{base}/ckq", TYPED, multiline=True, quarantine=True)
    for accepted, rejected in ((good, bad), B.landed(spark, f"{base}/sq", TYPED)):
        assert {tuple(r) for r in accepted.collect()} == want and accepted.columns == ["id", "text", "n"]
        assert sorted(r.record.strip() for r in rejected.collect()) == ["2,short", "3,long,7,8", "bad,y,6"]
        assert {r.source_file for r in rejected.collect()} == {"f0.csv"}


def test_quarantine_of_nothing_and_of_all(spark):
    base = files(spark, ["id,text,n\n1,,\n2,\"\",3\n"])
    good, bad = B.land_csv_quarantine(spark, f"{base}/in", f"{base}/q", TYPED, rfc=True)
    assert {tuple(r) for r in good.collect()} == {(1, None, None), (2, "", 3)} and bad.count() == 0
    good, bad = B.land_csv_quarantine(spark, files(spark, ["id,text,n\nx,a,1\n"]) + "/in", f"{base}/q", TYPED)
    assert good.count() == 0 and [r.record for r in bad.collect()] == ["x,a,1"]
    again = B.land_csv_quarantine(spark, f"{base}/in", f"{base}/q", TYPED)  # replaces both folders
    assert [d.count() for d in again] == [2, 0]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet='a",;\\\n é日\t \'', max_size=12)), min_size=1, max_size=20))
def test_csv_round_trip(spark, texts):
    base = tempfile.mkdtemp(prefix="adlake-rt-")
    rows = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], TYPED)
    B.write_csv(rows, f"{base}/csv")
    got = {r.id: r.text for r in B.land_csv(spark, f"{base}/csv", f"{base}/b", TYPED, multiline=True, rfc=True).collect()}
    assert got == dict(enumerate(texts))


# -- contract and keys

def test_contract_rows(spark):
    C.save_layer(spark, "con", {"asset": bronze_frame(spark, SF_SMALL, "asset").withColumn("more", F.lit(1))})
    got = {r.table_name: r for r in B.check_bronze(spark, "con").collect()}
    assert len(got) == 22 and got["asset"].surplus == "more" and got["asset"].status == "differs" and got["ads_data"].status == "missing"
    measured = B.measure_bronze({"t": spark.createDataFrame([("ab", None), (None, 1)], "`a.x` string, b int")}).first()
    assert (measured.row_count, measured.null_cells, measured.text_chars) == (2, 2, 2)


PART = st.one_of(st.none(), st.text(alphabet="a~\\bU", max_size=4))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(PART, PART, PART), min_size=2, max_size=60, unique=True))
def test_keys_are_injective(spark, rows):
    rows = [*rows, ("a~b", "c", "d"), ("a", "b~c", "d"), ("a\\", "~c", "d"), ("a", "\\~c", "d"), ("a\\~", "c", "d")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    got = df.select(surrogate_key("x", "y", "z").alias("k"), F.expr(surrogate_key_sql("x", "y", "z")).alias("s")).collect()
    known = {tuple("Unknown" if v is None else v for v in r) for r in rows}
    assert len({r.k for r in got}) == len(known) and all(r.k == r.s for r in got)
    assert all(re.fullmatch("[0-9a-f]{32}", r.k) for r in got)


# -- command line and shared folder

def test_cli_with_rejects_contract_and_months(spark, capsys):
    from adlake.__main__ import main

    base = tempfile.mkdtemp(prefix="adlake-cli2-")
    for name in ("network_performance", "ads_data"):
        B.write_csv(bronze_frame(spark, SF_SMALL, name), os.path.join(base, name))
    with open(f"{base}/network_performance/more.csv", "w") as f:
        f.write(",".join(f.name for f in B.declared(B.BRONZE_DDL["network_performance"])) + "\nno date,1,c,SEARCH,1,2,3.0\n")
    main(["land", "--csv", base, "--bronze-db", "c2_bronze", "--rfc", "--rejects-db", "c2_rejects"])
    assert spark.table("c2_rejects.network_performance").first().record == "no date,1,c,SEARCH,1,2,3.0"
    assert spark.table("c2_rejects.ads_data").count() == 0
    for name in ("network_performance", "ads_data"):
        assert spark.table(f"c2_bronze.{name}").count() == bronze_frame(spark, SF_SMALL, name).count()
    main(["check", "--bronze-db", "c2_bronze"])
    assert "missing" in capsys.readouterr().out
    main(["run", "--bronze-db", "c2_bronze", "--silver-db", "c2_s", "--gold-db", "c2_g", "--analytics-db", "c2_a", "--facts-by-month"])
    assert [c.name for c in spark.catalog.listColumns("c2_g.fact_campaign_network_perf") if c.isPartition] == ["month_key"]
    main(["audit", "--db", "c2_g", "--expect", "gold"])
    out = capsys.readouterr().out
    assert "missing_input" in out and "ERROR: no such table" in out


def test_clear_shared(spark):
    from adlake import session

    kept = list(session._MADE)
    session._MADE.clear()
    path = session.shared_dir(spark, "clear")
    spark.range(3).write.parquet(path)
    assert session.clear_shared(spark) == 1 and session.clear_shared(spark) == 0
    assert not os.path.exists(path.removeprefix("file:"))
    session._MADE.extend(kept)
