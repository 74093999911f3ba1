"""Scalar and aggregate metric builders (SC-*, AGG-2, MET-1) on literal edge frames."""

from pyspark.sql import functions as F

from adlake.functions import metrics as m


def test_guarded_rates_edge_rows(spark):
    rows = [(0, 0, 0.0), (0, 1, 0.0), (10, 0, 0.0), (10, 5, 1.0)]
    df = spark.createDataFrame(rows, "imp long, clk long, conv double")
    out = df.select(
        m.guarded_pct("clk", "imp").alias("ctr"), m.guarded_pct("conv", "clk").alias("cvr"),
        m.guarded_ratio("conv", "clk").alias("r"),
    ).collect()
    assert [r.ctr for r in out] == [0.0, 0.0, 0.0, 50.0]
    assert [r.cvr for r in out] == [0.0, 0.0, 0.0, 20.0]
    assert [r.r for r in out] == [0.0, 0.0, 0.0, 0.2]
    assert dict(df.select(m.guarded_pct("clk", "imp").alias("c")).dtypes)["c"] == "double"


def test_ratio_of_sums_null_on_zero(spark):
    df = spark.createDataFrame([(0, 0), (4, 1)], "a long, b long")
    r = df.select(m.ratio_of_sums(F.col("b"), F.col("a"), 100).alias("x")).collect()
    assert r[0].x is None and r[1].x == 25.0


def test_micros_pct_lost_cpm(spark):
    df = spark.createDataFrame([(2500000, 0.25, 1500, 2000000.0)], "c long, s double, i long, cpm double")
    r = df.select(m.micros("c").alias("a"), m.pct("s").alias("b"), m.lost_pct("s").alias("l"),
                  m.cpm_cost("i", m.micros_sql("cpm")).alias("t")).first()
    assert (r.a, r.b, r.l, r.t) == (2.5, 25.0, 75.0, 3.0)


def test_day_part_hours(spark):
    hours = [None, 0, 5, 6, 11, 12, 17, 18, 23]
    df = spark.createDataFrame([(h,) for h in hours], "h int").fillna(0)
    got = [r.p for r in df.select(m.day_part("h").alias("p")).collect()]
    assert got == ["Night", "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening", "Evening"]


def test_regex_captures(spark):
    urls = ["https://a.com/x", "http://a.com", "['https://a.com']", "Unknown", "", None]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r.h for r in df.select(m.url_host("u").alias("h")).collect()] == ["a.com", "a.com", "a.com']", "", "", None]
    names = ["customers/1/adGroupCriteria/22~33", "customers/1/adGroupCriteria/22", "Unknown", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.c for r in df.select(m.criterion_id("n").alias("c")).collect()] == ["33", "", "", None]
    df = spark.createDataFrame([("geoTargetConstants/1007",), ("Unknown",)], "n string")
    assert [r.c for r in df.select(m.trailing_id("n").alias("c")).collect()] == ["1007", ""]


def test_age_label_and_weekday(spark):
    ages = ["AGE_RANGE_18_24", "AGE_RANGE_65_UP", "AGE_RANGE_UNDETERMINED", "Unknown"]
    df = spark.createDataFrame([(a,) for a in ages], "a string")
    assert [r.x for r in df.select(m.age_label("a").alias("x")).collect()] == ["18-24", "65-UP", "UNDETERMINED", "Unknown"]
    df = spark.createDataFrame([(i,) for i in range(0, 9)], "d int")
    names = [r.n for r in df.select(m.weekday_name("d").alias("n")).collect()]
    assert names == [None, "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", None]


def test_money_sum_is_exact(spark):
    vals = [0.1, 0.2, 0.3] * 1000
    df = spark.createDataFrame([(v,) for v in vals], "c double").repartition(7)
    assert df.select(m.money_sum("c").alias("s")).first().s == 600.0
