"""Property tests: metric builders against plain-Python formulas on random rows."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlake.functions import metrics as m

longs = st.one_of(st.none(), st.integers(min_value=0, max_value=10**9))
hours = st.one_of(st.none(), st.integers(min_value=-2, max_value=30))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(longs, longs, longs), min_size=1, max_size=40))
def test_guarded_and_aggregate_rates(spark, rows):
    df = spark.createDataFrame(rows, "imp long, clk long, cost long")
    got = df.select(
        m.guarded_pct("clk", "imp").alias("ctr"),
        m.guarded_ratio(m.micros_sql("cost"), "clk").alias("cpc"),
    ).collect()
    for (imp, clk, cost), r in zip(rows, got):
        exp_ctr = clk / imp * 100 if imp is not None and imp > 0 and clk is not None else (
            None if imp is not None and imp > 0 else 0.0)
        assert (r.ctr is None and exp_ctr is None) or math.isclose(r.ctr, exp_ctr)
        if clk is not None and clk > 0:
            assert (r.cpc is None) == (cost is None)
        else:
            assert r.cpc == 0.0
    agg = df.agg(m.ctr(F.sum("clk"), F.sum("imp")).alias("ctr")).first().ctr
    si = sum(r[0] for r in rows if r[0] is not None)
    sc = sum(r[1] for r in rows if r[1] is not None)
    has_i = any(r[0] is not None for r in rows)
    if not has_i or si == 0:
        assert agg is None
    elif any(r[1] is not None for r in rows):
        assert abs(agg - sc / si * 100) <= 0.005 + 1e-9


@settings(max_examples=10, deadline=None)
@given(st.lists(hours, min_size=1, max_size=30))
def test_day_part_total(spark, hs):
    df = spark.createDataFrame([(h,) for h in hs], "h int")
    got = [r.p for r in df.select(m.day_part("h").alias("p")).collect()]
    for h, p in zip(hs, got):
        exp = ("Morning" if h is not None and 6 <= h <= 11 else "Afternoon" if h is not None and 12 <= h <= 17
               else "Evening" if h is not None and 18 <= h <= 23 else "Night")
        assert p == exp


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10**12), min_size=1, max_size=50), st.integers(1, 6))
def test_money_sum_order_independent(spark, micros_vals, parts):
    df = spark.createDataFrame([(v / 1e6,) for v in micros_vals], "c double")
    a = df.repartition(parts).select(m.money_sum("c").alias("s")).first().s
    b = df.coalesce(1).select(m.money_sum("c").alias("s")).first().s
    assert a == b  # identical whatever the partitioning
    assert math.isclose(a, sum(micros_vals) / 1e6, rel_tol=1e-15)
