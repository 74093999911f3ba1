"""PRJ-1..PRJ-8 and the fill traps T1-T3, T21 via apply_spec."""

import math

import pytest

from adlake.functions.names import flatten_names
from adlake.operators.clean import MissingColumnsError, apply_spec
from adlake.operators.spec import SPEC_BY_SILVER, SPECS, TableSpec


def test_flatten_and_collapse(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `a.b.c` int, `a__b` int")
    assert flatten_names(df).columns == ["a_b", "a_b_c", "a__b"]
    assert flatten_names(df.select("`a.b`", "`a.b.c`"), collapse=True).columns == ["a_b", "a_b_c"]
    df2 = spark.createDataFrame([(1, 2)], "`x.__y` int, z int")
    assert flatten_names(df2, collapse=True).columns == ["x__y", "z"]


def test_flatten_collision_rejected(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, a_b int")
    with pytest.raises(ValueError, match="collide"):
        flatten_names(df)


def test_fill_semantics(spark):
    spec = TableSpec(silver="t", bronze="t", num_fill=("n", "d", "s_num"), str_fill=("s", "i", "b"))
    df = spark.createDataFrame(
        [(None, float("nan"), None, None, None, None), (3, 1.5, 7, "x", 5, True)],
        "n long, d double, s_num long, s string, i long, b boolean",
    )
    out = apply_spec(df, spec).collect()
    assert out[0].n == 0 and out[0].d == 0.0 and out[0].s_num == 0  # T1: NaN filled too
    assert out[0].s == "Unknown"
    assert out[0].i is None and out[0].b is None  # T3: string fill skips bigint / boolean
    assert out[1].n == 3 and out[1].d == 1.5 and out[1].s == "x"


def test_missing_columns_listed(spark):
    spec = SPEC_BY_SILVER["campaigns"]
    df = spark.createDataFrame([(1,)], "`campaign.id` long")
    with pytest.raises(MissingColumnsError) as e:
        apply_spec(df, spec)
    assert "metrics_ctr" in str(e.value) and "metrics_average_cpc" in str(e.value)  # T21 columns are required


def test_campaign_spec_row(spark):
    spec = SPEC_BY_SILVER["campaigns"]
    cols = ("`campaign.id` string, `segments.date` date, `campaign.name` string, `campaign.status` string, "
            "`campaign.advertising_channel_type` string, `metrics.impressions` long, `metrics.clicks` long, "
            "`metrics.ctr` double, `metrics.cost_micros` long, `metrics.average_cpc` double")
    import datetime as dt

    df = spark.createDataFrame(
        [("1", dt.date(2024, 1, 1), None, "ENABLED", "SEARCH", 10, 5, None, 2500000, None),
         (None, dt.date(2024, 1, 2), "c", "PAUSED", None, None, 3, 0.1, 300000, 1.0)], cols)
    out = apply_spec(df, spec).orderBy("segments_date").collect()
    assert out[0].campaign_name == "Unknown" and out[0].ctr_pct == 50.0 and out[0].cost_inr == 2.5
    assert out[0].cpc_inr == 0.5
    assert out[1].campaign_id == "Unknown" and out[1].metrics_impressions == 0 and out[1].ctr_pct == 0.0  # T4
    assert apply_spec(df, spec).columns == [
        "campaign_id", "segments_date", "campaign_name", "campaign_status", "campaign_advertising_channel_type",
        "metrics_impressions", "metrics_clicks", "ctr_pct", "cpc_inr", "cost_inr"]


def test_every_spec_is_consistent():
    assert len(SPECS) == 22
    for s in SPECS:
        names = s.derived_names()
        for src, _ in s.output_pairs() or []:
            assert src in names or src in s.required_columns()
        aliases = [a for _, a in s.output_pairs() or []]
        assert len(aliases) == len(set(aliases)), s.silver


def test_impression_share_lost_is_100_on_null(spark):
    spec = SPEC_BY_SILVER["impressions"]
    df = spark.createDataFrame(
        [(None, None, None, None, None, None)],
        "`segments.date` date, `campaign.id` string, `campaign.name` string, `metrics.search_impression_share` double,"
        " `metrics.search_top_impression_share` double, `metrics.search_absolute_top_impression_share` double")
    r = apply_spec(df, spec).first()
    assert r.lost_impression_share_pct == 100.0 and r.impression_share_pct == 0.0  # T6


def test_display_ads_not_scaled(spark):
    spec = SPEC_BY_SILVER["display_ads"]
    df = spark.createDataFrame(
        [(None, "c", "g", 2000, 0.5, 0.25, 3000000.0)],
        "`segments.date` date, `campaign.name` string, `ad_group.name` string, "
        "`metrics.active_view_impressions` long, `metrics.active_view_measurability` double, "
        "`metrics.active_view_viewability` double, `metrics.active_view_cpm` double")
    r = apply_spec(df, spec).first()
    assert r.measurability_pct == 0.5 and r.viewability_pct == 0.25  # T11: renamed only
    assert r.cpm == 3.0 and math.isclose(r.total_cost, 6.0)


def test_plan_is_narrow_and_pruned(spark):
    from adlake.sources.fixtures import bronze_frame

    df = apply_spec(bronze_frame(spark, "/root/testdata/sf0.001", "optimization_device_and_time"),
                    SPEC_BY_SILVER["devices"]).select("device", "ctr_pct")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan
    assert df.count() == 1000
