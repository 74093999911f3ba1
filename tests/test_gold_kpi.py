"""Gold builders and KPI invariants over the sf0.001 fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from adlake.operators import gold as G
from adlake.operators import kpi as K
from adlake.plans.pipeline import Lakehouse

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def lake(spark):
    return Lakehouse.from_fixtures(spark, SF_SMALL)


def test_dims_unique_on_keys(lake):
    for dim, pk in [("dim_campaign", "campaign_pk"), ("dim_ad_group", "ad_group_pk"), ("dim_ad", "ad_pk"),
                    ("dim_keyword", "keyword_pk"), ("dim_age_range", "age_range_pk"), ("dim_gender", "gender_pk"),
                    ("dim_network", "network_pk"), ("dim_date", "date_key")]:
        df = lake.gold[dim]
        assert df.count() == df.select(pk).distinct().count(), dim
    ag = lake.gold["dim_ad_group"]
    assert ag.count() == ag.select("ad_group_id").distinct().count()  # KPI 10 joins on the natural key


def test_fact_keys_exist_in_dims(lake):
    pairs = [("fact_campaign_perf", "dim_campaign", "campaign_pk"), ("fact_campaign_perf", "dim_date", "date_key"),
             ("fact_keyword_perf", "dim_keyword", "keyword_pk"), ("fact_keyword_perf", "dim_ad_group", "ad_group_pk"),
             ("fact_age_perf", "dim_age_range", "age_range_pk"), ("fact_gender_perf", "dim_gender", "gender_pk"),
             ("fact_campaign_network_perf", "dim_network", "network_pk")]
    for fact, dim, k in pairs:
        assert lake.gold[fact].join(lake.gold[dim], k, "left_anti").count() == 0, (fact, dim)


def test_fact_campaign_perf_preserves_totals(lake):
    s, f = lake.silver, lake.gold["fact_campaign_perf"]
    days = [s[t].select("campaign_id", "segments_date") for t in ("campaigns", "conversions")]
    assert f.count() == days[0].union(days[1]).distinct().count() > days[0].distinct().count()
    a = s["campaigns"].agg(F.sum("metrics_clicks")).first()[0]
    assert f.agg(F.sum("clicks")).first()[0] == a
    # conversions are all kept, also on days and for campaigns without a campaign row, none duplicated
    conv = s["conversions"].agg(F.sum("conversions")).first()[0]
    assert f.agg(F.sum("conversions")).first()[0] == conv > 0
    for k, leads in (("kpi_1_summary", "total_leads"), ("kpi_6_monthly_trend", "monthly_leads"), ("kpi_9_day_of_week", "total_leads")):
        assert lake.kpis[k].agg(F.sum(leads)).first()[0] == conv, k
    revenue = s["conversions"].agg(F.sum("conversions_value")).first()[0]
    assert abs(lake.roas().agg(F.sum("total_conversions_value")).first()[0] - revenue) < 0.5


def test_branches_of_the_kpis_have_rows_on_both_sides(lake):
    """HAVING drops a campaign, a campaign has no conversion, there are months of two years."""
    one, two = lake.kpis["kpi_1_summary"], lake.kpis["kpi_2_cpl_ranking"]
    assert one.count() > two.count() > 0
    assert 0 < one.filter("total_impressions > 0 AND total_leads = 0").count() < one.count()
    months = lake.kpis["kpi_6_monthly_trend"].collect()
    assert len({r.year for r in months}) == 2 and len(months) > 5


@pytest.mark.parametrize("name", list(K.KPI_NAMES))
def test_kpi_order(lake, name):
    """SRT-1, SRT-2: the rows come in the KPI's own order (nulls last where it falls, first where it rises)."""
    from adlake.operators.report import KPI_ORDER

    rows = [r.asDict() for r in lake.kpis[name].collect()]

    def before(a, b):
        for c, desc in KPI_ORDER[name]:
            x, y = a[c], b[c]
            if x == y:
                continue
            if x is None or y is None:
                return (x is None) != desc
            return x > y if desc else x < y
        return True

    assert len(rows) > 1 and all(before(a, b) for a, b in zip(rows, rows[1:]))


def test_dim_campaign_latest_row(spark):
    rows = [("1", dt.date(2024, 1, 1), "old", "ENABLED", "SEARCH"), ("1", dt.date(2024, 1, 3), "new", "PAUSED", "SEARCH"),
            ("1", dt.date(2024, 1, 2), "mid", "ENABLED", "SEARCH")]
    df = spark.createDataFrame(rows, "campaign_id string, segments_date date, campaign_name string, "
                                     "campaign_status string, campaign_advertising_channel_type string")
    r = G.dim_campaign(df).collect()
    assert len(r) == 1 and r[0].campaign_name == "new" and r[0].campaign_status == "PAUSED"


def test_surrogate_key_null_is_not_merged(spark):
    from adlake.functions.keys import surrogate_key

    df = spark.createDataFrame([(None, "a"), ("a", None), ("Unknown", "a")], "x string, y string")
    keys = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert keys[0] != keys[1] and keys[0] == keys[2]


def test_kpi_totals_agree(lake):
    k = lake.kpis
    k1 = k["kpi_1_summary"].agg(F.sum("total_leads"), F.sum("total_clicks")).first()
    k6 = k["kpi_6_monthly_trend"].agg(F.sum("monthly_leads")).first()[0]
    k9 = k["kpi_9_day_of_week"].agg(F.sum("total_leads"), F.sum("total_clicks")).first()
    assert k1[0] == k6 == k9[0] and k1[1] == k9[1]
    f = lake.gold["fact_campaign_perf"].agg(F.sum("clicks")).first()[0]
    assert k1[1] == f


def test_kpi3_topk_and_filter(lake):
    r = lake.kpis["kpi_3_top_keywords"].collect()
    assert len(r) <= K.TOP_KEYWORDS_K
    assert all(x.total_clicks > 0 for x in r)
    clicks = [x.total_clicks for x in r]
    assert clicks == sorted(clicks, reverse=True)


def test_kpi2_having(lake):
    assert lake.kpis["kpi_2_cpl_ranking"].filter("total_leads <= 0").count() == 0


def test_kpi6_multi_month_order(spark):
    fact = spark.createDataFrame(
        [("p", 20231231, 1, 1, 1.5, 1.0, 0.0), ("p", 20240101, 1, 1, 2.5, 0.0, 0.0), ("p", 20240201, 1, 1, 1.0, 2.0, 0.0)],
        "campaign_pk string, date_key int, impressions long, clicks long, cost_inr double, conversions double, "
        "conversions_value double")
    dates = G.dim_date(spark.createDataFrame(
        [(dt.date(2023, 12, 31),), (dt.date(2024, 1, 1),), (dt.date(2024, 2, 1),), (None,)], "segments_date date"))
    assert dates.count() == 3
    out = K.kpi_6_monthly_trend({"fact_campaign_perf": fact, "dim_date": dates}).collect()
    assert [(r.year, r.month) for r in out] == [(2023, 12), (2024, 1), (2024, 2)]
    assert out[1].monthly_cpl_inr is None and out[0].monthly_cpl_inr == 1.5  # NULLIF: null, not 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpi_plans_aggregate_before_join(lake):
    """Every KPI aggregates its fact to the dimension key before joining; no broadcast hint on a dimension."""
    for name in K.KPI_NAMES:
        opt = lake.kpis[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "broadcast" not in opt.lower(), name
        phys = _plan(lake.kpis[name])
        assert "partial_sum" in phys or "partial_count" in phys, name  # map-side combine before the shuffle
    p1 = lake.kpis["kpi_1_summary"]._jdf.queryExecution().optimizedPlan().toString()
    # the first aggregate (per campaign_pk) sits below the join with dim_campaign
    assert p1.index("Join") < p1.rindex("Aggregate [campaign_pk")


def test_hot_key_is_combined_map_side(spark):
    """One campaign holding most rows: results stay exact and the fact is combined before any exchange."""
    rows = [("hot", 20240101 + (i % 3), 1, 1, 0.5, 1.0, 0.0) for i in range(3000)]
    rows += [(f"c{i}", 20240101, 2, 1, 1.0, 0.0, 0.0) for i in range(100)]
    fact = spark.createDataFrame(rows, "campaign_pk string, date_key int, impressions long, clicks long, "
                                       "cost_inr double, conversions double, conversions_value double")
    fact = fact.repartition(8)
    dim = spark.createDataFrame([("hot", "H", "ENABLED")] + [(f"c{i}", f"C{i}", "PAUSED") for i in range(100)],
                                "campaign_pk string, campaign_name string, campaign_status string")
    out = K.kpi_1_summary({"fact_campaign_perf": fact, "dim_campaign": dim})
    got = {r.campaign_name: r for r in out.collect()}
    assert got["H"].total_clicks == 3000 and got["H"].total_cost_inr == 1500.0 and got["C7"].total_impressions == 2
    phys = _plan(out)
    assert phys.index("partial_sum") > phys.index("Exchange")  # partial agg is below (after, in text) the exchange


def test_metric_roas(lake):
    r = lake.roas().collect()
    assert len(r) == lake.gold["dim_campaign"].count()
    assert all(x.roas is None or x.roas >= 0 for x in r)
