"""Ads-shaped bronze tables derived from the supplied test tables.

The supplied data (``events``, ``part``, ``pages``, ``documents``, ``customer``,
``supplier``, ``nation``, ``region``) is not advertising data, so every bronze
report table is a deterministic SQL projection of it.  One SQL text per table
serves both engines: Spark reads the parquet files directly
(``parquet.`path```) and DuckDB reads its pre-registered views; only table
references, identifier quotes and the day-of-week base differ.

Every fixture scales with its source tables: no row caps, samples or filters
other than the semantic ones (conversion rows are purchase events).
Nulls are injected by key modulus so that the fill rules are exercised.
Bronze column names keep the report API's dotted form (``metrics.clicks``).
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from adlake.operators.layer import LazyLayer


SOURCE_TABLES = ("events", "part", "pages", "documents", "customer", "supplier", "nation", "region")


def source_view(sf_dir: str, table: str) -> str:
    """Session view name of one supplied table of one data folder."""
    return f"adlake_src_{hashlib.md5(sf_dir.rstrip('/').encode()).hexdigest()[:10]}_{table}"


def register_sources(spark: SparkSession, sf_dir: str) -> None:
    """Resolve each supplied parquet table once per session (one file listing and
    schema read), instead of once per reference in every fixture."""
    for t in SOURCE_TABLES:
        name = source_view(sf_dir, t)
        if not spark.catalog.tableExists(name):
            spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet").createOrReplaceTempView(name)


@dataclass(frozen=True)
class Dialect:
    name: str  # "spark" | "duckdb"
    sf_dir: str = ""

    def t(self, table: str) -> str:
        if self.name == "spark":
            return source_view(self.sf_dir, table)
        return table

    def dow(self, expr: str) -> str:
        """Day of week, 1 = Sunday ... 7 = Saturday."""
        return f"dayofweek({expr})" if self.name == "spark" else f"(dayofweek({expr}) + 1)"

    def add_days(self, date: str, n: str) -> str:
        return f"date_add({date}, CAST({n} AS INT))" if self.name == "spark" else f"({date} + CAST({n} AS INTEGER))"

    def finish(self, sql: str) -> str:
        return sql if self.name == "spark" else sql.replace("`", '"')


SPARK = "spark"
DUCKDB = "duckdb"


def _nn(expr: str, k: int, key: str = "event_id", mod: int = 17) -> str:
    """Numeric null injection."""
    return f"CASE WHEN {key} % {mod} = {k} THEN NULL ELSE {expr} END"


def _ns(expr: str, k: int, key: str = "event_id", mod: int = 19) -> str:
    """String null injection."""
    return f"CASE WHEN {key} % {mod} = {k} THEN NULL ELSE {expr} END"


def _events(d: Dialect) -> str:
    """Base projection of ``events`` shared by the event-grain fixtures."""
    return f"""SELECT
      event_id,
      user_id,
      CAST(user_id % 12 AS STRING) AS cid,
      CAST(user_id % 36 AS STRING) AS agid,
      CAST(user_id AS STRING) AS adid,
      'Campaign ' || CAST(user_id % 12 AS STRING) AS cname,
      'Group ' || CAST(user_id % 36 AS STRING) AS agname,
      CASE user_id % 3 WHEN 0 THEN 'ENABLED' WHEN 1 THEN 'PAUSED' ELSE 'REMOVED' END AS status,
      CASE user_id % 4 WHEN 0 THEN 'SEARCH' WHEN 1 THEN 'DISPLAY' WHEN 2 THEN 'VIDEO'
        ELSE 'PERFORMANCE_MAX' END AS channel,
      {d.add_days('CAST(ts AS DATE)', 'event_id % 4 * 120')} AS d,
      CAST(hour(ts) AS INT) AS hr,
      event_id % 5 AS imp,
      CAST(CASE WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 0 END AS BIGINT) AS clk,
      CAST(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS DOUBLE) AS conv,
      CASE WHEN event_type = 'purchase' THEN value ELSE CAST(0 AS DOUBLE) END AS conv_value,
      CAST(round(value * 100) AS BIGINT) * 10000 AS cost_micros,
      CAST(event_id % 100 AS DOUBLE) / 100 AS share,
      CAST(event_id % 50 AS DOUBLE) / 1000 AS rep_ctr,
      value * 1000000 AS rep_cpc,
      CASE event_id % 4 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' WHEN 2 THEN 'TABLET'
        ELSE 'CONNECTED_TV' END AS device,
      event_type,
      value
    FROM {d.t('events')}"""


def _six_metrics() -> str:
    return f"""{_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`,
      {_nn('cost_micros', 4)} AS `metrics.cost_micros`,
      {_nn('rep_ctr', 5)} AS `metrics.ctr`,
      {_nn('rep_cpc', 6)} AS `metrics.average_cpc`"""


def f01_core_campaign_performance(d: Dialect) -> str:
    day_key = "(day(g.d) * 12 + CAST(g.cid AS INT))"
    return f"""WITH ev AS ({_events(d)})
    SELECT
      g.cid AS `campaign.id`,
      g.d AS `segments.date`,
      CASE WHEN {day_key} % 19 = 3 THEN NULL ELSE g.cname END AS `campaign.name`,
      g.status AS `campaign.status`,
      CASE WHEN {day_key} % 23 = 4 THEN NULL ELSE g.channel END AS `campaign.advertising_channel_type`,
      CASE WHEN {day_key} % 17 = 0 THEN NULL ELSE g.imp END AS `metrics.impressions`,
      CASE WHEN {day_key} % 17 = 5 THEN NULL ELSE g.clk END AS `metrics.clicks`,
      CASE WHEN {day_key} % 17 = 7 THEN NULL ELSE g.ctr END AS `metrics.ctr`,
      CASE WHEN {day_key} % 17 = 9 THEN NULL ELSE g.cost END AS `metrics.cost_micros`,
      CASE WHEN {day_key} % 17 = 11 THEN NULL ELSE g.cpc END AS `metrics.average_cpc`
    FROM (
      SELECT cid, d, cname, status, channel,
        CAST(sum(imp) AS BIGINT) AS imp,
        CAST(sum(clk) AS BIGINT) AS clk,
        max(rep_ctr) AS ctr,
        CAST(sum(cost_micros) AS BIGINT) AS cost,
        max(rep_cpc) AS cpc
      FROM ev
      GROUP BY cid, d, cname, status, channel
    ) g"""


def _keyword_base(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)}),
    evk AS (SELECT ev.*, ev.event_id % (SELECT count(*) FROM {d.t('part')}) AS pk FROM ev),
    kw AS (
      SELECT evk.*, p.p_name, p.p_type, p.p_size,
        CASE p.p_size % 3 WHEN 0 THEN 'BROAD' WHEN 1 THEN 'PHRASE' ELSE 'EXACT' END AS match_type
      FROM evk JOIN {d.t('part')} p ON p.p_partkey = evk.pk
    )"""


def f02_search_keyword_performance(d: Dialect) -> str:
    return f"""{_keyword_base(d)}
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      agid AS `ad_group.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns('agname', 2)} AS `ad_group.name`,
      {_ns('p_name', 3)} AS `ad_group_criterion.keyword.text`,
      {_ns('match_type', 4)} AS `ad_group_criterion.keyword.match_type`,
      {_nn('CAST(p_size % 10 + 1 AS BIGINT)', 1)} AS `ad_group_criterion.quality_info.quality_score`,
      {_nn('imp', 2)} AS `metrics.impressions`,
      {_nn('clk', 3)} AS `metrics.clicks`,
      {_nn('cost_micros', 4)} AS `metrics.cost_micros`
    FROM kw"""


def f03_search_term_analysis(d: Dialect) -> str:
    criterion = (
        "CASE WHEN event_id % 23 = 0 THEN 'customers/1/adGroupCriteria/' || agid "
        "ELSE 'customers/1/adGroupCriteria/' || agid || '~' || CAST(pk AS STRING) END"
    )
    return f"""{_keyword_base(d)}
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      agid AS `ad_group.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns('agname', 2)} AS `ad_group.name`,
      {_ns("p_name || ' ' || lower(p_type)", 3)} AS `search_term_view.search_term`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'ADDED' WHEN 1 THEN 'EXCLUDED' ELSE 'NONE' END", 4)}
        AS `search_term_view.status`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'EXACT' WHEN 1 THEN 'PHRASE' ELSE 'BROAD' END", 5)}
        AS `segments.search_term_match_type`,
      {_ns(criterion, 6)} AS `segments.keyword.ad_group_criterion`,
      {_ns('p_name', 7)} AS `segments.keyword.info.text`,
      {_ns('match_type', 8)} AS `segments.keyword.info.match_type`,
      {_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`,
      {_nn('cost_micros', 4)} AS `metrics.cost_micros`,
      {_nn('rep_cpc', 5)} AS `metrics.average_cpc`,
      {_nn('rep_ctr', 6)} AS `metrics.ctr`
    FROM kw"""


def f04_conversion_performance(d: Dialect) -> str:
    """Conversions follow their click by up to twelve days, and those of campaign 5 are booked on a campaign without cost:
    there are conversions without a campaign row, by day and by campaign, and a campaign without conversions."""
    offline = "CASE cid WHEN '5' THEN {0} ELSE {1} END"
    return f"""WITH ev AS ({_events(d)})
    SELECT
      {d.add_days('d', 'event_id % 7 * 2')} AS `segments.date`,
      {offline.format("'900'", 'cid')} AS `campaign.id`,
      {_ns(offline.format("'Offline import'", 'cname'), 1)} AS `campaign.name`,
      {_ns("'customers/1/conversionActions/' || CAST(event_id % 3 AS STRING)", 2)} AS `segments.conversion_action`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'Lead form' WHEN 1 THEN 'Phone call' ELSE 'Enrollment' END", 3)}
        AS `segments.conversion_action_name`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'SUBMIT_LEAD_FORM' WHEN 1 THEN 'PHONE_CALL_LEAD' ELSE 'PURCHASE' END", 4)}
        AS `segments.conversion_action_category`,
      {_nn('conv', 1)} AS `metrics.conversions`,
      {_nn('conv_value', 2)} AS `metrics.conversions_value`,
      {_nn('conv + CAST(event_id % 2 AS DOUBLE)', 3)} AS `metrics.all_conversions`,
      {_nn('conv_value * 2', 4)} AS `metrics.all_conversions_value`,
      {_nn('conv_value', 5)} AS `metrics.value_per_conversion`,
      {_nn('value', 6)} AS `metrics.value_per_all_conversions`
    FROM ev
    WHERE event_type = 'purchase'"""


def _page_base(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)}),
    evp AS (SELECT ev.*, ev.event_id % (SELECT count(*) FROM {d.t('pages')}) AS pid FROM ev),
    pg AS (SELECT evp.*, p.url FROM evp JOIN {d.t('pages')} p ON p.page_id = evp.pid)"""


def f05_ad_copy_and_landing_page_performance(d: Dialect) -> str:
    urls = "CASE WHEN event_id % 29 = 0 THEN 'n/a' WHEN event_id % 31 = 0 THEN '[''' || url || ''']' ELSE url END"
    return f"""{_page_base(d)}
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      agid AS `ad_group.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns('agname', 2)} AS `ad_group.name`,
      adid AS `ad_group_ad.ad.id`,
      {_ns(urls, 3)} AS `ad_group_ad.ad.final_urls`,
      {_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`
    FROM pg"""


def f06_optimization_device_and_time(d: Dialect) -> str:
    dow = d.dow("d")
    names = " ".join(
        f"WHEN {i} THEN '{n}'"
        for i, n in enumerate(["SUNDAY", "MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY"], 1)
    )
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      {_ns('device', 1)} AS `segments.device`,
      {_ns(f'CASE {dow} {names} END', 2)} AS `segments.day_of_week`,
      {_nn('hr', 7)} AS `segments.hour`,
      {_six_metrics()}
    FROM ev"""


def _audience(d: Dialect, col: str, expr: str) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      agid AS `ad_group.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns(expr, 2)} AS `{col}`,
      {_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`,
      {_nn('cost_micros', 4)} AS `metrics.cost_micros`
    FROM ev"""


def f07_audience_gender_performance(d: Dialect) -> str:
    return _audience(
        d, "ad_group_criterion.gender.type",
        "CASE event_id % 3 WHEN 0 THEN 'MALE' WHEN 1 THEN 'FEMALE' ELSE 'UNDETERMINED' END",
    )


def f08_audience_age_performance(d: Dialect) -> str:
    ages = ["AGE_RANGE_18_24", "AGE_RANGE_25_34", "AGE_RANGE_35_44", "AGE_RANGE_45_54",
            "AGE_RANGE_55_64", "AGE_RANGE_65_UP"]
    cases = " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ages))
    return _audience(
        d, "ad_group_criterion.age_range.type", f"CASE event_id % 7 {cases} ELSE 'AGE_RANGE_UNDETERMINED' END"
    )


def f09_competitive_impression_share(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_nn('share', 1)} AS `metrics.search_impression_share`,
      {_nn('share / 2', 2)} AS `metrics.search_top_impression_share`,
      {_nn('share / 4', 3)} AS `metrics.search_absolute_top_impression_share`
    FROM ev"""


def f10_network_performance(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'SEARCH' WHEN 1 THEN 'SEARCH_PARTNERS' ELSE 'CONTENT' END", 2)}
        AS `segments.ad_network_type`,
      {_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`
    FROM ev"""


def f11_display_ad_viewability(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns('agname', 2)} AS `ad_group.name`,
      {_nn('imp * 100', 1)} AS `metrics.active_view_impressions`,
      {_nn('share', 2)} AS `metrics.active_view_measurability`,
      {_nn('rep_ctr * 10', 3)} AS `metrics.active_view_viewability`,
      {_nn('rep_cpc', 4)} AS `metrics.active_view_cpm`
    FROM ev"""


def f12_call_lead_generation(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns('agname', 2)} AS `ad_group.name`,
      {_nn('clk', 1)} AS `metrics.phone_calls`,
      {_nn('imp', 2)} AS `metrics.phone_impressions`,
      {_nn('share', 3)} AS `metrics.phone_through_rate`
    FROM ev"""


def f13_geo_target_constant(d: Dialect) -> str:
    copies = " UNION ALL ".join(f"SELECT c_custkey, c_nationkey, {k} AS copy FROM {d.t('customer')} WHERE c_custkey % {m} = 0"
                                for k, m in ((0, 1), (1, 10), (2, 30)))
    return f"""SELECT
      CAST(c.c_custkey AS STRING) AS `geo_target_constant.id`,
      {_ns("'City ' || CAST(c.c_custkey AS STRING) || substr(' (old)', 1, 6 * c.copy)", 1, 'c.c_custkey', 23)} AS `geo_target_constant.name`,
      {_ns("'City ' || CAST(c.c_custkey AS STRING) || ', ' || n.n_name || ', ' || r.r_name", 2, 'c.c_custkey', 23)}
        AS `geo_target_constant.canonical_name`,
      {_ns('substr(r.r_name, 1, 2)', 3, 'c.c_custkey', 23)} AS `geo_target_constant.country_code`,
      {_ns("'City'", 4, 'c.c_custkey', 23)} AS `geo_target_constant.target_type`
    FROM ({copies}) c
    JOIN {d.t('nation')} n ON n.n_nationkey = c.c_nationkey
    JOIN {d.t('region')} r ON r.r_regionkey = n.n_regionkey"""


def f14_geographic_performance(d: Dialect) -> str:
    city = f"'geoTargetConstants/' || CAST(event_id % ((SELECT count(*) FROM {d.t('customer')}) + 7) AS STRING)"
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      {_ns(city, 1, mod=3)} AS `segments.geo_target_city`,
      {_ns("CASE event_id % 2 WHEN 0 THEN 'AREA_OF_INTEREST' ELSE 'LOCATION_OF_PRESENCE' END", 2)}
        AS `geographic_view.location_type`,
      {_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`,
      {_nn('cost_micros', 4)} AS `metrics.cost_micros`
    FROM ev"""


def f15_ads_performance(d: Dialect) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      {_ns('agid', 1)} AS `ad_group.id`,
      {_ns('adid', 2)} AS `ad_group_ad.ad.id`,
      {_nn('imp', 1)} AS `metrics.impressions`,
      {_nn('clk', 2)} AS `metrics.clicks`,
      {_nn('conv', 3)} AS `metrics.conversions`,
      {_nn('cost_micros', 4)} AS `metrics.cost_micros`
    FROM ev"""


def f16_ads_data(d: Dialect) -> str:
    """One row per ad (= user); ad texts are whole documents."""
    types = "CASE u.user_id % 4 WHEN 0 THEN 'RESPONSIVE_SEARCH_AD' WHEN 1 THEN 'EXPANDED_TEXT_AD' " \
            "WHEN 2 THEN 'RESPONSIVE_DISPLAY_AD' ELSE 'IMAGE_AD' END"

    def text_for(kind: int, k: int) -> str:
        return f"CASE WHEN u.user_id % 4 = {kind} AND u.user_id % 11 <> {k} THEN doc.text ELSE NULL END"

    return f"""WITH u AS (SELECT DISTINCT user_id FROM {d.t('events')}),
    ud AS (
      SELECT u.user_id,
        u.user_id % (SELECT count(*) FROM {d.t('documents')}) AS did,
        u.user_id % (SELECT count(*) FROM {d.t('pages')}) AS pid
      FROM u
    )
    SELECT
      CAST(u.user_id % 12 AS STRING) AS `campaign.id`,
      {_ns("'Campaign ' || CAST(u.user_id % 12 AS STRING)", 1, 'u.user_id', 13)} AS `campaign.name`,
      CAST(u.user_id % 36 AS STRING) AS `ad_group.id`,
      {_ns("'Group ' || CAST(u.user_id % 36 AS STRING)", 2, 'u.user_id', 13)} AS `ad_group.name`,
      CAST(u.user_id AS STRING) AS `ad_group_ad.ad.id`,
      {_ns(types, 3, 'u.user_id', 13)} AS `ad_group_ad.ad.type`,
      {_ns("CASE u.user_id % 3 WHEN 0 THEN 'ENABLED' WHEN 1 THEN 'PAUSED' ELSE 'REMOVED' END", 4, 'u.user_id', 13)}
        AS `ad_group_ad.status`,
      {_ns('pg.url', 5, 'u.user_id', 13)} AS `ad_group_ad.ad.final_urls`,
      {text_for(0, 1)} AS `ad_group_ad.ad.responsive_search_ad.headlines`,
      {text_for(0, 2)} AS `ad_group_ad.ad.responsive_search_ad.descriptions`,
      {text_for(1, 3)} AS `ad_group_ad.ad.expanded_text_ad.headline_part1`,
      {text_for(1, 4)} AS `ad_group_ad.ad.expanded_text_ad.headline_part2`,
      {text_for(1, 5)} AS `ad_group_ad.ad.expanded_text_ad.headline_part3`,
      {text_for(1, 6)} AS `ad_group_ad.ad.expanded_text_ad.description`,
      {text_for(1, 7)} AS `ad_group_ad.ad.expanded_text_ad.description2`,
      {text_for(2, 8)} AS `ad_group_ad.ad.responsive_display_ad.long_headline`,
      {text_for(2, 9)} AS `ad_group_ad.ad.responsive_display_ad.headlines`,
      {text_for(2, 10)} AS `ad_group_ad.ad.responsive_display_ad.descriptions`,
      CASE WHEN u.user_id % 4 = 3 THEN 'https://img.example.com/ad/' || CAST(u.user_id AS STRING) ELSE NULL END
        AS `ad_group_ad.ad.image_ad.image_url`,
      CASE WHEN u.user_id % 4 = 3 THEN 'IMAGE_PNG' ELSE NULL END AS `ad_group_ad.ad.image_ad.mime_type`,
      doc.lang AS `ad_group_ad.ad.language`,
      doc.n_chars AS `ad_group_ad.ad.text_length`
    FROM ud u
    LEFT JOIN {d.t('documents')} doc ON doc.doc_id = u.did
    LEFT JOIN {d.t('pages')} pg ON pg.page_id = u.pid"""


def _asset_metrics(d: Dialect, head: str) -> str:
    return f"""WITH ev AS ({_events(d)})
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {head},
      {_ns('device', 5)} AS `segments.device`,
      {_six_metrics()}
    FROM ev"""


def f17_campaign_asset(d: Dialect) -> str:
    head = f"""{_ns('status', 2)} AS `campaign.status`,
      CAST(event_id % 40 AS STRING) AS `asset.id`,
      {_ns("CASE event_id % 4 WHEN 0 THEN 'TEXT' WHEN 1 THEN 'IMAGE' WHEN 2 THEN 'SITELINK' ELSE 'CALLOUT' END", 3)}
        AS `asset.type`,
      {_ns("CASE event_id % 2 WHEN 0 THEN 'ENABLED' ELSE 'REMOVED' END", 4)} AS `campaign_asset.status`"""
    return _asset_metrics(d, head)


def f18_ad_group_ad_asset_view(d: Dialect) -> str:
    head = f"""agid AS `ad_group.id`,
      {_ns('agname', 2)} AS `ad_group.name`,
      {_ns("'customers/1/assets/' || CAST(event_id % 40 AS STRING)", 3)} AS `ad_group_ad_asset_view.asset`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'HEADLINE' WHEN 1 THEN 'DESCRIPTION' ELSE 'MARKETING_IMAGE' END", 4)}
        AS `ad_group_ad_asset_view.field_type`"""
    return _asset_metrics(d, head)


def f19_asset(d: Dialect) -> str:
    k = "p_partkey"
    return f"""SELECT
      CAST(p_partkey AS STRING) AS `asset.id`,
      {_ns("CASE p_size % 4 WHEN 0 THEN 'TEXT' WHEN 1 THEN 'IMAGE' WHEN 2 THEN 'SITELINK' ELSE 'CALLOUT' END", 1, k, 13)}
        AS `asset.type`,
      {_ns("CASE p_partkey % 2 WHEN 0 THEN 'ADVERTISER' ELSE 'AUTOMATICALLY_CREATED' END", 2, k, 13)}
        AS `asset.source`,
      {_ns('p_name', 3, k, 13)} AS `asset.text_asset.text`,
      {_ns("'https://img.example.com/asset/' || CAST(p_partkey AS STRING)", 4, k, 13)}
        AS `asset.image_asset.full_size_url`,
      {_ns('p_brand', 5, k, 13)} AS `asset.sitelink_asset.link_text`,
      {_ns('p_type', 6, k, 13)} AS `asset.callout_asset.callout_text`,
      {_ns("'Brands'", 7, k, 13)} AS `asset.structured_snippet_asset.header`,
      {_ns("p_brand || ', ' || p_type", 8, k, 13)} AS `asset.structured_snippet_asset.values`
    FROM {d.t('part')}"""


def f20_conversion_action(d: Dialect) -> str:
    k = "s_suppkey"
    return f"""SELECT
      CAST(s_suppkey AS STRING) AS `conversion_action.id`,
      {_ns('s_name', 1, k, 7)} AS `conversion_action.name`,
      {_ns("CASE s_suppkey % 3 WHEN 0 THEN 'ENABLED' WHEN 1 THEN 'REMOVED' ELSE 'HIDDEN' END", 2, k, 7)}
        AS `conversion_action.status`,
      {_ns("CASE s_suppkey % 4 WHEN 0 THEN 'SUBMIT_LEAD_FORM' WHEN 1 THEN 'PHONE_CALL_LEAD' "
           "WHEN 2 THEN 'PURCHASE' ELSE 'PAGE_VIEW' END", 3, k, 7)} AS `conversion_action.category`,
      {_ns("CASE s_suppkey % 2 WHEN 0 THEN 'true' ELSE 'false' END", 4, k, 7)}
        AS `conversion_action.primary_for_goal`,
      {_ns("CASE s_suppkey % 2 WHEN 0 THEN 'ONE_PER_CLICK' ELSE 'MANY_PER_CLICK' END", 5, k, 7)}
        AS `conversion_action.counting_type`,
      {_ns("CASE s_suppkey % 3 WHEN 0 THEN 'LAST_CLICK' WHEN 1 THEN 'DATA_DRIVEN' "
           "ELSE 'UNKNOWN' END", 6, k, 7)} AS `conversion_action.attribution_model_settings.attribution_model`,
      {_nn("CAST(30 + (s_suppkey % 3) * 30 AS BIGINT)", 1, k, 11)}
        AS `conversion_action.click_through_lookback_window_days`,
      {_nn("CAST(1 + s_suppkey % 30 AS BIGINT)", 2, k, 11)} AS `conversion_action.view_through_lookback_window_days`,
      {_ns("CASE s_suppkey % 5 WHEN 0 THEN 'false' ELSE 'true' END", 0, k, 7)}
        AS `conversion_action.include_in_conversions_metric`
    FROM {d.t('supplier')}"""


def _placement(d: Dialect, prefix: str, with_target: bool) -> str:
    target = ""
    if with_target:
        target = f"""{_ns("CASE WHEN event_id % 29 = 0 THEN 'n/a' ELSE url END", 7)}
        AS `{prefix}.group_placement_target_url`,"""
    return f"""{_page_base(d)}
    SELECT
      d AS `segments.date`,
      cid AS `campaign.id`,
      {_ns('cname', 1)} AS `campaign.name`,
      {_ns('channel', 2)} AS `campaign.advertising_channel_type`,
      agid AS `ad_group.id`,
      {_ns('agname', 3)} AS `ad_group.name`,
      {_ns('url', 4)} AS `{prefix}.placement`,
      {_ns("CASE event_id % 3 WHEN 0 THEN 'WEBSITE' WHEN 1 THEN 'YOUTUBE_VIDEO' ELSE 'MOBILE_APPLICATION' END", 5)}
        AS `{prefix}.placement_type`,
      {_ns("'Site ' || CAST(pid AS STRING)", 6)} AS `{prefix}.display_name`,
      {target}
      {_six_metrics()}
    FROM pg"""


def f21_placement_performance(d: Dialect) -> str:
    return _placement(d, "detail_placement_view", True)


def f22_group_placement_performance(d: Dialect) -> str:
    return _placement(d, "group_placement_view", False)


FIXTURES = {
    "core_campaign_performance": f01_core_campaign_performance,
    "search_keyword_performance": f02_search_keyword_performance,
    "search_term_analysis": f03_search_term_analysis,
    "conversion_performance": f04_conversion_performance,
    "ad_copy_and_landing_page_performance": f05_ad_copy_and_landing_page_performance,
    "optimization_device_and_time": f06_optimization_device_and_time,
    "audience_gender_performance": f07_audience_gender_performance,
    "audience_age_performance": f08_audience_age_performance,
    "competitive_impression_share": f09_competitive_impression_share,
    "network_performance": f10_network_performance,
    "display_ad_viewability": f11_display_ad_viewability,
    "call_lead_generation": f12_call_lead_generation,
    "geo_target_constant": f13_geo_target_constant,
    "geographic_performance": f14_geographic_performance,
    "ads_performance": f15_ads_performance,
    "ads_data": f16_ads_data,
    "campaign_asset": f17_campaign_asset,
    "ad_group_ad_asset_view": f18_ad_group_ad_asset_view,
    "asset": f19_asset,
    "conversion_action": f20_conversion_action,
    "placement_performance": f21_placement_performance,
    "group_placement_performance": f22_group_placement_performance,
}


def fixture_sql(bronze_table: str, dialect: Dialect) -> str:
    return dialect.finish(FIXTURES[bronze_table](dialect))


def bronze_frame(spark: SparkSession, sf_dir: str, bronze_table: str) -> DataFrame:
    register_sources(spark, sf_dir)
    return spark.sql(fixture_sql(bronze_table, Dialect(SPARK, sf_dir)))


class BronzeFixtures(LazyLayer):
    """Lazy, thread-safe name -> bronze DataFrame mapping over one test-data folder.

    The supplied tables are registered once, here; each fixture is then one
    ``spark.sql`` call on first access.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        register_sources(spark, sf_dir)
        dialect = Dialect(SPARK, sf_dir)
        super().__init__(lambda name: spark.sql(fixture_sql(name, dialect)), FIXTURES)
        self.spark, self.sf_dir = spark, sf_dir
