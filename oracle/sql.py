"""DuckDB oracle: the same pipeline written independently as plain SQL.

Used only to check the Spark implementation (``__spark_entry__.oracle_sql``).
Bronze inputs are the shared fixture SQL texts (the fixtures are test data,
not the code under test) with flattened column names; every layer above is
re-stated here from the reference's semantics, not generated from the Spark
specs.

Two engine differences are bridged on purpose:

* DuckDB's ``sum(bigint)`` is HUGEINT -> cast to BIGINT;
* DuckDB rounds doubles with ``round(x * 10^d) / 10^d``, Spark rounds the
  shortest decimal form of the double HALF_UP -> ``SR(x, d)`` goes through
  that decimal form.
"""

from __future__ import annotations

import re

from adlake.sources.bronze import BRONZE_DDL
from adlake.sources.fixtures import Dialect, fixture_sql


def SR(x: str, d: int = 2) -> str:
    """Spark's round(double, d)."""
    return f"CAST(round(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)"


def NUM(c: str) -> str:
    """fillna(0) on a numeric column: null and NaN -> 0."""
    return f"CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN 0 ELSE coalesce({c}, 0) END"


def bronze(name: str) -> str:
    sql = fixture_sql(name, Dialect("duckdb"))
    # flatten the quoted dotted output names: "metrics.clicks" -> "metrics_clicks"
    return re.sub(r'"([A-Za-z0-9_.]+)"', lambda mo: '"' + mo.group(1).replace(".", "_") + '"', sql)


def filled(bronze_name: str, num: list[str], strs: list[str]) -> str:
    reps = [f"{NUM(c)} AS {c}" for c in num] + [f"coalesce({c}, 'Unknown') AS {c}" for c in strs]
    return f"SELECT * REPLACE ({', '.join(reps)}) FROM b_{bronze_name}"


CTR = "CASE WHEN metrics_impressions > 0 THEN metrics_clicks / metrics_impressions * 100 ELSE 0 END"
CVR = "CASE WHEN metrics_clicks > 0 THEN metrics_conversions / metrics_clicks * 100 ELSE 0 END"
COST = "metrics_cost_micros / 1000000"
CPC_COST = f"CASE WHEN metrics_clicks > 0 THEN ({COST}) / metrics_clicks ELSE 0 END"
CPC_REP = "metrics_average_cpc / 1000000"
SIX = ["metrics_impressions", "metrics_clicks", "metrics_cost_micros", "metrics_conversions", "metrics_ctr",
       "metrics_average_cpc"]

# silver table -> (bronze table, numeric fills, string fills, select list)
SILVER: dict[str, tuple[str, list[str], list[str], str]] = {
    "campaigns": (
        "core_campaign_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_ctr", "metrics_cost_micros", "metrics_average_cpc"],
        ["campaign_id", "campaign_name", "campaign_status", "campaign_advertising_channel_type"],
        f"""campaign_id, segments_date, campaign_name, campaign_status, campaign_advertising_channel_type,
        metrics_impressions, metrics_clicks, {CTR} AS ctr_pct, {CPC_COST} AS cpc_inr, {COST} AS cost_inr""",
    ),
    "keywords": (
        "search_keyword_performance",
        ["ad_group_criterion_quality_info_quality_score", "metrics_impressions", "metrics_clicks",
         "metrics_cost_micros"],
        ["campaign_name", "ad_group_name", "ad_group_criterion_keyword_text", "ad_group_criterion_keyword_match_type"],
        f"""segments_date, campaign_id, ad_group_id, campaign_name, ad_group_name,
        ad_group_criterion_keyword_text AS keyword, ad_group_criterion_keyword_match_type AS keyword_match_type,
        ad_group_criterion_quality_info_quality_score AS quality_score, metrics_impressions, metrics_clicks,
        {CTR} AS ctr_pct, {CPC_COST} AS cpc_inr, {COST} AS cost_inr""",
    ),
    "search_terms": (
        "search_term_analysis",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros", "metrics_average_cpc",
         "metrics_ctr"],
        ["campaign_name", "ad_group_name", "search_term_view_search_term", "search_term_view_status",
         "segments_search_term_match_type", "segments_keyword_ad_group_criterion", "segments_keyword_info_text",
         "segments_keyword_info_match_type"],
        f"""segments_date, campaign_id, ad_group_id, campaign_name, ad_group_name,
        search_term_view_search_term AS search_term, search_term_view_status AS search_term_status,
        segments_search_term_match_type AS search_term_match_type,
        regexp_extract(segments_keyword_ad_group_criterion, 'adGroupCriteria/[0-9]+~([0-9]+)', 1)
          AS triggering_keyword_criterion_id,
        segments_keyword_info_text AS triggering_keyword_text,
        segments_keyword_info_match_type AS triggering_keyword_match_type,
        metrics_impressions, metrics_clicks, metrics_conversions, {COST} AS cost_inr, {CPC_REP} AS cpc_inr,
        {CTR} AS ctr_pct""",
    ),
    "conversions": (
        "conversion_performance",
        ["metrics_all_conversions", "metrics_all_conversions_value", "metrics_conversions",
         "metrics_conversions_value", "metrics_value_per_conversion", "metrics_value_per_all_conversions"],
        ["segments_conversion_action", "segments_conversion_action_name", "segments_conversion_action_category"],
        """segments_date, campaign_id, campaign_name, segments_conversion_action AS conversion_action,
        segments_conversion_action_name AS conversion_action_name,
        segments_conversion_action_category AS conversion_action_category,
        metrics_conversions AS conversions, metrics_conversions_value AS conversions_value,
        CASE WHEN metrics_conversions > 0 THEN metrics_conversions_value / metrics_conversions ELSE 0 END
          AS value_per_conversion,
        metrics_all_conversions AS all_conversions, metrics_all_conversions_value AS all_conversions_value,
        CASE WHEN metrics_all_conversions > 0 THEN metrics_all_conversions_value / metrics_all_conversions ELSE 0 END
          AS value_per_all_conversions""",
    ),
    "ad_copy": (
        "ad_copy_and_landing_page_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions"],
        ["campaign_name", "ad_group_name", "ad_group_ad_ad_final_urls"],
        f"""segments_date, campaign_id, ad_group_id, campaign_name, ad_group_name, ad_group_ad_ad_id AS ad_id,
        metrics_impressions, metrics_clicks, metrics_conversions, {CTR} AS ctr_pct, {CVR} AS cvr_pct,
        ad_group_ad_ad_final_urls AS final_url,
        regexp_extract(ad_group_ad_ad_final_urls, 'https?://([^/]+)', 1) AS domain""",
    ),
    "devices": (
        "optimization_device_and_time",
        ["segments_hour", "metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros",
         "metrics_ctr", "metrics_average_cpc"],
        ["segments_device", "segments_day_of_week"],
        f"""segments_date, campaign_id, segments_device AS device, segments_day_of_week AS day_of_week,
        segments_hour AS hour,
        CASE WHEN segments_hour BETWEEN 6 AND 11 THEN 'Morning' WHEN segments_hour BETWEEN 12 AND 17 THEN 'Afternoon'
             WHEN segments_hour BETWEEN 18 AND 23 THEN 'Evening' ELSE 'Night' END AS time_of_day,
        metrics_impressions, metrics_clicks, {CTR} AS ctr_pct, metrics_conversions, {CVR} AS cvr_pct,
        {COST} AS cost_inr, {CPC_REP} AS cpc_inr""",
    ),
    "genders": (
        "audience_gender_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros"],
        ["campaign_name", "ad_group_criterion_gender_type"],
        f"""segments_date, campaign_id, ad_group_id, campaign_name, ad_group_criterion_gender_type AS gender,
        metrics_impressions, metrics_clicks, metrics_conversions, {CTR} AS ctr_pct, {CVR} AS cvr_pct,
        {COST} AS cost_inr""",
    ),
    "ages": (
        "audience_age_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros"],
        ["campaign_name", "ad_group_criterion_age_range_type"],
        f"""segments_date, campaign_id, ad_group_id, campaign_name,
        replace(replace(ad_group_criterion_age_range_type, 'AGE_RANGE_', ''), '_', '-') AS age_range,
        metrics_impressions, metrics_clicks, metrics_conversions, {CTR} AS ctr_pct, {CVR} AS cvr_pct,
        {COST} AS cost_inr""",
    ),
    "impressions": (
        "competitive_impression_share",
        ["metrics_search_impression_share", "metrics_search_top_impression_share",
         "metrics_search_absolute_top_impression_share"],
        ["campaign_name"],
        """segments_date, campaign_id, campaign_name,
        metrics_search_impression_share * 100 AS impression_share_pct,
        metrics_search_top_impression_share * 100 AS top_impression_share_pct,
        metrics_search_absolute_top_impression_share * 100 AS abs_top_impression_share_pct,
        (1 - metrics_search_impression_share) * 100 AS lost_impression_share_pct""",
    ),
    "networks": (
        "network_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions"],
        ["campaign_name", "segments_ad_network_type"],
        f"""segments_date, campaign_id, campaign_name, segments_ad_network_type AS ad_network,
        metrics_impressions, metrics_clicks, metrics_conversions, {CTR} AS ctr_pct, {CVR} AS cvr_pct""",
    ),
    "display_ads": (
        "display_ad_viewability",
        ["metrics_active_view_impressions", "metrics_active_view_measurability", "metrics_active_view_viewability",
         "metrics_active_view_cpm"],
        ["campaign_name", "ad_group_name"],
        """segments_date, campaign_name, ad_group_name, metrics_active_view_impressions,
        metrics_active_view_measurability AS measurability_pct, metrics_active_view_viewability AS viewability_pct,
        metrics_active_view_cpm / 1000000 AS cpm,
        (metrics_active_view_impressions / 1000) * (metrics_active_view_cpm / 1000000) AS total_cost""",
    ),
    "calls": (
        "call_lead_generation",
        ["metrics_phone_calls", "metrics_phone_impressions", "metrics_phone_through_rate"],
        ["campaign_name", "ad_group_name"],
        """segments_date, campaign_name, ad_group_name, metrics_phone_impressions, metrics_phone_calls,
        metrics_phone_through_rate * 100 AS phone_through_rate_pct""",
    ),
    "geo_constants": (
        "geo_target_constant",
        [],
        ["geo_target_constant_id", "geo_target_constant_name", "geo_target_constant_canonical_name",
         "geo_target_constant_country_code", "geo_target_constant_target_type"],
        """geo_target_constant_id AS constant_id, geo_target_constant_name AS name,
        geo_target_constant_canonical_name AS canonical_name, geo_target_constant_country_code AS country_code,
        geo_target_constant_target_type AS target_type""",
    ),
    "locations_base": (
        "geographic_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros"],
        ["segments_geo_target_city", "geographic_view_location_type"],
        f"""segments_date, campaign_id, regexp_extract(segments_geo_target_city, '/([0-9]+)$', 1) AS city_id,
        geographic_view_location_type AS location_type, metrics_impressions, metrics_clicks, {CTR} AS ctr_pct,
        metrics_conversions, {CVR} AS cvr_pct, {COST} AS cost_inr""",
    ),
    "ads_performance": (
        "ads_performance",
        ["metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros"],
        ["ad_group_id", "ad_group_ad_ad_id"],
        f"""ad_group_id, ad_group_ad_ad_id, metrics_impressions, metrics_clicks, metrics_conversions,
        {COST} AS cost_inr""",
    ),
    "ads_data": (
        "ads_data",
        [],
        ["campaign_id", "campaign_name", "ad_group_id", "ad_group_name", "ad_group_ad_ad_id", "ad_group_ad_ad_type",
         "ad_group_ad_status", "ad_group_ad_ad_final_urls", "ad_group_ad_ad_responsive_search_ad_headlines",
         "ad_group_ad_ad_responsive_search_ad_descriptions", "ad_group_ad_ad_expanded_text_ad_headline_part1",
         "ad_group_ad_ad_expanded_text_ad_headline_part2", "ad_group_ad_ad_expanded_text_ad_headline_part3",
         "ad_group_ad_ad_expanded_text_ad_description", "ad_group_ad_ad_expanded_text_ad_description2",
         "ad_group_ad_ad_responsive_display_ad_long_headline", "ad_group_ad_ad_responsive_display_ad_headlines",
         "ad_group_ad_ad_responsive_display_ad_descriptions", "ad_group_ad_ad_image_ad_image_url",
         "ad_group_ad_ad_image_ad_mime_type"],
        "*",
    ),
    "campaign_assets": (
        "campaign_asset",
        SIX,
        ["campaign_name", "campaign_status", "asset_type", "campaign_asset_status", "segments_device"],
        f"""segments_date, campaign_id, campaign_name, campaign_status, asset_id, asset_type,
        campaign_asset_status AS asset_status, segments_device AS device, metrics_impressions, metrics_clicks,
        metrics_conversions, metrics_ctr * 100 AS ctr_pct, {CPC_REP} AS cpc_inr, {COST} AS cost_inr""",
    ),
    "ad_group_ad_assets": (
        "ad_group_ad_asset_view",
        SIX,
        ["campaign_name", "ad_group_name", "ad_group_ad_asset_view_asset", "ad_group_ad_asset_view_field_type",
         "segments_device"],
        f"""segments_date, campaign_id, campaign_name, ad_group_id, ad_group_name,
        ad_group_ad_asset_view_asset AS asset, ad_group_ad_asset_view_field_type AS field_type,
        segments_device AS device, metrics_impressions, metrics_clicks, metrics_conversions,
        metrics_ctr * 100 AS ctr_pct, {CPC_REP} AS cpc_inr, {COST} AS cost_inr""",
    ),
    "assets": (
        "asset",
        [],
        ["asset_type", "asset_source", "asset_text_asset_text", "asset_image_asset_full_size_url",
         "asset_sitelink_asset_link_text", "asset_callout_asset_callout_text", "asset_structured_snippet_asset_header",
         "asset_structured_snippet_asset_values"],
        """asset_id, asset_type, asset_source, asset_text_asset_text AS text_asset_text,
        asset_image_asset_full_size_url AS image_url, asset_sitelink_asset_link_text AS sitelink_text,
        asset_callout_asset_callout_text AS callout_text, asset_structured_snippet_asset_header AS snippet_header,
        asset_structured_snippet_asset_values AS snippet_values""",
    ),
    "conversion_actions": (
        "conversion_action",
        ["conversion_action_click_through_lookback_window_days", "conversion_action_view_through_lookback_window_days"],
        ["conversion_action_name", "conversion_action_status", "conversion_action_category",
         "conversion_action_primary_for_goal", "conversion_action_counting_type",
         "conversion_action_attribution_model_settings_attribution_model",
         "conversion_action_include_in_conversions_metric"],
        """conversion_action_id, conversion_action_name AS name, conversion_action_status AS status,
        conversion_action_category AS category, conversion_action_primary_for_goal AS primary_for_goal,
        conversion_action_counting_type AS counting_type,
        conversion_action_attribution_model_settings_attribution_model AS attribution_model,
        conversion_action_click_through_lookback_window_days AS click_through_lookback_window_days,
        conversion_action_view_through_lookback_window_days AS view_through_lookback_window_days,
        conversion_action_include_in_conversions_metric AS include_in_conversions""",
    ),
    "placements": (
        "placement_performance",
        SIX,
        ["campaign_name", "campaign_advertising_channel_type", "ad_group_name", "detail_placement_view_placement",
         "detail_placement_view_placement_type", "detail_placement_view_display_name",
         "detail_placement_view_group_placement_target_url"],
        f"""segments_date, campaign_id, campaign_name, campaign_advertising_channel_type, ad_group_id, ad_group_name,
        detail_placement_view_placement AS placement, detail_placement_view_placement_type AS placement_type,
        detail_placement_view_display_name AS display_name,
        detail_placement_view_group_placement_target_url AS group_placement_target_url,
        metrics_impressions, metrics_clicks, metrics_conversions, metrics_ctr * 100 AS ctr_pct,
        {CPC_REP} AS cpc_inr, {COST} AS cost_inr""",
    ),
    "group_placements": (
        "group_placement_performance",
        SIX,
        ["campaign_name", "campaign_advertising_channel_type", "ad_group_name", "group_placement_view_placement",
         "group_placement_view_placement_type", "group_placement_view_display_name"],
        f"""segments_date, campaign_id, campaign_name, campaign_advertising_channel_type, ad_group_id, ad_group_name,
        group_placement_view_placement AS placement, group_placement_view_placement_type AS placement_type,
        group_placement_view_display_name AS display_name,
        metrics_impressions, metrics_clicks, metrics_conversions, metrics_ctr * 100 AS ctr_pct,
        {CPC_REP} AS cpc_inr, {COST} AS cost_inr""",
    ),
}

LOCATIONS = """SELECT l.*, g.name AS city_name, g.canonical_name, g.country_code
FROM s_locations_base l LEFT JOIN (
  SELECT * FROM s_geo_constants
  QUALIFY row_number() OVER (PARTITION BY constant_id ORDER BY name, canonical_name, country_code) = 1) g
ON l.city_id = g.constant_id"""


def SK(*cols: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), 'Unknown')" for c in cols]
    if len(parts) > 1:  # escaped, so that ('a~b', 'c') and ('a', 'b~c') differ
        parts = [rf"replace(replace({p}, '\', '\\'), '~', '\~')" for p in parts]
    return "md5(concat_ws('~', " + ", ".join(parts) + "))"


def DK(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


DEC = "DECIMAL(20,6)"

GOLD: dict[str, tuple[str, list[str]]] = {
    "dim_campaign": (f"""SELECT {SK('campaign_id')} AS campaign_pk, campaign_id,
          l.campaign_name AS campaign_name, l.campaign_status AS campaign_status,
          l.campaign_advertising_channel_type AS advertising_channel_type
        FROM (SELECT coalesce(campaign_id, 'Unknown') AS campaign_id,
          arg_max({{'campaign_name': campaign_name, 'campaign_status': campaign_status,
                    'campaign_advertising_channel_type': campaign_advertising_channel_type}},
                  {{'own': own, 'd': segments_date, 'n': campaign_name, 's': campaign_status,
                    'c': campaign_advertising_channel_type}}) AS l
          FROM (SELECT campaign_id, segments_date, campaign_name, campaign_status, campaign_advertising_channel_type, 1 AS own
                FROM s_campaigns
                UNION ALL SELECT campaign_id, segments_date, campaign_name, 'Unknown', 'Unknown', 0 FROM s_conversions)
          GROUP BY 1)""", ["s_campaigns", "s_conversions"]),
    "dim_ad_group": (f"""SELECT {SK('ad_group_id')} AS ad_group_pk, ad_group_id, l.n AS ad_group_name,
          l.c AS campaign_id, {SK('l.c')} AS campaign_pk
        FROM (SELECT ad_group_id, arg_max({{'n': ad_group_name, 'c': campaign_id}},
                                          {{'d': coalesce(segments_date, DATE '0001-01-01'), 'n': ad_group_name,
                                            'c': campaign_id}}) AS l
          FROM (SELECT coalesce(ad_group_id, 'Unknown') AS ad_group_id, ad_group_name,
                       coalesce(campaign_id, 'Unknown') AS campaign_id, segments_date FROM s_keywords
                UNION ALL
                SELECT coalesce(ad_group_id, 'Unknown'), ad_group_name, coalesce(campaign_id, 'Unknown'),
                       CAST(NULL AS DATE) FROM s_ads_data)
          GROUP BY ad_group_id)""", ["s_keywords", "s_ads_data"]),
    "dim_ad": (f"""SELECT {SK('ad_group_id', 'ad_id')} AS ad_pk, ad_id, ad_group_id, l.t AS ad_type, l.s AS ad_status
        FROM (SELECT coalesce(ad_group_id, 'Unknown') AS ad_group_id, coalesce(ad_group_ad_ad_id, 'Unknown') AS ad_id,
                     max({{'t': ad_group_ad_ad_type, 's': ad_group_ad_status}}) AS l
              FROM s_ads_data GROUP BY 1, 2)""", ["s_ads_data"]),
    "dim_keyword": (f"""SELECT {SK('keyword_text', 'keyword_match_type')} AS keyword_pk, keyword_text,
          keyword_match_type
        FROM (SELECT DISTINCT coalesce(keyword, 'Unknown') AS keyword_text,
                              coalesce(keyword_match_type, 'Unknown') AS keyword_match_type FROM s_keywords)""",
                    ["s_keywords"]),
    "dim_age_range": (f"""SELECT {SK('age_range')} AS age_range_pk, age_range
        FROM (SELECT DISTINCT coalesce(age_range, 'Unknown') AS age_range FROM s_ages)""", ["s_ages"]),
    "dim_gender": (f"""SELECT {SK('gender')} AS gender_pk, gender
        FROM (SELECT DISTINCT coalesce(gender, 'Unknown') AS gender FROM s_genders)""", ["s_genders"]),
    "dim_network": (f"""SELECT {SK('network_name')} AS network_pk, network_name
        FROM (SELECT DISTINCT coalesce(ad_network, 'Unknown') AS network_name FROM s_networks)""", ["s_networks"]),
    "dim_date": (f"""SELECT {DK('full_date')} AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
          CAST(month(full_date) AS INTEGER) AS month, CAST(day(full_date) AS INTEGER) AS day_of_month,
          CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week
        FROM (SELECT DISTINCT segments_date AS full_date FROM (
                SELECT segments_date FROM s_campaigns UNION ALL SELECT segments_date FROM s_conversions)
              WHERE segments_date IS NOT NULL)""",
                 ["s_campaigns", "s_conversions"]),
    "fact_campaign_perf": (f"""SELECT {SK('campaign_id')} AS campaign_pk, {DK('segments_date')} AS date_key,
          campaign_id, segments_date,
          coalesce(p.impressions, 0) AS impressions, coalesce(p.clicks, 0) AS clicks,
          coalesce(p.cost_inr, 0.0) AS cost_inr, coalesce(c.conversions, 0.0) AS conversions,
          coalesce(c.conversions_value, 0.0) AS conversions_value
        FROM (SELECT coalesce(campaign_id, 'Unknown') AS campaign_id, segments_date,
                     CAST(sum(metrics_impressions) AS BIGINT) AS impressions,
                     CAST(sum(metrics_clicks) AS BIGINT) AS clicks,
                     CAST(sum(CAST(cost_inr AS {DEC})) AS DOUBLE) AS cost_inr
              FROM s_campaigns GROUP BY 1, 2) p
        FULL JOIN (SELECT coalesce(campaign_id, 'Unknown') AS campaign_id, segments_date,
                     sum(conversions) AS conversions,
                     CAST(sum(CAST(conversions_value AS {DEC})) AS DOUBLE) AS conversions_value
              FROM s_conversions GROUP BY 1, 2) c
        USING (campaign_id, segments_date)""", ["s_campaigns", "s_conversions"]),
    "fact_keyword_perf": (f"""SELECT {SK('keyword', 'keyword_match_type')} AS keyword_pk,
          {SK('ad_group_id')} AS ad_group_pk, {SK('campaign_id')} AS campaign_pk, {DK('segments_date')} AS date_key,
          metrics_impressions AS impressions, metrics_clicks AS clicks, cost_inr, quality_score
        FROM s_keywords""", ["s_keywords"]),
    "fact_age_perf": (f"""SELECT {SK('age_range')} AS age_range_pk, {SK('campaign_id')} AS campaign_pk,
          {SK('ad_group_id')} AS ad_group_pk, {DK('segments_date')} AS date_key, metrics_impressions AS impressions,
          metrics_clicks AS clicks, metrics_conversions AS conversions, cost_inr
        FROM s_ages""", ["s_ages"]),
    "fact_gender_perf": (f"""SELECT {SK('gender')} AS gender_pk, {SK('campaign_id')} AS campaign_pk,
          {SK('ad_group_id')} AS ad_group_pk, {DK('segments_date')} AS date_key, metrics_impressions AS impressions,
          metrics_clicks AS clicks, metrics_conversions AS conversions, cost_inr
        FROM s_genders""", ["s_genders"]),
    "fact_campaign_network_perf": (f"""SELECT {SK('ad_network')} AS network_pk, {SK('campaign_id')} AS campaign_pk,
          {DK('segments_date')} AS date_key, metrics_impressions AS impressions, metrics_clicks AS clicks,
          metrics_conversions AS conversions
        FROM s_networks""", ["s_networks"]),
}

COSTSUM = f"sum(CAST(f.cost_inr AS {DEC}))"


def _rates(cost: str, imp: str | None, clk: str, conv: str | None) -> dict[str, str]:
    out = {"cpc": SR(f"CAST({cost} AS DOUBLE) / NULLIF({clk}, 0)")}
    if conv:
        out["cpl"] = SR(f"CAST({cost} AS DOUBLE) / NULLIF({conv}, 0)")
        out["cvr"] = SR(f"{conv} / NULLIF({clk}, 0) * 100")
    if imp:
        out["ctr"] = SR(f"{clk} / NULLIF({imp}, 0) * 100")
    return out


_r = _rates("cost", "imp", "clk", "conv")
CAMPAIGN_TOTALS = f"""SELECT c.campaign_name, c.campaign_status, {COSTSUM} AS cost,
    CAST(sum(f.impressions) AS BIGINT) AS imp, CAST(sum(f.clicks) AS BIGINT) AS clk, sum(f.conversions) AS conv
  FROM g_fact_campaign_perf f JOIN g_dim_campaign c ON f.campaign_pk = c.campaign_pk
  GROUP BY c.campaign_name, c.campaign_status"""

KPI: dict[str, tuple[str, list[str]]] = {
    "kpi_1_summary": (f"""SELECT campaign_name, campaign_status, CAST(round(cost, 2) AS DOUBLE) AS total_cost_inr,
          imp AS total_impressions, clk AS total_clicks, conv AS total_leads, {_r['cpc']} AS average_cpc,
          {_r['cpl']} AS average_cpl, {_r['ctr']} AS overall_ctr_pct, {_r['cvr']} AS overall_lead_rate_pct
        FROM ({CAMPAIGN_TOTALS})""", ["g_fact_campaign_perf", "g_dim_campaign"]),
    "kpi_2_cpl_ranking": (f"""SELECT campaign_name, campaign_status, CAST(round(cost, 2) AS DOUBLE) AS total_cost_inr,
          clk AS total_clicks, conv AS total_leads, {_r['cvr']} AS lead_rate_pct, {_r['cpl']} AS campaign_cpl
        FROM ({CAMPAIGN_TOTALS}) WHERE conv > 0""", ["g_fact_campaign_perf", "g_dim_campaign"]),
    "kpi_3_top_keywords": (f"""SELECT keyword_text, keyword_match_type, imp AS total_impressions, clk AS total_clicks,
          {_r['ctr']} AS ctr_percentage, {_r['cpc']} AS cost_per_click
        FROM (SELECT k.keyword_text, k.keyword_match_type, CAST(sum(f.impressions) AS BIGINT) AS imp,
                     CAST(sum(f.clicks) AS BIGINT) AS clk, {COSTSUM} AS cost
              FROM g_fact_keyword_perf f JOIN g_dim_keyword k ON f.keyword_pk = k.keyword_pk
              WHERE f.clicks > 0 GROUP BY k.keyword_text, k.keyword_match_type)
        ORDER BY total_clicks DESC, keyword_text, keyword_match_type LIMIT 25""",
                           ["g_fact_keyword_perf", "g_dim_keyword"]),
    "kpi_4_age_performance": ("AUDIENCE:age_range:g_fact_age_perf:g_dim_age_range:age_range_pk",
                              ["g_fact_age_perf", "g_dim_age_range"]),
    "kpi_5_gender_performance": ("AUDIENCE:gender:g_fact_gender_perf:g_dim_gender:gender_pk",
                                 ["g_fact_gender_perf", "g_dim_gender"]),
    "kpi_6_monthly_trend": (f"""SELECT year, month, CAST(round(cost, 2) AS DOUBLE) AS monthly_cost_inr,
          conv AS monthly_leads, {_r['cpl']} AS monthly_cpl_inr
        FROM (SELECT d.year, d.month, {COSTSUM} AS cost, sum(f.conversions) AS conv
              FROM g_fact_campaign_perf f JOIN g_dim_date d ON f.date_key = d.date_key GROUP BY d.year, d.month)""",
                            ["g_fact_campaign_perf", "g_dim_date"]),
    "kpi_7_adgroup_efficiency": (f"""SELECT ad_group_name, campaign_name, imp AS total_impressions,
          clk AS total_clicks, CAST(round(cost, 2) AS DOUBLE) AS total_cost_inr, {_r['ctr']} AS ctr_pct,
          {_r['cpc']} AS avg_cpc_inr
        FROM (SELECT ag.ad_group_name, c.campaign_name, CAST(sum(f.impressions) AS BIGINT) AS imp,
                     CAST(sum(f.clicks) AS BIGINT) AS clk, {COSTSUM} AS cost
              FROM g_fact_keyword_perf f JOIN g_dim_ad_group ag ON f.ad_group_pk = ag.ad_group_pk
              JOIN g_dim_campaign c ON f.campaign_pk = c.campaign_pk
              GROUP BY ag.ad_group_name, c.campaign_name)""",
                                 ["g_fact_keyword_perf", "g_dim_ad_group", "g_dim_campaign"]),
    "kpi_8_network_performance": (f"""SELECT network_name, imp AS total_impressions, clk AS total_clicks,
          conv AS total_leads, {_r['ctr']} AS ctr_pct, {_r['cvr']} AS cvr_pct
        FROM (SELECT n.network_name, CAST(sum(f.impressions) AS BIGINT) AS imp, CAST(sum(f.clicks) AS BIGINT) AS clk,
                     sum(f.conversions) AS conv
              FROM g_fact_campaign_network_perf f JOIN g_dim_network n ON f.network_pk = n.network_pk
              GROUP BY n.network_name)""", ["g_fact_campaign_network_perf", "g_dim_network"]),
    "kpi_9_day_of_week": (f"""SELECT CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday'
            WHEN 4 THEN 'Wednesday' WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END AS day_name,
          day_of_week, imp AS total_impressions, clk AS total_clicks,
          CAST(round(cost, 2) AS DOUBLE) AS total_cost_inr, conv AS total_leads, {_r['cpl']} AS cpl_inr
        FROM (SELECT d.day_of_week, CAST(sum(f.impressions) AS BIGINT) AS imp, CAST(sum(f.clicks) AS BIGINT) AS clk,
                     {COSTSUM} AS cost, sum(f.conversions) AS conv
              FROM g_fact_campaign_perf f JOIN g_dim_date d ON f.date_key = d.date_key GROUP BY d.day_of_week)""",
                          ["g_fact_campaign_perf", "g_dim_date"]),
    "kpi_10_ad_type_dist": ("""SELECT c.campaign_name, a.ad_type, count(a.ad_pk) AS number_of_ads
        FROM g_dim_ad a JOIN g_dim_ad_group ag ON a.ad_group_id = ag.ad_group_id
        JOIN g_dim_campaign c ON ag.campaign_pk = c.campaign_pk
        GROUP BY c.campaign_name, a.ad_type""", ["g_dim_ad", "g_dim_ad_group", "g_dim_campaign"]),
}


def _audience(spec: str) -> str:
    _, label, fact, dim, pk = spec.split(":")
    return f"""SELECT {label}, imp AS total_impressions, clk AS total_clicks, conv AS total_leads,
          CAST(round(cost, 2) AS DOUBLE) AS total_cost_inr, {_r['ctr']} AS ctr_pct, {_r['cpc']} AS cpc_inr,
          {_r['cpl']} AS cpl_inr
        FROM (SELECT d.{label}, CAST(sum(f.impressions) AS BIGINT) AS imp, CAST(sum(f.clicks) AS BIGINT) AS clk,
                     sum(f.conversions) AS conv, {COSTSUM} AS cost
              FROM {fact} f JOIN {dim} d ON f.{pk} = d.{pk} GROUP BY d.{label})"""


for _k, (_sql, _deps) in list(KPI.items()):
    if _sql.startswith("AUDIENCE:"):
        KPI[_k] = (_audience(_sql), _deps)

ROAS = (f"""SELECT campaign_id, n.campaign_name, CAST(round(coalesce(c.cost, 0), 2) AS DOUBLE) AS total_cost_inr,
      CAST(round(coalesce(r.rev, 0), 2) AS DOUBLE) AS total_conversions_value,
      {SR('CAST(coalesce(r.rev, 0) AS DOUBLE) / NULLIF(CAST(coalesce(c.cost, 0) AS DOUBLE), 0)')} AS roas
    FROM (SELECT coalesce(campaign_id, 'Unknown') AS campaign_id, sum(CAST(cost_inr AS {DEC})) AS cost
          FROM s_campaigns GROUP BY 1) c
    FULL JOIN (SELECT coalesce(campaign_id, 'Unknown') AS campaign_id, sum(CAST(conversions_value AS {DEC})) AS rev
          FROM s_conversions GROUP BY 1) r USING (campaign_id)
    LEFT JOIN g_dim_campaign n USING (campaign_id)""", ["s_campaigns", "s_conversions", "g_dim_campaign"])

# The report's titles.
KPI_TITLES = {
    "kpi_1_summary": "KPI 1: High-Level Performance Summary",
    "kpi_2_cpl_ranking": "KPI 2: Campaign Performance Ranking by CPL",
    "kpi_3_top_keywords": "KPI 3: Top 10 Keywords by Clicks",
    "kpi_4_age_performance": "KPI 4: Performance Breakdown by Age Group",
    "kpi_5_gender_performance": "KPI 5: Performance Breakdown by Gender",
    "kpi_6_monthly_trend": "KPI 6: Monthly Performance Trend",
    "kpi_7_adgroup_efficiency": "KPI 7: Ad Group Efficiency",
    "kpi_8_network_performance": "KPI 8: Performance by Ad Network",
    "kpi_9_day_of_week": "KPI 9: Performance by Day of the Week",
    "kpi_10_ad_type_dist": "KPI 10: Ad Type Distribution by Campaign",
}
KPI_LIST = list(KPI_TITLES)

K1 = "k_kpi_1_summary"
SPEND = "sum(CAST(total_cost_inr AS DECIMAL(20,2)))"
ZERO = "(total_impressions > 0 AND total_leads = 0)"


def _acct(cols: str, group: str = "") -> str:
    r = _rates("spend", "imp", "clk", "conv")
    return f"""SELECT {cols} CAST(spend AS DOUBLE) AS {'total_spend_inr' if not group else 'total_cost_inr'},
          imp AS total_impressions, clk AS total_clicks, conv AS total_leads, {r['cpc']} AS average_cpc,
          {r['cpl']} AS average_cpl, {r['ctr']} AS overall_ctr_pct, {r['cvr']} AS overall_lead_rate_pct
        FROM (SELECT {group + ',' if group else ''} count(*) AS campaigns, {SPEND} AS spend,
                     CAST(sum(total_impressions) AS BIGINT) AS imp, CAST(sum(total_clicks) AS BIGINT) AS clk,
                     sum(total_leads) AS conv
              FROM {K1} {'GROUP BY ' + group if group else ''})"""


def _row_counts() -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS kpi_no, '{k}' AS kpi, '{KPI_TITLES[k]}' AS title, count(*) AS row_count FROM k_{k}"
        for i, k in enumerate(KPI_LIST, start=1)
    )


BANDS = "(VALUES ('CTR', 6.5, 8.0, true), ('CPC', 45.0, 65.0, false), ('CPL', 1000.0, 1200.0, false), " \
        "('Lead Rate', 8.0, 10.0, true)) AS b(metric, band_low, band_high, higher_is_better)"

ALL_KPIS = [f"k_{k}" for k in KPI_LIST]

def _money(c: str) -> str:
    return f"'₹' || format('{{:,}}', CAST(round({c}) AS BIGINT))"


def _best_worst(k: str, label: str, metric: str, less: bool) -> str:
    lo, hi = (f"arg_min({label}, {{'v': {metric}, 'n': {label}}})", f"min({metric})"), (
        f"arg_max({label}, {{'v': {metric}, 'n': {label}}})", f"max({metric})")
    best, worst = (lo, hi) if less else (hi, lo)
    return f"""SELECT '{k}' AS kpi, '{metric}' AS metric, count(*) AS entries, {best[0]} AS best, {best[1]} AS best_value,
          {worst[0]} AS worst, {worst[1]} AS worst_value,
          {SR(f"abs({worst[1]} - {best[1]}) / NULLIF({worst[1]}, 0) * 100")} AS gap_pct
        FROM k_{k} WHERE {metric} IS NOT NULL"""


BEST_WORST = [
    ("kpi_2_cpl_ranking", "campaign_name", "campaign_cpl", True), ("kpi_2_cpl_ranking", "campaign_name", "lead_rate_pct", False),
    ("kpi_3_top_keywords", "keyword_text", "ctr_percentage", False), ("kpi_4_age_performance", "age_range", "cpl_inr", True),
    ("kpi_5_gender_performance", "gender", "cpl_inr", True), ("kpi_7_adgroup_efficiency", "ad_group_name", "ctr_pct", False),
    ("kpi_7_adgroup_efficiency", "ad_group_name", "avg_cpc_inr", True), ("kpi_8_network_performance", "network_name", "cvr_pct", False),
    ("kpi_9_day_of_week", "day_name", "cpl_inr", True),
]

REPORTS: dict[str, tuple[str, list[str]]] = {
    "report_account_totals": (_acct("campaigns,"), [K1]),
    "report_by_status": (_acct("campaign_status, campaigns,", "campaign_status"), [K1]),
    "report_zero_conversion": (f"SELECT * FROM {K1} WHERE {ZERO}", [K1]),
    "report_zero_conv_spend_share": (f"""SELECT zc AS zero_conversion_campaigns,
          CAST(coalesce(zs, 0) AS DOUBLE) AS zero_conversion_spend_inr, CAST(ts AS DOUBLE) AS total_spend_inr,
          {SR('CAST(zs AS DOUBLE) / NULLIF(CAST(ts AS DOUBLE), 0) * 100')} AS spend_share_pct
        FROM (SELECT count(CASE WHEN {ZERO} THEN 1 END) AS zc,
                     sum(CASE WHEN {ZERO} THEN CAST(total_cost_inr AS DECIMAL(20,2)) ELSE CAST(0 AS DECIMAL(20,2)) END)
                       AS zs,
                     {SPEND} AS ts FROM {K1})""", [K1]),
    "report_currency": (f"""SELECT campaign_name, campaign_status, total_cost_inr,
          {_money('total_cost_inr')} AS total_cost_display, {_money('average_cpc')} AS average_cpc_display,
          {_money('average_cpl')} AS average_cpl_display FROM {K1}""", [K1]),
    "report_benchmark_bands": (f"""SELECT m.campaign_name, m.campaign_status, m.metric, m.value, b.band_low,
          b.band_high, b.higher_is_better,
          CASE WHEN m.value IS NULL THEN NULL WHEN m.value < b.band_low THEN 'below'
               WHEN m.value > b.band_high THEN 'above' ELSE 'within' END AS band
        FROM (SELECT campaign_name, campaign_status, 'CTR' AS metric, CAST(overall_ctr_pct AS DOUBLE) AS value
              FROM {K1}
              UNION ALL SELECT campaign_name, campaign_status, 'CPC', CAST(average_cpc AS DOUBLE) FROM {K1}
              UNION ALL SELECT campaign_name, campaign_status, 'CPL', CAST(average_cpl AS DOUBLE) FROM {K1}
              UNION ALL SELECT campaign_name, campaign_status, 'Lead Rate', CAST(overall_lead_rate_pct AS DOUBLE)
              FROM {K1}) m
        JOIN (SELECT metric, CAST(band_low AS DOUBLE) AS band_low, CAST(band_high AS DOUBLE) AS band_high,
                     higher_is_better FROM {BANDS}) b ON m.metric = b.metric""", [K1]),
    "report_best_vs_worst": ("""SELECT 'campaign_cpl' AS metric, count(*) AS entries,
          arg_min(campaign_name, {'v': campaign_cpl, 'n': campaign_name}) AS best, min(campaign_cpl) AS best_value,
          arg_max(campaign_name, {'v': campaign_cpl, 'n': campaign_name}) AS worst, max(campaign_cpl) AS worst_value,
          """ + SR("abs(max(campaign_cpl) - min(campaign_cpl)) / NULLIF(max(campaign_cpl), 0) * 100") + """ AS gap_pct
        FROM k_kpi_2_cpl_ranking WHERE campaign_cpl IS NOT NULL""", ["k_kpi_2_cpl_ranking"]),
    "report_sample_flags": (f"""SELECT kpi_no, kpi, title, row_count,
          CASE WHEN row_count = 0 THEN 'empty' WHEN row_count < 3 THEN 'limited' ELSE 'ok' END AS sample_flag
        FROM ({_row_counts()})""", ALL_KPIS),
    "report_pack": (f"""SELECT kpi_no, kpi, title, CASE WHEN row_count = 0 THEN 'empty' ELSE 'ok' END AS status,
          row_count, CAST(NULL AS VARCHAR) AS error FROM ({_row_counts()})""", ALL_KPIS),
    "report_best_vs_worst_kpis": (" UNION ALL ".join(_best_worst(*b) for b in BEST_WORST), sorted({f"k_{b[0]}" for b in BEST_WORST})),
}

MARKDOWN_ORDER = {
    "kpi_1_summary": "total_cost_inr DESC NULLS LAST, campaign_name, campaign_status",
    "kpi_2_cpl_ranking": "campaign_cpl ASC NULLS FIRST, campaign_name, campaign_status",
    "kpi_3_top_keywords": "total_clicks DESC NULLS LAST, keyword_text, keyword_match_type",
    "kpi_4_age_performance": "total_leads DESC NULLS LAST, age_range",
    "kpi_5_gender_performance": "total_leads DESC NULLS LAST, gender",
    "kpi_6_monthly_trend": "year, month",
    "kpi_7_adgroup_efficiency": "ctr_pct DESC NULLS LAST, ad_group_name, campaign_name",
    "kpi_8_network_performance": "total_leads DESC NULLS LAST, network_name",
    "kpi_9_day_of_week": "day_of_week",
    "kpi_10_ad_type_dist": "campaign_name, number_of_ads DESC NULLS LAST, ad_type",
}
KPI_COLUMNS = {
    "kpi_1_summary": ["campaign_name:s", "campaign_status:s", "total_cost_inr:d", "total_impressions:s",
                      "total_clicks:s", "total_leads:d", "average_cpc:d", "average_cpl:d", "overall_ctr_pct:d",
                      "overall_lead_rate_pct:d"],
    "kpi_2_cpl_ranking": ["campaign_name:s", "campaign_status:s", "total_cost_inr:d", "total_clicks:s",
                          "total_leads:d", "lead_rate_pct:d", "campaign_cpl:d"],
    "kpi_3_top_keywords": ["keyword_text:s", "keyword_match_type:s", "total_impressions:s", "total_clicks:s",
                           "ctr_percentage:d", "cost_per_click:d"],
    "kpi_4_age_performance": ["age_range:s", "total_impressions:s", "total_clicks:s", "total_leads:d",
                              "total_cost_inr:d", "ctr_pct:d", "cpc_inr:d", "cpl_inr:d"],
    "kpi_5_gender_performance": ["gender:s", "total_impressions:s", "total_clicks:s", "total_leads:d",
                                 "total_cost_inr:d", "ctr_pct:d", "cpc_inr:d", "cpl_inr:d"],
    "kpi_6_monthly_trend": ["year:s", "month:s", "monthly_cost_inr:d", "monthly_leads:d", "monthly_cpl_inr:d"],
    "kpi_7_adgroup_efficiency": ["ad_group_name:s", "campaign_name:s", "total_impressions:s", "total_clicks:s",
                                 "total_cost_inr:d", "ctr_pct:d", "avg_cpc_inr:d"],
    "kpi_8_network_performance": ["network_name:s", "total_impressions:s", "total_clicks:s", "total_leads:d",
                                  "ctr_pct:d", "cvr_pct:d"],
    "kpi_9_day_of_week": ["day_name:s", "day_of_week:s", "total_impressions:s", "total_clicks:s",
                          "total_cost_inr:d", "total_leads:d", "cpl_inr:d"],
    "kpi_10_ad_type_dist": ["campaign_name:s", "ad_type:s", "number_of_ads:s"],
}


def _truncated(k: str) -> str:
    return f"""SELECT t.*, n.total_rows, n.total_rows > 15 AS truncated,
          CASE WHEN n.total_rows > 15 THEN '*(Showing top 10 of ' || n.total_rows || ' total rows. Full data available in source system.)*'
          END AS note
        FROM (SELECT * FROM k_{k}
              QUALIFY (SELECT count(*) FROM k_{k}) <= 15 OR row_number() OVER (ORDER BY {MARKDOWN_ORDER[k]}) <= 10) t,
             (SELECT count(*) AS total_rows FROM k_{k}) n"""


for _k in KPI_LIST:
    if _k not in ("kpi_1_summary", "kpi_6_monthly_trend"):
        REPORTS[f"report_truncated_{_k}"] = (_truncated(_k), [f"k_{_k}"])
REPORTS["report_truncated"] = REPORTS["report_truncated_kpi_7_adgroup_efficiency"]


def _markdown() -> str:
    parts = []
    for k in KPI_LIST:
        cols = [c.split(":") for c in KPI_COLUMNS[k]]
        cells = ", ".join(
            f"coalesce(printf('%.2f', {c}), '')" if t == "d" else f"coalesce(CAST({c} AS VARCHAR), '')" for c, t in cols
        )
        names = " | ".join(c for c, _ in cols)
        sep = "|" + "|".join([" --- "] * len(cols)) + "|"
        parts.append(f"""SELECT '{k}' AS kpi, CAST(1 AS BIGINT) AS line_no, '## {KPI_TITLES[k]}' AS line
          UNION ALL SELECT '{k}', CAST(2 AS BIGINT), '| {names} |' FROM (SELECT count(*) AS n FROM k_{k}) WHERE n > 0
          UNION ALL SELECT '{k}', CAST(3 AS BIGINT), '{sep}' FROM (SELECT count(*) AS n FROM k_{k}) WHERE n > 0
          UNION ALL SELECT '{k}', CAST(2 AS BIGINT), 'No data available for this KPI.'
            FROM (SELECT count(*) AS n FROM k_{k}) WHERE n = 0
          UNION ALL SELECT '{k}', CAST(row_number() OVER (ORDER BY {MARKDOWN_ORDER[k]}) + 3 AS BIGINT),
            '| ' || concat_ws(' | ', {cells}) || ' |' FROM k_{k}""")
    return " UNION ALL ".join(f"({p})" for p in parts)


REPORTS["report_markdown"] = (_markdown(), ALL_KPIS)

# ---------------------------------------------------------------- assembly


def _ctes() -> dict[str, tuple[str, list[str]]]:
    c: dict[str, tuple[str, list[str]]] = {}
    for s, (b, num, strs, sel) in SILVER.items():
        c[f"b_{b}"] = (bronze(b), [])
        c[f"f_{s}"] = (filled(b, num, strs), [f"b_{b}"])
        c[f"s_{s}"] = (f"SELECT {sel} FROM f_{s}", [f"f_{s}"])
    c["s_locations"] = (LOCATIONS, ["s_locations_base", "s_geo_constants"])
    for g, (sql, deps) in GOLD.items():
        c[f"g_{g}"] = (sql, deps)
    for k, (sql, deps) in KPI.items():
        c[f"k_{k}"] = (sql, deps)
    return c


CTES = _ctes()


def with_ctes(body: str, deps: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for d in deps:
        visit(d)
    if not order:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in order) + "\n" + body


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    for s in list(SILVER) + ["locations"]:
        if s == "locations_base":
            continue
        q[f"silver_{s}"] = with_ctes(f"SELECT * FROM s_{s}", [f"s_{s}"])
    for g in GOLD:
        q[g] = with_ctes(f"SELECT * FROM g_{g}", [f"g_{g}"])
    for k in KPI:
        q[k] = with_ctes(f"SELECT * FROM k_{k}", [f"k_{k}"])
    q["metric_roas"] = with_ctes(ROAS[0], ROAS[1])
    for r, (sql, deps) in REPORTS.items():
        q[r] = with_ctes(sql, deps)
    silver_names = [s for s in SILVER if s != "locations_base"] + ["locations"]
    kinds = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"
    audit_rows = " UNION ALL ".join(
        f"""SELECT '{s}' AS table_name, (SELECT count(*) FROM s_{s}) AS row_count, CAST(count(*) AS INTEGER) AS n_columns,
              string_agg(column_name || ' ' || {kinds}, ',') AS columns FROM (DESCRIBE SELECT * FROM s_{s})""" for s in silver_names
    )
    q["audit_silver"] = with_ctes(
        f"""SELECT * FROM ({audit_rows}) UNION ALL SELECT '__total__', CAST(sum(row_count) AS BIGINT), NULL,
            CAST(count(*) AS VARCHAR) FROM ({audit_rows})""",
        [f"s_{s}" for s in silver_names],
    )
    gold_names = list(GOLD)
    saved = {"bronze": [f"b_{b}" for b in BRONZE_DDL], "silver": [f"s_{s}" for s in silver_names], "gold": [f"g_{g}" for g in gold_names]}
    q["saved_tables"] = with_ctes(" UNION ALL ".join(
        f"""SELECT '{layer}' AS layer, '{t[2:]}' AS table_name, count(*) AS row_count, least(3, count(*)) AS preview_rows FROM {t}"""
        for layer, tables in saved.items() for t in tables), [t for tables in saved.values() for t in tables])
    q["saved_kpi_1_summary"] = q["kpi_1_summary"]
    q["saved_columns"] = with_ctes(" UNION ALL ".join(
        f"""SELECT '{t[2:]}' AS table_name, row_number() OVER () AS position, column_name, {kinds} AS column_type
            FROM (DESCRIBE SELECT * FROM {t})""" for t in saved["silver"]), saved["silver"])
    q["bronze_csv_roundtrip"] = with_ctes("SELECT * FROM b_core_campaign_performance", ["b_core_campaign_performance"])
    q["saved_bronze"] = with_ctes(" UNION ALL ".join(map(_measured, BRONZE_DDL)), saved["bronze"])
    q["saved_kpi_tables"] = with_ctes(" UNION ALL ".join(_digest(k, f"k_{k}") for k in KPI_LIST), [f"k_{k}" for k in KPI_LIST])
    q["saved_month_kpis"] = _month_kpis()
    q["saved_outcomes"] = _outcomes(silver_names, gold_names)
    damaged = {"networks": "damaged", "keywords": "missing", "genders": "missing"}
    kept = " UNION ALL ".join(f"SELECT * FROM ({audit_rows}) WHERE table_name = '{s}'" for s in silver_names if s not in damaged)
    q["audit_saved_silver"] = with_ctes(
        f"""SELECT *, 'ok' AS status FROM ({kept})
            UNION ALL SELECT '__total__', CAST(sum(row_count) AS BIGINT), NULL, CAST(count(*) AS VARCHAR), 'total' FROM ({kept}) """
        + " ".join(f"UNION ALL SELECT '{t}', NULL, NULL, NULL, '{x}'" for t, x in damaged.items()), [f"s_{s}" for s in silver_names])
    unread = ("kpi_3_top_keywords", "kpi_5_gender_performance", "kpi_7_adgroup_efficiency", "kpi_8_network_performance", "kpi_10_ad_type_dist")
    q["report_pack_saved"] = with_ctes(" UNION ALL ".join(
        f"SELECT {n} AS kpi_no, '{k}' AS kpi, '{KPI_TITLES[k]}' AS title, " + (
            "'error' AS status, CAST(NULL AS BIGINT) AS row_count" if k in unread else
            "'empty' AS status, CAST(0 AS BIGINT) AS row_count" if k == "kpi_2_cpl_ranking" else
            f"CASE WHEN count(*) = 0 THEN 'empty' ELSE 'ok' END AS status, count(*) AS row_count FROM k_{k}")
        for n, k in enumerate(KPI_LIST, start=1)), [f"k_{k}" for k in KPI_LIST])
    q["replaced_table"] = with_ctes(
        """SELECT campaign_id, CAST(sum(metrics_clicks) AS BIGINT) AS clicks, count(DISTINCT ad_network) AS networks,
             'ok:,ok:,error:execution,error:analysis' AS saves FROM s_networks GROUP BY campaign_id""", ["s_networks"])
    odd = {"network_performance": ("ok", len(_columns("network_performance")), "", "", ""),
           "asset": ("differs", len(_columns("asset")), "asset.source", "extra", "asset.id bigint")}
    q["bronze_contract"] = " UNION ALL ".join(
        f"SELECT '{b}' AS table_name, '{odd[b][0]}' AS status, {odd[b][1]} AS n_columns, '{odd[b][2]}' AS missing, '{odd[b][3]}' AS surplus, '{odd[b][4]}' AS retyped"
        if b in odd else f"SELECT '{b}', 'missing', NULL, NULL, NULL, NULL" for b in sorted(BRONZE_DDL, key=lambda b: b not in odd))
    q["bronze_csv_quarantine"] = with_ctes(
        """SELECT campaign_id, CAST(sum(1 - bad) AS BIGINT) AS accepted, CAST(sum(bad) AS BIGINT) AS rejected, count(*) AS records,
             CAST(sum(metrics_clicks) FILTER (bad = 0) AS BIGINT) AS clicks FROM (
           SELECT *, CASE WHEN (CAST(campaign_id AS INTEGER) % 5, day(segments_date)) IN ((1, 3), (2, 4), (3, 5)) THEN 1 ELSE 0 END AS bad
           FROM b_core_campaign_performance) GROUP BY campaign_id""", ["b_core_campaign_performance"])
    for b, (broken, empty) in {"ads_data": ("ad_group_ad_ad_responsive_search_ad_headlines", "ad_group_ad_ad_responsive_search_ad_descriptions"),
                               "asset": ("asset_text_asset_text", "asset_sitelink_asset_link_text")}.items():
        q[f"bronze_csv_multiline_{b}"] = with_ctes(
            f"""SELECT * REPLACE ('"a", ' || chr(10) || ',,' || {broken} || chr(10) || chr(10) || ' "" ' AS {broken},
                  CASE WHEN {empty} IS NULL THEN '' END AS {empty}) FROM b_{b}""", [f"b_{b}"])
    return q


def _columns(table: str) -> dict[str, str]:
    """Flattened column names and types of a bronze table, as declared."""
    return {c.replace(".", "_"): kind for c, kind in re.findall(r"`([^`]+)` (\w+)", BRONZE_DDL[table])}


def _measured(table: str) -> str:
    cols = _columns(table)
    cells = " + ".join(f"count(*) - count({c})" for c in cols)
    text = " + ".join([f"coalesce(sum(length({c})), 0)" for c, kind in cols.items() if kind == "STRING"] or ["0"])
    return f"""SELECT '{table}' AS table_name, 'ok' AS status, {len(cols)} AS n_columns, count(*) AS row_count,
        CAST({cells} AS BIGINT) AS null_cells, CAST({text} AS BIGINT) AS text_chars FROM b_{table}"""


def _digest(k: str, table: str) -> str:
    cells = ", ".join(f"coalesce(CAST({f'CAST({c} AS DECIMAL(38,2))' if t == 'd' else c} AS VARCHAR), '')" for c, t in (x.split(":") for x in KPI_COLUMNS[k]))
    return f"""SELECT '{k}' AS kpi, count(*) AS row_count,
        CAST(coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {cells})), 1, 8) AS BIGINT)), 0) AS BIGINT) AS digest FROM {table}"""


def _month_kpis() -> str:
    """Digests of all KPIs over facts of the latest month of dim_date."""
    facts = [g for g in GOLD if g.startswith("fact_")]
    deps = sorted({d for k in KPI_LIST for d in CTES[f"k_{k}"][1]})
    body = with_ctes("", deps).rstrip()
    month = "date_key // 100 = (SELECT max(date_key // 100) FROM g_dim_date)"
    own = [f"m_{g} AS (SELECT * FROM g_{g} WHERE {month})" for g in facts if f"g_{g}" in deps]
    own += [f"p_{k} AS ({re.sub(r'g_fact_', 'm_fact_', CTES[f'k_{k}'][0])})" for k in KPI_LIST]
    return body + ",\n" + ",\n".join(own) + "\n" + " UNION ALL ".join(_digest(k, f"p_{k}") for k in KPI_LIST)


def _outcomes(silver_names: list[str], gold_names: list[str]) -> str:
    """Outcomes of a run whose keyword report breaks and whose gender report is absent."""
    failed = {"dim_ad_group", "dim_keyword", "fact_keyword_perf", "kpi_3_top_keywords", "kpi_7_adgroup_efficiency", "kpi_10_ad_type_dist"}
    absent = {"genders", "dim_gender", "fact_gender_perf", "kpi_5_gender_performance"}
    planned = [("silver", f"s_{s}") for s in silver_names] + [("gold", f"g_{g}") for g in gold_names] + [("analytics", f"k_{k}") for k in KPI_LIST]
    rows = []
    for layer, t in planned:
        name = t[2:]
        fate = "'error', 'execution', NULL" if name == "keywords" else "'skipped', 'failed_input', NULL" if name in failed else \
            "'skipped', 'missing_input', NULL" if name in absent else f"'ok', NULL, (SELECT count(*) FROM {t})"
        rows.append(f"('{layer}', '{name}', {fate})")
    return with_ctes(f"SELECT * FROM (VALUES {', '.join(rows)}) v(layer, table_name, status, cause, row_count)", [t for _, t in planned])
