"""Declarative silver specs (SV-1 .. SV-22).

Twenty-one of the 22 silver tables differ only in data: which columns get a
numeric fill, which get a string fill, which columns are derived (in dependency
levels) and which are kept (with renames).  ``apply_spec`` interprets a spec;
SV-14 additionally joins the geo lookup (see ``silver.enrich_geo``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from adlake.functions import metrics as m

# A derived column: output name and a SQL expression over the flattened names.
Derived = tuple[str, str]


@dataclass(frozen=True)
class TableSpec:
    silver: str
    bronze: str
    num_fill: tuple[str, ...] = ()
    str_fill: tuple[str, ...] = ()
    derived: tuple[tuple[Derived, ...], ...] = ()
    # "src" keeps a column, "src>alias" renames it; None keeps every column.
    output: tuple[str, ...] | None = None
    collapse_underscores: bool = False
    extra_required: tuple[str, ...] = field(default=())

    def output_pairs(self) -> list[tuple[str, str]] | None:
        if self.output is None:
            return None
        out = []
        for o in self.output:
            src, _, alias = o.partition(">")
            out.append((src, alias or src))
        return out

    def derived_names(self) -> set[str]:
        return {name for level in self.derived for name, _ in level}

    def required_columns(self) -> list[str]:
        """Input columns (after flattening) the spec reads."""
        need = list(self.num_fill) + list(self.str_fill) + list(self.extra_required)
        for src, _ in self.output_pairs() or []:
            if src not in self.derived_names():
                need.append(src)
        return list(dict.fromkeys(need))


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's: column names of the report
# tables, null-fill lists, output lists and renames, per silver table.
# ---------------------------------------------------------------------------
IMP, CLK, CONV, COST = "metrics_impressions", "metrics_clicks", "metrics_conversions", "metrics_cost_micros"
CTR, AVG_CPC = "metrics_ctr", "metrics_average_cpc"
SIX_METRICS = (IMP, CLK, COST, CONV, CTR, AVG_CPC)


def _ctr():
    return ("ctr_pct", m.guarded_pct_sql(CLK, IMP))


def _cvr():
    return ("cvr_pct", m.guarded_pct_sql(CONV, CLK))


def _cost():
    return ("cost_inr", m.micros_sql(COST))


def _cpc_from_cost():
    return ("cpc_inr", m.guarded_ratio_sql("cost_inr", CLK))


def _cpc_reported():
    return ("cpc_inr", m.micros_sql(AVG_CPC))


def _ctr_reported():
    return ("ctr_pct", m.pct_sql(CTR))


SPECS: tuple[TableSpec, ...] = (
    TableSpec(
        silver="campaigns",
        bronze="core_campaign_performance",
        num_fill=(IMP, CLK, CTR, COST, AVG_CPC),
        str_fill=("campaign_id", "campaign_name", "campaign_status", "campaign_advertising_channel_type"),
        derived=((_ctr(), _cost()), (_cpc_from_cost(),)),
        output=(
            "campaign_id", "segments_date", "campaign_name", "campaign_status",
            "campaign_advertising_channel_type", IMP, CLK, "ctr_pct", "cpc_inr", "cost_inr",
        ),
    ),
    TableSpec(
        silver="keywords",
        bronze="search_keyword_performance",
        collapse_underscores=True,
        num_fill=("ad_group_criterion_quality_info_quality_score", IMP, CLK, COST),
        str_fill=("campaign_name", "ad_group_name", "ad_group_criterion_keyword_text",
                  "ad_group_criterion_keyword_match_type"),
        derived=((_cost(), _ctr()), (_cpc_from_cost(),)),
        output=(
            "segments_date", "campaign_id", "ad_group_id", "campaign_name", "ad_group_name",
            "ad_group_criterion_keyword_text>keyword",
            "ad_group_criterion_keyword_match_type>keyword_match_type",
            "ad_group_criterion_quality_info_quality_score>quality_score",
            IMP, CLK, "ctr_pct", "cpc_inr", "cost_inr",
        ),
    ),
    TableSpec(
        silver="search_terms",
        bronze="search_term_analysis",
        num_fill=(IMP, CLK, CONV, COST, AVG_CPC, CTR),
        str_fill=("campaign_name", "ad_group_name", "search_term_view_search_term", "search_term_view_status",
                  "segments_search_term_match_type", "segments_keyword_ad_group_criterion",
                  "segments_keyword_info_text", "segments_keyword_info_match_type"),
        derived=((
            ("triggering_keyword_criterion_id", m.criterion_id_sql("segments_keyword_ad_group_criterion")),
            _cost(), _cpc_reported(), _ctr(),
        ),),
        output=(
            "segments_date", "campaign_id", "ad_group_id", "campaign_name", "ad_group_name",
            "search_term_view_search_term>search_term",
            "search_term_view_status>search_term_status",
            "segments_search_term_match_type>search_term_match_type",
            "triggering_keyword_criterion_id",
            "segments_keyword_info_text>triggering_keyword_text",
            "segments_keyword_info_match_type>triggering_keyword_match_type",
            IMP, CLK, CONV, "cost_inr", "cpc_inr", "ctr_pct",
        ),
    ),
    TableSpec(
        silver="conversions",
        bronze="conversion_performance",
        num_fill=("metrics_all_conversions", "metrics_all_conversions_value", "metrics_conversions",
                  "metrics_conversions_value", "metrics_value_per_conversion",
                  "metrics_value_per_all_conversions"),
        str_fill=("segments_conversion_action", "segments_conversion_action_name",
                  "segments_conversion_action_category"),
        derived=((
            ("value_per_all_conversions",
             m.guarded_ratio_sql("metrics_all_conversions_value", "metrics_all_conversions")),
            ("value_per_conversion", m.guarded_ratio_sql("metrics_conversions_value", "metrics_conversions")),
        ),),
        output=(
            "segments_date", "campaign_id", "campaign_name",
            "segments_conversion_action>conversion_action",
            "segments_conversion_action_name>conversion_action_name",
            "segments_conversion_action_category>conversion_action_category",
            "metrics_conversions>conversions", "metrics_conversions_value>conversions_value",
            "value_per_conversion",
            "metrics_all_conversions>all_conversions", "metrics_all_conversions_value>all_conversions_value",
            "value_per_all_conversions",
        ),
    ),
    TableSpec(
        silver="ad_copy",
        bronze="ad_copy_and_landing_page_performance",
        num_fill=(IMP, CLK, CONV),
        str_fill=("campaign_name", "ad_group_name", "ad_group_ad_ad_final_urls"),
        derived=((_ctr(), _cvr(), ("domain", m.url_host_sql("ad_group_ad_ad_final_urls"))),),
        output=(
            "segments_date", "campaign_id", "ad_group_id", "campaign_name", "ad_group_name",
            "ad_group_ad_ad_id>ad_id", IMP, CLK, CONV, "ctr_pct", "cvr_pct",
            "ad_group_ad_ad_final_urls>final_url", "domain",
        ),
    ),
    TableSpec(
        silver="devices",
        bronze="optimization_device_and_time",
        num_fill=("segments_hour", IMP, CLK, CONV, COST, CTR, AVG_CPC),
        str_fill=("segments_device", "segments_day_of_week"),
        derived=((_ctr(), _cvr(), _cost(), _cpc_reported(),
                  ("time_of_day", m.day_part_sql("segments_hour"))),),
        output=(
            "segments_date", "campaign_id", "segments_device>device", "segments_day_of_week>day_of_week",
            "segments_hour>hour", "time_of_day", IMP, CLK, "ctr_pct", CONV, "cvr_pct", "cost_inr", "cpc_inr",
        ),
    ),
    TableSpec(
        silver="genders",
        bronze="audience_gender_performance",
        num_fill=(IMP, CLK, CONV, COST),
        str_fill=("campaign_name", "ad_group_criterion_gender_type"),
        derived=((_ctr(), _cvr(), _cost()),),
        output=(
            "segments_date", "campaign_id", "ad_group_id", "campaign_name",
            "ad_group_criterion_gender_type>gender", IMP, CLK, CONV, "ctr_pct", "cvr_pct", "cost_inr",
        ),
    ),
    TableSpec(
        silver="ages",
        bronze="audience_age_performance",
        num_fill=(IMP, CLK, CONV, COST),
        str_fill=("campaign_name", "ad_group_criterion_age_range_type"),
        derived=((_ctr(), _cvr(), ("age_range", m.age_label_sql("ad_group_criterion_age_range_type")),
                  _cost()),),
        output=(
            "segments_date", "campaign_id", "ad_group_id", "campaign_name", "age_range",
            IMP, CLK, CONV, "ctr_pct", "cvr_pct", "cost_inr",
        ),
    ),
    TableSpec(
        silver="impressions",
        bronze="competitive_impression_share",
        num_fill=("metrics_search_impression_share", "metrics_search_top_impression_share",
                  "metrics_search_absolute_top_impression_share"),
        str_fill=("campaign_name",),
        derived=((
            ("search_impression_share_pct", m.pct_sql("metrics_search_impression_share")),
            ("search_top_is_pct", m.pct_sql("metrics_search_top_impression_share")),
            ("search_abs_top_is_pct", m.pct_sql("metrics_search_absolute_top_impression_share")),
            ("search_lost_is_pct", m.lost_pct_sql("metrics_search_impression_share")),
        ),),
        output=(
            "segments_date", "campaign_id", "campaign_name",
            "search_impression_share_pct>impression_share_pct",
            "search_top_is_pct>top_impression_share_pct",
            "search_abs_top_is_pct>abs_top_impression_share_pct",
            "search_lost_is_pct>lost_impression_share_pct",
        ),
    ),
    TableSpec(
        silver="networks",
        bronze="network_performance",
        num_fill=(IMP, CLK, CONV),
        str_fill=("campaign_name", "segments_ad_network_type"),
        derived=((_ctr(), _cvr()),),
        output=(
            "segments_date", "campaign_id", "campaign_name", "segments_ad_network_type>ad_network",
            IMP, CLK, CONV, "ctr_pct", "cvr_pct",
        ),
    ),
    TableSpec(
        silver="display_ads",
        bronze="display_ad_viewability",
        num_fill=("metrics_active_view_impressions", "metrics_active_view_measurability",
                  "metrics_active_view_viewability", "metrics_active_view_cpm"),
        str_fill=("campaign_name", "ad_group_name"),
        derived=(
            (("actual_cpm", m.micros_sql("metrics_active_view_cpm")),),
            (("total_cost", m.cpm_cost_sql("metrics_active_view_impressions", "actual_cpm")),),
        ),
        output=(
            "segments_date", "campaign_name", "ad_group_name", "metrics_active_view_impressions",
            "metrics_active_view_measurability>measurability_pct",
            "metrics_active_view_viewability>viewability_pct",
            "actual_cpm>cpm", "total_cost",
        ),
    ),
    TableSpec(
        silver="calls",
        bronze="call_lead_generation",
        num_fill=("metrics_phone_calls", "metrics_phone_impressions", "metrics_phone_through_rate"),
        str_fill=("campaign_name", "ad_group_name"),
        derived=((("phone_through_rate_pct", m.pct_sql("metrics_phone_through_rate")),),),
        output=(
            "segments_date", "campaign_name", "ad_group_name", "metrics_phone_impressions",
            "metrics_phone_calls", "phone_through_rate_pct",
        ),
    ),
    TableSpec(
        silver="geo_constants",
        bronze="geo_target_constant",
        str_fill=("geo_target_constant_id", "geo_target_constant_name", "geo_target_constant_canonical_name",
                  "geo_target_constant_country_code", "geo_target_constant_target_type"),
        output=(
            "geo_target_constant_id>constant_id", "geo_target_constant_name>name",
            "geo_target_constant_canonical_name>canonical_name",
            "geo_target_constant_country_code>country_code",
            "geo_target_constant_target_type>target_type",
        ),
    ),
    TableSpec(
        silver="locations",
        bronze="geographic_performance",
        num_fill=(IMP, CLK, CONV, COST),
        str_fill=("segments_geo_target_city", "geographic_view_location_type"),
        derived=((_cost(), _ctr(), _cvr(), ("city_id", m.trailing_id_sql("segments_geo_target_city"))),),
        output=(
            "segments_date", "campaign_id", "city_id", "geographic_view_location_type>location_type",
            IMP, CLK, "ctr_pct", CONV, "cvr_pct", "cost_inr",
        ),
    ),
    TableSpec(
        silver="ads_performance",
        bronze="ads_performance",
        num_fill=(IMP, CLK, CONV, COST),
        str_fill=("ad_group_id", "ad_group_ad_ad_id"),
        derived=((_cost(),),),
        output=("ad_group_id", "ad_group_ad_ad_id", IMP, CLK, CONV, "cost_inr"),
    ),
    TableSpec(
        silver="ads_data",
        bronze="ads_data",
        str_fill=(
            "campaign_id", "campaign_name",
            "ad_group_id", "ad_group_name",
            "ad_group_ad_ad_id", "ad_group_ad_ad_type", "ad_group_ad_status",
            "ad_group_ad_ad_final_urls",
            "ad_group_ad_ad_responsive_search_ad_headlines",
            "ad_group_ad_ad_responsive_search_ad_descriptions",
            "ad_group_ad_ad_expanded_text_ad_headline_part1",
            "ad_group_ad_ad_expanded_text_ad_headline_part2",
            "ad_group_ad_ad_expanded_text_ad_headline_part3",
            "ad_group_ad_ad_expanded_text_ad_description",
            "ad_group_ad_ad_expanded_text_ad_description2",
            "ad_group_ad_ad_responsive_display_ad_long_headline",
            "ad_group_ad_ad_responsive_display_ad_headlines",
            "ad_group_ad_ad_responsive_display_ad_descriptions",
            "ad_group_ad_ad_image_ad_image_url",
            "ad_group_ad_ad_image_ad_mime_type",
        ),
        output=None,
    ),
    TableSpec(
        silver="campaign_assets",
        bronze="campaign_asset",
        num_fill=SIX_METRICS,
        str_fill=("campaign_name", "campaign_status", "asset_type", "campaign_asset_status", "segments_device"),
        derived=((_ctr_reported(), _cost(), _cpc_reported()),),
        output=(
            "segments_date", "campaign_id", "campaign_name", "campaign_status", "asset_id", "asset_type",
            "campaign_asset_status>asset_status", "segments_device>device",
            IMP, CLK, CONV, "ctr_pct", "cpc_inr", "cost_inr",
        ),
    ),
    TableSpec(
        silver="ad_group_ad_assets",
        bronze="ad_group_ad_asset_view",
        num_fill=SIX_METRICS,
        str_fill=("campaign_name", "ad_group_name", "ad_group_ad_asset_view_asset",
                  "ad_group_ad_asset_view_field_type", "segments_device"),
        derived=((_ctr_reported(), _cost(), _cpc_reported()),),
        output=(
            "segments_date", "campaign_id", "campaign_name", "ad_group_id", "ad_group_name",
            "ad_group_ad_asset_view_asset>asset", "ad_group_ad_asset_view_field_type>field_type",
            "segments_device>device", IMP, CLK, CONV, "ctr_pct", "cpc_inr", "cost_inr",
        ),
    ),
    TableSpec(
        silver="assets",
        bronze="asset",
        str_fill=("asset_type", "asset_source", "asset_text_asset_text", "asset_image_asset_full_size_url",
                  "asset_sitelink_asset_link_text", "asset_callout_asset_callout_text",
                  "asset_structured_snippet_asset_header", "asset_structured_snippet_asset_values"),
        output=(
            "asset_id", "asset_type", "asset_source",
            "asset_text_asset_text>text_asset_text",
            "asset_image_asset_full_size_url>image_url",
            "asset_sitelink_asset_link_text>sitelink_text",
            "asset_callout_asset_callout_text>callout_text",
            "asset_structured_snippet_asset_header>snippet_header",
            "asset_structured_snippet_asset_values>snippet_values",
        ),
    ),
    TableSpec(
        silver="conversion_actions",
        bronze="conversion_action",
        num_fill=("conversion_action_click_through_lookback_window_days",
                  "conversion_action_view_through_lookback_window_days"),
        str_fill=("conversion_action_name", "conversion_action_status", "conversion_action_category",
                  "conversion_action_primary_for_goal", "conversion_action_counting_type",
                  "conversion_action_attribution_model_settings_attribution_model",
                  "conversion_action_include_in_conversions_metric"),
        output=(
            "conversion_action_id",
            "conversion_action_name>name",
            "conversion_action_status>status",
            "conversion_action_category>category",
            "conversion_action_primary_for_goal>primary_for_goal",
            "conversion_action_counting_type>counting_type",
            "conversion_action_attribution_model_settings_attribution_model>attribution_model",
            "conversion_action_click_through_lookback_window_days>click_through_lookback_window_days",
            "conversion_action_view_through_lookback_window_days>view_through_lookback_window_days",
            "conversion_action_include_in_conversions_metric>include_in_conversions",
        ),
    ),
    TableSpec(
        silver="placements",
        bronze="placement_performance",
        num_fill=SIX_METRICS,
        str_fill=("campaign_name", "campaign_advertising_channel_type", "ad_group_name",
                  "detail_placement_view_placement", "detail_placement_view_placement_type",
                  "detail_placement_view_display_name", "detail_placement_view_group_placement_target_url"),
        derived=((_ctr_reported(), _cost(), _cpc_reported()),),
        output=(
            "segments_date", "campaign_id", "campaign_name", "campaign_advertising_channel_type",
            "ad_group_id", "ad_group_name",
            "detail_placement_view_placement>placement",
            "detail_placement_view_placement_type>placement_type",
            "detail_placement_view_display_name>display_name",
            "detail_placement_view_group_placement_target_url>group_placement_target_url",
            IMP, CLK, CONV, "ctr_pct", "cpc_inr", "cost_inr",
        ),
    ),
    TableSpec(
        silver="group_placements",
        bronze="group_placement_performance",
        num_fill=SIX_METRICS,
        str_fill=("campaign_name", "campaign_advertising_channel_type", "ad_group_name",
                  "group_placement_view_placement", "group_placement_view_placement_type",
                  "group_placement_view_display_name"),
        derived=((_ctr_reported(), _cost(), _cpc_reported()),),
        output=(
            "segments_date", "campaign_id", "campaign_name", "campaign_advertising_channel_type",
            "ad_group_id", "ad_group_name",
            "group_placement_view_placement>placement",
            "group_placement_view_placement_type>placement_type",
            "group_placement_view_display_name>display_name",
            IMP, CLK, CONV, "ctr_pct", "cpc_inr", "cost_inr",
        ),
    ),
)

SPEC_BY_SILVER: dict[str, TableSpec] = {s.silver: s for s in SPECS}
SPEC_BY_BRONZE: dict[str, TableSpec] = {s.bronze: s for s in SPECS}
SILVER_TABLES: tuple[str, ...] = tuple(s.silver for s in SPECS)
BRONZE_TABLES: tuple[str, ...] = tuple(s.bronze for s in SPECS)
