"""Bronze sources and landing: SRC-1, SRC-2, SNK-1."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adlake.operators.spec import BRONZE_TABLES

# Declared input schemas of the 22 report types (bronze contract).  Ids and
# resource names are strings: the report API's 64-bit ids, and a string fill
# must reach them (trap T3: an inferred bigint id would stay null).  Metrics
# are BIGINT counts / micros and DOUBLE rates / values; dates are DATE.
BRONZE_DDL: dict[str, str] = {
    "core_campaign_performance": (
        "`campaign.id` STRING, `segments.date` DATE, `campaign.name` STRING, `campaign.status` STRING, "
        "`campaign.advertising_channel_type` STRING, `metrics.impressions` BIGINT, `metrics.clicks` BIGINT, "
        "`metrics.ctr` DOUBLE, `metrics.cost_micros` BIGINT, `metrics.average_cpc` DOUBLE"
    ),
    "search_keyword_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `ad_group.id` STRING, `campaign.name` STRING, "
        "`ad_group.name` STRING, `ad_group_criterion.keyword.text` STRING, "
        "`ad_group_criterion.keyword.match_type` STRING, "
        "`ad_group_criterion.quality_info.quality_score` BIGINT, `metrics.impressions` BIGINT, "
        "`metrics.clicks` BIGINT, `metrics.cost_micros` BIGINT"
    ),
    "search_term_analysis": (
        "`segments.date` DATE, `campaign.id` STRING, `ad_group.id` STRING, `campaign.name` STRING, "
        "`ad_group.name` STRING, `search_term_view.search_term` STRING, `search_term_view.status` STRING, "
        "`segments.search_term_match_type` STRING, `segments.keyword.ad_group_criterion` STRING, "
        "`segments.keyword.info.text` STRING, `segments.keyword.info.match_type` STRING, "
        "`metrics.impressions` BIGINT, `metrics.clicks` BIGINT, `metrics.conversions` DOUBLE, "
        "`metrics.cost_micros` BIGINT, `metrics.average_cpc` DOUBLE, `metrics.ctr` DOUBLE"
    ),
    "conversion_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, "
        "`segments.conversion_action` STRING, `segments.conversion_action_name` STRING, "
        "`segments.conversion_action_category` STRING, `metrics.conversions` DOUBLE, "
        "`metrics.conversions_value` DOUBLE, `metrics.all_conversions` DOUBLE, "
        "`metrics.all_conversions_value` DOUBLE, `metrics.value_per_conversion` DOUBLE, "
        "`metrics.value_per_all_conversions` DOUBLE"
    ),
    "ad_copy_and_landing_page_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `ad_group.id` STRING, `campaign.name` STRING, "
        "`ad_group.name` STRING, `ad_group_ad.ad.id` STRING, `ad_group_ad.ad.final_urls` STRING, "
        "`metrics.impressions` BIGINT, `metrics.clicks` BIGINT, `metrics.conversions` DOUBLE"
    ),
    "optimization_device_and_time": (
        "`segments.date` DATE, `campaign.id` STRING, `segments.device` STRING, "
        "`segments.day_of_week` STRING, `segments.hour` INT, `metrics.impressions` BIGINT, "
        "`metrics.clicks` BIGINT, `metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT, "
        "`metrics.ctr` DOUBLE, `metrics.average_cpc` DOUBLE"
    ),
    "audience_gender_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `ad_group.id` STRING, `campaign.name` STRING, "
        "`ad_group_criterion.gender.type` STRING, `metrics.impressions` BIGINT, `metrics.clicks` BIGINT, "
        "`metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT"
    ),
    "audience_age_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `ad_group.id` STRING, `campaign.name` STRING, "
        "`ad_group_criterion.age_range.type` STRING, `metrics.impressions` BIGINT, `metrics.clicks` BIGINT, "
        "`metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT"
    ),
    "competitive_impression_share": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, "
        "`metrics.search_impression_share` DOUBLE, `metrics.search_top_impression_share` DOUBLE, "
        "`metrics.search_absolute_top_impression_share` DOUBLE"
    ),
    "network_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, "
        "`segments.ad_network_type` STRING, `metrics.impressions` BIGINT, `metrics.clicks` BIGINT, "
        "`metrics.conversions` DOUBLE"
    ),
    "display_ad_viewability": (
        "`segments.date` DATE, `campaign.name` STRING, `ad_group.name` STRING, "
        "`metrics.active_view_impressions` BIGINT, `metrics.active_view_measurability` DOUBLE, "
        "`metrics.active_view_viewability` DOUBLE, `metrics.active_view_cpm` DOUBLE"
    ),
    "call_lead_generation": (
        "`segments.date` DATE, `campaign.name` STRING, `ad_group.name` STRING, `metrics.phone_calls` BIGINT, "
        "`metrics.phone_impressions` BIGINT, `metrics.phone_through_rate` DOUBLE"
    ),
    "geo_target_constant": (
        "`geo_target_constant.id` STRING, `geo_target_constant.name` STRING, "
        "`geo_target_constant.canonical_name` STRING, `geo_target_constant.country_code` STRING, "
        "`geo_target_constant.target_type` STRING"
    ),
    "geographic_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `segments.geo_target_city` STRING, "
        "`geographic_view.location_type` STRING, `metrics.impressions` BIGINT, `metrics.clicks` BIGINT, "
        "`metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT"
    ),
    "ads_performance": (
        "`ad_group.id` STRING, `ad_group_ad.ad.id` STRING, `metrics.impressions` BIGINT, "
        "`metrics.clicks` BIGINT, `metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT"
    ),
    "ads_data": (
        "`campaign.id` STRING, `campaign.name` STRING, `ad_group.id` STRING, `ad_group.name` STRING, "
        "`ad_group_ad.ad.id` STRING, `ad_group_ad.ad.type` STRING, `ad_group_ad.status` STRING, "
        "`ad_group_ad.ad.final_urls` STRING, `ad_group_ad.ad.responsive_search_ad.headlines` STRING, "
        "`ad_group_ad.ad.responsive_search_ad.descriptions` STRING, "
        "`ad_group_ad.ad.expanded_text_ad.headline_part1` STRING, "
        "`ad_group_ad.ad.expanded_text_ad.headline_part2` STRING, "
        "`ad_group_ad.ad.expanded_text_ad.headline_part3` STRING, "
        "`ad_group_ad.ad.expanded_text_ad.description` STRING, "
        "`ad_group_ad.ad.expanded_text_ad.description2` STRING, "
        "`ad_group_ad.ad.responsive_display_ad.long_headline` STRING, "
        "`ad_group_ad.ad.responsive_display_ad.headlines` STRING, "
        "`ad_group_ad.ad.responsive_display_ad.descriptions` STRING, "
        "`ad_group_ad.ad.image_ad.image_url` STRING, `ad_group_ad.ad.image_ad.mime_type` STRING, "
        "`ad_group_ad.ad.language` STRING, `ad_group_ad.ad.text_length` BIGINT"
    ),
    "campaign_asset": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, `campaign.status` STRING, "
        "`asset.id` STRING, `asset.type` STRING, `campaign_asset.status` STRING, `segments.device` STRING, "
        "`metrics.impressions` BIGINT, `metrics.clicks` BIGINT, `metrics.conversions` DOUBLE, "
        "`metrics.cost_micros` BIGINT, `metrics.ctr` DOUBLE, `metrics.average_cpc` DOUBLE"
    ),
    "ad_group_ad_asset_view": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, `ad_group.id` STRING, "
        "`ad_group.name` STRING, `ad_group_ad_asset_view.asset` STRING, "
        "`ad_group_ad_asset_view.field_type` STRING, `segments.device` STRING, `metrics.impressions` BIGINT, "
        "`metrics.clicks` BIGINT, `metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT, "
        "`metrics.ctr` DOUBLE, `metrics.average_cpc` DOUBLE"
    ),
    "asset": (
        "`asset.id` STRING, `asset.type` STRING, `asset.source` STRING, `asset.text_asset.text` STRING, "
        "`asset.image_asset.full_size_url` STRING, `asset.sitelink_asset.link_text` STRING, "
        "`asset.callout_asset.callout_text` STRING, `asset.structured_snippet_asset.header` STRING, "
        "`asset.structured_snippet_asset.values` STRING"
    ),
    "conversion_action": (
        "`conversion_action.id` STRING, `conversion_action.name` STRING, `conversion_action.status` STRING, "
        "`conversion_action.category` STRING, `conversion_action.primary_for_goal` STRING, "
        "`conversion_action.counting_type` STRING, "
        "`conversion_action.attribution_model_settings.attribution_model` STRING, "
        "`conversion_action.click_through_lookback_window_days` BIGINT, "
        "`conversion_action.view_through_lookback_window_days` BIGINT, "
        "`conversion_action.include_in_conversions_metric` STRING"
    ),
    "placement_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, "
        "`campaign.advertising_channel_type` STRING, `ad_group.id` STRING, `ad_group.name` STRING, "
        "`detail_placement_view.placement` STRING, `detail_placement_view.placement_type` STRING, "
        "`detail_placement_view.display_name` STRING, "
        "`detail_placement_view.group_placement_target_url` STRING, `metrics.impressions` BIGINT, "
        "`metrics.clicks` BIGINT, `metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT, "
        "`metrics.ctr` DOUBLE, `metrics.average_cpc` DOUBLE"
    ),
    "group_placement_performance": (
        "`segments.date` DATE, `campaign.id` STRING, `campaign.name` STRING, "
        "`campaign.advertising_channel_type` STRING, `ad_group.id` STRING, `ad_group.name` STRING, "
        "`group_placement_view.placement` STRING, `group_placement_view.placement_type` STRING, "
        "`group_placement_view.display_name` STRING, `metrics.impressions` BIGINT, `metrics.clicks` BIGINT, "
        "`metrics.conversions` DOUBLE, `metrics.cost_micros` BIGINT, `metrics.ctr` DOUBLE, "
        "`metrics.average_cpc` DOUBLE"
    ),
}
CORE_CAMPAIGN_DDL = BRONZE_DDL["core_campaign_performance"]

# Report types with free text (ad copy, asset texts) whose quoted fields may
# span lines.  Multi-line CSV files cannot be split, so only these pay for it;
# their exports should arrive as many files for parallelism.
MULTILINE_REPORTS = frozenset({"ads_data", "asset"})


#: The raw text of a record that could not be parsed, and the folders that accepted and rejected records are landed in.
RAW, PART = "_raw_record", "part"
ACCEPTED, REJECTED = "accepted", "rejected"


def csv_options(multiline: bool = False, quarantine: bool = False, rfc: bool = False) -> dict[str, str]:
    """The reader options that batch and incremental landing share.

    A record that does not fit the schema stops the job, or is kept as raw text with ``quarantine``; none becomes nulls.
    ``rfc`` is for files as ``write_csv`` makes them: quotes are doubled inside quotes, and a quoted empty field is an empty string,
    where it is null otherwise (a field that is one NUL character is null then).
    """
    own = {"header": "true", "multiLine": str(multiline).lower()}
    own |= {"escape": '"', "nullValue": "\x00"} if rfc else {}
    return own | ({"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW} if quarantine else {"mode": "FAILFAST"})


def read_csv(spark: SparkSession, path: str | list[str], schema: str | StructType | None = None,
             multiline: bool = False, rfc: bool = False) -> DataFrame:
    """SRC-1: distributed CSV scan with a header.

    With a declared schema there is no inference pass over the data; without
    one the schema is inferred (an extra full read, as the reference's pandas
    read does).  ``multiline`` accepts quoted fields spanning lines.
    """
    r = spark.read.options(**csv_options(multiline, rfc=rfc))
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, quotes doubled inside quotes; nulls are empty, empty strings are quoted."""
    df.write.mode("overwrite").options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def land_csv(spark: SparkSession, csv_path: str, bronze_path: str, schema: str | StructType | None = None,
             multiline: bool = False, rfc: bool = False) -> DataFrame:
    """SRC-1 + SNK-1: land raw CSV as Parquet (overwrite, parent folders created).

    Returns the landed table read back from its files.
    """
    read_csv(spark, csv_path, schema, multiline, rfc).write.mode("overwrite").parquet(bronze_path)
    return spark.read.parquet(bronze_path)


def declared(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def split_rejects(rows: DataFrame, schema: StructType) -> DataFrame:
    """Rows of a quarantining reader with ``part`` (accepted or rejected), the raw record and its file; a rejected row has no
    other values, as what could be parsed of it is not to be trusted."""
    bad = F.col(RAW).isNotNull()
    return rows.select(
        *[F.when(~bad, F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields], RAW,
        F.when(bad, F.col("_metadata.file_name")).alias("_source_file"),
        F.when(bad, REJECTED).otherwise(ACCEPTED).alias(PART))


def land_csv_quarantine(spark: SparkSession, csv_path: str | list[str], bronze_path: str, schema: str | StructType, multiline: bool = False,
                        rfc: bool = False) -> tuple[DataFrame, DataFrame]:
    """SRC-1 + SNK-1 with rejects: (accepted rows, rejected records with their raw text and file).

    The files are parsed once; one job writes both, each to its folder, so that both are there or neither.  A record
    with too few or too many fields, or with a field that does not fit its type, is rejected.
    """
    schema = declared(schema)
    reader = spark.read.options(**csv_options(multiline, quarantine=True, rfc=rfc))
    rows = reader.schema(StructType([*schema.fields, StructField(RAW, StringType())])).csv(csv_path)
    split_rejects(rows, schema).write.mode("overwrite").partitionBy(PART).parquet(bronze_path)
    return landed(spark, bronze_path, schema)


def landed(spark: SparkSession, bronze_path: str, schema: str | StructType) -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected records (raw text, file) of a quarantining landing; a filter on the folder's name reads one of both."""
    schema = declared(schema)
    every = StructType([*schema.fields, *StructType.fromDDL(f"{RAW} string, _source_file string, {PART} string").fields])
    rows = spark.read.schema(every).parquet(bronze_path)
    accepted = rows.where(F.col(PART) == ACCEPTED).select(*[F.col(f"`{f.name}`") for f in schema.fields])
    return accepted, rows.where(F.col(PART) == REJECTED).select(F.col(RAW).alias("record"), F.col("_source_file").alias("source_file"))


def read_bronze(spark: SparkSession, db: str, tables: tuple[str, ...] = BRONZE_TABLES) -> dict[str, DataFrame]:
    """SRC-2: the bronze catalog tables that exist in ``db``."""
    have = {t.name for t in spark.catalog.listTables(db) if not t.isTemporary}
    return {t: spark.table(f"{db}.{t}") for t in tables if t in have}


def check_bronze(spark: SparkSession, db: str, tables: tuple[str, ...] = BRONZE_TABLES) -> DataFrame:
    """SRC-2: every bronze table of the contract against what a database has, from the catalog alone (no data is read).

    One row each: status (``ok`` / ``differs`` / ``missing``), and the columns that are missing, surplus or of another type, in
    the contract's (surplus: the table's) order.
    """
    have, rows = read_bronze(spark, db, tables), []
    for name in tables:
        if name not in have:
            rows.append((name, "missing", None, None, None, None))
            continue
        want = {f.name: f.dataType for f in declared(BRONZE_DDL[name]).fields}
        got = {f.name: f.dataType for f in have[name].schema.fields}
        missing, surplus = [c for c in want if c not in got], [c for c in got if c not in want]
        retyped = [f"{c} {got[c].simpleString()}" for c in want if c in got and got[c] != want[c]]
        rows.append((name, "differs" if missing or surplus or retyped else "ok", len(got), *map(",".join, (missing, surplus, retyped))))
    return spark.createDataFrame(rows, "table_name string, status string, n_columns int, missing string, surplus string, retyped string")


def measure_bronze(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, empty cells and characters of text of every table; one scan and one partial aggregate each."""
    parts = []
    for name, df in tables.items():
        cells = " + ".join(f"CAST(`{c}` IS NULL AS BIGINT)" for c in df.columns)
        text = " + ".join([f"coalesce(char_length(`{c}`), 0)" for c, kind in df.dtypes if kind == "string"] or ["0"])
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), F.expr(f"coalesce(sum({cells}), 0)").alias("null_cells"),
                            F.expr(f"CAST(coalesce(sum({text}), 0) AS BIGINT)").alias("text_chars")).select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)
