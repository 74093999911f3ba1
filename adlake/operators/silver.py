"""Silver layer: SV-1..SV-22 from bronze DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.clean import apply_spec
from adlake.operators.layer import LazyLayer
from adlake.operators.spec import SPECS, SPEC_BY_SILVER

# Rows without a city share one empty key; they are dealt out over this many.
EMPTY_CITY_SALTS = 64


def enrich_geo(locations: DataFrame, geo: DataFrame) -> DataFrame:
    """SV-14 / JN-1 / PRJ-9: locations LEFT JOIN geo constants on city_id = constant_id.

    Every location row is kept once: of several constants with one id the smallest
    (name, canonical name, country) stands; unmatched rows get null city attributes.
    Whether the constants are broadcast is the planner's choice, by their bytes.  The
    empty city, a key that very many rows can share, is salted on both sides; AQE
    splits any other skewed city.
    """
    attrs = ["city_name", "canonical_name", "country_code"]
    g = geo.select(
        F.col("constant_id"),
        F.col("name").alias("city_name"),
        F.col("canonical_name"),
        F.col("country_code"),
    ).groupBy("constant_id").agg(F.min(F.struct(*attrs)).alias("g")).select("constant_id", "g.*")
    salts = F.transform(F.sequence(F.lit(0), F.lit(EMPTY_CITY_SALTS - 1)), lambda k: F.concat(F.lit("#"), k.cast("string")))
    g = g.select(F.explode(F.when(F.col("constant_id") == "", salts).otherwise(F.array("constant_id"))).alias("_city"), *attrs)
    salt = F.pmod(F.xxhash64(*[locations[c] for c in locations.columns]), F.lit(EMPTY_CITY_SALTS)).cast("string")
    city = F.when(F.col("city_id") == "", F.concat(F.lit("#"), salt)).otherwise(F.col("city_id"))
    joined = locations.withColumn("_city", city).join(g, "_city", "left")
    return joined.select(*locations.columns, *attrs)


def silver_table(name: str, bronze: Mapping[str, DataFrame]) -> DataFrame:
    """One silver table from the bronze frames it needs."""
    spec = SPEC_BY_SILVER[name]
    df = apply_spec(bronze[spec.bronze], spec)
    if name == "locations":
        geo_spec = SPEC_BY_SILVER["geo_constants"]
        df = enrich_geo(df, apply_spec(bronze[geo_spec.bronze], geo_spec))
    return df


GEO_SILVER = "geo_constants"
#: Bronze tables each silver table reads.
SILVER_INPUTS = {s.silver: (s.bronze, SPEC_BY_SILVER[GEO_SILVER].bronze) if s.silver == "locations" else (s.bronze,) for s in SPECS}


def build_silver(bronze: Mapping[str, DataFrame]) -> LazyLayer:
    """Every silver table whose bronze inputs are present, each built on first access."""
    names = [n for n, inputs in SILVER_INPUTS.items() if all(b in bronze for b in inputs)]
    return LazyLayer(lambda n: silver_table(n, bronze), names)
