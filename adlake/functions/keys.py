"""GD-14 surrogate keys, date keys and a distributed dense row index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.session import shared_dir

UNKNOWN = "Unknown"
KEY_SEP = "~"


def _ref(name: str) -> str:
    """SQL reference to a (possibly nested ``a.b``) column given by name."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in name.split("."))


def _part_sql(text: str, alone: bool) -> str:
    """One natural key as text, null -> 'Unknown'; beside others its own '\\' and '~' are escaped, so that no two
    different lists of keys are joined to one text."""
    whole = f"coalesce(CAST({text} AS STRING), '{UNKNOWN}')"
    return whole if alone else f"replace(replace({whole}, r'\\', r'\\\\'), '{KEY_SEP}', r'\\{KEY_SEP}')"


def surrogate_key_sql(*natural_keys: str) -> str:
    """GD-14 as SQL text: md5 of the natural keys joined by '~', each null -> 'Unknown' and escaped."""
    parts = ", ".join(_part_sql(_ref(k), len(natural_keys) == 1) for k in natural_keys)
    return f"md5(concat_ws('{KEY_SEP}', {parts}))"


def surrogate_key(*natural_keys: str | Column) -> Column:
    """Stable key: md5 of the natural keys joined by '~', each null -> 'Unknown' and escaped.

    Pure per-row function: facts compute it themselves, no lookup join and no
    shuffle; identical across runs and reproducible in any SQL engine.
    (``concat_ws`` would drop nulls and merge distinct keys, hence the coalesce.)
    """
    if all(isinstance(k, str) for k in natural_keys):
        return F.expr(surrogate_key_sql(*natural_keys))
    parts = [F.coalesce((F.col(k) if isinstance(k, str) else k).cast("string"), F.lit(UNKNOWN)) for k in natural_keys]
    if len(parts) > 1:
        parts = [F.replace(F.replace(x, F.lit("\\"), F.lit("\\\\")), F.lit(KEY_SEP), F.lit("\\" + KEY_SEP)) for x in parts]
    return F.md5(F.concat_ws(KEY_SEP, *parts))


def date_key_sql(d: str) -> str:
    """yyyyMMdd as int, as SQL text."""
    r = _ref(d)
    return f"CAST(year({r}) * 10000 + month({r}) * 100 + dayofmonth({r}) AS INT)"


def date_key(d: str | Column) -> Column:
    """yyyyMMdd as int."""
    if isinstance(d, str):
        return F.expr(date_key_sql(d))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def with_row_index(df: DataFrame, order: list[Column], name: str = "row_no") -> DataFrame:
    """Dense 1-based position of every row in a total ``order`` without one task.

    Rows are range-partitioned on ``order`` and sorted inside each partition;
    ``monotonically_increasing_id`` then encodes (partition, position in
    partition).  These tagged rows are written once to the session's shared
    folder, and both the per-partition counts (one row per partition, which give
    each partition's offset) and the rows are read from there: two evaluations
    of the range partitioning could sample different bounds.  Nothing gathers
    the rows into one task or onto the driver.  ``order`` must be a total order.
    """
    spark, low_bits = df.sparkSession, (1 << 33) - 1
    path = shared_dir(spark, "adlake-rows")
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .select("*", F.shiftright("_mid", 33).alias("_part"), F.col("_mid").bitwiseAND(F.lit(low_bits)).alias("_pos"))
        .drop("_mid")
        .write.parquet(path)
    )
    tagged = spark.read.schema(df.schema.add("_part", "long").add("_pos", "long")).parquet(path)
    counts = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to broadcast
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    )
    return (
        tagged.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.coalesce(F.col("_off"), F.lit(0)) + F.col("_pos") + 1)
        .drop("_part", "_pos", "_off")
    )
