"""Catalog, sinks and audit: SNK-2..SNK-5, CAT-1..CAT-6."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.layer import LazyLayer, prefetch

MAX_CONCURRENT_WRITES = 8
OUTCOME_SCHEMA = "table_name string, status string, cause string, error string"
AUDIT_SCHEMA = "table_name string, row_count long, n_columns int, columns string, status string"
#: Tables of a save under way: the new one until it takes its name, the old one until that is done.
STAGED, REPLACED = "__staged_", "__replaced"


def create_database(spark: SparkSession, db: str) -> None:
    """SNK-5."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def list_databases(spark: SparkSession) -> list[str]:
    """CAT-1."""
    return [d.name for d in spark.catalog.listDatabases()]


def list_tables(spark: SparkSession, db: str) -> list[str]:
    """CAT-2: tables of ``db`` (without session temp views, which the catalog also lists, and tables of a save under way)."""
    return sorted(t.name for t in spark.catalog.listTables(db)
                  if not t.isTemporary and STAGED not in t.name and not t.name.endswith(REPLACED))


def list_columns(spark: SparkSession, table: str) -> list[str]:
    """CAT-3."""
    return [c.name for c in spark.catalog.listColumns(table)]


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """CAT-5: first n rows."""
    return df.limit(n)


def schema_of(df: DataFrame) -> str:
    """CAT-6."""
    return df.schema.simpleString()


def save_table(df: DataFrame, full_name: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """SNK-2 / SNK-4: managed-table overwrite that also replaces the schema, and keeps the old table until the new one is whole.

    The rows are written to a table beside, which then takes the name; a save that fails leaves the old table as it was.
    If the driver is lost between both renames, the next save (or ``restore_table``) brings the old table back first.
    A written table cuts the lineage: the next layer reads files, not a recomputed plan.
    """
    spark, keys = df.sparkSession, partition_by or []
    restore_table(spark, full_name)
    staged = f"{full_name}{STAGED}{uuid.uuid4().hex[:8]}"
    # an empty table first, so that dropping it takes away whatever a failed write has left in its folder
    rows = df.select(*[F.col(_quoted(c)) for c in df.columns if c not in keys], *[F.col(_quoted(c)) for c in keys])
    empty = spark.createDataFrame([], rows.schema).write.format(fmt)
    (empty.partitionBy(*keys) if keys else empty).saveAsTable(staged)
    try:
        rows.write.insertInto(staged)
        swap_table(spark, staged, full_name)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def swap_table(spark: SparkSession, staged: str, full_name: str) -> None:
    """Give ``staged`` the name ``full_name``; the table that had it is dropped last, and has it again if the renaming fails."""
    old = spark.catalog.tableExists(full_name)
    if old:
        spark.sql(f"ALTER TABLE {full_name} RENAME TO {full_name}{REPLACED}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {full_name}")
    except Exception:
        if old:
            spark.sql(f"ALTER TABLE {full_name}{REPLACED} RENAME TO {full_name}")
        raise
    spark.catalog.refreshTable(full_name)
    if old:
        spark.sql(f"DROP TABLE {full_name}{REPLACED}")


def restore_table(spark: SparkSession, full_name: str) -> None:
    """Finish or undo a swap during which the driver was lost."""
    if spark.catalog.tableExists(f"{full_name}{REPLACED}"):
        if spark.catalog.tableExists(full_name):
            spark.sql(f"DROP TABLE {full_name}{REPLACED}")
        else:
            spark.sql(f"ALTER TABLE {full_name}{REPLACED} RENAME TO {full_name}")


def save_tables(db: str, frames: Mapping[str, DataFrame], names: Sequence[str], blocked: Mapping[str, tuple[str, str]] | None = None,
                fmt: str = "parquet", partition_by: Mapping[str, list[str]] | None = None,
                workers: int = MAX_CONCURRENT_WRITES) -> list[tuple[str, str, str | None, str | None]]:
    """SNK-3: one outcome (name, ``ok`` / ``error`` / ``skipped``, class of cause, text) for every planned table, in order.

    Tables in ``blocked`` are not attempted; the value has the cause.  The others are
    written side by side; one failure does not stop them, and its whole text is kept.  A failure is of class
    ``analysis`` if the plan could not be made, else ``execution``.
    """
    blocked = blocked or {}

    def save(name: str) -> tuple[str, str, str | None, str | None]:
        if name in blocked:
            return name, "skipped", *blocked[name]
        try:
            save_table(frames[name], f"{db}.{name}", fmt, (partition_by or {}).get(name))
        except Exception as e:  # noqa: BLE001 - isolated per table and reported
            return name, "error", "analysis" if isinstance(e, AnalysisException) else "execution", str(e)
        return name, "ok", None, None

    if not names:
        return []
    with ThreadPoolExecutor(max_workers=min(workers, len(names))) as pool:
        return list(pool.map(save, names))


def save_layer(spark: SparkSession, db: str, frames: Mapping[str, DataFrame], fmt: str = "parquet",
               partition_by: Mapping[str, list[str]] | None = None) -> DataFrame:
    """SNK-3: save every table of ``frames``; one outcome row per table."""
    create_database(spark, db)
    names = list(frames.names()) if hasattr(frames, "names") else list(frames.keys())
    return spark.createDataFrame(save_tables(db, frames, names, fmt=fmt, partition_by=partition_by), OUTCOME_SCHEMA)


def columns_text(df: DataFrame) -> str:
    """CAT-6 on one line: ``name type`` of every column."""
    return ",".join(f"{name} {kind}" for name, kind in df.dtypes)


def audit_frames(frames: Mapping[str, DataFrame], total_label: str = "__total__") -> DataFrame:
    """CAT-4: row count, column count and typed columns per table, plus a grand-total row.

    Each count is a distributed aggregate; the per-table rows are unioned and
    one ``rollup`` over that union adds the total, so every table is read once.
    """
    names = list(frames.names()) if hasattr(frames, "names") else list(frames.keys())
    if isinstance(frames, LazyLayer):
        prefetch(frames, names)
    per_table = reduce(
        DataFrame.unionByName,
        [
            frames[n].agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(n).alias("table_name"),
                "row_count",
                F.lit(len(frames[n].columns)).alias("n_columns"),
                F.lit(columns_text(frames[n])).alias("columns"),
            )
            for n in names
        ],
    )
    rolled = per_table.rollup("table_name").agg(
        F.sum("row_count").alias("row_count"),
        F.max("n_columns").alias("n_columns"),
        F.max("columns").alias("columns"),
        F.grouping("table_name").alias("_total"),
    )
    is_total = F.col("_total") == 1
    return rolled.select(
        F.when(is_total, F.lit(total_label)).otherwise(F.col("table_name")).alias("table_name"),
        "row_count",
        F.when(is_total, F.lit(None).cast("int")).otherwise(F.col("n_columns")).alias("n_columns"),
        F.when(is_total, F.lit(str(len(names)))).otherwise(F.col("columns")).alias("columns"),
    )


def readable(spark: SparkSession, tables: Mapping[str, str], whole: bool = False) -> tuple[dict[str, DataFrame], dict[str, str]]:
    """Tables (name -> full name) that can be read, and the error text of the others.

    A missing table fails when it is resolved, a damaged file only when it is read.  So all
    are counted in one job, and only if that fails each one by itself (``whole``: reading every column).
    """
    frames, errors = {}, {}
    for name, table in tables.items():
        try:
            frames[name] = spark.table(table)
            frames[name].schema  # noqa: B018 - resolves the table
        except Exception as e:  # noqa: BLE001 - recorded per table
            frames.pop(name, None)
            errors[name] = str(e)

    def read(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save() if whole else df.count()

    def attempt(name: str) -> tuple[str, str | None]:
        try:
            read(frames[name])
        except Exception as e:  # noqa: BLE001
            return name, str(e)
        return name, None

    together = bool(frames) and not whole
    try:
        if together:
            reduce(DataFrame.union, [df.agg(F.count(F.lit(1))) for df in frames.values()]).collect()
    except Exception:  # noqa: BLE001 - which one is found out table by table
        together = False
    if frames and not together:
        with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_WRITES, len(frames))) as pool:
            failed = {name: e for name, e in pool.map(attempt, list(frames)) if e is not None}
        errors |= failed
        frames = {n: df for n, df in frames.items() if n not in failed}
    return frames, errors


def audit(spark: SparkSession, db: str, expected: Sequence[str] | None = None, total_label: str = "__total__") -> DataFrame:
    """CAT-4 over saved tables: rows, columns and status (``ok`` / ``damaged`` / ``missing``) of each, and a total of the readable ones.

    ``expected`` names the tables that should be there (default: those that are).  Each table is counted once, in a job of its
    own, so that a damaged one fails alone; what reaches the driver is one number for each table.
    """
    there = set(list_tables(spark, db))
    names = sorted(set(expected) if expected is not None else there)

    def count(name: str) -> tuple[str, int | None, int | None, str, str]:
        if name not in there:
            return name, None, None, "ERROR: no such table", "missing"
        try:
            df = spark.table(f"{db}.{name}")
            return name, df.count(), len(df.columns), columns_text(df), "ok"
        except Exception as e:  # noqa: BLE001 - recorded per table
            return name, None, None, f"ERROR: {e}", "damaged"

    rows = []
    if names:
        with ThreadPoolExecutor(max_workers=min(MAX_CONCURRENT_WRITES, len(names))) as pool:
            rows = list(pool.map(count, names))
    counts = [r[1] for r in rows if r[4] == "ok"]
    return spark.createDataFrame([*rows, (total_label, sum(counts), None, str(len(counts)), "total")], AUDIT_SCHEMA)
