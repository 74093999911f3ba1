"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.session import ensure_checkpoint_dir, shared_dir

#: Word separators of every operator here that splits on ASCII white space: \x20 and \x09-\x0D.
#: ``bytes.split()`` splits on exactly these, ``bytes.lower()`` lower-cases exactly A-Z.
WORD = r"[^\x20\x09-\x0D]+"


def with_package(call: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``call(spark, ...)`` after putting this package's folder on the Python path of the session's workers.

    That serves workers that see the folder; a cluster without it gets the package as usual, by ``--py-files``.
    """
    @wraps(call)
    def run(spark: SparkSession, *args) -> DataFrame:
        here, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
        if here not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), here]))
        return call(spark, *args)

    return run


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has, in any letter case."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"{base}_{uuid.uuid4().hex[:8]}"
    return name


def set_aside(df: DataFrame, *names: str) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns of these names (in any letter case) under fresh ones, and the new names by the old.

    For operators that make columns of their own on the way; ``put_back`` gives the names back.
    """
    own = {n.lower() for n in names}
    new = {c: fresh(df, f"aside_{c}") for c in df.columns if c.lower() in own}
    return (df.withColumnsRenamed(new) if new else df), new


def put_back(df: DataFrame, new: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({b: a for a, b in new.items()}) if new else df


def crc_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text (fold 0)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % F.lit(folds)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder of the session."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, max_rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` as Parquet into the session's shared folder and read it back.

    Used where a costly column is read more than once: the lineage is cut, lost executors
    re-read the files, and later scans read only the columns they need.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", max_rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sliced(batches: Iterator, rows: int = 256) -> Iterator:
    """Arrow arrays or batches in pieces of few rows, so that a task holds little besides the batch Spark handed over."""
    for batch in batches:
        for k in range(0, len(batch), rows):
            yield batch.slice(k, rows)
        del batch
        pa.default_memory_pool().release_unused()
