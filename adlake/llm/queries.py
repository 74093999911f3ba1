"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adlake.llm import (
    alignment, bpe, brown, decontaminate, langid, licenses, merkle, pii, quality, simhash, substring, topk, whitening,
)
from adlake.llm.common import documents, with_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_licenses": lambda spark, sf: licenses.report(documents(spark, sf)),
    "op2_simhash": lambda spark, sf: simhash.groups(documents(spark, sf)),
    "op3_merkle": lambda spark, sf: merkle.report(spark.read.parquet(f"{sf}/pages.parquet")),
    "op4_language": lambda spark, sf: langid.predictions(documents(spark, sf)),
    "op5_brown": lambda spark, sf: brown.report(documents(spark, sf)),
    "op6_substring": lambda spark, sf: substring.report(documents(spark, sf)),
    "op7_quality": lambda spark, sf: quality.report(documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")),
    "op8_pii": lambda spark, sf: pii.report(documents(spark, sf)),
    "op9_decontamination": lambda spark, sf: decontaminate.report(
        documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet")),
    "op10_bpe": lambda spark, sf: bpe.digests(documents(spark, sf)),
    "op11_topk": lambda spark, sf: topk.report(spark.read.parquet(f"{sf}/embeddings.parquet")),
    "op12_whitening": lambda spark, sf: whitening.report(spark.read.parquet(f"{sf}/embeddings.parquet")),
    "op13_alignment": lambda spark, sf: alignment.report(documents(spark, sf)),
}
QUERIES = {name: with_package(query) for name, query in QUERIES.items()}


ORACLE_SQL: dict[str, str] = {
    "op1_licenses": licenses.oracle_sql(),
    "op3_merkle": merkle.ORACLE_SQL,
    "op11_topk": topk.ORACLE_SQL,
}
