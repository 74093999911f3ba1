"""Corpus preparation in five stages: language, near duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` applies them to ``documents`` in order and
writes each result as Parquet in the session's shared folder, which is the next stage's input.

Every stage takes nulls in any column, empty and very long texts, repeated rows, empty tables and further columns of any
name; what it does with them stands with it.  Near copies are found as the near-duplicate operator's contract sets it (three-word shingles,
three differing bits), which groups exact copies and only close variants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import bpe, decontaminate, langid, pii, simhash
from adlake.llm.common import fresh, with_package, written

#: Documents of which more than this share of words is benchmark text go; of the others the passages are cut out.
MAX_LEAK_SHARE = 0.5


def _with_length(before: DataFrame, after: DataFrame) -> DataFrame:
    """``n_chars`` follows the changed text, where documents have it."""
    if "n_chars" not in before.columns:
        return after
    return after.withColumn("n_chars", F.char_length("text").cast(before.schema["n_chars"].dataType))


@with_package
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language.

    Null, empty and letterless texts have none and go; of languages equally near the alphabetically first counts; repeated rows
    stay or go together; in a table without any ``lang`` nothing can be learned, and all go.
    """
    return langid.keep_identified(docs)


@with_package
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id, or of equal ids one of them.

    Texts without words are one group; a row without id stands for its group only where no row has one; of rows equal in all
    columns one stays.
    """
    return simhash.keep_one_of_each(docs)


@with_package
def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages cut out; documents of which more than ``MAX_LEAK_SHARE`` of the words are such go.

    Null and empty texts have no words and stay as they are, as does every text where the benchmark is empty; a document of
    exactly that share stays; repeated rows are treated alike.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _with_length(docs, decontaminate.remove(docs, benchmark, max_share=MAX_LEAK_SHARE))


@with_package
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; all rows stay.

    Null stays null and empty stays empty; spans that overlap become one, of the first one's kind (of equal starts the longest);
    a corpus in which the patterns find nothing has no tagger and stays as it is.
    """
    return _with_length(docs, pii.mask(docs))


@with_package
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed as little-endian unsigned 32-bit integers, and the digest of the decoded text, for every row.

    Null and empty texts have no tokens: an empty id string, and the digest of the empty text.
    """
    out = fresh(docs, "coded")
    coded = bpe.round_trip(docs, bpe.default_vocabulary(), out=out)
    ids = F.col(out)["ids"]
    return coded.select("doc_id", F.floor(F.length(ids) / 4).alias("n_tokens"), ids.alias("ids"),
                        F.sha2(F.col(out)["decoded"].cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

#: A trained tagger, n-gram ranks and graph components are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


@with_package
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
