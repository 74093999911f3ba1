"""Near duplicates with Spark's limit on broadcasts far under the joined tables: none of these may be broadcast by a size estimate that is too low."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlake.llm import queries, simhash
from adlake.llm.common import written


@pytest.fixture
def limit(spark):
    """Sets the bytes from which a broadcast fails."""
    key = "spark.sql.maxBroadcastTableSize"
    yield lambda size: spark.conf.set(key, size)
    spark.conf.unset(key)


def documents(spark, tmp_path, texts):
    """A folder with documents of these texts, as a query reads them."""
    df = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def distinct_texts(n):
    rng = random.Random(5)
    return [" ".join(f"w{rng.randrange(10**6)}" for _ in range(6)) for _ in range(n)]


def test_keys_of_fingerprints_are_not_broadcast(spark, limit):
    limit("8m")
    fps = spark.range(20_000).select(F.xxhash64("id").alias("fp"))
    near = fps.limit(50).select(F.col("fp").bitwiseXOR(F.lit((1 << 40) + (1 << 20) + 1)).alias("fp"))
    got = simhash.links(written(fps.union(near), "test-fingerprints")).collect()
    assert len(got) == 50 and all((a ^ b) % (1 << 64) == (1 << 40) + (1 << 20) + 1 and a < b for a, b in got)


def test_op2_with_many_fingerprints(spark, limit, tmp_path):
    texts = distinct_texts(20_000)
    sf = documents(spark, tmp_path, [*texts, *texts[:10]])
    limit("8m")
    got = {r.doc_id: r.component_id for r in queries.QUERIES["op2_simhash"](spark, sf).collect()}
    assert len(got) == 20_010 and all(got[20_000 + k] == got[k] <= k for k in range(10))


def test_op2_with_many_copies(spark, limit, tmp_path):
    sf = documents(spark, tmp_path, [f"copies of text {k % 50}" for k in range(200_000)])
    limit("8m")
    found = queries.QUERIES["op2_simhash"](spark, sf).groupBy("fingerprint", "component_id").count().collect()
    assert sum(r["count"] for r in found) == 200_000 and {r.component_id for r in found} <= set(range(50))


def test_pipeline_stage_with_many_fingerprints(spark, limit, tmp_path):
    texts = distinct_texts(20_000)
    docs = spark.read.parquet(documents(spark, tmp_path, [*texts, *texts[:10]]) + "/documents.parquet")
    limit("8m")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).select("doc_id").collect()}
    assert max(kept) < 20_000 and len(kept) > 19_900


def test_pipeline_stage_with_copies_of_a_long_text(spark, limit, tmp_path):
    docs = spark.read.parquet(documents(spark, tmp_path, ["all words of the long text here " * 700, "another"] * 1_000) + "/documents.parquet")
    limit("8m")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, str(tmp_path)).orderBy("doc_id").collect()] == [0, 1]
