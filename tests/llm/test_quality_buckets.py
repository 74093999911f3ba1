"""A fixed number of buckets, and a threshold from trusted documents that are held out of the counts."""

from pyspark.sql import functions as F

from adlake.llm import quality

SF = "/root/testdata/sf0.1"


def test_a_verdict_follows_the_counts_only(spark):
    """The buckets of a word do not follow the size of the table."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert quality.log_ratios(docs.limit(3), docs.limit(1)).count() == quality.BUCKETS // quality.CHUNK
    assert quality.log_ratios(docs.limit(0), docs.limit(0)).count() == quality.BUCKETS // quality.CHUNK


def test_threshold(spark):
    rows = spark.createDataFrame([(k, float(k % 7) / 100, False) for k in range(200)] + [(500, -9.0, True), (501, -9.0, False)], "id long, ratio double, base_failed boolean")
    trusted = spark.range(201).select(F.col("id").alias("doc_id")).union(spark.createDataFrame([(500,)], "doc_id long"))
    held = [r.ratio for r in rows.where(quality.held_out() & F.expr("id < 200")).collect()]
    assert 20 < len(held) < 60
    mean = sum(held) / len(held)
    spread = max((sum((x - mean) ** 2 for x in held) / len(held)) ** 0.5, quality.LEAST_SPREAD)
    assert abs(quality.threshold_of(rows, trusted) - (mean - quality.SPREADS * spread)) < 1e-5
    assert quality.threshold_of(rows, trusted.limit(0)) == float("-inf")
    kept_in = rows.where(~quality.held_out() & F.expr("id < 200")).limit(1)
    assert abs(quality.threshold_of(kept_in, trusted) - (kept_in.first().ratio - quality.SPREADS * quality.LEAST_SPREAD)) < 1e-5


def test_junk_is_told_from_prose(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.report(spark.read.parquet(f"{SF}/documents.parquet"), labels).where("NOT base_failed").join(labels, "doc_id")
    assert {r["quality"]: (r["n"], r["n_kept"]) for r in judged.groupBy("quality").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("n_kept")).collect()} == {0: (291, 0), 1: (3243, 3243)}


def test_joined_ratios_are_the_broadcast_ones(spark, odd):
    texts, trusted = odd.select("doc_id", "text"), odd.where("doc_id in (3, 8, 11)").select("doc_id")
    near, far = (sorted((repr((r[:6], r[7:])), r.ratio) for r in quality.judge(texts, trusted, broadcast_buckets=n).collect())
                 for n in (quality.BROADCAST_BUCKETS, 0))
    assert [a[0] for a in near] == [b[0] for b in far] and all(abs(a[1] - b[1]) < 1e-9 for a, b in zip(near, far, strict=True))
