"""Columns of the caller that have the names of an operator's own steps come out as they went in."""

from pyspark.sql import functions as F

from adlake.llm import licenses, merkle, quality


def test_license_scan(spark):
    docs = spark.createDataFrame([(1, "see the MIT License"), (2, None)], "doc_id long, text string")
    plain = {r.doc_id: (r.license, r.dice, r.n_units) for r in licenses.scan(docs).collect()}
    odd = docs.withColumns({c: F.lit(f"own {c}") for c in licenses.STEPS}).withColumnRenamed("names", "NAMES").withColumnRenamed("text", "Best_")
    odd = odd.withColumnRenamed("best", "old").withColumnRenamed("Best_", "best")
    got = licenses.scan(odd, text_col="best")
    assert got.columns == [*odd.columns, "license", "dice", "n_units"]
    for r in got.collect():
        assert (r.license, r.dice, r.n_units) == plain[r.doc_id]
        assert r.units == "own units" and r.NAMES == "own names" and r.windows == "own windows" and r.kept == "own kept"


def test_quality_shape(spark):
    docs = spark.createDataFrame([(1, "a b c d a b c\n\nx # y\nx # y"), (2, None)], "doc_id long, text string")
    odd = docs.withColumns({c: F.lit(f"own {c}") for c in quality.STEPS})
    got = {r.doc_id: r for r in quality.shape(odd).collect()}
    for r in quality.shape(docs).collect():
        assert all(got[r.doc_id][c] == r[c] for c in r.asDict())
        assert all(got[r.doc_id][c] == f"own {c}" for c in quality.STEPS)


def test_record_counts(spark):
    a = spark.createDataFrame([(1, "x", "p"), (1, "y", "q"), (2, "z", "r"), (None, "w", "s")], "_place long, place string, digest string")
    at = spark.createDataFrame([(1,), (-1,)], "place long")
    got = merkle.record_counts(a, "_place", merkle.record_digest("place", "digest"), at).collect()
    assert sorted((r.place, r.n) for r in got) == [(-1, 1), (1, 1), (1, 1)] and len({r.digest for r in got}) == 3
