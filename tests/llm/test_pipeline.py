"""The pipeline: its stages on given, odd and empty tables, against brute force where SQL cannot say it."""

import re

import duckdb
import pytest

import corpus_pipeline
from adlake.llm import bpe, decontaminate, langid, pii, simhash

SF = "/root/testdata/sf0.001"


def test_run_agrees_with_the_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {r.doc_id for r in langid.predictions(docs).collect() if r.lang_pred != "und" and r.score >= 0.05}
    left = docs.where(docs.doc_id.isin(sorted(kept)))
    ones = {r.component_id for r in simhash.groups(left).collect()}
    leaks = {r.doc_id: (r.n_words, r.n_hit) for r in decontaminate.report(left, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    want = {d for d in ones if leaks[d][1] <= 0.5 * leaks[d][0]}
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == want and 0 < len(want) < len(texts)
    coder = bpe.Encoder(bpe.load_vocabulary(bpe.default_vocabulary()))
    plain = [d for d in want if not leaks[d][1] and not re.search("[0-9@]", texts[d])]
    assert len(plain) > 50 and all(bytes(got[d].ids) == coder.encode(texts[d]) for d in plain)


def test_no_leak_and_no_personal_data_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = corpus_pipeline.benchmark_leaks(spark, docs, SF)
    assert clean.columns == docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert all(len(t) == n for t, n in after.values()) and any(before[d] != t for d, (t, _) in after.items())
    hits = {r.doc_id: r.n_hit for r in decontaminate.report(docs, benchmark).collect()}
    assert all(before[d] == t for d, (t, _) in after.items() if not hits[d])
    masked = corpus_pipeline.personal_data(spark, docs, SF)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert all(not pii.base_spans(r.text) for r in masked.collect())


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f g", "x"), (3, "a b c d e f g", "y"), (3, "a b c d e f g", "y"), (3, "a b c d e f g", "z"), (9, "other words stand here now", "x"),
            (None, "a b c d e f g", "n"), (None, "only without an id here", "n"), (None, "only without an id here", "n"),
            (None, "Only without an id here", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = simhash.keep_one_of_each(df).collect()
    assert sorted((r.doc_id or -1, r.text.lower()) for r in got) == [
        (-1, "only without an id here"), (3, "a b c d e f g"), (9, "other words stand here now")]


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_take_anything(spark, odd, empty, which):
    docs = {"odd": odd, "empty": empty}[which]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        assert out.count() <= docs.count()
        if name == "language" and which == "odd":
            assert {r.text for r in out.collect()}.isdisjoint({None, "", "1234567890" * 200})


def test_exact_copies_and_clean_documents(spark):
    """Copies leave one; documents that nothing speaks against stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = duckdb.sql(f"SELECT min(doc_id) FROM '{SF}/documents.parquet' GROUP BY text").fetchall()
    kept = {r.doc_id for r in simhash.keep_one_of_each(docs).select("doc_id").collect()}
    assert kept <= {t[0] for t in texts}
    assert langid.keep_identified(docs).count() == docs.count()
