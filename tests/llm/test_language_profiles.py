"""Language profiles, distances and scores by their definition, and the plan that ranks them."""

import collections
import zlib

from adlake.llm import langid

SF = "/root/testdata/sf0.001"


def grams(text):
    """n-grams as strings: letter runs in lower case, one border between and around them."""
    plain = "_".join("".join((c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " " for c in text).split())
    marked = f"_{plain}_" if plain else ""
    out = [c for c in marked if c != "_"] + [marked[k : k + 2] for k in range(len(marked) - 1)]
    return out + [marked[k : k + 3] for k in range(len(marked) - 2) if marked[k + 1] != "_"]


def code(gram):
    value = 0
    for c in gram:
        value = value << 21 | ord(c)
    return value


def first(counts, n):
    """The most frequent, ties by code."""
    return [g for _, g in sorted((-k, code(g)) for g, k in counts.items())[:n]]


def test_profiles_distance_and_score(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    counts = collections.defaultdict(collections.Counter)
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts[r.lang].update(grams(r.text or ""))
    profile = {lang: {g: k for k, g in enumerate(first(c, langid.RANKS))} for lang, c in counts.items() if c}
    learned = langid.train(docs.where(langid.crc_fold("doc_id", 4) != 2))
    assert {(r["lang"], r["gram"], r["rank"]) for r in learned.collect()} == {(x, g, k) for x, p in profile.items() for g, k in p.items()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predictions(docs).collect()}
    for r in rows:
        own = first(collections.Counter(grams(r.text or "")), langid.RANKS)
        if not own:
            assert got[r.doc_id] == ("und", 0.0)
            continue
        apart = {lang: sum(abs(p[g] - k) if g in p else langid.RANKS for k, g in enumerate(own)) for lang, p in profile.items()}
        best = min(sorted(apart), key=apart.get)
        assert got[r.doc_id] == (best, 1.0 - apart[best] / (langid.RANKS * len(own)))


def test_ranks_are_cut_before_the_shuffle(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = langid.train(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
