"""The classes of op5_brown: all words from a count on have one, wherever their counts are."""

import math
import random

import numpy as np

from adlake.llm import brown


def corpus(spark):
    """Words a0 ... and b0 ... that alternate, sixty of each, and words that occur once; a third of them end alike."""
    rng, texts = random.Random(5), []
    for k in range(600):
        words = []
        for _ in range(10):
            words += [f"a{rng.randrange(60)}{rng.choice(['x', 'x', ''])}", f"b{rng.randrange(60)}"]
        texts.append((k, " ".join([*words, f"once{k}"])))
    return spark.createDataFrame(texts, "doc_id bigint, text string")


def test_vocabulary_has_no_cap(spark):
    """Ten words travel with their counts and four are the core; every word found often enough has a class of its group."""
    docs = corpus(spark)
    model, counts = brown.train(docs.select("text"), words=4, endings=4, classes=4, hot=10, least=20, rounds=8)
    n = {bytes(r.word): r.n for r in counts.collect()}
    cold = {bytes(r.word): r.cls for r in model["cold"].collect()}
    many = {w for w in n if n[w] >= 20}
    assert len(many) > 150 and many == {*cold, *model["hot"]} and len(model["hot"]) == 10
    of = {w: cold.get(w, model["classes"][model["unit"][model["hot"].index(w)]] if w in model["hot"] else None) for w in many}
    a, b = ({of[w] for w in many if w.startswith(k)} for k in (b"a", b"b"))
    assert not a & b


def test_travelling_or_not_is_the_same(spark):
    """Counts and classes that travel, and those that are joined, give the same scores."""
    docs, got = corpus(spark), []
    for hot in (7, 100_000):
        model, counts = brown.train(docs.select("text"), words=4, endings=4, classes=4, hot=hot, least=20, rounds=2)
        got.append({r.id: r for r in brown.score(docs.where("doc_id < 300"), model, counts).collect()})
    assert len(got[0]) == 300
    for k, one in got[0].items():
        two = got[1][k]
        assert (one.n_tokens, one.n_known) == (two.n_tokens, two.n_known)
        assert math.isclose(one.base_log, two.base_log, rel_tol=1e-9) and math.isclose(one.score, two.score, rel_tol=1e-9)


def test_best_classes_as_exchange():
    """A unit's best class is that of the greatest likelihood, by trying all."""
    rng = np.random.default_rng(1)
    n = rng.poisson(0.7, (30, 30)).astype(float)
    cls = np.concatenate(([0], rng.integers(1, 5, 29)))
    member = np.eye(5)[cls]
    pair = member.T @ n @ member
    own = np.diag(n).copy()
    right, left = n @ member, n.T @ member
    right[np.arange(30), cls] -= own
    left[np.arange(30), cls] -= own
    got = brown.best_classes(pair, cls, right, left, own)
    for w in range(1, 30):
        tried = []
        for c in range(1, 5):
            other = cls.copy()
            other[w] = c
            m = np.eye(5)[other]
            tried.append(brown.likelihood(m.T @ n @ m))
        assert math.isclose(tried[got[w] - 1], max(tried), rel_tol=1e-12)


def test_bigrams_are_packed_and_whole(spark):
    """Spark moves rows of many unit bigrams each; they hold every bigram, and a round moves each unit, travelling or not, to its best class."""
    texts = [r.text for r in corpus(spark).collect()]
    words = sorted({w.encode() for t in texts for w in t.split() if not w.startswith("once")})
    near = words[::2] + words[1::4]
    unit = {w: 2 + k for k, w in enumerate(near + sorted({*words} - {*near}))}
    dense, units = 2 + len(near), 2 + len(words)
    want = np.zeros((units, units))
    for t in texts:
        seq = [brown.END, *[unit.get(w.encode(), brown.REST) for w in t.split()], brown.END]
        np.add.at(want, (seq[:-1], seq[1:]), 1)

    model = {"key": "packed", "hot": near, "ending": {}, "unit": np.arange(2, dense), "bits": b"\xff" * (1 << brown.MAP_BITS - 3), "dense": dense}
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4)
    found = brown.unit_bigrams(docs, spark.sparkContext.broadcast(model)).cache()
    got, far, packed, n_pairs = np.zeros((units, units)), [], 0, 0
    for r in found.collect():
        if r.cells is None:
            a, b = (unit.get(bytes(w), brown.REST) if w else u for w, u in ((r.aw, r.pair >> brown.PAIR), (r.bw, r.pair & 0xFFFFFFFF)))
            far.append((a, b, r.n))
            got[a, b] += r.n
        else:
            pair, n = brown._unpacked([bytes(r.cells)])
            packed, n_pairs = packed + 1, n_pairs + len(pair)
            np.add.at(got, (pair >> brown.PAIR, pair & 0xFFFFFFFF), n)
    assert (got == want).all()
    assert 0 < packed < n_pairs <= np.count_nonzero(want[:dense, :dense])

    bigrams = brown.Bigrams(found.where("cells IS NOT NULL").select("cells"), spark.createDataFrame(far, "a bigint, b bigint, n bigint"), dense)
    cls = np.concatenate(([0], np.random.default_rng(2).integers(1, 5, units - 1)))
    member, table = np.eye(5)[cls], spark.createDataFrame(list(enumerate(cls.tolist())), "unit bigint, cls bigint")
    shared = bigrams.broadcast(table)
    pair = bigrams.code_pairs(table, shared, 5)
    assert (pair == member.T @ want @ member).all()
    own, right, left = np.diag(want).copy(), want @ member, want.T @ member
    right[np.arange(units), cls] -= own
    left[np.arange(units), cls] -= own
    best = brown.best_classes(pair, cls, right, left, own)
    best[brown.END] = 0
    moved = {r.unit: r.cls for r in bigrams.moved(table, shared, pair).collect()}
    assert moved == dict(enumerate(best.tolist())) and (best != cls).any()
