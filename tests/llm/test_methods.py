"""The methods themselves, without or nearly without Spark."""

import random
import struct

import duckdb
import numpy as np
import pytest

from adlake.llm import bpe, brown, components, decontaminate, langid, licenses, pii, simhash, substring


def test_bpe_fuzz():
    from tokenizers import Tokenizer

    path = bpe.default_vocabulary()
    want, tables = Tokenizer.from_file(path), bpe.load_vocabulary(path)
    encoder, decoder = bpe.Encoder(tables, cache_words=50), bpe.Decoder(tables)
    rng = random.Random(1)
    odd = "abcdefghijklmnopqrstuvwxyz'éèßñöİΣς日本語العربيةक्षि0१²Ⅻ!?…—́​\x85\x1c\x0b　 \n\t👍🏽<|>#"
    for k in range(4000):
        s = "".join(rng.choice("etaoinshrdlu" if k % 3 == 0 else odd) for _ in range(rng.randint(0, 30)))
        s += f"<|endoftext|>{s} <|startoftext|>" if k % 50 == 0 else ""
        ids = want.encode(s, add_special_tokens=False).ids
        packed = encoder.encode(s)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids, s
        assert decoder.decode(packed) == want.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("alphabet", [b"ab", b"abcdef\x00\xff"])
def test_run_index_marks(alphabet):
    rng = random.Random(5)
    for _ in range(100):
        length = rng.choice([4, 8, 12])
        bits = lambda n: bytes(rng.choice(alphabet) for _ in range(n))  # noqa: B023, E731
        core = bits(40)
        batch = list({bits(rng.randint(0, 30)) + core[rng.randint(0, 20) : rng.randint(20, 40)] + bits(rng.randint(0, 20)) for _ in range(rng.randint(1, 8))})
        count: dict[bytes, int] = {}
        for raw in batch:
            for k in range(len(raw) - length + 1):
                count[raw[k : k + length]] = count.get(raw[k : k + length], 0) + 1
        for raw, spans in zip(batch, substring.marks(batch, length), strict=True):
            want, got = set(), set()
            for k in range(len(raw) - length + 1):
                want |= set(range(k, k + length)) if count[raw[k : k + length]] > 1 else set()
            for a, b in spans:
                got |= set(range(a, b))
            assert got == want


def test_run_index_inverts():
    """The runs are the transform: walking them backwards spells the text."""
    text = np.array([5, 6, 5, 6, 5, 7, 5, 6, 5, 6, 1], dtype=np.int32)
    order, _ = substring.suffix_array(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:].tolist())
    index = substring.run_index(text)
    assert np.repeat(index["symbol"], index["size"]).tolist() == text[order - 1].tolist()
    assert len(index["symbol"]) < len(text)


def test_substring_large_group(spark, monkeypatch):
    """An anchor with too many different pieces is counted by Spark, with the same result."""
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core = text(500)
    texts = [text(rng.randint(0, 300)) + core[rng.randint(0, 90) :] + text(rng.randint(0, 300)) for _ in range(30)] + ["abab" * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(substring.removed_by_definition(texts)))
    for limit in (substring.MAX_GROUP, 3000):
        monkeypatch.setattr(substring, "MAX_GROUP", limit)
        got = {r.doc_id: tuple(r)[1:] for r in substring.report(df).collect()}
        assert got == want


def test_links_are_complete(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    near = [s ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for s in seeds for _ in range(5)] + [0, 1, (1 << 64) - 1, 1 << 63, 7, 15]
    signed = sorted({x - (1 << 64) * (x >> 63) for x in near})
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert got == want and len(want) > 100


def test_components_of_a_path_and_a_star(spark):
    edges = [(k, k + 1) for k in range(60)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (2000, 2001), (2001, 2000)]
    got = dict(components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1300), 1000), 2000: 2000, 2001: 2000}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_exchange_finds_classes():
    """Words of two groups that alternate are told apart, and the likelihood never falls."""
    rng = np.random.default_rng(0)
    n = np.zeros((21, 21))
    for _ in range(4000):
        a, b = 1 + rng.integers(10), 11 + rng.integers(10)
        n[a, b] += 1
        n[b, 1 + rng.integers(10)] += 1
    cls = brown.exchange(n, classes=3)
    assert len(set(cls[1:11])) == len(set(cls[11:])) == 1 and cls[1] != cls[11] and cls[0] == 0


def test_brown_probabilities_add_up(spark):
    texts = spark.createDataFrame([("a b c a",), ("b a d",), ("c c a b",)], "text string")
    model, _ = brown.train(texts, words=3, endings=2, classes=3, hot=3)
    move = 10.0 ** model["move"]
    assert np.allclose(move.sum(axis=1), 1)


def test_patterns_fuzz():
    from .test_queries import by_pattern

    rng = random.Random(3)
    for _ in range(5000):
        t = "".join(rng.choice("ab1@..+- ()9%é_55") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == by_pattern(t), t


def test_crf_gradients():
    rng = np.random.default_rng(0)
    p = pii._new_parameters(3)
    ids, tags = rng.integers(0, pii.SYMBOLS, (2, 6)), np.array([[0, 1, 2, 0, 3, 4], [5, 6, 0, 0, 7, 8]])
    _, g = pii.gradients(p, ids, tags)
    for name in p:
        for _ in range(3):
            at = tuple(rng.integers(0, n) for n in p[name].shape)
            if name.startswith("in_"):
                at = (ids[0, 0], at[1])
            if name == "move" and pii.FORBIDDEN[at]:
                continue
            keep, eps = p[name][at], 1e-5
            p[name][at] = keep + eps
            up, _ = pii.gradients(p, ids, tags)
            p[name][at] = keep - eps
            down, _ = pii.gradients(p, ids, tags)
            p[name][at] = keep
            assert abs((up - down) / (2 * eps) - g[name][at]) < 1e-6, name


def test_tagger_learns_spans(spark):
    """Trained on half of the windows, the tagger finds the spans of the other half."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    ids, tags = pii.training_windows(docs)
    model = pii.fit(ids[::2], tags[::2])
    got, want = pii.viterbi(model, ids[1::2])[0], tags[1::2]
    both, found, true = ((got == want) & (want > 0)).sum(), (got > 0).sum(), (want > 0).sum()
    assert both / found > 0.85 and both / true > 0.9


def test_windows_cover_and_reconcile():
    text = "x" * 200 + " mail bob@example.com now " + "y" * 200
    starts = pii.windows_of(text)
    middle = set()
    for s in starts:
        middle |= set(range(s + pii.WINDOW // 4, s + 3 * pii.WINDOW // 4))
    at = text.index("@")
    assert set(range(at - pii.NEAR + pii.STRIDE // 2, at + pii.NEAR - pii.STRIDE // 2)) <= middle
    whole = pii.tags_of(len(text), [("email", 206, 221)])
    padded = np.concatenate((np.zeros(pii.WINDOW, int), whole, np.zeros(2 * pii.WINDOW, int)))
    rows = np.array([padded[s + pii.WINDOW : s + 2 * pii.WINDOW] for s in starts])
    assert pii.reconcile(text, starts, rows, np.ones(rows.shape)) == [("email", 206, 221)]
    assert pii.reconcile(text, starts, rows, np.full(rows.shape, 0.5)) == []
    assert len(pii.windows_of("no anchors here")) == 0


def test_masking_joins_overlaps():
    assert pii.masked("abcdefgh", [("ip", 1, 4, True), ("card", 2, 6, False), ("email", 7, 8, True)]) == "a<IP>g<EMAIL>"


def test_cut_spans_keeps_the_rest():
    text = "One, two THREE four. Five six"
    assert decontaminate.cut_spans(text, [1, 2, 3]) == "One, . Five six"
    assert decontaminate.cut_spans(text, [0, 5]) == ", two THREE four. Five "


def test_decontamination_blocks_agree(spark, odd, benchmark):
    one = decontaminate.scan(odd.select("doc_id", "text"), benchmark)
    many = decontaminate.scan(odd.select("doc_id", "text"), benchmark, block_windows=1)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))
    clean = [sorted(map(repr, decontaminate.remove(odd, benchmark, block_windows=n).collect())) for n in (1, 10_000)]
    assert clean[0] == clean[1] and 0 < len(clean[0]) < odd.count()


def test_language_profiles():
    text = "Hello, hello!"
    assert len(langid.grams(text)) == 2 * (5 + 6 + 5) and len(langid.grams("12 !")) == 0 and len(langid.grams(None)) == 0
    assert langid.nearest("abc", {"langs": [], "code": np.empty(0), "place": np.empty((0, 0)), "ranks": 5}) == ("und", 0.0)


def test_license_pruning_is_lossless(spark):
    """Bounds and pivots never lose a unit: the same result without any pruning, over cut and changed templates."""
    rng = random.Random(4)
    texts = []
    for _, t in licenses.TEMPLATES:
        w = t.split()
        for drop in (0, 1, 2, 5):
            keep = [x for k, x in enumerate(w) if k not in set(rng.sample(range(len(w)), min(drop, len(w) - 2)))]
            texts += [" ".join(keep), "noise\n" + " ".join(keep) + "\nnoise again", " ".join(keep + ["more"] * drop)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {tuple(r) for r in licenses.report(df).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(texts)))
    assert got == {(d, name, dice, n) for d, name, dice, n in con.sql(licenses.oracle_sql()).fetchall()}
    names = {d: name for d, name, _, _ in got}
    assert [names[12 * k] for k in range(len(licenses.TEMPLATES))] == [n for n, _ in licenses.TEMPLATES]
