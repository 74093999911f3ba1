"""Cross-tokenizer alignment against brute force by its definition, and the tokenizer files' own libraries."""

import collections
import hashlib
import random

import numpy as np
import pytest

from adlake.llm import alignment
from adlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coders():
    import public_tokenizers as P

    return alignment.Coders(alignment.load_tokenizers(P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")))


@pytest.fixture(scope="module")
def library():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def tokens(library, text):
    """(id, begin, end) of both tokenizers' tokens, or nothing if the bytes differ."""
    if not text:
        return [], []
    first, second = library
    raw = (" " + text).encode()
    alphabet = {c: b for b, c in enumerate(alignment.byte_alphabet())}
    a = [(i, bytes(alphabet[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode())
         for i in second.encode(text)]
    out = []
    for side in (a, b):
        if b"".join(t for _, t in side) != raw:
            return [], []
        at, placed = 0, []
        for i, t in side:
            placed.append((i, at, at + len(t)))
            at += len(t)
        out.append(placed)
    return tuple(out)


def brute(library, docs):
    """The contract's columns for rows (doc_id, text), pair by pair."""
    placed = [tokens(library, t) for _, t in docs]
    links = []
    for a, b in placed:
        own, j = [], 0
        for i, x, y in a:
            while b[j][2] <= x:
                j += 1
            k = j
            while k < len(b) and b[k][1] < y:
                own.append((i, b[k][0]))
                k += 1
        links.append(own)
    count = collections.Counter(p for own in links for p in set(own))
    top = collections.defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = []
    for (d, _), (a, b), own in zip(docs, placed, links, strict=True):
        cuts = sorted({y for _, _, y in a} & {y for _, _, y in b})
        groups, at = [], [0, 0]
        for end in cuts:
            parts = []
            for k, side in enumerate((a, b)):
                first = at[k]
                while at[k] < len(side) and side[at[k]][2] <= end:
                    at[k] += 1
                parts.append(",".join(str(i) for i, _, _ in side[first : at[k]]))
            groups.append("|".join(parts))
        text = ";".join(groups)
        out.append((d, len(a), len(b), len(cuts), len(own), sum(count[p] == top[p[0]] for p in own), sum(count[p] for p in own),
                    hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    short = [(d, t) for d, t in docs if len(t or "") < 20_000]
    assert len(short) > 100
    frame = spark.createDataFrame(short, "doc_id bigint, text string").repartition(5)
    assert sorted(map(tuple, alignment.report(frame).select(*COLUMNS).collect())) == sorted(brute(library, short))
    got = QUERIES["op13_alignment"](spark, SF)
    assert got.columns == list(COLUMNS) and sorted(r.doc_id for r in got.collect()) == sorted(d for d, _ in docs)


def test_odd_and_empty(spark, odd, empty, library):
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    texts += [(100, "▁ own sign"), (101, "<0x41> <s> <|endoftext|> </s> <unk>"), (102, "<|endoftext|>"), (103, " 　  x\x85 İı ﬁ é")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = alignment.report(frame).select(*COLUMNS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(library, texts)))
    assert len(alignment.report(odd).collect()) == odd.count()
    assert alignment.report(empty).count() == 0 and alignment.report(empty).columns == list(COLUMNS)
    nothing = alignment.report(frame.where("text IS NULL OR text = ''")).collect()
    assert {tuple(r[1:]) for r in nothing} == {(0, 0, 0, 0, 0, 0, "")}


def test_chunks_do_not_matter(spark, monkeypatch):
    """Small chunks and slices give the same scores, and counts by bitmaps and planes are the plain counts."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    want = sorted(map(tuple, alignment.report(docs).collect()))
    with monkeypatch.context() as m:
        m.setattr(alignment, "CHUNK_DOCS", 7)
        m.setattr(alignment, "SLICE", 3)
        made = alignment.index(docs)
        counts = alignment.pair_counts(made)
        small = alignment.scores(made, counts)
        assert sorted(map(tuple, small.select(*[c if c != "n_links" else "n_links_doc" for c in COLUMNS]).collect())) == want
        assert made.where("a IS NOT NULL").select("chunk").distinct().count() > 3
        assert counts.agg({"links": "sum"}).first()[0] == sum(r[4] for r in want)


def test_real_groups(spark, library):
    docs = spark.createDataFrame([(1, "Hello worlds, naïve 日本"), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.alignment for r in alignment.align(docs).collect()}
    text = brute(library, [(1, "Hello worlds, naïve 日本")])[0]
    assert hashlib.sha256(got[1].groups.encode()).hexdigest() == text[7] and got[1].n_links == text[4]
    assert tuple(got[2]) == (0, 0, 0, 0, "")


def test_postings_round_trip():
    rng = np.random.default_rng(3)
    doc = rng.integers(0, 300, 5000)
    code = np.where(rng.random(5000) < 0.2, 1 << 32 | 7, rng.integers(0, 400, 5000) << 32 | rng.integers(0, 3, 5000))
    pairs = np.unique(np.stack((code, doc)), axis=1)
    times = rng.integers(1, 200, pairs.shape[1])
    shuffled = rng.permutation(pairs.shape[1])
    made = alignment.postings(5, pairs[0][shuffled], pairs[1][shuffled], times[shuffled], 300)
    assert any(made["dense"].to_pylist()) and not all(made["dense"].to_pylist())
    own, docs, n = alignment.read_postings(made["n_docs"].to_numpy(), np.array(made["dense"].to_pylist()), made["docs"].to_pylist(), made["planes"].to_pylist())
    codes = made["a"].to_numpy().astype(np.int64) << 32 | made["b"].to_numpy()
    assert sorted(zip(codes[own], docs, n, strict=True)) == sorted(zip(pairs[0], pairs[1], times, strict=True))
    links = dict(zip(codes.tolist(), made["n_links"].to_pylist(), strict=True))
    assert links == {c: int(times[pairs[0] == c].sum()) for c in links}


def test_same_ids_as_the_file(coders, library):
    """Every token and random text: ids of the byte-level file are those that its own library gives."""
    rng = random.Random(5)
    signs = "ab zé\t\n\r'’ 　日本🙂0123١٢İıſß.,!?-_#́​\x85\x1cVv'll've"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    texts += [raw.decode() for raw in coders.bytes_1 if raw.isascii()][:20_000]
    for text in texts:
        assert coders.first.encode_ordinary(" " + text) == library[0].encode(" " + text, add_special_tokens=False).ids
