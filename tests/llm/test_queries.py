"""The registered queries against brute force by their definitions (sf0.001), and on odd and empty tables."""

import collections
import hashlib
import math
import re
import struct
import zlib

import duckdb
import pytest
import xxhash

from adlake.llm import bpe, brown, decontaminate, langid, licenses, merkle, pii, quality, simhash, substring
from adlake.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def rows(spark, name, key="doc_id"):
    return {r[key]: r for r in QUERIES[name](spark, SF).collect()}


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.01/{t}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    got = QUERIES[name](spark, "/root/testdata/sf0.01")
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, got.select(*want.columns).rdd.map(tuple).collect())) == sorted(map(repr, want.fetchall()))
    assert any(r[1] is not None for r in want.fetchall() or [(0, 1)])


def test_simhash(spark, docs):
    def fingerprint(text):
        w = words(lower(text))
        if not w:
            return 0
        shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    fp = {d: fingerprint(t) for d, t, _ in docs}
    root = {d: d for d in fp}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in fp:
        for b in fp:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = rows(spark, "op2_simhash")
    assert {d: (f"{fp[d]:016x}", find(d)) for d in fp} == {d: (r.fingerprint, r.component_id) for d, r in got.items()}
    assert len({find(d) for d in fp}) < len(fp)


def test_language(spark, docs):
    got = rows(spark, "op4_language")
    assert set(got) == {d for d, _, _ in docs}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= got[d].score <= 1 for d in got)
    held = [(got[d].lang_pred, lang) for d, _, lang in docs if got[d].held_out]
    assert len(held) > 20 and sum(a == b for a, b in held) / len(held) > 0.97


def test_brown(spark, docs):
    tokens = {d: [*words(lower(t)), None] for d, t, _ in docs}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    count = collections.Counter(w for d in tokens if not held[d] for w in tokens[d])
    n, v = sum(count.values()), len(count)
    got = rows(spark, "op5_brown")
    for d, own in tokens.items():
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(own), sum(w in count for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in own), rel_tol=1e-9)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)  # lower perplexity than single words


def test_substring(spark, docs):
    got = rows(spark, "op6_substring")
    want = substring.removed_by_definition([t for _, t, _ in docs])
    assert {d: w for (d, _, _), w in zip(docs, want, strict=True)} == {
        d: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for d, r in got.items()}
    assert any(0 < w[1] < w[0] for w in want)


def shape(text):
    w = words(text)
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            twice += line in seen
            seen.add(line)
    windows = list(zip(w, w[1:], w[2:], strict=False))
    n = collections.Counter(windows)
    hit = {k + j for k, x in enumerate(windows) if n[x] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), twice, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_quality(spark, docs):
    got = rows(spark, "op7_quality")
    good = {r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE quality = 1").fetchall()}
    raw, own, grams = collections.Counter(), collections.Counter(), {}
    for d, t, _ in docs:
        w = [x.encode() for x in words(t)]
        digest = lambda x, seed=42: xxhash.xxh64_intdigest(x, seed)
        one = [digest(x) for x in w]
        two = [digest(b, a) for a, b in zip(one, w[1:], strict=False)]  # Spark hashes further columns with the last hash as seed
        grams[d] = [(h - (1 << 64) * (h >> 63)) % quality.BUCKETS for h in one + two]
        raw.update(grams[d])
        own.update(grams[d] if d in good and zlib.crc32(str(d).encode()) % quality.FOLDS != 2 else ())
    n_raw, n_own = raw.total() + quality.BUCKETS, own.total() + quality.BUCKETS
    ratio = {d: sum(math.log((own[g] + 1) / n_own) - math.log((raw[g] + 1) / n_raw) for g in grams[d]) / max(1, len(grams[d])) for d in grams}
    held = [ratio[d] for d in good if not got[d].base_failed and zlib.crc32(str(d).encode()) % quality.FOLDS == 2]
    mean = sum(held) / len(held)
    spread = max((sum((x - mean) ** 2 for x in held) / len(held)) ** 0.5, quality.LEAST_SPREAD)
    for d, t, _ in docs:
        r = got[d]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == shape(t)
        assert math.isclose(r.ratio, ratio[d], abs_tol=1e-9) and r.kept == (not r.base_failed and ratio[d] >= mean - quality.SPREADS * spread)
    assert any(not r.kept and not r.base_failed for r in got.values())
    assert all(got[d].kept for d in good if not got[d].base_failed)


def test_quality_window_places(spark):
    text = "a b c d a b c e f g h f g h x " + " ".join(map(str, range(60)))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.shape(df).first()["n_repeat_words"] == shape(text)[4] == 12


def test_personal_data(spark, docs):
    got = rows(spark, "op8_pii")
    for d, t, _ in docs:
        spans = by_pattern(t)
        n = collections.Counter(k for k, _, _ in spans)
        r = got[d]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [n[k] for k in pii.KINDS] and r.base_sha256 == sha(text)
        assert set(text.split(",")) - {""} <= set(r.spans.split(","))
        if not re.search("[0-9@]", t):
            assert r.spans == ""


def by_pattern(text):
    def luhn(digits):
        double = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return sum(x // 10 + x % 10 for x in double) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m[0])
    found = lambda kind, pattern, fits: [(kind, *m.span()) for m in re.finditer(pattern, text) if fits(m)]
    return [
        *found("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        *found("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        *found("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        *found("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15)]


def test_decontamination(spark, docs):
    word = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = collections.defaultdict(set)
    for item, t in duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall():
        w = word(t)
        size = min(10, len(w))
        for k in range(len(w) - size + 1 if size else 0):
            windows[tuple(w[k : k + size])].add(str(item))
    got = rows(spark, "op9_decontamination")
    for d, t, _ in docs:
        w, hit, items = word(t), set(), set()
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    items |= found
        r = got[d]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            len(w), len(hit), len(items), sha(",".join(sorted(items))), bool(hit))
    assert any(r.contaminated for r in got.values())


def test_bpe(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.default_vocabulary())
    got = rows(spark, "op10_bpe")
    for d, text, _ in docs:
        ids = t.encode(text, add_special_tokens=False).ids
        r = got[d]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), sha(t.decode(ids, skip_special_tokens=False)))


# -- odd and empty tables: every operator takes them, one row for each document

def reports(spark, docs, benchmark):
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (None, 1, 0)], "doc_id bigint, quality int, toxic int")
    return {
        "licenses": licenses.report(docs), "simhash": simhash.groups(docs), "langid": langid.predictions(docs), "brown": brown.report(docs),
        "substring": substring.report(docs), "quality": quality.report(docs, labels), "pii": pii.report(docs),
        "decontaminate": decontaminate.report(docs, benchmark), "bpe": bpe.digests(docs)}


def test_odd_documents(spark, odd, benchmark):
    n = odd.count()
    got = {k: df.collect() for k, df in reports(spark, odd, benchmark).items()}
    assert {k: len(v) for k, v in got.items()} == dict.fromkeys(got, n)
    one = {k: {r.doc_id: r for r in v if r.doc_id is not None} for k, v in got.items()}
    texts = {r.doc_id: r.text for r in odd.collect() if r.doc_id is not None}
    assert one["simhash"][0].fingerprint == "0" * 16 and one["simhash"][1].component_id == 0  # no words: one group
    assert one["simhash"][12].component_id == 11
    alone = [r.fingerprint for r in got["simhash"] if r.component_id is None]  # "a a a" has no id, and no like with one
    assert alone == [f"{simhash.fingerprint_of(b'a a a'):016x}"]
    assert all(one["langid"][d].lang_pred == "und" and one["langid"][d].score == 0 for d in (0, 1, 2, 9))
    assert all(one["brown"][d].n_tokens == 1 for d in (0, 1, 2))
    assert one["substring"][0].n_bytes == 0 and one["substring"][7].n_removed == 30_000 and one["substring"][3].n_removed == 0
    for d, t in texts.items():
        assert tuple(one["quality"][d][1:7]) == shape(t)
        spans = by_pattern(t or "")
        assert one["pii"][d].base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans))
    assert one["decontaminate"][0].n_words == 0 and one["decontaminate"][11].n_items == 1 and one["decontaminate"][11].n_hit == 2
    assert one["bpe"][0].n_tokens == one["bpe"][2].n_tokens == 0
    assert one["licenses"][0].license is None and one["licenses"][0].n_units == 0


def test_empty_documents(spark, empty, benchmark):
    assert {k: df.count() for k, df in reports(spark, empty, benchmark).items()} == dict.fromkeys(reports(spark, empty, benchmark), 0)


def test_empty_benchmark(spark, odd, benchmark):
    assert decontaminate.report(odd, benchmark.limit(0)).where("contaminated").count() == 0


def test_merkle_odd(spark):
    page = "page_id bigint, url string, html string, extra int"
    a = spark.createDataFrame([(1, "u", "h", 1), (1, "u", "h", 2), (2, None, "x", 1), (None, "n", "n", 1), (-5, "m", "", 1), (10**12, "big", "b", 1)], page)
    b = spark.createDataFrame([(1, "u", "h", 9), (2, "", "x", 1), (None, "n", "n", 1), (-5, "m", None, 1), (7, "new", "b", 1)], page)
    got = {r.place: r.status for r in merkle.audit(a, b, "page_id", ["url", "html"]).collect()}
    assert got == {1: "changed", 2: "changed", -5: "changed", 10**12: "missing", 7: "extra"}
    assert merkle.audit(a, a.orderBy("extra"), "page_id", ["url", "html"]).count() == 0
    assert merkle.audit(a.limit(0), a.limit(0), "page_id", ["url", "html"]).count() == 0
    assert merkle.audit(a, a.limit(0), "page_id", ["url", "html"]).count() == 5
    assert merkle.report(a.limit(0)).count() == 0
