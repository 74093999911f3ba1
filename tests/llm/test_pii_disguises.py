"""The tagger finds spans that no pattern matches: disguised ones of documents that it has not seen."""

import random
import zlib

from adlake.llm import pii

SF = "/root/testdata/sf0.1"


def test_rules():
    assert pii.disguised("email", "a.b@c.org", 0) == "a.b (at) c (dot) org" and pii.disguised("email", "a@c.org", 3) == "a @ c.org"
    assert pii.disguised("ip", "1.2.3.4", 0) == "1[.]2[.]3[.]4" and pii.disguised("card", "1234 5678-90123456", 1) == "1234/5678/9012/3456"
    assert [pii.disguised("phone", "+1 (23) 456-7890", n) for n in range(3)] == ["001 (23) 456-7890", "1 (23) 456-7890", "1/23/456/7890"]
    text = "x a@b.org y 1.2.3.4"
    other, moved = pii.disguise(text, pii.base_spans(text), 1)
    assert other == "x a[at]b[dot]org y 1(.)2(.)3(.)4" and [other[a:b] for _, a, b in moved] == ["a[at]b[dot]org", "1(.)2(.)3(.)4"]
    assert not pii.base_spans(other) and pii.disguise("plain", []) == ("plain", [])
    assert pii.plausible("ip", "1[.]2[.]3[.]255") and not pii.plausible("ip", "1 . 2 . 3 . 256") and not pii.plausible("ip", "1[.]2")
    assert not pii.plausible("card", "1234/5678/9012/3456") and pii.plausible("phone", "0049/30/123456") and not pii.plausible("phone", "1/2")


def test_held_out_disguises(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [r for r in docs.collect() if r.text]
    held = lambda d: zlib.crc32(str(d).encode()) % 4 == 1
    model = pii.train(docs.where("crc32(cast(doc_id AS string)) % 4 <> 1"))
    rng, texts, want = random.Random(2), [], []
    for r in rows:
        spans = pii.base_spans(r.text) if held(r.doc_id) else []
        if spans:
            text, moved = pii.disguise(r.text, spans, rng.randrange(12))
            texts.append(text)
            want.append([s for s in moved if not any(s[1] < b and a < s[2] for _, a, b in pii.base_spans(text))])
    found = [[s[:3] for s in got if not s[3]] for got in pii.all_spans(model, texts)]
    near = lambda s, t: s[0] == t[0] and abs(s[1] - t[1]) <= 2 and abs(s[2] - t[2]) <= 2
    total, hit = sum(map(len, want)), sum(any(near(s, t) for t in g) for w, g in zip(want, found, strict=True) for s in w)
    right = sum(any(near(s, t) for s in w) for w, g in zip(want, found, strict=True) for t in g)
    print("recall", hit, total, "precision", right, sum(map(len, found)))
    assert total > 100 and hit >= 0.9 * total and right >= 0.9 * sum(map(len, found))
    clean = [r.text for r in rows if held(r.doc_id) and not pii.base_spans(r.text)]
    assert sum(map(bool, pii.tagged_spans(model, clean))) <= 0.001 * len(clean)
