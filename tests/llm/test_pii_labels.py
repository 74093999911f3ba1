"""A tagger trained on given labels finds spans that hold neither a digit nor an at-sign, wherever they stand."""

import random

from adlake.llm import pii


def test_labels_without_anchor(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnoprstu", k=rng.randint(3, 8)))

    def text():
        before = " ".join(word() for _ in range(rng.randint(20, 60)))
        span = f"{word()} (at) {word()} (dot) org"
        return f"{before} {span} " + " ".join(word() for _ in range(20)), [("email", len(before) + 1, len(before) + 1 + len(span))]

    rows = [(k, *text()) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, own array<struct<kind: string, start: int, end: int>>")
    model = pii.train(df.where("doc_id < 200"), spans_col="own")
    assert model is not None
    found = pii.tagged_spans(model, [t for _, t, _ in rows[200:]])
    near = sum(any(k == "email" and a < want[0][2] and want[0][1] < b for k, a, b in got) for got, (_, _, want) in zip(found, rows[200:], strict=True))
    assert near > 80


def test_every_window_tiles_the_text():
    for n in (1, 23, 24, 47, 48, 95, 96, 97, 500):
        middle = sorted(c for s in pii.windows_of("x" * n, True).tolist() for c in range(s + pii.WINDOW // 4, s + 3 * pii.WINDOW // 4))
        assert len(set(middle)) == len(middle) and set(range(n)) <= set(middle)
    assert len(pii.windows_of("", True)) == 0
