"""Differing records are located at places that hold several."""

import hashlib

from adlake.llm import merkle


def test_several_records_at_a_place(spark):
    page = "page_id bigint, url string, html string"
    same = [(None, "u", f"h{k}") for k in range(50)] + [(k, "u", "h") for k in range(100)]
    a = spark.createDataFrame([*same, (None, "u", "old"), (None, "u", "twice"), (None, "u", "twice"), (7, "u", "second"), (8, "u", "x")], page)
    b = spark.createDataFrame([*same, (None, "u", "new"), (None, "u", "twice"), (7, "u", "second"), (7, "u", "third"), (200, "u", "y")], page)
    digest = lambda html: hashlib.sha256(f"1:u{len(html)}:{html}".encode()).hexdigest()
    got = {tuple(r) for r in merkle.audit(a, b, "page_id", ["url", "html"]).collect()}
    assert got == {
        (-1, "missing", digest("old"), None, 1, 0), (-1, "extra", None, digest("new"), 0, 1), (-1, "changed", digest("twice"), digest("twice"), 2, 1),
        (7, "extra", None, digest("third"), 0, 1), (8, "missing", digest("x"), None, 1, 0), (200, "extra", None, digest("y"), 0, 1)}
    assert merkle.audit(a, a, "page_id", ["url", "html"]).isEmpty()
