"""Licences that are wrapped over lines, stand among other words, or come as complete texts."""

import textwrap

import pytest

from adlake.llm import licenses

NOTICE = max((t for n, t in licenses.TEMPLATES if n == "MIT" and t.startswith("Permission") and "WARRANTY" not in t), default=None)
PROSE = " ".join(f"word{k} and other{k} things" for k in range(200))


def scan(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [(r.license, r.dice, r.n_units) for r in licenses.scan(df).orderBy("doc_id").collect()]


def test_wrapped_and_inline(spark):
    wrapped = "\n".join(textwrap.wrap(NOTICE, 78))
    got = scan(spark, wrapped, f"{PROSE}\n{wrapped}\n{PROSE}", f"{PROSE} Released under the MIT License. {PROSE}",
               f"{PROSE}\n{wrapped}\n{PROSE}\nReleased under the MIT License.\n{PROSE}\n{wrapped}", PROSE, f"{PROSE} license")
    assert got == [("MIT", 1.0, 1), ("MIT", 1.0, 1), ("MIT", 1.0, 1), ("MIT", 1.0, 3), (None, None, 0), (None, None, 0)]


@pytest.mark.parametrize("name", ["MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC"])
def test_complete_texts(spark, name):
    text = max((t for n, t in licenses.TEMPLATES if n == name), key=len)
    assert text.isascii() and ("DAMAGE" in text)
    whole = "\n".join(textwrap.wrap(f"{name} License\n\nCopyright (c) 2020 A. Author\n\n{text}", 72))
    got = scan(spark, whole, f"{PROSE}\n{whole}\n{PROSE}")
    assert [g[0] for g in got] == [name, name], got
    assert all(g[1] > 0.9 and g[2] == 1 for g in got)
