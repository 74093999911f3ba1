import pytest
from pyspark.sql import functions as F

#: Texts that every operator must take: null, empty, blank, one word, ties, repeats, very long, not ASCII, line ends.
ODD_TEXTS = [
    None, "", " \t\n\x0b\f\r ", "word", "a a a", "A b\nA b\nA b", "é ñ ß 日本語 İ Σς", "x" * 30_000, "the cat sat on the mat . " * 4000,
    "1234567890" * 200, "@@@ @ a@b @.com +1 +", "same text twice here", "same text twice here", "\x00 \x1c   nul", "|" * 50 + " # $ % ",
]
DDL = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """Odd texts with null and repeated ids, nulls in every column, a wholly repeated row and clashing extra columns."""
    rows = [(k if k != 4 else None, t, None if k % 3 else "en", None if k % 4 else "s", None) for k, t in enumerate(ODD_TEXTS)]
    rows += [(11, "same text twice here", "en", "s", 20), (11, "same text twice here", "en", "s", 20), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DDL)
    return df.withColumns({
        "score": F.lit("clash"), "words": F.lit(1), "row": F.lit("r"), "ids": F.lit(2), "language": F.lit("l"), "leak": F.lit(3),
        "fp": F.lit(4), "sha": F.lit("s"), "raw": F.lit("w"), "coded": F.lit(5), "masked": F.lit(6), "id": F.lit("i"), "key": F.lit(7)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([("b1", "the cat sat on the mat the cat sat on the mat"), ("b2", "same text"), ("b3", None), ("b4", ""),
                                  ("b2", "same text"), (None, "a a a")], "item_id string, text string")


def documents(spark, sf="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf}/documents.parquet")


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
