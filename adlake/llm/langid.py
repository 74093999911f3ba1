"""Language identification by rank-order profiles of character n-grams.

A language's profile is the list of its most frequent n-grams (one to three characters of letter
runs, with the run's borders as a character), by falling count over *all* labelled texts.  A document
is given to the language whose profile is nearest by the out-of-place distance: the sum, over the
document's own most frequent n-grams, of how many ranks apart both lists have it, and the list
length for an n-gram the profile lacks.

Defined results: null, empty and letterless texts are ``und`` with score 0; a tie of distances goes to the
alphabetically first language; with no labelled text every document is ``und``; repeated rows count and come
out as often as they are there; a null id counts as the empty text in the fold; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adlake.llm.common import crc_fold, fresh, sliced

#: Ranks in a profile, and n-grams taken of a document.
RANKS = 400
#: More languages than this are refused: the profiles travel to every task.
MAX_LANGUAGES = 1000
#: Distinct n-grams a training task holds before it hands on partial counts.
FLUSH = 400_000
BORDER = 0x5F
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or the border for what is no letter."""
    if not _LETTER:
        table = np.full(0x110000, BORDER, dtype=np.int64)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _LETTER.append(table)
    return _LETTER[0]


def grams(text: str | None) -> np.ndarray:
    """All n-grams of a text as 63-bit codes (three fields of 21 bits), in no particular order."""
    if not text:
        return np.empty(0, dtype=np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    c = np.concatenate(([BORDER], _letters()[points], [BORDER]))
    c = c[np.concatenate(([True], (c[1:] != BORDER) | (c[:-1] != BORDER)))]
    inner = c != BORDER
    one = c[inner]
    two = c[:-1] << 21 | c[1:]
    three = (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[inner[1:-1]]
    return np.concatenate((one, two, three)) if len(one) else np.empty(0, dtype=np.int64)


def train(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", ranks: int = RANKS) -> DataFrame:
    """Profiles (lang, gram, rank from 0) from every row with a language.

    Tasks count n-grams with numpy and hand on one row for each language and n-gram; the sums
    are Spark's, and a window keeps the first ranks of each language: of each task's sums at most ``ranks`` rows of a
    language reach the one that ranks them.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows():
            for lang, (code, n) in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(code)), pa.array(code), pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        def add(lang: str, codes: list[np.ndarray]) -> None:
            code, n = np.unique(np.concatenate(codes), return_counts=True)
            if lang in held:
                code, back = np.unique(np.concatenate((held[lang][0], code)), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate((held[lang][1], n))).astype(np.int64)
            held[lang] = code, n.astype(np.int64)

        for batch in sliced(batches, 2048):
            waiting: dict[str, list[np.ndarray]] = {}
            size: dict[str, int] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                g = grams(text.as_py())
                if len(g):
                    waiting.setdefault(lang, []).append(g)
                    size[lang] = size.get(lang, 0) + len(g)
                    if size[lang] > 2_000_000:
                        add(lang, waiting.pop(lang))
                        size[lang] = 0
            for lang, codes in waiting.items():
                add(lang, codes)
            if sum(len(c) for c, _ in held.values()) > FLUSH:
                yield from rows()
        yield from rows()

    used = labelled.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    total = used.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    first = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    # the filter is on the row number itself: only so does Spark keep each task's first ranks of a language before it shuffles them
    numbered = total.withColumn("place", F.row_number().over(first)).where(F.col("place") <= ranks)
    return numbered.select("lang", "gram", (F.col("place") - 1).alias("rank"))


def collect_profiles(profiles: DataFrame, ranks: int = RANKS, max_languages: int = MAX_LANGUAGES) -> dict:
    """Profiles as arrays for the tasks: at most ``ranks`` rows of at most ``max_languages`` languages."""
    rows = profiles.limit(ranks * max_languages + 1).collect()
    langs = sorted({r["lang"] for r in rows})
    if len(langs) > max_languages or len(rows) > ranks * max_languages:
        raise ValueError(f"more than {max_languages} languages")
    code = np.array(sorted({r["gram"] for r in rows}), dtype=np.int64)
    place = np.full((len(code), len(langs)), -1, dtype=np.int64)
    where = {lang: k for k, lang in enumerate(langs)}
    for r in rows:
        place[np.searchsorted(code, r["gram"]), where[r["lang"]]] = r["rank"]
    return {"langs": langs, "code": code, "place": place, "ranks": ranks}


def nearest(text: str | None, model: dict) -> tuple[str, float]:
    """Language and score of one text: 1 less the distance as a share of the largest possible."""
    g = grams(text)
    if not len(g) or not model["langs"]:
        return "und", 0.0
    code, n = np.unique(g, return_counts=True)
    top = code[np.argsort(-n, kind="stable")[: model["ranks"]]]
    at = np.searchsorted(model["code"], top)
    at[at == len(model["code"])] = 0
    place = model["place"][at]
    place = np.where((model["code"][at] == top)[:, None], place, -1)
    apart = np.where(place >= 0, np.abs(place - np.arange(len(top))[:, None]), model["ranks"]).sum(axis=0)
    best = int(np.argmin(apart))
    return model["langs"][best], 1.0 - float(apart[best]) / (model["ranks"] * len(top))


def identify(model: dict, text: Column) -> Column:
    """Struct (lang, score) of a text column."""
    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            got = [nearest(t.as_py(), model) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array([x[0] for x in got], type=pa.string()), pa.array([x[1] for x in got], type=pa.float64())],
                names=["lang", "score"])

    return predict(text.cast("string"))


def identify_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       ranks: int = RANKS, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """Add (lang_pred, score, held_out) as one struct column ``language``, learned from the other folds."""
    train_docs = docs.where(crc_fold(id_col, folds) != held_fold)
    model = collect_profiles(train(train_docs, text_col, lang_col, ranks), ranks)
    out = fresh(docs, "language")
    found = docs.withColumn(out, identify(model, F.col(text_col)))
    return found, out


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    found, out = identify_documents(docs.select("doc_id", "text", "lang"))
    return found.select("doc_id", (crc_fold("doc_id", 4) == 2).alias("held_out"), F.col(out)["lang"].alias("lang_pred"),
                        F.col(out)["score"].alias("score"))


def keep_identified(docs: DataFrame, min_score: float = 0.05) -> DataFrame:
    """The documents whose text has a language: not ``und`` and not under ``min_score``; columns as given."""
    found, out = identify_documents(docs)
    return found.where((F.col(out)["lang"] != "und") & (F.col(out)["score"] >= min_score)).select(
        *[docs[c] for c in docs.columns])
