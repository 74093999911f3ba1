"""Benchmark decontamination by a broadcast hash set of normalised word windows.

Texts are lower-cased (A-Z) and cut into words of ASCII letters and digits and non-ASCII characters.
The windows of a test set are its items' runs of ``width`` words; an item of fewer words is one window.
Each task walks a document's words, looks every run up by hash, verifies the words of what it hits, and
marks the words of verified runs.  The test set is a stated query set: it is handled in blocks of at most
``block_windows`` windows, so that what travels to the tasks is bounded whatever the set's size.

Defined results: null and empty texts have no words and no hits, items without words no windows; equal windows
of several items hit all of them; repeated items count once (by id), repeated documents each; an empty
test set hits nothing; an item without id marks words but is no counted item; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import fresh, sliced, written

WIDTH = 10
#: Windows of the test set in one block (about 200 bytes each in a task).
BLOCK_WINDOWS = 200_000

#: Bytes of words stay (A-Z lowered), all others separate: [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing.
_KEEP = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
              for b in range(256))
_WORD_BYTE = np.frombuffer(_KEEP, dtype=np.uint8) != 0x20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


class Windows:
    """The windows of some items, by width; hashes for the first look, words for the verification."""

    def __init__(self, items: list[tuple[str | None, str | None]], width: int = WIDTH):
        self.word: dict[bytes, int] = {}
        self.by_width: dict[int, dict[tuple[int, ...], set]] = {}
        for item, text in items:
            ids = [self.word.setdefault(w, len(self.word)) for w in words_of(text)]
            size = min(width, len(ids))
            if size:
                held = self.by_width.setdefault(size, {})
                for k in range(len(ids) - size + 1):
                    held.setdefault(tuple(ids[k : k + size]), set()).add(item)
        self.hash = {size: np.sort(self.hashes(np.array([*held], dtype=np.int64))) for size, held in self.by_width.items()}

    @staticmethod
    def hashes(windows: np.ndarray) -> np.ndarray:
        """Polynomial hash of each row of word numbers."""
        h = np.zeros(len(windows), dtype=np.uint64)
        for column in windows.T:
            h = (h + column.astype(np.uint64) + np.uint64(1)) * _MIX
        return h

    def scan(self, text: str | None) -> tuple[int, np.ndarray, set]:
        """Number of words, a mark for each hit word, and the items with occurring windows."""
        words = words_of(text)
        hit, items = np.zeros(len(words), dtype=bool), set()
        get = self.word.get
        ids = np.fromiter((get(w, -1) for w in words), dtype=np.int64, count=len(words))
        known = ids >= 0
        if not known.any():
            return len(words), hit, items
        run = np.concatenate(([0], np.cumsum(known)))
        for size, held in self.by_width.items():
            if size > len(ids):
                continue
            start = np.flatnonzero(run[size:] - run[:-size] == size)
            if not len(start):
                continue
            h = np.zeros(len(start), dtype=np.uint64)
            for k in range(size):
                h = (h + ids[start + k].astype(np.uint64) + np.uint64(1)) * _MIX
            table = self.hash[size]
            at = np.searchsorted(table, h)
            at[at == len(table)] = 0
            for s in start[table[at] == h]:
                found = held.get(tuple(ids[s : s + size].tolist()))
                if found is not None:
                    hit[s : s + size] = True
                    items |= found
        return len(words), hit, items


def blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_windows: int) -> Iterator[Windows]:
    """The test set, block by block; one block is held at a time."""
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text")).distinct()
    held, size = [], 0
    for r in rows.toLocalIterator():
        held.append((r["item"], r["text"]))
        size += max(1, len(words_of(r["text"])))
        if size >= block_windows:
            yield Windows(held, width)
            held, size = [], 0
    if held or size == 0:
        yield Windows(held, width)


def scan(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
         width: int = WIDTH, block_windows: int = BLOCK_WINDOWS, out: str = "leak") -> DataFrame:
    """Add ``out``: struct (n_words, hit: word numbers that are hit, items: ids with occurring windows).

    A test set of one block (the usual case) takes one scan of the documents.  Beyond that each block is a pass
    of its own, written to the shared folder, so that a task holds one block at a time.
    """
    sc = docs.sparkSession.sparkContext
    frame, parts, before = docs, [], None
    for k, windows in enumerate(blocks(benchmark, item_col, item_text, width, block_windows)):
        if before is not None:
            frame = written(frame, "leak-block")
            before.destroy()
        before = sc.broadcast(windows)
        parts.append(fresh(frame, f"leak_block_{k}"))
        frame = frame.withColumn(parts[-1], _look_up(before)(F.col(text_col).cast("string")))
    if len(parts) == 1:
        both = F.col(parts[0])
    else:
        every = {f: F.array_sort(F.array_distinct(F.flatten(F.array(*[F.col(p)[f] for p in parts])))) for f in ("hit", "items")}
        both = F.struct(F.col(parts[0])["n_words"].alias("n_words"), every["hit"].alias("hit"), every["items"].alias("items"))
    return frame.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], both.alias(out))


def _look_up(shared):
    @F.arrow_udf("struct<n_words: bigint, hit: array<int>, items: array<string>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            n, hit, items = [], [], []
            for t in texts:
                a, b, c = shared.value.scan(t.as_py())
                n.append(a)
                hit.append(np.flatnonzero(b).astype(np.int32))
                items.append(sorted(x for x in c if x is not None))
            yield pa.StructArray.from_arrays(
                [pa.array(n, type=pa.int64()), pa.array(hit, type=pa.list_(pa.int32())),
                 pa.array(items, type=pa.list_(pa.string()))], names=["n_words", "hit", "items"])

    return found


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    found = scan(docs.select("doc_id", "text"), benchmark)
    n_hit = F.size("leak.hit").cast("bigint")
    return found.select(
        "doc_id", F.col("leak.n_words").alias("n_words"), n_hit.alias("n_hit"),
        F.size("leak.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("leak.items")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def cut_spans(text: str, hit: list[int]) -> str:
    """The text without the bytes from the first to the last character of each run of hit words."""
    raw = text.encode("utf-8", "surrogatepass")
    word = _WORD_BYTE[np.frombuffer(raw, dtype=np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
    begin, end = edge[::2], edge[1::2]
    parts, at = [], 0
    spans = np.array(hit, dtype=np.int64)
    for run in np.split(spans, np.flatnonzero(np.diff(spans) > 1) + 1):
        parts.append(raw[at : begin[run[0]]])
        at = end[run[-1]]
    return b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_share: float = 0.5, item_col: str = "item_id",
           item_text: str = "text", width: int = WIDTH, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """Remove benchmark words: hit spans are cut out, and a document goes if more than ``max_share`` of its words are hit.

    Spans are judged on the text as given.  A test set of one block is looked up and cut out in one pass and
    one worker; of several blocks all hits are gathered before anything is cut.
    """
    name = fresh(docs, "leak")
    each = blocks(benchmark, item_col, item_text, width, block_windows)
    first, more = next(each), next(each, None)
    if more is None:
        shared = docs.sparkSession.sparkContext.broadcast(first)

        @F.arrow_udf("struct<share: double, text: string>")
        def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in sliced(batches):
                share, out = [], []
                for t in texts.to_pylist():
                    n, hit, _ = shared.value.scan(t)
                    share.append(float(hit.sum()) / max(1, n))
                    out.append(cut_spans(t, np.flatnonzero(hit).tolist()) if hit.any() else t)
                yield pa.StructArray.from_arrays([pa.array(share, type=pa.float64()), pa.array(out, type=pa.string())], names=["share", "text"])

        # not to be moved below the filter, which would scan every text twice
        found = docs.withColumn(name, clean.asNondeterministic()(F.col(f"`{text_col}`").cast("string")))
    else:
        @F.arrow_udf("string")
        def cut(texts: pa.Array, hits: pa.Array) -> pa.Array:
            return pa.array([cut_spans(t, h) if t is not None and h else t
                             for t, h in zip(texts.to_pylist(), hits.to_pylist(), strict=True)], type=pa.string())

        found = scan(docs, benchmark, text_col, item_col, item_text, width, block_windows, out=name)
        found = found.withColumn(name, F.struct(
            (F.size(F.col(name)["hit"]) / F.greatest(F.col(name)["n_words"], F.lit(1))).alias("share"),
            cut(F.col(f"`{text_col}`"), F.col(name)["hit"]).alias("text")))
    text = F.col(name)["text"]
    left = found.where(F.col(name)["share"] <= max_share)
    return left.select(*[text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
