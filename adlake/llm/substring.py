"""Removal of long byte strings that occur more than once, by run-length Burrows-Wheeler indexes.

A string of ``length`` = 400 bytes is *repeated* if it also starts anywhere else; every byte that a repeated
string covers goes.  No text is compared with every other one:

1. Each window of ``length`` bytes has an anchor, the smallest hash of the 32-byte strings in it, which depends on
   the window's bytes only.  Runs of neighbouring windows with one anchor form a *piece*; equal windows always meet
   under the same anchor.  An anchor that occurs once in the corpus is done: nothing repeats there.
2. A piece that occurs twice or more repeats as a whole.
3. The different pieces of an anchor are laid together, with those of other anchors up to a batch, into one text,
   of which a run-compressed Burrows-Wheeler transform is built.  Longest matches can only begin anew at the ends of
   its runs, so match lengths are computed at the sampled run ends alone; streaming the samples in text order (each
   step loses one byte until the next sample) gives the matching statistics of the batch against itself, and
   stretches of at least ``length`` are marked.
4. Marks go back to all places of their pieces, and every distinct text is cut once.

An anchor whose different pieces exceed ``MAX_GROUP`` bytes does not enter an index: the digests of its
windows are counted by Spark instead, exactly and in any number.

Defined results: null counts as empty; a text shorter than ``length`` keeps all bytes; repeated rows are repeated
occurrences; rows with and without id are alike; cuts are bytes, so that what is left need not be valid UTF-8; other
columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import sliced, written

LENGTH = 400
GRAM = 32
#: Bytes of text segmented at once.
BLOCK = 1 << 20
#: Windows in a piece at most (a run of one anchor in a periodic text is cut).
PIECE = 1024
#: Bytes in one index; about 40 bytes of memory for each.
BATCH = 2 << 20
#: Bytes of different pieces under one anchor that still go into one index.
MAX_GROUP = 4 << 20
#: Bits of the map of the texts looked for, which travels to the tasks (2 MB whatever the corpus).
MAP_BITS = 24

_RNG = np.random.default_rng(11)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64)
_STEP = [np.uint64(int(x) | 1) for x in _RNG.integers(0, 1 << 63, 6, dtype=np.uint64)]


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[: -(width - size)], h[width - size :]) if width > size else h


def pieces(raw: bytes, length: int = LENGTH) -> Iterator[tuple[int, int, int, bool]]:
    """(anchor, start, end, inner) of the pieces of a text: the windows that share the anchor begin at start and on.

    ``inner``: the anchor stands in the piece twice or more, so that the piece may repeat windows within itself.
    """
    for at in range(0, len(raw) - length + 1, BLOCK):
        part = np.frombuffer(raw, dtype=np.uint8, offset=at, count=min(BLOCK + length - 1, len(raw) - at))
        h, size = _BYTE[part], 1
        for k in range(5):  # hashes of 2, 4 ... 32 bytes
            h = h[:-size] * _STEP[k] + h[size:]
            size *= 2
        h ^= h >> np.uint64(29)
        h *= _STEP[5]
        h ^= h >> np.uint64(32)
        least = _sliding_min(h, length - GRAM + 1)
        cut = np.union1d(np.flatnonzero(least[1:] != least[:-1]) + 1, np.arange(PIECE, len(least), PIECE))
        begin, end = np.concatenate(([0], cut)), np.concatenate((cut, [len(least)]))
        for a, b, e in zip(least[begin].view(np.int64).tolist(), begin.tolist(), end.tolist(), strict=True):
            inner = np.count_nonzero(h[b : e + length - GRAM] == least[b]) > 1
            yield a, at + b, at + e - 1 + length, inner


# -- the index of a batch

def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order and ranks of the suffixes of a text whose suffixes all differ.

    Prefix doubling that sorts only what still ties: ``rank`` is the first place of a suffix's group.  A suffix's key, its
    group and its place are packed in one number where they fit, so that plain numbers are sorted.
    """
    n, u = len(text), np.uint64
    seen = np.bincount(text)
    text = (np.cumsum(seen > 0) * (seen > 0))[text].astype(u)  # the symbols that occur, from 1 on
    bits, place_bits = int(text.max(initial=1)).bit_length(), n.bit_length()
    depth = max(1, (64 - place_bits) // bits)
    wide = np.concatenate((text, np.zeros(depth, dtype=u)))
    key = wide[:n].copy()
    for k in range(1, depth):
        key <<= u(bits)
        key |= wide[k : k + n]
    mask = u((1 << place_bits) - 1)

    def ordered(key: np.ndarray, p: np.ndarray, key_bits: int) -> tuple[np.ndarray, np.ndarray]:
        if key_bits + place_bits > 64:
            by = np.argsort(key)
            return key[by], p[by]
        key <<= u(place_bits)
        key |= p.astype(u)
        key.sort()
        return key >> u(place_bits), (key & mask).astype(np.int32)

    place = np.arange(n, dtype=np.int32)
    key, p = ordered(key, place, depth * bits)
    order, rank = p.copy(), np.zeros(n + 1, dtype=np.int32)
    while True:
        head = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(head, len(key)))
        rank[p] = np.repeat(place[head], size)
        more = size > 1
        tied = np.repeat(more, size)
        if not more.any():
            return order, rank
        p, place, size = p[tied], place[tied], size[more]
        key = np.repeat(np.arange(len(size), dtype=u) << u(place_bits), size)
        key |= rank[np.minimum(p + np.int32(min(depth, n)), np.int32(n))].astype(u)
        key, p = ordered(key, p, len(size).bit_length() + place_bits)
        order[place] = p
        depth *= 2


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at a and b, in steps of 64 symbols for those still equal."""
    out, left, n = np.zeros(len(a), dtype=np.int64), np.arange(len(a)), len(text)
    span = np.arange(64)
    while len(left):
        more = []
        for k in range(0, len(left), 1 << 14):
            part = left[k : k + (1 << 14)]
            x, y = (a[part] + out[part])[:, None] + span, (b[part] + out[part])[:, None] + span
            differ = (text[np.minimum(x, n - 1)] != text[np.minimum(y, n - 1)]) | (x >= n) | (y >= n)
            some = differ.any(axis=1)
            out[part] += np.where(some, differ.argmax(axis=1), 64)
            more.append(part[~some])
        left = np.concatenate(more)
    return out


def run_index(text: np.ndarray, separators: int = 0) -> dict[str, np.ndarray]:
    """Run-compressed transform: run symbols and lengths, and the text places of the suffixes at both ends of each run.

    The symbols below ``separators`` end the strings of the text, each another one.  They count as one symbol in the order of
    the suffixes, which so has a small alphabet, and as different ones everywhere else.
    """
    order, _ = suffix_array(np.maximum(text, separators - 1) if separators else text)
    before = text[order - 1]
    head = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
    tail = np.concatenate((head[1:] - 1, [len(order) - 1]))
    above = np.where(head > 0, order[head - 1], -1)
    below = np.where(tail < len(order) - 1, order[np.minimum(tail + 1, len(order) - 1)], -1)
    return {"symbol": before[head], "size": tail - head + 1, "head": order[head], "tail": order[tail], "above": above, "below": below}


def matched(text: np.ndarray, length: int = LENGTH, separators: int = 0) -> np.ndarray:
    """Marks the symbols that a string of ``length`` symbols covers that also starts elsewhere in the text.

    The longest match of a suffix with its neighbour above (below) in the order is one less than that of the suffix
    one to the left, unless the suffix stands at the head (tail) of a run.  So the sampled run ends carry all match
    lengths, and a sample of length v at place p stands for the matches of p, p+1, ... up to the next sample.
    (Where separators count as one symbol in the order, both hold for matches cut off at the next separator, as the suffix one to
    the left is cut off at the same.)
    """
    index = run_index(text, separators)
    cover = np.zeros(len(text) + 1, dtype=np.int64)
    for place, other in ((index["head"], index["above"]), (index["tail"], index["below"])):
        place, other = place[other >= 0], other[other >= 0]
        # only samples that reach ``length``: the symbols half way and at the end are looked at before the rest
        for at in {length - 1, length // 2, length // 4, 0}:
            x, y = place + at, other + at
            same = (x < len(text)) & (y < len(text))
            same[same] = text[x[same]] == text[y[same]]
            place, other = place[same], other[same]
        size = common_prefix(text, place, other)
        place, size = place[size >= length], size[size >= length]
        np.add.at(cover, place, 1)
        np.add.at(cover, place + size, -1)
    return np.cumsum(cover[:-1]) > 0


def marks(batch: list[bytes], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Spans of each string that are covered by strings of ``length`` bytes found twice or more in the batch."""
    parts, begin, at = [], [], 0
    for k, raw in enumerate(batch):  # each string ends in a separator of its own
        parts.append(np.frombuffer(raw, dtype=np.uint8).astype(np.int32) + len(batch))
        parts.append(np.array([k], dtype=np.int32))
        begin.append(at)
        at += len(raw) + 1
    hit = matched(np.concatenate(parts), length, len(batch)).view(np.int8)
    edge = np.diff(np.concatenate(([0], hit, [0])))
    a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out: list[list[tuple[int, int]]] = [[] for _ in batch]
    for k, x, y in zip(np.searchsorted(begin, a, side="right") - 1, a, b, strict=True):
        out[k].append((int(x) - begin[k], int(y) - begin[k]))
    return out


# -- Spark

SPANS = "array<struct<a: int, b: int>>"
#: A text's key: 96 bits of its SHA-256 as two numbers.
KEY = ["k1", "k2"]
#: A piece's place in its text, in one number: start, 11 bits of size, whether it ends the text, whether ``inner``.
_START, _SIZE, _LAST, _INNER = "shiftright(at, 13)", "(shiftright(at, 2) & 2047)", "(at & 2) > 0", "(at & 1) > 0"


def _key(raw: bytes) -> tuple[int, int]:
    sha = hashlib.sha256(raw).digest()
    return int.from_bytes(sha[:8], "big", signed=True), int.from_bytes(sha[8:12], "big")


def _key_columns(sha_hex: str) -> list[Column]:
    """The key of a text from the hex digits of its SHA-256."""
    return [F.conv(F.substring(sha_hex, 1, 16), 16, -10).cast("bigint").alias("k1"), F.conv(F.substring(sha_hex, 17, 8), 16, 10).cast("bigint").alias("k2")]


def _segment(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = []
            for text in batch.column(0).cast(pa.binary()):
                raw = text.as_py()
                key = _key(raw)
                rows += [(a, xxhash.xxh3_64_intdigest(raw[b:e]) - (1 << 63), *key, b << 13 | (e - b) << 2 | (e == len(raw)) << 1 | again)
                         for a, b, e, again in pieces(raw, length)]
            table = np.array(rows, dtype=np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in table.T], names=["anchor", "piece", *KEY, "at"])

    return run


def _index(length: int):
    """Pieces, sorted by anchor, go into indexes of whole anchors; yields the marked spans of each piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []
        group: dict[int, bytes] = {}
        anchor, size, own = None, 0, 0

        def flush():
            nonlocal held, size
            todo, held, size = held, [], 0
            if not todo:
                return
            out = [(a, p, s) for (a, p, _), s in zip(todo, marks([raw for *_, raw in todo], length), strict=True) if s]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], type=pa.int64()), pa.array([x[1] for x in out], type=pa.int64()),
                 pa.array([[{"a": a, "b": b} for a, b in x[2]] for x in out], type=pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))],
                names=["anchor", "piece", "spans"])

        for batch in batches:
            for a, p, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                if a != anchor:
                    if size and size + own > BATCH:
                        yield from flush()
                    held += [(anchor, k, v) for k, v in group.items()]
                    size, anchor, own = size + own, a, 0
                    group = {}
                if p not in group:
                    group[p] = raw
                    own += len(raw)
        if size and size + own > BATCH:
            yield from flush()
        held += [(anchor, k, v) for k, v in group.items()]
        yield from flush()

    return run


def _digests(length: int):
    """(anchor, digest, piece, offset) of every window of the pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, p, raw in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                n = len(raw) - length + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([a] * n, type=pa.int64()), pa.array([xxhash.xxh3_128_digest(raw[k : k + length]) for k in range(n)], type=pa.binary()),
                     pa.array([p] * n, type=pa.int64()), pa.array(range(n), type=pa.int32())], names=["anchor", "digest", "piece", "at"])

    return run


def _pick(shared):
    """(key, raw) of the texts whose bit is set, each at most once for each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in sliced(batches):
            rows, keys = [], []
            for k, text in enumerate(batch.column(0).cast(pa.binary())):
                key = _key(text.as_py())
                bit = (key[0] & (1 << 64) - 1) >> (64 - MAP_BITS)
                if shared.value[bit >> 3] >> (bit & 7) & 1 and key not in seen:
                    seen.add(key)
                    rows.append(k)
                    keys.append(key)
            table = np.array(keys, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c) for c in table.T], batch.column(0).take(pa.array(rows, type=pa.int64()))], names=[*KEY, "raw"])

    return run


def _bit_map(keys: DataFrame) -> bytes:
    """A map of 2**MAP_BITS bits with the first bits of each key set; Spark builds it in parts of 4 KB."""
    rows = keys.select(F.shiftrightunsigned("k1", 64 - MAP_BITS).alias("bit")).groupBy(F.shiftrightunsigned("bit", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits")).collect()
    out = bytearray(1 << (MAP_BITS - 3))
    for r in rows:
        out[r["part"] * 4096 : (r["part"] + 1) * 4096] = r["bits"]
    return bytes(out)


def _picked(long: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, raw) of at least the texts whose keys are given; few others, and no text more than once for each task."""
    bits = long.sparkSession.sparkContext.broadcast(_bit_map(keys))
    return long.mapInArrow(_pick(bits), "k1 bigint, k2 bigint, raw string")


def united(spans: Column) -> Column:
    """Spans in order, those that overlap or touch made one."""
    @F.arrow_udf(SPANS)
    def apply(places: pa.Array) -> pa.Array:
        rows = []
        for row in places:
            a, b = (row.values.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
            order = np.argsort(a, kind="stable")
            a, top = a[order], np.maximum.accumulate(b[order])
            first = np.concatenate(([True], a[1:] > top[:-1]))
            last = np.concatenate((first[1:], [True]))
            rows.append([{"a": x, "b": y} for x, y in zip(a[first].tolist(), top[last].tolist(), strict=True)])
        return pa.array(rows, type=pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])))

    return apply(spans)


def long_texts(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    return docs.select(F.col(text_col).cast("string").alias("raw")).where(F.octet_length("raw") >= length)


def repeated_spans(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(k1, k2, spans, whole) of every distinct text with repeated strings: its key, the spans that they cover, in
    bytes, in order and apart, and whether they cover all of it.
    """
    if length < 2 * GRAM or PIECE + length > 2048:
        raise ValueError(f"length must be from {2 * GRAM} to {2048 - PIECE}")
    long = long_texts(docs, text_col, length)
    every = written(long.mapInArrow(_segment(length), "anchor bigint, piece bigint, k1 bigint, k2 bigint, at bigint"), "pieces")
    again = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("at").bitwiseAND(1)).alias("inner")).where(
        "n > 1 OR inner = 1").select("anchor")
    spots = written(every.join(again, "anchor").groupBy("anchor", "piece", *KEY, "at").agg(F.count(F.lit(1)).alias("n")), "piece-spots")
    kinds = written(spots.groupBy("anchor", "piece").agg(
        F.sum("n").alias("n"), *[F.first(c).alias(c) for c in (*KEY, "at")]), "piece-kinds")  # any one place stands for a piece
    several = kinds.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("kinds"), F.max(F.expr(f"{_INNER} AND n = 1")).alias("inner"),
        F.sum(F.expr(_SIZE)).alias("bytes")).where("kinds > 1 OR inner").select("anchor", "bytes")

    wanted = kinds.join(several, "anchor").select("anchor", "piece", *KEY, F.expr(_START).alias("start"), F.expr(_SIZE).alias("size"),
                                                  (F.col("bytes") > MAX_GROUP).alias("large"))
    wanted = written(wanted, "piece-wanted")
    fetched = _picked(long, wanted).join(wanted, KEY).select(
        "anchor", "piece", F.expr("substring(cast(raw AS binary), cast(start + 1 AS int), cast(size AS int))").alias("raw"), "large")
    small = fetched.where("NOT large").select("anchor", "piece", "raw")
    found = small.repartition(F.col("anchor")).sortWithinPartitions("anchor").mapInArrow(_index(length), f"anchor bigint, piece bigint, spans {SPANS}")
    parts = [kinds.where("n > 1").select("anchor", "piece", F.expr(f"array(struct(0 AS a, cast({_SIZE} AS int) AS b))").alias("spans")), found]
    if wanted.where("large").limit(1).count():
        window = fetched.where("large").select("anchor", "piece", "raw").dropDuplicates(["anchor", "piece"]).mapInArrow(
            _digests(length), "anchor bigint, digest binary, piece bigint, at int")
        twice = window.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", "digest")
        parts.append(window.join(twice, ["anchor", "digest"]).groupBy("anchor", "piece").agg(
            F.collect_set(F.struct(F.col("at").alias("a"), (F.col("at") + length).alias("b"))).alias("spans")))
    marked = parts[0]
    for p in parts[1:]:
        marked = marked.union(p)
    marked = marked.groupBy("anchor", "piece").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    moved = F.expr(f"transform(spans, s -> struct(cast(s.a + {_START} AS int) AS a, cast(s.b + {_START} AS int) AS b))")
    placed = spots.join(marked, ["anchor", "piece"]).groupBy(*KEY).agg(
        F.flatten(F.collect_list(moved)).alias("spans"), F.max(F.expr(f"CASE WHEN {_LAST} THEN {_START} + {_SIZE} END")).alias("end"))
    one = placed.select(*KEY, united(F.col("spans")).alias("spans"), "end")
    whole = F.expr("size(spans) = 1 AND spans[0].a = 0 AND coalesce(spans[0].b = end, false)")
    return written(one.select(*KEY, "spans", whole.alias("whole")), "repeated-spans")


def cut(raw: Column, spans: Column) -> Column:
    """Struct (n_removed bytes, n_spans: maximal runs of them, kept: the bytes outside the spans)."""
    @F.arrow_udf("struct<n_removed: bigint, n_spans: bigint, kept: binary>")
    def apply(texts: pa.Array, places: pa.Array) -> pa.Array:
        removed, runs, kept = [], [], []
        for text, row in zip(texts.cast(pa.binary()).to_pylist(), places, strict=True):
            cover = np.zeros(len(text) + 1, dtype=np.int32)
            flat = row.values
            np.add.at(cover, flat.field("a").to_numpy(zero_copy_only=False), 1)
            np.add.at(cover, flat.field("b").to_numpy(zero_copy_only=False), -1)
            hit = np.cumsum(cover[:-1]) > 0
            removed.append(int(hit.sum()))
            runs.append(int(np.count_nonzero(np.diff(np.concatenate(([0], hit.view(np.int8)))) == 1)))
            kept.append(np.frombuffer(text, dtype=np.uint8)[~hit].tobytes())
        return pa.StructArray.from_arrays(
            [pa.array(removed, type=pa.int64()), pa.array(runs, type=pa.int64()), pa.array(kept, type=pa.binary())],
            names=["n_removed", "n_spans", "kept"])

    return apply(raw, spans)


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(k1, k2, n_removed, n_spans, kept) of every distinct text that loses bytes; ``kept`` is binary.

    A text that goes as a whole is not looked at again; of the others each distinct one is shuffled once.
    """
    spans = repeated_spans(docs, text_col, length)
    gone = spans.where("whole").select(*KEY, F.expr("cast(spans[0].b AS bigint)").alias("n_removed"), F.lit(1).cast("bigint").alias("n_spans"),
                                       F.lit(b"").alias("kept"))
    part = spans.where("NOT whole").select(*KEY, "spans")
    texts = _picked(long_texts(docs, text_col, length), part).dropDuplicates(KEY)
    left = texts.join(part, KEY).select(*KEY, cut(F.col("raw"), F.col("spans")).alias("cut"))
    return gone.union(left.select(*KEY, "cut.n_removed", "cut.n_spans", "cut.kept"))


def report(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    own = docs.select("doc_id", F.octet_length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("sha"))
    own = own.select("doc_id", "n_bytes", "sha", *_key_columns("sha"))
    lost = remove_repeats(docs.select("text"), "text", length).select(*KEY, "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    return own.join(lost, KEY, "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("bigint")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def removed_by_definition(texts: list[str | None], length: int = LENGTH) -> list[tuple[int, int, int, str]]:
    """(n_bytes, n_removed, n_spans, kept_sha256) by counting every window: the definition, for tests."""
    raws, count = [(t or "").encode() for t in texts], {}
    for raw in raws:
        for k in range(len(raw) - length + 1):
            count[raw[k : k + length]] = count.get(raw[k : k + length], 0) + 1
    out = []
    for raw in raws:
        hit = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if count[raw[k : k + length]] > 1:
                hit[k : k + length] = b"\x01" * length
        kept = bytes(b for b, x in zip(raw, hit, strict=True) if not x)
        out.append((len(raw), sum(hit), bytes([0, *hit]).count(b"\x00\x01"), hashlib.sha256(kept).hexdigest()))
    return out
