"""Language-model scores by Brown class-based bigrams.

Units are all words found ``LEAST`` times or more, and the last bytes of all other words (a rarer word is modelled as its
ending followed by the word among those with that ending; endings of fewer tokens are one unit).  Exchange clustering assigns
every unit to a class.  It begins with a core, the most frequent words and endings, which fits one matrix: from a
round-robin start each of its units moves to the class that raises the class-bigram likelihood most, sweep after sweep.  All
units then start in the class of their core unit (a word outside the core: its ending's) and are exchanged in Spark: the tasks
count unit bigrams by class, packed in one row for each part of the units, Spark brings the rows of a part together, and in each
round every unit, against the classes of the round before, moves to its best class; a round that does not raise the likelihood of the whole is undone and ends the exchange.
A text's probability is the product, over its tokens, of the class transition, the unit within its class and, for
words outside the frequent ones, the word within its ending, each smoothed:

    (n(c', c) + K p(c)) / (n(c') + K),   (n(u) + 1/2) / (n(c) + units(c)/2),   (n(w) + 1) / (n(e) + words(e) + 1)

Counts of words, units and unit bigrams cover all training texts.  The model that travels is bounded by its parameters
(core units squared, ``HOT`` words, three-byte endings); counts and classes of all other words stay in Spark and meet the texts
in joins.  A bit map of those that have a class travels, so that few others are looked for.

Defined results: a null or empty text has the end token only; with no training text every count is zero and the
scores follow from the formulas; repeated rows count and come out as often as they are there; a null id
counts as the empty text in the fold; other columns play no part.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import crc_fold, sliced, written

#: Words and endings of the core, whose classes the exchange in Spark begins with.
WORDS, ENDINGS = 1000, 500
#: Tokens from which on a word, or an ending of rarer words, is a unit of its own.
LEAST = 50
ENDING = 3
CLASSES = 48
SWEEPS = 6
#: Rounds of the exchange in Spark at most, and the part by which a round must raise the likelihood for another one.
ROUNDS, RISE = 2, 0.001
#: Words whose counts travel to the tasks; those of all others are joined.
HOT = 150_000
#: Weight of the class frequencies in the transitions.
SMOOTH = 20.0
#: Distinct words or unit pairs a task holds before it hands on partial counts.
FLUSH = 250_000
#: Tokens of which a task counts unit pairs at once.
BLOCK = 2_000_000
#: Bits of the map of words that have a class and do not travel (2 MB whatever the corpus).
MAP_BITS = 24

#: Parts that counts are dealt to; a task hands on one row for each, with all its numbers packed.
PARTS_BITS = 11
#: Unit pairs in a packed row of the whole counts.
PACK = 8192
#: Deals unit pairs evenly to parts, and back.
MIX = 0x9E3779B97F4A7C15
UNMIX = pow(MIX, -1, 1 << 64)
#: A unit pair is one number: the first unit, shifted, and the second.
PAIR = 32

#: A transition's classes, and its words whose classes are to be looked up.
LINK = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]

END, REST = 0, 1  # units: the end token, and endings that are no unit


def tokens_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[bytes | None]:
    for t in batch.column(column).cast(pa.binary()):
        yield t.as_py()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over one text column: counted in the tasks, summed by Spark."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), type=pa.binary()), pa.array(list(held.values()), type=pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for text in _texts(batch, 0):
                held.update(tokens_of(text))
                if len(held) > FLUSH:
                    yield rows()
        yield rows()

    return texts.mapInArrow(count, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Lookup(dict):
    """Word -> its number if its count travels, else the complement of its ending's unit, less ``ASK`` if it may have a class.

    The empty word stands for the end token.
    """

    ASK = 1 << 40

    def __init__(self, hot: list[bytes], ending: dict[bytes, int], bits: bytes | None = None):
        super().__init__((w, k) for k, w in enumerate(hot))
        self[b""] = ~END
        self.ending, self.bits = ending, bits

    def __missing__(self, word: bytes) -> int:
        unit = ~self.ending.get(word[-ENDING:], REST)
        if self.bits is not None:
            bit = zlib.crc32(word) >> (32 - MAP_BITS)
            if self.bits[bit >> 3] >> (bit & 7) & 1:
                return unit - self.ASK
        return unit


_LOOKUPS: dict[str, Lookup] = {}


def _lookup(model: dict) -> Lookup:
    if model["key"] not in _LOOKUPS:
        _LOOKUPS.clear()
        _LOOKUPS[model["key"]] = Lookup(model["hot"], model["ending"], model["bits"])
    return _LOOKUPS[model["key"]]


def _flat(batch: pa.RecordBatch, column: int) -> list[bytes]:
    """The words of all texts, an empty one before the first text and after each."""
    words = [b""]
    for text in _texts(batch, column):
        words += tokens_of(text)
        words.append(b"")
    return words


def _numbers(model: dict, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lookup numbers and units of words, and which of these may have a class that does not travel."""
    number = np.fromiter(map(_lookup(model).__getitem__, words), dtype=np.int64, count=len(words))
    ask = number < -(Lookup.ASK >> 1)
    number = np.where(ask, number + Lookup.ASK, number)
    return number, np.where(number >= 0, model["unit"][np.maximum(number, 0)], ~number), ask


def _bit_map(words: DataFrame) -> bytes:
    """A map of 2**MAP_BITS bits with the first bits of each word's crc32 set; Spark builds it in parts of 4 KB."""
    rows = words.select(F.shiftright(F.crc32("word"), 32 - MAP_BITS).alias("bit")).groupBy(F.shiftright("bit", 15).alias("part")).agg(
        F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits")).collect()
    out = bytearray(1 << (MAP_BITS - 3))
    for r in rows:
        out[r["part"] * 4096 : (r["part"] + 1) * 4096] = r["bits"]
    return bytes(out)


def _named(words: list[bytes], ask: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """The words at these places, where they are to be looked up."""
    return [words[k] if x else None for k, x in zip(at.tolist(), ask[at].tolist(), strict=True)]


def _packed(part: np.ndarray, key: np.ndarray, n: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """One row for each part, given in order: the part, and its keys and their counts in one string."""
    part, first = np.unique(part, return_index=True)
    edge = [*first.tolist(), len(key)]
    return pa.array(part.astype(np.int64)), pa.array([key[x:y].tobytes() + n[x:y].tobytes() for x, y in zip(edge[:-1], edge[1:], strict=True)], type=pa.binary())


def _unpacked(cells: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of packed rows."""
    both = [np.frombuffer(c, dtype=np.int64).reshape(2, -1) for c in cells]
    return tuple(np.concatenate([np.zeros(0, dtype=np.int64), *[x[k] for x in both]]) for k in (0, 1))


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sums of their counts."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(key)), dtype=bool), key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n[order], first) if len(key) else n


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[tuple]]]:
    """Keys and counts of the packed rows, and the other rows, of each part; rows (part, cells or none, other columns) sorted by part."""
    part, cells, single = None, [], []
    for batch in batches:
        for p, packed, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if p != part and part is not None:
                yield *_unpacked(cells), single
                cells, single = [], []
            part = p
            if packed is None:
                single.append(tuple(row))
            else:
                cells.append(packed)
    if part is not None:
        yield *_unpacked(cells), single


def unit_bigrams(texts: DataFrame, shared) -> DataFrame:
    """Bigrams of units a, b over all texts, the end token before the first and after the last word: packed rows (cells) of units that
    are known, and rows (pair, aw, bw, n), where ``aw`` and ``bw`` name words whose unit is still to be looked up, and is a or b if there is none."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        waiting, held = [], 0
        odd: dict[tuple, int] = {}

        def rows() -> pa.RecordBatch:
            nonlocal waiting, held
            key, n = np.unique(np.concatenate(waiting or [np.zeros(0, dtype=np.uint64)]) * np.uint64(MIX), return_counts=True)
            known, keys = _packed(key >> np.uint64(64 - PARTS_BITS), key, n), list(odd)
            single = [pa.nulls(len(keys), pa.int64()), pa.nulls(len(keys), pa.binary()), pa.array([k[0] for k in keys], type=pa.int64()),
                      *[pa.array([k[c] for k in keys], type=pa.binary()) for c in (1, 2)], pa.array(list(odd.values()), type=pa.int64())]
            many = [*known, *[pa.nulls(len(known[0]), c.type) for c in single[2:]]]
            waiting, held = [], 0
            odd.clear()
            return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(many, single, strict=True)], names=["part", "cells", "pair", "aw", "bw", "n"])

        for batch in sliced(batches):
            words = _flat(batch, 0)
            _, unit, ask = _numbers(model, words)
            pair, some = unit[:-1] << PAIR | unit[1:], ask[:-1] | ask[1:]
            if some.any():
                at = np.flatnonzero(some)
                for k in zip(pair[at].tolist(), _named(words, ask, at), _named(words, ask, at + 1), strict=True):
                    odd[k] = odd.get(k, 0) + 1
                pair = pair[~some]
            waiting.append(pair.view(np.uint64))
            held += len(pair)
            if held > BLOCK or len(odd) > FLUSH:
                yield rows()
        yield rows()

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["cells", "pair", "aw", "bw", "n"]
        for key, n, single in _parts(batches):
            key, n = _summed((key.view(np.uint64) * np.uint64(UNMIX)).view(np.int64), n)
            if len(key):
                cells = _packed(np.arange(len(key)) // PACK, key, n)[1]
                yield pa.RecordBatch.from_arrays([cells, *[pa.nulls(len(cells), t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.int64())]], names=names)
            odd: dict[tuple, int] = {}
            for *k, m in single:
                odd[tuple(k)] = odd.get(tuple(k), 0) + m
            if odd:
                own = [pa.array([k[c] for k in odd], type=t) for c, t in enumerate((pa.int64(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(odd), pa.binary()), *own, pa.array(list(odd.values()), type=pa.int64())], names=names)

    found = texts.mapInArrow(count, "part bigint, cells binary, pair bigint, aw binary, bw binary, n bigint")
    found = found.withColumn("part", F.coalesce("part", F.pmod(F.xxhash64("pair", "aw", "bw"), F.lit(1 << PARTS_BITS))))
    return found.repartition("part").sortWithinPartitions("part").mapInArrow(whole, "cells binary, pair bigint, aw binary, bw binary, n bigint")


def _looked_up(rows: DataFrame, cold: DataFrame, name: str, word: str, value: str) -> DataFrame:
    """Column ``name`` replaced by the ``value`` that ``cold`` has for the word in column ``word``, if any.  Rows without a word are dealt out."""
    key = F.coalesce(word, F.concat(F.lit(" "), F.pmod(F.xxhash64(*rows.columns), F.lit(1000)).cast("string")).cast("binary"))
    there = cold.select(F.col("word").alias("_word"), F.col(value).alias("_value"))
    return rows.withColumn("_key", key).join(there, F.col("_key") == F.col("_word"), "left").select(
        *[F.coalesce("_value", name).alias(c) if c == name else c for c in rows.columns])


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def exchange(n: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Classes of units by the exchange algorithm on their bigram counts; the end token keeps class 0 alone.

    The likelihood of a class bigram model is, up to a constant, the sum of h(n(c', c)) less those of
    h(n(c', .)) and h(n(., c)), with h(x) = x log x.  Ties go to the lowest class.
    """
    units = len(n)
    classes = max(2, min(classes, units))
    cls = np.zeros(units, dtype=np.int64)
    by_count = [u for u in np.argsort(-n.sum(axis=0), kind="stable") if u != END]
    cls[by_count] = 1 + np.arange(units - 1) % (classes - 1)
    member = np.eye(classes)[cls]
    pair = member.T @ n @ member
    for _ in range(sweeps):
        moved = 0
        for w in by_count:
            own, a = n[w, w], cls[w]
            right = np.bincount(cls, weights=n[w], minlength=classes)
            left = np.bincount(cls, weights=n[:, w], minlength=classes)
            right[a] -= own
            left[a] -= own
            pair[a] -= right
            pair[:, a] -= left
            pair[a, a] -= own
            row, col = pair.sum(axis=1) + left, pair.sum(axis=0) + right  # the links with other units, wherever w goes
            held = _h(pair)
            diag = np.arange(classes)
            gain = (_h(pair + right) - held).sum(axis=1) + (_h(pair.T + left) - held.T).sum(axis=1)
            gain -= _h(pair[diag, diag] + right) + _h(pair[diag, diag] + left) - 2 * held[diag, diag]
            gain += _h(pair[diag, diag] + right + left + own) - held[diag, diag]
            gain -= _h(row + right.sum() + own) - _h(row) + _h(col + left.sum() + own) - _h(col)
            gain[0] = -np.inf
            b = int(np.argmax(gain))
            if b != a and gain[b] <= gain[a] + 1e-9:
                b = a
            moved += b != a
            cls[w] = b
            pair[b] += right
            pair[:, b] += left
            pair[b, b] += own
        if not moved:
            break
    return cls


def likelihood(pair: np.ndarray) -> float:
    """What the classes add to the log-likelihood of the bigrams."""
    return float(_h(pair).sum() - _h(pair.sum(axis=1)).sum() - _h(pair.sum(axis=0)).sum())


def best_classes(pair: np.ndarray, cls: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The class of each unit that raises the likelihood most if it alone moves; ``right`` and ``left`` are its counts by the class of
    the unit after and before it, without ``own``, those with itself.  As in ``exchange``, for many units at once."""
    m, size = right.shape
    unit, diag = np.arange(m), np.arange(size)
    p = np.repeat(pair[None], m, axis=0)
    p[unit, cls] -= right
    p[unit, :, cls] -= left
    p[unit, cls, cls] -= own
    row, col, held = p.sum(axis=2) + left, p.sum(axis=1) + right, _h(p)
    gain = (_h(p + right[:, None, :]) - held).sum(axis=2) + (_h(p + left[:, :, None]) - held).sum(axis=1)
    d, h = p[:, diag, diag], held[:, diag, diag]
    gain -= _h(d + right) + _h(d + left) - 2 * h
    gain += _h(d + right + left + own[:, None]) - h
    gain -= _h(row + (right.sum(axis=1) + own)[:, None]) - _h(row) + _h(col + (left.sum(axis=1) + own)[:, None]) - _h(col)
    gain[:, 0] = -np.inf
    best = gain.argmax(axis=1)
    return np.where(gain[unit, best] <= gain[unit, cls] + 1e-9, cls, best)


#: Rows of counts by key: packed ones of a part, and single ones.
COUNTS = "part bigint, cells binary, key bigint, n bigint"


def _counts(part: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    part, cells = _packed(part, key, n)
    return pa.RecordBatch.from_arrays([part, cells, *[pa.nulls(len(part), pa.int64())] * 2], names=["part", "cells", "key", "n"])


def _both(key: np.ndarray, n: np.ndarray, single: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Sums by key of a part's packed rows and single ones (key, n)."""
    more = np.array(single, dtype=np.int64).reshape(-1, 2)
    return _summed(np.concatenate((key, more[:, 0])), np.concatenate((n, more[:, 1])))


def _width(size: int) -> int:
    """Cells of a unit: counts by the class of the unit after and before it, the count with itself, its own class."""
    return 3 * size + 1


def _class_cells(shared, dense: int, size: int):
    """Packed bigrams to counts by unit and cell, without the units' own classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, width = shared.value, 2 * size + 1
        held = np.zeros(dense * width, dtype=np.int64)
        for batch in batches:
            for cells in batch.column(0):
                pair, n = _unpacked([cells.as_py()])
                a, b = pair >> PAIR, pair & ((1 << PAIR) - 1)
                np.add.at(held, a * width + cls[b], n)
                np.add.at(held, b * width + size + cls[a], n)
                same = a == b
                np.add.at(held, a[same] * width + 2 * size, n[same])
        at = np.flatnonzero(held)
        n, unit = held[at], at // width
        del held
        yield _counts(unit // _step(dense), unit * _width(size) + at % width, n)

    return run


def _step(dense: int) -> int:
    """Units in a part."""
    return -(-dense >> PARTS_BITS) or 1


def _code_pairs(shared, size: int):
    """Packed bigrams to counts by the codes of both units, x * size + y; a part is a code x."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, held = shared.value, np.zeros(size * size, dtype=np.int64)
        for batch in batches:
            for cells in batch.column(0):
                pair, n = _unpacked([cells.as_py()])
                np.add.at(held, code[pair >> PAIR] * size + code[pair & ((1 << PAIR) - 1)], n)
        at = np.flatnonzero(held)
        yield _counts(at // size, at, held[at])

    return run


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts, sorted by part, to (key, n)."""
    for part in _parts(batches):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in _both(*part)], names=["key", "n"])


def _moves(shared):
    """Counts by unit and cell, sorted by part, to the class of each unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = shared.value
        size, width = len(pair), _width(len(pair))
        for part in _parts(batches):
            key, n = _both(*part)
            units = np.unique(key // width)
            for k in range(0, len(units), 128):
                some = units[k : k + 128]
                x, y = np.searchsorted(key, (some[0] * width, (some[-1] + 1) * width))
                cell = np.zeros((len(some), width))
                cell[np.searchsorted(some, key[x:y] // width), key[x:y] % width] = n[x:y]
                right, left, own, cls = cell[:, :size], cell[:, size : 2 * size], cell[:, 2 * size], cell[:, 2 * size + 1 :].argmax(axis=1)
                each = np.arange(len(some))
                right[each, cls] -= own
                left[each, cls] -= own
                best = np.where(some == END, cls, best_classes(pair, cls, right, left, own))
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(best)], names=["unit", "cls"])

    return run


def _classed(rows: DataFrame, cls: DataFrame, unit: str, name: str, dense: int) -> DataFrame:
    """``rows`` with the class of the unit in column ``unit``.  The classes of the units that travel are broadcast, so that the rows stay
    where they are; only those with another unit are shuffled."""
    def to(part: DataFrame) -> DataFrame:
        return part.select(F.col("unit").alias(unit), F.col("cls").alias(name))

    travels = F.col("unit") < dense
    near = rows.where(F.col(unit) < dense).join(F.broadcast(to(cls.where(travels))), unit)
    return near.unionByName(rows.where(F.col(unit) >= dense).join(to(cls.where(~travels)), unit))


class Bigrams:
    """Unit bigrams: ``near`` (cells) packed, of units that travel, all below ``dense``; ``far`` (a, b, n) of others, or None."""

    def __init__(self, near: DataFrame, far: DataFrame | None, dense: int):
        self.near, self.far, self.dense = near, far, dense

    def broadcast(self, cls: DataFrame):
        """The classes (unit, cls) of the units that travel."""
        own, out = cls.where(F.col("unit") < self.dense).toArrow(), np.zeros(self.dense, dtype=np.int64)
        out[own["unit"].to_numpy()] = own["cls"].to_numpy()
        return cls.sparkSession.sparkContext.broadcast(out)

    def code_pairs(self, cls: DataFrame, shared, size: int) -> np.ndarray:
        """Counts of the bigrams by the codes of both units."""
        found = self.near.mapInArrow(_code_pairs(shared, size), COUNTS)
        if self.far is not None:
            far = _classed(_classed(self.far, cls, "a", "x", self.dense), cls, "b", "y", self.dense).groupBy("x", "y").agg(F.sum("n").alias("n"))
            found = found.union(far.select("x", F.lit(None).cast("binary"), F.col("x") * size + F.col("y"), "n"))
        found = found.repartition("part").sortWithinPartitions("part").mapInArrow(_sums, "key bigint, n bigint").toArrow()
        out = np.zeros(size * size)
        out[found["key"].to_numpy()] = found["n"].to_numpy()
        return out.reshape(size, size)

    def moved(self, cls: DataFrame, shared, pair: np.ndarray) -> DataFrame:
        """The class of each unit that is best against the others' classes."""
        size = len(pair)

        def single(rows: DataFrame, unit: str, cell: Column, n: Column) -> DataFrame:
            return rows.select(F.expr(f"{unit} DIV {_step(self.dense)}").alias("part"), F.lit(None).cast("binary").alias("cells"),
                               (F.col(unit) * _width(size) + cell).cast("bigint").alias("key"), n.cast("bigint").alias("n"))

        found = self.near.mapInArrow(_class_cells(shared, self.dense, size), COUNTS).union(single(cls, "unit", F.col("cls") + 2 * size + 1, F.lit(1)))
        if self.far is not None:
            for side, here, there in ((0, "a", "b"), (1, "b", "a")):
                rows = _classed(self.far, cls, there, "c", self.dense).groupBy(here, "c").agg(F.sum("n").alias("n"))
                found = found.union(single(rows, here, F.col("c") + side * size, F.col("n")))
            found = found.union(single(self.far.where("a = b"), "a", F.lit(2 * size), F.col("n")))
        known = cls.sparkSession.sparkContext.broadcast(pair)
        return written(found.repartition("part").sortWithinPartitions("part").mapInArrow(_moves(known), "unit bigint, cls bigint"), "classes")


def spread(bigrams: Bigrams, cls: DataFrame, pair: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """Classes (unit, cls) after the exchange of all units, and the counts of class pairs, from those given on, round by round."""
    shared = bigrams.broadcast(cls)
    for _ in range(rounds):
        moved = bigrams.moved(cls, shared, pair)
        shared = bigrams.broadcast(moved)
        new = bigrams.code_pairs(moved, shared, len(pair))
        before, after = likelihood(pair), likelihood(new)
        if after <= before:
            break
        cls, pair = moved, new
        if after - before < RISE * abs(before):
            break
    return cls, pair


def train(texts: DataFrame, words: int = WORDS, endings: int = ENDINGS, classes: int = CLASSES, hot: int = HOT,
          sweeps: int = SWEEPS, least: int = LEAST, rounds: int = ROUNDS) -> tuple[dict, DataFrame]:
    """(model, counts) from one column of texts; ``counts`` (word, n, emit) of all words is written to the shared folder.

    ``emit`` is for words that have a class and do not travel.  ``model["cold"]`` has their units and classes, or is None.
    """
    spark = texts.sparkSession
    counts = written(word_counts(texts), "word-counts")
    n_docs = texts.count()
    total = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(hot).toArrow()
    hot_words, hot_n = top["word"].to_pylist(), top["n"].to_numpy().astype(np.float64)
    n_core = min(words, len(hot_words))
    many = max(n_core, int((hot_n >= least).sum()))  # the hot words that have a class of their own: the first ones
    core = F.lit(False)
    if n_core:
        low, word = int(hot_n[n_core - 1]), hot_words[n_core - 1]
        core = (F.col("n") > low) | ((F.col("n") == low) & (F.col("word") <= F.lit(word)))
    ending_of = f"substring(word, greatest(length(word) - {ENDING - 1}, 1), {ENDING})"
    rest = counts.where(~core).select("n", F.expr(ending_of).alias("ending"), (F.col("n") < least).alias("rare"))
    ends = written(rest.groupBy("ending").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("rare"), F.col("n")).otherwise(0)).alias("rare"),
        F.sum(F.col("rare").cast("bigint")).alias("words")), "endings")
    heads = {bytes(r["ending"]): 2 + n_core + k for k, r in enumerate(ends.orderBy(F.desc("n"), "ending").limit(endings).collect())}
    listed = ends.where(F.col("rare") >= least).orderBy(F.desc("rare"), "ending").collect()  # as many as there are ends of three bytes at most
    ending = {bytes(r["ending"]): 2 + k for k, r in enumerate(listed)}
    first = 2 + len(listed)  # units: the end, the rest, endings, hot words, others
    dense = first + many
    of_ending, kinds = np.zeros(dense), np.zeros(dense)
    for k, r in enumerate(listed):
        of_ending[2 + k], kinds[2 + k] = r["rare"], r["words"]
    every = ends.agg(F.sum("rare").alias("n"), F.sum("words").alias("words")).first()
    of_ending[REST], kinds[REST] = (every["n"] or 0) - of_ending.sum(), (every["words"] or 0) - kinds.sum()
    unit = np.array([first + k if k < many else ending.get(w[-ENDING:], REST) for k, w in enumerate(hot_words)] or [REST], dtype=np.int64)
    core_of = np.array([END, REST, *[heads.get(e, REST) for e in ending],
                        *[2 + k if k < n_core else heads.get(w[-ENDING:], REST) for k, w in enumerate(hot_words[:many])]], dtype=np.int64)

    cold = bits = None
    if many == len(hot_words) == hot:
        low, word = int(hot_n[-1]), hot_words[-1]
        others = counts.where((F.col("n") >= least) & ((F.col("n") < low) | ((F.col("n") == low) & (F.col("word") > F.lit(word)))))
        cold = written(others.select("word", "n", (F.monotonically_increasing_id() + dense).alias("unit")), "cold-words")
        bits = _bit_map(cold)
    model = {"key": uuid.uuid4().hex, "hot": hot_words, "ending": ending, "unit": unit, "bits": bits, "dense": dense}
    found = written(unit_bigrams(texts, spark.sparkContext.broadcast(model)), "unit-bigrams")
    far = None
    if cold is not None:
        asked = found.where("pair IS NOT NULL").select(
            F.shiftright("pair", PAIR).alias("a"), F.col("pair").bitwiseAND((1 << PAIR) - 1).alias("b"), "aw", "bw", "n")
        asked = _looked_up(_looked_up(asked, cold, "a", "aw", "unit"), cold, "b", "bw", "unit")
        far = written(asked.select("a", "b", "n"), "far-bigrams")
    bigrams = Bigrams(found.where("cells IS NOT NULL").select("cells"), far, dense)

    # the core's classes, then those of all units
    def by_unit(own: np.ndarray, of_cold) -> DataFrame:
        table = spark.createDataFrame(pa.table({"unit": np.arange(dense), "cls": own.astype(np.int64)}))
        return table if cold is None else table.union(cold.select("unit", of_cold.cast("bigint").alias("cls")))

    head = F.lit(REST)
    if cold is not None and heads:
        head = F.coalesce(F.element_at(F.create_map(*[x for e, k in heads.items() for x in (F.lit(e.hex().upper()), F.lit(k))]), F.hex(F.expr(ending_of))), F.lit(REST))
    units = 2 + n_core + len(heads)
    cores = by_unit(core_of, head)
    n = bigrams.code_pairs(cores, spark.sparkContext.broadcast(core_of), units)
    cls_core = exchange(n, classes, sweeps)
    size = int(cls_core.max()) + 1
    member = np.eye(size)[cls_core]
    start = by_unit(cls_core[core_of], F.element_at(F.array(*[F.lit(int(c)) for c in cls_core]), head + 1))
    table, pair = spread(bigrams, written(start, "classes"), member.T @ n @ member, rounds if dense > 2 else 0)
    cls = cls_core[core_of]
    own = table.where(F.col("unit") < dense).toArrow()
    cls[own["unit"].to_numpy()] = own["cls"].to_numpy()

    freq = pair.sum(axis=0)
    share = (freq + 0.5) / (freq.sum() + 0.5 * size)
    n_unit = np.concatenate(([n_docs], of_ending[1:first], hot_n[:many]))
    n_class, in_class = np.bincount(cls, weights=n_unit, minlength=size), np.bincount(cls, minlength=size).astype(np.float64)
    if cold is not None:
        cold = written(cold.join(table, "unit"), "cold-words")
        for r in cold.groupBy("cls").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
            n_class[r["cls"]] += r["n"]
            in_class[r["cls"]] += r["words"]
        below = F.element_at(F.array(*[F.lit(float(x)) for x in n_class + 0.5 * in_class]), (F.col("cls") + 1).cast("int"))
        counts = written(counts.join(cold.select("word", F.log10((F.col("n") + 0.5) / below).alias("emit")), "word", "left"), "word-counts")
    else:
        counts = counts.withColumn("emit", F.lit(None).cast("double"))
    is_ending = (np.arange(dense) > END) & (np.arange(dense) < first)
    model |= {
        "units": dense, "classes": cls, "n_tokens": int(total["n"] or 0) + n_docs, "n_words": int(total["v"]) + (n_docs > 0),
        "n_end": n_docs, "hot_log": np.log10((hot_n if len(hot_n) else np.zeros(1)) + 1), "cold": cold,
        "move": np.log10((pair + SMOOTH * share) / (pair.sum(axis=1, keepdims=True) + SMOOTH)),
        "emit": np.log10((n_unit + 0.5) / (n_class + 0.5 * in_class)[cls]) - np.where(is_ending, np.log10(of_ending + kinds + 1), 0.0),
        "is_ending": is_ending,
    }
    return model, counts


def score(docs: DataFrame, model: dict, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_log, score): tokens, known tokens, sum of log10(count + 1), log10 probability.

    The tasks add up all that the travelling model knows.  A word outside of it is one row (word, text, times in the text),
    joined with its count; transitions to or from a word whose class does not travel are rows joined with its class; the sums
    meet by text.
    """
    sc, cold = docs.sparkSession.sparkContext, model["cold"]
    shared = sc.broadcast({k: v for k, v in model.items() if k != "cold"})

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in sliced(batches):
            words = _flat(batch, 2)
            number, unit, ask = _numbers(m, words)
            end = np.flatnonzero(unit == END)  # a text's tokens follow an end, up to its own
            first, size = end[:-1] + 1, np.diff(end)
            text = np.repeat(np.arange(len(size)), size)  # of each token from the second on
            hot, cls = number >= 0, m["classes"][unit]
            log = m["hot_log"][np.maximum(number, 0)] * hot
            some = ask[:-1] | ask[1:]
            prob = np.where(ask, 0.0, m["emit"][unit]) + log * m["is_ending"][unit]
            prob[1:] += np.where(some, 0.0, m["move"][cls[:-1], cls[1:]])

            # a text's first row has no word, its sums and its id; one row follows for each word outside of the model
            spot = np.flatnonzero(~hot & (unit != END))
            rare, edge = [words[k] for k in spot.tolist()], np.searchsorted(spot, end).tolist()
            maybe = {words[k]: float(m["emit"][unit[k]]) for k in np.flatnonzero(ask).tolist()}  # its emission as a word that has no class
            keys, word, times, at = batch.column(0).to_numpy(), [], [], []
            for key, x, y in zip(keys.tolist(), edge[:-1], edge[1:], strict=True):
                seldom = Counter(rare[x:y])
                at.append(len(word))
                word.append(b" %d" % key)  # no word: words hold no space
                word += seldom
                times.append(0)
                times += seldom.values()
            many = np.diff([*at, len(word)])
            spare = [maybe.get(w, 0.0) for w in word] if maybe else np.zeros(len(word))
            own = np.full(len(word), -1)
            own[at] = np.arange(len(at))
            own = pa.array(own, mask=own < 0)
            sums = [batch.column(1), pa.array(size), pa.array(np.add.reduceat(hot.astype(np.int64), first) + int(m["n_end"] > 0)),
                    pa.array(np.add.reduceat(log, first) + np.log10(m["n_end"] + 1)), pa.array(np.add.reduceat(prob, first))]
            arrays = [pa.array(np.repeat(keys, many)), pa.array(word, type=pa.binary()), pa.array(times, type=pa.int64()), pa.array(spare, type=pa.float64()),
                      *[c.take(own) for c in sums], *[pa.nulls(len(word), kind) for kind in LINK]]
            link = np.flatnonzero(some)
            links = [cls[link], cls[link + 1], _named(words, ask, link), _named(words, ask, link + 1)]
            more = [pa.array(keys[text[link]]), *[pa.nulls(len(link), c.type) for c in arrays[1:9]],
                    *[pa.array(c, type=kind) for c, kind in zip(links, LINK, strict=True)]]
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(arrays, more, strict=True)], names=[
                "row", "word", "times", "spare", "id", "n_tokens", "n_known", "base", "prob", "x", "y", "aw", "bw"])

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = numbered.schema["id"].dataType.simpleString()
    rows = numbered.mapInArrow(
        parts, f"row bigint, word binary, times bigint, spare double, id {kind}, n_tokens bigint, n_known bigint, base double, prob double, "
               "x bigint, y bigint, aw binary, bw binary")
    if cold is not None:  # read twice, and the rows' numbers must be the same
        rows = written(rows, "scored-parts")
    log = F.log10(F.coalesce("n", F.lit(0)) + 1) * F.col("times")
    known = F.coalesce("n_known", F.lit(0)) + F.when(F.col("n") > 0, F.col("times")).otherwise(0)
    own = F.when(F.col("emit").isNotNull(), F.col("emit") * F.col("times")).otherwise(log + F.col("spare") * F.col("times"))
    found = rows.where("word IS NOT NULL").join(counts, "word", "left").select(
        "row", "id", "n_tokens", known.alias("n_known"), (F.coalesce("base", F.lit(0.0)) + log).alias("base_log"),
        (F.coalesce("prob", F.lit(0.0)) + own).alias("score"))
    if cold is not None:
        asked = rows.where("word IS NULL").select("row", "x", "y", "aw", "bw")
        asked = _looked_up(_looked_up(asked, cold, "x", "aw", "cls"), cold, "y", "bw", "cls")
        size = len(model["move"])
        move = F.element_at(F.array(*[F.lit(float(x)) for x in model["move"].ravel()]), (F.col("x") * size + F.col("y") + 1).cast("int"))
        none = [F.lit(None).cast(kind).alias("id"), *[F.lit(None).cast("bigint").alias(c) for c in ("n_tokens", "n_known")], F.lit(0.0).alias("base_log")]
        found = found.union(asked.select("row", *none, move.alias("score")))
    return found.groupBy("row").agg(
        F.max("id").alias("id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_log", "score")]).drop("row")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    docs = docs.select("doc_id", "text")
    texts = docs.where(crc_fold("doc_id", 7) != 2).select(F.col("text").cast("string").alias("text"))
    model, counts = train(texts)
    found = score(docs, model, counts).withColumnRenamed("id", "doc_id")
    base = F.col("base_log") - F.col("n_tokens") * float(np.log10(model["n_tokens"] + model["n_words"] + 1))
    return found.select("doc_id", (crc_fold("doc_id", 7) == 2).alias("held_out"), "n_tokens", "n_known",
                        F.lit(model["n_tokens"]).cast("bigint").alias("train_tokens"), base.alias("base_score"), "score")
