"""Exact top-k by inner product: no-random-access aggregation over sorted lists.

Rows are held in blocks of ``BLOCK``.  For each dimension a block has a list of its rows sorted by that component; a query
reads it from the high end where its weight is positive and from the low end where it is negative.  All lists
are read in steps of equal depth and in their order only.  After each step a row's score has a lower bound (components not read yet are as bad as
the list's last) and an upper bound (they are as good as the list's frontier).  Rows whose upper bound is below the k-th best score known for
a query cannot qualify; the reading stops when each query has k rows or fewer left in the block, and ends with the
lists otherwise.  Final scores are resolved for the rows left, whose remaining entries are read off the lists.
The queries of one batch share the reading; their bounds are matrix products.

Each task keeps k rows for each query of the batch in hand (``BATCH`` queries, so memory is bounded), and the k best of all tasks
are ranked by a window.  Queries beyond one batch take further passes; a batch is the only thing that is broadcast.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do rows without id or with a
component whose integer does not fit a long.  A shorter vector counts as filled up with zeros.  All rows with a
query's id are its own; a query id listed several times has the ranks of its row with the greatest vector.  Equal rows with
different ids are ranked by id; a candidate id listed several times counts with each row.  A score beyond a long
stands at the long's limit.  An empty table has an empty result; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import written

K = 5
SCALE = 256
#: Rows in a block, queries in a batch (64 dimensions: 4 MB), queries whose bounds are held at once, and steps of reading.
BLOCK = 1024
BATCH = 8192
TILE = 512
STEPS = 8
LIMIT = (1 << 63) - 1
#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53


def scaled(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, x) of the rows that take part; x holds floor(scale * component), as whole numbers in double precision."""
    own = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    fits = f"forall(v, c -> coalesce(abs(c) < {float(1 << 62) / scale!r}D, false))"  # false for NaN
    return own.where("vec_id IS NOT NULL AND v IS NOT NULL").where(fits).select("vec_id", F.expr(f"transform(v, c -> floor({scale} * c))").alias("x"))


def matrix(x: pa.Array, width: int = 0) -> np.ndarray:
    """Lists of numbers as the rows of an integer matrix, filled up with zeros."""
    flat, offset = x.values.to_numpy(), x.offsets.to_numpy()
    size = np.diff(offset)
    out = np.zeros((len(x), max(width, int(size.max(initial=0)))), dtype=np.int64)
    own = np.repeat(np.arange(len(x)), size)
    out[own, np.arange(offset[0], offset[-1]) - np.repeat(offset[:-1], size)] = flat[offset[0] : offset[-1]]
    return out


class Lists:
    """The sorted lists of a block: for each dimension its rows by falling component."""

    def __init__(self, x: np.ndarray):
        self.n, self.dims = x.shape
        self.rows = np.argsort(-x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.rows, axis=0)
        # bounds of each (row, dimension), for readers from the high end and from the low end
        worst, best = np.broadcast_to(self.values[-1], x.shape), np.broadcast_to(self.values[0], x.shape)
        self.high = {"read": np.zeros(x.shape, bool), "lower": worst.copy(), "upper": best.copy()}
        self.low = {"read": np.zeros(x.shape, bool), "lower": best.copy(), "upper": worst.copy()}

    def read(self, begin: int, end: int) -> None:
        """Read places ``begin`` to ``end`` of every list from both ends, and move the frontier."""
        cols = np.arange(self.dims)
        for side, part in ((self.high, slice(begin, end)), (self.low, slice(self.n - end, self.n - begin))):
            rows, values = self.rows[part], self.values[part]
            for bound in ("lower", "upper"):
                side[bound][rows, cols] = values
            side["read"][rows, cols] = True
            frontier = values[-1] if side is self.high else values[0]
            side["upper"] = np.where(side["read"], side["upper"], frontier)


def _product(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """x times q, exactly, where the result fits a long."""
    if _most(x, q) < EXACT:
        return (x.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    return x @ q


def _most(x: np.ndarray, q: np.ndarray) -> int:
    """A bound of the inner products' magnitude."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0))) * max(int(q.max(initial=0)), -int(q.min(initial=0))) * max(1, x.shape[1])


def qualify(x: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int, steps: int = STEPS, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the rows of a block that may be among the ``k`` best of a query, with their final scores.

    ``floor`` has a score that k rows of earlier blocks reach, for each query; rows are kept on ties. ``own`` marks (row, query)
    pairs that do not count.
    """
    lists, plus, minus = Lists(x), np.maximum(q, 0).T, np.minimum(q, 0).T
    n, m = len(x), len(q)
    left = np.ones((n, m), dtype=bool) if own is None else ~own
    floor, depth = floor.copy(), 0
    huge = _most(x, q) > LIMIT // 4  # bounds would not fit a long: the lists are read to their ends
    for step in range(steps if huge else 1, steps + 1):
        end = -(-n * step // steps)
        if end > depth:
            lists.read(depth, end)
            depth = end
        open_q = np.flatnonzero(left.sum(axis=0) > k)
        if not len(open_q) or depth == n:
            break
        open_x = np.flatnonzero(left[:, open_q].any(axis=1))
        plus_q, minus_q, still = plus[:, open_q], minus[:, open_q], left[np.ix_(open_x, open_q)]
        lower = _product(lists.high["lower"][open_x], plus_q) + _product(lists.low["lower"][open_x], minus_q)
        lower[~still] = -LIMIT
        if len(open_x) >= k:
            floor[open_q] = np.maximum(floor[open_q], np.partition(lower, len(open_x) - k, axis=0)[len(open_x) - k])
        upper = _product(lists.high["upper"][open_x], plus_q) + _product(lists.low["upper"][open_x], minus_q)
        left[np.ix_(open_x, open_q)] = still & (upper >= floor[open_q])
    # resolve: the rest of the lists, read for the rows that are left
    row, query = np.nonzero(left)
    if depth < n:
        keep = np.zeros(n, dtype=bool)
        keep[row] = True
        tail = keep[lists.rows[depth:]]
        place, cols = np.nonzero(tail)
        lists.high["lower"][lists.rows[depth:][place, cols], cols] = lists.values[depth:][place, cols]
    whole = lists.high["lower"]
    score = np.zeros(len(row), dtype=np.int64)
    for begin in range(0, len(row), 1 << 16):
        part = slice(begin, begin + (1 << 16))
        a, b = whole[row[part]], q[query[part]]
        score[part] = np.clip((a.astype(object) * b.astype(object)).sum(axis=1), -LIMIT, LIMIT).astype(np.int64) if huge else np.einsum("ij,ij->i", a, b)
    return query, row, score


def best_of(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query by falling score, then rising id."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    begin = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1]))) if len(query) else np.zeros(0, int)
    rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
    return query[rank < k], ids[rank < k], score[rank < k]


class Search:
    """A task's running k best for the queries of a batch."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.floor = np.full(len(ids), -LIMIT, dtype=np.int64)
        self.held = (np.zeros(0, dtype=np.int64),) * 3

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        width = max(x.shape[1], self.q.shape[1])
        x, q = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (x, self.q))
        found = [self.held]
        for begin in range(0, len(q), TILE):
            part = slice(begin, begin + TILE)
            query, row, score = qualify(x, q[part], self.floor[part], self.k, own=ids[:, None] == self.ids[None, part])
            found.append((query + begin, ids[row], score))
        self.held = best_of(*map(np.concatenate, zip(*found, strict=True)), self.k)
        query, _, score = self.held
        full = np.flatnonzero(np.bincount(query, minlength=len(q)) == self.k)
        last = np.searchsorted(query, full, "right") - 1
        self.floor[full] = score[last]


def search(rows: DataFrame, queries: DataFrame, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
           batch: int = BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for every row of ``queries``."""
    spark = rows.sparkSession
    base = scaled(rows, id_col, vector_col, scale)
    asked = scaled(queries, id_col, vector_col, scale).groupBy("vec_id").agg(F.max("x").alias("x"))
    # files of at most ``batch`` queries each: what is collected and broadcast at a time is bounded
    asked = written(asked, "queries", max_rows_per_file=batch)
    files = [r[0] for r in asked.select(F.col("_metadata.file_path")).distinct().collect()]
    groups, parts = _packed(asked, files, batch), []
    for group in groups:
        got = spark.read.schema(asked.schema).parquet(*group).toArrow()
        ids, q = got["vec_id"].to_numpy().astype(np.int64), matrix(got["x"].combine_chunks())
        shared = spark.sparkContext.broadcast((ids, q))
        found = base.mapInArrow(_scan(shared, k), "query_id long, vec_id long, score long")
        parts.append(found if len(groups) == 1 else written(found, "best"))
        if len(groups) > 1:
            shared.destroy()
    if not parts:
        parts = [spark.createDataFrame([], "query_id long, vec_id long, score long")]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _packed(asked: DataFrame, files: list[str], batch: int) -> list[list[str]]:
    """The files in groups of at most ``batch`` queries."""
    count = {r[0]: r[1] for r in asked.groupBy(F.col("_metadata.file_path").alias("f")).count().collect()}
    groups, size = [], batch
    for f in sorted(files):
        if size + count[f] > batch:
            groups.append([])
            size = 0
        groups[-1].append(f)
        size += count[f]
    return groups


def _scan(shared, k: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q = shared.value
        found = Search(ids, q, k)
        for batch in batches:
            for begin in range(0, len(batch), BLOCK):
                part = batch.slice(begin, BLOCK)
                found.add(part.column("vec_id").to_numpy(), matrix(part.column("x")))
        query, vec, score = found.held
        yield pa.RecordBatch.from_arrays([pa.array(ids[query]), pa.array(vec), pa.array(score)], names=["query_id", "vec_id", "score"])

    return scan


def report(embeddings: DataFrame) -> DataFrame:
    """The 5 highest scores of every row whose id is divisible by 50, against all rows."""
    own = embeddings.select("vec_id", "embedding")
    return search(own, own.where("vec_id % 50 = 0"))


#: Brute force over all pairs of a query and a row, for small tables.
ORACLE_SQL = """
WITH c AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS c FROM embeddings WHERE vec_id IS NOT NULL),
x AS (
  SELECT vec_id, i, floor(256 * c)::BIGINT AS x FROM c
  WHERE vec_id NOT IN (SELECT vec_id FROM c WHERE c IS NULL OR NOT isfinite(c))),
s AS (
  SELECT q.vec_id AS query_id, o.vec_id AS vec_id, sum(q.x * o.x)::BIGINT AS score
  FROM x q JOIN x o ON q.i = o.i AND q.vec_id <> o.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5
"""
