"""SimHash near-duplicate groups by multi-index hashing.

A fingerprint has 64 bits; two that differ in at most ``distance`` = 3 bits differ in at most one bit
of one of their two 32-bit segments.  So each *distinct* fingerprint asks, for both segments, the table
of segment values for its own value and all values one bit away, and what the table returns is verified
over all 64 bits.  Groups are the connected components of the verified links; equal fingerprints are one
node from the start, so that a group of copies of any size costs one node.

Defined results: a text without words (null and empty too) has fingerprint zero and is linked like any
other; a text of fewer words than a shingle is one shingle; repeated rows are copies; a row without id takes
part, and ``component_id`` is the smallest non-null id of its group (null if there is none); other columns
play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import fresh, sliced, written
from adlake.llm.components import connected_components

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Shingles whose bits are counted at once (bounds the memory a long text takes).
STEP = 1 << 15


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one UTF-8 text, unsigned."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    else:
        digest = xxhash.xxh64_intdigest
        hashes = [digest(s, seed) for s in map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))]
    ones = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), STEP):
        h = np.array(hashes[k : k + STEP], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    """SimHash of a text column, as a signed 64-bit integer."""
    @F.arrow_udf("bigint")
    def signed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            found = np.array([fingerprint_of(t.as_py(), shingle, seed) for t in texts.cast(pa.binary())], dtype=np.uint64)
            yield pa.array(found.view(np.int64))

    return signed(text.cast("string"))


def links(fingerprints: DataFrame, column: str = "fp", distance: int = DISTANCE) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``distance`` (1 to 3) bits apart."""
    if not 1 <= distance <= 3:
        raise ValueError("two segments with balls of one bit find distances 1 to 3")
    own = fingerprints.select(F.col(column).alias("fp")).where("fp IS NOT NULL").distinct()
    low = F.col("fp").bitwiseAND(F.lit((1 << 32) - 1))
    high = F.shiftrightunsigned("fp", 32)
    tagged = F.array(low, high.bitwiseOR(F.lit(1 << 32)))
    table = own.select(F.col("fp").alias("b"), F.explode(tagged).alias("key"))
    ball = F.array(F.lit(0).cast("bigint"), *[F.lit(1 << k).cast("bigint") for k in range(32)])
    probe = own.select(F.col("fp").alias("a"), F.explode(tagged).alias("seg")).select(
        "a", "seg", F.explode(ball).alias("mask")).select("a", F.col("seg").bitwiseXOR(F.col("mask")).alias("key"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # Spark's estimates leave out what explode adds, so that it would broadcast the 66 keys of every fingerprint: both sides are shuffled
    return probe.hint("merge").join(table, "key").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    distance: int = DISTANCE, carry: list[Column] | None = None) -> DataFrame:
    """(id, fp, root, component, *carry) of every row: its fingerprint, its group and the group's smallest id.

    Fingerprints are computed once and written to the shared folder; links, components and the
    way back to the rows are joins on distinct fingerprints.  Rows are on the left of an outer join (every fingerprint
    has its group), which Spark never broadcasts: files of copies are far smaller than the rows they hold.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), shingle).alias("fp"),
                               *(carry or [])), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-nodes")
    found = connected_components(links(nodes, "fp", distance))
    member = nodes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = member.groupBy("root").agg(F.min("least").alias("component"))
    return rows.join(member.join(smallest, "root").select("fp", "root", "component"), "fp", "left")


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    found = near_duplicates(docs.select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each near-duplicate group, columns as given.

    The smallest id stays (rows without id only where a group has no other); among rows of the same id the
    smallest row digest decides, and of wholly equal rows one stays.
    """
    row, mark = fresh(docs, "row_digest"), fresh(docs, "times")
    digest = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    found = near_duplicates(docs, id_col, text_col, carry=[digest.alias("digest")])
    least = found.groupBy("root", "id", "digest").agg(F.count(F.lit(1)).alias("n")).groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("null_id"), "id", "digest", "n")).alias("m"))
    stay = least.select(F.col("m.id").alias("stay_id"), F.col("m.digest").alias("stay_digest"), F.col("m.n").alias("stay_n"))
    # by the size of its files Spark would broadcast a table of few or repeated texts: it is shuffled at any size
    kept = docs.withColumn(row, digest).hint("merge").join(
        stay, F.col(f"`{id_col}`").eqNullSafe(F.col("stay_id")) & (F.col(row) == F.col("stay_digest")))
    kept = kept.select(*[docs[c] for c in docs.columns], F.col(row), F.col("stay_n").alias(mark))
    once = kept.where(F.col(mark) == 1)
    more = kept.where(F.col(mark) > 1).dropDuplicates([id_col, row])
    return once.unionByName(more).select(*[f"`{c}`" for c in docs.columns])
