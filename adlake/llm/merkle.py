"""Merkle fixity audit of web-archive records: two replicas are compared by their trees, top down.

A record stands at a place (its number or offset in the archive) and has the digest of its bytes.  Records form
leaves by ranges of ``LEAF`` places, and nodes of ``FANOUT`` children above, up to one root; a node's digest is that of
its children's places and digests in order.  The audit compares the roots and then only the children of nodes that
differ, level by level, down to the records.  Each level is a Spark table and each descent a join on the differing
nodes, so that equal parts of an archive are never looked at below the node that proves them equal.

Records at one place are added up before they are hashed (their number and the sums of four parts of their digests), so
that any number of copies at one place costs partial sums only.  At differing places with several records the audit
descends once more, to the digests of the records and their numbers.

Defined results: a record without place stands at -1; null columns are hashed apart from empty ones; equal records at one
place count with their number; an empty replica differs in every record, two empty ones in none; other columns than
those named play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import written

LEAF = 64
FANOUT = 16


def record_digest(*columns: str) -> Column:
    """SHA-256 of a record's columns, each with its length before it (null: no length)."""
    parts = []
    for c in columns:
        b = F.col(c).cast("string").cast("binary")
        parts.append(F.when(b.isNull(), F.lit("-:")).otherwise(F.concat(F.octet_length(b).cast("string"), F.lit(":"), F.col(c).cast("string"))))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def places(records: DataFrame, place_col: str, digest: Column) -> DataFrame:
    """(place, digest, n): one row for each place, records at one place in any order."""
    each = records.select(F.coalesce(F.col(place_col).cast("bigint"), F.lit(-1)).alias("place"), digest.alias("d"))
    part = lambda k: F.conv(F.substring("d", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")
    sums = each.groupBy("place").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("d"), *[F.sum(part(k)).alias(f"s{k}") for k in range(4)])
    many = F.sha2(F.concat_ws(",", F.col("n").cast("string"), *[F.col(f"s{k}").cast("string") for k in range(4)]).cast("binary"), 256)
    return sums.select("place", F.when(F.col("n") == 1, F.col("d")).otherwise(many).alias("digest"), "n")


def parents(nodes: DataFrame, width: int) -> DataFrame:
    """The level above: ``width`` neighbouring nodes each; at most that many digests meet in a group."""
    up = F.floor(F.col("place") / width).cast("bigint")
    child = F.concat_ws(":", F.col("place").cast("string"), "digest")
    return nodes.groupBy(up.alias("up")).agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("place", child.alias("c")))).alias("cs")).select(
        F.col("up").alias("place"), F.sha2(F.concat_ws(",", F.col("cs.c")).cast("binary"), 256).alias("digest"), "n")


def tree(level: DataFrame, levels: int, leaf: int = LEAF, fanout: int = FANOUT) -> list[DataFrame]:
    """All levels from the records to the root; levels above the records are written, small as they are."""
    out = [level]
    for k in range(levels):
        out.append(written(parents(out[-1], leaf if k == 0 else fanout), f"merkle-{k + 1}"))
    return out


def height(*levels: DataFrame, leaf: int = LEAF, fanout: int = FANOUT) -> int:
    """Levels above the records until all places, of all replicas, lie under one node."""
    ends = reduce(DataFrame.union, levels).agg(F.min("place").alias("a"), F.max("place").alias("b")).first()
    a, b, n = ends["a"] or 0, ends["b"] or 0, 0
    while a != b:
        a, b, n = a // (fanout if n else leaf), b // (fanout if n else leaf), n + 1
        if (a, b) == (-1, 0):  # places on both sides of zero never meet by division: the root is above both
            return n + 1
    return n


def differing(a: DataFrame, b: DataFrame) -> DataFrame:
    """Places at which digests differ or one side has none: (place, digest_a, digest_b, n_a, n_b)."""
    both = a.select("place", F.col("digest").alias("digest_a"), F.col("n").alias("n_a")).join(
        b.select("place", F.col("digest").alias("digest_b"), F.col("n").alias("n_b")), "place", "full")
    return both.where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def record_counts(records: DataFrame, place_col: str, digest: Column, where: DataFrame) -> DataFrame:
    """(place, digest, n): the different records at the places of ``where``, with their numbers."""
    # the digest is taken before the join, so that no column of the records is in its way
    own = records.select(F.coalesce(F.col(place_col).cast("bigint"), F.lit(-1)).alias("place"), digest.alias("digest"))
    return own.join(where.select("place"), "place", "left_semi").groupBy("place", "digest").agg(F.count(F.lit(1)).alias("n"))


def audit(a: DataFrame, b: DataFrame, place_col: str, columns: list[str], leaf: int = LEAF, fanout: int = FANOUT) -> DataFrame:
    """(place, status, digest_a, digest_b, n_a, n_b) of every place at which two replicas differ.

    status: ``changed``, ``missing`` (only in a) or ``extra`` (only in b).  A place that holds several records on a side
    has a row for each record digest whose numbers differ: ``changed`` then is another number of equal records.
    """
    low_a, low_b = (written(places(x, place_col, record_digest(*columns)), "merkle-0") for x in (a, b))
    levels = height(low_a, low_b, leaf=leaf, fanout=fanout)
    tree_a, tree_b = tree(low_a, levels, leaf, fanout), tree(low_b, levels, leaf, fanout)
    apart = differing(tree_a[-1], tree_b[-1])
    for k in range(levels - 1, -1, -1):
        width = leaf if k == 0 else fanout
        branch = apart.select(F.col("place").alias("up"))
        under = lambda t: t.withColumn("up", F.floor(F.col("place") / width).cast("bigint")).join(branch, "up", "left_semi")  # noqa: B023, E731
        apart = differing(under(tree_a[k]), under(tree_b[k]))
        if k:
            apart = written(apart, f"merkle-apart-{k}")
    apart = written(apart, "merkle-apart-0")
    several = F.greatest(F.coalesce("n_a", F.lit(0)), F.coalesce("n_b", F.lit(0))) > 1
    crowded = apart.where(several)
    if not crowded.isEmpty():
        records = [record_counts(x, place_col, record_digest(*columns), crowded).select("place", "digest", F.col("digest").alias(f"digest_{k}"), F.col("n").alias(f"n_{k}"))
                   for k, x in (("a", a), ("b", b))]
        differ = records[0].join(records[1], ["place", "digest"], "full").where(~F.col("n_a").eqNullSafe(F.col("n_b"))).drop("digest")
        apart = apart.where(~several).unionByName(differ)
    status = F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra").otherwise("changed")
    return apart.select("place", status.alias("status"), "digest_a", "digest_b", F.coalesce("n_a", F.lit(0)).cast("bigint").alias("n_a"),
                        F.coalesce("n_b", F.lit(0)).cast("bigint").alias("n_b"))


def damaged(pages: DataFrame) -> DataFrame:
    """A replica of the pages with faults that follow from their content: by the first digits of a page's own digest its
    text has one character too many (00), it is lost (01) or its address is empty (02)."""
    head = F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 2)
    return pages.withColumn("head", head).where(F.coalesce(F.col("head") != "01", F.lit(True))).withColumns({
        "html": F.when(F.col("head") == "00", F.concat("html", F.lit("\u0000"))).otherwise(F.col("html")),
        "url": F.when(F.col("head") == "02", F.lit("")).otherwise(F.col("url"))}).drop("head")


def report(pages: DataFrame) -> DataFrame:
    """The audit of all pages against a damaged replica: page_id, status and both digests of every differing record."""
    pages = pages.select("page_id", "url", "html")
    return audit(pages, damaged(pages), "page_id", ["url", "html"]).select(
        F.col("place").alias("page_id"), "status", "digest_a", "digest_b")


ORACLE_SQL = """
WITH a AS (SELECT page_id, sha256(strlen(url) || ':' || url || strlen(html) || ':' || html) AS digest_a, substr(md5(html), 1, 2) AS head, url, html FROM pages),
b AS (SELECT page_id, sha256(strlen(u) || ':' || u || strlen(h) || ':' || h) AS digest_b FROM (
    SELECT page_id, CASE WHEN head = '02' THEN '' ELSE url END AS u, CASE WHEN head = '00' THEN html || chr(0) ELSE html END AS h FROM a WHERE head <> '01'))
SELECT a.page_id, CASE WHEN digest_b IS NULL THEN 'missing' ELSE 'changed' END AS status, digest_a, digest_b
FROM a LEFT JOIN b USING (page_id) WHERE digest_a IS DISTINCT FROM digest_b"""
