"""Quality rules: shape counts of a text, and a hashed n-gram log-likelihood ratio of trusted to raw text.

Only Spark's own functions run here.  Words and word pairs are hashed into ``BUCKETS`` buckets, as many at any size of the input; two
multinomials, over the trusted documents and over all documents, are counted with one partial aggregation per task.  A document's ratio is
the mean over its words and pairs of log(p_trusted / p_raw), with one added to each count.  One in ``FOLDS`` of the trusted documents
(by a hash of the id) is held out of the trusted counts, so that its ratios are those of good documents that are
not listed; a document is kept from a number of standard deviations below their mean on.  The ratios are broadcast, 8 bytes a bucket;
beyond ``BROADCAST_BUCKETS`` (a parameter's choice) the n-grams of each document are joined with them by a shuffle.  Repeated
three-word windows are found by a text's window hashes (64 bits).

Defined results: null and empty texts have no words and fail the base rule; without any trusted document the
ratio is 0 for all and none is below the threshold; a trusted id that is listed twice counts once, repeated documents count each; rows without id
are never trusted; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import crc_fold, put_back, set_aside, written

#: Buckets that words and word pairs are hashed to, at any size of the input.
BUCKETS = 1 << 18
#: Buckets whose ratios are broadcast (128 MB), and buckets in one broadcast row.
BROADCAST_BUCKETS = 1 << 24
CHUNK = 4096
#: Parts of the trusted documents, of which one gives the threshold; a document is kept down to so many standard deviations of
#: their ratios below the mean, and the least deviation that counts.
FOLDS = 5
SPREADS = 4.0
LEAST_SPREAD = 0.05
MIN_WORDS = 50
#: Trusted ids that are broadcast (8 bytes each before hashing); beyond, the join shuffles.
BROADCAST_IDS = 1_000_000

#: Places of a text's windows that occur in it twice or more, by rising place.  A window is one number, the upper bits of
#: its hash before its place, so that sorting brings equal windows together; what agrees in those bits is compared whole.
_LOW = "(shiftleft(1L, cast(ceil(log2(size(words))) AS int)) - 1)"
_HASH = "xxhash64(words[{0}], words[{0} + 1], words[{0} + 2])"


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns, and the text's ``words`` (an empty array for null)."""
    text = rf"btrim(coalesce(cast(`{text_col}` AS string), ''), ' \t\n\u000b\u000c\r')"
    return docs.withColumn("trimmed", F.expr(text)).withColumn(
        "words", F.expr(r"CASE WHEN trimmed = '' THEN cast(array() AS array<string>) ELSE split(trimmed, '[\\x20\\x09-\\x0D]+') END")).drop("trimmed")


#: Columns that the counts make on their way; columns of the caller with these names are set aside.
STEPS = ("trimmed", "lines", "low", "hashes", "packed", "near", "whole", "places")


def shape(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Add ``words``, n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    docs, aside = set_aside(docs, *STEPS)
    text_col = aside.get(text_col, text_col)
    text = f"coalesce(cast(`{text_col}` AS string), '')"
    lines = rf"filter(split({text}, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"
    hashes = f"CASE WHEN size(words) < 4 THEN cast(array() AS array<bigint>) ELSE transform(sequence(0, size(words) - 3), i -> {_HASH.format('i')}) END"
    packed = """CASE WHEN size(array_distinct(hashes)) = size(hashes) THEN cast(array() AS array<bigint>)
        ELSE sort_array(transform(hashes, (x, i) -> (x & ~low) | i)) END"""
    near = """transform(filter(packed, (x, k) -> (k > 0 AND ((x ^ packed[greatest(k - 1, 0)]) & ~low) = 0)
        OR (k < size(packed) - 1 AND ((x ^ packed[least(k + 1, size(packed) - 1)]) & ~low) = 0)), x -> cast(x & low AS int))"""
    whole = "array_sort(transform(near, i -> struct(hashes[i] AS h, i AS at)))"
    places = """array_sort(transform(filter(transform(whole, (w, k) -> struct(w.at AS at,
        (k > 0 AND whole[greatest(k - 1, 0)].h = w.h) OR (k < size(whole) - 1 AND whole[least(k + 1, size(whole) - 1)].h = w.h) AS again)),
        w -> w.again), w -> w.at))"""
    # every repeated window covers three words; neighbours share theirs
    covered = "aggregate(places, struct(-3 AS last, 0L AS n), (a, p) -> struct(p AS last, a.n + least(3, p - a.last) AS n), a -> a.n)"
    counted = with_words(docs, text_col).withColumns({
        "n_words": F.expr("cast(size(words) AS bigint)"),
        "word_chars": F.expr("cast(char_length(array_join(words, '')) AS bigint)"),
        "n_symbols": F.expr(f"cast(regexp_count({text}, '[#*$%&|<>]') AS bigint)"),
        "lines": F.expr(lines),
        "low": F.expr(f"CASE WHEN size(words) > 0 THEN {_LOW} ELSE 0L END"),
    })
    for name, expr in (("hashes", hashes), ("packed", packed), ("near", near), ("whole", whole), ("places", places)):
        counted = counted.withColumn(name, F.expr(expr))
    return put_back(counted.withColumns({
        "n_dup_lines": F.expr("cast(size(lines) - size(array_distinct(lines)) AS bigint)"),
        "n_repeat_words": F.expr(covered),
    }).drop(*STEPS), aside)


def grams(rows: DataFrame, buckets: int) -> DataFrame:
    """One row for each word with the bucket of the word and of the pair it begins (null at the end); a text without
    words has one row of nulls."""
    pairs = "inline_outer(arrays_zip(words, slice(words, 2, greatest(size(words) - 1, 0))))"
    each = rows.select(*[c for c in rows.columns if c != "words"], F.expr(pairs).alias("w1", "w2"))
    return each.withColumns({
        "bucket_1": F.expr(f"CASE WHEN w1 IS NOT NULL THEN pmod(xxhash64(w1), {buckets}L) END"),
        "bucket_2": F.expr(f"CASE WHEN w2 IS NOT NULL THEN pmod(xxhash64(w1, w2), {buckets}L) END")}).drop("w1", "w2")


def bucket_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(bucket, n, trusted_n) of words and pairs of rows (words, trusted)."""
    each = grams(texts, buckets).select("trusted", F.expr("explode(array(bucket_1, bucket_2))").alias("bucket")).where("bucket IS NOT NULL")
    return each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("trusted"), 1)).alias("trusted_n"))


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """Log ratios of the buckets as rows (chunk, logs) of ``CHUNK`` neighbouring buckets, written to the shared folder;
    ``trusted`` has the ids of trusted documents."""
    rows = with_trusted(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), trusted, id_col)
    rows = rows.select("text", (F.col("trusted") & ~held_out()).alias("trusted"))
    counts = written(bucket_counts(with_words(rows).drop("text"), buckets), "bucket-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("trusted_n").alias("trusted_n")).first()
    n_raw, n_own = (total["n"] or 0) + buckets, (total["trusted_n"] or 0) + buckets
    log = F.log((F.col("trusted_n") + 1) / n_own) - F.log((F.col("n") + 1) / n_raw) if n_own > buckets else F.lit(0.0)
    place = [F.floor(F.col("bucket") / CHUNK).cast("bigint").alias("chunk"), (F.col("bucket") % CHUNK).cast("int").alias("at")]
    counted = counts.select(*place, log.alias("log"))
    # every bucket has its place in the chunk, empty ones too
    empty = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket")).select(*place, F.lit(None).cast("double").alias("log"))
    chunks = counted.unionByName(empty).groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("at", "log"))).alias("xs"))
    logs = "transform(filter(xs, (x, k) -> k = size(xs) - 1 OR xs[least(k + 1, size(xs) - 1)].at <> x.at), x -> coalesce(x.log, 0D))"
    return written(chunks.select("chunk", F.expr(logs).alias("logs")), "log-ratios")


def with_trusted(rows: DataFrame, trusted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows (id, ...) with ``trusted``: whether the id is listed; the list is broadcast up to a counted bound."""
    ids = trusted.select(F.col(id_col).alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    known = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    ids = ids.withColumn("trusted", F.lit(True))
    joined = rows.join(F.broadcast(ids) if known else ids, F.col("id") == F.col("trusted_id"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce("trusted", F.lit(False)).alias("trusted"))


def ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
           buckets: int = BUCKETS, broadcast_buckets: int = BROADCAST_BUCKETS) -> DataFrame:
    """(id, the shape counts, ratio, base_failed) of every row.

    Words and pairs are rows with their buckets' log ratios for as long as it takes to add them up in the task that made
    them; what is shuffled is one row for each document.  Over ``broadcast_buckets``, one row for each bucket of
    each document is shuffled to the bucket's ratio.
    """
    chunks = log_ratios(docs, trusted, id_col, text_col, buckets)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # the counts travel in three numbers beside each word; each is below 2^31, as a text is
    packed = {"c1": "shiftleft(n_words, 32) | n_repeat_words", "c2": "shiftleft(n_symbols, 32) | n_dup_lines", "c3": "word_chars"}
    each = grams(shape(rows).select("row", "id", *[F.expr(e).alias(c) for c, e in packed.items()], "words"), buckets)
    if buckets <= broadcast_buckets:
        for k in (1, 2):
            own = F.broadcast(chunks.select(F.col("chunk").alias(f"chunk_{k}"), F.col("logs").alias(f"logs_{k}")))
            each = each.join(own, F.shiftright(f"bucket_{k}", CHUNK.bit_length() - 1) == F.col(f"chunk_{k}"), "left")
        log = F.expr(" + ".join(f"coalesce(logs_{k}[cast(bucket_{k} % {CHUNK} AS int)], 0D)" for k in (1, 2)))
    else:
        # a text's columns stand in the rows without a bucket (each has one), which are told apart to meet no other
        each = each.withColumn("bucket", F.explode(F.array("bucket_1", "bucket_2")))
        each = each.groupBy("row", F.coalesce("bucket", -1 - F.col("row")).alias("bucket")).agg(
            F.count(F.lit(1)).alias("times"), *[F.max(F.when(F.col("bucket").isNull(), F.col(c))).alias(c) for c in ("id", *packed)])
        own = chunks.select("chunk", F.posexplode("logs").alias("at", "one")).select((F.col("chunk") * CHUNK + F.col("at")).alias("bucket"), "one")
        each = each.join(own, "bucket", "left")
        log = F.coalesce(F.col("times") * F.col("one"), F.lit(0.0))
    sums = each.groupBy("row").agg(*[F.max(c).alias(c) for c in ("id", *packed)], F.sum(log).alias("log"))
    low = (1 << 32) - 1
    counts = sums.select("id", "log", F.expr("shiftright(c1, 32) AS n_words"), F.col("c3").alias("word_chars"), F.expr("shiftright(c2, 32) AS n_symbols"),
                         F.expr(f"c2 & {low}L AS n_dup_lines"), F.expr(f"c1 & {low}L AS n_repeat_words"))
    ratio = F.when(F.col("n_words") > 0, F.col("log") / (2 * F.col("n_words") - 1)).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counts.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", ratio.alias("ratio"), failed.alias("base_failed"))


def held_out() -> Column:
    """Whether the document ``id`` gives the threshold if it is trusted."""
    return crc_fold("id", FOLDS) == 2


def threshold_of(scored: DataFrame, trusted: DataFrame, id_col: str = "doc_id") -> float:
    """The mean ratio of the held-out trusted documents that pass the base rule (of all trusted ones if there is none), less ``SPREADS``
    standard deviations (of ``LEAST_SPREAD`` at least); rounded, so that the order of adding up plays no part.  Without trusted
    documents nothing is below it."""
    own = with_trusted(scored, trusted, id_col).where("trusted AND NOT base_failed").groupBy(held_out().alias("out")).agg(
        F.avg("ratio").alias("mean"), F.stddev_pop("ratio").alias("spread")).orderBy(F.desc("out")).first()
    if own is None:
        return float("-inf")
    return round(own["mean"] - SPREADS * max(own["spread"], LEAST_SPREAD), 6)


def judge(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float | None = None, min_words: int = MIN_WORDS, buckets: int = BUCKETS, broadcast_buckets: int = BROADCAST_BUCKETS) -> DataFrame:
    """(id, the shape counts, ratio, base_failed, kept) of every row; ``threshold`` is taken from the trusted documents if not given."""
    scored = ratios(docs, trusted, id_col, text_col, min_words, buckets, broadcast_buckets)
    if threshold is None:
        scored = written(scored, "quality-ratios")  # read twice: for the threshold and for the verdicts
        threshold = threshold_of(scored, trusted, id_col)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("ratio") >= threshold))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The counts and verdicts of every document; trusted are the documents labelled of good quality."""
    trusted = labels.where("quality = 1").select("doc_id")
    return judge(docs.select("doc_id", "text"), trusted).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio")
