"""Cross-tokenizer alignment: inverted bitmaps of linked token pairs.

Two tokenizers cut the same bytes.  Two token occurrences are *linked* if their byte ranges overlap, and byte offsets
where both end cut a text into *groups*.  The score of a link is the number of documents in which its id pair is linked.

One pass over the texts encodes them and writes an index: a row for each document, and for each pair of a *chunk* of
documents one posting, that is a compressed bitmap of the chunk's documents (places as 16-bit numbers, or a bit set where that is
shorter) and the multiplicities as bit planes over those documents.  Document counts are popcounts of the bitmaps, link counts
are popcounts of the planes, and Spark adds both up over the chunks.  The counts go back to the chunks that hold the pair, where the postings
return each document's scores.  Only numbers travel by pair, bitmaps by chunk: a pair that all documents have is one
short row for each chunk, and no group is larger than ``CHUNK_DOCS`` documents or about ``CHUNK_ENTRIES`` postings' entries.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens:
zeros and the empty group string.  Every row is a document of its own, repeated ids and null ids too.  Other
columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from adlake.llm.bpe import byte_alphabet
from adlake.llm.common import sliced, written

#: Documents in a chunk (their places are 16-bit numbers), and entries (document, pair) that end one early.
CHUNK_DOCS = 8192
CHUNK_ENTRIES = 1 << 20
#: Documents that are aligned together.
SLICE = 64
#: Fixed value: how the byte-level vocabulary splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DOCUMENT = "doc int, n_a long, n_b long, n_groups long, n_links_doc long, groups_sha256 string"
POSTING = "chunk long, a int, b int, n_docs long, n_links long, dense boolean, docs binary, planes binary"


def load_tokenizers(byte_level: str, pieces: str) -> dict:
    """What the workers need of both vocabulary files; its size is bounded by them."""
    with open(byte_level, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"] for t in spec.get("added_tokens", [])}
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    made = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
    if made != sorted(made):
        raise ValueError("token ids must follow the order of merges")
    with open(pieces, "rb") as f:
        return {"ranks": ranks, "pieces": f.read()}


def share_tokenizers(spark: SparkSession, byte_level: str | None = None, pieces: str | None = None) -> Broadcast:
    import public_tokenizers

    return spark.sparkContext.broadcast(load_tokenizers(
        byte_level or public_tokenizers.path("byte_bpe_50k.json"), pieces or public_tokenizers.path("piece_bpe_32k.model")))


class Coders:
    """Both tokenizers in a worker, with the bytes of every token."""

    def __init__(self, tables: dict):
        import sentencepiece
        import tiktoken

        # ids follow the merges, so the least rank is the next merge
        self.first = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=tables["ranks"], special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_proto=tables["pieces"])
        self.bytes_1 = [b""] * (max(tables["ranks"].values()) + 1)
        for raw, i in tables["ranks"].items():
            self.bytes_1[i] = raw
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.bytes_2 = [bytes([int(p[3:5], 16)]) if self.second.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(names)]
        self.size_1, self.size_2 = (np.array([len(b) for b in x], dtype=np.int64) for x in (self.bytes_1, self.bytes_2))
        top = max(len(self.bytes_1), len(self.bytes_2))
        self.digits = np.array([str(i).encode() for i in range(top)])
        self.width = self.digits.dtype.itemsize
        self.digits = self.digits.view(np.uint8).reshape(top, self.width)

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both tokenizers; none if the text is empty or either does not give its bytes back."""
        none = np.zeros(0, dtype=np.int64)
        if not text:
            return none, none
        first, second = self.first.encode_ordinary(" " + text), self.second.encode(text, num_threads=1)
        raw = (" " + text).encode("utf-8", "surrogatepass")
        if b"".join(map(self.bytes_1.__getitem__, first)) != raw or b"".join(map(self.bytes_2.__getitem__, second)) != raw:
            return none, none
        return np.array(first, dtype=np.int64), np.array(second, dtype=np.int64)


class Aligned:
    """The alignment of a few texts laid end to end; all of it in arrays."""

    def __init__(self, coders: Coders, texts: list[str | None]):
        self.coders = coders
        both = [coders.encode(t) for t in texts]
        self.n_a, self.n_b = (np.array([len(x[k]) for x in both], dtype=np.int64) for k in (0, 1))
        self.a, self.b = (np.concatenate([x[k] for x in both]) if both else np.zeros(0, dtype=np.int64) for k in (0, 1))
        self.end_a, self.end_b = np.cumsum(coders.size_1[self.a]), np.cumsum(coders.size_2[self.b])
        # between two neighbouring ends lies one token of either kind, and every linked pair has one such place
        ends = np.sort(np.concatenate((self.end_a, self.end_b)), kind="stable")
        ends = ends[np.concatenate(([True], ends[1:] != ends[:-1]))] if len(ends) else ends
        self.link_a, self.link_b = np.searchsorted(self.end_a, ends), np.searchsorted(self.end_b, ends)
        shared = (self.end_a[self.link_a] == ends) & (self.end_b[self.link_b] == ends)
        self.group_end = ends[shared]
        self.doc_of_a = np.repeat(np.arange(len(texts)), self.n_a)
        self.link_doc = self.doc_of_a[self.link_a]
        self.n_links = np.bincount(self.link_doc, minlength=len(texts))
        self.n_groups = np.bincount(self.link_doc[shared], minlength=len(texts))

    def group_texts(self) -> list[bytes]:
        """Each text's groups as ``a1,a2|b1;a3|b2,b3``, in decimal ids."""
        width, n = self.coders.width, len(self.a) + len(self.b)
        own_a, own_b = np.searchsorted(self.group_end, self.end_a), np.searchsorted(self.group_end, self.end_b)
        before = np.concatenate(([0], np.searchsorted(self.end_b, self.group_end, "right")))
        at_a = np.arange(len(self.a)) + before[own_a]
        at_b = np.arange(len(self.b)) + np.searchsorted(self.end_a, self.group_end, "right")[own_b]
        out = np.zeros((n, width + 1), dtype=np.uint8)
        for at, ids, ends, own, last in ((at_a, self.a, self.end_a, own_a, b"|"), (at_b, self.b, self.end_b, own_b, b";")):
            out[at, :width] = self.coders.digits[ids]
            out[at, width] = np.where(ends == self.group_end[own], last[0], ord(","))
        size = np.concatenate(([0], np.cumsum((out != 0).sum(axis=1))))[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))]
        whole = out[out != 0].tobytes()
        return [whole[x : max(x, y - 1)] for x, y in zip(size[:-1].tolist(), size[1:].tolist(), strict=True)]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (pair, document) as pair codes (a in the upper half), documents and how often they are linked."""
        code = self.a[self.link_a] << 32 | self.b[self.link_b]
        order = np.lexsort((code, self.link_doc))
        code, doc = code[order], self.link_doc[order]
        new = np.flatnonzero(np.concatenate(([True], (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])))) if len(code) else np.zeros(0, int)
        return code[new], doc[new], np.diff(np.append(new, len(code)))


def _binary(size: np.ndarray, raw: bytes) -> pa.Array:
    """Binary values of such sizes that stand one after the other in ``raw``."""
    offset = np.concatenate(([0], np.cumsum(size))).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offset.tobytes()), pa.py_buffer(raw)])


def postings(chunk: int, code: np.ndarray, doc: np.ndarray, times: np.ndarray, n_docs: int) -> pa.RecordBatch:
    """One posting for each pair of entries; a bit set takes the place of the document numbers where it is shorter."""
    order = np.lexsort((doc, code))
    code, doc, times = code[order], doc[order], times[order]
    begin = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    n = np.diff(np.append(begin, len(code)))
    whole = -(-n_docs // 8)
    dense = 2 * n > whole
    # document bitmaps: each document's bit is OR-ed into its pair's place
    size = np.where(dense, whole, 2 * n)
    start = np.concatenate(([0], np.cumsum(size)))
    blob = np.zeros(start[-1], dtype=np.uint8)
    own = np.repeat(np.arange(len(n)), n)
    in_set = dense[own]
    np.bitwise_or.at(blob, (start[own] + (doc >> 3))[in_set], (1 << (doc & 7)).astype(np.uint8)[in_set])
    rank = np.arange(len(code)) - begin[own]
    at = (start[own] + 2 * rank)[~in_set]
    blob[at], blob[at + 1] = doc[~in_set] & 255, doc[~in_set] >> 8
    # multiplicity planes: plane k has bit k of each document's count, in the order of the documents
    row = -(-n // 8)
    planes = np.ceil(np.log2(np.maximum.reduceat(times, begin) + 1)).astype(np.int64)
    start_p = np.concatenate(([0], np.cumsum(planes * row)))
    bits = np.zeros(start_p[-1], dtype=np.uint8)
    links = np.zeros(len(n), dtype=np.int64)
    for k in range(int(planes.max())):
        has = (times >> k & 1).astype(bool)
        np.bitwise_or.at(bits, (start_p[own] + k * row[own] + (rank >> 3))[has], (1 << (rank & 7)).astype(np.uint8)[has])
        part = np.flatnonzero(planes > k)  # popcount of the plane, by the bytes of each pair
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))
        links[part] += (ones[(start_p[:-1] + (k + 1) * row)[part]] - ones[(start_p[:-1] + k * row)[part]]) << k
    ones = np.concatenate(([0], np.cumsum(np.bitwise_count(blob), dtype=np.int64)))
    n_set = np.where(dense, ones[start[1:]] - ones[start[:-1]], n)
    first = code[begin]
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(n), chunk)), pa.array((first >> 32).astype(np.int32)), pa.array((first & 0xFFFFFFFF).astype(np.int32)),
         pa.array(n_set), pa.array(links), pa.array(dense), _binary(size, blob.tobytes()), _binary(planes * row, bits.tobytes())],
        names=["chunk", "a", "b", "n_docs", "n_links", "dense", "docs", "planes"])


def read_postings(n_docs: np.ndarray, dense: np.ndarray, docs: list[bytes], planes: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posting, document, times) of every entry, in the order of the postings."""
    own = np.repeat(np.arange(len(n_docs)), n_docs)
    doc = [np.flatnonzero(np.unpackbits(np.frombuffer(d, np.uint8), bitorder="little")) if s else np.frombuffer(d, "<u2") for s, d in zip(dense, docs, strict=True)]
    row = -(-n_docs // 8)
    blob, size = np.frombuffer(b"".join(planes), np.uint8), np.array([len(p) for p in planes], dtype=np.int64)
    start, k_of = np.concatenate(([0], np.cumsum(size)[:-1])), size // row
    rank = np.arange(len(own)) - np.repeat(np.cumsum(n_docs) - n_docs, n_docs)
    times = np.zeros(len(own), dtype=np.int64)
    for k in range(int(k_of.max())):
        has = (k_of > k)[own]
        at = (start[own] + k * row[own] + (rank >> 3))[has]
        times[has] |= (blob[at] >> (rank[has] & 7) & 1).astype(np.int64) << k
    return own, np.concatenate(doc).astype(np.int64), times


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizers: Broadcast | None = None) -> DataFrame:
    """Encode every text once; rows of documents (``doc`` is set) and postings (``a`` is set) by chunk, written to the shared folder."""
    shared = tokenizers or share_tokenizers(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = StructType([rows.schema["doc_id"], *StructType.fromDDL(f"{DOCUMENT}, {POSTING}").fields])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        coders, target = Coders(shared.value), to_arrow_schema(schema)

        def filled(batch: pa.RecordBatch) -> pa.RecordBatch:
            have = dict(zip(batch.schema.names, batch.columns, strict=True))
            return pa.RecordBatch.from_arrays([have[f.name].cast(f.type) if f.name in have else pa.nulls(len(batch), f.type) for f in target], schema=target)

        chunk, held, n_docs, n_held = TaskContext.get().partitionId() << 32, [], 0, 0
        for batch in sliced(batches, SLICE):
            part = Aligned(coders, batch.column("text").to_pylist())
            code, doc, times = part.entries()
            if n_docs and (n_docs + len(batch) > CHUNK_DOCS or n_held + len(code) > CHUNK_ENTRIES):
                if n_held:
                    yield from sliced([filled(postings(chunk, *map(np.concatenate, zip(*held, strict=True)), n_docs))], 4096)
                chunk, held, n_docs, n_held = chunk + 1, [], 0, 0
            digest = [hashlib.sha256(g).hexdigest() if g else "" for g in part.group_texts()]
            yield filled(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.arange(n_docs, n_docs + len(batch)), pa.int32()), pa.array(part.n_a), pa.array(part.n_b),
                 pa.array(part.n_groups), pa.array(part.n_links), pa.array(digest, pa.string()), pa.array(np.full(len(batch), chunk))],
                names=["doc_id", "doc", "n_a", "n_b", "n_groups", "n_links_doc", "groups_sha256", "chunk"]))
            held.append((code, doc + n_docs, times))
            n_docs, n_held = n_docs + len(batch), n_held + len(code)
        if n_held:
            yield from sliced([filled(postings(chunk, *map(np.concatenate, zip(*held, strict=True)), n_docs))], 4096)

    return written(rows.mapInArrow(make, schema), "pair-bitmaps")


def pair_counts(made: DataFrame) -> DataFrame:
    """(a, b, documents, links, best) of every pair: how many documents hold it linked, how often, and whether no pair of
    its ``a`` is in more documents."""
    pairs = made.where("a IS NOT NULL").groupBy("a", "b").agg(F.sum("n_docs").alias("documents"), F.sum("n_links").alias("links"))
    top = pairs.groupBy("a").agg(F.max("documents").alias("top"))
    return pairs.join(top, "a").select("a", "b", "documents", "links", (F.col("documents") == F.col("top")).alias("best"))


def scores(made: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of an index, with n_best and count_sum that the postings return."""
    # numbers only are joined by pair; a pair has one row for each chunk that holds it
    known = made.where("a IS NOT NULL").select("chunk", "a", "b").join(counts.select("a", "b", "documents", "best"), ["a", "b"])
    known = known.select(*[F.col(c).alias(f"known_{c}") for c in ("chunk", "a", "b", "documents", "best")])
    own = [f for f in made.schema.fields if f.name in ("doc_id", "n_a", "n_b", "n_groups", "n_links_doc", "groups_sha256")]
    out = StructType([*own, *StructType.fromDDL("n_best long, count_sum long").fields])

    def gather(rows: pa.Table, found: pa.Table) -> pa.Table:
        held = rows.filter(rows["doc"].is_valid())
        n_best, count_sum = (np.zeros(int(held["doc"].to_numpy().max(initial=-1)) + 1, dtype=np.int64) for _ in range(2))
        lists = rows.filter(rows["a"].is_valid())
        if len(lists):
            code, want = (t[f"{p}a"].to_numpy().astype(np.int64) << 32 | t[f"{p}b"].to_numpy() for t, p in ((lists, ""), (found, "known_")))
            order = np.argsort(want)
            at = order[np.searchsorted(want[order], code)]
            count, best = found["known_documents"].to_numpy()[at], found["known_best"].to_numpy()[at]
            own, doc, times = read_postings(lists["n_docs"].to_numpy(), lists["dense"].to_pylist(), lists["docs"].to_pylist(), lists["planes"].to_pylist())
            np.add.at(count_sum, doc, times * count[own])
            np.add.at(n_best, doc, times * best[own])
        place = held["doc"].to_numpy()
        columns = {c: held[c] for c in out.names if c in held.column_names}
        return pa.table({**columns, "n_best": pa.array(n_best[place]), "count_sum": pa.array(count_sum[place])}).select(out.names)

    return made.groupBy("chunk").cogroup(known.groupBy("known_chunk")).applyInArrow(gather, out)


def align(docs: DataFrame, text_col: str = "text", out: str = "alignment", tokenizers: Broadcast | None = None) -> DataFrame:
    """Add ``out``: struct (n_a, n_b, n_groups, n_links, groups: ``a1,a2|b1;a3|b2,b3``) of each whole text."""
    shared = tokenizers or share_tokenizers(docs.sparkSession)

    @F.arrow_udf("struct<n_a: bigint, n_b: bigint, n_groups: bigint, n_links: bigint, groups: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coders = Coders(shared.value)
        for texts in sliced(batches, SLICE):
            part = Aligned(coders, texts.to_pylist())
            yield pa.StructArray.from_arrays(
                [pa.array(x) for x in (part.n_a, part.n_b, part.n_groups, part.n_links)] + [pa.array([g.decode() for g in part.group_texts()], pa.string())],
                names=["n_a", "n_b", "n_groups", "n_links", "groups"])

    return docs.withColumn(out, both(F.col(f"`{text_col}`").cast("string")))


def report(docs: DataFrame) -> DataFrame:
    """n_a, n_b, n_groups, n_links, n_best, count_sum and the digest of the groups of every document."""
    made = index(docs.select("doc_id", "text"))
    return scores(made, pair_counts(made)).select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_links_doc").alias("n_links"), "n_best", "count_sum", "groups_sha256")
