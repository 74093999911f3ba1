"""BPE encoding by backtracking over longest token matches, and decoding by an offset table.

The encoder never replays merges.  An Aho-Corasick automaton over the vocabulary gives the longest
token that starts at each place of a word; tokens are laid down left to right, a token is accepted
only if the pair it forms with the token before is *compatible* (both would stand side by side in
the merge result), and otherwise the next shorter token is tried or the last token taken back.
Every place is given up at most once, so a word takes linear time.

Defined results: a null or empty text has no tokens (empty id string, empty decoded text); repeated
rows give repeated results; other columns are kept as they are, whatever their names, except that
the named output column replaces one of the same name.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.common import sliced

END = "</w>"
#: Symbols of a word's last byte are moved up by this, so that "last byte" is a symbol of its own.
LAST = 0x1000
#: Unicode White_Space, as the vocabulary's split pattern means it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the split pattern of the vocabulary file.
PRETOKEN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+"
#: Words of at most ``CACHE_LENGTH`` characters kept by an encoder with their ids, in each of two generations (an efficiency bound only).
CACHE_WORDS = 100_000
CACHE_LENGTH = 24
#: Token pairs kept by an encoder with their verdict (an efficiency bound only).
CACHE_PAIRS = 200_000


def byte_alphabet() -> list[str]:
    """Printable stand-ins of the 256 bytes: Latin-1 printables stand for themselves, the rest follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Tables of a word-end BPE vocabulary file, small (bounded by the vocabulary) and picklable."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, alphabet = spec["model"], byte_alphabet()
    names: dict[int, str] = {i: t for t, i in model["vocab"].items()}
    byte_of = {c: chr(b) for b, c in enumerate(alphabet)}

    def symbols(token: str) -> str:
        last = token.endswith(END) and token != END
        body = "".join(byte_of[c] for c in (token.removesuffix(END) if last else token))
        return body[:-1] + chr(ord(body[-1]) + LAST) if last else body

    vocab = model["vocab"]
    text = {i: symbols(t) for t, i in vocab.items()}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    rank: dict[int, int] = {}
    split: dict[int, tuple[int, int]] = {}
    pair: dict[tuple[int, int], int] = {}
    for k, (a, b) in enumerate(merges):
        new = vocab[a + b]
        pair.setdefault((vocab[a], vocab[b]), new)
        if new not in rank:
            rank[new], split[new] = k, (vocab[a], vocab[b])
    if any(r2 <= r1 for r1, r2 in zip([rank[i] for i in sorted(rank)], [rank[i] for i in sorted(rank)][1:], strict=False)):
        raise ValueError("token ids must follow the order of merges")
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    names |= {i: t for t, i in special.items()}
    return {"text": text, "split": split, "pair": pair, "special": special, "names": names}


class Encoder:
    """Encodes texts with one vocabulary."""

    def __init__(self, tables: dict, cache_words: int = CACHE_WORDS):
        import ahocorasick

        self.split, self.pair, self.special = tables["split"], tables["pair"], tables["special"]
        self.compat: dict[int, bool] = {}
        text: dict[int, str] = tables["text"]
        self.size = {i: len(t) for i, t in text.items()}
        valid: dict[int, bool] = {}
        for i in sorted(text):  # parts come before what they form
            two = self.split.get(i)
            valid[i] = two is None or (valid[two[0]] and valid[two[1]] and self.side_by_side(*two, i))
        self.token = {t: i for i, t in text.items() if valid[i]}
        self.shorter = {}
        self.longest = ahocorasick.Automaton()
        for t, i in self.token.items():
            self.longest.add_word(t, (i, len(t)))
            self.shorter[i] = next((self.token[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in self.token), None)
        self.longest.make_automaton()
        self.pretokens = regex.compile(PRETOKEN)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.cache = _Words(self.encode_word, cache_words)

    def side_by_side(self, a: int, b: int, limit: int = 1 << 31) -> bool:
        """Whether merging leaves ``a`` and ``b`` apart, counting only merges into tokens below ``limit``.

        The seam between both tokens existed at every earlier step between ever smaller parts:
        undo the later of the two merges at the seam, and see that no merge across it came first.
        """
        while True:
            new = self.pair.get((a, b))
            if new is not None and new < limit:
                return False
            if a in self.split and (a > b or b not in self.split):
                limit, a = a, self.split[a][1]
            elif b in self.split:
                limit, b = b + 1, self.split[b][0]
            else:
                return True

    def compatible(self, a: int, b: int) -> bool:
        """Entry of the pair-compatibility table, which is filled as pairs are met."""
        if len(self.compat) >= CACHE_PAIRS:
            self.compat.clear()
        ok = self.compat[a << 32 | b] = self.side_by_side(a, b)
        return ok

    def encode_word(self, word: str) -> bytes:
        raw = word.encode("utf-8").decode("latin-1")
        w = raw[:-1] + chr(ord(raw[-1]) + LAST)
        whole = self.token.get(w)
        if whole is not None:
            return whole.to_bytes(4, "little")
        n, known, size, shorter = len(w), self.compat.get, self.size, self.shorter
        start: list[int] = [0] * n
        for end, (i, length) in self.longest.iter(w):  # by rising end: the longest of each start comes last
            start[end - length + 1] = i
        untried = bytearray(b"\x01") * (n + 1)
        out: list[int] = []
        at, token, last = 0, start[0], -1
        while at < n:
            end = at + size[token]
            if untried[end]:
                ok = last < 0
                if not ok:
                    ok = known(last << 32 | token)
                    if ok is None:
                        ok = self.compatible(last, token)
                if ok:
                    out.append(token)
                    at, last = end, token
                    if at < n:
                        token = start[at]
                    continue
            less = shorter[token]
            if less is not None:
                token = less
                continue
            # nothing fits here: give up this place, and go on with the next shorter of the last token
            untried[at] = 0
            token = out.pop()
            at -= size[token]
            last = out[-1] if out else -1
        return struct.pack(f"<{len(out)}I", *out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = []
        for k, piece in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                parts.append(self.special[piece].to_bytes(4, "little"))
            elif piece:
                # lower-casing goes character by character: a capital sigma has one small form
                plain = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
                parts.append(b"".join(map(self.cache.__getitem__, self.pretokens.findall(plain))))
        return b"".join(parts)


class _Words(dict):
    """Word -> ids, holding at most two generations of ``size`` words."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, word: str) -> bytes:
        if len(word) > CACHE_LENGTH:
            return self.make(word)
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Decoder:
    """Ids to text: one byte string of all token names with its offsets; ids gather their slices."""

    def __init__(self, tables: dict):
        names = tables["names"]
        spelled = [(names.get(i, "") + " ").encode("utf-8") for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        self.offset = np.zeros(len(spelled) + 1, dtype=np.int64)
        np.cumsum([len(s) for s in spelled], out=self.offset[1:])

    def decode(self, ids: bytes | None) -> str:
        """Token names joined by one space (the vocabulary file names no decoder)."""
        if not ids:
            return ""
        every = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        parts = []
        for k in range(0, len(every), 1 << 16):
            part = every[k : k + (1 << 16)]
            begin, size = self.offset[part], self.offset[part + 1] - self.offset[part]
            before = np.cumsum(size) - size
            parts.append(self.blob[np.repeat(begin - before, size) + np.arange(int(size.sum()))].tobytes())
        return b"".join(parts)[:-1].decode("utf-8")


def share_vocabulary(spark: SparkSession, path: str) -> dict:
    """Broadcast the tables of a vocabulary file, for either direction; their size is bounded by the vocabulary."""
    tables = load_vocabulary(path)
    spell = {"names": tables.pop("names")}
    return {"encode": spark.sparkContext.broadcast(tables), "decode": spark.sparkContext.broadcast(spell)}


def encode(df: DataFrame, vocabulary: str, text_col: str = "text", out: str = "ids", shared: dict | None = None) -> DataFrame:
    """Add ``out``: the ids of each whole text, packed as little-endian unsigned 32-bit integers."""
    tables = (shared or share_vocabulary(df.sparkSession, vocabulary))["encode"]

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Encoder(tables.value)  # for the task: a worker that goes on to other work keeps none of it
        for texts in sliced(batches):
            yield pa.array([coder.encode(t.as_py()) for t in texts], type=pa.binary())

    return df.withColumn(out, ids(F.col(text_col).cast("string")))


def decode(df: DataFrame, vocabulary: str, ids_col: str = "ids", out: str = "decoded", shared: dict | None = None) -> DataFrame:
    """Add ``out``: the text of packed ids."""
    tables = (shared or share_vocabulary(df.sparkSession, vocabulary))["decode"]

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = Decoder(tables.value)
        for ids in sliced(batches):
            yield pa.array([coder.decode(i.as_py()) for i in ids], type=pa.string())

    return df.withColumn(out, text(F.col(ids_col)))


def round_trip(df: DataFrame, vocabulary: str, text_col: str = "text", out: str = "coded", shared: dict | None = None) -> DataFrame:
    """Add ``out``: struct (ids, decoded), encoded and decoded again in one worker instead of two."""
    shared = shared or share_vocabulary(df.sparkSession, vocabulary)
    to, back = shared["encode"], shared["decode"]

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = Encoder(to.value), Decoder(back.value)
        for texts in sliced(batches):
            ids = [encoder.encode(t.as_py()) for t in texts]
            yield pa.StructArray.from_arrays(
                [pa.array(ids, type=pa.binary()), pa.array([decoder.decode(i) for i in ids], type=pa.string())],
                names=["ids", "decoded"])

    return df.withColumn(out, both(F.col(text_col).cast("string")))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def digests(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Round trip of every text: token count and digests of the ids and of the decoded text."""
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    both = round_trip(docs, vocabulary or default_vocabulary(), out="coded").select("doc_id", "coded.ids", "coded.decoded")
    return both.select(
        "doc_id", F.expr("cast(length(ids) div 4 AS bigint)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
