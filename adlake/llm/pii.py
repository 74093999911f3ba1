"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions that adds to them.

The tagger is trained in numpy from labelled spans, by default those that the patterns find in a bounded sample of windows of the
corpus, as they stand and disguised by fixed rules (``(at)`` for the at-sign, other separators, no plus), which no pattern matches.
A text is laid out in windows of ``WINDOW`` characters that overlap by half;
each window is decoded by Viterbi on its own, and the tags are reconciled over the whole text: a character
takes its tag from the window in which it stands most centrally, and spans are read off the united tags.
Every span of the patterns, plain or disguised, holds a digit, an at-sign or a bracketed ``at`` or ``dot``, so a tagger that learnt from them
does not decode a window with none of these in it or near it, and keeps spans that pass the patterns' checks of digits; one that learnt
from given labels decodes every window.  A span of the tagger is added where no span of the patterns overlaps it.

Defined results: null and empty texts have no spans; a corpus without any pattern match has no tagger and keeps
the patterns' spans (none); a span that begins a window's worth from the next anchor is found by the patterns
alone; repeated rows give repeated results; texts of any length are handled window by window; other columns
are kept as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import fresh, sliced

KINDS = ("email", "ip", "card", "phone")
WINDOW = 96
STRIDE = WINDOW // 2
#: A window is decoded if a digit or at-sign stands in it or this near to it.
NEAR = STRIDE
#: Windows with and without spans that the tagger is trained on: the bound of the training sample.
TRAIN_WITH, TRAIN_WITHOUT = 600, 300
#: Windows with disguised spans, beside those.
TRAIN_DISGUISED = 1200
HIDDEN = 16
STEPS = 600
BATCH = 32
#: Least mean probability of a span's tags for a span of the tagger to be added.
SURE = 0.9
#: Windows decoded at once in a task.
DECODE = 512

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_AT = re.compile(r"[(\[]at[)\]]")
_ANCHOR = re.compile(r"[0-9@]|[(\[](?:at|dot)[)\]]")
#: How a span is disguised: what stands for the at-sign and for the dots of an address, for the dots of an ip number, between a card's
#: groups of four, and for a phone number's plus (with the last, slashes stand between its groups of digits).
DISGUISES = {"email": ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."), (" @ ", ".")), "ip": ("[.]", "(.)", " . "),
             "card": (".", "/", "_"), "phone": ("00", "", "/")}


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses, leftmost first.  A local part runs up to the at-sign, so each at-sign is tried once."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            done = domain.end()
            yield begin, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """The patterns' spans (kind, start, end), by kind and start."""
    if not text:
        return []
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.groups())]
        for m in _CARD.finditer(text):
            digits = "".join(c for c in m[0] if c not in " -")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def disguised(kind: str, span: str, n: int) -> str:
    """A span as someone writes it who does not want it found: the ``n``-th way of its kind, by a fixed rule."""
    way = DISGUISES[kind][n % len(DISGUISES[kind])]
    if kind == "email":
        name, host = span.split("@", 1)
        return name + way[0] + host.replace(".", way[1])
    if kind == "ip":
        return span.replace(".", way)
    if kind == "card":
        digits = "".join(c for c in span if c not in " -")
        return way.join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return "/".join(re.findall("[0-9]+", span)) if way == "/" else way + span[1:]


def disguise(text: str, spans: list[tuple[str, int, int]], n: int | None = None) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with each span disguised, in the ``n``-th way or one that a checksum of it picks, and where the spans then stand.

    Of spans that overlap the first is disguised, and the others are left out.
    """
    parts, out, at, done = [], [], 0, 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            new = disguised(kind, text[a:b], zlib.crc32(text[a:b].encode("utf-8", "surrogatepass")) if n is None else n)
            parts += [text[done:a], new]
            at += a - done
            out.append((kind, at, at + len(new)))
            at, done = at + len(new), b
    return "".join([*parts, text[done:]]), out


def plausible(kind: str, span: str) -> bool:
    """Whether what the tagger found can be of its kind at all: the checks of the patterns, whatever stands between the digits."""
    digits = _DIGIT.findall(span)
    if kind == "email":
        return "@" in span or bool(_AT.search(span))
    if kind == "ip":
        numbers = [p.lstrip("0") or "0" for p in re.findall("[0-9]+", span)]
        return len(numbers) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in numbers)
    return 16 <= len(digits) <= 19 and luhn("".join(digits)) if kind == "card" else 8 <= len(digits) <= 15


# -- windows

def windows_of(text: str, every: bool = False) -> np.ndarray:
    """Starts of the windows that are decoded."""
    if every:
        return np.arange(-1, len(text) // STRIDE + 1) * STRIDE if text else np.empty(0, dtype=np.int64)
    anchors = np.array([m.start() for m in _ANCHOR.finditer(text)], dtype=np.int64)
    if not len(anchors):
        return anchors
    # window k covers [k * STRIDE - STRIDE, k * STRIDE + STRIDE): every character lies in two
    first = np.maximum(0, (anchors - NEAR) // STRIDE)
    last = (anchors + NEAR) // STRIDE + 1
    ks = first[:, None] + np.arange(2 + 2 * NEAR // STRIDE)[None, :]
    ks = np.unique(np.minimum(ks, last[:, None]))
    ks = ks[ks * STRIDE - STRIDE < len(text)]
    return ks * STRIDE - STRIDE


PAD, OTHER_LETTER, OTHER = 128, 129, 130
SYMBOLS = 131


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    return np.where(points < 128, points, np.where(points < 0x2000, OTHER_LETTER, OTHER))


def cut_windows(text: str, starts: np.ndarray) -> np.ndarray:
    padded = np.full(len(text) + 3 * WINDOW, PAD, dtype=np.int64)
    padded[WINDOW : WINDOW + len(text)] = symbols(text)
    return padded[(starts + WINDOW)[:, None] + np.arange(WINDOW)[None, :]]


def tags_of(length: int, spans: list[tuple[str, int, int]]) -> np.ndarray:
    """0 outside, 2k+1 first and 2k+2 further characters of a span of kind k; earlier kinds win overlaps."""
    tags = np.zeros(length, dtype=np.int64)
    for kind, a, b in reversed(spans):
        k = KINDS.index(kind)
        tags[a:b] = 2 * k + 2
        tags[a] = 2 * k + 1
    return tags


# -- the tagger

TAGS = 1 + 2 * len(KINDS)


def _forbidden() -> np.ndarray:
    """A further character of a kind follows a first or further character of the same kind only."""
    no = np.zeros((TAGS, TAGS), dtype=bool)
    for t in range(2, TAGS, 2):
        no[:, t] = True
        no[t - 1, t] = no[t, t] = False
    return no


FORBIDDEN = _forbidden()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def _new_parameters(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for d in ("f", "b"):
        p[f"in_{d}"] = rng.normal(0, 0.3, (SYMBOLS, 4 * HIDDEN))
        p[f"rec_{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        bias = np.zeros(4 * HIDDEN)
        bias[HIDDEN : 2 * HIDDEN] = 1.0  # remember at first
        p[f"bias_{d}"] = bias
    p["out"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS))
    p["out_bias"] = np.zeros(TAGS)
    p["move"] = np.zeros((TAGS, TAGS))
    return p


def _lstm(x: np.ndarray, rec: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (T, B, H) for gate inputs (T, B, 4H); gates in the order in, forget, out, candidate."""
    steps, n, _ = x.shape
    h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    states, trace = np.empty((steps, n, HIDDEN)), []
    for t in range(steps):
        z = x[t] + h @ rec
        gate = _sigmoid(z[:, : 3 * HIDDEN])
        g = np.tanh(z[:, 3 * HIDDEN :])
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN : 2 * HIDDEN], gate[:, 2 * HIDDEN :]
        before, h_before = c, h
        c = f * c + i * g
        tc = np.tanh(c)
        h = o * tc
        states[t] = h
        if keep:
            trace.append((i, f, o, g, before, tc, h_before))
    return states, trace


def _lstm_back(d_states: np.ndarray, trace: list, rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps, n, _ = d_states.shape
    dx, d_rec = np.empty((steps, n, 4 * HIDDEN)), np.zeros_like(rec)
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, tc, h_before = trace[t]
        dh = dh + d_states[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)), axis=1)
        dx[t] = dz
        d_rec += h_before.T @ dz
        dh, dc = dz @ rec.T, dc * f
    return dx, d_rec


def emissions(p: dict[str, np.ndarray], ids: np.ndarray, keep: bool = False):
    """Tag scores (T, B, TAGS) of windows (B, T); with ``keep`` also what training needs."""
    x = ids.T
    forward, trace_f = _lstm(p["in_f"][x] + p["bias_f"], p["rec_f"], keep)
    backward, trace_b = _lstm(p["in_b"][x[::-1]] + p["bias_b"], p["rec_b"], keep)
    h = np.concatenate((forward, backward[::-1]), axis=2)
    return (h @ p["out"] + p["out_bias"], h, trace_f, trace_b) if keep else h @ p["out"] + p["out_bias"]


def _moves(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.where(FORBIDDEN, -1e4, p["move"])


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _forward_backward(score: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log sums over all tag sequences up to and after each place, and over all of them."""
    alpha, beta = np.empty_like(score), np.zeros_like(score)
    alpha[0] = score[0]
    for t in range(1, len(score)):
        alpha[t] = score[t] + _logsumexp(alpha[t - 1][:, :, None] + move[None], 1)
    for t in range(len(score) - 2, -1, -1):
        beta[t] = _logsumexp(move[None] + (score[t + 1] + beta[t + 1])[:, None, :], 2)
    return alpha, beta, _logsumexp(alpha[-1], 1)


def gradients(p: dict[str, np.ndarray], ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log-likelihood of the tag sequences under the CRF, and its gradients."""
    score, h, trace_f, trace_b = emissions(p, ids, keep=True)
    steps, n, _ = score.shape
    move, y, row = _moves(p), tags.T, np.arange(n)
    alpha, beta, total = _forward_backward(score, move)
    gold = score[np.arange(steps)[:, None], row, y].sum(axis=0) + move[y[:-1], y[1:]].sum(axis=0)
    both = np.exp(alpha[:-1, :, :, None] + move + (score + beta)[1:, :, None, :] - total[:, None, None])
    d_move = both.sum(axis=(0, 1)) - np.bincount((y[:-1] * TAGS + y[1:]).reshape(-1), minlength=TAGS * TAGS).reshape(TAGS, TAGS)
    d_score = np.exp(alpha + beta - total[None, :, None])
    d_score[np.arange(steps)[:, None], row[None, :], y] -= 1.0
    d_score /= n
    d_h = d_score @ p["out"].T
    g = {"move": np.where(FORBIDDEN, 0.0, d_move / n), "out": np.einsum("tbh,tbk->hk", h, d_score), "out_bias": d_score.sum(axis=(0, 1))}
    for d, d_states, trace, x in (("f", d_h[:, :, :HIDDEN], trace_f, ids.T), ("b", d_h[::-1, :, HIDDEN:], trace_b, ids.T[::-1])):
        dx, g[f"rec_{d}"] = _lstm_back(d_states, trace, p[f"rec_{d}"])
        g[f"bias_{d}"] = dx.sum(axis=(0, 1))
        g[f"in_{d}"] = np.eye(SYMBOLS)[x.reshape(-1)].T @ dx.reshape(-1, 4 * HIDDEN)
    return float((total - gold).mean()), g


def fit(ids: np.ndarray, tags: np.ndarray, steps: int = STEPS, rate: float = 0.05, seed: int = 1) -> dict[str, np.ndarray]:
    """Train by ``steps`` Adam steps over shuffled batches of windows (N, WINDOW) and their tags."""
    p = _new_parameters(seed)
    first, second = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    rng, order = np.random.default_rng(seed), np.empty(0, dtype=np.int64)
    for step in range(1, steps + 1):
        if len(order) < min(BATCH, len(ids)):
            order = rng.permutation(len(ids))
        pick, order = order[:BATCH], order[BATCH:]
        _, g = gradients(p, ids[pick], tags[pick])
        norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
        pace, clip = rate * 0.5 ** (3 * step / steps), min(1.0, 5.0 / (norm + 1e-9))
        for name, v in g.items():
            first[name] = 0.9 * first[name] + 0.1 * clip * v
            second[name] = 0.99 * second[name] + 0.01 * (clip * v) ** 2
            p[name] -= pace * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
    return p


def viterbi(p: dict[str, np.ndarray], ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags (B, T) of windows, and the probability of each of them at its place."""
    score, move = emissions(p, ids), _moves(p)
    steps, n, _ = score.shape
    best, back = score[0], np.empty((steps, n, TAGS), dtype=np.int8)
    for t in range(1, steps):
        way = best[:, :, None] + move[None]
        back[t] = way.argmax(axis=1)
        best = way.max(axis=1) + score[t]
    out = np.empty((n, steps), dtype=np.int64)
    out[:, -1] = best.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[t][np.arange(n), out[:, t]]
    alpha, beta, total = _forward_backward(score, move)
    sure = np.exp(alpha + beta - total[None, :, None])
    return out, np.take_along_axis(sure.transpose(1, 0, 2), out[:, :, None], axis=2)[:, :, 0]


def reconcile(text: str, starts: np.ndarray, tags: np.ndarray, sure: np.ndarray, every: bool = False) -> list[tuple[str, int, int]]:
    """Spans of the whole text: each character's tag is that of the window in which it stands most centrally.

    A span needs a mean probability of its tags of at least ``SURE`` and, unless the labels were given (``every``), to be ``plausible``.
    """
    middle = slice(WINDOW // 4, WINDOW // 4 + STRIDE)  # the middle halves of all windows tile the text
    place = (starts[:, None] + np.arange(WINDOW)[None, :])[:, middle].reshape(-1)
    tag, prob = tags[:, middle].reshape(-1), sure[:, middle].reshape(-1)
    inside = (tag > 0) & (place >= 0) & (place < len(text))
    spans: list[list] = []
    for at, t, q in zip(place[inside].tolist(), tag[inside].tolist(), prob[inside].tolist(), strict=True):
        kind = KINDS[(t - 1) // 2]
        if t % 2 == 0 and spans and spans[-1][2] == at and spans[-1][0] == kind:
            spans[-1][2] = at + 1
            spans[-1][3] += q
        elif t % 2:
            spans.append([kind, at, at + 1, q])
    return [(k, a, b) for k, a, b, q in spans if q >= SURE * (b - a) and (every or plausible(k, text[a:b]))]


def tagged_spans(p: dict[str, np.ndarray], texts: list[str | None]) -> list[list[tuple[str, int, int]]]:
    """The tagger's spans of each text; windows of many texts are decoded together."""
    out: list[list] = [[] for _ in texts]
    held: list[tuple[int, np.ndarray, int]] = []  # text, starts, number of windows
    every_window = "every" in p
    cut, size, tags = [], 0, []

    def decode():
        nonlocal size
        every = np.concatenate(cut)
        got, sure = map(np.concatenate, zip(*(viterbi(p, every[k : k + DECODE]) for k in range(0, len(every), DECODE)), strict=True))
        at = 0
        for k, starts, n in held:
            out[k] = reconcile(texts[k], starts, got[at : at + n], sure[at : at + n], every_window)
            at += n
        held.clear()
        cut.clear()
        size = 0

    for k, text in enumerate(texts):
        starts = windows_of(text, every_window) if text else ()
        if len(starts):
            held.append((k, starts, len(starts)))
            cut.append(cut_windows(text, starts))
            size += len(starts)
            if size >= 8 * DECODE:
                decode()
    if held:
        decode()
    return out


# -- Spark

def training_windows(docs: DataFrame, text_col: str = "text", spans_col: str | None = None, n_with: int = TRAIN_WITH,
                     n_without: int = TRAIN_WITHOUT, n_disguised: int = TRAIN_DISGUISED) -> tuple[np.ndarray, np.ndarray]:
    """A bounded sample of labelled windows: of distinct windows those of smallest hash, with spans, without, and with disguised ones.

    ``spans_col`` (array of struct kind, start, end) holds the labels; without it the patterns' spans are the labels, and a
    text with spans is taken again with all of them disguised, once in each way, so that the tagger learns what the patterns miss.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got, lab, new = [], [], []
            for row in range(batch.num_rows):
                text = batch.column(0)[row].as_py()
                starts = windows_of(text, spans_col is not None)
                if not len(starts):
                    continue
                spans = base_spans(text) if spans_col is None else [
                    (s["kind"], s["start"], s["end"]) for s in batch.column(1)[row].as_py() or []]
                versions = [(text, starts, spans)]
                if spans_col is None and spans:
                    for n in range(max(map(len, DISGUISES.values()))):
                        other, moved = disguise(text, spans, n)
                        versions.append((other, windows_of(other), moved))
                for k, (text, starts, spans) in enumerate(versions):
                    tag = np.zeros(len(text) + 3 * WINDOW, dtype=np.int64)
                    tag[WINDOW : WINDOW + len(text)] = tags_of(len(text), spans)
                    for w, t in zip(cut_windows(text, starts), tag[(starts + WINDOW)[:, None] + np.arange(WINDOW)], strict=True):
                        if k == 0 or t.any():
                            got.append(w.astype(np.uint8).tobytes())
                            lab.append(t.astype(np.uint8).tobytes())
                            new.append(min(k, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(got, type=pa.binary()), pa.array(lab, type=pa.binary()), pa.array(new, type=pa.int32())], names=["win", "tag", "new"])

    text = F.col(text_col).cast("string")
    rows = docs.where(text.rlike("[0-9@]") if spans_col is None else text != "").select(text.alias("text"), *([F.col(spans_col)] if spans_col else []))
    each = rows.mapInArrow(cut, "win binary, tag binary, new int").groupBy("win").agg(F.min("tag").alias("tag"), F.min("new").alias("new"))
    kind = F.when(F.col("tag") == F.lit(bytes(WINDOW)), "without").when(F.col("new") == 1, "disguised").otherwise("with")
    each = each.select("win", "tag", F.xxhash64("win").alias("h"), kind.alias("kind"))
    pick = [r for kind, n in (("with", n_with), ("without", n_without), ("disguised", n_disguised))
            for r in each.where(F.col("kind") == kind).orderBy("h", "win").limit(n).collect()]
    as_rows = lambda k: np.array([list(r[k]) for r in pick], dtype=np.int64).reshape(-1, WINDOW)
    return as_rows("win"), as_rows("tag")


def train(docs: DataFrame, text_col: str = "text", spans_col: str | None = None) -> dict[str, np.ndarray] | None:
    """A tagger from labelled windows of the corpus; None where no window has a span.

    One that was trained on given labels decodes every window, as these may hold neither a digit nor an at-sign.
    """
    ids, tags = training_windows(docs, text_col, spans_col)
    if not tags.any():
        return None
    return fit(ids, tags) | ({} if spans_col is None else {"every": np.ones(1)})


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def all_spans(model: dict | None, texts: list[str | None]) -> list[list[tuple[str, int, int, bool]]]:
    """Spans of the patterns, and of the tagger where they overlap none of those; by kind and start."""
    added = tagged_spans(model, texts) if model else [[] for _ in texts]
    out = []
    for text, more in zip(texts, added, strict=True):
        base = base_spans(text)
        free = [s for s in more if not any(s[1] < b and a < s[2] for _, a, b in base)]
        both = [(*s, True) for s in base] + [(*s, False) for s in free]
        out.append(sorted(both, key=lambda s: (KINDS.index(s[0]), s[1])))
    return out


def spans(model: dict | None, text: Column) -> Column:
    """The spans of a text column, in code points with an exclusive end."""
    @F.arrow_udf(SPANS)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for texts in sliced(batches, 1024):
            rows = all_spans(model, texts.to_pylist())
            yield pa.array([[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in r] for r in rows], type=kind)

    return found(text.cast("string"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, the number of the patterns' spans of each kind, their digest, and all spans."""
    docs = docs.select("doc_id", "text")
    found = docs.select("doc_id", spans(train(docs), F.col("text")).alias("spans"))
    spelled = "concat_ws(',', transform({0}, s -> concat(s.kind, ':', s.start, ':', s.end)))"
    return found.select(
        "doc_id", *[F.expr(f"cast(size(filter(spans, s -> s.base AND s.kind = '{k}')) AS bigint)").alias(f"n_{k}") for k in KINDS],
        F.expr(f"sha2({spelled.format('filter(spans, s -> s.base)')}, 256)").alias("base_sha256"),
        F.expr(spelled.format("spans")).alias("spans"))


def masked(text: str, found: list) -> str:
    """The text with each span replaced by its kind; spans that overlap become one, of the first one's kind."""
    parts, at = [], 0
    for kind, a, b, _ in sorted(found, key=lambda s: (s[1], -s[2])):
        if a >= at:
            parts += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def mask(docs: DataFrame, text_col: str = "text", model: dict | None = None) -> DataFrame:
    """Replace personal data in the text column by its kind; other columns and all rows stay."""
    model = model or train(docs, text_col)

    @F.arrow_udf("string")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches, 1024):
            rows = texts.to_pylist()
            yield pa.array([masked(t, s) if s else t for t, s in zip(rows, all_spans(model, rows), strict=True)], type=pa.string())

    name = fresh(docs, "masked")
    return docs.withColumn(name, clean(F.col(f"`{text_col}`").cast("string"))).select(
        *[F.col(name).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
