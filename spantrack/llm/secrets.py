"""Secret scanning by a linear-chain conditional random field.

Fixed patterns find secrets of known forms. A CRF over words, with the tags
outside, begin and inside, learns from those on a bounded sample what secrets look
like: the word's shape and mixture of characters, its neighbours, and what kind of
file the text is. Decoding is Viterbi. A word whose lead for "outside" exceeds what
any two transitions could make up is outside on every best path, so that decoding
falls into the short runs between such words, each begun and ended outside; runs
are decoded side by side. Spans that the field adds are reported as kind ``crf``
where they touch no span of the patterns, which always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.llm._spark import python_ready
from spantrack.llm._text import Words, spans_hash, words_of

# The patterns of the known kinds, and how long a match must be.
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "crf")

#: Bounds of the training sample: documents, windows of one document, words in a window.
SAMPLE_ROWS, DOC_WINDOWS, WINDOW_WORDS = 12_000, 4, 40
STEPS, RATE, PENALTY, HASHES = 80, 0.15, 0.3, 2048
O, B, I = 0, 1, 2
#: Sizes of the feature tables; one more row stands for "no such word".
SIZES = (224, 224, 224, 16, 8, 8, HASHES, HASHES, HASHES, 16)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in code points, by start and kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


_CLASS = np.full(256, 4, np.uint8)  # 0 symbol, 1 digit, 2 upper, 3 lower, 4 beyond ASCII
_CLASS[:128] = 0
_CLASS[48:58], _CLASS[65:91], _CLASS[97:123] = 1, 2, 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPREAD = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int32)
    np.cumsum(flags, out=out[1:])
    return out


def features(words: Words) -> np.ndarray:
    """(words, 10) rows of the feature tables."""
    s, e, data = words.starts, words.ends, words.data
    n, kinds = len(s), _CLASS[data]
    counts = [(c := _sums(kinds == k))[e] - c[s] for k in range(4)]
    length = (e - s).astype(np.int32)
    beyond = length - sum(counts)
    bucket = np.searchsorted([3, 7, 11, 15, 23, 39], length)
    bits = (counts[1] > 0) + 2 * (counts[2] > 0) + 4 * (counts[3] > 0) + 8 * (counts[0] > 0) + 16 * (beyond > 0)
    shape = bucket * 32 + bits
    turns = _sums(np.concatenate([[False], (kinds[1:] != kinds[:-1]) & (kinds[1:] % 4 > 0) & (kinds[:-1] % 4 > 0)]))
    mixture = np.searchsorted([0, 1, 3], turns[e] - turns[s]) * 4 + np.minimum(3, 4 * counts[1] // np.maximum(length, 1))
    signs = _sums((data == 61) | (data == 58))
    marks = (signs[e] > signs[s]) + 2 * np.isin(data[e - 1], (61, 58)) + 4 * np.isin(data[s], (34, 39))
    own = np.empty(n, np.int64)
    own[:] = spans_hash(_SPREAD[_LOWER[data]], s, e, 0x9E3779B97F4A7C15) % np.uint64(HASHES)
    own[counts[1] > 0] = HASHES  # a secret is known by its form and never by name
    doc = words.of()
    totals = np.zeros((len(words.first), 3))
    for k, x in enumerate((length, counts[0], counts[1])):
        totals[:, k] = np.bincount(doc, x, len(words.first))
    share = totals[:, 1:] / np.maximum(totals[:, :1], 1)
    kind = np.searchsorted([0.02, 0.05, 0.2], share[:, 0]) * 4 + np.searchsorted([0.0, 0.02, 0.1], share[:, 1])

    def near(x: np.ndarray, by: int, none: int) -> np.ndarray:
        out = np.full(n, none, np.int64)
        if abs(by) < n:
            a, b = (slice(-by, None), slice(None, by)) if by < 0 else (slice(None, -by), slice(by, None))
            out[a] = np.where(doc[a] == doc[b], x[b], none)
        return out

    columns = (shape, near(shape, -1, 224), near(shape, 1, 224), mixture, marks, near(marks, -1, 8), own, near(own, -1, HASHES), near(own, -2, HASHES), kind[doc])
    return np.stack(columns, axis=1).astype(np.int32)


@dataclass
class Model:
    """Weights: a table of rows (outside, begin, inside) per feature, and the transitions."""

    tables: list[np.ndarray]
    moves: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros((len(rows), 3), np.float32)
        for k, x in enumerate(self.tables):
            out += x[rows[:, k]]
        return out

    def lead(self) -> float:
        """What the transitions around a word can favour another tag over outside at most."""
        m = self.moves
        return max(m[a, y] + m[y, b] - m[a, O] - m[O, b] for a in range(3) for b in range(3) for y in (B, I))

    def tags(self, rows: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The best tags of each text's words, as Viterbi over the whole text gives them."""
        score = self.scores(rows)
        out = np.zeros(len(rows), np.int8)
        open_ = np.flatnonzero(score[:, 1:].max(axis=1) + self.lead() + 1e-3 >= score[:, O])
        if not len(open_):
            return out
        cuts = np.flatnonzero((np.diff(open_) > 1) | (doc[open_[1:]] != doc[open_[:-1]])) + 1
        starts = open_[np.concatenate([[0], cuts])]
        lengths = np.diff(np.concatenate([[0], cuts, [len(open_)]]))
        for size in np.unique(lengths):
            at = starts[lengths == size][:, None] + np.arange(size)
            out[at] = self.viterbi(score[at])
        return out

    def viterbi(self, score: np.ndarray) -> np.ndarray:
        """Best tags for (runs, length, 3) scores; each run comes from and goes to outside."""
        runs, length, _ = score.shape
        best = self.moves[O] + score[:, 0]
        back = np.zeros((runs, length, 3), np.int8)
        for t in range(1, length):
            step = best[:, :, None] + self.moves
            back[:, t] = step.argmax(axis=1)
            best = step.max(axis=1) + score[:, t]
        tag = (best + self.moves[:, O]).argmax(axis=1)
        out = np.zeros((runs, length), np.int8)
        for t in range(length - 1, -1, -1):
            out[:, t] = tag
            tag = back[np.arange(runs), t, tag]
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(rows: np.ndarray, tags: np.ndarray, mask: np.ndarray, steps: int = STEPS) -> Model:
    """Maximum likelihood with an L2 penalty over (windows, words, features), by Adam; sizes are those of the sample."""
    n, length = mask.shape
    sizes = [s + 1 for s in SIZES]
    offset = np.concatenate([[0], np.cumsum(sizes)])
    flat = (rows + offset[:-1]).reshape(n * length, -1)
    weights, moves = np.zeros((offset[-1], 3)), np.zeros((3, 3))
    gold = np.eye(3)[tags] * mask[:, :, None]
    padded = np.concatenate([np.zeros((n, 1), int), np.where(mask, tags, O), np.zeros((n, 1), int)], axis=1)
    counted = np.zeros((3, 3))
    ends = mask.sum(axis=1)
    steps_in = np.arange(length + 1)[None, :] <= ends[:, None]
    np.add.at(counted, (padded[:, :-1][steps_in], padded[:, 1:][steps_in]), 1)
    memory = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
    for it in range(1, steps + 1):
        score = weights[flat].sum(axis=1).reshape(n, length, 3)
        alpha, beta = np.zeros((n, length, 3)), np.zeros((n, length, 3))
        alpha[:, 0] = moves[O] + score[:, 0]
        for t in range(1, length):
            alpha[:, t] = np.where(mask[:, t, None], _logsum(alpha[:, t - 1, :, None] + moves, 1) + score[:, t], alpha[:, t - 1])
        total = _logsum(alpha[:, -1] + moves[:, O], 1)
        beta[:, -1] = moves[:, O]
        for t in range(length - 2, -1, -1):
            beta[:, t] = np.where(mask[:, t + 1, None], _logsum(moves + (score[:, t + 1] + beta[:, t + 1])[:, None, :], 2), beta[:, t + 1])
        share = np.exp(alpha + beta - total[:, None, None]) * mask[:, :, None]
        expected = np.zeros((3, 3))
        expected[O] += share[:, 0].sum(axis=0)
        last = share[np.arange(n), ends - 1]
        expected[:, O] += last.sum(axis=0)
        for t in range(1, length):
            pair = alpha[:, t - 1, :, None] + moves + (score[:, t] + beta[:, t])[:, None, :] - total[:, None, None]
            expected += (np.exp(np.minimum(pair, 0)) * mask[:, t, None, None]).sum(axis=0)
        error = (share - gold).reshape(n * length, 3)
        slope = np.zeros_like(weights)
        for k in range(flat.shape[1]):
            for y in range(3):
                slope[:, y] += np.bincount(flat[:, k], error[:, y], len(weights))
        slope += PENALTY * weights
        slope_moves = expected - counted + PENALTY * moves
        for x, g, m, v in ((weights, slope, memory[0], memory[1]), (moves, slope_moves, memory[2], memory[3])):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= RATE * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-6)
    return Model([weights[a:b].astype(np.float32) for a, b in zip(offset, offset[1:], strict=False)], moves.astype(np.float32))


def _code_points(data: bytes, ends: list[int]) -> list[int]:
    """Code points before each byte offset, offsets ascending."""
    out, at, count = [], 0, 0
    for end in ends:
        count += len(data[at:end].translate(None, bytes(range(0x80, 0xC0))))
        at = end
        out.append(count)
    return out


def _labels(words: Words, text: str, k: int) -> np.ndarray:
    """Tags of text k's words after the patterns."""
    a, b = words.first[k], words.last[k]
    tags = np.zeros(b - a, np.int64)
    spans = base_spans(text)
    if not spans or a == b:
        return tags
    begin = words.starts[a:b]
    bytes_at = lambda i: len(text[:i].encode("utf-8", "replace"))
    low = _origin(words, k)
    for start, _, end in spans:
        i = np.searchsorted(words.ends[a:b] - low, bytes_at(start), "right")
        j = np.searchsorted(begin - low, bytes_at(end))
        tags[i:j] = I
        if i == 0 or tags[i - 1] == O:
            tags[i] = B
    return tags


def _origin(words: Words, k: int) -> int:
    return int(words.bounds[k])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows of sampled texts: flattened features and tags."""
    for batch in batches:
        texts = [x.as_py() or "" for x in batch.column(1)]
        hashes = batch.column(0).to_pylist()
        rows, tags = [], []
        for words in words_of(batch.column(1)):
            found = features(words) if len(words.starts) else None
            for k in range(len(words.first)):
                a, b = words.first[k], words.last[k]
                if a == b:
                    continue
                own = _labels(words, texts[words.row + k], k)
                h = hashes[words.row + k]
                at = [max(0, int(i) - h % 17 - 2) for i in np.flatnonzero(own == B)[: DOC_WINDOWS - 1]]
                at += [h % max(1, b - a - WINDOW_WORDS)] if at or h % 4 == 0 else []
                for i in at:
                    rows.append(found[a + i : min(b, a + i + WINDOW_WORDS)].ravel())
                    tags.append(own[i : i + WINDOW_WORDS])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32())), pa.array(tags, pa.list_(pa.int64()))], ["rows", "tags"])


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from the windows of the ``sample_rows`` documents of least hash; None where the patterns find nothing there.

    A document gives DOC_WINDOWS windows at most. Null and empty texts have no windows;
    repeated rows of one doc_id and text are one document; an empty table gives None;
    other columns are not read.
    """
    python_ready(docs.sparkSession)
    hashed = docs.select(F.xxhash64("doc_id", "text").alias("h"), F.col("text").cast("string").alias("text"))
    least = hashed.select("h").orderBy("h").limit(sample_rows)
    sample = hashed.join(F.broadcast(least.distinct()), "h", "left_semi").dropDuplicates(["h"])  # sample_rows hashes at most
    got = sample.select(F.shiftrightunsigned("h", 33).alias("h"), "text").mapInArrow(_windows, "rows array<int>, tags array<long>").toArrow()
    pairs = sorted(zip(got.column("rows").to_pylist(), got.column("tags").to_pylist(), strict=True))
    if not any(B in t for _, t in pairs):
        return None
    n = len(pairs)
    rows, tags, mask = np.zeros((n, WINDOW_WORDS, len(SIZES)), np.int64), np.zeros((n, WINDOW_WORDS), np.int64), np.zeros((n, WINDOW_WORDS), bool)
    for i, (r, t) in enumerate(pairs):
        rows[i, : len(t)], tags[i, : len(t)], mask[i, : len(t)] = np.array(r).reshape(len(t), -1), t, True
    return train(rows, tags, mask)


def _scan(model: Model | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x.as_py() or "" for x in batch.column(1)]
        spans = [[(*x,) for x in base_spans(t)] for t in texts]
        added: list[list] = [[] for _ in texts]
        for words in words_of(batch.column(1)) if model else ():
            if not len(words.starts):
                continue
            doc = words.of()
            tags = model.tags(features(words), doc)
            hit = np.flatnonzero(tags)
            head = (tags[hit] == B) | (np.concatenate([[-2], hit[:-1]]) != hit - 1) | (np.concatenate([[-1], doc[hit[:-1]]]) != doc[hit])
            firsts = hit[head]
            lasts = hit[np.concatenate([np.flatnonzero(head)[1:] - 1, [len(hit) - 1]])] if len(hit) else hit
            for k in np.unique(doc[firsts]):
                own = doc[firsts] == k
                low = _origin(words, k)
                data = words.data[low : words.ends[words.last[k] - 1]].tobytes()
                edges = [x - low for pair in zip(words.starts[firsts[own]], words.ends[lasts[own]], strict=True) for x in pair]
                places = _code_points(data, edges)
                base = spans[words.row + k]
                added[words.row + k] = [(a, 3, b) for a, b in zip(places[::2], places[1::2], strict=True) if not any(a < e and s < b for s, _, e in base)]
        found = [sorted([*b, *c]) for b, c in zip(spans, added, strict=True)]
        item = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[{"start": s, "kind": KINDS[k], "end": e} for s, k, e in x] for x in found], item)], ["doc_id", "spans"])


def scan(docs: DataFrame, model: Model | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, spans): each document's secrets as structs (start, kind, end) in code points, by start and kind.

    Without ``model`` one is fitted on ``docs``. Null and empty texts have none; a
    null doc_id stays null; repeated rows give repeated rows; an empty table gives
    no rows; other columns are not read.
    """
    python_ready(docs.sparkSession)
    model = model or fit(docs, sample_rows)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size
    out = "doc_id long, spans array<struct<start:long,kind:string,end:long>>"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(lambda x: _scan(sent.value, x), out)
