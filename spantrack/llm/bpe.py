"""Byte-level BPE by monoid tree reduction.

A piece of text (one match of the pattern) is halved until the parts are short;
a part is encoded by merging, and neighbours are joined up the tree. A join
re-encodes a window around the boundary, at first one token of either side, and
widens it until the tokens outside stay as they are. That they do is provable: a
sequence of tokens is the encoding of its bytes exactly if each neighbouring pair
is the encoding of the pair's own bytes, since the first merge across a boundary
would also be the first in the pair alone. So only the two pairs at the window's
ends have to be checked. Decoding concatenates the tokens' bytes up the tree.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.llm._spark import python_ready

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
#: Bytes in a leaf of the tree; pieces, leaves with windows, and pairs that a worker remembers.
LEAF_BYTES, PIECES, PARTS, PAIRS = 5, 200_000, 150_000, 200_000
#: Tokens that decoding concatenates at a leaf.
LEAF_TOKENS = 4096


class Encoder:
    """Encodes and decodes by a rank file's content; ``pattern`` splits text into pieces."""

    def __init__(self, content: bytes, pattern: str = public_tokenizers.PATTERN):
        self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}
        self.tokens = {i: x for x, i in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def merged(self, data: bytes) -> tuple[int, ...]:
        """The encoding of a leaf or a window, by merging; short ones are remembered."""
        known = self.parts.get(data)
        if known is None:
            known = tuple(self._merged(data) if len(data) <= 64 else self._merged_long(data))
            if len(data) <= 64:
                if len(self.parts) >= PARTS:
                    self.parts.clear()
                self.parts[data] = known
        return known

    def _merged(self, data: bytes) -> list[int]:
        """Merge the pair of least rank, leftmost first, until none is left."""
        ranks, parts = self.ranks, [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            near = [ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:], strict=False)]
            least = min(near)
            if least == 1 << 40:
                break
            at = near.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[x] for x in parts]

    def _merged_long(self, data: bytes) -> list[int]:
        """The same with a heap and links, in n log n steps."""
        n, ranks = len(data), self.ranks
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n

        def pair(i: int) -> int | None:
            return ranks.get(data[i : end[end[i]]]) if end[i] < n else None

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop or end[i] == stop:
                continue
            gone = end[i]
            alive[gone], end[i] = False, stop
            if stop < n:
                before[stop] = i
            for j in (before[i], i):
                if j >= 0 and (r := pair(j)) is not None:
                    heapq.heappush(heap, (r, j, end[end[j]]))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return out

    def stable(self, left: int, right: int) -> bool:
        """Whether the two tokens stay apart next to each other."""
        known = self.pairs.get(left << 32 | right)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left << 32 | right] = self.merged(self.tokens[left] + self.tokens[right]) == (left, right)
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of the two sides' bytes together; associative, with () as its unit."""
        if not left or not right:
            return left or right
        if self.stable(left[-1], right[0]):
            return left + right
        a = b = 1
        while True:
            window = self.merged(b"".join([self.tokens[x] for x in left[len(left) - a :] + right[:b]]))
            left_holds = a == len(left) or self.stable(left[-a - 1], window[0])
            right_holds = b == len(right) or self.stable(window[-1], right[b])
            if left_holds and right_holds:
                return left[: len(left) - a] + window + right[b:]
            a = a if left_holds else min(2 * a, len(left))
            b = b if right_holds else min(2 * b, len(right))

    def tree(self, data: bytes) -> tuple[int, ...]:
        """Encode halves and join them."""
        if len(data) <= LEAF_BYTES:
            return self.merged(data)
        middle = len(data) // 2
        return self.join(self.tree(data[:middle]), self.tree(data[middle:]))

    def piece(self, piece: str) -> bytes:
        """A piece's ids as little-endian unsigned 32-bit integers; a piece that is a token is that token."""
        data = piece.encode("utf-8", "replace")
        rank = self.ranks.get(data)
        ids = self.tree(data) if rank is None else (rank,)
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.pieces) >= PIECES:
            self.pieces.clear()
        if len(piece) <= 64:
            self.pieces[piece] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of a text; pieces never merge, so that joining them is concatenation."""
        known = self.pieces.get
        return b"".join([known(x) or self.piece(x) for x in self.find(text)])

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_TOKENS:
            return b"".join([self.tokens[x] for x in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])

    def unpacked(self, ids: bytes) -> bytes:
        """Decode packed ids."""
        return self.decode(np.frombuffer(ids, "<u4").tolist())


_encoders: dict[tuple[bytes, str], Encoder] = {}


def encoder(content: bytes, pattern: str = public_tokenizers.PATTERN) -> Encoder:
    """One encoder for each vocabulary in a worker."""
    if (content, pattern) not in _encoders:
        _encoders[content, pattern] = Encoder(content, pattern)
    return _encoders[content, pattern]


def _content(df: DataFrame, path: str):
    """The rank file, read here and sent to the executors: a vocabulary, whose size the data don't change."""
    with open(path, "rb") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with column ``ids``: the text's token ids as little-endian unsigned 32-bit integers.

    ``decoded`` names a column for the bytes that these ids stand for, decoded in the
    same pass, so that a worker holds the vocabulary once.

    Null and empty texts have no tokens; strings of special tokens are ordinary
    text; repeated rows are encoded alike; an empty table gives no rows; a column
    of the name ``ids`` is replaced.
    """
    python_ready(docs.sparkSession)
    added = [ids, *([decoded] if decoded else [])]
    content, docs = _content(docs, path), docs.drop(*added)
    schema = docs.withColumns({c: F.lit(b"") for c in added}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(content.value, pattern)
        for batch in batches:
            texts = batch.column(text).cast(pa.string())
            found = [own.encode(x.as_py() or "") for x in texts]
            columns = [found, *([[own.unpacked(x) for x in found]] if decoded else [])]
            yield _with(batch, dict(zip(added, columns, strict=True)))

    return docs.mapInArrow(run, schema)


def _with(batch: pa.RecordBatch, added: dict[str, list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x, pa.binary()) for x in added.values()]], [*batch.schema.names, *added])


def decode(encoded: DataFrame, path: str = VOCABULARY, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with column ``out``: the bytes that its ids stand for.

    Null and empty ids give no bytes; repeated rows are decoded alike; an empty table
    gives no rows; other columns pass through, but one of the name ``out`` is replaced.
    """
    python_ready(encoded.sparkSession)
    content, encoded = _content(encoded, path), encoded.drop(out)
    schema = encoded.withColumn(out, F.lit(b"")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(content.value)
        for batch in batches:
            yield _with(batch, {out: [own.unpacked(x.as_py() or b"") for x in batch.column(ids)]})

    return encoded.mapInArrow(run, schema)
