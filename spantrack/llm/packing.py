"""Packing by power-of-two decomposition.

A document's tokens, with an end token, are cut at the binary digits of their number:
as many pieces of the longest length as fit, then one for each set bit of the rest,
longer ones first. Each piece is a sequence of its own, so that no sequence crosses
documents and none is padded; pieces of one length form a bucket, from which batches of
equal sequences are drawn. A bucket's sequences are numbered one after the other: tasks
number theirs by length, and the counts of tasks, a row for each task and length, are
summed up along each bucket, so that no piece moves.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spantrack.llm._spark import FEW_IDS, cut, python_ready
from spantrack.llm._units import BOUNDARY, MOST, ByteTokenizer, Units, plain, sizes, slices

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: The token after each document, tokens of the longest sequence, and bytes of tokens that a worker hands over at a time.
END_ID, MOST_TOKENS, OUT_BYTES = 1, 2048, 8 << 20


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, by a tokenizer's file content."""

    def __init__(self, content: str):
        self.tokenizer = ByteTokenizer(content)
        self.lengths = np.zeros(max(self.tokenizer.bytes) + 1, np.int64)
        for i, x in self.tokenizer.bytes.items():
            self.lengths[i] = len(x)
        self.clear()

    def clear(self) -> None:
        self.ids: list[bytes] = []
        self.units = Units()

    def _encoded(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text), "<u4").tobytes()

    def _settle(self) -> None:
        """Encode the units that are new."""
        new, self.units.new = self.units.new, []
        easy = [x for x in new if plain(x)]
        ends, ids = np.cumsum(sizes(easy)), self.tokenizer.together("".join(easy))
        known: dict[str, bytes] = {}
        if ids is not None and len(easy):
            at = np.cumsum(self.lengths[ids])
            bounds = np.searchsorted(at, ends) + 1
            if at[-1] == ends[-1] and (at[bounds - 1] == ends).all():
                data, bounds = ids.astype("<u4").tobytes(), (4 * bounds).tolist()
                known = {x: data[i:j] for x, i, j in zip(easy, [0, *bounds], bounds, strict=False)}
        self.ids += [known[x] if x in known else self._encoded(x) for x in new]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.ids) > MOST:
            self.clear()
        found = []
        for text in texts:
            at = BOUNDARY.search(text)  # what stands before the first space that begins a unit is a text of its own
            found.append((text[: at.start()], self.units.of(text[at.end() :]).tolist()) if at else (text, []))
        self._settle()
        return [(self._encoded(head) if head else b"") + b"".join(map(self.ids.__getitem__, own)) for head, own in found]


def lengths(n: int, most: int = MOST_TOKENS) -> list[int]:
    """``n`` as a sum of ``most`` as often as it fits and of falling powers of two."""
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID, most: int = MOST_TOKENS, ids: bool = True) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, ids, part, nth): a row per piece, the nth of its length in task ``part``."""
    if most < 1 or most & (most - 1):
        raise ValueError("the longest length must be a power of two")
    python_ready(docs.sparkSession)
    with open(path, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # a vocabulary, whose size the data don't change
    end = np.array([end_id], "<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "part", "nth"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoders.get(content.value) or _encoders.setdefault(content.value, Encoder(content.value))
        part, counts = TaskContext.get().partitionId(), {}
        rows, size = [], 0
        for doc_id, data in _encoded(batches, own):
            data, at = data + end, 0
            for n in lengths(len(data) // 4, most):
                piece = data[4 * at : 4 * (at + n)]
                nth = counts[n] = counts.get(n, -1) + 1
                rows.append((doc_id, at, n, zlib.crc32(piece), len(data) // 4, piece if ids else None, part, nth))
                at, size = at + n, size + 40 + len(piece) * ids
                if size >= OUT_BYTES:
                    yield _batch(rows, kinds, names)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, kinds, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, part int, nth long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def _encoded(batches: Iterator[pa.RecordBatch], own: Encoder) -> Iterator[tuple[int | None, bytes]]:
    for batch in batches:
        for a, b in slices(batch.column(1)):
            texts = [x or "" for x in batch.column(1).slice(a, b - a).to_pylist()]
            yield from zip(batch.column(0).slice(a, b - a).to_pylist(), own.encode(texts), strict=True)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def pack(docs: DataFrame, path: str = VOCABULARY, end_id: int = END_ID, most: int = MOST_TOKENS, ids: bool = True) -> DataFrame:
    """Per piece: doc_id, start (the document's tokens before it), length, ids_crc32, doc_tokens, sequence_id, offset and, where ``ids``, ids (little-endian unsigned 32-bit integers).

    Each piece is a sequence, so that offset is 0; sequence_id runs without gaps from
    0 over all pieces, longest bucket first. A null or empty text has the end token
    alone; strings of special tokens become what the tokenizer makes of them; repeated
    rows are packed each for itself; an empty table gives no rows; other columns are
    not read. A text's tokens are held in one task at a time.
    """
    found = cut(pieces(docs, path, end_id, most, ids))
    counts = found.groupBy("length", "part").agg(F.count("*").alias("n"))
    along = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    within = cut(counts.select("length", "part", "n", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before")))
    longer = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)  # a row per length
    buckets = within.groupBy("length").agg(F.sum("n").alias("n")).select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("longer"))
    bases = cut(within.join(F.broadcast(buckets), "length").select("length", "part", (F.col("before") + F.col("longer")).alias("base")))
    named = found.join(F.broadcast(bases) if bases.count() <= FEW_IDS else bases, ["length", "part"])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")]
    return named.select(*columns, *(["ids"] if ids else []))


def write_buckets(packed: DataFrame, path: str) -> None:
    """The sequences as Parquet files by length, so that a reader of one bucket makes batches without padding."""
    packed.withColumn("bucket", F.col("length")).write.partitionBy("bucket").parquet(path)
