"""Token pairs of two tokenizers that lie over the same bytes, and in how many documents each pair does.

Where a token of either side ends at the same byte, the text is cut into groups; every
token of one side is linked to every one of the other in its group. A first pass
aligns the documents and counts pairs within tasks. The distinct pairs are dealt to
shards by hash, and each shard gets a minimal perfect hash: rounds of bit arrays, in
which a pair that is alone at its place takes it, and the number of taken places before
it is its index. The tasks' counts become dense vectors under these indexes, a chunk of
tasks and a shard each, and are summed up a tree of chunks. Keys stand in the same
order, so that a lookup is verified. A second pass aligns the documents again and looks
their links up: in the broadcast index where its size, counted first, is below a bound,
otherwise by a join of each document's pairs with the index as a table.

Both sides encode a text unit by unit (``_units``), and a unit's alignment is made once
in a worker.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from hashlib import sha256
from itertools import product

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.llm._spark import cut, python_ready
from spantrack.llm._text import U, mix
from spantrack.llm._units import MOST, ByteTokenizer, Units, gathered, plain, sizes, slices

A_VOCABULARY, B_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
#: Pairs in a shard (about), tasks whose counts meet in one step of the tree, pairs that a task counts before it hands them over.
SHARD_PAIRS, FAN_IN, HELD_PAIRS = 1 << 16, 8, 1 << 20
#: Bytes of the index up to which it is broadcast, and those of a pair in it.
BROADCAST_BYTES, PAIR_BYTES = 64 << 20, 17
#: Places of a round for each key that is left; bits of a pair's second id, of a pair, and of a document's number in a batch.
PLACES, B_BITS, PAIR_BITS, DOC_BITS = 2, 20, 36, 20
_ROUND = 0xC2B2AE3D27D4EB4F


class Aligner:
    """Aligns texts by two vocabularies; a unit's alignment is kept until there are too many."""

    def __init__(self, a_content: str, b_content: bytes):
        self.a = ByteTokenizer(a_content, specials_are_text=True)
        self.b = b = sentencepiece.SentencePieceProcessor(model_proto=b_content)
        a_tokens = [self.a.bytes.get(i, b"") for i in range(max(self.a.bytes) + 1)]
        b_tokens = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(len(b))]
        self.tokens = _Strings(a_tokens), _Strings(b_tokens)
        self.names = _Strings([str(i).encode() for i in range(max(len(a_tokens), len(b_tokens)))])
        self.clear()

    def clear(self) -> None:
        self.units, self.place = Units(), np.empty(0, np.int64)
        self.shown: list[bytes] = []
        self.facts, self.keys, self.times, self.sizes = np.empty((0, 4), np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)

    def _settle(self) -> None:
        """Align the units that are new: plain ones in a row, others one by one."""
        new, self.units.new = self.units.new, []
        easy = np.fromiter((plain(x) and "▁" not in x for x in new), bool, len(new))
        row = [x for x, ok in zip(new, easy, strict=True) if ok]
        found = self._in_a_row(row) if row else None
        if found is None:
            easy[:], row = False, []
        parts = [found] if row else []
        parts += [self._one(x) for x, ok in zip(new, easy, strict=True) if not ok]
        at = np.empty(len(new), np.int64)
        at[easy], at[~easy] = np.arange(len(row)), np.arange(len(row), len(new))
        self.place = np.concatenate([self.place, len(self.shown) + at])
        self.shown += [x for part in parts for x in part[0]]
        self.facts, self.keys, self.times, self.sizes = (np.concatenate([have, *[part[i] for part in parts]]) for i, have in enumerate((self.facts, self.keys, self.times, self.sizes), 1))

    def _one(self, unit: str) -> tuple:
        """Groups as text, facts, links' pairs and times, and their number, of a unit; n_a is -1 where the tokens don't spell it."""
        sides = self.a.encode(unit), self.b.encode(unit[1:])
        spelled = [[own.items[x] for x in ids] for own, ids in zip(self.tokens, sides, strict=True)]
        links: Counter[int] = Counter()
        if not b"".join(spelled[0]) == b"".join(spelled[1]) == unit.encode():
            return [b""], np.array([[-1, 0, 0, 0]]), *[np.empty(0, np.int64)] * 2, np.zeros(1, np.int64)
        ends = [np.cumsum([len(x) for x in own]) for own in spelled]
        cuts = np.intersect1d(*ends)
        begins = [np.concatenate([[0], np.searchsorted(x, cuts) + 1]) for x in ends]
        groups, n_links = [], 0
        for i in range(len(cuts)):
            a, b = (ids[x[i] : x[i + 1]] for ids, x in zip(sides, begins, strict=True))
            groups.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
            n_links += len(a) * len(b)
            for (x, k), (y, m) in product(Counter(a).items(), Counter(b).items()):
                links[x << B_BITS | y] += k * m
        facts = np.array([[len(sides[0]), len(sides[1]), len(groups), n_links]])
        return [";".join(groups).encode()], facts, np.fromiter(links.keys(), np.int64, len(links)), np.fromiter(links.values(), np.int64, len(links)), np.array([len(links)])

    def _in_a_row(self, units: list[str]) -> tuple | None:
        """The same of many units; None where tokens don't end with each unit or spell something else."""
        text = "".join(units)
        a = self.a.together(text)
        if a is None:
            return None
        b, last = np.array(self.b.encode(text[1:]), np.int64), np.cumsum(sizes(units))
        data = np.frombuffer(text.encode(), np.uint8)
        sides = list(zip(self.tokens, (a, b), strict=True))
        if not all(np.array_equal(own.joined(ids), data) for own, ids in sides):
            return None
        ends_a, ends_b = (np.cumsum(own.lengths[ids]) for own, ids in sides)
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not np.array_equal(cuts[np.searchsorted(cuts, last)], last):
            return None
        in_a, in_b, unit = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b), np.searchsorted(last, cuts)
        n_a, n_b, n = np.bincount(in_a), np.bincount(in_b), len(units)
        facts = np.stack([np.bincount(unit, x, n) for x in (n_a, n_b, np.ones(len(cuts)), n_a * n_b)], axis=1).astype(np.int64)
        # each token of the first side meets those of the second in its group
        meets = n_b[in_a]
        nth = np.arange(meets.sum()) - np.repeat(np.cumsum(meets) - meets, meets)
        pairs = np.repeat(a, meets) << B_BITS | b[np.repeat((np.cumsum(n_b) - n_b)[in_a], meets) + nth]
        both, times = np.unique(np.repeat(unit[in_a], meets) << PAIR_BITS | pairs, return_counts=True)
        return self._texts(a, b, in_a, in_b, facts), facts, both & ((1 << PAIR_BITS) - 1), times, np.bincount(both >> PAIR_BITS, minlength=n)

    def _texts(self, a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, facts: np.ndarray) -> list[bytes]:
        """Each unit's groups as text."""
        side = np.concatenate([2 * in_a, 2 * in_b + 1])
        order = np.argsort(side, kind="stable")
        ids, side = np.concatenate([a, b])[order], side[order]
        first = np.append(True, side[1:] != side[:-1])
        mark = np.where(first, np.where(side % 2 == 0, ord(";"), ord("|")), ord(",")).astype(np.uint8)
        digits = self.names.lengths[ids]
        ends = np.cumsum(digits + 1)
        out = np.empty(ends[-1], np.uint8)
        at = np.zeros(len(out), bool)
        at[ends - digits - 1] = True
        out[at], out[~at] = mark, self.names.joined(ids)
        bounds, data = ends[np.cumsum(facts[:, 0] + facts[:, 1]) - 1].tolist(), out.tobytes()
        return [data[i + 1 : j] for i, j in zip([0, *bounds], bounds, strict=False)]

    def texts(self, column: pa.Array) -> Aligned:
        """The alignment of some texts."""
        if self.units.n > MOST:
            self.clear()
        units = [self.units.of(x) if x else np.empty(0, np.int64) for x in column.to_pylist()]
        if self.units.new:
            self._settle()
        n = len(units)
        counts = np.fromiter(map(len, units), np.int64, n)
        doc, own = np.repeat(np.arange(n), counts), self.place[np.concatenate([np.empty(0, np.int64), *units])]
        facts = self.facts[own]
        bad = np.bincount(doc[facts[:, 0] < 0], minlength=n) > 0
        good = ~bad[doc]
        doc, own, facts = doc[good], own[good], facts[good]
        sums = np.stack([totals(doc, x, n) for x in facts.T], axis=1)
        # a document's units, each with its number of times, then their links
        both, times = np.unique(doc << 32 | own, return_counts=True)
        doc_of, unit = both >> 32, both & 0xFFFFFFFF
        links, starts = self.sizes[unit], np.cumsum(self.sizes) - self.sizes
        key = gathered(self.keys, starts, self.sizes, unit)
        shown = [b";".join(map(self.shown.__getitem__, x)) for x in np.split(own, np.searchsorted(doc, np.arange(1, n)))] if n else []
        return Aligned(shown, sums, np.repeat(doc_of, links), key, gathered(self.times, starts, self.sizes, unit) * np.repeat(times, links))


class _Strings:
    """Byte strings by number, also many of them in a row."""

    def __init__(self, items: list[bytes]):
        self.items = items
        self.flat, self.lengths = np.frombuffer(b"".join(items), np.uint8), np.array([len(x) for x in items], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def joined(self, which: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.starts, self.lengths, which)


def totals(doc: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of whole numbers by document; ``doc`` is sorted."""
    sums, bounds = np.concatenate([[0], np.cumsum(values)]), np.searchsorted(doc, np.arange(n + 1))
    return sums[bounds[1:]] - sums[bounds[:-1]]


def _begins(x: np.ndarray) -> np.ndarray:
    """Where sorted numbers change."""
    return np.append(np.ones(min(len(x), 1), bool), x[1:] != x[:-1])


class Aligned:
    """Groups as text and sums (tokens of either side, groups, links) of each document, and its links: document, in order, pair, times."""

    def __init__(self, shown: list[bytes], sums: np.ndarray, doc: np.ndarray, key: np.ndarray, times: np.ndarray):
        self.shown, self.sums, self.doc, self.key, self.times = shown, sums, doc, key, times

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs, and how many of these documents hold each."""
        held = np.sort(self.key << DOC_BITS | self.doc)
        held = held[_begins(held)] >> DOC_BITS
        first = np.flatnonzero(_begins(held))
        return held[first], np.diff(np.append(first, len(held)))


class PerfectHash:
    """A minimal perfect hash of distinct numbers: rounds of bit arrays in words of 64 places, with the taken places before each word."""

    def __init__(self, keys: np.ndarray):
        self.rounds: list[tuple[np.ndarray, np.ndarray]] = []
        left, before = keys, 0
        while len(left):
            places = 64 * (PLACES * len(left) // 64 + 1)
            at = self._place(left, len(self.rounds), places)
            alone = np.bincount(at, minlength=places) == 1
            words = np.packbits(alone, bitorder="little").view(U)
            counts = np.bitwise_count(words).astype(np.int64)
            self.rounds.append((words, before + np.cumsum(counts) - counts))
            before += int(counts.sum())
            left = left[~alone[at]]

    @staticmethod
    def _place(keys: np.ndarray, turn: int, places: int) -> np.ndarray:
        return (mix(keys.view(U) + U((turn + 1) * _ROUND % 2**64)) % U(places)).astype(np.int64)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; other numbers get some index or -1."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for turn, (words, ranks) in enumerate(self.rounds):
            at = self._place(keys[left], turn, 64 * len(words))
            word, bit = words[at >> 6], U(1) << (at & 63).astype(U)
            hit = word & bit != 0
            out[left[hit]] = (ranks[at >> 6] + np.bitwise_count(word & (bit - U(1))))[hit]
            left = left[~hit]
        return out


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys.view(U)) % U(shards)).astype(np.int32)


class Index:
    """Counts of pairs by the shards' hashes; ``best`` has the highest count of each first id."""

    def __init__(self, shards: int, parts: dict[int, tuple[list, np.ndarray, np.ndarray]], best: np.ndarray):
        self.shards, self.best = shards, best
        self.parts = {}
        for shard, (rounds, keys, counts) in parts.items():
            own = PerfectHash(np.empty(0, np.int64))
            own.rounds = rounds
            self.parts[shard] = own, keys, counts

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count of each pair, which must be one of the index's keys."""
        out, shard = np.zeros(len(keys), np.int64), shard_of(keys, self.shards)
        for s in np.unique(shard):
            own, stored, counts = self.parts[s]
            some = np.flatnonzero(shard == s)
            at = own.index(keys[some])
            if (stored[at] != keys[some]).any():
                raise ValueError("a pair that the first pass didn't count")
            out[some] = counts[at]
        return out


_aligners: dict[tuple[str, bytes], Aligner] = {}


def _aligner(content: tuple[str, bytes]) -> Aligner:
    return _aligners.get(content) or _aligners.setdefault(content, Aligner(*content))


def _counted(content):
    """A task's pairs and how many of its documents hold each, in one or more parts; shards come later."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, part = _aligner(content.value), TaskContext.get().partitionId()
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([n for _, n in found]), len(keys)).astype(np.int64)

        def out() -> pa.RecordBatch:
            keys, counts = merged()
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), part, np.int32)), pa.array(keys), pa.array(counts)], ["part", "key", "n"])

        for batch in batches:
            for a, b in slices(batch.column(0)):
                found.append(own.texts(batch.column(0).slice(a, b - a)).pairs())
                if sum(len(x) for x, _ in found) > 2 * HELD_PAIRS:
                    found[:] = [merged()]
                    if len(found[0][0]) > HELD_PAIRS:
                        yield out()
                        found.clear()
        if found:
            yield out()

    return run


def _shard_column(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = shard_of(batch.column("key").to_numpy(), shards)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard)], [*batch.schema.names, "shard"])

    return run


def _hashed(table: pa.Table) -> pa.Table:
    """A shard's hash, and its keys by their index."""
    keys = table.column("key").to_numpy()
    own = PerfectHash(keys)
    rounds = [(words.tobytes(), ranks.tobytes()) for words, ranks in own.rounds]
    ordered = np.empty_like(keys)
    ordered[own.index(keys)] = keys
    kinds = pa.list_(pa.struct([("words", pa.binary()), ("ranks", pa.binary())]))
    return pa.table({"shard": table.column("shard").slice(0, 1), "rounds": pa.array([[{"words": w, "ranks": r} for w, r in rounds]], kinds), "keys": pa.array([ordered.tobytes()], pa.binary())})


def _rounds(cell: list[dict]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(x["words"], U), np.frombuffer(x["ranks"], np.int64)) for x in cell]


def _dense(counts: pa.Table, hashes: pa.Table) -> pa.Table:
    """The vector of a shard's counts in some tasks."""
    own = PerfectHash(np.empty(0, np.int64))
    own.rounds = _rounds(hashes.column("rounds")[0].as_py())
    keys = np.frombuffer(hashes.column("keys")[0].as_py(), np.int64)
    at = own.index(counts.column("key").to_numpy())
    vector = np.bincount(at, counts.column("n").to_numpy(), len(keys)).astype(np.int64)
    return pa.table({"shard": hashes.column("shard"), "chunk": hashes.column("chunk"), "vector": pa.array([vector.tobytes()], pa.binary())})


def _summed(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("vector"))
    return pa.table({"shard": table.column("shard").slice(0, 1), "chunk": table.column("chunk").slice(0, 1), "vector": pa.array([total.tobytes()], pa.binary())})


def _spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The index as rows of pair and count."""
    for batch in batches:
        for keys, vector in zip(batch.column("keys"), batch.column("vector"), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x.as_py(), np.int64)) for x in (keys, vector)], ["key", "n"])


def pair_index(texts: DataFrame, content, shard_pairs: int = SHARD_PAIRS, fan_in: int = FAN_IN) -> tuple[DataFrame, int, int]:
    """(shard, rounds, keys, vector) of each shard, the number of shards and the number of distinct pairs in ``texts`` (text)."""
    found = cut(texts.mapInArrow(_counted(content), "part int, key long, n long"))
    distinct = cut(found.select("key").distinct())
    pairs = distinct.count()
    shards = max(1, -(-pairs // shard_pairs))
    hashes = cut(distinct.mapInArrow(_shard_column(shards), "key long, shard int").groupBy("shard").applyInArrow(_hashed, "shard int, rounds array<struct<words: binary, ranks: binary>>, keys binary"))
    counts = found.mapInArrow(_shard_column(shards), "part int, key long, n long, shard int").withColumn("chunk", F.floor(F.col("part") / fan_in).cast("int"))
    chunks = cut(counts.select("shard", "chunk").distinct().join(hashes, "shard").select("shard", "chunk", "rounds", "keys"))
    vectors = cut(counts.groupBy("shard", "chunk").cogroup(chunks.groupBy("shard", "chunk")).applyInArrow(_dense, "shard int, chunk int, vector binary"))
    most = vectors.agg(F.max("chunk")).first()[0] or 0
    while most:
        most //= fan_in
        vectors = vectors.withColumn("chunk", F.floor(F.col("chunk") / fan_in).cast("int")).groupBy("shard", "chunk").applyInArrow(_summed, "shard int, chunk int, vector binary")
    return cut(hashes.join(vectors.select("shard", "vector"), "shard")), shards, pairs


def _looked_up(content, index):
    """Each document's facts; with an index the sums over its links, without one the links."""
    kinds = pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _aligner(content.value)
        for batch in batches:
            for a, b in slices(batch.column("text")):
                found = own.texts(batch.column("text").slice(a, b - a))
                n, columns = b - a, [batch.column("doc_id").slice(a, b - a), *[pa.array(x) for x in found.sums.T]]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
                if index is not None:
                    known = index.value
                    keys, place = np.unique(found.key, return_inverse=True)
                    counts = known.counts(keys)
                    best = counts == known.best[keys >> B_BITS]
                    columns += [pa.array(totals(found.doc, found.times * x[place], n)) for x in (best, counts)]
                    names += ["n_best", "count_sum"]
                else:
                    bounds = np.searchsorted(found.doc, np.arange(n + 1)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays([pa.array(found.key), pa.array(found.times)], ["key", "times"])).cast(kinds))
                    names.append("links")
                columns.append(pa.array([sha256(x).hexdigest() if x else "" for x in found.shown], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, [*names, "groups_sha256"])

    return run


FACTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long"


def aligned(docs: DataFrame, a_path: str = A_VOCABULARY, b_path: str = B_VOCABULARY, shard_pairs: int = SHARD_PAIRS, fan_in: int = FAN_IN, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair is held by as many documents as any pair of
    their first id is, count_sum adds up the links' numbers of documents. Null and empty
    texts, and texts that a side's tokens don't spell, have zeros and ''. Strings of
    special tokens are plain text. Repeated rows count as documents of their own; an
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    python_ready(spark)
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        content = spark.sparkContext.broadcast((a.read(), b.read()))  # vocabularies, whose size the data don't change
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    index, shards, pairs = pair_index(texts.select("text"), content, shard_pairs, fan_in)
    counts = index.select("keys", "vector").mapInArrow(_spread, "key long, n long")
    best = counts.groupBy(F.shiftright("key", B_BITS).alias("a")).agg(F.max("n").alias("best"))  # a row per id of the first vocabulary at most
    if pairs * PAIR_BYTES <= broadcast_bytes:
        rows, tops = index.toArrow().to_pylist(), best.toArrow()
        ids = tops.column("a").to_numpy()
        most = np.zeros(ids.max(initial=0) + 1, np.int64)
        most[ids] = tops.column("best").to_numpy()
        parts = {r["shard"]: (_rounds(r["rounds"]), np.frombuffer(r["keys"], np.int64), np.frombuffer(r["vector"], np.int64)) for r in rows}
        sent = spark.sparkContext.broadcast(Index(shards, parts, most))
        return texts.mapInArrow(_looked_up(content, sent), f"{FACTS}, n_best long, count_sum long, groups_sha256 string")
    found = cut(texts.mapInArrow(_looked_up(content, None), f"{FACTS}, links array<struct<key: long, times: long>>, groups_sha256 string").withColumn("row", F.monotonically_increasing_id()))
    known = cut(counts.withColumn("a", F.shiftright("key", B_BITS)).join(F.broadcast(best), "a").select("key", "n", (F.col("n") == F.col("best")).alias("top")))
    links = cut(found.select("row", F.inline("links"))).join(known, "key")
    sums = links.groupBy("row").agg(F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.join(sums, "row", "left").select(*[x.split()[0] for x in FACTS.split(", ")], zero("n_best"), zero("count_sum"), "groups_sha256")
