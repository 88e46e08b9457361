"""A Merkle manifest of documents, with a witness for each, by incremental appends.

Each group's leaves are put in order and numbered. A task then appends its leaves, one
after the other, to a forest of open aligned subtrees: two siblings merge as soon as
both are whole, and the witnesses of all leaves below, so far partial, gain the other
side's hash. A subtree of 2^12 leaves is a block; it leaves the forest with its
members' witnesses, so that a task holds few of them. What is left open at the ends of
tasks, and the blocks' roots, are appends of the next tier, whose blocks hold 2^24
leaves, and so on; the tier in which a group is one block closes it, by hashing lone
nodes on their own. A leaf's witness is the concatenation along the tiers. The groups'
roots are leaves of one more such tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spantrack.llm._spark import FEW_IDS, cut, partitions, python_ready

#: Levels of a block, and leaves that a task appends, about.
BLOCK_LEVELS, TASK_ROWS = 12, 500_000
#: Every so many documents, by checksum, ``tampered`` changes one.
TAMPERED = 7


def field(x: Column) -> Column:
    """A value as the leaf's hash takes it: its size in bytes, a colon and itself, or a dash for null."""
    text = x.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(docs: DataFrame, n_chars: Column | None = None) -> Column:
    """The hash of a document's row, with another ``n_chars`` where one is given."""
    count = F.col("n_chars") if n_chars is None else n_chars
    return F.sha2(F.concat(*[field(x) for x in (F.col("doc_id").cast("long"), F.col("source"), F.col("lang"), count.cast("long"), F.col("text"))]), 256)


def joined(*hashes: bytes) -> bytes:
    """The hash of hashes, which go in as hexadecimal text."""
    return sha256("".join([x.hex() for x in hashes]).encode()).digest()


class Forest:
    """Whole aligned subtrees in order of place, each with the witnesses of the nodes that were appended below it."""

    def __init__(self, levels: int):
        self.levels, self.trees, self.end = levels, [], None

    def append(self, level: int, index: int, value: bytes, row: int) -> Iterator[tuple]:
        """Append a node that stands right after the last one; yields subtrees that have become a block."""
        self.trees.append((level, index, value, [(row, bytearray())]))
        self.end = index + 1 << level
        while len(self.trees) > 1 and self._siblings():
            self._merge()
        if self.trees[-1][0] == self.levels:
            yield self.trees.pop()

    def _siblings(self) -> bool:
        (a, i, *_), (b, j, *_) = self.trees[-2:]
        return a == b and j == i ^ 1 and j & 1

    def _merge(self) -> None:
        level, index, right, below = self.trees.pop()
        _, _, left, others = self.trees.pop()
        for _, witness in others:
            witness += right
        for _, witness in below:
            witness += left
        self.trees.append((level + 1, index >> 1, joined(left, right), others + below))

    def close(self, n: int) -> None:
        """Hash the last subtrees up to one root of ``n`` leaves, lone nodes on their own."""
        while self.trees[-1][0] < (n - 1).bit_length():
            if len(self.trees) > 1 and self._siblings():
                self._merge()
            else:
                level, index, value, below = self.trees.pop()
                self.trees.append((level + 1, index >> 1, joined(value), below))


_OUT = "row long, witness binary, root_level int, root_index long, root binary"


def _emitted(trees: list[tuple]) -> dict[str, list]:
    """Columns of the nodes below some subtrees; the root's hash stands at its first node."""
    out: dict[str, list] = {x.split()[0]: [] for x in _OUT.split(", ")}
    for level, index, value, below in trees:
        for i, (row, witness) in enumerate(below):
            for column, x in zip(out.values(), (row, bytes(witness), level, index, value if i == 0 else None), strict=True):
                column.append(x)
    return out


def _table(columns: dict[str, list]) -> pa.Table:
    kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary())
    return pa.table([pa.array(x, t) for x, t in zip(columns.values(), kinds, strict=True)], names=list(columns))


def _stream(levels: int):
    """Append the rows of a partition, sorted by group and place, and give each its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, own = Forest(levels), None
        waiting: dict[int, dict] = {}

        def out(trees: list[tuple]) -> Iterator[pa.RecordBatch]:
            if trees:
                found = _table(_emitted(trees))
                rows = [waiting.pop(x) for x in found.column("row").to_pylist()]
                kept = pa.Table.from_pylist(rows, schema)
                yield from pa.table([*kept.columns, *found.drop_columns(["row"]).columns], names=[*kept.column_names, *found.column_names[1:]]).combine_chunks().to_batches()

        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                if (row["g"], row["pos"]) != (own, forest.end):  # another group
                    yield from out(forest.trees)
                    forest, own = Forest(levels), row["g"]
                waiting[row["row"]] = row
                yield from out(list(forest.append(0, row["pos"], bytes.fromhex(row["h"]), row["row"])))
        yield from out(forest.trees)

    return run


def _block(levels: int):
    """Append the nodes of a block of a higher tier, and close the tree where the block is the whole group."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["index"] << r["level"])
        forest, done = Forest(levels), []
        for i, r in enumerate(rows):
            done += forest.append(r["level"], r["index"], r["h"], i)
        if rows[0]["n"] <= 1 << levels:
            forest.trees = done or forest.trees
            forest.close(rows[0]["n"])
            done = []
        found = _emitted(done + forest.trees)
        of = [rows[i] for i in found["row"]]
        own = {c: [r[c] for r in of] for c in ("g", "n", "level", "index")}
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.int64())
        return pa.table([*[pa.array(x, t) for x, t in zip(own.values(), kinds, strict=True)], *_table(found).drop_columns(["row"]).columns], names=[*own, *list(found)[1:]])

    return run


def _few(df: DataFrame) -> DataFrame:
    """To be broadcast where it has few rows, counted first."""
    return F.broadcast(df) if df.count() <= FEW_IDS else df


def placed(rows: DataFrame, order: list[Column], task_rows: int = TASK_ROWS) -> DataFrame:
    """``rows`` (with group g) sorted by g and ``order`` within partitions, with pos, the place in the group, n, the group's rows, and row, unique in its partition.

    Rows equal in all of ``order`` stand in the order in which they are read, so that a
    row found very often is spread over many partitions.
    """
    rows = cut(rows.withColumn("_salt", F.monotonically_increasing_id()))
    parts = max(partitions(rows.sparkSession), -(-rows.count() // task_rows))
    keys = [F.col("g").asc(), *order, F.col("_salt").asc()]
    lined = cut(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_salt").withColumn("row", F.monotonically_increasing_id()))
    part = F.shiftright("row", 33).alias("_part")
    runs = lined.groupBy("g", part).agg(F.min("row").alias("_first"), F.count("*").alias("_n"))
    group = Window.partitionBy("g")  # a row per partition at most
    before = F.coalesce(F.sum("_n").over(group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = cut(runs.select(F.col("g").alias("_g"), "_part", (before - F.col("_first")).alias("_base"), F.sum("_n").over(group).alias("n")))
    few = bases.count() <= FEW_IDS
    out = lined.withColumn("_own", part).join(F.broadcast(bases) if few else bases, (F.col("g") == F.col("_g")) & (F.col("_own") == F.col("_part")))
    out = out.withColumn("pos", F.col("row") + F.col("_base")).drop("_g", "_part", "_own", "_base")
    return out if few else out.repartitionByRange(parts, "g", "pos").sortWithinPartitions("g", "pos")


def witnessed(rows: DataFrame, order: list[Column], levels: int = BLOCK_LEVELS, task_rows: int = TASK_ROWS) -> DataFrame:
    """``rows`` (g, h: a hexadecimal hash, and others) with pos, n, witness and top, the root of g.

    witness holds the siblings' digests from the leaf upwards, 32 bytes each; a level
    at which a node has no sibling adds none.
    """
    python_ready(rows.sparkSession)
    lined = placed(rows, order, task_rows)
    schema = ", ".join(f"{c} {t}" for c, t in lined.dtypes) + ", " + _OUT.partition(", ")[2]
    leaves = cut(lined.mapInArrow(_stream(levels), schema))
    most = leaves.agg(F.max("n")).first()[0] or 1
    out, tiers, height = "g string, n long, level int, index long, " + _OUT.partition(", ")[2], [], levels
    last = leaves
    while not tiers or 1 << height < most:
        height += levels
        nodes = last.where("root IS NOT NULL").select("g", "n", F.col("root_level").alias("level"), F.col("root_index").alias("index"), F.col("root").alias("h"))
        block = F.expr(f"shiftright(shiftleft(index, level), {height})") if height < 63 else F.lit(0)
        last = cut(nodes.groupBy("g", block).applyInArrow(_block(height), out))
        tiers.append(last)
    roots = last.where("root IS NOT NULL").select("g", F.col("root").alias("top"))
    keys = [F.col("_g").alias("_g"), F.col("level").alias("_level"), F.col("index").alias("_index")]
    above = last.withColumnRenamed("g", "_g").select(*keys, F.col("witness").alias("_more"))
    same = (F.col("g") == F.col("_g")) & (F.col("root_level") == F.col("_level")) & (F.col("root_index") == F.col("_index"))
    for tier in reversed(tiers[:-1]):
        both = tier.join(_few(cut(above)), same).select(F.col("g").alias("_g"), F.col("level").alias("_level"), F.col("index").alias("_index"), F.concat("witness", "_more").alias("_more"))
        above = both
    tops = _few(cut(roots.withColumnRenamed("g", "_g2")))
    full = leaves.join(_few(cut(above)), same).join(tops, F.col("g") == F.col("_g2"))
    return full.select(*rows.columns, "pos", "n", F.concat("witness", "_more").alias("witness"), F.lower(F.hex("top")).alias("top"))


def fold(value: bytes, pos: int, n: int, witness: bytes) -> bytes:
    """The root over a node at ``pos`` of ``n``, from its siblings."""
    at = 0
    while n > 1:
        if pos ^ 1 < n:
            other, at = witness[at : at + 32], at + 32
            value = joined(other, value) if pos & 1 else joined(value, other)
        else:
            value = joined(value)
        pos, n = pos >> 1, n + 1 >> 1
    return value


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        proofs, folded = [], []
        for r in batch.select(["leaf", "changed", "pos", "n", "witness", "lang_pos", "lang_n", "lang_witness"]).to_pylist():
            both = r["witness"] + r["lang_witness"]
            proofs.append(sha256(both.hex().encode()).hexdigest())
            subroot = fold(bytes.fromhex(r["changed"] or r["leaf"]), r["pos"], r["n"], r["witness"])
            folded.append(fold(subroot, r["lang_pos"], r["lang_n"], r["lang_witness"]).hex())
        names = ["doc_id", "leaf", "subroot", "root"]
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(proofs, pa.string()), pa.array(folded, pa.string())], [*names, "proof_sha256", "folded_root"])


def tampered(n_chars: Column) -> Column:
    """``n_chars`` plus 1 where TAMPERED divides the checksum of doc_id; nulls stay."""
    return F.when(F.crc32(F.col("doc_id").cast("long").cast("string")) % TAMPERED == 0, n_chars + 1)


def manifest(docs: DataFrame, changed: Column | None = None, levels: int = BLOCK_LEVELS, task_rows: int = TASK_ROWS) -> DataFrame:
    """Per document: doc_id, leaf, subroot (of its lang), root, proof_sha256, folded_root and verified.

    ``changed`` is the n_chars that a document has when it is verified, null where it
    is as it was; by default no document has another. Leaves of a lang ascend by
    doc_id, null first, and rows of one doc_id by their hash; a null lang is a lang of
    its own and the first. Null and empty values differ. Repeated rows are leaves of
    their own; an empty table gives no rows; other columns are not read. A document
    moves as its hash only.
    """
    other = F.lit(None).cast("string") if changed is None else F.when(changed.isNotNull(), leaf(docs, changed))
    lang = F.col("lang").cast("string")
    group = F.coalesce(F.concat(F.lit("+"), lang), F.lit(""))  # sorts null first, then by bytes
    leaves = docs.select(group.alias("g"), F.col("doc_id").cast("long"), leaf(docs).alias("h"), other.alias("changed"))
    found = cut(witnessed(leaves, [F.col("doc_id").asc_nulls_first(), F.col("h").asc()], levels, task_rows))
    subroots = found.where("pos = 0").select(F.lit("").alias("g"), F.col("g").alias("lang"), F.col("top").alias("h"))
    over = witnessed(subroots, [F.col("lang").asc()], levels, task_rows)
    over = cut(over.select(F.col("lang").alias("_lang"), F.col("pos").alias("lang_pos"), F.col("n").alias("lang_n"), F.col("witness").alias("lang_witness"), F.col("top").alias("root")))
    full = found.join(_few(over), F.col("g") == F.col("_lang")).withColumns({"leaf": F.col("h"), "subroot": F.col("top")})
    wanted = full.select("doc_id", "leaf", "changed", "pos", "n", "witness", "lang_pos", "lang_n", "lang_witness", "subroot", "root")
    out = wanted.mapInArrow(_checked, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
