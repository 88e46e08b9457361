"""Places of rows in a global order: sampled ranges, and sums over their partitions.

Rows are dealt by range over many tasks, with a salt as the last key, so that neither a
hot key nor keys that begin alike fill one of them. A row's number within its partition
comes from its place there, and one row per partition and group says how many rows of
the group stand before it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spantrack.operators.small import local
from spantrack.sources.folders import kept


def _base(lined: DataFrame, by: list[str], weight: Column) -> DataFrame:
    """(by as _by0, ..., _part, _base, _first): for each partition's rows of a group the weight of all before them, and the first one's place."""
    part = F.shiftright("_at", 33).alias("_part")
    runs = lined.groupBy(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], part).agg(F.min("_at").alias("_first"), F.sum(weight).alias("_n"))
    before = Window.partitionBy(*[f"_by{i}" for i in range(len(by))]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition at most
    return local(runs.withColumn("_base", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"))


def _lined(table: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """``table`` in order by ranges, with _at, a row's partition and place there."""
    keys = [*[F.col(c).asc() for c in by], *order]
    n = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = table.withColumn("_salt", F.monotonically_increasing_id())
    lined = salted.repartitionByRange(n, *keys, F.col("_salt").asc()).sortWithinPartitions(*keys, F.col("_salt").asc()).drop("_salt")
    return kept(lined.withColumn("_at", F.monotonically_increasing_id()))


def _joined(lined: DataFrame, by: list[str], bases: DataFrame) -> DataFrame:
    same = F.shiftright("_at", 33) == F.col("_part")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
    return lined.join(bases, same)


def numbered(table: DataFrame, by: list[str], order: list[Column], name: str) -> DataFrame:
    """``table`` with ``name``: each row's number, from 1, among the rows of equal ``by`` in ``order``; of equal rows in the order they are read."""
    lined = _lined(table, by, order)
    placed = _joined(lined, by, _base(lined, by, F.lit(1)))
    return placed.withColumn(name, (F.col("_base") + F.col("_at") - F.col("_first") + 1).cast("long")).select(*table.columns, name)


def numbered_in_files(rows: DataFrame, by: list[str], name: str, start: int) -> DataFrame:
    """``rows`` of files with ``name``: each row's number, from ``start``, among the rows of equal ``by`` through the files in the order of their names.

    ``rows`` have _file and _block, where their part of the file begins, and _at, rising
    along each part. A file's part in one task is a run of rows; the runs' lengths are
    summed up along the files' names and places, a row per run.
    """
    run = [*by, "_file", "_block"]
    before = Window.partitionBy(*by).orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy(*run).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    bases = local(runs.select(*[F.col(c).alias(f"_{c}_of") for c in run], "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}_of")) for c in run]
    columns = [c for c in rows.columns if c not in ("_file", "_block", "_at")]
    return rows.join(bases, same).select(*columns, (F.col("_before") + F.col("_at") - F.col("_first") + start).alias(name))


def ranked(table: DataFrame, by: list[str], keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``table`` with ``name``: as ``numbered``, but rows of equal ``keys`` share the number of their first; ``order`` sorts by the keys.

    Only the distinct keys are put in order, each with its number of rows, so that a key
    found very often is one row there; Spark can split it where the rows get their rank.
    """
    every = [*by, *keys]
    counts = table.groupBy(*every).agg(F.count("*").alias("_rows"))
    lined = _lined(counts, by, order)
    placed = _joined(lined, by, _base(lined, by, F.col("_rows")))
    within = Window.partitionBy("_part", *by).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    ranks = kept(placed.select(*[F.col(c).alias(f"_own{i}") for i, c in enumerate(every)], (F.col("_base") + F.coalesce(F.sum("_rows").over(within), F.lit(0)) + 1).cast("long").alias(name)))
    same = F.lit(True)
    for i, c in enumerate(every):
        same = same & F.col(c).eqNullSafe(F.col(f"_own{i}"))
    return table.join(ranks, same).select(*table.columns, name)
