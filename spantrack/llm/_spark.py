"""Session helpers shared by the operators of this package."""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of an Arrow batch handed to Python, the same for all operators: texts, trees and blocks can be large.
ARROW_ROWS, ARROW_BYTES = 1000, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def python_ready(spark: SparkSession) -> None:
    """Before Python runs on executors: send them this package, and keep Arrow batches of long texts small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    path = Path(tempfile.mkdtemp(prefix="spark-")) / "spantrack_llm.zip"
    with zipfile.ZipFile(path, "w") as out:
        for file in (here.parent / "__init__.py", *sorted(here.glob("*.py"))):
            out.write(file, file.relative_to(here.parent.parent))
    context.addPyFile(str(path))
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, or on a local master a new one of our own.

    On a cluster without that setting it raises: a folder of one machine would lose data.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not (context.master or "").startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="spark-")
    return shared


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Spark drops the shuffle files of the lineage that has been cut off once the
    driver's collectors have found it unreachable; that they do so now keeps the
    disks of a long chain of cuts at the size of its largest step.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    out = df.checkpoint(eager=True)
    del df
    gc.collect()
    context._jvm.System.gc()
    return out


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a table written to the shared folder and read from there.

    Unlike a checkpoint it is made once and knows nothing of the plan it came from: what
    the optimizer inferred for that one, which grows from level to level of a loop, is
    gone. Rows may come in another order and in other partitions.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with as many underscores in front as set it apart from ``taken`` (whatever the case)."""
    used = {x.lower() for x in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


#: Numbers of 64 bits that are broadcast at most: 16 MB.
FEW_IDS = 2_000_000


def only(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """The rows of ``df`` whose ``on`` is in ``ids`` (one column of longs, checkpointed): without moving ``df`` where they are few, counted first, else by a shuffle of both."""
    return df.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, on, "left_semi")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: Sequence[Column], name: str, weight: str | None = None) -> DataFrame:
    """Add ``name``: the sum of ``weight`` (1 by default) over all rows before this one.

    Rows are sorted by range over many tasks, and only one sum per partition
    reaches the driver, so that no task holds the whole table.
    """
    n = partitions(df.sparkSession)
    parts = cut(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    value = F.col(weight) if weight else F.lit(1)
    sums = parts.groupBy("_part").agg(F.sum(value).cast("long").alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        parts.join(F.broadcast(bases), "_part")  # one row per partition
        .withColumn(name, (F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))).cast("long"))
        .drop("_part", "_base")
    )


def numbered(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: the number of a row among those of equal ``keys`` (nulls are equal), from 0, as a long.

    Only rows whose keys are found twice or more are sorted, and these by the
    partition they came in as well, so that no task holds all rows of one key.
    """
    part, zero = free_name("_part", df.columns), F.lit(0).cast("long")
    rows = cut(df.withColumn(part, F.spark_partition_id()))
    many = cut(rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]))
    n = many.count()
    if not n:
        return rows.drop(part).withColumn(name, zero)
    equal = [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)]
    known = F.broadcast(many) if n * len(keys) <= FEW_IDS else many
    some = rows.join(known, equal, "left_semi").repartition(*keys, part)  # else the windows would keep the join's partitions
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row per partition at most
    counts = some.groupBy(*keys, part).agg(F.count("*").alias("_n")).withColumn("_base", F.coalesce(F.sum("_n").over(before), zero))
    bases = cut(counts.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], F.col(part).alias("_key_part"), "_base"))
    within = F.row_number().over(Window.partitionBy(*keys, part).orderBy(F.lit(0)))
    placed = some.withColumn(name, within.cast("long") - 1).join(bases, [*equal, F.col(part) == F.col("_key_part")])
    placed = placed.withColumn(name, F.col(name) + F.col("_base")).select(*df.columns, name)
    return rows.join(known, equal, "left_anti").drop(part).withColumn(name, zero).unionByName(placed)
