"""Where what is written for reading back goes, and tables that are made once."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``, or on a local master a new one of our own.

    On a cluster without that setting it raises: a folder of one machine would lose data.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="spark-")
    return shared


def kept(table: DataFrame) -> DataFrame:
    """``table`` written to the shared folder and read from there: it is made once, and a lost executor doesn't take it along."""
    context = table.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(table.sparkSession))
    return table.checkpoint(eager=True)
