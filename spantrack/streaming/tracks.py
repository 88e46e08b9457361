"""Tracks over alignments that keep arriving.

Unadjusted and length-weighted signals are sums over fragments, so that each batch
adds its own bins to a table of partial sums; normalising divides by the fragments
counted so far, when the track is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spantrack.operators.fragments import fragments
from spantrack.operators.signal import bin_signal


def start(alignments: DataFrame, contigs: DataFrame, path: str, checkpoint: str, width: int = 10, method: str = "frag", until_done: bool = False) -> StreamingQuery:
    """Write the bins of each batch of a stream of alignments under ``path``; a batch that is run again replaces itself. With ``until_done`` the stream ends once it has taken what is there."""
    if method == "norm":
        raise ValueError("a stream keeps sums: write unadj or frag and read with normalised=True")

    def add(batch: DataFrame, number: int) -> None:
        frags = fragments(batch, contigs).select("sample", "chrom", "frg_start", "frg_end", "frg_len").persist()  # what bins are made of, without names
        bin_signal(frags, width, method).write.mode("overwrite").parquet(f"{path}/bins/batch={number}")
        frags.groupBy("sample").agg(F.count("*").alias("frg_tot")).write.mode("overwrite").parquet(f"{path}/totals/batch={number}")
        frags.unpersist()

    writer = alignments.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if until_done else writer).start()


def track(spark: SparkSession, path: str, normalised: bool = False) -> DataFrame:
    """The track of all batches so far."""
    sums = spark.read.parquet(f"{path}/bins").groupBy("sample", "chrom", "bin_start", "bin_end").agg(F.sum("signal").alias("signal"))
    if not normalised:
        return sums
    totals = spark.read.parquet(f"{path}/totals").groupBy("sample").agg(F.sum("frg_tot").alias("frg_tot"))
    return sums.join(totals, "sample").withColumn("signal", F.col("signal") / F.col("frg_tot")).drop("frg_tot")
