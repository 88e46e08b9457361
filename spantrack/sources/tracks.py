"""Tracks as tables that are kept: bucketed for merging, by contig for looking up regions, and line by line as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spantrack.operators.ordering import numbered_in_files
from spantrack.operators.signal import region_max
from spantrack.operators.small import SMALL_ROWS

#: What two tracks are merged by, and regions up to which their bounds are given to the scan.
KEYS, STATED_REGIONS = ("pair", "chrom", "bin_start"), 200


def save_bucketed(track: DataFrame, table: str, path: str, buckets: int | None = None, keys: tuple[str, ...] = KEYS) -> None:
    """``track`` as an external table with a file per bucket of ``keys``; tables of as many buckets merge without moving rows."""
    n = buckets or int(track.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    track.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def save_by_contig(track: DataFrame, path: str, by: str = "sample") -> None:
    """``track`` as Parquet with a folder per contig, its files in order of place, so that row groups span short stretches."""
    n = int(track.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ("chrom", "bin_start", by)
    track.repartitionByRange(n, *order).sortWithinPartitions(*order).write.partitionBy("chrom").parquet(path)


def stored_region_max(spark: SparkSession, path: str, regions: DataFrame) -> DataFrame:
    """(region, sample, max_signal) over a track saved by contig; regions (region, chrom, start, end).

    The regions' contigs, few by their nature, pick the folders; the bounds of up to
    STATED_REGIONS regions pick row groups as well.
    """
    track = spark.read.parquet(path)
    chroms = [r.chrom for r in regions.select("chrom").distinct().limit(SMALL_ROWS + 1).collect()]
    if len(chroms) <= SMALL_ROWS:
        track = track.where(F.col("chrom").isin(*sorted(x for x in chroms if x is not None)))
    found = regions.select("region", "chrom", "start", "end").limit(STATED_REGIONS + 1).collect()
    if len(found) <= STATED_REGIONS:
        track = track.where(_within(found))
    return region_max(track, regions)


def _within(found: list) -> Column:
    """Rows that overlap a region, by contig the union of what its regions span."""
    out = F.lit(False)
    for chrom in sorted({r.chrom for r in found}):
        own = [r for r in found if r.chrom == chrom]
        spans = F.lit(False)
        for r in own:
            spans = spans | ((F.col("bin_start") < r.end) & (F.col("bin_end") >= r.start))
        out = out | ((F.col("chrom") == chrom) & spans)
    return out


def read_lines(spark: SparkSession, path: str, by: str = "sample") -> DataFrame:
    """(by, line_no, line) of a track written as text: lines are numbered from 1 through the files of a folder ``by=name``, in the order of the files' names."""
    lines = spark.read.text(path).select(F.col(by).cast("string").alias(by), F.col("value").alias("line"), F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"))
    return numbered_in_files(lines, [by], "line_no", 1).select(by, "line_no", "line")


def file_ranges(spark: SparkSession, path: str, by: str = "sample") -> DataFrame:
    """(by, file, lines, first, last): the least and greatest place of each file of a bedGraph, as contig number, contig and start; unknown contigs have number 99."""
    from spantrack.functions.scalars import roman_number

    field = F.split("value", "\t")
    place = F.struct(F.coalesce(roman_number(field[0]), F.lit(99)).alias("number"), field[0].alias("chrom"), field[1].cast("long").alias("bin_start"))
    rows = spark.read.text(path).select(F.col(by).cast("string").alias(by), F.col("_metadata.file_name").alias("file"), place.alias("place"))
    return rows.groupBy(by, "file").agg(F.count("*").alias("lines"), F.min("place").alias("first"), F.max("place").alias("last"))
