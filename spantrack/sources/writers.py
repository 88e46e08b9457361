"""Writers of fragments, tracks and sample tables as text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.functions.scalars import fixed, genome_order
from spantrack.operators.factors import ALPHA_COLUMNS, SPIKE_COLUMNS
from spantrack.operators.ratio import is_finite


def _text(df: DataFrame, path: str, by: list[str], gzip: bool, header: bool = False) -> None:
    writer = df.write.mode("errorifexists").option("header", header)
    writer = writer.partitionBy(*by) if by else writer
    writer.csv(path, sep="\t", compression="gzip" if gzip else "none", nullValue="", quote="")


def write_sam(alignments: DataFrame, contigs: DataFrame, path: str, gzip: bool = False) -> None:
    """Alignments as SAM text in one folder per sample, its part files without headers but for one file of contig lines.

    The aligned part is written as one match; sequences and qualities are left out.
    """
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("*"))
    cigar = F.when(F.col("aln_len") > 0, F.concat(F.col("aln_len").cast("string"), F.lit("M"))).otherwise("*")
    mate = F.when(F.col("mate_chrom") == F.col("chrom"), "=").otherwise(none("mate_chrom"))
    fields = ["qname", F.col("flag").cast("string"), none("chrom"), (F.col("pos") + 1).cast("string"), F.coalesce(F.col("mapq").cast("string"), F.lit("0")), cigar, mate, F.lit("0"), F.col("tlen").cast("string"), F.lit("*"), F.lit("*")]
    header = contigs.select(F.concat_ws("\t", F.lit("@SQ"), F.concat(F.lit("SN:"), "chrom"), F.concat(F.lit("LN:"), F.col("chrom_len").cast("string"))).alias("value"))
    compression = "gzip" if gzip else "none"
    header.coalesce(1).write.text(f"{path}/sample=header", compression=compression)
    alignments.select("sample", F.concat_ws("\t", *fields).alias("value")).write.mode("append").partitionBy("sample").text(path, compression=compression)


def write_bedgraph(track: DataFrame, path: str, value: str = "signal", by: str = "sample", digits: int = 24, gzip: bool = True, outer: tuple[str, ...] = ()) -> None:
    """One folder per ``by`` (within folders of ``outer``), its rows in genome order over its part files, which are numbered in that order; values with ``digits`` decimals."""
    ordered = track.orderBy(*outer, by, *genome_order(F.col("chrom"), F.col("bin_start")))
    _text(ordered.select(*outer, by, "chrom", "bin_start", "bin_end", fixed(F.col(value), digits).alias(value)), path, [*outer, by], gzip)


def write_fragments(frags: DataFrame, path: str, gzip: bool = True) -> None:
    """Coordinates: contig, start, end, length."""
    _text(frags.select("sample", "chrom", "frg_start", "frg_end", "frg_len"), path, ["sample"], gzip)


def write_ratio(track: DataFrame, path: str, companion: bool = True, digits: int = 24, gzip: bool = True) -> None:
    """A ratio track under ``path``/file=all, and under ``path``/file=companion its rows for browsers, without -inf and NaN.

    A row is named for each file that it goes to, so that the track is made and sorted once.
    """
    files = F.array(F.lit("all"), *([F.when(is_finite(F.col("value")), "companion")] if companion else []))
    write_bedgraph(track.withColumn("file", F.explode(F.array_compact(files))), path, "value", "pair", digits, gzip, ("file",))


def write_sample_table(table: DataFrame, path: str, mode: str) -> None:
    """A scaling-factor table with the header of its mode, alpha or spike; a row per sample, in one file."""
    columns = {"alpha": ALPHA_COLUMNS, "spike": SPIKE_COLUMNS}[mode]
    _text(table.select(*columns).orderBy(*columns).coalesce(1), path, [], False, True)
