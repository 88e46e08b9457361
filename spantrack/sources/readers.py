"""Readers of alignment, fragment, track and table files, all by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spantrack.operators.ordering import numbered_in_files
from spantrack.sources.folders import kept
from spantrack.sources.headers import read_headers

# Header names of measurement tables under their standard names.
ALIASES = {
    "vol_in": ("volume_in", "vol_in", "v_in", "input sample volume"),
    "vol_all": ("volume_all", "volume_ip", "vol_all", "vol_ip", "v_all", "v_ip", "total volume before removal of input"),
    "mass_in": ("mass_in", "m_in", "input DNA mass (ng)", "input DNA mass"),
    "mass_ip": ("mass_ip", "m_ip", "IP DNA mass (ng)", "IP DNA mass"),
    "conc_in": ("conc_in", "con_in", "concentration_in", "input DNA concentration (ng/µL)", "input DNA concentration"),
    "conc_ip": ("conc_ip", "con_ip", "concentration_ip", "IP DNA concentration (ng/µL)", "IP DNA concentration"),
    "len_in": ("length_in", "len_in", "input average fragment length (from TapeStation)", "input average fragment length (from Bioanalyzer)", "input average fragment length"),
    "len_ip": ("length_ip", "len_ip", "IP average fragment length (from TapeStation)", "IP average fragment length (from Bioanalyzer)", "IP average fragment length"),
    "dep_in": ("depth_in", "dep_in", "input sequencing depth", "input depth"),
    "dep_ip": ("depth_ip", "dep_ip", "IP sequencing depth", "IP depth"),
}


def sample_of_file(field: str = "sample") -> F.Column:
    """The name in a folder ``field=name`` of the file's path, as the writers lay files out, else the file's name without folder and endings."""
    path = F.input_file_name()
    folder = F.url_decode(F.regexp_extract(path, rf"/{field}=([^/]+)/", 1))
    return F.when(folder != "", folder).otherwise(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(sam|bed|bedgraph|bg|txt|tsv)?(\.gz)?$", ""))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text: one row per record, the sample by file name; header lines are left out."""
    fields = F.split(F.col("value"), "\t")
    at = lambda i: F.get(fields, F.lit(i))
    whole = lambda i: at(i).try_cast("long")
    # aligned bases on the reference: M, D, N, = and X of the CIGAR; on the read: M, I, = and X
    span = lambda kinds: F.aggregate(F.regexp_extract_all(at(5), F.lit(f"([0-9]+)[{kinds}]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))
    pos, chrom = whole(3) - 1, F.when(at(2) != "*", at(2))
    lines = spark.read.text(path).withColumn("sample", sample_of_file()).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    return lines.select(
        "sample", at(0).alias("qname"), whole(1).cast("int").alias("flag"), chrom.alias("chrom"), pos.alias("pos"), F.when(at(5) != "*", pos + span("MDN=X")).alias("ref_end"),
        F.when(at(6) == "=", chrom).when(at(6) != "*", at(6)).alias("mate_chrom"), whole(8).cast("int").alias("tlen"), span("MI=X").cast("int").alias("aln_len"), whole(4).cast("int").alias("mapq"),
    )


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, chrom_len) of the header lines of SAM text, each contig once; of a file no more than its header is read."""
    lines = read_headers(spark, path).where(F.col("line").startswith("@SQ"))
    return lines.select(F.regexp_extract("line", r"\tSN:([^\t]+)", 1).alias("chrom"), F.regexp_extract("line", r"\tLN:([0-9]+)", 1).try_cast("long").alias("chrom_len")).distinct()


def read_marked(spark: SparkSession, path: str) -> DataFrame:
    """(sample) of SAM text whose header says that duplicates have been marked; of a file no more than its header is read."""
    return read_headers(spark, path).where(F.col("line").rlike("^@PG.*CL:samtools markdup")).select("sample").distinct()


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """Fragments of BED text, plain or gzip, the sample by file name."""
    raw = spark.read.schema("chrom string, frg_start long, frg_end long, frg_len int").csv(path, sep="\t", comment="#")
    return raw.select(sample_of_file().alias("sample"), "chrom", "frg_start", "frg_end", "frg_len")


def read_bedgraph(spark: SparkSession, path: str, value: str = "signal", by: str = "sample") -> DataFrame:
    """A track of bedGraph text, plain or gzip, columns apart by any white space; track and browser lines are left out."""
    fields = F.split(F.trim("value"), r"\s+")
    at = lambda i: F.get(fields, F.lit(i))
    number = F.when(F.lower(at(3)) == "nan", float("nan")).when(F.lower(at(3)).isin("-inf", "-infinity"), float("-inf")).when(F.lower(at(3)).isin("inf", "infinity"), float("inf")).otherwise(at(3).try_cast("double"))
    lines = spark.read.text(path).withColumn(by, sample_of_file(by)).where((F.trim("value") != "") & ~F.col("value").rlike("^(track|browser|#)"))
    return lines.select(by, at(0).alias("chrom"), at(1).try_cast("long").alias("bin_start"), at(2).try_cast("long").alias("bin_end"), number.alias(value))


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """A measurement table under standard column names; the ending gives the delimiter.

    row_no numbers the rows from 0, without gaps, in the order of the file, or of a
    folder's files by name. The table is kept, as a file read anew may fall into other parts.
    """
    ending = path.lower().removesuffix(".gz").rpartition(".")[2]
    if ending not in ("csv", "tsv", "txt"):
        raise ValueError(f"not a .csv, .tsv or .txt file: {path}")
    raw = spark.read.option("header", True).option("ignoreTrailingWhiteSpace", True).csv(path, sep="," if ending == "csv" else "\t")
    known = {alias.lower(): name for name, aliases in ALIASES.items() for alias in aliases}
    clean = [known.get(c.strip().lower(), c.strip()) for c in raw.columns]
    placed = raw.select("*", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()).toDF(*clean, "_file", "_block", "_at")
    return numbered_in_files(kept(placed), [], "row_no", 0)


def read_manifest(spark: SparkSession, path: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(line_no, run_accession, urls, custom_name) of download manifests, whatever the order of their columns.

    A manifest is read as one row and its lines are numbered there, the header as 1;
    each file has its own header. One without run_accession or URLs is an error.
    ``keep`` names columns of folders ``column=value`` to keep in front.
    """
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(*keep, F.posexplode(F.split(F.regexp_replace("value", "\r", ""), "\n")).alias("at", "line"), F.split(F.regexp_replace(F.substring_index("value", "\n", 1), "\r", ""), "\t").alias("header"))
    fields = F.split("line", "\t")
    place = lambda name: F.array_position("header", name)
    field = lambda at: F.when(at > 0, F.get(fields, (at - 1).cast("int")))
    urls = F.greatest(place("fastq_ftp"), place("fastq_https"))
    known = F.when((urls > 0) & (place("run_accession") > 0), field(place("run_accession"))).otherwise(F.raise_error("a manifest has run_accession and fastq_ftp or fastq_https").cast("string"))
    named = rows.where((F.col("at") > 0) & (F.trim("line") != ""))
    return named.select(*keep, (F.col("at") + 1).cast("long").alias("line_no"), known.alias("run_accession"), field(urls).alias("urls"), F.trim(field(place("custom_name"))).alias("custom_name"))
