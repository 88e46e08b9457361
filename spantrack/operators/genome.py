"""Genome text as tables: FASTA headers, GFF3 features, contig names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spantrack.functions.scalars import genome_order
from spantrack.operators import ordering
from spantrack.operators.small import local

# Feature kinds that carry a gene name.
GENES = ("blocked_reading_frame", "gene", "ncRNA_gene", "pseudogene", "rRNA_gene", "snRNA_gene", "snoRNA_gene", "tRNA_gene", "telomerase_RNA_gene")
# Spike-in FASTA headers and GFF3 contigs under their new names.
SPIKE_FASTA = (("chr_II_telomeric_gap", "SP_II_TG"), ("I", "SP_I"), ("II", "SP_II"), ("III", "SP_III"), ("mating_type_region", "SP_MTR"), ("mitochondrial", "SP_Mito"))
# Encoded characters of attributes and their text.
ENCODED = (("%20", " "), ("%2C", ","), ("%3B", ","), ("%28", "("), ("%29", ")"), ("&#946", "beta"), ("&#8242", " prime"), ("%", " percent"))


def main_fasta(line: Column) -> Column:
    """A header becomes its contig's name, Mito for the mitochondrion; sequence lines stay."""
    field = F.get(F.split(line, "chromosome=|location="), F.lit(1))
    name = F.when(field.contains("mitochondrion"), "Mito").otherwise(F.substring_index(F.coalesce(field, F.lit("")), "]", 1))
    return F.when(line.startswith(">"), F.concat(F.lit(">"), name)).otherwise(line)


def spike_fasta(line: Column) -> Column:
    out = line
    for old, new in SPIKE_FASTA:
        out = F.regexp_replace(out, rf"^>{old} .*$", f">{new}")
    return out


def spike_contig(name: Column) -> Column:
    """A GFF3 line or contig of the spike-in organism with its prefix; I goes before II and III, which start alike."""
    out = name
    for old, new in SPIKE_FASTA:
        out = F.regexp_replace(out, f"^{old}", new)
    return out


def before_marker(lines: DataFrame, file: str = "file", number: str = "line_no", text: str = "line") -> DataFrame:
    """Lines of each file before its first one that starts with ###."""
    ends = local(lines.where(F.col(text).startswith("###")).groupBy(file).agg(F.min(number).alias("_end")))  # a row per file
    return lines.join(ends, file, "left").where(F.col("_end").isNull() | (F.col(number) < F.col("_end"))).drop("_end")


def clean_features(features: DataFrame) -> DataFrame:
    """GFF3 features (seqid, ..., strand, ..., attributes) with plain contig names, decoded attributes and ``.`` for strand 0."""
    seqid = F.regexp_replace(F.regexp_replace("seqid", "^chr", ""), "^mt", "Mito")
    attributes = F.col("attributes")
    for old, new in ENCODED:
        attributes = F.replace(attributes, F.lit(old), F.lit(new))
    return features.withColumns({"seqid": seqid, "attributes": attributes, "strand": F.when(F.col("strand") == "0", ".").otherwise(F.col("strand"))})


def readable_names(features: DataFrame) -> DataFrame:
    """Genes named by ``gene=``, origins of replication by ``Alias=``, where those exist; only the first Name= is replaced."""
    gene, alias = (F.regexp_extract("attributes", f"{k}=([^;]+)", 1) for k in ("gene", "Alias"))
    name = F.when(F.col("type").isin(*GENES), gene).when(F.col("type") == "ARS", alias).otherwise("")
    at = F.regexp_instr("attributes", F.lit("Name=[^;]+"))
    old = F.regexp_extract("attributes", "Name=[^;]+", 0)
    new = F.concat(F.substring("attributes", F.lit(1), at - 1), F.lit("Name="), name, F.substring("attributes", at + F.length(old), F.lit(1 << 30)))
    return features.withColumn("attributes", F.when((name != "") & (at > 0), new).otherwise(F.col("attributes")))


def concatenated(*parts: DataFrame) -> DataFrame:
    """All rows of the parts, repeats kept."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def contigs_present(alignments: DataFrame) -> DataFrame:
    return alignments.select("chrom").distinct()


def in_genome_order(track: DataFrame, *before: str) -> DataFrame:
    return track.orderBy(*before, *genome_order(F.col("chrom"), F.col("bin_start")))


def numbered(track: DataFrame, name: str = "place", by: str = "sample", ties: bool = False) -> DataFrame:
    """``track`` with ``name``: each row's number, from 1, in its sample's genome order; with ``ties`` rows of one place share the first number."""
    order = [x.asc() for x in genome_order(F.col("chrom"), F.col("bin_start"))]
    return ordering.ranked(track, [by], ["chrom", "bin_start"], order, name) if ties else ordering.numbered(track, [by], order, name)


def table_order(table: DataFrame) -> DataFrame:
    """Rows sorted by all columns; rows of nothing but blanks go."""
    filled = F.lit(False)
    for c in table.columns:
        filled = filled | (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    return table.where(filled).orderBy(*table.columns)
