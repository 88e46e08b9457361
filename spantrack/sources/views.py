"""The driver's tables seen as alignments, mates, sample sheets, measurements, manifests and features.

The columns follow from the rows by integer arithmetic that any engine repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spantrack.operators.small import on_all_cores

CONTIG_LENGTH = 20000
MAIN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI")
CONTIGS = (*MAIN, "SP_I", "SP_II", "SP_III")
FLAGS = (99, 163, 1123, 1187, 147, 0, 16, 83, 99, 2147)
REGIONS = ("I:1001-3000", "chrII:5000-5999", "16", "chrX", "SP_I:1-20000", "XVII", "IV:300-200", "V:19000-21000")
GENOTYPES, STATES = ("WT", "hho1-KO", ""), ("G1", "G2M", "log", "Q", "ZZ")
FACTORS = ("Hho1", "Hmo1", "H3", "H4K20", "Isw1-flag", "weird")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple, at: F.Column) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus", "l_quantity", "l_discount"]
    line = on_all_cores(table(spark, sf_dir, "lineitem").select(*columns))
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    return line.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", price.cast("string")).alias("qname"),
        F.col("l_returnflag").alias("grp"), F.when(F.col("l_linestatus") == "O", "IP").otherwise("in").alias("assay"),
        ((F.col("l_partkey") * 31 + F.col("l_orderkey")) % 19).alias("cidx"),
        ((F.col("l_partkey") * 7919 + F.col("l_orderkey") * 104729 + F.col("l_linenumber").cast("long") * 1299709) % CONTIG_LENGTH).alias("pos"),
        (F.col("l_quantity").cast("int") * 4 + 50).alias("tlen"), ((F.col("l_orderkey") + F.col("l_linenumber")) % 10).alias("kind"),
        F.round(F.col("l_discount") * 100).cast("int").alias("mapq"), ((F.col("l_orderkey") + F.col("l_partkey")) % 4 == 0).alias("fourth"),
    )


def alignments(spark: SparkSession, sf_dir: str, secondary: bool = False) -> DataFrame:
    """One alignment per lineitem in six samples, IP and input of three groups; with ``secondary`` every fourth or so is a secondary one."""
    chrom, flag = _pick(CONTIGS, F.col("cidx")), _pick(FLAGS, F.col("kind"))
    flag = F.when(F.col("fourth"), flag.bitwiseOR(F.lit(256))).otherwise(flag) if secondary else flag
    return _lines(spark, sf_dir).select(
        F.concat_ws("_", "assay", "grp").alias("sample"), "grp", "assay", "qname", flag.alias("flag"), chrom.alias("chrom"), "pos",
        (F.col("pos") + 50).alias("ref_end"), chrom.alias("mate_chrom"), "tlen", F.lit(50).alias("aln_len"), "mapq",
    )


def mates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records per lineitem, the mates of a pair."""
    chrom = _pick(CONTIGS, F.col("cidx"))
    two = _lines(spark, sf_dir).withColumn("second", F.explode(F.array(F.lit(False), F.lit(True))))
    return two.select(
        F.concat_ws("_", "assay", "grp").alias("sample"), "qname", F.when(F.col("second"), 147).otherwise(99).alias("flag"), chrom.alias("chrom"),
        F.when(F.col("second"), F.col("pos") + F.col("tlen") - 50).otherwise(F.col("pos")).alias("pos"), F.lit(50).alias("aln_len"), "mapq",
    )


def contigs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, CONTIG_LENGTH) for c in CONTIGS], "chrom string, chrom_len long")


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(r,) for r in REGIONS], "region string")


def sample_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, path): names made of tokens by p_partkey."""
    k = F.col("p_partkey")
    state, factor = _pick(STATES, k % 5), _pick(FACTORS, k % 6)
    order = F.when(k % 4 < 2, F.concat_ws("_", state, factor)).otherwise(F.concat_ws("_", factor, state))
    genotype = F.nullif(_pick(GENOTYPES, k % 3), F.lit(""))
    name = F.concat_ws("_", _pick(("IP", "in"), k % 2), genotype, order, F.when(k % 7 == 0, "DMSO"), F.concat(F.lit("y"), (k % 9).cast("string")))
    return table(spark, sf_dir, "part").select(k.alias("sample_id"), F.concat(F.lit("/data/"), name, F.lit(".sc.bam")).alias("path"))


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements per factor, state, genotype and strain, the first of each by p_partkey; every third swaps factor and state, some are of strains that no sample has."""
    k = F.col("row_no")
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("row_no"), "p_retailprice", "p_size")
    state, factor = _pick(STATES, k % 5), _pick(FACTORS, k % 6)
    swap = k % 3 == 0
    return rows.select(
        "row_no", F.when(swap, F.lower(state)).otherwise(factor).alias("factor"), F.when(swap, factor).otherwise(state).alias("state"),
        _pick(("WT", "hho1-KO", "other"), k % 3).alias("genotype"), F.concat(F.when(k % 11 < 8, " y").otherwise(" z"), (k % 9).cast("string")).alias("strain"),
        F.lit(20.0).alias("vol_in"), F.lit(300.0).alias("vol_all"), F.col("p_retailprice").alias("mass_in"), (F.col("p_size") + 1.0).alias("mass_ip"),
    )


def group_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(grp, mass_ip, mass_in, vol_all, vol_in) of the three groups."""
    part = table(spark, sf_dir, "part")
    return part.groupBy(_pick(("A", "N", "R"), F.col("p_partkey") % 3).alias("grp")).agg(
        (F.min("p_retailprice") / 100).alias("mass_ip"), (F.max("p_retailprice") / 10).alias("mass_in"), F.lit(300.0).alias("vol_all"), F.lit(20.0).alias("vol_in")
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, run_accession, urls): one, two or three URLs by page_id; every fifth run is missing."""
    p = F.col("page_id")
    urls = F.when(p % 13 == 0, F.concat_ws(";", "url", "url", "url")).when(p % 2 == 0, F.concat_ws(";", F.concat("url", F.lit("_1")), F.concat("url", F.lit("_2")))).otherwise(F.col("url"))
    run = F.when(p % 5 == 0, "NA").otherwise(F.concat(F.lit("SRR"), p.cast("string")))
    return table(spark, sf_dir, "pages").select((p + 2).alias("line_no"), run.alias("run_accession"), urls.alias("urls"))


def read_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path): read files by p_partkey, in pairs, alone and without a partner."""
    k = F.col("p_partkey")
    stem = F.concat(F.lit("s"), k.cast("string"))
    end = F.when(k % 3 == 0, ".fq").otherwise(".fastq.gz")
    names = F.when(k % 4 == 0, F.array(F.concat(stem, end))).when(k % 4 == 1, F.array(F.concat(stem, F.lit("_R1.atria"), end))).otherwise(F.array(F.concat(stem, F.lit("_R1"), end), F.concat(stem, F.lit("_R2"), end)))
    return table(spark, sf_dir, "part").select(F.explode(names).alias("path"))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GFF3-like features of parts, with encoded attributes."""
    k = F.col("p_partkey")
    kind = _pick(("gene", "ARS", "CDS", "tRNA_gene", "pseudogene", "mRNA"), k % 6)
    seqid = F.concat(F.lit("chr"), _pick((*MAIN, "mt"), k % 17))
    attributes = F.concat(F.lit("ID="), k.cast("string"), F.lit(";Name=N"), k.cast("string"), F.when(k % 2 == 0, F.concat(F.lit(";gene="), F.replace("p_name", F.lit(" "), F.lit("%20")))).otherwise(""), F.when(k % 3 == 1, F.concat(F.lit(";Alias=A%28"), k.cast("string"), F.lit("%29"))).otherwise(""), F.lit(";Note=5&#8242%2C 3&#946 %3B 10%"))
    return table(spark, sf_dir, "part").select(
        k.alias("feature_id"), seqid.alias("seqid"), F.lit("src").alias("source"), kind.alias("type"), (k % 1000 + 1).alias("start"), (k % 1000 + F.col("p_size")).alias("end"),
        F.lit(".").alias("score"), _pick(("+", "-", "0"), k % 3).alias("strand"), F.lit(".").alias("phase"), attributes.alias("attributes"),
    )


def feature_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, line_no, line): lines of ten files of features, with a marker line in some."""
    k = F.col("p_partkey")
    line = F.when((k % 97 == 50) & (k % 10 < 7), "### end").otherwise(F.concat(F.lit("chrI\t"), F.col("p_name")))
    return table(spark, sf_dir, "part").select((k % 10).alias("file"), k.alias("line_no"), line.alias("line"))


def fasta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, organism, line): headers and sequence lines of both organisms."""
    s = F.col("s_suppkey")
    main = F.concat(F.lit(">ref|NC_"), s.cast("string"), F.lit("| [org=x] ["), F.when(s % 4 == 1, "location=mitochondrion]").otherwise(F.concat(F.lit("chromosome="), _pick(MAIN, s % 16), F.lit("]"))))
    spiked = F.concat(F.lit(">"), _pick(("chr_II_telomeric_gap", "I", "II", "III", "mating_type_region", "mitochondrial"), s % 6), F.lit(" of the organism"))
    organism = _pick(("main", "spike"), s % 2)
    header = F.when(organism == "main", main).otherwise(spiked)
    lines = F.array(header, F.upper(F.translate("s_name", "0123456789#", "ACGTACGTACN")))
    return table(spark, sf_dir, "supplier").select(s.alias("number"), organism.alias("organism"), F.posexplode(lines).alias("part", "line")).select((F.col("number") * 2 + F.col("part")).alias("line_no"), "organism", "line")
