import pytest
from pyspark.sql import functions as F

from spantrack.functions import scalars
from spantrack.operators import genome, matching


def test_sample_names(spark):
    cases = {
        "/x/IP_WT_G1_Hho1_6336.sc.bam": ("IP", "WT", "G1", "N/A", "Hho1", "6336", None),
        "in_Hmo1_Q_7750.cram": ("in", "N/A", "Q", "N/A", "Hmo1", "7750", None),
        "IP_hho1-KO_log_H3_DMSO_1.sp.sam": ("IP", "hho1-KO", "log", "DMSO", "H3", "1", None),
        "IP_DMSO_log_H4K20_1": ("IP", "N/A", "log", "DMSO", "H4K20", "1", None),
        "IP_Isw1-flag_1.bam": ("IP", "N/A", "N/A", "N/A", "Isw1-flag", "1", None),
        "IP_a_b_c_H3_1": ("IP", "N/A", "N/A", "c", None, "1", "no factor"),
        "IP_H3_b_c_d_1": ("IP", "N/A", "N/A", "c", "H3", "1", None),
        "IP_1": ("IP", "N/A", "N/A", "N/A", None, "1", "too short"),
        "xx_WT_G1_H3_1": ("xx", "WT", "G1", "N/A", "H3", "1", "bad assay"),
    }
    frame = spark.createDataFrame([(x,) for x in cases], "path string")
    for r in matching.parsed(frame).collect():
        assert tuple(r)[1:] == cases[r.path], r


def test_measurements(spark):
    rows = [(0, "Hho1", None, " yA", "WT", "G1"), (1, "G1", None, "ya", "WT", "HHO1"), (2, "long name", "H3", "yb", "WT", "log"), (3, "H3", None, "yb", "WT", "log")]
    table = spark.createDataFrame(rows, "row_no long, factor string, factor_abbrev string, strain string, genotype string, state string")
    samples = [("a", "hho1", "YA", "WT", "G1"), ("b", "G1", "ya", "N/A", "Hho1"), ("c", "H3", "yb", "N/A", "N/A"), ("d", "H3", "yb", "hho1-KO", "log"), ("e", "H4", "yb", "N/A", "N/A")]
    frame = spark.createDataFrame(samples, "sample string, factor string, strain string, genotype string, state string")
    got = {r.sample: (r.row_no, r.match_pass) for r in matching.match_measurements(frame, table).collect()}
    assert got == {"a": (0, 1), "b": (1, 1), "c": (2, 1)}
    assert {r.sample for r in matching.unmatched(frame, table).collect()} == {"d", "e"}
    swapped = spark.createDataFrame([("z", "log", "yb", "WT", "H3")], frame.schema)
    assert matching.match_measurements(swapped, table).first().match_pass == 2


def test_files_and_manifest(spark):
    files = ["a_R1.fastq.gz", "a_R2.fastq.gz", "b_R1.atria.fq", "c.fq.gz", "d_R1.atria.fastq", "d_R2.atria.fastq"]
    got = {r.stem: (r.r1, r.r2, r.problem) for r in matching.pair_files(spark.createDataFrame([(x,) for x in files], "path string")).collect()}
    assert got == {"a": (files[0], files[1], None), "b": (files[2], None, "missing R2"), "c.fq.gz": (files[3], None, None), "d": (files[4], files[5], None)}
    rows = [(2, "SRR1", "u;v"), (3, "NA", "u"), (4, None, "a;b;c")]
    got = matching.parse_manifest(spark.createDataFrame(rows, "line_no long, run_accession string, urls string")).collect()
    assert [(r.run_accession, r.url_1, r.url_2, r.problem) for r in got] == [("SRR1", "u", "v", None), ("SRR_undefined_3", "u", "NA", None), ("SRR_undefined_4", "a", "b", "too many URLs")]
    names = spark.createDataFrame([("IP_a",), ("IP_Brn1",), ("in_a",)], "sample string")
    assert [r.sample for r in matching.select_samples(names, ("IP*",), ("*Brn1*",)).collect()] == ["IP_a"]


def test_lookup_and_unpivot(spark):
    samples, table = spark.createDataFrame([("a",), ("b",)], "sample string"), spark.createDataFrame([("a", 2.0)], "sample string, alpha double")
    assert {tuple(r) for r in matching.lookup(samples, table, "alpha").collect()} == {("a", 2.0), ("b", None)}
    assert {r.alpha for r in matching.lookup(samples, table, "alpha", override=5).collect()} == {5.0}
    wide = spark.createDataFrame([("mass", 1.0, 2.0), ("vol", 3.0, None)], "sample string, s1 double, s2 double")
    assert {tuple(r) for r in matching.unpivot_measures(wide).collect()} == {("s1", "mass", 1.0), ("s2", "mass", 2.0), ("s1", "vol", 3.0), ("s2", "vol", None)}


def test_genome_text(spark):
    lines = {">ref|N1| [org=S] [chromosome=IV] [x]": ">IV", ">ref|N2| [org=S] [location=mitochondrion] [top=circular]": ">Mito", "ACGT": "ACGT"}
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", genome.main_fasta(F.col("line")).alias("out")).collect()
    assert {r.line: r.out for r in got} == lines
    lines = {">chr_II_telomeric_gap x": ">SP_II_TG", ">I y": ">SP_I", ">II y": ">SP_II", ">III z": ">SP_III", ">mating_type_region x": ">SP_MTR", ">mitochondrial x": ">SP_Mito", "II ACG": "II ACG"}
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", genome.spike_fasta(F.col("line")).alias("out")).collect()
    assert {r.line: r.out for r in got} == lines
    names = {"I": "SP_I", "II": "SP_II", "III": "SP_III", "chr_II_telomeric_gap": "SP_II_TG", "mating_type_region": "SP_MTR", "mitochondrial": "SP_Mito"}
    got = spark.createDataFrame([(x,) for x in names], "n string").select("n", genome.spike_contig(F.col("n")).alias("out")).collect()
    assert {r.n: r.out for r in got} == names


def test_features(spark):
    columns = "seqid string, type string, strand string, attributes string"
    rows = [("chrmt", "gene", "0", "Name=Y1;gene=A%20B%2C;x=5%;Name=Y2"), ("chrI", "ARS", "+", "ID=1;Name=n;Alias=ARS%281%29"), ("chrI", "CDS", "-", "Name=c;gene=G"), ("chrI", "snoRNA_gene", "-", "Name=c;gene=$1\\")]
    got = genome.readable_names(genome.clean_features(spark.createDataFrame(rows, columns))).collect()
    assert [(r.seqid, r.strand) for r in got][0] == ("Mito", ".")
    assert [r.attributes for r in got] == ["Name=A B,;gene=A B,;x=5 percent;Name=Y2", "ID=1;Name=ARS(1);Alias=ARS(1)", "Name=c;gene=G", "Name=$1\\;gene=$1\\"]
    lines = spark.createDataFrame([("f", 1, "a"), ("f", 2, "### x"), ("f", 3, "b"), ("g", 5, "c")], "file string, line_no long, line string")
    assert sorted(r.line for r in genome.before_marker(lines).collect()) == ["a", "c"]


def test_orders(spark):
    track = spark.createDataFrame([(c, s) for c in ("X", "II", "Mito", "IX", "SP_I") for s in (20, 3)], "chrom string, bin_start long")
    assert [r.chrom for r in genome.in_genome_order(track).collect()][::2] == ["II", "IX", "X", "Mito", "SP_I"]
    table = spark.createDataFrame([("b", 1), (" ", None), ("a", 2), (None, None)], "x string, y int")
    assert [r.x for r in genome.table_order(table).collect()] == ["a", "b"]
    fixed = spark.createDataFrame([(0.5,), (float("nan"),), (float("-inf"),)], "x double").select(scalars.fixed(F.col("x"), 3).alias("t")).collect()
    assert [r.t for r in fixed] == ["0.500", "nan", "-inf"]
    assert [r.y for r in spark.createDataFrame([(0.125,), (0.375,)], "x double").select(scalars.round_even(F.col("x"), 2).alias("y")).collect()] == [0.12, 0.38]
    with pytest.raises(Exception):
        genome.concatenated(track, table)
