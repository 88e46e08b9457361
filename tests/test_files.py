import glob
import gzip
import math

import pytest
from pyspark.sql import functions as F

from spantrack.operators import factors
from spantrack.plans import samples as plans
from spantrack.sources import readers, views, writers
from spantrack.streaming import tracks

SAM = "@HD\tVN:1\n@SQ\tSN:I\tLN:1000\n@SQ\tSN:II\tLN:50\nq1\t99\tI\t101\t30\t20M2I5M3D25M\t=\t251\t200\tA\tF\nq2\t16\tII\t11\t0\t*\t*\t0\t0\tA\tF\nq3\t4\t*\t0\t0\t*\t*\t0\t0\tA\tF\n"


def test_sam(spark, tmp_path):
    (tmp_path / "IP_a.sam").write_text(SAM)
    rows = {r.qname: r for r in readers.read_sam(spark, str(tmp_path / "IP_a.sam")).collect()}
    assert tuple(rows["q1"]) == ("IP_a", "q1", 99, "I", 100, 153, "I", 200, 52, 30)
    assert rows["q2"].ref_end is None and rows["q2"].mate_chrom is None and rows["q3"].chrom is None
    assert {tuple(r) for r in readers.read_contigs(spark, str(tmp_path / "IP_a.sam")).collect()} == {("I", 1000), ("II", 50)}


def test_bed_and_bedgraph(spark, tmp_path):
    with gzip.open(tmp_path / "in_a.bed.gz", "wt") as out:
        out.write("I\t5\t105\t100\nII\t0\t20\t25\n")
    assert {tuple(r) for r in readers.read_bed(spark, str(tmp_path / "in_a.bed.gz")).collect()} == {("in_a", "I", 5, 105, 100), ("in_a", "II", 0, 20, 25)}
    (tmp_path / "x.bedgraph").write_text("track type=bedGraph\nI 0  10\t1.5\nI\t10\t20\t-inf\nI\t20\t30\tnan\n\n")
    got = readers.read_bedgraph(spark, str(tmp_path / "x.bedgraph")).orderBy("bin_start").collect()
    assert [r.signal for r in got[:2]] == [1.5, float("-inf")] and math.isnan(got[2].signal)


def test_measurement_tables(spark, tmp_path):
    (tmp_path / "m.tsv").write_bytes("factor\tvolume_in\tIP DNA mass (ng)\tconc_in\r\nHho1\t20\t2.7\t6.04\r\nHmo1\t20\t5\t1\r\n".encode())
    got = readers.read_measurements(spark, str(tmp_path / "m.tsv")).orderBy("row_no").collect()
    assert [(r.factor, r.vol_in, r.mass_ip, r.conc_in) for r in got] == [("Hho1", "20", "2.7", "6.04"), ("Hmo1", "20", "5", "1")]
    (tmp_path / "m.csv").write_text("factor,v_all\nH3,300\n")
    assert readers.read_measurements(spark, str(tmp_path / "m.csv")).first().vol_all == "300"
    with pytest.raises(ValueError):
        readers.read_measurements(spark, str(tmp_path / "m.xlsx"))
    (tmp_path / "d.tsv").write_text("custom_name\tfastq_https\trun_accession\nn1\tu;v\tSRR1\nn2\tw\tNA\n")
    assert [tuple(r) for r in readers.read_manifest(spark, str(tmp_path / "d.tsv")).orderBy("line_no").collect()] == [(2, "SRR1", "u;v", "n1"), (3, "NA", "w", "n2")]


def test_measurements_of_many_parts(spark, tmp_path):
    """A table that many tasks read, and one in several files: rows are numbered through them without a gap."""
    (tmp_path / "m.csv").write_text("factor,v_all\n" + "".join(f"f{i},{i}\n" for i in range(5000)))
    (tmp_path / "d.csv").mkdir()
    for k in range(3):
        (tmp_path / "d.csv" / f"part-{k}.csv").write_text("factor,v_all\n" + "".join(f"f{i},{i}\n" for i in range(k * k * 1000, (k + 1) ** 2 * 1000)))
    (tmp_path / "e.csv").write_text("factor,v_all\n")
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(c) for c in names]
    for c in names:
        spark.conf.set(c, "3k")
    try:
        assert spark.read.csv(str(tmp_path / "m.csv")).rdd.getNumPartitions() > 8
        for name, n in (("m.csv", 5000), ("d.csv", 9000), ("e.csv", 0)):
            got = readers.read_measurements(spark, str(tmp_path / name))
            assert got.columns == ["factor", "vol_all", "row_no"]
            assert sorted((r.row_no, r.factor, r.vol_all) for r in got.collect()) == [(i, f"f{i}", str(i)) for i in range(n)]
    finally:
        for c, value in zip(names, before):
            spark.conf.set(c, value)


def test_round_trips(spark, tmp_path):
    track = spark.createDataFrame([("IP_a", "X", 0, 10, 0.25), ("IP_a", "II", 10, 20, 1 / 3), ("IP_b", "I", 0, 10, 2.0)], "sample string, chrom string, bin_start long, bin_end long, signal double")
    writers.write_bedgraph(track, str(tmp_path / "t"), digits=20)
    lines = [x for p in sorted(glob.glob(f"{tmp_path}/t/sample=IP_a/*.gz")) for x in gzip.open(p, "rt").read().splitlines()]
    assert [x.split("\t")[0] for x in lines] == ["II", "X"]
    back = readers.read_bedgraph(spark, f"{tmp_path}/t/sample=IP_a").collect()
    assert sorted(r.signal for r in back) == [0.25, 1 / 3]
    ratio = spark.createDataFrame([("a", "I", 0, 10, float("nan")), ("a", "I", 10, 20, 2.0)], "pair string, chrom string, bin_start long, bin_end long, value double")
    writers.write_ratio(ratio, str(tmp_path / "r"), gzip=False)
    assert readers.read_bedgraph(spark, f"{tmp_path}/r/file=all/pair=a").count() == 2 and readers.read_bedgraph(spark, f"{tmp_path}/r/file=companion/pair=a").first().signal == 2.0
    frags = spark.createDataFrame([("s", "I", 1, 9, 8)], "sample string, chrom string, frg_start long, frg_end long, frg_len int")
    writers.write_fragments(frags, str(tmp_path / "f"))
    assert readers.read_bed(spark, f"{tmp_path}/f/sample=s").drop("sample").first() == frags.drop("sample").first()


def test_sample_tables(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    aligned = views.alignments(spark, d)
    alpha = plans.alpha_table(aligned, views.group_measurements(spark, d).withColumnRenamed("grp", "pair"))
    for name, table, columns in (("alpha", alpha, factors.ALPHA_COLUMNS), ("spike", plans.spike_table(aligned), factors.SPIKE_COLUMNS)):
        writers.write_sample_table(table, str(tmp_path / name), name)
        (file,) = glob.glob(f"{tmp_path}/{name}/part*")
        lines = open(file).read().splitlines()
        assert lines[0].split("\t") == columns and len(lines) == 4


def test_stream(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    aligned, contigs = views.alignments(spark, d), views.contigs(spark)
    from spantrack.operators.fragments import fragments
    from spantrack.operators.signal import bin_signal

    for i in range(3):
        aligned.where(f"pos % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(aligned.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError):
        tracks.start(stream, contigs, "", "", method="norm")
    q = tracks.start(stream, contigs, str(tmp_path / "out"), str(tmp_path / "check"))
    q.processAllAvailable()
    q.stop()
    keys = ["sample", "chrom", "bin_start", "bin_end"]
    want = bin_signal(fragments(aligned, contigs), 10, "norm").withColumnRenamed("signal", "want")
    both = tracks.track(spark, str(tmp_path / "out"), normalised=True).join(want, keys, "full_outer")
    assert both.where("want IS NULL OR signal IS NULL OR abs(want - signal) > 1e-12").count() == 0


def test_samples_by_folder_and_marked_headers(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    aligned = views.alignments(spark, d)
    writers.write_sam(aligned, views.contigs(spark), str(tmp_path / "sam"), gzip=True)
    back = readers.read_sam(spark, str(tmp_path / "sam"))
    columns = ["sample", "qname", "flag", "chrom", "pos", "ref_end", "mate_chrom", "tlen", "aln_len", "mapq"]
    assert back.exceptAll(aligned.select(*columns).withColumn("ref_end", F.col("ref_end").cast("long"))).count() == 0 and back.count() == aligned.count()
    assert sorted(tuple(r) for r in readers.read_contigs(spark, str(tmp_path / "sam")).collect()) == sorted((c, views.CONTIG_LENGTH) for c in views.CONTIGS)
    (tmp_path / "m.sam").write_text("@PG\tID:samtools\tCL:samtools markdup -t a b\nq\t0\tI\t1\t1\t5M\t*\t0\t0\t*\t*\n")
    (tmp_path / "n.sam").write_text("@PG\tID:samtools\tCL:samtools sort a\nq\t0\tI\t1\t1\t5M\t*\t0\t0\t*\t*\n")
    assert [r.sample for r in readers.read_marked(spark, str(tmp_path / "*.sam")).collect()] == ["m"]


def test_manifests(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b"run_accession\tfastq_ftp\r\nS1\tu\r\n\r\nS2\tv;w\r\n")
    (tmp_path / "b.tsv").write_text("custom_name\tother\n")
    assert [tuple(r) for r in readers.read_manifest(spark, str(tmp_path / "a.tsv")).collect()] == [(2, "S1", "u", None), (4, "S2", "v;w", None)]
    (tmp_path / "b.tsv").write_text("custom_name\tother\nx\ty\n")
    with pytest.raises(Exception, match="run_accession"):
        readers.read_manifest(spark, str(tmp_path / "b.tsv")).collect()


def test_headers_cost_no_records(spark, tmp_path, monkeypatch):
    """A header's bytes are all that is read, however long the file; files have headers of their own, also packed ones and none."""
    from pyarrow import fs

    from spantrack.sources import headers

    record = "q\t0\tI\t1\t1\t5M\t*\t0\t0\t*\t*\n"
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.sam").write_text("@SQ\tSN:I\tLN:9\n@SQ\tSN:II\tLN:8\n" + record * 200_000)
    with gzip.open(tmp_path / "d" / "b.sam.gz", "wt") as out:
        out.write("@SQ\tSN:I\tLN:9\r\n@SQ\tSN:X\tLN:7\n@PG\tID:samtools\tCL:samtools markdup x\n" + record)
    (tmp_path / "d" / "c.sam").write_text(record)
    (tmp_path / "d" / "e.sam").write_text("")
    (tmp_path / "d" / "f.sam").write_text("@SQ\tSN:last\tLN:1")
    (tmp_path / "d" / "_g.sam").write_text("@SQ\tSN:hidden\tLN:1\n")
    assert {tuple(r) for r in readers.read_contigs(spark, str(tmp_path / "d")).collect()} == {("I", 9), ("II", 8), ("X", 7), ("last", 1)}
    assert [r.sample for r in readers.read_marked(spark, f"file://{tmp_path}/d").collect()] == ["b"]
    assert {tuple(r) for r in readers.read_contigs(spark, str(tmp_path / "d" / "f.sam")).collect()} == {("last", 1)}
    read = []

    class Counted:
        def __init__(self, stream):
            self.stream = stream

        def read(self, n):
            read.append(n)
            return self.stream.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

    system = fs.LocalFileSystem()

    class Watched:
        def open_input_stream(self, *a, **k):
            return Counted(system.open_input_stream(*a, **k))

    assert len(list(headers.header_lines(Watched(), str(tmp_path / "d" / "a.sam"), 100))) == 2 and sum(read) == 100
    with pytest.raises(Exception, match="nothing-here"):
        readers.read_contigs(spark, str(tmp_path / "nothing-here")).collect()


def test_lines_and_files_are_in_order(spark, tmp_path):
    rows = [("s", c, i * 10, i * 10 + 10, float(i)) for c in ("X", "II", "IX", "zz") for i in range(300)] + [("t", "I", 0, 10, 1.0)]
    track = spark.createDataFrame(rows, "sample string, chrom string, bin_start long, bin_end long, signal double").repartition(5)
    for gz in (True, False):
        writers.write_bedgraph(track, str(tmp_path / f"t{gz}"), digits=1, gzip=gz)
        from spantrack.sources import tracks as kept

        got = sorted((r.sample, r.line_no, r.line) for r in kept.read_lines(spark, str(tmp_path / f"t{gz}")).collect())
        want = [f"{c}\t{i * 10}\t{i * 10 + 10}\t{i:.1f}" for c in ("II", "IX", "X", "zz") for i in range(300)]
        assert got == [("s", k, x) for k, x in enumerate(want, 1)] + [("t", 1, "I\t0\t10\t1.0")]
        ranges = sorted((r.sample, r.file, r.first, r.last) for r in kept.file_ranges(spark, str(tmp_path / f"t{gz}")).collect())
        assert all(a[3] < b[2] for a, b in zip(ranges, ranges[1:]) if a[0] == b[0])
