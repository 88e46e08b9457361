from spantrack.operators import fragments as f

COLUMNS = "sample string, qname string, flag int, chrom string, pos long, ref_end long, mate_chrom string, tlen int, aln_len int, mapq int"


def aligned(spark, rows):
    return spark.createDataFrame([("s", f"q{i}", *r) for i, r in enumerate(rows)], COLUMNS)


def contigs(spark):
    return spark.createDataFrame([("I", 1000)], "chrom string, chrom_len long")


def places(frags):
    return sorted((r.qname, r.frg_start, r.frg_end, r.frg_len) for r in frags.collect())


def test_pairs_and_singles(spark):
    rows = [
        (99, "I", 100, 150, "I", 200, 50, 9), (147, "I", 250, 300, "I", -200, 50, 9), (99, "I", 950, 1000, "I", 120, 50, 9), (65, "I", 10, 60, "I", 90, 50, 9), (99, "I", 10, 60, "II", 90, 50, 9),
        (0, "I", 5, 40, None, 0, 35, 9), (16, "I", 5, 40, None, 0, 60, 9), (16, "I", 500, None, None, 0, 30, 9), (4, "I", 5, 40, None, 0, 35, 9), (0, "I", 5, 40, None, 0, 0, 9),
        (2048, "I", 5, 40, None, 0, 35, 9), (256, "I", 7, 40, None, 0, 35, 9), (1024, "I", 8, 40, None, 0, 35, 9), (83, "I", 60, 110, "I", 70, 50, 9), (0, "other", 1, 2, None, 0, 5, 9),
    ]
    got = places(f.fragments(aligned(spark, rows), contigs(spark)))
    assert got == sorted([("q0", 100, 300, 200), ("q2", 950, 1000, 120), ("q5", 5, 40, 35), ("q6", 0, 40, 60), ("q7", 470, 500, 30), ("q11", 7, 42, 35), ("q12", 8, 43, 35), ("q13", 60, 130, 70)])
    none = f.fragments(aligned(spark, rows), contigs(spark), allow_secondary=False, allow_duplicate=False, allow_supplementary=True)
    assert {x[0] for x in places(none)} == {"q0", "q2", "q5", "q6", "q7", "q10", "q13"}


def test_fixed_length(spark):
    import pytest

    rows = [(99, "I", 990, 1000, "I", 5, 10, 9), (16, "I", 5, 40, None, 0, 35, 9)]
    assert places(f.fragments(aligned(spark, rows), contigs(spark), 30)) == [("q0", 990, 1000, 30), ("q1", 10, 40, 30)]
    with pytest.raises(ValueError):
        f.fragments(aligned(spark, rows), contigs(spark), 0)


def test_mates(spark):
    rows = [("s", "a", 99, "I", 100, 50, 1), ("s", "a", 147, "I", 250, 50, 1), ("s", "b", 99, "I", 1, 50, 1), ("s", "b", 147, "II", 9, 50, 1), ("s", "c", 99, "I", 1, 50, 1)]
    records = spark.createDataFrame(rows, "sample string, qname string, flag int, chrom string, pos long, aln_len int, mapq int")
    assert [(r.frg_start, r.frg_end, r.frg_len) for r in f.join_mates(records).collect()] == [(100, 299, 200)]
    fixed = {(r.qname, r.flag): (r.mate_chrom, r.mate_pos, r.tlen) for r in f.fix_mates(records).collect()}
    assert fixed == {("a", 99): ("I", 250, 200), ("a", 147): ("I", 100, -200), ("b", 99): ("II", 9, 0), ("b", 147): ("I", 1, 0), ("c", 99): (None, None, 0)}


def test_duplicates_and_layout(spark):
    rows = [(0, "I", 5, 40, None, 0, 35, q) for q in (3, 9, 9)] + [(16, "I", 5, 40, None, 0, 35, 1)]
    marked = {r.qname: r.flag for r in f.mark_duplicates(f.fragments(aligned(spark, rows), contigs(spark))).collect()}
    assert marked == {"q0": 1024, "q1": 0, "q2": 1024, "q3": 16}
    assert f.layouts(aligned(spark, rows)).first().layout == "single"


def test_third_record_of_a_name(spark):
    rows = [("s", "a", 99, "I", 100, 50, 1), ("s", "a", 147, "I", 250, 50, 1), ("s", "a", 2147, "II", 150, 30, 1), ("s", "a", 2195, "I", 20, 30, 1), ("s", "d", 355, "I", 7, 50, 1)]
    records = spark.createDataFrame(rows, "sample string, qname string, flag int, chrom string, pos long, aln_len int, mapq int")
    fixed = {(r.qname, r.flag): (r.mate_chrom, r.mate_pos, r.tlen) for r in f.fix_mates(records).collect()}
    assert fixed == {("a", 99): ("I", 250, 200), ("a", 147): ("I", 100, -200), ("a", 2147): ("I", 250, 200), ("a", 2195): ("I", 100, -200), ("d", 355): (None, None, 0)}


def test_duplicates_of_null_quality_and_equal_names(spark):
    rows = [(0, "I", 5, 40, None, 0, 35, q) for q in (None, 7)] + [(16, "I", 500, 540, None, 0, 40, None), (272, "I", 500, 540, None, 0, 40, None)]
    table = aligned(spark, rows).replace({"q3": "q2"}, subset="qname")
    frags = f.fragments(table, contigs(spark))
    marked = {(r.qname, r.flag & ~1024): r.flag & 1024 for r in f.mark_duplicates(frags).collect()}
    assert marked == {("q0", 0): 1024, ("q1", 0): 0, ("q2", 16): 0, ("q2", 272): 1024}
    done = spark.createDataFrame([("s",)], "sample string")
    assert {r.flag & 1024 for r in f.mark_duplicates(frags, done).collect()} == {0}


def test_orders(spark):
    rows = [("s", "b", 99, "II", 5), ("s", "a", 147, "X", 9), ("s", "a", 99, "IX", 9), ("t", "a", 0, "zz", 1), ("s", "c", 0, "II", 4)]
    records = spark.createDataFrame(rows, "sample string, qname string, flag int, chrom string, pos long")
    assert [(r.sample, r.qname, r.flag) for r in f.queryname_order(records).collect()] == [("s", "a", 99), ("s", "a", 147), ("s", "b", 99), ("s", "c", 0), ("t", "a", 0)]
    assert [(r.sample, r.chrom, r.pos) for r in f.coordinate_order(records).collect()] == [("s", "II", 4), ("s", "II", 5), ("s", "IX", 9), ("s", "X", 9), ("t", "zz", 1)]
    assert {(r.qname, r.flag): r.place for r in f.numbered_by_name(records).where("sample = 's'").collect()} == {("a", 99): 1, ("a", 147): 2, ("b", 99): 3, ("c", 0): 4}
