import math

import pytest
from pyspark.sql import functions as F

from spantrack.operators import ratio

TRACK = "sample string, chrom string, bin_start long, bin_end long, signal double"


def values(spark, rows, **options):
    frame = spark.createDataFrame(rows, "ip double, control double, floor double, factor double")
    given = {k: F.col(k) for k in ("floor", "factor") if options.pop(k, False)}
    return [r.v for r in frame.select(ratio.ratio(F.col("ip"), F.col("control"), given.get("floor"), options.get("log2", False), given.get("factor")).alias("v")).collect()]


def test_edges(spark):
    rows = [(1.0, 0.0, 2.0, 3.0), (0.0, 0.0, 2.0, 3.0), (4.0, 2.0, 1.0, 3.0), (0.0, 2.0, 1.0, 3.0), (-4.0, 2.0, 8.0, None)]
    plain = values(spark, rows)
    assert all(math.isnan(x) for x in plain[:2]) and plain[2:] == [2.0, 0.0, -2.0]
    assert values(spark, rows, floor=True) == [0.5, 0.0, 2.0, 0.0, -0.5]
    logged = values(spark, rows, log2=True, factor=True)
    assert math.isnan(logged[0]) and logged[2] == 3.0 and logged[3] == float("-inf") and math.isnan(logged[4])
    assert values(spark, [(4.0, 2.0, None, 3.0)], floor=True, factor=True) == [6.0]
    for bad in ("floor", "factor"):
        with pytest.raises(Exception, match="above 0"):
            values(spark, [(4.0, 2.0, 0.0, 0.0)], **{bad: True})


def test_merge_and_reports(spark):
    rows = [("IP_x", "I", 0, 10, 2.0), ("IP_x", "zz", 10, 20, 3.0), ("in_x", "I", 0, 10, 4.0), ("in_x", "yy", 10, 20, 5.0), ("IP_lone", "I", 0, 10, 1.0)]
    track = spark.createDataFrame(rows, TRACK)
    got = {(r.pair, r.chrom): r for r in ratio.with_kind(ratio.ratio_track(track)).collect()}
    assert got["x", "I"].value == 0.5 and got["x", "zz"].kind == "nan" and got["x", "yy"].value == 0.0 and got["lone", "I"].kind == "nan"
    assert ratio.finite(ratio.ratio_track(track, log2=True)).count() == 1
    assert [tuple(r) for r in ratio.unpaired(track).collect()] == [("IP_lone", "in")]
    ip, control = ratio.pair_tracks(track)
    assert ratio.width_mismatch(ip, control).count() == 0
    odd = control.withColumn("bin_end", F.col("bin_end") + 5)
    assert [tuple(r) for r in ratio.width_mismatch(ip, odd).collect()] == [("x", 10, 15)]


def test_one_pass_is_the_merge_of_tracks(spark):
    from spantrack.operators import signal

    rows = [("IP_x", "I", 0, 25, 20), ("IP_x", "I", 12, 40, 30), ("in_x", "I", 30, 70, 40), ("IP_lone", "II", 5, 9, 4), ("in_only", "II", 5, 9, 4), ("other", "II", 5, 9, 4)]
    frags = spark.createDataFrame(rows, "sample string, chrom string, frg_start long, frg_end long, frg_len int")
    for method in signal.METHODS:
        want = ratio.merge(*ratio.pair_tracks(signal.bin_signal(frags, 10, method)))
        got = ratio.paired_signal(frags, 10, method)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(*got.columns).collect()))
    figures = spark.createDataFrame([("x", 0.5, 2.0)], "pair string, floor double, factor double")
    values = {(r.pair, r.bin_start): r.value for r in ratio.ratio_of(ratio.paired_signal(frags, 10, "unadj"), figures).collect()}
    assert values["x", 0] == 40.0 and math.isnan(values["lone", 0])
