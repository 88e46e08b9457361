import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from spantrack.operators import signal

FRAGS = "sample string, chrom string, frg_start long, frg_end long, frg_len int"


def frags(spark, n=200, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice("ab"), rng.choice(["I", "II"]), s := rng.randrange(900), s + rng.randint(1, 90), rng.randint(1, 120)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, FRAGS)


@pytest.mark.parametrize("width", [1, 5, 10, 30])
@pytest.mark.parametrize("method", signal.METHODS)
def test_against_bases(spark, width, method):
    rows, table = frags(spark)
    for closed in (True, False):
        want = defaultdict(float)
        total = {s: sum(r[0] == s for r in rows) for s in "ab"}
        for s, c, a, b, n in rows:
            for p in range(a, b + closed):
                want[s, c, p // width * width] += {"unadj": 1, "frag": 1 / n, "norm": 1 / n / total[s]}[method]
        got = {(r.sample, r.chrom, r.bin_start): r.signal for r in signal.bin_signal(table, width, method, closed).collect()}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_coverage_is_signal_base_by_base(spark):
    rows, table = frags(spark, 150, 4)
    far = table.unionByName(spark.createDataFrame([("a", "I", 4000, 13000, 9000), ("b", "II", 4096, 8192, 5), ("b", "II", 4095, 4096, 5)], FRAGS))
    for closed in (True, False):
        both = signal.coverage(far, closed).withColumnRenamed("signal", "x").join(signal.bin_signal(far, 1, "unadj", closed), ["sample", "chrom", "bin_start", "bin_end"], "full_outer")
        assert both.count() > 9000 and both.where("NOT x <=> signal").count() == 0


def test_coverage_runs_cross_tiles(spark):
    """Runs are the longest ones, also over whole tiles, and stand for the same bases and statistics."""
    rows, table = frags(spark, 150, 4)
    far = table.unionByName(spark.createDataFrame([("a", "I", 4000, 13000, 9000), ("a", "II", 2000, 90000, 9), ("a", "II", 12287, 12288, 1), ("b", "II", 4096, 8192, 5), ("b", "II", 4095, 4096, 5)], FRAGS))
    for closed in (True, False):
        depth = {(r.sample, r.chrom, r.bin_start): int(r.signal) for r in signal.coverage(far, closed).collect()}
        runs = signal.coverage_runs(far, closed)
        got = sorted(map(tuple, runs.collect()))
        want, last = [], None
        for (s, c, at), d in sorted(depth.items()):
            if last == (s, c, at, d):
                want[-1] = (*want[-1][:3], at + 1, d)
            else:
                want.append((s, c, at, at + 1, d))
            last = (s, c, at + 1, d)
        assert got == want and max(e - a for _, _, a, e, _ in got) > 70_000
        for r in signal.run_statistics(runs).collect():
            own = [d for (s, _, _), d in depth.items() if s == r.sample]
            assert (r.bases, r.min, r.max, r["sum"]) == (len(own), min(own), max(own), sum(own)) and abs(r.avg - sum(own) / len(own)) < 1e-9


def test_bins_refine_and_unity(spark):
    rows, table = frags(spark)
    fine = signal.bin_signal(table, 5, "frag").withColumn("bin_start", F.col("bin_start") - F.col("bin_start") % 10).groupBy("sample", "chrom", "bin_start").agg(F.sum("signal").alias("x"))
    both = fine.join(signal.bin_signal(table, 10, "frag"), ["sample", "chrom", "bin_start"])
    assert both.count() == fine.count() and both.where("abs(x - signal) > 1e-9").count() == 0
    own = spark.createDataFrame([("a", "I", s, s + n, n) for s, n in ((0, 100), (50, 200), (3, 150))], FRAGS)
    assert abs(signal.unity(signal.bin_signal(own, 10, "norm")).first().total - (1 + (1 / 100 + 1 / 200 + 1 / 150) / 3)) < 1e-12
    assert abs(signal.unity(signal.bin_signal(own, 10, "norm", closed_end=False)).first().total - 1) < 1e-12


def test_one_shuffle_and_no_join_for_sums(spark):
    _, table = frags(spark)
    plan = signal.bin_signal(table, 10, "frag")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_scaled(spark):
    _, table = frags(spark)
    track = signal.bin_signal(table, 10, "unadj")
    twice = signal.scaled(track, spark.createDataFrame([("a", 2.0)], "sample string, factor double"))
    sums = {r.sample: r.s for r in twice.groupBy("sample").agg(F.sum("signal").alias("s")).collect()}
    plain = {r.sample: r.s for r in track.groupBy("sample").agg(F.sum("signal").alias("s")).collect()}
    assert sums == {"a": 2 * plain["a"], "b": plain["b"]}
    with pytest.raises(Exception, match="above 0"):
        signal.scaled(track, spark.createDataFrame([("a", 0.0)], "sample string, factor double")).collect()
    with pytest.raises(ValueError):
        signal.bin_signal(table, 0)
    with pytest.raises(ValueError):
        signal.bin_signal(table, 10, "len")


def test_regions(spark):
    contigs = spark.createDataFrame([("I", 1000), ("II", 9000)], "chrom string, chrom_len long")
    regions = spark.createDataFrame([(x,) for x in ("I", "chrII", "2", "chr1", "I:1-10", "chrII:5000-9000", "II:0-3", "I:5-4", "I:1-1001", "III", "x", "I:1", "1:991-1000")], "region string")
    got = {r.region: (r.chrom, r.start, r.end, r.error) for r in signal.parse_regions(regions, contigs).collect()}
    assert got["I"] == ("I", 1, 1000, None) and got["2"] == got["chrII"] == ("II", 1, 9000, None) and got["chr1"] == got["I"]
    assert got["chrII:5000-9000"] == ("II", 5000, 9000, None) and got["1:991-1000"] == ("I", 991, 1000, None)
    assert [got[x][3] for x in ("II:0-3", "I:5-4", "I:1-1001", "III", "x", "I:1")] == ["start", "order", "bounds", "contig", "format", "format"]
    track = spark.createDataFrame([("s", "II", i * 100, i * 100 + 100, float(i)) for i in range(90)], "sample string, chrom string, bin_start long, bin_end long, signal double")
    good = signal.parse_regions(regions, contigs).where("error IS NULL")
    assert {r.region: r.max_signal for r in signal.region_max(track, good).collect()} == {"2": 89.0, "chrII": 89.0, "chrII:5000-9000": 89.0}
    assert signal.in_region(track, good.where("region = 'chrII:5000-9000'")).count() == 41
