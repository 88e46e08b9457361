import pytest
from pyspark.sql import functions as F

from spantrack.operators import factors

SAMPLES = "sample string, mass_ip double, mass_in double, vol_all double, vol_in double, dep_ip long, dep_in long, len_ip double, len_in double"
ROW = ("IP_a", 2.7, 72.5, 300.0, 20.0, 13492920, 12851824, 227.009, 197.186)


def close(a, b):
    return abs(a - b) <= 1e-12 * abs(b)


def test_alpha(spark):
    table = spark.createDataFrame([ROW, ("IP_b", 5.0, 81.1, 300.0, 20.0, 13655994, 12030091, 230.767, 199.994)], SAMPLES)
    got = [r.a for r in table.select(factors.alpha("6nd").alias("a")).collect()]
    assert close(got[0], 0.0023106316806475436) and close(got[1], 0.003816492180174805)
    m, v, d, n = 2.7 / 72.5, 20 / 300, 12851824 / 13492920, 197.186 / 227.009
    assert close(table.select(factors.alpha("5")).first()[0], m * v * d * n)
    assert close(table.select(factors.alpha("5nd")).first()[0], m * v * n)
    assert close(table.select(factors.alpha("6")).first()[0], 0.0023106316806475436 * d)
    with pytest.raises(ValueError):
        factors.alpha("7")


def test_alpha_errors(spark):
    table = spark.createDataFrame([ROW, ("b", 0.0, None, 20.0, 20.0, 0, 1, 1.0, 1.0)], SAMPLES)
    assert {tuple(r) for r in factors.alpha_errors(table).collect()} == {("b", "mass_ip must be above 0"), ("b", "mass_in must be above 0"), ("b", "vol_all must be above vol_in")}
    assert ("b", "dep_ip must be above 0") in {tuple(r) for r in factors.alpha_errors(table, "5").collect()}


def test_spike(spark):
    rows = [(13492920, 217340, 12851824, 452406), (13655994, 116947, 12030091, 339029)]
    frame = spark.createDataFrame(rows, "a long, b long, c long, d long")
    got = [r.s for r in frame.select(factors.spike(*[F.col(x) for x in "abcd"]).alias("s")).collect()]
    assert close(got[0], 2.145085661466039) and close(got[1], 3.228015767161274)
    for bad in ((0, 1, 1, 1), (1, 0, 1, 1), (1, 1, 0, 1), (1, 1, 1, -1)):
        with pytest.raises(Exception, match="above 0"):
            spark.createDataFrame([bad], "a long, b long, c long, d long").select(factors.spike(*[F.col(x) for x in "abcd"])).collect()


def test_floors(spark):
    got = factors.with_floors(spark.createDataFrame([(12851824,)], "dep long"), "dep").first()
    assert close(got.dm_fr_1, 1.057145188525161913560992) and close(got.dm_fr_50, 52.857472471745829890545037)
    assert close(got.dm_nm_10, 0.000000822564930190970787) and close(got.dm_nm_30, 0.000002467698850257977350)
    assert close(got.dm_fr_10, 10.57145971138664286570)


def test_relative(spark):
    table = spark.createDataFrame([("IP_a", 2.0, "x"), ("IP_b", 3.0, "y"), ("in_a", 9.0, "z")], "sample string, sf double, other string")
    out = factors.relative(table)
    assert out.columns == ["sample", "sf", "scaled", "other"]
    assert {r.sample: r.scaled for r in out.collect()} == {"IP_a": 0.666667, "IP_b": 1.0, "in_a": 1.0}
    assert {r.sample: r.scaled for r in factors.relative(table, include_input=True).collect()}["in_a"] == 3.0
    with pytest.raises(ValueError):
        factors.relative(table.drop("sf"))


def test_numbers_and_lengths(spark):
    table = spark.createDataFrame([("a", "10", "1.5"), ("b", "0", ".5"), ("c", "x", "0.0"), ("d", None, "1e5"), ("e", "007", "3")], "sample string, n string, x string")
    got = {(r.sample, r.field) for r in factors.number_problems(table, "sample", ("n",), ("x",)).collect()}
    assert got == {("b", "n"), ("c", "n"), ("c", "x"), ("d", "n"), ("d", "x")}
    digits = spark.createDataFrame([(227.0094321,), (0.000123456789,), (0.0,)], "x double").select(factors.six_digits(F.col("x")).alias("y")).collect()
    assert [f"{r.y:.6g}" for r in digits] == ["227.009", "0.000123457", "0"]
    bed = spark.createDataFrame([("s", 10), ("s", 20), ("t", None)], "sample string, frg_len int")
    assert {tuple(r) for r in factors.bed_lengths(bed).collect()} == {("s", 2, 15.0), ("t", 1, 0.0)}


def test_depth_errors(spark):
    figures = spark.createDataFrame([("a", 5, 100.0), ("b", 0, None), ("c", 3, None)], "sample string, depth long, length double")
    assert sorted(map(tuple, factors.depth_errors(figures).collect())) == [("b", "no countable alignments"), ("b", "no positive template length"), ("c", "no positive template length")]
