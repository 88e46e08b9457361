"""Binned signal of fragments.

A fragment adds its weight to every base that it covers; a bin's value is the sum
over its bases. A fragment becomes one row for each bin it touches, with the number
of bases in it, and for coverage base by base only its two ends are rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spantrack.operators.fragments import totals
from spantrack.operators.small import local

METHODS = ("unadj", "frag", "norm")


def bins(frags: DataFrame, width: int, closed_end: bool = True, keys: tuple[str, ...] = ("sample", "chrom")) -> DataFrame:
    """(keys, bin_start, bases, frg_len): one row per fragment and bin.

    ``closed_end`` counts the base at frg_end too, as the reference tracks do; the
    documented half-open intervals are had without it.
    """
    if width <= 0:
        raise ValueError("a bin must be wider than 0")
    last = F.col("frg_end") if closed_end else F.col("frg_end") - 1
    floor = lambda x: x - F.pmod(x, F.lit(width))
    spread = frags.select(*keys, "frg_start", last.alias("last"), "frg_len", F.explode(F.sequence(floor(F.col("frg_start")), floor(last), F.lit(width).cast("long"))).alias("bin_start"))
    bases = F.least("last", F.col("bin_start") + (width - 1)) - F.greatest("frg_start", "bin_start") + 1
    return spread.select(*keys, "bin_start", bases.alias("bases"), "frg_len")


def weight(method: str) -> Column:
    """What a fragment adds to a bin, before normalising."""
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}")
    return F.col("bases").cast("double") if method == "unadj" else F.col("bases") / F.col("frg_len")


def bin_signal(frags: DataFrame, width: int = 10, method: str = "norm", closed_end: bool = True) -> DataFrame:
    """(sample, chrom, bin_start, bin_end, signal), sparse: bins that no fragment touches are absent.

    unadj: each base counts 1; frag: 1 / frg_len; norm: that over the sample's number
    of fragments, divided once per bin. One shuffle for the sums; the fragments are
    counted first, a row per sample.
    """
    track = bins(frags, width, closed_end).groupBy("sample", "chrom", "bin_start").agg(F.sum(weight(method)).alias("signal"))
    if method == "norm":
        track = track.join(local(totals(frags)), "sample").withColumn("signal", F.col("signal") / F.col("frg_tot"))
    return track.select("sample", "chrom", "bin_start", (F.col("bin_start") + width).alias("bin_end"), "signal")


def scaled(track: DataFrame, factors: DataFrame, factor: str = "factor") -> DataFrame:
    """``track`` times each sample's factor; samples without one (or null) stay; a factor of 0 or less is an error."""
    value = F.col("_factor")
    checked = F.when(value.isNull(), F.lit(1.0)).when(value > 0, value).otherwise(F.raise_error("a scaling factor must be above 0").cast("double"))
    joined = track.join(local(factors.select("sample", F.col(factor).cast("double").alias("_factor"))), "sample", "left")
    return joined.withColumn("signal", F.col("signal") * checked).drop("_factor")


#: Bases of a tile, within which depths are summed up.
TILE = 4096


def _runs(frags: DataFrame, closed_end: bool) -> DataFrame:
    """(sample, chrom, tile, start, end, depth): stretches of equal depth above 0 within each tile, end left out."""
    last = F.col("frg_end") if closed_end else F.col("frg_end") - 1
    cut = frags.select("sample", "chrom", "frg_start", last.alias("last")).withColumn("tile", F.explode(F.sequence(F.floor(F.col("frg_start") / TILE), F.floor(F.col("last") / TILE))))
    begin, end = F.greatest("frg_start", F.col("tile") * TILE), F.least("last", F.col("tile") * TILE + (TILE - 1)) + 1
    changes = F.explode(F.array(F.struct(begin.alias("at"), F.lit(1).alias("by")), F.struct(end.alias("at"), F.lit(-1).alias("by"))))
    steps = cut.select("sample", "chrom", "tile", changes.alias("c")).groupBy("sample", "chrom", "tile", "c.at").agg(F.sum("c.by").alias("by"))
    along = Window.partitionBy("sample", "chrom", "tile").orderBy("at")
    depths = steps.where("by <> 0").select("sample", "chrom", "tile", F.col("at").alias("start"), F.lead("at").over(along).alias("end"), F.sum("by").over(along).alias("depth"))
    return depths.where("depth > 0")


def coverage(frags: DataFrame, closed_end: bool = True) -> DataFrame:
    """Per-base coverage, the unadjusted signal in bins of one base, from the places where it changes.

    A fragment gives two rows for each tile of 4096 bases that it touches, whatever
    its length; equal places are summed before the shuffle, and a running sum within
    each tile gives the depth up to the next change.
    """
    bases = _runs(frags, closed_end).select("sample", "chrom", F.explode(F.sequence("start", F.col("end") - 1)).alias("bin_start"), F.col("depth").cast("double").alias("signal"))
    return bases.select("sample", "chrom", "bin_start", (F.col("bin_start") + 1).alias("bin_end"), "signal")


def coverage_runs(frags: DataFrame, closed_end: bool = True) -> DataFrame:
    """(sample, chrom, start, end, depth): the longest stretches of equal depth above 0, end left out; no base is a row.

    Within a tile neighbouring runs differ, as a change of 0 isn't one. Only runs that
    reach a tile's border, two a tile at most, are carried on to the next one: they are
    put in order by contig, and a run starts where the one before doesn't end at its
    start with its depth.
    """
    runs = _runs(frags, closed_end)
    at_border = (F.col("start") == F.col("tile") * TILE) | (F.col("end") == (F.col("tile") + 1) * TILE)
    along = Window.partitionBy("sample", "chrom").orderBy("start")
    goes_on = (F.lag("end").over(along) == F.col("start")) & (F.lag("depth").over(along) == F.col("depth"))
    border = runs.where(at_border).withColumn("_new", F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(along))
    carried = border.groupBy("sample", "chrom", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.first("depth").alias("depth"))
    columns = ["sample", "chrom", "start", "end", "depth"]
    return runs.where(~at_border).select(*columns).unionByName(carried.select(*columns))


def run_statistics(runs: DataFrame, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """(by, bases, min, max, avg, sum) of the bases that runs stand for, each weighted by its length."""
    length = F.col("end") - F.col("start")
    total, bases = F.sum(F.col("depth") * length), F.sum(length)
    return runs.groupBy(*by).agg(bases.alias("bases"), F.min("depth").alias("min"), F.max("depth").alias("max"), (total / bases).alias("avg"), total.alias("sum"))


def in_region(track: DataFrame, regions: DataFrame) -> DataFrame:
    """Rows of ``track`` that overlap a region (region, chrom, start, end; 1-based, ends included), with its name.

    Regions meet a track by contig and tile of 4096 bases, so that neither side has to be small.
    """
    tile = 4096
    spread = lambda a, b: F.explode(F.sequence(F.floor(a / tile), F.floor(b / tile)))
    left = track.withColumn("_tile", spread(F.col("bin_start"), F.col("bin_end") - 1))
    right = regions.select("region", F.col("chrom").alias("_chrom"), F.col("start").alias("_start"), F.col("end").alias("_end"), spread(F.col("start") - 1, F.col("end") - 1).alias("_t"))
    met = left.join(right, (F.col("chrom") == F.col("_chrom")) & (F.col("_tile") == F.col("_t")) & (F.col("bin_start") < F.col("_end")) & (F.col("bin_end") >= F.col("_start")))
    once = F.greatest(F.floor(F.col("bin_start") / tile), F.floor((F.col("_start") - 1) / tile)) == F.col("_tile")
    return met.where(once).drop("_tile", "_t", "_chrom", "_start", "_end")


def region_max(track: DataFrame, regions: DataFrame) -> DataFrame:
    """(region, sample, max_signal)."""
    return in_region(track, regions).groupBy("region", "sample").agg(F.max("signal").alias("max_signal"))


def unity(track: DataFrame, low: float = 0.98, high: float = 1.02) -> DataFrame:
    """(sample, total, is_unity)."""
    return track.groupBy("sample").agg(F.sum("signal").alias("total")).withColumn("is_unity", F.col("total").between(low, high))


def statistics(track: DataFrame) -> DataFrame:
    """(sample, min, max, avg, sum) of the bins that are there."""
    return track.groupBy("sample").agg(*[f("signal").alias(n) for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg), ("sum", F.sum))])


def parse_regions(regions: DataFrame, contigs: DataFrame) -> DataFrame:
    """``regions`` (region) with chrom, start, end and error.

    A region is a Roman number or an integer, with or without ``chr``, alone (the
    whole contig) or with ``:start-end``, 1-based with both ends; integers 1 to 16
    mean the Roman contigs.
    """
    from spantrack.functions.scalars import ROMAN

    pattern = rf"^(?:chr)?({'|'.join(sorted(ROMAN, key=len, reverse=True))}|[0-9]+)(?::([0-9]+)-([0-9]+))?$"
    part = lambda i: F.nullif(F.regexp_extract("region", pattern, i), F.lit(""))
    names = F.array(*[F.lit(x) for x in ROMAN])
    chrom = F.coalesce(F.get(names, part(1).try_cast("int") - 1), part(1))
    split = regions.withColumns({"chrom": chrom, "start": part(2).try_cast("long"), "end": part(3).try_cast("long")})
    known = split.join(local(contigs.select(F.col("chrom").alias("_c"), "chrom_len")), F.col("chrom") == F.col("_c"), "left")
    whole = F.col("start").isNull() & part(2).isNull()
    known = known.withColumns({"start": F.when(whole, F.lit(1).cast("long")).otherwise(F.col("start")), "end": F.when(whole, F.col("chrom_len")).otherwise(F.col("end"))})
    error = (
        F.when(F.col("chrom").isNull(), "format").when(F.col("chrom_len").isNull(), "contig").when(F.col("start").isNull() | F.col("end").isNull() | (F.col("start") < 1), "start")
        .when(F.col("end") < F.col("start"), "order").when(F.col("end") > F.col("chrom_len"), "bounds")
    )
    return known.select(*regions.columns, "chrom", "start", "end", error.alias("error"))
