"""Ratios of tracks: a full outer merge, a floored denominator, log2 and scaling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spantrack.operators.fragments import totals
from spantrack.operators.signal import bins, weight
from spantrack.operators.small import local

NAN, NEG_INF = float("nan"), float("-inf")


def merge(ip: DataFrame, control: DataFrame, keys: tuple[str, ...] = ("pair", "chrom", "bin_start")) -> DataFrame:
    """(keys, bin_end, ip, control): bins of either track, a missing side as 0.0; keyed on the contig's name."""
    left = ip.select(*keys, F.col("bin_end").alias("_a"), F.col("signal").alias("ip"))
    right = control.select(*keys, F.col("bin_end").alias("_b"), F.col("signal").alias("control"))
    both = left.join(right, list(keys), "full_outer")
    return both.select(*keys, F.coalesce("_a", "_b").alias("bin_end"), F.coalesce("ip", F.lit(0.0)).alias("ip"), F.coalesce("control", F.lit(0.0)).alias("control"))


def ratio(ip: Column, control: Column, floor: Column | None = None, log2: bool = False, factor: Column | None = None) -> Column:
    """ip over control, at least ``floor``; NaN over 0; log2 of 0 is -inf and of less NaN, both before scaling.

    A null floor or factor isn't applied; one of 0 or less is an error.
    """
    def above_zero(x: Column, what: str) -> Column:
        return F.when(x > 0, x).otherwise(F.raise_error(f"{what} must be above 0").cast("double"))

    below = control if floor is None else F.when(floor.isNull(), control).otherwise(F.greatest(control, above_zero(floor, "a floor")))
    plain = F.when(below == 0, F.lit(NAN)).otherwise(ip / F.nullif(below, F.lit(0.0)))
    scale = None if factor is None else F.when(factor.isNull(), F.lit(1.0)).otherwise(above_zero(factor, "a factor"))
    if not log2:
        return plain if scale is None else plain * scale
    logged = F.log2(plain) if scale is None else F.log2(plain) * scale
    return F.when(F.isnan(plain) | (plain < 0), F.lit(NAN)).when(plain == 0, F.lit(NEG_INF)).otherwise(logged)


def pair_tracks(track: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The IP and the input tracks of a table, each with ``pair``: the sample's name without its assay."""
    named = track.withColumn("pair", pair_name())
    return named.where(F.col("sample").startswith("IP_")), named.where(F.col("sample").startswith("in_"))


def pair_name(sample: str = "sample") -> Column:
    return F.regexp_replace(sample, "^(IP|in)_", "")


def paired_signal(frags: DataFrame, width: int = 10, method: str = "norm", closed_end: bool = True, counts: DataFrame | None = None) -> DataFrame:
    """(pair, chrom, bin_start, bin_end, ip, control): the two signals of every pair side by side, from one pass over the fragments.

    The bins of either track are there, a missing side as 0.0: what a full outer merge
    of the two tracks gives, by one shuffle on (pair, chrom, bin_start). ``counts``
    (sample, frg_tot), where another pass has them, spares norm one of its own.
    """
    side = lambda is_ip: F.sum(F.when(F.col("_ip") == is_ip, weight(method)).otherwise(0.0))
    sides = frags.where("sample LIKE 'IP\\_%' OR sample LIKE 'in\\_%'").withColumns({"pair": F.substring("sample", 4, 1 << 30), "_ip": F.col("sample").startswith("IP_")})
    spread = bins(sides, width, closed_end, ("pair", "_ip", "chrom"))
    both = spread.groupBy("pair", "chrom", "bin_start").agg(side(True).alias("ip"), side(False).alias("control"))
    if method == "norm":
        count = lambda name: F.max(F.when(F.col("sample").startswith(f"{name}_"), F.col("frg_tot")))
        counts = (totals(frags) if counts is None else counts).withColumn("pair", pair_name()).groupBy("pair").agg(count("IP").alias("_ip"), count("in").alias("_in"))
        over = lambda x, n: F.when(F.col(n).isNull(), 0.0).otherwise(F.col(x) / F.col(n))
        both = both.join(local(counts), "pair").withColumns({"ip": over("ip", "_ip"), "control": over("control", "_in")})
    return both.select("pair", "chrom", "bin_start", (F.col("bin_start") + width).alias("bin_end"), "ip", "control")


def ratio_of(both: DataFrame, figures: DataFrame | None = None, log2: bool = False) -> DataFrame:
    """(pair, chrom, bin_start, bin_end, value) of merged tracks (ip, control); ``figures`` (pair, with floor or factor or both), a row per pair."""
    has = lambda c: figures is not None and c in figures.columns
    if figures is not None:
        both = both.join(local(figures.select("pair", *[c for c in ("floor", "factor") if has(c)])), "pair", "left")
    value = ratio(F.col("ip"), F.col("control"), F.col("floor") if has("floor") else None, log2, F.col("factor") if has("factor") else None)
    return both.select("pair", "chrom", "bin_start", "bin_end", value.alias("value"))


def ratio_track(track: DataFrame, figures: DataFrame | None = None, log2: bool = False) -> DataFrame:
    """(pair, chrom, bin_start, bin_end, value) of every IP track of a table over its input, as ``ratio_of``."""
    return ratio_of(merge(*pair_tracks(track)), figures, log2)


def is_finite(value: Column) -> Column:
    """Neither -inf nor NaN."""
    return ~F.isnan(value) & (value != NEG_INF)


def finite(track: DataFrame, value: str = "value") -> DataFrame:
    """Rows for browsers."""
    return track.where(is_finite(F.col(value)))


def with_kind(track: DataFrame, value: str = "value") -> DataFrame:
    """``track`` with kind (finite, neginf, nan), and value null where it isn't finite."""
    kind = F.when(F.isnan(value), "nan").when(F.col(value) == NEG_INF, "neginf").otherwise("finite")
    return track.withColumn("kind", kind).withColumn(value, F.when(F.col("kind") == "finite", F.col(value)))


def width_mismatch(a: DataFrame, b: DataFrame, by: str = "pair") -> DataFrame:
    """One row per ``by`` whose two tracks' bins aren't all of one width: (by, min_width, max_width)."""
    width = (F.col("bin_end") - F.col("bin_start")).alias("width")
    widths = a.select(by, width).unionByName(b.select(by, width)).groupBy(by).agg(F.min("width").alias("min_width"), F.max("width").alias("max_width"))
    return widths.where("min_width <> max_width")


def unpaired(samples: DataFrame) -> DataFrame:
    """(sample, missing): IP samples without an input and inputs without an IP."""
    names = samples.select("sample").distinct().withColumn("pair", pair_name())
    ip, control = names.where("sample LIKE 'IP\\_%'"), names.where("sample LIKE 'in\\_%'")
    return ip.join(control, "pair", "left_anti").select("sample", F.lit("in").alias("missing")).unionByName(control.join(ip, "pair", "left_anti").select("sample", F.lit("IP").alias("missing")))
