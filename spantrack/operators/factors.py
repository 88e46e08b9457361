"""Scaling factors, depth floors and other per-sample figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spantrack.operators.fragments import counted, on_main, on_spike

# Genome size, bins of the floor grid, grams per mole of a base pair.
GENOME_SIZE, FLOOR_BINS, BASE_PAIR = 12157105, (1, 5, 10, 20, 30, 40, 50), 660
EQUATIONS = ("5", "5nd", "6", "6nd")
INPUTS = ("mass_ip", "mass_in", "vol_all", "vol_in", "dep_ip", "dep_in", "len_ip", "len_in")
FLOORS = [f"dm_{m}_{b}" for m in ("fr", "nm") for b in FLOOR_BINS]
# Columns of the two sample tables in order.
ALPHA_COLUMNS = ["fil_ip", "fil_in", "alpha", "eqn", *INPUTS, *FLOORS]
SPIKE_COLUMNS = ["main_ip", "spike_ip", "main_in", "spike_in", "spike", "num_mp", "num_sp", "num_mn", "num_sn", *FLOORS]


def depths(alignments: DataFrame, layout: str = "paired") -> DataFrame:
    """(sample, depth, length): countable alignments and their mean template length, one pass; length null without a positive one."""
    ok = counted(layout)
    return alignments.groupBy("sample").agg(F.count_if(ok).alias("depth"), F.avg(F.when(ok & (F.col("tlen") > 0), F.col("tlen"))).alias("length"))


def depth_errors(figures: DataFrame) -> DataFrame:
    """One row (sample, problem) for each sample of ``depths`` whose factor can't be made: nothing counted, or no positive template length."""
    found = [F.when(F.col("depth") == 0, "no countable alignments"), F.when(F.col("length").isNull(), "no positive template length")]
    return figures.select("sample", F.explode(F.array_compact(F.array(*found))).alias("problem"))


def six_digits(x: Column) -> Column:
    """A positive number with 6 significant digits, as awk prints it."""
    scale = F.pow(F.lit(10.0), F.lit(5) - F.floor(F.log10(x)))
    return F.when(x > 0, F.round(x * scale) / scale).otherwise(x)


def bed_lengths(bed: DataFrame, by: str = "sample") -> DataFrame:
    """(by, n, mean_length) of fragment tables; 0 without rows of a length."""
    return bed.groupBy(by).agg(F.count("*").alias("n"), F.coalesce(F.avg("frg_len"), F.lit(0.0)).alias("mean_length"))


def alpha(equation: str = "6nd") -> Column:
    """A sample's factor from its masses, volumes, depths and lengths, by one of four equations."""
    m_ip, m_in, v_all, v_in, d_ip, d_in, l_ip, l_in = (F.col(c).cast("double") for c in INPUTS)
    if equation not in EQUATIONS:
        raise ValueError(f"equation must be one of {EQUATIONS}")
    if equation.startswith("5"):
        depth = (d_in / d_ip,) if equation == "5" else ()
        return reduce(lambda a, b: a * b, (m_ip / m_in, v_in / v_all, *depth, l_in / l_ip))
    above, below = m_ip / (BASE_PAIR * l_ip * (v_all - v_in)), m_in / (BASE_PAIR * l_in * v_in)
    return above / d_ip / (below / d_in) if equation == "6" else above / below


def alpha_errors(samples: DataFrame, equation: str = "6nd") -> DataFrame:
    """One row (sample, problem) for each input that isn't above 0, and for volumes the equation can't use."""
    needed = [c for c in INPUTS if equation in ("5", "6") or not c.startswith("dep")]
    found = [F.when(F.coalesce(F.col(c).cast("double") > 0, F.lit(False)), None).otherwise(f"{c} must be above 0") for c in needed]
    if equation.startswith("6"):
        found.append(F.when(F.col("vol_all").cast("double") <= F.col("vol_in").cast("double"), "vol_all must be above vol_in"))
    return samples.select("sample", F.explode(F.array_compact(F.array(*found))).alias("problem"))


def spike(main_ip: Column, spike_ip: Column, main_in: Column, spike_in: Column) -> Column:
    """The input's spike-in share over the IP's; counts below 0, no main reads and no spike-in reads in the IP are errors."""
    bad = (F.least(main_ip, spike_ip, main_in, spike_in) < 0) | (main_ip == 0) | (main_in == 0) | (spike_ip == 0)
    share = lambda s, m: s.cast("double") / F.nullif(m + s, F.lit(0))
    factor = share(spike_in, main_in) / F.nullif(share(spike_ip, main_ip), F.lit(0.0))
    return F.when(bad, F.raise_error("counts of a spike-in sample must be above 0").cast("double")).otherwise(factor)


def organism_counts(alignments: DataFrame, layout: str = "paired") -> DataFrame:
    """(sample, main, spike): countable alignments of the two organisms, one pass."""
    ok = counted(layout)
    return alignments.groupBy("sample").agg(F.count_if(ok & on_main()).alias("main"), F.count_if(ok & on_spike()).alias("spike"))


def floor_value(depth: Column, width: int, genome: int = GENOME_SIZE, mode: str = "frag") -> Column:
    """The least signal of an input: what its fragments give spread over the genome; ``norm`` divides by their number."""
    if width <= 0 or genome <= width:
        raise ValueError("a bin must be wider than 0 and narrower than the genome")
    share = width / (genome - width)
    if mode == "norm":
        return F.when(depth > 0, F.lit(share)).otherwise(F.raise_error("no fragments").cast("double"))
    return depth * F.lit(float(width)) / F.lit(float(genome - width))


def with_floors(samples: DataFrame, depth: str) -> DataFrame:
    """``samples`` with the 14 floors of its input depth."""
    grid = {f"dm_{k}_{b}": floor_value(F.col(depth), b, mode=m) for k, m in (("fr", "frag"), ("nm", "norm")) for b in FLOOR_BINS}
    return samples.withColumns(grid)


def relative(samples: DataFrame, factor: str | None = None, include_input: bool = False, digits: int = 6) -> DataFrame:
    """``samples`` with ``scaled`` after its factor: over the largest of samples not named in_*, which get 1 unless included."""
    factor = factor or next((c for c in ("alpha", "sf") if c in samples.columns), None)
    if factor is None:
        raise ValueError("neither alpha nor sf is a column")
    is_input = F.col("sample").startswith("in_")
    largest = samples.where(~is_input).agg(F.max(F.col(factor).cast("double"))).first()[0]  # one number, found here
    value = F.bround(F.col(factor) / F.lit(largest or None).cast("double"), digits)
    out = samples.withColumn("scaled", value if include_input else F.when(is_input, 1.0).otherwise(value))
    at = samples.columns.index(factor) + 1
    return out.select(*samples.columns[:at], "scaled", *samples.columns[at:])


def number_problems(table: DataFrame, key: str, integers: tuple[str, ...] = (), floats: tuple[str, ...] = ()) -> DataFrame:
    """(key, field, value, problem) of text fields that aren't positive numbers by grammar."""
    integer, decimal = r"^[0-9]*[1-9][0-9]*$", r"^([0-9]+(\.[0-9]+)?|\.[0-9]+)$"
    found = []
    for c in (*integers, *floats):
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        ok = text.rlike(integer) if c in integers else text.rlike(decimal) & (F.coalesce(text.try_cast("double"), F.lit(0.0)) > 0)
        what = "not a positive integer" if c in integers else "not a positive number"
        found.append(F.when(~ok, F.struct(F.lit(c).alias("field"), text.alias("value"), F.lit(what).alias("problem"))))
    return table.select(key, F.explode(F.array_compact(F.array(*found))).alias("p")).select(key, "p.*")
