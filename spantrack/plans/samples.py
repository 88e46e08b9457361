"""Sample tables and scaled tracks: compositions over all samples in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.operators import factors
from spantrack.operators.fragments import counted, fragments, makes_fragment, on_main, on_spike, with_contigs
from spantrack.operators.ratio import pair_name, paired_signal, ratio_of
from spantrack.operators.small import local


def sample_figures(alignments: DataFrame, contigs: DataFrame, layout: str = "paired") -> DataFrame:
    """(sample, depth, length, main, spike, frg_tot) of all samples, a table made here by one pass: whatever factors and norms need.

    frg_tot counts the fragments on main contigs.
    """
    ok = counted(layout)
    return local(with_contigs(alignments, contigs).groupBy("sample").agg(
        F.count_if(ok).alias("depth"), F.avg(F.when(ok & (F.col("tlen") > 0), F.col("tlen"))).alias("length"), F.count_if(ok & on_main()).alias("main"),
        F.count_if(ok & on_spike()).alias("spike"), F.count_if(makes_fragment() & on_main()).alias("frg_tot"),
    ))


def pair_figures(alignments: DataFrame, layout: str = "paired", figures: DataFrame | None = None) -> DataFrame:
    """(pair, dep_ip, len_ip, dep_in, len_in) of every IP and its input, from one pass over the alignments, or from ``figures`` of one that has run."""
    own = (factors.depths(alignments, layout) if figures is None else figures).withColumn("pair", pair_name())
    side = lambda name, c: F.max(F.when(F.col("sample").startswith(f"{name}_"), F.col(c)))
    return own.groupBy("pair").agg(side("IP", "depth").alias("dep_ip"), side("IP", "length").alias("len_ip"), side("in", "depth").alias("dep_in"), side("in", "length").alias("len_in")).where("dep_ip IS NOT NULL AND dep_in IS NOT NULL")


def alpha_table(alignments: DataFrame, measurements: DataFrame, equation: str = "6nd", layout: str = "paired", figures: DataFrame | None = None) -> DataFrame:
    """The 26 columns of the alpha table, with pair in front; measurements (pair, mass_ip, mass_in, vol_all, vol_in).

    Floors are of the input's depth.
    """
    figures = pair_figures(alignments, layout, figures).join(measurements, "pair")
    named = figures.withColumns({"fil_ip": F.concat(F.lit("IP_"), "pair"), "fil_in": F.concat(F.lit("in_"), "pair"), "alpha": factors.alpha(equation), "eqn": F.lit(equation)})
    return factors.with_floors(named, "dep_in").select("pair", *factors.ALPHA_COLUMNS)


def spike_table(alignments: DataFrame, layout: str = "paired", figures: DataFrame | None = None) -> DataFrame:
    """The 23 columns of the spike-in table, with pair in front."""
    counts = (factors.organism_counts(alignments, layout) if figures is None else figures).withColumn("pair", pair_name())
    side = lambda name, c: F.max(F.when(F.col("sample").startswith(f"{name}_"), F.col(c)))
    wide = counts.groupBy("pair").agg(side("IP", "main").alias("num_mp"), side("IP", "spike").alias("num_sp"), side("in", "main").alias("num_mn"), side("in", "spike").alias("num_sn"))
    wide = wide.where("num_mp IS NOT NULL AND num_mn IS NOT NULL")
    names = {f"{o}_{s.lower()}": F.concat(F.lit(f"{s}_"), "pair", F.lit(f".{e}")) for o, e in (("main", "sc"), ("spike", "sp")) for s in ("IP", "in")}
    factor = factors.spike(F.col("num_mp"), F.col("num_sp"), F.col("num_mn"), F.col("num_sn"))
    return factors.with_floors(wide.withColumns(names).withColumn("spike", factor), "num_mn").select("pair", *factors.SPIKE_COLUMNS)


def scaled_ratio(alignments: DataFrame, contigs: DataFrame, table: DataFrame, factor: str, width: int = 30, log2: bool = False, figures: DataFrame | None = None) -> DataFrame:
    """The flagship: normalised tracks of all samples, each IP over its input's floor, times its sample's factor.

    Factors, floors and numbers of fragments are a row per pair; the tracks themselves
    are one pass over the alignments with one shuffle.
    """
    both = paired_signal(fragments(alignments.where(on_main()), contigs), width, "norm", counts=figures)
    return ratio_of(both, table.select("pair", F.col(factor).alias("factor"), F.col(f"dm_nm_{width}").alias("floor")), log2)


def siq_signal(alignments: DataFrame, contigs: DataFrame, measurements: DataFrame, width: int = 30) -> DataFrame:
    """Tracks scaled by alpha: two passes over the alignments, one for all figures and one for the tracks."""
    figures = sample_figures(alignments, contigs)
    return scaled_ratio(alignments, contigs, alpha_table(alignments, measurements, figures=figures), "alpha", width, figures=figures)


def spike_signal(alignments: DataFrame, contigs: DataFrame, width: int = 30) -> DataFrame:
    """Tracks scaled by the spike-in factor, in two passes likewise."""
    figures = sample_figures(alignments, contigs)
    return scaled_ratio(alignments, contigs, spike_table(alignments, figures=figures), "spike", width, figures=figures)
