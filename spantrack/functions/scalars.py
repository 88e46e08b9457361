"""Column functions: contig order, sample names, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sixteen main contigs in order.
ROMAN = ("I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII", "XIV", "XV", "XVI")


def roman_number(chrom: Column) -> Column:
    """1 to 16 for a Roman contig name, with or without ``chr``; null for others."""
    numbers = F.create_map(*[F.lit(x) for i, name in enumerate(ROMAN, 1) for x in (name, i)])
    return F.element_at(numbers, F.regexp_replace(chrom, "^chr", ""))


def genome_order(chrom: Column, start: Column) -> list[Column]:
    """Sort keys: Roman contigs by number, then others by name, each by start."""
    number = roman_number(chrom)
    return [number.isNull(), number, chrom, start]


def round_even(x: Column, digits: int) -> Column:
    """Half-even rounding, as for scaling factors."""
    return F.bround(x, digits)


def fixed(x: Column, digits: int = 24) -> Column:
    """A track's value with so many decimals; NaN and infinities in lower case."""
    text = F.format_string(f"%.{digits}f", x)
    return F.when(F.isnan(x), "nan").when(x == float("inf"), "inf").when(x == float("-inf"), "-inf").otherwise(text)


# Tokens of sample names.
STATES = ("G1", "G2M", "log", "Q")
FACTOR = r"^(H[1-4][A-Za-z0-9]*|[A-Za-z0-9]+-flag|Hmo1|Hho1)$"


#: What a sample's name says.
NAME_PARTS = ("assay", "genotype", "state", "treatment", "factor", "strain", "error")


def parse_sample_names(table: DataFrame, path: str = "path") -> DataFrame:
    """``table`` with assay, genotype, state, treatment, factor, strain and error of a column of paths or names.

    The folder, one of .bam, .cram or .sam, and one more dotted tag are dropped. The
    first token is the assay (IP or in), the last the strain. A first middle token
    WT or ending in -KO is the genotype. Of the rest, where both a state and a
    factor occur anywhere, the first of each counts and the first other token is the
    treatment; otherwise only the first two tokens are looked at and the third is
    the treatment. Missing parts are N/A; error says what makes the name unusable.

    Each step is a column of its own, so that none is worked out again for every
    part that needs it.
    """
    c, at, none = F.col, lambda x, i: F.get(x, F.lit(i)), F.lit("N/A")
    first = lambda x, test: at(F.filter(x, test), 0)
    is_state, is_factor = lambda t: t.isin(*STATES), lambda t: t.rlike(FACTOR)
    stem = F.regexp_replace(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.(bam|cram|sam)$", ""), r"\.[^.]+$", "")
    after = lambda x: F.slice(x, F.lit(2), F.greatest(F.size(x) - 1, F.lit(0)))
    steps = (
        {"_tokens": F.split(stem, "_")},
        {"_assay": at(c("_tokens"), 0), "_strain": F.element_at("_tokens", -1), "_middle": F.slice("_tokens", F.lit(2), F.greatest(F.size("_tokens") - 2, F.lit(0)))},
        {"_lead": at(c("_middle"), 0)},
        {"_named": F.coalesce((c("_lead") == "WT") | F.lower("_lead").endswith("-ko"), F.lit(False))},
        {"_rest": F.when(c("_named"), after(c("_middle"))).otherwise(c("_middle"))},
        {"_a_state": first(c("_rest"), is_state), "_a_factor": first(c("_rest"), is_factor), "_two": F.slice("_rest", 1, 2)},
        {"_both": c("_a_state").isNotNull() & c("_a_factor").isNotNull()},
        # token positions hold each value once at their first place
        {"_state_at": F.array_position("_rest", c("_a_state")), "_factor_at": F.array_position("_rest", c("_a_factor"))},
        {
            "_state": F.when(c("_both"), c("_a_state")).otherwise(first(c("_two"), is_state)), "_factor": F.when(c("_both"), c("_a_factor")).otherwise(first(c("_two"), is_factor)),
            "_treatment": F.when(c("_both"), at(F.filter("_rest", lambda t, i: (i + 1 != c("_state_at")) & (i + 1 != c("_factor_at"))), 0)).otherwise(at(c("_rest"), 2)),
        },
    )
    out = table
    for step in steps:
        out = out.withColumns(step)
    error = F.when(F.size("_tokens") < 3, "too short").when(~c("_assay").isin("IP", "in"), "bad assay").when(c("_factor").isNull(), "no factor")
    parts = (c("_assay"), F.when(c("_named"), c("_lead")).otherwise(none), F.coalesce("_state", none), F.coalesce("_treatment", none), c("_factor"), c("_strain"), error)
    # a generator of one row, so that filters on a part aren't pushed below the steps and worked out from the path again
    return out.select(*table.columns, F.inline(F.array(F.struct(*[x.alias(n) for n, x in zip(NAME_PARTS, parts, strict=True)]))))
