"""From alignments to fragments: filters, interval construction, pairing, duplicates.

Alignments have columns sample, qname, flag, chrom, pos, ref_end, mate_chrom, tlen,
aln_len, mapq; fragments sample, chrom, frg_start, frg_end (half-open) and frg_len.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spantrack.operators.small import local

# Bits of the flag, flags that are counted, contigs of the two organisms.
PAIRED, PROPER, UNMAPPED, REVERSE, SECONDARY, DUPLICATE, SUPPLEMENTARY = 0x1, 0x2, 0x4, 0x10, 0x100, 0x400, 0x800
READ_1, READ_2 = 0x40, 0x80
COUNTED = {"paired": (99, 1123, 163, 1187), "single": (0, 1024, 16, 1040)}
SPIKE, SPIKE_EXTRA = ("SP_I", "SP_II", "SP_III"), {"tg": "SP_II_TG", "mtr": "SP_MTR", "mito": "SP_Mito"}


def has(bits: int, flag: str = "flag") -> Column:
    return F.col(flag).bitwiseAND(F.lit(bits)) == bits


def counted(layout: str = "paired") -> Column:
    """Alignments that count towards a sample's depth."""
    return F.col("flag").isin(*COUNTED[layout])


def mapped_tally(layout: str = "paired") -> Column:
    return ~has(UNMAPPED) & counted(layout)


def quality_at_least(mapq: int = 1, require_proper: bool = False) -> Column:
    """Mapping quality of at least ``mapq``; proper pairs only for paired records where asked for."""
    least = F.col("mapq") >= mapq
    return least & (~has(PAIRED) | has(PROPER)) if require_proper else least


def on_main(mito: bool = False) -> Column:
    from spantrack.functions.scalars import ROMAN

    return F.col("chrom").isin(*ROMAN, *(["Mito"] if mito else []))


def on_spike(tg: bool = False, mtr: bool = False, mito: bool = False) -> Column:
    return F.col("chrom").isin(*SPIKE, *[SPIKE_EXTRA[k] for k, on in (("tg", tg), ("mtr", mtr), ("mito", mito)) if on])


def usable(allow_secondary: bool = True, allow_supplementary: bool = False, allow_duplicate: bool = True) -> Column:
    """Records that may make a fragment; the flag is asked once, as a filter repeats what a column is made of."""
    dropped = UNMAPPED
    for allowed, bits in ((allow_secondary, SECONDARY), (allow_supplementary, SUPPLEMENTARY), (allow_duplicate, DUPLICATE)):
        dropped |= 0 if allowed else bits
    return (F.col("flag").bitwiseAND(F.lit(dropped)) == 0) & F.col("chrom").isNotNull()


def anchors() -> Column:
    """The leftmost record of a proper pair on one contig."""
    return has(PAIRED | PROPER) & (F.col("chrom") == F.col("mate_chrom")) & (F.col("tlen") > 0)


def bounds(length: int | Column | None = None) -> dict[str, Column]:
    """frg_start, frg_end and frg_len of an alignment that knows its contig's chrom_len, before it is asked whether it makes a fragment."""
    if isinstance(length, int) and length <= 0:
        raise ValueError("a fragment length must be above 0")
    fixed = F.lit(None).cast("int") if length is None else F.lit(length) if isinstance(length, int) else length
    pair = has(PAIRED)
    size = F.coalesce(fixed, F.when(pair, F.col("tlen")).otherwise(F.col("aln_len"))).cast("int")
    right = F.coalesce("ref_end", "pos")
    begin = F.when(~pair & has(REVERSE), right - size).otherwise(F.col("pos"))
    return {"frg_start": F.greatest(begin, F.lit(0)).cast("long"), "frg_end": F.least(begin + size, F.col("chrom_len")).cast("long"), "frg_len": size}


def fragments(alignments: DataFrame, contigs: DataFrame, length: int | Column | None = None, **filters: bool) -> DataFrame:
    """Fragments of all samples, clamped to their contig; frg_len stays as it was before.

    A pair's fragment starts at its anchor and is as long as the template; a single
    read's starts at its 5' end and is as long as its aligned part. ``length``
    replaces both: a number or a column of the alignments (null: not replaced).
    ``contigs`` (chrom, chrom_len) drops records on other contigs; the list is small,
    so that alignments stay where they are.
    """
    kept = alignments.where(usable(**filters)).where(~has(PAIRED) | anchors())
    placed = kept.join(local(contigs.select("chrom", "chrom_len")), "chrom")
    bounded = placed.withColumns(bounds(length) | {"strand": F.when(has(REVERSE), "-").otherwise("+")})
    return bounded.where("frg_len > 0 AND frg_end > frg_start").select("sample", "chrom", "frg_start", "frg_end", "frg_len", "strand", "qname", "mapq", "flag")


def with_contigs(alignments: DataFrame, contigs: DataFrame) -> DataFrame:
    """``alignments`` with chrom_len, null on other contigs."""
    return alignments.join(local(contigs.select("chrom", "chrom_len")), "chrom", "left")


def makes_fragment(length: int | Column | None = None, **filters: bool) -> Column:
    """Whether a record of ``with_contigs`` is one of those that ``fragments`` keeps, to count them in a pass over alignments."""
    at = bounds(length)
    made = usable(**filters) & (~has(PAIRED) | anchors()) & F.col("chrom_len").isNotNull() & (at["frg_len"] > 0) & (at["frg_end"] > at["frg_start"])
    return F.coalesce(made, F.lit(False))


def totals(frags: DataFrame) -> DataFrame:
    """(sample, frg_tot)."""
    return frags.groupBy("sample").agg(F.count("*").alias("frg_tot"))


def join_mates(records: DataFrame) -> DataFrame:
    """Fragments of records that come in pairs by name: from the first start to the later mate's last base, ends included."""
    grouped = records.groupBy("sample", "qname").agg(
        F.count("*").alias("n"), F.min("chrom").alias("chrom"), F.max("chrom").alias("other"), F.min("pos").alias("frg_start"),
        (F.max(F.struct("pos", "aln_len"))["pos"] + F.max(F.struct("pos", "aln_len"))["aln_len"] - 1).alias("frg_end"),
    )
    return grouped.where("n = 2 AND chrom = other").select("sample", "qname", "chrom", "frg_start", "frg_end", (F.col("frg_end") - F.col("frg_start") + 1).alias("frg_len"))


def fix_mates(records: DataFrame) -> DataFrame:
    """Records with mate_chrom, mate_pos and signed tlen filled from the other primary record of their name.

    The two primary records are told apart by position, then flag. A secondary or
    supplementary record gets what the primary record of its own read gets. A name
    without two primary records has nulls and tlen 0; mates on two contigs have tlen 0.
    """
    name = Window.partitionBy("sample", "qname")
    primary = ~has(SECONDARY) & ~has(SUPPLEMENTARY)
    place = F.struct("pos", "flag", "chrom", (F.col("pos") + F.col("aln_len")).alias("end"))
    ends = records.withColumns({"_a": F.min(F.when(primary, place)).over(name), "_b": F.max(F.when(primary, place)).over(name), "_n": F.count_if(primary).over(name)})
    read = lambda flag: flag.bitwiseAND(F.lit(READ_1 | READ_2))
    first = F.when(primary, place == F.col("_a")).otherwise((read(F.col("flag")) == read(F.col("_a.flag"))) | (read(F.col("flag")) != read(F.col("_b.flag"))))
    mated = ends.withColumns({"_first": first, "_mate": F.when(F.col("_n") > 1, F.when(first, F.col("_b")).otherwise(F.col("_a")))})
    span = F.greatest("_a.end", "_b.end") - F.least("_a.pos", "_b.pos")
    tlen = F.when((F.col("_n") > 1) & (F.col("_a.chrom") == F.col("_b.chrom")), F.when(F.col("_first"), span).otherwise(-span))
    filled = {"mate_chrom": F.col("_mate.chrom"), "mate_pos": F.col("_mate.pos"), "tlen": F.coalesce(tlen, F.lit(0)).cast("int")}
    return mated.withColumns(filled).drop("_a", "_b", "_n", "_first", "_mate")


def mark_duplicates(frags: DataFrame, marked: DataFrame | None = None) -> DataFrame:
    """Fragments with 0x400 in flag for all but the best of equal places: best mapping quality (null is the worst), then name, then flag.

    Rows alike in all of these are one record. Samples of ``marked`` (sample), whose
    files' headers say that duplicates have been marked, stay as they are. The best is
    found in two rounds over one scan: first among the fragments of a place and a salt
    of as many values as there are tasks, so that a place with very many fragments is
    spread over all of them; then among those rounds' winners, one a task at most.
    """
    place = ["sample", "chrom", "frg_start", "frg_end", "strand"]
    tasks = int(frags.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rank = F.struct((-F.coalesce("mapq", F.lit(-1))).alias("m"), F.col("qname").alias("q"), F.col("flag").alias("f"))
    best = lambda *keys: rank == F.min(rank).over(Window.partitionBy(*place, *keys))
    salted = frags.withColumn("_salt", F.pmod(F.xxhash64("qname", "flag"), F.lit(tasks)))
    won = salted.withColumn("_won", best("_salt")).withColumn("_turn", F.when(F.col("_won"), -1).otherwise(F.col("_salt")))
    joined = won.withColumn("_won", F.col("_won") & best("_turn"))  # who lost stays among the others of its salt
    if marked is not None:
        joined = joined.join(local(marked.select("sample").distinct().withColumn("_done", F.lit(True))), "sample", "left")
    done = F.coalesce("_done", F.lit(False)) if marked is not None else F.lit(False)
    flag = F.when(done | F.col("_won"), F.col("flag")).otherwise(F.col("flag").bitwiseOR(F.lit(DUPLICATE)))
    return joined.select(*[flag.alias(c) if c == "flag" else c for c in frags.columns])


def layouts(alignments: DataFrame) -> DataFrame:
    """(sample, layout): paired where any record is."""
    return alignments.groupBy("sample").agg(F.when(F.bool_or(has(PAIRED)), "paired").otherwise("single").alias("layout"))


def queryname_order(alignments: DataFrame) -> DataFrame:
    """Records of a name together and sorted, within partitions by sample and range of names, which stand in order."""
    return alignments.repartitionByRange("sample", "qname").sortWithinPartitions("sample", "qname", "flag")


def numbered_by_name(alignments: DataFrame, name: str = "place") -> DataFrame:
    """``alignments`` with ``name``: each record's number, from 1, in its sample's order by name, then flag."""
    from spantrack.operators.ordering import numbered

    return numbered(alignments, ["sample"], [F.col("qname").asc_nulls_first(), F.col("flag").asc_nulls_first()], name)


def coordinate_order(alignments: DataFrame) -> DataFrame:
    """Records sorted by sample, contig in genome order and position."""
    from spantrack.functions.scalars import genome_order

    return alignments.orderBy("sample", *genome_order(F.col("chrom"), F.col("pos")))
