"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are handed out in blocks of equal size. A source's target follows from its
weight; the mix's blocks go to sources by the highest quotients target / (2k - 1),
and a source's blocks to its shards in the same way with the shards' sizes as
votes, so that every shard has an integer quota. A shard's documents form a ring
in an order seeded by hash; the shard's blocks are the run of that length from
the ring's start, at most twice round, so that documents are taken whole but
for the run's end. Only the list of sources is handled as a table of its own:
documents are dealt to shards of bounded size, however large their source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spantrack.llm._spark import FEW_IDS, cut, numbered, ranked

WEIGHTS = (3, 1, 2)
#: Percent of all words that the mix holds, and how often a source may be repeated.
SHARE, REPEATS = 150, 2
#: Words in a block, words in a shard (about), and the seed of the order in a shard.
BLOCK_WORDS, SHARD_WORDS, SEED = 8, 1_000_000, 17
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, text_hash); size is the number of words, 0 for null."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), size.alias("size"), F.xxhash64(text).alias("text_hash"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = SHARE, repeats: int = REPEATS) -> DataFrame:
    """(place, source, source_size, target): water-filling under the cap of ``repeats`` times a source's size.

    ``place`` numbers the sources by code point, null last. Each pass gives the
    uncapped sources what is left by weight and caps those that would go above;
    one row of sums a pass reaches the driver.
    """
    sources = ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")), [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = cut(sources.select("place", "source", "source_size", weight.alias("weight"), (F.col("source_size") * float(repeats)).alias("cap")))
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * share / 100
    level, capped = 0.0, -1
    while True:
        full = F.col("weight") * level > F.col("cap")
        sums = rows.agg(F.sum(F.when(full, F.col("cap"))).alias("cap"), F.sum(F.when(~full, F.col("weight"))).alias("weight"), F.count_if(full).alias("n")).first()
        if not sums["weight"] or sums["n"] == capped:
            break
        level, capped = (total - (sums["cap"] or 0.0)) / sums["weight"], sums["n"]
    return rows.select("place", "source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def apportion(rows: DataFrame, group: str, key: str, votes: str, seats: str) -> DataFrame:
    """``rows`` with ``quota``: each group's ``seats`` by the highest quotients votes / (2k - 1).

    With V votes in all, n rows and S seats, a row of v votes gets at least
    round(v / V * (S - n/2)) - 1 seats and at most round(v / V * (S + n/2)) + 1, so
    that only the quotients between, a few a row, are ranked, by range over many
    tasks. Ties go to the smaller key. Rows without votes get no seats.
    """
    stats = rows.groupBy(group).agg(F.sum(votes).cast("double").alias("_v"), F.count("*").alias("_n"))
    ratio = F.when(F.col("_v") > 0, F.col(votes) / F.col("_v")).otherwise(0.0)
    low = F.greatest(F.floor(ratio * (F.col(seats) - F.col("_n") / 2.0) + 0.5) - 1, F.lit(0)).cast("long")
    high = F.when(F.col(votes) > 0, F.floor(ratio * (F.col(seats) + F.col("_n") / 2.0) + 0.5) + 1).otherwise(0).cast("long")
    bounds = cut(rows.join(stats, group).withColumns({"_low": low, "_high": high}))
    quotients = bounds.where("_high > _low").withColumn("_k", F.explode(F.sequence(F.col("_low") + 1, "_high"))).withColumn("_q", F.col(votes) / (2.0 * F.col("_k") - 1.0))
    order = [F.col(group).asc(), F.col("_q").desc(), F.col(key).asc(), F.col("_k").asc()]
    placed = cut(ranked(quotients.select(group, key, "_q", "_k", seats), order, "_place"))
    starts = placed.groupBy(group).agg(F.min("_place").alias("_start"))
    given = bounds.groupBy(group).agg(F.sum("_low").alias("_given"))
    won = placed.join(starts.join(given, group), group).where(F.col("_place") - F.col("_start") < F.col(seats) - F.col("_given"))
    extra = won.groupBy(group, key).agg(F.count("*").alias("_extra"))
    return bounds.join(extra, [group, key], "left").select(*rows.columns, (F.col("_low") + F.coalesce("_extra", F.lit(0))).alias("quota"))


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: int = SHARE, repeats: int = REPEATS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, text_hash.

    ``taken`` counts the words that the mix takes of the document, repeats counted.
    Documents without words (null and empty texts) take nothing; null sources are
    one source; repeated rows are documents of their own; an empty table gives no
    rows; other columns are not read. Reruns over the same rows agree.
    """
    sized = cut(numbered(sizes(docs), ["doc_id", "source", "text_hash"], "copy"))  # repeated rows are dealt one by one
    sources = cut(targets(sized, weights, share, repeats))
    total = sources.agg(F.sum("target")).first()[0] or 0.0
    by_source = apportion(sources.withColumns({"_all": F.lit(0), "_blocks": F.lit(round(total / block_words)).cast("long")}), "_all", "place", "target", "_blocks")
    by_source = cut(by_source.select("place", "source", "source_size", "target", F.col("quota").alias("blocks")))
    shards = F.ceil(F.col("source_size") / shard_words).cast("long")
    order = F.xxhash64(F.lit(seed), "doc_id", "text_hash")
    order = F.when(F.col("copy") > 0, F.xxhash64(order, "copy")).otherwise(order)
    known = F.broadcast(by_source) if by_source.count() <= FEW_IDS else by_source  # a row per source: documents stay where they are
    dealt = sized.join(known, sized.source.eqNullSafe(known.source)).drop(known.source)
    dealt = dealt.withColumn("_order", order).withColumn("shard", F.when(F.col("size") > 0, F.pmod(F.xxhash64(F.lit(seed + 1), "_order"), shards)))
    rings = dealt.where("shard IS NOT NULL").groupBy("place", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    quotas = apportion(rings, "place", "shard", "shard_size", "blocks").select(F.col("place").alias("_p"), F.col("shard").alias("_s"), "shard_size", "quota")
    placed = dealt.where("shard IS NOT NULL").join(quotas, (F.col("place") == F.col("_p")) & (F.col("shard") == F.col("_s")))
    ring = Window.partitionBy("place", "shard").orderBy("_order", "doc_id", "text_hash", "copy").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("size").over(ring), F.lit(0))
    length = F.least(F.col("quota") * block_words, F.col("shard_size") * repeats)
    rounds, rest = F.floor(length / F.col("shard_size")), F.pmod(length, F.col("shard_size"))
    taken = rounds * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_begin")))
    columns = ["doc_id", "source", "size", "source_size", "target", "taken", "text_hash"]
    some = placed.withColumn("_begin", begin).withColumn("taken", taken.cast("long")).select(*columns)
    return some.unionByName(dealt.where("shard IS NULL").withColumn("taken", F.lit(0).cast("long")).select(*columns))


def take(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, with all its columns.

    Where only some words are left to take, one more row holds the text up to the
    last of them. Repeated rows of one doc_id, source and text share what they take
    as evenly as whole copies allow. Documents that are not taken go, among them
    those of null and empty text. Null sources are one source; an empty table gives
    no rows; other columns pass through, whatever their names.
    """
    columns = docs.columns
    text = F.col("text").cast("string")
    others = F.struct(*[F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in columns])
    packed = docs.select(others.alias("_other"), text.alias("_text"), F.col("doc_id").cast("long").alias("_id"), F.col("source").cast("string").alias("_from"), F.xxhash64(text).alias("_hash"))
    found = cut(
        mixed(docs, **options).groupBy("doc_id", "source", "text_hash")
        .agg(F.sum("taken").alias("_taken"), F.max("size").alias("_size"), F.count("*").alias("_rows")).where("_taken > 0")
    )
    keys = [F.col("_id").eqNullSafe(F.col("doc_id")), F.col("_from").eqNullSafe(F.col("source")), F.col("_hash") == F.col("text_hash")]
    again = found.where("_rows > 1")
    joined = packed.join(found.where("_rows = 1"), keys).withColumn("_row", F.lit(1).cast("long"))
    if not again.isEmpty():
        same = numbered(packed.join(again, keys, "left_semi"), ["_id", "_from", "_hash"], "_row")
        joined = joined.unionByName(same.withColumn("_row", F.col("_row") + 1).join(again, keys))
    whole, rest = F.floor(F.col("_taken") / F.col("_size")), F.col("_taken") % F.col("_size")
    copies = F.floor(whole / F.col("_rows")) + F.when(F.col("_row") <= whole % F.col("_rows"), 1).otherwise(0)
    cut_here = F.when((F.col("_row") == F.col("_rows")) & (rest > 0), rest)
    words = F.regexp_extract_all("_text", F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    full = F.array_repeat(F.lit(-1).cast("long"), copies.cast("int"))
    parts = F.when(cut_here.isNotNull(), F.concat(full, F.array(cut_here))).otherwise(full)
    spread = joined.withColumn("_part", F.explode(parts))
    kept = F.when(F.col("_part") < 0, F.col("_text")).otherwise(F.array_join(F.slice(words, F.lit(1), F.col("_part").cast("int")), ""))
    return spread.select(*[kept.alias(c) if c == "text" else F.col("_other").getField(c).alias(c) for c in columns])
