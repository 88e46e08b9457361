"""Near copies by SimHash over segment popcounts, and what that misses, verified by exact Jaccard similarity.

Sets of shingles are candidates of each other where their SimHash fingerprints, over
these shingles, differ in 2 or fewer of 64 bits: ``simhash``'s grid of segment popcounts
finds those. Every candidate is verified exactly. But SimHash is coarse: at similarity
0.8 two fingerprints differ in about 10 bits, give or take 3, no radius is sure to reach
all, and at such a radius the bit counts of segments rule out next to nothing. So what
it misses comes from a prefix filter, which is complete. Shingles are ordered by the
number of documents that hold them, rarest first. A set of n shingles that is similar
to another at t or more shares at least t n of them, so the two meet in its first
n - ceil(t n) + 1 shingles; in the smaller set of the two, the first
n - ceil(2 t n / (1 + t)) + 1 are enough. A shingle of one document meets none but takes
its place in the prefix, which leaves few documents and only shared shingles.

Two lower bounds of the difference pass over most pairs that meet, both exact: the
places at which they meet first, and the Hamming distance of parity fingerprints of
512 bits, in which each shingle flips one bit. What is left is verified exactly.

Only components are wanted. A first round verifies the SimHash candidates, and each
document against one of those that it meets in a shingle. A second one takes the pairs
that lie in different components still: for a shingle, documents of its most frequent
component are compared with the others only, so that a large group of near copies costs
its size and not its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spantrack.llm._spark import cut, only, python_ready
from spantrack.llm.simhash import SEED, components, identified, with_components
from spantrack.llm.simhash import links as simhash_links

SHINGLE_WORDS, PERCENT = 5, 80
#: Words of 64 bits in a parity fingerprint.
BIT_WORDS = 8
#: The part of the hashes' range that is counted first; documents with too many shingles of their own in it leave.
FIRST_SLICE = 0.25


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """The distinct XXH64 hashes of a text's shingles of k words, sorted; fewer words form one shingle, none give none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_digest
    many = [b" ".join(x) for x in zip(*[words[i:] for i in range(k)], strict=False)] or [b" ".join(words)]
    return np.unique(np.frombuffer(b"".join([digest(x, SEED) for x in many]), np.uint64))


def parity(hashes: np.ndarray) -> np.ndarray:
    """The set's parity fingerprint: BIT_WORDS numbers in which each hash flips one bit."""
    odd = np.bincount((hashes >> np.uint64(20)).astype(np.int64) % (64 * BIT_WORDS), minlength=64 * BIT_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def simhash_of(hashes: np.ndarray) -> int:
    """The set's SimHash, as a signed number: a bit is set where over half of the hashes have it."""
    ones = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big", signed=True)


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(row, doc_id, text_hash, fp, sim, bits, hashes) of every document; row numbers the rows, fp names the set by 128 bits, sim is its SimHash, hashes are in two arrays by value."""
    edge = np.uint64(FIRST_SLICE * 2**64)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [shingles(x.as_py(), k) for x in batch.column(1).cast(pa.binary())]
            names = pa.array([xxhash.xxh3_128_digest(x.tobytes(), SEED) for x in got], pa.binary())
            counts, at = np.array([len(x) for x in got], np.int64), np.array([np.searchsorted(x, edge) for x in got], np.int64)
            starts = np.cumsum(counts) - counts
            inner = np.append(np.column_stack([starts, starts + at]).ravel(), counts.sum()).astype(np.int32)
            slices = pa.ListArray.from_arrays(inner, np.concatenate([np.empty(0, np.uint64), *got]).view(np.int64))
            hashes = pa.ListArray.from_arrays(np.arange(len(got) + 1, dtype=np.int32) * 2, slices)
            bits = pa.ListArray.from_arrays(np.arange(len(got) + 1, dtype=np.int32) * BIT_WORDS, np.concatenate([np.empty(0, np.int64), *map(parity, got)]))
            sims = pa.array([simhash_of(x) for x in got], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), names, sims, bits, hashes], ["doc_id", "text_hash", "fp", "sim", "bits", "hashes"])

    python_ready(docs.sparkSession)
    found = identified(docs).mapInArrow(sets, "doc_id long, text_hash long, fp binary, sim long, bits array<long>, hashes array<array<long>>")
    return cut(found.withColumn("row", F.monotonically_increasing_id()))


def _least_shared(n: str, numerator: int, denominator: int) -> Column:
    """n - ceil(n * numerator / denominator) + 1."""
    return F.expr(f"{n} - CAST(ceil({n} * {numerator}L / {denominator}D) AS INT) + 1")


NO_SHINGLES = "CAST(array() AS array<struct<df: bigint, h: bigint>>)"


def _sliced(left: DataFrame, part: DataFrame, i: int, percent: int) -> DataFrame:
    """The sets of ``left`` that can have a partner still, with their shared shingles and number of own ones in ``part``, their slice i."""
    every = part.select("row", F.explode("part").alias("h"))
    counts = cut(every.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"))  # both sides of the join are read afresh, so that Spark can split a hot shingle
    more = every.join(counts, "h").groupBy("row").agg(F.collect_list(F.struct("df", "h")).alias("more"))
    found = left.join(more, "row", "left").selectExpr("row", "fp", "sim", "bits", "sizes", "n", "own", "shared", f"coalesce(more, {NO_SHINGLES}) AS more")
    found = found.selectExpr("row", "fp", "sim", "bits", "sizes", "n", f"own + sizes[{i}] - size(more) AS own", "concat(shared, more) AS shared")
    return found.where(F.col("own") < _least_shared("n", percent, 100))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, fp, sim, n, own, bits, probe, index) of sets that can have a partner: size, number of shingles that are theirs alone, and the shared ones of both prefixes.

    The hashes' range is counted in two parts. A set leaves as soon as more of its
    shingles than a partner can lack are its own, and isn't counted in the second.
    Sets found more than once count as often, so that they stay; then one of them goes on.
    """
    first = sets.select("row", "fp", "sim", "bits", F.transform("hashes", F.size).alias("sizes")).selectExpr("row", "fp", "sim", "bits", "sizes", "sizes[0] + sizes[1] AS n", "0 AS own", f"{NO_SHINGLES} AS shared")
    left = cut(_sliced(first, sets.select("row", F.col("hashes")[0].alias("part")), 0, percent))
    rest = cut(only(sets.select("row", F.col("hashes")[1].alias("part")), left.select("row"), "row"))
    left = _sliced(left, rest, 1, percent)
    fits = left.withColumns({"p": _least_shared("n", percent, 100), "i": _least_shared("n", 2 * percent, 100 + percent), "shared": F.expr("transform(array_sort(shared), x -> x.h)")})
    return cut(fits.selectExpr("row AS node", "fp", "sim", "n", "own", "bits", "slice(shared, 1, p - own) AS probe", "slice(shared, 1, greatest(i - own, 0)) AS index").dropDuplicates(["fp"]))


def _entries(prefixes: DataFrame, which: str, name: str) -> DataFrame:
    """(h, <name>, <name>_n, <name>_at, <name>_bits, <name>_root): a row for each shingle of a prefix, with its place in the set."""
    return prefixes.select(F.posexplode(which).alias("at", "h"), "node", "n", "own", "bits", "root").select(
        "h", F.col("node").alias(name), F.col("n").alias(f"{name}_n"), (F.col("own") + F.col("at")).alias(f"{name}_at"), F.col("bits").alias(f"{name}_bits"), F.col("root").alias(f"{name}_root"), F.col("own").alias(f"{name}_own")
    )


def _may_match(percent: int) -> Column:
    """Whether a pair that meets in a shingle can be similar enough, by sizes, places and parity fingerprints."""
    both = F.col("a_n").cast("long") + F.col("b_n")
    apart = sum((F.bit_count(F.col("a_bits")[i].bitwiseXOR(F.col("b_bits")[i])).cast("long") for i in range(BIT_WORDS)), start=F.lit(0).cast("long"))
    sizes = 100 * F.least("a_n", "b_n").cast("long") >= percent * F.greatest("a_n", "b_n").cast("long")
    most = F.least(F.col("a_n") - F.col("a_at"), F.col("b_n") - F.col("b_at")).cast("long")
    return sizes & ((100 + percent) * most >= percent * both) & ((100 + percent) * apart <= (100 - percent) * both)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(fp, to) of the pairs (a, b) of nodes that are similar enough, the larger first."""
    one, two = (sets.select(F.col("node").alias(x), F.col("hashes").alias(f"{x}_hashes")) for x in "ab")
    both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().join(one, "a").join(two, "b")
    met = both.withColumn("met", F.size(F.array_intersect("a_hashes", "b_hashes")).cast("long"))
    return met.where(f"100 * met >= {percent} * (size(a_hashes) + size(b_hashes) - met)").select(F.col("a").alias("fp"), F.col("b").alias("to"))


def _simhash_pairs(prefixes: DataFrame) -> DataFrame:
    """Pairs of sets whose SimHashes link: each with the first set of its fingerprint, and the first sets of linked fingerprints."""
    firsts = cut(prefixes.groupBy("sim").agg(F.min("node").alias("first")))
    alike = prefixes.join(firsts, "sim").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    one, two = (firsts.select(F.col("sim").alias(c), F.col("first").alias(x)) for c, x in (("fp", "a"), ("to", "b")))
    return alike.unionByName(simhash_links(firsts.select(F.col("sim").alias("fp"))).join(one, "fp").join(two, "to").select("a", "b"))


def _stars(prefixes: DataFrame, percent: int) -> DataFrame:
    """Pairs of each document and, for each shingle of its prefix, the one with fewest shingles of its own."""
    probe, index = _entries(prefixes, "probe", "a"), _entries(prefixes, "index", "b")
    hub = F.min(F.struct("b_own", "b", "b_n", "b_at", "b_bits")).alias("hub")
    return probe.join(index.groupBy("h").agg(hub).select("h", "hub.*"), "h").where("a <> b").where(_may_match(percent)).select("a", "b")


def _rest(prefixes: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that meet in a shingle and may match; of a shingle's most frequent component no two members are paired."""
    probe, index = cut(_entries(prefixes, "probe", "a")), _entries(prefixes, "index", "b")
    by_root = probe.groupBy("h", "a_root").agg(F.count("*").alias("k"))  # the index is part of the probe
    tops = cut(by_root.groupBy("h").agg(F.max_by("a_root", "k").alias("top"), F.count("*").alias("roots")).where("roots > 1").select("h", "top"))
    probe, index = probe.join(tops, "h"), index.join(tops, "h")
    ordered = (F.col("a_root") != F.col("b_root")) & (F.struct("b_n", "b") < F.struct("a_n", "a")) & _may_match(percent)
    met = lambda a, b: a.drop("top").join(b.drop("top"), (a.h == b.h) & ordered).select("a", "b")
    return met(probe.where("a_root <> top"), index).union(met(probe.where("a_root = top"), index.where("b_root <> top")))


def near(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every document, and (node, root) of the sets that are tied to another one: what is similar at percent or more is connected."""
    sets = shingle_sets(docs, k)
    prefixes = _prefixes(sets, percent)
    found = cut(only(sets, prefixes.select(F.col("node").alias("row")), "row").select(F.col("row").alias("node"), F.flatten("hashes").alias("hashes")))
    alone = prefixes.withColumn("root", F.col("node"))
    stars = cut(_verified(_simhash_pairs(prefixes).unionByName(_stars(alone, percent)), found, percent))
    roots = cut(components(stars))
    rooted = cut(prefixes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    links = _verified(_rest(rooted, percent), found, percent)
    named = prefixes.select("node", "fp")
    final = components(roots.select(F.col("node").alias("fp"), F.col("root").alias("to")).where("fp <> to").union(links))
    by_name = final.join(named, "node").select("root", F.col("fp").alias("own")).join(named, F.col("root") == named.node)
    return sets.select("doc_id", "text_hash", "fp"), cut(by_name.select(F.col("own").alias("node"), F.col("fp").alias("root")))


def near_copies(docs: DataFrame, k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, fingerprint (32 hex digits, the same for the same shingles), component_id.

    component_id is the smallest doc_id reachable over pairs whose sets of shingles of
    k words have a Jaccard similarity of percent / 100 or more. Null and empty texts
    are alike; nulls and repeated rows as in ``simhash.near_duplicates``; an empty
    table gives no rows; other columns are not read.
    """
    return with_components(*near(docs, k, percent), digits=32)
