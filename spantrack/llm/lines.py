"""Removal of repeated line runs by a suffix array over line ids.

Lines with a word are numbered within their document and named by hash; only names
found twice or more go on. A suffix starts at each such line. Its rank, the number
of suffixes that sort before all of its like, is found by distributed prefix
doubling: the rank of twice the length comes from the pair of ranks at the line and
at the line one length on, and pairs are counted before they are sorted, so that a
line found a million times is one row of the sort. A suffix leaves when its rank is
its own; doubling goes on until no rank is shared.

Longest common prefixes then come from the levels by binary descent. All suffixes
begin as one interval of length 0. At each step, from the longest down, the suffixes
of an interval that share the rank of that many lines more become an interval of
their own, which is so much longer; the first of them, by doc_id and line, stays
behind as its witness, so that shorter common prefixes with what is left are found
as well. An interval in which a suffix isn't the first place says how many of its
lines stand earlier, exactly. These are the repeated runs; one that isn't the rest of
the run a line before is maximal, and is deleted from ``min_lines`` lines or
``lone_words`` words in its first line on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spantrack.llm._spark import ranked, stored

#: A run counts from so many lines with a word, and a line of so many words (a passage's length in ``substrings``) counts alone.
MIN_LINES, LONE_WORDS = 2, 13
WORD = r"[^\x20\x09-\x0D]"


def _rid(doc_id: Column, text: Column) -> Column:
    """What names a document, in 128 bits of its doc_id and text."""
    return F.unhex(F.md5(F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("-")), F.coalesce(text, F.lit("")))))


def _base(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, lines): lines are the text's, null for null."""
    text = F.col("text").cast("string")
    return docs.select(_rid(F.col("doc_id"), text).alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.split(text, "\n", -1).alias("lines"))


def _positions(base: DataFrame, lone_words: int | None) -> DataFrame:
    """(rid, doc_id, seq, rank, long) of each line with a word that isn't the only one of its kind; rank sorts the names, long lines have ``lone_words``."""
    space = r"[\x20\x09-\x0D]"
    long = lambda x: x.rlike(rf"^{space}*+(?:{WORD}++{space}++){{{lone_words - 1}}}{WORD}") if lone_words else F.lit(False)
    words = F.filter("lines", lambda x: x.rlike(WORD))
    names = base.select("rid", "doc_id", F.transform(words, lambda x: F.struct(F.xxhash64(x).alias("h"), F.hash(x).alias("c"), long(x).alias("long"))).alias("names")).dropDuplicates(["rid"])
    lines = stored(names.select("rid", "doc_id", F.posexplode("names").alias("seq", "name")).select("rid", "doc_id", "seq", "name.h", "name.c", "name.long"))
    repeated = lines.groupBy("h", "c").agg(F.count("*").alias("n")).where("n > 1")
    names = stored(ranked(repeated, [F.col("h"), F.col("c")], "rank", "n"))  # both sides of the join are read afresh, so that Spark can split a hot name
    return stored(lines.join(names, ["h", "c"]).select("rid", "doc_id", "seq", F.lit(1).alias("length"), "rank", "long"))


def _doubled(positions: DataFrame) -> DataFrame:
    """Ranks over twice as many lines; what isn't repeated at that length leaves.

    The length is a column, so that every level runs the same compiled code.
    """
    ahead = positions.select("rid", (F.col("seq") - F.col("length")).alias("seq"), F.col("rank").alias("next"))
    pairs = stored(positions.join(ahead, ["rid", "seq"]))
    repeated = pairs.groupBy("rank", "next").agg(F.count("*").alias("n")).where("n > 1")
    named = ranked(repeated, [F.col("rank"), F.col("next")], "longer", "n")
    return stored(pairs.join(named, ["rank", "next"]).select("rid", "doc_id", "seq", (F.col("length") * 2).alias("length"), F.col("longer").alias("rank")))


def shared_ranks(base: DataFrame, lone_words: int | None = LONE_WORDS) -> list[DataFrame]:
    """(rid, doc_id, seq, length, rank) of the suffixes that share their rank, for lengths 1, 2, 4 and so on until none does."""
    ranks = [_positions(base, lone_words)]
    while not (longer := _doubled(ranks[-1])).isEmpty():
        ranks.append(longer)
    return ranks


def _place() -> Column:
    """The order of places: by document, null doc_id last, then by line."""
    return F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid", "seq")


def common_prefixes(ranks: list[DataFrame]) -> DataFrame:
    """(rid, doc_id, seq, long, shared, earlier): how many lines from each place on stand at another place too, and at an earlier one (0: none).

    An interval is named by its first place and length. A place belongs to one interval
    only, apart from witnesses, of which each interval adds one.
    """
    none = {"of_rid": F.lit(b""), "of_seq": F.lit(0), "length": F.lit(0)}
    columns, key = ["rid", "doc_id", "seq"], [*none]
    left = ranks[0].select(*columns).withColumns(none)
    every = ranks[0].select(*columns, F.lit(0).alias("length"), F.lit(False).alias("later"))
    for level in reversed(ranks):
        ahead = level.select(F.col("rid").alias("_rid"), F.col("seq").alias("_seq"), F.col("length").alias("step"), "rank")
        tried = stored(left.join(ahead, (F.col("rid") == F.col("_rid")) & (F.col("seq") + F.col("length") == F.col("_seq")), "left").drop("_rid", "_seq"))
        some = tried.where("rank IS NOT NULL")
        longer = stored(some.groupBy(*key, "rank").agg(F.count("*").alias("n"), F.min(_place()).alias("first")).where("n > 1").drop("n"))
        split = stored(some.join(longer, [*key, "rank"], "left"))  # both sides are read afresh, so that Spark can split a hot rank
        inner = split.where("first IS NOT NULL").select(*columns, F.col("first.rid").alias("of_rid"), F.col("first.seq").alias("of_seq"), (F.col("length") + F.col("step")).alias("length"), (_place() != F.col("first")).alias("later"))
        every = every.unionByName(inner.select(*columns, "length", "later"))
        witnesses = longer.select("first.rid", "first.doc_id", "first.seq", *key)
        left = inner.select(*columns, *key)
        for x in (tried.where("rank IS NULL"), split.where("first IS NULL"), witnesses):
            left = left.unionByName(x.select(*columns, *key))
    best = every.groupBy(*columns).agg(F.max("length").alias("shared"), F.max(F.when(F.col("later"), F.col("length")).otherwise(0)).alias("earlier"))
    long = ranks[0].select(F.col("rid").alias("_rid"), F.col("seq").alias("_seq"), "long")
    return stored(best.join(long, (F.col("rid") == F.col("_rid")) & (F.col("seq") == F.col("_seq"))).select(*columns, "long", "shared", "earlier"))


def maximal_runs(prefixes: DataFrame, min_lines: int = MIN_LINES, lone_words: int | None = LONE_WORDS) -> DataFrame:
    """(rid, doc_id, seq, n): the runs of n lines that stand at an earlier place too and aren't the rest of one that begins a line before."""
    along = Window.partitionBy("rid").orderBy("seq")  # a document's lines
    rest = (F.lag("seq").over(along) == F.col("seq") - 1) & (F.lag("earlier").over(along) == F.col("earlier") + 1)
    begins = prefixes.where("earlier > 0").withColumn("_rest", F.coalesce(rest, F.lit(False)))
    counts = F.col("earlier") >= min_lines
    # a long line counts alone, also within a run that is too short
    alone = F.col("long") & ~counts if lone_words else F.lit(False)
    whole = begins.where(counts & ~F.col("_rest")).select("rid", "doc_id", "seq", F.col("earlier").alias("n"))
    # the rest of a run that counted may be too short to count, and lies within it
    return whole.unionByName(begins.where(alone).select("rid", "doc_id", "seq", F.lit(1).alias("n"))) if lone_words else whole


def repeated_runs(docs: DataFrame, min_lines: int = MIN_LINES, lone_words: int | None = LONE_WORDS) -> DataFrame:
    """(doc_id, first_line, n_lines): the stretches that go, counted over lines with a word from 0.

    Null and empty texts have no lines with a word; documents of null doc_id come
    last; repeated rows of one doc_id and text are one document; an empty table gives
    no rows; other columns are not read.
    """
    runs = maximal_runs(common_prefixes(shared_ranks(_base(docs), lone_words)), min_lines, lone_words)
    covered = runs.select("rid", "doc_id", F.explode(F.sequence("seq", F.expr("seq + n - 1"))).alias("seq")).distinct()
    run = F.col("seq") - F.row_number().over(Window.partitionBy("rid").orderBy("seq"))
    return covered.withColumn("run", run).groupBy("rid", "doc_id", "run").agg(F.min("seq").alias("first_line"), F.count("*").alias("n_lines")).select("doc_id", "first_line", "n_lines")


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, removed: str | None = None, lone_words: int | None = LONE_WORDS, shared: str | None = None) -> DataFrame:
    """``docs`` with the later copies of repeated runs of ``min_lines`` or more lines deleted from text.

    A line of ``lone_words`` words or more is a run as well (None: no line is). Lines
    without a word take no part and stay; a null text stays null. Documents of null
    doc_id come after all others. Repeated rows of one doc_id and text are one document
    and come out alike. Other columns pass through, whatever their names; ``removed``
    names a column for the number of lines deleted, ``shared`` one for the length of
    the longest run of its lines that stands at another place too, in it or in another
    document (0: no line does). A document's lines are handled in one row.
    """
    columns = docs.columns
    prefixes = common_prefixes(shared_ranks(_base(docs), lone_words))
    starts = maximal_runs(prefixes, min_lines, lone_words).groupBy("rid").agg(F.collect_list(F.struct("seq", "n")).alias("_starts")).withColumnRenamed("rid", "_rid")
    if shared:
        longest = prefixes.groupBy(F.col("rid").alias("_rid3")).agg(F.max("shared").cast("long").alias("shared"))
        starts = longest.join(starts, longest._rid3 == starts._rid, "left").select(F.col("_rid3").alias("_rid"), "_starts", "shared")
    text = F.col("text").cast("string")
    packed = docs.select(F.struct(*[F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in columns]).alias("_row"), _rid(F.col("doc_id"), text).alias("_rid2"), F.split(text, "\n", -1).alias("_lines"))
    joined = packed.join(starts, packed._rid2 == starts._rid, "left")
    every = F.sequence(F.lit(0), F.size("_lines") - 1)
    worded = F.filter(F.transform("_lines", lambda x, i: F.when(x.rlike(WORD), i)), lambda i: i.isNotNull())
    marked = joined.withColumn("_worded", F.when(F.col("_starts").isNotNull(), worded))
    gone = F.array_distinct(F.flatten(F.transform("_starts", lambda s: F.slice("_worded", s["seq"] + 1, s["n"]))))
    kept = F.transform(F.array_except(every, F.col("_gone")), lambda i: F.get(F.col("_lines"), i))
    text = F.when(F.col("_gone").isNull(), F.array_join("_lines", "\n")).otherwise(F.array_join(kept, "\n"))
    added = [F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias(removed)] if removed else []
    added += [F.coalesce("shared", F.lit(0)).cast("long").alias(shared)] if shared else []
    return marked.withColumn("_gone", gone).select(*[text.alias(c) if c == "text" else F.col("_row").getField(c).alias(c) for c in columns], *added)
