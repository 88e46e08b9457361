"""Removal of passages that documents share, by repeated-phrase automata.

A passage counts from 13 words. Documents are dealt once to shards of about 2 MB,
and all that is compared between documents is a row per shard, so that a passage
found in any number of documents costs a shard one row.

Of every window of 13 consecutive words one phrase of 4 words, the one of least
hash, stands for it; equal windows have equal phrases, so that a window can only
recur where its phrase occurs in two different texts. Among the windows of such
phrases the recurring ones are confirmed by two hashes of 64 and 31 bits over
independent hashes of their words, together with the smallest doc_id that has them. Each shard then compiles the confirmed passages that
occur in it, one copy each, into Aho-Corasick automata over its words, and every
document of the shard is streamed through to locate every occurrence. Exact copies
of a text are settled by the text's digest and take part only as their first copy.
"""

from __future__ import annotations

import hashlib
import re
from itertools import compress

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spantrack.llm._spark import cut, partitions, python_ready
from spantrack.llm._text import U, Words, mix, sliding_min, spans_hash, words_of

WINDOW, PHRASE = 13, 4
SPAN = WINDOW - PHRASE + 1
SHARD_BYTES = 2 << 20
#: Shards in a partition, on average: partitions grow with the texts, so that tasks don't.
SHARDS_TOGETHER = 2
#: Passages in one automaton (a shard with more compiles several, one after the other), and letters of an alphabet.
AUTOMATON_PASSAGES, LETTERS = 20_000, 40
#: Shards from which a phrase's or passage's rows are spread over tasks (a shard has one at most).
HOT_SHARDS = 1_000_000
_FACTORS = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
_WINDOW_BASE, _CHECK_BASE = 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


class _Slice:
    """Phrase hashes of some texts and which windows lie within one text."""

    def __init__(self, words: Words):
        self.words, self.hashes, self.doc = words, words.hashes(), words.of()
        n = len(self.hashes)
        self.empty = n < WINDOW
        if self.empty:
            return
        h = self.hashes
        self.phrase = mix(sum((h[i : n - PHRASE + 1 + i] * U(f) for i, f in enumerate(_FACTORS)), start=np.zeros(n - PHRASE + 1, U)))
        self.least = sliding_min(self.phrase, SPAN)
        self.valid = self.doc[: n - WINDOW + 1] == self.doc[WINDOW - 1 :]

    def standing(self) -> np.ndarray:
        """Words at which a phrase begins that stands for some window."""
        inverted = np.where(self.valid, ~self.least, _TOP)
        pad = np.full(SPAN - 1, _TOP)
        return np.flatnonzero(sliding_min(np.concatenate([pad, inverted, pad]), SPAN) == ~self.phrase)

    def windows(self, flagged: np.ndarray) -> np.ndarray:
        """Words at which windows begin whose phrase is flagged."""
        some = np.full(len(self.phrase), _TOP)
        some[flagged] = self.phrase[flagged]
        return np.flatnonzero(self.valid & (sliding_min(some, SPAN) == self.least))


def _phrases(docs: pa.Table) -> pa.Table:
    """A shard's phrases, each with the least and the greatest text_id that has it."""
    phrase, text_id = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    texts = docs.column("text_id").to_numpy()
    for words in words_of(docs.column("text")):
        part = _Slice(words)
        if not part.empty:
            at = part.standing()
            phrase.append(part.phrase[at])
            text_id.append(texts[words.row + part.doc[at]])
    phrase, text_id = np.concatenate(phrase).view(np.int64), np.concatenate(text_id)
    first, last = _ends(phrase, text_id)
    order = np.argsort(first)  # rows of one text together, which packs well
    first, last = first[order], last[order]
    shard = np.full(len(first), docs.column("shard")[0].as_py())
    return pa.table({"phrase": phrase[first], "shard": shard, "low": text_id[first], "high": text_id[last]})


def _ends(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first and last row of each group; the last key orders rows within the groups of the others."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys[:-1]:
        new[1:] |= k[order[1:]] != k[order[:-1]]
    starts = np.flatnonzero(new)
    return order[starts], order[np.append(starts[1:], len(order))[: len(starts)] - 1]


def _windows(docs: pa.Table, flags: pa.Table) -> pa.Table:
    """A shard's windows whose phrase is flagged, each with the smallest and greatest doc_id and a place in the former."""
    value, copied = flags.column("value").to_numpy(), flags.column("first").is_valid().to_numpy(zero_copy_only=False)
    phrases, copies = np.sort(value[~copied]), value[copied]
    rids = docs.column("rid").to_numpy()
    part_of = docs.column("doc_id").is_valid().to_numpy(zero_copy_only=False) & ~np.isin(rids, copies)
    ids = docs.column("doc_id").fill_null(0).to_numpy()
    none = np.zeros(0, np.int64)
    found = [(none, none, none, none)]
    for words in words_of(docs.column("text")) if len(phrases) else ():
        part = _Slice(words)
        if part.empty:
            continue
        own = part.phrase.view(np.int64)
        near = np.minimum(np.searchsorted(phrases, own), len(phrases) - 1)
        at = part.windows(np.flatnonzero(phrases[near] == own))
        at = at[part_of[words.row + part.doc[at]]]
        row = part.doc[at]
        key = spans_hash(part.hashes, at, at + WINDOW, _WINDOW_BASE).view(np.int64)
        others = words.hashes(other=True) if len(at) else part.hashes  # words that the first hash takes for one are told apart
        check = (spans_hash(others, at, at + WINDOW, _CHECK_BASE) >> U(33)).astype(np.int64)
        found.append((key, check, words.row + row, at - words.first[row]))
    key, check, row, at = (np.concatenate(x) for x in zip(*found, strict=True))
    first, last = _ends(key, check, ids[row])
    order = np.argsort(first)
    first, last = first[order], last[order]
    columns = {"key": key[first], "check": check[first].astype(np.int32), "rid": rids[row[first]], "at": at[first].astype(np.int32), "own_first": ids[row[first]], "own_last": ids[row[last]]}
    return pa.table(columns)


def _copies(base: DataFrame) -> DataFrame:
    """(rid, first): documents whose whole text is also that of a smaller doc_id."""
    texts = base.select("rid", "doc_id", F.md5("text").alias("digest"))
    firsts = cut(texts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("digest", "first"))
    return texts.join(firsts, "digest").where("doc_id > first").groupBy("rid").agg(F.min("first").alias("first"))


def _ends_of(rows: DataFrame, keys: list[str], low: str, high: str, shards: int, hot_shards: int) -> DataFrame:
    """``rows``, at most one for each shard and ``keys``, with first and last: the least ``low`` and greatest ``high`` of equal keys.

    Keys of more than ``hot_shards`` rows, at most one for so many rows, are found by map-side
    sums first and broadcast with their ends; their rows are dealt by shard as well.
    """
    ends = {"first": F.min(low), "last": F.max(high)}
    if shards <= hot_shards:  # no key can have more rows
        own = Window.partitionBy(*keys)
        return rows.withColumns({c: x.over(own) for c, x in ends.items()})
    sums = rows.groupBy(*keys).agg(F.count("*").alias("n"), *[x.alias(f"_{c}") for c, x in ends.items()])
    hot = cut(sums.where(F.col("n") > hot_shards).drop("n"))
    own = Window.partitionBy(*keys, F.when(F.col("_first").isNotNull(), F.col("shard")))
    marked = rows.join(F.broadcast(hot), keys, "left")
    return marked.withColumns({c: F.coalesce(f"_{c}", x.over(own)) for c, x in ends.items()}).drop(*[f"_{c}" for c in ends])


def _flags(base: DataFrame, shards: int, hot_shards: int) -> DataFrame:
    """(shard, value, first): phrases that occur in two different texts, for each shard that has them."""
    phrases = base.groupBy("shard").applyInArrow(_phrases, "phrase long, shard long, low long, high long")
    seen = _ends_of(phrases, ["phrase"], "low", "high", shards, hot_shards)
    return seen.where("first < last").select("shard", F.col("phrase").alias("value"), F.lit(None).cast("long").alias("first"))


def _passages(base: DataFrame, flags: DataFrame, shards: int, hot_shards: int) -> DataFrame:
    """(shard, rid, at, first): recurring windows, once for each shard, with the smallest doc_id that has them."""
    out = "key long, check int, rid long, at int, own_first long, own_last long"
    windows = base.groupBy("shard").cogroup(flags.groupBy("shard")).applyInArrow(_windows, out)
    seen = _ends_of(windows.withColumn("shard", F.pmod("rid", F.lit(shards))), ["key", "check"], "own_first", "own_last", shards, hot_shards)
    return seen.where("first < own_last").select("shard", "rid", "at", "first")


_known_run = re.compile(b"\\x01{%d,}" % WINDOW)


def _codes(words: set[bytes]) -> tuple[dict[bytes, str], int]:
    """Words as strings of one width over small alphabets, one alphabet for each place.

    The automaton looks through a node's children one by one, so that a letter of
    its own for every word would make its root slow.
    """
    width = 1
    while LETTERS**width < len(words):
        width += 1
    return {x: "".join([chr(1 + p * LETTERS + n // LETTERS**p % LETTERS) for p in range(width)]) for n, x in enumerate(sorted(words))}, width


def _located(docs: pa.Table, passages: pa.Table, texts: bool) -> pa.Table:
    """Stream a shard's documents through the automata of its passages."""
    words = [(x.as_py() or b"").split() for x in docs.column("text").cast(pa.binary())]
    doc_ids, rids = docs.column("doc_id").to_pylist(), docs.column("rid").to_pylist()
    marks = [bytearray(len(x)) for x in words]
    whole: set[int] = set()
    rows = dict(zip(rids, range(len(rids)), strict=True))
    found = [x for x in zip(*(passages.column(c).to_pylist() for c in ("rid", "at", "first")), strict=True) if x[1] >= 0 or whole.add(x[0])]
    for begin in range(0, len(found), AUTOMATON_PASSAGES):
        batch = [(words[rows[rid]][at : at + WINDOW], first) for rid, at, first in found[begin : begin + AUTOMATON_PASSAGES]]
        codes, width = _codes({x for passage, _ in batch for x in passage})
        automaton = ahocorasick.Automaton()
        for passage, first in batch:
            automaton.add_word("".join([codes[x] for x in passage]), first)
        automaton.make_automaton()
        for own, doc_id, mark in zip(words, doc_ids, marks, strict=True):
            if doc_id is None:
                continue
            for run in _known_run.finditer(bytes(map(codes.__contains__, own))):  # no passage holds an unknown word
                a, b = run.span()
                for end, first in automaton.iter("".join([codes[x] for x in own[a:b]])):
                    if first < doc_id:
                        mark[(at := a + end // width - WINDOW + 1) : at + WINDOW] = b"\1" * WINDOW
    out = {"doc_id": doc_ids, "n_words": [len(x) for x in words], "n_removed": [], "kept_sha256": [], "kept": []}
    for own, mark, rid in zip(words, marks, rids, strict=True):
        if rid in whole and len(own) >= WINDOW:
            mark[:] = b"\1" * len(mark)
        removed = sum(mark)
        kept = b" ".join(compress(own, [not x for x in mark]) if removed else own)
        out["n_removed"].append(removed)
        out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
        out["kept"].append(kept.decode("utf-8", "replace") if texts else None)
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.table([pa.array(x, t) for x, t in zip(out.values(), kinds, strict=True)], names=list(out))


def removed(docs: DataFrame, texts: bool = True, shard_bytes: int = SHARD_BYTES, hot_shards: int = HOT_SHARDS) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and, where ``texts``, kept (its kept words joined by spaces).

    A word goes if a window of 13 words covers it whose words also start in a
    document with a smaller doc_id. Null and empty texts have no words; a document
    without doc_id keeps all its words and takes none from others; repeated rows
    of one doc_id keep alike; an empty table gives no rows; other columns are not
    read. A phrase or passage that is found in more than ``hot_shards`` shards is settled
    by sums and a broadcast, so that no task gets all its rows.
    """
    python_ready(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long"), text.alias("text")).withColumns({"rid": F.xxhash64("doc_id", "text"), "text_id": F.xxhash64("text")})
    shards = max(1, -(-(base.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    base = base.withColumn("shard", F.pmod("rid", F.lit(shards)))
    parts = max(-(-shards // SHARDS_TOGETHER), partitions(docs.sparkSession))
    copies = cut(_copies(base)).withColumn("shard", F.pmod("rid", F.lit(shards)))
    base = base.repartition(parts, "shard")
    flags = _flags(base, shards, hot_shards).unionByName(copies.select("shard", F.col("rid").alias("value"), "first"))
    passages = _passages(base, flags, shards, hot_shards).unionByName(copies.select("shard", "rid", F.lit(-1).alias("at"), "first"))
    # one plan from here: its three passes over the shards read one and the same shuffle of the texts
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    result = base.groupBy("shard").cogroup(passages.groupBy("shard")).applyInArrow(lambda a, b: _located(a, b, texts), out)
    return result if texts else result.drop("kept")
