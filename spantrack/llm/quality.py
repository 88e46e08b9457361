"""Quality rules as a short-circuit cascade.

Every rule tests a few measures of the text. On a bounded sample of the documents
each rule is tried alone: that gives its selectivity (the share it rejects), the
measures it needs and the CPU time that each of these takes. Rules then run in order
of rejections per cost, where measures that an earlier rule has taken cost nothing,
and a document leaves at the first rule that rejects it, with the measures of later
rules never taken. The order changes the work and ``rejected_by``, never which
documents are kept; as it follows measured times, it may differ between runs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.llm._spark import python_ready

#: Documents in the sample from which the order of rules is estimated.
SAMPLE_ROWS = 2000
SYMBOLS = b"#*$%&|<>"
CONTINUATION = bytes(range(0x80, 0xC0))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def _repeat_words(m: Measures) -> int:
    windows = list(zip(m.words, m.words[1:], m.words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: set = set()
    twice = {x for x in windows if x in seen or seen.add(x)}
    last, total = -1, 0
    for i in compress(range(len(windows)), [x in twice for x in windows]):
        total += min(3, i + 2 - last)
        last = i + 2
    return total


#: How each measure is taken; measures may use others.
TAKE: dict[str, Callable[[Measures], object]] = {
    "words": lambda m: m.text.split(),
    "body": lambda m: b"".join(m.words),
    "lines": lambda m: [x for x in m.text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")],
    "n_words": lambda m: len(m.words),
    "word_chars": lambda m: len(m.body.translate(None, CONTINUATION)),
    "n_symbols": lambda m: len(m.body) - len(m.body.translate(None, SYMBOLS)),
    "n_lines": lambda m: len(m.lines),
    "n_dup_lines": lambda m: len(m.lines) - len(set(m.lines)),
    "n_repeat_words": _repeat_words,
}


class Measures:
    """Measures of one text (null: empty), each taken when first asked for."""

    def __init__(self, text: bytes | None):
        self.text = text or b""

    def __getattr__(self, name: str) -> object:
        if name not in TAKE:
            raise AttributeError(name)
        value = self.__dict__[name] = TAKE[name](self)
        return value


class Timed(Measures):
    """Measures that add the CPU nanoseconds of each one, without those of the measures that it uses, to ``spent``."""

    def __init__(self, text: bytes | None, spent: dict[str, int]):
        super().__init__(text)
        self.spent, self.inner = spent, 0

    def __getattr__(self, name: str) -> object:
        outside, self.inner, began = self.inner, 0, time.thread_time_ns()
        value = super().__getattr__(name)
        took = time.thread_time_ns() - began
        self.spent[name] = self.spent.get(name, 0) + took - self.inner
        self.inner = outside + took
        return value


@dataclass(frozen=True)
class Rule:
    """``rejects`` looks at measures; what they cost is measured."""

    name: str
    rejects: Callable[[Measures], bool]


#: What the base verdict is made of.
BASE = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 50 * m.n_words),
)
#: Symbol noise, repeated lines and words of no plausible length come on top.
RULES = (
    *BASE,
    Rule("symbols", lambda m: 20 * m.n_symbols > m.word_chars),
    Rule("repeated_lines", lambda m: 2 * m.n_dup_lines > m.n_lines),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
)


def _texts(batch: pa.RecordBatch) -> list[Measures]:
    return [Measures(x.as_py()) for x in batch.column("text").cast(pa.binary())]


def trials(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> dict[str, tuple[int, dict[str, int]]]:
    """Of each rule, tried alone on the ``sample_rows`` documents of least hash: how many it rejects, and the CPU nanoseconds of each measure that it takes.

    A row for each rule and measure reaches the driver. Null and empty texts count
    as texts, repeated rows once; an empty table gives no rejections and no measures.
    """

    def trial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [x.as_py() for x in batch.column("text").cast(pa.binary())]
            for r in rules:
                spent: dict[str, int] = {}
                rejected = sum(bool(r.rejects(Timed(x, spent))) for x in texts)
                names = [None, *spent]
                yield pa.RecordBatch.from_arrays([pa.array([r.name] * len(names)), pa.array(names, pa.string()), pa.array([rejected, *spent.values()], pa.int64())], ["rule", "measure", "n"])

    python_ready(docs.sparkSession)
    hashed = docs.select(F.col("text").cast("string"), F.xxhash64("doc_id", "text").alias("h"))
    least = hashed.select("h").distinct().orderBy("h").limit(sample_rows)
    sample = hashed.join(F.broadcast(least), "h", "left_semi").dropDuplicates(["h"]).select("text")  # sample_rows hashes at most
    sums = sample.mapInArrow(trial, "rule string, measure string, n long").groupBy("rule", "measure").agg(F.sum("n").alias("n")).collect()
    found: dict[str, tuple[int, dict[str, int]]] = {r.name: (0, {}) for r in rules}
    for s in sums:
        if s["measure"] is None:
            found[s["rule"]] = s["n"], found[s["rule"]][1]
        else:
            found[s["rule"]][1][s["measure"]] = s["n"]
    return found


def order_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """Rules by rejections per measured cost, one after the other: a rule costs what its measures took that none before it has taken.

    Ties (rules that reject nothing in the sample, an empty sample) go by less cost,
    then as given.
    """
    found = trials(docs, rules, sample_rows)
    ordered: list[Rule] = []
    taken: set[str] = set()
    while rest := [r for r in rules if r not in ordered]:
        cost = {r.name: sum(n for m, n in found[r.name][1].items() if m not in taken) for r in rest}
        ordered.append(min(rest, key=lambda r: (-found[r.name][0] / max(cost[r.name], 1), cost[r.name])))
        taken |= set(found[ordered[-1].name][1])
    return tuple(ordered)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Per document doc_id, base_failed, rejected_by and kept, with the ``measures`` asked for in between.

    The verdict takes measures only as far as it needs; those asked for are taken of
    every document beside it, and so are base_failed's. Null and empty texts have no
    words and fail; a null doc_id stays null; repeated rows are judged alike; an
    empty table gives no rows; other columns are not read.
    """
    ordered = order_rules(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _texts(batch)
            by = [next((r.name for r in ordered if r.rejects(m)), None) for m in found]
            failed = [any(r.rejects(m) for r in BASE) for m in found]
            columns = [pa.array([getattr(m, x) for m in found], pa.int64()) for x in measures]
            verdict = [pa.array(failed, pa.bool_()), pa.array(by, pa.string()), pa.array([x is None for x in by], pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, *verdict], ["doc_id", *measures, "base_failed", "rejected_by", "kept"])

    out = ", ".join(["doc_id long", *[f"{x} long" for x in measures], "base_failed boolean, rejected_by string, kept boolean"])
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, out)


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents that no rule rejects, with all their columns; measures are taken only as far as needed.

    Null, empty and very short texts go; repeated rows stay or go alike; rows of null
    doc_id are judged as others; an empty table gives no rows; other columns pass
    through, whatever their names.
    """
    ordered = order_rules(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not any(r.rejects(m) for r in ordered) for m in _texts(batch)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
