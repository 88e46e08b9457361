import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from spantrack.llm import _text, substrings
from tests.llm.docs import documents, frame


def brute(rows):
    words = [(r[1] or "").encode().split() for r in rows]
    first = {}
    for r, w in zip(rows, words):
        for i in range(len(w) - 12 if r[0] is not None else 0):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r, w in zip(rows, words):
        gone = {j for i in range(len(w) - 12 if r[0] is not None else 0) if first[tuple(w[i : i + 13])] < r[0] for j in range(i, i + 13)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0] or -1, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def compare(spark, rows, **options):
    got = substrings.removed(frame(spark, rows), **options).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)
    for r in got:
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256


def test_against_windows(spark):
    rows = documents()
    compare(spark, [*rows, (None, *rows[2][1:])], shard_bytes=3000)


def test_few_words_and_repeats(spark, monkeypatch):
    """A small vocabulary: windows recur within documents and across, at every offset."""
    rng = random.Random(9)
    monkeypatch.setattr(substrings, "AUTOMATON_PASSAGES", 40)
    rows = []
    for i in range(60):
        text = "ab " * rng.randint(0, 40) if i % 3 else " ".join(rng.choice("abc") for _ in range(rng.randint(5, 60)))
        rows.append((rng.randrange(45), text, *[None] * 7))
    rows += [(7, "p q r " * 10, *[None] * 7), (7, "z " + "p q r " * 10, *[None] * 7), (3, "r p q " * 10, *[None] * 7)]
    compare(spark, rows, shard_bytes=500)


def test_hot_phrases(spark):
    """A licence phrase in nearly all shards: spread or not, the same words go."""
    rng = random.Random(4)
    licence = " ".join(f"licence{i}" for i in range(16))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(20)) + (f" {licence} end{i}" if i % 9 else ""), *[None] * 7) for i in range(300)]
    rows += [(i + 300, " ".join(f"p{i % 40}q{j}" for j in range(15)) + f" z{i}", *[None] * 7) for i in range(80)]
    compare(spark, rows, shard_bytes=600, hot_shards=5)
    compare(spark, rows, shard_bytes=600)


def test_rows_of_hot_phrases_are_spread(spark):
    rows = spark.range(0, 40_000, 1, 8).select((F.col("id") % 20_000).alias("shard"), F.when(F.col("id") < 20_000, 7).otherwise(F.col("id")).alias("phrase"), F.col("id").alias("low"), F.col("id").alias("high"))
    seen = substrings._ends_of(rows, ["phrase"], "low", "high", 20_000, 1000).withColumn("task", F.spark_partition_id())
    hot = seen.where("phrase = 7")
    assert hot.agg(F.min("first"), F.max("first"), F.min("last"), F.max("last"), F.count("*")).first() == (0, 0, 19_999, 19_999, 20_000)
    assert seen.where("phrase <> 7 AND (first <> low OR last <> low)").isEmpty()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in seen.groupBy("task").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(sizes) < 2 * sum(sizes) / len(sizes)


def test_empty(spark):
    assert substrings.removed(frame(spark, [])).count() == 0


def test_colliding_words(monkeypatch):
    """Windows whose words the first hash takes for one another differ in the second one."""
    monkeypatch.setattr(_text, "_TABLE", np.ones(256, np.uint64))
    texts = [" ".join(chr(97 + i) * 3 for i in range(13)), " ".join(chr(98 + i) * 3 for i in range(13))]
    part = substrings._Slice(next(_text.words_of(pa.array(texts))))
    docs = pa.table({"doc_id": [1, 2], "rid": [1, 2], "text": texts})
    flags = pa.table({"value": np.unique(part.phrase.view(np.int64)), "first": pa.array([None] * len(np.unique(part.phrase)), pa.int64())})
    out = substrings._windows(docs, flags)
    assert len(set(out["key"].to_pylist())) == 1 and len(set(out["check"].to_pylist())) == 2
