"""Toxicity by a classifier chain of linear models.

The categories are predicted one after the other; the model of each sees the
words and word beginnings of the text and the probabilities of the categories
before it. In training those probabilities are out-of-fold predictions, so that a
later model meets earlier ones as they behave on texts that they haven't seen.
The labels hold one verdict, toxic. The categories before it are toxic in each of
the sample's most frequent languages, the last is toxic as a whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spantrack.llm._spark import cut, python_ready

#: Bounds of training: labelled documents, features, categories before the last; folds and steps.
SAMPLE_ROWS, FEATURES, LANGUAGES, FOLDS, STEPS, RATE, PENALTY = 10_000, 384, 8, 5, 200, 0.3, 0.5
#: Beginnings of words that are features besides the words themselves, in letters.
BEGINNINGS = (4, 5, 6)
#: Occurrences in a text at which a term is one more feature, and words for each of two or more to make it a dense one.
LEVELS, DENSE_WORDS = (1, 2, 3), 300
#: Documents a feature must occur in, and how many times as often among the toxic ones.
LEAST_DOCS, LEAST_LIFT = 3, 2.0
_letters = re.compile(r"[^\W\d_]+").findall


def counted(text: str) -> Counter[str]:
    """Words in lower case and their beginnings, the latter ending in ``*``, with how often they occur."""
    out = Counter(_letters(text.lower()))
    for word, n in list(out.items()):
        for size in BEGINNINGS:
            if len(word) > size:
                out[f"{word[:size]}*"] += n
    return out


def levels(count: int, words: int) -> list[str]:
    """The levels that a term reaches with so many occurrences among so many words; 0 stands for dense."""
    return [str(n) for n in LEVELS if count >= n] + ["0"] * (count >= 2 and count * DENSE_WORDS >= words)


def terms(text: str) -> list[str]:
    """The features of a text: each of its terms under every level that it reaches."""
    words = len(_letters(text))
    return [f"{x}{n}" for x, c in counted(text).items() for n in levels(c, words)]


@dataclass
class Chain:
    """Features in order, and for each category its weights: features, probabilities before it, constant."""

    features: dict[str, int]
    categories: list[str]
    weights: list[np.ndarray]
    threshold: float

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        """(rows, categories): each category's probability, given those before."""
        out = np.zeros((len(rows), 0))
        for w in self.weights:
            out = np.column_stack([out, _sigmoid(_inputs(rows, out) @ w)])
        return out

    def rows(self, texts: list[str]) -> np.ndarray:
        out, known = np.zeros((len(texts), len(self.features)), np.float32), {x.rstrip("0123456789") for x in self.features}
        for i, text in enumerate(texts):
            seen, words = Counter(), _letters(text.lower())
            for word, n in Counter(words).items():
                for term in (word, f"{word[:4]}*", f"{word[:5]}*", f"{word[:6]}*"):
                    if term in known and len(term) <= len(word):
                        seen[term] += n
            for term, c in seen.items():
                for n in levels(c, len(words)):
                    at = self.features.get(f"{term}{n}")
                    if at is not None:
                        out[i, at] = 1
        return out


def _inputs(rows: np.ndarray, before: np.ndarray) -> np.ndarray:
    return np.column_stack([rows, before, np.ones(len(rows))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with an L2 penalty (none on the constant), by Adam."""
    w, m, v = (np.zeros(x.shape[1]) for _ in range(3))
    free = np.append(np.ones(x.shape[1] - 1), 0)
    for it in range(1, STEPS + 1):
        g = x.T @ (_sigmoid(x @ w) - y) + PENALTY * free * w
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= RATE * (m / (1 - 0.9**it)) / (np.sqrt(v / (1 - 0.99**it)) + 1e-8)
    return w


def train(rows: np.ndarray, targets: np.ndarray, folds: np.ndarray, features: dict[str, int], categories: list[str]) -> Chain:
    """The chain of one model per column of ``targets``; earlier probabilities are out-of-fold."""
    before, weights = np.zeros((len(rows), 0)), []
    for c in range(targets.shape[1]):
        x, y, out = _inputs(rows, before), targets[:, c], np.zeros(len(rows))
        for f in np.unique(folds):
            held = folds == f
            out[held] = _sigmoid(x[held] @ logistic(x[~held], y[~held]))
        weights.append(logistic(x, y))
        before = np.column_stack([before, out])
    return Chain(features, categories, weights, _threshold(before[:, -1], targets[:, -1]))


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut of best F1 over out-of-fold probabilities, halfway to the next one below; at least 0.05."""
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + max(y.sum(), 1))
    f1[:-1][p[order][:-1] == p[order][1:]] = 0
    at = int(f1.argmax()) if len(p) else 0
    return max(0.05, float((p[order][at] + (p[order][at + 1] if at + 1 < len(p) else 0)) / 2)) if len(p) else 0.5


def _sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, text, lang, toxic) of the labelled documents whose doc_id has the least hash; of rows of one doc_id the first by text and lang."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    least = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    first = texts.join(F.broadcast(least), "doc_id").groupBy("doc_id", "toxic").agg(F.min(F.struct("text", "lang")).alias("x"))  # sample_rows rows at most
    return first.select("doc_id", "x.text", "x.lang", "toxic")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1), strict=True):
            found = sorted(terms(text.as_py() or ""))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([toxic.as_py()] * len(found), pa.int32())], ["term", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Chain | None:
    """A chain from ``sample_rows`` labelled documents at most; None where their labels are all alike.

    Features are the terms that best tell toxic from other documents, by the
    log-likelihood ratio of their counts, which are made in Spark. Labels that are null
    or of no document take no part; a null or empty text has no terms and trains as such;
    of rows of one doc_id one text trains; empty tables give None; other columns are not
    read.
    """
    python_ready(docs.sparkSession)
    sample = cut(_sample(docs, labels, sample_rows))
    total, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < total:
        return None
    by_term = sample.select("text", "toxic").mapInArrow(_terms, "term string, toxic int").groupBy("term").agg(F.sum("toxic").alias("t"), F.count("*").alias("n"))
    rate = toxic / total
    part = lambda k, n, p: k * F.log((k + 0.5) / (n * p + 0.5))
    gain = part(F.col("t"), F.col("n"), F.lit(rate)) + part(F.col("n") - F.col("t"), F.col("n"), F.lit(1 - rate))
    found = cut(by_term.where((F.col("n") >= LEAST_DOCS) & (F.col("t") > LEAST_LIFT * rate * F.col("n"))).withColumn("gain", gain))
    chance = math.log(max(found.count(), 1))  # the best of so many terms gains about this much by chance
    telling = found.where(F.col("gain") >= chance)
    chosen = [r["term"] for r in telling.orderBy(F.col("gain").desc(), "term").limit(FEATURES).collect()]
    features = {x: i for i, x in enumerate(chosen)}
    spoken = [r["lang"] for r in sample.where("lang IS NOT NULL").groupBy("lang").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).where("t >= 10").orderBy(F.col("n").desc(), "lang").limit(LANGUAGES).collect()]
    categories = [*[f"toxic_{x}" for x in spoken], "toxic"]
    blank = Chain(features, [], [], 0.5)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [np.flatnonzero(x).astype(np.int32) for x in blank.rows([x.as_py() or "" for x in batch.column(1)])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.list_(pa.int32())), batch.column(2), batch.column(3)], ["doc_id", "at", "lang", "toxic"])

    sampled = sample.select("doc_id", "text", "lang", "toxic").mapInArrow(vectors, "doc_id long, at array<int>, lang string, toxic int").orderBy("doc_id").toArrow().to_pylist()
    rows = np.zeros((len(sampled), len(features)), np.float32)
    for i, r in enumerate(sampled):
        rows[i, r["at"]] = 1
    verdict = np.array([r["toxic"] for r in sampled], float)
    targets = np.column_stack([*[verdict * np.array([r["lang"] == x for r in sampled]) for x in spoken], verdict])
    return train(rows, targets, np.arange(len(sampled)) % FOLDS, features, categories)


def classify(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """(doc_id, probabilities, toxic): each category's probability in the chain's order and the verdict.

    Null and empty texts have no terms and get the verdict of that; without a chain
    there are no probabilities and nothing is toxic; a null doc_id stays null;
    repeated rows come out alike; an empty table gives no rows; other columns are
    not read.
    """
    python_ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(chain)  # FEATURES terms, LANGUAGES + 1 models

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts = [x.as_py() or "" for x in batch.column(1)]
            p = own.probabilities(own.rows(texts)) if own else np.zeros((len(texts), 0))
            toxic = p[:, -1] >= own.threshold if own else np.zeros(len(texts), bool)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(p.round(6)), pa.list_(pa.float64())), pa.array(toxic)], ["doc_id", "probabilities", "toxic"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, probabilities array<double>, toxic boolean")
