"""The corpus pipeline: documents that pass the quality rules, without repeated lines and near copies, mixed and tokenized.

Each stage calls one operator on all rows that the stage before has kept. Every
stage but the last returns the columns of documents; the last adds the tokens. For
all stages: an empty table gives no rows, null and empty texts have no words (the
quality rules reject them), rows of null doc_id are documents like others, repeated
rows are treated alike until the near-copy stage keeps one of them, and other
columns pass through with their values, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spantrack.llm import bpe, jaccard, lines, mixing, quality, simhash
from spantrack.llm._spark import free_name, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go, among them those of null, empty and very short text."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs (two lines, or one long one) go, and with them documents of which no word is left.

    Documents of null doc_id come after all others; repeated rows come out alike.
    """
    return lines.dedup_lines(docs).where(F.col("text").rlike(lines.WORD))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles at a Jaccard similarity of 0.8 or more, by SimHash and what it misses.

    That of the smallest doc_id stays; rows of one doc_id go by their own texts, of
    repeated rows one stays, and rows of null doc_id stay.
    """
    return simhash.keep_one(docs, near=jaccard.near)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last one of a shard may be cut. Null sources are one source."""
    return mixing.take(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their tokens, and whether these decode to the text again: n_tokens, ids and round_trip.

    Where a document's column has one of these names it keeps it, and the new column
    gets underscores in front. A null text has no tokens and decodes to nothing.
    """
    others = F.struct(*[F.lit(None).cast("string").alias(c) if c == "text" else F.col(c) for c in docs.columns])
    out = bpe.encode(docs.select(others.alias("row"), F.col("text").cast("string").alias("text")), decoded="decoded")
    kept = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit("")).cast("binary")
    added = {"n_tokens": (F.octet_length("ids") / 4).cast("long"), "ids": F.col("ids"), "round_trip": same}
    return out.select(*kept, *[x.alias(free_name(c, docs.columns)) for c, x in added.items()])


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("bpe_tokens", tokenize),
]

#: Near copies, the seeded mix and BPE are beyond SQL; tests/llm holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet and read as the next one's documents."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
