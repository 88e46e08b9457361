import random
from collections import Counter

import corpus_pipeline
from spantrack.llm import mixing, quality
from tests.llm import test_jaccard, test_lines, test_mixing
from tests.llm.docs import documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def brute(rows):
    """(doc_id, text, source) of what the first three stages keep."""
    good = [r for r in rows if not any(rule.rejects(quality.Measures((r[1] or "").encode())) for rule in quality.RULES)]
    left = [(max(i, 0), x) for i, x in dict.fromkeys(test_lines.brute(good, 2)) if x.encode().split()]  # brute writes doc_id 0 as -1
    roots, _ = test_jaccard.brute_components(dict(left))
    source = {r[0]: r[3] for r in rows}
    return {i: (x, source[i]) for i, x in left if roots[i] == i}


def test_run(spark, tmp_path):
    rows = [r[:5] for r in documents(160, 12)]
    rng = random.Random(7)
    for i in range(1000, 1030):  # near copies by shared shingles; most of their fingerprints differ in more than 2 bits
        text = [f"n{rng.randrange(900)}" for _ in range(120)]
        other = [*text[:50], "changed", *text[51:]] if i % 2 else [*text[:40], "x", "y", *text[70:]]
        rows += [(i, " ".join(text), "en", "s1", 9), (i + 100, " ".join(other), "en", "s2", 9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert {r.doc_id: (r.text, r.source) for r in docs.collect()} == want
    sizes = Counter()
    for x, s in want.values():
        sizes[s] += len(x.encode().split())
    targets = test_mixing.brute_targets(sizes)
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken = Counter()
    for r in out:
        assert r.round_trip and len(r.ids) == 4 * r.n_tokens and want[r.doc_id][0].startswith(r.text)
        taken[r.source] += len(r.text.encode().split())
    assert all(abs(taken[s] - t) <= mixing.BLOCK_WORDS + 2 for s, t in targets.items())


def test_no_documents(spark, tmp_path):
    for k, rows in enumerate(([], [(1, None, None, None, None)])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        assert corpus_pipeline.run(spark, f"{tmp_path}/{k}").count() == 0


def test_clashing_columns(spark, tmp_path):
    """Columns that are named as the stages' own ones come out as they went in."""
    names = ["ids", "decoded", "_row", "_part", "_taken", "n_tokens", "round_trip", "row", "fp", "_id"]
    rows = [(*r[:5], *[f"{c} of {r[0]}" for c in names]) for r in documents(40, 12) if r[0] < 900]
    docs = spark.createDataFrame(rows, SCHEMA + "".join(f", {c} string" for c in names))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "_n_tokens", "_ids", "_round_trip"]
    got = out.collect()
    assert got and all(r[c] == f"{c} of {r.doc_id}" for r in got for c in names) and all(r["_round_trip"] and len(r["_ids"]) == 4 * r["_n_tokens"] for r in got)
