import numpy as np

from spantrack.llm import toxicity
from tests.llm.docs import documents, frame

DATA = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, the chain finds the other half's toxic documents."""
    docs, labels = spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")
    chain = toxicity.fit(docs, labels.where("doc_id % 4 < 2"))
    assert chain.categories[-1] == "toxic" and len(chain.categories) == len(chain.weights) > 1
    got = {r.doc_id: r.toxic for r in toxicity.classify(docs, chain).collect()}
    held = [(r.toxic, got[r.doc_id]) for r in labels.where("doc_id % 4 >= 2").collect()]
    hits = sum(t and g for t, g in held)
    assert hits >= 0.9 * sum(t for t, _ in held)
    assert sum(g and not t for t, g in held) <= 0.005 * len(held)
    again = toxicity.fit(docs, labels.where("doc_id % 4 < 2"))
    assert again.features == chain.features and all((a == b).all() for a, b in zip(again.weights, chain.weights))


def test_later_models_see_out_of_fold_probabilities():
    rng = np.random.default_rng(0)
    rows = rng.integers(0, 2, (300, 4)).astype(np.float32)
    first = rows[:, 0] * rows[:, 1]
    targets = np.column_stack([first, np.maximum(first, rows[:, 2])])
    chain = toxicity.train(rows, targets, np.arange(300) % 5, {str(i): i for i in range(4)}, ["a", "b"])
    assert len(chain.weights[0]) == 5 and len(chain.weights[1]) == 6
    p = chain.probabilities(rows)
    assert ((p[:, 1] >= chain.threshold) == targets[:, 1]).mean() > 0.9
    x = toxicity._inputs(rows, p[:, :1])
    assert np.allclose(p[:, 1], toxicity._sigmoid(x @ chain.weights[1]))


def test_awkward_rows(spark):
    rows = documents()
    docs = frame(spark, rows)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(docs, none) is None
    assert toxicity.classify(docs, None).where("NOT toxic").count() == len(rows)
    labels = spark.createDataFrame([(r[0], int(r[0] % 3 == 0)) for r in rows[:60]] + [(None, 1), (5, None)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, labels)
    assert toxicity.classify(docs, chain).count() == len(rows)
    assert toxicity.classify(frame(spark, []), chain).count() == 0


def test_repeated_ids_in_training(spark):
    """Of rows of one doc_id the first by text is the sample's, whatever the rows' order."""
    rows = [(1, "b", "en"), (1, "a", "de"), (2, None, None), (2, "z", "en"), (None, "n", "en")]
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1)], "doc_id long, toxic int")
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, lang string")
        assert sorted(map(tuple, toxicity._sample(docs, labels, 10).collect())) == [(1, "a", "de", 1), (2, None, None, 0)]
