import math
import random

from spantrack.llm import topk


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for own, (q, v) in enumerate(good):
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for at, (i, w) in enumerate(good) if at != own)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<double>, label int, cell int, far int")
    return sorted(map(tuple, topk.top_k(frame, **options).collect()))


def test_against_all_pairs(spark):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(7)]
    rows = []
    for i in range(1500):
        c = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.2) for x in c]))
    for i in range(1500, 2100):
        rows.append((i, centres[0]))
    rows += [(3000, None), (3050, [1.0, None]), (3100, [float("nan")] * 12), (3150, [float("inf")] * 12), (None, centres[0]), (50, rows[50][1]), (-50, [0.0] * 12), (3200, centres[1][:5])]
    assert run(spark, rows, tree_rows=150, block_queries=7) == brute(rows)


def test_few_rows_and_large_numbers(spark):
    assert run(spark, []) == []
    assert run(spark, [(50, [1.0, 2.0])]) == []
    rows = [(i, [float((-1) ** i * (i + 1) * 10**4), 1.0, -3.5]) for i in range(0, 200, 25)] + [(7, [])]
    assert run(spark, rows) == brute(rows)


def test_best_first_skips_pages(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-5, 5, (500, 8)) + 400 * c for c in np.eye(8, dtype=int)])
    top = float((rows.astype(float) ** 2).sum(axis=1).max())
    lifted = topk._lifted(rows, top)
    tree = topk.build(np.arange(len(rows)), rows, lifted[0], top)
    q = rows[::97]
    best = -np.sort(-(q @ rows.T), axis=1)[:, :5]
    scores, names = topk.search(tree, np.full(len(q), -1), q, np.full(len(q), np.iinfo(np.int64).min), 5)
    assert (scores == best).all()
    counted = []
    distances = topk._distances
    monkeypatch.setattr(topk, "_distances", lambda a, b: counted.append(len(a) * len(b)) or distances(a, b))
    scores, names = topk.search(tree, np.full(len(q), -1), q, best[:, -1], 5)  # with the bound that a query's own tree gives
    assert (scores == best).all()
    pages = len(topk.pickle.loads(tree)[2]) - 1
    assert sum(counted) < 0.5 * len(q) * pages  # most pages are ruled out by stored distances


def test_more_rows_than_the_sample_and_another_operator_between(spark):
    """Several cells, rows that the sample of routes hasn't seen, and a plan that runs after other operators have been built."""
    from spantrack.llm import quality

    rng = random.Random(8)
    rows = [(i, [rng.gauss(3 * (i % 9), 1) for _ in range(6)]) for i in range(topk.SAMPLE_ROWS + 500)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plan = topk.top_k(frame, every=500, tree_rows=100)
    quality.judged(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    assert sorted(map(tuple, plan.collect())) == brute(rows, every=500)


def test_repeated_ids(spark):
    """Rows of one vec_id are candidates and queries of their own."""
    rows = [(0, [0.5, 0.5]), (1, [0.5, 0.25]), (1, [0.9, 0.9]), (2, [0.1, 0.1])]
    assert run(spark, rows) == brute(rows) == [(0, 1, 1, 58880), (0, 2, 1, 24576), (0, 3, 2, 6400)]
    rows = [(50, [1.0, 2.0]), (50, [1.0, -2.0]), (50, [1.0, 2.0]), (1, [5.0, 1.0]), (1, [4.0, 9.0]), (2, [0.5, 0.5])] + [(100, [3.0, 3.0])] * 9
    assert run(spark, rows) == brute(rows)


def test_many_trees_and_shells_of_a_cell(spark):
    """Cells dealt by distance into trees and shells, one cell with most rows, equal distances, and routes that grow with the rows."""
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1 if i % 3 else 0.05) + 2 * (i % 3 == 0) for _ in range(5)]) for i in range(1, 1400)]
    rows += [(2000 + i, [float((i >> b & 1) * 2 - 1) for b in range(5)]) for i in range(32)]
    assert run(spark, rows, tree_rows=20, n_routes=3, block_queries=5) == brute(rows)
    assert run(spark, rows, tree_rows=4, block_queries=5) == brute(rows)


def test_trees_beyond_reach_cost_no_distances(monkeypatch):
    import numpy as np

    rows = np.random.default_rng(5).integers(-9, 9, (300, 6))
    top = float((rows.astype(float) ** 2).sum(axis=1).max())
    lifted = topk._lifted(rows, top)
    route = lifted[0]
    order = np.argsort(topk._distances(lifted, route[None])[:, 0], kind="stable")
    near, far = (topk.build(part, rows[part], route, top) for part in (order[:150], order[150:]))
    q = rows[:1]
    best = -np.sort(-(q @ rows.T), axis=1)[:, :3]
    counted, distances = [], topk._distances
    monkeypatch.setattr(topk, "_distances", lambda a, b: counted.append(len(a) * len(b)) or distances(a, b))
    scores = [topk.search(tree, np.array([-1]), q, best[:, -1], 3)[0] for tree in (near, far)]
    assert (np.sort(np.concatenate(scores, axis=1), axis=1)[:, :-4:-1] == best).all()
    counted.clear()
    topk.search(far, np.array([-1]), q, np.array([10**6]), 3)  # no point can score as much
    assert sum(counted) == 1  # the distance to the routing object settles the whole tree
