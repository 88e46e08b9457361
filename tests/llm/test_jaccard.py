import random

import corpus_pipeline
from pyspark.sql import functions as F

from spantrack.llm import jaccard
from tests.llm.docs import frame


def brute_sets(texts):
    words = {i: (x or "").encode().lower().split() for i, x in texts.items()}
    return {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}


def brute_components(texts):
    """doc_id to the smallest doc_id reachable over all pairs at Jaccard 0.8 or more, and the number of such pairs of different sets."""
    sets, root, n = brute_sets(texts), {i: i for i in texts}, 0

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sorted(texts):
        for b in (b for b in texts if b < a):
            if sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y], n = x, n + (sets[a] != sets[b])
    return {i: find(i) for i in texts}, n


def near_texts():
    """Chains and groups of texts around the threshold, some of a common passage, with copies, null, empty and short ones."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(2000)}"
    passage = [word() for _ in range(60)]
    texts = [None, "", " \n", "One two", "one  TWO", "one two three four five", "one two three four five six"]
    for k in range(40):
        text = [word() for _ in range(rng.choice([6, 30, 60, 120]))] + (passage if k % 3 == 0 else [])
        for _ in range(rng.randint(1, 7)):
            texts.append(" ".join(text))
            text = list(text) if rng.random() < 0.7 else text[: len(text) - rng.randint(0, len(text) // 6)]
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = word()
    rng.shuffle(texts)
    return dict(enumerate(texts))


def test_stage_against_all_pairs(spark):
    texts = near_texts()
    want, n = brute_components(texts)
    assert n > 30
    docs = frame(spark, [(i, x, *[None] * 7) for i, x in texts.items()])
    got = jaccard.near_copies(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(got) == len(texts)
    kept = corpus_pipeline.simhash_near_dedup(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))


def test_group_around_a_hub(spark):
    """Copies with three words changed each, similar to the one that none is made from and to few of the others."""
    rng = random.Random(4)
    text = [f"w{i}" for i in range(150)]
    texts = {70: " ".join(text)}
    for i in range(60):
        copy = list(text)
        for j in rng.sample(range(10, 140), 3):
            copy[j] = f"other{i}-{j}"
        texts[i] = " ".join(copy)
    want, _ = brute_components(texts)
    got = {r.doc_id: r.component_id for r in jaccard.near_copies(frame(spark, [(i, x, *[None] * 7) for i, x in texts.items()])).collect()}
    assert got == want and set(want.values()) == {0}


def test_no_documents(spark):
    assert jaccard.near_copies(frame(spark, [])).count() == 0


def test_simhash_finds_candidates(spark):
    """Pairs by SimHash: those whose fingerprints over the shingles differ in 2 bits or fewer are connected, and no others."""
    texts = {i: x for i, x in near_texts().items() if x}
    docs = frame(spark, [(i, x, *[None] * 7) for i, x in texts.items()])
    sets = jaccard.shingle_sets(docs, 5).select(F.col("row").alias("node"), "sim", "doc_id")
    sims = {r.node: r.sim for r in sets.collect()}
    root = {x: x for x in sims}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in jaccard._simhash_pairs(sets).collect():
        root[find(r.a)] = find(r.b)
    near = {a: {b for b in sims if bin((sims[a] ^ sims[b]) & (1 << 64) - 1).count("1") <= 2} for a in sims}
    assert all(find(a) == find(b) for a in sims for b in near[a]) and sum(len(x) > 1 for x in near.values()) > 40
    classes = {}
    for x in sims:
        classes.setdefault(find(x), set()).add(x)
    for members in classes.values():  # nothing is connected but over links
        seen, todo = set(), [next(iter(members))]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += near[x]
        assert seen == members
