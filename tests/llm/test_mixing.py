from collections import Counter
from fractions import Fraction

from spantrack.llm import mixing
from spantrack.llm._spark import numbered
from tests.llm.docs import documents, frame


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, full = Fraction(3 * sum(sizes.values()), 2), set()
    while True:
        free = [s for s in names if s not in full]
        rest = left - sum(2 * sizes[s] for s in full)
        level = rest / sum(weights[s] for s in free) if free else 0
        above = {s for s in free if level * weights[s] > 2 * sizes[s]}
        if not above:
            return {s: float(2 * sizes[s] if s in full else level * weights[s]) for s in names}
        full |= above


def brute_quotas(votes, seats):
    won = sorted(((-Fraction(v) / (2 * k - 1), i) for i, v in enumerate(votes) if v for k in range(1, seats + 1)))[:seats]
    count = Counter(i for _, i in won)
    return [count[i] for i in range(len(votes))]


def test_apportion(spark):
    import random

    rng = random.Random(3)
    cases = [([5, 3, 1], 7), ([0, 4, 4, 4], 5), ([1000, 1, 1, 1, 1, 1, 1], 40), ([10], 3), ([3, 3], 0)]
    cases += [([rng.randrange(50) + 1 for _ in range(rng.randint(1, 12))], rng.randrange(80)) for _ in range(15)]
    rows = [(g, i, v, s) for g, (votes, s) in enumerate(cases) for i, v in enumerate(votes)]
    got = mixing.apportion(spark.createDataFrame(rows, "g long, k long, v long, s long"), "g", "k", "v", "s").collect()
    quota = {(r.g, r.k): r.quota for r in got}
    for g, (votes, s) in enumerate(cases):
        assert [quota[g, i] for i in range(len(votes))] == brute_quotas(votes, s), (votes, s)


def test_mix(spark):
    rows = documents()
    docs = frame(spark, rows)
    got = mixing.mixed(docs, shard_words=700).collect()
    assert len(got) == len(rows)
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").encode().split())
    want = brute_targets(sizes)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        taken[r.source] += r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= mixing.BLOCK_WORDS + 2, (s, taken[s], t)
    again = mixing.mixed(docs.repartition(5), shard_words=700).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_take(spark):
    rows = documents()
    docs = frame(spark, rows)
    out = mixing.take(docs)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(r.text.encode().split())
        assert any(x[0] == r.doc_id and (x[1] or "").startswith(r.text) and x[2] == r.lang for x in rows)
    taken = Counter()
    for r in mixing.mixed(docs).collect():
        taken[r.doc_id] += r.taken
    assert +words == +taken


def test_empty(spark):
    assert mixing.mixed(frame(spark, [])).count() == 0
    assert mixing.take(frame(spark, [(1, None, None, None, None, None, None, None, None)])).count() == 0


def test_numbered(spark):
    """Equal keys, nulls among them, are numbered from 0 over all partitions."""
    rows = [(None, None, "clash")] * 40 + [(1, "a", "clash")] * 90 + [(1, None, "clash")] * 3 + [(i, "b", "clash") for i in range(50)]
    docs = spark.createDataFrame(rows, "x long, y string, _part string").repartition(7)
    for df in (docs, docs.coalesce(1), docs.where("y = 'b'"), docs.limit(0)):
        got, want = Counter(), Counter()
        out = numbered(df, ["x", "y"], "n")
        assert out.columns == ["x", "y", "_part", "n"]
        for r in out.collect():
            got[r.x, r.y, r.n] += 1
        for r in df.collect():
            want[r.x, r.y] += 1
        assert got == Counter((x, y, i) for (x, y), n in want.items() for i in range(n))


def test_repeated_rows(spark):
    """A third of all rows is one row: it is dealt over shards, and reruns agree."""
    own = [(i, " ".join(f"w{i}x{j}" for j in range(20)), "en", f"s{i % 2}", 1) for i in range(200)]
    rows = own + [(7, "a b c d e f g h i j", "en", "s1", 1)] * 100 + [(7, "a b c d e f g h i j", "de", "s1", 1)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mixed(docs, shard_words=300).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    copies = [r.taken for r in got if r.size == 10]
    taken, want = Counter(), brute_targets({"s0": 2000, "s1": 3030})
    for r in got:
        taken[r.source] += r.taken
    assert len(copies) == 103 and all(abs(taken[s] - t) <= mixing.BLOCK_WORDS + 2 for s, t in want.items())
    again = mixing.mixed(docs.repartition(9), shard_words=300).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    out = mixing.take(docs, shard_words=300).collect()
    assert sum(len(r.text.split()) for r in out if r.text.startswith("a b")) == sum(copies)
    whole = Counter(r.lang for r in out if r.text == "a b c d e f g h i j")
    assert abs(whole["de"] - 3 * sum(copies) // 1030) <= 3
