from collections import Counter

import corpus_pipeline
from spantrack.llm import lines
from tests.llm.docs import documents, frame


def brute(rows, m):
    """Text of each row after deletion."""
    seen, unique = {}, {}
    for r in rows:
        unique[r[0], r[1]] = None
    order = sorted(unique, key=lambda k: (k[0] is None, k[0] or 0))
    for k in order:
        all_lines = (k[1] or "").split("\n")
        worded = [i for i, x in enumerate(all_lines) if x.encode().split()]
        gone = set()
        for s in range(len(worded) - m + 1):
            key = tuple(all_lines[i] for i in worded[s : s + m])
            if key in seen:
                gone |= set(worded[s : s + m])
            seen.setdefault(key, k)
        unique[k] = None if k[1] is None else "\n".join(x for i, x in enumerate(all_lines) if i not in gone)
    return sorted(((r[0] or -1, unique[r[0], r[1]] or "") for r in rows))


def test_against_windows(spark):
    import random

    rng = random.Random(6)
    rows = documents()
    rows += [(1000 + i, "\n".join(rng.choice(["a", "b", "", " ", "c d"]) for _ in range(rng.randint(1, 15))), *[None] * 7) for i in range(25)]
    docs = frame(spark, rows)
    for m in (1, 2, 3):
        out = lines.dedup_lines(docs, m, removed="gone", lone_words=None)
        assert out.columns == [*docs.columns, "gone"]
        got = out.collect()
        assert sorted((r.doc_id or -1, r.text or "") for r in got) == brute(rows, m), m
        assert any(r.gone for r in got) and all(r.lang == "en" for r in got if r.doc_id < 901 and r.doc_id != 900)


def test_runs(spark):
    rows = [(1, "x\na\nb\nc\ny"), (2, "p\na\n\nb\nc\nq"), (3, "b\nc"), (4, "z\nz\nz")]
    docs = frame(spark, [(*r, *[None] * 7) for r in rows])
    got = {tuple(r) for r in lines.repeated_runs(docs).collect()}
    assert got == {(2, 1, 3), (3, 0, 2), (4, 1, 2)}
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == {1: rows[0][1], 2: "p\n\nq", 3: "", 4: "z"}


def test_lone_long_lines(spark):
    """A line of 13 words or more is a run of its own, wherever it stands; a shorter one needs a neighbour."""
    long, short, pair = " ".join(f"w{i}" for i in range(13)), " ".join(f"v{i}" for i in range(12)), "p\nq"
    spaced = "  " + long.replace(" ", " \t") + " "
    rows = [(1, f"a\n{long}\nb\n{short}\nc"), (2, f"d\n{long}\ne\n\n{short}\nf\n{pair}"), (3, f"{spaced}\ng\n{long}\nh\n{spaced}"), (4, f"i\n{long} w13\n{pair}"), (5, f"{'x' * 50000}\n{long}")]
    docs = frame(spark, [(*r, *[None] * 7) for r in rows])
    want = {1: rows[0][1], 2: f"d\ne\n\n{short}\nf\n{pair}", 3: f"{spaced}\ng\nh", 4: f"i\n{long} w13", 5: "x" * 50000}
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()} == {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs, "").collect()} == want
    got = {tuple(r) for r in lines.repeated_runs(docs).collect()}
    assert got == {(2, 1, 1), (3, 2, 1), (3, 4, 1), (4, 2, 2), (5, 1, 1)}


def test_empty(spark):
    assert lines.dedup_lines(frame(spark, [])).count() == 0
    assert lines.dedup_lines(frame(spark, [(None, None, *[None] * 7), (None, "a\nb", *[None] * 7)])).count() == 2


def test_shared_runs_of_2_to_64_lines(spark):
    """The exact length of the longest run that stands elsewhere too, and later copies of runs of any length."""
    import random

    rng = random.Random(9)
    texts = []
    for n in (1, 2, 3, 5, 8, 13, 31, 32, 33, 64):
        run = [f"run {n} line {i}" for i in range(n)]
        own = lambda: [f"own {rng.random()}" for _ in range(rng.randint(0, 4))]
        texts += ["\n".join([*own(), *run, *own()]) for _ in range(rng.randint(2, 4))]
    texts += ["\n".join(["again", "and again"] * 20), "", None, "alone"]
    rows = [(i, x, *[None] * 7) for i, x in enumerate(texts)]
    names = {i: [x for x in (t or "").split("\n") if x.split()] for i, t in enumerate(texts)}
    want = {}
    for i, own in names.items():
        want[i], n = 0, 1
        while n <= len(own):
            counts = Counter(tuple(x[s : s + n]) for x in names.values() for s in range(len(x) - n + 1))
            if max(counts[tuple(own[s : s + n])] for s in range(len(own) - n + 1)) == 1:
                break
            want[i] = n
            n += 1
    out = lines.dedup_lines(frame(spark, rows), removed="gone", shared="shared")
    got = out.collect()
    assert {r.doc_id: r.shared for r in got} == want and max(want.values()) == 64
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == brute(rows, 2)


def test_prefixes_with_any_and_with_earlier_places(spark):
    """Exact lengths at each place, also where the longest match comes later and a shorter one earlier, and where runs overlap themselves."""
    import random

    rng = random.Random(2)
    texts = ["a\nb\nc\nx", "a\nb\nc\nd\ne\ny", "q\na\nb\nc\nd\ne\nf", "d\ne\nf\na\nb"] + ["\n".join(["o"] * n) for n in (1, 7, 12)] + ["\n".join(rng.choice("ab") for _ in range(rng.randint(1, 40))) for _ in range(12)]
    names = [x.split("\n") for x in texts]
    places = [(i, s) for i, own in enumerate(names) for s in range(len(own))]

    def prefix(a, b):
        n = 0
        while a[1] + n < len(names[a[0]]) and b[1] + n < len(names[b[0]]) and names[a[0]][a[1] + n] == names[b[0]][b[1] + n]:
            n += 1
        return n

    want = {p: (max(prefix(p, q) for q in places if q != p), max((prefix(p, q) for q in places if q < p), default=0)) for p in places}
    docs = frame(spark, [(i, x, *[None] * 7) for i, x in enumerate(texts)])
    got = {(r.doc_id, r.seq): (r.shared, r.earlier) for r in lines.common_prefixes(lines.shared_ranks(lines._base(docs))).collect()}
    assert got == {p: x for p, x in want.items() if x[0]}
