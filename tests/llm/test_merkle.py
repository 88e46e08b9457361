import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from spantrack.llm import merkle
from tests.llm.docs import SCHEMA, documents, frame


def digest(*hashes):
    return sha256("".join(hashes).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    shown = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    return digest(*map(shown, (doc_id, source, lang, n_chars, text)))


def tree(leaves):
    """The root, and for each leaf its siblings, by the definition."""
    level, at, siblings = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for i, k in enumerate(at):
            if k ^ 1 < len(level):
                siblings[i].append(level[k ^ 1])
            at[i] = k >> 1
        level = [digest(*level[k : k + 2]) for k in range(0, len(level), 2)]
    return level[0], siblings


def refold(value, place, n, siblings):
    siblings = list(siblings)
    while n > 1:
        value = digest(value) if place ^ 1 >= n else digest(*((siblings.pop(0), value) if place & 1 else (value, siblings.pop(0))))
        place, n = place // 2, (n + 1) // 2
    return value


def brute(rows):
    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append((r[0] is not None, r[0] or 0, leaf(*r[:5]), r))
    names = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for x in names:
        langs[x].sort(key=lambda y: y[:3])
        trees[x] = tree([y[2] for y in langs[x]])
    root, over = tree([trees[x][0] for x in names])
    out = []
    for k, x in enumerate(names):
        for place, (_, _, own, r) in enumerate(langs[x]):
            siblings = trees[x][1][place]
            changed = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                changed = leaf(*r[:4], r[4] + 1)
            subroot = refold(changed, place, len(langs[x]), siblings)
            folded = refold(subroot, k, len(names), over[k])
            out.append((r[0], own, trees[x][0], root, digest(*siblings, *over[k]), folded, folded == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("levels, task_rows, parts", [(12, 500_000, 3), (2, 9, 4)])
def test_brute_force(spark, levels, task_rows, parts):
    langs = ["en", "de", None, "", "Ünder", "z", "en", "en"]
    rows = [(r[0], r[1], langs[i % 8], *r[3:]) for i, r in enumerate(documents(90))]
    rows += [(None, "x", "en", "s", 3, *["c"] * 4), rows[4], rows[4]]
    got = merkle.manifest(frame(spark, rows).repartition(parts), merkle.tampered(F.col("n_chars")), levels, task_rows)
    want = brute([tuple(r[:5]) for r in rows])
    assert rows_of(got) == want and {x[-1] for x in want} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 5, 16])
def test_small_tables(spark, n):
    rows = [(i, f"t{i}", "en", "s", i, *["c"] * 4) for i in range(n)]
    got = merkle.manifest(spark.createDataFrame(rows, SCHEMA), levels=2, task_rows=3)
    assert rows_of(got) == sorted([(*x[:5], x[3], True) for x in brute([tuple(r[:5]) for r in rows])], key=str) if n else got.count() == 0


def test_hot_row_is_spread(spark):
    """A row found very often, all equal, in blocks of many tasks."""
    rows = [(7, "same", "en", "s", 4)] * 300 + [(i, "t", "en", "s", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lined = merkle.placed(docs.select(F.lit("").alias("g"), "doc_id", merkle.leaf(docs).alias("h")), [F.col("doc_id").asc()], 20)
    sizes = [r["count"] for r in lined.groupBy(F.shiftright("row", 33)).count().collect()]
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert sorted(r.pos for r in lined.collect()) == list(range(320))
    assert rows_of(merkle.manifest(docs, levels=3, task_rows=20)) == sorted([(*x[:5], x[3], True) for x in brute(rows)], key=str)


def test_forest_is_the_tree_at_every_size():
    """Appends one by one, closed after each: the same root and witnesses as the definition."""
    leaves = [sha256(str(i).encode()).digest() for i in range(40)]
    for n in range(1, 41):
        forest, blocks = merkle.Forest(3), []
        for i in range(n):
            blocks += forest.append(0, i, leaves[i], i)
        upper, done = merkle.Forest(6), []
        for k, (level, index, value, _) in enumerate([*blocks, *forest.trees]):
            done += upper.append(level, index, value, k)
        upper.close(n)
        ((_, _, root, below),) = upper.trees
        assert not done and root.hex() == tree([x.hex() for x in leaves[:n]])[0]
        for (_, _, _, members), (_, above) in zip([*blocks, *forest.trees], below, strict=True):
            for i, witness in members:
                assert merkle.fold(leaves[i], i, n, bytes(witness + above)) == root
