"""Exact top-k inner products by M-trees of metric pages.

With M the largest norm of all, a vector x gains the coordinate sqrt(M^2 - |x|^2)
and a query q a zero; then |x' - q'|^2 = |q|^2 + M^2 - 2 <q, x>, so that the nearest
points are those of highest score and a metric tree can search for them. The root
holds routing objects from a bounded sample, more of them the more vectors there are.
Every vector belongs to the nearest one's cell. A cell is dealt by distance from its
routing object into trees of bounded size, neighbouring trees form a shell, and each
tree is split into nodes and these into pages, each with a routing object, a covering
radius and its distance to the one above; members have their distance to their page.

A query first searches the tree of its cell that lies nearest, which bounds its k-th
score; then it visits, in blocks of queries, the shells that can still hold better
ones: a shell and a tree keep the least and greatest distance of their members from the
routing object. In a tree pages are taken best first. Distances between stored
objects bound those to the query by the triangle inequality, so that trees, pages
and members beyond the bound are passed over without computing theirs.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spantrack.llm._spark import cut, python_ready, ranked

#: Rows of the sample for routing objects (per routing object, and at least); vectors in a tree, a node and a page; queries in a block.
SAMPLE_SHARE, SAMPLE_ROWS, TREE_ROWS, NODE_ROWS, PAGE_ROWS, BLOCK_QUERIES = 4, 2000, 2048, 512, 64, 256
#: Least and greatest number of routing objects, the trees' worth of vectors for each between these, and trees in a shell.
ROUTES, MOST_ROUTES, CELL_TREES, SHELL_TREES = 48, 512, 4, 8


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): floor(256 * x) of every component; vectors null or with null or non-finite components, and null ids, go."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    good = vectors.where(x.isNotNull() & whole & F.col("vec_id").isNotNull())
    return good.select(F.col("vec_id").cast("long"), F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("long")).alias("v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which adds nothing to a product."""
    out = np.zeros((len(column), width), np.int64)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, bounds = column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
    lengths = np.diff(bounds)
    if len(out) and (lengths == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    for i, n in enumerate(lengths):
        out[i, :n] = flat[bounds[i] : bounds[i + 1]]
    return out


def _lifted(rows: np.ndarray, top: float) -> np.ndarray:
    """Rows with the coordinate that makes all of them as long as the longest."""
    x = rows.astype(float)
    return np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(axis=1), 0))])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0))


def spread_out(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points, each as far as possible from those before."""
    chosen, near = [0], _distances(points, points[:1])[:, 0]
    while len(chosen) < min(n, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, _distances(points, points[chosen[-1] :][:1])[:, 0])
    return points[chosen]


def _parts(points: np.ndarray, rows: np.ndarray, most: int) -> list[np.ndarray]:
    """Split rows between two far points until each part has ``most`` or fewer; equal points are cut by count."""
    if len(rows) <= most:
        return [rows]
    own = points[rows]
    a = own[_distances(own, own[:1])[:, 0].argmax()][None]
    far = _distances(own, a)[:, 0]
    b = own[far.argmax()][None]
    side = far <= _distances(own, b)[:, 0]
    if side.all() or not side.any():
        side = np.arange(len(rows)) < len(rows) // 2
    return [*_parts(points, rows[side], most), *_parts(points, rows[~side], most)]


@dataclass
class Level:
    """Routing objects of one level, their covering radii, the place of the one above and the distance to it."""

    centres: np.ndarray
    radii: np.ndarray
    above: np.ndarray
    parents: np.ndarray


def _level(points: np.ndarray, parts: list[np.ndarray], above: np.ndarray, over: np.ndarray) -> Level:
    centres = np.stack([points[p].mean(axis=0) for p in parts])
    radii = np.array([_distances(points[p], c[None]).max() for p, c in zip(parts, centres, strict=True)])
    return Level(centres, radii, above, np.array([_distances(c[None], over[k][None])[0, 0] for c, k in zip(centres, above, strict=True)]))


def build(ids: np.ndarray, rows: np.ndarray, route: np.ndarray, top: float) -> bytes:
    """A tree of nodes and pages under the routing object ``route``."""
    points = _lifted(rows, top)
    nodes = _parts(points, np.arange(len(rows)), NODE_ROWS)
    split = [_parts(points, n, PAGE_ROWS) for n in nodes]
    pages = [p for n in split for p in n]
    upper = _level(points, nodes, np.zeros(len(nodes), int), route[None])
    lower = _level(points, pages, np.repeat(np.arange(len(nodes)), [len(n) for n in split]), upper.centres)
    order, bounds = np.concatenate(pages), np.concatenate([[0], np.cumsum([len(p) for p in pages])])
    members = np.concatenate([_distances(points[p], c[None])[:, 0] for p, c in zip(pages, lower.centres, strict=True)])
    kind = np.int32 if np.abs(rows).max(initial=0) < 2**31 else np.int64
    far = _distances(points, route[None])
    return pickle.dumps((ids[order], rows[order].astype(kind), bounds, members, [tuple(vars(x).values()) for x in (upper, lower)], route, top, far.min(), far.max()), protocol=5)


def _below(queries: np.ndarray, level: Level, to_above: np.ndarray, within: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances from queries to a level's routing objects, infinite where stored distances or the level above rule one out, and the least distance of anything below each."""
    ahead = np.maximum(least[:, level.above], np.abs(to_above[:, level.above] - level.parents[None, :]) - level.radii[None, :])
    out = np.full(ahead.shape, np.inf)
    for k in np.flatnonzero((ahead <= within[:, None]).any(axis=0)):
        some = ahead[:, k] <= within
        out[some, k] = _distances(queries[some], level.centres[k : k + 1])[:, 0]
    return out, np.maximum(ahead, out - level.radii[None, :])


def search(tree: bytes, ids: np.ndarray, queries: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, vec_ids), each queries by k, of a tree's best for a block; ``least``: scores below are of no use.

    Absent places hold the least 64-bit score. Bounds have a margin for rounding, scores are exact integers.
    """
    own, rows, bounds, members, levels, route, top, nearest, farthest = pickle.loads(tree)
    upper, lower = (Level(*x) for x in levels)
    n, none = len(ids), np.iinfo(np.int64).min
    exact = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * rows.shape[1] < 2**53
    left, right = (rows.astype(float), queries.astype(float)) if exact else (rows.astype(np.int64), queries)
    lifted = np.column_stack([queries.astype(float), np.zeros(n)])
    square = (lifted * lifted).sum(axis=1) + top
    slack = 1e-9 * square + 1.0
    scores, found = np.full((n, k), none), np.full((n, k), np.iinfo(np.int64).max)
    useful = least.copy()

    def reach() -> np.ndarray:
        """The distance within which a point could still enter."""
        worst = np.maximum(scores[:, -1], useful)
        far = np.sqrt(np.maximum(square - 2.0 * worst.astype(float) + slack, 0))
        return np.where(worst == none, np.inf, far)

    within = reach()
    to_route = _distances(lifted, route[None])
    gap = np.maximum(np.maximum(nearest - to_route, to_route - farthest), 0)
    to_node, least_node = _below(lifted, upper, to_route, within, gap)
    with np.errstate(invalid="ignore"):  # nodes that are ruled out
        to_page, closest = _below(lifted, lower, to_node, within, least_node)
    order = np.argsort(closest, axis=1, kind="stable")
    live = np.arange(n)
    for turn in range(order.shape[1]):
        within = reach()
        page = order[live, turn]
        live, page = live[(keep := closest[live, page] <= within[live])], page[keep]
        if not len(live):
            break
        for p in np.unique(page):
            q = live[page == p]
            a, b = bounds[p], bounds[p + 1]
            near = np.abs(to_page[q, p][:, None] - members[None, a:b]) <= within[q][:, None]
            at = a + np.flatnonzero(near.any(axis=0))
            if not len(at):
                continue
            got = (right[q] @ left[at].T).astype(np.int64)
            got[(own[at][None, :] == ids[q][:, None]) | (got < useful[q][:, None])] = none
            names = np.where(got == none, np.iinfo(np.int64).max, own[at][None, :])
            merged, named = np.concatenate([scores[q], got], axis=1), np.concatenate([found[q], names], axis=1)
            best = np.lexsort((named, -merged.astype(float) if exact else ~merged), axis=1)[:, :k]
            scores[q], found[q] = np.take_along_axis(merged, best, 1), np.take_along_axis(named, best, 1)
    return scores, found


def _nearest(points: np.ndarray, routes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    far = _distances(points, routes)
    cell = far.argmin(axis=1)
    return cell, far[np.arange(len(points)), cell]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, tree_rows: int = TREE_ROWS, block_queries: int = BLOCK_QUERIES, n_routes: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all other rows for each vec_id divisible by ``every``.

    Ties go to the smaller vec_id. Every row is a candidate and, if its vec_id is
    divisible, a query of its own: rows of one vec_id, also equal ones, stand beside each
    other, and only the query's own row is left out. Vectors of unequal lengths are
    compared over the shorter one. Nulls and non-finite components take no part; an empty
    table gives no rows; other columns are not read. ``n_routes`` follows from the number
    of vectors if None.
    """
    spark = vectors.sparkSession
    python_ready(spark)
    # rows are numbered in order of vec_id, and the number stands for the row from here on, so that ties go by it
    salted = quantized(vectors).withColumn("_salt", F.monotonically_increasing_id())
    numbered = cut(ranked(salted, [F.col("vec_id").asc(), F.col("_salt").asc()], "row").drop("_salt"))
    names, rows = numbered.select("row", "vec_id"), numbered.select(F.col("row").alias("vec_id"), "v", (F.col("vec_id") % every == 0).alias("asks"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.max(square).alias("top"), F.max(F.size("v")).alias("width"), F.count("*").alias("n"), F.count_if("asks").alias("queries")).first()
    top, width = facts["top"] or 0.0, max(facts["width"] or 0, 1)
    n_routes = n_routes or min(max(ROUTES, facts["n"] // (CELL_TREES * tree_rows)), MOST_ROUTES)
    # of equal vectors the k + 1 first rows are all that can be returned; Spark keeps no more of each before it shuffles them
    indexed = rows.drop("asks").withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("n") <= k + 1).drop("n")
    sample = indexed.orderBy(F.xxhash64("vec_id")).limit(max(SAMPLE_ROWS, SAMPLE_SHARE * n_routes)).select("v").toArrow()
    routes = spread_out(_lifted(_matrix(sample.column("v"), width), top), n_routes) if sample.num_rows else np.zeros((1, width + 1))
    sent = spark.sparkContext.broadcast(routes)  # MOST_ROUTES rows at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, far = _nearest(_lifted(_matrix(batch.column(1), width), top), sent.value)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(far)], ["vec_id", "v", "cell", "far"])

    placed = cut(ranked(indexed.mapInArrow(place, "vec_id long, v array<long>, cell int, far double"), [F.col("cell"), F.col("far"), F.col("vec_id")], "at"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    cells = sizes.select("cell", "n", "first", F.ceil(F.col("n") / tree_rows).cast("long").alias("trees"))
    part = F.floor((F.col("at") - F.col("first")) * F.col("trees") / F.col("n")).cast("int")
    dealt = placed.join(F.broadcast(cells), "cell").select("cell", part.alias("part"), "vec_id", "v", "far")  # a row per routing object
    shell = F.floor(F.col("part") / SHELL_TREES).cast("int").alias("shell")
    spans = cut(dealt.groupBy("cell", "part").agg(F.min("far").alias("nearest"), F.max("far").alias("farthest")))
    shells = spans.groupBy("cell", shell).agg(F.min("nearest").alias("nearest"), F.max("farthest").alias("farthest"))

    def make(key: tuple, table: pa.Table) -> pa.Table:
        tree = build(table.column("vec_id").to_numpy(), _matrix(table.column("v"), width), sent.value[key[0].as_py()], top)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "tree": pa.array([tree], pa.binary())})

    trees = cut(dealt.drop("far").groupBy("cell", "part").applyInArrow(make, "cell int, part int, tree binary").withColumn("shell", shell))
    blocks = max(1, -(-facts["queries"] // block_queries))

    def lifted(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([_matrix(batch.column(1), width).astype(float), np.zeros(len(batch))])

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, to_route = _nearest(lifted(batch), sent.value) if len(batch) else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(to_route)], ["query_id", "q", "cell", "to_route"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                block = batch.column("block").slice(i, 1).flatten()
                ids, least = block.field("query_id").to_numpy(), block.field("least").to_numpy()
                scores, names = search(batch.column("tree")[i].as_py(), ids, _matrix(block.field("q"), width), least, k)
                ok = scores != np.iinfo(np.int64).min
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, ok.sum(axis=1))), pa.array(names[ok]), pa.array(scores[ok])], ["query_id", "vec_id", "score"])

    def searched(queries: DataFrame, on: list[str]) -> DataFrame:
        """Queries meet trees in blocks of bounded size."""
        blocked = queries.withColumn("b", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).groupBy(*on, "b").agg(F.collect_list(F.struct("query_id", "q", "least")).alias("block"))
        return trees.join(blocked, on).select("tree", "block").mapInArrow(run, "query_id long, vec_id long, score long")

    def best(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    none = F.lit(int(np.iinfo(np.int64).min)).alias("least")
    asked = rows.where("asks").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    asked = cut(asked.mapInArrow(home, "query_id long, q array<long>, cell int, to_route double"))
    gap = F.greatest(F.col("nearest") - F.col("to_route"), F.col("to_route") - F.col("farthest"), F.lit(0.0)).alias("gap")
    homes = asked.select("query_id", "cell", "to_route").join(spans, "cell").groupBy("query_id", "cell").agg(F.min(F.struct(gap, "part"))["part"].alias("part"))
    at_home = asked.drop("cell", "to_route").join(homes, "query_id").select("query_id", "q", "cell", "part", none)
    bound = best(searched(at_home, ["cell", "part"])).groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n")).where(F.col("n") >= k).select("query_id", "kth")
    bounded = asked.join(bound, "query_id", "left").select("query_id", "q", F.coalesce("kth", F.lit(int(np.iinfo(np.int64).min))).alias("least"))

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's distances to all routing objects, and the one within which a better point must lie."""
        for batch in batches:
            points, least = lifted(batch), batch.column(2).to_numpy()
            square = (points * points).sum(axis=1) + top
            within = np.where(least == np.iinfo(np.int64).min, np.inf, np.sqrt(np.maximum(square - 2.0 * least.astype(float) + 1e-9 * square + 1.0, 0)))
            far = pa.array(list(_distances(points, sent.value)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), far, pa.array(within)], ["query_id", "least", "far", "within"])

    near = bounded.mapInArrow(reach, "query_id long, least long, far array<double>, within double")
    near = near.select("query_id", "least", "within", F.posexplode("far").alias("cell", "to_route"))
    visits = near.join(shells, "cell").where((F.col("to_route") - F.col("within") <= F.col("farthest")) & (F.col("to_route") + F.col("within") >= F.col("nearest")))
    visits = visits.select("query_id", "least", "cell", "shell").join(asked.select("query_id", "q"), "query_id")  # vectors go only where there is something to find
    found = best(searched(visits, ["cell", "shell"]))
    asker, other = names.select(F.col("row").alias("query_id"), F.col("vec_id").alias("_query")), names.select(F.col("row").alias("vec_id"), F.col("vec_id").alias("_vec"))
    return found.join(asker, "query_id").join(other, "vec_id").select(F.col("_query").alias("query_id"), "rank", F.col("_vec").alias("vec_id"), "score")
