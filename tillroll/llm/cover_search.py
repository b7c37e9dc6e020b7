"""Exact search for the k largest inner products by two cover trees.

A cover tree splits a node of points among children whose centres are points of it, far apart from
each other, and notes for each node its covering radius: no point of it is farther from its centre.
Here a node's children are chosen farthest first, so their centres are at least as far apart as the
radius that they leave uncovered.  For a query node with centre p and radius r and a data node with
centre c and radius s, no inner product exceeds <p, c> + r|c| + s|p| + rs.  A pair of nodes whose
bound is below the worst k-th score of the query node's members can't change any answer.

The upper levels of one tree hold queries and data together.  They are fitted on a bounded sample
(`SAMPLE` vectors), every row then goes to the nearest of at most `CELLS` leaves, and the leaves'
radii are measured over all rows.  Nodes of up to `BLOCK` rows are the groups of data, those of up to
`QUERY_BLOCK` queries the groups of queries; a leaf with more rows is dealt out in pieces.  First
each group of queries meets the groups of data nearest to it, which gives its worst k-th score; then only
those groups of data whose bound reaches it.  Each pair of groups meets in a task of its own, which
goes on with the lower levels: a tree of the group's queries against one of its data.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tillroll.llm.shared import staged

#: Vectors that the upper levels are fitted on, and leaves that they have at most.
SAMPLE = 2048
CELLS = 256
#: Rows of a group of data, and queries of a group of queries.
BLOCK = 4096
QUERY_BLOCK = 4096
#: Children of a node, points and queries of a leaf in a task.
FAN = 8
LEAF = 512
QUERY_LEAF = 64

_LOW = np.iinfo(np.int64).min


@dataclass(eq=False)
class Node:
    """A node over the points [low, high) of a tree's order."""

    low: int
    high: int
    center: np.ndarray
    radius: float
    children: list["Node"] = field(default_factory=list)


def distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.linalg.norm(points - center, axis=1)


def cover_tree(points: np.ndarray, leaf: int = LEAF, fan: int = FAN, leaves: int | None = None) -> tuple[Node, np.ndarray]:
    """The tree of the points, and their order: a node's points lie together in it.

    Nodes of more than `leaf` points are split, widest first, until the tree has `leaves` leaves.
    """
    order = np.arange(len(points))
    middle = points[int(distances(points, points.mean(0)).argmin())]
    root = Node(0, len(points), middle, float(distances(points, middle).max()))
    open_nodes, count = [root], 1
    while open_nodes and (leaves is None or count + fan <= leaves):
        node = max(open_nodes, key=lambda n: n.radius) if leaves else open_nodes[-1]
        open_nodes.remove(node)
        if node.high - node.low <= leaf or not node.radius > 0:
            continue
        own = order[node.low : node.high]
        inside = points[own]
        # Farthest first; the node's own centre is the first child's.
        near, of = distances(inside, node.center), np.zeros(len(own), np.int64)
        centers = [node.center]
        while len(centers) < fan and near.max() > 0:
            centers.append(inside[int(near.argmax())])
            away = distances(inside, centers[-1])
            of[away < near] = len(centers) - 1
            near = np.minimum(near, away)
        by = np.argsort(of, kind="stable")
        order[node.low : node.high] = own[by]
        edges = node.low + np.searchsorted(of[by], np.arange(len(centers) + 1))
        near = near[by]
        for k, center in enumerate(centers):
            low, high = int(edges[k]), int(edges[k + 1])
            if low < high:
                node.children.append(Node(low, high, center, float(near[low - node.low : high - node.low].max())))
        open_nodes += node.children
        count += len(node.children) - 1
    return root, order


def leaves_of(node: Node) -> Iterator[Node]:
    if not node.children:
        yield node
    for child in node.children:
        yield from leaves_of(child)


def bound(p: np.ndarray, r: float, c: np.ndarray, s: float) -> float:
    """No inner product of members of the two nodes is larger; rounding is allowed for."""
    n, m = float(np.linalg.norm(p)), float(np.linalg.norm(c))
    return float(p @ c) + r * m + s * n + r * s + 1e-9 * (n + r) * (m + s) + 1e-6


def exact_scores(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers as 64-bit integers; those beyond take the nearest one."""
    if np.abs(queries).sum(1).max(initial=0) * np.abs(data).max(initial=0) < 1 << 53:
        return (queries @ data.T).astype(np.int64)
    a, b = ([[int(x) for x in row] for row in m] for m in (queries, data))
    low, high = _LOW, np.iinfo(np.int64).max
    return np.array([[min(max(sum(x * y for x, y in zip(p, c, strict=True)), low), high) for c in b] for p in a], np.int64)


class Best:
    """The best k candidates of each query so far: scores, falling, and places in the data; place -1 is none."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        self.scores = np.full((len(floors), k), _LOW)
        self.places = np.full((len(floors), k), -1)
        self.floors = floors

    def worst(self, low: int, high: int) -> int:
        return int(np.maximum(self.scores[low:high, -1], self.floors[low:high]).min())

    def offer(self, low: int, scores: np.ndarray, places: np.ndarray, counts: np.ndarray) -> None:
        """Scores of queries from `low` on and the data at the places, those that count; of equal scores the smaller place wins."""
        least = np.maximum(self.scores[low : low + len(scores), -1], self.floors[low : low + len(scores)])
        hit = (scores >= least[:, None]) & counts
        for row in np.flatnonzero(hit.any(1)).tolist():
            s, p = scores[row][hit[row]], places[hit[row]]
            known = self.places[low + row] >= 0
            s, p = np.concatenate([self.scores[low + row][known], s]), np.concatenate([self.places[low + row][known], p])
            first = np.lexsort((p, -1 - s))[: self.scores.shape[1]]
            self.scores[low + row, : len(first)], self.places[low + row, : len(first)] = s[first], p[first]


def dual_search(queries: np.ndarray, data: np.ndarray, floors: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores and places of each query's best k among the data, scores below its floor left out, and the number of pairs of
    leaves that were compared.  The data are in the order in which ties are decided; own: the place of the query itself in
    the data, or -1."""
    q_root, q_order = cover_tree(queries, QUERY_LEAF)
    d_root, d_order = cover_tree(data)
    queries, data = queries[q_order], data[d_order]
    best, compared = Best(floors[q_order], k), 0
    own = own[q_order]
    stack = [(bound(q_root.center, q_root.radius, d_root.center, d_root.radius), q_root, d_root)]
    while stack:
        most, q, d = stack.pop()
        if most < best.worst(q.low, q.high):
            continue
        if not q.children and not d.children:
            compared += 1
            scores, places = exact_scores(queries[q.low : q.high], data[d.low : d.high]), d_order[d.low : d.high]
            itself = own[q.low : q.high, None] == places[None, :]
            best.offer(q.low, scores, places, ~itself)
            continue
        wide = d.children and (not q.children or d.radius >= q.radius)
        pairs = [(q, c) for c in d.children] if wide else [(c, d) for c in q.children]
        stack += sorted(((bound(a.center, a.radius, b.center, b.radius), a, b) for a, b in pairs), key=lambda x: x[0])
    scores, places = np.empty_like(best.scores), np.empty_like(best.places)
    scores[q_order], places[q_order] = best.scores, best.places
    return scores, places, compared


def matrix(column: pa.Array | pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """The vectors as rows; shorter ones end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    sizes = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), np.float64)
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def widened(points: np.ndarray, width: int) -> np.ndarray:
    return points if points.shape[1] >= width else np.pad(points, ((0, 0), (0, width - points.shape[1])))


def whole_numbers(embedding: Column) -> Column:
    """floor(256 x) of each component x."""
    def scaled(x: Column) -> Column:
        y = x.cast("double") * 256
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)

    return F.transform(embedding, scaled)


def _cells(batches: Iterator[pa.RecordBatch], centers) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        points = matrix(batch.column("v"))
        own = widened(centers.value, points.shape[1])
        points = widened(points, own.shape[1])
        cell, away = np.empty(len(points), np.int32), np.empty(len(points))
        for at in range(0, len(points), 4096):
            some = points[at : at + 4096]
            cell[at : at + 4096] = ((own * own).sum(1) - 2 * some @ own.T).argmin(1)
            away[at : at + 4096] = np.linalg.norm(some - own[cell[at : at + 4096]], axis=1)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(away)], [*batch.schema.names, "cell", "away"])


@dataclass(eq=False)
class Group:
    """Cells below one node: their rows, centre, covering radius and the pieces they are dealt out in."""

    cells: list[int]
    center: np.ndarray
    radius: float
    rows: int
    pieces: int


def groups(node: Node, number: dict[int, int], centers: np.ndarray, rows: dict[int, int], radius: dict[int, float], most: int) -> list[Group]:
    """The highest nodes of at most `most` rows, and leaves, with any rows at all.  rows, radius: by cell."""
    cells = [number[leaf.low] for leaf in leaves_of(node)]
    total = sum(rows.get(c, 0) for c in cells)
    if not total:
        return []
    if total > most and node.children:
        return [g for child in node.children for g in groups(child, number, centers, rows, radius, most)]
    filled = [c for c in cells if rows.get(c, 0)]
    reach = max(float(np.linalg.norm(centers[c] - node.center)) + radius[c] for c in filled)
    return [Group(filled, node.center, reach * (1 + 1e-9), total, math.ceil(total / most))]


def _meet(key: tuple, left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The queries (left) and the data (right) of a pair of pieces: candidates of each query."""
    schema = pa.schema([("qid", pa.int64()), ("query_id", pa.int64()), ("rid", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not len(left) or not len(right):
        return schema.empty_table()
    right = right.sort_by([("vec_id", "ascending"), ("rid", "ascending")])  # NULL ids last: the order of ties
    queries, data = matrix(left.column("v")), matrix(right.column("v"))
    width = max(queries.shape[1], data.shape[1])
    rids, qids = right.column("rid").to_numpy(), left.column("rid").to_numpy()
    by = np.argsort(rids)
    place = np.minimum(np.searchsorted(rids[by], qids), len(rids) - 1)
    own = np.where(rids[by][place] == qids, by[place], -1)
    floors = left.column("floor").fill_null(_LOW).to_numpy()
    scores, places, _ = dual_search(widened(queries, width), widened(data, width), floors, own, k)
    row, col = np.nonzero((places >= 0) & (scores >= floors[:, None]))
    at = places[row, col]
    return pa.table([left.column("rid").take(row), left.column("vec_id").take(row), right.column("rid").take(at), right.column("vec_id").take(at), pa.array(scores[row, col])], schema=schema)


def _first(candidates: DataFrame, k: int) -> DataFrame:
    """The k best candidates of each query, with rank."""
    order = Window.partitionBy("qid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "rid")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _met(placed: DataFrame, queries: DataFrame, pairs: list[tuple[int, int, int, int, bool]], k: int) -> DataFrame:
    """Candidates from pairs (query group, its pieces, data group, its pieces, only the first of these).  The list is
    bounded by the square of the number of cells."""
    spark = placed.sparkSession
    table = spark.createDataFrame(pairs, "qg int, qn int, dg int, dn int, first boolean")
    data = placed.select("rid", "vec_id", "v", "dg", F.pmod(F.xxhash64("rid"), "dn").cast("int").alias("dp"))
    chosen = F.broadcast(table.select("qg", "qn", "dg", "first"))
    data = data.join(chosen, "dg").where(~F.col("first") | (F.col("dp") == 0)).drop("first")
    data = data.withColumn("qp", F.explode(F.sequence(F.lit(0), F.col("qn") - 1))).drop("qn")
    asking = queries.select("rid", "vec_id", "v", "floor", "qg", F.pmod(F.xxhash64("rid"), "qn").cast("int").alias("qp"))
    asking = asking.join(F.broadcast(table.select("qg", "dg", F.when(F.col("first"), 1).otherwise(F.col("dn")).alias("parts"))), "qg")
    asking = asking.withColumn("dp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    key = ["qg", "qp", "dg", "dp"]
    data = data.select(*[F.col(c).alias(c) for c in data.columns])  # both sides come from one frame
    return asking.groupBy(*key).cogroup(data.groupBy(*key)).applyInArrow(
        lambda key, left, right: _meet(key, left, right, k), "qid bigint, query_id bigint, rid bigint, vec_id bigint, score bigint"
    )


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, sample: int = SAMPLE, cells: int = CELLS, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: of each query row the k rows of largest inner product.

    vectors: vec_id and embedding; the product is that of floor(256 x) of the components, and a row
    isn't a candidate of its own.  Of equal scores the smaller vec_id comes first, NULL last.  Queries get all
    candidates where there are fewer than k.  Rows whose embedding is NULL or has a component that is NULL, not
    finite or not finite when scaled take no part; shorter vectors count as ending in zeros, an empty one scores
    0.  Scores beyond 64 bits are given as the nearest 64-bit number.  Rows that share an id each ask and answer for
    themselves.  Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    asked = vectors.select(
        F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("bigint").alias("vec_id"), whole_numbers(F.col("embedding")).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    fits = F.col("v").isNotNull() & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    rows = staged(asked.where(fits), "vectors")  # from here on a row keeps its number
    some = rows.orderBy(F.xxhash64("v", "rid")).limit(sample).select("v").toArrow().column("v")
    out = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not len(some):
        return spark.createDataFrame([], out)
    points = matrix(some)
    root, order = cover_tree(points, leaf=1, leaves=cells)
    number = {leaf.low: n for n, leaf in enumerate(leaves_of(root))}
    centers = np.stack([leaf.center for leaf in leaves_of(root)])
    shared = spark.sparkContext.broadcast(centers)
    kind = rows.schema["v"].dataType.simpleString()
    found = staged(
        rows.mapInArrow(partial(_cells, centers=shared), f"rid bigint, vec_id bigint, v {kind}, asks boolean, cell int, away double"), "cells"
    )
    sums = found.groupBy("cell").agg(
        F.count("*").alias("n"), F.max("away").alias("r"), F.count_if("asks").alias("qn"), F.max(F.when(F.col("asks"), F.col("away"))).alias("qr")
    ).collect()  # one row for each cell
    data = groups(root, number, centers, {s.cell: s.n for s in sums}, {s.cell: s.r for s in sums}, block)
    asking = groups(root, number, centers, {s.cell: s.qn for s in sums}, {s.cell: s.qr for s in sums}, query_block)
    dealt = {s.cell: [0, 1, 0, 1] for s in sums}
    for kind_at, found_groups in ((0, asking), (2, data)):
        for n, g in enumerate(found_groups):
            for c in g.cells:
                dealt[c][kind_at : kind_at + 2] = [n, g.pieces]
    to_groups = spark.createDataFrame([(c, *x) for c, x in dealt.items()], "cell int, qg int, qn int, dg int, dn int")
    placed = found.join(F.broadcast(to_groups), "cell")  # one row for each cell
    queries = placed.where("asks")

    # Each group of queries first meets the data nearest to it, enough for k answers.
    seeds: dict[int, list[int]] = {}
    for n, g in enumerate(asking):
        enough, near = 0, sorted(range(len(data)), key=lambda m: -float(g.center @ data[m].center))
        for m in near:
            seeds.setdefault(n, []).append(m)
            enough += math.ceil(data[m].rows / data[m].pieces)
            if enough > 2 * k:
                break
    met = _met(placed, queries.withColumn("floor", F.lit(None).cast("bigint")), [(n, asking[n].pieces, m, data[m].pieces, True) for n, ms in seeds.items() for m in ms], k)
    begun = staged(_first(met, k), "begun")
    floors = begun.where(F.col("rank") == k).select(F.col("qid").alias("rid"), F.col("score").alias("floor"))
    known = staged(queries.join(floors, "rid", "left"), "floors")
    worst = {r.qg: r.worst for r in known.groupBy("qg").agg(F.min(F.coalesce("floor", F.lit(_LOW))).alias("worst")).collect()}
    pairs = []
    for n, g in enumerate(asking):
        for m, h in enumerate(data):
            if m in seeds[n] and h.pieces == 1:
                continue
            if not bound(g.center, g.radius, h.center, h.radius) < worst.get(n, _LOW):
                pairs.append((n, g.pieces, m, h.pieces, False))
    if pairs:
        # A first piece that was met before is met again with the rest of its group: equal candidates are one.
        begun = _first(begun.drop("rank").union(_met(placed, known, pairs, k)).dropDuplicates(["qid", "rid"]), k)
    return begun.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
