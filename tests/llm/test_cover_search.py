"""Cover-tree search against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import cover_search

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, rid int, cell string, score double"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "c", 0.5) for i, v in rows], SCHEMA)


def plain(rows, k=5):
    whole = []
    for i, v in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (i, v) in enumerate(whole):
        if i is None or i % 50:
            continue
        scores = [(-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for m, (j, w) in enumerate(whole) if m != n]
        out += [(i, r + 1, None if none else j, -s) for r, (s, none, j) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect())


def vectors(seed, n, dims=8, clusters=7):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(clusters, dims)) * 2
    points = middles[rng.integers(0, clusters, n)] + rng.normal(size=(n, dims)) * 0.2
    return [(int(i), [float(x) for x in p]) for i, p in zip(rng.permutation(n * 3)[:n], points, strict=True)]


@pytest.mark.parametrize("size", [{}, {"sample": 40, "cells": 24, "block": 20, "query_block": 3}])
def test_search_matches_all_products(spark, size):
    """Also with groups of few rows, so that leaves are dealt out in pieces, and with a vector that a third of the rows share."""
    rows = vectors(1, 420) + [(10_000 + k, [1.0] * 8) for k in range(240)]
    df = frame(spark, rows).repartition(4)
    assert got(cover_search.top_k(df, F.col("vec_id") % 50 == 0, **size)) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (50, [1.0, 2.0]), (50, [1.0, 2.0]), (100, None), (150, [None, 1.0]), (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]),
        (300, []), (350, [0.0, 0.0, -1.0]), (None, [1.0, 2.0]), (None, [3.0, 0.001]), (-50, [-0.001, 0.5]), (7, [1.0, 2.0]), (8, [3.0]), (9, [1e18, 1e18]),
    ]
    low, high = -(1 << 63), (1 << 63) - 1
    want = sorted((q, r, j, min(max(s, low), high)) for q, r, j, s in plain(rows))
    order = lambda rs: sorted(rs, key=lambda r: (r[0], r[1]))  # noqa: E731  queries that share an id: their rows in pairs
    a, b = order(got(cover_search.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0))), order(want)
    assert [(q, r, s) for q, r, _, s in a] == [(q, r, s) for q, r, _, s in b]
    assert {x for x in a if x[0] != 50} == {x for x in b if x[0] != 50}


def test_few_and_none(spark):
    for rows in ([], [(0, [1.0])], [(0, [1.0]), (1, [2.0])], [(1, [1.0]), (2, [2.0])], [(0, None)]):
        df = cover_search.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
        assert df.columns == ["query_id", "rank", "vec_id", "score"] and got(df) == plain(rows)


def test_pairs_of_nodes_are_pruned():
    """Clustered points: most pairs of leaves are never compared; all answers stay."""
    rng = np.random.default_rng(3)
    data = np.floor(256 * np.concatenate([m + 0.05 * rng.normal(size=(500, 16)) for m in 3 * rng.normal(size=(8, 16))]))
    queries, own = data[::40], np.arange(len(data))[::40]
    scores, places, compared = cover_search.dual_search(queries, data, np.full(len(queries), cover_search._LOW), own, 5)
    products = (queries @ data.T).astype(np.int64)
    for k, row in enumerate(products):
        want = [p for p in np.lexsort((np.arange(len(row)), -row)).tolist() if p != own[k]][:5]
        assert places[k].tolist() == want and scores[k].tolist() == row[want].tolist()
    root, order = cover_search.cover_tree(data)
    assert sorted(order.tolist()) == list(range(len(data)))
    for leaf in cover_search.leaves_of(root):
        assert cover_search.distances(data[order[leaf.low : leaf.high]], leaf.center).max() <= leaf.radius * (1 + 1e-12)
    leaves = sum(1 for _ in cover_search.leaves_of(root))
    assert compared < 0.5 * leaves * sum(1 for _ in cover_search.leaves_of(cover_search.cover_tree(queries, cover_search.QUERY_LEAF)[0]))


def test_bound_holds():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a, b = rng.normal(size=(20, 6)) * 300, rng.normal(size=(30, 6)) * 300
        assert (a @ b.T).max() <= cover_search.bound(a[0], float(cover_search.distances(a, a[0]).max()), b[0], float(cover_search.distances(b, b[0]).max()))
