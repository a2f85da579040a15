import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from savora.llm import metric_tree as mt

SCHEMA = "vec_id long, embedding array<double>"


def plain(rows, every, top=5):
    vectors = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (query, q) in enumerate(vectors):
        if query % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for other, (i, v) in enumerate(vectors) if other != at and len(v) == len(q))
            out += [(query, rank, i, -s) for rank, (s, i) in enumerate(scores[:top], 1)]
    return sorted(out)


def rows_of(spark, rows, every=3, parts=3, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in mt.search(df.repartition(parts) if rows else df, every, **options).collect())


def clustered(n, dims=4, seed=5):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(dims)] for _ in range(12)]
    return [(i, [x + draw.gauss(0, 0.05) for x in draw.choice(centres)]) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    for name, value in (("TREE", 40), ("PAGE", 5), ("FANOUT", 3), ("BLOCK_BITS", 3)):
        monkeypatch.setattr(mt, name, value)


def test_same_as_brute_force(spark, small):
    rows = clustered(300) + [(i, [0.0] * 4) for i in (300, 301, 303)] + [(i, [0.5, 0.5, 0.0, -0.25]) for i in range(400, 430)] + [(402, [0.5, 0.5, 0.0, -0.25])]
    assert rows_of(spark, rows) == plain(rows, 3)


def test_cells_of_many_entries_are_split(spark, small, monkeypatch):
    monkeypatch.setattr(mt, "CELLS", 2)
    rows = clustered(260, seed=8)
    assert rows_of(spark, rows, every=10, top=3) == plain(rows, 10, 3)


def test_odd_rows(spark):
    rows = [(None, [1.0, 2.0]), (3, None), (6, [1.0, None]), (9, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (15, [1.0, 2.0]), (16, [1.0, 2.0]), (15, [1.0, 2.0]), (18, []), (19, []), (21, [1.0, 2.0, 3.0]),
            (22, [-1.0, -2.0]), (24, [0.0, 0.0]), (27, [-0.001, 0.0])]
    assert rows_of(spark, rows) == plain(rows, 3)
    assert rows_of(spark, []) == []
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("key", "tree", "ids", "dims", "vector", "rank", "score", "nth")})
    assert sorted(tuple(r) for r in mt.search(df, 3).collect()) == plain(rows, 3)


def test_scores_beyond_exact_doubles(spark):
    """Products above 2^53, which differ in the last digits only."""
    rows = [(i, [float(2 ** 22 + i), float(2 ** 21 - 3 * i), 1.0 / 256 * i]) for i in range(40)]
    got = rows_of(spark, rows)
    assert got == plain(rows, 3) and max(r[3] for r in got) > 2 ** 53


def test_third_of_all_rows_is_one_vector(spark, small):
    rows = clustered(120, seed=2) + [(1000 + i, [0.7, 0.1, -0.2, 0.4]) for i in range(60)]
    assert rows_of(spark, rows) == plain(rows, 3)


def tree_of(vectors):
    order, nodes, to_pivot = mt.build(vectors)
    return order, mt.Tree(vectors[order], nodes, to_pivot, [[int(i)] for i in order])


def test_radii_and_distances_hold(small):
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v in clustered(200)])
    order, tree = tree_of(vectors)
    assert sorted(order.tolist()) == list(range(200))
    units, lengths = mt.directions(tree.vectors), mt.lengths_of(tree.vectors)
    for node in tree.nodes:
        own = slice(node["start"], node["stop"])
        apart = mt.angles(units[own], units[node["pivot"]:node["pivot"] + 1])[:, 0]
        assert apart.max() <= node["radius"] + 1e-7
        assert node["shortest"] <= lengths[own].min() and lengths[own].max() <= node["longest"]
        for child in tree.nodes[node["first"]:node["first"] + node["children"]]:
            assert node["start"] <= child["start"] < child["stop"] <= node["stop"]
            between = mt.angles(units[child["pivot"]:child["pivot"] + 1], units[node["pivot"]:node["pivot"] + 1])[0, 0]
            assert abs(child["to_parent"] - between) < 1e-7
        if not node["children"]:
            assert node["stop"] - node["start"] <= mt.PAGE or not node["radius"]
            assert np.allclose(tree.to_pivot[own], apart, atol=1e-7)


def test_bounds_avoid_computations(small):
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v in clustered(3000)])
    _, tree = tree_of(vectors)
    tree.search(vectors[:20], np.full(20, -np.inf), 6)
    assert tree.computed < 0.25 * 20 * len(vectors)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=60), st.lists(st.lists(st.integers(-6, 6), min_size=3, max_size=3), min_size=1, max_size=5),
       st.one_of(st.none(), st.integers(-60, 60)))
def test_tree_finds_all_that_reach_the_floor(vectors, queries, floor):
    before, mt.PAGE = mt.PAGE, 4
    try:
        vectors, queries = np.array(vectors), np.array(queries)
        _, tree = tree_of(vectors)
        floors = np.full(len(queries), -np.inf if floor is None else floor, float)
        expected = [sorted((-int(q @ v), i) for i, v in enumerate(vectors) if floor is None or q @ v >= floor)[:4] for q in queries]
        assert tree.search(queries, floors, 4) == expected
    finally:
        mt.PAGE = before
