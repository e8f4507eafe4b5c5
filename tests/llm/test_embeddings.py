from __future__ import annotations

import numpy as np
import pytest

from siltgate.llm import embeddings as em
from siltgate.llm.queries import QUERIES


def brute(rows, threshold=0.95):
    units = em._units([x for _, x in rows])
    n = len(rows)
    links, label = [0] * n, list(range(n))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= threshold:
                links[i] += 1
                links[j] += 1
                label[find(i)] = find(j)
    least = {}
    for i, (v, _) in enumerate(rows):
        if v is not None:
            least[find(i)] = min(v, least.get(find(i), v))
    return sorted(((v, links[i], least.get(find(i))) for i, (v, _) in enumerate(rows)), key=repr)


def vectors(seed=0, dim=16):
    draw = np.random.default_rng(seed)
    rows = []
    for size, noise in ((1, 0), (2, 0.05), (40, 0.06), (60, 0.075), (5, 0)):
        centre = draw.standard_normal(dim)
        centre /= np.linalg.norm(centre)
        rows += [centre + noise * draw.standard_normal(dim) for _ in range(size)]
    rows += [draw.standard_normal(dim) for _ in range(60)]
    return [(1000 - i, [float(np.float32(v)) for v in x]) for i, x in enumerate(rows)]


@pytest.mark.parametrize("cell_vectors", [10, 1000])
def test_links_equal_brute_force(spark, monkeypatch, cell_vectors):
    monkeypatch.setattr(em, "BLOCK", 16)
    rows = vectors()
    x = rows[0][1]
    rows += [(1, None), (2, [0.0] * 16), (3, [float("nan")] + x[1:]), (4, [float("inf")] + x[1:])]
    rows += [(5, [None, *x[1:]]), (6, []), (7, x[:8]), (None, x), rows[3], (8, [1e-30 * v for v in x])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS v", "2 AS cell", "3 AS n")
    got = em.near_vectors(df, cell_vectors=cell_vectors, margin=float(np.sqrt(1 - 0.95**2))).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_with_the_default_margin():
    """Pairs exactly at the threshold, in random directions, across the borders of many cells."""
    draw = np.random.default_rng(5)
    dim, n, t = 64, 4000, 0.95
    x = draw.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = draw.standard_normal((n, dim))
    side -= (side * x).sum(axis=1)[:, None] * x
    y = t * x + np.sqrt(1 - t * t) * side / np.linalg.norm(side, axis=1)[:, None]
    centres = em.fit_centres(np.vstack((x, y)), 64)
    margin = em.REACH * np.sqrt(2 * (1 - t) / dim)
    home_x, home_y = (x @ centres.T).argmax(1), (y @ centres.T).argmax(1)
    from_y = home_x < home_y  # the one with the larger home visits the other
    a, home, other = np.where(from_y[:, None], y, x), np.where(from_y, home_y, home_x), np.where(from_y, home_x, home_y)
    u = centres[other] - centres[home]
    found = (home == other) | (((a * u).sum(1)) >= -margin * np.linalg.norm(u, axis=1))
    assert (home != other).sum() > 400
    assert found.mean() > 0.999


def test_vectors_of_few_directions_keep_all_links(spark):
    """64 dimensions of which the vectors use four, in 40 cells."""
    draw = np.random.default_rng(3)
    x = draw.standard_normal((200, 4))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = draw.standard_normal((200, 4))
    side -= (side * x).sum(axis=1)[:, None] * x
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * side / np.linalg.norm(side, axis=1)[:, None]
    turned = np.vstack((x, y)) @ np.linalg.qr(draw.standard_normal((64, 4)))[0].T
    rows = [(i, v.tolist()) for i, v in enumerate(turned)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = em.near_vectors(df, cell_vectors=10).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)


def test_lengths_are_compared_each_for_itself(spark):
    """Two vectors of three entries link beside many of two."""
    rows = [(k, [1.0, float(k)]) for k in range(0, 300, 100)] + [(500, [1.0, 0.0, 0.0]), (501, [1.0, 0.01, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in em.near_vectors(df, cell_vectors=1).collect())
    assert got == brute(rows) and got[-1] == (501, 1, 500)


@pytest.mark.parametrize("dims", [64, 16, 4])
def test_recall_is_measured(spark, dims):
    """Planted pairs at and above the threshold, among vectors of 64 entries that use fewer."""
    draw = np.random.default_rng(dims)
    x = draw.standard_normal((1500, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = draw.standard_normal((1500, dims))
    side -= (side * x).sum(axis=1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    cos = np.where(np.arange(1500) % 2 == 0, 0.9501, 0.97)[:, None]
    y = cos * x + np.sqrt(1 - cos**2) * side
    turned = np.vstack((x, y)) @ np.linalg.qr(draw.standard_normal((64, dims)))[0].T
    df = spark.createDataFrame(list(enumerate(turned.tolist())), "vec_id long, embedding array<double>")
    found, there = em.measured_recall(df, every=5)
    assert there >= 600 and 0.99 * there <= found <= there
    assert em.measured_recall(df, every=5, margin=em.EXACT) == (there, there)


def test_empty_and_all_null(spark):
    schema = "vec_id long, embedding array<float>"
    assert em.near_vectors(spark.createDataFrame([], schema)).collect() == []
    only = em.near_vectors(spark.createDataFrame([(4, None)], schema)).collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in only] == [(4, 0, 4, True)]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op5_embeddings"](spark, sf).collect()
    rows = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=repr) == brute(rows)
