from __future__ import annotations

import math
import random

import numpy as np
import pytest

from siltgate.llm import bidiagonal, whitening
from siltgate.llm.queries import QUERIES

DRAW = np.random.default_rng(11)
TURN = np.linalg.qr(DRAW.standard_normal((24, 24)))[0]
SCHEMA = "vec_id long, embedding array<float>, label int"

MATRICES = {
    "one": np.array([[3.0]]),
    "random": DRAW.standard_normal((24, 24)),
    "fewer rows than columns": DRAW.standard_normal((5, 24)),
    "nothing": np.zeros((4, 4)),
    "diagonal": np.diag(np.arange(12.0)),
    "all equal": TURN,
    "two values": TURN @ np.diag([10.0] * 9 + [1.0] * 15) @ TURN.T,
    "close": TURN @ np.diag(1 + 1e-9 * np.arange(24)) @ TURN.T,
    "closer": TURN @ np.diag(1 + 1e-13 * np.arange(24)) @ TURN.T,
    "graded": TURN @ np.diag(10.0 ** -np.arange(0, 12, 0.5)) @ TURN.T,
    "many rows": np.linalg.qr(DRAW.standard_normal((20_000, 24)), mode="r"),
}


@pytest.mark.parametrize("name", MATRICES)
def test_values_and_vectors(name):
    r = MATRICES[name]
    d = r.shape[1]
    values, vectors, total = bidiagonal.right_singular(r, d)
    expected = np.zeros(d)
    found = np.linalg.svd(r, compute_uv=False)
    expected[: len(found)] = found**2
    top = max(expected[0], 1e-300)
    assert np.abs(values - expected).max() <= 1e-13 * top
    assert abs(total - expected.sum()) <= 1e-12 * top
    assert np.abs(vectors.T @ vectors - np.eye(d)).max() < 1e-12
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() < 1e-12 * top


def test_bidiagonal_form():
    r = MATRICES["random"]
    a, b, w = bidiagonal.bidiagonalise(r)
    form = np.diag(a) + np.diag(b, 1)
    assert np.allclose(w @ form.T @ form @ w.T, r.T @ r, atol=1e-12)


def test_small_values_are_as_exact_as_large_ones():
    a, b = 10.0 ** -np.arange(30), 10.0 ** -np.arange(29)
    values = bidiagonal.squares(a, b)
    # The product of the singular values is that of the diagonal.
    assert math.isclose(np.log10(values).sum() / 2, -np.arange(30).sum(), abs_tol=1e-12)
    by_halving = sorted(bidiagonal._by_halving(a**2, b**2), reverse=True)
    assert np.allclose(by_halving, values, rtol=1e-12, atol=0)


def test_merged_blocks_are_the_whole():
    x = DRAW.integers(-500, 500, (1000, 7)) + 10**9
    whole = whitening.reduced(x[:1])
    for k in range(1, 1000, 37):
        whole = whitening.merged(whole, whitening.reduced(x[k : k + 37]))
    n, sums, r = whole
    assert n == 1000 and list(sums) == x.sum(axis=0).tolist()
    y = x - 10**9 - (x - 10**9).mean(axis=0)
    assert np.allclose(r.T @ r, y.T @ y, rtol=1e-12)


def by_hand(rows, many=32):
    """The contract on few rows: exact whole numbers, numpy's eigenvectors."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    deviation = ((x * n - sums) ** 2).sum(axis=1)
    centred = ((x * n - sums) / n).astype(float)
    e, z = np.linalg.eigh(centred.T @ centred / n)
    e, z = e[::-1][:many], z[:, ::-1][:, :many]
    return {(good[k][0], j + 1): (n, deviation[k], centred[k] @ z[:, j] / e[j] ** 0.5, e[j] / (centred**2).sum() * n)
            for k in range(n) for j in range(len(e))}


def check(got, rows, many=32):
    expected = by_hand(rows, many)
    assert len(got) == len(expected)
    signs = {}
    for r in got:
        n, deviation, whitened, explained = expected[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["explained"] / explained - 1) < 1e-9 and r["identity_error"] < 1e-9
        sign = signs.setdefault(r["component"], 1 if r["whitened"] * whitened >= 0 else -1)
        assert abs(sign * r["whitened"] - whitened) < 1e-7
    assert len({r["identity_error"] for r in got}) == 1


def test_rows_of_the_query(spark, tmp_path):
    draw = random.Random(2)
    rows = [(k, [draw.gauss(0, 1 + j) for j in range(6)]) for k in range(300)]
    rows += [(1000 + k, list(rows[0][1])) for k in range(150)]  # a third are copies
    odd = [
        (None, None), (2001, None), (2002, []), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, [float("nan")] * 6),
        (2005, [float("inf")] + [0.0] * 5), (2006, [1.0, 2.0]), (2007, [1e30] * 6),
    ]
    rows += [(3001, [-0.0] * 6), (3002, [-1e-9, 1 / 64, -1 / 64, 0.999, -0.999, 100.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], SCHEMA).selectExpr("*", "'x' AS x", "1 AS component", "2 AS part")
    df.repartition(40).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op11_whitening"](spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(got.collect(), rows)


def test_fewer_components_and_rounds_of_merging(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    monkeypatch.setattr(whitening, "BLOCK", 4)
    rows = [(k, DRAW.standard_normal(5).tolist()) for k in range(200)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(20)
    check(whitening.whiten(whitening.fixed_point(df), 3).collect(), rows, 3)


@pytest.mark.parametrize("vectors", [[], [None], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_nothing_to_scale(spark, vectors):
    df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(vectors)], SCHEMA)
    assert whitening.whiten(whitening.fixed_point(df)).count() == 0


def test_directions_without_variance_are_left_out(spark):
    df = spark.createDataFrame([(k, [k / 7, 2 * k / 7, 5.0], 0) for k in range(0, 700, 7)], SCHEMA)
    got = whitening.whiten(whitening.fixed_point(df)).collect()
    assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-12


def test_a_deviation_that_is_no_long_is_null():
    model = whitening.Whitening(3, (0, 3 * 2**40), np.eye(2), np.ones(2), 2.0)
    assert model.deviations(np.array([[0, 2**40], [1, 2**40 + 1]])) == [0, 18]
    assert model.deviations(np.array([[2**33, 2**40]])) == [None]
