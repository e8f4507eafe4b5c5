"""Singular values and right singular vectors of a small matrix: Householder, dqds, twists.

``bidiagonalise`` takes a matrix to ``U B W'``.  ``squares`` finds the squared singular
values of ``B`` by differential quotient-difference steps with shifts, which subtract only
where it does no harm and so keep small values to high relative accuracy.  ``vectors`` takes
each eigenvector of ``B'B`` from the twisted factorisation with the least middle entry: the
top-down factorisation above it and the bottom-up one below.  Eigenvalues that lie close
together are first moved apart, relatively, by a shift to one of their ends.  Values that
are equal to working precision get any orthonormal basis of what they span.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(float).eps)
_TINY = 1e-290
#: Neighbours closer than this, relatively, are moved apart before vectors are taken.
_CLOSE = 1e-3
_DEPTH = 8


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit ``v`` with ``x - 2 v (v.x)`` a multiple of the first axis, and that multiple."""
    size = float(np.linalg.norm(x))
    v = x.copy()
    if size == 0:
        return np.zeros_like(v), 0.0
    top = -size if v[0] >= 0 else size
    v[0] -= top
    return v / np.linalg.norm(v), top


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a, b, w``: ``r = U B w'`` with ``a`` on the diagonal of ``B`` and ``b`` above it."""
    d = r.shape[1]
    m = np.zeros((max(d, len(r)), d))
    m[: len(r)] = r
    a, b, w = np.zeros(d), np.zeros(max(d - 1, 0)), np.eye(d)
    for k in range(d):
        v, a[k] = _reflector(m[k:, k])
        m[k:, k:] -= 2 * np.outer(v, v @ m[k:, k:])
        if k < d - 1:
            v, b[k] = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= 2 * np.outer(m[k:, k + 1 :] @ v, v)
            w[:, k + 1 :] -= 2 * np.outer(w[:, k + 1 :] @ v, v)
    return a, b, w


# --- values -------------------------------------------------------------------


def _step(q: list[float], e: list[float], shift: float):
    """One dqds step: the new arrays and the ``d`` of each row; None if the shift is too big."""
    d = q[0] - shift
    new_q, new_e, ds = [], [], [d]
    for k, below in enumerate(e):
        if d < 0:
            return None
        total = d + below
        ratio = q[k + 1] / total if total > _TINY else 0.0
        new_q.append(total)
        new_e.append(below * ratio)
        d = d * ratio - shift if total > _TINY else q[k + 1] - shift
        ds.append(d)
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e, ds


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal matrix, the largest first."""
    scale = max((float(np.abs(x).max()) for x in (a, b) if len(x)), default=0.0)
    if scale == 0:
        return np.zeros(len(a))
    out: list[float] = []
    q, e = ((x / scale) ** 2 for x in (a, b))
    blocks = [(q.tolist(), e.tolist(), 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        for _ in range(60 + 20 * len(q)):
            n = len(q)
            if n == 1:
                out.append(q[0] + sigma)
                break
            cut = next(
                (k for k in range(n - 1) if e[k] <= (4 * EPS) ** 2 * (sigma + min(q[k], q[k + 1])) + _TINY), None
            )
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], sigma))
                blocks.append((q[cut + 1 :], e[cut + 1 :], sigma))
                break
            if q[0] < q[-1]:  # the small ones belong at the end
                q, e = q[::-1], e[::-1]
            q, e, ds = _step(q, e, 0.0)
            least = min(ds)
            # 1 / d are the diagonal of the inverse: its trace bounds the least value from
            # below, its largest entry from above.
            safe = 1.0 / sum(1.0 / d for d in ds) if least > _TINY else 0.0
            for shift in (least * (1 - 1e-3), safe * (1 - 4 * n * EPS)):
                done = _step(q, e, shift) if shift > 0 else None
                if done:
                    q, e, _ = done
                    sigma += shift
                    break
        else:
            out.extend(sigma + x for x in _by_halving(np.array(q), np.array(e)))
    return np.sort(np.array(out))[::-1] * scale**2


def _by_halving(q: np.ndarray, e: np.ndarray) -> list[float]:
    """The same from counts of smaller values, should the steps not settle."""
    lower = np.sqrt(np.maximum(e, 0) / np.maximum(q[:-1], _TINY))
    top = float(q.max() + e.max() + 2 * np.sqrt(q.max() * e.max())) * 1.01
    return [_refined(q, lower, k, 0.0, top) for k in range(len(q))]


# --- factorisations -----------------------------------------------------------


def _stationary(d: np.ndarray, l: np.ndarray, shift: float):
    """``L+ D+ L+' = L D L' - shift`` from the top: ``D+``, ``L+`` and the remainders."""
    n = len(d)
    new_d, new_l, rest = np.empty(n), np.empty(max(n - 1, 0)), np.empty(n)
    s = -shift
    for k in range(n):
        rest[k] = s
        pivot = s + d[k]
        if abs(pivot) < _TINY:
            pivot = -_TINY
        new_d[k] = pivot
        if k < n - 1:
            new_l[k] = d[k] * l[k] / pivot
            s = new_l[k] * l[k] * s - shift
            if not math.isfinite(s):
                s = l[k] * l[k] * d[k] - shift
    return new_d, new_l, rest


def _progressive(d: np.ndarray, l: np.ndarray, shift: float):
    """``U- D- U-' = L D L' - shift`` from the bottom: ``U-`` and the remainders."""
    n = len(d)
    upper, rest = np.empty(max(n - 1, 0)), np.empty(n)
    p = d[-1] - shift
    rest[-1] = p
    for k in range(n - 2, -1, -1):
        pivot = d[k] * l[k] * l[k] + p
        if abs(pivot) < _TINY:
            pivot = -_TINY
        ratio = d[k] / pivot
        upper[k] = l[k] * ratio
        p = p * ratio - shift
        if not math.isfinite(p):
            p = d[k] - shift
        rest[k] = p
    return upper, rest


def _smaller(d: np.ndarray, l: np.ndarray, x: float) -> int:
    """How many eigenvalues of ``L D L'`` are below ``x``."""
    return int((_stationary(d, l, x)[0] < 0).sum())


def _refined(d: np.ndarray, l: np.ndarray, k: int, low: float, high: float) -> float:
    """Eigenvalue number ``k`` from below, between bounds that are widened where wrong."""
    width = max(high - low, _TINY)
    while _smaller(d, l, low) > k:
        low, width = low - width, 2 * width
    while _smaller(d, l, high) <= k:
        high, width = high + width, 2 * width
    for _ in range(1200):  # from any float to its last bit
        middle = (low + high) / 2
        if high - low <= 2 * EPS * max(abs(low), abs(high)) or not low < middle < high:
            break
        if _smaller(d, l, middle) > k:
            high = middle
        else:
            low = middle
    return (low + high) / 2


def _twisted(d: np.ndarray, l: np.ndarray, x: float) -> np.ndarray:
    """Unit eigenvector of ``L D L'`` for the eigenvalue close to ``x``."""
    best, vector = math.inf, np.zeros(len(d))
    for _ in range(4):
        _, lower, above = _stationary(d, l, x)
        upper, below = _progressive(d, l, x)
        middle = above + below + x
        k = int(np.abs(middle).argmin())
        z = np.zeros(len(d))
        z[k] = 1.0
        for i in range(k - 1, -1, -1):
            z[i] = -lower[i] * z[i + 1]
        for i in range(k, len(d) - 1):
            z[i + 1] = -upper[i] * z[i]
        size = float(np.linalg.norm(z))
        if not math.isfinite(size):
            break
        left = abs(middle[k]) / size
        if left >= best:
            break
        best, vector = left, z / size
        if left <= 4 * EPS * abs(x):
            break
        x += middle[k] / size**2
    return vector


def _spanned(d: np.ndarray, l: np.ndarray, x: float, many: int, span: float) -> np.ndarray:
    """An orthonormal basis of what ``many`` equal eigenvalues span, by inverse iteration."""
    t = np.diag(d) + np.diag(d[:-1] * l, 1) + np.diag(d[:-1] * l, -1)
    t[np.arange(1, len(d)), np.arange(1, len(d))] += d[:-1] * l * l
    basis = np.random.default_rng(0).standard_normal((len(d), many))
    for _ in range(4):
        basis = np.linalg.qr(np.linalg.solve(t - (x + 2 * EPS * span) * np.eye(len(d)), basis))[0]
    return basis


def _tree(d, l, values: list[float], first: int, span: float, depth: int) -> np.ndarray:
    """Vectors for eigenvalues number ``first``.. from below, rising in ``values``."""
    out = np.zeros((len(d), len(values)))
    start = 0
    while start < len(values):
        end = start + 1
        while end < len(values) and values[end] - values[end - 1] < _CLOSE * max(
            abs(values[end]), abs(values[end - 1])
        ):
            end += 1
        if end == start + 1:
            out[:, start] = _twisted(d, l, values[start])
        elif depth == 0 or values[end - 1] - values[start] <= 8 * EPS * span:
            out[:, start:end] = _spanned(d, l, sum(values[start:end]) / (end - start), end - start, span)
        else:
            width = values[end - 1] - values[start]
            # Of a shift just below and one just above, the one whose entries grow less.
            shifts = (values[start] - width / 64, values[end - 1] + width / 64)
            tried = [(*_stationary(d, l, s)[:2], s) for s in shifts]
            new_d, new_l, shift = min(tried, key=lambda t: float(np.abs(t[0]).max()))
            moved = [
                _refined(new_d, new_l, first + k, v - shift - 4 * EPS * span, v - shift + 4 * EPS * span)
                for k, v in zip(range(start, end), values[start:end], strict=True)
            ]
            out[:, start:end] = _tree(new_d, new_l, moved, first + start, span, depth - 1)
        start = end
    return out


def vectors(a: np.ndarray, b: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``many`` largest eigenvalues of ``B'B`` and their unit eigenvectors as columns."""
    d, scale = len(a), max((float(np.abs(x).max()) for x in (a, b) if len(x)), default=0.0)
    if scale == 0:
        return np.zeros(min(many, d)), np.eye(d)[:, :many]
    a, b = a / scale, b / scale
    cuts = (np.flatnonzero(np.abs(b) <= EPS) + 1).tolist()
    found: list[tuple[float, int, int, int]] = []
    blocks = list(zip([0, *cuts], [*cuts, d], strict=True))
    values = []
    for n, (i, j) in enumerate(blocks):
        values.append(squares(a[i:j], b[i : j - 1]))
        found += [(-v, n, k, 0) for k, v in enumerate(values[n])]
    chosen = sorted(found)[:many]
    out = np.zeros((d, len(chosen)))
    for n, (i, j) in enumerate(blocks):
        mine = [c for c, (_, of, _, _) in enumerate(chosen) if of == n]
        if not mine:
            continue
        diagonal = np.where(np.abs(a[i:j]) < EPS**2, EPS**2, a[i:j])
        rising = values[n][: len(mine)][::-1].tolist()
        z = _tree(
            diagonal**2, b[i : j - 1] / diagonal[:-1], rising, j - i - len(mine),
            float(values[n][0]), _DEPTH,
        )
        out[i:j, mine] = z[:, ::-1]
    if np.abs(out.T @ out - np.eye(len(chosen))).max() > 1e-13:
        out = np.linalg.qr(out)[0]  # signs are settled by the caller
    return np.array([-v for v, *_ in chosen]) * scale**2, out


def right_singular(r: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``many`` largest squared singular values of ``r``, their right vectors as columns
    (the largest entry of each is positive) and the sum of all squared values."""
    a, b, w = bidiagonalise(r)
    values, z = vectors(a, b, many)
    out = w @ z
    if out.size:
        out *= np.where(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])] < 0, -1.0, 1.0)
    return values, out, float((a**2).sum() + (b**2).sum())
