"""Embedding of compositions into few dimensions: t-SNE in each group, after principal components."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..session import checkpoint, ship, spread

#: Contigs up to which all pairs are taken; more are embedded as Barnes-Hut t-SNE does it, by near neighbours and an approximate repulsion.
EXACT = 512
#: Elements of a block of distances, and of one of pulls, small enough for a core's cache; spacing of the grid for the repulsion, its most nodes a side, and the pairs that take as long as one node.
BLOCK, PULL, STEP, NODES, NODE = 4_000_000, 65_536, 0.25, 2048, 30
METHODS = ("bhsne", "sksne", "umap", "densmap", "trimap")


def clamp_perplexity(n: int, perplexity: float = 30.0) -> float:
    """Lowered where a group has less than three times as many neighbours."""
    return max(1.0, (n - 1) / 3 - 1) if n - 1 < 3 * perplexity else perplexity


def _joint(x: np.ndarray, perplexity: float) -> np.ndarray:
    n = len(x)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2) if n * n * x.shape[1] < 5_000_000 else np.maximum((x**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * x @ x.T, 0)
    low, high, beta, want = np.full(n, -np.inf), np.full(n, np.inf), np.ones(n), np.log(perplexity)
    off = ~np.eye(n, dtype=bool)
    for _ in range(50):
        p = np.exp(-d * beta[:, None]) * off
        s = np.maximum(p.sum(1), 1e-300)
        entropy = np.log(s) + beta * (d * p).sum(1) / s
        up = entropy > want
        low, high = np.where(up, beta, low), np.where(up, high, beta)
        beta = np.where(np.isinf(high), beta * 2, np.where(np.isinf(low), beta / 2, (low + high) / 2))
    p = np.exp(-d * beta[:, None]) * off
    p /= np.maximum(p.sum(1, keepdims=True), 1e-300)
    return np.maximum((p + p.T) / (2 * n), 1e-12)


def _neighbours(x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the k nearest other rows of each row, and their squared distances."""
    n = len(x)
    x = x - x.mean(0)
    at, d, square, rows = np.empty((n, k), np.int32), np.empty((n, k)), (x**2).sum(1), max(1, BLOCK // n)
    for s in range(0, n, rows):
        part = x[s : s + rows]
        near = square - 2 * part @ x.T
        near[np.arange(len(part)), np.arange(s, s + len(part))] = np.inf
        at[s : s + rows] = np.argpartition(near, k - 1, axis=1)[:, :k]
        d[s : s + rows] = sum((x[:, c][at[s : s + rows]] - part[:, c, None]) ** 2 for c in range(x.shape[1]))
    return at, d


def _affinities(d: np.ndarray, perplexity: float) -> np.ndarray:
    """Shares of each row's neighbours, with the entropy of the perplexity."""
    d = d - d.min(1, keepdims=True)
    n, want = len(d), np.log(perplexity)
    low, high, beta = np.full(n, -np.inf), np.full(n, np.inf), np.ones(n)
    for _ in range(50):
        p = np.exp(-d * beta[:, None])
        s = p.sum(1)
        up = np.log(s) + beta * (d * p).sum(1) / s > want
        low, high = np.where(up, beta, low), np.where(up, high, beta)
        beta = np.where(np.isinf(high), beta * 2, np.where(np.isinf(low), beta / 2, (low + high) / 2))
    p = np.exp(-d * beta[:, None])
    return p / p.sum(1, keepdims=True)


def _repulsion(y: np.ndarray, far: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """The sum of 1 / (1 + d^2) over all pairs, and for each row that of differences over (1 + d^2)^2; blocks of rows at a time. With the indices far, only pairs that one of these rows is in."""
    far, rest = np.arange(len(y)) if far is None else far, np.ones(len(y), bool)
    rest[far] = False
    total, out, square, rows = 0.0, np.zeros_like(y), (y**2).sum(1), max(1, BLOCK // len(y))
    for s in range(0, len(far), rows):
        at = far[s : s + rows]
        part = y[at]
        q = 1 / (1 + np.maximum(square[at, None] + square - 2 * part @ y.T, 0))
        total += q.sum() - len(part) + q[:, rest].sum()
        q *= q
        out[at] = q.sum(1)[:, None] * part - q @ y
        if len(far) < len(y):
            back = q[:, rest].T
            out[rest] += back.sum(1)[:, None] * y[rest] - back @ part
    return total, out


class Grid:
    """_repulsion of two dimensions by convolution on a grid of STEP, from and to which cubic polynomials interpolate. Its size is the one that costs least with the pairs of the rows outside it, so that a few rows far away don't make it large. Kernels are kept while the size holds."""

    sides = np.array(sorted(m for m in {a * 2**b for a in (8, 9, 10, 12, 15) for b in range(3, 9)} if m <= NODES))

    def __init__(self):
        self.size, self.kernels = 0, []

    def __call__(self, y: np.ndarray) -> tuple[float, np.ndarray]:
        middle = np.quantile(y, (0.02, 0.98), axis=0).mean(0)
        away, half = np.abs(y - middle).max(1), (self.sides - 4) * STEP / 2
        outside = len(y) - np.searchsorted(np.sort(away), half)
        cost = outside * len(y) + NODE * self.sides**2
        k = int(cost.argmin())
        if cost[k] >= len(y) ** 2:
            return _repulsion(y)
        inside = away < half[k]
        total, out = _repulsion(y, np.flatnonzero(~inside))
        own, pushed = self._inside(y[inside] - (middle - half[k]), int(self.sides[k]))
        out[inside] += pushed
        return total + own, out

    def _inside(self, y: np.ndarray, m: int) -> tuple[float, np.ndarray]:
        """The same for rows on a grid of m nodes a side from 0 on."""
        if m != self.size:
            self.size = m
            i = np.arange(2 * m)
            c = np.where(i < m, i, i - 2 * m) * STEP
            q = 1 / (1 + c[:, None] ** 2 + c**2)
            self.kernels = [np.fft.rfft2(k) for k in (q, c[:, None] * q**2, c * q**2)]
        cells = y / STEP
        base = np.floor(cells).astype(np.int64)
        t = cells - base
        w = np.stack([-t * (t - 1) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, -(t + 1) * t * (t - 2) / 2, (t + 1) * t * (t - 1) / 6], 2)
        weight = (w[:, 0, :, None] * w[:, 1, None, :]).reshape(-1, 16)
        at = ((base[:, 0] * m + base[:, 1])[:, None] + (np.arange(4)[:, None] * m + np.arange(4)).ravel()).astype(np.int64)
        mass = np.fft.rfft2(np.bincount(at.ravel(), weight.ravel(), m * m).reshape(m, m), (2 * m, 2 * m))
        fields = [(np.fft.irfft(np.fft.ifft(mass * k, axis=0)[:m], 2 * m, axis=1)[:, :m].ravel()[at] * weight).sum(1) for k in self.kernels]
        return float(fields[0].sum()) - len(y), np.column_stack(fields[1:])


def _near_gradient(x: np.ndarray, dims: int, perplexity: float):
    """A function of y and the exaggeration that gives the gradient, with affinities of three times as many neighbours as the perplexity."""
    n = len(x)
    at, d = _neighbours(x, min(n - 1, int(3 * perplexity)))
    p = np.concatenate([_affinities(d[s : s + 10_000], perplexity) for s in range(0, n, 10_000)]) / (2 * n)
    repulsion, rows = Grid() if dims == 2 else _repulsion, max(1, PULL // at.shape[1])

    def gradient(y: np.ndarray, more: float) -> np.ndarray:
        total, pushed = repulsion(y)
        pulled, columns = np.zeros_like(y), [np.ascontiguousarray(c) for c in y.T]
        for s in range(0, n, rows):
            near = at[s : s + rows].astype(np.intp)
            apart = [c[s : s + rows, None] - c[near] for c in columns]
            w = apart[0] * apart[0]
            for a in apart[1:]:
                w += a * a
            w += 1
            np.divide(p[s : s + rows], w, out=w)
            for c, a in enumerate(apart):
                a *= w
                pulled[:, c] -= np.bincount(near.ravel(), a.ravel(), n)
                pulled[s : s + rows, c] += a.sum(1)
        return 4 * (more * pulled - pushed / total)

    return gradient


def _exact_gradient(x: np.ndarray, perplexity: float):
    """The same over all pairs."""
    p = _joint(x, perplexity)

    def gradient(y: np.ndarray, more: float) -> np.ndarray:
        q = 1 / (1 + ((y[:, None, :] - y[None, :, :]) ** 2).sum(2))
        np.fill_diagonal(q, 0)
        w = (p * more - q / q.sum()) * q
        return 4 * (w.sum(1)[:, None] * y - w @ y)

    return gradient


def tsne(x: np.ndarray, dims: int = 2, perplexity: float = 30.0, rounds: int = 500, seed: int = 42) -> np.ndarray:
    """t-SNE with early exaggeration, momentum and gains; memory grows with the rows, beyond EXACT of them."""
    n = len(x)
    if n <= 2:
        return np.arange(n)[:, None] * np.ones((1, dims))
    perplexity = clamp_perplexity(n, perplexity)
    gradient = _exact_gradient(x, perplexity) if n <= EXACT else _near_gradient(x, dims, perplexity)
    y = np.random.default_rng(seed).normal(0, 1e-4, (n, dims))
    step, gain, rate = np.zeros_like(y), np.ones_like(y), max(n / 12 / 4, 50.0)
    for i in range(rounds):
        grad = gradient(y, 12 if i < rounds // 4 else 1)
        gain = np.maximum(np.where(np.sign(grad) != np.sign(step), gain + 0.2, gain * 0.8), 0.01)
        step = (0.5 if i < rounds // 4 else 0.8) * step - rate * gain * grad
        y += step
        y -= y.mean(0)
    return y


def embed(rows: DataFrame, dims: int = 2, method: str = "bhsne", perplexity: float = 30.0, seed: int = 42, by: str | None = None, rounds: int = 500) -> DataFrame:
    """(by, contig, features) of dims numbers for the contigs of each group, a task each. One t-SNE serves both of its names; methods that need other libraries raise."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method}; there are {', '.join(METHODS)}")
    if method not in ("bhsne", "sksne"):
        raise NotImplementedError(f"{method} needs a library that is not installed")
    ship(rows.sparkSession)
    from pyspark.sql import functions as F

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("contig")
        y = tsne(np.array(frame["features"].tolist(), float), dims, perplexity, rounds, seed)
        return pd.DataFrame({"taxon": str(key[0]), "contig": frame["contig"], "features": list(y)})

    grouped = rows.select((F.col(by) if by else F.lit("all")).cast("string").alias("taxon"), "contig", "features")
    return spread(grouped, "taxon").groupBy("taxon").applyInPandas(run, "taxon string, contig string, features array<double>")


def reembed(every: DataFrame, rows: DataFrame, dims: int = 2, pca_dims: int = 50, by: str = "taxon", method: str = "bhsne", seed: int = 42, rounds: int = 500) -> DataFrame:
    """rows with new features: those of an embedding of their group, or for groups of fewer than max(pca_dims, dims) + 1 contigs of one embedding of every, the contigs classified at the rank."""
    from pyspark.sql import functions as F

    points = checkpoint(rows.select(by, "contig", "features"))
    sizes = points.groupBy(by).count()
    large, small = (points.join(sizes.filter(c).select(by), by, "left_semi") for c in (F.col("count") > max(pca_dims, dims), F.col("count") <= max(pca_dims, dims)))
    parts = [embed(large, dims, method, seed=seed, by=by, rounds=rounds)]
    if not small.isEmpty():
        parts.append(embed(every, dims, method, seed=seed, rounds=rounds).join(small.select("contig"), "contig", "left_semi").select("taxon", "contig", "features"))
    new = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.drop("features").join(checkpoint(new.select("contig", "features")), "contig")
