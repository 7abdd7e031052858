"""Pseudo-likelihood fit per alignment column, and scores from its parameters.

A site's parameters are fields h(q) and couplings J(N, q, q), J[i, k, s] for state k at column i and s at the site;
J of the site itself is zero. Weights are divided by their sum. The penalty is lambda_h * sum h^2 + lambda_j / 2 * sum J^2,
so the objective is strictly convex and its minimum does not depend on the optimizer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Codes:
    """An alignment's codes as one-hot rows, in parts of bounded size. The parts are kept if they all fit in ``most_bytes``;
    else each is made when it is needed, so that memory does not grow with rows times columns times states."""

    def __init__(self, codes: np.ndarray, q: int, most_bytes: int = 256 << 20):
        if codes.min() < 0 or codes.max() >= q:
            raise ValueError("codes must be from 0 to q - 1")
        self.codes, self.q = codes.astype(np.int8), q
        row = codes.shape[1] * q * 8
        self.step = max(1, min(len(codes), most_bytes // 4 // row))
        self.held = [self._part(a) for a in range(0, len(codes), self.step)] if len(codes) * row <= most_bytes else None

    def _part(self, first: int) -> np.ndarray:
        part = self.codes[first:first + self.step]
        one = np.zeros((*part.shape, self.q))
        np.put_along_axis(one, part[:, :, None].astype(np.int64), 1.0, axis=2)
        return one.reshape(len(part), -1)

    def parts(self):
        """(first row, one-hot rows)."""
        for k, first in enumerate(range(0, len(self.codes), self.step)):
            yield first, self.held[k] if self.held else self._part(first)


def objective(codes: np.ndarray | Codes, weights: np.ndarray, site: int, q: int, lambda_h: float, lambda_j: float) -> Callable:
    """x -> (value, gradient) for one site; x is h then J, flat. J of the site itself is no part of the energy, so it stays zero."""
    codes = codes if isinstance(codes, Codes) else Codes(codes, q)
    n = codes.codes.shape[1]
    w = weights / weights.sum()
    own = codes.codes[:, site].astype(np.int64)
    mine = slice(site * q, site * q + q)

    def value(x: np.ndarray) -> tuple[float, np.ndarray]:
        h, j = x[:q], x[q:].reshape(n * q, q)
        f, dh, dj = 0.0, 2 * lambda_h * h, lambda_j * j
        others = j.copy()
        others[mine] = 0
        for first, one in codes.parts():
            k = np.arange(len(one))
            s, v = own[first:first + len(one)], w[first:first + len(one)]
            energy = one @ others + h
            top = energy.max(1, keepdims=True)
            log_z = top[:, 0] + np.log(np.exp(energy - top).sum(1))
            f -= (v * (energy[k, s] - log_z)).sum()
            residual = -v[:, None] * np.exp(energy - log_z[:, None])
            residual[k, s] += v
            dh = dh - residual.sum(0)
            dj -= one.T @ residual
        dj[mine] = lambda_j * j[mine]
        return float(f + lambda_h * (h @ h) + lambda_j / 2 * (j * j).sum()), np.concatenate([dh, dj.ravel()])

    return value


def lbfgs(value: Callable, x: np.ndarray, most: int = 200, tolerance: float = 1e-3, memory: int = 8) -> tuple[np.ndarray, bool]:
    """(minimum, whether the gradient's largest entry fell below the tolerance). Limited-memory quasi-Newton, Armijo steps."""
    f, g = value(x)
    used, steps, flat = 1, [], 0
    while used < most and np.abs(g).max() > tolerance and flat < 5:
        d, kept = g.copy(), []
        for s, y, r in reversed(steps):
            a = r * (s @ d)
            d -= a * y
            kept.append(a)
        if steps:
            s, y, _ = steps[-1]
            d *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(steps, reversed(kept)):
            d += (a - r * (y @ d)) * s
        slope = -(g @ d)
        if slope >= 0:
            d, slope, steps = g, -(g @ g), []
        size = 1.0 if steps else min(1.0, 1.0 / np.abs(g).max())
        for _ in range(10):
            new = x - size * d
            f_new, g_new = value(new)
            used += 1
            if f_new <= f + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = new - x, g_new - g
        if s @ y > 1e-12:
            steps = [*steps[-memory + 1:], (s, y, 1.0 / (s @ y))]
        flat = flat + 1 if abs(f - f_new) <= 1e-9 * max(1.0, abs(f)) else 0
        x, f, g = new, f_new, g_new
    return x, bool(np.abs(g).max() <= tolerance)


def rmsprop(value: Callable, x: np.ndarray, most: int = 200, tolerance: float = 1e-3, rate: float = 2e-3, decay: float = 0.92, momentum: float = 0.9) -> tuple[np.ndarray, bool]:
    square, push = np.zeros_like(x), np.zeros_like(x)
    for _ in range(most):
        _, g = value(x)
        if np.abs(g).max() <= tolerance:
            return x, True
        square = decay * square + (1 - decay) * g * g
        push = momentum * push + g / (np.sqrt(square) + 1e-8)
        x = x - rate * push
    return x, False


def nadam(value: Callable, x: np.ndarray, most: int = 200, tolerance: float = 1e-3, rate: float = 5e-3, first: float = 0.9, second: float = 0.999, decay: float = 4e-3) -> tuple[np.ndarray, bool]:
    m, v, product = np.zeros_like(x), np.zeros_like(x), 1.0
    for t in range(1, most + 1):
        _, g = value(x)
        if np.abs(g).max() <= tolerance:
            return x, True
        now, then = (first * (1 - 0.5 * 0.96 ** (k * decay)) for k in (t, t + 1))
        product *= now
        m = first * m + (1 - first) * g
        v = second * v + (1 - second) * g * g
        ahead = then * m / (1 - product * then) + (1 - now) * g / (1 - product)
        x = x - rate * ahead / (np.sqrt(v / (1 - second**t)) + 1e-8)
    return x, False


OPTIMIZERS = {"lbfgs": lbfgs, "rmsprop": rmsprop, "nadam": nadam}


def fit_site(codes: np.ndarray | Codes, weights: np.ndarray, site: int, q: int = 21, lambda_h: float = 0.01, lambda_j: float = 0.01, most: int = 200, tolerance: float = 3e-4, optimizer: str = "lbfgs") -> tuple[np.ndarray, bool]:
    """(J of the site as (N, q, q), converged)."""
    codes = codes if isinstance(codes, Codes) else Codes(codes, q)
    n = codes.codes.shape[1]
    x, good = OPTIMIZERS[optimizer](objective(codes, weights, site, q, lambda_h, lambda_j), np.zeros(q + n * q * q), most, tolerance)
    return x[q:].reshape(n, q, q), good


def gauge(j: np.ndarray) -> np.ndarray:
    """Zero-sum form of the last two axes."""
    return j - j.mean(-1, keepdims=True) - j.mean(-2, keepdims=True) + j.mean((-2, -1), keepdims=True)


def norms(j: np.ndarray, gap: int = 0) -> np.ndarray:
    """Frobenius norms (N, N) of J (site, i, state at i, state at site), each block averaged with its counterpart, without the gap."""
    mean = (j + j.transpose(1, 0, 3, 2)) / 2
    keep = np.arange(j.shape[-1]) != gap
    fn = np.sqrt((mean[:, :, keep][..., keep] ** 2).sum((-2, -1)))
    np.fill_diagonal(fn, 0)
    return fn


def corrected(fn: np.ndarray) -> np.ndarray:
    n = len(fn)
    if n < 2:
        raise ValueError("a score needs two columns or more")
    return fn - np.outer(fn.sum(1) / (n - 1), fn.sum(0) / (n - 1)) / (fn.sum() / (n * (n - 1)))


def fit_sites(rows: DataFrame, blocks: int = 8, q: int = 21, lambda_h: float = 0.01, lambda_j: float = 0.01, most: int = 200, tolerance: float = 3e-4, optimizer: str = "lbfgs") -> DataFrame:
    """(pair, site, i, j binary, converged): one row per pair, site and column, j as float64 q x q in zero-sum form.

    rows: (pair, codes, weight). Each task fits a block of a pair's sites; the alignment goes once to each block.
    """
    dealt = rows.select("pair", "codes", "weight", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        codes, weights, block = Codes(np.stack(pdf.codes.to_numpy()), q), pdf.weight.to_numpy(), int(pdf.block.iloc[0])
        out = []
        for site in range(block, codes.codes.shape[1], blocks):
            j, good = fit_site(codes, weights, site, q, lambda_h, lambda_j, most, tolerance, optimizer)
            out += [(pdf.pair.iloc[0], site, i, x.tobytes(), good) for i, x in enumerate(gauge(j))]
        return pd.DataFrame(out, columns=["pair", "site", "i", "j", "converged"])

    return dealt.groupBy("pair", "block").applyInPandas(fit, f"pair {dict(rows.dtypes)['pair']}, site int, i int, j binary, converged boolean")


def scores_of(params: DataFrame, q: int = 21) -> DataFrame:
    """(pair, pos1, pos2, score) from fit_sites' rows: only q x q blocks meet, norms and means are aggregations."""

    def norm(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((q - 1, q - 1))
        for s, i, b in zip(pdf.site, pdf.i, pdf.j):
            x = np.frombuffer(b).reshape(q, q)
            total += (x if s < i else x.T)[1:, 1:]
        fn = float(np.sqrt(((total / 2) ** 2).sum()))
        lo, hi = sorted((int(pdf.site.iloc[0]), int(pdf.i.iloc[0])))
        return pd.DataFrame([(pdf["pair"].iloc[0], lo + 1, hi + 1, fn), (pdf["pair"].iloc[0], hi + 1, lo + 1, fn)], columns=["pair", "pos1", "pos2", "fn"])

    kind = dict(params.dtypes)["pair"]
    bad = params.where("site <> i").withColumn("lo", F.least("site", "i")).withColumn("hi", F.greatest("site", "i"))
    fn = bad.groupBy("pair", "lo", "hi").applyInPandas(norm, f"pair {kind}, pos1 int, pos2 int, fn double")
    row = fn.groupBy("pair", "pos1").agg(F.sum("fn").alias("s"))
    total = row.groupBy("pair").agg(F.sum("s").alias("t"), F.count("*").alias("n"))
    full = fn.unionByName(row.select("pair", "pos1", F.col("pos1").alias("pos2"), F.lit(0.0).alias("fn")))
    out = full.join(row.select("pair", "pos1", F.col("s").alias("r")), ["pair", "pos1"]).join(row.select("pair", F.col("pos1").alias("pos2"), F.col("s").alias("c")), ["pair", "pos2"]).join(total, "pair")
    n = F.col("n")
    return out.select("pair", "pos1", "pos2", (F.col("fn") - F.col("r") / (n - 1) * (F.col("c") / (n - 1)) / (F.col("t") / (n * (n - 1)))).alias("score"))


def require_converged(params: DataFrame) -> DataFrame:
    """Pairs of which no site failed."""
    return params.join(params.where("NOT converged").select("pair").distinct(), "pair", "left_anti")


#: Score functions by method name; register others here.
SCORERS: dict[str, Callable[[DataFrame], DataFrame]] = {"plm": lambda rows: scores_of(fit_sites(rows))}
