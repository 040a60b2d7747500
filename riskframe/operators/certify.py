"""A training result that can be checked.

The objective of the fitted model is strictly convex, so its optimum is unique and can be
recognised: one distributed aggregate gives value, gradient and Hessian of the regularised
loss at any weights, and from these a bound on the distance to the optimum follows.

The logistic loss is self-concordant in the sense of Bach (2010, "Self-concordant analysis
for logistic regression"): with R the largest norm of a row, v the Newton decrement and mu
the least eigenvalue of the Hessian, v / sqrt(mu) <= 1 / (2 R) implies that the optimum is
within 4 v / sqrt(mu) of the weights. ``certificate`` reports that bound (none where the
condition fails); ``polish`` takes Newton steps with the same aggregate, a pass each, until
the bound stops shrinking. The driver holds the weights and the Hessian: features squared.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import col, sigmoid

SUMS = 300                      # aggregates in one pass: the Hessian of many features takes several


@dataclass
class Scaled:
    """Features with the training rows' means and sample deviations (0: the feature is 0)."""
    features: list[str]
    means: list[float]
    stds: list[float]

    def columns(self) -> list:
        return [(col(f).cast("double") - F.lit(m)) / F.lit(s) if s else F.lit(0.0)
                for f, m, s in zip(self.features, self.means, self.stds)]


def scaled_by(train: DataFrame, features: Sequence[str]) -> Scaled:
    """Means and sample deviations of the training rows, one aggregate."""
    from .encode import zscore_fit
    st = zscore_fit(train, features)
    return Scaled(list(features), [float(st[f][0] or 0.0) for f in features], [float(st[f][1] or 0.0) for f in features])


def scaled_of(coefficients: DataFrame) -> tuple[Scaled, np.ndarray]:
    """Scaling and weights (intercept last) of a coefficient table."""
    rows = coefficients.orderBy("position").collect()
    own = [r for r in rows if r["position"] >= 0]
    b = next((r["coefficient"] for r in rows if r["position"] < 0), 0.0)
    return (Scaled([r["feature"] for r in own], [r["mean"] for r in own], [r["std"] for r in own]),
            np.array([*(r["coefficient"] for r in own), b]))


@dataclass
class Terms:
    n: int
    value: float
    gradient: np.ndarray
    hessian: np.ndarray
    radius: float


def terms(train: DataFrame, scaled: Scaled, weights: np.ndarray, label: str = "label", reg: float = 0.01) -> Terms:
    """Value, gradient and Hessian of mean log loss + reg / 2 |coefficients|² (the intercept,
    last, is not regularised) and the largest row norm: distributed sums, no row moves."""
    d = len(scaled.features)
    z = [*scaled.columns(), F.lit(1.0)]
    rows = train.select(*[e.alias(f"z{j}") for j, e in enumerate(z)], col(label).cast("double").alias("y"))
    margin = F.lit(0.0)
    for j, w in enumerate(weights):
        margin = margin + F.lit(float(w)) * F.col(f"z{j}")
    rows = rows.withColumn("m", margin).withColumn("p", sigmoid(F.col("m")))
    zj = [F.col(f"z{j}") for j in range(d + 1)]
    # log(1 + e^m) - y m without overflow
    loss = F.greatest("m", F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m")
    norm = sum((e * e for e in zj[:-1]), F.lit(1.0))
    pairs = [(j, k) for j in range(d + 1) for k in range(j, d + 1)]
    curve = F.col("p") * (F.lit(1.0) - F.col("p"))
    aggs = [F.count("*").alias("n"), F.avg(loss).alias("value"), F.max(norm).alias("norm"),
            *[F.avg((F.col("p") - F.col("y")) * zj[j]).alias(f"g{j}") for j in range(d + 1)],
            *[F.avg(curve * zj[j] * zj[k]).alias(f"h{j}_{k}") for j, k in pairs]]
    got: dict = {}
    for lo in range(0, len(aggs), SUMS):
        got |= rows.agg(*aggs[lo:lo + SUMS]).first().asDict()
    if not got["n"]:
        raise ValueError("no training rows")
    w = np.asarray(weights, dtype=float)
    ridge = np.array([reg] * d + [0.0])
    h = np.zeros((d + 1, d + 1))
    for j, k in pairs:
        h[j, k] = h[k, j] = got[f"h{j}_{k}"]
    return Terms(got["n"], got["value"] + 0.5 * float(ridge @ (w * w)),
                 np.array([got[f"g{j}"] for j in range(d + 1)]) + ridge * w, h + np.diag(ridge), float(got["norm"]) ** 0.5)


def distance_bound(t: Terms) -> tuple[float, float, float | None]:
    """(Newton decrement, least eigenvalue, bound on the distance to the optimum or None)."""
    e, q = np.linalg.eigh(t.hessian)
    if e[0] <= 0:
        return float("nan"), float(e[0]), None
    v = float(np.sqrt((((q.T @ t.gradient) ** 2) / e).sum()))
    ok = v / np.sqrt(e[0]) <= 1 / (2 * t.radius)
    return v, float(e[0]), float(4 * v / np.sqrt(e[0])) if ok else None


def certificate(train: DataFrame, scaled: Scaled, weights: np.ndarray, label: str = "label", reg: float = 0.01,
                tolerance: float = 1e-6) -> DataFrame:
    """One row: how far the weights can be from the optimum, and whether that is within
    ``tolerance``."""
    t = terms(train, scaled, weights, label, reg)
    v, least, bound = distance_bound(t)
    row = (t.n, t.value, float(np.linalg.norm(t.gradient)), v, least, t.radius, bound,
           bound is not None and bound <= tolerance)
    return train.sparkSession.createDataFrame([row], (
        "n long, objective double, gradient_norm double, newton_decrement double, least_eigenvalue double, "
        "radius double, distance_bound double, certified boolean"))


def polish(train: DataFrame, scaled: Scaled, weights: np.ndarray, label: str = "label", reg: float = 0.01,
           tolerance: float = 1e-11, max_steps: int = 50) -> tuple[np.ndarray, float]:
    """Weights whose distance to the optimum is at most ``tolerance`` (or the least that the
    arithmetic reaches), and that bound. Raises where no bound can be given."""
    w, best = np.array(weights, dtype=float), (np.inf, None)
    t = terms(train, scaled, w, label, reg)
    for _ in range(max_steps):
        _, _, bound = distance_bound(t)
        if bound is not None:
            if bound < best[0]:
                best = (bound, w)
            elif best[1] is not None:
                break                            # at the rounding of the sums
            if bound <= tolerance:
                break
        step, size = np.linalg.solve(t.hessian, t.gradient), 1.0
        while True:                              # far from the optimum a whole step may overshoot
            nxt = terms(train, scaled, w - size * step, label, reg)
            if nxt.value <= t.value + 1e-12 or size < 1e-6:
                break
            size /= 2
        w, t = w - size * step, nxt
    if best[1] is None:
        raise RuntimeError("the optimum has not been located")
    return best[1], best[0]


def weight_table(spark, scaled: Scaled, weights: np.ndarray) -> DataFrame:
    """The coefficient table (M7) of given weights."""
    rows = [(i, f, float(w), m, s) for i, (f, w, m, s) in
            enumerate(zip(scaled.features, weights, scaled.means, scaled.stds))]
    rows.append((-1, "(intercept)", float(weights[-1]), 0.0, 1.0))
    return spark.createDataFrame(rows, "position int, feature string, coefficient double, mean double, std double")


def train_certified(df: DataFrame, features: Sequence[str], label: str = "label",
                    key_cols: Sequence[str] | None = None, train_fraction: float = 0.8, reg: float = 0.01,
                    max_iter: int = 50) -> tuple[DataFrame, float, DataFrame, DataFrame]:
    """M4-M7: split, fit, polish to the optimum -> (coefficient table, distance bound, training
    rows, test rows). The training rows' few columns are persisted for the passes."""
    from pyspark import StorageLevel

    from . import model
    fitted, train, test = model.train_model(df, features, label, key_cols, train_fraction, reg_param=reg,
                                            max_iter=max_iter, elastic_net=0.0)
    scaled, weights = scaled_of(model.coefficient_table(fitted, features))
    rows = train.select(*[col(f) for f in features], col(label)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        weights, bound = polish(rows, scaled, weights, label, reg)
    finally:
        rows.unpersist()
    return weight_table(df.sparkSession, scaled, weights), bound, train, test
