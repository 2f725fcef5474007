"""Purchase-count and spend models fitted on the executors, and the value they imply."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.functions.numeric import digamma, hyp2f1, log_gamma, trigamma
from stumpline.operators import boosting
from stumpline.operators.users import CHURN_FEATURES

#: Value, gradient and curvature by natural parameters: arrays (rows,), (rows, p), (rows, p, p).
Derived = Callable[[np.ndarray, pd.DataFrame], tuple[np.ndarray, np.ndarray, np.ndarray]]
DAYS_PER_MONTH = 30


def total_derived(counts: DataFrame, derived: Derived, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted sums of value, gradient and curvature at several points of log parameters, in one job."""
    many, p = points.shape
    width = 1 + p + p * p

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((many, width))
        for b in batches:
            w = b["weight"].to_numpy(dtype=float)
            for i, point in enumerate(points):
                with np.errstate(all="ignore"):
                    value, grad, bend = derived(np.exp(point), b)
                    total[i, 0] += w @ value
                    total[i, 1 : 1 + p] += w @ grad
                    total[i, 1 + p :] += np.tensordot(w, bend, 1).ravel()
        yield pd.DataFrame({"i": np.arange(many, dtype=np.int32), "s": list(total)})

    parts = counts.mapInPandas(run, "i int, s array<double>")
    rows = parts.groupBy("i").agg(F.array(*[F.sum(F.col("s")[j]) for j in range(width)]).alias("s")).collect()
    total = np.zeros((many, width))
    for r in rows:
        total[r["i"]] = r["s"]
    # From natural to log parameters.
    x = np.exp(points)
    grad = total[:, 1 : 1 + p] * x
    bend = total[:, 1 + p :].reshape(-1, p, p) * x[:, :, None] * x[:, None, :]
    bend[:, np.arange(p), np.arange(p)] += grad
    return total[:, 0], grad, bend


def maximise(
    counts: DataFrame, derived: Derived, start: np.ndarray, penalizer: float, max_iter: int = 200, tolerance: float = 1e-9
) -> tuple[np.ndarray, float]:
    """Damped Newton on log parameters with exact gradients and curvatures, one job over the folded rows a step.

    A job looks at a few lengths of the step together, and the best of them is where the next step starts. It ends
    where no derivative of the mean log-likelihood is above ``tolerance``, or no step gains any more; raises when ``max_iter`` steps do
    not suffice. The penalty is on the squared parameters.
    """
    weight = counts.agg(F.sum("weight")).first()[0]
    if not weight:
        raise ValueError("nothing to fit")
    p = len(start)

    def look(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        value, grad, bend = total_derived(counts, derived, points)
        square = np.exp(2 * points)
        value = value / weight - penalizer * square.sum(axis=1)
        bend = bend / weight
        bend[:, np.arange(p), np.arange(p)] -= 4 * penalizer * square
        fine = np.isfinite(value) & np.isfinite(grad).all(axis=1) & np.isfinite(bend).all(axis=(1, 2))
        return np.where(fine, value, -np.inf), grad / weight - 2 * penalizer * square, bend

    x = start.astype(float)
    values, grads, bends = look(x[None])
    best, grad, bend = values[0], grads[0], bends[0]
    if not np.isfinite(best):
        raise ValueError("the start has no likelihood")
    for _ in range(max_iter):
        if np.abs(grad).max() <= tolerance:
            return x, float(best)
        size, axes = np.linalg.eigh(-(bend + bend.T) / 2)
        tried = []
        for damp in (0.0, 1e-2, 1.0):
            move = axes @ ((axes.T @ grad) / (np.maximum(np.abs(size), 1e-8) + damp))
            move = move * min(1.0, 2.0 / max(np.abs(move).max(), 1e-12))
            tried += [x + move, x + 0.25 * move, x + 0.02 * move]
        values, grads, bends = look(np.array(tried))
        at = int(values.argmax())
        # Where values no longer tell points apart, the smaller gradient does.
        close = np.flatnonzero(values >= best - 1e-13 * max(1.0, abs(best)))
        if len(close) and values[at] <= best + 1e-13 * max(1.0, abs(best)):
            at = int(close[np.abs(grads[close]).max(axis=1).argmin()])
            if np.abs(grads[at]).max() >= np.abs(grad).max():
                return x, float(best)
        elif values[at] <= best:
            return x, float(best)
        x, best, grad, bend = tried[at], values[at], grads[at], bends[at]
    raise RuntimeError(f"no convergence in {max_iter} steps")


# --- purchase counts ------------------------------------------------------------------------------


@dataclass(frozen=True)
class PurchaseModel:
    """Beta-geometric / negative-binomial purchase process."""

    r: float
    alpha: float
    a: float
    b: float
    objective: float

    def expected(self, t: float, x: np.ndarray, tx: np.ndarray, age: np.ndarray) -> np.ndarray:
        """Expected purchases in the next ``t`` units given x purchases, the last at tx, aged ``age``."""
        r, alpha, a, b = self.r, self.alpha, self.a, self.b
        z = t / (alpha + age + t)
        ratio = (alpha + age) / (alpha + age + t)
        grow = 1 - np.exp((r + x) * np.log(ratio)) * hyp2f1(r + x, b + x, a + b + x - 1, z)
        first = (a + b + x - 1) / (a - 1) * grow
        gone = np.where(
            x > 0,
            a / (b + np.maximum(x, 1e-12) - 1)
            * np.exp(np.minimum((r + x) * np.log((alpha + age) / (alpha + tx)), 700.0)),
            0.0,
        )
        return first / (1 + gone)

    def expected_column(self, times: Sequence[float]) -> Column:
        """Array column with the expectation for each horizon, computed in Arrow batches."""
        model, horizons = self, list(times)

        @F.pandas_udf("array<double>")
        def run(x: pd.Series, tx: pd.Series, age: pd.Series) -> pd.Series:
            args = [s.to_numpy(dtype=float) for s in (x, tx, age)]
            return pd.Series(list(np.stack([model.expected(t, *args) for t in horizons], axis=1)))

        return run("frequency", "recency", "T")


def purchase_derived(theta: np.ndarray, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of (frequency, recency, T) by r, alpha, a, b with both derivatives."""
    r, alpha, a, c = theta
    x, tx, age = (b[k].to_numpy(dtype=float) for k in ("frequency", "recency", "T"))
    one, zero, some = np.ones_like(x), np.zeros_like(x), np.maximum(x, 1)
    value = (
        log_gamma(r + x) - log_gamma(np.array(r)) + r * np.log(alpha)
        + log_gamma(np.array(a + c)) + log_gamma(c + x) - log_gamma(np.array(c)) - log_gamma(a + c + x)
    )
    both, more = digamma(np.array(a + c)) - digamma(a + c + x), digamma(c + x) - digamma(np.array(c))
    grad = np.stack([digamma(r + x) - digamma(np.array(r)) + np.log(alpha), one * r / alpha, both, both + more], axis=1)
    bend = np.zeros((len(x), 4, 4))
    bend[:, 0, 0] = trigamma(r + x) - trigamma(np.array(r))
    bend[:, 0, 1] = bend[:, 1, 0] = 1 / alpha
    bend[:, 1, 1] = -r / alpha**2
    bend[:, 2, 2] = bend[:, 2, 3] = bend[:, 3, 2] = trigamma(np.array(a + c)) - trigamma(a + c + x)
    bend[:, 3, 3] = bend[:, 2, 2] + trigamma(c + x) - trigamma(np.array(c))

    def way(log: np.ndarray, time: np.ndarray, quit_: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.stack([-np.log(time), -(r + x) / time, one / a if quit_ else zero, -1 / (c + some - 1) if quit_ else zero], axis=1)
        second = np.zeros((len(x), 4, 4))
        second[:, 0, 1] = second[:, 1, 0] = -1 / time
        second[:, 1, 1] = (r + x) / time**2
        if quit_:
            second[:, 2, 2], second[:, 3, 3] = -1 / a**2, 1 / (c + some - 1) ** 2
        return log, first, second + first[:, :, None] * first[:, None, :]

    ways = (
        way(-(r + x) * np.log(alpha + age), alpha + age, False),
        way(np.where(x > 0, np.log(a) - np.log(c + some - 1) - (r + x) * np.log(alpha + tx), -np.inf), alpha + tx, True),
    )
    top = np.maximum(ways[0][0], ways[1][0])
    share = np.exp([w[0] - top for w in ways])
    whole = share.sum(axis=0)
    share = share / whole
    mixed = sum(s[:, None] * w[1] for s, w in zip(share, ways, strict=True))
    curved = sum(s[:, None, None] * w[2] for s, w in zip(share, ways, strict=True)) - mixed[:, :, None] * mixed[:, None, :]
    return value + top + np.log(whole), grad + mixed, bend + curved


def fit_purchases(rft: DataFrame, penalizer: float = 0.01) -> PurchaseModel:
    """Fit on active users. Rows with equal (frequency, recency, T) are folded first."""
    counts = (
        rft.groupBy("frequency", "recency", "T")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .cache()
    )
    try:
        top = counts.agg(F.max("T")).first()[0]
        if not top:
            raise ValueError("nothing to fit")
        scale = 10.0 / top
        scaled = counts.withColumns({"recency": F.col("recency") * scale, "T": F.col("T") * scale})
        theta, best = maximise(scaled, purchase_derived, np.log([1.0, 1.0, 1.0, 1.0]), penalizer)
    finally:
        counts.unpersist()
    r, alpha, a, b = np.exp(theta)
    return PurchaseModel(float(r), float(alpha / scale), float(a), float(b), best)


# --- spend ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SpendModel:
    """Gamma-gamma mean spend per purchase."""

    p: float
    q: float
    v: float
    objective: float

    def expected(self) -> Column:
        """Weighted mean of the user's own and the population's mean spend."""
        x, m = F.col("frequency"), F.col("monetary_value")
        own = x * self.p / (x * self.p + (self.q - 1.0))
        return (F.lit(1.0) - own) * (self.v * self.p / (self.q - 1.0)) + own * m


def spend_derived(theta: np.ndarray, b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-likelihood of (frequency, monetary_value) by p, q, v with both derivatives."""
    p, q, v = theta
    x, m = b["frequency"].to_numpy(dtype=float), b["monetary_value"].to_numpy(dtype=float)
    px, all_ = p * x, x * m + v
    value = (
        log_gamma(px + q) - log_gamma(px) - log_gamma(np.array(q))
        + q * np.log(v) + (px - 1) * np.log(m) + px * np.log(x) - (px + q) * np.log(all_)
    )
    up = digamma(px + q)
    grad = np.stack(
        [x * (up - digamma(px) + np.log(m) + np.log(x) - np.log(all_)), up - digamma(np.array(q)) + np.log(v) - np.log(all_), q / v - (px + q) / all_],
        axis=1,
    )
    bend = np.zeros((len(x), 3, 3))
    curve = trigamma(px + q)
    bend[:, 0, 0] = x * x * (curve - trigamma(px))
    bend[:, 0, 1] = bend[:, 1, 0] = x * curve
    bend[:, 0, 2] = bend[:, 2, 0] = -x / all_
    bend[:, 1, 1] = curve - trigamma(np.array(q))
    bend[:, 1, 2] = bend[:, 2, 1] = 1 / v - 1 / all_
    bend[:, 2, 2] = -q / v**2 + (px + q) / all_**2
    return value, grad, bend


def fit_spend(rft: DataFrame, penalizer: float = 0.01, min_rows: int = 10) -> SpendModel | None:
    """Fit on users with positive spend and count; None when there are ``min_rows`` or fewer."""
    counts = (
        rft.filter((F.col("monetary_value") > 0) & (F.col("frequency") > 0))
        .groupBy("frequency", "monetary_value")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
        .cache()
    )
    try:
        if (counts.agg(F.sum("weight")).first()[0] or 0) <= min_rows:
            return None
        theta, best = maximise(counts, spend_derived, np.log([1.0, 1.0, 1.0]), penalizer)
    finally:
        counts.unpersist()
    p, q, v = np.exp(theta)
    return SpendModel(float(p), float(q), float(v), best)


# --- lifetime value -------------------------------------------------------------------------------


def predict_value(
    rft: DataFrame, purchases: PurchaseModel, spend: SpendModel | None, periods: int = 12, discount: float = 0.01
) -> DataFrame:
    """Expected purchases over ``periods`` time units, and value over ``periods`` months, discounted.

    Without a spend model the value is purchases times the mean monthly spend.
    """
    month_ends = [float(DAYS_PER_MONTH * i) for i in range(1, periods + 1)]
    both = rft.withColumn("_e", purchases.expected_column([float(periods), *month_ends]))
    out = both.withColumn("predicted_purchases", F.element_at("_e", 1))
    if spend is None:
        mean = rft.agg(F.avg("monetary_value").alias("_m")).select("_m").scalar()
        return out.withColumn("predicted_clv", F.col("predicted_purchases") * mean).drop("_e")
    gains = F.transform(
        F.sequence(F.lit(1), F.lit(periods)),
        lambda i: (
            F.element_at("_e", i + 1) - F.when(i > 1, F.element_at("_e", i)).otherwise(0.0)
        )
        / F.pow(F.lit(1.0 + discount), i.cast("double")),
    )
    worth = F.aggregate(gains, F.lit(0.0), lambda t, v: t + v)
    return out.withColumn("predicted_clv", worth * spend.expected()).drop("_e")


# --- churn classifier -----------------------------------------------------------------------------


def train_churn_classifier(
    df: DataFrame,
    features: Sequence[str] = CHURN_FEATURES,
    label: str = "churned",
    trees: int = 200,
    depth: int = 4,
    step: float = 0.05,
) -> boosting.BoostedTrees:
    """Boosted trees, churned users weighted by the ratio of the classes."""
    counts = df.agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).alias("p"),
        F.sum(F.when(F.col(label) == 0, 1).otherwise(0)).alias("n"),
    ).first()
    if not counts["p"] or not counts["n"]:
        raise ValueError("both classes are needed")
    weight = counts["n"] / counts["p"]
    rows = churn_vectors(df, features).withColumn("_w", F.when(F.col(label) == 1, float(weight)).otherwise(1.0))
    return boosting.fit(rows, "features", label, "_w", trees, depth, step, rate=0.8)


def churn_vectors(df: DataFrame, features: Sequence[str] = CHURN_FEATURES) -> DataFrame:
    filled = df.withColumns({f"_f_{f}": F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features})
    names = [f"_f_{f}" for f in features]
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(filled).drop(*names)
    return vectors.withColumn("features", vector_to_array("features"))


def churn_probability(
    df: DataFrame, model: boosting.BoostedTrees, features: Sequence[str] = CHURN_FEATURES
) -> DataFrame:
    scored = model.transform(churn_vectors(df, features))
    return scored.withColumnRenamed("probability", "churn_probability").drop("features", "prediction")
