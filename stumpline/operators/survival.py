"""Retention curves, proportional hazards and the concordance of risk scores."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.functions.numeric import tie_sums
from stumpline.functions.quantiles import exact_quantiles, with_scalars
from stumpline.functions.scan import NO_HOT, Hot, Running, Total, hot_groups, hot_rows_limit, scan


def kaplan_meier(
    df: DataFrame, duration: str = "duration_days", event: str = "event_observed", by: Sequence[str] = ()
) -> DataFrame:
    """Survival after each observed duration, per group. Null group keys are dropped.

    Rows are folded to one per (group, duration); the product of factors is a running sum of logs.
    """
    per = (
        df.dropna(subset=[duration, *by])
        .groupBy(*by, duration)
        .agg(F.sum(F.col(event).cast("long")).alias("deaths"), F.count(F.lit(1)).alias("_left"))
    )
    hot = hot_groups(df, list(by))
    risk = scan(per, list(by), [duration], hot, _gone=Running(F.col("_left")), _all=Total(F.col("_left"))).withColumn(
        "at_risk", F.col("_all") - F.col("_gone") + F.col("_left")
    )
    all_die = F.col("deaths") == F.col("at_risk")
    factor = F.when(all_die, 0.0).otherwise(F.log(F.lit(1.0) - F.col("deaths") / F.col("at_risk")))
    curve = scan(risk, list(by), [duration], hot, _log=Running(factor), _zero=Running(all_die.cast("int")))
    survival = F.when(F.col("_zero") > 0, 0.0).otherwise(F.exp("_log"))
    return curve.select(*by, F.col(duration).alias("duration"), "at_risk", "deaths", survival.alias("survival"))


def by_threshold(df: DataFrame, value: str, limits: Sequence[int], name: str = "threshold") -> DataFrame:
    """Repeat each row for every limit its value reaches."""
    reached = F.filter(F.array(*[F.lit(x) for x in limits]), lambda x: F.col(value) >= x)
    return df.withColumn(name, F.explode(reached))


def by_quartile(df: DataFrame, value: str, name: str = "quartile") -> DataFrame:
    """Quartile of the value, intervals closed on the right, the lowest value in the first."""
    wide = with_scalars(df, exact_quantiles(df, value, {"_a": 0.25, "_b": 0.5, "_c": 0.75}))
    v = F.col(value)
    label = (
        F.when(v.isNull(), None)
        .when(v <= F.col("_a"), "Q1 Low")
        .when(v <= F.col("_b"), "Q2")
        .when(v <= F.col("_c"), "Q3")
        .otherwise("Q4 High")
    )
    return wide.withColumn(name, label).drop("_a", "_b", "_c")


# --- proportional hazards -------------------------------------------------------------------------


@dataclass(frozen=True)
class CoxModel:
    """Coefficients on the original scale, with the feature means used for centring."""

    features: tuple[str, ...]
    coefficients: np.ndarray
    means: np.ndarray
    standard_errors: np.ndarray
    log_likelihood: float
    iterations: int

    def risk(self) -> Column:
        """exp((x - mean) . beta)"""
        total = F.lit(0.0)
        for f, b, m in zip(self.features, self.coefficients, self.means, strict=True):
            total = total + (F.col(f).cast("double") - F.lit(float(m))) * F.lit(float(b))
        return F.exp(total)

    def hazard_ratios(self, df: DataFrame) -> DataFrame:
        rows = [
            (f, float(b), float(np.exp(b)), float(s))
            for f, b, s in zip(self.features, self.coefficients, self.standard_errors, strict=True)
        ]
        return df.sparkSession.createDataFrame(
            rows, "feature string, coefficient double, hazard_ratio double, standard_error double"
        )


def _pairs(p: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(p) for j in range(i, p)]


def _risk_sums(df: DataFrame, p: int, beta: np.ndarray, hot: Hot) -> DataFrame:
    """Per duration: sums over its rows and over its deaths of w, w x, w x x', then sums still at risk."""
    eta = F.lit(0.0)
    for i in range(p):
        eta = eta + F.col(f"z{i}") * F.lit(float(beta[i]))
    rows = df.withColumn("w", F.exp(eta))
    dead = F.col("e") == 1
    terms = {"s": F.col("w")}
    terms |= {f"s_{i}": F.col("w") * F.col(f"z{i}") for i in range(p)}
    terms |= {f"s_{i}_{j}": F.col("w") * F.col(f"z{i}") * F.col(f"z{j}") for i, j in _pairs(p)}
    aggs = [F.sum(v).alias(f"a_{k}") for k, v in terms.items()]
    aggs += [F.sum(F.when(dead, v).otherwise(0.0)).alias(f"d_{k}") for k, v in terms.items()]
    aggs += [F.sum(F.when(dead, F.col(f"z{i}")).otherwise(0.0)).alias(f"x_{i}") for i in range(p)]
    aggs.append(F.sum(F.col("e").cast("double")).alias("d"))
    per = rows.groupBy("t").agg(*aggs)
    # From the longest duration down, what is still at risk is a running sum and nothing cancels.
    run = scan(per, [], [F.desc("t")], hot, **{k: Running(F.col(f"a_{k}")) for k in terms})
    return run.filter("d > 0").select("d", *terms, *[f"d_{k}" for k in terms], *[f"x_{i}" for i in range(p)])


def _efron(p: int, beta: np.ndarray):
    """Batch function: log-likelihood, gradient and information of the tied-death likelihood."""
    pairs = _pairs(p)
    names = ["ll", *[f"g{i}" for i in range(p)], *[f"h{i}_{j}" for i, j in pairs]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if b.empty:
                continue
            d = b["d"].to_numpy()
            s = b["s"].to_numpy()
            t = b["d_s"].to_numpy()
            logs, f1, fl, q1, ql, q2 = tie_sums(s, t, d)
            sx = np.stack([b[f"s_{i}"].to_numpy() for i in range(p)])
            tx = np.stack([b[f"d_s_{i}"].to_numpy() for i in range(p)])
            dx = np.stack([b[f"x_{i}"].to_numpy() for i in range(p)])
            row = {"ll": float((beta @ dx).sum() - logs.sum())}
            for i in range(p):
                row[f"g{i}"] = float((dx[i] - (sx[i] * f1 - tx[i] * fl / d)).sum())
            for i, j in pairs:
                sxx, txx = b[f"s_{i}_{j}"].to_numpy(), b[f"d_s_{i}_{j}"].to_numpy()
                second = sxx * f1 - txx * fl / d
                cross = (
                    sx[i] * sx[j] * q1
                    - (sx[i] * tx[j] + tx[i] * sx[j]) * ql / d
                    + tx[i] * tx[j] * q2 / d**2
                )
                row[f"h{i}_{j}"] = float((second - cross).sum())
            yield pd.DataFrame([row])

    return run, names


def fit_cox(
    df: DataFrame,
    features: Sequence[str],
    duration: str = "duration_days",
    event: str = "event_observed",
    penalizer: float = 0.01,
    max_iter: int = 25,
    tolerance: float = 1e-7,
) -> CoxModel:
    """Newton steps on the partial likelihood, tied deaths by Efron's rule.

    Every step folds the rows to one per duration on the executors; the driver sees one row of
    p + p(p+1)/2 + 1 sums. Features are standardised, and the ridge term is on that scale.
    Raises when the fit cannot be made.
    """
    p = len(features)
    data = df.select(
        F.col(duration).cast("double").alias("t"),
        F.col(event).cast("int").alias("e"),
        *[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)],
    ).dropna()
    stats = data.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("e").alias("deaths"),
        *[F.avg(f"x{i}").alias(f"m{i}") for i in range(p)],
        *[F.stddev_samp(f"x{i}").alias(f"s{i}") for i in range(p)],
    ).first()
    n = stats["n"]
    if not n or not stats["deaths"]:
        raise ValueError("no complete rows with an observed event")
    mean = np.array([stats[f"m{i}"] for i in range(p)])
    std = np.array([stats[f"s{i}"] or 0.0 for i in range(p)])
    if (std == 0).any():
        raise ValueError(f"constant features: {[f for f, s in zip(features, std, strict=True) if s == 0]}")
    z = data.select(
        "t", "e", *[((F.col(f"x{i}") - float(mean[i])) / float(std[i])).alias(f"z{i}") for i in range(p)]
    ).cache()
    hot = hot_groups(z.select("t").distinct(), [])
    beta, last = np.zeros(p), -np.inf
    info = np.eye(p)
    step = 0
    try:
        for step in range(1, max_iter + 1):
            run, names = _efron(p, beta)
            sums = _risk_sums(z, p, beta, hot).mapInPandas(run, ", ".join(f"{c} double" for c in names))
            row = sums.agg(*[F.sum(c).alias(c) for c in names]).first()
            grad = np.array([row[f"g{i}"] for i in range(p)]) / n - penalizer * beta
            info = np.zeros((p, p))
            for i, j in _pairs(p):
                info[i, j] = info[j, i] = row[f"h{i}_{j}"] / n
            info = info + penalizer * np.eye(p)
            last = row["ll"]
            move = np.linalg.solve(info, grad)
            scale = min(1.0, 3.0 / max(np.abs(move).max(), 1e-12))
            beta = beta + move * scale
            if np.abs(move).max() < tolerance:
                break
        else:
            raise RuntimeError(f"no convergence in {max_iter} steps")
    finally:
        z.unpersist()
    errors = np.sqrt(np.diag(np.linalg.inv(info * n))) / std
    return CoxModel(tuple(features), beta / std, mean, errors, float(last), step)


def cox_risk(df: DataFrame, model: CoxModel, out: str = "cox_churn_risk_score") -> DataFrame:
    return df.withColumn(out, model.risk())


# --- concordance ----------------------------------------------------------------------------------


def concordance_index(df: DataFrame, duration: str, event: str, risk: str) -> DataFrame:
    """Share of comparable pairs in which the higher risk has the shorter life; ties count half.

    A pair is comparable when the shorter life ended in an event, or when both are equal and exactly
    one did. Pairs are never formed: scores get a dense rank, and for every bit of the rank the rows
    that agree above it are split by it and counted against each other along the duration. The work
    is rows times bits, with partial sums taken before the shuffle.
    """
    fold = (
        df.select(
            F.col(duration).cast("double").alias("t"),
            F.when(F.col(event).cast("int") == 1, 0).otherwise(1).alias("censored"),
            (-F.col(risk).cast("double")).alias("score"),
        )
        .dropna()
        .groupBy("t", "censored", "score")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    hot = hot_groups(df, [])
    ranks = scan(fold.select("score").distinct(), [], ["score"], hot, r=Running(F.lit(1)))
    rows = fold.join(ranks, "score")
    died = F.when(F.col("censored") == 0, F.col("c")).otherwise(0)
    later = lambda total, upto: F.col(total) - F.col(upto)
    place = ["t", "censored"]

    overall = fold.groupBy(*place).agg(F.sum("c").alias("c"), F.sum(died).alias("e"))
    # Groups below hold one row per place, so few places leave no group too large.
    few = overall.count() <= hot_rows_limit(df)
    known = NO_HOT if few else None
    pairs = scan(overall, [], place, known, _u=Running(F.col("c")), _a=Total(F.col("c"))).agg(
        F.sum(F.col("e") * later("_a", "_u")).alias("pairs")
    )
    same = scan(
        rows.withColumn("e", died), ["r"], place, known, _u=Running(F.col("c")), _a=Total(F.col("c"))
    ).agg(F.sum(F.col("e") * later("_a", "_u")).alias("tied"))

    bits = max(1, int(ranks.count()).bit_length())
    level = rows.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(bits - 1)))).withColumns(
        {
            "head": F.expr("shiftright(r, b + 1)"),
            "one": F.expr("shiftright(r, b) & 1"),
        }
    )
    split = level.groupBy("b", "head", *place).agg(
        F.sum(F.when(F.col("one") == 1, F.col("c")).otherwise(0)).alias("high"),
        F.sum(F.when(F.col("one") == 0, died).otherwise(0)).alias("low_died"),
    )
    right = scan(split, ["b", "head"], place, known, _u=Running(F.col("high")), _a=Total(F.col("high"))).agg(
        F.sum(F.col("low_died") * later("_a", "_u")).alias("concordant")
    )
    one = right.withColumns({"tied": same.select("tied").scalar(), "pairs": pairs.select("pairs").scalar()})
    index = (F.col("concordant") + F.col("tied") / 2.0) / F.col("pairs")
    return one.select("pairs", "concordant", "tied", index.alias("concordance_index"))
