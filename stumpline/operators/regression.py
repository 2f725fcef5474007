"""Ridge regressions of several goals on the same inputs, from one pass over the rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The sums of squares and products of so many inputs reach the driver.
MAX_INPUTS = 1_000


@dataclass(frozen=True)
class Ridge:
    intercept: float
    coefficients: np.ndarray
    rows: int

    def predict(self, inputs: Sequence[str]) -> Column:
        out = F.lit(self.intercept)
        for name, b in zip(inputs, self.coefficients, strict=True):
            out = out + F.col(name) * F.lit(float(b))
        return out


def fit_ridge(df: DataFrame, inputs: Sequence[str], goals: Sequence[str], ridge: float = 1e-3) -> dict[str, Ridge]:
    """Coefficients b of every goal that solve (cov(x) + ridge) b = cov(x, y), over the rows where the goal is known.

    A task adds up the squares and products of its rows for all goals together; Spark adds up the tasks' sums, one row
    per (goal, input). Inputs are not null. Raises where a goal has no rows or an input is not finite.
    """
    p = len(inputs)
    if p > MAX_INPUTS:
        raise ValueError(f"more than {MAX_INPUTS} inputs")
    rows = df.select(F.array(*[F.col(c).cast("double") for c in inputs]).alias("x"), F.array(*[F.col(g).cast("double") for g in goals]).alias("y"))
    many = len(goals)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((many, p + 1, p + 2))
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            y = batch.column("y").flatten().to_numpy(zero_copy_only=False).reshape(-1, many)
            if not np.isfinite(x).all():
                raise ValueError("inputs have to be finite")
            one = np.column_stack([np.ones(len(x)), x])
            for h in range(many):
                known = np.isfinite(y[:, h])
                total[h] += one[known].T @ np.column_stack([one[known], y[known, h]])
        at = [(h, i) for h in range(many) for i in range(p + 1)]
        sums = [total[h, i].tolist() for h, i in at]
        yield pa.record_batch([pa.array([a[0] for a in at], pa.int32()), pa.array([a[1] for a in at], pa.int32()), pa.array(sums, pa.list_(pa.float64()))], names=["h", "i", "s"])

    parts = rows.mapInArrow(add, "h int, i int, s array<double>")
    summed = parts.groupBy("h", "i").agg(F.array(*[F.sum(F.col("s")[j]) for j in range(p + 2)]).alias("s")).collect()
    total = np.zeros((many, p + 1, p + 2))
    for r in summed:
        total[r["h"], r["i"]] = r["s"]
    out = {}
    for h, goal in enumerate(goals):
        n = total[h, 0, 0]
        if not n:
            raise ValueError(f"no rows to learn {goal} from")
        mean = total[h, 0] / n
        both = total[h, 1:, 1:] / n - np.outer(mean[1:-1], mean[1:])
        b = np.linalg.solve(both[:, :-1] + ridge * np.eye(p), both[:, -1])
        out[goal] = Ridge(float(mean[-1] - mean[1:-1] @ b), b, int(n))
    return out
