"""Per-delivery match state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.functions.exprs import boundary_ball, clip, dot_ball
from stumpline.functions.scan import Hot, RowNumber, Running, Since, Total, Trailing, hot_groups, lookup, scan

INNINGS = ("match_id", "innings")
RECENT = 12


def delivery_order(df: DataFrame) -> list[str]:
    """Over, ball, then the position in the source when it is known."""
    return ["over", "ball", *[c for c in ("source_rank", "seq") if c in df.columns]] if (
        "seq" in df.columns
    ) else ["over", "ball", *[c for c in df.columns if c not in ("over", "ball")]]


def phase_of_play() -> Column:
    return (
        F.when(F.col("over") <= 6, "powerplay")
        .when(F.col("over") <= 15, "middle")
        .when(F.col("innings") == 1, "death")
        .otherwise("chase_death")
    )


def innings_target(df: DataFrame) -> DataFrame:
    """Per (match, innings): first-innings total and the target it sets (1 when there is none).

    Returned on the innings key, not the match key, so that the join reuses the partitioning the
    innings windows already need.
    """
    totals = df.groupBy(*INNINGS).agg(F.sum("runs").alias("_total"))
    first = F.max(F.when(F.col("innings") == 1, F.col("_total"))).over(Window.partitionBy("match_id"))
    return totals.select(*INNINGS, first.alias("inning1_total"))


def running_state(df: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Running totals, ball ordinals, partnership and recent-window sums of every delivery."""
    runs, wickets = F.coalesce("runs", F.lit(0)), F.coalesce("wickets", F.lit(0))
    one = F.lit(1)
    flagged = df.withColumns({"is_boundary": boundary_ball(), "is_dot_ball": dot_ball()})
    return scan(
        flagged,
        INNINGS,
        delivery_order(df),
        hot,
        total_runs=Running(runs),
        total_wickets=Running(wickets),
        ball_number=RowNumber(),
        _balls=Total(one),
        _wickets=Total(wickets),
        _boundaries=Total(F.col("is_boundary").cast("int")),
        _dots=Total(F.col("is_dot_ball").cast("int")),
        _boundaries_so_far=Running(F.col("is_boundary").cast("int")),
        _dots_so_far=Running(F.col("is_dot_ball").cast("int")),
        partnership_runs=Since(wickets > 0, runs),
        partnership_balls=Since(wickets > 0, one),
        recent_12_ball_runs=Trailing(runs, RECENT),
        recent_12_ball_wickets=Trailing(wickets, RECENT),
    )


def event_state(df: DataFrame, leakage: str = "reference", keep_working: bool = False) -> DataFrame:
    """The 20 state columns of every delivery.

    ``leakage="reference"`` uses whole-innings boundary and dot rates (and whole-innings wickets for
    the first innings' bowling pressure); ``"causal"`` uses only deliveries up to the current one.
    ``keep_working`` also returns ``ball_number`` and ``target``.
    """
    if leakage not in ("reference", "causal"):
        raise ValueError("leakage is 'reference' or 'causal'")
    causal = leakage == "causal"
    hot = hot_groups(df, INNINGS)
    run = lookup(running_state(df, hot), innings_target(df), INNINGS, hot=hot)
    col = F.col
    chase = col("innings") == 2
    rrr0 = F.coalesce("required_run_rate", F.lit(0.0))
    lost = col("total_wickets") / 10.0
    wickets_base = F.when(col("innings") == 1, col("total_wickets") if causal else col("_wickets"))

    base = run.withColumns(
        {
            "wickets_in_hand": F.lit(10) - col("total_wickets"),
            "balls_remaining": col("_balls") - col("ball_number"),
            "phase_of_play": phase_of_play(),
            "current_run_rate": col("total_runs") / F.greatest(col("ball_number") / 6.0, F.lit(0.1)),
            "target": F.coalesce("inning1_total", F.lit(0)) + 1,
            "boundary_rate": (col("_boundaries_so_far") / col("ball_number"))
            if causal
            else (col("_boundaries") / col("_balls")),
            "dot_ball_pressure": (col("_dots_so_far") / col("ball_number"))
            if causal
            else (col("_dots") / col("_balls")),
        }
    ).withColumn(
        "required_run_rate",
        F.when(
            chase & (col("balls_remaining") > 0),
            F.greatest(col("target") - col("total_runs"), F.lit(0)) / (col("balls_remaining") / 6.0),
        ),
    )
    done = (col("balls_remaining") <= 0) | (rrr0 <= 0)
    outlook = (
        F.greatest(F.lit(0.0), F.lit(1.0) - rrr0 / 12.0) * 0.5
        + col("wickets_in_hand") / 10.0 * 0.3
        + F.least(col("balls_remaining") / 72.0, F.lit(1.0)) * 0.2
    )
    late = F.when(col("over") >= 16, 1.0).otherwise(0.0)
    out = base.withColumns(
        {
            "pressure_index": F.when(
                chase, clip(rrr0 / 15.0 * 0.5 + lost * 0.3 + late * 0.2, 0.0, 1.0)
            ).otherwise(0.0),
            "momentum_score": clip(
                (col("current_run_rate") - rrr0) * (col("wickets_in_hand") / 10.0), -10.0, 10.0
            ),
            "batting_aggression_index": col("boundary_rate") * 2 + col("current_run_rate") / 6.0,
            "bowling_pressure_index": F.when(col("innings") == 1, wickets_base / 10.0).otherwise(
                lost + rrr0 / 15.0
            ),
            "chase_win_probability_proxy": F.when(~chase, 0.5)
            .when(done, F.when(col("total_runs") >= col("target"), 1.0).otherwise(0.0))
            .otherwise(F.least(outlook, F.lit(1.0))),
        }
    )
    drop = [c for c in out.columns if c.startswith("_") and c not in df.columns] + ["inning1_total"]
    if not keep_working:
        drop += ["ball_number", "target"]
    return out.drop(*drop)
