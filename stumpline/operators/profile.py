"""How a striker performs under pressure: one row per player."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.functions.exprs import boundary_ball, dot_ball, flag_sum, legal_ball, rate, sum_where
from stumpline.functions.scan import Hot, Lag, Trailing, lookup, scan
from stumpline.operators.aggregates import match_context, over_stats_legacy
from stumpline.operators.state import INNINGS, delivery_order

# The twelve profile features, in order.
PROFILE_FEATURES = (
    "death_overs_sr", "chase_pressure_sr", "wickets_fallen_pressure_avg", "boundary_dependency",
    "dot_ball_recovery_rate", "high_rr_required_performance", "clutch_boundary_rate",
    "collapse_resistance_score", "pressure_consistency", "spin_pressure_sr", "pace_pressure_sr",
    "momentum_shift_response",
)

# Columns of the simpler profile, in order, with the default of those not derived.
PRESSURE_COLUMNS = {
    "player": "", "pressure_sr": 0.0, "pressure_dot_pct": 0.0, "pressure_boundary_pct": 0.0,
    "pressure_dismissal_rate": 0.0, "consistency_index": 0.0, "clutch_runs_above_expected": 0.0,
    "performance_decay_slope": 0.0, "venue_pressure_delta": 0.0, "vs_pace_pressure_sr": 0.0,
    "vs_spin_pressure_sr": 0.0, "late_innings_fatigue_index": 0.0,
    "high_stakes_match_multiplier": 1.0, "known_archetype": "",
}
PRESSURE_FEATURES = tuple(c for c in PRESSURE_COLUMNS if c not in ("player", "known_archetype"))


def is_spin_by_name(bowler: Column) -> Column:
    """Name heuristic: a last letter that is a vowel counts as spin; no name, no class."""
    return F.when(F.length(bowler) > 0, F.substring(bowler, -1, 1).isin("a", "e", "i", "o", "u"))


def boundary_over_response(df: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Runs and legal balls a striker faced right after a ball from an over with a boundary.

    "After" follows the striker's own deliveries. Within one over every ball but the first follows
    a ball of the same over, so the over table (one row per striker and over) is enough.
    """
    order = [c for c in delivery_order(df) if c != "over"]
    per_over = df.groupBy("striker", *INNINGS, "over").agg(
        F.max(boundary_ball()).alias("_had"),
        sum_where(F.col("runs_off_bat"), legal_ball()).alias("_runs"),
        flag_sum(legal_ball()).alias("_legal"),
        F.min_by(
            F.struct(
                F.when(legal_ball(), F.col("runs_off_bat")).otherwise(0).alias("runs"),
                legal_ball().cast("int").alias("legal"),
            ),
            F.struct(*order),
        ).alias("_first"),
    )
    seen = scan(per_over, ["striker"], [*INNINGS, "over"], hot, _before=Lag(F.col("_had")))
    first, before = F.col("_first"), F.coalesce("_before", F.lit(False))

    def after(total: str, part: str) -> Column:
        rest = F.when(F.col("_had"), F.col(total) - first[part]).otherwise(0)
        return F.sum(rest + F.when(before, first[part]).otherwise(0))

    return seen.groupBy("striker").agg(
        after("_runs", "runs").alias("_shift_runs"), after("_legal", "legal").alias("_shift_legal")
    )


def pressure_profile(
    state: DataFrame,
    min_balls: int = 10,
    bowler_types: DataFrame | None = None,
    hot: Hot | None = None,
    hot_strikers: Hot | None = None,
) -> DataFrame:
    """The twelve features plus appearances, balls, runs and overall rate, per striker.

    ``hot`` and ``hot_strikers`` pass known lists of oversized innings and strikers.

    ``bowler_types(bowler, is_spin)`` replaces the name heuristic when given.
    """
    c = F.col
    df = state.dropna(subset=["striker"])
    if bowler_types is not None:
        df = lookup(df, bowler_types.select("bowler", "is_spin"), ["bowler"])
        spin = c("is_spin")
    else:
        spin = is_spin_by_name(c("bowler"))
    df = scan(
        df, INNINGS, delivery_order(df), hot, _recent_wickets=Trailing(F.coalesce("wickets", F.lit(0)), 6)
    )
    df = scan(
        df, ["striker"], [*INNINGS, *delivery_order(df)], hot_strikers, _after_dot=Lag(dot_ball())
    )
    legal, bat = legal_ball(), c("runs_off_bat")
    death = c("over") >= 16
    chase_high = F.coalesce((c("innings") == 2) & (c("required_run_rate") > 10), F.lit(False))
    high = F.coalesce(c("required_run_rate") > 12, F.lit(False))
    collapse = c("_recent_wickets") >= 2
    clutch = death & (c("innings") == 2) & legal
    tense = death | chase_high | high

    def sr(cond: Column) -> Column:
        """Runs per hundred over the legal balls where ``cond`` holds."""
        here = cond & legal
        return rate(sum_where(bat, here), flag_sum(here), 100)

    collapse_sr = rate(sum_where(bat, collapse), flag_sum(collapse & legal), 100)
    per = df.groupBy("striker").agg(
        F.countDistinct("match_id").alias("appearances"),
        flag_sum(legal).alias("total_balls_faced"),
        F.sum(bat).alias("total_runs"),
        sr(death).alias("death_overs_sr"),
        sr(chase_high).alias("chase_pressure_sr"),
        collapse_sr.alias("wickets_fallen_pressure_avg"),
        rate(sum_where(bat, boundary_ball()), F.sum(bat)).alias("boundary_dependency"),
        sr(F.coalesce("_after_dot", F.lit(False))).alias("dot_ball_recovery_rate"),
        sr(high).alias("high_rr_required_performance"),
        rate(flag_sum(clutch & boundary_ball()), flag_sum(clutch)).alias("clutch_boundary_rate"),
        collapse_sr.alias("collapse_resistance_score"),
        F.when(flag_sum(tense) > 5, F.stddev_pop(F.when(tense, bat)))
        .otherwise(0.5)
        .alias("pressure_consistency"),
        sr(F.coalesce(spin, F.lit(False))).alias("spin_pressure_sr"),
        sr(F.coalesce(~spin, F.lit(False))).alias("pace_pressure_sr"),
    )
    shift = boundary_over_response(state.dropna(subset=["striker"]), hot_strikers)
    return (
        per.filter(c("total_balls_faced") >= min_balls)
        .join(shift, "striker", "left")
        .select(
            c("striker").alias("player"),
            "appearances",
            "total_balls_faced",
            "total_runs",
            *[f for f in PROFILE_FEATURES if f != "momentum_shift_response"],
            rate(c("_shift_runs"), c("_shift_legal"), 100).alias("momentum_shift_response"),
            rate(c("total_runs"), c("total_balls_faced"), 100).alias("overall_sr"),
        )
    )


# --- simpler profile on the second internal schema -----------------------------------------------


def in_pressure_over(deliveries: DataFrame, context: DataFrame) -> DataFrame:
    """Mark deliveries whose over was flagged in the over context."""
    flagged = (
        context.filter("pressure_ball")
        .select("match_id", "innings", "over")
        .distinct()
        .withColumn("_flagged", F.lit(True))
    )
    marked = lookup(deliveries, flagged, ["match_id", "innings", "over"])
    return marked.withColumn("is_pressure_over", F.coalesce("_flagged", F.lit(False))).drop("_flagged")


def row_archetype() -> Column:
    """Label of one player from absolute thresholds."""
    sr, dot = F.col("pressure_sr"), F.col("pressure_dot_pct")
    out, decay = F.col("pressure_dismissal_rate"), F.col("performance_decay_slope")
    return (
        F.when((sr > 140) & (dot < 0.35) & (out < 0.12) & (decay > -20), "Ice-blooded finisher")
        .when((sr < 100) | (dot > 0.55), "Pressure crumbler")
        .when(sr.between(100, 135) & (out < 0.10), "Steady accumulator")
        .otherwise("Panic scorer")
    )


def derive_pressure_features(
    deliveries: DataFrame, min_balls: int = 5, context: DataFrame | None = None
) -> DataFrame:
    """Strike rate, dots, boundaries and dismissals under pressure against the rest, per batter."""
    ctx = context if context is not None else match_context(over_stats_legacy(deliveries))
    df = in_pressure_over(deliveries.dropna(subset=["batter"]), ctx)
    c, runs = F.col, F.col("runs")
    wide, noball = F.coalesce(c("is_wide"), F.lit(0)) > 0, F.coalesce(c("is_noball"), F.lit(0)) > 0
    legal = ~wide & ~noball
    hot = c("is_pressure_over") | (c("over") >= 16)
    out = F.coalesce(c("is_wicket").cast("int"), F.lit(0))
    per = (
        df.groupBy(c("batter").alias("player"))
        .agg(
            F.countDistinct("match_id").alias("appearances"),
            F.sum(runs).alias("total_runs"),
            flag_sum(legal).alias("total_balls_faced"),
            sum_where(runs, hot).alias("_runs"),
            flag_sum(hot & legal).alias("_balls"),
            sum_where(out, hot).alias("_outs"),
            flag_sum(hot & legal & (runs == 0)).alias("_dots"),
            flag_sum(hot & (runs >= 4) & ~wide).alias("_fours"),
            rate(sum_where(runs, ~hot), flag_sum(~hot & legal), 100).alias("_calm_sr"),
            F.stddev_pop(F.when(legal, runs)).alias("_std"),
        )
        .filter(c("total_balls_faced") >= min_balls)
    )
    seen = c("_balls") > 0
    when = lambda value, other: F.when(seen, value).otherwise(F.lit(other))
    tense_sr = rate(c("_runs"), c("_balls"), 100)
    derived = per.withColumns(
        {
            "strike_rate": rate(c("total_runs"), c("total_balls_faced"), 100),
            "pressure_sr": when(tense_sr, 0.0),
            "pressure_dot_pct": when(rate(c("_dots"), c("_balls")), 0.5),
            "pressure_boundary_pct": when(rate(c("_fours"), c("_balls")), 0.0),
            "pressure_dismissal_rate": when(rate(c("_outs"), c("_balls")), 0.0),
            "consistency_index": F.when(c("total_balls_faced") > 1, c("_std")).otherwise(0.5),
            "clutch_runs_above_expected": when(c("_runs") - c("_calm_sr") * c("_balls") / 100, 0.0),
            "performance_decay_slope": when(c("_calm_sr") - tense_sr, 0.0),
        }
    ).withColumn("known_archetype", row_archetype())
    return derived.drop("_runs", "_balls", "_outs", "_dots", "_fours", "_calm_sr", "_std")


def pressure_features(deliveries: DataFrame, n: int | None = None) -> DataFrame:
    """Fixed fourteen columns, one row per player; warns when fewer than ``n`` players exist."""
    df = derive_pressure_features(deliveries)
    if n is not None:
        have = df.count()
        if have < n:
            warnings.warn(f"{have} players available, {n} requested", stacklevel=2)
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(d).alias(c) for c, d in PRESSURE_COLUMNS.items()]
    )
