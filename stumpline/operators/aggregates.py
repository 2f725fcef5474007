"""Over, player and match aggregates.

Group keys that are null are dropped, as the grouping they reproduce does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.functions.exprs import boundary_ball, bowled_wide, dot_ball, flag_sum, legal_ball, rate, six_ball
from stumpline.functions.quantiles import exact_quantiles

OVER_KEYS = ("match_id", "innings", "batting_team", "over")


def over_level(df: DataFrame) -> DataFrame:
    """Per (match, innings, team, over) counts with running score and wickets, and the season where there is one."""
    wide = bowled_wide()
    season = [F.min("season").alias("season")] if "season" in df.columns else []
    per = (
        df.dropna(subset=list(OVER_KEYS))
        .groupBy(*OVER_KEYS)
        .agg(
            F.sum("runs").alias("runs_scored"),
            F.sum("wickets").alias("wickets"),
            flag_sum((F.col("runs_off_bat") >= 4) & ~wide).alias("boundaries"),
            flag_sum((F.col("runs_off_bat") >= 6) & ~wide).alias("sixes"),
            flag_sum(dot_ball()).alias("dot_balls"),
            flag_sum(legal_ball()).alias("total_balls"),
            F.sum("extras").alias("extras"),
            F.sum("wides").alias("wides"),
            F.sum("noballs").alias("noballs"),
            *season,
        )
    )
    return running_score(per)


def running_score(per_over: DataFrame) -> DataFrame:
    """Cumulative score and wickets. At most 50 overs per innings and team remain by now."""
    upto = (
        Window.partitionBy("match_id", "innings")
        .orderBy("batting_team", "over")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return per_over.withColumns(
        {
            "cumulative_score": F.sum("runs_scored").over(upto),
            "cumulative_wickets": F.sum("wickets").over(upto),
        }
    )


def player_level(df: DataFrame, key: str = "striker") -> DataFrame:
    """Career line of every striker."""
    per = (
        df.dropna(subset=[key])
        .groupBy(F.col(key).alias("player"))
        .agg(
            F.countDistinct("match_id").alias("matches"),
            F.countDistinct("innings").alias("innings"),
            F.sum("runs_off_bat").alias("total_runs"),
            flag_sum(legal_ball()).alias("balls_faced"),
            flag_sum(boundary_ball()).alias("boundaries"),
            flag_sum(six_ball()).alias("sixes"),
            flag_sum(dot_ball()).alias("dot_balls"),
            F.sum("wickets").alias("dismissals"),
        )
    )
    c = F.col
    return per.withColumns(
        {
            "strike_rate": rate(c("total_runs"), c("balls_faced"), 100),
            "average": rate(c("total_runs"), c("dismissals")),
            "boundary_pct": rate(c("boundaries"), c("balls_faced")),
            "dot_ball_pct": rate(c("dot_balls"), c("balls_faced")),
        }
    )


def first_of(col: str, order: Sequence[str]) -> Column:
    """First non-null value in the given order; deterministic, unlike ``first``."""
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.struct(*order)))


def match_level(df: DataFrame) -> DataFrame:
    """Per (match, innings) totals with the first venue, date and type."""
    order = ["over", "ball", *[c for c in ("source_rank", "seq") if c in df.columns]]
    return (
        df.dropna(subset=["match_id", "innings"])
        .groupBy("match_id", "innings")
        .agg(
            F.sum("runs").alias("total_runs"),
            F.sum("wickets").alias("total_wickets"),
            F.count("runs").alias("total_balls"),
            flag_sum(F.col("runs_off_bat") >= 4).alias("boundaries"),
            flag_sum(F.col("runs_off_bat") >= 6).alias("sixes"),
            first_of("venue", order).alias("venue"),
            first_of("date", order).alias("date"),
            first_of("match_type", order).alias("match_type"),
        )
    )


def over_stats_legacy(df: DataFrame) -> DataFrame:
    """Over aggregate on the second internal schema (runs off the bat, is_* flags)."""
    have = set(df.columns)
    flag = lambda n: F.coalesce(F.col(n).cast("int"), F.lit(0)) > 0 if n in have else F.lit(False)
    wide, legal = flag("is_wide"), ~flag("is_wide") & ~flag("is_noball")
    per = (
        df.dropna(subset=list(OVER_KEYS))
        .groupBy(*OVER_KEYS)
        .agg(
            F.sum("runs").alias("runs_scored"),
            flag_sum(flag("is_wicket")).alias("wickets"),
            flag_sum((F.col("runs") >= 4) & ~wide).alias("boundaries"),
            flag_sum((F.col("runs") >= 6) & ~wide).alias("sixes"),
            flag_sum(legal & (F.col("runs") == 0)).alias("dot_balls"),
            flag_sum(legal).alias("total_balls"),
        )
    )
    return running_score(per)


# --- pressure rules on the over table ------------------------------------------------------------


def death_overs_chase() -> Column:
    """Second innings, at most four overs left, more than ten an over wanted."""
    return (F.col("innings") == 2) & (F.col("overs_remaining") <= 4) & (F.col("required_run_rate") > 10)


def early_collapse() -> Column:
    return (F.col("over") <= 15) & (F.col("wickets_fallen") >= 6)


def tight_finish() -> Column:
    """Second innings, ten or fewer wanted, at most two wickets in hand."""
    needed = F.col("target") - F.col("cumulative_score")
    return (F.col("innings") == 2) & (needed > 0) & (needed <= 10) & (F.col("wickets_fallen") >= 8)


PRESSURE_RULES = {
    "death_overs_chase": death_overs_chase,
    "early_collapse": early_collapse,
    "tight_finish": tight_finish,
}


def pressure_flag(rules: dict | None = None) -> Column:
    """True when any rule holds; a rule with a null input does not."""
    out = F.lit(False)
    for rule in (rules or PRESSURE_RULES).values():
        out = out | F.coalesce(rule(), F.lit(False))
    return out


def match_context(over_stats: DataFrame, rules: dict | None = None, overs: int = 20) -> DataFrame:
    """Target, overs left, runs needed, required and current rate, and the pressure flag."""
    first = (
        over_stats.filter(F.col("innings") == 1)
        .groupBy("match_id")
        .agg(F.sum("runs_scored").alias("inning1_total"))
    )
    chase = F.col("innings") == 2
    out = over_stats.join(first, "match_id", "left").withColumns(
        {
            "target": F.coalesce("inning1_total", F.lit(0)) + 1,
            "overs_remaining": F.lit(overs) - F.col("over"),
            "current_run_rate": F.when(F.col("over") > 0, F.col("cumulative_score") / F.col("over")),
            "wickets_fallen": F.col("cumulative_wickets"),
        }
    )
    needed = F.when(chase, F.col("target") - F.col("cumulative_score"))
    rrr = F.when(F.col("overs_remaining") > 0, F.col("runs_needed") / F.col("overs_remaining"))
    return (
        out.withColumn("runs_needed", needed)
        .withColumn("required_run_rate", rrr)
        .withColumn("pressure_ball", pressure_flag(rules))
    )


def match_schedule(df: DataFrame, n: int | None = None) -> DataFrame:
    """First team, city and season per match, the first ``n`` matches by id."""
    order = ["innings", "over", "ball", *[c for c in ("source_rank", "seq") if c in df.columns]]
    found = (
        df.dropna(subset=["match_id"])
        .groupBy("match_id")
        .agg(
            first_of("batting_team", order).alias("team1"),
            first_of("city", order).alias("city"),
            first_of("season", order).alias("season"),
        )
        .withColumns({"team2": F.lit(""), "is_knockout": F.lit(False)})
    )
    return found if n is None else found.orderBy("match_id").limit(n)


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (sample), min, quartiles, max of one column."""
    basic = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quart = exact_quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by)
    if by:
        return basic.join(quart, list(by))
    return basic.withColumns({c: quart.select(c).scalar() for c in ("p25", "p50", "p75")})


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency and share of each value, most frequent first."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(col).alias("_n")).select("_n").scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), col)
