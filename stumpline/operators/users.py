"""User features, segments, interventions and rankings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.functions.exprs import flag_sum
from stumpline.functions.quantiles import exact_quantiles, with_scalars
from stumpline.functions.scan import RowNumber, Total, hot_groups, scan

CRORE = 1e7
PLATFORM_USERS = 190_000_000

# Age group codes, churn model inputs and their defaults.
AGE_CODES = {"18-24": 0, "25-34": 1, "35-44": 2, "45+": 3}
CHURN_FEATURES = (
    "recency_days", "frequency_contests_per_week", "monetary_deposits", "win_rate",
    "team_diversity_score", "loss_streak_length", "avg_team_score_percentile", "winnings_last_30d",
)
CHURN_DEFAULTS = {
    "win_rate": 0.3, "team_diversity_score": 0.5, "avg_team_score_percentile": 0.5,
    "winnings_last_30d": 0.0, "total_deposits": 500.0,
}
COX_FEATURES = (
    "log_frequency", "monetary_deposits", "win_rate", "loss_streak_length", "diversity_score",
    "inactivity_risk", "mega_contest_affinity", "ipl_focus", "referral_score", "captain_change_freq",
)

# Intervention plan for four segments.
INTERVENTIONS_4 = (
    ("At-Risk High-CLV", "High", 1, "Personalised bonus + favourite player promo + streak protection",
     "SMS + Email + In-App Push", "₹500 bonus + free team entry", 0.20),
    ("High-CLV Loyalist", "Low", 2, "VIP referral bonus + loyalty badge + exclusive contests",
     "Email + In-App", "₹200 referral bonus", 0.35),
    ("Medium-CLV Grower", "Medium", 3, "Contest nudge + first-deposit match + team tips",
     "Push Notification + Email", "100% deposit match up to ₹250", 0.15),
    ("Low-CLV Casual", "Medium", 4, "Re-engagement push + free contest entry",
     "Push Notification", "Free ₹10 contest entry", 0.08),
)
# Intervention plan for five segments.
INTERVENTIONS_5 = (
    ("Churn Risk", "Critical", "Cashback offer + push notification + personalised captain suggestion",
     0.35, 150, "High-value users about to churn — immediate retention bonus"),
    ("High Roller", "High", "Exclusive mega-contest invitations + referral bonus",
     0.20, 75, "Keep whales engaged with VIP treatment"),
    ("Loyal Grinder", "Medium", "Low-risk contest suggestions + streak rewards",
     0.15, 30, "Maintain engagement of consistent users"),
    ("Promo Hunter", "Low", "Targeted promo contests + limited-time offers",
     0.10, 20, "Convert promo-dependent users to regular play"),
    ("Casual", "Low", "Re-engagement email + beginner contest invite",
     0.08, 10, "Bring back casual users with low effort"),
)


def fill_derived(df: DataFrame) -> DataFrame:
    """Derive contests per week and the loss streak where a source lacks the columns."""
    have, cols = set(df.columns), {}
    if "contests_entered_per_week" not in have:
        cols["contests_entered_per_week"] = (
            F.col("contests_joined") / F.greatest(F.col("lifetime_days"), F.lit(1)) * 7
            if {"contests_joined", "lifetime_days"} <= have
            else F.lit(1.0)
        )
    if "loss_streak_length" not in have:
        cols["loss_streak_length"] = ((F.lit(1.0) - F.col("win_rate")) * 5).cast("int")
    return df.withColumns(cols) if cols else df


def win_rate_bucket(rate: Column) -> Column:
    """Right-closed bins; 0 itself belongs to none."""
    return (
        F.when((rate > 0) & (rate <= 0.05), "low")
        .when((rate > 0.05) & (rate <= 0.15), "medium")
        .when((rate > 0.15) & (rate <= 0.30), "high")
        .when((rate > 0.30) & (rate <= 1.0), "elite")
    )


def user_features_src(users: DataFrame) -> DataFrame:
    """Recency, frequency, money, engagement flags, buckets, codes and the survival target.

    Constant defaults stand in for missing columns.
    """
    df = fill_derived(users)
    have = set(df.columns)
    c = F.col
    value = lambda name: c(name) if name in have else F.lit(CHURN_DEFAULTS[name])
    days = (
        F.coalesce(c("days_since_last_login").cast("int"), F.lit(14))
        if "days_since_last_login" in have
        else F.lit(45 if "churn_window_days" not in have else 14)
    )
    age = c("age_group") if "age_group" in have else F.lit("25-34")
    code = F.lit(None).cast("int")
    for name, k in AGE_CODES.items():
        code = F.when(age == name, k).otherwise(code)
    deposits = value("total_deposits")
    first = {
        "recency_days": days,
        "frequency_contests_per_week": F.coalesce(c("contests_entered_per_week").cast("double"), F.lit(1.0)),
        "monetary_deposits": deposits,
        "monetary_withdrawals": c("total_withdrawals") if "total_withdrawals" in have else deposits * 0.3,
        "loss_streak_length": F.coalesce(c("loss_streak_length").cast("int"), F.lit(3)),
        "win_rate_bucket": win_rate_bucket(c("win_rate")),
        "team_diversity_score": value("team_diversity_score"),
        "avg_team_score_percentile": value("avg_team_score_percentile"),
        "winnings_last_30d": value("winnings_last_30d"),
        "age_group": age,
        "age_group_encoded": F.coalesce(code, F.lit(1)),
        "churned": c("churned").cast("int"),
    }
    return df.withColumns(first).withColumns(
        {
            "contests_entered_per_week": c("frequency_contests_per_week"),
            "net_deposits": c("monetary_deposits") - c("monetary_withdrawals"),
            "is_high_engagement": (c("frequency_contests_per_week") >= 5).cast("int"),
            "is_dormant": (c("recency_days") >= 14).cast("int"),
            "loss_streak_sq": c("loss_streak_length") * c("loss_streak_length"),
            "low_diversity": (c("team_diversity_score") < 0.3).cast("int"),
            "churn_class": c("churned"),
            "duration_days": c("recency_days") if "days_since_last_login" in have else F.lit(14),
            "event_observed": c("churned"),
        }
    )


def user_features_ext(users: DataFrame) -> DataFrame:
    """Log-scaled and behavioural features; columns a source lacks are left out."""
    df = fill_derived(users)
    have = set(df.columns)
    c = F.col
    top = df.agg(F.max("loss_streak_length").alias("_top_streak"))
    cols = {
        "recency_days": c("days_since_last_login"),
        "log_recency": F.log1p(c("days_since_last_login")),
        "inactivity_risk": (c("days_since_last_login") > 30).cast("int"),
        "frequency_contests_per_week": c("contests_entered_per_week"),
        "log_frequency": F.log1p(c("contests_entered_per_week")),
        "monetary_deposits": F.log1p(c("total_deposits")),
        "duration_days": F.greatest(c("days_since_last_login"), F.lit(1)),
        "event_observed": c("churned").cast("int"),
        "churn_class": c("churned").cast("int"),
        "loss_streak_risk": F.when(c("_top_streak") > 0, c("loss_streak_length") / c("_top_streak")).otherwise(0.0),
    }
    optional = {
        "session_engagement": ("session_frequency_per_week", lambda: c("session_frequency_per_week") * c("contests_entered_per_week")),
        "log_winnings": ("winnings_last_30d", lambda: F.log1p(c("winnings_last_30d"))),
        "net_deposits": ("total_withdrawals", lambda: c("total_deposits") - c("total_withdrawals")),
        "withdrawal_ratio": ("total_withdrawals", lambda: c("total_withdrawals") / F.greatest(c("total_deposits"), F.lit(1.0))),
        "diversity_score": ("team_diversity_score", lambda: c("team_diversity_score")),
        "mega_contest_affinity": ("mega_contest_ratio", lambda: c("mega_contest_ratio")),
        "captain_change_freq": ("captain_change_frequency", lambda: c("captain_change_frequency")),
        "referral_score": ("referral_activity", lambda: c("referral_activity")),
        "late_joining_risk": ("late_match_joining_pct", lambda: c("late_match_joining_pct")),
        "ipl_focus": ("ipl_only_user", lambda: c("ipl_only_user")),
        "playoffs_boost": ("playoffs_engagement", lambda: c("playoffs_engagement")),
    }
    cols |= {name: make() for name, (needs, make) in optional.items() if needs in have}
    kept = ["user_id", "age_group", "city", "favourite_player", "win_rate", "loss_streak_length", "total_deposits", "winnings_last_30d"]
    out = with_scalars(df, top).withColumns(cols)
    return out.select(*[k for k in kept if k in have], *cols)


def rft_summary(users: DataFrame) -> DataFrame:
    """Frequency, recency, age and monthly value over a 90 day window, and whether still active."""
    days = F.col("days_since_last_login")
    return users.withColumns(
        {
            "frequency": F.col("contests_entered_per_week") * 4,
            "recency": F.when(days < 45, F.lit(90.0) - days).otherwise(0.0),
            "T": F.lit(90.0),
            "monetary_value": F.when(F.col("total_deposits") > 0, F.col("total_deposits") / 12).otherwise(0.0),
            "is_active": days < 45,
        }
    )


def clv_fallback(users: DataFrame) -> DataFrame:
    """Value estimate without a fitted model."""
    return users.withColumns(
        {
            "predicted_clv": F.greatest(F.col("total_deposits"), F.lit(0.0)) * (F.lit(1.0) - F.col("churned") * 0.5),
            "predicted_purchases": F.col("contests_entered_per_week") * 4,
        }
    )


def clv_quartile(users: DataFrame, value: str = "predicted_clv", key: str = "user_id") -> DataFrame:
    """Quartile by rank, ties ranked by ``key``.

    Ranks are taken on (value, key) alone; the rows themselves are labelled by comparing with the
    three boundary pairs, without a shuffle.
    """
    pair = F.struct(F.col(value).alias("v"), F.col(key).alias("k"))
    ranked = scan(
        users.filter(F.col(value).isNotNull()).select(value, key),
        [],
        [value, key],
        hot_groups(users, []),
        _r=RowNumber(),
        _n=Total(F.lit(1)),
    )
    edge = lambda q: F.max(F.when(F.col("_r") <= F.lit(1) + (F.col("_n") - 1) * q, pair))
    edges = ranked.agg(edge(0.25).alias("_e1"), edge(0.5).alias("_e2"), edge(0.75).alias("_e3"))
    label = (
        F.when(F.col(value).isNull(), None)
        .when(pair <= F.col("_e1"), "Q1_Low")
        .when(pair <= F.col("_e2"), "Q2")
        .when(pair <= F.col("_e3"), "Q3")
        .otherwise("Q4_High")
    )
    return with_scalars(users, edges).withColumn("clv_quartile", label).drop("_e1", "_e2", "_e3")


def churn_risk() -> Column:
    days, streak = F.col("days_since_last_login"), F.col("loss_streak_length")
    return (
        F.when((days > 30) | (streak >= 5), "High").when((days > 14) | (streak >= 2), "Medium").otherwise("Low")
    )


def segment_4(users: DataFrame, value: str = "predicted_clv") -> DataFrame:
    """Value quartile, churn risk and one of four segments."""
    top = F.col("clv_quartile") == "Q4_High"
    label = (
        F.when(top & (F.col("churn_risk") == "High"), "At-Risk High-CLV")
        .when(top, "High-CLV Loyalist")
        .when(F.col("clv_quartile").isin("Q2", "Q3"), "Medium-CLV Grower")
        .otherwise("Low-CLV Casual")
    )
    return clv_quartile(users, value).withColumn("churn_risk", churn_risk()).withColumn("segment", label)


def segment_5(users: DataFrame, value: str = "predicted_clv", mega: Column | None = None) -> DataFrame:
    """One of five segments and its risk, against the upper quartile of value."""
    promo = mega if mega is not None else F.coalesce(F.col("mega_contest_ratio") > 0.3, F.lit(False))
    high, gone = F.col(value) > F.col("_q75"), F.col("churned") == 1
    label = (
        F.when(high & gone, "Churn Risk")
        .when(high & ~gone & (F.col("win_rate") > 0.55), "High Roller")
        .when(high & ~gone, "Loyal Grinder")
        .when(~high & promo, "Promo Hunter")
        .otherwise("Casual")
    )
    risk = F.when(F.col("segment") == "Churn Risk", 0.8).when(F.col("segment") == "Casual", 0.5).otherwise(0.2)
    wide = with_scalars(users, exact_quantiles(users, value, {"_q75": 0.75}))
    return wide.withColumn("segment", label).withColumn("churn_risk_score", risk).drop("_q75")


def intervention_matrix(spark: SparkSession, segments: int = 4) -> DataFrame:
    if segments == 4:
        return spark.createDataFrame(
            list(INTERVENTIONS_4),
            "segment string, target_risk string, priority int, intervention string, channel string, "
            "offer_value string, expected_conversion double",
        )
    return spark.createDataFrame(
        list(INTERVENTIONS_5),
        "segment string, priority string, intervention string, expected_conversion double, "
        "cost_per_user int, rationale string",
    )


def assign_interventions(segmented: DataFrame, segments: int = 4) -> DataFrame:
    """Attach the plan of each user's segment."""
    plan = intervention_matrix(segmented.sparkSession, segments)
    return segmented.join(F.broadcast(plan), "segment", "left")


def clv_summary(users: DataFrame, value: str = "predicted_clv") -> DataFrame:
    """Mean, median, 95th percentile, and the share of value held by the top tenth."""
    limits = exact_quantiles(users, value, {"_median": 0.5, "_p90": 0.9, "_p95": 0.95})
    above = F.sum(F.when(F.col(value) >= F.col("_p90"), F.col(value)).otherwise(0.0))
    return with_scalars(users, limits).agg(
        F.avg(value).alias("mean_clv"),
        F.max("_median").alias("median_clv"),
        F.max("_p95").alias("p95_clv"),
        (above / F.sum(value)).alias("top_decile_share"),
    )


def revenue_impact_src(segmented: DataFrame, value: str = "predicted_clv") -> DataFrame:
    """Per segment: users, mean value, yearly deposits at risk and the part recovered, in crore."""
    plan = intervention_matrix(segmented.sparkSession, 4).select("segment", "expected_conversion")
    per = segmented.groupBy("segment").agg(F.count(F.lit(1)).alias("users_in_segment"), F.avg(value).alias("avg_clv"))
    risk = F.col("users_in_segment") * F.col("avg_clv") * 12
    return per.join(F.broadcast(plan), "segment").select(
        "segment",
        "users_in_segment",
        "avg_clv",
        (risk / CRORE).alias("annual_deposits_at_risk_cr"),
        F.col("expected_conversion").alias("conversion_rate"),
        (risk * F.col("expected_conversion") / CRORE).alias("recovered_annual_cr"),
    )


def platform_recovery(segmented: DataFrame, value: str = "predicted_clv", platform_users: int = PLATFORM_USERS) -> DataFrame:
    """Recovered total of the sample and its extrapolation to the platform."""
    total = revenue_impact_src(segmented, value).agg(
        F.sum("recovered_annual_cr").alias("total_recovered_cr_sample"), F.sum("users_in_segment").alias("_n")
    )
    ratio = F.col("_n") / float(max(platform_users, 1))
    return total.select(
        "total_recovered_cr_sample",
        F.when(ratio > 0, F.col("total_recovered_cr_sample") / ratio / 100)
        .otherwise(0.0)
        .alias("estimated_platform_recovery_cr"),
    )


def revenue_impact_net(
    segmented: DataFrame, value: str = "predicted_clv", platform_users: int = PLATFORM_USERS, whole_users: bool = True
) -> DataFrame:
    """Per segment at platform scale: recovered value (30 % of worth) less cost, in crore."""
    plan = intervention_matrix(segmented.sparkSession, 5).select("segment", "expected_conversion", "cost_per_user")
    per = segmented.groupBy("segment").agg(F.count(F.lit(1)).alias("_n"), F.avg(value).alias("_clv"))
    total = segmented.agg(F.count(F.lit(1)).alias("_total")).select("_total").scalar()
    c = F.col
    scaled = c("_n") / (total / float(platform_users))
    out = F.broadcast(plan).join(per, "segment", "left").withColumns(
        {"_n": F.coalesce("_n", F.lit(0)), "avg_clv": F.coalesce("_clv", F.lit(0.0))}
    )
    users = F.floor(scaled).cast("double") if whole_users else scaled
    return (
        out.withColumn("users_platform", users)
        .withColumns(
            {
                "recovered_users": c("users_platform") * c("expected_conversion"),
                "cost_cr": c("users_platform") * c("cost_per_user") / CRORE,
            }
        )
        .withColumn("recovered_value_cr", c("recovered_users") * c("avg_clv") * 0.3 / CRORE)
        .select(
            "segment",
            "users_platform",
            "avg_clv",
            c("expected_conversion").alias("conversion_rate"),
            "recovered_users",
            "recovered_value_cr",
            "cost_cr",
            (c("recovered_value_cr") - c("cost_cr")).alias("net_recovery_cr"),
        )
    )


def risk_rankings(
    scored: DataFrame, score: str, n: int = 100, ids: DataFrame | None = None, columns: Sequence[str] | None = None
) -> DataFrame:
    """Users by falling risk, ties by id. With ``ids``, only those users are ranked."""
    df = scored if ids is None else scored.join(ids, "user_id", "left_semi")
    default = ("user_id", "segment", "churn_risk", "predicted_clv", score, "days_since_last_login", "loss_streak_length", "favourite_player")
    cols = columns or [c for c in default if c in df.columns]
    return df.select(*cols).orderBy(F.desc(score), "user_id").limit(n)


def churn_overview(users: DataFrame) -> DataFrame:
    """Churn and partial churn rate, mean deposit, and how many count as at risk."""
    part = F.col("partial_churn").cast("double") if "partial_churn" in users.columns else F.col("churned") * 0.3
    cols = [
        F.count(F.lit(1)).alias("n_users"),
        F.avg(F.col("churned").cast("double")).alias("churn_rate"),
        F.avg(part).alias("partial_churn_rate"),
        F.avg("total_deposits").alias("avg_deposit"),
    ]
    if "segment" in users.columns:
        cols.append(flag_sum(F.col("segment").isin("Churn Risk", "At-Risk High-CLV")).alias("at_risk_users"))
    return users.agg(*cols)

