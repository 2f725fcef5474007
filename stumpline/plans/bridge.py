"""Delivery, raw-dialect and user tables derived from the ``events`` table.

The expressions are plain projections and partial aggregates. A match covers four users, so the
number of matches, players and users grows with the data while a match keeps its size.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.functions.scan import Since, scan
from stumpline.session import shared_folder as _shared

# The same text serves Spark SQL and DuckDB; {div} is the integer division of the engine and
# {sec} the whole seconds since the start of 2024.
DELIVERY_COLUMNS = {
    "seq": "event_id",
    "match_id": "CONCAT('M', CAST(user_id {div} 4 AS VARCHAR(20)))",
    "season": "CONCAT('S', CAST((user_id {div} 4) % 3 AS VARCHAR(20)))",
    "innings": "CAST(1 + event_id % 2 AS INT)",
    "over_no": "CAST(1 + {sec} {div} 129600 AS INT)",
    "ball": "CAST(1 + ({sec} % 129600) {div} 21600 AS INT)",
    "batting_team": "CONCAT('Team ', CAST((user_id {div} 4 + event_id % 2) % 8 AS VARCHAR(20)))",
    "bowling_team": "CONCAT('Team ', CAST((user_id {div} 4 + 1 - event_id % 2) % 8 AS VARCHAR(20)))",
    "striker": "CONCAT('P', CAST(user_id % 8 + 8 * (user_id {div} 64) AS VARCHAR(20)))",
    "non_striker": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE CONCAT('P', CAST((user_id + 1) % 8 + 8 * (user_id {div} 64) AS VARCHAR(20))) END",
    "bowler": "CONCAT('Bowler ', CHR(CAST(97 + event_id % 13 AS INT)))",
    "runs_off_bat": "CASE WHEN event_type = 'click' THEN 1 WHEN event_type = 'purchase' AND value >= 60 THEN 6 "
    "WHEN event_type = 'purchase' AND value >= 30 THEN 4 WHEN event_type = 'purchase' THEN 2 ELSE 0 END",
    "wides": "CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 1 ELSE 0 END",
    "noballs": "CASE WHEN event_type = 'signup' AND event_id % 5 = 1 THEN 1 ELSE 0 END",
    "byes": "0",
    "legbyes": "CASE WHEN event_type = 'view' AND event_id % 9 = 0 THEN 1 ELSE 0 END",
    "wicket_type": "CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'caught' END",
    "wickets": "CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 1 ELSE 0 END",
    "venue": "CONCAT('Venue ', CAST((user_id {div} 4) % 5 AS VARCHAR(20)))",
    "date": "CAST(CAST(ts AS DATE) AS VARCHAR(20))",
    "match_type": "'T20'",
    "city": "CASE (user_id {div} 4) % 3 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Pune' ELSE 'Delhi' END",
}

# Raw text dialect with "over.ball" counted from 0, blanks for zero extras and some junk numbers.
TEXT_COLUMNS = {
    "match_id": "match_id", "season": "season", "start_date": "date", "venue": "venue",
    "innings": "CAST(innings AS VARCHAR(20))",
    "ball": "CONCAT(CAST(over_no - 1 AS VARCHAR(20)), '.', CAST(ball AS VARCHAR(20)))",
    "batting_team": "CONCAT(' ', LOWER(batting_team))",
    "bowling_team": "LOWER(bowling_team)",
    "striker": "CONCAT(LOWER(striker), ' o''neil ')",
    "non_striker": "non_striker",
    "bowler": "CONCAT(UPPER(bowler), '-smith')",
    "runs_off_bat": "CASE WHEN seq % 50 = 0 THEN 'x' ELSE CAST(runs_off_bat AS VARCHAR(20)) END",
    "extras": "CAST(wides + noballs + legbyes AS VARCHAR(20))",
    "wides": "CASE WHEN wides > 0 THEN CAST(wides AS VARCHAR(20)) END",
    "noballs": "CASE WHEN noballs > 0 THEN CAST(noballs AS VARCHAR(20)) END",
    "byes": "CAST(NULL AS VARCHAR(20))",
    "legbyes": "CASE WHEN legbyes > 0 THEN CAST(legbyes AS VARCHAR(20)) END",
    "wicket_type": "wicket_type",
    "player_dismissed": "CASE WHEN wickets > 0 THEN striker END",
    "seq": "seq",
}

# Wide dialect without ball and non-striker, with overs, runs and extras that need repair.
WIDE_COLUMNS = {
    "match_id": "match_id", "innings": "innings",
    "over": "CASE WHEN seq % 83 = 0 THEN 60 ELSE over_no END",
    "batting_team": "batting_team", "bowling_team": "bowling_team", "striker": "striker",
    "bowler": "CASE WHEN seq % 97 = 0 THEN NULL ELSE bowler END",
    "runs_of_bat": "runs_off_bat",
    "extras": "wides + noballs + legbyes + CASE WHEN seq % 41 = 0 THEN 5 ELSE 0 END",
    "wide": "wides", "noballs": "noballs", "byes": "byes", "legbyes": "legbyes",
    "wicket_type": "wicket_type",
    "player_dismissed": "CASE WHEN wickets > 0 THEN striker END",
    "runs": "runs_off_bat + wides + noballs + legbyes + CASE WHEN seq % 29 = 0 THEN 10 ELSE 0 END",
    "wickets": "wickets", "venue_x": "venue", "date_x": "date", "team1": "batting_team", "team2": "bowling_team",
    "seq": "seq",
}

USER_AGGREGATES = {
    "contests": "COUNT(*)",
    "clicks": "SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)",
    "errors": "SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)",
    "views": "SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END)",
    "buys": "SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)",
    "big_buys": "SUM(CASE WHEN event_type = 'purchase' AND value >= 30 THEN 1 ELSE 0 END)",
    "deposits": "ROUND(SUM(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2)",
    "withdrawals": "ROUND(SUM(CASE WHEN event_type = 'signup' THEN value ELSE 0 END), 2)",
    "winnings": "ROUND(SUM(CASE WHEN event_type = 'view' THEN value ELSE 0 END), 2)",
    "last_day": "MAX(CASE WHEN event_type = 'purchase' AND value >= 40 THEN CAST(ts AS DATE) END)",
}
USER_COLUMNS = {
    "user_id": "user_id",
    "city": "CASE user_id % 3 WHEN 0 THEN 'Mumbai' WHEN 1 THEN 'Pune' ELSE 'Delhi' END",
    "age_group": "CASE user_id % 5 WHEN 0 THEN '18-24' WHEN 1 THEN '25-34' WHEN 2 THEN '35-44' WHEN 3 THEN '45+' END",
    "favourite_player": "CONCAT('P', CAST(user_id % 10 AS VARCHAR(20)))",
    "registration_date": "CAST('2023-06-01' AS DATE)",
    "contests_entered_per_week": "CAST(contests AS DOUBLE) * 7 / 30",
    "avg_team_score_percentile": "CAST(views AS DOUBLE) * 100 / contests",
    "winnings_last_30d": "winnings",
    "total_deposits": "deposits",
    "total_withdrawals": "withdrawals",
    "win_rate": "CASE WHEN 5 * clicks > 2 * contests THEN CAST(1 AS DOUBLE) ELSE CAST(5 * clicks AS DOUBLE) / (2 * contests) END",
    "team_diversity_score": "CAST(buys AS DOUBLE) * 2 / contests",
    "days_since_last_login": "CAST(COALESCE({days}, 31) + CASE WHEN user_id % 11 = 0 THEN 20 ELSE 0 END AS INT)",
    "loss_streak_length": "CAST(COALESCE(streak, 0) AS INT)",
    "churned": "CASE WHEN COALESCE(streak, 0) >= 4 OR user_id % 5 = 0 THEN 1 ELSE 0 END",
    "partial_churn": "CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END",
    "mega_contest_ratio": "CASE WHEN buys > 0 THEN CAST(big_buys AS DOUBLE) / buys ELSE CAST(0 AS DOUBLE) END",
    "session_frequency_per_week": "CAST(views AS DOUBLE) * 7 / 30",
    "captain_change_frequency": "CAST(clicks % 5 AS DOUBLE)",
    "referral_activity": "CAST(errors % 4 AS DOUBLE)",
    "late_match_joining_pct": "CAST(errors AS DOUBLE) / contests",
    "playoffs_engagement": "CAST(user_id % 2 AS INT)",
    "ipl_only_user": "CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END",
}

_SPARK = {
    "div": "div",
    "sec": "timestampdiff(SECOND, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)",
    "days": "datediff(DATE '2024-01-31', last_day)",
}


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e.format(**_SPARK)).alias(n) for n, e in columns.items()])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _base(spark: SparkSession, folder: str) -> DataFrame:
    return _select(table(spark, folder, "events"), DELIVERY_COLUMNS)


def deliveries(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical deliveries with ``seq``, season and city."""
    extras = F.col("wides") + F.col("noballs") + F.col("legbyes")
    return (
        _base(spark, folder)
        .withColumnRenamed("over_no", "over")
        .withColumns({"extras": extras, "runs": F.col("runs_off_bat") + extras})
        .withColumn("player_dismissed", F.when(F.col("wickets") > 0, F.col("striker")))
    )


def raw_frames(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The same deliveries in two raw dialects."""
    base = _base(spark, folder)
    return {
        "raw_cricsheet_all_ipl": _select(base, TEXT_COLUMNS),
        "raw_ipl_2025": _select(base, WIDE_COLUMNS),
    }


def users(spark: SparkSession, folder: str) -> DataFrame:
    """One row per user of ``events``; the loss streak is the longest run of errors."""
    events = table(spark, folder, "events")
    miss = F.col("event_type") != "error"
    runs = scan(
        events.select("user_id", "ts", "event_id", "event_type"),
        ["user_id"],
        ["ts", "event_id"],
        run=Since(miss, F.when(miss, 0).otherwise(1)),
    )
    streak = runs.groupBy("user_id").agg(F.max("run").alias("streak"))
    totals = events.groupBy("user_id").agg(*[F.expr(e).alias(n) for n, e in USER_AGGREGATES.items()])
    return _select(totals.join(streak, "user_id"), USER_COLUMNS)


def vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, list[str]]:
    """``embeddings`` as a player table: name, cluster and one column per dimension (64)."""
    names = [f"f{i}" for i in range(1, 65)]
    df = table(spark, folder, "embeddings").select(
        F.concat(F.lit("V"), F.col("vec_id").cast("string")).alias("player"),
        F.col("label").alias("cluster"),
        *[F.element_at("embedding", i).cast("double").alias(f"f{i}") for i in range(1, 65)],
    )
    return df, names


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    return f"{_shared(spark)}/tables-{uuid.uuid4().hex}"
