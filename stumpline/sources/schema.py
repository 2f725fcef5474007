"""Canonical delivery table and the dialects that map onto it."""

from __future__ import annotations

from pyspark.sql import types as T

INT_DEFAULT_ONE = ("innings", "over", "ball")
INT_DEFAULT_ZERO = ("runs_off_bat", "extras", "wides", "noballs", "byes", "legbyes", "runs", "wickets")

# The canonical columns, in order.
CANONICAL = (
    "match_id", "innings", "over", "ball", "batting_team", "bowling_team", "striker", "non_striker",
    "bowler", "runs_off_bat", "extras", "wides", "noballs", "byes", "legbyes", "wicket_type",
    "player_dismissed", "runs", "wickets", "venue", "date", "match_type",
)

CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField(c, T.IntegerType() if c in INT_DEFAULT_ONE + INT_DEFAULT_ZERO else T.StringType())
        for c in CANONICAL
    ]
)

# A column a dialect does not mention is taken from the raw column of the same name.
# Logical source names and where each departs from the canonical names.
#   "=x" constant x, None typed null, "runs()" off bat + extras, "wickets()" any dismissal,
#   "over()" / "ball()" the two halves of an "over.ball" text column, else a raw column name.
DIALECTS: dict[str, dict[str, str | None]] = {
    "raw_kaggle_ipl": {},
    "raw_cricsheet_ashwin": {
        "over": "over()", "ball": "ball()", "runs": "runs()", "wickets": "wickets()",
        "date": "start_date", "match_type": None,
    },
    "raw_ipl_2025": {
        "ball": None, "non_striker": None, "runs_off_bat": "runs_of_bat", "wides": "wide",
        "venue": "venue_x", "date": "date_x", "match_type": "=IPL",
    },
    "raw_cricket_dataset_downloader": {},
    "raw_cricsheet_all_ipl": {
        "over": "over()", "ball": "ball()", "runs": "runs()", "wickets": "wickets()",
        "date": "start_date", "match_type": "=IPL",
    },
}

# User table columns.
USER_REQUIRED = (
    "user_id", "age_group", "registration_date", "contests_entered_per_week",
    "avg_team_score_percentile", "winnings_last_30d", "days_since_last_login", "total_deposits",
    "win_rate", "loss_streak_length", "churned",
)
USER_TYPES = {
    "user_id": "long", "city": "string", "age_group": "string", "favourite_player": "string",
    "registration_date": "date", "contests_entered_per_week": "double",
    "avg_team_score_percentile": "double", "winnings_last_30d": "double", "total_deposits": "double",
    "total_withdrawals": "double", "win_rate": "double", "team_diversity_score": "double",
    "days_since_last_login": "int", "loss_streak_length": "int", "churned": "int",
    "partial_churn": "int", "mega_contest_ratio": "double", "session_frequency_per_week": "double",
    "captain_change_frequency": "double", "referral_activity": "double",
    "late_match_joining_pct": "double", "playoffs_engagement": "int", "ipl_only_user": "int",
}
