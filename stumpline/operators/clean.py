"""Cleaning rules for canonical deliveries, in the order they are applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stumpline.functions.exprs import flag_sum, title_case
from stumpline.functions.scan import Hot, Running, hot_groups, scan

EVENT_KEY = ("match_id", "innings", "over", "ball", "batting_team", "bowler")
CRITICAL = ("match_id", "innings", "over", "striker", "bowler")
NAME_COLUMNS = ("striker", "non_striker", "bowler", "batting_team", "bowling_team")
GAP_LIMIT = 3
MAX_WICKETS = 10
MAX_OVER = 50


def dedup_events(
    df: DataFrame,
    keys: tuple[str, ...] = EVENT_KEY,
    prefer: tuple[str, ...] = ("source_rank", "seq"),
    count_col: str | None = None,
) -> DataFrame:
    """Keep the preferred row of every key; null keys match each other.

    A minimum over (preference, whole row) combines map side, so a key with very many copies never
    meets in one sort, and equal preferences are settled by the row itself.
    """
    first = [c for c in prefer if c in df.columns]
    rest = [c for c in df.columns if c not in first and c not in keys]
    best = F.min(F.struct(*first, *rest)).alias("_best")
    aggs = [best] + ([F.count(F.lit(1)).alias(count_col)] if count_col else [])
    kept = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns]
    return kept.select(*cols, *([count_col] if count_col else []))


def over_in_range(low: int = 1, high: int = MAX_OVER) -> Column:
    return F.col("over").between(low, high)


def filter_over_range(df: DataFrame, low: int = 1, high: int = MAX_OVER) -> DataFrame:
    return df.filter(over_in_range(low, high))


def arrival_order(df: DataFrame) -> list[str]:
    """Columns that restore the order in which rows arrived."""
    placed = [c for c in ("source_rank", "seq") if c in df.columns]
    return placed or ["over", "ball", *[c for c in df.columns if c not in ("over", "ball")]]


def cap_wickets(
    df: DataFrame, limit: int = MAX_WICKETS, flag: str | None = None, hot: Hot | None = None
) -> DataFrame:
    """Zero the wicket on rows where the innings has already passed ``limit``.

    Rows without a match or innings have no running count and stay as they are.
    """
    run = scan(
        df, ["match_id", "innings"], arrival_order(df), hot, _run=Running(F.coalesce("wickets", F.lit(0)))
    )
    over = F.col("match_id").isNotNull() & F.col("innings").isNotNull() & (F.col("_run") > limit)
    out = run.withColumn("_bad", over).withColumn(
        "wickets", F.when(F.col("_bad"), 0).otherwise(F.col("wickets"))
    )
    if flag:
        out = out.withColumn(flag, F.col("_bad"))
    return out.drop("_run", "_bad")


def _expected_runs() -> Column:
    return F.coalesce("runs_off_bat", F.lit(0)) + F.coalesce("extras", F.lit(0))


def _expected_extras() -> Column:
    parts = [F.coalesce(F.col(c), F.lit(0)) for c in ("wides", "noballs", "byes", "legbyes")]
    return parts[0] + parts[1] + parts[2] + parts[3]


def runs_disagree() -> Column:
    return F.abs(F.coalesce("runs", F.lit(0)) - _expected_runs()) > GAP_LIMIT


def extras_disagree() -> Column:
    return F.abs(F.coalesce("extras", F.lit(0)) - _expected_extras()) > GAP_LIMIT


def reconcile_runs(df: DataFrame) -> DataFrame:
    return df.withColumn("runs", F.when(runs_disagree(), _expected_runs()).otherwise(F.col("runs")))


def reconcile_extras(df: DataFrame) -> DataFrame:
    return df.withColumn("extras", F.when(extras_disagree(), _expected_extras()).otherwise(F.col("extras")))


def drop_missing_critical(df: DataFrame) -> DataFrame:
    return df.dropna(subset=[c for c in CRITICAL if c in df.columns])


def fill_and_standardise_names(df: DataFrame) -> DataFrame:
    out = df.fillna({"non_striker": "unknown"}) if "non_striker" in df.columns else df
    return out.withColumns({c: title_case(F.col(c)) for c in NAME_COLUMNS if c in df.columns})


def clean_events(df: DataFrame) -> DataFrame:
    """All rules, in order."""
    # Sized before the dedup, which only removes rows, so that the check does not repeat it.
    hot = hot_groups(df, ["match_id", "innings"])
    out = filter_over_range(dedup_events(df))
    out = reconcile_extras(reconcile_runs(cap_wickets(out, hot=hot)))
    return fill_and_standardise_names(drop_missing_critical(out))


def cleaning_audit(df: DataFrame) -> DataFrame:
    """One row with the effect of every rule, from a single pass over the flagged rows."""
    kept = dedup_events(df, count_col="_copies")
    ranged = kept.withColumn("_bad_over", F.coalesce(~over_in_range(), F.lit(True)))
    # Rows outside the over range must not add to the running wickets.
    safe = ranged.withColumn("wickets", F.when(F.col("_bad_over"), 0).otherwise(F.col("wickets")))
    flagged = cap_wickets(safe, flag="_bad_wicket", hot=hot_groups(df, ["match_id", "innings"]))
    valid = ~F.col("_bad_over")
    missing = F.lit(False)
    for c in CRITICAL:
        missing = missing | F.col(c).isNull()
    row = flagged.withColumns({"_bad_runs": runs_disagree(), "_bad_extras": extras_disagree()}).agg(
        F.sum("_copies").alias("rows_before"),
        flag_sum(valid & ~missing).alias("rows_after"),
        F.sum(F.col("_copies") - 1).alias("duplicates_removed"),
        flag_sum(F.col("_bad_over")).alias("overs_out_of_range"),
        flag_sum(valid & F.col("_bad_wicket")).alias("wickets_capped"),
        flag_sum(valid & F.col("_bad_runs")).alias("runs_fixed"),
        flag_sum(valid & F.col("_bad_extras")).alias("extras_fixed"),
        flag_sum(valid & missing).alias("missing_critical"),
    )

    def part(text: str, col: str) -> Column:
        return F.when(F.col(col) > 0, F.concat(F.lit(text), F.col(col).cast("string")))

    rows = F.concat(
        F.lit("rows "), F.col("rows_before").cast("string"), F.lit(" -> "), F.col("rows_after").cast("string")
    )
    return row.withColumn(
        "summary",
        F.concat_ws(
            "; ",
            rows,
            part("duplicates ", "duplicates_removed"),
            part("overs out of range ", "overs_out_of_range"),
            part("wickets capped ", "wickets_capped"),
            part("missing critical ", "missing_critical"),
            part("runs fixed ", "runs_fixed"),
            part("extras fixed ", "extras_fixed"),
        ),
    )


def validate_events(df: DataFrame) -> DataFrame:
    """Per innings: balls past the sixth, wickets past ten, odd innings count, runs above the match."""
    per = df.groupBy("match_id", "innings").agg(
        flag_sum(F.col("ball") > 6).alias("balls_past_six"),
        F.sum("wickets").alias("wickets"),
        F.sum("runs").alias("runs"),
    )
    match = per.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("innings_count"), F.sum("runs").alias("match_runs")
    )
    return per.join(match, "match_id").select(
        "match_id",
        "innings",
        "balls_past_six",
        "wickets",
        "runs",
        (F.col("wickets") > MAX_WICKETS).alias("too_many_wickets"),
        (F.col("innings_count") != 2).alias("odd_innings_count"),
        (F.col("runs") > F.col("match_runs")).alias("runs_above_match"),
    )
