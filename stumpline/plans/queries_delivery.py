"""Queries on sources, harmonising, cleaning, state and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.functions.scan import Hot, hot_groups
from stumpline.operators import aggregates as agg
from stumpline.operators import clean, state
from stumpline.plans import bridge
from stumpline.plans.registry import cte, query
from stumpline.sources import harmonize as hz
from stumpline.sources import readers, store
from stumpline.sources.schema import CANONICAL

# --- harmonise ------------------------------------------------------------------------------------

CANON = (
    "match_id:s innings:i over:i ball:i batting_team:s bowling_team:s striker:s non_striker:s bowler:s "
    "runs_off_bat:i extras:i wides:i noballs:i byes:i legbyes:i wicket_type:s player_dismissed:s runs:i "
    "wickets:i venue:s date:s match_type:s seq:l"
)
cte("htext", "rawtext", """
SELECT match_id, COALESCE(TRY_CAST(innings AS INTEGER), 1) AS innings,
  CAST(split_part(ball, '.', 1) AS INTEGER) + 1 AS over_no, CAST(split_part(ball, '.', 2) AS INTEGER) AS ball,
  batting_team, bowling_team, striker, non_striker, bowler,
  COALESCE(TRY_CAST(runs_off_bat AS INTEGER), 0) AS runs_off_bat, COALESCE(TRY_CAST(extras AS INTEGER), 0) AS extras,
  COALESCE(TRY_CAST(wides AS INTEGER), 0) AS wides, COALESCE(TRY_CAST(noballs AS INTEGER), 0) AS noballs,
  COALESCE(TRY_CAST(byes AS INTEGER), 0) AS byes, COALESCE(TRY_CAST(legbyes AS INTEGER), 0) AS legbyes,
  wicket_type, player_dismissed,
  COALESCE(TRY_CAST(runs_off_bat AS INTEGER), 0) + COALESCE(TRY_CAST(extras AS INTEGER), 0) AS runs,
  CASE WHEN wicket_type IS NOT NULL AND wicket_type <> '' THEN 1 ELSE 0 END AS wickets,
  venue, start_date AS date, 'IPL' AS match_type, seq, 'raw_cricsheet_all_ipl' AS _source, 0 AS source_rank FROM rawtext""")
cte("hwide", "rawwide", """
SELECT match_id, innings, over_no, 1 AS ball, batting_team, bowling_team, striker, CAST(NULL AS VARCHAR) AS non_striker,
  bowler, runs_of_bat AS runs_off_bat, extras, wide AS wides, noballs, byes, legbyes, wicket_type, player_dismissed,
  runs, wickets, venue_x AS venue, date_x AS date, 'IPL' AS match_type, seq, 'raw_ipl_2025' AS _source, 1 AS source_rank FROM rawwide""")
cte("h", "htext hwide", "SELECT * FROM htext UNION ALL SELECT * FROM hwide")


def merged(spark: SparkSession, folder: str) -> DataFrame:
    return hz.merge_sources(bridge.raw_frames(spark, folder))


@query("harmonize_text_dialect", CANON, "SELECT * FROM htext", "htext")
def _(spark, folder):
    return hz.harmonize(bridge.raw_frames(spark, folder)["raw_cricsheet_all_ipl"], "raw_cricsheet_all_ipl")


@query("harmonize_wide_dialect", CANON, "SELECT * FROM hwide", "hwide")
def _(spark, folder):
    return hz.harmonize(bridge.raw_frames(spark, folder)["raw_ipl_2025"], "raw_ipl_2025")


def _rules(spark, folder, **rules):
    raw = bridge.raw_frames(spark, folder)["raw_cricsheet_all_ipl"]
    return raw.select("seq", *[hz.rule_column(raw, r).alias(n) for n, r in rules.items()])


@query("rule_rename", "seq:l date:s", "SELECT seq, start_date AS date FROM rawtext", "rawtext")
def _(spark, folder):
    return _rules(spark, folder, date="start_date")


@query("rule_constant", "seq:l match_type:s", "SELECT seq, 'IPL' AS match_type FROM rawtext", "rawtext")
def _(spark, folder):
    return _rules(spark, folder, match_type="=IPL")


@query(
    "rule_missing", "seq:l no_rule:s absent:s",
    "SELECT seq, CAST(NULL AS VARCHAR) AS no_rule, CAST(NULL AS VARCHAR) AS absent FROM rawtext", "rawtext",
)
def _(spark, folder):
    return _rules(spark, folder, no_rule=None, absent="no_such_column")


@query("rule_computed_runs", "seq:l runs:i", "SELECT seq, runs FROM htext", "htext")
def _(spark, folder):
    return _rules(spark, folder, runs="runs()")


@query("rule_computed_wickets", "seq:l wickets:i", "SELECT seq, wickets FROM htext", "htext")
def _(spark, folder):
    return _rules(spark, folder, wickets="wickets()")


@query(
    "rule_parsed_over_ball", "seq:l over:i raw_over:i ball:i",
    "SELECT seq, over_no, over_no - 1 AS raw_over, ball FROM htext", "htext",
)
def _(spark, folder):
    raw = bridge.raw_frames(spark, folder)["raw_cricsheet_all_ipl"]
    return raw.select(
        "seq",
        hz.rule_column(raw, "over()").alias("over"),
        hz.rule_column(raw, "over()", shift_overs=False).alias("raw_over"),
        hz.rule_column(raw, "ball()").alias("ball"),
    )


@query(
    "numeric_coercion", "seq:l innings:i runs_off_bat:i wides:i",
    "SELECT seq, innings, runs_off_bat, wides FROM htext", "htext",
)
def _(spark, folder):
    return hz.harmonize(bridge.raw_frames(spark, folder)["raw_cricsheet_all_ipl"], "raw_cricsheet_all_ipl")


_NULLS = " + ".join(f"CASE WHEN {'over_no' if c == 'over' else c} IS NULL THEN 1 ELSE 0 END" for c in CANONICAL)


@query(
    "harmonize_report", "source:s rows:l absent_columns:l absent_names:s null_cells:l",
    f"SELECT _source AS source, COUNT(*) AS rows, CASE WHEN _source = 'raw_ipl_2025' THEN 2 ELSE 0 END AS absent_columns, "
    f"CASE WHEN _source = 'raw_ipl_2025' THEN 'ball,non_striker' ELSE '' END AS absent_names, "
    f"SUM({_NULLS}) AS null_cells FROM h GROUP BY _source",
    "h",
)
def _(spark, folder):
    return hz.harmonize_report(bridge.raw_frames(spark, folder))


@query("merge_sources", CANON + " _source:s", "SELECT * FROM h", "h")
def _(spark, folder):
    return merged(spark, folder)


STANDARD = (
    "match_id:s innings:i over:i ball_in_over:i batter:s bowler:s runs:i is_wide:i is_noball:i is_wicket:i "
    "match_type:s city:s teams:s target:s start_date:s venue:s"
)
cte("std", "rawtext rawwide", """
SELECT match_id, CAST(innings AS INTEGER) AS innings, CAST(split_part(ball, '.', 1) AS INTEGER) AS over_no,
  CAST(split_part(ball, '.', 2) AS INTEGER) AS ball_in_over, striker AS batter, bowler,
  COALESCE(TRY_CAST(runs_off_bat AS INTEGER), 0) AS runs, CASE WHEN COALESCE(TRY_CAST(wides AS INTEGER), 0) > 0 THEN 1 ELSE 0 END AS is_wide,
  CASE WHEN COALESCE(TRY_CAST(noballs AS INTEGER), 0) > 0 THEN 1 ELSE 0 END AS is_noball,
  CASE WHEN wicket_type IS NOT NULL THEN 1 ELSE 0 END AS is_wicket, 'T20' AS match_type, '' AS city,
  CONCAT('[', batting_team, ', ', bowling_team, ']') AS teams, '' AS target, start_date, venue, batting_team FROM rawtext
UNION ALL
SELECT match_id, innings, over_no, 1, striker, bowler, runs_of_bat, CASE WHEN wide > 0 THEN 1 ELSE 0 END, noballs,
  CASE WHEN wicket_type IS NOT NULL THEN 1 ELSE 0 END, 'IPL', '', CONCAT('[', team1, ', ', team2, ']'), '0', date_x, venue_x,
  batting_team FROM rawwide""")


def standard_frames(spark, folder):
    raw = bridge.raw_frames(spark, folder)
    return {"ashwin": raw["raw_cricsheet_all_ipl"], "ipl_2025": raw["raw_ipl_2025"]}


@query("load_all_matches", STANDARD, "SELECT * FROM std", "std")
def _(spark, folder):
    return hz.load_all_matches(standard_frames(spark, folder))


@query(
    "standardise_loader", STANDARD.replace(" target:s", ""),
    "SELECT * FROM std WHERE match_type = 'T20'", "std",
)
def _(spark, folder):
    return hz.standardise(standard_frames(spark, folder)["ashwin"], "ashwin")


@query(
    "standardise_kaggle_enriched", "source:s match_id:s over:i ball_in_over:i batter:s runs:i is_wide:i is_noball:i is_wicket:i match_type:s city:s teams:s",
    """SELECT s.source, match_id, over_no, ball AS ball_in_over, striker AS batter, runs_off_bat AS runs, CASE WHEN wides > 0 THEN 1 ELSE 0 END AS is_wide,
       CASE WHEN noballs > 0 THEN 1 ELSE 0 END AS is_noball, wickets AS is_wicket, match_type, city,
       CONCAT('[', batting_team, ', ', bowling_team, ']') AS teams FROM d, (SELECT unnest(['enriched', 'kaggle']) AS source) s""",
    "d",
)
def _(spark, folder):
    base = bridge.deliveries(spark, folder).withColumns(
        {"team1": F.col("batting_team"), "team2": F.col("bowling_team")}
    )
    parts = [
        hz.standardise(base.drop("runs"), n).withColumn("source", F.lit(n)) for n in ("enriched", "kaggle")
    ]
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


# --- sources and store ----------------------------------------------------------------------------


def _written(spark, folder):
    """The raw dialects as CSV in the shared folder."""
    out = bridge.shared_folder(spark)
    for name, df in bridge.raw_frames(spark, folder).items():
        df.withColumnRenamed("seq", "line").write.csv(readers.source_path(out, name), header=True)
    return out


SOURCE_COUNTS = "source:s rows:l matches:l off_bat:l"


@query(
    "read_source_csv", "line:l match_id:s ball:s bowler:s runs_off_bat:s wides:s",
    "SELECT seq AS line, match_id, ball, bowler, runs_off_bat, wides FROM rawtext", "rawtext",
)
def _(spark, folder):
    return readers.read_source(spark, "raw_cricsheet_all_ipl", _written(spark, folder))


@query(
    "read_all_sources_csv", SOURCE_COUNTS,
    "SELECT _source AS source, COUNT(*) AS rows, COUNT(DISTINCT match_id) AS matches, SUM(runs_off_bat) AS off_bat FROM h GROUP BY _source",
    "h",
)
def _(spark, folder):
    both = hz.merge_sources(readers.read_all_sources(spark, _written(spark, folder)))
    return both.groupBy(F.col("_source").alias("source")).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("match_id").alias("matches"), F.sum("runs_off_bat").alias("off_bat")
    )


@query(
    "read_users_csv", "user_id:l age_group:s total_deposits:d days_since_last_login:i churned:i",
    "SELECT * FROM u ORDER BY user_id LIMIT 100", "u",
)
def _(spark, folder):
    path = f"{bridge.shared_folder(spark)}/users.csv"
    bridge.users(spark, folder).write.csv(path, header=True)
    return readers.read_users(spark, path, 100)


def _store(spark, folder):
    out = bridge.shared_folder(spark)
    store.build_feature_store(spark, out, frames=bridge.raw_frames(spark, folder))
    return out


_COUNTS = {
    "full_canonical": "COUNT(*)", "match_state": "COUNT(*)", "over_level": "COUNT(DISTINCT (match_id, innings, batting_team, over_no))",
    "player_level": "COUNT(DISTINCT striker)", "match_level": "COUNT(DISTINCT (match_id, innings))",
}


@query(
    "build_feature_store", "table:s present:b rows:l all_ready:b",
    " UNION ALL ".join(f"SELECT '{k}' AS \"table\", TRUE AS present, {v} AS rows, TRUE AS all_ready FROM cleaned" for k, v in _COUNTS.items()),
    "cleaned",
)
def _(spark, folder):
    return store.store_inventory(spark, _store(spark, folder))


@query(
    "store_inventory", "table:s present:b rows:l filled:b all_ready:b",
    " UNION ALL ".join(f"SELECT '{k}' AS \"table\", TRUE AS present, {v} AS rows, TRUE AS filled, TRUE AS all_ready FROM cleaned" for k, v in _COUNTS.items()),
    "cleaned",
)
def _(spark, folder):
    return store.store_inventory(spark, _store(spark, folder)).withColumn("filled", F.col("bytes") > 0)


@query(
    "load_feature_store", "match_id:s innings:i total_runs:l total_wickets:l total_balls:l",
    "SELECT match_id, innings, SUM(runs) AS total_runs, SUM(wickets) AS total_wickets, COUNT(*) AS total_balls FROM cleaned GROUP BY match_id, innings",
    "cleaned",
)
def _(spark, folder):
    return store.load_feature_store(spark, _store(spark, folder), "match_level")


# --- clean ----------------------------------------------------------------------------------------

_KEYS = "match_id, innings, over_no, ball, batting_team, bowler"


def _title(col: str) -> str:
    return (
        f"array_to_string(list_transform(range(1, length(trim({col})) + 1), lambda i: CASE WHEN i = 1 OR NOT "
        f"regexp_matches(substr(trim({col}), CAST(i - 1 AS BIGINT), 1), '[A-Za-z]') THEN upper(substr(trim({col}), CAST(i AS BIGINT), 1)) "
        f"ELSE lower(substr(trim({col}), CAST(i AS BIGINT), 1)) END), '')"
    )


_NON_STRIKER = "COALESCE(non_striker, 'unknown')"
cte("dd", "h", f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {_KEYS} ORDER BY source_rank, seq) AS rn, COUNT(*) OVER (PARTITION BY {_KEYS}) AS copies FROM h) WHERE rn = 1")
cte("ranged", "dd", "SELECT * FROM dd WHERE over_no BETWEEN 1 AND 50")
cte("capped", "ranged", """
SELECT * EXCLUDE (wickets), CASE WHEN bad_wicket THEN 0 ELSE wickets END AS wickets FROM (
  SELECT *, SUM(wickets) OVER (PARTITION BY match_id, innings ORDER BY source_rank, seq ROWS UNBOUNDED PRECEDING) > 10 AS bad_wicket FROM ranged)""")
cte("mended", "capped", """
SELECT * EXCLUDE (runs, extras), CASE WHEN bad_runs THEN runs_off_bat + extras ELSE runs END AS runs,
  CASE WHEN bad_extras THEN wides + noballs + byes + legbyes ELSE extras END AS extras FROM (
  SELECT *, ABS(runs - (runs_off_bat + extras)) > 3 AS bad_runs, ABS(extras - (wides + noballs + byes + legbyes)) > 3 AS bad_extras FROM capped)""")
cte("whole", "mended", "SELECT * FROM mended WHERE match_id IS NOT NULL AND innings IS NOT NULL AND over_no IS NOT NULL AND striker IS NOT NULL AND bowler IS NOT NULL")
cte("cleaned", "whole", f"""SELECT * EXCLUDE (striker, non_striker, bowler, batting_team, bowling_team),
  {_title('striker')} AS striker, {_title(_NON_STRIKER)} AS non_striker, {_title('bowler')} AS bowler,
  {_title('batting_team')} AS batting_team, {_title('bowling_team')} AS bowling_team FROM whole""")


@query("dedup_events", CANON, "SELECT * FROM dd", "dd")
def _(spark, folder):
    return clean.dedup_events(merged(spark, folder))


@query(
    "dedup_lineitem", "l_orderkey:l l_linenumber:i l_partkey:l l_suppkey:l l_quantity:d l_extendedprice:d l_shipdate:s copies:l",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, copies FROM (
       SELECT *, COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies, ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(spark, folder):
    kept = clean.dedup_events(bridge.table(spark, folder, "lineitem"), keys=("l_orderkey", "l_linenumber"), count_col="copies")
    return kept.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("filter_over_range", CANON, "SELECT * FROM h WHERE over_no BETWEEN 1 AND 50", "h")
def _(spark, folder):
    return clean.filter_over_range(merged(spark, folder))


@query("cap_wickets", "match_id:s innings:i seq:l source_rank:i wickets:i bad_wicket:b", "SELECT * FROM capped", "capped")
def _(spark, folder):
    return clean.cap_wickets(
        clean.filter_over_range(clean.dedup_events(merged(spark, folder))), flag="bad_wicket"
    )


@query(
    "reconcile_runs", "seq:l source_rank:i runs:i",
    "SELECT seq, source_rank, CASE WHEN ABS(runs - (runs_off_bat + extras)) > 3 THEN runs_off_bat + extras ELSE runs END AS runs FROM h", "h",
)
def _(spark, folder):
    return clean.reconcile_runs(merged(spark, folder))


@query(
    "reconcile_extras", "seq:l source_rank:i extras:i",
    "SELECT seq, source_rank, CASE WHEN ABS(extras - (wides + noballs + byes + legbyes)) > 3 THEN wides + noballs + byes + legbyes ELSE extras END AS extras FROM h", "h",
)
def _(spark, folder):
    return clean.reconcile_extras(merged(spark, folder))


@query(
    "drop_missing_critical", "seq:l source_rank:i",
    "SELECT seq, source_rank FROM h WHERE match_id IS NOT NULL AND striker IS NOT NULL AND bowler IS NOT NULL", "h",
)
def _(spark, folder):
    return clean.drop_missing_critical(merged(spark, folder))


@query(
    "standardise_names", "seq:l source_rank:i striker:s non_striker:s bowler:s batting_team:s bowling_team:s",
    f"SELECT seq, source_rank, {_title('striker')} AS striker, {_title(_NON_STRIKER)} AS non_striker, "
    f"{_title('bowler')} AS bowler, {_title('batting_team')} AS batting_team, {_title('bowling_team')} AS bowling_team FROM h", "h",
)
def _(spark, folder):
    return clean.fill_and_standardise_names(merged(spark, folder))


@query("clean_events", CANON + " _source:s", "SELECT * FROM cleaned", "cleaned")
def _(spark, folder):
    return clean.clean_events(merged(spark, folder))


_AUDIT = "rows_before:l rows_after:l duplicates_removed:l overs_out_of_range:l wickets_capped:l runs_fixed:l extras_fixed:l missing_critical:l"


def _part(label: str, col: str) -> str:
    return f"CASE WHEN {col} > 0 THEN '{label} ' || CAST({col} AS VARCHAR) END"


@query(
    "cleaning_audit", _AUDIT + " summary:s",
    f"""SELECT *, concat_ws('; ', 'rows ' || CAST(rows_before AS VARCHAR) || ' -> ' || CAST(rows_after AS VARCHAR),
      {_part('duplicates', 'duplicates_removed')}, {_part('overs out of range', 'overs_out_of_range')},
      {_part('wickets capped', 'wickets_capped')}, {_part('missing critical', 'missing_critical')},
      {_part('runs fixed', 'runs_fixed')}, {_part('extras fixed', 'extras_fixed')}) AS summary FROM (
    SELECT (SELECT COUNT(*) FROM h) AS rows_before, (SELECT COUNT(*) FROM whole) AS rows_after,
      (SELECT COUNT(*) FROM h) - (SELECT COUNT(*) FROM dd) AS duplicates_removed,
      (SELECT COUNT(*) FROM dd) - (SELECT COUNT(*) FROM ranged) AS overs_out_of_range,
      (SELECT COUNT(*) FROM capped WHERE bad_wicket) AS wickets_capped,
      (SELECT COUNT(*) FROM mended WHERE bad_runs) AS runs_fixed, (SELECT COUNT(*) FROM mended WHERE bad_extras) AS extras_fixed,
      (SELECT COUNT(*) FROM mended) - (SELECT COUNT(*) FROM whole) AS missing_critical)""",
    "whole",
)
def _(spark, folder):
    return clean.cleaning_audit(merged(spark, folder))


@query(
    "validate_events", "match_id:s innings:i balls_past_six:l wickets:l runs:l too_many_wickets:b odd_innings_count:b runs_above_match:b",
    """SELECT p.*, wickets > 10 AS too_many_wickets, n <> 2 AS odd_innings_count, runs > total AS runs_above_match FROM (
       SELECT match_id, innings, SUM(CASE WHEN ball > 6 THEN 1 ELSE 0 END) AS balls_past_six, SUM(wickets) AS wickets, SUM(runs) AS runs FROM d GROUP BY match_id, innings) p
       JOIN (SELECT match_id, COUNT(DISTINCT innings) AS n, SUM(runs) AS total FROM d GROUP BY match_id) m USING (match_id)""",
    "d",
)
def _(spark, folder):
    return clean.validate_events(bridge.deliveries(spark, folder))


# --- state ----------------------------------------------------------------------------------------

cte("st0", "d", """
SELECT *, SUM(runs) OVER w AS total_runs, SUM(wickets) OVER w AS total_wickets, ROW_NUMBER() OVER w AS ball_number,
  COUNT(*) OVER p AS n_balls, SUM(wickets) OVER p AS inn_wickets, CAST(SUM(bnd) OVER p AS DOUBLE) / COUNT(*) OVER p AS boundary_rate,
  CAST(SUM(dot) OVER p AS DOUBLE) / COUNT(*) OVER p AS dot_ball_pressure,
  CAST(SUM(bnd) OVER w AS DOUBLE) / ROW_NUMBER() OVER w AS boundary_rate_causal, CAST(SUM(dot) OVER w AS DOUBLE) / ROW_NUMBER() OVER w AS dot_rate_causal,
  SUM(runs) OVER r12 AS recent_12_ball_runs, SUM(wickets) OVER r12 AS recent_12_ball_wickets,
  SUM(runs) OVER r6 AS runs6, SUM(wickets) OVER r6 AS wickets6, SUM(bnd) OVER r18 AS fours18
FROM d WINDOW w AS (PARTITION BY match_id, innings ORDER BY over_no, ball, seq ROWS UNBOUNDED PRECEDING),
  p AS (PARTITION BY match_id, innings),
  r12 AS (PARTITION BY match_id, innings ORDER BY over_no, ball, seq ROWS 11 PRECEDING),
  r6 AS (PARTITION BY match_id, innings ORDER BY over_no, ball, seq ROWS 5 PRECEDING),
  r18 AS (PARTITION BY match_id, innings ORDER BY over_no, ball, seq ROWS 17 PRECEDING)""")
cte("st1", "st0 d", """
SELECT st0.*, 10 - total_wickets AS wickets_in_hand, n_balls - ball_number AS balls_remaining,
  CASE WHEN over_no <= 6 THEN 'powerplay' WHEN over_no <= 15 THEN 'middle' WHEN innings = 1 THEN 'death' ELSE 'chase_death' END AS phase_of_play,
  CAST(total_runs AS DOUBLE) / GREATEST(ball_number / 6.0::DOUBLE, 0.1::DOUBLE) AS current_run_rate,
  COALESCE(t.total, 0) + 1 AS target,
  SUM(runs) OVER pw AS partnership_runs, COUNT(*) OVER pw AS partnership_balls
FROM st0 LEFT JOIN (SELECT match_id, SUM(runs) AS total FROM d WHERE innings = 1 GROUP BY match_id) t USING (match_id)
WINDOW pw AS (PARTITION BY match_id, innings, total_wickets ORDER BY over_no, ball, seq ROWS UNBOUNDED PRECEDING)""")
cte("st2", "st1", """SELECT *, CASE WHEN innings = 2 AND balls_remaining > 0 THEN GREATEST(target - total_runs, 0) / (balls_remaining / 6.0::DOUBLE) END AS required_run_rate FROM st1""")
cte("st", "st2", """
SELECT *, CASE WHEN innings = 2 THEN LEAST(GREATEST(COALESCE(required_run_rate, 0) / 15 * 0.5 + total_wickets / 10.0::DOUBLE * 0.3 + CASE WHEN over_no >= 16 THEN 0.2 ELSE 0 END, 0), 1) ELSE 0 END AS pressure_index,
  LEAST(GREATEST((current_run_rate - COALESCE(required_run_rate, 0)) * (wickets_in_hand / 10.0::DOUBLE), -10), 10) AS momentum_score,
  boundary_rate * 2 + current_run_rate / 6 AS batting_aggression_index,
  CASE WHEN innings = 1 THEN inn_wickets / 10.0::DOUBLE ELSE total_wickets / 10.0::DOUBLE + COALESCE(required_run_rate, 0) / 15 END AS bowling_pressure_index,
  CASE WHEN innings <> 2 THEN 0.5 WHEN balls_remaining <= 0 OR COALESCE(required_run_rate, 0) <= 0 THEN CASE WHEN total_runs >= target THEN 1 ELSE 0 END
    ELSE LEAST(GREATEST(0, 1 - required_run_rate / 12) * 0.5 + wickets_in_hand / 10.0::DOUBLE * 0.3 + LEAST(balls_remaining / 72.0::DOUBLE, 1) * 0.2, 1) END AS chase_win_probability_proxy
FROM st2""")


def big_innings(spark: SparkSession, folder: str) -> Hot:
    """Oversized innings of the feed, found once and passed to the operators that need them."""
    return hot_groups(bridge.deliveries(spark, folder), state.INNINGS)


def states(spark: SparkSession, folder: str) -> DataFrame:
    return state.event_state(bridge.deliveries(spark, folder), keep_working=True)


def _state_query(name: str, spec: str) -> None:
    query(name, "match_id:s innings:i over:i ball:i seq:l " + spec, "SELECT * FROM st", "st")(states)


_state_query("state_running_totals", "total_runs:l total_wickets:l")
_state_query("state_wickets_in_hand", "wickets_in_hand:l")
_state_query("state_balls_remaining", "ball_number:l balls_remaining:l")
_state_query("state_phase_of_play", "phase_of_play:s")
_state_query("state_current_run_rate", "current_run_rate:d")
_state_query("state_target", "target:l")
_state_query("state_required_run_rate", "required_run_rate:d")
_state_query("state_pressure_index", "pressure_index:d")
_state_query("state_momentum_score", "momentum_score:d")
_state_query("state_partnership", "partnership_runs:l partnership_balls:l")
_state_query("state_boundary_rate", "boundary_rate:d")
_state_query("state_dot_ball_pressure", "dot_ball_pressure:d")
_state_query("state_batting_aggression", "batting_aggression_index:d")
_state_query("state_bowling_pressure", "bowling_pressure_index:d")
_state_query("state_recent_balls", "recent_12_ball_runs:l recent_12_ball_wickets:l")
_state_query("state_win_probability", "chase_win_probability_proxy:d")
_state_query(
    "event_state",
    "striker:s bowler:s runs:i wickets:i total_runs:l total_wickets:l wickets_in_hand:l balls_remaining:l phase_of_play:s "
    "current_run_rate:d required_run_rate:d pressure_index:d momentum_score:d partnership_runs:l partnership_balls:l "
    "boundary_rate:d dot_ball_pressure:d batting_aggression_index:d bowling_pressure_index:d recent_12_ball_runs:l "
    "recent_12_ball_wickets:l chase_win_probability_proxy:d",
)


@query(
    "event_state_causal", "match_id:s innings:i seq:l boundary_rate:d dot_ball_pressure:d batting_aggression_index:d bowling_pressure_index:d",
    """SELECT match_id, innings, seq, boundary_rate_causal AS boundary_rate, dot_rate_causal AS dot_ball_pressure,
       boundary_rate_causal * 2 + current_run_rate / 6 AS batting_aggression_index,
       total_wickets / 10.0::DOUBLE + CASE WHEN innings = 1 THEN 0 ELSE COALESCE(required_run_rate, 0) / 15 END AS bowling_pressure_index FROM st""",
    "st",
)
def _(spark, folder):
    return state.event_state(bridge.deliveries(spark, folder), leakage="causal")


# --- aggregates -----------------------------------------------------------------------------------

cte("ov0", "d", """
SELECT match_id, innings, batting_team, over_no, SUM(runs) AS runs_scored, SUM(wickets) AS wickets, SUM(bnd) AS boundaries,
  SUM(CASE WHEN runs_off_bat >= 6 AND wides = 0 THEN 1 ELSE 0 END) AS sixes, SUM(dot) AS dot_balls, SUM(legal) AS total_balls,
  SUM(extras) AS extras, SUM(wides) AS wides, SUM(noballs) AS noballs, MIN(season) AS season FROM d GROUP BY match_id, innings, batting_team, over_no""")
cte("ov", "ov0", """
SELECT *, SUM(runs_scored) OVER w AS cumulative_score, SUM(wickets) OVER w AS cumulative_wickets FROM ov0
WINDOW w AS (PARTITION BY match_id, innings ORDER BY batting_team, over_no ROWS UNBOUNDED PRECEDING)""")
OVER_KEY = "match_id:s innings:i batting_team:s over:i "


def overs(spark: SparkSession, folder: str) -> DataFrame:
    return agg.over_level(bridge.deliveries(spark, folder))


query(
    "over_level",
    OVER_KEY + "runs_scored:l wickets:l boundaries:l sixes:l dot_balls:l total_balls:l extras:l wides:l noballs:l cumulative_score:l cumulative_wickets:l",
    "SELECT * FROM ov", "ov",
)(overs)
query("over_running_score", OVER_KEY + "cumulative_score:l cumulative_wickets:l", "SELECT * FROM ov", "ov")(overs)


@query(
    "player_level", "player:s matches:l innings:l total_runs:l balls_faced:l boundaries:l sixes:l dot_balls:l dismissals:l strike_rate:d average:d boundary_pct:d dot_ball_pct:d",
    """SELECT *, CAST(total_runs AS DOUBLE) / GREATEST(balls_faced, 1) * 100 AS strike_rate, CAST(total_runs AS DOUBLE) / GREATEST(dismissals, 1) AS average,
       CAST(boundaries AS DOUBLE) / GREATEST(balls_faced, 1) AS boundary_pct, CAST(dot_balls AS DOUBLE) / GREATEST(balls_faced, 1) AS dot_ball_pct FROM (
       SELECT striker AS player, COUNT(DISTINCT match_id) AS matches, COUNT(DISTINCT innings) AS innings, SUM(runs_off_bat) AS total_runs, SUM(legal) AS balls_faced,
         SUM(bnd) AS boundaries, SUM(CASE WHEN runs_off_bat >= 6 AND wides = 0 THEN 1 ELSE 0 END) AS sixes, SUM(dot) AS dot_balls, SUM(wickets) AS dismissals FROM d GROUP BY striker)""",
    "d",
)
def _(spark, folder):
    return agg.player_level(bridge.deliveries(spark, folder))


@query(
    "match_level", "match_id:s innings:i total_runs:l total_wickets:l total_balls:l boundaries:l sixes:l venue:s date:s match_type:s",
    """SELECT match_id, innings, SUM(runs) AS total_runs, SUM(wickets) AS total_wickets, COUNT(*) AS total_balls, SUM(CASE WHEN runs_off_bat >= 4 THEN 1 ELSE 0 END) AS boundaries,
       SUM(CASE WHEN runs_off_bat >= 6 THEN 1 ELSE 0 END) AS sixes, FIRST(venue ORDER BY over_no, ball, seq) AS venue, FIRST(date ORDER BY over_no, ball, seq) AS date,
       FIRST(match_type ORDER BY over_no, ball, seq) AS match_type FROM d GROUP BY match_id, innings""",
    "d",
)
def _(spark, folder):
    return agg.match_level(bridge.deliveries(spark, folder))


LEGACY = OVER_KEY + "runs_scored:l wickets:l boundaries:l sixes:l dot_balls:l total_balls:l cumulative_score:l cumulative_wickets:l"
cte("lg", "d", """
SELECT match_id, innings, batting_team, over_no, striker AS batter, bowler, runs_off_bat AS runs, CASE WHEN wides > 0 THEN 1 ELSE 0 END AS is_wide,
  CASE WHEN noballs > 0 THEN 1 ELSE 0 END AS is_noball, wickets AS is_wicket, legal, city, season, seq, ball FROM d""")
cte("lo0", "lg", """
SELECT match_id, innings, batting_team, over_no, SUM(runs) AS runs_scored, SUM(is_wicket) AS wickets, SUM(CASE WHEN runs >= 4 AND is_wide = 0 THEN 1 ELSE 0 END) AS boundaries,
  SUM(CASE WHEN runs >= 6 AND is_wide = 0 THEN 1 ELSE 0 END) AS sixes, SUM(CASE WHEN runs = 0 THEN legal ELSE 0 END) AS dot_balls, SUM(legal) AS total_balls FROM lg
GROUP BY match_id, innings, batting_team, over_no""")
cte("lo", "lo0", """
SELECT *, SUM(runs_scored) OVER w AS cumulative_score, SUM(wickets) OVER w AS cumulative_wickets FROM lo0
WINDOW w AS (PARTITION BY match_id, innings ORDER BY batting_team, over_no ROWS UNBOUNDED PRECEDING)""")
cte("cx0", "lo", """
SELECT o.*, COALESCE(t.total, 0) + 1 AS target, 20 - over_no AS overs_remaining, CASE WHEN over_no > 0 THEN CAST(cumulative_score AS DOUBLE) / over_no END AS current_run_rate,
  cumulative_wickets AS wickets_fallen, CASE WHEN innings = 2 THEN COALESCE(t.total, 0) + 1 - cumulative_score END AS runs_needed
FROM lo o LEFT JOIN (SELECT match_id, SUM(runs_scored) AS total FROM lo WHERE innings = 1 GROUP BY match_id) t USING (match_id)""")
cte("cx1", "cx0", "SELECT *, CASE WHEN overs_remaining > 0 THEN CAST(runs_needed AS DOUBLE) / overs_remaining END AS required_run_rate FROM cx0")
cte("cx", "cx1", """
SELECT *, COALESCE(innings = 2 AND overs_remaining <= 4 AND required_run_rate > 10, FALSE) AS death_overs_chase, over_no <= 15 AND wickets_fallen >= 6 AS early_collapse,
  COALESCE(innings = 2 AND runs_needed > 0 AND runs_needed <= 10 AND wickets_fallen >= 8, FALSE) AS tight_finish,
  COALESCE(innings = 2 AND overs_remaining <= 4 AND required_run_rate > 10, FALSE) OR (over_no <= 15 AND wickets_fallen >= 6)
    OR COALESCE(innings = 2 AND runs_needed > 0 AND runs_needed <= 10 AND wickets_fallen >= 8, FALSE) AS pressure_ball FROM cx1""")


def legacy(spark: SparkSession, folder: str) -> DataFrame:
    """Deliveries in the second internal schema."""
    d = bridge.deliveries(spark, folder)
    return d.select(
        "match_id", "innings", "batting_team", "over", "ball", "bowler", "city", "season", "seq",
        F.col("striker").alias("batter"),
        F.col("runs_off_bat").alias("runs"),
        (F.col("wides") > 0).cast("int").alias("is_wide"),
        (F.col("noballs") > 0).cast("int").alias("is_noball"),
        F.col("wickets").alias("is_wicket"),
    )


def context(spark: SparkSession, folder: str) -> DataFrame:
    return agg.match_context(agg.over_stats_legacy(legacy(spark, folder)))


@query("over_stats_legacy", LEGACY, "SELECT * FROM lo", "lo")
def _(spark, folder):
    return agg.over_stats_legacy(legacy(spark, folder))


query(
    "match_context", OVER_KEY + "target:l overs_remaining:i runs_needed:l required_run_rate:d current_run_rate:d wickets_fallen:l pressure_ball:b",
    "SELECT * FROM cx", "cx",
)(context)


def _flag_query(name: str, rule) -> None:
    def build(spark, folder):
        return context(spark, folder).withColumn(name, F.coalesce(rule(), F.lit(False)))

    query(f"rule_{name}", OVER_KEY + f"{name}:b", "SELECT * FROM cx", "cx")(build)


for _name, _rule in agg.PRESSURE_RULES.items():
    _flag_query(_name, _rule)
query("pressure_flag", OVER_KEY + "pressure_ball:b", "SELECT * FROM cx", "cx")(context)


@query(
    "match_schedule", "match_id:s team1:s city:s season:s team2:s is_knockout:b",
    """SELECT match_id, FIRST(batting_team ORDER BY innings, over_no, ball, seq) AS team1, FIRST(city ORDER BY innings, over_no, ball, seq) AS city,
       FIRST(season ORDER BY innings, over_no, ball, seq) AS season, '' AS team2, FALSE AS is_knockout FROM lg GROUP BY match_id""",
    "lg",
)
def _(spark, folder):
    return agg.match_schedule(legacy(spark, folder))


DESCRIBE = "count:l mean:d std:d min:d p25:d p50:d p75:d max:d"


@query(
    "describe_orders", DESCRIBE,
    "SELECT COUNT(o_totalprice) AS count, AVG(o_totalprice) AS mean, STDDEV_SAMP(o_totalprice) AS std, MIN(o_totalprice) AS min, QUANTILE_CONT(o_totalprice, 0.25) AS p25, "
    "QUANTILE_CONT(o_totalprice, 0.5) AS p50, QUANTILE_CONT(o_totalprice, 0.75) AS p75, MAX(o_totalprice) AS max FROM orders",
)
def _(spark, folder):
    return agg.describe(bridge.table(spark, folder, "orders"), "o_totalprice")


@query(
    "describe_by_flag", "l_returnflag:s " + DESCRIBE,
    "SELECT l_returnflag, COUNT(l_extendedprice) AS count, AVG(l_extendedprice) AS mean, STDDEV_SAMP(l_extendedprice) AS std, MIN(l_extendedprice) AS min, QUANTILE_CONT(l_extendedprice, 0.25) AS p25, "
    "QUANTILE_CONT(l_extendedprice, 0.5) AS p50, QUANTILE_CONT(l_extendedprice, 0.75) AS p75, MAX(l_extendedprice) AS max FROM lineitem GROUP BY l_returnflag",
)
def _(spark, folder):
    return agg.describe(bridge.table(spark, folder, "lineitem"), "l_extendedprice", ["l_returnflag"])


@query(
    "value_counts", "o_orderpriority:s n:l share:d",
    "SELECT o_orderpriority, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM orders) AS share FROM orders GROUP BY o_orderpriority",
)
def _(spark, folder):
    return agg.value_counts(bridge.table(spark, folder, "orders"), "o_orderpriority")


