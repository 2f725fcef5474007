"""Queries on substitution decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.operators import decision as de
from stumpline.plans import bridge
from stumpline.plans.queries_delivery import big_innings, context, legacy, states
from stumpline.plans.registry import cte, query
from stumpline.session import stored
from stumpline.sources import store

_S = {
    "s1_innings": "innings", "s2_balls_remaining": "balls_remaining", "s3_wickets_in_hand": "wickets_in_hand",
    "s4_required_run_rate": "COALESCE(required_run_rate, 0)", "s5_current_run_rate": "current_run_rate",
    "s6_momentum_score": "momentum_score",
    "s7_phase_code": "CASE phase_of_play WHEN 'powerplay' THEN 0 WHEN 'middle' THEN 1 ELSE 2 END",
    "s8_runs_last_6_balls": "runs6", "s9_wickets_last_6_balls": "wickets6", "s10_boundary_last_3_overs": "fours18",
    "s11_pressure_index": "pressure_index", "s12_chase_win_prob": "chase_win_probability_proxy",
    "s13_bowling_pressure": "bowling_pressure_index", "s14_partnership_runs": "partnership_runs",
}


def _bin(col: str, a: str, b: str) -> str:
    return f"CASE WHEN {col} <= {a} THEN 0 WHEN {col} <= {b} THEN 1 ELSE 2 END"


cte("sv0", "st", "SELECT match_id, innings, over_no, ball, seq, striker AS batter, bowler, " + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in _S.items()) + " FROM st")
cte("sv", "sv0", f"""
SELECT *, concat_ws('_', {_bin('s4_required_run_rate', '6', '10')}, CASE WHEN s3_wickets_in_hand >= 7 THEN 0 WHEN s3_wickets_in_hand >= 4 THEN 1 ELSE 2 END, CAST(s7_phase_code AS INTEGER),
  {_bin('s6_momentum_score', '-2', '2')}, {_bin('s11_pressure_index', '0.3::DOUBLE', '0.6::DOUBLE')}, {_bin('s12_chase_win_prob', '0.3::DOUBLE', '0.7::DOUBLE')}, {_bin('s13_bowling_pressure', '0.3::DOUBLE', '0.6::DOUBLE')}) AS state_key,
  CASE WHEN s8_runs_last_6_balls / 6 > s4_required_run_rate THEN 1 ELSE 0 END AS sub_benefit FROM sv0""")
KEY = "match_id:s innings:i over:i ball:i seq:l "


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return de.state_vector_14d(states(spark, folder), big_innings(spark, folder))


def keyed(spark: SparkSession, folder: str) -> DataFrame:
    return de.discretise_state(vectors(spark, folder))


query("state_vector_14d", KEY + " ".join(f"{c}:d" for c in de.STATE_COLUMNS), "SELECT * FROM sv", "sv")(vectors)
query("discretise_state", KEY + "state_key:s", "SELECT * FROM sv", "sv")(keyed)

cte("os", "cx", """
SELECT match_id, innings, over_no, cumulative_score AS current_score, cumulative_wickets AS wickets_fallen, COALESCE(current_run_rate, 0) AS current_run_rate,
  CASE WHEN innings = 2 THEN COALESCE(required_run_rate, 0) ELSE 0 END AS required_run_rate, overs_remaining, GREATEST(10 - cumulative_wickets, 0) AS wickets_remaining,
  CASE WHEN innings = 2 THEN CASE WHEN city IN ('Mumbai', 'Delhi') THEN 0.7 ELSE 0.3 END ELSE 0 END AS dew_factor_proxy, LEAST(over_no / 4.0::DOUBLE, 4) / 4 AS bowler_fatigue,
  LEAST(over_no / 6.0::DOUBLE, 3) / 3 AS batter_fatigue, CASE WHEN innings = 2 THEN 0 ELSE 1 END AS is_first_innings, CASE WHEN pressure_ball THEN 1 ELSE 0 END AS is_pressure_situation
FROM cx JOIN (SELECT DISTINCT match_id, city FROM d) c USING (match_id)""")


def over_states(spark: SparkSession, folder: str) -> DataFrame:
    cities = legacy(spark, folder).select("match_id", "city").distinct()
    return de.over_state(context(spark, folder).join(cities, "match_id"))


query(
    "over_state",
    "match_id:s innings:i over:i current_score:d wickets_fallen:d current_run_rate:d required_run_rate:d overs_remaining:d wickets_remaining:d dew_factor_proxy:d bowler_fatigue:d batter_fatigue:d is_first_innings:d is_pressure_situation:d",
    "SELECT * FROM os", "os d",
)(over_states)


@query(
    "bucket_state", "match_id:s innings:i over:i rrr_bucket:s over_bucket:s wicket_bucket:s",
    """SELECT *, CASE WHEN r BETWEEN 0 AND 6 THEN 'low' WHEN r BETWEEN 6 AND 10 THEN 'medium' WHEN r BETWEEN 10 AND 999 THEN 'high' ELSE 'medium' END AS rrr_bucket,
       CASE WHEN o BETWEEN 1 AND 6 THEN 'early' WHEN o BETWEEN 7 AND 15 THEN 'mid' WHEN o BETWEEN 16 AND 20 THEN 'death' ELSE 'mid' END AS over_bucket,
       CASE WHEN w BETWEEN 0 AND 3 THEN 'few' WHEN w BETWEEN 4 AND 6 THEN 'some' WHEN w BETWEEN 7 AND 10 THEN 'many' ELSE 'some' END AS wicket_bucket
       FROM (SELECT *, CASE WHEN required_run_rate > 0 THEN required_run_rate ELSE 5 END AS r, 20 - overs_remaining AS o, LEAST(GREATEST(wickets_fallen, 0), 10) AS w FROM os)""",
    "os d",
)
def _(spark, folder):
    return de.bucket_state(over_states(spark, folder))


@query("state_summary", "rows:l distinct_states:l", "SELECT COUNT(*) AS rows, COUNT(DISTINCT state_key) AS distinct_states FROM sv", "sv")
def _(spark, folder):
    return de.state_summary(keyed(spark, folder))


@query("label_benefit", KEY + "sub_benefit:i", "SELECT * FROM sv", "sv")
def _(spark, folder):
    return de.label_benefit(vectors(spark, folder))


def _classifier(spark, folder):
    return de.train_benefit_classifier(de.label_benefit(keyed(spark, folder)).cache())


@query("benefit_classifier_scores", KEY + "sub_benefit:i probability:d prediction:d")
def _(spark, folder):
    return _classifier(spark, folder)[1]


@query("benefit_classifier_importance", "feature:s importance:d")
def _(spark, folder):
    model, scored = _classifier(spark, folder)
    return de.feature_importance(scored, model, de.STATE_COLUMNS)


@query("benefit_classifier_metrics", "roc_auc:d precision:d recall:d f1:d accuracy:d support_0:l support_1:l")
def _(spark, folder):
    return de.binary_metrics(_classifier(spark, folder)[1], "sub_benefit", "probability")


@query(
    "binary_metrics", "roc_auc:d precision:d recall:d f1:d precision_0:d recall_0:d f1_0:d support_0:l support_1:l accuracy:d",
    """SELECT (SELECT (SUM(CASE WHEN y = 1 THEN r ELSE 0 END) - SUM(y) * (SUM(y) + 1) / 2.0) / (SUM(y) * SUM(1 - y)) FROM (
           SELECT y, AVG(rn) OVER (PARTITION BY p) AS r FROM (SELECT y, p, ROW_NUMBER() OVER (ORDER BY p) AS rn FROM bm))) AS roc_auc,
         tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, tn / (tn + fn) AS precision_0, tn / (tn + fp) AS recall_0, 2 * tn / (2 * tn + fp + fn) AS f1_0,
         tn + fp AS support_0, tp + fn AS support_1, (tp + tn) / (tp + tn + fp + fn) AS accuracy
       FROM (SELECT SUM(CASE WHEN y = 1 AND p >= 0.5 THEN 1.0::DOUBLE ELSE 0 END) AS tp, SUM(CASE WHEN y = 0 AND p >= 0.5 THEN 1.0::DOUBLE ELSE 0 END) AS fp,
         SUM(CASE WHEN y = 1 AND p < 0.5 THEN 1.0::DOUBLE ELSE 0 END) AS fn, SUM(CASE WHEN y = 0 AND p < 0.5 THEN 1.0::DOUBLE ELSE 0 END) AS tn FROM bm)""",
    "bm",
)
def _(spark, folder):
    df = de.label_benefit(vectors(spark, folder))
    return de.binary_metrics(df.withColumn("p", F.round("s12_chase_win_prob", 3)), "sub_benefit", "p")


cte("bm", "sv", "SELECT sub_benefit AS y, ROUND(s12_chase_win_prob, 3) AS p FROM sv")
_SEQ = "PARTITION BY match_id, innings ORDER BY over_no, ball, seq"
cte("tr0", "sv", f"""
SELECT match_id, innings, ROW_NUMBER() OVER ({_SEQ}) AS ball_number, COUNT(*) OVER (PARTITION BY match_id, innings) AS n, state_key, LEAD(state_key) OVER ({_SEQ}) AS next_state_key, seq % 3 AS action,
  AVG(s8_runs_last_6_balls) OVER ({_SEQ} ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS m8, AVG(s4_required_run_rate) OVER ({_SEQ} ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING) AS m4 FROM sv""")
cte("tr", "tr0", "SELECT *, CASE WHEN m4 <= 0 THEN 0.5 ELSE LEAST(GREATEST(m8 / 6 / GREATEST(m4, 0.1) - 1, -1), 1) END AS reward FROM tr0 WHERE ball_number <= n - 7")


def logged(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """Transitions of the keyed states, or of those that are passed along."""
    return de.transitions(keyed(spark, folder) if known is None else known, action=F.col("seq") % 3, hot=big_innings(spark, folder))


query(
    "transitions", "match_id:s innings:i ball_number:l state_key:s next_state_key:s action:i reward:d", "SELECT * FROM tr", "tr"
)(logged)


@query(
    "transition_counts", "state_key:s action:i next_state_key:s n:l reward_sum:d",
    "SELECT state_key, action, next_state_key, COUNT(*) AS n, SUM(reward) AS reward_sum FROM tr GROUP BY state_key, action, next_state_key", "tr",
)
def _(spark, folder):
    return de.transition_counts(logged(spark, folder))


def keyed_once(spark: SparkSession, folder: str) -> DataFrame:
    """The keyed states as a written table, for queries that read them more than once."""
    return stored(keyed(spark, folder), "keyed")


def mean_q(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    """Mean reward per state and action, to four places so that ties are the same everywhere."""
    return logged(spark, folder, known).groupBy("state_key", "action").agg(F.round(F.avg("reward"), 4).alias("q"))


cte("q", "tr", "SELECT state_key, action, ROUND(AVG(reward), 4) AS q FROM tr GROUP BY state_key, action")
cte("po0", "q", """
SELECT state_key, COALESCE(MAX(CASE WHEN action = 0 THEN q END), 0) AS q0, COALESCE(MAX(CASE WHEN action = 1 THEN q END), 0) AS q1, COALESCE(MAX(CASE WHEN action = 2 THEN q END), 0) AS q2 FROM q GROUP BY state_key""")
cte("po", "po0", """
SELECT *, CASE WHEN q0 >= q1 AND q0 >= q2 THEN 0 WHEN q1 >= q2 THEN 1 ELSE 2 END AS action,
  CASE WHEN q0 >= q1 AND q0 >= q2 THEN 'no_substitution' WHEN q1 >= q2 THEN 'substitute_batter' ELSE 'substitute_bowler' END AS action_name,
  LEAST(GREATEST((GREATEST(q0, q1, q2) - (q0 + q1 + q2) / 3) / (GREATEST(q0, q1, q2) - LEAST(q0, q1, q2) + 1e-8), 0), 1) AS confidence,
  LEAST(GREATEST((GREATEST(q0, q1, q2) - LEAST(q0, q1, q2)) / 10, 0), 1) AS spread_confidence FROM po0""")


def mean_policy(spark: SparkSession, folder: str, known: DataFrame | None = None) -> DataFrame:
    return de.policy(mean_q(spark, folder, known))


query("policy", "state_key:s q0:d q1:d q2:d action:i action_name:s confidence:d spread_confidence:d", "SELECT * FROM po", "po")(mean_policy)


@query(
    "batch_q_iteration", "state_key:s action:i q:d",
    """WITH RECURSIVE cnt AS (SELECT state_key, action, next_state_key, COUNT(*) AS n, SUM(reward) AS r FROM tr GROUP BY state_key, action, next_state_key),
       pair AS (SELECT state_key, action, SUM(n) AS n, SUM(r) / SUM(n) AS r FROM cnt GROUP BY state_key, action),
       it AS (SELECT 0 AS k, state_key, action, 0::DOUBLE AS q FROM pair UNION ALL
         SELECT MAX(s.k) + 1, c.state_key, c.action, MAX(p.r) + 0.85::DOUBLE * SUM(c.n * COALESCE(v.v, 0)) / MAX(p.n)
         FROM cnt c JOIN pair p USING (state_key, action) JOIN (SELECT MAX(k) AS k FROM it) s ON s.k < 200
         LEFT JOIN (SELECT state_key, MAX(q) AS v FROM it GROUP BY state_key) v ON v.state_key = c.next_state_key GROUP BY c.state_key, c.action)
       SELECT state_key, action, q FROM it WHERE k = 200""",
    "tr",
)
def _(spark, folder):
    return de.batch_q_iteration(de.transition_counts(logged(spark, folder)))


@query(
    "policy_action_distribution", "action:i action_name:s states:l pct:d",
    "SELECT action, action_name, COUNT(*) AS states, COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM po) AS pct FROM po GROUP BY action, action_name", "po",
)
def _(spark, folder):
    return de.policy_action_distribution(mean_policy(spark, folder))


ASKED = [("a", 11.5, 5.0), ("b", 6.2, 2.0), ("c", 0.0, 9.0)]
_ASKED = "(VALUES ('a', 11.5::DOUBLE, 5.0::DOUBLE), ('b', 6.2::DOUBLE, 2.0::DOUBLE), ('c', 0.0::DOUBLE, 9.0::DOUBLE)) r(request_id, rr, wf)"
_NEAREST = "request_id:s distance:d match_id:s innings:i over:i ball:i seq:l state_key:s"


@query(
    "nearest_state", _NEAREST,
    f"""SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY distance, match_id, innings, over_no, ball, seq) AS rn FROM (
        SELECT sv.*, r.request_id, ABS(s4_required_run_rate - rr) + ABS(10 - s3_wickets_in_hand - wf) AS distance FROM sv, {_ASKED})) WHERE rn = 1""",
    "sv",
)
def _(spark, folder):
    asked = spark.createDataFrame(ASKED, "request_id string, required_run_rate double, wickets_fallen double")
    return de.nearest_state(keyed(spark, folder), asked)


cte("nl", "sv", """
SELECT s3_wickets_in_hand AS hand, s4_required_run_rate AS rate, arg_min(p, p) AS p FROM (
  SELECT *, {'match_id': match_id, 'innings': innings, 'over_no': over_no, 'ball': ball, 'seq': seq, 'state_key': state_key} AS p FROM sv) GROUP BY 1, 2""")


@query(
    "nearest_state_batch", _NEAREST,
    """SELECT request_id, m.distance AS distance, m.p.match_id AS match_id, m.p.innings AS innings, m.p.over_no AS over_no, m.p.ball AS ball, m.p.seq AS seq, m.p.state_key AS state_key FROM (
         SELECT concat_ws('-', o.match_id, o.innings, o.over_no) AS request_id, MIN({'distance': ABS(nl.rate - o.required_run_rate) + ABS(10 - nl.hand - o.wickets_fallen), 'p': nl.p}) AS m
         FROM os o, nl GROUP BY o.match_id, o.innings, o.over_no)""",
    "os nl d",
)
def _(spark, folder):
    """Every over's state as a request, against all deliveries."""
    asked = over_states(spark, folder).select(
        F.concat_ws("-", "match_id", "innings", "over").alias("request_id"), "required_run_rate", "wickets_fallen"
    )
    return de.nearest_state(keyed(spark, folder), asked)


cte("qk", "sv", "SELECT DISTINCT CAST(round_even(s4_required_run_rate, 0) AS INTEGER) AS k_rate, CAST(round_even(s3_wickets_in_hand, 0) AS INTEGER) AS k_hand, CAST(round_even(s2_balls_remaining / 10, 0) * 10 AS INTEGER) AS k_balls FROM sv")


@query(
    "nearest_q_key", "k_rate:i k_hand:i k_balls:i distance:i q_rate:i q_hand:i q_balls:i",
    """SELECT * FROM (SELECT k.*, v.k_rate AS q_rate, v.k_hand AS q_hand, v.k_balls AS q_balls, ABS(k.k_rate - v.k_rate) + ABS(k.k_hand - v.k_hand) + ABS(k.k_balls - v.k_balls) AS distance,
         ROW_NUMBER() OVER (PARTITION BY k.k_rate, k.k_hand, k.k_balls ORDER BY ABS(k.k_rate - v.k_rate) + ABS(k.k_hand - v.k_hand) + ABS(k.k_balls - v.k_balls), v.k_rate, v.k_hand, v.k_balls) AS rn
       FROM qk k, (SELECT DISTINCT k_rate, k_hand, CAST(k_balls / 20 AS INTEGER) * 20 AS k_balls FROM qk WHERE k_balls % 20 = 0) v) WHERE rn = 1""",
    "qk",
)
def _(spark, folder):
    s = vectors(spark, folder)
    keys = de.q_key(s).select("k_rate", "k_hand", "k_balls").filter("k_balls % 20 = 0").distinct()
    return de.nearest_q_key(s, keys)


@query(
    "heuristic_decision", "match_id:s innings:i over:i substitute:b",
    "SELECT *, required_run_rate > 10 AND wickets_fallen >= 5 AS substitute FROM os", "os d",
)
def _(spark, folder):
    s = over_states(spark, folder)
    return s.withColumn("substitute", de.heuristic_decision(F.col("required_run_rate"), F.col("wickets_fallen")))


CONTEXTS = [("x", 2.0, 9.0), ("y", 0.0, 0.0), ("z", 1.0, 40.0)]
_ALIKE = "s7_phase_code = ph AND s4_required_run_rate BETWEEN GREATEST(rr - 3, 0) AND rr + 3"
cte("rc0", "sv", f"""
SELECT context_id, batter AS player, COALESCE(AVG(CASE WHEN {_ALIKE} THEN s8_runs_last_6_balls END), AVG(s8_runs_last_6_balls)) AS recent, COALESCE(AVG(CASE WHEN {_ALIKE} THEN s4_required_run_rate END), AVG(s4_required_run_rate)) AS rate
FROM sv, (VALUES ('x', 2.0::DOUBLE, 9.0::DOUBLE), ('y', 0.0::DOUBLE, 0.0::DOUBLE), ('z', 1.0::DOUBLE, 40.0::DOUBLE)) c(context_id, ph, rr) GROUP BY context_id, batter""")
cte("rc", "rc0", "SELECT *, CASE WHEN rate > 0 THEN recent / 6 - rate ELSE 0 END AS expected_uplift_runs FROM rc0")


@query(
    "rank_candidates_context", "context_id:s player:s expected_uplift_runs:d compatibility:d primary_role:s sr_in_context:d rank:i",
    """SELECT *, CASE WHEN recent > 0 THEN 1 / (1 + ABS(expected_uplift_runs)) ELSE 0.3 END AS compatibility, CASE WHEN expected_uplift_runs > 0 THEN 'Batter' ELSE 'Bowler' END AS primary_role,
       CASE WHEN recent > 0 THEN recent / 6 * 100 ELSE 0 END AS sr_in_context, ROW_NUMBER() OVER (PARTITION BY context_id ORDER BY expected_uplift_runs DESC, player) AS rank FROM rc""",
    "rc",
)
def _(spark, folder):
    asked = spark.createDataFrame(CONTEXTS, "context_id string, phase_code double, required_run_rate double")
    return de.rank_candidates_context(vectors(spark, folder), asked)


def _roles(spark, folder):
    """A role table derived from the player number."""
    d = legacy(spark, folder).select(F.col("batter").alias("player")).distinct()
    k = F.substring("player", 2, 9).cast("int") % 5
    role = F.get(F.array(*[F.lit(r) for r in ("Batsman", "All-rounder", "Wicketkeeper", "Bowler")]), k)
    weight = F.get(F.array(*[F.lit(w) for w in (5, 3, 2, 0)]), k)
    return d.select(F.upper("player").alias("player"), role.alias("role"), weight.alias("weight")).dropna()


@query(
    "rank_candidates_roles", "player:s role:s expected_uplift_runs:d compatibility:d weighted_score:d",
    """SELECT player, role, u AS expected_uplift_runs, 1 / (1 + ABS(u)) AS compatibility, u * 0.6 + 0.4 / (1 + ABS(u)) + w AS weighted_score FROM (
         SELECT player, u, CASE k WHEN 0 THEN 'Batsman' WHEN 1 THEN 'All-rounder' WHEN 2 THEN 'Wicketkeeper' WHEN 3 THEN 'Bowler' ELSE 'Unknown' END AS role, CASE k WHEN 0 THEN 5 WHEN 1 THEN 3 WHEN 2 THEN 2 ELSE 0 END AS w
         FROM (SELECT batter AS player, CAST(substr(batter, 2) AS INTEGER) % 5 AS k, AVG(s8_runs_last_6_balls) / 6 - AVG(s4_required_run_rate) AS u FROM sv GROUP BY batter)) WHERE role <> 'Bowler' OR player = 'P3'""",
    "sv",
)
def _(spark, folder):
    return de.rank_candidates_roles(vectors(spark, folder), _roles(spark, folder), pinch_hitters=["p3"])


ROLE_STATE = {
    "current_score": 170, "wickets_fallen": 5, "required_run_rate": 10.5, "overs_remaining": 4, "wickets_remaining": 5,
    "pitch_type_encoded": 0.5, "dew_factor_proxy": 0.3, "bowler_fatigue": 0.5, "current_run_rate": 9,
}
_FIRST = (170, 5, 9, 10.5, 4, 5, 0.5, 0.3, 0.5)
_PARTS = ("average / 55", "strike_rate / 180", "1 - 8.0::DOUBLE / 15", "1 - 8.0::DOUBLE / 15", "boundary_pct", "130.0::DOUBLE / 190", "0.5::DOUBLE", "1", "ar")


@query(
    "profile_uplift", "player:s expected_uplift_runs:d compatibility:d primary_role:s",
    f"""SELECT player, compatibility, 'BAT' AS primary_role, (compatibility * 20 + (strike_rate - 100) / 8 + boundary_pct * 15) * CASE WHEN ar = 1 THEN 1.3 ELSE 1 END AS expected_uplift_runs FROM (
        SELECT *, ({' + '.join(f'{s}::DOUBLE * ({p})' for s, p in zip(_FIRST, _PARTS, strict=True))}) / (SQRT({sum(float(x) ** 2 for x in _FIRST)}) * SQRT({' + '.join(f'({p}) * ({p})' for p in _PARTS)})) AS compatibility FROM (
        SELECT striker AS player, CAST(SUM(runs_off_bat) AS DOUBLE) / GREATEST(SUM(wickets), 1) AS average, CAST(SUM(runs_off_bat) AS DOUBLE) / GREATEST(SUM(legal), 1) * 100 AS strike_rate,
          CAST(SUM(bnd) AS DOUBLE) / GREATEST(SUM(legal), 1) AS boundary_pct, CAST(substr(striker, 2) AS INTEGER) % 2 AS ar FROM d GROUP BY striker))""",
    "d",
)
def _(spark, folder):
    from stumpline.operators.aggregates import player_level

    p = player_level(bridge.deliveries(spark, folder)).select(
        "player",
        F.col("average").alias("batting_avg"),
        "strike_rate",
        F.lit(None).cast("double").alias("bowling_economy"),
        F.lit(None).cast("double").alias("death_overs_economy"),
        F.col("boundary_pct").alias("current_form_index"),
        F.lit(None).cast("double").alias("powerplay_strike_rate"),
        F.lit(None).cast("double").alias("head_to_head_vs_opponent"),
        F.lit(1).alias("is_batsman"),
        F.lit(0).alias("is_bowler"),
        (F.substring("player", 2, 9).cast("int") % 2).alias("is_allrounder"),
    )
    return de.profile_uplift(p, ROLE_STATE)


cte("rq", "sv", """
SELECT match_id AS request_id, state_key, s7_phase_code AS ph, s4_required_run_rate AS rr, ROUND(s12_chase_win_prob, 3) AS prob FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY match_id ORDER BY innings DESC, over_no DESC, ball DESC, seq DESC) AS rn FROM sv) WHERE rn = 1""")
cte("rq1", "rq sv", f"""
SELECT request_id, batter AS player, COALESCE(AVG(CASE WHEN {_ALIKE} THEN s8_runs_last_6_balls END), AVG(s8_runs_last_6_balls)) AS recent, COALESCE(AVG(CASE WHEN {_ALIKE} THEN s4_required_run_rate END), AVG(s4_required_run_rate)) AS rate
FROM sv, (SELECT request_id, ph, rr FROM rq) GROUP BY request_id, batter""")
cte("rq2", "rq1", """
SELECT request_id, string_agg(player, ',' ORDER BY rn) AS candidates FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY CASE WHEN rate > 0 THEN recent / 6 - rate ELSE 0 END DESC, player) AS rn FROM rq1) WHERE rn <= 3 GROUP BY request_id""")


def _last_states(states: DataFrame) -> DataFrame:
    last = states.groupBy("match_id").agg(F.max_by(F.struct(*de.STATE_COLUMNS), F.struct("innings", "over", "ball", "seq")).alias("r"))
    return last.select(F.col("match_id").alias("request_id"), "r.*")


def _recommended(spark, folder, model=None, probability=None):
    s = keyed_once(spark, folder)
    out = de.recommend(_last_states(s), s, mean_policy(spark, folder, s), model, probability=probability)
    return out.withColumn("candidates", F.concat_ws(",", F.transform("candidates", lambda c: c["player"])))


@query("recommend", "request_id:s state_key:s substitute_now:b recommended_action:s confidence:d benefit_probability:d candidates:s")
def _(spark, folder):
    """The last state of every match, with the trained classifier."""
    return _recommended(spark, folder, _classifier(spark, folder)[0])


@query(
    "recommend_by_policy", "request_id:s state_key:s substitute_now:b recommended_action:s confidence:d benefit_probability:d candidates:s",
    """SELECT request_id, state_key, COALESCE(po.action, 0) > 0 AS substitute_now, COALESCE(po.action_name, 'no_substitution') AS recommended_action, COALESCE(po.confidence, 0) AS confidence,
       0.5::DOUBLE AS benefit_probability, candidates FROM rq LEFT JOIN po USING (state_key) LEFT JOIN rq2 USING (request_id)""",
    "rq rq2 po",
)
def _(spark, folder):
    return _recommended(spark, folder)


@query(
    "recommend_by_score", "request_id:s state_key:s substitute_now:b recommended_action:s confidence:d benefit_probability:d candidates:s",
    """SELECT request_id, state_key, COALESCE(po.action, 0) > 0 OR prob > 0.7::DOUBLE AS substitute_now, COALESCE(po.action_name, 'no_substitution') AS recommended_action,
       COALESCE(po.confidence, 0) AS confidence, prob AS benefit_probability, candidates FROM rq LEFT JOIN po USING (state_key) LEFT JOIN rq2 USING (request_id)""",
    "rq rq2 po",
)
def _(spark, folder):
    """The last state of every match, with a stored score (the chance to win the chase) as the probability."""
    return _recommended(spark, folder, probability=F.round("s12_chase_win_prob", 3))


cte("cf0", "sv po", f"""
SELECT sv.*, COALESCE(po.action, 0) > 0 AND ROW_NUMBER() OVER ({_SEQ}) < COUNT(*) OVER (PARTITION BY match_id, innings) AS acts FROM sv LEFT JOIN po USING (state_key)""")
cte("cf1", "cf0", "SELECT match_id, innings, MIN(over_no) AS fo, MAX(over_no) AS lo, MIN(CASE WHEN acts THEN over_no END) AS opt, (MIN(over_no) + MAX(over_no)) // 2 AS mid FROM cf0 GROUP BY match_id, innings HAVING COUNT(*) >= 12 AND COUNT(CASE WHEN acts THEN 1 END) > 0")
cte("cf2", "cf0 cf1", """
SELECT match_id, innings, opt AS optimal_sub_over, mid AS actual_sub_over, AVG(CASE WHEN over_no >= GREATEST(fo, opt - 2) AND over_no < opt THEN s8_runs_last_6_balls END) * 6 AS runs_before_opt,
  AVG(CASE WHEN over_no >= opt AND over_no <= LEAST(lo, opt + 2) THEN s8_runs_last_6_balls END) * 6 AS runs_after_opt, AVG(CASE WHEN over_no >= mid AND over_no <= LEAST(lo, mid + 2) THEN s8_runs_last_6_balls END) * 6 AS runs_after_actual
FROM cf0 JOIN cf1 USING (match_id, innings) GROUP BY match_id, innings, opt, mid""")
cte("cf", "cf2", "SELECT *, runs_after_opt - runs_after_actual AS expected_uplift FROM cf2")


def cases(spark: SparkSession, folder: str) -> DataFrame:
    s = keyed_once(spark, folder)
    return de.counterfactual(s, mean_policy(spark, folder, s), hot=big_innings(spark, folder))


query(
    "counterfactual", "match_id:s innings:i optimal_sub_over:i actual_sub_over:i runs_before_opt:d runs_after_opt:d runs_after_actual:d expected_uplift:d",
    "SELECT * FROM cf", "cf",
)(cases)


@query(
    "counterfactual_summary", "cases:l wins:l mean_uplift:d verdict:s",
    """SELECT *, CASE WHEN mean_uplift > 3 THEN 'better' WHEN ABS(mean_uplift) <= 3 THEN 'equal' ELSE 'worse' END AS verdict FROM (
       SELECT COUNT(*) AS cases, SUM(CASE WHEN expected_uplift > 0 THEN 1 ELSE 0 END) AS wins, AVG(expected_uplift) AS mean_uplift FROM cf)""",
    "cf",
)
def _(spark, folder):
    return de.counterfactual_summary(cases(spark, folder))


@query(
    "policy_value", "baseline_reward:d policy_reward:d matched:l uplift_pct:d",
    """SELECT *, (policy_reward - baseline_reward) * 100 AS uplift_pct FROM (
       SELECT AVG(reward) AS baseline_reward, AVG(CASE WHEN tr.action = COALESCE(po.action, 0) THEN reward END) AS policy_reward, COUNT(CASE WHEN tr.action = COALESCE(po.action, 0) THEN 1 END) AS matched
       FROM tr LEFT JOIN po USING (state_key))""",
    "tr po",
)
def _(spark, folder):
    s = keyed_once(spark, folder)
    return de.policy_value(logged(spark, folder, s), mean_policy(spark, folder, s))


@query("export_policy", "state_key:s action:i q:d", "SELECT * FROM q", "q")
def _(spark, folder):
    """Policy values that went through JSON."""
    out = bridge.shared_folder(spark)
    store.export_results(out, {}, {"q_table": mean_q(spark, folder)})
    return store.read_policy(spark, f"{out}/q_table.json")


@query("export_state_vectors", KEY + " ".join(f"{c}:d" for c in de.STATE_COLUMNS), "SELECT * FROM sv", "sv")
def _(spark, folder):
    """State vectors that went through parquet."""
    out = bridge.shared_folder(spark)
    store.export_results(out, {"match_state_vectors": vectors(spark, folder)})
    return store.read_results(spark, out, "match_state_vectors")
