"""Queries on user features, survival, value and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.operators import survival as su
from stumpline.operators import users as us
from stumpline.operators import value_models as vm
from stumpline.operators.decision import feature_importance
from stumpline.plans import bridge
from stumpline.plans.registry import cte, query

users = bridge.users


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as users: order value, order count and days since the last order."""
    orders = bridge.table(spark, folder, "orders")
    per = orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total_deposits"), F.count(F.lit(1)).alias("n")
    )
    return (
        bridge.table(spark, folder, "customer")
        .join(per, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.coalesce("total_deposits", F.lit(0.0)).alias("total_deposits"),
            (F.coalesce("n", F.lit(0)) / 4.0).alias("contests_entered_per_week"),
            (F.col("c_custkey") % 40).cast("int").alias("days_since_last_login"),
            (F.col("c_custkey") % 7).cast("int").alias("loss_streak_length"),
            F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(0).alias("churned"),
            ((F.coalesce("n", F.lit(0)) % 10) / 10.0).alias("win_rate"),
            (F.coalesce("n", F.lit(0)) % 2).cast("double").alias("mega_contest_ratio"),
        )
    )


cte("cu", "", """
SELECT c_custkey AS user_id, COALESCE(t, 0) AS total_deposits, CAST(COALESCE(n, 0) AS DOUBLE) / 4 AS contests_entered_per_week, c_custkey % 40 AS days_since_last_login, c_custkey % 7 AS loss_streak_length,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS churned, CAST(COALESCE(n, 0) % 10 AS DOUBLE) / 10 AS win_rate, COALESCE(n, 0) % 2 AS mega_contest_ratio
FROM customer LEFT JOIN (SELECT o_custkey, ROUND(SUM(o_totalprice), 2) AS t, COUNT(*) AS n FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey""")
cte("val", "cu", "SELECT *, GREATEST(total_deposits, 0) * (1 - churned * 0.5::DOUBLE) AS predicted_clv, contests_entered_per_week * 4 AS predicted_purchases FROM cu")

# --- features -------------------------------------------------------------------------------------

_BUCKET = "CASE WHEN {0} > 0 AND {0} <= 0.05 THEN 'low' WHEN {0} > 0.05 AND {0} <= 0.15 THEN 'medium' WHEN {0} > 0.15 AND {0} <= 0.3 THEN 'high' WHEN {0} > 0.3 AND {0} <= 1 THEN 'elite' END"
cte("uf", "u", f"""
SELECT *, days_since_last_login AS recency_days, contests_entered_per_week AS frequency_contests_per_week, total_deposits AS monetary_deposits, total_withdrawals AS monetary_withdrawals,
  total_deposits - total_withdrawals AS net_deposits, CASE WHEN contests_entered_per_week >= 5 THEN 1 ELSE 0 END AS is_high_engagement, CASE WHEN days_since_last_login >= 14 THEN 1 ELSE 0 END AS is_dormant,
  loss_streak_length * loss_streak_length AS loss_streak_sq, {_BUCKET.format('win_rate')} AS win_rate_bucket, CASE WHEN team_diversity_score < 0.3::DOUBLE THEN 1 ELSE 0 END AS low_diversity,
  CASE age_group WHEN '18-24' THEN 0 WHEN '25-34' THEN 1 WHEN '35-44' THEN 2 WHEN '45+' THEN 3 ELSE 1 END AS age_group_encoded, days_since_last_login AS duration_days, churned AS event_observed, churned AS churn_class FROM u""")


def features_src(spark: SparkSession, folder: str) -> DataFrame:
    return us.user_features_src(users(spark, folder))


def features_ext(spark: SparkSession, folder: str) -> DataFrame:
    return us.user_features_ext(users(spark, folder))


query(
    "user_features_src",
    "user_id:l recency_days:i frequency_contests_per_week:d monetary_deposits:d monetary_withdrawals:d net_deposits:d is_high_engagement:i is_dormant:i loss_streak_length:i loss_streak_sq:i "
    "win_rate_bucket:s team_diversity_score:d low_diversity:i age_group_encoded:i duration_days:i event_observed:i churn_class:i avg_team_score_percentile:d winnings_last_30d:d",
    "SELECT * FROM uf", "uf",
)(features_src)
cte("ue", "u", """
SELECT *, days_since_last_login AS recency_days, LN(1 + days_since_last_login) AS log_recency, CASE WHEN days_since_last_login > 30 THEN 1 ELSE 0 END AS inactivity_risk, LN(1 + contests_entered_per_week) AS log_frequency,
  session_frequency_per_week * contests_entered_per_week AS session_engagement, LN(1 + total_deposits) AS monetary_deposits, LN(1 + winnings_last_30d) AS log_winnings, total_deposits - total_withdrawals AS net_deposits,
  total_withdrawals / GREATEST(total_deposits, 1) AS withdrawal_ratio, CAST(loss_streak_length AS DOUBLE) / (SELECT MAX(loss_streak_length) FROM u) AS loss_streak_risk, team_diversity_score AS diversity_score,
  mega_contest_ratio AS mega_contest_affinity, captain_change_frequency AS captain_change_freq, referral_activity AS referral_score, late_match_joining_pct AS late_joining_risk, ipl_only_user AS ipl_focus,
  playoffs_engagement AS playoffs_boost, GREATEST(days_since_last_login, 1) AS duration_days, churned AS event_observed FROM u""")
query(
    "user_features_ext",
    "user_id:l recency_days:i log_recency:d inactivity_risk:i log_frequency:d session_engagement:d monetary_deposits:d log_winnings:d net_deposits:d withdrawal_ratio:d loss_streak_risk:d diversity_score:d "
    "mega_contest_affinity:d captain_change_freq:d referral_score:d late_joining_risk:d ipl_focus:i playoffs_boost:i duration_days:i event_observed:i",
    "SELECT * FROM ue", "ue",
)(features_ext)


@query(
    "win_rate_bucket", "user_id:l bucket:s",
    f"SELECT user_id, {_BUCKET.format('win_rate')} AS bucket FROM cu", "cu",
)
def _(spark, folder):
    c = customers(spark, folder)
    return c.select("user_id", us.win_rate_bucket(F.col("win_rate")).alias("bucket"))


@query(
    "fill_derived", "user_id:l contests_entered_per_week:d loss_streak_length:i",
    "SELECT user_id, CAST(total_deposits AS DOUBLE) / GREATEST(days_since_last_login, 1) * 7 AS contests_entered_per_week, CAST(TRUNC((1 - win_rate) * 5) AS INTEGER) AS loss_streak_length FROM cu", "cu",
)
def _(spark, folder):
    c = customers(spark, folder).withColumns(
        {"contests_joined": F.col("total_deposits"), "lifetime_days": F.col("days_since_last_login")}
    )
    return us.fill_derived(c.drop("contests_entered_per_week", "loss_streak_length"))


# --- survival -------------------------------------------------------------------------------------


def _km(table: str, group: str, filt: str = "TRUE") -> str:
    part = f"PARTITION BY {group} " if group else ""
    head = f"{group}, " if group else ""
    return f"""SELECT *, CASE WHEN MIN(CASE WHEN deaths = at_risk THEN 0 ELSE 1 END) OVER ({part}ORDER BY duration ROWS UNBOUNDED PRECEDING) = 0 THEN 0
        ELSE EXP(SUM(CASE WHEN deaths = at_risk THEN 0 ELSE LN(1 - CAST(deaths AS DOUBLE) / at_risk) END) OVER ({part}ORDER BY duration ROWS UNBOUNDED PRECEDING)) END AS survival FROM (
        SELECT *, SUM(n) OVER ({part}ORDER BY duration DESC ROWS UNBOUNDED PRECEDING) AS at_risk FROM (
        SELECT {head}duration_days AS duration, COUNT(*) AS n, SUM(event_observed) AS deaths FROM {table} WHERE {filt} GROUP BY {head}duration_days))"""


KM = "duration:i at_risk:l deaths:l survival:d"
query("kaplan_meier", KM, _km("ue", ""), "ue")(lambda s, f: su.kaplan_meier(features_ext(s, f)))
query("kaplan_meier_by_age", "age_group:s " + KM, _km("ue", "age_group", "age_group IS NOT NULL"), "ue")(
    lambda s, f: su.kaplan_meier(features_ext(s, f), by=["age_group"])
)
query(
    "kaplan_meier_by_streak", "threshold:i " + KM,
    _km("(SELECT ue.*, t.threshold FROM ue JOIN (SELECT unnest([0, 1, 3, 5]) AS threshold) t ON loss_streak_length >= t.threshold)", "threshold"), "ue",
)(lambda s, f: su.kaplan_meier(su.by_threshold(features_ext(s, f), "loss_streak_length", (0, 1, 3, 5)), by=["threshold"]))
_QT = "(SELECT *, CASE WHEN win_rate <= QUANTILE_CONT(win_rate, 0.25) OVER () THEN 'Q1 Low' WHEN win_rate <= QUANTILE_CONT(win_rate, 0.5) OVER () THEN 'Q2' WHEN win_rate <= QUANTILE_CONT(win_rate, 0.75) OVER () THEN 'Q3' ELSE 'Q4 High' END AS quartile FROM ue)"
query("kaplan_meier_by_quartile", "quartile:s " + KM, _km(_QT, "quartile"), "ue")(
    lambda s, f: su.kaplan_meier(su.by_quartile(features_ext(s, f), "win_rate"), by=["quartile"])
)

COX = ("log_frequency", "monetary_deposits", "win_rate", "loss_streak_length", "mega_contest_affinity")


def _cox(spark, folder):
    df = features_ext(spark, folder).cache()
    return df, su.fit_cox(df, COX)


@query("cox_ph", "feature:s coefficient:d hazard_ratio:d standard_error:d")
def _(spark, folder):
    df, model = _cox(spark, folder)
    return model.hazard_ratios(df)


@query("cox_risk", "user_id:l cox_churn_risk_score:d")
def _(spark, folder):
    df, model = _cox(spark, folder)
    return su.cox_risk(df, model)


@query("cox_concordance", "pairs:l concordance_index:d")
def _(spark, folder):
    df, model = _cox(spark, folder)
    return su.concordance_index(su.cox_risk(df, model), "duration_days", "event_observed", "cox_churn_risk_score")


@query(
    "concordance_index", "pairs:l concordant:l tied:l concordance_index:d",
    """SELECT *, (concordant + tied / 2.0::DOUBLE) / pairs AS concordance_index FROM (
       SELECT COUNT(*) AS pairs, SUM(CASE WHEN a.loss_streak_length > b.loss_streak_length THEN 1 ELSE 0 END) AS concordant, SUM(CASE WHEN a.loss_streak_length = b.loss_streak_length THEN 1 ELSE 0 END) AS tied
       FROM ue a JOIN ue b ON a.event_observed = 1 AND (a.duration_days < b.duration_days OR (a.duration_days = b.duration_days AND b.event_observed = 0)))""",
    "ue",
)
def _(spark, folder):
    return su.concordance_index(features_ext(spark, folder), "duration_days", "event_observed", "loss_streak_length")


@query(
    "concordance_continuous", "pairs:l concordant:l tied:l concordance_index:d",
    """SELECT *, (concordant + tied / 2.0::DOUBLE) / pairs AS concordance_index FROM (
       SELECT COUNT(*) AS pairs, SUM(CASE WHEN a.total_deposits > b.total_deposits THEN 1 ELSE 0 END) AS concordant, SUM(CASE WHEN a.total_deposits = b.total_deposits THEN 1 ELSE 0 END) AS tied
       FROM cu a JOIN cu b ON a.churned = 1 AND (a.days_since_last_login < b.days_since_last_login OR (a.days_since_last_login = b.days_since_last_login AND b.churned = 0)))""",
    "cu",
)
def _(spark, folder):
    return su.concordance_index(customers(spark, folder), "days_since_last_login", "churned", "total_deposits")


# --- churn classifier and value models ------------------------------------------------------------


def _churn(spark, folder):
    df = features_src(spark, folder).cache()
    return df, vm.train_churn_classifier(df)


@query("churn_classifier_scores", "user_id:l churn_probability:d")
def _(spark, folder):
    df, model = _churn(spark, folder)
    return vm.churn_probability(df, model)


@query("churn_classifier_importance", "feature:s importance:d")
def _(spark, folder):
    df, model = _churn(spark, folder)
    return feature_importance(df, model, us.CHURN_FEATURES)


@query(
    "rft_summary", "user_id:l frequency:d recency:d T:d monetary_value:d is_active:b",
    """SELECT user_id, contests_entered_per_week * 4 AS frequency, CASE WHEN days_since_last_login < 45 THEN 90 - days_since_last_login ELSE 0 END AS recency, 90 AS T,
       CASE WHEN total_deposits > 0 THEN total_deposits / 12 ELSE 0 END AS monetary_value, days_since_last_login < 45 AS is_active FROM u""",
    "u",
)
def _(spark, folder):
    return us.rft_summary(users(spark, folder))


def _value(spark, folder):
    rft = us.rft_summary(users(spark, folder)).cache()
    active = rft.filter("is_active")
    return rft, vm.fit_purchases(active), vm.fit_spend(active)


@query("purchase_model", "r:d alpha:d a:d b:d objective:d")
def _(spark, folder):
    _, m, _ = _value(spark, folder)
    return spark.createDataFrame([(m.r, m.alpha, m.a, m.b, m.objective)], "r double, alpha double, a double, b double, objective double")


@query("expected_purchases", "user_id:l expected_12:d expected_30:d")
def _(spark, folder):
    rft, m, _ = _value(spark, folder)
    e = rft.withColumn("e", m.expected_column([12.0, 30.0]))
    return e.select("user_id", F.col("e")[0].alias("expected_12"), F.col("e")[1].alias("expected_30"))


@query("spend_model", "user_id:l expected_spend:d")
def _(spark, folder):
    rft, _, s = _value(spark, folder)
    return rft.withColumn("expected_spend", F.lit(None).cast("double") if s is None else s.expected())


def clv_users(spark, folder):
    return vm.predict_value(*_value(spark, folder))


query("clv", "user_id:l predicted_purchases:d predicted_clv:d")(clv_users)

# --- value, segments, interventions ---------------------------------------------------------------


def valued(spark: SparkSession, folder: str) -> DataFrame:
    return us.clv_fallback(customers(spark, folder))


query("clv_fallback", "user_id:l predicted_clv:d predicted_purchases:d", "SELECT * FROM val", "val")(valued)


@query(
    "clv_summary", "mean_clv:d median_clv:d p95_clv:d top_decile_share:d",
    """SELECT AVG(predicted_clv) AS mean_clv, QUANTILE_CONT(predicted_clv, 0.5) AS median_clv, QUANTILE_CONT(predicted_clv, 0.95) AS p95_clv,
       SUM(CASE WHEN predicted_clv >= (SELECT QUANTILE_CONT(predicted_clv, 0.9) FROM val) THEN predicted_clv ELSE 0 END) / SUM(predicted_clv) AS top_decile_share FROM val""",
    "val",
)
def _(spark, folder):
    return us.clv_summary(valued(spark, folder))


cte("s4a", "val", """
SELECT *, CASE WHEN r <= 1 + (n - 1) * 0.25 THEN 'Q1_Low' WHEN r <= 1 + (n - 1) * 0.5 THEN 'Q2' WHEN r <= 1 + (n - 1) * 0.75 THEN 'Q3' ELSE 'Q4_High' END AS clv_quartile,
  CASE WHEN days_since_last_login > 30 OR loss_streak_length >= 5 THEN 'High' WHEN days_since_last_login > 14 OR loss_streak_length >= 2 THEN 'Medium' ELSE 'Low' END AS churn_risk
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY predicted_clv, user_id) AS r, COUNT(*) OVER () AS n FROM val)""")
cte("s4", "s4a", """
SELECT *, CASE WHEN churn_risk = 'High' AND clv_quartile = 'Q4_High' THEN 'At-Risk High-CLV' WHEN clv_quartile = 'Q4_High' THEN 'High-CLV Loyalist' WHEN clv_quartile IN ('Q2', 'Q3') THEN 'Medium-CLV Grower' ELSE 'Low-CLV Casual' END AS segment FROM s4a""")


def segmented4(spark: SparkSession, folder: str) -> DataFrame:
    return us.segment_4(valued(spark, folder))


query("clv_quartile", "user_id:l clv_quartile:s", "SELECT * FROM s4", "s4")(lambda s, f: us.clv_quartile(valued(s, f)))
query("churn_risk", "user_id:l churn_risk:s", "SELECT * FROM s4", "s4")(
    lambda s, f: valued(s, f).withColumn("churn_risk", us.churn_risk())
)
query("segment_4", "user_id:l clv_quartile:s churn_risk:s segment:s", "SELECT * FROM s4", "s4")(segmented4)


@query("segment_counts", "segment:s n:l share:d", "SELECT segment, COUNT(*) AS n, CAST(COUNT(*) AS DOUBLE) / (SELECT COUNT(*) FROM s4) AS share FROM s4 GROUP BY segment", "s4")
def _(spark, folder):
    from stumpline.operators.aggregates import value_counts

    return value_counts(segmented4(spark, folder), "segment")


def _five(value: str, mega: str, table: str) -> str:
    high = f"{value} > (SELECT QUANTILE_CONT({value}, 0.75) FROM {table})"
    return f"""SELECT *, CASE segment WHEN 'Churn Risk' THEN 0.8 WHEN 'Casual' THEN 0.5 ELSE 0.2 END AS churn_risk_score FROM (
      SELECT *, CASE WHEN {high} AND churned = 1 THEN 'Churn Risk' WHEN {high} AND win_rate > 0.55 THEN 'High Roller' WHEN {high} THEN 'Loyal Grinder' WHEN {mega} THEN 'Promo Hunter' ELSE 'Casual' END AS segment FROM {table})"""


cte("s5", "val", _five("predicted_clv", "mega_contest_ratio > 0.3", "val"))
cte("s5d", "val", _five("total_deposits", "contests_entered_per_week > 2", "val"))


def segmented5(spark: SparkSession, folder: str) -> DataFrame:
    return us.segment_5(valued(spark, folder))


query("segment_5", "user_id:l segment:s churn_risk_score:d", "SELECT * FROM s5", "s5")(segmented5)
query("segment_5_deposits", "user_id:l segment:s churn_risk_score:d", "SELECT * FROM s5d", "s5d")(
    lambda s, f: us.segment_5(valued(s, f), "total_deposits", mega=F.col("contests_entered_per_week") > 2)
)
_PLAN4 = "(VALUES " + ", ".join(f"('{r[0]}', {r[2]}, '{r[5]}', {r[6]}::DOUBLE)" for r in us.INTERVENTIONS_4) + ") p(segment, priority, offer_value, conv)"
_PLAN5 = "(VALUES " + ", ".join(f"('{r[0]}', '{r[1]}', {r[3]}::DOUBLE, {r[4]})" for r in us.INTERVENTIONS_5) + ") p(segment, priority, conv, cost)"


@query("intervention_matrix_4", "user_id:l segment:s priority:i offer_value:s expected_conversion:d", f"SELECT user_id, s4.segment, priority, offer_value, conv AS expected_conversion FROM s4 LEFT JOIN {_PLAN4} ON s4.segment = p.segment", "s4")
def _(spark, folder):
    return us.assign_interventions(segmented4(spark, folder), 4)


@query("intervention_matrix_5", "user_id:l segment:s priority:s expected_conversion:d cost_per_user:i", f"SELECT user_id, s5.segment, priority, conv AS expected_conversion, cost AS cost_per_user FROM s5 LEFT JOIN {_PLAN5} ON s5.segment = p.segment", "s5")
def _(spark, folder):
    return us.assign_interventions(segmented5(spark, folder), 5)


cte("ri", "s4", f"""
SELECT s.segment, n AS users_in_segment, avg_clv, n * avg_clv * 12 / 1e7 AS annual_deposits_at_risk_cr, conv AS conversion_rate, n * avg_clv * 12 * conv / 1e7 AS recovered_annual_cr
FROM (SELECT segment, COUNT(*) AS n, AVG(predicted_clv) AS avg_clv FROM s4 GROUP BY segment) s JOIN {_PLAN4} ON s.segment = p.segment""")
query(
    "revenue_impact_src", "segment:s users_in_segment:l avg_clv:d annual_deposits_at_risk_cr:d conversion_rate:d recovered_annual_cr:d", "SELECT * FROM ri", "ri"
)(lambda s, f: us.revenue_impact_src(segmented4(s, f)))


@query(
    "platform_recovery", "total_recovered_cr_sample:d estimated_platform_recovery_cr:d",
    "SELECT SUM(recovered_annual_cr) AS total_recovered_cr_sample, SUM(recovered_annual_cr) / (SUM(users_in_segment) / 190000000.0::DOUBLE) / 100 AS estimated_platform_recovery_cr FROM ri", "ri",
)
def _(spark, folder):
    return us.platform_recovery(segmented4(spark, folder))


NET = "segment:s users_platform:d avg_clv:d conversion_rate:d recovered_users:d recovered_value_cr:d cost_cr:d net_recovery_cr:d"


def _net(table: str, value: str, whole: bool) -> str:
    users_sql = "FLOOR({0})" if whole else "{0}"
    return f"""SELECT segment, m AS users_platform, avg_clv, conv AS conversion_rate, m * conv AS recovered_users, m * conv * avg_clv * 0.3 / 1e7 AS recovered_value_cr, m * cost / 1e7 AS cost_cr,
       m * conv * avg_clv * 0.3 / 1e7 - m * cost / 1e7 AS net_recovery_cr FROM (
       SELECT p.segment, conv, cost, COALESCE(a, 0) AS avg_clv, {users_sql.format(f"COALESCE(n, 0) / ((SELECT COUNT(*) FROM {table}) / 190000000.0::DOUBLE)")} AS m
       FROM {_PLAN5} LEFT JOIN (SELECT segment, COUNT(*) AS n, AVG({value}) AS a FROM {table} GROUP BY segment) s ON s.segment = p.segment)"""


query("revenue_impact_net", NET, _net("s5", "predicted_clv", True), "s5")(lambda s, f: us.revenue_impact_net(segmented5(s, f)))
query("revenue_impact_net_deposits", NET, _net("s5d", "total_deposits", False), "s5d")(
    lambda s, f: us.revenue_impact_net(
        us.segment_5(valued(s, f), "total_deposits", mega=F.col("contests_entered_per_week") > 2), "total_deposits", whole_users=False
    )
)


@query("risk_rankings", "user_id:l segment:s churn_risk_score:d predicted_clv:d", "SELECT * FROM s5 ORDER BY churn_risk_score DESC, user_id LIMIT 20", "s5")
def _(spark, folder):
    return us.risk_rankings(segmented5(spark, folder), "churn_risk_score", 20)


@query(
    "score_given_users", "user_id:l segment:s churn_risk_score:d",
    "SELECT * FROM s5 WHERE user_id IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000) ORDER BY churn_risk_score DESC, user_id LIMIT 50", "s5",
)
def _(spark, folder):
    big = bridge.table(spark, folder, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("user_id"))
    return us.risk_rankings(segmented5(spark, folder), "churn_risk_score", 50, ids=big)


@query(
    "churn_overview", "n_users:l churn_rate:d partial_churn_rate:d avg_deposit:d at_risk_users:l",
    "SELECT COUNT(*) AS n_users, AVG(churned) AS churn_rate, AVG(churned * 0.3) AS partial_churn_rate, AVG(total_deposits) AS avg_deposit, SUM(CASE WHEN segment = 'Churn Risk' THEN 1 ELSE 0 END) AS at_risk_users FROM s5",
    "s5",
)
def _(spark, folder):
    return us.churn_overview(segmented5(spark, folder))
