"""Queries on the per-over engagement series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.operators import aggregates as agg
from stumpline.operators import engagement as en
from stumpline.plans.queries_delivery import OVER_KEY, overs
from stumpline.plans.registry import cte, query

_W = "PARTITION BY match_id ORDER BY innings, over_no, batting_team"
_BASE = "boundaries * 2.0::DOUBLE + wickets * 4 + dot_balls * 0.5::DOUBLE"
_CHASE = "CASE WHEN innings = 2 THEN dot_balls * 1.5::DOUBLE ELSE 0 END"
cte("ex0", "ov", f"""
SELECT *, {_BASE} AS excitement_base, {_CHASE} AS excitement_chase_bonus, GREATEST(runs_scored - AVG(runs_scored) OVER (PARTITION BY match_id), 0) / 6 AS run_acceleration,
  COALESCE(ABS(wickets - LAG(wickets) OVER w), 0) * 3 + COALESCE(ABS(boundaries - LAG(boundaries) OVER w), 0) AS momentum_shift,
  COALESCE(ABS(runs_scored - LAG(runs_scored) OVER w), 0) * 0.5::DOUBLE AS run_swing FROM ov WINDOW w AS ({_W})""")


def _normal(name: str, density: str) -> None:
    cte(name, "ex0", f"""
SELECT *, (excitement_density - MIN(excitement_density) OVER (PARTITION BY match_id)) / (MAX(excitement_density) OVER (PARTITION BY match_id) - MIN(excitement_density) OVER (PARTITION BY match_id) + 1e-8) AS excitement_normalised
FROM (SELECT *, {density} AS excitement_density FROM ex0)""")


_normal("ex", "excitement_base + excitement_chase_bonus + run_acceleration + momentum_shift")
_normal("exsource", "excitement_base + excitement_chase_bonus + run_swing")
_normal("exsimple", "excitement_base + excitement_chase_bonus")


def excited(spark: SparkSession, folder: str, variant: str = "extended") -> DataFrame:
    return en.excitement_density(overs(spark, folder), variant)


def series(spark: SparkSession, folder: str) -> DataFrame:
    return en.series_features(excited(spark, folder))


for _variant, _cte in (("extended", "ex"), ("source", "exsource"), ("simple", "exsimple")):
    query(f"excitement_density_{_variant}", OVER_KEY + "excitement_density:d", f"SELECT * FROM {_cte}", _cte)(
        lambda spark, folder, v=_variant: excited(spark, folder, v)
    )
query("excitement_normalised", OVER_KEY + "excitement_normalised:d", "SELECT * FROM ex", "ex")(excited)

cte("ts0", "ex", f"""
SELECT *, LAG(excitement_normalised, 1) OVER w AS excitement_lag_1, LAG(excitement_normalised, 2) OVER w AS excitement_lag_2, LAG(excitement_normalised, 3) OVER w AS excitement_lag_3,
  AVG(excitement_normalised) OVER ({_W} ROWS 2 PRECEDING) AS excitement_rolling_3, AVG(excitement_normalised) OVER ({_W} ROWS 4 PRECEDING) AS excitement_rolling_5,
  SUM(excitement_density) OVER ({_W} ROWS UNBOUNDED PRECEDING) AS cumulative_excitement, CAST(runs_scored - LAG(runs_scored) OVER w AS DOUBLE) AS step FROM ex WINDOW w AS ({_W})""")
cte("ts", "ts0", f"""
SELECT *, CASE WHEN MAX(cumulative_excitement) OVER (PARTITION BY match_id) > 0 THEN cumulative_excitement / MAX(cumulative_excitement) OVER (PARTITION BY match_id) ELSE 0 END AS match_tension_index,
  COALESCE(STDDEV_SAMP(step) OVER ({_W} ROWS 2 PRECEDING), 0) AS rr_volatility FROM ts0""")
query("series_lags", OVER_KEY + "excitement_lag_1:d excitement_lag_2:d excitement_lag_3:d", "SELECT * FROM ts", "ts")(series)
query("series_rolling_means", OVER_KEY + "excitement_rolling_3:d excitement_rolling_5:d", "SELECT * FROM ts", "ts")(series)
query("series_tension", OVER_KEY + "cumulative_excitement:d match_tension_index:d", "SELECT * FROM ts", "ts")(series)
query("series_rr_volatility", OVER_KEY + "rr_volatility:d", "SELECT * FROM ts", "ts")(series)

_TIER = "CASE WHEN excitement_density >= p{peak} THEN 2500000 WHEN excitement_density >= p50 THEN 800000 ELSE 300000 END"


def _tier_sql(peak: int, over: str) -> str:
    rate = _TIER.format(peak=peak)
    return (
        f"SELECT *, {rate} AS ad_rate_per_30s, {rate} * 4 AS ad_rate_per_over, CASE WHEN excitement_density >= p{peak} THEN 1 ELSE 0 END AS is_peak_window "
        f"FROM (SELECT e.*, QUANTILE_CONT(excitement_density, 0.5) OVER ({over}) AS p50, QUANTILE_CONT(excitement_density, {peak / 100}) OVER ({over}) AS p{peak} FROM ex e)"
    )


TIERS = OVER_KEY + "ad_rate_per_30s:l ad_rate_per_over:l is_peak_window:i"


@query("ad_tiers", TIERS, _tier_sql(80, ""), "ex")
def _(spark, folder):
    return en.ad_tiers(excited(spark, folder))


@query("ad_tiers_p75", TIERS, _tier_sql(75, ""), "ex")
def _(spark, folder):
    return en.ad_tiers(excited(spark, folder), peak=0.75)


@query("ad_tiers_by_season", TIERS, _tier_sql(75, "PARTITION BY season"), "ex")
def _(spark, folder):
    return en.ad_tiers(excited(spark, folder), peak=0.75, season="season")


@query(
    "sequences", OVER_KEY + "first_value:d last_value:d next_1:d next_3:d length:i",
    f"""SELECT * FROM (SELECT *, LAG(excitement_normalised, 4) OVER w AS first_value, excitement_normalised AS last_value, LEAD(excitement_normalised, 1) OVER w AS next_1,
        LEAD(excitement_normalised, 3) OVER w AS next_3, 5 AS length, ROW_NUMBER() OVER w AS rn, COUNT(*) OVER (PARTITION BY match_id) AS n FROM ts WINDOW w AS ({_W})) WHERE rn >= 5 AND rn + 3 <= n""",
    "ts",
)
def _(spark, folder):
    s = en.sequences(series(spark, folder))
    return s.select(
        "*",
        F.col("x")[0][0].alias("first_value"),
        F.col("x")[4][0].alias("last_value"),
        F.col("y")[0].alias("next_1"),
        F.col("y")[2].alias("next_3"),
        F.size("x").alias("length"),
    )


@query(
    "split_by_group", "match_id:s split:s",
    f"SELECT DISTINCT match_id, CASE WHEN substr(md5(match_id), 1, 8) < '{int(0.7 * 2**32):08x}' THEN 'train' ELSE 'validation' END AS split FROM ov", "ov",
)
def _(spark, folder):
    return en.split_by_group(overs(spark, folder)).select("match_id", "split").distinct()


cte("nx", "ex", f"SELECT *, LEAD(excitement_normalised) OVER w AS next_1, LEAD(excitement_normalised, 2) OVER w AS next_2 FROM ex WINDOW w AS ({_W})")
_INPUTS = [(f, k) for f in en.SERIES_FEATURES for k in range(5)]
_P = len(_INPUTS)
cte("fr", "ts", f"""
SELECT *, CASE WHEN substr(md5(match_id), 1, 8) < '{int(0.7 * 2**32):08x}' THEN 'train' ELSE 'validation' END AS split, ROW_NUMBER() OVER w >= 5 AS whole,
  [{', '.join(f'COALESCE(LAG(COALESCE({f}, 0), {k}) OVER w, 0)::DOUBLE' for f, k in _INPUTS)}] AS x, [{', '.join(f'LEAD(excitement_normalised, {h}) OVER w' for h in (1, 2, 3))}] AS y FROM ts WINDOW w AS ({_W})""")
cte("fn", "fr", "SELECT h, x, y[h] AS y FROM fr, (SELECT unnest(range(1, 4)) AS h) WHERE split = 'train' AND whole AND y[h] IS NOT NULL")
cte("fa", "fn", f"SELECT h, i, j, COVAR_POP(x[i], x[j]) + CASE WHEN i = j THEN 1e-3::DOUBLE ELSE 0 END AS c FROM fn, (SELECT unnest(range(1, {_P + 1})) AS i), (SELECT unnest(range(1, {_P + 1})) AS j) GROUP BY h, i, j")
cte("fy", "fn", f"SELECT h, i, COVAR_POP(x[i], y) AS c, AVG(x[i]) AS mx, AVG(y) AS my FROM fn, (SELECT unnest(range(1, {_P + 1})) AS i) GROUP BY h, i")
# Conjugate gradients solve the normal equations: b the solution so far, r what is left of the right side, p the direction.
cte("fb", "fa fy", """
WITH RECURSIVE it AS (SELECT 0 AS k, h, i, 0::DOUBLE AS b, c AS r, c AS p FROM fy UNION ALL
  SELECT k + 1, h, i, b + al * p, r - al * ap, CASE WHEN rr > 1e-26 THEN r - al * ap + SUM((r - al * ap) * (r - al * ap)) OVER (PARTITION BY h) / rr * p ELSE 0 END FROM (
    SELECT *, CASE WHEN rr > 1e-26 THEN rr / SUM(p * ap) OVER (PARTITION BY h) ELSE 0 END AS al FROM (
      SELECT it.*, ap, SUM(r * r) OVER (PARTITION BY it.h) AS rr FROM it JOIN (SELECT a.h, a.i, SUM(a.c * v.p) AS ap FROM fa a JOIN it v ON a.h = v.h AND a.j = v.i GROUP BY a.h, a.i) m ON m.h = it.h AND m.i = it.i WHERE it.k < 300)))
SELECT h, MAX(my) - SUM(b * mx) AS b0, LIST(b ORDER BY i) AS b FROM it JOIN fy USING (h, i) WHERE k = 300 GROUP BY h""")
_AHEAD = ", ".join(f"CASE WHEN whole THEN (SELECT b0 + list_dot_product(fr.x, b) FROM fb WHERE h = {h}) ELSE 0 END AS predicted_excitement_t{h}" for h in (1, 2, 3))


@query("forecast", OVER_KEY + "predicted_excitement_t1:d predicted_excitement_t2:d predicted_excitement_t3:d split:s", f"SELECT *, {_AHEAD} FROM fr", "fr fb")
def _(spark, folder):
    return en.forecast(series(spark, folder))


@query("forecast_boosted", OVER_KEY + "predicted_excitement_t1:d predicted_excitement_t2:d predicted_excitement_t3:d split:s")
def _(spark, folder):
    return en.forecast(series(spark, folder), learner="gbt")


@query("naive_forecast", OVER_KEY + "predicted_excitement_t1:d", "SELECT *, excitement_normalised AS predicted_excitement_t1 FROM ex", "ex")
def _(spark, folder):
    return en.naive_forecast(excited(spark, folder))


@query(
    "forecast_error", "mse:d n:l",
    "SELECT AVG((next_1 - excitement_normalised) * (next_1 - excitement_normalised)) AS mse, COUNT(next_1) AS n FROM nx", "nx",
)
def _(spark, folder):
    return en.forecast_error(en.with_next(en.naive_forecast(excited(spark, folder))))


@query(
    "match_peak_window", OVER_KEY + "predicted_peak_window:b",
    "SELECT *, (next_1 + next_2) / 2 > QUANTILE_CONT(excitement_normalised, 0.8) OVER (PARTITION BY match_id) AS predicted_peak_window FROM nx", "nx",
)
def _(spark, folder):
    return en.match_peak_window(en.with_next(excited(spark, folder), 2), "next_1", "next_2")


cte("pk0", "ex", "SELECT *, CASE WHEN excitement_normalised > (SELECT QUANTILE_CONT(excitement_normalised, 0.8) FROM ex) THEN 1 ELSE 0 END AS is_peak_predicted FROM ex")
cte("pk1", "pk0", f"SELECT *, ROW_NUMBER() OVER ({_W}) - ROW_NUMBER() OVER (PARTITION BY match_id, is_peak_predicted ORDER BY innings, over_no, batting_team) AS isl FROM pk0")
cte("pk2", "pk1", "SELECT *, is_peak_predicted * ROW_NUMBER() OVER (PARTITION BY match_id, is_peak_predicted, isl ORDER BY innings, over_no, batting_team) AS peak_streak FROM pk1")
cte("pk", "pk2", "SELECT *, CASE WHEN peak_streak >= 2 THEN 1 ELSE 0 END AS engagement_window FROM pk2")


def detected(spark: SparkSession, folder: str) -> DataFrame:
    return en.peak_detect(excited(spark, folder))


query("peak_detect", OVER_KEY + "is_peak_predicted:i peak_streak:l engagement_window:i", "SELECT * FROM pk", "pk")(detected)


@query(
    "precision_at_1", "precision_at_1:d",
    "SELECT CAST(SUM(CASE WHEN engagement_window = 1 AND is_peak_predicted = 1 THEN 1 ELSE 0 END) AS DOUBLE) / GREATEST(SUM(is_peak_predicted), 1) AS precision_at_1 FROM pk", "pk",
)
def _(spark, folder):
    return en.precision_at_1(detected(spark, folder))


@query("revenue_uniform", "uniform_revenue:d", "SELECT COUNT(*) * 3200000 AS uniform_revenue FROM pk", "pk")
def _(spark, folder):
    return en.revenue_uniform(detected(spark, folder))


_GUIDED = "CASE WHEN engagement_window = 1 THEN 2500000 WHEN is_peak_predicted = 1 THEN 2000000 ELSE 800000 END"


@query("revenue_model_guided", "model_revenue:d", f"SELECT SUM({_GUIDED}) * 4 AS model_revenue FROM pk", "pk")
def _(spark, folder):
    return en.revenue_model_guided(detected(spark, folder))


cte("dr", "pk", f"""
SELECT simulation, SUM(guided) * 4 AS model_revenue, SUM(price) * 4 AS random_revenue, COUNT(*) * 3200000 AS uniform_revenue FROM (
  SELECT simulation, {_GUIDED} AS guided, CASE WHEN h < '55555555' THEN 2500000 WHEN h < 'aaaaaaaa' THEN 800000 ELSE 300000 END AS price FROM (
    SELECT s.simulation, pk.*, substr(md5(concat_ws(':', CAST(s.simulation AS VARCHAR), match_id, CAST(innings AS VARCHAR), CAST(over_no AS VARCHAR), batting_team)), 1, 8) AS h
    FROM pk, (SELECT unnest(range(1, 51)) AS simulation) s)) GROUP BY simulation""")


@query(
    "revenue_draws", "simulation:i model_revenue:d random_revenue:d uniform_revenue:d uplift_vs_random:d uplift_vs_uniform:d",
    "SELECT *, model_revenue - random_revenue AS uplift_vs_random, model_revenue - uniform_revenue AS uplift_vs_uniform FROM dr", "dr",
)
def _(spark, folder):
    return en.revenue_draws(detected(spark, folder))


_PCT = ", ".join(f"QUANTILE_CONT(model_revenue - random_revenue, {p / 100}) / 1e7 AS uplift_p{p}_cr" for p in (5, 25, 50, 75, 95))


@query(
    "revenue_resample",
    "mean_model_revenue_cr:d mean_random_revenue_cr:d mean_uniform_revenue_cr:d mean_uplift_vs_random_cr:d mean_uplift_vs_uniform_cr:d uplift_p5_cr:d uplift_p25_cr:d uplift_p50_cr:d uplift_p75_cr:d uplift_p95_cr:d",
    "SELECT AVG(model_revenue) / 1e7 AS mean_model_revenue_cr, AVG(random_revenue) / 1e7 AS mean_random_revenue_cr, AVG(uniform_revenue) / 1e7 AS mean_uniform_revenue_cr, "
    f"AVG(model_revenue - random_revenue) / 1e7 AS mean_uplift_vs_random_cr, AVG(model_revenue - uniform_revenue) / 1e7 AS mean_uplift_vs_uniform_cr, {_PCT} FROM dr",
    "dr",
)
def _(spark, folder):
    return en.revenue_resample(detected(spark, folder))


cte("hz", "ex", f"""
SELECT *, QUANTILE_CONT(excitement_normalised, 0.8) OVER (PARTITION BY match_id) AS peak_threshold,
  ROW_NUMBER() OVER (PARTITION BY match_id ORDER BY excitement_normalised DESC, innings, over_no, batting_team) AS zone_rank, FIRST_VALUE(batting_team) OVER ({_W}) AS team1 FROM ex""")


@query(
    "hot_zone_overs", OVER_KEY + "excitement_normalised:d peak_threshold:d zone_rank:i",
    "SELECT * FROM hz WHERE excitement_normalised > peak_threshold", "hz",
)
def _(spark, folder):
    return en.hot_zone_overs(excited(spark, folder))


@query(
    "hot_zones", "match_id:s team1:s total_overs:l peak_overs:l peak_threshold:d estimated_ad_revenue_cr:d top_zones:s",
    """SELECT match_id, ANY_VALUE(team1) AS team1, COUNT(*) AS total_overs, SUM(CASE WHEN excitement_normalised > peak_threshold THEN 1 ELSE 0 END) AS peak_overs, ANY_VALUE(peak_threshold) AS peak_threshold,
       SUM(CASE WHEN excitement_normalised > peak_threshold THEN 10000000 ELSE 3200000 END) / 1e7 AS estimated_ad_revenue_cr,
       string_agg(CASE WHEN zone_rank <= 5 THEN CAST(innings AS VARCHAR) || '.' || CAST(over_no AS VARCHAR) END, ',' ORDER BY zone_rank) AS top_zones FROM hz GROUP BY match_id""",
    "hz",
)
def _(spark, folder):
    z = en.hot_zones(excited(spark, folder))
    text = F.transform("top_zones", lambda t: F.concat(t["innings"].cast("string"), F.lit("."), t["over"].cast("string")))
    return z.withColumn("top_zones", F.concat_ws(",", text))


@query(
    "engagement_summary", "n_matches:l n_overs:l mean_excitement:d peak_window_fraction:d",
    "SELECT COUNT(DISTINCT match_id) AS n_matches, COUNT(*) AS n_overs, AVG(excitement_density) AS mean_excitement, AVG(engagement_window) AS peak_window_fraction FROM pk", "pk",
)
def _(spark, folder):
    return en.engagement_summary(detected(spark, folder))


@query("timeline", OVER_KEY + "excitement_density:d excitement_normalised:d runs_scored:l wickets:l", "SELECT * FROM ex WHERE match_id = 'M1'", "ex")
def _(spark, folder):
    return en.timeline(excited(spark, folder), "M1")


@query(
    "top_overs", OVER_KEY + "excitement_density:d runs_scored:l wickets:l boundaries:l",
    "SELECT * FROM ex ORDER BY excitement_density DESC, match_id, innings, over_no, batting_team LIMIT 5", "ex",
)
def _(spark, folder):
    return en.top_overs(excited(spark, folder))


@query(
    "describe_excitement", "count:l mean:d std:d min:d p25:d p50:d p75:d max:d",
    "SELECT COUNT(*) AS count, AVG(excitement_density) AS mean, STDDEV_SAMP(excitement_density) AS std, MIN(excitement_density) AS min, QUANTILE_CONT(excitement_density, 0.25) AS p25, "
    "QUANTILE_CONT(excitement_density, 0.5) AS p50, QUANTILE_CONT(excitement_density, 0.75) AS p75, MAX(excitement_density) AS max FROM ex",
    "ex",
)
def _(spark, folder):
    return agg.describe(excited(spark, folder), "excitement_density")
