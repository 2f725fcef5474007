"""Queries on player profiles, clusters and selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.functions.scan import hot_groups
from stumpline.operators import clusters as cl
from stumpline.operators import profile as pr
from stumpline.operators import selection as sel
from stumpline.plans import bridge
from stumpline.plans.queries_delivery import big_innings, context, legacy, states
from stumpline.plans.registry import cte, query
from stumpline.session import stored
from stumpline.sources import store

# --- profile from deliveries ----------------------------------------------------------------------


def _sr(cond: str) -> str:
    return (
        f"CAST(SUM(CASE WHEN {cond} AND legal = 1 THEN runs_off_bat ELSE 0 END) AS DOUBLE) / "
        f"GREATEST(SUM(CASE WHEN {cond} AND legal = 1 THEN 1 ELSE 0 END), 1) * 100"
    )


_COLLAPSE = (
    "CAST(SUM(CASE WHEN wickets6 >= 2 THEN runs_off_bat ELSE 0 END) AS DOUBLE) / "
    "GREATEST(SUM(CASE WHEN wickets6 >= 2 THEN legal ELSE 0 END), 1) * 100"
)
_CHASE = "(innings = 2 AND COALESCE(required_run_rate > 10, FALSE))"
_HIGH = "COALESCE(required_run_rate > 12, FALSE)"
_SPIN = "substr(bowler, length(bowler), 1) IN ('a', 'e', 'i', 'o', 'u')"
cte("prof0", "st", """
SELECT *, LAG(dot) OVER s AS prev_dot, LAG(over_bnd) OVER s AS prev_bnd FROM (
  SELECT *, MAX(bnd) OVER (PARTITION BY striker, match_id, innings, over_no) AS over_bnd FROM st)
WINDOW s AS (PARTITION BY striker ORDER BY match_id, innings, over_no, ball, seq)""")
cte("prof", "prof0", f"""
SELECT striker AS player, COUNT(DISTINCT match_id) AS appearances, SUM(legal) AS total_balls_faced, SUM(runs_off_bat) AS total_runs,
  {_sr('over_no >= 16')} AS death_overs_sr, {_sr(_CHASE)} AS chase_pressure_sr, {_COLLAPSE} AS wickets_fallen_pressure_avg,
  CAST(SUM(bnd * runs_off_bat) AS DOUBLE) / GREATEST(SUM(runs_off_bat), 1) AS boundary_dependency,
  {_sr('prev_dot = 1')} AS dot_ball_recovery_rate, {_sr(_HIGH)} AS high_rr_required_performance,
  CAST(SUM(CASE WHEN over_no >= 16 AND innings = 2 AND legal = 1 THEN bnd ELSE 0 END) AS DOUBLE) / GREATEST(SUM(CASE WHEN over_no >= 16 AND innings = 2 THEN legal ELSE 0 END), 1) AS clutch_boundary_rate,
  {_COLLAPSE} AS collapse_resistance_score,
  CASE WHEN SUM(CASE WHEN over_no >= 16 OR {_CHASE} OR {_HIGH} THEN 1 ELSE 0 END) > 5
    THEN STDDEV_POP(CASE WHEN over_no >= 16 OR {_CHASE} OR {_HIGH} THEN runs_off_bat END) ELSE 0.5 END AS pressure_consistency,
  {_sr(_SPIN)} AS spin_pressure_sr, {_sr('NOT ' + _SPIN)} AS pace_pressure_sr, {_sr('prev_bnd = 1')} AS momentum_shift_response,
  CAST(SUM(runs_off_bat) AS DOUBLE) / GREATEST(SUM(legal), 1) * 100 AS overall_sr
FROM prof0 GROUP BY striker HAVING SUM(legal) >= 10""")
HEAD = "player:s appearances:l total_balls_faced:l total_runs:l "


def profiles(spark: SparkSession, folder: str) -> DataFrame:
    strikers = hot_groups(bridge.deliveries(spark, folder), ["striker"])
    return pr.pressure_profile(
        states(spark, folder), hot=big_innings(spark, folder), hot_strikers=strikers
    )


query("pressure_profile", HEAD + " ".join(f"{f}:d" for f in pr.PROFILE_FEATURES) + " overall_sr:d", "SELECT * FROM prof", "prof")(profiles)
for _f in pr.PROFILE_FEATURES:
    query(f"profile_{_f}", f"player:s {_f}:d", "SELECT * FROM prof", "prof")(profiles)


@query(
    "profile_bowler_types", "player:s spin_pressure_sr:d pace_pressure_sr:d",
    f"SELECT striker AS player, {_sr('seq_class = 1')} AS spin_pressure_sr, {_sr('seq_class = 0')} AS pace_pressure_sr FROM ("
    "SELECT *, CASE WHEN ascii(substr(bowler, 8, 1)) % 2 = 0 THEN 1 ELSE 0 END AS seq_class FROM prof0) GROUP BY striker HAVING SUM(legal) >= 10",
    "prof0",
)
def _(spark, folder):
    d = states(spark, folder)
    kinds = d.select("bowler").distinct().withColumn("is_spin", F.ascii(F.substring("bowler", 8, 1)) % 2 == 0)
    return pr.pressure_profile(d, bowler_types=kinds)


@query(
    "pressure_over_events", "seq:l match_id:s innings:i over:i is_pressure_over:b",
    "SELECT l.seq, l.match_id, l.innings, l.over_no, EXISTS (SELECT 1 FROM cx WHERE cx.match_id = l.match_id AND cx.innings = l.innings AND cx.over_no = l.over_no AND pressure_ball) AS is_pressure_over FROM lg l",
    "lg cx",
)
def _(spark, folder):
    return pr.in_pressure_over(legacy(spark, folder), context(spark, folder))


cte("pf0", "lg cx", """
SELECT l.*, EXISTS (SELECT 1 FROM cx WHERE cx.match_id = l.match_id AND cx.innings = l.innings AND cx.over_no = l.over_no AND pressure_ball) OR over_no >= 16 AS hot FROM lg l""")
cte("pf1", "pf0", """
SELECT batter AS player, COUNT(DISTINCT match_id) AS appearances, SUM(runs) AS total_runs, SUM(legal) AS total_balls_faced,
  SUM(CASE WHEN hot THEN runs ELSE 0 END) AS pr, SUM(CASE WHEN hot THEN legal ELSE 0 END) AS pb, SUM(CASE WHEN hot THEN is_wicket ELSE 0 END) AS pw,
  SUM(CASE WHEN hot AND runs = 0 THEN legal ELSE 0 END) AS pd, SUM(CASE WHEN hot AND runs >= 4 AND is_wide = 0 THEN 1 ELSE 0 END) AS pf,
  CAST(SUM(CASE WHEN NOT hot THEN runs ELSE 0 END) AS DOUBLE) / GREATEST(SUM(CASE WHEN NOT hot THEN legal ELSE 0 END), 1) * 100 AS calm,
  STDDEV_POP(CASE WHEN legal = 1 THEN runs END) AS sd FROM pf0 GROUP BY batter HAVING SUM(legal) >= 5""")
cte("pf2", "pf1", """
SELECT *, CAST(total_runs AS DOUBLE) / GREATEST(total_balls_faced, 1) * 100 AS strike_rate, CASE WHEN pb > 0 THEN CAST(pr AS DOUBLE) / pb * 100 ELSE 0 END AS pressure_sr,
  CASE WHEN pb > 0 THEN CAST(pd AS DOUBLE) / pb ELSE 0.5 END AS pressure_dot_pct, CASE WHEN pb > 0 THEN CAST(pf AS DOUBLE) / pb ELSE 0 END AS pressure_boundary_pct,
  CASE WHEN pb > 0 THEN CAST(pw AS DOUBLE) / pb ELSE 0 END AS pressure_dismissal_rate, CASE WHEN total_balls_faced > 1 THEN sd ELSE 0.5 END AS consistency_index,
  CASE WHEN pb > 0 THEN pr - calm * pb / 100 ELSE 0 END AS clutch_runs_above_expected, CASE WHEN pb > 0 THEN calm - CAST(pr AS DOUBLE) / pb * 100 ELSE 0 END AS performance_decay_slope FROM pf1""")
cte("pf", "pf2", """
SELECT *, CASE WHEN pressure_sr > 140 AND pressure_dot_pct < 0.35 AND pressure_dismissal_rate < 0.12 AND performance_decay_slope > -20 THEN 'Ice-blooded finisher'
  WHEN pressure_sr < 100 OR pressure_dot_pct > 0.55 THEN 'Pressure crumbler' WHEN pressure_sr BETWEEN 100 AND 135 AND pressure_dismissal_rate < 0.10 THEN 'Steady accumulator'
  ELSE 'Panic scorer' END AS known_archetype, 0 AS venue_pressure_delta, 0 AS vs_pace_pressure_sr, 0 AS vs_spin_pressure_sr, 0 AS late_innings_fatigue_index, 1 AS high_stakes_match_multiplier FROM pf2""")


@query(
    "derive_pressure_features",
    HEAD + "strike_rate:d pressure_sr:d pressure_dot_pct:d pressure_boundary_pct:d pressure_dismissal_rate:d consistency_index:d clutch_runs_above_expected:d performance_decay_slope:d",
    "SELECT * FROM pf", "pf",
)
def _(spark, folder):
    return pr.derive_pressure_features(legacy(spark, folder))


@query("row_archetype", "player:s known_archetype:s", "SELECT * FROM pf", "pf")
def _(spark, folder):
    return pr.derive_pressure_features(legacy(spark, folder))


@query(
    "pressure_features",
    " ".join(f"{c}:{'s' if c in ('player', 'known_archetype') else 'd'}" for c in pr.PRESSURE_COLUMNS),
    "SELECT * FROM pf", "pf",
)
def _(spark, folder):
    return pr.pressure_features(legacy(spark, folder))


# --- clusters over the embeddings, label as the cluster -------------------------------------------

F64 = [f"f{i}" for i in range(1, 65)]
cte("v", "", "SELECT 'V' || CAST(vec_id AS VARCHAR) AS player, vec_id, label AS cluster, " + ", ".join(
    f"CAST(embedding[{i}] AS DOUBLE) AS f{i}" for i in range(1, 65)) + " FROM embeddings")
cte("vl", "", "SELECT 'V' || CAST(vec_id AS VARCHAR) AS player, vec_id, label AS cluster, i, CAST(embedding[i] AS DOUBLE) AS x FROM embeddings, (SELECT unnest(range(1, 65)) AS i) r")
cte("cen", "vl", "SELECT cluster, i, AVG(x) AS m, COUNT(*) AS n FROM vl GROUP BY cluster, i")


@query(
    "standardise_features", "player:s " + " ".join(f"{f}:d" for f in F64),
    "SELECT player, " + ", ".join(f"({f} - AVG({f}) OVER ()) / STDDEV_POP({f}) OVER () AS {f}" for f in F64) + " FROM v", "v",
)
def _(spark, folder):
    df, _ = bridge.vectors(spark, folder)
    return cl.standardise(df.select("player", *F64), F64)


@query("centroid_profile", "cluster:i " + " ".join(f"{f}:d" for f in F64), "SELECT cluster, " + ", ".join(f"AVG({f}) AS {f}" for f in F64) + " FROM v GROUP BY cluster", "v")
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.centroid_profile(df, names)


@query(
    "silhouette", "silhouette:d",
    """SELECT AVG(CASE WHEN n = 1 THEN 0 ELSE (b - a) / GREATEST(a, b) END) AS silhouette FROM (
      SELECT player, MAX(CASE WHEN same THEN n END) AS n, MAX(CASE WHEN same THEN total / (n - 1) END) AS a, MIN(CASE WHEN NOT same THEN total / n END) AS b FROM (
        SELECT p.player, p.cluster = q.cluster AS same, q.cluster, COUNT(*) AS n, SUM(list_sum(list_transform(list_zip(p.e, q.e), lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2])))) AS total
        FROM (SELECT vec_id AS player, label AS cluster, embedding AS e FROM embeddings) p, (SELECT label AS cluster, embedding AS e FROM embeddings) q GROUP BY p.player, p.cluster = q.cluster, q.cluster) GROUP BY player)""",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.silhouette(df, names)


@query(
    "silhouette_euclidean", "silhouette:d",
    """SELECT AVG(CASE WHEN n = 1 THEN 0 ELSE (b - a) / GREATEST(a, b) END) AS silhouette FROM (
      SELECT player, MAX(CASE WHEN same THEN n END) AS n, MAX(CASE WHEN same THEN total / (n - 1) END) AS a, MIN(CASE WHEN NOT same THEN total / n END) AS b FROM (
        SELECT p.player, p.cluster = q.cluster AS same, q.cluster, COUNT(*) AS n, SUM(SQRT(list_sum(list_transform(list_zip(p.e, q.e), lambda z: (CAST(z[1] AS DOUBLE) - z[2]) * (CAST(z[1] AS DOUBLE) - z[2]))))) AS total
        FROM (SELECT vec_id AS player, label AS cluster, embedding AS e FROM embeddings) p, (SELECT label AS cluster, embedding AS e FROM embeddings) q GROUP BY p.player, p.cluster = q.cluster, q.cluster) GROUP BY player)""",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.silhouette_euclidean(df, names)


@query(
    "calinski_harabasz", "calinski_harabasz:d",
    """SELECT bt * (n - k) / (wt * (k - 1)) AS calinski_harabasz FROM (
      SELECT (SELECT COUNT(*) FROM embeddings) AS n, (SELECT COUNT(DISTINCT label) FROM embeddings) AS k,
        (SELECT SUM(c.n * (c.m - g.m) * (c.m - g.m)) FROM cen c JOIN (SELECT i, AVG(x) AS m FROM vl GROUP BY i) g USING (i)) AS bt,
        (SELECT SUM((vl.x - c.m) * (vl.x - c.m)) FROM vl JOIN cen c USING (cluster, i)) AS wt)""",
    "cen vl",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.calinski_harabasz(df, names)


@query(
    "davies_bouldin", "davies_bouldin:d",
    """SELECT AVG(w) AS davies_bouldin FROM (
      SELECT a.cluster, MAX((a.s + b.s) / g.gap) AS w FROM sp a JOIN sp b ON a.cluster <> b.cluster
      JOIN (SELECT p.cluster AS ca, q.cluster AS cb, SQRT(SUM((p.m - q.m) * (p.m - q.m))) AS gap FROM cen p JOIN cen q USING (i) GROUP BY p.cluster, q.cluster) g ON g.ca = a.cluster AND g.cb = b.cluster
      GROUP BY a.cluster)""",
    "sp cen",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.davies_bouldin(df, names)


cte("sp", "vl cen", "SELECT cluster, AVG(d) AS s FROM (SELECT cluster, player, SQRT(SUM((x - m) * (x - m))) AS d FROM vl JOIN cen USING (cluster, i) GROUP BY cluster, player) GROUP BY cluster")


@query(
    "feature_separation", "feature:s between_cluster_var:d",
    "SELECT 'f' || CAST(i AS VARCHAR) AS feature, VAR_POP(m) AS between_cluster_var FROM cen GROUP BY i", "cen",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.feature_separation(df, names)


_CENTER_COLS = "pressure_sr:d pressure_dot_pct:d pressure_dismissal_rate:d performance_decay_slope:d clutch_runs_above_expected:d"
_ABS = ("pressure_sr", "pressure_dot_pct", "pressure_dismissal_rate", "performance_decay_slope", "clutch_runs_above_expected")


@query(
    "name_archetypes_absolute", "cluster:i archetype:s " + _CENTER_COLS,
    """SELECT *, CASE WHEN pressure_sr > 135 AND pressure_dot_pct < 0.4 AND pressure_dismissal_rate < 0.12 AND performance_decay_slope > -0.3 AND clutch_runs_above_expected > 0 THEN 'Ice-blooded finisher'
       WHEN pressure_sr < 115 OR pressure_dot_pct > 0.5 THEN 'Pressure crumbler' WHEN pressure_dismissal_rate < 0.1 AND ABS(performance_decay_slope) < 0.5 THEN 'Steady accumulator' ELSE 'Panic scorer' END AS archetype
       FROM (SELECT length(player) AS cluster, """ + ", ".join(f"AVG({c}) AS {c}" for c in _ABS) + " FROM pf GROUP BY length(player))",
    "pf",
)
def _(spark, folder):
    df = pr.derive_pressure_features(legacy(spark, folder)).withColumn("cluster", F.length("player"))
    return cl.name_archetypes_absolute(cl.centroid_profile(df, _ABS))


_Q = ", ".join(
    f"QUANTILE_CONT({c}, {q / 100}) OVER () AS {r}{q}" for r, c in (("d", "f1"), ("c", "f2"), ("b", "f3"), ("r", "f4")) for q in (25, 50, 75)
)


@query(
    "name_archetypes_quantile", "cluster:i archetype:s",
    f"""SELECT cluster, CASE WHEN f1 >= d75 AND f2 >= c75 AND f3 >= b75 THEN 'Ice Finisher' WHEN f1 <= d25 AND f3 <= b25 THEN 'Risk Stabilizer'
        WHEN f1 >= d75 AND f3 <= b25 AND f4 >= r75 THEN 'Collapse Anchor' WHEN f1 >= d75 AND f3 >= b75 THEN 'Power Enforcer'
        WHEN f1 >= d50 AND f2 >= c50 AND f3 <= b50 THEN 'Chaos Accelerator' ELSE 'Situational Player' END AS archetype
        FROM (SELECT *, {_Q} FROM (SELECT cluster, AVG(f1) AS f1, AVG(f2) AS f2, AVG(f3) AS f3, AVG(f4) AS f4 FROM v GROUP BY cluster))""",
    "v",
)
def _(spark, folder):
    df, _ = bridge.vectors(spark, folder)
    return cl.name_archetypes_quantile(cl.centroid_profile(df, F64[:4]), "f1", "f2", "f3", "f4")


@query(
    "name_archetypes_counts", "cluster:i high_count:l low_count:l archetype:s",
    """SELECT cluster, high_count, low_count, CASE WHEN n = 0 THEN 'Unclassified' WHEN high_count >= n * 0.6 THEN 'Ice Finisher' WHEN low_count >= n * 0.6 THEN 'Risk Stabilizer'
       WHEN high_count >= n * 0.4 THEN 'Power Enforcer' WHEN high_count >= n * 0.2 AND low_count < n * 0.3 THEN 'Collapse Anchor' WHEN high_count >= n * 0.25 THEN 'Chaos Accelerator' ELSE 'Situational Player' END AS archetype
       FROM (SELECT cluster, SUM(CASE WHEN sd > 0 THEN 1 ELSE 0 END) AS n, SUM(CASE WHEN sd > 0 AND m >= q75 THEN 1 ELSE 0 END) AS high_count, SUM(CASE WHEN sd > 0 AND m <= q25 THEN 1 ELSE 0 END) AS low_count FROM (
         SELECT *, STDDEV_SAMP(m) OVER (PARTITION BY i) AS sd, QUANTILE_CONT(m, 0.75) OVER (PARTITION BY i) AS q75, QUANTILE_CONT(m, 0.25) OVER (PARTITION BY i) AS q25 FROM cen) GROUP BY cluster)""",
    "cen",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    return cl.name_archetypes_counts(cl.centroid_profile(df, names), names)


@query(
    "archetype_summary", "cluster:i archetype:s size:l members:s",
    """SELECT cluster, 'label ' || CAST(cluster AS VARCHAR) AS archetype, MAX(size) AS size, string_agg(player, ',' ORDER BY player) AS members FROM (
       SELECT cluster, player, COUNT(*) OVER (PARTITION BY cluster) AS size, ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY player) AS rn FROM v) WHERE rn <= 10 GROUP BY cluster""",
    "v",
)
def _(spark, folder):
    df, _ = bridge.vectors(spark, folder)
    named = df.withColumn("archetype", F.concat(F.lit("label "), F.col("cluster").cast("string")))
    return cl.archetype_summary(named).withColumn("members", F.concat_ws(",", "members"))


# --- fitted clusters, on the pressure profiles ------------------------------------------------------

cte("pz", "prof", "SELECT player, i, CASE WHEN STDDEV_POP(x) OVER (PARTITION BY i) > 0 THEN (x - AVG(x) OVER (PARTITION BY i)) / STDDEV_POP(x) OVER (PARTITION BY i) ELSE 0 END AS z FROM (" + " UNION ALL ".join(
    f"SELECT player, {i} AS i, COALESCE({f}, 0)::DOUBLE AS x FROM prof" for i, f in enumerate(pr.PROFILE_FEATURES)) + ")")
cte("pcc1", "pz", "SELECT a.i, b.i AS j, AVG(a.z * b.z) AS x FROM pz a JOIN pz b USING (player) GROUP BY a.i, b.i")
for _k in (1, 2, 3):
    # Squaring a matrix again and again leaves the first axis; what it explains is taken out for the next.
    cte(f"pca{_k}", f"pcc{_k}", f"""
WITH RECURSIVE it AS (SELECT 0 AS k, i, j, x / (SELECT SUM(x) FROM pcc{_k} WHERE i = j) AS x FROM pcc{_k} UNION ALL
  SELECT MAX(a.k) + 1, a.i, b.j, SUM(a.x * b.x) / (SELECT SUM(x * x) FROM it) FROM it a JOIN it b ON a.j = b.i WHERE a.k < 16 GROUP BY a.i, b.j)
SELECT i, j, x FROM it WHERE k = 16""")
    cte(f"pcl{_k}", f"pca{_k}", f"SELECT m.i, m.x / SQRT(d.x) AS pc{_k} FROM pca{_k} m JOIN (SELECT i, x FROM pca{_k} WHERE i = j ORDER BY x DESC LIMIT 1) d ON m.j = d.i")
    cte(f"pcv{_k}", f"pcc{_k} pca{_k} pcc1", f"SELECT 'pc{_k}' AS axis, SUM(c.x * m.x) AS v, SUM(c.x * m.x) / (SELECT SUM(x) FROM pcc1 WHERE i = j) AS explained_variance_ratio FROM pcc{_k} c JOIN pca{_k} m USING (i, j)")
    cte(f"pcc{_k + 1}", f"pcc{_k} pca{_k} pcv{_k}", f"SELECT c.i, c.j, c.x - v * m.x AS x FROM pcc{_k} c JOIN pca{_k} m USING (i, j), pcv{_k}")
_AXES = "pcl1 JOIN pcl2 USING (i) JOIN pcl3 USING (i)"


def _profiled(spark, folder):
    return profiles(spark, folder).select("player", *pr.PROFILE_FEATURES).na.fill(0.0)


def _fit(spark, folder, k=4):
    return cl.fit_clusters(_profiled(spark, folder), pr.PROFILE_FEATURES, k=k)


@query("pca_scores", "player:s pc1:d pc2:d pc3:d", f"SELECT player, SUM(z * pc1) AS pc1, SUM(z * pc2) AS pc2, SUM(z * pc3) AS pc3 FROM pz JOIN {_AXES} USING (i) GROUP BY player", "pz pcl1 pcl2 pcl3")
def _(spark, folder):
    return _fit(spark, folder).labelled


@query("pca_loadings", "feature:s pc1:d pc2:d pc3:d", f"SELECT ([{', '.join(repr(f) for f in pr.PROFILE_FEATURES)}])[i + 1] AS feature, pc1, pc2, pc3 FROM {_AXES}", "pcl1 pcl2 pcl3")
def _(spark, folder):
    fit = _fit(spark, folder)
    return cl.pca_loadings(fit.labelled, fit.projection)


@query("pca_variance", "axis:s explained_variance_ratio:d", "SELECT * FROM pcv1 UNION ALL SELECT * FROM pcv2 UNION ALL SELECT * FROM pcv3", "pcv1 pcv2 pcv3")
def _(spark, folder):
    fit = _fit(spark, folder)
    return cl.pca_variance(fit.labelled, fit.projection)


@query("kmeans_clusters", "player:s cluster:i")
def _(spark, folder):
    return _fit(spark, folder).labelled


@query("sweep_k", "k:i silhouette:d inertia:d is_best:b")
def _(spark, folder):
    z = cl.standardise(_profiled(spark, folder), pr.PROFILE_FEATURES)
    projection = cl.fit_pca(z, pr.PROFILE_FEATURES)
    return cl.sweep_k(projection.apply(z), projection.axes)


def _compatibility(spark, folder):
    df = stored(pr.pressure_features(legacy(spark, folder)), "pressure")
    used = [f for f in pr.PRESSURE_FEATURES if f not in ("venue_pressure_delta", "vs_pace_pressure_sr", "vs_spin_pressure_sr", "late_innings_fatigue_index", "high_stakes_match_multiplier")]
    fit = cl.fit_clusters(df, used, k=3)
    return sel.compatibility_scores(fit, df, rrr=11.0, wickets_left=3, is_chase=True)


query("compatibility_score", "player:s cluster:i compatibility:d")(_compatibility)


@query("rank_by_compatibility", "player:s compatibility:d")
def _(spark, folder):
    scored = stored(_compatibility(spark, folder), "scored")
    best = scored.orderBy(F.desc("compatibility"), "player").limit(1).select("player")
    return sel.rank_by_compatibility(scored, 3, exclude=best)


@query("saved_model_clusters", "player:s cluster:i")
def _(spark, folder):
    """Clusters by a pipeline of scaling, projection and centres that went through storage."""
    df = _profiled(spark, folder)
    path = f"{bridge.shared_folder(spark)}/clusters"
    store.save_model(cl.fit_clusters(df, pr.PROFILE_FEATURES, k=4).pipeline, path)
    return store.load_pipeline(path).transform(df)


# --- selection ------------------------------------------------------------------------------------


@query(
    "similar_players", "target:s player:s similarity:d rank:i",
    """SELECT target, player, similarity, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY target ORDER BY similarity DESC, player) AS rank FROM (
      SELECT t.player AS target, p.player, list_dot_product(p.e, t.e) / SQRT(list_dot_product(p.e, p.e) * list_dot_product(t.e, t.e)) AS similarity
      FROM (SELECT 'V' || CAST(vec_id AS VARCHAR) AS player, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) p,
        (SELECT 'V' || CAST(vec_id AS VARCHAR) AS player, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IN (SELECT MIN(vec_id) FROM embeddings GROUP BY label)) t
      WHERE p.player <> t.player)) WHERE rank <= 5""",
)
def _(spark, folder):
    df, names = bridge.vectors(spark, folder)
    first = (
        bridge.table(spark, folder, "embeddings")
        .groupBy("label")
        .agg(F.min("vec_id").alias("v"))
        .select(F.concat(F.lit("V"), F.col("v").cast("string")).alias("player"))
    )
    return sel.similar_players(df, names, first, 5)


def _norm(f: str) -> str:
    return f"({f} - MIN({f}) OVER ()) / CASE WHEN MAX({f}) OVER () > MIN({f}) OVER () THEN MAX({f}) OVER () - MIN({f}) OVER () ELSE 1 END"


cte("pn", "prof", "SELECT *, " + ", ".join(f"{_norm(f)} AS {f}_norm" for f in pr.PROFILE_FEATURES) + " FROM prof")


@query("minmax_normalise", "player:s " + " ".join(f"{f}_norm:d" for f in pr.PROFILE_FEATURES), "SELECT * FROM pn", "pn")
def _(spark, folder):
    return sel.minmax_normalise(profiles(spark, folder), pr.PROFILE_FEATURES)


@query(
    "compare_players", "feature:s value_a:d value_b:d",
    "SELECT a.feature, a.value AS value_a, b.value AS value_b FROM (UNPIVOT (SELECT " + ", ".join(f"{f}_norm AS {f}" for f in pr.PROFILE_FEATURES)
    + " FROM pn WHERE player = 'P0') ON * INTO NAME feature VALUE value) a JOIN (UNPIVOT (SELECT " + ", ".join(f"{f}_norm AS {f}" for f in pr.PROFILE_FEATURES)
    + " FROM pn WHERE player = 'P1') ON * INTO NAME feature VALUE value) b USING (feature)",
    "pn",
)
def _(spark, folder):
    return sel.compare_players(profiles(spark, folder), pr.PROFILE_FEATURES, "P0", "P1")


def _weights(name: str) -> str:
    w = sel.SITUATION_WEIGHTS[name]
    total = sum(w.values())
    return " + ".join(f"{f}_norm * {v / total:.17e}" for f, v in w.items())


@query(
    "rank_for_situation", "situation:s player:s compatibility:d rank:i",
    "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY situation ORDER BY compatibility DESC, player) AS rank FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS situation, player, {_weights(s)} AS compatibility FROM pn" for s in sel.SITUATION_WEIGHTS)
    + ")) WHERE rank <= 3",
    "pn",
)
def _(spark, folder):
    return sel.rank_for_situation(profiles(spark, folder), pr.PROFILE_FEATURES)


_LATE, _FEW, _HIGH = "overs_left <= 6", "wickets_left <= 5", "rrr > 8"
_DYN = {
    "death_overs_sr": f"CASE WHEN {_LATE} THEN 0.30 WHEN rrr > 6 THEN 0.20 ELSE 0.10 END", "chase_pressure_sr": f"CASE WHEN {_HIGH} THEN 0.30 ELSE 0.15 END",
    "clutch_boundary_rate": f"CASE WHEN {_HIGH} THEN 0.20 ELSE 0.10 END", "boundary_dependency": f"CASE WHEN {_HIGH} AND NOT {_FEW} THEN 0.10 ELSE 0.05 END",
    "dot_ball_recovery_rate": f"CASE WHEN {_FEW} THEN 0.15 ELSE 0.10 END", "pressure_consistency": f"CASE WHEN {_LATE} THEN 0.05 ELSE 0.15 END",
}


def _dynamic(states: str, n: int) -> str:
    made = ", ".join(f"({w})::DOUBLE AS w{i}" for i, w in enumerate(_DYN.values()))
    total = " + ".join(f"w{i}" for i in range(len(_DYN)))
    score = " + ".join(f"{f} * (w{i} / ({total}))" for i, f in enumerate(_DYN))
    return (
        f"SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY state_id ORDER BY compatibility DESC, player) AS rank FROM ("
        f"SELECT state_id, player, overall_sr, ({score}) / (SELECT MAX(overall_sr) FROM prof) AS compatibility FROM prof, (SELECT state_id, {made} FROM {states}))) WHERE rank <= {n}"
    )


_RANKED = "player:s overall_sr:d compatibility:d"


@query("rank_dynamic_weights", _RANKED, _dynamic("(SELECT 'a' AS state_id, 10.5::DOUBLE AS rrr, 4 AS wickets_left, 4 AS overs_left)", 5), "prof")
def _(spark, folder):
    asked = spark.createDataFrame([("a", 10.5, 4.0, 4.0)], "state_id string, required_run_rate double, wickets_left double, overs_left double")
    return sel.rank_dynamic(profiles(spark, folder), asked)


cte("rs", "os", """
SELECT concat_ws('-', match_id, innings, over_no) AS state_id, required_run_rate AS rrr, wickets_remaining AS wickets_left, overs_remaining AS overs_left, innings = 2 AS chase FROM os""")
_NAME = "CASE WHEN chase AND overs_left <= 4 AND rrr > 10 THEN 'death_chase' WHEN chase AND rrr > 8 THEN 'high_chase' WHEN wickets_left <= 5 THEN 'collapse' ELSE 'default' END"


def _over_situations(spark, folder):
    """Every over's state as a situation."""
    from stumpline.plans.queries_decision import over_states

    return over_states(spark, folder).select(
        F.concat_ws("-", "match_id", "innings", "over").alias("state_id"), "required_run_rate", F.col("wickets_remaining").alias("wickets_left"),
        F.col("overs_remaining").alias("overs_left"), (F.col("innings") == 2).alias("is_chase"),
    )


@query("rank_dynamic_states", f"state_id:s rank:i {_RANKED}", _dynamic("rs", 5), "prof rs d")
def _(spark, folder):
    return sel.rank_dynamic(profiles(spark, folder), _over_situations(spark, folder))


@query(
    "rank_for_states", "state_id:s situation:s player:s compatibility:d rank:i",
    f"SELECT state_id, l.* FROM (SELECT state_id, {_NAME} AS situation FROM rs) JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY situation ORDER BY compatibility DESC, player) AS rank FROM ("
    + " UNION ALL ".join(f"SELECT '{s}' AS situation, player, {_weights(s)} AS compatibility FROM pn" for s in sel.SITUATION_WEIGHTS)
    + ")) l USING (situation) WHERE rank <= 3",
    "pn rs d",
)
def _(spark, folder):
    return sel.rank_for_states(profiles(spark, folder), pr.PROFILE_FEATURES, _over_situations(spark, folder))


LINEUP = ["P0", "P1", "P2", "P3", "P4", "P5"]


@query(
    "mismatch_alert", "mismatch_detected:b avg_compatibility:d best:s worst:s",
    "SELECT AVG(c) < 0.35 AS mismatch_detected, AVG(c) AS avg_compatibility, array_to_string(list_slice(LIST(player ORDER BY c DESC, player), 1, 3), ',') AS best, "
    f"array_to_string(list_slice(LIST(player ORDER BY c, player), 1, 3), ',') AS worst FROM (SELECT player, {_weights('death_chase')} AS c FROM pn) WHERE player IN ('P0', 'P1', 'P2', 'P3', 'P4', 'P5')",
    "pn",
)
def _(spark, folder):
    norm = sel.minmax_normalise(profiles(spark, folder), pr.PROFILE_FEATURES)
    scored = norm.select("player", sel.weighted_score(sel.SITUATION_WEIGHTS["death_chase"]).alias("compatibility"))
    out = sel.mismatch_alert(scored, LINEUP)
    return out.withColumns({"best": F.concat_ws(",", "best"), "worst": F.concat_ws(",", "worst")})


@query(
    "mismatch_overall_rate", "mismatch_detected:b avg_compatibility:d",
    "SELECT AVG(c) < 0.4 AS mismatch_detected, AVG(c) AS avg_compatibility FROM (SELECT player, overall_sr / (SELECT MAX(overall_sr) FROM prof) AS c FROM prof) WHERE player IN ('P0', 'P1', 'P2', 'P3', 'P4', 'P5')",
    "prof",
)
def _(spark, folder):
    return sel.mismatch_alert(sel.overall_rate_scores(profiles(spark, folder)), LINEUP, threshold=0.4)
