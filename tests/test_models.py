"""Model operators against brute force on small fixtures."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stumpline.functions.numeric import digamma, hyp2f1, log_gamma, tie_sums, trigamma
from stumpline.operators import clusters as cl
from stumpline.operators import decision as de
from stumpline.operators import engagement as en
from stumpline.operators import selection as sel
from stumpline.operators import survival as su
from stumpline.operators import value_models as vm


def test_special_functions():
    x = np.array([0.05, 0.7, 1.0, 3.3, 25.0, 400.0])
    assert log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)
    h = 1e-5
    slope = (log_gamma(x + h) - log_gamma(x - h)) / (2 * h)
    assert digamma(x) == pytest.approx(slope, rel=1e-5)
    assert trigamma(x) == pytest.approx((digamma(x + h) - digamma(x - h)) / (2 * h), rel=1e-5)
    assert hyp2f1(1, 1, 2, 0.5) == pytest.approx(2 * math.log(2), rel=1e-12)


def test_many_ties_close_to_the_direct_sum():
    s, t, d = np.array([9000.0]), np.array([2500.0]), np.array([1500.0])
    phi = s - np.arange(1500) / 1500 * t
    l = np.arange(1500)
    want = [np.log(phi).sum(), (1 / phi).sum(), (l / phi).sum(), (1 / phi**2).sum(), (l / phi**2).sum(), (l**2 / phi**2).sum()]
    assert np.concatenate(tie_sums(s, t, d)) == pytest.approx(want, rel=1e-6)


@pytest.fixture(scope="module")
def patients():
    rnd = random.Random(3)
    rows = []
    for _ in range(160):
        a, b = rnd.gauss(0, 1), rnd.gauss(2, 3)
        t = max(1, int(rnd.expovariate(0.1 * math.exp(0.8 * a - 0.1 * b))))
        rows.append((float(min(t, 25)), int(t < 25 and rnd.random() < 0.8), a, b))
    return rows


def efron_loglik(rows, beta):
    total = 0.0
    for t in {r[0] for r in rows if r[1]}:
        dead = [r for r in rows if r[0] == t and r[1]]
        weight = lambda r: math.exp(beta[0] * r[2] + beta[1] * r[3])
        risk, dying = sum(weight(r) for r in rows if r[0] >= t), sum(map(weight, dead))
        total += sum(beta[0] * r[2] + beta[1] * r[3] for r in dead)
        total -= sum(math.log(risk - k / len(dead) * dying) for k in range(len(dead)))
    return total


@pytest.mark.parametrize("limit", [10**6, 8])
def test_cox_maximises_the_tied_likelihood(spark, hot, patients, limit):
    hot(limit)
    df = spark.createDataFrame(patients, "duration_days double, event_observed int, a double, b double")
    model = su.fit_cox(df, ["a", "b"], penalizer=0.0)
    best = efron_loglik(patients, model.coefficients)
    assert model.log_likelihood == pytest.approx(best, abs=1e-4)
    for i in range(2):
        for step in (-0.02, 0.02):
            other = model.coefficients.copy()
            other[i] += step
            assert efron_loglik(patients, other) < best
    assert model.coefficients[0] > 0 and (model.standard_errors > 0).all()
    ratios = {r["feature"]: r["hazard_ratio"] for r in model.hazard_ratios(df).collect()}
    assert ratios["a"] == pytest.approx(math.exp(model.coefficients[0]))


def test_cox_raises_instead_of_passing_silently(spark):
    df = spark.createDataFrame([(1.0, 0, 1.0)], "duration_days double, event_observed int, a double")
    with pytest.raises(ValueError, match="event"):
        su.fit_cox(df, ["a"])


@pytest.mark.parametrize("limit", [10**6, 15])
def test_concordance_counts_pairs(spark, hot, patients, limit):
    hot(limit)
    rows = [(t, e, round(a, 1)) for t, e, a, _ in patients]
    pairs = won = tied = 0
    for t1, e1, r1 in rows:
        for t2, e2, r2 in rows:
            if e1 and (t1 < t2 or (t1 == t2 and not e2)):
                pairs, won, tied = pairs + 1, won + (r1 > r2), tied + (r1 == r2)
    df = spark.createDataFrame(rows, "t double, e int, risk double")
    got = su.concordance_index(df, "t", "e", "risk").first()
    assert (got["pairs"], got["concordant"], got["tied"]) == (pairs, won, tied)
    assert got["concordance_index"] == pytest.approx((won + tied / 2) / pairs)


def test_purchase_and_spend_models_reach_a_maximum(spark):
    rnd = np.random.default_rng(7)
    rows = []
    for _ in range(400):
        lam, p, age = rnd.gamma(1.2, 1 / 8), rnd.beta(1.5, 3.0), float(rnd.integers(30, 91))
        t, x, last = 0.0, 0, 0.0
        while True:
            t += rnd.exponential(1 / lam)
            if t > age:
                break
            x, last = x + 1, t
            if rnd.random() < p:
                break
        rows.append((float(x), round(last, 1), age, float(rnd.gamma(6.0, rnd.gamma(4.0, 5.0) / 4))))
    df = spark.createDataFrame(rows, "frequency double, recency double, T double, monetary_value double").repartition(4)
    model = vm.fit_purchases(df, penalizer=0.0)
    pdf = df.toPandas()
    mean = lambda th: vm.purchase_derived(np.exp(th), pdf)[0].mean()
    best = np.log([model.r, model.alpha, model.a, model.b])
    for i in range(4):
        for step in (-0.05, 0.05):
            other = best.copy()
            other[i] += step
            assert mean(other) <= mean(best) + 1e-7
    spend = vm.fit_spend(df, penalizer=0.0)
    value = vm.predict_value(df, model, spend)
    got = value.agg(F.min("predicted_clv"), F.avg("predicted_purchases")).first()
    assert got[0] >= 0 and got[1] > 0
    assert vm.fit_spend(df.limit(5)) is None


@pytest.mark.parametrize("derived, p", [(vm.purchase_derived, 4), (vm.spend_derived, 3)])
def test_derivatives_match_differences_and_vanish_at_the_fit(spark, derived, p):
    rnd = np.random.default_rng(3)
    x = rnd.integers(0 if p == 4 else 1, 9, 60).astype(float)
    b = pd.DataFrame({"frequency": x, "recency": np.where(x > 0, rnd.uniform(1, 30, 60), 0.0), "T": rnd.uniform(31, 60, 60), "monetary_value": rnd.gamma(3.0, 9.0, 60), "weight": 1.0})
    at = rnd.uniform(0.5, 3, p)
    value, grad, bend = derived(at, b)
    for i in range(p):
        step = np.eye(p)[i] * 1e-5
        up, down = derived(at + step, b), derived(at - step, b)
        assert (up[0] - down[0]) / 2e-5 == pytest.approx(grad[:, i], rel=1e-4, abs=1e-6)
        assert (up[1] - down[1]) / 2e-5 == pytest.approx(bend[:, :, i], rel=1e-4, abs=1e-5)
    best, _ = vm.maximise(spark.createDataFrame(b), derived, np.zeros(p), 0.01)
    _, slope, _ = vm.total_derived(spark.createDataFrame(b), derived, best[None])
    assert slope[0] / 60 == pytest.approx(0.02 * np.exp(2 * best), abs=1e-7)


@pytest.mark.parametrize("ratio", [1.0, 1.0001, 1.7, 40.0, 1e6])
def test_tie_sums_match_direct_ones_for_any_number(ratio):
    for d in (1, 2, 31, 32, 33, 34, 100, 999, 1000, 1001, 20_000, 100_000):
        t = 0.37 * d
        s = t * ratio
        l = np.arange(d)
        phi = s - l / d * t
        want = [math.fsum(v) for v in (np.log(phi), 1 / phi, l / phi, 1 / phi**2, l / phi**2, l**2 / phi**2)]
        got = [v[0] for v in tie_sums([s], [t], [d])]
        assert got == pytest.approx(want, rel=1e-9, abs=1e-12 * d)


def test_expected_purchases_grow_with_time():
    m = vm.PurchaseModel(1.2, 8.0, 1.5, 3.0, 0.0)
    x, tx, age = np.array([0.0, 3.0]), np.array([0.0, 80.0]), np.array([90.0, 90.0])
    near, far = m.expected(10, x, tx, age), m.expected(100, x, tx, age)
    assert (far > near).all() and (near > 0).all() and near[1] > near[0]


@pytest.fixture(scope="module")
def points(spark):
    rnd = np.random.default_rng(1)
    rows = [(f"p{i}", i % 3, *map(float, rnd.normal((i % 3) * 3, 1, 4))) for i in range(90)]
    return rows, spark.createDataFrame(rows, "player string, cluster int, a double, b double, c double, d double")


def brute_silhouette(rows, power):
    x, lab = np.array([r[2:] for r in rows]), np.array([r[1] for r in rows])
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) ** power
    out = []
    for i in range(len(rows)):
        own = lab == lab[i]
        a = dist[i, own].sum() / (own.sum() - 1)
        b = min(dist[i, lab == k].mean() for k in set(lab) if k != lab[i])
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouettes(points):
    rows, df = points
    cols = ["a", "b", "c", "d"]
    assert cl.silhouette(df, cols).first()[0] == pytest.approx(brute_silhouette(rows, 2))
    for tile in (7, 2048):
        assert cl.silhouette_euclidean(df, cols, tile_rows=tile).first()[0] == pytest.approx(brute_silhouette(rows, 1))
    assert cl.silhouette_euclidean(df.limit(0), cols).first()[0] is None


def test_clusters_are_found_and_predicted(points):
    _, df = points
    cols = ["a", "b", "c", "d"]
    fit = cl.fit_clusters(df.drop("cluster"), cols)
    assert fit.labelled.select("cluster").distinct().count() == 3
    both = fit.labelled.select("player", F.col("cluster").alias("k")).join(fit.predict(df.drop("cluster")), "player")
    assert both.filter("k <> cluster").count() == 0
    scaled = cl.standardise(df, cols).agg(F.avg("a"), F.stddev_pop("a")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-9) and scaled[1] == pytest.approx(1)
    variance = [r[1] for r in cl.pca_variance(df, fit.projection).collect()]
    assert variance == sorted(variance, reverse=True) and sum(variance) <= 1 + 1e-9
    assert np.linalg.norm(fit.projection.loadings, axis=0) == pytest.approx(1)


def test_weights_sum_to_one_and_situations_are_named(spark):
    rows = [("a", 12.0, 3.0, 4.0, None), ("b", 7.0, 8.0, 10.0, True), ("c", 3.0, 2.0, 20.0, False), ("d", None, None, None, None), ("e", 12.0, 9.0, 4.0, False)]
    df = spark.createDataFrame(rows, "id string, rrr double, left double, overs double, chase boolean")
    cols = [F.col(c) for c in ("rrr", "left", "overs")]
    total = sum(sel.dynamic_weights(*cols).values())
    got = {r[0]: (r[1], r[2]) for r in df.select("id", total, sel.situation(*cols, F.col("chase"))).collect()}
    assert all(v[0] == pytest.approx(1) for k, v in got.items())
    assert {k: v[1] for k, v in got.items()} == {"a": "death_chase", "b": "default", "c": "collapse", "d": "default", "e": "default"}


def test_q_values_solve_a_two_state_log(spark):
    counts = spark.createDataFrame(
        [("x", 0, "y", 2, 2.0), ("x", 1, "x", 1, 0.0), ("y", 0, "x", 1, 0.0)],
        "state_key string, action int, next_state_key string, n long, reward_sum double",
    )
    q = {(r[0], r[1]): r[2] for r in de.batch_q_iteration(counts, gamma=0.5, tolerance=1e-10).collect()}
    # x0 = 1 + y0 / 2, y0 = x0 / 2, x1 = x0 / 2
    assert q == pytest.approx({("x", 0): 4 / 3, ("y", 0): 2 / 3, ("x", 1): 2 / 3}, abs=1e-6)
    best = {r["state_key"]: r["action_name"] for r in de.policy(spark.createDataFrame([(*k, v) for k, v in q.items()], "state_key string, action int, q double")).collect()}
    assert best == {"x": "no_substitution", "y": "no_substitution"}


def test_logistic_benefit_classifier_converges_or_raises(spark):
    rng = np.random.default_rng(6)
    rows = [(i, 1, 1 + i // 6, *x, int(x[0] + rng.normal() > 0)) for i, x in enumerate(rng.normal(size=(300, len(de.STATE_COLUMNS))).tolist())]
    schema = "match_id long, innings int, over int, " + ", ".join(f"{c} double" for c in de.STATE_COLUMNS) + ", sub_benefit int"
    df = spark.createDataFrame(rows, schema)
    model, scored = de.train_benefit_classifier(df, kind="logistic")
    weights = np.abs(model.coefficients.toArray())
    assert weights.argmax() == 0 and scored.filter("(probability > 0.5) = (sub_benefit = 1)").count() > 0.6 * scored.count()
    with pytest.raises(RuntimeError, match="not converged"):
        de.train_benefit_classifier(df, kind="logistic", iterations=1)


def test_q_values_of_a_random_log_are_a_fixed_point_and_nothing_stays_cached(spark):
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    rng = np.random.default_rng(4)
    rows = {(f"s{rng.integers(40)}", int(rng.integers(3)), f"s{rng.integers(50)}"): (int(rng.integers(1, 9)), float(rng.normal())) for _ in range(400)}
    schema = "state_key string, action int, next_state_key string, n long, reward_sum double"
    counts = spark.createDataFrame([(*k, *v) for k, v in rows.items()], schema)
    q = {(r[0], r[1]): r[2] for r in de.batch_q_iteration(counts, gamma=0.9).collect()}
    value = {}
    for (s, _), v in q.items():
        value[s] = max(v, value.get(s, -np.inf))
    want = {}
    for (s, a, t), (n, reward) in rows.items():
        total, gain = want.get((s, a), (0, 0.0))
        want[s, a] = total + n, gain + reward + 0.9 * n * value.get(t, 0.0)
    assert q == pytest.approx({k: gain / total for k, (total, gain) in want.items()}, abs=1e-9)
    assert de.batch_q_iteration(spark.createDataFrame([], schema)).count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held


def test_value_iteration_fails_when_not_converged(spark):
    counts = spark.createDataFrame([("x", 0, "x", 1, 1.0)], "state_key string, action int, next_state_key string, n long, reward_sum double")
    with pytest.raises(Exception, match="still move"):
        de.batch_q_iteration(counts, sweeps=2).collect()


def test_state_buckets_and_gaps(spark):
    df = spark.createDataFrame([(0.0, 13.5, 3.5), (10.0, 4.0, 7.0), (12.0, 20.0, 11.0)], "required_run_rate double, overs_remaining double, wickets_fallen double")
    got = [tuple(r)[3:] for r in de.bucket_state(df).collect()]
    assert got == [("low", "mid", "some"), ("medium", "death", "many"), ("high", "mid", "many")]


def test_auc_with_ties(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1), (1, 0.1)]
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    want = sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs)
    got = de.binary_metrics(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    assert got["roc_auc"] == pytest.approx(want) and got["precision"] == 0.5 and got["recall"] == pytest.approx(1 / 3)


def test_forecast_beats_zero(spark):
    rows = [(f"m{m}", 1, "A", o, 5 + (o * m) % 7, o % 2, (o + m) % 3, o % 4) for m in range(12) for o in range(20)]
    over = spark.createDataFrame(rows, "match_id string, innings int, batting_team string, over int, runs_scored int, wickets int, boundaries int, dot_balls int")
    df = en.forecast(en.series_features(en.excitement_density(over)))
    error = en.forecast_error(df).first()["mse"]
    base = df.agg(F.avg(F.col("next_1") * F.col("next_1"))).first()[0]
    assert error < base
    assert {r[0] for r in df.select("split").distinct().collect()} == {"train", "validation"}


def test_ranking_of_many_contexts_matches_a_plain_one(spark):
    rng = random.Random(4)
    log = [(f"b{rng.randint(0, 12)}", float(rng.randint(0, 2)), rng.choice([0.0, rng.uniform(0, 20)]), float(rng.randint(0, 20))) for _ in range(400)]
    states = spark.createDataFrame([*log, (None, 0.0, 5.0, 30.0)], "batter string, s7_phase_code double, s4_required_run_rate double, s8_runs_last_6_balls double")
    asked = [(f"c{i}", float(i % 4), [0.0, 6.0, 11.5, 40.0, -5.0][i % 5]) for i in range(5_000)] + [("none", None, 3.0)]
    contexts = spark.createDataFrame(asked, "context_id string, phase_code double, required_run_rate double")
    got = {}
    for r in de.rank_candidates_context(states, contexts, n=2).collect():
        got.setdefault(r.context_id, {})[r["rank"]] = (r.player, round(r.expected_uplift_runs, 6))
    mean = lambda v: sum(v) / len(v)
    known = {}
    for name, phase, rate in asked:
        if (phase, rate) not in known:
            scored = []
            for b in {x[0] for x in log}:
                mine = [x for x in log if x[0] == b]
                near = [x for x in mine if x[1] == phase and max(rate - 3, 0) <= x[2] <= rate + 3] or mine
                recent, need = mean([x[3] for x in near]), mean([x[2] for x in near])
                scored.append((-(recent / 6 - need) if need > 0 else 0.0, b))
            known[phase, rate] = {i + 1: (b, round(-u, 6)) for i, (u, b) in enumerate(sorted(scored)[:2])}
        assert got[name] == known[phase, rate]
    assert de.rank_candidates_context(states, contexts.limit(3)).count() == 3 * len({x[0] for x in log})


def test_nearest_deliveries_of_many_requests_match_all_pairs(spark, hot):
    rng = random.Random(6)
    log = [("m", 1, i, 1, i, f"k{i}", rng.choice([0.0, round(rng.uniform(0, 20), 1)]), float(rng.randint(0, 10))) for i in range(300)]
    states = spark.createDataFrame(log, "match_id string, innings int, over int, ball int, seq long, state_key string, s4_required_run_rate double, s3_wickets_in_hand double")
    asked = [(f"r{i}", rng.choice([0.0, -3.0, 25.0, round(rng.uniform(0, 20), 1)]), float(rng.randint(0, 10))) for i in range(5_000)]
    requests = spark.createDataFrame([*asked, ("none", None, 3.0)], "request_id string, required_run_rate double, wickets_fallen double")
    for limit in (10**6, 400):
        hot(limit)
        got = {r.request_id: (r.distance, r.seq) for r in de.nearest_state(states, requests).collect()}
        assert set(got) == {a[0] for a in asked}
        for name, rate, fallen in asked:
            assert got[name] == min((abs(x[6] - rate) + abs(10 - x[7] - fallen), x[4]) for x in log)
    assert de.nearest_state(states.limit(0), requests).count() == 0
    assert de.nearest_state(states, requests.limit(0)).count() == 0


def test_euclidean_groups_do_not_grow_with_the_rows():
    assert cl.silhouette_groups(10_000, 64, 10, 12, 6) == cl.silhouette_groups(1_000_000, 64, 10, 500, 6) == 12
    assert cl.silhouette_groups(100, 64, 10, 1, 6) == 1 and cl.silhouette_groups(0, 64, 0, 0, 6) == 1
    assert cl.silhouette_groups(10_000_000, 64, 2_000, 5_000, 6) > 12
