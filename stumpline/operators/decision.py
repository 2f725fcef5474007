"""Substitution decisions from match states."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.functions.exprs import boundary_ball, clip, flag_sum
from stumpline.functions.quantiles import with_scalars
from stumpline.functions.scan import NO_HOT, Hot, Lag, Last, RowNumber, Running, Total, Trailing, hot_groups, hot_rows_limit, scan
from stumpline.operators import boosting
from stumpline.operators.state import INNINGS, delivery_order
from stumpline.session import stored

# The fourteen state dimensions, in order.
STATE_COLUMNS = (
    "s1_innings", "s2_balls_remaining", "s3_wickets_in_hand", "s4_required_run_rate",
    "s5_current_run_rate", "s6_momentum_score", "s7_phase_code", "s8_runs_last_6_balls",
    "s9_wickets_last_6_balls", "s10_boundary_last_3_overs", "s11_pressure_index",
    "s12_chase_win_prob", "s13_bowling_pressure", "s14_partnership_runs",
)
ACTIONS = ("no_substitution", "substitute_batter", "substitute_bowler")
# Places where evening games bring dew.
NIGHT_CITIES = ("Mumbai", "Chennai", "Bangalore", "Delhi")
# Player roles that count as pure bowlers, and the weight of each role.
ROLE_WEIGHTS = {"Batsman": 5, "All-rounder": 3, "Wicketkeeper": 2, "Bowler": 0}
# Three bins in seven places: no more than this many state keys exist.
MAX_STATE_KEYS = 3**7
# Actions that a log may hold for each of them, on average.
MAX_ACTIONS = 16
# Wickets in hand run from 0 to 10, below 0 where feeds list more wickets; more values than these raise.
MAX_HANDS = 64
# Coordinates of a value table's keys, and values that one of them may take.
Q_AXES = ("k_rate", "k_hand", "k_balls")
MAX_AXIS = 100_000
# Phases of play that a table of contexts may ask for.
MAX_PHASES = 64


def state_vector_14d(state: DataFrame, hot: Hot | None = None) -> DataFrame:
    """The fourteen state dimensions of every delivery. ``hot`` passes known oversized innings."""
    df = scan(
        state,
        INNINGS,
        delivery_order(state),
        hot,
        _runs6=Trailing(F.coalesce("runs", F.lit(0)), 6),
        _wickets6=Trailing(F.coalesce("wickets", F.lit(0)), 6),
        _fours18=Trailing(boundary_ball().cast("int"), 18),
    )
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    phase = (
        F.when(F.col("phase_of_play") == "powerplay", 0.0)
        .when(F.col("phase_of_play") == "middle", 1.0)
        .when(F.col("phase_of_play").isin("death", "chase_death"), 2.0)
        .otherwise(1.0)
    )
    values = {
        "s1_innings": F.col("innings").cast("double"),
        "s2_balls_remaining": zero("balls_remaining"),
        "s3_wickets_in_hand": zero("wickets_in_hand"),
        "s4_required_run_rate": zero("required_run_rate"),
        "s5_current_run_rate": zero("current_run_rate"),
        "s6_momentum_score": zero("momentum_score"),
        "s7_phase_code": phase,
        "s8_runs_last_6_balls": zero("_runs6"),
        "s9_wickets_last_6_balls": zero("_wickets6"),
        "s10_boundary_last_3_overs": zero("_fours18"),
        "s11_pressure_index": zero("pressure_index"),
        "s12_chase_win_prob": F.coalesce("chase_win_probability_proxy", F.lit(0.5)),
        "s13_bowling_pressure": zero("bowling_pressure_index"),
        "s14_partnership_runs": zero("partnership_runs"),
    }
    place = [c for c in ("source_rank", "seq") if c in df.columns]
    return df.select(
        *INNINGS, "over", "ball", *place, F.col("striker").alias("batter"), "bowler",
        *[v.alias(n) for n, v in values.items()],
    )


def _bin(col: str, low: float, high: float) -> Column:
    return F.when(F.col(col) <= low, 0).when(F.col(col) <= high, 1).otherwise(2)


def discretise_state(states: DataFrame) -> DataFrame:
    """Add ``state_key``: seven bins of three, joined by underscores."""
    hand = F.col("s3_wickets_in_hand")
    bins = [
        _bin("s4_required_run_rate", 6, 10),
        F.when(hand >= 7, 0).when(hand >= 4, 1).otherwise(2),
        F.col("s7_phase_code").cast("int"),
        _bin("s6_momentum_score", -2, 2),
        _bin("s11_pressure_index", 0.3, 0.6),
        _bin("s12_chase_win_prob", 0.3, 0.7),
        _bin("s13_bowling_pressure", 0.3, 0.6),
    ]
    return states.withColumn("state_key", F.concat_ws("_", *[b.cast("string") for b in bins]))


def over_state(context: DataFrame) -> DataFrame:
    """State of every over, with fatigue and dew proxies, from the over context table."""
    c = F.col
    second = c("innings") == 2
    dew = F.lit(0.0)
    if "city" in context.columns:
        dew = F.when(second, F.when(c("city").isin(*NIGHT_CITIES), 0.7).otherwise(0.3)).otherwise(0.0)
    d = lambda x: x.cast("double")
    return context.select(
        "match_id",
        "innings",
        "over",
        d(c("cumulative_score")).alias("current_score"),
        d(c("cumulative_wickets")).alias("wickets_fallen"),
        d(F.coalesce("current_run_rate", F.lit(0.0))).alias("current_run_rate"),
        F.when(second, d(F.coalesce("required_run_rate", F.lit(0.0)))).otherwise(0.0).alias("required_run_rate"),
        d(c("overs_remaining")).alias("overs_remaining"),
        d(F.greatest(F.lit(10) - c("cumulative_wickets"), F.lit(0))).alias("wickets_remaining"),
        F.lit(0.5).alias("pitch_type_encoded"),
        dew.alias("dew_factor_proxy"),
        (F.least(c("over") / 4.0, F.lit(4.0)) / 4.0).alias("bowler_fatigue"),
        (F.least(c("over") / 6.0, F.lit(3.0)) / 3.0).alias("batter_fatigue"),
        F.lit(0.5).alias("opponent_bowling_strength"),
        F.lit(0.5).alias("home_away"),
        F.when(second, 0.0).otherwise(1.0).alias("is_first_innings"),
        d(c("pressure_ball").cast("int")).alias("is_pressure_situation"),
    )


def bucket_state(states: DataFrame) -> DataFrame:
    """Rate, over and wicket labels. Ranges are closed and tried in turn; gaps take a fallback."""
    rate = F.when(F.col("required_run_rate") > 0, F.col("required_run_rate")).otherwise(5.0)
    over = F.lit(20.0) - F.col("overs_remaining")
    out = clip(F.col("wickets_fallen"), 0.0, 10.0)
    label = (
        F.when(rate.between(0, 6), "low").when(rate.between(6, 10), "medium").when(rate.between(10, 999), "high")
    )
    stage = F.when(over.between(1, 6), "early").when(over.between(7, 15), "mid").when(over.between(16, 20), "death")
    lost = F.when(out.between(0, 3), "few").when(out.between(4, 6), "some").when(out.between(7, 10), "many")
    return states.withColumns(
        {
            "rrr_bucket": label.otherwise("medium"),
            "over_bucket": stage.otherwise("mid"),
            "wicket_bucket": lost.otherwise("some"),
        }
    )


def state_summary(states: DataFrame) -> DataFrame:
    return states.agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("state_key").alias("distinct_states")
    )


def label_benefit(states: DataFrame) -> DataFrame:
    """1 when the last six balls outpaced the required rate."""
    hit = (F.col("s8_runs_last_6_balls") / 6.0) > F.col("s4_required_run_rate")
    return states.withColumn("sub_benefit", hit.cast("int"))


def hash_share(*cols: str) -> Column:
    """Reproducible value in [0, 1) from the given columns, independent of partitioning."""
    return F.pmod(F.xxhash64(*cols), F.lit(1_000_000)) / 1_000_000.0


def train_benefit_classifier(
    labelled: DataFrame, trees: int = 100, depth: int = 4, step: float = 0.1, kind: str = "gbt", iterations: int = 1_000
) -> tuple[object, DataFrame]:
    """Classifier of ``sub_benefit`` on 70 % of the deliveries; the scored other 30 % is returned.

    ``kind`` is "gbt" (``trees``, ``depth``, ``step``) or "logistic"; the latter raises where ``iterations`` do not suffice.
    """
    keys = [c for c in (*INNINGS, "over", "ball", "seq", "batter", "bowler") if c in labelled.columns]
    df = VectorAssembler(inputCols=list(STATE_COLUMNS), outputCol="features").transform(
        labelled.withColumn("_share", hash_share(*keys))
    )
    known = df.filter("_share < 0.7")
    if kind == "gbt":
        arrays = known.withColumn("features", vector_to_array("features"))
        model = boosting.fit(arrays, "features", "sub_benefit", trees=trees, depth=depth, step=step)
    else:
        model = LogisticRegression(maxIter=iterations, featuresCol="features", labelCol="sub_benefit").fit(known)
        if model.summary.totalIterations >= iterations:
            raise RuntimeError(f"the classifier has not converged after {iterations} iterations")
    scored = score_classifier(model, df.filter("_share >= 0.7"))
    return model, scored.drop("features", "_share")


def score_classifier(model: object, df: DataFrame) -> DataFrame:
    """Add ``probability`` of the positive class and the 0/1 ``prediction``."""
    have = "features" in df.columns
    vectors = df if have else VectorAssembler(inputCols=list(STATE_COLUMNS), outputCol="features").transform(df)
    if isinstance(model, boosting.BoostedTrees):
        out = model.transform(vectors.withColumn("features", vector_to_array("features")))
    else:
        out = model.transform(vectors).withColumn("probability", vector_to_array("probability")[1])
    return out.drop("rawPrediction", *([] if have else ["features"]))


def feature_importance(df: DataFrame, model: boosting.BoostedTrees, features: Sequence[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def binary_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Exact ROC-AUC (ties count half), precision, recall and F1 per class, in one row.

    Scores are counted first, so the ranked table has one row per distinct score.
    """
    pos = F.col(label) == 1
    per = df.groupBy(score).agg(flag_sum(pos).alias("_p"), flag_sum(~pos).alias("_n"))
    ranked = scan(per, [], [score], hot_groups(df, []), _neg=Running(F.col("_n")))
    guess = F.col(score) >= threshold
    area = F.sum(F.col("_p") * (F.col("_neg") - F.col("_n") + F.col("_n") / 2.0))
    counts = ranked.agg(
        area.alias("_area"),
        F.sum("_p").alias("support_1"),
        F.sum("_n").alias("support_0"),
        F.sum(F.when(guess, F.col("_p")).otherwise(0)).alias("_tp"),
        F.sum(F.when(guess, F.col("_n")).otherwise(0)).alias("_fp"),
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, p1, n0 = F.col("_tp"), F.col("_fp"), F.col("support_1"), F.col("support_0")
    fn, tn = p1 - tp, n0 - fp
    return counts.select(
        F.when((p1 > 0) & (n0 > 0), F.col("_area") / (p1 * n0)).alias("roc_auc"),
        share(tp, tp + fp).alias("precision"),
        share(tp, p1).alias("recall"),
        share(tp * 2.0, tp * 2 + fp + fn).alias("f1"),
        share(tn, tn + fn).alias("precision_0"),
        share(tn, n0).alias("recall_0"),
        share(tn * 2.0, tn * 2 + fp + fn).alias("f1_0"),
        "support_0",
        "support_1",
        ((tp + tn) / (p1 + n0)).alias("accuracy"),
    )


# --- transitions and policy ----------------------------------------------------------------------


def transitions(states: DataFrame, action: Column | None = None, hot: Hot | None = None) -> DataFrame:
    """(state, next state, reward) per innings, all but its last seven deliveries.

    The reward compares the mean six-ball runs with the mean required rate over the delivery and
    the five after it. It is complete five deliveries later, so one ordered pass looking back
    suffices. ``action`` is the logged action; by default one is drawn by hash, reproducibly.
    """
    order = delivery_order(states)
    act = action if action is not None else F.pmod(F.xxhash64(*INNINGS, *order), F.lit(len(ACTIONS)))
    df = scan(
        states,
        INNINGS,
        order,
        hot,
        _rn=RowNumber(),
        _all=Total(F.lit(1)),
        _runs=Trailing(F.col("s8_runs_last_6_balls"), 6),
        _rate=Trailing(F.col("s4_required_run_rate"), 6),
        _from=Lag(F.col("state_key"), 5),
        _to=Lag(F.col("state_key"), 4),
        _action=Lag(act.cast("int"), 5),
    )
    rate = F.col("_rate") / 6.0
    gain = clip(F.col("_runs") / 6.0 / 6.0 / F.greatest(rate, F.lit(0.1)) - 1.0, -1.0, 1.0)
    return df.filter((F.col("_rn") >= 6) & (F.col("_rn") <= F.col("_all") - 2)).select(
        *INNINGS,
        (F.col("_rn") - 5).alias("ball_number"),
        F.col("_from").alias("state_key"),
        F.col("_to").alias("next_state_key"),
        F.col("_action").alias("action"),
        F.when(rate <= 0, 0.5).otherwise(gain).alias("reward"),
    )


def transition_counts(trans: DataFrame) -> DataFrame:
    """Logged transitions folded to (state, action, next state) with count and summed reward."""
    return trans.groupBy("state_key", "action", "next_state_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("reward").alias("reward_sum")
    )


def _backup(log: DataFrame, values: np.ndarray, gamma: float) -> DataFrame:
    """One sweep: ``state_key``, ``action``, ``q`` from the values of all states, a constant in which ``next_place`` looks up."""
    table = F.split(F.lit(",".join(map(repr, values.tolist() or [0.0]))), ",").cast("array<double>")
    after = F.col("n") * F.coalesce(F.get(table, F.col("next_place")), F.lit(0.0))
    q = (F.sum("reward_sum") + gamma * F.sum(after)) / F.sum("n")
    return log.groupBy("state_key", "action").agg(q.alias("q"))


def _mixed(points: list[np.ndarray], images: list[np.ndarray]) -> np.ndarray:
    """The combination of the last images whose distance to the same combination of points is smallest."""
    gaps = np.stack([b - a for a, b in zip(points, images, strict=True)], axis=1)
    if gaps.shape[1] == 1:
        return images[-1]
    steps = gaps[:, 1:] - gaps[:, :-1]
    share, *_ = np.linalg.lstsq(steps, gaps[:, -1], rcond=1e-10)
    return images[-1] - (np.stack(images, axis=1)[:, 1:] - np.stack(images, axis=1)[:, :-1]) @ share


def batch_q_iteration(
    counts: DataFrame, gamma: float = 0.85, tolerance: float = 1e-12, sweeps: int = 1_000, memory: int = 6
) -> DataFrame:
    """The fixed point of Q(s, a) = mean of r + gamma max Q(s', .) over the logged transitions.

    Bulk-synchronous sweeps: the log, folded to one row per (state, action, next state), is written once and kept
    partitioned by state while it is swept, so a sweep shuffles nothing. It carries the values of all states (at most
    MAX_STATE_KEYS, which is checked) as a constant and sums per (state, action); these sums come back. The next values
    are the combination of the last ``memory`` ones that leaves the smallest gap, which takes a fraction of the plain
    sweeps; where it makes the gap larger, plain sweeps go on. A step size would not move the fixed point, so full backups are made until no state's value is
    off its own backup by more than ``tolerance``; if ``sweeps`` do not suffice, the job fails. A next state that was
    never left has value 0.
    """
    log = counts.groupBy("state_key", "action", "next_state_key").agg(F.sum("n").alias("n"), F.sum("reward_sum").alias("reward_sum"))
    log = stored(log, "transitions")
    pairs = [tuple(r) for r in log.select("state_key", "action").distinct().limit(MAX_STATE_KEYS * MAX_ACTIONS + 1).collect()]
    names = sorted({state for state, _ in pairs})
    if len(names) > MAX_STATE_KEYS or len(pairs) > MAX_STATE_KEYS * MAX_ACTIONS:
        raise ValueError("state keys are not discretised")
    place = {name: i for i, name in enumerate(names)}
    places = pa.table({"next_state_key": pa.array(names, pa.string()), "next_place": pa.array(range(len(names)), pa.int32())})
    log = log.join(F.broadcast(log.sparkSession.createDataFrame(places)), "next_state_key", "left")
    held = log.repartition("state_key").cache()
    try:
        return _backup(log, _fixed_point(held, place, gamma, tolerance, sweeps, memory), gamma)
    finally:
        held.unpersist()


def _fixed_point(log: DataFrame, place: dict[str, int], gamma: float, tolerance: float, sweeps: int, memory: int) -> np.ndarray:
    """The value of every state, by place."""
    value, least, gap = np.zeros(len(place)), np.inf, 0.0
    points: list[np.ndarray] = []
    images: list[np.ndarray] = []
    for _ in range(sweeps):
        found = _backup(log, value, gamma).select("state_key", "q").toArrow()
        image = np.full(len(place), -np.inf)
        np.maximum.at(image, [place[k] for k in found.column(0).to_pylist()], found.column(1).to_numpy())
        gap = float(np.abs(image - value).max(initial=0.0))
        if gap <= tolerance:
            return value
        if gap > least:
            points, images = [], []
        least = min(least, gap)
        points, images = [*points, value][-memory:], [*images, image][-memory:]
        value = _mixed(points, images)
    raise RuntimeError(f"values still move by {gap} after {sweeps} sweeps")


def policy(q: DataFrame) -> DataFrame:
    """Best action per state (first on ties) with its confidence; absent actions count as 0."""
    n = len(ACTIONS)
    value = [F.coalesce(F.max(F.when(F.col("action") == a, F.col("q"))), F.lit(0.0)).alias(f"q{a}") for a in range(n)]
    wide = q.groupBy("state_key").agg(*value)
    cols = [F.col(f"q{a}") for a in range(n)]
    top, low = F.greatest(*cols), F.least(*cols)
    mean = (cols[0] + cols[1] + cols[2]) / float(n)
    first = F.when(cols[0] == top, 0).when(cols[1] == top, 1).otherwise(2)
    return wide.withColumns(
        {
            "action": first,
            "action_name": F.get(F.array(*[F.lit(a) for a in ACTIONS]), first),
            "confidence": clip((top - mean) / (top - low + 1e-8), 0.0, 1.0),
            "spread_confidence": clip((top - low) / 10.0, 0.0, 1.0),
        }
    )


def policy_action_distribution(pol: DataFrame) -> DataFrame:
    """States per best action and their percentage."""
    total = pol.agg(F.count(F.lit(1)).alias("_n")).select("_n").scalar()
    return (
        pol.groupBy("action", "action_name")
        .agg(F.count(F.lit(1)).alias("states"))
        .withColumn("pct", F.col("states") * 100.0 / total)
    )


def nearest_state(states: DataFrame, requests: DataFrame) -> DataFrame:
    """Closest logged delivery to each (``request_id``, ``required_run_rate``, ``wickets_fallen``) of a table.

    A nearest join without pairs. The log is folded to one delivery per distinct (wickets in hand, rate). Per value of
    wickets in hand, of which there are at most ``MAX_HANDS``, requests and log are sorted by rate together, and each
    request takes the last logged rate before it and the first one after it; the best over all values counts, of
    equally close deliveries the first. Requests may be many; ``request_id`` is unique. Requests with a null are left out.
    """
    c = F.col
    place = ["match_id", "innings", *delivery_order(states)]
    known = states.select(c("s3_wickets_in_hand").alias("hand"), c("s4_required_run_rate").alias("rate"), F.struct(*place, "state_key").alias("at"))
    log = stored(known.dropna(subset=["hand", "rate"]).groupBy("hand", "rate").agg(F.min("at").alias("at")), "folded")
    hands = [r[0] for r in log.select("hand").distinct().limit(MAX_HANDS + 1).collect()]
    if len(hands) > MAX_HANDS:
        raise ValueError(f"wickets in hand take more than {MAX_HANDS} values")
    asked = requests.select(
        "request_id", c("required_run_rate").cast("double").alias("rate"), c("wickets_fallen").cast("double").alias("fallen")
    ).dropna(subset=["rate", "fallen"])
    each = F.explode(F.array(*[F.lit(h) for h in sorted(hands)])) if hands else F.explode(F.array().cast("array<double>"))
    points = log.select("hand", "rate", F.lit(0).alias("kind"), F.struct("rate", "at").alias("point"))
    rows = stored(asked.select("*", each.alias("hand"), F.lit(1).alias("kind")).unionByName(points, allowMissingColumns=True), "nearest")
    hot = hot_groups(rows, ["hand"])
    # A logged rate equal to the asked one comes before it in both orders.
    seen = scan(rows, ["hand"], ["rate", "kind"], hot, below=Last(c("point")))
    seen = scan(seen, ["hand"], [F.desc("rate"), "kind"], hot, above=Last(c("point"))).filter("kind = 1")

    def found(side: str) -> Column:
        point = c(side)
        gap = F.abs(point["rate"] - c("rate")) + F.abs(F.lit(10) - c("hand") - c("fallen"))
        return F.when(point.isNotNull(), F.struct(gap.alias("distance"), point["at"].alias("at")))

    best = seen.groupBy("request_id").agg(F.min(F.least(found("below"), found("above"))).alias("b"))
    return best.select("request_id", "b.distance", *[c("b.at")[p].alias(p) for p in (*place, "state_key")])


def q_key(states: DataFrame) -> DataFrame:
    """Three-integer key: required rate, wickets in hand, balls left to the nearest ten."""
    return states.withColumns(
        {
            "k_rate": F.bround("s4_required_run_rate").cast("int"),
            "k_hand": F.bround("s3_wickets_in_hand").cast("int"),
            "k_balls": (F.bround(F.col("s2_balls_remaining") / 10) * 10).cast("int"),
        }
    )


def _nearest_along(sources: DataFrame, targets: DataFrame, axis: str) -> DataFrame:
    """``targets`` with the best of the sources on their line along ``axis``: each costs its distance and the way to it.

    Both are sorted along the line once up and once down, and the cheapest source so far is carried along. On the way up
    a source at s costs (distance - s) + x at every place x, so its order among the sources does not depend on x.
    """
    line = [k for k in Q_AXES if k != axis]
    x, best = F.col(axis), F.col("best")
    rows = sources.withColumn("kind", F.lit(0)).unionByName(targets.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def carried(order: Column, way: Column) -> Column:
        so_far = Window.partitionBy(*line).orderBy(order, "kind").rowsBetween(Window.unboundedPreceding, 0)
        first = F.min(F.when(F.col("kind") == 0, F.struct((best["distance"] - way).alias("distance"), best["key"].alias("key")))).over(so_far)
        return F.when(first.isNotNull(), F.struct((first["distance"] + way).alias("distance"), first["key"].alias("key")))

    both = rows.withColumns({"up": carried(x.asc(), x), "down": carried(x.desc(), -x)}).filter("kind = 1")
    return both.select(*Q_AXES, F.least("up", "down").alias("best"))


def nearest_q_key(states: DataFrame, keys: DataFrame) -> DataFrame:
    """For every distinct state key the closest key of the value table by L1 distance, of equally close keys the smallest.

    A distance transform on the lattice of the keys' coordinates, one axis after another: along each line the cheapest
    key so far is carried up and down, so the work is linear in lattice points and no two keys are compared. A line
    has as many points as an axis has values, at most ``MAX_AXIS``, which is checked. Keys with a null are left out.
    """
    table = keys.select(*Q_AXES).dropna().distinct()
    asked = stored(q_key(states).select(*Q_AXES).dropna().distinct(), "asked")
    values = asked.agg(*[F.collect_set(k).alias(k) for k in Q_AXES]).select(*[F.array_sort(k).alias(f"_{k}") for k in Q_AXES])
    sizes = asked.agg(*[F.count_distinct(k).alias(k) for k in Q_AXES]).first()
    if max(sizes) > MAX_AXIS:
        raise ValueError(f"an axis of the keys has more than {MAX_AXIS} values")
    found = table.withColumn("best", F.struct(F.lit(0).alias("distance"), F.struct(*Q_AXES).alias("key")))
    for axis in reversed(Q_AXES[1:]):
        lines = with_scalars(found.select(*[k for k in Q_AXES if k != axis]).distinct(), values.select(f"_{axis}"))
        found = _nearest_along(found, lines.withColumn(axis, F.explode(f"_{axis}")).select(*Q_AXES), axis)
    found = _nearest_along(found, asked, Q_AXES[0]).filter("best IS NOT NULL")
    named = dict(zip(Q_AXES, ("q_rate", "q_hand", "q_balls"), strict=True))
    return found.select(*Q_AXES, F.col("best.distance").alias("distance"), *[F.col("best.key")[k].alias(v) for k, v in named.items()])


def heuristic_decision(rrr: Column, wickets_fallen: Column) -> Column:
    return (rrr > 10) & (wickets_fallen >= 5)


# --- candidates -----------------------------------------------------------------------------------


def _uplift() -> Column:
    return F.when(F.col("_rate") > 0, F.col("_recent") / 6.0 - F.col("_rate")).otherwise(0.0)


def _exact(value: Column) -> Column:
    """A decimal with twelve places, so that running sums lose nothing when they are subtracted."""
    return value.cast("decimal(24,12)")


def _alike_pieces(folded: DataFrame, spots: DataFrame, hot: Hot | None) -> tuple[DataFrame, DataFrame]:
    """Per (player, phase) the stretches of asked rates with the same alike deliveries, and the places of the spots.

    Spots of a phase are numbered by asked rate. In one pass in order of the rate over logged rates and the spots' lower
    and upper bounds, a logged rate counts the bounds before it: it is alike to the spots from the first one whose upper
    bound is not below it to the last one whose lower bound is not above it. It enters a player's running sums there
    and leaves them after; between two such events the sums do not change.
    """
    c = F.col
    lows = spots.select(c("code").alias("phase"), c("low").alias("at"), F.lit(0).alias("kind"), "asked")
    highs = spots.select(c("code").alias("phase"), c("high").alias("at"), F.lit(2).alias("kind"), "asked")
    rates = folded.dropna(subset=["rate"]).select("*", c("rate").alias("at"), F.lit(1).alias("kind"))
    line = lows.unionByName(highs).unionByName(rates, allowMissingColumns=True)
    counted = scan(
        line, ["phase"], ["at", "kind", "asked"], hot,
        _low=Running((c("kind") == 0).cast("long")), _high=Running((c("kind") == 2).cast("long")),
    )
    placed = counted.filter("kind = 0").select(c("phase").alias("code"), "asked", c("_low").alias("spot"))
    sums = {
        "_runs": _exact(c("sum_s8_runs_last_6_balls")), "_known": c("n_s8_runs_last_6_balls"),
        "_rates": _exact(c("rate")) * c("n_rate").cast("decimal(12,0)"), "_rated": c("n_rate"), "_rows": F.lit(1),
    }
    step = lambda at, enters: F.struct(at.alias("spot"), F.lit(enters).alias("enters"))
    events = (
        counted.filter("kind = 1 AND _low > _high")
        .select("player", "phase", *[v.alias(k) for k, v in sums.items()], F.explode(F.array(step(c("_high") + 1, True), step(c("_low") + 1, False))).alias("e"))
        .groupBy("player", "phase", c("e.spot").alias("spot"))
        .agg(*[F.sum(F.when(c("e.enters"), c(k)).otherwise(-c(k))).alias(k) for k in sums])
    )
    return events, placed


def rank_candidates_context(
    states: DataFrame, contexts: DataFrame, players: Sequence[str] | None = None, n: int | None = None
) -> DataFrame:
    """Batters ranked for each context (``context_id``, ``phase_code``, ``required_run_rate``) of a table.

    A batter is judged by how they outpaced the rate: on deliveries of the same phase within three runs an over,
    or on all their deliveries where none is alike. The log is folded to (batter, phase, rate), stored once; contexts
    are taken once per distinct (phase, rate). Running sums along the rates give a batter's alike deliveries, so each
    (context, batter) pair costs one row however many deliveries lie in reach. Rates count with twelve decimal places.
    Batters without alike deliveries come in one order for all contexts, so a top ``n`` takes only the first ``n`` and as
    many more as the context has alike ones. Without ``n`` every batter is listed for every context. ``context_id`` is
    unique; phases are at most ``MAX_PHASES``.
    """
    c = F.col
    df = states if players is None else states.filter(c("batter").isin(*players))
    sums = lambda v: (F.sum(v).alias(f"sum_{v}"), F.count(v).alias(f"n_{v}"))
    folded = (
        df.dropna(subset=["batter"])
        .groupBy(c("batter").alias("player"), c("s7_phase_code").alias("phase"), c("s4_required_run_rate").alias("rate"))
        .agg(*sums("s8_runs_last_6_balls"), F.count("s4_required_run_rate").alias("n_rate"))
    )
    folded = stored(folded, "folded")
    asked = contexts.select(
        "context_id", c("phase_code").cast("double").alias("code"), c("required_run_rate").cast("double").alias("asked")
    )
    low, high = F.greatest(c("asked") - 3, F.lit(0.0)), c("asked") + 3
    spots = stored(asked.select("code", "asked").distinct().withColumns({"low": low, "high": high}), "spots")
    limit = hot_rows_limit(folded)
    phases = spots.groupBy("code").agg(F.count(F.lit(1)).alias("spots")).limit(MAX_PHASES + 1).collect()
    if len(phases) > MAX_PHASES:
        raise ValueError(f"contexts have more than {MAX_PHASES} phases")
    hot = NO_HOT if folded.count() + 2 * sum(p["spots"] for p in phases) <= limit else None
    events, placed = _alike_pieces(folded, spots.filter("high >= low"), hot)

    mean = lambda total, many: F.when(many > 0, total.cast("double") / many.cast("double"))
    overall = folded.groupBy("player").agg(
        mean(F.sum("sum_s8_runs_last_6_balls"), F.sum("n_s8_runs_last_6_balls")).alias("_r"),
        mean(F.sum(c("rate") * c("n_rate")), F.sum("n_rate")).alias("_q"),
    )
    here = c("code").eqNullSafe(c("_c")) & c("asked").eqNullSafe(c("_a"))
    if n is None:
        # The spots that no delivery is alike to follow the others; every batter has a piece from the first spot on.
        rest = spots.filter("high < low OR high IS NULL OR code IS NULL").select("code", "asked")
        ends = placed.unionByName(rest.withColumn("spot", F.lit(None).cast("long")))
        places = scan(ends, ["code"], [F.asc_nulls_last("spot"), "asked"], hot, spot=RowNumber())
        edge = F.array(*[F.struct(F.lit(p["code"]).cast("double").alias("phase"), F.lit(at).cast("long").alias("spot")) for p in phases for at in (1, p["spots"] + 1)])
        names = [k for k in events.columns if k.startswith("_")]
        edges = overall.select("player", F.explode(edge if phases else F.array().cast("array<struct<phase:double,spot:long>>")).alias("e"))
        edges = edges.select("player", "e.*", *[F.lit(0).cast(events.schema[k].dataType).alias(k) for k in names])
        events = events.unionByName(edges).groupBy("player", "phase", "spot").agg(*[F.sum(k).alias(k) for k in names])
    else:
        places = placed
    pieces = scan(events, ["player", "phase"], [F.desc("spot")], hot, _until=Lag(c("spot")))
    names = ("_runs", "_known", "_rates", "_rated", "_rows")
    pieces = scan(pieces, ["player", "phase"], ["spot"], hot, **{f"{k}_": Running(c(k)) for k in names})
    pieces = pieces.filter(c("_until").isNotNull() if n is None else c("_rows_") > 0).join(overall, "player")
    alike = c("_rows_") > 0
    near = pieces.select(
        "player", c("phase").alias("_phase"), F.explode(F.sequence(c("spot"), c("_until") - 1)).alias("_spot"),
        F.coalesce(F.when(alike, mean(c("_runs_"), c("_known_"))), "_r").alias("_recent"),
        F.coalesce(F.when(alike, mean(c("_rates_"), c("_rated_"))), "_q").alias("_rate"),
    )
    at = c("_phase").eqNullSafe(c("code")) & (c("_spot") == c("spot"))
    scored = near.join(places, at).select("code", "asked", "player", "_recent", "_rate")
    if n is not None:
        scored = scored.unionByName(_first_others(spots, scored, overall, n))
    uplift = c("expected_uplift_runs")
    fit = F.when(c("_recent") > 0, clip(F.lit(1.0) / (F.lit(1.0) + F.abs(uplift)), 0.0, 1.0))
    scored = scored.withColumn("expected_uplift_runs", _uplift()).withColumns(
        {
            "compatibility": fit.otherwise(0.3),
            "primary_role": F.when(uplift > 0, "Batter").otherwise("Bowler"),
            "sr_in_context": F.when(c("_recent") > 0, c("_recent") / 6.0 * 100).otherwise(0.0),
        }
    ).drop("_recent", "_rate")
    order = [F.desc("expected_uplift_runs"), "player"]
    if n is None:
        all_hot = NO_HOT if hot is NO_HOT else None  # a context lists no more batters than the folded log has rows
        ranked = scan(scored, ["code", "asked"], order, all_hot, rank=RowNumber()).withColumn("rank", c("rank").cast("int"))
    else:
        ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("code", "asked").orderBy(*order)))
        ranked = ranked.filter(c("rank") <= n)
    ranked = ranked.withColumnsRenamed({"code": "_c", "asked": "_a"})
    return asked.join(ranked, here).drop("code", "asked", "_c", "_a")


def _first_others(spots: DataFrame, near: DataFrame, overall: DataFrame, n: int) -> DataFrame:
    """For each spot the first ``n`` batters, by all their deliveries, that have none alike."""
    c = F.col
    whole = overall.select("player", c("_r").alias("_recent"), c("_q").alias("_rate"))
    ordered = whole.withColumn("_up", _uplift())
    ordered = scan(ordered, [], [F.desc("_up"), "player"], hot_groups(overall, []), _place=RowNumber()).drop("_up")
    here = c("code").eqNullSafe(c("_c")) & c("asked").eqNullSafe(c("_a"))
    many = near.groupBy(c("code").alias("_c"), c("asked").alias("_a")).agg(F.count(F.lit(1)).alias("_n"))
    counted = with_scalars(spots.select("code", "asked").join(many, here, "left").drop("_c", "_a"), overall.agg(F.count(F.lit(1)).alias("_all")))
    wanted = F.least("_all", F.coalesce("_n", F.lit(0)) + n)
    places = counted.filter("_all > 0").select("code", "asked", F.explode(F.sequence(F.lit(1).cast("long"), wanted)).alias("_place"))
    taken = near.select(c("code").alias("_c"), c("asked").alias("_a"), c("player").alias("_p"))
    others = places.join(ordered, "_place").drop("_place")
    return others.join(taken, here & (c("player") == c("_p")), "left_anti").select("code", "asked", "player", "_recent", "_rate")


def rank_candidates_roles(
    states: DataFrame, roles: DataFrame, pinch_hitters: Sequence[str] = (), n: int | None = None
) -> DataFrame:
    """Batters by 0.6 uplift + 0.4 compatibility + role weight, pure bowlers left out.

    ``roles(player, role, weight)`` is matched without regard to case; unknown players weigh 0.
    """
    c = F.col
    per = (
        states.dropna(subset=["batter"])
        .groupBy(c("batter").alias("player"))
        .agg((F.avg("s8_runs_last_6_balls") / 6.0 - F.avg("s4_required_run_rate")).alias("expected_uplift_runs"))
        .withColumn("_key", F.lower(F.trim("player")))
    )
    known = roles.select(F.lower(F.trim("player")).alias("_key"), "role", "weight")
    fit = F.lit(1.0) / (F.lit(1.0) + F.abs("expected_uplift_runs"))
    scored = per.join(known, "_key", "left").withColumns(
        {
            "role": F.coalesce("role", F.lit("Unknown")),
            "compatibility": fit,
            "weighted_score": c("expected_uplift_runs") * 0.6
            + fit * 0.4
            + F.coalesce(c("weight").cast("double"), F.lit(0.0)),
        }
    )
    spared = c("_key").isin(*[p.lower().strip() for p in pinch_hitters]) if pinch_hitters else F.lit(False)
    kept = scored.filter((c("role") != "Bowler") | spared).drop("_key", "weight")
    out = kept.orderBy(F.desc("weighted_score"), "player")
    return out if n is None else out.limit(n)


def profile_uplift(profiles: DataFrame, state: Mapping[str, float]) -> DataFrame:
    """Expected runs added by each profiled player in the given over state.

    Cosine of the first nine state values with nine scaled profile values, plus strike rate and form.
    """
    names = (
        "current_score", "wickets_fallen", "current_run_rate", "required_run_rate", "overs_remaining",
        "wickets_remaining", "pitch_type_encoded", "dew_factor_proxy", "bowler_fatigue",
    )
    first = [float(state.get(k, 0.0)) for k in names]
    norm = sum(v * v for v in first) ** 0.5
    nvl = lambda name, default: F.coalesce(F.col(name).cast("double"), F.lit(float(default)))
    parts = [
        nvl("batting_avg", 30) / 55,
        nvl("strike_rate", 130) / 180,
        F.lit(1.0) - nvl("bowling_economy", 8) / 15,
        F.lit(1.0) - nvl("death_overs_economy", 8) / 15,
        nvl("current_form_index", 0.5),
        nvl("powerplay_strike_rate", 130) / 190,
        nvl("head_to_head_vs_opponent", 0.5),
        nvl("is_batsman", 0),
        nvl("is_allrounder", 0),
    ]
    dot, sq = F.lit(0.0), F.lit(0.0)
    for s, p in zip(first, parts, strict=True):
        dot, sq = dot + p * F.lit(s), sq + p * p
    fit = F.when((sq > 0) & F.lit(norm > 0), dot / (F.lit(norm or 1.0) * F.sqrt(sq))).otherwise(0.0)
    base = F.col("compatibility") * 20 + (nvl("strike_rate", 130) - 100) / 8.0 + nvl("current_form_index", 0.5) * 15
    role = F.when(nvl("is_batsman", 0) > 0, "BAT").when(nvl("is_bowler", 0) > 0, "BOWL").otherwise("AR")
    return profiles.withColumn("compatibility", fit).select(
        "player",
        (base * F.when(nvl("is_allrounder", 0) > 0, 1.3).otherwise(1.0)).alias("expected_uplift_runs"),
        "compatibility",
        role.alias("primary_role"),
    )


def recommend(
    requests: DataFrame,
    states: DataFrame,
    pol: DataFrame,
    model: object | None = None,
    n: int = 3,
    probability: Column | None = None,
) -> DataFrame:
    """Decision, confidence and top candidates for a table of asked states.

    ``requests`` carries ``request_id`` (unique) and the fourteen dimensions. A state the policy has not seen
    means no substitution with confidence 0; a benefit probability above 0.7 overrules waiting. The probability comes
    from the classifier ``model``, or from the column ``probability`` (a stored score), or is 0.5.
    """
    contexts = requests.select(
        F.col("request_id").alias("context_id"), F.col("s7_phase_code").alias("phase_code"),
        F.col("s4_required_run_rate").alias("required_run_rate"),
    )
    keyed = discretise_state(requests)
    scored = (
        score_classifier(model, keyed).drop("prediction")
        if model is not None
        else keyed.withColumn("probability", F.lit(0.5) if probability is None else probability)
    )
    known = pol.select("state_key", "action", "confidence")
    joined = scored.join(known, "state_key", "left").withColumns(
        {"action": F.coalesce("action", F.lit(0)), "confidence": F.coalesce("confidence", F.lit(0.0))}
    )
    best = rank_candidates_context(states, contexts, n=n)
    lists = best.groupBy(F.col("context_id").alias("request_id")).agg(
        F.sort_array(
            F.collect_list(F.struct("rank", "player", "expected_uplift_runs", "compatibility"))
        ).alias("candidates")
    )
    return joined.join(lists, "request_id", "left").select(
        "request_id",
        "state_key",
        ((F.col("action") > 0) | (F.col("probability") > 0.7)).alias("substitute_now"),
        F.get(F.array(*[F.lit(a) for a in ACTIONS]), F.col("action")).alias("recommended_action"),
        "confidence",
        F.col("probability").alias("benefit_probability"),
        "candidates",
    )


# --- evaluation -----------------------------------------------------------------------------------


def _beside(pol: DataFrame, *columns: Column) -> DataFrame:
    """Columns of a policy, to be broadcast if it has no more states than discretised ones can be."""
    side = stored(pol.select("state_key", *columns), "policy")
    return F.broadcast(side) if side.count() <= MAX_STATE_KEYS else side


def counterfactual(
    states: DataFrame, pol: DataFrame, overs: int = 2, hot: Hot | None = None
) -> DataFrame:
    """Per innings of 12 or more deliveries: first over the policy would act in, against the middle.

    Deliveries are folded to overs before the comparison, so it looks at 50 rows per innings at most.
    """
    sub = _beside(pol, (F.col("action") > 0).alias("_acts"))
    placed = scan(
        states, INNINGS, delivery_order(states), hot, _rn=RowNumber(), _all=Total(F.lit(1))
    ).join(sub, "state_key", "left")
    acts = F.coalesce("_acts", F.lit(False)) & (F.col("_rn") < F.col("_all"))
    per = placed.groupBy(*INNINGS, "over").agg(
        F.sum("s8_runs_last_6_balls").alias("_s"), F.count(F.lit(1)).alias("_n"), F.max(acts).alias("_acts")
    )
    c = F.col
    w = Window.partitionBy(*INNINGS)
    wide = per.withColumns(
        {
            "_first": F.min("over").over(w),
            "_last": F.max("over").over(w),
            "_balls": F.sum("_n").over(w),
            "_opt": F.min(F.when(c("_acts"), c("over"))).over(w),
        }
    ).filter((c("_balls") >= 12) & c("_opt").isNotNull())
    wide = wide.withColumn("_mid", F.floor((c("_first") + c("_last")) / 2).cast("int"))

    def mean(cond: Column) -> Column:
        return F.sum(F.when(cond, c("_s"))) / F.sum(F.when(cond, c("_n"))) * 6

    after = lambda start: (c("over") >= start) & (c("over") <= F.least(c("_last"), start + overs))
    before = (c("over") >= F.greatest(c("_first"), c("_opt") - overs)) & (c("over") < c("_opt"))
    out = wide.groupBy(*INNINGS).agg(
        F.first("_opt").alias("optimal_sub_over"),
        F.first("_mid").alias("actual_sub_over"),
        mean(before).alias("runs_before_opt"),
        mean(after(c("_opt"))).alias("runs_after_opt"),
        mean(after(c("_mid"))).alias("runs_after_actual"),
    )
    return out.withColumn("expected_uplift", c("runs_after_opt") - c("runs_after_actual"))


def verdict(uplift: Column) -> Column:
    return F.when(uplift > 3, "better").when(F.abs(uplift) <= 3, "equal").otherwise("worse")


def counterfactual_summary(cases: DataFrame, uplift: str = "expected_uplift") -> DataFrame:
    mean = F.avg(uplift)
    return cases.agg(
        F.count(F.lit(1)).alias("cases"), flag_sum(F.col(uplift) > 0).alias("wins"), mean.alias("mean_uplift")
    ).withColumn("verdict", verdict(F.col("mean_uplift")))


def policy_value(trans: DataFrame, pol: DataFrame) -> DataFrame:
    """Mean logged reward, and the mean where the logged action is the one the policy prefers."""
    best = _beside(pol, F.col("action").alias("_best"))
    same = F.col("action") == F.coalesce("_best", F.lit(0))
    return (
        trans.join(best, "state_key", "left")
        .agg(
            F.avg("reward").alias("baseline_reward"),
            F.avg(F.when(same, F.col("reward"))).alias("policy_reward"),
            flag_sum(same).alias("matched"),
        )
        .withColumn("uplift_pct", (F.col("policy_reward") - F.col("baseline_reward")) * 100)
    )
