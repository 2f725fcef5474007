"""Per-over excitement, price tiers, peak windows, forecasts and revenue.

Input is the over table. A match has at most 50 overs per innings and team there, so windows per
match stay small whatever the volume of deliveries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.functions.exprs import flag_sum
from stumpline.functions.quantiles import exact_quantiles, with_scalars
from stumpline.functions.scan import lookup
from stumpline.operators.regression import fit_ridge
from stumpline.session import stored

# Price of a 30 second slot, and slots per over.
AD_RATES = {"peak": 2_500_000, "standard": 800_000, "low": 300_000}
SLOTS = 4
CRORE = 1e7
MATCH_ORDER = ("innings", "over", "batting_team")
SERIES_FEATURES = (
    "excitement_normalised", "excitement_lag_1", "excitement_lag_2", "excitement_rolling_3",
    "match_tension_index", "rr_volatility",
)
TIE = ("match_id", *MATCH_ORDER)


def _match() -> Window:
    return Window.partitionBy("match_id").orderBy(*MATCH_ORDER)


def _whole() -> Window:
    """Whole match in the shared order, so that all windows use one sort."""
    return _match().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _upto() -> Window:
    return _match().rowsBetween(Window.unboundedPreceding, 0)


def excitement_density(overs: DataFrame, variant: str = "extended") -> DataFrame:
    """Excitement per over, raw and scaled to 0..1 within the match.

    ``extended`` adds run acceleration and wicket and boundary swings, ``source`` the swing in runs,
    ``simple`` neither.
    """
    c = F.col
    swing = lambda name: F.coalesce(F.abs(c(name) - F.lag(name).over(_match())), F.lit(0))
    base = c("boundaries") * 2.0 + c("wickets") * 4.0 + c("dot_balls") * 0.5
    cols: dict[str, Column] = {
        "excitement_base": base,
        "excitement_chase_bonus": F.when(c("innings") == 2, c("dot_balls") * 1.5).otherwise(0.0),
    }
    total = c("excitement_base") + c("excitement_chase_bonus")
    if variant == "extended":
        cols["run_acceleration"] = (
            F.greatest(c("runs_scored") - F.avg("runs_scored").over(_whole()), F.lit(0.0)) / 6.0
        )
        cols["momentum_shift"] = swing("wickets") * 3.0 + swing("boundaries") * 1.0
        total = total + c("run_acceleration") + c("momentum_shift")
    elif variant == "source":
        cols["momentum_shift"] = swing("runs_scored") * 0.5
        total = total + c("momentum_shift")
    elif variant != "simple":
        raise ValueError("variant is 'extended', 'source' or 'simple'")
    out = overs.withColumns(cols).withColumn("excitement_density", total)
    low, high = F.min("excitement_density").over(_whole()), F.max("excitement_density").over(_whole())
    return out.withColumn("excitement_normalised", (c("excitement_density") - low) / (high - low + 1e-8))


def series_features(df: DataFrame, lags: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Lags, rolling means, running excitement, tension and run-rate volatility within the match."""
    c, w = F.col, _match()
    mean = lambda n: F.avg("excitement_normalised").over(w.rowsBetween(-(n - 1), 0))
    first = {f"excitement_lag_{k}": F.lag("excitement_normalised", k).over(w) for k in lags}
    first |= {
        "excitement_rolling_3": mean(3),
        "excitement_rolling_5": mean(5),
        "cumulative_excitement": F.sum("excitement_density").over(_upto()),
        "_step": c("runs_scored") - F.lag("runs_scored").over(w),
    }
    top = F.max("cumulative_excitement").over(_whole())
    second = {
        "match_tension_index": F.when(top > 0, c("cumulative_excitement") / top).otherwise(0.0),
        "rr_volatility": F.coalesce(F.stddev_samp("_step").over(w.rowsBetween(-2, 0)), F.lit(0.0)),
    }
    return df.withColumns(first).withColumns(second).drop("_step")


def ad_tiers(
    df: DataFrame, value: str = "excitement_density", peak: float = 0.80, season: str | None = None
) -> DataFrame:
    """Slot price from the peak and median excitement, over all overs or per season."""
    probs = {"_p50": 0.50, "_peak": peak}
    if season is None:
        wide = with_scalars(df, exact_quantiles(df, value, probs))
    else:
        named = df.withColumn("_season", F.coalesce(F.col(season).cast("string"), F.lit("default")))
        wide = lookup(named, exact_quantiles(named, value, probs, ["_season"]), ["_season"]).drop("_season")
    top, mid = F.col(value) >= F.col("_peak"), F.col(value) >= F.col("_p50")
    price = F.when(top, AD_RATES["peak"]).when(mid, AD_RATES["standard"]).otherwise(AD_RATES["low"])
    return wide.withColumns(
        {
            "ad_rate_per_30s": price,
            "ad_rate_per_over": price * SLOTS,
            "is_peak_window": top.cast("int"),
        }
    ).drop("_p50", "_peak")


def sequences(
    df: DataFrame, features: Sequence[str] = SERIES_FEATURES, lookback: int = 5, horizon: int = 3
) -> DataFrame:
    """Sliding windows: ``lookback`` rows of features and the next ``horizon`` targets.

    Matches too short for one window yield none. Missing values count as 0.
    """
    w = _match()
    vector = F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features])
    goal = F.coalesce("excitement_normalised", F.lit(0.0))
    return (
        df.withColumns(
            {
                "x": F.collect_list(vector).over(w.rowsBetween(-(lookback - 1), 0)),
                "y": F.collect_list(goal).over(w.rowsBetween(1, horizon)),
            }
        )
        .filter((F.size("x") == lookback) & (F.size("y") == horizon))
        .select(*TIE, "x", "y")
    )


def in_share(key: str, share: float) -> Column:
    """True for about ``share`` of the keys, always the same ones."""
    limit = min(int(share * 2**32), 2**32 - 1)
    return F.substring(F.md5(F.col(key).cast("string")), 1, 8) < F.lit(f"{limit:08x}")


def split_by_group(df: DataFrame, key: str = "match_id", share: float = 0.7) -> DataFrame:
    """Add ``split``: whole groups go to train or validation."""
    return df.withColumn("split", F.when(in_share(key, share), "train").otherwise("validation"))


def lagged_inputs(
    df: DataFrame, features: Sequence[str] = SERIES_FEATURES, lookback: int = 5, horizon: int = 3
) -> tuple[DataFrame, list[str]]:
    """One column per feature and lag, the next ``horizon`` values, and whether the row has a full past."""
    w = _match()
    inputs = {
        f"in_{f}_{k}": F.lag(F.coalesce(F.col(f).cast("double"), F.lit(0.0)), k).over(w)
        for f in features
        for k in range(lookback)
    }
    goals = {f"next_{h}": F.lead("excitement_normalised", h).over(w) for h in range(1, horizon + 1)}
    full = {"_full": F.row_number().over(w) >= lookback}
    return df.withColumns(inputs | goals | full), list(inputs)


def forecast(
    df: DataFrame,
    features: Sequence[str] = SERIES_FEATURES,
    lookback: int = 5,
    horizon: int = 3,
    train_share: float = 0.7,
    learner: str = "linear",
    ridge: float = 1e-3,
    trees: int = 20,
    depth: int = 4,
) -> DataFrame:
    """Excitement 1..``horizon`` overs ahead, one regressor per step, trained on part of the matches.

    The linear form fits all steps in one pass over the rows; ``gbt`` boosts ``trees`` trees of ``depth`` per step. Rows
    without a full past are predicted as 0. The actual later values and the split are kept.
    """
    wide, inputs = lagged_inputs(df, features, lookback, horizon)
    goals = [f"next_{h}" for h in range(1, horizon + 1)]
    rows = split_by_group(wide, share=train_share).withColumns(
        {c: F.coalesce(c, F.lit(0.0)) for c in inputs}
    )
    rows = stored(rows, "lagged")
    past = rows.filter(F.col("_full") & (F.col("split") == "train"))
    if learner == "gbt":
        rows = VectorAssembler(inputCols=inputs, outputCol="features").transform(rows)
        for h, goal in enumerate(goals, 1):
            make = GBTRegressor(featuresCol="features", labelCol=goal, predictionCol=f"_raw_{h}", maxIter=trees, maxDepth=depth, seed=42)
            known = VectorAssembler(inputCols=inputs, outputCol="features").transform(past.filter(F.col(goal).isNotNull()))
            rows = make.fit(known).transform(rows)
        rows = rows.drop("features")
    else:
        fitted = fit_ridge(past, inputs, goals, ridge)
        rows = rows.withColumns({f"_raw_{h}": fitted[goal].predict(inputs) for h, goal in enumerate(goals, 1)})
    predicted = {f"predicted_excitement_t{h}": F.when(F.col("_full"), F.col(f"_raw_{h}")).otherwise(0.0) for h in range(1, horizon + 1)}
    return rows.withColumns(predicted).drop("_full", *inputs, *[f"_raw_{h}" for h in range(1, horizon + 1)])


def naive_forecast(df: DataFrame) -> DataFrame:
    """Current excitement as the prediction for the next over."""
    return df.withColumn("predicted_excitement_t1", F.col("excitement_normalised"))


def forecast_error(
    df: DataFrame, actual: str = "next_1", predicted: str = "predicted_excitement_t1"
) -> DataFrame:
    gap = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(gap * gap).alias("mse"), F.count(gap).alias("n"))


def with_next(df: DataFrame, horizon: int = 1) -> DataFrame:
    """Add the excitement of the following overs."""
    return df.withColumns(
        {f"next_{h}": F.lead("excitement_normalised", h).over(_match()) for h in range(1, horizon + 1)}
    )


def match_peak_window(
    df: DataFrame, one: str = "predicted_excitement_t1", two: str = "predicted_excitement_t2", q: float = 0.8
) -> DataFrame:
    """Flag overs whose mean prediction for the next two overs tops the match's own quantile."""
    # At most a few hundred overs per match.
    limits = df.groupBy("match_id").agg(F.percentile(F.col("excitement_normalised"), q).alias("_limit"))
    flag = (F.col(one) + F.col(two)) / 2.0 > F.col("_limit")
    return df.join(limits, "match_id").withColumn("predicted_peak_window", flag).drop("_limit")


def peak_detect(
    df: DataFrame, predicted: str = "excitement_normalised", actual: str = "excitement_normalised", q: float = 0.8
) -> DataFrame:
    """Flag predictions above the overall quantile, number runs of flags, mark runs of two or more."""
    w = _match()
    flagged = with_scalars(df, exact_quantiles(df, actual, {"_limit": q})).withColumn(
        "is_peak_predicted", (F.col(predicted) > F.col("_limit")).cast("int")
    )
    # Rows of one run share the difference of their place in the match and among equal flags.
    island = F.row_number().over(w) - F.row_number().over(
        Window.partitionBy("match_id", "is_peak_predicted").orderBy(*MATCH_ORDER)
    )
    run = Window.partitionBy("match_id", "is_peak_predicted", "_island").orderBy(*MATCH_ORDER)
    return (
        flagged.withColumn("_island", island)
        .withColumn("peak_streak", F.col("is_peak_predicted") * F.row_number().over(run))
        .withColumn("engagement_window", (F.col("peak_streak") >= 2).cast("int"))
        .drop("_island", "_limit")
    )


def precision_at_1(df: DataFrame) -> DataFrame:
    hits = flag_sum((F.col("engagement_window") == 1) & (F.col("is_peak_predicted") == 1))
    flags = F.sum("is_peak_predicted")
    return df.agg((hits / F.greatest(flags, F.lit(1))).alias("precision_at_1"))


# --- revenue --------------------------------------------------------------------------------------


def guided_price(df: DataFrame) -> Column:
    """Peak price in windows and peak overs, 80 % of it on a lone predicted peak, else standard."""
    have = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1 if c in df.columns else F.lit(False)
    return (
        F.when(have("engagement_window") | have("is_peak_window"), float(AD_RATES["peak"]))
        .when(have("is_peak_predicted"), AD_RATES["peak"] * 0.8)
        .otherwise(float(AD_RATES["standard"]))
    )


def revenue_uniform(df: DataFrame) -> DataFrame:
    return df.agg((F.count(F.lit(1)) * AD_RATES["standard"] * SLOTS).alias("uniform_revenue"))


def revenue_model_guided(df: DataFrame) -> DataFrame:
    return df.agg((F.sum(guided_price(df)) * SLOTS).alias("model_revenue"))


def revenue_draws(df: DataFrame, n: int = 50) -> DataFrame:
    """Revenue of ``n`` random price allocations next to the guided and the uniform one.

    The price of an over in a draw comes from a digest of (draw, over), so reruns agree. Each task
    sums its own draws: only ``n`` rows per task are shuffled.
    """
    name = F.concat_ws(":", F.col("simulation").cast("string"), *[F.col(c).cast("string") for c in TIE])
    digit = F.substring(F.md5(name), 1, 8)
    price = (
        F.when(digit < "55555555", AD_RATES["peak"])
        .when(digit < "aaaaaaaa", AD_RATES["standard"])
        .otherwise(AD_RATES["low"])
    )
    return (
        df.withColumn("_guided", guided_price(df))
        .withColumn("simulation", F.explode(F.sequence(F.lit(1), F.lit(n))))
        .groupBy("simulation")
        .agg(
            (F.sum("_guided") * SLOTS).alias("model_revenue"),
            (F.sum(price) * SLOTS).cast("double").alias("random_revenue"),
            (F.count(F.lit(1)) * AD_RATES["standard"] * SLOTS).cast("double").alias("uniform_revenue"),
        )
        .withColumns(
            {
                "uplift_vs_random": F.col("model_revenue") - F.col("random_revenue"),
                "uplift_vs_uniform": F.col("model_revenue") - F.col("uniform_revenue"),
            }
        )
    )


def revenue_resample(df: DataFrame, n: int = 50) -> DataFrame:
    """Mean revenues and the spread of the uplift over ``n`` draws, in crore."""
    draws = revenue_draws(df, n)
    mean = lambda c: (F.avg(c) / CRORE).alias(f"mean_{c}_cr")
    spread = [
        (F.percentile(F.col("uplift_vs_random"), p / 100) / CRORE).alias(f"uplift_p{p}_cr")
        for p in (5, 25, 50, 75, 95)
    ]
    names = ("model_revenue", "random_revenue", "uniform_revenue", "uplift_vs_random", "uplift_vs_uniform")
    return draws.agg(*[mean(c) for c in names], *spread)


# --- reports --------------------------------------------------------------------------------------


def hot_zone_overs(df: DataFrame, q: float = 0.8) -> DataFrame:
    """Overs above the match's own quantile, numbered from the most exciting down."""
    limits = df.groupBy("match_id").agg(F.percentile(F.col("excitement_normalised"), q).alias("peak_threshold"))
    place = Window.partitionBy("match_id").orderBy(F.desc("excitement_normalised"), *MATCH_ORDER)
    return (
        df.join(limits, "match_id")
        .withColumn("zone_rank", F.row_number().over(place))
        .filter(F.col("excitement_normalised") > F.col("peak_threshold"))
        .select(*TIE, "excitement_normalised", "runs_scored", "wickets", "peak_threshold", "zone_rank")
    )


def hot_zones(df: DataFrame, q: float = 0.8, top: int = 5) -> DataFrame:
    """Per match: overs, peak overs, revenue estimate, first team and the ``top`` overs."""
    limits = df.groupBy("match_id").agg(F.percentile(F.col("excitement_normalised"), q).alias("peak_threshold"))
    order = Window.partitionBy("match_id").orderBy(F.desc("excitement_normalised"), *MATCH_ORDER)
    zone = F.struct("zone_rank", "innings", "over", "excitement_normalised", "runs_scored", "wickets")
    per = (
        df.join(limits, "match_id")
        .withColumn("zone_rank", F.row_number().over(order))
        .groupBy("match_id")
        .agg(
            F.min_by("batting_team", F.struct(*MATCH_ORDER)).alias("team1"),
            F.count(F.lit(1)).alias("total_overs"),
            flag_sum(F.col("excitement_normalised") > F.col("peak_threshold")).alias("peak_overs"),
            F.first("peak_threshold").alias("peak_threshold"),
            F.sort_array(F.collect_list(F.when(F.col("zone_rank") <= top, zone))).alias("top_zones"),
        )
    )
    peaks, rest = F.col("peak_overs"), F.col("total_overs") - F.col("peak_overs")
    value = (peaks * AD_RATES["peak"] + rest * AD_RATES["standard"]) * SLOTS
    return per.withColumn("estimated_ad_revenue_cr", value / CRORE)


def engagement_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct("match_id").alias("n_matches"),
        F.count(F.lit(1)).alias("n_overs"),
        F.avg("excitement_density").alias("mean_excitement"),
        F.avg(F.col("engagement_window").cast("double")).alias("peak_window_fraction"),
    )


def timeline(df: DataFrame, match_id: str) -> DataFrame:
    """Ordered series of one match."""
    return (
        df.filter(F.col("match_id") == match_id)
        .orderBy(*MATCH_ORDER)
        .select(*TIE, "excitement_density", "excitement_normalised", "runs_scored", "wickets")
    )


def top_overs(df: DataFrame, n: int = 5) -> DataFrame:
    """The most exciting overs of all matches."""
    return (
        df.orderBy(F.desc("excitement_density"), *TIE)
        .limit(n)
        .select(*TIE, "excitement_density", "runs_scored", "wickets", "boundaries")
    )
