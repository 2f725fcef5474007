"""Scaling, projection, clustering, cluster quality and cluster names.

Functions take a table with one double column per feature. Clusters are few (k), so tables with
one row per cluster are small whatever the number of players.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stumpline.functions.quantiles import with_scalars
from stumpline.operators import lloyd
from stumpline.operators.stages import NearestCentre, ScaledProjection
from stumpline.session import stored

# Groups of tiles per core that the Euclidean silhouette deals its rows to, and bytes that a group's rows may take.
GROUPS_PER_CORE = 2
GROUP_BYTES = 1 << 28


def _add(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


def feature_scale(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row with mean and population deviation of every feature."""
    return df.agg(
        *[F.avg(f).alias(f"_mean_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"_std_{f}") for f in features],
    )


def standardise(df: DataFrame, features: Sequence[str], scale: DataFrame | None = None) -> DataFrame:
    """Zero mean and unit population variance; a constant feature becomes 0.

    Pass the ``feature_scale`` of another table to apply its scaling.
    """
    out = with_scalars(df, scale if scale is not None else feature_scale(df, features))
    z = {
        f: (F.col(f) - F.col(f"_mean_{f}"))
        / F.when(F.col(f"_std_{f}") > 0, F.col(f"_std_{f}")).otherwise(F.lit(1.0))
        for f in features
    }
    return out.withColumns(z).select(df.columns)


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df)


@dataclass(frozen=True)
class Projection:
    """Principal axes with a fixed sign: the largest loading of each axis is positive."""

    features: tuple[str, ...]
    loadings: np.ndarray
    variance: np.ndarray
    model: PCAModel

    def apply(self, df: DataFrame) -> DataFrame:
        axes = {
            f"pc{j + 1}": _add(
                [F.col(f) * F.lit(float(self.loadings[i, j])) for i, f in enumerate(self.features)]
            )
            for j in range(self.loadings.shape[1])
        }
        return df.withColumns(axes)

    @property
    def axes(self) -> list[str]:
        return [f"pc{j + 1}" for j in range(self.loadings.shape[1])]


def fit_pca(standardised: DataFrame, features: Sequence[str], k: int = 3) -> Projection:
    """Principal axes of standardised features; the covariance is aggregated on the executors."""
    model = PCA(k=k, inputCol="features", outputCol="_pca").fit(assemble(standardised, features))
    axes = model.pc.toArray()
    sign = np.sign(axes[np.abs(axes).argmax(axis=0), range(axes.shape[1])])
    sign[sign == 0] = 1.0
    return Projection(tuple(features), axes * sign, model.explainedVariance.toArray(), model)


def pca_loadings(df: DataFrame, projection: Projection) -> DataFrame:
    """Feature by axis loadings."""
    rows = [
        (f, *[float(x) for x in projection.loadings[i]]) for i, f in enumerate(projection.features)
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, " + ", ".join(f"{a} double" for a in projection.axes)
    )


def pca_variance(df: DataFrame, projection: Projection) -> DataFrame:
    rows = [(a, float(v)) for a, v in zip(projection.axes, projection.variance, strict=True)]
    return df.sparkSession.createDataFrame(rows, "axis string, explained_variance_ratio double")


def fit_kmeans(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42, steps: int = 300) -> NearestCentre:
    """Centres that have stopped moving; raises where ``steps`` passes do not suffice."""
    return nearest_centre(cols, lloyd.fit(lloyd.points_of(df, cols), len(cols), [k], seed, steps=steps)[k])


def nearest_centre(cols: Sequence[str], found: lloyd.Clusters) -> NearestCentre:
    return NearestCentre(features=list(cols), centres=[float(x) for x in found.centres.ravel()])


def assign_clusters(df: DataFrame, model: NearestCentre) -> DataFrame:
    return model.transform(df)


def _swept(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int) -> tuple[dict[int, lloyd.Clusters], dict[int, float], int]:
    points = lloyd.points_of(df, cols)
    found = lloyd.fit(points, len(cols), list(ks), seed)
    score = lloyd.silhouettes(points, len(cols), found)
    return found, score, max(ks, key=lambda k: (score[k], -k))


def sweep_k(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = range(2, 9), seed: int = 42) -> DataFrame:
    """Silhouette and inertia for each k, with the best k flagged; all k share the passes over the rows."""
    found, score, best = _swept(df, cols, ks, seed)
    return df.sparkSession.createDataFrame(
        [(k, score[k], found[k].inertia, k == best) for k in ks], "k int, silhouette double, inertia double, is_best boolean"
    )


@dataclass(frozen=True)
class ClusterFit:
    """Scaling with projection and clusters of a player table, as stages; ``pipeline`` can be saved and loaded."""

    projection: Projection
    scaled: ScaledProjection
    kmeans: NearestCentre
    labelled: DataFrame

    @property
    def pipeline(self) -> PipelineModel:
        return PipelineModel([self.scaled, self.kmeans])

    def centers(self) -> list[list[float]]:
        return self.kmeans.centre_list()

    def predict(self, df: DataFrame) -> DataFrame:
        """Cluster (and axes) of players the fit has not seen."""
        return self.pipeline.transform(df).drop(*self.projection.features)


def fit_clusters(
    df: DataFrame, features: Sequence[str], k: int | None = None, components: int = 3, seed: int = 42
) -> ClusterFit:
    """Scale, project, choose k on the projected space when it is not given, cluster there.

    The table is written once, and everything is fitted on what was written.
    """
    players = stored(df, "players")
    scale = feature_scale(players, features).first()
    projection = fit_pca(standardise(players, features), features, components)
    scaled = ScaledProjection(
        features=list(features), means=[scale[f"_mean_{f}"] for f in features], deviations=[scale[f"_std_{f}"] for f in features],
        axes=projection.axes, loadings=[float(x) for x in projection.loadings.ravel()],
    )
    placed = scaled.transform(players)
    if k is None:
        found, _, best = _swept(placed, projection.axes, range(2, 9), seed)
        model = nearest_centre(projection.axes, found[best])
    else:
        model = fit_kmeans(placed, projection.axes, k, seed)
    return ClusterFit(projection, scaled, model, model.transform(placed))


# --- cluster quality ------------------------------------------------------------------------------


def cluster_moments(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Per cluster: size, sum of every feature, sum of squared norms."""
    return df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{c}") for c in cols],
        F.sum(_add([F.col(c) * F.col(c) for c in cols])).alias("_sq"),
    )


def silhouette(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean silhouette with squared Euclidean distance, exact, without forming pairs.

    The mean squared distance of x to cluster C is |x|^2 - 2 x.S/n + Q/n, with S the sum and Q the
    sum of squared norms of C, so k moments are all a row needs.
    """
    moments = cluster_moments(df, cols, cluster).agg(
        F.collect_list(
            F.struct(
                F.col(cluster).alias("c"),
                F.col("_n").alias("n"),
                F.array(*[F.col(f"_sum_{c}") for c in cols]).alias("s"),
                F.col("_sq").alias("q"),
            )
        ).alias("_moments")
    )
    rows = with_scalars(df, moments).withColumns(
        {"_x": F.array(*[F.col(c) for c in cols]), "_x2": _add([F.col(c) * F.col(c) for c in cols])}
    )

    def total_distance(m: Column) -> Column:
        dot = F.aggregate(F.zip_with("_x", m["s"], lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
        return F.col("_x2") * m["n"] - dot * 2.0 + m["q"]

    own = F.element_at(F.filter("_moments", lambda m: m["c"] == F.col(cluster)), 1)
    others = F.filter("_moments", lambda m: m["c"] != F.col(cluster))
    a = F.greatest(total_distance(own), F.lit(0.0)) / (own["n"] - 1)
    b = F.array_min(F.transform(others, lambda m: F.greatest(total_distance(m), F.lit(0.0)) / m["n"]))
    score = F.when(own["n"] == 1, 0.0).otherwise(
        F.when(F.greatest(a, b) > 0, (b - a) / F.greatest(a, b)).otherwise(0.0)
    )
    return rows.agg(F.avg(score).alias("silhouette"))


def silhouette_groups(rows: int, width: int, clusters: int, tiles: int, cores: int) -> int:
    """Groups of tiles: some for each core, fewer if there are fewer tiles, and more where a group would hold more than ``GROUP_BYTES``."""
    return max(1, min(tiles, max(GROUPS_PER_CORE * cores, -(-rows * (width + clusters) * 8 // GROUP_BYTES))))


def silhouette_euclidean(df: DataFrame, cols: Sequence[str], cluster: str = "cluster", tile_rows: int = 2_048) -> DataFrame:
    """Mean silhouette with Euclidean distance, exact: the work grows with the square of the rows.

    Rows are packed in tiles and these dealt to groups. A group holds its tiles and meets every tile, itself included, as
    matrices; what is kept are its rows' sums of distances per cluster, so no pair of rows becomes a row, and a task holds
    its group, one tile more and the distances of two tiles. A tile is shuffled once for each group, and the number of groups
    does not grow with the rows until a group is large. The
    squared form (``silhouette``) needs one pass instead. A row without company in its cluster scores 0.
    """
    width = len(cols)
    rows = df.select(F.col(cluster).cast("string").alias("c"), F.array(*[F.col(f).cast("double") for f in cols]).alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[str] = []
        held: list[np.ndarray] = []

        def tile(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal names, held
            x = np.concatenate(held) if held else np.zeros((0, width))
            while len(x) >= tile_rows or (last and len(x)):
                yield pa.record_batch([pa.array([names[:tile_rows]]), pa.array([x[:tile_rows].tobytes()])], names=["labels", "vectors"])
                names, x = names[tile_rows:], x[tile_rows:]
            held = [x]

        for batch in batches:
            names += batch.column("c").to_pylist()
            held.append(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width))
            yield from tile(False)
        yield from tile(True)

    packed = rows.mapInArrow(pack, "labels array<string>, vectors binary")
    tiles = stored(packed.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    size = {r["c"]: r["n"] for r in rows.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    place = {c: i for i, c in enumerate(size)}
    many = np.array([float(n) for n in size.values()])
    ids = [r[0] for r in tiles.select("tile").orderBy("tile").collect()]
    groups = silhouette_groups(sum(size.values()), width, len(size), len(ids), df.sparkSession.sparkContext.defaultParallelism)
    dealt = pa.table({"tile": pa.array(ids, pa.int64()), "at": pa.array([i % groups for i in range(len(ids))], pa.int32())})
    own_tiles = tiles.join(F.broadcast(tiles.sparkSession.createDataFrame(dealt)), "tile").select("at", F.lit(0).alias("kind"), "labels", "vectors")
    met = tiles.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("at"), F.lit(1).alias("kind"), "labels", "vectors")
    line = own_tiles.unionByName(met)

    def score(own: np.ndarray, total: np.ndarray) -> float:
        each = np.arange(len(own))
        inside = total[each, own] / np.maximum(many[own] - 1, 1)
        mean = total / many
        mean[each, own] = np.inf
        outside = mean.min(axis=1)
        top = np.maximum(inside, outside)
        able = (many[own] > 1) & np.isfinite(outside) & (top > 0)
        return float(np.where(able, (outside - inside) / np.where(able, top, 1), 0.0).sum())

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, result = None, [], 0.0  # own: vectors, squares, labels and totals of the tiles of the group
        for batch in batches:
            for here, kind, labels, vectors in zip(*(batch.column(c) for c in ("at", "kind", "labels", "vectors")), strict=True):
                code = np.array([place[c] for c in labels.as_py()])
                y = np.frombuffer(vectors.as_py()).reshape(-1, width)
                if here.as_py() != at:
                    result += sum(score(c, total) for *_, c, total in own)
                    at, own = here.as_py(), []
                if kind.as_py() == 0:
                    own.append((y, (y * y).sum(1)[:, None], code, np.zeros((len(code), len(many)))))
                    continue
                order = np.argsort(code, kind="stable")
                found, starts = np.unique(code[order], return_index=True)
                other, square = y[order].T, (y[order] ** 2).sum(1)
                for x, mine, _, total in own:
                    away = np.sqrt(np.maximum(mine - 2 * x @ other + square, 0))
                    total[:, found] += np.add.reduceat(away, starts, axis=1)
        result += sum(score(c, total) for *_, c, total in own)
        yield pa.record_batch([pa.array([result])], names=["s"])

    sums = line.repartitionById(groups, "at").sortWithinPartitions("at", "kind").mapInArrow(meet, "s double")
    return sums.agg((F.sum("s") / F.lit(float(many.sum()) or None)).alias("silhouette"))


def calinski_harabasz(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Between against within dispersion, each over its degrees of freedom."""
    per = cluster_moments(df, cols, cluster)
    norm = _add([F.col(f"_sum_{c}") * F.col(f"_sum_{c}") for c in cols])
    total = _add([F.sum(f"_sum_{c}") * F.sum(f"_sum_{c}") for c in cols]) / F.sum("_n")
    parts = per.agg(
        F.count(F.lit(1)).alias("_k"),
        F.sum("_n").alias("_all"),
        (F.sum(norm / F.col("_n")) - total).alias("_between"),
        (F.sum("_sq") - F.sum(norm / F.col("_n"))).alias("_within"),
    )
    k, n = F.col("_k"), F.col("_all")
    value = F.when(
        F.col("_within") > 0, F.col("_between") * (n - k) / (F.col("_within") * (k - 1))
    ).otherwise(1.0)
    return parts.select(value.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Mean over clusters of the worst (spread + spread) / centroid distance."""
    centers = df.groupBy(cluster).agg(*[F.avg(c).alias(f"_c_{c}") for c in cols])
    joined = df.join(F.broadcast(centers), cluster)  # k rows
    away = F.sqrt(_add([(F.col(c) - F.col(f"_c_{c}")) * (F.col(c) - F.col(f"_c_{c}")) for c in cols]))
    spread = joined.groupBy(cluster).agg(
        F.avg(away).alias("s"), F.first(F.array(*[F.col(f"_c_{c}") for c in cols])).alias("v")
    )
    listed = spread.agg(F.collect_list(F.struct(F.col(cluster).alias("c"), "s", "v")).alias("_all"))

    def worst(x: Column) -> Column:
        gap = lambda y: F.sqrt(
            F.aggregate(
                F.zip_with(x["v"], y["v"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, d: t + d
            )
        )
        rest = F.filter("_all", lambda y: y["c"] != x["c"])
        return F.array_max(F.transform(rest, lambda y: (x["s"] + y["s"]) / gap(y)))

    mean = F.aggregate(F.transform("_all", worst), F.lit(0.0), lambda t, v: t + v) / F.size("_all")
    return listed.select(mean.alias("davies_bouldin"))


def centroid_profile(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(*[F.avg(f).alias(f) for f in features])


def feature_separation(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Population variance of the cluster means, per feature, widest first."""
    long = centroid_profile(df, features, cluster).unpivot([cluster], list(features), "feature", "mean")
    return (
        long.groupBy("feature")
        .agg(F.var_pop("mean").alias("between_cluster_var"))
        .orderBy(F.desc("between_cluster_var"), "feature")
    )


# --- names ----------------------------------------------------------------------------------------


def name_archetypes_absolute(centroids: DataFrame) -> DataFrame:
    """Four labels from absolute limits on the centroid."""
    sr, dot, out = F.col("pressure_sr"), F.col("pressure_dot_pct"), F.col("pressure_dismissal_rate")
    decay, clutch = F.col("performance_decay_slope"), F.col("clutch_runs_above_expected")
    return centroids.withColumn(
        "archetype",
        F.when((sr > 135) & (dot < 0.40) & (out < 0.12) & (decay > -0.3) & (clutch > 0), "Ice-blooded finisher")
        .when((sr < 115) | (dot > 0.50), "Pressure crumbler")
        .when((out < 0.10) & (F.abs(decay) < 0.5), "Steady accumulator")
        .otherwise("Panic scorer"),
    )


def name_archetypes_quantile(
    centroids: DataFrame,
    death: str = "death_overs_sr",
    chase: str = "chase_pressure_sr",
    boundary: str = "boundary_dependency",
    collapse: str = "collapse_resistance_score",
) -> DataFrame:
    """Six labels from quartiles over the centroids themselves."""
    roles = {"d": death, "c": chase, "b": boundary, "r": collapse}
    # One value per cluster: k values at most.
    limits = centroids.agg(
        *[
            F.percentile(F.col(col), q).alias(f"_{r}{label}")
            for r, col in roles.items()
            for label, q in (("25", 0.25), ("50", 0.5), ("75", 0.75))
        ]
    )
    c = {r: F.col(col) for r, col in roles.items()}
    up = lambda r, q: c[r] >= F.col(f"_{r}{q}")
    down = lambda r, q: c[r] <= F.col(f"_{r}{q}")
    label = (
        F.when(up("d", 75) & up("c", 75) & up("b", 75), "Ice Finisher")
        .when(down("d", 25) & down("b", 25), "Risk Stabilizer")
        .when(up("d", 75) & down("b", 25) & up("r", 75), "Collapse Anchor")
        .when(up("d", 75) & up("b", 75), "Power Enforcer")
        .when(up("d", 50) & up("c", 50) & down("b", 50), "Chaos Accelerator")
        .otherwise("Situational Player")
    )
    return with_scalars(centroids, limits).withColumn("archetype", label).select(*centroids.columns, "archetype")


def name_archetypes_counts(centroids: DataFrame, features: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Six labels from the share of varying features in the upper or lower quartile."""
    long = centroids.unpivot([cluster], list(features), "feature", "mean")
    limits = long.groupBy("feature").agg(
        F.stddev_samp("mean").alias("_sd"),
        F.percentile(F.col("mean"), 0.75).alias("_q75"),
        F.percentile(F.col("mean"), 0.25).alias("_q25"),
    )
    varying = F.coalesce(F.col("_sd") > 0, F.lit(False))
    counts = (
        long.join(F.broadcast(limits), "feature")  # one row per feature
        .groupBy(cluster)
        .agg(
            F.sum((varying & (F.col("mean") >= F.col("_q75"))).cast("int")).alias("high_count"),
            F.sum((varying & (F.col("mean") <= F.col("_q25"))).cast("int")).alias("low_count"),
            F.sum(varying.cast("int")).alias("n_features"),
        )
    )
    high, low, n = F.col("high_count"), F.col("low_count"), F.col("n_features")
    return counts.withColumn(
        "archetype",
        F.when(n == 0, "Unclassified")
        .when(high >= n * 0.6, "Ice Finisher")
        .when(low >= n * 0.6, "Risk Stabilizer")
        .when(high >= n * 0.4, "Power Enforcer")
        .when((high >= n * 0.2) & (low < n * 0.3), "Collapse Anchor")
        .when(high >= n * 0.25, "Chaos Accelerator")
        .otherwise("Situational Player"),
    )


def archetype_summary(
    labelled: DataFrame, cluster: str = "cluster", label: str = "archetype", player: str = "player", first: int = 10
) -> DataFrame:
    """Per cluster: label, size and its first members by name."""
    sizes = labelled.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("size"))
    place = F.row_number().over(Window.partitionBy(cluster).orderBy(player))
    members = (
        labelled.select(cluster, player)
        .withColumn("_rn", place)
        .filter(F.col("_rn") <= first)
        .groupBy(cluster)
        .agg(F.sort_array(F.collect_list(player)).alias("members"))
    )
    return sizes.join(members, cluster)
