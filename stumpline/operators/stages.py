"""Fitted scaling, projection and clusters as pipeline stages that can be saved and loaded."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NAMES, _NUMBERS = TypeConverters.toListString, TypeConverters.toListFloat


def _add(cols: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols)


class _Stage(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, **values: Sequence) -> None:
        super().__init__()
        self._set(**values)

    def value(self, name: str) -> list:
        return self.getOrDefault(self.getParam(name))


class ScaledProjection(_Stage):
    """Adds one column per axis: the features, each less its mean over its deviation, times the axis' loadings."""

    features = Param(Params._dummy(), "features", "feature columns", _NAMES)
    means = Param(Params._dummy(), "means", "mean of each feature", _NUMBERS)
    deviations = Param(Params._dummy(), "deviations", "population deviation of each feature", _NUMBERS)
    axes = Param(Params._dummy(), "axes", "columns to add", _NAMES)
    loadings = Param(Params._dummy(), "loadings", "loadings, feature after feature", _NUMBERS)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names, axes, load = self.value("features"), self.value("axes"), self.value("loadings")
        z = [(F.col(f) - m) / (s if s > 0 else 1.0) for f, m, s in zip(names, self.value("means"), self.value("deviations"), strict=True)]
        return dataset.withColumns(
            {a: _add([v * F.lit(load[i * len(axes) + j]) for i, v in enumerate(z)]) for j, a in enumerate(axes)}
        )


class NearestCentre(_Stage):
    """Adds ``cluster``, the number of the nearest centre (the first of equally near ones)."""

    features = Param(Params._dummy(), "features", "feature columns", _NAMES)
    centres = Param(Params._dummy(), "centres", "coordinates, centre after centre", _NUMBERS)

    def centre_list(self) -> list[list[float]]:
        flat, width = self.value("centres"), len(self.value("features"))
        return [flat[i : i + width] for i in range(0, len(flat), width)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        names = self.value("features")
        away = F.array(*[_add([(F.col(f) - x) * (F.col(f) - x) for f, x in zip(names, c, strict=True)]) for c in self.centre_list()])
        return dataset.withColumn("cluster", (F.array_position(away, F.array_min(away)) - 1).cast("int"))
