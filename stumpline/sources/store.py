"""Parquet feature store, exports and saved models."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession

from stumpline.operators.aggregates import match_level, over_level, player_level
from stumpline.operators.clean import clean_events
from stumpline.operators.state import event_state
from stumpline.sources.harmonize import merge_sources
from stumpline.sources.readers import path_exists, read_all_sources

# Feature store keys, in the order they depend on each other.
STORE_KEYS = ("full_canonical", "match_state", "over_level", "player_level", "match_level")


def store_path(folder: str, key: str) -> str:
    if key not in STORE_KEYS:
        raise ValueError(f"Unknown feature store table '{key}'. Known: {list(STORE_KEYS)}")
    return f"{folder.rstrip('/')}/{key}.parquet"


def build_feature_store(
    spark: SparkSession,
    folder: str,
    raw_folder: str | None = None,
    force: bool = False,
    frames: Mapping[str, DataFrame] | None = None,
    partition_by: str | None = None,
) -> dict[str, DataFrame]:
    """Write the five tables, reusing those that exist unless ``force``.

    Every table is read back after it is written, so later tables start from parquet and not from
    the raw text again. The delivery tables keep ``source_rank`` and ``seq``, the order of arrival, which
    settles repeated (over, ball).
    """

    def canonical() -> DataFrame:
        raw = frames if frames is not None else read_all_sources(spark, raw_folder or folder)
        return clean_events(merge_sources(raw))

    makers = {
        "full_canonical": lambda t: canonical(),
        "match_state": lambda t: event_state(t["full_canonical"]),
        "over_level": lambda t: over_level(t["match_state"]),
        "player_level": lambda t: player_level(t["match_state"]),
        "match_level": lambda t: match_level(t["match_state"]),
    }
    tables: dict[str, DataFrame] = {}
    for key in STORE_KEYS:
        path = store_path(folder, key)
        if force or not path_exists(spark, path):
            df = makers[key](tables)
            writer = df.write.mode("overwrite")
            if partition_by and partition_by in df.columns:
                writer = writer.partitionBy(partition_by)
            writer.parquet(path)
        tables[key] = spark.read.parquet(path)
    return tables


def load_feature_store(spark: SparkSession, folder: str, key: str) -> DataFrame:
    path = store_path(folder, key)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"{path} is missing; run build_feature_store first")
    return spark.read.parquet(path)


def store_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Per table: present, rows, bytes; ``all_ready`` when every table is present."""
    conf = spark._jsc.hadoopConfiguration()
    rows = []
    for key in STORE_KEYS:
        path = store_path(folder, key)
        present = path_exists(spark, path)
        size, n = 0, 0
        if present:
            hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
            size = hadoop.getFileSystem(conf).getContentSummary(hadoop).getLength()
            n = spark.read.parquet(path).count()
        rows.append((key, present, n, size))
    ready = all(r[1] for r in rows)
    return spark.createDataFrame(
        [(*r, ready) for r in rows],
        "table string, present boolean, rows long, bytes long, all_ready boolean",
    )


def export_results(folder: str, parquet: Mapping[str, DataFrame], json: Mapping[str, DataFrame] | None = None) -> None:
    """Write result tables as parquet, and small lookup tables (policies) as JSON lines."""
    for name, df in parquet.items():
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}.parquet")
    for name, df in (json or {}).items():
        df.write.mode("overwrite").json(f"{folder.rstrip('/')}/{name}.json")


def read_results(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A result table written by ``export_results``."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_policy(spark: SparkSession, path: str) -> DataFrame:
    """State-action values written by ``export_results``."""
    return spark.read.schema("state_key string, action int, q double").json(path)


def save_model(model: MLWritable, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)
