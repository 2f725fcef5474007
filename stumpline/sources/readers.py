"""CSV sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.sources.schema import DIALECTS, USER_REQUIRED, USER_TYPES


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence on whatever file system the path names."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def source_path(folder: str, name: str) -> str:
    if name not in DIALECTS:
        raise ValueError(f"Unknown raw source '{name}'. Known: {sorted(DIALECTS)}")
    return f"{folder.rstrip('/')}/{name}.csv"


def read_source(spark: SparkSession, name: str, folder: str) -> DataFrame:
    """Raw text columns of one source. ``seq`` orders rows by file, block and position in the block.

    All columns stay text: types are settled by the mapping rules, and "0.10" must not become 0.1.
    """
    path = source_path(folder, name)
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    raw = spark.read.csv(path, header=True, inferSchema=False)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return raw.select("*", place.alias("seq"))


def read_all_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every source whose file is present, in dialect order."""
    return {n: read_source(spark, n, folder) for n in DIALECTS if path_exists(spark, source_path(folder, n))}


def read_users(spark: SparkSession, path: str, n: int | None = None) -> DataFrame:
    """User activity rows, the first ``n`` by id when asked; required columns are checked."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    raw = spark.read.csv(path, header=True, inferSchema=False)
    absent = [c for c in USER_REQUIRED if c not in raw.columns]
    if absent:
        raise ValueError(f"User file lacks columns: {absent}")
    typed = raw.select(
        *[F.col(c).try_cast(USER_TYPES[c]).alias(c) if c in USER_TYPES else F.col(c) for c in raw.columns]
    )
    return typed if n is None else typed.orderBy("user_id").limit(n)
