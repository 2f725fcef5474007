"""Tables, written intermediate results and samples shared by the operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stumpline.session import shared_folder

#: Arrow batches hold at most so many rows and bytes, so that long texts do not add up in a worker.
BATCH_ROWS = 1_000
BATCH_BYTES = "16m"
#: Counted tables with more rows are never broadcast.
MAX_BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches in this session; plans read the setting when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` for a join that is never a broadcast, whatever size Spark expects.

    Spark sizes a table by its packed files and takes an explode to add no rows, so it may send to the driver what
    is many times its threshold.
    """
    return df.hint("merge")


def by_rows(df: DataFrame, rows: int) -> DataFrame:
    """``df``, known to have ``rows`` rows, for a join that is by shuffle if they are too many for a broadcast."""
    return by_shuffle(df) if rows > MAX_BROADCAST_ROWS else df


def forget(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that no later step reads."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(conf).delete(path, False)


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % n


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int | None, held_out: int = 5, extra: tuple[str, ...] = ()
) -> DataFrame:
    """About ``rows`` labelled documents, or all for None, outside the held-out fold: ``_text``, ``_label``, ``_order`` and ``extra``.

    The sample is a range of hashed ids, the same in every run. At most ``rows`` labels (plus chance) are
    broadcast; all labels are joined as Spark sees fit. Of a repeated id the text with the smallest hash counts, chosen in each task before the shuffle.
    Labels that are null are left out; of repeated labels the largest counts.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder("doc_id", held_out) != 0))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("_label"))
        .withColumn("_order", F.xxhash64("doc_id", F.lit("sample")))
    )
    if rows is not None:
        there = known.count()
        if there > rows:
            known = known.filter(F.pmod("_order", F.lit(1_000_000)) < int(1e6 * rows / there))
        known = F.broadcast(known)
    texts = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("_text"), *extra)
    found = texts.join(known, "doc_id")
    one = F.min(F.struct(F.xxhash64("_text").alias("_hash"), *extra, "_text", "_label", "_order")).alias("r")
    return found.groupBy("doc_id").agg(one).select("r._text", "r._label", "r._order", *(f"r.{c}" for c in extra))


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator], Iterator]:
    """A function of one record batch as the function ``mapInArrow`` takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def sums_by_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    return np.bincount(row, weights=values, minlength=rows)
