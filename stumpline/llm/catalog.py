"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stumpline.llm import decontaminate, infill, langid, language_model, lines, packing, periodic, quality, sharding, simhash, spotsigs, toxicity, warc
from stumpline.llm.common import table

Build = Callable[[SparkSession, str], DataFrame]


def _documents(operator: Callable[[DataFrame], DataFrame]) -> Build:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Build] = {
    "op1_fingerprints": _documents(spotsigs.edited_likeness),
    "op2_simhash": _documents(simhash.near_duplicates),
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_line_dedup": _documents(lines.digest),
    "op6_sharding": _documents(sharding.assign),
    "op7_decontamination": op7_decontamination,
    "op8_packing": _documents(packing.pack),
    "op9_lm_scoring": _documents(language_model.scores),
    "op10_quality": op10_quality,
    "op11_infill": _documents(infill.digests),
    "op12_periodic": _documents(periodic.digests),
    "op13_langid": _documents(langid.scores),
}

SQL: dict[str, str] = {"op5_line_dedup": lines.SQL, "op6_sharding": sharding.SQL, "op11_infill": infill.SQL}
