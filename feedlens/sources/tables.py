"""Readers for the parquet tables the jobs run on."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(table_path(sf_dir, name))


# Tables whose rows carry CPU-heavy text or JSON work (tokenising, HMAC, parsing).
TEXT_TABLES = ("documents", "events", "conversations", "pages", "benchmark")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan that has fewer partitions than the session has cores.

    A small file with one row group is read by one task; per-row text work on
    it would then use one core.  Large inputs already have at least one split
    per core and are returned unchanged (no extra shuffle)."""
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < parallelism:
        return df.repartition(parallelism)
    return df


class Tables:
    """Memoised scans of one data directory (one scan object per table)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        if name not in self._cache:
            df = read_table(self.spark, self.sf_dir, name)
            self._cache[name] = spread(df) if name in TEXT_TABLES else df
        return self._cache[name]
