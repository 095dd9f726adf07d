"""Scans of the driver's Parquet test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters push into the reader."""
    return spark.read.parquet(table_path(sf_dir, name))
