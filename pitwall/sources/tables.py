"""Readers for the landed Parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from pitwall.session import ship_package

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; Catalyst pushes filters and prunes columns into it."""
    ship_package(spark)
    return spark.read.parquet(table_path(sf_dir, name))
