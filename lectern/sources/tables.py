"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Table ``name`` of ``directory``; filters and column choices reach the scan."""
    return spark.read.parquet(f"{directory}/{name}.parquet")
