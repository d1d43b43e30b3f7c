"""Parquet table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read ``<base_dir>/<name>.parquet``; selecting columns here lets the scan prune them."""
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
