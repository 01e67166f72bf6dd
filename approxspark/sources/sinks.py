"""Result sinks (A3, A4): CSV with a header and JSON lines, written by executors in parallel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read a written result back with its schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).json(path)
    return path


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)
