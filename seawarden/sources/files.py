"""Input files, read with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seawarden.sources import schemas


def read_positions(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Raw position reports."""
    return spark.read.format(fmt).schema(schemas.AIS_BRONZE).options(**options).load(path)


def read_observations(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    """Weather observations per port and time."""
    return spark.read.format(fmt).schema(schemas.WEATHER_OBSERVATIONS).options(**options).load(path)
