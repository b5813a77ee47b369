"""Per-vessel summary of clean positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from seawarden.functions.stats import exact_mean

VESSEL_KEYS = ("MMSI", "VesselName", "VesselTypeName", "PortZone")


def summarise(df: DataFrame, keys: Sequence[str] = VESSEL_KEYS, time: str = "BaseDateTime") -> DataFrame:
    """Speed statistics and the latest position per vessel.

    Times are unique per vessel after ``dedup``, so "latest" needs no tie-break and every
    aggregation buffer is a fixed-width number: Spark hash-aggregates on the map side, and a
    vessel with most of the rows sends one partial row per task.
    """
    return df.groupBy(*keys).agg(
        F.expr(f"{exact_mean('SOG')} AS avg_sog"),
        F.expr("min(SOG) AS min_sog"),
        F.expr("max(SOG) AS max_sog"),
        F.expr("count(SOG) AS record_count"),
        F.expr(f"max_by(LAT, {time}) AS latest_lat"),
        F.expr(f"max_by(LON, {time}) AS latest_lon"),
        F.expr(f"max_by(SOG, {time}) AS latest_sog"),
        F.expr(f"max({time}) AS latest_time"),
    )
