"""Reference tables as DataFrames.

Rows go in as one Arrow table each, which Spark keeps as a local relation of known size. The size
lets the optimizer choose a broadcast join by itself; no join in this package carries a hint, so a
reference table that outgrows the broadcast threshold falls back to a shuffled join.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructType, TimestampType

from seawarden import fixed_values as fixed
from seawarden.sources import schemas

_ARROW = {
    StringType(): pa.string(),
    DoubleType(): pa.float64(),
    IntegerType(): pa.int32(),
    LongType(): pa.int64(),
    BooleanType(): pa.bool_(),
    TimestampType(): pa.timestamp("us", tz="UTC"),
}


def rows_to_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small list of rows as a DataFrame with an explicit schema."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema.fields]
    arrays = [pa.array(list(values), _ARROW[f.dataType]) for values, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema=schema)


def port_zones(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.PORT_ZONES, schemas.PORT_ZONES)


def geopolitical_risk_zones(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.GEOPOLITICAL_RISK_ZONES, schemas.GEOPOLITICAL_RISK_ZONES)


def maritime_obstacles(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.MARITIME_OBSTACLES, schemas.MARITIME_OBSTACLES)


def safe_corridors(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.SAFE_CORRIDORS, schemas.SAFE_CORRIDORS)


def port_alternatives(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.PORT_ALTERNATIVES, schemas.PORT_ALTERNATIVES)


def route_profile(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.ROUTE_PROFILE, schemas.ROUTE_PROFILE)


def fuel_cost(spark: SparkSession) -> DataFrame:
    return rows_to_table(spark, fixed.FUEL_COST, schemas.FUEL_COST)


def zone_aliases(spark: SparkSession) -> DataFrame:
    """Alias -> zone. The alias for all zones is expanded to one row per known zone."""
    every = [(fixed.ALL_ZONES_ALIAS, zone[0]) for zone in fixed.GEOPOLITICAL_RISK_ZONES]
    return rows_to_table(spark, fixed.ZONE_ALIASES + every, schemas.ZONE_ALIASES)


# Tables that are loaded as they are, by name.
PUBLISHED = {
    "port_zones": port_zones,
    "geopolitical_risk_zones": geopolitical_risk_zones,
    "maritime_obstacles": maritime_obstacles,
    "safe_corridors": safe_corridors,
    "port_alternatives": port_alternatives,
}
ROW_COUNTS = {
    "port_zones": len(fixed.PORT_ZONES),
    "geopolitical_risk_zones": len(fixed.GEOPOLITICAL_RISK_ZONES),
    "maritime_obstacles": len(fixed.MARITIME_OBSTACLES),
    "safe_corridors": len(fixed.SAFE_CORRIDORS),
    "port_alternatives": len(fixed.PORT_ALTERNATIVES),
}
