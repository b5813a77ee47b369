"""One explicit schema per table, checked whenever a table is built or read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TYPES: dict[str, DataType] = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "timestamp": TimestampType(),
    "boolean": BooleanType(),
}


def _schema(columns: str, comments: dict[str, str] | None = None) -> StructType:
    fields = []
    for column in columns.split(","):
        name, kind = column.split()
        comment = (comments or {}).get(name)
        fields.append(StructField(name, _TYPES[kind], True, {"comment": comment} if comment else None))
    return StructType(fields)


# Column names and types are fixed values shared with existing queries on these tables.
AIS_BRONZE = _schema(
    "MMSI bigint, BaseDateTime string, LAT double, LON double, SOG double, COG double, "
    "VesselType int, Status int, VesselName string, PortZone string",
    {
        "MMSI": "Maritime Mobile Service Identity",
        "BaseDateTime": "Timestamp of AIS position",
        "LAT": "Latitude",
        "LON": "Longitude",
        "SOG": "Speed Over Ground (knots)",
        "COG": "Course Over Ground (degrees)",
        "VesselType": "Vessel type code",
        "Status": "Navigation status code",
        "VesselName": "Vessel name",
        "PortZone": "Port zone name",
    },
)
AIS_SILVER = _schema(
    "MMSI bigint, BaseDateTime timestamp, LAT double, LON double, SOG double, COG double, VesselType int, "
    "VesselTypeName string, Status int, NavStatus string, VesselName string, PortZone string"
)
PORT_ZONES = _schema(
    "port_zone string, center_lat double, center_lon double, lat_min double, lat_max double, "
    "lon_min double, lon_max double, description string"
)
WEATHER_OBSERVATIONS = _schema(
    "port_zone string, obs_time timestamp, wind_speed_kmh double, wind_gusts_kmh double, temperature_c double, "
    "precipitation_mm double, visibility_m double, cloud_cover_pct double, wave_height_m double"
)
VESSEL_DISRUPTION_RISK = _schema(
    "MMSI bigint, VesselName string, VesselTypeName string, latest_lat double, latest_lon double, "
    "latest_sog double, avg_sog double, min_sog double, max_sog double, slowdown_events double, "
    "port_zone string, distance_to_port_km double, wind_speed_kmh double, wind_gusts_kmh double, "
    "temperature_c double, precipitation_mm double, visibility_m double, wave_height_m double, "
    "cloud_cover_pct double, slowdown_score double, weather_severity_score double, weather_severity string, "
    "port_proximity_score double, delay_risk_score double, risk_level string, recommended_action string, "
    "disruption_summary string",
    {"risk_level": "Critical | High | Medium | Low"},
)
GEOPOLITICAL_RISK_ZONES = _schema(
    "zone_name string, zone_type string, risk_level string, risk_score int, description string, "
    "affected_routes string"
)
MARITIME_OBSTACLES = _schema(
    "obstacle_name string, obstacle_type string, port_zone string, radius_km int, severity string, "
    "obstacle_risk_score int, description string"
)
SAFE_CORRIDORS = _schema(
    "corridor_name string, route_alternative string, avoids_zones string, additional_nm int, "
    "additional_hours int, safety_rating string, status string, description string"
)
PORT_ALTERNATIVES = _schema(
    "current_port string, alternative_port string, distance_nm int, transit_hours double, "
    "berth_capacity string, safety_rating string, status string, description string"
)
ROUTE_PROFILE = _schema("port_zone string, route_type string, geopolitical_risk_score int, transit_zones string")
FUEL_COST = _schema("vessel_type string, fuel_cost_per_hour_usd int")
ZONE_ALIASES = _schema("alias string, zone_name string")
VESSEL_ROUTING_INTELLIGENCE = _schema(
    "MMSI bigint, VesselName string, VesselTypeName string, latest_lat double, latest_lon double, "
    "latest_sog double, avg_sog double, slowdown_events double, port_zone string, distance_to_port_km double, "
    "wind_speed_kmh double, wind_gusts_kmh double, temperature_c double, precipitation_mm double, "
    "visibility_m double, wave_height_m double, cloud_cover_pct double, slowdown_score double, "
    "weather_severity_score double, weather_severity string, port_proximity_score double, "
    "delay_risk_score double, risk_level string, recommended_action string, disruption_summary string, "
    "route_type string, geopolitical_risk_score int, obstacle_risk_score int, safety_score double, "
    "estimated_delay_hours double, fuel_cost_per_hour_usd int, delay_cost_usd double, "
    "rerouting_distance_nm double, rerouting_cost_usd double, net_savings_usd double, "
    "rerouting_recommended boolean, routing_priority string, transit_zones string, "
    "rerouting_recommendation string",
    {
        "route_type": "Trans-Pacific | Trans-Atlantic | Gulf Route | Coastal | Domestic",
        "safety_score": "100 = safest",
        "routing_priority": "Safety Critical | Balanced | Cost Optimized | Monitor",
    },
)

TABLES: dict[str, StructType] = {
    "ais_bronze": AIS_BRONZE,
    "ais_silver": AIS_SILVER,
    "port_zones": PORT_ZONES,
    "vessel_disruption_risk": VESSEL_DISRUPTION_RISK,
    "geopolitical_risk_zones": GEOPOLITICAL_RISK_ZONES,
    "maritime_obstacles": MARITIME_OBSTACLES,
    "safe_corridors": SAFE_CORRIDORS,
    "port_alternatives": PORT_ALTERNATIVES,
    "vessel_routing_intelligence": VESSEL_ROUTING_INTELLIGENCE,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``, in its order, types and comments.

    A column that is absent is an error, not skipped. Casts follow Spark's store assignment: they
    widen (int to bigint, decimal to double) and fail on a value that does not fit.
    """
    absent = [name for name in schema.names if name not in df.columns]
    if absent:
        raise ValueError("columns missing: " + ", ".join(absent))
    return df.to(schema)


def check(df: DataFrame, schema: StructType) -> DataFrame:
    """``df`` unchanged, or an error that lists the columns whose name or type differs."""
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: expected {f.dataType.simpleString()}, got "
        f"{have[f.name].simpleString() if f.name in have else 'nothing'}"
        for f in schema.fields
        if have.get(f.name) != f.dataType
    ]
    if wrong:
        raise ValueError("schema mismatch: " + "; ".join(wrong))
    return df
