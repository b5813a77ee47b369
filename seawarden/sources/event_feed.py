"""Position reports, weather observations and payloads derived from an event table.

The event table has ``event_id, ts, user_id, event_type, value, props``. Each event becomes one
position report of the vessel ``user_id``, by whole-number rules that any SQL engine repeats
exactly. Truncating times to the hour makes real duplicates; every 97th report lies outside the
monitored area. Vessels of slot 6 belong to no known port; slot 5 has no weather at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seawarden import fixed_values as fixed
from seawarden.functions.text import quote
from seawarden.sources import schemas

OFFSHORE = "Offshore"
SLOTS = len(fixed.PORT_ZONES) + 1
WEATHER_SLOTS = (0, 1, 2, 3, 4, 6)
PORT_NAMES = [zone[0] for zone in fixed.PORT_ZONES] + [OFFSHORE]
CENTER_LATS = [zone[1] for zone in fixed.PORT_ZONES] + [36.0]
CENTER_LONS = [zone[2] for zone in fixed.PORT_ZONES] + [-70.0]
STATUS_CODES = (0, 1, 5, 7, 99)


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The event table as a stream of files. The pattern fits a single file and a folder of files."""
    schema = events(spark, folder).schema
    return spark.readStream.schema(schema).parquet(f"{folder}/events.parque[t]")


def _pick(values, index: str) -> str:
    """The index-th of a few fixed values, counted from 0."""
    return f"element_at(array({', '.join(map(_literal, values))}), cast({index} + 1 AS int))"


def _literal(value) -> str:
    return quote(value) if isinstance(value, str) else f"{value}D" if isinstance(value, float) else str(value)


_SLOT = f"user_id % {SLOTS}"
_HOUR = "date_trunc('hour', cast(ts AS timestamp))"
_LAT = f"{_pick(CENTER_LATS, _SLOT)} + (event_id * 37 % 101 - 50) * 0.005D"
_LON = f"{_pick(CENTER_LONS, _SLOT)} + (event_id * 53 % 103 - 51) * 0.005D"

_REPORT = {
    "MMSI": "user_id + 200000000L",
    "BaseDateTime": "concat(cast(to_date(ts) AS string), 'T', lpad(hour(ts), 2, '0'), ':00:00')",
    "LAT": f"if(event_id % 97 = 0, 61D, {_LAT})",
    "LON": _LON,
    "SOG": "round(value * 0.2D, 2)",
    "COG": "event_id * 29 % 3600 / 10",
    "VesselType": _pick(fixed.VESSEL_TYPE_CODES, "(user_id * 5 + 3) % 6"),
    "Status": _pick(STATUS_CODES, "event_id % 5"),
    "VesselName": "concat('VESSEL ', lpad(user_id, greatest(4, length(user_id)), '0'))",
    "PortZone": _pick(PORT_NAMES, _SLOT),
}


def _reports(events: DataFrame, extra: dict[str, str], changed: dict[str, str]) -> DataFrame:
    columns = {**extra, **_REPORT, **changed}
    return events.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def positions(events: DataFrame) -> DataFrame:
    """Bronze position reports, with time as ISO text. Works on a table and on a stream."""
    return schemas.conform(_reports(events, {}, {}), schemas.AIS_BRONZE)


def fine_positions(events: DataFrame) -> DataFrame:
    """The same reports with speeds of four digits."""
    speed = "round(value * 0.2D, 2) + event_id % 100 / 10000D"
    return schemas.conform(_reports(events, {}, {"SOG": speed}), schemas.AIS_BRONZE)


def faulty_positions(events: DataFrame) -> DataFrame:
    """The same reports, some with a damaged time, position or speed, and their ``report_id``."""
    changed = {
        "BaseDateTime": "CASE WHEN event_id % 89 = 0 THEN 'not-a-time' WHEN event_id % 83 = 0 THEN NULL"
        f" WHEN event_id % 79 = 0 THEN '2024-13-01T00:00:00' WHEN event_id % 61 = 0 THEN '12:30:00'"
        f" WHEN event_id % 59 = 0 THEN '2024-01' WHEN event_id % 53 = 0 THEN 'T12:30:00'"
        f" ELSE {_REPORT['BaseDateTime']} END",
        "LON": f"if(event_id % 73 = 0, -131D, {_LON})",
        "SOG": "CASE WHEN event_id % 71 = 0 THEN -1D WHEN event_id % 67 = 0 THEN NULL"
        " WHEN event_id % 47 = 0 THEN double('NaN') WHEN event_id % 43 = 0 THEN double('Infinity')"
        " ELSE round(value * 0.2D, 2) END",
    }
    return _reports(events, {"report_id": "event_id"}, changed)


def weather(events: DataFrame) -> DataFrame:
    """Hourly observations per port, at the hours that hold an event of type view.

    Every third hour has all seven numbers, the others wind, waves and visibility only.
    """
    hours = events.where("event_type = 'view'").selectExpr(f"{_HOUR} AS obs_time").distinct()
    slots = f"explode(array({', '.join(map(str, WEATHER_SLOTS))})) AS slot"
    observed = hours.selectExpr("obs_time", "dayofmonth(obs_time) * 24 + hour(obs_time) AS h", slots).selectExpr(
        f"{_pick(PORT_NAMES, 'slot')} AS port_zone",
        "obs_time",
        "cast(5 + (h * 7 + slot * 11) % 60 AS double) AS wind_speed_kmh",
        "if(h % 3 = 0, cast(10 + (h * 5 + slot * 3) % 80 AS double), NULL) AS wind_gusts_kmh",
        "if(h % 3 = 0, cast((h * 7 + slot) % 45 - 10 AS double), NULL) AS temperature_c",
        "if(h % 3 = 0, (h + slot) % 20 / 10, NULL) AS precipitation_mm",
        "cast(500 + (h * 131 + slot * 17) % 9500 AS double) AS visibility_m",
        "if(h % 3 = 0, cast((h * 11 + slot * 13) % 101 AS double), NULL) AS cloud_cover_pct",
        "(10 + (h * 13 + slot * 7) % 40) / 10 AS wave_height_m",
    )
    return schemas.conform(observed, schemas.WEATHER_OBSERVATIONS)


def payloads(events: DataFrame) -> DataFrame:
    """Raw service payloads built from ``props``: some lack fields, some are cut off, some are absent."""
    forecast = """concat('{"current": ', replace(props, '"k"', '"wind_speed_10m"'), '}')"""
    marine = """concat('{"current": {"wave_height": ', cast(event_id % 50 / 10 AS string), '}}')"""
    partial = """'{"current": {"visibility": 1200, "cloud_cover": 80.5}}'"""
    return events.selectExpr(
        "event_id",
        f"CASE WHEN event_id % 11 = 0 THEN '{{' WHEN event_id % 7 = 0 THEN {partial} ELSE {forecast} END AS forecast_json",
        f"if(event_id % 13 = 0, NULL, {marine}) AS marine_json",
    )
