"""The registered queries: each takes (spark, folder of tables) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from seawarden import fixed_values as fixed
from seawarden.operators import add, audit, diversion, profile, prompts, proximity, refine, replace, reports
from seawarden.operators import risk, routing, trailing, weather
from seawarden.plans import pipeline
from seawarden.session import remove_folder, shared_folder
from seawarden.sources import event_feed, reference, schemas
from seawarden.sources.reference import rows_to_table
from seawarden.streaming import positions as live

Query = Callable[[SparkSession, str], DataFrame]

# Computed doubles are rounded for display, since engines differ in the last bits.
SHOWN = {"avg_sog": 4, "latest_lat": 6, "latest_lon": 6, "distance_to_port_km": 3}


def shown(df: DataFrame) -> DataFrame:
    return replace(df, {name: f"round({name}, {digits})" for name, digits in SHOWN.items() if name in df.columns})


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    return event_feed.positions(event_feed.events(spark, folder))


def _weather(spark: SparkSession, folder: str) -> DataFrame:
    return event_feed.weather(event_feed.events(spark, folder))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.silver(_bronze(spark, folder))


def _located(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.located(_silver(spark, folder), reference.port_zones(spark))


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.gold_plan(_bronze(spark, folder), _weather(spark, folder))


def _routing(spark: SparkSession, folder: str) -> DataFrame:
    return pipeline.routing_plan(_bronze(spark, folder), _weather(spark, folder))


# --- positions ---------------------------------------------------------------------------------


def refine_positions(spark, folder):
    return _silver(spark, folder)


def parse_and_reject(spark, folder):
    faulty = event_feed.faulty_positions(event_feed.events(spark, folder))
    tagged = add(refine.tag_rejects(faulty), parsed_time=refine.parsed_time())
    return tagged.select("report_id", "MMSI", "BaseDateTime", "parsed_time", "reject_reason")


def vessel_profile(spark, folder):
    return shown(profile.summarise(_silver(spark, folder)))


def fine_speed_profile(spark, folder):
    """Means of speeds with four digits."""
    silver = pipeline.silver(event_feed.fine_positions(event_feed.events(spark, folder)))
    summary = profile.summarise(silver, keys=["MMSI"])
    return replace(summary, {"avg_sog": "round(avg_sog, 6)"}).select("MMSI", "avg_sog", "min_sog", "max_sog", "record_count")


def port_distance(spark, folder):
    return shown(_located(spark, folder)).select("MMSI", "PortZone", "latest_lat", "latest_lon", "distance_to_port_km")


def port_by_box(spark, folder):
    boxed = proximity.assign_box(_silver(spark, folder), reference.port_zones(spark))
    return boxed.select("MMSI", "BaseDateTime", "LAT", "LON", "PortZone", "box_port")


def port_by_wide_box(spark, folder):
    """Positions in watch areas of very different size around the ports, some of them across the date line."""
    reach = "inline(array(struct('near' AS area, 0.1D AS reach), struct('coast' AS area, 3D AS reach), struct('sea' AS area, 70D AS reach)))"
    areas = reference.port_zones(spark).selectExpr("port_zone AS port", "center_lat", "center_lon", reach)
    areas = areas.selectExpr(
        "concat(port, ' ', area) AS port_zone",
        "center_lat",
        "center_lon",
        "center_lat - reach / 4 AS lat_min",
        "center_lat + reach / 4 AS lat_max",
        "if(center_lon - reach < -180, center_lon - reach + 360, center_lon - reach) AS lon_min",
        "center_lon + reach AS lon_max",
    )
    boxed = proximity.assign_box(_silver(spark, folder), areas, into="watch_area")
    return boxed.select("MMSI", "BaseDateTime", "LAT", "LON", "watch_area")


def vessels_near_obstacles(spark, folder):
    """Vessels whose latest position lies within an obstacle's radius."""
    centres = reference.port_zones(spark).select("port_zone", "center_lat", "center_lon")
    obstacles = reference.maritime_obstacles(spark).join(centres, "port_zone").selectExpr(
        "obstacle_name", "obstacle_type", "severity", "cast(radius_km AS double) AS radius_km", "center_lat", "center_lon"
    )
    vessels = profile.summarise(_silver(spark, folder)).select("MMSI", "VesselName", "latest_lat", "latest_lon")
    near = proximity.within_radius(vessels, obstacles)
    return replace(near, {"distance_km": "round(distance_km, 3)"}).select(
        "MMSI", "VesselName", "obstacle_name", "obstacle_type", "severity", "radius_km", "distance_km"
    )


def speed_drop_events(spark, folder):
    return trailing.speed_drop_counts(_silver(spark, folder))


def slowdown_episodes(spark, folder):
    return trailing.slowdown_episodes(_silver(spark, folder))


# --- weather -----------------------------------------------------------------------------------


def weather_asof(spark, folder):
    found = pipeline.weathered(_located(spark, folder), _weather(spark, folder))
    return found.select("MMSI", "PortZone", "latest_time", "obs_time", *weather.WEATHER_COLUMNS, "weather_imputed")


def weather_by_cell(spark, folder):
    """Weather where the vessel is, by two-degree cell, instead of by port name."""
    cell = "concat(cast(floor({lat} / 2) AS string), ' ', cast(floor({lon} / 2) AS string))"
    centres = reference.port_zones(spark).select("port_zone", "center_lat", "center_lon")
    observed = add(_weather(spark, folder).join(centres, "port_zone"), cell=cell.format(lat="center_lat", lon="center_lon"))
    vessels = add(_located(spark, folder), cell=cell.format(lat="latest_lat", lon="latest_lon"))
    found = weather.as_of(vessels, observed, by="cell", on="latest_time", obs_by="cell")
    return weather.fill_defaults(found).select(
        "MMSI", "latest_time", "obs_time", "wind_speed_kmh", "wave_height_m", "weather_imputed"
    )


def weather_json(spark, folder):
    parsed = weather.parse(event_feed.payloads(event_feed.events(spark, folder)))
    return weather.fill_defaults(parsed).select("event_id", *weather.WEATHER_COLUMNS, "weather_imputed")


# --- risk --------------------------------------------------------------------------------------


def weather_scores(spark, folder):
    found = pipeline.weathered(_located(spark, folder), _weather(spark, folder))
    return risk.add_weather_scores(found).select(
        "MMSI", "wind_speed_kmh", "wave_height_m", "visibility_m", "weather_severity_score", "weather_severity"
    )


def slowdown_scores(spark, folder):
    scored = risk.add_slowdown_scores(profile.summarise(_silver(spark, folder)))
    return shown(scored).select("MMSI", "latest_sog", "avg_sog", "record_count", "slowdown_events", "slowdown_score")


def proximity_scores(spark, folder):
    scored = risk.add_proximity_scores(_located(spark, folder))
    return shown(scored).select("MMSI", "PortZone", "distance_to_port_km", "port_proximity_score")


def vessel_risk(spark, folder):
    return shown(_gold(spark, folder))


# --- routing -----------------------------------------------------------------------------------


def route_profile(spark, folder):
    vessels = _silver(spark, folder).selectExpr("MMSI", "VesselTypeName", "PortZone AS port_zone").distinct()
    return routing.add_profile(
        vessels, reference.route_profile(spark), reference.maritime_obstacles(spark), reference.fuel_cost(spark)
    )


def routing_costs(spark, folder):
    return _routing(spark, folder).select(
        "MMSI",
        "risk_level",
        "delay_risk_score",
        "safety_score",
        "estimated_delay_hours",
        "fuel_cost_per_hour_usd",
        "delay_cost_usd",
        "rerouting_distance_nm",
        "rerouting_cost_usd",
        "net_savings_usd",
    )


def routing_decision(spark, folder):
    return _routing(spark, folder).select(
        "MMSI",
        "port_zone",
        "risk_level",
        "rerouting_recommended",
        "routing_priority",
        "transit_zones",
        "rerouting_recommendation",
    )


def vessel_routing(spark, folder):
    return shown(_routing(spark, folder))


# --- diversion ---------------------------------------------------------------------------------


def route_options(spark, folder):
    vessels = _gold(spark, folder).select("MMSI", "VesselName", "port_zone", "risk_level")
    return diversion.options(vessels, reference.port_alternatives(spark))


def corridor_match(spark, folder):
    vessels = _routing(spark, folder).select("MMSI", "VesselName", "route_type", "transit_zones", "risk_level")
    return diversion.corridors(
        vessels, reference.route_profile(spark), reference.safe_corridors(spark), reference.zone_aliases(spark)
    )


def uncovered_vessels(spark, folder):
    vessels = _routing(spark, folder).select("MMSI", "VesselName", "port_zone", "route_type", "transit_zones")
    return diversion.uncovered(
        vessels, reference.route_profile(spark), reference.safe_corridors(spark), reference.zone_aliases(spark)
    )


def zones_by_route(spark, folder):
    exposed = diversion.zone_exposure(_routing(spark, folder), reference.geopolitical_risk_zones(spark))
    return exposed.select("route_type", "zone_name", "zone_type", "risk_level", "risk_score", "vessels")


def critical_zones(spark, folder):
    return diversion.critical_exposure(_routing(spark, folder), reference.geopolitical_risk_zones(spark))


# --- reports -----------------------------------------------------------------------------------


def kpis(spark, folder):
    return reports.kpis(_routing(spark, folder))


def risk_distribution(spark, folder):
    return reports.distribution(_gold(spark, folder), ["risk_level"], fixed.RISK_LEVELS)


def level_by_priority(spark, folder):
    return reports.distribution(_routing(spark, folder), ["risk_level", "routing_priority"])


def priority_distribution(spark, folder):
    return reports.distribution(_routing(spark, folder), ["routing_priority"])


def weather_distribution(spark, folder):
    return reports.distribution(_gold(spark, folder), ["weather_severity"], fixed.WEATHER_LABELS)


def port_summary(spark, folder):
    return reports.port_summary(_routing(spark, folder))


def port_level_pivot(spark, folder):
    return reports.port_level_pivot(_gold(spark, folder))


def high_risk_vessels(spark, folder):
    return reports.high_risk_vessels(_routing(spark, folder))


def reroute_list(spark, folder):
    return reports.reroute_list(_routing(spark, folder))


def top_risk_vessels(spark, folder):
    top = reports.ranked(_gold(spark, folder), "delay_risk_score", ["MMSI"], n=20)
    return top.select("MMSI", "VesselName", "port_zone", "delay_risk_score", "risk_level")


def risk_pairs(spark, folder):
    return reports.risk_pairs(_routing(spark, folder))


# --- audit, prompts ----------------------------------------------------------------------------


@contextmanager
def _published(spark: SparkSession, folder: str, **options):
    """All tables in a database of their own, which goes when its caller is done with it."""
    location = shared_folder(spark, "fleet")
    database = "fleet_" + location[-32:]
    bronze = _bronze(spark, folder)
    report = pipeline.publish(spark, bronze, _weather(spark, folder), database, location, **options)
    try:
        yield database, report
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
        remove_folder(spark, location)


def table_audit(spark, folder):
    """Row counts of stored tables, rejects among them, each with what to expect."""
    reports = _bronze(spark, folder).count()
    usable = refine.usable(_bronze(spark, folder)).select(*refine.POSITION_KEY).distinct()
    layers = {"ais_bronze": reports, "ais_silver": usable.count()}
    with _published(spark, folder, keep_rejects=True, expected=layers) as (database, _):
        expected = {**dict.fromkeys(schemas.TABLES), **reference.ROW_COUNTS, **layers, "ais_rejected": None}
        report = audit.saved_tables(spark, expected, database)
        return rows_to_table(spark, [tuple(row) for row in report.collect()], report.schema)


def column_checks(spark, folder):
    faulty = event_feed.faulty_positions(event_feed.events(spark, folder))
    raw = audit.columns(
        faulty,
        key=refine.POSITION_KEY,
        required=["BaseDateTime", "SOG"],
        ranges={"LAT": fixed.LAT_RANGE, "LON": fixed.LON_RANGE, "SOG": (0, 102.2)},
    )
    scores = ["slowdown_score", "weather_severity_score", "port_proximity_score", "delay_risk_score", "risk_level"]
    scored = audit.columns(
        _gold(spark, folder), key=["MMSI"], required=scores, ranges={"weather_severity_score": (15, 100)}
    )
    return add(raw, table_name="'ais_bronze'").unionByName(add(scored, table_name="'vessel_disruption_risk'"))


def render_prompts(spark, folder):
    variables = spark.read.parquet(f"{folder}/documents.parquet").selectExpr(
        "doc_id", "text AS topic", "concat('readers of ', source, ' in ', lang) AS audience"
    )
    return prompts.render(variables).selectExpr(
        "doc_id", "messages[0].content AS system_text", "messages[1].content AS human_text", "error"
    )


# --- streams -----------------------------------------------------------------------------------


def _live(spark: SparkSession, folder: str) -> DataFrame:
    return live.clean(event_feed.positions(event_feed.event_stream(spark, folder)))


def stream_hourly_speed(spark, folder):
    work = shared_folder(spark, "hourly-speed")
    hourly = live.hourly_speed(_live(spark, folder))
    live.keep_newest(hourly, ["PortZone", "hour_start"], f"{work}/state", f"{work}/progress").awaitTermination()
    return live.stored_state(spark, f"{work}/state")


def stream_latest(spark, folder):
    work = shared_folder(spark, "latest")
    live.latest(_live(spark, folder), f"{work}/state", f"{work}/progress").awaitTermination()
    return live.stored_state(spark, f"{work}/state")


def stream_dedup(spark, folder):
    work = shared_folder(spark, "dedup")
    live.write_changes(live.dedup(_live(spark, folder)), f"{work}/rows", f"{work}/progress", mode="append").awaitTermination()
    kept = spark.read.parquet(f"{work}/rows")
    # Which of several reports comes first is up to the stream; it must be one of them, unchanged.
    reported = refine.add_labels(refine.usable(_bronze(spark, folder)))
    same = " AND ".join(f"r.{name} <=> k.{name}" for name in reported.columns if name not in refine.POSITION_KEY)
    return (
        kept.alias("k")
        .join(reported.alias("r"), list(refine.POSITION_KEY))
        .groupBy(*refine.POSITION_KEY)
        .agg(
            F.expr("count(DISTINCT r.LAT, r.LON, r.SOG) AS candidates"),
            F.expr(f"bool_or({same}) AND count(DISTINCT k.LAT, k.LON, k.SOG) = 1 AS kept_as_reported"),
        )
    )


# --- tables ------------------------------------------------------------------------------------


#: Columns whose values are added up to compare stored contents.
CONTENT = {
    "ais_bronze": ["MMSI", "VesselType", "Status", "VesselName", "PortZone"],
    "ais_silver": ["MMSI", "VesselTypeName", "NavStatus", "VesselName", "PortZone"],
    "vessel_disruption_risk": ["MMSI", "port_zone", "weather_severity", "risk_level", "recommended_action"],
    "vessel_routing_intelligence": ["MMSI", "route_type", "routing_priority", "rerouting_recommendation"],
    "port_zones": ["port_zone"],
    "geopolitical_risk_zones": ["zone_name", "zone_type", "risk_level", "risk_score", "affected_routes"],
    "maritime_obstacles": ["obstacle_name", "obstacle_type", "port_zone", "radius_km", "obstacle_risk_score"],
    "safe_corridors": ["corridor_name", "route_alternative", "avoids_zones", "additional_nm", "status"],
    "port_alternatives": ["current_port", "alternative_port", "distance_nm", "safety_rating", "status"],
}


def publish_tables(spark, folder):
    """All nine tables written and read back: their audit and a sum over their contents."""
    with _published(spark, folder) as (database, report):
        contents = {
            name: spark.table(f"{database}.{name}").agg(F.expr(audit.content(columns))).first()[0]
            for name, columns in CONTENT.items()
        }
        lines = [(*row, contents[row["table_name"]]) for row in report.collect()]
        return rows_to_table(spark, lines, report.schema.add("content", "long"))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        refine_positions,
        parse_and_reject,
        vessel_profile,
        fine_speed_profile,
        port_distance,
        port_by_box,
        port_by_wide_box,
        vessels_near_obstacles,
        speed_drop_events,
        slowdown_episodes,
        weather_asof,
        weather_by_cell,
        weather_json,
        weather_scores,
        slowdown_scores,
        proximity_scores,
        vessel_risk,
        route_profile,
        routing_costs,
        routing_decision,
        vessel_routing,
        route_options,
        corridor_match,
        uncovered_vessels,
        zones_by_route,
        critical_zones,
        kpis,
        risk_distribution,
        level_by_priority,
        priority_distribution,
        weather_distribution,
        port_summary,
        port_level_pivot,
        high_risk_vessels,
        reroute_list,
        top_risk_vessels,
        risk_pairs,
        table_audit,
        column_checks,
        render_prompts,
        stream_hourly_speed,
        stream_latest,
        stream_dedup,
        publish_tables,
    )
}
