"""Where a vessel could go instead: other ports, safe corridors, and the zones on its route.

What a vessel can choose from depends on its port or route only. So the choices are worked out on
the reference tables first, and vessels join the outcome on one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seawarden.functions.bands import label_rank
from seawarden.functions.text import split_list
from seawarden.sources.reference import rows_to_table

#: Rows of a derived reference table that are read while a plan is built, at most.
SMALL = 1000


def options(df: DataFrame, alternatives: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` best open diversion ports of each vessel: safest first, then nearest, then by name.

    The order is the same for all vessels of a port, so ranking ports ranks them for every vessel,
    without a shuffle of vessels.
    """
    safest = label_rank("safety_rating", ["High", "Medium"])
    best = (
        alternatives.where("status = 'Open'")
        .selectExpr(
            "current_port AS port_zone",
            "alternative_port",
            "distance_nm",
            "transit_hours",
            "berth_capacity",
            "safety_rating",
            f"row_number() OVER (PARTITION BY current_port ORDER BY {safest}, distance_nm, alternative_port)"
            " AS option_rank",
        )
        .where(f"option_rank <= {k}")
    )
    return df.join(best, "port_zone")


def _zones(df: DataFrame, listed_in: str, aliases: DataFrame) -> DataFrame:
    """One row per listed zone, under its name in the zone table."""
    return (
        df.selectExpr("*", f"explode({split_list(listed_in)}) AS alias")
        .join(aliases, "alias", "left")
        .selectExpr(*df.columns, "coalesce(zone_name, alias) AS zone")
    )


def coverage(routes: DataFrame, corridors: DataFrame, aliases: DataFrame) -> DataFrame:
    """Corridors that avoid a zone of a route, per list of transit zones, with the number avoided."""
    facts = ["corridor_name", "route_alternative", "additional_nm", "additional_hours", "safety_rating", "status"]
    zones = _zones(routes.select("transit_zones").distinct(), "transit_zones", aliases)
    avoided = _zones(corridors.select(*facts, "avoids_zones"), "avoids_zones", aliases)
    return (
        zones.join(avoided, "zone")
        .groupBy("transit_zones", *facts)
        .agg(F.expr("count(DISTINCT zone) AS zones_avoided"))
    )


def _counted(df: DataFrame) -> DataFrame:
    """A small table as rows of known size, so that the optimizer does not overestimate it.

    Estimates multiply with every explode and join. Up to ``SMALL`` rows are read here; a larger table stays a
    plan, and the optimizer chooses by its estimate.
    """
    rows = df.limit(SMALL + 1).collect()
    return rows_to_table(df.sparkSession, [tuple(row) for row in rows], df.schema) if len(rows) <= SMALL else df


def corridors(df: DataFrame, routes: DataFrame, corridor_table: DataFrame, aliases: DataFrame) -> DataFrame:
    """Each vessel with the corridors that avoid a zone it transits."""
    return df.join(_counted(coverage(routes, corridor_table, aliases)), "transit_zones")


def uncovered(df: DataFrame, routes: DataFrame, corridor_table: DataFrame, aliases: DataFrame) -> DataFrame:
    """Vessels for which no open corridor avoids any zone of their route."""
    covered = coverage(routes, corridor_table.where("status = 'Open'"), aliases)
    return df.join(_counted(covered.select("transit_zones").distinct()), "transit_zones", "left_anti")


def zones_by_route(zones: DataFrame) -> DataFrame:
    """One row per zone and route that the zone affects."""
    return zones.selectExpr("*", f"explode({split_list('affected_routes')}) AS route_type")


def zone_exposure(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Zones per route with the number of vessels on that route, 0 if none."""
    vessels = df.groupBy("route_type").agg(F.expr("count(1) AS vessels"))
    routes = zones_by_route(zones)
    return routes.join(vessels, "route_type", "left").selectExpr(*routes.columns, "coalesce(vessels, 0L) AS vessels")


def critical_exposure(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Critical zones, the highest score first, with the vessels on the routes they affect."""
    facts = ["zone_name", "risk_level", "risk_score", "description", "affected_routes"]
    return (
        zone_exposure(df, zones.where("risk_level = 'Critical'"))
        .groupBy(*facts)
        .agg(F.expr("sum(vessels) AS vessels_exposed"))
        .orderBy(F.desc("risk_score"), "zone_name")
    )
