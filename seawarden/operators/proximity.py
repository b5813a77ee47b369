"""Where a vessel is in relation to the ports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seawarden.functions.geo import distance_km
from seawarden.operators import add, cells


#: Boxes that the list of one grid cell holds at most.
LISTED = 1000


def add_port_distance(
    df: DataFrame, ports: DataFrame, port: str = "PortZone", lat: str = "latest_lat", lon: str = "latest_lon"
) -> DataFrame:
    """Adds ``distance_to_port_km`` to the centre of the vessel's port; null for an unknown port."""
    centres = ports.selectExpr(f"port_zone AS {port}", "center_lat", "center_lon")
    distance = distance_km(lat, lon, "center_lat", "center_lon")
    return df.join(centres, port, "left").selectExpr(*df.columns, f"{distance} AS distance_to_port_km")


def assign_box(
    df: DataFrame,
    boxes: DataFrame,
    lat: str = "LAT",
    lon: str = "LON",
    into: str = "box_port",
    cell_degrees: float = 1.0,
) -> DataFrame:
    """Adds the port whose bounding box holds the position, null if none does.

    Where boxes overlap, the nearest centre wins, then the name. A box may be of any size and may cross the date line
    (``lon_min`` greater than ``lon_max``). Boxes are listed in the cells of a grid of several resolutions, four cells
    each at most, and a position looks up its own cell at each resolution in use: equi-joins instead of comparing
    every position with every box. Where no cell is touched by more than ``LISTED`` boxes, a cell carries the list of
    its boxes, so that a position stays one row and moves once. Denser boxes stay rows: distinct places are joined to
    the boxes of their cells, the nearest is taken by an aggregate that combines before its shuffle, and positions
    look their place up.
    """
    touching = cells.cover(boxes, cell_degrees)

    def holds(box: str) -> str:
        return f"{lat} BETWEEN {box}lat_min AND {box}lat_max AND {lon} BETWEEN {box}lon_min AND {box}lon_max"

    def distance(box: str) -> str:
        return f"struct({distance_km(lat, lon, box + 'center_lat', box + 'center_lon')} AS km, {box}port_zone AS name)"

    shape = touching.groupBy(*cells.CELL_KEYS).count().groupBy("_level").agg(F.expr("max(count) AS most")).collect()
    levels = sorted(row["_level"] for row in shape)
    if not levels:
        return add(df, **{into: "cast(NULL AS string)"})
    names = ["port_zone", "center_lat", "center_lon", "lat_min", "lat_max", "lon_min", "lon_max"]
    if max(row["most"] for row in shape) <= LISTED:
        found, near = df, []
        for level in levels:
            row, col = cells.cell(lat, lon, level, cell_degrees)
            listed = touching.where(f"_level = {level}").groupBy("_row", "_col")
            listed = listed.agg(F.expr(f"collect_list(struct({', '.join(names)})) AS _boxes_{level}"))
            found = add(found, _row=row, _col=col).join(listed, ["_row", "_col"], "left").drop("_row", "_col")
            near.append(f"array_min(transform(filter(_boxes_{level}, b -> {holds('b.')}), b -> {distance('b.')}))")
        nearest = near[0] if len(near) == 1 else f"array_min(array({', '.join(near)}))"
        return found.selectExpr(*df.columns, f"{nearest}.name AS {into}")

    places = cells.at_levels(df.select(lat, lon).distinct(), lat, lon, levels, cell_degrees)
    found = (
        places.join(touching.selectExpr(*cells.CELL_KEYS, *[f"{name} AS _b_{name}" for name in names]), list(cells.CELL_KEYS))
        .where(holds("_b_"))
        .groupBy(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        .agg(F.expr(f"min({distance('_b_')}).name AS {into}"))
    )
    same = (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon"))
    return df.join(found, same, "left").select(*df.columns, into)


def within_radius(
    df: DataFrame,
    circles: DataFrame,
    lat: str = "latest_lat",
    lon: str = "latest_lon",
    into: str = "distance_km",
    cell_degrees: float = 1.0,
) -> DataFrame:
    """Every pair of a position and a circle (center_lat, center_lon, radius_km, more) that holds it, and its distance.

    A circle is listed in the cells that its bounding box touches, at the resolution of its size, four at most; around
    a pole and across the date line too. Positions meet the circles of their own cells, and the great-circle distance
    decides. Positions without coordinates are in no circle.
    """
    boxed = add(circles, **cells.bounding_box("center_lat", "center_lon", "radius_km"))
    touching = cells.cover(boxed, cell_degrees).drop("lat_min", "lat_max", "lon_min", "lon_max")
    levels = sorted(row["_level"] for row in touching.select("_level").distinct().collect())
    at = cells.at_levels(df, lat, lon, levels or [0], cell_degrees)
    met = add(at.join(touching, list(cells.CELL_KEYS)), **{into: distance_km(lat, lon, "center_lat", "center_lon")})
    return met.where(f"{into} <= radius_km").drop(*cells.CELL_KEYS, "center_lat", "center_lon")
