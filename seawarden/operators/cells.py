"""Areas on a grid of several resolutions, so that a position finds the areas around it by an equi-join.

A level's cells are twice as large as those of the level below. An area is listed at the level whose cells are at
least as large as itself, where it touches four cells at most, whatever its size. A position looks its own cell up at
each level in use, of which there are as many as sizes of areas differ by factors of two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from seawarden.fixed_values import EARTH_RADIUS_KM
from seawarden.functions.geo import grid_cell
from seawarden.operators import add

CELL_KEYS = ("_level", "_row", "_col")


def cover(boxes: DataFrame, cell_degrees: float) -> DataFrame:
    """Boxes (lat_min, lat_max, lon_min, lon_max) once for each cell they touch: adds ``_level``, ``_row``, ``_col``.

    A box whose ``lon_min`` is greater than its ``lon_max`` crosses the date line and becomes the two boxes on either
    side of it. A box without an inside, or with a null or NaN bound, is not listed.
    """
    west, east = "struct(lon_min AS a, 180D AS b)", "struct(-180D AS a, lon_max AS b)"
    whole = "struct(lon_min AS a, lon_max AS b)"
    real = " AND ".join(f"abs({name}) < double('Infinity')" for name in ("lat_min", "lat_max", "lon_min", "lon_max"))
    parts = add(
        boxes.where(f"lat_min <= lat_max AND {real}"),
        _part=f"explode(if(lon_min <= lon_max, array({whole}), array({west}, {east})))",
    )
    extent = f"greatest(lat_max - lat_min, _part.b - _part.a) / {float(cell_degrees)}D"
    sized = add(parts, _level=f"cast(ceil(log2(greatest({extent}, 1D))) AS int)")
    size = f"{float(cell_degrees)}D * shiftleft(1L, _level)"

    def touched(low: str, high: str) -> str:
        return f"explode(sequence(floor({low} / ({size})), floor({high} / ({size}))))"

    rows = add(sized, _row=touched("lat_min", "lat_max"))
    cells = add(rows, _col=touched("_part.a", "_part.b"))
    kept = [f"_part.{'a' if name == 'lon_min' else 'b'} AS {name}" if name in ("lon_min", "lon_max") else name for name in boxes.columns]
    return cells.selectExpr(*kept, *CELL_KEYS)


def cell(lat: str, lon: str, level: int, cell_degrees: float) -> tuple[str, str]:
    """Row and column of a position at a level."""
    size = cell_degrees * 2**level
    return grid_cell(lat, size), grid_cell(lon, size)


def at_levels(df: DataFrame, lat: str, lon: str, levels: Sequence[int], cell_degrees: float) -> DataFrame:
    """Positions once for each level in use, with their cell."""
    cells = []
    for level in levels:
        row, col = cell(lat, lon, level, cell_degrees)
        cells.append(f"struct({level} AS _level, {row} AS _row, {col} AS _col)")
    return df.selectExpr("*", f"inline(array({', '.join(cells)}))")


def bounding_box(lat: str, lon: str, radius_km: str) -> dict[str, str]:
    """The box around a circle on the globe, as expressions by name; it may cross the date line or hold a pole."""
    angle = f"({radius_km} / {float(EARTH_RADIUS_KM)}D)"
    reach = f"(degrees({angle}) + 1e-9D)"
    polar = f"abs({lat}) + {reach} >= 90D"
    wide = f"(degrees(asin(sin({angle}) / cos(radians({lat})))) + 1e-9D)"
    return {
        "lat_min": f"{lat} - {reach}",
        "lat_max": f"{lat} + {reach}",
        "lon_min": f"CASE WHEN {polar} THEN -180D WHEN {lon} - {wide} < -180D THEN {lon} - {wide} + 360D ELSE {lon} - {wide} END",
        "lon_max": f"CASE WHEN {polar} THEN 180D WHEN {lon} + {wide} > 180D THEN {lon} + {wide} - 360D ELSE {lon} + {wide} END",
    }
