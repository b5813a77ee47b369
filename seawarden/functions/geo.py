"""Positions on the globe."""

from __future__ import annotations

from seawarden.fixed_values import EARTH_RADIUS_KM


def distance_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance (haversine, atan2 form); null if any input is null."""
    half_dlat = f"sin(radians({lat2} - {lat1}) / 2)"
    half_dlon = f"sin(radians({lon2} - {lon1}) / 2)"
    chord = (
        f"({half_dlat} * {half_dlat}"
        f" + cos(radians({lat1})) * cos(radians({lat2})) * {half_dlon} * {half_dlon})"
    )
    return f"{2 * EARTH_RADIUS_KM}D * atan2(sqrt({chord}), sqrt(1 - {chord}))"


def grid_cell(degrees: str, size: float) -> str:
    """Index of the grid line at or below a coordinate."""
    return f"floor({degrees} / {float(size)}D)"
