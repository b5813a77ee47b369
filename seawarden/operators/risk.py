"""Scores of a vessel's delay risk, from its summary, distance to port and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame

from seawarden import fixed_values as fixed
from seawarden.functions.bands import bands, labels, weighted
from seawarden.functions.text import quote, template
from seawarden.operators import add

# Estimated from the record count, for a vessel that is nearly stopped but was cruising.
SLOWDOWN_EVENTS = bands(
    [
        (
            f"latest_sog < {fixed.SLOW_KNOTS} AND avg_sog > {fixed.MODERATE_KNOTS}",
            f"round(record_count * {fixed.SLOWDOWN_SHARE}D, 0)",
        )
    ],
    "0D",
)
SLOWDOWN_SCORE = bands(
    [
        (f"latest_sog < {fixed.SLOW_KNOTS}", f"{fixed.SLOW_SCORE} + slowdown_events * {fixed.SLOW_PER_EVENT}D"),
        (f"latest_sog < {fixed.MODERATE_KNOTS}", f"{fixed.MODERATE_SCORE} + slowdown_events * {fixed.MODERATE_PER_EVENT}D"),
    ],
    f"{fixed.CRUISE_SCORE}D",
    digits=1,
)


def _worse_than(wind: int, wave: int) -> str:
    return f"wind_speed_kmh > {wind} OR wave_height_m > {wave}"


WEATHER_SEVERITY_SCORE = bands(
    [
        (
            _worse_than(fixed.STORM_WIND_KMH, fixed.STORM_WAVE_M),
            f"{fixed.STORM_SCORE} + wind_speed_kmh * {fixed.ROUGH_PER_KMH}D",
        ),
        (
            _worse_than(fixed.ROUGH_WIND_KMH, fixed.ROUGH_WAVE_M),
            f"{fixed.ROUGH_SCORE} + wind_speed_kmh * {fixed.ROUGH_PER_KMH}D",
        ),
        (f"visibility_m < {fixed.FOG_VISIBILITY_M}", f"{fixed.FOG_SCORE}D"),
    ],
    f"{fixed.CALM_SCORE} + wind_speed_kmh * {fixed.CALM_PER_KMH}D",
    digits=1,
)


def _closer_than(km: int, score: int, per_km: float) -> tuple[str, str]:
    return f"distance_to_port_km < {km}", f"{score} + ({km} - distance_to_port_km) * {per_km}D"


# Highest at the port; an unknown distance scores as a far one.
PORT_PROXIMITY_SCORE = bands(
    [
        _closer_than(fixed.NEAR_KM, fixed.NEAR_SCORE, fixed.NEAR_PER_KM),
        _closer_than(fixed.AROUND_KM, fixed.AROUND_SCORE, fixed.AROUND_PER_KM),
    ],
    f"{fixed.FAR_SCORE}D",
    digits=1,
)


def add_slowdown_scores(df: DataFrame) -> DataFrame:
    return add(add(df, slowdown_events=SLOWDOWN_EVENTS), slowdown_score=SLOWDOWN_SCORE)


def add_weather_scores(df: DataFrame) -> DataFrame:
    severity = labels("weather_severity_score", fixed.WEATHER_LABEL_BANDS, fixed.LOWEST_LABEL)
    return add(add(df, weather_severity_score=WEATHER_SEVERITY_SCORE), weather_severity=severity)


def add_proximity_scores(df: DataFrame) -> DataFrame:
    return add(df, port_proximity_score=PORT_PROXIMITY_SCORE)


def add_delay_risk(df: DataFrame) -> DataFrame:
    """The composite score and its level."""
    level = labels("delay_risk_score", fixed.RISK_LEVEL_BANDS, fixed.LOWEST_LABEL)
    return add(add(df, delay_risk_score=weighted(fixed.DELAY_RISK_WEIGHTS, digits=1)), risk_level=level)


def add_messages(df: DataFrame) -> DataFrame:
    """Recommended action and summary, by level."""

    def by_level(texts: dict[str, str], default: str) -> str:
        rules = [(f"risk_level = {quote(level)}", template(text)) for level, text in texts.items() if level != default]
        return bands(rules, template(texts[default]))

    return add(
        df,
        recommended_action=by_level(fixed.ACTION_TEXT, "Low"),
        disruption_summary=by_level(fixed.SUMMARY_TEXT, "other"),
    )


def score(df: DataFrame) -> DataFrame:
    """All risk columns. The three component scores do not depend on each other: two steps for all."""
    first = add(
        df,
        slowdown_events=SLOWDOWN_EVENTS,
        weather_severity_score=WEATHER_SEVERITY_SCORE,
        port_proximity_score=PORT_PROXIMITY_SCORE,
    )
    severity = labels("weather_severity_score", fixed.WEATHER_LABEL_BANDS, fixed.LOWEST_LABEL)
    second = add(first, slowdown_score=SLOWDOWN_SCORE, weather_severity=severity)
    return add_messages(add_delay_risk(second))
