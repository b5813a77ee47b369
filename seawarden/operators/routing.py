"""Safety, cost and rerouting advice on top of the risk scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from seawarden import fixed_values as fixed
from seawarden.functions.bands import bands, weighted
from seawarden.functions.text import quote, template
from seawarden.operators import add

CRITICAL, HIGH = (f"risk_level = {quote(name)}" for name in fixed.RISK_LEVELS[:2])


def add_profile(df: DataFrame, routes: DataFrame, obstacles: DataFrame, fuel: DataFrame) -> DataFrame:
    """Route, zone score and transit zones by port, worst obstacle by port, fuel cost by vessel type."""
    route, geo, zones = fixed.ROUTE_DEFAULT
    worst = obstacles.groupBy("port_zone").agg(F.max("obstacle_risk_score").alias("obstacle_risk_score"))
    defaults = {
        "route_type": quote(route),
        "geopolitical_risk_score": geo,
        "transit_zones": quote(zones),
        "obstacle_risk_score": fixed.OBSTACLE_SCORE_DEFAULT,
        "fuel_cost_per_hour_usd": fixed.FUEL_COST_DEFAULT,
    }
    return (
        df.join(routes, "port_zone", "left")
        .join(worst, "port_zone", "left")
        .join(fuel.withColumnRenamed("vessel_type", "VesselTypeName"), "VesselTypeName", "left")
        .selectExpr(*df.columns, *[f"coalesce({name}, {value}) AS {name}" for name, value in defaults.items()])
    )


def _by_level(values: dict[str, str], otherwise: str) -> str:
    return bands([(f"risk_level = {quote(level)}", value) for level, value in values.items()], otherwise)


def delay_hours() -> str:
    """Hours at the lower bound of the vessel's level, and more for each point above it."""
    bounds = {level: low for low, level in fixed.RISK_LEVEL_BANDS}
    hours = {
        level: f"{least} + (delay_risk_score - {bounds[level]}) * {per_point}D"
        for level, (least, per_point) in fixed.DELAY_HOURS.items()
    }
    return _by_level(hours, f"{fixed.LEAST_DELAY_HOURS}D")


def late_penalty() -> str:
    """The base amount times a factor of the level."""
    factors = {level: f"{factor}D" for level, factor in fixed.LATE_FACTORS.items()}
    return f"{fixed.LATE_PENALTY_USD} * {_by_level(factors, f'{fixed.LEAST_LATE_FACTOR}D')}"


def detour_miles() -> str:
    """Miles of the way around: longer for a critical vessel by its zone, for a high one by its obstacles."""
    scores = {"Critical": "geopolitical_risk_score", "High": "obstacle_risk_score"}
    miles = {
        level: f"{least} + {scores[level]} * {per_point}D" if level in scores else f"{least}D"
        for level, (least, per_point) in fixed.DETOUR_MILES.items()
    }
    return _by_level(miles, "0D")


def add_costs(df: DataFrame) -> DataFrame:
    """Safety score, delay and rerouting cost. Costs use the hours and miles before rounding."""
    parts = add(
        add(df, _hours=delay_hours(), _miles=detour_miles()),
        _delay=f"fuel_cost_per_hour_usd * _hours + {late_penalty()}",
        _reroute=f"_miles * fuel_cost_per_hour_usd * {fixed.FUEL_SHARE_PER_MILE}D",
    )
    return add(
        parts,
        safety_score=f"round(100 - {weighted(fixed.SAFETY_WEIGHTS)}, 1)",
        estimated_delay_hours="round(_hours, 1)",
        delay_cost_usd="round(_delay, 0)",
        rerouting_distance_nm="round(_miles, 0)",
        rerouting_cost_usd="round(_reroute, 0)",
        net_savings_usd="round(_delay - _reroute, 0)",
    ).drop("_hours", "_miles", "_delay", "_reroute")


def decide(df: DataFrame) -> DataFrame:
    """Whether to reroute, how urgent it is, and what to tell the operator.

    A critical vessel always reroutes; a high one only if its zone or an obstacle adds to the risk.
    """
    text = {name: template(message) for name, message in fixed.REROUTING_TEXT.items()}
    risky_zone = f"geopolitical_risk_score > {fixed.ZONE_SCORE_SAFETY}"
    blocked = f"obstacle_risk_score > {fixed.OBSTACLE_SCORE_REROUTE}"
    worth_it = f"geopolitical_risk_score > {fixed.ZONE_SCORE_REROUTE} OR {blocked}"
    cheaper = f"delay_risk_score > {fixed.RISK_SCORE_COST} AND obstacle_risk_score > {fixed.OBSTACLE_SCORE_COST}"
    urgency = (f"{CRITICAL} OR {risky_zone}", HIGH, cheaper)
    priorities = [quote(name) for name in fixed.ROUTING_PRIORITIES]
    return add(
        df,
        rerouting_recommended=f"coalesce({CRITICAL} OR ({HIGH} AND ({worth_it})), false)",
        routing_priority=bands(zip(urgency, priorities), priorities[-1]),
        rerouting_recommendation=bands(
            [
                (f"{CRITICAL} AND {risky_zone}", text["critical_zone"]),
                (CRITICAL, text["critical"]),
                (f"{HIGH} AND {blocked}", text["high_obstacle"]),
                (HIGH, text["high"]),
            ],
            text["other"],
        ),
    )
