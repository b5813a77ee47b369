"""Report queries on the risk and routing tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from seawarden import fixed_values as fixed
from seawarden.functions.bands import label_rank
from seawarden.functions.stats import exact_avg, exact_sum


def kpis(df: DataFrame) -> DataFrame:
    """The headline figures, in one pass and one row."""
    return df.agg(
        F.expr("count(1) AS total_vessels"),
        F.expr("count_if(risk_level = 'Critical') AS critical_vessels"),
        F.expr("count_if(risk_level = 'High') AS high_vessels"),
        F.expr(f"round({exact_avg('delay_risk_score', 1)}, 3) AS avg_risk_score"),
        F.expr(f"{exact_sum('delay_cost_usd')} AS total_delay_cost_usd"),
        F.expr(f"{exact_sum('net_savings_usd')} AS total_net_savings_usd"),
        F.expr("count_if(rerouting_recommended) AS vessels_to_reroute"),
        F.expr(f"{exact_sum('if(rerouting_recommended, net_savings_usd, 0D)')} AS rerouting_net_savings_usd"),
    )


def distribution(df: DataFrame, columns: Sequence[str], ranks: Sequence[str] | None = None) -> DataFrame:
    """Rows per combination of ``columns``; the most frequent first, or in the order of ``ranks``."""
    counted = df.groupBy(*columns).agg(F.expr("count(1) AS cnt"))
    first = F.expr(label_rank(columns[0], ranks)) if ranks is not None else F.desc("cnt")
    return counted.orderBy(first, *columns)


def ranked(
    df: DataFrame, by: str, tiebreak: Sequence[str], where: str | None = None, n: int | None = None
) -> DataFrame:
    """Rows that satisfy ``where``, the highest ``by`` first; only the first ``n`` if given.

    End ``tiebreak`` with a unique column: it makes the order repeatable, and lets the sort spread
    rows that share a value of ``by`` over several tasks.
    """
    out = (df.where(where) if where else df).orderBy(F.desc(by), *tiebreak)
    return out.limit(n) if n is not None else out


def high_risk_vessels(df: DataFrame) -> DataFrame:
    columns = ["VesselName", "port_zone", "risk_level", "delay_risk_score", "safety_score", "rerouting_recommended"]
    chosen = "risk_level IN ('Critical', 'High')"
    return ranked(df, "delay_risk_score", ["VesselName", "MMSI"], chosen).select(*columns)


def reroute_list(df: DataFrame) -> DataFrame:
    columns = [
        "VesselName",
        "route_type",
        "routing_priority",
        "delay_cost_usd",
        "rerouting_cost_usd",
        "net_savings_usd",
        "rerouting_recommendation",
    ]
    return ranked(df, "net_savings_usd", ["VesselName", "MMSI"], "rerouting_recommended").select(*columns)


def port_summary(df: DataFrame) -> DataFrame:
    """Risk, obstacle and zone measures per port."""

    def measures(score: str, name: str, digits: int):
        return (
            F.expr(f"round({exact_avg(score, digits)}, 3) AS avg_{name}"),
            F.expr(f"max({score}) AS max_{name}"),
        )

    return df.groupBy("port_zone").agg(
        F.expr("count(1) AS vessels"),
        *measures("delay_risk_score", "delay_risk", 1),
        *measures("obstacle_risk_score", "obstacle_risk", 0),
        *measures("geopolitical_risk_score", "geopolitical_risk", 0),
    )


def port_level_pivot(df: DataFrame) -> DataFrame:
    """Vessels per port and risk level, one column per level; the fixed levels save a scan for them."""
    return df.groupBy("port_zone").pivot("risk_level", fixed.RISK_LEVELS).count().na.fill(0)


def risk_pairs(df: DataFrame) -> DataFrame:
    """Measures to plot against each other, per vessel."""
    return df.select(
        "MMSI",
        "VesselName",
        "risk_level",
        "wind_speed_kmh",
        "latest_sog",
        "delay_risk_score",
        "delay_cost_usd",
        "safety_score",
    )
