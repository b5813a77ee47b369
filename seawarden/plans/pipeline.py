"""The layers: bronze -> silver -> gold -> routing, as plans and as saved tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from seawarden.operators import audit, profile, proximity, refine, risk, routing, weather
from seawarden.sources import reference, schemas, tables


def silver(bronze: DataFrame) -> DataFrame:
    """Clean positions, one per vessel and time."""
    return refine.clean(bronze)


def located(silver: DataFrame, ports: DataFrame) -> DataFrame:
    """Vessel summaries with the distance to port."""
    return proximity.add_port_distance(profile.summarise(silver), ports)


def weathered(vessels: DataFrame, observations: DataFrame) -> DataFrame:
    """Vessel summaries with the weather in force at their last position, defaults where unknown."""
    return weather.fill_defaults(weather.as_of(vessels, observations, by="PortZone", on="latest_time"))


def gold(silver: DataFrame, ports: DataFrame, observations: DataFrame) -> DataFrame:
    """Scored vessels."""
    scored = risk.score(weathered(located(silver, ports), observations))
    return schemas.conform(scored.withColumnRenamed("PortZone", "port_zone"), schemas.VESSEL_DISRUPTION_RISK)


def routed(gold: DataFrame, routes: DataFrame, obstacles: DataFrame, fuel: DataFrame) -> DataFrame:
    """Scored vessels with safety, cost and rerouting advice."""
    advised = routing.decide(routing.add_costs(routing.add_profile(gold, routes, obstacles, fuel)))
    return schemas.conform(advised, schemas.VESSEL_ROUTING_INTELLIGENCE)


def gold_plan(bronze: DataFrame, observations: DataFrame) -> DataFrame:
    """Gold in one plan, with the built-in reference tables."""
    return gold(silver(bronze), reference.port_zones(bronze.sparkSession), observations)


def routing_plan(bronze: DataFrame, observations: DataFrame) -> DataFrame:
    """Routing in one plan, with the built-in reference tables."""
    spark = bronze.sparkSession
    return routed(
        gold_plan(bronze, observations),
        reference.route_profile(spark),
        reference.maritime_obstacles(spark),
        reference.fuel_cost(spark),
    )


def publish(
    spark: SparkSession,
    bronze: DataFrame | str,
    observations: DataFrame,
    database: str,
    location: str | None = None,
    fmt: str = "parquet",
    silver_by_day: bool = False,
    keep_rejects: bool = False,
    expected: Mapping[str, int] | None = None,
) -> DataFrame:
    """Write all nine tables and return their audit. Running it again replaces them.

    Each layer is read back from its saved table, so the next one starts from stored data: a lost
    executor costs a rerun of one layer's tasks, and nothing is computed twice.

    ``bronze`` is a DataFrame to store, or the path of stored reports in format ``fmt``, which are
    then used where they are. ``silver_by_day`` partitions the clean positions by day, for readers
    that filter on time. ``keep_rejects`` also stores the unusable reports with the reason. ``expected`` gives row
    counts to hold the four layers against; those of the reference tables are known.
    """
    tables.ensure_database(spark, database, location)
    full = {name: f"{database}.{name}" for name in (*schemas.TABLES, "ais_rejected")}

    for name, rows in reference.PUBLISHED.items():
        tables.load_rows(rows(spark).coalesce(1), full[name], schemas.TABLES[name], fmt)

    def save(df: DataFrame, name: str) -> DataFrame:
        return tables.save(df, full[name], schemas.TABLES[name], fmt)

    if isinstance(bronze, str):
        raw = tables.register(spark, full["ais_bronze"], bronze, schemas.AIS_BRONZE, fmt)
    else:
        raw = save(bronze, "ais_bronze")
    if keep_rejects:
        tables.save(refine.split_rejects(raw)[1], full["ais_rejected"], fmt=fmt)
    if silver_by_day:
        by_day = silver(raw).selectExpr("*", "to_date(BaseDateTime) AS report_date")
        clean = tables.save(by_day, full["ais_silver"], fmt=fmt, partition_by=["report_date"]).drop("report_date")
    else:
        clean = save(silver(raw), "ais_silver")
    scored = save(gold(clean, spark.table(full["port_zones"]), observations), "vessel_disruption_risk")
    save(
        routed(
            scored,
            reference.route_profile(spark),
            spark.table(full["maritime_obstacles"]),
            reference.fuel_cost(spark),
        ),
        "vessel_routing_intelligence",
    )
    counts = {**dict.fromkeys(schemas.TABLES), **reference.ROW_COUNTS, **(expected or {})}
    return audit.saved_tables(spark, counts, database)
