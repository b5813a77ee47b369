"""Shapes of the plans: what must not be in them, and what must."""

import pytest

from seawarden.operators import proximity, weather
from seawarden.plans import pipeline
from seawarden.plans.queries import QUERIES
from seawarden.sources import event_feed, reference
from tests.conftest import plan_of

RUNS_ON_CALL = {"publish_tables", "table_audit", "stream_hourly_speed", "stream_latest", "stream_dedup"}
BATCH = sorted(set(QUERIES) - RUNS_ON_CALL)


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_and_no_python(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for unwanted in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "FlatMapGroups", "ExistingRDD"):
        assert unwanted not in plan


def test_only_needed_columns_are_read(spark, folder):
    plan = plan_of(QUERIES["kpis"](spark, folder))
    assert "props" not in plan.split("ReadSchema", 1)[1]


def test_summary_is_hash_aggregated(spark, folder):
    plan = plan_of(QUERIES["vessel_profile"](spark, folder))
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    assert "partial_max_by" in plan


def test_hot_left_side_of_a_shuffled_join_is_split(spark):
    """Ports as a large table, and a third of all vessels at one port."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "12",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        vessels = spark.range(0, 60000, 1, 8).selectExpr(
            "id", "if(id % 3 = 0, 'Miami', concat('P', id % 40)) AS PortZone", "25D + id / 1e6 AS latest_lat", "-80D AS latest_lon"
        )
        df = proximity.add_port_distance(vessels, reference.port_zones(spark))
        assert df.count() == 60000 and df.where("distance_to_port_km IS NOT NULL").count() == 20000
        df.collect()
        assert "skew=true" in plan_of(df)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_as_of_reads_its_rows_once(spark, events):
    vessels = pipeline.located(pipeline.silver(event_feed.positions(events)), reference.port_zones(spark))
    plan = plan_of(weather.as_of(vessels, event_feed.weather(events), by="PortZone", on="latest_time"))
    # the vessel track is scanned for one branch only; the others read observation times
    assert plan.count("value#") > 0 and sum("user_id" in line for line in plan.splitlines() if "FileScan" in line) == 1
