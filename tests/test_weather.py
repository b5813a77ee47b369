import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seawarden.operators import weather
from tests.conftest import plan_of

START = datetime(2024, 1, 1)
VALUES = ["wind_speed_kmh"]
OBSERVED = "port_zone string, obs_time timestamp, wind_speed_kmh double"
VESSELS = "id long, place string, seen timestamp"


def brute_force(vessels, observations):
    """Latest observation at or before, greatest value first among equal times."""
    out = []
    for vessel, place, seen in vessels:
        usable = [(t, w) for p, t, w in observations if p is not None and p == place and t is not None and seen is not None and t <= seen]
        # a missing value is below every other
        best = max(usable, key=lambda o: (o[0], o[1] is not None, o[1] or 0.0), default=(None, None))
        out.append((vessel, *best))
    return sorted(out, key=repr)


def found(spark, vessels, observations, **kwargs):
    got = weather.as_of(
        spark.createDataFrame(vessels, VESSELS),
        spark.createDataFrame(observations, OBSERVED),
        by="place",
        on="seen",
        values=VALUES,
        **kwargs,
    )
    return sorted(((r.id, r.obs_time, r.wind_speed_kmh) for r in got.collect()), key=repr)


def minute(n):
    return START + timedelta(minutes=n)


@pytest.mark.parametrize("seed, bucket_hours", [(1, 24), (2, 1), (3, 5), (4, 24 * 365)])
def test_as_of_equals_brute_force(spark, seed, bucket_hours):
    pick = random.Random(seed)
    # a third of the vessels sit at one place at one time
    vessels = [
        (i, "A", minute(3000)) if i % 3 == 0 else (i, pick.choice(["A", "B", "C", "none", None]), minute(pick.randrange(9000)))
        for i in range(300)
    ]
    vessels += [(900, "A", None)]
    observations = [
        (pick.choice(["A", "A", "A", "B", "C", None]), minute(pick.randrange(0, 8000, 7)), pick.choice([None, 1.0, 2.0, 3.0]))
        for _ in range(200)
    ]
    observations += [("A", None, 9.0)]
    assert found(spark, vessels, observations, bucket_hours=bucket_hours) == brute_force(vessels, observations)


def test_edges(spark):
    observations = [("A", minute(10), 1.0), ("A", minute(60 * 24 * 9), 2.0), ("B", minute(50), 5.0)]
    vessels = [
        (1, "A", minute(9)),  # before the first observation
        (2, "A", minute(10)),  # at the same time
        (3, "A", minute(60 * 24 * 4)),  # days later, in a bucket without observations
        (4, "A", minute(60 * 24 * 9 - 1)),
        (5, "A", minute(60 * 24 * 400)),  # long after the last
        (6, "B", minute(49)),
        (7, "C", minute(49)),
    ]
    assert found(spark, vessels, observations) == brute_force(vessels, observations)
    assert found(spark, vessels, []) == [(i, None, None) for i in range(1, 8)]


def test_equal_rows_are_all_kept(spark):
    vessels = [(1, "A", minute(30))] * 50
    assert found(spark, vessels, [("A", minute(1), 4.0)]) == [(1, minute(1), 4.0)] * 50


def test_no_pairs_are_formed(spark):
    df = spark.createDataFrame([(1, "A", START)], VESSELS)
    seen = spark.createDataFrame([("A", START, 1.0)], OBSERVED)
    plan = plan_of(weather.as_of(df, seen, by="place", on="seen", values=VALUES))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_defaults(spark):
    names = ", ".join(f"{name} double" for name in weather.WEATHER_COLUMNS)
    df = spark.createDataFrame([(None,) * 7, (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None), (1.0,) * 7], names)
    got = [tuple(r) for r in weather.fill_defaults(df).collect()]
    assert got == [
        (15.0, 20.0, 20.0, 0.0, 10000.0, 50.0, 1.5, True),
        (1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 1.5, True),
        (1.0,) * 7 + (False,),
    ]


def test_parse_payloads(spark):
    full = (
        '{"latitude": 1, "current": {"wind_speed_10m": 12.5, "wind_gusts_10m": 30, "temperature_2m": -1,'
        ' "precipitation": 0.2, "visibility": 900, "cloud_cover": 10, "unknown": [1]}}'
    )
    df = spark.createDataFrame(
        [
            (1, full, '{"current": {"wave_height": 2.5}}'),
            (2, '{"current": {"wind_speed_10m": "strong", "visibility": 7}}', "[]"),
            (3, "{", None),
            (4, "{}", '{"current": null}'),
        ],
        "id int, forecast_json string, marine_json string",
    )
    got = {r.id: tuple(r[c] for c in weather.WEATHER_COLUMNS) for r in weather.parse(df).collect()}
    assert got[1] == (12.5, 30.0, -1.0, 0.2, 900.0, 10.0, 2.5)
    assert got[2] == (None, None, None, None, 7.0, None, None)
    assert got[3] == got[4] == (None,) * 7


def test_rows_of_one_place_and_day_use_all_tasks(spark):
    """Whether the join is broadcast or shuffled, nothing caps the tasks that share a hot place and day."""
    df = spark.range(0, 200000, 1, 64).selectExpr("id", "'A' AS place", "timestamp'2024-01-01 00:30:00' AS seen")
    seen = spark.createDataFrame([("A", START, 1.0)], OBSERVED)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "64",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        shuffled = weather.as_of(df, seen, by="place", on="seen", values=VALUES)
        sizes = [r["count"] for r in shuffled.groupBy(F.spark_partition_id().alias("task")).count().collect()]
        assert len(sizes) >= 16 and max(sizes) < 3 * sum(sizes) / len(sizes) and sum(sizes) == 200000
        assert shuffled.where("wind_speed_kmh = 1").count() == 200000
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_large_sides_join_without_broadcast(spark):
    """With broadcasts off, the plan still has no pairs and the result is the same."""
    vessels = [(i, "AB"[i % 2], minute(i)) for i in range(50)]
    observations = [("A", minute(5), 1.0), ("B", minute(20), 2.0)]
    expected = found(spark, vessels, observations)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(spark, vessels, observations) == expected == brute_force(vessels, observations)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("page, node, bucket_hours", [(256, 1024, 24), (4, 3, 1), (1, 2, 1000), (7, 5, 24)])
def test_dense_feed_in_small_pages(spark, monkeypatch, page, node, bucket_hours):
    """One observation a second at one place, others far off: equal to brute force, and no long list."""
    monkeypatch.setattr(weather, "PAGE", page)
    monkeypatch.setattr(weather, "NODE", node)
    pick = random.Random(page)
    observations = [("A", START + timedelta(seconds=n), float(n)) for n in range(3000)]
    observations += [("B", minute(pick.randrange(10**6)), float(n)) for n in range(40)]
    observations += [("A", datetime(1970, 1, 2), -1.0), ("A", datetime(9999, 12, 30), -2.0), ("C", START, 5.0)]
    vessels = [(i, pick.choice("AAABCD"), START + timedelta(milliseconds=pick.randrange(-(10**6), 4 * 10**6))) for i in range(300)]
    vessels += [(900 + i, "A", datetime(1900 + 40 * i, 1, 1)) for i in range(10)] + [(990, "A", datetime(9999, 12, 31))]
    assert found(spark, vessels, observations, bucket_hours=bucket_hours) == brute_force(vessels, observations)
    seen = spark.createDataFrame(observations, OBSERVED).selectExpr("port_zone AS _by", "obs_time AS _at", "struct(obs_time) AS _obs")
    leaves, nodes, roots = weather.pages(seen, bucket_hours)
    assert leaves.selectExpr("max(size(_seen))").first()[0] == min(page, 3002)
    assert nodes.selectExpr("max(size(_pages))").first()[0] == min(node, -(-3002 // page))
    assert roots.selectExpr("max(size(_nodes))").first()[0] == -(-3002 // (page * node))


def test_a_lonely_date_adds_no_rows(spark):
    """Observations thousands of years apart are as many entries as there are observations."""
    observations = [("A", datetime(1, 1, 1), 1.0), ("A", datetime(9999, 12, 31), 2.0)]
    seen = spark.createDataFrame(observations, OBSERVED).selectExpr("port_zone AS _by", "obs_time AS _at", "struct(obs_time) AS _obs")
    leaves, nodes, roots = weather.pages(seen, 1)
    assert (leaves.count(), nodes.count(), roots.count()) == (1, 1, 1)
    plan = plan_of(weather.as_of(spark.createDataFrame([(1, "A", START)], VESSELS), spark.createDataFrame(observations, OBSERVED), by="place", on="seen", values=VALUES))
    assert "sequence(" not in plan and "Generate" not in plan
