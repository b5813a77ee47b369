import random
from datetime import datetime, timedelta

import pytest

from seawarden.operators import trailing

START = datetime(2024, 1, 1)
SCHEMA = "MMSI long, BaseDateTime timestamp, SOG double"


def tracks(seed):
    """A vessel with most of the readings, sparse ones with long gaps, and one with a single reading."""
    pick = random.Random(seed)

    def track(vessel, count, step):
        times = sorted(pick.sample(range(count * step), count))
        return [(vessel, START + timedelta(minutes=t), pick.randrange(0, 2000) / 100) for t in times]

    return track(1, 1500, 3) + track(2, 90, 900) + track(3, 60, 60) + track(4, 1, 1) + track(5, 30, 4000)


def brute_force(data, rows):
    out, past = {}, {}
    for vessel, time, speed in sorted(data):
        before = past.setdefault(vessel, [])
        recent = before[-rows:]
        out[vessel, time] = round(sum(recent) / len(recent), 9) if recent else None
        before.append(speed)
    return out


@pytest.mark.parametrize("seed, rows, days", [(1, 24, 7), (2, 24, 1), (3, 3, 1), (4, 1, 30), (5, 200, 1)])
def test_trailing_average_equals_brute_force(spark, seed, rows, days):
    data = tracks(seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    got = trailing.trailing_average(df, rows=rows, bucket_days=days).collect()
    expected = brute_force(data, rows)
    assert len(got) == len(data)
    for r in got:
        want = expected[r.MMSI, r.BaseDateTime]
        assert r.trailing_avg == (want if want is None else pytest.approx(want))


def test_speed_drop_rule(spark):
    hour = [START + timedelta(hours=i) for i in range(6)]
    data = [(1, hour[0], 9.0), (1, hour[1], 9.0), (1, hour[2], 2.99), (1, hour[3], 3.0), (1, hour[4], 2.0), (2, hour[0], 1.0)]
    data += [(3, hour[0], 8.0), (3, hour[1], 1.0)]
    got = trailing.speed_drops(spark.createDataFrame(data, SCHEMA), rows=2).orderBy("MMSI", "BaseDateTime").collect()
    # vessel 1: 2.99 after 9 and 9 drops; 2.0 after 2.99 and 3.0 does not; vessel 3: a mean of 8 is not above 8
    assert [r.speed_drop for r in got] == [False, False, True, False, False, False, False, False]
    counts = {r.MMSI: (r.record_count, r.speed_drop_events, r.last_drop_time) for r in trailing.speed_drop_counts(spark.createDataFrame(data, SCHEMA), rows=2).collect()}
    assert counts == {1: (5, 1, hour[2]), 2: (1, 0, None), 3: (2, 0, None)}


def test_busy_vessel_leaves_only_bucket_edges_to_one_task(spark):
    data = [(1, START + timedelta(seconds=30 * i), 5.0) for i in range(20000)]
    df = trailing.trailing_average(spark.createDataFrame(data, SCHEMA), rows=24, bucket_days=1)
    df.collect()
    assert df.where("trailing_avg IS NULL").count() == 1
    # 7 days of readings every 30 seconds: 2 x 24 edge readings per day
    assert (20000 * 30) // 86400 + 1 == 7


def test_both_branches_share_the_bucket_shuffle(spark):
    df = trailing.trailing_average(spark.createDataFrame(tracks(1), SCHEMA))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("seed, days, gap", [(1, 7, 12), (2, 1, 1), (3, 1, 30), (4, 30, 3)])
def test_episodes_equal_brute_force(spark, seed, days, gap):
    """Drops are joined by their gaps alone, wherever the borders of time buckets lie."""
    data = tracks(seed)
    mean = brute_force(data, 24)
    expected, last = [], {}
    for vessel, time, speed in sorted(data):
        if speed < 3 and mean[vessel, time] is not None and mean[vessel, time] > 8:
            if vessel in last and time - last[vessel][2] <= timedelta(hours=gap):
                episode = last[vessel]
                episode[2], episode[3], episode[4] = time, episode[3] + 1, min(episode[4], speed)
            else:
                last[vessel] = [vessel, time, time, 1, speed]
                expected.append(last[vessel])
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    got = trailing.slowdown_episodes(df, gap_hours=gap, bucket_days=days).collect()
    assert sorted((r.MMSI, r.episode_start, r.episode_end, r.readings, r.min_sog) for r in got) == sorted(map(tuple, expected))
    assert all(r.hours == (r.episode_end - r.episode_start).total_seconds() / 3600 for r in got) and len(got) > 5


def test_readings_of_one_vessel_are_dealt_over_its_buckets(spark):
    """Before the window per vessel, drops have been joined per bucket."""
    df = spark.createDataFrame(tracks(1), SCHEMA)
    plan = trailing.slowdown_episodes(df)._jdf.queryExecution().optimizedPlan().toString()
    outer = plan[: plan.index("_bucket")]
    assert "Window" in outer and "Aggregate" in outer
