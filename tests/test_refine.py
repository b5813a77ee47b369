from datetime import datetime

import pytest

from seawarden.functions.stats import exact_mean
from seawarden.operators import profile, refine, risk
from seawarden.plans import pipeline
from seawarden.sources import schemas
from tests.conftest import rows

GOOD = (1, "2024-01-01T00:00:00", 30.0, -90.0, 5.0, 0.0, 70, 0, "A", "Houston")


def frame(spark, *changes):
    """Bronze rows, each the good row with some columns changed."""
    names = schemas.AIS_BRONZE.names
    data = [tuple(change.get(n, v) for n, v in zip(names, GOOD)) for change in changes]
    return spark.createDataFrame(data, schemas.AIS_BRONZE)


def test_reject_reasons(spark):
    df = frame(
        spark,
        {},
        {"BaseDateTime": "not-a-time"},
        {"BaseDateTime": None},
        {"BaseDateTime": "2024-02-30T00:00:00"},
        {"LAT": 19.99},
        {"LAT": 20.0},
        {"LAT": 60.0},
        {"LAT": 60.01},
        {"LAT": None},
        {"LON": -130.0},
        {"LON": -130.01},
        {"LON": -65.0},
        {"LON": -64.99},
        {"SOG": 0.0},
        {"SOG": -0.01},
        {"SOG": None},
        {"LAT": 0.0, "SOG": -1.0},
    )
    got = [r.reject_reason for r in refine.tag_rejects(df).collect()]
    lat, lon = "lat_out_of_range", "lon_out_of_range"
    assert got == [None, "bad_time", "bad_time", "bad_time", lat, None, None, lat, lat, None, lon, None, lon, None, "bad_speed", "bad_speed", lat]


def test_split_is_complete(spark, events):
    from seawarden.sources import event_feed

    faulty = event_feed.faulty_positions(events)
    good, bad = refine.split_rejects(faulty)
    total = faulty.count()
    assert good.count() + bad.count() == total
    assert 0 < bad.count() < total
    assert refine.tag_rejects(faulty).where("reject_reason IS NULL").count() == good.count()


def test_fastest_reading_wins_and_ties_are_stable(spark):
    df = frame(
        spark,
        {"SOG": 5.0, "LAT": 31.0},
        {"SOG": 9.0, "LAT": 33.0},
        {"SOG": 9.0, "LAT": 32.0},
        {"SOG": 9.0, "LAT": 32.0},
        {"MMSI": 2, "SOG": 0.0},
    )
    for arrangement in (df, df.repartition(5), df.orderBy("LAT")):
        got = rows(refine.clean(arrangement).select("MMSI", "SOG", "LAT"))
        assert got == [(30.0, 2, 0.0), (32.0, 1, 9.0)]


def test_same_time_in_two_spellings_is_one_report(spark):
    df = frame(spark, {"SOG": 5.0}, {"SOG": 6.0, "BaseDateTime": "2024-01-01 00:00:00"})
    got = refine.clean(df, "yyyy-MM-dd['T'][' ']HH:mm:ss").collect()
    assert [(r.SOG, r.BaseDateTime) for r in got] == [(6.0, datetime(2024, 1, 1))]


@pytest.mark.parametrize("text", ["12:30:00", "T12:30:00", "2024", "2024-01", "2024-01-01", "2024-01-01 00:00:00", ""])
def test_other_times_are_rejected_not_guessed(spark, text):
    df = frame(spark, {"BaseDateTime": text})
    assert [r.reject_reason for r in refine.tag_rejects(df).collect()] == ["bad_time"]
    assert refine.clean(df).count() == 0


@pytest.mark.parametrize("speed", [float("nan"), float("inf"), float("-inf"), -0.1, None])
def test_impossible_speeds_are_rejected_with_a_reason(spark, speed):
    df = frame(spark, {"SOG": speed})
    assert [r.reject_reason for r in refine.tag_rejects(df).collect()] == ["bad_speed"]
    assert refine.clean(df).count() == 0


def test_bad_reports_do_not_stop_the_layers(spark):
    bad = [{"SOG": float("nan")}, {"SOG": float("inf")}, {"SOG": 1e300, "MMSI": 5}, {"BaseDateTime": "12:30:00"}]
    df = frame(spark, {"SOG": 14.004}, {"SOG": 2.004, "BaseDateTime": "2024-01-01T05:00:00"}, *bad)
    weather = spark.createDataFrame([], schemas.WEATHER_OBSERVATIONS)
    routed = {r.MMSI: r for r in pipeline.routing_plan(df, weather).collect()}
    assert len(routed) == 2 and routed[5].avg_sog == 1e300


def test_mean_speed_is_not_rounded_first(spark):
    df = frame(spark, {"SOG": 14.004}, {"SOG": 2.004, "BaseDateTime": "2024-01-01T05:00:00"})
    summary = risk.add_slowdown_scores(profile.summarise(refine.clean(df))).first()
    assert (summary.avg_sog, summary.slowdown_events) == (8.004, 1.0)
    mixed = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "v double")
    assert mixed.selectExpr(f"{exact_mean('v')} AS m").first().m == pytest.approx(0.2, abs=1e-15)
    assert mixed.where("v IS NULL").selectExpr(f"{exact_mean('v')} AS m").first().m is None
    assert mixed.where("v > 9").selectExpr(f"{exact_mean('v')} AS m").first().m is None

def test_unreadable_time_is_dropped_not_fatal(spark):
    df = frame(spark, {}, {"BaseDateTime": "soon"}, {"BaseDateTime": None})
    assert refine.clean(df).count() == 1


def test_explicit_time_format(spark):
    df = frame(spark, {"BaseDateTime": "01/02/2024 03:04"}, {"BaseDateTime": "2024-01-01T00:00:00"})
    got = refine.clean(df, "dd/MM/yyyy HH:mm").collect()
    assert [r.BaseDateTime for r in got] == [datetime(2024, 2, 1, 3, 4)]


def test_dedup_is_idempotent(spark, events):
    from seawarden.sources import event_feed

    once = refine.dedup(refine.usable(event_feed.positions(events)))
    assert rows(refine.dedup(once)) == rows(once)


def test_hot_key_is_cut_before_the_shuffle(spark):
    from tests.conftest import plan_of

    plan = plan_of(refine.clean(frame(spark, {})))
    assert "row_number(), 1, Partial" in plan


def test_labels(spark):
    got = rows(refine.clean(frame(spark, {"Status": 99, "VesselType": 0})).select("VesselTypeName", "NavStatus"))
    assert got == [("Unknown", "Other")]


def test_area_filter_reaches_the_scan(spark, tmp_path):
    from seawarden.sources.files import read_positions
    from tests.conftest import plan_of

    frame(spark, {}).write.parquet(str(tmp_path / "bronze"))
    plan = plan_of(refine.clean(read_positions(spark, str(tmp_path / "bronze"))))
    assert "GreaterThanOrEqual(LAT,20.0)" in plan and "GreaterThanOrEqual(SOG,0.0)" in plan
