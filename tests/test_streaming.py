from datetime import datetime, timedelta

import pytest

from seawarden.session import remove_folder, subfolders
from seawarden.sources import schemas
from seawarden.streaming import positions as live
from tests.conftest import rows

START = datetime(2024, 1, 1)


def report(vessel, minutes, speed, port="Miami", lat=25.0):
    time = (START + timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%S")
    return (vessel, time, lat, -80.0, speed, 0.0, 70, 0, f"V{vessel}", port)


@pytest.fixture
def source(spark, tmp_path):
    """A folder, and a function that lets one more file of reports arrive in it."""
    folder = tmp_path / "incoming"
    folder.mkdir()

    def arrive(*reports):
        df = spark.createDataFrame(list(reports), schemas.AIS_BRONZE).coalesce(1)
        df.write.mode("append").parquet(str(folder))

    return str(folder), arrive, str(tmp_path)


def cleaned(spark, folder):
    return live.clean(live.positions(spark, folder, maxFilesPerTrigger="1"))


def test_cleaning_rules_hold(spark, source):
    folder, arrive, base = source
    arrive(report(1, 0, 5.0), report(1, 1, -1.0), report(2, 0, 5.0, lat=61.0), (3, "bad", 25.0, -80.0, 1.0, 0.0, 70, 0, "V", "Miami"))
    live.write_changes(cleaned(spark, folder), f"{base}/rows", f"{base}/progress", "append").awaitTermination()
    assert rows(spark.read.parquet(f"{base}/rows").select("MMSI", "VesselTypeName", "NavStatus")) == [
        (1, "Under way using engine", "Cargo")
    ]


def test_dedup_keeps_the_first_across_files_and_restarts(spark, source):
    folder, arrive, base = source

    def run():
        once = live.dedup(cleaned(spark, folder))
        live.write_changes(once, f"{base}/rows", f"{base}/progress", "append").awaitTermination()
        return rows(spark.read.parquet(f"{base}/rows").select("MMSI", "BaseDateTime", "SOG"))

    arrive(report(1, 0, 5.0), report(2, 0, 1.0))
    assert set(run()) == {(START, 1, 5.0), (START, 2, 1.0)}
    arrive(report(1, 0, 9.0), report(1, 30, 2.0))
    expected = {(START, 1, 5.0), (START, 2, 1.0), (START + timedelta(minutes=30), 1, 2.0)}
    assert set(run()) == expected
    assert len(run()) == 3


def test_hourly_speed_updates(spark, source):
    folder, arrive, base = source

    def run():
        hourly = live.hourly_speed(cleaned(spark, folder))
        live.keep_newest(hourly, ["PortZone", "hour_start"], f"{base}/rows", f"{base}/progress").awaitTermination()
        got = live.stored_state(spark, f"{base}/rows").collect()
        return {(r.PortZone, r.hour_start): (r.reports, r.avg_sog, r.min_sog, r.max_sog) for r in got}

    arrive(report(1, 0, 4.0), report(2, 59, 6.0), report(1, 60, 1.0))
    assert run() == {("Miami", START): (2, 5.0, 4.0, 6.0), ("Miami", START + timedelta(hours=1)): (1, 1.0, 1.0, 1.0)}
    arrive(report(3, 30, 11.0), report(3, 30, 2.0, "Houston"))
    got = run()
    assert got["Miami", START] == (3, 7.0, 4.0, 11.0) and got["Houston", START] == (1, 2.0, 2.0, 2.0) and len(got) == 3


def test_append_mode_emits_closed_hours_once(spark, source):
    folder, arrive, base = source

    def run():
        live.write_changes(
            live.hourly_speed(cleaned(spark, folder)), f"{base}/rows", f"{base}/progress", "append"
        ).awaitTermination()
        return rows(spark.read.parquet(f"{base}/rows").select("hour_start", "reports"))

    arrive(report(1, 0, 4.0), report(1, 181, 4.0))
    assert run() == [(START, 1)]
    arrive(report(1, 10, 4.0), report(1, 400, 4.0))  # the first one is too late
    assert run() == [(START, 1), (START + timedelta(hours=3), 1)]


def test_latest_with_late_reports(spark, source):
    folder, arrive, base = source

    def run():
        live.latest(cleaned(spark, folder), f"{base}/rows", f"{base}/progress").awaitTermination()
        return {r.MMSI: (r.BaseDateTime, r.SOG) for r in live.stored_state(spark, f"{base}/rows").collect()}

    arrive(report(1, 100, 4.0), report(1, 50, 9.0), report(2, 0, 3.0))
    assert run() == {1: (START + timedelta(minutes=100), 4.0), 2: (START, 3.0)}
    arrive(report(1, 90, 8.0), report(2, 0, 7.0), report(3, 5, 1.0))
    assert run() == {1: (START + timedelta(minutes=100), 4.0), 2: (START, 7.0), 3: (START + timedelta(minutes=5), 1.0)}
    assert run()[1] == (START + timedelta(minutes=100), 4.0)


def test_a_read_touches_one_state_version(spark, source):
    folder, arrive, base = source
    for n in range(6):
        arrive(report(1, n, float(n)), report(n + 2, n, 1.0))
    live.latest(cleaned(spark, folder), f"{base}/rows", f"{base}/progress").awaitTermination()
    state = live.stored_state(spark, f"{base}/rows")
    assert {path.split("/")[-2] for path in state.inputFiles()} == {"version=5"} and state.count() == 7
    assert sorted(subfolders(spark, f"{base}/rows")) == ["version=4", "version=5"]


def test_a_repeated_batch_starts_from_the_same_state(spark, source):
    folder, arrive, base = source
    arrive(report(1, 0, 5.0))
    arrive(report(1, 9, 6.0))
    live.latest(cleaned(spark, folder), f"{base}/rows", f"{base}/progress").awaitTermination()
    before = rows(live.stored_state(spark, f"{base}/rows"))
    remove_folder(spark, f"{base}/progress/commits/1")  # as if the second batch had not been confirmed
    live.latest(cleaned(spark, folder), f"{base}/rows", f"{base}/progress").awaitTermination()
    assert rows(live.stored_state(spark, f"{base}/rows")) == before


def test_state_can_be_read_before_the_first_batch(spark, source):
    folder, arrive, base = source
    live.latest(cleaned(spark, folder), f"{base}/rows", f"{base}/progress").awaitTermination()
    empty = live.stored_state(spark, f"{base}/rows")
    assert empty.count() == 0
    arrive(report(1, 0, 5.0))
    live.latest(cleaned(spark, folder), f"{base}/rows", f"{base}/progress").awaitTermination()
    state = live.stored_state(spark, f"{base}/rows")
    assert state.count() == 1 and state.dtypes == empty.dtypes


def test_a_running_stream_takes_a_trigger(spark, source):
    folder, arrive, base = source
    arrive(report(1, 0, 5.0))
    query = live.latest(
        cleaned(spark, folder), f"{base}/rows", f"{base}/progress", trigger={"processingTime": "200 milliseconds"}
    )
    try:
        query.processAllAvailable()
        assert query.isActive and live.stored_state(spark, f"{base}/rows").count() == 1
    finally:
        query.stop()
