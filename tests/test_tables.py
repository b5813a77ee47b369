from datetime import datetime
from types import SimpleNamespace

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from seawarden.operators import audit
from seawarden.plans import pipeline
from seawarden.session import is_there, shared_folder
from seawarden.sources import event_feed, files, reference, schemas, tables
from tests.conftest import rows


@pytest.fixture(scope="module")
def fleet(spark, events, tmp_path_factory):
    """All nine tables, published twice."""
    database = "fleet_test"
    location = str(tmp_path_factory.mktemp("fleet"))
    for _ in range(2):
        report = pipeline.publish(spark, event_feed.positions(events), event_feed.weather(events), database, location)
    return database, report


def test_rerun_replaces(spark, fleet, events):
    database, report = fleet
    counts = {r.table_name: (r.row_count, r.expected, r.status) for r in report.collect()}
    assert counts["ais_bronze"][0] == events.count()
    assert {name: counts[name][0] for name in reference.PUBLISHED} == {
        "port_zones": 6,
        "geopolitical_risk_zones": 7,
        "maritime_obstacles": 8,
        "safe_corridors": 8,
        "port_alternatives": 12,
    }
    assert set(counts) == set(schemas.TABLES) and {s for _, _, s in counts.values()} == {"OK"}


@pytest.mark.parametrize("name", sorted(schemas.TABLES))
def test_saved_schema(spark, fleet, name):
    schemas.check(spark.table(f"{fleet[0]}.{name}"), schemas.TABLES[name])
    assert spark.table(f"{fleet[0]}.{name}").columns == schemas.TABLES[name].names


def test_comments_are_kept(spark, fleet):
    described = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {fleet[0]}.ais_bronze").collect()}
    assert described["SOG"] == "Speed Over Ground (knots)"


def test_saved_layers_equal_one_plan(spark, fleet, events):
    planned = pipeline.routing_plan(event_feed.positions(events), event_feed.weather(events))
    assert rows(spark.table(f"{fleet[0]}.vessel_routing_intelligence")) == rows(planned)


@pytest.mark.parametrize(
    "columns, table, where, order",
    [
        (
            "VesselName, port_zone, risk_level, delay_risk_score, safety_score, rerouting_recommended",
            "vessel_routing_intelligence",
            "risk_level IN ('Critical', 'High')",
            "delay_risk_score",
        ),
        (
            "VesselName, route_type, routing_priority, delay_cost_usd, rerouting_cost_usd, net_savings_usd, rerouting_recommendation",
            "vessel_routing_intelligence",
            "rerouting_recommended = true",
            "net_savings_usd",
        ),
        (
            "zone_name, risk_level, risk_score, description, affected_routes",
            "geopolitical_risk_zones",
            "risk_level = 'Critical'",
            "risk_score",
        ),
    ],
)
def test_usual_sql_runs_on_the_tables(spark, fleet, columns, table, where, order):
    got = spark.sql(f"SELECT {columns} FROM {fleet[0]}.{table} WHERE {where} ORDER BY {order} DESC")
    assert got.count() > 0


def test_stored_reports_are_used_in_place(spark, fleet, events, tmp_path):
    path = f"{tmp_path}/reports"
    event_feed.positions(events).write.parquet(path)
    for _ in range(2):
        report = pipeline.publish(
            spark, path, event_feed.weather(events), "fleet_in_place", f"{tmp_path}/db", keep_rejects=True
        )
    assert {r.status for r in report.collect()} == {"OK"}
    described = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED fleet_in_place.ais_bronze").collect()}
    assert described["Type"] == "EXTERNAL" and described["Location"].endswith("/reports")
    same = "vessel_routing_intelligence"
    assert rows(spark.table(f"fleet_in_place.{same}")) == rows(spark.table(f"{fleet[0]}.{same}"))
    rejected = spark.table("fleet_in_place.ais_rejected")
    assert rejected.count() == events.where("event_id % 97 = 0").count()
    assert [r.reject_reason for r in rejected.select("reject_reason").distinct().collect()] == ["lat_out_of_range"]


def test_silver_by_day(spark, events, tmp_path):
    pipeline.publish(
        spark, event_feed.positions(events), event_feed.weather(events), "fleet_by_day", str(tmp_path), silver_by_day=True
    )
    day = spark.table("fleet_by_day.ais_silver").where("report_date = '2024-01-05'")
    assert "PartitionFilters: [isnotnull(report_date" in day._jdf.queryExecution().executedPlan().toString()
    assert 0 < day.count() < spark.table("fleet_by_day.ais_silver").count()


def test_audit_statuses(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("default.audit_full")
    tables.create_table(spark, "default.audit_empty", schemas.FUEL_COST)
    got = audit.saved_tables(spark, {"audit_full": 5, "audit_empty": None, "audit_missing": 1}, "default").collect()
    assert [tuple(r) for r in got] == [
        ("audit_full", 3, 5, -2, "OK"),
        ("audit_empty", 0, None, None, "EMPTY"),
        ("audit_missing", None, 1, None, "ERROR"),
    ]


def test_create_leaves_an_existing_table(spark):
    spark.sql("DROP TABLE IF EXISTS default.fuel_twice")
    tables.load_rows(reference.fuel_cost(spark), "default.fuel_twice", schemas.FUEL_COST)
    assert tables.create_table(spark, "default.fuel_twice", schemas.FUEL_COST).count() == 4
    assert tables.load_rows(reference.fuel_cost(spark), "default.fuel_twice", schemas.FUEL_COST).count() == 4


def test_rows_become_a_typed_table(spark):
    row = (7, "2024-01-01T00:00:00", 30.0, None, 5.0, 0.0, 70, 0, "O'Hara", "Houston")
    df = reference.rows_to_table(spark, [row, row], schemas.AIS_BRONZE)
    assert df.schema == schemas.AIS_BRONZE and [tuple(r) for r in df.collect()] == [row, row]
    seen = reference.rows_to_table(spark, [("A", datetime(2024, 1, 1, 5), *[1.0] * 7)], schemas.WEATHER_OBSERVATIONS)
    assert seen.first().obs_time == datetime(2024, 1, 1, 5)
    assert reference.rows_to_table(spark, [], schemas.FUEL_COST).count() == 0


def test_absent_column_is_an_error(spark):
    with pytest.raises(ValueError, match="columns missing: Status"):
        schemas.conform(spark.createDataFrame([], schemas.AIS_BRONZE).drop("Status"), schemas.AIS_BRONZE)


def test_wrong_type_is_an_error(spark):
    with pytest.raises(ValueError, match="fuel_cost_per_hour_usd: expected int, got bigint"):
        schemas.check(spark.createDataFrame([("a", 1)], "vessel_type string, fuel_cost_per_hour_usd long"), schemas.FUEL_COST)


def test_column_checks(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (1, None), (1, 200.0), (2, -1.0), (3, 0.0)], "k long, v double"
    )
    got = {r.check_name: (r.rows_checked, r.breaks, r.break_rate, r.status) for r in audit.columns(df, ["k"], ["v"], {"v": (0, 100)}).collect()}
    assert got == {
        "k repeated": (5, 2, 0.4, "BROKEN"),
        "v is null": (5, 1, 0.2, "BROKEN"),
        "v out of range": (5, 2, 0.4, "BROKEN"),
    }
    empty = audit.columns(df.where("k > 9"), ["k"], ["v"]).collect()
    assert [(r.breaks, r.break_rate, r.status) for r in empty] == [(0, None, "OK")] * 2


def test_gold_scores_are_never_null(spark, fleet):
    scores = ["slowdown_score", "weather_severity_score", "port_proximity_score", "delay_risk_score"]
    checks = audit.columns(spark.table(f"{fleet[0]}.vessel_disruption_risk"), ["MMSI"], scores)
    assert {r.status for r in checks.collect()} == {"OK"}


def session(master, **conf):
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_follows_the_session():
    cluster = session("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})
    one, two = shared_folder(cluster, "x"), shared_folder(cluster, "x")
    assert one.startswith("hdfs:///shared/x-") and one != two


def test_no_local_folder_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"), "x")
    assert "/x-" in shared_folder(session("local[2]"), "x")


@pytest.mark.parametrize("fmt, options", [("csv", {"header": "true"}), ("json", {}), ("orc", {}), ("parquet", {})])
def test_positions_and_weather_from_files(spark, events, tmp_path, fmt, options):
    positions, seen = event_feed.positions(events), event_feed.weather(events)
    positions.write.format(fmt).options(**options).save(f"{tmp_path}/p")
    seen.write.format(fmt).options(**options).save(f"{tmp_path}/w")
    read = files.read_positions(spark, f"{tmp_path}/p", fmt, **options)
    weather = files.read_observations(spark, f"{tmp_path}/w", fmt, **options)
    assert rows(pipeline.gold_plan(read, weather)) == rows(pipeline.gold_plan(positions, seen))


def test_format_holds_for_every_table_and_the_current_database_stays(spark, events, tmp_path):
    before = spark.catalog.currentDatabase()
    pipeline.publish(spark, event_feed.positions(events), event_feed.weather(events), "fleet_orc", str(tmp_path), fmt="orc")
    assert spark.catalog.currentDatabase() == before
    for name, schema in schemas.TABLES.items():
        described = {r.col_name: (r.data_type, r.comment) for r in spark.sql(f"DESCRIBE TABLE EXTENDED fleet_orc.{name}").collect()}
        assert described["Provider"][0].lower() == "orc", name
        wanted = {f.name: f.metadata["comment"] for f in schema.fields if "comment" in f.metadata}
        assert {n: described[n][1] for n in wanted} == wanted, name


def test_expected_counts_of_layers(spark, events, tmp_path):
    report = pipeline.publish(
        spark, event_feed.positions(events), event_feed.weather(events), "fleet_counted", str(tmp_path),
        expected={"ais_bronze": events.count() + 1},
    )
    assert {r.table_name: r.delta for r in report.collect()}["ais_bronze"] == -1


def _failing(spark, message="broken reading"):
    return spark.range(40).selectExpr("id", f"IF(id = 33, raise_error('{message}'), concat('new', id)) AS name")


@pytest.mark.parametrize("partition_by", [(), ("name",)], ids=["plain", "partitioned"])
def test_a_write_that_fails_leaves_the_old_rows(spark, partition_by):
    name = f"default.kept_{len(partition_by)}"
    old = spark.range(5).selectExpr("id", "concat('old', id % 2) AS name")
    tables.save(old, name, partition_by=partition_by)
    for _ in range(2):
        with pytest.raises(Exception, match="broken reading"):
            tables.save(_failing(spark), name, partition_by=partition_by)
        assert rows(spark.table(name)) == rows(old)
        before = {t.name for t in spark.catalog.listTables("default")}
        assert not [t for t in before if t.startswith("kept_") and "__" in t]
    new = spark.range(3).selectExpr("id", "concat('new', id % 2) AS name")
    assert rows(tables.save(new, name, partition_by=partition_by)) == rows(new) == rows(spark.table(name))
    spark.sql(f"DROP TABLE {name}")
    assert rows(tables.save(old, name, partition_by=partition_by)) == rows(old)
    spark.sql(f"DROP TABLE {name}")


def test_a_table_may_take_another_shape_and_be_filled_from_itself(spark):
    name = "default.reshaped"
    tables.save(spark.range(4), name)
    assert rows(tables.save(spark.table(name).selectExpr("id + 1 AS id"), name)) == [(1,), (2,), (3,), (4,)]
    assert rows(tables.save(spark.table(name).selectExpr("cast(id AS string) AS id", "id AS n"), name)) == [
        ("1", 1), ("2", 2), ("3", 3), ("4", 4)
    ]
    assert tables.save(spark.range(2), name, fmt="orc").count() == spark.table(name).count() == 2
    place = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]
    spark.sql(f"DROP TABLE {name}")
    assert not is_there(spark, place)


def test_filled_tables_keep_old_rows_when_a_write_fails(spark):
    schema = StructType([StructField("id", LongType(), True), StructField("name", StringType(), True)])
    tables.load_rows(spark.range(2).selectExpr("id", "'old' AS name"), "default.filled", schema)
    with pytest.raises(Exception, match="broken reading"):
        tables.load_rows(_failing(spark), "default.filled", schema)
    assert rows(spark.table("default.filled")) == [(0, "old"), (1, "old")]
    spark.sql("DROP TABLE default.filled")
