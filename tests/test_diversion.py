from seawarden import fixed_values as fixed
from seawarden.operators import diversion
from seawarden.sources import reference, schemas
from tests.conftest import plan_of, rows


def vessels(spark, ports):
    return spark.createDataFrame(list(enumerate(ports, 1)), "MMSI long, port_zone string")


def test_options_are_safest_then_nearest_and_open(spark):
    got = diversion.options(vessels(spark, ["Los Angeles", "New York/NJ", "Seattle", "Offshore"]), reference.port_alternatives(spark))
    best = sorted((r.MMSI, r.option_rank, r.alternative_port) for r in got.collect())
    assert best == [
        (1, 1, "San Diego, CA"),
        (1, 2, "Long Beach (Backup)"),
        (2, 1, "Boston, MA"),
        (2, 2, "Norfolk, VA"),
        (3, 1, "Tacoma, WA"),
    ]


def test_k_limits_options(spark):
    got = diversion.options(vessels(spark, ["New York/NJ"] * 3), reference.port_alternatives(spark), k=1)
    assert rows(got.select("MMSI", "alternative_port")) == [(i, "Boston, MA") for i in (1, 2, 3)]


def coverage(spark):
    got = diversion.coverage(reference.route_profile(spark), reference.safe_corridors(spark), reference.zone_aliases(spark))
    return {(r.transit_zones, r.corridor_name): r.zones_avoided for r in got.collect()}


def test_corridors_by_zone_name_and_alias(spark):
    pacific, atlantic = "South China Sea, Strait of Hormuz", "Gulf of Guinea, Black Sea"
    gulf = "Cuba Restricted Zone, Venezuela EEZ"
    assert coverage(spark) == {
        (pacific, "Cape of Good Hope"): 2,
        (pacific, "Strait of Malacca Alternative"): 1,
        (pacific, "Arctic Northern Passage"): 2,
        (atlantic, "Northern Atlantic Corridor"): 2,
        (atlantic, "Arctic Northern Passage"): 2,
        (gulf, "Florida Straits Deep Water"): 2,
        (gulf, "Arctic Northern Passage"): 2,
    }


def test_red_sea_names_mean_one_zone(spark):
    routes = spark.createDataFrame([("X", "R", 1, "Red Sea / Gulf of Aden")], schemas.ROUTE_PROFILE)
    got = diversion.coverage(routes, reference.safe_corridors(spark), reference.zone_aliases(spark))
    assert {r.corridor_name: r.zones_avoided for r in got.collect()} == {
        "Cape of Good Hope": 1,
        "Bab-el-Mandeb Alternative": 1,
        "Arctic Northern Passage": 1,
    }


def test_uncovered(spark):
    zones = ["None (Domestic Coastal)", "Cuba Restricted Zone, Venezuela EEZ"]
    df = spark.createDataFrame(list(enumerate(zones)), "MMSI long, transit_zones string")
    tables = reference.route_profile(spark), reference.safe_corridors(spark), reference.zone_aliases(spark)
    assert [r.MMSI for r in diversion.uncovered(df, *tables).collect()] == [0]
    closed = tables[1].selectExpr(*[c if c != "status" else "'Restricted' AS status" for c in tables[1].columns])
    assert diversion.uncovered(df, tables[0], closed, tables[2]).count() == 2


def test_every_zone_has_a_route(spark):
    zones = reference.geopolitical_risk_zones(spark)
    df = spark.createDataFrame([("Trans-Pacific",)] * 3 + [("Coastal",)], "route_type string")
    exposed = {(r.route_type, r.zone_name): r.vessels for r in diversion.zone_exposure(df, zones).collect()}
    assert len(exposed) == 8 and {name for _, name in exposed} == {z[0] for z in fixed.GEOPOLITICAL_RISK_ZONES}
    assert exposed["Trans-Pacific", "South China Sea"] == 3 and exposed["Gulf Route", "Venezuela EEZ"] == 0
    critical = [(r.zone_name, r.vessels_exposed) for r in diversion.critical_exposure(df, zones).collect()]
    assert critical == [("Black Sea", 0), ("Red Sea / Gulf of Aden", 3), ("Strait of Hormuz", 3)]


def test_vessels_are_not_shuffled(spark):
    """Only reference rows move; the vessels stay where they are."""
    df = spark.range(100).selectExpr("id AS MMSI", "if(id % 2 = 0, 'Miami', 'Houston') AS port_zone")
    plan = plan_of(diversion.options(df, reference.port_alternatives(spark)))
    above = plan.split("Range (0, 100")[0]
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
    assert "Exchange hashpartitioning(MMSI" not in above and "Exchange hashpartitioning(port_zone" not in above


def test_vessels_stay_where_they_are(spark, tmp_path):
    """From a stored table larger than the broadcast threshold, vessels are neither shuffled nor broadcast."""
    names = [row[0] for row in fixed.PORT_ZONES]
    ports = f"element_at(array({', '.join(repr(name) for name in names)}), cast(id % {len(names)} + 1 AS int))"
    routed = spark.range(0, 200000, 1, 4).selectExpr("id AS MMSI", "md5(cast(id AS string)) AS VesselName", f"{ports} AS port_zone")
    routes = reference.route_profile(spark)
    routed.join(routes, "port_zone").write.parquet(f"{tmp_path}/routing")
    stored = spark.read.parquet(f"{tmp_path}/routing")
    tables = (routes, reference.safe_corridors(spark), reference.zone_aliases(spark))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100KB")
    try:
        for found in (diversion.corridors(stored, *tables), diversion.uncovered(stored, *tables)):
            found.collect()
            plan = plan_of(found)
            assert "hashpartitioning(transit_zones" not in plan.replace("#", "(") and "Exchange hashpartitioning" not in plan
            broadcast = plan.split("BroadcastExchange", 1)[1].split("+-", 2)[1]
            assert "LocalTableScan" in plan.split("BroadcastExchange", 1)[1] and "FileScan" not in broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
