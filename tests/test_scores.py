"""Every band at its edges, from hand-computed values."""

import pytest
from hypothesis import given, settings, strategies as st

from seawarden import fixed_values as fixed
from seawarden.functions.bands import bands, code_label, label_rank, labels, weighted
from seawarden.operators import reports, risk, routing


def one(spark, expression, **columns):
    """The value of an expression over one row of doubles (None for null)."""
    cells = ", ".join(
        f"cast({'NULL' if v is None else repr(v)} AS {'string' if isinstance(v, str) else 'double'}) AS {k}"
        for k, v in columns.items()
    )
    return spark.sql(f"SELECT {expression} AS x FROM (SELECT {cells})").first().x


@pytest.mark.parametrize(
    "speed, events, expected",
    [
        (0.0, 0.0, 80.0),
        (2.99, 22.0, 124.0),
        (3.0, 0.0, 50.0),
        (3.01, 0.0, 50.0),
        (7.99, 0.0, 50.0),
        (7.99, 2.0, 53.0),
        (8.0, 0.0, 20.0),
        (8.01, 5.0, 20.0),
        (None, 0.0, 20.0),
    ],
)
def test_slowdown_score(spark, speed, events, expected):
    assert one(spark, risk.SLOWDOWN_SCORE, latest_sog=speed, slowdown_events=events) == expected


@pytest.mark.parametrize(
    "speed, mean, count, expected",
    [
        (2.99, 8.01, 72.0, 22.0),
        (2.99, 8.01, 5.0, 2.0),
        (2.99, 8.01, 15.0, 5.0),
        (2.99, 8.0, 72.0, 0.0),
        (3.0, 9.0, 72.0, 0.0),
        (None, 9.0, 72.0, 0.0),
    ],
)
def test_slowdown_events(spark, speed, mean, count, expected):
    assert one(spark, risk.SLOWDOWN_EVENTS, latest_sog=speed, avg_sog=mean, record_count=count) == expected


@pytest.mark.parametrize(
    "wind, wave, sight, expected, label",
    [
        (50.1, 1.0, 9000.0, 95.0, "Severe"),
        (50.0, 1.0, 9000.0, 65.0, "High"),
        (0.0, 4.01, 9000.0, 80.0, "Severe"),
        (0.0, 4.0, 9000.0, 50.0, "High"),
        (30.1, 1.0, 9000.0, 59.0, "High"),
        (30.0, 2.0, 9000.0, 21.0, "Low"),
        (0.0, 2.01, 9000.0, 50.0, "High"),
        (10.0, 1.0, 1999.0, 60.0, "High"),
        (10.0, 1.0, 2000.0, 17.0, "Low"),
        (None, 5.0, 9000.0, None, "Low"),
        (10.0, None, 1999.0, 60.0, "High"),
    ],
)
def test_weather_score(spark, wind, wave, sight, expected, label):
    df = spark.createDataFrame([(wind, wave, sight)], "wind_speed_kmh double, wave_height_m double, visibility_m double")
    got = risk.add_weather_scores(df).first()
    assert (got.weather_severity_score, got.weather_severity) == (expected, label)


@pytest.mark.parametrize(
    "km, expected",
    [(0.0, 100.0), (9.99, 70.0), (9.9, 70.3), (10.0, 70.0), (10.01, 70.0), (29.99, 40.0), (29.0, 41.5), (30.0, 10.0), (None, 10.0)],
)
def test_proximity_score(spark, km, expected):
    assert one(spark, risk.PORT_PROXIMITY_SCORE, distance_to_port_km=km) == expected


@pytest.mark.parametrize(
    "score, level", [(70.0, "Critical"), (69.9, "High"), (50.0, "High"), (49.9, "Medium"), (30.0, "Medium"), (29.9, "Low")]
)
def test_levels(spark, score, level):
    assert one(spark, labels("s", fixed.RISK_LEVEL_BANDS, fixed.LOWEST_LABEL), s=score) == level


def test_delay_risk(spark):
    df = spark.createDataFrame(
        [(124.0, 95.0, 70.3)], "slowdown_score double, weather_severity_score double, port_proximity_score double"
    )
    got = risk.add_delay_risk(df).first()
    assert (got.delay_risk_score, got.risk_level) == (99.0, "Critical")


COSTS = (
    "risk_level string, delay_risk_score double, weather_severity_score double, geopolitical_risk_score int, "
    "obstacle_risk_score int, fuel_cost_per_hour_usd int"
)


@pytest.mark.parametrize(
    "level, score, geo, obstacle, fuel, expected",
    [
        # safety, hours, delay cost, miles, reroute cost, savings
        ("Critical", 80.0, 65, 35, 12000, (35.8, 29.0, 355500.0, 330.0, 198000.0, 157500.0)),
        ("Critical", 70.0, 10, 10, 3000, (63.0, 24.0, 79500.0, 220.0, 33000.0, 46500.0)),
        ("High", 60.0, 20, 35, 15000, (57.5, 11.0, 167500.0, 153.0, 114375.0, 53125.0)),
        ("High", 50.1, 55, 20, 8000, (51.2, 8.0, 66740.0, 130.0, 52000.0, 14740.0)),
        ("Medium", 31.4, 45, 25, 10000, (59.3, 2.1, 21900.0, 50.0, 25000.0, -3100.0)),
        ("Low", 10.0, 10, 10, 10000, (81.0, 0.5, 5500.0, 0.0, 0.0, 5500.0)),
    ],
)
def test_costs(spark, level, score, geo, obstacle, fuel, expected):
    df = spark.createDataFrame([(level, score, 70.0, geo, obstacle, fuel)], COSTS)
    got = routing.add_costs(df).first()
    assert (
        got.safety_score,
        got.estimated_delay_hours,
        got.delay_cost_usd,
        got.rerouting_distance_nm,
        got.rerouting_cost_usd,
        got.net_savings_usd,
    ) == expected


DECISION = "risk_level string, delay_risk_score double, geopolitical_risk_score int, obstacle_risk_score int, route_type string, port_zone string"


@pytest.mark.parametrize(
    "level, score, geo, obstacle, reroute, priority, advice",
    [
        ("Critical", 75.0, 61, 10, True, "Safety Critical", "SAFETY CRITICAL"),
        ("Critical", 75.0, 60, 10, True, "Safety Critical", "SAFETY FIRST"),
        ("Critical", 75.0, 10, 10, True, "Safety Critical", "SAFETY FIRST"),
        ("High", 55.0, 41, 25, True, "Balanced", "COST OPTIMIZED"),
        ("High", 55.0, 40, 25, False, "Balanced", "COST OPTIMIZED"),
        ("High", 55.0, 40, 26, True, "Balanced", "BALANCED"),
        ("High", 55.0, 61, 26, True, "Safety Critical", "BALANCED"),
        ("Medium", 30.0, 20, 35, False, "Monitor", "No rerouting"),
        ("Medium", 30.1, 20, 21, False, "Cost Optimized", "No rerouting"),
        ("Medium", 30.1, 20, 20, False, "Monitor", "No rerouting"),
        ("Low", 10.0, 65, 35, False, "Safety Critical", "No rerouting"),
    ],
)
def test_decisions(spark, level, score, geo, obstacle, reroute, priority, advice):
    df = spark.createDataFrame([(level, score, geo, obstacle, "Coastal", "Savannah")], DECISION)
    got = routing.decide(df).first()
    assert (got.rerouting_recommended, got.routing_priority) == (reroute, priority)
    assert got.rerouting_recommendation.startswith(advice)


def test_moderate_is_not_reached_by_real_weather(spark):
    """Wind at or above zero scores at most 21 or at least 50."""
    df = spark.range(0, 2000).selectExpr(
        "id / 10 AS wind_speed_kmh", "id % 60 / 10 AS wave_height_m", "cast(id * 7 % 10000 AS double) AS visibility_m"
    )
    assert risk.add_weather_scores(df).where("weather_severity = 'Moderate'").count() == 0


def test_codes(spark):
    label = code_label("c", fixed.VESSEL_TYPES, fixed.VESSEL_TYPE_OTHER)
    got = [one(spark, label, c=float(c)) for c in (70, 80, 31, 0, 36, 52, 99)] + [one(spark, label, c=None)]
    assert got == ["Cargo", "Tanker", "Tug", "Other", "Sailing", "Pleasure", "Other", "Other"]


def test_unknown_port_and_type_take_defaults(spark):
    from seawarden.sources import reference

    df = spark.createDataFrame([(1, "Nowhere", "Sailing"), (2, "Houston", "Tug")], "MMSI long, port_zone string, VesselTypeName string")
    got = {
        r.MMSI: (r.route_type, r.geopolitical_risk_score, r.obstacle_risk_score, r.fuel_cost_per_hour_usd)
        for r in routing.add_profile(
            df, reference.route_profile(spark), reference.maritime_obstacles(spark), reference.fuel_cost(spark)
        ).collect()
    }
    assert got == {1: ("Domestic", 10, 10, 10000), 2: ("Gulf Route", 45, 25, 3000)}


def test_messages(spark):
    df = spark.createDataFrame(
        [("Critical", "O'Hara {x}", "Houston", 1.5, 60.0, 4.25), ("Low", "B", "Miami", 9.0, 1.0, 1.0)],
        "risk_level string, VesselName string, PortZone string, latest_sog double, wind_speed_kmh double, wave_height_m double",
    )
    got = {r.risk_level: r for r in risk.add_messages(df).collect()}
    assert got["Critical"].disruption_summary == (
        "Vessel O'Hara {x} at Houston is at CRITICAL risk. Speed: 1.50 kn. Wind: 60.00 km/h. Waves: 4.3 m."
    )
    assert got["Low"].recommended_action == "NORMAL: No action required."


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 1300), min_size=2, max_size=40))
def test_level_never_falls_as_the_score_rises(spark, tenths):
    df = spark.createDataFrame([(t / 10,) for t in sorted(tenths)], "s double")
    rank = label_rank(labels("s", fixed.RISK_LEVEL_BANDS, fixed.LOWEST_LABEL), fixed.RISK_LEVELS)
    ranks = [r.r for r in df.selectExpr("s", f"{rank} AS r").orderBy("s").collect()]
    assert ranks == sorted(ranks, reverse=True)


def test_weighted_and_default(spark):
    assert one(spark, weighted({"a": 0.5, "b": 0.25}, 1), a=10.0, b=2.0) == 5.5
    assert one(spark, bands([("a > 1", "'x'")], "'y'"), a=None) == "y"


def test_distribution_orders(spark):
    df = spark.createDataFrame([(x,) for x in ["Low", "High", "Low", "Critical", "odd"]], "risk_level string")
    by_rank = [r.risk_level for r in reports.distribution(df, ["risk_level"], fixed.RISK_LEVELS).collect()]
    by_count = [tuple(r) for r in reports.distribution(df, ["risk_level"]).collect()]
    assert by_rank == ["Critical", "High", "Low", "odd"]
    assert by_count[0] == ("Low", 2)
