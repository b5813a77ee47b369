"""The registered queries once more, as SQL for another engine, to compare results.

Written apart from the DataFrame code. Only the rows of reference tables and the texts of
messages come from the shared fixed values.
"""

from __future__ import annotations

from seawarden import fixed_values as fixed


def _value(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return f"{value!r}::DOUBLE" if isinstance(value, float) else str(value)


def _rows(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join(_value(v) for v in row) + ")" for row in rows) + ")"


def _message(text: str) -> str:
    """A message format as a concatenation: 'at ' || port || '.'"""
    out, rest = [], text
    while "{" in rest:
        before, rest = rest.split("{", 1)
        name, rest = rest.split("}", 1)
        if before:
            out.append(_value(before))
        column, _, spec = name.partition(":")
        out.append(f"printf('{spec}', {column})" if spec else column)
    if rest:
        out.append(_value(rest))
    return " || ".join(out)


def _half_up(expression: str, digits: int) -> str:
    """Spark rounds a double half-up on its shortest decimal form, not on its binary value."""
    return f"round(CAST(CAST({expression} AS DOUBLE)::VARCHAR AS DECIMAL(38, 18)), {digits})::DOUBLE"


_PORTS = [(slot, *zone[:7]) for slot, zone in enumerate(fixed.PORT_ZONES)]
_ROUTE, _GEO, _ZONES = fixed.ROUTE_DEFAULT
_W = fixed.WEATHER_DEFAULTS

CTES = {
    "ports": f"""SELECT * FROM {_rows(_PORTS)}
        t(slot, port_zone, center_lat, center_lon, lat_min, lat_max, lon_min, lon_max)""",
    "alternatives": f"""SELECT * FROM {_rows(fixed.PORT_ALTERNATIVES)}
        t(current_port, alternative_port, distance_nm, transit_hours, berth_capacity, safety_rating, status, note)""",
    "zones": f"""SELECT * FROM {_rows(fixed.GEOPOLITICAL_RISK_ZONES)}
        t(zone_name, zone_type, risk_level, risk_score, description, affected_routes)""",
    "obstacles": f"""SELECT * FROM {_rows(fixed.MARITIME_OBSTACLES)}
        t(obstacle_name, obstacle_type, port_zone, radius_km, severity, obstacle_risk_score, description)""",
    "safe_corridors": f"""SELECT * FROM {_rows(fixed.SAFE_CORRIDORS)}
        t(corridor_name, route_alternative, avoids_zones, additional_nm, additional_hours, safety_rating, status, note)""",
    "aliases": f"""SELECT * FROM {_rows(fixed.ZONE_ALIASES)} t(alias, zone_name)
        UNION ALL SELECT '{fixed.ALL_ZONES_ALIAS}', zone_name FROM zones""",
    "routes": f"""SELECT * FROM {_rows(fixed.ROUTE_PROFILE)}
        t(port_zone, route_type, geopolitical_risk_score, transit_zones)""",
    "fuel": f"""SELECT * FROM {_rows(fixed.FUEL_COST)} t(vessel_type, fuel_cost_per_hour_usd)""",
    # events as position reports
    "reports": """SELECT e.event_id AS report_id, 200000000 + e.user_id AS MMSI,
          date_trunc('hour', e.ts) AS BaseDateTime,
          CASE WHEN e.event_id % 97 = 0 THEN 61.0::DOUBLE
               ELSE coalesce(p.center_lat, 36.0::DOUBLE) + ((e.event_id * 37) % 101 - 50) * 0.005::DOUBLE END AS LAT,
          coalesce(p.center_lon, -70.0::DOUBLE) + ((e.event_id * 53) % 103 - 51) * 0.005::DOUBLE AS LON,
          round(e.value * 0.2::DOUBLE, 2) AS SOG,
          ((e.event_id * 29) % 3600)::DOUBLE / 10 AS COG,
          [70, 80, 31, 0, 36, 52][((e.user_id * 5 + 3) % 6 + 1)::INT] AS VesselType,
          [0, 1, 5, 7, 99][(e.event_id % 5 + 1)::INT] AS Status,
          printf('VESSEL %04d', e.user_id) AS VesselName,
          coalesce(p.port_zone, 'Offshore') AS PortZone
        FROM events e LEFT JOIN ports p ON p.slot = e.user_id % 7""",
    "valid": """SELECT * FROM reports
        WHERE LAT >= 20 AND LAT <= 60 AND LON >= -130 AND LON <= -65 AND SOG >= 0""",
    "silver": """SELECT MMSI, BaseDateTime, LAT, LON, SOG, COG, VesselType,
          coalesce(map {70: 'Cargo', 80: 'Tanker', 31: 'Tug', 36: 'Sailing', 52: 'Pleasure'}[VesselType],
                   'Other') AS VesselTypeName,
          Status,
          coalesce(map {0: 'Under way using engine', 1: 'At anchor', 5: 'Moored', 7: 'Engaged in fishing'}[Status],
                   'Unknown') AS NavStatus,
          VesselName, PortZone
        FROM valid
        QUALIFY row_number() OVER (PARTITION BY MMSI, BaseDateTime
          ORDER BY SOG DESC, LAT, LON, COG, VesselType, Status, VesselName, PortZone) = 1""",
    "profiles": """SELECT MMSI, VesselName, VesselTypeName, PortZone,
          sum(SOG::DECIMAL(38, 12))::DOUBLE / count(SOG) AS avg_sog, min(SOG) AS min_sog, max(SOG) AS max_sog,
          count(SOG) AS record_count, arg_max(LAT, BaseDateTime) AS latest_lat,
          arg_max(LON, BaseDateTime) AS latest_lon, arg_max(SOG, BaseDateTime) AS latest_sog,
          max(BaseDateTime) AS latest_time
        FROM silver GROUP BY ALL""",
    "located": """SELECT v.* EXCLUDE (h), 2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) AS distance_to_port_km
        FROM (SELECT s.*,
                pow(sin(radians(p.center_lat - latest_lat) / 2), 2) + cos(radians(latest_lat))
                  * cos(radians(p.center_lat)) * pow(sin(radians(p.center_lon - latest_lon) / 2), 2) AS h
              FROM profiles s LEFT JOIN ports p ON p.port_zone = s.PortZone) v""",
    "observed": """SELECT coalesce(p.port_zone, 'Offshore') AS port_zone, obs_time,
          (5 + (h * 7 + s.slot * 11) % 60)::DOUBLE AS wind, (500 + (h * 131 + s.slot * 17) % 9500)::DOUBLE AS sight,
          (10 + (h * 13 + s.slot * 7) % 40)::DOUBLE / 10 AS wave,
          CASE WHEN h % 3 = 0 THEN (10 + (h * 5 + s.slot * 3) % 80)::DOUBLE END AS gusts,
          CASE WHEN h % 3 = 0 THEN ((h * 7 + s.slot) % 45 - 10)::DOUBLE END AS temperature,
          CASE WHEN h % 3 = 0 THEN ((h + s.slot) % 20)::DOUBLE / 10 END AS rain,
          CASE WHEN h % 3 = 0 THEN ((h * 11 + s.slot * 13) % 101)::DOUBLE END AS clouds,
          p.center_lat, p.center_lon
        FROM (SELECT DISTINCT date_trunc('hour', ts) AS obs_time,
                extract(day FROM ts) * 24 + extract(hour FROM ts) AS h
              FROM events WHERE event_type = 'view') hours
        CROSS JOIN (VALUES (0), (1), (2), (3), (4), (6)) s(slot)
        LEFT JOIN ports p ON p.slot = s.slot""",
    "weathered": f"""SELECT l.*, w.obs_time,
          coalesce(w.wind, {_W['wind_speed_kmh']})::DOUBLE AS wind_speed_kmh,
          coalesce(w.gusts, {_W['wind_gusts_kmh']})::DOUBLE AS wind_gusts_kmh,
          coalesce(w.temperature, {_W['temperature_c']})::DOUBLE AS temperature_c,
          coalesce(w.rain, {_W['precipitation_mm']})::DOUBLE AS precipitation_mm,
          coalesce(w.sight, {_W['visibility_m']})::DOUBLE AS visibility_m,
          coalesce(w.clouds, {_W['cloud_cover_pct']})::DOUBLE AS cloud_cover_pct,
          coalesce(w.wave, {_W['wave_height_m']})::DOUBLE AS wave_height_m, w.gusts IS NULL AS weather_imputed
        FROM located l ASOF LEFT JOIN observed w ON l.PortZone = w.port_zone AND l.latest_time >= w.obs_time""",
    "parts": f"""SELECT *,
          {_half_up("CASE WHEN latest_sog < 3 THEN 80 + 2 * slowdown_events WHEN latest_sog < 8 "
                    "THEN 50 + 1.5 * slowdown_events ELSE 20 END", 1)} AS slowdown_score,
          {_half_up("CASE WHEN distance_to_port_km < 10 THEN 70 + 3 * (10 - distance_to_port_km) "
                    "WHEN distance_to_port_km < 30 THEN 40 + 1.5 * (30 - distance_to_port_km) ELSE 10 END", 1)}
            AS port_proximity_score,
          {_half_up("CASE WHEN wind_speed_kmh > 50 OR wave_height_m > 4 THEN 80 + 0.3::DOUBLE * wind_speed_kmh "
                    "WHEN wind_speed_kmh > 30 OR wave_height_m > 2 THEN 50 + 0.3::DOUBLE * wind_speed_kmh "
                    "WHEN visibility_m < 2000 THEN 60 ELSE 15 + 0.2::DOUBLE * wind_speed_kmh END", 1)}
            AS weather_severity_score
        FROM (SELECT *, CASE WHEN latest_sog < 3 AND avg_sog > 8 THEN {_half_up("0.3::DOUBLE * record_count", 0)}
                             ELSE 0.0::DOUBLE END AS slowdown_events FROM weathered)""",
    "scored": f"""SELECT *, CASE WHEN delay_risk_score >= 70 THEN 'Critical' WHEN delay_risk_score >= 50 THEN 'High'
                   WHEN delay_risk_score >= 30 THEN 'Medium' ELSE 'Low' END AS risk_level
        FROM (SELECT *,
                {_half_up("slowdown_score * 0.35::DOUBLE + weather_severity_score * 0.4::DOUBLE "
                          "+ port_proximity_score * 0.25::DOUBLE", 1)} AS delay_risk_score,
                CASE WHEN weather_severity_score >= 70 THEN 'Severe' WHEN weather_severity_score >= 50 THEN 'High'
                     WHEN weather_severity_score >= 30 THEN 'Moderate' ELSE 'Low' END AS weather_severity
              FROM parts)""",
    "gold": f"""SELECT * EXCLUDE (PortZone, record_count, latest_time, obs_time, weather_imputed),
          PortZone AS port_zone,
          CASE risk_level WHEN 'Critical' THEN {_message(fixed.ACTION_TEXT['Critical'])}
               WHEN 'High' THEN {_message(fixed.ACTION_TEXT['High'])}
               WHEN 'Medium' THEN {_message(fixed.ACTION_TEXT['Medium'])}
               ELSE {_message(fixed.ACTION_TEXT['Low'])} END AS recommended_action,
          CASE risk_level WHEN 'Critical' THEN {_message(fixed.SUMMARY_TEXT['Critical'])}
               WHEN 'High' THEN {_message(fixed.SUMMARY_TEXT['High'])}
               ELSE {_message(fixed.SUMMARY_TEXT['other'])} END AS disruption_summary
        FROM scored""",
    "worst": "SELECT port_zone, max(obstacle_risk_score) AS obstacle_risk_score FROM obstacles GROUP BY port_zone",
    "profiled": f"""SELECT g.*, coalesce(r.route_type, '{_ROUTE}') AS route_type,
          coalesce(r.geopolitical_risk_score, {_GEO}) AS geopolitical_risk_score,
          coalesce(r.transit_zones, '{_ZONES}') AS transit_zones,
          coalesce(o.obstacle_risk_score, {fixed.OBSTACLE_SCORE_DEFAULT}) AS obstacle_risk_score,
          coalesce(f.fuel_cost_per_hour_usd, {fixed.FUEL_COST_DEFAULT}) AS fuel_cost_per_hour_usd
        FROM gold g LEFT JOIN routes r USING (port_zone) LEFT JOIN worst o USING (port_zone)
        LEFT JOIN fuel f ON f.vessel_type = g.VesselTypeName""",
    "costed": f"""SELECT * EXCLUDE (hours, miles, penalty),
          {_half_up("100 - (delay_risk_score * 0.3::DOUBLE + geopolitical_risk_score * 0.35::DOUBLE "
                    "+ obstacle_risk_score * 0.2::DOUBLE + weather_severity_score * 0.15::DOUBLE)", 1)} AS safety_score,
          {_half_up("hours", 1)} AS estimated_delay_hours,
          {_half_up("fuel_cost_per_hour_usd * hours + penalty", 0)} AS delay_cost_usd,
          {_half_up("miles", 0)} AS rerouting_distance_nm,
          {_half_up("miles * fuel_cost_per_hour_usd * 0.05::DOUBLE", 0)} AS rerouting_cost_usd,
          {_half_up("fuel_cost_per_hour_usd * hours + penalty - miles * fuel_cost_per_hour_usd * 0.05::DOUBLE", 0)}
            AS net_savings_usd
        FROM (SELECT *,
                (CASE risk_level WHEN 'Critical' THEN 24 + (delay_risk_score - 70) / 2
                      WHEN 'High' THEN 8 + (delay_risk_score - 50) * 0.3::DOUBLE
                      WHEN 'Medium' THEN 2 + (delay_risk_score - 30) * 0.1::DOUBLE ELSE 0.5 END)::DOUBLE AS hours,
                (CASE risk_level WHEN 'Critical' THEN 200 + 2 * geopolitical_risk_score
                      WHEN 'High' THEN 100 + 1.5 * obstacle_risk_score
                      WHEN 'Medium' THEN 50 ELSE 0 END)::DOUBLE AS miles,
                (CASE risk_level WHEN 'Critical' THEN 7500 WHEN 'High' THEN 2500 ELSE 500 END)::DOUBLE AS penalty
              FROM profiled)""",
    "routing": f"""SELECT * EXCLUDE (min_sog, max_sog),
          (risk_level = 'Critical' OR (risk_level = 'High' AND geopolitical_risk_score > 40)
           OR (risk_level = 'High' AND obstacle_risk_score > 25)) AS rerouting_recommended,
          CASE WHEN geopolitical_risk_score > 60 OR risk_level = 'Critical' THEN 'Safety Critical'
               WHEN risk_level = 'High' THEN 'Balanced'
               WHEN obstacle_risk_score > 20 AND delay_risk_score > 30 THEN 'Cost Optimized'
               ELSE 'Monitor' END AS routing_priority,
          CASE risk_level
            WHEN 'Critical' THEN CASE WHEN geopolitical_risk_score > 60
              THEN {_message(fixed.REROUTING_TEXT['critical_zone'])} ELSE {_message(fixed.REROUTING_TEXT['critical'])} END
            WHEN 'High' THEN CASE WHEN obstacle_risk_score > 25
              THEN {_message(fixed.REROUTING_TEXT['high_obstacle'])} ELSE {_message(fixed.REROUTING_TEXT['high'])} END
            ELSE {_message(fixed.REROUTING_TEXT['other'])} END AS rerouting_recommendation
        FROM costed""",
    "route_zones": """SELECT transit_zones, coalesce(a.zone_name, z) AS zone
        FROM (SELECT transit_zones, trim(unnest(string_split(transit_zones, ','))) AS z
              FROM (SELECT DISTINCT transit_zones FROM routes)) LEFT JOIN aliases a ON a.alias = z""",
    "corridor_zones": """SELECT c.*, coalesce(a.zone_name, z) AS zone
        FROM (SELECT *, trim(unnest(string_split(avoids_zones, ','))) AS z FROM safe_corridors) c
        LEFT JOIN aliases a ON a.alias = z""",
    "coverage": """SELECT transit_zones, corridor_name, route_alternative, additional_nm, additional_hours,
          safety_rating, status, count(DISTINCT zone) AS zones_avoided
        FROM route_zones JOIN corridor_zones USING (zone) GROUP BY ALL""",
    "exposure": """SELECT z.*, v.route_type, coalesce(r.vessels, 0) AS vessels
        FROM zones z CROSS JOIN LATERAL (SELECT trim(unnest(string_split(z.affected_routes, ','))) AS route_type) v
        LEFT JOIN (SELECT route_type, count(*) AS vessels FROM routing GROUP BY route_type) r USING (route_type)""",
    "fine_silver": """SELECT * EXCLUDE (SOG), round(SOG, 2) + (report_id % 100) / 10000.0::DOUBLE AS SOG FROM valid
        QUALIFY row_number() OVER (PARTITION BY MMSI, BaseDateTime
          ORDER BY round(SOG, 2) + (report_id % 100) / 10000.0::DOUBLE DESC, LAT, LON, COG, VesselType, Status,
            VesselName, PortZone) = 1""",
    # reports with damaged fields, and payloads
    "faulty": """SELECT report_id, MMSI, LAT,
          CASE WHEN report_id % 89 = 0 THEN 'not-a-time' WHEN report_id % 83 = 0 THEN NULL
               WHEN report_id % 79 = 0 THEN '2024-13-01T00:00:00' WHEN report_id % 61 = 0 THEN '12:30:00'
               WHEN report_id % 59 = 0 THEN '2024-01' WHEN report_id % 53 = 0 THEN 'T12:30:00'
               ELSE strftime(BaseDateTime, '%Y-%m-%dT%H:%M:%S') END AS BaseDateTime,
          CASE WHEN report_id % 73 = 0 THEN -131.0::DOUBLE ELSE LON END AS LON,
          CASE WHEN report_id % 71 = 0 THEN -1.0::DOUBLE WHEN report_id % 67 = 0 THEN NULL
               WHEN report_id % 47 = 0 THEN 'NaN'::DOUBLE WHEN report_id % 43 = 0 THEN 'Infinity'::DOUBLE
               ELSE SOG END AS SOG
        FROM reports""",
    "rejected": """SELECT * FROM reports
        WHERE NOT (LAT BETWEEN 20 AND 60 AND LON BETWEEN -130 AND -65 AND SOG >= 0)""",
    "payloads": """SELECT event_id,
          CASE WHEN event_id % 11 = 0 THEN NULL
               WHEN event_id % 7 = 0 THEN '{"visibility": 1200, "cloud_cover": 80.5}'
               ELSE props END::JSON AS forecast,
          CASE WHEN event_id % 13 <> 0 THEN (event_id % 50)::DOUBLE / 10 END AS wave
        FROM events""",
    "trail": """SELECT MMSI, BaseDateTime, SOG, SOG < 3 AND coalesce(before > 8, false) AS dropped
        FROM (SELECT MMSI, BaseDateTime, SOG,
                sum(SOG::DECIMAL(38, 12)) OVER past::DOUBLE / nullif(count(*) OVER past, 0) AS before
              FROM silver
              WINDOW past AS (PARTITION BY MMSI ORDER BY BaseDateTime ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""",
}

_AVG_SOG = _half_up("avg_sog", 4)
_SHOWN = (
    f"{_AVG_SOG} AS avg_sog, round(latest_lat, 6) AS latest_lat, round(latest_lon, 6) AS latest_lon, "
    "round(distance_to_port_km, 3) AS distance_to_port_km"
)
_HIDDEN = "avg_sog, latest_lat, latest_lon, distance_to_port_km"

_CHECK = """SELECT {table} AS table_name, {name} AS check_name, rows_checked, breaks,
  round(breaks / rows_checked, 4) AS break_rate, CASE WHEN breaks = 0 THEN 'OK' ELSE 'BROKEN' END AS status
  FROM (SELECT count(*) AS rows_checked, {breaks} AS breaks FROM {source})"""


def _check(table: str, source: str, name: str, breaks: str) -> str:
    return _CHECK.format(table=_value(table), name=_value(name), breaks=breaks, source=source)


def _null_checks(table: str, source: str, columns: list[str]) -> list[str]:
    return [_check(table, source, f"{c} is null", f"count(*) FILTER (WHERE {c} IS NULL)") for c in columns]


def _range_check(table: str, source: str, column: str, low: float, high: float) -> str:
    return _check(
        table, source, f"{column} out of range", f"count(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
    )


def _count(name: str, source: str, expected: int | str | None = None) -> str:
    target = "NULL::BIGINT" if expected is None else f"{expected}::BIGINT"
    return (
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {target} AS expected, count(*) - {target} AS delta, "
        f"CASE WHEN count(*) > 0 THEN 'OK' ELSE 'EMPTY' END AS status FROM {source}"
    )


def _content(source: str, columns: str) -> str:
    return (
        f"SELECT sum(('0x' || substr(md5(concat_ws('|', {columns})), 1, 8))::BIGINT)::BIGINT AS content FROM {source}"
    )


_REFERENCE_COUNTS = [
    _count("port_zones", "ports", 6),
    _count("geopolitical_risk_zones", "zones", 7),
    _count("maritime_obstacles", "obstacles", 8),
    _count("safe_corridors", "safe_corridors", 8),
    _count("port_alternatives", "alternatives", 12),
]

_SYSTEM, _HUMAN = (text for _, text in fixed.OUTLINE_PROMPT)
_COMPLETE = "topic IS NOT NULL AND audience IS NOT NULL"

FINAL = {
    "refine_positions": "SELECT * FROM silver",
    "parse_and_reject": """SELECT report_id, MMSI, BaseDateTime, parsed_time,
          CASE WHEN parsed_time IS NULL THEN 'bad_time'
               WHEN LAT IS NULL OR LAT < 20 OR LAT > 60 THEN 'lat_out_of_range'
               WHEN LON IS NULL OR LON < -130 OR LON > -65 THEN 'lon_out_of_range'
               WHEN SOG IS NULL OR SOG < 0 OR NOT isfinite(SOG) THEN 'bad_speed' END AS reject_reason
        FROM (SELECT *, try_strptime(BaseDateTime, '%Y-%m-%dT%H:%M:%S') AS parsed_time FROM faulty)""",
    "vessel_profile": f"""SELECT * EXCLUDE (avg_sog, latest_lat, latest_lon), {_AVG_SOG} AS avg_sog,
          round(latest_lat, 6) AS latest_lat, round(latest_lon, 6) AS latest_lon FROM profiles""",
    "fine_speed_profile": f"""SELECT MMSI, {_half_up("avg(SOG)", 6)} AS avg_sog, min(SOG) AS min_sog,
          max(SOG) AS max_sog, count(SOG) AS record_count FROM fine_silver GROUP BY MMSI""",
    "port_distance": """SELECT MMSI, PortZone, round(latest_lat, 6) AS latest_lat, round(latest_lon, 6) AS latest_lon,
          round(distance_to_port_km, 3) AS distance_to_port_km FROM located""",
    "port_by_box": """SELECT MMSI, BaseDateTime, LAT, LON, PortZone, p.port_zone AS box_port
        FROM silver s LEFT JOIN ports p
          ON s.LAT BETWEEN p.lat_min AND p.lat_max AND s.LON BETWEEN p.lon_min AND p.lon_max""",
    "speed_drop_events": """SELECT MMSI, count(*) AS record_count, count(*) FILTER (WHERE dropped) AS speed_drop_events,
          max(BaseDateTime) FILTER (WHERE dropped) AS last_drop_time FROM trail GROUP BY MMSI""",
    "slowdown_episodes": """SELECT MMSI, min(BaseDateTime) AS episode_start, max(BaseDateTime) AS episode_end,
          date_diff('second', min(BaseDateTime), max(BaseDateTime)) / 3600.0::DOUBLE AS hours, count(*) AS readings,
          min(SOG) AS min_sog
        FROM (SELECT *, sum(CASE WHEN earlier >= BaseDateTime - INTERVAL 12 HOUR THEN 0 ELSE 1 END)
                     OVER (PARTITION BY MMSI ORDER BY BaseDateTime) AS episode
              FROM (SELECT MMSI, BaseDateTime, SOG, lag(BaseDateTime) OVER (PARTITION BY MMSI ORDER BY BaseDateTime) AS earlier
                    FROM trail WHERE dropped))
        GROUP BY MMSI, episode""",
    "port_by_wide_box": """SELECT MMSI, BaseDateTime, LAT, LON, area AS watch_area
        FROM (SELECT s.*, p.port_zone || ' ' || r.area AS area,
                pow(sin(radians(p.center_lat - LAT) / 2), 2) + cos(radians(LAT)) * cos(radians(p.center_lat))
                  * pow(sin(radians(p.center_lon - LON) / 2), 2) AS h
              FROM silver s LEFT JOIN (ports p CROSS JOIN (VALUES ('near', 0.1::DOUBLE), ('coast', 3.0::DOUBLE),
                                                                 ('sea', 70.0::DOUBLE)) r(area, reach))
                ON LAT BETWEEN p.center_lat - reach / 4 AND p.center_lat + reach / 4
                   AND (abs(LON - p.center_lon) <= reach OR abs(LON - p.center_lon) >= 360 - reach))
        QUALIFY row_number() OVER (PARTITION BY MMSI, BaseDateTime ORDER BY round(h, 15) NULLS LAST, area) = 1""",
    "vessels_near_obstacles": """SELECT MMSI, VesselName, obstacle_name, obstacle_type, severity, radius_km::DOUBLE AS radius_km,
          round(km, 3) AS distance_km
        FROM (SELECT v.*, o.*, 2 * 6371 * atan2(sqrt(h), sqrt(1 - h)) AS km
              FROM (SELECT s.*, p.port_zone,
                      pow(sin(radians(p.center_lat - latest_lat) / 2), 2) + cos(radians(latest_lat))
                        * cos(radians(p.center_lat)) * pow(sin(radians(p.center_lon - latest_lon) / 2), 2) AS h
                    FROM profiles s CROSS JOIN ports p) v JOIN obstacles o ON o.port_zone = v.port_zone)
        WHERE km <= radius_km""",
    "weather_asof": f"""SELECT MMSI, PortZone, latest_time, obs_time, {', '.join(_W)}, weather_imputed FROM weathered""",
    "weather_by_cell": f"""SELECT MMSI, latest_time, w.obs_time,
          coalesce(w.wind, {_W['wind_speed_kmh']})::DOUBLE AS wind_speed_kmh,
          coalesce(w.wave, {_W['wave_height_m']})::DOUBLE AS wave_height_m, w.gusts IS NULL AS weather_imputed
        FROM (SELECT *, floor(latest_lat / 2)::VARCHAR || ' ' || floor(latest_lon / 2)::VARCHAR AS cell FROM located) l
        LEFT JOIN (SELECT *, floor(center_lat / 2)::VARCHAR || ' ' || floor(center_lon / 2)::VARCHAR AS cell
                   FROM observed WHERE center_lat IS NOT NULL) w
          ON l.cell = w.cell AND l.latest_time >= w.obs_time
        QUALIFY row_number() OVER (PARTITION BY MMSI
          ORDER BY w.obs_time DESC NULLS LAST, w.wind DESC, w.gusts DESC NULLS LAST) = 1""",
    "weather_json": f"""SELECT event_id,
          coalesce((forecast->>'k')::DOUBLE, {_W['wind_speed_kmh']}) AS wind_speed_kmh,
          {_W['wind_gusts_kmh']}::DOUBLE AS wind_gusts_kmh, {_W['temperature_c']}::DOUBLE AS temperature_c,
          {_W['precipitation_mm']}::DOUBLE AS precipitation_mm,
          coalesce((forecast->>'visibility')::DOUBLE, {_W['visibility_m']}) AS visibility_m,
          coalesce((forecast->>'cloud_cover')::DOUBLE, {_W['cloud_cover_pct']}) AS cloud_cover_pct,
          coalesce(wave, {_W['wave_height_m']}::DOUBLE) AS wave_height_m, true AS weather_imputed FROM payloads""",
    "weather_scores": """SELECT MMSI, wind_speed_kmh, wave_height_m, visibility_m, weather_severity_score,
          weather_severity FROM scored""",
    "slowdown_scores": f"""SELECT MMSI, latest_sog, {_AVG_SOG} AS avg_sog, record_count, slowdown_events,
          slowdown_score FROM parts""",
    "proximity_scores": """SELECT MMSI, PortZone, round(distance_to_port_km, 3) AS distance_to_port_km,
          port_proximity_score FROM parts""",
    "vessel_risk": f"SELECT * EXCLUDE ({_HIDDEN}), {_SHOWN} FROM gold",
    "route_profile": """SELECT MMSI, VesselTypeName, port_zone, route_type, geopolitical_risk_score, transit_zones,
          obstacle_risk_score, fuel_cost_per_hour_usd FROM profiled""",
    "routing_costs": """SELECT MMSI, risk_level, delay_risk_score, safety_score, estimated_delay_hours,
          fuel_cost_per_hour_usd, delay_cost_usd, rerouting_distance_nm, rerouting_cost_usd, net_savings_usd
        FROM routing""",
    "routing_decision": """SELECT MMSI, port_zone, risk_level, rerouting_recommended, routing_priority, transit_zones,
          rerouting_recommendation FROM routing""",
    "vessel_routing": f"SELECT * EXCLUDE ({_HIDDEN}), {_SHOWN} FROM routing",
    "route_options": """SELECT MMSI, VesselName, port_zone, risk_level, alternative_port, distance_nm, transit_hours,
          berth_capacity, safety_rating, option_rank
        FROM (SELECT *, row_number() OVER (PARTITION BY MMSI
                ORDER BY list_position(['High', 'Medium'], safety_rating), distance_nm, alternative_port)::INT AS option_rank
              FROM gold JOIN alternatives ON current_port = port_zone WHERE status = 'Open')
        WHERE option_rank <= 2""",
    "corridor_match": """SELECT MMSI, VesselName, route_type, transit_zones, risk_level, corridor_name,
          route_alternative, additional_nm, additional_hours, safety_rating, status, zones_avoided
        FROM routing JOIN coverage USING (transit_zones)""",
    "uncovered_vessels": """SELECT MMSI, VesselName, port_zone, route_type, transit_zones FROM routing r
        WHERE NOT EXISTS (SELECT 1 FROM coverage c WHERE c.transit_zones = r.transit_zones AND c.status = 'Open')""",
    "zones_by_route": "SELECT route_type, zone_name, zone_type, risk_level, risk_score, vessels FROM exposure",
    "critical_zones": """SELECT zone_name, risk_level, risk_score, description, affected_routes,
          sum(vessels)::BIGINT AS vessels_exposed FROM exposure WHERE risk_level = 'Critical' GROUP BY ALL""",
    "kpis": f"""SELECT count(*) AS total_vessels, count(*) FILTER (WHERE risk_level = 'Critical') AS critical_vessels,
          count(*) FILTER (WHERE risk_level = 'High') AS high_vessels,
          {_half_up("sum(delay_risk_score::DECIMAL(18, 1))::DOUBLE / count(*)", 3)} AS avg_risk_score,
          sum(delay_cost_usd) AS total_delay_cost_usd, sum(net_savings_usd) AS total_net_savings_usd,
          count(*) FILTER (WHERE rerouting_recommended) AS vessels_to_reroute,
          coalesce(sum(net_savings_usd) FILTER (WHERE rerouting_recommended), 0) AS rerouting_net_savings_usd
        FROM routing""",
    "risk_distribution": "SELECT risk_level, count(*) AS cnt FROM gold GROUP BY ALL",
    "level_by_priority": "SELECT risk_level, routing_priority, count(*) AS cnt FROM routing GROUP BY ALL",
    "priority_distribution": "SELECT routing_priority, count(*) AS cnt FROM routing GROUP BY ALL",
    "weather_distribution": "SELECT weather_severity, count(*) AS cnt FROM gold GROUP BY ALL",
    "port_summary": f"""SELECT port_zone, count(*) AS vessels,
          {_half_up("sum(delay_risk_score::DECIMAL(18, 1))::DOUBLE / count(*)", 3)} AS avg_delay_risk,
          max(delay_risk_score) AS max_delay_risk, {_half_up("avg(obstacle_risk_score)", 3)} AS avg_obstacle_risk,
          max(obstacle_risk_score) AS max_obstacle_risk, {_half_up("avg(geopolitical_risk_score)", 3)} AS avg_geopolitical_risk,
          max(geopolitical_risk_score) AS max_geopolitical_risk FROM routing GROUP BY port_zone""",
    "port_level_pivot": """SELECT port_zone, count(*) FILTER (WHERE risk_level = 'Critical') AS Critical,
          count(*) FILTER (WHERE risk_level = 'High') AS High, count(*) FILTER (WHERE risk_level = 'Medium') AS Medium,
          count(*) FILTER (WHERE risk_level = 'Low') AS Low FROM gold GROUP BY port_zone""",
    "high_risk_vessels": """SELECT VesselName, port_zone, risk_level, delay_risk_score, safety_score,
          rerouting_recommended FROM routing WHERE risk_level = 'Critical' OR risk_level = 'High'""",
    "reroute_list": """SELECT VesselName, route_type, routing_priority, delay_cost_usd, rerouting_cost_usd,
          net_savings_usd, rerouting_recommendation FROM routing WHERE rerouting_recommended""",
    "top_risk_vessels": """SELECT MMSI, VesselName, port_zone, delay_risk_score, risk_level FROM gold
        ORDER BY delay_risk_score DESC, MMSI LIMIT 20""",
    "risk_pairs": """SELECT MMSI, VesselName, risk_level, wind_speed_kmh, latest_sog, delay_risk_score, delay_cost_usd,
          safety_score FROM routing""",
    "table_audit": " UNION ALL ".join(
        [
            _count("ais_bronze", "reports", "(SELECT count(*) FROM reports)"),
            _count("ais_silver", "silver", "(SELECT count(DISTINCT (MMSI, BaseDateTime)) FROM valid)"),
            _count("vessel_disruption_risk", "gold"),
            _count("vessel_routing_intelligence", "routing"),
            *_REFERENCE_COUNTS,
            _count("ais_rejected", "rejected"),
        ]
    ),
    "column_checks": " UNION ALL ".join(
        [
            _check(
                "ais_bronze",
                "faulty",
                "MMSI, BaseDateTime repeated",
                "count(*) - count(DISTINCT (MMSI, coalesce(BaseDateTime, '')))",
            ),
            *_null_checks("ais_bronze", "faulty", ["BaseDateTime", "SOG"]),
            _range_check("ais_bronze", "faulty", "LAT", 20, 60),
            _range_check("ais_bronze", "faulty", "LON", -130, -65),
            _range_check("ais_bronze", "faulty", "SOG", 0, 102.2),
            _check("vessel_disruption_risk", "gold", "MMSI repeated", "count(*) - count(DISTINCT MMSI)"),
            *_null_checks(
                "vessel_disruption_risk",
                "gold",
                ["slowdown_score", "weather_severity_score", "port_proximity_score", "delay_risk_score", "risk_level"],
            ),
            _range_check("vessel_disruption_risk", "gold", "weather_severity_score", 15, 100),
        ]
    ),
    "render_prompts": f"""SELECT doc_id,
          CASE WHEN {_COMPLETE} THEN {_value(_SYSTEM)} END AS system_text,
          {_message(_HUMAN)} AS human_text,
          CASE WHEN NOT ({_COMPLETE}) THEN 'missing variable: ' || concat_ws(', ',
            CASE WHEN topic IS NULL THEN 'topic' END, CASE WHEN audience IS NULL THEN 'audience' END) END AS error
        FROM (SELECT doc_id, text AS topic, 'readers of ' || source || ' in ' || lang AS audience FROM documents)""",
    "stream_hourly_speed": f"""SELECT PortZone, BaseDateTime AS hour_start, count(*) AS reports,
          {_half_up("sum(SOG::DECIMAL(38, 12))::DOUBLE / count(*)", 4)} AS avg_sog, min(SOG) AS min_sog, max(SOG) AS max_sog
        FROM valid GROUP BY PortZone, BaseDateTime""",
    "stream_latest": """SELECT MMSI, BaseDateTime, LAT, LON, SOG, PortZone FROM valid
        QUALIFY row_number() OVER (PARTITION BY MMSI
          ORDER BY BaseDateTime DESC, SOG DESC, LAT DESC, LON DESC, PortZone DESC) = 1""",
    "stream_dedup": """SELECT MMSI, BaseDateTime, count(DISTINCT (LAT, LON, SOG)) AS candidates, true AS kept_as_reported
        FROM valid GROUP BY MMSI, BaseDateTime""",
    "publish_tables": " UNION ALL ".join(
        f"SELECT a.*, c.content FROM ({count}) a CROSS JOIN ({_content(source, columns)}) c"
        for count, source, columns in zip(
            [
                _count("ais_bronze", "reports"),
                _count("ais_silver", "silver"),
                _count("vessel_disruption_risk", "gold"),
                _count("vessel_routing_intelligence", "routing"),
                *_REFERENCE_COUNTS,
            ],
            ["reports", "silver", "gold", "routing", "ports", "zones", "obstacles", "safe_corridors", "alternatives"],
            [
                "MMSI, VesselType, Status, VesselName, PortZone",
                "MMSI, VesselTypeName, NavStatus, VesselName, PortZone",
                "MMSI, port_zone, weather_severity, risk_level, recommended_action",
                "MMSI, route_type, routing_priority, rerouting_recommendation",
                "port_zone",
                "zone_name, zone_type, risk_level, risk_score, affected_routes",
                "obstacle_name, obstacle_type, port_zone, radius_km, obstacle_risk_score",
                "corridor_name, route_alternative, avoids_zones, additional_nm, status",
                "current_port, alternative_port, distance_nm, safety_rating, status",
            ],
        )
    ),
}

_WITH = "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())

ORACLE: dict[str, str] = {name: f"{_WITH}\n{final}" for name, final in FINAL.items()}
