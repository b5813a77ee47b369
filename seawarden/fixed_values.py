"""Lookup tables, constants, labels and message formats.

Everything here is a given of the data product, not logic. Results only match when these stay
exactly as they are, so they stand together, in natural order and as plain text.
"""

# --- Fixed values: position codes -------------------------------------------------------------

VESSEL_TYPES = {70: "Cargo", 80: "Tanker", 31: "Tug", 36: "Sailing", 52: "Pleasure"}
VESSEL_TYPE_OTHER = "Other"
VESSEL_TYPE_CODES = (70, 80, 31, 0, 36, 52)

NAV_STATUS = {0: "Under way using engine", 1: "At anchor", 5: "Moored", 7: "Engaged in fishing"}
NAV_STATUS_UNKNOWN = "Unknown"

LAT_RANGE = (20.0, 60.0)
LON_RANGE = (-130.0, -65.0)
MIN_SPEED = 0.0

# --- Fixed values: port zones -----------------------------------------------------------------
# port_zone, center_lat, center_lon, lat_min, lat_max, lon_min, lon_max, description

PORT_ZONES = [
    ("Los Angeles", 33.75, -118.25, 33.5, 34.0, -118.5, -118.0, "Major West Coast container port"),
    ("New York/NJ", 40.67, -74.04, 40.4, 40.9, -74.3, -73.8, "Largest East Coast port complex"),
    ("Houston", 29.35, -94.85, 29.1, 29.6, -95.1, -94.6, "Gulf Coast energy and container port"),
    ("Savannah", 32.08, -81.09, 31.8, 32.4, -81.4, -80.8, "Fast-growing Southeast container port"),
    ("Seattle", 47.25, -122.4, 47.0, 47.5, -122.7, -122.1, "Pacific Northwest gateway port"),
    ("Miami", 25.77, -80.17, 25.5, 26.0, -80.4, -79.9, "Florida cruise and cargo hub"),
]

# --- Fixed values: geopolitical risk zones ----------------------------------------------------
# zone_name, zone_type, risk_level, risk_score, description, affected_routes

GEOPOLITICAL_RISK_ZONES = [
    ("Red Sea / Gulf of Aden", "War Zone", "Critical", 90, "Houthi attacks on commercial shipping. Multiple vessel strikes reported. Major shipping companies rerouting via Cape of Good Hope.", "Trans-Pacific,Trans-Atlantic"),
    ("Strait of Hormuz", "Conflict Zone", "Critical", 85, "Iran-US tensions. Risk of tanker seizure. Critical oil shipping chokepoint.", "Trans-Pacific"),
    ("South China Sea", "Territorial Dispute", "High", 70, "Competing territorial claims. Military confrontations. Navigation restrictions in disputed areas.", "Trans-Pacific"),
    ("Gulf of Guinea", "Piracy Zone", "High", 65, "Persistent piracy threat. Kidnap-for-ransom attacks on commercial vessels. International naval patrols active.", "Trans-Atlantic"),
    ("Black Sea", "Active Conflict", "Critical", 95, "Russia-Ukraine war. Maritime attacks. Grain corridor under threat. Mines in shipping lanes.", "Trans-Atlantic"),
    ("Cuba Restricted Zone", "Restricted Navigation", "Medium", 45, "US-Cuba diplomatic restrictions. Naval exercises. Limited transit windows for commercial vessels.", "Gulf Route"),
    ("Venezuela EEZ", "Sanctioned Waters", "High", 60, "US sanctions on Venezuela. Coast guard interceptions. Risk of vessel detention for sanctions violations.", "Gulf Route"),
]

# --- Fixed values: maritime obstacles ---------------------------------------------------------
# obstacle_name, obstacle_type, port_zone, radius_km, severity, obstacle_risk_score, description

MARITIME_OBSTACLES = [
    ("Storm System Alpha", "Severe Storm", "Los Angeles", 50, "High", 35, "Major Pacific storm system blocking primary approach channel. Vessels advised to hold or divert to San Diego."),
    ("Dense Traffic Zone Bravo", "Congestion", "New York/NJ", 30, "Medium", 20, "Heavy vessel congestion in approach channel. Average 4-hour delay for berthing. Consider alternative timing."),
    ("Ice Field Charlie", "Ice", "Seattle", 80, "High", 30, "Seasonal ice field extending from Puget Sound. Icebreaker escort required for vessels over 5000 DWT."),
    ("Military Exercise Delta", "Restricted Area", "Houston", 60, "Medium", 25, "Navy exercise zone active. Transit prohibited 0600-1800 local time. Rerouting via Galveston channel recommended."),
    ("Oil Spill Echo", "Environmental Hazard", "Savannah", 40, "High", 35, "Crude oil spill from offshore platform. Coast Guard enforcing safety zone. Vessels must use alternative channel."),
    ("Reef Navigation Foxtrot", "Navigation Risk", "Miami", 20, "Medium", 20, "Shallow reef extending into approach channel. Draft restrictions in effect. Deep-draft vessels must use alternate route."),
    ("Houthi Drone Zone", "Conflict Zone", "Trans-Pacific Route", 200, "Critical", 75, "Active drone and missile attacks on vessels in Red Sea corridor. All Trans-Pacific vessels must reroute via Cape of Good Hope. +3400nm additional distance."),
    ("Sanctions Interception Zone", "Restricted Area", "Gulf Route", 100, "High", 50, "US Coast Guard enforcement zone for Venezuela sanctions compliance. Vessels transiting without clearance risk seizure."),
]
OBSTACLE_SCORE_DEFAULT = 10

# --- Fixed values: safe corridors -------------------------------------------------------------
# corridor_name, route_alternative, avoids_zones, additional_nm, additional_hours, safety_rating, status, description

SAFE_CORRIDORS = [
    ("Cape of Good Hope", "South Atlantic Route", "South China Sea, Strait of Hormuz, Red Sea", 3400, 170, "Critical", "Open", "Reroutes vessels around Africa. Avoids all Asian conflict zones. +10-14 days additional transit time. Major carriers already using this route."),
    ("Northern Atlantic Corridor", "Great Circle Route", "Gulf of Guinea, Black Sea", 500, 25, "High", "Open", "Northern route avoids West African piracy and Black Sea conflict. +1-2 days additional transit. Minimal cost impact."),
    ("Florida Straits Deep Water", "Deep Water Channel", "Cuba Restricted Zone, Venezuela EEZ", 200, 10, "High", "Open", "Deep water route through Florida Straits avoids Cuba and Venezuela restricted zones. +10 hours transit. Safe for deep-draft vessels."),
    ("Intracoastal Waterway", "Protected Coastal Route", "Coastal storms, open water hazards", 100, 5, "Medium", "Restricted", "Protected inland waterway. Draft limitations. Small vessels only. Good for tugs and barges."),
    ("Strait of Malacca Alternative", "Sunda Strait Route", "South China Sea disputes", 500, 25, "Medium", "Open", "Alternative to South China Sea via Sunda Strait. Adds transit time but avoids territorial disputes. Moderate piracy risk."),
    ("Panama Canal Shortcut", "Panama Route", "Cape of Good Hope long route", -2000, -100, "High", "Open", "For Trans-Pacific vessels: Panama Canal reduces transit vs Cape route. Canal fees apply but saves 10+ days. Booking required."),
    ("Arctic Northern Passage", "Northern Sea Route", "All conflict zones", -1500, -75, "Variable", "Seasonal", "Seasonal Arctic route. Ice-free July-October only. Saves distance but ice risk. Special insurance required."),
    ("Bab-el-Mandeb Alternative", "Cape Verde Route", "Red Sea, Gulf of Aden", 800, 40, "High", "Open", "West African coastal route avoiding Red Sea entirely. +2 days but no war zone risk."),
]

# Free-text zone names used by corridors -> name in the zone table.
# "All conflict zones" stands for every zone and is expanded from the zone table itself.
ZONE_ALIASES = [
    ("Red Sea", "Red Sea / Gulf of Aden"),
    ("Gulf of Aden", "Red Sea / Gulf of Aden"),
    ("South China Sea disputes", "South China Sea"),
]
ALL_ZONES_ALIAS = "All conflict zones"

# --- Fixed values: port alternatives ----------------------------------------------------------
# current_port, alternative_port, distance_nm, transit_hours, berth_capacity, safety_rating, status, description

PORT_ALTERNATIVES = [
    ("Los Angeles", "San Diego, CA", 120, 6.0, "Large", "High", "Open", "Full service container port. Weather sheltered. Minimal congestion."),
    ("Los Angeles", "Long Beach (Backup)", 5, 0.5, "Large", "Medium", "Open", "Adjacent port. Same weather exposure. Backup berthing only."),
    ("New York/NJ", "Norfolk, VA", 280, 14.0, "Large", "High", "Open", "Naval base port. Excellent shelter. Deep water. Lower congestion."),
    ("New York/NJ", "Boston, MA", 200, 10.0, "Medium", "High", "Open", "Container terminal. Weather sheltered. Limited capacity for large vessels."),
    ("Houston", "Galveston, TX", 50, 2.5, "Medium", "High", "Open", "Nearby port with good shelter. Quick diversion. Oil and container terminals."),
    ("Houston", "New Orleans, LA", 300, 15.0, "Large", "High", "Open", "Major port. River access. Excellent weather protection. Longer diversion."),
    ("Savannah", "Charleston, SC", 90, 4.5, "Large", "High", "Open", "Well-equipped container port. Good shelter. Quick diversion from Savannah."),
    ("Savannah", "Jacksonville, FL", 130, 6.5, "Large", "High", "Open", "Major port. Multiple terminals. Good for longer diversions south."),
    ("Seattle", "Tacoma, WA", 30, 1.5, "Large", "High", "Open", "Adjacent port. Shared harbor. Minimal diversion. Full container terminal."),
    ("Seattle", "Portland, OR", 160, 8.0, "Medium", "Medium", "Restricted", "River port. Draft limitations. Further diversion but good shelter."),
    ("Miami", "Fort Lauderdale, FL", 40, 2.0, "Large", "High", "Open", "Nearby port. Excellent shelter. Quick diversion. Full service."),
    ("Miami", "Freeport, Bahamas", 100, 5.0, "Large", "Medium", "Open", "International port. Good shelter. Customs considerations for US cargo."),
]

# --- Fixed values: routes and fuel ------------------------------------------------------------
# port_zone, route_type, geopolitical_risk_score, transit_zones

ROUTE_PROFILE = [
    ("Los Angeles", "Trans-Pacific", 65, "South China Sea, Strait of Hormuz"),
    ("Seattle", "Trans-Pacific", 65, "South China Sea, Strait of Hormuz"),
    ("New York/NJ", "Trans-Atlantic", 55, "Gulf of Guinea, Black Sea"),
    ("Houston", "Gulf Route", 45, "Cuba Restricted Zone, Venezuela EEZ"),
    ("Miami", "Gulf Route", 45, "Cuba Restricted Zone, Venezuela EEZ"),
    ("Savannah", "Coastal", 20, "None (Domestic Coastal)"),
]
ROUTE_DEFAULT = ("Domestic", 10, "None (Domestic Coastal)")

# vessel_type, fuel_cost_per_hour_usd
FUEL_COST = [("Cargo", 12000), ("Tanker", 15000), ("Tug", 3000), ("Other", 8000)]
FUEL_COST_DEFAULT = 10000

# --- Fixed values: weather defaults, in column order ------------------------------------------

WEATHER_DEFAULTS = {
    "wind_speed_kmh": 15.0,
    "wind_gusts_kmh": 20.0,
    "temperature_c": 20.0,
    "precipitation_mm": 0.0,
    "visibility_m": 10000.0,
    "cloud_cover_pct": 50.0,
    "wave_height_m": 1.5,
}

# Payload field of the weather service -> our column
FORECAST_FIELDS = {
    "wind_speed_10m": "wind_speed_kmh",
    "wind_gusts_10m": "wind_gusts_kmh",
    "temperature_2m": "temperature_c",
    "precipitation": "precipitation_mm",
    "visibility": "visibility_m",
    "cloud_cover": "cloud_cover_pct",
}
MARINE_FIELDS = {"wave_height": "wave_height_m"}

# --- Fixed values: score weights --------------------------------------------------------------

EARTH_RADIUS_KM = 6371.0

DELAY_RISK_WEIGHTS = {"slowdown_score": 0.35, "weather_severity_score": 0.40, "port_proximity_score": 0.25}
SAFETY_WEIGHTS = {
    "delay_risk_score": 0.30,
    "geopolitical_risk_score": 0.35,
    "obstacle_risk_score": 0.20,
    "weather_severity_score": 0.15,
}

# Label bands: lower bound (inclusive) -> label
RISK_LEVEL_BANDS = [(70, "Critical"), (50, "High"), (30, "Medium")]
WEATHER_LABEL_BANDS = [(70, "Severe"), (50, "High"), (30, "Moderate")]
LOWEST_LABEL = "Low"

RISK_LEVELS = ["Critical", "High", "Medium", "Low"]
WEATHER_LABELS = ["Severe", "High", "Moderate", "Low"]
ROUTING_PRIORITIES = ["Safety Critical", "Balanced", "Cost Optimized", "Monitor"]

# --- Fixed values: numbers of the score rules --------------------------------------------------

SLOW_KNOTS, MODERATE_KNOTS = 3, 8
SLOWDOWN_SHARE = 0.3
SLOW_SCORE, SLOW_PER_EVENT = 80, 2.0
MODERATE_SCORE, MODERATE_PER_EVENT = 50, 1.5
CRUISE_SCORE = 20

STORM_WIND_KMH, STORM_WAVE_M = 50, 4
ROUGH_WIND_KMH, ROUGH_WAVE_M = 30, 2
FOG_VISIBILITY_M = 2000
STORM_SCORE, ROUGH_SCORE, FOG_SCORE, CALM_SCORE = 80, 50, 60, 15
ROUGH_PER_KMH, CALM_PER_KMH = 0.3, 0.2

NEAR_KM, AROUND_KM = 10, 30
NEAR_SCORE, AROUND_SCORE, FAR_SCORE = 70, 40, 10
NEAR_PER_KM, AROUND_PER_KM = 3.0, 1.5

# by risk level: hours at its lower bound and per point above it
DELAY_HOURS = {"Critical": (24, 0.5), "High": (8, 0.3), "Medium": (2, 0.1)}
LEAST_DELAY_HOURS = 0.5
LATE_PENALTY_USD = 5000
LATE_FACTORS = {"Critical": 1.5, "High": 0.5}
LEAST_LATE_FACTOR = 0.1
# by risk level: miles, and miles per point of the zone or obstacle score
DETOUR_MILES = {"Critical": (200, 2.0), "High": (100, 1.5), "Medium": (50, 0.0)}
FUEL_SHARE_PER_MILE = 0.05

# Limits in routing decisions
ZONE_SCORE_REROUTE, ZONE_SCORE_SAFETY = 40, 60
OBSTACLE_SCORE_REROUTE, OBSTACLE_SCORE_COST = 25, 20
RISK_SCORE_COST = 30

# A speed drop: slower than the first number after a recent average above the second
DROP_BELOW_KNOTS, DROP_FROM_KNOTS = 3, 8

# --- Fixed values: message formats (a name in braces is a column) -----------------------------

ACTION_TEXT = {
    "Critical": "CRITICAL: Vessel stopped in severe weather near {PortZone}. Immediate rerouting required. Consider alternate berth or hold at safe anchorage. Contact vessel master and port authority.",
    "High": "WARNING: Vessel at {PortZone} experiencing significant delay. Monitor closely. Prepare contingency rerouting plan.",
    "Medium": "MONITOR: Vessel showing moderate risk indicators. Continue standard monitoring.",
    "Low": "NORMAL: No action required.",
}
SUMMARY_TEXT = {
    "Critical": "Vessel {VesselName} at {PortZone} is at CRITICAL risk. Speed: {latest_sog:%.2f} kn. Wind: {wind_speed_kmh:%.2f} km/h. Waves: {wave_height_m:%.1f} m.",
    "High": "Vessel {VesselName} at {PortZone} showing HIGH delay risk due to weather and speed reduction.",
    "other": "No significant disruption detected.",
}
REROUTING_TEXT = {
    "critical_zone": "SAFETY CRITICAL: Immediate rerouting required. Vessel on {route_type} route transits high-risk geopolitical zone. Divert to safe corridor.",
    "critical": "SAFETY FIRST: Reroute vessel from {port_zone} due to severe weather and obstacle proximity.",
    "high_obstacle": "BALANCED: Consider rerouting around obstacle near {port_zone}. Cost-benefit favors diversion.",
    "high": "COST OPTIMIZED: Monitor vessel near {port_zone}. Minor rerouting may reduce delay costs.",
    "other": "No rerouting needed. Continue monitoring.",
}

# --- Fixed values: prompt messages ------------------------------------------------------------

OUTLINE_PROMPT = [
    ("system", "You are an expert educational content creator."),
    (
        "human",
        """
    Create a detailed learning outline on the topic of
            {topic} for {audience}.
            Respond with format of:
            Topic Title:<Title>
            Content Outline:<list of bullet points>
         """,
    ),
]
