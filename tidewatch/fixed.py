"""Every constant whose exact text or number decides a result.

Nothing here is derived. Columns, codes, labels, thresholds and weights are
part of the data contract and are kept together so that the rest of the
package holds logic only.
"""

# --- bronze ports: 109 columns by position; the rest are text ---------------
PORT_COLUMNS = """
OID_ World_Port_Index_Number Region_Name Main_Port_Name Alternate_Port_Name UN_LOCODE Country_Code
World_Water_Body IHO_S_130_Sea_Area Sailing_Direction_or_Publication Publication_Link
Standard_Nautical_Chart IHO_S_57_Electronic_Navigational_Chart IHO_S_101_Electronic_Navigational_Chart
Digital_Nautical_Chart Tidal_Range_m Entrance_Width_m Channel_Depth_m Anchorage_Depth_m
Cargo_Pier_Depth_m Oil_Terminal_Depth_m Liquified_Natural_Gas_Terminal_Depth_m Maximum_Vessel_Length_m
Maximum_Vessel_Beam_m Maximum_Vessel_Draft_m Offshore_Maximum_Vessel_Length_m
Offshore_Maximum_Vessel_Beam_m Offshore_Maximum_Vessel_Draft_m Harbor_Size Harbor_Type Harbor_Use
Shelter_Afforded Entrance_Restriction_Tide Entrance_Restriction_Heavy_Swell Entrance_Restriction_Ice
Entrance_Restriction_Other Overhead_Limits Underkeel_Clearance_Management_System Good_Holding_Ground
Turning_Area Port_Security Estimated_Time_of_Arrival_Message Quarantine_Pratique Quarantine_Sanitation
Quarantine_Other Traffic_Separation_Scheme Vessel_Traffic_Service First_Port_of_Entry US_Representative
Pilotage_Compulsory Pilotage_Available Pilotage_Local_Assistance Pilotage_Advisable Tugs_Salvage
Tugs_Assistance Communications_Telephone Communications_Telefax Communications_Radio
Communications_Radiotelephone Communications_Airport Communications_Rail Search_and_Rescue NAVAREA
Facilities_Wharves Facilities_Anchorage Facilities_Dangerous_Cargo_Anchorage Facilities_Med_Mooring
Facilities_Beach_Mooring Facilities_Ice_Mooring Facilities_Ro_Ro Facilities_Solid_Bulk
Facilities_Liquid_Bulk Facilities_Container Facilities_Breakbulk Facilities_Oil_Terminal
Facilities_LNG_Terminal Facilities_Other Medical_Facilities Garbage_Disposal
Chemical_Holding_Tank_Disposal Degaussing Dirty_Ballast_Disposal Cranes_Fixed Cranes_Mobile
Cranes_Floating Cranes_Container Lifts_100_Plus_Tons Lifts_50_100_Tons Lifts_25_49_Tons Lifts_0_24_Tons
Services_Longshoremen Services_Electricity Services_Steam Services_Navigation_Equipment
Services_Electrical_Repair Services_Ice_Breaking Services_Diving Supplies_Provisions
Supplies_Potable_Water Supplies_Fuel_Oil Supplies_Diesel_Oil Supplies_Aviation_Fuel Supplies_Deck
Supplies_Engine Repairs Dry_Dock Railway Latitude Longitude
""".split()

PORT_DOUBLE_COLUMNS = """
OID_ World_Port_Index_Number Tidal_Range_m Entrance_Width_m Channel_Depth_m Anchorage_Depth_m
Cargo_Pier_Depth_m Oil_Terminal_Depth_m Liquified_Natural_Gas_Terminal_Depth_m Maximum_Vessel_Length_m
Maximum_Vessel_Beam_m Maximum_Vessel_Draft_m Offshore_Maximum_Vessel_Length_m
Offshore_Maximum_Vessel_Beam_m Offshore_Maximum_Vessel_Draft_m Latitude Longitude
""".split()

# --- silver ports: which columns are kept, and how each is cleaned ----------
PORT_TEXT_KEPT = [
    "MAIN_PORT_NAME", "ALTERNATE_PORT_NAME", "COUNTRY_CODE", "REGION_NAME", "WORLD_WATER_BODY", "UN_LOCODE",
]
PORT_CATEGORY_KEPT = """
HARBOR_SIZE HARBOR_TYPE HARBOR_USE SHELTER_AFFORDED ENTRANCE_RESTRICTION_TIDE
ENTRANCE_RESTRICTION_HEAVY_SWELL ENTRANCE_RESTRICTION_ICE ENTRANCE_RESTRICTION_OTHER SUPPLIES_PROVISIONS
SUPPLIES_POTABLE_WATER SUPPLIES_FUEL_OIL SUPPLIES_DIESEL_OIL REPAIRS DRY_DOCK COMMUNICATIONS_TELEPHONE
COMMUNICATIONS_TELEFAX COMMUNICATIONS_RADIO COMMUNICATIONS_AIRPORT COMMUNICATIONS_RAIL FACILITIES_WHARVES
FACILITIES_ANCHORAGE FACILITIES_DANGEROUS_CARGO_ANCHORAGE FACILITIES_RO_RO FACILITIES_SOLID_BULK
FACILITIES_LIQUID_BULK FACILITIES_CONTAINER FACILITIES_BREAKBULK FACILITIES_OIL_TERMINAL
FACILITIES_LNG_TERMINAL CRANES_CONTAINER PORT_SECURITY SEARCH_AND_RESCUE MEDICAL_FACILITIES
VESSEL_TRAFFIC_SERVICE TUGS_SALVAGE TUGS_ASSISTANCE FIRST_PORT_OF_ENTRY
""".split()
# output name -> bronze name where they differ
PORT_MEASURE_KEPT = {
    "TIDAL_RANGE_M": "TIDAL_RANGE_M",
    "ENTRANCE_WIDTH_M": "ENTRANCE_WIDTH_M",
    "CHANNEL_DEPTH_M": "CHANNEL_DEPTH_M",
    "ANCHORAGE_DEPTH_M": "ANCHORAGE_DEPTH_M",
    "CARGO_PIER_DEPTH_M": "CARGO_PIER_DEPTH_M",
    "OIL_TERMINAL_DEPTH_M": "OIL_TERMINAL_DEPTH_M",
    "LNG_TERMINAL_DEPTH_M": "LIQUIFIED_NATURAL_GAS_TERMINAL_DEPTH_M",
    "MAXIMUM_VESSEL_LENGTH_M": "MAXIMUM_VESSEL_LENGTH_M",
    "MAXIMUM_VESSEL_BEAM_M": "MAXIMUM_VESSEL_BEAM_M",
    "MAXIMUM_VESSEL_DRAFT_M": "MAXIMUM_VESSEL_DRAFT_M",
}
EMPTY_CATEGORY_WORDS = ["", "Unknown", "N/A", "-"]
EMPTY_STATUS_WORDS = ["None", "-", "", "N/A"]
HARBOR_SIZES = ["Very Small", "Small", "Medium", "Large"]

# --- gold ports --------------------------------------------------------------
GOLD_PORT_CATEGORIES = """
HARBOR_SIZE HARBOR_TYPE HARBOR_USE SHELTER_AFFORDED ENTRANCE_RESTRICTION_TIDE
ENTRANCE_RESTRICTION_HEAVY_SWELL ENTRANCE_RESTRICTION_ICE ENTRANCE_RESTRICTION_OTHER PORT_SECURITY
FIRST_PORT_OF_ENTRY REPAIRS DRY_DOCK COMMUNICATIONS_TELEPHONE COMMUNICATIONS_RADIO COMMUNICATIONS_AIRPORT
COMMUNICATIONS_TELEFAX SUPPLIES_PROVISIONS SUPPLIES_POTABLE_WATER SUPPLIES_FUEL_OIL SUPPLIES_DIESEL_OIL
FACILITIES_CONTAINER FACILITIES_RO_RO FACILITIES_LIQUID_BULK FACILITIES_SOLID_BULK FACILITIES_OIL_TERMINAL
CRANES_CONTAINER
""".split()
GOLD_PORT_MEASURES = """
CHANNEL_DEPTH_M ANCHORAGE_DEPTH_M CARGO_PIER_DEPTH_M OIL_TERMINAL_DEPTH_M MAXIMUM_VESSEL_LENGTH_M
MAXIMUM_VESSEL_BEAM_M MAXIMUM_VESSEL_DRAFT_M
""".split()
SUPPLY_WORDS = ["YES", "LIMITED", "MODERATE", "MAJOR"]
SUPPLY_FLAGS = {
    "HAS_PROVISIONS": "SUPPLIES_PROVISIONS",
    "HAS_POTABLE_WATER": "SUPPLIES_POTABLE_WATER",
    "HAS_FUEL_OIL": "SUPPLIES_FUEL_OIL",
    "HAS_DIESEL_OIL": "SUPPLIES_DIESEL_OIL",
    "HAS_REPAIRS": "REPAIRS",
}
COMMUNICATION_FLAGS = {
    "HAS_RADIO": "COMMUNICATIONS_RADIO",
    "HAS_TELEPHONE": "COMMUNICATIONS_TELEPHONE",
    "HAS_AIRPORT": "COMMUNICATIONS_AIRPORT",
    "HAS_TELEFAX": "COMMUNICATIONS_TELEFAX",
}
FACILITY_FLAGS = {
    "HAS_CONTAINER_FACILITY": "FACILITIES_CONTAINER",
    "HAS_RO_RO_FACILITY": "FACILITIES_RO_RO",
    "HAS_LIQUID_BULK_FACILITY": "FACILITIES_LIQUID_BULK",
    "HAS_SOLID_BULK_FACILITY": "FACILITIES_SOLID_BULK",
    "HAS_OIL_TERMINAL_FACILITY": "FACILITIES_OIL_TERMINAL",
}
RATING_LABELS = ["Excellent", "Good", "Limited", "Unavailable"]

# --- vessels -----------------------------------------------------------------
VESSEL_COLUMNS = [
    "name", "type", "year_built", "gross_tonnage", "deadweight", "length(m)", "beam(m)", "detail_link",
    "departure_date", "last_port_country", "last_port_name", "arrival_date", "destination_port_country",
    "destination_port_name", "destination_port_lat", "destination_port_lon", "reported_status", "report_date",
]
OPTIONAL_VESSEL_COLUMNS = ["name", "type", "destination_port_name", "arrival_date", "reported_status"]
MIN_SNAPSHOT_ROWS = 50
MONTH_DAY_PATTERN = r"[A-Z][a-z]{2}\s+\d{1,2}"
REPORT_STAMP_FORMAT = "yyyy-MM-dd HH:mm"
AGE_LIMITS = {"New": 5, "Mid-life": 15, "Aging": 25}
SIZE_LIMITS = {"Handysize": 40000, "Handymax": 60000, "Panamax": 80000}
ACTIVE_STATUSES = ["Under way", "Sailing"]
ACTIVE_HOURS = 48

# --- seismic events ----------------------------------------------------------
EVENT_COLUMNS = [
    "source_id", "source_catalog", "lastupdate", "time", "flynn_region", "lat", "lon", "depth", "evtype",
    "auth", "mag", "magtype", "unid", "action",
]
EVENT_DOUBLE_COLUMNS = ["lat", "lon", "depth", "mag"]
EVENT_TYPE_LABELS = {
    "ke": "Confirmed Earthquake", "se": "Suspected Earthquake", "sl": "Landslide", "uk": "Unknown",
}
MAGNITUDE_TYPE_LABELS = {
    "ml": "Local Magnitude", "mb": "Body Wave Magnitude", "mw": "Moment Magnitude",
    "ms": "Surface Wave Magnitude", "md": "Duration Magnitude", "mr": "Richter Magnitude",
    "m": "Magnitude (unspecified)",
}
REVISION_WINDOW_HOURS = 24
ALERT_MAGNITUDE = 5.5
STRONGEST_SHOWN = 10
INTENSITY_BUCKETS = {"Minor (<2)": 2, "Light (2-4)": 4, "Moderate (4-6)": 6}
INTENSITY_TOP_BUCKET = "Strong (6+)"

# --- proximity and risk ------------------------------------------------------
EARTH_RADIUS_KM = 6371.0
PROXIMITY_KM = 500.0
ROLLING_ROWS = 7

# --- recommendations ---------------------------------------------------------
TOP_PORTS = 3
RISK_CUTOFF = 90.0
RISK_LOOKBACK_DAYS = 14
SCORE_WEIGHTS = {"supply": 0.30, "infrastructure": 0.25, "seismic": 0.30, "communication": 0.15}
NO_LENGTH_LIMIT = 9999.0
NO_BEAM_LIMIT = 999.0
DISTANCE_DECAY_KM = 2000.0
DEPTH_CLASS_SCORES = {"Deep": 100.0, "Medium": 65.0, "Shallow": 30.0}
HARBOR_SIZE_SCORES = {"Large": 100.0, "Medium": 70.0, "Small": 40.0, "Very Small": 20.0}
NEUTRAL_SCORE = 50.0
SHELTER_BONUS = {"excellent": 30.0, "good": 20.0, "fair": 10.0}
SECURITY_BONUS = 20.0
# first keyword contained in the lower-cased vessel type decides
FACILITY_KEYWORDS = [
    ("container", "HAS_CONTAINER_FACILITY"),
    ("tanker", "HAS_OIL_TERMINAL_FACILITY"),
    ("oil", "HAS_OIL_TERMINAL_FACILITY"),
    ("bulk", "HAS_SOLID_BULK_FACILITY"),
    ("liquid bulk", "HAS_LIQUID_BULK_FACILITY"),
    ("ro-ro", "HAS_RO_RO_FACILITY"),
    ("ro ro", "HAS_RO_RO_FACILITY"),
    ("car carrier", "HAS_RO_RO_FACILITY"),
    ("vehicle", "HAS_RO_RO_FACILITY"),
]

# --- keys, calendar, quality -------------------------------------------------
NULL_KEY_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"
CALENDAR_START = "2025-01-01"
CALENDAR_END = "2027-01-01"  # exclusive
FRESHNESS_HOURS = {"warn": 25, "error": 49}

# --- port name aliases (raw, mapped); repeats are intended --------------------
PORT_ALIASES = [
    ("Dumyat (Damietta)", "Damietta"),
    ("Dumyat (Damietta) Anch.", "Damietta"),
    ("Port Said East", "Port Said"),
    ("Alexandria Anch.", "Alexandria"),
    ("As Suways / Suez Port", "Suez"),
    ("Ain Sukhna Anch.", "Ain Sukhna"),
    ("Singapore Anch. 4", "Singapore"),
    ("Las Palmas Anch.", "Las Palmas"),
    ("Alger (Algiers)", "Algiers"),
    ("Massawa (Mitsiwa)", "Massawa"),
    ("Yanbu al-Bahr", "Yanbu"),
    ("Cochin", "Kochi"),
    ("Nhava Sheva", "Mumbai"),
    ("Colombo Anch.", "Colombo"),
    ("Port Sudan Anch.", "Port Sudan"),
    ("Alger (Algiers)", "Algiers"),
    ("As Suways / Suez Port", "As Suways"),
    ("Alexandria", "Al Iskandariyh (Alexandria)"),
    ("Alexandria Anch.", "Al Iskandariyh (Alexandria)"),
    ("Port Said", "Bur Sa'id"),
    ("Port Said East", "Bur Sa'id"),
    ("Ain Sukhna Anch.", "Ain Sukhna Terminal"),
    ("Ain Sukhna Oil Field Term.", "Ain Sukhna Terminal"),
    ("Ras Shukheir", "Ras Shukhier"),
    ("Safaga", "Safaja"),
    ("Mersa El Hamra Term.", "El Hamra Oil Terminal"),
    ("Massawa (Mitsiwa)", "Massawa"),
    ("Nhava Sheva", "Mumbai"),
    ("Cochin", "Kochi"),
]
