"""Fixed values shared with published flood-loss practice.

Everything below is data that results depend on: codes, lists, formats and
thresholds. There is no logic in this module.
"""

# --- Fixed values: column layouts -------------------------------------------------
ENGINE_INPUT_COLUMNS = [
    "FltyId",
    "Occ",
    "Cost",
    "Area",
    "NumStories",
    "FoundationType",
    "FirstFloorHt",
    "ContentCost",
    "Latitude",
    "Longitude",
]

FIELD_MAP_KEYS = [
    "UserDefinedFltyId",
    "OCC",
    "Cost",
    "Area",
    "NumStories",
    "FoundationType",
    "FirstFloorHt",
    "ContentCost",
    "BDDF_ID",
    "CDDF_ID",
    "IDDF_ID",
    "InvCost",
    "SOID",
    "Latitude",
    "Longitude",
]

REQUIRED_ENGINE_FIELDS = [
    "UserDefinedFltyId",
    "OCC",
    "Cost",
    "Area",
    "NumStories",
    "FoundationType",
    "FirstFloorHt",
    "Latitude",
    "Longitude",
]

DAMAGE_OUTPUT_COLUMNS = [
    "Depth_Grid",
    "Depth_in_Struc",
    "flExp",
    "SOID",
    "BDDF_ID",
    "BldgDmgPct",
    "BldgLossUSD",
    "ContentCostUSD",
    "CDDF_ID",
    "ContDmgPct",
    "ContentLossUSD",
    "InventoryCostUSD",
    "IDDF_ID",
    "InvDmgPct",
    "InventoryLossUSD",
    "DebrisID",
    "Debris_Fin",
    "Debris_Struc",
    "Debris_Found",
    "Debris_Tot",
    "Restor_Days_Min",
    "Restor_Days_Max",
    "GridName",
]

STRICT_REQUIRED_COLUMNS = [
    "bid",
    "occtype",
    "val_struct",
    "sqft",
    "num_story",
    "found_type",
    "found_ht",
    "latitude",
    "longitude",
]

KEPT_FEATURE_COLUMNS = [
    "bid",
    "occtype",
    "val_struct",
    "sqft",
    "num_story",
    "found_type",
    "found_ht",
    "val_cont",
    "cbfips",
    "pop2pmu65",
    "pop2pmo65",
]

SVI_COLUMNS = [
    "ST_ABBR",
    "COUNTY",
    "FIPS",
    "E_TOTPOP",
    "EP_POV150",
    "EP_HBURD",
    "EP_DISABL",
    "EP_MUNIT",
    "EP_MOBILE",
    "EP_CROWD",
    "EP_NOVEH",
    "EP_UNEMP",
    "EP_NOHSDP",
    "EP_UNINSUR",
    "EP_AGE65",
    "EP_AGE17",
    "EP_SNGPNT",
    "EP_LIMENG",
    "EP_MINRTY",
    "EP_GROUPQ",
]

FINAL_SVI_COLUMNS = [
    "E_TOTPOP",
    "EP_POV150",
    "EP_UNEMP",
    "EP_HBURD",
    "EP_NOHSDP",
    "EP_UNINSUR",
    "EP_AGE65",
    "EP_AGE17",
    "EP_DISABL",
    "EP_SNGPNT",
    "EP_LIMENG",
    "EP_MINRTY",
    "EP_MUNIT",
    "EP_MOBILE",
    "EP_CROWD",
    "EP_NOVEH",
    "EP_GROUPQ",
]

# --- Fixed values: foundation codes ----------------------------------------------
SLAB_WORDS = ["S", "SLAB", "SLAB ON GRADE", "7"]
CRAWL_WORDS = ["C", "CRAWL", "CRAWLSPACE", "CRAWL SPACE", "5", "F", "I", "W"]
BASEMENT_WORDS = ["B", "BASEMENT", "4"]
PIER_WORDS = ["P", "PIER", "PILE", "PILES", "PIER/PILE", "2"]
SLAB_CODE, CRAWL_CODE, BASEMENT_CODE, PIER_CODE = 7, 5, 4, 2

# --- Fixed values: flood class spellings -----------------------------------------
FLOOD_CLASS_SPELLINGS = {
    "riverine": "HazardRiverine",
    "hazardriverine": "HazardRiverine",
    "coastala": "CAE",
    "cae": "CAE",
    "coastalv": "V",
    "v": "V",
    "ve": "V",
}

# --- Fixed values: occupancy lists ------------------------------------------------
CONTENT_HALF = [
    "RES1", "RES2", "RES3A", "RES3B", "RES3C", "RES3D", "RES3E", "RES3F",
    "RES4", "RES5", "RES6", "COM10",
]
CONTENT_FULL = [
    "COM1", "COM2", "COM3", "COM4", "COM5", "COM8", "COM9",
    "IND6", "AGR1", "REL1", "GOV1", "EDU1",
]
CONTENT_ONE_AND_HALF = ["COM6", "COM7", "IND1", "IND2", "IND3", "IND4", "IND5", "GOV2", "EDU2"]
INVENTORY_OCCUPANCIES = ["COM1", "COM2", "IND1", "IND2", "IND3", "IND4", "IND5", "IND6", "AGR1"]
RESIDENTIAL_TYPES = [
    "RES1", "RES2", "RES3A", "RES3B", "RES3C", "RES3D", "RES3E", "RES3F",
    "RES4", "RES5", "RES6",
]

# --- Fixed values: depth-damage curve axis (feet) ---------------------------------
MIN_CURVE_DEPTH, MAX_CURVE_DEPTH = -4, 24
CURVE_COLUMNS = [
    "m4", "m3", "m2", "m1", "p0", "p1", "p2", "p3", "p4", "p5", "p6", "p7", "p8", "p9", "p10",
    "p11", "p12", "p13", "p14", "p15", "p16", "p17", "p18", "p19", "p20", "p21", "p22", "p23", "p24",
]

# --- Fixed values: surge category codes to feet -----------------------------------
SURGE_CODE_FEET = {1: 1.0, 2: 1.0, 3: 3.0, 4: 6.0, 5: 9.0}
DEFAULT_NODATA = -9999.0

# --- Fixed values: missing-row marker and fill defaults ---------------------------
MISSING_ROW_DEPTH = -99999.0
FILL_DEFAULTS = {"val_struct": 0.0, "sqft": 0.0, "num_story": 1.0, "found_ht": 1.0, "val_cont": 0.0}

# --- Fixed values: population model -----------------------------------------------
PERSONS_PER_BUILDING = 2.53
FLAT_SHELTER_RATE = 0.0073
SHELTER_RATE = {"LOW": 0.01, "MEDIUM": 0.03, "HIGH": 0.05}
FEEDING_RATE = {"LOW": 0.03, "MEDIUM": 0.07, "HIGH": 0.12}
IMPACT_RATE_EXAMPLE = {"LOW": 0.10, "MEDIUM": 0.30, "HIGH": 0.60}
ZONES = ["LOW", "MEDIUM", "HIGH"]
ZONE_THRESHOLDS = {
    "surge_low": 4.0,
    "surge_medium": 9.0,
    "surge_high": 12.0,
    "damage_low": 0.0,
    "damage_medium": 15.0,
    "damage_high": 35.0,
}
THRESHOLD_VARIANTS = {
    "default": (4.0, 9.0, 12.0),
    "tight": (3.0, 8.0, 11.0),
    "loose": (5.0, 10.0, 13.0),
    "very_low": (2.0, 6.0, 10.0),
}

# --- Fixed values: US states (name, abbreviation, FIPS) ---------------------------
US_STATES = [
    ("Alabama", "AL", "01"), ("Alaska", "AK", "02"), ("Arizona", "AZ", "04"),
    ("Arkansas", "AR", "05"), ("California", "CA", "06"), ("Colorado", "CO", "08"),
    ("Connecticut", "CT", "09"), ("Delaware", "DE", "10"), ("District Of Columbia", "DC", "11"),
    ("Florida", "FL", "12"), ("Georgia", "GA", "13"), ("Hawaii", "HI", "15"),
    ("Idaho", "ID", "16"), ("Illinois", "IL", "17"), ("Indiana", "IN", "18"),
    ("Iowa", "IA", "19"), ("Kansas", "KS", "20"), ("Kentucky", "KY", "21"),
    ("Louisiana", "LA", "22"), ("Maine", "ME", "23"), ("Maryland", "MD", "24"),
    ("Massachusetts", "MA", "25"), ("Michigan", "MI", "26"), ("Minnesota", "MN", "27"),
    ("Mississippi", "MS", "28"), ("Missouri", "MO", "29"), ("Montana", "MT", "30"),
    ("Nebraska", "NE", "31"), ("Nevada", "NV", "32"), ("New Hampshire", "NH", "33"),
    ("New Jersey", "NJ", "34"), ("New Mexico", "NM", "35"), ("New York", "NY", "36"),
    ("North Carolina", "NC", "37"), ("North Dakota", "ND", "38"), ("Ohio", "OH", "39"),
    ("Oklahoma", "OK", "40"), ("Oregon", "OR", "41"), ("Pennsylvania", "PA", "42"),
    ("Rhode Island", "RI", "44"), ("South Carolina", "SC", "45"), ("South Dakota", "SD", "46"),
    ("Tennessee", "TN", "47"), ("Texas", "TX", "48"), ("Utah", "UT", "49"),
    ("Vermont", "VT", "50"), ("Virginia", "VA", "51"), ("Washington", "WA", "53"),
    ("West Virginia", "WV", "54"), ("Wisconsin", "WI", "55"), ("Wyoming", "WY", "56"),
]
