"""Fixed values that results depend on: word lists, lookup tables, score weights."""

# --- Fixed values: listing vocabulary --------------------------------------

HOUSE_TYPES = [
    "house",
    "new house land",
    "townhouse",
    "villa",
    "semi-detached",
    "terrace",
    "duplex",
]
FLAT_TYPES = [
    "apartment unit flat",
    "studio",
    "new apartments off the plan",
    "penthouse",
]
PERMITTED_TYPES = [
    "house",
    "new house & land",
    "townhouse",
    "villa",
    "semi-detached",
    "terrace",
    "duplex",
    "apartment / unit / flat",
    "studio",
    "new apartments / off the plan",
    "penthouse",
]
COMMON_TYPES = ["house", "apartment / unit / flat", "townhouse", "villa", "duplex"]

WEEKLY_WORDS = ["pw", "perweek", "weekly", "p/w", "wk", "p.w.", "/wk", "/w", "/week", "p.w"]
MONTHLY_WORDS = [
    "permonth",
    "pm",
    "calendar",
    "monthly",
    "calender",
    "percalendarmonth",
    "percalendermonth",
]

STREET_PREFIXES = [
    "unit",
    "apt",
    "apartment",
    "suite",
    "level",
    "floor",
    "shop",
    "office",
    "rear",
    "front",
    "ground",
    "basement",
    "mezzanine",
    "penthouse",
    "villa",
    "townhouse",
    "house",
    "home",
    "property",
    "building",
]

# --- Fixed values: suburb name repairs before census joins ------------------

SUBURB_REPAIRS = {
    "brunswick west": "west brunswick",
    "brunswick east": "east brunswick",
    "st kilda east": "east st kilda",
    "st kilda west": "west st kilda",
    "hawthorn east": "east hawthorn",
    "east bendigo": "bendigo east",
    "mount martha": "mt martha",
    "mount eliza": "mt eliza",
    "wangaratta": "wanagaratta",
    "newcomb": "newcombe",
}

# --- Fixed values: month names ---------------------------------------------

MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# --- Fixed values: census sheets --------------------------------------------

DWELLING_TOTALS = [
    "Total occupied private dwellings",
    "Unoccupied private dwellings",
    "Total private dwellings",
    "Dwelling structure not stated",
]
INCOME_BANDS = [
    "15-19",
    "20-24",
    "25-34",
    "35-44",
    "45-54",
    "55-64",
    "65-74",
    "75-84",
    "85+",
    "Total",
]
EDUCATION_BANDS = ["15-24", "25-34", "35-44", "45-54", "55-64", "65-74", "75-84", "85+", "Total"]
# "Proffesionals" is spelled this way in the published column set.
JOB_BANDS = [
    "Managers",
    "Proffesionals",
    "Trades workers",
    "Community workers",
    "Administrative Workers",
    "Sales Workers",
    "Drivers",
    "Labourers",
    "Not Stated",
    "Total",
]
HOUSEHOLD_BANDS = ["Family Households", "Non-family Households", "Total"]
RENT_SHEETS = [
    "1 bedroom flat",
    "2 bedroom flat",
    "3 bedroom flat",
    "2 bedroom house",
    "3 bedroom house",
    "4 bedroom house",
]

# --- Fixed values: economic indicators --------------------------------------

INDICATOR_NAMES = {
    "CPI (%/y)": "cpi",
    "WPI (%/y)": "wpi",
    "PPI, Final Demand (%/y)": "ppi",
    "Unemployment rate (%)": "unemployment_rate",
    "SFD (%/y)": "sfd",
    "GSP quarterly components (%/y)": "gsp",
    "State final demand (%/y)": "state_final_demand",
    "Household consumption (pp/y)": "household_consumption",
    "Dwelling investment (pp/y)": "dwelling_investment",
    "Business investment (pp/y)": "business_investment",
    "Government spending (pp/y)": "government_spending",
    "Population (%/y)": "population",
    "Natural increase (pp/y)": "natural_increase",
    "Net overseas migration (pp/y)": "net_overseas_migration",
    "Net interstate migration (pp/y)": "net_interstate_migration",
    "Mortgage rates (%)": "mortgage_rates",
    "Savings rates (%)": "savings_rates",
    "Cash rate (%)": "cash_rate",
}
# Value columns (0-based cell positions) taken from each published web table.
TABLE_COLUMNS = {
    "unemployment_rate": [1],
    "interest_rates": [1, 2, 3],
    "price_data": [1, 2, 3],
    "economic_activity": [2, 3],
    "population": [1, 2, 3, 4],
    "investment": [1, 2, 3, 4, 5],
}

# --- Fixed values: limits of forecast indicators -------------------------------

# Names that hold one of the words stay within the limits (percent); the first match counts.
FORECAST_LIMITS = [
    (["rate", "cpi", "wpi"], -5.0, 10.0),
    (["gsp", "growth"], -10.0, 15.0),
]
FORECAST_SPREAD = 2.0
EXTREME_QUARTERS = [(2020, 2), (2020, 3)]

# --- Fixed values: schools ---------------------------------------------------

SCHOOL_COLUMNS = [
    "Address_Line_1",
    "Address_Line_2",
    "Address_Postcode",
    "Address_State",
    "Address_Town",
    "Education_Sector",
    "Entity_Type",
    "Full_Phone_No",
    "LGA_ID",
    "LGA_Name",
    "Postal_Address_Line_1",
    "Postal_Address_Line_2",
    "Postal_Postcode",
    "Postal_State",
    "Postal_Town",
    "School_Name",
    "School_No",
    "School_Type",
    "X",
    "Y",
    "Area",
    "LGA_TYPE",
    "Region",
    "School_Status",
]
SCHOOL_RENAMES = {"AREA_Name": "Area", "Region_Name": "Region"}
UNRANKED_SECONDARY_RANK = 101

# Travel bands tried, in order, when a band has no school of its own.
SCHOOL_FALLBACK = {
    "walking_5min": ["walking_10min", "walking_15min", "driving_5min", "driving_10min", "driving_15min"],
    "walking_10min": ["walking_15min", "driving_5min", "driving_10min", "driving_15min"],
    "walking_15min": ["driving_5min", "driving_10min", "driving_15min"],
    "driving_5min": ["driving_10min", "driving_15min"],
    "driving_10min": ["driving_5min", "driving_15min"],
    "driving_15min": ["driving_10min", "driving_5min"],
}
SCHOOL_TARGETS = ["walking_5min", "walking_10min", "driving_5min", "driving_10min", "driving_15min"]
SCHOOL_FIELDS = ["best_school_name", "best_school_coord", "best_score", "best_dist_km"]
MISSING_SCHOOL_SCORE = 3e-8

# --- Fixed values: distance models -------------------------------------------

EARTH_RADIUS_KM = 6371.0088
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563

# --- Fixed values: liveability ------------------------------------------------

_BANDS = [f"{mode}_{m}min" for mode in ("driving", "walking") for m in (5, 10, 15)]


def _amenities(prefix: str, names: list[str]) -> list[str]:
    return [prefix + n for n in names]


_WORK = ["coworking_space", "events_venue", "meeting_point", "conference_centre", "events_centre"]
_EAT = [
    "restaurant",
    "restaurant; cafe",
    "restaurant;cafe",
    "cafe",
    "cafe;deli",
    "cafe;bar",
    "fast_food",
    "bar",
    "biergarten",
    "nightclub",
    "music_venue",
]
_HEALTH = [
    "healthcare",
    "clinic",
    "hospital",
    "doctors",
    "pharmacy",
    "veterinary",
    "social_facility",
    "nursing_home",
]
_TRANSPORT = [
    "bus_station",
    "bus_station;shelter",
    "car_rental",
    "taxi",
    "motorcycle_parking",
    "charging_station",
    "courier",
]
_SAFETY = ["police", "fire_station", "social_facility"]
_SERVICES = [
    "atm",
    "bank",
    "retail",
    "parcel_locker",
    "pharmacy",
    "food_court",
    "community_centre",
    "private parking_space",
    "waste_disposal",
]
_DETRACT = ["prison", "brothel", "waste_transfer_station", "waste_disposal", "diused:fuel"]

PILLARS = {
    "W": {"count": _amenities("count_", _WORK), "distance": _amenities("min_dist_", _WORK)},
    "E": {
        "count": _amenities("count_", _EAT + ["cinema", "juice_bar"]),
        "distance": _amenities("min_dist_", _EAT),
    },
    "C": {"inverse": ["income_rent_ratio"]},
    "Ed": {
        "count": ["count_college", "count_library", "count_student_accommodation"]
        + [f"n_schools_{b}" for b in _BANDS],
        "direct": [f"best_score_{b}" for b in _BANDS],
        "distance": [f"best_dist_km_{b}" for b in _BANDS],
    },
    "H": {"count": _amenities("count_", _HEALTH), "distance": _amenities("min_dist_", _HEALTH)},
    "T": {
        "count": _amenities("count_", _TRANSPORT),
        "distance": _amenities("min_dist_", _TRANSPORT)
        + ["min_route_dist_m", "min_route_dist_m_imputed"],
        "inverse": ["min_route_dur_s", "min_route_dur_s_imputed"],
    },
    "S": {"count": _amenities("count_", _SAFETY), "distance": _amenities("min_dist_", _SAFETY)},
    "Sv": {"count": _amenities("count_", _SERVICES), "distance": _amenities("min_dist_", _SERVICES)},
    "N": {"count": _amenities("count_", _DETRACT), "distance": _amenities("min_dist_", _DETRACT)},
}
PILLAR_WEIGHTS = {
    "W": 0.15,
    "E": 0.12,
    "C": 0.18,
    "Ed": 0.12,
    "H": 0.12,
    "T": 0.15,
    "S": 0.10,
    "Sv": 0.08,
    "N": -0.10,
}
