"""Patterns, labels, thresholds and formats that results depend on."""

# --- fixed values: raw text formats ---
RAW_DATE_FORMAT = "yyyy MMM dd hh:mm:ss a"

# --- fixed values: raw header -> clean column name (the area header ends in a space) ---
RAW_TO_CLEAN = {
    "DR_NO": "id",
    "Date Rptd": "date_reported",
    "DATE OCC": "date_occured",
    "TIME OCC": "time_occured",
    "AREA ": "area_id",
    "AREA NAME": "area_name",
    "Rpt Dist No": "reporting_district_id",
    "Part 1-2": "part_1_2",
    "Crm Cd": "crime_code",
    "Crm Cd Desc": "crime_description",
    "Mocodes": "mocodes",
    "Vict Age": "victim_age",
    "Vict Sex": "victim_sex",
    "Vict Descent": "victim_descent",
    "Premis Cd": "premise_code",
    "Premis Desc": "premise_description",
    "Weapon Used Cd": "weapon_code",
    "Weapon Desc": "weapon_description",
    "Status": "status",
    "Status Desc": "status_description",
    "Crm Cd 1": "crime_code_1",
    "Crm Cd 2": "crime_code_2",
    "Crm Cd 3": "crime_code_3",
    "Crm Cd 4": "crime_code_4",
    "LOCATION": "street_address",
    "Cross Street": "cross_street",
    "LAT": "lat",
    "LON": "lon",
}

# --- fixed values: case status ---
CLOSED_STATUS_PATTERN = "(?i)(AA|AO|JA|JO)"
ONGOING_STATUS = "IC"

# --- fixed values: description pattern -> category, first match wins ---
# The vehicle-theft rule cannot fire (plain theft matches first); it is kept as part of the table.
CATEGORY_RULES = [
    ("(?i)(murder|homicide|manslaughter|kill)", "Violent - Homicide"),
    ("(?i)(rape|sexual|molest|sodomy)", "Violent - Sexual"),
    ("(?i)(robbery|armed|gun|weapon)", "Violent - Robbery"),
    ("(?i)(assault|battery|fight|attack)", "Violent - Assault"),
    ("(?i)(kidnap|abduct)", "Violent - Kidnapping"),
    ("(?i)(burglary|breaking|enter)", "Property - Burglary"),
    ("(?i)(theft|steal|larceny|shoplifting)", "Property - Theft"),
    ("(?i)(vehicle|auto|car|motorcycle).*theft", "Property - Vehicle Theft"),
    ("(?i)(vandalism|damage|destroy|graffiti)", "Property - Vandalism"),
    ("(?i)(arson|fire|burn)", "Property - Arson"),
    ("(?i)(drug|narcotic|marijuana|cocaine|heroin)", "Drug"),
    ("(?i)(fraud|embezzle|forgery|counterfeit)", "White Collar"),
    ("(?i)(domestic|intimate)", "Domestic Violence"),
    ("(?i)(disturbing|peace|noise|trespass)", "Public Order"),
    ("(?i)(drunk|alcohol|dui|dwi)", "Alcohol Related"),
]
CATEGORY_DEFAULT = "Other"

# --- fixed values: category pattern -> severity ---
SEVERITY_RULES = [
    ("(?i)homicide", "Critical"),
    ("(?i)(sexual|kidnapping|robbery)", "High"),
    ("(?i)(assault|burglary|vehicle theft|arson)", "Medium"),
    ("(?i)(theft|vandalism|drug|fraud)", "Low"),
]
SEVERITY_DEFAULT = "Minor"

# --- fixed values: flags ---
DOMESTIC_PATTERN = "(?i)(domestic|intimate|spouse|partner)"
DWELLING_PATTERN = "(?i)(residence|home|house|apartment)"
VIOLENT_PATTERN = "(?i)violent"
PROPERTY_PATTERN = "(?i)property"

# --- fixed values: weapon pattern -> category ---
WEAPON_RULES = [
    ("(?i)(gun|pistol|rifle|firearm|revolver|shotgun)", "Firearm"),
    ("(?i)(knife|blade|machete|sword|razor)", "Knife/Blade"),
    ("(?i)(bat|club|hammer|pipe|stick|rock|bottle)", "Blunt Object"),
    ("(?i)(hands|fist|feet|foot|personal)", "Personal Weapons"),
    ("(?i)(vehicle|car|auto)", "Vehicle"),
    ("(?i)(fire|burn|flame)", "Fire/Incendiary"),
    ("(?i)(drug|poison|chemical)", "Chemical/Poison"),
]

# --- fixed values: victim codes ---
SEX_CODES = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female", "X": "Other", "H": "Other"}
DESCENT_CODES = {
    "A": "Other Asian", "B": "Black", "C": "Chinese", "F": "Filipino", "G": "Guamanian",
    "H": "Hispanic/Latino", "I": "American Indian", "J": "Japanese", "K": "Korean", "L": "Laotian",
    "O": "Other", "P": "Pacific Islander", "S": "Samoan", "U": "Hawaiian", "V": "Vietnamese",
    "W": "White", "X": "Unknown", "Z": "Asian Indian",
}
UNKNOWN = "Unknown"

# --- fixed values: victim age ---
AGE_RANGE = (0, 120)
AGE_BOUNDS = [18, 25, 35, 50, 65]
AGE_LABELS = ["Minor (0-17)", "Young Adult (18-24)", "Adult (25-34)", "Middle Age (35-49)",
              "Older Adult (50-64)", "Senior (65+)"]

# --- fixed values: data quality ---
QUALITY_BOUNDS = [0.25, 0.5, 0.75]
QUALITY_LABELS = ["Poor Quality", "Low Quality", "Medium Quality", "High Quality"]

# --- fixed values: geography ---
CITY_BOUNDS = {"lat": (33.7, 34.4), "lon": (-118.9, -117.6)}
CITY_CENTER = (34.0522, -118.2437)
KM_PER_DEGREE = 111
LONGITUDE_FACTOR = 0.8
ZONE_BOUNDS = [8, 24, 48]
ZONE_LABELS = ["Downtown Core", "Inner City", "Greater LA", "Outer Areas"]
DENSITY_BOUNDS = [500, 2000, 5000, 10000]
DENSITY_LABELS = ["Very Low Density", "Low Density", "Medium Density", "High Density",
                  "Very High Density"]

# --- fixed values: time of day (start hours) and seasons (months) ---
DAY_PARTS = [(6, 12, "Morning"), (12, 18, "Afternoon"), (18, 22, "Evening")]
DAY_PART_DEFAULT = "Night"
SEASONS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8)}
SEASON_DEFAULT = "Fall"
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
WEEKEND_DAYS = (1, 7)

# --- fixed values: business metrics ---
TIER_BOUNDS = [50, 75]
TIER_LABELS = ["Low Performance", "Medium Performance", "High Performance"]
CRIME_DENSITY_BOUNDS = [25, 50, 75, 90]
CRIME_DENSITY_LABELS = ["Very Low Crime", "Low Crime", "Medium Crime", "High Crime", "Very High Crime"]
SPEED_BOUNDS = [1, 7, 30]
SPEED_LABELS = ["Next Day", "Within Week", "Within Month", "Delayed"]
SAME_DAY = "Same Day"
LAG_RANGE = (0, 365)
LAG_DELAYED = 30
TREND_LIMIT = 10
TREND_WEIGHTS = {"Increasing": 0.3, "Decreasing": 0.1}
TREND_WEIGHT_DEFAULT = 0.2
DENSITY_WEIGHT = 0.4
UNRESOLVED_WEIGHT = 0.3
RESOLUTION_DEFAULT = 50
RISK_BOUNDS = [25, 50, 75]
RISK_LABELS = ["Very Low Risk", "Low Risk", "Medium Risk", "High Risk"]

# --- fixed values: live calls ---
ESCALATION_TYPES = ["ASSAULT", "ROBBERY", "WEAPON VIOLATION"]
ESCALATION_REASON = "High risk area + violent incident type"
ESCALATION_MIN_PRIORITY = 3
HIGH_PRIORITY = 2
DEFAULT_PRIORITY = 5
DEFAULT_INCIDENT_TYPE = "UNKNOWN"
UNIT_PREFIXES = {"lapd_units": "LAPD", "lafd_units": "LAFD", "ems_units": "EMS"}
UNIT_CAPACITY = 50
RESPONSE_BASE = 5.0
RESPONSE_SPAN = 10.0
RESPONSE_DEFAULT = 8.5
RESPONSE_FACTOR = 1.5
SPIKE_FACTOR = 2
FAILURE_LIMIT = 0.3
FAILURE_RISKS = ["High Risk", "Medium Risk"]
PROCESSING_VERSION = "1.0.0"
