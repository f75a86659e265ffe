"""Fixed values.

These must equal the values of the original pipeline for identical results.
They are stated here once, in their natural order, and used everywhere else.
"""

# --- fixed values: fuel resolution -------------------------------------------
# LIKE pattern for interconnector units: 'I', then exactly one character, then
# anything ('_' is the single-character wildcard, not a literal underscore).
INTERCONNECTOR_PATTERN = "I_%"
INTERCONNECTOR_LABEL = "Interconnector"
# Capacity PSR types too generic to decide the fuel on their own.
GENERIC_PSR_TYPES = ("Generation", "Other")

# --- fixed values: fuel type mapping (19 rows) --------------------------------
# Columns: new_psr_type, fuel_category, bm_fuel_type, psr_type, source_category.
# '' is a blank cell in the original CSV.
FUEL_MAPPING_COLUMNS = ("new_psr_type", "fuel_category", "bm_fuel_type", "psr_type", "source_category")
FUEL_MAPPING_ROWS = (
    ("CCGT", "Fossil Gas", "CCGT", "", "Fossil"),
    ("Fossil Oil", "Fossil Oil", "OIL", "Fossil Oil", "Fossil"),
    ("Fossil Hard coal", "Fossil Hard coal", "COAL", "Fossil Hard coal", "Fossil"),
    ("Nuclear", "Nuclear", "NUCLEAR", "Nuclear", "Nuclear"),
    ("Wind (Unspecified)", "Wind", "WIND", "", "Clean"),
    ("Pumped storage", "Hydro", "PS", "", "Clean"),
    ("Non pumped storage hydro", "Hydro", "NPSHYD", "", "Clean"),
    ("OCGT", "Fossil Gas", "OCGT", "", "Fossil"),
    ("Other", "Other", "OTHER", "Other", "Other"),
    ("Biomass", "Biomass", "BIOMASS", "Biomass", "Clean"),
    ("Wind Offshore", "Wind", "", "Wind Offshore", "Clean"),
    ("Wind Onshore", "Wind", "", "Wind Onshore", "Clean"),
    ("Non pumped storage hydro", "Hydro", "", "Hydro Run-of-river and poundage", "Clean"),
    ("Non pumped storage hydro", "Hydro", "", "Hydro Water Reservoir", "Clean"),
    ("Fossil Gas", "Fossil Gas", "", "Fossil Gas", "Fossil"),
    ("Generation (Unspecified)", "Other", "", "Generation", "Other"),
    ("Synchronous Condenser", "Synchronous Condenser", "", "", "Clean"),
    ("Battery Storage", "Battery Storage", "", "", "Clean"),
    ("Solar PV", "Solar PV", "", "", "Clean"),
)

# --- fixed values: geography --------------------------------------------------
EARTH_RADIUS_KM = 6371.0

# Whole-value renames applied to city names after '-' is replaced by ' '.
CITY_RENAMES = {
    "Newcastle": "Newcastle upon Tyne",
    "Southend": "Southend on Sea",
    "Derry": "Londonderry",
    "Wrecsam": "Wrexham",
    "Caerdydd": "Cardiff",
}

# City coordinates added by hand after the city file: (city, latitude, longitude).
MANUAL_CITIES = (
    ("Saint Asaph", 53.257999, -3.442000),
    ("Saint Davids", 51.882000, -5.269000),
    ("Swansea", 51.621441, -3.943646),
    ("Isle of Man", 54.2312716, -4.569504),
    ("Douglas", 55.5499978, -3.8499966),
)

# --- fixed values: ingest schedule defaults -----------------------------------
INITIAL_LOAD_DAYS = 11
PUBLISH_DELAY_DAYS = 8
CAPACITY_HISTORY_START = "2023-01-01"

# --- parameters of the registered example queries ------------------------------
# The initial load holds the days before the cutoff; the batch corrects part of the two days before
# it and brings everything after.
MERGE_CUTOFF = "1998-06-01"
MERGE_OVERLAP_DAYS = 2
REPORT_RANGE = ("1995-03-01", "1996-06-30")
# Inclusive; within a month, across years, from the first day of a month with one side open.
REPORT_RANGES = (("1995-03-01", "1996-06-30"), ("1997-02-10", "1997-02-17"), ("1998-06-01", None), (None, "1994-12-31"))
HISTORY_UNITS = ("T_2", "IE41", "T_77")
