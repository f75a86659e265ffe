"""Explicit schemas of the raw feeds, reference files and domain tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw half-hourly generation feed (one JSON object per unit and period).
GENERATION_FEED = T.StructType([
    T.StructField("bmUnit", T.StringType()),
    T.StructField("halfHourEndTime", T.StringType()),
    T.StructField("nationalGridBmUnitId", T.StringType()),
    T.StructField("quantity", T.DoubleType()),
    T.StructField("settlementDate", T.StringType()),
    T.StructField("settlementPeriod", T.IntegerType()),
])

# Raw installed-capacity publications.
CAPACITY_FEED = T.StructType([
    T.StructField("bmUnit", T.StringType()),
    T.StructField("publishTime", T.StringType()),
    T.StructField("effectiveFrom", T.StringType()),
    T.StructField("psrType", T.StringType()),
    T.StructField("installedCapacity", T.DoubleType()),
])

# Unit reference feed: only these two fields are used, others are ignored.
UNIT_INFO_FEED = T.StructType([
    T.StructField("elexonBmUnit", T.StringType()),
    T.StructField("fuelType", T.StringType()),
])

# Plant id dictionary CSV (used columns; the file has more).
PLANT_ID_RAW = T.StructType([
    T.StructField("dictionary_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("sett_bmu_id", T.StringType()),
    T.StructField("ngc_bmu_id", T.StringType()),
])

PLANT_LOCATION_RAW = T.StructType([
    T.StructField("dictionary_id", T.LongType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

FUEL_MAPPING = T.StructType([
    T.StructField("new_psr_type", T.StringType()),
    T.StructField("fuel_category", T.StringType()),
    T.StructField("bm_fuel_type", T.StringType()),
    T.StructField("psr_type", T.StringType()),
    T.StructField("source_category", T.StringType()),
])

UNIT_OVERLAY = T.StructType([
    T.StructField("bm_unit", T.StringType()),
    T.StructField("psr_type", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("capacity", T.DoubleType()),
])

COUNTY_POINTS = T.StructType([
    T.StructField("county", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

GSP_POINTS = T.StructType([
    T.StructField("gsp", T.StringType()),
    T.StructField("gsp_name", T.StringType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
])

CITY_COORDINATES = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("lng", T.DoubleType()),
])

CITY_LIST = T.StructType([T.StructField("city", T.StringType())])

# Domain tables (snake_case, typed).
GENERATION_COLUMNS = (
    "bm_unit",
    "half_hour_end_time",
    "national_grid_bm_unit_id",
    "quantity",
    "settlement_date",
    "settlement_period",
    "settlement_date_partition",
)
CAPACITY_COLUMNS = ("bm_unit", "publish_time", "effective_from", "psr_type", "installed_capacity")
PARTITION_COLUMN = "settlement_date_partition"
GENERATION_KEY = ("bm_unit", "settlement_date", "settlement_period")
