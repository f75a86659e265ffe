"""Cleaning of the raw feeds and reference files (all DataFrame -> DataFrame)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import schemas
from wattframe.constants import MANUAL_CITIES
from wattframe.functions.text import clean_city, explode_list, rename_snake_case, strip_whitespace
from wattframe.functions.time import parse_timestamp, settlement_day
from wattframe.operators.dedup import keep_first
from wattframe.sources.inline import inline_table


def clean_generation(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw generation feed -> typed generation table.

    Timestamps are parsed (bad text -> NULL), the partition day is derived,
    names become snake_case. Rows with every feed field NULL (a ``null``
    response body) are dropped. ``keep`` names bookkeeping columns to carry along.
    """
    feed_cols = schemas.GENERATION_FEED.names
    df = (
        raw.select(*feed_cols, *keep)
        .na.drop(how="all", subset=feed_cols)
        .withColumn("halfHourEndTime", parse_timestamp(F.col("halfHourEndTime")))
        .withColumn("settlementDate", parse_timestamp(F.col("settlementDate")))
        .withColumn("settlement_date_partition", settlement_day(F.col("settlementDate")))
    )
    return rename_snake_case(df)


def clean_capacity(raw: DataFrame) -> DataFrame:
    """Raw capacity feed -> typed capacity table; rows without a unit are dropped."""
    feed_cols = schemas.CAPACITY_FEED.names
    df = (
        raw.select(*feed_cols)
        .withColumn("publishTime", parse_timestamp(F.col("publishTime")))
        .withColumn("effectiveFrom", parse_timestamp(F.col("effectiveFrom")))
        .na.drop(subset=["bmUnit"])
    )
    return rename_snake_case(df)


def plant_ids(raw: DataFrame, keep_empty_tokens: bool = True) -> DataFrame:
    """Plant id dictionary -> one row per (plant, settlement unit id).

    Only the settlement unit list is split; the national-grid id list stays
    whole. Tokens are whitespace-stripped; empty tokens are kept by default.
    """
    typed = raw.select(
        F.col("dictionary_id").cast("long").alias("dictionary_id"),
        F.col("name").cast("string").alias("name"),
        F.col("ngc_bmu_id").cast("string").alias("national_grid_bm_unit_id"),
        F.col("sett_bmu_id").cast("string").alias("_units"),
    )
    return typed.select(
        "dictionary_id",
        "name",
        "national_grid_bm_unit_id",
        explode_list(F.col("_units"), keep_empty=keep_empty_tokens).alias("bm_unit"),
    ).withColumn("bm_unit", strip_whitespace(F.col("bm_unit")))


def unit_info(raw: DataFrame) -> DataFrame:
    """Unit reference feed -> (bm_unit, fuel_type)."""
    return raw.select(F.col("elexonBmUnit").alias("bm_unit"), F.col("fuelType").alias("fuel_type"))


def clean_city_names(cities: DataFrame, city_col: str = "city") -> DataFrame:
    return cities.withColumn(city_col, clean_city(F.col(city_col)))


def manual_cities(spark: SparkSession) -> DataFrame:
    schema = T.StructType([
        T.StructField("ord", T.LongType()),
        T.StructField("city", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
    ])
    rows = [(i, c, lat, lon) for i, (c, lat, lon) in enumerate(MANUAL_CITIES)]
    return inline_table(spark, rows, schema)


def city_union_manual(city_file: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Cleaned city file rows followed by the hand-added cities.

    ``city_file`` has ord (file order), city, latitude, longitude.
    ``source_rank`` 0 = file, 1 = manual; (source_rank, ord) is the order.
    """
    spark = spark or city_file.sparkSession
    file_rows = clean_city_names(city_file.select("ord", "city", "latitude", "longitude")).withColumn(
        "source_rank", F.lit(0)
    )
    manual = manual_cities(spark).withColumn("source_rank", F.lit(1))
    return file_rows.unionByName(manual).select("source_rank", "ord", "city", "latitude", "longitude")


def keep_first_city(cities: DataFrame) -> DataFrame:
    """First row per city in (source_rank, ord) order."""
    return keep_first(cities, ["city"], ["source_rank", "ord"])


def official_city_filter(cities: DataFrame, official: DataFrame) -> DataFrame:
    """Cities whose cleaned name is in the (cleaned) official list."""
    names = clean_city_names(official.select("city")).where(F.col("city").isNotNull())
    return cities.join(names, "city", "left_semi")


def city_reference(city_file: DataFrame, official: DataFrame) -> DataFrame:
    """Clean -> add manual cities -> keep first per city -> official only.

    (source_rank, ord) stays with the city: it decides ties of the nearest city.
    """
    first = keep_first_city(city_union_manual(city_file))
    return official_city_filter(first, official).select("city", "latitude", "longitude", "source_rank", "ord")
