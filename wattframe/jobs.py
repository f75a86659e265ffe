"""Batch jobs over a landing directory and a table directory.

Each job is a function (usable from any driver program) and a sub-command
(``spark-submit wattframe/jobs.py <job> ...`` on a cluster)::

    python -m wattframe.jobs ingest-generation --landing L --tables T [--multiline] [--today D]
    python -m wattframe.jobs ingest-capacity   --landing L --tables T [--multiline] [--today D]
    python -m wattframe.jobs build-reference   --files F --tables T
    python -m wattframe.jobs build-reports     --tables T --out O [--first D --last D]

Table directory layout (Parquet): ``generation`` (partitioned by settlement
day), ``capacity`` (partitioned by publish day), ``plant_id``,
``plant_location``, ``unit_info``, ``fuel_mapping``, ``overlay``; ``daily_generation`` (refreshed
for the touched days), ``generation__ledger`` (days, rows and times of the loads), ``missing_days`` (the gap report) and ``quarantine`` (records that could not
be used). Ingest jobs merge by key: a re-run, a partial day or a late row neither duplicates nor
loses data.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import schemas
from wattframe.operators import clean
from wattframe.operators.dims import UnitDims
from wattframe.operators.nearest import region_points
from wattframe.plans import incremental as inc
from wattframe.plans import views as V
from wattframe.plans.geo import plant_locations
from wattframe.plans.ingest import CAPACITY_PARTITION, merge_capacity, merge_generation
from wattframe.schemas import PARTITION_COLUMN
from wattframe.session import build_session
from wattframe.sources.files import read_csv, read_csv_columns, read_feed_json, table_exists
from wattframe.sources.json_arrays import read_json_array
from wattframe.sources.ledger import loaded_days
from wattframe.sources.sinks import write_days, write_table

# Reference file names expected in the ``--files`` folder of build-reference.
REFERENCE_FILES = {
    "plant_ids": "ids.csv",
    "plant_locations": "plant-locations.csv",
    "unit_info": "bmunits.json",
    "fuel_mapping": "psr_fuel_type_mapping.csv",
    "overlay": "bm_unit_info_overlay.csv",
    "counties": "uk_counties_coordinates.csv",
    "gsps": "uk_gsps_coordinates.csv",
    "city_coordinates": "uk_cities_coordinates.csv",
    "official_cities": "uk_cities_list.csv",
}


def _landed(spark: SparkSession, landing: str, schema: T.StructType, multiline: bool) -> DataFrame:
    if multiline:
        return read_json_array(spark, landing, schema, keep_corrupt=True)
    raw = read_feed_json(spark, landing, schema, keep_corrupt=True)
    return raw.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def ingest_generation(spark: SparkSession, landing: str, tables: str, multiline: bool = False,
                      today: str | None = None) -> list:
    """Landed generation feed -> ``generation`` table by key, daily totals of the touched days, gap report.

    With ``today`` only the days that a run on that date asks for are taken (the initial window,
    the batch day, or everything since the last stored day if runs were missed); else all that
    has landed. Returns the touched days.
    """
    raw = _landed(spark, landing, schemas.GENERATION_FEED, multiline)
    table = f"{tables}/generation"
    if today:
        first, last = inc.generation_window(spark, table, today)
        day = F.to_date(clean.parse_timestamp(F.col("settlementDate")))
        raw = raw.where(day.isNull() | day.between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    days = merge_generation(raw, table, f"{tables}/quarantine")
    inc.refresh_daily(f"{tables}/daily_generation", table, spark, days)
    if days:
        write_table(inc.missing_settlement_dates(loaded_days(spark, table)), f"{tables}/missing_days")
    return days


def ingest_capacity(spark: SparkSession, landing: str, tables: str, multiline: bool = False,
                    today: str | None = None) -> list:
    """Landed capacity publications -> ``capacity`` partitioned by publish day; whole rows are the key.

    With ``today`` only what was published in the run's window is taken.
    """
    raw = _landed(spark, landing, schemas.CAPACITY_FEED, multiline).drop("landed_at")
    table = f"{tables}/capacity"
    if today:
        w = inc.capacity_windows(today)
        start, end = ("batch_from", "batch_to") if table_exists(spark, table) else ("initial_from", "initial_to")
        at = clean.parse_timestamp(F.col("publishTime"))
        raw = raw.where(at.isNull() | ((at >= w[start].cast("timestamp_ntz")) & (at < w[end].cast("timestamp_ntz"))))
    return merge_capacity(raw, table, f"{tables}/quarantine")


def _with_order(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema, with_file_order="ord")


def build_reference(spark: SparkSession, files: str, tables: str) -> None:
    """Reference CSV / JSON files -> the dimension tables, including the
    nearest city, county and supply point of every plant."""
    f = {k: f"{files.rstrip('/')}/{v}" for k, v in REFERENCE_FILES.items()}
    ids = read_csv_columns(spark, f["plant_ids"], {
        "dictionary_id": T.LongType(), "name": T.StringType(),
        "sett_bmu_id": T.StringType(), "ngc_bmu_id": T.StringType()})
    write_table(clean.plant_ids(ids), f"{tables}/plant_id")

    write_table(clean.unit_info(read_json_array(spark, f["unit_info"], schemas.UNIT_INFO_FEED)), f"{tables}/unit_info")

    write_table(read_csv(spark, f["fuel_mapping"], schemas.FUEL_MAPPING), f"{tables}/fuel_mapping")
    write_table(read_csv(spark, f["overlay"], schemas.UNIT_OVERLAY), f"{tables}/overlay")

    city_file = _with_order(spark, f["city_coordinates"], schemas.CITY_COORDINATES).select(
        "ord", "city", F.col("lat").alias("latitude"), F.col("lng").alias("longitude"))
    official = read_csv(spark, f["official_cities"], schemas.CITY_LIST)
    first = clean.keep_first_city(clean.city_union_manual(city_file))
    cities = clean.official_city_filter(first, official)
    counties = _with_order(spark, f["counties"], schemas.COUNTY_POINTS)
    gsps = _with_order(spark, f["gsps"], schemas.GSP_POINTS)
    locations = read_csv_columns(spark, f["plant_locations"], {
        "dictionary_id": T.LongType(), "latitude": T.DoubleType(), "longitude": T.DoubleType()}, others=True)
    located = plant_locations(
        locations,
        region_points(cities, "city", ("source_rank", "ord")),
        region_points(counties, "county", "ord"),
        region_points(gsps, "gsp_name", "ord"),
    )
    write_table(located, f"{tables}/plant_location")


def load_dims(spark: SparkSession, tables: str) -> UnitDims:
    read = spark.read.parquet
    return UnitDims(
        capacity=read(f"{tables}/capacity").drop(CAPACITY_PARTITION),
        plant_id=read(f"{tables}/plant_id"),
        plant_location=read(f"{tables}/plant_location"),
        unit_info=read(f"{tables}/unit_info"),
        fuel_mapping=read(f"{tables}/fuel_mapping"),
        overlay=read(f"{tables}/overlay"),
    )


def build_reports(spark: SparkSession, tables: str, out: str, first: str | None = None,
                  last: str | None = None) -> None:
    """The three reporting tables (and the enrichment).

    With ``first`` and / or ``last`` (a missing side is open) the day-partitioned outputs replace
    only the days computed, and the county rankings are tables of their own, named after the
    range; those over the whole history stay as they are.
    """
    days = (first, last) if first or last else None
    name = f"_{first or 'start'}_{last or 'end'}" if days else ""
    generation = spark.read.parquet(f"{tables}/generation").select(*schemas.GENERATION_COLUMNS)
    dims = load_dims(spark, tables)
    V.write_generation_360_view(generation, dims, f"{out}/generation_capacity_360_view", days)
    daily = V.daily_generation_by_unit(generation, days).withColumn(PARTITION_COLUMN, F.to_date("settlement_date"))
    write_days(daily, f"{out}/generation_by_unit_by_settlement_date")
    write_table(V.county_source_as_written(generation, dims, days), f"{out}/fuel_with_max_daily_gen_by_county{name}")
    write_table(V.county_top_source(generation, dims, days), f"{out}/county_top_source{name}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="wattframe.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("ingest-generation", "ingest-capacity"):
        p = sub.add_parser(name)
        p.add_argument("--landing", required=True)
        p.add_argument("--tables", required=True)
        p.add_argument("--multiline", action="store_true", help="landed files are JSON arrays")
        p.add_argument("--today", help="run date: take only the days that a run on it asks for")
    p = sub.add_parser("build-reference")
    p.add_argument("--files", required=True)
    p.add_argument("--tables", required=True)
    p = sub.add_parser("build-reports")
    p.add_argument("--tables", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--first")
    p.add_argument("--last")
    a = ap.parse_args(argv)
    spark = build_session(app_name=f"wattframe-{a.job}")
    if a.job == "ingest-generation":
        ingest_generation(spark, a.landing, a.tables, a.multiline, a.today)
    elif a.job == "ingest-capacity":
        ingest_capacity(spark, a.landing, a.tables, a.multiline, a.today)
    elif a.job == "build-reference":
        build_reference(spark, a.files, a.tables)
    else:
        build_reports(spark, a.tables, a.out, a.first, a.last)


if __name__ == "__main__":
    main()
