"""Adapters from the driver's test tables to the domain tables.

The test data is a TPC-H-like star schema; these functions re-read it as
generation facts, capacity publications and reference data so every query
of this library can run on it (and grow with it). The same rules are written
in SQL in :mod:`wattframe.oracle` for an independent check.

Unit id rule ``U(k)``: 'I_' || k when k % 20 = 0, 'IE' || k when k % 20 = 1,
otherwise 'T_' || k (covers the single-character wildcard of the
interconnector pattern).
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattframe.constants import FUEL_MAPPING_ROWS
from wattframe.operators.clean import city_reference
from wattframe.operators.dims import UnitDims
from wattframe.operators.nearest import region_points
from wattframe.schemas import FUEL_MAPPING
from wattframe.sources.inline import inline_table


@functools.lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver test table. A DataFrame is an immutable lazy plan, so the
    same file is described once per session and directory instead of being
    listed and its footer read again for every adapter."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unit_id(k: Column) -> Column:
    m = k % 20
    prefix = F.when(m == 0, F.lit("I_")).when(m == 1, F.lit("IE")).otherwise(F.lit("T_"))
    return F.concat(prefix, k.cast("string"))


def _d(x: float) -> Column:
    return F.lit(float(x))


def absent(k: Column, known: Column, key: Column) -> Column:
    """``key`` where ``known``, else an id that no fact has: every row is read, some never match."""
    return F.when(known, key).otherwise(F.concat(F.lit("U_"), k.cast("string")))


def _quantity() -> Column:
    """MWh with six decimals."""
    return F.col("l_quantity") - _d(5.0) + (F.col("l_orderkey") % 1000).cast("double") / _d(1e6)


# --- facts -------------------------------------------------------------------------

def generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly generation facts over lineitem."""
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    period = (F.col("l_orderkey") % 48 + 1).cast("int")
    return li.select(
        unit_id(k).alias("bm_unit"),
        (F.col("l_shipdate") + F.make_dt_interval(mins=period * 30)).alias("half_hour_end_time"),
        F.concat(F.lit("NG_"), k.cast("string")).alias("national_grid_bm_unit_id"),
        _quantity().alias("quantity"),
        F.col("l_shipdate").alias("settlement_date"),
        period.alias("settlement_period"),
        F.to_date("l_shipdate").alias("settlement_date_partition"),
    )


def gapped_generation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generation without any 13th day of a month (holes for gap detection)."""
    g = generation(spark, sf_dir)
    return g.where(F.dayofmonth("settlement_date_partition") != 13)


def as_feed(facts: DataFrame) -> DataFrame:
    """Cleaned facts as raw feed records (camelCase, text timestamps)."""
    return facts.select(
        F.col("bm_unit").alias("bmUnit"), F.date_format("half_hour_end_time", ISO_FORMAT).alias("halfHourEndTime"),
        F.col("national_grid_bm_unit_id").alias("nationalGridBmUnitId"), "quantity",
        F.date_format("settlement_date", ISO_FORMAT).alias("settlementDate"), F.col("settlement_period").alias("settlementPeriod"))


ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def generation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw feed form (camelCase, text timestamps) of :func:`generation`.

    Every 50th order carries an unparseable end time; every 97th order is an
    all-NULL record (an empty response body).
    """
    li = table(spark, sf_dir, "lineitem")
    k = F.col("l_partkey")
    okey = F.col("l_orderkey")
    period = (okey % 48 + 1).cast("int")
    end = F.col("l_shipdate") + F.make_dt_interval(mins=period * 30)
    null_row = okey % 97 == 0

    def unless_null(c: Column) -> Column:
        return F.when(~null_row, c)

    return li.select(
        unless_null(unit_id(k)).alias("bmUnit"),
        unless_null(F.when(okey % 50 == 0, F.lit("bad-date")).otherwise(F.date_format(end, ISO_FORMAT))).alias(
            "halfHourEndTime"
        ),
        unless_null(F.concat(F.lit("NG_"), k.cast("string"))).alias("nationalGridBmUnitId"),
        unless_null(_quantity()).alias("quantity"),
        unless_null(F.date_format("l_shipdate", ISO_FORMAT)).alias("settlementDate"),
        unless_null(period).alias("settlementPeriod"),
    )


# --- dimensions ---------------------------------------------------------------------

_PSR_BY_PART_TYPE = {
    "STANDARD": "Generation",
    "ECONOMY": "Wind Onshore",
    "MEDIUM": "Fossil Gas",
    "SMALL": "Nuclear",
    "LARGE": "Other",
}


def capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capacity publications: versions 0..k % 3; units of parts with k % 3 = 0 have no facts."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    versions = p.select("*", F.explode(F.sequence(F.lit(0), (k % 3).cast("int"))).alias("v"))
    at = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=F.col("v") * 700)
    psr = F.create_map(*[F.lit(x) for kv in _PSR_BY_PART_TYPE.items() for x in kv])
    return versions.select(
        absent(k, k % 3 != 0, unit_id(k)).alias("bm_unit"),
        at.alias("publish_time"),
        at.alias("effective_from"),
        F.try_element_at(psr, F.col("p_type")).alias("psr_type"),
        (F.col("p_retailprice") + F.col("v").cast("double")).alias("installed_capacity"),
    )


def capacity_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw capacity feed: :func:`capacity` as text plus unit-less records
    (parts with k % 9 = 0) that cleaning must drop."""
    cap = capacity(spark, sf_dir).select(
        F.col("bm_unit").alias("bmUnit"),
        F.date_format("publish_time", ISO_FORMAT).alias("publishTime"),
        F.date_format("effective_from", ISO_FORMAT).alias("effectiveFrom"),
        F.col("psr_type").alias("psrType"),
        F.col("installed_capacity").alias("installedCapacity"),
    )
    orphans = table(spark, sf_dir, "part").where(F.col("p_partkey") % 9 == 0).select(
        F.lit(None).cast("string").alias("bmUnit"),
        F.lit("2001-01-01T00:00:00Z").alias("publishTime"),
        F.lit("2001-01-01T00:00:00Z").alias("effectiveFrom"),
        F.lit("Nuclear").alias("psrType"),
        F.col("p_retailprice").alias("installedCapacity"),
    )
    return cap.unionByName(orphans)


def plant_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant id dictionary (already one unit per row); units of parts with k % 5 = 0 have no facts."""
    n_suppliers = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    dict_id = (k % n_suppliers).cast("long")
    return p.select(
        dict_id.alias("dictionary_id"),
        F.concat(F.lit("Plant "), dict_id.cast("string")).alias("name"),
        F.concat(F.lit("NG_"), k.cast("string")).alias("national_grid_bm_unit_id"),
        absent(k, k % 5 != 0, unit_id(k)).alias("bm_unit"),
    )


def plant_id_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw id dictionary with comma lists: 'T_k' plus ', T_k+1' (k % 3 = 0)
    or ',,X ' (k % 3 = 1)."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    first = F.concat(F.lit("T_"), k.cast("string"))
    tail = F.when(k % 3 == 0, F.concat(F.lit(", T_"), (k + 1).cast("string"))).when(k % 3 == 1, F.lit(",,X ")).otherwise(
        F.lit("")
    )
    return p.select(
        k.alias("dictionary_id"),
        F.col("p_name").alias("name"),
        F.concat(first, tail).alias("sett_bmu_id"),
        F.concat(F.lit("N_"), k.cast("string"), F.lit(",N_"), (k + 1).cast("string")).alias("ngc_bmu_id"),
        F.col("p_brand").alias("fuel"),
    )


def plant_location_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant coordinates over supplier; k % 17 = 0 has no latitude, k % 11 = 0 no plant of its id."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    lat = _d(50.0) + ((k * 37) % 900).cast("double") / _d(100.0)
    lon = _d(-6.0) + ((k * 53) % 780).cast("double") / _d(100.0)
    return s.select(
        F.when(k % 11 != 0, k).otherwise(k + 1_000_000_000).alias("dictionary_id"),
        F.when(k % 17 != 0, lat).alias("latitude"),
        lon.alias("longitude"),
        F.col("s_nationkey").alias("nation_key"),
    )


def county_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    return region_points(
        n.select(
            k.alias("ord"),
            F.col("n_name").alias("county"),
            (_d(50.0) + _d(0.35) * k.cast("double")).alias("latitude"),
            (_d(-5.5) + _d(0.28) * ((k * 7) % 25).cast("double")).alias("longitude"),
        ),
        "county",
        "ord",
    )


def gsp_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    return region_points(
        r.select(
            k.alias("ord"),
            F.col("r_name").alias("gsp_name"),
            (_d(51.0) + _d(0.8) * k.cast("double")).alias("latitude"),
            (_d(-4.5) + _d(1.1) * k.cast("double")).alias("longitude"),
        ),
        "gsp_name",
        "ord",
    )


def city_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City coordinates file over customer (file order = c_custkey)."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    m = k % 50
    city = (
        F.when(m == 0, F.lit("Newcastle"))
        .when(m == 1, F.lit("Derry"))
        .when(m == 2, F.lit("Caerdydd"))
        .otherwise(F.concat(F.lit("Town-"), m.cast("string")))
    )
    return c.select(
        k.alias("ord"),
        city.alias("city"),
        (_d(50.0) + _d(0.1) * (k % 83).cast("double")).alias("latitude"),
        (_d(-5.5) + _d(0.1) * (k % 61).cast("double")).alias("longitude"),
    )


def official_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official city list; names over odd suppliers are of no city in the file."""
    s = table(spark, sf_dir, "supplier")
    m = F.col("s_suppkey") % 50
    city = (
        F.when(m % 2 == 1, F.concat(F.lit("Elsewhere-"), m.cast("string")))
        .when(m == 0, F.lit("Newcastle upon Tyne"))
        .when(m == 2, F.lit("Caerdydd"))
        .when(m == 4, F.lit("Swansea"))
        .otherwise(F.concat(F.lit("Town-"), m.cast("string")))
    )
    return s.select(city.alias("city"))


def city_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref = city_reference(city_file(spark, sf_dir), official_cities(spark, sf_dir))
    return region_points(ref, "city", ("source_rank", "ord"))


def plant_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plant coordinates with nearest city, county and supply point."""
    from wattframe.plans.geo import plant_locations

    return plant_locations(
        plant_location_raw(spark, sf_dir),
        city_points(spark, sf_dir),
        county_points(spark, sf_dir),
        gsp_points(spark, sf_dir),
    )


def unit_info_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    m = F.col("p_size") % 5
    fuel = (
        F.when(m == 0, F.lit("CCGT"))
        .when(m == 1, F.lit("WIND"))
        .when(m == 2, F.lit("NUCLEAR"))
        .when(m == 3, F.lit("PS"))
    )
    return p.select(
        absent(k, k % 4 != 0, unit_id(k)).alias("elexonBmUnit"),
        fuel.alias("fuelType"),
        F.col("p_name").alias("leadPartyName"),
    )


def unit_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    from wattframe.operators.clean import unit_info as project

    return project(unit_info_feed(spark, sf_dir))


def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    m = k % 3
    psr = F.when(m == 0, F.lit("Battery Storage")).when(m == 1, F.lit("Wind Offshore")).otherwise(F.lit("Fossil Gas"))
    return p.select(
        absent(k, k % 7 == 0, F.concat(F.lit("T_"), k.cast("string"))).alias("bm_unit"),
        psr.alias("psr_type"),
        _d(51.5).alias("latitude"),
        _d(-1.0).alias("longitude"),
        F.col("p_retailprice").alias("capacity"),
    )


def fuel_mapping(spark: SparkSession, blank_as_null: bool = True) -> DataFrame:
    rows = [tuple((None if (blank_as_null and v == "") else v) for v in r) for r in FUEL_MAPPING_ROWS]
    return inline_table(spark, rows, FUEL_MAPPING)


def unit_dims(spark: SparkSession, sf_dir: str) -> UnitDims:
    return UnitDims(
        capacity=capacity(spark, sf_dir),
        plant_id=plant_id(spark, sf_dir),
        plant_location=plant_location(spark, sf_dir),
        unit_info=unit_info(spark, sf_dir),
        fuel_mapping=fuel_mapping(spark),
        overlay=overlay(spark, sf_dir),
    )


def raw_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    text = (
        F.when(k % 50 == 0, F.lit("bad-date"))
        .when(k % 50 == 1, F.lit(None).cast("string"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    )
    return o.select(k.alias("o_orderkey"), text.alias("raw_text"))


# --- points of very unequal density ----------------------------------------------------

def crowded_points(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """(key, latitude, longitude) over suppliers or customers: three in four lie within a few kilometres of one of two
    towns, the others anywhere between 40 south and 70 north. No two distances are equal but for equal places."""
    k = F.col(key)
    a, b = (k * 7919 % 10007).cast("double") / _d(10007.0), (k * 104729 % 10009).cast("double") / _d(10009.0)
    town = F.when(k % 8 < 4, _d(51.5)).when(k % 8 < 6, _d(-33.9))
    east = F.when(k % 8 < 4, _d(-0.1)).when(k % 8 < 6, _d(151.2))
    return table(spark, sf_dir, name).select(
        key, F.coalesce(town + a * _d(0.05), _d(-40.0) + a * _d(110.0)).alias("latitude"),
        F.coalesce(east + b * _d(0.08), _d(-180.0) + b * _d(360.0)).alias("longitude"))


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text in day-first form, with unreadable and missing ones."""
    text = F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(k % 50 == 0, "31/02/1995 00:00").when(k % 50 != 1, text).alias("raw_text"))
