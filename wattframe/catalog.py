"""Registry of every query, runnable on the driver's test tables.

Each entry takes (spark, sf_dir) and returns a DataFrame built from the
whole test tables through the adapters of :mod:`wattframe.fixtures`.
Write-path entries write into a fresh folder below the session's shared
checkpoint folder and read the result back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import fixtures as fx
from wattframe.constants import FUEL_MAPPING_ROWS, HISTORY_UNITS, MERGE_CUTOFF, MERGE_OVERLAP_DAYS, REPORT_RANGE, REPORT_RANGES
from wattframe.functions.geo import haversine_km
from wattframe.functions.text import rename_snake_case
from wattframe.functions.time import format_timestamp, parse_timestamp, settlement_day
from wattframe.operators import clean
from wattframe.operators.dims import capacity_as_of, capacity_as_of_sweep, capacity_latest, unit_dim
from wattframe.operators.nearest import nearest_region, region_points
from wattframe.plans import cumulative as C
from wattframe.plans import incremental as inc
from wattframe.plans import rankings as R
from wattframe.plans import sql as S
from wattframe.plans import views as V
from wattframe.schemas import CAPACITY_FEED, FUEL_MAPPING, GENERATION_COLUMNS, GENERATION_FEED, PARTITION_COLUMN, UNIT_INFO_FEED
from wattframe.session import scratch_dir, shuffles_released
from wattframe.sources import buckets as B
from wattframe.sources.files import read_csv, read_feed_json, stored_days, table_files
from wattframe.sources.inline import inline_table
from wattframe.sources.json_arrays import read_json_array
from wattframe.sources.ledger import loaded_days
from wattframe.sources.sinks import write_csv, write_days, write_json_arrays, write_json_lines, write_table
from wattframe.streaming import start_generation_ingest

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Double sums rounded for the comparison: their last bits depend on the order of addition."""
    return df.withColumns({c: F.round(c, 6) for c in cols})


# --- aggregates and enrichment ---------------------------------------------------------

def _daily(spark, sf):
    return _rounded(V.daily_generation_by_unit(fx.generation(spark, sf)), "daily_generation_mwh")


def _view360(spark, sf):
    return V.generation_360_view(fx.generation(spark, sf), fx.unit_dims(spark, sf))


def _view360_literal(spark, sf):
    return V.generation_360_view_literal(fx.generation(spark, sf), fx.unit_dims(spark, sf))


def _view360_latest(spark, sf):
    return V.generation_360_view_latest(fx.generation(spark, sf), fx.unit_dims(spark, sf))


def _by_county(spark, sf):
    return _rounded(V.generation_by_county_source(fx.generation(spark, sf), fx.unit_dims(spark, sf)), "total_daily_generation_mwh")


def _county_as_written(spark, sf):
    return V.county_source_as_written(fx.generation(spark, sf), fx.unit_dims(spark, sf))


def _county_top(spark, sf):
    return _rounded(V.county_top_source(fx.generation(spark, sf), fx.unit_dims(spark, sf)), "total_daily_generation_mwh")


def _county_top_in_range(spark, sf):
    return _rounded(V.county_top_source(fx.generation(spark, sf), fx.unit_dims(spark, sf), REPORT_RANGE), "total_daily_generation_mwh")


def _fuel_county(spark, sf):
    return _rounded(V.total_by_fuel_county(fx.generation(spark, sf), fx.unit_dims(spark, sf)), "total_generation_mwh")


def _fuel_county_rollup(spark, sf):
    return _rounded(V.total_by_fuel_county_rollup(fx.generation(spark, sf), fx.unit_dims(spark, sf)), "total_generation_mwh")


def _avg_period(spark, sf):
    return _rounded(V.avg_by_settlement_period(fx.generation(spark, sf)), "avg_quantity_mwh", "total_quantity_mwh")


def _interconnector(spark, sf):
    return V.interconnector_flag(fx.generation(spark, sf))


def _fuel_resolution(spark, sf):
    return V.fuel_resolution(fx.generation(spark, sf), fx.unit_dims(spark, sf))


def _coordinate_fallback(spark, sf):
    return V.coordinate_fallback(fx.generation(spark, sf), fx.unit_dims(spark, sf))


def _capacity_latest(spark, sf):
    return capacity_latest(fx.capacity(spark, sf))


def _capacity_as_of(spark, sf):
    return capacity_as_of(V.unit_days(fx.generation(spark, sf)), fx.capacity(spark, sf))


def _capacity_as_of_sweep(spark, sf):
    return capacity_as_of_sweep(V.unit_days(fx.generation(spark, sf)), fx.capacity(spark, sf))


# --- the same reports as Spark SQL over registered views ------------------------------

def _sql_query(statement, *sums):
    def run(spark, sf):
        S.register_views(fx.generation(spark, sf), fx.unit_dims(spark, sf), prefix="wf_")
        return _rounded(spark.sql(statement("wf_")), *sums)

    return run


def _view360_sql(spark, sf):
    """The statement over catalog tables: external locations of the facts, by day, and of the unit profile."""
    paths = {n: scratch_dir(spark, f"sql-{n}") for n in ("generation", "unit_profile")}
    facts = fx.generation(spark, sf)
    write_days(facts, paths["generation"])
    write_table(unit_dim(fx.unit_dims(spark, sf)), paths["unit_profile"])
    S.create_day_table(spark, "wt_generation", paths["generation"], facts.schema, replace=True)
    S.register_days(spark, "wt_generation", stored_days(spark, paths["generation"], PARTITION_COLUMN))
    S.create_table(spark, "wt_unit_profile", paths["unit_profile"])
    return spark.sql(S.generation_360_view_sql("wt_"))


def _view360_clustered(spark, sf):
    """Facts by month and bucket of units, the profile in the same buckets: joined without an exchange."""
    paths = {n: scratch_dir(spark, f"clustered-{n}") for n in ("generation", "unit-profile")}
    facts = fx.generation(spark, sf)
    n = B.buckets_for(table_files(spark, f"{sf}/lineitem.parquet").agg(F.sum("length")).first()[0])
    B.write_clustered(facts, "wc_generation", paths["generation"], n)
    B.write_bucketed(unit_dim(fx.unit_dims(spark, sf)), "wc_unit_profile", paths["unit-profile"], n)
    return V.generation_360_view_clustered(
        B.clustered(spark, "wc_generation").select(*facts.columns), spark.table("wc_unit_profile"), B.hot_units(spark, "wc_generation"))


def _unit_history(spark, sf):
    path = scratch_dir(spark, "history")
    write_days(fx.generation(spark, sf), path)
    return V.unit_history(spark.read.parquet(path), HISTORY_UNITS).select(*GENERATION_COLUMNS)


def _fuel_resolution_sql(spark, sf):
    S.register_views(fx.generation(spark, sf), fx.unit_dims(spark, sf), prefix="wf_")
    S.create_functions(spark, "wf_")
    return spark.sql(S.fuel_resolution_sql("wf_"))


def _haversine_sql(spark, sf):
    fx.plant_location_raw(spark, sf).createOrReplaceTempView("wf_sites")
    fx.county_points(spark, sf).createOrReplaceTempView("wf_counties")
    S.create_functions(spark, "wf_")
    return spark.sql("""SELECT dictionary_id, c.name AS county, round(wf_haversine_km(s.latitude, s.longitude, c.lat, c.lon), 6) AS distance_km
        FROM wf_sites AS s LEFT JOIN wf_counties AS c ON c.ord.k0 = s.nation_key""")


# --- cleaning and parsing -------------------------------------------------------------

def _clean_generation(spark, sf):
    return clean.clean_generation(fx.generation_feed(spark, sf))


def _json_roundtrip(spark, sf):
    path = scratch_dir(spark, "landing-json")
    write_json_lines(fx.generation_feed(spark, sf), path)
    return clean.clean_generation(read_feed_json(spark, path, GENERATION_FEED))


def _json_array(spark, sf):
    """The feed landed as responses: each file is one line that holds one JSON array (one file of a small feed)."""
    path = scratch_dir(spark, "landing-array")
    write_json_arrays(fx.generation_feed(spark, sf), path)
    return clean.clean_generation(read_json_array(spark, path, GENERATION_FEED))


def _stream_ingest(spark, sf):
    """Two available-now runs of one stream into a table: the facts, then corrections of old days."""
    landing, table, ckpt = (scratch_dir(spark, n) for n in ("stream-landing", "stream-table", "stream-ckpt"))
    loads = _loads(spark, sf)
    for load in (1, 2):  # a landed file may hold a key several times, and all that a load holds of it
        feed = fx.as_feed(loads.where(F.col("load_id") == load))
        feed.repartition("bmUnit", "settlementDate", "settlementPeriod").write.mode("append").json(landing)
        start_generation_ingest(spark, landing, table, ckpt).awaitTermination()
    return spark.read.parquet(table).select(*GENERATION_COLUMNS)


def _stream_ingest_repeats(spark, sf):
    """The same two runs with every record three times in its file; repeats are dropped in front of the merge."""
    landing, table, ckpt = (scratch_dir(spark, n) for n in ("stream-landing", "stream-table", "stream-ckpt"))
    loads = _loads(spark, sf).repartition("bm_unit", "settlement_date", "settlement_period")
    for load in (1, 2):  # dealt out and put into text once, then repeated; files of repeats are small when compressed
        feed = fx.as_feed(loads.where(F.col("load_id") == load))
        copies = feed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).select(*feed.columns)
        with shuffles_released(spark):
            copies.write.mode("append").option("compression", "gzip").json(landing)
        start_generation_ingest(spark, landing, table, ckpt, repeats_within="1 hour").awaitTermination()
    return spark.read.parquet(table).select(*GENERATION_COLUMNS)


def _capacity_clean(spark, sf):
    path = scratch_dir(spark, "capacity-json")
    write_json_lines(fx.capacity_feed(spark, sf), path)
    return clean.clean_capacity(read_feed_json(spark, path, CAPACITY_FEED))


def _capacity_publish_windows(spark, sf):
    """Publications that the initial and the daily run on the day after the last one ask for."""
    cap = fx.capacity(spark, sf)
    w = inc.capacity_windows(F.date_add(F.to_date(cap.agg(F.max("publish_time")).scalar()), 1), F.lit("1990-01-01").cast("date"))
    initial = inc.in_publish_window(cap, w["initial_from"], w["initial_to"]).withColumn("ingest_window", F.lit("initial"))
    batch = inc.in_publish_window(cap, w["batch_from"], w["batch_to"]).withColumn("ingest_window", F.lit("batch"))
    return initial.unionByName(batch)


def _parse_timestamps(spark, sf):
    raw = fx.raw_timestamps(spark, sf)
    ts = parse_timestamp(F.col("raw_text"))
    return raw.select("o_orderkey", "raw_text", ts.alias("parsed_ts"), settlement_day(ts).alias("parsed_day"))


def _timestamp_formats(spark, sf):
    raw = fx.dated_orders(spark, sf)
    ts = parse_timestamp(F.col("raw_text"), "dd/MM/yyyy HH:mm")
    return raw.select("o_orderkey", "raw_text", ts.alias("parsed_ts"), format_timestamp(ts, "yyyyMMdd").alias("file_stamp"),
                      format_timestamp(settlement_day(ts), "yyyy/MM/dd").alias("day_folder"))


def _snake_case(spark, sf):
    return rename_snake_case(fx.generation_feed(spark, sf))


def _unit_info_projection(spark, sf):
    path = scratch_dir(spark, "unit-info-json")
    write_json_lines(fx.unit_info_feed(spark, sf), path)
    return clean.unit_info(read_feed_json(spark, path, UNIT_INFO_FEED))


def _plant_id_explode(spark, sf):
    return clean.plant_ids(fx.plant_id_raw(spark, sf))


def _clean_city_name(spark, sf):
    cities = fx.city_file(spark, sf)
    return clean.clean_city_names(cities.select("ord", F.col("city").alias("raw_city"), "city"))


def _city_union(spark, sf):
    return clean.city_union_manual(fx.city_file(spark, sf))


def _dedup_keep_first(spark, sf):
    return clean.keep_first_city(clean.city_union_manual(fx.city_file(spark, sf)))


def _official_city_filter(spark, sf):
    return clean.official_city_filter(clean.city_union_manual(fx.city_file(spark, sf)), fx.official_cities(spark, sf))


def _city_reference(spark, sf):
    return clean.city_reference(fx.city_file(spark, sf), fx.official_cities(spark, sf))


def _csv_blank_join_keys(spark, sf):
    """Unit info and fuel mapping through CSV files with blank cells, read
    back keeping blanks as '' (they then join each other)."""
    info = fx.unit_info(spark, sf).na.fill("", subset=["fuel_type"])
    info_path, map_path = scratch_dir(spark, "unit-info-csv"), scratch_dir(spark, "mapping-csv")
    write_csv(info, info_path)
    write_csv(inline_table(spark, FUEL_MAPPING_ROWS, FUEL_MAPPING), map_path)
    info_schema = T.StructType([T.StructField("bm_unit", T.StringType()), T.StructField("fuel_type", T.StringType())])
    info_back = read_csv(spark, info_path, info_schema, blank_as_null=False)
    mapping = read_csv(spark, map_path, FUEL_MAPPING, blank_as_null=False)
    m = mapping.select(F.col("bm_fuel_type").alias("fuel_type"), "new_psr_type", "fuel_category", "source_category")
    return info_back.join(m, "fuel_type", "left").select(
        "bm_unit", "fuel_type", "new_psr_type", "fuel_category", "source_category"
    )


# --- geography ----------------------------------------------------------------------------

def _haversine(spark, sf):
    loc = fx.plant_location_raw(spark, sf)
    pts = fx.county_points(spark, sf)
    j = loc.join(pts, loc["nation_key"] == pts["ord.k0"], "left")
    return j.select(
        "dictionary_id",
        F.col("name").alias("county"),
        F.round(haversine_km(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon")), 6).alias(
            "distance_km"
        ),
    )


def _nearest_region(spark, sf):
    loc = fx.plant_location_raw(spark, sf).select("dictionary_id", "latitude", "longitude")
    out = nearest_region(loc, fx.county_points(spark, sf), "county", distance_col="distance_km")
    return out.withColumn("distance_km", F.round("distance_km", 6))


def _nearest_in_crowds(spark, sf):
    """The supplier nearest to each customer, through cells that follow the suppliers' density."""
    suppliers = region_points(fx.crowded_points(spark, sf, "supplier", "s_suppkey"), "s_suppkey", "s_suppkey")
    out = nearest_region(fx.crowded_points(spark, sf, "customer", "c_custkey"), suppliers, "supplier", distance_col="distance_km", small=False)
    return out.withColumn("distance_km", F.round("distance_km", 6))


def _plant_locations(spark, sf):
    return fx.plant_location(spark, sf)


# --- incremental -----------------------------------------------------------------------------

def _ingest_window(spark, sf):
    return _rounded(inc.ingest_window_report(fx.generation(spark, sf)), "total_quantity_mwh")


def _stored_days(spark, sf):
    """The days of the gapped facts, merged into a table, from the table's ledger."""
    path = scratch_dir(spark, "stored-days")
    inc.merge_days(fx.gapped_generation(spark, sf), path)
    return loaded_days(spark, path).select(PARTITION_COLUMN)


def _high_water_mark(spark, sf):
    scheduled = F.date_add(inc.high_water_mark(fx.generation(spark, sf)), 3)
    return inc.catch_up(_stored_days(spark, sf), scheduled)


def _dates_present(spark, sf):
    return _stored_days(spark, sf)


def _missing_dates(spark, sf):
    return inc.missing_settlement_dates(fx.gapped_generation(spark, sf))


def _missing_in_ledger(spark, sf):
    return inc.missing_settlement_dates(_stored_days(spark, sf))


def _loads(spark, sf):
    g = fx.generation(spark, sf)
    first = g.withColumn("load_id", F.lit(1))
    again = (
        g.where(F.dayofmonth(PARTITION_COLUMN).isin(1, 2))
        .withColumn("quantity", F.col("quantity") + F.lit(1.0))
        .withColumn("load_id", F.lit(2))
    )
    return first.unionByName(again)


def _dedup_generation(spark, sf):
    return inc.dedup_generation(_loads(spark, sf)).select(*GENERATION_COLUMNS)


def _split_loads(spark, sf):
    """Initial days, and a batch that corrects every second period of two of them, brings the days
    after them, and holds each of its rows twice."""
    g = fx.generation(spark, sf)
    part = F.col(PARTITION_COLUMN)
    cutoff = F.lit(MERGE_CUTOFF).cast("date")
    initial = g.where(part < cutoff)
    batch = g.where((part >= F.date_sub(cutoff, MERGE_OVERLAP_DAYS)) & ((part >= cutoff) | (F.col("settlement_period") % 2 == 0)))
    twice = batch.withColumn("less", F.explode(F.array(F.lit(0.0), F.lit(1.0))))
    return initial, twice.withColumn("quantity", F.col("quantity") + F.lit(1.0) - F.col("less")).drop("less")


def _incremental_merge(spark, sf):
    path = scratch_dir(spark, "generation-table")
    for load in _split_loads(spark, sf):
        inc.merge_days(load, path, order=("quantity",))
    return spark.read.parquet(path).select(*GENERATION_COLUMNS)


def _keyless(df):
    """Some of the rows without a unit or a period, as the feed has them when a field is missing."""
    no_unit, no_period = F.col("settlement_period") == 7, F.col("settlement_period") == 11
    return df.withColumn("bm_unit", F.when(~no_unit, F.col("bm_unit"))).withColumn(
        "settlement_period", F.when(~no_period, F.col("settlement_period")))


def _incremental_merge_keyless(spark, sf):
    """Both loads with rows that lack a part of the key, the second one merged twice."""
    path = scratch_dir(spark, "generation-table")
    initial, batch = _split_loads(spark, sf)
    for load in (initial, batch, batch):
        inc.merge_days(_keyless(load), path, order=("quantity",))
    return spark.read.parquet(path).select(*GENERATION_COLUMNS)


def _partitioned_roundtrip(spark, sf):
    path = scratch_dir(spark, "generation-partitioned")
    write_days(fx.generation(spark, sf), path)
    return spark.read.parquet(path).select(*GENERATION_COLUMNS)


def _incremental_daily_refresh(spark, sf):
    """Daily totals maintained incrementally: after each merge only the touched days are recomputed."""
    table, daily = scratch_dir(spark, "generation-table"), scratch_dir(spark, "daily")
    for load in _split_loads(spark, sf):
        inc.refresh_daily(daily, table, spark, inc.merge_days(load, table, order=("quantity",)))
    return _rounded(spark.read.parquet(daily).select("bm_unit", "settlement_date", "daily_generation_mwh"), "daily_generation_mwh")


def _county_top_incremental(spark, sf):
    """The ranking after two loads, the second with corrections of stored days, kept by differences."""
    table, state, dims = scratch_dir(spark, "generation-table"), scratch_dir(spark, "ranking-state"), fx.unit_dims(spark, sf)
    for load in _split_loads(spark, sf):
        R.refresh(spark, state, table, dims, inc.merge_days(load, table, order=("quantity",)))
    return _rounded(R.ranking(spark, state), "total_daily_generation_mwh")


def _county_top_by_ranges(spark, sf):
    """The ranking of several ranges of days from running totals, which were built for the first days and then extended."""
    path, dims = scratch_dir(spark, "running-totals"), fx.unit_dims(spark, sf)
    daily = V.daily_generation_by_unit(fx.generation(spark, sf))
    cutoff = F.lit(MERGE_CUTOFF).cast("timestamp_ntz")
    C.build(daily.where(F.col("settlement_date") < cutoff), dims, path)
    C.refresh(daily, dims, path, [MERGE_CUTOFF])
    out = None
    for first, last in REPORT_RANGES:
        top = C.county_top_source(spark, path, first, last).select(
            F.lit(first).alias("first_day"), F.lit(last).alias("last_day"), "county", "source_category", "total_daily_generation_mwh")
        out = top if out is None else out.unionByName(top)
    return _rounded(out, "total_daily_generation_mwh")


QUERIES: dict[str, Query] = {
    # aggregate / rank
    "daily_generation_by_unit": _daily,
    "generation_by_county_source": _by_county,
    "county_source_as_written": _county_as_written,
    "county_top_source": _county_top,
    "county_top_source_in_range": _county_top_in_range,
    "county_top_source_incremental": _county_top_incremental,
    "county_top_source_by_ranges": _county_top_by_ranges,
    "total_by_fuel_county": _fuel_county,
    "total_by_fuel_county_rollup": _fuel_county_rollup,
    "avg_by_settlement_period": _avg_period,
    # resolve / enrich
    "interconnector_flag": _interconnector,
    "fuel_resolution": _fuel_resolution,
    "coordinate_fallback": _coordinate_fallback,
    "capacity_latest": _capacity_latest,
    "capacity_as_of": _capacity_as_of,
    "capacity_as_of_sweep": _capacity_as_of_sweep,
    "generation_360_view": _view360,
    "generation_360_view_literal": _view360_literal,
    "generation_360_view_latest": _view360_latest,
    "generation_360_view_clustered": _view360_clustered,
    "unit_history": _unit_history,
    # SQL over registered views (S6 + C7-C9 as statements)
    "generation_360_view_sql": _view360_sql,
    "daily_generation_by_unit_sql": _sql_query(S.daily_generation_by_unit_sql, "daily_generation_mwh"),
    "fuel_resolution_sql": _fuel_resolution_sql,
    "haversine_distance_sql": _haversine_sql,
    "county_top_source_sql": _sql_query(S.county_top_source_sql, "total_daily_generation_mwh"),
    # clean / parse
    "clean_generation": _clean_generation,
    "json_roundtrip_generation": _json_roundtrip,
    "json_array_generation": _json_array,
    "stream_ingest_generation": _stream_ingest,
    "stream_ingest_repeats": _stream_ingest_repeats,
    "capacity_clean": _capacity_clean,
    "capacity_publish_windows": _capacity_publish_windows,
    "parse_timestamps": _parse_timestamps,
    "timestamp_formats": _timestamp_formats,
    "snake_case_columns": _snake_case,
    "unit_info_projection": _unit_info_projection,
    "plant_id_explode": _plant_id_explode,
    "clean_city_name": _clean_city_name,
    "city_union_manual": _city_union,
    "dedup_keep_first": _dedup_keep_first,
    "official_city_filter": _official_city_filter,
    "city_reference": _city_reference,
    "csv_blank_join_keys": _csv_blank_join_keys,
    # geo
    "haversine_distance": _haversine,
    "nearest_region": _nearest_region,
    "nearest_region_crowded": _nearest_in_crowds,
    "plant_locations": _plant_locations,
    # incremental
    "ingest_window": _ingest_window,
    "ingest_high_water_mark": _high_water_mark,
    "settlement_dates_present": _dates_present,
    "missing_settlement_dates": _missing_dates,
    "dedup_generation": _dedup_generation,
    "missing_settlement_dates_from_ledger": _missing_in_ledger,
    "incremental_merge": _incremental_merge,
    "incremental_merge_keyless": _incremental_merge_keyless,
    "partitioned_roundtrip": _partitioned_roundtrip,
    "incremental_daily_refresh": _incremental_daily_refresh,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
