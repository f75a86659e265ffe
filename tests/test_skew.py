"""A unit holding a third of all rows; results beyond the broadcast bound."""

import datetime as dt

from pyspark.sql import functions as F

from wattframe.fixtures import fuel_mapping
from wattframe.operators.dims import UnitDims
from wattframe.plans import views as V

GEN = ("bm_unit string, half_hour_end_time timestamp, national_grid_bm_unit_id string, quantity double, "
       "settlement_date timestamp, settlement_period int, settlement_date_partition date")


def skewed_generation(spark, n=3000):
    day = dt.datetime(2024, 5, 1)
    rows = []
    for i in range(n):
        unit = "T_HOT" if i % 3 == 0 else f"T_{i % 97}"
        d = day + dt.timedelta(days=i % 5)
        rows.append((unit, d, unit, float(i % 11) - 2.0, d, i % 48 + 1, d.date()))
    return spark.createDataFrame(rows, GEN).repartition(6)


def dims(spark):
    units = ["T_HOT"] + [f"T_{i}" for i in range(97)]
    d0 = dt.datetime(2024, 1, 1)
    return UnitDims(
        capacity=spark.createDataFrame([(u, d0, d0, "Wind Onshore" if i % 2 else "Generation", 10.0 + i)
                                        for i, u in enumerate(units)] + [("T_HOT", d0, d0, "Nuclear", 99.0)],
                                       "bm_unit string, publish_time timestamp, effective_from timestamp, "
                                       "psr_type string, installed_capacity double"),
        plant_id=spark.createDataFrame([(u, i % 7, f"P{i % 7}") for i, u in enumerate(units)],
                                       "bm_unit string, dictionary_id bigint, name string"),
        plant_location=spark.createDataFrame([(i, 50.0 + i, -1.0, "c", f"K{i % 3}", "g") for i in range(7)],
                                             "dictionary_id bigint, latitude double, longitude double, "
                                             "city string, county string, gsp_name string"),
        unit_info=spark.createDataFrame([(u, "CCGT") for u in units[::2]], "bm_unit string, fuel_type string"),
        fuel_mapping=fuel_mapping(spark),
        overlay=spark.createDataFrame([], "bm_unit string, psr_type string, latitude double, longitude double"),
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_results_equal_beyond_broadcast_bound(spark):
    g, d = skewed_generation(spark), dims(spark)
    assert g.where("bm_unit = 'T_HOT'").count() == 1000
    for fn in (V.generation_360_view, V.generation_by_county_source, V.total_by_fuel_county):
        small = fn(g, d, max_broadcast_bytes=0)     # no explicit broadcast: the planner decides
        big = fn(g, d)                              # broadcast
        assert rows(small) == rows(big)


def test_hot_unit_is_split_beyond_broadcast_bound(spark):
    low = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
           "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in low}
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        # many map tasks, so that the hot partition has parts to be split by
        g = skewed_generation(spark, 30000).repartition(40)
        view = V.generation_360_view(g, dims(spark), max_broadcast_bytes=0)
        n = view.count()
        job = view.groupBy().count()
        assert job.collect()[0][0] == n
        assert "skew=true" in job._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_view_written_beyond_bound_has_one_file_per_day(spark):
    from wattframe.session import scratch_dir
    from wattframe.sources.files import table_files

    path = scratch_dir(spark, "view-files")
    V.write_generation_360_view(skewed_generation(spark), dims(spark), path, max_broadcast_bytes=0)
    assert table_files(spark, path).count() == 5


def test_hot_unit_daily_totals(spark):
    g = skewed_generation(spark)
    out = {(r.bm_unit, r.settlement_date.day): r.daily_generation_mwh
           for r in V.daily_generation_by_unit(g).collect()}
    expect = (g.where("quantity > 0").groupBy("bm_unit", F.dayofmonth("settlement_date").alias("d"))
              .agg(F.sum("quantity").alias("s")).collect())
    assert {(r.bm_unit, r.d): r.s for r in expect} == out
