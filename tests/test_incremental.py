"""Windows, catch-up, gaps, de-duplication, idempotent merge, stream ingest."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from wattframe.plans import incremental as inc
from wattframe.plans import views as V
from wattframe.schemas import GENERATION_COLUMNS
from wattframe.session import scratch_dir
from wattframe.streaming import start_generation_ingest

GEN = ("bm_unit string, half_hour_end_time timestamp, national_grid_bm_unit_id string, quantity double, "
       "settlement_date timestamp, settlement_period int, settlement_date_partition date")


def gen_rows(days, units=("T_A", "T_B"), periods=3, bump=0.0):
    out = []
    for d in days:
        day = dt.datetime.combine(d, dt.time())
        for u in units:
            for p in range(1, periods + 1):
                out.append((u, day + dt.timedelta(minutes=30 * p), u, float(p) + bump, day, p, d))
    return out


def test_windows_example(spark):
    w = inc.ingest_windows("2024-03-26", initial_days=10, delay_days=7)
    r = spark.range(1).select(*[c.alias(k) for k, c in w.items()]).first()
    assert (str(r.initial_from), str(r.initial_to), str(r.batch_day)) == ("2024-03-16", "2024-03-18", "2024-03-19")


def test_capacity_windows_example(spark):
    w = inc.capacity_windows("2024-03-26")
    r = spark.range(1).select(*[c.alias(k) for k, c in w.items()]).first()
    assert [str(r[k]) for k in ("initial_from", "initial_to", "batch_from", "batch_to")] == [
        "2023-01-01", "2024-03-25", "2024-03-25", "2024-03-26"]
    cap = spark.createDataFrame(
        [(dt.datetime(2024, 3, 24, 23, 0),), (dt.datetime(2024, 3, 25, 0, 0),), (dt.datetime(2024, 3, 26, 0, 0),)],
        "publish_time timestamp_ntz")
    assert inc.in_publish_window(cap, w["batch_from"], w["batch_to"]).count() == 1


def test_catch_up_example(spark):
    days = [dt.date(2024, 3, d) for d in (14, 15, 16)]
    g = spark.createDataFrame(gen_rows(days), GEN)
    r = inc.catch_up(g, "2024-03-19").first()
    assert str(r.request_from) == "2024-03-17"
    g2 = spark.createDataFrame(gen_rows([dt.date(2024, 3, 18)]), GEN)
    assert str(inc.catch_up(g2, "2024-03-19").first().request_from) == "2024-03-19"


def test_missing_dates_include_interior_holes(spark):
    days = [dt.date(2024, 1, d) for d in (1, 2, 5, 7)]
    g = spark.createDataFrame(gen_rows(days), GEN)
    got = sorted(str(r[0]) for r in inc.missing_settlement_dates(g).collect())
    assert got == ["2024-01-03", "2024-01-04", "2024-01-06"]


def test_dedup_latest_load_wins(spark):
    first = spark.createDataFrame(gen_rows([dt.date(2024, 1, 1)]), GEN).withColumn("load_id", F.lit(1))
    again = spark.createDataFrame(gen_rows([dt.date(2024, 1, 1)], bump=10.0), GEN).withColumn("load_id", F.lit(2))
    out = inc.dedup_generation(first.unionByName(again))
    assert out.columns == list(GENERATION_COLUMNS)
    assert out.count() == 6 and out.agg(F.min("quantity")).first()[0] == 11.0


def test_merge_is_idempotent_and_equals_full_load(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 8)]
    full = spark.createDataFrame(gen_rows(days), GEN)
    path = scratch_dir(spark, "merge-test")
    part = F.col("settlement_date_partition")
    inc.merge_days(full.where(part <= F.lit("2024-01-05").cast("date")), path)
    inc.merge_days(full.where(part >= F.lit("2024-01-04").cast("date")), path)  # overlapping re-run
    inc.merge_days(full.where(part >= F.lit("2024-01-04").cast("date")), path)  # and again
    back = spark.read.parquet(path).select(*GENERATION_COLUMNS)
    assert back.count() == full.count()
    assert back.exceptAll(full).count() == 0 and full.exceptAll(back).count() == 0


def test_partial_day_keeps_the_rest_of_the_day(spark):
    path = scratch_dir(spark, "partial-test")
    day = dt.date(2024, 1, 1)
    inc.merge_days(spark.createDataFrame(gen_rows([day, dt.date(2024, 1, 2)]), GEN), path)
    one = spark.createDataFrame(gen_rows([day], units=("T_A",), periods=1, bump=5.0), GEN)
    days = inc.merge_days(one.unionByName(one).unionByName(one.withColumn("quantity", F.lit(0.5))), path, order=("quantity",))
    assert [str(d) for d in days] == ["2024-01-01"]
    back = spark.read.parquet(path)
    assert back.count() == 12
    assert back.where("bm_unit = 'T_A' AND settlement_period = 1 AND settlement_date_partition = '2024-01-01'").first().quantity == 6.0


def test_daily_refresh_matches_full_recompute(spark):
    days = [dt.date(2024, 2, d) for d in range(1, 6)]
    full = spark.createDataFrame(gen_rows(days), GEN)
    facts, daily = scratch_dir(spark, "facts-test"), scratch_dir(spark, "daily-test")
    part = F.col("settlement_date_partition")
    first = full.where(part <= F.lit("2024-02-03").cast("date"))
    later = spark.createDataFrame(gen_rows(days[2:], bump=1.0), GEN)  # re-published days 3..5
    inc.refresh_daily(daily, facts, spark, inc.merge_days(first, facts))
    inc.refresh_daily(daily, facts, spark, inc.merge_days(later, facts))
    expect = V.daily_generation_by_unit(spark.read.parquet(facts))
    got = spark.read.parquet(daily).select("bm_unit", "settlement_date", "daily_generation_mwh")
    assert got.count() == 10 and got.exceptAll(expect).count() == 0


def test_partition_filter_prunes_and_quantity_filter_is_pushed(spark):
    path = scratch_dir(spark, "prune-test")
    inc.merge_days(spark.createDataFrame(gen_rows([dt.date(2024, 1, d) for d in (1, 2, 3)]), GEN), path)
    q = V.daily_generation_by_unit(spark.read.parquet(path), days=("2024-01-02", "2024-01-02"))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(settlement_date_partition" in plan
    assert "GreaterThan(quantity,0.0)" in plan
    assert q.count() == 2


def test_available_now_stream_merges_late_rows_and_corrections(spark):
    landing = scratch_dir(spark, "landing")
    table, ckpt = scratch_dir(spark, "stream-table"), scratch_dir(spark, "stream-ckpt")
    os.makedirs(landing)

    def land(name, rows):
        with open(os.path.join(landing, name), "w") as f:
            for r in rows:
                f.write(json.dumps(r) + "\n")

    def rec(u, day, p, q):
        return {"bmUnit": u, "halfHourEndTime": f"{day}T00:{30 if p % 2 else 0:02d}:00Z", "nationalGridBmUnitId": u,
                "quantity": q, "settlementDate": day, "settlementPeriod": p}

    land("d1.json", [rec("T_A", "2024-01-01", p, 1.0) for p in (1, 2)])
    start_generation_ingest(spark, landing, table, ckpt).awaitTermination()
    land("d2.json", [rec("T_A", "2024-01-02", p, 2.0) for p in (1, 2)] + [rec("T_A", "2024-01-01", 1, 9.0)])
    start_generation_ingest(spark, landing, table, ckpt).awaitTermination()
    out = spark.read.parquet(table)
    assert out.count() == 4  # the re-published (T_A, 01-01, 1) row replaces the first one
    assert out.where("quantity = 9.0").count() == 1
    land("late.json", [rec("T_A", "2023-06-01", 1, 3.0), rec("T_B", "2024-01-01", 1, 4.0)])  # long past, and a part of a day
    start_generation_ingest(spark, landing, table, ckpt).awaitTermination()
    spark.catalog.refreshByPath(table)
    assert spark.read.parquet(table).count() == 6


def test_dates_from_file_paths_and_unshuffled_view_write(spark):
    from wattframe.fixtures import fuel_mapping
    from wattframe.operators.dims import UnitDims

    days = [dt.date(2024, 4, d) for d in (1, 2, 4)]
    gen = spark.createDataFrame(gen_rows(days), GEN)
    path = scratch_dir(spark, "paths-test")
    inc.merge_days(gen, path)
    got = sorted(str(r[0]) for r in inc.settlement_dates_in_files(spark, path).collect())
    assert got == ["2024-04-01", "2024-04-02", "2024-04-04"]

    empty = lambda schema: spark.createDataFrame([], schema)
    dims = UnitDims(
        capacity=empty("bm_unit string, publish_time timestamp, effective_from timestamp, psr_type string, "
                       "installed_capacity double"),
        plant_id=empty("bm_unit string, dictionary_id bigint, name string"),
        plant_location=empty("dictionary_id bigint, latitude double, longitude double, city string, "
                             "county string, gsp_name string"),
        unit_info=spark.createDataFrame([("T_A", "WIND")], "bm_unit string, fuel_type string"),
        fuel_mapping=fuel_mapping(spark),
        overlay=empty("bm_unit string, psr_type string, latitude double, longitude double"),
    )
    out = scratch_dir(spark, "view-test")
    V.write_generation_360_view(spark.read.parquet(path), dims, out)
    back = spark.read.parquet(out)
    assert back.count() == gen.count()
    assert back.where("bm_unit = 'T_A'").select("source_category").distinct().first()[0] == "Clean"
