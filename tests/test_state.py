"""Kept state: keyed merge with missing keys and late files, ledger, rankings by differences, running totals, catalog tables."""

import datetime as dt
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from wattframe.fixtures import fuel_mapping
from wattframe.operators.dims import UnitDims
from wattframe.plans import cumulative as C
from wattframe.plans import incremental as inc
from wattframe.plans import rankings as R
from wattframe.plans import sql as S
from wattframe.plans import views as V
from wattframe.plans.ingest import merge_generation
from wattframe.schemas import GENERATION_COLUMNS, GENERATION_FEED, PARTITION_COLUMN
from wattframe.session import scratch_dir
from wattframe.sources import ledger, sinks
from wattframe.streaming import start_generation_ingest
from wattframe.streaming.ingest import generation_stream, without_repeats

GEN = ("bm_unit string, half_hour_end_time timestamp, national_grid_bm_unit_id string, quantity double, "
       "settlement_date timestamp, settlement_period int, settlement_date_partition date")


def day(d, month=1, year=2024):
    return dt.date(year, month, d)


def fact(unit, d, period, q):
    at = dt.datetime.combine(d, dt.time())
    return (unit, at + dt.timedelta(minutes=30 * (period or 0)), "ng", q, at, period, d)


def facts(spark, rows):
    return spark.createDataFrame([fact(*r) for r in rows], GEN)


def dims(spark, county_of=(("T_A", 1), ("T_B", 2), ("T_C", 2), ("T_D", 3)), fuels=(("T_A", "WIND"), ("T_B", "CCGT"), ("T_C", "WIND"), ("T_D", "NUCLEAR"))):
    return UnitDims(
        capacity=spark.createDataFrame([("T_C", None, None, None, 1.0), ("T_C", None, None, None, 1.0)],
                                       "bm_unit string, publish_time timestamp, effective_from timestamp, psr_type string, installed_capacity double"),
        plant_id=spark.createDataFrame([(u, i, u) for u, i in county_of], "bm_unit string, dictionary_id bigint, name string"),
        plant_location=spark.createDataFrame([(1, 0.0, 0.0, "x", "Kent", "g"), (2, 0.0, 0.0, "x", "Essex", "g"), (3, 0.0, 0.0, "x", None, "g")],
                                             "dictionary_id bigint, latitude double, longitude double, city string, county string, gsp_name string"),
        unit_info=spark.createDataFrame(list(fuels), "bm_unit string, fuel_type string"),
        fuel_mapping=fuel_mapping(spark),
        overlay=spark.createDataFrame([], "bm_unit string, psr_type string, latitude double, longitude double"))


def rounded(df):
    return sorted(((*r[:-1], "nan" if r[-1] != r[-1] else round(r[-1], 6)) for r in df.collect()), key=str)


# ---- merge

def test_rows_without_a_full_key_are_all_kept(spark):
    path = scratch_dir(spark, "keyless")
    rows = [("T_A", day(1), 1, 1.0), ("T_A", day(1), None, 2.0), ("T_A", day(1), None, 3.0), (None, day(1), 1, 4.0), (None, day(1), 1, 5.0)]
    for _ in range(2):  # the second run changes nothing
        inc.merge_days(facts(spark, rows), path)
        assert sorted(r.quantity for r in spark.read.parquet(path).collect()) == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert inc.dedup_generation(facts(spark, rows).withColumn("load_id", F.lit(1))).count() == 5


@pytest.mark.parametrize("slice_rows, rows_a_key, dealt", [(1_000_000, 4, True), (5, 4, True), (5, 1, False)])
def test_a_merge_shuffles_rows_by_day_once(spark, monkeypatch, slice_rows, rows_a_key, dealt):
    by_day = []
    write = sinks.write_days
    monkeypatch.setattr(sinks, "SLICE_ROWS", slice_rows)
    monkeypatch.setattr(sinks, "ROWS_A_KEY", rows_a_key)
    monkeypatch.setattr(sinks, "write_days", lambda *a, **k: (by_day.append(k.get("rebalance", True)), write(*a, **k)))
    path = scratch_dir(spark, "dealt")
    full = [(f"T_{u}", day(1), p, float(v)) for u in range(10) for p in (1, 2) for v in (1, 2, 3)]
    part = [(None, day(1), 1, 8.0), (None, day(1), 1, 8.0), ("T_1", day(1), None, 9.0), ("T_1", None, 1, 5.0), ("T_2", day(2), 1, 6.0)]
    rows = spark.createDataFrame([fact(*r) if r[1] else (r[0], None, "ng", r[3], None, r[2], None) for r in full + part], GEN)
    for _ in range(2):  # a large day, then the same one with its stored rows
        inc.merge_days(rows, path, order=("quantity",))
        got = spark.read.parquet(path).select("bm_unit", "settlement_period", "quantity")
        assert sorted(r.quantity for r in got.collect()) == [3.0] * 20 + [5.0, 6.0, 8.0, 9.0]
    assert by_day == [not dealt] * 2


def feed(rows, landed):
    return [(u, f"{d}T00:30:00Z", u, q, str(d), p, landed) for u, d, p, q in rows]


FEED = "bmUnit string, halfHourEndTime string, nationalGridBmUnitId string, quantity double, settlementDate string, settlementPeriod int, landed_at timestamp"


def test_an_older_file_never_wins(spark):
    path, aside = scratch_dir(spark, "versions"), scratch_dir(spark, "aside")
    newer, older = dt.datetime(2024, 2, 2), dt.datetime(2024, 2, 1)
    first = spark.createDataFrame(feed([("T_A", day(1), 1, 9.0), ("T_A", day(1), None, 1.0)], newer), FEED)
    late = spark.createDataFrame(feed([("T_A", day(1), 1, 5.0), ("T_A", day(1), 2, 6.0), ("T_A", day(1), None, 1.0)], older)
                                 + [("T_B", None, "T_B", 1.0, "bad", 1, older)], FEED)
    for batch in (first, late, late):
        merge_generation(batch, path, aside)
    got = sorted((r.settlement_period or 0, r.quantity) for r in spark.read.parquet(path).collect())
    assert got == [(0, 1.0), (1, 9.0), (2, 6.0)]
    assert spark.read.parquet(aside).count() == 1  # set aside once, however often the batch runs
    merge_generation(first.drop("landed_at").withColumn("quantity", F.lit(7.0)), path)  # unknown time: the stored row stays
    assert spark.read.parquet(path).where("settlement_period = 1").first().quantity == 9.0


@pytest.mark.parametrize("within", [None, "1 hour"])
def test_stream_with_copies_in_a_file_and_an_older_file_late(spark, within):
    landing, table, ckpt = scratch_dir(spark, "landing"), scratch_dir(spark, "table"), scratch_dir(spark, "ckpt")
    os.makedirs(landing)

    def land(name, rows, at):
        path = os.path.join(landing, name)
        with open(path, "w") as f:
            f.writelines(json.dumps(dict(zip(GENERATION_FEED.names, r))) + "\n" for r in rows)
        os.utime(path, (at, at))
        start_generation_ingest(spark, landing, table, ckpt, repeats_within=within).awaitTermination()

    rec = lambda p, q: ("T_A", "2024-01-01T00:30:00Z", "T_A", q, "2024-01-01", p)
    land("b.json", [rec(1, 2.0), rec(1, 2.0), rec(None, 3.0), rec(None, 3.0)], 2_000_000)
    land("a.json", [rec(1, 8.0), rec(2, 4.0)], 1_000_000)
    assert sorted(r.quantity for r in spark.read.parquet(table).collect()) == [2.0, 3.0, 4.0]
    land("c.json", [rec(1, 5.0)], 2_000_001)
    land("d.json", [rec(1, 2.0)], 2_000_002)  # the values of b.json again, but later: they count
    assert sorted(r.quantity for r in spark.read.parquet(table).collect()) == [2.0, 3.0, 4.0]


def test_repeats_are_dropped_in_front_of_the_merge(spark):
    landing = scratch_dir(spark, "landing")
    os.makedirs(landing)
    rec = dict(zip(GENERATION_FEED.names, ("T_A", "2024-01-01T00:30:00Z", "T_A", 1.0, "2024-01-01", 1)))
    for name, at in (("a.json", 5_000_000), ("b.json", 5_000_000), ("c.json", 4_000_000)):  # b repeats a, c is older
        path = os.path.join(landing, name)
        with open(path, "w") as f:
            f.write((json.dumps(rec) + "\n") * 3)
        os.utime(path, (at, at))
    stream = without_repeats(generation_stream(spark, landing, max_files_per_trigger=1), "1 hour")
    stream.writeStream.format("memory").queryName("repeats_seen").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("repeats_seen").count() == 2


def test_state_of_repeats_holds_no_texts(spark):
    landing, ckpt, long = scratch_dir(spark, "landing"), scratch_dir(spark, "ckpt"), "T_" + "x" * 100
    os.makedirs(landing)
    kinds = [("a", None), (None, "a"), ("", "a"), (None, ""), ("", None), ("a", "a"), (None, None), ("aa", ""), (long, long), (long, "a")]
    records = [{"bmUnit": u, "nationalGridBmUnitId": g, "quantity": q} for u, g in kinds for q in (0.0, -0.0, 1.5, None)]
    for name in ("a.json", "b.json"):
        path = os.path.join(landing, name)
        with open(path, "w") as f:
            f.writelines(json.dumps(r) + "\n" for r in records * 2)
            f.writelines(["no record\n"] * 2 + ["nor this\n"])
        os.utime(path, (5_000_000, 5_000_000))
    stream = without_repeats(generation_stream(spark, landing, max_files_per_trigger=1), "1 hour")
    names = GENERATION_FEED.names
    assert stream.columns == [*names, "_corrupt_record", "landed_at"]
    stream.writeStream.format("memory").queryName("texts_seen").option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    seen = [(r.bmUnit, r.nationalGridBmUnitId, str(r.quantity)) for r in spark.table("texts_seen").where("_corrupt_record is null").collect()]
    assert sorted(seen, key=str) == sorted(((r["bmUnit"], r["nationalGridBmUnitId"], str(r["quantity"])) for r in records), key=str)
    assert sorted(r[0] for r in spark.table("texts_seen").where("_corrupt_record is not null").select("_corrupt_record").collect()) == ["no record", "nor this"]
    schema = "".join(open(os.path.join(d, f), errors="replace").read() for d, _, fs in os.walk(f"{ckpt}/state/0/0/_metadata") for f in fs if not f.endswith(".crc"))
    assert "landed_at" in schema and "bmUnit" not in schema and "_corrupt_record" not in schema


# ---- ledger

def test_mark_gaps_and_window_come_from_the_ledger_alone(spark):
    path = scratch_dir(spark, "ledger")
    inc.merge_days(facts(spark, [("T_A", day(d), 1, 1.0) for d in (1, 2, 5)]), path)
    inc.merge_days(facts(spark, [("T_A", day(d), 2, 1.0) for d in (5, 6)]), path)
    days = ledger.loaded_days(spark, path)
    assert sorted((str(r[0]), r.n_rows) for r in days.collect()) == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-05", 2), ("2024-01-06", 1)]
    assert days.inputFiles() and all(f"{os.path.basename(path)}__ledger" in f for f in days.inputFiles())
    shutil.move(path, path + "-away")  # no stored file is listed or opened
    assert sorted(str(r[0]) for r in inc.missing_settlement_dates(ledger.loaded_days(spark, path)).collect()) == ["2024-01-03", "2024-01-04"]
    assert inc.generation_window(spark, path, "2024-01-20") == ("2024-01-07", "2024-01-12")


def test_ledger_of_a_table_stored_without_one(spark):
    path = scratch_dir(spark, "no-ledger")
    from wattframe.sources.sinks import write_days

    write_days(facts(spark, [("T_A", day(d), 1, 1.0) for d in (3, 4)]), path)
    assert sorted(str(r[0]) for r in ledger.loaded_days(spark, path).collect()) == ["2024-01-03", "2024-01-04"]
    assert ledger.loaded_days(spark, path + "-none").count() == 0


def test_merge_reads_only_the_touched_days(spark):
    path = scratch_dir(spark, "touched")
    inc.merge_days(facts(spark, [("T_A", day(d), 1, 1.0) for d in (1, 2, 3)]), path)
    for name in os.listdir(f"{path}/{PARTITION_COLUMN}=2024-01-01"):
        if name.endswith(".parquet"):
            with open(f"{path}/{PARTITION_COLUMN}=2024-01-01/{name}", "w") as f:
                f.write("not parquet")
    inc.merge_days(facts(spark, [("T_A", day(3), 2, 1.0)]), path)
    assert spark.read.parquet(f"{path}/{PARTITION_COLUMN}=2024-01-03").count() == 2


# ---- ranking by differences

def full(spark, table, dims):
    return V.county_top_source(spark.read.parquet(table), dims)


def test_ranking_follows_loads_and_corrections(spark):
    table, state, d = scratch_dir(spark, "facts"), scratch_dir(spark, "state"), dims(spark)
    loads = [
        [("T_A", day(1), 1, 5.0), ("T_B", day(1), 1, 4.0), ("T_C", day(1), 1, 1.0), ("I_X", day(1), 1, 90.0), ("T_D", day(2), 1, -3.0)],
        [("T_C", day(2), 1, 2.5), ("T_B", day(2), 1, 0.1), ("T_D", day(2), 1, 3.0)],
        [("T_B", day(1), 1, 0.0), ("T_A", day(1), 1, -1.0)],                      # corrections: pairs disappear
        [("T_B", day(1), 1, float("nan"))],                                       # a bad value
        [("T_B", day(1), 1, 6.0), ("T_A", day(1), 1, float("inf"))],              # corrected
        [("T_A", day(1), 1, 0.3)],
    ]
    for rows in loads:
        R.refresh(spark, state, table, d, inc.merge_days(facts(spark, rows), table))
        spark.catalog.refreshByPath(table)
        assert rounded(R.ranking(spark, state)) == rounded(full(spark, table, d))
        assert rounded(R.county_totals(spark, state)) == rounded(V.generation_by_county_source(spark.read.parquet(table), d))
    R.refresh(spark, state, table, d, [day(1), day(2)])  # again: nothing to add
    assert rounded(R.ranking(spark, state)) == rounded(full(spark, table, d))
    other = dims(spark, county_of=(("T_A", 2), ("T_B", 1), ("T_C", 2)))  # plants moved: no facts are needed
    R.refresh(spark, state, table, other, [])
    assert rounded(R.ranking(spark, state)) == rounded(full(spark, table, other))


def test_sums_of_the_days_are_computed_once(spark, monkeypatch):
    def sampled(*_):
        raise AssertionError("ranges are sampled: what they are made of is computed twice")

    monkeypatch.setattr(type(spark.range(1)), "repartitionByRange", sampled)
    table, state = scratch_dir(spark, "t"), scratch_dir(spark, "s")
    rows = [(u, day(n), p, 1.0) for u in ("T_B", "T_A") for n in (3, 1, 2) for p in (1, 2)]
    R.refresh(spark, state, table, dims(spark), inc.merge_days(facts(spark, rows), table))
    kept = [(str(r.day), r.bm_unit, r.mwh) for r in spark.read.parquet(f"{state}/daily/version=0").collect()]
    assert sorted(kept) == [(f"2024-01-0{n}", u, 2.0) for n in (1, 2, 3) for u in ("T_A", "T_B")]


def test_ranking_reads_no_facts_of_untouched_days(spark):
    table, state, d = scratch_dir(spark, "facts"), scratch_dir(spark, "state"), dims(spark)
    R.refresh(spark, state, table, d, inc.merge_days(facts(spark, [("T_A", day(1), 1, 5.0), ("T_B", day(2), 1, 4.0)]), table))
    days = inc.merge_days(facts(spark, [("T_C", day(2), 1, 7.0)]), table)
    shutil.move(f"{table}/{PARTITION_COLUMN}=2024-01-01", scratch_dir(spark, "away"))
    R.refresh(spark, state, table, d, days)
    assert rounded(R.unit_totals(spark, state)) == [("T_A", 5.0), ("T_B", 4.0), ("T_C", 7.0)]
    assert rounded(R.ranking(spark, state)) == [("Essex", "Clean", 14.0), ("Kent", "Clean", 5.0)]


def test_a_run_that_stops_before_the_log_changes_nothing(spark, monkeypatch):
    table, state, d = scratch_dir(spark, "facts"), scratch_dir(spark, "state"), dims(spark)
    R.refresh(spark, state, table, d, inc.merge_days(facts(spark, [("T_A", day(1), 1, 5.0)]), table))
    days = inc.merge_days(facts(spark, [("T_A", day(1), 1, 6.0), ("T_B", day(2), 1, 1.0)]), table)

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(R, "top_per_county", stop)
        with pytest.raises(RuntimeError):
            R.refresh(spark, state, table, d, days)
    assert rounded(R.ranking(spark, state)) == [("Kent", "Clean", 5.0)]
    R.refresh(spark, state, table, d, days)
    assert rounded(R.ranking(spark, state)) == [("Essex", "Fossil", 1.0), ("Kent", "Clean", 6.0)]


# ---- running totals

def test_ranges_from_running_totals(spark):
    d, path = dims(spark), scratch_dir(spark, "running")
    units = ("T_A", "T_B", "T_C", "T_D", "I_X", "T_none")
    rows = [(u, day(1 + (7 * k) % 28, 1 + (k * 5) % 12, 2023 + k % 2), 1, 1.0 + k % 13) for k, u in enumerate(units * 9)]
    rows += [("T_A", day(15, 6, 2024), 1, float("nan"))]
    g = facts(spark, rows)
    daily = V.daily_generation_by_unit(g).withColumn(PARTITION_COLUMN, F.to_date("settlement_date"))
    early = F.col(PARTITION_COLUMN) < F.lit("2024-03-10").cast("date")
    C.build(daily.where(early), d, path)
    C.refresh(daily, d, path, [day(10, 3), day(2, 8)])
    ranges = [(None, None), ("2023-01-01", "2023-12-31"), ("2024-01-31", "2024-02-01"), ("2024-03-01", None), (None, "2023-02-28"),
              ("2024-06-14", "2024-06-15"), ("2024-06-16", "2030-01-01"), ("2020-01-01", "2020-12-31"), ("2023-05-05", "2023-05-05")]
    for a, b in ranges:
        assert rounded(C.county_top_source(spark, path, a, b)) == rounded(V.county_top_source(g, d, (a, b))), (a, b)
        got = C.generation_by_county_source(spark, path, a, b)
        assert rounded(got) == rounded(V.generation_by_county_source(g, d, (a, b))), (a, b)
    files = C.county_top_source(spark, path, "2023-02-10", "2024-07-01").inputFiles()
    assert {f.split("month=")[1][:7] for f in files} <= {"2023-02", "2024-07"}  # two months, no facts


def test_running_totals_after_a_gap_of_months(spark):
    d, path = dims(spark), scratch_dir(spark, "gap")
    g = facts(spark, [("T_A", day(3, 1), 1, 2.0), ("T_B", day(30, 5), 1, 3.0)])
    daily = V.daily_generation_by_unit(g)
    C.build(daily.where("bm_unit = 'T_A'"), d, path)
    C.refresh(daily, d, path, [day(30, 5)])
    for a, b in ((None, "2024-03-03"), ("2024-02-01", "2024-05-31"), ("2024-05-30", "2024-05-30"), (None, None)):
        assert rounded(C.county_top_source(spark, path, a, b)) == rounded(V.county_top_source(g, d, (a, b))), (a, b)


# ---- catalog tables

def test_partitions_of_the_catalog_table_are_the_merged_days(spark):
    path, rows = scratch_dir(spark, "catalog"), [("T_A", day(d), 1, 1.0) for d in (1, 2, 3)]
    g = facts(spark, rows)
    S.create_day_table(spark, "test_day_table", path, g.schema, replace=True)
    S.register_days(spark, "test_day_table", inc.merge_days(g.where("settlement_date_partition < '2024-01-03'"), path))
    assert spark.table("test_day_table").count() == 2
    S.register_days(spark, "test_day_table", inc.merge_days(facts(spark, [rows[1], rows[2], ("T_B", day(2), 1, 2.0)]), path))
    parts = sorted(r[0] for r in spark.sql("SHOW PARTITIONS test_day_table").collect())
    assert parts == [f"{PARTITION_COLUMN}=2024-01-0{d}" for d in (1, 2, 3)]
    one = spark.sql(f"SELECT {', '.join(GENERATION_COLUMNS)} FROM test_day_table WHERE {PARTITION_COLUMN} = DATE'2024-01-02'")
    assert one.count() == 2 and all("2024-01-02" in f for f in one.inputFiles())
    spark.sql("DROP TABLE test_day_table")
