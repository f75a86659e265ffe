"""Clustered tables, unit look-ups, as-of sweep, SQL functions."""

import bisect
import datetime as dt
import random

import pytest

from pyspark.sql import functions as F

from wattframe.functions.fuel import resolve_fuel_attribute
from wattframe.functions.geo import haversine_km
from wattframe.operators.dims import capacity_as_of_sweep, unit_dim
from wattframe.plans import sql as S
from wattframe.plans import views as V
from wattframe.session import scratch_dir
from wattframe.sources import buckets as B
from wattframe.sources.sinks import lookup_options, write_days

from test_resolution import D, dims, gen


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _facts(spark, hot=False):
    unit = F.concat(F.lit("T_"), F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit(5)).otherwise(F.col("id") % 40))
    day = F.date_add(F.lit("2024-01-20").cast("date"), (F.col("id") % 50).cast("int"))
    return spark.range(4000).select(
        F.when(F.col("id") % 101 > 0, unit).alias("bm_unit"), day.cast("timestamp").alias("half_hour_end_time"),
        F.lit("n").alias("national_grid_bm_unit_id"), F.col("id").cast("double").alias("quantity"), day.cast("timestamp").alias("settlement_date"),
        (F.col("id") % 48).cast("int").alias("settlement_period"),
        F.when(F.col("id") % 103 > 0, day).alias("settlement_date_partition"))


def _dims(spark):
    return dims(spark, capacity=[(f"T_{k}", D, D, "Nuclear" if k % 2 else "Other", float(k)) for k in range(30) for _ in range(1 + k % 2)],
                plant_id=[(f"T_{k}", k, f"plant {k}") for k in range(35)],
                location=[(k, 50.0 + k / 10, -1.0, "c", f"county {k % 4}", "g") for k in range(35)])


@pytest.mark.parametrize("hot", [False, True])
def test_clustered_view_has_no_exchange_and_equals_the_other_form(spark, hot):
    facts, d = _facts(spark, hot), _dims(spark)
    B.write_clustered(facts, "t_facts", scratch_dir(spark, "t-facts"), 8)
    B.write_bucketed(unit_dim(d), "t_profile", scratch_dir(spark, "t-profile"), 8)
    units = B.hot_units(spark, "t_facts")
    assert units == (["T_5"] if hot else [])
    read = B.clustered(spark, "t_facts").select(*facts.columns)
    assert read.count() == 4000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        view = V.generation_360_view_clustered(read, spark.table("t_profile"), units)
        plan = _plan(view)
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert ("BroadcastHashJoin" in plan) == hot
        got = sorted(map(str, view.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(map(str, V.generation_360_view_literal(facts, d).collect()))


def test_clustered_days_prune_months(spark):
    facts = _facts(spark)
    B.write_clustered(facts, "t_months", scratch_dir(spark, "t-months"), 8)
    days = ("2024-02-10", "2024-02-12")
    df = B.clustered(spark, "t_months", days)
    assert f"PartitionFilters: [isnotnull({B.MONTH}" in _plan(df)
    assert sorted(map(str, df.collect())) == sorted(map(str, V.in_days(facts, days).collect()))
    assert B.clustered(spark, "t_months", (None, "2024-01-31")).count() == V.in_days(facts, (None, "2024-01-31")).count()


def test_bucket_numbers_divide_each_other():
    assert [B.buckets_for(n << 30) for n in (0, 8, 9, 100, 100_000)] == [8, 8, 16, 128, 16384]


def _scanned(df):
    """Rows that the scan handed on."""
    df._jdf.queryExecution().toRdd().count()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().get("numOutputRows").get().value()


@pytest.mark.parametrize("dictionary", ["true", "false"])
def test_unit_lookup_skips_row_groups(spark, dictionary):
    path = scratch_dir(spark, "lookup")
    rows = spark.range(20000).select(F.format_string("T_%06d", F.col("id") * 2).alias("bm_unit"), F.rand(3).alias("x"))
    rows.repartition(4, "x").write.options(**lookup_options("bm_unit"), **{"parquet.enable.dictionary": dictionary}).parquet(path)
    table = spark.read.parquet(path)
    absent, present = table.where(F.col("bm_unit") == "T_001001"), table.where(F.col("bm_unit") == "T_001000")
    assert _scanned(absent) == 0                      # between the least and the greatest unit of every file
    assert 0 < _scanned(present) < 20000 and present.count() == 1


def test_unit_history(spark):
    path, facts = scratch_dir(spark, "history"), _facts(spark)
    write_days(facts, path)
    got = V.unit_history(spark.read.parquet(path), ["T_3", "T_none"], ("2024-02-01", None)).select(*facts.columns)
    assert "PushedFilters: [In(bm_unit" in _plan(got)
    want = V.in_days(facts, ("2024-02-01", None)).where("bm_unit = 'T_3'")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_as_of_sweep_of_a_long_history(spark):
    rng = random.Random(4)
    start = dt.datetime(2020, 1, 1)
    at = lambda h: start + dt.timedelta(hours=h)
    versions = [("T_A", at(rng.randrange(9000)) if rng.random() < .9 else None, at(rng.randrange(20000)) if rng.random() < .99 else None,
                 rng.choice(["Wind", "Solar", None]), rng.choice([1.0, 2.0, None])) for _ in range(10000)]
    versions += [(None, start, start, "Wind", 1.0), ("T_B", start, at(48), "Wind", 1.0)]
    days = [("T_A", at(24 * k)) for k in range(-2, 900)] + [("T_B", at(24)), ("T_B", at(48)), ("T_B", at(48)), ("T_C", at(0)), (None, at(99)), ("T_A", None)]
    cap = spark.createDataFrame(versions, "bm_unit string, publish_time timestamp, effective_from timestamp, psr_type string, installed_capacity double")
    out = capacity_as_of_sweep(spark.createDataFrame(days, "bm_unit string, settlement_date timestamp"), cap)
    assert "Join" not in _plan(out)
    low = lambda v: (v is not None, v if v is not None else 0)
    order = sorted((v for v in versions if v[0] == "T_A" and v[2]), key=lambda v: (v[2], low(v[1]), low(v[4]), (v[3] is not None, v[3] or "")))
    starts = [v[2] for v in order]
    got = out.collect()
    assert len(got) == len(days)
    for r in got:
        told = (r.effective_from, r.publish_time, r.psr_type, r.installed_capacity)
        if r.bm_unit == "T_A" and r.settlement_date and bisect.bisect_right(starts, r.settlement_date):
            v = order[bisect.bisect_right(starts, r.settlement_date) - 1]
            assert told == (v[2], v[1], v[3], v[4])
        elif r.bm_unit == "T_B" and r.settlement_date == at(48):
            assert told == (at(48), start, "Wind", 1.0)
        else:
            assert told == (None,) * 4


def test_sql_functions_equal_the_expressions(spark):
    S.create_functions(spark, "tf_")
    vals = [None, "I_1", "IE", "I", "T_1"]
    types = [None, "Other", "Generation", "Nuclear"]
    rows = [(u, t, a, b, c) for u in vals for t in types for a in (None, "A") for b in (None, "B") for c in (None, "C")]
    df = spark.createDataFrame(rows, "u string, t string, a string, b string, c string")
    df = df.withColumn("x", resolve_fuel_attribute(*[F.col(c) for c in "utabc"]))
    df.createOrReplaceTempView("tf_rows")
    both = spark.sql("SELECT *, tf_resolve_fuel(u, t, a, b, c) AS y, tf_is_interconnector(u) AS i FROM tf_rows").collect()
    assert all(r.x == r.y for r in both) and {r.u: r.i for r in both} == {None: None, "I_1": True, "IE": True, "I": False, "T_1": False}
    points = spark.createDataFrame([(51.5, -0.1, 53.4, -2.2), (0.0, 0.0, 0.0, 180.0), (None, 1.0, 1.0, 1.0), (5.0, 5.0, 5.0, 5.0)], "p double, q double, r double, s double")
    points.withColumn("d", haversine_km(*[F.col(c) for c in "pqrs"])).createOrReplaceTempView("tf_points")
    assert all(r.d == r.e for r in spark.sql("SELECT d, tf_haversine_km(p, q, r, s) AS e FROM tf_points").collect())
