"""Fuel resolution, fan-out and county ranking goldens on tiny frames."""

import datetime as dt


from wattframe.fixtures import fuel_mapping
from wattframe.operators.dims import UnitDims, capacity_latest
from wattframe.plans import views as V

GEN = ("bm_unit string, half_hour_end_time timestamp, national_grid_bm_unit_id string, quantity double, "
       "settlement_date timestamp, settlement_period int, settlement_date_partition date")
CAP = "bm_unit string, publish_time timestamp, effective_from timestamp, psr_type string, installed_capacity double"

D = dt.datetime(2024, 3, 19)


def gen(spark, rows):
    """rows: (unit, quantity) on one day, one period each."""
    data = [(u, D, u, q, D, i + 1, D.date()) for i, (u, q) in enumerate(rows)]
    return spark.createDataFrame(data, GEN)


def dims(spark, capacity=(), plant_id=(), location=(), unit_info=(), overlay=()):
    return UnitDims(
        capacity=spark.createDataFrame(list(capacity), CAP),
        plant_id=spark.createDataFrame(list(plant_id), "bm_unit string, dictionary_id bigint, name string"),
        plant_location=spark.createDataFrame(
            list(location),
            "dictionary_id bigint, latitude double, longitude double, city string, county string, gsp_name string"),
        unit_info=spark.createDataFrame(list(unit_info), "bm_unit string, fuel_type string"),
        fuel_mapping=fuel_mapping(spark),
        overlay=spark.createDataFrame(list(overlay),
                                      "bm_unit string, psr_type string, latitude double, longitude double"),
    )


def resolved(df):
    return {r.bm_unit: r.asDict() for r in df.collect()}


def test_null_capacity_type_falls_to_unit_info(spark):
    g = gen(spark, [("T_A", 1.0), ("T_B", 1.0)])
    d = dims(spark,
             capacity=[("T_A", D, D, None, 10.0), ("T_B", D, D, "Other", 5.0)],
             unit_info=[("T_A", "WIND")],
             overlay=[("T_B", "Wind Offshore", 51.0, -1.0)])
    out = resolved(V.fuel_resolution(g, d))
    assert out["T_A"]["source_category"] == "Clean"          # NULL NOT IN (...) -> unit info arm
    assert out["T_A"]["new_psr_type"] == "Wind (Unspecified)"
    assert out["T_B"]["source_category"] == "Clean"          # generic capacity type, no info -> overlay
    assert out["T_B"]["inferred_fuel_type"] == "Wind Offshore"


def test_unmapped_capacity_type_uses_overlay_category(spark):
    g = gen(spark, [("T_S", 1.0)])
    d = dims(spark, capacity=[("T_S", D, D, "Solar", 1.0)], overlay=[("T_S", "Fossil Gas", 51.0, -1.0)])
    out = resolved(V.fuel_resolution(g, d))["T_S"]
    assert out["inferred_fuel_type"] == "Solar"
    assert out["source_category"] == "Fossil"


def test_interconnector_without_any_dimension_row(spark):
    g = gen(spark, [("I_X", 3.0), ("IE", 3.0), ("I", 3.0)])
    out = resolved(V.fuel_resolution(g, dims(spark)))
    assert out["I_X"]["source_category"] == "Interconnector"
    assert out["IE"]["source_category"] == "Interconnector"
    assert out["I"]["source_category"] is None


def test_capacity_history_fans_out_as_written_and_latest_picks_one(spark):
    g = gen(spark, [("T_H", 2.0)])
    hist = [("T_H", dt.datetime(2023, 1, d), dt.datetime(2023, 1, d), "Nuclear", 100.0 + d) for d in (1, 2, 3)]
    d = dims(spark, capacity=hist)
    assert V.generation_360_view(g, d).count() == 3
    latest = V.generation_360_view_latest(g, d).collect()
    assert len(latest) == 1 and latest[0].installed_capacity == 103.0
    assert capacity_latest(d.capacity).count() == 1


def test_folded_view_equals_literal_joins(spark):
    g = gen(spark, [("T_1", 1.0), ("T_2", 2.0), ("I_3", 3.0), ("T_4", -1.0), ("T_9", 4.0)])
    d = dims(
        spark,
        capacity=[("T_1", D, D, "Wind Onshore", 5.0), ("T_1", D, D, "Generation", 6.0), ("T_2", D, D, None, 1.0)],
        plant_id=[("T_1", 7, "P7"), ("T_2", 8, "P8"), ("T_2", 9, "P9")],
        location=[(7, 52.0, -1.0, "C1", "K1", "G1"), (8, None, None, None, None, None)],
        unit_info=[("T_2", "CCGT"), ("T_4", "PS")],
        overlay=[("T_4", "Battery Storage", 51.0, 0.0), ("T_1", "Fossil Gas", 50.0, 0.5)],
    )
    folded = V.generation_360_view(g, d)
    literal = V.generation_360_view_literal(g, d)
    assert sorted(map(tuple, folded.collect()), key=str) == sorted(map(tuple, literal.collect()), key=str)
    assert folded.count() == 1 * 2 + 1 * 2 + 1 + 1 + 1  # product of multiplicities per fact row


def test_county_ranking_as_written_vs_intended(spark):
    g = gen(spark, [("T_C", 5.0), ("T_F", 9.0), ("T_N", 4.0), ("T_Z", 2.0)])
    d = dims(
        spark,
        plant_id=[("T_C", 1, "a"), ("T_F", 2, "b"), ("T_Z", 3, "c")],
        location=[(1, 1.0, 1.0, None, "c1", None), (2, 1.0, 1.0, None, "c1", None), (3, 1.0, 1.0, None, None, None)],
        unit_info=[("T_C", "WIND"), ("T_F", "CCGT"), ("T_Z", "NUCLEAR")],
    )
    written = {(r.county, r.source_category) for r in V.county_source_as_written(g, d).collect()}
    assert written == {("c1", "Clean"), ("c1", "Fossil"), (None, "Nuclear")}  # T_N: NULL category dropped
    top = {r.county: (r.source_category, r.total_daily_generation_mwh) for r in V.county_top_source(g, d).collect()}
    assert top == {"c1": ("Fossil", 9.0), None: ("Nuclear", 2.0)}


def test_daily_sum_only_positive(spark):
    g = gen(spark, [("T_A", 1.5), ("T_A", -2.0), ("T_A", 0.25), ("T_B", 0.0)])
    out = {r.bm_unit: r.daily_generation_mwh for r in V.daily_generation_by_unit(g).collect()}
    assert out == {"T_A": 1.75}


def test_rollup_marks_subtotals(spark):
    g = gen(spark, [("T_A", 1.0), ("T_B", 2.0)])
    d = dims(spark, plant_id=[("T_A", 1, "a")], location=[(1, 1.0, 1.0, None, "k", None)],
             unit_info=[("T_A", "WIND"), ("T_B", "WIND")])
    rows = {(r.county, r.fuel_category, r.grouping_level): r.total_generation_mwh
            for r in V.total_by_fuel_county_rollup(g, d).collect()}
    assert rows[(None, None, 3)] == 3.0
    assert rows[("k", None, 1)] == 1.0
    assert rows[(None, "Wind", 0)] == 2.0  # real NULL county, not a subtotal


def test_sql_statements_over_parquet_views_equal_dataframe_plans(spark):
    from wattframe.plans import sql as S
    from wattframe.session import scratch_dir

    g = gen(spark, [("T_1", 1.0), ("T_2", 2.0), ("I_3", 3.0)])
    d = dims(spark, capacity=[("T_1", D, D, "Wind Onshore", 5.0)], unit_info=[("T_2", "CCGT")],
             plant_id=[("T_1", 7, "P7")], location=[(7, 52.0, -1.0, "C1", "K1", "G1")])
    root = scratch_dir(spark, "views-test")
    frames = {"generation": g, "capacity": d.capacity, "plant_id": d.plant_id, "plant_location": d.plant_location,
              "unit_info": d.unit_info, "fuel_mapping": d.fuel_mapping, "overlay": d.overlay}
    for name, df in frames.items():
        df.write.parquet(f"{root}/{name}")
    S.register_parquet_views(spark, {n: f"{root}/{n}" for n in frames}, prefix="t_")
    sql_rows = sorted(map(tuple, spark.sql(S.generation_360_view_sql("t_")).collect()), key=str)
    df_rows = sorted(map(tuple, V.generation_360_view(g, d).collect()), key=str)
    assert sql_rows == df_rows
    top = {r.county: r.source_category for r in spark.sql(S.county_top_source_sql("t_")).collect()}
    assert top == {"K1": "Clean", None: "Fossil"}
