"""End-to-end jobs over tiny landed files."""

import json
import os

from wattframe import jobs
from wattframe.constants import FUEL_MAPPING_ROWS
from wattframe.schemas import FUEL_MAPPING
from wattframe.session import scratch_dir


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _gen(u, day, p, q):
    return {"bmUnit": u, "halfHourEndTime": f"{day}T{p // 2:02d}:{30 * (p % 2):02d}:00Z",
            "nationalGridBmUnitId": u, "quantity": q, "settlementDate": day, "settlementPeriod": p}


def test_ingest_reference_and_reports(spark):
    root = scratch_dir(spark, "jobs")
    landing, tables, files, out = (f"{root}/{x}" for x in ("landing", "tables", "files", "out"))
    rows = [_gen(u, d, p, q) for u, q in (("T_WIND", 10.0), ("T_GAS", 4.0), ("I_FR", 7.0))
            for d in ("2024-03-01", "2024-03-02") for p in (1, 2)]
    _write(f"{landing}/gen/a.json", "\n".join(json.dumps(r) for r in rows) + "\n")
    _write(f"{landing}/cap/a.json", json.dumps({"bmUnit": "T_GAS", "publishTime": "2024-01-01T00:00:00Z",
                                                 "effectiveFrom": "2024-01-01T00:00:00Z", "psrType": "Fossil Gas",
                                                 "installedCapacity": 400.0}) + "\n")
    _write(f"{files}/ids.csv", "extra,dictionary_id,name,sett_bmu_id,ngc_bmu_id\nx,1,Windy,T_WIND,W\ny,2,Gassy,T_GAS,G\n")
    _write(f"{files}/plant-locations.csv", "dictionary_id,latitude,longitude,note\n1,57.1,-2.6,a\n2,51.4,-0.1,b\n")
    _write(f"{files}/bmunits.json", json.dumps([{"elexonBmUnit": "T_WIND", "fuelType": "WIND", "other": 1},
                                                {"elexonBmUnit": "T_GAS", "fuelType": "CCGT"}]))
    mapping = "\n".join([",".join(FUEL_MAPPING.names)] + [",".join(r) for r in FUEL_MAPPING_ROWS])
    _write(f"{files}/psr_fuel_type_mapping.csv", mapping + "\n")
    _write(f"{files}/bm_unit_info_overlay.csv", "bm_unit,psr_type,latitude,longitude,capacity\n")
    _write(f"{files}/uk_counties_coordinates.csv",
           "county,country,latitude,longitude\nAberdeenshire,Scotland,57.16,-2.66\nKent,England,51.2,0.7\n")
    _write(f"{files}/uk_gsps_coordinates.csv", "gsp,gsp_name,latitude,longitude\n_A,Eastern,52.25,0.71\n"
                                               "_P,North Scotland,56.1,-3.9\n")
    _write(f"{files}/uk_cities_coordinates.csv", "city,lat,lng,pop\nAberdeen,57.15,-2.1,1\nLondon,51.5,-0.12,2\n")
    _write(f"{files}/uk_cities_list.csv", "city\nAberdeen\nLondon\n")

    jobs.main(["ingest-generation", "--landing", f"{landing}/gen", "--tables", tables])
    jobs.main(["ingest-generation", "--landing", f"{landing}/gen", "--tables", tables])  # re-run: no duplicates
    jobs.main(["ingest-capacity", "--landing", f"{landing}/cap", "--tables", tables])
    jobs.main(["build-reference", "--files", files, "--tables", tables])
    jobs.main(["build-reports", "--tables", tables, "--out", out])

    assert spark.read.parquet(f"{tables}/generation").count() == 12
    loc = {r.dictionary_id: (r.city, r.county, r.gsp_name) for r in spark.read.parquet(f"{tables}/plant_location").collect()}
    assert loc == {1: ("Aberdeen", "Aberdeenshire", "North Scotland"), 2: ("London", "Kent", "Eastern")}
    top = {r.county: r.source_category for r in spark.read.parquet(f"{out}/county_top_source").collect()}
    assert top == {"Aberdeenshire": "Clean", "Kent": "Fossil"}
    daily = spark.read.parquet(f"{out}/generation_by_unit_by_settlement_date")
    assert daily.count() == 6
    jobs.main(["build-reports", "--tables", tables, "--out", out, "--first", "2024-03-02"])  # one side open
    ranged = {r.county: r.total_daily_generation_mwh for r in spark.read.parquet(f"{out}/county_top_source_2024-03-02_end").collect()}
    assert ranged == {"Aberdeenshire": 20.0, "Kent": 8.0}
    whole = {r.county: r.total_daily_generation_mwh for r in spark.read.parquet(f"{out}/county_top_source").collect()}
    assert whole == {"Aberdeenshire": 40.0, "Kent": 16.0}  # the whole history stays
    assert "note" in spark.read.parquet(f"{tables}/plant_location").columns
    view = spark.read.parquet(f"{out}/generation_capacity_360_view")
    assert view.where("bm_unit = 'I_FR'").select("source_category").distinct().first()[0] == "Interconnector"


def test_ingest_json_array_response(spark):
    root = scratch_dir(spark, "jobs-array")
    rows = [_gen("T_A", "2024-03-05", p, 1.0 * p) for p in (1, 2, 3)]
    _write(f"{root}/landing/a.json", json.dumps(rows))  # one response saved as a JSON array
    _write(f"{root}/landing/b.json", "null")             # an empty response
    jobs.ingest_generation(spark, f"{root}/landing", f"{root}/tables", multiline=True)
    got = spark.read.parquet(f"{root}/tables/generation")
    assert got.count() == 3 and got.agg({"quantity": "sum"}).first()[0] == 6.0


def test_quarantine_partial_days_and_gap_report(spark):
    root = scratch_dir(spark, "jobs-merge")
    tables = f"{root}/tables"
    first = [json.dumps(_gen(u, d, p, 1.0)) for u in ("T_A", "T_B") for d in ("2024-03-01", "2024-03-04") for p in (1, 2, 3)]
    bad = [json.dumps(_gen("T_A", "not a day", 1, 8.0)), '{"bmUnit": "T_A", "quantity": ', "null"]
    _write(f"{root}/one/a.json", "\n".join(first + bad) + "\n")
    jobs.ingest_generation(spark, f"{root}/one", tables)
    _write(f"{root}/two/a.json", json.dumps(_gen("T_A", "2024-03-01", 1, 6.0)) + "\n")
    assert [str(d) for d in jobs.ingest_generation(spark, f"{root}/two", tables)] == ["2024-03-01"]
    got = spark.read.parquet(f"{tables}/generation")
    assert got.count() == 12 and got.agg({"quantity": "sum"}).first()[0] == 17.0
    reasons = sorted(r.reason for r in spark.read.parquet(f"{tables}/quarantine").collect())
    assert reasons == ["no settlement date", "unreadable record"]
    daily = {(r.bm_unit, str(r.settlement_date_partition)): r.daily_generation_mwh for r in spark.read.parquet(f"{tables}/daily_generation").collect()}
    assert daily == {("T_A", "2024-03-01"): 8.0, ("T_A", "2024-03-04"): 3.0, ("T_B", "2024-03-01"): 3.0, ("T_B", "2024-03-04"): 3.0}
    assert sorted(str(r[0]) for r in spark.read.parquet(f"{tables}/missing_days").collect()) == ["2024-03-02", "2024-03-03"]


def test_run_date_takes_missed_days(spark):
    root = scratch_dir(spark, "jobs-window")
    tables = f"{root}/tables"
    rows = [json.dumps(_gen("T_A", f"2024-03-{d:02d}", 1, 1.0)) for d in range(1, 21)]
    _write(f"{root}/landing/a.json", "\n".join(rows) + "\n")
    days = lambda: sorted(str(r[0])[-2:] for r in spark.read.parquet(f"{tables}/generation").select("settlement_date_partition").collect())
    jobs.ingest_generation(spark, f"{root}/landing", tables, today="2024-03-16")  # 11 to 9 days ago
    assert days() == ["05", "06", "07"]
    jobs.ingest_generation(spark, f"{root}/landing", tables, today="2024-03-16")  # the batch day
    assert days() == ["05", "06", "07", "08"]
    jobs.ingest_generation(spark, f"{root}/landing", tables, today="2024-03-20")  # runs were missed
    assert days() == ["05", "06", "07", "08", "09", "10", "11", "12"]


def test_capacity_merge_keeps_the_stored_day(spark):
    root = scratch_dir(spark, "jobs-capacity")
    cap = lambda u, mw: json.dumps({"bmUnit": u, "publishTime": "2024-01-01T10:00:00Z", "effectiveFrom": "2024-01-01T00:00:00Z",
                                    "psrType": "Nuclear", "installedCapacity": mw})
    _write(f"{root}/one/a.json", cap("T_A", 1.0) + "\n" + cap("T_B", 2.0) + "\n")
    _write(f"{root}/two/a.json", cap("T_A", 1.0) + "\n" + cap("T_C", 3.0) + "\n")
    for x in ("one", "two", "two"):
        jobs.ingest_capacity(spark, f"{root}/{x}", f"{root}/tables")
    assert spark.read.parquet(f"{root}/tables/capacity").count() == 3
