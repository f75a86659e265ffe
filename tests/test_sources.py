"""Sources and cleaning: blank CSV cells, explode, JSON feeds, null records."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe import schemas
from wattframe.constants import FUEL_MAPPING_ROWS
from wattframe.operators import clean
from wattframe.session import scratch_dir
from wattframe.sources.files import read_csv, read_feed_json


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_blank_keys_join_each_other_only_when_kept(spark):
    root = scratch_dir(spark, "csv-test")
    mapping = "\n".join([",".join(schemas.FUEL_MAPPING.names)] + [",".join(r) for r in FUEL_MAPPING_ROWS])
    _write(f"{root}/mapping/m.csv", mapping + "\n")
    _write(f"{root}/info/i.csv", "bm_unit,fuel_type\nT_A,\nT_B,WIND\n")
    info_schema = T.StructType([T.StructField("bm_unit", T.StringType()), T.StructField("fuel_type", T.StringType())])
    for keep_blank, expected in ((True, 9 + 1), (False, 1 + 1)):
        m = read_csv(spark, f"{root}/mapping", schemas.FUEL_MAPPING, blank_as_null=not keep_blank)
        i = read_csv(spark, f"{root}/info", info_schema, blank_as_null=not keep_blank)
        joined = i.join(m, i.fuel_type == m.bm_fuel_type, "left")
        assert joined.count() == expected
    m = read_csv(spark, f"{root}/mapping", schemas.FUEL_MAPPING, blank_as_null=False)
    assert m.where(F.col("bm_fuel_type") == "").count() == 9
    assert m.where(F.col("psr_type") == "").count() == 8


def test_plant_id_explode_splits_only_settlement_ids(spark):
    raw = spark.createDataFrame([(1, "A", "A, B", "C, D"), (2, "E", "F", "G"), (3, "X", "X,,Y", "Z")],
                                "dictionary_id long, name string, sett_bmu_id string, ngc_bmu_id string")
    got = [(r.dictionary_id, r.bm_unit, r.national_grid_bm_unit_id) for r in clean.plant_ids(raw).collect()]
    assert got == [(1, "A", "C, D"), (1, "B", "C, D"), (2, "F", "G"), (3, "X", "Z"), (3, "", "Z"), (3, "Y", "Z")]


def test_generation_feed_json_with_null_body_and_bad_values(spark):
    root = scratch_dir(spark, "json-test")
    _write(f"{root}/a.json",
           '{"bmUnit":"T_A","halfHourEndTime":"2024-03-19T00:30:00Z","nationalGridBmUnitId":"A",'
           '"quantity":1.5,"settlementDate":"2024-03-19","settlementPeriod":1,"extra":1}\n'
           '{"bmUnit":"T_B","halfHourEndTime":"zzz","quantity":"text","settlementDate":"2024-03-19",'
           '"settlementPeriod":2}\n')
    _write(f"{root}/b.json", "null\n")
    df = clean.clean_generation(read_feed_json(spark, root, schemas.GENERATION_FEED))
    assert df.columns == list(schemas.GENERATION_COLUMNS)
    rows = {r.bm_unit: r for r in df.collect()}
    assert set(rows) == {"T_A", "T_B"}  # the null body gives no row
    assert rows["T_B"].half_hour_end_time is None and rows["T_B"].quantity is None
    assert str(rows["T_A"].settlement_date_partition) == "2024-03-19"


def test_capacity_rows_without_unit_are_dropped(spark):
    raw = spark.createDataFrame([("T_A", "2024-01-01", "2024-01-01", "Nuclear", 1.0),
                                 (None, "2024-01-01", "2024-01-01", "Nuclear", 2.0)],
                                "bmUnit string, publishTime string, effectiveFrom string, psrType string, "
                                "installedCapacity double")
    out = clean.clean_capacity(raw)
    assert out.columns == list(schemas.CAPACITY_COLUMNS)
    assert out.count() == 1


def test_city_reference_keep_first_and_official_filter(spark):
    file_rows = spark.createDataFrame(
        [(0, "Saint-Asaph", 1.0, 1.0), (1, "Newcastle", 2.0, 2.0), (2, "Newcastle-upon-Tyne", 3.0, 3.0),
         (3, "Swansea", 4.0, 4.0), (4, "Elsewhere", 5.0, 5.0)],
        "ord long, city string, latitude double, longitude double")
    official = spark.createDataFrame([("Newcastle upon Tyne",), ("Saint Asaph",), ("Swansea",), ("Douglas",)],
                                     "city string")
    got = {r.city: (r.latitude, r.longitude) for r in clean.city_reference(file_rows, official).collect()}
    assert got["Newcastle upon Tyne"] == (2.0, 2.0)     # first file row wins
    assert got["Saint Asaph"] == (1.0, 1.0)             # file row before the manual one
    assert got["Swansea"] == (4.0, 4.0)
    assert got["Douglas"] == (55.5499978, -3.8499966)  # manual row kept when official
    assert "Elsewhere" not in got


def test_keep_first_follows_csv_file_order(spark):
    from wattframe.operators.dedup import keep_first
    from wattframe.schemas import CITY_COORDINATES

    root = scratch_dir(spark, "order-test")
    _write(f"{root}/c.csv", "city,lat,lng\nBath,1.0,1.0\nYork,2.0,2.0\nBath,3.0,3.0\nYork,4.0,4.0\n")
    df = read_csv(spark, root, CITY_COORDINATES, with_file_order="ord")
    got = {r.city: r.lat for r in keep_first(df, ["city"], ["ord"]).collect()}
    assert got == {"Bath": 1.0, "York": 2.0}


def test_read_csv_columns_by_name_with_extra_columns(spark):
    from wattframe.sources.files import read_csv_columns

    root = scratch_dir(spark, "bycol-test")
    _write(f"{root}/p.csv", "note,longitude,dictionary_id,latitude\nx,-1.5,7,52.0\ny,oops,8,\n")
    df = read_csv_columns(spark, root, {"dictionary_id": T.LongType(), "latitude": T.DoubleType(),
                                        "longitude": T.DoubleType()})
    assert df.columns == ["dictionary_id", "latitude", "longitude"]
    got = {r.dictionary_id: (r.latitude, r.longitude) for r in df.collect()}
    assert got == {7: (52.0, -1.5), 8: (None, None)}  # blank and unparseable values become NULL
