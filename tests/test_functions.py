import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattframe.functions import (
    clean_city,
    explode_list,
    haversine_km,
    is_interconnector,
    format_timestamp,
    parse_timestamp,
    settlement_day,
    snake_case,
    strip_whitespace,
    total,
)


def test_snake_case_names():
    assert snake_case("bmUnit") == "bm_unit"
    assert snake_case("nationalGridBmUnitId") == "national_grid_bm_unit_id"
    assert snake_case("settlement_date_partition") == "settlement_date_partition"
    assert snake_case("VendorID") == "vendor_id"
    assert snake_case("HTTPStatusCode") == "http_status_code"
    assert snake_case("halfHourEndTime") == "half_hour_end_time"


def test_interconnector_like_is_single_char_wildcard(spark):
    df = spark.createDataFrame([(u,) for u in ["I_IED", "IE", "INT", "I", "iA", "T_X"]], "u string")
    got = {r.u: r.f for r in df.select("u", is_interconnector(F.col("u")).alias("f")).collect()}
    assert got == {"I_IED": True, "IE": True, "INT": True, "I": False, "iA": False, "T_X": False}


def test_clean_city(spark):
    rows = ["Newcastle-upon-Tyne", "Newcastle", "St-Albans", "Caerdydd", "St Asaph"]
    df = spark.createDataFrame([(r,) for r in rows], "c string")
    got = [r.x for r in df.select(clean_city(F.col("c")).alias("x")).collect()]
    assert got == ["Newcastle upon Tyne", "Newcastle upon Tyne", "St Albans", "Cardiff", "St Asaph"]


def test_strip_and_explode_keep_empty_tokens(spark):
    df = spark.createDataFrame([("A, B",), ("X,,Y ",), (" \tZ\n",)], "s string")
    def tokens(keep_empty):
        out = df.select(explode_list(F.col("s"), keep_empty=keep_empty).alias("t"))
        return [r.t for r in out.select(strip_whitespace(F.col("t")).alias("t")).collect()]

    assert tokens(True) == ["A", "B", "X", "", "Y", "Z"]
    assert tokens(False) == ["A", "B", "X", "Y", "Z"]


def test_haversine_known_distance(spark):
    df = spark.createDataFrame([(51.5074, -0.1278, 48.8566, 2.3522), (50.0, -1.0, 50.0, -1.0)],
                               "a double, b double, c double, d double")
    got = [r.d for r in df.select(haversine_km(*[F.col(c) for c in "abcd"]).alias("d")).collect()]
    assert abs(got[0] - 343.56) < 0.5
    assert got[1] == 0.0


def test_totals_keep_small_values_and_nan(spark):
    small = spark.createDataFrame([(0.00004,)] * 1000, "q double").repartition(3)
    assert math.isclose(small.agg(total(F.col("q"))).first()[0], 0.04, rel_tol=1e-9)
    odd = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "q double")
    assert math.isnan(odd.agg(total(F.col("q"))).first()[0])


def test_timestamps_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame([("2024-03-10T02:30:00Z",), ("2024-11-03 01:30:00",), ("2024-11-03T07:30:00+02:00",), ("2024-01-02",)], "t string")
    seen = []
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            ts = parse_timestamp(F.col("t"))
            seen.append([tuple(r) for r in df.select(ts.cast("string"), settlement_day(ts).cast("string")).collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert seen[0] == seen[1] == seen[2]
    assert seen[0] == [("2024-03-10 02:30:00", "2024-03-10"), ("2024-11-03 01:30:00", "2024-11-03"),
                       ("2024-11-03 05:30:00", "2024-11-03"), ("2024-01-02 00:00:00", "2024-01-02")]


def test_bad_timestamp_gives_null_not_error(spark):
    df = spark.createDataFrame([("zzz",), ("2024-03-19T00:30:00Z",), (None,)], "t string")
    got = [r.ts for r in df.select(parse_timestamp(F.col("t")).alias("ts")).collect()]
    assert got[0] is None and got[2] is None
    assert got[1] is not None
    assert df.select(parse_timestamp(F.col("t")).alias("ts")).schema["ts"].dataType == T.TimestampNTZType()


def test_parse_and_format_by_pattern(spark):
    import datetime as dt

    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            df = spark.createDataFrame([("31/03/2024 01:30", "20240331 0130+0200"), ("31/02/2024 01:30", "x"), (None, None), ("31/03/2024", "")],
                                       "a string, b string")
            ts = parse_timestamp(F.col("a"), "dd/MM/yyyy HH:mm")
            rows = df.select(ts.alias("a"), parse_timestamp(F.col("b"), "yyyyMMdd HHmmxx").alias("b"), format_timestamp(ts, "yyyy/MM/dd HHmm").alias("c")).collect()
            assert tuple(rows[0]) == (dt.datetime(2024, 3, 31, 1, 30), dt.datetime(2024, 3, 30, 23, 30), "2024/03/31 0130")
            assert all(tuple(r) == (None, None, None) for r in rows[1:])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
