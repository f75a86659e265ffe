"""One-line JSON arrays read by several tasks give the records that a whole-file reader gives."""

import json
import os
import random

import pytest

from wattframe.schemas import GENERATION_FEED
from wattframe.session import scratch_dir
from wattframe.sources.json_arrays import read_json_array


def rec(k, unit="T_A", **more):
    return {"bmUnit": unit, "halfHourEndTime": "2024-01-01T00:30:00Z", "nationalGridBmUnitId": "ng", "quantity": float(k),
            "settlementDate": "2024-01-01", "settlementPeriod": k % 48 + 1, **more}


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(text)


def rows(df):
    return sorted((tuple(r) for r in df.select(*GENERATION_FEED.names).collect()), key=str)


def plain(records):
    return sorted((tuple(r.get(n) for n in GENERATION_FEED.names) for r in records), key=str)


TRICKY = ["a}b", "},{", '"},{"bmUnit":"x"}', "}}}{{{", "\\}", '\\"}', "{", "[]},]", "", "}", '{"bmUnit":"y"}', "}{\n}", "é}ñ", "},{ \""]


@pytest.mark.parametrize("layout", ["line", "spaced", "pretty", "lines"])
def test_records_with_the_separator_in_texts(spark, layout):
    rng = random.Random(2)
    records = [rec(k, rng.choice(TRICKY) if k % 3 == 0 else "T_A", nationalGridBmUnitId=rng.choice(TRICKY) if k % 7 == 0 else None) for k in range(900)]
    dump = {"line": lambda x: json.dumps(x, separators=(",", ":")), "spaced": json.dumps, "pretty": lambda x: json.dumps(x, indent=1),
            "lines": lambda x: "\n".join(map(json.dumps, x)) + "\n"}[layout]
    folder = scratch_dir(spark, "arrays")
    put(folder, "a.json", dump(records[:700]))
    put(folder, "b.json", dump(records[700:]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")  # splits within the file, also within a record
    try:
        df = read_json_array(spark, folder, GENERATION_FEED, keep_corrupt=True)
        assert rows(df) == plain(records)
        assert df.where("_corrupt_record is not null").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_line_file_is_read_by_several_tasks(spark):
    folder = scratch_dir(spark, "one-line")
    records = [rec(k) for k in range(2000)]
    put(folder, "a.json", json.dumps(records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        df = read_json_array(spark, folder, GENERATION_FEED)
        assert df.rdd.getNumPartitions() > 4 and rows(df) == plain(records)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bodies_that_are_no_lists_of_flat_records(spark):
    folder = scratch_dir(spark, "odd")
    nested = [rec(1, other={"a": {"b": "}"}, "c": [1, {"d": 2}]}), rec(2), rec(3, other=[{"bmUnit": "no"}, {"bmUnit": "record"}])]
    put(folder, "null.json", "null")
    put(folder, "empty.json", "[]")
    put(folder, "blank.json", "")
    put(folder, "nested.json", json.dumps(nested))
    put(folder, "flat.json", json.dumps([rec(4), rec(5)]))
    put(folder, "wrong.json", json.dumps([rec(6) | {"quantity": "text"}]))
    got = read_json_array(spark, folder, GENERATION_FEED)
    assert rows(got.where("bmUnit is not null")) == plain(nested + [rec(4), rec(5), rec(6) | {"quantity": None}])
    assert "landed_at" in got.columns


def test_a_broken_file_is_set_aside_and_others_are_read(spark):
    folder = scratch_dir(spark, "broken")
    put(folder, "cut.json", json.dumps([rec(1), rec(2)])[:-40])
    put(folder, "good.json", json.dumps([rec(3)]))
    got = read_json_array(spark, folder, GENERATION_FEED, keep_corrupt=True)
    assert got.where("quantity = 3.0").count() == 1
    assert got.where("_corrupt_record is not null").count() >= 1
