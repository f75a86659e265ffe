"""Feeds are landed by many tasks, and what lands is parsed once."""

import datetime as dt
import glob
import gzip
import json

import pytest
from pyspark.sql import functions as F

from wattframe import catalog
from wattframe.schemas import GENERATION_FEED
from wattframe.session import scratch_dir
from wattframe.sources.json_arrays import read_json_array
from wattframe.sources.sinks import write_json_arrays

LINEITEM = "l_orderkey long, l_partkey long, l_suppkey long, l_quantity double, l_shipdate timestamp_ntz"


@pytest.fixture
def landed(spark, monkeypatch):
    """Folders that a query asks for, by name; each file is a scan task of its own and small partitions stay apart."""
    folders = {}

    def remember(session, name):
        folders[name] = scratch_dir(session, name)
        return folders[name]

    monkeypatch.setattr(catalog, "scratch_dir", remember)
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.openCostInBytes": "128m"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield folders
    for k, v in before.items():
        spark.conf.set(k, v)


def lineitem(spark, rows):
    """A folder of tables whose lineitem has several files."""
    sf = scratch_dir(spark, "tables")
    spark.createDataFrame(rows, LINEITEM).repartition(5).write.parquet(f"{sf}/lineitem.parquet")
    return sf


def test_stream_lands_a_load_in_several_files(spark, landed):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    # Every key three times with other quantities, dealt over the files of the table; some rows lack a part of the key.
    rows = [(k, k % 5, 1, 10.0 + v, d) for k in range(20) for v in (2, 0, 1) for d in days] + [(None, 7, 1, 5.0, days[0]), (3, None, 1, 5.0, days[0])]
    out = catalog.queries()["stream_ingest_generation"](spark, lineitem(spark, rows))
    got = {(r.bm_unit, r.settlement_date, r.settlement_period, r.quantity) for r in out.collect()}
    want = {(f"{'I_' if k % 5 == 0 else 'IE' if k % 5 == 1 else 'T_'}{k % 5}", d, k % 48 + 1, 7.0 + k / 1e6 + (d.day < 3)) for k in range(20) for d in days}
    keyed = {r for r in got if r[0] is not None and r[2] is not None}
    rounded = lambda rs: {(*r[:3], round(r[3], 6)) for r in rs}
    assert rounded(keyed) == rounded(want)
    assert out.count() == len(want) + 3  # the row without a period is the same in both loads
    files = glob.glob(landed["stream-landing"] + "/*.json")
    assert len(files) > 4
    holds = {}
    for f in files:
        for r in map(json.loads, open(f)):
            holds.setdefault((r.get("bmUnit"), r["settlementDate"], r.get("settlementPeriod")), set()).add(f)
    assert all(len(f) == (1 if d.startswith("2024-01-03") else 2) for (_, d, _), f in holds.items())  # one file of each load


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_repeats_land_compressed_and_leave_no_shuffle_files(spark, landed):
    days = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    # Every key three times with other quantities, dealt over the files of the table; some rows lack a part of the key.
    rows = [(k, k % 5, 1, 10.0 + v, d) for k in range(20) for v in (2, 0, 1) for d in days] + [(None, 7, 1, 5.0, days[0]), (3, None, 1, 5.0, days[0])]
    sf, held = lineitem(spark, rows), shuffle_files(spark)
    changed = "spark.sql.streaming.stateStore.providerClass", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    settings = [spark.conf.get(k, None) for k in changed]
    out = catalog.queries()["stream_ingest_repeats"](spark, sf)
    assert not {n for n in shuffle_files(spark) - held if n.endswith(".data")}
    assert [spark.conf.get(k, None) for k in changed] == settings
    keyed = {(r.bm_unit, r.settlement_date, r.settlement_period, round(r.quantity, 6)) for r in out.collect()
             if r.bm_unit is not None and r.settlement_period is not None}
    want = {(f"{'I_' if k % 5 == 0 else 'IE' if k % 5 == 1 else 'T_'}{k % 5}", d, k % 48 + 1, round(7.0 + k / 1e6 + (d.day < 3), 6)) for k in range(20) for d in days}
    assert keyed == want and out.count() == len(want) + 3 and {r.settlement_period for r in out.collect()} >= {None}
    files = glob.glob(landed["stream-landing"] + "/*.json.gz")
    assert len(files) > 4 and not glob.glob(landed["stream-landing"] + "/*.json")
    holds = {}
    for f in files:
        texts = gzip.open(f, "rt").read().splitlines()
        assert all(texts.count(t) % 3 == 0 for t in texts)
        for r in map(json.loads, texts):
            holds.setdefault((r.get("bmUnit"), r["settlementDate"], r.get("settlementPeriod")), set()).add(f)
    assert all(len(f) == (1 if d.startswith("2024-01-03") else 2) for (_, d, _), f in holds.items())  # one file of each load
    state = glob.glob(landed["stream-ckpt"] + "/state/0/*/*")
    assert any(f.endswith(".zip") for f in state) and not any(f.endswith(".delta") for f in state)  # on disk, not on the heap


def test_arrays_land_in_several_files(spark, landed):
    rows = [(k, k, 1, float(k % 9), dt.datetime(2024, 1, 1 + k % 7)) for k in range(900)]
    out = catalog.queries()["json_array_generation"](spark, lineitem(spark, rows))
    assert out.count() == sum(k % 97 != 0 for k in range(900))
    files = glob.glob(landed["landing-array"] + "/*.txt")
    texts = [open(f).read() for f in files]
    assert len(files) > 1 and all(len(t.splitlines()) == 1 for t in texts)
    assert sum(len(json.loads(t)) - 1 for t in texts) == 900
    assert max(len(json.loads(t)) for t in texts) < 900


def test_arrays_are_parsed_once(spark):
    path = scratch_dir(spark, "arrays")
    feed = spark.range(100).select(*[(F.concat(F.lit("a}\""), "id") if t == "string" else F.col("id").cast(t)).alias(n)
                                     for n, t in ((f.name, f.dataType.simpleString()) for f in GENERATION_FEED.fields)])
    write_json_arrays(feed.union(feed.where("false")), path)
    back = read_json_array(spark, path, GENERATION_FEED)
    assert sorted(back.where("quantity is not null").select(*feed.columns).collect()) == sorted(feed.collect())
    plain = scratch_dir(spark, "arrays")
    write_json_arrays(feed.select("quantity", "settlementPeriod"), plain)
    back = read_json_array(spark, plain, GENERATION_FEED)
    assert back.where("quantity is not null").count() == 100
    assert "FileScan text" not in back._jdf.queryExecution().executedPlan().toString()
