"""Benchmark of the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` (default 8). Each query is forced to run completely
through the ``noop`` sink (no collect), once to warm up (JIT) and then
``$BENCH_REPEAT`` times (default 5); the median is reported. Prints one JSON
line. The Spark cache is cleared before every timed run, so cached
dimensions are rebuilt each time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wattframe import fixtures as fx  # noqa: E402
from wattframe.catalog import queries  # noqa: E402
from wattframe.plans import incremental as inc  # noqa: E402
from wattframe.schemas import PARTITION_COLUMN  # noqa: E402
from wattframe.session import build_session, scratch_dir  # noqa: E402

HEADLINE = (
    "daily_generation_by_unit",
    "generation_360_view",
    "generation_360_view_literal",
    "county_top_source",
    "total_by_fuel_county",
    "capacity_as_of",
    "nearest_region",
    "plant_locations",
    "plant_id_explode",
    "dedup_generation",
    "missing_settlement_dates",
)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _merge_one_day(spark, sf):
    """Set-up (untimed): a table holding the ten days before the last one.
    Timed: merge of the last day plus a re-run of the day before it."""
    g = fx.generation(spark, sf)
    last = g.agg(F.max(PARTITION_COLUMN)).first()[0]
    part = F.col(PARTITION_COLUMN)
    path = scratch_dir(spark, "bench-merge")
    inc.merge_days(g.where(part.between(F.date_sub(F.lit(last), 10), F.date_sub(F.lit(last), 1))), path)
    batch = g.where(part >= F.date_sub(F.lit(last), 1))

    def timed():
        inc.merge_days(batch, path)

    return timed


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": "8g"})
    reg = queries()
    results: dict[str, float] = {}
    for key in HEADLINE:
        fn = reg[key]
        _run(fn(spark, sf))  # warm-up
        times = []
        for _ in range(repeat):
            spark.catalog.clearCache()  # every run rebuilds its cached dimensions
            t0 = time.perf_counter()
            _run(fn(spark, sf))
            times.append(time.perf_counter() - t0)
        results[key] = round(statistics.median(times), 3)

    timed = _merge_one_day(spark, sf)
    timed()
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        timed()
        times.append(time.perf_counter() - t0)
    results["incremental_merge_one_day"] = round(statistics.median(times), 3)

    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf_name) if sf_name.replace(".", "", 1).isdigit() else sf_name,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
