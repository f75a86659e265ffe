"""Generation per county and category over any range of days, from running totals.

The table holds, per (county, source_category) and day with generation, the total from the
beginning through that day, in folders of a month. Every month begins with the totals brought
over from the month before (under its last day), so that one month answers "through day d" for
all pairs. A range is then the difference of two rows per pair: two months are read, whatever
the length of the range, and no facts.

After a load the months from the earliest touched day on are replaced, starting from the totals
brought over into it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattframe.operators.broadcast import DEFAULT_MAX_BROADCAST_BYTES
from wattframe.operators.dims import UnitDims
from wattframe.plans.rankings import SUMS, by_county, positive_sums, profile_of, top_per_county, value
from wattframe.sources.files import read_days, stored_days
from wattframe.sources.sinks import write_days

MONTH = "month"
_PAIR = ["county", "source_category"]
_COLUMNS = [*_PAIR, "day", *SUMS]


def _county_days(daily: DataFrame, dims: UnitDims, max_broadcast_bytes: int) -> DataFrame:
    """(county, source_category, day, SUMS) of daily totals per unit (bm_unit, settlement_date, daily_generation_mwh)."""
    per_day = daily.where(F.col("daily_generation_mwh") > 0).groupBy("bm_unit", F.to_date("settlement_date").alias("day")).agg(
        *positive_sums(F.col("daily_generation_mwh")))
    return by_county(per_day, profile_of(dims, max_broadcast_bytes), "day").select(*_COLUMNS)


def _with_months(rows: DataFrame, brought: DataFrame | None) -> DataFrame:
    """Running totals of ``rows`` by month, on top of the totals ``brought`` over into the first month.

    For every pair a row of zeros is added before each month after its first one; summed up, it is
    what the pair brings into that month.
    """
    start = F.trunc("day", "month")
    data = rows.select(*_COLUMNS, start.alias("start"), F.lit(0).alias("late"))
    if brought is not None:
        data = data.unionByName(brought.select(*_COLUMNS, F.date_add("day", 1).alias("start"), F.lit(1).alias("late")))
    last = data.agg(F.max("start")).scalar()
    later = data.groupBy(*_PAIR).agg(F.min("start").alias("first")).withColumn("last", last).where("first < last")
    months = F.explode(F.sequence(F.add_months("first", 1), F.col("last"), F.expr("interval 1 month"))).alias("start")
    zeros = later.select(*_PAIR, months).select(
        *_PAIR, F.date_sub("start", 1).alias("day"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mwh"),
        F.lit(0).cast("long").alias("n_nan"), F.lit(0).cast("long").alias("n_inf"), "start", F.lit(1).alias("late"))
    upto = Window.partitionBy(*_PAIR).orderBy("day", "late", "start").rowsBetween(Window.unboundedPreceding, 0)
    total = data.unionByName(zeros).select(*_PAIR, "day", *[F.sum(c).over(upto).alias(c) for c in SUMS],
                                           F.date_format("start", "yyyy-MM").alias(MONTH))
    return total


def build(daily: DataFrame, dims: UnitDims, path: str, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> None:
    """Write the table for the daily totals per unit (bm_unit, settlement_date, daily_generation_mwh) of all days."""
    write_days(_with_months(_county_days(daily, dims, max_broadcast_bytes), None), path, MONTH, ("county", "source_category"))


def refresh(daily: DataFrame, dims: UnitDims, path: str, days: list, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> None:
    """Replace the months from the earliest of ``days`` on. ``daily`` is pruned to these months by its
    ``settlement_date_partition``, if it has that column. A changed unit profile needs :func:`build`."""
    spark = daily.sparkSession
    days = sorted(str(d) for d in days if d is not None)
    if not days:
        return
    stored = sorted(stored_days(spark, path, MONTH))
    month = days[0][:7]
    if not stored or month <= stored[0]:
        return build(daily, dims, path, max_broadcast_bytes)
    month = min(month, _next(stored[-1]))
    begin = F.lit(f"{month}-01").cast("date")
    if month in stored:
        brought = _read(spark, path, month).where(F.col("day") < begin)
    else:
        brought = _through(spark, path, _last_day(stored[-1])).withColumn("day", F.date_sub(begin, 1))
    if "settlement_date_partition" in daily.columns:
        daily = daily.where(F.col("settlement_date_partition") >= begin)
    rows = _county_days(daily.where(F.to_date("settlement_date") >= begin), dims, max_broadcast_bytes)
    staged = _staged(_with_months(rows, brought), "running-totals")
    write_days(staged, path, MONTH, ("county", "source_category"))


def _staged(df: DataFrame, name: str) -> DataFrame:
    from wattframe.operators.broadcast import materialised

    return materialised(df, name)[0]


def _next(month: str) -> str:
    y, m = map(int, month.split("-"))
    return f"{y + m // 12:04d}-{m % 12 + 1:02d}"


def _last_day(month: str) -> dt.date:
    return dt.date.fromisoformat(f"{_next(month)}-01") - dt.timedelta(days=1)


def _read(spark: SparkSession, path: str, month: str) -> DataFrame:
    return read_days(spark, path, [month], partition_col=MONTH).select(*_COLUMNS)


def _through(spark: SparkSession, path: str, day: dt.date) -> DataFrame | None:
    """(pair, SUMS) through ``day``, from one month; None before the first."""
    stored = sorted(m for m in stored_days(spark, path, MONTH) if m <= day.isoformat()[:7])
    if not stored:
        return None
    rows = _read(spark, path, stored[-1]).where(F.col("day") <= F.lit(day.isoformat()).cast("date"))
    last = F.max_by(F.struct(*SUMS), "day").alias("s")
    return rows.groupBy(*_PAIR).agg(last).select(*_PAIR, *[F.col(f"s.{c}").alias(c) for c in SUMS])


def sums_between(spark: SparkSession, path: str, first: dt.date | str | None, last: dt.date | str | None) -> DataFrame:
    """(county, source_category, SUMS) of the days [first, last]; None leaves a side open."""
    stored = sorted(stored_days(spark, path, MONTH))
    empty = spark.createDataFrame([], "county string, source_category string, n long, mwh double, n_nan long, n_inf long")
    if not stored:
        return empty
    end = _through(spark, path, _last_day(stored[-1]) if last is None else dt.date.fromisoformat(str(last)))
    if end is None:
        return empty
    start = None if first is None else _through(spark, path, dt.date.fromisoformat(str(first)) - dt.timedelta(days=1))
    if start is not None:
        s = start.select(*[F.col(c).alias(f"s_{c}") for c in start.columns])
        end = end.join(s, F.col("county").eqNullSafe(F.col("s_county")) & F.col("source_category").eqNullSafe(F.col("s_source_category")), "left")
        end = end.select(*_PAIR, *[(F.col(c) - F.coalesce(F.col(f"s_{c}"), F.lit(0))).alias(c) for c in SUMS])
    return end.where("n > 0")


def generation_by_county_source(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Like ``views.generation_by_county_source`` over the days [first, last]."""
    return sums_between(spark, path, first, last).select(*_PAIR, value().alias("total_daily_generation_mwh"))


def county_top_source(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """Like ``views.county_top_source`` over the days [first, last]."""
    return top_per_county(sums_between(spark, path, first, last))
