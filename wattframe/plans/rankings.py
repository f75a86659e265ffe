"""The county ranking kept up to date by differences.

After a load only the facts of the touched days are read. Their sums per unit replace those of
the same days; the differences, new minus old, are added to the totals per unit, carried through
the unit profile to the totals per county and category, and only counties with a difference are
ranked again. If the profile has changed, county totals follow from the unit totals (no facts).

State below one folder::

    daily/version=v                       sums per day and unit, as load v found them, sorted by day
    units, counties, ranking / slot=0|1   totals and ranking, written alternately
    log                                   (version, day, n_rows, profile), appended last

The log decides: a day's sums are those of its last version, the slot is that of the last
version. A run that stops before it has appended to the log has changed nothing; run again, it
writes the same version over.

Totals are sums of doubles, like a full computation, but added in another order; a unit or pair
disappears with its last positive row (counted, not judged by its sum). Values that are not finite
are counted beside the sums, so that a corrected NaN leaves no trace.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattframe.constants import INTERCONNECTOR_LABEL
from wattframe.operators.broadcast import DEFAULT_MAX_BROADCAST_BYTES, broadcast_if_small
from wattframe.operators.dims import COPIES, UnitDims, fill_unmatched, unit_dim
from wattframe.schemas import PARTITION_COLUMN
from wattframe.session import scratch_dir
from wattframe.sources.files import read_days, stored_days, table_exists

#: What is kept of a set of positive values: their number, the sum of the finite ones, how many are not.
SUMS = ("n", "mwh", "n_nan", "n_inf")
_SUM_TYPES = "n long, mwh double, n_nan long, n_inf long"
_UNITS = f"bm_unit string, {_SUM_TYPES}"
_DAILY = f"day date, {_UNITS}"
_COUNTIES = f"county string, source_category string, {_SUM_TYPES}"
_RANKING = "county string, source_category string, total_daily_generation_mwh double"
_LOG = "version long, day date, n_rows long, profile string"


def positive_sums(q: Column) -> list[Column]:
    """Aggregates ``SUMS`` of the positive values of a column (the others must be filtered)."""
    infinite = q == F.lit(float("inf"))
    return [F.count("*").alias("n"), F.coalesce(F.sum(F.when(~F.isnan(q) & ~infinite, q)), F.lit(0.0)).alias("mwh"),
            F.count_if(F.isnan(q)).alias("n_nan"), F.count_if(infinite).alias("n_inf")]


def added(df: DataFrame, *by: str) -> DataFrame:
    """``SUMS`` added per group; groups without a row left are gone."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(c) for c in SUMS])


def value() -> Column:
    """The plain sum that ``SUMS`` stand for."""
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    return F.when(F.col("n_nan") > 0, nan).when(F.col("n_inf") > 0, inf).otherwise(F.col("mwh"))


def top_per_county(totals: DataFrame) -> DataFrame:
    """The leading category of every county of (county, source_category, SUMS); ties: the first name."""
    order = Window.partitionBy("county").orderBy(F.col("total_daily_generation_mwh").desc(), F.col("source_category").asc_nulls_last())
    ranked = totals.select("county", "source_category", value().alias("total_daily_generation_mwh")).withColumn("rn", F.row_number().over(order))
    return ranked.where("rn = 1").drop("rn")


def by_county(per_unit: DataFrame, profile: DataFrame, *more: str) -> DataFrame:
    """Sums per unit (and ``more`` columns) -> sums per (county, source_category, more), interconnectors left out."""
    joined = fill_unmatched(per_unit.join(profile, "bm_unit", "left")).where(F.col("source_category") != F.lit(INTERCONNECTOR_LABEL))
    copies = F.coalesce(F.col(COPIES), F.lit(1))
    return added(joined.select("county", "source_category", *more, *[(F.col(c) * copies).alias(c) for c in SUMS]), "county", "source_category", *more)


def profile_of(dims: UnitDims, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """(bm_unit, source_category, county, copies) as a written table, broadcast if it is small."""
    return broadcast_if_small(unit_dim(dims, ("source_category", "county")), max_broadcast_bytes, "unit-profile")[0]


def _fingerprint(profile: DataFrame) -> str:
    row = profile.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*profile.columns)).alias("x")).first()
    return f"{row['n']}:{row['x']}"


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    return spark.read.schema(_LOG).parquet(f"{root}/log") if table_exists(spark, f"{root}/log") else None


def _state(spark: SparkSession, root: str, name: str, version: int | None, schema: str) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{name}/slot={version % 2}")


def _day_in(days: list[str]) -> Column:
    return F.col("day").isin([dt.date.fromisoformat(d) for d in days])


def _minus(df: DataFrame) -> DataFrame:
    return df.withColumns({c: -F.col(c) for c in SUMS})


def refresh(spark: SparkSession, root: str, table_path: str, dims: UnitDims, days: list,
            max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> None:
    """Bring totals and ranking below ``root`` up to date with the fact table after a load that touched ``days``."""
    log = _log(spark, root)
    version = log.agg(F.max("version")).first()[0] if log is not None else None
    profile = profile_of(dims, max_broadcast_bytes)
    mark = _fingerprint(profile)
    days = sorted(str(d) for d in days if d is not None)

    # The touched days: what was counted of them, and what they hold now.
    before = spark.createDataFrame([], _UNITS)
    if log is not None and days:
        last = log.where(F.col("day").cast("string").isin(days)).groupBy("day").agg(
            F.max("version").alias("version"), F.max_by("n_rows", "version").alias("n_rows"))
        by_version: dict[int, list[str]] = {}
        for r in last.where("n_rows > 0").collect():  # one row per touched day
            by_version.setdefault(r["version"], []).append(str(r["day"]))
        for v, of in by_version.items():
            rows = spark.read.schema(_DAILY).parquet(f"{root}/daily/version={v}").where(_day_in(of))
            before = before.unionByName(rows.drop("day"))
    number = 0 if version is None else version + 1
    daily = f"{root}/daily/version={number}"
    held = sorted(set(days) & stored_days(spark, table_path, PARTITION_COLUMN))
    found: dict[str, int] = {}
    now = spark.createDataFrame([], _UNITS)
    if held:
        facts = read_days(spark, table_path, held).where(F.col("quantity") > 0)
        sums = facts.groupBy(F.col(PARTITION_COLUMN).alias("day"), "bm_unit").agg(*positive_sums(F.col("quantity")))
        # A rebalance keeps the rows of a day together (a hot day is split), without computing the sums twice to sample ranges.
        sums.hint("rebalance", "day").sortWithinPartitions("day", "bm_unit").write.mode("overwrite").parquet(daily)
        written = spark.read.schema(_DAILY).parquet(daily)
        found = {str(r[0]): r[1] for r in written.groupBy("day").count().collect()}  # one row per calendar day
        now = written.drop("day")

    delta = added(now.unionByName(_minus(before)), "bm_unit").where("n != 0 or mwh != 0 or n_nan != 0 or n_inf != 0")
    path = scratch_dir(spark, "ranking-delta")
    delta.write.parquet(path)
    delta = spark.read.schema(_UNITS).parquet(path)

    def put(df: DataFrame, name: str, schema: str) -> DataFrame:
        df.coalesce(8).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{root}/{name}/slot={number % 2}")
        return _state(spark, root, name, number, schema)

    units = put(added(_state(spark, root, "units", version, _UNITS).unionByName(delta), "bm_unit").where("n > 0"), "units", _UNITS)
    same = version is not None and log.where(F.col("version") == version).first()["profile"] == mark
    if same:
        change = by_county(delta, profile)
        counties = _state(spark, root, "counties", version, _COUNTIES).unionByName(change)
        counties = put(added(counties, "county", "source_category").where("n > 0"), "counties", _COUNTIES)
        touched = change.select(F.col("county").alias("of")).distinct()
        again = counties.join(touched, F.col("county").eqNullSafe(F.col("of")), "left_semi")
        rest = _state(spark, root, "ranking", version, _RANKING).join(touched, F.col("county").eqNullSafe(F.col("of")), "left_anti")
        ranking_now = rest.unionByName(top_per_county(again))
    else:
        counties = put(by_county(units, profile), "counties", _COUNTIES)
        ranking_now = top_per_county(counties)
    put(ranking_now, "ranking", _RANKING)
    rows = [(number, d, found.get(d, 0), mark) for d in days] or [(number, None, 0, mark)]
    spark.createDataFrame(rows, "version long, day string, n_rows long, profile string").select(
        "version", F.to_date("day").alias("day"), "n_rows", "profile").coalesce(1).write.mode("append").parquet(f"{root}/log")


def _current(spark: SparkSession, root: str) -> int | None:
    log = _log(spark, root)
    return None if log is None else log.agg(F.max("version")).first()[0]


def unit_totals(spark: SparkSession, root: str) -> DataFrame:
    """(bm_unit, total_daily_generation_mwh) of all loads so far."""
    return _state(spark, root, "units", _current(spark, root), _UNITS).select("bm_unit", value().alias("total_daily_generation_mwh"))


def county_totals(spark: SparkSession, root: str) -> DataFrame:
    """(county, source_category, total_daily_generation_mwh), equal to ``views.generation_by_county_source``."""
    return _state(spark, root, "counties", _current(spark, root), _COUNTIES).select(
        "county", "source_category", value().alias("total_daily_generation_mwh"))


def ranking(spark: SparkSession, root: str) -> DataFrame:
    """The leading category of every county, equal to ``views.county_top_source`` over all facts."""
    return _state(spark, root, "ranking", _current(spark, root), _RANKING)
