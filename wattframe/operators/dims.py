"""Unit dimensions: capacity picks and the folded unit dimension.

The enrichment query joins the fact table to eight dimension roles, all
keyed (directly or through another dimension) by ``bm_unit``. Instead of
eight joins over the fact table, :func:`unit_dim` joins the dimensions
to each other once, keeping every fan-out row, so the fact table needs a
single join. Equal rows are folded into one with their number (``COPIES``): a unit with a long
publication history has as many rows as it has different attribute values. Repeating each joined
fact ``COPIES`` times gives exactly the rows of the eight-join form; totals are multiplied by it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.fuel import is_interconnector, resolve_fuel_attribute
from wattframe.constants import INTERCONNECTOR_LABEL


@dataclass(frozen=True)
class UnitDims:
    """Dimension tables of the enrichment.

    capacity:       bm_unit, publish_time, effective_from, psr_type, installed_capacity
    plant_id:       bm_unit, dictionary_id, name, ...
    plant_location: dictionary_id, latitude, longitude, city, county, gsp_name, ...
    unit_info:      bm_unit, fuel_type
    fuel_mapping:   new_psr_type, fuel_category, bm_fuel_type, psr_type, source_category
    overlay:        bm_unit, psr_type, latitude, longitude, ...
    """

    capacity: DataFrame
    plant_id: DataFrame
    plant_location: DataFrame
    unit_info: DataFrame
    fuel_mapping: DataFrame
    overlay: DataFrame

    def with_capacity(self, capacity: DataFrame) -> "UnitDims":
        return replace(self, capacity=capacity)


COPIES = "_copies"

RESOLVED_ATTRIBUTES = ("inferred_fuel_type", "new_psr_type", "fuel_category", "source_category")

UNIT_DIM_COLUMNS = (
    "bmrs_capacity_psr_type",
    "bmrs_unit_fuel_type",
    "inferred_fuel_type",
    "new_psr_type",
    "fuel_category",
    "source_category",
    "installed_capacity",
    "name",
    "longitude",
    "latitude",
    "city",
    "county",
    "gsp_name",
)


def _mapping_role(mapping: DataFrame, key: str, key_alias: str, prefix: str) -> DataFrame:
    return mapping.select(
        F.col(key).alias(key_alias),
        F.col("new_psr_type").alias(f"{prefix}_new_psr_type"),
        F.col("fuel_category").alias(f"{prefix}_fuel_category"),
        F.col("source_category").alias(f"{prefix}_source_category"),
    )


def unit_dim(dims: UnitDims, columns: tuple[str, ...] = UNIT_DIM_COLUMNS) -> DataFrame:
    """One row per unit and distinct combination of ``columns``, with its number (``COPIES``).

    Units that appear in no dimension are absent; callers left-join and then
    apply :func:`fill_unmatched` for the interconnector rule.
    """
    mapping = dims.fuel_mapping
    keys = (
        dims.capacity.select("bm_unit")
        .unionByName(dims.plant_id.select("bm_unit"))
        .unionByName(dims.unit_info.select("bm_unit"))
        .unionByName(dims.overlay.select("bm_unit"))
        .where(F.col("bm_unit").isNotNull())
        .distinct()
    )
    cap = dims.capacity.select(
        "bm_unit",
        F.col("psr_type").alias("bmrs_capacity_psr_type"),
        "installed_capacity",
    ).join(_mapping_role(mapping, "psr_type", "bmrs_capacity_psr_type", "by_capacity"), "bmrs_capacity_psr_type", "left")
    loc = dims.plant_location.select(
        "dictionary_id",
        F.col("latitude").alias("site_latitude"),
        F.col("longitude").alias("site_longitude"),
        "city",
        "county",
        "gsp_name",
    )
    pid = dims.plant_id.select("bm_unit", "dictionary_id", "name").join(loc, "dictionary_id", "left")
    info = dims.unit_info.select("bm_unit", F.col("fuel_type").alias("bmrs_unit_fuel_type")).join(
        _mapping_role(mapping, "bm_fuel_type", "bmrs_unit_fuel_type", "by_info"), "bmrs_unit_fuel_type", "left"
    )
    ovl = dims.overlay.select(
        "bm_unit",
        F.col("psr_type").alias("overlay_psr_type"),
        F.col("latitude").alias("overlay_latitude"),
        F.col("longitude").alias("overlay_longitude"),
    ).join(_mapping_role(mapping, "psr_type", "overlay_psr_type", "by_overlay"), "overlay_psr_type", "left")

    ud = keys.join(cap, "bm_unit", "left").join(pid, "bm_unit", "left").join(info, "bm_unit", "left").join(ovl, "bm_unit", "left")

    unit, cap_type = F.col("bm_unit"), F.col("bmrs_capacity_psr_type")
    info_fuel = F.col("bmrs_unit_fuel_type")
    derived = {
        "inferred_fuel_type": resolve_fuel_attribute(
            unit, cap_type, F.coalesce(cap_type, info_fuel), info_fuel, F.col("overlay_psr_type")
        ),
        "longitude": F.coalesce(F.col("site_longitude"), F.col("overlay_longitude")),
        "latitude": F.coalesce(F.col("site_latitude"), F.col("overlay_latitude")),
    }
    for attr in ("new_psr_type", "fuel_category", "source_category"):
        derived[attr] = resolve_fuel_attribute(
            unit, cap_type, F.col(f"by_capacity_{attr}"), F.col(f"by_info_{attr}"), F.col(f"by_overlay_{attr}")
        )
    out = [F.col("bm_unit")]
    for c in columns:
        out.append(derived[c].alias(c) if c in derived else F.col(c))
    return ud.select(*out).groupBy("bm_unit", *columns).agg(F.count("*").alias(COPIES))


def repeated(joined: DataFrame) -> DataFrame:
    """Each row ``COPIES`` times (once without a match), the column dropped."""
    times = F.coalesce(F.col(COPIES), F.lit(1)).cast("int")
    return joined.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).drop("_copy", COPIES)


def fill_unmatched(df: DataFrame, unit_col: str = "bm_unit") -> DataFrame:
    """After ``fact LEFT JOIN unit_dim``: facts of units without any dimension
    row still get the interconnector label from their unit id."""
    label = F.when(is_interconnector(F.col(unit_col)), F.lit(INTERCONNECTOR_LABEL))
    for attr in RESOLVED_ATTRIBUTES:
        if attr in df.columns:
            df = df.withColumn(attr, F.coalesce(F.col(attr), label))
    return df


def capacity_latest(capacity: DataFrame) -> DataFrame:
    """Latest publication per unit.

    Order: publish_time, then effective_from, installed_capacity, psr_type, all descending with
    NULL lowest. An aggregate (sorted, as the struct holds a string): a unit with a very long
    history is one row per task after the partial step.
    """
    best = F.max(F.struct("publish_time", "effective_from", "installed_capacity", "psr_type")).alias("best")
    return capacity.groupBy("bm_unit").agg(best).select(
        "bm_unit", "best.publish_time", "best.effective_from", "best.psr_type", "best.installed_capacity"
    )


def capacity_intervals(capacity: DataFrame) -> DataFrame:
    """Capacity versions with the time until which each is in force (NULL: still).

    Of versions with one ``effective_from`` the later publication counts, then the larger
    capacity, then the greater type. Versions without ``effective_from`` are never in force.
    """
    best = F.max(F.struct("publish_time", "installed_capacity", "psr_type")).alias("v")
    versions = capacity.where(F.col("effective_from").isNotNull()).groupBy("bm_unit", "effective_from").agg(best)
    until = F.lead("effective_from").over(Window.partitionBy("bm_unit").orderBy("effective_from"))
    return versions.select("bm_unit", "effective_from", "v.publish_time", "v.psr_type", "v.installed_capacity", until.alias("until"))


def capacity_as_of(unit_days: DataFrame, capacity: DataFrame, day_col: str = "settlement_date") -> DataFrame:
    """For each (bm_unit, day) the capacity version in force: the greatest ``effective_from <= day``
    (ties: later publish_time, larger capacity).

    ``unit_days`` should be distinct (bm_unit, day) pairs. Validity intervals do not overlap, so a
    unit-day meets one version at most and nothing is aggregated after the join.
    """
    u, c = unit_days.alias("u"), capacity_intervals(capacity).alias("c")
    day = F.col(f"u.{day_col}")
    joined = u.join(c, (F.col("u.bm_unit") == F.col("c.bm_unit")) & (F.col("c.effective_from") <= day)
                    & (F.col("c.until").isNull() | (day < F.col("c.until"))), "left")
    return joined.select(F.col("u.bm_unit").alias("bm_unit"), day.alias(day_col), "c.effective_from", "c.publish_time",
                         "c.psr_type", "c.installed_capacity")


def capacity_as_of_sweep(unit_days: DataFrame, capacity: DataFrame, day_col: str = "settlement_date") -> DataFrame:
    """For each (bm_unit, day) the capacity version in force: the greatest ``effective_from <= day``
    (ties: later publish_time, larger capacity, greater type, NULL lowest).

    ``unit_days`` should be distinct (bm_unit, day) pairs; a repeated pair is answered as often. A sweep:
    versions and days of a unit lie in one order of time and every day takes the last version before
    it, so that a long history costs its sort and no day is compared with the versions that it does not
    take. Versions without ``effective_from`` or unit are never in force; a day or a unit of NULL has none.
    """
    version = ("effective_from", "publish_time", "psr_type", "installed_capacity")
    versions = capacity.where(F.col("effective_from").isNotNull() & F.col("bm_unit").isNotNull()).select(
        "bm_unit", F.col("effective_from").alias("_at"), F.lit(None).cast(unit_days.schema[day_col].dataType).alias("_day"),
        F.lit(False).alias("_asks"), F.struct(*version).alias("_version"))
    none = F.lit(None).cast(versions.schema["_version"].dataType)
    asked = unit_days.select("bm_unit", F.col(day_col).alias("_at"), F.col(day_col).alias("_day"), F.lit(True).alias("_asks"), none.alias("_version"))
    in_time = Window.partitionBy("bm_unit").orderBy(
        "_at", "_asks", "_version.publish_time", "_version.installed_capacity", "_version.psr_type"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = versions.unionByName(asked).withColumn("_version", F.last("_version", ignorenulls=True).over(in_time))
    return swept.where("_asks").select("bm_unit", F.col("_day").alias(day_col), *[F.col(f"_version.{c}") for c in version])
