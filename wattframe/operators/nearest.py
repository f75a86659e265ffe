"""Nearest-region assignment (arg-min of haversine distance).

Up to ``PACKED_REGIONS`` regions (counties, supply points, official cities) are packed into one
array, evaluated once as a scalar subquery and scanned for each point inside a native
``transform`` / ``array_min`` expression; points are not shuffled. Larger sets are cut into cells
that follow their density, and points go down the cells with bounds on the distance. Both give the
same rows: the region with the smallest (distance, ord, name), looked up by a point's coordinates,
so points need no key.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattframe.functions.geo import haversine_km, is_valid_coordinate
from wattframe.operators.broadcast import materialised

PACKED_REGIONS = 2048
CROWDED = 32   # regions beyond which a cell is cut into 4 x 4 x 4
LEVELS = 10    # the last cells are about 12 m wide
MARGIN = 1e-7  # of the unit sphere, for rounding: bounds on the distance only ever admit more


def region_points(df: DataFrame, name_col: str, order_cols: str | tuple[str, ...],
                  lat_col: str = "latitude", lon_col: str = "longitude") -> DataFrame:
    """Normalise a region table to (ord, name, lat, lon).

    ``order_cols`` fix the tie order (the first region wins on equal distance), compared one after
    the other, e.g. (source_rank, ord) for file rows before rows added by hand.
    """
    cols = (order_cols,) if isinstance(order_cols, str) else tuple(order_cols)
    return df.select(
        F.struct(*[F.col(c).cast("long").alias(f"k{i}") for i, c in enumerate(cols)]).alias("ord"),
        F.col(name_col).cast("string").alias("name"),
        F.col(lat_col).cast("double").alias("lat"),
        F.col(lon_col).cast("double").alias("lon"),
    )


def _candidate(lat: Column, lon: Column, r) -> Column:
    return F.struct(haversine_km(lat, lon, r("lat"), r("lon")).alias("d"), r("ord").alias("ord"), r("name").alias("name"))


def nearest_region(
    points: DataFrame,
    regions: DataFrame,
    out_col: str,
    lat_col: str = "latitude",
    lon_col: str = "longitude",
    distance_col: str | None = None,
    packed_regions: int = PACKED_REGIONS,
    small: bool | None = None,
) -> DataFrame:
    """Add ``out_col`` = name of the nearest region (and optionally its distance).

    ``regions`` must be in the shape of :func:`region_points`. Points with a NULL or NaN
    coordinate get NULL, as do all points if there is no region. Exact ties go to the lowest
    ``ord``, then the smallest name. Rows of ``points`` may repeat and need no key. ``small``
    passes on a size check that the caller has made already.
    """
    lat, lon = F.col(lat_col), F.col(lon_col)
    valid = is_valid_coordinate(lat, lon)
    regions = regions.where(is_valid_coordinate(F.col("lat"), F.col("lon")))
    if small is None:
        small = regions.count() <= packed_regions
    if small:
        packed = regions.select(F.sort_array(F.collect_list(F.struct("ord", "name", "lat", "lon"))).alias("r")).scalar()
        # Bound to a column first: subqueries may not sit inside a lambda. One value per query.
        best = F.array_min(F.transform("_regions", lambda r: _candidate(lat, lon, lambda c: r[c])))
        out = points.withColumn("_regions", packed).withColumn("_best", F.when(valid, best)).drop("_regions")
    else:
        found = _nearest_in_cells(points.where(valid).select(lat.alias("_lat"), lon.alias("_lon")).distinct(), regions)
        out = points.join(found, (lat == F.col("_lat")) & (lon == F.col("_lon")), "left").drop("_lat", "_lon")
    out = out.withColumn(out_col, F.col("_best.name"))
    if distance_col:
        out = out.withColumn(distance_col, F.col("_best.d"))
    return out.drop("_best")


AXES = ("x", "y", "z")


def _with_unit_vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    p, q = F.radians(lat), F.radians(lon)
    return df.withColumn("_x", F.cos(p) * F.cos(q)).withColumn("_y", F.cos(p) * F.sin(q)).withColumn("_z", F.sin(p))


def _cell(level: Column) -> Column:
    """Number of the cube of a ``level`` (0: one cube holds the sphere) around (_x, _y, _z)."""
    side = F.pow(F.lit(4.0), level)
    at = [F.least(F.floor((F.col(f"_{a}") + 1) / 2 * side), side - 1).cast("long") for a in AXES]
    return functools.reduce(lambda out, c: out * (1 << 2 * LEVELS) + c, at)


def cell_tree(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells, places) of :func:`region_points` with valid coordinates.

    ``cells``: level, cell, parent, whether it is a leaf, and the box (lo, hi by axis) of the regions in it. A
    cell with more than CROWDED regions is cut; where regions are sparse a cell stays large. ``places``: every
    region (the first of those at one place, which wins in any case) with the level and cell of its leaf.
    """
    first = regions.groupBy("lat", "lon").agg(F.min(F.struct("ord", "name")).alias("r")).select("r.*", "lat", "lon")
    levels = F.explode(F.sequence(F.lit(1), F.lit(LEVELS)))
    spread = _with_unit_vector(first, "lat", "lon").withColumn("level", levels)
    spread = spread.withColumn("cell", _cell(F.col("level"))).withColumn("parent", _cell(F.col("level") - 1))
    box = [f(f"_{a}").alias(f"{n}_{a}") for a in AXES for f, n in ((F.min, "lo"), (F.max, "hi"))]
    counted, _ = materialised(spread.groupBy("level", "cell", "parent").agg(F.count("*").alias("n"), *box), "region-cells")
    crowded = counted.where(F.col("n") > CROWDED).select((F.col("level") + 1).alias("level"), F.col("cell").alias("parent"))
    whole = counted.where("level = 1").withColumn("leaf", F.col("n") <= CROWDED)
    cut = counted.join(crowded, ["level", "parent"], "left_semi").withColumn("leaf", (F.col("n") <= CROWDED) | (F.col("level") == LEVELS))
    cells, _ = materialised(whole.unionByName(cut), "region-tree")
    places = spread.select("ord", "name", "lat", "lon", "level", "cell").join(cells.where("leaf").select("level", "cell"), ["level", "cell"], "left_semi")
    return cells, materialised(places, "region-places")[0]


def candidate_cells(coords: DataFrame, cells: DataFrame) -> DataFrame:
    """(_lat, _lon, level, cell): the leaves that may hold the region nearest to each of the distinct coordinates.

    A region of a cell is at least as far as its box and at most as far as the box's far corner. The least far
    corner that a point has met bounds its search, and is handed down to the cells within.
    """
    box = [(F.col(f"_{a}"), F.col(f"lo_{a}"), F.col(f"hi_{a}")) for a in AXES]
    near = F.sqrt(sum((F.pow(F.greatest(lo - x, x - hi, F.lit(0.0)), 2) for x, lo, hi in box), F.lit(0.0)))
    far = F.sqrt(sum((F.pow(F.greatest(x - lo, hi - x), 2) for x, lo, hi in box), F.lit(0.0)))
    of_point = Window.partitionBy("_lat", "_lon")
    depth = cells.agg(F.max("level")).first()[0] or 0
    left, leaves = _with_unit_vector(coords, "_lat", "_lon").withColumn("_in", F.lit(0).cast("long")).withColumn("_far", F.lit(2.0)), []
    for level in range(1, depth + 1):
        inner = cells.where(F.col("level") == level)
        met = left.join(inner, left["_in"] == inner["parent"]).withColumn("_near", near).withColumn("_to", far)
        met = met.where(F.col("_near") <= F.col("_far") + MARGIN)
        met = met.withColumn("_far", F.least("_far", F.min("_to").over(of_point))).where(F.col("_near") <= F.col("_far") + MARGIN)
        met, _ = materialised(met.select("_lat", "_lon", "_x", "_y", "_z", "level", "cell", "leaf", "_near", "_far"), "cells-met")
        leaves.append(met.where("leaf"))
        left = met.where(~F.col("leaf")).select("_lat", "_lon", "_x", "_y", "_z", F.col("cell").alias("_in"), "_far")
    if not leaves:
        return coords.where("false").select("_lat", "_lon", F.lit(0).alias("level"), F.lit(0).cast("long").alias("cell"))
    found = functools.reduce(DataFrame.unionByName, leaves).withColumn("_far", F.min("_far").over(of_point))
    return found.where(F.col("_near") <= F.col("_far") + MARGIN).select("_lat", "_lon", "level", "cell")


def _nearest_in_cells(coords: DataFrame, regions: DataFrame) -> DataFrame:
    """(_lat, _lon, _best) of distinct coordinates: only the regions of the leaves that may hold the nearest are compared."""
    cells, places = cell_tree(regions)
    coords, _ = materialised(coords, "points")
    pairs = candidate_cells(coords, cells).join(places, ["level", "cell"])
    return pairs.groupBy("_lat", "_lon").agg(F.min(_candidate(F.col("_lat"), F.col("_lon"), F.col)).alias("_best"))
