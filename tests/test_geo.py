"""Nearest region: ties, NULL/NaN, brute-force equality, packed regions and grid cells."""

import math

from pyspark.sql import functions as F

from wattframe.functions.geo import haversine_km
from wattframe.operators import nearest
from wattframe.operators.nearest import nearest_region, region_points


def regions(spark, rows):
    df = spark.createDataFrame(rows, "ord long, name string, latitude double, longitude double")
    return region_points(df, "name", "ord")


def test_tie_goes_to_first_region_and_bad_coords_to_null(spark):
    r = regions(spark, [(0, "B", 51.0, 1.0), (1, "A", 51.0, -1.0), (2, "C", 60.0, 0.0)])
    pts = spark.createDataFrame([(1, 51.0, 0.0), (2, None, 0.0), (3, float("nan"), 0.0), (4, 59.0, 0.0)],
                                "id long, latitude double, longitude double")
    got = {x.id: x.region for x in nearest_region(pts, r, "region").collect()}
    assert got == {1: "B", 2: None, 3: None, 4: "C"}


def test_order_is_compared_as_a_pair(spark):
    df = spark.createDataFrame([(1, 0, "manual", 51.0, 1.0), (0, 1 << 41, "file", 51.0, -1.0)],
                               "source_rank int, ord long, name string, latitude double, longitude double")
    r = region_points(df, "name", ("source_rank", "ord"))
    pts = spark.createDataFrame([(1, 51.0, 0.0)], "id long, latitude double, longitude double")
    for packed in (10, 0):
        assert nearest_region(pts, r, "region", packed_regions=packed).first().region == "file"


def test_cells_equal_packed_for_duplicate_and_null_ids(spark):
    r = regions(spark, [(0, "A", 51.0, 1.0), (1, "B", 51.0, -1.0), (2, "C", -40.0, 170.0), (3, "D", float("nan"), 0.0)])
    pts = spark.createDataFrame([(1, 51.0, 0.9), (1, 51.0, -0.9), (None, -41.0, -179.0), (1, 51.0, 0.0), (2, None, 1.0),
                                 (None, 51.0, 0.9), (7, 51.0, 0.9), (7, 51.0, 0.9)], "id long, latitude double, longitude double")
    both = [sorted(map(tuple, nearest_region(pts, r, "region", distance_col="d", packed_regions=n).collect()), key=str) for n in (10, 0)]
    assert both[0] == both[1] and len(both[0]) == 8
    assert nearest_region(pts, r.limit(0), "region", packed_regions=0).where("region is not null").count() == 0


def test_matches_brute_force_in_both_ways(spark):
    rows = [(i, f"R{i}", 50.0 + (i * 37 % 100) / 10.0, -6.0 + (i * 53 % 80) / 10.0) for i in range(60)]
    r = regions(spark, rows)
    pts = spark.range(200).select(
        F.col("id"),
        (F.lit(49.5) + (F.col("id") * 13 % 110) / F.lit(10.0)).alias("latitude"),
        (F.lit(-6.5) + (F.col("id") * 7 % 90) / F.lit(10.0)).alias("longitude"),
    )
    fast = {x.id: x.region for x in nearest_region(pts, r, "region").collect()}
    cells = {x.id: x.region for x in nearest_region(pts, r, "region", packed_regions=7).collect()}
    assert fast == cells

    def hav(a, b, c, d):
        a, b, c, d = map(math.radians, (a, b, c, d))
        h = math.sin((c - a) / 2) ** 2 + math.cos(a) * math.cos(c) * math.sin((d - b) / 2) ** 2
        return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(1 - h))

    for p in pts.collect():
        best = min(rows, key=lambda q: (hav(p.latitude, p.longitude, q[2], q[3]), q[0]))
        assert fast[p.id] == best[1]


def test_no_python_udf_in_nearest_plan(spark):
    r = regions(spark, [(0, "A", 51.0, 0.0)])
    pts = spark.createDataFrame([(1, 51.0, 0.0)], "id long, latitude double, longitude double")
    plan = nearest_region(pts, r, "region")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Exchange" not in plan.split("Subquery")[0]  # the points are not shuffled


def test_haversine_symmetry(spark):
    df = spark.createDataFrame([(50.1, -3.2, 55.0, 1.1)], "a double, b double, c double, d double")
    x = df.select(haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("x"),
                  haversine_km(F.col("c"), F.col("d"), F.col("a"), F.col("b")).alias("y")).first()
    assert abs(x.x - x.y) < 1e-9


def test_cells_follow_the_density_and_bound_the_pairs(spark):
    k = F.col("id")
    town = lambda n, seed: spark.range(n).select(
        k.alias("ord"), k.cast("string").alias("name"), (F.lit(51.5) + F.rand(seed) / 50).alias("latitude"), (F.rand(seed + 1) / 30).alias("longitude"))
    wide = spark.range(10000, 10100).select(
        k.alias("ord"), k.cast("string").alias("name"), (F.rand(5) * 170 - 85).alias("latitude"), (F.rand(6) * 360 - 180).alias("longitude"))
    same = spark.range(20000, 20500).select(k.alias("ord"), k.cast("string").alias("name"), F.lit(-30.0).alias("latitude"), F.lit(10.0).alias("longitude"))
    r, _ = nearest.materialised(region_points(town(4000, 1).unionAll(wide).unionAll(same), "name", "ord"), "regions")
    points, _ = nearest.materialised(town(600, 3).unionAll(wide).unionAll(same).select(F.col("ord").alias("id"), "latitude", "longitude"), "points")
    cells, places = nearest.cell_tree(r)
    per_leaf = places.groupBy("level", "cell").count().agg(F.max("count")).first()[0]
    assert per_leaf <= nearest.CROWDED and places.count() == 4101
    assert cells.where("leaf").agg(F.countDistinct("level")).first()[0] >= 3  # small cells in town, large ones elsewhere
    coords = points.select(F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")).distinct()
    pairs = nearest.candidate_cells(coords, cells).join(places, ["level", "cell"])
    assert pairs.count() <= coords.count() * 4 * nearest.CROWDED  # of 4,101 regions
    both = [sorted(map(tuple, nearest_region(points, r, "region", distance_col="d", packed_regions=n).collect())) for n in (10000, 0)]
    assert both[0] == both[1] and len(both[0]) == 1200
