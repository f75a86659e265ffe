"""Plant geography: nearest city, county and grid supply point."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattframe.operators.nearest import PACKED_REGIONS, nearest_region


def plant_locations(
    locations: DataFrame,
    cities: DataFrame,
    counties: DataFrame,
    gsps: DataFrame,
    lat_col: str = "latitude",
    lon_col: str = "longitude",
    packed_regions: int = PACKED_REGIONS,
) -> DataFrame:
    """Every raw location column plus ``city``, ``county`` and ``gsp_name``.

    Region tables are in :func:`wattframe.operators.nearest.region_points` shape; one job counts
    the three.
    """
    sets = (("city", cities), ("county", counties), ("gsp_name", gsps))
    counts = reduce(DataFrame.unionAll, [r.select(F.lit(name).alias("name")) for name, r in sets]).groupBy("name").count()
    sizes = {r["name"]: r["count"] for r in counts.collect()}
    out = locations
    for name, regions in sets:
        out = nearest_region(out, regions, name, lat_col, lon_col, packed_regions=packed_regions,
                             small=sizes.get(name, 0) <= packed_regions)
    return out
