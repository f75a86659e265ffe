"""Operators: cleaning, dimension folding, nearest region, keep-one-per-key."""

from wattframe.operators.broadcast import broadcast_if_small
from wattframe.operators.dedup import keep_first, keep_last
from wattframe.operators.dims import UnitDims, capacity_as_of, capacity_latest, unit_dim
from wattframe.operators.nearest import nearest_region, region_points

__all__ = [
    "UnitDims",
    "broadcast_if_small",
    "capacity_as_of",
    "capacity_latest",
    "keep_first",
    "keep_last",
    "nearest_region",
    "region_points",
    "unit_dim",
]
