"""Column-level building blocks: all native Spark expressions, no Python UDFs."""

from wattframe.functions.fuel import is_interconnector, resolve_fuel_attribute
from wattframe.functions.geo import haversine_km
from wattframe.functions.numeric import mean, total
from wattframe.functions.text import (
    clean_city,
    explode_list,
    rename_snake_case,
    snake_case,
    strip_whitespace,
)
from wattframe.functions.time import format_timestamp, parse_timestamp, settlement_day

__all__ = [
    "clean_city",
    "mean",
    "explode_list",
    "format_timestamp",
    "haversine_km",
    "is_interconnector",
    "parse_timestamp",
    "rename_snake_case",
    "resolve_fuel_attribute",
    "settlement_day",
    "snake_case",
    "strip_whitespace",
    "total",
]
