"""Fuel and source-category resolution across sources of differing trust."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattframe.constants import GENERIC_PSR_TYPES, INTERCONNECTOR_LABEL, INTERCONNECTOR_PATTERN


def is_interconnector(unit: Column) -> Column:
    """``unit LIKE 'I_%'``: an 'I' followed by at least one more character."""
    return unit.like(INTERCONNECTOR_PATTERN)


def capacity_type_is_specific(capacity_psr_type: Column) -> Column:
    """Three-valued ``psr_type NOT IN (generic types)``; NULL stays NULL."""
    return ~capacity_psr_type.isin(*GENERIC_PSR_TYPES)


def resolve_fuel_attribute(
    unit: Column,
    capacity_psr_type: Column,
    from_capacity: Column,
    from_unit_info: Column,
    from_overlay: Column,
) -> Column:
    """Priority rule for one attribute:

    interconnector label, else the capacity feed when its PSR type is specific,
    else the unit reference; the hand-made overlay fills whatever is left NULL.
    A NULL capacity type is not specific (NULL condition -> next branch).
    """
    chosen = (
        F.when(is_interconnector(unit), F.lit(INTERCONNECTOR_LABEL))
        .when(capacity_type_is_specific(capacity_psr_type), from_capacity)
        .otherwise(from_unit_info)
    )
    return F.coalesce(chosen, from_overlay)
