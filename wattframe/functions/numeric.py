"""Sums and averages of MWh values.

Plain double sums, as the original statements have them: no value is cut to a fixed scale, and a
NaN in the feed makes the totals it belongs to NaN instead of ending the query. The last bits of
a double sum depend on the order of addition, so results are to be compared after rounding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: Column) -> Column:
    """Aggregate: sum of the non-null values."""
    return F.sum(c)


def mean(c: Column) -> Column:
    """Aggregate: average of the non-null values."""
    return F.avg(c)
