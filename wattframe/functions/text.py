"""String helpers: column names, id lists, city names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattframe.constants import CITY_RENAMES

# A word boundary sits before a capitalised word ("Unit" in "bmUnit", "Id" in
# "HTTPId") and between a lowercase letter or digit and a capital.
_WORD_BOUNDARY = re.compile(r"(?<=.)(?=[A-Z][a-z])|(?<=[a-z0-9])(?=[A-Z])")

# Characters removed by a whitespace strip at both ends.
WHITESPACE = " \t\n\r\f\v"


def snake_case(name: str) -> str:
    """``bmUnit`` -> ``bm_unit``, ``HTTPStatusCode`` -> ``http_status_code``."""
    return _WORD_BOUNDARY.sub("_", name).lower()


def rename_snake_case(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case. Metadata only: no data is touched."""
    return df.toDF(*[snake_case(c) for c in df.columns])


def strip_whitespace(c: Column) -> Column:
    """Remove leading and trailing whitespace (not only spaces)."""
    return F.trim(c, F.lit(WHITESPACE))


def explode_list(c: Column, sep: str = ",", keep_empty: bool = True) -> Column:
    """One output row per ``sep``-separated token; empty tokens are kept by default.

    Use as a generator in ``select``; pair with :func:`strip_whitespace`.
    """
    tokens = F.split(c, re.escape(sep))
    if not keep_empty:
        tokens = F.filter(tokens, lambda t: F.length(strip_whitespace(t)) > 0)
    return F.explode(tokens)


def clean_city(c: Column) -> Column:
    """Replace '-' by ' ' and then apply the whole-value renames."""
    dashed = F.translate(c, "-", " ")
    renames = F.create_map(*[F.lit(x) for kv in CITY_RENAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(renames, dashed), dashed)
