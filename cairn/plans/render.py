"""Report rendering: nested values to plain text for registered query outputs.

Operators return arrays, structs and maps; the registered reports flatten them
into text in a fixed element order so that results can be compared across
engines without relying on nested-type hashing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_structs(arr, fields: list[str], sep: str = ",", inner: str = ":") -> Column:
    """array<struct> -> 'a:b,a:b' using the listed fields."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(F.transform(a, lambda s: F.concat_ws(inner, *[s[f].cast("string") for f in fields])), sep)


def join_values(arr, sep: str = ",", null: str = "null") -> Column:
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(F.transform(a, lambda x: F.coalesce(x.cast("string"), F.lit(null))), sep)
