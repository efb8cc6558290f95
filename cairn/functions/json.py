"""JSON object construction (json_build_object) with explicit nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(**fields: Column) -> Column:
    """``{"k": v, ...}`` in argument order; NULL values are written as null."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in fields.items()]), {"ignoreNullFields": "false"})
