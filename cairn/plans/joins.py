"""Plan inspection. Join strategies are left to AQE, which broadcasts from measured sizes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    return df._jdf.queryExecution().executedPlan().toString() if mode == "executed" else \
        df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def count_exchanges(df: DataFrame) -> int:
    """Number of shuffle exchanges in the physical plan (broadcasts excluded)."""
    txt = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", txt))
