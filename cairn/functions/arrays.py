"""Array helpers that are null- and ANSI-safe.

Spark 4 runs in ANSI mode: ``arr[i]`` past the end raises, ``concat(a, NULL)``
is NULL. These wrappers give the "missing means empty / zero" semantics the
cumulative tables rely on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_elem(arr) -> Column:
    return F.get(_c(arr), F.lit(0))


def last_elem(arr) -> Column:
    return F.try_element_at(_c(arr), F.lit(-1))


def concat_safe(left, right) -> Column:
    """Array concatenation where a NULL side counts as empty."""
    l, r = _c(left), _c(right)
    return F.when(l.isNull(), r).when(r.isNull(), l).otherwise(F.concat(l, r))


def append_history(history, item, when=None) -> Column:
    """``coalesce(history, []) || [item]`` where ``when`` holds, else history."""
    h = _c(history)
    one = F.array(_c(item))
    if when is not None:
        one = F.when(when, one)
    return concat_safe(h, one)


def pad_array(length, fill) -> Column:
    """``array_repeat(fill, length)`` with a NULL or negative length as empty."""
    n = F.greatest(F.coalesce(_c(length), F.lit(0)).cast("int"), F.lit(0))
    return F.array_repeat(_c(fill) if not isinstance(fill, (int, float)) else F.lit(fill), n)
