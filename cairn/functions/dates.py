"""Date helpers and the 32-bit activity mask."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 32-day activity mask, bit 31 = the as-of day, bit 0 = 31 days
# before. "Active in the last 7 days" is the top 7 bits, "the week before" the
# next 7.
UINT32_MASK = 4294967295
LAST_7_DAYS_MASK = 4261412864      # 0b11111110 00000000 00000000 00000000
PREVIOUS_WEEK_MASK = 33292288      # 0b00000001 11111100 00000000 00000000


def date_bit(as_of: Column, day: Column) -> Column:
    """Bit for ``day`` in the mask as of ``as_of``: 1 << (31 - days since); 0 outside 0..31."""
    d = F.datediff(as_of, day)
    # 2^k for k <= 31 is exact in a double, so pow + cast is an exact shift.
    return F.when((d >= 0) & (d <= 31), F.pow(F.lit(2.0), F.lit(31) - d).cast("bigint")) \
        .otherwise(F.lit(0).cast("bigint"))
