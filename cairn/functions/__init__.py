"""Column-expression helpers: all built-in Spark expressions (codegen, JVM side)."""

from cairn.functions.arrays import (  # noqa: F401
    append_history, first_elem, last_elem, pad_array,
)
from cairn.functions.classify import (  # noqa: F401
    REFERRER_RULES, classify_referrer, threshold_class,
)
from cairn.functions.dates import (  # noqa: F401
    LAST_7_DAYS_MASK, PREVIOUS_WEEK_MASK, UINT32_MASK, date_bit,
)
from cairn.functions.json import json_object  # noqa: F401
from cairn.functions.hashing import bucket_of, md5_bucket  # noqa: F401
