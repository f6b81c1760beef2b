"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from cellwise.functions.expr import (
    dict_lookup, hash_bucket, hash_u32, logistic2, map_literal, row_digest, try_cast,
)
from cellwise.functions.ranges import running_totals

__all__ = [
    "dict_lookup", "hash_bucket", "hash_u32", "logistic2", "map_literal", "row_digest",
    "try_cast", "running_totals",
]
