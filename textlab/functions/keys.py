"""Deterministic order keys shared by sampling, splitting and tie-breaking.

The key is ``md5('<seed>:<id>')`` as 32 hex characters: uniform, engine
independent (the same text in DuckDB and Spark), and stable under
re-execution, unlike ``rand()``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SEED = 42
# Hex digits of the key used for the first-level histogram of quota selection:
# 4 digits -> 65,536 buckets per group.
BUCKET_HEX_DIGITS = 4


def order_key(id_col, seed: int = DEFAULT_SEED) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat_ws(":", F.lit(str(seed)), c.cast("string")))


def key_bucket(key_col, digits: int = BUCKET_HEX_DIGITS) -> Column:
    """Leading hex digits of the order key as an int bucket (monotone in the key)."""
    c = F.col(key_col) if isinstance(key_col, str) else key_col
    return F.conv(F.substring(c, 1, digits), 16, 10).cast("int")
