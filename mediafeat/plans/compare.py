"""Render array results as exact strings, identically in Spark and DuckDB.

The correctness check hashes values; array formatting differs between engines,
so registered queries turn vectors into comma-joined fixed-scale decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ints_str(c) -> Column:
    return F.array_join(F.transform(_col(c), lambda x: x.cast("bigint").cast("string")), ",")


def dec_str(c, scale: int = 4) -> Column:
    return F.array_join(F.transform(_col(c), lambda x: x.cast(f"decimal(24,{scale})").cast("string")), ",")


def nested_dec_str(c, scale: int = 4) -> Column:
    return F.array_join(F.transform(_col(c), lambda v: F.array_join(
        F.transform(v, lambda x: x.cast(f"decimal(24,{scale})").cast("string")), ",")), ";")


# DuckDB spellings
def d_ints(e: str) -> str:
    return f"array_to_string(list_transform({e}, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')"


def d_dec(e: str, scale: int = 4) -> str:
    return f"array_to_string(list_transform({e}, lambda x: CAST(CAST(x AS DECIMAL(24,{scale})) AS VARCHAR)), ',')"


def d_nested_dec(e: str, scale: int = 4) -> str:
    return (f"array_to_string(list_transform({e}, lambda v: array_to_string(list_transform(v, "
            f"lambda x: CAST(CAST(x AS DECIMAL(24,{scale})) AS VARCHAR)), ',')), ';')")
