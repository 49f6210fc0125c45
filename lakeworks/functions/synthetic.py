"""Deterministic synthetic attributes from hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.functions.scalar import hash_int, hash_pick

# Category list for the hash-picked attribute.
STRATEGIES = ["DIRECT_LENDING", "MEZZANINE", "DISTRESSED", "REAL_ESTATE_DEBT", "SPECIALTY_FINANCE"]


def hash_attributes(df: DataFrame, key: str) -> DataFrame:
    """Hash-derived integer, hash-picked category and a deterministic half subset flag."""
    return df.select(
        F.col(key),
        hash_int("size", [key], 8, 1000, lo=100).alias("size_bucket"),
        hash_pick("strategy", [key], STRATEGIES).alias("strategy"),
        (hash_int("subset", [key], 8, 2) == 0).alias("in_subset"))
