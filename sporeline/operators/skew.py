"""Equi-joins whose large side may hold a third of its rows under one key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more rows than this.
HOT_ROWS = 200_000


def hot_keys(counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS, most: int = 4096) -> dict:
    """Keys of ``counts`` with more than ``hot_rows`` rows and the number of salts of each: a power of two that leaves ``hot_rows`` rows or fewer to a salt.

    Only the ``most`` largest come back, so the list is bounded; a key beyond them holds
    less than ``1/most`` of all rows.
    """
    rows = counts.filter(F.col(n) > hot_rows).orderBy(F.desc(n)).limit(most).select(key, n).collect()
    return {r[0]: 1 << (-(-r[1] // hot_rows) - 1).bit_length() for r in rows}


def salted_join(big: DataFrame, small: DataFrame, key: str, hot: dict, spread: Column, how: str = "inner") -> DataFrame:
    """``big`` join ``small`` (one row per key) with the rows of hot keys spread over their salts."""
    if not hot:
        return big.join(small, key, how)
    salts = F.lit(1)
    for n in sorted(set(hot.values())):
        salts = F.when(F.col(key).isin([k for k, v in hot.items() if v == n]), F.lit(n)).otherwise(salts)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(spread), salts).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.join(right, [key, "_salt"], how).drop("_salt")
