"""Bounded samples to fit models on."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

_RANGE = 2**31


def hashed_sample(df: DataFrame, id_col: str, bound: int, seed: int = 17) -> list[Row]:
    """At most ``bound`` rows of ``df``, those with the smallest hash of their id, in that order.

    The share to keep follows from the row count, so about ``bound`` rows reach the
    driver whatever the size of the table and the number of its partitions.
    """
    n = df.count()
    if not n:
        return []
    slot = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(_RANGE))
    keep = min(1.0, 1.05 * bound / n)
    rows = df.withColumn("_slot", slot).filter(F.col("_slot") < int(keep * _RANGE)).collect()
    rows.sort(key=lambda r: (r["_slot"], r[id_col]))
    return rows[:bound]
