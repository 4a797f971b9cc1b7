"""Gaps and islands: runs of rows in an order that belong together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def previous(col: str, keys: list[str], order: list[str]) -> Column:
    return F.lag(col).over(Window.partitionBy(*keys).orderBy(*order))


def running(col: Column, keys: list[str], order: list[str], last: int = 0) -> Column:
    """Sum of ``col`` over the rows up to this one (``last=-1``: before it)."""
    return F.sum(col).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, last))


def islands(df: DataFrame, keys: list[str], order: list[str], starts: Column, name: str = "island") -> DataFrame:
    """Number the runs within ``keys``: a row for which ``starts`` holds opens a new one."""
    flagged = df.withColumn("_starts", starts.cast("int"))
    return flagged.withColumn(name, running(F.col("_starts"), keys, order)).drop("_starts")


def ordered_text(order: str, text: str, sep: str = "\n") -> Column:
    """Aggregate: the texts joined in order."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return F.array_join(F.transform(pairs, lambda p: p["t"]), sep)
