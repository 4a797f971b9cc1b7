"""Intervals: overlap joins, gaps, merging, conflict resolution."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Half-open intervals that share a position."""
    return (a0 < b1) & (b0 < a1)


def overlap_join(left: DataFrame, right: DataFrame, key: str, width: int, how: str = "inner") -> DataFrame:
    """Rows of ``left(key, start, end, ..)`` with overlapping ones of ``right(key, other_start, other_end, ..)``.

    Both sides are cut into cells of ``width``, so the join is an equality on key and cell and a
    long document is spread over many tasks; a pair is kept in the first cell both lie in.
    """
    cells = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.greatest(F.col(s), F.col(e) - 1) / width)))
    a = left.withColumn("_cell", cells("start", "end"))
    b = right.withColumn("_cell", cells("other_start", "other_end"))
    met = a.join(b, [key, "_cell"], how)
    first = F.floor(F.greatest("start", "other_start") / width)
    return met.filter(overlaps(F.col("start"), F.col("end"), F.col("other_start"), F.col("other_end")) & (F.col("_cell") == first)).drop("_cell")


def gaps(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Distance of each span from the one before it, never below zero."""
    w = Window.partitionBy(*keys).orderBy("start", "end")
    return spans.withColumn("gap", F.greatest(F.lit(0), F.col("start") - F.lag("end").over(w)))


def merged(spans: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping or touching spans as one."""
    w = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max("end").over(w)
    run = Window.partitionBy(*keys).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    opened = spans.withColumn("_opens", F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)).withColumn("_run", F.sum("_opens").over(run))
    return opened.groupBy(*keys, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n_spans")).drop("_run")


def resolve_conflicts(spans: DataFrame) -> DataFrame:
    """Greedy choice within a document: shortest first, then the surer, then the earlier; none that overlaps a chosen one."""

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(_n=pdf["end"] - pdf["start"]).sort_values(["_n", "confidence", "start", "label"], ascending=[True, False, True, True], kind="stable")
        taken: list[tuple[int, int]] = []
        keep = []
        for s, e in zip(pdf["start"], pdf["end"]):
            ok = all(e <= a or b <= s for a, b in taken)
            keep.append(ok)
            if ok:
                taken.append((s, e))
        return pdf[keep].drop(columns="_n")

    return spans.groupBy("doc_id").applyInPandas(choose, spans.schema)


#: Identifiers looked for in text, (label, pattern).
PARTICLES = [
    ("doi", r"10\.[0-9]{4,9}/[^\s]+"),
    ("page_reference", r"\bp\. [0-9]+"),
    ("figure_reference", r"\bFig\. [0-9]+"),
    ("specimen_number", r"\b(?:No|no|Nr)\. [0-9]+"),
    ("registry", r"FungReg(?: No\.)? [0-9]+"),
    ("year", r"\((?:1[789]|20)[0-9]{2}\)"),
]


def particles(docs: DataFrame, text: str = "text") -> DataFrame:
    """Identifiers in texts with their positions: doc_id, label, start, end, found."""
    import re

    rules = [(n, re.compile(p)) for n, p in PARTICLES]

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, n, m.start(), m.end(), m.group(0)) for i, t in zip(pdf["doc_id"], pdf[text]) if t for n, p in rules for m in p.finditer(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "label", "start", "end", "found"])

    return docs.select("doc_id", text).mapInPandas(find, "doc_id long, label string, start int, end int, found string")
