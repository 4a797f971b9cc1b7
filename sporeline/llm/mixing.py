"""Mixing sources to target weights (problem 9).

*Temperature mixing.* ``temperature_weights`` raises the natural token shares of the sources
to a power and bisects the exponent until the mixture has a wanted entropy or no source is
repeated more than allowed. One exponent cannot meet ten given shares at once, so where
targets are given the wanted weights are the targets themselves, of the sources that have documents; what
the exponent of equal entropy would give is reported beside them. Weights become token amounts under the
budget by bisecting the common scale until the capped amounts fill it: a source takes
``min(max_repeats * size, scale * target)``, so one that is short gives all it may and the others
keep their proportions.

Amounts are realised as *budgeted block permutations*: full passes over a source plus
a part of one, namely the blocks of its hash permutation that come first until the amount
is reached, the last block document by document. Sums per block are bounded
(``sources x BLOCKS``), so no source, however large, is ordered in one task.

Defined cases: sources that are not listed or null are left out; a listed source without
tokens reaches share 0; null targets and repeats count as 0 and 1; targets need not sum to one; documents without
tokens are left out; repeated ids are copies of their own; empty tables give no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sporeline.llm.packing import measured
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

BLOCKS = 4096


def entropy(weights: list[float]) -> float:
    total = sum(weights)
    return -sum(w / total * math.log(w / total) for w in weights if w > 0) if total > 0 else 0.0


def temperature_weights(sizes: dict[str, float], goal: float | None = None, budget: float | None = None, max_repeats: dict[str, float] | None = None) -> tuple[float, dict[str, float]]:
    """``(exponent, weights)``: weights are the token shares to a power, normalised.

    The exponent in [0, 1] is bisected to meet the entropy ``goal``, or is the smallest (the flattest
    mixture) at which no source exceeds its repetition limit under ``budget``.
    """
    sizes = {s: n for s, n in sizes.items() if n > 0}
    whole = sum(sizes.values())
    if not sizes:
        return 1.0, {}

    def at(x: float) -> dict[str, float]:
        p = {s: (n / whole) ** x for s, n in sizes.items()}
        z = sum(p.values())
        return {s: v / z for s, v in p.items()}

    def low_enough(x: float) -> bool:
        w = at(x)
        if goal is not None:
            return entropy(list(w.values())) <= goal
        return all(budget * w[s] <= max_repeats.get(s, 1) * n + 1e-9 for s, n in sizes.items())

    lo, hi = 0.0, 1.0
    if goal is not None:
        while not low_enough(hi) and hi < 64:
            hi *= 2
    if low_enough(lo):
        return lo, at(lo)
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if low_enough(mid) else (mid, hi)
    return hi, at(hi)


def capped_amounts(sizes: dict[str, int], targets: dict[str, float], repeats: dict[str, int], budget: float) -> dict[str, float]:
    """Tokens of each source: ``min(cap, scale * target)``, the scale bisected so that they sum to the budget or to all caps."""
    cap = {s: max(0, repeats.get(s, 1)) * sizes.get(s, 0) if targets[s] > 0 else 0 for s in targets}
    if sum(cap.values()) <= budget:
        return {s: float(c) for s, c in cap.items()}
    lo, hi = 0.0, max(cap[s] / targets[s] for s in targets if targets[s] > 0)
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(min(cap[s], mid * targets[s]) for s in targets) < budget else (lo, mid)
    return {s: min(float(cap[s]), hi * targets[s]) for s in targets}


def _plan(items: DataFrame, targets: DataFrame, budget: float | None) -> tuple[list[tuple], float]:
    """Rows ``(source, target, max_repeats, size, amount, temperature share)`` and the exponent; as many as targets has rows."""
    sizes = {r["source"]: r["n"] for r in items.join(F.broadcast(targets.select("source")), "source").groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    want: dict[str, tuple[float, int]] = {}
    for r in targets.filter("source is not null").orderBy("source").collect():  # one row per listed source
        want[r["source"]] = (max(0.0, r["target_share"] or 0.0), r["max_repeats"] if r["max_repeats"] is not None else 1)
    share = {s: t for s, (t, _) in want.items()}
    amounts = capped_amounts(sizes, share, {s: m for s, (_, m) in want.items()}, sum(sizes.values()) if budget is None else budget) if want else {}
    exponent, flat = temperature_weights({s: sizes.get(s, 0) for s in want}, goal=entropy([t for s, t in share.items() if sizes.get(s)]))
    return [(s, t, m, sizes.get(s, 0), amounts[s], flat.get(s, 0.0)) for s, (t, m) in want.items()], exponent


_PLAN = "source string, target_share double, max_repeats int, source_tokens long, amount double, temperature_share double"


def mixture(items: DataFrame, targets: DataFrame, budget: float | None = None) -> tuple[DataFrame, DataFrame]:
    """``(mixture, plan)`` of ``items(doc_id, source, n_tokens)``.

    mixture has a row per use of a document: doc_id, source, pass_no, n_tokens, block.
    Without a budget the tokens of all documents of the listed sources are taken.
    """
    spark = items.sparkSession
    rows, exponent = _plan(items, targets, budget)
    plan = spark.createDataFrame([(*r, float(exponent)) for r in rows], f"{_PLAN}, exponent double")
    own = items.filter("n_tokens > 0").join(F.broadcast(plan.select("source", "source_tokens", "amount")), "source")
    own = own.withColumn("full", F.floor(F.try_divide("amount", "source_tokens") + 1e-9).cast("int")).withColumn("part", F.col("amount") - F.col("full") * F.col("source_tokens"))
    own = own.withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(BLOCKS)).cast("int"))
    sums = own.groupBy("source", "block", "part").agg(F.sum("n_tokens").alias("t"))
    before = F.sum("t").over(Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))  # at most BLOCKS rows a source
    ranked = sums.withColumn("before", F.coalesce(before, F.lit(0))).select("source", "block", "before", F.when(F.col("before") + F.col("t") <= F.col("part"), "all").when(F.col("before") < F.col("part"), "some").otherwise("none").alias("taken"))
    ranked, _ = materialize(ranked, "blocks")  # at most sources x BLOCKS rows
    placed = own.join(F.broadcast(ranked), ["source", "block"])
    inner = Window.partitionBy("source").orderBy(F.xxhash64("doc_id", F.lit(2)), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    edge = placed.filter("taken = 'some'").withColumn("at", F.col("before") + F.coalesce(F.sum("n_tokens").over(inner), F.lit(0)))
    edge = edge.withColumn("taken", F.when((F.col("at") + F.col("n_tokens") / 2) <= F.col("part"), "all").otherwise("none")).drop("at")
    every = placed.filter("taken <> 'some'").unionByName(edge).withColumn("uses", F.col("full") + F.when(F.col("taken") == "all", 1).otherwise(0))
    used = every.filter("uses > 0").withColumn("pass_no", F.explode(F.expr("sequence(1, uses)")))
    return used.select("doc_id", "source", "pass_no", "n_tokens", F.pmod(F.xxhash64("doc_id", "pass_no"), F.lit(BLOCKS)).cast("int").alias("block")), plan


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, _ = materialize(measured(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens"), "measured")
    return mixture(items, table(spark, sf_dir, "mix_targets"))[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each listed source: target, share reached, tokens, uses of a document at most, whether its repeats are used up, and the temperature share and exponent."""
    items, _ = materialize(measured(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens"), "measured")
    mix, plan = mixture(items, table(spark, sf_dir, "mix_targets"))
    got = mix.groupBy("source").agg(F.sum("n_tokens").alias("mixed_tokens"), F.max("pass_no").alias("most_uses"))
    whole = got.agg(F.sum("mixed_tokens").alias("whole"))
    joined = plan.join(got, "source", "left").join(F.broadcast(whole), F.lit(True), "left")
    return joined.select(
        "source", "target_share", F.round(F.coalesce(F.try_divide("mixed_tokens", "whole"), F.lit(0.0)), 6).alias("actual_share"), F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"), "source_tokens",
        F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats", (F.col("amount") >= F.col("max_repeats") * F.col("source_tokens") - 0.5).alias("at_limit"), F.round("temperature_share", 6).alias("temperature_share"), F.round("exponent", 6).alias("exponent"),
    )
