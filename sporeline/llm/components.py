"""Splits that keep related records together (problem 1).

Articles that share an author, a source key or a taxon key, directly or through
others, form a component. Components come from *hash-to-min*: every node keeps a
cluster; in each round it sends the whole cluster to the cluster's smallest member
and that smallest member to everybody else, until nothing changes. A cluster is kept
as ``(node, member)`` rows and never as one value, so a component of any size is
spread over tasks. Components then go to splits by weighted rendezvous hashing.

Defined cases: null or empty author lists, null keys and values that say "not known"
relate nothing; an article without usable keys is a component of its own; repeated
article rows and repeated keys count once; an empty table gives an empty result; a row
whose id is null has no place in any split and is left out; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.operators.skew import hot_keys, salted_join
from sporeline.plans.storage import discard, materialize
from sporeline.sources.tables import table

#: What a typed key says when its author meant "not known".
UNKNOWN = frozenset(
    ["", "-", "--", "–", "—", "?", "??", "???", ".", "*", "x", "anon", "anon.", "anonymous", "anonym", "anonymus", "n/a", "n.a.", "na", "none", "null", "nil", "n. n.", "n.n.", "nn", "n. n", "no author", "not known", "not given", "unbekannt", "inconnu", "desconocido", "ignotus", "unknown", "unknown author", "unknown source", "unknown taxon", "unnamed", "s. n.", "s.n.", "s. a.", "tba", "to be determined", "undetermined", "indet", "indet.", "[n. n.]"]
)


def normal_key(value: str | None) -> str | None:
    """Composed, case-folded, trimmed, with one blank for any run of white space; None when it says "not known"."""
    if value is None:
        return None
    key = " ".join(unicodedata.normalize("NFC", unicodedata.normalize("NFC", value).casefold()).split())
    bare = re.sub(r"^[\[(<{\"']+|[\])>}\"']+$", "", key).strip()
    return None if bare in UNKNOWN else key


def _normal_keys(values: pd.Series) -> pd.Series:
    seen: dict = {}
    return values.map(lambda v: seen[v] if v in seen else seen.setdefault(v, normal_key(v)))


def article_keys(articles: DataFrame) -> DataFrame:
    """Distinct ``(node, key)``: what relates an article to others."""
    norm = F.pandas_udf(_normal_keys, "string")
    typed = F.concat(
        F.transform(F.coalesce("authors", F.array().cast("array<string>")), lambda a: F.struct(F.lit("a").alias("kind"), a.alias("raw"))),
        F.array(F.struct(F.lit("s").alias("kind"), F.col("source_key").alias("raw")), F.struct(F.lit("t").alias("kind"), F.col("taxon_key").alias("raw"))),
    )
    pairs = articles.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("node"), F.explode(typed).alias("k")).filter("k.raw is not null")
    keyed = pairs.select("node", F.col("k.kind").alias("kind"), norm(F.col("k.raw")).alias("norm")).filter("norm is not null")
    return keyed.select("node", F.concat_ws(":", "kind", "norm").alias("key")).distinct()


def key_edges(keys: DataFrame, spread: str = "node") -> DataFrame:
    """Star edges ``(node, member)``: each node to the smallest node of each of its keys."""
    per, path = materialize(keys.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("n")).filter("n > 1"), "key-least")
    hot = hot_keys(per, "key", "n")
    return salted_join(keys, per.select("key", "least"), "key", hot, F.col(spread)).select("node", F.col("least").alias("member")).distinct()


def hash_to_min(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of ``edges(node, member)`` as ``(node, component)``; component is its smallest node.

    Each round joins the clusters with every node's smallest member, a join keyed by
    node whose hot keys (the least node of a huge component) are salted. The rounds
    end when a checksum over all ``(node, member)`` rows no longer changes.
    """
    spark = edges.sparkSession
    ends = edges.select("node", "member").union(edges.select(F.col("member"), F.col("node")))
    loops = ends.select("node", F.col("node").alias("member"))
    clusters, path = materialize(ends.union(loops).toDF("node", "member").distinct(), "clusters")
    before = None
    for _ in range(max_rounds):
        least, least_path = materialize(clusters.groupBy("node").agg(F.min("member").alias("least"), F.count("*").alias("n"), F.sum(F.xxhash64("node", "member").cast("decimal(38,0)")).alias("sig")), "least")
        state = least.agg(F.sum("n"), F.sum("sig"), F.max("n")).first()
        if state[:2] == before or state[0] is None:
            discard(spark, least_path)
            break
        before = state[:2]
        hot = hot_keys(least, "node", "n") if state[2] > 200_000 else {}
        met = salted_join(clusters, least.select("node", "least"), "node", hot, F.col("member"))
        sent = met.select(F.explode(F.array(F.struct(F.col("least").alias("node"), F.col("member")), F.struct(F.col("member").alias("node"), F.col("least").alias("member")))).alias("e")).select("e.node", "e.member")
        after, after_path = materialize(sent.distinct(), "clusters")
        discard(spark, least_path)
        discard(spark, path)
        clusters, path = after, after_path
    else:
        raise RuntimeError("hash-to-min did not settle")
    return clusters.groupBy("node").agg(F.min("member").alias("component"))


def related_groups(articles: DataFrame) -> DataFrame:
    """``(doc_id, group_doc_id)`` of every article whose component has two or more."""
    keys, _ = materialize(article_keys(articles), "article-keys")
    found = hash_to_min(key_edges(keys))
    return found.select(F.col("node").alias("doc_id"), F.col("component").alias("group_doc_id"))


def rendezvous(component: str, seed, weights: dict[str, float]):
    """Column: the split with the best score ``-w / ln(u)``, u drawn from the hash of seed, component and split."""
    scores = [
        F.struct((-F.lit(w) / F.log((F.pmod(F.xxhash64(seed, F.col(component), F.lit(s)), F.lit(2**52)) + F.lit(0.5)) / F.lit(float(2**52)))).alias("score"), F.lit(s).alias("split"))
        for s, w in sorted(weights.items())
    ]
    return F.greatest(*scores)["split"] if len(scores) > 1 else scores[0]["split"]


SPLITS = {"train": 0.8, "validation": 0.1, "test": 0.1}


def assign_splits(articles: DataFrame, lines: DataFrame, weights: dict[str, float] = SPLITS, seeds: int = 48) -> DataFrame:
    """``(doc_id, group_doc_id, split)`` of every article.

    Rendezvous hashing meets the proportions only in the mean, and components weigh very
    differently, so ``seeds`` independent hashings are tried in one pass and the one
    whose splits come nearest to the wanted share of every label (in lines) is taken.
    What is compared are ``seeds x splits x labels`` sums, a number fixed in advance.
    """
    groups = related_groups(articles)
    every = articles.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    placed, _ = materialize(every.join(groups, "doc_id", "left").withColumn("group_doc_id", F.coalesce("group_doc_id", "doc_id")), "placed")
    label = F.lower(F.trim(F.coalesce("label", F.lit(""))))
    per_doc = lines.filter(F.col("doc_id").isNotNull()).groupBy("doc_id", label.alias("label")).agg(F.count("*").alias("n"))
    per_group = per_doc.join(placed, "doc_id").groupBy("group_doc_id", "label").agg(F.sum("n").alias("n"))
    tried = per_group.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    got = tried.groupBy("seed", "label", rendezvous("group_doc_id", F.col("seed"), weights).alias("split")).agg(F.sum("n").alias("n"))
    grid = {}
    totals: dict[str, int] = {}
    for r in got.collect():  # at most seeds x splits x labels rows
        grid[r["seed"], r["label"], r["split"]] = r["n"]
        if r["seed"] == 0:
            totals[r["label"]] = totals.get(r["label"], 0) + r["n"]
    every_n = sum(totals.values()) or 1

    def off(seed: int) -> float:
        whole = sum(abs(sum(grid.get((seed, lab, s), 0) for lab in totals) / every_n - w) for s, w in weights.items())
        return 4 * whole + sum(abs(grid.get((seed, lab, s), 0) - w * n) for lab, n in totals.items() for s, w in weights.items()) / every_n

    best = min(range(seeds), key=lambda s: (off(s), s))
    return placed.select("doc_id", "group_doc_id", rendezvous("group_doc_id", F.lit(best), weights).alias("split"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return related_groups(table(spark, sf_dir, "articles"))


def p1_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split of every article, with the number of its sections and labelled lines."""
    placed = assign_splits(table(spark, sf_dir, "articles"), table(spark, sf_dir, "yedda_lines"))
    n = lambda t, c: table(spark, sf_dir, t).groupBy("doc_id").agg(F.count("*").alias(c))
    return placed.join(n("sections", "n_sections"), "doc_id", "left").join(n("yedda_lines", "n_lines"), "doc_id", "left").fillna(0, ["n_sections", "n_lines"])


def p1_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each label in each split and the share they are of the label."""
    lines = table(spark, sf_dir, "yedda_lines")
    placed = assign_splits(table(spark, sf_dir, "articles"), lines)
    got = lines.join(placed, "doc_id").groupBy("split", F.lower(F.trim(F.coalesce("label", F.lit("")))).alias("label")).agg(F.count("*").alias("n_lines"))
    whole = got.groupBy("label").agg(F.sum("n_lines").alias("n_label"))
    return got.join(whole, "label").withColumn("share", F.round(F.col("n_lines") / F.col("n_label"), 4))
