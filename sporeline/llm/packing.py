"""Filling fixed-capacity containers with items (problem 8).

Documents are measured in tokens and packed by *conflict-constrained best fit*, in falling
size. Open bins are ordered by their residual room; each carries a bitmap of the sources and
one of the duplicate clusters in it. For an item the successor search starts at the
smallest residual that holds it and goes on to larger ones until a compatible bin is found, so the
bin taken is the tightest compatible one. Two members of a duplicate cluster never share a
bin. Sources are spread where that costs no room: a bin without the item's source is
taken only if it is as tight as the tightest bin free of duplicates.

Only an item larger than a container is cut: into full containers and a rest that is packed
like any item. Items go to lanes of about ``LANE`` rows by a hash, packed independently;
what is lost against one packing are a few bins per lane, whatever the number of lanes.
Hot sources and clusters spread over all lanes.

Defined cases: null, empty and blank-token texts (no token) take no container; ties go to the
smaller id and the older bin; repeated rows are items of their own and, being duplicates, never share a
bin; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.tokens import TOKENIZERS, Tokenizer, load_ranks
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

CAPACITY = 2048
LANE = 10_000
_NOT_WORD = re.compile(r"[\W_]+")


def measured(docs: DataFrame, tokenizers: str = TOKENIZERS) -> DataFrame:
    """``doc_id, source, n_tokens, cluster``; texts alike up to case, punctuation and spacing are one cluster."""
    kept = docs.sparkSession.sparkContext.broadcast(load_ranks(tokenizers))  # bounded: a vocabulary file

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = Tokenizer(kept.value)
        for pdf in batches:
            texts = pdf["text"].fillna("")
            yield pd.DataFrame(
                {
                    "doc_id": pdf["doc_id"],
                    "source": pdf["source"],
                    "n_tokens": [tok.count(t) for t in texts],
                    "cluster": np.array([xxhash.xxh3_64_intdigest(_NOT_WORD.sub(" ", t.lower()).strip()) for t in texts], np.uint64).view(np.int64),
                }
            )

    return docs.select("doc_id", "text", "source").mapInPandas(count, "doc_id long, source string, n_tokens long, cluster long")


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int = CAPACITY) -> list[int]:
    """Bin of each item (items in the order of packing); no item is larger than the capacity."""
    bit: dict = {}
    seen: set = set()
    twice: set = set()
    for c in clusters:
        (twice if c in seen else seen).add(c)
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(twice))}
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins of each residual, oldest first
    filled = 0  # bitmap of residuals that have bins
    has_source: list[int] = []
    has_cluster: list[int] = []
    out = []
    for size, source, cluster in zip(sizes, sources, clusters):
        s, c = bit.setdefault(source, 1 << len(bit)), cluster_bit.get(cluster, 0)
        found = -1
        ahead = filled >> size << size
        while ahead and found < 0:
            room = (ahead & -ahead).bit_length() - 1
            fallback = -1
            for b in by_room[room]:
                if has_cluster[b] & c:
                    continue
                if not has_source[b] & s:
                    found = b
                    break
                if fallback < 0:
                    fallback = b
            if found < 0:
                found = fallback
            ahead &= ahead - 1
        if found < 0:
            found = len(has_source)
            has_source.append(0)
            has_cluster.append(0)
            room = capacity
        else:
            by_room[room].remove(found)
            if not by_room[room]:
                filled &= ~(1 << room)
        has_source[found] |= s
        has_cluster[found] |= c
        left = room - size
        by_room[left].append(found)
        filled |= 1 << left
        out.append(found)
    return out


def packed(items: DataFrame, capacity: int = CAPACITY, lane: int = LANE) -> DataFrame:
    """Containers of ``items(doc_id, source, n_tokens, cluster)``: one row per item or piece of one."""
    items, _ = materialize(items.filter("n_tokens > 0"), "items")
    n = items.count()
    lanes = max(1, -(-n // lane))
    piece = items.withColumn("piece_no", F.explode(F.expr(f"sequence(0, cast(ceil(n_tokens / {capacity}) as int) - 1)")))
    piece = piece.withColumn("tok_start", F.col("piece_no") * F.lit(capacity).cast("long")).withColumn("tok_end", F.least("n_tokens", F.col("tok_start") + capacity)).withColumn("size", F.col("tok_end") - F.col("tok_start"))
    whole = piece.filter(F.col("size") == capacity).select(F.concat(F.lit("f"), F.lpad(F.col("doc_id").cast("string"), 19, "0"), F.lit("-"), F.col("piece_no").cast("string")).alias("container_id"), "doc_id", "piece_no", "tok_start", "tok_end", F.lit(0).cast("long").alias("room"))
    rest = piece.filter(F.col("size") < capacity).withColumn("lane", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(lanes)).cast("int"))
    fields = "container_id string, doc_id long, piece_no int, tok_start long, tok_end long, room long"

    def fill(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "doc_id", "piece_no"], ascending=[False, True, True], kind="stable")
        bins = best_fit(pdf["size"].tolist(), pdf["source"].tolist(), pdf["cluster"].tolist(), capacity)
        room = capacity - pd.Series(pdf["size"].to_numpy()).groupby(bins).sum()
        pdf["container_id"] = [f"p{key[0]:09d}-{b}" for b in bins]
        pdf["room"] = room.reindex(bins).to_numpy()
        return pdf[["container_id", "doc_id", "piece_no", "tok_start", "tok_end", "room"]]

    return whole.unionByName(rest.groupBy("lane").applyInPandas(fill, fields))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(measured(table(spark, sf_dir, "documents")))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers, items and tokens in all, the least number of containers possible, and the share of room used."""
    got = p8_containers(spark, sf_dir)
    total = got.agg(F.count_distinct("container_id").alias("n_containers"), F.count("*").alias("n_pieces"), F.sum(F.col("tok_end") - F.col("tok_start")).alias("n_tokens"))
    return total.withColumn("least_containers", F.ceil(F.col("n_tokens") / CAPACITY)).withColumn("used", F.round(F.col("n_tokens") / (F.col("n_containers") * CAPACITY), 5))
