"""Near-duplicate records with small edits (problem 6).

*Tensored banding.* One would like many tables, each keyed by five minhashes. Instead two
small collections of sub-keys are made, ``X`` (keys of 2 minhashes) and ``Y`` (keys of 2 or 3):
table ``(i, j)`` is keyed by the pair ``(X_i, Y_j)``, so at threshold 0.8 96 tables (8 x 12 keys)
cost 52 minhashes in place of 480. Rows travel once per ``X_i`` with their ``Y`` minhashes, and the tables
``(i, .)`` are formed where they arrive, by sorting. A candidate pair shares a key in at
least one table; it is dropped early only if its Y minhashes put it more than 3.3
standard deviations under the threshold, and then verified exactly on the shingle sets.

Recall of ``x`` keys of 2 and ``y`` keys of ``r`` minhashes at similarity J is ``(1-(1-J^2)^x)(1-(1-J^r)^y)``.
``shape`` takes the numbers of keys from the threshold so that it is 0.99 or more there: 19 x 18 keys
at 0.5 (0.990, and 0.9995 at 0.6), 8 x 12 at 0.8 (0.9995). Exact copies are folded before banding, so their recall is 1.

Skew: copies are folded by a partial aggregation on a 128-bit fingerprint. Buckets are read
as sorted runs, never as one value. A bucket ``X_i`` of more than ``HOT`` rows is split by
its ``Y_j`` first, and a table bucket that is still as large is joined block against block.

Defined cases: rows whose id or main text is null have no pairs; words are lower-cased
runs of letters and digits; a text of fewer words than a shingle has one shingle of all its
words; a text without words equals no other; ids loaded twice count once (the greater text
stands); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.components import hash_to_min
from sporeline.llm.shingles import WordIds, mix, shingle_hashes
from sporeline.operators.skew import hot_keys
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

X_ROWS = 2
#: Least expected recall of the tables for a pair at the threshold.
RECALL = 0.99
#: Rows of one bucket that are handled as one run.
HOT = 4096
BLOCK = 1024
_BATCH = 512


class Shape(NamedTuple):
    """Numbers of X keys, Y keys and minhashes of a Y key."""

    x: int
    y: int
    rows: int

    def recall(self, j: float) -> float:
        return (1 - (1 - j**X_ROWS) ** self.x) * (1 - (1 - j**self.rows) ** self.y)


def shape(threshold: float) -> Shape:
    """The keys for ``RECALL`` at the threshold: Y keys of 3 minhashes if 12 are enough, else of 2."""
    part = 1 - (1 - RECALL) * 0.6  # of the Y keys; the X keys have the rest
    got = Shape(8, 12, 3) if 1 - (1 - threshold**3) ** 12 >= part else Shape(8, 18, 2)
    while 1 - (1 - threshold**got.rows) ** got.y < part:
        got = got._replace(y=got.y + 1)
    while got.recall(threshold) < RECALL:
        got = got._replace(x=got.x + 1)
    return got


def _seeds(sh: Shape) -> np.ndarray:
    return mix(np.arange(1, sh.x * X_ROWS + sh.y * sh.rows + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def _minhashes(hashes: np.ndarray, bounds: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """One row per text: the minimum of each multiplicative hash over its shingles (texts have at least one)."""
    out = np.empty((len(bounds) - 1, len(seeds)), np.uint64)
    for i, a in enumerate(seeds):
        out[:, i] = np.minimum.reduceat(hashes * a, bounds[:-1])
    return out


def _signer(k: int, threshold: float = 0.5):
    sh = shape(threshold)
    seeds, nx = _seeds(sh), sh.x * X_ROWS

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for pdf in batches:
            for lo in range(0, len(pdf), _BATCH):
                part = pdf.iloc[lo : lo + _BATCH]
                h, b = shingle_hashes(part["text"].tolist(), k, ids)
                some = np.flatnonzero(np.diff(b) > 0)
                if not len(some):
                    continue
                starts = b[:-1][some]
                m = _minhashes(h, np.append(starts, b[-1]), seeds)
                x = np.zeros((len(some), sh.x), np.uint64)
                for i in range(sh.x):
                    x[:, i] = mix(mix(m[:, 2 * i]) + m[:, 2 * i + 1] + np.uint64(i))
                y = (mix(m[:, nx:]) >> np.uint64(48)).astype(np.uint16)
                prints = [xxhash.xxh3_128_digest(np.unique(h[s:e]).tobytes()) for s, e in zip(starts, b[1:][some])]
                yield pd.DataFrame({"id": part["id"].to_numpy()[some], "content": prints, "x": list(x.view(np.int64)), "y": [r.tobytes() for r in y]})

    return sign


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts ``keys`` and the starts of runs of two or more equal keys, as (start, length) rows."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    length = np.diff(np.append(first, len(s)))
    many = length > 1
    return order, np.stack([first[many], length[many]], 1)


def _pairs_of_runs(order: np.ndarray, runs: np.ndarray, most: int = 2_000_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of all pairs within each run, in portions of about ``most``."""
    a, b, held = [], [], 0
    two = runs[runs[:, 1] == 2]
    if len(two):
        yield order[two[:, 0]], order[two[:, 0] + 1]
    for start, n in runs[runs[:, 1] > 2]:
        own = order[start : start + n]
        for i in range(n - 1):
            a.append(np.full(n - 1 - i, own[i]))
            b.append(own[i + 1 :])
            held += n - 1 - i
            if held >= most:
                yield np.concatenate(a), np.concatenate(b)
                a, b, held = [], [], 0
    if held:
        yield np.concatenate(a), np.concatenate(b)


def _near(y: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    return (y[a] == y[b]).mean(1) >= least


def _y_of(column: pd.Series, sh: Shape) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(len(column), sh.y * sh.rows)


def _y_keys(y: np.ndarray, j: int, sh: Shape) -> np.ndarray:
    key = np.zeros(len(y), np.uint64)
    for v in y[:, sh.rows * j : sh.rows * (j + 1)].T:
        key = (key << np.uint64(16)) | v.astype(np.uint64)
    return key


def _bucket_pairs(least: float, sh: Shape):
    """Pairs of rows (sorted by key) that share a table key, per run of complete keys."""

    def of(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        x, ids, y = pdf["key"].to_numpy().view(np.uint64), pdf["id"].to_numpy(), _y_of(pdf["y"], sh)
        found = []
        for j in range(sh.y):
            order, runs = _runs(mix(x ^ mix(_y_keys(y, j, sh))))
            for a, b in _pairs_of_runs(order, runs):
                ok = (x[a] == x[b]) & (ids[a] != ids[b])
                a, b = a[ok], b[ok]
                ok = _near(y, a, b, least)
                found.append(np.stack([np.minimum(ids[a[ok]], ids[b[ok]]), np.maximum(ids[a[ok]], ids[b[ok]])], 1))
        if found and len(got := np.unique(np.concatenate(found), axis=0)):
            yield pd.DataFrame({"a": got[:, 0], "b": got[:, 1]})

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for pdf in batches:
            if not len(pdf):
                continue
            last = pdf["key"].iloc[-1]
            done = int(np.searchsorted(pdf["key"].to_numpy(), last))
            if done or (held and held[-1]["key"].iloc[-1] != last):
                yield from of(pd.concat([*held, pdf.iloc[:done]], ignore_index=True))
                held = []
            held.append(pdf.iloc[done:])
        if held:
            yield from of(pd.concat(held, ignore_index=True))

    return stream


def _block_pairs(least: float, sh: Shape):
    """Within a task one pair of blocks of one bucket: all pairs of a row of the one with a row of the other."""

    def of(key, pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[pdf["side"] != 1], pdf[pdf["side"] != 0]
        y1, y2, i1, i2 = _y_of(left["y"], sh), _y_of(right["y"], sh), left["id"].to_numpy(), right["id"].to_numpy()
        found = []
        for i in range(len(i1)):
            ok = ((y2 == y1[i]).mean(1) >= least) & (i2 != i1[i])
            found.append(np.stack([np.minimum(i2[ok], i1[i]), np.maximum(i2[ok], i1[i])], 1))
        got = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
        return pd.DataFrame({"a": got[:, 0], "b": got[:, 1]}, dtype="int64")

    return of


def candidate_pairs(signed: DataFrame, threshold: float, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """Distinct ``(a, b)`` of ``signed(id, x, y)`` that share a key in at least one of the tables."""
    sh = shape(threshold)
    least = threshold - 3.3 * (threshold * (1 - threshold) / (sh.y * sh.rows)) ** 0.5
    rows = signed.select(F.explode("x").alias("key"), "id", "y")
    big = hot_keys(signed.select(F.explode("x").alias("key")).groupBy("key").agg(F.count("*").alias("n")), "key", "n", hot)
    out = "a long, b long"

    def streamed(r: DataFrame) -> DataFrame:
        return r.repartition("key").sortWithinPartitions("key").mapInPandas(_bucket_pairs(least, sh), out)

    if not big:
        return streamed(rows).distinct()
    is_big = F.col("key").isin(list(big))
    pairs = streamed(rows.filter(~is_big))
    # X buckets that are too large for one run: one key per table, so that each (i, j) goes its own way
    part = lambda j: F.substring("y", 2 * sh.rows * j + 1, 2 * sh.rows)
    keys = F.array(*[F.xxhash64("key", F.lit(j), part(j)) for j in range(sh.y)])
    direct, _ = materialize(rows.filter(is_big).select(F.explode(keys).alias("key"), "id", "y"), "direct")
    sizes = direct.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    sizes, _ = materialize(sizes, "bucket-sizes")
    met = direct.join(sizes, "key")
    pairs = pairs.union(streamed(met.filter(F.col("n") <= hot).select("key", "id", "y")))
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = met.filter(F.col("n") > hot).withColumn("nb", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("nb")).cast("int"))
    # each row meets every block once: block pairs (lo, hi), lo = hi within a block
    sent = own.withColumn("other", F.explode(F.expr("sequence(0, nb - 1)"))).select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), F.expr("case when own = other then 2 when own < other then 0 else 1 end").alias("side"), "id", "y")
    return pairs.union(sent.groupBy("key", "lo", "hi").applyInPandas(_block_pairs(least, sh), out)).distinct()


def _verifier(k: int, threshold: float):
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for pdf in batches:
            keep = np.zeros(len(pdf), bool)
            sim = np.zeros(len(pdf))
            for lo in range(0, len(pdf), _BATCH):
                part = pdf.iloc[lo : lo + _BATCH]
                h, b = shingle_hashes(part["text_a"].tolist() + part["text_b"].tolist(), k, ids)
                n = len(part)
                for i in range(n):
                    s, t = np.unique(h[b[i] : b[i + 1]]), np.unique(h[b[n + i] : b[n + i + 1]])
                    both = len(np.intersect1d(s, t, assume_unique=True))
                    either = len(s) + len(t) - both
                    sim[lo + i] = both / either if either else 0
                    keep[lo + i] = either > 0 and both >= threshold * either
            yield pd.DataFrame({"a": pdf["a"][keep], "b": pdf["b"][keep], "similarity": sim[keep]})

    return verify


def near_duplicates(records: DataFrame, k: int = 5, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Of ``records(id, text)``: links between different texts and the copies folded.

    Returns ``(links(a, b, similarity), members(id, rep))``: a and b are the smallest ids
    of two classes of equal shingle sets whose Jaccard similarity is ``threshold`` or more;
    members gives the class of every record that has a shingle.
    """
    texts = records.filter("id is not null and text is not null").groupBy("id").agg(F.max("text").alias("text"))
    signed, _ = materialize(texts.mapInPandas(_signer(k, threshold), "id long, content binary, x array<long>, y binary"), "signed")
    classes, _ = materialize(signed.groupBy("content").agg(F.min("id").alias("id"), F.min_by(F.struct("x", "y"), "id").alias("s")).select("content", "id", "s.x", "s.y"), "classes")
    members = signed.select("id", "content").join(classes.select("content", F.col("id").alias("rep")), "content").select("id", "rep")
    found, _ = materialize(candidate_pairs(classes.select("id", "x", "y"), threshold), "candidates")
    ends = found.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    needed, _ = materialize(texts.join(ends, "id"), "candidate-texts")
    side = lambda c: needed.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}"))
    links = found.join(side("a"), "a").join(side("b"), "b").mapInPandas(_verifier(k, threshold), "a long, b long, similarity double")
    return links, members


def all_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """Every pair ``(id_a, id_b)`` of linked records, those of equal texts included."""
    m, _ = materialize(members, "members")
    many = m.join(m.groupBy("rep").agg(F.count("*").alias("n")).filter("n > 1").select("rep"), "rep")
    same = many.select("rep", F.col("id").alias("id_a")).join(many.select("rep", F.col("id").alias("id_b")), "rep").filter("id_a < id_b").select("id_a", "id_b")
    a = m.select(F.col("rep").alias("a"), F.col("id").alias("ia"))
    b = m.select(F.col("rep").alias("b"), F.col("id").alias("ib"))
    cross = links.select("a", "b").join(a, "a").join(b, "b").select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"))
    return same.union(cross)


def _treatments(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "treatments").filter("description is not null")
    return t.select(F.col("row_id").alias("id"), F.concat(F.coalesce("treatment", F.lit("")), F.lit(" "), F.col("description")).alias("text"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    links, members = near_duplicates(_treatments(spark, sf_dir), k=3, threshold=0.5)
    return all_pairs(links, members).toDF("row_id_a", "row_id_b")


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per treatment: the class of its exact copies, its group of near-duplicates and its links to other texts."""
    links, members = near_duplicates(_treatments(spark, sf_dir), k=3, threshold=0.5)
    links, _ = materialize(links, "links")
    ends = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    comp = hash_to_min(links.select(F.col("a").alias("node"), F.col("b").alias("member"))).select(F.col("node").alias("rep"), "component")
    got = members.join(ends, "rep", "left").join(comp, "rep", "left")
    return got.select(F.col("id").alias("row_id"), F.col("rep").alias("class_id"), F.coalesce("component", "rep").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


SQL = {
    "p6_found": r"""
with t as (select row_id, regexp_extract_all(lower(coalesce(treatment, '') || ' ' || description), '[\p{L}\p{N}]+') w from treatments where description is not null),
s as (select distinct row_id, case when len(w) < 3 then array_to_string(w, ' ') else w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] end g
      from (select row_id, w, unnest(range(1, greatest(len(w) - 1, 2))) i from t where len(w) > 0)),
n as (select row_id, count(*) n from s group by 1),
b as (select a.row_id x, b.row_id y, count(*) c from s a join s b on a.g = b.g and a.row_id < b.row_id group by 1, 2)
select x as row_id_a, y as row_id_b from b join n p on p.row_id = x join n q on q.row_id = y where 2 * c >= p.n + q.n - c
""",
}
