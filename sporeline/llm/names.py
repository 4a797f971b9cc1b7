"""Variant spellings of names typed by people (problem 5).

A typed name is taken apart into genus, epithet, authors and year; remarks are dropped. Of
each distinct name two sets of padded q-grams are made, of genus and epithet and of epithet
and authors, so that a name with a shortened genus and one without authors both meet the full
name. MinHash bands over these sets give candidates; the number of bands follows from the
collision curve ``1-(1-s^r)^b`` for the recall wanted at ``LOWEST``, just under the lowest similarity (0.62) of
any two names of the sf 0.1 table that the verification accepts, every pair of names compared; the curve expects
0.9999 of those pairs. Two slips in a very short epithet beside a shortened genus leave 0.5 or less and are
met with a probability of 0.8 or less. Candidates are verified by Monge-Elkan similarity over their parts, with
shortened parts matching their beginnings, and then grouped by star clustering: names with
the most verified neighbours become centres and take their neighbours; a name next
to several centres goes to the one most like it.

A part that is no slip of the other is told from a slip by counts over the whole table:
two epithets that are both common are different ones, however alike.

Skew: equal names are folded before banding and expanded at the end; a band bucket is joined block by block
of ``BLOCK`` names; candidates are distinct pairs, and those whose epithets are more than a slip apart are dropped before they are verified;
hot names, epithets, genera and entities are salted.

Defined cases: null and blank names link to nothing; rows spelled alike are linked whatever
they say; names of one word link only to their like; a name without authors that fits
several homonyms goes to one of them; repeated ids count once; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.shingles import mix
from sporeline.operators.skew import hot_keys, salted_join
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

Q, ROWS, LOWEST, RECALL = 2, 5, 0.6, 0.99
#: Times that the first letter of the genus stands in the second view; rows of a band bucket that are joined as one block.
INITIALS, BLOCK = 3, 1024
BANDS = math.ceil(math.log(1 - RECALL) / math.log(1 - LOWEST**ROWS))
LEAST_SIMILARITY = 0.8
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)

#: Remarks added to names.
_REMARK = re.compile(
    r"\[[^\]]*\]|\((?:as|sub|ut|orth)\b[^)]*\)|\bin\s+litt\b\.?|\bin\s+sched\b\.?|,?\s*\bauctt?\b\.?(?:\s+non\b)?|\bs\.\s*(?:str|l|lat|ampl)\b\.?|\bsensu\s+(?:stricto|lato|auctt?\.?)|\b(?:cf|aff|nr)\b\.?(?=\s)|\b(?:sp|spec|gen|comb|stat|nom|var|f)\.\s*(?:nov|cons|nud|inval|illeg|rej|prov|ined|ambig|dub|nova|novum)\b\.?|\bined\b\.?|\bemend\b\.?|[?!*\"]",
    re.IGNORECASE,
)
_YEAR = re.compile(r"\b(1[5-9]\d\d|20\d\d)\b")
_AND = re.compile(r"\s*(?:&|\b(?:and|et|und|y|ac)\b)\s*", re.IGNORECASE)


def bare(raw: str) -> str:
    """Without marks over letters, remarks and doubled blanks; letter case stays."""
    s = unicodedata.normalize("NFKD", raw.replace("_", " ").replace(" ", " "))
    s = "".join(c for c in s if not unicodedata.combining(c))
    return " ".join(_REMARK.sub(" ", s).split())


def _authors(text: str) -> list[str]:
    parts = [re.sub(r"[^\w.\- ]", " ", a).strip(" -").lower() for a in re.split(r"[,;]|\x00", _AND.sub("\x00", text))]
    out = []
    for p in parts:
        words = [w for w in p.split() if w.strip(".")]
        if words:
            out.append(max(words, key=len) if len(words) > 1 else words[0])
    return out


def parse(raw: str | None) -> list[tuple[str, str, str, str]]:
    """Readings ``(genus, epithet, authors, year)`` of a typed name; several where letter case tells nothing.

    A shortened part keeps its point; authors are joined by blanks.
    """
    if raw is None or not (s := bare(raw)):
        return []
    year = (_YEAR.findall(s) or [""])[-1]
    s = _YEAR.sub(" ", s)
    m = re.match(r"^([^:]+?)\s*:\s*([^\s:]+)\s+([\w-]+)\s*$", s)
    if m:
        return [(m[2].lower(), m[3].lower(), " ".join(_authors(m[1])), year)]
    m = re.match(r"^([\w-]+)\s*,\s*([\w-]+\.?)\s*(?:\(([^)]*)\))?\s*$", s)
    if m and (m[3] or m[1][:1].islower()):
        return [(m[2].lower(), m[1].lower(), " ".join(_authors(m[3] or "")), year)]
    s = re.sub(r"[()]", " ", s)
    words = s.split()
    if len(words) < 2:
        return [(s.strip(" ,;").lower(), "", "", year)]
    genus, rest = words[0].strip(",;").lower(), words[1:]
    plain = lambda k: re.sub(r"[^\w-]", "", rest[k]).lower()
    others = lambda k: " ".join(_authors(" ".join(rest[:k] + rest[k + 1 :])))
    if len(rest) == 1:
        return [(genus, plain(0), "", year)]
    letters = re.sub(r"\W|\d", "", s)
    if not (letters.isupper() or letters.islower()):
        low = [k for k, w in enumerate(rest) if w[:1].islower() and w.lower() not in ("and", "et", "und", "y", "ac")]
        if low:
            return [(genus, plain(low[0]), others(low[0]), year)]
    ends = [0, len(rest) - 1]
    if _AND.fullmatch(rest[1]) or rest[0].endswith(",") and len(rest) > 2 and _AND.fullmatch(rest[2]):
        ends = [len(rest) - 1]
    elif len(rest) > 2 or rest[-1].endswith("."):
        ends = [0] if not (len(rest) > 3 and _AND.fullmatch(rest[1])) else ends
    return [(genus, plain(k), others(k), year) for k in ends]


def stem(epithet: str) -> str:
    """The epithet without its gender ending."""
    for a, b in (("us", ""), ("um", ""), ("os", ""), ("is", "i"), ("a", ""), ("e", "i")):
        if epithet.endswith(a) and len(epithet) - len(a) >= 2:
            return epithet[: -len(a)] + b
    return epithet


def _grams(s: str, tag: str) -> set[str]:
    p = f"{'#' * (Q - 1)}{s}{'#' * (Q - 1)}"
    return {tag + p[i : i + Q] for i in range(len(p) - Q + 1)}


def views(genus: str, epithet: str, authors: str) -> list[set[str] | None]:
    """Sets of padded q-grams: of genus and epithet, and of epithet, first author and ``INITIALS`` times the first letter of the genus."""
    e = _grams(stem(epithet), "e")
    whole = _grams(genus, "g") | e if not genus.endswith(".") and len(genus) > 2 else None
    if not authors:
        return [whole, None]
    first = authors.split()[0].strip(".")[:4]
    return [whole, e | _grams(first, "a") | {f"i{k}{genus[:1]}" for k in range(INITIALS)}]


def _bander(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, int] = {}
    for pdf in batches:
        ids, keys = [], []
        for i, g, e, a in zip(pdf["id"], pdf["genus"], pdf["epithet"], pdf["authors"]):
            for v, grams in enumerate(views(g, e, a)):
                if not grams:
                    continue
                h = np.array([known.get(x) or known.setdefault(x, xxhash.xxh3_64_intdigest(x)) for x in grams], np.uint64)
                m = (h[:, None] * _SEEDS[None, :]).min(0).reshape(BANDS, ROWS)
                k = np.full(BANDS, v, np.uint64) + np.arange(BANDS, dtype=np.uint64) * np.uint64(7)
                for r in range(ROWS):
                    k = mix(k + m[:, r])
                ids.append(np.full(BANDS, i))
                keys.append(k.view(np.int64))
        if len(known) > 500_000:
            known.clear()
        if ids:
            yield pd.DataFrame({"key": np.concatenate(keys), "id": np.concatenate(ids)})


@lru_cache(maxsize=400_000)
def slips(a: str, b: str, most: int = 2) -> int:
    """Edits (swaps of neighbours count once) from a to b, or ``most + 1`` when there are more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            v = min(prev[j] + 1, row[j - 1] + 1, prev[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, prev2[j - 2] + 1)
            row.append(v)
        if min(row) > most:
            return most + 1
        prev2, prev = prev, row
    return min(prev[-1], most + 1)


def likeness(a: str, b: str) -> float:
    """Of two parts of names: 1 for equal ones and for a shortened one and its whole."""
    if a == b:
        return 1.0
    short, long = (a, b) if a.endswith(".") else (b, a)
    if short.endswith("."):
        s, t = short[:-1], long.rstrip(".")
        if len(s) > len(t):
            s, t = t, s
        if t.startswith(s):
            return 0.98
        return max(0.0, 1 - min(slips(s, t[:k]) for k in (len(s) - 1, len(s), len(s) + 1)) / max(len(s), 1)) if len(s) >= 4 else 0.0
    n = slips(a, b)
    return max(0.0, 1 - n / max(len(a), len(b))) if n <= 2 else 0.0  # slips counts no further


def monge_elkan(a: list[str], b: list[str]) -> float:
    """The smaller of the two mean best likenesses."""
    if not a or not b:
        return 0.0
    one = sum(max(likeness(x, y) for y in b) for x in a) / len(a)
    two = sum(max(likeness(x, y) for x in a) for y in b) / len(b)
    return min(one, two)


def similarity(a: tuple, b: tuple) -> float:
    """Of two names ``(genus, epithet, authors, year, rows of the epithet, rows of the genus)``; 0 where they cannot be one taxon."""
    g1, e1, a1, y1, n1, m1 = a
    g2, e2, a2, y2, n2, m2 = b
    if g1[0] != g2[0] and slips(g1, g2) > 1:
        return 0.0
    s1, s2 = stem(e1), stem(e2)
    if s1 != s2:
        if min(slips(s1, s2), slips(e1, e2)) > 1 or max(len(e1), len(e2)) < 5 or min(n1, n2) > 0.12 * max(n1, n2) + 1:
            return 0.0
    g = likeness(g1, g2)
    if g < 0.75:
        return 0.0
    if g < 1 and not g1.endswith(".") and not g2.endswith(".") and min(m1, m2) > 0.25 * max(m1, m2) + 2:
        return 0.0
    if y1 and y2 and y1 != y2:
        return 0.0
    if a1 and a2:
        p, q = a1.split(), a2.split()
        if len(p) != len(q):
            return 0.0
        if min(likeness(x, y) for x, y in zip(p, q)) < 0.7:
            return 0.0
    elif g1.endswith(".") or g2.endswith("."):
        return 0.0
    left = [g1, s1, *a1.split()] if a1 and a2 else [g1, s1]
    right = [g2, s2, *a2.split()] if a1 and a2 else [g2, s2]
    return monge_elkan(left, right) - (0.03 if not (a1 and a2) else 0.0)


_PARTS = ("genus", "epithet", "authors", "year", "n_epithet", "n_genus")


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        left = zip(*[pdf[f"{c}_a"] for c in _PARTS])
        right = zip(*[pdf[f"{c}_b"] for c in _PARTS])
        sim = np.fromiter((similarity(x, y) for x, y in zip(left, right)), float, len(pdf))
        ok = sim >= LEAST_SIMILARITY
        yield pd.DataFrame({"a": pdf["a"][ok], "b": pdf["b"][ok], "sim": sim[ok]})


def _readings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(i, len(p), k, *r) for i, t in zip(pdf["id"], pdf["name"]) for p in [parse(t)] for k, r in enumerate(p)]
        yield pd.DataFrame(rows, columns=["id", "readings", "reading", "genus", "epithet", "authors", "year"])


def _end_rank(epithet: str) -> str:
    return "case when {0} rlike '(us|um|is|ens|ans|ior|ex|pes|cola)$' then 2 when {0} rlike '(ae|ii|a|e|i)$' then 1 else 0 end".format(epithet)


def parsed_names(rows: DataFrame) -> DataFrame:
    """One reading of each ``rows(id, name)``; between several the one whose epithet is commonest among the sure ones."""
    read, _ = materialize(rows.mapInPandas(_readings, "id long, readings int, reading int, genus string, epithet string, authors string, year string"), "readings")
    sure = read.filter("readings = 1 and epithet <> ''").groupBy("epithet").agg(F.count("*").alias("n"))
    doubtful = read.filter("readings > 1").join(sure, "epithet", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    best = doubtful.withColumn("rank", F.struct("n", F.expr(_end_rank("epithet")), -F.col("reading")))
    chosen = best.groupBy("id").agg(F.max_by(F.struct("genus", "epithet", "authors", "year"), "rank").alias("p")).select("id", "p.*")
    return read.filter("readings = 1").select("id", "genus", "epithet", "authors", "year").union(chosen)


def star_clusters(edges: DataFrame, rank: DataFrame, max_rounds: int = 40) -> DataFrame:
    """``(id, centre)`` from ``edges(a, b, sim)`` and ``rank(id, weight)``.

    In each round every free node whose weight tops that of all free neighbours becomes a
    centre and its free neighbours its satellites, until no edge joins two free nodes. A
    satellite then goes to the most similar of the centres next to it.
    """
    spark = edges.sparkSession
    both, _ = materialize(edges.select("a", "b", "sim").union(edges.select("b", "a", "sim")).toDF("a", "b", "sim"), "star-edges")
    degree = both.groupBy("a").agg(F.sum("sim").alias("d")).withColumnRenamed("a", "id")
    order = rank.join(degree, "id").select("id", F.struct("weight", "d", -F.col("id")).alias("w"))
    live, _ = materialize(both.join(order.select(F.col("id").alias("a"), F.col("w").alias("wa")), "a").join(order.select(F.col("id").alias("b"), F.col("w").alias("wb")), "b"), "star-live")
    centres = None
    for _ in range(max_rounds):
        tops = live.groupBy("a", "wa").agg(F.max("wb").alias("top")).filter("wa > top").select(F.col("a").alias("centre"))
        tops, _ = materialize(tops, "centres")
        if tops.isEmpty():
            break
        centres = tops if centres is None else centres.union(tops)
        gone = tops.union(live.join(tops, live["a"] == tops["centre"]).select("b")).toDF("gone").distinct()
        gone, _ = materialize(gone, "gone")
        left = live.join(gone, live["a"] == gone["gone"], "left_anti")
        live, _ = materialize(left.join(gone, left["b"] == gone["gone"], "left_anti"), "star-live")
    if centres is None:
        return spark.createDataFrame([], "id long, centre long")
    weights = order.select(F.col("id").alias("centre"), "w")
    sat = both.join(centres.withColumnRenamed("centre", "b"), "b").join(weights.withColumnRenamed("centre", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.max_by("b", F.struct("sim", "w")).alias("centre"))
    own = centres.select(F.col("centre").alias("id"), F.col("centre"))
    return own.union(sat.join(own.select("id"), "id", "left_anti"))


def linked_names(rows: DataFrame) -> DataFrame:
    """``(id, entity)`` of ``rows(id, name)``: entity is the smallest id of those that name one thing; null names are left out."""
    named = rows.filter("id is not null and trim(coalesce(name, '')) <> ''").groupBy("id").agg(F.max("name").alias("name"))
    spelled, _ = materialize(named.groupBy("name").agg(F.min("id").alias("id")), "spelled")  # rows spelled alike are one
    key = ["genus", "epithet", "authors", "year"]
    parts, _ = materialize(parsed_names(spelled), "parts")
    folded, _ = materialize(parts.groupBy(*key).agg(F.min("id").alias("rec"), F.count("*").alias("n")), "folded")

    def counted(df: DataFrame, c: str) -> DataFrame:
        per = folded.groupBy(c).agg(F.sum("n").alias(f"n_{c}"), F.count("*").alias("_rows"))
        return salted_join(df, per.select(c, f"n_{c}"), c, hot_keys(per, c, "_rows"), F.col("rec"))

    rec, _ = materialize(counted(counted(folded, "epithet"), "genus").select(F.col("rec").alias("id"), *key, "n_epithet", "n_genus", "n"), "records")
    two = rec.filter("epithet <> '' and genus <> ''")
    bands, _ = materialize(two.select("id", "genus", "epithet", "authors").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id").mapInPandas(_bander, "key long, id long"), "bands")
    met = bands.join(bands.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "key").withColumn("blocks", F.ceil(F.col("c") / BLOCK).cast("int"))
    left = met.select("key", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), F.col("id").alias("a"))
    right = met.select("key", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), F.col("id").alias("b"))
    pairs, _ = materialize(left.join(right, ["key", "block"]).filter("a < b").select("a", "b").distinct(), "name-pairs")
    side = lambda c: two.select(F.col("id").alias(c), *[F.col(p).alias(f"{p}_{c}") for p in _PARTS])
    near = lambda f: F.levenshtein(f("epithet_a"), f("epithet_b"), 2) >= 0
    bare_end = lambda c: F.regexp_replace(c, "(us|um|os|is|a|e)$", "")
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(near(F.col) | near(bare_end))  # a slip is one edit, or two where letters changed places; an ending more
    links, _ = materialize(both.mapInPandas(_verify, "a long, b long, sim double"), "name-links")
    whole = F.when(F.col("genus").endswith("."), 0).otherwise(2) + F.when(F.col("authors") == "", 0).when(F.col("authors").contains("."), 1).otherwise(2)
    stars = star_clusters(links, two.select("id", (whole * 1000 + F.least(F.col("n"), F.lit(99))).alias("weight")))
    of_name, _ = materialize(parts.join(folded.select(*key, "rec"), key).join(stars.withColumnRenamed("id", "rec"), "rec", "left").select(F.col("id").alias("name_id"), F.coalesce("centre", "rec").alias("centre")), "of-name")
    names = spelled.select("name", F.col("id").alias("name_id")).join(of_name, "name_id").select("name", "centre")
    of_row, _ = materialize(salted_join(named, names, "name", hot_keys(named.groupBy("name").agg(F.count("*").alias("n")), "name", "n"), F.col("id")).select("id", "centre"), "of-row")
    first = of_row.groupBy("centre").agg(F.min("id").alias("entity"), F.count("*").alias("n"))
    first, _ = materialize(first, "first-of-entity")
    return salted_join(of_row, first.select("centre", "entity"), "centre", hot_keys(first, "centre", "n"), F.col("id")).select("id", "entity")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "taxon").select(F.col("taxon_id").alias("id"), F.col("taxon").alias("name"))


def p5_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per named row: the entity it names and the number of rows that name it."""
    got, _ = materialize(linked_names(_rows(spark, sf_dir)), "entities")
    return got.join(got.groupBy("entity").agg(F.count("*").alias("n_rows")), "entity").select(F.col("id").alias("taxon_id"), F.col("entity").alias("entity_id"), "n_rows")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    got, _ = materialize(linked_names(_rows(spark, sf_dir)), "entities")
    return got.select("entity", F.col("id").alias("taxon_id_a")).join(got.select("entity", F.col("id").alias("taxon_id_b")), "entity").filter("taxon_id_a < taxon_id_b").select("taxon_id_a", "taxon_id_b")
