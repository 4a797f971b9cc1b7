"""Records and their parts: folds, merges, nested text, alignment, fits."""

from __future__ import annotations

import difflib
import json
import re
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def roman(c: Column) -> Column:
    """Value of a Roman numeral in lower case; null for anything else."""
    value = F.create_map(*[F.lit(x) for kv in {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}.items() for x in kv])
    digits = F.transform(F.regexp_extract_all(c, F.lit("([ivxlcdm])"), F.lit(1)), lambda x: F.element_at(value, x))
    folded = F.aggregate(F.reverse(digits), F.struct(F.lit(0).alias("sum"), F.lit(0).alias("top")), lambda s, x: F.struct((s["sum"] + F.when(x < s["top"], -x).otherwise(x)).alias("sum"), F.greatest(s["top"], x).alias("top")))
    return F.when(c.rlike("^[ivxlcdm]+$"), folded["sum"])


def first_line(c: Column, most: int = 60) -> Column:
    """First line that is not blank, cut with an ellipsis."""
    line = F.get(F.filter(F.transform(F.split(c, "\n", -1), lambda x: F.btrim(x)), lambda x: x != ""), 0)
    return F.when(F.char_length(line) > most, F.concat(F.rtrim(F.substring(line, 1, most - 1)), F.lit("…"))).otherwise(line)


def greedy_groups(sizes: Column, most: int) -> Column:
    """Group number of each element when an ordered array is packed in turn into groups of at most ``most``."""
    start = F.struct(F.array().cast("array<int>").alias("out"), F.lit(0).alias("group"), F.lit(0).alias("load"))

    def step(s, x):
        new = (s["load"] > 0) & (s["load"] + x > most)
        group = F.when(new, s["group"] + 1).otherwise(s["group"])
        return F.struct(F.concat(s["out"], F.array(group)).alias("out"), group.alias("group"), F.when(new, x).otherwise(s["load"] + x).alias("load"))

    return F.aggregate(sizes, start, step)["out"]


def _url_ids(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: str(uuid.uuid5(uuid.NAMESPACE_URL, u)) if u is not None else None)


def url_id(url) -> Column:
    """Name-based id of a URL."""
    return F.pandas_udf(_url_ids, "string")(url)


_DECODER = json.JSONDecoder()


def balanced_json(text: str | None) -> str | None:
    """First JSON object that parses in noisy text, as it stands there."""
    at = text.find("{") if text else -1
    while at >= 0:
        try:
            return text[at : _DECODER.raw_decode(text, at)[1]]
        except (ValueError, RecursionError):
            at = text.find("{", at + 1)
    return None


def _balanced(texts: pd.Series) -> pd.Series:
    return texts.map(balanced_json)


def json_in_text(text) -> Column:
    return F.pandas_udf(_balanced, "string")(text)


def deep_merge(values: list[str]) -> str:
    """JSON objects put together: objects by key, lists without repeats in order, of scalars the first."""

    def both(a, b):
        if isinstance(a, dict) and isinstance(b, dict):
            return {k: both(a[k], b[k]) if k in a and k in b else a.get(k, b.get(k)) for k in [*a, *[k for k in b if k not in a]]}
        if isinstance(a, list) and isinstance(b, list):
            return [*a, *[x for i, x in enumerate(b) if x not in a and x not in b[:i]]]
        return a

    out: dict = {}
    for v in values:
        got = json.loads(v) if v else {}
        out = both(out, got if isinstance(got, dict) else {})
    return json.dumps(out, ensure_ascii=False)


def merge_json(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """One merged object per key, in order."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return pd.DataFrame({key: [pdf[key].iloc[0]], "merged": [deep_merge(pdf[value].tolist())]})

    kind = dict(df.dtypes)[key]
    return df.select(key, order, value).groupBy(key).applyInPandas(run, f"{key} {kind}, merged string")


def nested_labels(text: str) -> list[tuple[str, str | None]]:
    """Lines of nested annotated text with the innermost label of each."""
    out, stack = [], []
    marks = list(re.finditer(r"\[@|#([^*\]]+)\*\]", text))
    label_of: dict[int, str] = {}
    opened = []
    for m in marks:
        if m.group(0) == "[@":
            opened.append(m.start())
        elif opened:
            label_of[opened.pop()] = m.group(1)
    at = 0
    for line in text.split("\n"):
        inside: list[str | None] = [label_of.get(s) for s in stack]
        bare, i = "", 0
        for m in re.finditer(r"\[@|#([^*\]]+)\*\]", line):
            bare += line[i : m.start()]
            if m.group(0) == "[@":
                stack.append(at + m.start())
                inside.append(label_of.get(stack[-1]))
            elif stack:
                stack.pop()
            i = m.end()
        bare += line[i:]
        out.append((bare.strip(), inside[-1] if inside else None))
        at += len(line) + 1
    return out


def align_blocks(old: list[tuple[str, str]], new: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The old blocks, each with the tag of the new block it is matched to along the longest common subsequence of texts, else its own."""
    out = list(old)
    for run in difflib.SequenceMatcher(None, [t for t, _ in old], [t for t, _ in new], autojunk=False).get_matching_blocks():
        out[run.a : run.a + run.size] = [(t, tag) for (t, _), (_, tag) in zip(out[run.a : run.a + run.size], new[run.b :])]
    return out


def _changes(base: list[str], other: list[str]) -> list[tuple[int, int, list[str]]]:
    return [(i, j, other[k:m]) for op, i, j, k, m in difflib.SequenceMatcher(None, base, other, autojunk=False).get_opcodes() if op != "equal"]


def three_way(base: str, left: str, right: str) -> str:
    """Lines of two versions of a text merged.

    Changes of the two sides that overlap, or begin at the same line, form one region; if both sides made the
    same of it, or only one changed it, that stands, else both stand between conflict marks. No line of either side is lost.
    """
    b = base.split("\n")
    sides = [_changes(b, left.split("\n")), _changes(b, right.split("\n"))]
    todo = sorted((i, j, side, k) for side, own in enumerate(sides) for k, (i, j, _) in enumerate(own))
    out: list[str] = []
    at = n = 0
    while n < len(todo):
        lo, hi = todo[n][:2]
        own: list[list] = [[], []]
        while n < len(todo) and (todo[n][0] < hi or todo[n][0] == lo):
            i, j, side, k = todo[n]
            own[side].append(sides[side][k])
            hi = max(hi, j)
            n += 1
        out += b[at:lo]
        made = []
        for mine in own:
            text, pos = [], lo
            for i, j, lines in mine:
                text += b[pos:i] + lines
                pos = j
            made.append(text + b[pos:hi])
        if not own[0] or not own[1] or made[0] == made[1]:
            out += made[0] if own[0] else made[1]
        else:
            out += ["<<<<<<<", *made[0], "=======", *made[1], ">>>>>>>"]
        at = hi
    return "\n".join(out + b[at:])


def per_document(rows: DataFrame, key: str, order: str, columns: list[str], run, out: str) -> DataFrame:
    """``run(list of rows)`` of each document, rows in order; what it returns are rows of ``out``."""
    names = [c.split(" ")[0] for c in out.split(", ")]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        got = run(list(zip(*[pdf[c] for c in columns])))
        return pd.DataFrame([(pdf[key].iloc[0], *r) for r in got], columns=names)

    return rows.select(key, order, *[c for c in columns if c != order]).groupBy(key).applyInPandas(one, out)


def best_line(points: DataFrame, keys: list[str], x: str, y: str, slack: float = 1.0) -> DataFrame:
    """Line that most neighbouring points of a group lie on, and how many of all points are near to it."""
    p = points.select(*keys, F.col(x).cast("double").alias("px"), F.col(y).cast("double").alias("py")).distinct()
    w = Window.partitionBy(*keys).orderBy("px", "py")
    step = p.withColumn("qx", F.lag("px").over(w)).withColumn("qy", F.lag("py").over(w)).filter("px > qx")
    lines = step.withColumn("slope", F.round((F.col("py") - F.col("qy")) / (F.col("px") - F.col("qx")), 6)).withColumn("at0", F.round(F.col("py") - F.col("slope") * F.col("px"), 6))
    votes = lines.groupBy(*keys, "slope", "at0").agg(F.count("*").alias("votes"))
    best = votes.groupBy(*keys).agg(F.max_by(F.struct("slope", "at0", "votes"), F.struct("votes", -F.abs(F.col("slope") - 1), -F.col("slope"), -F.col("at0"))).alias("b")).select(*keys, "b.*")
    return p.join(best, keys).groupBy(*keys, "slope", "at0", "votes").agg(F.count_if(F.abs(F.col("py") - F.col("slope") * F.col("px") - F.col("at0")) <= slack).alias("n_near"), F.count("*").alias("n_points"))
