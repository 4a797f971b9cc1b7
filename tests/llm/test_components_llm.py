import random

from pyspark.sql import functions as F

from sporeline.llm import components as C

ART = "doc_id string, authors array<string>, source_key string, taxon_key string, extra string, node string, key string"
LINES = "doc_id string, label string"


def art(spark, rows):
    return spark.createDataFrame([(*r, None, "x", "y") for r in rows], ART)


def groups(df):
    return {r["doc_id"]: r["group_doc_id"] for r in df.collect()}


def test_normal_key():
    assert C.normal_key("  Ann  B́ee ") == C.normal_key("ANN Ḃ́ee".replace("Ḃ́", "B́"))
    assert C.normal_key("É") == C.normal_key("É") != C.normal_key("E")
    assert all(C.normal_key(x) is None for x in (None, "", " ", "N. N.", "[unknown]", "ANONYMOUS ", "?", "n/a", "-"))


def test_groups_and_unknowns(spark):
    a = art(spark, [("a", ["X Y", "?"], None, None), ("b", ["x  y"], "k 1", None), ("c", None, "K 1 ", "FN 1"), ("d", ["?"], "n/a", "FN 2"), ("e", [None, "unknown"], None, "FN 3"), ("c", None, "K 1", "FN 1"), (None, ["X Y"], None, None)])
    assert groups(C.related_groups(a)) == {"a": "a", "b": "a", "c": "a"}


def test_empty_tables(spark):
    a = art(spark, [])
    assert C.related_groups(a).count() == 0
    assert C.assign_splits(a, spark.createDataFrame([], LINES)).count() == 0


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(f"n{rng.randint(0, 120):03d}", f"n{rng.randint(0, 120):03d}") for _ in range(110)]
    edges += [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(70)]
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in C.hash_to_min(spark.createDataFrame(edges, "node string, member string")).collect()}
    assert got == {x: find(x) for x in list(top)}


def test_splits_keep_groups_and_proportions(spark):
    rng = random.Random(3)
    a = art(spark, [(f"d{i:04d}", [f"au {i // 3}"], None, None) for i in range(900)])
    lines = spark.createDataFrame([(f"d{rng.randrange(900):04d}", rng.choice(["Key", "Notes"])) for _ in range(4000)], LINES)
    got = C.assign_splits(a, lines)
    rows = got.collect()
    assert len(rows) == 900
    by = {}
    for r in rows:
        by.setdefault(r["group_doc_id"], set()).add(r["split"])
    assert all(len(s) == 1 for s in by.values())
    share = {r["split"]: r["n"] / 4000 for r in lines.join(got, "doc_id").groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert abs(share["train"] - 0.8) < 0.03 and abs(share["test"] - 0.1) < 0.03
