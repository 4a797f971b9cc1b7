import json

import numpy as np
from pyspark.sql import functions as F

from sporeline.operators import records as R
from sporeline.operators import search as V


def test_roman_and_first_line(spark):
    df = spark.createDataFrame([("clxxvii", "\n \n a title that is long\nx"), ("xiv", "t"), ("abc", None)], "r string, t string")
    got = df.select(R.roman(F.col("r")).alias("n"), R.first_line(F.col("t"), 10).alias("t")).collect()
    assert [r["n"] for r in got] == [177, 14, None] and [r["t"] for r in got] == ["a title t…", "t", None]


def test_greedy_groups(spark):
    df = spark.createDataFrame([([5, 5, 1, 20, 3],), ([],)], "x array<int>")
    assert [r["g"] for r in df.select(R.greedy_groups(F.col("x"), 10).alias("g")).collect()] == [[0, 0, 1, 2, 3], []]


def test_balanced_json():
    assert R.balanced_json('so: {"a": "}{", "b": {"c": 1}} end') == '{"a": "}{", "b": {"c": 1}}'
    assert R.balanced_json("{broken") is None and R.balanced_json(None) is None
    assert R.balanced_json('{no {"a": [1, 2]} {"b": 1}') == '{"a": [1, 2]}' and R.balanced_json("{" * 5000) is None


def test_deep_merge():
    got = json.loads(R.deep_merge(['{"a": {"b": [1, 2]}, "c": 1}', '{"a": {"b": [2, 3], "d": 4}, "c": 2}', ""]))
    assert got == {"a": {"b": [1, 2, 3], "d": 4}, "c": 1}


def test_nested_labels():
    assert R.nested_labels("[@one\n[@two#Key*]\nthree#Notes*]\nfour") == [("one", "Notes"), ("two", "Key"), ("three", "Notes"), ("four", None)]


def test_alignment_keeps_old_blocks():
    assert R.align_blocks([("a", "K"), ("b", "N"), ("c", "X")], [("a", "D"), ("x", "E"), ("c", "F")]) == [("a", "D"), ("b", "N"), ("c", "F")]
    assert R.align_blocks([], [("a", "K")]) == []


def test_three_way():
    j = "\n".join
    assert R.three_way("a\nb\nc", "a\nB\nc", "a\nb\nc\nd") == "a\nB\nc\nd"
    assert R.three_way("a", "b", "c") == j(["<<<<<<<", "b", "=======", "c", ">>>>>>>"])
    assert R.three_way("a\nb", "z\na\nb", "w\na\nb") == j(["<<<<<<<", "z", "=======", "w", ">>>>>>>", "a", "b"])
    assert R.three_way("a\nb\nc\nd", "a\nd", "a\nb\nC\nd") == j(["a", "<<<<<<<", "=======", "b", "C", ">>>>>>>", "d"])
    assert "Q" in R.three_way("a\nb\nc\nd", "a\nP\nd", "a\nb\nQ\nd") and R.three_way("a", "a", "a") == "a"


def test_three_way_loses_no_line():
    import random

    rng = random.Random(6)
    for _ in range(400):
        base = [str(rng.randrange(6)) for _ in range(rng.randrange(7))]
        sides = []
        for tag in "LR":
            own = list(base)
            for k in range(rng.randrange(4)):
                at = rng.randrange(len(own) + 1)
                own[at : at + rng.randrange(3)] = [f"{tag}{k}"] * rng.randrange(2)
            sides.append(own)
        got = R.three_way("\n".join(base), *map("\n".join, sides)).split("\n")
        assert all(x in got for own in sides for x in own if x[:1] in ("L", "R"))
        assert R.three_way("\n".join(base), "\n".join(base), "\n".join(sides[1])) == "\n".join(sides[1])


def test_best_line(spark):
    pts = [("d", x, x + 100 + (5 if x == 7 else 0)) for x in range(12)]
    got = R.best_line(spark.createDataFrame(pts, "k string, x int, y int"), ["k"], "x", "y").first()
    assert (got["slope"], got["at0"], got["n_near"], got["n_points"]) == (1.0, 100.0, 11, 12)


def test_neighbours_recall(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 64))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in V.lsh_neighbours(df, df.filter("vec_id % 30 = 0"), 64).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    n = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in got:
        order = [i for i in np.argsort(-(n[q] @ n.T)) if i != q][:5]
        hit += len(got[q] & set(order))
    assert hit / (5 * len(got)) >= 0.9


def test_merge_json_frame(spark):
    df = spark.createDataFrame([("k", 1, '{"a": [1]}'), ("k", 0, '{"a": [0]}')], "k string, o int, v string")
    assert json.loads(R.merge_json(df, "k", "o", "v").first()["merged"]) == {"a": [0, 1]}


