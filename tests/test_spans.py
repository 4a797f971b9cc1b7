import random

from sporeline.operators import spans as S
from sporeline.operators.skew import hot_keys, salted_join


def brute(a, b):
    return sorted((x, y) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])


def test_overlap_join_equals_brute_force(spark):
    rng = random.Random(2)
    make = lambda: [(rng.choice("pq"), s, s + rng.randint(1, 40)) for s in (rng.randint(0, 300) for _ in range(60))]
    a, b = make(), make()
    left = spark.createDataFrame(a, "k string, start int, end int")
    right = spark.createDataFrame(b, "k string, other_start int, other_end int")
    got = sorted(((r["k"], r["start"], r["end"]), (r["k"], r["other_start"], r["other_end"])) for r in S.overlap_join(left, right, "k", 16).collect())
    assert got == brute(a, b)


def test_touching_spans_do_not_overlap_but_merge(spark):
    df = spark.createDataFrame([("d", 0, 5), ("d", 5, 9), ("d", 20, 30), ("d", 22, 25)], "k string, start int, end int")
    got = sorted((r["start"], r["end"], r["n_spans"]) for r in S.merged(df, ["k"]).collect())
    assert got == [(0, 9, 2), (20, 30, 2)]


def test_gaps(spark):
    df = spark.createDataFrame([("d", 0, 5), ("d", 9, 12), ("d", 10, 11)], "k string, start int, end int")
    assert [r["gap"] for r in S.gaps(df, ["k"]).orderBy("start").collect()] == [0, 4, 0] or [r["gap"] for r in S.gaps(df, ["k"]).orderBy("start").collect()][1:] == [4, 0]


def test_conflicts_keep_the_shorter(spark):
    df = spark.createDataFrame([(1, "a", 0, 10, 0.5), (1, "b", 2, 4, 0.5), (1, "c", 12, 14, 0.1)], "doc_id long, label string, start int, end int, confidence double")
    assert sorted(r["label"] for r in S.resolve_conflicts(df).collect()) == ["b", "c"]


def test_salted_join_is_the_join(spark):
    big = spark.createDataFrame([("h", i) for i in range(50)] + [("c", 99)], "k string, v int")
    small = spark.createDataFrame([("h", "x"), ("c", "y"), ("z", "w")], "k string, w string")
    hot = hot_keys(big.groupBy("k").count(), "k", "count", hot_rows=10)
    assert hot == {"h": 8}  # 50 rows in salts of 10 or fewer
    got = sorted(map(tuple, salted_join(big, small, "k", hot, big["v"]).select("k", "v", "w").collect()))
    assert got == sorted(map(tuple, big.join(small, "k").select("k", "v", "w").collect()))
