import random

from sporeline.llm import mixing as M
from sporeline.llm import packing as P


def test_best_fit_keeps_the_rules():
    rng = random.Random(4)
    sizes = sorted((rng.randint(1, 90) for _ in range(600)), reverse=True)
    clusters = [rng.choice([1, 2, 3, 3, 3, i + 10]) for i in range(600)]
    sources = [rng.choice("ab") for _ in range(600)]
    bins = P.best_fit(sizes, sources, clusters, 100)
    load, seen = {}, {}
    for b, s, c in zip(bins, sizes, clusters):
        load[b] = load.get(b, 0) + s
        assert c not in seen.setdefault(b, set())
        seen[b].add(c)
    assert max(load.values()) <= 100


def test_best_fit_is_tight_without_conflicts():
    rng = random.Random(5)
    sizes = sorted((rng.randint(5, 400) for _ in range(2000)), reverse=True)
    bins = P.best_fit(sizes, ["a"] * 2000, list(range(2000)), 2048)
    assert len(set(bins)) <= sum(sizes) / 2048 * 1.01 + 1


def test_packed_frame(spark):
    rows = [(1, "a", 5000, 1), (2, "a", 100, 2), (2, "a", 100, 2), (3, None, 0, 3), (4, "b", 2048, 4), (5, "b", 48, 5), (6, "c", None, 6)]
    got = P.packed(spark.createDataFrame(rows, "doc_id long, source string, n_tokens long, cluster long")).collect()
    by = {}
    for r in got:
        by.setdefault(r["container_id"], []).append(r)
    assert all(sum(r["tok_end"] - r["tok_start"] for r in v) + v[0]["room"] == 2048 for v in by.values())
    assert sorted((r["tok_start"], r["tok_end"]) for r in got if r["doc_id"] == 1) == [(0, 2048), (2048, 4096), (4096, 5000)]
    assert not any(r["doc_id"] in (3, 6) for r in got)
    two = [r["container_id"] for r in got if r["doc_id"] == 2]
    assert len(two) == 2 and len(set(two)) == 2


def test_measured_and_empty(spark):
    docs = spark.createDataFrame([(1, "Cap dry, stipe dry.", "s", "c"), (2, "cap  DRY stipe dry", "s", "c"), (3, None, None, "c"), (4, "", "s", "c"), (5, "word " * 50000, "s", "c")], "doc_id long, text string, source string, cluster string")
    got = {r["doc_id"]: r for r in P.measured(docs).collect()}
    assert got[1]["cluster"] == got[2]["cluster"] and got[3]["n_tokens"] == got[4]["n_tokens"] == 0 and got[5]["n_tokens"] > 40000
    assert P.packed(P.measured(docs.limit(0))).count() == 0


def test_temperature():
    x, w = M.temperature_weights({"a": 900, "b": 90, "c": 10}, goal=M.entropy([0.5, 0.3, 0.2]))
    assert abs(M.entropy(list(w.values())) - M.entropy([0.5, 0.3, 0.2])) < 1e-6 and 0 < x < 1
    x, w = M.temperature_weights({"a": 900, "b": 90, "c": 10}, budget=1000, max_repeats={"a": 1, "b": 2, "c": 4})
    assert all(1000 * w[s] <= r * n + 1e-3 for s, r, n in (("a", 1, 900), ("b", 2, 90), ("c", 4, 10)))
    assert M.temperature_weights({}) == (1.0, {})


def test_capped_amounts():
    got = M.capped_amounts({"a": 100, "b": 100, "c": 10}, {"a": 0.5, "b": 0.3, "c": 0.2, "d": 0.1}, {"a": 2, "b": 1, "c": 2, "d": 3}, 150)
    assert abs(sum(got.values()) - 150) < 1e-6 and got["c"] == 20 and got["d"] == 0
    assert abs(got["a"] / got["b"] - 5 / 3) < 1e-6


def test_mixture(spark):
    rng = random.Random(7)
    items = spark.createDataFrame([(i, rng.choice(["big", "big", "small", None, "other"]), rng.randint(1, 9)) for i in range(3000)] + [(9001, "small", 0), (9002, "small", None)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 2), ("gone", 0.1, 5), (None, 0.3, 1), ("zero", None, None)], "source string, target_share double, max_repeats int")
    mix, plan = M.mixture(items, targets)
    rows = mix.collect()
    amount = {r["source"]: r["amount"] for r in plan.collect()}
    for s in ("big", "small"):
        got = sum(r["n_tokens"] for r in rows if r["source"] == s)
        assert abs(got - amount[s]) <= 9
    assert max(r["pass_no"] for r in rows) <= 2
    assert len({(r["doc_id"], r["pass_no"]) for r in rows}) == len(rows)
    assert M.mixture(items.limit(0), targets)[0].count() == 0 and M.mixture(items, targets.limit(0))[0].count() == 0
