from sporeline.llm import names as N


def entities(spark, names):
    df = spark.createDataFrame([(i, n, "clash") for i, n in enumerate(names)], "id long, name string, entity string")
    out = {}
    for r in N.linked_names(df).collect():
        out.setdefault(r["entity"], set()).add(r["id"])
    return sorted(map(sorted, out.values()))


def test_forms_of_one_name():
    want = ("gadoba", "elegans", "navisk", "1901")
    for s in ("Gadoba elegans Navisk, 1901", "Gadoba elegans (Navisk) 1901", "Navisk 1901: Gadoba elegans", "elegans, Gadoba (Navisk 1901)", "Gadoba Navisk elegans 1901", "Gadoba_elegans_Navisk_1901", "Gadoba cf. elegans Navisk 1901 sp. nov.", "Gadoba elegans Nävisk 1901 [label]", 'Gadoba elegans Navisk 1901 (as "elegens")'):
        assert want in N.parse(s), s
    assert N.parse(None) == [] and N.parse("  ") == [] and N.parse("Solo") == [("solo", "", "", "")]
    assert len(N.parse("GADOBA NAVISK ELEGANS")) == 2


def test_similarity_rules():
    p = lambda s, n=50, m=20: (*N.parse(s)[0], n, m)
    same = [("Gadoba elegans Navisk", "G. elegans Navisk"), ("Gadoba ferrugineus Navisk", "Gadoba ferruginea Navisk"), ("Gadoba elegans Navi.", "Gadoba elegans Navisk 1901"), ("Gadoba elegans", "Gadoba elegans Navisk")]
    assert all(N.similarity(p(a), p(b)) >= N.LEAST_SIMILARITY for a, b in same)
    other = [("Gadoba elegans Navisk", "Gadoba elegans Tomorel"), ("Gadoba fumosus Navisk", "Gadoba famosus Navisk"), ("Gadoba elegans Navisk 1901", "Gadoba elegans Navisk 1950"), ("G. elegans", "Gadoba elegans Navisk")]
    assert all(N.similarity(p(a), p(b)) < N.LEAST_SIMILARITY for a, b in other)
    assert N.similarity(p("Gadoba fumsous Navisk", 1), p("Gadoba fumosus Navisk")) >= N.LEAST_SIMILARITY


def test_slips():
    assert N.slips("abcd", "abdc") == 1 and N.slips("abcd", "abd") == 1 and N.slips("abcd", "xyzw") == 3


def test_collision_curve_gives_the_recall():
    assert 1 - (1 - N.LOWEST**N.ROWS) ** N.BANDS >= N.RECALL > 1 - (1 - N.LOWEST**N.ROWS) ** (N.BANDS - 1)


def test_bands_find_what_the_verifier_accepts():
    import itertools
    import random

    import pandas as pd

    rng = random.Random(8)
    syl = lambda k: "".join(rng.choice("bdfglmnprstv") + rng.choice("aeiou") for _ in range(k))
    names = set()
    for _ in range(60):
        g, e, a = syl(4), syl(3) + "us", syl(3)
        for _ in range(5):
            w = [g, e, a]
            k = rng.randrange(3)
            i = rng.randrange(1, len(w[k]) - 1)
            w[k] = w[k][:i] + w[k][i + 1] + w[k][i] + w[k][i + 2 :] if rng.random() < 0.5 else w[k][:i] + rng.choice("aeiou") + w[k][i + 1 :]
            names.add((w[0] if rng.random() < 0.7 else w[0][0] + ".", w[1], w[2], ""))
    names = sorted(names)
    rows = pd.DataFrame([(i, *n[:3]) for i, n in enumerate(names)], columns=["id", "genus", "epithet", "authors"])
    by: dict = {}
    for b in N._bander(iter([rows])):
        for k, i in zip(b["key"], b["id"]):
            by.setdefault(k, set()).add(i)
    met = {p for ids in by.values() for p in itertools.combinations(sorted(ids), 2)}
    want = [(i, j) for i, j in itertools.combinations(range(len(names)), 2) if N.similarity((*names[i], 1, 1), (*names[j], 1, 1)) >= N.LEAST_SIMILARITY]
    assert len(want) > 300 and sum(p in met for p in want) >= 0.95 * len(want)


def test_genera_far_apart_are_not_alike():
    assert N.likeness("nevilepetium", "nisilisebua") == 0.0 and N.likeness("gadoba", "gadoab") > 0.8


def test_large_buckets_are_joined_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 2)
    names = [f"Gadobaria elegans Navisk {y}" for y in range(1900, 1909)] + ["Gadobaria elegans Navisk"]
    got = entities(spark, names)
    assert sum(map(len, got)) == 10 and any(9 in e and len(e) > 1 for e in got)


def test_links(spark):
    names = ["Gadobaria elegans Navisk 1901", "G. elegans Navisk", "Gadobaria elegans", "gadobaria elegns navisk", "Gadobaria elegans Tomorel", "Tomorel 1950: Gadobaria elegans", "Solo", "Solo", None, " ", "Gadobaria elegans Navisk 1901"]
    got = entities(spark, names)
    assert [6, 7] in got and [4, 5] in got
    assert [0, 1, 2, 3, 10] in got


def test_empty(spark):
    assert entities(spark, []) == [] and entities(spark, [None, ""]) == []
