import random

import numpy as np

from sporeline.llm import neardup as N
from sporeline.llm.shingles import WordIds, shingle_hashes

WORDS = [f"w{i}" for i in range(300)]


def sets(text, k):
    w = text.lower().split()
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def jaccard(a, b, k):
    a, b = sets(a, k), sets(b, k)
    return len(a & b) / len(a | b) if a | b else 0.0


def corpus(n, seed, edit):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        base = [rng.choice(WORDS) for _ in range(60)]
        out.append(" ".join(base))
        for _ in range(rng.randint(0, 3)):
            c = list(base)
            for _ in range(rng.randint(0, edit)):
                c[rng.randrange(len(c))] = rng.choice(WORDS)
            out.append(" ".join(c))
    return out


def found(spark, texts, k, t, ids=None):
    df = spark.createDataFrame([(i if ids is None else ids[i], x, "clash") for i, x in enumerate(texts)], "id long, text string, a string")
    links, members = N.near_duplicates(df, k, t)
    return {(r[0], r[1]) for r in N.all_pairs(links, members).collect()}


def test_shingles_do_not_depend_on_the_batch():
    texts = ["a b c d", "", "a b", "x a b c d", "a b c d"]
    h, b = shingle_hashes(texts, 3, WordIds())
    own = [sorted(h[b[i] : b[i + 1]].tolist()) for i in range(5)]
    assert own[0] == own[4] and own[1] == [] and len(own[2]) == 1
    one, at = shingle_hashes(["a b c d"], 3, WordIds())
    assert sorted(one.tolist()) == own[0] and set(own[0]) < set(own[3])


def test_pairs_equal_brute_force(spark):
    texts = corpus(60, 5, 4)
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if jaccard(texts[i], texts[j], 3) >= 0.5}
    got = found(spark, texts, 3, 0.5)
    assert got <= want and len(got) >= 0.97 * len(want)


def test_defaults_five_words_and_eight_tenths(spark):
    texts = corpus(40, 6, 2)
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if jaccard(texts[i], texts[j], 5) >= 0.8}
    got = found(spark, texts, 5, 0.8)
    assert got <= want and len(got) >= 0.97 * len(want)


def test_nulls_short_empty_long_and_repeated(spark):
    long = " ".join(random.Random(1).choice(WORDS) for _ in range(40000))
    texts = [None, "", "  ", "one", "one", "ONE!", long, long + " x", "two words"]
    assert found(spark, texts, 3, 0.5) == {(3, 4), (3, 5), (4, 5), (6, 7)}


def test_empty_table(spark):
    assert found(spark, [], 3, 0.5) == set()


def test_hot_buckets_in_blocks(spark):
    rng = random.Random(8)
    base = [rng.choice(WORDS) for _ in range(80)]
    texts = []
    for i in range(70):
        c = list(base)
        c[i] = f"own{i}"
        texts.append(" ".join(c))
    texts += corpus(10, 9, 0)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    signed = df.mapInPandas(N._signer(3), "id long, content binary, x array<long>, y binary").select("id", "x", "y")
    plain = {tuple(r) for r in N.candidate_pairs(signed, 0.5).collect()}
    split = {tuple(r) for r in N.candidate_pairs(signed, 0.5, hot=8, block=5).collect()}
    assert plain == split and len(plain) >= 70 * 69 // 2


def test_runs():
    order, runs = N._runs(np.array([5, 1, 5, 2, 1, 5], np.uint64))
    assert sorted(runs[:, 1].tolist()) == [2, 3] and len(order) == 6


def test_recall_follows_the_threshold():
    assert N.shape(0.8) == (8, 12, 3)
    assert all(N.shape(t).recall(t) >= 0.99 and N.shape(t).recall(t + 0.05) >= 0.99 for t in (0.4, 0.5, 0.6, 0.7, 0.8, 0.9))


def test_pairs_near_the_threshold_are_found(spark):
    rng = random.Random(12)
    texts = []
    for _ in range(150):
        base = [rng.choice(WORDS) for _ in range(80)]
        c = list(base)
        for i in range(4, 80, 11):
            c[i] = f"new{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(c)]
    want = {(i, i + 1) for i in range(0, 300, 2) if 0.5 <= jaccard(texts[i], texts[i + 1], 3) <= 0.7}
    assert len(want) >= 140
    got = found(spark, texts, 3, 0.5)
    assert len(got & want) >= 0.985 * len(want)
