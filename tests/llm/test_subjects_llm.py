import random

from sporeline.llm import subjects as S

TERMS = {"law": ["court rulings", "appeal decisions", "permits"], "sport": ["team scores", "relay walks", "final rounds"], "food": ["baking yeast", "cheese cultures", "shelf life"]}
FRAME = ["We discuss {} and {}.", "Until 1900 {} were compared with {}.", "A closer look at {} and {} is given."]
FILL = ["Further details are given below.", "We thank all readers."]


def doc(rng, subjects):
    out = []
    for _ in range(8):
        t = TERMS[rng.choice(subjects)]
        out.append(rng.choice(FRAME).format(rng.choice(t), rng.choice(t)))
    return " ".join([*out, rng.choice(FILL)])


def test_subjects(spark):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(160):
        s = [rng.choice(list(TERMS))]
        docs.append((i, doc(rng, s), s[0]))
        if i < 80:
            labels.append((i, s[0] if i % 20 else "law", "x"))
    docs += [(500, None, ""), (501, " \n ", ""), (502, "", ""), (3, docs[3][1], docs[3][2])]
    d = spark.createDataFrame([(i, t, "e") for i, t, _ in docs], "doc_id long, text string, subject string")
    lab = spark.createDataFrame([*labels, (7, "unknown subject", "x"), (9999, "law", "x"), (None, "law", "x")], "doc_id long, subject string, labelled_by string")
    sub = spark.createDataFrame([(s,) for s in TERMS], "subject string")
    got = S.document_subjects(d, lab, sub).collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["subject"])
    right = sum(by.get(i) == {s} for i, _, s in docs[80:160])
    assert right >= 76
    assert not {500, 501, 502} & set(by)
    assert S.document_subjects(d, lab.limit(0), sub).count() == 0
    assert S.document_subjects(d.limit(0), lab, sub).count() == 0


def test_long_text():
    m = S.Model(["a", "b"])
    assert S.Scorer(m).shares(["word sentence here. " * 30000, "", "x"]).shape == (3, 2)
