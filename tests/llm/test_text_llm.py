"""Sentences, languages, pieces."""

import random

from pyspark.sql import functions as F

from sporeline.llm import chunking as K
from sporeline.llm import languages as G
from sporeline.llm import sentences as S

EN = ["Spores smooth, cf. Fig. 3, 4.5–6.0 µm wide.", "The notes of Bod et al. state: \"Not seen. Stem dry.\" and more.", "Is this A. niger?", "Stipe dry, e.g. near the base, leg. B. Dod.", "Cap viscid when moist.", "Hyphae hyaline, up to 3 mm long."]
TEXTS = [" ".join(random.Random(i).choices(EN, k=6)) for i in range(250)] + ["子囊厚壁,宽3.2毫米。孢子光滑。标签上写着“少见。”共2份。" * 2] * 10
MODEL = S.fit(TEXTS, 3)


def cut(text):
    s = S.starts_of(text, MODEL)
    return [text[a:b].strip() for a, b in zip(s, [*s[1:], len(text)])]


def test_sentences_of_held_out_text():
    rng = random.Random(99)
    for _ in range(50):
        parts = rng.choices(EN, k=5)
        assert cut(" ".join(parts)) == parts


def test_empty_line_ends_a_sentence_and_a_break_does_not():
    assert cut("Cap dry\n\nStipe dry") == ["Cap dry", "Stipe dry"]
    assert cut("Cap\ndry; stipe: dry.") == ["Cap\ndry; stipe: dry."]


def test_wide_script_and_quotation():
    assert cut("子囊厚壁。孢子“少见。”共3份。") == ["子囊厚壁。", "孢子“少见。”共3份。"]


def test_odd_texts():
    assert S.starts_of(None, MODEL) == [] and S.starts_of("", MODEL) == [] and S.starts_of(" \n\n ", MODEL) == []
    assert S.starts_of("...", MODEL) == [0] and S.starts_of('"open quote. Never closed', MODEL)[0] == 0
    assert len(S.starts_of("Cap viscid when moist. " * 20000, MODEL)) == 20000


def test_viterbi_equals_brute_force():
    from itertools import product

    rng = random.Random(2)
    for _ in range(40):
        n = rng.randint(1, 7)
        s = [rng.uniform(-2, 2) for _ in range(n)]
        t = [[rng.uniform(-1, 1) for _ in range(2)] for _ in range(2)]
        value = lambda y: sum(a * b for a, b in zip(s, y)) + sum(t[p][q] for p, q in zip((0, *y), y))
        assert abs(value(S.viterbi(s, t)) - max(value(y) for y in product((0, 1), repeat=n))) < 1e-9


def test_sentence_frame(spark):
    df = spark.createDataFrame([(1, "Cap viscid when moist. Is this A. niger?", None, "c"), (1, "Cap viscid when moist.", None, "c"), (2, None, "  ", "c")], "row_id long, description string, materials_examined string, starts string")
    got = S.sentence_starts(df, "row_id", S.FIELDS, MODEL).collect()
    assert sorted((r["row_id"], r["field_name"], tuple(r["starts"])) for r in got) == [(1, "description", (0,)), (1, "description", (0, 23)), (2, "materials_examined", ())]
    assert S.sentence_starts(df.limit(0), "row_id", S.FIELDS, MODEL).count() == 0


def test_fit_on_nothing():
    assert S.starts_of("One. Two.", S.fit([])) != []


LANG = {
    "en": ["spores smooth and rather thick walled with a distinct pore", "cap dry when old and brown near the margin", "found near the coast under trees"],
    "de": ["sporen glatt und ziemlich dickwandig mit bräunlichem pigment", "hut trocken im alter und braun am rand", "gefunden an der küste unter bäumen"],
    "fr": ["spores lisses et à paroi épaisse avec un pore", "chapeau sec et brun vers la marge", "trouvé près de la côte sous les arbres"],
}


def labelled(seed, n=120):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        k = rng.choice(list(LANG))
        label = rng.choice(list(LANG)) if rng.random() < 0.08 else k
        out.append((" ".join(x.capitalize() + "." for x in rng.choices(LANG[k], k=4)), label))
    return out


FIELD = G.fit(labelled(1), steps=60)


def test_languages_of_mixed_text():
    text = "Spores smooth and rather thick walled with a distinct pore. Hut trocken im alter und braun am rand. Cap dry when old and brown near the margin."
    assert G._found_languages([text, "Chapeau sec et brun vers la marge.", "", "12 34", "ACGTACGTACGTACGT"], FIELD, G._Kinds())[:2] == [[0, 1], [3]]
    assert [G.LANGS[k] for k in G._found_languages(["Cap dry when old and brown near the margin."], FIELD, G._Kinds())[0]] == ["en"]


def test_forward_backward_equals_brute_force():
    from itertools import product

    import numpy as np

    f = G.Field({}, np.zeros((1, 10), np.float32), np.random.default_rng(1).normal(size=(10, 10)), np.random.default_rng(2).normal(size=(10, 10)), frozenset())
    toks = G.Tokens(["aa bb"], G._Kinds())
    s = np.random.default_rng(3).normal(size=(len(toks.words), 10)).astype(np.float32)
    got = f.posteriors(s, toks)
    want = np.zeros_like(got)
    for y in product(range(10), repeat=3):
        v = sum(s[i, k] for i, k in enumerate(y))
        for i in range(2):
            v += (f.across if toks.cut[i] else f.within)[y[i], y[i + 1]]
        for i, k in enumerate(y):
            want[i, k] += np.exp(v)
    want /= want.sum(1, keepdims=True)
    assert np.allclose(got, want, atol=1e-4)


def test_labels():
    assert [G.label_language(x) for x in ("EN", "en-GB", "en_US", "German", "deu", "??", None, " ", "pt-BR", "zh-CN", "und")] == ["en", "en", "en", "de", "de", None, None, None, "pt", "zh", None]


def test_fit_languages_on_nothing():
    f = G.fit([])
    assert G._found_languages(["abc def"], f, G._Kinds()) == [[]]


def whole(text, parts):
    return "".join(text[s:e][o:] for s, e, o in parts)


def test_pieces_lose_nothing():
    rng = random.Random(5)
    for n in (0, 1, 2000, 2001, 5000, 30000):
        text = "".join(rng.choice(["cap dry ", "stipe. ", "x" * 30, "\n\n", "、子囊", "é"]) for _ in range(n // 5 + 1))[:n]
        parts = K.pieces(text, MODEL)
        assert whole(text, parts) == text
        assert all(e - s <= K.LIMIT and o <= K.OVERLAP for s, e, o in parts)
        assert (len(parts) == 1) == (0 < n <= K.LIMIT) or n == 0
        assert all(parts[i][0] + parts[i][2] == parts[i - 1][1] for i in range(1, len(parts)))
    assert K.pieces(None) == []


def test_an_edit_alters_neighbours_only():
    rng = random.Random(6)
    text = " ".join(rng.choice(EN) + f" {rng.randint(0, 999)} is seen." for _ in range(400))
    a = {text[s + o : e] for s, e, o in K.pieces(text, MODEL)}
    changed = text[:9000] + "A new sentence here. " + text[9000:]
    b = {changed[s + o : e] for s, e, o in K.pieces(changed, MODEL)}
    assert len(b - a) <= 4


def test_no_boundaries_at_all():
    parts = K.pieces("A" * 7001, MODEL)
    assert whole("A" * 7001, parts) == "A" * 7001 and len(parts) >= 4


def test_sentence_statistics_and_models_take_all_rows(spark):
    body = ["Cap viscid when moist.", "Stem white.", "Gills free.", "Spores smooth."]
    own = {i: [*body[i % 4 :], *body[: i % 4], *(["Near zq."] if i % 3 == 0 else [])] for i in range(9000)}
    rows = [(i, " ".join(v), "菌盖光滑。菌柄白色。孢子椭圆形。" if i % 50 == 0 else None, "x") for i, v in own.items()]
    df = spark.createDataFrame(rows, "row_id long, description string, materials_examined string, extra string")
    got = S.table_statistics(*S.parsed_table(df, "row_id", S.FIELDS))
    want = S.Statistics([c for r in rows for c in r[1:3] if c])
    assert got.n["zq"] == want.n["zq"] / 1.5 == 2000 and got.starters["Cap"] == want.starters["Cap"] / 1.5 == 1500
    starts = {i: [sum(len(x) + 1 for x in v[:k]) for k in range(len(v))] for i, v in own.items()}
    found = S.found_starts(df, "row_id", S.FIELDS).filter("field_name = 'description'").groupBy("row_id").agg(F.sort_array(F.collect_list("sent_start"))).collect()
    assert {i: list(v) for i, v in found} == starts
    assert S.found_starts(df.limit(0), "row_id", S.FIELDS).count() == 0


def test_shares_of_sentence_statistics_hold_at_any_size(spark):
    # an epithet that 15 texts of 12,000 have before a capital, never at an end: seldom met, no abbreviation
    rows = [(i, "Cap viscid near R. conicus. Gills free." if i < 15 else "Cap viscid, leg. Smith near Oslo. Gills free. Stem white.", None) for i in range(12_000)]
    df = spark.createDataFrame(rows, "row_id long, description string, materials_examined string")
    st = S.table_statistics(*S.parsed_table(df, "row_id", S.FIELDS))
    assert not st.abbreviation("conicus", False) and st.abbreviation("leg", False) and not st.abbreviation("white", False)
