import random

from sporeline.llm import scans as C

RULES = [("c", "e"), ("l", "i"), ("0", "o"), ("ii", "n"), ("1", "l"), ("cl", "d"), ("ii", "u"), ("li", "h"), ("f", "t"), ("rn", "m")]
BODY = ["Spores smooth and hyaline in water, wide and amyloid.", "Basidia hyaline and smooth, rather wide.", "Hyphae amyloid, branched near the margin.", "The margin remained smooth and hyaline."]
SECTIONS = "section_id long, doc_id string, value string, paragraph_number int, pdf_page int, empirical_page_number int, section_name string, loaded string"


def sections():
    rows, n = [], 0
    for d in range(12):
        p = 0
        for page in range(1, 9):
            for v in [f"{100 + page}  Fungi Noti {d + 3}", BODY[(d + page) % 4], BODY[(d + page + 1) % 4] + " " + BODY[page % 4]]:
                rows.append((n, f"d{d}", v, p, page, 100 + page, None, "x"))
                n += 1
                p += 1
    add = lambda v, page, printed=None, p=None: rows.append((len(rows), "d0", v, 900 + len(rows) if p is None else p, page, printed, None, "x"))
    at = len(rows)
    add("Spores smooth and hya-\nline in water.", 9, 109)
    add("Spores smoofh and hyaliiie in water, l2.5 wide.", 9, 109)
    add("109", 9, 109)
    add("Basidia hyaline and", 9, 109)
    add("110  Fungi Noti 3", 10, 110)
    add("smooth, rather wide.", 10, 110)
    add(None, 10)
    add("  ", 10)
    rows.append((len(rows), None, "Spores smoofh.", None, None, None, None, None))
    return rows, at


def test_scan_cases(spark):
    rows, at = sections()
    got = {tuple(r) for r in C.scan_cases(spark.createDataFrame(rows, SECTIONS)).collect()}
    assert {(at, "hyphen", "hyaline"), (at + 1, "ocr", "smooth"), (at + 1, "ocr", "hyaline"), (at + 1, "ocr", "12.5"), (at + 2, "page_number", ""), (at + 3, "continues", ""), (at + 4, "running_header", "")} <= got
    assert not any(k == "continues" and i < at for i, k, _ in got)
    assert sum(k == "running_header" for _, k, _ in got) >= 12 * 8
    assert (at + 8, "ocr", "smooth") in got


def test_scan_empty(spark):
    assert C.scan_cases(spark.createDataFrame([], SECTIONS)).count() == 0


def facts_of(spark, rows):
    source = spark.createDataFrame(rows, SECTIONS).filter("value is not null")
    seen = source.drop("loaded", "section_name").mapInArrow(C._evidence(C.Folding(RULES)), C._SEEN)
    return C.facts(source, seen).collect()


def test_numbers_and_folds():
    f = C.Folding(RULES)
    assert C.line_number("– 231 –") == 231 and C.line_number("p. 12") == 12 and C.line_number("clxxvii") == 177 and C.line_number("1 7 7") == 177 and C.line_number("Table 7") is None
    assert f.fold("hyaliiie") == f.fold("hyaline") and f.fold("amy1oid") == f.fold("amyloid") and f.fold("branclied") == f.fold("branched")
    assert C.header_key("231  SPORE & HYPHA 9", f) == C.header_key("Sp0re & Hypha 9", f) == C.header_key("Spore & Hypha 9: 17", f)
    assert C.Folding([]).fold("Abc") == "abc"


def test_fold_as_a_column(spark):
    from pyspark.sql import functions as F

    f = C.Folding(RULES)
    words = ["hyaliiie", "Sclerotia", "modem", "uuhd", "É|x", ""]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(f.column(F.col("w"))).collect()
    assert [r[0] for r in got] == [f.fold(w) for w in words]


def test_misreadings_are_learned_from_the_corpus():
    rng = random.Random(3)
    common = {"".join(rng.choice("abdeghiklmnoprstu") for _ in range(9)): 900 for _ in range(300)}
    rare = {}
    for w in list(common)[:120]:
        for r, p in (("c", "e"), ("ii", "n"), ("0", "o")):
            if p in w:
                rare[w.replace(p, r, 1)] = 1
        rare[w[:-1] + "a"] = 2  # another ending is no misreading
    rules, pairs = C.learn_misreadings(common, common | rare)
    assert set(rules) == {("c", "e"), ("ii", "n"), ("0", "o")} and len(pairs) > 50


def test_no_header_of_an_article_is_dropped(spark):
    names = [f"{a}{b} Notes" for a in ("Ad", "Be", "Go", "Ka", "Po") for b in ("ra", "vo", "zy", "pe")]
    rows = [(p * 100 + k, "d0", n, p * 100 + k, p, 100 + p, None, "x") for p in range(1, 5) for k, n in enumerate(names)]
    rows.append((9000, "d0", names[0], 9000, None, None, None, "x"))
    long = "Spore " * 40
    rows += [(9001 + p, "d0", long, 9001 + p, p, None, None, "x") for p in (1, 2)]
    got = {r["section_id"]: C._pages(r["pages"]) for r in facts_of(spark, rows)}
    assert all(got[p * 100 + k] == {0: 4} for p in range(1, 5) for k, n in enumerate(names))
    assert got[9000] == {0: 4} and got[9002] == got[9003] == {0: 2}  # long lines count too


def test_headers_that_run_or_stop_like_prose(spark):
    rows, _ = sections()
    n, want = 10_000, set()
    for doc, head in (("e0", "Nova Hedwigia, 1987"), ("e1", "Smith et al."), ("e2", "Mycol. Res. 45")):
        for page in range(1, 9):
            for k, v in enumerate([f"{BODY[page % 4][:-1]},\n{head}\nand dry.", BODY[(page + 1) % 4]]):
                rows.append((n, doc, v, 2 * page + k, page, 100 + page, None, "x"))
                want |= {(n, "running_header", "")} if k == 0 else set()
                n += 1
    edges = {r["section_id"]: (r["first"], r["last"]) for r in facts_of(spark, rows)}
    assert edges[10_000] == (True, False) and edges[10_001] == (False, True)
    assert edges[0] == (True, False) and edges[1] == (False, False) and edges[len(sections()[0]) - 1] == (False, False)
    got = {tuple(r) for r in C.scan_cases(spark.createDataFrame(rows, SECTIONS)).collect()}
    assert want <= got
    assert {r for r in got if r[1] == "running_header" and r[0] >= 10_000} == want


def editor(words, breaks=()):
    e = C.Editor([*RULES, ("m", "rn"), ("d", "cl")])
    e.train(sorted(words), [], list(breaks))
    return e


def test_editor_takes_what_the_corpus_bears_out():
    words = "modern stern horn corner clavate cleft inclined close hyaline margin smooth spores wide brown dome hymenium drum mode and".split()
    e = editor(words)
    pairs = {"modem": "modern", "comer": "corner", "davate": "clavate", "smoofh": "smooth", "hyaliiie": "hyaline"}
    assert {r: e.repair(r, [p]) for r, p in pairs.items()} == pairs
    assert e.repair("Smoofh", ["smooth"]) == "Smooth" and e.number("l2.5") == "12.5" and e.number("sl") is None
    long = "smoofh" * 12
    assert e.repair(long, ["smooth" * 12]) == "smooth" * 12  # long words and many edits


def test_lines_passed_over_are_text():
    rng = random.Random(5)
    shapes = [C.line_shape(s) for s in ("Mycol. Res. 45", "Smith et al.", "spores smooth and hyaline in water, wide", "Notes — Fungi", "12", "(dry)")]
    net = C.Perceptron(["text", "header", "number"])
    net.fit([(C.line_features(rng.choice(shapes), rng.choice([0, 2, 3]), "-", rng.random() < 0.5, False, rng.random() < 0.5, False), rng.randrange(3)) for _ in range(300)])
    r = C.Reader(net, C.Folding([]))
    loud = C.Reader(net, C.Folding([]))
    loud.quiet = frozenset()
    for s in ("Mycol. Res.", "spores smooth and hyaline in water, wide", "Smith et al.", "(dry)", "NOTES", "a b c", "mix"):
        for alone in (True, False):
            assert r.line_class(s, 0, 1.0, 0.0, False, False, alone, None) == loud.line_class(s, 0, 1.0, 0.0, False, False, alone, None)


def test_joins_are_predicted():
    known = lambda a, b, w, o, y: (C.Break((a, "-", b, (w, o, 0, 0, False, False))), y)
    rng = random.Random(2)
    words = ["".join(rng.choice("aeiourstlm") for _ in range(8)) for _ in range(120)]
    breaks = [known(w[:4], w[4:], 50, 0, True) for w in words]
    breaks += [(C.Break((a, "-", b, (0, 30, 60, 60, False, False))), False) for a, b in zip(words[:60], words[60:])]
    e = editor(words, breaks)
    assert e.joins(C.Break(("hya", "-", "line", (9, 0, 0, 0, False, False))))
    assert not e.joins(C.Break(("olive", "-", "grey", (0, 9, 80, 80, False, False))))
    assert not e.joins(C.Break(("olive", "-", "green", (0, 0, 80, 80, False, False))))  # unseen, but of two known words


def test_clean_lines_and_joined_text():
    got = C.clean_lines("(smoofh and hya-\nline, olive-\ngrey", {"smoofh": "smooth"}, {("hya", "-", "line"): "hyaline", ("olive", "-", "grey"): None})
    assert got == "(smooth and hyaline, olive-grey"
    one = {"text": "smooth and hya-", "left": "hya", "printed": "hyaline"}
    assert C.joined_text([one, {"text": "line. End", "left": None, "printed": None}, {"text": "here", "left": None, "printed": None}]) == "smooth and hyaline. End here"
    assert C.joined_text([{"text": "an olive-", "left": "olive", "printed": None}, {"text": "grey,", "left": None, "printed": None}]) == "an olive-grey,"


def test_paragraphs_lose_nothing(spark):
    rows, at = sections()
    got = {(r["doc_id"], r["paragraph_no"]): r["text"] for r in C.paragraphs(spark.createDataFrame(rows, SECTIONS)).collect()}
    p0 = {r[0]: r[3] for r in rows}
    assert got["d0", p0[at]] == "Spores smooth and hyaline in water."
    assert got["d0", p0[at + 1]] == "Spores smooth and hyaline in water, 12.5 wide."
    assert got["d0", p0[at + 3]] == "Basidia hyaline and smooth, rather wide."
    body = {(r[1], r[3]): " ".join(r[2].split()) for r in rows if r[1] and r[2] and r[2].strip() and r[0] < at and "Fungi Noti" not in r[2]}
    assert all(got[k] == v for k, v in body.items())
    assert not any("Fungi Noti" in t for t in got.values())
    assert C.paragraphs(spark.createDataFrame([], SECTIONS)).count() == 0


def test_paragraphs_over_block_borders(spark):
    rows, _ = sections()
    n = 20_000
    chain = [f"{w} smooth and hyaline" for w in ["Spores", *["wide"] * 600]] + ["and wide."]
    rows += [(n + k, "long", v, k, None, None, None, "x") for k, v in enumerate(chain)]
    got = [r for r in C.paragraphs(spark.createDataFrame(rows, SECTIONS)).filter("doc_id = 'long'").collect()]
    assert [(r["paragraph_no"], r["n_rows"]) for r in got] == [(0, len(chain))]


def test_misreadings_come_from_all_words(spark):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abdeghiklmnoprstu") for _ in range(n))
    words = {word(10): 5000 for _ in range(4500)}  # commoner than any that is misread
    printed = sorted({word(9) for _ in range(300)} | {word(5) for _ in range(200)})
    words |= {w: 700 for w in printed} | {"µm": 4000, "pm": 30, "um": 20, "nm": 9, "olive-grey": 900, "x" * 3000: 1}
    for w in printed:
        for r, p in (("z", "e"), ("ii", "n"), ("m", "rn"), ("rn", "m")):
            if p in w:
                words.setdefault(w.replace(p, r, 1), 1 + len(w) % 7)
    rules, pairs = C.learned(spark.createDataFrame(list(words.items()), "word string, n long"))
    common = {w: n for w, n in words.items() if n >= 50 and "-" not in w}
    want, shown = C.learn_misreadings(common, words)
    assert rules == want and {("z", "e"), ("ii", "n"), ("m", "rn")} <= set(rules)
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) > 400 and set(got) == set(shown)


def test_tagger_learns_from_all_lines(spark):
    shapes = {s: C.line_shape(s) for s in ("Mycol. Res.", "Smith et al.", "spores smooth and hyaline in water, wide", "Notes — Fungi", "12", "(dry)")}
    places = [(shape, pages, gap, first, False, first, not first) for shape in shapes.values() for pages in (0, 2, 3) for gap in C._GAPS for first in (True, False)]
    assert [C.place_of(C.place_code(*p)) for p in places] == places
    text, head = (C.place_code(shapes[s], 3, "-", False, False, False, False) for s in ("spores smooth and hyaline in water, wide", "Smith et al."))
    rows = [([4 * text] * 5,) for _ in range(30_000)] + [([4 * head + 1],)] * 100
    net = C.fit_furniture(spark.createDataFrame(rows, "places array<int>"))
    reader = C.Reader(net, C.Folding([]))
    assert reader.place_class(head) == 1 and reader.place_class(text) == 0


def test_editor_learns_from_all_examples(spark):
    words = spark.createDataFrame([(f"{a}{b}{c}", 90) for a in ("hya", "spo", "cla", "mar") for b in ("li", "re", "va") for c in ("ne", "te", "nus")], "word string, n long")
    none = spark.createDataFrame([], "word string, mates array<string>")
    breaks = [("spore", "-", f"w{k}x", 9, 0, 5, 5) for k in range(4000)] + [("olive", "=", f"g{k}y", 0, 9, 80, 80) for k in range(9000)]
    counted = spark.createDataFrame(breaks, "left string, mark string, right string, whole long, own long, last long, first long")
    pairs = spark.createDataFrame([("smoofh", "smooth")], "word string, whole string")
    e = C.train_editor(words, none, counted, RULES, pairs)  # two blocks
    assert e.joins(C.Break(("hya", "-", "line", (9, 0, 0, 0, False, False)))) and not e.joins(C.Break(("olive", "-", "grey", (0, 9, 80, 80, False, False))))
    assert e.repair("smoofh", ["smooth"]) == "smooth" and e.number("l2.5") == "12.5"
