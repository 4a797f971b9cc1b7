import random

from pyspark.sql import functions as F

from sporeline.operators import labels as L

SCHEMA = "line_id long, doc_id string, line_number int, label string, line string"


def rows(spark, labels, doc="d"):
    return spark.createDataFrame([(i, doc, i, lab, f"t{i}") for i, lab in enumerate(labels)], SCHEMA)


def test_same_labels_merge_and_null_ends_a_run(spark):
    got = L.coalesce_blocks(L.clean_lines(rows(spark, ["Key", "key", None, "Key", "Notes"]))).orderBy("first_line").collect()
    assert [(r["label"], r["text"]) for r in got] == [("key", "t0\nt1"), ("key", "t3"), ("notes", "t4")]


def test_empty_frame(spark):
    assert L.coalesce_blocks(L.clean_lines(rows(spark, []))).count() == 0
    assert L.treatments(L.clean_lines(rows(spark, []))).count() == 0


def test_repeated_loads_count_once(spark):
    df = spark.createDataFrame([(1, "d", 0, "Key", "a"), (2, "d", 0, "Key", "a")], SCHEMA)
    assert L.clean_lines(df).count() == 1


def state_machine(kinds):
    """Treatments by hand: list of lists of positions, with whether each has a section."""
    out, cur, between, prev = [], None, 0, None
    for i, k in enumerate(kinds):
        if k == "M":
            between += 1
            continue
        if cur is None or between > L.MOST_BETWEEN or (k == "N" and prev == "S"):
            cur = []
            out.append(cur)
        cur.append((i, k))
        between, prev = 0, k
    return [t[0][0] for t in out if any(k == "S" for _, k in t)]


def test_treatments_equal_a_state_machine(spark):
    rng = random.Random(4)
    name = {"N": "Nomenclature", "S": "Description", "M": "Misc-exposition"}
    data, want, n = [], {}, 0
    for d in range(60):
        kinds = [rng.choice("NSMMM") for _ in range(25)]
        want[f"d{d}"] = state_machine(kinds)
        for i, k in enumerate(kinds):
            data.append((n, f"d{d}", i, name[k], f"t{i}"))
            n += 1
    got = L.treatments(L.clean_lines(spark.createDataFrame(data, SCHEMA))).select("doc_id", "first_line").collect()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r["first_line"])
    assert {k: sorted(v) for k, v in by.items()} == {k: v for k, v in want.items() if v}


def test_stub_name(spark):
    got = L.treatments(L.clean_lines(rows(spark, ["Description"]))).first()
    assert got["treatment"] == L.STUB and got["description"] == "t0"


def test_yedda_round_trip(spark):
    blocks = spark.createDataFrame([("d", 0, "Key", "a\nb"), ("d", 5, "Notes", "c")], "doc_id string, first_line int, label string, text string")
    got = L.from_yedda(L.to_yedda(blocks)).orderBy("block_no", "line_in_block").collect()
    assert [(r["label"], r["line"]) for r in got] == [("Key", "a"), ("Key", "b"), ("Notes", "c")]


def test_yedda_with_blanks_and_last_empty_line(spark):
    t = spark.createDataFrame([("d", "[@ one\n\ntwo #Key*][@x\n#Notes*]")], "doc_id string, value string")
    got = [(r["label"], r["line"]) for r in L.from_yedda(t).orderBy("block_no", "line_in_block").collect()]
    assert got == [("Key", "one"), ("Key", "two"), ("Notes", "x")]


def test_metrics(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "a")], "gold string, pred string")
    got = {r["label"]: r for r in L.per_class(pairs).collect()}
    assert got["a"]["precision"] == 0.5 and got["a"]["recall"] == 0.5 and got["c"]["f1"] == 0.0
    assert got["b"]["recall"] == 1.0


def test_frequencies(spark):
    got = {r["label"]: r["percentage"] for r in L.label_frequencies(rows(spark, ["a", "a", "a", "b", None])).collect()}
    assert got == {"a": 75.0, "b": 25.0}


def test_canonical_label(spark):
    df = spark.createDataFrame([(" Materials examined ",), ("?",), (None,)], "x string").select(L.canonical_label(F.col("x")).alias("y"))
    assert [r["y"] for r in df.collect()] == ["materials-examined", None, None]
