from sporeline.sources import text as T


def test_lines_pages_offsets(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\n\ftwo\n--- PDF Page 3 Label iii ---\n")
    got = T.text_lines(spark, str(tmp_path / "a.txt")).orderBy("line_number").collect()
    assert [(r["line"], r["page"], r["line_start"], r["is_page_marker"]) for r in got] == [("one", 1, 0, False), ("two", 2, 4, False), ("--- PDF Page 3 Label iii ---", 2, 9, True), ("", 2, 38, False)]


def test_annotated_file(spark, tmp_path):
    (tmp_path / "x.ann").write_text("[@A b\nc#Key*]\n")
    assert [(r["label"], r["line"]) for r in T.annotated_files(spark, str(tmp_path)).orderBy("line_in_block").collect()] == [("Key", "A b"), ("Key", "c")]


def test_ontology(spark, tmp_path):
    (tmp_path / "o.obo").write_text('format-version: 1.2\n\n[Term]\nid: X:1\nname: cap\nis_a: X:0 ! part\nsynonym: "pileus" EXACT []\n\n[Term]\nid: X:0\nname: part\n')
    got = {r["id"]: r for r in T.ontology(spark, str(tmp_path / "o.obo")).collect()}
    assert got["X:1"]["parents"] == ["X:0"] and got["X:1"]["synonyms"] == ["pileus"] and got["X:0"]["name"] == "part"


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "<table><tr><td>a</td><td><b>b</b></td></tr></table><ul><li>c</li></ul>")], "id int, html string")
    assert [r["cells"] for r in T.html_rows(df, "id", "html").orderBy("row_no").collect()] == [["a", "b"], ["c"]]


def test_xml_blocks(spark):
    x = "<article><sec sec-type='description'><p>One <i>two</i>.</p></sec><sec><p> </p><p>Three</p></sec></article>"
    df = spark.createDataFrame([("d", x), ("bad", "<a"), ("null", None)], "doc_id string, xml string")
    got = T.xml_blocks(df, "doc_id", "xml", {"description": "Description"}).orderBy("block_no").collect()
    assert [(r["tag"], r["text"]) for r in got] == [("Description", "One two."), ("Misc-exposition", "Three")]


def test_csv_and_edges(spark, tmp_path):
    df = spark.createDataFrame([("/a/", 1), ("/a/b/", 2)], "path string, extra int")
    T.write_csv(df, str(tmp_path / "c"), ["path"])
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["path"]
    T.write_edges(df, str(tmp_path / "e"))
    assert sorted((r["parent"] or "", r["child"]) for r in spark.read.parquet(str(tmp_path / "e")).collect()) == [("", "a"), ("a", "b")]
