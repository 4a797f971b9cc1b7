"""Queries over look-ups, evaluation, trees, JSON, sampling, sinks and learning, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from sporeline.operators import labels as L
from sporeline.operators import records as R
from sporeline.plans.lines import _CLEAN, _PRED, _RUNS, _lines
from sporeline.plans.storage import scratch_root
from sporeline.sources.tables import table
from sporeline.sources import text as X

_t = table


def _folder(spark, tag):
    return f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"


def alias_map(spark, d):
    """Spellings of journals through a slug to the commonest spelling of it."""
    t = _t(spark, d, "treatments").select(F.col("ingest")["journal"].alias("name")).unionByName(_t(spark, d, "articles").select(F.col("journal").alias("name"))).filter("name is not null")
    n = t.groupBy("name").agg(F.count("*").alias("n")).withColumn("slug", F.btrim(F.regexp_replace(F.lower(F.regexp_replace("name", "&", "and")), "[^a-z]+", "-"), F.lit("-")))
    best = n.groupBy("slug").agg(F.max_by("name", F.struct("n", "name")).alias("canonical"))
    return n.join(best, "slug").select("name", "slug", "canonical", "n")


def url_lookup(spark, d):
    """Articles found by the first two path segments of an address."""
    t = _t(spark, d, "treatments").select("row_id", F.regexp_extract(F.col("ingest")["url"], r"^https?://[^/]+/([^/]+/[^/]+)", 1).alias("k")).filter("k <> ''")
    a = _t(spark, d, "articles").select("doc_id", F.concat(F.lit("a/"), F.left("doc_id", F.lit(10))).alias("k"))
    return t.join(a, "k").select("row_id", "doc_id")


def result_lookup(spark, d):
    """Stored results of articles beside each treatment, an empty object where there is none."""
    r = _t(spark, d, "yedda_lines").filter("doc_id is not null").groupBy("doc_id").agg(F.to_json(F.struct(F.count("*").alias("lines"))).alias("result"))
    return _t(spark, d, "treatments").select("row_id", F.col("ingest")["_id"].alias("doc_id")).join(r, "doc_id", "left").select("row_id", F.coalesce("result", F.lit("{}")).alias("result"))


def candidate_probing(spark, d):
    """The file to take for an article, from candidates of several tables in order of preference, each once."""
    c = lambda t, e, k: _t(spark, d, t).select(e.alias("doc_id"), F.col("attachment_name").alias("name"), F.lit(k).alias("k")).filter("doc_id is not null and name is not null")
    both = c("sections", F.col("doc_id"), 0).union(c("treatments", F.col("ingest")["_id"], 1)).distinct()
    return both.groupBy("doc_id").agg(F.min_by("name", F.struct("k", "name")).alias("name"), F.count_distinct("name").alias("n_candidates"))


def linked_by_issue(spark, d):
    """Articles of one issue numbered in order, each linked to the next one."""
    a = _t(spark, d, "articles").filter("source_key is not null").select("doc_id", F.lower(F.trim("source_key")).alias("issue"))
    n = a.withColumn("ordinal", F.row_number().over(Window.partitionBy("issue").orderBy("doc_id")))
    nxt = n.select("issue", (F.col("ordinal") - 1).alias("ordinal"), F.col("doc_id").alias("next_id"))
    return n.join(nxt, ["issue", "ordinal"])


def members_only(spark, d):
    """Treatments of the articles in a collection: those of curated names."""
    c = _t(spark, d, "taxon").filter("entered_by like 'curator%'").select("doc_id")
    return _t(spark, d, "treatments").select("row_id", F.col("ingest")["_id"].alias("doc_id")).join(c, "doc_id", "left_semi")


def bio_tags(spark, d):
    """Tokens of lines with B, I or O by the bracketed span that covers them."""
    y = _t(spark, d, "yedda_lines").filter("line is not null").select("line_id", F.posexplode(F.split(F.regexp_replace("line", r"\(([^()]*)\)", "(\x01$1)"), " ")).alias("k", "w"))
    w = Window.partitionBy("line_id").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    depth = F.sum(F.regexp_count("w", F.lit(r"\("))).over(w) - F.coalesce(F.sum(F.regexp_count("w", F.lit(r"\)"))).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tag = F.when(F.contains("w", F.lit("\x01")), "B").when(depth > 0, "I").otherwise("O")
    return y.select("line_id", "k", tag.alias("tag")).groupBy("line_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "tag"))), lambda x: x["tag"]), "").alias("tags"))  # tokens of one line


def token_overlap(spark, d):
    """Overlap of the characters of blocks with those of the rule labels, position by position, per label."""
    x = _lines(spark, d).filter("label is not null").select("label", L.prediction(F.col("line")).alias("pred"), F.size(F.split(F.trim(F.coalesce("line", F.lit(""))), r"\s+")).alias("n"))
    same = F.col("label") == F.col("pred")
    roles = x.select(F.explode(F.when(same, F.array(F.struct("label", F.col("n").alias("both"), F.col("n").alias("either")))).otherwise(F.array(F.struct("label", F.lit(0).alias("both"), F.col("n").alias("either")), F.struct(F.col("pred").alias("label"), F.lit(0).alias("both"), F.col("n").alias("either"))))).alias("r")).select("r.*")
    return roles.groupBy("label").agg(F.sum("both").alias("both"), F.sum("either").alias("either"), F.round(F.sum("both") / F.sum("either"), 6).alias("iou"))


def evaluation_report(spark, d):
    """Agreement of labels and rule labels per article, and over all."""
    x = _lines(spark, d).filter("label is not null").select("doc_id", (F.col("label") == L.prediction(F.col("line"))).cast("int").alias("hit"))
    per = x.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"))
    whole = per.agg(F.lit("(all)").alias("doc_id"), F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return per.unionByName(whole).select("doc_id", "n", "hits", F.round(F.col("hits") / F.col("n"), 6).alias("accuracy"))


def grouped_counts(spark, d):
    """Children of each parent and comments of each collection, in one pass over both groupings."""
    t = _t(spark, d, "taxon").select(F.coalesce("doc_id", F.lit("?")).alias("doc_id"), F.coalesce(F.regexp_extract("entered_by", "^([a-z]+)", 1), F.lit("?")).alias("kind"))
    return t.groupingSets([["doc_id"], ["kind"]], "doc_id", "kind").agg(F.count("*").alias("n"))


def cost_estimate(spark, d):
    """Tokens (four characters each) and price of sending the texts of each kind."""
    n = F.ceil(F.char_length("text") / 4)
    return _t(spark, d, "documents").groupBy("doc_type").agg(F.count("*").alias("n_docs"), F.sum(n).alias("tokens"), F.round(F.sum(n) * 0.000003, 6).alias("price"))


def header_growth(spark, d):
    """Regions around page lines: up to five short neighbours each way."""
    s = _t(spark, d, "sections").filter("doc_id is not null and paragraph_number is not null and value is not null").groupBy("doc_id", "paragraph_number").agg(F.min_by("value", "section_id").alias("v"))
    w = Window.partitionBy("doc_id").orderBy("paragraph_number")
    near = lambda lo, hi: F.collect_list(F.char_length("v") < 45).over(w.rowsBetween(lo, hi))
    run = lambda a: F.aggregate(a, F.struct(F.lit(0).alias("n"), F.lit(True).alias("on")), lambda s, x: F.struct((s["n"] + F.when(s["on"] & x, 1).otherwise(0)).alias("n"), (s["on"] & x).alias("on")))["n"]
    r = s.select("doc_id", "paragraph_number", "v", run(F.reverse(near(-5, -1))).alias("up"), run(near(1, 5)).alias("down"))
    return r.filter(F.col("v").rlike("^[0-9]+$")).select("doc_id", "paragraph_number", "up", "down")


def region_lines(spark, d):
    """Paragraphs of all regions around headings as one set, each with the surest of its regions."""
    s = _t(spark, d, "sections").filter("doc_id is not null and paragraph_number is not null and section_name is not null and lower(value) = lower(section_name)")
    one = s.select("doc_id", F.explode(F.sequence(F.greatest(F.col("paragraph_number") - 1, F.lit(0)), F.col("paragraph_number") + 1)).alias("paragraph_number"), F.col("paragraph_number").alias("at"))
    return one.groupBy("doc_id", "paragraph_number").agg(F.max(F.when(F.col("at") == F.col("paragraph_number"), 1.0).otherwise(0.5)).alias("confidence"))


def stratified_order(spark, d):
    """Articles by variety of labels, then blocks, then id: the place of each."""
    n = _lines(spark, d).groupBy("doc_id").agg(F.count_distinct("label").alias("tags"), F.count("*").alias("lines"))
    return n.orderBy(F.desc("tags"), F.desc("lines"), "doc_id").limit(40)


def review_queue(spark, d):
    """Treatments to be looked at: those without diagnosis first, then the longest, then by id."""
    t = _t(spark, d, "treatments").select("row_id", F.col("diagnosis").isNull().alias("open"), F.char_length(F.coalesce("description", F.lit(""))).alias("n"))
    return t.orderBy(F.desc("open"), F.desc("n"), "row_id").limit(60)


def natural_order(spark, d):
    """Labels of pages ordered with their digit runs as numbers: the largest of each article."""
    s = _t(spark, d, "sections").filter("doc_id is not null and pdf_label is not null").select("doc_id", "pdf_label").distinct()
    parts = F.transform(F.regexp_extract_all("pdf_label", F.lit(r"(\d+|\D+)"), F.lit(1)), lambda p: F.when(p.rlike(r"^\d"), F.lpad(p, 12, "0")).otherwise(p))
    return s.groupBy("doc_id").agg(F.max_by("pdf_label", F.struct(F.array_join(parts, ""), "pdf_label")).alias("latest"))


def combined_training(spark, d):
    """Two training sets put together: ids that are in both are told, those already in the target skipped."""
    y = _t(spark, d, "yedda_lines").filter("doc_id is not null")
    a, b = y.filter("line_id % 3 <> 0").select("doc_id").distinct(), y.filter("line_id % 5 = 0").select("doc_id").distinct()
    return a.withColumn("k", F.lit(1)).union(b.withColumn("k", F.lit(2))).groupBy("doc_id").agg(F.min("k").alias("source"), (F.count("*") > 1).alias("clash"))


def permutation_split(spark, d):
    """Rows in the order of a hash of their id: seven tenths of each kind to train on."""
    docs = _t(spark, d, "documents").select("doc_id", "doc_type", F.md5(F.col("doc_id").cast("string")).alias("h"))
    return docs.groupBy("doc_type").agg(F.count_if(F.conv(F.left("h", F.lit(6)), 16, 10).cast("long") < F.lit(int(0.7 * 16**6))).alias("n_train"), F.count("*").alias("n"))


def flat_json(spark, d):
    """Key=value tokens of metadata, keys joined by underscores, blanks replaced."""
    y = _t(spark, d, "yedda_lines").filter("metadata is not null").select(F.explode(F.from_json("metadata", "map<string,string>")).alias("k", "v"))
    return y.select(F.concat_ws("=", F.regexp_replace("k", " ", "_"), F.regexp_replace(F.coalesce("v", F.lit("null")), " ", "_")).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def json_strings(spark, d):
    """All strings of JSON objects, keys as well, distinct."""
    y = _t(spark, d, "yedda_lines").filter("metadata is not null").select(F.from_json("metadata", "map<string,string>").alias("m"))
    return y.select(F.explode(F.concat(F.map_keys("m"), F.map_values("m"))).alias("s")).filter("s is not null").distinct()


def json_subtree(spark, d):
    """A sub-tree of nested JSON written from treatments, to a depth of two."""
    j = F.to_json(F.struct(F.struct(F.col("pdf_page").alias("page"), F.struct(F.col("line_number").alias("line")).alias("at")).alias("place"), F.col("_id").alias("id")))
    return _t(spark, d, "treatments").select("row_id", j.alias("j")).select("row_id", F.get_json_object("j", "$.place.page").alias("page"), F.get_json_object("j", "$.place.at.line").alias("line"), F.size(F.from_json(F.get_json_object("j", "$.place"), "map<string,string>")).alias("n_children"))


def span_envelope(spark, d):
    """Spans in a versioned envelope of JSON, and back."""
    env = F.to_json(F.struct(F.lit(1).alias("version"), F.col("description_spans").alias("spans")))
    back = F.from_json("e", "struct<version: int, spans: array<map<string,string>>>")
    return _t(spark, d, "treatments").filter("description_spans is not null").select("row_id", env.alias("e")).select("row_id", back["version"].alias("version"), F.size(back["spans"]).alias("n"), F.get(back["spans"], 0)["end_char"].try_cast("int").alias("first_end"))


def insert_if_absent(spark, d):
    """Journals and titles of a first load kept, new ones added by id."""
    a = _t(spark, d, "articles").filter("doc_id < 'a'").select("doc_id", F.coalesce("title", F.lit("")).alias("title"), F.lit(1).alias("revision"))
    b = _t(spark, d, "articles").filter("doc_id > '5'").select("doc_id", F.upper(F.coalesce("title", F.lit(""))).alias("title"), F.lit(2).alias("revision"))
    return a.unionByName(b.join(a, "doc_id", "left_anti"))


def marker_audit(spark, d):
    """Neighbouring page lines of an article with nothing but blanks between."""
    s = _t(spark, d, "sections").filter("doc_id is not null and paragraph_number is not null and trim(coalesce(value, '')) <> ''").select("doc_id", "paragraph_number", "section_id", F.col("value").rlike("^[0-9]+$").alias("m"))
    p = F.lag("m").over(Window.partitionBy("doc_id").orderBy("paragraph_number", "section_id"))
    return s.withColumn("both", F.col("m") & p).groupBy("doc_id").agg(F.count_if("m").alias("n_markers"), F.count_if("both").alias("n_adjacent"))


def failure_lookup(spark, d):
    """Errors of users, the last one of each with its value, and how many there were."""
    e = _t(spark, d, "events").filter("event_type = 'error'")
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("last_id"), F.max_by("value", "event_id").alias("last_value"))


def sorted_listing(spark, d):
    """A registry by code: one found, the rest listed in order."""
    n = _t(spark, d, "nation").select(F.upper(F.left("n_name", F.lit(3))).alias("code"), "n_name", "n_nationkey")
    return n.withColumn("place", F.row_number().over(Window.orderBy("code", "n_nationkey"))).select("code", "n_name", "place")  # 25 rows


def merged_by_priority(spark, d):
    """Labels of an article from two annotators: the surer one's wins, their spans are put together."""
    y = _lines(spark, d).filter("label is not null")
    both = y.select("doc_id", "line_number", "label", F.lit(2).alias("p")).unionByName(y.select("doc_id", "line_number", L.prediction(F.col("line")).alias("label"), F.lit(1).alias("p")).filter("line_number % 4 = 0"))
    return both.groupBy("doc_id", "line_number").agg(F.max_by("label", "p").alias("label"), F.array_join(F.array_sort(F.collect_set("label")), "+").alias("every"))


def annotated_files_roundtrip(spark, d):
    """Annotated texts written one file an article, read back as labelled lines."""
    clean = _lines(spark, d).filter("label is not null and trim(coalesce(line, '')) <> '' and not line rlike '[#\\\\[\\\\]*]'").withColumn("line", F.btrim("line", F.lit(" \t\n\r\f")))
    path = _folder(spark, "annotated")
    X.write_annotated(L.coalesce_blocks(clean), path)
    got = X.annotated_files(spark, f"{path}/*/*.txt")
    return got.select(F.regexp_extract("doc_id", "doc_id=([^/]+)/", 1).alias("doc_id"), "block_no", "label", "line_in_block", "line")


def csv_roundtrip(spark, d):
    """Fixed columns of articles written as CSV and read back as a dictionary."""
    path = _folder(spark, "csv")
    a = _t(spark, d, "articles").select("doc_id", F.coalesce("title", F.lit("-")).alias("title"), F.coalesce("journal", F.lit("-")).alias("journal"), "authors")
    X.write_csv(a, path, ["doc_id", "title", "journal"])
    return spark.read.schema("doc_id string, title string, journal string").option("header", True).csv(path)


def json_roundtrip(spark, d):
    """Labels and probabilities of lines written as JSON and read back."""
    path = _folder(spark, "json")
    y = _lines(spark, d).filter("label is not null").select("doc_id", "line_number", F.struct(F.col("label"), F.lit(0.5).alias("p")).alias("top"))
    y.write.mode("overwrite").json(path)
    return spark.read.schema("doc_id string, line_number int, top struct<label: string, p: double>").json(path).select("doc_id", "line_number", "top.label", "top.p")


def edges_roundtrip(spark, d):
    """Edges of a tree of regions, nations and customers written as parent and child, and the fan-out read back."""
    path = _folder(spark, "edges")
    n, c = _t(spark, d, "nation"), _t(spark, d, "customer")
    tree = c.join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("/r"), "n_regionkey", F.lit("/n"), "n_nationkey", F.lit("/c"), "c_custkey", F.lit("/")).alias("path"))  # 25 nations
    X.write_edges(tree, path)
    return spark.read.schema("parent string, child string").parquet(path).groupBy("parent").agg(F.count("*").alias("n"))


def saved_with_flags(spark, d):
    """Treatments saved with a flag each: written ones true, those without id false and told why."""
    path = _folder(spark, "saved")
    t = _t(spark, d, "treatments").select("row_id", "_id", F.col("ingest")["_id"].alias("doc_id"))
    t.filter("_id is not null and doc_id is not null").write.mode("overwrite").parquet(path)
    done = spark.read.schema(t.schema).parquet(path).select("row_id", F.lit(True).alias("ok"))
    return t.join(done, "row_id", "left").select("row_id", F.coalesce("ok", F.lit(False)).alias("success"), F.when(F.col("ok").isNull(), F.when(F.col("_id").isNull(), "no id").otherwise("no article")).alias("why"))


def resumed_run(spark, d):
    """A run taken up again: what an earlier one wrote is skipped, the union is whole."""
    path = _folder(spark, "resume")
    a = _t(spark, d, "articles").select("doc_id")
    a.filter("doc_id < '8'").write.mode("overwrite").parquet(path)
    left = a.join(spark.read.schema("doc_id string").parquet(path), "doc_id", "left_anti")
    left.write.mode("append").parquet(path)
    return spark.read.schema("doc_id string").parquet(path)


def merged_versions(spark, d):
    """Labels of an article's lines as three versions of a text merged: first loaded, rule labels of odd lines, of lines divisible by four."""
    y = _lines(spark, d).filter("label is not null and line_number < 1000000").withColumn("rule", L.prediction(F.col("line")))

    def run(rows):
        base = [r[1] for r in rows]
        left = [r[2] if r[0] % 2 else r[1] for r in rows]
        right = [r[2] if r[0] % 4 == 0 else r[1] for r in rows]
        text = R.three_way("\n".join(base), "\n".join(left), "\n".join(right)).split("\n")
        return [(len(rows), len(text), sum(x == "<<<<<<<" for x in text))]

    return R.per_document(y, "doc_id", "line_number", ["line_number", "label", "rule"], run, "doc_id string, n_base int, n_merged int, n_conflicts int")


def carried_tags(spark, d):
    """Blocks of an article with the tags of the rule labels where the texts align along the longest common subsequence."""
    x = _lines(spark, d)
    old = L.coalesce_blocks(x).select("doc_id", "first_line", "text", F.col("label").alias("tag"), F.lit(0).alias("side"))
    new = L.coalesce_blocks(x.withColumn("label", L.prediction(F.col("line")))).select("doc_id", "first_line", "text", F.col("label").alias("tag"), F.lit(1).alias("side"))

    def run(rows):
        got = R.align_blocks([(r[1], r[2]) for r in rows if r[3] == 0], [(r[1], r[2]) for r in rows if r[3] == 1])
        return [(k, tag) for k, (_, tag) in enumerate(got)]

    return R.per_document(old.unionByName(new), "doc_id", "first_line", ["first_line", "text", "tag", "side"], run, "doc_id string, block_no int, tag string")


def noisy_json(spark, d):
    """JSON found in noisy text around metadata."""
    y = _t(spark, d, "yedda_lines").select("line_id", F.concat(F.lit("so {x "), F.coalesce("metadata", F.lit("")), F.lit(" } end")).alias("t"), "metadata")
    return y.select("line_id", R.json_in_text("t").alias("found"))


def nested_text_labels(spark, d):
    """Lines of nested annotation with the innermost label: each block of two lines around an inner one."""
    y = _t(spark, d, "yedda_lines").filter("line is not null and not line rlike '[#\\\\[\\\\]*@]'").select("line_id", F.trim(F.regexp_replace("line", r"\s+", " ")).alias("line"))
    text = F.concat(F.lit("[@"), "line", F.lit("\n[@in#Inner*]\nout#Outer*]"))
    found = F.pandas_udf(lambda s: s.map(lambda t: ",".join(str(b) for _, b in R.nested_labels(t))), "string")
    return y.select("line_id", found(text).alias("labels"))


def classifier_bakeoff(spark, d):
    """Learners on lines, fitted on four fifths of the articles, scored on the rest: accuracy and weighted F1 of each, and mean top probability where there is one."""
    from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.functions import vector_to_array

    from sporeline.plans.analysis import _features, _labelled

    rows = _labelled(spark, d).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(5)))
    feats = _features().fit(rows.filter("part < 4"))
    train, test = feats.transform(rows.filter("part < 4")).cache(), feats.transform(rows.filter("part = 4")).cache()
    cols = {"featuresCol": "features", "labelCol": "label_index"}
    learners = {"logistic": LogisticRegression(maxIter=10, regParam=0.01, **cols), "bayes": NaiveBayes(**cols), "forest": RandomForestClassifier(numTrees=20, maxDepth=6, seed=1, **cols), "tree": DecisionTreeClassifier(maxDepth=6, seed=1, **cols)}
    out = []
    for name, learner in learners.items():
        got = learner.fit(train).transform(test)
        score = lambda m: float(MulticlassClassificationEvaluator(labelCol="label_index", metricName=m).evaluate(got))  # noqa: E731, B023
        top = got.agg(F.avg(F.array_max(vector_to_array("probability")))).first()[0] if "probability" in got.columns else None
        out.append((name, score("accuracy"), score("f1"), top))
    train.unpersist(), test.unpersist()
    return spark.createDataFrame(out, "learner string, accuracy double, f1 double, mean_top double")


def top_probabilities(spark, d):
    """The five likeliest labels of each line with a probability above a hundredth."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array

    from sporeline.plans.analysis import _features, _labelled

    rows = _labelled(spark, d)
    feats = _features().fit(rows)
    names = F.array(*[F.lit(n) for n in feats.stages[-1].labels])
    got = LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=10, regParam=0.01).fit(feats.transform(rows)).transform(feats.transform(rows))
    pairs = F.arrays_zip(vector_to_array("probability").alias("p"), names.alias("label"))
    five = F.slice(F.sort_array(F.filter(pairs, lambda x: x["p"] > 0.01), asc=False), 1, 5)
    return got.select("doc_id", "line_number", F.posexplode(five).alias("rank", "x")).select("doc_id", "line_number", "rank", "x.label", F.round("x.p", 4).alias("p"))


QUERIES = {f.__name__: f for f in (alias_map, url_lookup, result_lookup, candidate_probing, linked_by_issue, members_only, bio_tags, token_overlap, evaluation_report, grouped_counts, cost_estimate, header_growth, region_lines, stratified_order, review_queue, natural_order, combined_training, permutation_split, flat_json, json_strings, json_subtree, span_envelope, insert_if_absent, marker_audit, failure_lookup, sorted_listing, merged_by_priority, annotated_files_roundtrip, csv_roundtrip, json_roundtrip, edges_roundtrip, saved_with_flags, resumed_run, merged_versions, carried_tags, noisy_json, nested_text_labels, classifier_bakeoff, top_probabilities)}

_KV = "(select unnest(json_keys(metadata)) as k, json_extract_string(metadata, '$.' || unnest(json_keys(metadata))) as v from yedda_lines where metadata is not null)"

SQL = {
    "alias_map": "with n as (select name, count(*) n from (select ingest['journal'] as name from treatments union all select journal from articles) where name is not null group by 1), s as (select *, trim(regexp_replace(lower(replace(name, '&', 'and')), '[^a-z]+', '-', 'g'), '-') as slug from n), b as (select slug, arg_max(name, {n: n, x: name}) as canonical from s group by 1) select name, slug, canonical, n from s join b using (slug)",
    "url_lookup": "select row_id, doc_id from (select row_id, regexp_extract(ingest['url'], '^https?://[^/]+/([^/]+/[^/]+)', 1) k from treatments) t join articles a on t.k = 'a/' || left(doc_id, 10)",
    "result_lookup": """with r as (select doc_id, '{"lines":' || count(*) || '}' as result from yedda_lines where doc_id is not null group by 1) select row_id, coalesce(result, '{}') as result from treatments left join r on r.doc_id = ingest['_id']""",
    "candidate_probing": "with c as (select doc_id, attachment_name as name, 0 k from sections union select ingest['_id'], attachment_name, 1 from treatments) select doc_id, arg_min(name, {k: k, n: name}) as name, count(distinct name) as n_candidates from c where doc_id is not null and name is not null group by 1",
    "linked_by_issue": "with n as (select doc_id, lower(trim(source_key, ' ')) as issue, row_number() over (partition by lower(trim(source_key, ' ')) order by doc_id) as ordinal from articles where source_key is not null) select a.issue, a.ordinal, a.doc_id, b.doc_id as next_id from n a join n b on a.issue = b.issue and b.ordinal = a.ordinal + 1",
    "members_only": "select row_id, ingest['_id'] as doc_id from treatments where ingest['_id'] in (select doc_id from taxon where entered_by like 'curator%' and doc_id is not null)",
    "bio_tags": r"""with y as (select line_id, string_split(regexp_replace(line, '\(([^()]*)\)', '(' || chr(1) || '\1)', 'g'), ' ') s from yedda_lines where line is not null), w as (select line_id, unnest(s) w, generate_subscripts(s, 1) k from y),
c as (select *, sum(len(regexp_extract_all(w, '\('))) over (partition by line_id order by k) - coalesce(sum(len(regexp_extract_all(w, '\)'))) over (partition by line_id order by k rows between unbounded preceding and 1 preceding), 0) depth from w)
select line_id, string_agg(case when contains(w, chr(1)) then 'B' when depth > 0 then 'I' else 'O' end, '' order by k) as tags from c group by 1""",
    "token_overlap": f"with {_CLEAN}, x as (select label, {_PRED} as pred, len(regexp_split_to_array(trim(coalesce(line, ''), ' '), '\\s+')) n from clean where label is not null), r as (select label, case when label = pred then n else 0 end as b, n as e from x union all select pred, 0, n from x where label <> pred) select label, sum(b)::bigint as both, sum(e)::bigint as either, round(sum(b) / sum(e), 6) as iou from r group by 1",
    "evaluation_report": f"with {_CLEAN}, x as (select doc_id, (label = {_PRED})::int as hit from clean where label is not null), p as (select doc_id, count(*) as n, sum(hit)::bigint as hits from x group by 1), b as (select * from p union all select '(all)', sum(n)::bigint, sum(hits)::bigint from p) select *, round(hits / n, 6) as accuracy from b",
    "grouped_counts": "with t as (select coalesce(doc_id, '?') as doc_id, coalesce(regexp_extract(entered_by, '^([a-z]+)', 1), '?') as kind from taxon) select doc_id, kind, count(*) as n from t group by grouping sets ((doc_id), (kind))",
    "cost_estimate": "select doc_type, count(*) as n_docs, sum(ceil(length(text) / 4))::bigint as tokens, round(sum(ceil(length(text) / 4)) * 0.000003, 6) as price from documents group by 1",
    "header_growth": """with s as (select doc_id, paragraph_number, arg_min(value, section_id) v from sections where doc_id is not null and paragraph_number is not null and value is not null group by 1, 2),
w as (select *, list(length(v) < 45) over (partition by doc_id order by paragraph_number rows between 5 preceding and 1 preceding) u, list(length(v) < 45) over (partition by doc_id order by paragraph_number rows between 1 following and 5 following) d from s)
select doc_id, paragraph_number, coalesce(list_position(list_reverse(u), false) - 1, len(u), 0)::int as up, coalesce(list_position(d, false) - 1, len(d), 0)::int as down from w where regexp_matches(v, '^[0-9]+$')""",
    "region_lines": "with s as (select doc_id, paragraph_number p from sections where doc_id is not null and paragraph_number is not null and lower(value) = lower(section_name)), o as (select doc_id, p, unnest(range(greatest(p - 1, 0), p + 2)) x from s) select doc_id, x::int as paragraph_number, max(case when p = x then 1.0::double else 0.5::double end) as confidence from o group by 1, 2",
    "stratified_order": f"with {_CLEAN} select doc_id, count(distinct label) as tags, count(*) as lines from clean group by 1 order by tags desc, lines desc, doc_id limit 40",
    "review_queue": "select row_id, diagnosis is null as open, length(coalesce(description, '')) as n from treatments order by open desc, n desc, row_id limit 60",
    "natural_order": r"with s as (select distinct doc_id, pdf_label from sections where doc_id is not null and pdf_label is not null), k as (select *, array_to_string(list_transform(regexp_extract_all(pdf_label, '(\d+|\D+)', 1), lambda p: case when regexp_matches(p, '^\d') then lpad(p, 12, '0') else p end), '') k from s) select doc_id, arg_max(pdf_label, {k: k, l: pdf_label}) as latest from k group by 1",
    "combined_training": "with a as (select distinct doc_id, 1 k from yedda_lines where doc_id is not null and line_id % 3 <> 0 union select distinct doc_id, 2 from yedda_lines where doc_id is not null and line_id % 5 = 0) select doc_id, min(k) as source, count(*) > 1 as clash from a group by 1",
    "permutation_split": "select doc_type, count(*) filter (('0x' || left(md5(doc_id::varchar), 6))::bigint < 11744051) as n_train, count(*) as n from documents group by 1",
    "flat_json": f"select replace(k, ' ', '_') || '=' || replace(coalesce(v, 'null'), ' ', '_') as token, count(*) as n from {_KV} group by 1",
    "json_strings": f"select k as s from {_KV} union select v from {_KV} where v is not null",
    "json_subtree": "select row_id, pdf_page::varchar as page, line_number::varchar as line, ((pdf_page is not null)::int + 1)::int as n_children from treatments",
    "span_envelope": "select row_id, 1 as version, len(description_spans)::int as n, try_cast(description_spans[1]['end_char'] as int) as first_end from treatments where description_spans is not null",
    "insert_if_absent": "select doc_id, coalesce(title, '') as title, 1 as revision from articles where doc_id < 'a' union all select doc_id, upper(coalesce(title, '')), 2 from articles where doc_id > '5' and not doc_id < 'a'",
    "marker_audit": "with s as (select doc_id, regexp_matches(value, '^[0-9]+$') m, lag(regexp_matches(value, '^[0-9]+$')) over (partition by doc_id order by paragraph_number, section_id) p from sections where doc_id is not null and paragraph_number is not null and trim(coalesce(value, ''), ' ') <> '') select doc_id, count(*) filter (m) as n_markers, count(*) filter (m and p) as n_adjacent from s group by 1",
    "failure_lookup": "select user_id, count(*) as n, max(event_id) as last_id, arg_max(value, event_id) as last_value from events where event_type = 'error' group by 1",
    "sorted_listing": "select upper(left(n_name, 3)) as code, n_name, row_number() over (order by upper(left(n_name, 3)), n_nationkey) as place from nation",
    "merged_by_priority": f"with {_CLEAN}, b as (select doc_id, line_number, label, 2 p from clean where label is not null union all select doc_id, line_number, {_PRED}, 1 from clean where label is not null and line_number % 4 = 0) select doc_id, line_number, arg_max(label, p) as label, array_to_string(list_sort(list(distinct label)), '+') as every from b group by 1, 2",
    "annotated_files_roundtrip": f"""with {_CLEAN}, keyed as (select doc_id, line_number, label, trim(line, ' ' || chr(9) || chr(10) || chr(13) || chr(12)) line, label k from clean where label is not null and trim(coalesce(line, '')) <> '' and not regexp_matches(line, '[#\\[\\]*]')), {_RUNS},
n as (select *, row_number() over (partition by doc_id order by first_line) - 1 as block_no from blocks), s as (select doc_id, block_no, label, string_split(text, chr(10)) s from n) select doc_id, block_no, label, generate_subscripts(s, 1) - 1 as line_in_block, unnest(s) as line from s""",
    "csv_roundtrip": "select doc_id, coalesce(title, '-') as title, coalesce(journal, '-') as journal from articles",
    "json_roundtrip": f"with {_CLEAN} select doc_id, line_number, label, 0.5::double as p from clean where label is not null",
    "edges_roundtrip": "select 'n' || c_nationkey as parent, count(*) as n from customer join nation on c_nationkey = n_nationkey group by 1",
    "saved_with_flags": "select row_id, _id is not null and ingest['_id'] is not null as success, case when _id is null then 'no id' when ingest['_id'] is null then 'no article' end as why from treatments",
    "resumed_run": "select doc_id from articles",
    "noisy_json": "select line_id, case when metadata is not null then metadata end as found from yedda_lines",
    "nested_text_labels": r"select line_id, 'Outer,Inner,Outer' as labels from yedda_lines where line is not null and not regexp_matches(line, '[#\[\]*@]')",
}
