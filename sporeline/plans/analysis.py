"""Queries over triage, vocabulary, search, graphs, statistics, learning and streams, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sporeline.operators import search as V
from sporeline.operators import triage as T
from sporeline.plans.lines import _lines
from sporeline.sources.tables import table

STOP = ["the", "and", "with", "for", "are", "was", "were", "from", "that", "this"]


def complexity_score(spark, d):
    return table(spark, d, "treatments").select("row_id", T.complexity(F.col("description")).alias("score"))


def triage_flags(spark, d):
    return table(spark, d, "treatments").select("row_id", T.flags(F.col("description"), F.col("treatment")).alias("flags"))


def review_priority(spark, d):
    """Flags counted over all treatments, and how many records show them."""
    f = triage_flags(spark, d).select(F.explode(F.split("flags", r"\|")).alias("flag")).filter("flag <> ''")
    return f.groupBy("flag").agg(F.count("*").alias("n"))


def term_merge_metric(spark, d):
    return T.repeated_terms(table(spark, d, "documents"), "doc_id", "text", STOP, 8)


def regex_search(spark, d):
    t = table(spark, d, "treatments").filter(F.coalesce("treatment", F.lit("")).rlike("(?i)[a-z]+ (elegans|gracilis|simplex)"))
    return t.select("row_id", "treatment").orderBy("row_id").limit(50)


def topk_cosine(spark, d):
    e = table(spark, d, "embeddings")
    return V.nearest(e, e.filter("vec_id = 0"), 10)


def threshold_normalize(spark, d):
    e = table(spark, d, "embeddings")
    return V.best_centre(e, V.centroids(e))


def degradation_summary(spark, d):
    return threshold_normalize(spark, d).groupBy("level").agg(F.count("*").alias("n"))


def lsh_neighbours(spark, d):
    """Every hundredth vector against all."""
    e = table(spark, d, "embeddings")
    return V.lsh_neighbours(e, e.filter("vec_id % 100 = 0"), 64)


def vocab_tree(spark, d):
    """Terms of names by depth: genus, then epithet; how many distinct paths there are and how many rows use the top."""
    t = table(spark, d, "taxon").select("taxon_id", F.transform(F.filter(F.split(F.regexp_replace(F.lower("taxon"), "[^a-z ]", " "), " +"), lambda w: F.length(w) >= 4), lambda w: w).alias("w")).filter("size(w) >= 2")
    paths = t.select("taxon_id", F.explode(F.transform(F.sequence(F.lit(1), F.lit(2)), lambda k: F.slice("w", F.lit(1), k))).alias("path"))
    return paths.groupBy(F.array_join("path", "/").alias("path"), F.size("path").alias("depth")).agg(F.count_distinct("taxon_id").alias("n_rows"))


def vocab_levels(spark, d):
    v = vocab_tree(spark, d)
    return v.groupBy("depth").agg(F.count("*").alias("n_nodes"), F.sum("n_rows").alias("n_rows"), F.max("n_rows").alias("most"))


def props_terms(spark, d):
    e = table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").cast("int").alias("k"))
    return e.groupBy("event_type").agg(F.count_distinct("k").alias("n_values"), F.min("k").alias("least"), F.max("k").alias("most"))


def heaps_curve(spark, d):
    """Growth of the set of distinct types per user as events come in."""
    e = table(spark, d, "events").filter("ts is not null")
    first = e.groupBy("user_id", "event_type").agg(F.min("ts").alias("ts"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_type").rowsBetween(Window.unboundedPreceding, 0)
    return first.select("user_id", "event_type", F.count("*").over(w).alias("n_seen"))


def descendants(spark, d):
    """Regions, nations and customers as one tree, walked down from the root by a recursive query."""
    table(spark, d, "region").createOrReplaceTempView("sporeline_region")
    table(spark, d, "nation").createOrReplaceTempView("sporeline_nation")
    table(spark, d, "customer").createOrReplaceTempView("sporeline_customer")
    return spark.sql("""with recursive edges(parent, child) as (select 'root', concat('r', r_regionkey) from sporeline_region union all select concat('r', n_regionkey), concat('n', n_nationkey) from sporeline_nation union all select concat('n', c_nationkey), concat('c', c_custkey) from sporeline_customer),
tree(node, depth, path) as (select 'root', 0, '/' union all select e.child, t.depth + 1, concat(t.path, e.child, '/') from tree t join edges e on e.parent = t.node)
select node, depth, path from tree""")


def tree_counts(spark, d):
    return descendants(spark, d).groupBy("depth").agg(F.count("*").alias("n_nodes"), F.min("path").alias("first_path"))


def comment_order(spark, d):
    """Sortable paths of lines within blocks: padded ordinals joined by points."""
    x = _lines(spark, d).filter("label is not null")
    n = F.row_number().over(Window.partitionBy("doc_id", "label").orderBy("line_number"))
    return x.select("doc_id", "line_number", F.concat_ws(".", F.col("label"), F.lpad(n.cast("string"), 6, "0")).alias("sort_key"))


def version_order(spark, d):
    """Attachment names by their digit runs as numbers; the latest of each article."""
    t = table(spark, d, "sections").filter("doc_id is not null and attachment_name is not null").select("doc_id", "attachment_name", F.coalesce(F.nullif(F.regexp_extract("pdf_label", "([0-9]+)", 1), F.lit("")).cast("int"), F.lit(0)).alias("v"))
    return t.groupBy("doc_id").agg(F.max("v").alias("latest"), F.max_by("attachment_name", F.struct("v", "attachment_name")).alias("attachment_name"))


def describe_by_group(spark, d):
    o = table(spark, d, "orders")
    x = F.col("o_totalprice").cast("double")
    return o.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev(x), 4).alias("std"), F.min(x).alias("least"), F.round(F.median(x), 4).alias("median"), F.max(x).alias("most"), F.count_distinct("o_custkey").alias("n_customers"))


def best_row_per_group(spark, d):
    o = table(spark, d, "lineitem")
    w = Window.partitionBy("l_returnflag", "l_linestatus").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return o.withColumn("rn", F.row_number().over(w)).filter("rn <= 3").select("l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_extendedprice", "rn")


def registry_counts(spark, d):
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return c.groupBy(F.coalesce("n_name", F.lit("Unknown")).alias("country")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(10)


def json_set_distance(spark, d):
    """Jaccard distance of the word sets of the English description and the diagnosis of a treatment."""
    t = table(spark, d, "treatments").filter("description is not null and diagnosis is not null")
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(c), F.lit("([a-z]{3,})"), F.lit(1)))
    x = t.select("row_id", words(F.col("description")).alias("a"), words(F.col("diagnosis")).alias("b"))
    return x.select("row_id", F.round(1 - F.coalesce(F.try_divide(F.size(F.array_intersect("a", "b")), F.size(F.array_union("a", "b"))), F.lit(1.0)), 6).alias("distance"))


def deep_merge(spark, d):
    """Values of all records of a treatment id put together: first label, all distinct pages in order."""
    t = table(spark, d, "treatments").filter("_id is not null")
    return t.groupBy("_id").agg(F.min_by("pdf_label", F.when(F.col("pdf_label").isNotNull(), F.col("row_id"))).alias("pdf_label"), F.array_join(F.array_sort(F.collect_set("pdf_page")), ",").alias("pages"), F.count("*").alias("n"))


def title_search(spark, d):
    """Contains, in either of two columns, whatever the letter case; sorted."""
    a = table(spark, d, "articles")
    hit = F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit("notes on")) | F.contains(F.lower(F.coalesce("journal", F.lit(""))), F.lit("hypha"))
    return a.filter(hit).select("doc_id", F.upper(F.coalesce("title", F.lit(""))).alias("title")).orderBy("title", "doc_id")


def activity_report(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("event_type").alias("n_types")).orderBy(F.desc("n"), "user_id").limit(25)


def pricing_summary(spark, d):
    """Sums over line items by flag and status."""
    x = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp"))
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return x.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(net), 2).alias("sum_net"), F.round(F.avg("l_discount"), 6).alias("avg_discount"), F.count("*").alias("n"))


def _labelled(spark, d):
    return _lines(spark, d).filter("label is not null and trim(coalesce(line, '')) <> ''").select("doc_id", "line_number", "line", "label")


def _features():
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, SQLTransformer, StringIndexer, VectorAssembler

    return Pipeline(
        stages=[
            RegexTokenizer(inputCol="line", outputCol="words", pattern=r"[^\p{L}]+", minTokenLength=2),
            SQLTransformer(statement="select *, cast(char_length(line) as double) as length, flatten(transform(words, w -> array(right(w, 2), right(w, 3), right(w, 4)))) as ends from __THIS__"),
            CountVectorizer(inputCol="words", outputCol="tf", vocabSize=800, minDF=2.0),
            IDF(inputCol="tf", outputCol="tfidf", minDocFreq=2),
            CountVectorizer(inputCol="ends", outputCol="ends_tf", vocabSize=200, minDF=2.0),
            VectorAssembler(inputCols=["tfidf", "ends_tf", "length"], outputCol="features"),
            StringIndexer(inputCol="label", outputCol="label_index", handleInvalid="keep"),
        ]
    )


def tfidf_features(spark, d):
    rows = _labelled(spark, d)
    from pyspark.ml.functions import vector_to_array

    got = _features().fit(rows).transform(rows)
    return got.select("doc_id", "line_number", F.round(F.aggregate(vector_to_array("tfidf"), F.lit(0.0), lambda s, x: s + x), 6).alias("weight"), "label_index")


def line_classifier(spark, d):
    """Logistic regression on lines, fitted on four fifths of the articles and scored on the rest: metrics per class."""
    from pyspark.ml.classification import LogisticRegression

    from sporeline.operators.labels import per_class

    rows = _labelled(spark, d).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(5)))
    feats = _features().fit(rows.filter("part < 4"))
    names = feats.stages[-1].labels
    model = LogisticRegression(featuresCol="features", labelCol="label_index", maxIter=10, regParam=0.01).fit(feats.transform(rows.filter("part < 4")))
    out = model.transform(feats.transform(rows.filter("part = 4")))
    table_ = F.array(*[F.lit(n) for n in [*names, "(unknown)"]])
    return per_class(out.select(F.col("label").alias("gold"), F.get(table_, F.col("prediction").cast("int")).alias("pred")))


def tree_classifier(spark, d):
    """A decision tree on lines: its most important words."""
    from pyspark.ml.classification import DecisionTreeClassifier

    rows = _labelled(spark, d)
    feats = _features().fit(rows)
    model = DecisionTreeClassifier(featuresCol="features", labelCol="label_index", maxDepth=8, seed=1).fit(feats.transform(rows))
    names = [*feats.stages[2].vocabulary, *[f"-{s}" for s in feats.stages[4].vocabulary], "(length)"]
    top = sorted(((float(v), names[i]) for i, v in zip(model.featureImportances.indices, model.featureImportances.values)), key=lambda x: (-x[0], x[1]))[:40]
    return spark.createDataFrame([(n, v) for v, n in top], "feature string, importance double")


QUERIES = {f.__name__: f for f in (complexity_score, triage_flags, review_priority, term_merge_metric, regex_search, topk_cosine, threshold_normalize, degradation_summary, lsh_neighbours, vocab_tree, vocab_levels, props_terms, heaps_curve, descendants, tree_counts, comment_order, version_order, describe_by_group, best_row_per_group, registry_counts, json_set_distance, deep_merge, title_search, activity_report, pricing_summary, tfidf_features, line_classifier, tree_classifier)}

_FLAGS = r"""select row_id, concat_ws('|', case when d = '' then 'no_description' end, case when d <> '' and length(d) < 200 then 'short' end, case when length(d) > 4000 then 'merged' end, case when regexp_matches(d, '^[a-z,;)]') then 'starts_mid_sentence' end,
case when d <> '' and not regexp_matches(rtrim(d, ' '), '[.!?"»”“。।]$') then 'clipped_tail' end, case when len(regexp_extract_all(t, '(?:sp|gen|comb|nom)\. nov\.')) > 1 then 'several_names' end, case when contains(d, 'ITS barcode') then 'sequence' end, case when len(regexp_extract_all(d, '\n\n')) >= 3 then 'many_paragraphs' end) as flags
from (select row_id, coalesce(description, '') d, coalesce(treatment, '') t from treatments)"""
_TREE = """with recursive edges(parent, child) as (select 'root', 'r' || r_regionkey from region union all select 'r' || n_regionkey, 'n' || n_nationkey from nation union all select 'n' || c_nationkey, 'c' || c_custkey from customer),
tree(node, depth, path) as (select 'root', 0, '/' union all select e.child, t.depth + 1, t.path || e.child || '/' from tree t join edges e on e.parent = t.node)"""
_COS = "list_dot_product({0}::double[], {1}::double[]) / nullif(sqrt(list_dot_product({0}::double[], {0}::double[])) * sqrt(list_dot_product({1}::double[], {1}::double[])), 0)"
_BEST = f"""with p as (select label, pos, avg(x::double) x from (select label, unnest(embedding) x, generate_subscripts(embedding, 1) pos from embeddings) group by 1, 2), c as (select label as cl, list(x order by pos) c from p group by 1),
s as (select vec_id, cl, coalesce({_COS.format("embedding", "c")}, 0.0) sim from embeddings, c), b as (select *, row_number() over (partition by vec_id order by round(sim, 9) desc, cl) rn from s)"""
_LEVEL = "case when sim >= 0.85 then 'high' when sim >= 0.6 then 'medium' when sim >= 0.3 then 'low' else 'novel' end"
_VOCAB = """with t as (select taxon_id, list_filter(regexp_split_to_array(regexp_replace(lower(taxon), '[^a-z ]', ' ', 'g'), ' +'), lambda x: length(x) >= 4) w from taxon),
v as (select w[1] as path, 1 as depth, taxon_id from t where len(w) >= 2 union all select w[1] || '/' || w[2], 2, taxon_id from t where len(w) >= 2), n as (select path, depth, count(distinct taxon_id) as n_rows from v group by 1, 2)"""

from sporeline.plans.lines import _CLEAN  # noqa: E402

SQL = {
    "complexity_score": "select row_id, len(regexp_extract_all(d, '[^\\s]+')) + 5 * (" + " + ".join(f"contains(lower(d), '{w}')::int" for w in T.FEATURES) + f") + 5 * len(regexp_extract_all(d, '{T.MEASURE}')) as score from (select row_id, coalesce(description, '') d from treatments)",
    "triage_flags": _FLAGS,
    "review_priority": f"select flag, count(*) as n from (select unnest(string_split(flags, '|')) as flag from ({_FLAGS})) where flag <> '' group by 1",
    "term_merge_metric": f"select doc_id, count(*) as n_terms, max(n) as most from (select doc_id, w, count(*) n from (select doc_id, unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) w from documents) where w not in ({', '.join(repr(s) for s in STOP)}) group by 1, 2 having count(*) >= 8) group by 1",
    "regex_search": "select row_id, treatment from treatments where regexp_matches(coalesce(treatment, ''), '(?i)[a-z]+ (elegans|gracilis|simplex)') order by row_id limit 50",
    "topk_cosine": f"select vec_id, round(coalesce({_COS.format('embedding', 'q')}, 0.0), 5) as similarity from embeddings, (select embedding q from embeddings where vec_id = 0) order by similarity desc, vec_id limit 10",
    "threshold_normalize": f"{_BEST} select vec_id, cl as label, round(sim, 5) as similarity, {_LEVEL} as level from b where rn = 1",
    "degradation_summary": f"{_BEST} select {_LEVEL} as level, count(*) as n from b where rn = 1 group by 1",
    "vocab_tree": f"{_VOCAB} select * from n",
    "vocab_levels": f"{_VOCAB} select depth, count(*) as n_nodes, sum(n_rows)::bigint as n_rows, max(n_rows) as most from n group by 1",
    "props_terms": "select event_type, count(distinct k) as n_values, min(k) as least, max(k) as most from (select event_type, json_extract_string(props, '$.k')::int k from events) group by 1",
    "heaps_curve": "select user_id, event_type, count(*) over (partition by user_id order by ts, event_type rows between unbounded preceding and current row) as n_seen from (select user_id, event_type, min(ts) ts from events where ts is not null group by 1, 2)",
    "descendants": f"{_TREE} select node, depth, path from tree",
    "tree_counts": f"{_TREE} select depth, count(*) as n_nodes, min(path) as first_path from tree group by 1",
    "comment_order": f"with {_CLEAN} select doc_id, line_number, label || '.' || lpad((row_number() over (partition by doc_id, label order by line_number))::varchar, 6, '0') as sort_key from clean where label is not null",
    "version_order": "with t as (select doc_id, attachment_name, coalesce(nullif(regexp_extract(pdf_label, '([0-9]+)', 1), '')::int, 0) v from sections where doc_id is not null and attachment_name is not null) select doc_id, max(v) as latest, arg_max(attachment_name, {v: v, a: attachment_name}) as attachment_name from t group by 1",
    "describe_by_group": "select o_orderpriority, count(*) as n, round(avg(o_totalprice::double), 4) as mean, round(stddev(o_totalprice::double), 4) as std, min(o_totalprice::double) as least, round(median(o_totalprice::double), 4) as median, max(o_totalprice::double) as most, count(distinct o_custkey) as n_customers from orders group by 1",
    "best_row_per_group": "select l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_extendedprice, rn from (select *, row_number() over (partition by l_returnflag, l_linestatus order by l_extendedprice desc, l_orderkey, l_linenumber) rn from lineitem) where rn <= 3",
    "registry_counts": "select coalesce(n_name, 'Unknown') as country, count(*) as n from customer left join nation on c_nationkey = n_nationkey group by 1 order by n desc, country limit 10",
    "json_set_distance": "with x as (select row_id, list_distinct(regexp_extract_all(lower(description), '[a-z]{3,}')) a, list_distinct(regexp_extract_all(lower(diagnosis), '[a-z]{3,}')) b from treatments where description is not null and diagnosis is not null) select row_id, round(1 - coalesce(len(list_intersect(a, b)) / nullif(len(list_distinct(list_concat(a, b))), 0), 1.0), 6) as distance from x",
    "deep_merge": "select _id, arg_min(pdf_label, row_id) filter (pdf_label is not null) as pdf_label, coalesce(array_to_string(list_sort(list(distinct pdf_page) filter (pdf_page is not null)), ','), '') as pages, count(*) as n from treatments where _id is not null group by 1",
    "title_search": "select doc_id, upper(coalesce(title, '')) as title from articles where contains(lower(coalesce(title, '')), 'notes on') or contains(lower(coalesce(journal, '')), 'hypha')",
    "activity_report": "select user_id, count(*) as n, count(distinct event_type) as n_types from events group by 1 order by n desc, user_id limit 25",
    "pricing_summary": "select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) as sum_net, round(avg(l_discount), 6) as avg_discount, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by 1, 2",
}
