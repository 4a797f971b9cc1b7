"""Queries over records, pages, dates, JSON and the long tail of small operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sporeline.operators import labels as L
from sporeline.operators import records as R
from sporeline.plans.lines import _CLEAN, _PRED, _RUNS, _lines
from sporeline.sources.tables import table

MONTHS = ["Jan", "Feb", "March", "Apr", "May", "June", "July", "Aug", "Sept", "Oct", "Nov", "Dec"]


def roman_pages(spark, d):
    s = table(spark, d, "sections").filter(F.col("value").rlike("^[ivxlcdm]+$"))
    return s.select("section_id", R.roman(F.col("value")).alias("number"))


def first_lines(spark, d):
    return table(spark, d, "treatments").filter("treatment is not null").select("row_id", R.first_line(F.col("treatment"), 40).alias("title"))


def collection_years(spark, d):
    """Years in which specimens were collected."""
    t = table(spark, d, "treatments").select(F.explode(F.regexp_extract_all("materials_examined", F.lit(r"[0-9]{1,2} [A-Z][a-z]+\.? ((?:1[89]|20)[0-9]{2})"), F.lit(1))).alias("y"))
    return t.groupBy(F.col("y").cast("int").alias("year")).agg(F.count("*").alias("n"))


def collection_dates(spark, d):
    """Dates of specimens as dates, whatever the abbreviation of the month."""
    pat = r"([0-9]{1,2} (?:" + "|".join(MONTHS) + r")[a-z]*\.? (?:1[89]|20)[0-9]{2})"
    t = table(spark, d, "treatments").select("row_id", F.explode(F.regexp_extract_all("materials_examined", F.lit(pat), F.lit(1))).alias("x"))
    short = F.substring(F.split_part("x", F.lit(" "), F.lit(2)), 1, 3)
    day = F.lpad(F.split_part("x", F.lit(" "), F.lit(1)), 2, "0")
    return t.select("row_id", F.to_date(F.concat_ws(" ", day, short, F.split_part("x", F.lit(" "), F.lit(3))), "dd MMM yyyy").cast("string").alias("day")).groupBy("row_id").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("n"))


def json_paths(spark, d):
    """Key paths of the metadata and how often each value stands there, the values per article left out."""
    y = table(spark, d, "yedda_lines").select(F.explode(F.from_json("metadata", "map<string,string>")).alias("key", "value"))
    return y.groupBy("key").agg(F.count("*").alias("n"), F.count_distinct("value").alias("n_values"))


def variant_valid(spark, d):
    """Whether properties are valid JSON."""
    e = table(spark, d, "events").select(F.try_parse_json("props").isNotNull().alias("valid"))
    return e.groupBy("valid").agg(F.count("*").alias("n"))


def valid_terms(spark, d):
    """Words of treatments that may stand in a vocabulary."""
    t = table(spark, d, "treatments").select(F.explode(F.split(F.lower(F.coalesce("biology", F.lit(""))), r"[\s,.;]+")).alias("term")).filter("term <> ''")
    ok = (F.char_length("term") <= 100) & F.col("term").rlike("[a-z]") & ~F.col("term").rlike(r"^[\[{]")
    return t.filter(ok).groupBy("term").agg(F.count("*").alias("n"))


def retry_skip(spark, d):
    """Users whose last error is less than three days before the last event of all."""
    e = table(spark, d, "events").filter("ts is not null")
    last = e.agg(F.max("ts").alias("now"))
    err = e.filter("event_type = 'error'").groupBy("user_id").agg(F.max("ts").alias("ts"))
    return err.join(F.broadcast(last), F.lit(True)).filter(F.expr("timestampdiff(SECOND, ts, now) < 259200")).select("user_id")


def char_metrics(spark, d):
    """Characters of each label that the rule labels find, miss and add, and the overlap."""
    x = _lines(spark, d).filter("label is not null").select("label", L.prediction(F.col("line")).alias("pred"), F.char_length(F.coalesce("line", F.lit(""))).alias("n"))
    roles = x.select(F.explode(F.when(F.col("label") == F.col("pred"), F.array(F.struct(F.col("label").alias("l"), F.lit("tp").alias("r"), "n"))).otherwise(F.array(F.struct(F.col("label").alias("l"), F.lit("fn").alias("r"), "n"), F.struct(F.col("pred").alias("l"), F.lit("fp").alias("r"), "n")))).alias("z")).select("z.*")
    of = lambda r: F.coalesce(F.sum(F.when(F.col("r") == r, F.col("n"))), F.lit(0))
    t = roles.groupBy(F.col("l").alias("label")).agg(of("tp").alias("tp"), of("fp").alias("fp"), of("fn").alias("fn"))
    return t.select("label", "tp", "fp", "fn", F.round(F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)), 6).alias("overlap"))


def scope_confidence(spark, d):
    """Collectors and types named in lines, surer in a line labelled as material than elsewhere."""
    y = _lines(spark, d).filter(F.col("line").rlike(r"Holotype|leg\.|coll\.|[A-Z]{2,5} [0-9]{3,}"))
    return y.select("doc_id", "line_number", F.when(F.col("label") == "materials-examined", 0.9).otherwise(0.6).alias("confidence"))


def block_chunks(spark, d):
    """Blocks of an article in chunks of twenty."""
    b = L.coalesce_blocks(_lines(spark, d))
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("first_line")) - 1
    return b.withColumn("chunk", F.floor(n / 20)).groupBy("doc_id", "chunk").agg(F.count("*").alias("n_blocks"), F.sum(F.char_length("text")).alias("chars"))


def greedy_chunks(spark, d):
    """Blocks of an article packed in turn under a budget of characters."""
    b = L.coalesce_blocks(_lines(spark, d)).withColumn("n", F.char_length("text"))
    per = b.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("first_line", "n"))).alias("x"))
    g = per.select("doc_id", "x", R.greedy_groups(F.transform("x", lambda v: v["n"]), 2000).alias("g"))
    return g.select("doc_id", F.explode(F.arrays_zip("x", "g")).alias("z")).select("doc_id", F.col("z.x.first_line").alias("first_line"), F.col("z.g").alias("chunk"))


def key_prefixes(spark, d):
    """Attachment names up to the first point, distinct."""
    return table(spark, d, "sections").filter("attachment_name is not null").select(F.substring_index("attachment_name", ".", 1).alias("prefix"), "attachment_name").groupBy("prefix").agg(F.count_distinct("attachment_name").alias("n"))


def paged_scan(spark, d):
    """The third page of fifty of the documents in order."""
    return table(spark, d, "documents").select("doc_id", "source").orderBy("doc_id").offset(100).limit(50)


def field_merge(spark, d):
    """Of the records of an id the longest text of each field, ties to the first."""
    t = table(spark, d, "treatments").filter("_id is not null")
    longest = lambda c: F.max_by(c, F.struct(F.coalesce(F.char_length(c), F.lit(-1)), -F.col("row_id"))).alias(c)
    return t.groupBy("_id").agg(longest("treatment"), longest("biology"), longest("notes"))


def winner_by_score(spark, d):
    """Of the records of an article the one with most filled in."""
    t = table(spark, d, "treatments").withColumn("doc_id", F.col("ingest")["_id"]).filter("doc_id is not null")
    has = lambda c, n: F.when(F.col(c).isNotNull(), n).otherwise(0)
    score = has("description", 100) + has("diagnosis", 10) + has("pdf_page", 5) + F.size(F.coalesce("ingest", F.create_map().cast("map<string,string>")))
    w = Window.partitionBy("doc_id").orderBy(F.desc("score"), "row_id")
    return t.withColumn("score", score).withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("doc_id", "row_id", "score")


def renames(spark, d):
    """Journals whose name in the treatments differs from the usual form, and that form."""
    j = table(spark, d, "treatments").select(F.col("ingest")["journal"].alias("journal")).filter("journal is not null").distinct()
    fine = F.regexp_replace(F.regexp_replace(F.trim("journal"), r"\s+", " "), " & ", " and ")
    return j.select("journal", fine.alias("usual")).filter("journal <> usual")


def all_journals(spark, d):
    a = table(spark, d, "articles").select("journal")
    t = table(spark, d, "treatments").select(F.col("ingest")["journal"].alias("journal"))
    return a.union(t).filter("journal is not null").distinct()


def run_status(spark, d):
    """State of each article: has treatments and lines, only one of them, or none."""
    ids = lambda t, c, n: table(spark, d, t).select(c.alias("doc_id")).filter("doc_id is not null").distinct().withColumn(n, F.lit(True))
    a = table(spark, d, "articles").select("doc_id")
    x = a.join(ids("treatments", F.col("ingest")["_id"], "t"), "doc_id", "left").join(ids("yedda_lines", F.col("doc_id"), "y"), "doc_id", "left")
    state = F.when(F.col("t") & F.col("y"), "success").when(F.col("t").isNotNull() | F.col("y").isNotNull(), "partial").otherwise("error")
    return x.groupBy(state.alias("state")).agg(F.count("*").alias("n"))


def nested_export(spark, d):
    """Journals with their articles as nested JSON."""
    a = table(spark, d, "articles").filter("journal is not null")
    return a.groupBy("journal").agg(F.array_join(F.transform(F.array_sort(F.collect_list("doc_id")), lambda x: F.concat(F.lit('"'), x, F.lit('"'))), ",").alias("ids"), F.count("*").alias("n")).select("journal", F.concat(F.lit("["), "ids", F.lit("]")).alias("articles"), "n")


def parity_alternation(spark, d):
    """How often neighbouring printed page numbers of an article change between odd and even."""
    s = table(spark, d, "sections").filter("doc_id is not null and pdf_page is not null and empirical_page_number is not null").groupBy("doc_id", "pdf_page").agg(F.min("empirical_page_number").alias("p"))
    prev = F.lag("p").over(Window.partitionBy("doc_id").orderBy("pdf_page"))
    x = s.withColumn("changes", (F.pmod("p", F.lit(2)) != F.pmod(prev, F.lit(2))).cast("int")).filter("changes is not null")
    return x.groupBy("doc_id").agg(F.round(F.avg("changes"), 6).alias("rate"), F.count("*").alias("n"))


def page_line_fit(spark, d):
    """Slope and start of the printed numbers over the pages of an article, from the line most pages are near to."""
    s = table(spark, d, "sections").filter("doc_id is not null and pdf_page is not null and empirical_page_number is not null").select("doc_id", "pdf_page", "empirical_page_number").distinct()
    return R.best_line(s, ["doc_id"], "pdf_page", "empirical_page_number").filter("n_near >= 4")


def source_suffixes(spark, d):
    """Source keys without series and issue, and the addresses of articles without their scheme."""
    a = table(spark, d, "articles").filter("source_key is not null")
    bare = F.trim(F.regexp_replace(F.regexp_replace("source_key", r"(?i),? ser\. [0-9]+\s*$", ""), r"[0-9]+\([0-9]+\)", ""))
    return a.select(F.lower(bare).alias("source")).groupBy("source").agg(F.count("*").alias("n"))


def url_ids(spark, d):
    """Ids of treatments from their addresses."""
    return table(spark, d, "treatments").select("row_id", F.col("ingest")["url"].alias("url")).filter("url is not null").select("row_id", R.url_id("url").alias("id"))


def json_merge(spark, d):
    """All metadata of an article's lines merged."""
    y = table(spark, d, "yedda_lines").filter("doc_id is not null and metadata is not null").groupBy("doc_id", "metadata").agg(F.min("line_id").alias("line_id"))
    return R.merge_json(y, "doc_id", "line_id", "metadata")


def embedding_clusters(spark, d):
    """Clusters of embeddings by bisecting k-means, sizes."""
    from pyspark.ml.clustering import BisectingKMeans
    from pyspark.ml.functions import array_to_vector

    e = table(spark, d, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    return BisectingKMeans(k=8, seed=1, distanceMeasure="cosine").fit(e).transform(e).groupBy("prediction").agg(F.count("*").alias("n"))


def explained_variance(spark, d):
    """Share of variance of the leading components of the embeddings, and its running sum."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    e = table(spark, d, "embeddings").select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    v = PCA(k=32, inputCol="features", outputCol="pca").fit(e).explainedVariance.toArray().tolist()
    rows = spark.createDataFrame(list(enumerate(v)), "component int, share double")
    return rows.withColumn("cumulative", F.sum("share").over(Window.orderBy("component")))  # 32 rows


QUERIES = {f.__name__: f for f in (roman_pages, first_lines, collection_years, collection_dates, json_paths, variant_valid, valid_terms, retry_skip, char_metrics, scope_confidence, block_chunks, greedy_chunks, key_prefixes, paged_scan, field_merge, winner_by_score, renames, all_journals, run_status, nested_export, parity_alternation, page_line_fit, source_suffixes, url_ids, json_merge, embedding_clusters, explained_variance)}

_V = "list_transform(string_split(value, ''), lambda x: case x when 'i' then 1 when 'v' then 5 when 'x' then 10 when 'l' then 50 when 'c' then 100 when 'd' then 500 else 1000 end)"
_LONG = "arg_max({0}, {{a: length({0}), b: -row_id}}) filter ({0} is not null) as {0}"

SQL = {
    "roman_pages": f"with v as (select section_id, {_V} v from sections where regexp_full_match(value, '[ivxlcdm]+')) select section_id, list_sum(list_transform(v, lambda x, i: case when i < len(v) and x < list_max(v[i + 1:]) then -x else x end))::int as number from v",
    "first_lines": "with l as (select row_id, list_filter(list_transform(string_split(treatment, chr(10)), lambda x: trim(x)), lambda x: x <> '')[1] s from treatments where treatment is not null) select row_id, case when length(s) > 40 then rtrim(substring(s, 1, 39)) || '…' else s end as title from l",
    "collection_years": r"select y::int as year, count(*) as n from (select unnest(regexp_extract_all(materials_examined, '[0-9]{1,2} [A-Z][a-z]+\.? ((?:1[89]|20)[0-9]{2})', 1)) y from treatments) group by 1",
    "collection_dates": r"with x as (select row_id, unnest(regexp_extract_all(materials_examined, '([0-9]{1,2} (?:" + "|".join(MONTHS) + r")[a-z]*\.? (?:1[89]|20)[0-9]{2})', 1)) x from treatments), p as (select row_id, strptime(lpad(split_part(x, ' ', 1), 2, '0') || ' ' || substring(split_part(x, ' ', 2), 1, 3) || ' ' || split_part(x, ' ', 3), '%d %b %Y')::date::varchar d from x) select row_id, min(d) as first_day, max(d) as last_day, count(*) as n from p group by 1",
    "json_paths": "select key, count(*) as n, count(distinct value) as n_values from (select unnest(json_keys(metadata)) as key, json_extract_string(metadata, '$.' || unnest(json_keys(metadata))) as value from yedda_lines) group by 1",
    "variant_valid": "select coalesce(json_valid(props), false) as valid, count(*) as n from events group by 1",
    "valid_terms": r"select term, count(*) as n from (select unnest(regexp_split_to_array(lower(coalesce(biology, '')), '[\s,.;]+')) term from treatments) where term <> '' and length(term) <= 100 and regexp_matches(term, '[a-z]') and not regexp_matches(term, '^[\[{]') group by 1",
    "retry_skip": "select user_id from events where event_type = 'error' and ts is not null group by 1 having date_diff('second', max(ts), (select max(ts) from events)) < 259200",
    "char_metrics": f"with {_CLEAN}, p as (select label, {_PRED} pred, length(coalesce(line, '')) n from clean where label is not null), r as (select label as l, case when label = pred then 'tp' else 'fn' end r, n from p union all select pred, 'fp', n from p where label <> pred), a as (select l as label, coalesce(sum(n) filter (r = 'tp'), 0)::bigint as tp, coalesce(sum(n) filter (r = 'fp'), 0)::bigint as fp, coalesce(sum(n) filter (r = 'fn'), 0)::bigint as fn from r group by 1) select *, round(coalesce(tp / nullif(tp + fp + fn, 0), 0.0), 6) as overlap from a",
    "scope_confidence": f"with {_CLEAN} select doc_id, line_number, case when label = 'materials-examined' then 0.9::double else 0.6::double end as confidence from clean where regexp_matches(line, 'Holotype|leg\\.|coll\\.|[A-Z]{{2,5}} [0-9]{{3,}}')",
    "block_chunks": f"with {_CLEAN}, keyed as (select *, coalesce(label, '') k from clean), {_RUNS}, c as (select *, (row_number() over (partition by doc_id order by first_line) - 1) // 20 as chunk from blocks) select doc_id, chunk, count(*) as n_blocks, sum(length(text))::bigint as chars from c group by 1, 2",
    "key_prefixes": "select split_part(attachment_name, '.', 1) as prefix, count(distinct attachment_name) as n from sections where attachment_name is not null group by 1",
    "paged_scan": "select doc_id, source from documents order by doc_id limit 50 offset 100",
    "field_merge": "select _id, " + ", ".join(_LONG.format(c) for c in ("treatment", "biology", "notes")) + " from treatments where _id is not null group by 1",
    "winner_by_score": "with s as (select ingest['_id'] as doc_id, row_id, (case when description is not null then 100 else 0 end + case when diagnosis is not null then 10 else 0 end + case when pdf_page is not null then 5 else 0 end + coalesce(cardinality(ingest), 0))::int as score from treatments) select doc_id, row_id, score from (select *, row_number() over (partition by doc_id order by score desc, row_id) rn from s where doc_id is not null) where rn = 1",
    "renames": r"with j as (select distinct ingest['journal'] as journal from treatments where ingest['journal'] is not null), u as (select journal, replace(regexp_replace(trim(journal), '\s+', ' ', 'g'), ' & ', ' and ') as usual from j) select * from u where journal <> usual",
    "all_journals": "select journal from articles where journal is not null union select ingest['journal'] from treatments where ingest['journal'] is not null",
    "run_status": "with t as (select distinct ingest['_id'] d from treatments), y as (select distinct doc_id d from yedda_lines) select case when t.d is not null and y.d is not null then 'success' when t.d is not null or y.d is not null then 'partial' else 'error' end as state, count(*) as n from articles a left join t on t.d = a.doc_id left join y on y.d = a.doc_id group by 1",
    "nested_export": """select journal, '[' || string_agg('"' || doc_id || '"', ',' order by doc_id) || ']' as articles, count(*) as n from articles where journal is not null group by 1""",
    "parity_alternation": "with p as (select doc_id, pdf_page, min(empirical_page_number) p from sections where doc_id is not null and pdf_page is not null and empirical_page_number is not null group by 1, 2), c as (select doc_id, (p % 2 <> lag(p) over (partition by doc_id order by pdf_page) % 2)::int x from p) select doc_id, round(avg(x), 6) as rate, count(*) as n from c where x is not null group by 1",
    "page_line_fit": """with p as (select distinct doc_id, pdf_page::double px, empirical_page_number::double py from sections where doc_id is not null and pdf_page is not null and empirical_page_number is not null),
s as (select *, lag(px) over w qx, lag(py) over w qy from p window w as (partition by doc_id order by px, py)), l as (select doc_id, round((py - qy) / (px - qx), 6) slope, px, py from s where px > qx), l2 as (select doc_id, slope, round(py - slope * px, 6) at0 from l),
v as (select doc_id, slope, at0, count(*) votes, row_number() over (partition by doc_id order by count(*) desc, abs(slope - 1), slope, at0) rn from l2 group by 1, 2, 3)
select v.doc_id, slope, at0, votes, count(*) filter (abs(py - slope * px - at0) <= 1) as n_near, count(*) as n_points from v join p on p.doc_id = v.doc_id where rn = 1 group by 1, 2, 3, 4 having count(*) filter (abs(py - slope * px - at0) <= 1) >= 4""",
    "source_suffixes": r"select lower(trim(regexp_replace(regexp_replace(source_key, '(?i),? ser\. [0-9]+\s*$', ''), '[0-9]+\([0-9]+\)', '', 'g'))) as source, count(*) as n from articles where source_key is not null group by 1",
}
