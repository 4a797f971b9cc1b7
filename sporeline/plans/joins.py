"""Queries over joins, spans, evaluation, deduplication and sampling, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sporeline.functions.text import content_id
from sporeline.operators import labels as L
from sporeline.operators import spans as S
from sporeline.plans.lines import _CLEAN, _PRED, _RUNS, _doc_lines, _lines
from sporeline.sources.tables import table


def source_stats(spark, d):
    """Articles, treatments and name acts of each journal, its share of all treatments, with a grand total row."""
    a = table(spark, d, "articles").select("doc_id", F.coalesce("journal", F.lit("Unknown")).alias("journal"))
    t = table(spark, d, "treatments").select(F.col("ingest")["_id"].alias("doc_id"), F.regexp_count("treatment", F.lit(r"(sp|gen|comb|nom)\. nov\.")).alias("acts"))
    per = t.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"), F.sum("acts").alias("acts"))
    got = a.join(per, "doc_id", "left").groupBy("journal").agg(F.count("*").alias("n_articles"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_treatments"), F.coalesce(F.sum("acts"), F.lit(0)).alias("n_acts"))
    whole = got.agg(F.lit("(all)").alias("journal"), F.sum("n_articles").alias("n_articles"), F.sum("n_treatments").alias("n_treatments"), F.sum("n_acts").alias("n_acts"))
    both = got.unionByName(whole)
    n = F.max("n_treatments").over(Window.partitionBy())  # one row per journal
    return both.select("journal", "n_articles", "n_treatments", "n_acts", F.round(F.coalesce(F.try_divide(100.0 * F.col("n_treatments"), n), F.lit(0.0)), 1).alias("percent"))


def journal_fallback(spark, d):
    """Journal of a treatment: its own record, else its article's, else the one of the article's source key, else unknown."""
    a = table(spark, d, "articles").select("doc_id", "journal", F.nullif(F.trim(F.regexp_extract("source_key", r"^\s*([^0-9]+?)\s*[0-9]", 1)), F.lit("")).alias("from_key"))
    t = table(spark, d, "treatments").select("row_id", F.col("ingest")["_id"].alias("doc_id"), F.col("ingest")["journal"].alias("own"))
    return t.join(a, "doc_id", "left").select("row_id", F.coalesce("own", "journal", "from_key", F.lit("Unknown")).alias("journal"))


def dedup_best(spark, d):
    """Of treatments of one id the one with most source anchors, then the first line."""
    t = table(spark, d, "treatments").filter("_id is not null")
    w = Window.partitionBy("_id").orderBy(F.desc(F.size(F.coalesce("source_anchors", F.array().cast("array<map<string,string>>")))), F.asc_nulls_last("line_number"), "row_id")
    return t.withColumn("rn", F.row_number().over(w)).filter("rn = 1").select("_id", "row_id")


def content_ids(spark, d):
    f = ["treatment", "diagnosis", "description", "distribution", "etymology", "materials_examined", "type_designation", "biology", "notes", "key_text", "figure_captions"]
    return table(spark, d, "treatments").select("row_id", content_id(*[F.col(c) for c in f]).alias("content_id"))


def populated_sections(spark, d):
    f = ["description", "diagnosis", "etymology", "distribution", "materials_examined", "type_designation", "biology", "notes", "key_text", "figure_captions"]
    n = sum((F.when(F.coalesce(F.col(c), F.lit("")) != "", 1).otherwise(0) for c in f), F.lit(0))
    return table(spark, d, "treatments").select("row_id", n.alias("n_sections"))


def limit_by_doc(spark, d):
    """All sections of the first twenty articles."""
    s = table(spark, d, "sections")
    first = s.filter("doc_id is not null").select("doc_id").distinct().orderBy("doc_id").limit(20)
    return s.join(first, "doc_id", "left_semi").select("section_id", "doc_id")


def skip_existing(spark, d):
    """Articles with sections but without treatments."""
    t = table(spark, d, "treatments").select(F.col("ingest")["_id"].alias("doc_id"))
    return table(spark, d, "sections").select("doc_id").distinct().join(t, "doc_id", "left_anti")


def split_membership(spark, d):
    """Rows of documents in training and test part, by a rule on the id."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    part = docs.select("doc_id", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("part"))
    return docs.join(part, "doc_id").groupBy("part", "source").agg(F.count("*").alias("n"))


def anchors(spark, d):
    """Kinds of source anchors of treatments, one row each."""
    t = table(spark, d, "treatments").select("row_id", F.explode("source_anchors").alias("a"))
    return t.groupBy(F.col("a")["kind"].alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("row_id").alias("n_treatments"))


def annotation_diff(spark, d):
    """Labels of lines against the rule labels: kept, added, deleted."""
    x = _lines(spark, d)
    old = x.filter("label is not null").select("doc_id", "line_number", "label", F.lit(1).alias("a"))
    new = x.select("doc_id", "line_number", L.prediction(F.col("line")).alias("label"), F.lit(1).alias("b"))
    state = F.when(F.col("a").isNull(), "added").when(F.col("b").isNull(), "deleted").otherwise("kept").alias("state")
    return old.join(new, ["doc_id", "line_number", "label"], "full").groupBy("label", state).agg(F.count("*").alias("n"))


def align_full_outer(spark, d):
    """Blocks of equal text in the labels and the rule labels, paired in order of occurrence."""
    x = _lines(spark, d)
    gold = L.coalesce_blocks(x).select("doc_id", "text", F.col("label").alias("gold"), "first_line")
    pred = L.coalesce_blocks(x.withColumn("label", L.prediction(F.col("line")))).select("doc_id", "text", F.col("label").alias("pred"), "first_line")
    nth = F.row_number().over(Window.partitionBy("doc_id", "text").orderBy("first_line"))
    g, p = gold.withColumn("nth", nth).drop("first_line"), pred.withColumn("nth", nth).drop("first_line")
    met = g.join(p, ["doc_id", "text", "nth"], "full")
    return met.groupBy(F.coalesce("gold", F.lit("(none)")).alias("gold"), F.coalesce("pred", F.lit("(none)")).alias("pred")).agg(F.count("*").alias("n"))


def _particles(spark, d):
    return S.particles(table(spark, d, "documents"))


def particle_spans(spark, d):
    return _particles(spark, d).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("doc_id").alias("n_docs"), F.sum(F.col("end") - F.col("start")).alias("chars"))


def span_line_overlap(spark, d):
    """Identifiers found in documents with the lines they lie on."""
    lines = _doc_lines(spark, d).select("doc_id", F.col("line_start").alias("other_start"), (F.col("line_start") + F.char_length("line")).alias("other_end"), "line_number")
    met = S.overlap_join(_particles(spark, d).select("doc_id", "start", "end", "label"), lines.filter("other_end > other_start"), "doc_id", 2000)
    return met.select("doc_id", "label", "start", "line_number")


def span_conflicts(spark, d):
    """Identifiers and whole bracketed remarks, of which overlapping ones give way to the shorter."""
    return S.resolve_conflicts(_particles(spark, d).withColumn("confidence", F.lit(0.9)).drop("found"))


def _seconds():
    """Seconds since 1970 of ``ts``, whatever the time zone of the session."""
    return F.expr("timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', ts)")


def event_gaps(spark, d):
    """Gaps between the five-minute spans of a user's events, in seconds."""
    e = table(spark, d, "events").select("user_id", _seconds().alias("start"), (_seconds() + 300).alias("end"))
    return S.gaps(e, ["user_id"]).groupBy("user_id").agg(F.count_if(F.col("gap") >= 10).alias("n_gaps"), F.max("gap").alias("longest"))


def highlight_merge(spark, d):
    e = table(spark, d, "events").select("user_id", _seconds().alias("start"), (_seconds() + 20000).alias("end"))
    return S.merged(e, ["user_id"])


def round_robin(spark, d):
    """Documents taken from the sources in turn until a hundred are there."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("?")).alias("source"))
    turn = docs.withColumn("turn", F.row_number().over(Window.partitionBy("source").orderBy("doc_id")))
    return turn.orderBy("turn", "source").limit(100)


def even_sample(spark, d):
    """Of each source five documents at even distances of its order."""
    docs = table(spark, d, "documents").filter("source is not null").select("doc_id", "source")
    w = Window.partitionBy("source")
    n = docs.withColumn("i", F.row_number().over(w.orderBy("doc_id")) - 1).withColumn("n", F.count("*").over(w))
    hit = F.exists(F.sequence(F.lit(0), F.lit(4)), lambda k: F.floor(k * F.col("n") / 5) == F.col("i"))
    return n.filter(hit).select("source", "doc_id")


def score_bands(spark, d):
    """Seven bands of equal size of the documents by length, and where they begin and end."""
    docs = table(spark, d, "documents").select("doc_id", F.char_length("text").alias("score"), F.coalesce("source", F.lit("?")).alias("source"))
    w = Window.partitionBy("source").orderBy("score", "doc_id")
    n = docs.withColumn("rn", F.row_number().over(w)).withColumn("n", F.count("*").over(Window.partitionBy("source")))
    band = F.expr("((rn * 7) - 1) div n")
    return n.groupBy("source", band.alias("band")).agg(F.count("*").alias("n_docs"), F.min("score").alias("least"), F.max("score").alias("most"))


def union_reinsert(spark, d):
    """Body paragraphs and page lines, split for separate treatment and put together again."""
    s = table(spark, d, "sections").filter("value is not null")
    marker = F.col("value").rlike(r"^\W*(p\. )?[0-9]+\W*$")
    body = s.filter(~marker).select("section_id", F.char_length("value").alias("length"))
    marks = s.filter(marker).select("section_id", F.lit(True).alias("is_marker"))
    both = body.unionByName(marks, allowMissingColumns=True)
    return both.select("section_id", "length", F.coalesce("is_marker", F.lit(False)).alias("is_marker"))


def set_ops(spark, d):
    """Articles with treatments, with sections, with both, with labelled lines only."""
    ids = lambda t, c: table(spark, d, t).select(c.alias("doc_id")).filter("doc_id is not null")
    t, s, y = ids("treatments", F.col("ingest")["_id"]), ids("sections", F.col("doc_id")), ids("yedda_lines", F.col("doc_id"))
    named = lambda df, n: df.agg(F.lit(n).alias("what"), F.count("*").alias("n"))
    return named(t.union(s).distinct(), "union").union(named(t.intersect(s), "both")).union(named(y.distinct().subtract(t), "lines_only"))


def unique_lines(spark, d):
    """Distinct lines of labelled text in the order they were first seen."""
    y = table(spark, d, "yedda_lines").filter("line is not null")
    return y.groupBy("line").agg(F.min("line_id").alias("first_id"), F.count("*").alias("n"))


def latest_per_key(spark, d):
    """The last event of each user and type."""
    e = table(spark, d, "events")
    return e.groupBy("user_id", "event_type").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


def upsert(spark, d):
    """Names of curators replace those of the first load, new ones are added; the key is article and line."""
    t = table(spark, d, "taxon").filter("doc_id is not null and line_number is not null")
    old, new = t.filter("taxon_id % 3 <> 0"), t.filter("taxon_id % 3 = 0")
    best = lambda df: df.groupBy("doc_id", "line_number").agg(F.min("taxon_id").alias("taxon_id"))
    return best(old).join(new, ["doc_id", "line_number"], "left_anti").unionByName(best(new))


QUERIES = {f.__name__: f for f in (source_stats, journal_fallback, dedup_best, content_ids, populated_sections, limit_by_doc, skip_existing, split_membership, anchors, annotation_diff, align_full_outer, particle_spans, span_line_overlap, span_conflicts, event_gaps, highlight_merge, round_robin, even_sample, score_bands, union_reinsert, set_ops, unique_lines, latest_per_key, upsert)}

_F11 = ["treatment", "diagnosis", "description", "distribution", "etymology", "materials_examined", "type_designation", "biology", "notes", "key_text", "figure_captions"]
_ID11 = " || ':' || ".join(f"coalesce(trim({c}, ' '), '')" for c in _F11)
_PART = " union all ".join(f"select doc_id, '{n}' as label, unnest(regexp_extract_all(text, '{p}')) as found from documents" for n, p in S.PARTICLES)

SQL = {
    "source_stats": r"""with per as (select ingest['_id'] as doc_id, count(*) n, sum(len(regexp_extract_all(treatment, '(?:sp|gen|comb|nom)\. nov\.'))) acts from treatments where ingest['_id'] is not null group by 1),
g as (select coalesce(journal, 'Unknown') as journal, count(*) as n_articles, coalesce(sum(n), 0)::bigint as n_treatments, coalesce(sum(acts), 0)::bigint as n_acts from articles left join per using (doc_id) group by 1),
b as (select * from g union all select '(all)', sum(n_articles)::bigint, sum(n_treatments)::bigint, sum(n_acts)::bigint from g)
select *, round(coalesce(100.0 * n_treatments / nullif(max(n_treatments) over (), 0), 0.0), 1)::double as percent from b""",
    "journal_fallback": r"""select row_id, coalesce(ingest['journal'], journal, nullif(trim(regexp_extract(source_key, '^\s*([^0-9]+?)\s*[0-9]', 1)), ''), 'Unknown') as journal from treatments left join articles on articles.doc_id = ingest['_id']""",
    "dedup_best": "select _id, row_id from (select _id, row_id, row_number() over (partition by _id order by coalesce(len(source_anchors), 0) desc, line_number asc nulls last, row_id) rn from treatments where _id is not null) where rn = 1",
    "content_ids": f"select row_id, 'taxon_' || sha256({_ID11}) as content_id from treatments",
    "populated_sections": "select row_id, " + " + ".join(f"(coalesce({c}, '') <> '')::int" for c in _F11 if c != "treatment") + " as n_sections from treatments",
    "limit_by_doc": "select section_id, doc_id from sections where doc_id in (select distinct doc_id from sections where doc_id is not null order by doc_id limit 20)",
    "skip_existing": "select distinct doc_id from sections s where not exists (select 1 from treatments t where t.ingest['_id'] = s.doc_id)",
    "split_membership": "select case when doc_id % 5 = 0 then 'test' else 'train' end as part, source, count(*) as n from documents group by 1, 2",
    "anchors": "select a['kind'] as kind, count(*) as n, count(distinct row_id) as n_treatments from (select row_id, unnest(source_anchors) a from treatments) group by 1",
    "annotation_diff": f"""with {_CLEAN}, o as (select doc_id, line_number, label, 1 a from clean where label is not null), n as (select doc_id, line_number, {_PRED} as label, 1 b from clean)
select label, case when a is null then 'added' when b is null then 'deleted' else 'kept' end as state, count(*) as n from o full join n using (doc_id, line_number, label) group by 1, 2""",
    "align_full_outer": f"""with {_CLEAN}, kg as (select doc_id, line_number, line, label, coalesce(label, '') k from clean), kp as (select doc_id, line_number, line, {_PRED} as label, {_PRED} as k from clean),
{_RUNS.replace("keyed", "kg").replace("runs as", "rg as").replace("from runs", "from rg").replace("blocks as", "bg as")}, {_RUNS.replace("keyed", "kp").replace("runs as", "rp as").replace("from runs", "from rp").replace("blocks as", "bp as")},
g as (select doc_id, text, label gold, row_number() over (partition by doc_id, text order by first_line) nth from bg), p as (select doc_id, text, label pred, row_number() over (partition by doc_id, text order by first_line) nth from bp)
select coalesce(gold, '(none)') as gold, coalesce(pred, '(none)') as pred, count(*) as n from g full join p on g.doc_id = p.doc_id and g.text is not distinct from p.text and g.nth = p.nth and g.text is not null group by 1, 2""",
    "particle_spans": f"select label, count(*) as n, count(distinct doc_id) as n_docs, sum(length(found))::bigint as chars from ({_PART}) group by 1",
    "event_gaps": """with e as (select user_id, floor(epoch(ts))::bigint s, floor(epoch(ts))::bigint + 300 e from events), g as (select user_id, greatest(0, s - lag(e) over (partition by user_id order by s, e)) gap, lag(e) over (partition by user_id order by s, e) p from e)
select user_id, count(*) filter (p is not null and gap >= 10) as n_gaps, max(gap) as longest from g group by 1""",
    "highlight_merge": """with e as (select user_id, floor(epoch(ts))::bigint s, floor(epoch(ts))::bigint + 20000 e from events), r as (select *, max(e) over (partition by user_id order by s, e rows between unbounded preceding and 1 preceding) reach from e),
o as (select *, sum(case when reach is null or s > reach then 1 else 0 end) over (partition by user_id order by s, e rows between unbounded preceding and current row) run from r) select user_id, min(s) as start, max(e) as "end", count(*) as n_spans from o group by user_id, run""",
    "round_robin": "select doc_id, source, turn from (select doc_id, coalesce(source, '?') as source, row_number() over (partition by coalesce(source, '?') order by doc_id) as turn from documents) order by turn, source limit 100",
    "even_sample": "select source, doc_id from (select source, doc_id, row_number() over (partition by source order by doc_id) - 1 i, count(*) over (partition by source) n from documents where source is not null) where i in (0, n // 5, 2 * n // 5, 3 * n // 5, 4 * n // 5)",
    "score_bands": "select source, (rn * 7 - 1) // n as band, count(*) as n_docs, min(score) as least, max(score) as most from (select coalesce(source, '?') as source, length(text) score, row_number() over (partition by coalesce(source, '?') order by length(text), doc_id) rn, count(*) over (partition by coalesce(source, '?')) n from documents) group by 1, 2",
    "union_reinsert": r"select section_id, case when not regexp_matches(value, '^[^\w]*(p\. )?[0-9]+[^\w]*$') then length(value) end as length, regexp_matches(value, '^[^\w]*(p\. )?[0-9]+[^\w]*$') as is_marker from sections where value is not null",
    "set_ops": """with t as (select distinct ingest['_id'] x from treatments where ingest['_id'] is not null), s as (select distinct doc_id x from sections where doc_id is not null), y as (select distinct doc_id x from yedda_lines where doc_id is not null)
select 'union' as what, count(*) as n from (select x from t union select x from s) union all select 'both', count(*) from (select x from t intersect select x from s) union all select 'lines_only', count(*) from (select x from y except select x from t)""",
    "unique_lines": "select line, min(line_id) as first_id, count(*) as n from yedda_lines where line is not null group by 1",
    "latest_per_key": "select user_id, event_type, event_id from (select user_id, event_type, event_id, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) rn from events) where rn = 1",
    "upsert": """with t as (select * from taxon where doc_id is not null and line_number is not null), n as (select doc_id, line_number, min(taxon_id) taxon_id from t where taxon_id % 3 = 0 group by 1, 2), o as (select doc_id, line_number, min(taxon_id) taxon_id from t where taxon_id % 3 <> 0 group by 1, 2)
select * from o where not exists (select 1 from n where n.doc_id = o.doc_id and n.line_number = o.line_number) union all select * from n""",
}
