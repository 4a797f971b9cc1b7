"""Queries over lines, labels, blocks and treatments, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sporeline.functions.text import count_of, lines_of, strip, suffixes
from sporeline.operators import labels as L
from sporeline.sources.tables import table


def _lines(spark, d):
    return L.clean_lines(table(spark, d, "yedda_lines"))


def _offsets(batches):
    """Lines with their offsets, in one pass over each text: prefix sums before rows leave their partition, so nothing is shuffled."""
    import itertools

    import pyarrow as pa

    for batch in batches:
        ids, numbers, lines, starts = [], [], [], []
        for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if text is not None:
                own = text.split("\n")
                ids += [i] * len(own)
                numbers += range(len(own))
                lines += own
                starts += list(itertools.accumulate((len(x) + 1 for x in own[:-1]), initial=0))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(lines, pa.string()), pa.array(starts, pa.int64())], names=["doc_id", "line_number", "line", "line_start"])


def _doc_lines(spark, d):
    """Lines of documents with their offsets, numbered from 0."""
    return table(spark, d, "documents").select("doc_id", "text").mapInArrow(_offsets, "doc_id long, line_number int, line string, line_start long")


def line_offsets(spark, d):
    return _doc_lines(spark, d).select("doc_id", "line_number", "line_start", (F.col("line_start") + F.char_length("line")).alias("line_end"))


def line_features(spark, d):
    """Shape of each line and whether the lines around it are blank, taken from the array of lines before it is exploded."""
    docs = table(spark, d, "documents").select("doc_id", lines_of(F.col("text")).alias("l")).withColumn("b", F.transform("l", lambda x: strip(x) == ""))
    n = F.size("l")
    before = F.concat(F.array(F.lit(True)), F.slice("b", F.lit(1), F.greatest(n - 1, F.lit(0))))
    after = F.concat(F.slice("b", F.lit(2), n), F.array(F.lit(True)))
    rows = docs.select("doc_id", F.posexplode(F.arrays_zip(F.col("l").alias("l"), before.alias("p"), after.alias("a"))).alias("line_number", "z"))
    s = F.col("z.l")
    return rows.select(
        "doc_id", "line_number", F.char_length(s).alias("length"), (F.char_length(s) - F.char_length(F.ltrim(s))).alias("indent"), count_of(s, "[A-Z]").alias("capitals"), count_of(s, "[0-9]").alias("digits"),
        s.rlike("[0-9]$").alias("trailing_digit"), (F.char_length(strip(s)) < 30).alias("short"), F.col("z.p").alias("after_blank"), F.col("z.a").alias("before_blank"),
    )


def line_length_stats(spark, d):
    docs = table(spark, d, "documents")
    n = F.transform(F.filter(lines_of(F.col("text")), lambda x: strip(x) != ""), lambda x: F.char_length(x))
    return docs.select("doc_id", F.coalesce(F.array_max(n), F.lit(0)).alias("longest"), F.round(F.coalesce(F.try_divide(F.aggregate(n, F.lit(0), lambda a, x: a + x), F.size(n)), F.lit(0.0)), 6).alias("mean_length"))


def suffix_tokens(spark, d):
    docs = table(spark, d, "documents")
    one = docs.select(F.explode(suffixes(F.filter(F.split(F.lower("text"), " ", -1), lambda w: w.rlike("^[a-z]+$")))).alias("suffix"))
    return one.groupBy("suffix").agg(F.count("*").alias("n"))


def block_coalesce(spark, d):
    return L.coalesce_blocks(_lines(spark, d))


def block_coalesce_blank(spark, d):
    return L.coalesce_blocks(_lines(spark, d), blank_breaks=True)


def yedda_roundtrip(spark, d):
    clean = _lines(spark, d).filter("label is not null and trim(coalesce(line, '')) <> '' and not line rlike '[#\\\\[\\\\]*]'").withColumn("line", strip(F.col("line")))
    return L.from_yedda(L.to_yedda(L.coalesce_blocks(clean)))


def treatments_group(spark, d):
    """Treatments from paragraphs: runs of one label between blank lines, page lines left out."""
    blocks = L.coalesce_blocks(_lines(spark, d), blank_breaks=True).withColumnsRenamed({"first_line": "line_number", "text": "line"})
    return L.treatments(blocks.filter(~F.col("line").rlike(r"^\s*[0-9]*\s*$")))


def label_stats(spark, d):
    return L.label_frequencies(_lines(spark, d))


def class_weights(spark, d):
    return L.class_weights(_lines(spark, d))


def _pairs(spark, d):
    return _lines(spark, d).filter("label is not null").select(F.col("label").alias("gold"), L.prediction(F.col("line")).alias("pred"))


def prf_per_class(spark, d):
    return L.per_class(_pairs(spark, d))


def confusion(spark, d):
    names = ["nomenclature", "materials-examined", "figure-caption", "description", "misc-exposition"]
    return _pairs(spark, d).groupBy("gold").pivot("pred", names).count().na.fill(0).select("gold", *[F.col(n).alias(n.replace("-", "_")) for n in names])


def metadata_fields(spark, d):
    y = table(spark, d, "yedda_lines")
    got = y.select(F.get_json_object("metadata", "$.annotator").alias("annotator"), F.get_json_object("metadata", "$.attachment").alias("attachment"))
    return got.groupBy("annotator", "attachment").agg(F.count("*").alias("n"))


def tag_inventory(spark, d):
    b = L.coalesce_blocks(_lines(spark, d))
    return b.groupBy("doc_id").agg(F.count_distinct("label").alias("n_tags"), F.count("*").alias("n_blocks")).filter("n_tags >= 3")


def sections_carry(spark, d):
    """Section name of each paragraph: that of the last heading before it in the article, and the page likewise."""
    s = table(spark, d, "sections").filter("doc_id is not null and paragraph_number is not null and value is not null")
    one = s.groupBy("doc_id", "paragraph_number").agg(F.min_by(F.struct("section_id", "value", "pdf_page"), "section_id").alias("r")).select("doc_id", "paragraph_number", "r.*")
    heading = F.when(F.lower("value").isin(*HEADINGS), F.lower("value"))
    w = Window.partitionBy("doc_id").orderBy("paragraph_number").rowsBetween(Window.unboundedPreceding, 0)
    return one.select("section_id", "doc_id", "paragraph_number", F.last(heading, ignorenulls=True).over(w).alias("section"), F.last("pdf_page", ignorenulls=True).over(w).alias("page"))


#: Headings that name a section.
HEADINGS = ["taxonomy", "results", "references", "key to species", "materials and methods", "description", "discussion", "distribution and ecology", "etymology", "introduction", "abstract"]


def page_regions(spark, d):
    """Paragraph ranges of the pages of an article, up to the start of the next page."""
    s = table(spark, d, "sections").filter("doc_id is not null and pdf_page is not null and paragraph_number is not null")
    first = s.groupBy("doc_id", "pdf_page").agg(F.min("paragraph_number").alias("first_paragraph"), F.max("paragraph_number").alias("last_seen"))
    w = Window.partitionBy("doc_id").orderBy("first_paragraph", "pdf_page")
    return first.select("doc_id", "pdf_page", "first_paragraph", F.coalesce(F.lead("first_paragraph").over(w) - 1, F.col("last_seen")).alias("last_paragraph"))


def page_gap_histogram(spark, d):
    """Steps between the printed numbers of neighbouring pages, the most common one of each article and its share."""
    s = table(spark, d, "sections").filter("doc_id is not null and pdf_page is not null and empirical_page_number is not null")
    pages = s.groupBy("doc_id", "pdf_page").agg(F.min("empirical_page_number").alias("printed"))
    w = Window.partitionBy("doc_id").orderBy("pdf_page")
    gaps = pages.withColumn("gap", F.lead("printed").over(w) - F.col("printed")).filter("gap is not null").groupBy("doc_id", "gap").agg(F.count("*").alias("n"))
    best = gaps.groupBy("doc_id").agg(F.max_by("gap", F.struct("n", -F.col("gap"))).alias("gap"), F.max("n").alias("n"), F.sum("n").alias("n_all"))
    return best.select("doc_id", "gap", "n", F.round(F.col("n") / F.col("n_all"), 6).alias("quality"))


def figure_captions(spark, d):
    s = table(spark, d, "sections").filter(F.col("value").rlike(r"^(Fig|Abb|Table|Tabelle)\.? ?[0-9]+"))
    return s.select("section_id", F.regexp_extract("value", r"^([A-Za-z]+)", 1).alias("kind"), F.regexp_extract("value", r"^[A-Za-z]+\.? ?([0-9]+)", 1).cast("int").alias("number"))


def sections_per_page(spark, d):
    s = table(spark, d, "sections")
    return s.groupBy("pdf_page").agg(F.count("*").alias("n"), F.round(F.avg(F.char_length("value")), 6).alias("mean_length"))


def sql_contains(spark, d):
    """SQL text over a temporary view."""
    table(spark, d, "sections").createOrReplaceTempView("sporeline_sections")
    return spark.sql("select section_id, pdf_page from sporeline_sections where lower(value) like '%hyaline in koh%'")


QUERIES = {f.__name__: f for f in (line_offsets, line_features, line_length_stats, suffix_tokens, block_coalesce, block_coalesce_blank, yedda_roundtrip, treatments_group, label_stats, class_weights, prf_per_class, confusion, metadata_fields, tag_inventory, sections_carry, page_regions, page_gap_histogram, figure_captions, sections_per_page, sql_contains)}

_CLEAN = r"""
clean as (select doc_id, line_number, nullif(trim(regexp_replace(lower(trim(r.label)), '[^a-z]+', '-', 'g'), '-'), '') as label, r.line as line
          from (select doc_id, line_number, arg_min({label: label, line: line}, line_id) r from yedda_lines where doc_id is not null and line_number is not null group by 1, 2))"""
_SPLIT = r"""
l as (select doc_id, unnest(s) as line, generate_subscripts(s, 1) - 1 as line_number from (select doc_id, string_split(text, chr(10)) s from documents)),
o as (select *, coalesce(sum(length(line) + 1) over (partition by doc_id order by line_number rows between unbounded preceding and 1 preceding), 0) as line_start from l)"""
_RUNS = r"""
runs as (select *, sum(st) over (partition by doc_id order by line_number) as island from (select *, case when lag(k) over w is null or lag(k) over w <> k then 1 else 0 end st from keyed window w as (partition by doc_id order by line_number))),
blocks as (select doc_id, label, min(line_number) as first_line, count(*) as n_lines, string_agg(line, chr(10) order by line_number) as text from runs where k <> '' and k <> chr(1) group by doc_id, island, label)"""
_PRED = r"""case when coalesce(trim(line), '') = '' then 'misc-exposition' when regexp_matches(line, '(sp|comb|nom|gen)\. nov\.|\((1[789]|20)[0-9]{2}\)$') then 'nomenclature'
 when regexp_matches(line, '(Holotype|leg\.|coll\.|det\.)') then 'materials-examined' when regexp_matches(line, '^(Fig|Table)\b') then 'figure-caption' when regexp_matches(line, 'µm|mm|walled|spored') then 'description' else 'misc-exposition' end"""
_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"

SQL = {
    "line_offsets": f"with {_SPLIT} select doc_id, line_number, line_start, line_start + length(line) as line_end from o",
    "line_features": f"""with {_SPLIT}, b as (select *, trim(line, {_BLANKS}) = '' as blank from o)
select doc_id, line_number, length(line) as length, length(line) - length(ltrim(line, ' ')) as indent, len(regexp_extract_all(line, '[A-Z]')) as capitals, len(regexp_extract_all(line, '[0-9]')) as digits,
regexp_matches(line, '[0-9]$') as trailing_digit, length(trim(line, {_BLANKS})) < 30 as short, coalesce(lag(blank) over w, true) as after_blank, coalesce(lead(blank) over w, true) as before_blank
from b window w as (partition by doc_id order by line_number)""",
    "line_length_stats": f"""with {_SPLIT} select d.doc_id, coalesce(max(length(line)), 0) as longest, round(coalesce(avg(length(line)), 0.0), 6) as mean_length
from documents d left join (select * from l where trim(line, {_BLANKS}) <> '') x using (doc_id) group by d.doc_id""",
    "suffix_tokens": r"""select suffix, count(*) as n from (select unnest([right(w, 2), right(w, 3), right(w, 4)]) as suffix from (select unnest(string_split(lower(text), ' ')) w from documents) where regexp_full_match(w, '[a-z]+')) group by 1""",
    "block_coalesce": f"with {_CLEAN}, keyed as (select *, coalesce(label, '') k from clean), {_RUNS} select * from blocks",
    "block_coalesce_blank": f"with {_CLEAN}, keyed as (select *, case when trim(coalesce(line, '')) = '' then chr(1) else coalesce(label, '') end k from clean), {_RUNS} select * from blocks",
    "yedda_roundtrip": f"""with {_CLEAN}, keyed as (select doc_id, line_number, label, trim(line, {_BLANKS}) line, label k from clean where label is not null and trim(coalesce(line, '')) <> '' and not regexp_matches(line, '[#\\[\\]*]')), {_RUNS},
n as (select *, row_number() over (partition by doc_id order by first_line) - 1 as block_no from blocks), s as (select doc_id, block_no, label, string_split(text, chr(10)) s from n)
select doc_id, block_no, label, generate_subscripts(s, 1) - 1 as line_in_block, unnest(s) as line from s""",
    "treatments_group": f"""with {_CLEAN}, keyed as (select *, case when trim(coalesce(line, '')) = '' then chr(1) else coalesce(label, '') end k from clean), {_RUNS},
paragraphs as (select doc_id, first_line as line_number, label, text as line from blocks where not regexp_matches(text, '^\\s*[0-9]*\\s*$')), seen as (select *, case when label = 'nomenclature' then 'N' when label in ({", ".join(f"'{x}'" for x in L.SECTION_LABELS)}) then 'S' when label = 'misc-exposition' then 'M' end kind from paragraphs),
c as (select *, sum(case when kind = 'M' then 1 else 0 end) over (partition by doc_id order by line_number) m from seen where kind is not null),
g as (select *, case when lag(kind) over w is null or m - lag(m) over w > 4 or (kind = 'N' and lag(kind) over w = 'S') then 1 else 0 end st from c where kind <> 'M' window w as (partition by doc_id order by line_number)),
t as (select *, sum(st) over (partition by doc_id order by line_number) treatment_no from g),
a as (select doc_id, treatment_no, min(line_number) as first_line, count(*) filter (kind = 'S') as n_section_lines, coalesce(string_agg(coalesce(line, ''), chr(10) order by line_number) filter (label = 'nomenclature'), '') names,
coalesce(string_agg(coalesce(line, ''), chr(10) order by line_number) filter (label = 'description'), '') as description, coalesce(string_agg(coalesce(line, ''), chr(10) order by line_number) filter (label = 'materials-examined'), '') as materials_examined from t group by 1, 2)
select doc_id, treatment_no, first_line, n_section_lines, description, materials_examined, case when names = '' then 'Nomen ignotum' else names end as treatment from a where n_section_lines > 0""",
    "label_stats": f"with {_CLEAN} select label, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 2) as percentage from clean where label is not null group by label",
    "class_weights": f"""with {_CLEAN}, n as (select label, count(*) n from clean where label is not null group by 1), i as (select *, sum(n) over () / (n * 1.0::double) as inv, sum(n) over () / (count(*) over () * (n * 1.0::double)) as bal from n)
select label, n, round(inv, 6) as inverse, round(bal, 6) as balanced, round(case when max(inv) over () > min(inv) over () then (inv - min(inv) over ()) / (max(inv) over () - min(inv) over ()) else 1.0 end, 6) as scaled from i""",
    "prf_per_class": f"""with {_CLEAN}, p as (select label as gold, {_PRED} as pred from clean where label is not null), r as (select gold as label, 1 as s, 0 as q, case when gold = pred then 1 else 0 end as t from p union all select pred, 0, 1, 0 from p),
a as (select label, sum(s)::bigint as support, sum(q)::bigint as predicted, sum(t)::bigint as tp from r group by 1), b as (select *, coalesce(tp / nullif(predicted, 0), 0.0) p, coalesce(tp / nullif(support, 0), 0.0) r from a)
select label, support, predicted, tp, round(p, 6) as precision, round(r, 6) as recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0.0), 6) as f1 from b""",
    "confusion": f"""with {_CLEAN}, p as (select label as gold, {_PRED} as pred from clean where label is not null)
select gold, count(*) filter (pred = 'nomenclature') as nomenclature, count(*) filter (pred = 'materials-examined') as materials_examined, count(*) filter (pred = 'figure-caption') as figure_caption, count(*) filter (pred = 'description') as description, count(*) filter (pred = 'misc-exposition') as misc_exposition from p group by 1""",
    "metadata_fields": "select json_extract_string(metadata, '$.annotator') as annotator, json_extract_string(metadata, '$.attachment') as attachment, count(*) as n from yedda_lines group by 1, 2",
    "tag_inventory": f"with {_CLEAN}, keyed as (select *, coalesce(label, '') k from clean), {_RUNS} select doc_id, count(distinct label) as n_tags, count(*) as n_blocks from blocks group by 1 having count(distinct label) >= 3",
    "sections_carry": f"""with one as (select doc_id, paragraph_number, r.* from (select doc_id, paragraph_number, arg_min({{section_id: section_id, value: value, pdf_page: pdf_page}}, section_id) r from sections where doc_id is not null and paragraph_number is not null and value is not null group by 1, 2))
select section_id, doc_id, paragraph_number, last_value(case when lower(value) in ({", ".join(f"'{h}'" for h in HEADINGS)}) then lower(value) end ignore nulls) over w as section, last_value(pdf_page ignore nulls) over w as page from one window w as (partition by doc_id order by paragraph_number rows between unbounded preceding and current row)""",
    "page_regions": """with f as (select doc_id, pdf_page, min(paragraph_number) first_paragraph, max(paragraph_number) last_seen from sections where doc_id is not null and pdf_page is not null and paragraph_number is not null group by 1, 2)
select doc_id, pdf_page, first_paragraph, coalesce(lead(first_paragraph) over (partition by doc_id order by first_paragraph, pdf_page) - 1, last_seen) as last_paragraph from f""",
    "page_gap_histogram": """with p as (select doc_id, pdf_page, min(empirical_page_number) printed from sections where doc_id is not null and pdf_page is not null and empirical_page_number is not null group by 1, 2),
g as (select doc_id, lead(printed) over (partition by doc_id order by pdf_page) - printed as gap from p), n as (select doc_id, gap, count(*) n from g where gap is not null group by 1, 2)
select doc_id, gap, n, round(n / total, 6) as quality from (select *, sum(n) over (partition by doc_id) total, row_number() over (partition by doc_id order by n desc, gap) rn from n) where rn = 1""",
    "figure_captions": r"select section_id, regexp_extract(value, '^([A-Za-z]+)', 1) as kind, regexp_extract(value, '^[A-Za-z]+\.? ?([0-9]+)', 1)::int as number from sections where regexp_matches(value, '^(Fig|Abb|Table|Tabelle)\.? ?[0-9]+')",
    "sections_per_page": "select pdf_page, count(*) as n, round(avg(length(value)), 6) as mean_length from sections group by 1",
    "sql_contains": "select section_id, pdf_page from sections where lower(value) like '%hyaline in koh%'",
}
