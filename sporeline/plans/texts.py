"""Queries that load, project, test and rewrite texts and records, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from sporeline.functions.text import count_of, lines_of, strip
from sporeline.sources.tables import table

#: A page marker as it stands in texts, and abbreviations of taxonomy.
MARKER = r"^--- PDF Page ([0-9]+)(?: Label ([^ ]+))? ---$"
ABBREVIATIONS = ["sp.", "spp.", "var.", "subsp.", "gen.", "comb.", "nov.", "f."]
#: Headings of sections in the order they are looked for, (kind, pattern).
HEADERS = [("diagnosis", "^(diagnosis|differential diagnosis)"), ("description", "^(description|morphology)"), ("etymology", "^etymology"), ("distribution", "^(distribution|habitat|ecology)"), ("materials", "^(materials? examined|specimens? examined|holotype)"), ("taxonomy", "^taxonomy"), ("discussion", "^(discussion|notes|remarks)"), ("key", "^key to"), ("references", "^(references|literature)")]
WATCHED = ["Spore print", "Basidiospores", "Pileus", "Lamellae", "Conidia", "Hyphae"]
_T = lambda spark, d: table(spark, d, "treatments")
_S = lambda spark, d: table(spark, d, "sections")
_D = lambda spark, d: table(spark, d, "documents")
_A = lambda spark, d: table(spark, d, "articles")
_Y = lambda spark, d: table(spark, d, "yedda_lines")


def attachment_lines(spark, d):
    """Lines of attachments, numbered within each paragraph, with a flag for page lines."""
    rows = _S(spark, d).filter("value is not null").select("section_id", "attachment_name", F.posexplode(lines_of(F.col("value"))).alias("line_no", "line"))
    return rows.groupBy("attachment_name", F.col("line").rlike("^[0-9]+$").alias("is_page")).agg(F.count("*").alias("n"), F.sum(F.char_length("line")).alias("chars"), F.max("line_no").alias("last"))


def frame_lines(spark, d):
    """Texts of a frame as lines: columns that are missing get their defaults, blank lines are dropped, the rest numbered."""
    rows = _D(spark, d).select("doc_id", F.coalesce("title", F.lit("")).alias("title"), F.lit("article.txt").alias("attachment_name"), F.filter(lines_of(F.col("text")), lambda x: strip(x) != "").alias("l"))
    return rows.select("doc_id", "title", "attachment_name", F.posexplode("l").alias("line_number", "line")).select("doc_id", "attachment_name", "line_number", F.char_length("line").alias("length"), (F.char_length("title") > 0).alias("titled"))


def id_glob(spark, d):
    """Ids by glob: all, a prefix, one in full; how many each pattern gives."""
    a = _A(spark, d).select("doc_id")
    first = a.agg(F.min("doc_id").alias("m"))
    x = a.join(F.broadcast(first), F.lit(True))
    pats = F.array(F.struct(F.lit("*").alias("pattern"), F.lit(True).alias("hit")), F.struct(F.lit("a*").alias("pattern"), F.col("doc_id").startswith("a").alias("hit")), F.struct(F.lit("exact").alias("pattern"), (F.col("doc_id") == F.col("m")).alias("hit")))
    return x.select(F.explode(pats).alias("p")).groupBy("p.pattern").agg(F.count_if("p.hit").alias("n"))


def attachment_priority(spark, d):
    """One attachment of each article: a PDF before a text before any other, then by name."""
    t = _T(spark, d).select(F.col("ingest")["_id"].alias("doc_id"), "attachment_name").filter("doc_id is not null and attachment_name is not null")
    rank = F.when(F.col("attachment_name").endswith(".pdf.ann"), 0).when(F.col("attachment_name").endswith(".txt.ann"), 1).otherwise(2)
    return t.groupBy("doc_id").agg(F.min_by("attachment_name", F.struct(rank, "attachment_name")).alias("attachment_name"), F.count_distinct("attachment_name").alias("n"))


def treatments_by_pattern(spark, d):
    """Treatments whose id begins with a letter pattern, with the columns a later stage needs."""
    return _T(spark, d).filter(F.col("_id").rlike("^[a-c]")).select("row_id", "_id", F.coalesce("treatment", F.lit("")).alias("treatment"))


def equality_lookup(spark, d):
    """Selector look-up: equality on two fields, in order, limited."""
    return _A(spark, d).filter("journal = 'Mycota Nova' and doc_id is not null").orderBy("doc_id").limit(25).select("doc_id", "title")


def ingest_projection(spark, d):
    """Four keys of the origin of a treatment in a stable shape, and one of them as a column of its own."""
    keys = ["_id", "journal", "url", "doi"]
    return _T(spark, d).select("row_id", F.to_json(F.struct(*[F.coalesce(F.col("ingest")[k], F.lit("")).alias(k) for k in keys])).alias("ingest"), F.col("ingest")["_id"].alias("doc_id"))


def stripped_annotations(spark, d):
    """Annotated lines without their marks, with the numbers of whole and of orphan marks."""
    y = _Y(spark, d).filter("line is not null").select("line_id", F.when(F.col("line_id") % 7 == 0, F.concat(F.lit("[@"), "line")).otherwise(F.concat(F.lit("[@"), "line", F.lit("#"), F.coalesce("label", F.lit("?")), F.lit("*]"))).alias("t"))
    whole = F.regexp_count("t", F.lit(r"\[@[^#]*#[^*\]]+\*\]"))
    bare = F.regexp_replace(F.regexp_replace("t", r"\[@\s*([^#]*?)\s*#[^*\]]+\*\]", "$1"), r"\[@|#[^*\]]+\*\]", "")
    return y.select("line_id", whole.alias("n_whole"), (F.regexp_count("t", F.lit(r"\[@")) - whole).alias("n_orphan"), F.md5(bare).alias("bare"))


def model_input(spark, d):
    """Text an encoder gets: description, blank line, diagnosis, empty ones left out."""
    full = lambda c: F.nullif(F.col(c), F.lit(""))
    return _T(spark, d).select("row_id", F.md5(F.concat_ws("\n\n", full("description"), full("diagnosis"))).alias("input"), F.char_length(F.concat_ws("\n\n", full("description"), full("diagnosis"))).alias("length"))


def clean_values(spark, d):
    """Values without NaN, and missing prices as zero."""
    e = table(spark, d, "events").select("event_id", F.when(F.col("value") > 90, F.lit(float("nan"))).otherwise(F.col("value")).alias("v"))
    return e.select("event_id", F.coalesce(F.when(F.isnan("v"), F.lit(None)).otherwise(F.col("v")), F.lit(0.0)).alias("value"))


def renamed_fields(spark, d):
    """Old names of fields replaced by new ones; spans as structs of typed numbers."""
    t = _T(spark, d).withColumnsRenamed({"treatment": "name", "_id": "taxon_id"}).select("row_id", "taxon_id", "name", F.explode("description_spans").alias("s"))
    n = lambda k: F.expr(f"try_cast(s['{k}'] as int)").alias(k)
    return t.select("row_id", "taxon_id", F.md5("name").alias("name"), n("start_line"), n("start_char"), n("end_char"), n("empirical_page"))


def merged_defaults(spark, d):
    """Settings of journals over common defaults."""
    j = _A(spark, d).filter("journal is not null").groupBy("journal").agg(F.count("*").alias("n"))
    own = F.when(F.col("n") > 20, F.create_map(F.lit("batch"), F.lit("100"), F.lit("mode"), F.lit("bulk"))).otherwise(F.create_map(F.lit("batch"), F.lit("10")))
    both = F.map_zip_with(F.create_map(F.lit("batch"), F.lit("50"), F.lit("mode"), F.lit("single"), F.lit("retries"), F.lit("3")), own, lambda k, a, b: F.coalesce(b, a))
    return j.select("journal", both["batch"].alias("batch"), both["mode"].alias("mode"), both["retries"].alias("retries"))


def page_markers(spark, d):
    """Page markers written into texts and read back: number and label."""
    p = _S(spark, d).filter("pdf_page is not null").select("pdf_page", "pdf_label").distinct()
    text = F.concat(F.lit("--- PDF Page "), F.col("pdf_page").cast("string"), F.when(F.col("pdf_label").isNotNull() & ~F.contains("pdf_label", F.lit(" ")), F.concat(F.lit(" Label "), "pdf_label")).otherwise(F.lit("")), F.lit(" ---"))
    m = p.select(text.alias("t")).distinct()
    return m.filter(F.col("t").rlike(MARKER)).select(F.regexp_extract("t", MARKER, 1).cast("int").alias("page"), F.nullif(F.regexp_extract("t", MARKER, 2), F.lit("")).alias("label"))


def paragraph_kinds(spark, d):
    """What kind of paragraph a value is by its first word and its lines."""
    v = F.col("value")
    first = F.lower(F.regexp_extract(v, r"^\s*([^\s]+)", 1))
    long = F.forall(F.filter(lines_of(v), lambda x: strip(x) != ""), lambda x: F.char_length(x) >= 45)
    kind = (
        F.when(strip(v) == "", "blank").when(first.isin("fig.", "figs.", "figure", "figures", "abb.", "plate"), "figure").when(first.isin("table", "tabelle", "tab.", "tableau"), "table")
        .when(first == "key", "key").when(v.rlike(r"^\W*(p\. )?[0-9]+\W*$"), "page").when(F.char_length(v) < 45, "short").otherwise("text")
    )
    return _S(spark, d).filter("value is not null").select("section_id", kind.alias("kind"), long.alias("all_long"))


def without_interstitials(spark, d):
    """Paragraphs that are no figure, table, blank or page line, by article."""
    k = paragraph_kinds(spark, d).filter(~F.col("kind").isin("blank", "figure", "table", "page"))
    return _S(spark, d).select("section_id", "doc_id").join(k, "section_id").groupBy("doc_id").agg(F.count("*").alias("n"), F.count_if("all_long").alias("n_long"))


def nomenclature_paragraphs(spark, d):
    """Lines that hold a Latin name with an act or a year after it."""
    return _Y(spark, d).filter(F.col("line").rlike(r"[A-Z][a-z]+(us|um|a|is|ea|ia) [a-z]{3,}.*((sp|gen|comb|nom)\. nov\.|\([12][0-9]{3}\))")).select("line_id")


def sentence_ends(spark, d):
    """Whether a paragraph ends a sentence: a point that is none of an initial, a number or an abbreviation."""
    v = F.rtrim("value")
    ends = v.rlike(r"[.!?]$") & ~v.rlike(r"(^|[^A-Za-z])[A-Z]\.$") & ~v.rlike(r"(: n\.|p\. n\.)$") & ~v.rlike(r"(^| )(cf|Fig|al|ca|Abb|vgl|No|Nr|var|subsp)\.$")
    return _S(spark, d).filter("value is not null").select("section_id", ends.alias("ends"))


def likely_headers(spark, d):
    """Short lines in title case of at most ten words: kind of the heading in a fixed order of kinds, or other."""
    v = strip(F.col("value"))
    words = F.filter(F.split(v, r"\s+"), lambda w: w != "")
    upper = F.size(F.filter(words, lambda w: w.rlike("^[A-Z]")))
    low = F.lower(v)
    kind = F.coalesce(*[F.when(low.rlike(p), k) for k, p in HEADERS], F.lit("other"))
    return _S(spark, d).filter("value is not null").select("section_id", v.alias("v"), words.alias("w"), upper.alias("u"), kind.alias("kind")).filter((F.size("w") <= 10) & (F.size("w") > 0) & (F.col("u") >= 0.7 * F.size("w")) & ~F.col("v").rlike(r"[.,;]$")).select("section_id", "kind", F.size("w").alias("n_words"))


def abbreviation_filter(spark, d):
    """Articles with lines that hold an abbreviation of taxonomy, and how many."""
    one = "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)
    return _Y(spark, d).filter(F.col("line").rlike(rf"(^|[^A-Za-z])({one})")).groupBy("doc_id").agg(F.count("*").alias("n"))


def repair_scans(spark, d):
    """Records in need of repair: without journal, without spans, without text, with malformed marks."""
    t = _T(spark, d)
    what = F.array(
        F.when(F.col("ingest").isNull() | F.col("ingest")["journal"].isNull(), "no_journal"), F.when(F.coalesce(F.size("description_spans"), F.lit(-1)) < 1, "no_spans"),
        F.when(F.coalesce("description", F.lit("")) == "", "bare"), F.when(F.coalesce("attachment_name", F.lit("")) == "", "no_attachment"),
    )
    return t.select("row_id", F.explode(F.array_compact(what)).alias("what")).groupBy("what").agg(F.count("*").alias("n"), F.min("row_id").alias("first"))


def orphans(spark, d):
    """Rows of tables whose article is not there."""
    a = _A(spark, d).select("doc_id")
    of = lambda df, n: df.filter("doc_id is not null").join(a, "doc_id", "left_anti").agg(F.lit(n).alias("what"), F.count("*").alias("n"))
    return of(_S(spark, d), "sections").union(of(_Y(spark, d), "lines")).union(of(table(spark, d, "taxon"), "taxon")).union(of(_T(spark, d).select(F.col("ingest")["_id"].alias("doc_id")), "treatments"))


def visibility(spark, d):
    """Records open at a moment: published before it and not embargoed for half a year after loading."""
    a = _A(spark, d)
    now = F.lit("1981-07-19").cast("timestamp_ntz")
    open_ = F.coalesce(F.col("published_at") <= now, F.lit(False))
    return a.groupBy(open_.alias("open")).agg(F.count("*").alias("n"), F.count_if(F.col("journal").isNull()).alias("n_hidden"))


def dehyphenated(spark, d):
    """Values with words joined over line ends, by length and number of blank-line parts."""
    j = F.regexp_replace("value", "-\n", "")
    return _S(spark, d).filter("value is not null").select("section_id", F.char_length(j).alias("length"), F.size(F.split(j, "\n")).alias("n_lines"), F.md5(j).alias("hash"))


def citation_tails(spark, d):
    """Volume, issue and series of a source key."""
    k = F.lower("source_key")
    n = lambda p: F.nullif(F.regexp_extract(k, p, 1), F.lit("")).cast("int")
    return _A(spark, d).filter("source_key is not null").select("doc_id", n(r"([0-9]+)\([0-9]+\)").alias("volume"), n(r"[0-9]+\(([0-9]+)\)").alias("issue"), n(r"ser\. ([0-9]+)").alias("series"))


def mended_blocks(spark, d):
    """Malformed annotation of lines mended: doubled openings, blanks in closings; page lines taken out."""
    t = F.when(F.col("line_id") % 5 == 0, F.concat(F.lit("[@[@"), "line", F.lit("# "), "label", F.lit(" *]"))).otherwise(F.concat(F.lit("[@"), "line", F.lit("#"), "label", F.lit("*]")))
    fixed = F.regexp_replace(F.regexp_replace(t, r"^(\[@)+", "[@"), r"# *([^#*]*?) *\*\]$", "#$1*]")
    return _Y(spark, d).filter("line is not null and label is not null").select("line_id", F.md5(fixed).alias("hash"), (fixed != t).alias("changed"))


def header_counters(spark, d):
    """Headers, acts and key couplets that a record holds."""
    t = F.concat_ws("\n", "treatment", "description", "key_text", "notes")
    return _T(spark, d).select("row_id", count_of(t, "(?i)diagnosis").alias("n_diagnosis"), count_of(t, "(?i)description").alias("n_description"), count_of(t, r"sp\. nov\.").alias("n_species"), count_of(t, r"(?m)^[0-9]+[a-z']?[.)] ").alias("n_couplets"))


def latin_ratio(spark, d):
    """Share of words of a description with a Latin ending, of those of three letters or more."""
    w = F.regexp_extract_all(F.lower(F.coalesce("description", F.lit(""))), F.lit("([a-z]{3,})"), F.lit(1))
    n = F.size(F.filter(w, lambda x: x.rlike("(us|um|is|ae|orum|arum|ibus|atis)$")))
    return _T(spark, d).select("row_id", F.round(F.coalesce(F.try_divide(n, F.size(w)), F.lit(0.0)), 6).alias("ratio"))


def latin_blocks(spark, d):
    """Runs of Latin paragraphs of a description, and whether one stands between others."""
    p = F.filter(F.split("description", "\n\n"), lambda x: strip(x) != "")
    latin = F.transform(p, lambda x: x.rlike(r"(?i)(us|um|is|ae|orum|arum|ibus)[ ,.;].*(us|um|is|ae|orum|arum|ibus)[ ,.;]") & ~x.rlike(r"(?i) (the|with|and|of|der|die|und|les|des|el|los) "))
    marks = F.array_join(F.transform(latin, lambda b: F.when(b, "L").otherwise("E")), "")
    return _T(spark, d).filter("description is not null").select("row_id", marks.alias("m")).select("row_id", F.regexp_count("m", F.lit("L+")).alias("n_blocks"), F.col("m").rlike("EL+E").alias("between"))


def watched_headers(spark, d):
    """How many watched headers stand twice or more in a description."""
    x = F.coalesce("description", F.lit(""))
    return _T(spark, d).select("row_id", sum((F.when(count_of(x, w) >= 2, 1).otherwise(0) for w in WATCHED), F.lit(0)).alias("n"))


def repeated_openings(spark, d):
    """First words that several sentences of a description begin with, per language."""
    s = _T(spark, d).filter("description is not null").select("row_id", "description_lang", F.explode(F.regexp_extract_all("description", F.lit(r"(?:^|[.] )([A-Z][a-z]+)"), F.lit(1))).alias("w"))
    n = s.groupBy("row_id", "description_lang", "w").agg(F.count("*").alias("n")).filter("n >= 2")
    return n.groupBy("row_id", "description_lang").agg(F.count("*").alias("n_words"), F.max("n").alias("most"))


def normal_space(spark, d):
    """Blanks reduced, byte order marks off, letters in their compatible form."""
    x = F.btrim(F.regexp_replace(F.regexp_replace("text", "﻿", ""), r"[ \t\n\r\f]+", " "))
    return _D(spark, d).select("doc_id", F.char_length(x).alias("length"), F.md5(x).alias("hash"))


def relabelled_headers(spark, d):
    """Labels by the first word of a line where it names a section; holotypes split off from materials."""
    low = F.lower(F.coalesce("line", F.lit("")))
    new = F.when(low.rlike("^holotype"), "Type-designation").when(low.rlike("^(etymology|etym)"), "Etymology").when(low.rlike("^(distribution|habitat)"), "Distribution").otherwise(F.col("label"))
    return _Y(spark, d).groupBy("label", new.alias("new_label")).agg(F.count("*").alias("n"))


def cross_entropy(spark, d):
    """Loss of a probability: minus its logarithm, held at 1e-10; none for what is missing or no probability."""
    p = F.when(F.col("value").between(0, 100), F.col("value") / 100)
    e = table(spark, d, "events").select("event_type", F.coalesce(F.when(p.isNotNull(), -F.ln(F.greatest(p, F.lit(1e-10)))), F.lit(0.0)).alias("loss"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("value") / 50)).alias("confidence"))
    return e.groupBy("event_type").agg(F.round(F.avg("loss"), 5).alias("loss"), F.round(F.avg("confidence"), 5).alias("confidence"))


def rescaled(spark, d):
    """Lengths of the texts of a source between its shortest and longest."""
    x = F.char_length("text")
    docs = _D(spark, d).select("doc_id", "source", x.alias("n"))
    ends = docs.groupBy(F.col("source").alias("of")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    met = docs.join(ends, F.col("source").eqNullSafe(F.col("of")))
    return met.select("doc_id", F.round(F.coalesce(F.try_divide(F.col("n") - F.col("lo"), F.col("hi") - F.col("lo")), F.lit(1.0)), 6).alias("scaled"))


def durations(spark, d):
    """Time between the first and last event of a user as hours, minutes and seconds."""
    n = F.expr("timestampdiff(SECOND, min(ts), max(ts))")
    e = table(spark, d, "events").filter("ts is not null").groupBy("user_id").agg(n.alias("s"))
    return e.select("user_id", F.format_string("%dh %02dm %02ds", F.floor(F.col("s") / 3600), F.floor(F.col("s") % 3600 / 60), F.col("s") % 60).alias("duration"), (F.col("s") >= 86400).alias("due"))


QUERIES = {f.__name__: f for f in (attachment_lines, frame_lines, id_glob, attachment_priority, treatments_by_pattern, equality_lookup, ingest_projection, stripped_annotations, model_input, clean_values, renamed_fields, merged_defaults, page_markers, paragraph_kinds, without_interstitials, nomenclature_paragraphs, sentence_ends, likely_headers, abbreviation_filter, repair_scans, orphans, visibility, dehyphenated, citation_tails, mended_blocks, header_counters, latin_ratio, latin_blocks, watched_headers, repeated_openings, normal_space, relabelled_headers, cross_entropy, rescaled, durations)}

_BL = "' ' || chr(9) || chr(10) || chr(13) || chr(12)"
_FULL = "concat_ws(chr(10) || chr(10), nullif(description, ''), nullif(diagnosis, ''))"
_MARKED = "case when line_id % 7 = 0 then '[@' || line else '[@' || line || '#' || coalesce(label, '?') || '*]' end"
_BLOCK = "case when line_id % 5 = 0 then '[@[@' || line || '# ' || label || ' *]' else '[@' || line || '#' || label || '*]' end"
_KIND = rf"""case when trim(value, {_BL}) = '' then 'blank' when f in ('fig.', 'figs.', 'figure', 'figures', 'abb.', 'plate') then 'figure' when f in ('table', 'tabelle', 'tab.', 'tableau') then 'table'
 when f = 'key' then 'key' when regexp_matches(value, '^[^\w]*(p\. )?[0-9]+[^\w]*$') then 'page' when length(value) < 45 then 'short' else 'text' end"""
_KINDS = rf"""select section_id, doc_id, {_KIND} as kind, len(list_filter(string_split(value, chr(10)), lambda x: trim(x, {_BL}) <> '' and length(x) < 45)) = 0 as all_long from (select *, lower(regexp_extract(value, '^\s*([^\s]+)', 1)) f from sections where value is not null)"""
_ORPHAN = "select '{0}' as what, count(*) as n from {1} x where {2} is not null and not exists (select 1 from articles a where a.doc_id = {2})"

SQL = {
    "attachment_lines": "select attachment_name, regexp_matches(line, '^[0-9]+$') as is_page, count(*) as n, sum(length(line))::bigint as chars, max(k)::int as last from (select attachment_name, unnest(s) as line, generate_subscripts(s, 1) - 1 as k from (select attachment_name, string_split(value, chr(10)) s from sections where value is not null)) group by 1, 2",
    "frame_lines": f"select doc_id, 'article.txt' as attachment_name, (generate_subscripts(l, 1) - 1)::int as line_number, length(unnest(l)) as length, title <> '' as titled from (select doc_id, coalesce(title, '') title, list_filter(string_split(text, chr(10)), lambda x: trim(x, {_BL}) <> '') l from documents)",
    "id_glob": "select '*' as pattern, count(*) as n from articles union all select 'a*', count(*) from articles where doc_id like 'a%' union all select 'exact', count(*) from articles where doc_id = (select min(doc_id) from articles)",
    "attachment_priority": "with t as (select ingest['_id'] as doc_id, attachment_name a from treatments where ingest['_id'] is not null and attachment_name is not null) select doc_id, arg_min(a, {r: case when a like '%.pdf.ann' then 0 when a like '%.txt.ann' then 1 else 2 end, a: a}) as attachment_name, count(distinct a) as n from t group by 1",
    "treatments_by_pattern": "select row_id, _id, coalesce(treatment, '') as treatment from treatments where regexp_matches(_id, '^[a-c]')",
    "equality_lookup": "select doc_id, title from articles where journal = 'Mycota Nova' order by doc_id limit 25",
    "ingest_projection": """select row_id, '{"_id":"' || coalesce(ingest['_id'], '') || '","journal":"' || coalesce(ingest['journal'], '') || '","url":"' || coalesce(ingest['url'], '') || '","doi":"' || coalesce(ingest['doi'], '') || '"}' as ingest, ingest['_id'] as doc_id from treatments""",
    "stripped_annotations": rf"""with y as (select line_id, {_MARKED} t from yedda_lines where line is not null) select line_id, len(regexp_extract_all(t, '\[@[^#]*#[^*\]]+\*\]'))::int as n_whole, (len(regexp_extract_all(t, '\[@')) - len(regexp_extract_all(t, '\[@[^#]*#[^*\]]+\*\]')))::int as n_orphan,
md5(regexp_replace(regexp_replace(t, '\[@\s*([^#]*?)\s*#[^*\]]+\*\]', '\1', 'g'), '\[@|#[^*\]]+\*\]', '', 'g')) as bare from y""",
    "model_input": f"select row_id, md5({_FULL}) as input, length({_FULL}) as length from treatments",
    "clean_values": "select event_id, case when value > 90 or value is null then 0.0 else value end::double as value from events",
    "renamed_fields": "select row_id, _id as taxon_id, md5(treatment) as name, try_cast(s['start_line'] as int) as start_line, try_cast(s['start_char'] as int) as start_char, try_cast(s['end_char'] as int) as end_char, try_cast(s['empirical_page'] as int) as empirical_page from (select row_id, _id, treatment, unnest(description_spans) s from treatments)",
    "merged_defaults": "select journal, case when count(*) > 20 then '100' else '10' end as batch, case when count(*) > 20 then 'bulk' else 'single' end as mode, '3' as retries from articles where journal is not null group by 1",
    "page_markers": "select distinct pdf_page as page, case when not contains(pdf_label, ' ') then pdf_label end as label from sections where pdf_page is not null",
    "paragraph_kinds": f"select section_id, kind, all_long from ({_KINDS})",
    "without_interstitials": f"select doc_id, count(*) as n, count(*) filter (all_long) as n_long from ({_KINDS}) where kind not in ('blank', 'figure', 'table', 'page') group by 1",
    "nomenclature_paragraphs": r"select line_id from yedda_lines where regexp_matches(line, '[A-Z][a-z]+(us|um|a|is|ea|ia) [a-z]{3,}.*((sp|gen|comb|nom)\. nov\.|\([12][0-9]{3}\))')",
    "sentence_ends": r"select section_id, regexp_matches(v, '[.!?]$') and not regexp_matches(v, '(^|[^A-Za-z])[A-Z]\.$') and not regexp_matches(v, '(: n\.|p\. n\.)$') and not regexp_matches(v, '(^| )(cf|Fig|al|ca|Abb|vgl|No|Nr|var|subsp)\.$') as ends from (select section_id, rtrim(value, ' ') v from sections where value is not null)",
    "likely_headers": f"with v as (select section_id, trim(value, {_BL}) v from sections where value is not null), w as (select *, list_filter(regexp_split_to_array(v, '\\s+'), lambda x: x <> '') w from v) select section_id, coalesce({', '.join(f'''case when regexp_matches(lower(v), '{p}') then '{k}' end''' for k, p in HEADERS)}, 'other') as kind, len(w)::int as n_words from w where len(w) between 1 and 10 and len(list_filter(w, lambda x: regexp_matches(x, '^[A-Z]'))) >= 0.7 * len(w) and not regexp_matches(v, '[.,;]$')",
    "abbreviation_filter": "select doc_id, count(*) as n from yedda_lines where regexp_matches(line, '(^|[^A-Za-z])({})') group by 1".format("|".join(a.replace(".", r"\.") for a in ABBREVIATIONS)),
    "repair_scans": "with w as (select row_id, unnest([case when ingest is null or ingest['journal'] is null then 'no_journal' end, case when coalesce(len(description_spans), -1) < 1 then 'no_spans' end, case when coalesce(description, '') = '' then 'bare' end, case when coalesce(attachment_name, '') = '' then 'no_attachment' end]) as what from treatments) select what, count(*) as n, min(row_id) as first from w where what is not null group by 1",
    "orphans": " union all ".join([_ORPHAN.format("sections", "sections", "x.doc_id"), _ORPHAN.format("lines", "yedda_lines", "x.doc_id"), _ORPHAN.format("taxon", "taxon", "x.doc_id"), _ORPHAN.format("treatments", "treatments", "x.ingest['_id']")]),
    "visibility": "select coalesce(published_at <= timestamp '1981-07-19', false) as open, count(*) as n, count(*) filter (journal is null) as n_hidden from articles group by 1",
    "dehyphenated": "select section_id, length(j) as length, len(string_split(j, chr(10)))::int as n_lines, md5(j) as hash from (select section_id, replace(value, '-' || chr(10), '') j from sections where value is not null)",
    "citation_tails": r"select doc_id, nullif(regexp_extract(k, '([0-9]+)\([0-9]+\)', 1), '')::int as volume, nullif(regexp_extract(k, '[0-9]+\(([0-9]+)\)', 1), '')::int as issue, nullif(regexp_extract(k, 'ser\. ([0-9]+)', 1), '')::int as series from (select doc_id, lower(source_key) k from articles where source_key is not null)",
    "mended_blocks": f"select line_id, md5('[@' || regexp_replace(line, '^(\\[@)+', '') || '#' || trim(label, ' ') || '*]') as hash, ('[@' || regexp_replace(line, '^(\\[@)+', '') || '#' || trim(label, ' ') || '*]') <> ({_BLOCK}) as changed from yedda_lines where line is not null and label is not null",
    "header_counters": r"with t as (select row_id, concat_ws(chr(10), treatment, description, key_text, notes) t from treatments) select row_id, len(regexp_extract_all(t, '(?i)diagnosis'))::int as n_diagnosis, len(regexp_extract_all(t, '(?i)description'))::int as n_description, len(regexp_extract_all(t, 'sp\. nov\.'))::int as n_species, len(regexp_extract_all(t, '(?m)^[0-9]+[a-z'']?[.)] '))::int as n_couplets from t",
    "latin_ratio": "with w as (select row_id, regexp_extract_all(lower(coalesce(description, '')), '[a-z]{3,}') w from treatments) select row_id, round(coalesce(len(list_filter(w, lambda x: regexp_matches(x, '(us|um|is|ae|orum|arum|ibus|atis)$'))) / nullif(len(w), 0), 0.0), 6) as ratio from w",
    "latin_blocks": rf"with p as (select row_id, list_filter(string_split(description, chr(10) || chr(10)), lambda x: trim(x, {_BL}) <> '') p from treatments where description is not null), m as (select row_id, array_to_string(list_transform(p, lambda x: case when regexp_matches(x, '(?i)(us|um|is|ae|orum|arum|ibus)[ ,.;].*(us|um|is|ae|orum|arum|ibus)[ ,.;]') and not regexp_matches(x, '(?i) (the|with|and|of|der|die|und|les|des|el|los) ') then 'L' else 'E' end), '') m from p) select row_id, len(regexp_extract_all(m, 'L+'))::int as n_blocks, regexp_matches(m, 'EL+E') as between from m",
    "watched_headers": "select row_id, ({})::int as n from (select row_id, coalesce(description, '') x from treatments)".format(" + ".join(f"(len(regexp_extract_all(x, '{w}')) >= 2)::int" for w in WATCHED)),
    "repeated_openings": "with s as (select row_id, description_lang, unnest(regexp_extract_all(description, '(?:^|[.] )([A-Z][a-z]+)', 1)) w from treatments where description is not null), n as (select row_id, description_lang, w, count(*) n from s group by 1, 2, 3 having count(*) >= 2) select row_id, description_lang, count(*) as n_words, max(n) as most from n group by 1, 2",
    "normal_space": "select doc_id, length(x) as length, md5(x) as hash from (select doc_id, trim(regexp_replace(replace(text, chr(65279), ''), '[ \\t\\n\\r\\f]+', ' ', 'g'), ' ') x from documents)",
    "relabelled_headers": "select label, case when l like 'holotype%' then 'Type-designation' when l like 'etym%' then 'Etymology' when l like 'distribution%' or l like 'habitat%' then 'Distribution' else label end as new_label, count(*) as n from (select label, lower(coalesce(line, '')) l from yedda_lines) group by 1, 2",
    "cross_entropy": "select event_type, round(avg(case when value between 0 and 100 then -ln(greatest(value / 100, 1e-10)) else 0.0 end), 5) as loss, round(avg(greatest(0.0, least(1.0, value / 50))), 5) as confidence from events group by 1",
    "rescaled": "select doc_id, round(coalesce((n - min(n) over w) / nullif((max(n) over w - min(n) over w)::double, 0), 1.0), 6) as scaled from (select doc_id, source, length(text) n from documents) window w as (partition by source)",
    "durations": "select user_id, (s // 3600)::varchar || 'h ' || lpad((s % 3600 // 60)::varchar, 2, '0') || 'm ' || lpad((s % 60)::varchar, 2, '0') || 's' as duration, s >= 86400 as due from (select user_id, date_sub('second', min(ts), max(ts)) s from events where ts is not null group by 1)",
}
