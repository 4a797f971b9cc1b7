"""Labelled lines: blocks, treatments, annotated text and label statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sporeline.functions.text import canonical_label
from sporeline.operators.islands import islands, ordered_text, previous, running

STUB = "Nomen ignotum"
#: Labels that open a treatment, that belong to one, and that may stand between.
NAME_LABEL = "nomenclature"
SECTION_LABELS = ["description", "diagnosis", "etymology", "distribution", "materials-examined", "type-designation", "biology", "notes", "key", "figure-caption"]
BETWEEN_LABEL = "misc-exposition"
MOST_BETWEEN = 4


def clean_lines(lines: DataFrame) -> DataFrame:
    """One row per (doc_id, line_number), the first loaded, with its canonical label; by article, so that all windows over an article share one shuffle."""
    first = F.min_by(F.struct("label", "line"), "line_id").alias("r")
    return lines.filter("doc_id is not null and line_number is not null").repartition("doc_id").groupBy("doc_id", "line_number").agg(first).select("doc_id", "line_number", canonical_label(F.col("r.label")).alias("label"), F.col("r.line").alias("line"))


def coalesce_blocks(lines: DataFrame, blank_breaks: bool = False) -> DataFrame:
    """Runs of one label within an article as blocks; lines without label end a run and are left out.

    With ``blank_breaks`` a blank line ends a run as well and is left out.
    """
    key = ["doc_id"]
    order = ["line_number"]
    label = F.coalesce("label", F.lit(""))
    if blank_breaks:
        lines = lines.withColumn("_blank", F.trim(F.coalesce("line", F.lit(""))) == "")
        lines = lines.withColumn("_key", F.when(F.col("_blank"), F.lit("\x01")).otherwise(label))
    else:
        lines = lines.withColumn("_key", label)
    starts = previous("_key", key, order).isNull() | (previous("_key", key, order) != F.col("_key"))
    runs = islands(lines, key, order, starts)
    kept = runs.filter((F.col("_key") != "") & (F.col("_key") != "\x01"))
    return kept.groupBy("doc_id", "island", "label").agg(F.min("line_number").alias("first_line"), F.count("*").alias("n_lines"), ordered_text("line_number", "line").alias("text")).drop("island")


def treatments(lines: DataFrame) -> DataFrame:
    """Blocks of an article grouped into treatments.

    Names (N) and sections (S) belong to a treatment; up to four other lines (M) may stand
    between. A new one starts at the first N or S, after more than four M, or at an N after an
    S. A treatment without a section is dropped; one without a name gets a stub.
    """
    kind = F.when(F.col("label") == NAME_LABEL, "N").when(F.col("label").isin(SECTION_LABELS), "S").when(F.col("label") == BETWEEN_LABEL, "M")
    k, o = ["doc_id"], ["line_number"]
    seen = lines.withColumn("kind", kind).filter("kind is not null")
    seen = seen.withColumn("m", running((F.col("kind") == "M").cast("int"), k, o))
    ns = seen.filter("kind <> 'M'")
    gap = F.col("m") - previous("m", k, o)
    starts = previous("kind", k, o).isNull() | (gap > MOST_BETWEEN) | ((F.col("kind") == "N") & (previous("kind", k, o) == "S"))
    grouped = islands(ns, k, o, starts, "treatment_no")
    text = lambda cond: F.array_join(F.transform(F.filter(F.sort_array(F.collect_list(F.struct(F.col("line_number").alias("o"), F.col("label").alias("l"), F.coalesce("line", F.lit("")).alias("t")))), cond), lambda p: p["t"]), "\n")
    out = grouped.groupBy("doc_id", "treatment_no").agg(
        F.min("line_number").alias("first_line"),
        F.count_if(F.col("kind") == "S").alias("n_section_lines"),
        text(lambda p: p["l"] == NAME_LABEL).alias("names"),
        text(lambda p: p["l"] == "description").alias("description"),
        text(lambda p: p["l"] == "materials-examined").alias("materials_examined"),
    )
    kept = out.filter("n_section_lines > 0")
    return kept.withColumn("treatment", F.when(F.col("names") == "", STUB).otherwise(F.col("names"))).drop("names")


def to_yedda(blocks: DataFrame, order: str = "first_line") -> DataFrame:
    """Annotated text of each article: ``[@text#Label*]`` per block, one after another."""
    one = F.concat(F.lit("[@"), F.col("text"), F.lit("#"), F.col("label"), F.lit("*]"))
    return blocks.withColumn("_one", one).groupBy("doc_id").agg(ordered_text(order, "_one").alias("value"))


def from_yedda(texts: DataFrame) -> DataFrame:
    """Lines of annotated text: block number, label, line in block, line; an empty last line of a block is dropped."""
    pattern = F.lit(r"(?s)\[@\s*(.*?)\s*#([^*]+)\*\]")
    found = F.arrays_zip(F.regexp_extract_all("value", pattern, F.lit(1)).alias("body"), F.regexp_extract_all("value", pattern, F.lit(2)).alias("label"))
    blocks = texts.select("doc_id", F.posexplode(found).alias("block_no", "b")).select("doc_id", "block_no", F.col("b.label").alias("label"), F.split("b.body", "\n", -1).alias("l"))
    return blocks.select("doc_id", "block_no", "label", F.posexplode("l").alias("line_in_block", "line")).filter(~((F.col("line") == "") & (F.col("line_in_block") > 0)))


def label_frequencies(lines: DataFrame) -> DataFrame:
    """Rows of each label and their percentage."""
    n = lines.filter("label is not null").groupBy("label").agg(F.count("*").alias("n"))
    return n.withColumn("percentage", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))  # one row per label


def class_weights(lines: DataFrame) -> DataFrame:
    """Inverse-frequency weights: inverse, balanced, and inverse rescaled to [0, 1]."""
    n = lines.filter("label is not null").groupBy("label").agg(F.count("*").alias("n"))
    w = Window.partitionBy()  # one row per label
    total, k = F.sum("n").over(w), F.count("*").over(w)
    inv = F.col("n") * 1.0
    out = n.withColumn("inverse", total / inv).withColumn("balanced", total / (k * inv))
    lo, hi = F.min("inverse").over(w), F.max("inverse").over(w)
    scaled = F.when(hi > lo, F.try_divide(F.col("inverse") - lo, hi - lo)).otherwise(F.lit(1.0))
    return out.select("label", "n", F.round("inverse", 6).alias("inverse"), F.round("balanced", 6).alias("balanced"), F.round(scaled, 6).alias("scaled"))


def prediction(line: Column) -> Column:
    """A rule label of a line, to score labels against."""
    return (
        F.when(F.coalesce(F.trim(line), F.lit("")) == "", "misc-exposition")
        .when(line.rlike(r"(sp|comb|nom|gen)\. nov\.|\((1[789]|20)[0-9]{2}\)$"), "nomenclature")
        .when(line.rlike(r"(Holotype|leg\.|coll\.|det\.)"), "materials-examined")
        .when(line.rlike(r"^(Fig|Table)\b"), "figure-caption")
        .when(line.rlike("µm|mm|walled|spored"), "description")
        .otherwise("misc-exposition")
    )


def per_class(pairs: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 of each class from ``pairs(gold, pred)``, in one aggregation."""
    n = pairs.groupBy("gold", "pred").agg(F.count("*").alias("n"))
    roles = n.select(F.explode(F.array(F.struct(F.col("gold").alias("label"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted"), F.when(F.col("gold") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")), F.struct(F.col("pred").alias("label"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))).alias("r")).select("r.*")
    t = roles.groupBy("label").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    p, r = F.coalesce(F.try_divide("tp", "predicted"), F.lit(0.0)), F.coalesce(F.try_divide("tp", "support"), F.lit(0.0))
    return t.select("label", "support", "predicted", "tp", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)), 6).alias("f1"))
