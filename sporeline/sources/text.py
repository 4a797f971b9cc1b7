"""Readers and writers of text: plain and annotated files, web pages, ontologies, marked-up articles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.operators.labels import from_yedda

#: Fixed value: a page marker line, raw or within an annotated block.
PAGE_MARKER = r"---\s*PDF Page ([0-9]+)\s*(?:Label ([^\s]+)\s*)?---"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of whole files with file name, number, page (form feeds begin a new one) and character offset."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = files.select("file", F.posexplode(F.split("value", "\n", -1)).alias("line_number", "line"))
    before = "sum({}) over (partition by file order by line_number rows between unbounded preceding and 1 preceding)"
    now = "sum({}) over (partition by file order by line_number rows between unbounded preceding and current row)"
    return lines.select("file", "line_number", F.expr(f"1 + coalesce({now.format('char_length(line) - char_length(replace(line, chr(12)))')}, 0)").alias("page"), F.expr(f"coalesce({before.format('char_length(line) + 1')}, 0)").alias("line_start"), F.btrim("line", F.lit(" \n\f\r\t")).alias("line"), F.col("line").rlike(PAGE_MARKER).alias("is_page_marker"))


def annotated_files(spark: SparkSession, path: str) -> DataFrame:
    """Labelled lines of annotated files; the file name is the document."""
    return from_yedda(spark.read.text(path, wholetext=True).select(F.input_file_name().alias("doc_id"), "value"))


def ontology(spark: SparkSession, path: str) -> DataFrame:
    """Terms of an OBO file: id, name, parents, synonyms."""
    stanzas = spark.read.text(path, lineSep="\n\n").filter(F.col("value").startswith("[Term]"))
    one = lambda k: F.nullif(F.regexp_extract("value", rf"(?m)^{k}: (.*)$", 1), F.lit(""))
    return stanzas.select(one("id").alias("id"), one("name").alias("name"), F.regexp_extract_all("value", F.lit(r"(?m)^is_a: ([^\s!]+)"), F.lit(1)).alias("parents"), F.regexp_extract_all("value", F.lit(r'(?m)^synonym: "([^"]*)"'), F.lit(1)).alias("synonyms"))


def html_rows(pages: DataFrame, key: str, html: str) -> DataFrame:
    """Cells of table rows and list items of web pages, tags taken off."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(r"(?is)<(?:tr|li)\b[^>]*>(.*?)</(?:tr|li)>"), F.lit(1))).alias("row_no", "row"))
    cells = F.transform(F.split("row", r"(?i)</t[dh]>"), lambda c: F.btrim(F.regexp_replace(c, "<[^>]+>", "")))
    return rows.select(key, "row_no", F.filter(cells, lambda c: c != "").alias("cells"))


def xml_blocks(docs: DataFrame, key: str, xml: str, tags: dict[str, str]) -> DataFrame:
    """Tagged blocks of marked-up articles: each section's paragraphs with the tag its type maps to."""
    import re
    import xml.etree.ElementTree as ET

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for i, text in zip(pdf[key], pdf[xml]):
                try:
                    root = ET.fromstring(text)
                except (ET.ParseError, TypeError):
                    continue
                n = 0
                for sec in root.iter("sec"):
                    tag = tags.get((sec.get("sec-type") or "").lower(), "Misc-exposition")
                    for p in sec.findall("p"):
                        body = re.sub(r"\s+", " ", "".join(p.itertext())).strip()
                        if body:
                            out.append((i, n, tag, body))
                            n += 1
            yield pd.DataFrame(out, columns=[key, "block_no", "tag", "text"])

    return docs.select(key, xml).mapInPandas(run, f"{key} string, block_no int, tag string, text string")


def write_annotated(blocks: DataFrame, path: str) -> None:
    """One annotated text per article, in folders by article."""
    from sporeline.operators.labels import to_yedda

    to_yedda(blocks).repartition("doc_id").write.mode("overwrite").partitionBy("doc_id").text(path)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """Fixed columns as CSV, others ignored."""
    df.select(*columns).write.mode("overwrite").option("header", True).csv(path)


def write_edges(tree: DataFrame, path: str) -> None:
    """Edges of a tree of nodes with paths ``/a/b/``: parent and child."""
    parts = F.filter(F.split("path", "/"), lambda x: x != "")
    tree.select(F.when(F.size(parts) > 1, F.element_at(parts, -2)).alias("parent"), F.element_at(parts, -1).alias("child")).filter("child is not null").write.mode("overwrite").parquet(path)
