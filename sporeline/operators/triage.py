"""Signals of faulty records and measures of their size, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sporeline.functions.text import count_of

#: Words of a description that name features, and units of measurement.
FEATURES = ["cap", "pileus", "stipe", "lamellae", "spores", "basidia", "hyphae", "cystidia", "context", "colonies", "conidia", "asci", "setae", "annulus", "perithecia"]
MEASURE = r"[0-9.]+[–-][0-9.]+ (?:µm|mm|cm)"


def complexity(text: Column) -> Column:
    """Words, plus five for each distinct feature word and for each measurement."""
    t = F.coalesce(text, F.lit(""))
    words = count_of(t, r"[^\s]+")
    low = F.lower(t)
    features = sum((F.when(F.contains(low, F.lit(w)), 1).otherwise(0) for w in FEATURES), F.lit(0))
    return words + 5 * features + 5 * count_of(t, MEASURE)


def flags(description: Column, treatment: Column) -> Column:
    """Names of the signals a record shows, in fixed order, joined by bars."""
    d, t = F.coalesce(description, F.lit("")), F.coalesce(treatment, F.lit(""))
    return F.concat_ws(
        "|",
        F.when(d == "", "no_description"),
        F.when((d != "") & (F.char_length(d) < 200), "short"),
        F.when(F.char_length(d) > 4000, "merged"),
        F.when(d.rlike(r"^[a-z,;)]"), "starts_mid_sentence"),
        F.when((d != "") & ~F.rtrim(d).rlike(r"[.!?\"»”“。।]$"), "clipped_tail"),
        F.when(count_of(t, r"(sp|gen|comb|nom)\. nov\.") > 1, "several_names"),
        F.when(count_of(d, "ITS barcode") > 0, "sequence"),
        F.when(count_of(d, r"\n\n") >= 3, "many_paragraphs"),
    )


def repeated_terms(docs: DataFrame, key: str, text: str, stop: list[str], least: int = 10) -> DataFrame:
    """Per document the number of different words that it uses ``least`` times or more."""
    words = docs.select(key, F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("([a-z]{3,})"), F.lit(1))).alias("w")).filter(~F.col("w").isin(stop))
    return words.groupBy(key, "w").agg(F.count("*").alias("n")).filter(F.col("n") >= least).groupBy(key).agg(F.count("*").alias("n_terms"), F.max("n").alias("most"))
