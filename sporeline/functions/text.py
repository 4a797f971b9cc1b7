"""Column expressions over text, all evaluated in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = " \t\n\r\f"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(BLANK))


def lines_of(c: Column) -> Column:
    """All lines, blank ones at the end too."""
    return F.split(c, "\n", -1)


def count_of(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def words_of(c: Column, pattern: str = "[a-zA-Z]{3,}") -> Column:
    return F.regexp_extract_all(c, F.lit(f"({pattern})"), F.lit(1))


def suffixes(words: Column) -> Column:
    """The last two, three and four letters of each word; a shorter word is repeated whole."""
    return F.flatten(F.transform(words, lambda w: F.array(F.right(w, F.lit(2)), F.right(w, F.lit(3)), F.right(w, F.lit(4)))))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays; 0 when one has no length."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.try_divide(dot, n))


def content_id(*fields: Column) -> Column:
    """Id of a record from its trimmed fields; null and empty are the same."""
    return F.concat(F.lit("taxon_"), F.sha2(F.concat_ws(":", *[F.coalesce(F.trim(f), F.lit("")) for f in fields]), 256))


def canonical_label(c: Column) -> Column:
    """Label spellings as one: lower case, runs of anything but letters as one hyphen."""
    low = F.regexp_replace(F.lower(F.trim(c)), "[^a-z]+", "-")
    return F.nullif(F.btrim(low, F.lit("-")), F.lit(""))
