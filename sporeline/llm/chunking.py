"""Splitting oversized items at natural boundaries (problem 3).

*Content-defined chunking.* A rolling hash over ``WINDOW`` characters marks landmarks
wherever it matches a mask. From the start of a piece the first landmark beyond the minimum
size is taken and snapped to the nearest natural boundary between minimum and maximum: the
end of a paragraph, else of a sentence, else of a clause, else of a word, else any place
that keeps a letter and its combining marks together. As landmarks depend on
the characters near them only, an edit alters the pieces around it and the cuts further on
fall where they fell before. Each piece after the first repeats up to ``overlap`` characters from
the end of the one before, from a boundary on where there is one.

Defined cases: null and empty texts give no piece; a text up to the limit is one piece; an
item without any boundary is cut at the limit; ``piece[overlap:]`` of all pieces joined is
the text; lengths are in Unicode code points; equal rows give equal pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.sentences import SentenceModel, fit, sample_texts, starts_of
from sporeline.sources.tables import table

LIMIT, OVERLAP, LEAST, WINDOW, SPACING = 2000, 200, 900, 32, 256
_PARAGRAPH = re.compile(r"\n[^\S\n]*\n\s*")
_LINE = re.compile(r"\n\s*")
_CLAUSE = re.compile(r"[,;:，；：、]\s*")
_WORD = re.compile(r"\s+")
_COMBINING = re.compile(r"[̀-ͯऀ-ःऺ-ॏ‍️]")


def landmarks(text: str, window: int = WINDOW, spacing: int = SPACING) -> np.ndarray:
    """Positions after which the hash of the last ``window`` characters matches the mask, about one in ``spacing``."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(c) < window:
        return np.empty(0, np.int64)
    h = np.zeros(len(c) - window + 1, np.uint64)
    for j in range(window):
        h = h * np.uint64(0x100000001B3) + c[j : j + len(h)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return np.flatnonzero((h >> np.uint64(40)) % np.uint64(spacing) == 0) + window


def _ends(pattern: re.Pattern, text: str) -> np.ndarray:
    return np.array([m.end() for m in pattern.finditer(text)], np.int64)


def boundaries(text: str, model: SentenceModel | None) -> list[np.ndarray]:
    """Places to cut, best kind first; each is the position of the first character after the cut."""
    sentences = np.array(starts_of(text, model), np.int64) if model else np.array([m.end() for m in re.finditer(r"[.!?]\s+|[。！？।]", text)], np.int64)
    safe = np.array([i for i in range(1, len(text)) if not _COMBINING.match(text[i])], np.int64) if _COMBINING.search(text) else np.arange(1, len(text))
    return [_ends(_PARAGRAPH, text), np.union1d(sentences, _ends(_LINE, text)), _ends(_CLAUSE, text), _ends(_WORD, text), safe]


def _between(a: np.ndarray, lo: int, hi: int) -> np.ndarray:
    return a[np.searchsorted(a, lo) : np.searchsorted(a, hi, "right")]


def pieces(text: str | None, model: SentenceModel | None = None, limit: int = LIMIT, overlap: int = OVERLAP, least: int = LEAST) -> list[tuple[int, int, int]]:
    """``(start, end, overlap)`` of each piece: ``text[start:end]``, whose first ``overlap`` characters are the end of the one before."""
    if not text:
        return []
    if len(text) <= limit:
        return [(0, len(text), 0)]
    least = min(least, (limit - overlap) // 2)
    marks, kinds = landmarks(text), boundaries(text, model)
    out: list[tuple[int, int, int]] = []
    at = back = 0
    while True:
        most = at - back + limit
        if len(text) <= most:
            out.append((at - back, len(text), back))
            return out
        lo, hi = at + max(1, least), min(most, len(text) - 1)
        mark = _between(marks, lo, hi)
        aim = int(mark[0]) if len(mark) else hi
        cut = hi
        for places in kinds:
            near = _between(places, lo, hi)
            if len(near):
                cut = int(near[np.abs(near - aim).argmin()])
                break
        out.append((at - back, cut, back))
        back = min(overlap, cut - at)
        for places in (kinds[1], kinds[2], kinds[3]):
            starts = _between(places, cut - back, cut - 1)
            if len(starts):
                back = cut - int(starts[0])
                break
        at = cut


def chunked(df: DataFrame, id_col: str, text_col: str, model: SentenceModel, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """Pieces of every text over ``limit``: id, piece_no, piece_start, piece_end, overlap, piece.

    Short texts are filtered out in the JVM; only long ones reach Python.
    """
    kept = df.sparkSession.sparkContext.broadcast(model)  # bounded: fitted on a bounded sample

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = kept.value
        for pdf in batches:
            rows = [(i, n, s, e, o, t[s:e]) for i, t in zip(pdf[id_col], pdf[text_col]) for n, (s, e, o) in enumerate(pieces(t, m, limit, overlap))]
            yield pd.DataFrame(rows, columns=[id_col, "piece_no", "piece_start", "piece_end", "overlap", "piece"])

    long = df.select(id_col, text_col).filter(F.char_length(text_col) > limit)
    return long.mapInPandas(cut, f"{id_col} long, piece_no int, piece_start int, piece_end int, overlap int, piece string")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "treatments")
    return chunked(t, "row_id", "description", fit(sample_texts(t, "row_id", ["description"], 1500), 3))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that came out in more than one piece."""
    return p3_pieces(spark, sf_dir).filter("piece_no = 1").select("row_id").distinct()


SQL = {"p3_found": "select distinct row_id from treatments where length(description) > 2000"}
