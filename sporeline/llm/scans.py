"""Noise in text from scanned pages (problem 4).

Two averaged perceptrons are trained on the whole corpus: the tagger on counts of all lines by what its features
depend on, the editor in blocks of all words.

The *furniture* tagger decides of every line whether it is text, a running header or a page
number, from its shape and its place: how many pages of the article have the line (look-alike letters
folded, page numbers taken off), whether its number is the one the page should bear, whether it
stands first or last on its page, whether it stands alone.

The *editor* goes through a word character by character and predicts keep, delete, replace or insert (put one
letter or two for what was read) and, at the hyphen of a broken line, join. What scanners read for
what was printed is learned from the corpus: rare words that differ from words fifty times as common by
one or two characters in the same surroundings are aligned, and the differences that turn up
in many words, within them as well as at their ends, are the misreadings (a few are known to be likely; of short words only signs that are no plain letters). The editor is trained on those
pairs, on common words with the misreadings put in, and on broken words whose whole or
hyphenated form the corpus knows, with and without that knowledge. What it proposes is taken only
if the corpus bears it out: the proposed word is far more common than the one read.

Nothing is bounded but a filter: words are counted whole before anything is learned from them,
edited once per distinct word, in a table; candidates come from a join of all words on the fold of look-alikes; broken
words meet their counts by joins. The workers get the furniture weights and the ``COMMON``
commonest words that have no candidate; every other word of every row is looked up in the table of
repairs by a join, so the filter changes the cost and never the result.

Places are found in blocks of ``BLOCK`` paragraphs and across their borders, line keys and pages by
salted joins, so no article is read by one task.

Defined cases: null and blank values yield nothing; rows loaded twice yield under each id, but stand once in
``paragraphs``; rows without article or paragraph number take no part in joining paragraphs; unknown page
numbers leave the shape to decide; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sporeline.operators.skew import hot_keys, salted_join
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

#: Bound of the filter, size of a block of paragraphs and, about, of a block of examples the editor is trained on; visits of the tagger to all lines together in an epoch.
COMMON, BLOCK, EXAMPLES, VISITS = 60_000, 256, 10_000, 12_000
#: A misread word is met at most once for so many times that the printed one is.
RARE = 50
#: A word is a misreading only of one so many times as common (the first for words met once or twice).
FACTORS, LEAST_COUNT = (8, 12), 4
#: Common misreadings, (read, printed); one showing of them in the corpus is enough, of others it takes many.
LIKELY = [("ii", "n"), ("ii", "u"), ("li", "h"), ("cl", "d"), ("rn", "m"), ("vv", "w"), ("c", "e"), ("l", "i"), ("f", "t"), ("q", "g"), ("0", "o"), ("1", "l"), ("5", "s"), ("6", "b")]
#: Letters that stand for digits in misread numbers, (read, printed).
DIGITS = [("O", "0"), ("l", "1"), ("I", "1"), ("S", "5")]
_EDGE = "()[]{}.,;:!?\"'«»„“”‘’… "
_HYPHENS = "-¬­‐"
_ALPHA = re.compile(r"[^\W\d_]")
_ROMAN = re.compile(r"m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$")
_NUMBER_LINE = re.compile(r"^\W*(?:(?:p|pp|s|pag|page|seite)\.?\s*)?((?:[\dOlI]\s?){1,5}|[ivxlcdm]{1,12})\W*$", re.IGNORECASE)
_LEAD = re.compile(r"^[\dOlI]{1,5}\s{2,}")
_TAIL = re.compile(r"(?:\s{2,}|:\s*)[\dOlI]{1,5}$")
_VOLUME = re.compile(r"\s[\dOlI]{1,4}$")
_CAPTION = re.compile(r"^(?:fig|figs|abb|taf|tab|table|tabelle|tableau|plate|pl)\b\.?\s*[\dOlI]+\.?$", re.IGNORECASE)
_TABLE_ROW = re.compile(r"^[\d.,–\-Ol ]+(?:\s{2,}|\t)[\d.,–\-Ol ]+$")
_CLAUSE = re.compile(r"[,.;] ")
_STOPPED = re.compile(r"[.!?]['\"»”“)]*$")
_SHORTENED = re.compile(r"(?:\b(?:cf|Fig|fig|al|ca|Abb|vgl|No|Nr|p|subsp|var|excl|Approx)|\b[A-Z])\.$")
_NUMERIC = re.compile(r"[OlI.–()\-×]{2,}")
_PLAIN_NUMBER = re.compile(r"[\d.,–()\-×°/:]+")


#: What a line that is a number may begin with, blanks and marks aside.
_NUMBER_STARTS = frozenset("0123456789OlIpPsSivxlcdmVXLCDM")


class Folding:
    """Misreadings ``(read, printed)`` and what look-alikes have in common under them.

    Single letters that are read for one another have one representative; a letter read as two is those two.
    """

    def __init__(self, misreadings: list[tuple[str, str]]):
        self.misreadings = misreadings
        root: dict[str, str] = {}

        def find(c: str) -> str:
            while root.get(c, c) != c:
                c = root[c]
            return c

        pairs = [(r.lower(), p.lower()) for r, p in misreadings]
        for r, p in pairs:
            if len(r) == len(p) == 1:
                a, b = find(r), find(p)
                if a != b:
                    root[max(a, b)] = min(a, b)
                    root.setdefault(min(a, b), min(a, b))
        longer: dict[str, str] = {}
        for r, p in pairs:
            one, two = (p, r) if len(p) < len(r) else (r, p)
            if len(one) == 1 and len(two) == 2 and find(one) not in {find(c) for c in two}:
                longer.setdefault(find(one), two)

        def spell(c: str, depth: int = 0) -> str:
            c = find(c)
            return "".join(spell(x, depth + 1) for x in longer[c]) if c in longer and depth < 3 else c

        letters = {c for r, p in pairs for c in r + p} | {"|"}
        root.setdefault("|", find("l"))
        self.map = {c: s for c in letters if (s := spell(c)) != c}

    def fold(self, s: str) -> str:
        s = s.lower()
        for k, v in self.map.items():  # no letter put in is ever replaced
            s = s.replace(k, v)
        return s

    def column(self, c: Column) -> Column:
        """The same as a column expression."""
        one = {k: v for k, v in self.map.items() if len(v) == 1}
        out = F.lower(c)
        for k, v in self.map.items():
            if len(v) > 1:
                out = F.replace(out, F.lit(k), F.lit(v.upper()))
        return F.lower(F.translate(out, "".join(one), "".join(one.values()))) if one else F.lower(out)


def roman(s: str) -> int | None:
    s = s.lower()
    if not s or not _ROMAN.match(s):
        return None
    v = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
    n = [v[c] for c in s]
    return sum(-a if k + 1 < len(n) and a < n[k + 1] else a for k, a in enumerate(n))


def line_number(line: str) -> int | None:
    """The number a line consists of, Arabic or Roman, or None."""
    c = line[:1]
    m = _NUMBER_LINE.match(line) if c in _NUMBER_STARTS or not c.isalnum() else None
    if not m:
        return None
    body = m[1].replace(" ", "")
    digits = body.replace("O", "0").replace("l", "1").replace("I", "1")
    return int(digits) if digits.isdigit() and any(c.isdigit() for c in body) else roman(body)


def header_key(line: str, folding: Folding) -> str:
    """A stripped line without its page number, blanks reduced, look-alikes folded."""
    if line[0] in _DIGITISH:
        line = _LEAD.sub("", line)
    if line[-1:] in _DIGITISH:
        line = _TAIL.sub("", line)
    return folding.fold(" ".join(line.split()) if "  " in line or "\t" in line else line)


_DIGITISH = frozenset("0123456789OlI")


def _stop(s: str) -> str:
    """The mark a line stops with; the point of an abbreviation is none."""
    c = s[-1:]
    return c if c in _ENDS and not (c == "." and _SHORTENED.search(s[-24:])) else ""


_ENDS = frozenset(".,;-!?")


def _line_end(s: str) -> str:
    return _stop(s) or (")" if s[-1] == ")" else "o")


def _is_header_like(line: str) -> bool:
    s = line.strip()
    return len(s) >= 5 and not _stop(s) and not _CAPTION.match(s) and not _TABLE_ROW.match(s) and line_number(s) is None


# --- words and lines of the corpus


def _bare(words: Counter) -> dict[str, int]:
    """Words with a letter, marks around them taken off."""
    bare: Counter = Counter()
    for w, n in words.items():
        if _ALPHA.search(w):
            bare[w.strip(_EDGE)] += n
    bare.pop("", None)
    return bare


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of all values and how often they stand there."""
    words: Counter = Counter()

    def counted() -> pa.RecordBatch:
        got = _bare(words)
        return pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for value in batch.column("value").to_pylist():
            words.update(value.split())
        if len(words) > 500_000:
            yield counted()
            words.clear()
    yield counted()


_SEEN = "n long, section_id long, doc_id string, line_no int, line long, page int, offset int"


def _evidence(folding: Folding):
    """Keys of lines and page offsets, as rows of which the other columns are null."""
    kinds = {"n": pa.int64(), "section_id": pa.int64(), "doc_id": pa.string(), "line_no": pa.int32(), "line": pa.int64(), "page": pa.int32(), "offset": pa.int32()}

    def frame(**given) -> pa.RecordBatch:
        n = len(next(iter(given.values())))
        return pa.RecordBatch.from_arrays([pa.array(given[c], t) if c in given else pa.nulls(n, t) for c, t in kinds.items()], names=list(kinds))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            ids, nos, keys, pages, docs, offs, weight = [], [], [], [], [], [], []
            for i, doc, value, page, printed in zip(*[batch.column(c).to_pylist() for c in ("section_id", "doc_id", "value", "pdf_page", "empirical_page_number")]):
                if doc is None:
                    continue
                seed = digest(doc)
                if page is not None and printed is not None:
                    docs.append(doc), offs.append(printed - page), weight.append(3)
                for k, s in enumerate(value.split("\n")):
                    s = s.strip()
                    if not s:
                        continue
                    n = line_number(s)
                    if n is None:
                        ids.append(i), nos.append(k), pages.append(page), keys.append(digest(header_key(s, folding), seed) >> 1)
                    elif page is not None:
                        docs.append(doc), offs.append(n - page), weight.append(1)
            if ids:
                yield frame(section_id=ids, line_no=nos, line=keys, page=pages)
            if docs:
                yield frame(doc_id=docs, offset=offs, n=weight)

    return run


def _same_sign(r: str, p: str) -> bool:
    """Whether the two are spellings of one sign, or what was read is no plain sign."""
    return unicodedata.normalize("NFKC", r) != r or r == unicodedata.normalize("NFKC", p)


def _odd_sign(r: str, p: str) -> bool:
    """Whether a sign that is no plain letter was printed where plain ones were read."""
    return len(p) == 1 and r.isascii() and not p.isascii() and unicodedata.normalize("NFKD", p)[0] != r


def choose_misreadings(words: Counter, inner: Counter, met: Counter, signs: Counter) -> list[tuple[str, str]]:
    """Misreadings ``(read, printed)``, the best borne out first.

    Given are, of every pair, the number of words that show it, of those that show it within, the times these words
    are met, and the times that short words show it.
    """
    by_count = lambda c: sorted(c.items(), key=lambda x: (-x[1], x[0]))
    least = max(3, 0.02 * max(words.values(), default=0))
    good = [rp for rp, n in by_count(words) if rp in LIKELY or n >= least and inner[rp] >= max(2, 0.3 * n)]
    # what is read long for one letter may be read short elsewhere
    good += [(p, r) for r, p in good if len(r) > len(p) and met[p, r] >= 3 and (p, r) not in good]
    # such a sign is taken for misread when it is read in two ways that look alike
    fold = Folding(good).fold
    alike = Counter((fold(r), p) for (r, p), n in signs.items() if n >= 5)
    return good + [(r, p) for (r, p), n in by_count(signs) if n >= 5 and alike[fold(r), p] >= 2 and (r, p) not in good]


def learn_misreadings(common: dict[str, int], other: dict[str, int]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """Misreadings ``(read, printed)`` and the pairs of words that show them, of words in memory; of a table see ``learned``."""
    places = defaultdict(list)
    for w, n in common.items():
        if len(w) >= 5 or not w.isascii():
            for k in (1, 2):
                for i in range(len(w) - k + 1):
                    places[w[:i], w[i + k :]].append((w[i : i + k], n, w))
    words, inner, shown, signs, met = Counter(), Counter(), defaultdict(list), Counter(), Counter()
    for w, n in sorted(other.items()):
        seen = {}
        for k in (1, 2):
            for i in range(len(w) - k + 1):
                for p, m, whole in places.get((w[:i], w[i + k :]), ()):
                    r = w[i : i + k]
                    if m < RARE * n or p[0] == r[0] or p[-1] == r[-1] or len(p) + len(r) > 3 or not (r + p).isalnum() or _same_sign(r, p):
                        continue
                    if len(whole) >= 5:
                        seen[r, p] = (len(w) - i - k >= 2, whole)
                    elif len(w) > len(r) and _odd_sign(r, p):
                        signs[r, p] += n  # a sign scanners do not know, in a short word
                        shown[r, p].append((w, whole))
        for rp, (inside, whole) in seen.items():
            words[rp] += 1
            met[rp] += n
            inner[rp] += inside
            shown[rp].append((w, whole))
    good = choose_misreadings(words, inner, met, signs)
    return good, [pair for rp in good for pair in shown[rp]]


def _cuts(words: DataFrame, taken: str) -> DataFrame:
    """Every word with one or two of its letters taken out: ``around`` is what is left, ``at`` the place."""
    out = None
    for k in (1, 2):
        at = F.explode(F.sequence(F.lit(1), F.length("word") - k + 1)).alias("at")
        cut = words.filter(F.length("word") >= k).select("word", "n", at)
        part = cut.select("word", "n", "at", F.expr(f"substr(word, at, {k})").alias(taken), F.expr(f"concat(substr(word, 1, at - 1), '\x01', substr(word, at + {k}))").alias("around"))
        out = part if out is None else out.unionByName(part)
    return out


def _plain_signs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        ok, odd = [], []
        for r, p in zip(pdf["read"], pdf["printed"]):
            ok.append((r + p).isalnum() and not _same_sign(r, p))
            odd.append(_odd_sign(r, p))
        yield pdf.assign(signs=pdf["signs"].where(odd, 0))[np.array(ok, bool)]


def learned(words: DataFrame) -> tuple[list[tuple[str, str]], DataFrame]:
    """Misreadings of all ``words(word, n)`` of the corpus and ``(word, whole)``, the pairs that show them.

    A printed word is met ``RARE`` times or more, or no word is rare beside it; a misread one is at most a letter longer
    than the longest of them. Letters read for letters reach the driver: pairs of an alphabet, if three words show them.
    """
    common = words.filter((F.col("n") >= RARE) & ~F.col("word").contains("-") & ((F.length("word") >= 5) | F.col("word").rlike(r"[^\x00-\x7f]")))
    longest = common.agg(F.max(F.length("word"))).first()[0] or 0
    whole = _cuts(common, "printed").select("around", "printed", F.col("word").alias("whole"), F.col("n").alias("m"))
    met = _cuts(words.filter(F.length("word") <= longest + 1), "read").join(whole, "around").filter(F.expr(f"m >= {RARE} * n and length(read) + length(printed) <= 3 and left(read, 1) <> left(printed, 1) and right(read, 1) <> right(printed, 1)"))
    long = F.length("whole") >= 5
    met = met.filter(long | (F.length("word") > F.length("read"))).groupBy("word", "read", "printed", long.alias("long"), F.when(~long, F.col("at")).alias("place"), F.when(~long, F.col("whole")).alias("short"))
    met = met.agg(F.max("n").alias("n"), F.max_by("whole", "at").alias("whole"), (F.length("word") - F.max("at") - F.length("read") + 1 >= 2).alias("inside"))
    met, _ = materialize(met.select("word", "read", "printed", "long", "n", "whole", "inside"), "aligned")
    of = lambda c: F.sum(F.when(F.col("long"), c).otherwise(0))
    stats = met.groupBy("read", "printed").agg(of(F.lit(1)).alias("words"), of(F.col("inside").cast("long")).alias("inner"), of(F.col("n")).alias("met"), F.sum(F.when(~F.col("long"), F.col("n")).otherwise(0)).alias("signs"))
    stats = stats.mapInPandas(_plain_signs, "read string, printed string, words long, inner long, met long, signs long")
    likely = F.concat_ws(" ", "read", "printed").isin([f"{r} {p}" for r, p in LIKELY])
    count: dict[str, Counter] = {c: Counter() for c in ("words", "inner", "met", "signs")}
    for x in stats.filter((F.col("words") >= 3) | (F.col("met") >= 3) | (F.col("signs") >= 5) | likely).collect():
        for c, v in count.items():
            if x[c]:
                v[x["read"], x["printed"]] = x[c]
    good = choose_misreadings(**count)
    chosen = words.sparkSession.createDataFrame(good, "read string, printed string")
    odd = words.sparkSession.createDataFrame([rp for rp in good if _odd_sign(*rp)], "read string, printed string")
    pairs = met.filter("long").join(F.broadcast(chosen), ["read", "printed"]).unionByName(met.filter("not long").join(F.broadcast(odd), ["read", "printed"]))
    return good, pairs.select("word", "whole").distinct()


class Perceptron:
    """Averaged multiclass perceptron over sparse string features."""

    def __init__(self, classes: list[str]):
        self.classes = classes
        self.lists: dict[str, list[float]] = {}

    def best(self, feats: list[str]) -> int:
        """The class of the highest score, the first of equal ones."""
        own = [self.lists[f] for f in feats if f in self.lists]
        s = [sum(c) for c in zip(*own)]
        return s.index(max(s)) if s else 0

    def fit(self, rows: list[tuple[list[str], int]], epochs: int = 4, seed: int = 3, steps: list[float] | None = None) -> None:
        """``steps`` are the sizes of the corrections by the rows, 1 by default."""
        rng = np.random.default_rng(seed)
        step = np.ones(len(rows)) if steps is None else np.array(steps)
        number: dict[str, int] = {}
        ids = [np.array([number.setdefault(f, len(number)) for f in feats]) for feats, _ in rows]
        w, total = np.zeros((len(number), len(self.classes))), np.zeros((len(number), len(self.classes)))
        t = 1
        for _ in range(epochs):
            for i in rng.permutation(len(rows)):
                own, y = ids[i], rows[i][1]
                h = int(w[own].sum(0).argmax())
                if h != y:
                    w[own, y] += step[i]
                    w[own, h] -= step[i]
                    total[own, y] += t * step[i]
                    total[own, h] -= t * step[i]
                t += 1
        w -= total / t
        self.lists = {f: w[k].tolist() for f, k in number.items() if w[k].any()}

    def score(self, feats: list[str], k: int) -> float:
        """Of one class, from plain lists."""
        w = self.lists
        return sum(w[f][k] for f in feats if f in w)


# --- furniture


def line_shape(s: str) -> tuple:
    """What a stripped line looks like: all that the features take from its text."""
    number = line_number(s) is not None
    edge = s[0] in _DIGITISH or s[-1] in _DIGITISH
    bare = _TAIL.sub("", _LEAD.sub("", s)) if edge else s
    words = bare.split()
    caps = low = 0
    for w in words:
        caps += w[0].isupper()
        low += w[0].islower()
    n = len(words) or 1
    upper = bare.isupper() or caps * 2 >= n and sum(map(str.isupper, bare)) > 0.6 * max(1, sum(map(str.isalpha, bare)))
    volume = edge and bool(_VOLUME.search(bare)) and bool(_ALPHA.search(bare))
    end = _line_end(s)
    prose = low > 0.6 * n or bool(_CLAUSE.search(bare))
    caption = not prose and bool(_CAPTION.match(s))
    return number, bare != s, volume, "—" in s, end, caps * 2 >= n, upper, prose, caption, edge and bool(_TABLE_ROW.match(s)), min(len(s) // 15, 6)


def line_features(shape: tuple, pages: int, gap: str, first: bool, last: bool, alone: bool, heading: bool) -> list[str]:
    """Shape of a line and its place on the page and in the article."""
    number, paged, volume, dash, end, caps, upper, prose, caption, row, length = shape
    p = "0" if pages < 2 else "2" if pages == 2 else "3"
    look = f"{number}{paged}{volume}{dash}"
    return [
        "b", f"n{number}", f"p{p}", f"s{look}", f"e{end}", f"c{caps}{upper}", f"h{heading}", f"np{p}{heading}{end}{number}", f"sa{look}{alone}",
        f"of{number}{gap}", f"oa{number}{gap}{alone}", f"cap{caption}", f"tab{row}", f"l{length}", f"fl{first}{last}", f"fa{first or last}{alone}{p}", f"se{look}{end}{caps}{heading}", f"pr{prose}{p}", f"ps{prose}{look}", f"fs{first or last}{look}{prose}",
    ]


_STOPS = (*sorted(_ENDS), ")", "o")
_GAPS = ("-", "?", "=", "x")
#: Marks of a line that teaches nothing.
UNTAUGHT = 3


def place_code(shape: tuple, pages: int, gap: str, first: bool, last: bool, alone: bool, heading: bool) -> int:
    """A number for all that the features of a line depend on."""
    code = 0
    for bit in (*shape[:4], *shape[5:10], first, last, alone, heading):
        code = 2 * code + bool(bit)
    return ((code * 8 + _STOPS.index(shape[4])) * 7 + shape[10]) * 16 + min(pages, 3) * 4 + _GAPS.index(gap)


def place_of(code: int) -> tuple:
    """What :func:`place_code` was given."""
    code, low = divmod(code, 16)
    code, length = divmod(code, 7)
    code, end = divmod(code, 8)
    bits = [bool(code >> k & 1) for k in range(12, -1, -1)]
    return (*bits[:4], _STOPS[end], *bits[4:9], length), low // 4, _GAPS[low % 4], *bits[9:]


def taught(line: str, shape: tuple, pages: int, gap: str, alone: bool, heading: bool) -> int:
    """What a line teaches: lines on three or more pages are headers, numbers that fit the page are page numbers."""
    if gap != "-":
        return 2 if gap == "=" or (gap == "?" and not re.search(r"[.)]$", line)) else 0
    header = not heading and (pages >= 2 or alone) and _is_header_like(line)
    if header and pages >= 3:
        return 1
    # may be the only header of a short article: not used for training
    return UNTAUGHT if header and (alone or pages == 2) and (shape[3] or shape[2]) else 0


def _gap(line: str, page: float, offset: float) -> str:
    """How the number of a line agrees with the page."""
    n = line_number(line)
    if n is None:
        return "-"
    if page != page or offset != offset:
        return "?"
    return "=" if n == int(page) + int(offset) else "x"


# --- the editor


def _numeric(s: str) -> str:
    return "d" if any(map(str.isdigit, s)) and sum(map(str.isdigit, s)) * 2 > sum(map(str.isalnum, s)) else "w"


def _editor_features(s: str, i: int, done: str, digits: str) -> list[str]:
    p = f"^^^{s}$$$"
    j = i + 3
    a, b, c, d, e = p[j - 2], p[j - 1], p[j], p[j + 1], p[j + 2]
    return [f"0{c}", f"1{b}{c}", f"2{c}{d}", f"3{b}{c}{d}", f"4{a}{b}{c}", f"5{c}{d}{e}", f"6{a}{b}{c}{d}", f"7{b}{c}{d}{e}", f"8{a}{b}{c}{d}{e}", f"9{c}{digits}", f"A{c}{d}{digits}", f"B{done}{c}", f"C{p[j - 3]}{a}{b}{c}", f"D{c}{d}{e}{p[j + 3]}"]


class Break(tuple):
    """A word broken at a line end: ``(left, mark, right, counts)``; counts are those of the whole word, of the form with
    the hyphen, of the last part before and of the first part after it, then whether either form is a misreading."""

    def features(self, hide: bool = False) -> list[str]:
        a, mark, b, (whole, own, last, first, fix_whole, fix_own) = self
        if hide:
            whole = own = 0
        know = "0" if not whole and not own else "w" if whole > own else "o" if own > whole else "="
        parts = f"{last >= 5}{first >= 5}"
        cap = b[:1].isupper()
        j = len(a)
        # the place of the hyphen in the broken word, as the editor sees any other character
        near = [f"j{f}" for f in _editor_features(f"{a}{mark}{b}", j, "k", "w")[1:6]]
        sure = know if know in "wo" else f"{know}{parts}{cap}{fix_whole}{fix_own}"
        return [f"J{know}", f"Jm{know}{mark}", f"Jp{sure}", f"Jpm{sure}{mark}", f"Jc{know}{cap}", f"Jf{know}{fix_whole}{fix_own}", f"Jl{know}{min(len(a), 4)}{min(len(b), 4)}", *(near if know == "0" else [])]


class Editor:
    """The character editor: classes keep, delete, join and one to put each letter or two."""

    KEEP, DROP, JOIN = 0, 1, 2

    def __init__(self, misreadings: list[tuple[str, str]]):
        self.folding = Folding(misreadings)
        self.words = misreadings
        prints = sorted({p for _, p in [*misreadings, *DIGITS]})
        self.net = Perceptron(["keep", "delete", "join", *[f"put {p}" for p in prints]])
        self._put = {p: 3 + k for k, p in enumerate(prints)}

    def train(self, common: list[str], pairs: list[tuple[str, str]], broken: list[tuple[Break, bool]], seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        rows: list[tuple[list[str], int]] = []
        every = [*self.words, *DIGITS]

        def teach(read: str, tags: list[int], near: range) -> None:
            done, digits = "k", _numeric(read)
            for i in near:
                rows.append((_editor_features(read, i, done, digits), tags[i]))
                done = "k" if tags[i] == 0 else "x"

        def spoil(w: str, i: int, r: str, p: str) -> None:
            read = w[:i] + r + w[i + len(p) :]
            teach(read, [0] * i + [self._put[p]] + [1] * (len(r) - 1) + [0] * (len(w) - i - len(p)), range(max(0, i - 3), min(len(read), i + len(r) + 3)))

        numbers = [f"{rng.integers(1, 30)}.{rng.integers(0, 10)}–{rng.integers(10, 60)}.{rng.integers(0, 10)}" for _ in range(150)] + [str(rng.integers(1850, 2024)) for _ in range(150)] + [f"{rng.integers(10, 70)}–{rng.integers(10, 90)}" for _ in range(100)]
        for w in [*common, *numbers]:
            teach(w, [0] * len(w), range(len(w)))
            spots = [(i, r, p) for r, p in every for i in range(len(w)) if w.startswith(p, i) and (p.isdigit() == w[0].isdigit())]
            for k in rng.permutation(len(spots))[:3]:
                spoil(w, *spots[k])
        for read, printed in pairs:  # misreadings as they were met
            for r, p in self.words:
                at = [i for i in range(len(read)) if read.startswith(r, i) and read[:i] + p + read[i + len(r) :] == printed]
                if at:
                    spoil(printed, at[0], r, p)
        for b, y in broken:
            rows += [(b.features(), self.JOIN if y else self.KEEP), (b.features(hide=True), self.JOIN if y else self.KEEP)]
        self.net.fit(rows, 2)

    def propose(self, s: str, beam: int = 16, numeric: bool = False, within: list[str] | None = None) -> list[str]:
        """Best readings of what was printed, likeliest first; of a number those without letters put in.

        With ``within`` only readings that begin like one of these lower-case words are followed.
        """
        score = self.net.score
        rules, digits = DIGITS if numeric else self.words, _numeric(s)
        at: list[list[tuple[float, str, str, int]]] = [[] for _ in range(len(s) + 2)]
        at[0] = [(0.0, "", "k", 0)]
        for i in range(len(s)):
            states = at[i]
            if within is not None:
                states = [x for x in states if any(w.startswith(x[1].lower()) for w in within)]
            here = [(r, p) for r, p in rules if s.startswith(r, i)]
            feats = {d: _editor_features(s, i, d, digits) for d in {x[2] for x in states}}
            keep = {d: score(f, self.KEEP) for d, f in feats.items()}
            put = {(d, p): score(f, self._put[p]) for d, f in feats.items() for _, p in here}
            drop = score(_editor_features(s, i + 1, "x", digits), self.DROP) if any(len(r) == 2 for r, _ in here) else 0.0
            for total, out, done, edits in sorted(states, reverse=True)[:beam]:
                at[i + 1].append((total + keep[done], out + s[i], "k", edits))
                for r, p in here:
                    at[i + len(r)].append((total + put[done, p] + (drop if len(r) == 2 else 0.0), out + p, "x", edits + 1))
        return [o for _, o, _, e in sorted(at[len(s)], reverse=True)[:beam] if e]

    def number(self, tok: str) -> str | None:
        """The number printed where letters were read for digits, or None."""
        digits = any(c.isdigit() for c in tok)
        if digits and all(c in "OlIS" for c in tok if c.isalpha()) or (not digits and "." in tok and _NUMERIC.fullmatch(tok)):
            ok = [p for p in self.propose(tok, numeric=True) if not any(c.isalpha() for c in p)]
            if ok and _PLAIN_NUMBER.fullmatch(ok[0]):
                return ok[0]
        return None

    def repair(self, tok: str, mates: list[str]) -> str | None:
        """The one of the words ``mates``, look-alikes far more common, that was printed where ``tok`` was read, or None.

        A capital form is borne out by its lower-case form.
        """
        low = {m.lower() for m in mates}
        got = self.propose(tok, within=sorted(low))
        for p in got:
            if p in mates:
                return p
        return next((p for p in got if p.lower() in low), None)

    def joins(self, b: Break) -> bool:
        f = b.features()
        return self.net.score(f, self.JOIN) > self.net.score(f, self.KEEP)


# --- repairs of words and joins of broken ones, as tables


def _folded(words: DataFrame, editor: Editor) -> DataFrame:
    return words.select("*", editor.folding.column(F.col("word")).alias("fold"))


def with_mates(tokens: DataFrame, words: DataFrame, editor: Editor) -> DataFrame:
    """``(word, mates)`` of the ``tokens(word, n)`` that have far commoner look-alikes among ``words(word, n)``."""
    lexicon = _folded(words.filter((F.col("n") >= LEAST_COUNT) & ~F.col("word").rlike(r"\d")), editor).select("fold", F.col("word").alias("mate"), F.col("n").alias("m"))
    least = F.greatest(F.lit(LEAST_COUNT), F.when(F.col("n") < 3, FACTORS[0] * F.col("n")).otherwise(FACTORS[1] * F.col("n")))
    met = _folded(tokens, editor).join(lexicon, "fold").filter((F.col("m") >= least) & (F.lower("mate") != F.lower("word")))
    return met.groupBy("word").agg(F.array_sort(F.collect_list("mate")).alias("mates"))  # spellings of one fold


_LOOKS_NUMERIC = r"^(?=.*\d)[^\p{L}]*([OlIS]+[^\p{L}]*)+$|^[OlI.–()\-×]{2,}$"


def repairs(tokens: DataFrame, mates: DataFrame, kept) -> DataFrame:
    """``(word, printed)`` of the misread ones of the distinct ``tokens(word)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        editor: Editor = kept.value
        for pdf in batches:
            out = []
            for w, m in zip(pdf["word"], pdf["mates"]):
                printed = editor.number(w) if m is None else editor.repair(w, list(m))
                if printed:
                    out.append((w, printed.strip(_EDGE)))
            yield pd.DataFrame(out, columns=["word", "printed"])

    numeric = tokens.filter(F.col("word").rlike(_LOOKS_NUMERIC)).select("word", F.lit(None).cast("array<string>").alias("mates"))
    both = mates.join(numeric.select("word"), "word", "left_anti").unionByName(numeric)
    return both.mapInPandas(run, "word string, printed string")


def repaired_words(tokens: DataFrame, words: DataFrame, kept, mates: DataFrame | None = None) -> DataFrame:
    """``(word, printed)`` of ``tokens(word, n)``; a word with hyphens is repaired as a whole or else part by part."""
    editor: Editor = kept.value
    parts = tokens.filter(F.col("word").rlike("[^-]-[^-]")).select("word", F.split(F.btrim("word", F.lit("-")), "-").alias("parts"))
    loose = parts.select(F.explode("parts").alias("word")).filter("word <> ''").distinct().join(tokens.select("word"), "word", "left_anti").join(words, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))
    loose, _ = materialize(loose, "parts")
    every = tokens.select("word", "n").unionByName(loose)
    own = with_mates(tokens, words, editor) if mates is None else mates
    whole, _ = materialize(repairs(every.select("word"), own.unionByName(with_mates(loose, words, editor)), kept), "repairs")
    told = parts.join(whole.select("word"), "word", "left_anti").select("word", F.posexplode("parts").alias("k", "part"))
    fixed = told.join(whole.select(F.col("word").alias("part"), "printed"), "part", "left")
    built = fixed.groupBy("word").agg(F.count("printed").alias("some"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", F.coalesce("printed", "part").alias("p")))), lambda x: x["p"]), "-").alias("printed")).filter("some > 0")
    direct = whole.join(loose.select("word"), "word", "left_anti")
    return direct.unionByName(built.select("word", "printed"))


def break_counts(breaks: DataFrame, words: DataFrame) -> DataFrame:
    """``(left, mark, right, whole, own, last, first)`` of the distinct ``breaks(left, mark, right)``: counts of the forms, whatever the letter case."""
    form = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("form"))
    forms = F.array(form("whole", F.concat("left", "right")), form("own", F.concat_ws("-", "left", "right")), form("last", F.element_at(F.split("left", "-"), -1)), form("first", F.element_at(F.split("right", "-"), 1)))
    asked = breaks.select("left", "mark", "right", F.explode(forms).alias("f")).select("left", "mark", "right", "f.role", F.lower("f.form").alias("form"))
    known = words.groupBy(F.lower("word").alias("form")).agg(F.max("n").alias("n"))
    got = asked.join(known, "form", "left")
    of = lambda r: F.coalesce(F.max(F.when(F.col("role") == r, F.col("n"))), F.lit(0)).alias(r)
    return materialize(got.groupBy("left", "mark", "right").agg(of("whole"), of("own"), of("last"), of("first")), "break-counts")[0]


def joined_breaks(counted: DataFrame, words: DataFrame, kept) -> DataFrame:
    """``(left, mark, right, printed)``: the whole word of a break, null where the hyphen is the word's own."""
    forms = counted.select(F.explode(F.array(F.concat("left", "right"), F.concat_ws("-", "left", "right"))).alias("word")).distinct()
    forms, _ = materialize(forms.join(words, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n")), "forms")
    fixed, _ = materialize(repaired_words(forms, words, kept), "form-repairs")
    a = fixed.select(F.col("word").alias("w"), F.col("printed").alias("fix_whole"))
    b = fixed.filter("printed like '%-%'").select(F.col("word").alias("o"), F.col("printed").alias("fix_own"))
    rows = counted.withColumn("w", F.concat("left", "right")).withColumn("o", F.concat_ws("-", "left", "right")).join(a, "w", "left").join(b, "o", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        editor: Editor = kept.value
        for pdf in batches:
            out = []
            for l, m, r, whole, own, last, first, fw, fo in zip(*[pdf[c] for c in ("left", "mark", "right", "whole", "own", "last", "first", "fix_whole", "fix_own")]):
                b = Break((l, m, r, (whole, own, last, first, bool(fw), bool(fo))))
                out.append((l, m, r, (fw or l + r) if editor.joins(b) else None))
            yield pd.DataFrame(out, columns=["left", "mark", "right", "printed"])

    return rows.mapInPandas(run, "left string, mark string, right string, printed string")


# --- rows and their places


def quiet_lines(net: Perceptron) -> frozenset:
    """``(end, length, alone)`` of which the tagger says text whatever else such a line is, if it stands on one page, within it, without a dash and without digits at its ends."""
    two = (False, True)
    out = []
    for end in (*sorted(_ENDS), ")", "o"):
        for length in range(7):
            for alone in two:
                rest = itertools.product(two, two, two, two, two)
                if not any(net.best(line_features((False, False, False, False, end, caps, upper, prose, caption, False, length), 0, "-", False, False, alone, heading)) for caps, upper, prose, caption, heading in rest):
                    out.append((end, length, alone))
    return frozenset(out)


class Reader:
    """The furniture tagger and the words that need no look-up."""

    def __init__(self, furniture: Perceptron, folding: Folding, common: frozenset = frozenset()):
        self.furniture, self.folding, self.common = furniture, folding, common
        self.quiet = quiet_lines(furniture)
        self._classes: dict[tuple, int] = {}
        self._places: dict[int, int] = {}
        self._asked = _Asked(common)

    def __getstate__(self):
        return self.__dict__ | {"_classes": {}, "_places": {}, "_asked": _Asked(self.common)}

    def line_class(self, s: str, pages: int, page: float, offset: float, first: bool, last: bool, alone: bool, section: str | None) -> int:
        """0 text, 1 running header, 2 page number."""
        if pages < 2 and not first and not last and s[-1] not in _DIGITISH and s[0] not in _DIGITISH and "—" not in s and (_line_end(s), min(len(s) // 15, 6), alone) in self.quiet and line_number(s) is None:
            return 0
        shape = line_shape(s)
        heading = section is not None and self.folding.fold(s) == section
        place = (shape, min(pages, 3), _gap(s, page, offset) if shape[0] else "-", first, last, alone, heading)
        k = self._classes.get(place)
        if k is None:
            k = self._classes[place] = self.furniture.best(line_features(*place))
        return 0 if k and (k == 2) != shape[0] else k

    def place_class(self, code: int) -> int:
        """The same of a line whose place is numbered."""
        k = self._places.get(code)
        if k is None:
            place = place_of(code)
            k = self.furniture.best(line_features(*place))
            k = self._places[code] = 0 if k and (k == 2) != place[0][0] else k
        return k

    def read(self, value: str, places: list[int], section: str | None) -> dict:
        """Furniture, words to look up and broken words of one value, and what joining paragraphs needs to know of it."""
        lines = [t for s in value.split("\n") if (t := s.strip())]
        section = self.folding.fold(section) if section else None
        kinds, kept = 0, []
        for s, code in zip(lines, places):
            c = self.place_class(code)
            if c:
                kinds |= c
            else:
                kept.append(s)
        if not kept:
            return {"kinds": kinds, "cls": "F", "open": False, "weak": False, "head": "", "tail": "", "mark": "", "asked": [], "breaks": [], "kept": ""}
        one, body, titled = len(kept) == 1, kept[0], False
        if one and (_CAPTION.match(body) or _TABLE_ROW.match(body) or line_number(body) is not None):
            cls = "C"
        elif one and section and self.folding.fold(body) == section:
            cls = "H"
        elif one and (len(body) < 60 and body[-1] not in ".!?,;-" and len(body.split()) <= 5 and body[:1].isupper() and _titled(body)):
            cls, titled = "H", True  # a title, or the beginning of a paragraph that goes on in lower case
        else:
            cls = "B"
        words, breaks, tail, mark = loose_words(kept)
        stop = _STOPPED.search(kept[-1][-24:])
        return {
            "kinds": kinds, "cls": cls, "open": titled or cls == "B" and (not stop or bool(_SHORTENED.search(kept[-1][-24:]))), "weak": bool(stop), "head": body.split(None, 1)[0], "tail": tail, "mark": mark,
            "asked": list(set(map(self._asked.__getitem__, words)) - {""}), "breaks": list({f"{a}\x01{m}\x01{b}" for a, m, b in breaks}), "kept": "\n".join(kept),
        }


class _Asked(dict):
    """Of a word as it stands in a text the part to look up, '' for numbers and the commonest words."""

    def __init__(self, common: frozenset):
        self.common = common

    def __missing__(self, raw: str) -> str:
        if len(self) > 500_000:
            self.clear()
        core = raw.strip(_EDGE) if _ALPHA.search(raw) else ""
        v = self[raw] = "" if core in self.common else core
        return v


def broken(line: str) -> str | None:
    """The part of a word before the hyphen that a line ends with, or None."""
    return line.rsplit(None, 1)[-1][:-1] if line[-1] in _HYPHENS and len(line) > 1 and line[-2].isalpha() else None


def loose_words(kept: list[str]) -> tuple[list[str], list[tuple[str, str, str]], str, str]:
    """Unbroken words of the lines, the broken ones as ``(left, mark, right)``, and an open break at the end."""
    words: list[str] = []
    breaks: list[tuple[str, str, str]] = []
    tail = mark = ""
    skip = False
    for n, s in enumerate(kept):
        own = s.split()
        if skip:
            own, skip = own[1:], False
        left = broken(s) if own else None
        if left is not None:
            own.pop()
            if n + 1 == len(kept):
                tail, mark = left.lstrip(_EDGE), s[-1]
            else:
                right = kept[n + 1].split(None, 1)[0]
                if right[:1].isalpha():
                    a, b = left.lstrip(_EDGE), right.rstrip(_EDGE)
                    if a and b:
                        breaks.append((a, s[-1], b))
                    skip = True
        words += own
    return words, breaks, tail, mark


def _titled(body: str) -> bool:
    """A short line that looks like a heading or a name on its own."""
    words = [w for w in body.split() if w[:1].isalpha()]
    return bool(words) and not any(c.isdigit() for c in body) and "×" not in body and "(" not in body


def facts(source: DataFrame, evidence: DataFrame) -> DataFrame:
    """``(section_id, pages, offset, first, last)`` of every row.

    ``pages`` holds every line of the row whose key stands on two or more pages of its article, and on how many;
    ``first`` and ``last`` tell whether the row is at the edge of its page.
    """
    seen = evidence.filter("line is not null").select("section_id", "line_no", "page", "line")
    keyed = seen.filter("page is not null").groupBy("line", "page").agg(F.count("*").alias("n"))
    counts, _ = materialize(keyed.groupBy("line").agg(F.count("*").alias("pages"), F.sum("n").alias("n")).filter("pages >= 2"), "line-pages")
    met = salted_join(seen.select("section_id", "line_no", "line"), counts.select("line", "pages"), "line", hot_keys(counts, "line", "n"), F.col("section_id"))
    heads = met.groupBy("section_id").agg(F.array_join(F.collect_list(F.concat_ws(":", "line_no", "pages")), " ").alias("pages"))  # lines of one row
    offs = evidence.filter("offset is not null").groupBy("doc_id", "offset").agg(F.sum("n").alias("n")).groupBy("doc_id").agg(F.max_by("offset", F.struct("n", F.col("offset").cast("string"))).alias("offset"), F.max("n").alias("n"))
    known = offs.filter("n >= 2").select("doc_id", "offset")
    page_key = F.concat_ws("\x03", "doc_id", F.col("pdf_page").cast("string"))
    rows = source.filter(F.col("value").rlike(r"\S")).select("section_id", "doc_id", "pdf_page", "paragraph_number", page_key.alias("page_key"))
    on_page = lambda c: F.when(F.col("doc_id").isNotNull() & F.col("pdf_page").isNotNull(), c)
    pages = rows.groupBy("page_key").agg(F.min(on_page(F.col("doc_id"))).alias("doc_id"), F.min(on_page(F.col("paragraph_number"))).alias("top"), F.max(on_page(F.col("paragraph_number"))).alias("foot"), F.count("*").alias("n"))
    pages, _ = materialize(pages.join(known, "doc_id", "left"), "pages")
    placed = salted_join(rows.select("section_id", "paragraph_number", "page_key"), pages.select("page_key", "top", "foot", "offset"), "page_key", hot_keys(pages, "page_key", "n"), F.col("section_id"), "left")
    at = lambda c: F.coalesce(F.col("paragraph_number") == F.col(c), F.lit(False))
    return placed.select("section_id", "offset", at("top").alias("first"), at("foot").alias("last")).join(heads, "section_id", "left")


def _offset(printed: float, page: float, offset: float) -> float:
    return printed - page if printed == printed and page == page else offset


def _pages(h: str | None) -> dict[int, int]:
    return {int(n): int(p) for n, p in (x.split(":") for x in h.split(" "))} if h else {}


def _numbered(folding: Folding, schema: list[str]):
    """Rows with ``places`` of their lines that are not blank: what the features depend on, times 4, plus what the line teaches."""
    nan = float("nan")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[tuple, int] = {}
        folded = _Folded(folding)
        for batch in batches:
            every = []
            for value, page, printed, section, h, off, first, last in zip(*[batch.column(c).to_pylist() for c in ("value", "pdf_page", "empirical_page_number", "section_name", "pages", "offset", "first", "last")]):
                page, printed, off = (nan if x is None else x for x in (page, printed, off))
                offset = _offset(printed, page, off)
                known, section = _pages(h), folded[section] if section else None
                lines = [(n, t) for n, s in enumerate(value.split("\n")) if (t := s.strip())]
                end, alone, out = len(lines) - 1, len(lines) == 1, []
                for k, (n, t) in enumerate(lines):
                    shape = line_shape(t)
                    gap = _gap(t, page, offset) if shape[0] else "-"
                    pages = known.get(n, 0)
                    heading = section is not None and len(t) <= len(section) and folding.fold(t) == section  # folding shortens no line
                    place = (shape, min(pages, 3), gap, first is True and k == 0, last is True and k == end, alone, heading)
                    code = codes.get(place)
                    if code is None:
                        code = codes[place] = 4 * place_code(*place)
                    out.append(code + (taught(t, shape, pages, gap, alone, heading) if gap != "-" or alone or pages >= 2 else 0))
                every.append(out)
            cols = {c: batch.column(c) for c in batch.schema.names} | {"places": pa.array(every, pa.list_(pa.int32()))}
            yield pa.RecordBatch.from_arrays([cols[c] for c in schema], names=list(schema))

    return run


class _Folded(dict):
    """Folded names of sections."""

    def __init__(self, folding: Folding):
        self.folding = folding

    def __missing__(self, name: str) -> str:
        if len(self) > 100_000:
            self.clear()
        v = self[name] = self.folding.fold(name)
        return v


def fit_furniture(placed: DataFrame) -> Perceptron:
    """The tagger, from all lines, counted by their place and what they teach: as many rows as there are kinds of places.

    In an epoch the places are visited about ``VISITS`` times in all, each in proportion to its lines but once at least.
    Where one place teaches different things, the corrections keep the proportion of their lines.
    """
    counted = placed.select(F.explode("places").alias("place")).groupBy("place").agg(F.count("*").alias("n")).collect()
    met: Counter = Counter()
    for code, n in counted:
        place, y = divmod(code, 4)
        if y != UNTAUGHT:
            met[place, y] += n
            if y == 1:  # the same header in an article of one page
                shape, _, *rest = place_of(place)
                met[place_code(shape, 0, *rest), y] += n
    train, steps, every = [], [], sum(met.values())
    most: Counter = Counter()
    for (place, _), n in met.items():
        most[place] = max(most[place], n)
    for (place, y), n in sorted(met.items()):
        share = VISITS * n / min(every, VISITS * most[place])  # of a rare place, that of the rarer lesson to the commoner
        times = max(1, round(share))
        train += [(line_features(*place_of(place)), y)] * times
        steps += [share / times] * times
    net = Perceptron(["text", "header", "number"])
    net.fit(train, 5, steps=steps)
    return net


def train_editor(words: DataFrame, mates: DataFrame, counted: DataFrame, misreadings: list, pairs: DataFrame) -> Editor:
    """The editor, from all common words without a far commoner look-alike, all misread words and all broken words that the corpus knows in one form.

    The examples are put in blocks of about ``EXAMPLES`` by their hash. An editor is trained on each, and a weight is
    its mean over the editors that met its feature.
    """
    clean = words.filter((F.col("n") >= 8) & (F.length("word") >= 2) & ~F.col("word").rlike(r"\d")).join(mates.select("word"), "word", "left_anti")
    cols = {"kind": F.lit(0), "a": F.lit(""), "m": F.lit(""), "b": F.lit(""), "n": F.lit(0).cast("long"), "own": F.lit(0).cast("long"), "last": F.lit(0).cast("long"), "first": F.lit(0).cast("long")}
    rows = lambda df, **given: df.select(*[(given[c] if c in given else v).alias(c) for c, v in cols.items()])
    c = F.col
    examples = rows(clean, kind=F.lit(1), a=c("word"), n=c("n")).unionByName(rows(pairs, kind=F.lit(2), a=c("word"), b=c("whole")))
    examples = examples.unionByName(rows(counted.filter("whole <> own"), kind=F.lit(3), a=c("left"), m=c("mark"), b=c("right"), n=c("whole"), own=c("own"), last=c("last"), first=c("first")))
    examples, _ = materialize(examples, "examples")
    blocks = 1 + examples.count() // EXAMPLES
    numbers = rows(examples.sparkSession.range(blocks), n=c("id")).withColumn("block", c("n").cast("int"))  # every block learns numbers
    blocked = examples.withColumn("block", F.pmod(F.xxhash64("kind", "a", "m", "b"), F.lit(blocks)).cast("int")).unionByName(numbers)
    editor = Editor(misreadings)

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        own = Editor(misreadings)
        pdf = pdf.sort_values(["kind", "n", "a", "m", "b"], ascending=[True, False, True, True, True])
        of = {k: g for k, g in pdf.groupby("kind")}
        common = of[1]["a"].tolist() if 1 in of else []
        shown = list(zip(of[2]["a"], of[2]["b"])) if 2 in of else []
        breaks = []
        if 3 in of:
            g = of[3]
            for a, m, b, whole, kept, last, first in zip(*[g[x].tolist() for x in ("a", "m", "b", "n", "own", "last", "first")]):
                y = whole > kept
                breaks.append((Break((a, m, b, (whole, kept, last, first, False, False))), y))
                if xxhash.xxh3_64_intdigest(f"{a}{m}{b}") % 7 == 0:  # a break whose forms the corpus does not know but for a misreading of one
                    breaks.append((Break((a, m, b, (0, 0, last, first, y, not y))), y))
        own.train(common, shown, breaks)
        return pd.DataFrame({"feature": list(own.net.lists), "weights": list(own.net.lists.values())})

    trained = blocked.groupBy("block").applyInPandas(train, "feature string, weights array<double>")
    mean = F.array(*[F.avg(F.col("weights")[k]) for k in range(len(editor.net.classes))]).alias("weights")
    editor.net.lists = {r["feature"]: list(r["weights"]) for r in trained.groupBy("feature").agg(mean).collect()}
    return editor


_READ = "section_id long, doc_id string, paragraph_number int, kinds int, cls string, open boolean, weak boolean, head string, tail string, mark string, asked array<string>, breaks array<string>, kept string"


def _reading(kept, texts: bool):
    words = pa.list_(pa.string())
    kinds = {"section_id": pa.int64(), "doc_id": pa.string(), "paragraph_number": pa.int32(), "kinds": pa.int32(), "cls": pa.string(), "open": pa.bool_(), "weak": pa.bool_(), "head": pa.string(), "tail": pa.string(), "mark": pa.string(), "asked": words, "breaks": words, "kept": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: Reader = kept.value
        for batch in batches:
            rows = []
            for i, doc, para, value, section, places in zip(*[batch.column(c).to_pylist() for c in ("section_id", "doc_id", "paragraph_number", "value", "section_name", "places")]):
                if places:
                    g = reader.read(value, [x // 4 for x in places], section)
                    rows.append((i, doc, para, g["kinds"], g["cls"], g["open"], g["weak"], g["head"], g["tail"], g["mark"], g["asked"], g["breaks"], g["kept"] if texts else None))
            cols = list(zip(*rows)) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values())], names=list(kinds))

    return run


def _next_rows(read: DataFrame) -> DataFrame:
    """Open rows with the class and first word of the next row that is no furniture and no caption."""
    flow = read.filter("cls in ('B', 'H') and doc_id is not null and paragraph_number is not null").select("section_id", "doc_id", "paragraph_number", "cls", "open", "weak", "head", "tail", "mark", F.floor(F.col("paragraph_number") / BLOCK).alias("block"))
    after = Window.partitionBy("doc_id", "block").orderBy("paragraph_number").rangeBetween(1, Window.unboundedFollowing)
    nxt = F.min_by(F.struct("cls", "head", "paragraph_number"), F.struct("paragraph_number", "section_id"))
    placed = flow.withColumn("next", F.first(F.struct("cls", "head", "paragraph_number")).over(after))
    firsts = flow.groupBy("doc_id", "block").agg(nxt.alias("first"))
    later = firsts.withColumn("later", F.lead("first").over(Window.partitionBy("doc_id").orderBy("block"))).select("doc_id", "block", "later")  # one row per BLOCK paragraphs
    return placed.filter("open").join(later, ["doc_id", "block"], "left").withColumn("next", F.coalesce("next", "later"))


def _follow(read: DataFrame) -> DataFrame:
    """Rows whose paragraph goes on: ``(section_id, doc_id, paragraph_number, next_number, left, mark, right)``, left null where no word is broken."""
    nxt = _next_rows(read).filter("next is not null and next.cls = 'B'").withColumn("start", F.ltrim(F.col("next.head"), F.lit("(\"'«„“[")))
    low = F.col("start").rlike(r"^(\p{Ll}|[^\p{L}]|$)")
    goes = nxt.filter((~F.col("weak") | low) & ((F.col("cls") != "H") | F.col("start").rlike(r"^\p{Ll}")))
    right = F.rtrim(F.col("next.head"), F.lit(_EDGE))
    whole = (F.col("tail") != "") & (right != "")
    return goes.select("section_id", "doc_id", "paragraph_number", F.col("next.paragraph_number").alias("next_number"), F.when(whole, F.col("tail")).alias("left"), "mark", F.when(whole, right).alias("right"))


class Scan:
    """All that is known of the rows after one reading: tables ``read``, ``follow``, ``joins`` of broken words and ``fixed`` words."""

    def __init__(self, sections: DataFrame, texts: bool = False):
        spark = sections.sparkSession
        source = sections.select("section_id", "doc_id", "value", "paragraph_number", "pdf_page", "empirical_page_number", "section_name").filter("value is not null")
        words, _ = materialize(source.select("value").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
        misreadings, pairs = learned(words)
        folding = Folding(misreadings)
        evidence, _ = materialize(source.mapInArrow(_evidence(folding), _SEEN), "evidence")
        editor = Editor(misreadings)
        mates, _ = materialize(with_mates(words, words, editor), "mates")
        quiet = words.filter(~F.col("word").rlike(_LOOKS_NUMERIC) & ~F.col("word").contains("-")).orderBy(F.desc("n"), "word").limit(2 * COMMON).join(mates.select("word"), "word", "left_anti")
        clean = frozenset(r["word"] for r in quiet.orderBy(F.desc("n"), "word").limit(COMMON).collect())  # at most COMMON words
        joined = source.join(facts(source, evidence), "section_id", "left")
        kept_cols = ["section_id", "doc_id", "value", "paragraph_number", "section_name", "places"]
        joined, _ = materialize(joined.mapInArrow(_numbered(folding, kept_cols), "section_id long, doc_id string, value string, paragraph_number int, section_name string, places array<int>"), "with-places")
        reader = spark.sparkContext.broadcast(Reader(fit_furniture(joined), folding, clean))  # bounded: weights and COMMON words
        self.read, _ = materialize(joined.mapInArrow(_reading(reader, texts), _READ), "read")
        self.follow, _ = materialize(_follow(self.read), "follow")
        of = lambda k: F.split_part("b", F.lit("\x01"), F.lit(k))
        self.breaks = self.read.select("section_id", F.explode("breaks").alias("b")).select("section_id", of(1).alias("left"), of(2).alias("mark"), of(3).alias("right"))
        distinct = self.breaks.select("left", "mark", "right").unionByName(self.follow.filter("left is not null").select("left", "mark", "right")).distinct()
        counted = break_counts(distinct, words)
        kept = spark.sparkContext.broadcast(train_editor(words, mates, counted, misreadings, pairs))  # bounded: weights
        self.joins, _ = materialize(joined_breaks(counted, words, kept), "joins")
        self.fixed, _ = materialize(repaired_words(words, words, kept, mates), "fixed")
        self.asked = self.read.select("section_id", F.explode("asked").alias("word"))

    def words(self) -> DataFrame:
        """``(section_id, word, printed)`` of the misread words of every row."""
        return self.asked.join(self.fixed, "word")

    def within(self) -> DataFrame:
        """``(section_id, left, mark, right, printed)`` of the words broken within a row."""
        return self.breaks.join(self.joins, ["left", "mark", "right"])

    def across(self) -> DataFrame:
        """Rows that go on, with the whole word where one is broken."""
        return self.follow.join(self.joins, ["left", "mark", "right"], "left")


def scan_cases(sections: DataFrame) -> DataFrame:
    """``(section_id, kind, repaired)`` of all cases, distinct."""
    s = Scan(sections)
    case = lambda df, kind, repaired: df.select("section_id", F.lit(kind).alias("kind"), repaired.alias("repaired"))
    plain = F.btrim("printed", F.lit(_EDGE))
    every = case(s.read.filter("kinds & 1 = 1"), "running_header", F.lit("")).union(case(s.read.filter("kinds & 2 = 2"), "page_number", F.lit(""))).union(case(s.words(), "ocr", plain))
    hyphens = case(s.within().filter("printed is not null"), "hyphen", plain)
    across = s.across().select("section_id", F.explode(F.array(F.struct(F.lit("continues").alias("kind"), F.lit("").alias("repaired")), F.struct(F.lit("hyphen").alias("kind"), plain.alias("repaired")))).alias("c")).select("section_id", "c.*").filter("repaired is not null")
    return every.union(hyphens).union(across).distinct()


# --- repaired text


def clean_lines(kept: str, words: dict[str, str], joins: dict[tuple[str, str, str], str | None]) -> str:
    """Lines without furniture as one text: broken words joined, misread ones replaced."""

    def fix(raw: str) -> str:
        core = raw.strip(_EDGE)
        got = words.get(core)
        return raw.replace(core, got, 1) if got else raw

    out: list[str] = []
    lines = kept.split("\n")
    skip = False
    for n, s in enumerate(lines):
        own = s.split()
        if skip:
            own, skip = own[1:], False
        left = broken(s) if own and n + 1 < len(lines) else None
        if left is None:
            out += map(fix, own)
            continue
        own.pop()
        out += map(fix, own)
        right = lines[n + 1].split(None, 1)[0]
        if not right[:1].isalpha():
            out.append(f"{left}{s[-1]}")
            continue
        a, b = left.lstrip(_EDGE), right.rstrip(_EDGE)
        whole = joins.get((a, s[-1], b)) or f"{a}-{b}"
        out.append(f"{left[: len(left) - len(a)]}{whole}{right[len(b) :]}")
        skip = True
    return " ".join(out)


def _cleaner(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for kept, w, j in zip(pdf["kept"], pdf["w"], pdf["j"]):
            words = {x["word"]: x["printed"] for x in w} if w is not None else {}
            joins = {(x["left"], x["mark"], x["right"]): x["printed"] for x in j} if j is not None else {}
            out.append(clean_lines(kept, words, joins))
        yield pd.DataFrame({"section_id": pdf["section_id"], "doc_id": pdf["doc_id"], "paragraph_number": pdf["paragraph_number"], "cls": pdf["cls"], "text": out}).astype({"paragraph_number": "Int32"})


def joined_text(pieces: list[dict]) -> str:
    """Pieces of one paragraph in order; a word broken between two is whole again, or keeps its own hyphen."""
    out = ""
    for k, p in enumerate(pieces):
        text = p["text"]
        before = pieces[k - 1] if k else None
        if before is None:
            out = text
        elif before["left"] is None:
            out = f"{out} {text}"
        else:
            head, _, rest = text.partition(" ")
            b = head.rstrip(_EDGE)
            whole = before["printed"] or f"{before['left']}-{b}"
            cut = len(before["left"]) + 1
            out = f"{out[:-cut]}{whole}{head[len(b) :]}{' ' if rest else ''}{rest}"
    return out


def _paragraph_texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "paragraph_no": pdf["paragraph_no"], "n_rows": [len(p) for p in pdf["pieces"]], "text": [joined_text(list(p)) for p in pdf["pieces"]]})


def paragraphs(sections: DataFrame) -> DataFrame:
    """``(doc_id, paragraph_no, n_rows, text)``: every article as continuous paragraphs.

    Furniture is gone, lines are joined, broken and misread words repaired, paragraphs that go on in later rows
    joined. ``paragraph_no`` is the number of the first row; captions and headings are paragraphs of their own.
    Rows without article or number are left out, of rows of one number the one loaded first stands.
    """
    s = Scan(sections, texts=True)
    rows = s.read.filter("cls <> 'F' and doc_id is not null and paragraph_number is not null")
    one = rows.groupBy("doc_id", "paragraph_number").agg(F.min("section_id").alias("section_id"))
    own = rows.select("section_id", "doc_id", "paragraph_number", "cls", "kept").join(one.select("section_id"), "section_id", "left_semi")
    w = s.words().groupBy("section_id").agg(F.collect_list(F.struct("word", "printed")).alias("w"))  # words of one row
    j = s.within().groupBy("section_id").agg(F.collect_list(F.struct("left", "mark", "right", "printed")).alias("j"))
    clean, _ = materialize(own.join(w, "section_id", "left").join(j, "section_id", "left").mapInPandas(_cleaner, "section_id long, doc_id string, paragraph_number int, cls string, text string"), "clean-rows")
    goes = s.across().select("section_id", "next_number", "left", "printed")
    # the rows of the text in order; a paragraph begins where no earlier row goes on to
    placed, _ = materialize(clean.join(goes, "section_id", "left"), "placed-rows")
    follows = placed.filter("next_number is not null").select("doc_id", F.col("next_number").alias("paragraph_number"), F.lit(False).alias("begins")).distinct()
    marked = placed.join(follows, ["doc_id", "paragraph_number"], "left").withColumn("begins", F.coalesce("begins", F.lit(True)) | ~F.col("cls").isin("B", "H"))
    flow = marked.filter("cls in ('B', 'H')").withColumn("block", F.floor(F.col("paragraph_number") / BLOCK))
    before = Window.partitionBy("doc_id", "block").orderBy("paragraph_number").rowsBetween(Window.unboundedPreceding, 0)
    start = F.when(F.col("begins"), F.col("paragraph_number"))
    numbered = flow.withColumn("head", F.last(start, ignorenulls=True).over(before))
    ends = flow.groupBy("doc_id", "block").agg(F.max(start).alias("head"))
    carried = ends.withColumn("carried", F.last("head", ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).select("doc_id", "block", "carried")  # one row per BLOCK paragraphs
    whole = numbered.join(carried, ["doc_id", "block"], "left").withColumn("paragraph_no", F.coalesce("head", "carried", "paragraph_number"))
    rest = marked.filter("cls not in ('B', 'H')").withColumn("paragraph_no", F.col("paragraph_number"))
    cols = ["doc_id", "paragraph_no", "paragraph_number", "text", "left", "printed"]
    pieces = whole.select(*cols).unionByName(rest.select(*cols)).groupBy("doc_id", "paragraph_no").agg(F.array_sort(F.collect_list(F.struct("paragraph_number", "text", "left", "printed"))).alias("pieces"))  # rows of one paragraph
    return pieces.mapInPandas(_paragraph_texts, "doc_id string, paragraph_no int, n_rows int, text string")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_cases(table(spark, sf_dir, "sections"))


def p4_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repaired paragraphs of every article."""
    return paragraphs(table(spark, sf_dir, "sections"))
