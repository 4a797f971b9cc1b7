"""Sentence boundaries across languages and scripts (problem 7).

Every character of a text is tagged as boundary or inside by a linear-chain model (an
averaged structured perceptron with learned transitions) and Viterbi decoding. A character
that is no terminator is inside by definition, so the chain runs over terminators only.
Its features are the token before, its shape and how often that token ends a paragraph or is
followed by lower case, the white space, closing marks, open quotation or bracket, and
the word after. Paragraphs without any terminator in a script without word spaces go to a
second chain over all characters, trained on sentences whose punctuation was stripped.

The statistics are counts over all texts. Labels come from a teacher that decides by them and by
lists of fixed abbreviations. Both chains are trained on all texts: in blocks of about ``SAMPLE``
rows by the hash of their id, and a weight is its mean over the blocks that met its feature.
Terminators are looked for once and kept, with all that their features depend on, in a table.

Defined cases: an empty line always ends a sentence, a single line break never does; a
semicolon or colon never does; a quotation belongs to the sentence around it; null, empty
and blank texts have no sentence; an unclosed quotation mark is ordinary text; equal rows
give equal sentences; extra columns are ignored.
"""

from __future__ import annotations

import marshal
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.sampling import hashed_sample
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

#: Rows of a block that a model is trained on.
SAMPLE = 6000
EPOCHS = 4

#: Abbreviations that are followed by a capital within a sentence.
BEFORE_CAPITAL = frozenset(
    "leg det coll cf vgl z St Mt Dr Prof Mr Mrs Ms Sr Sra Jr ed eds Fr Herr u d ü v t т ср см собр опр им ул г-н comm pers auct sensu aff nr Nr no No Fig fig Figs figs Abb Taf Tab Pl pl Bd Vol vol p pp S n № рис табл стр véase ver Abt Hrsg bzw usw evtl ggf Mme M Mlle Sta Sto Ft".split()
)
#: Abbreviations that are followed by a number or lower case within a sentence.
BEFORE_OTHER = frozenset(
    "ca approx aprox alt var subsp ssp f e g i excl incl env ок т выс ур г др Jan Febr Feb March Apr Aug Sept Sep Oct Nov Dec Nr No no Fig fig Abb рис p n s min diam max ibid et al u a d h z B cf vgl".split()
)
_BREAK = re.compile(r"\n[^\S\n]*\n\s*")
_CAND = re.compile(r"((?:\.(?!\d)|[!?…])+|[。！？｡।॥．]+)([)\]}\"'»”’“」』）]*)(\s*)(?=([(\[\"'«„“「『（]*)(\d|[^\W\d_]*)(\S?))")
_NOT_TOKEN = frozenset(" \n\t\r\f\v\u00a0\u3000.!?…。！？｡।॥．,，、:：;；")
_SPAN = re.compile(r'"[^"]*"|«[^«»]*»|„[^“”„]*[“”]|“[^”“]*”|「[^」]*」|『[^』]*』|\([^()]*\)|（[^（）]*）|\[[^\[\]]*\]')
_WIDE_END = frozenset("。！？｡।॥．")
_NO_SPACE = re.compile(r"[฀-໿က-႟ក-៿぀-ヿ㐀-鿿]")
_LAST_WIDE = re.compile(r".*[぀-ヿ㐀-鿿]")
_STRIP = re.compile(r"[^\w]+")


def _paragraphs(text: str) -> list[tuple[int, int]]:
    out, at = [], 0
    for m in _BREAK.finditer(text):
        out.append((at, m.start()))
        at = m.end()
    out.append((at, len(text)))
    return [(a, b) for a, b in out if text[a:b].strip()]


def _token(raw: str) -> str:
    """Kind of the token before a terminator: itself for words, a class for numbers and bracketed ends."""
    t = raw.lstrip("([\"'«„“「（")
    if not t:
        return "<none>"
    if t[-1].isdigit():
        return "<num>"
    if t[-1] in ")]}":
        return "<close>"
    wide = None if t.isascii() else _LAST_WIDE.match(t)
    return t[wide.end() :] if wide and wide.end() < len(t) else t[-14:]


def _next_kind(word: str, char: str) -> str:
    if word:
        return "d" if word[0].isdigit() else "U" if word[0].isupper() else "l" if word[0].islower() else "o"
    return char or "end"


def candidates(text: str) -> list[tuple[int, tuple]]:
    """``(start of what follows, key)`` of each terminator; key is all that the features depend on."""
    out = []
    spans: list[tuple[int, int]] | None = None
    k = 0
    for m in _CAND.finditer(text):
        punct, close, gap, opener, word, char = m.groups()
        end, first = m.end(1), m.start()
        lo = at = max(0, first - 15)
        for i in range(first - 1, lo - 1, -1):
            if text[i] in _NOT_TOKEN:
                at = i + 1
                break
        if spans is None:
            spans = [s.span() for s in _SPAN.finditer(text)]
        while k < len(spans) and spans[k][1] < end:
            k += 1
        within = inner = False
        if k < len(spans) and spans[k][0] < end:
            within = end < spans[k][1] - len(close)
            inner = end <= spans[k][1] - 1 and not within
        g = "" if not gap else "n" if "\n" in gap else " "
        dotted = at > 0 and text[at - 1] == "."
        out.append((m.end(3), (_token(text[at:first]), punct[-1], "q" if inner and close else close[:1], g, bool(opener), word[:12], char if not word else "", within, dotted)))
    return out


def parsed(text: str) -> list[tuple]:
    """Paragraphs as ``(start of the text, first word, candidates, part)``; part is the text of those left to the chain over characters."""
    out = []
    for a, b in _paragraphs(text):
        part = text[a:b]
        cand = candidates(part)
        first = _FIRST.match(part)
        bare = not cand and len(_NO_SPACE.findall(part)) * 2 > len(part)
        out.append((a + len(part) - len(part.lstrip()), first.group(1) if first else "", [(a + at, k) for at, k in cand if at < len(part)] + [(-1, k) for at, k in cand if at >= len(part)], (a, part) if bare else None))
    return out


_FIRST = re.compile(r"\W*([^\W\d_]+)")


class Statistics:
    """How tokens before a period and words after a sure boundary behave in all texts, as counts in ``SAMPLE`` rows if there are more."""

    def __init__(self, texts: list[str] = ()):
        self.n: Counter = Counter()
        self.ends: Counter = Counter()
        self.low: Counter = Counter()
        self.starters: Counter = Counter()
        for text in texts:
            self.add(parsed(text))

    def add(self, paragraphs: list[tuple]) -> None:
        for _, first, cand, _ in paragraphs:
            if first:
                self.starters[first] += 1
            for _, (tok, p, _c, g, _o, word, char, within, _d) in cand:
                if within:
                    continue
                if p in "!?" and word[:1].isupper():
                    self.starters[word] += 1
                if p == ".":
                    self.n[tok] += 1
                    kind = _next_kind(word, char)
                    if kind == "end" or g == "n":
                        self.ends[tok] += 1
                    if kind == "l" and g == " ":
                        self.low[tok] += 1

    def abbreviation(self, tok: str, dotted: bool) -> bool:
        """Whether a capital after this token goes on with the sentence."""
        n, ends = self.n.get(tok, 0), self.ends.get(tok, 0)
        if len(tok) == 1 and tok.isalpha() and (tok.isupper() or ends < 0.5):
            return True
        if dotted and not tok.startswith("<") and ends < 0.02 * n + 1:
            return True
        if tok in BEFORE_CAPITAL and ends <= 0.01 * n:
            return True
        return n >= 12 and ends < 0.5

    def ending(self, tok: str) -> bool:
        n = self.n.get(tok, 0)
        return n >= 5 and self.ends.get(tok, 0) > 0.05 * n

    def low_rate(self, tok: str) -> float:
        n = self.n.get(tok, 0)
        return self.low.get(tok, 0) / n if n else 0.0

    def starts(self, word: str) -> int:
        return self.starters.get(word[:1].upper() + word[1:], 0) if word else 0


def teacher(key: tuple, st: Statistics) -> bool:
    """The label of a terminator of the training sample."""
    tok, p, close, gap, opener, word, char, within, dotted = key
    if within:
        return False
    kind = _next_kind(word, char)
    if kind == "end":
        return False
    if kind not in ("U", "l", "o", "d"):
        return p in _WIDE_END and not close
    if p in _WIDE_END:
        return not close or gap != "" or kind == "U"
    if close in ('"', "'", "»", "”", "“", "」", "』", "q"):
        return kind == "U" or (kind == "o" and gap != "")
    if p == "…":
        return kind == "U" and gap != ""
    if p in "!?":
        return kind in ("U", "o", "d")
    if kind in ("U", "o"):
        return not st.abbreviation(tok, dotted) and not (gap == "" and len(tok) < 2)
    if tok in BEFORE_OTHER or st.abbreviation(tok, dotted):
        return False
    if kind == "l":
        return gap != "" and st.low_rate(tok) < 0.15 and st.starts(word) >= 3
    return gap != "" and tok[0] != "<" and len(tok) >= 4 and st.low_rate(tok) < 0.15 and st.ending(tok)


def features(key: tuple, st: Statistics) -> list[str]:
    tok, p, close, gap, opener, word, char, within, dotted = key
    kind = _next_kind(word, char)
    wide = p in _WIDE_END
    shape = tok if tok[0] == "<" else ("I" if tok.isupper() else "i") + str(min(len(tok), 4)) if tok.isalpha() else "mix"
    abbr = st.abbreviation(tok, dotted)
    low = "lo" if st.low_rate(tok) >= 0.15 else "hi"
    start = "s" if st.starts(word) >= 3 else "-"
    other = tok in BEFORE_OTHER
    ending = st.ending(tok)
    base = f"{'W' if wide else p}|{close}|{kind if kind in ('U', 'l', 'o', 'd', 'end') else ','}"
    return [
        "bias",
        f"in{within}",
        f"b{base}",
        f"g{base}{gap}",
        f"a{abbr}{base}",
        f"t{tok}",
        f"tn{tok}|{kind}",
        f"sh{shape}|{kind}|{gap}",
        f"l{low}{other}{start}|{base}|{gap}|{abbr}",
        f"e{ending}{shape}|{base}|{low}",
        f"w{word}|{kind}",
        f"x{within}|{base}",
        f"z{opener}{kind}",
    ]


class SentenceModel:
    """Weights of the chain over terminators, of the chain over characters, and the statistics of the sample."""

    def __init__(self, st: Statistics):
        self.st = st
        self.w: dict[str, float] = {}
        self.trans = [[0.0, 0.0], [0.0, 0.0]]
        self.chars: dict[str, float] = {}
        self.char_trans = [[0.0, 0.0], [0.0, 0.0]]
        self._cache: dict[tuple, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}}

    def emission(self, key: tuple) -> float:
        v = self._cache.get(key)
        if v is None:
            if len(self._cache) > 500_000:
                self._cache.clear()
            w = self.w
            v = self._cache[key] = sum(w.get(f, 0.0) for f in features(key, self.st))
        return v


def viterbi(scores: list[float], trans: list[list[float]]) -> list[int]:
    """Best tags of a chain of two states; a score is that of tag 1, tag 0 scores 0."""
    (t00, t01), (t10, t11) = trans
    a, b, back = 0.0, -1e9, []
    for s in scores:
        x0, x1 = a + t00, b + t10
        y0, y1 = a + t01, b + t11
        back.append((x0 < x1, y0 < y1))
        a = x1 if x0 < x1 else x0
        b = (y1 if y0 < y1 else y0) + s
    tags, state = [], int(b > a)
    for i in range(len(scores) - 1, -1, -1):
        tags.append(state)
        state = int(back[i][state])
    return tags[::-1]


def _perceptron(chains: list[tuple[list[list[str]], list[int]]], epochs: int) -> dict[str, float]:
    """Weights of an averaged structured perceptron over chains of feature lists and tags: of all features, and of transitions as T00 to T11."""
    w: dict[str, float] = defaultdict(float)
    total: dict[str, float] = defaultdict(float)
    known: dict[int, float] = {}  # scores of lists under the present weights
    t = 1
    for _ in range(epochs):
        for feats, gold in chains:
            scores = []
            for fs in feats:
                v = known.get(id(fs))
                if v is None:
                    v = known[id(fs)] = sum([w[f] for f in fs])
                scores.append(v)
            guess = viterbi(scores, [[w["T00"], w["T01"]], [w["T10"], w["T11"]]])
            if guess != gold:
                step: dict[str, float] = defaultdict(float)
                for fs, g, h in zip(feats, gold, guess):
                    if g != h:
                        for f in fs:
                            step[f] += g - h
                p = q = 0
                for g, h in zip(gold, guess):
                    step[f"T{p}{g}"] += 1
                    step[f"T{q}{h}"] -= 1
                    p, q = g, h
                for f, d in step.items():
                    w[f] += d
                    total[f] += t * d
                known.clear()
            t += 1
    return {f: v - total.get(f, 0.0) / t for f, v in w.items()}


def _split(weights: dict[str, float]) -> tuple[dict, list]:
    """Weights of features that have one, and those of transitions."""
    trans = [[weights.pop("T00", 0.0), weights.pop("T01", 0.0)], [weights.pop("T10", 0.0), weights.pop("T11", 0.0)]]
    return {f: v for f, v in weights.items() if v}, trans


def _char_features(s: str, i: int) -> list[str]:
    a, b, c, d = s[i - 2 : i - 1], s[i - 1 : i], s[i : i + 1], s[i + 1 : i + 2]
    return ["c", f"1{b}", f"2{c}", f"3{a}{b}", f"4{c}{d}", f"5{b}{c}", f"6{a}{b}{c}", f"7{b}{c}{d}"]


def _chain_weights(texts: list[list[tuple]], st: Statistics, epochs: int) -> dict[str, float]:
    """Weights of the chain over terminators, from parsed texts."""
    known: dict[tuple, tuple] = {}
    chains = []
    for paragraphs in texts:
        for _, _, cand, _ in paragraphs:
            if cand:
                got = [known[k] if k in known else known.setdefault(k, (features(k, st), int(teacher(k, st)))) for _, k in cand]
                chains.append(([f for f, _ in got], [y for _, y in got]))
    return _perceptron(chains, epochs)


def _bare_weights(texts: list[str], model: SentenceModel) -> dict[str, float]:
    """Weights of the chain over characters, from the texts in scripts without blanks as the other chain cuts them."""
    bare = []
    for text in texts:
        if len(_NO_SPACE.findall(text)) * 3 > len(text):
            cuts = [*starts_of(text, model), len(text)]
            parts = [_STRIP.sub("", text[x:y]) for x, y in zip(cuts, cuts[1:])]
            whole = "".join(parts)
            marks = set(np.cumsum([len(p) for p in parts])[:-1].tolist())
            if len(whole) > 20:
                bare.append(([_char_features(whole, i) for i in range(1, len(whole))], [int(i in marks) for i in range(1, len(whole))]))
    return _perceptron(bare, 3) if bare else {}


def fit(texts: list[str], epochs: int = EPOCHS) -> SentenceModel:
    """Train both chains on texts in memory."""
    every = [parsed(t) for t in texts]
    st = Statistics()
    for paragraphs in every:
        st.add(paragraphs)
    model = SentenceModel(st)
    model.w, model.trans = _split(_chain_weights(every, st, epochs))
    model.chars, model.char_trans = _split(_bare_weights(texts, model))
    return model


def _bare_starts(part: str, model: SentenceModel) -> list[int]:
    """Boundaries in a paragraph without terminators, from the chain over characters."""
    keep = [i for i, c in enumerate(part) if c.isalnum() or c == "_"]
    s = "".join(part[i] for i in keep)
    w = model.chars
    scores = [sum(w.get(f, 0.0) for f in _char_features(s, i)) for i in range(1, len(s))]
    return [keep[i + 1] for i, t in enumerate(viterbi(scores, model.char_trans)) if t]


def starts_in(paragraphs: list[tuple], model: SentenceModel) -> list[int]:
    """Position of the first character of each sentence of a parsed text."""
    out = []
    for start, _, cand, bare in paragraphs:
        out.append(start)
        if cand:
            tags = viterbi([model.emission(k) for _, k in cand], model.trans)
            out.extend(at for (at, k), t in zip(cand, tags) if t and at >= 0)
        elif bare and model.chars:
            a, part = bare
            out.extend(a + i for i in _bare_starts(part, model) if a + i > start)
    return out


def starts_of(text: str | None, model: SentenceModel) -> list[int]:
    """Position of the first character of each sentence."""
    return starts_in(parsed(text), model) if text else []


def sample_texts(df: DataFrame, id_col: str, columns: list[str], bound: int = SAMPLE) -> list[str]:
    """Texts of at most ``bound`` rows, those with the smallest hash of their id, to fit a model on in memory."""
    rows = hashed_sample(df.select(id_col, *columns).filter(F.col(id_col).isNotNull()), id_col, bound)
    return [r[c] for r in rows for c in columns if r[c] and r[c].strip()]


def sentence_starts(df: DataFrame, id_col: str, columns: list[str], model: SentenceModel) -> DataFrame:
    """``(id, field_name, starts)`` of every non-null text of the columns."""
    kept = df.sparkSession.sparkContext.broadcast(model)  # weights and tokens of the statistics

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = kept.value
        for pdf in batches:
            for c in columns:
                some = pdf[c].notna()
                if not some.any():
                    continue
                yield pd.DataFrame({id_col: pdf[id_col][some], "field_name": c, "starts": [starts_of(t, m) for t in pdf[c][some]]})

    return df.select(id_col, *columns).mapInPandas(tag, f"{id_col} long, field_name string, starts array<int>")


def parsed_table(df: DataFrame, id_col: str, columns: list[str]) -> tuple[DataFrame, int]:
    """``(id, block, field_name, parsed, bare, token, n)`` of every text that is not blank, ``block`` of about ``SAMPLE`` rows, and the number of rows.

    ``bare`` is a text in a script without blanks. Rows of block -1 have no text but the statistics of a part of the
    texts: ``n`` of the kind ``field_name`` for a token.
    """
    every = df.count()
    blocks = 1 + every // SAMPLE

    kinds = {id_col: pa.int64(), "block": pa.int32(), "field_name": pa.string(), "parsed": pa.binary(), "bare": pa.string(), "token": pa.string(), "n": pa.int64()}

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds.values())], names=list(kinds))

    def counted(st: Statistics) -> pa.RecordBatch:
        return frame([(None, -1, kind, None, None, tok, n) for kind in ("n", "ends", "low", "starters") for tok, n in getattr(st, kind).items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        st = Statistics()
        for batch in batches:
            ids, blocks, *texts = (batch.column(c).to_pylist() for c in (id_col, "block", *columns))
            out = []
            for c, values in zip(columns, texts):
                for i, block, text in zip(ids, blocks, values):
                    if text and text.strip():
                        got = parsed(text)
                        st.add(got)
                        out.append((i, block, c, marshal.dumps(got), text if len(_NO_SPACE.findall(text)) * 3 > len(text) else None, None, None))
            yield frame(out)
            if len(st.n) + len(st.starters) > 200_000:
                yield counted(st)
                st = Statistics()
        yield counted(st)

    block = F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block")
    rows = df.select(id_col, block, *columns).mapInArrow(run, f"{id_col} long, block int, field_name string, parsed binary, bare string, token string, n long")
    return materialize(rows, "parsed")[0], every


def table_statistics(parts: DataFrame, rows: int) -> Statistics:
    """The statistics of all texts of so many rows; of more than ``SAMPLE`` the counts are divided, so the bounds mean the same share of texts at any size.

    A token seldom met that neither ends a paragraph nor precedes lower case counts like one never met, so it is left out,
    as are words that no three sentences of ``SAMPLE`` rows begin with.
    """
    share = max(1.0, rows / SAMPLE)
    counts = parts.filter("block = -1").groupBy("token")
    of = lambda k: F.coalesce(F.sum(F.when(F.col("field_name") == k, F.col("n"))), F.lit(0)).alias(k)
    st = Statistics()
    for r in counts.agg(of("n"), of("ends"), of("low"), of("starters")).filter(f"ends > 0 or low > 0 or n >= {12 * share} or starters >= {3 * share}").collect():
        for kind in ("n", "ends", "low", "starters"):
            if r[kind]:
                getattr(st, kind)[r["token"]] = r[kind] / share
    return st


def fit_table(parts: DataFrame, rows: int, id_col: str, epochs: int = EPOCHS) -> SentenceModel:
    """Train both chains on all texts of a parsed table."""
    spark = parts.sparkSession
    model = SentenceModel(table_statistics(parts, rows))

    def mixed(blocked: DataFrame, train) -> tuple[dict, list]:
        weights = blocked.groupBy("block").applyInPandas(train, "feature string, weight double")
        got = weights.groupBy("feature").agg(F.avg("weight").alias("weight")).filter("weight <> 0").collect()
        return _split({r["feature"]: r["weight"] for r in got})

    def frame(weights: dict[str, float]) -> pd.DataFrame:
        return pd.DataFrame({"feature": pd.Series(list(weights), dtype=object), "weight": pd.Series(list(weights.values()), dtype=float)})

    st = spark.sparkContext.broadcast(model.st)  # tokens of the statistics

    def chains(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([id_col, "field_name"])
        return frame(_chain_weights(map(marshal.loads, pdf["parsed"]), st.value, epochs))

    texts = parts.filter("block >= 0")
    model.w, model.trans = mixed(texts.select(id_col, "block", "field_name", "parsed"), chains)
    kept = spark.sparkContext.broadcast(model)

    def characters(pdf: pd.DataFrame) -> pd.DataFrame:
        return frame(_bare_weights(pdf.sort_values([id_col, "field_name"])["bare"].tolist(), kept.value))

    model.chars, model.char_trans = mixed(texts.filter("bare is not null").select(id_col, "block", "field_name", "bare"), characters)
    return model


FIELDS = ["description", "materials_examined"]


def found_starts(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """``(id, field_name, sent_start)`` of all sentences, by the model of these texts."""
    parts, rows = parsed_table(df, id_col, columns)
    kept = df.sparkSession.sparkContext.broadcast(fit_table(parts, rows, id_col))  # weights and tokens of the statistics

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = kept.value
        for batch in batches:
            starts = pa.array([starts_in(marshal.loads(p), m) for p in batch.column("parsed").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("field_name"), starts], names=[id_col, "field_name", "starts"])

    starts = parts.filter("block >= 0").select(id_col, "field_name", "parsed").mapInArrow(tag, f"{id_col} long, field_name string, starts array<int>")
    return starts.select(id_col, "field_name", F.explode("starts").alias("sent_start"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_starts(table(spark, sf_dir, "treatments"), "row_id", FIELDS)


def p7_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences themselves: number, start, end and text."""
    t = table(spark, sf_dir, "treatments")
    model = fit_table(*parsed_table(t, "row_id", FIELDS), "row_id")
    kept = spark.sparkContext.broadcast(model)

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = kept.value
        for pdf in batches:
            for c in FIELDS:
                out = []
                for i, text in zip(pdf["row_id"], pdf[c]):
                    s = starts_of(text, m)
                    out += [(i, c, j, a, text[a:b].rstrip()) for j, (a, b) in enumerate(zip(s, [*s[1:], len(text or "")]))]
                yield pd.DataFrame(out, columns=["row_id", "field_name", "sent_no", "sent_start", "sentence"])

    return t.select("row_id", *FIELDS).mapInPandas(tag, "row_id long, field_name string, sent_no int, sent_start int, sentence string")
