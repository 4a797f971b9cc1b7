"""Languages of texts and of passages in other languages (problem 2).

A linear-chain conditional random field labels every word with one of ten languages. A
word's features are the word itself (lexicon), its affixes, its character n-grams and its
scripts; transitions are learned twice, within a sentence and across the end of one. The
posterior of every word comes from forward-backward over the whole text; a sentence takes
the language with the largest mean posterior over its informative words, which is also its
confidence, and neighbouring sentences of one language make a segment.

Taxon names, DNA strings, numbers and single letters carry no evidence. The field is
fitted on a bounded sample (``SAMPLE`` rows of the smallest hash of their id): labels are
cleaned sentence by sentence with a naive Bayes pass, since some are wrong, and sentences
of different languages are chained so that transitions can be learned.

Defined cases: null texts give nothing; a text without informative words has no language;
a label in any usual form (code, name, with region) counts as its language; labels that
name no known language count as missing; equal rows give equal results; an id that occurs
twice is treated row by row; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.sampling import hashed_sample
from sporeline.sources.tables import table

SAMPLE = 3000
LANGS = ["de", "en", "es", "fr", "hi", "ja", "la", "pt", "ru", "zh"]
#: Usual names of the languages.
NAMES = {
    "de": "de deu ger german deutsch allemand alemán aleman",
    "en": "en eng english anglais englisch inglés ingles inglês",
    "es": "es spa spanish español espanol castellano castilian espagnol spanisch esp",
    "fr": "fr fra fre french français francais französisch franzosisch francés",
    "hi": "hi hin hindi हिन्दी हिंदी",
    "ja": "ja jpn japanese 日本語 jp japanisch japonais",
    "la": "la lat latin latein latina lateinisch latín",
    "pt": "pt por portuguese português portugues portugiesisch portugais",
    "ru": "ru rus russian русский russisch russe",
    "zh": "zh zho chi chinese 中文 汉语 漢語 cn cmn mandarin chinesisch chinois 华文",
}
_BY_NAME = {n: k for k, v in NAMES.items() for n in v.split()}
_TOKEN = re.compile(r"[㐀-鿿々]+|[぀-ヿー]+|[ऀ-ॣ०-ॿ]+|[^\W\d_㐀-鿿぀-ヿऀ-ॿ々]+(?:['’-][^\W\d_㐀-鿿぀-ヿऀ-ॿ々]+)*|(?:\.(?!\s?\d)|[!?…。！？।])+|\n\s*\n|\x00")
_DNA = re.compile(r"[ACGTUNRYKM]{12,}$")
#: Kinds of tokens.
TEXT_END, STOP, HARD, LETTER, LOWER, UPPER, WIDE = range(7)
_LEAST_MASS = 3


def label_language(label: str | None) -> str | None:
    """The language a label names, or None."""
    if not label:
        return None
    low = label.strip().lower()
    return _BY_NAME.get(low) or _BY_NAME.get(re.split(r"[-_ (/;,]", low)[0])


def _kind(tok: str) -> int:
    c = tok[0]
    if c == "\x00":
        return TEXT_END
    if c in "。！？।!?\n":
        return HARD
    if c in ".…":
        return STOP
    if "ऀ" <= c <= "ॿ" or "぀" <= c <= "ヿ" or "㐀" <= c <= "鿿" or c == "々":
        return WIDE
    if len(tok) == 1:
        return LETTER
    return LOWER if c.islower() else UPPER


def word_features(tok: str) -> list[str]:
    w = tok.lower()
    f = [f"w{w}", f"p{w[:2]}", f"p{w[:3]}", f"s{w[-2:]}", f"s{w[-3:]}", f"s{w[-4:]}"]
    g = f"<{w}>"
    f += [f"g{g[i : i + 3]}" for i in range(len(g) - 2)]
    c = w[0]
    f.append("Xhan" if "㐀" <= c <= "鿿" else "Xkana" if "぀" <= c <= "ヿ" else "Xdeva" if "ऀ" <= c <= "ॿ" else "Xcyr" if "Ѐ" <= c <= "ӿ" else "Xlat")
    if "㐀" <= c <= "鿿":
        f += [f"c{x}" for x in w]
    return list(dict.fromkeys(f))


class Tokens:
    """Batch of texts as arrays: token strings, kinds, text bounds."""

    def __init__(self, texts: list[str], kinds: dict[str, int]):
        joined = "\x00".join(t.replace("\x00", " ") for t in texts) + "\x00"
        self.words = _TOKEN.findall(joined)
        n = len(self.words)
        self.kind = np.fromiter(map(kinds.__getitem__, self.words), np.int8, n)
        self.ends = np.flatnonzero(self.kind == TEXT_END)
        after, before = np.append(self.kind[1:], TEXT_END), np.append(TEXT_END, self.kind[:-1])
        # any stop may end a sentence here, abbreviations too: their fragments are small and take the language around
        stop = (self.kind == STOP) & ((before != LETTER) | (after != LOWER))
        self.cut = stop | (self.kind == HARD) | (self.kind == TEXT_END)
        # of a name in two parts ("Genus species", "G. species") nothing is known yet
        self.after_letter = (before == STOP) & (np.append([TEXT_END, TEXT_END], self.kind[:-2]) == LETTER)


class _Kinds(dict):
    def __missing__(self, tok: str) -> int:
        if len(self) > 1_000_000:
            self.clear()
        v = self[tok] = _kind(tok)
        return v


class Field:
    """The fitted conditional random field."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, within: np.ndarray, across: np.ndarray, lexicon: frozenset):
        self.features, self.weights, self.within, self.across, self.lexicon = features, weights, within, across, lexicon
        self._rows: dict[str, int] | None = None

    def __getstate__(self):
        return self.__dict__ | {"_rows": None}

    def _reset(self) -> None:
        self._rows, self._table = {}, np.zeros((4096, len(LANGS)), np.float32)

    def _row(self, tok: str) -> int:
        """Row of the emission table of a word; row 0 stands for no evidence."""
        rows = self._rows
        k = rows.get(tok)
        if k is None:
            kind = _kind(tok)
            ids = [self.features[f] for f in word_features(tok) if f in self.features] if kind >= LOWER and not _DNA.match(tok) else []
            if not ids:
                k = 0
            else:
                k = self._n = getattr(self, "_n", 0) + 1 if rows else 1
                if k >= len(self._table):
                    self._table = np.concatenate([self._table, np.zeros_like(self._table)])
                self._table[k] = self.weights[ids].sum(0)
            rows[tok] = k
        return k

    def emissions(self, toks: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Scores (tokens x languages) and whether a token is informative."""
        if self._rows is None or len(self._rows) > 400_000:
            self._reset()
        row = np.fromiter(map(self._row, toks.words), np.int64, len(toks.words))
        known = np.fromiter(map(self.lexicon.__contains__, toks.words), bool, len(toks.words))
        unknown_upper = (toks.kind == UPPER) & ~known
        first = np.append(True, toks.cut[:-1])
        name = unknown_upper & ~first
        epithet = np.append(False, unknown_upper[:-1]) & (toks.kind == LOWER) & ~known
        row[name | epithet | (np.append(False, name[:-1]) & (toks.kind == LOWER)) | toks.after_letter & (toks.kind == LOWER)] = 0
        return self._table[row], row > 0

    def posteriors(self, scores: np.ndarray, toks: Tokens, chunk: int = 256) -> np.ndarray:
        """Forward-backward over every text; probabilities of each token."""
        L = len(LANGS)
        bounds = np.concatenate([[0], toks.ends + 1])
        n = np.diff(bounds)
        order = np.argsort(-n, kind="stable")
        out = np.zeros((len(toks.words), L), np.float32)
        e = np.exp(scores - scores.max(1, keepdims=True)).astype(np.float32)
        t0, t1 = np.exp(self.within).astype(np.float32), np.exp(self.across).astype(np.float32)
        cut = toks.cut
        for lo in range(0, len(order), chunk):
            part = order[lo : lo + chunk]
            m, start = n[part], bounds[:-1][part]
            longest = int(m[0])
            alive = (m[None, :] > np.arange(longest)[:, None]).sum(1)  # texts are in falling length
            alpha = np.empty((longest, len(part), L), np.float32)
            a = np.full((len(part), L), 1 / L, np.float32)
            for t in range(longest):
                k = alive[t]
                at = start[:k] + t
                if t:
                    jump = cut[at - 1]
                    a = np.where(jump[:, None], a[:k] @ t1, a[:k] @ t0)
                a = a[:k] * e[at]
                a /= a.sum(1, keepdims=True)
                alpha[t, :k] = a
            b = np.ones((len(part), L), np.float32)
            for t in range(longest - 1, -1, -1):
                k = alive[t]
                at = start[:k] + t
                p = alpha[t, :k] * b[:k]
                out[at] = p / p.sum(1, keepdims=True)
                if t:
                    x = e[at] * b[:k]
                    jump = cut[at - 1]
                    y = np.where(jump[:, None], x @ t1.T, x @ t0.T)
                    b[:k] = y / y.sum(1, keepdims=True)
        return out


def _mass(toks: Tokens, informative: np.ndarray) -> np.ndarray:
    """Evidence of a token: 1 for a word, half its length for a run of Han, kana."""
    m = informative.astype(np.float32)
    wide = np.flatnonzero(informative & (toks.kind == WIDE))
    for i in wide:
        if toks.words[i][0] >= "぀":
            m[i] = max(1.0, len(toks.words[i]) / 2)
    return m


def _sample_units(texts: list[str]) -> list[list[str]]:
    """Sentences of each text as lists of tokens (with the final one)."""
    toks = Tokens(texts, _Kinds())
    units, own, all_units = [], [], []
    for w, c, k in zip(toks.words, toks.cut, toks.kind):
        own.append(w)
        if c:
            if len(own) > 1 or k != TEXT_END:
                units.append(own)
            own = []
        if k == TEXT_END:
            all_units.append(units)
            units = []
    return all_units


def fit(rows: list[tuple[str, str | None]], steps: int = 150, seed: int = 7) -> Field:
    """Fit the field on ``(text, label)`` rows."""
    L = len(LANGS)
    texts = [t for t, _ in rows]
    labels = [label_language(x) for _, x in rows]
    units = _sample_units(texts)
    count = np.full(L, 1.0)
    lex: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(L))
    seen: Counter = Counter()
    informative = lambda w: _kind(w) >= LOWER and not _DNA.match(w)
    for us, lab in zip(units, labels):
        for w in {w for u in us for w in u if informative(w)}:
            seen[w] += 1
        if lab is None:
            continue
        k = LANGS.index(lab)
        for u in us:
            for w in u:
                if informative(w):
                    lex[w.lower()][k] += 1
                    count[k] += 1
    lexicon = frozenset(w for w, n in seen.items() if n >= 4)
    prior = np.log(count / count.sum())

    def bayes(u: list[str]) -> tuple[int, float]:
        s, n = np.zeros(L), 0
        for w in u:
            if w in lexicon and w.lower() in lex:
                v = lex[w.lower()] + 0.5 * np.exp(prior)
                s += np.log(v / v.sum()) - prior
                n += 1
        if n < 3:
            return -1, 0.0
        top = np.sort(s)
        return int(s.argmax()), (top[-1] - top[-2]) / n

    clean: list[list[tuple[list[str], int]]] = [[] for _ in range(L)]
    for _ in range(2):
        clean = [[] for _ in range(L)]
        again: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(L))
        for us in units:
            for u in us:
                k, margin = bayes(u)
                if k >= 0 and margin > 0.15:
                    clean[k].append((u, k))
                    for w in u:
                        if informative(w):
                            again[w.lower()][k] += 1
        lex = again
    pools = [p for p in clean if p]
    if not pools:
        return Field({}, np.zeros((1, L)), np.zeros((L, L)), np.zeros((L, L)), lexicon)
    vocabulary = {w for p in pools for u, _ in p for w in u if w in lexicon and informative(w)}
    freq = Counter(f for w in vocabulary for f in word_features(w))
    features = {f: i for i, f in enumerate(sorted(freq))}
    of = {w: np.array([features[f] for f in word_features(w)]) for w in vocabulary}
    W = np.zeros((len(features), L))
    gW = np.full(len(features), 1e-8)
    A, B = np.eye(L) * 1.0, np.zeros((L, L))
    gA, gB = np.full((L, L), 1e-8), np.full((L, L), 1e-8)
    rng = np.random.default_rng(seed)
    for _ in range(steps):
        dW: dict[int, np.ndarray] = {}
        dA, dB = np.zeros((L, L)), np.zeros((L, L))
        seqs = []
        for _ in range(24):
            pick = [pools[rng.integers(len(pools))] for _ in range(3)] if rng.random() < 0.5 else [pools[rng.integers(len(pools))]] * 3
            seqs.append([p[rng.integers(len(p))] for p in pick])
        T = max(sum(len(u) for u, _ in s) for s in seqs)
        N = len(seqs)
        E, gold, real, jump = np.zeros((N, T, L)), np.zeros((N, T), int), np.zeros((N, T), bool), np.zeros((N, T), bool)
        words: list[tuple[int, int, str]] = []
        for i, s in enumerate(seqs):
            t = 0
            for u, k in s:
                for w in u:
                    f = of.get(w)
                    # part of the words is masked as a whole word so that affixes and n-grams carry weight too
                    if f is not None and rng.random() < 0.9:
                        E[i, t] = W[f].sum(0)
                        words.append((i, t, w))
                    gold[i, t], real[i, t] = k, True
                    t += 1
                jump[i, t - 1] = True
        al, z = np.zeros((N, T, L)), np.zeros((N, T))
        e = np.exp(E)
        mA, mB = np.exp(A), np.exp(B)
        for t in range(T):
            a = al[:, t - 1] if t else np.full((N, L), 1 / L)
            if t:
                a = np.where(jump[:, t - 1, None], a @ mB, a @ mA)
            a = np.where(real[:, t, None], a * e[:, t], a)
            z[:, t] = a.sum(1)
            al[:, t] = a / z[:, t, None]
        be = np.ones((N, T, L))
        for t in range(T - 2, -1, -1):
            x = np.where(real[:, t + 1, None], e[:, t + 1] * be[:, t + 1], be[:, t + 1])
            y = np.where(jump[:, t, None], x @ mB.T, x @ mA.T)
            be[:, t] = y / y.sum(1, keepdims=True)
            j = np.einsum("ni,nj->nij", al[:, t], x)
            jA, jB = j * mA, j * mB
            jA /= jA.sum((1, 2), keepdims=True)
            jB /= jB.sum((1, 2), keepdims=True)
            use = real[:, t + 1]
            a_, b_ = use & ~jump[:, t], use & jump[:, t]
            dA -= jA[a_].sum(0)
            dB -= jB[b_].sum(0)
            np.add.at(dA, (gold[a_, t], gold[a_, t + 1]), 1)
            np.add.at(dB, (gold[b_, t], gold[b_, t + 1]), 1)
        post = al * be
        post /= post.sum(2, keepdims=True)
        for i, t, w in words:
            g = -post[i, t]
            g[gold[i, t]] += 1
            for f in of[w]:
                if f in dW:
                    dW[f] = dW[f] + g
                else:
                    dW[f] = g
        if dW:
            ids = np.fromiter(dW, int)
            G = np.stack(list(dW.values())) - 0.02 * W[ids]
            gW[ids] += (G**2).mean(1)
            W[ids] += 0.35 * G / np.sqrt(gW[ids])[:, None]
        for M, G, acc in ((A, dA, gA), (B, dB, gB)):
            G -= 0.05 * M
            acc += G**2
            M += 0.2 * G / np.sqrt(acc)
    return Field(features, W.astype(np.float32), A, B, lexicon)


def sentence_languages(texts: list[str], field: Field, kinds: dict) -> tuple[Tokens, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per sentence: the text it is of, its first token, language, confidence and evidence."""
    toks = Tokens(texts, kinds)
    scores, informative = field.emissions(toks)
    post = field.posteriors(scores, toks)
    mass = _mass(toks, informative)
    first = np.concatenate([[0], np.flatnonzero(toks.cut)[:-1] + 1])
    weight = np.add.reduceat(mass, first)
    mean = np.add.reduceat(post * mass[:, None], first) / np.maximum(weight, 1e-9)[:, None]
    text_of = np.searchsorted(toks.ends, first)
    return toks, np.stack([text_of, first], 1), mean.argmax(1), mean.max(1), weight


def _found_languages(texts: list[str], field: Field, kinds: dict) -> list[list[int]]:
    """Languages of each text with a whole sentence; of a text of mere fragments the one of its largest."""
    _, at, lang, conf, weight = sentence_languages(texts, field, kinds)
    out: list[set] = [set() for _ in texts]
    best: list[tuple] = [(0.0, -1)] * len(texts)
    for (i, _), k, c, w in zip(at.tolist(), lang.tolist(), conf.tolist(), weight.tolist()):
        if w >= _LEAST_MASS and c > 0.6:
            out[i].add(k)
        elif w > best[i][0]:
            best[i] = (w, k)
    return [sorted(s) if s else [b[1]] if b[0] > 0 else [] for s, b in zip(out, best)]


FIELDS = ("description", "diagnosis")


def stacked(treatments: DataFrame) -> DataFrame:
    """One row per non-null field: row_id, field_name, label, text."""
    parts = [F.struct(F.lit(f).alias("field_name"), F.col(f"{f}_lang").alias("label"), F.col(f).alias("text")) for f in FIELDS]
    return treatments.select("row_id", F.explode(F.array(*parts)).alias("p")).select("row_id", "p.*").filter("text is not null")


def sample_rows(t: DataFrame, bound: int = SAMPLE) -> list[tuple[str, str | None]]:
    """Texts and labels of at most ``bound`` rows, those with the smallest hash of their id."""
    rows = hashed_sample(t.select("row_id", *FIELDS, *[f"{f}_lang" for f in FIELDS]).filter("row_id is not null"), "row_id", bound)
    return [(r[f], r[f"{f}_lang"]) for r in rows for f in FIELDS if r[f]]


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "treatments")
    kept = spark.sparkContext.broadcast(fit(sample_rows(t)))  # bounded: fitted on SAMPLE rows

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, kinds = kept.value, _Kinds()
        for pdf in batches:
            out = []
            for lo in range(0, len(pdf), 2000):
                part = pdf.iloc[lo : lo + 2000]
                for i, f, label, langs in zip(part["row_id"], part["field_name"], part["label"], _found_languages(part["text"].tolist(), field, kinds)):
                    if len(langs) > 1 or label_language(label) != (LANGS[langs[0]] if langs else None):
                        out += [(i, f, LANGS[k]) for k in langs]
            yield pd.DataFrame(out, columns=["row_id", "field_name", "lang"])

    return stacked(t).mapInPandas(tag, "row_id long, field_name string, lang string")


def p2_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every field as segments of one language: number, start, end, language, confidence; n_segments tells mixed fields."""
    t = table(spark, sf_dir, "treatments")
    kept = spark.sparkContext.broadcast(fit(sample_rows(t)))

    def tag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        field, kinds = kept.value, _Kinds()
        for pdf in batches:
            for lo in range(0, len(pdf), 1000):
                part = pdf.iloc[lo : lo + 1000]
                texts = [x.replace("\x00", " ") for x in part["text"]]
                _, at, lang, conf, weight = sentence_languages(texts, field, kinds)
                by: dict[int, list] = defaultdict(list)
                for (i, first), k, c, w in zip(at.tolist(), lang.tolist(), conf.tolist(), weight.tolist()):
                    by[i].append((first, k, c, w))
                out, base = [], 0
                for i, text in enumerate(texts):
                    starts = [m.start() for m in _TOKEN.finditer(text)]
                    segs: list[list] = []
                    for first, k, c, w in by[i]:
                        if first - base >= len(starts):
                            continue
                        pos = starts[first - base] if segs else 0
                        if segs and (segs[-1][1] == k or w < _LEAST_MASS or segs[-1][3] < _LEAST_MASS):
                            s = segs[-1]
                            if s[3] < _LEAST_MASS <= w:
                                s[1] = k
                            s[2], s[3] = (s[2] * s[3] + c * w) / max(s[3] + w, 1e-9), s[3] + w
                        elif w > 0 or not segs:
                            segs.append([pos, k, c, w])
                    base += len(starts) + 1
                    ends = [s[0] for s in segs[1:]] + [len(text)]
                    out += [(part["row_id"].iloc[i], part["field_name"].iloc[i], j, s[0], e, LANGS[s[1]] if s[3] > 0 else None, float(s[2]) if s[3] > 0 else None, len(segs)) for j, (s, e) in enumerate(zip(segs, ends))]
                yield pd.DataFrame(out, columns=["row_id", "field_name", "seg_no", "seg_start", "seg_end", "lang", "confidence", "n_segments"])

    return stacked(t).mapInPandas(tag, "row_id long, field_name string, seg_no int, seg_start int, seg_end int, lang string, confidence double, n_segments int")
