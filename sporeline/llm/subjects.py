"""Subject areas of documents (problem 10).

Every sentence is the average of the vectors of its words, a word's vector being the mean of
those of its own bucket and of its character n-grams, and has one independent logistic
output per subject. Training runs in rounds: the weights go to all partitions, each makes a
pass of mini-batches over its sentences and returns its change, and the changes are averaged, so
that the partitions stay in step. Labels are given per document; between rounds each sentence's target is
set anew from the document's labels and the scores so far (a sentence may deal with one
of them, with none, or with a subject the document as a whole does not have), which
also rides over wrong labels. Then every document is scored, sentence by sentence; it has the subjects of at
least a quarter of its sentences.

Fitted on at most ``LABELLED`` labelled and ``UNLABELLED`` other documents (smallest hashes of their ids; the others get
their labels from the first fit). All documents are scored on whole texts.

Defined cases: blank and null texts have no subject; a document that no subject reaches a quarter of has none;
repeated documents come out alike; labels of unknown subjects or documents are ignored; without labels there are no rows; extra
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sporeline.llm.sampling import hashed_sample
from sporeline.plans.storage import materialize
from sporeline.sources.tables import table

BUCKETS, DIM, PARTS = 1 << 15, 24, 6
LABELLED, UNLABELLED = 2000, 1000
LEAST_SHARE = 0.25
LEAST_BATCHES = 30
_ABBREVIATIONS = "cf vgl Fig Abb fig al St Mt Nr No no bzw Dr excl ср рис др см".split()
_NO_STOP = "".join(rf"(?<!\b{a}\.)" for a in _ABBREVIATIONS) + r"(?<!\b\w\.)"
_AFTER = r"[\"'»”“’)]*\s+(?=[\"'«„“(¿¡]?[^\W\d_a-z])"
_SPLIT = re.compile(rf"[.!?。！？।\n](?:(?<=\.){_NO_STOP}{_AFTER}|(?<=[!?]){_AFTER}|(?<=[^\W\d]{{3}}\.)(?=[^\W\d_a-z])|(?<=[。！？।])[。！？।]*(?![」』”])|(?<=\n)[^\S\n]*\n\s*)")
_TOKEN = re.compile(r"[^\W\d_]+|[\x00\x01]")


def word_buckets(word: str) -> list[int]:
    """The word's own bucket and those of its character n-grams (pairs for scripts without blanks)."""
    p = f"<{word}>"
    n = 2 if word[0] >= "ऀ" else 4
    grams = {p[i : i + n] for i in range(len(p) - n + 1)} if len(p) > n else set()
    return [zlib.crc32(x.encode()) % BUCKETS for x in [f"w {word}", *sorted(grams)]]


class Texts:
    """Sentences of texts as word numbers; a worker keeps the numbers of the words it met."""

    def __init__(self):
        self.number: dict[str, int] = {"\x00": -2, "\x01": -1}
        self.buckets: list[list[int]] = []

    def _of(self, word: str) -> int:
        k = self.number.get(word)
        if k is None:
            k = self.number[word] = len(self.buckets)
            self.buckets.append(word_buckets(word))
        return k

    def sentences(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, the first of each sentence, and the text of each sentence."""
        joined = "\x00".join(_SPLIT.sub("\x01", t.replace("\x00", " ").replace("\x01", " ").strip()) for t in texts).lower() + "\x00"
        words = _TOKEN.findall(joined)
        ids = np.fromiter(map(self._of, words), np.int64, len(words))
        mark = ids < 0
        text_of = np.cumsum(ids == -2)
        cut = np.concatenate([[True], mark[:-1]]) & ~mark  # first word of a sentence
        at = np.cumsum(~mark) - 1
        return ids[~mark], at[cut], text_of[cut]


class Model:
    def __init__(self, subjects: list[str], seed: int = 5):
        rng = np.random.default_rng(seed)
        self.subjects = subjects
        self.E = (rng.standard_normal((BUCKETS, DIM)) * 0.1).astype(np.float32)
        self.W = np.zeros((DIM, len(subjects)), np.float32)
        self.W += (rng.standard_normal(self.W.shape) * 0.3).astype(np.float32)
        self.b = np.full(len(subjects), -2.0, np.float32)

    def words(self, buckets: list[list[int]]) -> np.ndarray:
        flat = np.fromiter((x for w in buckets for x in w), np.int64)
        n = np.array([len(w) for w in buckets])
        starts = np.concatenate([[0], np.cumsum(n)[:-1]])
        return np.add.reduceat(self.E[flat], starts, 0) / n[:, None] if len(flat) else np.zeros((0, DIM), np.float32)


def logits(model: Model, table_: np.ndarray, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Outputs of each sentence; ``table_`` has each word's share in them."""
    if not len(first):
        return np.zeros((0, len(model.subjects)), np.float32)
    n = np.diff(np.append(first, len(ids)))
    return np.add.reduceat(table_[ids], first, 0) / n[:, None] + model.b


def local_pass(model: Model, ids: np.ndarray, first: np.ndarray, target: np.ndarray, buckets: list[list[int]], rate: float, seed: int, batch: int = 128) -> None:
    """Mini-batches over sentences, in place: one pass, or as many as make ``LEAST_BATCHES`` of few sentences."""
    n_sent = len(first)
    ends = np.append(first[1:], len(ids))
    rng = np.random.default_rng(seed)
    passes = min(12, -(-LEAST_BATCHES * batch // max(n_sent, 1)))
    order = np.concatenate([rng.permutation(n_sent) for _ in range(passes)])
    width = np.array([len(w) for w in buckets])
    flat = np.fromiter((x for w in buckets for x in w), np.int64)
    start = np.concatenate([[0], np.cumsum(width)[:-1]])
    gE, gW, gb = np.full(BUCKETS, 1e-7, np.float32), np.full(model.W.shape, 1e-4, np.float32), np.full(len(model.b), 1e-2, np.float32)
    for lo in range(0, len(order), batch):
        part = order[lo : lo + batch]
        own = np.concatenate([ids[first[i] : ends[i]] for i in part])
        n = ends[part] - first[part]
        row = np.repeat(np.arange(len(part)), n)
        uniq, inv = np.unique(own, return_inverse=True)
        fl = np.concatenate([flat[start[u] : start[u] + width[u]] for u in uniq])
        wn = width[uniq]
        ws = np.concatenate([[0], np.cumsum(wn)[:-1]])
        vec = np.add.reduceat(model.E[fl], ws, 0) / wn[:, None]
        sent = np.add.reduceat(vec[inv], np.concatenate([[0], np.cumsum(n)[:-1]]), 0) / n[:, None]
        p = 1 / (1 + np.exp(-np.clip(sent @ model.W + model.b, -30, 30)))
        d = p - target[part]
        dW = sent.T @ d
        dS = (d @ model.W.T) / n[:, None]
        dV = np.zeros_like(vec)
        o = np.argsort(inv, kind="stable")
        s = inv[o]
        cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        dV[s[cut]] = np.add.reduceat(dS[row[o]], cut, 0)
        dV /= wn[:, None]
        per = np.repeat(dV, wn, 0)
        o = np.argsort(fl, kind="stable")
        s = fl[o]
        cut = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
        g = np.add.reduceat(per[o], cut, 0)
        k = s[cut]
        gE[k] += (g**2).mean(1)
        model.E[k] -= rate * g / np.sqrt(gE[k])[:, None]
        gW += dW**2
        model.W -= rate * dW / np.sqrt(gW)
        db = d.sum(0)
        gb += db**2
        model.b -= rate * db / np.sqrt(gb)


def targets(p: np.ndarray | None, labels: np.ndarray) -> np.ndarray:
    """Targets of sentences from the labels of their documents and the scores so far (none in the first round)."""
    if p is None:
        return labels.astype(np.float32)
    best = p.argmax(1)
    top = p[np.arange(len(p)), best]
    own = p * labels
    mine = own.max(1)
    # of several labels the one that the sentence speaks for; an undecided sentence keeps them all, shared out
    sure = (own > 0.3) & (own >= 0.5 * mine[:, None])
    out = np.where((mine > 0.3)[:, None], sure, labels / np.maximum(labels.sum(1), 1)[:, None]).astype(np.float32)
    away = (top > 0.6) & (mine < 0.3)
    out[away] = 0
    out[away, best[away]] = 1
    return out


def shares(model: Model, table_: np.ndarray, ids: np.ndarray, first: np.ndarray, text_of: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text the share of its sentences that deal with each subject."""
    hit = logits(model, table_, ids, first) > 0
    out = np.zeros((n_texts, len(model.subjects)))
    np.add.at(out, text_of, hit)
    return out / np.maximum(np.bincount(text_of, minlength=n_texts), 1)[:, None]


def _labelled(docs: DataFrame, labels: DataFrame, subjects: list[str], bound: int) -> DataFrame:
    """Texts and label numbers of at most ``bound`` labelled documents."""
    number = F.array_position(F.array(*[F.lit(s) for s in subjects]), F.col("subject")).cast("int") - 1
    per_doc = labels.filter("doc_id is not null and subject is not null").select("doc_id", number.alias("label")).filter("label >= 0").groupBy("doc_id").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    kept = hashed_sample(per_doc, "doc_id", bound)  # at most bound rows
    sample = docs.sparkSession.createDataFrame([(r["doc_id"], r["labels"]) for r in kept], "doc_id long, labels array<int>")
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")


def _bits(labels: pd.Series, k: int) -> np.ndarray:
    out = np.zeros((len(labels), k), np.int64)
    for i, own in enumerate(labels):
        out[i, list(own)] = 1
    return out


def _round(sent, number: int, relabel: bool, rate: float):
    """The local pass of one round: the change of the weights on one part, touched buckets only."""

    def work(key, pdf: pd.DataFrame) -> pd.DataFrame:
        base = sent.value
        own = Model.__new__(Model)
        own.subjects, own.E, own.W, own.b = base.subjects, base.E.copy(), base.W.copy(), base.b.copy()
        texts = Texts()
        pdf = pdf[pdf["text"].notna()].sort_values(["doc_id", "text"])
        ids, first, of = texts.sentences(pdf["text"].tolist())
        if not len(first):
            return pd.DataFrame({"k": [], "e": [], "w": [], "b": []})
        y = _bits(pdf["labels"], len(own.subjects))[of]
        p = 1 / (1 + np.exp(-logits(own, own.words(texts.buckets) @ own.W, ids, first))) if relabel else None
        local_pass(own, ids, first, targets(p, y), texts.buckets, rate, seed=100 * number + int(key[0]))
        d = own.E - base.E
        k = np.flatnonzero(np.abs(d).max(1) > 0).astype(np.int32)
        return pd.DataFrame({"k": [k.tobytes()], "e": [d[k].astype(np.float16).tobytes()], "w": [(own.W - base.W).tobytes()], "b": [(own.b - base.b).tobytes()]})

    return work


def train(rows: DataFrame, model: Model, rounds: int, relabel_from: int, rate: float = 0.12) -> Model:
    """Rounds over ``rows(part, doc_id, text, labels)``: weights out, a local pass per part, averaged changes back."""
    rows = rows.repartition(PARTS, "part")
    for r in range(rounds):
        sent = rows.sparkSession.sparkContext.broadcast(model)  # BUCKETS x DIM floats, whatever the data
        got = rows.groupBy("part").applyInPandas(_round(sent, r, r >= relabel_from, rate), "k binary, e binary, w binary, b binary").collect()  # a row per part
        if not got:
            return model
        change, n = np.zeros_like(model.E), np.zeros(BUCKETS, np.float32)
        for g in got:
            k = np.frombuffer(g["k"], np.int32)
            change[k] += np.frombuffer(g["e"], np.float16).reshape(-1, DIM)
            n[k] += 1
        out = Model.__new__(Model)
        out.subjects = model.subjects
        out.E = model.E + change / np.maximum(n, 1)[:, None]
        out.W = model.W + np.mean([np.frombuffer(g["w"], np.float32).reshape(model.W.shape) for g in got], 0)
        out.b = model.b + np.mean([np.frombuffer(g["b"], np.float32) for g in got], 0)
        model = out
        sent.unpersist()
    return model


class Scorer:
    """Shares of subjects of texts; keeps each word's share in the outputs."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most = model, most
        self._reset()

    def _reset(self) -> None:
        self.texts, self.table = Texts(), np.zeros((0, len(self.model.subjects)), np.float32)

    def shares(self, texts: list[str]) -> np.ndarray:
        if len(self.table) > self.most:
            self._reset()
        ids, first, of = self.texts.sentences(texts)
        new = self.texts.buckets[len(self.table) :]
        if new:
            self.table = np.concatenate([self.table, self.model.words(new) @ self.model.W])
        return shares(self.model, self.table, ids, first, of, len(texts))


def _score(model: Model, docs: DataFrame) -> DataFrame:
    """``doc_id, shares`` of every document (rows as they come, several of one id too)."""
    kept = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(kept.value)
        for pdf in batches:
            for lo in range(0, len(pdf), 1000):
                part = pdf.iloc[lo : lo + 1000]
                yield pd.DataFrame({"doc_id": part["doc_id"], "shares": list(scorer.shares(part["text"].fillna("").tolist()))})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, shares array<double>")


def fit(docs: DataFrame, labels: DataFrame, subjects: list[str], rounds: int = 4, more: int = 1) -> Model | None:
    """Fit on the labelled sample, then on it and a sample of others with the labels of the first fit."""
    spark = docs.sparkSession
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part")
    if not subjects:
        return None
    known, _ = materialize(_labelled(docs, labels, subjects, LABELLED).select(part, "doc_id", "text", "labels"), "labelled")
    if known.isEmpty():
        return None
    model = train(known, Model(subjects), rounds, 2)
    others = hashed_sample(docs.select("doc_id", "text").filter("doc_id is not null and text is not null"), "doc_id", UNLABELLED)
    scorer = Scorer(model)
    got = scorer.shares([r["text"] for r in others]) >= LEAST_SHARE if others else np.zeros((0, len(subjects)), bool)
    guessed = [(r["doc_id"], r["text"], np.flatnonzero(g).tolist()) for r, g in zip(others, got) if g.any()]
    both = known.unionByName(spark.createDataFrame(guessed, "doc_id long, text string, labels array<int>").select(part, "doc_id", "text", "labels")) if guessed else known
    both, _ = materialize(both, "with-guessed")
    return train(both, model, more, 0)


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame) -> DataFrame:
    """``doc_id, subject, share`` of the subjects of every document."""
    names = [r["subject"] for r in subjects.select("subject").filter("subject is not null").distinct().orderBy("subject").collect()]  # a fixed list
    model = fit(docs, labels, names)
    if model is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, subject string, share double")
    by = F.explode(F.arrays_zip(F.array(*[F.lit(s) for s in names]).alias("subject"), F.col("shares").alias("share"))).alias("z")
    return _score(model, docs.filter("text is not null")).select("doc_id", by).select("doc_id", F.col("z.subject").alias("subject"), F.col("z.share").alias("share")).filter(F.col("share") >= LEAST_SHARE)


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = lambda n: table(spark, sf_dir, n)
    return document_subjects(t("documents"), t("subject_labels"), t("subjects")).select("doc_id", "subject").distinct()


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and characters of the corpus by subject, and the share of documents."""
    t = lambda n: table(spark, sf_dir, n)
    docs = t("documents")
    got = document_subjects(docs, t("subject_labels"), t("subjects")).join(docs.select("doc_id", F.char_length("text").alias("chars")), "doc_id")
    n = docs.agg(F.count("*").alias("n_all"))
    per = got.groupBy("subject").agg(F.count("*").alias("n_docs"), F.sum("chars").alias("n_chars"))
    return per.join(F.broadcast(n), F.lit(True)).select("subject", "n_docs", "n_chars", F.round(F.try_divide("n_docs", "n_all"), 6).alias("share"))
