"""Problem 9: the subjects of each document, and the corpus composition by subject.

Method: class-association rules. Sentences of labelled documents are
transactions of their words and of their document's subject. Frequent patterns
grow in parallel, in the tasks that hold the sentences: frequent words first,
then, in the projection of the sentences on each of them, pairs; a pattern and
a subject give a rule (one or two words -> subject). The growth stops there, so
long sentences that repeat cost no more than their pairs. A rule's confidence is balanced by the subjects' own
frequencies and shrunk by its support, which calibrates its evidence (log
odds); a rule of two words is pruned unless it is clearly surer than the rules
of its words. Every sentence of every document sums the evidence of its
matching rules and goes to its best subject, if that is clear; a document
treats a subject from SHARE of its sentences on.

The rules are fitted on a documented bounded sample (about FIT_DOCS
documents labelled with one subject; those with several don't teach), so the broadcast rules are bounded too. Terms of
subject_terms that no rule covers join as rules of their own.

Defined results: null, blank and wordless texts have no subject; a repeated
document row counts once; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.functions.folding import INVISIBLES, fold, unescape
from korale.session import sample, stored, table

FIT_DOCS = 6000  # bound of the labelled sample
SUPPORT = 4  # sentences that a rule must hold in
LEAN = 0.4  # balanced share of one subject from which a word is an item
CONFIDENCE = 0.45  # balanced confidence from which a rule is kept
GAIN = 0.1  # by which a rule of two words must be surer than those of its words
CLEAR = 1.2, 1.3  # evidence a sentence needs, absolutely and as a multiple of the second subject's
SHARE = 0.19  # of a document's sentences, from which it treats a subject
TERM = 0.85  # confidence of a listed term

_SPLIT = re.compile(r"(?<=[.!?])[\"”’)]*\s+|\n+")
_WORD = re.compile(r"[\w\u0300-\u036f'’‘ʻʼ`´‵]+(?:-[\w\u0300-\u036f'’‘ʻʼ`´‵]+)*")
_HIDDEN = re.compile(f"[{INVISIBLES}]")


def sentence_words(text: str | None) -> list[list[str]]:
    """The raw words of each sentence of text; sentences without words are left out."""
    if not text:
        return []
    if "&" in text:
        text = unescape(text)
    if not text.isascii() and _HIDDEN.search(text):
        text = _HIDDEN.sub("", text)
    return [w for s in _SPLIT.split(text) if (w := _WORD.findall(s))]


class Rules:
    """Balanced rules: word -> (subject, evidence) and pair of words -> (subject, evidence)."""

    def __init__(self, subjects: list[str], single: dict[str, tuple[int, float]], double: dict[tuple[str, str], tuple[int, float]]):
        self.subjects, self.single, self.double = subjects, single, double
        self.paired = {w for pair in double for w in pair}
        self.memo: dict[str, tuple[str, int, float] | None] = {}

    def _match(self, raw: str) -> tuple[str, int, float] | None:
        word = fold(raw)
        hit = self.single.get(word)
        return (word, *hit) if hit else (word, -1, 0.0) if word in self.paired else None

    def shares(self, text: str | None) -> list[tuple[str, float, int]]:
        """(subject, share of the sentences, sentences) for each subject with any sentence."""
        count = [0] * len(self.subjects)
        parts = sentence_words(text)
        memo = self.memo
        for words in parts:
            hits = {}
            for w in words:
                if w in memo:
                    m = memo[w]
                else:
                    if len(memo) > 200_000:
                        memo.clear()
                    m = memo[w] = self._match(w)
                if m is not None:
                    hits[m[0]] = m
            if not hits:
                continue
            evidence: dict[int, float] = defaultdict(float)
            for _, k, e in hits.values():
                if k >= 0:
                    evidence[k] += e
            if len(hits) > 1 and self.double:
                names = sorted(w for w in hits if w in self.paired)
                for i, a in enumerate(names):
                    for b in names[i + 1 :]:
                        if pair := self.double.get((a, b)):
                            evidence[pair[0]] += pair[1]
            if evidence:
                order = sorted(evidence.items(), key=lambda x: (-x[1], x[0]))
                if order[0][1] >= CLEAR[0] and (len(order) == 1 or order[0][1] >= CLEAR[1] * order[1][1]):
                    count[order[0][0]] += 1
        return [(s, c / len(parts), len(parts)) for s, c in zip(self.subjects, count, strict=True) if c]


def _balanced(counts: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """([row]: best subject, [row]: its share) of counts[row, subject], as if all subjects were equally frequent."""
    c = counts * scale
    p = (c + 0.15) / (c.sum(axis=1, keepdims=True) + 0.15 * counts.shape[1])
    return p.argmax(axis=1), p.max(axis=1)


def _per_subject(rows: DataFrame, key: str, subjects: list[str]) -> DataFrame:
    """key, counts (array with the sum of n for each subject)."""
    sums = [F.sum(F.when(F.col("subject") == s, F.col("n")).otherwise(0)) for s in subjects]
    return rows.groupBy(key).agg(F.array(*sums).alias("counts"))


def _grown(baskets: DataFrame, items: dict[str, int], subjects: list[str]) -> DataFrame:
    """pair (a * items + b), subject, n: how often items a < b stand together in sentences of a subject.

    The growth of the patterns of one item: each basket is projected on each of
    its items, and the items behind it in the common order are counted there.
    Rules have two words at most, so patterns grow no further.
    """
    packed, width = pickle.dumps((items, subjects)), len(items)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, subjects = pickle.loads(packed)
        place = {s: i for i, s in enumerate(subjects)}

        def counted(keys: list[np.ndarray], weights: list[np.ndarray]) -> pd.DataFrame:
            key, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(at, np.concatenate(weights), len(key)).astype(np.int64)
            return pd.DataFrame({"pair": key // len(subjects), "subject": [subjects[i] for i in key % len(subjects)], "n": n})

        for b in batches:
            keys, weights, held = [], [], 0
            for s, words, n in zip(b.subject, b.words, b.n, strict=True):
                ids = np.array(sorted(known[w] for w in words if w in known), np.int64)
                for i in range(len(ids) - 1):  # the projection on item i
                    keys.append((ids[i] * width + ids[i + 1 :]) * len(subjects) + place[s])
                    weights.append(np.full(len(ids) - 1 - i, n, float))
                    held += len(ids) - 1 - i
                    if held > 1_000_000:
                        yield counted(keys, weights)
                        keys, weights, held = [], [], 0
            if keys:
                yield counted(keys, weights)

    return baskets.mapInPandas(run, "pair bigint, subject string, n bigint").groupBy("pair", "subject").agg(F.sum("n").alias("n"))


def mine(documents: DataFrame, labels: DataFrame, terms: DataFrame) -> Rules:
    """Rules from the labelled sample and the listed terms. Sentences stay in the tasks; the driver gets items and kept rules."""
    listed = [(r.subject, fold(r.term)) for r in terms.select("subject", "term").distinct().collect() if r.subject and r.term]
    one = labels.filter("subject is not null and doc_id is not null").groupBy("doc_id").agg(F.min("subject").alias("subject"), F.count_distinct("subject").alias("n")).filter("n = 1")
    chosen = sample(one, FIT_DOCS, "doc_id").select("doc_id", "subject")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(s, sorted({fold(w) for w in words if not w[0].isdigit()})) for s, t in zip(b.subject, b.text, strict=True) for words in sentence_words(t)]
            yield pd.DataFrame(rows, columns=["subject", "words"])

    # the sample has about FIT_DOCS rows, so its side may be broadcast
    joined = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("subject", "text")
    baskets = joined.mapInPandas(split, "subject string, words array<string>").groupBy("subject", "words").agg(F.count("*").alias("n"))
    baskets = stored(baskets, "baskets")  # equal sentences once
    of = {r.subject: r.n for r in baskets.groupBy("subject").agg(F.sum("n").alias("n")).collect()}
    subjects = sorted(set(of) | {s for s, _ in listed})
    place = {s: i for i, s in enumerate(subjects)}
    base = np.array([of.get(s, 0) for s in subjects], float)
    scale = base.mean() / np.maximum(base, 1) if len(subjects) else base
    single: dict[str, tuple[int, float]] = {}
    double: dict[tuple[str, str], tuple[int, float]] = {}
    common: set[str] = set()
    odds = lambda p: float(np.log(p / (1 - p) * (len(subjects) - 1) / 2))
    if of:
        c = [F.col("counts")[i] for i in range(len(subjects))]
        most = F.greatest(*[x * float(k) for x, k in zip(c, scale, strict=True)]) if len(c) > 1 else c[0]
        lean = (most + 0.15) / (sum(x * float(k) for x, k in zip(c, scale, strict=True)) + 0.15 * len(subjects))
        words = _per_subject(baskets.select("subject", "n", F.explode("words").alias("word")), "word", subjects)
        terms_ = {t for _, t in listed}
        wanted = (sum(c) >= SUPPORT) & ((lean >= LEAN) | F.col("word").isin(*terms_))
        got = words.filter(wanted).sort("word").toPandas()
        counts = np.array(got.counts.tolist(), float).reshape(len(got), len(subjects))
        common = {w for w, n in zip(got.word, counts.sum(axis=1), strict=True) if n >= 3 * SUPPORT}
        leaning = _balanced(counts, scale)[1] >= LEAN
        names, counts = got.word[leaning].tolist(), counts[leaning]
        best, sure = _balanced(np.where(counts >= SUPPORT, counts, 0), scale)
        held = (counts >= SUPPORT).any(axis=1)
        sure = np.where(held, sure, 0.0)
        single = {w: (int(k), odds(p)) for w, k, p in zip(names, best, sure, strict=True) if p >= CONFIDENCE}
        pairs = _per_subject(_grown(baskets, {w: i for i, w in enumerate(names)}, subjects).filter(F.col("n") >= SUPPORT), "pair", subjects)
        rules = pickle.dumps((best, sure, scale))

        def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            best, sure, scale = pickle.loads(rules)
            for b in batches:
                if b.empty:
                    continue
                k, p = _balanced(np.array(b.counts.tolist(), float), scale)
                one, two = np.divmod(b.pair.to_numpy(np.int64), len(best))
                alone = np.maximum(np.where(best[one] == k, sure[one], 0.0), np.where(best[two] == k, sure[two], 0.0))
                kept = (p >= CONFIDENCE) & (p >= GAIN + alone)
                yield pd.DataFrame({"one": one[kept], "two": two[kept], "k": k[kept], "p": p[kept]})

        for r in pairs.mapInPandas(prune, "one bigint, two bigint, k int, p double").toPandas().itertuples():
            double[names[r.one], names[r.two]] = (int(r.k), odds(r.p))
    owners: dict[str, set[str]] = defaultdict(set)
    for s, t in listed:
        owners[t].add(s)
    for t, who in owners.items():
        if len(who) == 1 and t not in single and t not in common:
            single[t] = (place[next(iter(who))], odds(TERM))
    return Rules(subjects, single, double)


def document_subjects(documents: DataFrame, labels: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, subject, share, sentences: one row per document and subject with any sentence."""
    model = pickle.dumps(mine(documents, labels, terms))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rules = pickle.loads(model)
        for b in batches:
            rows = [(d, *x) for d, t in zip(b.doc_id, b.text, strict=True) for x in rules.shares(t)]
            yield pd.DataFrame(rows, columns=["doc_id", "subject", "share", "sentences"])

    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, subject string, share double, sentences int")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "subject_labels").select("doc_id", "subject"),
        table(spark, sf_dir, "subject_terms").select("subject", "term"),
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subjects of each document."""
    return document_subjects(*_tables(spark, sf_dir)).filter(F.col("share") >= SHARE).select("doc_id", "subject").distinct()


def p9_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per subject its documents, and the sum of their sentences on it."""
    rows = document_subjects(*_tables(spark, sf_dir)).filter(F.col("share") >= SHARE).distinct()
    return rows.groupBy("subject").agg(F.count("*").alias("documents"), F.sum(F.round(F.col("share") * F.col("sentences")).cast("long")).alias("sentences"))


QUERIES = {"p9_found": p9_found, "p9_composition": p9_composition}
