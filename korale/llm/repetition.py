"""Problem 4: the share of repeated content inside each document.

Method: cheap statistics of each document (distinct words and word pairs,
repeated n-grams, the most frequent phrase, the repetition of its tail) are
scored by gradient-boosted trees with monotonic constraints, flattened into
numpy node arrays. The trees are fitted, on a documented bounded sample
(about FIT_ROWS documents), against the exact share of words standing in a
repeated stretch. Every document gets the estimate, which decides where it is
below CANDIDATE or, for p4_found, from SURE on; documents in between are
measured exactly. Statistics, trees and measurement run over all documents of
a batch at once.

Defined results: a null, empty or very short text has share 0; repeated rows
give equal rows; other columns are ignored, so clashing names do no harm.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.llm import gbt
from korale.session import sample, spread, table

STRETCH = 5  # words
FIT_ROWS = 3000  # about so many documents are the sample that the trees are fitted on
CANDIDATE = 0.08  # estimate from which a document is measured exactly,
SURE = 0.40  # and from which the trees alone find it repetitive
REPEATED = 0.25  # share that counts as repetitive; no body lies between 0.2 and 0.3
BATCH_CHARS = 2_000_000  # of the texts handled at once; a longer text is handled alone
NAMES = ("log_words", "distinct_words", "distinct_2", "repeated_3", "repeated_4", "repeated_8", "top_2", "top_4", "tail_repeated_3")
MONOTONE = {1: -1, 2: -1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1}
TAIL = 80  # words
_WORD = re.compile(r"[^\W\d_]+")


class Texts:
    """The words of some texts, as numbers, one text behind the other."""

    def __init__(self, texts: list[str | None]):
        found = [_WORD.findall((t or "").lower()) for t in texts]
        self.size = np.array([len(w) for w in found], np.int64)
        self.owner = np.repeat(np.arange(len(found)), self.size)
        self.ids = pd.factorize(np.array([x for w in found for x in w], dtype=object))[0].astype(np.int64) if self.size.sum() else np.zeros(0, np.int64)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the n words from each position on that has them, the positions); equal stretches of a text have equal numbers, which rise with first occurrence."""
        last = len(self.ids) - n + 1
        if last <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.owner[:last] == self.owner[n - 1 :])
        with np.errstate(over="ignore"):
            mixed = (self.owner[:last].astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
            for k in range(n):
                mixed = (mixed ^ self.ids[k : last + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
        return pd.factorize(mixed[at])[0].astype(np.int64), at

    @staticmethod
    def later(gram: np.ndarray) -> np.ndarray:
        """True where the same gram began earlier."""
        highest = np.maximum.accumulate(gram)
        return gram <= np.concatenate([[-1], highest[:-1]]) if len(gram) else np.zeros(0, bool)

    def per_text(self, at: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(self.owner[at], values, len(self.size)).astype(float)

    def repeated_share(self) -> np.ndarray:
        """Per text the share of the words in stretches of STRETCH or more words that occurred earlier in it."""
        gram, at = self.grams(STRETCH)
        at = at[self.later(gram)]
        edge = np.bincount(at, minlength=len(self.ids) + 1) - np.bincount(at + STRETCH, minlength=len(self.ids) + 1)
        covered = np.cumsum(edge)[:-1] > 0
        return np.bincount(self.owner, covered, len(self.size)) / np.maximum(self.size, 1)

    def _top(self, gram: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Per text how often its most frequent gram stands there."""
        out = np.zeros(len(self.size))
        first = ~self.later(gram)
        np.maximum.at(out, self.owner[at[first]], np.bincount(gram).astype(float) if len(gram) else np.zeros(0))
        return out

    def statistics(self) -> np.ndarray:
        """[text, feature of NAMES]."""
        got = {n: self.grams(n) for n in (1, 2, 3, 4, 8)}
        later = {n: self.later(g) for n, (g, _) in got.items()}
        total = {n: np.maximum(1, self.size - n + 1) for n in got}
        repeated = {n: self.per_text(at[later[n]]) / total[n] for n, (_, at) in got.items()}
        at = got[3][1]
        tail = at >= (np.cumsum(self.size) - 2 - TAIL)[self.owner[at]]
        short = self.size < STRETCH
        x = np.column_stack([
            np.log1p(self.size), 1 - repeated[1], 1 - repeated[2], repeated[3], repeated[4], repeated[8], self._top(*got[2]) / total[2], self._top(*got[4]) / total[4],
            self.per_text(at[tail], later[3][tail]) / np.maximum(1, self.per_text(at[tail])),
        ])
        x[short, 1:3], x[short, 3:] = 1.0, 0.0
        return x


def repeated_share(text: str | None) -> float:
    """The share of one text."""
    return float(Texts([text]).repeated_share()[0])


def _parts(texts: pd.Series) -> Iterator[tuple[slice, list[str | None]]]:
    """Runs of rows with about BATCH_CHARS characters."""
    start, chars = 0, 0
    values = texts.tolist()
    for i, t in enumerate(values):
        if chars and chars + len(t or "") > BATCH_CHARS:
            yield slice(start, i), values[start:i]
            start, chars = i, 0
        chars += len(t or "")
    if start < len(values):
        yield slice(start, len(values)), values[start:]


def fit_estimator(texts: DataFrame, key: str, text: str) -> gbt.Forest | None:
    """Trees for the share, fitted on a sample by a hash of the key, whose texts stay in the tasks; None for an empty table."""
    seen = sample(texts.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")), FIT_ROWS, "k")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for _, part in _parts(b.t):
                t = Texts(part)
                yield pd.DataFrame({"x": t.statistics().tolist(), "y": t.repeated_share()})

    got = spread(seen).mapInPandas(measure, "x array<double>, y double").toPandas()
    if got.empty:
        return None
    x = np.array(got.x.tolist())
    order = np.lexsort((*x.T, got.y))  # so that the trees don't depend on the order of the tasks
    return gbt.fit(x[order], got.y.to_numpy()[order], logistic=False, trees=50, depth=4, monotone=MONOTONE, names=NAMES)


def repetition(texts: DataFrame, key: str = "id", text: str = "body_tvl", sure: float = 1.1) -> DataFrame:
    """One row per row of texts: key, estimate of the trees, repeated_share.

    repeated_share is exact where the estimate is from CANDIDATE to below sure,
    else the estimate, held between 0 and CANDIDATE or from sure to 1.
    """
    forest = fit_estimator(texts, key, text)
    kind = texts.schema[key].dataType.simpleString()
    model = pickle.dumps(forest)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = pickle.loads(model)
        for b in batches:
            for rows, part in _parts(b.t):
                estimate = np.clip(trees.predict(Texts(part).statistics()), 0, 1)
                share = np.where(estimate >= sure, estimate, np.minimum(estimate, CANDIDATE))
                doubtful = np.flatnonzero((estimate >= CANDIDATE) & (estimate < sure))
                if len(doubtful):
                    share[doubtful] = Texts([part[i] for i in doubtful]).repeated_share()
                yield pd.DataFrame({key: b.k.iloc[rows], "estimate": estimate, "repeated_share": share})

    return spread(texts.select(F.col(key).alias("k"), F.col(text).alias("t"))).mapInPandas(
        score, f"`{key}` {kind}, estimate double, repeated_share double"
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """translation_id of each translation whose body repeats itself."""
    got = repetition(table(spark, sf_dir, "translations").select("id", "body_tvl"), sure=SURE)
    return got.filter(F.col("repeated_share") >= REPEATED).select(F.col("id").alias("translation_id")).distinct()


def p4_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repeated share of each translation, beside the stored collapse_score."""
    rows = table(spark, sf_dir, "translations").select("id", "body_tvl")
    return repetition(rows).select(F.col("id").alias("translation_id"), F.round("repeated_share", 4).alias("repeated_share"))


QUERIES = {"p4_found": p4_found, "p4_shares": p4_shares}
