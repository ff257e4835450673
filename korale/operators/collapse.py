"""Degenerate repetition in generated texts, by n-gram statistics."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.session import spread

# Sizes and limits of the detectors.
LEAST_WORDS, UNIQUE_LIMIT, TOP_LIMIT = 20, 0.3, 0.4
TAIL, TAIL_UNIQUE, TAIL_TOP = 80, 0.25, 0.10
SPAN, STRIDE, SPAN_UNIQUE, SPAN_TOP = 100, 50, 0.20, 0.12
PHRASES, PHRASE_TIMES = (5, 6, 7, 8), 8
PARAGRAPH_WORDS, PARAGRAPH_UNIQUE, PARAGRAPH_TOP = 30, 0.15, 0.5
_WORD = re.compile(r"\w+")


class Grams:
    """Counts of the n-grams of a list of words."""

    def __init__(self, words: list[str], n: int):
        self.total = max(0, len(words) - n + 1)
        self.counts = Counter(zip(*(words[i:] for i in range(n)), strict=False)) if self.total else Counter()
        self.enough = len(words) > n

    @property
    def unique(self) -> float:
        return len(self.counts) / self.total if self.enough else 1.0

    @property
    def top(self) -> float:
        return max(self.counts.values()) / self.total if self.enough else 0.0


def _spans(words: list[str]) -> Iterator[list[str]]:
    for start in range(0, len(words) - SPAN + 1, STRIDE):
        yield words[start : start + SPAN]


def _dense(words: list[str], least: int, unique: float, top: float) -> bool:
    for n in (3, 4):
        g = Grams(words, n)
        if g.total >= least and (g.unique < unique or g.top > top):
            return True
    return False


def score(text: str | None) -> float:
    """0 (none) to 1 (nothing but repetition): the worst of the whole text, its tail and its spans."""
    words = _WORD.findall((text or "").lower())
    if len(words) < LEAST_WORDS:
        return 0.0
    g = Grams(words, 4)
    whole = 0.7 * (1 - g.unique) + 0.3 * g.top
    tail = 0.8 * (1 - Grams(words[-TAIL:], 4).unique)
    span = 0.85 * max((1 - Grams(w, 4).unique for w in _spans(words)), default=0.0)
    return min(1.0, max(whole, tail, span))


def signals(text: str | None) -> dict[str, bool]:
    """The detectors, each by name."""
    text = text or ""
    words = _WORD.findall(text.lower())
    names = ("unique", "top", "tail", "span", "phrase", "paragraph")
    if len(words) < LEAST_WORDS:
        return dict.fromkeys(names, False)
    g = Grams(words, 4)
    paragraphs = [Grams(w, 4) for p in text.split("\n\n") if len(w := _WORD.findall(p.lower())) >= PARAGRAPH_WORDS]
    phrase = len(words) >= PHRASES[0] * PHRASE_TIMES and any(max(Grams(words, n).counts.values(), default=0) >= PHRASE_TIMES for n in PHRASES)
    return {
        "unique": g.unique < UNIQUE_LIMIT,
        "top": g.top > TOP_LIMIT,
        "tail": len(words) >= TAIL and _dense(words[-TAIL:], 5, TAIL_UNIQUE, TAIL_TOP),
        "span": any(_dense(w, 10, SPAN_UNIQUE, SPAN_TOP) for w in _spans(words)),
        "phrase": phrase,
        "paragraph": any(p.unique < PARAGRAPH_UNIQUE or p.top > PARAGRAPH_TOP for p in paragraphs),
    }


def collapse(rows: DataFrame, key: str, *texts: str) -> DataFrame:
    """key, collapse_score (the worst of texts, four places), is_collapsed and the detectors that spoke, in one Arrow pass."""
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, *ts in zip(b[key], *(b[t] for t in texts), strict=True):
                found = sorted({n for t in ts for n, v in signals(t).items() if v})
                out.append((k, round(max(score(t) for t in ts), 4), bool(found), found))
            yield pd.DataFrame(out, columns=[key, "collapse_score", "is_collapsed", "detectors"])

    return spread(rows.select(key, *texts)).mapInPandas(run, f"`{key}` {kind}, collapse_score double, is_collapsed boolean, detectors array<string>")


def best_attempt(attempts: DataFrame, group: str, number: str, collapsed: Column) -> DataFrame:
    """Per group the first attempt that isn't collapsed, else the last one."""
    bad = F.coalesce(collapsed, F.lit(False)).cast("int")
    order = Window.partitionBy(group).orderBy(bad, F.when(bad == 0, F.col(number)), F.when(bad == 1, -F.col(number)), "id")
    return attempts.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")
