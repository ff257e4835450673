"""Problem 6: texts that were cut off, and how often each source cuts them.

Method: a stack automaton runs over the structural marks of the whole text
(quotes, brackets, markup, entities, replacement characters of broken
multibyte sequences) and tells what is still open at the end. What a cut may
leave behind or a later step may append (dots, a bracketed omission mark, an
opened quote) is set apart, and the rest is judged by its last mark: a
terminator, or none. A missing terminator counts against the source's own
baseline: where texts of a source usually end without one, or usually end with
a closing tag, that is expected or demanded. Whether a text without terminator
nevertheless ends a sentence is told by end statistics, counted over all
rows: how often a word, and the skeleton of the last words (frequent words
kept, others by kind), ends a sentence. The counts stay distributed: a text
whose end must be looked up is joined with them by the keys of its end. Where a
source has far more texts without end at one length than at lengths nearby,
that length is a limit of its field and counts against such a text.

Defined results: null and blank texts are never cut; repeated rows count once;
a row without source is judged as one of a source that ends its texts with
terminators and without tags; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions.folding import INVISIBLES, fold, unescape
from korale.session import stored, table

FREQUENT = 90  # words that the skeleton keeps
ORDERS = (7, 5, 4, 3, 2, 1)  # lengths of the skeleton, longest first
BITS = 7  # of a word in a skeleton's code; FREQUENT + 4 stay below their power
HELD = 500_000  # words that a task counts before it hands them on
FORMULA = 5  # occurrences from which a short sentence is a formula
LEAST = 10  # occurrences of a skeleton before it is used
WHOLE = -3.0  # log odds from which an end without terminator is a sentence's end
USUAL = 0.8  # share of a source's texts from which its lack of terminators is its baseline
SEEN = 3  # occurrences from which a word is known to be whole
NEARBY = 10  # characters to either side with which the texts of one length are compared
PEAK, PEAK_RATIO = 8, 5.0  # texts without end at a limit, and how many times as many as nearby they must be
MOST_WEIGHT = 6.0
TAGGED = 0.5  # the same for a closing tag

_MARK = re.compile(r"[“”\"«»()\[\]{}]|</?[a-zA-Z][^<>]*>|<[^<>]*$|<!--|-->|&#?\w{0,10}$|\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?$|�")
MARKED = r"[“”\"«»()\[\]{}<>&\\\\�…]"
_OPEN = {"“": "”", "«": "»", "(": ")", "[": "]", "{": "}"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr"}
_APPENDED = re.compile(r"(?:\s*(?:\[\s*(?:…|\.{2,}|\.\.\.)\s*\]|\(\s*(?:more|continued|cont\.?)\s*\)|(?:read|see)\s+more\b\W*|…+|\.{2,}|(?<=[^\s])-{1,2}|[“«(\[{]))+\s*$", re.I)
_TAGS = re.compile(r"(?:\s*</?[a-zA-Z][^<>]*>)+\s*$")
_CLOSERS = re.compile(r"[”\"»'’)\]\s]+$")
_ASIDE = re.compile(r"\s*(?:\([^()]{1,60}\)|\[[^\[\]]{1,20}\]|[—–]\s*[^\n.!?]{1,40})\s*[”\"»]*\s*$")
_END = re.compile(r"[.!?](?:[”\"»)\]]+)?(?=\s|$)|\n+|</?[a-zA-Z][^<>]*>")
_WORD = re.compile(r"[^\W_]+(?:-[^\W_]+)*-?")
_GROUP = re.compile(r"[(\[][^()\[\]]*[)\]]|[(\[].*$")
_EDGE = re.compile(f"[{INVISIBLES}\\s]+$")


def open_marks(text: str) -> list[str]:
    """The marks still open at the end of text; a broken character or a tag, entity or escape that stops half-way stays as '�'."""
    stack: list[str] = []
    for m in _MARK.finditer(text):
        mark = m.group()
        if mark in _OPEN:
            stack.append(mark)
        elif mark in "”»)]}":
            for i in range(len(stack) - 1, -1, -1):
                if _OPEN.get(stack[i]) == mark:
                    del stack[i:]
                    break
        elif mark == '"':
            if '"' in stack:
                del stack[stack.index('"') :]
            else:
                stack.append('"')
        elif mark == "�":
            if m.end() == len(text):
                stack.append("�")
        elif mark[0] == "<" and mark[-1] == ">":
            name = re.match(r"</?\s*(\w+)", mark).group(1).lower()
            if mark[1] == "/":
                if f"<{name}" in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(f"<{name}") :]
            elif name not in _VOID and mark[-2] != "/":
                stack.append(f"<{name}")
        elif mark[0] in "<&\\":
            stack.append("�")
    return stack


def _kind(word: str, capital: bool, frequent: set[str]) -> str:
    if word in frequent:
        return word
    return "#" if word[0].isdigit() else "C" if capital else "x"


def _sentence(text: str, frequent: set[str], all_caps: bool) -> tuple[list[str], list[str]]:
    """Folded words and skeleton of a stretch of text."""
    raw = _WORD.findall(text)
    low = [fold(w).strip("-") or w for w in raw]
    return low, ["^"] + [_kind(w, not all_caps and r[0].isupper() and i > 0, frequent) for i, (w, r) in enumerate(zip(low, raw, strict=True))]


def sentences(text: str) -> list[str]:
    """The stretches of text between terminators, line ends and tags."""
    return [s for s in _END.split(text) if s and not s.isspace()]


def _key(kind: str, what: str) -> int:
    """The key under which a word (w), a formula (f) or a skeleton (s) is counted."""
    return xxhash.xxh3_64_intdigest(kind + what) - (1 << 63)


def _skeleton_keys(skeleton: list[str]) -> list[int | None]:
    """The keys of the ends of a skeleton, one per length of ORDERS; null where it is shorter."""
    return [_key("s", " ".join(skeleton[-k:])) if k <= len(skeleton) else None for k in ORDERS]


class Skeletons:
    """Counts skeletons of sentences. A skeleton is coded in bits, BITS for each word, the last one lowest."""

    def __init__(self, frequent: set[str]):
        self.names = ["", "^", "#", "C", "x", *sorted(frequent)]
        self.number = {w: i for i, w in enumerate(self.names)}

    def count(self, found: list[list[str]]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(keys, how often they occur, how often at an end) of the skeletons of ORDERS words in the sentences."""
        flat = np.array([self.number[w] for s in found for w in s], np.int64)
        size = np.array([len(s) for s in found], np.int64)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
        last = place == np.repeat(size, size) - 1
        codes, ends = [], []
        for k in ORDERS:
            at = np.flatnonzero(place >= max(1, k - 1))
            codes.append(sum(flat[at - t] << (BITS * t) for t in range(k)))
            ends.append(last[at])
        got, where, n = np.unique(np.concatenate(codes), return_inverse=True, return_counts=True)
        return [self._named(c) for c in got.tolist()], n, np.bincount(where, np.concatenate(ends), len(got)).astype(np.int64)

    def _named(self, code: int) -> int:
        words = []
        while code:
            words.append(self.names[code & ((1 << BITS) - 1)])
            code >>= BITS
        return _key("s", " ".join(reversed(words)))


def _closed(text: str, frequent: set[str]) -> Iterator[tuple[list[str], list[str]]]:
    """Words and skeletons of the sentences of text that have their end."""
    parts = sentences(text)
    if not re.search(r"(?:^|[^.])[.!?][”\"»)\]\s]*(?:</\w+>\s*)*$", text):
        parts = parts[:-1]
    caps = text.upper() == text
    for s in (_GROUP.sub(" ", x) for x in parts):
        low, skeleton = _sentence(s, frequent, caps)
        if low:
            yield low, skeleton


def frequent_words(texts: DataFrame) -> set[str]:
    """The FREQUENT most frequent words of texts (t)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter[str] = Counter()
        for b in batches:
            for t in b.t:
                seen.update(_WORD.findall(fold(unescape(t))))
            if len(seen) > HELD:
                yield pd.DataFrame(seen.items(), columns=["w", "n"])
                seen = Counter()
        yield pd.DataFrame(seen.items(), columns=["w", "n"])

    seen = texts.mapInPandas(count, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(FREQUENT)
    return {r.w for r in seen.collect() if not r.w[0].isdigit()}


def end_counts(texts: DataFrame, frequent: set[str]) -> DataFrame:
    """key, kind, n, ends: how often words (w), skeletons (s) and short sentences (f) of texts (t) occur, and how often at a sentence's end; those of their least count."""
    columns = ["key", "kind", "n", "ends"]
    skeletons = Skeletons(frequent)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            words: Counter[str] = Counter()
            last: Counter[str] = Counter()
            formulas: Counter[str] = Counter()
            found = []
            for t in b.t:
                for low, skeleton in _closed(unescape(t), frequent):
                    words.update(low)
                    last[low[-1]] += 1
                    if len(low) <= 6:
                        formulas[" ".join(low)] += 1
                    found.append(skeleton)
            yield pd.DataFrame([(_key("w", w), "w", n, last[w]) for w, n in words.items()] + [(_key("f", w), "f", n, 0) for w, n in formulas.items()], columns=columns)
            if found:
                keys, n, ends = skeletons.count(found)
                yield pd.DataFrame({"key": keys, "kind": "s", "n": n, "ends": ends}, columns=columns)

    counted = texts.mapInPandas(measure, "key bigint, kind string, n bigint, ends bigint").groupBy("key", "kind").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
    least = F.when(F.col("kind") == "w", 1).when(F.col("kind") == "s", LEAST).otherwise(FORMULA)
    return stored(counted.filter(F.col("n") >= least), "ends")


def parts(text: str) -> tuple[str, bool, bool, list[str]]:
    """(stem, appended, tagged, open): text without what was appended to it or closes it."""
    body = _EDGE.sub("", text)
    still = open_marks(body)
    appended = False
    tagged = bool(_TAGS.search(body))
    body = _TAGS.sub("", body)
    if m := _APPENDED.search(body):
        appended, body = True, body[: m.start()]
    return body.rstrip(), appended, tagged, still


def ends_whole(stem: str) -> bool:
    """True where stem, perhaps after an aside (a name, a reference), has its terminator."""
    for _ in range(3):
        bare = _CLOSERS.sub("", stem) if stem[-1:] not in ")]" else stem
        if bare[-1:] in (".", "!", "?", ":"):
            return True
        if not (m := _ASIDE.search(stem)):
            return False
        stem = stem[: m.start()].rstrip()
        if not stem:
            return False
    return False


class Judgement(NamedTuple):
    """What a text tells by itself: cut or not (null where its end must be looked up), cut if its source's texts end with tags; and what to look up."""

    cut: bool | None
    untagged: bool = False
    keys: list[int | None] | None = None  # formula, word (null for a number), skeletons
    shift: float = 0.0


def judge(text: str | None, frequent: set[str]) -> Judgement:
    """The automaton's verdict on text, and the keys of its end where there is neither a terminator nor an open mark that decides."""
    if text is None or not text.strip():
        return Judgement(False)
    text = unescape(text) if "&" in text else text
    stem, appended, tagged, still = parts(text)
    if "�" in still:
        return Judgement(True)
    untagged = not tagged and any(m[0] == "<" for m in still)
    if ends_whole(stem):
        return Judgement(bool(still and _APPENDED.search(text) and still[-1] in _OPEN and text.rstrip().endswith(still[-1])), untagged)
    if text.rstrip()[-1:] in _OPEN:
        return Judgement(True)
    if not stem:
        return Judgement(False, untagged)
    stem = _ASIDE.sub("", stem) or stem
    found = sentences(stem)
    low, skeleton = _sentence(found[-1], frequent, stem.upper() == stem) if found else ([], [])
    if not low:
        return Judgement(False, untagged)
    word = None if low[-1][0].isdigit() else _key("w", low[-1])
    return Judgement(None, untagged, [_key("f", " ".join(low)), word, *_skeleton_keys(skeleton)], -1.0 if any(m in _OPEN for m in still) else 0.0)


def log_odds(probes: DataFrame, counts: DataFrame) -> DataFrame:
    """probe, odds: the log odds that a text with the keys of probes (probe, keys) stops at a sentence's end."""
    totals = counts.filter("kind = 'w'").agg(F.sum("ends").alias("ends"), F.sum(F.when(F.col("n") >= SEEN, F.col("n"))).alias("n")).first()
    rate = (totals.ends or 0) / max(1, totals.n or 0)
    looked = probes.select("probe", F.posexplode("keys").alias("slot", "key")).filter("key is not null")
    hit = looked.join(counts.filter(F.col("n") >= SEEN).select("key", "n", "ends"), "key", "left")
    found = F.when((F.col("slot") >= 2) & F.col("n").isNotNull(), F.col("slot"))
    each = hit.groupBy("probe").agg(
        F.max(F.when(F.col("slot") == 0, F.col("n"))).alias("formula"),
        F.max(F.when(F.col("slot") == 1, 1)).alias("worded"),
        F.max(F.when(F.col("slot") == 1, F.struct("n", "ends"))).alias("word"),
        F.min_by(F.struct("n", "ends"), found).alias("skeleton"),
    )
    p = (F.col("skeleton.ends") + 0.01) / (F.col("skeleton.n") + 1)
    base = F.coalesce(F.log(p / (1 - p)), F.lit(-6.0))
    last = F.log((F.col("word.ends") + 0.3) / (F.col("word.n") * rate + 0.3))
    worded = F.when(F.col("word.n").isNull(), F.least(base, F.lit(0.0)) - 6.0).otherwise(base + F.least(F.lit(1.0), F.greatest(F.lit(-3.0), last)))
    return each.select("probe", F.when(F.col("formula").isNotNull(), 9.0).when(F.col("worded").isNull(), base).otherwise(worded).alias("odds"))


def baselines(rows: DataFrame, source: str, text: str) -> DataFrame:
    """Per source: texts, and the shares that end with a terminator and with a tag."""
    t = F.rtrim(F.col(text))
    return (
        rows.filter(F.col(text).isNotNull())
        .groupBy(F.col(source).alias("source"))
        .agg(
            F.count("*").alias("texts"),
            F.avg(t.rlike(r"[.!?][”\"»)\]]*(</\w+>\s*)*$").cast("double")).alias("terminated"),
            F.avg(t.rlike(r"</?\w[^<>]*>$").cast("double")).alias("tagged"),
        )
    )


def limits(judged: DataFrame) -> DataFrame:
    """source, kind (chars or bytes), n, weight: the lengths at which a source cuts its texts.

    At a limit far more texts lack their end than at lengths nearby; weight is
    the log of that ratio. Lengths next to the limit, where blanks were cut off
    after it, show the same and are found in the same way.
    """
    each = judged.filter("source is not null and chars > 0").select("source", F.col("probe").isNotNull().cast("bigint").alias("open"), F.inline(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("n")) for k in ("chars", "bytes")])))
    counted = each.groupBy("source", "kind", "n").agg(F.count("*").alias("all"), F.sum("open").alias("open"))
    w = Window.partitionBy("source", "kind").orderBy("n")  # one row per length, so a source has as many as its longest text has characters at most
    beside = (F.coalesce(F.sum("open").over(w.rangeBetween(-NEARBY, -3)), F.lit(0)) + F.coalesce(F.sum("open").over(w.rangeBetween(3, NEARBY)), F.lit(0))) / (2 * (NEARBY - 2))
    peaks = counted.withColumn("weight", F.log(F.col("open") / F.greatest(beside, F.lit(1.0))))
    return peaks.filter((F.col("open") >= PEAK) & (F.col("weight") >= math.log(PEAK_RATIO)) & (F.col("open") * 2 >= F.col("all"))).select("source", "kind", "n", F.least("weight", F.lit(MOST_WEIGHT)).alias("weight"))


def truncated(rows: DataFrame, key: str, text: str, source: str, kinds: str | None = None) -> DataFrame:
    """One row per row of rows: key, source, cut (boolean).

    kinds names a column by whose value texts without any sentence are left out
    of the statistics: rows where it is `word` or `expression` are cut only
    where they end in a broken character.

    Texts are judged where they are read; what has to be looked up is joined by
    keys, and so are the baselines of the sources, whatever their number.
    """
    short = F.coalesce(F.col(kinds).isin("word", "expression"), F.lit(False)) if kinds else F.lit(False)
    whole = rows.filter(~short).select(F.col(text).alias("t")).filter("t is not null and trim(t) != ''")
    frequent = frequent_words(whole)
    counts = end_counts(whole, frequent)
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [judge(t, frequent) if not short else Judgement(bool(t) and t.rstrip()[-1:] == "�") for t, short in zip(b.t, b.short, strict=True)]
            yield pd.DataFrame(
                {key: b.k, "source": b.s, "known": [g.cut for g in got], "untagged": [g.untagged for g in got], "keys": [g.keys for g in got], "shift": [g.shift for g in got], "chars": b.chars, "bytes": b.bytes}
            )

    raw = F.coalesce(F.col(text), F.lit(""))
    plain = F.col(text).rlike(r"[^.][.!?]$") & ~F.col(text).rlike(MARKED)  # these are whole: a terminator and nothing to be left open
    asked = rows.select(F.col(key).alias("k"), F.when(~plain, F.col(text)).alias("t"), F.col(source).alias("s"), short.alias("short"), F.length(raw).alias("chars"), F.octet_length(raw).alias("bytes"))
    judged = asked.mapInPandas(run, f"`{key}` {kind}, source string, known boolean, untagged boolean, keys array<bigint>, shift double, chars int, bytes int")
    judged = stored(judged.withColumn("probe", F.when(F.col("keys").isNotNull(), F.xxhash64("keys"))), "judged")
    odds = log_odds(judged.filter("probe is not null").select("probe", "keys").dropDuplicates(["probe"]), counts)
    base = baselines(rows, source, text).select("source", (F.col("tagged") >= TAGGED).alias("tags"), (F.col("terminated") < 1 - USUAL).alias("bare"))
    joined = judged.select(key, "source", "known", "untagged", "probe", "shift", "chars", "bytes").join(base.filter("source is not null"), "source", "left").join(odds, "probe", "left")
    found = stored(limits(judged), "limits")
    for c in ("chars", "bytes"):
        joined = joined.join(found.filter(F.col("kind") == c).select("source", F.col("n").alias(c), F.col("weight").alias(f"at_{c}")), ["source", c], "left")
    at_limit = F.greatest(F.coalesce("at_chars", F.lit(0.0)), F.coalesce("at_bytes", F.lit(0.0)))
    below = F.col("odds") + F.col("shift") - at_limit + F.when(F.col("bare"), 2.0).otherwise(0.0) < WHOLE  # a source that does without terminators
    cut = (F.col("untagged") & F.coalesce("tags", F.lit(False))) | F.coalesce("known", below, F.lit(False))
    return joined.select(key, "source", cut.alias("cut"))


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(table(spark, sf_dir, "aligned_pairs").select("id", "tvl", "source_file", "content_type"), "id", "tvl", "source_file", "content_type")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated(table(spark, sf_dir, "articles").select("id", "body_en", "source_id"), "id", "body_en", "source_id")


def _found(cut: DataFrame, name: str) -> DataFrame:
    return cut.filter("cut").select(F.lit(name).alias("record_table"), F.col("id").alias("record_id")).distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cut records of both tables."""
    return _found(_pairs(spark, sf_dir), "aligned_pairs").unionByName(_found(_articles(spark, sf_dir), "articles"))


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table and source: records, cut records and their rate."""

    def rates(cut: DataFrame, name: str) -> DataFrame:
        once = cut.groupBy("id", "source").agg(F.max("cut").alias("cut"))
        return once.groupBy("source").agg(F.count("*").alias("records"), F.count_if("cut").alias("cut_records")).select(
            F.lit(name).alias("record_table"), "source", "records", "cut_records", F.round(F.col("cut_records") / F.col("records"), 4).alias("cut_rate")
        )

    return rates(_pairs(spark, sf_dir), "aligned_pairs").unionByName(rates(_articles(spark, sf_dir), "articles"))


QUERIES = {"p6_found": p6_found, "p6_rates": p6_rates}
