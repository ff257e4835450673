"""Problem 3: a language with a confidence for documents, segments and paragraphs.

Method: every language has a Bloom filter over its character n-grams; the
filters are kept bit-sliced, so that one slot holds a bitmask of the languages
and one look-up (the AND of HASHES slots) returns all languages that contain
an n-gram. A text's look-ups are popcounted per language, each count is
corrected for the filter's false positives, and the languages' shares decide.

The filters are fitted on a documented bounded sample (FIT_ROWS labelled
segments): the labels may be wrong or the texts mixed, so an n-gram enters a
language's filter only where its rate among that language's texts is at least
RATIO of its highest rate in any language.

Defined results: null, blank and wordless texts get no row; a paragraph without
words gets no row but keeps its number; repeated rows count once; rows without
segment_id are left out.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.functions.folding import fold
from korale.session import sample, spread, stored, table

LANGUAGES = ("tvl", "en", "sm", "gil")
SPELLINGS = {
    "tvl": "tvl", "tuvaluan": "tvl", "tv": "tvl", "en": "en", "eng": "en", "english": "en",
    "sm": "sm", "smo": "sm", "samoan": "sm", "gil": "gil", "gilbertese": "gil", "kiribati": "gil", "ikiribati": "gil",
}
FIT_ROWS = 3000  # bound of the labelled sample
ORDERS = (3, 4, 5)  # characters of an n-gram; blanks stand at word edges
RATIO = 0.5  # of an n-gram's highest rate, from which a language has it
LEAST = 4  # texts of a language that must have an n-gram
BITS = 20  # the filters have 2 ** BITS slots
HASHES = 3
SURE = 0.6  # share of a paragraph's evidence from which its language is told
WORDS = 12  # words of a paragraph below which it doesn't make a segment mixed

_LETTERS = re.compile(r"[^\W\d_]+(?:[-][^\W\d_]+)*")
_BLANK = re.compile(r"\n[^\S\n]*\n\s*")
_BRACKET = re.compile(r"\([^()\n]{1,40}\)")


def label(raw: Column) -> Column:
    """The language that a label names, in any spelling; null where it names none."""
    base = F.regexp_extract(F.lower(F.trim(raw)), r"^([a-z]+)", 1)
    known = F.create_map(*[F.lit(x) for pair in SPELLINGS.items() for x in pair])
    return F.element_at(known, F.when(F.trim(raw) != "", base))


def paragraphs(text: str) -> list[str]:
    """The stretches of text between blank lines."""
    return [p for p in _BLANK.split(text.strip("\n")) if p.strip()]


def _plain(text: str) -> str:
    return " " + " ".join(_LETTERS.findall(fold(_BRACKET.sub(" ", text)))) + " "


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character n-grams of texts, one per occurrence, and the place of each one's text in the list."""
    lows = [_plain(t) for t in texts]
    code = np.frombuffer("".join(lows).encode("utf-32-le"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(lows)), [len(x) for x in lows])
    out, of = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    with np.errstate(over="ignore"):
        for n in ORDERS:
            m = len(code) - n + 1
            if m <= 0:
                continue
            h = np.full(m, n, np.uint64)
            for k in range(n):
                h = (h ^ code[k : m + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            inside = owner[:m] == owner[n - 1 :]
            out.append(h[inside])
            of.append(owner[:m][inside])
    return np.concatenate(out), np.concatenate(of)


class LanguageFilters:
    """Bit-sliced Bloom filters: slot -> bitmask of languages."""

    def __init__(self, slots: np.ndarray, languages: tuple[str, ...]):
        self.slots = slots
        self.languages = languages
        fill = [np.mean((slots >> b) & 1) for b in range(len(languages))]
        self.false = np.array(fill) ** HASHES

    @staticmethod
    def _places(h: np.ndarray) -> Iterator[np.ndarray]:
        step = (h >> np.uint64(40)) | np.uint64(1)
        with np.errstate(over="ignore"):
            for k in range(HASHES):
                yield ((h + np.uint64(k) * step) & np.uint64((1 << BITS) - 1)).astype(np.int64)

    @classmethod
    def fit(cls, hashes: np.ndarray, mask: np.ndarray, languages: tuple[str, ...]) -> LanguageFilters:
        """mask[i]: the languages that have n-gram hashes[i]."""
        slots = np.zeros(1 << BITS, np.uint8)
        for place in cls._places(hashes):
            np.bitwise_or.at(slots, place, mask)
        return cls(slots, languages)

    def masks(self, h: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram."""
        out = np.full(len(h), 255, np.uint8)
        for place in self._places(h):
            out &= self.slots[place]
        return out

    def evidence(self, texts: list[str]) -> np.ndarray:
        """[text, a, b]: the n-grams of each text that language a has and b lacks, corrected for false positives of a; the diagonal has all of a's."""
        h, of = grams(texts)
        mask = self.masks(h)
        k = len(self.languages)
        kinds = np.bincount(of * 256 + mask, minlength=256 * len(texts)).reshape(len(texts), 256)
        has = (np.arange(256)[:, None] >> np.arange(k)) & 1
        told = (np.arange(256) != 0) & (np.arange(256) != (1 << k) - 1)
        only = has[:, :, None] * (1 - has[:, None, :]) + has[:, :, None] * np.eye(k, dtype=int)
        hits = np.einsum("tm,mab->tab", kinds, only * told[:, None, None]).astype(float)
        seen = kinds.sum(axis=1)[:, None, None]
        return np.maximum(0.0, (hits - seen * self.false[:, None]) / (1 - self.false[:, None]))

    def decide(self, texts: list[str]) -> list[tuple[str | None, float, list[float]]]:
        """Per text its language, the confidence (the best's share of the n-grams that only it or only the second has) and all popcounts."""
        out: list[tuple[str | None, float, list[float]]] = []
        for pairs in self.evidence(texts):
            e = np.diag(pairs)
            a, b = np.argsort(-e, kind="stable")[:2]
            both = pairs[a, b] + pairs[b, a]
            out.append((self.languages[a] if e[a] > 0 else None, float(pairs[a, b] / both) if both else 0.0, e.tolist()))
        return out


def fit(segments: DataFrame) -> LanguageFilters:
    """Filters from about FIT_ROWS labelled segments, chosen by a hash of their id.

    N-grams are counted in the tasks; the driver gets those that enter a filter,
    as a hash and a bitmask each.
    """
    named = segments.select("segment_id", "text", label(F.col("likely_language")).alias("l")).filter("l is not null and text is not null")
    columns = [f"n_{b}" for b in range(len(LANGUAGES))]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for start in range(0, len(whole), 200):
                part = whole.iloc[start : start + 200]
                for b, lang in enumerate(LANGUAGES):
                    ps = [p for t in part.text[part.l == lang] for p in paragraphs(t)]
                    if not ps:
                        continue
                    h, of = grams(ps)
                    with np.errstate(over="ignore"):
                        once = h[np.unique(h * np.uint64(31) + of.astype(np.uint64), return_index=True)[1]]  # once per paragraph
                    h, n = np.unique(once, return_counts=True)
                    out = pd.DataFrame(0, index=range(len(h) + 1), columns=columns, dtype=np.int64)
                    out[f"n_{b}"] = np.append(n, len(ps))
                    out.insert(0, "h", pd.array([*h.view(np.int64).tolist(), None], dtype="Int64"))  # the row without hash counts the paragraphs
                    yield out

    picked = spread(sample(named, FIT_ROWS, "segment_id").select("l", "text"))
    counted = picked.mapInPandas(count, ", ".join(["h bigint", *(f"{c} bigint" for c in columns)]))
    counted = stored(counted.groupBy("h").agg(*[F.sum(c).alias(c) for c in columns]), "grams")
    paras = counted.filter("h is null").first()
    if paras is None:
        return LanguageFilters(np.zeros(1 << BITS, np.uint8), LANGUAGES)
    texts = [paras[c] for c in columns]
    rates = [F.col(c) / max(n, 1) for c, n in zip(columns, texts, strict=True)]
    mask = sum(
        F.when((r >= RATIO * F.greatest(*rates)) & (F.col(c) >= min(LEAST, max(1, n // 4))), 1 << b).otherwise(0)
        for b, (c, r, n) in enumerate(zip(columns, rates, texts, strict=True))
    )
    got = counted.filter("h is not null").select("h", mask.alias("mask")).filter("mask != 0").toPandas()
    return LanguageFilters.fit(got.h.to_numpy(np.int64).view(np.uint64), got["mask"].to_numpy(np.uint8), LANGUAGES)


PARAGRAPHS = "array<struct<para_no int, words int, lang string, confidence double, evidence array<double>>>"


def segment_paragraphs(segments: DataFrame, filters: LanguageFilters | None = None) -> DataFrame:
    """segment_id, source_path, named (the language of its label), paras: one row per segment; its paragraphs with words.

    Texts are judged where they are read. A segment delivered twice counts once;
    of several texts that of the least hash.
    """
    model = pickle.dumps(filters or fit(segments))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = pickle.loads(model)
        for b in batches:
            found, rows = [], []
            for k, text in enumerate(b.text):
                for n, p in enumerate(paragraphs(text or ""), 1):
                    if words := len(_LETTERS.findall(_BRACKET.sub(" ", p))):
                        found.append((k, n, words, p))
            of: list[list[dict]] = [[] for _ in range(len(b))]
            for i in range(0, len(found), 64):
                part = found[i : i + 64]
                for (k, n, words, _), (lang, confidence, evidence) in zip(part, filters.decide([x[3] for x in part]), strict=True):
                    of[k].append({"para_no": n, "words": words, "lang": lang, "confidence": confidence, "evidence": evidence})
            rows = b[["segment_id", "source_path", "named", "h"]].assign(paras=of)
            yield rows

    rows = segments.filter("segment_id is not null").select("segment_id", "source_path", label(F.col("likely_language")).alias("named"), F.xxhash64("text").alias("h"), "text")
    judged = spread(rows).mapInPandas(run, f"segment_id string, source_path string, named string, h bigint, paras {PARAGRAPHS}")
    once = judged.groupBy("segment_id").agg(F.min_by(F.struct("source_path", "paras"), F.struct("h", "source_path")).alias("r"), F.min("named").alias("named"))
    return once.select("segment_id", "r.source_path", "named", "r.paras").filter(F.size("paras") > 0)


def _sums(paras: Column) -> list[Column]:
    """The evidence for each language, over all paragraphs."""
    return [F.aggregate(F.transform(paras, _evidence(i)), F.lit(0.0), lambda acc, x: acc + x).alias(x) for i, x in enumerate(LANGUAGES)]


def _evidence(i: int):
    return lambda p: p["evidence"][i]


def _choice() -> tuple[Column, Column]:
    """(the language with most evidence, its share), from a column of evidence for each language."""
    best = F.greatest(*LANGUAGES)
    return F.coalesce(*[F.when((F.col(x) == best) & (best > 0), F.lit(x)) for x in LANGUAGES]), F.round(best / sum(F.col(x) for x in LANGUAGES), 4)


def _mixed(paras: Column) -> Column:
    """Whether sure paragraphs are in several languages."""
    sure = F.filter(paras, lambda p: (p["confidence"] >= SURE) & (p["words"] >= WORDS) & p["lang"].isNotNull())
    return F.size(F.array_distinct(F.transform(sure, lambda p: p["lang"]))) > 1


def segment_languages(segments: DataFrame, filters: LanguageFilters | None = None) -> DataFrame:
    """segment_id, source_path, named, lang, confidence, mixed, paras and the evidence for each language, one row per segment."""
    rows = segment_paragraphs(segments, filters)
    lang, confidence = _choice()
    rows = rows.select("*", _mixed(F.col("paras")).alias("mixed"), *_sums(F.col("paras")))
    return rows.withColumns({"lang": lang, "confidence": confidence})


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "extracted_segments").select("source_path", "segment_id", "text", "likely_language")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments in one language with a missing or wrong label; paragraphs of segments in several."""
    rows = segment_languages(_segments(spark, sf_dir))
    several = F.transform(F.filter("paras", lambda p: p["lang"].isNotNull()), lambda p: F.struct(p["para_no"].alias("para_no"), p["lang"].alias("lang")))
    wrong = F.col("lang").isNotNull() & ~F.col("lang").eqNullSafe(F.col("named"))
    one = F.when(wrong, F.array(F.struct(F.lit(0).alias("para_no"), F.col("lang").alias("lang"))))
    return rows.select("segment_id", F.inline(F.when(F.col("mixed"), several).otherwise(one)))


def p3_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language with its confidence for every source_path."""
    lang, confidence = _choice()
    sums = segment_languages(_segments(spark, sf_dir)).groupBy("source_path").agg(*[F.sum(x).alias(x) for x in LANGUAGES])
    return sums.select("source_path", lang.alias("lang"), confidence.alias("confidence"))


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A language with its confidence for every segment, and whether it is mixed."""
    return segment_languages(_segments(spark, sf_dir)).select("segment_id", "lang", "confidence", "mixed")


QUERIES = {"p3_found": p3_found, "p3_documents": p3_documents, "p3_segments": p3_segments}
