"""Corpus-level translation metrics by their published definitions, and set overlaps."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHAR_ORDER, WORD_ORDER, BETA, BLEU_ORDER = 6, 2, 2, 4
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# The steps of the common 13a tokenisation.
_SPLITS = ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "), (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 "))


def bleu_tokens(text: str) -> list[str]:
    text = f" {text.replace('<skipped>', '').replace('-' + chr(10), '').replace(chr(10), ' ')} "
    for pattern, by in _SPLITS:
        text = re.sub(pattern, by, text)
    return text.split()


def _chrf_words(text: str) -> list[str]:
    out: list[str] = []
    for w in text.split():
        if len(w) > 1 and w[-1] in _PUNCTUATION:
            out += [w[:-1], w[-1]]
        elif len(w) > 1 and w[0] in _PUNCTUATION:
            out += [w[0], w[1:]]
        else:
            out.append(w)
    return out


def _grams(items, n: int) -> Counter:
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def sentence_counts(prediction: str, reference: str) -> list[int]:
    """The additive counts of one pair: per chrF order (predicted, reference, matched), per BLEU order (matched, predicted), both lengths, exact."""
    out: list[int] = []
    a, b = ("".join(x.split()) for x in (prediction, reference))
    for n in range(1, CHAR_ORDER + 1):
        p, r = _grams(a, n), _grams(b, n)
        out += [p.total(), r.total(), (p & r).total()]
    a, b = _chrf_words(prediction), _chrf_words(reference)
    for n in range(1, WORD_ORDER + 1):
        p, r = _grams(a, n), _grams(b, n)
        out += [p.total(), r.total(), (p & r).total()]
    a, b = bleu_tokens(prediction), bleu_tokens(reference)
    for n in range(1, BLEU_ORDER + 1):
        p, r = _grams(a, n), _grams(b, n)
        out += [(p & r).total(), p.total()]
    lines = lambda t: "\n".join(" ".join(x.split()) for x in t.splitlines()).strip()
    return [*out, len(a), len(b), int(lines(prediction) == lines(reference))]


WIDTH = 3 * (CHAR_ORDER + WORD_ORDER) + 2 * BLEU_ORDER + 3


def chrf(counts: list[int]) -> float:
    """chrF++ of summed counts, 0 to 100."""
    orders, score = 0, 0.0
    for i in range(CHAR_ORDER + WORD_ORDER):
        p, r, m = counts[3 * i : 3 * i + 3]
        if not p or not r:
            continue
        orders += 1
        precision, recall = m / p, m / r
        if precision + recall:
            score += (1 + BETA**2) * precision * recall / (BETA**2 * precision + recall)
    return 100 * score / orders if orders else 0.0


def bleu(counts: list[int]) -> float:
    """BLEU of summed counts with exponential smoothing over the orders that occur, 0 to 100."""
    at = 3 * (CHAR_ORDER + WORD_ORDER)
    length, reference = counts[-3], counts[-2]
    logs, orders, smooth = 0.0, 0, 1.0
    for n in range(BLEU_ORDER):
        m, p = counts[at + 2 * n : at + 2 * n + 2]
        if not p:
            break
        orders += 1
        if not m:
            smooth *= 2
            logs += math.log(1 / (smooth * p))
        else:
            logs += math.log(m / p)
    if not orders or not counts[at]:
        return 0.0
    brevity = 1.0 if length >= reference else math.exp(1 - reference / length) if length else 0.0
    return 100 * brevity * math.exp(logs / orders)


def translation_metrics(rows: DataFrame, prediction: str, reference: str, *by: str) -> DataFrame:
    """chrf, bleu, exact_match and rows per group. The counts add up in Spark; only the formulas run on the sums."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = [sentence_counts(p or "", r or "") for p, r in zip(b["__p"], b["__r"], strict=True)]
            yield b[list(by)].assign(c=counts)

    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in by]
    counted = rows.select(*by, F.col(prediction).alias("__p"), F.col(reference).alias("__r")).mapInPandas(count, ", ".join([*kinds, "c array<bigint>"]))
    sums = counted.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(F.col("c")[i]).alias(f"c{i}") for i in range(WIDTH)])

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = b[[f"c{i}" for i in range(WIDTH)]].to_numpy().tolist()
            yield b[[*by, "n"]].assign(
                chrf=[round(chrf(c), 4) for c in counts], bleu=[round(bleu(c), 4) for c in counts], exact_match=[round(c[-1] / n, 6) for c, n in zip(counts, b.n, strict=True)]
            )

    return sums.mapInPandas(finish, ", ".join([*kinds, "n bigint, chrf double, bleu double, exact_match double"]))


def token_overlap(a: Column, b: Column) -> Column:
    """Share of the distinct words of a that b has too; 0 for a text without words."""
    words = lambda t: F.array_distinct(F.filter(F.split(F.lower(t), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    return F.coalesce(F.size(F.array_intersect(words(a), words(b))) / F.nullif(F.size(words(a)), F.lit(0)), F.lit(0.0))


def preserved(required: Column, text: Column) -> Column:
    """Share of the required strings that text contains; 1 where none is required."""
    return F.coalesce(F.size(F.filter(required, lambda r: text.contains(r))) / F.nullif(F.size(required), F.lit(0)), F.lit(1.0))


def preservation(rows: DataFrame) -> DataFrame:
    """What of the structure predictions keep, over rows (prediction, expected_json, expected_blocks, placeholders): the shares of parsing JSON, of all blocks kept, of leaked placeholders; null where nothing was expected."""
    text = F.coalesce("prediction", F.lit(""))
    json_ok = F.try_parse_json("prediction").isNotNull()
    blocks, marks = F.size(F.coalesce("expected_blocks", F.array().cast("array<string>"))) > 0, F.size(F.coalesce("placeholders", F.array().cast("array<string>"))) > 0
    kept, leaked = F.forall("expected_blocks", lambda b: text.contains(b)), F.exists("placeholders", lambda b: b.startswith("__PH_") & text.contains(b))
    rate = lambda case, ok: F.round(F.avg(F.when(case, ok.cast("int"))), 6)
    return rows.agg(
        F.count("*").alias("rows"), F.count_if(F.col("expected_json")).alias("json_rows"), rate(F.col("expected_json"), json_ok).alias("json_rate"),
        F.count_if(blocks).alias("code_rows"), rate(blocks, kept).alias("code_rate"), F.count_if(marks).alias("placeholder_rows"), rate(marks, leaked).alias("leak_rate"),
    )
