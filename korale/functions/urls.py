"""Ids, sections and kinds of article URLs, and packing of sentences into paragraphs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korale.functions.text import word_count


def article_id(url: Column) -> Column:
    """The number behind /news/<section>/, else the last part of five or more digits."""
    direct = F.regexp_extract(url, r"/news/\d+/(\d+)/", 1)
    parts = F.filter(F.split(F.regexp_replace(url, "/+$", ""), "/"), lambda p: p.rlike(r"^\d{5,}$"))
    return F.coalesce(F.when(direct != "", direct), F.get(F.reverse(parts), F.lit(0)))


def section_id(url: Column) -> Column:
    got = F.regexp_extract(url, r"/news/(\d+)/\d+/", 1)
    return F.when(got != "", got)


def swap_resolution(url: Column, target: str = "1600x900") -> Column:
    """The first resolution part of an image URL replaced."""
    return F.regexp_replace(url, r"^(.*?)/\d+x\d+/", f"$1/{target}/")


def relative(url: Column) -> Column:
    return F.regexp_replace(url, r"^[a-z]+://[^/]*", "")


def kind(url: Column, rules: list[tuple[str, str]]) -> Column:
    """The first kind whose pattern is found in the URL, else other."""
    out = F.lit("other")
    for name, pattern in reversed(rules):
        out = F.when(url.rlike(pattern), name).otherwise(out)
    return out


def pack_sentences(sentences: Column, target: int = 100) -> Column:
    """Paragraphs of sentences, closed at `target` words; a last one of less than a third joins the one before."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"), F.lit(0).alias("n"))

    def step(acc, s):
        text = F.when(acc["open"] == "", s).otherwise(F.concat_ws(" ", acc["open"], s))
        n = acc["n"] + word_count(s)
        full = n >= target
        return F.struct(
            F.when(full, F.concat(acc["done"], F.array(text))).otherwise(acc["done"]).alias("done"), F.when(full, "").otherwise(text).alias("open"), F.when(full, 0).otherwise(n).alias("n")
        )

    def finish(acc):
        size = F.size(acc["done"])
        joined = F.concat(F.slice(acc["done"], F.lit(1), F.greatest(size - 1, F.lit(0))), F.array(F.concat_ws(" ", F.element_at(acc["done"], F.when(size > 0, -1).otherwise(None)), acc["open"])))
        return F.when(acc["open"] == "", acc["done"]).when((size > 0) & (acc["n"] < target // 3), joined).otherwise(F.concat(acc["done"], F.array(acc["open"])))

    return F.aggregate(sentences, start, step, finish)


def split_paragraphs(text: Column, least: int = 100) -> Column:
    """text broken into paragraphs at sentence ends, if it is longer than `least` words and has no blank line."""
    parts = F.split(text, r"(?<=[.!?])\s+(?=[A-ZĀĒĪŌŪ\"“])")
    return F.when(text.contains("\n\n") | (word_count(text) <= least) | (F.size(parts) <= 1), text).otherwise(F.array_join(pack_sentences(parts), "\n\n"))
