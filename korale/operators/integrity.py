"""Checks of a split corpus: overlaps of documents, books, days and texts, leaks of word runs, sizes and kinds.

Every check is one row (check, level, found), so a report is a DataFrame; a check
fails where found is not 0. Values are compared by grouped sets of splits, so one
shuffle per key serves all pairs of splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korale.functions.text import tokens
from korale.operators import splitting

REQUIRED = ("bible_verse", "article_paragraph", "daily_text")
LEAST_TEST, LEAST_VALIDATION = 300, 100
SPLITS = ("train", "validation", "test")


def _shared(rows: DataFrame, key: Column) -> DataFrame:
    """How many keys stand in each pair of splits, and in more than one: columns train_test, train_validation, validation_test, several."""
    has = {s: F.max((F.col("split") == s).cast("int")) for s in SPLITS}
    each = rows.filter(F.col("split").isin(*SPLITS)).select(key.alias("k"), "split").filter("k is not null and k != ''").groupBy("k").agg(*[c.alias(s) for s, c in has.items()])
    pair = lambda a, b: F.count_if((F.col(a) == 1) & (F.col(b) == 1))
    return each.agg(
        pair("train", "test").alias("train_test"), pair("train", "validation").alias("train_validation"), pair("validation", "test").alias("validation_test"),
        F.count_if(F.col("train") + F.col("validation") + F.col("test") > 1).alias("several"),
    )


def _rows(counts: DataFrame, names: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per counted column: check, level, found."""
    return counts.select(F.inline(F.array(*[F.struct(F.lit(check).alias("check"), F.lit(level).alias("level"), F.col(c).cast("bigint").alias("found")) for c, (check, level) in names.items()])))


def _exact(pairs: DataFrame) -> DataFrame:
    """Held-out texts that stand in train: of tvl and of en on the same side, and of either side on any."""
    sides = splitting.sides(pairs.filter(F.col("split").isin(*SPLITS)), "split").select("side", "split", F.xxhash64("form").alias("h"), F.xxhash64(F.lit(1), "form").alias("g"))
    by_text = sides.groupBy("h", "g").agg(
        F.max(((F.col("split") == "train") & (F.col("side") == "tvl")).cast("int")).alias("t"), F.max(((F.col("split") == "train") & (F.col("side") == "en")).cast("int")).alias("e"),
        F.count_if((F.col("split") != "train") & (F.col("side") == "tvl")).alias("nt"), F.count_if((F.col("split") != "train") & (F.col("side") == "en")).alias("ne"),
    )
    return by_text.agg(
        F.coalesce(F.sum(F.when(F.col("t") == 1, F.col("nt"))), F.lit(0)).alias("exact_tvl"), F.coalesce(F.sum(F.when(F.col("e") == 1, F.col("ne"))), F.lit(0)).alias("exact_en"),
        F.coalesce(F.sum(F.when(F.col("t") + F.col("e") > 0, F.col("nt") + F.col("ne"))), F.lit(0)).alias("exact_any"),
    )


def _leaks(pairs: DataFrame, n: int) -> DataFrame:
    """Training rows other than verses that share n words in a row with a held-out verse, on either side: leaks, and rows looked at."""
    verse = F.coalesce(F.col("content_type") == "bible_verse", F.lit(False))
    runs = splitting.runs(n)
    side = lambda rows, *keep: splitting.sides(rows, *keep).select(*keep, tokens(F.col("form")).alias("words"))
    index = side(pairs.filter(verse & F.col("split").isin("validation", "test"))).select(F.explode(runs).alias("run")).distinct()
    train = pairs.filter(~verse & (F.col("split") == "train")).withColumn("row", F.struct("id", "source_file", "source_line"))
    met = side(train, "row").select("row", F.explode(runs).alias("run")).join(splitting.looked_up(index), "run", "left_semi")
    return met.agg(F.count_distinct("row").alias("leaks")).join(F.broadcast(train.agg(F.count("*").alias("looked_at"))))


def checks(pairs: DataFrame, n: int = splitting.NGRAM) -> DataFrame:
    """check, level (failure or warning), found, over pairs (id, split, content_type, doc_id, book_num, text_date, source_file, source_line, tvl, en).

    Null and empty keys count for nothing; rows of other splits take no part.
    """
    verse_book = F.when((F.col("content_type") == "bible_verse") & (F.col("book_num") != 0), F.col("book_num").cast("string"))
    out = None
    for name, key in (("doc_id", F.col("doc_id")), ("book", verse_book), ("date", F.col("text_date"))):
        named = {"train_test": (f"{name}_train_test", "failure"), "train_validation": (f"{name}_train_validation", "failure"), "several": (f"{name}_in_several_splits", "failure")}
        if name == "book":
            named["validation_test"] = ("book_validation_test", "failure")
        got = _rows(_shared(pairs, key), named)
        out = got if out is None else out.unionByName(got)
    out = out.unionByName(_rows(_exact(pairs), {c: (c, "failure") for c in ("exact_tvl", "exact_en", "exact_any")}))
    leaks = _leaks(pairs, n)
    out = out.unionByName(_rows(leaks, {"leaks": ("ngram_leaks", "failure")}))
    per_10000 = F.when(F.col("looked_at") > 0, F.round(F.col("leaks") * 10000 / F.col("looked_at"))).otherwise(0)
    out = out.unionByName(_rows(leaks.select(per_10000.alias("share")), {"share": ("ngram_leaks_per_10000", "warning")}))
    count = lambda s: F.count_if(F.col("split") == s)
    sizes = pairs.agg(
        F.greatest(F.lit(0), LEAST_TEST - count("test")).alias("small_test"), F.greatest(F.lit(0), LEAST_VALIDATION - count("validation")).alias("small_validation"),
        *[(F.count_if((F.col("split") == s) & (F.col("content_type") == k)) == 0).cast("int").alias(f"missing_{k}_{s}") for k in REQUIRED for s in ("validation", "test")],
    )
    named = {"small_test": ("small_test", "warning"), "small_validation": ("small_validation", "warning")}
    return out.unionByName(_rows(sizes, named | {f"missing_{k}_{s}": (f"missing_{k}_{s}", "warning") for k in REQUIRED for s in ("validation", "test")}))
