"""Pairing the two languages: by verse, by place, by number, by dictionary forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MACRONS, BARE = "āēīōūĀĒĪŌŪ", "aeiouAEIOU"
EDGES = r".,;:!?()\"—‵“”‘’"


def by_verse(tvl: DataFrame, en: DataFrame) -> DataFrame:
    """Verses that both sides have, with text on both."""
    given = lambda c: F.trim(c) != ""
    keys = ["book_num", "chapter", "verse"]
    return tvl.filter(given("tvl")).join(en.filter(given("en")), keys)


def by_place(rows: DataFrame, group: str, side: str, place: str, text: str, most: float = 3.0) -> DataFrame:
    """(group, place, tvl, en, confidence) of texts paired by their place.

    Groups with equal counts pair all; where the counts differ by at most 40 %
    of the smaller, its places are paired with less confidence; other groups
    give one pair of their whole texts (place 0) where both have 50 characters.
    Pairs whose lengths differ by more than `most` times are left out.
    """
    each = rows.filter(F.col(text) != "").groupBy(group, place).agg(*[F.max(F.when(F.col(side) == s, F.col(text))).alias(s) for s in ("tvl", "en")])
    n = each.groupBy(group).agg(F.count("tvl").alias("_a"), F.count("en").alias("_b")).filter("_a > 0 and _b > 0")
    joined = each.join(n, group)
    low, high = F.least("_a", "_b"), F.greatest("_a", "_b")
    near = F.least(F.length("tvl"), F.length("en")) / F.greatest(F.length("tvl"), F.length("en"))
    ratio = F.length("tvl") / F.length("en")
    fits = ratio.between(1 / most, most)
    paired = joined.filter(((high - low) / low <= 0.4) & F.col("tvl").isNotNull() & F.col("en").isNotNull()).filter(fits)
    confidence = F.when(F.col("_a") == F.col("_b"), F.least(F.lit(1.0), 0.5 + 0.5 * near)).otherwise(F.least(F.lit(0.7), 0.3 + 0.4 * near))
    out = paired.select(group, F.col(place).alias("place"), "tvl", "en", F.round(confidence, 3).alias("confidence"))
    text_of = lambda s: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(s).isNotNull(), F.struct(place, s)))), lambda x: x[s]), " ").alias(s)
    whole = joined.filter((high - low) / low > 0.4).groupBy(group).agg(text_of("tvl"), text_of("en")).filter((F.length("tvl") >= 50) & (F.length("en") >= 50) & fits)
    return out.unionByName(whole.select(group, F.lit(0).alias("place"), "tvl", "en", F.lit(0.4).alias("confidence")))


def by_number(rows: DataFrame, group: str, side: str, text: str) -> DataFrame:
    """(group, number, tvl, en) of paragraphs that carry the same leading number."""
    number = F.regexp_extract(F.col(text), r"^\s*(\d+)[.)]?\s", 1)
    keyed = rows.withColumn("number", F.when(number != "", number.cast("int"))).filter("number is not null")
    one = keyed.groupBy(group, "number", side).agg(F.min(text).alias("_t"))
    t, e = (one.filter(F.col(side) == s).select(group, "number", F.col("_t").alias(s)) for s in ("tvl", "en"))
    return t.join(e, [group, "number"])


def alternating(rows: DataFrame, group: str, order: str, language: str, text: str) -> DataFrame:
    """(group, order, tvl, en) of neighbouring lines in alternate languages, each line used once: of a run of alternations every other step pairs."""
    w = Window.partitionBy(group).orderBy(order)
    rows = rows.withColumn("_same", F.coalesce(F.lag(language).over(w) == F.col(language), F.lit(True)))
    rows = rows.withColumn("_run", F.sum(F.col("_same").cast("int")).over(w))
    rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy(group, "_run").orderBy(order)))
    rows = rows.withColumns({"_next": F.lead(text).over(w), "_next_run": F.lead("_run").over(w)})
    first = rows.filter((F.col("_k") % 2 == 1) & (F.col("_run") == F.col("_next_run")))
    pick = lambda s: F.when(F.col(language) == s, F.col(text)).otherwise(F.col("_next")).alias(s)
    return first.select(group, order, pick("tvl"), pick("en"))


def last_match(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """left joined with the last row of right per key."""
    last = right.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(order)))).filter("_r = 1").drop("_r", order)
    return left.join(last, key)


def precedence(ranked: list[DataFrame], key: str) -> DataFrame:
    """Rows of the first table, then of each next one those whose key no earlier table has."""
    out = ranked[0]
    for df in ranked[1:]:
        out = out.unionByName(df.join(out.select(key).distinct(), key, "left_anti"))
    return out


def macron_map(entries: DataFrame, word: str = "tvl") -> DataFrame:
    """bare, form: words that lack their macrons and the one dictionary form they stand for. Bare forms that are words themselves are left out."""
    head = entries.select(F.lower(F.trim(word)).alias("form")).filter(~F.col("form").contains(" ")).distinct()
    bare = head.select("form", F.translate("form", MACRONS, BARE).alias("bare")).filter((F.col("bare") != F.col("form")) & (F.length("bare") >= 3))
    single = bare.groupBy("bare").agg(F.min("form").alias("form"), F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    return single.join(head.select(F.col("form").alias("bare")), "bare", "left_anti")


def correct_macrons(rows: DataFrame, key: str, text: str, forms: DataFrame) -> DataFrame:
    """key, text with bare words replaced; texts without any keep their spacing."""
    words = rows.select(key, F.posexplode(F.split(F.trim(text), r"\s+")).alias("_p", "_w"))
    core = F.regexp_extract("_w", rf"^[{EDGES}]*(.*?)[{EDGES}]*$", 1)
    words = words.withColumn("_c", core).withColumn("bare", F.lower("_c")).join(forms, "bare", "left")
    upper = (F.upper("_c") == F.col("_c")) & (F.lower("_c") != F.col("_c"))
    first = F.concat(F.upper(F.substring("form", 1, 1)), F.expr("substring(form, 2)"))
    form = F.when(upper & (F.length("_c") > 0), F.upper("form")).when(F.substring("_c", 1, 1) != F.lower(F.substring("_c", 1, 1)), first).otherwise(F.col("form"))
    fixed = F.when(F.col("form").isNotNull(), F.replace(F.col("_w"), F.col("_c"), form)).otherwise(F.col("_w"))
    parts = F.array_sort(F.collect_list(F.struct("_p", fixed.alias("_w"))))
    done = words.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["_w"]), " ").alias("_t"), F.count("form").alias("_n")).filter("_n > 0")
    return rows.select(key, text).join(done, key, "left").select(key, F.coalesce("_t", text).alias(text))


def line_languages(lines: DataFrame, group: str, order: str, tvl: Column, en: Column) -> DataFrame:
    """lines with language: en where its score is higher, tvl where any is, else that of the line before, en at the start."""
    told = F.when((tvl == 0) & (en == 0), None).when(en > tvl, "en").otherwise("tvl")
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("_l", told).withColumn("language", F.coalesce(F.last("_l", ignorenulls=True).over(w), F.lit("en"))).drop("_l")


def by_paragraph_id(rows: DataFrame, group: str, side: str, pid: str, text: str) -> DataFrame:
    """(group, pid, tvl, en, method, confidence) of paragraphs with the same id on both sides.

    A group whose counts differ by more than a fifth, and whose common ids are
    under 0.8 of the smaller count, gives its whole texts as one pair instead
    (pid null, confidence 0.6). Else ids pair: with 0.9 where both sides have
    just the same ids, with 0.8 otherwise; pairs under 20 characters on both
    sides and lengths beyond 0.15 to 7 are left out. Null texts have no part.
    """
    each = rows.filter(F.col(text).isNotNull()).groupBy(group, pid).agg(*[F.max(F.when(F.col(side) == s, F.col(text))).alias(s) for s in ("tvl", "en")])
    n = each.groupBy(group).agg(F.count("tvl").alias("_a"), F.count("en").alias("_b"), F.count_if(F.col("tvl").isNotNull() & F.col("en").isNotNull()).alias("_c")).filter("_a > 0 and _b > 0")
    low, high = F.least("_a", "_b"), F.greatest("_a", "_b")
    apart = ((high - low) / high > 0.2) & (F.col("_c") < low * 0.8)
    joined = each.join(n.withColumn("_apart", apart), group)
    ratio = F.length("tvl") / F.nullif(F.length("en"), F.lit(0))
    fits = ((F.length("tvl") >= 20) | (F.length("en") >= 20)) & F.coalesce(ratio.between(0.15, 7.0), F.lit(True))
    same = F.when((F.col("_a") == F.col("_b")) & (F.col("_c") == F.col("_a")), 0.9).otherwise(0.8)
    ids = joined.filter(~F.col("_apart") & F.col("tvl").isNotNull() & F.col("en").isNotNull() & fits)
    ids = ids.select(group, F.col(pid).alias("pid"), "tvl", "en", F.lit("paragraph_id").alias("method"), same.alias("confidence"))
    text_of = lambda s: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(s).isNotNull(), F.struct(pid, s)))), lambda x: x[s]), " ").alias(s)
    whole = joined.filter("_apart").groupBy(group).agg(text_of("tvl"), text_of("en"))
    kind = rows.schema[pid].dataType
    return ids.unionByName(whole.select(group, F.lit(None).cast(kind).alias("pid"), "tvl", "en", F.lit("document_level").alias("method"), F.lit(0.6).alias("confidence")))


def by_page(documents: DataFrame, key: str, least: int = 30) -> DataFrame:
    """(key, page, place, tvl, en, confidence) of the paragraphs of two texts (tvl, en) whose pages are divided by form feeds: pages by their place, paragraphs within a page as by_place() does. Page numbers, addresses and paragraphs under `least` characters are left out."""
    from korale.functions.strings import clean_paragraph, is_boilerplate, long_paragraphs

    pages = lambda c: F.filter(F.split(c, "\f"), lambda p: F.trim(p) != "")
    both = documents.select(F.col(key).cast("string").alias("_key"), F.posexplode(F.arrays_zip(pages(F.col("tvl")).alias("a"), pages(F.col("en")).alias("b"))).alias("page", "p")).filter("p.a is not null and p.b is not null")
    kept = lambda c: F.filter(long_paragraphs(c, least), lambda p: ~is_boilerplate(p))
    sides = [both.select("_key", "page", F.lit(s).alias("side"), F.posexplode(F.transform(kept(F.col(f"p.{c}")), clean_paragraph)).alias("place", "text")) for s, c in (("tvl", "a"), ("en", "b"))]
    rows = sides[0].unionByName(sides[1]).withColumn("_page", F.concat_ws("\x01", "_key", "page"))
    out = by_place(rows, "_page", "side", "place", "text")
    return out.select(F.substring_index("_page", "\x01", 1).alias(key), F.substring_index("_page", "\x01", -1).cast("int").alias("page"), "place", "tvl", "en", "confidence")


def with_default(rows: DataFrame, lookup: DataFrame, key: str, value: str, default: str) -> DataFrame:
    """rows with a value looked up by a key, and the default where there is none; the lookup has one row per key."""
    return rows.join(lookup.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))
