"""Documents from segments: language guesses, bundles, entities, numbers, headlines, clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions.text import drop_blank_lines, sentences

# Words and letters that hint at a language.
TVL_HINTS = (
    "te", "kae", "ko", "ki", "mai", "atu", "faka", "tuvalu", "malo", "fenua", "tala", "tenei", "tena", "konei", "konea", "fakatoka", "fakamau", "fakaaoga",
    "fakailoa", "faiga", "tagata", "manako", "fakafetai", "mote", "galuega", "atufenua", "matagaluega", "ola", "lei", "fakamatalaga",
)
TVL_LETTERS = "āēīōū‵ʻ’"
EN_HINTS = (
    "a", "an", "are", "as", "at", "be", "by", "can", "education", "guidance", "in", "is", "it", "its", "learning", "learners", "of", "on", "or", "our", "should",
    "support", "teacher", "teachers", "the", "and", "for", "with", "from", "that", "this", "these", "those", "their", "they", "to", "will", "would", "shall",
    "we", "working", "together", "your", "you", "house", "government", "report", "committee", "health", "budget", "ministry", "conference", "island",
)
PLACE_HINTS = ("funafuti", "nanumea", "nanumaga", "nui", "nukufetau", "nukulaelae", "niutao", "niulakita", "vaitupu", "tuvalu", "nanumean")
LETTERS = "A-Za-zĀĒĪŌŪāēīōūʻ’'`-"
ENTITY = f"[A-ZĀĒĪŌŪ][{LETTERS}]+(?:[ ][A-ZĀĒĪŌŪ][{LETTERS}]+){{0,5}}"
MONTHS = ("Ianuali", "Fepuali", "Mati", "Apelila", "Mee", "Iuni", "Iulai", "Aokuso", "Setema", "Oketopa", "Novema", "Tesema")
DATE = rf"(?U)\b(?:\d{{1,2}}\s+[A-Z][a-z]{{2,9}}\s+\d{{4}}|\d{{4}}|(?:{'|'.join(MONTHS)})\b)\b"
STOP_ENTITIES = ("Tuvalu", "Page", "The", "A", "An", "Of", "For", "And", "No", "TVL", "EN", "PDF")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"([{LETTERS}]+)"), 1)


def _once(value: Column, of) -> Column:
    """of(value), with the value worked out once however often `of` uses it."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def language_scores(text: Column) -> Column:
    """A struct of the scores tvl and en: hint words, and for tvl its letters."""
    hints = lambda ws, listed: F.size(F.filter(ws, lambda w: w.isin(*listed)))
    letters = F.length(F.regexp_replace(text, f"[^{TVL_LETTERS}]", ""))
    return _once(words(text), lambda ws: F.struct((hints(ws, (*TVL_HINTS, *PLACE_HINTS)) + letters).alias("tvl"), hints(ws, EN_HINTS).alias("en")))


def guess_language(text: Column, path: Column | None = None) -> Column:
    """tvl or en where its score is at least 2 and twice the other's, else mixed; unknown without any hint."""
    extra = F.lit(0), F.lit(0)
    if path is not None:
        low = F.lower(F.coalesce(path, F.lit("")))
        extra = (
            F.when(low.contains("tuvaluan") | low.contains("tuv_") | low.endswith("_tvl.pdf"), 2).otherwise(0),
            F.when(low.endswith("_en.pdf") | low.contains("english"), 2).otherwise(0),
        )

    def told(scores: Column) -> Column:
        tvl, en = scores["tvl"] + extra[0], scores["en"] + extra[1]
        guess = F.when((tvl >= en * 2) & (tvl >= 2), "tvl").when((en >= tvl * 2) & (en >= 2), "en").otherwise("mixed")
        return F.when((tvl == 0) & (en == 0), "unknown").otherwise(guess)

    blank = ~F.coalesce(text, F.lit("")).rlike(r"(?U)[^\s\x{FEFF}]")
    return F.when(blank, "unknown").otherwise(_once(language_scores(F.coalesce(text, F.lit(""))), told))


def hint_share(text: Column) -> Column:
    """The tvl score's share of both scores; 0 without any."""
    share = lambda s: F.coalesce(s["tvl"] / F.nullif(s["tvl"] + s["en"], F.lit(0)), F.lit(0.0))
    return _once(language_scores(F.coalesce(text, F.lit(""))), share)


def entities(text: Column) -> Column:
    """Runs of one to six capitalised words, without stop words and in order of first occurrence."""
    runs = F.regexp_extract_all(text, F.lit(f"({ENTITY})"), 1)
    return F.array_distinct(F.filter(runs, lambda e: ~e.isin(*STOP_ENTITIES) & (F.length(e) >= 3)))


def named(text: Column) -> Column:
    """entities(), then the known places that text has in any case and that aren't among them."""
    low = F.lower(text)
    places = F.array_compact(F.array(*[F.when(low.contains(p), p.title()) for p in sorted(PLACE_HINTS)]))
    return F.array_distinct(F.concat(entities(text), places))


def dates(text: Column) -> Column:
    """Days with their month and year, years and names of months, in order of first occurrence."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(DATE), 0))


def numbers(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b(\d[\d,]*(?:\.\d+)?%?)"), 1))


def headline(text: Column) -> Column:
    """The first line that isn't blank."""
    return F.get(F.split(drop_blank_lines(text), "\n"), F.lit(0))


def summary(text: Column, count: int = 2) -> Column:
    """The first sentences."""
    return F.array_join(F.slice(sentences(drop_blank_lines(text)), 1, count), " ")


def facts(text: Column, limit: int = 5) -> Column:
    """Distinct sentences of 18 or more characters, the first ones; any first ones where there are none."""
    every = sentences(drop_blank_lines(text))
    good = F.array_distinct(F.filter(every, lambda s: F.length(s) >= 18))
    return F.slice(F.when(F.size(good) > 0, good).otherwise(every), 1, limit)


def is_heading(line: Column) -> Column:
    """3 to 18 words of which nearly half the letters are capitals."""
    n = F.size(F.filter(F.split(line, r"\s+"), lambda w: w != ""))
    letters, capitals = F.length(F.regexp_replace(line, r"[^\p{L}]", "")), F.length(F.regexp_replace(line, r"[^\p{Lu}]", ""))
    return n.between(3, 18) & (F.coalesce(capitals / F.nullif(letters, F.lit(0)), F.lit(0.0)) >= 0.45)


def bundles(segments: DataFrame, least: int = 40) -> DataFrame:
    """One row per doc_id: its segments of `least` or more characters in order, joined by blank lines, with the page range."""
    page = F.expr("try_cast(page_or_image as int)")
    kept = segments.filter(F.length(F.trim("text")) >= least)
    once = kept.groupBy("doc_id", "segment_id").agg(F.min("text").alias("text"), F.min(page).alias("page"))
    parts = F.array_sort(F.collect_list(F.struct("segment_id", "text")))
    return once.groupBy("doc_id").agg(
        F.count("*").cast("int").alias("segments"), F.min("page").alias("first_page"), F.max("page").alias("last_page"),
        F.array_join(F.transform(parts, lambda s: s["text"]), "\n\n").alias("text"),
    )


def registry(bundle: DataFrame, segments: DataFrame) -> DataFrame:
    """One row per document: path, segments, pages, characters, language guess."""
    paths = segments.groupBy("doc_id").agg(F.min("source_path").alias("source_path"))
    rows = bundle.join(paths, "doc_id")
    return rows.select("doc_id", "source_path", "segments", "first_page", "last_page", F.length("text").alias("chars"), guess_language(F.col("text"), F.col("source_path")).alias("language"))


def family(path: Column) -> Column:
    """The source family of a path: its second folder, or other."""
    part = F.regexp_extract(F.lower(path), r"^[^/]+/([^/]+)/", 1)
    return F.when(part != "", part).otherwise("other")


def spelling_clusters(names: DataFrame, name: str) -> DataFrame:
    """Names that differ only in accents, marks and case: key, representative, spellings."""
    bare = F.translate(F.lower(name), "āēīōūʻ’'‵", "aeiou")
    sets = names.groupBy(bare.alias("cluster")).agg(F.array_sort(F.collect_set(name)).alias("spellings"))
    return sets.filter(F.size("spellings") >= 2).withColumn("representative", F.array_min("spellings"))


def islands(lines: DataFrame, group: str, order: str, label: Column) -> DataFrame:
    """Runs of lines with one label: group, island, label, first, last, lines."""
    w = Window.partitionBy(group).orderBy(order)
    rows = lines.withColumn("_l", label)
    rows = rows.withColumn("_c", F.when(F.lag("_l").over(w).eqNullSafe(F.col("_l")), 0).otherwise(1))
    rows = rows.withColumn("island", F.sum("_c").over(w))
    return rows.groupBy(group, "island").agg(F.min("_l").alias("label"), F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("lines"))


def lead(text: Column) -> Column:
    """The first sentence of 18 or more characters, else the first."""
    every = sentences(drop_blank_lines(text))
    return F.coalesce(F.get(F.filter(every, lambda s: F.length(s) >= 18), F.lit(0)), F.get(every, F.lit(0)))


def quote(text: Column) -> Column:
    """The first quoted stretch of 8 or more characters."""
    got = F.regexp_extract(text, r"[“\"]([^”\"]{8,})[”\"]", 1)
    return F.when(got != "", got)


def entity_rows(bundle: DataFrame, entity_limit: int = 24, number_limit: int = 12, date_limit: int = 12) -> DataFrame:
    """doc_id, kind, value, place: the first entities, dates and numbers of each document."""
    of = (("entity", named, entity_limit), ("date", dates, date_limit), ("number", numbers, number_limit))
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.slice(found(F.col("text")), 1, limit).alias("v")) for kind, found, limit in of])
    each = bundle.select("doc_id", F.inline(kinds))
    return each.select("doc_id", "kind", F.posexplode("v").alias("place", "value"))


def entries(lines: DataFrame, group: str, order: str, text: str, starts: Column) -> DataFrame:
    """Lines gathered from one starting line to the next: group, entry, lines, text. Lines before the first start are entry 0."""
    w = Window.partitionBy(group).orderBy(order)
    rows = lines.withColumn("entry", F.sum(starts.cast("int")).over(w))
    parts = F.array_sort(F.collect_list(F.struct(order, text)))
    return rows.groupBy(group, "entry").agg(F.count("*").alias("lines"), F.array_join(F.transform(parts, lambda p: p[text]), " ").alias("text"))


def articles_of_pages(lines: DataFrame, group: str, order: str, text: str, least: int = 100) -> DataFrame:
    """Articles of a document's lines: a heading starts one; those with less than `least` characters of text are dropped."""
    got = entries(lines.filter(F.trim(text) != ""), group, order, text, is_heading(F.col(text)))
    return got.filter(F.length("text") >= least)


def _drop_first(t: Column, part: Column) -> Column:
    at = F.position(part, t)
    return F.when(at > 0, F.trim(F.concat(F.substring(t, F.lit(1), at - 1), F.substring(t, at + F.length(part), F.length(t))))).otherwise(t)


def negatives(rows: DataFrame, chosen: str, paired: str) -> DataFrame:
    """rows with rejected and tags: controlled corruptions of an answer.

    The paired text's summary where there is one, else the answer without its
    first entity; in either the first number dropped; a sentence added where
    nothing has changed, and a remark in English where nothing is paired.
    Each step is a column of its own, so that no expression is repeated.
    """
    rows = rows.withColumns(
        {"_pair": F.coalesce(F.col(paired) != "", F.lit(False)), "_e": F.get(entities(F.col(chosen)), F.lit(0)), "_n": F.get(numbers(F.col(chosen)), F.lit(0)), "_s": summary(F.col(paired))}
    )
    rows = rows.withColumn("_b", F.when(F.col("_pair"), F.col("_s")).when(F.col("_e").isNotNull(), _drop_first(F.col(chosen), F.col("_e"))).otherwise(F.col(chosen)))
    rows = rows.withColumn("_c", F.when(F.col("_n").isNotNull(), _drop_first(F.col("_b"), F.col("_n"))).otherwise(F.col("_b")))
    same = F.col("_c") == F.col(chosen)
    rows = rows.withColumn("_d", F.when(same, F.concat(chosen, F.lit(" This extra sentence is not in the source."))).otherwise(F.col("_c")))
    tags = (
        ("wrong_language", F.col("_pair")), ("translationese", F.col("_pair")), ("entity_drop", ~F.col("_pair") & F.col("_e").isNotNull()),
        ("dropped_numbers_dates", F.col("_n").isNotNull()), ("unsupported_hallucination", same), ("english_leakage", ~F.col("_pair")),
    )
    rows = rows.withColumn("tags", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tags])))
    rejected = F.when(F.col("_pair"), F.col("_d")).otherwise(F.concat("_d", F.lit(" Please note the original report.")))
    return rows.withColumn("rejected", rejected).drop("_pair", "_e", "_n", "_s", "_b", "_c", "_d")
