"""Last rules over gathered pairs: what is dropped, in order, and what is repaired in the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korale.functions.strings import drop_controls, exact_form, plain_width
from korale.functions.text import squeeze

# Stems of negations whose end was cut, marks of glosses, and function words of English.
CUT_NEGATIONS = ("don", "didn", "doesn", "won", "wouldn", "couldn", "shouldn", "isn", "aren", "wasn", "weren", "hasn", "haven", "hadn", "ain", "can", "mustn", "needn")
GLOSSES = (
    "Anp", "Ben", "Cmp", "Cnt", "Cst", "Dxs", "Erg", "Foc", "Fut", "Inc", "Irr", "Itj", "Neg", "Nps", "Nrg", "Num", "Opt", "Prc", "Prf", "Pst", "Rcp", "Rdp", "Sbj", "Spc", "Tag", "Trn", "Voc", "Agr", "Nom",
)
ENGLISH = ("the", "a", "an", "of", "in", "is", "are", "was", "were", "that", "this", "which", "for", "with", "can", "may", "but", "also", "however", "between", "from", "as", "be", "or", "and", "not")


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def _garbled(w: Column) -> Column:
    """Ten or more words, most of one or two characters."""
    return (F.size(w) >= 10) & (F.size(F.filter(w, lambda x: F.length(x) <= 2)) / F.size(w) > 0.6)


def drop_reason(tvl: Column, en: Column) -> Column:
    """The first rule that drops a pair, or null: a cut negation, a stub, glosses, English instead of tvl, garbled text."""
    a, b = words(tvl), words(en)
    cut = F.lower(F.regexp_extract(F.rtrim(en), r"(\w+)$", 1)).isin(*CUT_NEGATIONS)
    glosses = F.size(F.array_intersect(F.array_distinct(a), F.array(*map(F.lit, GLOSSES))))
    english = F.size(F.filter(a, lambda w: F.lower(w).isin(*ENGLISH))) / F.size(a)
    return (
        F.when(cut, "truncated_en").when((F.size(b) <= 2) & (F.size(a) >= 5), "stub_en").when(glosses >= 2, "gloss_in_tvl")
        .when((F.size(a) >= 6) & (english > 0.35), "en_prose_in_tvl").when(_garbled(a) | _garbled(b), "garbled_text")
    )


def repaired(tvl: Column, en: Column) -> tuple[Column, Column]:
    """Both texts without speakers, word classes, page numbers inside, zero marks, full-width and control characters."""
    number = lambda t: F.when(t.rlike(r"\s\d{3}\s"), F.trim(F.regexp_replace(t, r"\s+\d{3}\s+", " "))).otherwise(t)
    a = number(F.regexp_replace(tvl, r"^[A-Z]:\s+", ""))
    a = F.when(a.contains("ø"), squeeze(F.regexp_replace(a, r"\s*ø[ji/*]*\s*", " "))).otherwise(a)
    tags = r"\[(?:N|V|Adj|Adv|Prep|Conj|Pron)\]\s*"
    b = number(F.when(en.rlike(tags), F.trim(F.regexp_replace(en, tags, ""))).otherwise(en))
    return drop_controls(plain_width(a)), drop_controls(plain_width(b))


def firsts(rows: DataFrame, key: Column, order: tuple[str, ...]) -> DataFrame:
    """rows with `again`: whether an earlier row in the order has the same key. The firsts are found with a map-side combine, so a frequent key is no hot task; the order must tell all rows apart."""
    place = F.struct(*order)
    keyed = rows.withColumns({"_k": F.struct(F.xxhash64(key), F.xxhash64(F.lit(1), key)), "_o": place})
    first = keyed.groupBy("_k").agg(F.min("_o").alias("_f"), F.count("*").alias("_c")).filter("_c > 1").drop("_c")
    return keyed.join(first, "_k", "left").withColumn("again", F.coalesce(F.col("_o") != F.col("_f"), F.lit(False))).drop("_k", "_o", "_f")


def postprocess(rows: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """rows (tvl, en, ...) with the reason that drops each, and for the kept ones repaired texts, their lengths and ratio. Repetitions, told in any case, count whether or not the first is dropped; what is blank after the repair is dropped as empty."""
    key = F.concat_ws("\x01", F.lower(F.trim("tvl")), F.lower(F.trim("en")))
    rows = firsts(rows, key, order)
    reason = F.when(F.col("again"), "duplicate").otherwise(drop_reason(F.col("tvl"), F.col("en")))
    a, b = repaired(F.col("tvl"), F.col("en"))
    rows = rows.withColumns({"reason": reason, "tvl": a, "en": b}).drop("again")
    rows = rows.withColumn("reason", F.coalesce("reason", F.when((F.trim("tvl") == "") | (F.trim("en") == ""), "empty")))
    return rows.withColumns({"tvl_chars": F.length("tvl"), "en_chars": F.length("en"), "length_ratio": F.round(F.length("tvl") / F.nullif(F.length("en"), F.lit(0)), 4)})


def with_duplicates(rows: DataFrame, reasons: Column, order: tuple[str, ...]) -> DataFrame:
    """rows with all their reasons; repeated pairs (case kept) have duplicate_pair among them."""
    key = F.concat_ws("\x01", exact_form(F.coalesce("tvl", F.lit(""))), exact_form(F.coalesce("en", F.lit(""))))
    return firsts(rows.withColumn("_r", reasons), key, order).withColumn("reasons", F.when(F.col("again"), F.array_append("_r", F.lit("duplicate_pair"))).otherwise(F.col("_r"))).drop("again", "_r")


def distinct_tasks(tasks: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], least: int = 0, prompt: str = "prompt") -> DataFrame:
    """The first of the tasks with the same keys (texts in any case and spacing), of those whose prompt has `least` characters."""
    key = F.concat_ws("\x01", *[F.lower(squeeze(F.coalesce(F.col(k).cast("string"), F.lit("")))) for k in keys])
    return firsts(tasks.filter(F.length(prompt) >= least), key, order).filter("not again").drop("again")
