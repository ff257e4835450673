"""Decision tables: the first matching rule of a list gives the value. The tables are data, so a user can bring others."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korale.functions.text import strip


def first_match(text: Column, rules: tuple[tuple[str, tuple[str, ...]], ...], otherwise: str | None) -> Column:
    """The value of the first rule one of whose words text has (in lower case)."""
    low, out = F.lower(text), F.lit(otherwise)
    for value, words in reversed(rules):
        hit = low.contains(words[0])
        for w in words[1:]:
            hit = hit | low.contains(w)
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def by_family(family: Column, table: dict[str, tuple[str, ...]], otherwise: str) -> Column:
    """The value whose list has the family."""
    out = F.lit(otherwise)
    for value, families in table.items():
        out = F.when(family.isin(*families), F.lit(value)).otherwise(out)
    return out


# Families of source files by parts of their path, the first that is found.
FAMILIES = (
    ("health", ("medicare", "diabetes", "measles", "health")), ("finance", ("finance", "budget")), ("education", ("education", "activity")), ("scan", ("archive", "news_sheet", "scan")),
    ("children", ("children", "story")), ("oral", ("nanumea", "tales")), ("nature", ("nature", "biorap")), ("lexical", ("dictionary", "corpus", "language_cards")), ("report", ("report", "minutes", "notice")),
)
CONTENT = {"article": ("scan",), "narrative": ("children", "oral"), "report_or_notice": ("health", "finance", "education", "report"), "lexical_reference": ("lexical",)}
CLEANUP = {"high": ("scan", "children"), "medium": ("health", "finance", "education", "report"), "low": ("lexical",)}
VALUE = {"high": ("scan", "health", "finance", "education", "oral"), "medium": ("children", "report", "nature"), "support_only": ("lexical",)}
DOMAINS = {"news": ("scan",), "finance": ("finance",), "health": ("health",), "education": ("education",), "culture": ("children", "oral"), "biodiversity": ("nature",), "lexical": ("lexical",)}
HELD_OUT = ("scan", "health", "finance", "education", "report", "children", "oral")


def source_profile(path: Column) -> dict[str, Column]:
    """What a source file's path tells: family, domain, kind of content, cost of cleaning, value, and whether it may be held out."""
    family = first_match(path, FAMILIES, "other")
    return {
        "family": family, "domain": by_family(family, DOMAINS, "civic"), "content_kind": by_family(family, CONTENT, "document"), "cleanup_cost": by_family(family, CLEANUP, "medium"),
        "task_value": by_family(family, VALUE, "medium"), "holdout_candidate": family.isin(*HELD_OUT),
    }


def mapped(key: Column, table: dict[str, str], *fallbacks: Column) -> Column:
    """The table's value of a key in any case, else of the first fallback that has one."""
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(*[F.element_at(lookup, F.lower(k)) for k in (key, *fallbacks)])


def looks_like(text: Column, strong: str, function: str) -> Column:
    """Whether a text is in the language of these two patterns: of long texts more of its words must match than of short ones."""
    s, f = F.regexp_count(text, F.lit(strong)), F.regexp_count(text, F.lit(function))
    n = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    long = (s >= 2) | (f >= 3) | ((s >= 1) & (f >= 2))
    short = (s >= 1) | (f >= 2) | ((f >= 1) & (n <= 4))
    return F.when(n == 0, False).when(n > 10, long).otherwise(short)


def is_name(text: Column) -> Column:
    """One to three words, each with one capital at its start."""
    words = F.regexp_extract_all(text, F.lit("([A-Za-z`ʻ‘’ʹ]+)"), 1)
    return F.size(words).between(1, 3) & F.forall(words, lambda w: w.rlike("^[`ʻ‘’ʹ]*[A-Z][a-z]*(?:[`ʻ‘’ʹ]+[A-Z]?[a-z]*)*$"))


def has_word(text: Column, words: tuple[str, ...]) -> Column:
    """Whether one of the words stands in text, in any case."""
    return F.arrays_overlap(F.regexp_extract_all(F.lower(text), F.lit("([a-z']+)"), 1), F.array(*map(F.lit, words)))


def is_page_remark(text: Column) -> Column:
    """Chapter headings, copyright lines, credits and index lines of a page's paragraphs."""
    t = strip(text)
    heading = F.lower(F.regexp_replace(t, r"\s+", " ")).rlike("^(chapter|mataupu e|section|part) [0-9]+$")
    index = t.rlike("^[0-9]+[A-Z]") & (F.length(t) < 40)
    return heading | t.rlike(r"^©\s*[0-9]{4}") | F.startswith(F.lower(t), F.lit("photo credit")) | index | t.isin("PAGECHAPTER", "MATAUPUTE ITULAU")


# --- requests

SIGNALS = ("share", "reveal", "thumbs_up", "thumbs_down")


def _id(c: Column) -> Column:
    return F.coalesce((c != "") & (F.length(c) <= 200), F.lit(False))


def valid_signal(article_id: Column, signal: Column) -> Column:
    return _id(article_id) & F.coalesce(signal.isin(*SIGNALS), F.lit(False))


def article_feedback_error(article_id: Column, helpful: Column, mode: Column, modes: tuple[str, ...], correction: Column, paragraph: Column) -> Column:
    """What is wrong with an article's feedback, or null: invalid, no_paragraph or too_long."""
    text = F.trim(F.coalesce(correction, F.lit("")))
    ok = _id(article_id) & F.coalesce(helpful.isin(0, 1), F.lit(False)) & F.coalesce(mode.isin(*modes), F.lit(False))
    return F.when(~ok, "invalid").when((text != "") & ~F.coalesce(paragraph >= 0, F.lit(False)), "no_paragraph").when(F.length(text) > 1000, "too_long")


def valid_island(session: Column, island: Column, islands: tuple[str, ...]) -> Column:
    return _id(F.trim(session)) & F.coalesce(F.trim(island).isin(*islands), F.lit(False))


def valid_email(email: Column) -> Column:
    e = F.lower(F.trim(email))
    return F.coalesce(e.rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]{2,}$") & (F.length(e) <= 320), F.lit(False))
