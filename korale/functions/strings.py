"""More text functions as Column expressions: lines, paragraphs, keys, slugs, labels of dates. All return null for null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from korale.functions.text import BRACKETED, DASHED, EDITION, LETTERS, _LEFT, cut_stub, decode_entities, drop_invisible, nfc, squeeze, strip
from korale.functions.urls import pack_sentences

_LINE_ENDS = r"\r\n|[\n\r]"


def _lines(text: Column) -> Column:
    return F.split(text, _LINE_ENDS)


def normalize_structure(text: Column) -> Column:
    """The corpus normalisation with line breaks kept: references stripped, blanks of each line squeezed; glottal marks stay as they are."""
    t = decode_entities(drop_invisible(nfc(text)))
    t = F.regexp_replace(F.regexp_replace(t, f"{BRACKETED}|{DASHED}", ""), _LEFT, "")
    t = F.regexp_replace(F.regexp_replace(cut_stub(cut_stub(t)), EDITION, ""), r" ?\(\)", "")
    t = F.regexp_replace(t, f"([.!?])([{LETTERS}])", "$1 $2")
    joined = F.array_join(F.transform(_lines(t), lambda s: strip(F.regexp_replace(s, r"[ \t]+", " "))), "\n")
    return F.regexp_replace(strip(joined), r"^[. ]+", "")


def exact_form(text: Column) -> Column:
    """Composed and squeezed, case kept: the form by which repeated pairs are told."""
    return squeeze(nfc(text))


def bare_lines(text: Column) -> Column:
    """Lines with single blanks and bare ends; blank lines are dropped."""
    lines = F.transform(_lines(F.replace(text, F.lit("﻿"), F.lit(""))), lambda s: strip(F.regexp_replace(s, r"[ \t\x{A0}]+", " ")))
    return F.array_join(F.filter(lines, lambda s: s != ""), "\n")


# Full-width marks and their plain forms.
FULL_WIDTH, PLAIN = "？，．（）：；ｗ", "?,.():;w"


def plain_width(text: Column) -> Column:
    return F.translate(text, FULL_WIDTH, PLAIN)


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def entry_text(text: Column) -> Column:
    """A dictionary's text: plain width, composed, single blanks."""
    return squeeze(nfc(plain_width(text)))


def tidy_blanks(text: Column) -> Column:
    """Single blanks within lines, bare line ends, one blank line at most."""
    t = F.regexp_replace(text, r"[^\S\n]+", " ")
    return strip(F.regexp_replace(F.regexp_replace(t, r"(?m)^ +| +$", ""), r"\n{3,}", "\n\n"))


def drop_lines(text: Column, begins: tuple[str, ...]) -> Column:
    """text without the lines that begin with one of the phrases; the line ends stay."""
    keep = lambda s: ~_any([F.startswith(s, F.lit(b)) for b in begins])
    return F.array_join(F.transform(F.split(text, "\n"), lambda s: F.when(keep(s), s).otherwise("")), "\n")


def clean_body(body: Column, source: Column, phrases: dict[str, tuple[str, ...]]) -> Column:
    """A feed's body without its own promotion lines (phrases by source), with tidy blanks."""
    out = body
    for name, begins in phrases.items():
        out = F.when(source == name, drop_lines(body, begins)).otherwise(out)
    return tidy_blanks(out)


def _any(checks: list[Column]) -> Column:
    out = checks[0]
    for c in checks[1:]:
        out = out | c
    return out


def chunks(paragraph: Column, most: int = 100) -> Column:
    """A long paragraph in pieces that end with sentences, of about `most` words; a short tail joins the piece before."""
    parts = F.split(paragraph, r"(?<=[.!?])\s+(?=[A-ZĀĒĪŌŪ\"“])")
    return F.when((F.size(F.split(F.trim(paragraph), r"\s+")) <= most) | (F.size(parts) <= 1), F.array(paragraph)).otherwise(pack_sentences(parts, most))


def marked_paragraphs(body: Column) -> Column:
    """The contents of <p> elements where the body has any, else the stretches between double line ends; never blank ones."""
    inside = F.transform(F.regexp_extract_all(body, F.lit(r"(?i)<p[^>]*>([\s\S]*?)</p>"), 1), lambda p: strip(F.regexp_replace(p, "<[^>]+>", "")))
    plain = F.transform(F.split(body, "\n\n"), strip)
    return F.filter(F.when(body.contains("<p") & (F.size(inside) > 0), inside).otherwise(plain), lambda p: p != "")


def long_paragraphs(text: Column, least: int = 20) -> Column:
    """The stretches between blank lines and form feeds, with single blanks, of `least` characters or more."""
    parts = F.split(F.regexp_replace(text, "\f", "\n\n"), r"\n{2,}")
    return F.filter(F.transform(parts, squeeze), lambda p: F.length(p) >= least)


def clean_paragraph(text: Column) -> Column:
    """A paragraph without page numbers."""
    return F.trim(F.regexp_replace(F.regexp_replace(squeeze(text), r"^\d+$", ""), r"(?i)page \d+ of \d+", ""))


def is_boilerplate(text: Column) -> Column:
    """Paragraphs of under 15 characters, page numbers and addresses."""
    t = F.lower(strip(text))
    return (F.length(t) < 15) | t.rlike(r"^(page\s+)?\d+(\s+of\s+\d+)?$") | F.startswith(t, F.lit("www.")) | F.startswith(t, F.lit("http"))


def clean_line(line: Column) -> Column:
    """A recognised line with single blanks, without rules and dashes at its ends."""
    return F.regexp_replace(squeeze(line), r"^[-=~_ ]+|[-=~_ ]+$", "")


def stem(path: Column) -> Column:
    """A file's name without folder, extension and page range, in lower case with underscores."""
    name = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"-p\d+-\d+$", ""), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))


def relative_path(path: Column, root: str) -> Column:
    """path below root, or as it is; with slashes."""
    p, r = F.replace(path, F.lit("\\"), F.lit("/")), root.rstrip("/") + "/"
    return F.when(F.startswith(p, F.lit(r)), F.substr(p, F.lit(len(r) + 1))).otherwise(p)


def slug(text: Column) -> Column:
    """Letters and digits in lower case, joined by dashes; apostrophes vanish."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "['’]", ""), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def unique_slugs(headings: Column) -> Column:
    """Slugs of the headings of one text; repeated ones get a number, blank ones are sections."""
    bases = F.transform(headings, lambda h: F.coalesce(F.nullif(slug(h), F.lit("")), F.lit("section")))
    earlier = lambda i: F.size(F.filter(F.slice(bases, F.lit(1), i), lambda b: b == F.get(bases, i)))
    return F.transform(bases, lambda b, i: F.when(earlier(i) > 0, F.concat(b, F.lit("-"), (earlier(i) + 1).cast("string"))).otherwise(b))


def strip_markdown(text: Column) -> Column:
    """The words of a markdown text, in one line."""
    t = F.regexp_replace(F.regexp_replace(text, r"```[\s\S]*?```", " "), "`([^`]+)`", "$1")
    t = F.regexp_replace(F.regexp_replace(t, r"!\[([^\]]*)\]\([^)]+\)", " $1 "), r"\[([^\]]+)\]\([^)]+\)", " $1 ")
    t = F.regexp_replace(F.regexp_replace(t, r"</?[^>]+>", " "), r"(?m)^[#>*-]+\s*", "")
    return squeeze(F.replace(t, F.lit("|"), F.lit(" ")))


def without_parens(text: Column) -> Column:
    """text without its parentheses and what stands in them, at any depth; an unclosed one goes on to the end."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("depth"))

    def step(acc: Column, c: Column) -> Column:
        depth = acc["depth"] + F.when(c == "(", 1).when((c == ")") & (acc["depth"] > 0), -1).otherwise(0)
        outside = (acc["depth"] == 0) & (c != "(") & (c != ")")
        return F.struct(F.when(outside, F.concat(acc["out"], c)).otherwise(acc["out"]).alias("out"), depth.alias("depth"))

    whole = F.aggregate(F.split(text, ""), start, step, lambda acc: acc["out"])
    return F.when(text.contains("(") | text.contains(")"), squeeze(whole)).otherwise(squeeze(text))


def names(text: Column) -> Column:
    """The different names of a list, in order: split at commas, semicolons and slashes, without parentheses."""
    return F.array_distinct(F.filter(F.transform(F.split(without_parens(text), r"[,;/]"), strip), lambda n: n != ""))


def age(then: Column, now: Column) -> Column:
    """How long ago, as a label: just now, 5m, 3h, 2d, 4w, 7mo or 2y ago."""
    s = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(then.cast("timestamp"))
    by = lambda n: F.floor(s / n).cast("string")
    days = F.floor(s / 86400)
    return (
        F.when(s.isNull(), None).when(s < 60, "just now").when(s < 3600, F.concat(by(60), F.lit("m ago"))).when(s < 86400, F.concat(by(3600), F.lit("h ago")))
        .when(days < 7, F.concat(by(86400), F.lit("d ago"))).when(F.floor(days / 7) < 5, F.concat(by(7 * 86400), F.lit("w ago")))
        .when(F.floor(days / 30) < 12, F.concat(by(30 * 86400), F.lit("mo ago"))).otherwise(F.concat(by(365 * 86400), F.lit("y ago")))
    )


def day_label(t: Column) -> Column:
    """6 Mar 2026."""
    return F.date_format(t, "d MMM yyyy")


def days(first: Column, last: Column) -> Column:
    """All days from first to last; none where first is later."""
    return F.when(first <= last, F.sequence(first.cast("date"), last.cast("date"))).otherwise(F.array().cast("array<date>"))


def day_url(pattern: str, day: Column) -> Column:
    """A daily page's address; pattern has {yyyy}, {m} and {d}."""
    out = F.lit(pattern)
    for mark, part in (("{yyyy}", F.year(day)), ("{m}", F.month(day)), ("{d}", F.dayofmonth(day))):
        out = F.replace(out, F.lit(mark), part.cast("string"))
    return out


def url_path(url: Column) -> Column:
    """The path of an address, without its first slash."""
    return F.regexp_replace(F.regexp_replace(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/*", ""), r"[?#].*$", "")


def json_file(name: Column) -> Column:
    """A group's name as the name of its JSON file."""
    return F.concat(F.replace(F.lower(F.replace(name, F.lit("&"), F.lit("and"))), F.lit(" "), F.lit("_")), F.lit(".json"))


def author_key(name: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(name)), r"\s+", "-")
