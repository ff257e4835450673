"""Text and data from markup: paragraphs of pages, JSON in scripts, rich text. Pages are parsed with the standard library, a batch at a time."""

from __future__ import annotations

import json
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

LEFT_OUT = ("sup", "script", "style", "noscript", "template")
VOID = ("br", "hr", "img", "input", "meta", "link", "wbr", "source", "col", "area", "base", "embed", "track")
PARAGRAPH = T.ArrayType(T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())]))


class _Paragraphs(HTMLParser):
    """The texts of one kind of element, with the value of an attribute; what stands in LEFT_OUT or in elements of the classes to be skipped is dropped."""

    def __init__(self, tag: str, attribute: str, skip: tuple[str, ...]):
        super().__init__(convert_charrefs=True)
        self.tag, self.attribute, self.skip = tag, attribute, set(skip)
        self.out: list[dict] = []
        self.open: list[tuple[str, bool]] = []
        self.depth = 0
        self.text: list[str] | None = None
        self.key: str | None = None

    def _close(self) -> None:
        if self.text is not None:
            text = " ".join("".join(self.text).split())
            if text:
                self.out.append({"id": self.key, "text": text})
            self.text = None

    def handle_starttag(self, tag, attrs):
        given = dict(attrs)
        if tag == self.tag and not self.depth:
            self._close()  # paragraphs needn't be closed
            self.text, self.key = [], given.get(self.attribute)
        if tag in VOID:
            if tag == "br" and self.text is not None:
                self.text.append(" ")
            return
        hidden = tag in LEFT_OUT or bool(self.skip & set((given.get("class") or "").split()))
        self.open.append((tag, hidden))
        self.depth += hidden

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                self.depth -= sum(h for _, h in self.open[i:])
                del self.open[i:]
                break
        if tag == self.tag:
            self._close()

    def handle_data(self, data):
        if self.text is not None and not self.depth:
            self.text.append(data)


def page_paragraphs(html: str | None, tag: str = "p", attribute: str = "data-pid", skip: tuple[str, ...] = ()) -> list[dict]:
    """id and text of the elements of a page; an empty list for none, null or broken pages."""
    parser = _Paragraphs(tag, attribute, skip)
    parser.feed(html or "")
    parser.close()
    parser._close()
    return parser.out


def paragraphs(html: Column, tag: str = "p", attribute: str = "data-pid", skip: tuple[str, ...] = ()) -> Column:
    """Column form of page_paragraphs()."""

    @pandas_udf(PARAGRAPH)
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda t: page_paragraphs(t, tag, attribute, skip))

    return run(html)


def joined_verses(rows: DataFrame, html: str, *keys: str) -> DataFrame:
    """Verses of pages: id and text by the keys; the parts of a verse that stands several times are joined in their order."""
    each = rows.select(*keys, F.posexplode(paragraphs(F.col(html), "span", "id")).alias("n", "p")).filter("p.id is not null")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("n", "p.text"))), lambda x: x["text"])
    return each.groupBy(*keys, F.col("p.id").alias("id")).agg(F.array_join(parts, " ").alias("text"))


def script_json(html: Column, marker: str = "application/ld+json") -> Column:
    """The JSON text of the first script of a page whose tag has the marker; null where there is none or it can't be parsed."""
    got = F.regexp_extract(html, rf'(?is)<script[^>]*{marker.replace("+", "[+]")}[^>]*>\s*(.*?)\s*</script>', 1)
    return F.when(F.try_parse_json(got).isNotNull(), got)


def linked_article(data: Column) -> dict[str, Column]:
    """headline, author, image, published and section of an article's linked data; authors and images may be lists, objects or texts."""
    at = lambda *paths: F.coalesce(*[F.nullif(F.get_json_object(data, p), F.lit("")) for p in paths])
    plain = lambda c: F.when(~c.rlike(r"^\s*[\[{]"), c)
    return {
        "headline": at("$.headline", "$.name"), "author": F.coalesce(at("$.author[0].name", "$.author.name"), plain(at("$.author"))),
        "image": F.coalesce(at("$.image[0].url", "$.image.url", "$.image[0]"), plain(at("$.image"))), "published": at("$.datePublished", "$.dateCreated"), "section": at("$.articleSection[0]", "$.articleSection"),
    }


def rich_text(node, skip: tuple[str, ...] = ("embed", "image", "video")) -> str:
    """The text of a tree of nodes (type, text or value, content): blocks on lines of their own, inline nodes joined, embedded ones left out."""
    if isinstance(node, list):
        return "".join(rich_text(n, skip) for n in node)
    if not isinstance(node, dict):
        return node if isinstance(node, str) else ""
    kind = str(node.get("type") or node.get("nodeType") or "")
    if any(s in kind for s in skip):
        return ""
    text = str(node.get("text") or node.get("value") or "") + rich_text(node.get("content") or [], skip)
    return text + "\n" if kind in ("paragraph", "heading", "list-item", "quote") and text.strip() else text


@pandas_udf(T.StringType())
def rich_text_of(data: pd.Series) -> pd.Series:
    """Column form of rich_text(), of JSON texts; trees of any depth need a walk. Null for null and for what is no JSON."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else rich_text(json.loads(text)).strip()
        except ValueError:
            return None

    return data.map(one)


def audio_ids(columns: list[Column], width: int = 2) -> Column:
    """The different ids of several columns (name-number), sorted, with numbers of `width` digits; what has no number is left out."""
    parts = F.transform(F.array_compact(F.array(*columns)), lambda c: F.struct(F.regexp_extract(c, r"^(.*?)-?(\d+)$", 1).alias("a"), F.regexp_extract(c, r"(\d+)$", 1).alias("n")))
    named = F.transform(F.filter(parts, lambda p: p["n"] != ""), lambda p: F.concat(p["a"], F.lit("-"), F.when(F.length(p["n"]) < width, F.lpad(p["n"], width, "0")).otherwise(p["n"])))
    return F.array_sort(F.array_distinct(named))


def zipped_entries(names: Column, meanings: Column, separator: str = " / ") -> Column:
    """(id suffix, name, meaning) of parallel lists; names with alternatives give one entry each, numbered behind the place."""
    pairs = F.filter(F.transform(F.arrays_zip(names.alias("a"), meanings.alias("b")), lambda p, i: F.struct(i.alias("i"), p["a"].alias("a"), p["b"].alias("b"))), lambda p: p["a"].isNotNull() & p["b"].isNotNull())

    def alternatives(p: Column) -> Column:
        each = F.split(p["a"], separator)
        suffix = lambda k: F.when(F.size(each) > 1, F.concat(p["i"].cast("string"), F.lit("_"), k.cast("string"))).otherwise(p["i"].cast("string"))
        return F.transform(each, lambda n, k: F.struct(suffix(k).alias("suffix"), F.trim(n).alias("name"), F.trim(p["b"]).alias("meaning")))

    return F.flatten(F.transform(pairs, alternatives))


def crawl(links: DataFrame, start: DataFrame, depth: int = 5) -> DataFrame:
    """(page, depth) of all pages that links (source, target) lead to from start (page) in `depth` steps, each at its least depth. Every step is one join with what the last one found, cut off from its lineage."""
    from korale.session import stored

    edges = links.select("source", "target").filter("source is not null and target is not null").distinct()
    seen = stored(start.select("page").filter("page is not null").distinct().withColumn("depth", F.lit(0)), "crawl")
    last = seen
    for k in range(1, depth + 1):
        new = edges.join(last.select(F.col("page").alias("source")), "source", "left_semi").select(F.col("target").alias("page")).distinct().join(seen.select("page"), "page", "left_anti")
        last = stored(new.withColumn("depth", F.lit(k)), "crawl")
        if last.isEmpty():
            break
        seen = seen.unionByName(last)
    return seen
