"""Registered queries of text functions and decision tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from korale.functions import strings as st
from korale.functions import text as tx
from korale.operators import rules
from korale.plans.corpus import QUERIES, SQL, query
from korale.session import table

_STRIP, _SQUEEZE = tx.sql_strip, tx.sql_squeeze


def _articles(spark, d):
    return table(spark, d, "articles")


def _segments(spark, d):
    return table(spark, d, "extracted_segments").filter("text is not null").select("segment_id", "source_path", "text").distinct()


_SEG = "(SELECT DISTINCT segment_id, source_path, text FROM extracted_segments WHERE text IS NOT NULL)"


def _structure_sql(x: str) -> str:
    t = tx.sql_normalize(x)
    # the same steps as the flat normalisation but for its last ones: line by line
    inner = t[t.index("regexp_replace(") :]
    core = inner[len("regexp_replace(trim(regexp_replace(") : inner.rindex(f", '{tx.SQL_WS}+', ' ', 'g'))")]
    core = core.removeprefix("translate(").rsplit(", '", 2)[0] if core.startswith("translate(") else core
    lines = f"array_to_string(list_transform(string_split_regex({core}, '\\r\\n|[\\n\\r]'), l -> " + _STRIP("regexp_replace(l, '[ \\t]+', ' ', 'g')") + "), chr(10))"
    return f"regexp_replace({_STRIP(lines)}, '^[. ]+', '')"


@query("n04_structure", f"SELECT id, source_file, source_line, {_structure_sql('tvl')} AS tvl FROM aligned_pairs WHERE tvl IS NOT NULL")
def n04(spark, d):
    return table(spark, d, "aligned_pairs").filter("tvl is not null").select("id", "source_file", "source_line", st.normalize_structure(F.col("tvl")).alias("tvl"))


@query("n07_exact_form", f"SELECT id, source_file, source_line, md5({_SQUEEZE('nfc_normalize(tvl)')}) AS form FROM aligned_pairs WHERE tvl IS NOT NULL")
def n07(spark, d):
    return table(spark, d, "aligned_pairs").filter("tvl is not null").select("id", "source_file", "source_line", F.md5(st.exact_form(F.col("tvl"))).alias("form"))


@query(
    "n09_bare_lines",
    "SELECT segment_id, md5(array_to_string(list_filter(list_transform(string_split_regex(replace(text, chr(65279), ''), '\\r\\n|[\\n\\r]'), l -> " + _STRIP("regexp_replace(l, '[ \\t\\x{A0}]+', ' ', 'g')") + f"), l -> l <> ''), chr(10))) AS lines FROM {_SEG}",
)
def n09(spark, d):
    return _segments(spark, d).select("segment_id", F.md5(st.bare_lines(F.col("text"))).alias("lines"))


@query("n12_entry_text", f"SELECT id, source_file, source_line, {_SQUEEZE(f'nfc_normalize(translate(en, {chr(39)}{st.FULL_WIDTH}{chr(39)}, {chr(39)}{st.PLAIN}{chr(39)}))')} AS en FROM aligned_pairs WHERE content_type IN ('word', 'expression')")
def n12(spark, d):
    rows = table(spark, d, "aligned_pairs").filter(F.col("content_type").isin("word", "expression"))
    return rows.select("id", "source_file", "source_line", st.entry_text(F.col("en")).alias("en"))


_PROMOTION = {"s0": ("Read more", "Also read"), "s1": ("Subscribe", "Follow us"), "s2": ("Photo:",)}
_TIDY = lambda x: _STRIP(f"regexp_replace(regexp_replace(regexp_replace({x}, '[^\\S\\n]+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


@query(
    "n14_clean_bodies",
    "SELECT id, fetched_at, md5(" + _TIDY("CASE WHEN n = 0 THEN regexp_replace(body_en, '(?m)^(?:Read more|Also read)[^\\n]*', '', 'g') WHEN n = 1 THEN regexp_replace(body_en, '(?m)^(?:Subscribe|Follow us)[^\\n]*', '', 'g') WHEN n = 2 THEN regexp_replace(body_en, '(?m)^Photo:[^\\n]*', '', 'g') ELSE body_en END") + ") AS body FROM (SELECT *, length(source_id) % 4 AS n FROM articles) WHERE body_en IS NOT NULL",
)
def n14(spark, d):
    source = F.concat(F.lit("s"), (F.length("source_id") % 4).cast("string"))
    return _articles(spark, d).filter("body_en is not null").select("id", "fetched_at", F.md5(st.clean_body(F.col("body_en"), source, _PROMOTION)).alias("body"))


@query("n18_marked_paragraphs", "SELECT id, fetched_at, len(p) AS paragraphs, md5(array_to_string(p, '|')) AS text FROM (SELECT id, fetched_at, list_filter(CASE WHEN contains(body_en, '<p') AND len(m) > 0 THEN list_transform(m, x -> " + _STRIP("regexp_replace(x, '<[^>]+>', '', 'g')") + ") ELSE list_transform(string_split(body_en, chr(10) || chr(10)), x -> " + _STRIP("x") + ") END, x -> x <> '') AS p FROM (SELECT *, regexp_extract_all(body_en, '(?is)<p[^>]*>(.*?)</p>', 1) AS m FROM articles WHERE body_en IS NOT NULL))")
def n18(spark, d):
    p = st.marked_paragraphs(F.col("body_en"))
    return _articles(spark, d).filter("body_en is not null").select("id", "fetched_at", F.size(p).cast("long").alias("paragraphs"), F.md5(F.array_join(p, "|")).alias("text"))


@query(
    "n19_long_paragraphs",
    "SELECT segment_id, count(*) AS paragraphs, count(*) FILTER (length(low) < 15 OR regexp_matches(low, '^(page\\s+)?\\d+(\\s+of\\s+\\d+)?$') OR starts_with(low, 'www.') OR starts_with(low, 'http')) AS boilerplate, sum(length(trim(regexp_replace(regexp_replace(p, '^\\d+$', ''), '(?i)page \\d+ of \\d+', '', 'g'))))::BIGINT AS chars"
    f" FROM (SELECT segment_id, p, lower(p) AS low FROM (SELECT segment_id, {_SQUEEZE('q')} AS p FROM (SELECT segment_id, unnest(string_split_regex(replace(text, chr(12), chr(10) || chr(10)), '\\n{{2,}}')) AS q FROM {_SEG})) WHERE length(p) >= 10) GROUP BY 1",
)
def n19(spark, d):
    rows = _segments(spark, d).select("segment_id", F.explode(st.long_paragraphs(F.col("text"), 10)).alias("p"))
    return rows.groupBy("segment_id").agg(F.count("*").alias("paragraphs"), F.count_if(st.is_boilerplate(F.col("p"))).alias("boilerplate"), F.sum(F.length(st.clean_paragraph(F.col("p")))).alias("chars"))


@query("n20_clean_lines", f"SELECT segment_id, md5(string_agg(regexp_replace({_SQUEEZE('l')}, '^[-=~_ ]+|[-=~_ ]+$', '', 'g'), '|' ORDER BY n)) AS lines FROM (SELECT segment_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM {_SEG}) GROUP BY 1")
def n20(spark, d):
    return _segments(spark, d).select("segment_id", F.md5(F.array_join(F.transform(F.split("text", "\n"), st.clean_line), "|")).alias("lines"))


@query("n21_stems", "SELECT DISTINCT source_path, lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_extract(source_path, '([^/]*)$', 1), '^(.+)\\.[^.]*$', '\\1'), '-p\\d+-\\d+$', ''), '[^A-Za-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS stem, CASE WHEN starts_with(source_path, 'data/') THEN substr(source_path, 6) ELSE source_path END AS relative FROM extracted_segments WHERE source_path IS NOT NULL")
def n21(spark, d):
    rows = table(spark, d, "extracted_segments").filter("source_path is not null").select("source_path").distinct()
    return rows.select("source_path", st.stem(F.col("source_path")).alias("stem"), st.relative_path(F.col("source_path"), "data").alias("relative"))


@query("n22_slugs", "SELECT id, fetched_at, regexp_replace(regexp_replace(regexp_replace(lower(trim(title_en)), '[''’]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM articles WHERE title_en IS NOT NULL")
def n22(spark, d):
    return _articles(spark, d).filter("title_en is not null").select("id", "fetched_at", st.slug(F.col("title_en")).alias("slug"))


@query("n22_unique_slugs", "SELECT doc_id, list_transform(range(1, 5), i -> 'a' || CASE WHEN i = 1 THEN '' ELSE '-' || i END)[1 + n] AS last FROM (SELECT doc_id, doc_id % 4 AS n FROM documents)")
def n22b(spark, d):
    """Headings that are all alike get running numbers."""
    same = F.array_repeat(F.lit("A?"), (F.col("doc_id") % 4 + 1).cast("int"))
    return table(spark, d, "documents").select("doc_id", F.element_at(st.unique_slugs(same), -1).alias("last"))


@query("n22_markdown", f"SELECT id, fetched_at, {_SQUEEZE('title_en')} || ' b c d' AS text FROM articles WHERE title_en IS NOT NULL AND NOT regexp_matches(title_en, '[`<>|\\[\\]#*]|^[#>*-]')")
def n22c(spark, d):
    rows = _articles(spark, d).filter(F.col("title_en").isNotNull() & ~F.col("title_en").rlike(r"[`<>|\[\]#*]|^[#>*-]"))
    return rows.select("id", "fetched_at", st.strip_markdown(F.concat(F.lit("# "), "title_en", F.lit("\n```x\ny```\n[b](http://x) ![c](u) <i>`d`</i>"))).alias("text"))


@query("n24_names", f"SELECT id, source_file, source_line, array_to_string(list_filter(list_distinct(list_transform(string_split_regex(en, '[,;/]'), x -> {_STRIP('x')})), x -> x <> '').list_sort(), '|') AS names FROM aligned_pairs WHERE content_type IN ('word', 'expression') AND en IS NOT NULL AND NOT regexp_matches(en, '\\s\\s|[()]|[^ -~]')")
def n24(spark, d):
    rows = table(spark, d, "aligned_pairs").filter(F.col("content_type").isin("word", "expression") & F.col("en").isNotNull() & ~F.col("en").rlike(r"\s\s|[()]|[^ -~]"))
    return rows.select("id", "source_file", "source_line", F.array_join(F.array_sort(st.names(F.concat("en", F.lit(" (a, (b) c)")))), "|").alias("names"))


_AGE = "date_diff('second', published_at, TIMESTAMP '2026-01-01 00:00:00')"


@query(
    "n29_ages",
    f"""SELECT id, fetched_at, CASE WHEN s < 60 THEN 'just now' WHEN s < 3600 THEN s // 60 || 'm ago' WHEN s < 86400 THEN s // 3600 || 'h ago' WHEN s // 86400 < 7 THEN s // 86400 || 'd ago' WHEN s // 86400 // 7 < 5 THEN s // 604800 || 'w ago'
    WHEN s // 86400 // 30 < 12 THEN s // 2592000 || 'mo ago' ELSE s // 31536000 || 'y ago' END AS age, strftime(published_at, '%-d %b %Y') AS day FROM (SELECT *, epoch(TIMESTAMP '2026-01-01 00:00:00')::BIGINT - floor(epoch(published_at))::BIGINT AS s FROM articles WHERE published_at IS NOT NULL)""",
)
def n29(spark, d):
    now = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    rows = _articles(spark, d).filter("published_at is not null")
    return rows.select("id", "fetched_at", st.age(F.col("published_at"), now).alias("age"), st.day_label(F.col("published_at")).alias("day"))


@query("n29_days", "SELECT id, fetched_at, CASE WHEN published_at::DATE <= fetched_at::DATE THEN date_diff('day', published_at::DATE, fetched_at::DATE) + 1 ELSE 0 END::INT AS days FROM articles WHERE published_at IS NOT NULL AND fetched_at IS NOT NULL")
def n29b(spark, d):
    rows = _articles(spark, d).filter("published_at is not null and fetched_at is not null")
    return rows.select("id", "fetched_at", F.size(st.days(F.to_date("published_at"), F.to_date("fetched_at"))).alias("days"))


@query("n30_keys", "SELECT id, fetched_at, regexp_replace(regexp_replace(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/*', ''), '[?#].*$', '') AS path, regexp_replace(lower(trim(author)), '\\s+', '-', 'g') AS author, replace(lower(replace(category, '&', 'and')), ' ', '_') || '.json' AS file, 'x/' || year(published_at) || '/' || month(published_at) || '/' || day(published_at) AS day FROM articles")
def n30(spark, d):
    return _articles(spark, d).select("id", "fetched_at", st.url_path(F.col("url")).alias("path"), st.author_key(F.col("author")).alias("author"), st.json_file(F.col("category")).alias("file"), st.day_url("x/{yyyy}/{m}/{d}", F.col("published_at")).alias("day"))


# --- decision tables


def _case(rules_, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches(p, '{'|'.join(words)}') THEN '{value}'" for value, words in rules_) + f" ELSE '{otherwise}' END"


def _of(table_: dict, otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN family IN ({', '.join(repr(f) for f in families)}) THEN '{v}'" for v, families in table_.items()) + f" ELSE '{otherwise}' END"


@query(
    "p14_source_profiles",
    f"""SELECT source_path, family, {_of(rules.DOMAINS, 'civic')} AS domain, {_of(rules.CONTENT, 'document')} AS content_kind, {_of(rules.CLEANUP, 'medium')} AS cleanup_cost, {_of(rules.VALUE, 'medium')} AS task_value, family IN {rules.HELD_OUT} AS holdout_candidate
    FROM (SELECT source_path, {_case(rules.FAMILIES, 'other')} AS family FROM (SELECT DISTINCT source_path, lower(source_path) AS p FROM extracted_segments WHERE source_path IS NOT NULL))""",
)
def p14(spark, d):
    rows = table(spark, d, "extracted_segments").filter("source_path is not null").select("source_path").distinct()
    return rows.select("source_path", *[c.alias(n) for n, c in rules.source_profile(F.col("source_path")).items()])


_SECTIONS = {"sport": "football", "news": "general"}


@query("p13_categories", "SELECT id, fetched_at, coalesce(CASE lower(category) WHEN 'sport' THEN 'football' WHEN 'news' THEN 'general' END, CASE lower(split_part(url, '/', 4)) WHEN 'sport' THEN 'football' WHEN 'news' THEN 'general' END) AS category FROM articles")
def p13(spark, d):
    return _articles(spark, d).select("id", "fetched_at", rules.mapped(F.col("category"), _SECTIONS, F.get(F.split("url", "/"), F.lit(3))).alias("category"))


_STRONG, _FUNCTION = r"\b(?:kae|mo|faka\w+)\b", r"\b(?:te|ne|ki|o|i)\b"


@query(
    "p10_looks_like",
    f"""SELECT id, source_file, source_line, CASE WHEN n = 0 THEN false WHEN n > 10 THEN s >= 2 OR f >= 3 OR (s >= 1 AND f >= 2) ELSE s >= 1 OR f >= 2 OR (f >= 1 AND n <= 4) END AS tvl FROM (SELECT id, source_file, source_line, len(list_filter(string_split_regex(tvl, '\\s+'), w -> w <> '')) AS n,
    len(regexp_extract_all(tvl, '{_STRONG}')) AS s, len(regexp_extract_all(tvl, '{_FUNCTION}')) AS f FROM (SELECT *, regexp_replace(tvl, '[^ -~]', '', 'g') AS t FROM aligned_pairs) q(q) WHERE tvl IS NOT NULL)""".replace("FROM (SELECT *, regexp_replace(tvl, '[^ -~]', '', 'g') AS t FROM aligned_pairs) q(q)", "FROM (SELECT id, source_file, source_line, regexp_replace(tvl, '[^ -~]', 'z', 'g') AS tvl FROM aligned_pairs)"),
)
def p10(spark, d):
    rows = table(spark, d, "aligned_pairs").filter("tvl is not null").select("id", "source_file", "source_line", F.regexp_replace("tvl", "[^ -~]", "z").alias("t"))
    return rows.select("id", "source_file", "source_line", rules.looks_like(F.col("t"), _STRONG, _FUNCTION).alias("tvl"))


@query("p11_names", "SELECT id, source_file, source_line, len(w) BETWEEN 1 AND 3 AND len(list_filter(w, x -> regexp_matches(x, '^[A-Z][a-z]*$'))) = len(w) AS name, len(list_filter(regexp_extract_all(lower(t), '[a-z'']+'), x -> x IN ('fish', 'tree', 'bird'))) > 0 AS nature FROM (SELECT *, regexp_extract_all(t, '[A-Za-z]+') AS w FROM (SELECT id, source_file, source_line, regexp_replace(en, '[`ʻ‘’ʹ]', ' ', 'g') AS t FROM aligned_pairs WHERE en IS NOT NULL AND content_type IN ('word', 'expression')))")
def p11(spark, d):
    rows = table(spark, d, "aligned_pairs").filter(F.col("en").isNotNull() & F.col("content_type").isin("word", "expression")).select("id", "source_file", "source_line", F.regexp_replace("en", "[`ʻ‘’ʹ]", " ").alias("t"))
    return rows.select("id", "source_file", "source_line", rules.is_name(F.col("t")).alias("name"), rules.has_word(F.col("t"), ("fish", "tree", "bird")).alias("nature"))


@query("p12_url_sections", "SELECT id, fetched_at, CASE WHEN regexp_matches(lower(url), '/sport') THEN 'sport' WHEN regexp_matches(lower(url), '/news|/tala') THEN 'news' WHEN contains(lower(url), '/video') THEN 'video' ELSE 'other' END AS section FROM articles WHERE url IS NOT NULL")
def p12(spark, d):
    return _articles(spark, d).filter("url is not null").select("id", "fetched_at", rules.first_match(F.col("url"), (("sport", ("/sport",)), ("news", ("/news", "/tala")), ("video", ("/video",))), "other").alias("section"))


@query("p19_page_remarks", f"SELECT id, source_file, source_line, regexp_matches(lower(regexp_replace(t, '\\s+', ' ', 'g')), '^(chapter|mataupu e|section|part) [0-9]+$') OR regexp_matches(t, '^©\\s*[0-9]{{4}}') OR starts_with(lower(t), 'photo credit') OR (regexp_matches(t, '^[0-9]+[A-Z]') AND length(t) < 40) OR t IN ('PAGECHAPTER', 'MATAUPUTE ITULAU') AS remark FROM (SELECT *, {_STRIP('en')} AS t FROM aligned_pairs WHERE en IS NOT NULL)")
def p19(spark, d):
    return table(spark, d, "aligned_pairs").filter("en is not null").select("id", "source_file", "source_line", rules.is_page_remark(F.col("en")).alias("remark"))


@query("p26_signals", "SELECT id, created_at, received_at, coalesce(article_id <> '' AND length(article_id) <= 200, false) AND coalesce(feedback_type IN ('share', 'reveal', 'thumbs_up', 'thumbs_down'), false) AS valid, coalesce(trim(session_id) <> '' AND length(trim(session_id)) <= 200, false) AND coalesce(trim(island) IN ('Nui', 'Funafuti', 'Vaitupu'), false) AS island_valid FROM feedback")
def p26(spark, d):
    rows = table(spark, d, "feedback")
    return rows.select("id", "created_at", "received_at", rules.valid_signal(F.col("article_id"), F.col("feedback_type")).alias("valid"), rules.valid_island(F.col("session_id"), F.col("island"), ("Nui", "Funafuti", "Vaitupu")).alias("island_valid"))


@query(
    "p26_article_feedback",
    """SELECT id, created_at, received_at, CASE WHEN NOT (coalesce(article_id <> '' AND length(article_id) <= 200, false) AND coalesce(paragraph_idx IN (0, 1), false) AND coalesce(feedback_type IN ('thumbs_up', 'thumbs_down'), false)) THEN 'invalid' WHEN trim(coalesce(island, '')) <> '' AND session_id IS NULL THEN 'no_paragraph' WHEN length(trim(coalesce(island, ''))) > 1000 THEN 'too_long' END AS error,
    coalesce(regexp_matches(lower(trim(e)), '^[^\\s@]+@[^\\s@]+\\.[^\\s@]{2,}$'), false) AS email FROM (SELECT *, session_id || CASE WHEN id % 2 = 0 THEN '@x.tv' ELSE '@x' END AS e FROM feedback)""",
)
def p26b(spark, d):
    c = F.col
    email = F.concat("session_id", F.when(c("id") % 2 == 0, "@x.tv").otherwise("@x"))
    error = rules.article_feedback_error(c("article_id"), c("paragraph_idx"), c("feedback_type"), ("thumbs_up", "thumbs_down"), c("island"), F.length("session_id"))
    return table(spark, d, "feedback").select("id", "created_at", "received_at", error.alias("error"), rules.valid_email(email).alias("email"))
