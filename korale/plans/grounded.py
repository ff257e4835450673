"""Registered queries of grounded tasks and of markup, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from korale.functions import markup
from korale.functions import text as tx
from korale.operators import rules, tasks
from korale.plans.corpus import QUERIES, SQL, query
from korale.session import table

_HEAD = f"""(list_filter(list_transform(string_split_regex(replace(text, chr(65279), ''), '\\r\\n|[\\n\\r]'), l -> {tx.sql_strip("regexp_replace(l, '[ \\t\\x{A0}]+', ' ', 'g')")}), l -> l <> ''))[1]"""
_NUMBERS = "array_to_string(list_transform(n[1:12], x -> '- ' || x), chr(10))"
_FAMILIES = ("headline_generation", "number_extraction")


def _tasks(spark, d, families=_FAMILIES):
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", "title", F.regexp_replace("text", r"[^\x00-\x7f]", "x").alias("text"))
    return tasks.grounded(rows, families)


_FRAME = "CASE origin " + " ".join(f"WHEN '{o}' THEN '" + f.replace("{ask}", "' || ask || '").replace("{title}", "' || title || '").replace("\n", "' || chr(10) || '") + "'" for o, f in tasks.FRAME.items()) + " END"
_TASKS = f"""WITH d AS (SELECT doc_id, coalesce(title, '') AS title, regexp_replace(text, '[^\\x00-\\x7f]', 'x', 'g') AS text FROM documents WHERE text IS NOT NULL), h AS (SELECT *, (SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(m) AS x, generate_subscripts(m, 1) AS i) GROUP BY x)) AS n FROM (SELECT *, regexp_extract_all(text, '\\b(\\d[\\d,]*(?:\\.\\d+)?%?)', 1) AS m FROM d)),
 f AS (SELECT doc_id, title, 'headline_generation' AS family, '{tasks.ASK["headline_generation"]}' AS ask, trim(coalesce({_HEAD}, '')) AS answer FROM d UNION ALL SELECT doc_id, title, 'number_extraction', '{tasks.ASK["number_extraction"]}', coalesce({_NUMBERS}, '') FROM h),
 o AS (SELECT *, unnest({list(tasks.ORIGINS)}) AS origin FROM f WHERE answer <> ''), t AS (SELECT doc_id || '::' || family || '::' || origin AS id, doc_id, family, origin, {_FRAME} AS prompt, answer FROM o) """


@query("m17_grounded_tasks", _TASKS + "SELECT id, family, origin, prompt, md5(answer) AS answer FROM t")
def m17(spark, d):
    return _tasks(spark, d).select("id", "family", "origin", "prompt", F.md5("answer").alias("answer"))


@query("m16_prompts", "SELECT family, origin, count(*) AS n FROM (" + _TASKS + "SELECT * FROM t) GROUP BY ALL")
def m16(spark, d):
    return _tasks(spark, d).groupBy("family", "origin").agg(F.count("*").alias("n"))


@query("m17_all_families")
def m17b(spark, d):
    """Tasks of all families, by family."""
    return _tasks(spark, d, tuple(tasks.ASK)).groupBy("family").agg(F.count("*").alias("tasks"), F.count_distinct("doc_id").alias("documents"))


@query("m18_news_tasks", _TASKS + "SELECT 'news::' || id AS id, prompt FROM t WHERE family = 'headline_generation'")
def m18(spark, d):
    return tasks.renamed(_tasks(spark, d), ("headline_generation",), "news").select("id", "prompt")


@query("m19_mirrors", _TASKS + """, r AS (SELECT id, family, origin, prompt, other, doc_id FROM (SELECT *, unnest(['native', 'english', 'mixed', 'plain']) AS other FROM t WHERE origin = 'english') WHERE other <> 'english')
 SELECT other AS origin, family, count(*) AS n FROM r GROUP BY ALL""")
def m19(spark, d):
    return tasks.mirrors(_tasks(spark, d).filter("origin = 'english'")).groupBy("origin", "family").agg(F.count("*").alias("n"))


@query("m21_evaluation_items", _TASKS + "SELECT id, prompt FROM t WHERE origin = 'native' AND family = 'headline_generation' AND doc_id % 10 = 3")
def m21(spark, d):
    held = table(spark, d, "documents").filter("doc_id % 10 = 3").select("doc_id")
    return tasks.evaluation_items(_tasks(spark, d), held, ("headline_generation",)).select("id", "prompt")


@query("e16_arms", _TASKS + "SELECT arm, arm = 'native_plus_english' AS is_default, count(*) AS n FROM (SELECT unnest(CASE origin WHEN 'native' THEN ['native_only', 'native_plus_english', 'with_mixed', 'all'] WHEN 'english' THEN ['native_plus_english', 'with_mixed', 'all'] WHEN 'mixed' THEN ['with_mixed', 'all'] ELSE ['all'] END) AS arm FROM t) GROUP BY ALL")
def e16(spark, d):
    return tasks.arms(_tasks(spark, d)).groupBy("arm", "is_default").agg(F.count("*").alias("n"))


@query("e15_manifest", "SELECT source_path, count(DISTINCT segment_id) FILTER (length(text) > 200) AS segments, CASE WHEN count(DISTINCT segment_id) FILTER (length(text) > 200) = 0 THEN 'candidate_only' WHEN regexp_matches(lower(source_path), 'medicare|diabetes|measles|health|finance|budget|education|activity|archive|news_sheet|scan|children|story|nanumea|tales') THEN 'ready' WHEN regexp_matches(lower(source_path), 'nature|biorap|dictionary|corpus|language_cards') THEN 'support_only' ELSE 'ready' END AS ingest_status FROM extracted_segments WHERE source_path IS NOT NULL GROUP BY 1")
def e15(spark, d):
    rows = table(spark, d, "extracted_segments").filter("source_path is not null").groupBy("source_path").agg(F.count_distinct(F.when(F.length("text") > 200, F.col("segment_id"))).alias("segments"))
    return tasks.manifest(rows, rules.source_profile(F.col("source_path"))).select("source_path", "segments", "ingest_status")


@query("a11_document_overlap", "SELECT x.split AS a, y.split AS b, count(*) AS documents FROM (SELECT DISTINCT doc_id, split FROM aligned_pairs WHERE doc_id IS NOT NULL AND split IS NOT NULL) x JOIN (SELECT DISTINCT doc_id, split FROM aligned_pairs WHERE doc_id IS NOT NULL AND split IS NOT NULL) y ON x.doc_id = y.doc_id AND x.split < y.split GROUP BY ALL")
def a11(spark, d):
    return tasks.overlap_report(table(spark, d, "aligned_pairs"), "doc_id", "split")


@query("e08_segments", f"SELECT substr(sha256(concat_ws(chr(1), url, '1', t)), 1, 16) AS segment_id, url AS source_path, length(t) AS chars, CASE WHEN length(t) < 200 THEN 'short' ELSE '' END AS flags FROM (SELECT DISTINCT url, {tx.sql_squeeze('body_en')} AS t FROM articles WHERE body_en IS NOT NULL AND url IS NOT NULL) WHERE length(t) >= 20")
def e08(spark, d):
    rows = table(spark, d, "articles").filter("body_en is not null and url is not null").select(F.col("url").alias("source_path"), F.lit(1).alias("page"), tx.squeeze(F.col("body_en")).alias("text")).distinct()
    got = tasks.segment_rows(rows, "stored_body", {"short": F.length(tx.squeeze(F.col("text"))) < 200}, 20)
    return got.select("segment_id", "source_path", F.length("text").cast("long").alias("chars"), F.array_join("confidence_flags", ",").alias("flags"))


# --- markup

_T = "regexp_replace(coalesce(title_en, ''), '[^A-Za-z0-9 ]', '', 'g')"
_PLAIN = f"trim(regexp_replace({_T}, ' +', ' ', 'g'))"


def _titles(spark, d):
    return table(spark, d, "articles").select("id", "fetched_at", "category", F.regexp_replace(F.coalesce("title_en", F.lit("")), "[^A-Za-z0-9 ]", "").alias("t"))


@query("e17_page_paragraphs", f"SELECT id, fetched_at, unnest(['p1', 'p2']) AS pid, unnest([{_PLAIN} || ' & more', 'b ' || {_PLAIN}]) AS text FROM articles WHERE {_PLAIN} <> ''")
def e17(spark, d):
    rows = _titles(spark, d).filter("trim(t) != ''")
    html = F.concat(F.lit('<div><p data-pid="p1">'), "t", F.lit('<sup>1</sup> &amp; <b>more</b><p data-pid="p2">b <i>'), "t", F.lit("</i><script>no</script></p><p></p><span class='note'>x</span></div>"))
    return rows.select("id", "fetched_at", F.explode(markup.paragraphs(html)).alias("p")).select("id", "fetched_at", F.col("p.id").alias("pid"), "p.text")


@query("e17_verses", f"SELECT id, fetched_at, 'v1' AS verse, {_PLAIN} || ' again' AS text FROM articles WHERE {_PLAIN} <> ''")
def e17b(spark, d):
    rows = _titles(spark, d).filter("trim(t) != ''").withColumn("html", F.concat(F.lit('<span id="v1">'), "t", F.lit('</span> - <span id="v1">again<sup>*</sup></span>'))).withColumnRenamed("id", "article")
    return markup.joined_verses(rows, "html", "article", "fetched_at").select(F.col("article").alias("id"), "fetched_at", F.col("id").alias("verse"), "text")


@query("e18_linked_data", f"SELECT id, fetched_at, nullif({_T}, '') AS headline, nullif({_T}, '') AS author, 'u1' AS image, category AS section FROM articles")
def e18(spark, d):
    c = F.col
    person = F.struct(c("t").alias("name"))
    data = F.to_json(F.struct(c("t").alias("headline"), F.array(person).alias("author"), F.struct(F.lit("u1").alias("url")).alias("image"), F.array_compact(F.array(c("category"))).alias("articleSection")))
    html = F.concat(F.lit('<html><script type="application/ld+json">'), data, F.lit("</script></html>"))
    rows = _titles(spark, d).withColumn("data", markup.script_json(html))
    found = markup.linked_article(c("data"))
    return rows.select("id", "fetched_at", *[found[n].alias(n) for n in ("headline", "author", "image")], F.when(c("category").isNotNull(), found["section"]).alias("section"))


@query("e26_rich_text", f"SELECT id, fetched_at, trim({_T} || chr(10) || 'a' || {_T}, ' ' || chr(10)) AS text FROM articles WHERE trim({_T}) <> ''")
def e26(spark, d):
    rows = _titles(spark, d).filter("trim(t) != ''")
    node = F.concat(F.lit('{"type":"doc","content":[{"type":"paragraph","content":[{"type":"text","text":"'), "t", F.lit('"}]},{"type":"embed","content":[{"text":"no"}]},{"type":"paragraph","content":[{"text":"a"},{"value":"'), "t", F.lit('"}]}]}'))
    return rows.select("id", "fetched_at", markup.rich_text_of(node).alias("text"))


@query("e28_audio_ids", "SELECT doc_id, 'a-' || CASE WHEN doc_id % 100 < 10 THEN '0' ELSE '' END || (doc_id % 100) || ',w-07' AS ids FROM documents")
def e28(spark, d):
    n = (F.col("doc_id") % 100).cast("string")
    ids = markup.audio_ids([F.concat(F.lit("a-"), n), F.lit("w-7"), F.lit("none"), F.concat(F.lit("a-"), n), F.lit(None).cast("string")])
    return table(spark, d, "documents").select("doc_id", F.array_join(ids, ",").alias("ids"))


@query("e30_entries", "SELECT id, fetched_at, unnest(['0_0', '0_1', '1']) AS suffix, unnest([category, 'b', 'c']) AS name, unnest([author, author, 'd']) AS meaning FROM articles WHERE category IS NOT NULL AND author IS NOT NULL AND NOT contains(category, '/') AND category = trim(category) AND author = trim(author)")
def e30(spark, d):
    rows = table(spark, d, "articles").filter("category is not null and author is not null and not contains(category, '/') and category = trim(category) and author = trim(author)")
    entries = markup.zipped_entries(F.array(F.concat("category", F.lit(" / b")), F.lit("c"), F.lit(None).cast("string")), F.array(F.col("author"), F.lit("d"), F.lit("e")))
    return rows.select("id", "fetched_at", F.inline(entries))


@query("e25_crawl", "WITH RECURSIVE l AS (SELECT doc_id AS source, doc_id // 3 AS target FROM documents UNION ALL SELECT doc_id, doc_id // 2 FROM documents), r AS (SELECT max(doc_id) AS page, 0 AS depth FROM documents UNION SELECT target, depth + 1 FROM r JOIN l ON l.source = r.page WHERE depth < 5) SELECT page, min(depth) AS depth FROM r GROUP BY 1")
def e25(spark, d):
    ids = table(spark, d, "documents").select("doc_id")
    links = ids.select(F.col("doc_id").alias("source"), F.expr("doc_id div 3").alias("target")).unionByName(ids.select(F.col("doc_id").alias("source"), F.expr("doc_id div 2").alias("target")))
    return markup.crawl(links, ids.agg(F.max("doc_id").alias("page")))
