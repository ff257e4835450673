"""Registered queries: pairing, samples, masks, lines and entries, terms, pages of results."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions import text as tx
from korale.functions import urls
from korale.operators import chat, documents, metrics, pairing, protect, selection
from korale.plans.analytics import _ART, articles
from korale.plans.corpus import _L, _sql_in, pairs
from korale.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = re.sub(r", (\w) -> ", r", lambda \1: ", sql)
        return f

    return add


_MACRONS = """WITH h AS (SELECT DISTINCT lower(trim(tvl)) AS form FROM aligned_pairs WHERE content_type = 'word' AND tvl NOT LIKE '% %'),
 b AS (SELECT form, translate(form, 'āēīōūĀĒĪŌŪ', 'aeiouAEIOU') AS bare FROM h) SELECT bare, min(form) AS form FROM b WHERE bare <> form AND length(bare) >= 3 AND bare NOT IN (SELECT form FROM h) GROUP BY bare HAVING count(*) = 1"""


def _macrons(spark, d):
    return pairing.macron_map(pairs(spark, d).filter("content_type = 'word'"))


@query("n03_macron_map", _MACRONS)
def n03(spark, d):
    return _macrons(spark, d).select("bare", "form")


@query("n02_macron_correction")
def n02(spark, d):
    return pairing.correct_macrons(pairs(spark, d).filter("tvl is not null").select("id", "tvl").distinct(), "id", "tvl", _macrons(spark, d))


@query(
    "n05_line_structure",
    "SELECT doc_id, length(" + tx.sql_strip("array_to_string(list_transform(string_split_regex(nfc_normalize(text), '\\r\\n|[\\n\\r]'), l -> " + tx.sql_strip("regexp_replace(l, '[ \\t]+', ' ', 'g')") + "), chr(10))") + ")::INT AS chars, length(array_to_string(list_filter(list_transform(string_split_regex(replace(text, chr(65279), ''), '\\r\\n|[\\n\\r]'), l -> "
    + tx.sql_strip("regexp_replace(l, '[ \\t\\x{A0}]+', ' ', 'g')") + "), l -> l <> ''), chr(10)))::INT AS dense_chars FROM documents WHERE text IS NOT NULL",
)
def n05(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.length(tx.normalize_lines(F.col("text"))).alias("chars"), F.length(tx.drop_blank_lines(F.col("text"))).alias("dense_chars"))


@query("n15_split_paragraphs")
def n15(spark, d):
    return table(spark, d, "articles").filter("body_en is not null").select("id", "fetched_at", F.size(F.split(urls.split_paragraphs(F.replace("body_en", F.lit("\n\n"), F.lit(" "))), "\n\n")).alias("paragraphs"))


@query("n25_url_parts", _ART + r"SELECT id, nullif(regexp_extract(url, '/news/(\d+)/\d+/', 1), '') AS section, regexp_replace(url, '^[a-z]+://[^/]*', '') AS path FROM art WHERE url IS NOT NULL")
def n25(spark, d):
    return articles(spark, d).filter("url is not null").select("id", urls.section_id(F.col("url")).alias("section"), urls.relative(F.col("url")).alias("path"))


@query("p12_url_kinds", _ART + r"SELECT CASE WHEN regexp_matches(url, '/live/') THEN 'live' WHEN regexp_matches(url, '\d{5,}') THEN 'article' ELSE 'other' END AS kind, count(*) AS n FROM art WHERE url IS NOT NULL GROUP BY 1")
def p12(spark, d):
    return articles(spark, d).filter("url is not null").groupBy(urls.kind(F.col("url"), [("live", "/live/"), ("article", r"\d{5,}")]).alias("kind")).agg(F.count("*").alias("n"))


_SCANS = "WITH s AS (SELECT segment_id, min(text) AS text FROM extracted_segments WHERE text IS NOT NULL GROUP BY 1), l AS (SELECT segment_id, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS n, unnest(string_split(text, chr(10))) AS line FROM s) "


def lines(spark, d):
    once = table(spark, d, "extracted_segments").filter("text is not null").groupBy("segment_id").agg(F.min("text").alias("text"))
    return once.select("segment_id", F.posexplode(F.split("text", "\n")).alias("p", "line")).select("segment_id", (F.col("p") + 1).cast("long").alias("n"), "line")


@query(
    "p09_line_languages",
    _SCANS
    + f""", t AS (SELECT segment_id, n, list_distinct(regexp_extract_all(lower(line), '[{_L}]+')) AS w FROM l WHERE trim(line) <> ''),
 c AS (SELECT segment_id, n, len(list_filter(w, x -> x IN ({_sql_in(documents.TVL_HINTS)}))) AS a, len(list_filter(w, x -> x IN ({_sql_in(documents.EN_HINTS)}))) AS b FROM t)
 SELECT segment_id, n, coalesce(last_value(CASE WHEN a = 0 AND b = 0 THEN NULL WHEN b > a THEN 'en' ELSE 'tvl' END IGNORE NULLS) OVER (PARTITION BY segment_id ORDER BY n ROWS UNBOUNDED PRECEDING), 'en') AS language FROM c""",
)
def p09(spark, d):
    rows = lines(spark, d).filter("trim(line) <> ''").withColumn("w", F.array_distinct(documents.words(F.col("line"))))
    score = lambda listed: F.size(F.filter("w", lambda x: x.isin(*listed)))
    return pairing.line_languages(rows, "segment_id", "n", score(documents.TVL_HINTS), score(documents.EN_HINTS)).select("segment_id", "n", "language")


@query("n20_headings", _SCANS + "SELECT segment_id, n FROM (SELECT *, len(list_filter(string_split_regex(line, '\\s+'), w -> w <> '')) AS k, length(regexp_replace(line, '[^\\p{L}]', '', 'g')) AS letters, length(regexp_replace(line, '[^\\p{Lu}]', '', 'g')) AS capitals FROM l) WHERE k BETWEEN 3 AND 18 AND coalesce(capitals / nullif(letters, 0), 0) >= 0.45")
def n20(spark, d):
    return lines(spark, d).filter(documents.is_heading(F.col("line"))).select("segment_id", "n")


@query("w13_entries", _SCANS + ", e AS (SELECT *, sum(regexp_matches(line, '^\\s*\\d')::INT) OVER (PARTITION BY segment_id ORDER BY n) AS entry FROM l) SELECT segment_id, entry::BIGINT AS entry, count(*) AS lines, string_agg(line, ' ' ORDER BY n) AS text FROM e GROUP BY segment_id, entry")
def w13(spark, d):
    return documents.entries(lines(spark, d), "segment_id", "n", "line", F.col("line").rlike(r"^\s*\d"))


@query("e06_page_articles")
def e06(spark, d):
    return documents.articles_of_pages(lines(spark, d), "segment_id", "n", "line")


@query("e05_headlines")
def e05(spark, d):
    t = F.col("text")
    return documents.bundles(table(spark, d, "extracted_segments")).select("doc_id", documents.headline(t).alias("headline"), documents.summary(t).alias("summary"), documents.lead(t).alias("lead"), documents.quote(t).alias("quote"), F.size(documents.facts(t)).alias("facts"))


@query("e14_entity_rows")
def e14(spark, d):
    return documents.entity_rows(documents.bundles(table(spark, d, "extracted_segments")))


@query("m20_preferences")
def m20(spark, d):
    rows = table(spark, d, "extracted_segments").filter("text is not null").groupBy("segment_id").agg(F.min("text").alias("text"), F.min("paired_en_text").alias("paired"))
    rows = rows.withColumn("chosen", documents.summary(F.col("text")))
    got = documents.negatives(rows, "chosen", "paired")
    # a filter on the derived column would be pushed below it and repeat its whole expression, so the row is kept or dropped inside an array
    kept = F.filter(F.array(F.struct("rejected", F.array_join("tags", ",").alias("tags"))), lambda r: (r["rejected"] != "") & (r["rejected"] != F.col("chosen")))
    return got.select("segment_id", "chosen", F.inline(kept))


# --- pairing

_VERSE = "SELECT book_num, chapter, verse, min(%s) AS %s FROM aligned_pairs WHERE content_type = 'bible_verse' AND trim(%s) <> '' GROUP BY ALL"


@query("j01_verses", f"SELECT * FROM ({_VERSE % (('tvl',) * 3)}) JOIN ({_VERSE % (('en',) * 3)}) USING (book_num, chapter, verse)")
def j01(spark, d):
    rows = pairs(spark, d).filter("content_type = 'bible_verse'")
    side = lambda s: rows.filter(F.trim(s) != "").groupBy("book_num", "chapter", "verse").agg(F.min(s).alias(s))
    return pairing.by_verse(side("tvl"), side("en"))


@query(
    "j03_place_pairs",
    """WITH e AS (SELECT pair_id, sent_no, max(sentence) FILTER (side = 'tvl') AS tvl, max(sentence) FILTER (side = 'en') AS en FROM pair_sentences WHERE sentence <> '' GROUP BY ALL),
 n AS (SELECT pair_id, count(tvl) a, count(en) b FROM e GROUP BY 1 HAVING count(tvl) > 0 AND count(en) > 0), j AS (SELECT * FROM e JOIN n USING (pair_id)), k AS (SELECT *, (greatest(a, b) - least(a, b)) / least(a, b) AS gap FROM j),
 w AS (SELECT pair_id, string_agg(tvl, ' ' ORDER BY sent_no) AS tvl, string_agg(en, ' ' ORDER BY sent_no) AS en FROM k WHERE gap > 0.4 GROUP BY 1)
 SELECT pair_id, sent_no AS place, round(CASE WHEN a = b THEN least(1.0, 0.5 + 0.5 * (least(length(tvl), length(en)) / greatest(length(tvl), length(en)))) ELSE least(0.7, 0.3 + 0.4 * (least(length(tvl), length(en)) / greatest(length(tvl), length(en)))) END, 3) AS confidence FROM k
 WHERE gap <= 0.4 AND tvl IS NOT NULL AND en IS NOT NULL AND length(tvl) / length(en) BETWEEN 1/3.0 AND 3 UNION ALL SELECT pair_id, 0, 0.4 FROM w WHERE length(tvl) >= 50 AND length(en) >= 50 AND length(tvl) / length(en) BETWEEN 1/3.0 AND 3""",
)
def j03(spark, d):
    got = pairing.by_place(table(spark, d, "pair_sentences"), "pair_id", "side", "sent_no", "sentence")
    return got.select("pair_id", "place", "confidence")


@query(
    "j05_numbered_paragraphs",
    """WITH n AS (SELECT pair_id, side, sent_no + length(sentence) % 2 AS number, (sent_no + length(sentence) % 2) || '. ' || sentence AS t FROM pair_sentences WHERE sentence IS NOT NULL), m AS (SELECT pair_id, number, side, min(t) AS t FROM n GROUP BY ALL)
    SELECT a.pair_id, a.number, a.t AS tvl, b.t AS en FROM m a JOIN m b ON a.pair_id = b.pair_id AND a.number = b.number AND a.side = 'tvl' AND b.side = 'en'""",
)
def j05(spark, d):
    number = (F.col("sent_no") + F.length("sentence") % 2).cast("string")
    rows = table(spark, d, "pair_sentences").filter("sentence is not null").select("pair_id", "side", F.concat(number, F.lit(". "), "sentence").alias("sentence"))
    return pairing.by_number(rows, "pair_id", "side", "sentence")


@query("j06_alternating_lines")
def j06(spark, d):
    rows = lines(spark, d).filter("trim(line) <> ''").withColumn("w", F.array_distinct(documents.words(F.col("line"))))
    score = lambda listed: F.size(F.filter("w", lambda x: x.isin(*listed)))
    told = pairing.line_languages(rows, "segment_id", "n", score(documents.TVL_HINTS), score(documents.EN_HINTS))
    return pairing.alternating(told, "segment_id", "n", "language", "line")


@query("j07_last_translation", "SELECT id, translation_id FROM (SELECT DISTINCT id FROM articles) JOIN (SELECT article_id AS id, id AS translation_id, row_number() OVER (PARTITION BY article_id ORDER BY id DESC) r FROM translations) USING (id) WHERE r = 1")
def j07(spark, d):
    last = table(spark, d, "translations").select(F.col("article_id").alias("id"), F.col("id").alias("translation_id"), F.col("id").alias("o"))
    return pairing.last_match(table(spark, d, "articles").select("id").distinct(), last, "id", "o")


@query(
    "j15_precedence",
    "WITH s AS (SELECT DISTINCT source_path, extraction_method AS m, CASE extraction_method WHEN 'existing_stage_a_seed' THEN 1 WHEN 'pdftotext_layout' THEN 2 WHEN 'existing_ocr_jsonl' THEN 3 ELSE 4 END AS k FROM extracted_segments) SELECT source_path, m FROM s WHERE k = (SELECT min(k) FROM s AS t WHERE t.source_path = s.source_path)",
)
def j15(spark, d):
    rows = table(spark, d, "extracted_segments").select("source_path", F.col("extraction_method").alias("m")).distinct()
    order = ("existing_stage_a_seed", "pdftotext_layout", "existing_ocr_jsonl")
    ranked = [rows.filter(F.col("m") == m) for m in order] + [rows.filter(~F.coalesce(F.col("m").isin(*order), F.lit(False)))]
    return pairing.precedence(ranked, "source_path").select("source_path", "m")


# --- samples


@query("h14_hash_sample", "SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY sha256(doc_id::VARCHAR), doc_id LIMIT 50")
def h14(spark, d):
    return selection.hash_sample(table(spark, d, "documents").filter("lang = 'en'").select("doc_id"), "doc_id", 50)


@query("h15_slice_quotas", "SELECT doc_id, slice FROM (SELECT doc_id, lang AS slice, row_number() OVER (PARTITION BY lang ORDER BY sha256(doc_id::VARCHAR), doc_id) r FROM documents WHERE lang IN ('en', 'tvl', 'sm')) WHERE r <= CASE slice WHEN 'en' THEN 40 WHEN 'tvl' THEN 30 ELSE 10 END")
def h15(spark, d):
    return selection.quotas(table(spark, d, "documents").select("doc_id", "lang"), F.col("lang"), "doc_id", {"en": 40, "tvl": 30, "sm": 10}).select("doc_id", "slice")


@query("h12_ratio_mix")
def h12(spark, d):
    got = selection.mix(table(spark, d, "documents").select("doc_id", "lang"), "lang", "doc_id", {"en": 0.4, "tvl": 0.4, "sm": 0.2})
    return got.groupBy("lang").agg(F.count("*").alias("documents"))


@query("b07_resume", "SELECT DISTINCT id FROM articles WHERE id NOT IN (SELECT article_id FROM translations WHERE article_id IS NOT NULL)")
def b07(spark, d):
    return selection.not_done(table(spark, d, "articles").select("id").distinct(), table(spark, d, "translations").select(F.col("article_id").alias("id")), "id")



# --- masks and checks


@query("m07_mask_round_trip", "SELECT id, fetched_at, md5(body_en) AS text, regexp_matches(body_en, '`[^`]+`|https?://') AS has_spans FROM articles WHERE body_en IS NOT NULL AND NOT contains(body_en, '__PH')")
def m07(spark, d):
    """What was masked and restored is the text again, and texts with addresses or code have spans."""
    rows = table(spark, d, "articles").filter("body_en is not null and not contains(body_en, '__PH')").select("id", "fetched_at", "body_en", protect.mask_spans("body_en").alias("m"))
    marked = F.col("body_en").rlike("`[^`]+`|https?://")
    return rows.select("id", "fetched_at", F.md5(protect.unmask(F.col("m.masked"), F.col("m.spans"))).alias("text"), (marked & (F.size("m.spans") > 0)).alias("has_spans"))


@query("q11_translation_problems")
def q11(spark, d):
    return pairs(spark, d).select(F.explode(protect.translation_problems("en", "tvl")).alias("problem")).groupBy("problem").agg(F.count("*").alias("n"))


_WORDS = r"list_distinct(list_filter(string_split_regex(lower(%s), '[^\p{L}\p{N}]+'), w -> w <> ''))"


@query(
    "q07_prediction_scores",
    f"""WITH r AS (SELECT article_id, arg_max(body_tvl, (attempt_number, id)) AS reference FROM translations WHERE article_id IS NOT NULL GROUP BY 1), t AS (SELECT attempt_number, {_WORDS % 'reference'} AS a, {_WORDS % 'body_tvl'} AS b FROM translations JOIN r USING (article_id) WHERE body_tvl IS NOT NULL AND reference IS NOT NULL)
 SELECT attempt_number, count(*) AS n, round(avg(coalesce(len(list_intersect(a, b)) / nullif(len(a), 0), 0)), 6) AS adequacy, round(avg(coalesce(len(list_intersect(a, b)) / nullif(len(b), 0), 0)), 6) AS support FROM t GROUP BY 1""",
)
def q07(spark, d):
    t = table(spark, d, "translations").filter("article_id is not null")
    last = t.groupBy("article_id").agg(F.max_by("body_tvl", F.struct("attempt_number", "id")).alias("reference"))
    rows = t.join(last, "article_id").filter("body_tvl is not null and reference is not null")
    a, b = F.col("reference"), F.col("body_tvl")
    return rows.groupBy("attempt_number").agg(F.count("*").alias("n"), F.round(F.avg(metrics.token_overlap(a, b)), 6).alias("adequacy"), F.round(F.avg(metrics.token_overlap(b, a)), 6).alias("support"))


# --- reports


@query("a10_count_by", "SELECT alignment_method AS k, count(*) AS n FROM aligned_pairs GROUP BY 1")
def a10(spark, d):
    return pairs(spark, d).groupBy(F.col("alignment_method").alias("k")).agg(F.count("*").alias("n"))


_CONF = "SELECT segment_id, source_path, text, list_max(list_transform(list_filter(confidence_flags, f -> f LIKE 'ocr_confidence:%'), f -> substr(f, 16)::DOUBLE)) AS conf FROM extracted_segments WHERE confidence_flags IS NOT NULL"


def confidence(spark, d):
    values = F.transform(F.filter("confidence_flags", lambda f: f.startswith("ocr_confidence:")), lambda f: F.substring(f, 16, 20).cast("double"))
    return table(spark, d, "extracted_segments").filter("confidence_flags is not null").select("segment_id", "source_path", "text", F.array_max(values).alias("conf"))


@query("a25_page_confidence", f"SELECT source_path, count(*) AS pages, round(avg(conf), 4) AS mean, round(median(conf), 4) AS median FROM ({_CONF}) WHERE conf >= 0 GROUP BY 1")
def a25(spark, d):
    return confidence(spark, d).filter("conf >= 0").groupBy("source_path").agg(F.count("*").alias("pages"), F.round(F.avg("conf"), 4).alias("mean"), F.round(F.median("conf"), 4).alias("median"))


@query("a21_terms", f"SELECT term, count(*) AS n, max(conf) AS best, min(segment_id) AS first FROM (SELECT segment_id, conf, lower(unnest(regexp_extract_all(text, '[A-Za-zāēīōū]+-[A-Za-zāēīōū]+'))) AS term FROM ({_CONF}) WHERE conf >= 60) GROUP BY 1 HAVING count(*) >= 3")
def a21(spark, d):
    terms = F.explode(F.regexp_extract_all("text", F.lit("([A-Za-zāēīōū]+-[A-Za-zāēīōū]+)"), 1))
    rows = confidence(spark, d).filter("conf >= 60").select("segment_id", "conf", terms.alias("t")).withColumn("term", F.lower("t"))
    return rows.groupBy("term").agg(F.count("*").alias("n"), F.max("conf").alias("best"), F.min("segment_id").alias("first")).filter("n >= 3")


@query("a22_dictionary_terms", "SELECT content_type, term, id FROM (SELECT content_type, lower(tvl) AS term, id, row_number() OVER (PARTITION BY content_type, lower(tvl) ORDER BY id, source_line, source_file) r FROM aligned_pairs WHERE content_type IN ('word', 'expression') AND tvl IS NOT NULL) WHERE r = 1")
def a22(spark, d):
    rows = pairs(spark, d).filter("content_type in ('word', 'expression') and tvl is not null")
    return rows.groupBy("content_type", F.lower("tvl").alias("term")).agg(F.min("id").alias("id"))


@query("s21_samples_per_group", "SELECT content_type, id FROM (SELECT DISTINCT content_type, id, dense_rank() OVER (PARTITION BY content_type ORDER BY id) r FROM aligned_pairs WHERE alignment_confidence < 0.8) WHERE r <= 10")
def s21(spark, d):
    rows = pairs(spark, d).filter("alignment_confidence < 0.8").select("content_type", "id").distinct()
    return rows.withColumn("r", F.row_number().over(Window.partitionBy("content_type").orderBy("id"))).filter("r <= 10").drop("r")


@query("w06_progress", "SELECT user_id, event_id, round(100.0 * row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) / count(*) OVER (PARTITION BY user_id), 1) AS percent FROM events")
def w06(spark, d):
    w = Window.partitionBy("user_id")
    return table(spark, d, "events").select("user_id", "event_id", F.round(100.0 * F.row_number().over(w.orderBy("ts", "event_id")) / F.count("*").over(w), 1).alias("percent"))


@query("w08_category_order", _ART + "SELECT category, arg_min(id, (-epoch(published_at), id)) AS newest, count(*) AS n FROM art WHERE category <> '' AND published_at IS NOT NULL GROUP BY 1")
def w08(spark, d):
    rows = articles(spark, d).filter("category <> '' and published_at is not null")
    return rows.groupBy("category").agg(F.min_by("id", F.struct(-F.unix_micros(F.col("published_at").cast("timestamp")), F.col("id"))).alias("newest"), F.count("*").alias("n"))


@query("w16_article", _ART + "SELECT a.id, t.title_tvl FROM art a LEFT JOIN (SELECT article_id, CASE WHEN is_collapsed = 1 THEN NULL ELSE title_tvl END AS title_tvl, row_number() OVER (PARTITION BY article_id ORDER BY attempt_number DESC, id) r FROM translations) t ON t.article_id = a.id AND t.r = 1")
def w16(spark, d):
    w = Window.partitionBy("article_id").orderBy(F.desc("attempt_number"), "id")
    hide = F.when(F.coalesce(F.col("is_collapsed") != 1, F.lit(True)), F.col("title_tvl")).alias("title_tvl")
    last = table(spark, d, "translations").select(F.col("article_id").alias("id"), hide, F.row_number().over(w).alias("r")).filter("r = 1").drop("r")
    return articles(spark, d).select("id").join(last, "id", "left")



@query("u08_distinct_pairs", f"SELECT count(*) AS rows, count(DISTINCT {tx.sql_squeeze('tvl')} || chr(1) || {tx.sql_squeeze('en')}) AS pairs FROM aligned_pairs WHERE tvl IS NOT NULL AND en IS NOT NULL")
def u08(spark, d):
    key = F.concat(tx.squeeze(F.col("tvl")), F.lit("\x01"), tx.squeeze(F.col("en")))
    return pairs(spark, d).filter("tvl is not null and en is not null").agg(F.count("*").alias("rows"), F.count_distinct(key).alias("pairs"))

