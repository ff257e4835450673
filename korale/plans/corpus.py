"""Registered queries over pairs, documents and segments, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions import text as tx
from korale.operators import chat, cleaning, collapse, documents, metrics, splitting
from korale.session import keyed, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = re.sub(r", (\w) -> ", r", lambda \1: ", sql)
        return f

    return add


def pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "aligned_pairs")


# --- normalisation

_N = tx.sql_normalize


@query("n01_normalize_text", f"SELECT id, source_file, source_line, {_N('tvl')} AS tvl, {_N('en', False)} AS en FROM aligned_pairs")
def n01(spark, d):
    return pairs(spark, d).select("id", "source_file", "source_line", tx.normalize_text(F.col("tvl")).alias("tvl"), tx.normalize_text(F.col("en"), False).alias("en"))


@query("n06_tokens", f"SELECT doc_id, len(list_filter(string_split({tx.sql_form('text')}, ' '), w -> w <> '')) AS tokens, sha256({tx.sql_form('text')}) AS text_hash FROM documents")
def n06(spark, d):
    return table(spark, d, "documents").select("doc_id", F.size(tx.tokens(tx.comparison_form(F.col("text")))).cast("long").alias("tokens"), tx.text_hash(F.col("text")).alias("text_hash"))


@query("n10_glottal_marks", f"SELECT id, source_line, source_file, translate(tvl, '{tx.GLOTTAL_VARIANTS.replace(chr(39), chr(39) * 2)}', '{tx.GLOTTAL * 5}') AS tvl FROM aligned_pairs WHERE tvl IS NOT NULL")
def n10(spark, d):
    return pairs(spark, d).filter("tvl is not null").select("id", "source_line", "source_file", tx.map_glottals(F.col("tvl")).alias("tvl"))


@query(
    "n13_slash_alternatives",
    """WITH s AS (SELECT id, source_file, source_line, string_split(tvl, ' / ') a, string_split(en, ' / ') b, tvl, en FROM aligned_pairs WHERE content_type IN ('word', 'expression'))
    SELECT id, source_file, source_line, trim(unnest(CASE WHEN len(a) = len(b) AND len(a) > 1 THEN a ELSE [tvl] END)) AS tvl, trim(unnest(CASE WHEN len(a) = len(b) AND len(a) > 1 THEN b ELSE [en] END)) AS en FROM s""",
)
def n13(spark, d):
    rows = pairs(spark, d).filter(F.col("content_type").isin("word", "expression"))
    a, b = F.split("tvl", " / "), F.split("en", " / ")
    both = F.when((F.size(a) == F.size(b)) & (F.size(a) > 1), F.arrays_zip(a.alias("a"), b.alias("b"))).otherwise(F.array(F.struct(F.col("tvl").alias("a"), F.col("en").alias("b"))))
    return rows.select("id", "source_file", "source_line", F.explode(both).alias("p")).select("id", "source_file", "source_line", F.trim("p.a").alias("tvl"), F.trim("p.b").alias("en"))


@query(
    "n17_article_paragraphs",
    r"""SELECT id, fetched_at, len(p) AS paragraphs, list_sum(list_transform(p, x -> length(x))) AS chars FROM (
    SELECT id, fetched_at, list_filter(CASE WHEN regexp_matches(body_en, '(?i)<p[ >]') THEN list_transform(regexp_extract_all(body_en, '(?is)<p[^>]*>(.*?)</p>', 1), x -> """
    + tx.sql_strip("regexp_replace(x, '<[^>]+>', '', 'g')")
    + r""") ELSE list_transform(string_split_regex(body_en, '\n\n+'), x -> """
    + tx.sql_strip("x")
    + """) END, x -> x <> '') AS p FROM articles WHERE body_en IS NOT NULL)""",
)
def n17(spark, d):
    rows = table(spark, d, "articles").filter("body_en is not null").select("id", "fetched_at", tx.paragraphs(F.col("body_en")).alias("p"))
    chars = F.expr("aggregate(transform(p, x -> length(x)), 0, (a, x) -> a + x)")
    return rows.select("id", "fetched_at", F.size("p").cast("long").alias("paragraphs"), F.when(F.size("p") > 0, chars).alias("chars"))


@query("n21_slug_stem", r"SELECT DISTINCT source_path, regexp_replace(regexp_replace(lower(regexp_extract(source_path, '([^/]+)\.[^.]+$', 1)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM extracted_segments")
def n21(spark, d):
    rows = table(spark, d, "extracted_segments").select("source_path").distinct()
    return rows.select("source_path", tx.slug(F.regexp_extract("source_path", r"([^/]+)\.[^.]+$", 1)).alias("slug"))


@query("n22_reading_time", f"SELECT doc_id, greatest(1, floor(len(list_filter(string_split({tx.sql_squeeze('text')}, ' '), w -> w <> '')) / 220.0 + 0.5))::INT AS minutes FROM documents")
def n22(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.reading_minutes(F.col("text")).alias("minutes"))


# --- predicates

def _meta_sql(x: str) -> str:
    low, quoted = f"lower(regexp_replace({x}, '\\s+', ' ', 'g'))", lambda words: ", ".join("'" + w + "'" for w in words)
    labels = "|".join(re.escape(w) for w in cleaning.LABELS)
    heads = "|".join(cleaning.HEADINGS)
    return f"""({x} = '' OR {low} IN ({quoted(cleaning.WHOLE)}) OR {x} IN ({quoted(cleaning.WHOLE_CAPITALS)}) OR regexp_matches({low}, '^({labels})')
      OR regexp_matches({low}, '^({heads})\\s*[0-9]') OR regexp_matches({low}, '^(ch|chapt)\\.? [0-9]') OR regexp_matches({low}, '^\\[(p|pp|page)\\. ?[0-9]')
      OR regexp_matches({low}, '^© ?[0-9]{{4}}|copyright ?\\(?[c©]\\)? ?[0-9]{{4}}|maps?\\(r\\) copyright')
      OR (regexp_matches({low}, '^\\(?({"|".join(cleaning.POINTERS)})(\\W|$)') AND length({x}) < 120) OR (regexp_matches({low}, '{"|".join(cleaning.DISCLAIMERS)}') AND length({x}) < 400))"""


def _ref_sql(x: str) -> str:
    low = f"lower(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"""(contains({x}, '¶') AND length({x}) <= 120 AND regexp_matches({low}, '^((no|no\\.|napa) [0-9]+:|[a-z]\\w*\\.* ?[0-9]|([0-9]+[ ,]+)*¶|[^¶]{{0,60}}\\([0-9]+ ?minu?\\.\\)[^¶]*¶|bible reading:)'))"""


_META, _REF = _meta_sql, _ref_sql


@query("p01_metadata", f"SELECT id, source_file, source_line, {_META('t')} AS metadata, {_REF('t')} AS reference_only FROM (SELECT *, {tx.sql_strip('tvl')} AS t FROM aligned_pairs WHERE tvl IS NOT NULL)")
def p01(spark, d):
    rows = pairs(spark, d).filter("tvl is not null")
    return rows.select("id", "source_file", "source_line", cleaning.is_metadata(F.col("tvl")).alias("metadata"), cleaning.is_reference_only(F.col("tvl")).alias("reference_only"))


def _clean_sql(profile: str) -> str:
    p = cleaning.PROFILES[profile]
    bound = lambda i: f"CASE WHEN content_type = 'bible_verse' THEN {p['verse_ratio'][i]} WHEN content_type IN ('word', 'expression') THEN {p['entry_ratio'][i]} ELSE {p['ratio'][i]} END"
    least = f"CASE WHEN content_type IN ('word', 'expression') THEN {p['entry_min']} ELSE {p['min_chars']} END"
    ref = f"WHEN {_REF('tvl')} OR {_REF('en')} THEN 'ref_only'" if p["refs"] else ""
    return f"""WITH c AS (SELECT id, source_file, source_line, ingested_at, content_type, domain, pub_code, text_date, {_N("coalesce(tvl, '')", p['refs'])} AS tvl, {_N("coalesce(en, '')", p['refs'])} AS en FROM aligned_pairs),
    i AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_file, source_line, ingested_at) AS n, sha256(lower(tvl) || chr(1) || lower(en)) AS k FROM c),
    j AS (SELECT *, row_number() OVER (PARTITION BY k, n = 1 ORDER BY source_file, source_line, ingested_at, id) AS m, count(*) OVER (PARTITION BY en) AS often FROM i),
    r AS (SELECT *, CASE WHEN n > 1 THEN 'duplicate_id' WHEN m > 1 THEN 'duplicate_content' WHEN tvl = '' OR en = '' THEN 'empty_text'
      WHEN {_META('tvl')} OR {_META('en')} THEN 'metadata' WHEN tvl = en THEN 'identical_pair'
      WHEN length(tvl) < {least} OR length(en) < {least} THEN 'too_short' WHEN length(tvl) > {p['max_chars']} OR length(en) > {p['max_chars']} THEN 'too_long'
      WHEN length(tvl) / length(en) < {bound(0)} OR length(tvl) / length(en) > {bound(1)} THEN 'bad_ratio' WHEN pub_code IN ('sjj', 'snnw') THEN 'song_lyrics'
      {ref} WHEN often > {p['boilerplate']} THEN 'boilerplate_en'
      WHEN content_type = 'daily_text' AND text_date LIKE '2025-05%' AND length(tvl) / length(en) < 0.2 THEN 'truncated_daily' END AS reason FROM j)"""


def cleaned(spark, d, profile="balanced", keep=("id", "source_file", "source_line"), derive=None):
    rows = pairs(spark, d).select("id", "source_file", "source_line", "ingested_at", "content_type", "domain", "pub_code", "text_date", "tvl", "en")
    return cleaning.clean(rows, profile, keep, derive)


@query("p03_rejections", _clean_sql("balanced") + "SELECT id, source_file, source_line, reason FROM r WHERE reason IS NOT NULL")
def p03(spark, d):
    return cleaned(spark, d).filter("reason is not null").select("id", "source_file", "source_line", "reason")


@query("p04_strict_profile", _clean_sql("strict") + "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM r GROUP BY 1")
def p04(spark, d):
    return cleaned(spark, d, "strict").groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


@query("p04_lenient_profile", _clean_sql("lenient") + "SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM r GROUP BY 1")
def p04b(spark, d):
    return cleaned(spark, d, "lenient").groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("n"))


_REASONS = """WITH q AS (SELECT id, source_line, source_file, coalesce(nullif(tvl_chars, 0), length(tvl)) n, coalesce(nullif(en_chars, 0), length(en)) m, length_ratio, alignment_confidence, tvl, en FROM aligned_pairs),
 r AS (SELECT *, coalesce(nullif(length_ratio, 0), n / nullif(m, 0)) AS ratio FROM q),
 x AS (SELECT id, source_line, source_file, list_filter([CASE WHEN coalesce(tvl, '') = '' OR coalesce(en, '') = '' THEN 'empty_text' END, CASE WHEN n < 10 OR m < 10 THEN 'too_short' END,
  CASE WHEN n > 4096 OR m > 4096 THEN 'too_long' END, CASE WHEN ratio < 0.4 OR ratio > 2.5 THEN 'bad_length_ratio' END, CASE WHEN alignment_confidence < 0.8 THEN 'low_alignment_confidence' END], y -> y IS NOT NULL) AS reasons FROM r) """


def _reasons(spark, d):
    c = F.col
    return pairs(spark, d).select("id", "source_line", "source_file", cleaning.quality_reasons(c("tvl"), c("en"), c("tvl_chars"), c("en_chars"), c("length_ratio"), c("alignment_confidence")).alias("reasons"))


@query("p05_quality_reasons", _REASONS + "SELECT id, source_line, source_file, array_to_string(reasons, ',') AS reasons FROM x WHERE len(reasons) > 0")
def p05(spark, d):
    return _reasons(spark, d).filter(F.size("reasons") > 0).withColumn("reasons", F.array_join("reasons", ","))


@query("a05_reason_histogram", _REASONS + "SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM x) GROUP BY 1")
def a05(spark, d):
    return _reasons(spark, d).select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def _sql_in(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


_L = documents.LETTERS.replace("'", "''")
_SCORES = f"""WITH w AS (SELECT segment_id, source_path, text, list_transform(regexp_extract_all(lower(text), '[{_L}]+'), x -> x) AS ws FROM (SELECT DISTINCT segment_id, source_path, text FROM extracted_segments WHERE text IS NOT NULL)),
 s AS (SELECT segment_id, source_path, text, len(list_filter(ws, x -> x IN ({_sql_in(documents.TVL_HINTS)}))) + len(list_filter(ws, x -> x IN ({_sql_in(documents.PLACE_HINTS)}))) + length(regexp_replace(text, '[^{documents.TVL_LETTERS}]', '', 'g')) AS tvl,
  len(list_filter(ws, x -> x IN ({_sql_in(documents.EN_HINTS)}))) AS en FROM w) """


@query(
    "p07_guess_language",
    _SCORES
    + """, t AS (SELECT segment_id, tvl + CASE WHEN lower(source_path) LIKE '%tuvaluan%' OR lower(source_path) LIKE '%tuv\\_%' ESCAPE '\\' OR lower(source_path) LIKE '%\\_tvl.pdf' ESCAPE '\\' THEN 2 ELSE 0 END AS tvl,
    en + CASE WHEN lower(source_path) LIKE '%\\_en.pdf' ESCAPE '\\' OR lower(source_path) LIKE '%english%' THEN 2 ELSE 0 END AS en, text FROM s)
    SELECT segment_id, CASE WHEN (tvl = 0 AND en = 0) OR """
    + tx.sql_strip("text")
    + """ = '' THEN 'unknown' WHEN tvl >= en * 2 AND tvl >= 2 THEN 'tvl' WHEN en >= tvl * 2 AND en >= 2 THEN 'en' ELSE 'mixed' END AS language FROM t""",
)
def p07(spark, d):
    rows = table(spark, d, "extracted_segments").filter("text is not null").select("segment_id", "source_path", "text").distinct()
    return rows.select("segment_id", documents.guess_language(F.col("text"), F.col("source_path")).alias("language"))


@query("p08_hint_share", _SCORES + "SELECT segment_id, round(coalesce(tvl / nullif(tvl + en, 0), 0), 6) AS share FROM s")
def p08(spark, d):
    rows = table(spark, d, "extracted_segments").filter("text is not null").select("segment_id", "source_path", "text").distinct()
    return rows.select("segment_id", F.round(documents.hint_share(F.col("text")), 6).alias("share"))


@query("p18_vocabulary", "SELECT vocabulary, count(*) AS n FROM (SELECT coalesce(content_type IN ('word', 'expression', 'translation_phrase'), false) OR (length(tvl) < 30 AND length(en) < 80) AS vocabulary FROM aligned_pairs) GROUP BY 1")
def p18(spark, d):
    return pairs(spark, d).groupBy(cleaning.is_vocabulary(F.col("content_type"), F.col("tvl"), F.col("en")).alias("vocabulary")).agg(F.count("*").alias("n"))


# --- duplicates


@query("u01_first_per_id", "SELECT id, source_file, source_line FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_file, source_line, ingested_at) AS n FROM aligned_pairs) WHERE n = 1")
def u01(spark, d):
    w = Window.partitionBy("id").orderBy(*cleaning.ORDER)
    return pairs(spark, d).select("id", *cleaning.ORDER, F.row_number().over(w).alias("n")).filter("n = 1").select("id", "source_file", "source_line")


@query(
    "u05_new_signatures",
    "WITH h AS (SELECT *, sha256(coalesce(tvl, '') || chr(1) || coalesce(en, '')) AS sig FROM aligned_pairs) SELECT min(id) AS id, sig FROM h WHERE split <> 'train' AND sig NOT IN (SELECT sig FROM h WHERE split = 'train') GROUP BY sig",
)
def u05(spark, d):
    sig = F.sha2(F.concat(F.coalesce("tvl", F.lit("")), F.lit("\x01"), F.coalesce("en", F.lit(""))), 256)
    rows = pairs(spark, d).select("id", "split", sig.alias("sig"))
    return rows.filter("split <> 'train'").join(rows.filter("split = 'train'").select("sig"), "sig", "left_anti").groupBy("sig").agg(F.min("id").alias("id")).select("id", "sig")


@query("u10_duplicate_groups", "SELECT count(*) AS duplicate_groups, coalesce(sum(n - 1), 0)::BIGINT AS duplicate_rows FROM (SELECT md5(coalesce(tvl, '') || chr(1) || coalesce(en, '')) k, count(*) n FROM aligned_pairs GROUP BY 1 HAVING n > 1)")
def u10(spark, d):
    return cleaning.duplicate_groups(pairs(spark, d))


@query("u12_frequent_english", f"SELECT en, count(*) AS n FROM (SELECT {_N('en')} AS en FROM aligned_pairs WHERE en IS NOT NULL) GROUP BY 1 HAVING count(*) > 3")
def u12(spark, d):
    return pairs(spark, d).filter("en is not null").groupBy(tx.normalize_text(F.col("en")).alias("en")).agg(F.count("*").alias("n")).filter("n > 3")


# --- splits and samples

_KEY = "coalesce(CASE WHEN content_type = 'bible_verse' THEN 'bible_book_' || coalesce(book_num::VARCHAR, 'None') END, 'doc_' || nullif(doc_id, ''), 'date_' || nullif(text_date, '')%s, 'row_' || coalesce(id, ''))"


def _split_sql(pub: bool, books) -> str:
    key = _KEY % (", 'pub_' || nullif(pub_code, '')" if pub else "")
    return f"""SELECT id, source_file, source_line, CASE WHEN content_type = 'bible_verse' THEN CASE WHEN coalesce(book_num, 0) IN {splitting.TEST_BOOKS} THEN 'test' WHEN coalesce(book_num, 0) IN {books} THEN 'validation' ELSE 'train' END
     WHEN b < 500 THEN 'test' WHEN b < 1000 THEN 'validation' ELSE 'train' END AS assigned FROM (SELECT *, {tx.sql_bucket(key, 10000)} AS b FROM aligned_pairs)"""


@query("h04_assign_split", _split_sql(False, splitting.VALIDATION_BOOKS))
def h04(spark, d):
    return pairs(spark, d).select("id", "source_file", "source_line", splitting.assign_split().alias("assigned"))


@query("h05_assign_split_by_publication", _split_sql(True, splitting.VALIDATION_BOOKS_A))
def h05(spark, d):
    return pairs(spark, d).select("id", "source_file", "source_line", splitting.assign_split(True, splitting.VALIDATION_BOOKS_A).alias("assigned"))


@query("h02_bucket", f"SELECT doc_id, {tx.sql_bucket('doc_id::VARCHAR', 97)} AS bucket FROM documents")
def h02(spark, d):
    return table(spark, d, "documents").select("doc_id", tx.bucket(F.col("doc_id").cast("string"), 97).alias("bucket"))


@query(
    "h08_stratified_holdout",
    "SELECT doc_id, source FROM (SELECT doc_id, coalesce(source, '') AS source, row_number() OVER (PARTITION BY coalesce(source, '') ORDER BY sha256(doc_id::VARCHAR), doc_id) r, count(*) OVER (PARTITION BY coalesce(source, '')) n FROM documents) WHERE r <= greatest(1, round_even(n * 0.18, 0))",
)
def h08(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    return splitting.holdout(rows, "source", "doc_id").select("doc_id", "source")


@query(
    "h09_share_cap",
    """WITH u AS (SELECT DISTINCT id, content_type FROM aligned_pairs WHERE content_type IS NOT NULL), c AS (SELECT count(*) FILTER (content_type = 'article_paragraph') a, count(*) FILTER (content_type <> 'article_paragraph') b FROM u),
    r AS (SELECT id, content_type, row_number() OVER (PARTITION BY content_type = 'article_paragraph' ORDER BY sha256(id), id) AS place FROM u)
    SELECT id, content_type FROM r, c WHERE content_type <> 'article_paragraph' OR a = 0 OR b = 0 OR place <= floor((0.3 / (1 - 0.3)) * b)""",
)
def h09(spark, d):
    rows = pairs(spark, d).filter("content_type is not null").select("id", "content_type").distinct()
    return splitting.cap_share(rows, F.col("content_type") == "article_paragraph", "id", 0.3).select("id", "content_type")


@query(
    "h11_budget_prefix",
    "WITH s AS (SELECT doc_id, greatest(1, length(text) // 4) AS n, sha256(doc_id::VARCHAR) AS h FROM documents WHERE text IS NOT NULL), r AS (SELECT *, sum(n) OVER (ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS reach FROM s) SELECT doc_id, n AS tokens FROM r WHERE reach <= 100000 OR reach = n",
)
def h11(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").select(F.col("doc_id").cast("string").alias("k"), "doc_id", tx.tokens_by_chars(F.col("text")).cast("long").alias("tokens"))
    return splitting.budget_prefix(rows, "k", F.col("tokens"), 100_000).select("doc_id", "tokens")


@query(
    "b04_group_quota",
    "SELECT doc_id, source FROM (SELECT doc_id, source, coalesce(sum(greatest(1, length(text) // 4)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents WHERE source IS NOT NULL AND text IS NOT NULL) WHERE before < 5000",
)
def b04(spark, d):
    rows = table(spark, d, "documents").filter("source is not null and text is not null").select("doc_id", "source", tx.tokens_by_chars(F.col("text")).alias("n"))
    return splitting.quota_prefix(rows, "source", "doc_id", F.col("n"), 5000).select("doc_id", "source")


@query("b03_budget_allocation", "SELECT mix_name, source_name, floor(1000000 * target_share / sum(target_share) OVER (PARTITION BY mix_name) + 1e-9)::BIGINT AS tokens FROM mix_targets")
def b03(spark, d):
    whole = F.sum("target_share").over(Window.partitionBy("mix_name"))
    return table(spark, d, "mix_targets").select("mix_name", "source_name", F.floor(F.lit(1_000_000) * F.col("target_share") / whole + 1e-9).alias("tokens"))


@query("b02_token_labels", "SELECT source, CASE WHEN n >= 1e6 THEN format('{:.1f}M', n / 1e6) WHEN n >= 1e3 THEN format('{:.1f}K', n / 1e3) ELSE n::VARCHAR END AS tokens FROM (SELECT source, sum(greatest(1, length(text) // 4))::BIGINT AS n FROM documents WHERE text IS NOT NULL GROUP BY source)")
def b02(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").groupBy("source").agg(F.sum(tx.tokens_by_chars(F.col("text"))).alias("n"))
    return rows.select("source", tx.token_label(F.col("n")).alias("tokens"))


# --- decontamination

_FORM = tx.sql_form


@query("g01_ngrams", f"SELECT doc_id, len(list_distinct([array_to_string(t[i:i+3], ' ') FOR i IN range(1, len(t) - 2)])) AS grams FROM (SELECT doc_id, list_filter(string_split({_FORM('text')}, ' '), w -> w <> '') AS t FROM documents WHERE text IS NOT NULL)")
def g01(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", tx.tokens(tx.comparison_form(F.col("text"))).alias("t"))
    grams = rows.select("doc_id", F.explode_outer(tx.ngrams(F.col("t"), 4)).alias("g"))
    return grams.groupBy("doc_id").agg(F.count("g").alias("grams"))


def _held(spark, d):
    rows = pairs(spark, d).select("id", "split", "tvl", "en")
    return rows.filter("split = 'train'"), rows.filter("split in ('validation', 'test')")


@query(
    "g04_contamination",
    f"""WITH s AS (SELECT DISTINCT id, split, side, form FROM (SELECT id, split, 'tvl' AS side, {_FORM("coalesce(tvl, '')")} AS form FROM aligned_pairs UNION ALL SELECT id, split, 'en', {_FORM("coalesce(en, '')")} FROM aligned_pairs)),
    w AS (SELECT *, list_filter(string_split(form, ' '), w -> w <> '') AS t FROM s), h AS (SELECT DISTINCT side, form, t FROM w WHERE split IN ('validation', 'test')), r AS (SELECT DISTINCT id, side, form, t FROM w WHERE split = 'train'),
    e AS (SELECT id, side FROM r WHERE form IN (SELECT form FROM h)), rest AS (SELECT * FROM r WHERE form NOT IN (SELECT form FROM h) AND form <> ''),
    hg AS (SELECT DISTINCT unnest([array_to_string(t[i:i+9], ' ') FOR i IN range(1, len(t) - 8)]) AS g FROM h WHERE len(t) >= 10),
    rg AS (SELECT DISTINCT id, side, unnest([array_to_string(t[i:i+9], ' ') FOR i IN range(1, len(t) - 8)]) AS g FROM rest WHERE len(t) >= 10),
    o AS (SELECT id, side, count(*) FILTER (g IN (SELECT g FROM hg)) AS matching, count(*) AS total FROM rg GROUP BY ALL HAVING matching > 0),
    k AS (SELECT side, ' ' || array_to_string(t[1:floor(0.6 * len(t))::INT + 1], ' ') || ' ' AS lead FROM h WHERE len(t) BETWEEN 4 AND 9),
    c AS (SELECT DISTINCT rest.id, rest.side FROM rest JOIN k ON rest.side = k.side AND contains(' ' || rest.form || ' ', k.lead) WHERE (rest.id, rest.side) NOT IN (SELECT (id, side) FROM o))
    SELECT id, side, 'exact_match' AS level, NULL::BIGINT AS matching, NULL::BIGINT AS total FROM e UNION ALL SELECT id, side, 'ngram_overlap', matching, total FROM o UNION ALL SELECT id, side, 'high_containment', NULL, NULL FROM c""",
)
def g04(spark, d):
    return splitting.contamination(*_held(spark, d))


@query(
    "g05_decontaminate",
    f"""WITH s AS (SELECT DISTINCT id, split, coalesce(content_type = 'bible_verse', false) AS verse, side, form FROM (SELECT id, split, content_type, 'tvl' AS side, {_FORM("coalesce(tvl, '')")} AS form FROM aligned_pairs UNION ALL SELECT id, split, content_type, 'en', {_FORM("coalesce(en, '')")} FROM aligned_pairs)),
    w AS (SELECT *, list_filter(string_split(form, ' '), w -> w <> '') AS t FROM s), a AS (SELECT DISTINCT form FROM w WHERE split IN ('validation', 'test')), h AS (SELECT DISTINCT side, form, t FROM w WHERE split IN ('validation', 'test') AND verse), r AS (SELECT DISTINCT id, verse, side, form, t FROM w WHERE split = 'train'),
    e AS (SELECT id, side FROM r WHERE form IN (SELECT form FROM a)), rest AS (SELECT * FROM r WHERE NOT verse AND form NOT IN (SELECT form FROM a) AND form <> ''),
    hg AS (SELECT DISTINCT unnest([array_to_string(t[i:i+9], ' ') FOR i IN range(1, len(t) - 8)]) AS g FROM h WHERE len(t) >= 10),
    rg AS (SELECT DISTINCT id, side, unnest([array_to_string(t[i:i+9], ' ') FOR i IN range(1, len(t) - 8)]) AS g FROM rest WHERE len(t) >= 10), o AS (SELECT DISTINCT id, side FROM rg WHERE g IN (SELECT g FROM hg)),
    k AS (SELECT side, ' ' || array_to_string(t[1:floor(0.6 * len(t))::INT + 1], ' ') || ' ' AS lead FROM h WHERE len(t) BETWEEN 4 AND 9),
    c AS (SELECT DISTINCT rest.id, rest.side FROM rest JOIN k ON rest.side = k.side AND contains(' ' || rest.form || ' ', k.lead) WHERE (rest.id, rest.side) NOT IN (SELECT (id, side) FROM o)),
    l AS (SELECT id, 'exact_match' AS level FROM e UNION ALL SELECT id, 'ngram_overlap' FROM o UNION ALL SELECT id, 'high_containment' FROM c), b AS (SELECT id, array_to_string(list_sort(list_distinct(list(level))), ',') AS levels FROM l GROUP BY 1)
    SELECT t.id, CASE WHEN b.levels IS NULL THEN 'train' ELSE 'quarantined' END AS split, coalesce(b.levels, '') AS levels FROM (SELECT DISTINCT id FROM aligned_pairs WHERE split = 'train') t LEFT JOIN b ON t.id = b.id""",
)
def g05(spark, d):
    rows = pairs(spark, d).select("id", "content_type", "split", "tvl", "en")
    train, held = rows.filter("split = 'train'"), rows.filter("split in ('validation', 'test')")
    bad = splitting.decontamination(train, held).groupBy("id").agg(F.array_sort(F.collect_set("level")).alias("levels"))
    return train.select("id").distinct().join(bad, "id", "left").select("id", F.when(F.col("levels").isNull(), "train").otherwise("quarantined").alias("split"), F.coalesce(F.array_join("levels", ","), F.lit("")).alias("levels"))


@query("g07_groups_in_several_splits", "SELECT group_key, count(DISTINCT split) AS splits, count(*) AS rows FROM (SELECT split, " + _KEY % "" + " AS group_key FROM aligned_pairs) GROUP BY 1 HAVING count(DISTINCT split) > 1")
def g07(spark, d):
    return splitting.groups_in_several_splits(pairs(spark, d), splitting.group_key())


@query("g08_split_report", "SELECT split, content_type, domain, count(*) AS rows, sum(length(tvl))::BIGINT AS tvl_chars, sum(length(en))::BIGINT AS en_chars FROM aligned_pairs GROUP BY ALL")
def g08(spark, d):
    return pairs(spark, d).groupBy("split", "content_type", "domain").agg(F.count("*").alias("rows"), F.sum(F.length("tvl")).alias("tvl_chars"), F.sum(F.length("en")).alias("en_chars"))


@query("g09_shared_documents", "SELECT doc_id FROM aligned_pairs WHERE split = 'train' AND doc_id IS NOT NULL INTERSECT SELECT doc_id FROM aligned_pairs WHERE split = 'test'")
def g09(spark, d):
    of = lambda s: pairs(spark, d).filter(F.col("split") == s).filter("doc_id is not null").select("doc_id")
    return of("train").intersect(of("test"))


# --- repetition

_WORDS4 = r"""WITH w AS (SELECT id, regexp_extract_all(lower(body_tvl), '[\p{L}\p{N}\p{M}_]+') AS t FROM translations WHERE body_tvl IS NOT NULL), g AS (SELECT id, len(t) AS words, CASE WHEN len(t) >= 5 THEN [array_to_string(t[i:i+3], ' ') FOR i IN range(1, len(t) - 2)] ELSE [] END AS g FROM w)"""


@query(
    "r01_unique_4grams",
    _WORDS4 + " SELECT id, CASE WHEN words < 5 THEN 1.0 ELSE round(len(list_distinct(g)) / len(g), 6) END AS unique_share, CASE WHEN words < 5 THEN 0.0 ELSE round(list_max(map_values(list_histogram(g))) / len(g), 6) END AS top_share FROM g".replace("list_histogram(g)", "list_aggregate(g, 'histogram')"),
)
def r01(spark, d):
    rows = table(spark, d, "translations").filter("body_tvl is not null").select("id", F.regexp_extract_all(F.lower("body_tvl"), F.lit(r"([\p{L}\p{N}\p{M}_]+)"), 1).alias("t"))
    # exploded and counted rather than compared inside one row, so that long texts stay linear
    grams = rows.filter(F.size("t") >= 5).select("id", F.explode(F.transform(F.sequence(F.lit(1), F.size("t") - 3), lambda i: F.array_join(F.slice("t", i, 4), " "))).alias("g"))
    each = grams.groupBy("id", "g").agg(F.count("*").alias("n")).groupBy("id").agg(F.round(F.count("*") / F.sum("n"), 6).alias("unique_share"), F.round(F.max("n") / F.sum("n"), 6).alias("top_share"))
    return rows.select("id").join(each, "id", "left").fillna(1.0, ["unique_share"]).fillna(0.0, ["top_share"])


@query("r09_collapse_scan")
def r09(spark, d):
    return collapse.collapse(table(spark, d, "translations"), "id", "title_tvl", "body_tvl").withColumn("detectors", F.array_join("detectors", ","))


@query(
    "r10_best_attempt",
    """SELECT article_id, id, attempt_number FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY bad, CASE WHEN bad = 0 THEN attempt_number END NULLS FIRST, CASE WHEN bad = 1 THEN -attempt_number END NULLS FIRST, id) AS r
    FROM (SELECT *, CASE WHEN is_collapsed = 1 THEN 1 ELSE 0 END AS bad FROM translations WHERE article_id IS NOT NULL)) WHERE r = 1""",
)
def r10(spark, d):
    rows = table(spark, d, "translations").filter("article_id is not null")
    return collapse.best_attempt(rows, "article_id", "attempt_number", F.col("is_collapsed") == 1).select("article_id", "id", "attempt_number")


# --- chat

_LINES = lambda x: (
    tx.sql_strip("array_to_string(list_transform(string_split_regex(nfc_normalize(coalesce(" + x + ", '')), '\\r\\n|[\\n\\r]'), l -> " + tx.sql_strip("regexp_replace(l, '[ \\t]+', ' ', 'g')") + "), chr(10))")
)
_RENDER = f"""WITH p AS (SELECT id, source_line, source_file, content_type, {_LINES('tvl')} AS tvl, {_LINES('en')} AS en FROM aligned_pairs), v AS (SELECT *, coalesce(content_type IN ('word', 'expression', 'translation_phrase'), false) OR (length(tvl) < 30 AND length(en) < 80) AS vocab FROM p),
 x AS (SELECT *, unnest(['tvl_to_en', 'en_to_tvl']) AS direction FROM v), k AS (SELECT *, id || '::' || direction AS key FROM x)"""


@query(
    "m01_render",
    _RENDER + f" SELECT key AS id, direction, vocab, (CASE WHEN vocab THEN {tx.sql_bucket('key', 5)} ELSE {tx.sql_bucket('key', 3)} END)::INT AS template_idx, CASE WHEN direction = 'tvl_to_en' THEN en ELSE tvl END AS answer FROM k",
)
def m01(spark, d):
    return chat.render(pairs(spark, d)).select("id", "direction", "vocab", "template_idx", F.element_at("messages", -1)["content"].alias("answer"))


@query("a02_render_summary")
def a02(spark, d):
    return chat.render_summary(chat.render(pairs(spark, d)))




# --- reports


@query("a01_clean_report_by_type", _clean_sql("balanced") + "SELECT content_type, domain, count(*) AS accepted, round(avg(length(tvl)), 4) AS tvl_mean, round(median(length(en)), 4) AS en_median, round(median(length(tvl) / length(en)), 6) AS ratio_median FROM r WHERE reason IS NULL GROUP BY ALL")
def a01(spark, d):
    lengths = {"tvl_length": F.length("tvl"), "en_length": F.length("en"), "ratio": cleaning.length_ratio(F.col("tvl"), F.col("en"))}
    return cleaned(spark, d, keep=("content_type", "domain"), derive=lengths).filter("reason is null").groupBy("content_type", "domain").agg(
        F.count("*").alias("accepted"), F.round(F.avg("tvl_length"), 4).alias("tvl_mean"), F.round(F.median("en_length"), 4).alias("en_median"), F.round(F.median("ratio"), 6).alias("ratio_median")
    )


@query("a07_length_report", "SELECT content_type, count(*) AS pairs, min(length(tvl)) AS tvl_min, max(length(tvl)) AS tvl_max, round(avg(length(tvl)), 4) AS tvl_mean, round(median(length(tvl)), 4) AS tvl_median, min(length(en)) AS en_min, max(length(en)) AS en_max, round(avg(length(en)), 4) AS en_mean, round(median(length(en)), 4) AS en_median FROM aligned_pairs GROUP BY 1")
def a07(spark, d):
    return cleaning.length_report(pairs(spark, d), ("content_type",)).drop("ratio_min", "ratio_max", "ratio_mean", "ratio_median")


@query("a08_ratio_histogram", "SELECT CASE WHEN length_ratio < 0.5 THEN '<0.5' WHEN length_ratio < 0.8 THEN '0.5-0.8' WHEN length_ratio < 1.0 THEN '0.8-1.0' WHEN length_ratio < 1.3 THEN '1.0-1.3' WHEN length_ratio < 2.0 THEN '1.3-2.0' ELSE '>=2.0' END AS ratio_range, count(*) AS pairs FROM aligned_pairs WHERE length_ratio > 0 GROUP BY 1")
def a08(spark, d):
    return cleaning.ratio_histogram(pairs(spark, d))


@query("a09_quality_issues", "SELECT count(*) FILTER (coalesce(tvl, '') = '' OR coalesce(en, '') = '') AS empty, count(*) FILTER (length_ratio < 0.3 OR length_ratio > 3) AS extreme, count(*) FILTER (length(tvl) < 10 OR length(en) < 10) AS short FROM aligned_pairs")
def a09(spark, d):
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    return pairs(spark, d).agg(
        F.count_if(blank("tvl") | blank("en")).alias("empty"), F.count_if((F.col("length_ratio") < 0.3) | (F.col("length_ratio") > 3)).alias("extreme"),
        F.count_if((F.length("tvl") < 10) | (F.length("en") < 10)).alias("short"),
    )


# --- metrics


@query("q01_translation_metrics")
def q01(spark, d):
    """Attempts against the article's last translation, as predictions and references."""
    t = table(spark, d, "translations").filter("article_id is not null")
    last = t.groupBy("article_id").agg(F.max_by("body_tvl", F.struct("attempt_number", "id")).alias("reference"))
    return metrics.translation_metrics(keyed(t.join(last, "article_id").select("body_tvl", "reference", "attempt_number", "id"), "id"), "body_tvl", "reference", "attempt_number")


@query("q04_token_overlap", r"SELECT id, source_line, source_file, round(coalesce(len(list_intersect(a, b)) / nullif(len(a), 0), 0), 6) AS overlap FROM (SELECT id, source_line, source_file, list_distinct(list_filter(string_split_regex(lower(tvl), '[^\p{L}\p{N}]+'), w -> w <> '')) a, list_distinct(list_filter(string_split_regex(lower(en), '[^\p{L}\p{N}]+'), w -> w <> '')) b FROM aligned_pairs WHERE tvl IS NOT NULL AND en IS NOT NULL)")
def q04(spark, d):
    return pairs(spark, d).filter("tvl is not null and en is not null").select("id", "source_line", "source_file", F.round(metrics.token_overlap(F.col("tvl"), F.col("en")), 6).alias("overlap"))


# --- documents


@query(
    "e01_sentences",
    f"""SELECT doc_id, len(list_filter(string_split(regexp_replace({tx.sql_squeeze('text')}, '([.!?])\\s+([A-ZĀĒĪŌŪ0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), s -> s <> ''))::INT AS sentences,
    (list_filter(list_transform(string_split_regex(replace(text, chr(65279), ''), '\\r\\n|[\\n\\r]'), l -> {tx.sql_strip("regexp_replace(l, '[ \\t\\x{A0}]+', ' ', 'g')")}), l -> l <> ''))[1] AS headline FROM documents WHERE text IS NOT NULL""",
)
def e01(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.size(tx.sentences(F.col("text"))).alias("sentences"), documents.headline(F.col("text")).alias("headline"))


@query("e02_entities", f"SELECT entity, count(*) AS documents FROM (SELECT doc_id, unnest(list_distinct(list_filter(regexp_extract_all(text, '{documents.ENTITY.replace(chr(39), chr(39) * 2)}'), e -> length(e) >= 3 AND e NOT IN ({_sql_in(documents.STOP_ENTITIES)})))) AS entity FROM documents) GROUP BY 1 HAVING count(*) >= 3")
def e02(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.explode(documents.entities(F.col("text"))).alias("entity"))
    return rows.groupBy("entity").agg(F.count("*").alias("documents")).filter("documents >= 3")


@query("e03_numbers", r"SELECT doc_id, len(list_distinct(regexp_extract_all(text, '\b(\d[\d,]*(?:\.\d+)?%?)', 1))) AS numbers FROM documents WHERE text IS NOT NULL")
def e03(spark, d):
    return table(spark, d, "documents").filter("text is not null").select("doc_id", F.size(documents.numbers(F.col("text"))).cast("long").alias("numbers"))


_PAGES = "CASE WHEN regexp_matches(page_or_image, '^\\d+$') THEN page_or_image::INT END"


@query(
    "e09_bundles",
    f"WITH s AS (SELECT doc_id, segment_id, min(text) AS text, min({_PAGES}) AS page FROM extracted_segments WHERE length(trim(text)) >= 40 GROUP BY ALL) SELECT doc_id, count(*)::INT AS segments, min(page) AS first_page, max(page) AS last_page, string_agg(text, chr(10) || chr(10) ORDER BY segment_id) AS text FROM s GROUP BY doc_id",
)
def e09(spark, d):
    return documents.bundles(table(spark, d, "extracted_segments"))


@query("e12_registry")
def e12(spark, d):
    segments = table(spark, d, "extracted_segments")
    return documents.registry(documents.bundles(segments), segments)


@query("p14_source_families", "SELECT CASE WHEN regexp_extract(lower(source_path), '^[^/]+/([^/]+)/', 1) <> '' THEN regexp_extract(lower(source_path), '^[^/]+/([^/]+)/', 1) ELSE 'other' END AS family, count(DISTINCT source_path) AS sources, count(*) AS segments FROM extracted_segments GROUP BY 1")
def p14(spark, d):
    return table(spark, d, "extracted_segments").groupBy(documents.family(F.col("source_path")).alias("family")).agg(F.count_distinct("source_path").alias("sources"), F.count("*").alias("segments"))


@query(
    "a20_spelling_clusters",
    "SELECT cluster, representative, array_to_string(spellings, ',') AS spellings FROM (SELECT translate(lower(w), 'āēīōūʻ’''‵', 'aeiou') AS cluster, min(w) AS representative, list_sort(list_distinct(list(w))) AS spellings FROM (SELECT unnest(string_split(tvl, ' ')) AS w FROM aligned_pairs WHERE content_type = 'word') WHERE w <> '' GROUP BY 1) WHERE len(spellings) >= 2",
)
def a20(spark, d):
    words = pairs(spark, d).filter("content_type = 'word'").select(F.explode(F.split("tvl", " ")).alias("w")).filter("w <> ''")
    return documents.spelling_clusters(words, "w").select("cluster", "representative", F.array_join("spellings", ",").alias("spellings"))


@query("e07_segment_paragraphs", "SELECT segment_id, count(*) AS paragraphs, sum(length(p))::BIGINT AS chars FROM (SELECT segment_id, " + tx.sql_strip("unnest(string_split_regex(text, '\\n\\n+'))") + " AS p FROM (SELECT DISTINCT segment_id, text FROM extracted_segments WHERE text IS NOT NULL)) WHERE length(p) >= 40 GROUP BY 1")
def e07(spark, d):
    rows = table(spark, d, "extracted_segments").filter("text is not null").select("segment_id", "text").distinct()
    each = rows.select("segment_id", F.explode(F.split("text", r"\n\n+")).alias("p")).withColumn("p", tx.strip(F.col("p")))
    return each.filter(F.length("p") >= 40).groupBy("segment_id").agg(F.count("*").alias("paragraphs"), F.sum(F.length("p")).alias("chars"))


@query(
    "w12_page_islands",
    """WITH l AS (SELECT source_path, segment_id, min(extraction_method) AS m FROM extracted_segments GROUP BY ALL), c AS (SELECT *, CASE WHEN lag(m) OVER w IS NOT DISTINCT FROM m THEN 0 ELSE 1 END AS ch FROM l WINDOW w AS (PARTITION BY source_path ORDER BY segment_id)),
    i AS (SELECT *, sum(ch) OVER (PARTITION BY source_path ORDER BY segment_id) AS island FROM c) SELECT source_path, island::BIGINT AS island, min(m) AS label, min(segment_id) AS first, max(segment_id) AS last, count(*) AS lines FROM i GROUP BY source_path, island""",
)
def w12(spark, d):
    rows = table(spark, d, "extracted_segments").groupBy("source_path", "segment_id").agg(F.min("extraction_method").alias("m"))
    return documents.islands(rows, "source_path", "segment_id", F.col("m"))
