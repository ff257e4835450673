"""Registered queries of checks, evaluation, pairing and events, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from korale.functions import text as tx
from korale.operators import evaluation, feedback, integrity, pairing, postprocess, selection, splitting
from korale.plans.corpus import QUERIES, SQL, query
from korale.session import table

_FORM = tx.sql_form
_ALL = "('train', 'validation', 'test')"


def _pairs(spark, d):
    return table(spark, d, "aligned_pairs")


# --- integrity


def _shared_sql(key: str) -> str:
    return f"""(SELECT count(*) FILTER (a AND c) AS tt, count(*) FILTER (a AND b) AS tv, count(*) FILTER (b AND c) AS vt, count(*) FILTER (a::INT + b::INT + c::INT > 1) AS s FROM (SELECT bool_or(split = 'train') a, bool_or(split = 'validation') b, bool_or(split = 'test') c
     FROM (SELECT split, {key} AS k FROM aligned_pairs WHERE split IN {_ALL}) WHERE k IS NOT NULL AND k <> '' GROUP BY k))"""


_CHECKS = f"""WITH s AS (SELECT id, source_file, source_line, split, content_type, unnest(['tvl', 'en']) AS side, unnest([{_FORM("coalesce(tvl, '')")}, {_FORM("coalesce(en, '')")}]) AS form FROM aligned_pairs WHERE split IN {_ALL}),
 x AS (SELECT form, bool_or(split = 'train' AND side = 'tvl') t, bool_or(split = 'train' AND side = 'en') e, count(*) FILTER (split <> 'train' AND side = 'tvl') nt, count(*) FILTER (split <> 'train' AND side = 'en') ne FROM s GROUP BY 1),
 w AS (SELECT *, list_filter(string_split(form, ' '), v -> v <> '') AS t FROM s), v AS (SELECT DISTINCT unnest([array_to_string(t[i:i+9], ' ') FOR i IN range(1, len(t) - 8)]) AS g FROM w WHERE split <> 'train' AND content_type = 'bible_verse' AND len(t) >= 10),
 r AS (SELECT id, source_file, source_line, unnest([array_to_string(t[i:i+9], ' ') FOR i IN range(1, len(t) - 8)]) AS g FROM w WHERE split = 'train' AND coalesce(content_type, '') <> 'bible_verse' AND len(t) >= 10),
 l AS (SELECT (SELECT count(DISTINCT (id, source_file, source_line)) FROM r WHERE g IN (SELECT g FROM v)) AS leaks, (SELECT count(*) FROM aligned_pairs WHERE split = 'train' AND coalesce(content_type, '') <> 'bible_verse') AS n),
 k AS (SELECT count(*) FILTER (split = 'test') a, count(*) FILTER (split = 'validation') b, {", ".join(f"count(*) FILTER (split = '{s}' AND content_type = '{t}') AS {t}_{s}" for t in integrity.REQUIRED for s in ("validation", "test"))} FROM aligned_pairs),
 d AS (SELECT * FROM {_shared_sql("doc_id")}), b AS (SELECT * FROM {_shared_sql("CASE WHEN content_type = 'bible_verse' AND book_num <> 0 THEN book_num::VARCHAR END")}), y AS (SELECT * FROM {_shared_sql("text_date")})
 {" UNION ALL ".join(f"SELECT '{n}_{c}' AS check, 'failure' AS level, {col} AS found FROM {t}" for n, t in (("doc_id", "d"), ("book", "b"), ("date", "y")) for c, col in (("train_test", "tt"), ("train_validation", "tv"), ("in_several_splits", "s")))}
 UNION ALL SELECT 'book_validation_test', 'failure', vt FROM b UNION ALL SELECT 'exact_tvl', 'failure', coalesce(sum(nt) FILTER (t), 0)::BIGINT FROM x UNION ALL SELECT 'exact_en', 'failure', coalesce(sum(ne) FILTER (e), 0)::BIGINT FROM x UNION ALL SELECT 'exact_any', 'failure', coalesce(sum(nt + ne) FILTER (t OR e), 0)::BIGINT FROM x
 UNION ALL SELECT 'ngram_leaks', 'failure', leaks FROM l UNION ALL SELECT 'ngram_leaks_per_10000', 'warning', CASE WHEN n > 0 THEN round(leaks * 10000 / n) ELSE 0 END::BIGINT FROM l
 UNION ALL SELECT 'small_test', 'warning', greatest(0, 300 - a) FROM k UNION ALL SELECT 'small_validation', 'warning', greatest(0, 100 - b) FROM k
 {" ".join(f"UNION ALL SELECT 'missing_{t}_{s}', 'warning', ({t}_{s} = 0)::BIGINT FROM k" for t in integrity.REQUIRED for s in ("validation", "test"))}"""


def _checks(spark, d):
    return integrity.checks(_pairs(spark, d).select("id", "split", "content_type", "doc_id", "book_num", "text_date", "source_file", "source_line", "tvl", "en"))


@query("g07_split_checks", _CHECKS)
def g07(spark, d):
    return _checks(spark, d)


@query("g06_failed_checks", f"SELECT * FROM ({_CHECKS}) WHERE found <> 0 AND level = 'failure'")
def g06(spark, d):
    return _checks(spark, d).filter("found <> 0 and level = 'failure'")


# --- repetitions and last rules

_KEYED = "SELECT *, row_number() OVER (PARTITION BY {k} ORDER BY id, source_file, source_line, ingested_at) AS n FROM aligned_pairs"


@query(
    "u03_duplicate_reasons",
    f"SELECT id, source_file, source_line, array_to_string(list_filter([CASE WHEN coalesce(tvl, '') = '' THEN 'empty_text' END, CASE WHEN n > 1 THEN 'duplicate_pair' END], x -> x IS NOT NULL), ',') AS reasons FROM ({_KEYED})".replace("{k}", tx.sql_squeeze("nfc_normalize(coalesce(tvl, ''))") + " || chr(1) || " + tx.sql_squeeze("nfc_normalize(coalesce(en, ''))")),
)
def u03(spark, d):
    rows = _pairs(spark, d).select("id", "source_file", "source_line", "ingested_at", "tvl", "en")
    reasons = F.array_compact(F.array(F.when(F.coalesce("tvl", F.lit("")) == "", "empty_text")))
    return postprocess.with_duplicates(rows, reasons, ("id", "source_file", "source_line", "ingested_at")).select("id", "source_file", "source_line", F.array_join("reasons", ",").alias("reasons"))


@query("u09_first_pairs", f"SELECT count(*) AS pairs, count(*) FILTER (n = 1) AS firsts FROM ({_KEYED})".replace("{k}", "concat_ws(chr(1), lower(trim(tvl)), lower(trim(en)))"))
def u09(spark, d):
    rows = _pairs(spark, d).select("id", "source_file", "source_line", "ingested_at", "tvl", "en")
    key = F.concat_ws("\x01", F.lower(F.trim("tvl")), F.lower(F.trim("en")))
    got = postprocess.firsts(rows, key, ("id", "source_file", "source_line", "ingested_at"))
    return got.agg(F.count("*").alias("pairs"), F.count_if(~F.col("again")).alias("firsts"))


@query("u06_distinct_tasks", f"SELECT id, fetched_at FROM (SELECT id, fetched_at, row_number() OVER (PARTITION BY lower({tx.sql_squeeze("coalesce(category, '')")}), lower({tx.sql_squeeze("coalesce(title_en, '')")}) ORDER BY fetched_at, id, url) AS n FROM articles WHERE length(title_en) >= 12) WHERE n = 1")
def u06(spark, d):
    rows = table(spark, d, "articles").select("id", "fetched_at", "url", "category", F.col("title_en").alias("prompt"))
    return postprocess.distinct_tasks(rows, ("category", "prompt"), ("fetched_at", "id", "url"), 12).select("id", "fetched_at")


_W = lambda c: f"list_filter(string_split_regex({c}, '\\s+'), w -> w <> '')"


def _list(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


@query(
    "e24_postprocess",
    f"""WITH k AS ({_KEYED}), w AS (SELECT *, {_W('tvl')} AS a, {_W('en')} AS b FROM k),
    r AS (SELECT id, source_file, source_line, CASE WHEN n > 1 THEN 'duplicate' WHEN lower(regexp_extract(rtrim(en), '([A-Za-z0-9_]+)$', 1)) IN ({_list(postprocess.CUT_NEGATIONS)}) THEN 'truncated_en' WHEN len(b) <= 2 AND len(a) >= 5 THEN 'stub_en'
     WHEN len(list_intersect(list_distinct(a), [{_list(postprocess.GLOSSES)}])) >= 2 THEN 'gloss_in_tvl' WHEN len(a) >= 6 AND len(list_filter(a, x -> lower(x) IN ({_list(postprocess.ENGLISH)}))) / len(a) > 0.35 THEN 'en_prose_in_tvl'
     WHEN (len(a) >= 10 AND len(list_filter(a, x -> length(x) <= 2)) / len(a) > 0.6) OR (len(b) >= 10 AND len(list_filter(b, x -> length(x) <= 2)) / len(b) > 0.6) THEN 'garbled_text' END AS reason FROM w WHERE tvl IS NOT NULL AND en IS NOT NULL)
    SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM r GROUP BY 1""".replace("{k}", "concat_ws(chr(1), lower(trim(tvl)), lower(trim(en)))"),
)
def e24(spark, d):
    rows = _pairs(spark, d).filter("tvl is not null and en is not null").select("id", "source_file", "source_line", "ingested_at", "tvl", "en")
    got = postprocess.postprocess(rows, ("id", "source_file", "source_line", "ingested_at"))
    return got.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


# --- splits and orders


@query("h07_split_rows", f"SELECT id, CASE WHEN {tx.sql_bucket('doc_id', 100)} < 8 THEN 'validation' ELSE 'train' END AS split, source_file, source_line FROM aligned_pairs WHERE doc_id IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM aligned_pairs WHERE split = 'test' AND doc_id IS NOT NULL)")
def h07(spark, d):
    rows = _pairs(spark, d).select("id", "doc_id", "split", "source_file", "source_line")
    held = rows.filter("split = 'test' and doc_id is not null").select("doc_id").distinct()
    return splitting.split_documents(rows.drop("split"), held, "doc_id", 8).select("id", "split", "source_file", "source_line")


@query("h16_variants", f"SELECT id, source_file, source_line, ['a', 'b', 'c', 'd'][1 + {tx.sql_bucket("'v' || id", 4)}] AS variant FROM aligned_pairs WHERE id IS NOT NULL")
def h16(spark, d):
    return _pairs(spark, d).filter("id is not null").select("id", "source_file", "source_line", splitting.variant(F.concat(F.lit("v"), "id"), ("a", "b", "c", "d")).alias("variant"))


@query("h17_epoch_order", "SELECT count(*) AS rows, count(DISTINCT doc_id) AS documents FROM documents")
def h17(spark, d):
    """Each epoch has all rows in another order; what can be compared is that none is lost."""
    rows = table(spark, d, "documents").select("doc_id")
    return selection.epoch_order(rows, "doc_id", 3, 1).agg(F.count("*").alias("rows"), F.count_distinct("doc_id").alias("documents"))


@query("h12_ratio_counts", "SELECT coalesce(sum(n), 0)::BIGINT AS kept FROM (SELECT least(count(*), (SELECT count(*) FROM documents WHERE lang IN ('en', 'tvl', 'sm'))) AS n FROM documents WHERE lang IN ('en', 'tvl', 'sm'))")
def h12(spark, d):
    """Ratios that equal the pools' shares keep every row."""
    rows = table(spark, d, "documents").filter(F.col("lang").isin("en", "tvl", "sm")).select("doc_id", "lang")
    counts = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    whole = sum(counts.values())
    return selection.mix(rows, "lang", "doc_id", {k: v / whole + 1e-12 for k, v in counts.items()}).agg(F.count("*").alias("kept"))


# --- scores

_LOSS = "round(avg(m), 6) AS loss, count(*) AS batches FROM (SELECT avg(length(text)) AS m FROM documents WHERE text IS NOT NULL GROUP BY floor(doc_id / 64))"


@query("q14_batch_loss", f"SELECT {_LOSS}")
def q14(spark, d):
    rows = table(spark, d, "documents").filter("text is not null").select("doc_id", F.length("text").cast("double").alias("loss"))
    return evaluation.mean_of_batches(rows, F.col("doc_id"), "loss", 64)


@query(
    "q06_style",
    f"""WITH p AS (SELECT id, fetched_at, coalesce(category, '') AS g, array_to_string(list_filter(list_transform(string_split_regex(coalesce(title_en, ''), '\\r\\n|[\\n\\r]'), l -> {tx.sql_strip("regexp_replace(l, '[ \\t\\x{A0}]+', ' ', 'g')")}), l -> l <> ''), chr(10)) AS t, id AS k FROM articles), f AS (SELECT *, length(g) % 4 AS n FROM p)
    SELECT id, fetched_at, CASE WHEN t = '' THEN 0.0 WHEN n = 0 THEN CASE WHEN len({_W('t')}) <= 16 THEN 1.0 ELSE 0.3 END WHEN n = 1 THEN CASE WHEN contains(t, chr(10)) OR starts_with(t, '-') THEN 1.0 ELSE 0.4 END WHEN n = 2 THEN CASE WHEN length(regexp_replace(t, '[^.!?]', '', 'g')) <= 4 THEN 1.0 ELSE 0.5 END ELSE 0.8 END::DOUBLE AS style FROM f""",
)
def q06(spark, d):
    family = F.element_at(F.array(*map(F.lit, ("headline_generation", "entity_extraction", "summary_short", "qa"))), F.length(F.coalesce("category", F.lit(""))) % 4 + 1)
    return table(spark, d, "articles").select("id", "fetched_at", evaluation.style(family, F.col("title_en")).alias("style"))


@query("q05_preserved", """SELECT id, CASE WHEN len(r) = 0 THEN 1.0 ELSE round(len(list_filter(r, x -> contains(coalesce(title_tvl, ''), x))) / len(r), 6) END AS share FROM (SELECT id, title_tvl, list_distinct(regexp_extract_all(body, '\\b(\\d[\\d,]*(?:\\.\\d+)?%?)', 1)) AS r FROM (SELECT id, replace(title_tvl, chr(160), ' ') AS title_tvl, regexp_replace(lower(coalesce(body_tvl, '')), '[^a-z0-9,.% ]', '', 'g') AS body FROM translations))""")
def q05(spark, d):
    from korale.operators.documents import numbers
    from korale.operators.metrics import preserved

    body = F.regexp_replace(F.lower(F.coalesce("body_tvl", F.lit(""))), "[^a-z0-9,.% ]", "")
    return table(spark, d, "translations").select("id", F.round(preserved(numbers(body), F.coalesce(F.replace("title_tvl", F.lit(" "), F.lit(" ")), F.lit(""))), 6).alias("share"))


@query("q07_all_scores")
def q07(spark, d):
    """The five scores of each attempt against the article's last translation, over all rows and by attempt."""
    t = table(spark, d, "translations").filter("article_id is not null")
    last = t.groupBy("article_id").agg(F.max_by("body_tvl", F.struct("attempt_number", "id")).alias("reference"))
    rows = t.join(last, "article_id").filter("body_tvl is not null and reference is not null")
    rows = rows.select(F.col("body_tvl").alias("prediction"), "reference", F.lit("").alias("source"), F.lit("summary_short").alias("family"), F.lit("").alias("path"), F.col("attempt_number").cast("string").alias("k"))
    return evaluation.means(evaluation.scores(rows), "k")


@query("q09_differences", "SELECT a.attempt_number, 'chars' AS metric, round(a.v - b.v, 6) AS delta FROM (SELECT attempt_number, avg(length(body_tvl)) AS v FROM translations WHERE model_id = (SELECT max(model_id) FROM translations) GROUP BY 1) a JOIN (SELECT attempt_number, avg(length(body_tvl)) AS v FROM translations WHERE model_id = (SELECT min(model_id) FROM translations) GROUP BY 1) b USING (attempt_number)")
def q09(spark, d):
    rows = table(spark, d, "translations").filter("model_id is not null")
    ends = rows.agg(F.max("model_id").alias("a"), F.min("model_id").alias("b")).first()
    metrics_ = rows.groupBy(F.col("model_id").alias("model"), "attempt_number").agg(F.avg(F.length("body_tvl")).alias("value")).withColumn("metric", F.lit("chars"))
    return evaluation.differences(metrics_, ends.a or "", ends.b or "", ("attempt_number",))


# --- pairing


@query("j14_manifest", "SELECT s.segment_id, coalesce(m.kind, 'unlisted') AS kind FROM (SELECT DISTINCT segment_id, doc_id FROM extracted_segments) s LEFT JOIN (SELECT doc_id, min(support_type) AS kind FROM extracted_segments WHERE doc_id IS NOT NULL AND support_type IS NOT NULL AND length(doc_id) % 2 = 0 GROUP BY 1) m USING (doc_id)")
def j14(spark, d):
    rows = table(spark, d, "extracted_segments").select("segment_id", "doc_id", "support_type")
    listed = rows.filter("doc_id is not null and support_type is not null and length(doc_id) % 2 = 0").groupBy("doc_id").agg(F.min("support_type").alias("kind"))
    return pairing.with_default(rows.select("segment_id", "doc_id").distinct(), listed, "doc_id", "kind", "unlisted").select("segment_id", "kind")


@query(
    "j02_paragraph_ids",
    """WITH e AS (SELECT pair_id, sent_no, max(sentence) FILTER (side = 'tvl') AS tvl, max(sentence) FILTER (side = 'en') AS en FROM pair_sentences WHERE sentence IS NOT NULL GROUP BY ALL), n AS (SELECT pair_id, count(tvl) a, count(en) b, count(*) FILTER (tvl IS NOT NULL AND en IS NOT NULL) c FROM e GROUP BY 1 HAVING count(tvl) > 0 AND count(en) > 0),
    j AS (SELECT *, (greatest(a, b) - least(a, b)) / greatest(a, b) > 0.2 AND c < least(a, b) * 0.8 AS apart FROM e JOIN n USING (pair_id))
    SELECT pair_id, sent_no AS pid, tvl, en, 'paragraph_id' AS method, CASE WHEN a = b AND c = a THEN 0.9 ELSE 0.8 END::DOUBLE AS confidence FROM j WHERE NOT apart AND tvl IS NOT NULL AND en IS NOT NULL AND (length(tvl) >= 20 OR length(en) >= 20) AND coalesce(length(tvl) / nullif(length(en), 0) BETWEEN 0.15 AND 7, true)
    UNION ALL SELECT pair_id, NULL, string_agg(tvl, ' ' ORDER BY sent_no), string_agg(en, ' ' ORDER BY sent_no), 'document_level', 0.6 FROM j WHERE apart GROUP BY 1""",
)
def j02(spark, d):
    return pairing.by_paragraph_id(table(spark, d, "pair_sentences"), "pair_id", "side", "sent_no", "sentence")


@query("j17_zipped", "SELECT e.id, e.title_tvl AS reference, p.title_tvl AS prediction FROM translations e JOIN translations p USING (id) WHERE e.id % 2 = 0")
def j17(spark, d):
    rows = table(spark, d, "translations")
    return rows.filter("id % 2 = 0").select("id", F.col("title_tvl").alias("reference")).join(rows.select("id", F.col("title_tvl").alias("prediction")), "id")


_ORIGINS = ("native", "english", "mixed", "plain")


@query("j19_prompt_table", "SELECT id, fetched_at, origin, 'Ask ' || origin || ': ' || title_en AS prompt FROM articles, (VALUES ('native'), ('english'), ('mixed'), ('plain')) o(origin) WHERE title_en IS NOT NULL AND category IS NOT NULL")
def j19(spark, d):
    """A prompt for each of a fixed list of origins; the list is no table, so each row is exploded where it stands."""
    rows = table(spark, d, "articles").filter("title_en is not null and category is not null").withColumn("origin", F.explode(F.array(*map(F.lit, _ORIGINS))))
    return rows.select("id", "fetched_at", "origin", F.concat(F.lit("Ask "), "origin", F.lit(": "), "title_en").alias("prompt"))


# --- orders, configuration, events


@query("w08_featured_first", "SELECT id, fetched_at FROM (SELECT *, row_number() OVER (ORDER BY (category IS NOT NULL AND author IS NOT NULL) DESC, published_at DESC NULLS LAST, id, fetched_at) AS n FROM articles) WHERE n <= 6")
def w08(spark, d):
    rows = table(spark, d, "articles").withColumn("featured", F.col("category").isNotNull() & F.col("author").isNotNull())
    return feedback.featured_first(rows, "featured", "published_at", ("id", "fetched_at"), 6).select("id", "fetched_at")


@query("w03_predictions", "SELECT id, title_tvl FROM translations WHERE model_id = (SELECT min(model_id) FROM translations) AND attempt_number = 1 ORDER BY id LIMIT 20")
def w03(spark, d):
    rows = table(spark, d, "translations")
    model = rows.agg(F.min("model_id")).first()[0]
    return feedback.filtered(rows, {"model_id": model, "attempt_number": 1}, ("id",), 20).select("id", "title_tvl")


@query("w14_configuration", "SELECT source_id AS key, max(tags->>'$[0]') AS value FROM articles WHERE json_valid(tags) AND source_id IS NOT NULL GROUP BY 1")
def w14(spark, d):
    rows = table(spark, d, "articles").filter("source_id is not null").select(F.col("source_id").alias("key"), F.col("tags").alias("value_json"))
    return feedback.configuration(rows, "array<string>").groupBy("key").agg(F.max(F.get("value", F.lit(0))).alias("value")).join(
        rows.filter(F.try_parse_json("value_json").isNotNull()).select("key").distinct(), "key", "left_semi"
    )


@query("w15_runs", "SELECT article_id AS run_id, id, attempt_number AS step FROM translations WHERE article_id = (SELECT min(article_id) FROM translations)")
def w15(spark, d):
    rows = table(spark, d, "translations").select(F.col("article_id").alias("run_id"), "id", F.col("attempt_number").alias("step"))
    first = rows.agg(F.min("run_id")).first()[0]
    return rows.filter(F.col("run_id") == F.lit(first)).orderBy("step", "id")


@query("w06_eta", "SELECT id, round(100.0 * attempt_number / 8, 1) AS percent, (8 - attempt_number) * 5 AS eta_seconds FROM translations WHERE attempt_number IS NOT NULL")
def w06(spark, d):
    percent, eta = feedback.progress(F.col("attempt_number"), F.lit(8))
    return table(spark, d, "translations").filter("attempt_number is not null").select("id", percent.alias("percent"), eta.alias("eta_seconds"))


@query("a09_duplicate_counts", "SELECT (SELECT count(*) FROM (SELECT id FROM aligned_pairs GROUP BY 1 HAVING count(*) > 1)) AS repeated_ids, (SELECT count(*) FROM (SELECT 1 FROM aligned_pairs WHERE tvl IS NOT NULL AND en IS NOT NULL GROUP BY tvl, en HAVING count(*) > 1)) AS repeated_pairs")
def a09(spark, d):
    rows = _pairs(spark, d)
    again = lambda df, *keys: df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("c"))
    ids = again(rows.select("id"), "id").select(F.col("c").alias("repeated_ids"))
    texts = again(rows.filter("tvl is not null and en is not null").select(F.xxhash64("tvl", "en").alias("h"), F.xxhash64("en", "tvl").alias("g")), "h", "g").select(F.col("c").alias("repeated_pairs"))
    return ids.join(F.broadcast(texts))


@query("a14_feedback_totals", "SELECT count(*) FILTER (created_at >= TIMESTAMP '2025-01-01') AS recent, count(*) AS total, count(*) FILTER (trim(coalesce(island, '')) <> '') AS with_island, count(*) FILTER (lower(feedback_type) = 'thumbs_up') AS yes, count(*) FILTER (lower(feedback_type) = 'thumbs_down') AS no FROM feedback")
def a14(spark, d):
    return feedback.totals(table(spark, d, "feedback"), "2025-01-01")


@query("a19_run_map", "SELECT article_id AS run_id, count(DISTINCT model_id) AS models, max(CASE WHEN id = m THEN body END) AS last FROM (SELECT article_id, model_id, id, length(body_tvl)::VARCHAR AS body, max(id) OVER (PARTITION BY article_id) AS m FROM translations WHERE article_id IS NOT NULL AND model_id IS NOT NULL) GROUP BY 1")
def a19(spark, d):
    rows = table(spark, d, "translations").filter("article_id is not null and model_id is not null").select(F.col("article_id").alias("run_id"), F.col("model_id").alias("model"), "id", F.length("body_tvl").cast("string").alias("result"))
    return feedback.by_model(rows, "run_id", "model", "result", "id").select("run_id", F.size("models").cast("long").alias("models"), F.element_at("models", F.col("last_model")).alias("last"))


@query("a15_with_baseline", "SELECT coalesce(a.island, b.island) AS island, coalesce(a.n, 0) + coalesce(b.n, 0) AS n FROM (SELECT island, count(*) AS n FROM feedback WHERE island IS NOT NULL GROUP BY 1) a FULL JOIN (VALUES ('Nui', 3), ('Niulakita', 1)) b(island, n) ON a.island = b.island")
def a15(spark, d):
    counts = table(spark, d, "feedback").filter("island is not null").groupBy("island").agg(F.count("*").alias("n"))
    return feedback.with_baseline(counts, spark.createDataFrame([("Nui", 3), ("Niulakita", 1)], "island string, n bigint"), "island", "n")


_EVENTS = "SELECT CASE WHEN source = 'feedback' THEN 'explicit_feedback' ELSE source END AS output, count(*) AS events, count(article_id) AS with_article FROM ({}) GROUP BY 1"


@query("x06_outputs", "SELECT output, count(*) AS events FROM (SELECT 'explicit_feedback' AS output FROM feedback UNION ALL SELECT 'explicit_feedback' FROM feedback WHERE id % 2 = 0 UNION ALL SELECT 'corrections' FROM feedback WHERE id % 2 = 0 AND trim(coalesce(island, '')) <> '' UNION ALL SELECT 'implicit_signals' FROM feedback WHERE id % 3 = 0 UNION ALL SELECT 'poll_votes' FROM feedback WHERE id % 5 = 0) GROUP BY 1")
def x06(spark, d):
    return _exported(spark, d).groupBy("output").agg(F.count("*").alias("events"))


def _exported(spark, d):
    rows = table(spark, d, "feedback")
    forms = rows.filter("id % 2 = 0").select("id", "article_id", F.col("paragraph_idx").alias("correction_paragraph_idx"), F.when(F.col("feedback_type") == "thumbs_up", "yes").otherwise("no").alias("helpful"), F.col("island").alias("correction_text"), "session_id", "island", "created_at")
    signals = rows.filter("id % 3 = 0").select("id", "article_id", F.col("paragraph_idx").alias("paragraph_index"), F.col("feedback_type").alias("signal_type"), "session_id", "island", "created_at")
    polls = rows.filter("id % 5 = 0").select("id", "article_id", F.lit("Which?").alias("question"), F.lit('["a","b"]').alias("options_json"), F.col("feedback_type").alias("vote"), "session_id", "island", "created_at")
    return feedback.export(rows, forms, signals, polls)


@query("x02_article_feedback", "SELECT 'article_feedback:' || id AS id, CASE WHEN feedback_type = 'thumbs_up' THEN 1.0 ELSE 0.0 END::DOUBLE AS score, coalesce(feedback_type = 'thumbs_up', false) AS helpful, paragraph_idx FROM feedback WHERE id % 2 = 0")
def x02(spark, d):
    got = _exported(spark, d).filter("event_type = 'article_feedback'")
    return got.select("id", "score", (F.col("score") > 0).alias("helpful"), "paragraph_idx")


@query("x03_corrections", "SELECT 'correction:article_feedback:' || id AS id, island AS correction FROM feedback WHERE id % 2 = 0 AND trim(coalesce(island, '')) <> ''")
def x03(spark, d):
    return _exported(spark, d).filter("event_type = 'correction_suggestion'").select("id", F.col("label").alias("correction"))


@query("x04_implicit_signals", "SELECT 'implicit:' || id AS id, article_id, paragraph_idx, feedback_type AS signal_type FROM feedback WHERE id % 3 = 0")
def x04(spark, d):
    return _exported(spark, d).filter("event_type = 'implicit_signal'").select("id", "article_id", "paragraph_idx", F.col("label").alias("signal_type"))


@query("x05_poll_votes", "SELECT 'poll_votes:' || id AS id, article_id, feedback_type AS vote, 'a,b' AS options FROM feedback WHERE id % 5 = 0")
def x05(spark, d):
    return _exported(spark, d).filter("event_type = 'poll_vote'").select("id", "article_id", F.col("label").alias("vote"), F.array_join("options", ",").alias("options"))
