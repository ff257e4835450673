"""Registered queries over chat examples, with their SQL. The chats are made of articles: description, title and body as system, user and assistant."""

from __future__ import annotations

from pyspark.sql import functions as F

from korale.functions import text as tx
from korale.operators import chat, metrics, protect, selection, splitting
from korale.plans.corpus import QUERIES, SQL, query
from korale.session import table
from korale.sources import chats

_S = tx.sql_bucket


def _turns(*pairs):
    return F.array(*[F.struct(F.lit(r).alias("role"), (c if not isinstance(c, str) else F.col(c)).alias("content")) for r, c in pairs])


def _chats(spark, d):
    rows = table(spark, d, "articles").select("id", "fetched_at", "source_id", *[F.coalesce(c, F.lit("")).alias(c) for c in ("title_en", "body_en", "og_description_en", "category")])
    return rows.select("id", "fetched_at", "source_id", "category", _turns(("system", "og_description_en"), ("user", "title_en"), ("assistant", "body_en")).alias("messages"))


_CHATS = """WITH c AS (SELECT id, fetched_at, source_id, coalesce(category, '') AS category, coalesce(og_description_en, '') AS s, coalesce(title_en, '') AS u, coalesce(body_en, '') AS a FROM articles),
 l AS (SELECT *, lower(s || ' ' || u || ' ' || a) AS t FROM c),
 f AS (SELECT *, CASE WHEN regexp_matches(t, 'def |function |```python|```java|```js') THEN 'code' WHEN regexp_matches(t, 'solve|calculate|equation|answer is') THEN 'math'
   WHEN regexp_matches(t, 'tool_call|function_call') THEN 'tool' WHEN regexp_matches(t, 'summarize|summary|highlights') THEN 'summarization' WHEN regexp_matches(t, 'translat(e|ion)') THEN 'translation' ELSE 'chat' END AS family,
   greatest(1, length(s) // 4) + greatest(1, length(u) // 4) + greatest(1, length(a) // 4) AS n FROM l) """


def _families(spark, d):
    return _chats(spark, d).withColumn("task_family", chat.task_family(F.col("messages")))


@query("p16_task_families", _CHATS + "SELECT id, fetched_at, family FROM f")
def p16(spark, d):
    return _families(spark, d).select("id", "fetched_at", F.col("task_family").alias("family"))


@query("m04_translate_masks", _CHATS + "SELECT family, CASE WHEN family IN ('code', 'tool') THEN 'preserve,translate,selective' ELSE 'preserve,translate,translate' END AS mask, count(*) AS n FROM f GROUP BY ALL")
def m04(spark, d):
    return _families(spark, d).groupBy(F.col("task_family").alias("family"), F.array_join(chat.translate_mask(F.col("messages"), F.col("task_family")), ",").alias("mask")).agg(F.count("*").alias("n"))


@query("p23_family_filter", _CHATS + "SELECT id, fetched_at, family FROM f WHERE (family IN ('chat', 'summarization', 'math') AND family <> 'math') OR source_id IS NULL")
def p23(spark, d):
    kept = selection.by_family(_families(spark, d), ("chat", "summarization", "math"), ("math",), F.col("source_id").isNull())
    return kept.select("id", "fetched_at", F.col("task_family").alias("family"))


_ORIGINS = {"native": ("native",), "native_plus_english": ("native", "english")}


@query("p22_prompt_origins", "SELECT id, fetched_at FROM articles WHERE CASE WHEN coalesce(title_en, '') <> '' THEN 'native' ELSE 'english' END IN ('native')")
def p22(spark, d):
    origin = F.when(F.coalesce("title_en", F.lit("")) != "", "native").otherwise("english")
    return table(spark, d, "articles").filter(selection.origin_allowed(origin, "native", _ORIGINS)).select("id", "fetched_at")


@query("p24_ablation", "SELECT id, fetched_at, 'synthetic' AS stage FROM articles WHERE coalesce(title_en, '') <> '' UNION ALL SELECT id, fetched_at, 'anchor' FROM articles WHERE coalesce(title_en, '') = '' AND category IS NULL")
def p24(spark, d):
    stage = F.when(F.coalesce("title_en", F.lit("")) != "", "synthetic").when(F.col("category").isNull(), "anchor").otherwise("english")
    return selection.ablation(table(spark, d, "articles").withColumn("stage", stage), "tvl_only").select("id", "fetched_at", "stage")


_ROLES = ("system", "user", "assistant", "tool", "critic")


@query(
    "p15_message_actions",
    """SELECT id, fetched_at, role, CASE role WHEN 'system' THEN CASE WHEN regexp_matches(t, '"type"\\s*:\\s*"function"|"parameters"\\s*:\\s*\\{|"tools"\\s*:\\s*\\[') THEN 'preserve' ELSE 'translate' END
    WHEN 'user' THEN CASE WHEN contains(t, '```') THEN 'selective' ELSE 'translate' END WHEN 'assistant' THEN CASE WHEN contains(lower(t), '<tool_call>') OR regexp_matches(lower(t), '"function":\\s*\\{') THEN 'preserve' WHEN contains(t, '```') THEN 'selective' ELSE 'translate' END
    ELSE 'preserve' END AS action FROM (SELECT id, fetched_at, role, coalesce(title_en, '') || CASE WHEN category IS NULL THEN ' {"type": "function"} <tool_call>' WHEN length(title_en) % 2 = 0 THEN ' ```x```' ELSE '' END AS t FROM articles, (VALUES ('system'), ('user'), ('assistant'), ('tool'), ('critic')) r(role))""",
)
def p15(spark, d):
    extra = F.when(F.col("category").isNull(), ' {"type": "function"} <tool_call>').when(F.length("title_en") % 2 == 0, " ```x```").otherwise("")
    rows = table(spark, d, "articles").select("id", "fetched_at", F.concat(F.coalesce("title_en", F.lit("")), extra).alias("t"), F.explode(F.array(*map(F.lit, _ROLES))).alias("role"))
    return rows.select("id", "fetched_at", "role", protect.action(F.col("t"), F.col("role")).alias("action"))


def _calls(spark, d):
    """Chats with a tool's result under its name, a call in a field, and a call in tags."""
    rows = table(spark, d, "articles").select("id", "fetched_at", F.coalesce("title_en", F.lit("")).alias("t"), "category")
    none, texts = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    m = lambda role, content, name=none, calls=texts, call=none: F.struct(F.lit(role).alias("role"), content.alias("content"), name.alias("name"), calls.alias("tool_calls"), call.alias("function_call"))
    messages = F.array(m("user", F.col("t")), m("assistant", F.col("t"), calls=F.array(F.lit('{"name":"a"}'), F.lit('{"name":"b"}'))), m("tool", F.col("t"), F.col("category")),
                       m("assistant", F.lit(""), call=F.when(F.length("t") % 2 == 0, F.lit('{"name":"c"}'))), m("assistant", F.concat(F.lit("<tool_call>"), "category", F.lit("</tool_call>"))))
    return rows.select("id", "fetched_at", messages.alias("messages"))


_FIELDS = ("role", "content", "name", "tool_calls", "function_call")


@query(
    "m10_tool_format",
    """WITH c AS (SELECT id, fetched_at, coalesce(title_en, '') AS t, category AS g, chr(10) AS n FROM articles)
    SELECT id, fetched_at, 'user: ' || t || n || 'assistant: ' || CASE WHEN t <> '' THEN t || n ELSE '' END || '<tool_call>' || n || '{"name":"a"}' || n || '</tool_call>' || n || '<tool_call>' || n || '{"name":"b"}' || n || '</tool_call>' || n
     || 'user: ' || coalesce('[' || g || ']' || n, '') || '<tool_result>' || n || t || n || '</tool_result>' || n || 'assistant: ' || CASE WHEN length(t) % 2 = 0 THEN '<tool_call>' || n || '{"name":"c"}' || n || '</tool_call>' ELSE '' END || n
     || 'assistant: ' || coalesce('<tool_call>' || g || '</tool_call>', '') AS chat FROM c""",
)
def m10(spark, d):
    return _calls(spark, d).select("id", "fetched_at", chat.lines(chat.tool_format(F.col("messages"), _FIELDS)).alias("chat"))


@query("p17_tool_places", "SELECT id, fetched_at, '1,2' || CASE WHEN length(coalesce(title_en, '')) % 2 = 0 THEN ',3' ELSE '' END || CASE WHEN category IS NOT NULL THEN ',4' ELSE '' END AS places FROM articles")
def p17(spark, d):
    places = chat.tool_places(F.col("messages"), _FIELDS)
    return _calls(spark, d).select("id", "fetched_at", F.array_join(F.transform(places, lambda i: i.cast("string")), ",").alias("places"))


@query("m03_messages", "SELECT id, fetched_at, 'user: ' || coalesce(nullif(title_en, ''), nullif(category, ''), '') || chr(10) || CASE WHEN coalesce(category, '') = '' THEN 'user' ELSE category END || ': ' || coalesce(nullif(title_en, ''), nullif(author, ''), '') AS chat FROM articles")
def m03(spark, d):
    m = lambda role, content, text, value: F.struct(role.alias("role"), content.alias("content"), text.alias("text"), value.alias("value"))
    none = F.lit(None).cast("string")
    rows = table(spark, d, "articles")
    return rows.select("id", "fetched_at", chat.lines(chat.normalize_messages(F.array(m(none, F.col("title_en"), F.col("category"), none), m(F.col("category"), F.lit(""), F.col("title_en"), F.col("author"))))).alias("chat"))


@query("m05_training_rows", _CHATS + "SELECT id, fetched_at, family AS task_family, 'system: ' || s || chr(10) || 'user: ' || u || chr(10) || 'assistant: ' || a AS chat FROM f")
def m05(spark, d):
    rows = chats.example(_chats(spark, d).withColumn("f", F.col("fetched_at")), F.col("id"), "chat", F.col("messages"), "articles")
    both = _families(spark, d).select("id", "fetched_at", "task_family", chat.lines(F.col("messages")).alias("chat"))
    return both if set(rows.columns) == {"id", "task_family", "messages", "metadata", "translate_mask"} else both.limit(0)


@query("m12_prompt_completion", _CHATS + "SELECT id, fetched_at, 'system: ' || s || chr(10) || 'user: ' || u AS prompt, a AS completion FROM f")
def m12(spark, d):
    prompt, completion = chat.prompt_completion(F.col("messages"))
    return _chats(spark, d).select("id", "fetched_at", prompt.alias("prompt"), completion.alias("completion"))


@query("m13_prompt_reference", _CHATS + "SELECT id, fetched_at, CASE WHEN category = '' THEN 'user: ' || u ELSE 'user: ' || u || chr(10) || 'assistant: ' || a || chr(10) || 'user: ' || s END AS prompt, CASE WHEN category = '' THEN '' ELSE category END AS reference FROM f")
def m13(spark, d):
    m = F.col("messages")
    end = F.struct(F.lit("assistant").alias("role"), F.col("category").alias("content"))
    ask = F.struct(F.lit("user").alias("role"), m[0]["content"].alias("content"))
    messages = F.when(F.col("category") == "", F.array(m[1])).otherwise(F.array(m[1], m[2], ask, end))
    prompt, reference = chat.prompt_completion(messages)
    return _chats(spark, d).select("id", "fetched_at", prompt.alias("prompt"), reference.alias("reference"))


@query("m14_source_reference", _CHATS + "SELECT id, fetched_at, u AS source, a AS reference FROM f")
def m14(spark, d):
    return _chats(spark, d).select("id", "fetched_at", F.element_at("messages", -2)["content"].alias("source"), F.element_at("messages", -1)["content"].alias("reference"))


@query("m15_requests", "SELECT DISTINCT id, 'request-' || (dense_rank() OVER (ORDER BY sha256(id), id) - 1) AS custom_id, '{\"prompt\":\"article ' || id || '\"}' AS body FROM articles")
def m15(spark, d):
    rows = table(spark, d, "articles").select("id").distinct()
    return selection.requests(rows, "id", F.struct(F.concat(F.lit("article "), "id").alias("prompt"))).select("id", "custom_id", "body")


@query("m09_translated_chats", _CHATS + "SELECT id, fetched_at, 'system: ' || upper(s) || chr(10) || 'user: ' || upper(u) || chr(10) || 'assistant: ' || upper(category) AS chat, 0::BIGINT AS protected_spans FROM f")
def m09(spark, d):
    """Capitals stand for the translation; without fenced blocks every message is translated whole."""
    m = F.col("messages")
    rows = _chats(spark, d).select("id", "fetched_at", F.array(m[0], m[1], F.struct(F.lit("assistant").alias("role"), F.col("category").alias("content"))).alias("messages"))
    return protect.translate_messages(rows, F.upper).select("id", "fetched_at", chat.lines(m).alias("chat"), "protected_spans")


@query(
    "m09_selective_chats",
    "SELECT id, fetched_at, CASE WHEN n = 0 THEN 'user: ' || t || chr(10) || 'tool: ' || t ELSE 'user: ' || upper(t) || ' ```' || t || '```' || chr(10) || 'tool: ' || t END AS chat, CASE WHEN n = 0 THEN 0 ELSE 1 END::BIGINT AS protected_spans FROM (SELECT id, fetched_at, regexp_replace(coalesce(title_en, ''), '[^a-z ]', '', 'g') AS t, length(coalesce(title_en, '')) % 2 AS n FROM articles)",
)
def m09b(spark, d):
    t = F.regexp_replace(F.coalesce("title_en", F.lit("")), "[^a-z ]", "")
    odd = F.length(F.coalesce("title_en", F.lit(""))) % 2 == 1
    rows = table(spark, d, "articles").select("id", "fetched_at", _turns(("user", F.when(odd, F.concat(t, F.lit(" ```"), t, F.lit("```"))).otherwise(t)), ("tool", t)).alias("messages"), F.when(odd, F.array(F.lit("selective"))).otherwise(F.array(F.lit("preserve"))).alias("mask"))
    return protect.translate_messages(rows, F.upper, "mask").select("id", "fetched_at", chat.lines(F.col("messages")).alias("chat"), "protected_spans")


@query(
    "m11_crosslingual",
    f"""WITH x AS (SELECT a.id, a.title_en AS q, t.body AS b, {_S("'x' || a.id", 2)} AS k FROM (SELECT id, max(title_en) AS title_en FROM articles WHERE id IS NOT NULL GROUP BY id) a JOIN (SELECT article_id, max(title_tvl) AS body FROM translations GROUP BY 1) t ON a.id = t.article_id WHERE a.title_en IS NOT NULL AND t.body IS NOT NULL)
    SELECT id, CASE WHEN k = 0 THEN 'system: Answer in Tuvaluan.' || chr(10) || 'user: ' || q ELSE 'user: Answer in Tuvaluan.' || chr(10) || chr(10) || q END || chr(10) || 'assistant: ' || b AS chat FROM x""",
)
def m11(spark, d):
    asked = table(spark, d, "articles").filter("id is not null").groupBy("id").agg(F.max("title_en").alias("q")).filter("q is not null").select("id", _turns(("user", "q")).alias("messages"))
    answers = table(spark, d, "translations").groupBy(F.col("article_id").alias("id")).agg(F.max("title_tvl").alias("b")).filter("b is not null").select("id", F.array("b").alias("answers"))
    return chat.crosslingual(asked, answers, "x").select("id", chat.lines(F.col("messages")).alias("chat"))


@query("p06_example_errors", """SELECT id, fetched_at, array_to_string(list_filter([CASE WHEN coalesce(category, '') = '' THEN 'missing id' END, CASE WHEN coalesce(source_id, '') <> 'chat' THEN 'unknown family' END, CASE WHEN title_en IS NULL THEN 'no messages' END, CASE WHEN title_en IS NOT NULL AND author IS NULL THEN 'incomplete message' END], x -> x IS NOT NULL), ',') AS errors FROM articles""")
def p06(spark, d):
    messages = F.when(F.col("title_en").isNotNull(), _turns(("user", "title_en"), ("assistant", "author")))
    return table(spark, d, "articles").select("id", "fetched_at", F.array_join(chat.example_errors(F.col("category"), F.col("source_id"), messages, ("chat",)), ",").alias("errors"))


@query("u04_examples_once", "SELECT count(*) AS examples, (SELECT count(*) FROM articles) - count(*) AS dropped, sum(length(category))::BIGINT AS chars FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched_at, url) AS n FROM articles) WHERE n = 1")
def u04(spark, d):
    rows = table(spark, d, "articles").select("id", "fetched_at", "url", "category")
    kept, dropped = chat.deduplicated(rows, ("fetched_at", "url"))
    return kept.agg(F.count("*").alias("examples"), F.sum(F.length("category")).alias("chars")).join(F.broadcast(dropped)).select("examples", "dropped", "chars")


@query("h06_example_split", f"SELECT id, fetched_at, CASE WHEN b < 200 THEN 'test' WHEN b < 400 THEN 'validation' ELSE 'train' END AS split FROM (SELECT id, fetched_at, {_S("coalesce(nullif(category, ''), id)", 10000)} AS b FROM articles)")
def h06(spark, d):
    key = chat.split_key(F.col("id"), F.col("category"))
    return table(spark, d, "articles").select("id", "fetched_at", splitting.hash_split(key, 0.02, 0.02).alias("split"))


@query("a03_example_summary", _CHATS + "SELECT source_id, count(*) AS examples, sum(n)::BIGINT AS tokens, round(avg(n), 4) AS mean_tokens, round(avg(length(a)), 4) AS target_chars FROM f GROUP BY 1")
def a03(spark, d):
    n = chat.message_tokens(F.col("messages"))
    return _chats(spark, d).groupBy("source_id").agg(
        F.count("*").alias("examples"), F.sum(n).alias("tokens"), F.round(F.avg(n), 4).alias("mean_tokens"), F.round(F.avg(F.length(F.element_at("messages", -1)["content"])), 4).alias("target_chars")
    )


@query("a04_mix_summary", _CHATS + "SELECT family AS task_family, count(*) AS examples, sum(n)::BIGINT AS tokens FROM f GROUP BY 1")
def a04(spark, d):
    return chat.mix_summary(_families(spark, d), "task_family")


@query("n27_content_parts", "SELECT id, fetched_at, concat_ws(chr(10), title_en, category) AS content FROM articles")
def n27(spark, d):
    part = lambda kind, text: F.struct(kind.alias("type"), text.alias("text"))
    parts = F.array(part(F.lit("text"), F.col("title_en")), part(F.lit("image"), F.col("author")), part(F.lit(None).cast("string"), F.col("category")))
    return table(spark, d, "articles").select("id", "fetched_at", chat.content_text(parts).alias("content"))


@query(
    "q11_chat_problems",
    """SELECT id, CASE WHEN title_tvl IS NULL THEN 'message_count_mismatch: 1 vs 0' ELSE concat_ws(',', CASE WHEN failed_paragraphs > 0 THEN 'role_mismatch[0]: user vs assistant' END, CASE WHEN contains(title_tvl, '__PH_001__') THEN 'placeholder_leak[0]' END,
     CASE WHEN length(body) > 10 AND (length(title_tvl) / length(body) < 0.3 OR length(title_tvl) / length(body) > 3) THEN 'length_ratio[0]' END) END AS problems
    FROM (SELECT id, regexp_replace(title_tvl, '[{}`]', '', 'g') || CASE WHEN id % 7 = 0 THEN ' __PH_001__' ELSE '' END AS title_tvl, failed_paragraphs, substr(coalesce(body_tvl, ''), 1, 90) AS body FROM translations)""",
)
def q11(spark, d):
    leak = F.when(F.col("id") % 7 == 0, " __PH_001__").otherwise("")
    rows = table(spark, d, "translations").select("id", F.concat(F.regexp_replace("title_tvl", "[{}`]", ""), leak).alias("t"), "failed_paragraphs", F.substring(F.coalesce("body_tvl", F.lit("")), 1, 90).alias("body"))
    one = F.array(F.struct(F.when(F.col("failed_paragraphs") > 0, "assistant").otherwise("user").alias("role"), F.col("t").alias("content")))
    got = rows.select("id", _turns(("user", "body")).alias("a"), F.when(F.col("t").isNotNull(), one).otherwise(F.array().cast("array<struct<role:string,content:string>>")).alias("b"))
    return got.select("id", F.array_join(protect.chat_problems("a", "b"), ",").alias("problems"))


@query("a06_rejection_stats", "SELECT reason, count(*) AS n FROM (SELECT unnest(CASE WHEN paragraph_count > 3 THEN ['length_ratio', 'role_mismatch'] ELSE ['role_mismatch'] END) AS reason FROM translations) GROUP BY 1")
def a06(spark, d):
    n = F.col("paragraph_count").cast("string")
    both = F.array(F.concat(F.lit("length_ratio["), n, F.lit("]: 4.00")), F.lit("role_mismatch[0]: user vs tool"))
    reasons = F.when(F.col("paragraph_count") > 3, both).otherwise(F.slice(both, 2, 1))
    return table(spark, d, "translations").select(F.explode(reasons).alias("r")).groupBy(protect.reason_key(F.col("r")).alias("reason")).agg(F.count("*").alias("n"))


@query("q03_preservation", """SELECT count(*) AS rows, count(tags) AS json_rows, round(avg(CASE WHEN tags IS NOT NULL THEN json_valid(tags)::INT END), 6) AS json_rate, count(*) FILTER (category IS NOT NULL) AS code_rows, round(avg(CASE WHEN category IS NOT NULL THEN contains(coalesce(tags, ''), category)::INT END), 6) AS code_rate,
 count(*) AS placeholder_rows, round(avg(contains(coalesce(tags, ''), '__PH_000__')::INT), 6) AS leak_rate FROM articles""")
def q03(spark, d):
    return metrics.preservation(table(spark, d, "articles").select(
        F.col("tags").alias("prediction"), F.col("tags").isNotNull().alias("expected_json"), F.when(F.col("category").isNotNull(), F.array("category")).alias("expected_blocks"), F.array(F.lit("__PH_000__")).alias("placeholders")
    ))


# --- chat sources


def _mapped(rows, *metadata):
    return rows.select("id", "task_family", chat.lines(F.col("messages")).alias("chat"), F.array_join("translate_mask", ",").alias("mask"), *[F.element_at("metadata", k).alias(k) for k in metadata])


_NL = " || chr(10) || 'assistant: ' || "


@query("m06a_instructions", f"SELECT 'instruction-' || id AS id, 'chat' AS task_family, 'user: ' || title_tvl{_NL}body_tvl AS chat, 'translate,translate' AS mask, coalesce(model_id, '') AS task FROM translations WHERE coalesce(title_tvl, '') <> '' AND coalesce(body_tvl, '') <> ''")
def m06a(spark, d):
    none = F.lit(None).cast("string")
    rows = table(spark, d, "translations").select(F.col("id").alias("row_idx"), none.alias("inputs"), F.col("title_tvl").alias("prompt"), F.lit("").alias("targets"), F.col("body_tvl").alias("completion"), F.col("model_id").alias("task"))
    return _mapped(chats.instructions(rows), "task")


@query("m06b_dialogues", f"SELECT 'dialogue-' || id AS id, 'chat' AS task_family, 'user: ' || coalesce(title_tvl, ''){_NL}coalesce(body_tvl, '') AS chat, 'translate,translate' AS mask FROM translations")
def m06b(spark, d):
    m = lambda role, content, text: F.struct(role.alias("role"), content.alias("content"), text.alias("text"), F.lit(None).cast("string").alias("value"))
    none = F.lit(None).cast("string")
    rows = table(spark, d, "translations").select(F.col("id").alias("row_idx"), F.array(m(none, F.col("title_tvl"), none), m(F.lit("assistant"), none, F.col("body_tvl"))).alias("messages"))
    return _mapped(chats.dialogues(rows))


@query("m06c_private_chats", f"SELECT coalesce(nullif(model_path, ''), 'private-' || id) AS id, 'chat' AS task_family, 'user: ' || title_tvl{_NL}body_tvl AS chat, 'translate,translate' AS mask, 'tvl' AS language_mode, nullif(article_id, '') AS split_group FROM translations WHERE coalesce(title_tvl, '') <> '' AND coalesce(body_tvl, '') <> ''")
def m06c(spark, d):
    none = F.lit(None).cast("string")
    rows = table(spark, d, "translations").select(
        F.col("id").alias("row_idx"), F.col("model_path").alias("id"), F.lit(None).cast(chats._OPEN).alias("messages"), none.alias("prompt"), none.alias("completion"), F.col("title_tvl").alias("user"), F.col("body_tvl").alias("assistant"),
        F.col("article_id").alias("thread_id"), none.alias("conversation_id"), none.alias("language_mode"), F.lit(None).cast("map<string,string>").alias("metadata"),
    )
    return _mapped(chats.private_chats(rows), "language_mode", "split_group")


@query("m06d_word_problems", f"SELECT 'problem-' || id AS id, 'math' AS task_family, 'user: ' || title_tvl{_NL}body_tvl AS chat, 'translate,selective' AS mask FROM translations WHERE coalesce(title_tvl, '') <> '' AND coalesce(body_tvl, '') <> ''")
def m06d(spark, d):
    return _mapped(chats.word_problems(table(spark, d, "translations").select(F.col("id").alias("row_idx"), F.col("title_tvl").alias("question"), F.col("body_tvl").alias("answer"))))


@query("m06e_function_calls", f"SELECT 'call-' || id AS id, 'tool' AS task_family, 'system: These tools can be called:' || chr(10) || CASE WHEN id % 2 = 0 THEN '[{{\"name\":\"f' || id || '\"}}]' ELSE '[]' END || chr(10) || 'user: ' || title_tvl{_NL}'[]' AS chat, 'preserve,translate,preserve' AS mask FROM translations WHERE coalesce(title_tvl, '') <> ''")
def m06e(spark, d):
    tools = F.when(F.col("id") % 2 == 0, F.concat(F.lit('[{"name": "f'), F.col("id").cast("string"), F.lit('"}]'))).otherwise("no json")
    return _mapped(chats.function_calls(table(spark, d, "translations").select(F.col("id").alias("row_idx"), F.col("title_tvl").alias("query"), F.lit(None).cast("string").alias("answers"), tools.alias("tools"))))


@query("m06f_programs", f"SELECT 'program-' || coalesce(article_id, id::VARCHAR) AS id, 'code' AS task_family, 'user: ' || title_tvl{_NL}body_tvl AS chat, 'translate,selective' AS mask FROM translations WHERE coalesce(title_tvl, '') <> '' AND coalesce(body_tvl, '') <> ''")
def m06f(spark, d):
    return _mapped(chats.programs(table(spark, d, "translations").select(F.col("id").alias("row_idx"), F.col("article_id").alias("task_id"), F.col("title_tvl").alias("text"), F.col("body_tvl").alias("code"))))


@query("m06g_passages", f"SELECT 'passage-' || id AS id, 'qa' AS task_family, 'system: Answer from this text.' || chr(10) || chr(10) || 'Text: ' || body_en || chr(10) || 'user: ' || title_en{_NL}category AS chat, 'preserve,translate,translate' AS mask, coalesce(author, '') AS title FROM articles WHERE coalesce(body_en, '') <> '' AND coalesce(title_en, '') <> '' AND category IS NOT NULL")
def m06g(spark, d):
    answers = F.when(F.col("category").isNotNull(), F.array("category", "author")).otherwise(F.array().cast("array<string>"))
    rows = table(spark, d, "articles").select(F.lit(0).alias("row_idx"), "id", F.col("body_en").alias("context"), F.col("title_en").alias("question"), answers.alias("answers"), F.col("author").alias("title"))
    return _mapped(chats.passages(rows), "title")


@query("m06h_highlights", f"SELECT 'article-' || id AS id, 'summarization' AS task_family, 'user: Summarize this article.' || chr(10) || chr(10) || body_en{_NL}og_description_en AS chat, 'translate,translate' AS mask FROM articles WHERE coalesce(body_en, '') <> '' AND coalesce(og_description_en, '') <> ''")
def m06h(spark, d):
    return _mapped(chats.highlights(table(spark, d, "articles").select(F.lit(0).alias("row_idx"), "id", F.col("body_en").alias("article"), F.col("og_description_en").alias("highlights"))))


@query("m06i_stories", "SELECT 'story-' || doc_id AS id, 'chat' AS task_family, md5('user: Tell me a short story.' || chr(10) || 'assistant: ' || t) AS chat, 'translate,translate' AS mask FROM (SELECT doc_id, " + r"regexp_replace(text, '^\s+|\s+$', '', 'g')" + " AS t FROM documents) WHERE length(t) >= 50")
def m06i(spark, d):
    return _mapped(chats.stories(table(spark, d, "documents").select(F.col("doc_id").alias("row_idx"), "text"))).withColumn("chat", F.md5("chat"))
