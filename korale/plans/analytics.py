"""Registered queries over articles, translations, feedback and events, with their SQL."""

from __future__ import annotations

import re

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.operators import feedback
from korale.session import table
from korale.sources import tables as src

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = re.sub(r", (\w) -> ", r", lambda \1: ", sql)
        return f

    return add


_ART = "WITH art AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC, url) r FROM articles WHERE id IS NOT NULL) WHERE r = 1) "


def articles(spark, d):
    """Each article once, as fetched last."""
    return feedback.latest(table(spark, d, "articles").filter("id is not null"), "id", "fetched_at", "url")


@query("s13_latest_articles", _ART + "SELECT id, source_id, fetched_at, word_count FROM art")
def s13(spark, d):
    return articles(spark, d).select("id", "source_id", "fetched_at", "word_count")


@query(
    "s13_upsert",
    "SELECT id, split, ingested_at FROM (SELECT id, split, ingested_at, row_number() OVER (PARTITION BY id ORDER BY ingested_at DESC NULLS LAST, late DESC) r FROM (SELECT id, split, max(ingested_at) AS ingested_at, (source_file LIKE 'redelivery%')::INT AS late FROM aligned_pairs GROUP BY ALL)) WHERE r = 1",
)
def s13b(spark, d):
    rows = table(spark, d, "aligned_pairs").withColumn("late", F.col("source_file").startswith("redelivery"))
    rows = rows.groupBy("id", "split", "late").agg(F.max("ingested_at").alias("ingested_at"))
    return src.upsert(rows.filter(~F.coalesce("late", F.lit(False))).drop("late"), rows.filter("late").drop("late"), "id", "ingested_at")


@query("s14_insert_new", "SELECT DISTINCT id FROM aligned_pairs WHERE split = 'test' AND id NOT IN (SELECT id FROM aligned_pairs WHERE split = 'train' AND id IS NOT NULL)")
def s14(spark, d):
    rows = table(spark, d, "aligned_pairs").select("id", "split")
    return src.insert_new(rows.filter("split = 'train'"), rows.filter("split = 'test'"), "id").select("id").distinct()


@query("j08_articles_with_translation", _ART + "SELECT a.id, t.id AS translation_id, CASE WHEN t.is_collapsed = 1 THEN NULL ELSE t.title_tvl END AS title_tvl FROM art a LEFT JOIN translations t ON t.article_id = a.id")
def j08(spark, d):
    return feedback.with_translation(articles(spark, d), table(spark, d, "translations")).select("id", "translation_id", "title_tvl")


@query("j09_translated_articles", _ART + "SELECT a.id, t.id AS translation_id FROM art a JOIN translations t ON t.article_id = a.id AND (t.is_collapsed = 0 OR t.is_collapsed IS NULL)")
def j09(spark, d):
    return feedback.translated(articles(spark, d), table(spark, d, "translations")).select("id", "translation_id")


@query("j10_untranslated_articles", _ART + "SELECT a.id FROM art a LEFT JOIN translations t ON t.article_id = a.id WHERE t.id IS NULL")
def j10(spark, d):
    return feedback.untranslated(articles(spark, d), table(spark, d, "translations"))


@query("j11_collapsed_articles", _ART + "SELECT DISTINCT a.id FROM art a JOIN translations t ON t.article_id = a.id WHERE t.is_collapsed = 1")
def j11(spark, d):
    t = table(spark, d, "translations").filter("is_collapsed = 1").select(F.col("article_id").alias("id"))
    return articles(spark, d).select("id").join(t, "id", "left_semi")


@query("a12_categories", _ART + "SELECT category, count(*) AS articles FROM art WHERE category <> '' AND id IN (SELECT article_id FROM translations WHERE is_collapsed = 0 OR is_collapsed IS NULL) GROUP BY 1")
def a12(spark, d):
    live = table(spark, d, "translations").filter("is_collapsed = 0 or is_collapsed is null").select(F.col("article_id").alias("id"))
    return articles(spark, d).filter("category <> ''").join(live, "id", "left_semi").groupBy("category").agg(F.count("*").alias("articles"))


@query("a13_article_count", _ART + "SELECT count(*) AS articles, count(DISTINCT source_id) AS sources FROM art")
def a13(spark, d):
    return articles(spark, d).agg(F.count("*").alias("articles"), F.count_distinct("source_id").alias("sources"))


@query("a17_articles_per_source", _ART + "SELECT source_id, count(*) AS articles, sum(word_count)::BIGINT AS words FROM art GROUP BY 1")
def a17(spark, d):
    return articles(spark, d).groupBy("source_id").agg(F.count("*").alias("articles"), F.sum("word_count").alias("words"))


@query("a23_tags", _ART + "SELECT tag, count(*) AS articles FROM (SELECT id, unnest(list_distinct(from_json(tags, '[\"VARCHAR\"]'))) AS tag FROM art WHERE json_valid(tags)) WHERE tag IS NOT NULL GROUP BY 1")
def a23(spark, d):
    tags = F.explode(F.array_distinct(F.from_json("tags", "array<string>")))
    return articles(spark, d).select("id", tags.alias("tag")).filter("tag is not null").groupBy("tag").agg(F.count("*").alias("articles"))


@query("a24_archive", _ART + "SELECT year(published_at)::INT AS year, count(*) AS articles, min(published_at) AS first, max(published_at) AS last FROM art WHERE published_at IS NOT NULL GROUP BY 1")
def a24(spark, d):
    return articles(spark, d).filter("published_at is not null").groupBy(F.year("published_at").alias("year")).agg(F.count("*").alias("articles"), F.min("published_at").alias("first"), F.max("published_at").alias("last"))


@query("w01_latest_page", _ART + "SELECT id, published_at FROM art ORDER BY published_at DESC NULLS LAST, id LIMIT 20 OFFSET 20")
def w01(spark, d):
    return articles(spark, d).select("id", "published_at").orderBy(F.desc_nulls_last("published_at"), "id").offset(20).limit(20)


@query("w07_neighbours", _ART + "SELECT id, lag(id) OVER w AS newer, lead(id) OVER w AS older FROM art WHERE published_at IS NOT NULL WINDOW w AS (PARTITION BY source_id ORDER BY published_at DESC, id)")
def w07(spark, d):
    w = Window.partitionBy("source_id").orderBy(F.desc("published_at"), "id")
    return articles(spark, d).filter("published_at is not null").select("id", F.lag("id").over(w).alias("newer"), F.lead("id").over(w).alias("older"))


@query("p27_search", _ART + "SELECT a.id, t.id AS translation_id FROM art a JOIN translations t ON t.article_id = a.id AND (t.is_collapsed = 0 OR t.is_collapsed IS NULL) WHERE a.title_en ILIKE '%coach%' OR t.title_tvl ILIKE '%coach%' OR a.body_en ILIKE '%coach%' OR t.body_tvl ILIKE '%coach%' ORDER BY a.published_at DESC NULLS LAST, a.id, t.id LIMIT 30")
def p27(spark, d):
    return feedback.search(articles(spark, d), table(spark, d, "translations"), "coach", 30).select("id", "translation_id")


# --- feedback


_FB = "WITH fb AS (SELECT * REPLACE (lower(trim(feedback_type)) AS feedback_type) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY received_at DESC) r FROM feedback) WHERE r = 1) "


@query("x01_events", _FB + """, e AS (SELECT fb.*, a.body_en, a.id AS aid FROM fb LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY fetched_at DESC, url) rr FROM articles) WHERE rr = 1) a ON a.id = fb.article_id)
 SELECT id, 'paragraph_feedback' AS event_type, CASE WHEN feedback_type = 'thumbs_up' THEN 1 ELSE 0 END AS score, paragraph_idx, article_id, aid IS NOT NULL AS known FROM e""")
def x01(spark, d):
    return feedback.events(feedback.deliveries(table(spark, d, "feedback")), articles(spark, d)).select("id", "event_type", "score", "paragraph_idx", "article_id", "known")


@query("x01_event_paragraphs")
def x01b(spark, d):
    return feedback.events(feedback.deliveries(table(spark, d, "feedback")), articles(spark, d)).select("id", "paragraph_en")


@query("x06_event_counts", _FB + "SELECT feedback_type, count(*) AS n, count(DISTINCT session_id) AS sessions FROM fb GROUP BY 1")
def x06(spark, d):
    return feedback.deliveries(table(spark, d, "feedback")).groupBy("feedback_type").agg(F.count("*").alias("n"), F.count_distinct("session_id").alias("sessions"))


@query("x07_island_backfill", _FB + ", s AS (SELECT session_id, min(trim(island)) AS known FROM fb WHERE trim(island) <> '' GROUP BY 1) SELECT id, coalesce(nullif(trim(island), ''), known) AS island FROM fb LEFT JOIN s USING (session_id)")
def x07(spark, d):
    return feedback.backfill(feedback.deliveries(table(spark, d, "feedback"))).select("id", "island")


@query("a14_month_by_island", _FB + "SELECT date_trunc('month', created_at)::TIMESTAMP AS month, coalesce(nullif(trim(island), ''), 'unknown') AS island, count(*) AS n, count(*) FILTER (feedback_type = 'thumbs_up') AS up, count(*) FILTER (feedback_type = 'thumbs_down') AS down FROM fb WHERE created_at IS NOT NULL GROUP BY ALL")
def a14(spark, d):
    return feedback.monthly(feedback.deliveries(table(spark, d, "feedback")))


@query("a16_month_total", _FB + "SELECT count(*) AS n FROM fb WHERE created_at >= TIMESTAMP '2024-01-01' AND created_at < TIMESTAMP '2024-02-01'")
def a16(spark, d):
    return feedback.deliveries(table(spark, d, "feedback")).filter("created_at >= timestamp_ntz'2024-01-01' and created_at < timestamp_ntz'2024-02-01'").agg(F.count("*").alias("n"))


@query("a19_pivot_feedback", _FB + "SELECT article_id, count(*) FILTER (feedback_type = 'thumbs_up') AS thumbs_up, count(*) FILTER (feedback_type = 'thumbs_down') AS thumbs_down FROM fb WHERE article_id IS NOT NULL GROUP BY 1")
def a19(spark, d):
    rows = feedback.deliveries(table(spark, d, "feedback")).filter("article_id is not null")
    return rows.groupBy("article_id").pivot("feedback_type", ["thumbs_up", "thumbs_down"]).count().fillna(0)


@query("p26_valid_feedback", _FB + "SELECT valid, count(*) AS n FROM (SELECT coalesce(article_id <> '', false) AND coalesce(paragraph_idx >= 0, false) AND coalesce(feedback_type IN ('thumbs_up', 'thumbs_down'), false) AS valid FROM fb) GROUP BY 1")
def p26(spark, d):
    return feedback.deliveries(table(spark, d, "feedback")).groupBy(feedback.is_valid().alias("valid")).agg(F.count("*").alias("n"))


# --- metric logs, with events as the log


@query("w02_latest_metric", "SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) r FROM events) WHERE r = 1")
def w02(spark, d):
    rows = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))
    return rows.select("user_id", "event_type", "value")


@query("w04_last_segment", "WITH s AS (SELECT *, sum((event_type = 'login' OR event_type = 'signup')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seg FROM events) SELECT user_id, count(*) AS events, round(sum(value), 4) AS value FROM s WHERE seg = (SELECT max(seg) FROM s AS t WHERE t.user_id = s.user_id) GROUP BY 1")
def w04(spark, d):
    reset = F.col("event_type").isin("login", "signup")
    rows = feedback.last_segment(table(spark, d, "events"), "user_id", ("ts", "event_id"), reset)
    return rows.groupBy("user_id").agg(F.count("*").alias("events"), F.round(F.sum("value"), 4).alias("value"))


@query("w05_trend", "SELECT event_id, round(100 * (value - lag(value, 19) OVER w) / nullif(lag(value, 19) OVER w, 0), 4) AS delta FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)")
def w05(spark, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    before = F.lag("value", 19).over(w)
    return table(spark, d, "events").select("event_id", F.round(100 * (F.col("value") - before) / F.nullif(before, F.lit(0.0)), 4).alias("delta"))


@query("h18_stride_downsample", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) r, count(*) OVER (PARTITION BY user_id) n FROM events) WHERE r % 5 = 1 OR r = n")
def h18(spark, d):
    return feedback.downsample(table(spark, d, "events"), "user_id", ("ts", "event_id"), 5).select("event_id")


@query("a18_leaderboard", "SELECT user_id, round(avg(v), 6) AS score FROM (SELECT user_id, event_type, avg(value) v FROM events GROUP BY ALL) GROUP BY 1")
def a18(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.avg("value").alias("v")).groupBy("user_id").agg(F.round(F.avg("v"), 6).alias("score"))


# --- relational parity


@query("tpch_q1", "SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL")
def q1(spark, d):
    rows = table(spark, d, "lineitem").filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"),
    )


@query("tpch_revenue_by_nation", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1")
def nation(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    # summed per order before the join with customers, so that this join moves one row per order
    per_order = lines.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("r"))
    rows = per_order.join(orders, "l_orderkey").join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    rows = rows.join(table(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    return rows.groupBy("n_name").agg(F.round(F.sum("r"), 2).alias("revenue"))
