"""Articles, translations and reader feedback: joins, search, normalised events, log windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions.text import paragraphs


def latest(rows: DataFrame, key: str, order: str, tie: str) -> DataFrame:
    """The last row of each key."""
    w = Window.partitionBy(key).orderBy(F.desc_nulls_first(order), F.asc_nulls_last(tie))
    return rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def with_translation(articles: DataFrame, translations: DataFrame) -> DataFrame:
    """Every article with its translations; the texts of collapsed ones are null."""
    hide = lambda c: F.when(F.coalesce(F.col("is_collapsed") != 1, F.lit(True)), F.col(c)).alias(c)
    t = translations.select(F.col("article_id").alias("id"), F.col("id").alias("translation_id"), hide("title_tvl"), hide("body_tvl"))
    return articles.join(t, "id", "left")


def translated(articles: DataFrame, translations: DataFrame) -> DataFrame:
    """Articles joined with their translations that aren't collapsed."""
    t = translations.filter("is_collapsed = 0 or is_collapsed is null").select(F.col("article_id").alias("id"), F.col("id").alias("translation_id"), "title_tvl", "body_tvl")
    return articles.join(t, "id")


def untranslated(articles: DataFrame, translations: DataFrame) -> DataFrame:
    return articles.select("id").join(translations.select(F.col("article_id").alias("id")), "id", "left_anti")


def search(articles: DataFrame, translations: DataFrame, text: str, limit: int) -> DataFrame:
    """Translated articles with text in a title or body of either language, newest first; texts of less than two characters find nothing."""
    term = text.strip()[:200]
    pattern = "%" + term.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
    hit = F.lit(False)
    for c in ("title_en", "title_tvl", "body_en", "body_tvl"):
        hit = hit | F.coalesce(F.col(c).ilike(pattern), F.lit(False))
    rows = translated(articles, translations).filter(hit if len(term) >= 2 else F.lit(False))
    return rows.orderBy(F.desc_nulls_last("published_at"), "id", "translation_id").limit(limit)


def deliveries(rows: DataFrame) -> DataFrame:
    """Each feedback row once, as received last, with its type in lower case."""
    once = rows.withColumn("_r", F.row_number().over(Window.partitionBy("id").orderBy(F.desc_nulls_first("received_at")))).filter("_r = 1").drop("_r")
    return once.withColumn("feedback_type", F.lower(F.trim("feedback_type")))


def is_valid() -> Column:
    ok = (F.col("article_id") != "", F.col("paragraph_idx") >= 0, F.col("feedback_type").isin("thumbs_up", "thumbs_down"))
    out = F.lit(True)
    for c in ok:
        out = out & F.coalesce(c, F.lit(False))
    return out


def events(rows: DataFrame, articles: DataFrame) -> DataFrame:
    """Feedback as normalised preference events, with the paragraph it is about (by 0-based index; null out of range)."""
    context = articles.select(F.col("id").alias("article_id"), F.lit(True).alias("known"), paragraphs(F.col("body_en")).alias("_p"))
    joined = rows.join(context, "article_id", "left")
    return joined.select(
        "id", F.lit("paragraph_feedback").alias("event_type"), F.lit("binary_preference").alias("training_signal_type"), "article_id", "paragraph_idx", "created_at",
        F.when(F.col("feedback_type") == "thumbs_up", 1).otherwise(0).alias("score"), F.coalesce("known", F.lit(False)).alias("known"),
        F.when(F.col("paragraph_idx") >= 0, F.get("_p", F.col("paragraph_idx"))).alias("paragraph_en"),
        F.struct("session_id", "island").alias("context"),
    )


def backfill(rows: DataFrame) -> DataFrame:
    """Blank islands filled from other rows of the session."""
    given = F.when(F.trim("island") != "", F.trim("island"))
    known = rows.groupBy("session_id").agg(F.min(given).alias("_k")).filter("session_id is not null and _k is not null")
    return rows.join(known, "session_id", "left").withColumn("island", F.coalesce(given, "_k")).drop("_k")


def monthly(rows: DataFrame) -> DataFrame:
    """Feedback per month and island."""
    island = F.coalesce(F.when(F.trim("island") != "", F.trim("island")), F.lit("unknown"))
    month = F.date_trunc("month", F.col("created_at")).cast("timestamp_ntz")
    return rows.filter("created_at is not null").groupBy(month.alias("month"), island.alias("island")).agg(
        F.count("*").alias("n"), F.count_if(F.col("feedback_type") == "thumbs_up").alias("up"), F.count_if(F.col("feedback_type") == "thumbs_down").alias("down")
    )


def last_segment(rows: DataFrame, key: str, order: tuple[str, ...], reset: Column) -> DataFrame:
    """Per key the rows from the last reset on."""
    w = Window.partitionBy(key).orderBy(*order)
    rows = rows.withColumn("_s", F.sum(F.coalesce(reset, F.lit(False)).cast("int")).over(w))
    return rows.withColumn("_m", F.max("_s").over(Window.partitionBy(key))).filter("_s = _m").drop("_s", "_m")


def downsample(rows: DataFrame, key: str, order: tuple[str, ...], stride: int) -> DataFrame:
    """Every stride-th row of each key, from the first on, and the last."""
    w = Window.partitionBy(key).orderBy(*order)
    n = F.count("*").over(Window.partitionBy(key))
    rows = rows.withColumn("_r", F.row_number().over(w)).withColumn("_n", n)
    return rows.filter((F.col("_r") % stride == 1) | (F.col("_r") == F.col("_n"))).drop("_r", "_n")


def article_events(rows: DataFrame) -> DataFrame:
    """Article-level feedback with optional columns (helpful, rating, mode, correction, comment) as events; a text for helpful counts by its meaning, and null stays null."""
    have = set(rows.columns)
    first = lambda *names: F.coalesce(*[F.col(n).cast("string") for n in names if n in have], F.lit(None).cast("string"))
    stated = F.lower(F.trim(first("helpful", "rating", "score")))
    score = F.coalesce(stated.try_cast("double"), F.when(stated.isin("true", "yes", "y", "helpful"), 1.0).when(stated.isin("false", "no", "n", "unhelpful"), 0.0))
    return rows.select("id", F.lit("article_feedback").alias("event_type"), "article_id", score.alias("score"), (score > 0).alias("helpful"), first("correction", "correction_text").alias("correction"), first("mode").alias("mode"))


def with_corrections(events_: DataFrame) -> DataFrame:
    """The events, and one more for each that has a correction."""
    extra = events_.filter(F.trim("correction") != "").withColumns({"event_type": F.lit("correction"), "score": F.lit(None).cast("double"), "helpful": F.lit(None).cast("boolean")})
    return events_.unionByName(extra)


def votes(rows: DataFrame, prompts: DataFrame) -> DataFrame:
    """Poll votes with their prompt; options that are no JSON list are kept as one raw option."""
    parsed = F.from_json("options_json", "array<string>")
    options = F.when(F.col("options_json").isNull(), F.array().cast("array<string>")).otherwise(F.coalesce(parsed, F.array("options_json")))
    return rows.join(prompts.select("prompt_id", "question", options.alias("options")), "prompt_id", "left")


def _event(rows: DataFrame, prefix: str, event: str, signal: str, output: str, label: Column, paragraph: Column, score: Column | None = None, options: Column | None = None) -> DataFrame:
    return rows.select(
        F.concat(F.lit(f"{prefix}:"), F.col("id").cast("string")).alias("id"), F.lit(output).alias("output"), F.lit(event).alias("event_type"), F.lit(signal).alias("training_signal_type"),
        "article_id", paragraph.cast("int").alias("paragraph_idx"), "created_at", label.alias("label"), (score if score is not None else F.lit(None)).cast("double").alias("score"),
        (options if options is not None else F.lit(None)).cast("array<string>").alias("options"), F.struct("session_id", "island").alias("user"),
    )


def export(rows: DataFrame, forms: DataFrame, signals: DataFrame | None, polls: DataFrame) -> DataFrame:
    """All interactions as one table of events in four outputs: explicit_feedback, corrections, implicit_signals (none, if signals is None) and poll_votes.

    rows: votes on paragraphs; forms: feedback on articles, which gives a second
    event where it has a correction; signals and polls as their names say.
    write_events() writes a folder per output.
    """
    c = F.col
    stated = F.lower(F.trim(c("helpful").cast("string")))
    helpful = F.coalesce(stated.try_cast("double"), F.when(stated.isin("true", "yes", "helpful"), 1.0).when(stated.isNotNull(), 0.0))
    corrected = forms.filter(F.trim(F.coalesce("correction_text", F.lit(""))) != "")
    parsed = F.coalesce(F.from_json("options_json", "array<string>"), F.when(c("options_json").isNotNull(), F.array("options_json")))
    out = _event(rows, "feedback", "paragraph_feedback", "binary_preference", "explicit_feedback", c("feedback_type"), c("paragraph_idx"), F.when(c("feedback_type") == "thumbs_up", 1).otherwise(0))
    out = out.unionByName(_event(forms, "article_feedback", "article_feedback", "article_preference", "explicit_feedback", c("correction_text"), c("correction_paragraph_idx"), helpful))
    out = out.unionByName(_event(corrected, "correction:article_feedback", "correction_suggestion", "freeform_correction", "corrections", c("correction_text"), c("correction_paragraph_idx")))
    if signals is not None:
        out = out.unionByName(_event(signals, "implicit", "implicit_signal", "engagement_signal", "implicit_signals", c("signal_type"), c("paragraph_index")))
    return out.unionByName(_event(polls, "poll_votes", "poll_vote", "community_preference", "poll_votes", c("vote"), F.lit(None), None, parsed))


def write_events(events_: DataFrame, path: str) -> dict[str, int]:
    """A folder of JSON lines per output, and the number of events in each."""
    events_.write.mode("overwrite").partitionBy("output").json(path)
    counts = {r.output: r["count"] for r in events_.groupBy("output").count().collect()}
    return {o: counts.get(o, 0) for o in ("explicit_feedback", "corrections", "implicit_signals", "poll_votes")}


def featured_first(rows: DataFrame, featured: str, date: str, ties: tuple[str, ...], limit: int) -> DataFrame:
    """The first rows: featured ones, then the latest (a list of that length is the feature)."""
    return rows.orderBy(F.desc(featured), F.desc_nulls_last(date), *ties).limit(limit)


def filtered(rows: DataFrame, equal: dict[str, object], order: tuple[str, ...], limit: int) -> DataFrame:
    """The first rows, in an order, whose columns have the values that are given; values of None don't count."""
    for name, value in equal.items():
        rows = rows if value is None else rows.filter(F.col(name) == F.lit(value))
    return rows.orderBy(*order).limit(limit)


def configuration(rows: DataFrame, schema: str) -> DataFrame:
    """key and its parsed value_json; null where it can't be parsed."""
    return rows.select("key", F.from_json("value_json", schema).alias("value"))


def progress(step: Column, total: Column, seconds: int = 5) -> tuple[Column, Column]:
    """(per cent done, to a tenth; seconds left)."""
    return F.round(F.lit(100.0) * step / total, 1), (total - step) * seconds


def totals(rows: DataFrame, since: str) -> DataFrame:
    """Feedback since a day, in all, with an island, and by answer in any case."""
    kind = F.lower("feedback_type")
    return rows.agg(
        F.count_if(F.col("created_at") >= F.lit(since).cast("timestamp_ntz")).alias("recent"), F.count("*").alias("total"), F.count_if(F.trim(F.coalesce("island", F.lit(""))) != "").alias("with_island"),
        F.count_if(kind == "thumbs_up").alias("yes"), F.count_if(kind == "thumbs_down").alias("no"),
    )


def by_model(rows: DataFrame, run: str, model: str, result: str, order: str) -> DataFrame:
    """Per run a map from each model to its last result, and the model of the last one."""
    last = rows.groupBy(run, model).agg(F.max_by(result, order).alias("_v"), F.max(order).alias("_o"))
    return last.groupBy(run).agg(F.map_from_entries(F.collect_list(F.struct(model, "_v"))).alias("models"), F.max_by(model, "_o").alias("last_model"))


def with_baseline(counts: DataFrame, baseline: DataFrame, key: str, n: str) -> DataFrame:
    """Counts and those of an optional baseline table, added up by key."""
    return counts.select(key, n).unionByName(baseline.select(key, n)).groupBy(key).agg(F.sum(n).alias(n))
