"""Tasks grounded in documents: prompts by family and origin, answers taken from the text, mirrors, evaluation items and arms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korale.functions.text import drop_blank_lines, sentences, squeeze
from korale.operators.documents import facts, headline, lead, named, numbers, quote, summary
from korale.operators.postprocess import distinct_tasks

ORIGINS = ("native", "english", "mixed", "plain")
ASK = {  # what each family is asked for, in its own words
    "headline_generation": "Write a headline for this text.", "summary_short": "Sum this text up in a sentence.", "summary_medium": "Sum this text up in three sentences.",
    "fact_bullets": "List the facts of this text.", "lead": "How does this text begin?", "quote": "What is quoted in this text?",
    "entity_extraction": "List the names in this text.", "number_extraction": "List the numbers in this text.", "continuation": "Go on with this text.",
}
FRAME = {"native": "Fakamolemole. {ask}\n\n{title}", "english": "{ask}\n\n{title}", "mixed": "{ask} Tali i te Tuvaluan.\n\n{title}", "plain": "{title}\n\n{ask}"}
ARMS = {"native_only": ("native",), "native_plus_english": ("native", "english"), "with_mixed": ("native", "english", "mixed"), "all": ORIGINS}
DEFAULT_ARM = "native_plus_english"
LEAST_PROMPT = 12


def _listed(values: Column, most: int) -> Column:
    return F.array_join(F.transform(F.slice(values, 1, most), lambda v: F.concat(F.lit("- "), v)), "\n")


def answers(text: Column) -> dict[str, Column]:
    """The answer of each family, from the text alone; blank where the text has none."""
    every = sentences(drop_blank_lines(text))
    out = {
        "headline_generation": headline(text), "summary_short": summary(text, 1), "summary_medium": summary(text, 3), "fact_bullets": _listed(facts(text), 5), "lead": lead(text), "quote": quote(text),
        "entity_extraction": _listed(named(text), 12), "number_extraction": _listed(numbers(text), 12), "continuation": F.array_join(F.slice(every, 2, 2), " "),
    }
    return {k: F.trim(F.coalesce(v, F.lit(""))) for k, v in out.items()}


def prompt(family: Column, origin: Column, title: Column) -> Column:
    """The prompt of a family and an origin, from the two tables above."""
    pick = lambda table, key: F.element_at(F.create_map(*[F.lit(x) for p in table.items() for x in p]), key)
    return F.replace(F.replace(pick(FRAME, origin), F.lit("{ask}"), pick(ASK, family)), F.lit("{title}"), F.coalesce(title, F.lit("")))


def grounded(bundles: DataFrame, families: tuple[str, ...] = tuple(ASK), origins: tuple[str, ...] = ORIGINS) -> DataFrame:
    """id, doc_id, family, origin, prompt, answer: the tasks of documents (doc_id, title, text), those with an answer. Each text is worked through once; null texts give none."""
    told = answers(F.col("text"))
    each = bundles.select("doc_id", "title", F.explode(F.array(*[F.struct(F.lit(f).alias("family"), told[f].alias("answer")) for f in families])).alias("t"))
    each = each.select("doc_id", "title", "t.*").filter("answer != ''").withColumn("origin", F.explode(F.array(*map(F.lit, origins))))
    rows = each.withColumn("prompt", prompt(F.col("family"), F.col("origin"), F.col("title")))
    return rows.select(F.concat_ws("::", F.col("doc_id").cast("string"), "family", "origin").alias("id"), "doc_id", "family", "origin", "prompt", "answer")


def renamed(tasks: DataFrame, families: tuple[str, ...], prefix: str) -> DataFrame:
    """The tasks of some families under ids of their own."""
    return tasks.filter(F.col("family").isin(*families)).withColumn("id", F.concat(F.lit(f"{prefix}::"), "id"))


def mirrors(tasks: DataFrame) -> DataFrame:
    """Each task under the other origins' prompts, once per document, family and prompt."""
    rows = tasks.withColumn("other", F.explode(F.array(*map(F.lit, ORIGINS)))).filter("other != origin")
    rows = rows.withColumns({"prompt": prompt(F.col("family"), F.col("other"), F.substring_index("prompt", "\n\n", -1)), "id": F.concat_ws("::", "id", "other")})
    return distinct_tasks(rows.drop("origin").withColumnRenamed("other", "origin"), ("doc_id", "family", "prompt"), ("id",), LEAST_PROMPT)


def evaluation_items(tasks: DataFrame, held: DataFrame, families: tuple[str, ...], origin: str = "native") -> DataFrame:
    """The tasks of held-out documents in some families and one origin."""
    return tasks.filter(F.col("family").isin(*families) & (F.col("origin") == origin)).join(held.select("doc_id"), "doc_id", "left_semi")


def arms(tasks: DataFrame) -> DataFrame:
    """Each task once per arm that takes its origin; is_default marks the default arm."""
    of = F.array_compact(F.array(*[F.when(F.col("origin").isin(*origins), F.lit(a)) for a, origins in ARMS.items()]))
    return tasks.withColumn("arm", F.explode(of)).withColumn("is_default", F.col("arm") == DEFAULT_ARM)


def manifest(sources: DataFrame, profile: dict[str, Column]) -> DataFrame:
    """Per source (source_path, segments) its profile and whether it is ready: sources without segments are candidates, lexical and nature ones support others."""
    rows = sources.select("source_path", "segments", *[c.alias(n) for n, c in profile.items()])
    status = F.when(F.col("segments") == 0, "candidate_only").when(F.col("family").isin("lexical", "nature"), "support_only").otherwise("ready")
    return rows.withColumn("ingest_status", status)


def overlap_report(rows: DataFrame, document: str, part: str) -> DataFrame:
    """How many documents each pair of parts has in common."""
    each = rows.select(F.col(document).alias("d"), F.col(part).alias("p")).filter("d is not null and p is not null").distinct()
    sets = each.groupBy("d").agg(F.array_sort(F.collect_set("p")).alias("ps")).filter(F.size("ps") > 1)  # parts are few
    pairs = F.flatten(F.transform("ps", lambda a: F.transform(F.filter("ps", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return sets.select(F.inline(pairs)).groupBy("a", "b").agg(F.count("*").alias("documents"))


def segment_rows(rows: DataFrame, method: str, flags: dict[str, Column], least: int = 1) -> DataFrame:
    """Rows (source_path, page, text) in the shape of extracted segments: an id by path, page and text, the text squeezed, and the flags that hold; texts under `least` characters are left out."""
    text = squeeze(F.coalesce("text", F.lit("")))
    key = F.substring(F.sha2(F.concat_ws("\x01", "source_path", F.col("page").cast("string"), text), 256), 1, 16)
    held = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()])) if flags else F.array().cast("array<string>")
    return rows.filter(F.length(text) >= least).select(key.alias("segment_id"), "source_path", F.col("page").cast("string").alias("page_or_image"), text.alias("text"), F.lit(method).alias("extraction_method"), held.alias("confidence_flags"))
