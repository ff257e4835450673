"""Scores of predictions: preservation of names and numbers, style, support, and comparisons of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korale.functions.text import drop_blank_lines
from korale.operators.documents import guess_language, named, numbers
from korale.operators.metrics import token_overlap

SCORES = ("adequacy", "in_language", "entities", "style", "support")


def preserved(prediction: Column, reference: Column) -> Column:
    """The share of the reference's names and numbers that the prediction has; 1 where it has none."""
    required = F.array_distinct(F.concat(named(reference), numbers(reference)))
    text = drop_blank_lines(F.coalesce(prediction, F.lit("")))
    kept = F.size(F.filter(required, lambda x: text.contains(x)))
    return F.when(F.coalesce(F.size(required), F.lit(0)) <= 0, 1.0).otherwise(kept / F.size(required))


def style(family: Column, prediction: Column) -> Column:
    """A rough mark for the form: short headlines, listed entities, summaries of four sentences at most; 0 for nothing."""
    text = drop_blank_lines(F.coalesce(prediction, F.lit("")))
    n = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    stops = F.length(F.regexp_replace(text, "[^.!?]", ""))
    return (
        F.when(text == "", 0.0).when(family == "headline_generation", F.when(n <= 16, 1.0).otherwise(0.3))
        .when(family == "entity_extraction", F.when(text.contains("\n") | F.startswith(text, F.lit("-")), 1.0).otherwise(0.4))
        .when(family.isin("summary_short", "summary_medium"), F.when(stops <= 4, 1.0).otherwise(0.5)).otherwise(0.8)
    )


def scores(rows: DataFrame) -> DataFrame:
    """rows (prediction, reference, source, family, path) with the five SCORES; English is expected of translations to English and explanations in it."""
    wanted = F.when(F.col("family").isin("translation_to_english", "explain_in_english"), "en").otherwise("tvl")
    told = guess_language(F.coalesce("prediction", F.lit("")), F.coalesce("path", F.lit("")))
    right = (told == wanted) | ((wanted == "tvl") & (told == "mixed"))
    support = F.when(F.coalesce("source", F.lit("")) != "", F.col("source")).otherwise(F.col("reference"))
    return rows.withColumns({
        "adequacy": token_overlap(F.col("reference"), F.col("prediction")), "in_language": right.cast("double"), "entities": preserved(F.col("prediction"), F.col("reference")),
        "style": style(F.col("family"), F.col("prediction")), "support": token_overlap(F.col("prediction"), support),
    })


def means(scored: DataFrame, by: str) -> DataFrame:
    """Rows and mean scores, over all rows (slice null) and by slice."""
    aggs = [F.count("*").alias("rows"), *[F.round(F.avg(c), 6).alias(c) for c in SCORES]]
    return scored.groupBy(F.col(by).alias("slice")).agg(*aggs).unionByName(scored.agg(*aggs).withColumn("slice", F.lit("all")))


def differences(metrics: DataFrame, model: str, base: str, keys: tuple[str, ...]) -> DataFrame:
    """metrics (model, keys, metric, value): by how much a model differs from a base; only what both have."""
    pick = lambda m, name: metrics.filter(F.col("model") == m).select(*keys, "metric", F.col("value").alias(name))
    return pick(model, "_a").join(pick(base, "_b"), [*keys, "metric"]).select(*keys, "metric", F.round(F.col("_a") - F.col("_b"), 6).alias("delta"))


def mean_of_batches(rows: DataFrame, order: Column, loss: str, size: int) -> DataFrame:
    """The mean of the batches' means: the last batch, if it is smaller, weighs as much as the others."""
    return rows.groupBy(F.floor(order / size).alias("batch")).agg(F.avg(loss).alias("m")).agg(F.round(F.avg("m"), 6).alias("loss"), F.count("*").alias("batches"))
