"""Incremental ingest: appended logs and redelivered rows, as Structured Streaming."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window


def metric_kind(entry: str = "value_json") -> F.Column:
    """The kind of a metric row by its keys: gen_eval before val_nll before train_nll."""
    has = lambda k: F.get_json_object(F.col(entry), f"$.{k}").isNotNull()
    return F.when(has("gen_eval"), "gen_eval").when(has("val_nll"), "val_nll").when(has("train_nll"), "train_nll")


def tail_json(spark: SparkSession, folder: str, schema: T.StructType, per_trigger: int = 100) -> DataFrame:
    """A stream of the JSON lines that appear in folder; incomplete lines become null rows and are dropped."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).option("mode", "PERMISSIVE").json(folder)
    return rows.dropna(how="all")


def tail_parquet(spark: SparkSession, folder: str, schema: T.StructType, per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def upsert_sink(stream: DataFrame, path: str, key: str, order: str, checkpoint: str) -> StreamingQuery:
    """Keeps at path the latest row per key; each batch writes a new version and then moves the pointer, so a repeated batch is harmless."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        old_version = current(path, number)
        rows = batch
        if old_version is not None:
            rows = spark.read.schema(batch.schema).parquet(f"{path}/v{old_version}").unionByName(batch)
        w = Window.partitionBy(key).orderBy(F.desc_nulls_last(order))
        rows.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r").write.mode("overwrite").parquet(f"{path}/v{number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(path: str, before: int | None = None) -> int | None:
    """The newest complete version at path (older than `before`)."""
    if not os.path.isdir(path):
        return None
    done = [int(d[1:]) for d in os.listdir(path) if d[0] == "v" and os.path.exists(f"{path}/{d}/_SUCCESS")]
    done = [v for v in done if before is None or v < before]
    return max(done, default=None)


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """Events and their sum of value per window and kind, with a watermark. An extension: the batch system has no event-time windows."""
    return (
        events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("events"), F.sum("value").alias("value"))
        .select(F.col("window.start").alias("window_start"), by, "events", F.round("value", 4).alias("value"))
    )


def distinct_deliveries(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """Rows of a stream without redeliveries of the same key within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def run_to_end(stream: DataFrame, name: str, mode: str, checkpoint: str) -> DataFrame:
    """A stream drained into an in-memory table (tests and small reports)."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)


def for_each_batch(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
