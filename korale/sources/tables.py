"""Readers and writers: JSON lines, TSV, sitemaps, front matter, upserts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from korale.functions.text import strip


def read_records(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(records, bad lines) of JSON-lines files, with source_file (the file's stem) and source_line (from 1 within each file).

    Blank lines are skipped. Lines are numbered block by block, so a large file
    is neither read nor sorted as one.
    """
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), stem.alias("source_file"), "value", F.monotonically_increasing_id().alias("m"))
    local = F.row_number().over(Window.partitionBy("f", "b").orderBy("m"))
    blocks = rows.groupBy("f", "b").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("f").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = rows.withColumn("r", local).join(blocks.withColumn("o", before).drop("n"), ["f", "b"])
    lines = lines.select("source_file", (F.col("r") + F.col("o")).alias("source_line"), F.col("value").alias("line")).filter(F.trim("line") != "")
    full = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.select("source_file", "source_line", "line", F.from_json("line", full, {"columnNameOfCorruptRecord": "_bad"}).alias("r"))
    wrong = F.col("r").isNull() | F.col("r._bad").isNotNull()
    return parsed.filter(~wrong).select("r.*", "source_file", "source_line").drop("_bad"), parsed.filter(wrong).select("source_file", "source_line", "line")


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Strict JSON lines: a bad line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def write_split(df: DataFrame, path: str, by: str = "split") -> None:
    """One folder per value of `by`."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def read_json(path: str, default=None):
    """A JSON file of the driver, or default where it is missing."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return default


def read_jsonl_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All JSON lines of a folder; no rows where it is missing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.schema(schema).json(path) if where.getFileSystem(conf).exists(where) else spark.createDataFrame([], schema)


def rows_of(spark: SparkSession, sql: str, **args) -> list[dict]:
    """The rows of a parametrised query, as dicts; for small results."""
    return [r.asDict(recursive=True) for r in spark.sql(sql, args=args).collect()]


def one_of(spark: SparkSession, sql: str, **args) -> dict | None:
    """The first row of a parametrised query, or nothing."""
    got = spark.sql(sql, args=args).limit(1).collect()
    return got[0].asDict(recursive=True) if got else None


def database_tables(spark: SparkSession, url: str, names: tuple[str, ...], driver: str = "org.sqlite.JDBC") -> list[str]:
    """Makes tables of a database (any JDBC address) views of the session, so that one SQL text runs over them and over parquet alike."""
    for name in names:
        spark.read.format("jdbc").option("url", url).option("dbtable", name).option("driver", driver).load().createOrReplaceTempView(name)
    return list(names)


def report(df: DataFrame, path: str) -> dict:
    """A one-row aggregate as a JSON file on the driver."""
    row = df.limit(1).collect()
    out = row[0].asDict(recursive=True) if row else {}
    with open(path, "w", encoding="utf-8") as f:
        json.dump(out, f, ensure_ascii=False, indent=2, default=str)
    return out


def read_pairs_tsv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, rejected) of a two-column TSV; the id has the line's hash."""
    rows = spark.read.text(path).filter(F.trim("value") != "").select("value", F.split("value", "\t").alias("c"))
    good = (F.size("c") == 2) & (F.length(F.trim(F.get("c", F.lit(0)))) >= 2) & (F.length(F.trim(F.get("c", F.lit(1)))) >= 2)
    pairs = rows.filter(good).select(F.concat(F.lit("tsv_"), F.substring(F.sha2("value", 256), 1, 16)).alias("id"), strip(F.col("c")[0]).alias("en"), strip(F.col("c")[1]).alias("tvl"))
    return pairs, rows.filter(~good).select("value", F.when(F.size("c") != 2, "bad_columns").otherwise("too_short").alias("reason"))


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """loc and lastmod of the url elements of sitemap XML."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)


def front_matter(text: Column) -> Column:
    """The `key: value` head of a markdown text between --- lines, as a map."""
    head = F.regexp_extract(text, r"(?s)^---\r?\n(.*?)\r?\n---", 1)
    pairs = F.filter(F.split(head, r"\r?\n"), lambda s: s.contains(":"))
    entry = lambda s: F.struct(F.trim(F.substring_index(s, ":", 1)), F.trim(F.regexp_replace(s, r'^[^:]*:\s*"?|"$', "")))
    return F.map_from_entries(F.transform(pairs, entry))


def upsert(old: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """The latest row per key of both tables; of equal ones the new table's."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    w = Window.partitionBy(key).orderBy(F.desc_nulls_last(order), F.desc("_new"))
    return both.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "_new")


def insert_new(old: DataFrame, new: DataFrame, *keys: str) -> DataFrame:
    """The rows of new that old has under none of the keys."""
    for k in keys:
        new = new.join(old.select(k).filter(F.col(k).isNotNull()).distinct(), k, "left_anti")
    return new


def first_table(spark: SparkSession, *names: str) -> str | None:
    """The first of the tables that exists."""
    return next((n for n in names if spark.catalog.tableExists(n)), None)


def file_name(dataset: str) -> str:
    return dataset.replace("/", "__")


def dataset_name(stem: str) -> str:
    return stem.replace("__", "/", 1)


class Loaders:
    """Named loaders of chat sources: functions of (spark, path) that return id, task_family, messages, metadata."""

    def __init__(self) -> None:
        self._of: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    def register(self, name: str) -> Callable:
        def add(f: Callable) -> Callable:
            self._of[name] = f
            return f

        return add

    def load(self, name: str, spark: SparkSession, path: str) -> DataFrame:
        if name not in self._of:
            raise KeyError(f"no loader named {name}")
        return self._of[name](spark, path)

    def names(self) -> list[str]:
        return sorted(self._of)


LOADERS = Loaders()
