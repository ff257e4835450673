"""Sessions, tables and shared folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = 8, partitions: int | None = None, name: str = "korale") -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet tables in sf_dir."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir of the session.

    Where the setting is missing (tests on local masters) a temporary folder is
    taken and kept for the life of the process; on a cluster that is an error.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
    global _LOCAL
    if _LOCAL is None:
        _LOCAL = tempfile.mkdtemp(prefix="korale-")
    return _LOCAL


_LOCAL: str | None = None


def stored(df: DataFrame, label: str, partitions: int | None = None) -> DataFrame:
    """df written once to the shared folder and read again.

    This cuts the lineage and survives lost executors, and several consumers
    read the columns they need instead of computing df again.
    """
    spark = df.sparkSession
    path = os.path.join(shared_dir(spark), "korale", f"{label}-{uuid.uuid4().hex}")
    _STORED.append(path)
    (df.coalesce(partitions) if partitions else df).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_STORED: list[str] = []


def discard(df: DataFrame) -> None:
    """Deletes a table that stored() has returned, once no query reads it any more."""
    names = {os.path.basename(os.path.dirname(f)) for f in df.inputFiles()}
    for path in [p for p in _STORED if os.path.basename(p) in names]:
        _delete(df.sparkSession, path)
        _STORED.remove(path)


def clear_stored(spark: SparkSession) -> None:
    """Deletes the tables that stored() has written in this process; for use when no query that reads them is left to run."""
    while _STORED:
        _delete(spark, _STORED.pop())


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About `rows` rows of df, at least where it has so many, chosen by a hash of their keys; all rows of a smaller table.

    The threshold follows from the number of rows, so each task hands on its
    share only: nothing is sorted, and no task gathers the sample. The same
    rows are chosen at every run, however the table is split. The number holds
    for keys that are (nearly) unique.
    """
    total = df.count()
    if total <= rows:
        return df
    # six standard deviations above the number wanted
    share = min(1.0, (rows + 6 * rows**0.5) / total)
    return df.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < int(share * (1 << 40)))


def spread(df: DataFrame) -> DataFrame:
    """A scan over at least as many partitions as there are cores, for Python stages on small files; larger scans stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def keyed(df: DataFrame, *keys: str) -> DataFrame:
    """df partitioned by keys, for Python stages over the groups: the session's number of shuffle partitions, or two per split of the input where that is more, so that partitions stay small whatever the size."""
    session = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(session, 2 * df.rdd.getNumPartitions()), *keys)
