"""Deterministic samples and allocations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.operators.splitting import placed


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """n rows in the order of a hash of their key (a sampling operator: the limit is its purpose)."""
    return rows.orderBy(F.sha2(F.col(key).cast("string"), 256), key).limit(n)


def quotas(rows: DataFrame, slice_: Column, key: str, counts: dict[str, int]) -> DataFrame:
    """Per slice its quota of rows, in the order of a hash of their key."""
    quota = F.create_map(*[x for s, n in counts.items() for x in (F.lit(s), F.lit(n))])
    rows = rows.withColumn("slice", slice_).filter(F.col("slice").isin(*counts))
    return placed(rows, "slice", key, "_r").filter(F.col("_r") <= F.element_at(quota, F.col("slice"))).drop("_r")


def epoch_order(rows: DataFrame, key: str, seed: int, epoch: int) -> DataFrame:
    """Another fixed order for each epoch."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed + epoch)), key)


def allocate(available: dict[str, int], ratios: dict[str, float]) -> dict[str, int]:
    """Rows to take of each pool: pools smaller than their share of what is left give all, and their rest is shared out again."""
    left, open_ = sum(available.values()), {k: v for k, v in ratios.items() if v > 0}
    out = dict.fromkeys(ratios, 0)
    while open_:
        whole = sum(open_.values())
        share = {k: int(left * v / whole) for k, v in open_.items()}
        small = [k for k in open_ if available.get(k, 0) <= share[k]]
        if not small:
            return out | {k: min(share[k], available.get(k, 0)) for k in open_}
        for k in small:
            out[k] = available.get(k, 0)
            left -= out[k]
            del open_[k]
    return out


def mix(pools: DataFrame, pool: str, key: str, ratios: dict[str, float]) -> DataFrame:
    """Rows of the pools by allocate(), each pool in the order of a hash of its keys. Only the pools' counts reach the driver."""
    counts = {r[0]: r[1] for r in pools.filter(F.col(pool).isin(*ratios)).groupBy(pool).count().collect()}
    return quotas(pools, F.col(pool), key, allocate(counts, ratios)).drop("slice")


def by_family(rows: DataFrame, include: tuple[str, ...] = (), exclude: tuple[str, ...] = (), exempt: Column | None = None) -> DataFrame:
    """Rows of the included families (all, if none is named) but not of the excluded ones; exempt rows always."""
    ok = F.col("task_family").isin(*include) if include else F.lit(True)
    if exclude:
        ok = ok & ~F.coalesce(F.col("task_family").isin(*exclude), F.lit(False))
    return rows.filter(ok | (F.coalesce(exempt, F.lit(False)) if exempt is not None else F.lit(False)))


def origin_allowed(origin: Column, arm: str, arms: dict[str, tuple[str, ...]]) -> Column:
    """Whether a prompt's origin belongs to an arm; an unknown arm is an error."""
    if arm not in arms:
        raise ValueError(f"unknown arm {arm}")
    return origin.isin(*arms[arm])


def not_done(rows: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """Rows whose keys aren't done yet (resumption)."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


ABLATIONS: dict[str, tuple[str, ...]] = {"mixed": (), "english_only": ("english",), "tvl_only": ("synthetic", "anchor")}


def ablation(rows: DataFrame, name: str, stage: str = "stage") -> DataFrame:
    """The rows of the stages of an ablation; all of them for mixed, and an unknown name is an error."""
    if name not in ABLATIONS:
        raise ValueError(f"unknown ablation {name}")
    return rows.filter(F.col(stage).isin(*ABLATIONS[name])) if ABLATIONS[name] else rows


def numbered(rows: DataFrame, key: str, name: str) -> DataFrame:
    """rows with their place (from 0) in the order of a hash of a unique key; counts of hash prefixes spare a sort of all rows in one task."""
    h = F.sha2(F.col(key).cast("string"), 256)
    rows = rows.withColumns({"_h": h, "_p": F.substring(h, 1, 3)})
    before = F.coalesce(F.sum("_k").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = rows.groupBy("_p").agg(F.count("*").alias("_k")).select("_p", before.alias("_before"))  # at most 4096 prefixes
    place = F.row_number().over(Window.partitionBy("_p").orderBy("_h", key)) - 1 + F.col("_before")
    return rows.join(F.broadcast(sums), "_p").withColumn(name, place).drop("_h", "_p", "_before")


def requests(rows: DataFrame, key: str, body: Column, prefix: str = "request") -> DataFrame:
    """Rows of a batch of requests: a running custom_id, and the body as JSON."""
    return numbered(rows, key, "_n").select("*", F.concat(F.lit(f"{prefix}-"), F.col("_n").cast("string")).alias("custom_id"), F.to_json(body).alias("body")).drop("_n")
