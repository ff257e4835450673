"""Problem 8: sources mixed to target weights.

Method: a multivariate-hypergeometric splitting tree. A mix's total is the
largest for which every source can give its target share within max_repeats.
Each source's quota is met by whole passes over its documents and one partial
pass, along a permutation by hash; passes are made of blocks. The tree splits
the sources' block counts exactly among the output shards: every node draws
how many blocks of each source go left from the multivariate hypergeometric
distribution of its remaining blocks, so that every shard gets its expected
share of each source and all blocks are used once. Shards then draw disjoint
runs of permuted blocks, and shuffle them locally.

The driver splits the upper part of the tree only, by block counts; tasks split
the nodes below it, so its work doesn't grow with the shards. Blocks have
BLOCK_TOKENS tokens at every size.

Defined results: sources of mix_targets without documents, and shares that are
null or not positive, get nothing (p8_shares reports them); documents without
source or tokens are not used; equal targets given twice count once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.llm.tokens import RANKS, token_sizes
from korale.session import stored, table

SEED = 11
BUCKETS = 256  # of a source's permutation, from whose sums the partial pass is found
BLOCK_TOKENS = 16_384
SHARD_TOKENS = 2_000_000
MOST_DRAWN = 500_000_000  # blocks in one draw
LEAST_SHARDS, MOST_NODES = 64, 4096  # the driver splits the tree down to nodes of so many shards, and to at most about twice so many nodes; tasks go on


def _permuted(*parts) -> F.Column:
    return F.xxhash64(*parts, F.lit(SEED))


def _draw(blocks: np.ndarray, take: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each kind are among `take` blocks drawn without order; beyond MOST_DRAWN, the generator's limit, equal bundles of blocks are drawn."""
    bundle = int(blocks.sum()) // MOST_DRAWN + 1
    whole, rest = blocks // bundle, blocks % bundle
    first = min(take // bundle, int(whole.sum()))
    last = min(take - first * bundle, int(rest.sum()))
    return rng.multivariate_hypergeometric(whole, first, method="marginals") * bundle + rng.multivariate_hypergeometric(rest, last, method="marginals")


def _halves(first: int, shards: int, blocks: np.ndarray, start: np.ndarray, seed: list[int]) -> tuple:
    """The two children of a node of the tree. Its draw depends on the seed and its place only, so a lost task repeats it."""
    left = shards // 2
    drawn = _draw(blocks, round(int(blocks.sum()) * left / shards), np.random.default_rng([*seed, first, shards]))
    return (first, left, drawn, start), (first + left, shards - left, blocks - drawn, start + drawn)


def _below(first: int, shards: int, blocks: np.ndarray, start: np.ndarray, seed: list[int], size: int) -> Iterator[tuple]:
    waiting = [(first, shards, blocks, start)]
    while waiting:
        node = waiting.pop()
        if node[1] <= max(1, size):
            yield node
        else:
            waiting += _halves(*node, seed)[::-1]


def nodes(blocks: np.ndarray, shards: int, seed: list[int], size: int) -> list[tuple]:
    """The upper part of the tree: nodes (first shard, shards, blocks of each kind, first block of each kind) of at most size shards, in order."""
    return list(_below(0, shards, blocks, blocks * 0, seed, size))


def leaves(first: int, shards: int, blocks: np.ndarray, start: np.ndarray, seed: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, blocks of each kind, first block of each kind) of each shard below a node."""
    for n, _, got, begin in _below(first, shards, blocks, start, seed, 1):
        yield n, got, begin


def _targets(mixes: DataFrame) -> dict[str, dict[str, tuple[float, int]]]:
    """mix -> source -> (share, most repeats); a mix table names a few dozen shares."""
    out: dict[str, dict[str, tuple[float, int]]] = {}
    for r in sorted(mixes.select("mix_name", "source_name", "target_share", "max_repeats").distinct().collect(), key=str):
        if r.mix_name and r.source_name and (r.target_share or 0) > 0:
            out.setdefault(r.mix_name, {})[r.source_name] = (float(r.target_share), max(1, int(r.max_repeats or 1)))
    return out


class Pass(NamedTuple):
    """How a mix uses a source: whole passes over it, then buckets below edge, in bucket edge those below edge2, and of the last some tokens."""

    mix_name: str
    source: str
    have: int
    quota: float
    whole: int
    edge: int
    edge2: int
    wanted: float


def _reach(sums: np.ndarray, rest: float) -> tuple[int, float]:
    """(the bucket in which `rest` tokens are reached, the tokens wanted of it)."""
    reach = np.cumsum(sums)
    edge = int(np.searchsorted(reach, rest, side="right"))
    return edge, float(rest - (reach[edge - 1] if edge else 0))


def _bucket_sums(rows: DataFrame, bucket: str) -> dict[tuple[str, str], np.ndarray]:
    sums: dict[tuple[str, str], np.ndarray] = {}
    for r in rows.groupBy("mix_name", "source", bucket).agg(F.sum("n_tokens").alias("n")).collect():
        sums.setdefault((r.mix_name, r.source), np.zeros(BUCKETS, np.int64))[r[bucket]] = r.n
    return sums


def plan(sizes: DataFrame, mixes: DataFrame) -> tuple[DataFrame, list[Pass]]:
    """(rows, passes): sizes by mix and two levels of buckets, and the passes. The driver gets BUCKETS sums per mix and source, twice."""
    targets = _targets(mixes)
    names = [(m, s) for m, of in targets.items() for s in of]
    if not names:
        return sizes.select(F.lit("").alias("mix_name"), "*", F.lit(0).alias("bucket"), F.lit(0).alias("bucket2")).limit(0), []
    lookup = sizes.sparkSession.createDataFrame(names, "mix_name string, source string")
    rows = sizes.filter("n_tokens > 0").join(F.broadcast(lookup), "source")  # one row per target share
    for k in ("bucket", "bucket2"):
        rows = rows.withColumn(k, F.pmod(_permuted("doc_id", "mix_name", F.lit(k)), F.lit(BUCKETS)).cast("int"))
    sums = _bucket_sums(rows, "bucket")
    passes = []
    for mix, of in targets.items():
        there = {s: t for s, t in of.items() if (mix, s) in sums}
        weight = sum(t[0] for t in there.values())
        if not weight:
            continue
        total = min(int(sums[mix, s].sum()) * most * weight / share for s, (share, most) in there.items())
        for s, (share, most) in there.items():
            have = int(sums[mix, s].sum())
            quota = total * share / weight
            whole = min(most, int(quota // have))
            rest = 0.0 if whole == most else quota - whole * have
            edge, wanted = _reach(sums[mix, s], rest)
            passes.append(Pass(mix, s, have, float(quota), whole, edge, 0, wanted))
    second = _bucket_sums(_joined(rows, passes).filter("bucket = edge"), "bucket2")
    for i, p in enumerate(passes):
        edge2, wanted = _reach(second.get((p.mix_name, p.source), np.zeros(BUCKETS, np.int64)), p.wanted)
        passes[i] = p._replace(edge2=edge2, wanted=wanted)
    return rows, passes


def _joined(rows: DataFrame, passes: list[Pass]) -> DataFrame:
    """rows with the whole, edge, edge2 and wanted of their pass."""
    schema = "mix_name string, source string, whole int, edge int, edge2 int, wanted double"
    chosen = rows.sparkSession.createDataFrame([(p.mix_name, p.source, p.whole, p.edge, p.edge2, p.wanted) for p in passes], schema)
    return rows.join(F.broadcast(chosen), ["mix_name", "source"])


def usage(sizes: DataFrame, mixes: DataFrame) -> tuple[DataFrame, list[Pass]]:
    """(mix_name, source, doc_id, n_tokens, uses) of each document of a mix's sources, and the passes of plan()."""
    rows, passes = plan(sizes, mixes)
    rows = _joined(rows, passes)
    last = (F.col("bucket") == F.col("edge")) & (F.col("bucket2") == F.col("edge2"))
    before = (F.col("bucket") < F.col("edge")) | ((F.col("bucket") == F.col("edge")) & (F.col("bucket2") < F.col("edge2")))
    columns = ("mix_name", "source", "doc_id", "n_tokens")
    below = rows.filter(~last).select(*columns, (F.col("whole") + before.cast("int")).alias("uses"))
    # only the last bucket, one in BUCKETS squared, needs an order; short documents first, as they meet the quota more closely
    order = Window.partitionBy("mix_name", "source").orderBy("n_tokens", _permuted("doc_id", "mix_name", F.lit("order")), "doc_id")
    reach = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens") / 2
    edge = rows.filter(last).withColumn("reach", reach)
    edge = edge.select(*columns, (F.col("whole") + (F.col("reach") <= F.col("wanted")).cast("int")).alias("uses"))
    return below.unionByName(edge), passes


def _owners(spark: SparkSession, passes: list[Pass]) -> tuple[DataFrame, DataFrame]:
    """(mix_name, source, copy_no, blocks) and (mix_name, source, copy_no, block, shard): the blocks of each pass and their shards."""
    blocks, top, kinds_of = [], [], {}
    for mix in dict.fromkeys(p.mix_name for p in passes):
        kinds = []
        for p in passes:
            for copy in range(p.whole + 1) if p.mix_name == mix else ():
                size = p.have if copy < p.whole else p.quota - p.whole * p.have
                if size >= 1:
                    kinds.append((p.source, copy, max(1, math.ceil(size / BLOCK_TOKENS))))
        kinds_of[mix] = kinds
        blocks += [(mix, *k) for k in kinds]
        shards = max(1, math.ceil(sum(p.quota for p in passes if p.mix_name == mix) / SHARD_TOKENS))
        upper = nodes(np.array([n for _, _, n in kinds], np.int64), shards, [SEED, *mix.encode()], max(LEAST_SHARDS, shards // MOST_NODES))
        top += [(mix, first, n, got.tolist(), start.tolist()) for first, n, got, start in upper]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples(index=False):
                kinds = kinds_of[r.mix_name]
                for shard, got, start in leaves(r.first, r.shards, np.array(r.blocks, np.int64), np.array(r.start, np.int64), [SEED, *r.mix_name.encode()]):
                    k = np.flatnonzero(got)
                    yield pd.DataFrame({"mix_name": r.mix_name, "source": [kinds[i][0] for i in k], "copy_no": [kinds[i][1] for i in k], "first": start[k], "n": got[k], "shard": shard})

    schema = "mix_name string, first bigint, shards bigint, blocks array<bigint>, start array<bigint>"
    runs = spark.createDataFrame(top, schema).mapInPandas(split, "mix_name string, source string, copy_no int, first bigint, n bigint, shard bigint")
    owners = runs.select("mix_name", "source", "copy_no", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("block"), "shard")
    return spark.createDataFrame(blocks, "mix_name string, source string, copy_no int, blocks bigint"), owners


def mixture(sizes: DataFrame, mixes: DataFrame) -> DataFrame:
    """(mix_name, shard, position, doc_id, source, copy_no, n_tokens): the mixed stream of each mix."""
    used, passes = usage(sizes, mixes)
    counts, owners = _owners(sizes.sparkSession, passes)
    copies = used.filter("uses > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(0), F.col("uses") - 1)))
    drawn = copies.join(F.broadcast(counts), ["mix_name", "source", "copy_no"], "left")
    # a partial pass rounded to less than a token has no block of its own and joins the first shard
    block = F.coalesce(F.pmod(_permuted("doc_id", "mix_name", "copy_no", F.lit("block")), F.col("blocks")), F.lit(0))
    drawn = drawn.withColumn("block", block).join(owners, ["mix_name", "source", "copy_no", "block"], "left").withColumn("shard", F.coalesce("shard", F.lit(0)))
    local = Window.partitionBy("mix_name", "shard").orderBy(_permuted("doc_id", "mix_name", "copy_no", F.lit("local")), "doc_id", "copy_no")
    return drawn.select("mix_name", "shard", F.row_number().over(local).alias("position"), "doc_id", "source", "copy_no", "n_tokens")


def _sizes(spark: SparkSession, sf_dir: str, ranks_path: str = RANKS) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source").filter("source is not null")
    return stored(token_sizes(documents, keep=("source",), ranks_path=ranks_path), "sizes")


def p8_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document of its sources is used by each mix."""
    return usage(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed stream of each mix, by shard and position."""
    return mixture(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per mix and target source: the share wanted, tokens there and used, most uses of a document, and the actual share."""
    used = usage(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))[0]
    got = used.groupBy("mix_name", F.col("source").alias("source_name")).agg(
        F.sum("n_tokens").alias("tokens_there"), F.sum(F.col("n_tokens") * F.col("uses")).alias("tokens_used"), F.max("uses").alias("most_uses")
    )
    wanted = table(spark, sf_dir, "mix_targets").select("mix_name", "source_name", "target_share", "max_repeats").distinct()
    rows = wanted.join(got, ["mix_name", "source_name"], "left").fillna(0, ["tokens_there", "tokens_used", "most_uses"])
    whole = F.sum("tokens_used").over(Window.partitionBy("mix_name"))
    return rows.withColumn("actual_share", F.round(F.col("tokens_used") / F.nullif(whole, F.lit(0)), 5))


QUERIES = {"p8_mixture": p8_mixture, "p8_usage": p8_usage, "p8_shares": p8_shares}
