"""Problem 7: documents put into containers of fixed capacity with little space unused.

Method: pattern packing by non-negative least squares. The documents are dealt
by a hash of their id into shards of about SHARD_DOCS each (their number grows
with the table, their size does not), and every shard and capacity is packed
on its own: the length histogram over CELLS cells is fitted by non-negative
repeat counts of the patterns of up to three lengths that fill a container;
the counts are rounded down, each repeat takes the longest document of its
cells first and for the last place the best-fitting one; the residual documents
go, longest first, into the container with the least space that still holds
them.

A document larger than the capacity gives full pieces, which fill containers
of their own, and a last piece that is packed like a document. Nothing else is
split. Documents without tokens need no container and have no row.
"""

from __future__ import annotations

from bisect import bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.llm.tokens import RANKS, token_sizes
from korale.session import table

SHARD_DOCS = 20_000
CELLS = 48  # of a length histogram
ROUNDS = 300  # of the least-squares solver
SCHEMA = "container_set string, capacity_tokens int, doc_id bigint, piece_no int, n_tokens bigint, container_id string"


def patterns(cells: int) -> np.ndarray:
    """All multisets of one to three cell sizes that sum to cells: one row of counts each."""
    rows = [(cells, 0, 0)]
    rows += [(a, cells - a, 0) for a in range((cells + 1) // 2, cells)]
    rows += [(a, b, cells - a - b) for a in range(1, cells) for b in range(1, a + 1) if 1 <= cells - a - b <= b]
    out = np.zeros((len(rows), cells + 1))
    for i, r in enumerate(rows):
        for c in r:
            out[i, c] += c > 0
    return out


def nonnegative(a: np.ndarray, h: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """x >= 0 that minimises |a'x - h| weighted by size, by cyclic coordinate descent on the normal equations."""
    w = np.sqrt(np.arange(len(h)) + 1.0)
    a, h = a * w, h * w
    gram, target = a @ a.T, a @ h
    x = np.zeros(len(a))
    grad = -target.copy()
    diag = np.diag(gram)
    for _ in range(rounds):
        moved = 0.0
        for j in np.flatnonzero((grad < -1e-9) | (x > 0)):
            new = max(0.0, x[j] - grad[j] / diag[j])
            if new != x[j]:
                grad += gram[:, j] * (new - x[j])
                moved = max(moved, abs(new - x[j]))
                x[j] = new
        if moved < 0.25:
            break
    return x


def pack(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The container (from 0) of each item; lengths are from 1 to capacity."""
    n = len(lengths)
    out = np.full(n, -1, np.int64)
    if n == 0:
        return out
    cells = min(CELLS, capacity)
    order = np.lexsort((np.arange(n), lengths))
    cell = np.ceil(lengths * cells / capacity).astype(int)
    stock: list[list[int]] = [[] for _ in range(cells + 1)]  # ascending lengths, so pop() takes the longest
    for i in order:
        stock[cell[i]].append(int(i))
    shapes = patterns(cells)
    repeats = np.floor(nonnegative(shapes, np.bincount(cell, minlength=cells + 1).astype(float))).astype(int)
    # remaining items as a sorted list of (length, item) per cell serves the exact last pick
    used = 0
    space: list[int] = []
    for p in np.argsort(-repeats, kind="stable"):
        if repeats[p] <= 0:
            break
        sizes = sorted(np.repeat(np.arange(cells + 1), shapes[p].astype(int)).tolist(), reverse=True)
        for _ in range(repeats[p]):
            left, taken = capacity, []
            for k, c in enumerate(sizes):
                if k == len(sizes) - 1 and k:
                    # rounding up left some room: look from the fullest cell that may fit downwards
                    pick = _best(stock, lengths, min(cells, left * cells // capacity + 1), c, left)
                else:
                    pick = stock[c].pop() if stock[c] else -1
                if pick < 0:
                    break
                taken.append(pick)
                left -= int(lengths[pick])
            if len(taken) < len(sizes):
                for i in taken:
                    insort(stock[cell[i]], i, key=lambda j: (lengths[j], j))
                break
            out[taken] = used
            space.append(left)
            used += 1
    # residual items, longest first, into the fullest container that holds them
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    for c, left in enumerate(space):
        if left:
            open_at[left].append(c)
            mask |= 1 << left
    for items in reversed(stock):
        for i in reversed(items):
            size = int(lengths[i])
            above = mask >> size
            if above:
                left = size + (above & -above).bit_length() - 1
                c = open_at[left].pop()
                if not open_at[left]:
                    mask ^= 1 << left
            else:
                c, left = used, capacity
                used += 1
            out[i] = c
            if left := left - size:
                open_at[left].append(c)
                mask |= 1 << left
    return out


def _best(stock: list[list[int]], lengths: np.ndarray, high: int, low: int, left: int) -> int:
    """Takes the longest item of the cells from high down to low that fits into left; -1 where there is none."""
    for c in range(high, low - 1, -1):
        items = stock[c]
        if items and (at := bisect_right(items, left, key=lambda j: int(lengths[j]))):
            return items.pop(at - 1)
    return -1


def _pack_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    name, shard, capacity = key[0], int(key[1]), int(key[2])
    rows = rows.sort_values("doc_id", kind="stable")
    size = rows.n_tokens.to_numpy(np.int64)
    ids = rows.doc_id.to_numpy(np.int64)
    full, rest = size // capacity, size % capacity
    at = np.repeat(np.arange(len(rows)), full)
    piece = np.arange(len(at)) - np.repeat(np.cumsum(full) - full, full)
    tail = np.flatnonzero(rest)
    packed = pack(rest[tail], capacity)
    container = np.concatenate([np.arange(len(at)), len(at) + packed])
    return pd.DataFrame(
        {
            "container_set": name, "capacity_tokens": np.int32(capacity),
            "doc_id": np.concatenate([ids[at], ids[tail]]),
            "piece_no": np.concatenate([piece, full[tail]]).astype(np.int32) + 1,
            "n_tokens": np.concatenate([np.full(len(at), capacity), rest[tail]]),
            "container_id": [f"{shard}-{c}" for c in container],
        }
    )


def containers(sizes: DataFrame, capacities: DataFrame, documents: int, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """A container for each document of sizes (doc_id, n_tokens), for every row of capacities; documents tells about how many there are."""
    shards = max(1, -(-documents // shard_docs))
    # a capacity table names a handful of capacities; they are read here so that it can't grow a broadcast
    kinds = sorted({(r.container_set, r.capacity_tokens) for r in capacities.select("container_set", "capacity_tokens").collect() if r.capacity_tokens and r.capacity_tokens > 0})
    if not kinds:
        return sizes.sparkSession.createDataFrame([], SCHEMA)
    each = F.array(*[F.struct(F.lit(s).alias("container_set"), F.lit(c).cast("int").alias("capacity_tokens")) for s, c in kinds])
    rows = sizes.filter("n_tokens > 0").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "n_tokens", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard"), F.inline(each)
    )
    return rows.groupBy("container_set", "shard", "capacity_tokens").applyInPandas(_pack_shard, SCHEMA)


def _packed(spark: SparkSession, sf_dir: str, ranks_path: str = RANKS) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return containers(token_sizes(documents, ranks_path=ranks_path), table(spark, sf_dir, "container_sizes"), documents.count())


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of each document, or piece of one larger than the capacity, for every capacity."""
    return _packed(spark, sf_dir)


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: containers, tokens, and the share of the space that is filled."""
    return fill(_packed(spark, sf_dir))


def fill(packed: DataFrame) -> DataFrame:
    each = packed.groupBy("container_set", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("n"))
    return each.groupBy("container_set", "capacity_tokens").agg(
        F.count("*").alias("containers"), F.sum("n").alias("tokens"), F.round(F.sum("n") / (F.count("*") * F.col("capacity_tokens")), 5).alias("filled")
    )


QUERIES = {"p7_containers": p7_containers, "p7_fill": p7_fill}
