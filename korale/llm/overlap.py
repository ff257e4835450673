"""Problem 1: records of the evaluation splits that also stand in the training split.

Method: every record is canonicalised (case, accents, glottal marks, entities,
invisible characters, punctuation and spacing) and hashed; equal hashes of a
training and an evaluation record, on one side or the other, are exact
overlaps. Near overlaps, whose longest common subsequence of words reaches
AGREE of all their words, are found with joins of hashes too:

* A text is the sequence of its words without the STOPS; its keys are the
  bigrams of neighbours in that sequence. If D words of one text are not in the
  common subsequence and I of the other, at most 2D + I of its bigrams are lost,
  and 1.1 D + 0.9 I <= 0.2 n, which bounds the loss for a text of n words.
* So, in any one order of all bigrams, the first `loss + need` bigrams of two
  agreeing texts share `need` of them (prefix filter). The order is by how
  common a bigram's bucket is over all records, so hot bigrams hardly ever are
  keys. A text with too few bigrams for this also emits keys made of all its
  words, which the other texts of that kind match. No pair is lost.
* Keys carry 54 parities of the words, whose differences bound the words that
  differ from below; this drops nearly all chance meetings inside the join.
* The pairs left are verified exactly.

Copies are joined as classes of equal texts and expanded at the end, so a text
with many copies costs its keys once per task.

Defined results: null and short texts, null ids and rows of other splits take
no part; repeated rows give their pair once; rows with the same id never pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.functions.folding import words
from korale.session import stored, table

LEAST_WORDS = 14
AGREE = 0.9
# Words that hardly tell texts apart; the choice bears on speed only.
STOPS = ("te", "ne", "i", "o", "e", "se", "mo", "ki", "ko", "a", "me", "ke", "kae", "mai", "the", "of", "and", "in", "for", "to", "on")
BUCKETS = 1 << 16  # of the counts by which bigrams are ordered
LONG = 100  # words from which a pair must share more than one key
PARITIES = 53  # of a sketch, which has 64 bits: ten hold the length, one whether the text repeats itself
FEW_PAIRS = 300_000  # candidates up to which their classes are looked up through a broadcast

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hash(word: str, seed: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(word, seed) - (1 << 63)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return x ^ (x >> np.uint64(29))


def loss(n: int) -> int:
    """The most bigrams that a text of n words can lose against one that agrees with it."""
    return max(2 * d + int((0.2 * n - 1.1 * d) / 0.9 + 1e-9) for d in range(int(0.2 * n / 1.1 + 1e-9) + 1))


def need(n: int) -> int:
    """Keys that a pair must share, unless a text has too few; more for long texts, which share some by chance."""
    return 1 if n < LONG else 2 + n // 50


def common(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, with the rows of the dynamic programme as bits."""
    at: dict[int, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & at.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def agree(a: list[int], b: list[int]) -> bool:
    return len(a) >= LEAST_WORDS and len(b) >= LEAST_WORDS and 2 * common(a, b) >= AGREE * (len(a) + len(b)) - 1e-9


RECORD = "side tinyint, cls bigint, id string, ev boolean, n int, tokens array<bigint>"


def records(pairs: DataFrame) -> DataFrame:
    """One row per row and side of pairs (id, split, tvl, en) with LEAST_WORDS words: its class and, for the first of a class and role in each task, its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        first: set[tuple[int, int, bool]] = set()
        for b in batches:
            sides, classes, ids, evs, ns, values, offsets, null = [], [], [], [], [], [], [0], []
            for rid, ev, *texts in zip(*(b.column(c).to_pylist() for c in ("id", "ev", "tvl", "en")), strict=True):
                for side, text in enumerate(texts):
                    w = words(text)
                    if len(w) < LEAST_WORDS:
                        continue
                    cls = _hash(" ".join(w), side)
                    sides.append(side)
                    classes.append(cls)
                    ids.append(rid)
                    evs.append(ev)
                    ns.append(len(w))
                    if (side, cls, ev) in first:
                        null.append(True)
                    else:
                        if len(first) < 1_000_000:  # beyond, a copy may be keyed twice, which changes no result
                            first.add((side, cls, ev))
                        null.append(False)
                        for x in w:
                            h = known.get(x)
                            if h is None:
                                if len(known) > 500_000:
                                    known.clear()
                                h = known[x] = _hash(x)
                            values.append(h)
                    offsets.append(len(values))
            tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()), mask=pa.array(null, pa.bool_()) if null else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sides, pa.int8()), pa.array(classes, pa.int64()), pa.array(ids, pa.string()), pa.array(evs, pa.bool_()), pa.array(ns, pa.int32()), tokens],
                names=["side", "cls", "id", "ev", "n", "tokens"],
            )

    rows = pairs.filter("id is not null and split in ('train', 'validation', 'test')")
    rows = rows.select("id", (F.col("split") != "train").alias("ev"), "tvl", "en")
    return rows.mapInArrow(run, RECORD)


_STOP_HASHES = np.array(sorted(_hash(w) for w in STOPS), np.int64)


def _bigrams(values: np.ndarray, owner: np.ndarray, all_words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the bigrams, and their texts."""
    if not all_words:
        at = np.minimum(np.searchsorted(_STOP_HASHES, values), len(_STOP_HASHES) - 1)
        kept = _STOP_HASHES[at] != values
        values, owner = values[kept], owner[kept]
    v = values.view(np.uint64)
    same = owner[:-1] == owner[1:]
    with np.errstate(over="ignore"):
        g = _mix(v[:-1][same] * np.uint64(3) + _mix(v[1:][same]))
    return g, owner[:-1][same]


def _flat(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lists = b.column("tokens")
    n = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(n)), n), n


def common_buckets(rows: DataFrame) -> np.ndarray:
    """[side, bucket]: how many bigrams of all records fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * BUCKETS, np.int64)
        for b in batches:
            values, owner, _ = _flat(b)
            g, of = _bigrams(values, owner, False)
            side = b.column("side").to_numpy(zero_copy_only=False).astype(np.int64)
            total += np.bincount(side[of] * BUCKETS + (g >> np.uint64(48)).astype(np.int64), minlength=2 * BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(2 * BUCKETS, np.int64)
    counted = rows.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out[counted.bucket.to_numpy()] = counted.n.to_numpy()
    return out.reshape(2, BUCKETS)


def _sketch(values: np.ndarray, owner: np.ndarray, n: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """PARITIES parities of each text's words, above a bit for texts that repeat themselves and ten bits for the length."""
    bit = (_mix(values.view(np.uint64)) % np.uint64(PARITIES)).astype(np.int64)
    odd = np.bincount(owner * PARITIES + bit, minlength=len(n) * PARITIES).reshape(-1, PARITIES) & 1
    return ((odd.astype(np.uint64) << np.arange(PARITIES, dtype=np.uint64)).sum(axis=1, dtype=np.uint64) << np.uint64(11)) | repeats.astype(np.uint64) << np.uint64(10) | np.minimum(n, 1023).astype(np.uint64)


def keys(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """(key, cls, sketch): the prefix of each text."""
    order = counts.astype(np.int32)

    def chosen(g, of, side, limit, salt):
        bucket = (g >> np.uint64(48)).astype(np.int64)
        at = np.lexsort((g, order[side[of], bucket], of))
        g, of = g[at], of[at]
        new = np.ones(len(g), bool)
        new[1:] = (g[1:] != g[:-1]) | (of[1:] != of[:-1])
        g, of = g[new], of[new]
        size = np.bincount(of, minlength=len(limit))
        place = np.arange(len(g)) - (np.cumsum(size) - size)[of]
        kept = place < limit[of]
        return _mix(g[kept] + (side[of[kept]] * 2 + salt).astype(np.uint64)), of[kept], size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lost = np.array([loss(n) for n in range(4096)])
        for whole in batches:
            for start in range(0, whole.num_rows, 4000):
                b = whole.slice(start, 4000)
                values, owner, n = _flat(b)
                side = b.column("side").to_numpy(zero_copy_only=False).astype(np.int64)
                limit = np.array([lost[k] if k < 4096 else loss(int(k)) for k in n], np.int64) + np.array([need(int(k)) for k in n], np.int64)
                key, of, size = chosen(*_bigrams(values, owner, False), side, limit, 0)
                few = size < limit  # these texts also need keys of all their words
                repeats = np.zeros(len(n), bool)
                if few.any():
                    some = few[owner]
                    key2, of2, size2 = chosen(*_bigrams(values[some], owner[some], True), side, limit, 1)
                    key, of = np.concatenate([key, key2]), np.concatenate([of, of2])
                    repeats = few & (size2 < limit)
                cls = b.column("cls").to_numpy(zero_copy_only=False)
                sketch = _sketch(values, owner, n, repeats).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(cls[of]), pa.array(sketch[of])], names=["key", "cls", "sketch"])

    return rows.select("side", "cls", "tokens").mapInArrow(run, "key bigint, cls bigint, sketch bigint")


def candidates(rows: DataFrame, counts: np.ndarray) -> DataFrame:
    """(a, b): classes of training and evaluation texts that may agree."""
    texts = rows.filter("tokens is not null")
    train = keys(texts.filter("not ev"), counts).select("key", F.col("cls").alias("a"), F.col("sketch").alias("sa"))
    held = keys(texts.filter("ev"), counts).select("key", F.col("cls").alias("b"), F.col("sketch").alias("sb"))
    na, nb = F.col("sa").bitwiseAND(F.lit(1023)), F.col("sb").bitwiseAND(F.lit(1023))
    apart = F.bit_count(F.shiftrightunsigned(F.col("sa").bitwiseXOR(F.col("sb")), 11))
    repeats = F.col("sa").bitwiseOR(F.col("sb")).bitwiseAND(F.lit(1024)) > 0
    whole = (na == 1023) | (nb == 1023)  # the length of a very long text isn't known here
    may = whole | ((apart * 10 <= na + nb) & (F.least(na, nb) * 20 >= (na + nb) * 9))
    met = train.join(held.hint("merge"), "key").filter((F.col("a") != F.col("b")) & may)
    enough = F.least(*[F.when(n < LONG, 1).otherwise(2 + F.floor(n / 50)) for n in (na, nb)])
    return met.groupBy("a", "b", "sa", "sb").agg(F.count("*").alias("shared")).filter(repeats | (F.col("shared") >= enough)).select("a", "b").distinct()


def _only(rows: DataFrame, wanted: DataFrame, bounded: bool) -> DataFrame:
    """The rows whose class is wanted; through a look-up where there are few."""
    if not bounded:
        return rows.join(wanted, "cls", "left_semi")
    listed = np.sort(wanted.toPandas().cls.to_numpy(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls = b.column("cls").to_numpy(zero_copy_only=False)
            at = np.minimum(np.searchsorted(listed, cls), max(0, len(listed) - 1))
            yield b.filter(pa.array(listed[at] == cls if len(listed) else np.zeros(len(cls), bool)))

    return rows.mapInArrow(run, rows.schema)


def near_classes(rows: DataFrame) -> tuple[DataFrame, bool]:
    """((a, b): classes of different training and evaluation texts that agree; whether they are few enough to be broadcast)."""
    counts = common_buckets(rows.filter("tokens is not null").select("side", "tokens"))
    pairs = stored(candidates(rows, counts), "candidates")
    few = pairs.count() <= FEW_PAIRS
    wanted = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    texts = _only(rows.filter("tokens is not null").select("cls", "tokens"), wanted, few).dropDuplicates(["cls"])

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ok = [agree(x.tolist(), y.tolist()) for x, y in zip(b.ta, b.tb, strict=True)]
            yield b.loc[ok, ["a", "b"]]

    both = pairs.join(texts.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a").join(texts.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b")
    return stored(both.mapInPandas(verify, "a bigint, b bigint"), "agreeing"), few


def overlaps(pairs: DataFrame) -> DataFrame:
    """(id, ev_id): a training row and an evaluation row of pairs that agree on a side, once each."""
    rows = stored(records(pairs), "records")
    near, few = near_classes(rows)
    members = rows.select("side", "cls", "n", "id", "ev")
    train = members.filter("not ev").drop("ev")
    held = members.filter("ev").drop("ev").withColumnRenamed("id", "ev_id")
    same = train.join(held, ["side", "cls", "n"]).select("id", "ev_id")
    listed = near.select(F.col("a").alias("cls")).union(near.select(F.col("b").alias("cls"))).distinct()
    close = _only(members.select("cls", "id", "ev"), listed, few)
    a = close.filter("not ev").select(F.col("cls").alias("a"), "id")
    b = close.filter("ev").select(F.col("cls").alias("b"), F.col("id").alias("ev_id"))
    return same.unionByName(near.join(a, "a").join(b, "b").select("id", "ev_id")).filter("id != ev_id").distinct()


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "aligned_pairs").select("id", "tvl", "en", "content_type", "split", "source_file")
    return rows.filter(~F.coalesce(F.col("content_type").isin("word", "expression"), F.lit(False)))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a training and an evaluation row that agree."""
    got = overlaps(_rows(spark, sf_dir))
    return got.select(F.least("id", "ev_id").alias("id_a"), F.greatest("id", "ev_id").alias("id_b")).distinct()


def p1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per evaluation split and source_file: rows, rows that overlap with training, and pairs; a row delivered in several files counts in each."""
    rows = _rows(spark, sf_dir)
    held = rows.filter("split in ('validation', 'test')").select("id", "split", "source_file").distinct()
    found = overlaps(rows).groupBy(F.col("ev_id").alias("id")).agg(F.count("*").alias("pairs"))
    return (
        held.join(found, "id", "left")
        .groupBy("split", "source_file")
        .agg(F.count("*").alias("rows"), F.count("pairs").alias("overlapping_rows"), F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"))
    )


QUERIES = {"p1_found": p1_found, "p1_counts": p1_counts}
