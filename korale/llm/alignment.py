"""Problem 5: sentences of bilingual documents that translate each other.

Method: length-based dynamic programming. A bead pairs up to three sentences of
one side with up to three of the other (one-to-one, omission, merge, split);
its cost is the negative log probability of the bead's kind and of its length
ratio under a normal model, whose mean and variance are estimated, plus what
its words leave untranslated. The dynamic programme finds the cheapest path;
it runs over the anti-diagonals of many documents at once.

The word evidence comes from ROUNDS rounds over all pairs: the first aligns by
length, names and numbers alone and counts words that keep company in
one-to-one beads; later rounds use that lexicon. Lengths and lexicon are counted
anew in each round, word frequencies once, all over all pairs. The model holds
words from a share of RARE of all sentences on, so their number is at most that
of the words of a sentence divided by RARE, and few partners for each; rarer
words count as unknown, which names and numbers don't mind.

The path decides: its one-to-one beads are pairs, and in its merges, splits and
at borders of beads sentences that share a part. Sentences that the path leaves
over are matched across positions by their words, which finds reordered ones.

Defined results: null and blank sentences have no counterpart; repeated rows
count once; pairs with one side only give no rows. Documents of more than CELLS
times CELLS sentences are aligned in windows of so many, each going on from the
middle of the path of the one before.
"""

from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.functions.folding import fold
from korale.session import discard, spread, stored, table

FIT_PAIRS = 450  # bounds nothing any more, as all rounds read all pairs; only tests set it
ROUNDS = 4  # of learning, each over all pairs
RARE = 1e-6  # share of a side's sentences from which the model holds a word
TOGETHER = 3  # one-to-one beads two words must share
DICE = 0.2  # association from which two words are translations
# Negative log probabilities of the kinds of beads: (sentences of tvl, of en).
KINDS = {(1, 1): 0.3, (1, 0): 2.6, (0, 1): 2.6, (1, 2): 2.0, (2, 1): 2.0, (2, 2): 3.0, (1, 3): 3.2, (3, 1): 3.2, (2, 3): 4.2, (3, 2): 4.2, (3, 3): 5.5}
WORDS = 8.0  # cost of a bead without any translated word
FIRST = 2.5  # the same in the first round, which knows no words
KNOWN = 0.35  # share of known words below which a bead is judged as in the first round
SHARED = 0.7  # share of a sentence's words that a partner outside of its own one-to-one bead must have
SHORT = 5  # words up to which a sentence also counts as one expression,
EXPRESSION = 3.0  # which weighs as much as so many rare words, if it is known
CELLS = 1400  # sentences of a side in one window
BATCH_CELLS = 50_000  # of the tables of documents that are aligned together

PHRASE, LONG, DIGITS = 1, 2, 4  # the lowest bits of a word's number
_WORD = re.compile(r"[^\W_]+(?:[-,][^\W_]+)*")


def tokens(sentence: str) -> list[str]:
    """Folded words of a sentence, digits without their separators; a short sentence is also one expression."""
    out = [w.replace(",", "") if w[0].isdigit() else w for x in _WORD.findall(fold(sentence)) for w in ([x] if x[0].isdigit() else x.split(","))]
    return [*out, "=" + " ".join(out)] if 0 < len(out) <= SHORT else out


@lru_cache(100_000)
def number(word: str) -> int:
    """A word as a number: its hash, and whether it is an expression, has over three letters, or is a number itself."""
    kind = (PHRASE if word[0] == "=" else 0) | (LONG if len(word) > 3 else 0) | (DIGITS if word[0].isdigit() else 0)
    return ((xxhash.xxh3_64_intdigest(word) - (1 << 63)) & ~7) | kind


def _runs(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers start[k], start[k] + 1, ... of each run, size[k] of them."""
    return np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in the sorted keys, whether they are there)."""
    at = np.searchsorted(keys, wanted)
    if not len(keys):
        return at, np.zeros(len(wanted), bool)
    at = np.minimum(at, len(keys) - 1)
    return at, keys[at] == wanted


def _window(x: np.ndarray, k: int, axis: int) -> np.ndarray:
    """Sums of k neighbours along an axis."""
    n = x.shape[axis] - k + 1
    parts = [x[(slice(None),) * axis + (slice(t, t + n),)] for t in range(k)]
    return parts[0] if k == 1 else sum(parts[1:], parts[0])


@dataclass
class Side:
    """One side of some documents: sentences padded to the longest document, words flat."""

    size: np.ndarray  # [document]
    chars: np.ndarray  # [document, sentence]
    doc: np.ndarray  # [word]
    sent: np.ndarray  # [word]
    word: np.ndarray  # [word]


@dataclass
class Model:
    """Length model and lexicon; arrays by side."""

    vocabulary: list[np.ndarray]  # sorted word numbers
    weight: list[np.ndarray]
    rare: float = 6.0
    ratio: float = 1.1
    spread: float = 6.0
    penalty: float = FIRST
    lexicon: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=lambda: [_lexicon(np.zeros(0, np.int64), np.zeros(0, np.int64))] * 2)

    def hits(self, side: int, a: Side, b: Side) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """([document, i, j]: weight of the words of sentence i that have a counterpart in sentence j, [document, i]: of all its words, of those that are known)."""
        (docs, p), q = a.chars.shape, b.chars.shape[1]
        at, there = _find(self.vocabulary[side], a.word)
        w = np.where(there, self.weight[side][at] if len(self.weight[side]) else 0.0, self.rare)
        keys, start, size, partners = self.lexicon[side]
        at, listed = _find(keys, a.word)
        phrase = (a.word & PHRASE) > 0
        w = np.where(phrase, np.where(listed, EXPRESSION * self.rare, 0.0), w)
        n = np.where(listed, size[at] if len(size) else 0, 0)
        same = np.flatnonzero(((a.word & (LONG | DIGITS)) > 0) & (~phrase | listed))
        i = np.concatenate([np.repeat(np.arange(len(n)), n), same])
        y = np.concatenate([partners[_runs(start[at] if len(start) else n, n)], a.word[same]])
        key = b.word * 0x2545F4914F6CDD1D + b.doc * 0x9E3779B97F4A7 if len(b.word) else b.word
        order = np.argsort(key)
        asked = y * 0x2545F4914F6CDD1D + a.doc[i] * 0x9E3779B97F4A7
        held, begin, times = np.unique(key[order], return_index=True, return_counts=True)
        at, there = _find(held, asked)
        i, at = i[there], at[there]
        low, met = begin[at], times[at]
        hit = np.zeros(len(w) * q, bool)  # [word, sentence of the other side]; a word may meet it through several partners
        hit[np.repeat(i, met) * q + b.sent[order[_runs(low, met)]]] = True
        i, j = np.divmod(np.flatnonzero(hit), q)
        place = a.doc * p + a.sent
        m = np.bincount(place[i] * q + j, w[i], docs * p * q).reshape(docs, p, q)
        known = listed | ((a.word & DIGITS) > 0)
        known[i] = True
        return m, np.bincount(place, w, docs * p).reshape(docs, p), np.bincount(place, w * known, docs * p).reshape(docs, p)

    def covered(self, a: Side, b: Side) -> tuple[np.ndarray, ...]:
        """(m, n, wa, wb, ka, kb): hits of both sides, [document, i, j], and the weights of all and of known words."""
        m, wa, ka = self.hits(0, a, b)
        n, wb, kb = self.hits(1, b, a)
        return m, n.transpose(0, 2, 1), np.maximum(wa, 1e-6), np.maximum(wb, 1e-6), ka, kb

    def paths(self, batch: Batch) -> Iterator[tuple[np.ndarray, np.ndarray, Side, Side, np.ndarray, tuple[np.ndarray, ...]]]:
        """(documents, first sentences, both sides, beads, covered()) of groups of documents, and of the windows of those beyond CELLS."""
        for rows in batch.groups():
            first = np.zeros((len(rows), 2), np.int64)
            while len(rows):
                a, b = batch.part(0, rows, first[:, 0]), batch.part(1, rows, first[:, 1])
                beads, cover = self.align(a, b)
                whole = (first[:, 0] + a.size == batch.sides[0][0][rows]) & (first[:, 1] + b.size == batch.sides[1][0][rows])
                beads = beads[whole[beads[:, 0]] | (2 * (beads[:, 1] + beads[:, 2]) < (a.size + b.size)[beads[:, 0]])]
                yield rows, first, a, b, beads, cover
                end = np.zeros((len(rows), 2), np.int64)
                np.maximum.at(end, beads[:, 0], beads[:, 1:3] + beads[:, 3:5])
                rows, first = rows[~whole], (first + end)[~whole]

    def costs(self, a: Side, b: Side, cover: tuple[np.ndarray, ...]) -> dict[tuple[int, int], np.ndarray]:
        """Per kind of bead with both sides, [document, i, j] of its first sentences: what lengths and untranslated words add to its cost."""
        m, n, wa, wb, ka, kb = cover
        (_, p), q = a.chars.shape, b.chars.shape[1]
        rows = {k: np.minimum(wa[:, :, None], _window(m, k, 2)) for k in (1, 2, 3) if k <= q}
        cols = {k: np.minimum(wb[:, None, :], _window(n, k, 1)) for k in (1, 2, 3) if k <= p}
        out = {}
        for x, y in KINDS:
            if not x or not y or x > p or y > q:
                continue
            la, lb = _window(a.chars, x, 1)[:, :, None], _window(b.chars, y, 1)[:, None, :]
            d = (la - self.ratio * lb) ** 2 / (self.spread * (la + lb) / 2 + 1)
            weight = _window(wa, x, 1)[:, :, None] + _window(wb, y, 1)[:, None, :]
            got = (_window(rows[y], x, 1) + _window(cols[x], y, 2)) / weight
            known = (_window(ka, x, 1)[:, :, None] + _window(kb, y, 1)[:, None, :]) / weight
            penalty = np.where(known < KNOWN, min(FIRST, self.penalty), self.penalty)
            out[x, y] = np.minimum(d / 2, 12.0) * 0.5 + penalty * (1 - got) * max(x, y)
        return out

    def align(self, a: Side, b: Side) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
        """([bead]: document, i, j, sentences from i on, from j on; of the cheapest path of each document, from its end), and covered()."""
        cover = self.covered(a, b)
        costs = {k: np.ascontiguousarray(c).reshape(len(c), -1) for k, c in self.costs(a, b, cover).items()}
        (docs, p), q = a.chars.shape, b.chars.shape[1]
        reach = np.full((docs, (p + 1) * (q + 1)), np.inf)
        reach[:, 0] = 0.0
        back = np.zeros(reach.shape, np.int8)

        def diagonal(x: np.ndarray, width: int, s: int, first: int, last: int) -> np.ndarray:
            """The cells (i, s - i), from i = first to last, of a table of that width."""
            return x[:, s + first * (width - 1) : s + last * (width - 1) + 1 : max(1, width - 1)]

        kinds = list(KINDS.items())
        for s in range(1, p + q + 1):
            low, high = max(0, s - q), min(p, s)
            best, arg = np.full((docs, high - low + 1), np.inf), np.zeros((docs, high - low + 1), np.int8)
            for k, ((x, y), prior) in enumerate(kinds):
                first, last = max(low - x, 0), min(high - x, s - x - y)
                if last < first:
                    continue
                c = diagonal(reach, q + 1, s - x - y, first, last) + prior
                if x and y:
                    c += diagonal(costs[x, y], q - y + 1, s - x - y, first, last)
                here = slice(first + x - low, last + x - low + 1)
                better = c < best[:, here]
                np.copyto(best[:, here], c, where=better)
                np.copyto(arg[:, here], np.int8(k), where=better)
            diagonal(reach, q + 1, s, low, high)[:] = best
            diagonal(back, q + 1, s, low, high)[:] = arg
        steps = np.array([k for k, _ in kinds])
        doc, i, j, beads = np.arange(docs), a.size.copy(), b.size.copy(), []
        while len(doc):
            step = steps[back[doc, i * (q + 1) + j]]
            i, j = i - step[:, 0], j - step[:, 1]
            beads.append(np.column_stack([doc, i, j, step]))
            on = (i > 0) | (j > 0)
            doc, i, j = doc[on], i[on], j[on]
        return np.concatenate(beads), cover

    def pairs(self, a: Side, b: Side, beads: np.ndarray, cover: tuple[np.ndarray, ...]) -> np.ndarray:
        """[pair]: document, i, j of the sentences that translate each other, or parts of each other."""
        m, n, wa, wb, _, _ = cover
        share = np.maximum(m / wa[:, :, None], n / wb[:, None, :])
        of: list[np.ndarray] = []
        alone: list[np.ndarray] = []
        for side, chars in ((0, a.chars), (1, b.chars)):
            size = beads[:, 3 + side]
            doc, at = np.repeat(beads[:, 0], size), _runs(beads[:, 1 + side], size)
            of.append(np.full(chars.shape, len(beads), np.int64))
            of[side][doc, at] = np.repeat(np.arange(len(beads)), size)
            alone.append(np.zeros(chars.shape, bool))
            alone[side][doc, at] = np.repeat(beads[:, 4 - side] == 0, size)
        # the beads of a step of all documents follow each other, so a document's own ones are numbered by step
        step = np.zeros(len(beads) + 1, np.int64)
        order = np.argsort(beads[:, 0], kind="stable")
        step[order] = np.arange(len(order))
        near = np.abs(step[of[0]][:, :, None] - step[of[1]][:, None, :]) <= 1
        found = (share >= SHARED) & (near | alone[0][:, :, None] | alone[1][:, None, :]) & (of[0] < len(beads))[:, :, None] & (of[1] < len(beads))[:, None, :]
        d, i, j, x, y = beads[(beads[:, 3] == 1) & (beads[:, 4] == 1)].T
        found[d, i, j] = True
        return np.argwhere(found)


def _lexicon(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words, start and number of their partners, partners) of pairs of words."""
    order = np.lexsort((y, x))
    words, start, size = np.unique(x[order], return_index=True, return_counts=True)
    return words, start, size, y[order]


# --- documents

_SIDE = "{0}_no array<int>, {0}_chars array<int>, {0}_size array<int>, {0}_words array<bigint>"


def _documents(sentences: DataFrame) -> DataFrame:
    """pair_id and, for tvl and en, the numbered sentences in order: numbers, characters, words of each and all words. A pair is one document, so its size is a document's."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = b.column("sentence").to_pylist()
            words = [sorted({number(w) for w in tokens(t)}) for t in text]
            yield pa.RecordBatch.from_arrays(
                [b.column("pair_id"), b.column("side"), b.column("sent_no"), pa.array([len(t) for t in text], pa.int32()), pa.array(words, pa.list_(pa.int64()))],
                names=["pair_id", "side", "sent_no", "chars", "words"],
            )

    rows = sentences.filter("pair_id is not null and sent_no is not null and side in ('tvl', 'en') and trim(sentence) != ''").select("pair_id", "side", F.col("sent_no").cast("int"), "sentence")
    rows = spread(rows).mapInArrow(split, "pair_id string, side string, sent_no int, chars int, words array<bigint>")
    # one sentence per number: of several the one of the least words
    item = F.struct("sent_no", "chars", "words")
    both = rows.groupBy("pair_id").agg(*[F.array_sort(F.collect_set(F.when(F.col("side") == s, item))).alias(s) for s in ("tvl", "en")])
    out = [F.col("pair_id")]
    for s in ("tvl", "en"):
        once = F.filter(s, _first(s))
        out += [F.transform(once, lambda x: x["sent_no"]).alias(f"{s}_no"), F.transform(once, lambda x: x["chars"]).alias(f"{s}_chars"),
                F.transform(once, lambda x: F.size(x["words"])).alias(f"{s}_size"), F.flatten(F.transform(once, lambda x: x["words"])).alias(f"{s}_words")]
    return both.select(*out).filter((F.size("tvl_no") > 0) & (F.size("en_no") > 0))


def _first(side: str):
    """Whether an item of the sorted array is the first of its number."""
    return lambda x, i: (i == 0) | (F.col(side)[i - 1]["sent_no"] != x["sent_no"])


class Batch:
    """The documents of an Arrow batch, flat; parts of it are padded for the programme."""

    def __init__(self, b: pa.RecordBatch):
        self.ids = b.column("pair_id")
        self.sides = []
        for s in ("tvl", "en"):
            sents = b.column(f"{s}_no").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            no, chars, size, words = (b.column(f"{s}_{c}").flatten().to_numpy(zero_copy_only=False) for c in ("no", "chars", "size", "words"))
            self.sides.append((sents, np.cumsum(sents) - sents, no, chars.astype(float), size.astype(np.int64), np.cumsum(size, dtype=np.int64) - size, words))

    def groups(self) -> Iterator[np.ndarray]:
        """Documents of like size, to be aligned together."""
        p, q = np.minimum(self.sides[0][0], CELLS), np.minimum(self.sides[1][0], CELLS)
        order = np.lexsort((q, p))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and (end + 1 - at) * p[order[at : end + 1]].max() * q[order[at : end + 1]].max() <= BATCH_CELLS:
                end += 1
            yield order[at:end]
            at = end

    def part(self, side: int, rows: np.ndarray, first: np.ndarray) -> Side:
        """The sentences of some documents from first on, CELLS at most."""
        sents, start, _, chars, size, word, words = self.sides[side]
        n = np.minimum(sents[rows] - first, CELLS)
        flat = _runs(start[rows] + first, n)
        doc, sent = np.repeat(np.arange(len(rows)), n), _runs(n * 0, n)
        padded = np.ones((len(rows), int(n.max())))
        padded[doc, sent] = chars[flat]
        k = size[flat]
        return Side(n, padded, np.repeat(doc, k), np.repeat(sent, k), words[_runs(word[flat], k)])


# --- fitting


def _vocabulary(documents: DataFrame) -> Model:
    """A model with the inverse sentence frequencies of both sides."""
    total = documents.agg(*[F.sum(F.size(f"{s}_no")).alias(s) for s in ("tvl", "en")]).first()
    ids, weights = [], []
    for s in ("tvl", "en"):
        n = total[s] or 0
        counted = documents.select(F.explode(f"{s}_words").alias("w")).groupBy("w").count()
        got = counted.filter((F.col("count") > 1) & (F.col("count") >= RARE * n)).toPandas().sort_values("w")
        ids.append(got.w.to_numpy(np.int64))
        weights.append(np.log((n + 1) / got["count"].to_numpy(float)))
    return Model(ids, weights, math.log(max(total["en"] or 0, 8)))


def _learn(documents: DataFrame, model: Model, first: bool) -> None:
    """Aligns the documents by the model, then counts its lengths and lexicon anew from the beads, which aren't kept."""
    packed = pickle.dumps(model)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(packed)
        for batch in map(Batch, batches):
            for _, _, a, b, beads, (m, n, wa, wb, ka, kb) in model.paths(batch):
                d, i, j, _, _ = beads = beads[(beads[:, 3] == 1) & (beads[:, 4] == 1)].T
                sure = np.maximum(m[d, i, j] / wa[d, i], n[d, i, j] / wb[d, j]) > 0.1
                kept = sure | first | (ka[d, i] + kb[d, j] < KNOWN * (wa[d, i] + wb[d, j]))
                d, i, j = d[kept], i[kept], j[kept]
                columns = [pa.array(a.chars[d, i].astype(np.int32)), pa.array(b.chars[d, j].astype(np.int32))]
                for k, (side, at) in enumerate(((a, i), (b, j))):
                    places, known = _find(model.vocabulary[k], side.word)
                    cell = (side.doc * side.chars.shape[1] + side.sent)[known]
                    size = np.bincount(cell, minlength=side.chars.size)
                    of = size[d * side.chars.shape[1] + at]
                    begin = (np.cumsum(size) - size)[d * side.chars.shape[1] + at]
                    offsets = np.concatenate([[0], np.cumsum(of)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(places[known][_runs(begin, of)].astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["x", "y", "one", "two"])

    beads = stored(spread(documents).mapInArrow(align, "x int, y int, one array<int>, two array<int>"), "beads")
    _count(beads, model)
    discard(beads)


def _count(beads: DataFrame, model: Model) -> None:
    """Counts the model's lengths and lexicon from one-to-one beads."""
    sums = beads.agg(F.count("*").alias("n"), F.sum("x").alias("x"), F.sum("y").alias("y")).first()
    if sums.n <= 20:
        return
    model.ratio = sums.x / sums.y
    off = F.pow(F.col("x") - model.ratio * F.col("y"), 2) / ((F.col("x") + F.col("y")) / 2)
    model.spread = float(np.clip(beads.agg(F.percentile_approx(off, 0.5).alias("m")).first().m * 2.2, 0.5, 12))
    size = [len(v) for v in model.vocabulary]

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(n, np.int64) for n in size]
        for b in batches:
            for side, c in enumerate(("one", "two")):
                counts[side] += np.bincount(b.column(c).flatten().to_numpy(zero_copy_only=False), minlength=size[side])
        for side in (0, 1):
            at = np.flatnonzero(counts[side])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), side, np.int32)), pa.array(at.astype(np.int32)), pa.array(counts[side][at])], names=["side", "w", "n"])

    got = beads.select("one", "two").mapInArrow(single, "side int, w int, n bigint").groupBy("side", "w").agg(F.sum("n").alias("n")).toPandas()
    of = [np.bincount(g.w, g.n, size[side]).astype(np.int64) for side in (0, 1) for g in [got[got.side == side]]]
    phrase = [(v & PHRASE).astype(bool) for v in model.vocabulary]
    width = max(1, size[1])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2000):
                b = whole.slice(start, 2000)
                one, two = b.column("one"), b.column("two")
                k, n = (c.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64) for c in (one, two))
                left, right = (c.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (one, two))
                x = np.repeat(left, np.repeat(n, k))
                y = right[_runs(np.repeat(np.cumsum(n) - n, k), np.repeat(n, k))]
                nx, ny = of[0][x], of[1][y]
                low = np.minimum(nx, ny)  # the most beads they can share
                may = (low >= TOGETHER) & (2 * low >= DICE * (nx + ny)) & (phrase[0][x] == phrase[1][y])
                key, n = np.unique(x[may] * width + y[may], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    counted = beads.select("one", "two").mapInArrow(together, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    got = counted.filter(F.col("n") >= TOGETHER).toPandas()
    x, y = np.divmod(got.key.to_numpy(np.int64), width)
    kept = 2 * got.n.to_numpy(np.int64) >= DICE * (of[0][x] + of[1][y])
    x, y = model.vocabulary[0][x[kept]], model.vocabulary[1][y[kept]]
    model.lexicon = [_lexicon(x, y), _lexicon(y, x)]


def fit(documents: DataFrame) -> Model:
    """Length model and lexicon: ROUNDS rounds over all documents."""
    model = _vocabulary(documents)
    for k in range(ROUNDS):
        model.penalty = WORDS if k else FIRST
        _learn(documents, model, k == 0)
    model.penalty = WORDS
    return model


def sentence_pairs(sentences: DataFrame, model: Model | None = None) -> DataFrame:
    """pair_id, tvl_no, en_no of the sentences that translate each other."""
    documents = stored(_documents(sentences), "pair-documents")
    packed = pickle.dumps(model or fit(documents))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.loads(packed)
        for batch in map(Batch, batches):
            for rows, first, a, b, beads, cover in model.paths(batch):
                d, i, j = model.pairs(a, b, beads, cover).T
                tvl, en = (batch.sides[k][2][batch.sides[k][1][rows[d]] + first[d, k] + at] for k, at in ((0, i), (1, j)))
                yield pa.RecordBatch.from_arrays([batch.ids.take(pa.array(rows[d])), pa.array(tvl), pa.array(en)], names=["pair_id", "tvl_no", "en_no"])

    return spread(documents).mapInArrow(run, "pair_id string, tvl_no int, en_no int")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sentences of each pair that translate each other."""
    return sentence_pairs(table(spark, sf_dir, "pair_sentences").select("pair_id", "side", "sent_no", "sentence"))


def p5_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per pair: sentences of both sides and how many of them have a counterpart."""
    sentences = table(spark, sf_dir, "pair_sentences").select("pair_id", "side", "sent_no", "sentence")
    found = sentence_pairs(sentences).groupBy("pair_id").agg(F.count_distinct("tvl_no").alias("tvl_paired"), F.count_distinct("en_no").alias("en_paired"))
    total = sentences.groupBy("pair_id").agg(
        F.count_distinct(F.when(F.col("side") == "tvl", F.col("sent_no"))).alias("tvl_sentences"),
        F.count_distinct(F.when(F.col("side") == "en", F.col("sent_no"))).alias("en_sentences"),
    )
    return total.join(found, "pair_id", "left").fillna(0, ["tvl_paired", "en_paired"])


QUERIES = {"p5_found": p5_found, "p5_coverage": p5_coverage}
