"""Problem 2: text of scanned pages repaired into continuous paragraphs.

Method, in three steps.

1. Furniture (running headers, footers, page numbers): line-pair classifiers,
   boosted trees over a line at a page's edge and its neighbour, among them how
   many pages of the document have the same line there. They learn from lines
   whose repetition or page number speaks for itself, and from inner lines.
2. Words broken across lines: a line-pair classifier, boosted trees over how
   often the parts, the joined and the hyphenated word occur elsewhere; it
   learns from words split at random and from hyphens inside lines.
3. Misread words: a word that no clean page has is looked up through an
   inverted join over the character q-grams of its skeleton (characters that
   scanners confuse fall together); boosted trees rank the candidates by what
   was confused, how often that happens, and how common both words are. They
   learn from lexicon words with confusions put in, and from true words.

All classifiers are fitted on documented bounded samples (FIT_*). Word counts,
the candidate search and the decisions cover all pages.

Defined results: pages that are not scanned, null and blank texts give no rows;
a page delivered twice counts once; a misread word that no candidate explains
stays as it is.
"""

from __future__ import annotations

import pickle
import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from korale.functions.folding import INVISIBLES
from korale.llm import gbt
from korale.session import keyed, stored, table

SCANNED = ("tesseract_image_ocr", "existing_ocr_jsonl")
FIT_PAGES = 3_500  # about so many pages teach the furniture classifier,
FIT_LINES = 40_000  # with so many of their lines at most
FIT_WORDS = 8_000  # bound of the lexicon words for the join classifier and the ranking
LEXICON = 2  # occurrences from which a word of clean pages is in the lexicon
LEXICON_SCANNED = 6, 2e-5  # the same for words of scanned pages only: at least so many, and so large a share of their words; a misread form stays below it
FURNITURE = 0.5  # probability from which a line is furniture
JOIN = 0.5
REPLACE = 0.5
MISREAD_RATE = 0.0006  # share of a word's occurrences that are misread in one certain way, for the examples to learn from
COMMON_GRAMS = 0.4  # share of a form's q-grams that a candidate must have
MEMO = 200_000  # tokens that a task remembers
FREQUENT = 1e-5  # share of all words from which a clean page's word is known to every task; there are at most as many as its inverse

_HYPHENS = "-\u2010\u00ac\u00ad\u2011"
_HYPHEN = "\\-\u2010\u00ac\u00ad\u2011"  # the same inside a character class
_BROKEN = re.compile(f"(\\S*[^\\W\\d_][^\\s{_HYPHEN}]*)[{_HYPHEN}]\\s*$")
_ENDS = set(_HYPHENS)
_OUTER = ".,;:?()[]{}\"“”„«»—–…"
_GLOTTAL = re.compile("[‘’'`ʼ‛´′]")
_HIDDEN = re.compile(f"[{INVISIBLES}]")
_PURE = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")
_NUMBER = re.compile(r"[\dOoIl|!.,:/-]*\d[\dOoIl|!.,:/-]*")
_ROMAN = re.compile(r"[ivxlc1!|]{1,9}", re.I)
_STOP = re.compile(r"\w{2}[.!?][”\"')]*\s+(\S+)")
# Shapes that scanners confuse, the printed characters after the read ones.
_SHAPES = (("rn", "m"), ("ri", "n"), ("ii", "u"), ("lc", "k"), ("cl", "d"), ("vv", "w"))
_SHAPE = str.maketrans("0@5986|!1þyc*fb", "oasghollipveʻth")
_STRAY = re.compile(r"[~^•¦]")


# --- words


@lru_cache(200_000)
def form(token: str) -> str:
    """A token in lower case, composed, with one glottal mark, without outer punctuation."""
    t = _HIDDEN.sub("", token.strip(_OUTER))
    t = _GLOTTAL.sub("ʻ", unicodedata.normalize("NFC", t.lower()))
    return t.strip(_OUTER)


def forms(line: str) -> list[str]:
    return [f for t in line.split() if (f := form(t))]


def skeleton(word: str) -> str:
    """word with confused shapes fallen together; accents and stray marks are dropped."""
    w = "".join(c for c in unicodedata.normalize("NFKD", _STRAY.sub("", word)) if not unicodedata.combining(c))
    for a, b in _SHAPES:
        w = w.replace(a, b)
    return w.translate(_SHAPE)


def skeletons(word: str) -> set[str]:
    """All readings of a form: an upright bar may be a letter or a stray mark."""
    out = {skeleton(word)}
    if "|" in word:
        out.add(skeleton(word.replace("|", "")))
    return out


@lru_cache(100_000)
def grams(word: str) -> frozenset[str]:
    """The q-grams of the skeletons: pairs for short words, triples for longer ones."""
    out = set()
    for s in skeletons(word):
        for q in (2, 3) if len(s) == 6 else (2,) if len(s) < 6 else (3,):
            x = f"^{s}$"
            out |= {f"{q}{x[i : i + q]}" for i in range(len(x) - q + 1)}
    return frozenset(out)


def difference(word: str, candidate: str) -> tuple[str, str]:
    """(printed, read): what is left of candidate and of word between their common ends."""
    p = 0
    while p < min(len(word), len(candidate)) and word[p] == candidate[p]:
        p += 1
    q = 0
    while q < min(len(word), len(candidate)) - p and word[-1 - q] == candidate[-1 - q]:
        q += 1
    return candidate[p : len(candidate) - q], word[p : len(word) - q]


def is_number(word: str) -> bool:
    return bool(_NUMBER.fullmatch(word))


@lru_cache(200_000)
def is_word(f: str) -> bool:
    """Whether a form may be a misread word."""
    return not is_number(f) and any(c.isalpha() for c in f) and f[-1] not in _HYPHENS


def broken_end(line: str) -> re.Match | None:
    """The word before a hyphen at a line's end."""
    line = line.rstrip()
    return _BROKEN.search(line.rsplit(None, 1)[-1]) if line[-1:] in _ENDS else None


# --- pages


def in_parts(b: pd.DataFrame, rows: int = 400) -> Iterator[pd.DataFrame]:
    """A batch in parts, as the rows of many pages at once would fill a worker's memory."""
    for i in range(0, len(b), rows):
        yield b.iloc[i : i + rows]


def pages(segments: DataFrame) -> DataFrame:
    """segment_id, source_path, page, text, scanned: each page once."""
    item = F.struct(
        "source_path", F.col("page_or_image").alias("page"), "text", F.coalesce(F.col("extraction_method").isin(*SCANNED), F.lit(False)).alias("scanned")
    )
    once = keyed(segments.filter("segment_id is not null"), "segment_id").groupBy("segment_id").agg(F.min_by(item, F.coalesce("text", F.lit(""))).alias("r"))
    return once.select("segment_id", "r.*").filter(F.col("text").rlike(r"(?U)\S"))


def word_counts(page: DataFrame) -> DataFrame:
    """form, clean, scan: occurrences on clean and on scanned pages; parts of words broken across lines are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            count: tuple[Counter[str], Counter[str]] = Counter(), Counter()
            for text, scanned in zip(b.text, b.scanned, strict=True):
                broken = False
                for line in text.split("\n"):
                    words = line.split()
                    if not words:
                        continue
                    if broken:
                        words = words[1:]
                    broken = bool(broken_end(line))
                    count[bool(scanned)].update(f for t in (words[:-1] if broken else words) if (f := form(t)))
            both = list(count[0].keys() | count[1].keys())
            yield pd.DataFrame({"form": both, "clean": [count[0][w] for w in both], "scan": [count[1][w] for w in both]})

    found = page.select("text", "scanned").mapInPandas(run, "form string, clean bigint, scan bigint")
    return found.groupBy("form").agg(F.sum("clean").alias("clean"), F.sum("scan").alias("scan"))


# --- furniture

EDGE_FEATURES = (
    "top", "depth", "width", "terminated", "numbers", "only_number", "is_page", "gap", "blank_beside", "lower_start", "broken", "upper", "words",
    "neighbour_lower", "neighbour_terminated", "same_lines", "pages", "neighbour_width", "inner_stop",
)
_DIGITS = str.maketrans("OoIl|!", "001111")


def _page_number(line: str, page: str | None) -> tuple[int, bool, bool]:
    """(number-like tokens, whether there is nothing else, whether one is the page's number)."""
    tokens = [t for t in re.split(r"[\s\[\]()|—–·.:-]+", line) if t]
    found, hit = 0, False
    want = (page or "").strip()
    roman = _to_roman(int(want)) if want.isdigit() and 0 < int(want) < 400 else ""
    for t in tokens:
        if is_number(t):
            found += 1
            hit |= t.translate(_DIGITS) == want
        elif _ROMAN.fullmatch(t):
            found += 1
            hit |= bool(roman) and skeleton(t.lower()) == skeleton(roman)
    return found, bool(tokens) and found == len(tokens), hit


def _to_roman(n: int) -> str:
    out = ""
    for value, sign in ((100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= value:
            out, n = out + sign, n - value
    return out


def _features(lines: list[str], at: list[int], k: int, top: bool, depth: int, page: str | None, width: int) -> list[float]:
    i = at[k]
    line = lines[i].strip()
    j = k + 1 if top else k - 1
    other = lines[at[j]].strip() if 0 <= j < len(at) else ""
    letters = [c for c in line if c.isalpha()]
    numbers, only, hit = _page_number(line, page)
    beside = i + 1 if top else i - 1
    return [
        float(top), float(depth), len(line) / width, float(bool(re.search(r"[.!?][”\"')\]]*$", line))), float(numbers), float(only), float(hit),
        float(bool(re.search(r"\S\s{2,}\S", line)) or " | " in line), float(0 <= beside < len(lines) and not lines[beside].strip()),
        float(line[:1].islower()), float(bool(broken_end(lines[i]))), sum(c.isupper() for c in letters) / max(1, len(letters)), float(len(line.split())),
        float(other[:1].islower()), float(bool(re.search(r"[.!?][”\"')\]]*$", other))), 0.0, 0.0, len(other) / width,
        float(any(m.group(1)[0].isupper() or m.group(1)[0] in "—“\"" or m.group(1)[-1] in _HYPHENS for m in _STOP.finditer(line))),
    ]


def _line_keys(line: str) -> list[str]:
    """Keys under which a header is the same on other pages, whatever its number and a misread letter."""
    s = "".join(c for c in skeleton(re.sub(r"\S*\d\S*|\b[ivxlc]+\b", " ", line.lower())) if c.isalpha())
    return [f"<{s[:7]}", f">{s[-7:]}"] if len(s) >= 4 else ["#"]


def edge_lines(page: DataFrame) -> DataFrame:
    """segment_id, line_no, inner, taught, x: the features of the two first and two last lines of each scanned page, and of some inner lines of the pages to learn from."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in (part for whole in batches for part in in_parts(whole)):
            rows = []
            for seg, path, no, text, taught in zip(b.segment_id, b.source_path, b.page, b.text, b.taught, strict=True):
                lines = text.split("\n")
                at = [i for i, s in enumerate(lines) if s.strip()]
                if not at:
                    continue
                width = max(20, int(np.quantile([len(lines[i].strip()) for i in at], 0.9)))
                for top in (True, False):
                    for depth in range(min(2, len(at))):
                        k = depth if top else len(at) - 1 - depth
                        rows.append((seg, path, at[k] + 1, top, depth, False, taught, _line_keys(lines[at[k]]), _features(lines, at, k, top, depth, no, width)))
                for k in range(3, len(at) - 3) if taught else ():
                    short = len(lines[at[k]].strip()) < 0.5 * width
                    if short or k % 9 == 0:
                        rows.append((seg, path, at[k] + 1, k % 2 == 0, k % 3 // 2, True, True, ["!"], _features(lines, at, k, k % 2 == 0, k % 3 // 2, no, width)))
            yield pd.DataFrame(rows, columns=["segment_id", "source_path", "line_no", "top", "depth", "inner", "taught", "keys", "x"])

    schema = "segment_id string, source_path string, line_no int, top boolean, depth int, inner boolean, taught boolean, keys array<string>, x array<double>"
    scanned = page.filter("scanned")
    chosen = F.pmod(F.xxhash64("segment_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, FIT_PAGES / max(1, scanned.count())))
    rows = scanned.select("segment_id", "source_path", "page", "text", chosen.alias("taught")).mapInPandas(run, schema)
    total = scanned.groupBy("source_path").agg(F.count("*").cast("double").alias("pages"))
    edges = rows.filter("not inner")
    keyed = edges.select("segment_id", "source_path", "line_no", "top", "depth", F.explode("keys").alias("key")).filter("key != '#'")
    # a document has a bounded number of pages, so this window is small
    w = Window.partitionBy("source_path", "top", "key")
    same = keyed.withColumn("n", F.size(F.collect_set("segment_id").over(w))).groupBy("segment_id", "line_no", "top", "depth").agg(F.max("n").cast("double").alias("same"))
    return rows.join(same, ["segment_id", "line_no", "top", "depth"], "left").join(total, "source_path", "left").select(
        "segment_id", "line_no", "top", "depth", "inner", "taught", "x", F.coalesce("same", F.lit(1.0)).alias("same"), "pages"
    )


def _edge_matrix(b: pd.DataFrame) -> np.ndarray:
    x = np.array(b.x.tolist(), np.float64).reshape(len(b), len(EDGE_FEATURES))
    x[:, 15], x[:, 16] = b.same, b.pages
    return x


def fit_furniture(edges: DataFrame) -> gbt.Forest | None:
    """Trees for furniture, from lines whose case is clear."""
    got = edges.filter("taught").select("segment_id", "line_no", "top", "inner", "same", "pages", "x").limit(FIT_LINES).toPandas()
    if got.empty:
        return None
    got = got.sort_values(["segment_id", "line_no", "top"], ignore_index=True)
    x = _edge_matrix(got)
    name = {n: i for i, n in enumerate(EDGE_FEATURES)}
    col = lambda n: x[:, name[n]]
    inner = got.inner.to_numpy(bool)
    open_end = (col("terminated") == 0) & (col("broken") == 0) & (col("inner_stop") == 0)
    # a line in lower case that goes on from the line above, or into the line below
    goes_on = (col("lower_start") == 1) & np.where(col("top") == 1, col("neighbour_lower") == 1, (col("neighbour_terminated") == 0) & (col("blank_beside") == 0))
    open_end &= ~goes_on
    sure = ~inner & (
        (col("only_number") == 1) & (col("depth") == 0)
        | (col("is_page") == 1) & (col("gap") == 1) & open_end
        | (col("same_lines") >= 3) & (col("same_lines") >= 0.4 * col("pages")) & open_end & (col("width") < 0.95)
    )
    text = inner | ((col("same_lines") <= 1) | goes_on | (col("inner_stop") == 1)) & (col("is_page") == 0) & ((col("terminated") == 1) | (col("broken") == 1) | (col("inner_stop") == 1) | goes_on | (col("width") > 0.85) & (col("pages") >= 3))
    kept = sure | text
    x, y = x[kept], sure[kept].astype(float)
    blind = x[y == 1].copy()  # single pages have nothing to repeat
    blind[:, name["same_lines"]], blind[:, name["pages"]] = 1.0, 1.0
    blind_text = x[(y == 0)].copy()
    blind_text[:, name["pages"]] = 1.0
    x = np.concatenate([x, blind, blind_text])
    y = np.concatenate([y, np.ones(len(blind)), np.zeros(len(blind_text))])
    if y.min() == y.max():
        return None
    return gbt.fit(x, y, logistic=True, trees=60, depth=5, names=EDGE_FEATURES)


def furniture(page: DataFrame) -> DataFrame:
    """segment_id, line_no of the furniture lines. A second line from the edge counts only behind a first."""
    edges = edge_lines(page)
    edges = stored(edges, "edges")
    model = pickle.dumps(fit_furniture(edges))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = pickle.loads(model)
        for b in batches:
            p = trees.predict(_edge_matrix(b)) if trees is not None and len(b) else np.zeros(len(b))
            yield b[["segment_id", "line_no", "top", "depth"]].assign(p=p)

    scored = edges.filter("not inner").mapInPandas(run, "segment_id string, line_no int, top boolean, depth int, p double").filter(F.col("p") >= FURNITURE)
    outer = scored.filter("depth = 0")
    inner = scored.filter("depth = 1").join(outer.select("segment_id", "top"), ["segment_id", "top"], "left_semi")
    return outer.select("segment_id", "line_no").union(inner.select("segment_id", "line_no")).distinct()


# --- tokens of the text lines


def tokens(page: DataFrame, removed: DataFrame, frequent: set[str]) -> DataFrame:
    """segment_id, line_no, kind, form, left, right: the forms of the text lines (w), line ends that may break a word (h), hyphens inside lines (n).

    Forms in frequent are those of clean words, which need no correction; they are left out.
    """
    gone = removed.groupBy("segment_id").agg(F.collect_list("line_no").alias("gone"))
    rows = page.filter("scanned").select("segment_id", "text").join(gone, "segment_id", "left")

    packed = pickle.dumps(frequent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = Asked(pickle.loads(packed))
        for b in (part for whole in batches for part in in_parts(whole)):
            out = []
            for seg, text, gone in zip(b.segment_id, b.text, b.gone, strict=True):
                out += [(seg, *t) for t in page_tokens(text, set() if gone is None else set(gone), memo)]
            yield pd.DataFrame(out, columns=["segment_id", "line_no", "kind", "form", "left", "right"])

    return rows.mapInPandas(run, "segment_id string, line_no int, kind string, form string, left string, right string")


class Asked(dict):
    """The form of a token if it may be misread and is not known, else an empty text; remembers MEMO tokens."""

    def __init__(self, known: set[str] | frozenset[str] = frozenset()):
        super().__init__()
        self.known = known

    def __missing__(self, token: str) -> str:
        if len(self) > MEMO:
            self.clear()
        f = form(token)
        self[token] = f if f and f not in self.known and is_word(f) else ""
        return self[token]


def page_tokens(text: str, gone: set[int], memo: Asked | None = None) -> list[tuple[int, str, str, str | None, str | None]]:
    memo = Asked() if memo is None else memo
    lines = text.split("\n")
    at = [i for i, s in enumerate(lines) if s.strip() and i + 1 not in gone]
    out = []
    broken = False
    for n, i in enumerate(at):
        words = lines[i].split()
        first = 1 if broken else 0
        m = broken_end(lines[i]) if n + 1 < len(at) else None
        broken = False
        if m and (tail := lines[at[n + 1]].split()):
            left, right = form(m.group(1)), form(tail[0]).rstrip("!")
            if left and right and any(c.isalpha() for c in right):
                broken = True
                out.append((i + 1, "h", left + right, left, right))
        if broken_end(lines[i]) and words:
            words = words[:-1] if len(words[-1].strip()) else words
        if not _ENDS.isdisjoint(lines[i]):
            for a, b in zip(words, words[1:], strict=False):
                if len(a) > 2 and a[-1] in _HYPHENS and a[0].isalpha():
                    out.append((i + 1, "n", form(a.rstrip(_HYPHENS)) + form(b), form(a.rstrip(_HYPHENS)), form(b)))
        out += [(i + 1, "w", f, None, None) for w in words[first:] if (f := memo[w])]
    return out


# --- misread words

RANK_FEATURES = ("rate", "known", "clean", "scan", "of_clean", "of_all", "ratio", "shared", "length", "odd", "rivals", "best", "printed", "read")


def _rank_rows(word: str, clean: int, scan: int, found: list[tuple[str, int, int, float]], rates: dict[tuple[str, str], float]) -> np.ndarray:
    """Features of the candidates (word, clean, all, shared grams) of one form."""
    odd = float(not _PURE.fullmatch(word))
    rows = []
    for cand, c, total, shared in found:
        d = difference(word, cand)
        rate = rates.get(d)
        rows.append([rate if rate is not None else -9.0, float(rate is not None), np.log1p(clean), np.log1p(scan), np.log1p(c), np.log1p(total),
                     np.log((total + 1) / (clean + scan + 1)), shared, float(len(word)), odd, 0.0, 0.0, float(len(d[0])), float(len(d[1]))])
    x = np.array(rows)
    power = x[:, 0] + 0.5 * x[:, 5]
    order = np.sort(power)
    x[:, 10] = len(order) - np.searchsorted(order, power - 1.5, side="right") - 1
    second = order[-2] if len(order) > 1 else -20.0
    x[:, 11] = power - np.maximum(np.where(power >= order[-1], second, order[-1]), -20.0)
    return x


class Ranker:
    """Confusion rates and trees that rank candidates."""

    def __init__(self, rates: dict[tuple[str, str], float], forest: gbt.Forest):
        self.rates, self.forest = rates, forest

    def best(self, asked: list[tuple[str, int, int, list[tuple[str, int, int, float]]]]) -> list[tuple[str, float]]:
        """The best candidate of each (form, clean, scan, candidates), and its probability."""
        if not asked:
            return []
        p = self.forest.predict(np.concatenate([_rank_rows(*x, self.rates) for x in asked]))
        out, at = [], 0
        for _, _, _, found in asked:
            i = int(np.argmax(p[at : at + len(found)]))
            out.append((found[i][0], float(p[at + i])))
            at += len(found)
        return out


def fit_ranker(lexicon: list[tuple[str, int, int]], odd: list[tuple[str, int]], seed: int = 5) -> Ranker | None:
    """lexicon: (word, clean, all); odd: (form, occurrences) that no clean page has."""
    rng, draws = random.Random(seed), np.random.default_rng(seed)
    index: dict[str, list[int]] = defaultdict(list)
    sizes = []
    for i, (w, _, _) in enumerate(lexicon):
        g = grams(w)
        sizes.append(len(g))
        for x in g:
            index[x].append(i)

    def look(word: str) -> list[tuple[str, int, int, float]]:
        g = grams(word)
        hit: Counter[int] = Counter(i for x in g for i in index.get(x, ()))
        return [(*lexicon[i], n / len(g)) for i, n in hit.items() if n >= COMMON_GRAMS * len(g) and abs(len(lexicon[i][0]) - len(word)) <= 2 and lexicon[i][0] != word]

    counts: Counter[tuple[str, str]] = Counter()
    for w, _ in odd:
        near = [d for c in look(w) if max(len((d := difference(w, c[0]))[0]), len(d[1])) <= 2 and min(len(d[0]), len(d[1])) <= 1]
        if len(set(near)) == 1:
            counts[near[0]] += 1
    counts = Counter({d: n for d, n in counts.items() if n >= 3 and not (d[0].isalpha() and d[1] == "" or d[0] == "" and d[1].isalpha())})
    if not counts or not lexicon:
        return None
    total = counts.total()
    rates = {d: float(np.log(n / total)) for d, n in counts.items()}
    kinds, weights = list(counts), list(counts.values())
    xs, ys = [], []

    def add(x: np.ndarray, y: list[float]) -> None:
        # to learn from, the strongest candidates and the right one are enough
        keep = sorted({*np.argsort(-(x[:, 0] + 0.5 * x[:, 5]), kind="stable")[:6].tolist(), *[i for i, v in enumerate(y) if v]})
        xs.append(x[keep])
        ys.extend(y[i] for i in keep)

    known = {w for w, _, _ in lexicon}
    pool = [x for x in lexicon if x[2] >= 4]
    for k in range(min(3000, 6 * len(pool))):
        w, c, n = pool[int(rng.random() ** 1.5 * len(pool))] if k % 2 else rng.choice(pool)
        a, b = rng.choices(kinds, weights)[0]
        places = [i for i in range(len(w) + (not a)) if w.startswith(a, i)] if a else list(range(1, len(w)))
        if not places:
            continue
        i = rng.choice(places)
        bad = w[:i] + b + w[i + len(a) :]
        found = look(bad)
        if bad in known or w not in {f[0] for f in found}:
            continue
        # a common word is misread in the same way more than once
        times = 1 + int(draws.poisson(MISREAD_RATE * n)) + (rng.random() < 0.1)
        add(_rank_rows(bad, 0, times, found, rates), [float(f[0] == w) for f in found])
    for k in range(3000):
        w, c, n = rng.choice(lexicon)
        if found := look(w):
            rare = k % 3 > 0  # as if no clean page had it, and few scanned ones
            add(_rank_rows(w, 0 if rare else c, rng.randint(1, 3) if rare else n - c, found, rates), [0.0] * len(found))
    if not xs or not any(ys):
        return None
    return Ranker(rates, gbt.fit(np.concatenate(xs), np.array(ys), logistic=True, trees=80, depth=5, names=RANK_FEATURES))


def corrections(queries: DataFrame, counts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """form, word: the right word of each misread form of queries (form)."""
    sample = lexicon.orderBy(F.desc("total"), "word").limit(FIT_WORDS).collect()
    known = counts.select("form", "clean", "scan")
    open_forms = (
        queries.join(known, "form", "left")
        .fillna(0, ["clean", "scan"])
        .filter("clean = 0")
        # an exclamation mark behind a known word is no letter
        .withColumn("bare", F.regexp_replace("form", "[!*|]+$", ""))
        .join(lexicon.select(F.col("word").alias("bare"), F.lit(True).alias("plain")), "bare", "left")
        .filter("plain is null or bare = form")
        .select("form", "clean", "scan")
    )
    open_forms = stored(open_forms, "forms")
    odd = open_forms.orderBy(F.xxhash64("form"), "form").limit(FIT_WORDS).collect()
    ranker = fit_ranker([(r.word, r.clean, r.total) for r in sample], [(r.form, r.scan) for r in odd])
    if ranker is None:
        return open_forms.select("form", F.col("form").alias("word"), F.lit(0.0).alias("p")).limit(0)
    model = pickle.dumps(ranker)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"w": b.w, "grams": [sorted(grams(w)) for w in b.w]})

    q = open_forms.select(F.col("form").alias("w")).mapInPandas(listed, "w string, grams array<string>").withColumnRenamed("w", "form")
    inverted = lexicon.select(F.col("word").alias("w")).mapInPandas(listed, "w string, grams array<string>").select(F.col("w").alias("word"), F.explode("grams").alias("gram"))
    inverted = stored(inverted, "inverted")
    # Of the grams of a form that the lexicon has, a candidate has `least` at least, so it has one of the rarest
    # that are left when least - 1 are put aside: the common grams, with their long lists, are never joined.
    often = inverted.groupBy("gram").agg(F.count("*").alias("n"))
    there = q.select("form", F.size("grams").alias("size"), F.explode("grams").alias("gram")).join(often, "gram")
    least = F.ceil(F.col("size") * COMMON_GRAMS - 1e-9).cast("int")
    ordered = there.groupBy("form", "size").agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("grams"))
    prefix = ordered.select("form", F.explode(F.slice("grams", 1, F.greatest(F.size("grams") - least + 1, F.lit(0)))).alias("g")).select("form", F.col("g.gram").alias("gram"))
    met = prefix.join(inverted, "gram").filter((F.abs(F.length("form") - F.length("word")) <= 2) & (F.col("form") != F.col("word"))).select("form", "word").distinct()
    each = met.join(lexicon, "word").groupBy("form").agg(F.collect_list(F.struct("word", "clean", "total")).alias("found"))

    def rank(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ranker = pickle.loads(model)
        for b in (part for whole in batches for part in in_parts(whole, 2000)):
            asked = []
            for w, c, s, f in zip(b.form, b.clean, b.scan, b.found, strict=True):
                g = grams(w)
                found = [(x["word"], x["clean"], x["total"], n / len(g)) for x in f if (n := len(g & grams(x["word"]))) >= COMMON_GRAMS * len(g)]
                if found:
                    asked.append((w, c, s, sorted(found)))
            got = ranker.best(asked)
            yield pd.DataFrame({"form": [x[0] for x in asked], "word": [g[0] for g in got], "p": [g[1] for g in got]})

    scored = open_forms.join(each, "form").mapInPandas(rank, "form string, word string, p double")
    return scored.filter(F.col("p") >= REPLACE)


# --- broken words

JOIN_FEATURES = ("joined", "hyphenated", "left", "right", "corrected")


def fit_join(lexicon: list[tuple[str, int, int]], inside: list[tuple[str, str]], seed: int = 6) -> gbt.Forest | None:
    """Trees for line ends, from lexicon words split at random (counted without this occurrence) and from hyphens inside lines (left, right)."""
    rng = random.Random(seed)
    n = {w: t for w, _, t in lexicon}
    x, y = [], []
    words = [w for w in n if len(w) >= 4]
    if not words:
        return None
    for w in rng.sample(words, min(3000, len(words))):
        i = w.index("-") if "-" in w and rng.random() < 0.5 else rng.randint(2, len(w) - 2)
        left, right = (w[:i], w[i + 1 :]) if w[i] == "-" else (w[:i], w[i:])
        total = n[w] - 1 if rng.random() < 0.9 else 0
        x.append([total if w[i] != "-" else 0, total if w[i] == "-" else 0, n.get(left, 0), n.get(right, 0), float(total == 0 and rng.random() < 0.5)])
        y.append(1.0)
    common = sorted(n, key=lambda w: (-n[w], w))[:400]
    none = [*inside[:2000], *((rng.choice(common), rng.choice(common)) for _ in range(600))]
    for left, right in none:
        x.append([n.get(left + right, 0), n.get(f"{left}-{right}", 0), n.get(left, 0), n.get(right, 0), 0.0])
        y.append(0.0)
    return gbt.fit(np.log1p(np.array(x)), np.array(y), logistic=True, trees=40, depth=4, names=JOIN_FEATURES)


def repairs(segments: DataFrame) -> DataFrame:
    """segment_id, line_no, kind, word, form: every repair of the scanned pages; form is what stands there."""
    page = stored(pages(segments), "pages")
    counts = stored(word_counts(page), "counts")
    words, total = (n or 0 for n in counts.agg(F.sum("scan"), F.sum(F.col("clean") + F.col("scan"))).first())
    often = max(LEXICON_SCANNED[0], LEXICON_SCANNED[1] * words)
    whole = (F.col("clean") >= LEXICON) | ((F.col("clean") >= 1) & (F.col("scan") >= 3)) | (F.col("scan") >= often)
    lexicon = counts.filter(whole & F.col("form").rlike(r"^\p{L}+(-\p{L}+)*$")).select(F.col("form").alias("word"), "clean", (F.col("clean") + F.col("scan")).alias("total"))
    removed = stored(furniture(page), "furniture")
    frequent = {r.form for r in counts.filter((F.col("clean") > 0) & (F.col("clean") + F.col("scan") >= FREQUENT * total)).select("form").collect()}
    found = stored(tokens(page, removed, frequent), "tokens")
    ends = found.filter("kind = 'h'").withColumn("kept", F.concat_ws("-", "left", "right"))
    queries = found.filter("kind = 'w'").select("form").union(ends.select("form")).union(ends.select(F.col("kept"))).distinct()
    fixes = stored(corrections(queries, counts, lexicon), "fixes")

    sample = lexicon.orderBy(F.desc("total"), "word").limit(FIT_WORDS).collect()
    inside = found.filter("kind = 'n'").select("left", "right").orderBy(F.xxhash64("left", "right"), "left", "right").limit(2000).collect()
    model = pickle.dumps(fit_join([(r.word, r.clean, r.total) for r in sample], [(r.left, r.right) for r in inside]))
    # words of scanned pages that misreadings made count for nothing
    real = counts.join(fixes.select("form"), "form", "left_anti").select("form", (F.col("clean") + F.col("scan")).cast("double").alias("n"))
    for c in ("form", "kept", "left", "right"):
        ends = ends.join(real.select(F.col("form").alias(c), F.col("n").alias(f"n_{c}")), c, "left")
    for c in ("form", "kept"):
        ends = ends.join(fixes.select(F.col("form").alias(c), F.col("word").alias(f"fix_{c}"), F.col("p").alias(f"p_{c}")), c, "left")
    ends = ends.fillna(0.0, ["n_form", "n_kept", "n_left", "n_right", "p_form", "p_kept"])

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = pickle.loads(model)
        for b in batches:
            if b.empty or trees is None:
                continue
            fixed = (b[["p_form", "p_kept"]].max(axis=1) > 0).astype(float)
            x = np.log1p(np.stack([b.n_form, b.n_kept, b.n_left, b.n_right, fixed], axis=1).astype(float))
            b = b[trees.predict(x) >= JOIN]
            rows = []
            for r in b.itertuples(index=False):
                # the more common of the two spellings, else the one that a correction explains, else without hyphen
                if r.n_form > 0 or r.n_kept > 0:
                    word, fix = (r.form, None) if r.n_form >= r.n_kept else (r.kept, None)
                elif r.p_form > 0 or r.p_kept > 0:
                    word, fix = (r.form, r.fix_form) if r.p_form >= r.p_kept else (r.kept, r.fix_kept)
                else:
                    word, fix = r.form, None
                rows.append((r.segment_id, r.line_no, "hyphen", fix or word, f"{r.left}-{r.right}"))
                if fix:
                    rows.append((r.segment_id, r.line_no, "misread", fix, word))
            yield pd.DataFrame(rows, columns=["segment_id", "line_no", "kind", "word", "form"])

    schema = "segment_id string, line_no int, kind string, word string, form string"
    joined = ends.mapInPandas(decide, schema)
    misread = found.filter("kind = 'w'").join(fixes, "form").select("segment_id", "line_no", F.lit("misread").alias("kind"), "word", "form")
    lines = removed.select("segment_id", "line_no", F.lit("furniture").alias("kind"), F.lit("").alias("word"), F.lit("").alias("form"))
    return lines.unionByName(joined).unionByName(misread).distinct()


_COLUMNS = ("segment_id", "source_path", "page_or_image", "text", "extraction_method")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repair of the scanned pages."""
    return repairs(table(spark, sf_dir, "extracted_segments").select(*_COLUMNS)).select("segment_id", "line_no", "kind", "word").distinct()


def repaired(text: str, found: list[tuple[int, str, str, str]]) -> list[str]:
    """The continuous paragraphs of a page, given its repairs (line_no, kind, word, form)."""
    lines = text.split("\n")
    gone = {n for n, kind, _, _ in found if kind == "furniture"}
    broken = {n: w for n, kind, w, _ in found if kind == "hyphen"}
    words: dict[int, dict[str, str]] = defaultdict(dict)
    for n, kind, w, f in found:
        if kind == "misread":
            words[n][f] = w
    out: list[str] = []
    current: list[str] = []
    drop_first = blank = False
    for i, line in enumerate(lines, 1):
        if i in gone:
            continue
        if not line.strip():
            blank = True
            continue
        ended = bool(current) and current[-1].rstrip("”\"')]")[-1:] in (".", "!", "?", ":")
        if current and ended and (blank or line.startswith("  ")):
            out.append(" ".join(current))
            current = []
        blank = False
        tokens_ = line.split()
        if drop_first:
            rest = tokens_[0].lstrip(_OUTER)
            tail = rest[len(rest.rstrip(_OUTER + "!")) :]
            current[-1] += tail
            tokens_ = tokens_[1:]
        drop_first = i in broken
        if drop_first and tokens_:
            tokens_[-1] = broken[i].capitalize() if tokens_[-1][:1].isupper() else broken[i]
        for t in tokens_:
            w = words[i].get(form(t))
            if w:
                core = t.strip(_OUTER)
                w = w.capitalize() if core[:1].isupper() else w
                t = t.replace(core, w, 1)
            current.append(t)
    if current:
        out.append(" ".join(current))
    return out


def p2_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """segment_id, para_no, text, repairs: the continuous paragraphs of each scanned page, with the page's number of repairs."""
    segments = table(spark, sf_dir, "extracted_segments").select(*_COLUMNS)
    each = repairs(segments).groupBy("segment_id").agg(F.collect_list(F.struct("line_no", "kind", "word", "form")).alias("found"))
    rows = pages(segments).filter("scanned").select("segment_id", "text").join(each, "segment_id", "left")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for seg, text, found in zip(b.segment_id, b.text, b.found, strict=True):
                fixes = [] if found is None else [(x["line_no"], x["kind"], x["word"], x["form"]) for x in found]
                out += [(seg, k, p, len(fixes)) for k, p in enumerate(repaired(text, fixes), 1)]
            yield pd.DataFrame(out, columns=["segment_id", "para_no", "text", "repairs"])

    return rows.mapInPandas(run, "segment_id string, para_no int, text string, repairs int")


QUERIES = {"p2_found": p2_found, "p2_paragraphs": p2_paragraphs}
