"""The operators for training data: against brute force, round trips, and the odd cases."""

from __future__ import annotations

import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from korale.llm import alignment, gbt, language, mixing, ocr_repair, overlap, packing, queries, repetition, subjects, tokens, truncation
from korale.session import sample, shared_dir

WORDS = [a + b + c for a in ("ka", "te", "mo", "fu", "li") for b in ("na", "ve", "si", "lo") for c in ("", "ta", "mu", "pe")]


def prose(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 9)) * (rng.random() < 0.1) for _ in range(n))


# --- trees


def test_trees_keep_monotonic_order():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 3))
    y = x[:, 0] + 0.5 * np.sin(8 * x[:, 0]) + x[:, 1] ** 2 + rng.normal(size=2000) * 0.1
    forest = gbt.fit(x, y, logistic=False, monotone={0: 1})
    line = np.zeros((100, 3))
    line[:, 0] = np.linspace(-3, 3, 100)
    assert (np.diff(forest.predict(line)) >= -1e-12).all()
    assert np.mean((forest.predict(x) - y) ** 2) < 0.5 * y.var()
    assert len(gbt.fit(x[:0], y[:0], logistic=False).predict(x)) == 2000


# --- p1


PAIRS = "id string, split string, tvl string, en string, doc_id string, cls string"


def brute_overlaps(rows) -> set[tuple[str, str]]:
    out = set()
    for a in rows:
        for b in rows:
            if a[1] == "train" and b[1] in ("validation", "test") and a[0] and b[0] and a[0] != b[0]:
                for s in (2, 3):
                    x, y = ([hash(w) for w in overlap.words(r[s])] for r in (a, b))
                    if overlap.agree(x, y):
                        out.add((a[0], b[0]))
    return out


def test_overlaps_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(90):
        text, other = prose(rng, rng.choice((13, 14, 15, 20, 35, 60, 130))), prose(rng, 30)
        rows.append((f"t{i}", "train", text, other, "d", None))
        w = text.split()
        for _ in range(rng.randint(0, max(1, len(w) // 8))):
            k = rng.randrange(len(w))
            match rng.randrange(4):
                case 0:
                    del w[k]
                case 1:
                    w.insert(k, rng.choice(WORDS))
                case 2:
                    w[k] = rng.choice(WORDS)
                case 3:
                    w[k], w[k - 1] = w[k - 1], w[k]
        rows.append((f"e{i}", rng.choice(("test", "validation", "quarantined", None)), " ".join(w).upper() + "!", prose(rng, 25), "d", None))
    rows += [("c1", "train", None, "", None, None), ("c2", "test", rows[0][2], None, None, None), (None, "test", rows[0][2], None, None, None)]
    rows += [("t0", *rows[0][1:]), ("copy", "train", rows[0][2], None, None, None)]
    got = {(r.id, r.ev_id) for r in overlap.overlaps(spark.createDataFrame(rows, PAIRS)).collect()}
    want = brute_overlaps(rows)
    assert got == want and len(want) > 20


def test_overlaps_of_texts_on_both_sides_and_of_repetitive_texts(spark, monkeypatch):
    rng = random.Random(4)
    text, near = prose(rng, 40), None
    near = text.split()
    near[7] = "other"
    near = " ".join(near)
    rows = [("t1", "train", text, prose(rng, 30), "d", None), ("t2", "train", prose(rng, 30), text, "d", None), ("h1", "test", near, prose(rng, 30), "d", None)]
    rows += [("r1", "train", "kolo " * 250, None, "d", None), ("q1", "test", "kolo " * 240, None, "d", None)]
    rows += [("r2", "train", "te fale lei " * 100, None, "d", None), ("q2", "test", "te fale lei " * 95, None, "d", None)]
    for i in range(30):  # sentences that stand on either side, with few different words
        words = [rng.choice(("ko", "lua", "tolu", "fa")) for _ in range(rng.choice((14, 30, 110, 160)))]
        sides = [" ".join(words), prose(rng, 20)]
        rows.append((f"a{i}", "train", *(sides if rng.random() < 0.5 else sides[::-1]), "d", None))
        for _ in range(len(words) // 14):
            words[rng.randrange(len(words))] = "lima"
        sides = [" ".join(words), prose(rng, 20)]
        rows.append((f"b{i}", "validation", *(sides if rng.random() < 0.5 else sides[::-1]), "d", None))
    want = brute_overlaps(rows)
    assert {("t1", "h1"), ("r1", "q1"), ("r2", "q2")} <= want and ("t2", "h1") not in want
    frame = spark.createDataFrame(rows, PAIRS)
    assert {(r.id, r.ev_id) for r in overlap.overlaps(frame).collect()} == want
    monkeypatch.setattr(overlap, "FEW_PAIRS", 0)  # the way for many candidates
    assert {(r.id, r.ev_id) for r in overlap.overlaps(frame).collect()} == want


def test_overlap_canonical_form(spark):
    a = "ʻĀ te fale lei &lsquo;o te tagata nei ne fau ki te kogakoga tena i Funafuti, 1999!"
    b = "a te FALE\xa0lei o  te ta\xadgata nei ne fau ki te kogakoga tenā i funafuti 1999"
    rows = [("x", "train", a, None, None, None), ("y", "test", b, None, None, None)]
    assert overlap.overlaps(spark.createDataFrame(rows, PAIRS)).count() == 1
    assert overlap.overlaps(spark.createDataFrame([], PAIRS)).count() == 0


def test_loss_bounds_the_lost_bigrams():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randint(14, 60)
        a = [rng.randrange(10**6) for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(1, max(1, n // 10))):
            k = rng.randrange(len(b))
            rng.choice((lambda k=k: b.__delitem__(k), lambda k=k: b.insert(k, rng.randrange(10**6)), lambda k=k: b.__setitem__(k, rng.randrange(10**6))))()
        if overlap.agree(a, b):
            grams = lambda t: set(zip(t, t[1:]))
            assert len(grams(a) - grams(b)) <= overlap.loss(len(a))


# --- p2


def test_ocr_helpers():
    assert ocr_repair.form("“Ke’a!”") == "keʻa!"
    assert ocr_repair.skeleton("g0al") == ocr_repair.skeleton("goal") and ocr_repair.skeleton("rnorning") == ocr_repair.skeleton("morning")
    assert ocr_repair.difference("rnade", "made") == ("m", "rn")
    got = ocr_repair.page_tokens("ka te-\npu lei\n\n12\nwell-\nknown half- and", {4})
    assert (1, "h", "tepu", "te", "pu") in got and (5, "h", "wellknown", "well", "known") in got and any(k[1] == "n" for k in got)
    assert ocr_repair.page_tokens("", set()) == [] and ocr_repair.page_tokens("-\n-", set()) == []
    text = "HEAD 3\n\nThe br0ken wo-\nrd is here.\n\nNext one."
    found = [(1, "furniture", "", ""), (3, "misread", "broken", "br0ken"), (3, "hyphen", "word", "wo-rd")]
    assert ocr_repair.repaired(text, found) == ["The broken word is here.", "Next one."]


SEGMENTS = "segment_id string, source_path string, page_or_image string, text string, extraction_method string, form string"


def test_repairs_of_small_pages(spark):
    rng = random.Random(4)
    rows = []
    for d in range(12):
        for p in range(1, 9):
            words = [rng.choice(WORDS) for _ in range(90)]
            scanned = d < 8
            lines, line = [], ""
            for w in words:
                if len(line) + len(w) > 48:
                    if scanned and len(w) > 5 and rng.random() < 0.5:
                        lines.append(f"{line} {w[:3]}-")
                        line = w[3:]
                        continue
                    lines.append(line.strip())
                    line = ""
                if scanned and "o" in w and rng.random() < 0.1:
                    w = w.replace("o", "0", 1)
                line += f" {w}"
            lines.append(line.strip() + ".")
            text = "\n".join(([f"Running title of book {d}   {p}"] if scanned else []) + lines)
            rows.append((f"s{d}#{p}", f"path{d}", str(p), text, "tesseract_image_ocr" if scanned else "pdftotext_layout", "clash"))
    rows += [rows[0], ("n1", "x", None, None, "tesseract_image_ocr", None), ("n2", "x", "0", "  \n ", "existing_ocr_jsonl", None), (None, "x", "1", "text", None, None)]
    got = ocr_repair.repairs(spark.createDataFrame(rows, SEGMENTS)).toPandas()
    kinds = got.kind.value_counts()
    assert kinds["furniture"] == 64 and set(got[got.kind == "furniture"].line_no) == {1}
    joined = got[got.kind == "hyphen"]
    assert len(joined) > 30 and joined.word.isin(WORDS).mean() > 0.9
    bad = got[got.kind == "misread"]
    assert len(bad) > 20 and bad.word.isin(WORDS).mean() > 0.9


def test_repairs_of_nothing(spark):
    assert ocr_repair.repairs(spark.createDataFrame([], SEGMENTS)).count() == 0


# --- p3


def test_languages(spark):
    rng = random.Random(5)
    tvl = lambda n: " ".join(rng.choice(("te", "ne", "kae", "fale", "tagata", "ki", "mo", "faka", "lei")) for _ in range(n))
    en = lambda n: " ".join(rng.choice(("the", "and", "house", "that", "people", "with", "great", "which", "good")) for _ in range(n))
    rows = [(f"p{i}", f"s{i}", (tvl if i % 2 else en)(60), "Tuvaluan" if i % 2 else "en-NZ") for i in range(60)]
    rows += [("q", "wrong", tvl(40), "English"), ("q", "none", en(40), None), ("q", "mixed", f"{tvl(30)}\n\n{en(30)}\n \n{tvl(25)}", "tvl"), ("q", "numbers", "12 34\n56", None)]
    rows += [("q", "blank", " ", None), ("q", "null", None, "tvl"), ("q", "long", tvl(60000), "mixed"), rows[0]]
    df = spark.createDataFrame(rows, "source_path string, segment_id string, text string, likely_language string")
    filters = language.fit(df)
    segments = {r.segment_id: r for r in language.segment_languages(df, filters).collect()}
    got = {(k, p.para_no): p.lang for k, r in segments.items() for p in r.paras}
    assert got["mixed", 1] == "tvl" and got["mixed", 2] == "en" and got["mixed", 3] == "tvl" and got["wrong", 1] == "tvl" and got["long", 1] == "tvl"
    assert not any(k[0] in ("numbers", "blank", "null") for k in got)
    assert (segments["none"].lang, segments["none"].mixed) == ("en", False) and (segments["mixed"].lang, segments["mixed"].mixed) == ("tvl", True)
    assert language.segment_languages(df.limit(0)).count() == 0


def test_bloom_filters_hold_all_their_grams():
    h = np.arange(1, 5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    has = np.where(np.arange(len(h)) % 2, 4, 1).astype(np.uint8)
    f = language.LanguageFilters.fit(h, has, language.LANGUAGES)
    mask = f.masks(h)
    assert (mask[::2] & 1).all() and (mask[1::2] >> 2 & 1).all() and np.mean(mask[::2] == 1) > 0.99


# --- p4


def brute_share(text: str) -> float:
    w = repetition._WORD.findall((text or "").lower())
    seen, cover = set(), set()
    for i in range(len(w) - 4):
        g = tuple(w[i : i + 5])
        if g in seen:
            cover.update(range(i, i + 5))
        seen.add(g)
    return len(cover) / len(w) if w else 0.0


def test_repeated_share_against_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        part = [prose(rng, rng.randint(3, 12)) for _ in range(4)]
        text = ". ".join(rng.choice(part) for _ in range(rng.randint(1, 20)))
        assert repetition.repeated_share(text) == pytest.approx(brute_share(text))
    assert repetition.repeated_share(None) == repetition.repeated_share("") == repetition.repeated_share("a b") == 0.0


def test_repetition(spark):
    rng = random.Random(7)
    rows = [(i, (prose(rng, 12) + ". ") * rng.randint(3, 9) if i % 4 == 0 else prose(rng, 120), "x") for i in range(200)]
    rows += [(900, None, "x"), (901, "", "x"), (902, (prose(rng, 8) + "\n\n") * 20000, "x"), (903, rows[0][1], "x"), (903, rows[0][1], "x")]
    df = spark.createDataFrame(rows, "id bigint, body_tvl string, estimate string")
    got = {r.id: r.repeated_share for r in repetition.repetition(df).collect()}
    want = {r[0]: brute_share(r[1]) for r in rows if r[0] != 902}
    assert {i for i, s in got.items() if s >= 0.25} == {i for i, s in want.items() if s >= 0.25} | {902}
    assert repetition.repetition(df.limit(0)).count() == 0


def test_overlap_counts_every_delivery(spark, tmp_path):
    same, other = " ".join(WORDS[:20]), " ".join(WORDS[20:40])
    rows = [("t", "train", "a", same), ("e", "test", "a", same), ("e", "test", "b", same), ("e", "test", "b", same), ("f", "validation", "b", other)]
    spark.createDataFrame([(i, t, None, "daily_text", s, f) for i, s, f, t in rows], "id string, tvl string, en string, content_type string, split string, source_file string").write.parquet(f"{tmp_path}/aligned_pairs.parquet")
    got = {tuple(r) for r in overlap.p1_counts(spark, str(tmp_path)).select("split", "source_file", "rows", "overlapping_rows", "pairs").collect()}
    assert got == {("test", "a", 1, 1, 1), ("test", "b", 1, 1, 1), ("validation", "b", 1, 0, 0)}


# --- p5


def test_alignment_finds_merges_omissions_and_order(spark):
    rng = random.Random(9)
    names = [f"Name{c}{d}" for c in "abcdefghij" for d in "klmnop"]
    lexicon = {w: f"en{i}q" for i, w in enumerate(WORDS)}
    documents = []
    for k in range(150):
        left, right, truth = [], [], []
        for _ in range(12):
            w = [rng.choice(WORDS) for _ in range(rng.randint(6, 12))] + [rng.choice(names)]
            a, b = " ".join(w) + ".", " ".join(lexicon.get(x, x) for x in w) + "."
            match rng.randrange(10):
                case 0:
                    left.append(a)
                case 1:
                    right.append(b)
                case 2 if right and truth and truth[-1][1] == len(right):
                    left.append(a)
                    right[-1] += " " + b
                    truth.append((len(left), len(right)))
                case _:
                    left.append(a)
                    right.append(b)
                    truth.append((len(left), len(right)))
        documents.append((f"p{k}", left, right, truth))
    rows = [(p, s, i, t, "x") for p, a, b, _ in documents for s, side in (("tvl", a), ("en", b)) for i, t in enumerate(side, 1)]
    rows += [("lone", "tvl", 1, "Ka te.", "x"), ("p0", "tvl", 99, None, "x"), ("p0", "en", 98, " ", "x"), (None, "en", 1, "x", "x"), rows[0]]
    df = spark.createDataFrame(rows, "pair_id string, side string, sent_no int, sentence string, tvl_no string")
    got = {(r.pair_id, r.tvl_no, r.en_no) for r in alignment.sentence_pairs(df).collect()}
    want = {(p, i, j) for p, _, _, t in documents for i, j in t}
    assert len(got & want) / len(want) > 0.97 and len(got & want) / len(got) > 0.97
    assert alignment.sentence_pairs(df.limit(0)).count() == 0


def test_alignment_knows_words_that_the_sample_lacks(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FIT_PAIRS", 30)
    rng = random.Random(12)
    ids = spark.createDataFrame([(f"q{k}",) for k in range(150)], "pair_id string").orderBy(F.xxhash64("pair_id"), "pair_id")
    ids = [r.pair_id for r in ids.collect()]
    rows, want = [], set()
    for k, p in enumerate(ids):
        rare = k >= 30 and k % 3 == 0  # a domain of its own, outside of the sample
        words = [w[::-1] if rare else w for w in WORDS]
        english = {w: f"e{'x' if rare else 'n'}{i}q" for i, w in enumerate(words)}
        for n in range(1, 11):
            w = [rng.choice(words) for _ in range(rng.randint(6, 12))]
            b = " ".join(english[x] for x in w) + "."
            rows.append((p, "tvl", n, " ".join(w) + "."))
            if n != 3:  # an omission
                rows.append((p, "en", n, b))
                if rare:
                    want.add((p, n, n))
    df = spark.createDataFrame(rows, "pair_id string, side string, sent_no int, sentence string")
    rare = {p for p, _, _ in want}
    got = {(r.pair_id, r.tvl_no, r.en_no) for r in alignment.sentence_pairs(df).collect() if r.pair_id in rare}
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.95


def test_alignment_learns_from_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(alignment, "FIT_PAIRS", 10)
    rng = random.Random(13)
    ids = spark.createDataFrame([(f"q{k}",) for k in range(200)], "pair_id string")
    few = {r.pair_id for r in sample(ids, 10, "pair_id").collect()}  # a domain of its own, in which the words mean something else
    assert 10 <= len(few) < 50
    rows, want = [], set()
    for p in (f"q{k}" for k in range(200)):
        english = {w: f"e{'x' if p in few else 'n'}{i}q" for i, w in enumerate(WORDS)}
        for n in range(1, 11):
            w = [rng.choice(WORDS) for _ in range(rng.randint(6, 12))]
            rows.append((p, "tvl", n, " ".join(w) + "."))
            if n != 3:  # an omission
                rows.append((p, "en", n, " ".join(english[x] for x in w) + "."))
                want.add((p, n, n))
    df = spark.createDataFrame(rows, "pair_id string, side string, sent_no int, sentence string")
    got = {(r.pair_id, r.tvl_no, r.en_no) for r in alignment.sentence_pairs(df).collect()}
    assert len(got & want) / len(want) > 0.95 and len(got & want) / len(got) > 0.95


def test_alignment_keeps_no_beads(spark):
    rows = [(f"p{k}", s, n, f"{s}{k % 7} word{n}.") for k in range(10) for s in ("tvl", "en") for n in range(1, 4)]
    documents = alignment._documents(spark.createDataFrame(rows, "pair_id string, side string, sent_no int, sentence string"))
    before = set(Path(shared_dir(spark)).glob("korale/beads-*"))
    alignment.fit(documents)
    assert set(Path(shared_dir(spark)).glob("korale/beads-*")) == before


# --- p6


def test_truncation_knows_words_that_a_sample_lacks(spark):
    ids = spark.range(8600).select(F.concat(F.lit("r"), "id").alias("id"))
    ids = [r.id for r in ids.orderBy(F.xxhash64("id"), "id").collect()]
    rng = random.Random(13)
    names = [f"zeli{a}{b}" for a in "abcdefghij" for b in "klmnop"]
    rows = [(i, f"te {rng.choice(WORDS)} ne {rng.choice(WORDS)} ki {names[k % 60] if k >= 8000 else rng.choice(WORDS)}.", "s") for k, i in enumerate(ids)]
    whole = {f"w{k}": f"te {rng.choice(WORDS)} ne {rng.choice(WORDS)} ki {w}" for k, w in enumerate(names)}
    rows += [(i, t, "s") for i, t in whole.items()] + [("cut", "te kana ne kana ki zel", "s")]
    df = spark.createDataFrame(rows, "id string, body string, src string")
    got = {r.id for r in truncation.truncated(df, "id", "body", "src").filter("cut").collect()}
    assert got == {"cut"}


def test_truncation_finds_the_limits_of_fields(spark):
    rng = random.Random(21)
    word = lambda: rng.choice(WORDS)
    sentence = lambda: f"te {word()} ne {word()} ki te {word()} o {word()}"
    texts = [". ".join(sentence() for _ in range(rng.randint(1, 7))) + "." for _ in range(3000)]
    rows = [(f"a{i}", t[:90], "narrow") for i, t in enumerate(texts)] + [(f"b{i}", t, "wide") for i, t in enumerate(texts)]
    rows += [("n", None, "narrow"), ("s", texts[0], None)]
    whole = {f"a{i}" for i, t in enumerate(texts) if len(t) <= 90 or t[89] == "."} | {f"b{i}" for i in range(3000)} | {"n", "s"}
    df = spark.createDataFrame(rows, "id string, body string, src string")
    got = {r.id for r in truncation.truncated(df, "id", "body", "src").filter("cut").collect()}
    cut = {r[0] for r in rows} - whole
    assert not got & whole and len(got & cut) > 0.9 * len(cut)


def test_open_marks():
    assert truncation.open_marks("“a (b) [c]” <p>x</p>") == []
    assert truncation.open_marks("“a (b") == ["“", "("]
    assert truncation.open_marks("<p>x <b") == ["<p", "�"] and truncation.open_marks("x &am") == ["�"] and truncation.open_marks("x\\u12") == ["�"]
    assert truncation.open_marks("") == []


def test_truncation(spark):
    rng = random.Random(10)
    nouns, verbs = [f"{a}{b}an" for a in "bcdfglmnprst" for b in ("ana", "oko", "ile", "umu")], [f"{a}{b}ed" for a in "bcdfglmnprst" for b in ("al", "ol", "ul")]
    sentence = lambda: f"The {rng.choice(nouns)} {rng.choice(verbs)} the {rng.choice(nouns)} of {rng.choice(('Lafo', 'Nui', 'Vao'))} with great care"
    whole = [". ".join(sentence() for _ in range(4)) + "." for _ in range(800)]
    rows = [(f"w{i}", t, "a", "x") for i, t in enumerate(whole)]
    rows += [("cut1", whole[0] + " The bana", "a", "x"), ("cut2", whole[1][:-1] + ". The banaan balled the", "a", "x"), ("cut3", whole[2] + " The balan of […]", "a", "x")]
    rows += [("cut4", whole[3] + " The ba�", "a", "x"), ("cut5", whole[4] + " “", "a", "x"), ("ok1", whole[5][:-1], "a", "x"), ("ok2", whole[6][:-1] + "...", "a", "x"), ("ok3", whole[7] + " — Lafo", "a", "x")]
    rows += [("ok4", whole[8] + " (page 4)", "a", "x"), ("null", None, "a", "x"), ("blank", " ", "a", "x"), ("src", whole[9], None, "x"), ("long", " ".join(whole) * 3 + " The ba", "a", "x"), ("cut1", whole[0] + " The bana", "a", "x")]
    df = spark.createDataFrame(rows, "id string, body string, src string, cut string")
    got = {r.id for r in truncation.truncated(df, "id", "body", "src").filter("cut").collect()}
    assert got == {"cut1", "cut2", "cut3", "cut4", "cut5", "long"}
    assert truncation.truncated(df.limit(0), "id", "body", "src").count() == 0


# --- p7


def test_packing_is_exact_and_tight(spark):
    rng = np.random.default_rng(2)
    for capacity in (1, 7, 256, 5000):
        sizes = rng.integers(1, capacity + 1, 3000)
        at = packing.pack(sizes, capacity)
        load = np.bincount(at, sizes)
        assert (at >= 0).all() and load.max() <= capacity and (load > 0).all()
    small = np.minimum(256, rng.lognormal(4, 0.8, 5000).astype(int) + 1)
    load = np.bincount(packing.pack(small, 256), small)
    assert small.sum() / (256 * len(load)) > 0.98
    assert len(packing.pack(np.zeros(0, int), 10)) == 0
    rows = spark.createDataFrame([(1, 1000), (2, 300), (3, 0), (4, 256)], "doc_id bigint, n_tokens bigint")
    sets = spark.createDataFrame([("s", 256), ("s", 256), ("z", 0), (None, None)], "container_set string, capacity_tokens int")
    got = packing.containers(rows, sets, 4).toPandas()
    assert got.groupby("doc_id").n_tokens.sum().to_dict() == {1: 1000, 2: 300, 4: 256}
    assert got.groupby("container_id").n_tokens.sum().max() <= 256 and got[got.doc_id == 4].piece_no.tolist() == [1]
    assert packing.containers(rows.limit(0), sets, 0).count() == 0 and packing.containers(rows, sets.limit(0), 4).count() == 0


def test_token_sizes(spark):
    long = "te fale " * 60000
    rows = [(1, "Talofa koutou", "a", "x"), (1, "Talofa", "a", "x"), (2, None, None, "x"), (3, "", "b", "x"), (None, "x", "a", "x"), (4, long, "a", "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in tokens.token_sizes(df.drop("n_tokens"), keep=("source",)).collect()}
    enc = tokens.encoder(open(tokens.RANKS, "rb").read())
    assert got == {1: len(enc.encode_ordinary("Talofa koutou")), 2: 0, 3: 0, 4: len(enc.encode_ordinary(long))}


# --- p8


def test_split_blocks_uses_every_block_once():
    blocks = np.array([100, 7, 0, 33])
    for whole in (1, 3, 9):  # whatever is split beforehand
        nodes = mixing.nodes(blocks, 9, [3], whole)
        dealt = [leaf for node in nodes for leaf in mixing.leaves(*node, [3])]
        got = np.array([n for _, n, _ in dealt])
        assert [s for s, _, _ in dealt] == list(range(9)) and (got.sum(axis=0) == blocks).all() and got.sum(axis=1).max() - got.sum(axis=1).min() <= 2
        assert all((first == got[:s].sum(axis=0)).all() for s, _, first in dealt)  # runs of blocks follow each other


def test_splitting_of_many_blocks():
    blocks = np.array([3_000_000_000, 1_000_000_007, 5])
    (_, a, _), (_, b, _) = mixing.leaves(0, 2, blocks, blocks * 0, [1])
    assert (a + b == blocks).all() and abs(int(a.sum()) - int(b.sum())) < 1e6 and abs(a[0] / blocks[0] - 0.5) < 0.01
    got = mixing.nodes(np.array([61_000_000, 1000]), 500_000, [1], 500_000 // 4096)
    assert len(got) <= 2 * 4096 * 2 and min(n.sum() / k for _, k, n, _ in got) > 100  # no node without blocks


def test_mixture(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(("a", "a", "a", "b")), rng.randint(50, 400)) for i in range(2000)] + [(5000, "tiny", 300), (5001, None, 10), (5002, "a", 0)]
    sizes = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    mixes = spark.createDataFrame([("m", "a", 0.5, 2), ("m", "b", 0.5, 3), ("m", "gone", 0.2, 1), ("m", None, 0.1, 1), ("n", "tiny", 1.0, 4), ("n", "b", None, 1)], "mix_name string, source_name string, target_share double, max_repeats int")
    got = mixing.mixture(sizes, mixes).toPandas()
    m = got[got.mix_name == "m"]
    share = m.groupby("source").n_tokens.sum() / m.n_tokens.sum()
    assert share["a"] == pytest.approx(0.5, abs=0.01) and not m.duplicated(["doc_id", "copy_no"]).any()
    assert m[m.source == "b"].groupby("doc_id").size().max() <= 3 and m[m.source == "a"].groupby("doc_id").size().max() <= 2
    assert len(got[got.mix_name == "n"]) == 4
    for _, g in got.groupby(["mix_name", "shard"]):
        assert sorted(g.position) == list(range(1, len(g) + 1))
    assert mixing.mixture(sizes.limit(0), mixes).count() == 0 and mixing.mixture(sizes, mixes.limit(0)).count() == 0


# --- p9


def test_subjects(spark):
    rng = random.Random(12)
    own = {s: [f"{s[:3]}{w}" for w in WORDS[:25]] for s in ("law", "sport", "health", "art", "food", "trade")}
    common = [f"gen{w}" for w in WORDS]

    def sentence(s):
        w = [rng.choice(common) for _ in range(6)]
        return " ".join(w[:3] + ([rng.choice(own[s]), rng.choice(own[s])] if s else []) + w[3:]).capitalize() + "."

    docs, labels, truth = [], [], {}
    for i in range(600):
        plan = rng.choice(([("law", 8)], [("sport", 8)], [("health", 8)], [("art", 8)], [("food", 8)], [("trade", 8)], [("law", 4), ("sport", 4)], [(None, 8)], [("law", 11), ("health", 1)]))
        text = " ".join(sentence(s) for s, n in plan for _ in range(n))
        docs.append((i, text, "x"))
        truth[i] = {s for s, n in plan if s and n > 2}
        if i < 400:
            labels += [(i, s) for s in truth[i]]
    labels += [labels[0], (599, None), (12345, "law")]
    docs += [(900, None, "x"), (901, " ", "x"), (902, docs[0][1] * 300, "x"), docs[0]]
    d = spark.createDataFrame(docs, "doc_id bigint, text string, subject string")
    lab = spark.createDataFrame(labels, "doc_id bigint, subject string")
    terms = spark.createDataFrame([("law", "lawkana"), ("law", None)], "subject string, term string")
    got: dict[int, set] = {}
    for r in subjects.document_subjects(d, lab, terms).filter(F.col("share") >= subjects.SHARE).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    right = sum(got.get(i, set()) == truth[i] for i in range(600))
    assert right > 570 and got.get(902, set()) == truth[0] and 900 not in got and 901 not in got
    assert subjects.document_subjects(d.limit(0), lab.limit(0), terms.limit(0)).count() == 0
    assert subjects.document_subjects(d, lab.limit(0), terms.limit(0)).count() == 0
    assert subjects.document_subjects(d, lab, terms.limit(0)).count() > 0


def test_long_repeated_sentences_are_mined_at_the_cost_of_their_pairs(spark):
    words = " ".join(f"rare{a}{b}" for a in WORDS[:8] for b in WORDS[:5])  # 40 words
    docs = [(i, f"{words}. " if i % 2 else f"plain {WORDS[i % 40]} text.") for i in range(200)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    lab = spark.createDataFrame([(i, "law" if i % 2 else "art") for i in range(200)], "doc_id bigint, subject string")
    terms = spark.createDataFrame([], "subject string, term string")
    rules = subjects.mine(d, lab, terms)
    assert len([w for w in rules.single if w.startswith("rare")]) == 40


# --- all queries


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_runs(spark, sf, name):
    got = queries.queries()[name](spark, sf).toPandas()
    assert isinstance(got, pd.DataFrame)
    if name.endswith("_found"):
        assert not got.duplicated().any()
