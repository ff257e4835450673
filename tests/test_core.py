from __future__ import annotations

import hashlib
import math
import os
import random
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from korale.functions import folding
from korale.functions import text as tx
from korale.functions import urls
from korale.operators import chat, cleaning, collapse, documents, feedback, metrics, pairing, protect, selection, splitting
from korale.plans import corpus
from korale.sources import chats as chat_sources
from korale.sources import tables as src
from korale.streaming import ingest


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if v is None or isinstance(v, str) else 'int' if isinstance(v, int) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("r")).first().r


def test_folding_agrees_on_both_sides(spark):
    texts = ["ʻĀTU’i &lsquo;mō​na-se", "", "Plain text, 12!", "x̄ ÉTÉ \xad soft", "&amp;lsquo;fale"]
    got = [r.f for r in spark.createDataFrame([(t,) for t in texts], "t string").select(folding.folded(F.col("t")).alias("f")).collect()]
    assert got == [" ".join(folding.words(t)) for t in texts]
    assert folding.words(None) == []


def test_normalize_text(spark):
    n = lambda t: one(spark, tx.normalize_text(F.col("t")), t=t)
    assert n("  a  b​c &amp;lt; d.Next  ") == "a bc < d. Next"
    assert n("Text (;w18.067 ¶16) goes on () —Read.") == "Text goes on"
    assert n("it's ʻa’") == "it‵s ‵a‵"
    assert n(". . lead") == "lead"
    assert n("") == "" and n(None) is None


@pytest.mark.parametrize("m", [97, 10000, 3])
def test_bucket_is_the_digest_modulo(spark, m):
    for key in ("", "doc_1", "ʻā"):
        assert one(spark, tx.bucket(F.col("k"), m), k=key) == int(hashlib.sha256(key.encode()).hexdigest(), 16) % m


def test_ngrams_and_tokens(spark):
    words = tx.tokens(F.lower(tx.squeeze(F.col("t"))))
    assert one(spark, tx.comparison_form(F.col("t")), t=" A\xa0 B a\u0304 ") == "a b ā"
    assert one(spark, tx.ngrams(words, 2), t="A b  a B") == ["a b", "b a"]
    assert one(spark, tx.ngrams(words, 5), t="a b") == []
    assert one(spark, words, t="") == []


def test_paragraphs(spark):
    assert one(spark, tx.paragraphs(F.col("t")), t="<P class='x'>One <b>two</b></P><p>  </p><p>three</p>") == ["One two", "three"]
    assert one(spark, tx.paragraphs(F.col("t")), t="a\n\n\nb\n\n") == ["a", "b"]


PAIR = "id string, source_file string, source_line bigint, ingested_at timestamp_ntz, content_type string, domain string, pub_code string, text_date string, tvl string, en string"


def test_clean_first_reason_and_duplicates(spark):
    long = "word " * 10
    rows = [
        ("a", "f", 1, None, "article_paragraph", None, None, None, long, long + "x"),
        ("a", "f", 2, None, "article_paragraph", None, None, None, "other text here", "other words here"),
        ("b", "f", 3, None, "article_paragraph", None, None, None, long.upper(), long + "x"),
        ("c", "f", 4, None, "article_paragraph", None, None, None, None, "x"),
        ("d", "f", 5, None, "article_paragraph", None, None, None, "[Picture on page 3]", long),
        ("e", "f", 6, None, "article_paragraph", None, None, None, "same text on both", "same text on both"),
        ("g", "f", 7, None, "article_paragraph", None, None, None, "short", long),
        ("h", "f", 8, None, "word", None, None, None, "fale", "house"),
        ("i", "f", 9, None, "bible_verse", None, None, None, long * 3, long),
        ("j", "f", 10, None, "article_paragraph", None, "sjj", None, "a song line here", "a song line there"),
        ("k", "f", 11, None, None, None, None, None, "no type is given", "no type was given"),
    ]
    got = {(r.id, r.source_line): r.reason for r in cleaning.clean(spark.createDataFrame(rows, PAIR)).collect()}
    assert got == {
        ("a", 1): None, ("a", 2): "duplicate_id", ("b", 3): "duplicate_content", ("c", 4): "empty_text", ("d", 5): "metadata", ("e", 6): "identical_pair",
        ("g", 7): "too_short", ("h", 8): None, ("i", 9): "bad_ratio", ("j", 10): "song_lyrics", ("k", 11): None,
    }
    assert cleaning.clean(spark.createDataFrame([], PAIR)).count() == 0


def test_boilerplate_counts_all_rows(spark):
    rows = [(str(i), "f", i, None, "article_paragraph", None, None, None, f"distinct text number {i}", "the same english line") for i in range(11)]
    got = {r.reason for r in cleaning.clean(spark.createDataFrame(rows, PAIR)).collect()}
    assert got == {"boilerplate_en"}
    assert {r.reason for r in cleaning.clean(spark.createDataFrame(rows[:10], PAIR)).collect()} == {None}


def test_contamination_levels(spark):
    held = [("h1", "one two three four five six seven eight nine ten eleven", "short verse of five words"), ("h2", "x", "y")]
    train = [
        ("t1", "ONE two  three four five six seven eight nine ten eleven", "nothing"),
        ("t2", "zero one two three four five six seven eight nine ten", "nothing at all"),
        ("t3", "abc", "a short verse of five letters"),
        ("t4", "clean", "clean words only"),
        ("t5", "", None),
    ]
    schema = "id string, tvl string, en string"
    got = {(r.id, r.side, r.level) for r in splitting.contamination(spark.createDataFrame(train, schema), spark.createDataFrame(held, schema)).collect()}
    assert got == {("t1", "tvl", "exact_match"), ("t2", "tvl", "ngram_overlap"), ("t3", "en", "high_containment")}


def test_decontamination_checks_all_train_rows(spark, tmp_path):
    verse = "one two three four five six seven eight nine ten eleven"
    rows = [
        ("h1", "bible_verse", "test", verse, "short verse of five words"),
        ("h2", "daily_text", "validation", "held daily text", "a b c d e f g h i j k"),
        ("t1", "article_paragraph", "train", "zero " + verse, "clean"),
        ("t2", "daily_text", "train", "abc", "a short verse of five letters"),
        ("t3", "translation_phrase", "train", "Held  daily text", "clean"),
        ("t4", "word", "train", "clean", verse),
        ("t5", None, "train", "short verse of five letters", "x short verse of five y"),
        ("t6", "article_paragraph", "train", "short verse of five letters", "x a b c d e f g h i j k"),
        ("v1", "bible_verse", "train", "zero " + verse, "short verse of five letters"),
        ("v2", "bible_verse", "train", "held daily text", "clean"),
        ("t7", "daily_text", "train", None, "clean words only"),
    ]
    spark.createDataFrame(rows, "id string, content_type string, split string, tvl string, en string").write.parquet(f"{tmp_path}/aligned_pairs.parquet")
    got = {r.id: (r.split, r.levels) for r in corpus.g05(spark, str(tmp_path)).collect()}
    bad = {"t1": "ngram_overlap", "t2": "high_containment", "t3": "exact_match", "t4": "exact_match", "t5": "high_containment", "v2": "exact_match"}
    assert got == {r[0]: ("quarantined", bad[r[0]]) if r[0] in bad else ("train", "") for r in rows if r[2] == "train"}


def test_budget_prefix_against_brute_force(spark):
    rows = [(f"k{i}", (i * 37) % 50 + 1) for i in range(300)]
    order = sorted(rows, key=lambda r: hashlib.sha256(r[0].encode()).hexdigest())
    for budget in (0, 1, 500, 3000, 10**6):
        want, total = set(), 0
        for k, n in order:
            if want and total + n > budget:
                break
            total += n
            want.add(k)
        got = {r.k for r in splitting.budget_prefix(spark.createDataFrame(rows, "k string, n int"), "k", F.col("n"), budget).collect()}
        assert got == want


def test_share_cap(spark):
    rows = [(f"k{i}", i % 3 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, c boolean")
    got = splitting.cap_share(df, F.col("c"), "k", 0.2).collect()
    assert sum(r.c for r in got) == math.floor(0.2 / 0.8 * 200) and sum(not r.c for r in got) == 200
    assert splitting.cap_share(df.filter("c"), F.col("c"), "k", 0.2).count() == 100


def test_collapse_signals():
    loop = "te tala o te fale " * 40
    assert collapse.score(loop) > 0.75 and collapse.signals(loop)["unique"] and collapse.signals(loop)["phrase"]
    varied = " ".join(f"w{i}" for i in range(200))
    assert collapse.score(varied) < 0.01 and not any(collapse.signals(varied).values())
    tail = varied + " " + "again and again we go " * 20
    assert collapse.signals(tail)["tail"]
    assert collapse.score(None) == 0.0 and not any(collapse.signals("").values())


def test_best_attempt(spark):
    rows = [(1, "a", 1, 1), (2, "a", 2, 0), (3, "a", 3, 0), (4, "b", 1, 1), (5, "b", 2, 1), (6, "c", 1, None)]
    df = spark.createDataFrame(rows, "id int, article string, n int, bad int")
    assert {(r.article, r.id) for r in collapse.best_attempt(df, "article", "n", F.col("bad") == 1).collect()} == {("a", 2), ("b", 5), ("c", 6)}


def test_chat_rendering(spark):
    pairs = spark.createDataFrame([("r1", "fale", "house", "word", None), ("r2", "a\n b\t c" * 9, "x y z " * 20, "article_paragraph", "book")], "id string, tvl string, en string, content_type string, domain string")
    got = {r.id: r for r in chat.render(pairs).collect()}
    assert set(got) == {"r1::tvl_to_en", "r1::en_to_tvl", "r2::tvl_to_en", "r2::en_to_tvl"}
    assert got["r1::tvl_to_en"].vocab and "fale" in got["r1::tvl_to_en"].messages[1].content and got["r1::tvl_to_en"].messages[2].content == "house"
    assert not got["r2::en_to_tvl"].vocab and "\n" in got["r2::en_to_tvl"].messages[2].content
    prompt, completion = chat.prompt_completion(F.col("messages"))
    r = chat.render(pairs).filter("id = 'r1::tvl_to_en'").select(prompt.alias("p"), completion.alias("c")).first()
    assert r.c == "house" and r.p.startswith("system: ")


def test_chat_without_answer(spark):
    df = spark.createDataFrame([([Row(role="user", content="hi")],)], "messages array<struct<role:string,content:string>>")
    prompt, completion = chat.prompt_completion(F.col("messages"))
    assert df.select(prompt, completion).first() == ("user: hi", "")
    assert df.select(chat.task_family(F.col("messages"))).first()[0] == "chat"


def test_metrics():
    same = metrics.sentence_counts("The cat sat on the mat.", "The cat sat on the mat.")
    assert round(metrics.chrf(same), 4) == 100.0 and round(metrics.bleu(same), 4) == 100.0 and same[-1] == 1
    none = metrics.sentence_counts("xyz", "abc def")
    assert metrics.chrf(none) == 0.0 and metrics.bleu(none) == 0.0
    empty = metrics.sentence_counts("", "")
    assert metrics.bleu(empty) == 0.0 and len(empty) == metrics.WIDTH
    # two of three words, one of two bigrams
    part = metrics.sentence_counts("a b x", "a b c")
    assert 0 < metrics.bleu(part) < 100 and 0 < metrics.chrf(part) < 100


def test_language_guess(spark):
    guess = lambda t, p=None: one(spark, documents.guess_language(F.col("t"), F.col("p")), t=t, p=p)
    assert guess("te tagata kae ko te fenua") == "tvl"
    assert guess("the report of the committee") == "en"
    assert guess("the of te ko") == "mixed"
    assert guess("xyz") == "unknown" and guess("") == "unknown" and guess(None) == "unknown"
    assert guess("xyz", "docs/a_tvl.pdf") == "tvl"


def test_islands_and_bundles(spark):
    rows = spark.createDataFrame([("g", i, x) for i, x in enumerate("aabbba")], "g string, n int, l string")
    got = [(r.island, r.label, r.lines) for r in documents.islands(rows, "g", "n", F.col("l")).orderBy("island").collect()]
    assert got == [(1, "a", 2), (2, "b", 3), (3, "a", 1)]
    seg = spark.createDataFrame([("d", "d#2", "y" * 40, "4"), ("d", "d#1", "x" * 40, "x3"), ("d", "d#1", "x" * 40, "x3"), ("d", "d#3", "short", "9")], "doc_id string, segment_id string, text string, page_or_image string")
    r = documents.bundles(seg).first()
    assert (r.segments, r.first_page, r.last_page) == (2, 4, 4) and r.text.startswith("x")


def test_feedback_events(spark):
    art = spark.createDataFrame([("a", "one\n\ntwo")], "id string, body_en string")
    fb = spark.createDataFrame([(1, "a", 1, "thumbs_up", "s", None, None), (2, "a", 7, "thumbs_down", "s", " ", None), (3, "zz", 0, None, None, "Nui", None)], "id int, article_id string, paragraph_idx int, feedback_type string, session_id string, island string, created_at timestamp_ntz")
    got = {r.id: (r.score, r.known, r.paragraph_en) for r in feedback.events(fb, art).collect()}
    assert got == {1: (1, True, "two"), 2: (0, True, None), 3: (0, False, None)}


def test_search_escapes_and_guards(spark):
    art = spark.createDataFrame([("a", "100% coach", "b", None), ("b", "100 coaches", "b", None)], "id string, title_en string, body_en string, published_at timestamp_ntz")
    tr = spark.createDataFrame([(1, "a", None, None, 0), (2, "b", None, None, None)], "id int, article_id string, title_tvl string, body_tvl string, is_collapsed int")
    assert [r.id for r in feedback.search(art, tr, "100%", 5).collect()] == ["a"]
    assert feedback.search(art, tr, "x", 5).count() == 0


def test_sources(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": "1"}\n\nnot json\n{"id": "2"}\n', encoding="utf-8")
    good, bad = src.read_records(spark, str(tmp_path), T.StructType([T.StructField("id", T.StringType())]))
    assert sorted((r.id, r.source_file, r.source_line) for r in good.collect()) == [("1", "a", 1), ("2", "a", 4)]
    assert [(r.source_line, r.line) for r in bad.collect()] == [(3, "not json")]
    (tmp_path / "t.tsv").write_text("house\tfale\nbad line\nx\ty\n", encoding="utf-8")
    pairs, rejected = src.read_pairs_tsv(spark, str(tmp_path / "t.tsv"))
    assert [(r.en, r.tvl) for r in pairs.collect()] == [("house", "fale")] and sorted(r.reason for r in rejected.collect()) == ["bad_columns", "too_short"]
    (tmp_path / "s.xml").write_text("<urlset><url><loc>http://x/a</loc><lastmod>2024-01-01</lastmod></url></urlset>", encoding="utf-8")
    assert src.read_sitemap(spark, str(tmp_path / "s.xml")).first().loc == "http://x/a"
    assert one(spark, src.front_matter(F.col("t")), t='---\ntitle: "A: b"\ndraft: true\n---\nbody') == {"title": "A: b", "draft": "true"}
    assert src.dataset_name(src.file_name("org/name__x")) == "org/name__x"
    (tmp_path / "qa.json").write_text('{"question": "q", "answer": "a"}\n{"question": "", "answer": "a"}\n', encoding="utf-8")
    rows = chat_sources.LOADERS.load("word_problems", spark, str(tmp_path / "qa.json")).collect()
    assert len(rows) == 1 and rows[0].messages[1].content == "a"


def test_upsert_and_insert(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 3, "y"), ("b", 2, "y"), ("c", 1, "y")], "k string, v int, w string")
    assert {(r.k, r.v, r.w) for r in src.upsert(old, new, "k", "v").collect()} == {("a", 3, "y"), ("b", 2, "y"), ("c", 1, "y")}
    assert [r.k for r in src.insert_new(old, new, "k").collect()] == ["c"]


def test_streaming(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    spark.createDataFrame([("a", 5)], "k string, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.tail_parquet(spark, str(tmp_path / "in"), rows.schema)
    ingest.upsert_sink(stream, str(tmp_path / "out"), "k", "v", str(tmp_path / "cp")).awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out/v{ingest.current(str(tmp_path / 'out'))}")
    assert {(r.k, r.v) for r in out.collect()} == {("a", 5), ("b", 2)}
    os.makedirs(tmp_path / "json")
    (tmp_path / "json/x.json").write_text('{"k": "a", "v": 1}\n{"k": "b"', encoding="utf-8")
    tail = ingest.tail_json(spark, str(tmp_path / "json"), rows.schema)
    assert ingest.run_to_end(tail, "tailed", "append", str(tmp_path / "cp2")).count() == 1


def test_masks_round_trip(spark):
    texts = ["Use `x = 1` and ```py\ncode {a}\n``` at https://a.b/c?d {name} $5 call(x) snake_case 12px", "plain words", "", None, '{"a": {"b": [1]}} <b>x</b>']
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", protect.mask_spans("t").alias("m"))
    got = df.select("t", "m.masked", "m.spans", protect.unmask(F.col("m.masked"), F.col("m.spans")).alias("u")).collect()
    assert [r.u for r in got] == texts and len(got[0].spans) >= 6 and "code" not in got[0].masked and got[1].masked == "plain words"
    assert protect.problems("a long original text", "__PH_000__ {bad json}") == ["placeholder_leak", "invalid_json"]
    assert protect.problems("```a```", "```b```") == ["code_block_mismatch"] and protect.problems("a long original text", "x") == ["length_ratio"] and protect.problems(None, None) == []


def brute_pack(text: str) -> str:
    parts = re.split(r"(?<=[.!?])\s+(?=[A-ZĀĒĪŌŪ\"“])", text)
    if "\n\n" in text or len(text.split()) <= 100 or len(parts) <= 1:
        return text
    out, now = [], []
    for s in parts:
        now.append(s)
        if sum(len(x.split()) for x in now) >= 100:
            out.append(" ".join(now))
            now = []
    if now:
        if out and sum(len(x.split()) for x in now) < 33:
            out[-1] += " " + " ".join(now)
        else:
            out.append(" ".join(now))
    return "\n\n".join(out)


def test_paragraph_packing(spark):
    rng = random.Random(1)
    texts = [" ".join(" ".join(["Word"] + ["word"] * rng.randint(3, 30)) + "." for _ in range(n)) for n in (1, 3, 8, 12, 20, 33)] + ["", "a\n\nb"]
    got = [r.p for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(urls.split_paragraphs(F.col("t")).alias("p")).collect()]
    assert got == [brute_pack(t) for t in texts]


def test_urls(spark):
    get = lambda f, u: one(spark, f(F.col("u")), u=u)
    assert get(urls.article_id, "https://x.y/football/news/11661/13500000/some-slug") == "13500000" and get(urls.article_id, "https://x.y/a/123456/b") == "123456"
    assert get(urls.article_id, "https://x.y/a") is None and get(urls.section_id, "https://x.y/football/news/11661/1/s") == "11661"
    assert get(urls.swap_resolution, "http://a/26/2048x1152/b/1x1/c") == "http://a/26/1600x900/b/1x1/c" and get(urls.relative, "https://a.b/c/d") == "/c/d"
    assert get(lambda u: urls.kind(u, [("a", "/a/"), ("b", "/")]), "x/a/") == "a"


def test_macrons(spark):
    words_ = spark.createDataFrame([("fālē",), ("tala",), ("tālā",), ("Mōū",), ("two wōrds",)], "tvl string")
    forms = pairing.macron_map(words_)
    assert {(r.bare, r.form) for r in forms.collect()} == {("fale", "fālē"), ("mou", "mōū")}
    rows = spark.createDataFrame([(1, "Fale, FALE tala!"), (2, "no  change"), (3, None)], "id int, t string")
    assert {r.id: r.t for r in pairing.correct_macrons(rows, "id", "t", forms).collect()} == {1: "Fālē, FĀLĒ tala!", 2: "no  change", 3: None}


def test_pairing(spark):
    rows = [("a", "tvl", 1, "x" * 10), ("a", "en", 1, "y" * 20), ("b", "tvl", 1, "x" * 60), ("b", "en", 1, "y" * 30), ("b", "en", 2, "y" * 30), ("c", "tvl", 1, "x")]
    got = {(r.g, r.place): r.confidence for r in pairing.by_place(spark.createDataFrame(rows, "g string, s string, n int, t string"), "g", "s", "n", "t").collect()}
    assert got == {("a", 1): 0.75, ("b", 0): 0.4}
    lines = [("g", i, lang, f"{lang}{i}") for i, lang in enumerate(["en", "tvl", "en", "en", "tvl", "tvl"])]
    pairs = {(r.tvl, r.en) for r in pairing.alternating(spark.createDataFrame(lines, "g string, n int, l string, t string"), "g", "n", "l", "t").collect()}
    assert pairs == {("tvl1", "en0"), ("tvl4", "en3")}
    numbered = [("g", "en", "1. one"), ("g", "tvl", "1) tasi"), ("g", "en", "2 two"), ("g", "tvl", "none")]
    assert [(r.number, r.en, r.tvl) for r in pairing.by_number(spark.createDataFrame(numbered, "g string, s string, t string"), "g", "s", "t").collect()] == [(1, "1. one", "1) tasi")]


def test_allocation():
    assert selection.allocate({"a": 1000, "b": 100, "c": 50}, {"a": 0.4, "b": 0.4, "c": 0.2}) == {"a": 1000, "b": 100, "c": 50}
    assert selection.allocate({}, {"a": 1.0}) == {"a": 0} and selection.allocate({"a": 5}, {}) == {}
    with pytest.raises(ValueError):
        selection.origin_allowed(None, "none", {})


def test_events_of_articles(spark):
    rows = spark.createDataFrame([(1, "a", "yes", None), (2, "a", "0", "better text"), (3, "b", None, " ")], "id int, article_id string, helpful string, correction string")
    got = sorted((r.id, r.event_type, r.score, r.helpful) for r in feedback.with_corrections(feedback.article_events(rows)).collect() if r.score is not None or r.event_type == "correction")
    assert got == [(1, "article_feedback", 1.0, True), (2, "article_feedback", 0.0, False), (2, "correction", None, None)]
    v = spark.createDataFrame([(1, "p"), (2, "q"), (3, "r")], "id int, prompt_id string")
    p = spark.createDataFrame([("p", "?", '["a", "b"]'), ("q", "?", "raw")], "prompt_id string, question string, options_json string")
    assert {r.id: r.options for r in feedback.votes(v, p).collect()} == {1: ["a", "b"], 2: ["raw"], 3: None}


def test_negatives(spark):
    rows = spark.createDataFrame([(1, "Ne fano a Sione Lama i te 12 aso", None), (2, "seai", "The report says so. It is long. More."), (3, "seai se tino", None)], "id int, chosen string, paired string")
    got = {r.id: (r.rejected, r.tags) for r in documents.negatives(rows, "chosen", "paired").collect()}
    assert got[1][1] == ["entity_drop", "dropped_numbers_dates", "english_leakage"] and "12" not in got[1][0]
    assert got[2] == ("The report says so. It is long.", ["wrong_language", "translationese"]) and got[3][1] == ["unsupported_hallucination", "english_leakage"]


def test_entity_rows_have_dates_and_places(spark):
    text = "Ne fano a Sione Lama ki funafuti i te 12 Iulai 1978 mai Nui. I a Mati 2001 ne foki mai vaitupu; 1978 e 45%."
    rows = spark.createDataFrame([("d", text), ("e", "seai")], "doc_id string, text string")
    got: dict = {}
    for r in documents.entity_rows(rows).orderBy("doc_id", "kind", "place").collect():
        got.setdefault((r.doc_id, r.kind), []).append(r.value)
    assert got["d", "date"] == ["12 Iulai 1978", "Mati", "2001", "1978"]
    assert got["d", "entity"] == ["Sione Lama", "Iulai", "Nui", "Mati", "Funafuti", "Vaitupu"]
    assert got["d", "number"] == ["12", "1978", "2001", "45%"] and not any(k[0] == "e" for k in got)
    many = " ".join(str(1900 + k) for k in range(20))
    assert documents.entity_rows(spark.createDataFrame([("m", many)], "doc_id string, text string")).filter("kind = 'date'").count() == 12
