"""Small cases of the core: nulls, blanks, ties, empty tables, clashing columns."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from korale.functions import markup
from korale.functions import strings as st
from korale.functions import text as tx
from korale.operators import chat, cleaning, evaluation, feedback, integrity, pairing, postprocess, protect, rules, selection, splitting, tasks
from korale.session import sample
from korale.sources import chats, tables

PAIR = "id string, split string, content_type string, doc_id string, book_num int, text_date string, source_file string, source_line bigint, tvl string, en string"


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


# --- protected spans


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ("Here is code:\n```python\nprint('hello')\n```\nDone.", ["```python\nprint('hello')\n```"]),
        ("Visit https://example.com/api/v2 for docs.", ["https://example.com/api/v2"]),
        ("Hello {name}, your id is {user_id}.", ["{name}", "{user_id}"]),
        ('It is {"key": "a } b", "num": [1, {"x": 2}]} here.', ['{"key": "a } b", "num": [1, {"x": 2}]}']),
        ("The equation is $$E = mc^2$$ as shown.", ["$$E = mc^2$$"]),
        ("<b>bold</b> <br/> <id>", ["<b>bold</b>", "<br/>", "<id>"]),
        ("plain words only, and 3 of them", []),
        ("an open { brace and ` tick", []),
        ("", []),
    ],
)
def test_spans(text, spans):
    masked, found = protect.mask(text)
    assert list(found.values()) == spans
    for name, span in found.items():
        masked = masked.replace(name, span)
    assert masked == text


def test_many_spans_and_mangled_placeholders(spark):
    text = " ".join(f"`c{i}`" for i in range(1200))
    masked, found = protect.mask(text)
    assert len(found) == 1200 and "__PH_1199__" in masked
    rows = spark.createDataFrame([("see _ _PH_000_ _ and __PH_001__", {"__PH_000__": "A", "__PH_001__": "B"}), (None, {}), ("x", {})], "t string, s map<string,string>")
    assert [r.x for r in rows.select(protect.unmask(F.col("t"), F.col("s")).alias("x")).collect()] == ["see A and B", None, "x"]


def test_json_structure_and_chat_problems():
    assert protect.json_preserved('{"a": 1, "b": [1, 2]}', '{"b": [3, 4], "a": 9}')
    assert not protect.json_preserved('{"a": 1}', '{"a": "1"}') and not protect.json_preserved('{"a": 1', '{"a": 1}') and not protect.json_preserved(None, "1")
    m = lambda role, content: {"role": role, "content": content}
    assert protect.example_problems([m("user", "a")], []) == ["message_count_mismatch: 1 vs 0"]
    assert protect.example_problems([m("user", "some words here")], [m("assistant", "x")]) == ["role_mismatch[0]: user vs assistant", "length_ratio[0]"]
    assert protect.example_problems(None, None) == []


def test_selective_translation(spark):
    rows = [("a", [("user", "Fix ```x = 1``` now"), ("tool", "raw"), ("assistant", None)]), ("b", []), ("c", [("critic", "keep"), ("system", '{"type": "function"}')])]
    df = spark.createDataFrame(rows, "id string, messages array<struct<role:string,content:string>>")
    got = {r.id: ([m.content for m in r.messages], r.protected_spans) for r in protect.translate_messages(df, F.upper).collect()}
    assert got["a"] == (["FIX ```x = 1``` NOW", "raw", None], 1) and got["b"] == ([], 0) and got["c"] == (["keep", '{"type": "function"}'], 0)
    assert protect.translate_messages(df.limit(0), F.upper).count() == 0


# --- chats


@pytest.mark.parametrize(
    ("text", "family"),
    [("The answer is 4", "math"), ("Give the highlights", "summarization"), ("a translation please", "translation"), ("in class today", "chat"), ("import goods", "chat"), ("def f(x)", "code"), ("a tool_call", "tool")],
)
def test_task_families(spark, text, family):
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("t").alias("content")))
    assert one(spark, chat.task_family(messages), t=text) == family
    assert one(spark, chat.task_family(messages, F.lit("qa")), t=text) == "qa" and one(spark, chat.task_family(messages, F.lit("poetry")), t=text) == family


def test_chat_sources(spark, tmp_path):
    lines = [
        {"id": "chat-1", "thread_id": "thread-1", "messages": [{"role": "user", "content": "Talofa"}, {"role": "assistant", "content": "Malo ni"}], "metadata": {"is_private": "true"}},
        {"id": "chat-2", "conversation_id": "conv-9", "prompt": "Can you help?", "completion": "Ioe.", "language_mode": "mixed"},
        {"user": "no answer", "assistant": ""},
        {"messages": [{"role": "user", "content": "last turn is a question"}]},
        {"user": "q", "assistant": "a"},
    ]
    (tmp_path / "p.jsonl").write_text("\n".join(map(json.dumps, lines)), encoding="utf-8")
    got = {r.id: r for r in chats.LOADERS.load("private_chats", spark, str(tmp_path / "p.jsonl")).collect()}
    assert set(got) == {"chat-1", "chat-2", "private-4"}
    assert got["chat-1"].metadata["split_group"] == "thread-1" and got["chat-1"].metadata["language_mode"] == "tvl" and got["chat-2"].metadata["language_mode"] == "mixed"
    built = chats.build(spark, {"stories": str(tmp_path / "p.jsonl"), "agent_tasks": "x", "nothing": "x", "programs": str(tmp_path / "missing")})
    assert {k: v[0] for k, v in built.items()} == {"stories": "ok", "agent_tasks": "not_implemented", "nothing": "error", "programs": "error"}
    assert built["stories"][1].count() == 0
    calls = spark.createDataFrame([(0, "q", "[1]", "no json"), (1, "", "[]", "[]"), (2, None, None, None)], "row_idx bigint, query string, answers string, tools string")
    assert [(r.id, r.messages[0].content, r.messages[2].content) for r in chats.function_calls(calls).collect()] == [("call-0", "These tools can be called:\n[]", "[1]")]


def test_examples_once_and_ablations(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, None), (None, 1, "n")], "id string, o int, dropped string")
    kept, dropped = chat.deduplicated(df, ("o",))
    assert {(r.id, r.dropped) for r in kept.collect()} == {("a", "y"), ("b", None), (None, "n")} and dropped.first().dropped == 1
    with pytest.raises(ValueError):
        selection.ablation(df, "none")
    assert selection.ablation(df.withColumn("stage", F.lit("english")), "tvl_only").count() == 0


def test_numbers_and_places_are_complete(spark):
    df = spark.createDataFrame([(f"k{i}", "g" if i % 3 else None) for i in range(500)], "k string, g string")
    assert sorted(r.n for r in selection.numbered(df, "k", "n").collect()) == list(range(500))
    got = splitting.placed(df, "g", "k", "n").collect()
    assert sorted(r.n for r in got if r.g is None) == list(range(1, 168)) and sorted(r.n for r in got if r.g) == list(range(1, 334))
    assert splitting.placed(df.limit(0), "g", "k", "n").count() == 0


def test_sample_is_bounded_and_the_same_at_every_split(spark):
    df = spark.range(20000).withColumn("k", F.col("id").cast("string"))
    a, b = ({r.id for r in sample(x, 1000, "k").collect()} for x in (df, df.repartition(7)))
    assert a == b and 1000 <= len(a) <= 1500
    assert sample(df.limit(10), 1000, "k").count() == 10 and sample(df.limit(0), 1000, "k").count() == 0


# --- cleaning


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("[Picture on page 5]", True), ("[Box on page 3]", True), ("CHAPTER 7", True), ("mataupu e 12", True), ("ch. 4", True), ("chart 4", False), ("Part of it, 7 of them", False), ("© 2001 all", True),
        ("Copyright (c) 1999 X", True), ("[p. 12]", True), ("(Chorus)", True), ("PAGECHAPTER", True), ("Pagechapter", False), ("(See also page 3.)", True), ("See alsoran", False), ("*", True), ("", True), (" \n", True),
        ("Also in this issue", True), ("This is not for sale.", True), ("A plain text.", False), ("x" * 200 + " not for sale " + "y" * 200, False), ("Photo credit: A", True),
    ],
)
def test_metadata(spark, text, expected):
    assert one(spark, cleaning.is_metadata(F.col("t")), t=text) is expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("w18.067 ¶16", True), ("No. 2: x ¶3", True), ("12, 13, ¶4", True), ("Congregation Bible Study:(30 min.)btchap. 1 ¶16-21", True), ("(5 minu.)be-E28 ¶3", True), ("A sentence with ¶3 inside", False), ("no mark", False), ("w1 " + "x" * 130 + " ¶3", False)],
)
def test_reference_only(spark, text, expected):
    assert one(spark, cleaning.is_reference_only(F.col("t")), t=text) is expected


@pytest.mark.parametrize(("text", "expected"), [("a —read.", "a "), ("a —", "a "), ("a — b", "a — b"), ("a —, ftn.", "a "), ("a —Tusi Paia, Samoa", "a "), ("a —Tusi. Paia", "a —Tusi. Paia"), ("no dash", "no dash"), ("", "")])
def test_cut_stub(spark, text, expected):
    assert one(spark, tx.cut_stub(F.col("t")), t=text) == expected


def test_clean_keeps_wanted_columns_only(spark):
    rows = [(f"r{i}", "f", i, None, "article_paragraph", "d", None, None, "te fale lei o te tagata", "the good house of the people", "x") for i in range(15)] + [("r0", "g", 0, None, None, None, None, None, None, None, "x")]
    schema = "id string, source_file string, source_line bigint, ingested_at timestamp_ntz, content_type string, domain string, pub_code string, text_date string, tvl string, en string, _n string"
    df = spark.createDataFrame(rows, schema)
    got = cleaning.clean(df.drop("_n"), keep=("id",), derive={"n": F.length("en")})
    assert got.columns == ["id", "n", "reason"]
    reasons = sorted((r.id, r.reason) for r in got.collect())
    assert reasons[0] == ("r0", "boilerplate_en") and reasons[1] == ("r0", "duplicate_id") and all(r == "duplicate_content" for i, r in reasons[2:])
    assert cleaning.clean(df.drop("_n").limit(0)).count() == 0


# --- checks and last rules


def test_checks_of_a_bad_and_of_an_empty_corpus(spark):
    verse = "e tasi lua tolu fa lima ono fitu valu iva sefulu"
    rows = [
        ("a", "train", "article_paragraph", "d1", None, "2024", "f", 1, f"tala {verse} tala", "x y", ), ("b", "test", "bible_verse", None, 8, None, "f", 2, verse, "same"),
        ("c", "train", "daily_text", "d2", None, "2024", "f", 3, "other", "same"), ("d", "validation", "daily_text", "d2", None, "2024", "f", 4, None, None), ("e", "train", "bible_verse", None, 8, None, "f", 5, "v", ""),
    ]
    got = {r.check: r.found for r in integrity.checks(spark.createDataFrame(rows, PAIR)).collect()}
    assert got["doc_id_train_validation"] == 1 and got["doc_id_train_test"] == 0 and got["book_train_test"] == 1 and got["date_in_several_splits"] == 1
    assert got["exact_en"] == 2 and got["exact_tvl"] == 0 and got["ngram_leaks"] == 1 and got["small_test"] == 299 and got["missing_article_paragraph_test"] == 1
    empty = {r.check: r.found for r in integrity.checks(spark.createDataFrame([], PAIR)).collect()}
    assert empty["ngram_leaks"] == 0 and empty["small_validation"] == 100 and set(empty) == set(got)


def test_postprocess(spark):
    rows = [
        (1, "Te fale", "The house"), (2, "te FALE ", "the house"), (3, "A ka sau koe", "Why didn"), (4, "te lua tolu fa lima", "two"), (5, "Erg Anp fale", "the house"),
        (6, "the house of the people is in that place", "it is there"), (7, "A: te fale 123 lei ø nei", "[N] the house\x07 is good"), (8, "ø", "zero"), (9, None, "x"),
    ]
    got = {r.id: r for r in postprocess.postprocess(spark.createDataFrame(rows, "id int, tvl string, en string"), ("id",)).collect()}
    assert [got[i].reason for i in range(1, 9)] == [None, "duplicate", "truncated_en", "stub_en", "gloss_in_tvl", "en_prose_in_tvl", None, "empty"]
    assert (got[7].tvl, got[7].en) == ("te fale lei nei", "the house is good") and got[7].tvl_chars == 15 and got[9].reason is None


def test_pairing_by_ids_and_pages(spark):
    t = "a text that is long enough"
    rows = [("g", s, i, t) for s in ("tvl", "en") for i in (1, 2)] + [("h", "tvl", i, t) for i in range(6)] + [("h", "en", 9, t)] + [("lone", "tvl", 1, t), ("g", "en", 3, None)]
    got = {(r.g, r.pid, r.method, r.confidence) for r in pairing.by_paragraph_id(spark.createDataFrame(rows, "g string, side string, pid int, text string"), "g", "side", "pid", "text").collect()}
    assert got == {("g", 1, "paragraph_id", 0.9), ("g", 2, "paragraph_id", 0.9), ("h", None, "document_level", 0.6)}
    docs = spark.createDataFrame([("k", f"{t} one.\n\n{t} two.\f{t} three.\f12", f"{t} uno.\n\n{t} due.\f{t} tre."), ("n", None, t)], "k string, tvl string, en string")
    assert sorted((r.page, r.place, r.tvl[-6:], r.en[-5:]) for r in pairing.by_page(docs, "k", 10).collect()) == [(0, 0, "h one.", " uno."), (0, 1, "h two.", " due."), (1, 0, "three.", " tre.")]


# --- scores, events


def test_scores(spark):
    rows = [("Te fale 12 i Funafuti", "Te fale 12 i Funafuti", "", "headline_generation", "", "a"), ("", "Te fale", None, "qa", None, "a"), (None, None, None, None, None, None)]
    got = evaluation.scores(spark.createDataFrame(rows, "prediction string, reference string, source string, family string, path string, k string")).collect()
    assert (got[0].adequacy, got[0].entities, got[0].style, got[0].support) == (1.0, 1.0, 1.0, 1.0) and got[1].style == 0.0 and got[1].adequacy == 0.0 and got[2].entities == 1.0
    losses = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 8.0)], "i int, loss double")
    assert evaluation.mean_of_batches(losses, F.col("i"), "loss", 2).first().loss == 5.0


def test_export_of_interactions(spark, tmp_path):
    user = ("s1", "Nui", "2024-01-01")
    rows = spark.createDataFrame([(1, "a", 1, "thumbs_up", *user)], "id int, article_id string, paragraph_idx int, feedback_type string, session_id string, island string, created_at string")
    forms = spark.createDataFrame([(1, "a", 0, "1", "Palakalafa muamua", *user), (2, "a", None, "no", " ", *user), (3, None, None, None, None, *user)], "id int, article_id string, correction_paragraph_idx int, helpful string, correction_text string, session_id string, island string, created_at string")
    signals = spark.createDataFrame([(1, "a", 0, "share", *user)], "id int, article_id string, paragraph_index int, signal_type string, session_id string, island string, created_at string")
    polls = spark.createDataFrame([(1, "a", "Who?", '["Arsenal", "Draw"]', "Arsenal", *user), (2, None, None, "not json", None, *user)], "id int, article_id string, question string, options_json string, vote string, session_id string, island string, created_at string")
    events = feedback.export(rows, forms, signals, polls)
    assert feedback.write_events(events, str(tmp_path / "out")) == {"explicit_feedback": 4, "corrections": 1, "implicit_signals": 1, "poll_votes": 2}
    got = {r.id: r for r in events.collect()}
    assert got["feedback:1"].score == 1 and got["article_feedback:2"].score == 0 and got["article_feedback:3"].score is None and got["poll_votes:1"].options == ["Arsenal", "Draw"] and got["poll_votes:2"].options == ["not json"]
    assert feedback.export(rows, forms, None, polls).filter("output = 'implicit_signals'").count() == 0
    assert spark.read.json(str(tmp_path / "out")).count() == 8


# --- strings, tables, markup


def test_strings(spark):
    x = lambda f, t: one(spark, f(F.col("t")), t=t)
    assert x(st.without_parens, "a (b (c) d) e") == "a e" and x(st.without_parens, "a (b") == "a" and x(st.without_parens, None) is None
    assert x(st.names, "A, b; A / c (d)") == ["A", "b", "c"] and x(st.stem, "x/Some Doc-p1-20.pdf") == "some_doc" and x(st.stem, "plain") == "plain"
    assert x(st.strip_markdown, "# Hi `a` [b](u)\n```\ncode\n```") == "Hi a b" and x(st.slug, " It’s A-b! ") == "its-a-b" and x(st.is_boilerplate, "page 3 of 9") and not x(st.is_boilerplate, "a text of some length")
    assert x(st.clean_line, " -- a   b == ") == "a b" and x(st.url_path, "https://a.b/c/d?e") == "c/d" and x(st.chunks, "short") == ["short"]
    assert x(lambda c: st.clean_body(c, F.lit("s"), {"s": ("More:",)}), "a  b\nMore: x\n\n\n\nc ") == "a b\n\nc"
    assert one(spark, rules.is_name(F.col("t")), t="Ana Maria") and not one(spark, rules.is_name(F.col("t")), t="a Maria") and not one(spark, rules.is_name(F.col("t")), t="")


def test_markup():
    html = '<p data-pid="1">A<sup>2</sup> b &amp; c<br>d<p data-pid="2">e <i class="note">no</i></p><p> </p><div><p>f'
    assert markup.page_paragraphs(html, skip=("note",)) == [{"id": "1", "text": "A b & c d"}, {"id": "2", "text": "e"}, {"id": None, "text": "f"}]
    assert markup.page_paragraphs(None) == [] and markup.page_paragraphs("< broken <p") == []
    assert markup.rich_text({"content": [{"type": "paragraph", "text": "a"}, {"type": "embedded-asset", "text": "x"}, "b"]}) == "a\nb" and markup.rich_text(None) == ""


def test_linked_data(spark):
    html = '<script type="application/ld+json">{"headline": "H", "author": {"name": "A"}, "image": ["u"]}</script>'
    df = spark.createDataFrame([(html,), ("<script type='application/ld+json'>{bad</script>",), (None,)], "h string").withColumn("d", markup.script_json(F.col("h")))
    got = df.select(*[c.alias(n) for n, c in markup.linked_article(F.col("d")).items()]).collect()
    assert (got[0].headline, got[0].author, got[0].image) == ("H", "A", "u") and got[1].headline is None and got[2].author is None


def test_crawl(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "y"), ("a", None), ("a", "b")], "source string, target string")
    start = spark.createDataFrame([("a",), ("a",), (None,)], "page string")
    assert {(r.page, r.depth) for r in markup.crawl(links, start, 3).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}
    assert markup.crawl(links.limit(0), start).count() == 1


def test_tasks(spark):
    docs = spark.createDataFrame([(1, "T", "A headline here\nThe island of Nui has 12 boats. It is said: “a good day for all”. More."), (2, None, ""), (3, "x", None)], "doc_id int, title string, text string")
    got = tasks.grounded(docs).collect()
    assert {r.doc_id for r in got} == {1} and len({r.id for r in got}) == len(got) and {r.origin for r in got} == set(tasks.ORIGINS)
    assert next(r.answer for r in got if r.family == "number_extraction") == "- 12"
    one_origin = tasks.grounded(docs, ("lead",), ("native",))
    assert {r.origin for r in tasks.mirrors(one_origin).collect()} == {"english", "mixed", "plain"} and tasks.grounded(docs.limit(0)).count() == 0
    assert {(r.arm, r.is_default) for r in tasks.arms(one_origin).collect()} == {("native_only", False), ("native_plus_english", True), ("with_mixed", False), ("all", False)}


def test_tables(spark, tmp_path):
    schema = spark.createDataFrame([], "id string").schema
    assert tables.read_jsonl_folder(spark, str(tmp_path / "none"), schema).count() == 0 and tables.read_json(str(tmp_path / "none.json"), {}) == {}
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").createOrReplaceTempView("small")
    assert tables.one_of(spark, "select v from small where k = :k", k="b") == {"v": 2} and tables.one_of(spark, "select v from small where k = :k", k="z") is None
    assert len(tables.rows_of(spark, "select * from small where v > :v", v=0)) == 2
