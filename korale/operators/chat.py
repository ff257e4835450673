"""Chat examples: rendering, masks, tool formats, validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from korale.functions.text import bucket, normalize_lines, tokens_by_chars
from korale.operators.cleaning import is_vocabulary

FAMILIES = ("chat", "tool", "math", "code", "qa", "summarization", "translation")
SYSTEM = "You translate between Tuvaluan and English. Keep names, numbers, punctuation and line breaks as they are, and answer with the translation alone."
SYSTEM_ENTRY = "You are a dictionary of Tuvaluan and English. Answer with a short translation or definition and nothing else."
TEMPLATES = {
    ("tvl_to_en", False): (
        "Put this Tuvaluan text into English.\n\n{source}",
        "The text below is in Tuvaluan. Write it in English, with the same layout and without remarks.\n\n{source}",
        "How would this read in natural English? Keep its structure.\n\n{source}",
    ),
    ("en_to_tvl", False): (
        "Put this English text into Tuvaluan.\n\n{source}",
        "The text below is in English. Write it in Tuvaluan, with the same layout and without remarks.\n\n{source}",
        "How would this read in natural Tuvaluan? Keep its structure.\n\n{source}",
    ),
    ("tvl_to_en", True): (
        "Which English word stands for the Tuvaluan {source}?",
        "Tuvaluan entry: {source}\nEnglish:",
        "Explain the Tuvaluan word {source} in English.",
        "{source} (Tuvaluan) means what in English?",
        "Give the English for: {source}",
    ),
    ("en_to_tvl", True): (
        "Which Tuvaluan word stands for the English {source}?",
        "English entry: {source}\nTuvaluan:",
        "Say {source} in Tuvaluan.",
        "{source} (English) is what in Tuvaluan?",
        "Give the Tuvaluan for: {source}",
    ),
}


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def render(pairs: DataFrame) -> DataFrame:
    """Two chat examples per pair, one per direction: id, direction, vocab, template_idx, messages."""
    rows = pairs.withColumns({"tvl": normalize_lines(F.coalesce("tvl", F.lit(""))), "en": normalize_lines(F.coalesce("en", F.lit("")))})
    rows = rows.withColumn("vocab", is_vocabulary(F.col("content_type"), F.col("tvl"), F.col("en")))
    rows = rows.withColumn("direction", F.explode(F.array(F.lit("tvl_to_en"), F.lit("en_to_tvl"))))
    rows = rows.withColumn("key", F.concat_ws("::", "id", "direction"))
    forth = F.col("direction") == "tvl_to_en"
    source, target = F.when(forth, F.col("tvl")).otherwise(F.col("en")), F.when(forth, F.col("en")).otherwise(F.col("tvl"))
    idx = F.when(F.col("vocab"), bucket(F.col("key"), 5)).otherwise(bucket(F.col("key"), 3)).cast("int")
    rows = rows.withColumns({"source": source, "target": target, "template_idx": idx})
    template = F.lit(None).cast("string")
    for (direction, vocab), options in TEMPLATES.items():
        chosen = F.get(F.array(*[F.lit(o) for o in options]), F.col("template_idx"))
        template = F.when((F.col("direction") == direction) & (F.col("vocab") == F.lit(vocab)), chosen).otherwise(template)
    prompt = F.replace(template, F.lit("{source}"), F.col("source"))
    system = F.when(F.col("vocab"), SYSTEM_ENTRY).otherwise(SYSTEM)
    messages = F.array(_message("system", system), _message("user", prompt), _message("assistant", F.col("target")))
    return rows.select(F.col("key").alias("id"), "direction", "vocab", "template_idx", "content_type", "domain", messages.alias("messages"))


def message_tokens(messages: Column) -> Column:
    """Estimated tokens of a chat: the sum of its messages'."""
    return F.aggregate(F.transform(messages, lambda m: tokens_by_chars(m["content"])), F.lit(0), lambda a, n: a + n)


def render_summary(examples: DataFrame) -> DataFrame:
    """Examples, mean target length and estimated tokens by direction and type."""
    target = F.element_at("messages", -1)["content"]
    return examples.groupBy("direction", "content_type").agg(
        F.count("*").alias("examples"), F.round(F.avg(F.length(target)), 4).alias("target_chars"), F.sum(message_tokens(F.col("messages"))).alias("tokens")
    )


def normalize_messages(messages: Column) -> Column:
    """Messages of open shape (role, content, text, value) as role and content; the role is user where it is missing."""
    given = lambda c: F.when(c != "", c)
    return F.transform(
        messages,
        lambda m: F.struct(
            F.coalesce(given(m["role"]), F.lit("user")).alias("role"), F.coalesce(given(m["content"]), given(m["text"]), given(m["value"]), F.lit("")).alias("content")
        ),
    )


# Words by which a chat's family is told, in the order in which they count.
FAMILY_WORDS = (
    ("code", ("def ", "function ", "```python", "```java", "```js")),
    ("math", ("solve", "calculate", "equation", "answer is")),
    ("tool", ("tool_call", "function_call")),
    ("summarization", ("summarize", "summary", "highlights")),
    ("translation", ("translate", "translation")),
)


def task_family(messages: Column, stated: Column | None = None) -> Column:
    """The stated family if it is one of FAMILIES, else the first whose words occur, else chat. Null contents count as blank."""
    text = F.lower(F.array_join(F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))), " "))
    out = F.lit("chat")
    for name, words in reversed(FAMILY_WORDS):
        hit = text.contains(words[0])
        for w in words[1:]:
            hit = hit | text.contains(w)
        out = F.when(hit, name).otherwise(out)
    return F.when(stated.isin(*FAMILIES), stated).otherwise(out) if stated is not None else out


def translate_mask(messages: Column, family: Column) -> Column:
    """Per message translate, preserve or selective: system and tool messages are preserved, answers with code or calls selective."""
    return F.transform(
        messages,
        lambda m: F.when(m["role"].isin("system", "tool"), "preserve").when((m["role"] == "assistant") & family.isin("code", "tool"), "selective").otherwise("translate"),
    )


def prompt_completion(messages: Column) -> tuple[Column, Column]:
    """The text before the last assistant message, and that message; without one all is prompt."""
    places = F.transform(messages, lambda m: m["role"] == "assistant")
    last = F.size(messages) + 1 - F.array_position(F.reverse(places), True)
    there = F.exists(places, lambda p: p)
    line = lambda m: F.concat(m["role"], F.lit(": "), m["content"])
    head = F.when(there, F.slice(messages, F.lit(1), (last - 1).cast("int"))).otherwise(messages)
    return F.array_join(F.transform(head, line), "\n"), F.when(there, F.element_at(messages, F.when(there, last).cast("int"))["content"]).otherwise("")


def _tagged(tag: str, content: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>\n"), content, F.lit(f"\n</{tag}>"))


def tool_format(messages: Column, fields: tuple[str, ...] = ("role", "content"), native: bool = False) -> Column:
    """Messages for models with a tool role (native: as they are) or without one.

    fields names what the messages have besides role and content: name,
    tool_calls (an array of JSON texts) and function_call (a JSON text). Results
    of tools become user messages with tags, under their name if they have one;
    calls of an assistant follow its text in tags. Null contents count as blank.
    """
    if native:
        return messages
    have = lambda m, f: m[f] if f in fields else F.lit(None)

    def one(m: Column) -> Column:
        text = F.coalesce(m["content"], F.lit(""))
        name = have(m, "name").cast("string")
        result = F.concat(F.when(name.isNotNull(), F.concat(F.lit("["), name, F.lit("]\n"))).otherwise(""), _tagged("tool_result", text))
        many = F.transform(have(m, "tool_calls").cast("array<string>"), lambda c: _tagged("tool_call", c))
        single = F.when(have(m, "function_call").cast("string") != "", F.array(_tagged("tool_call", have(m, "function_call").cast("string"))))
        calls = F.coalesce(F.when(F.size(many) > 0, many), single)
        spoken = F.array_join(F.concat(F.when(text != "", F.array(text)).otherwise(F.array().cast("array<string>")), calls), "\n")
        tool = m["role"].isin("tool", "function")
        content = F.when(tool, result).when((m["role"] == "assistant") & calls.isNotNull(), spoken).otherwise(m["content"])
        return F.struct(F.when(tool, "user").otherwise(m["role"]).alias("role"), content.alias("content"))

    return F.transform(messages, one)


def tool_places(messages: Column, fields: tuple[str, ...] = ("role", "content")) -> Column:
    """The places (from 0) of messages that have to do with tools: by role, by calls, by tags, or by a call's key in their text."""
    have = lambda m, f: m[f] if f in fields else F.lit(None)

    def is_tool(m: Column) -> Column:
        text = F.coalesce(m["content"], F.lit(""))
        calls = (F.size(F.coalesce(have(m, "tool_calls").cast("array<string>"), F.array().cast("array<string>"))) > 0) | (F.coalesce(have(m, "function_call").cast("string"), F.lit("")) != "")
        tags = text.rlike(r"(?s)<tool_call>.*?</tool_call>|<tool_result>.*?</tool_result>")
        return F.coalesce(m["role"].isin("tool", "function"), F.lit(False)) | (F.coalesce(m["role"] == "assistant", F.lit(False)) & calls) | tags | text.rlike(r'"function_call"\s*:')

    return F.filter(F.transform(messages, lambda m, i: F.when(is_tool(m), i)), lambda i: i.isNotNull())


def lines(messages: Column) -> Column:
    """A chat as text: a line per message, with its role."""
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(": "), F.coalesce(m["content"], F.lit("")))), "\n")


def content_text(parts: Column) -> Column:
    """The text of a content that is a list of parts (struct with type and text): the texts of its text parts, one per line."""
    given = F.filter(parts, lambda p: (F.coalesce(p["type"], F.lit("text")) == "text") & p["text"].isNotNull())
    return F.array_join(F.transform(given, lambda p: p["text"]), "\n")


def deduplicated(examples: DataFrame, order: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(the first example of each id in an order, one row with the number of dropped ones)."""
    first = examples.groupBy("id").agg(F.min_by(F.struct(*[c for c in examples.columns if c != "id"]), F.struct(*order)).alias("_r"), F.count("*").alias("_n"))
    return first.select("id", "_r.*"), first.agg(F.sum(F.col("_n") - 1).alias("dropped"))


def split_key(id_: Column, split_group: Column) -> Column:
    """What an example is split by: its group (a thread), else itself."""
    return F.coalesce(F.when(split_group != "", split_group), id_)


def mix_summary(examples: DataFrame, by: str) -> DataFrame:
    """Examples and estimated tokens by a column."""
    return examples.groupBy(by).agg(F.count("*").alias("examples"), F.sum(message_tokens(F.col("messages"))).alias("tokens"))


def crosslingual(examples: DataFrame, answers: DataFrame, seed: str, most_turns: int = 1) -> DataFrame:
    """Chats whose questions are in one language and whose answers are in another.

    examples (id, messages) give the user turns, answers (id, answers: array of
    texts) the answers; a chat ends where the answers do. Where the instruction
    to answer in that language stands (system or first question) is chosen by a
    hash of the id. Ids without answers give nothing.
    """
    joined = examples.join(answers.select("id", "answers"), "id")
    asked = F.filter("messages", lambda m: m["role"] == "user")
    turns = F.least(F.size(asked), F.size("answers"), F.lit(most_turns))
    pairs_ = F.slice(F.arrays_zip(F.transform(asked, lambda m: m["content"]).alias("q"), F.col("answers").alias("a")), F.lit(1), turns)
    ahead = bucket(F.concat(F.lit(seed), F.col("id")), 2) == 0
    wish = F.lit("Answer in Tuvaluan.")
    body = F.flatten(F.transform(pairs_, lambda p, i: F.array(_message("user", F.when(~ahead & (i == 0), F.concat(wish, F.lit("\n\n"), p["q"])).otherwise(p["q"])), _message("assistant", p["a"]))))
    head = F.when(ahead, F.array(_message("system", wish))).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    return joined.filter(turns > 0).select("id", F.concat(head, body).alias("messages"))


def example_errors(id_: Column, family: Column, messages: Column, families: tuple[str, ...]) -> Column:
    """What is wrong with an example; empty where nothing is."""
    bad = F.exists(messages, lambda m: m["role"].isNull() | m["content"].isNull())
    checks = (
        ("missing id", F.coalesce(id_, F.lit("")) == ""), ("unknown family", ~F.coalesce(family.isin(*families), F.lit(False))),
        ("no messages", F.coalesce(F.size(messages), F.lit(0)) < 1), ("incomplete message", F.coalesce(bad, F.lit(False))),
    )
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks]))
