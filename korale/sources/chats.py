"""Chat sources: how the rows of each become examples (id, task_family, messages, metadata, translate_mask).

A mapper takes a DataFrame in the shape of its source with a column row_idx, the
row's place from 0, by which examples without an id of their own are named; rows
that are left out leave gaps. Null and empty texts count as missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from korale.operators.chat import normalize_messages, translate_mask
from korale.sources.tables import LOADERS, read_records

MESSAGE = "struct<role:string,content:string>"
DEFAULT = ()  # the mask by roles


def given(*columns: str) -> Column:
    """The first of the columns with a text."""
    return F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in columns])


def _turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def example(rows: DataFrame, id_: Column, family: str, messages: Column, source: str, mask: tuple[str, ...] = DEFAULT, **metadata: Column) -> DataFrame:
    """The common shape."""
    rows = rows.select(id_.cast("string").alias("id"), F.lit(family).alias("task_family"), messages.cast(f"array<{MESSAGE}>").alias("messages"), F.map_from_entries(
        F.filter(F.array(*[F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")) for k, v in {"source": F.lit(source), **metadata}.items()]), lambda e: e["v"].isNotNull())
    ).alias("metadata"))
    return rows.withColumn("translate_mask", F.array(*map(F.lit, mask)) if mask else translate_mask(F.col("messages"), F.col("task_family")))


def _numbered(prefix: str) -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.col("row_idx").cast("string"))


def instructions(rows: DataFrame) -> DataFrame:
    """inputs or prompt, targets or completion, task."""
    user, answer = given("inputs", "prompt"), given("targets", "completion")
    return example(rows.filter(user.isNotNull() & answer.isNotNull()), _numbered("instruction"), "chat", F.array(_turn("user", user), _turn("assistant", answer)), "instructions", task=F.coalesce("task", F.lit("")))


def dialogues(rows: DataFrame) -> DataFrame:
    """messages (role, content, text, value): any number of turns."""
    return example(rows.filter(F.size("messages") > 0), _numbered("dialogue"), "chat", normalize_messages(F.col("messages")), "dialogues")


def private_chats(rows: DataFrame) -> DataFrame:
    """messages, or prompt and completion, or user and assistant; the last turn must be an answer. Threads are kept together by split_group."""
    two = lambda a, b: F.when(given(a).isNotNull() & given(b).isNotNull(), F.array(_turn("user", F.col(a)), _turn("assistant", F.col(b))))
    shaped = F.coalesce(F.when(F.size("messages") > 0, normalize_messages(F.col("messages"))), two("prompt", "completion"), two("user", "assistant"))
    rows = rows.withColumn("messages", shaped).filter(F.element_at("messages", -1)["role"] == "assistant")
    stated = lambda k: F.when(F.element_at("metadata", k) != "", F.element_at("metadata", k))
    group = F.coalesce(stated("split_group"), given("thread_id", "conversation_id"), stated("thread_id"), stated("conversation_id"))
    out = example(
        rows, F.coalesce(given("id"), _numbered("private")), "chat", F.col("messages"), "private_chats",
        source_dataset=F.lit("private_chats"), language_mode=F.coalesce(given("language_mode"), stated("language_mode"), F.lit("tvl")), split_group=group,
    )
    return out


def word_problems(rows: DataFrame) -> DataFrame:
    """question, answer: the reasoning may be translated, the result at its end not."""
    rows = rows.filter(given("question").isNotNull() & given("answer").isNotNull())
    return example(rows, _numbered("problem"), "math", F.array(_turn("user", F.col("question")), _turn("assistant", F.col("answer"))), "word_problems", ("translate", "selective"))


def function_calls(rows: DataFrame) -> DataFrame:
    """query, answers and tools (JSON texts; what is no JSON counts as an empty list): the tools stand in the system message."""
    listed = lambda c: F.coalesce(F.to_json(F.try_parse_json(c)), F.lit("[]"))
    messages = F.array(_turn("system", F.concat(F.lit("These tools can be called:\n"), listed("tools"))), _turn("user", F.col("query")), _turn("assistant", listed("answers")))
    return example(rows.filter(given("query").isNotNull()), _numbered("call"), "tool", messages, "function_calls", ("preserve", "translate", "preserve"), tools=listed("tools"))


def programs(rows: DataFrame) -> DataFrame:
    """text, code, task_id."""
    rows = rows.filter(given("text").isNotNull() & given("code").isNotNull())
    key = F.concat(F.lit("program-"), F.coalesce(F.col("task_id").cast("string"), F.col("row_idx").cast("string")))
    return example(rows, key, "code", F.array(_turn("user", F.col("text")), _turn("assistant", F.col("code"))), "programs", ("translate", "selective"))


def passages(rows: DataFrame) -> DataFrame:
    """context, question, answers (texts, the first counts), id, title."""
    rows = rows.filter(given("context").isNotNull() & given("question").isNotNull() & (F.size("answers") > 0))
    key = F.concat(F.lit("passage-"), F.coalesce(given("id"), F.col("row_idx").cast("string")))
    system = F.concat(F.lit("Answer from this text.\n\nText: "), "context")
    return example(rows, key, "qa", F.array(_turn("system", system), _turn("user", F.col("question")), _turn("assistant", F.col("answers")[0])), "passages", title=F.coalesce("title", F.lit("")))


def highlights(rows: DataFrame) -> DataFrame:
    """article, highlights, id."""
    rows = rows.filter(given("article").isNotNull() & given("highlights").isNotNull())
    key = F.concat(F.lit("article-"), F.coalesce(given("id"), F.col("row_idx").cast("string")))
    return example(rows, key, "summarization", F.array(_turn("user", F.concat(F.lit("Summarize this article.\n\n"), "article")), _turn("assistant", F.col("highlights"))), "highlights")


def stories(rows: DataFrame) -> DataFrame:
    """text of 50 characters or more, told on a fixed request."""
    told = F.trim(F.regexp_replace("text", r"^\\s+|\\s+$", ""))
    rows = rows.filter(F.length(told) >= 50)
    return example(rows, _numbered("story"), "chat", F.array(_turn("user", F.lit("Tell me a short story.")), _turn("assistant", told)), "stories", ("translate", "translate"))


_OPEN = "array<struct<role:string,content:string,text:string,value:string>>"
SHAPES: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "instructions": (instructions, "inputs string, prompt string, targets string, completion string, task string"),
    "dialogues": (dialogues, f"messages {_OPEN}"),
    "private_chats": (private_chats, f"id string, messages {_OPEN}, prompt string, completion string, user string, assistant string, thread_id string, conversation_id string, language_mode string, metadata map<string,string>"),
    "word_problems": (word_problems, "question string, answer string"),
    "function_calls": (function_calls, "query string, answers string, tools string"),
    "programs": (programs, "text string, code string, task_id string"),
    "passages": (passages, "context string, question string, answers array<string>, id string, title string"),
    "highlights": (highlights, "article string, highlights string, id string"),
    "stories": (stories, "text string"),
}
UNFINISHED = ("paraphrased_problems", "function_dialogues", "agent_tasks")  # known by name, without a mapping


def _register(name: str) -> None:
    mapper, schema = SHAPES[name]

    @LOADERS.register(name)
    def load(spark: SparkSession, path: str) -> DataFrame:
        records, _ = read_records(spark, path, spark.createDataFrame([], schema).schema)
        return mapper(records.withColumn("row_idx", F.col("source_line") - 1))


def _unfinished(name: str) -> None:
    @LOADERS.register(name)
    def load(spark: SparkSession, path: str) -> DataFrame:
        raise NotImplementedError(f"{name} has no mapping")


for _name in SHAPES:
    _register(_name)
for _name in UNFINISHED:
    _unfinished(_name)


def build(spark: SparkSession, paths: dict[str, str]) -> dict[str, tuple[str, DataFrame | None]]:
    """name -> (ok, not_implemented or error, its examples) for each named source."""
    out: dict[str, tuple[str, DataFrame | None]] = {}
    for name, path in paths.items():
        try:
            out[name] = ("ok", LOADERS.load(name, spark, path))
        except NotImplementedError:
            out[name] = ("not_implemented", None)
        except Exception:  # noqa: BLE001  a source that can't be read must not stop the others
            out[name] = ("error", None)
    return out
