"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"  # default of the path parameter
# Fixed value: the published splitting pattern of this family of byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG = 200_000  # characters from which a text is encoded in parts
_BREAK = re.compile(r"(?<=\S)(?= \S)")


def encoder(ranks: bytes):
    """The tokenizer of a ranks file."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def count(encoding, text: str | None) -> int:
    """Tokens of text. A very long text is cut before single blanks, where no token reaches across; a word of over LONG characters is cut at LONG."""
    if not text:
        return 0
    if len(text) <= LONG:
        return len(encoding.encode_ordinary(text))
    total, start = 0, 0
    while start < len(text):
        end = min(len(text), start + LONG)
        if end < len(text) and (m := _BREAK.search(text, end, min(len(text), end + LONG))):
            end = m.start()
        total += len(encoding.encode_ordinary(text[start:end]))
        start = end
    return total


def token_sizes(documents: DataFrame, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), ranks_path: str = RANKS) -> DataFrame:
    """key, n_tokens and the columns of keep, one row per key.

    The ranks file (a fixed vocabulary, under 1 MB) is read once on the driver
    and travels with the tasks. A null text has 0 tokens; of several rows with
    one key the one with most tokens counts; rows without a key are left out.
    """
    ranks = Path(ranks_path).read_bytes()
    kinds = {c: documents.schema[c].dataType.simpleString() for c in (key, *keep)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = encoder(ranks)
        for b in batches:
            yield b[[key, *keep]].assign(n_tokens=[count(encoding, t) for t in b["__text"]])

    schema = ", ".join([*(f"`{c}` {k}" for c, k in kinds.items()), "n_tokens bigint"])
    sized = documents.filter(F.col(key).isNotNull()).select(key, *keep, F.col(text).alias("__text")).mapInPandas(run, schema)
    most = F.max_by(F.struct(*keep, "n_tokens"), F.struct(F.col("n_tokens"), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keep]))
    return sized.groupBy(key).agg(most.alias("r")).select(key, "r.*")
