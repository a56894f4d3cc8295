"""Token counts of whole texts under a public tokenizer whose file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame

from crateloom.runtime import spread_scan

TOKENIZER = os.environ.get("CRATELOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the split pattern that the byte-level vocabulary was made with.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def encoder(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, keep: list[str], path: str = TOKENIZER) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``n_tokens`` of ``text``; null and empty texts have 0."""
    context = docs.sparkSession.sparkContext
    context.addFile(path)  # once per context; workers may have no file at this place
    name = os.path.basename(path)
    schema = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep) + ", n_tokens long"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(SparkFiles.get(name)).encode_ordinary
        for b in batches:
            yield b[keep].assign(n_tokens=[0 if t is None else len(encode(t)) for t in b["text"]])

    return spread_scan(docs.select(*dict.fromkeys([*keep, "text"]))).mapInPandas(count, schema)
