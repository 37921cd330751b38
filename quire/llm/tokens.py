"""Sizes in tokens of a public tokenizer, whose vocabulary file is read where the cluster has it."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.session import parallelism

#: Folder and file of the vocabulary: byte-level BPE for many languages.
FOLDER, FILE = os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str | None = None) -> Column:
    """Tokens of each text; 0 for null and empty ones."""
    path = path or os.path.join(FOLDER, FILE)

    @F.pandas_udf(T.LongType())
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for s in texts:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in s], dtype="int64")

    return count(text)


def sized(df: DataFrame, text_col: str, keep: list[Column | str], path: str | None = None) -> DataFrame:
    """keep..., n_tokens; the texts are spread over all cores first, as files may be few."""
    src = df.select(*keep, F.col(text_col).alias("__text")).repartition(parallelism(df.sparkSession))
    return src.withColumn("n_tokens", token_count(F.col("__text"), path)).drop("__text")
