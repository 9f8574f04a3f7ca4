"""Sizes of texts in tokens of a public byte-level BPE tokenizer, whose file is read on the driver and sent along."""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ship

#: Where the vocabulary lies; a parameter of every function that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how the vocabulary's public tokenizer cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BUILT: dict = {}


def encoder(body: bytes):
    """The tokenizer of a vocabulary file's bytes, built once in each process."""
    key = hash(body)
    if key not in _BUILT:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, body.splitlines())}
        _BUILT[key] = tiktoken.Encoding("corpusloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _BUILT[key]


def with_tokens(df: DataFrame, columns: list[str], text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns and ``n_tokens`` of the whole text; null and empty texts have 0 tokens."""
    spark: SparkSession = df.sparkSession
    ship(spark)
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())  # one file of fixed size

    @F.pandas_udf("bigint")
    def count(text: pd.Series) -> pd.Series:
        encode = encoder(sent.value).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in text], dtype="int64")

    return df.select(*columns, count(text_col).alias("n_tokens"))
