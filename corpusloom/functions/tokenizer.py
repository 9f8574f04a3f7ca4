"""Tokenizers: a text column in, an array of ids out. Null and empty texts give an empty array."""

from __future__ import annotations

import base64

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from corpusloom.functions.text import col

#: Where the vocabulary lies that runs use unless another tokenizer is given.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: how a byte-level BPE vocabulary of 50,000 entries cuts a text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@F.pandas_udf(ArrayType(IntegerType()))
def _bytes(text: pd.Series) -> pd.Series:
    return text.map(lambda t: np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8).astype(np.int32))


def byte_level(c) -> Column:
    """The UTF-8 bytes as ids; their number is the text's length in bytes."""
    return _bytes(F.coalesce(col(c), F.lit("")))


def bpe(spark: SparkSession, vocabulary: str):
    """A tokenizer from a local file of ranks; the file is read on the driver and sent to each executor once."""
    with open(vocabulary, "rb") as f:
        sent = spark.sparkContext.broadcast(f.read())
    built: list = []

    @F.pandas_udf("array<int>")
    def ids(text: pd.Series) -> pd.Series:
        if not built:
            import tiktoken

            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
            built.append(tiktoken.Encoding("corpusloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}))
        return text.map(lambda t: built[0].encode_ordinary(t) if t else [])

    return lambda c: ids(col(c))


def token_columns(ids: Column) -> list[Column]:
    """input_ids, attention_mask and n_tokens."""
    return [ids.alias("input_ids"), F.transform(ids, lambda _: F.lit(1)).alias("attention_mask"), F.size(ids).cast("bigint").alias("n_tokens")]
