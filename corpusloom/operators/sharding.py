"""Dense row numbers, shards and samples, all by an explicit order and without a single-task window."""

from __future__ import annotations

from bisect import bisect_right

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import durable

_ROW_BITS = 33  # of monotonically_increasing_id: rows within a partition


def with_index(df: DataFrame, order: str, name: str = "idx") -> DataFrame:
    """Row numbers 0, 1, 2 … in the order of a unique column.

    Rows are range-partitioned and sorted once and written; a partition's first number is the count of rows before it.
    """
    mid = durable(df.repartitionByRange(order).sortWithinPartitions(order).withColumn("__m", F.monotonically_increasing_id()))
    part = F.shiftright("__m", _ROW_BITS)
    pos = F.col("__m").bitwiseAND((1 << _ROW_BITS) - 1)
    counts = mid.groupBy(part.alias("__p")).agg((F.max(pos) + 1).alias("n"))  # one row a partition
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("__p", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    out = mid.withColumn("__p", part).join(F.broadcast(starts), "__p")  # one row a partition
    return out.withColumn(name, (F.col("__start") + pos).cast("bigint")).drop("__m", "__p", "__start")


def assign_shards(df: DataFrame, order: str, docs_per_shard: int = 50_000) -> DataFrame:
    """shard_id from 1; the last shard may be short, an empty table has none."""
    return with_index(df, order).withColumn("shard_id", (F.floor(F.col("idx") / docs_per_shard) + 1).cast("bigint"))


#: Shards of one run: their first order values are sent to all executors.
MAX_SHARDS = 1_000_000


def shard_bounds(df: DataFrame, order: str, docs_per_shard: int = 50_000) -> list:
    """The order value of each shard's first row. Only the order column is sorted and numbered."""
    idx = with_index(df.select(order), order).where(F.col("idx") % docs_per_shard == 0)
    rows = idx.orderBy("idx").select(order).limit(MAX_SHARDS + 1).collect()  # a row a shard
    if len(rows) > MAX_SHARDS:
        raise ValueError(f"more than {MAX_SHARDS} shards; use larger ones")
    return [r[0] for r in rows]


def in_shards(df: DataFrame, order: str, docs_per_shard: int = 50_000) -> DataFrame:
    """Whole rows with their shard_id, each shard in one task and in order: rows are shuffled once."""
    bounds = shard_bounds(df, order, docs_per_shard)
    sent = df.sparkSession.sparkContext.broadcast(bounds)  # at most MAX_SHARDS values

    @F.pandas_udf("bigint")
    def shard(v: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(sent.value, x) for x in v], dtype="int64")

    return df.withColumn("shard_id", shard(order)).repartition(max(1, len(bounds)), "shard_id").sortWithinPartitions("shard_id", order)


def shard_name(base: str):
    """As the files are called: ``train_shard_00001.jsonl`` for the first shard."""
    return F.format_string(f"{base}_%05d.jsonl", "shard_id")


def manifest(sharded: DataFrame, base: str = "train_shard", folder: str = "shards") -> DataFrame:
    """One row a shard: id, file, path, documents and tokens (null without ``n_tokens``)."""
    tokens = F.sum("n_tokens") if "n_tokens" in sharded.columns else F.lit(None).cast("bigint")
    out = sharded.groupBy("shard_id").agg(F.count(F.lit(1)).alias("num_docs"), tokens.alias("total_tokens"))
    name = shard_name(base)
    return out.select("shard_id", name.alias("filename"), F.concat(F.lit(folder + "/"), name).alias("path"), "num_docs", "total_tokens")


def sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same on every run: the smallest hashes of key and seed (a distributed top-n)."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)
