"""Exact and prefix deduplication with lineage.

"First" is always by an explicit order column. Only ids and hashes are shuffled: groups are aggregated before, and the first
id of a repeated hash is joined back to ids alone. The ids of duplicates then meet the rows; where they are few enough for
a broadcast, no text is shuffled at all, else each row is once, by its unique id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DEFAULT, Config
from corpusloom.functions import text as T
from corpusloom.operators.checks import once, require
from corpusloom.operators.skew import join_groups
from corpusloom.session import durable


#: Duplicates up to which their ids are broadcast to the rows: at most about 100 bytes each, 100 MB.
BROADCAST_ROWS = 1_000_000


def add_keys(df: DataFrame, c: Config = DEFAULT, text: str = "text_pii_masked", id_col: str = "doc_id", order: str | None = None) -> DataFrame:
    """dedup_id, exact_canon_text, exact_hash and near_key. Without an id column, the row number ``order`` is the id."""
    require(df, text)
    if id_col not in df.columns:
        require(df, order or id_col)
    out = once(df.withColumn("dedup_id", F.col(id_col if id_col in df.columns else order).cast("string")), exact_canon_text=T.canonical(text))
    return out.withColumns({"exact_hash": F.sha2("exact_canon_text", 256), "near_key": F.substring("exact_canon_text", 1, c.near_key_chars)})


def _later(narrow: DataFrame, key: str, name: str) -> DataFrame:
    """``o``, and in ``name`` the id of the group's first row, of all rows but the first of each repeated key."""
    rows = narrow.where(F.col(key).isNotNull()).select("o", "d", key)
    first = rows.groupBy(key).agg(F.min(F.struct("o", "d")).alias("f"), F.count(F.lit(1)).alias("n")).where("n > 1")
    first = durable(first.select(key, "n", F.col("f.o").alias("first_o"), F.col("f.d").alias("first_d")))
    return join_groups(rows.select("o", key), first, key).where("o > first_o").select("o", F.col("first_d").alias(name))


def duplicates(keyed: DataFrame, c: Config, order: str) -> DataFrame:
    """``o`` (the order column), ``exact_id`` and ``near_id`` of all rows that are not the first of their text or prefix."""
    candidate = (F.length("exact_canon_text") >= c.near_dup_min_len) & (F.col("near_key") != "")
    # a prefix may be long: its hash is what is shuffled
    narrow = keyed.where(F.col(order).isNotNull()).select(F.col(order).alias("o"), F.col("dedup_id").alias("d"), F.unhex("exact_hash").alias("e"), F.when(candidate, F.unhex(F.sha2("near_key", 256))).alias("p"))
    narrow = durable(narrow)
    both = _later(narrow, "e", "exact_id").withColumn("near_id", F.lit(None).cast("string")).unionByName(_later(narrow, "p", "near_id").withColumn("exact_id", F.lit(None).cast("string")))
    return both.groupBy("o").agg(F.max("exact_id").alias("exact_id"), F.max("near_id").alias("near_id"))


def deduplicate(df: DataFrame, c: Config = DEFAULT, text: str = "text_pii_masked", id_col: str = "doc_id", order: str | None = None) -> DataFrame:
    """All rows with ``is_dup_exact``, ``is_dup_near``, ``dup_of`` and ``drop_reason``.

    The first row of equal canonical texts is kept; among texts of at least ``near_dup_min_len`` characters the first of
    equal prefixes. Null and empty texts are equal to each other. Reasons given before stay, flags are set regardless. The
    order column must be unique, and is the id where there is no id column; rows without an order value are nobody's
    duplicate. An empty table gives an empty result.
    """
    order = order or id_col
    keyed = add_keys(df, c, text, id_col, order)
    if "drop_reason" not in keyed.columns:
        keyed = keyed.withColumn("drop_reason", F.lit(None).cast("string"))
    flags = durable(duplicates(keyed, c, order)).select(F.col("o").alias(order), F.col("exact_id").alias("__exact_id"), F.col("near_id").alias("__near_id"))
    few = flags.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    flagged = keyed.join(F.broadcast(flags) if few else flags, order, "left")
    flagged = flagged.withColumns({"is_dup_exact": F.col("__exact_id").isNotNull(), "is_dup_near": F.col("__near_id").isNotNull() & F.col("__exact_id").isNull()})
    flagged = flagged.withColumns({
        "dup_of": F.coalesce("__exact_id", "__near_id"),
        "drop_reason": F.coalesce("drop_reason", F.when(F.col("is_dup_exact"), "exact_duplicate").when(F.col("is_dup_near"), "near_duplicate")),
    })
    return flagged.select(*keyed.columns, "is_dup_exact", "is_dup_near", "dup_of")


def summary(df: DataFrame) -> DataFrame:
    """One row: rows, kept, dropped, exact and near duplicates."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("drop_reason").isNull()).alias("kept"),
        F.count_if(F.col("drop_reason").isNotNull()).alias("dropped"),
        F.count_if("is_dup_exact").alias("exact_duplicates"),
        F.count_if("is_dup_near").alias("near_duplicates"),
    )
