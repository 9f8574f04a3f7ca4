"""Problem 3: records that differ by formatting only, found by Bloom filters of once- and repeatedly-seen hashes.

1. every row gets the hash of its word sequence and, if it is a record of named fields, of its sorted fields.
2. hashes are parted by value so that a part holds about ``PART_ROWS`` of them, however many rows there are. For each part a
   task builds two filters of its hashes, *seen* and *seen repeatedly*; merging two tasks, in a tree, bits set in both
   *seen* filters move to *repeatedly*. No repeated hash can be missed, and a filter always has 16 bits a hash (8 if all
   rows are records): about one singleton in 400 (40) passes as a possible repeat.
3. only possible repeats are shuffled and grouped exactly, by 128-bit hashes; all others are singletons at once. Parts are
   probed one after the other, each reading its own files, with one filter of at most ``2 * PART_ROWS`` bytes broadcast.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrays import mix, runs
from corpusloom.llm.neardup import components, words_of
from corpusloom.llm.trees import fold_segments
from corpusloom.operators.skew import join_groups
from corpusloom.session import durable, ship, table

#: The names of a record's fields.
FIELD_NAMES = ("title", "brand", "sku", "price", "colour", "size", "weight", "stock", "city", "rating")
MIN_FIELDS = 3
#: Rows of a part of the hashes. The filter of a part has 16 bits for each: 32 MB are the most that is sent to executors.
PART_ROWS = 1 << 24
_PROBES = 4
_SEGMENT = 1 << 16
#: Hashes that a task turns into filters at a time.
_CHUNK = 500_000


def record_key(text, names=FIELD_NAMES):
    """The sorted ``name value`` word sequences of a record's fields; null for other texts."""
    low = F.lower(text)
    name = "(?<![\\p{L}\\p{N}])(" + "|".join(names) + ")\\s*:"
    parts = F.transform(F.filter(F.split(F.regexp_replace(low, name, "\u0001$1 "), "\u0001"), lambda _, i: i > 0), words_of)
    return F.when(low.rlike("^\\s*" + name) & (F.regexp_count(low, F.lit(name)) >= MIN_FIELDS), F.array_join(F.array_sort(parts), "\u0001"))


def _positions(h: np.ndarray, bits: int) -> np.ndarray:
    a = mix(h.view(np.uint64))
    b = mix(a ^ np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    return ((a[:, None] + np.arange(_PROBES, dtype=np.uint64) * b[:, None]) & np.uint64(bits - 1)).astype(np.int64)


def _set(bits: int, h: np.ndarray) -> np.ndarray:
    """A packed filter that holds some hashes."""
    p = np.unique(_positions(h, bits))
    out = np.zeros(bits // 8, dtype=np.uint8)
    if len(p):
        st = runs(p >> 3)
        out[p[st] >> 3] = np.bitwise_or.reduceat((128 >> (p & 7)).astype(np.uint8), st)
    return out


def _merged(a, b):
    """*Seen* and *repeatedly* of the hashes of two pairs of filters."""
    return a[0] | b[0], a[1] | b[1] | (a[0] & b[0])


def _filters(bits: int):
    """One task's filters, some hashes at a time, in compressed segments."""

    def chunks(frames):
        held, n = [], 0
        for f in frames:
            held.append(f["h"].to_numpy())
            n += len(f)
            if n >= _CHUNK:
                yield np.concatenate(held)
                held, n = [], 0
        if held:
            yield np.concatenate(held)

    def run(frames):
        both = None
        for h in chunks(frames):
            h = np.sort(h)
            st = runs(h)
            mine = _set(bits, h[st]), _set(bits, h[st[np.diff(np.r_[st, len(h)]) > 1]])
            both = mine if both is None else _merged(both, mine)
        if both is None:
            return
        step = min(_SEGMENT, bits // 8)
        for i in range(bits // 8 // step):
            part = [x[i * step : i * step + step] for x in both]
            if part[0].any():
                yield pd.DataFrame({"segment": [i], "body": [zlib.compress(b"".join(x.tobytes() for x in part), 1)]})

    return run


def _merge(bodies) -> bytes:
    both = None
    for b in bodies:
        x = np.frombuffer(zlib.decompress(b), dtype=np.uint8)
        mine = x[: len(x) // 2], x[len(x) // 2 :]
        both = mine if both is None else _merged(both, mine)
    return zlib.compress(b"".join(x.tobytes() for x in both), 1)


def _probe(sent, bits: int):
    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        body, p = np.frombuffer(sent.value, np.uint8), _positions(h.to_numpy(dtype=np.int64), bits)
        return pd.Series(((body[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).all(axis=1))

    return maybe


def _possible(hashes: DataFrame, parts: int, bits: int) -> list[DataFrame]:
    """For each part its hashes with the column ``maybe``: false only for hashes that occur once. One table a part."""
    spark = hashes.sparkSession
    out = []
    for part in range(parts):
        mine = hashes.where(F.col("part") == part)
        merged = fold_segments(mine.select("h").mapInPandas(_filters(bits), "segment int, body binary"), _merge)
        step = min(_SEGMENT, bits // 8)
        again = np.zeros(bits // 8, dtype=np.uint8)
        for r in merged.toLocalIterator():  # bits in all, however many rows
            again[r["segment"] * step : (r["segment"] + 1) * step] = np.frombuffer(zlib.decompress(r["body"]), np.uint8)[step:]
        sent = spark.sparkContext.broadcast(again.tobytes())
        out.append(durable(mine.withColumn("maybe", _probe(sent, bits)("h")).drop("h", "part")))
        sent.unpersist()
    return out


def copy_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "exact_canon_text", part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(candidates with their group, groups of more than one row, singletons).

    Groups: ``g, first_id`` (smallest id), ``n_copies``. Two rows are copies if they have the same words in the same order,
    or are records of the same fields in any order. Null, blank and wordless texts are singletons, however many there are.
    Rows without an id take no part.
    """
    ship(df.sparkSession)
    text = F.col(text_col)
    known = df.where(F.col(id_col).isNotNull())
    n = known.count()  # of the narrowest column
    parts = max(1, -(-n // part_rows))
    bits = 1 << max(16, (16 * -(-n // parts) - 1).bit_length())
    rows = known.select(F.col(id_col).alias("doc_id"), words_of(text).alias("w"), record_key(text).alias("r"))
    keys = rows.select("doc_id", F.when(F.col("w") != "", F.unhex(F.md5("w"))).alias("s"), F.when(F.col("w") != "", F.unhex(F.md5("r"))).alias("r"))
    # a row of one hash for each text, of two for a record; part is null for rows without a word
    hashes = keys.withColumn("h", F.explode_outer(F.when(F.col("s").isNotNull(), F.array_compact(F.array(F.xxhash64("s"), F.when(F.col("r").isNotNull(), F.xxhash64("r")))))))
    hashes = durable(hashes.withColumn("part", F.pmod("h", F.lit(parts))), partition_by="part" if parts > 1 else None)
    probed = _possible(hashes, parts, bits)
    marked = probed[0]
    for x in probed[1:]:
        marked = marked.unionByName(x)
    # a record is possible if one of its hashes is
    records = marked.where("r is not null").groupBy("doc_id").agg(F.first("s").alias("s"), F.first("r").alias("r"), F.max("maybe").alias("maybe"))
    rows = marked.where("r is null").select("doc_id", "s", "r", "maybe").unionByName(records)
    possible = durable(rows.where("maybe").select("doc_id", "s", "r"))
    single = rows.where("not maybe").select("doc_id").union(hashes.where("h is null").select("doc_id"))
    return _grouped(possible), possible, single


def _grouped(possible: DataFrame) -> DataFrame:
    """``doc_id, g``: rows by field key or words; plain rows that have a record's words, and records of one word sequence
    but different fields, join that record's group."""
    of_seq = possible.where("r is not null").groupBy("s").agg(F.min("r").alias("r0"), F.max("r").alias("r1"))
    plain = durable(possible.where("r is null").groupBy("s").agg(F.count(F.lit(1)).alias("n")).join(of_seq, "s").select("s", "r0", "n"))
    g = possible.select("doc_id", F.coalesce("r", "s").alias("g"))
    if not plain.isEmpty():
        moved = join_groups(possible.where("r is null"), plain, "s").select("doc_id", F.col("r0").alias("g"))
        stay = possible.join(plain.select("s", F.lit(True).alias("has")), "s", "left").where("r is not null or has is null")
        g = durable(stay.select("doc_id", F.coalesce("r", "s").alias("g")).unionByName(moved))
    twice = of_seq.where("r0 <> r1")
    if not twice.isEmpty():
        edges = possible.where("r is not null").join(twice, "s").select(F.hex("r").alias("x"), F.hex("r0").alias("y")).distinct()
        roots = components(edges).select(F.unhex("node").alias("g"), F.unhex("root").alias("root"))
        n = durable(g.groupBy("g").agg(F.count(F.lit(1)).alias("n")).join(roots, "g"))
        moved = join_groups(g, n, "g").select("doc_id", F.col("root").alias("g"))
        g = durable(g.join(n.select("g"), "g", "left_anti").select("doc_id", "g").unionByName(moved))
    return g


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _, _ = copy_groups(table(spark, sf_dir, "mainpipe_cleaned_v5"))
    groups = durable(rows.groupBy("g").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    out = join_groups(rows, groups, "g").where("doc_id <> first_id")
    return out.select(F.col("first_id").alias("doc_id_a"), F.col("doc_id").alias("doc_id_b"))


def p3_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each record: the smallest id of its copies and how many there are."""
    rows, _, single = copy_groups(table(spark, sf_dir, "mainpipe_cleaned_v5"))
    groups = rows.groupBy("g").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n_copies"))
    return groups.select("doc_id", "n_copies").union(single.select("doc_id", F.lit(1).cast("bigint").alias("n_copies")))
