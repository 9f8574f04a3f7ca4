"""Problem 7: mixing sources to target shares, by systematic sampling.

The total size of a mixture is the largest at which every source still reaches its share within its repeats. Sources that
are absent, or so small that they would hold the total below ``MIN_SCALE`` of what the mixture's sources have, give all
they may and their missing part goes to the others by their shares. Each record of a source has the same expected number of
copies. Expected copies are summed up in an order by size within the source (so that all lengths are hit alike), one random
offset is added, and a record is emitted once for each integer its stretch of the sum crosses. As shares are of tokens and
texts differ in length, ``OFFSETS`` random offsets are tried, each with the expected copies changed by up to ``STRETCH``, and
the one is taken whose records' tokens come nearest to those that are due; one pass over the numbered records sums them up for all of these. Prefix sums are taken over
blocks of records: counts of blocks are added up first, then each block numbers its own records, so that no source is ever
gathered in one task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.tokens import VOCABULARY, with_tokens
from corpusloom.session import durable, table

MIN_SCALE = 0.05
#: Random offsets of which the best is taken, and by which part the expected copies may change with them.
OFFSETS, STRETCH = 64, 0.05
#: Records of a block, about.
BLOCK_ROWS = 20_000


def plan(supply: dict[str, int], targets: list[tuple[str, float, int]], min_scale: float = MIN_SCALE) -> dict[str, float]:
    """Expected copies of each record by source. ``targets``: (source, share, repeats)."""
    have = {s: supply.get(s, 0) for s, _, _ in targets}
    cap = {s: have[s] * r for s, _, r in targets}
    share = {s: max(0.0, float(x)) for s, x, _ in targets}
    floor = min_scale * sum(have.values())
    able = {s for s in share if share[s] > 0 and cap[s] > 0 and cap[s] / share[s] >= floor}
    small = {s for s in share if share[s] > 0 and cap[s] > 0} - able
    if not able:
        return {s: (cap[s] / have[s] if have[s] and share[s] else 0.0) for s in share}
    # the able sources stand to each other as their shares do; the small ones take the rest as far as they reach
    unit = min(cap[s] / share[s] for s in able)
    given = {s: share[s] * unit for s in able}
    for s in small:
        given[s] = min(cap[s], share[s] * unit)
    return {s: (given.get(s, 0.0) / have[s] if have[s] else 0.0) for s in share}


def _offset(seed: int, mixture: str, source: str, k: int) -> float:
    return int.from_bytes(hashlib.sha256(f"{seed}\u0001{mixture}\u0001{source}\u0001{k}".encode()).digest()[:6], "big") / 2**48


def _crossed(shift, rate, i):
    """How many integers the i-th record's stretch of the sum of expected copies crosses."""
    return F.floor(shift + rate * i) - F.floor(shift + rate * (i - 1))


def mix(items: DataFrame, targets: DataFrame, seed: int = 42, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``mixture_name, source, doc_id, copy_no, n_tokens``: one row for each copy.

    ``items``: ``doc_id, source, n_tokens``; rows without an id or a source belong to no mixture, null sizes count as 0. ``targets``: ``mixture_name, source,
    target_share, max_repeats``, a small table. A source may be named by several mixtures. Records of 0 tokens are sampled
    like others. Absent sources and empty tables give no row.
    """
    spark = items.sparkSession
    items = items.where("doc_id is not null").select("doc_id", "source", F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("bigint").alias("n_tokens"))
    goals = targets.where("source is not null and target_share is not null").groupBy("mixture_name", "source").agg(F.max("target_share").alias("s"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("r")).limit(100_001).collect()
    if len(goals) > 100_000:
        raise ValueError("at most 100000 targets")
    sizes = items.where("source is not null").groupBy("source").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    named = sorted({g["source"] for g in goals})
    known = {r["source"]: r for r in sizes.where(F.col("source").isin(named)).collect()}  # bounded by the targets
    rates = []
    for m in sorted({g["mixture_name"] for g in goals}):
        of = [(g["source"], g["s"], g["r"]) for g in goals if g["mixture_name"] == m]
        copies = plan({s: int(r["t"] or 0) for s, r in known.items()}, sorted(of))
        most = {s: float(r) for s, _, r in of}
        for s, c in copies.items():
            if c > 0:
                stretch = [1 + STRETCH * (2 * _offset(seed, m, s, -k) - 1) if k else 1.0 for k in range(OFFSETS)]
                rates.append((m, s, c, [_offset(seed, m, s, k) for k in range(OFFSETS)], [min(c * x, most[s]) for x in stretch]))
    if not rates:
        return spark.createDataFrame([], "mixture_name string, source string, doc_id bigint, copy_no int, n_tokens bigint")
    rate = spark.createDataFrame(rates, "mixture_name string, source string, due double, shifts array<double>, rates array<double>")
    blocks = {s: max(1, -(-r["n"] // block_rows)) for s, r in known.items()}
    pairs = [x for s in sorted(blocks) for x in (F.lit(s), F.lit(blocks[s]))]
    # blocks by size first: records of one length class lie together, a hash parts them further
    rows = items.where(F.col("source").isin(sorted(known))).withColumn("size_class", F.floor(F.log2(F.col("n_tokens") + 1) * 2).cast("int"))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.element_at(F.create_map(*pairs), F.col("source"))))
    group = ["source", "size_class", "salt"]
    counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("size_class", "salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inner = Window.partitionBy(*group).orderBy("n_tokens", F.xxhash64("doc_id", F.lit(seed)), "doc_id")
    numbered = rows.withColumn("i", F.row_number().over(inner)).join(starts, group).withColumn("i", F.col("i") + F.col("start"))
    numbered = durable(numbered.select("source", "doc_id", "n_tokens", "i"))
    tried = numbered.join(F.broadcast(rate), "source")  # at most 100000 rows, checked above
    sums = [F.sum(F.col("n_tokens") * _crossed(F.col("shifts")[k], F.col("rates")[k], F.col("i"))).alias(f"t{k}") for k in range(OFFSETS)]
    best = []
    for r in tried.groupBy("mixture_name", "source").agg(F.first("due").alias("due"), F.first("shifts").alias("shifts"), F.first("rates").alias("rates"), *sums).collect():  # a row a target
        due = r["due"] * int(known[r["source"]]["t"] or 0)
        k = min(range(OFFSETS), key=lambda k: (abs(r[f"t{k}"] - due), k))
        best.append((r["mixture_name"], r["source"], r["rates"][k], r["shifts"][k]))
    out = numbered.join(F.broadcast(spark.createDataFrame(best, "mixture_name string, source string, rate double, shift double")), "source")
    out = out.withColumn("n", _crossed(F.col("shift"), F.col("rate"), F.col("i")).cast("int")).where("n > 0").withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("n"))))
    return out.select("mixture_name", "source", "doc_id", "copy_no", "n_tokens")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """For each mixture and source: the target, the share of all tokens reached, tokens, rows and the most copies of one record."""
    per = mixed.groupBy("mixture_name", "source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("n_rows"), F.max("copy_no").cast("bigint").alias("most_copies"))
    out = targets.select("mixture_name", "source", "target_share", "max_repeats").join(per, ["mixture_name", "source"], "left").fillna(0, ["tokens", "n_rows", "most_copies"])
    total = F.sum("tokens").over(Window.partitionBy("mixture_name"))
    return out.withColumn("reached_share", F.when(total > 0, F.round(F.col("tokens") / total, 6)).otherwise(F.lit(0.0)))


def _items(spark: SparkSession, sf_dir: str, vocabulary: str) -> DataFrame:
    return durable(with_tokens(table(spark, sf_dir, "documents"), ["doc_id", "source"], vocabulary=vocabulary))


def p7_mixture(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return mix(_items(spark, sf_dir, vocabulary), table(spark, sf_dir, "mixture_targets"))


def p7_shares(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    targets = table(spark, sf_dir, "mixture_targets")
    return shares(mix(_items(spark, sf_dir, vocabulary), targets), targets)


def p7_checks(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """What every mixture must keep, for each target: no record more often than allowed, all of the source, and copies
    numbered from 1 without gaps. Targets without a record keep it all."""
    items, targets = _items(spark, sf_dir, vocabulary), table(spark, sf_dir, "mixture_targets")
    m = mix(items, targets).groupBy("mixture_name", "source", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max("copy_no").alias("most"))
    m = m.join(items.select("doc_id", F.col("source").alias("own")), "doc_id", "left")
    per = m.groupBy("mixture_name", "source").agg(F.max("most").alias("most"), F.bool_and(F.col("own") == F.col("source")).alias("known"), F.bool_and(F.col("n") == F.col("most")).alias("numbered"))
    out = targets.join(per, ["mixture_name", "source"], "left")
    return out.select("mixture_name", "source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_repeats"), F.coalesce("known", F.lit(True)).alias("all_known"), F.coalesce("numbered", F.lit(True)).alias("copies_numbered"))
