"""Problem 6: filling containers of fixed capacity, by Karmarkar-Karp multiway differencing.

Items go to blocks of about ``WINDOWS`` containers each by a hash, so a block is small whatever the input and all blocks are
solved at once. Within a block an item above the capacity is cut into full containers and a rest; all other pieces start as
partial partitions into k windows, of one filled window each. The two partitions of the largest imbalance are merged again
and again, the fullest window of one with the emptiest of the other, until one partition is left: its windows are near
equal. k starts at the least that could do. While a window exceeds the capacity, pieces are exchanged between it and others
with room; if that does not do, k rises.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.tokens import VOCABULARY, with_tokens
from corpusloom.session import durable, ship, table

#: Containers of a block: more gives less waste by rounding up (one in so many), and costs as much more time.
WINDOWS = 96


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Items (by number) of each of k windows of near-equal sums."""
    # a partition: imbalance, number, sums in falling order, and a tree of items for each sum; missing windows are empty
    heap = [(-s, i, [s], [i]) for i, s in enumerate(sizes)]
    if k == 1 or not heap:
        return [list(range(len(sizes)))]
    heapq.heapify(heap)
    no = len(sizes)
    while len(heap) > 1:
        _, _, a, ta = heapq.heappop(heap)
        _, _, b, tb = heap[0]
        over = len(a) + len(b) - k
        if over <= 0:
            sums, trees = a + b, ta + tb
        else:
            alone_a, alone_b = len(a) - over, len(b) - over
            sums = a[:alone_a] + b[:alone_b]
            trees = ta[:alone_a] + tb[:alone_b]
            for i in range(over):  # the fullest of the overlap with the emptiest
                j = len(b) - 1 - i
                sums.append(a[alone_a + i] + b[j])
                trees.append((ta[alone_a + i], tb[j]))
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, trees = [sums[x] for x in order], [trees[x] for x in order]
        low = sums[-1] if len(sums) == k else 0
        heapq.heapreplace(heap, (low - sums[0], no, sums, trees))
        no += 1
    out = []
    for t in heap[0][3]:
        items, todo = [], [t]
        while todo:
            x = todo.pop()
            if type(x) is tuple:
                todo += x
            else:
                items.append(x)
        out.append(items)
    return out


def repair(sizes: list[int], windows: list[list[int]], capacity: int) -> bool:
    """Exchange pieces between windows above the capacity and others, until none is above; False if some stay so.

    A piece of a full window changes places with a smaller one, or with room alone, so that the full window's excess goes
    and the other window stays within the capacity. Of the exchanges that do, the one of the least difference is taken; if
    none does, the one that takes most of the excess away.
    """
    size = np.array([*sizes, 0])
    where = np.zeros(len(size), dtype=np.int64)
    for w, items in enumerate(windows):
        where[items] = w
    where[-1] = -1
    used = np.bincount(where[:-1], weights=size[:-1], minlength=len(windows)).astype(np.int64)
    for _ in range(8 * len(windows)):
        w = int(used.argmax())
        excess = used[w] - capacity
        if excess <= 0:
            break
        mine = np.flatnonzero(where[:-1] == w)
        roomiest = int(used.argmin())
        other = np.r_[np.flatnonzero(where[:-1] != w), len(sizes)]
        to = np.r_[where[other[:-1]], roomiest]
        less = size[mine][:, None] - size[other][None, :]
        ok = (less > 0) & (less <= (capacity - used)[to][None, :])
        if not ok.any():
            return False
        cost = np.where(ok, np.where(less >= excess, less, (1 << 40) - less), 1 << 50)
        i, j = np.unravel_index(int(cost.argmin()), cost.shape)
        d = int(less[i, j])
        used[w] -= d
        used[to[j]] += d
        where[mine[i]] = to[j]
        if other[j] < len(sizes):
            where[other[j]] = w
    if used.max() > capacity:
        return False
    o = np.argsort(where[:-1], kind="stable")
    for w, items in enumerate(np.split(o, np.searchsorted(where[:-1][o], np.arange(1, len(windows))))):
        windows[w] = items.tolist()
    return True


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Windows of at most ``capacity`` each, for sizes of 1 to ``capacity``."""
    total = sum(sizes)
    # no two pieces above half a container share one
    k = max(1, -(-total // capacity), sum(2 * s > capacity for s in sizes))
    while True:
        windows = differencing(sizes, k)
        excess = sum(max(0, sum(sizes[i] for i in w) - capacity) for w in windows)
        if not excess or repair(sizes, windows, capacity):
            return windows
        k += max(1, excess // capacity)


def _pack_block(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
    pack_id, block = int(key[0]), int(key[1])
    capacity = int(f["capacity_tokens"].iloc[0])
    f = f.sort_values("doc_id", kind="stable")
    out, pieces, n = [], [], 0
    for doc, size in zip(f["doc_id"].tolist(), f["n_tokens"].tolist()):
        full = size // capacity if size > capacity else 0
        for p in range(full):
            out.append((doc, p, p * capacity, capacity, n))
            n += 1
        rest = size - full * capacity
        if rest or not size:
            pieces.append((doc, full, full * capacity, rest))
    filled = [p for p in pieces if p[3]]
    for w in pack([p[3] for p in filled], capacity) if filled else []:
        if w:
            out += [(*filled[i], n) for i in w]
            n += 1
    out += [(*p, 0) for p in pieces if not p[3]]  # texts without a token take no room
    r = pd.DataFrame(out, columns=["doc_id", "piece_no", "start_token", "n_tokens", "container_id"])
    r["container_id"] += block << 24
    return r.assign(pack_id=pack_id, capacity_tokens=capacity)


def assign(items: DataFrame, capacities: DataFrame, windows: int = WINDOWS) -> DataFrame:
    """``pack_id, capacity_tokens, container_id, doc_id, piece_no, start_token, n_tokens`` of every piece.

    ``items``: ``doc_id, n_tokens``. ``capacities``: ``pack_id, capacity_tokens``, a small table. Every item comes out for
    every capacity, whole unless it exceeds the capacity alone. Items of 0 tokens are kept in their block's first
    container; a null size counts as 0, items without an id take no part. Empty tables give an empty result; a capacity below 1 is an error.
    """
    ship(items.sparkSession)
    items = items.where("doc_id is not null").select("doc_id", F.greatest(F.coalesce("n_tokens", F.lit(0)), F.lit(0)).cast("bigint").alias("n_tokens"))
    caps = capacities.select("pack_id", "capacity_tokens").limit(10_001).collect()
    if len(caps) > 10_000 or any(c[1] is None or c[1] < 1 for c in caps):
        raise ValueError("capacities: at most 10000 rows, each of at least one token")
    if not caps:
        return items.sparkSession.createDataFrame([], _SCHEMA)
    total = items.select(F.sum("n_tokens")).first()[0] or 0
    sized = [(int(p), int(c), max(1, round(total / (c * windows)))) for p, c in caps]
    each = F.explode(F.array(*[F.struct(F.lit(p).cast("bigint").alias("pack_id"), F.lit(c).cast("bigint").alias("capacity_tokens"), F.lit(b).cast("bigint").alias("blocks")) for p, c, b in sized])).alias("c")
    rows = items.select("doc_id", "n_tokens", each).select("doc_id", "n_tokens", "c.*")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    return rows.groupBy("pack_id", "block").applyInPandas(_pack_block, _SCHEMA)


_SCHEMA = "pack_id bigint, capacity_tokens bigint, container_id bigint, doc_id bigint, piece_no bigint, start_token bigint, n_tokens bigint"


def p6_assignments(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    items = durable(with_tokens(table(spark, sf_dir, "documents"), ["doc_id"], vocabulary=vocabulary))
    return assign(items, table(spark, sf_dir, "pack_sizes"))


def p6_fill(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """For each capacity: containers, tokens, the share of room in use, and how many texts had to be cut."""
    a = p6_assignments(spark, sf_dir, vocabulary).where("n_tokens > 0")
    per = a.groupBy("pack_id", "capacity_tokens", "container_id").agg(F.sum("n_tokens").alias("used"), F.count_if(F.col("piece_no") == 1).alias("cut"))
    out = per.groupBy("pack_id", "capacity_tokens").agg(F.count(F.lit(1)).alias("containers"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.sum("cut").alias("texts_cut"))
    return out.withColumn("fill_ratio", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))


def p6_checks(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """What every packing must keep, for each capacity: all documents are there; containers above the capacity, documents
    that were cut though they fit, and documents whose pieces do not add up without gaps to their tokens are none."""
    items = durable(with_tokens(table(spark, sf_dir, "documents"), ["doc_id"], vocabulary=vocabulary))
    a = durable(assign(items, table(spark, sf_dir, "pack_sizes")))
    key = ["pack_id", "capacity_tokens"]
    room = a.groupBy(*key, "container_id").agg(F.sum("n_tokens").alias("used")).groupBy(*key).agg(F.count_if(F.col("used") > F.col("capacity_tokens")).alias("over_full"))
    doc = a.groupBy(*key, "doc_id").agg(F.count(F.lit(1)).alias("pieces"), F.sum("n_tokens").alias("sum"), F.max(F.col("start_token") + F.col("n_tokens")).alias("end"), F.max("piece_no").alias("last"))
    whole = (F.col("sum") == F.col("n_tokens")) & (F.col("end") == F.col("n_tokens")) & (F.col("last") == F.col("pieces") - 1)
    doc = doc.join(items, "doc_id").groupBy(*key).agg(F.count(F.lit(1)).alias("n_docs"), F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= F.col("capacity_tokens"))).alias("cut_needlessly"), F.count_if(~whole).alias("not_whole"))
    return doc.join(room, key).select(*key, "n_docs", "over_full", "cut_needlessly", "not_whole")
