"""Tables of fixed size that tasks fill and a tree merges, segment by segment: no task reads a row of every other one."""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of tasks whose rows of one segment are merged first.
BRANCHES = 64
#: Numbers of one segment of a table of counts.
SEGMENT = 1 << 16
KIND = "segment int, body binary"


def fold_segments(parts: DataFrame, merge) -> DataFrame:
    """``segment int, body binary`` with one row for each segment: ``merge`` makes one body of several."""

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"segment": [key[0]], "body": [merge(f["body"])]})

    some = parts.withColumn("branch", F.pmod(F.spark_partition_id(), F.lit(BRANCHES)))
    return some.groupBy("segment", "branch").applyInPandas(run, KIND).groupBy("segment").applyInPandas(run, KIND)


def cut_counts(n: np.ndarray) -> pd.DataFrame:
    """A task's counts, a multiple of ``SEGMENT`` in number, as compressed segments; those of zeros are left out."""
    n = n.reshape(-1, SEGMENT)
    some = np.flatnonzero(n.any(axis=1))
    return pd.DataFrame({"segment": some, "body": [zlib.compress(n[i].astype(np.uint32).tobytes(), 1) for i in some]})


def add_counts(bodies) -> bytes:
    n = np.zeros(SEGMENT, dtype=np.uint64)
    for b in bodies:
        n += np.frombuffer(zlib.decompress(b), dtype=np.uint32)
    return zlib.compress(np.minimum(n, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1)


def whole_counts(rows, cells: int) -> np.ndarray:
    """``cells`` counts out of (segment, body) rows."""
    n = np.zeros((cells // SEGMENT, SEGMENT))
    for segment, body in rows:
        n[segment] = np.frombuffer(zlib.decompress(body), dtype=np.uint32)
    return n.ravel()


def counted(parts: DataFrame, cells: int) -> np.ndarray:
    """The sum of all tasks' counts: ``cells`` numbers on the driver, however many rows there are."""
    return whole_counts(fold_segments(parts, add_counts).toLocalIterator(), cells)
