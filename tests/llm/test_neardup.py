import random
import re

import numpy as np
import pandas as pd
import pytest

from corpusloom.llm import neardup
from corpusloom.llm.neardup import Bands, components, near_groups, near_pairs


def brute(rows, t, k):
    sets = {}
    for i, x in rows:
        w = re.findall(r"[^\W_]+", (x or "").lower())
        sets[i] = (tuple(w), frozenset(zip(*[w[j:] for j in range(k)])))
    out = set()
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            (wa, sa), (wb, sb) = sets[a], sets[b]
            if wa != wb and sa and sb and len(sa & sb) >= t * len(sa | sb) - 1e-12:
                out.add((a, b))
    return out


def corpus(seed, n=60, words=70):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 8, 20, words, words * 3]))] for _ in range(n)]
    rows = []
    for i, b in enumerate(base):
        rows.append((f"d{i:03d}a", " ".join(b)))
        e = list(b)
        for _ in range(r.randint(0, max(1, len(e) // 15))):
            p = r.randrange(len(e))
            e[p : p + 1] = r.choice([[], [r.choice(vocab)], [e[p], r.choice(vocab)]])
        rows.append((f"d{i:03d}b", ", ".join(e).upper()))
    return rows + [("n1", None), ("n2", ""), ("n3", "--- !!"), ("n4", "one two"), ("n5", "one two")]


@pytest.mark.parametrize("seed,t,k", [(1, 0.6, 3), (2, 0.8, 5)])
@pytest.mark.parametrize("hot", [8192, 2])
def test_pairs_against_brute_force(spark, monkeypatch, seed, t, k, hot):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    monkeypatch.setattr(neardup.similar_classes, "__defaults__", (hot, None))
    got = [tuple(r) for r in near_pairs(df, "doc_id", "text", t, k).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, t, k)


def test_copies_are_one_class_but_all_have_its_links(spark):
    a = " ".join(f"w{i}" for i in range(50))
    rows = [(f"c{i}", a.upper() if i % 2 else a) for i in range(6)] + [("z", a + " more"), ("y", "x"), (None, a)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id string, text string, rid int, band int")
    assert {tuple(r) for r in near_pairs(df, "doc_id", "text", 0.8, 5).collect()} == {(f"c{i}", "z") for i in range(6)}
    groups = {r["doc_id"]: (r["group_id"], r["n_links"]) for r in near_groups(df, "doc_id", "text", 0.8, 5).collect()}
    assert groups == {**{f"c{i}": ("c0", 1) for i in range(6)}, "z": ("c0", 1), "y": ("y", 0)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id string, text string")
    assert near_pairs(df, "doc_id", "text").count() == 0 and near_groups(df, "doc_id", "text").count() == 0


def test_components(spark):
    edges = [(f"n{i:02d}", f"n{i + 1:02d}") for i in range(20)] + [("x", "y"), ("y", "x"), ("z", "y")]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "x string, y string")).collect()}
    assert got == {**{f"n{i:02d}": "n00" for i in range(21)}, "x": "x", "y": "x", "z": "x"}


def test_sketch_distance_is_a_lower_bound_at_every_width():
    r = np.random.default_rng(3)
    for _ in range(30):
        a = set(r.integers(0, 1 << 40, 60).tolist())
        b = set(list(a)[:50]) | set(r.integers(0, 1 << 40, 15).tolist())
        s = np.array(sorted(a) + sorted(b), dtype=np.uint64)
        d = np.array([0] * len(a) + [1] * len(b))
        wide = neardup._sketches(s, d, np.array([0, 1]), 4)
        for words in (4, 2, 1):
            sk = neardup._sketches(s, d, np.array([0, 1]), words)
            assert (sk == wide).all() and np.bitwise_count(sk[0] ^ sk[1]).sum() <= len(a ^ b)
            wide = wide[:, : words // 2] ^ wide[:, words // 2 :]


@pytest.mark.parametrize("t", [0.3, 0.6, 0.8])
def test_keys_of_alike_sets_meet(t):
    bands, r = Bands(t), np.random.default_rng(5)
    for _ in range(3000):
        n, extra = int(r.integers(1, 40)), r.integers(0, 1000, 60)
        a = set(r.integers(0, 1000, n).tolist())
        b = set(r.permutation(list(a))[: int(r.integers(0, len(a) + 1))].tolist()) | set(extra[: int(r.integers(0, n))].tolist())
        if b and len(a & b) >= t * len(a | b):
            k = lambda s: set(sorted(s)[: bands.keys(np.array(len(s)))])
            assert k(a) & k(b)


def ha(n):
    return [(f"h{i:04d}", " ".join(["ha"] * i)) for i in range(3, n + 3)]


@pytest.mark.parametrize("n,hot", [(1100, 1024), (1100, 8192), (300, 100)])
def test_sets_of_one_hot_key(spark, n, hot):
    """Texts of one repeated word have one shingle: all pairs are alike, however many there are."""
    _, reps = neardup.classes(spark.createDataFrame(ha(n), "doc_id string, text string").repartition(4), "doc_id", "text")
    got = neardup.similar_classes(reps, 0.6, 3, hot=hot)
    assert got.count() == n * (n - 1) // 2 and got.distinct().count() == n * (n - 1) // 2


def test_keys_spread_over_blocks(spark, monkeypatch):
    """A table of counts that calls every key frequent spreads all of them over blocks; the pairs are the same."""
    rows = corpus(4)
    monkeypatch.setattr(neardup, "rarity", lambda reps, shingle: np.full(neardup.CELLS, 18, dtype=np.uint8))
    got = near_pairs(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id", "text", 0.6, 3)
    assert {tuple(r) for r in got.collect()} == brute(rows, 0.6, 3)


def test_very_long_texts(spark):
    """A long text's keys stay in proportion to it, and its edited copy is found; a text that shares a third is not."""
    r = random.Random(11)
    words = [f"w{r.randrange(50_000)}" for _ in range(60_000)]
    edited = list(words)
    for i in r.sample(range(60_000), 3000):
        edited[i] = "changed"
    rows = [("a", " ".join(words)), ("b", " ".join(edited)), ("c", " ".join(words[:20_000] + [f"v{i}" for i in range(40_000)])), ("d", "short text of its own here")]
    got = near_pairs(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id", "text", 0.6, 3)
    assert {tuple(x) for x in got.collect()} == {("a", "b")}
    frame = pd.DataFrame({"rid": [1], "words": [rows[0][1]]})
    rare = type("Sent", (), {"value": np.zeros(neardup.CELLS, dtype=np.uint8)})
    assert sum(f["body"].str.len().sum() for f in neardup._key_blocks(0.6, 3, 2600, rare)([frame])) < 6 * len(rows[0][1])


def test_exchange_of_many_blocks():
    """At the block count of 30 GB the packed keys stay below four times the text, and hardly grow with the count."""
    r = np.random.default_rng(8)
    vocab = ["".join(chr(97 + c) for c in r.integers(0, 26, n)) for n in r.integers(3, 9, 5000)]
    texts = [" ".join(vocab[i] for i in r.integers(0, 5000, n)) for n in r.integers(40, 250, 12_000)]
    frame = pd.DataFrame({"rid": np.arange(len(texts)), "words": texts})
    rare = type("Sent", (), {"value": np.zeros(neardup.CELLS, dtype=np.uint8)})
    few, many = (sum(f["body"].str.len().sum() for f in neardup._key_blocks(0.6, 3, blocks, rare)([frame])) for blocks in (12, 2600))
    assert many < 4 * sum(map(len, texts)) and many < 1.2 * few
