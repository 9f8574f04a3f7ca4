import random

import numpy as np
import pandas as pd
import pytest

from corpusloom.llm import copies, spans


def groups(spark, rows, part_rows=copies.PART_ROWS):
    df = spark.createDataFrame(rows, "doc_id string, exact_canon_text string").repartition(3)
    g, possible, single = copies.copy_groups(df, part_rows=part_rows)
    out = {}
    for r in g.collect():
        out.setdefault(bytes(r["g"]), []).append(r["doc_id"])
    return {tuple(sorted(v)) for v in out.values() if len(v) > 1}, {r["doc_id"] for r in single.collect()}, {r["doc_id"] for r in possible.collect()}


@pytest.mark.parametrize("part_rows", [copies.PART_ROWS, 4])
def test_copies(spark, part_rows):
    rows = [
        ("a1", "Hello,  world"), ("a2", "hello world!"), ("a3", "world hello"),
        ("b1", "title: red lamp | sku: AB1 | stock: 5"), ("b2", "stock : 5; title: Red Lamp; SKU: ab1"), ("b3", "title: red lamp sku: ab1 stock: 5"), ("b4", "stock: 6; title: red lamp; sku: ab1"),
        ("c1", "title red lamp sku ab1 stock 5"),  # no record, but the words of b1
        ("d1", "title: x y"), ("d2", "y title: x"),
        ("e1", None), ("e2", ""), ("e3", "--"), ("f1", "unique text here"), (None, "hello world"),
    ]
    got, single, possible = groups(spark, rows, part_rows)
    assert got == {("a1", "a2"), ("b1", "b2", "b3", "c1")}
    assert single | possible == {r[0] for r in rows if r[0]} and not single & possible
    assert {"e1", "e2", "e3"} <= single


def test_records_that_share_words_in_other_fields_join(spark):
    # the same words, cut into fields in two ways: each has a copy in another order
    rows = [("a", "title: x size y city: z stock: 1"), ("b", "title: x size: y city: z stock: 1"), ("c", "stock: 1 title: x size y city: z"), ("d", "stock: 1 city: z size: y title: x")]
    assert groups(spark, rows)[0] == {("a", "b", "c", "d")}


def test_records_in_batches_of_their_own(spark):
    # tasks with records alone and tasks with other texts too see the same hashes
    rec = lambda i, turn: "; ".join([f"title: lamp {i}", f"stock: {i}", "city: x"][::turn])
    a = spark.createDataFrame([(f"a{i}", rec(i, 1)) for i in range(50)], "doc_id string, exact_canon_text string").coalesce(1)
    b = spark.createDataFrame([(f"b{i}", rec(i, -1)) for i in range(50)] + [(f"c{i}", f"text {i}") for i in range(50)], "doc_id string, exact_canon_text string").coalesce(1)
    g, possible, _ = copies.copy_groups(a.union(b))
    assert g.groupBy("g").count().where("count = 2").count() == 50 and possible.where("doc_id like 'c%'").count() <= 2


def test_hot_group_and_no_miss(spark):
    rows = [(f"h{i:04d}", "same text" if i % 3 else f"text {i % 400}") for i in range(1500)]
    got, single, _ = groups(spark, rows)
    assert len(next(g for g in got if "h0001" in g)) == 1000
    assert sum(len(g) for g in got) + len({x for x in single}) >= 1000 + 2 * 100
    truth = {}
    for i, t in rows:
        truth.setdefault(t, []).append(i)
    assert got == {tuple(sorted(v)) for v in truth.values() if len(v) > 1}


@pytest.mark.parametrize("bits,hashes", [(1 << 20, 1 << 16), (1 << 20, 1 << 17)])
def test_filters_let_few_singletons_pass(bits, hashes):
    """The load of a filter is the same for 10^9 rows as for these: 16 bits a hash, 8 if every row is a record."""
    import zlib

    r = np.random.default_rng(1)
    once = r.integers(-(1 << 62), 1 << 62, hashes * 9 // 10)
    twice = r.integers(-(1 << 62), 1 << 62, hashes // 20)
    h = r.permutation(np.concatenate([once, twice, twice]))
    parts = [x for i in range(8) for x in copies._filters(bits)([pd.DataFrame({"h": y}) for y in np.array_split(h[i::8], 3)])]
    again = np.zeros(bits // 8, dtype=np.uint8)
    for segment, bodies in pd.concat(parts).groupby("segment")["body"]:
        both = np.frombuffer(zlib.decompress(copies._merge([copies._merge(bodies[:3]), *bodies[3:]])), np.uint8)
        again[segment * copies._SEGMENT : segment * copies._SEGMENT + len(both) // 2] = both[len(both) // 2 :]
    hit = lambda h: ((again[(p := copies._positions(h, bits)) >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).all(axis=1).mean()
    assert hit(twice) == 1 and hit(once) < 0.05


def test_hot_groups_are_joined_in_place(spark):
    from corpusloom.operators.skew import join_groups

    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i % 40}", "x") for i in range(900)] + [(901, None, "x")], "id int, k string, first_id string").drop("first_id")
    sizes = rows.where("k is not null").groupBy("k").count().withColumnRenamed("count", "n")
    want = {(r["id"], r["k"]) for r in rows.where("k is not null").collect()}
    for least in (100, 5, 10_000):
        assert {(r["id"], r["k"]) for r in join_groups(rows, sizes, "k", hot_rows=least).collect()} == want


def test_empty_copies(spark):
    assert groups(spark, []) == (set(), set(), set())


def brute_spans(rows, w):
    seen = {}
    for d, t in rows:
        for i in range(len(t or "") - w + 1):
            seen.setdefault(t[i : i + w], set()).add(d)
    out = set()
    for d, t in rows:
        run = None
        for i in range(len(t or "") - w + 1):
            if len(seen[t[i : i + w]]) > 1:
                if run and i <= run[1]:
                    run = (run[0], i + w)
                else:
                    if run:
                        out.add((d, *run))
                    run = (i, i + w)
        if run:
            out.add((d, *run))
    return out


@pytest.mark.parametrize("hot", [20_000, 3])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spans_against_brute_force(spark, seed, hot):
    r = random.Random(seed)
    text = lambda n, a="abcdefghij kl": "".join(r.choice(a) for _ in range(n))
    shared = [text(r.choice([60, 79, 80, 81, 150, 400]), "xyzäöü𝒳é ") for _ in range(6)]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(r.randint(0, 4)):
            s = r.choice(shared)
            cut = r.randint(0, 20)
            parts += [text(r.randint(0, 60)), s[cut:] if r.random() < 0.5 else s]
        rows.append((d, "".join(parts)))
    rows += [(90, None), (91, ""), (92, "a" * 300), (93, "a" * 200), (94, "b" * 500), (95, text(200)), (96, "ab" * 100 + "𝒳" * 90), (97, "ab" * 90)]
    rows += [(98, rows[5][1]), (99, rows[5][1])]
    df = spark.createDataFrame([(*x, 1, "z") for x in rows], "doc_id bigint, text string, h int, p string").repartition(3)
    got = [tuple(x) for x in spans.shared_spans(df, 80, hot).select("doc_id", "start_at", "end_at").collect()]
    assert len(got) == len(set(got)) and set(got) == brute_spans(rows, 80)


def test_coverage_and_empty(spark):
    df = spark.createDataFrame([(1, "q" * 50 + "r" * 200), (2, "r" * 200 + "s"), (3, None), (4, "t")], "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_spans"], r["shared_chars"], r["shared_ratio"]) for r in spans.coverage(df, spans.shared_spans(df)).collect()}
    assert got == {1: (1, 200, 0.8), 2: (1, 200, round(200 / 201, 6)), 3: (0, 0, 0.0), 4: (0, 0, 0.0)}
    assert spans.shared_spans(df.where("false")).count() == 0
    with pytest.raises(ValueError):
        spans.shared_spans(df, 40)
