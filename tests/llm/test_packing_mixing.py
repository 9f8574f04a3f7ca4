import random

import pytest

from corpusloom.llm import mixing, packing
from corpusloom.llm.tokens import with_tokens


@pytest.mark.parametrize("seed", range(5))
def test_differencing(seed):
    r = random.Random(seed)
    sizes = [r.randint(1, 900) for _ in range(150)]
    w = packing.differencing(sizes, 12)
    sums = [sum(sizes[i] for i in x) for x in w]
    assert sorted(i for x in w for i in x) == list(range(150)) and max(sums) - min(sums) <= 30
    for cap in (900, 1500, 5000):
        p = packing.pack(sizes, cap)
        assert sorted(i for x in p for i in x) == list(range(150)) and all(sum(sizes[i] for i in x) <= cap for x in p)
    assert packing.pack([5], 5) == [[0]] and len([x for x in packing.pack([5, 5, 5], 5) if x]) == 3


@pytest.mark.parametrize("seed", range(4))
def test_no_window_too_many(seed):
    """On log-normal sizes the count of windows is the lower bound, or that of best-fit decreasing, whichever is larger."""
    r = random.Random(seed)
    cap = 2048
    sizes = [min(cap, max(1, int(r.lognormvariate(5.3, 0.9)))) for _ in range(600)]
    rooms: list[int] = []
    for s in sorted(sizes, reverse=True):
        fit = [i for i, x in enumerate(rooms) if x >= s]
        if fit:
            rooms[min(fit, key=rooms.__getitem__)] -= s
        else:
            rooms.append(cap - s)
    p = [w for w in packing.pack(sizes, cap) if w]
    assert sorted(i for x in p for i in x) == list(range(600)) and all(sum(sizes[i] for i in x) <= cap for x in p)
    assert len(p) <= len(rooms)


def test_assign(spark):
    r = random.Random(1)
    rows = [(i, r.choice([0, 1, 5, 50, 100, 101, 250, 1000])) for i in range(500)]
    items = spark.createDataFrame([(*x, "s", 1) for x in rows] + [(None, 7, "s", 1)], "doc_id bigint, n_tokens bigint, source string, container_id int").repartition(5)
    caps = spark.createDataFrame([(1, 100), (2, 2000)], "pack_id bigint, capacity_tokens bigint")
    out = packing.assign(items, caps).collect()
    for p, c in ((1, 100), (2, 2000)):
        mine = [x for x in out if x["pack_id"] == p]
        room, parts = {}, {}
        for x in mine:
            room[x["container_id"]] = room.get(x["container_id"], 0) + x["n_tokens"]
            parts.setdefault(x["doc_id"], []).append((x["start_token"], x["n_tokens"]))
        assert max(room.values()) <= c and set(parts) == {i for i, _ in rows}
        for i, n in rows:
            at = 0
            for s, k in sorted(parts[i]):
                assert s == at
                at += k
            assert at == n and (len(parts[i]) == 1 or n > c)
        used = [v for v in room.values() if v]
        assert sum(used) / (len(used) * c) > 0.9
    assert packing.assign(items.where("false"), caps).count() == 0 and packing.assign(items, caps.where("false")).count() == 0
    with pytest.raises(ValueError):
        packing.assign(items, spark.createDataFrame([(1, 0)], "pack_id bigint, capacity_tokens bigint"))


def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "x" * 100_000)], "doc_id bigint, text string")
    n = {r["doc_id"]: r["n_tokens"] for r in with_tokens(df, ["doc_id"]).collect()}
    assert n[1] == 2 and n[2] == n[3] == 0 and n[4] > 1000


def test_plan():
    supply = {"a": 10_000, "b": 1000, "tiny": 1}
    p = mixing.plan(supply, [("a", 0.5, 2), ("b", 0.3, 3), ("tiny", 0.1, 4), ("gone", 0.1, 4)])
    assert p["b"] == pytest.approx(3) and p["a"] == pytest.approx(0.5) and p["tiny"] == pytest.approx(4) and p["gone"] == 0
    assert mixing.plan({}, [("a", 1.0, 1)]) == {"a": 0.0}


def test_shares_of_long_tailed_texts(spark):
    """Few long texts among many short ones: shares of tokens come within a point of the targets where supply allows."""
    r = random.Random(5)
    rows = [(i, f"s{i % 4}", int(r.lognormvariate(5, 1.6)) + 1) for i in range(1600)] + [(9999, "tiny", 40)]
    items = spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("m", f"s{i}", x, 2) for i, x in enumerate((0.125, 0.2, 0.3, 0.374))] + [("m", "tiny", 0.001, 3)], "mixture_name string, source string, target_share double, max_repeats bigint")
    got = {x["source"]: x["reached_share"] - x["target_share"] for x in mixing.shares(mixing.mix(items, targets), targets).collect()}
    assert max(map(abs, got.values())) < 0.01


@pytest.mark.parametrize("block", [20_000, 37])
def test_mix(spark, block):
    r = random.Random(2)
    rows = [(i, "big" if i % 3 == 0 else "mid" if i % 5 else None if i % 2 else "small", r.randint(0, 300)) for i in range(3000)]
    items = spark.createDataFrame([(*x, 9) for x in rows] + [(None, "big", 7, 9)], "doc_id bigint, source string, n_tokens bigint, salt int").repartition(4)
    goals = [("m", "big", 0.5, 2), ("m", "mid", 0.3, 1), ("m", "small", 0.2, 3), ("one", "mid", 1.0, 2), ("none", "absent", 1.0, 2)]
    targets = spark.createDataFrame(goals, "mixture_name string, source string, target_share double, max_repeats bigint")
    out = mixing.mix(items, targets, block_rows=block)
    got = out.collect()
    assert {tuple(x) for x in got} == {tuple(x) for x in mixing.mix(items.repartition(2), targets, block_rows=block).collect()}
    most = {(m, s): k for m, s, _, k in goals}
    assert all(x["copy_no"] <= most[(x["mixture_name"], x["source"])] for x in got)
    assert len({(x["mixture_name"], x["doc_id"], x["copy_no"]) for x in got}) == len(got)
    s = {(x["mixture_name"], x["source"]): x["reached_share"] for x in mixing.shares(out, targets).collect()}
    assert all(abs(s[("m", k)] - v) < 0.01 for k, v in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))
    assert s[("one", "mid")] == 1.0 and s[("none", "absent")] == 0.0
    # the whole of a source at its most, in one mixture of its own
    assert sum(x["mixture_name"] == "one" for x in got) == 2 * sum(x[1] == "mid" for x in rows)
    assert mixing.mix(items.where("false"), targets).count() == 0 and mixing.mix(items, targets.where("false")).count() == 0
