"""Problem 8: long exact spans shared between records, by prefix-partitioned suffix trees.

Suffixes are taken at *anchors* only: the position of the smallest ``ANCHOR``-gram hash within every window of
``min_len`` code points. Two equal windows pick the same anchor at the same place, so each shared window is seen from
an anchor that stands in both records, and about one suffix in ``(min_len - ANCHOR) / 2`` is enough. The steps:

1. anchors of every text; those that stand in one record only are dropped. Only (hash, record, place) is exchanged;
   a task that sees an anchor in two records of its own sends one notice for it instead of every place.
2. the remaining anchors get the text around them (``min_len`` to either side less the anchor).
3. suffixes are grouped by their prefix, the anchor; groups are joined to memory-sized blocks. In a block the suffixes
   are sorted, neighbours' common prefixes give the internal nodes of the suffix tree, and the same over the
   reversed left sides its twin. Leaves of two records below one node of depth r that share the left node of depth
   ``min_len - r`` make a maximal repeat.
4. groups above ``HOT`` suffixes are split by longer prefixes. A window that has its anchor after d code points shares d of
   them to the left; so the places d are halved, and the suffixes of either half are grouped by what all its windows
   have in common: 104 code points of 160, then 132 for quarters. What is hot even so goes by whole windows, counted
   by a distributed aggregation, so that no group is gathered in one task.
5. spans that overlap or touch are merged for each record.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.llm.arrays import Rolling, codes, mix, pack, runs, sliding_min, unpack_all
from corpusloom.operators.skew import join_groups
from corpusloom.session import durable, ship, table

ANCHOR = 48
#: Suffixes of one anchor beyond which its group is split by longer prefixes.
HOT = 20_000
#: Entries of one block of the exchange, and suffixes of one block of trees.
BLOCK_ANCHORS, BLOCK_SUFFIXES = 1_000_000, 25_000
#: Into how many ranges of places the suffixes of hot groups are split, one after the other.
SPLITS = (2, 4)
_CHARS = 1 << 20


def _anchors(ids: np.ndarray, texts: list[str], min_len: int):
    """(hash, record, place) of the anchors of some texts, of about a million code points at a time."""
    w = min_len - ANCHOR + 1
    keep = [(i, t) for i, t in zip(ids, texts) if t is not None and len(t) >= min_len]
    at = 0
    while at < len(keep):
        part, size = [], 0
        while at < len(keep) and (not part or size + len(keep[at][1]) <= _CHARS):
            part.append(keep[at])
            size += len(keep[at][1])
            at += 1
        lens = np.array([len(t) for _, t in part])
        ends = np.cumsum(lens)
        starts = ends - lens
        g = Rolling(codes("".join(t for _, t in part))).grams(ANCHOR)
        bits = np.uint64(max(22, int(size).bit_length()))
        low = (np.uint64(1) << bits) - np.uint64(1)
        v = (g & ~low) | np.arange(len(g), dtype=np.uint64)
        m = sliding_min(v, w)
        ok = np.ones(len(m), dtype=bool)
        for e in ends[:-1]:
            ok[max(0, e - min_len + 1) : e] = False  # windows that would cross into the next text
        sel = (m[ok] & low).astype(np.int64)
        sel = np.unique(sel[np.r_[True, sel[1:] != sel[:-1]]])
        d = np.searchsorted(ends, sel, side="right")
        yield g[sel], np.array([i for i, _ in part], dtype=np.int64)[d], sel - starts[d]


def _collect_anchors(min_len: int, blocks: int):
    def run(frames):
        hs, ds, ps = [], [], []
        for f in frames:
            for h, d, p in _anchors(f["doc_id"].to_numpy(), f["text"].tolist(), min_len):
                hs.append(h), ds.append(d), ps.append(p)
        if not hs:
            return
        h, d, p = np.concatenate(hs), np.concatenate(ds), np.concatenate(ps)
        o = np.lexsort((d, h))
        h, d, p = h[o], d[o], p[o]
        st = runs(h)
        known = np.repeat(d[np.r_[st[1:], len(h)] - 1] != d[st], np.diff(np.r_[st, len(h)]))  # in two records already
        notice = np.zeros(len(h), dtype=bool)
        notice[st] = True
        b = (h % np.uint64(blocks)).astype(np.int64)
        send = ~known | notice
        yield pd.DataFrame({"block": (x := _blocks(b[send], h=h[send], d=d[send], p=p[send].astype(np.int32), k=known[send]))[0], "body": x[1]})
        if known.any():  # needs no answer: passes by under a block number of its own
            rest = np.flatnonzero(known)
            own = blocks + int(h[rest[0]] % np.uint64(blocks))
            yield pd.DataFrame({"block": (x := _blocks(np.full(len(rest), own), h=h[rest], d=d[rest], p=p[rest].astype(np.int32), k=known[rest]))[0], "body": x[1]})

    return run


def _blocks(b: np.ndarray, **arrays: np.ndarray) -> tuple[list[int], list[bytes]]:
    """One packed body for each block number; entries in record order, as differences of the records compress well."""
    o = np.lexsort((arrays["d"], b))
    b = b[o]
    st = runs(b)
    en = np.r_[st[1:], len(b)]
    return [int(b[s]) for s in st], [pack(**{k: a[o[s:e]] for k, a in arrays.items()}) for s, e in zip(st, en)]


def _repeated(blocks: int):
    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        x = unpack_all(f["body"])
        h, d, p, k = x["h"], x["d"], x["p"], x["k"]
        if key[0] < blocks:
            o = np.lexsort((d, h))
            h, d, p, k = h[o], d[o], p[o], k[o]
            st = runs(h)
            n = np.diff(np.r_[st, len(h)])
            several = np.repeat((d[st + n - 1] != d[st]) | np.logical_or.reduceat(k, st), n) & ~k
            h, d, p = h[several], d[several], p[several]
        return pd.DataFrame({"h": h.view(np.int64), "doc_id": d, "p": p.astype(np.int32)})

    return run


def _contexts(min_len: int):
    """For each anchor: its record, place, and the text around it with the anchor's offset in it."""
    side = min_len - ANCHOR

    def run(frames):
        for f in frames:
            out = []
            for doc, text, at in zip(f["doc_id"], f["text"], f["at"]):
                for x in at:
                    p = x["p"]
                    out.append((x["h"], doc, p, min(p, side), text[max(0, p - side) : p + min_len], x["hot"]))
            yield pd.DataFrame(out, columns=["h", "doc_id", "p", "off", "ctx", "hot"])

    return run


def _matrix(f: pd.DataFrame, min_len: int) -> np.ndarray:
    """The contexts as rows of code points around the anchor; places outside a text never equal others."""
    side = min_len - ANCHOR
    n = len(f)
    m = np.empty((n, side + min_len), dtype=np.int64)
    m[:] = (0x110000 + np.arange(n))[:, None]
    c = codes("".join(f["ctx"]))
    lens = f["ctx"].str.len().to_numpy()
    row = np.repeat(np.arange(n), lens)
    first = np.cumsum(lens) - lens
    m[row, np.arange(len(c)) - np.repeat(first, lens) + np.repeat(side - f["off"].to_numpy(), lens)] = c
    return m.astype(np.int32)


def _lcp_runs(m: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by (group, row) and the common prefix of each with the one before it (-1 in a new group)."""
    key = np.concatenate([group.astype(">i8")[:, None].view(">i4").reshape(len(m), 2), m.astype(">i4")], axis=1)
    order = np.argsort(np.ascontiguousarray(key).view(f"S{key.shape[1] * 4}").ravel(), kind="stable")  # big-endian: bytes sort as numbers
    s, g = m[order], group[order]
    differ = np.concatenate([s[1:] != s[:-1], np.ones((max(0, len(s) - 1), 1), dtype=bool)], axis=1)
    lcp = np.r_[-1, np.where(g[1:] != g[:-1], -1, differ.argmax(axis=1))] if len(s) else np.zeros(0, dtype=np.int64)
    return order, lcp


def _trees(min_len: int):
    side = min_len - ANCHOR

    def run(f: pd.DataFrame) -> pd.DataFrame:
        n = len(f)
        m = _matrix(f, min_len)
        group = np.unique(f["h"].to_numpy(), return_inverse=True)[1].astype(np.int64)
        first, last = f["lo"].to_numpy(), f["hi"].to_numpy()
        doc = np.unique(f["doc_id"].to_numpy(), return_inverse=True)[1].astype(np.int64)
        ro, rl = _lcp_runs(m[:, side:], group)
        lo, ll = _lcp_runs(m[:, :side][:, ::-1], group)
        least, most = np.full(n, 1 << 30), np.full(n, -1)
        right, left = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        for d in range(side + 1):
            right[ro] = np.cumsum(rl < min_len - d)  # the node of depth min_len - d above each leaf
            left[lo] = np.cumsum(ll < d)
            pair = right * (n + 1) + left
            o = np.argsort(pair, kind="stable")
            st = runs(pair[o])
            size = np.diff(np.r_[st, n])
            dd = doc[o]
            shared = np.empty(n, dtype=bool)
            shared[o] = np.repeat(np.minimum.reduceat(dd, st) != np.maximum.reduceat(dd, st), size)
            shared &= (first <= d) & (d <= last)
            least[shared & (least > d)] = d
            most[shared] = d
        hit = most >= 0
        p = f["p"].to_numpy()[hit]
        return pd.DataFrame({"doc_id": f["doc_id"].to_numpy()[hit], "start_at": p - most[hit], "end_at": p - least[hit] + min_len})

    return run


def _split(min_len: int, ranges: int):
    """Suffixes by longer prefixes: for each range of places of the anchor in a window, what its windows have in common."""
    side = min_len - ANCHOR
    bounds = [(side + 1) * i // ranges for i in range(ranges + 1)]

    def run(frames):
        for f in frames:
            rows = list(zip(f["h"], f["doc_id"], f["p"], f["off"], f["ctx"], f["lo"], f["hi"]))
            texts, out = [], []
            for h, doc, p, off, ctx, lo, hi in rows:
                for d0, d1 in zip(bounds, bounds[1:]):
                    if lo <= d0 < d1 <= hi + 1 and off >= d0 and len(ctx) - off >= min_len - d1 + 1:
                        texts.append(ctx[off - d0 : off + min_len - d1 + 1])
                        out.append((h, doc, p, off, ctx, d0, d1 - 1))
            if not out:
                continue
            c = codes("".join(texts))
            ends = np.cumsum([len(x) for x in texts])
            key = Rolling(c).of(ends - [len(x) for x in texts], ends)
            r = pd.DataFrame(out, columns=["h", "doc_id", "p", "off", "ctx", "lo", "hi"])
            r["h"] = mix(key + mix(r["h"].to_numpy(np.int64).view(np.uint64) + r["lo"].to_numpy(np.int64).astype(np.uint64))).view(np.int64)
            yield r

    return run


def _windows(min_len: int):
    """The longest prefixes, whole windows, of hot groups: (key, record, start)."""

    def run(frames):
        for f in frames:
            if not len(f):
                continue
            ctx, off, p = f["ctx"].tolist(), f["off"].to_numpy(), f["p"].to_numpy()
            lens = np.array([len(x) for x in ctx])
            first = np.maximum(0, off - f["hi"].to_numpy())
            n = np.maximum(0, np.minimum(off - f["lo"].to_numpy(), lens - min_len) - first + 1)
            row = np.repeat(np.arange(len(f)), n)
            s = first[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row]
            at = (np.cumsum(lens) - lens)[row] + s
            k = Rolling(codes("".join(ctx))).of(at, at + min_len)
            k2 = mix(k ^ f["h"].to_numpy(np.int64).view(np.uint64)[row])
            yield pd.DataFrame({"k1": k.view(np.int64), "k2": k2.view(np.int64), "doc_id": f["doc_id"].to_numpy()[row], "start_at": p[row] - off[row] + s})

    return run


def _hot_keys(rows: DataFrame, hot: int) -> DataFrame:
    """Keys of more than ``hot`` suffixes; there are at most as many as suffixes divided by that."""
    return rows.groupBy("h").count().where(F.col("count") > hot).select("h", F.lit(True).alias("hot"))


def shared_spans(documents: DataFrame, min_len: int = 160, hot: int = HOT) -> DataFrame:
    """Maximal stretches of each text that are covered by windows of ``min_len`` code points found in another record too.

    ``documents`` has ``doc_id`` (bigint, unique) and ``text``; other columns are ignored. Returns ``doc_id, start_at,
    end_at``. Null, empty and shorter texts have no span; repeats within one record alone do not count; records that
    are copies of each other are covered as a whole; an empty table gives an empty result.
    """
    if min_len <= ANCHOR:
        raise ValueError(f"min_len must be above {ANCHOR}")
    spark = documents.sparkSession
    ship(spark)
    docs = documents.select("doc_id", "text").where("text is not null and doc_id is not null")
    chars = docs.select(F.sum(F.length("text"))).first()[0] or 0
    blocks = 1 + int(chars / ((min_len - ANCHOR) / 2) / BLOCK_ANCHORS) * 2
    blocks = max(blocks, min(12, 1 + chars // 5_000_000))
    anchors = docs.mapInPandas(_collect_anchors(min_len, blocks), "block int, body binary")
    places = durable(anchors.groupBy("block").applyInPandas(_repeated(blocks), "h bigint, doc_id bigint, p int"))
    n = places.count()
    hot_keys = places.groupBy("h").count().where(F.col("count") > hot).select("h", F.lit(True).alias("hot"))
    any_hot = n > hot and not hot_keys.isEmpty()
    places = places.join(hot_keys, "h", "left").fillna(False, ["hot"]) if any_hot else places.withColumn("hot", F.lit(False))
    at = places.groupBy("doc_id").agg(F.collect_list(F.struct("h", "p", "hot")).alias("at"))
    kind = "h bigint, doc_id bigint, p int, off int, ctx string"
    ctx = docs.join(at, "doc_id").mapInPandas(_contexts(min_len), kind + ", hot boolean").withColumns({"lo": F.lit(0), "hi": F.lit(min_len - ANCHOR)})
    parts = max(1, n // BLOCK_SUFFIXES)

    def trees(x):
        return x.groupBy(F.pmod(F.xxhash64("h"), F.lit(parts)).alias("part")).applyInPandas(_trees(min_len), "doc_id bigint, start_at bigint, end_at bigint")

    spans = trees(ctx.where("not hot") if any_hot else ctx)
    if any_hot:
        rest = ctx.where("hot").drop("hot")
        for ranges in SPLITS:
            rest = durable(rest.mapInPandas(_split(min_len, ranges), kind + ", lo int, hi int"))
            rest = rest.join(_hot_keys(rest, hot), "h", "left").fillna(False, ["hot"])
            spans = spans.unionByName(trees(rest.where("not hot")))
            rest = rest.where("hot").drop("hot")
        win = durable(rest.mapInPandas(_windows(min_len), "k1 bigint, k2 bigint, doc_id bigint, start_at bigint").withColumn("k", F.struct("k1", "k2")))
        several = win.groupBy("k").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b").select("k", "n")
        spans = spans.unionByName(join_groups(win, durable(several), "k").select("doc_id", "start_at", (F.col("start_at") + min_len).alias("end_at")))
    return merge_spans(spans)


def merge_spans(spans: DataFrame) -> DataFrame:
    """Union of the spans of each record; spans that touch become one."""
    w = Window.partitionBy("doc_id").orderBy("start_at", "end_at")
    before = F.max("end_at").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("fresh", F.when(before.isNull() | (F.col("start_at") > before), 1).otherwise(0))
    marked = marked.withColumn("no", F.sum("fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy("doc_id", "no").agg(F.min("start_at").alias("start_at"), F.max("end_at").alias("end_at")).drop("no")


def coverage(documents: DataFrame, spans: DataFrame) -> DataFrame:
    """For each record how much of it stands elsewhere too; records without a span have 0, null texts a length of 0."""
    per = spans.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_spans"), F.sum(F.col("end_at") - F.col("start_at")).alias("shared_chars"))
    docs = documents.select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("text_chars"))
    out = docs.join(per, "doc_id", "left").fillna(0, ["n_spans", "shared_chars"])
    return out.withColumn("shared_ratio", F.when(F.col("text_chars") > 0, F.round(F.col("shared_chars") / F.col("text_chars"), 6)).otherwise(F.lit(0.0)))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_spans(table(spark, sf_dir, "documents"))


def p8_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return coverage(docs, shared_spans(docs))
