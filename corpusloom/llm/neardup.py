"""Problem 1: near-duplicate records, by a parity-sketch join.

A text is the set of its shingles. Each shingle's 64-bit hash flips one bit of a *wide* parity sketch of 2^64 bits, kept as
the list of its odd bits, and one bit of a *narrow* sketch, the wide one folded by XOR to a word for each 48 shingles (a
power of two, by size band), and further to ``CARRIED`` words where it travels with keys. The Hamming distance of two sketches, wide or narrow, is at most the symmetric difference of
the sets. Sets of sizes a and b with a Jaccard similarity of at least t differ in at most
``D = floor((1 - t) / (1 + t) * (a + b))`` shingles. The steps:

1. texts of the same word sequence become one class with one representative (pre-aggregated, so copies cost nothing).
2. all bits of all sketches are counted in a table of fixed size. It only serves as an order, the rarest bits first, which
   is the same for all sets; whatever the counts, the result is exact.
3. pigeonhole: at a distance of at most D, all but ``(a - b + D) / 2`` odd bits of the first sketch are odd in the second.
   Hence the first ``k`` bits of a set in that order, one more than that for the partner that allows most, hold the first
   bit that the two have in common. These bits are the keys; each travels with the set's size, the bit's rank and the
   narrow sketch. A pair that meets at its first common bit has ``rank a + rank b`` bits of difference before it, and pairs
   beyond D by that or by their narrow sketches are refused at once. A block of keys holds sets of neighbouring bands,
   compared in the narrower of their widths.
4. keys of more than ``HOT`` sets are cut, by size, into tiles of at most so many, and tiles are paired as tasks of their
   own; keys that the count knows as larger still are spread over several blocks before. No key is left out.
5. pairs that are left meet the narrow sketches of all words, one for each set and pair, and are refused by their distance.
6. what is left then is verified by the exact shingle sets.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrays import Rolling, codes, mix, pack, runs, unpack
from corpusloom.llm.trees import KIND, counted, cut_counts
from corpusloom.session import durable, release, ship, table

#: Sets that share one key beyond which they are paired tile by tile.
HOT = 8192
#: Sets above the mean load of a count's cell beyond which a key is spread over several blocks (a power of two).
SPREAD = 1 << 16
#: Keys of one block of the exchange.
BLOCK_KEYS = 2_500_000
#: Words of a sketch that travels with each key, as a power of two; more would make long texts' keys outweigh them.
CARRIED = 2
#: Cells of the table of counts. One byte each is sent to the executors: 4 MB.
CELLS = 1 << 22
_CHARS = 1 << 20
#: Entries that a task gathers before it cuts them into blocks.
_GATHER = 1_000_000


def words_of(col):
    """Lower-cased maximal runs of letters and digits, parted by one blank."""
    return F.trim(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " "))


def _shingles(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of texts of single-blank words, and their texts' numbers; sorted by (text, hash)."""
    c = codes(" ".join(texts) + " ")
    ends = np.flatnonzero(c == 32)
    starts = np.r_[0, ends[:-1] + 1]
    w = Rolling(c).of(starts, ends)
    text_ends = np.cumsum([len(t) + 1 for t in texts])
    d = np.searchsorted(text_ends, starts, side="right")
    full = ends > starts
    w, d = w[full], d[full]
    if len(w) < size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    n = len(w) - size + 1
    s = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        s = mix(s * np.uint64(0x9E3779B97F4A7C15) + w[i : n + i] + np.uint64(i))
    inside = d[:n] == d[size - 1 :]
    s, d = s[inside], d[:n][inside]
    o = np.lexsort((s, d))
    s, d = s[o], d[o]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    s, d = s[new], d[new]
    return s, d, np.bincount(d, minlength=len(texts))


class Bands:
    """What a threshold allows: differences, keys of a set, words of its narrow sketch."""

    def __init__(self, threshold: float):
        self.t = threshold

    def differences(self, a, b):
        """D for two sizes."""
        return np.floor((1 - self.t) / (1 + self.t) * (np.asarray(a, np.float64) + b) + 1e-9).astype(np.int64)

    def keys(self, a: np.ndarray) -> np.ndarray:
        """Rarest bits of a set of size a that must hold one of any partner's: its smallest partner allows most."""
        b = np.ceil(self.t * a - 1e-9).astype(np.int64)
        return (a - b + self.differences(a, b)) // 2 + 1

    def band(self, a: np.ndarray, most: int = 40) -> np.ndarray:
        """Bands double: up to 48 shingles, 96, 192, ...; those from ``most`` on are one."""
        return np.minimum(np.ceil(np.log2(np.maximum(a, 48) / 48) - 1e-12).astype(np.int64), most)


def _sketches(s: np.ndarray, d: np.ndarray, sets: np.ndarray, words: int) -> np.ndarray:
    """Narrow parity sketches of some sets: bit ``hash mod 64 words``, so that XOR of the halves gives the next narrower."""
    at = np.full(int(d.max(initial=-1)) + 1, -1)
    at[sets] = np.arange(len(sets))
    mine = at[d] >= 0
    bit = (mix(s[mine] + np.uint64(0x51ED)) % np.uint64(64 * words)).astype(np.int64)
    out = np.zeros(len(sets) * words, dtype=np.uint64)
    np.bitwise_xor.at(out, at[d[mine]] * words + bit // 64, np.uint64(1) << (bit % 64).astype(np.uint64))
    return out.reshape(len(sets), words)


def _batches(frames, columns):
    """Rows of some frames, about a million characters at a time."""
    for f in frames:
        lens = f["words"].str.len().to_numpy()
        part = np.cumsum(lens) // _CHARS
        for lo, hi in zip(st := runs(part), [*st[1:], len(f)]):
            yield [f[c].iloc[lo:hi] for c in columns]


def _cell(s: np.ndarray) -> np.ndarray:
    return (s & np.uint64(CELLS - 1)).astype(np.int64)


def _counts(shingle: int):
    """One task's table of counts, in compressed segments."""

    def run(frames):
        n = np.zeros(CELLS, dtype=np.uint32)
        for (words,) in _batches(frames, ["words"]):
            cells, c = np.unique(_cell(_shingles(words.tolist(), shingle)[0]), return_counts=True)
            n[cells] += c.astype(np.uint32)
        yield cut_counts(n)

    return run


def rarity(reps: DataFrame, shingle: int) -> np.ndarray:
    """For each cell a byte: 0 for no more than twice the mean load, else the binary logarithm of what is above the mean.

    All shingles of all texts are counted. The load is what unrelated shingles in the same cell add, so a cell's byte tells
    frequent shingles from others however large the collection is.
    """
    n = counted(reps.select("words").mapInPandas(_counts(shingle), KIND), CELLS)
    return np.log2(np.maximum(n - n.mean(), 1)).astype(np.uint8)


def _spread(key: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Over how many blocks a key's sets are spread, by its count: one below ``SPREAD``, then two for each ``SPREAD``.

    A key without its highest bits, as its block knows it, gives the same."""
    return np.uint64(1) << np.clip(rare[_cell(key)].astype(np.int64) + 2 - SPREAD.bit_length(), 0, 30).astype(np.uint64)


def _entries(s, d, size, bands: Bands, rare: np.ndarray):
    """(set, key, rank) of the keys of all sets."""
    cls = rare[_cell(s)].astype(np.uint64)
    o = np.lexsort(((cls << np.uint64(56)) | (s >> np.uint64(8)), d))
    rank = np.arange(len(s)) - (np.cumsum(size) - size)[d]
    keep = rank < bands.keys(size)[d]
    return d[keep], s[o[keep]], rank[keep]


def _key_blocks(threshold: float, shingle: int, blocks: int, rare):
    """The packed exchange: for each block and band the sets that have keys in it, with rank, size and narrow sketch."""
    bands = Bands(threshold)

    def cut(parts):
        for band in sorted({p[0] for p in parts}):
            rid, size, key, rank, sk = (np.concatenate(x) for x in list(zip(*[p for p in parts if p[0] == band]))[1:])
            block = (key % np.uint64(blocks)).astype(np.int64)
            block += (mix(rid.view(np.uint64)) % _spread(key, rare.value)).astype(np.int64) * blocks
            o = np.lexsort((rid, block))
            block, rid, size, key, rank, sk = block[o], rid[o], size[o], key[o], rank[o], sk[o]
            small = np.uint16 if size.max() < 1 << 16 else np.int32
            st = runs(block)
            body = [
                pack(r=rid[lo:hi], z=size[lo:hi].astype(small), p=rank[lo:hi].astype(small), s=sk[lo:hi].ravel(), k=((key[lo:hi] // np.uint64(blocks)) & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                for lo, hi in zip(st, [*st[1:], len(block)])
            ]
            yield pd.DataFrame({"block": block[st], "band": np.int32(band), "body": body})

    def run(frames):
        parts, n = [], 0
        for rid, words in _batches(frames, ["rid", "words"]):
            s, d, size = _shingles(words.tolist(), shingle)
            if not len(s):
                continue
            rid, (which, key, rank), band = rid.to_numpy(), _entries(s, d, size, bands, rare.value), bands.band(size, CARRIED)
            for b in np.unique(band[size > 0]):
                sets = np.flatnonzero((band == b) & (size > 0))
                sk = _sketches(s, d, sets, 1 << int(b))
                at = np.zeros(len(size), dtype=np.int64)
                at[sets] = np.arange(len(sets))
                m = band[which] == b
                parts.append((int(b), rid[which[m]], size[which[m]], key[m], rank[m], sk[at[which[m]]]))
            n += len(key)
            if n >= _GATHER:
                yield from cut(parts)
                parts, n = [], 0
        yield from cut(parts)

    return run


class _Members:
    """Sets that have keys in one place, by band, with narrow sketches at their own width or folded to a lower band's."""

    def __init__(self, bands: Bands, rows):
        """``rows``: (band, packed arrays) with r: numbers, z: sizes, p: ranks, s: sketches, k: keys."""
        self.bands, self.sk, self._folds = bands, {}, {}
        every: dict[int, list] = {}
        for band, p in rows:
            every.setdefault(int(band), []).append(p)
        got = []
        for band, parts in sorted(every.items()):
            self.sk[band] = np.concatenate([p["s"] for p in parts]).reshape(-1, 1 << band)
            r, z, p, k = (np.concatenate([x[c] for x in parts]) for c in "rzpk")
            got.append((r, z.astype(np.int64), p.astype(np.int64), k, np.full(len(r), band), np.arange(len(r))))
        self.rid, self.size, self.rank, self.key, self.band, self.at = (np.concatenate(x) for x in zip(*got))

    def sketches(self, band: int, width: int) -> np.ndarray:
        """Sketches of a band at the width of another, not higher one."""
        if width == band:
            return self.sk[band]
        if (band, width) not in self._folds:
            wide = self.sketches(band, width + 1)
            half = wide.shape[1] // 2
            self._folds[band, width] = wide[:, :half] ^ wide[:, half:]
        return self._folds[band, width]

    def near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of entries, met at a common key, may be alike: by size, rank and the distance of their sketches."""
        b = self.bands
        a, c, p, q = self.size[i], self.size[j], self.rank[i], self.rank[j]
        diff = b.differences(a, c)
        # so many bits of each are common at most, and so many are not; the rest is for the pair's first common key
        ok = (2 * np.minimum(a - p, c - q) >= a + c - diff) & (p + q <= diff) & (self.rid[i] != self.rid[j])
        ok = np.flatnonzero(ok)
        i, j, diff = i[ok], j[ok], diff[ok]
        swap = self.band[i] > self.band[j]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        keep = np.zeros(len(i), bool)
        two = self.band[i] * 64 + self.band[j]
        for x in np.unique(two):
            m = np.flatnonzero(two == x)
            low, high = int(x) // 64, int(x) % 64
            far = np.bitwise_count(self.sk[low][self.at[i[m]]] ^ self.sketches(high, low)[self.at[j[m]]]).sum(axis=1, dtype=np.int64)
            keep[m] = far <= diff[m]
        i, j = self.rid[i[keep]], self.rid[j[keep]]
        return np.stack([np.minimum(i, j), np.maximum(i, j)], axis=1)

    def take(self, which: np.ndarray, **more) -> list[tuple[int, bytes]]:
        """(band, packed) of some entries."""
        out = []
        for band in np.unique(self.band[which]):
            w = which[self.band[which] == band]
            out.append((int(band), pack(r=self.rid[w], z=self.size[w].astype(np.int32), p=self.rank[w].astype(np.int32), s=self.sk[int(band)][self.at[w]].ravel(), k=self.key[w])))
        return out


def _all_pairs(n: int):
    """Pairs i < j of n places, about a million at a time."""
    at = 0
    while at < n - 1:
        x = np.arange(at, min(at + max(1, 1_000_000 // n), n - 1))
        reps = n - 1 - x
        i = np.repeat(x, reps)
        yield i, i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(reps) - reps, reps)
        at = int(x[-1]) + 1


def _distinct(found: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _pairs_in_block(threshold: float, blocks: int, hot: int, rare):
    """Pairs (a, b) of a block, and tiles (mark, tile, band, sizes, packed sets) of its keys of more than ``hot`` sets."""
    bands = Bands(threshold)

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        m = _Members(bands, ((b, unpack(x)) for b, x in zip(f["band"], f["body"])))
        o = np.lexsort((m.size, m.key))
        st = runs(m.key[o])
        length = np.diff(np.r_[st, len(o)])
        mark = m.key[o[st]].astype(np.uint64) * np.uint64(blocks) + np.uint64(block % blocks)
        tiled = (length > hot) | (_spread(mark, rare.value) > 1)
        tiles = []
        for lo, n, k in zip(st[tiled], length[tiled], mark[tiled]):
            for t, at in enumerate(range(0, int(n), hot)):
                w = o[lo + at : lo + min(at + hot, int(n))]
                tiles += [(_signed(int(k)), block * (1 << 20) + t, band, int(m.size[w[0]]), int(m.size[w[-1]]), body) for band, body in m.take(w)]
        some = ~tiled & (length > 1)
        st, length = st[some], length[some]
        found = []
        for n in np.unique(length):  # groups of one length at a time, as arrays; a bounded number of pairs each time
            these = st[length == n]
            if n <= 64:
                x, y = np.triu_indices(int(n), 1)
                step = max(1, 1_000_000 // len(x))
                for at in range(0, len(these), step):
                    g = these[at : at + step, None]
                    found.append(m.near(o[(g + x).ravel()], o[(g + y).ravel()]))
            else:
                found += [m.near(o[lo + x], o[lo + y]) for lo in these for x, y in _all_pairs(int(n))]
        p = _distinct(found)
        pairs = pd.DataFrame({"a": p[:, 0], "b": p[:, 1], "mark": 0, "tile": -1, "band": 0, "low": 0, "high": 0, "body": b""})
        return pd.concat([pairs, pd.DataFrame(tiles, columns=[*pairs.columns[2:]]).assign(a=0, b=0)[[*pairs.columns]]]) if tiles else pairs

    return run


def _pairs_of_tiles(threshold: float):
    bands = Bands(threshold)

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("band", kind="stable")
        rows = [unpack(x) for x in f["body"]]
        m = _Members(bands, zip(f["band"], rows))
        tile = np.repeat(f["tile"].to_numpy(), [len(r["r"]) for r in rows])
        one, two = f["one"].iloc[0], f["two"].iloc[0]
        x, y = np.flatnonzero(tile == one), np.flatnonzero(tile == two)
        if one == two:
            found = [m.near(x[i], x[j]) for i, j in _all_pairs(len(x))]
        else:
            step = max(1, 1_000_000 // len(y))
            found = [m.near(np.repeat(x[at : at + step], len(y)), np.tile(y, len(x[at : at + step]))) for at in range(0, len(x), step)]
        p = _distinct(found)
        return pd.DataFrame({"a": p[:, 0], "b": p[:, 1]})

    return run


def _tile_pairs(tiles: DataFrame, threshold: float) -> DataFrame:
    """Pairs of sets of hot keys: each pair of a key's tiles whose sizes allow it is one task's."""
    heads = tiles.select("mark", "tile", "low", "high").distinct()
    other = heads.select("mark", F.col("tile").alias("two"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    both = heads.withColumnRenamed("tile", "one").join(other, "mark").where("one <= two").where((F.col("low") <= F.ceil(F.col("high2") / threshold)) & (F.col("low2") <= F.ceil(F.col("high") / threshold)))
    both = both.select("mark", "one", "two")
    need = both.select("mark", "one", "two", F.col("one").alias("tile")).union(both.where("one <> two").select("mark", "one", "two", F.col("two").alias("tile")))
    sent = need.join(tiles.select("mark", "tile", "band", "body"), ["mark", "tile"])
    return sent.groupBy("mark", "one", "two").applyInPandas(_pairs_of_tiles(threshold), "a bigint, b bigint")


def _all_sketches(threshold: float, shingle: int):
    """``rid, size, sketch`` of all sets, at the width of their bands."""
    bands = Bands(threshold)

    def run(frames):
        for rid, words in _batches(frames, ["rid", "words"]):
            s, d, size = _shingles(words.tolist(), shingle)
            band, rid = bands.band(size), rid.to_numpy()
            for b in np.unique(band[size > 0]):
                sets = np.flatnonzero((band == b) & (size > 0))
                sk = _sketches(s, d, sets, 1 << int(b))
                yield pd.DataFrame({"rid": rid[sets], "size": size[sets], "sketch": [x.tobytes() for x in sk]})

    return run


def _close(threshold: float):
    """Pairs whose sketches are within the distance that the threshold allows."""
    bands = Bands(threshold)

    def run(frames):
        for f in frames:
            most = bands.differences(f["size_a"].to_numpy(), f["size_b"].to_numpy())
            keep = np.zeros(len(f), bool)
            for k, (x, y) in enumerate(zip(f["sketch_a"], f["sketch_b"])):
                x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                while len(y) > len(x):
                    y = y[: len(y) // 2] ^ y[len(y) // 2 :]
                keep[k] = int(np.bitwise_count(x ^ y).sum()) <= most[k]
            yield f.loc[keep, ["a", "b"]]

    return run


def _verify(threshold: float, shingle: int):
    def run(frames):
        for f in frames:
            jac = np.zeros(len(f))
            sets: dict[str, np.ndarray] = {}
            for k, (x, y) in enumerate(zip(f["words_a"], f["words_b"])):
                s = [sets.setdefault(w, None) if sets.get(w) is not None else sets.__setitem__(w, _shingles([w], shingle)[0]) or sets[w] for w in (x, y)]
                both = len(np.intersect1d(s[0], s[1], assume_unique=True))
                jac[k] = both / max(1, len(s[0]) + len(s[1]) - both)
                if len(sets) > 20_000:
                    sets.clear()
            f = f.assign(similarity=jac)
            yield f.loc[jac >= threshold - 1e-12, ["seq_a", "seq_b", "similarity"]]

    return run


def classes(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Members (id, class) and one representative (rid, class, words) for each class of equal word sequences."""
    w = df.select(F.col(id_col).cast("string").alias("doc_id"), words_of(F.col(text_col)).alias("words")).where("doc_id is not null and words is not null and words <> ''")
    w = w.withColumn("seq", F.unhex(F.md5("words")))
    members = durable(w.select("doc_id", "seq"))
    reps = durable(w.groupBy("seq").agg(F.first("words").alias("words")).withColumn("rid", F.monotonically_increasing_id()))
    return members, reps


def block_count(total_chars: int) -> int:
    """Blocks of the exchange for so many characters; at least a few, for the sake of the cores."""
    return max(1, math.ceil(total_chars / 6 * 0.5 / BLOCK_KEYS), min(12, 1 + total_chars // 2_000_000))


def similar_classes(reps: DataFrame, threshold: float, shingle: int, hot: int = HOT, blocks: int | None = None) -> DataFrame:
    """Pairs (seq_a, seq_b, similarity) of classes whose shingle sets reach the threshold."""
    spark = reps.sparkSession
    ship(spark)
    blocks = blocks or block_count(reps.select(F.sum(F.length("words"))).first()[0] or 0)
    rare = spark.sparkContext.broadcast(rarity(reps, shingle))  # CELLS bytes
    keys = reps.select("rid", "words").mapInPandas(_key_blocks(threshold, shingle, blocks, rare), "block bigint, band int, body binary")
    out = "a bigint, b bigint, mark bigint, tile bigint, band int, low int, high int, body binary"
    first = durable(keys.groupBy("block").applyInPandas(_pairs_in_block(threshold, blocks, hot, rare), out))
    pairs = first.where("tile < 0").select("a", "b")
    tiles = first.where("tile >= 0")
    if not tiles.isEmpty():
        pairs = pairs.unionByName(_tile_pairs(tiles, threshold))
    met = durable(pairs.distinct())
    release(first)
    sketches = durable(reps.select("rid", "words").mapInPandas(_all_sketches(threshold, shingle), "rid bigint, size bigint, sketch binary"))
    both = met
    for x in "ab":
        both = both.join(sketches.select(F.col("rid").alias(x), F.col("size").alias(f"size_{x}"), F.col("sketch").alias(f"sketch_{x}")), x)
    pairs = durable(both.mapInPandas(_close(threshold), "a bigint, b bigint"))
    release(met, sketches)
    need = pairs.select(F.col("a").alias("rid")).union(pairs.select("b")).distinct()
    texts = durable(reps.join(need, "rid"))
    side = lambda x: texts.select(F.col("rid").alias(x), F.col("words").alias(f"words_{x}"), F.col("seq").alias(f"seq_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").drop("a", "b").mapInPandas(_verify(threshold, shingle), "seq_a binary, seq_b binary, similarity double")


def near_pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """All pairs ``doc_id_a < doc_id_b`` of rows whose texts are alike enough but are not the same word sequence.

    Words are maximal runs of letters and digits of the lower-cased text. Null and wordless texts, and texts shorter than
    one shingle, have no partner; rows without an id take no part. Rows of one word sequence are one class (that is problem 3) and have the class's partners.
    """
    members, reps = classes(df, id_col, text_col)
    pairs = similar_classes(reps, threshold, shingle)
    m = lambda x: members.select(F.col("seq").alias(f"seq_{x}"), F.col("doc_id").alias(f"id_{x}"))
    out = pairs.join(m("a"), "seq_a").join(m("b"), "seq_b")
    return out.select(F.least("id_a", "id_b").alias("doc_id_a"), F.greatest("id_a", "id_b").alias("doc_id_b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of an undirected graph; root is the smallest node. Alternating star contraction.

    Each round is written to the shared folder; the driver sees one number a round.
    """
    e = durable(edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).where("x <> y").distinct())
    while True:
        both = e.union(e.select(F.col("y").alias("x"), F.col("x").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y")
        large = large.union(e.select("x", "y").groupBy("x").agg(F.min("y").alias("y"))).distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y").union(least).distinct()
        small = durable(small)
        changed = small.exceptAll(e).limit(1).count() + e.exceptAll(small).limit(1).count()
        e = small
        if not changed:
            return e.select(F.col("x").alias("node"), F.col("y").alias("root")).union(e.select(F.col("y").alias("node"), F.col("y").alias("root")).distinct())


def near_groups(df: DataFrame, id_col: str, text_col: str, threshold: float = 0.8, shingle: int = 5) -> DataFrame:
    """One row for each record with words: ``doc_id, group_id`` (smallest id of its group), ``n_links`` (similar classes)."""
    members, reps = classes(df, id_col, text_col)
    pairs = durable(similar_classes(reps, threshold, shingle).select(F.hex("seq_a").alias("x"), F.hex("seq_b").alias("y")))
    roots = components(pairs)
    links = pairs.union(pairs.select("y", "x")).groupBy(F.col("x").alias("node")).agg(F.count(F.lit(1)).alias("n_links"))
    m = members.select("doc_id", F.hex("seq").alias("node")).join(roots.join(links, "node"), "node", "left")
    m = m.select("doc_id", F.coalesce("root", "node").alias("root"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))
    ids = m.groupBy("root").agg(F.min("doc_id").alias("group_id"))
    return m.join(ids, "root").select("doc_id", "group_id", "n_links")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_pairs(table(spark, sf_dir, "mainpipe_cleaned_v4"), "doc_id", "text_pii_masked", threshold=0.6, shingle=3)


def p1_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "mainpipe_cleaned_v4"), "doc_id", "text_pii_masked", threshold=0.6, shingle=3)


def p1_near_key_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over the prefix keys of the dedup stage, with the usual shingle of five words and a similarity of 0.8."""
    return near_groups(table(spark, sf_dir, "mainpipe_cleaned_v5"), "doc_id", "near_key")
