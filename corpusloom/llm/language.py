"""Problem 5: language of documents and of the segments of mixed ones.

The model is a sparse multinomial logistic regression on TF-IDF weighted character n-grams (1 to 4, words with their
bounds), trained on the driver with follow-the-regularised-leader and an elastic net from a bounded sample of labelled
texts (``TRAIN_ROWS``), then calibrated by a temperature. A feature's value is ``count * idf / (grams + SMOOTH)``, so a
unit's score is a sum over its words, and each word of a task is scored once. A tenth of the texts is held out for the
temperature, as sentences and as short pieces of them, and another tenth measures the error of the calibrated confidence
(``Model.error``); both are whole texts that the weights have not seen.

A document most of whose character triples and quadruples the model has never seen (fewer known than in almost all
held-out sentences) is in none of its languages: its label is ``unk``, whatever the scores say.

A text is cut into sentences. The likeliest path of languages over the sentences, with a price
for each change, gives the segments. Headings, names, list entries and other short units weigh too little to open one.
"""

from __future__ import annotations

import math
import re
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import ship, table

LANGS = ("de", "en", "es", "fr", "it", "nl")
#: Bound of the labelled sample that the model is trained on.
TRAIN_ROWS = 20_000
SMOOTH = 25.0
SWITCH, FLOOR, LIGHT = 3.0, -9.0, 0.08
_WORD = re.compile(r"[^\W\d_]+")
_CUT = re.compile(r"(?<=[.!?…])[\"'”»)]*\s+")
_END = re.compile(r"[.!?…][\"'”»)*]*$")
_NO_WORD = re.compile(r"\S*[@\d]\S*|\S+ ?[(\[] ?(?:at|dot) ?[)\]] ?\S+|https?:\S+")
_ODD = re.compile(r"[@\d]|[(\[] ?(?:at|dot)|://")
_TAG = re.compile(r"</?[A-Za-z][^<>]*>")
_CACHE_WORDS = 300_000


def evidence(unit: str) -> tuple[list[str], float]:
    """The words of a sentence that tell its language: no addresses, no numbers, no names inside a sentence; and how much
    a sentence of so many such words weighs."""
    s = _NO_WORD.sub(" ", unit) if _ODD.search(unit) else unit
    words = _WORD.findall(s)
    rest = [w for w in words if w.islower()]
    if len(rest) != len(words):
        if words[0][:1].isupper() and not words[0].isupper():
            rest.insert(0, words[0].lower())
        elif not rest:  # all in capitals
            rest = [w.lower() for w in words]
        if len(rest) < 3:
            return [w.lower() for w in words], LIGHT
    return rest, min(1.0, max(LIGHT, (len(rest) - 2) / 4))


def grams(word: str) -> list[str]:
    w = f" {word} "
    return [w[i : i + n] for n in (1, 2, 3, 4) for i in range(len(w) - n + 1) if n > 1 or w[i] != " "]


def strip_accents(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def sentences(text: str) -> list[str]:
    return [s for line in text.split("\n") for s in _CUT.split(line) if s.strip()]


class Model:
    """Weights (one row of languages for each n-gram), bias, temperature; the n-grams seen in training, the share of known
    ones below which a text is in no language, and the expected calibration error on texts held out from all of it."""

    def __init__(self, langs, vocab: dict[str, int], weights: np.ndarray, bias: np.ndarray, temperature: float, seen: frozenset[str] = frozenset()):
        self.langs, self.vocab, self.weights, self.bias, self.temperature = tuple(langs), vocab, weights, bias, temperature
        self.seen, self.least_known, self.error = seen, 0.0, float("nan")

    def known(self, w: str) -> tuple[int, int]:
        """How many of a word's n-grams of three and four characters were seen in training, and how many it has."""
        g = [x for x in grams(w) if len(x) > 2]
        return sum(x in self.seen for x in g), len(g)

    def word(self, w: str) -> tuple[np.ndarray, int]:
        g = grams(w)
        at = [i for i in map(self.vocab.get, g) if i is not None]
        return (self.weights[at].sum(axis=0) if at else np.zeros(len(self.langs))), len(g)

    def logits(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return (sums / (counts + SMOOTH)[:, None] + self.bias) / self.temperature


def log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(samples: list[tuple[str, str]], epochs: int = 6, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.05, scale: float = 10.0) -> Model:
    """FTRL-proximal over the sentences of labelled texts, each also without accents; a tenth of the texts tunes, another tests."""
    langs = tuple(sorted({y for y, _ in samples}))
    units = []
    for k, (y, t) in enumerate(sorted(samples)):
        part = {0: "tune", 5: "test"}.get(k % 10, "fit")
        for s in sentences(t):
            for v in {s.lower(), strip_accents(s.lower())}:
                ws = _WORD.findall(v)
                for piece in [ws] if part == "fit" else [ws, *(ws[i : i + n] for n in (1, 2, 3) for i in range(0, len(ws), 4))]:
                    units.append((part, langs.index(y), [g for w in piece for g in grams(w)], piece))
    fit = [u for u in units if u[0] == "fit" and u[2]]
    vocab: dict[str, int] = {}
    seen: list[int] = []
    for _, _, gs, _ in fit:
        for g in set(gs):
            i = vocab.setdefault(g, len(vocab))
            if i == len(seen):
                seen.append(0)
            seen[i] += 1
    idf = np.log((1 + len(fit)) / (1 + np.array(seen, dtype=float))) + 1 if fit else np.zeros(0)

    def features(gs):
        at, n = np.unique([vocab[g] for g in gs if g in vocab], return_counts=True)
        return at.astype(int), n * idf[at.astype(int)] * scale / (len(gs) + SMOOTH)

    rows = [(y, *features(gs)) for _, y, gs, _ in fit]
    z, n = np.zeros((len(vocab), len(langs))), np.zeros((len(vocab), len(langs)))
    rng = np.random.default_rng(7)

    def weights(z, n):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))

    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            y, at, x = rows[r]
            w = weights(z[at], n[at])
            p = np.exp(log_softmax((x @ w)[None, :])[0])
            p[y] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(z, n) * idf[:, None] * scale
    used = np.flatnonzero(np.abs(w).sum(axis=1))
    back = {int(i): k for k, i in enumerate(used)}
    m = Model(langs, {g: back[i] for g, i in vocab.items() if i in back}, w[used], np.zeros(len(langs)), 1.0)
    m.seen = frozenset(g for g in vocab if len(g) > 2)
    tuned, tested = ([u for u in units if u[0] == part and u[2]] for part in ("tune", "test"))
    if tuned:
        raw, y = _raw(m, tuned)
        m.temperature = _temperature(raw, y)
        shares = [np.sum([m.known(w) for w in u[3]], axis=0) for u in tuned if len(u[3]) >= 5]
        if shares:
            m.least_known = float(np.quantile([k / max(1, n) for k, n in shares], 0.001)) * 0.6
    if tested:
        raw, y = _raw(m, tested)
        m.error = calibration_error(np.exp(log_softmax(raw / m.temperature)), y)
    return m


def _raw(m: Model, units) -> tuple[np.ndarray, np.ndarray]:
    sums = np.array([m.weights[[m.vocab[g] for g in u[2] if g in m.vocab]].sum(axis=0) for u in units])
    return m.logits(sums, np.array([len(u[2]) for u in units])) * m.temperature, np.array([u[1] for u in units])


def _temperature(raw: np.ndarray, y: np.ndarray) -> float:
    """The likeliest temperature: the likelihood is concave in its inverse, so halving an interval finds it."""
    pick = raw[np.arange(len(y)), y]

    def slope(b: float) -> float:
        p = np.exp(log_softmax(raw * b))
        return float((pick - (p * raw).sum(axis=1)).mean()) - 1e-4 * b  # a slight pull, as some samples part perfectly

    lo, hi = 1e-3, 1e3
    for _ in range(60):
        mid = math.sqrt(lo * hi)
        lo, hi = (mid, hi) if slope(mid) > 0 else (lo, mid)
    return 1 / math.sqrt(lo * hi)


def calibration_error(p: np.ndarray, y: np.ndarray, bins: int = 10) -> float:
    """Expected calibration error: how far confidence is from the share of right answers, over bins of equal width."""
    conf, right = p.max(axis=1), p.argmax(axis=1) == y
    at = np.minimum((conf * bins).astype(int), bins - 1)
    return float(sum(abs(conf[at == i].sum() - right[at == i].sum()) for i in range(bins)) / len(y))


class _Words(dict):
    """Rows of a growing table of word scores."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.sums, self.counts, self.known = model, [], [], []

    def __missing__(self, w: str) -> int:
        s, n = self.model.word(w)
        self[w] = i = len(self.sums)
        self.sums.append(s)
        self.counts.append(n)
        self.known.append(self.model.known(w))
        return i


def units_of(text: str) -> list[tuple[str, bool]]:
    """(unit, does it weigh as a sentence) of a text. Menus, headings and other short lines are units that do not."""
    kept = [x for x in text.split("\n") if x.strip()]
    joined: list[str] = []
    for x in kept:  # lines that were wrapped inside a sentence
        x = _TAG.sub(" ", x).strip() if "<" in x else x.strip()
        if joined and not _END.search(joined[-1]) and x[:1].islower() and len(joined[-1].split()) > 1:
            joined[-1] += " " + x
        else:
            joined.append(x)
    out = []
    for line in joined:
        for s in _CUT.split(line):
            n = s.count(" ") + 1
            full = n >= 4 and (_END.search(s) is not None or n >= 9) and ":" not in s[:24] and not s.startswith(("-", "*", "•", "~", "☎"))
            out.append((s, full))
    return out


def path(logp: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The likeliest languages of the units, with a price for each change."""
    e = np.maximum(logp, FLOOR) * weight[:, None]
    best, back = e[0], []
    for row in e[1:]:
        stay, change = best, best.max() - SWITCH
        back.append(np.where(stay >= change, np.arange(len(row)), best.argmax()))
        best = np.maximum(stay, change) + row
    at = [int(best.argmax())]
    for b in reversed(back):
        at.append(int(b[at[-1]]))
    return np.array(at[::-1])


class Segmenter:
    """Segments of frames of texts; the scores of a task's words are kept from frame to frame."""

    def __init__(self, model: Model):
        self.model, self.words = model, _Words(model)

    def __call__(self, f: pd.DataFrame) -> pd.DataFrame:
        model = self.model
        if len(self.words) > _CACHE_WORDS:
            self.words = _Words(model)
        words = self.words
        at, unit_len, full, owner = [], [], [], []
        for k, t in enumerate(f["text"]):
            for u, whole in units_of(t):
                w, much = evidence(u)
                if w:
                    at += [words[x] for x in w]
                    unit_len.append(len(w)), full.append(much if whole else LIGHT), owner.append(k)
        columns = ["doc_id", "seg_no", "lang", "confidence", "size", "known"]
        if not at:
            return pd.DataFrame([], columns=columns)
        at, owner = np.array(at), np.array(owner)
        first = np.r_[0, np.cumsum(unit_len)[:-1]]
        counts = np.add.reduceat(np.array(words.counts)[at], first)
        known = np.add.reduceat(np.array(words.known)[at], first, axis=0)
        logp = log_softmax(model.logits(np.add.reduceat(np.array(words.sums)[at], first), counts))
        weight = np.array(full)
        top = logp.argmax(axis=1)
        out = []
        st = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        for lo, hi in zip(st, [*st[1:], len(owner)]):
            doc, heavy = f["doc_id"].iloc[owner[lo]], weight[lo:hi] > LIGHT
            t = top[lo:hi][heavy]
            if len(t) and (t == t[0]).all():
                langs = np.full(hi - lo, t[0])
            elif not len(t):
                langs = np.full(hi - lo, (logp[lo:hi] * counts[lo:hi, None]).sum(axis=0).argmax())
            else:
                langs = path(logp[lo:hi], weight[lo:hi])
                no = np.cumsum(np.r_[0, langs[1:] != langs[:-1]])
                for s in range(no[-1] + 1):  # a segment holds at least one sentence
                    if not heavy[no == s].any():
                        langs[no == s] = langs[np.flatnonzero(no == s)[0] - 1] if s else langs[np.flatnonzero(no == s)[-1] + 1]
            cuts = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1]])
            for no, (a, b) in enumerate(zip(cuts, [*cuts[1:], hi - lo]), 1):
                c = counts[lo + a : lo + b] * weight[lo + a : lo + b]
                conf = float((np.exp(logp[lo + a : lo + b, langs[a]]) * c).sum() / c.sum())
                k, n = known[lo + a : lo + b].sum(axis=0)
                out.append((doc, no, model.langs[langs[a]], conf, int(counts[lo + a : lo + b].sum()), bool(k >= model.least_known * n)))
        return pd.DataFrame(out, columns=columns)


def _segments(model_sent):
    def run(frames):
        cut = Segmenter(model_sent.value)
        for f in frames:
            yield cut(f)

    return run


def fit(samples: DataFrame) -> Model:
    """Train on ``lang, text`` rows, at most ``TRAIN_ROWS`` of them, taken in the order of a hash."""
    rows = samples.where("lang is not null and text is not null").select("lang", "text")
    return train([(r["lang"], r["text"]) for r in rows.orderBy(F.xxhash64("text"), "text").limit(TRAIN_ROWS).collect()])


def segments(df: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text_norm") -> DataFrame:
    """``doc_id, seg_no, lang, confidence, size, known`` of every segment, where ``known`` tells whether the model has seen
    enough of its character sequences for ``lang`` to mean anything; texts without a letter, blank and null ones
    and rows without an id have none."""
    spark = df.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(fit(samples))  # bounded by the n-grams of TRAIN_ROWS texts
    return df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where("doc_id is not null and text is not null and text <> ''").mapInPandas(_segments(sent), "doc_id string, seg_no bigint, lang string, confidence double, size bigint, known boolean")


def label_of(col):
    """A label without letter case and region; null where it is missing, blank or unknown."""
    base = F.lower(F.trim(F.regexp_extract(F.trim(col), r"^[A-Za-z]+", 0)))
    return F.when((base != "") & (base != "unk"), base)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    v2 = table(spark, sf_dir, "mainpipe_cleaned_v2")
    ship(spark)
    sent = spark.sparkContext.broadcast(fit(table(spark, sf_dir, "lang_samples")))

    def run(frames):
        cut = Segmenter(sent.value)
        for f in frames:
            f = f[f["text"].notna() & (f["text"] != "")]
            label = dict(zip(f["doc_id"], f["label"]))
            s = cut(f)
            several = s.groupby("doc_id")["seg_no"].transform("max") > 1
            yield s.loc[several | (s["doc_id"].map(label) != s["lang"]), ["doc_id", "seg_no", "lang"]]

    return v2.select("doc_id", F.col("text_norm").alias("text"), label_of(F.col("lang_pred")).alias("label")).mapInPandas(run, "doc_id string, seg_no bigint, lang string")


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its main language (that of the most text; ``unk`` without a letter or in no language known to the
    model), its confidence and the number of its segments, beside the label and score it came with and whether they agree."""
    v2 = table(spark, sf_dir, "mainpipe_cleaned_v2")
    s = segments(v2, table(spark, sf_dir, "lang_samples"))
    best = s.groupBy("doc_id", "lang").agg(F.sum("size").alias("size"), F.sum(F.col("confidence") * F.col("size")).alias("c"), F.count(F.lit(1)).alias("n"), F.max("known").alias("known"))
    doc = best.groupBy("doc_id").agg(F.max_by(F.struct("lang", F.expr("c / size").alias("confidence"), "known"), F.struct("size", "lang")).alias("m"), F.sum("n").alias("n_segments"))
    doc = doc.select("doc_id", F.when(F.col("m.known"), F.col("m.lang")).alias("lang"), F.when(F.col("m.known"), F.round("m.confidence", 6)).alias("confidence"), "n_segments")
    was = v2.select("doc_id", label_of(F.col("lang_pred")).alias("label"), F.col("lang_score").alias("label_score"))
    out = was.join(doc, "doc_id", "left").select("doc_id", F.coalesce("lang", F.lit("unk")).alias("lang"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.coalesce("n_segments", F.lit(0)).cast("bigint").alias("n_segments"), "label", "label_score")
    return out.withColumn("label_holds", F.coalesce(F.col("label") == F.col("lang"), F.lit(False)))


def p5_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = segments(table(spark, sf_dir, "mainpipe_cleaned_v2"), table(spark, sf_dir, "lang_samples"))
    return out.select("doc_id", "seg_no", "lang", F.round("confidence", 6).alias("confidence"))
