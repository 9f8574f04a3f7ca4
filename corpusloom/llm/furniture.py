"""Problem 4: page boilerplate, by the distribution of text over blocks of lines.

No list of words or phrases is built in; what furniture looks like is learned from where it stands on all pages at hand.

1. *Raw distribution.* Markup is stripped from the lines of each page and the lengths of what is left are summed over
   sliding windows of lines. The first *surge* of the sums and the last *dive* bound the page's core. The line before the
   surge may be a title and is no evidence.
2. *Evidence.* Over all pages, the words and word pairs outside the cores are counted, and those inside. Their
   logarithmic odds tell text that stands outside cores (menus, notices, footers) from text that stands in them. The counts
   are kept in a table of fixed size, by hash. A second round counts the lines that the first one finds against all others,
   so that titles and lists outside cores speak for text.
3. *Own text.* A line whose odds are above ``OUTSIDE`` has no text of its own. The lengths of own text are summed over
   the windows again. Runs of windows with text in which the sum reaches ``SURGE`` run from a surge to a dive; from their
   first to their last line with own text, lines belong to the page. Lines without own text open a gap in them if their
   odds are above ``INSIDE``; outside they are furniture, as are links side by side and blocks of bare link lines of
   words that hardly occur anywhere else.

A single page without a model is judged by the distribution alone.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.arrays import Rolling, codes, mix, runs
from corpusloom.llm.trees import KIND, SEGMENT, counted, cut_counts
from corpusloom.session import ship, table

WINDOW = 3
#: Characters in a window of raw lines that make a surge, and of own text.
RAW_SURGE, SURGE = 150, 60
#: Logarithmic odds from which a line outside, or between, surge and dive has no text of its own; twice that for items.
OUTSIDE, INSIDE = 0.85, 0.95
#: Occurrences of a feature below which it says nothing, and those that are added inside and, in proportion, outside.
SEEN, PRIOR = 5, 10
#: Rounds of counting: the first by cores, the next by the lines found so far, titles and lists outside cores among the others.
ROUNDS = 2
#: Cells of the tables of counts; a byte of each is sent to the executors: 2 MB.
CELLS = 1 << 21
_CHARS = 1 << 20
_UNKNOWN, _STEP = -128, 16

_TAG = re.compile(r"<[^>\n]+>")
_ZERO = re.compile("[​-‏⁠﻿­]")
_MARKS = re.compile("[̀-ͯ]")
_LINKS = re.compile(r"\s*[|·•»›]\s*")
_PROSE_END = re.compile(r"[.!?…]['\"”»)]*$")
_FIELD = re.compile(r"^[^\W\d_]+\s*:\s*\S")
_ITEM = re.compile(r"^\W*(?:[-*•–—~]|\d+[.)])|[@:]|\d\d")
#: Kinds of code points: blank, line feed, letter, digit, sign.
_BULLETS, _CLOSERS, _STOPS = ([ord(x) for x in y] for y in ("-*•–—~", ").", ".!?…"))
_BLANK, _FEED, _LETTER, _DIGIT, _SIGN = range(5)


def _kinds() -> np.ndarray:
    out = np.full(1 << 16, _SIGN, dtype=np.uint8)
    for i in range(1 << 16):
        c = chr(i)
        if c.isdigit():
            out[i] = _DIGIT
        elif c.isalnum():
            out[i] = _LETTER
        elif c.isspace() or unicodedata.category(c)[0] == "C":
            out[i] = _BLANK
    out[10] = _FEED
    return out


_KIND: list[np.ndarray] = []


def plain(text: str) -> str:
    """A text without markup, invisible characters, accents and case; its lines stay."""
    s = _TAG.sub(" ", text)
    if not s.isascii():
        s = _MARKS.sub("", unicodedata.normalize("NFKD", _ZERO.sub("", s)))
    return s.lower()


@dataclass
class Lines:
    """The filled lines of some pages."""

    page: np.ndarray  # number of the page
    no: np.ndarray  # number of the line on its page, from 1
    length: np.ndarray  # characters without outer blanks
    item: np.ndarray  # does it begin with a bullet or a number of a list?
    sentences: np.ndarray  # how many it has
    at: np.ndarray  # for each feature, its line
    cell: np.ndarray  # for each feature, its cell


def lines_of(pages: list[str]) -> Lines:
    """Filled lines of plain pages, with the cells of their words and word pairs. Numbers count as one word."""
    if not _KIND:
        _KIND.append(_kinds())
    c = codes("\n".join(pages) + "\n")
    kind = np.where(c < 1 << 16, _KIND[0][np.minimum(c, (1 << 16) - 1)], _SIGN)
    # lines: first and last character that is no blank
    line = np.cumsum(kind == _FEED) - (kind == _FEED)
    ink = np.flatnonzero(kind > _FEED)
    first = runs(line[ink])
    last = np.r_[first[1:], len(ink)] - 1
    filled = line[ink[first]] if len(ink) else np.zeros(0, np.int64)
    length = ink[last] - ink[first] + 1 if len(ink) else np.zeros(0, np.int64)
    counts = np.array([p.count("\n") + 1 for p in pages])
    page = np.searchsorted(np.cumsum(counts), filled, side="right")
    no = filled - (np.cumsum(counts) - counts)[page] + 1
    # words: runs of letters and digits, and single signs; pairs and whole runs of words stay within a sentence
    word = (kind == _LETTER) | (kind == _DIGIT)
    start = np.flatnonzero((word & ~np.r_[False, word[:-1]]) | (kind == _SIGN))
    end = np.flatnonzero((word & ~np.r_[word[1:], False]) | (kind == _SIGN)) + 1
    letters = np.r_[0, np.cumsum(kind != _DIGIT)]
    number = letters[end] == letters[start]
    h = Rolling(c).of(start, end)
    h[number] = np.uint64(0x9E3779B97F4A7C15)
    at = np.searchsorted(filled, line[start])
    lines = runs(at)
    item = np.zeros(len(filled), bool)
    if len(h):
        sign = np.isin(c[start[lines]], _BULLETS)
        sign |= number[lines] & np.isin(c[np.minimum(end[lines], len(c) - 1)], _CLOSERS)
        item[at[lines]] = sign
    closes = np.isin(c, _STOPS) & np.r_[kind[1:] <= _FEED, True]
    sentence = np.cumsum(closes) - closes + line
    lo = runs(sentence[start])
    place = np.arange(len(h)) - np.repeat(lo, np.diff(np.r_[lo, len(h)]))
    edge, k = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA24BAED4963EE407)
    pairs = mix(np.where(place == 0, edge, np.r_[edge, h[:-1]]) * k + h)
    ends = np.r_[lo[1:], len(h)] - 1 if len(h) else lo
    closing = mix(h[ends] * k + edge)
    cell = (np.concatenate([mix(h), pairs, closing]) % np.uint64(CELLS)).astype(np.int64)
    return Lines(page, no, length, item, np.bincount(at[ends], minlength=len(filled)), np.concatenate([at, at, at[ends]]), cell)


def window_sums(length: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Sums of lengths over windows of ``WINDOW`` lines of one page around each line."""
    out = length.astype(np.float64).copy()
    for d in range(1, WINDOW // 2 + 1):
        same = page[d:] == page[:-d]
        out[d:] += np.where(same, length[:-d], 0)
        out[:-d] += np.where(same, length[d:], 0)
    return out


def cores(x: Lines) -> tuple[np.ndarray, np.ndarray]:
    """Of each line: 1 in its page's core, -1 outside, 0 where that is no evidence: next to the surge and for items of lists."""
    zone = np.zeros(len(x.page), dtype=np.int8)
    own = (window_sums(x.length, x.page) >= RAW_SURGE) & (x.length >= RAW_SURGE * 3 // 4)
    k = np.flatnonzero(own)
    if not len(k):
        return zone
    pages, first = np.unique(x.page[k], return_index=True)
    lo, hi = k[first], k[np.r_[first[1:], len(k)] - 1]
    which = np.minimum(np.searchsorted(pages, x.page), len(pages) - 1)
    i = np.arange(len(zone))
    has = pages[which] == x.page
    zone[has & (i >= lo[which]) & (i <= hi[which])] = 1
    zone[has & ((i < lo[which] - 1) | (i > hi[which])) & ~x.item] = -1
    return zone


class Evidence:
    """Bytes of odds, sixteen to one of the natural logarithm, by cell."""

    def __init__(self, odds: np.ndarray | None = None):
        self.odds = odds

    @classmethod
    def of(cls, outside: np.ndarray, inside: np.ndarray, sentences: tuple[int, int]) -> Evidence:
        """From the counts of features and of sentences, outside cores and inside."""
        share = sentences[0] / max(1, sentences[1])
        if not share:
            return cls()
        odds = np.log((outside + PRIOR * share) / ((inside + PRIOR) * share))
        q = np.clip(np.rint(odds * _STEP), -127, 127).astype(np.int8)
        q[outside + inside < SEEN] = _UNKNOWN
        return cls(q)

    def of_lines(self, x: Lines) -> tuple[np.ndarray, np.ndarray]:
        """Odds of the known features of each line, between their mean and their mean weighted by size, 0 where there is none;
        and the share of its features that is known."""
        if self.odds is None:
            return np.zeros(len(x.page)), np.zeros(len(x.page))
        q = self.odds[x.cell]
        known = q != _UNKNOWN
        at, q = x.at[known], q[known].astype(np.float64) / _STEP
        total = lambda w: np.bincount(at, weights=w, minlength=len(x.page))
        n = total(np.ones(len(q)))
        odds = (total(q) / np.maximum(n, 1) + total(q * np.abs(q)) / np.maximum(total(np.abs(q)), 1e-9)) / 2
        return odds, n / np.bincount(x.at, minlength=len(x.page))


def link_like(s: str) -> bool:
    """Does a plain line look like links side by side: three short parts or more, none of them a number or a sentence?"""
    parts = [p for p in _LINKS.split(s.strip()) if p]
    return len(parts) >= 3 and all(len(p.split()) <= 4 and any(c.isalpha() for c in p) and not _PROSE_END.search(p) for p in parts)


def bare(s: str) -> bool:
    """Could a plain line be one link: a few words, no sentence, item, field, address or number?"""
    return len(s.split()) <= 8 and not _PROSE_END.search(s) and not _ITEM.search(s)


def between(own: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Which lines lie from a surge to a dive of the sums of own text."""
    sums = window_sums(own, page)
    fresh = np.r_[True, (page[1:] != page[:-1]) | (sums[1:] <= 0) | (sums[:-1] <= 0)] if len(own) else np.zeros(0, bool)
    run = np.cumsum(fresh) - 1
    st = np.flatnonzero(fresh)
    if not len(st):
        return np.zeros(0, bool)
    surges = np.maximum.reduceat(sums, st) >= SURGE
    i = np.arange(len(own))
    first = np.minimum.reduceat(np.where(own > 0, i, len(own)), st)
    last = np.maximum.reduceat(np.where(own > 0, i, -1), st)
    return surges[run] & (i >= first[run]) & (i <= last[run])


def _blocks(marked: np.ndarray, page: np.ndarray) -> np.ndarray:
    """Marked lines that stand in a window full of marked lines."""
    return marked & (window_sums(window_sums(marked, page) >= WINDOW, page) > 0)


def furnished(x: Lines, pages: list[str], model: Evidence) -> np.ndarray:
    """Which lines of some plain pages are furniture."""
    odds, known = model.of_lines(x)
    texts = [p.split("\n") for p in pages]
    line = lambda k: texts[x.page[k]][x.no[k] - 1].strip()
    own = np.where(odds >= OUTSIDE, 0, x.length)
    short = np.flatnonzero((odds < OUTSIDE) & (odds > -0.5))
    links = np.zeros(len(own), bool)
    links[[k for k in short if link_like(line(k))]] = True
    # links have no text of their own, but a window full of such lines is a table, and one full of fields a record
    links &= ~_blocks(links, x.page)
    own[links] = 0
    fields = np.zeros(len(own), bool)
    fields[[k for k in np.flatnonzero((x.length < SURGE) & (odds > -0.5)) if _FIELD.match(line(k))]] = True
    fields = _blocks(fields, x.page)
    own[fields] = x.length[fields]
    # a block of bare lines before or after all text is a list of links; the line next to the text may be a title or a name
    text = own >= SURGE
    start = np.flatnonzero(np.r_[True, x.page[1:] != x.page[:-1]]) if len(own) else np.zeros(0, np.int64)
    i, of = np.arange(len(own)), np.cumsum(np.isin(np.arange(len(own)), start)) - 1
    first = np.minimum.reduceat(np.where(text, i, len(own)), start)[of] if len(own) else i
    last = np.maximum.reduceat(np.where(text, i, -1), start)[of] if len(own) else i
    free = np.zeros(len(own), bool)
    free[[k for k in short if known[k] < 0.4 and (last[k] >= 0) and not first[k] - 1 <= k <= last[k] + 1 and bare(line(k))]] = True
    free = _blocks(free & ~fields, x.page)
    own[free] = 0
    inside = between(own, x.page)
    found = np.where(inside, odds >= INSIDE, (odds >= np.where(x.item, 2 * OUTSIDE, OUTSIDE)) | links | free) & ~fields
    if found.any():  # a telephone or other number alone is no link
        k = np.flatnonzero(found)
        found[k[[sum(c.isdigit() for c in line(i)) >= 7 and sum(c.isalpha() for c in line(i)) <= 3 for i in k]]] = False
    return found


def judge(pages: list[str], model: Evidence) -> tuple[np.ndarray, np.ndarray]:
    """(page, line number) of the furniture of some plain pages."""
    x = lines_of(pages)
    found = furnished(x, pages, model)
    return x.page[found], x.no[found]


def furniture_lines(text: str | None, model: Evidence | None = None) -> list[int]:
    """Numbers (from 1) of the lines that are site furniture."""
    if not text:
        return []
    return [int(n) for n in judge([plain(text)], model or Evidence())[1]]


def without(text: str, drop: set[int]) -> str:
    return "\n".join(x for i, x in enumerate(text.split("\n"), 1) if i not in drop).strip("\n")


def main_text(text: str | None, model: Evidence | None = None) -> str | None:
    """The text without its furniture lines; null stays null, a page of furniture alone gives an empty text."""
    return None if text is None else without(text, set(furniture_lines(text, model)))


def main_texts(texts: list[str | None], model: Evidence) -> list[str | None]:
    """The same for many pages at once."""
    out = list(texts)
    some = [i for i, t in enumerate(texts) if t]
    for lo, hi in _parts([texts[i] for i in some]):
        page, no = judge([plain(texts[i]) for i in some[lo:hi]], model)
        st = runs(page)
        for a, b in zip(st, [*st[1:], len(page)]):
            i = some[lo + int(page[a])]
            out[i] = without(texts[i], set(no[a:b].tolist()))
        for i in set(some[lo:hi]) - {some[lo + int(x)] for x in page[st]}:
            out[i] = texts[i].strip("\n")
    return out


def _parts(texts: list[str]):
    """Places of about a million characters each in a list of texts."""
    size = np.cumsum([len(t) for t in texts]) // _CHARS
    st = runs(size)
    return zip(st, [*st[1:], len(texts)])


def _counts(before):
    """One task's counts outside and inside cores, or of furniture and other lines by what was learned before, in compressed
    segments; the last segment counts sentences."""

    def run(frames):
        model = before and Evidence(before.value)
        n, sentences = np.zeros((2, CELLS), dtype=np.uint32), np.zeros(SEGMENT, dtype=np.uint32)
        for f in frames:
            texts = f["text"].tolist()
            for lo, hi in _parts(texts):
                pages = [plain(t) for t in texts[lo:hi]]
                x = lines_of(pages)
                zone = np.where(furnished(x, pages, model), -1, 1) if model else cores(x)
                for i, z in enumerate((-1, 1)):
                    cells, c = np.unique(x.cell[zone[x.at] == z], return_counts=True)
                    n[i, cells] += c.astype(np.uint32)
                    sentences[i] += x.sentences[zone == z].sum()
        yield cut_counts(np.concatenate([n.ravel(), sentences]))

    return run


def _evidence(n: np.ndarray) -> Evidence:
    """From all tasks' counts, one after the other."""
    return Evidence.of(*n[: 2 * CELLS].reshape(2, CELLS), n[2 * CELLS : 2 * CELLS + 2])


def _pages(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))


def learn(df: DataFrame, text_col: str = "text_deep_clean", rounds: int = ROUNDS) -> Evidence:
    """What stands outside and inside the cores of all pages of ``df``; later rounds count by the lines found before."""
    ship(df.sparkSession)
    texts = df.select(F.col(text_col).alias("text")).where("text is not null and text <> ''")
    model = None
    for _ in range(rounds):
        sent = df.sparkSession.sparkContext.broadcast(model.odds) if model else None  # CELLS bytes
        model = _evidence(counted(texts.mapInPandas(_counts(sent), KIND), 2 * CELLS + SEGMENT))
        if model.odds is None:
            break
    return model


def furniture(df: DataFrame, id_col: str = "doc_id", text_col: str = "text_deep_clean", model: Evidence | None = None) -> DataFrame:
    """``doc_id, line_no`` of every furniture line. Lines are parted by line feeds and numbered from 1, blank ones included
    but never reported. Rows without an id, null and empty texts, and pages of main text alone, give no row. ``model`` is
    learned from the same pages unless given."""
    model = model or learn(df, text_col)
    sent = df.sparkSession.sparkContext.broadcast(model.odds)  # CELLS bytes

    def run(frames):
        for f in frames:
            ids, texts = f["doc_id"].to_numpy(), f["text"].tolist()
            for lo, hi in _parts(texts):
                page, no = judge([plain(t) for t in texts[lo:hi]], Evidence(sent.value))
                yield pd.DataFrame({"doc_id": ids[lo:hi][page], "line_no": no.astype(np.int64)})

    return _pages(df, id_col, text_col).where("doc_id is not null and text is not null and text <> ''").mapInPandas(run, "doc_id string, line_no bigint")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return furniture(table(spark, sf_dir, "mainpipe_cleaned_v4"))


def p4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with its main text and the share of it that was kept."""
    df = table(spark, sf_dir, "mainpipe_cleaned_v4")
    sent = spark.sparkContext.broadcast(learn(df).odds)

    @F.pandas_udf("string")
    def body(t: pd.Series) -> pd.Series:
        return pd.Series(main_texts([x if isinstance(x, str) else None for x in t], Evidence(sent.value)), dtype=object)

    df = df.select("doc_id", body("text_deep_clean").alias("main_text"), F.length("text_deep_clean").cast("bigint").alias("text_chars"))
    return df.withColumn("kept_ratio", F.when(F.col("text_chars") > 0, F.round(F.length("main_text") / F.col("text_chars"), 6)))
