"""Scalar text functions as column expressions. Null in, null out, unless a function says otherwise."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WHITE = r"(?U)\s+"
#: The words that count as stopwords.
STOPWORDS = (
    "the a an and or of to in for on at is it this that with as by from be are was were will would can could has have had about into over after before between up down"
).split()
#: Patterns of boilerplate lines.
BOILERPLATE = (
    r"cookie(s)? policy",
    r"accept( all)? cookies",
    r"privacy policy",
    r"terms of service",
    r"all rights reserved",
    r"sign up for our newsletter",
    r"subscribe to our newsletter",
    r"contact us",
)
_LINE_END = "\\r\\n|[\\n\\r\\x0B\\x0C\\x1C\\x1D\\x1E\\x85\\u2028\\u2029]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: All white space there is.
WHITE_CHARS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also where the optimiser would copy it into several branches."""
    return F.element_at(F.transform(F.array(value), body), 1)


def trim_white(c) -> Column:
    return F.btrim(col(c), F.lit(WHITE_CHARS))


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c) -> Column:
    """Unicode compatibility composition; ASCII texts never leave the JVM's side as more than a null."""
    c = col(c)
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def normalize_text(c, keep_lines: bool = False) -> Column:
    """NFKC, control characters to blanks, white space collapsed and stripped; empty results are null.

    With ``keep_lines`` line feeds survive (with blanks around them removed).
    """
    t = nfkc(c)
    if keep_lines:
        t = F.regexp_replace(t, "\\r\\n?", "\n")
        t = F.regexp_replace(t, "[\\x00-\\x09\\x0B-\\x1F\\x7F-\\x9F]", " ")
        t = F.regexp_replace(t, "(?U)[\\s&&[^\\n]]+", " ")
        t = F.regexp_replace(t, " ?\\n ?", "\n")
    else:
        t = F.regexp_replace(t, "[\\x00-\\x1F\\x7F-\\x9F]", " ")
        t = F.regexp_replace(t, WHITE, " ")
    return F.nullif(trim_white(t), F.lit(""))


def tokens(c) -> Column:
    """White-space tokens; an empty array for empty and null texts."""
    t = trim_white(c)
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(F.split(t, WHITE))


def word_count(c) -> Column:
    """Number of white-space words as bigint; 0 for null."""
    return F.size(tokens(c)).cast("bigint")


def ratio(a: Column, b: Column) -> Column:
    """a / b as a double, 0 where b is 0 or null."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def letters(c, of: str = r"\p{L}") -> Column:
    """How many letters; they stand in runs, so taking runs out is cheaper than taking the rest out."""
    return F.length(col(c)) - F.length(F.regexp_replace(col(c), f"[{of}]+", ""))


def quality_metrics(c) -> Column:
    """struct(n_chars, n_words, alpha_ratio, repetition_ratio); zeros for null."""
    c = F.coalesce(col(c), F.lit(""))
    tok = tokens(c)
    n = F.size(tok)
    return F.struct(
        F.length(c).cast("bigint").alias("n_chars"),
        n.cast("bigint").alias("n_words"),
        ratio(letters(c), F.length(c)).alias("alpha_ratio"),
        F.when(n > 0, 1.0 - F.size(F.array_distinct(tok)) / n).otherwise(F.lit(0.0)).alias("repetition_ratio"),
    )


def non_latin_ratio(c) -> Column:
    """Share of letters outside ASCII among all letters; 0 for texts without letters and for null."""
    c = F.coalesce(col(c), F.lit(""))
    n = letters(c)
    return ratio(n - letters(c, "A-Za-z"), n)


def strip_html(c) -> Column:
    return F.regexp_replace(col(c), "<[^>]+>", " ")


def lines(c) -> Column:
    return F.split(col(c), _LINE_END)


def is_boilerplate(line: Column) -> Column:
    return F.lower(line).rlike("|".join(BOILERPLATE))


def remove_boilerplate(c) -> Column:
    """Drops the lines that hold a boilerplate phrase; joins the rest by line feeds and strips."""
    kept = F.filter(lines(c), lambda x: ~is_boilerplate(x))
    return trim_white(F.array_join(kept, "\n"))


def collapse_repeats(c) -> Column:
    """Runs of three and more of ``! ? . ,`` to two, then runs of four and more of any character to three."""
    t = F.regexp_replace(col(c), r"([!?.,])\1{2,}", "$1$1")
    return F.regexp_replace(t, r"([^\n])\1{3,}", "$1$1$1")


def structural_cleanup(c) -> Column:
    return collapse_repeats(remove_boilerplate(strip_html(c)))


def token_stats(c) -> Column:
    """struct(token_count, unique_tokens, unique_token_ratio, stopword_ratio); zeros for empty and null."""
    tok = tokens(c)
    n = F.size(tok)
    u = F.size(F.array_distinct(tok))
    stop = F.size(F.filter(tok, lambda x: F.lower(x).isin(STOPWORDS)))
    return F.struct(
        n.cast("bigint").alias("token_count"),
        u.cast("bigint").alias("unique_tokens"),
        ratio(u, n).alias("unique_token_ratio"),
        ratio(stop, n).alias("stopword_ratio"),
    )


def top_token_share(c) -> Column:
    """Share of the most frequent token: run lengths over the sorted tokens, in one pass."""
    tok = tokens(c)
    zero = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc, x):
        run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1))
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return ratio(F.aggregate(F.array_sort(tok), zero, step, lambda acc: acc["best"]), F.size(tok))


def is_token_spam(c, threshold: float = 0.70, min_tokens: int = 3) -> Column:
    """Does one token make up more than the threshold of at least so many tokens?

    That needs few different tokens, which is cheap to know; only such texts have their tokens counted.
    """
    tok = tokens(c)
    n = F.size(tok)
    few = F.size(F.array_distinct(tok)) <= n * (1 - threshold) + 1
    return F.when((n >= min_tokens) & few, top_token_share(c) > threshold).otherwise(F.lit(False))


def canonical(c) -> Column:
    """Lower case, stripped, white space collapsed; null gives an empty text."""
    return F.regexp_replace(trim_white(F.lower(F.coalesce(col(c), F.lit("")))), WHITE, " ")


def near_key(c, max_chars: int = 500) -> Column:
    return F.substring(canonical(c), 1, max_chars)


def sha256(c) -> Column:
    return F.sha2(F.coalesce(col(c), F.lit("")), 256)


def doc_id(url, text) -> Column:
    """sha1 of ``url || text``, where a missing part reads ``None``."""
    part = lambda c: F.coalesce(col(c).cast("string"), F.lit("None"))
    return F.sha1(F.concat(part(url), F.lit("||"), part(text)))


def first_filled(*cs, strip: bool = False) -> Column:
    """The first text that is neither null nor empty; stripped, and empty if there is none, with ``strip``."""
    xs = [trim_white(c) if strip else col(c) for c in cs]
    if strip:
        return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs], F.lit(""))
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in xs[:-1]], xs[-1])
