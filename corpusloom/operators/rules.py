"""Ordered drop rules: the first that matches gives the reason, and a reason once given stays."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import Config
from corpusloom.functions import text as T
from corpusloom.operators.checks import once

Rule = tuple[str, Column]
#: Texts that stand for a missing one.
NULL_LIKE = ("nan", "none", "null", "n/a", "null value")


def first_match(rules: Iterable[Rule]) -> Column:
    """One CASE WHEN over the rules in order; null comparisons count as no match."""
    out = None
    for reason, test in rules:
        out = F.when(test, reason) if out is None else out.when(test, reason)
    return out if out is not None else F.lit(None).cast("string")


def apply(df: DataFrame, rules: Iterable[Rule], reason: str = "drop_reason") -> DataFrame:
    """Fills the reason where it is null; adds the column if there is none."""
    new = first_match(list(rules))
    return once(df, **{reason: F.coalesce(F.col(reason), new) if reason in df.columns else new})


def kept(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    return df.where(F.col(reason).isNull())


def dropped(df: DataFrame, reason: str = "drop_reason") -> DataFrame:
    return df.where(F.col(reason).isNotNull())


def early(c: Config, raw: str = "text", norm: str = "text_norm", kind: str | None = None) -> list[Rule]:
    """Rules on the normalised text. ``kind``: a column with the raw value's type, if the source knows it."""
    n = F.col(norm)
    typed = [("non_string", F.col(kind).isNotNull() & ~F.col(kind).isin("STRING", "VOID"))] if kind else []
    return [
        ("missing", F.col(raw).isNull()),
        *typed,
        ("empty_after_clean", n.isNull()),
        ("null_like", F.lower(F.trim(n)).isin(*NULL_LIKE)),
        ("numeric_like", n.rlike(r"^[\d\.\-]+$")),
        ("too_short_chars", F.col("char_len") < c.min_chars),
        ("too_short_words", F.col("word_count") < c.min_words),
        ("too_long", F.col("char_len") > c.max_chars),
    ]


def language(c: Config) -> list[Rule]:
    known = F.col("lang_pred").isin(*c.allowed_langs)
    rules = [
        ("lang_unknown", F.col("lang_pred") == "unk"),
        ("non_english", ~known),
        ("low_lang_confidence", known & (F.col("lang_score") < c.min_lang_score)),
    ]
    if c.drop_non_latin:
        rules.append(("non_latin_heavy", F.col("non_latin_ratio") > c.max_non_latin_ratio))
    return rules


def quality(c: Config, text: str = "text_norm") -> list[Rule]:
    return [
        ("empty_text", F.col(text).isNull() | (T.trim_white(text) == "")),
        ("too_short", F.col("n_words") < c.least_words),
        ("too_long", F.col("n_words") > c.most_words),
        ("low_alpha_ratio", F.col("alpha_ratio") < c.min_alpha_ratio),
        ("high_repetition", F.col("repetition_ratio") > c.max_repetition_ratio),
        ("blocked_url", F.col("url").rlike(c.blocked_url)),
        ("pii_heavy", F.col("email_hits") + F.col("phone_hits") > c.max_pii_hits),
        ("high_toxicity", F.col("toxicity") >= c.toxicity_threshold),
    ]


def deep(c: Config, text: str = "text_deep_clean") -> list[Rule]:
    enough = F.col("token_count") >= c.min_tokens_for_stats
    rules = [
        ("repetitive_token_spam", T.is_token_spam(text, c.spam_threshold, c.spam_min_tokens)),
        ("low_unique_token_ratio", enough & (F.col("unique_token_ratio") < c.low_unique)),
        ("high_stopword_ratio", enough & (F.col("stopword_ratio") > c.high_stopword)),
    ]
    if c.drop_pii:
        rules.append(("pii", F.col("has_pii")))
    return rules


def token_length(c: Config) -> list[Rule]:
    return [("too_few_tokens", F.col("n_tokens") < c.min_tokens), ("too_many_tokens", F.col("n_tokens") > c.max_tokens)]
