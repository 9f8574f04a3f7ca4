"""Keyword toxicity. The lexicon is data: term and category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import col

#: The terms by category.
LEXICON = {
    "profanity": ("fuck", "fucking", "shit", "bitch", "bastard", "asshole", "crap", "damn", "dick", "piss"),
    "insult": ("idiot", "moron", "stupid", "loser", "dumb"),
    "threat": ("kill", "murder", "hurt", "shoot", "stab"),
    "sexual_explicit": ("sex", "porn", "nude", "naked"),
    "identity_attack": ("nigger", "nigga", "faggot", "retard"),
}
WORD = r"[\p{L}\p{N}_]+"
SCALE, SEVERE = 5.0, 0.9
#: What a toxicity model has to give.
SCORES = ("toxicity", "severe_toxicity", "insult", "threat", "identity_attack", "sexual_explicit")


def lexicon_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t, c) for c, ts in LEXICON.items() for t in ts], "term string, category string")


def toxicity(c, lexicon: dict[str, tuple[str, ...]] = LEXICON) -> Column:
    """struct of six scores between 0 and 1: hits among all words times five, at most 1; zeros for null."""
    tok = F.regexp_extract_all(F.lower(F.coalesce(col(c), F.lit(""))), F.lit(WORD), F.lit(0))
    n = F.greatest(F.size(tok), F.lit(1))
    every = [t for ts in lexicon.values() for t in ts]
    bad = F.filter(tok, lambda x: x.isin(every))  # few are left to be told apart

    def score(terms):
        return F.least(F.lit(1.0), F.size(F.filter(bad, lambda x: x.isin(list(terms)))) / n * SCALE)

    total = F.least(F.lit(1.0), F.size(bad) / n * SCALE)
    return F.struct(
        total.alias("toxicity"),
        F.when(total >= SEVERE, 1.0).otherwise(0.0).alias("severe_toxicity"),
        *[score(lexicon[k]).alias(k) for k in ("insult", "threat", "identity_attack", "sexual_explicit")],
    )
