"""The quality score and what hangs on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col

#: Weights of language, length, unique tokens and freedom from personal data; where long texts reach 0.
WEIGHTS = (0.4, 0.3, 0.2, 0.1)
TOO_LONG = 4000


def clamp(c: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def quality_score(lang_score, token_count, unique_ratio, has_pii, least: int = 20, most: int = 1000) -> Column:
    """Between 0 and 1. A null language score, count or ratio counts as 0, a null flag as no personal data; NaN as 1."""
    lang = col(lang_score).cast("double")
    lang = F.when(lang.isNull(), 0.0).when(F.isnan(lang), 1.0).otherwise(clamp(lang))
    n = F.coalesce(col(token_count), F.lit(0)).cast("double")
    length = (
        F.when(n <= 0, 0.0)
        .when(n < least, n / F.lit(float(least)))
        .when(n > most, F.greatest(F.lit(0.0), 1.0 - (F.least(n, F.lit(float(TOO_LONG))) - most) / F.lit(float(TOO_LONG - most))))
        .otherwise(1.0)
    )
    unique = clamp(F.coalesce(col(unique_ratio), F.lit(0.0)).cast("double"))
    clean = F.when(F.coalesce(col(has_pii), F.lit(False)), 0.0).otherwise(1.0)
    a, b, c, d = (F.lit(w) for w in WEIGHTS)
    return clamp(a * lang + b * length + c * unique + d * clean)


def subset(score, threshold: float = 0.8) -> Column:
    return F.when(col(score) >= threshold, "high_quality").otherwise("rest")


def model_quality(_text=None) -> Column:
    """A place for a model's score; a constant until there is one."""
    return F.lit(0.5)
