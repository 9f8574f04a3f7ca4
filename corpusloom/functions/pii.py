"""Pattern-based personal data: counts and masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import col, let

#: The patterns, and the placeholder of each in the order of masking.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
ROUGH_PHONE = r"\+?\d[\d\- ]{7,}\d"
PHONE = r"\b(?:\+?\d{1,3}[\s\-\.]?)?(?:\(?\d{2,4}\)?[\s\-\.]?)?\d{3,4}[\s\-\.]?\d{3,4}\b"
CARD = r"\b(?:\d[ -]*?){13,16}\b"
IBAN = r"\b[A-Z]{2}\d{2}[A-Z0-9]{10,30}\b"
MASKS = (("email", EMAIL, "<EMAIL>"), ("phone", PHONE, "<PHONE>"), ("cc", CARD, "<CREDIT_CARD>"), ("iban", IBAN, "<IBAN>"))


#: What a text must hold before a pattern is tried on it: cheap, and most texts hold none of it.
_GATE = {EMAIL: "@", PHONE: r"\d{3}", ROUGH_PHONE: r"\d", CARD: r"\d", IBAN: r"[A-Z]{2}\d{2}"}


def _may_hold(c: Column, pattern: str) -> Column:
    gate = _GATE.get(pattern)
    return F.lit(True) if gate is None else c.contains(gate) if gate == "@" else c.rlike(gate)


def hits(c, pattern: str) -> Column:
    """Matches of a pattern as bigint; 0 for null."""
    c = col(c)
    return F.when(_may_hold(c, pattern), F.regexp_count(c, F.lit(pattern))).otherwise(F.lit(0)).cast("bigint")


def replace(c, pattern: str, placeholder: str) -> Column:
    c = col(c)
    return F.when(_may_hold(c, pattern), F.regexp_replace(c, pattern, placeholder)).otherwise(c)


def rough_hits(c) -> Column:
    return F.struct(hits(c, EMAIL).alias("email_hits"), hits(c, ROUGH_PHONE).alias("phone_hits"))


def _replacer(pattern: str, placeholder: str):
    return lambda x: replace(x, pattern, placeholder)


def mask(c) -> Column:
    """Each kind replaced in turn, so a later pattern sees the placeholders of the earlier ones."""
    t = col(c)
    for _, pattern, placeholder in MASKS:
        t = let(t, _replacer(pattern, placeholder))
    return t


def detect_and_mask(c) -> Column:
    """struct(text_pii_masked, pii_*_hits, has_pii); hits are counted on the text before masking."""
    n = {k: hits(c, p) for k, p, _ in MASKS}
    return F.struct(
        mask(c).alias("text_pii_masked"),
        *[x.alias(f"pii_{k}_hits") for k, x in n.items()],
        (sum(n.values(), F.lit(0)) > 0).alias("has_pii"),
    )
