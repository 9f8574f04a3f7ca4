"""The stages of the pipeline, each a frame to a frame; all rows stay, with a reason for those that are dropped."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.config import DEFAULT, Config
from corpusloom.functions import langid, pii, scoring, toxicity
from corpusloom.functions import text as T
from corpusloom.operators import rules
from corpusloom.operators.checks import add_struct, once, or_default, require


def ingest(df: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """doc_id, source and ingest_ts over the raw columns."""
    require(df, "url", "text")
    ts = c.ingest_ts or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
    return df.withColumns({"doc_id": T.doc_id("url", "text"), "source": F.lit(c.source), "ingest_ts": F.lit(ts)})


def prefilter(df: DataFrame, c: Config = DEFAULT, kind: str | None = None) -> DataFrame:
    """text_norm, char_len, word_count and the early reasons."""
    require(df, "text")
    out = once(df, text_norm=T.normalize_text("text", c.keep_lines))
    out = out.withColumns({"char_len": F.length("text_norm").cast("bigint"), "word_count": T.word_count("text_norm")})
    return rules.apply(out, rules.early(c, kind=kind))


def language(df: DataFrame, c: Config = DEFAULT, detector: langid.Detector = langid.lexical) -> DataFrame:
    """lang_pred, lang_score, lang, non_latin_ratio and the language reasons."""
    out = once(df, __d=detector(F.col("text_norm")), non_latin_ratio=T.non_latin_ratio("text_norm"))
    out = out.withColumns({"lang_pred": F.col("__d.lang"), "lang_score": F.col("__d.score"), "lang": F.col("__d.lang")}).drop("__d")
    return rules.apply(out, rules.language(c))


def quality(df: DataFrame, c: Config = DEFAULT, toxicity_model: Callable[[Column], Column] = toxicity.toxicity, quality_model: Callable[[Column], Column] = scoring.model_quality) -> DataFrame:
    """Quality metrics, rough PII counts, toxicity, a model's score and the quality reasons.

    ``toxicity_model`` gives a struct of the six scores of ``toxicity.toxicity`` for a text, ``quality_model`` one number;
    either may be any column function, an Arrow function with a model of one's own included.
    """
    out = add_struct(df, T.quality_metrics("text_norm"))
    out = add_struct(out, pii.rough_hits("text_norm"))
    out = add_struct(out, toxicity_model(F.col("text_norm")))
    require(out, *toxicity.SCORES)
    out = once(out, model_q=quality_model(F.col("text_norm")).cast("double"))
    if "url" not in out.columns:
        out = out.withColumn("url", F.lit(""))
    return rules.apply(out, rules.quality(c))


def clean_and_filter(df: DataFrame, c: Config = DEFAULT, detector: langid.Detector = langid.lexical, kind: str | None = None, **models) -> DataFrame:
    """The whole second stage in one pass; ``text`` becomes the normalised text where there is one.

    Rows with an early reason skip the costly steps, as these see a null text for them: their features are null.
    Language-dropped rows are kept with their reason like all others.
    """
    pre = prefilter(df, c, kind)
    early = once(pre, __norm=F.col("text_norm"), __early=F.col("drop_reason").isNotNull())
    out = quality(language(early.withColumn("text_norm", F.when(~F.col("__early"), F.col("text_norm"))), c, detector), c, **models)
    new = [x for x in out.columns if x not in early.columns and x != "url"]
    out = out.withColumns({**{x: F.when(~F.col("__early"), F.col(x)) for x in new}, "text_norm": F.col("__norm"), "text": F.coalesce("__norm", "text")})
    return out.drop("__norm", "__early")


def deep_clean(df: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """text_deep_clean, token statistics, masks and the deep reasons."""
    require(df, "text_norm")
    out = once(df, text_deep_clean=T.structural_cleanup("text_norm"))
    out = add_struct(out, T.token_stats("text_deep_clean"))
    out = add_struct(out, pii.detect_and_mask("text_deep_clean"))
    return rules.apply(out, rules.deep(c))


def score(df: DataFrame, c: Config = DEFAULT) -> DataFrame:
    """quality_score, mixture_name and subset; missing columns count as in the defaults (1.0, 0, 0.0, False)."""
    q = scoring.quality_score(or_default(df, "lang_score", 1.0), or_default(df, "token_count", 0), or_default(df, "unique_token_ratio", 0.0), or_default(df, "has_pii", False), c.min_tokens_pref, c.max_tokens_pref)
    out = once(df, quality_score=q, mixture_name=F.lit(c.mixture_name))
    return out.withColumn("subset", scoring.subset("quality_score", c.high_quality))


def tokenise(df: DataFrame, tokenizer, c: Config = DEFAULT, text: str = "text_pii_masked") -> DataFrame:
    """input_ids, attention_mask, n_tokens and the length reasons."""
    require(df, text)
    out = once(df, input_ids=tokenizer(F.col(text)))
    out = out.withColumns({"attention_mask": F.transform("input_ids", lambda _: F.lit(1)), "n_tokens": F.size("input_ids").cast("bigint")})
    return rules.apply(out, rules.token_length(c))
