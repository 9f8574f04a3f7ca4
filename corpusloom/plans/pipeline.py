"""The whole pipeline: the stages one after the other, each written once to the shared folder.

A stage feeds both its kept and its dropped rows to what follows. Written, it is computed once, filters on its reason reach
the files instead of being inlined through every expression below, and a lost executor costs one stage at most. A stage
writes only the columns that a later one or its own output needs: texts that it supersedes stay behind.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from corpusloom.config import DEFAULT, Config
from corpusloom.functions import langid, tokenizer
from corpusloom.operators import dedup, rules, stages
from corpusloom.operators.checks import union_all
from corpusloom.session import durable

log = logging.getLogger("corpusloom")


def run(raw: DataFrame, c: Config = DEFAULT, detector: langid.Detector = langid.lexical, encode: Callable | None = None, order: str = "row_idx", keep: Callable[[DataFrame], DataFrame] = durable, **models) -> dict[str, DataFrame]:
    """Every stage's output: cleaned, deep, deduplicated, scored, tokenised, and all dropped rows.

    ``keep`` takes a stage's frame and gives back one that is cheap to read; by default it is written and read again.
    The limits of ``token_length`` are numbers of BPE tokens, so texts are cut by the public vocabulary unless ``encode`` is given.
    ``models``: ``toxicity_model`` and ``quality_model`` of ``stages.quality``. Rows without a ``doc_id`` are ingested
    first. An empty input gives empty outputs of the same columns. Stages are logged under the name ``corpusloom``.
    """

    def stage(name: str, df: DataFrame) -> DataFrame:
        log.info("stage %s begins", name)
        began = time.monotonic()
        out = keep(df)
        log.info("stage %s ended after %.1f s", name, time.monotonic() - began)
        return out

    if "doc_id" not in raw.columns:
        raw = stages.ingest(raw, c)
    cleaned = stage("clean and filter", stages.clean_and_filter(raw, c, detector, **models))
    deep = stage("deep clean", stages.deep_clean(rules.kept(cleaned).drop("text"), c).drop("text_norm"))
    deduped = stage("deduplicate", dedup.deduplicate(rules.kept(deep), c, order=order))
    scored = stages.score(rules.kept(deduped).drop("exact_canon_text", "near_key"), c)
    tokenised = stage("tokenise", stages.tokenise(scored.drop("text_deep_clean"), encode or tokenizer.bpe(raw.sparkSession, tokenizer.VOCABULARY), c))
    return {
        "cleaned": cleaned, "deep": deep, "deduplicated": deduped, "scored": scored, "tokenised": tokenised,
        "dropped": union_all(rules.dropped(cleaned), rules.dropped(deep), rules.dropped(deduped), rules.dropped(tokenised)),
    }
