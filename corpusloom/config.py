"""All thresholds of the pipeline, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    source: str = "mainpipe_v1"
    ingest_ts: str | None = None  # one value a run; None: the time of the call
    # early rules
    min_chars: int = 20
    min_words: int = 2
    max_chars: int = 100_000
    # language rules
    allowed_langs: tuple[str, ...] = ("en",)
    min_lang_score: float = 0.80
    drop_non_latin: bool = True
    max_non_latin_ratio: float = 0.50
    # quality rules
    least_words: int = 5
    most_words: int = 5000
    min_alpha_ratio: float = 0.5
    max_repetition_ratio: float = 0.8
    max_pii_hits: int = 20
    toxicity_threshold: float = 0.8
    blocked_url: str = r"/ads/|example-spam-site\.com"
    # deep rules
    spam_threshold: float = 0.70
    spam_min_tokens: int = 3
    min_tokens_for_stats: int = 10
    low_unique: float = 0.20
    high_stopword: float = 0.95
    drop_pii: bool = False
    #: Removing boilerplate lines before white space is collapsed; else a text is one line, and one hit empties it.
    keep_lines: bool = False
    # dedup
    near_dup_min_len: int = 200
    near_key_chars: int = 500
    # scoring
    mixture_name: str = "web_sample"
    high_quality: float = 0.8
    min_tokens_pref: int = 20
    max_tokens_pref: int = 1000
    # tokens and shards
    min_tokens: int = 10
    max_tokens: int = 2048
    docs_per_shard: int = 50_000
    toy_docs: int = 1000
    seed: int = 42
    text_priority: tuple[str, ...] = ("text_pii_masked", "text_deep_clean", "text_norm", "text")
    extra_fields: tuple[str, ...] = ("doc_id", "source", "url", "subset", "mixture_name", "quality_score")


DEFAULT = Config()
