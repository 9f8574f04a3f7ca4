"""Queries of the core operators, by name; each takes (spark, folder) and reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.config import DEFAULT, Config
from corpusloom.functions import langid, pii, scoring, tokenizer, toxicity
from corpusloom.functions import text as X
from corpusloom.operators import checks, dedup, metrics, rules, sharding, stages
from corpusloom.plans import pipeline
from corpusloom.session import durable, shared_dir, table
from corpusloom.sources import readers, sinks
from corpusloom.streaming import stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
V1, V2, V4, V5, DOCS = "mainpipe_ingested_v1", "mainpipe_cleaned_v2", "mainpipe_cleaned_v4", "mainpipe_cleaned_v5", "documents"


def query(f):
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, *cols: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in cols})


# ---- sources


@query
def scan_parquet(spark, d):
    return readers.parquet(spark, f"{d}/{V1}.parquet", "doc_id", "text").select("row_idx", "doc_id", "url", "text")


@query
def scan_jsonl(spark, d):
    """Written as JSON lines and read back."""
    path = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    sinks.write_jsonl(table(spark, d, DOCS).select("doc_id", "text", "source"), path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType())])
    return readers.jsonl(spark, path, schema)


def _typed_lines(spark, d):
    """The raw pages as JSON lines, numeric texts written as numbers, and read with the kinds of their values."""
    path = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    number = F.col("text").rlike("^[1-9][0-9]{0,17}$")
    text = F.to_json(F.struct("row_idx", "url", "text"), {"ignoreNullFields": "false"})
    plain = F.to_json(F.struct("row_idx", "url"), {"ignoreNullFields": "false"})
    line = F.when(number, F.concat(F.expr("left(p, length(p) - 1)"), F.lit(',"text":'), F.col("text"), F.lit("}"))).otherwise(F.col("t"))
    table(spark, d, V1).withColumns({"t": text, "p": plain}).select(line.alias("value")).write.mode("overwrite").text(path)
    return readers.jsonl_typed(spark, path, row_idx="bigint")


@query
def scan_jsonl_typed(spark, d):
    """Kind, url and length of every raw text after a way through JSON lines."""
    return _typed_lines(spark, d).select("row_idx", "url", F.coalesce("text_kind", F.lit("ABSENT")).alias("kind"), F.coalesce(F.length("text"), F.lit(-1)).cast("bigint").alias("text_chars"))


@query
def drop_reason_typed(spark, d):
    """The early rules where the source knows that a value was no text."""
    return stages.prefilter(_typed_lines(spark, d), kind="text_kind").select("row_idx", "drop_reason")


@query
def head_lines(spark, d):
    """The first three lines of a JSON-lines file of sorted ids."""
    path = f"{shared_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    table(spark, d, DOCS).select("doc_id", "source").orderBy("doc_id").coalesce(1).write.option("ignoreNullFields", "false").json(path)
    return readers.head_lines(spark, path, 3).select(F.from_json("value", "doc_id bigint, source string").alias("r")).select("r.*")


@query
def fail_fast(spark, d):
    """What is refused while the plan is made: a missing file, missing columns."""
    tests = {"missing_file": lambda: readers.jsonl(spark, f"{d}/no_such_file.jsonl"), "missing_column": lambda: readers.parquet(spark, f"{d}/{V1}.parquet", "no_such_column"), "present": lambda: readers.parquet(spark, f"{d}/{V1}.parquet", "text")}
    rows = []
    for name, f in tests.items():
        try:
            f()
            rows.append((name, False))
        except Exception:
            rows.append((name, True))
    return spark.createDataFrame(rows, "check_name string, refused boolean")


@query
def scan_optional(spark, d):
    """A table that is not there reads as empty."""
    none = readers.optional_parquet(spark, f"{d}/no_such_table.parquet", readers.RAW)
    return none.unionByName(readers.optional_parquet(spark, f"{d}/{V1}.parquet", readers.RAW).select("url", "text")).agg(F.count(F.lit(1)).alias("n"))


# ---- projections and scalar functions


@query
def doc_id_sha1(spark, d):
    return stages.ingest(table(spark, d, V1), Config(ingest_ts="2025-01-01T00:00:00")).select("row_idx", "doc_id", "source", "ingest_ts")


@query
def normalize_text(spark, d):
    return table(spark, d, V1).select("row_idx", X.normalize_text("text").alias("text_norm"))


@query
def word_count(spark, d):
    return table(spark, d, DOCS).select("doc_id", X.word_count("text").alias("word_count"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("char_len"))


@query
def quality_metrics(spark, d):
    return rounded(checks.add_struct(table(spark, d, V2).select("doc_id", "text_norm"), X.quality_metrics("text_norm")).drop("text_norm"), "alpha_ratio", "repetition_ratio")


@query
def non_latin_ratio(spark, d):
    return table(spark, d, V2).select("doc_id", F.round(X.non_latin_ratio("text_norm"), 9).alias("non_latin_ratio"))


@query
def pii_hits_simple(spark, d):
    return table(spark, d, V2).select("doc_id", pii.rough_hits("text_norm").alias("s")).select("doc_id", "s.*")


@query
def toxicity_scores(spark, d):
    out = table(spark, d, V2).select("doc_id", toxicity.toxicity("text_norm").alias("s")).select("doc_id", "s.*")
    return rounded(out, *[c for c in out.columns if c != "doc_id"])


#: A lexicon of one's own: words that the test tables hold.
OWN_LEXICON = {"profanity": ("kettle", "lantern"), "insult": ("mayor", "tenant", "bürgermeister"), "threat": ("bridge", "puente"), "sexual_explicit": ("museum",), "identity_attack": ("the", "der")}


@query
def toxicity_lexicon(spark, d):
    """The heuristic over a lexicon of one's own."""
    own = table(spark, d, V2).select("doc_id", toxicity.toxicity("text_norm", OWN_LEXICON).alias("s")).select("doc_id", "s.*")
    return rounded(own, *toxicity.SCORES)


@query
def toxicity_terms(spark, d):
    """How often each term of the built-in lexicon occurs, those that never do included."""
    lex = toxicity.lexicon_table(spark)
    words = [t for ts in toxicity.LEXICON.values() for t in ts]
    tok = F.regexp_extract_all(F.lower("text"), F.lit(toxicity.WORD), F.lit(0))
    n = table(spark, d, DOCS).select(F.explode(F.filter(tok, lambda x: x.isin(words))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return lex.join(n, "term", "left").select("category", "term", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query
def lang_detect(spark, d):
    return table(spark, d, V2).select("doc_id", langid.lexical("text_norm").alias("s")).select("doc_id", F.col("s.lang").alias("lang_pred"), F.round("s.score", 9).alias("lang_score"))


@query
def strip_html(spark, d):
    return table(spark, d, V1).select("row_idx", X.strip_html("text").alias("text"))


@query
def boilerplate(spark, d):
    return table(spark, d, V4).select("doc_id", X.remove_boilerplate("text_deep_clean").alias("text"))


@query
def repeat_chars(spark, d):
    return table(spark, d, V2).select("doc_id", X.collapse_repeats("text_norm").alias("text"))


@query
def structural_cleanup(spark, d):
    """Over the normalised raw pages, whose texts are one line each."""
    return table(spark, d, V1).select("row_idx", X.structural_cleanup(X.normalize_text("text")).alias("text"))


@query
def token_stats(spark, d):
    return rounded(table(spark, d, V4).select("doc_id", X.token_stats("text_deep_clean").alias("s")).select("doc_id", "s.*"), "unique_token_ratio", "stopword_ratio")


@query
def token_spam(spark, d):
    return table(spark, d, V1).select("row_idx", F.round(X.top_token_share("text"), 9).alias("top_share"), X.is_token_spam("text").alias("is_spam"))


@query
def pii_mask(spark, d):
    return table(spark, d, V4).select("doc_id", pii.detect_and_mask("text_deep_clean").alias("s")).select("doc_id", "s.*")


def _pii_kind(name, pattern):
    def f(spark, d):
        return table(spark, d, V4).select("doc_id", pii.hits("text_deep_clean", pattern).alias("hits"), F.regexp_replace("text_deep_clean", pattern, dict((k, m) for k, _, m in pii.MASKS)[name]).alias("masked"))

    f.__name__ = f"pii_{name}"
    query(f)


for _k, _p, _ in pii.MASKS:
    _pii_kind(_k, _p)


@query
def canon_exact(spark, d):
    return table(spark, d, V4).select("doc_id", X.canonical("text_pii_masked").alias("canon"))


@query
def canon_near(spark, d):
    return table(spark, d, V4).select("doc_id", X.near_key("text_pii_masked").alias("near_key"))


@query
def sha256(spark, d):
    return table(spark, d, V4).select("doc_id", X.sha256(X.canonical("text_pii_masked")).alias("exact_hash"))


def _scored(spark, d):
    """The inputs of the score lie in two tables."""
    v2 = table(spark, d, V2).select("doc_id", "url", "lang_score", "text_norm")
    v4 = table(spark, d, V4).select("doc_id", "source", "token_count", "unique_token_ratio", "has_pii", "text_deep_clean", "text_pii_masked")
    return stages.score(v4.join(v2, "doc_id"))


@query
def quality_score(spark, d):
    return rounded(_scored(spark, d).select("doc_id", "quality_score", "subset", "mixture_name"), "quality_score")


@query
def subset(spark, d):
    return _scored(spark, d).select("doc_id", scoring.subset(F.col("quality_score")).alias("subset"))


@query
def model_quality(spark, d):
    """The quality stage with models of one's own: a score by length, and a toxicity that counts exclamation marks."""
    loud = lambda t: F.least(F.lit(1.0), F.coalesce(F.regexp_count(t, F.lit("!")), F.lit(0)) / 10.0)
    tox = lambda t: F.struct(loud(t).alias("toxicity"), *[F.lit(0.0).alias(c) for c in toxicity.SCORES[1:]])
    pre = table(spark, d, V2).select("doc_id", "url", "text_norm")
    out = stages.quality(pre, DEFAULT, toxicity_model=tox, quality_model=lambda t: F.least(F.lit(1.0), F.length(t) / 1000.0))
    return rounded(out.select("doc_id", "toxicity", "model_q", (F.col("drop_reason") == "high_toxicity").alias("is_loud")), "toxicity", "model_q").fillna(False, ["is_loud"])


@query
def text_fallback(spark, d):
    return table(spark, d, V4).join(table(spark, d, V2).select("doc_id", "text_norm"), "doc_id").select("doc_id", X.first_filled("text_pii_masked", "text_deep_clean", "text_norm").alias("text"))


@query
def pick_text(spark, d):
    return table(spark, d, V4).select("doc_id", X.first_filled("text_pii_masked", "text_deep_clean", strip=True).alias("text"))


def _bpe(spark):
    return tokenizer.bpe(spark, tokenizer.VOCABULARY)


@query
def tokenise(spark, d):
    """By bytes, as its SQL; the reference's limit counts BPE tokens, as ``tokenise_bpe`` does."""
    out = stages.tokenise(table(spark, d, V4).select("doc_id", "text_pii_masked"), tokenizer.byte_level)
    n, mask = F.size("input_ids"), F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)
    return out.select("doc_id", "n_tokens", F.md5(F.array_join("input_ids", " ")).alias("ids_in_order"), (n == mask).alias("mask_fits"), "drop_reason")


@query
def tokenise_bpe(spark, d):
    """The same stage with a vocabulary file, where one is at hand."""
    return stages.tokenise(table(spark, d, V4).select("doc_id", "text_pii_masked"), _bpe(spark)).select("doc_id", "n_tokens", "drop_reason")


# ---- drop rules


def _early(spark, d):
    return stages.prefilter(table(spark, d, V1))


@query
def drop_reason_early(spark, d):
    return _early(spark, d).select("row_idx", F.coalesce("char_len", F.lit(0)).alias("char_len"), "word_count", "drop_reason")


@query
def drop_reason_lang(spark, d):
    return stages.language(table(spark, d, V2).select("doc_id", "text_norm")).select("doc_id", "lang_pred", "drop_reason")


def _quality(spark, d):
    pre = rules.kept(_early(spark, d))
    return stages.quality(pre)


@query
def drop_reason_quality(spark, d):
    return _quality(spark, d).select("row_idx", "n_words", "drop_reason")


@query
def drop_reason_deep(spark, d):
    return stages.deep_clean(_early(spark, d).where("text_norm is not null").drop("drop_reason")).select("row_idx", "token_count", "drop_reason")


@query
def drop_reason_pii(spark, d):
    """With the option to drop texts that hold personal data."""
    c = Config(drop_pii=True)
    v4 = table(spark, d, V4)
    return rules.apply(v4, rules.deep(c)).select("doc_id", "drop_reason")


@query
def drop_reason_tokens(spark, d):
    """By bytes, as its SQL; ``tokenise_bpe`` has the reasons by BPE tokens."""
    return stages.tokenise(table(spark, d, V4).select("doc_id", "text_pii_masked"), tokenizer.byte_level).select("doc_id", "n_tokens", "drop_reason")


@query
def kept_dropped(spark, d):
    e = _early(spark, d)
    return checks.union_all(rules.kept(e).select("row_idx", F.lit("kept").alias("side")), rules.dropped(e).select("row_idx", F.lit("dropped").alias("side")))


@query
def dropped_union(spark, d):
    """Dropped rows of two stages by name, with nulls for what one lacks."""
    q = rules.dropped(_quality(spark, d)).select("row_idx", "drop_reason", "n_words")
    both = checks.union_all(rules.dropped(_early(spark, d)).select("row_idx", "drop_reason", "word_count"), q)
    return both.fillna(-1, ["word_count", "n_words"])


# ---- deduplication


def _dedup(spark, d):
    return dedup.deduplicate(table(spark, d, V4).select("doc_id", "text_pii_masked"))


@query
def dedup_exact(spark, d):
    return _dedup(spark, d).select("doc_id", "exact_hash", "is_dup_exact")


@query
def dedup_near(spark, d):
    return _dedup(spark, d).select("doc_id", "near_key", "is_dup_near", "drop_reason")


@query
def dedup_by_row_number(spark, d):
    """Without an id column the row number is the id."""
    raw = table(spark, d, V1).select("row_idx", F.col("text").alias("text_pii_masked"))
    return dedup.deduplicate(raw, order="row_idx").select("row_idx", "dedup_id", "dup_of")


@query
def dedup_columns(spark, d):
    """What a deduplicated frame holds: its input, the stage's columns, and no helper."""
    out = _dedup(spark, d)
    return spark.createDataFrame([(c, t) for c, t in out.dtypes], "column_name string, column_type string")


@query
def dup_of(spark, d):
    return _dedup(spark, d).select("doc_id", "dedup_id", "dup_of", "drop_reason")


@query
def dedup_summary(spark, d):
    return dedup.summary(_dedup(spark, d))


# ---- aggregates


@query
def drop_reason_counts(spark, d):
    return metrics.value_counts(_early(spark, d), "drop_reason", name="n")


@query
def stage_counts(spark, d):
    return metrics.stage_counts(_early(spark, d))


@query
def quality_summary(spark, d):
    return metrics.summary(table(spark, d, V2), ["n_chars", "n_words", "alpha_ratio", "repetition_ratio"])


@query
def token_summary(spark, d):
    return metrics.summary(table(spark, d, V4), ["token_count", "unique_token_ratio", "stopword_ratio"], mean=False)


def _describe(t, c):
    def f(spark, d):
        return metrics.describe(table(spark, d, t), c)

    f.__name__ = f"describe_{c}"
    query(f)


for _t, _c in ((V2, "lang_score"), (V4, "token_count"), (DOCS, "n_chars"), (V4, "unique_token_ratio")):
    _describe(_t, _c)


@query
def describe_quality_score(spark, d):
    return metrics.describe(_scored(spark, d), "quality_score")


@query
def subset_counts(spark, d):
    return _scored(spark, d).groupBy("subset").agg(F.count(F.lit(1)).alias("n"))


@query
def pii_totals(spark, d):
    return metrics.pii_totals(table(spark, d, V4))


@query
def pii_aggregate(spark, d):
    """Totals over two outputs together; rows that are in both count twice."""
    v4 = table(spark, d, V4)
    dropped5 = v4.join(table(spark, d, V5).where("drop_reason is not null").select("doc_id"), "doc_id", "left_semi")
    return metrics.pii_aggregate(v4, dropped5)


@query
def pii_rows(spark, d):
    """The row-level PII columns of the CSV report, read back."""
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(checks.project_existing(table(spark, d, V4), ["doc_id", *metrics.PII_COUNTS, "has_pii", "no_such_column"]), path)
    return spark.read.option("header", True).schema("doc_id string, pii_email_hits bigint, pii_phone_hits bigint, pii_cc_hits bigint, pii_iban_hits bigint, has_pii boolean").csv(path)


@query
def pii_hit_hist(spark, d):
    """Of each of the four counters its most frequent values, 30 at most."""
    v4 = table(spark, d, V4)
    return checks.union_all(*[metrics.value_counts(v4, c, top=30, name="n").select(F.lit(c).alias("counter"), F.col(c).alias("hits"), "n") for c in metrics.PII_COUNTS])


@query
def csv_drop_counts(spark, d):
    """The CSV of drop counts, one file, read back."""
    path = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(metrics.value_counts(_early(spark, d), "drop_reason", name="n"), path, one_file=True)
    return spark.read.option("header", True).schema("drop_reason string, n bigint").csv(path)


@query
def sink_kept_dropped(spark, d):
    """Both sides of a stage written to folders that are not there yet, and read back."""
    base = f"{shared_dir(spark)}/sides-{uuid.uuid4().hex}/a/b"
    sinks.write_kept_dropped(_early(spark, d).select("row_idx", "drop_reason"), f"{base}/kept", f"{base}/dropped")
    read = lambda x: spark.read.parquet(f"{base}/{x}").select("row_idx", "drop_reason", F.lit(x).alias("side"))
    return read("kept").unionByName(read("dropped"))


@query
def low_info_counts(spark, d):
    deep = stages.deep_clean(_early(spark, d).where("text_norm is not null").drop("drop_reason"))
    return metrics.low_info_counts(deep)


@query
def toxicity_report(spark, d):
    return metrics.share_report(_quality(spark, d), "high_toxicity", "toxic")


@query
def language_report(spark, d):
    return metrics.share_report(stages.language(table(spark, d, V2).select("doc_id", "text_norm")), "non_english", "non_english")


def _hist(t, c, bins):
    def f(spark, d):
        return metrics.histogram(table(spark, d, t), c, bins)

    f.__name__ = f"hist_{c}"
    query(f)


for _t, _c, _b in ((V2, "char_len", 80), (V2, "word_count", 80), (V2, "lang_score", 50), (V2, "alpha_ratio", 50), (V2, "repetition_ratio", 50), (V4, "unique_token_ratio", 50), (V4, "stopword_ratio", 50), (V4, "token_count", 80)):
    _hist(_t, _c, _b)


@query
def hist_quality_score(spark, d):
    return metrics.histogram(_scored(spark, d), "quality_score", 50)


@query
def hist_n_tokens(spark, d):
    """By bytes, as its SQL."""
    return metrics.histogram(stages.tokenise(table(spark, d, V4).select("doc_id", "text_pii_masked"), tokenizer.byte_level), "n_tokens", 80)


@query
def structural_counters(spark, d):
    return metrics.structural_counters(table(spark, d, V2), "text_norm")


@query
def low_unique_examples(spark, d):
    """The first five texts of many tokens and few different ones."""
    v = stages.deep_clean(_early(spark, d).where("text_norm is not null").drop("drop_reason"))
    return v.where("token_count >= 10 and unique_token_ratio < 0.2").orderBy("row_idx").limit(5).select("row_idx", "token_count", F.round("unique_token_ratio", 9).alias("unique_token_ratio"))


# ---- shards and records


@query
def shard_assign(spark, d):
    return sharding.assign_shards(table(spark, d, DOCS).select("doc_id"), "doc_id", 300).select("doc_id", "idx", "shard_id")


@query
def shard_manifest(spark, d):
    items = table(spark, d, DOCS).select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_tokens"))
    return sharding.manifest(sharding.assign_shards(items, "doc_id", 300))


def _shards_of(spark, d, encode, name, only_kept=False):
    """Shards written as JSON lines under the names of the manifest, read back: file, rows and tokens of each."""
    path = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    docs = stages.tokenise(table(spark, d, DOCS).select("doc_id", F.col("text").alias("text_pii_masked")), encode)
    m = sinks.write_shards(rules.kept(docs) if only_kept else docs, path, "doc_id", Config(docs_per_shard=300), tokenizer_name=name)
    if not m["shards"]:
        return spark.createDataFrame([], "shard_id bigint, filename string, num_docs bigint, total_tokens bigint")
    schema = "input_ids array<int>, attention_mask array<int>, doc_id bigint"
    read = spark.read.schema(schema).json([s["path"] for s in m["shards"]]).select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("filename"), F.size("input_ids").alias("n"))
    found = read.groupBy("filename").agg(F.count(F.lit(1)).alias("num_docs"), F.sum("n").alias("total_tokens"))
    listed = spark.createDataFrame([(s["shard_id"], s["filename"], s["num_docs"], s["total_tokens"]) for s in m["shards"]], "shard_id bigint, filename string, num_docs bigint, total_tokens bigint")
    return listed.join(found, ["filename", "num_docs", "total_tokens"]).select("shard_id", "filename", "num_docs", "total_tokens")


@query
def shard_files(spark, d):
    """Shards of all documents, in bytes, as its SQL."""
    return _shards_of(spark, d, tokenizer.byte_level, "byte_level")


@query
def shard_files_bpe(spark, d):
    """Shards of all documents, whatever their length, in BPE tokens."""
    return _shards_of(spark, d, _bpe(spark), "byte_bpe_50k")


@query
def toy_shard(spark, d):
    """What a sample must hold whatever its seed: so many rows (or all), no row twice, all of the table; seeds differ."""
    docs = table(spark, d, DOCS).select("doc_id", "source")
    one, two = (sharding.sample(docs, 100, "doc_id", seed) for seed in (42, 7))
    n = one.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("doc_id").alias("n_ids"))
    inside = one.join(docs, ["doc_id"], "left_semi").agg(F.count(F.lit(1)).alias("n_known"))
    other = one.join(two, "doc_id", "left_anti").agg((F.count(F.lit(1)) > 0).alias("seeds_differ"))
    return n.join(inside).join(other)  # one row each


def _parsed(records: DataFrame) -> DataFrame:
    """Records as JSON texts, read again."""
    return sinks.as_json(records).select(F.from_json("record", records.schema).alias("r")).select("r.*")


@query
def jsonl_clean(spark, d):
    return _parsed(sinks.clean_records(table(spark, d, V2).withColumnRenamed("text_norm", "text")))


@query
def jsonl_text_fallback(spark, d):
    return _parsed(sinks.fallback_records(table(spark, d, V4)))


@query
def jsonl_scored(spark, d):
    return sinks.scored_records(rounded(_scored(spark, d), "quality_score"))


@query
def jsonl_tokenised(spark, d):
    """By bytes, as its SQL."""
    return _tokenised(spark, d, tokenizer.byte_level)


@query
def jsonl_tokenised_bpe(spark, d):
    """The same records by BPE tokens, which the reference's limit counts."""
    return _tokenised(spark, d, _bpe(spark))


def _tokenised(spark, d, encode):
    out = stages.tokenise(_scored(spark, d), encode)
    return _parsed(sinks.tokenised_records(rules.kept(out), attention_mask=False)).select("doc_id", "url", "subset", F.size("input_ids").cast("bigint").alias("n_tokens"), F.md5(F.array_join("input_ids", " ")).alias("ids_in_order"))


@query
def export_text(spark, d):
    return sinks.export_records(rounded(_scored(spark, d), "quality_score"), drop_empty=True)


# ---- whole runs


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """All stages over the raw pages: rows by drop reason, ``kept`` for those that reach the end."""
    out = pipeline.run(table(spark, d, V1).drop("source", "ingest_ts"), DEFAULT)
    reasons = out["dropped"].select("drop_reason").unionByName(rules.kept(out["tokenised"]).select(F.lit("kept").alias("drop_reason")))
    return reasons.groupBy("drop_reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "drop_reason")


@query
def pipeline_reasons(spark, d):
    return flagship(spark, d)


@query
def pipeline_reasons_bytes(spark, d):
    """The whole run with the tokenizer that SQL has too: its limits count bytes."""
    out = pipeline.run(table(spark, d, V1).drop("source", "ingest_ts"), DEFAULT, encode=tokenizer.byte_level)
    return checks.union_all(out["dropped"].select("row_idx", "drop_reason"), rules.kept(out["tokenised"]).select("row_idx", F.lit("kept").alias("drop_reason")))


@query
def clean_and_filter(spark, d):
    """The second stage: its text is the normalised one, its language is there under both names."""
    out = stages.clean_and_filter(table(spark, d, V1))
    return out.select("row_idx", "text", "drop_reason", F.coalesce(F.col("lang") == F.col("lang_pred"), F.lit(False)).alias("lang_is_pred"))


@query
def pipeline_kept_lines(spark, d):
    """The option that keeps line feeds, so that boilerplate is removed line by line."""
    c = Config(keep_lines=True, allowed_langs=tuple(langid.VOTES))
    out = pipeline.run(table(spark, d, V1).drop("source", "ingest_ts"), c)
    return rules.kept(out["scored"]).groupBy("lang_pred", "subset").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("quality_score"), 6).alias("mean_score"))


@query
def metrics_report(spark, d):
    """The summary metrics, written as one JSON file and read back: a row a metric."""
    s, v4 = _scored(spark, d), table(spark, d, V4)
    values = {"quality_score": metrics.describe(s, "quality_score").first().asDict(), "pii": metrics.pii_totals(v4).first().asDict(), "drop_reasons": {r["drop_reason"]: r["n"] for r in metrics.value_counts(_early(spark, d), "drop_reason", name="n").collect()}}
    path = f"{shared_dir(spark)}/metrics-{uuid.uuid4().hex}.json"
    sinks.write_metrics(values, path, spark)
    part = "map<string, double>"
    read = spark.read.text(path, wholetext=True).select(F.from_json("value", f"quality_score {part}, pii {part}, drop_reasons {part}").alias("r"))
    return checks.union_all(*[read.select(F.lit(k).alias("report"), F.explode(f"r.{k}").alias("metric", "value")) for k in values])


@query
def stream_reason_counts(spark, d):
    """The early rules over a stream of the raw pages: rows by reason."""
    src = f"{d}/{V1}.parquet*"
    schema = table(spark, d, V1).schema
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    s = stages.prefilter(stream.read_parquet(spark, src, schema)).select("row_idx", "drop_reason")
    stream.drain(s, lambda b, i: b.write.mode("overwrite").parquet(f"{base}/out/batch={i}"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query
def stream_clean(spark, d):
    """Cleaning, filtering and deep cleaning of a stream of the raw pages: rows by reason."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    s = stream.clean(stream.read_parquet(spark, f"{d}/{V1}.parquet*", table(spark, d, V1).schema)).select("row_idx", "drop_reason")
    stream.drain(s, lambda b, i: b.write.mode("overwrite").parquet(f"{base}/out/batch={i}"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("row_idx", "drop_reason")


@query
def stream_window_counts(spark, d):
    """Rows of the stream by day and early reason; rows without a time count under none."""
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    s = stages.prefilter(stream.read_parquet(spark, f"{d}/{V1}.parquet*", table(spark, d, V1).schema)).withColumn("crawled_at", F.col("crawled_at").cast("timestamp"))
    stream.drain(stream.reason_counts(s, "crawled_at"), lambda b, i: b.write.mode("overwrite").parquet(f"{base}/out"), f"{base}/checkpoint", "complete")
    return spark.read.parquet(f"{base}/out").select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "reason", "n")


@query
def stream_dedup(spark, d):
    """Exact copies within a watermark of as long as the table: distinct canonical texts. The time is that of the crawl, or of the
    arrival where there is none."""
    schema = table(spark, d, DOCS).schema
    base = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    rows = stream.read_parquet(spark, f"{d}/{DOCS}.parquet*", schema).withColumn("seen_at", F.coalesce("crawled_at", "ingested_at").cast("timestamp"))
    s = stream.dedup_exact(rows, "text", "seen_at", "36500 days").select("exact_hash")
    stream.drain(s, lambda b, i: b.write.mode("overwrite").parquet(f"{base}/out/batch={i}"), f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/out").select("exact_hash")
