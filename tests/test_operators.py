"""Rules, stages, deduplication, shards, reports, sources, sinks and streams on small frames."""

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.config import Config
from corpusloom.functions import tokenizer
from corpusloom.operators import checks, dedup, metrics, rules, sharding, stages
from corpusloom.plans import pipeline, queries, sql
from corpusloom.sources import readers, sinks
from corpusloom.streaming import stream

DAY = "The quick brown fox jumps over the lazy dog near the river bank today"


def frame(spark, texts, url="http://x.org/1"):
    return spark.createDataFrame([(i, url, t) for i, t in enumerate(texts)], "row_idx bigint, url string, text string")


def reasons(df):
    return [r[0] for r in df.orderBy("row_idx").select("drop_reason").collect()]


def test_early_rules(spark):
    texts = [None, "", "\x00\x07 \t\n", " N/A ", "null value", "Nan", "3.14-15", "1" * 25, "１２３４", "short text here", "x y", "a" * 25, "ab " * 40_000, "1234567890 1234567890 99", "hello world this is ok"]
    want = ["missing", "empty_after_clean", "empty_after_clean", "null_like", "null_like", "null_like", "numeric_like", "numeric_like", "numeric_like", "too_short_chars", "too_short_chars", "too_short_words", "too_long", None, None]
    assert reasons(stages.prefilter(frame(spark, texts))) == want


def test_quality_rules(spark):
    texts = ["only four words herelong", " ".join(f"word{i}" for i in range(5001)), "11 22 33 44 55 66 77 abc def", "go " * 12, "mail " + " ".join(f"a{i}@x.org" for i in range(21)), "mail " + " ".join(f"a{i}@x.org" for i in range(20)), DAY, "you idiot moron stupid loser dumb"]
    want = ["too_short", "too_long", "low_alpha_ratio", "high_repetition", "pii_heavy", None, None, "high_toxicity"]
    assert reasons(stages.quality(stages.prefilter(frame(spark, texts)))) == want
    for url in ("http://x.com/ads/1", "https://example-spam-site.com/q"):
        assert reasons(stages.quality(stages.prefilter(frame(spark, [DAY], url)))) == ["blocked_url"]


def test_language_and_deep_rules(spark):
    out = stages.language(stages.prefilter(frame(spark, [DAY + " and it is the best of all", "Der Hund ist nicht hier und das ist gut so", "12345678901234567890 123 zzz"])))
    assert reasons(out) == [None, "non_english", "lang_unknown"]
    deep = stages.deep_clean(stages.prefilter(frame(spark, ["spam " * 9 + "ham", "the of and to in it is at be by or " * 2, DAY])))
    assert reasons(deep) == ["repetitive_token_spam", "high_stopword_ratio", None]
    assert reasons(stages.deep_clean(stages.prefilter(frame(spark, [DAY + " a@b.org"])), Config(drop_pii=True))) == ["pii"]


def test_reason_given_before_stays(spark):
    df = frame(spark, [None]).withColumn("drop_reason", F.lit("before"))
    assert reasons(stages.prefilter(df)) == ["before"]


def test_dedup(spark):
    a, b = "long text " * 60, "b" * 300
    rows = [(1, "Hello   World"), (2, "hello world"), (3, ""), (4, None), (5, a), (6, a[:500] + "another tail"), (7, a.upper()), (8, b), (9, b + " x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text_pii_masked string").repartition(4)
    got = {r["doc_id"]: (r["drop_reason"], r["dup_of"], r["is_dup_near"]) for r in dedup.deduplicate(df).collect()}
    none = (None, None, False)
    assert got == {1: none, 2: ("exact_duplicate", "1", False), 3: none, 4: ("exact_duplicate", "3", False), 5: none, 6: ("near_duplicate", "5", True), 7: ("exact_duplicate", "5", False), 8: none, 9: none}
    s = dedup.summary(dedup.deduplicate(df)).first()
    assert (s["n_rows"], s["kept"], s["exact_duplicates"], s["near_duplicates"]) == (9, 5, 3, 1)


def test_dedup_of_one_hot_text_and_extra_columns(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same").alias("text_pii_masked"), F.lit(1).alias("salt"), F.lit("x").alias("n"))
    out = dedup.deduplicate(df)
    assert out.where("drop_reason is null").count() == 1 and out.where("dup_of = '0'").count() == 2999 and "salt" in out.columns


@pytest.mark.parametrize("n,size,want", [(0, 2, []), (1, 2, [1]), (2, 2, [2]), (3, 2, [2, 1]), (4, 2, [2, 2]), (1000, 7, [7] * 142 + [6])])
def test_shards(spark, n, size, want):
    df = spark.range(n).select((F.col("id") * 17 % 1009).alias("doc_id")).repartition(5)
    out = sharding.assign_shards(df, "doc_id", size)
    rows = out.orderBy("doc_id").collect()
    assert [r["idx"] for r in rows] == list(range(n))
    assert [r["num_docs"] for r in sharding.manifest(out).orderBy("shard_id").collect()] == want


def test_sample_is_stable(spark):
    df = spark.range(500).withColumnRenamed("id", "doc_id")
    a = {r[0] for r in sharding.sample(df, 50, "doc_id").collect()}
    assert a == {r[0] for r in sharding.sample(df.repartition(7), 50, "doc_id").collect()} and len(a) == 50


def test_empty_and_constant_tables(spark):
    empty = frame(spark, [])
    out = pipeline.run(empty)
    assert all(f.count() == 0 for f in out.values())
    assert metrics.histogram(empty, "row_idx", 5).count() == 0 and metrics.describe(empty, "row_idx").first()["count"] == 0
    same = spark.range(4).select(F.lit(3).alias("x"))
    assert [tuple(r) for r in metrics.histogram(same, "x", 5).collect()] == [(1, 3.0, 3.0, 4)]


def test_pipeline_keeps_every_row(spark):
    texts = [None, "x y", DAY + " and it is the best of all", DAY + " and it is the best of all", "Der Hund ist nicht hier und das ist gut so", DAY + " with a mail a@b.org for it"]
    out = pipeline.run(frame(spark, texts), Config(min_lang_score=0.5))
    kept = rules.kept(out["tokenised"]).count()
    assert kept + out["dropped"].count() == len(texts) and kept == 2
    assert rules.kept(out["tokenised"]).where("text_pii_masked like '%<EMAIL>%'").count() == 1


def test_token_limit_counts_bpe_tokens(spark, tmp_path):
    long = " ".join(f"{DAY} and it is the best of all {w} that we have" for w in "mill lamp road hill barn gate pond tree wall yard fern moss bell desk coin rope silk wool corn salt".split() * 2)
    assert len(long) > 2048
    out = pipeline.run(frame(spark, [long]), Config(min_lang_score=0.5, low_unique=0.0, max_repetition_ratio=1.0))
    assert [r["n_tokens"] < 2048 for r in rules.kept(out["tokenised"]).collect()] == [True]
    docs = [(i, t) for i, t in enumerate([long, "short", None, "word " * 4000])]
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["shard_files_bpe"](spark, str(tmp_path)).collect()
    ids = tokenizer.bpe(spark, tokenizer.VOCABULARY)
    want = spark.createDataFrame(docs, "doc_id bigint, text string").agg(F.sum(F.size(ids("text")))).first()[0]
    assert [(r["num_docs"], r["total_tokens"]) for r in got] == [(4, want)]


def test_sources_and_sinks(spark, tmp_path):
    p = str(tmp_path / "raw.jsonl")
    (tmp_path / "raw.jsonl").write_text('{"url":"u","text":"a"}\n{"url":"u","text":5}\n{"url":"u","text":null}\n{"url":"u"}\nno json\n')
    kinds = [r["text_kind"] for r in readers.jsonl_typed(spark, p).collect()]
    assert kinds == ["STRING", "BIGINT", "VOID", None, None]
    typed = readers.jsonl_typed(spark, p).withColumn("row_idx", F.monotonically_increasing_id())
    assert reasons(stages.prefilter(typed, kind="text_kind"))[:3] == ["too_short_chars", "non_string", "missing"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.jsonl(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="missing columns: z"):
        checks.require(spark.range(1), "z")
    assert readers.optional_parquet(spark, str(tmp_path / "none"), readers.RAW).count() == 0
    assert readers.head_lines(spark, p, 2).count() == 2
    docs = stages.tokenise(frame(spark, [DAY, DAY + "!", "üö 東京 " * 5]).withColumnsRenamed({"text": "text_pii_masked", "row_idx": "doc_id"}), tokenizer.byte_level)
    m = sinks.write_shards(docs, str(tmp_path / "shards"), "doc_id", Config(docs_per_shard=2))
    assert sorted(p.name for p in (tmp_path / "shards").iterdir() if not p.name.startswith((".", "_"))) == ["train_shard_00001.jsonl", "train_shard_00002.jsonl", "train_shard_manifest.json"]
    for s in m["shards"]:  # the files of the manifest are there and hold what it says
        lines = [json.loads(x) for x in open(s["path"])]
        assert len(lines) == s["num_docs"] and sum(len(x["input_ids"]) for x in lines) == s["total_tokens"] and set(lines[0]) >= {"input_ids", "attention_mask", "doc_id"}
    assert json.loads((tmp_path / "shards" / "train_shard_manifest.json").read_text()) == m and m["created_at_utc"]
    assert (m["num_shards"], m["total_docs"]) == (2, 3) and m["total_tokens"] == sum(s["total_tokens"] for s in m["shards"])
    sinks.write_metrics(m, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text())["num_shards"] == 2
    sinks.write_kept_dropped(docs, str(tmp_path / "k"), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "k")).count() == 3
    sinks.write_toy(docs, str(tmp_path / "toy"), "doc_id")
    assert spark.read.json(str(tmp_path / "toy")).count() == 3


def test_export(spark):
    df = spark.createDataFrame([("1", "  a "), ("2", " "), ("3", None)], "doc_id string, text_norm string")
    assert [r["text"] for r in sinks.export_records(df).orderBy("doc_id").collect()] == ["a", "", ""]
    assert sinks.export_records(df, drop_empty=True).columns == ["text", "doc_id"] and sinks.export_records(df, drop_empty=True).count() == 1


def test_streams(spark, tmp_path):
    rows = [(1, "u", "hello there my good old friend", "2025-01-01"), (2, "u", "HELLO there my  good old friend", "2025-01-01"), (3, "u", "x", "2025-01-02")]
    spark.createDataFrame(rows, "row_idx bigint, url string, text string, at string").withColumn("at", F.to_timestamp("at")).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    read = lambda: stream.read_parquet(spark, str(tmp_path / "in"), schema)
    out = []
    stream.drain(stream.dedup_exact(read(), "text", "at"), lambda b, i: out.extend(b.collect()), str(tmp_path / "c1"))
    assert sorted(r["row_idx"] for r in out) in ([1, 3], [2, 3])
    out2 = []
    stream.drain(stream.clean(read()), lambda b, i: out2.extend(b.collect()), str(tmp_path / "c2"))
    assert {r["row_idx"]: r["drop_reason"] for r in out2}[3] == "too_short_chars"
    counts = {}
    stream.drain(stream.reason_counts(stages.prefilter(read()), "at"), lambda b, i: counts.update({r["reason"]: r["n"] for r in b.collect()}), str(tmp_path / "c3"), "update")
    assert counts == {"kept": 2, "too_short_chars": 1}


def test_results_do_not_depend_on_partitions(spark):
    df = frame(spark, [DAY + f" number {i % 7} of it all" for i in range(60)] + [None] * 5)
    a, b = (sorted(map(str, pipeline.run(df.repartition(n))["dropped"].select("row_idx", "drop_reason").collect())) for n in (1, 8))
    assert a == b


def test_every_sql_has_its_query():
    assert set(sql.ORACLE) <= set(queries.QUERIES)


def test_filters_reach_the_files(spark, tmp_path):
    spark.range(10).withColumn("a", F.col("id")).withColumn("b", F.col("id")).write.parquet(str(tmp_path / "t"))
    plan = spark.read.parquet(str(tmp_path / "t")).where("a > 3").select("b")._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(a), GreaterThan(a,3)]" in plan and "ReadSchema: struct<a:bigint,b:bigint>" in plan


def test_dedup_shuffles_no_text(spark):
    from corpusloom.operators.dedup import deduplicate

    df = spark.createDataFrame([(i, f"d{i}", "Same  TEXT" if i % 3 else f"text {i}") for i in range(60)], "row_idx int, doc_id string, text_pii_masked string")
    out = deduplicate(df, order="row_idx")
    assert out.where("is_dup_exact").count() == 39 and {r[0] for r in out.where("dup_of is not null").select("dup_of").collect()} == {"d1"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange" in x and "Broadcast" not in x]


def test_dedup_without_an_id_numbers_rows(spark):
    from corpusloom.operators.dedup import deduplicate

    df = spark.createDataFrame([(5, "a b"), (3, "A  b"), (4, "c")], "row_idx int, text_pii_masked string")
    got = {r["row_idx"]: (r["dedup_id"], r["dup_of"]) for r in deduplicate(df, order="row_idx").collect()}
    assert got == {3: ("3", None), 5: ("5", "3"), 4: ("4", None)}


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from corpusloom import session

    unset = SimpleNamespace(get=lambda *a: None)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(master="spark://host:7077", getConf=lambda: unset), conf=unset)
    with pytest.raises(ValueError):
        session.shared_dir(cluster)


def test_scratch_deletes_intermediate_tables(spark):
    from corpusloom import session

    with session.scratch(spark):
        kept = session.durable(spark.range(3))
        assert kept.count() == 3
        gone = session.durable(spark.range(4))
        session.release(gone)
        assert gone._corpusloom_path not in session._OPEN and kept._corpusloom_path in session._OPEN
    assert kept._corpusloom_path not in session._OPEN


def test_quantiles(spark):
    import numpy as np

    for values in ([1.0], [2.0, 1.0], [3.0, 1.0, 1.0, 8.0], list(np.random.default_rng(1).normal(size=501).round(2))):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double").repartition(5)
        want = np.quantile(values, [0, 0.25, 0.5, 0.75, 1])
        assert metrics.quantiles(df, "x", [0, 0.25, 0.5, 0.75, 1]) == pytest.approx(list(want))
    assert metrics.quantiles(df.where("false"), "x", [0.5]) == [None]


def test_models_can_be_plugged_in(spark):
    import pandas as pd

    @F.pandas_udf("double")
    def vowels(t: pd.Series) -> pd.Series:
        return t.str.count("[aeiou]") / t.str.len()

    mean = lambda t: F.struct(F.when(t.contains("mean"), 1.0).otherwise(0.0).alias("toxicity"), *[F.lit(0.0).alias(c) for c in ("severe_toxicity", "insult", "threat", "identity_attack", "sexual_explicit")])
    out = pipeline.run(frame(spark, [DAY + " and it is mean of all", DAY + " and it is the best of all"]), Config(min_lang_score=0.5), toxicity_model=mean, quality_model=vowels)
    rows = {r["row_idx"]: r for r in out["cleaned"].collect()}
    assert sorted(str(r["drop_reason"]) for r in rows.values()) == ["None", "high_toxicity"] and all(0.1 < r["model_q"] < 0.6 for r in rows.values())
    with pytest.raises(ValueError, match="severe_toxicity"):
        stages.quality(spark.createDataFrame([("a b c d e",)], "text_norm string"), toxicity_model=lambda t: F.struct(F.lit(0.0).alias("toxicity")))


def test_late_copies_in_a_stream(spark, tmp_path):
    """Within the delay later copies are dropped; a copy that comes after it is a first one again, and rows behind the watermark go."""
    import os

    files = [[("a", "2025-01-01 00:00:00")], [("A ", "2025-01-01 06:00:00"), ("b", "2025-01-04 00:00:00")], [("d", "2025-01-04 01:00:00")], [("c", "2025-01-01 00:00:00"), ("a", "2025-01-04 02:00:00")]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "text string, at string").withColumn("at", F.to_timestamp("at")).coalesce(1).write.parquet(str(tmp_path / f"w{i}"))
        (tmp_path / "in").mkdir(exist_ok=True)
        part = next((tmp_path / f"w{i}").glob("part-*"))
        os.rename(part, tmp_path / "in" / f"{i}.parquet")
        os.utime(tmp_path / "in" / f"{i}.parquet", (1000 + i, 1000 + i))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    out = []
    stream.drain(stream.dedup_exact(stream.read_parquet(spark, str(tmp_path / "in"), schema, 1), "text", "at", "1 day"), lambda b, i: out.extend((r["text"], str(r["at"])) for r in b.collect()), str(tmp_path / "c"))
    assert sorted(out) == [("a", "2025-01-01 00:00:00"), ("a", "2025-01-04 02:00:00"), ("b", "2025-01-04 00:00:00"), ("d", "2025-01-04 01:00:00")]


def test_charts(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    sinks.bar_chart(metrics.value_counts(df, "x"), "x", "count", str(tmp_path / "bars.png"))
    sinks.histogram_chart(metrics.histogram(df, "id", 10), str(tmp_path / "hist.png"), 10)
    assert all((tmp_path / f"{n}.png").read_bytes()[:8] == b"\x89PNG\r\n\x1a\n" for n in ("bars", "hist"))


def test_stages_are_logged(spark, caplog):
    with caplog.at_level("INFO", logger="corpusloom"):
        pipeline.run(frame(spark, [DAY]), Config(min_lang_score=0.5))
    assert [r.getMessage() for r in caplog.records if "begins" in r.getMessage()] == [f"stage {n} begins" for n in ("clean and filter", "deep clean", "deduplicate", "tokenise")]
