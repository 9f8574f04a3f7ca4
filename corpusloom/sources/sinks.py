"""Sinks, and the record layouts they write."""

from __future__ import annotations

import json
import zlib
from datetime import datetime, timezone

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.config import DEFAULT, Config
from corpusloom.functions import text as T
from corpusloom.operators.checks import project_existing
from corpusloom.operators.sharding import in_shards, sample
from corpusloom.session import durable, release

FALLBACK = ("text_pii_masked", "text_deep_clean", "text_norm", "text")
#: The fields of a tokenised record.
SHARD_FIELDS = ("input_ids", "attention_mask", "doc_id", "url", "subset", "mixture_name", "quality_score")


def clean_records(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "text", "source")


def fallback_records(df: DataFrame, *extra: str) -> DataFrame:
    """doc_id, the first filled text as it is, source, and further fields."""
    return df.select("doc_id", T.first_filled(*[c for c in FALLBACK if c in df.columns]).alias("text"), "source", *extra)


def scored_records(df: DataFrame) -> DataFrame:
    return fallback_records(df, "quality_score", "subset", "mixture_name")


def tokenised_records(df: DataFrame, attention_mask: bool = True) -> DataFrame:
    return project_existing(df, [c for c in SHARD_FIELDS if attention_mask or c != "attention_mask"])


def export_records(df: DataFrame, c: Config = DEFAULT, drop_empty: bool = False) -> DataFrame:
    """text (the first filled one by priority, stripped, else empty) and those extra fields that exist."""
    picked = T.first_filled(*[x for x in c.text_priority if x in df.columns], strip=True).alias("text")
    out = df.select(picked, *[x for x in c.extra_fields if x in df.columns])
    return out.where("text <> ''") if drop_empty else out


def as_json(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON text, nulls written out."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_kept_dropped(df: DataFrame, kept: str, dropped: str | None = None) -> None:
    """Both sides of a stage, which is computed once."""
    if not dropped:
        return write_parquet(df.where("drop_reason is null"), kept)
    once = durable(df)
    write_parquet(once.where("drop_reason is null"), kept)
    write_parquet(once.where("drop_reason is not null"), dropped)
    release(once)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header; ``one_file`` only for reports of bounded size."""
    (df.coalesce(1) if one_file else df).write.mode("overwrite").option("header", True).csv(path)


def write_metrics(values: dict, path: str, spark: SparkSession | None = None) -> None:
    """A dict of bounded size as one JSON file: on the driver's disk, or with ``spark`` on any file system Spark reaches."""
    text = json.dumps(values, indent=2, ensure_ascii=False)
    if spark is None:
        with open(path, "w", encoding="utf-8") as f:
            f.write(text)
        return
    jvm = spark.sparkContext._jvm
    out = _fs(spark, path).create(jvm.org.apache.hadoop.fs.Path(path), True)
    out.write(bytearray(text.encode()))
    out.close()


def _fs(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_shards(df: DataFrame, folder: str, order: str, c: Config = DEFAULT, base: str = "train_shard", tokenizer_name: str = "byte_level", created_at: str | None = None) -> dict:
    """JSON-lines shards of ``docs_per_shard`` rows in order, one file ``{base}_00001.jsonl`` each in ``folder``, and the
    manifest as a dict (one entry a shard), which is written beside them as ``{base}_manifest.json``.

    Shards are written in parallel, each by the one task that holds its rows, and then given their names; only these names
    and the counts of each shard pass the driver. ``created_at`` is the time of the call unless given.
    """
    spark = df.sparkSession
    folder = folder.rstrip("/")
    part = f"{folder}/_parts"
    sharded = in_shards(df, order, c.docs_per_shard)
    fields = tokenised_records(sharded).columns
    tokens = F.col("n_tokens") if "n_tokens" in sharded.columns else F.lit(None).cast("bigint")
    counted = durable(sharded.select("shard_id", *fields, tokens.alias("__tokens")))
    counted.select("shard_id", *fields).write.mode("overwrite").partitionBy("shard_id").option("ignoreNullFields", "false").json(part)
    shards = counted.groupBy("shard_id").agg(F.count(F.lit(1)).alias("num_docs"), F.sum("__tokens").alias("total_tokens"))
    jvm, fs = spark.sparkContext._jvm, _fs(spark, folder)
    path = jvm.org.apache.hadoop.fs.Path
    rows = []
    for r in shards.orderBy("shard_id").collect():  # one row a shard, of which there are at most MAX_SHARDS
        name = f"{base}_{r['shard_id']:05d}.jsonl"
        files = [f.getPath() for f in fs.listStatus(path(f"{part}/shard_id={r['shard_id']}")) if f.getPath().getName().startswith("part-")]
        if len(files) != 1:
            raise RuntimeError(f"shard {r['shard_id']} has {len(files)} files")
        target = path(f"{folder}/{name}")
        fs.delete(target, False)
        if not fs.rename(files[0], target):
            raise RuntimeError(f"{name} can't be written")
        rows.append({"shard_id": r["shard_id"], "filename": name, "path": f"{folder}/{name}", "num_docs": r["num_docs"], "total_tokens": r["total_tokens"]})
    fs.delete(path(part), True)
    release(counted)
    has_tokens = all(s["total_tokens"] is not None for s in rows)
    out = {
        "created_at_utc": created_at or datetime.now(timezone.utc).isoformat(), "tokenizer_name": tokenizer_name, "docs_per_shard": c.docs_per_shard, "num_shards": len(rows),
        "total_docs": sum(s["num_docs"] for s in rows), "total_tokens": sum(s["total_tokens"] for s in rows) if has_tokens else None, "shards": rows,
    }
    write_metrics(out, f"{folder}/{base}_manifest.json", spark)
    return out


def write_toy(df: DataFrame, path: str, key: str, c: Config = DEFAULT) -> None:
    write_jsonl(tokenised_records(sample(df, c.toy_docs, key, c.seed)), path)


def bar_chart(df: DataFrame, label: str, count: str, path: str, top: int = 30, title: str = "") -> bool:
    """A bar chart (PNG) of the ``top`` rows of most; with labels where a plotting library is installed, which is returned."""
    rows = df.orderBy(F.desc(count), label).limit(top).collect()
    return _chart([str(r[label]) for r in rows], [r[count] for r in rows], path, title)


def histogram_chart(df: DataFrame, path: str, bins: int = 80, title: str = "") -> bool:
    """The chart of a ``metrics.histogram``, empty bins included; there are ``bins`` bars."""
    rows = {r["bin"]: r for r in df.where(F.col("bin") <= bins).collect()}
    lower = {b: str(r["lower"]) for b, r in rows.items()}
    return _chart([lower.get(b, "") for b in range(1, bins + 1)], [rows[b]["count"] if b in rows else 0 for b in range(1, bins + 1)], path, title)


def _chart(labels: list[str], counts: list[int], path: str, title: str) -> bool:
    try:
        import matplotlib.pyplot as plt
    except ImportError:
        with open(path, "wb") as f:
            f.write(png_bars(counts))
        return False
    fig, ax = plt.subplots()
    ax.bar(range(len(counts)), counts, tick_label=labels)
    ax.set_title(title)
    fig.autofmt_xdate()
    fig.savefig(path)
    plt.close(fig)
    return True


def png_bars(counts: list[int], width: int = 640, height: int = 360) -> bytes:
    """Grey-scale bars over a base line as a PNG file, without labels."""
    img = np.full((height, width), 255, dtype=np.uint8)
    img[height - 11 : height - 10, 10 : width - 10] = 0
    step = (width - 20) / max(1, len(counts))
    for i, n in enumerate(counts):
        tall = round((height - 30) * n / max(1, *counts))
        a = 10 + int(i * step)
        img[height - 11 - tall : height - 11, a : max(a + 1, 10 + int((i + 1) * step) - 1)] = 90
    raw = np.concatenate([np.zeros((height, 1), np.uint8), img], axis=1).tobytes()
    chunk = lambda kind, body: len(body).to_bytes(4, "big") + kind + body + zlib.crc32(kind + body).to_bytes(4, "big")
    head = width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([8, 0, 0, 0, 0])
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
