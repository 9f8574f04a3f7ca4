"""Aggregates of the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators.checks import union_all
from corpusloom.session import durable, release


def value_counts(df: DataFrame, col: str, top: int | None = None, name: str = "count") -> DataFrame:
    """Values and how often they occur, most frequent first, ties by value; nulls are left out."""
    out = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), col)
    return out.limit(top) if top else out


def stage_counts(df: DataFrame) -> DataFrame:
    n, kept = F.count(F.lit(1)), F.count_if(F.col("drop_reason").isNull())
    return df.agg(n.alias("n_in"), kept.alias("n_kept"), (n - kept).alias("n_dropped"))


def quantiles(df: DataFrame, col: str, at: list[float]) -> list[float | None]:
    """Exact quantiles, interpolated between neighbouring ranks as is usual; nulls are left out, no value gives None.

    Equal values are counted first, their counts range-partitioned and written; the counts of whole partitions tell in
    which of them a rank lies, and only these are ranked. No task or driver holds the distinct values.
    """
    x = F.col(col).cast("double")
    counts = df.where(x.isNotNull()).groupBy(x.alias("x")).agg(F.count(F.lit(1)).alias("n"))
    mid = durable(counts.repartitionByRange("x").sortWithinPartitions("x").withColumn("p", F.spark_partition_id()))
    start, n = {}, 0
    for p, k in sorted(tuple(r) for r in mid.groupBy("p").agg(F.sum("n")).collect()):  # one row a partition
        start[p] = n
        n += k
    if not n:
        release(mid)
        return [None] * len(at)
    ranks = {r for q in at for r in (int(q * (n - 1)), min(n - 1, int(q * (n - 1)) + 1))}
    parts = {p: s for p, s in start.items() if any(s <= r < s2 for r in ranks for s2 in [min([v for v in start.values() if v > s], default=n)])}
    before = F.sum("n").over(Window.partitionBy("p").orderBy("x")) - F.col("n") + F.create_map(*[F.lit(v) for p in parts.items() for v in p])[F.col("p")]
    ranked = mid.where(F.col("p").isin(list(parts))).withColumn("first", before)
    rows = ranked.where(F.array_max(F.filter(F.array(*[F.lit(r) for r in sorted(ranks)]), lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n")))).isNotNull()).collect()  # two rows a quantile
    release(mid)
    value = {r: row["x"] for row in rows for r in ranks if row["first"] <= r < row["first"] + row["n"]}
    out = []
    for q in at:
        i, part = int(q * (n - 1)), q * (n - 1) - int(q * (n - 1))
        lo, hi = value[i], value[min(n - 1, i + 1)]
        out.append(lo + (hi - lo) * part)
    return out


def describe(df: DataFrame, col: str, accuracy: int | None = None) -> DataFrame:
    """count, mean, std (of a sample), min, quartiles and max; quartiles are exact and interpolated, or with ``accuracy``
    approximate, in one pass."""
    x = F.col(col).cast("double")
    r = lambda c: F.round(c, 6)
    names, at = ("p25", "p50", "p75"), [0.25, 0.5, 0.75]
    if accuracy:
        q = [F.percentile_approx(x, p, accuracy) for p in at]
    else:
        q = [F.max(F.lit(v).cast("double")) for v in quantiles(df, col, at)]
    out = df.agg(F.count(x).alias("count"), r(F.avg(x)).alias("mean"), r(F.stddev_samp(x)).alias("std"), r(F.min(x)).alias("min"), *[r(v).alias(n) for n, v in zip(names, q)], r(F.max(x)).alias("max"))
    return out.select("count", "mean", "std", "min", *names, "max")


def summary(df: DataFrame, cols: list[str], mean: bool = True, accuracy: int | None = None) -> DataFrame:
    """One row a column: min, max, (mean,) median. The median is exact, or with ``accuracy`` approximate in the same pass."""
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        median = F.percentile_approx(x, 0.5, accuracy) if accuracy else F.max(F.lit(quantiles(df, c, [0.5])[0]).cast("double"))
        parts.append(F.struct(F.lit(c).alias("metric"), F.round(F.min(x), 6).alias("min"), F.round(F.max(x), 6).alias("max"), *([F.round(F.avg(x), 6).alias("mean")] if mean else []), F.round(median, 6).alias("median")))
    return df.agg(F.array(*parts).alias("m")).select(F.inline("m"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins between the least and the greatest value, the last one closed; empty bins are left out.

    A constant column falls into one bin; nulls are left out; no value gives no row.
    """
    x = F.col(col).cast("double")
    lo, hi = df.agg(F.min(x), F.max(x)).first()  # two numbers
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin bigint, lower double, upper double, count bigint")
    width = (hi - lo) / bins
    b = F.least(F.width_bucket(x, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)) if width else F.lit(1)
    out = df.where(x.isNotNull()).groupBy(b.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return out.select("bin", F.round(F.lit(lo) + (F.col("bin") - 1) * width, 6).alias("lower"), F.round(F.lit(lo) + F.col("bin") * width, 6).alias("upper"), "count")


PII_COUNTS = ("pii_email_hits", "pii_phone_hits", "pii_cc_hits", "pii_iban_hits")


def pii_totals(df: DataFrame) -> DataFrame:
    return df.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in PII_COUNTS], F.count_if("has_pii").alias("rows_with_pii"))


def pii_aggregate(*dfs: DataFrame) -> DataFrame:
    """Totals over the union of several outputs, where rows in two of them count twice."""
    return pii_totals(union_all(*[d.select(*PII_COUNTS, "has_pii") for d in dfs]))


def low_info_counts(df: DataFrame, low_unique: float = 0.20, high_stopword: float = 0.95, min_tokens: int = 10) -> DataFrame:
    enough = F.col("token_count") >= min_tokens
    return df.agg(
        F.count_if(enough & (F.col("unique_token_ratio") < low_unique)).alias("low_unique"),
        F.count_if(enough & (F.col("stopword_ratio") > high_stopword)).alias("high_stopword"),
        F.count_if(F.col("drop_reason") == "repetitive_token_spam").alias("token_spam"),
    )


def share_report(df: DataFrame, reason: str, name: str) -> DataFrame:
    """Rows, rows dropped for a reason, rows that remain without any, and the dropped share in percent."""
    n, d = F.count(F.lit(1)), F.count_if(F.col("drop_reason") == reason)
    return df.agg(n.alias("n_rows"), d.alias(f"{name}_dropped"), F.count_if(F.col("drop_reason").isNull()).alias("remaining"), F.when(n > 0, F.round(d * 100.0 / n, 6)).otherwise(0.0).alias(f"{name}_pct"))


def structural_counters(df: DataFrame, text: str) -> DataFrame:
    """What the structural cleanup meets and changes, as sums over rows."""
    t = F.col(text)
    rows = df.select(
        t.isNotNull().alias("seen"),
        F.coalesce(t.contains("<") & t.contains(">"), F.lit(False)).alias("tags"),
        T.strip_html(t).alias("a"),
        t.alias("t"),
    )
    rows = rows.withColumn("lines", F.when(F.col("a").isNotNull() & (F.col("a") != ""), T.lines(F.regexp_replace("a", "(\\r\\n|[\\n\\r\\x0B\\x0C\\x1C-\\x1E\\x85\\u2028\\u2029])$", ""))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("gone", F.size(F.filter("lines", T.is_boilerplate))).withColumn("b", T.remove_boilerplate("a"))
    rows = rows.withColumn("c", T.collapse_repeats("b"))
    count = lambda cond, n: F.count_if(cond).alias(n)
    return rows.agg(
        F.count(F.lit(1)).alias("texts"), count(F.col("tags"), "had_tags"), count(F.col("a") != F.col("t"), "html_changed"),
        F.coalesce(F.sum(F.size("lines")), F.lit(0)).alias("lines_total"), F.coalesce(F.sum("gone"), F.lit(0)).alias("lines_removed"), count(F.col("gone") > 0, "docs_with_removals"),
        count(F.col("c") != F.col("b"), "repeats_changed"), count(F.col("c") != F.col("t"), "changed"),
    )
