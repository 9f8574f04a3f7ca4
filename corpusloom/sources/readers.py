"""Sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.checks import require

RAW = T.StructType([T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def jsonl(spark: SparkSession, path: str, schema: T.StructType = RAW, compression: str | None = None) -> DataFrame:
    """JSON lines under a given schema; a missing path fails while the plan is made."""
    reader = spark.read.schema(schema)
    return (reader.option("compression", compression) if compression else reader).json(path)


def jsonl_typed(spark: SparkSession, path: str, **more: str) -> DataFrame:
    """``url, text, text_kind`` and further fields by name and type: the kind of the raw value (STRING, BIGINT, VOID for null, null where the key is absent or
    the line is no JSON), so that numbers can be told from texts."""
    v = F.try_parse_json("value")
    rows = spark.read.text(path).select(v.alias("v"))
    get = lambda k, t: F.expr(f"try_variant_get(v, '$.{k}', '{t}')")
    return rows.select(*[get(k, t).alias(k) for k, t in more.items()], get("url", "string").alias("url"), get("text", "string").alias("text"), F.expr("regexp_extract(schema_of_variant(variant_get(v, '$.text')), '^[A-Z]+', 0)").alias("text_kind"))


def parquet(spark: SparkSession, path: str, *required: str) -> DataFrame:
    """A Parquet table, checked for the columns that are needed."""
    return require(spark.read.parquet(path), *required)


def optional_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty one of the schema where there is none."""
    if exists(spark, path):
        return spark.read.parquet(path)
    return spark.createDataFrame([], schema)


def head_lines(spark: SparkSession, path: str, n: int = 3) -> DataFrame:
    return spark.read.text(path).limit(n)
