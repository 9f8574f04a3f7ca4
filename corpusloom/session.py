"""Session helpers shared by all operators: reading tables, durable intermediate results, shipping the package."""

from __future__ import annotations

import atexit
import contextlib
import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[tuple[str, str]] = set()
#: Paths of the intermediate tables that exist, oldest first.
_OPEN: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` as the cluster names it.

    Only where it is unset and all executors run on this machine, as in tests, is a temporary folder taken (and set);
    on any other master a folder of one machine would lose rows, so that is an error.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {spark.sparkContext.master} share")
        conf = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", conf)
    return conf.rstrip("/")


def durable(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and survives the loss of executors.

    Without a shuffle, ``partition_by`` parts the files by a column of few values. The table goes with ``release``, at the end of a ``scratch`` block, or when the driver ends, whichever is first.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._corpusloom_path = path
    if not _OPEN:
        atexit.register(release_all, spark)
    _OPEN.append(path)
    return out


def release(*frames: DataFrame) -> None:
    """Delete tables of ``durable`` that no later step reads; other frames are passed over."""
    for df in frames:
        if (path := getattr(df, "_corpusloom_path", None)) in _OPEN:
            _OPEN.remove(path)
            _remove(df.sparkSession, path)


def release_all(spark: SparkSession, since: int = 0) -> None:
    while len(_OPEN) > since:
        _remove(spark, _OPEN.pop())


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """A block whose intermediate tables are deleted when it ends: write or count results inside it."""
    since = len(_OPEN)
    try:
        yield
    finally:
        release_all(spark, since)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the JVM is gone: the cluster's own cleaning of its checkpoint folder remains
        pass


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that Arrow functions can import it there."""
    root = Path(__file__).resolve().parent
    app = spark.sparkContext.applicationId
    if (app, str(root)) in _SHIPPED:
        return
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.writestr(zipfile.ZipInfo(str(p.relative_to(root.parent))), p.read_text())
    body = data.getvalue()
    # on the driver only: Spark serves the file to the executors
    path = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), f"corpusloom_{hashlib.sha256(body).hexdigest()[:12]}.zip")
    Path(path).write_bytes(body)
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add((app, str(root)))
