"""Session defaults and the shared folder in which intermediate tables are cut.

Intermediate results that are read more than once, or whose lineage must end, are written as Parquet
under the folder the cluster names in ``spark.checkpoint.dir``; all executors share it, so a lost
executor costs nothing but the tasks it was running. Only where that setting is absent (tests, a laptop)
a local folder is chosen.
"""

from __future__ import annotations

import atexit
import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULT: list[str] = []
_WRITTEN: list[tuple[SparkSession, str]] = []


def build_session(app: str = "pagelathe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is written for; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a local one is made only where it is unset and executors are threads of this machine's driver."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share; a folder of one machine would lose rows")
    if not _LOCAL_DEFAULT:
        _LOCAL_DEFAULT.append("file://" + tempfile.mkdtemp(prefix="pagelathe-"))
    return _LOCAL_DEFAULT[0]


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, removed when the Python process ends or the ``temporary`` block around it does."""
    path = f"{shared_dir(spark)}/pagelathe/{os.getpid()}/{label}-{uuid.uuid4().hex[:12]}"
    _WRITTEN.append((spark, path))
    return path


@contextmanager
def temporary() -> Iterator[None]:
    """Removes at its end all intermediate tables written within it. Results must be consumed (written, collected) before."""
    before = len(_WRITTEN)
    try:
        yield
    finally:
        written = _WRITTEN[before:]
        del _WRITTEN[before:]
        _remove(written)


def cut(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: one computation, no lineage."""
    spark = df.sparkSession
    path = new_path(spark, label)
    writer = df.write.mode("error").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(written: list[tuple[SparkSession, str]]) -> None:
    for spark, path in written:
        try:
            jvm = spark._jvm  # noqa: SLF001
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)  # noqa: SLF001
        except Exception:  # the session may be gone; the folder is temporary anyway
            continue


@atexit.register
def _remove_written() -> None:
    _remove(_WRITTEN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the project's tables, by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
