"""Helpers that several operators share: table access, staging and folders."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Where it is unset a local session gets a temporary one;
    on a cluster, whose executors would not see that, it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="hammerline-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def staged_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/hammerline-{name}-{uuid.uuid4().hex[:12]}"
    log = _staged.get()
    if log is not None:
        log.append(path)
    return path


def stage(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later plans start from
    files that survive the loss of any executor."""
    path = staged_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths staged inside, so that who has written out the result can ``discard`` them."""
    token = _staged.set([])
    try:
        yield _staged.get()
    finally:
        _staged.reset(token)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Leaves nothing but an empty file of what was staged."""
    for path in paths:
        spark.createDataFrame([], "nothing int").coalesce(1).write.mode("overwrite").parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def crc32_mod(doc_id: Column, mod: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % mod
