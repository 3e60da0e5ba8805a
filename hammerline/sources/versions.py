"""Versioned folders: what a table consists of is a small table itself, written last.

A writer adds files nobody reads yet and then one new version of the manifest, which a job commits by
a rename; readers take the newest version that is complete, so they see the state before or after a
change and nothing between.  A version can be written once: of two writers that started from the
same state the second fails.  That holds for the threads of a driver; of several drivers one at a time is assumed to
write a table, as the check for an existing version and the write are two steps."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession


#: Commits of one driver's threads take turns, so that exactly one of them makes a version.
_turns = threading.Lock()


class Conflict(RuntimeError):
    """Another writer has changed the table since it was read."""


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="hammerline-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/hammerline-{name}-{uuid.uuid4().hex[:12]}"


class Manifest:
    """The versions of ``folder``; each holds rows of ``schema`` (a DDL string)."""

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, schema
        self.path = f"{folder}/manifest"

    def rows(self, version: int | None = None) -> tuple[int, list[Row]]:
        """The newest version, or a stated one: its number and its rows.  Version 0 is empty.
        A manifest names files or segments, not data, and comes to the driver as a file index does."""
        try:
            known = self.spark.read.schema(f"{self.schema}, version long").json(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, []
        if version is None:
            version = known.agg({"version": "max"}).first()[0] or 0
        return version, known.filter(known["version"] == version).drop("version").filter("name IS NOT NULL").collect()

    def commit(self, version: int, rows: list[tuple]) -> int:
        """Writes the version after ``version``, from which the writer started."""
        names = [c.strip().split(" ")[0] for c in self.schema.split(",")]
        data = self.spark.createDataFrame(rows or [(None,) * len(names)], self.schema)
        try:
            with _turns:
                data.coalesce(1).write.mode("error").option("ignoreNullFields", "false").json(f"{self.path}/version={version + 1}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
            raise Conflict(f"{self.folder} has a version {version + 1} already") from error
        return version + 1


def read_files(spark: SparkSession, schema, files: list[str]) -> DataFrame:
    """A table of just these files."""
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
