"""A table whose changes rewrite only the files that hold changed rows.

The table is a folder of Parquet files and a manifest that says which of them count.  A change finds the
files with affected rows by ``_metadata.file_path`` (a scan of the condition's columns alone, which
row group statistics prune), reads and rewrites only these, and commits a manifest of the untouched
and the new files.  Until then nobody reads the new files; the old ones stay for readers of
earlier versions.  File names, rows and key bounds of a file are all that reaches the driver."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ..sources.versions import Manifest, read_files
from .changes import newest

ENTRY = "name string, n long, low string, high string"


@dataclass
class Change:
    """What a change did: the version it made, files rewritten and added, rows affected."""

    version: int
    rewritten: int
    added: int
    rows: int


class FileTable:
    """``cluster_by`` orders rows over files, so that a range of these columns lies in few of them; the first of
    them has its bounds in the manifest."""

    def __init__(self, spark: SparkSession, folder: str, schema, cluster_by: list[str]):
        self.spark, self.folder, self.schema, self.cluster_by = spark, folder.rstrip("/"), schema, cluster_by
        self.manifest = Manifest(spark, self.folder, ENTRY)

    @classmethod
    def create(cls, df: DataFrame, folder: str, cluster_by: list[str], files: int = 16) -> FileTable:
        table = cls(df.sparkSession, folder, df.schema, cluster_by)
        ordered = df.repartitionByRange(files, *cluster_by).sortWithinPartitions(*cluster_by)
        table.manifest.commit(0, table._write(ordered))
        return table

    def _write(self, df: DataFrame) -> list[tuple]:
        """Writes new files and says what they hold."""
        path = f"{self.folder}/data-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        written = self.spark.read.schema(self.schema).parquet(path)
        key = F.col(self.cluster_by[0])
        each = written.groupBy(F.col("_metadata.file_path").alias("name")).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).cast("string").alias("low"), F.max(key).cast("string").alias("high")
        )
        return [tuple(r) for r in each.collect()]

    def files(self, version: int | None = None) -> list[Row]:
        return self.manifest.rows(version)[1]

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the newest version, or of an earlier one."""
        return read_files(self.spark, self.schema, [e["name"] for e in self.files(version)])

    def _with_file(self, entries: list[Row]) -> DataFrame:
        df = read_files(self.spark, self.schema, [e["name"] for e in entries])
        return df.withColumn("_file", F.col("_metadata.file_path")) if entries else df.withColumn("_file", F.lit(None).cast("string"))

    def _rewrite(self, version: int, entries: list[Row], touched: list[Row], changed: DataFrame | None, new: DataFrame | None) -> tuple[int, int, int]:
        """Commits ``changed`` in place of the touched files, and ``new`` besides."""
        names = {r["_file"] for r in touched}
        stay = [tuple(e) for e in entries if e["name"] not in names]
        made = []
        if changed is not None and names:
            ordered = changed.repartitionByRange(len(names), *self.cluster_by).sortWithinPartitions(*self.cluster_by)
            made += self._write(ordered.select(self.schema.names))
        added = []
        if new is not None:
            added = self._write(new.select(self.schema.names).sortWithinPartitions(*self.cluster_by))
        number = self.manifest.commit(version, [*stay, *made, *added])
        return number, len(names), len(added)

    def _touched(self, entries: list[Row], hit: DataFrame) -> list[Row]:
        """The files that hold rows of ``hit``, and how many each."""
        return hit.groupBy("_file").agg(F.count(F.lit(1)).alias("n")).collect()

    def _only(self, entries: list[Row], touched: list[Row]) -> DataFrame:
        names = {r["_file"] for r in touched}
        return read_files(self.spark, self.schema, [e["name"] for e in entries if e["name"] in names])

    def update(self, which: Column, values: dict[str, object]) -> Change:
        """Sets ``values`` (None: left as it is) where the condition is true."""
        version, entries = self.manifest.rows()
        types = dict(self._only(entries, []).dtypes)
        given = {k: v for k, v in values.items() if v is not None}
        touched = self._touched(entries, self._with_file(entries).filter(which)) if given else []
        rows = sum(r["n"] for r in touched)
        if not rows:
            return Change(version, 0, 0, 0)
        hit = F.coalesce(which, F.lit(False))
        new = {k: F.when(hit, (v if isinstance(v, Column) else F.lit(v)).cast(types[k])).otherwise(F.col(k)) for k, v in given.items()}
        number, files, added = self._rewrite(version, entries, touched, self._only(entries, touched).withColumns(new), None)
        return Change(number, files, added, rows)

    def delete(self, which: Column) -> Change:
        """Deletes where the condition is true; files that hold nothing else go without being read again."""
        version, entries = self.manifest.rows()
        touched = self._touched(entries, self._with_file(entries).filter(which))
        rows = sum(r["n"] for r in touched)
        if not rows:
            return Change(version, 0, 0, 0)
        whole = {e["name"]: e["n"] for e in entries}
        partly = [r for r in touched if r["n"] < whole[r["_file"]]]
        left = [e for e in entries if e["name"] not in {r["_file"] for r in touched} or e["name"] in {r["_file"] for r in partly}]
        kept = self._only(entries, partly).filter(~F.coalesce(which, F.lit(False))) if partly else None
        number, _, _ = self._rewrite(version, left, partly, kept, None)
        return Change(number, len(partly), 0, rows)

    def upsert(self, new: DataFrame, keys: list[str], columns: list[str], order: list[Column]) -> Change:
        """ON CONFLICT (keys) DO UPDATE: ``new`` holds keys and columns; of new rows with one key the first in
        ``order`` counts; NULL keys never conflict.  Columns it lacks are NULL in inserted rows."""
        version, entries = self.manifest.rows()
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        given = newest(new.filter(known), keys, order).unionByName(new.filter(~known))
        path = f"{self.folder}/given-{uuid.uuid4().hex[:12]}"  # read by each step below, and made once
        given.write.parquet(path)
        given = self.spark.read.schema(given.schema).parquet(path)
        renamed = given.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
        on = F.lit(True)
        for k in keys:
            on = on & (F.col(k) == F.col(f"_key_{k}"))
        low, high = given.agg(F.min(keys[0]), F.max(keys[0])).first()
        near = self._with_file(entries).filter(F.col(keys[0]).between(F.lit(low), F.lit(high)))  # prunes the scan
        touched = self._touched(entries, near.select(*keys, "_file").join(renamed.select(*[f"_key_{k}" for k in keys]), on, "left_semi"))
        changed = self._only(entries, touched).join(renamed, on, "left")
        changed = changed.withColumns({c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns})
        absent = given.join(near.select(*keys).distinct(), keys, "left_anti")
        types = dict(self._only(entries, []).dtypes)
        absent = absent.select(*keys, *columns, *[F.lit(None).cast(t).alias(c) for c, t in types.items() if c not in (*keys, *columns)])
        rows = sum(r["n"] for r in touched)
        inserted = None if absent.isEmpty() else absent
        number, files, added = self._rewrite(version, entries, touched, changed, inserted)
        return Change(number, files, added, rows)
