"""Versions of a set of tables: readers see all tables of a version, or none of them.

Rows are only ever written to new folders. What makes a folder part of a table is the manifest, a small
table of (version, table, folders); the entries of a version are one file, which Spark's writer moves into
place whole. So all tables change at the same moment, a job that dies half way leaves folders that
nobody reads, and a table may be overwritten while it is read. A table may have several folders: rows that
were appended have their own.

Any store that Spark writes to will do, as nothing is renamed or locked by hand. There is one writer at a
time: a writer that started from a version that is no longer the latest is refused, but two that
publish in the same instant are not told apart.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version bigint, table string, folders array<string>, removed bigint"


class Conflict(RuntimeError):
    """Another writer has published since this one started."""


class VersionGone(LookupError):
    """The version was removed, or never existed."""


@dataclass(frozen=True)
class Versions:
    spark: SparkSession
    folder: str

    @property
    def root(self) -> str:
        return self.folder.rstrip("/")

    def _manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/versions")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST)

    def _append(self, rows: Sequence[tuple]) -> None:
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.root}/versions")

    def latest(self) -> int:
        """The number of the newest version, 0 before the first."""
        return self._manifest().agg(F.max("version")).first()[0] or 0

    def removed(self) -> int:
        """Versions up to this one are gone."""
        return self._manifest().agg(F.max("removed")).first()[0] or 0

    def entries(self, version: int | None = None) -> dict[str, list[str]]:
        """Every table's folders, by name, in one version; the latest by default.

        A version lists all tables, so each table's newest row is that of the newest version.
        """
        manifest = self._manifest()
        if version is not None:
            manifest = manifest.filter((F.col("version") == version) | F.col("table").isNull())
        newest = F.max_by("folders", "version").alias("folders")
        rows = manifest.groupBy("table").agg(newest, F.max("removed").alias("removed")).collect()
        removed = max((r["removed"] or 0 for r in rows), default=0)
        found = {r["table"]: list(r["folders"]) for r in rows if r["table"] is not None}
        if version is not None and (not found or version <= removed):
            raise VersionGone(f"version {version} is not kept")
        return found

    def folders(self, version: int | None = None) -> dict[str, list[str]]:
        """Every table's folders, as paths."""
        return {table: [self.path(name) for name in names] for table, names in self.entries(version).items()}

    def write(self, table: str, df: DataFrame, keys: Sequence[str] = ()) -> str:
        """Store rows in a new folder that no version has yet; its name.

        The columns ``keys`` get Bloom filters, of a size that fits their values, in every row group.
        """
        name, writer = f"{table}/{uuid.uuid4().hex}", df.write
        for key in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
        writer.option("parquet.bloom.filter.adaptive.enabled", "true").parquet(self.path(name))
        return name

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def publish(self, base: int, replaced: Mapping[str, Sequence[str]], added: Mapping[str, Sequence[str]] | None = None) -> int:
        """A new version on top of ``base``, which must be the latest; its number.

        ``replaced`` gives tables new folders, ``added`` gives them further ones; others stay.
        """
        if self.latest() != base:
            raise Conflict(f"version {base} is no longer the latest")
        entries = self.entries() if base else {}
        entries |= {table: list(names) for table, names in replaced.items()}
        for table, names in (added or {}).items():
            entries[table] = [*entries.get(table, []), *names]
        self._append([(base + 1, table, names, None) for table, names in sorted(entries.items())])
        return base + 1

    def keep(self, count: int) -> list[str]:
        """Remove all versions but the latest ``count``, and the folders that no other version has.

        They are declared gone first, so nobody finds half of a version. Folders of jobs that died go
        as well, so none may be running. The names of the folders that went.
        """
        if count < 1:
            raise ValueError("the latest version must stay")
        gone = max(self.latest() - count, self.removed())
        self._append([(None, None, None, gone)])
        kept = self._manifest().filter(F.col("version") > gone).select(F.explode("folders")).distinct()
        used = {r[0] for r in kept.collect()}
        names = [name for name in self._stored() if name not in used]
        for name in names:
            files, path = self._file_system(name)
            files.delete(path, True)
        return names

    def _file_system(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _stored(self) -> list[str]:
        """All folders with rows: those of any version, and those below the same tables."""
        tables = self._manifest().filter("table IS NOT NULL").select("table").distinct().collect()
        found = []
        for (table,) in tables:
            files, path = self._file_system(table)
            if files.exists(path):
                found += [f"{table}/{status.getPath().getName()}" for status in files.listStatus(path)]
        return found
