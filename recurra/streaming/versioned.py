"""A partitioned table whose partitions are replaced without a moment of loss.

New partitions go to a folder of their own, ``version=<v>/<column>=<value>``.
Then a pointer is written: one row per partition with the version that holds
it, and a mark of the writer's. Readers take the last pointer whose write ended
(its folder has a marker file, set after the write; a committer's ``_SUCCESS``
counts too, but is not relied on) and read exactly the folders that it names. So a crash at any step leaves the table as the last pointer describes
it, a rerun writes a new version, and running readers keep their files: only
what neither the last two pointers name is removed.

One writer at a time. A pointer has as many rows as the table has partitions
(buckets or months), the only data on the driver.
"""

from __future__ import annotations

from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from recurra.sources.sinks import PACKED, shuffles_removed

ENDED = "_ENDED"


class Pointer(NamedTuple):
    seq: int
    versions: dict[str, str]      # partition folder -> version
    mark: int | None


class VersionedTable:
    def __init__(self, spark: SparkSession, data: str, pointers: str, column: str):
        self.spark, self.data, self.pointers, self.column = spark, data, pointers, column

    # ---------------------------------------------------------------- folders

    def _folder(self, path: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _names(self, path: str, prefix: str) -> list[str]:
        fs, where = self._folder(path)
        if not fs.exists(where):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return [n for n in names if n.startswith(prefix)]

    def _remove(self, path: str) -> None:
        fs, where = self._folder(path)
        fs.delete(where, True)

    # ---------------------------------------------------------------- pointers

    def _ended(self) -> list[int]:
        """Numbers of the pointers whose write ended, in order."""
        out = []
        for name in self._names(self.pointers, "seq="):
            if any(fs.exists(done) for fs, done in (self._folder(f"{self.pointers}/{name}/{m}") for m in (ENDED, "_SUCCESS"))):
                out.append(int(name[4:]))
        return sorted(out)

    def _pointer(self, seq: int) -> Pointer:
        rows = self.spark.read.parquet(f"{self.pointers}/seq={seq}").collect()     # one row per partition
        return Pointer(seq, {r["part"]: r["version"] for r in rows if r["part"] is not None},
                       next(r["mark"] for r in rows if r["part"] is None))

    def pointer(self) -> Pointer:
        ended = self._ended()
        return self._pointer(ended[-1]) if ended else Pointer(-1, {}, None)

    def _publish(self, pointer: Pointer) -> None:
        rows = [(None, None, pointer.mark), *((p, v, None) for p, v in sorted(pointer.versions.items()))]
        (self.spark.createDataFrame(rows, "part string, version string, mark bigint").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.pointers}/seq={pointer.seq}"))
        fs, done = self._folder(f"{self.pointers}/seq={pointer.seq}/{ENDED}")
        fs.create(done, True).close()

    # ---------------------------------------------------------------- table

    def read(self, parts: list[str] | None = None) -> DataFrame | None:
        """The table, or only some partition folders of it; None where there is nothing to read."""
        held = self.pointer().versions
        paths = [f"{self.data}/version={v}/{p}" for p, v in sorted(held.items()) if parts is None or p in parts]
        if not paths:
            return None
        return self.spark.read.option("basePath", self.data).parquet(*paths).drop("version")

    def replace(self, rows: DataFrame, mark: int | None = None) -> None:
        """Replace the partitions that ``rows`` has rows in; the others stay."""
        old, version = self.pointer(), f"v{uuid4().hex}"
        with shuffles_removed(rows.sparkSession):
            rows.write.option("compression", PACKED).partitionBy(self.column).parquet(f"{self.data}/version={version}")
        made = self._names(f"{self.data}/version={version}", f"{self.column}=")
        new = Pointer(old.seq + 1, {**old.versions, **dict.fromkeys(made, version)}, mark)
        self._publish(new)
        self._clean(old, new)

    def _clean(self, *live: Pointer) -> None:
        named = {(v, p) for pointer in live for p, v in pointer.versions.items()}
        for folder in self._names(self.data, "version="):
            parts = self._names(f"{self.data}/{folder}", f"{self.column}=")
            dead = [p for p in parts if (folder[8:], p) not in named]
            if len(dead) == len(parts):
                self._remove(f"{self.data}/{folder}")
                continue
            for p in dead:
                self._remove(f"{self.data}/{folder}/{p}")
        for name in self._names(self.pointers, "seq="):
            if int(name[4:]) < min(p.seq for p in live):
                self._remove(f"{self.pointers}/{name}")
