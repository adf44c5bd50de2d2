"""Tables of mergeable aggregates that grow batch by batch and stay few folders.

Each micro-batch is reduced to partial aggregates and written to a folder of its own number, so a batch that
is repeated replaces itself. When ``keep`` folders of a level are there they are merged into one of the
next level, which is whole before the ones it replaces are deleted. After n batches there are at most
``keep`` folders a level and about log n levels, and each row has been rewritten about log n times.
Rows may be as late as they like: nothing is closed, reading merges what there is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.sources.tables import evened

_PART = re.compile(r"part-(\d+)-(\d+)-(\d+)$")
Part = tuple[int, int, int]     # level, first and last batch


@dataclass(frozen=True)
class MergedTable:
    """``merge`` turns partial rows of a key, from any number of folders, into one; it must not
    matter how often and in which order it is applied. ``schema`` is that of partial rows."""

    spark: SparkSession
    path: str
    schema: StructType
    merge: Callable[[DataFrame], DataFrame]
    partition_by: Sequence[str] = ()
    keep: int = 8

    def _file_system(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _folder(self, part: Part) -> str:
        return f"{self.path}/part-{part[0]}-{part[1]}-{part[2]}"

    def _written(self) -> list[Part]:
        """Whole folders; a handful of names, whatever the number of batches."""
        fs, path = self._file_system()
        if not fs.exists(path):
            return []
        names = [str(s.getPath().getName()) for s in fs.listStatus(path)]
        found = [tuple(map(int, m.groups())) for m in map(_PART.match, names) if m]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p for p in found if fs.exists(done(f"{self._folder(p)}/_SUCCESS")))

    def parts(self) -> list[Part]:
        """The folders that count: those that no other one covers."""
        written = self._written()
        return [p for p in written if not any(q[0] > p[0] and q[1] <= p[1] and p[2] <= q[2] for q in written)]

    def _write(self, df: DataFrame, part: Part) -> None:
        placed = evened(df, self.partition_by) if self.partition_by else df
        writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "static")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(self._folder(part))

    def _read(self, parts: Sequence[Part]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        frames = [self.spark.read.schema(self.schema).parquet(self._folder(p)).select(*self.schema.names) for p in parts]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionByName(frame)
        return out

    def read(self) -> DataFrame:
        """One row per key."""
        return self.merge(self._read(self.parts()))

    def partial(self) -> DataFrame:
        """Rows as they are stored, to be filtered before they are merged."""
        return self._read(self.parts())

    def store(self, partial: DataFrame, batch: int) -> None:
        """Take in a batch, once: one that a merged folder holds already is left as it is."""
        if not any(level > 0 and first <= batch <= last for level, first, last in self._written()):
            self._write(partial.select(*self.schema.names), (0, batch, batch))
        self.compact()

    def compact(self) -> None:
        fs, _ = self._file_system()
        counted, level = self.parts(), 0
        while level <= max((p[0] for p in counted), default=-1):
            same = [p for p in counted if p[0] == level]
            if len(same) >= self.keep:
                into = (level + 1, min(p[1] for p in same), max(p[2] for p in same))
                self._write(self.merge(self._read(same)), into)
                counted = self.parts()
            level += 1
        for part in set(self._written()) - set(counted):
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(self._folder(part)), True)

    def follow(self, stream: DataFrame, reduce: Callable[[DataFrame], DataFrame], checkpoint: str,
               after: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
        """Take in what the source has, batch by batch, then stop. ``after`` gets each batch when it is stored."""
        def step(batch: DataFrame, number: int) -> None:
            self.store(reduce(batch), number)
            if after is not None:
                after(batch)

        return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
