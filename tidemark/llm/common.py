"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_folder

# white space of the contracts: space and U+0009 to U+000D
BLANK = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the session's shared folder and return it as a scan.

    What several jobs read is computed once and outlives lost executors. Packed tightly, as
    these tables hold texts and live as long as their folder does.
    """
    folder = fresh_folder(df.sparkSession, label)
    if (owner := _OWNER.get()) is not None:
        owner.folders.append(folder)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Scratch:
    """The tables that a chain of stages writes for itself, deleted when nothing needs them any more.

    Only folders written inside ``stage`` belong to it. Frames of any other call keep theirs.
    """

    def __init__(self):
        self.folders: list[str] = []
        self.inputs: set[str] = set()       # files that the stage before read

    @contextmanager
    def stage(self, docs: DataFrame) -> Iterator[None]:
        """Before the body, delete what earlier stages left, if ``docs`` lies in other files than those tables
        and than the input of the stage before: then that stage's result has been written and read again."""
        files = set(docs.inputFiles())
        own = any(f.rsplit("/", 1)[-1] in file for f in self.folders for file in files)
        if files and not own and not files & self.inputs:
            self.release(docs.sparkSession)
        self.inputs = files
        token = _OWNER.set(self)
        try:
            yield
        finally:
            _OWNER.reset(token)

    def release(self, spark: SparkSession) -> None:
        for folder in self.folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self.folders.clear()


_OWNER: ContextVar[Scratch | None] = ContextVar("scratch", default=None)


def numbered(docs: DataFrame, label: str) -> DataFrame:
    """Columns ``row`` (unique) and ``doc`` (all columns of ``docs`` as a struct), written once.

    The number is made while writing, so every later read sees the same one, also
    after a lost executor. The struct keeps the caller's column names apart from ours.
    """
    packed = docs.select(F.monotonically_increasing_id().alias("row"),
                         F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("doc"))
    return materialise(packed, label)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole(text: Column | str) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def word_count(text: Column | str) -> Column:
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def sha256_text(c: Column) -> Column:
    return F.sha2(c, 256)


def held_out(doc_id: Column | str) -> Column:
    """Every fifth document by the CRC of its id: never learnt from. Null ids hash as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % 5 == 0
