"""What the operators of this package share: working files, skew-safe lookups, text rules."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayload.workspace import new_area

#: White space of the text rules: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"
#: At most this many keys hold one part in this many of all rows.
HEAVY_PARTS = 1000
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Files:
    """Working tables of one run, below the shared folder.

    Writing a table cuts the lineage: a lost executor costs the running step
    only. Shuffle files are dropped once the table is written.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, new_area(spark, label)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        with shuffles_dropped(self.spark):
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        context = self.spark.sparkContext
        for name in names:
            path = context._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def partition_bytes(spark: SparkSession) -> int:
    """Bytes a task should read, as the session has them for files."""
    text = str(spark.conf.get("spark.sql.files.maxPartitionBytes")).lower().rstrip("b")
    unit = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text.rstrip("kmgt")) << unit


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def heavy_limit(rows: int) -> int:
    """Keys with more rows than this are at most ``HEAVY_PARTS``."""
    return max(2, rows // HEAVY_PARTS)


def look_up(rows: DataFrame, answers: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` to one answer per key, where a key may have any share of the rows.

    ``size`` is the answer's column with its key's number of rows and ``total``
    the sum of all. Keys above ``heavy_limit`` are at most ``HEAVY_PARTS`` by
    arithmetic, so their answers are broadcast; every other key brings few
    rows to a task. Rows without a key get nulls.
    """
    limit = heavy_limit(total)
    heavy = answers.where(F.col(size) > limit)
    light = answers.where(F.col(size) <= limit)
    marks = heavy.select(key, F.lit(True).alias("_heavy"))
    marked = rows.join(F.broadcast(marks), key, "left")
    hot = marked.where("_heavy").drop("_heavy").join(F.broadcast(heavy), key, "left")
    rest = marked.where("_heavy IS NULL").drop("_heavy").join(light, key, "left")
    return hot.unionByName(rest)


def crc(column: Column) -> Column:
    """CRC-32 of a value's text in UTF-8; of null as of the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns, whatever else the table has; a missing one is an error."""
    return df.select(*[df[c] for c in columns])


def give_back_memory() -> None:
    """At the end of a task: a worker that waits for the next one should not hold what this one has freed."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_batches(
    make: Callable[[pa.Table], Iterator[pa.Table]], most_bytes: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Call ``make`` with tables of about ``most_bytes``, for ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            step = max(1, int(batch.num_rows * most_bytes / max(batch.nbytes, 1)))
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                held.append(part)
                size += part.nbytes
                if size >= most_bytes:
                    for out in make(pa.Table.from_batches(held)):
                        yield from out.to_batches()
                    held, size = [], 0
        if held:
            for out in make(pa.Table.from_batches(held)):
                yield from out.to_batches()
        del held
        give_back_memory()

    return run
