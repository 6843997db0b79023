"""What the training-data operators share: folders for checkpoints, Arrow batches, word splitting, null rules.

Operators take a DataFrame and the names of its id and text columns, ignore every other column
(so an extra column may have any name) and return the id with their own outputs.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.shipping import ship

#: White space of the word contracts: space, tab, LF, VT, FF, CR. Fixed values.
SPACE = " \t\n\x0b\x0c\r"
#: Text bytes that one Python sub-batch holds at most, unless one text alone has more.
SUB_BATCH = 2 << 20
#: Rows of the table that tells which ids may be wanted, at most; each has 64 bits.
BIT_WORDS = 1 << 19


def tune(spark: SparkSession) -> None:
    """Small Arrow batches (texts may be long, and a batch lies in a worker's memory as a whole) and this package on the executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    ship(spark)


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which all executors see; one of the session's own only where that is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{root.rstrip('/')}/ledgerline-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str = "t", folder: str | None = None, **options: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: cuts the lineage, and a lost executor loses nothing of it.

    Spark drops the shuffle files of a finished step when the driver's JVM collects its garbage, so that is asked for.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/{name}"
    df.write.options(**options).parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete what was settled in `folder` and is read no more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def parted(docs: DataFrame, wanted: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows of `docs` whose id is surely not among those of `wanted`, rows whose id may be), so that no others have to be shuffled to meet `wanted`.

    Each wanted id sets a bit, chosen by its hash, in a table of BIT_WORDS rows at most, which is broadcast whatever the number of ids. Both have `id_col`, integers.
    """
    bit = F.pmod(F.xxhash64(F.col(id_col).cast("bigint")), F.lit(64 * BIT_WORDS))
    ones = wanted.select(bit.alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    ones = settle(ones, "wanted")
    marked = docs.select(F.struct("*").alias("row"), bit.alias("bit")).join(F.broadcast(ones), F.expr("word = bit div 64"), "left")
    may = F.expr("coalesce(getbit(bits, cast(bit % 64 as int)), 0) = 1")
    return marked.where(~may).select("row.*"), marked.where(may).select("row.*")


def without(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """The rows of `docs` but for those with an id of `gone`. Rows that surely stay are not shuffled."""
    stay, may_go = parted(docs, gone, id_col)
    return stay.union(may_go.join(gone, id_col, "left_anti").select(*docs.columns))


_HELD: dict[Hashable, Any] = {}


def held(key: Hashable, make: Callable[[], Any]) -> Any:
    """The one large object that a worker keeps between batches and tasks of an operator; another key evicts it."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = make()
    return _HELD[key]


def give_back() -> None:
    """Let go of garbage, and give the memory that nothing uses back to the system."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def lean(keep: Hashable = None) -> None:
    """At the start of a task in a worker that is used again: let go of what another operator's tasks held and left.

    Arrow's memory comes from the system's allocator from then on, which gives large buffers back at once.
    """
    if any(key != keep for key in _HELD):
        _HELD.clear()
    pa.set_memory_pool(pa.system_memory_pool())
    give_back()


def sub_batches(it: Iterator[pa.RecordBatch], column: str = "text", most: int = SUB_BATCH, keep: Hashable = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `most` bytes of `column`. For workers, at a task's start: see `lean`."""
    lean(keep)
    for batch in it:
        n, at, size = batch.num_rows, 0, 0
        for i, x in enumerate(batch.column(column)):
            size += 0 if (b := x.as_buffer()) is None else b.size
            if size >= most:
                yield batch.slice(at, i + 1 - at)
                at, size = i + 1, 0
        if at < n:
            yield batch.slice(at)
