"""Session, staging and sizing helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: The six separators of a word: space, tab, line feed, vertical tab, form feed, carriage return.
SEPARATORS = " \t\n\x0b\x0c\r"
#: Rows and bytes in one Arrow batch; documents are large, so the default of 10,000 rows would be.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20
#: A key that holds more than one in HOT of a table's rows is hot. There are HOT such keys at most.
HOT = 1000
#: A table is broadcast only if its written size is below this many bytes; read, it takes up to about eight times as much.
BROADCAST_BYTES = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Bounds the Arrow batches of Python stages, where the session leaves them at Spark's defaults, and ships the package."""
    ship(spark)
    for name, default, bound in (("maxRecordsPerBatch", "10000", BATCH_ROWS), ("maxBytesPerBatch", "67108864b", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if spark.conf.get(key) == default:
            spark.conf.set(key, str(bound))


class _Worker:
    """What a Python worker keeps between tasks: things of one operator, the last that ran."""

    owner: str | None = None
    things: dict = {}


def _give_back() -> None:
    """Returns freed memory to the machine, which Python's and Arrow's allocators otherwise keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def keep(name: str, make: Callable):
    """The worker's thing of this name; it stays until a task of another operator begins."""
    if name not in _Worker.things:
        _Worker.things[name] = make()
    return _Worker.things[name]


def task(owner: str, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """`run` for mapInArrow as a task of the operator `owner`: what others kept goes first, and at its end free memory."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _Worker.owner != owner:
            _Worker.owner = owner
            _Worker.things.clear()
            _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return start


def fresh(columns: list[str], *stems: str) -> list[str]:
    """Names for columns of our own beside the caller's: the stems, with as many underscores before them as it takes."""
    taken, out = {c.lower() for c in columns}, []
    for name in stems:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset in a local session."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = getattr(spark.sparkContext, "_newsloom_shared", None)
        if not found:
            if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
                raise RuntimeError("spark.checkpoint.dir is unset: executors of a cluster need a folder that all of them share")
            found = "file://" + tempfile.mkdtemp(prefix="newsloom-")
            spark.sparkContext._newsloom_shared = found
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/newsloom/{name}-{uuid.uuid4().hex}"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def written_bytes(spark: SparkSession, path: str) -> int:
    fs, at = _fs(spark, path)
    return int(fs.getContentSummary(at).getLength()) if fs.exists(at) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


class Staged:
    """A table in the shared folder: it cuts lineage and survives lost executors."""

    def __init__(self, df: DataFrame, name: str, by: tuple[str, ...] = ()):
        self.spark = df.sparkSession
        self.path = new_path(self.spark, name)
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(self.path)
        self.schema = df.schema

    @property
    def df(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)

    @property
    def bytes(self) -> int:
        return written_bytes(self.spark, self.path)

    @property
    def small(self) -> bool:
        return self.bytes <= BROADCAST_BYTES

    def side(self) -> DataFrame:
        """This table as a join's smaller side: broadcast if its size has been checked, else left to a shuffle."""
        return F.broadcast(self.df) if self.small else self.df

    def drop(self) -> None:
        delete(self.spark, self.path)


def with_unique(left: DataFrame, right: Staged, on: list[str], held: str, total: int, how: str = "inner", broadcast: bool = True) -> DataFrame:
    """Inner or left join of `left` with `right`, whose keys are unique and whose column `held` says how many rows of left have each.

    A small right side is broadcast, if it may be. Else hot keys (more than one in HOT of left's `total` rows) are broadcast, as
    there are HOT at most, and their rows are spread by their other columns, while the rest meet by key. So no key gathers
    more than that in one task.
    """
    if broadcast and right.small:
        return left.join(F.broadcast(right.df), on, how)
    values = [c for c in right.schema.names if c not in on]
    limit, held_by = max(1, total // HOT), F.col(held)
    hot = right.df.where(held_by > limit).select(*on, F.struct(*values).alias("_hot"))
    marked = left.join(F.broadcast(hot), on, "left")
    is_hot = F.col("_hot").isNotNull()
    # Rows of hot keys, which have no partner in what follows, differ in `_salt`; that of all others is 0.
    marked = marked.withColumn("_salt", F.when(is_hot, F.xxhash64(*left.columns)).otherwise(0))
    rest = right.df.where(held_by <= limit).select(*on, F.struct(*values).alias("_cool"), F.when(held_by < 0, 1).otherwise(0).cast("long").alias("_salt"))
    met = is_hot | F.col("_cool").isNotNull()
    out = marked.join(rest, [*on, "_salt"], "left")
    out = out.where(met) if how == "inner" else out
    return out.select(*left.columns, *(F.coalesce(F.col(f"_hot.{c}"), F.col(f"_cool.{c}")).alias(c) for c in values))


def release(spark: SparkSession) -> None:
    """Lets Spark clear the shuffle files of finished queries now, not when the driver next happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def plan_bytes(df: DataFrame) -> int:
    """Bytes of the files that df scans, by Catalyst's statistics; no job runs."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def parts_for(df: DataFrame, target: int, least: int = 1) -> int:
    """Partitions of about `target` bytes of input files; the session's number where Catalyst has no statistics."""
    n = plan_bytes(df)
    return max(least, -(-n // target) if n < 1 << 60 else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
