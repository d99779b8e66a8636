"""Queries with state: which sources are due, what a cache with a time to live answers, which keys come for the first time.

Time is that of the rows, never the clock's, so that a query gives the same when it runs again over the same batches. Watermarks say when
state may go: a timer of each group forgets what no row in time can meet. Rows of one group are decided in order of time within a
batch; of batches, the earlier one decides first, also where its rows are later. A group's rows of one batch (some 400 bytes each) are held
by one task, so `maxFilesPerTrigger` bounds the memory; its state is one number, or a cache of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from ..sources.writers import _fs

#: A source that was scanned stays fresh so long.
SOURCE_SECONDS = 7200
#: An entry of the cache is good so long.
ENTRY_SECONDS = 172_800
#: Entries of a cache at most; the oldest go.
ENTRIES = 500


_DUE = Row("source", "id", "at", "due")
_HIT = Row("source", "entry", "id", "at", "hit")

# Groups are many and small, so what a group costs decides: rows and no frames, a state of one value that is read and written once,
# and one timer, which is always that of the state as it is.


def _in_order(rows: Iterator[Row], what: str) -> list[tuple]:
    """Microseconds, id and `what` of each row by time and id, a missing id last."""
    return sorted(((r.at, r.id, r[what]) for r in rows), key=lambda x: (x[0], x[1] is None, x[1] or 0))


class _Freshness(StatefulProcessor):
    """A source: the time of its last good scan. The timer at which that scan is stale forgets it."""

    def __init__(self, ttl: int):
        self.ttl = ttl

    def init(self, handle) -> None:
        self.handle = handle
        self.scanned = handle.getValueState("scanned", "at long")

    def _keep(self, before: int | None, last: int | None) -> None:
        if before == last:
            return
        if before is not None:
            self.handle.deleteTimer(_due(before + self.ttl))
        if last is None:
            self.scanned.clear()
        else:
            self.scanned.update((last,))
            self.handle.registerTimer(_due(last + self.ttl))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.scanned.get()
        before = last = None if held is None else held[0]
        for at, id, ok in _in_order(rows, "ok"):
            stale = last is None or at - last >= self.ttl
            yield _DUE(key[0], id, at, stale)
            if stale:
                last = at if ok else None
        self._keep(before, last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.scanned.clear()
        return iter([])

    def close(self) -> None:
        pass


class _Cache(StatefulProcessor):
    """A source: its entries and when each was fetched. A timer at the oldest entry's end clears what is over."""

    def __init__(self, ttl: int, most: int):
        self.ttl, self.most = ttl, most

    def init(self, handle) -> None:
        self.handle = handle
        self.entries = handle.getValueState("entries", "entries array<string>, at array<long>")

    def _keep(self, before: dict[str, int], held: dict[str, int], fired: int | None = None) -> None:
        """Writes what is held; `fired` is the time of the timer that has just gone off, which goes by itself."""
        if before == held:
            return
        if held:
            self.entries.update((list(held), list(held.values())))
        else:
            self.entries.clear()
        old, new = (_due(min(x.values()) + self.ttl) if x else None for x in (before, held))
        if old != new:
            if old is not None and old != fired:
                self.handle.deleteTimer(old)
            if new is not None:
                self.handle.registerTimer(new)

    def _held(self) -> dict[str, int]:
        held = self.entries.get()
        return {} if held is None else dict(zip(held[0], held[1]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        before = self._held()
        held = dict(before)
        for at, id, entry in _in_order(rows, "entry"):
            hit = entry in held and at - held[entry] < self.ttl
            yield _HIT(key[0], entry, id, at, hit)
            if not hit:
                held[entry] = at
                if len(held) > self.most:
                    del held[min(held, key=lambda x: (held[x], x))]
        self._keep(before, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        before, now = self._held(), timerValues.getCurrentWatermarkInMs()
        self._keep(before, {k: at for k, at in before.items() if _due(at + self.ttl) > now}, expiredTimerInfo.getExpiryTimeInMs())
        return iter([])

    def close(self) -> None:
        pass


def _due(micros: int) -> int:
    """The first millisecond at or after a time: the watermark counts in those, and a timer must not come early."""
    return -(-micros // 1000)


def _timed(stream: DataFrame, time: str, delay: str) -> DataFrame:
    return stream.where(F.col(time).isNotNull()).withColumn("time", F.col(time).cast("timestamp")).withWatermark("time", delay)


def due_sources(stream: DataFrame, source: str, id_col: str, time: str, ok: str, ttl_seconds: int = SOURCE_SECONDS, delay: str = "1 hour") -> DataFrame:
    """source, id, at and due of each wish to scan a source: due unless a good scan of it is less than `ttl_seconds` old.

    A wish that is due is a scan: if it was `ok` the source is fresh from then on, if not (or null) the next wish is due again. Wishes
    without a time or source go, as do those more than `delay` behind the newest row of earlier batches. Ties go by id.
    """
    rows = _timed(stream.where(F.col(source).isNotNull()), time, delay)
    rows = rows.select(F.col(source).cast("string").alias("source"), F.col(id_col).cast("long").alias("id"), F.unix_micros("time").alias("at"), F.coalesce(F.col(ok), F.lit(False)).alias("ok"), "time")
    return rows.groupBy("source").transformWithState(_Freshness(ttl_seconds * 1_000_000), "source string, id long, at long, due boolean", "Append", "EventTime")


def cached_lookups(stream: DataFrame, source: str, entry: str, id_col: str, time: str, ttl_seconds: int = ENTRY_SECONDS, most: int = ENTRIES, delay: str = "1 hour") -> DataFrame:
    """source, entry, id, at and hit of each lookup: a hit if its source's cache has the entry, fetched less than `ttl_seconds` ago.

    A miss fetches the entry and puts it into the cache; beyond `most` entries the one that was fetched first goes (ties: the least name).
    Lookups without a time, source or entry go, as do those more than `delay` behind the newest row of earlier batches. Ties go by id.
    """
    rows = _timed(stream.where(F.col(source).isNotNull() & F.col(entry).isNotNull()), time, delay)
    rows = rows.select(F.col(source).cast("string").alias("source"), F.col(entry).cast("string").alias("entry"), F.col(id_col).cast("long").alias("id"), F.unix_micros("time").alias("at"), "time")
    return rows.groupBy("source").transformWithState(_Cache(ttl_seconds * 1_000_000, most), "source string, entry string, id long, at long, hit boolean", "Append", "EventTime")


def stateful_session(spark: SparkSession) -> SparkSession:
    """A session beside the given one for a query with state. What it sets holds for its own queries only."""
    session = spark.newSession()
    for name, value in (
        ("spark.sql.session.timeZone", "UTC"),  # times without a zone have no gaps
        ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
        ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"),
        ("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"),
        ("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false"),
    ):
        session.conf.set(name, value)
    return session


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Runs over what has come since the last run with this checkpoint, and appends to Parquet at `out`. A batch that ran is never written twice."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def in_batches(rows: DataFrame, batch: str, path: str, use: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the streaming query `use` writes if rows come in batches, in the order of the whole number `batch`.

    All lies in `path`, a new folder that the cluster shares. The query starts anew for each batch, on one checkpoint, as a daily job does.
    """
    spark = rows.sparkSession
    session = stateful_session(spark)
    rows.withColumn("_batch", F.col(batch)).write.partitionBy("_batch").parquet(f"{path}/cut")
    fs, cut = _fs(spark, f"{path}/cut")
    found = sorted((s.getPath() for s in fs.listStatus(cut) if s.isDirectory() and "=" in s.getPath().getName()), key=lambda p: int(p.getName().split("=")[1]))
    fs.mkdirs(_fs(spark, f"{path}/in")[1])
    stream = use(session.readStream.schema(rows.schema).parquet(f"{path}/in/*"))
    for n, part in enumerate(found):
        if not fs.rename(part, _fs(spark, f"{path}/in/{n:06d}")[1]):
            raise OSError(f"{part} could not be moved to the stream's folder")
        run_available(stream, f"{path}/out", f"{path}/state")
    return spark.read.schema(stream.schema).parquet(f"{path}/out") if found else spark.createDataFrame([], stream.schema)
