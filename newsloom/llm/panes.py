"""Hourly panes of a stream, written once they are due and written anew when late rows revise them.

The batches lie as files and are fed in order to one stateful Structured Streaming query, which is started anew for each. Time
travels in band: every batch, even one without rows, holds a control row for each state shard with W, the greatest event hour
of all earlier batches, and whether the batch is the last. Rows carry W too, so that a task tells rows of closed panes at once,
and sums up the others by pane before anything moves; a crowded pane costs a shuffled row for each task. A shard keeps its
panes in a MapState, adds what has come, and settles their lives when it has read its control row: due panes are written,
written ones with new rows are taken back and replaced, closed ones are forgotten.

State lives in the checkpoint folder, and the sink commits whole batches, so a lost executor or a batch that runs again
changes nothing. No pane, row or file passes through the driver, which only sees one number for each batch.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ._common import Staged, _fs, delete, new_path, prepare
from ._words import mix

#: Hours from the end of a pane's hour to its being due, and to its end.
DUE_HOURS, CLOSED_HOURS = 2, 72
BATCHES, SHARDS = 12, 64
#: Panes that a task sums up before it sends them on.
_HELD = 100_000
#: W before any row has come, in hours: minus infinity. No number in the stream is null, as pandas would make floats of a column with nulls.
_NEVER = -(1 << 48)

_FILES = "batch long, hour long, kind string, click_id long, cents long, w long, shard int, last boolean"
#: `what`: a control row, the sums of a pane's rows, or a row of a closed pane.
_CONTROL, _PANE, _LATE = 0, 1, 2
_SENT = "shard int, what int, batch long, hour long, kind string, click_id long, n_rows long, cents long, w long, last boolean"
RESULT = "batch long, hour long, click_id long, n_rows long, cents long, record string, kind string"
_COLUMNS = [c.split()[0] for c in RESULT.split(", ")]


def closed(hour, w, after: int = CLOSED_HOURS):
    """Whether W, in whole hours, has passed a pane's hour by `after` from its end. All limits are whole hours, so W may be, too."""
    return w >= hour + 1 + after


def _summed(batches: Iterator[pa.RecordBatch], shards: int, closed_after: int) -> Iterator[pa.RecordBatch]:
    """Control rows and rows of closed panes as they are, the others as sums of the task by pane; each with its shard."""
    schema = pa.schema([("shard", pa.int32()), ("what", pa.int32()), ("batch", pa.int64()), ("hour", pa.int64()), ("kind", pa.string()), ("click_id", pa.int64()), ("n_rows", pa.int64()), ("cents", pa.int64()), ("w", pa.int64()), ("last", pa.bool_())])
    held: dict[tuple, list[int]] = {}

    def sums() -> pa.RecordBatch:
        rows = [(zlib.crc32(f"{hour} {kind}".encode()) % shards, _PANE, batch, hour, kind, -1, n, cents, _NEVER, False) for (batch, hour, kind), (n, cents) in held.items()]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def as_they_are(rows: pa.Table, what: int, shard: pa.Array) -> Iterator[pa.RecordBatch]:
        n = len(rows)
        columns = [shard, pa.array(np.full(n, what, np.int32)), rows["batch"], rows["hour"], rows["kind"], rows["click_id"], pa.array(np.ones(n, np.int64)), rows["cents"], rows["w"], rows["last"]]
        yield from pa.table(columns, schema=schema).to_batches()

    for batch in batches:
        rows = pa.Table.from_batches([batch])
        control = pc.is_valid(rows["shard"])
        if (told := rows.filter(control)).num_rows:
            yield from as_they_are(told, _CONTROL, told["shard"])
        rows = rows.filter(pc.invert(control))
        late = closed(rows["hour"].to_numpy(), rows["w"].to_numpy(), closed_after)
        if (gone := rows.filter(pa.array(late))).num_rows:
            dealt = mix(gone["click_id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(shards)
            yield from as_they_are(gone, _LATE, pa.array(dealt.astype(np.int32)))
        sum_ = rows.filter(pa.array(~late)).group_by(["batch", "hour", "kind"]).aggregate([("cents", "count"), ("cents", "sum")])
        for b, hour, kind, n, cents in zip(*(sum_[c].to_pylist() for c in ("batch", "hour", "kind", "cents_count", "cents_sum"))):
            own = held.setdefault((b, hour, kind), [0, 0])
            own[0] += n
            own[1] += cents
        if len(held) >= _HELD:
            yield sums()
    if held:
        yield sums()


class Panes(StatefulProcessor):
    """A shard: (hour, kind) of each pane that is not closed, with its totals and those last written (none: -1 rows)."""

    def __init__(self, due_after: int = DUE_HOURS, closed_after: int = CLOSED_HOURS):
        self.due_after, self.closed_after = due_after, closed_after

    def init(self, handle) -> None:
        self.panes = handle.getMapState("panes", "hour long, kind string", "n_rows long, cents long, sent_rows long, sent_cents long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        control, fresh = None, {}
        for held in rows:
            late = held[held["what"] == _LATE]
            if len(late):
                yield late.assign(record="late")[_COLUMNS]
            come = held[held["what"] == _PANE]
            for hour, kind, n, cents in zip(come["hour"].tolist(), come["kind"].tolist(), come["n_rows"].tolist(), come["cents"].tolist()):
                own = fresh.setdefault((hour, kind), [0, 0])
                own[0] += n
                own[1] += cents
            told = held[held["what"] == _CONTROL]
            if len(told):
                control = told.iloc[0]
        for pane, (n, cents) in fresh.items():
            old = self.panes.getValue(pane) if self.panes.containsKey(pane) else (0, 0, -1, 0)
            self.panes.updateValue(pane, (old[0] + n, old[1] + cents, old[2], old[3]))
        if control is not None:
            out = self.settle(int(control["batch"]), int(control["w"]), bool(control["last"]))
            if out:
                yield pd.DataFrame(out, columns=_COLUMNS)

    def settle(self, batch: int, w: int, last: bool) -> list[tuple]:
        out = []
        for (hour, kind), (n, cents, sent_rows, sent_cents) in list(self.panes.iterator()):
            due = closed(hour, w, self.due_after)
            record = []
            if sent_rows < 0 and (due or last):
                record = [("emit" if due else "final", n, cents)]
            elif 0 <= sent_rows != n:
                record = [("retract", sent_rows, sent_cents), ("replace", n, cents)]
            out += [(batch, hour, -1, rows, total, name, kind) for name, rows, total in record]
            if closed(hour, w, self.closed_after):
                self.panes.removeKey((hour, kind))
            elif record:
                self.panes.updateValue((hour, kind), (n, cents, n, cents))
        return out

    def close(self) -> None:
        pass


def _told(spark: SparkSession, w: list[int], shards: int) -> DataFrame:
    """The control rows of all batches."""
    batch = F.floor(F.col("id") / shards)
    zero = F.lit(0).cast("long")
    return spark.range(len(w) * shards).select(
        batch.alias("batch"), zero.alias("hour"), F.lit("").alias("kind"), (zero - 1).alias("click_id"), zero.alias("cents"),
        F.get(F.array(*(F.lit(x).cast("long") for x in w)), batch.cast("int")).alias("w"), (F.col("id") % shards).cast("int").alias("shard"), (batch == len(w) - 1).alias("last"),
    )


def pane_revisions(rows: DataFrame, batches: int = BATCHES, shards: int = SHARDS, due_after: int = DUE_HOURS, closed_after: int = CLOSED_HOURS) -> DataFrame:
    """What the stateful query writes over `rows`: batch (0 to batches - 1), hour (of the event), kind, click_id, cents.

    Records: `late` for each row of a closed pane (its click_id, 1 row); `emit` for a due pane; `retract` and `replace` for a
    written pane with new rows; `final` for panes that the last batch leaves unwritten. click_id is -1 but in `late`. Rows that
    repeat count as often as they come; a null kind is a pane of its own (`none`), null cents count as 0. Other columns are
    ignored. Without rows nothing is written, though all batches run. Each call takes a new folder under the shared one.
    """
    spark = rows.sparkSession
    prepare(spark)
    top = new_path(spark, "panes")
    kind, cents = F.coalesce("kind", F.lit("none")), F.coalesce(F.col("cents").cast("long"), F.lit(0))
    own = Staged(rows.select(F.col("batch").cast("long"), F.col("hour").cast("long"), kind.alias("kind"), F.col("click_id").cast("long"), cents.alias("cents")), "dealt-rows")
    greatest = {r["batch"]: r["w"] for r in own.df.groupBy("batch").agg(F.max("hour").alias("w")).collect()}  # a row for each batch
    w = [_NEVER]
    for k in range(batches - 1):
        w.append(max(w[-1], greatest.get(k, _NEVER)))
    control = _told(spark, w, shards)
    earlier = control.where("shard = 0").select("batch", "w")
    timed = own.df.join(F.broadcast(earlier), "batch").select("batch", "hour", "kind", "click_id", "cents", "w", F.lit(None).cast("int").alias("shard"), F.lit(False).alias("last"))
    timed.unionByName(control.coalesce(1)).withColumn("b", F.col("batch")).write.partitionBy("b").parquet(f"{top}/cut")
    own.drop()

    session = spark.newSession()  # the state store's settings hold for this query only
    partitions = min(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for name, value in (
        ("spark.sql.streaming.internal.stateStore.partitions", str(partitions)),  # the state has a width of its own: no more tasks than shards
        ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"),
        ("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"),
        ("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false"),  # small stores need no space in advance
        ("spark.sql.streaming.stateStore.unloadOnCommit", "true"),  # the next start may place a shard elsewhere
        ("spark.sql.streaming.noDataMicroBatches.enabled", "false"),
    ):
        session.conf.set(name, value)
    fs, _ = _fs(spark, top)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(path(f"{top}/in"))
    for k in range(batches):
        if not fs.rename(path(f"{top}/cut/b={k}"), path(f"{top}/in/{k:05d}")):
            raise RuntimeError(f"batch {k} could not be moved to the stream's folder")
        stream = session.readStream.schema(_FILES).parquet(f"{top}/in/*")
        summed = stream.mapInArrow(lambda x: _summed(x, shards, closed_after), _SENT)
        settled = summed.groupBy("shard").transformWithStateInPandas(Panes(due_after, closed_after), RESULT, "Append", "None")
        query = settled.writeStream.format("parquet").option("path", f"{top}/out").option("checkpointLocation", f"{top}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    for done in ("cut", "in", "state"):
        delete(spark, f"{top}/{done}")
    return spark.read.schema(RESULT).parquet(f"{top}/out")


def _day(time: Column) -> Column:
    return F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date"))


def dealt_clicks(clicks: DataFrame, batches: int = BATCHES) -> DataFrame:
    """click_id, kind, hour, cents and batch of each click: some come up to six batches after their time.

    Rows without ts or click_id go. Of rows that share a click_id, the first to arrive stays, by ts, kind and value among those.
    A null arrived_at counts as ts. Infinite or undefined values follow Spark's cast of floor to long.
    """
    arrived, ts = F.coalesce("arrived_at", "ts"), F.col("ts")
    rows = clicks.where("ts IS NOT NULL AND click_id IS NOT NULL").select(F.col("click_id").cast("long"), F.struct(arrived.alias("arrived_at"), ts.alias("ts"), "kind", "value").alias("row"))
    rows = rows.groupBy("click_id").agg(F.min("row").alias("row")).select("click_id", "row.*")
    day = _day(F.col("arrived_at"))
    turn = F.pmod(day, F.lit(batches))
    late = F.greatest(F.lit(0), F.crc32(F.col("click_id").cast("string").cast("binary")) % 30 - 23)
    hour = (_day(ts) - (day - turn)) * 24 + F.hour(ts)
    return rows.select("click_id", "kind", hour.cast("long").alias("hour"), F.coalesce(F.floor(100 * F.col("value") + 0.5), F.lit(0)).cast("long").alias("cents"), F.least(F.lit(batches - 1), turn + late).cast("long").alias("batch"))


def op11_window_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = spark.read.parquet(f"{sf_dir}/clicks.parquet")
    return pane_revisions(dealt_clicks(clicks)).select("batch", "hour", "click_id", "n_rows", "cents", "record", "kind")


OP11_SQL = r"""
WITH RECURSIVE steps(n, c, k) AS (
  SELECT i, i, 0 FROM range(256) t(i)
  UNION ALL
  SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), tab AS (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
firsts AS (
  SELECT * FROM clicks WHERE ts IS NOT NULL AND click_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY coalesce(arrived_at, ts), ts, kind NULLS FIRST, value NULLS FIRST) = 1
), dealt AS (
  SELECT click_id, coalesce(kind, 'none') AS kind, coalesce(floor(100 * value + 0.5), 0)::BIGINT AS cents, ts,
         date_diff('day', DATE '1970-01-01', coalesce(arrived_at, ts)::DATE) AS d,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(click_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)]))) AS crc
  FROM firsts, tab
), r AS (
  SELECT click_id, kind, cents, least(11, d % 12 + greatest(0, crc % 30 - 23)) AS batch,
         (date_diff('day', DATE '1970-01-01', ts::DATE) - (d - d % 12)) * 24 + hour(ts) AS hour
  FROM dealt
), w AS (
  SELECT k AS batch, (SELECT max(hour) FROM r WHERE r.batch < k) AS w FROM range(12) t(k)
), told AS (
  SELECT r.*, coalesce(hour + 73 <= w, false) AS is_late FROM r JOIN w USING (batch)
), sums AS (
  SELECT hour, kind, batch, count(*) AS n, sum(cents) AS c FROM told WHERE NOT is_late GROUP BY ALL
), running AS (
  SELECT *, sum(n) OVER p AS to_n, sum(c) OVER p AS to_c, lag(batch) OVER (PARTITION BY hour, kind ORDER BY batch) AS before
  FROM sums WINDOW p AS (PARTITION BY hour, kind ORDER BY batch)
), panes AS (
  SELECT hour, kind, (SELECT min(w.batch) FROM w WHERE w.batch >= f.b AND w.w >= f.hour + 3) AS emitted
  FROM (SELECT hour, kind, min(batch) AS b FROM sums GROUP BY ALL) f
), written AS (
  SELECT s.*, p.emitted FROM running s JOIN panes p ON s.hour = p.hour AND s.kind = p.kind
), out AS (
  SELECT batch, hour, click_id, 1 AS n_rows, cents, 'late' AS record, kind FROM told WHERE is_late
  UNION ALL
  SELECT coalesce(emitted, 11), hour, -1, sum(n), sum(c), CASE WHEN emitted IS NULL THEN 'final' ELSE 'emit' END, kind
  FROM written WHERE emitted IS NULL OR batch <= emitted GROUP BY hour, kind, emitted
  UNION ALL
  SELECT batch, hour, -1, to_n - n, to_c - c, 'retract', kind FROM written WHERE batch > emitted
  UNION ALL
  SELECT batch, hour, -1, to_n, to_c, 'replace', kind FROM written WHERE batch > emitted
)
SELECT batch::BIGINT AS batch, hour::BIGINT AS hour, click_id::BIGINT AS click_id, n_rows::BIGINT AS n_rows, cents::BIGINT AS cents, record, kind FROM out
"""
