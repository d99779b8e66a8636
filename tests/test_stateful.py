"""Streams with state against plain Python, restarts included."""

import datetime as dt
import random

import pytest

from newsloom.streaming import incremental as I
from newsloom.streaming import stateful as K

START = dt.datetime(2024, 3, 1)


def made(rng, n):
    """Wishes in order of time, dealt to three batches in order; some at the same second, some without a source."""
    times = sorted(rng.randint(0, 40 * 3600) for _ in range(n))
    return [(i, rng.choice(["a", "b", "c", None]), rng.choice("xyz"), START + dt.timedelta(seconds=t), rng.random() < 0.7, min(2, 3 * k // n)) for k, (i, t) in enumerate(zip(rng.sample(range(n), n), times))]


SCHEMA = "id long, src string, entry string, t timestamp, good boolean, batch int"


def in_order(rows):
    return sorted((r for r in rows if r[1] is not None), key=lambda r: (r[5], r[3], r[0]))


def due_by_python(rows, ttl):
    last, out = {}, {}
    for i, src, _, t, good, _ in in_order(rows):
        out[i] = due = src not in last or (t - last[src]).total_seconds() >= ttl
        if due and good:
            last[src] = t
        elif due:
            last.pop(src, None)
    return out


def hits_by_python(rows, ttl, most):
    held, out = {}, {}
    for i, src, entry, t, _, _ in in_order(rows):
        own = held.setdefault(src, {})
        out[i] = hit = entry in own and (t - own[entry]).total_seconds() < ttl
        if not hit:
            own[entry] = t
            if len(own) > most:
                del own[min(own, key=lambda x: (own[x], x))]
    return out


def test_due_sources_and_caches_equal_python(spark, tmp_path):
    rows = made(random.Random(2), 90)
    df = spark.createDataFrame(rows, SCHEMA)
    due = K.in_batches(df, "batch", f"file://{tmp_path}/due", lambda s: K.due_sources(s, "src", "id", "t", "good", 7200, "10 minutes"))
    got = {r.id: r.due for r in due.collect()}
    assert got == due_by_python(rows, 7200) and {True, False} == set(got.values())
    hits = K.in_batches(df, "batch", f"file://{tmp_path}/hits", lambda s: K.cached_lookups(s, "src", "entry", "id", "t", 4 * 3600, 2, "10 minutes"))
    got = {r.id: r.hit for r in hits.collect()}
    assert got == hits_by_python(rows, 4 * 3600, 2) and {True, False} == set(got.values())


def test_state_of_sources_that_are_stale_goes(spark, tmp_path):
    """The timer forgets a source once no row in time can meet its scan; a row of another source moves the watermark."""
    rows = [(1, "a", "x", START, True, 0), (2, "b", "x", START + dt.timedelta(hours=9), True, 1), (3, "b", "x", START + dt.timedelta(hours=10), True, 2)]
    path = f"file://{tmp_path}/s"
    told = K.in_batches(spark.createDataFrame(rows, SCHEMA), "batch", path, lambda s: K.due_sources(s, "src", "id", "t", "good", 7200, "1 minute"))
    assert {r.id: r.due for r in told.collect()} == {1: True, 2: True, 3: False}
    session = K.stateful_session(spark)
    left = session.read.format("statestore").option("stateVarName", "scanned").load(f"{path}/state").collect()
    assert [r["key"][0] for r in left] == ["b"]


def test_no_rows_give_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    told = K.in_batches(df, "batch", f"file://{tmp_path}/none", lambda s: K.due_sources(s, "src", "id", "t", "good"))
    assert told.collect() == [] and told.columns == ["source", "id", "at", "due"]


def test_first_seen_drops_late_and_repeated_rows_and_restarts_without_change(spark, tmp_path):
    at = lambda h: START + dt.timedelta(hours=h)
    rows = [("a", at(0), 0), ("a", at(0), 0), ("b", at(5), 0), ("a", at(0), 1), ("late", at(3), 1), ("in time", at(4.5), 1), ("b", at(5), 1), ("c", at(20), 1), ("b", at(21), 2), ("d", at(19.5), 2)]
    path = f"file://{tmp_path}/seen"
    df = spark.createDataFrame(rows, "key string, t timestamp, batch int")
    told = K.in_batches(df, "batch", path, lambda s: I.first_seen(s, "key", "t", "1 hour"))
    want = sorted([("a", 0), ("b", 0), ("in time", 1), ("c", 1), ("b", 2), ("d", 2)])  # b comes again when its state is gone
    assert sorted((r.key, r.batch) for r in told.collect()) == want
    again = I.first_seen(K.stateful_session(spark).readStream.schema(df.schema).parquet(f"{path}/in/*"), "key", "t", "1 hour")
    K.run_available(again, f"{path}/out", f"{path}/state")
    assert sorted((r.key, r.batch) for r in spark.read.schema(df.schema).parquet(f"{path}/out").collect()) == want


def test_a_batch_that_broke_off_is_decided_once(spark, tmp_path):
    """A sink that fails in the middle of a batch: the next run ends it, and no wish is told twice."""
    rows = made(random.Random(4), 60)
    path, session = f"file://{tmp_path}/b", K.stateful_session(spark)
    df = spark.createDataFrame(rows, SCHEMA)
    stream = lambda: K.due_sources(session.readStream.schema(df.schema).parquet(f"{path}/in"), "src", "id", "t", "good", 7200, "10 minutes")

    def broken(batch, epoch):
        batch.write.format("noop").mode("overwrite").save()
        raise RuntimeError("lost")

    for k in range(3):
        df.where(f"batch = {k}").coalesce(1).write.mode("append").parquet(f"{path}/in")
        if k == 1:
            with pytest.raises(Exception):
                stream().writeStream.foreachBatch(broken).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
        stream().writeStream.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{path}/out/n={n}")).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start().awaitTermination()
    told = session.read.parquet(f"{path}/out").collect()
    assert len(told) == len({r.id for r in told}) and {r.id: r.due for r in told} == due_by_python(rows, 7200)


class Handle:
    """A state store of one value for one group; `calls` has all that goes to it."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None

    def registerTimer(self, at):
        self.calls.append("register")
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls.append("delete")
        self.timers.remove(at)


def test_a_group_costs_one_read_one_write_and_one_timer():
    """groups are rows, not frames; a cache is one value however many entries it has, and what is over goes at once."""
    from pyspark.sql import Row
    from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

    rows = [Row(source="a", entry=e, id=i, at=at, ok=True) for e, i, at in (("z", None, 5000), ("y", 2, 5000), ("x", 1, 0), ("x", 7, 3000))]
    fresh, handle = K._Freshness(4000), Handle()
    fresh.init(handle)
    told = [tuple(r) for r in fresh.handleInputRows(("a",), iter(rows), None)]
    assert told == [("a", 1, 0, True), ("a", 7, 3000, False), ("a", 2, 5000, True), ("a", None, 5000, False)]
    assert handle.calls == ["get", "update", "register"] and handle.value == (5000,) and handle.timers == {9}

    cache, handle = K._Cache(4000, 5), Handle()
    cache.init(handle)
    told = [tuple(r) for r in cache.handleInputRows(("a",), iter(rows), None)]
    assert told == [("a", "x", 1, 0, False), ("a", "x", 7, 3000, True), ("a", "y", 2, 5000, False), ("a", "z", None, 5000, False)]
    assert handle.calls == ["get", "update", "register"] and handle.timers == {4}
    handle.timers.clear()  # Spark itself takes the timer that fires
    assert list(cache.handleExpiredTimer(("a",), TimerValues(0, 9), ExpiredTimerInfo(4))) == []
    assert handle.value is None and not handle.timers
