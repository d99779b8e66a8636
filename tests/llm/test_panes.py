import datetime as dt
import math
import random
import zlib

import duckdb
import pyarrow as pa
from newsloom.llm import panes

SCHEMA = "batch long, hour long, kind string, click_id long, cents long"


def brute(rows, batches, due=2, closed=72):
    """The contract, batch by batch: rows of (batch, hour, kind, click_id, cents)."""
    out, state, w = [], {}, -math.inf
    for k in range(batches):
        come, fresh = [r for r in rows if r[0] == k], set()
        for _, hour, kind, click, cents in come:
            kind, cents = kind or "none", cents or 0
            if w >= hour + 1 + closed:
                out.append((k, hour, click, 1, cents, "late", kind))
            else:
                own = state.setdefault((hour, kind), [0, 0, None])
                own[0] += 1
                own[1] += cents
                fresh.add((hour, kind))
        for (hour, kind), own in list(state.items()):
            n, cents, sent = own
            if sent is None and w >= hour + 1 + due:
                out.append((k, hour, -1, n, cents, "emit", kind))
                own[2] = (n, cents)
            elif sent is not None and (hour, kind) in fresh:
                out += [(k, hour, -1, *sent, "retract", kind), (k, hour, -1, n, cents, "replace", kind)]
                own[2] = (n, cents)
            if w >= hour + 1 + closed:
                del state[hour, kind]
        w = max([w, *(r[1] for r in come)])
    return sorted(out + [(batches - 1, hour, -1, n, cents, "final", kind) for (hour, kind), (n, cents, sent) in state.items() if sent is None])


def read(df):
    return sorted(tuple(r) for r in df.select("batch", "hour", "click_id", "n_rows", "cents", "record", "kind").collect())


def test_random_batches(spark):
    """Late rows, batches without rows, crowded panes, negative hours, sums past 2 ** 53, nulls and repeated rows."""
    rng = random.Random(4)
    rows = []
    for k in range(150):
        batch = rng.choice([0, 1, 2, 4])
        rows.append((batch, rng.randint(-3, 6) + 20 * batch - 60 * (rng.random() < 0.3), rng.choice(["a", "b", None]), k, rng.choice([None, -5, 7, 2**55 + k])))
    rows += [(1, 3, "a", 1000 + k, 1) for k in range(2000)] + rows[:20]
    got = panes.pane_revisions(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS w", "2 AS shard", "3 AS b"), batches=6, shards=3, due_after=1, closed_after=30)
    want = brute(rows, 6, 1, 30)
    assert read(got) == want
    assert {r[5] for r in want} == {"late", "emit", "retract", "replace", "final"}


def test_no_rows(spark):
    assert read(panes.pane_revisions(spark.createDataFrame([], SCHEMA), batches=2, shards=2)) == []


def test_summed_by_task():
    """Panes are summed before they move, whatever the batches; rows of closed panes and control rows stay as they are."""
    rng = random.Random(2)
    rows = [(0, rng.randint(0, 9), rng.choice("xy"), k, k, 80, None, False) for k in range(500)] + [(0, 0, "", -1, 0, 80, 1, True)]
    names = "batch hour kind click_id cents w shard last".split()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    table = pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)], names=names)
    out = pa.Table.from_batches(panes._summed(iter(table.to_batches(max_chunksize=70)), 5, 72)).to_pylist()
    late = [r for r in rows if r[6] is None and r[5] >= r[1] + 73]
    assert sorted(r["click_id"] for r in out if r["what"] == 2) == sorted(r[3] for r in late)
    sums = {}
    for _, hour, kind, _, cents, w, shard, _ in rows:
        if shard is None and w < hour + 73:
            own = sums.setdefault((hour, kind), [0, 0])
            own[0] += 1
            own[1] += cents
    assert {(r["hour"], r["kind"]): [r["n_rows"], r["cents"]] for r in out if r["what"] == 1} == sums
    assert [(r["shard"], r["last"]) for r in out if r["what"] == 0] == [(1, True)]
    assert all(0 <= r["shard"] < 5 for r in out)


def deal(clicks):
    first = {}
    for click, ts, arrived, kind, value in clicks:
        if ts is not None and click is not None:
            key = (arrived or ts, ts, kind is not None, kind or "", value is not None, value or 0)
            if click not in first or key < first[click][0]:
                first[click] = (key, (ts, arrived or ts, kind, value))
    out = []
    for click, (_, (ts, arrived, kind, value)) in first.items():
        day = (arrived.date() - dt.date(1970, 1, 1)).days
        turn = day % 12
        hour = math.floor((ts - dt.datetime(1970, 1, 1) - dt.timedelta(days=day - turn)) / dt.timedelta(hours=1))
        out.append((min(11, turn + max(0, zlib.crc32(str(click).encode()) % 30 - 23)), hour, kind, click, 0 if value is None else math.floor(100 * value + 0.5)))
    return sorted(out, key=str)


def test_clicks_are_dealt(spark, sf):
    t = dt.datetime(2024, 3, 5, 23, 59, 59, 999_999)
    odd = [(1, t, t, "a", 1.005), (1, t, t, "a", 1.005), (2, None, t, "a", 1.0), (None, t, t, "a", 1.0), (3, t, None, None, None), (4, t, t + dt.timedelta(days=3), "b", -0.005), (4, t, t, "c", 2.0), (-5, t - dt.timedelta(days=90), t, "", 3.0)]
    schema = "click_id long, ts timestamp_ntz, arrived_at timestamp_ntz, kind string, value double"
    read = lambda df: sorted((tuple(r) for r in df.select("batch", "hour", "kind", "click_id", "cents").collect()), key=str)
    assert read(panes.dealt_clicks(spark.createDataFrame(odd, schema).selectExpr("*", "1 AS row", "2 AS batch"))) == deal(odd)
    table = spark.read.parquet(f"{sf}/clicks.parquet")
    assert read(panes.dealt_clicks(table)) == deal([tuple(r) for r in table.select("click_id", "ts", "arrived_at", "kind", "value").collect()])


def test_query_equals_sql_and_brute_force(spark, sf):
    got = read(panes.op11_window_panes(spark, sf))
    clicks = spark.read.parquet(f"{sf}/clicks.parquet").select("click_id", "ts", "arrived_at", "kind", "value").collect()
    assert got == brute(deal([tuple(r) for r in clicks]), 12)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW clicks AS SELECT * FROM '{sf}/clicks.parquet'")
    assert got == sorted(db.sql(f"SELECT batch, hour, click_id, n_rows, cents, record, kind FROM ({panes.OP11_SQL})").fetchall())
