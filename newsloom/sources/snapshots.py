"""Tables that change together: an archive and what goes with it, in versions that a reader sees whole or not at all.

Parts are Parquet folders that nothing alters once written, one for each bucket of a table, a hash of the key. A version is a manifest, a
small JSON file that names the parts of all tables and some facts; it is written last, under another name, and then renamed. A writer that
is killed before that leaves parts which no manifest names; a reader keeps the parts that it began with until `vacuum` takes their
version. A commit writes the buckets that it touches, and the manifest names the others where they are. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregates import guard_size
from ..operators.archive import keep_first, last_seen, seen_at
from ..streaming.incremental import BUCKETS, enrich
from .writers import _fs

#: Columns of the table of exceptions: keys that the last scan lacked, and the scan that had them last.
SEEN = "key string, seen string"


@dataclass(frozen=True)
class Version:
    """n is 0 before the first commit. tables: for each, its columns as DDL and its parts by bucket."""

    n: int = 0
    facts: dict = field(default_factory=dict)
    tables: dict[str, tuple[str, dict[str, str]]] = field(default_factory=dict)


def _manifest(path: str, n: int) -> str:
    return f"{path}/manifests/{n:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    fs, at = _fs(spark, f"{path}/manifests")
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, value: str) -> None:
    """Writes a small file, in place of one that may be there."""
    fs, at = _fs(spark, path)
    stream = fs.create(at, True)
    try:
        stream.write(value.encode())
    finally:
        stream.close()


def version(spark: SparkSession, path: str, n: int | None = None) -> Version:
    """Version n, or the newest."""
    n = max(versions(spark, path), default=0) if n is None else n
    if not n:
        return Version()
    told = json.loads(read_text(spark, _manifest(path, n)))
    return Version(n, told["facts"], {name: (ddl, parts) for name, (ddl, parts) in told["tables"].items()})


def table(spark: SparkSession, path: str, name: str, at: Version, buckets: list[int] | None = None) -> DataFrame:
    """A table, or some of its buckets, as version `at` has it."""
    ddl, parts = at.tables[name]
    own = [f"{path}/{p}" for b, p in parts.items() if buckets is None or int(b) in buckets]
    return spark.read.schema(ddl).parquet(*own) if own else spark.createDataFrame([], ddl)


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def write_parts(df: DataFrame, path: str, name: str, key: str, at: Version, buckets: int, touched: list[int] | None = None) -> tuple[str, dict[str, str]]:
    """Writes df as the new state of the touched buckets (None: of all) and returns the table's columns and parts.

    Buckets are dealt to tasks by size, so that a large one is written by several and small ones do not become many files.
    """
    spark, folder = df.sparkSession, f"parts/{name}/{uuid.uuid4().hex}"
    df.withColumn("_bucket", bucket_of(key, buckets)).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{path}/{folder}")
    fs, top = _fs(spark, f"{path}/{folder}")
    new = {p.split("=")[1]: f"{folder}/{p}" for p in (s.getPath().getName() for s in fs.listStatus(top)) if p.startswith("_bucket=")}
    kept = {} if touched is None or name not in at.tables else {b: p for b, p in at.tables[name][1].items() if int(b) not in touched}
    return df.schema.toDDL(), kept | new


def commit(spark: SparkSession, path: str, before: Version, tables: dict[str, tuple[str, dict[str, str]]], facts: dict) -> Version:
    """The version after `before`, with the given tables and facts in place of theirs. Fails if another commit came in between."""
    new = Version(before.n + 1, before.facts | facts, before.tables | tables)
    fs, target = _fs(spark, _manifest(path, new.n))
    if fs.exists(target):
        raise FileExistsError(f"version {new.n} of {path} is there already")
    written = f"{_manifest(path, new.n)}.{uuid.uuid4().hex}"
    write_text(spark, written, json.dumps({"facts": new.facts, "tables": new.tables}, ensure_ascii=False))
    if not fs.rename(_fs(spark, written)[1], target):
        raise OSError(f"version {new.n} of {path} could not be put in its place")
    return new


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Deletes manifests but the newest `keep`, then folders of parts that none of those names, and says how many. No writer may run."""
    found = versions(spark, path)
    stay, gone = found[-max(1, keep):], found[: -max(1, keep)]
    named = {p.rsplit("/", 1)[0] for n in stay for _, parts in version(spark, path, n).tables.values() for p in parts.values()}
    fs, at = _fs(spark, f"{path}/parts")
    for n in gone:
        fs.delete(_fs(spark, _manifest(path, n))[1], False)
    n = 0
    for name in [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []:
        for s in fs.listStatus(_fs(spark, f"{path}/parts/{name}")[1]):
            if f"parts/{name}/{s.getPath().getName()}" not in named:
                fs.delete(s.getPath(), True)
                n += 1
    return n


def count_scan(scanned: DataFrame, key: str, buckets: int) -> tuple[list[int], dict[str, int]]:
    """The buckets of a scan's keys, and its counters."""
    some = lambda c: F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    keyed = F.coalesce(F.col(key).cast("string"), F.lit("")) != ""
    sums = {"rows": F.count(F.lit(1)), "with_body": some("body"), "with_date": some("date")}
    found = scanned.groupBy(F.when(keyed, bucket_of(key, buckets)).alias("b")).agg(*(c.alias(n) for n, c in sums.items())).collect()  # `buckets` rows at most, and one without
    own = [r for r in found if r["b"] is not None]
    counters = {"rows": sum(r["rows"] for r in found), "keyed": sum(r["rows"] for r in own)} | {n: sum(r[n] for r in own) for n in ("with_body", "with_date")} | {"buckets": len(own)}
    return sorted(r["b"] for r in own), counters


def commit_scan(scanned: DataFrame, path: str, scan: str, key: str = "key", seq: str = "seq", run: str | None = None, epoch: int = 0, buckets: int = BUCKETS, ratio: float | None = None) -> Version:
    """Merges a scan into the archive and the state of what was seen last, in one commit.

    The archive gets the scan's new keys, longer bodies and missing dates; only buckets of scanned keys are read and written. The state
    holds exceptions alone: keys that this scan lacks, stamped once with the scan before; keys that come again leave it. Rows without a
    key go. A scan that names its `run` is merged once for each epoch: one that comes again, as after a crash, changes nothing.

    The facts of the version hold `counters` of the scan: rows, keyed (those with a key), with_body, with_date, and the touched buckets. They
    come with the aggregation that finds these buckets, before anything is written, so they cost no scan of their own and are exact when
    tasks run again, which metrics that are observed are not. With a `ratio`, a scan of fewer keyed rows than that share of the scan
    before, rounded down, raises CorpusCollapse and leaves the archive as it is.
    """
    spark = scanned.sparkSession
    before = version(spark, path)
    runs, previous = before.facts.get("runs", {}), before.facts.get("scan")
    if run is not None and runs.get(run, -1) >= epoch:
        return before
    buckets = before.facts.get("buckets", buckets)
    touched, counters = count_scan(scanned, key, buckets)
    if ratio is not None:
        guard_size(counters["keyed"], before.facts.get("counters", {}).get("keyed", 0), ratio)
    scanned = scanned.where(F.coalesce(F.col(key), F.lit("")) != "")
    names = [c for c in scanned.columns if c != seq]
    own = table(spark, path, "archive", before, touched) if "archive" in before.tables else keep_first(scanned, key, seq).select(*names)
    archive = write_parts(enrich(own, scanned, key, seq), path, "archive", key, before, buckets, touched)
    now = Version(before.n, before.facts, before.tables | {"archive": archive})
    known = table(spark, path, "seen", before) if "seen" in before.tables else spark.createDataFrame([], SEEN)
    known = known.withColumnRenamed("key", key)
    if previous:
        out = last_seen(table(spark, path, "archive", now), scanned, known, F.lit(previous), key)
    else:
        out = known.join(scanned.select(key), key, "left_anti")
    seen = write_parts(out.select(F.col(key).alias("key"), "seen"), path, "seen", "key", before, buckets)
    facts = {"scan": scan, "buckets": buckets, "counters": counters} | ({"runs": runs | {run: epoch}} if run is not None else {})
    return commit(spark, path, before, {"archive": archive, "seen": seen}, facts)


def archive_seen(spark: SparkSession, path: str, key: str = "key", at: Version | None = None) -> DataFrame:
    """The archive and, in `seen`, the scan that had each key last; both of one version."""
    at = at or version(spark, path)
    return seen_at(table(spark, path, "archive", at), table(spark, path, "seen", at).withColumnRenamed("key", key), F.lit(at.facts["scan"]), key)


def run_scans(stream: DataFrame, path: str, checkpoint: str, run: str, scan: str, key: str = "key", seq: str = "seq", buckets: int = BUCKETS, ratio: float | None = None):
    """A query that commits each micro-batch as a scan named by the batch's greatest value of the column `scan`. Empty batches are no scans."""

    def merge(batch: DataFrame, epoch: int) -> None:
        name = batch.agg(F.max(F.col(scan).cast("string"))).first()[0]
        if name is not None:
            commit_scan(batch.drop(scan), path, name, key, seq, run, epoch, buckets, ratio)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
