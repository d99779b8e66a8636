"""A cache of fetched pages as a data source of Spark: inserts show whole or not at all, and what has expired is never read.

An insert writes Parquet files, sorted by time within each, and then one commit, a small JSON file that names them with their least and
greatest time; files that no commit names, as of tasks that failed, are not there for readers. A read passes its bounds on the time and its
URLs down: files beyond the bounds are not opened, and of the others only rows within leave the reader. Files are opened by pyarrow, so
the folder has to be in a store that pyarrow reaches (file, s3, gs, hdfs) and that all executors share.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage

from ..shipping import ship

PAGE = "url string, content string, etag string, last_modified string, fetched_at timestamp"
_ARROW = pa.schema([*((n, pa.string()) for n in ("url", "content", "etag", "last_modified")), ("fetched_at", pa.timestamp("us", "UTC"))])

#: A file ends with the batch that takes it beyond this, before compression; a partition takes small files up to this.
FILE_BYTES = 128 << 20
#: Rows of a row group, which is what a reader skips within a file.
GROUP_ROWS = 4096


@dataclass(frozen=True)
class Part:
    """A file, its size on disk, and its least and greatest time in microseconds."""

    name: str
    size: int
    least: int
    greatest: int


@dataclass
class Written(WriterCommitMessage):
    parts: list[Part]


@dataclass
class Files(InputPartition):
    names: list[str]


@dataclass
class Bounds:
    """Microseconds, both inclusive, and the URLs that are asked for (None: all)."""

    least: int | None = None
    greatest: int | None = None
    urls: list[str] | None = None

    def take(self, f: Filter) -> bool:
        """Narrows the bounds by a filter, and says whether that is all that the filter asks."""
        if f.attribute == ("url",) and isinstance(f, (EqualTo, In)):
            own = [f.value] if isinstance(f, EqualTo) else list(f.value)
            own = [u for u in own if u is not None]
            self.urls = own if self.urls is None else [u for u in self.urls if u in own]
            return True
        if f.attribute != ("fetched_at",) or not isinstance(getattr(f, "value", None), datetime):
            return False
        at = micros_of(f.value)
        if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            at += isinstance(f, GreaterThan)
            self.least = at if self.least is None else max(self.least, at)
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            at -= isinstance(f, LessThan)
            self.greatest = at if self.greatest is None else min(self.greatest, at)
        else:
            return False
        return True

    def may_have(self, part: Part) -> bool:
        return (self.least is None or part.greatest >= self.least) and (self.greatest is None or part.least <= self.greatest) and self.urls != []

    def expression(self) -> ds.Expression | None:
        at, own = (lambda us: pa.scalar(us, pa.timestamp("us", "UTC"))), []
        if self.least is not None:
            own.append(ds.field("fetched_at") >= at(self.least))
        if self.greatest is not None:
            own.append(ds.field("fetched_at") <= at(self.greatest))
        if self.urls is not None:
            own.append(ds.field("url").isin(pa.array(self.urls, pa.string())))
        out = None
        for e in own:
            out = e if out is None else out & e
        return out


def micros_of(at: datetime) -> int:
    """Microseconds since 1970; times without a zone are in that of the machine, as Spark's Python API has it."""
    return (at.astimezone(timezone.utc) - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _commits(path: str) -> dict[str, dict]:
    """Commits by name, without those that a later one stands for."""
    store, top = _open(path)
    found = {}
    for info in store.get_file_info(pafs.FileSelector(f"{top}/commits", allow_not_found=True)):
        if info.base_name.endswith(".json"):
            with store.open_input_stream(info.path) as f:
                found[info.base_name[:-5]] = json.loads(f.read())
    gone = {old for c in found.values() for old in c["replaces"]}
    return {name: c for name, c in found.items() if name not in gone}


def parts(path: str) -> list[Part]:
    """The files of the cache, by time."""
    own = [Part(*p) for c in _commits(path).values() for p in c["parts"]]
    return sorted(own, key=lambda p: (p.least, p.greatest, p.name))


def _put_commit(path: str, own: Iterable[Part], replaces: Iterable[str] = ()) -> None:
    store, top = _open(path)
    store.create_dir(f"{top}/commits", recursive=True)
    name = f"{top}/commits/{uuid.uuid4().hex}"
    with store.open_output_stream(f"{name}.next") as f:
        f.write(json.dumps({"parts": [[p.name, p.size, p.least, p.greatest] for p in own], "replaces": sorted(replaces)}).encode())
    store.move(f"{name}.next", f"{name}.json")


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, top = _open(self.path)
        store.create_dir(f"{top}/parts", recursive=True)
        done: list[Part] = []
        out = name = None
        held, times = 0, []

        def close() -> None:
            out.close()
            done.append(Part(name, store.get_file_info(f"{top}/{name}").size, min(times), max(times)))

        for batch in iterator:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).select(_ARROW.names).cast(_ARROW)
            if out is None:
                name, held, times = f"parts/{uuid.uuid4().hex}.parquet", 0, []
                out = pq.ParquetWriter(f"{top}/{name}", _ARROW, filesystem=store, compression="zstd")
            out.write_table(table, row_group_size=GROUP_ROWS)
            at = table["fetched_at"].cast(pa.int64())
            times += [at[0].as_py(), at[-1].as_py()]  # rows come by time
            held += table.nbytes
            if held >= FILE_BYTES:
                close()
                out = None
        if out is not None:
            close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        own = [p for m in messages if m for p in m.parts]
        if own:
            _put_commit(self.path, own)

    def abort(self, messages: list[Written | None]) -> None:
        store, top = _open(self.path)
        for p in (p for m in messages if m for p in m.parts):
            store.delete_file(f"{top}/{p.name}")


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path, self.bounds = path, Bounds()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self.bounds.take(f):
                yield f

    def partitions(self) -> list[Files]:
        out, held = [], FILE_BYTES
        for p in parts(self.path):
            if not self.bounds.may_have(p):
                continue
            if held + p.size > FILE_BYTES:
                out.append(Files([]))
                held = 0
            out[-1].names.append(p.name)
            held += p.size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        store, top = _open(self.path)
        if partition.names:
            own = ds.dataset([f"{top}/{n}" for n in partition.names], schema=_ARROW, filesystem=store, format="parquet")
            yield from (b for b in own.to_batches(filter=self.bounds.expression(), batch_size=GROUP_ROWS, batch_readahead=1, fragment_readahead=1) if b.num_rows)


class PageCache(DataSource):
    """spark.read.format("page_cache").load(path), and df.write.format("page_cache").mode("append").save(path)."""

    @classmethod
    def name(cls) -> str:
        return "page_cache"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        if overwrite:
            raise ValueError("a page cache grows by append; `expire` takes old entries out")
        return _Writer(self.options["path"])


def register(spark: SparkSession) -> None:
    """Makes the source known to a session, and lets filters reach Python sources."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PageCache)


def insert(pages: DataFrame, path: str) -> None:
    """Adds pages with URL, content and time; without one of these they are no entries. Missing columns are null, others are left out.

    No row is an empty insert, which leaves no commit. Repeated rows and older entries of a URL stay until they expire.
    """
    register(pages.sparkSession)
    names = [f.split(" ") for f in PAGE.split(", ")]
    own = pages.select(*((F.col(n) if n in pages.columns else F.lit(None)).cast(kind).alias(n) for n, kind in names))
    own.where("url IS NOT NULL AND content IS NOT NULL AND fetched_at IS NOT NULL").sortWithinPartitions("fetched_at").write.format("page_cache").mode("append").save(path)


def fresh(spark: SparkSession, path: str, now: datetime, ttl_seconds: int | None) -> DataFrame:
    """The newest entry of each URL that is `ttl_seconds` old at most at `now`; None takes stale ones too.

    Of entries of one URL and time the greatest content counts. An empty or missing folder is an empty cache.
    """
    register(spark)
    df = spark.read.format("page_cache").load(path)
    if ttl_seconds is not None:
        df = df.where(F.col("fetched_at") >= F.lit(now - timedelta(seconds=ttl_seconds)))
    newest = df.groupBy("url").agg(F.max(F.struct("fetched_at", "content", "etag", "last_modified")).alias("r"))
    return newest.select("url", "r.content", "r.etag", "r.last_modified", "r.fetched_at")


def expire(path: str, before: datetime) -> int:
    """Deletes files whose entries are all older than `before`, and puts one commit in the place of all; returns how many files went.

    Inserts may go on meanwhile. Readers with a bound of `before` or later never open those files; others should not run.
    """
    store, top = _open(path)
    old = _commits(path)
    own = [Part(*p) for c in old.values() for p in c["parts"]]
    gone = [p for p in own if p.greatest < micros_of(before)]
    if gone:
        _put_commit(path, [p for p in own if p not in gone], old)
        for name in old:
            store.delete_file(f"{top}/commits/{name}.json")
        for p in gone:
            store.delete_file(f"{top}/{p.name}")
    return len(gone)
