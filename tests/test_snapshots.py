"""An archive and its state in one commit: killed after each step, both agree; readers keep what they began with."""

import pytest

from newsloom.operators.aggregates import CorpusCollapse
from newsloom.sources import snapshots as V

SCHEMA = "key string, title string, body string, date string, seq int"
SCANS = [
    ("s1", [("a", "A", "x", None, 1), ("b", "B", "", None, 2), (None, "none", "y", None, 3), ("a", "again", "xx", "d", 4)]),
    ("s2", [("a", "other", "longer", "e", 5), ("c", "C", "y", None, 6)]),
    ("s3", [("c", "C", "y", "f", 7)]),
    ("s4", [("b", "B", "back", None, 8), ("c", "C", "y", "g", 9)]),
]
#: After each scan: key -> title, body, date, seen.
WANT = [
    {"a": ("A", "xx", "d", "s1"), "b": ("B", "", None, "s1")},
    {"a": ("A", "longer", "d", "s2"), "b": ("B", "", None, "s1"), "c": ("C", "y", None, "s2")},
    {"a": ("A", "longer", "d", "s2"), "b": ("B", "", None, "s1"), "c": ("C", "y", "f", "s3")},
    {"a": ("A", "longer", "d", "s2"), "b": ("B", "back", None, "s4"), "c": ("C", "y", "f", "s4")},
]


def rows(spark, k):
    return spark.createDataFrame(SCANS[k][1], SCHEMA)


def state(spark, path, at=None):
    return {r.key: (r.title, r.body, r.date, r.seen) for r in V.archive_seen(spark, path, at=at).collect()}


def test_scans_versions_and_pinned_readers(spark, tmp_path):
    path, held = f"file://{tmp_path}/v", []
    for k, (scan, _) in enumerate(SCANS):
        at = V.commit_scan(rows(spark, k), path, scan, buckets=4)
        assert at.n == k + 1 and state(spark, path) == WANT[k]
        held.append(V.archive_seen(spark, path))
    for k, df in enumerate(held):  # readers of older versions
        assert {r.key: (r.title, r.body, r.date, r.seen) for r in df.collect()} == WANT[k] == state(spark, path, V.version(spark, path, k + 1))
    sparse = {r.key: r.seen for r in V.table(spark, path, "seen", V.version(spark, path)).collect()}
    assert sparse == {"a": "s2"}  # exceptions alone
    assert V.vacuum(spark, path, keep=1) > 0 and V.versions(spark, path) == [4] and state(spark, path) == WANT[3]
    assert V.vacuum(spark, path, keep=1) == 0


def test_untouched_buckets_stay_where_they_are(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    many = spark.range(64).selectExpr("cast(id AS string) AS key", "'t' AS title", "'x' AS body", "cast(NULL AS string) AS date", "cast(id AS int) AS seq")
    before = V.commit_scan(many, path, "s1", buckets=16)
    after = V.commit_scan(many.where("key = '7'"), path, "s2", buckets=99)  # the number of buckets is that of the first commit
    moved = [b for b, p in after.tables["archive"][1].items() if before.tables["archive"][1][b] != p]
    assert len(before.tables["archive"][1]) > 8 and len(moved) == 1
    assert V.archive_seen(spark, path).where("seen = 's1'").count() == 63


@pytest.mark.parametrize("step", ["archive", "seen", "manifest"])
def test_killed_after_each_step_both_tables_agree(spark, tmp_path, monkeypatch, step):
    path = f"file://{tmp_path}/v"
    V.commit_scan(rows(spark, 0), path, "s1", run="r", epoch=0, buckets=4)
    write, commit = V.write_parts, V.commit

    def killed_write(df, at, name, *rest):
        out = write(df, at, name, *rest)
        if name == step:
            raise RuntimeError("killed")
        return out

    def killed_commit(session, at, before, tables, facts):
        real = V._fs

        class NoRename:
            def __init__(self, fs):
                self.fs = fs

            def __getattr__(self, name):
                return getattr(self.fs, name)

            def rename(self, *_):
                raise RuntimeError("killed")

        monkeypatch.setattr(V, "_fs", lambda s, p: (NoRename(real(s, p)[0]), real(s, p)[1]))
        try:
            return commit(session, at, before, tables, facts)
        finally:
            monkeypatch.setattr(V, "_fs", real)

    monkeypatch.setattr(V, "write_parts", killed_write)
    if step == "manifest":
        monkeypatch.setattr(V, "commit", killed_commit)
    with pytest.raises(RuntimeError, match="killed"):
        V.commit_scan(rows(spark, 1), path, "s2", run="r", epoch=1)
    assert state(spark, path) == WANT[0] and V.version(spark, path).facts["scan"] == "s1"
    monkeypatch.setattr(V, "write_parts", write)
    monkeypatch.setattr(V, "commit", commit)
    for _ in range(2):  # the second time the epoch is known
        assert V.commit_scan(rows(spark, 1), path, "s2", run="r", epoch=1).n == 2
        assert state(spark, path) == WANT[1]
    assert V.vacuum(spark, path, keep=2) >= 1 and state(spark, path) == WANT[1]


def test_another_commit_in_between_is_refused(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    first = V.commit_scan(rows(spark, 0), path, "s1", buckets=4)
    V.commit(spark, path, first, {}, {"scan": "x"})
    with pytest.raises(FileExistsError):
        V.commit(spark, path, first, {}, {"scan": "y"})
    assert V.version(spark, path).facts["scan"] == "x"


def test_stream_of_scans(spark, tmp_path):
    path, source = f"file://{tmp_path}/v", str(tmp_path / "in")
    schema = SCHEMA + ", scan string"
    for k, (scan, _) in enumerate(SCANS):
        rows(spark, k).selectExpr("*", f"'{scan}' AS scan").coalesce(1).write.mode("append").json(source)
        V.run_scans(spark.readStream.schema(schema).json(source), path, str(tmp_path / "cp"), "daily", "scan", buckets=4).awaitTermination()
    assert state(spark, path) == WANT[3] and V.version(spark, path).n == 4


def test_counters_and_collapse(spark, tmp_path):
    """A scan that is too small against the one before leaves no version; counters are those of each scan."""
    path = f"file://{tmp_path}/v"
    counters = [V.commit_scan(rows(spark, k), path, s, buckets=4, ratio=0.5).facts["counters"] for k, (s, _) in enumerate(SCANS[:2])]
    assert [{n: c[n] for n in ("rows", "keyed", "with_body", "with_date")} for c in counters] == [{"rows": 4, "keyed": 3, "with_body": 2, "with_date": 1}, {"rows": 2, "keyed": 2, "with_body": 2, "with_date": 1}]
    before = state(spark, path)
    with pytest.raises(CorpusCollapse):
        V.commit_scan(rows(spark, 2).limit(0), path, "s3", buckets=4, ratio=0.5)
    assert V.versions(spark, path) == [1, 2] and state(spark, path) == before
    assert V.commit_scan(rows(spark, 2), path, "s3", buckets=4, ratio=0.5).n == 3  # int(2 * 0.5) = 1 row is enough
    with pytest.raises(CorpusCollapse):
        V.commit_scan(rows(spark, 3).where("seq > 99"), path, "s4", buckets=4, ratio=1.0)
