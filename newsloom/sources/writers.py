"""Writers: flat CSV, JSON lines, staged rewrites, merges into an archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def flat(df: DataFrame, joined: dict[str, str] | None = None) -> DataFrame:
    """Scalar columns only: arrays are joined (", " unless `joined` says otherwise), structs and maps become JSON."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "array<string>":
            c = F.concat_ws((joined or {}).get(name, ", "), c)
        elif kind.startswith(("array", "struct", "map")):
            c = F.to_json(c)
        cols.append(c.alias(name))
    return df.select(*cols)


def export_csv(df: DataFrame, path: str, joined: dict[str, str] | None = None) -> None:
    flat(df, joined).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def append_lines(df: DataFrame, path: str) -> int:
    """Appends JSON lines and returns how many; writes nothing if there are none."""
    n = Observation()
    if df.isEmpty():
        return 0
    df.observe(n, F.count(F.lit(1)).alias("n")).write.mode("append").json(path)
    return n.get["n"]


def _fs(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def staged_path(path: str) -> str:
    """Where what replaces `path`, or some of its partitions, is written first."""
    return f"{path.rstrip('/')}.next"


def _move(fs, source, target) -> None:
    fs.delete(target, True)
    if not fs.rename(source, target):
        raise OSError(f"{source} could not be moved to {target}")


def recover(spark: SparkSession, path: str) -> None:
    """Ends a swap that broke off. What is staged whole (it has its _SUCCESS) takes its place; the rest of a broken write goes."""
    fs, staged = _fs(spark, staged_path(path))
    if not fs.exists(staged):
        return
    if fs.exists(_fs(spark, staged_path(path) + "/_SUCCESS")[1]):
        swap(spark, path)
    else:
        fs.delete(staged, True)


def swap(spark: SparkSession, path: str) -> None:
    """Puts the folder staged beside `path` in its place, or its partitions in that of theirs where it has any.

    Until the last part has moved, the staged folder and its _SUCCESS stand, so that `recover` ends what breaks off in between.
    Any part is either in its place or staged at all times.
    """
    fs, target = _fs(spark, path)
    staged = _fs(spark, staged_path(path))[1]
    parts = [s.getPath() for s in fs.listStatus(staged) if s.isDirectory() and "=" in s.getPath().getName()]
    whole = not parts and not (fs.exists(target) and any(s.isDirectory() and "=" in s.getPath().getName() for s in fs.listStatus(target)))
    if whole:
        _move(fs, staged, target)
        return
    fs.mkdirs(target)
    for part in parts:
        _move(fs, part, _fs(spark, f"{path.rstrip('/')}/{part.getName()}")[1])
    fs.delete(staged, True)


def rewrite(df: DataFrame, path: str, changed: bool = True) -> None:
    """Replaces a folder of JSON lines, also one that df reads: written beside it, then swapped."""
    if not changed:
        return
    df.write.mode("overwrite").json(staged_path(path))
    swap(df.sparkSession, path)


def review_file(df: DataFrame, path: str) -> None:
    """Rows to label by hand, with pertinent null."""
    df.withColumn("pertinent", F.lit(None).cast("boolean")).write.mode("overwrite").option("ignoreNullFields", False).json(path)
