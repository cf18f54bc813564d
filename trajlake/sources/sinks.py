"""Sinks: JSON lines, staged publishing, fan-out by group, checksums and summaries.

Data is written by Spark into a staging folder beside the target and renamed when every check has
passed, so a reader sees the whole output or none of it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajlake.session import work_table


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder or file over whatever is at target."""
    s, fs = _fs(spark, source)
    t, _ = _fs(spark, target)
    fs.delete(t, True)
    if not fs.rename(s, t):
        raise OSError(f"{source} can't be moved to {target}")


def publish(spark: SparkSession, target: str, write: Callable[[str], None], check: Callable[[str], None] | None = None) -> None:
    """write(staging path), check(staging path), then one rename; the staging folder goes if either fails."""
    staging = f"{target.rstrip('/')}.{uuid.uuid4().hex}.tmp"
    try:
        write(staging)
        if check:
            check(staging)
        rename(spark, staging, target)
    except BaseException:
        delete(spark, staging)
        raise


def json_lines(rows: DataFrame) -> DataFrame:
    """One compact JSON text a row; fields that are null are left out, other scripts stay as they are."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def require_rows(spark: SparkSession, path: str, wanted: int) -> None:
    got = spark.read.text(path).count()
    if got != wanted:
        raise ValueError(f"{got} rows written where {wanted} were expected")


def write_jsonl(rows: DataFrame, path: str, order: list[Column | str] | None = None, files: int | None = None, expected: int | None = None) -> None:
    """rows as JSON lines in a folder, in order if given (files are ordered by name, lines within a file).

    files: how many at most; 1 gives a single file, which suits small outputs only. expected: number of
    rows; another one raises and nothing is published.
    """
    spark = rows.sparkSession
    ordered = rows.orderBy(*order) if order else rows
    lines = json_lines(ordered)
    if files:
        lines = lines.coalesce(files)
    publish(spark, path, lambda p: lines.write.text(p), None if expected is None else lambda p: require_rows(spark, p, expected))


def write_groups(rows: DataFrame, group: str, path: str, groups: list[str]) -> dict[str, int]:
    """One folder of JSON lines for each group, published together when the counts agree; rows per group.

    A value of group that isn't in groups raises. An empty group has no folder.
    """
    spark = rows.sparkSession
    # counted and written from one table, so that both see the same rows and the plan runs once
    rows = work_table(rows, "groups")
    wanted = {r[group]: r["n"] for r in rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).collect()}
    if unknown := set(wanted) - set(groups):
        raise ValueError(f"unknown groups: {sorted(map(str, unknown))}")
    body = [c for c in rows.columns if c != group]

    def write(staging):
        rows.select(F.to_json(F.struct(*body)).alias("value"), F.col(group).alias("group")).write.partitionBy("group").text(staging)

    def check(staging):
        if not wanted:
            return
        got = {str(r["group"]): r["n"] for r in spark.read.text(staging).groupBy("group").agg(F.count(F.lit(1)).alias("n")).collect()}
        if got != {str(k): v for k, v in wanted.items()}:
            raise ValueError(f"groups written {got}, expected {wanted}")

    publish(spark, path, write, check)
    return {g: wanted.get(g, 0) for g in groups}


#: Files up to this size are hashed by the executors, each in one row; larger ones are streamed.
ONE_ROW = 1 << 29


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes and sha256 of every file under path, on any file system Spark can read.

    Files of more than ONE_ROW bytes are streamed through the driver, one after the other, without being
    held; writers that want them hashed in parallel keep their files smaller.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    name = F.url_decode(F.regexp_extract("path", r"([^/]+)$", 1)).alias("file")
    small = files.filter(F.col("length") <= ONE_ROW).select(name, F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.filter(F.col("length") > ONE_ROW).select("path", name, "length").collect()
    digest = spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils
    rows = []
    for r in large:
        p, fs = _fs(spark, r["path"])
        stream = fs.open(p)
        try:
            rows.append((r["file"], r["length"], digest.sha256Hex(stream)))
        finally:
            stream.close()
    return small.unionByName(spark.createDataFrame(rows, "file string, bytes bigint, sha256 string")) if rows else small


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, published whole."""

    def write(staging):
        p, fs = _fs(spark, staging)
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    publish(spark, path, write)


def write_summary(spark: SparkSession, path: str, summary: dict) -> str:
    """The summary as indented JSON with sorted keys, in one file; returns the text."""
    text = json.dumps(summary, ensure_ascii=False, indent=2, sort_keys=True, default=str)
    put_text(spark, path, text + "\n")
    return text


def files_in(spark: SparkSession, path: str, ending: str) -> list[str]:
    """Names of the files in a folder, sorted."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName().endswith(ending))


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def nested_counts(rows: DataFrame, levels: list[str], most: int = 100_000) -> dict:
    """{value: {value: records}} of small grouped counts, nulls as 'None'; ValueError beyond `most` groups."""
    counts = rows.groupBy(*levels).agg(F.count(F.lit(1)).alias("_n")).limit(most + 1).collect()
    if len(counts) > most:
        raise ValueError(f"more than {most} groups")
    out: dict = {}
    for r in counts:
        at = out
        for level in levels[:-1]:
            at = at.setdefault(str(r[level]), {})
        at[str(r[levels[-1]])] = r["_n"]
    return out


def without_text(rows: DataFrame, allowed: list[str]) -> DataFrame:
    """Only the allowed columns, for reports that must not hold message texts; a missing one raises."""
    if gone := [c for c in allowed if c not in rows.columns]:
        raise ValueError(f"no columns {gone}")
    return rows.select(*allowed)
