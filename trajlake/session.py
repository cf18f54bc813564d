"""Session defaults and the shared work folder of multi-stage operators."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings that the operators assume; none of them depends on the size of the data.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "trajlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; master is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or (unset, as in tests) a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"trajlake-{os.getpid()}")
    os.makedirs(own, exist_ok=True)
    return f"file://{own}"


#: Work tables of this process that are still there.
_TABLES: list[str] = []


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p, fs = _file_system(spark, path)
        fs.delete(p, True)
    except Exception:  # noqa: BLE001 - the session may have ended before the interpreter
        if path.startswith("file:"):
            shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)


def release(spark: SparkSession) -> None:
    """Remove the work tables written so far; results that were not computed yet can't be any more."""
    while _TABLES:
        _remove(spark, _TABLES.pop())


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, with its scheme; removed by release(), at the latest when the interpreter ends."""
    p, fs = _file_system(spark, f"{shared_dir(spark)}/trajlake/{name}-{uuid.uuid4().hex}")
    path = fs.makeQualified(p).toString()
    if not _TABLES:
        atexit.unregister(release)
        atexit.register(release, spark)
    _TABLES.append(path)
    return path


def work_table(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared folder and read it back: cuts the lineage and survives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
