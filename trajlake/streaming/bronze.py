"""Continuous ingestion of JSON lines and stateless audits of what arrives."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trajlake.operators.audit import audit
from trajlake.sources import jsonl


def stream_lines(spark: SparkSession, folder: str, pattern: str = "*.jsonl", files_per_trigger: int = 100) -> DataFrame:
    """file, line (null: a stream sees no whole files) and value of the lines of new files; blank lines are left out."""
    rows = spark.readStream.option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_trigger).text(folder)
    rows = rows.select(F.col("_metadata.file_name").alias("file"), F.lit(None).cast("bigint").alias("line"), "value")
    return rows.filter(F.length(F.trim("value")) > 0)


def stream_audits(lines: DataFrame) -> DataFrame:
    """file, id, task_id and the audit metrics of every conversation that arrives; no message text, no state."""
    return audit(jsonl.conversations(jsonl.parsed(lines)).drop("line", "source", "tools", "tools_type"))


def status_counts(lines: DataFrame) -> DataFrame:
    """Running counts of lines by file and status (complete or update mode); state is one row a file and status."""
    return jsonl.parsed(lines).groupBy("file", "status").agg(F.count(F.lit(1)).alias("lines"))


def write_table(rows: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append to Parquet with exactly-once files; once: end when everything at hand is written."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer).start(path)
