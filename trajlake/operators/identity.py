"""Which task a record belongs to: by source, by position, by text, in this order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.functions.labels import cases
from trajlake.session import work_table

from .stats import join_on_nullable


def manifest_index(manifest: DataFrame, instruction: Column, output: Column, order: list[str]) -> DataFrame:
    """version, task, text, source, ordinal of every manifest row with an instruction and a task.

    manifest: columns v and task_id besides. source is the file name of output; the ordinal is the row's
    place among its version's rows by source, or by task where there is no output, ties by order.
    """
    rows = manifest.select(F.col("v").alias("version"), F.col("task_id").alias("task"), instruction.alias("text"), F.regexp_extract(output, r"([^/]+)/*$", 1).alias("source"), *order)
    rows = rows.withColumn("source", F.when(F.col("source") != "", F.col("source"))).filter("text IS NOT NULL AND task IS NOT NULL")
    return numbered(rows.withColumn("_key", F.coalesce("source", "task")), "version", ["_key", *order]).drop("_key", *order)


#: Rows that one task may number; more are numbered by ranges.
ONE_TASK = 1_000_000


def numbered(rows: DataFrame, group: str, order: list[str], one_task: int = ONE_TASK) -> DataFrame:
    """rows with ordinal, their 1-based place in their group by order (columns), without a task that gets a whole large group.

    Many rows are sorted into ranges over the cluster; a row's place is its place in its range plus the
    rows of the group in the ranges before, of which there is one count for each range and group.
    """
    rows = work_table(rows, "to_number")
    if rows.count() <= one_task:
        return rows.withColumn("ordinal", F.row_number().over(Window.partitionBy(group).orderBy(*order)))
    ranges = work_table(rows.repartitionByRange(group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranges.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_range")) - F.col("_n")
    inside = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order))
    placed = join_on_nullable(ranges.withColumn("_inside", inside), counts.select(group, "_range", before.alias("_before")), [group, "_range"])
    return placed.withColumn("ordinal", (F.col("_inside") + F.col("_before")).cast("int")).drop("_range", "_inside", "_before")


def _unique(index: DataFrame, column: str, name: str) -> DataFrame:
    """version, column and task where the column tells exactly one task."""
    rows = index.filter(F.col(column).isNotNull()).groupBy("version", column).agg(F.min("task").alias(name), F.max("task").alias("_hi"))
    return rows.filter(F.col(name) == F.col("_hi")).drop("_hi")


def resolve(records: DataFrame, index: DataFrame) -> DataFrame:
    """records (version, source, line, text) with task and method: source, position, unique_text or unresolved.

    Three left joins on equal keys; a text that many records share is skewed on the records' side only,
    which adaptive execution splits, as the index has one row a key.
    """
    by_source = _unique(index, "source", "_by_source")
    by_text = _unique(index, "text", "_by_text")
    by_place = index.select("version", F.col("ordinal").alias("line"), F.col("text").alias("_text"), F.col("task").alias("_by_place"))
    rows = records.join(by_source, ["version", "source"], "left").join(by_place, ["version", "line"], "left").join(by_text, ["version", "text"], "left")
    place = F.when(F.col("_text") == F.col("text"), F.col("_by_place"))
    method = cases([(F.col("_by_source").isNotNull(), "source"), (place.isNotNull(), "position"), (F.col("_by_text").isNotNull(), "unique_text")], F.lit("unresolved"))
    return rows.select(*records.columns, F.coalesce("_by_source", place, "_by_text").alias("task"), method.alias("method"))
