"""Queries that go through files: JSON lines written, checked, read back, hashed."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.functions.labels import LONG_PHASE, output_group
from trajlake.session import work_path
from trajlake.sources import jsonl, sinks

from .catalog_queries import PLANNED, plan_rows
from .registry import query

ORDER = ["phase", "split", "task_id", "record_id"]
GROUPS = ["train_strong_verified", "train_review", "heldout", LONG_PHASE]
SET = f"CASE WHEN phase = '{LONG_PHASE}' THEN phase WHEN coalesce(split <> 'train', true) THEN 'heldout' WHEN quality_tier = 'sql_result_verified' THEN 'train_strong_verified' ELSE 'train_review' END"


def _written(spark, folder):
    """The plan as JSON lines in one ordered file; its folder."""
    path = work_path(spark, "plan_lines")
    rows = plan_rows(spark, folder).select(*ORDER)
    sinks.write_jsonl(rows, path, ORDER, files=1, expected=rows.count())
    return path


@query("plan_lines", f"WITH {PLANNED} SELECT row_number() OVER (ORDER BY phase, split NULLS FIRST, task_id NULLS FIRST, record_id) AS line, phase, split, task_id, record_id FROM plan")
def plan_lines(spark, folder):
    """The plan written as JSON lines and read back with its line numbers."""
    lines = jsonl.read_lines(spark, _written(spark, folder), pattern="part-*")
    schema = T._parse_datatype_string("phase string, split string, task_id string, record_id bigint")
    return jsonl.typed(lines, schema).select("line", *ORDER)


JSON = "'{' || concat_ws(',', '\"phase\":' || to_json(phase)::VARCHAR, '\"split\":' || to_json(split)::VARCHAR, '\"task_id\":' || to_json(task_id)::VARCHAR, '\"record_id\":' || record_id) || '}' || chr(10)"


@query(
    "file_checksums",
    f"WITH {PLANNED}, whole AS (SELECT coalesce(string_agg({JSON}, '' ORDER BY phase, split NULLS FIRST, task_id NULLS FIRST, record_id), '') AS t FROM plan) SELECT strlen(t) AS bytes, sha256(t) AS sha256 FROM whole",
)
def file_checksums(spark, folder):
    """Size and digest of the plan's file."""
    return sinks.checksums(spark, _written(spark, folder)).filter("file LIKE 'part-%'").select("bytes", "sha256")


@query("set_files", f"WITH {PLANNED} SELECT {SET} AS grp, count(*) AS records, sum(record_id)::BIGINT AS ids FROM plan GROUP BY ALL")
def set_files(spark, folder):
    """The plan fanned out to its sets, published together and read back."""
    path = work_path(spark, "plan_sets")
    rows = plan_rows(spark, folder).select(*ORDER, output_group(F.col("phase"), F.col("split"), F.col("quality_tier")).alias("grp"))
    sinks.write_groups(rows, "grp", path, GROUPS)
    back = spark.read.schema("value string, group string").text(path)
    ids = F.from_json("value", "record_id bigint")["record_id"]
    return back.groupBy(F.col("group").alias("grp")).agg(F.count(F.lit(1)).alias("records"), F.sum(ids).alias("ids"))
