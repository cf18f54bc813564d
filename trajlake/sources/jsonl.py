"""JSON-lines sources: physical lines, tolerant parsing, typed conversations.

Line numbers are physical and 1-based, blank lines included. They come from the splits of the scan, not
from reading a file into one row: each row's place in its split plus the number of lines in the file's
earlier splits. A file of any size is thereby read by many tasks.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajlake.functions.calls import is_nothing, json_value, variant_text
from trajlake.functions.labels import variant_type

VERSION = r"_(\d{8}_v\d+)_openai\.jsonl$"
#: A message as the operators expect it; content_type and reasoning_type tell values of a wrong type from null.
MESSAGES = "array<struct<role:string,content:string,reasoning_content:string,tool_call_id:string,tool_calls:string,content_type:string,reasoning_type:string>>"


def read_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl", blank: bool = False) -> DataFrame:
    """file (its name), line and value of every line of the files at path; blank lines are left out by default.

    path: a file or a folder. Lines end in \\n, \\r\\n or \\r. The counts of lines per split, one row
    for each split, are joined back; they take a first, cheap pass over the files.
    """
    raw = spark.read.option("pathGlobFilter", pattern).text(path) if pattern else spark.read.text(path)
    rows = raw.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id"))
    blocks = rows.groupBy("path", "start").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.sum("lines").over(Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("before", F.coalesce(before, F.lit(0)))
    rows = rows.join(blocks, ["path", "start"], "left")
    # both scans are planned from one listing; should they ever be split unlike, this stops instead of misnumbering
    within = F.coalesce((F.col("id") >= F.col("first")) & (F.col("id") - F.col("first") < F.col("lines")), F.lit(False))
    numbered = rows.filter(F.assert_true(within, F.lit("the files changed while their lines were numbered")).isNull()).select(
        F.url_decode(F.regexp_extract("path", r"([^/]+)$", 1)).alias("file"),
        (F.col("id") - F.col("first") + F.col("before") + 1).alias("line"),
        "value",
    )
    return numbered if blank else numbered.filter(F.length(F.regexp_replace("value", r"(?U)\s+", "")) > 0)


def first_lines(lines: DataFrame, n: int) -> DataFrame:
    """The first n rows of each file; all of them for n = 0."""
    if not n:
        return lines
    w = Window.partitionBy("file").orderBy("line")
    return lines.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= n).drop("_n")


def file_version(name: Column, strict: bool = True) -> Column:
    """The version in a file name; without one, an error when computed (strict) or null."""
    found = F.regexp_extract(name, VERSION, 1)
    wrong = F.raise_error(F.concat(F.lit("no version in file name "), F.coalesce(name, F.lit("null")))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(found != "", found).otherwise(wrong)


def parsed(lines: DataFrame) -> DataFrame:
    """lines with doc (VARIANT) and status: object, not_object or invalid (no JSON, or more than one value)."""
    rows = lines.withColumn("doc", json_value(F.col("value")))
    kind = variant_type(F.col("doc"))
    return rows.withColumn("status", F.when(F.col("doc").isNull(), "invalid").when(kind == "object", "object").otherwise("not_object"))


def require_objects(rows: DataFrame) -> DataFrame:
    """rows of status object; ValueError that names up to ten lines if there are others."""
    bad = rows.filter("status <> 'object'").select("file", "line", "status").orderBy("file", "line").limit(10).collect()
    if bad:
        raise ValueError(f"lines that are no JSON objects: {[tuple(r) for r in bad]}")
    return rows


def conversations(rows: DataFrame) -> DataFrame:
    """file, line, id, task_id, source, tools (JSON text), tools_type and messages of parsed rows.

    A value of a wrong type is null, with content_type and reasoning_type telling which it was; tool_calls are JSON text
    with sorted keys; missing messages are an empty array.
    """
    doc = F.col("doc")
    messages = F.coalesce(F.try_variant_get(doc, "$.messages", "array<variant>"), F.array().cast("array<variant>"))

    def message(m):
        calls, thought = F.try_variant_get(m, "$.tool_calls", "variant"), F.try_variant_get(m, "$.reasoning_content", "variant")
        return F.struct(
            variant_text(m, "$.role").alias("role"),
            variant_text(m, "$.content").alias("content"),
            variant_text(m, "$.reasoning_content").alias("reasoning_content"),
            variant_text(m, "$.tool_call_id").alias("tool_call_id"),
            F.to_json(calls).alias("tool_calls"),
            variant_type(F.try_variant_get(m, "$.content", "variant")).alias("content_type"),
            F.when(is_nothing(thought), "null").otherwise(variant_type(thought)).alias("reasoning_type"),
        )

    tools = F.try_variant_get(doc, "$.tools", "variant")
    return rows.filter("status = 'object'").select(
        "file",
        "line",
        variant_text(doc, "$.id").alias("id"),
        variant_text(doc, "$.task_id").alias("task_id"),
        variant_text(doc, "$._source").alias("source"),
        F.to_json(tools).alias("tools"),
        variant_type(tools).alias("tools_type"),
        F.transform(messages, message).alias("messages"),
    )


def key_profile(rows: DataFrame) -> DataFrame:
    """How many objects have each top-level key."""
    keys = rows.filter("status = 'object'").select(F.explode(F.json_object_keys("value")).alias("key"))
    return keys.groupBy("key").agg(F.count(F.lit(1)).alias("objects"))


def line_report(rows: DataFrame) -> DataFrame:
    """Lines by file and status, with a row of all files (file null)."""
    return rows.rollup("file", "status").agg(F.count(F.lit(1)).alias("lines")).filter("status IS NOT NULL OR file IS NULL")


def manifest_schema() -> T.StructType:
    return T._parse_datatype_string(
        "v string, task_id string, instruction string, output string, type string, gold_answer string, expected_tables array<string>, "
        "verification_criteria struct<must_query_tables:array<string>>, citation struct<doc_id:string>, source_documents array<string>"
    )


def verdict_schema() -> T.StructType:
    return T._parse_datatype_string("v string, task_id string, verdict string, type string, evidence struct<agent_sql_ok:boolean,is_report:boolean,answer_type:string>")


def typed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """file, line and the fields of schema of every line; a field of another JSON type is null, a JSON value read into a string is its text."""
    rows = lines.select("file", "line", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"))
    return rows.filter("r IS NOT NULL").select("file", "line", "r.*")


# --- companion files by name ---------------------------------------------------------------------


class Layout:
    """Which manifest and verdict file belong to a trajectory file.

    rules: (prefix of the file name, manifest name, verdict names in the order they are tried), where names
    may hold {version} and {suffix}, the number after _v. Special versions are rules of a longer prefix
    or of `only` a suffix.
    """

    def __init__(self, rules: list[tuple]):
        self.rules = rules

    def companions(self, name: str, manifests: str, verdicts: str, must_exist: bool = False, exists=os.path.isfile) -> tuple[str, str]:
        """Paths of manifest and verdict file: the first verdict file that exists, else the first named.

        exists tells whether there is a file at a path. ValueError for a name of no rule or without version; FileNotFoundError if must_exist and none exists.
        """
        import re

        found = re.search(VERSION, name)
        if not found:
            raise ValueError(f"no version in file name {name}")
        version = found.group(1)
        suffix = version.rsplit("_v", 1)[1]
        for prefix, manifest, candidates, *only in self.rules:
            if name.startswith(prefix) and (not only or suffix in only):
                fill = lambda s: s.format(version=version, suffix=suffix)
                paths = [os.path.join(verdicts, fill(c)) for c in candidates]
                present = next((p for p in paths if exists(p)), None)
                if present is None and must_exist:
                    raise FileNotFoundError(paths[0])
                return os.path.join(manifests, fill(manifest)), present or paths[0]
        raise ValueError(f"no rule for {name}")
