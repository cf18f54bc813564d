"""The planned records: dataset_plan with canonical keys, one row a record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajlake.functions import keys

PLANNED_SQL = f"""planned AS (
  SELECT record_id, min({keys.task_sql('task_id')}) AS task, min({keys.family_sql('source_family', 'source_file')}) AS family,
         min({keys.split_sql('split')}) AS split, min({keys.tier_sql('quality_tier')}) AS tier, min({keys.label_sql('type')}) AS type
  FROM dataset_plan WHERE record_id IS NOT NULL GROUP BY record_id)"""


def planned(plan: DataFrame) -> DataFrame:
    """record_id, task, family, split (null if none), tier, type of every planned record, once.

    Repeated rows are equal; should they differ, each column has its smallest value. Null record_ids
    name no record and are left out.
    """
    rows = plan.filter(F.col("record_id").isNotNull()).select(
        "record_id",
        keys.task_key(F.col("task_id")).alias("task"),
        keys.family_key(F.col("source_family"), F.col("source_file")).alias("family"),
        keys.split_key(F.col("split")).alias("split"),
        keys.tier_key(F.col("quality_tier")).alias("tier"),
        keys.label_key(F.col("type")).alias("type"),
    )
    return rows.groupBy("record_id").agg(*(F.min(c).alias(c) for c in ("task", "family", "split", "tier", "type")))
