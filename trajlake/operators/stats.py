"""Exact statistics: nearest-rank percentiles, shares, weighted ratios, grouped summaries.

Percentiles are the element at round-half-even((n - 1) x r) of the sorted values, which no built-in
gives. They are computed by counting: equal values are added up before the shuffle, and ranks come
from running sums over the distinct values. Of many distinct values (ratios have nearly as many as
rows) the counts are sorted into ranges over the cluster; the totals of the ranges tell in which one a
rank lies, and only that one is looked through. No task gets a group's values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.session import work_table


#: Distinct values that one task may rank in memory; more are ranked by ranges.
ONE_TASK = 1_000_000


def _ranked(counts: DataFrame, by: list[str], wanted: list[tuple[str, float]], one_task: int) -> DataFrame:
    """counts (by, _f, _v, _n) with _upto, the values up to this one, and _total; where there are more than
    one_task of them, only those of the ranges in which a wanted rank lies."""
    group = [*by, "_f"]
    upto = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = work_table(counts, "value_counts")
    if counts.count() <= one_task:
        return counts.withColumns({"_upto": F.sum("_n").over(upto), "_total": F.sum("_n").over(Window.partitionBy(*group))})
    ranges = work_table(counts.repartitionByRange(*group, "_v").withColumn("_p", F.spark_partition_id()), "value_ranges")
    # one row for each range and group in it: at most the groups and the ranges together
    sums = ranges.groupBy(*group, "_p").agg(F.sum("_n").alias("_in"))
    order = Window.partitionBy(*group).orderBy("_p")
    sums = sums.withColumns({"_before": F.sum("_in").over(order) - F.col("_in"), "_total": F.sum("_in").over(Window.partitionBy(*group))})
    rank = lambda r: F.rint((F.col("_total") - 1) * F.lit(r))
    hit = F.lit(False)
    for f, r in wanted:
        hit = hit | ((F.col("_f") == f) & (F.col("_before") <= rank(r)) & (rank(r) < F.col("_before") + F.col("_in")))
    found = join_on_nullable(sums.filter(hit), ranges, [*group, "_p"], "inner")
    inside = Window.partitionBy(*group, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return found.withColumn("_upto", F.col("_before") + F.sum("_n").over(inside))


def nearest_rank(df: DataFrame, by: list[str], values: list[str], ratios: list[float], one_task: int = ONE_TASK) -> DataFrame:
    """One row a group: by, and <value>_p<percent> for every value and ratio; null values are left out.

    A group whose values are all null has null percentiles. by may be empty: one row, of nulls for no rows.
    """
    rows = df.select(*by, F.explode(F.array(*(F.struct(F.lit(v).alias("_f"), F.col(v).cast("double").alias("_v")) for v in values))).alias("_x")).select(*by, "_x.*")
    counts = rows.groupBy(*by, "_f", "_v").agg(F.count(F.lit(1)).alias("_n"))
    # nulls count nothing, but keep their group
    counts = counts.withColumn("_n", F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0))
    ranked = _ranked(counts, by, [(v, r) for v in values for r in ratios], one_task)
    wanted = []
    for v in values:
        for r in ratios:
            rank = F.rint((F.col("_total") - 1) * F.lit(r))
            here = (F.col("_f") == v) & (F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank)
            wanted.append(F.max(F.when(here, F.col("_v"))).alias(f"{v}_p{round(r * 100):02d}"))
    found = ranked.groupBy(*by).agg(*wanted)
    if not by:
        return found
    # groups without any value of which a rank was looked for
    groups = counts.select(*by).distinct()
    return join_on_nullable(groups, found, by)


def join_on_nullable(left: DataFrame, right: DataFrame, by: list[str], how: str = "left") -> DataFrame:
    """Join on equal values, with null equal to null; the columns of by come from the left."""
    condition = None
    for c in by:
        same = F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        condition = same if condition is None else condition & same
    return left.alias("l").join(right.alias("r"), condition, how).select(F.col("l.*"), *(F.col(f"r.{c}") for c in right.columns if c not in by))


def weighted_ratio(part: Column | str, whole: Column | str) -> Column:
    """Sum of part over sum of whole (at least 1), rounded half-even to six places; an aggregate."""
    return F.bround(F.coalesce(F.sum(part), F.lit(0)) / F.greatest(F.lit(1), F.coalesce(F.sum(whole), F.lit(0))), 6)


def group_summary(df: DataFrame, by: list[str], tokens: str, supervised: str, ratios=(0.5, 0.95)) -> DataFrame:
    """Per group: records, sums of both counts, their ratio, percentiles and largest of tokens. Null keys are a group."""
    sums = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records"),
        F.coalesce(F.sum(tokens), F.lit(0)).alias(tokens),
        F.coalesce(F.sum(supervised), F.lit(0)).alias(supervised),
        weighted_ratio(supervised, tokens).alias("weighted_ratio"),
        F.coalesce(F.max(tokens), F.lit(0)).alias("largest"),
    )
    return join_on_nullable(sums, nearest_rank(df, by, [tokens], list(ratios)), by)


def histogram(df: DataFrame, bucket: Column, weight: str, order: Column) -> DataFrame:
    """bucket, position, records, weight and the shares of both in the whole; only buckets that occur."""
    counts = df.groupBy(bucket.alias("bucket")).agg(F.min(order).alias("position"), F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(weight), F.lit(0)).alias(weight))
    # one row a bucket, so the window over all of them is small
    total = Window.partitionBy(F.lit(0))
    share = lambda c: F.bround(F.col(c) / F.greatest(F.lit(1), F.sum(c).over(total)), 6)
    return counts.select("*", share("records").alias("record_share"), share(weight).alias("weight_share"))


def distribution(df: DataFrame, fields: list[str]) -> DataFrame:
    """One row a field: rows above zero, total to six places, p50, p95, p99 and largest value."""
    long = df.select(F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("double").alias("value")) for f in fields))).alias("x")).select("x.*")
    sums = long.groupBy("field").agg(F.count_if(F.col("value") > 0).alias("records_nonzero"), F.bround(F.coalesce(F.sum("value"), F.lit(0.0)), 6).alias("total"), F.coalesce(F.max("value"), F.lit(0.0)).alias("largest"))
    return sums.join(nearest_rank(long, ["field"], ["value"], [0.5, 0.95, 0.99]), "field", "left").select("field", "records_nonzero", "total", F.col("value_p50").alias("p50"), F.col("value_p95").alias("p95"), F.col("value_p99").alias("p99"), "largest")


def median_truncated(c: str) -> Column:
    """The mean of the middle values, cut to an integer; an aggregate, not the p50 of nearest_rank."""
    return F.percentile(c, F.lit(0.5)).cast("bigint")


def duplicate_groups(df: DataFrame, by: list[str]) -> DataFrame:
    """One row: how many groups of by have more than one row, and how many rows those have."""
    many = df.groupBy(*by).count().filter(F.col("count") > 1)
    return many.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("count"), F.lit(0)).alias("records"))


def counts_by(df: DataFrame, sets: list[list[str]], *extra: Column) -> DataFrame:
    """One scan for several group-bys: `grouping` names the columns of the set, the others are null."""
    columns = list(dict.fromkeys(c for s in sets for c in s))
    named = {c: F.col(c) for c in columns}
    spread = F.array(*(F.struct(F.lit("+".join(s) or "all").alias("grouping"), *((named[c] if c in s else F.lit(None).cast(df.schema[c].dataType)).alias(c) for c in columns)) for s in sets))
    rest = [c for c in df.columns if c not in columns]
    return df.select(F.explode(spread).alias("_g"), *rest).select("_g.*", *rest).groupBy("grouping", *columns).agg(F.count(F.lit(1)).alias("records"), *extra)
