"""The pN_ queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajlake.functions import keys
from trajlake.session import work_table
from trajlake.sources.tables import table

from . import budget, cap, encode, overlap, pack, pieces, plan_table, regroup, repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return keep


def none(columns: str) -> str:
    """SQL of no row: what a query of broken rules must give."""
    named = [c.split() for c in columns.split(", ")]
    return "SELECT " + ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in named) + " WHERE false"


@query("p6_ids")
def p6_ids(spark, folder):
    """Ids of every document by byte_bpe_50k."""
    return encode.encode_ids(table(spark, folder, "documents"))


def _budget(spark, folder):
    return budget.record_budget(table(spark, folder, "token_catalog"), table(spark, folder, "trajectories"))


@query("p3_found", f"SELECT DISTINCT record_id FROM token_catalog WHERE {budget.UNUSABLE_SQL}")
def p3_found(spark, folder):
    """Records whose catalog count can't be used."""
    return budget.found_unusable(_budget(spark, folder))


@query("p3_records")
def p3_records(spark, folder):
    """Tokens of the records per source_family and type."""
    return budget.budget_by_family(_budget(spark, folder))


@query("p3_documents")
def p3_documents(spark, folder):
    """Tokens of the documents per source, lang and domain."""
    return budget.document_budget(table(spark, folder, "documents"))


def _limit(spark, folder, purpose):
    """The row of size_limits, a fixed table of two rows."""
    return table(spark, folder, "size_limits").filter(F.col("purpose") == purpose).first()


def _packed(spark, folder):
    docs = table(spark, folder, "documents")
    capacity = _limit(spark, folder, "container")["max_tokens"]
    return pack.pack(encode.token_counts(docs), capacity, n_items=docs.count()), capacity


@query("p7_found")
def p7_found(spark, folder):
    """Documents larger than a container."""
    return pack.divided(_packed(spark, folder)[0])


@query("p7_containers")
def p7_containers(spark, folder):
    """The container of every part of every document."""
    return _packed(spark, folder)[0]


@query("p7_violated", none("container_id BIGINT, tokens BIGINT, parts BIGINT, cost DOUBLE"))
def p7_violated(spark, folder):
    """Containers that break a constraint; none."""
    return pack.violated(*_packed(spark, folder))


@query("p7_fill")
def p7_fill(spark, folder):
    """How full the containers are."""
    return pack.fill_report(*_packed(spark, folder))


def _pieces(spark, folder):
    limit = _limit(spark, folder, "piece")
    return pieces.split(table(spark, folder, "documents"), limit["max_tokens"], limit["overlap_tokens"])


@query("p8_found")
def p8_found(spark, folder):
    """Documents larger than a piece."""
    return pieces.oversized(_pieces(spark, folder))


@query("p8_pieces")
def p8_pieces(spark, folder):
    """The pieces of every document that is larger than a piece."""
    return _pieces(spark, folder)


@query("p8_violated", none("doc_id BIGINT, piece BIGINT, fault VARCHAR"))
def p8_violated(spark, folder):
    """Pieces that break a rule (limit, overlap, order, end of the text); none."""
    limit, docs = _limit(spark, folder, "piece"), table(spark, folder, "documents")
    return pieces.violated(_pieces(spark, folder), encode.token_counts(docs), limit["max_tokens"], limit["overlap_tokens"])


CAP = 3
#: Of all planned records, the share that one contributor may hold in p4_share.
SHARE = 0.002

P4_SQL = f"""WITH {plan_table.PLANNED_SQL},
ranked AS (SELECT record_id, row_number() OVER (PARTITION BY task, family ORDER BY coalesce(tier_rank, 1000000), record_id) AS n
  FROM planned LEFT JOIN (SELECT {keys.tier_sql('quality_tier')} AS tier, min(tier_rank) AS tier_rank FROM tier_order GROUP BY 1) USING (tier))
"""


def _capped(spark, folder, draw, most=CAP):
    rows = plan_table.planned(table(spark, folder, "dataset_plan"))
    # a fixed table of four rows
    order = table(spark, folder, "tier_order").groupBy(keys.tier_key(F.col("quality_tier")).alias("tier")).agg(F.min("tier_rank").alias("tier_rank"))
    rows = rows.join(F.broadcast(order), "tier", "left")
    tier = F.coalesce("tier_rank", F.lit(1_000_000))
    # by tier, then by the smaller record_id: scores too far apart for the draw to change their order
    if draw == "sure":
        return rows, cap.keep_per_contributor(rows, ["task", "family"], most, "record_id", tier, cap.sure_order(F.col("record_id")))
    # a draw over all tiers: each tier weighs half of the tier before it
    return rows, cap.keep_per_contributor(rows, ["task", "family"], most, "record_id", F.lit(0), F.least(tier, F.lit(20)) * F.log(F.lit(0.5)))


@query("p4_found", P4_SQL + f"SELECT record_id FROM ranked WHERE n > {CAP}")
def p4_found(spark, folder):
    """Planned records to give up."""
    return cap.given_up(*_capped(spark, folder, "sure"), "record_id")


@query("p4_plan", P4_SQL + f"SELECT task, family, record_id FROM planned WHERE record_id IN (SELECT record_id FROM ranked WHERE n <= {CAP})")
def p4_plan(spark, folder):
    """The capped plan: records that stay, with their contributor."""
    return _capped(spark, folder, "sure")[1]


@query("p4_share", P4_SQL + f"SELECT task, family, record_id FROM planned WHERE record_id IN (SELECT record_id FROM ranked WHERE n <= (SELECT greatest(1, floor(count(*) * {SHARE})) FROM planned))")
def p4_share(spark, folder):
    """A plan in which no contributor holds more than SHARE of the records there were."""
    rows = plan_table.planned(table(spark, folder, "dataset_plan"))
    return _capped(spark, folder, "sure", cap.share_cap(rows, SHARE))[1]


@query("p4_sample")
def p4_sample(spark, folder):
    """A capped plan by weighted draw: better tiers stay more often, but none always."""
    return _capped(spark, folder, "random")[1]


def _components(spark, folder):
    rows = work_table(plan_table.planned(table(spark, folder, "dataset_plan")), "planned")
    return rows, regroup.components(rows, "record_id", "task")


@query(
    "p5_found",
    f"""WITH {plan_table.PLANNED_SQL} SELECT record_id FROM planned WHERE split IS NOT NULL AND task IN
(SELECT task FROM planned GROUP BY task HAVING count(DISTINCT split) > 1)""",
)
def p5_found(spark, folder):
    """Planned records whose task stands in more than one split."""
    rows, parts = _components(spark, folder)
    return regroup.conflicting(rows, parts, "record_id", "split")


def _regrouped(spark, folder):
    rows, parts = _components(spark, folder)
    # a fixed table of three rows
    shares = {r["split_name"]: r["share"] for r in table(spark, folder, "split_shares").collect()}
    return rows, regroup.new_splits(rows, parts, shares, "record_id", F.concat_ws("|", "family", "type"))


@query("p5_splits")
def p5_splits(spark, folder):
    """A split for every planned record, with each task in one split."""
    return _regrouped(spark, folder)[1]


@query("p5_balance")
def p5_balance(spark, folder):
    """Records per new split, family and type, and the split's share of the family and type."""
    rows, chosen = _regrouped(spark, folder)
    counts = rows.join(chosen, "record_id").groupBy("family", "type", "new_split").agg(F.count(F.lit(1)).alias("records"))
    return counts.withColumn("share", F.round(F.col("records") / F.sum("records").over(Window.partitionBy("family", "type")), 6))


@query("p5_violated", none("task VARCHAR, fault VARCHAR"))
def p5_violated(spark, folder):
    """Tasks in more than one new split, or with a record that has none; none."""
    rows, chosen = _regrouped(spark, folder)
    tasks = rows.join(chosen, "record_id", "left").groupBy("task").agg(F.min("new_split").alias("lo"), F.max("new_split").alias("hi"), F.count_if(F.col("new_split").isNull()).alias("without"))
    # records without a task are groups of their own
    fault = F.when(F.col("without") > 0, "record without split").when(F.col("task").isNotNull() & (F.col("lo") < F.col("hi")), "several splits")
    return tasks.select("task", fault.alias("fault")).filter("fault IS NOT NULL")


def _repeat_items(spark, folder):
    yield repeats.trajectory_items(table(spark, folder, "trajectories")), repeats.TRAJECTORIES
    yield repeats.document_items(table(spark, folder, "documents")), repeats.DOCUMENTS


@query("p2_found")
def p2_found(spark, folder):
    """Records and documents that repeat themselves."""
    a, b = (repeats.found(*x) for x in _repeat_items(spark, folder))
    return a.unionByName(b)


@query("p2_shares")
def p2_shares(spark, folder):
    """The share of repeated content of every record and document."""
    a, b = (repeats.shares(*x) for x in _repeat_items(spark, folder))
    return a.unionByName(b)


def _sequences(spark, folder):
    rows = plan_table.planned(table(spark, folder, "dataset_plan")).filter("split IS NOT NULL")
    sides = rows.select("record_id", F.when(F.col("split") == "train", "a").otherwise("b").alias("side"))
    records = table(spark, folder, "trajectories").select("record_id", overlap.conversation().alias("text"))
    return rows, overlap.sequences(records, sides)


@query("p1_found")
def p1_found(spark, folder):
    """Pairs of a train and a validation or test record whose conversations are the same or almost."""
    _, seqs = _sequences(spark, folder)
    return overlap.record_pairs(overlap.similar_classes(seqs), overlap.members(seqs))


def _links(spark, folder):
    rows, seqs = _sequences(spark, folder)
    frequent = overlap.frequent_prints(seqs, "record_id")
    shared = overlap.shared_prints(seqs, frequent=frequent)
    links = overlap.class_links(overlap.similar_classes(seqs, shared), overlap.members(seqs), overlap.containment(seqs, shared, frequent))
    return links.join(rows.select("record_id", "split", "family"), "record_id")


@query("p1_records")
def p1_records(spark, folder):
    """Class, number of links across splits and coverage of every planned record with a split."""
    return _links(spark, folder).select("record_id", "split", "family", "class_id", "links", "coverage")


@query("p1_report")
def p1_report(spark, folder):
    """Overlapping records per split and source_family."""
    return _links(spark, folder).groupBy("split", "family").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("links") > 0).alias("overlapping"),
        F.sum("links").alias("links"),
        F.count_if((F.col("links") == 0) & (F.col("coverage") >= 0.5)).alias("half_covered"),
        F.round(F.avg("coverage"), 6).alias("mean_coverage"),
    )
