"""Splits that keep related records together (problem 5).

Records and entities (tasks, authors, sources) form a bipartite graph. Minimum labels travel along its
edges until none changes; the label of a record is then its group. Groups go to splits so that both
the proportions and the distribution of a label (here family and type) come near the target.

A round costs two pre-aggregated shuffles of the edges. Aggregations reduce a hot entity map-side to a
minimum, and joins look hot keys up by a broadcast (lookup.join_hot), so an entity or a component with a
third of all records is never gathered. Rounds are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trajlake.session import work_table

from .lookup import join_hot

#: Groups up to this share of all records are assigned by cell, larger ones one by one; so at most 1 / BIG are.
BIG = 1 / 1_000
#: Cells per stratum for the groups that aren't big.
CELLS = 64
#: Strata (values of the label) that are told apart; the rest share one.
STRATA = 32


def components(edges: DataFrame, record: str, entity: str, max_rounds: int = 200) -> DataFrame:
    """record and component (the smallest record of it) of every record in edges.

    edges: one row for each record and entity it has; rows repeat without harm, null records are left out. A record whose entity
    is null is a component of its own unless it has another edge. Ends when no label changes; raises
    if that takes more than max_rounds (each round doubles the reach by taking the label of the label).
    """
    edges = edges.select(F.col(record).alias("r"), F.col(entity).alias("e")).filter(F.col("r").isNotNull())
    edges = work_table(edges.distinct(), "edges")
    linked = work_table(edges.filter(F.col("e").isNotNull()), "linked")
    labels = edges.select("r", F.col("r").alias("label")).distinct()
    for _ in range(max_rounds):
        least = join_hot(linked, labels, "r").groupBy("e").agg(F.min("label").alias("label"))
        back = join_hot(linked, least, "e").groupBy("r").agg(F.min("label").alias("new"))
        step = labels.join(back, "r", "left").select("r", F.col("label").alias("old"), F.least("label", F.coalesce("new", "label")).alias("label"))
        # pointer jump: a label's own label may be smaller already
        step = work_table(step, "steps")
        own = step.select(F.col("r").alias("label"), F.col("label").alias("further"))
        step = join_hot(step, own, "label", "left").select("r", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        step = work_table(step, "labels")
        changed = step.filter(F.col("label") < F.col("old")).limit(1).count()
        labels = step.select("r", "label")
        if not changed:
            return labels.select(F.col("r").alias(record), F.col("label").alias("component"))
    raise RuntimeError(f"labels still change after {max_rounds} rounds")


def assign(groups: DataFrame, shares: dict[str, float], seed: int = 17) -> DataFrame:
    """component and new_split, given component, stratum and n: the records of each component by stratum.

    Splits get records near their shares, in all and in each stratum. A component is assigned whole.
    Components above BIG of all records are placed one by one, the others by cells of about equal size,
    within the stratum that holds most of their records. Only the counts of the cells by stratum come to
    the driver: of 1 / BIG + CELLS x (STRATA + 1) cells and STRATA + 1 strata, 102,696 at most.
    """
    total = sum(shares.values())
    if not shares or total <= 0 or min(shares.values()) < 0:
        raise ValueError("shares must be non-negative and not all zero")
    names = sorted(shares)
    per_stratum = groups.groupBy("stratum").agg(F.sum("n").alias("n"))
    known = {row["stratum"]: k for k, row in enumerate(per_stratum.orderBy(F.col("n").desc(), "stratum").limit(STRATA).collect())}
    all_records = per_stratum.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    code = F.coalesce(F.element_at(F.create_map(*[x for s, k in known.items() if s is not None for x in (F.lit(s), F.lit(k))]), F.col("stratum")), F.lit(known.get(None, STRATA))) if any(s is not None for s in known) else F.lit(STRATA)
    counts = groups.groupBy("component", code.alias("code")).agg(F.sum("n").alias("n"))
    whole = counts.groupBy("component").agg(F.sum("n").alias("size"), F.max_by("code", F.struct("n", -F.col("code"))).alias("main"))
    big = F.col("size") > F.lit(max(1.0, all_records * BIG))
    cell = F.when(big, F.concat(F.lit("g"), F.col("component").cast("string"))).otherwise(F.concat(F.lit("c"), F.col("main").cast("string"), F.lit("_"), F.pmod(F.xxhash64(F.lit(seed), "component"), F.lit(CELLS)).cast("string")))
    placed = work_table(whole.select("component", cell.alias("cell")), "cells")
    loads = counts.join(placed, "component").groupBy("cell", "code").agg(F.sum("n").alias("n"))
    cells: dict[str, dict[int, int]] = {}
    for row in loads.collect():
        cells.setdefault(row["cell"], {})[row["code"]] = row["n"]
    strata: dict[int, int] = {}
    for mix in cells.values():
        for s, n in mix.items():
            strata[s] = strata.get(s, 0) + n
    have = {name: {"": 0} for name in names}
    choice = {}
    for c in sorted(cells, key=lambda c: (-sum(cells[c].values()), c)):
        mix = cells[c]

        def cost(name):
            # growth of the squared deviations from the target, in all and in each stratum, each as a share of it
            share, size = shares[name] / total, sum(mix.values())
            grow = lambda now, add, target: ((now + add - target) ** 2 - (now - target) ** 2) / max(1.0, target)
            inner = sum(grow(have[name].get(s, 0), n, share * strata[s]) for s, n in mix.items())
            return grow(have[name][""], size, share * all_records) + inner

        best = min((n for n in names if shares[n] > 0), key=lambda n: (cost(n), n))
        choice[c] = best
        have[best][""] += sum(mix.values())
        for s, n in mix.items():
            have[best][s] = have[best].get(s, 0) + n
    spark = groups.sparkSession
    table = spark.createDataFrame(list(choice.items()), "cell string, new_split string")
    return placed.join(F.broadcast(table), "cell").select("component", "new_split")


def conflicting(records: DataFrame, components_: DataFrame, record: str, split: str) -> DataFrame:
    """Records with a split whose component has records in more than one split; null splits don't count."""
    known = records.filter(F.col(split).isNotNull()).select(record, split)
    known = work_table(known.join(components_, record), "known")
    mixed = known.groupBy("component").agg(F.min(split).alias("lo"), F.max(split).alias("hi")).filter(F.col("lo") < F.col("hi")).select("component")
    return join_hot(known, mixed, "component").select(record)


def new_splits(records: DataFrame, components_: DataFrame, shares: dict[str, float], record: str, stratum: Column) -> DataFrame:
    """record and new_split of every record."""
    rows = work_table(records.select(record, stratum.alias("stratum")).join(components_, record), "grouped")
    chosen = assign(rows.groupBy("component", "stratum").agg(F.count(F.lit(1)).alias("n")), shares)
    return join_hot(rows, chosen, "component").select(record, "new_split")
