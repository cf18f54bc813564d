"""Filling fixed-capacity containers (problem 7) by vector best-fit.

A container has three residual capacities: tokens, documents and attention cost (the sum of squared
lengths). Items go by decreasing size into the open container that fits under every constraint and
scores best: smallest weighted norm of what would stay free ('norm'), or largest weighted dot product
of item and free space ('dot'). An item larger than a container is divided into full containers and
one rest; no other item is divided. An item whose own attention cost exceeds the container's stands
alone, as nothing but division could help it.

Items are spread over shards by a hash, and each shard is packed on its own; a shard holds about
`shard_items` items whatever the size of the input, so a task's memory and time are bounded, and what
a shard leaves unused is a few containers in about a thousand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ITEMS = 20_000
#: Parts in a container; and the sum of squared sizes in it, as a share of capacity squared: of several parts
#: the largest is then at most sqrt(ATTENTION) of the container, and larger items stand alone.
MAX_DOCS, ATTENTION = 512, 0.75
#: Weights of the three dimensions in the score.
WEIGHTS = (1.0, 0.05, 0.1)
#: Shard numbers take the upper bits of a container id.
SHARD_BITS = 31


def best_fit(sizes: np.ndarray, capacity: int, max_docs: int, attention: float, rule: str = "norm", weights=WEIGHTS) -> np.ndarray:
    """The container number of each item, by vector best-fit decreasing; every size must be <= capacity.

    attention may be smaller than a single item's cost: that item is then alone in its container.
    """
    n = len(sizes)
    out = np.empty(n, np.int64)
    if n == 0:
        return out
    order = np.lexsort((np.arange(n), -sizes))
    w = np.asarray(weights)
    items = np.stack([sizes / capacity, np.full(n, 1.0 / max_docs), sizes.astype(float) ** 2 / attention], axis=1)
    free = np.empty((1024, 3))
    number = np.empty(1024, np.int64)
    used = total = 0
    smallest, least_cost = sizes.min() / capacity, float(sizes.min()) ** 2 / attention
    eps = 1e-9
    for i in order:
        v = items[i]
        room = free[:used]
        ok = np.flatnonzero((room[:, 0] >= v[0] - eps) & (room[:, 1] >= v[1] - eps) & (room[:, 2] >= v[2] - eps))
        if len(ok):
            left = room[ok]
            score = ((left - v) ** 2 @ w) if rule == "norm" else -(left * v) @ w
            at = ok[np.argmin(score)]
        else:
            if used == len(free):
                free = np.concatenate([free, np.empty_like(free)])
                number = np.concatenate([number, np.empty_like(number)])
            at = used
            free[at], number[at] = 1.0, total
            used, total = used + 1, total + 1
        free[at] -= v
        out[i] = number[at]
        # a container that no further item can enter is closed
        if free[at, 0] < smallest - eps or free[at, 1] < 1.0 / max_docs - eps or free[at, 2] < least_cost - eps:
            used -= 1
            free[at], number[at] = free[used], number[used]
    return out


def _pack_shards(key: str, capacity: int, max_docs: int, attention: float, rule: str):
    def pack(shard, rows):
        tables = pa.Table.from_batches(rows)
        sizes = tables.column("size").to_numpy()
        order = np.lexsort((tables.column("part").to_numpy(), tables.column(key).to_numpy(zero_copy_only=False)))
        bins = np.empty(len(sizes), np.int64)
        bins[order] = best_fit(sizes[order], capacity, max_docs, attention, rule)
        return tables.append_column("container_id", pa.array((np.int64(shard) << SHARD_BITS) + bins)).drop_columns(["shard"])

    def run(batches):
        # rows come sorted by shard
        current, held = None, []
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1), len(shards)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if shards[a] != current and held:
                    yield from pack(current, held).to_batches()
                    held = []
                current = shards[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield from pack(current, held).to_batches()

    return run


def pack(items: DataFrame, capacity: int, key: str = "doc_id", size: str = "n_tokens", max_docs: int = MAX_DOCS, attention: float | None = None, rule: str = "norm", shard_items: int = SHARD_ITEMS, n_items: int | None = None) -> DataFrame:
    """key, part, size and container_id of every part of every item.

    An item up to the capacity has the one part 0. A larger one has full parts, each a container of
    its own, and a last part that is packed with the others. Items of size 0 or null (counted as 0)
    take a document's room only. attention: the largest sum of squared sizes in a container of several
    parts, by default ATTENTION of capacity squared; any positive number, and an item that costs more
    is alone. Repeated and null keys are items of their own, told apart by nothing but their rows.
    n_items: the number of items if known, else they are counted.
    """
    attention = ATTENTION * float(capacity) ** 2 if attention is None else float(attention)
    if capacity < 1 or max_docs < 1 or attention <= 0:
        raise ValueError("capacity, max_docs and attention must be positive")
    if n_items is None:
        n_items = items.count()
    shards = max(1, round(n_items / shard_items))
    rows = items.select(key, F.greatest(F.lit(0), F.coalesce(F.col(size), F.lit(0))).cast("bigint").alias("total"))
    full = F.greatest(F.lit(0), F.ceil(F.col("total") / capacity).cast("int") - 1)
    # of hot keys the rows are spread by size and by the partition they are read in, which a lost task doesn't change
    shard = F.pmod(F.xxhash64(key, "total", F.spark_partition_id()), F.lit(shards)).cast("bigint")
    rows = rows.select(key, "total", full.alias("full"), shard.alias("shard"))
    # full parts fill a container and need no search; the sign bit keeps their containers apart from those of the shards
    whole = rows.filter("full > 0").select(key, F.explode(F.sequence(F.lit(0), F.col("full") - 1)).alias("part"))
    whole = whole.select(key, "part", F.lit(capacity).cast("bigint").alias("size"), (-F.monotonically_increasing_id() - 1).alias("container_id"))
    rest = rows.select(key, F.col("full").alias("part"), (F.col("total") - F.col("full") * F.lit(capacity)).alias("size"), "shard")
    kind = items.schema[key].dataType.simpleString()
    rest = rest.repartition(shards, "shard").sortWithinPartitions("shard")
    packed = rest.mapInArrow(_pack_shards(key, capacity, max_docs, attention, rule), f"`{key}` {kind}, part int, size bigint, container_id bigint")
    return whole.unionByName(packed)


def divided(assignment: DataFrame, key: str = "doc_id") -> DataFrame:
    """The items that were divided."""
    return assignment.filter(F.col("part") == 1).select(key)


def fill_report(assignment: DataFrame, capacity: int) -> DataFrame:
    """Containers, tokens, capacity and the share that is used, over the whole assignment."""
    bins = assignment.groupBy("container_id").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("parts"))
    return bins.agg(
        F.count(F.lit(1)).alias("containers"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        F.coalesce(F.max("tokens"), F.lit(0)).alias("fullest"),
        F.coalesce(F.max("parts"), F.lit(0)).alias("most_parts"),
        F.round(F.sum("tokens") / (F.count(F.lit(1)) * capacity), 6).alias("used_share"),
    )


def violated(assignment: DataFrame, capacity: int, max_docs: int = MAX_DOCS, attention: float | None = None) -> DataFrame:
    """container_id, tokens, parts and cost of the containers that break a constraint: none, if pack works."""
    attention = ATTENTION * float(capacity) ** 2 if attention is None else float(attention)
    cost = F.sum(F.col("size").cast("double") * F.col("size"))
    bins = assignment.groupBy("container_id").agg(F.sum("size").alias("tokens"), F.count(F.lit(1)).alias("parts"), cost.alias("cost"))
    many = F.col("parts") > 1
    return bins.filter((F.col("tokens") > capacity) | (F.col("parts") > max_docs) | (many & (F.col("cost") > attention * (1 + 1e-9))))
