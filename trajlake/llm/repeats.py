"""Repetition inside a single document or record (problem 2).

Statistics of every item go through gradient-boosted trees (trees.py), fitted to the exact share of
repeated content on a bounded sample. An item is measured exactly if the trees score it above a cutoff
or if a bound can't rule it out; it is given up only if its score is low and the bound proves that its
share is below the limit. So whatever the trees learn, no case is lost; what they and the bound save
is the measuring of the others. Statistics, scores and exact check are one pass over the data: an item
is read once and nothing but its result leaves the task.

The bounds. Of a document: if c of its units lie in runs of `run` units that occurred before, at least
c (run - k + 1) / run of its windows of k units occurred before, as each run holds run - k + 1 of them.
Of a record: equal calls have equal names, so at most calls - distinct names repeat an earlier one.

Shares: of a document, the words that lie in runs of WORD_RUN or more that occurred earlier in the
text; of a Chinese or Japanese one (at least half of the letters are ideographs or kana) the letters
in runs of CHAR_RUN or more, those of Latin words in it too. Digits, punctuation, case, width and
white space don't count; an ideograph in another text is a word. Of a record, the tool calls that
repeat an earlier call of the record: same name, equal arguments once parsed, or equal text if they
can't be parsed. Null and empty items have share 0. Of repeated rows of an item, which are deliveries
of the same content, one counts.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import trees
from .units import OWNER_BITS, letter_units, repeated_units, repeated_windows

WORD_RUN, CHAR_RUN = 8, 16
DOC_SHARE, CALL_SHARE, LEAST_CALLS = 0.30, 0.40, 4
#: Labelled rows the trees are fitted to, about; the only thing that comes to the driver.
SAMPLE = 4_000
#: Items whose statistics are computed and scored together, and characters of them.
BLOCK, BLOCK_CHARS = 1 << OWNER_BITS, 4_000_000

#: Features of documents: length, whether letters are units, and share of windows of half a run that
#: occurred before. A repeated stretch repeats its windows, so the score must not fall as their share grows.
DOC_MONOTONE = [0, 0, 1]
#: Features of records: number of calls, and shares of calls whose name, or name and unparsed arguments,
#: occurred before. Equal calls have equal names, so the score must not fall as these grow.
CALL_MONOTONE = [0, 1, 1]


def doc_prepare(text: str | None) -> tuple[np.ndarray, bool]:
    return letter_units(text) if text else (np.empty(0, np.int64), False)


def _by_run(items: list, count) -> np.ndarray:
    """count(sequences, run) of the items, those of one run together."""
    out = np.zeros(len(items), np.int64)
    for letters, run in ((False, WORD_RUN), (True, CHAR_RUN)):
        at = [i for i, (_, x) in enumerate(items) if x == letters]
        out[at] = count([items[i][0] for i in at], run)
    return out


def doc_features(items: list) -> tuple[np.ndarray, np.ndarray]:
    """Features, and the largest number of units that may lie in repeated runs."""
    size = np.array([len(u) for u, _ in items], np.int64)
    letters = np.array([x for _, x in items], bool)
    again = _by_run(items, lambda s, run: repeated_windows(s, run // 2))
    half = np.where(letters, CHAR_RUN, WORD_RUN) // 2
    return np.stack([np.log1p(size), letters, again / np.maximum(1, size)], axis=1), again * 2 * half // (half + 1)


def doc_share(items: list) -> np.ndarray:
    """units in repeated runs and units of each item, as two columns"""
    return np.stack([_by_run(items, repeated_units), np.array([len(u) for u, _ in items], np.int64)], axis=1)


def calls_of(texts: list[str | None] | None) -> list[tuple[str, object]]:
    """(name, arguments as given) of every call, in order, of the JSON arrays of a record's messages.

    An array that can't be parsed is one call without a name; so is an element that isn't an object.
    """
    out = []
    for text in texts or ():
        if text is None:
            continue
        try:
            parsed = json.loads(text)
        except ValueError:
            parsed = [text]
        for call in parsed if isinstance(parsed, list) else [parsed]:
            function = call.get("function") if isinstance(call, dict) else None
            if isinstance(function, dict):
                out.append((str(function.get("name")), function.get("arguments")))
            else:
                out.append(("", call))
    return out


def canonical(value) -> str:
    """Equal values have equal text: keys sorted, whole floats as integers."""

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        if isinstance(x, list):
            return [plain(v) for v in x]
        return int(x) if isinstance(x, float) and x.is_integer() else x

    return json.dumps(plain(value), sort_keys=True)


def signature(call) -> tuple[str, str, str]:
    name, arguments = call
    if isinstance(arguments, str):
        try:
            return name, "parsed", canonical(json.loads(arguments))
        except ValueError:
            return name, "text", arguments
    return name, "parsed", canonical(arguments)


def call_features(items: list) -> tuple[np.ndarray, np.ndarray]:
    """Features, and the largest number of calls that may repeat an earlier one."""
    counts = [(len(calls), len({name for name, _ in calls}), len({(name, a if isinstance(a, str) else repr(a)) for name, a in calls})) for calls in items]
    n, names, texts = np.array(counts, np.int64).reshape(-1, 3).T
    return np.stack([n, (n - names) / np.maximum(1, n), (n - texts) / np.maximum(1, n)], axis=1), n - names


def call_share(items: list) -> np.ndarray:
    """calls that repeat an earlier one and calls of each item, as two columns"""
    return np.array([(len(calls) - len({signature(c) for c in calls}), len(calls)) for calls in items], np.int64).reshape(-1, 2)


class Kind:
    """How one kind of item is prepared, described and measured."""

    def __init__(self, name, key, column, prepare, features, measure, monotone, share, least):
        self.name, self.key, self.column = name, key, column
        self.prepare, self.features, self.measure = prepare, features, measure
        self.monotone, self.share, self.least = monotone, share, least

    def reached(self, repeated, size):
        """Whether the share sought is reached; for numpy arrays and columns."""
        return (size >= self.least) & (repeated >= size * self.share - 1e-9)


DOCUMENTS = Kind("document", "doc_id", "text", doc_prepare, doc_features, doc_share, DOC_MONOTONE, DOC_SHARE, 1)
TRAJECTORIES = Kind("trajectory", "record_id", "calls", calls_of, call_features, call_share, CALL_MONOTONE, CALL_SHARE, LEAST_CALLS)


def document_items(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text")


def trajectory_items(trajectories: DataFrame) -> DataFrame:
    """record_id and the tool-call arrays of its messages, the only nested field that is read."""
    return trajectories.select("record_id", F.col("messages.tool_calls").alias("calls"))


def _blocks(batch):
    """Parts of a batch of at most BLOCK rows and about BLOCK_CHARS bytes, but of one row at least."""
    column = batch.column(1)
    begin = 0
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    else:
        # of lists of texts, by the lengths of all texts of a row
        texts = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column.flatten()), 0).to_numpy(zero_copy_only=False)))
        ends = texts[np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]
    while begin < len(column):
        full = int(np.searchsorted(ends, (ends[begin - 1] if begin else 0) + BLOCK_CHARS, side="right"))
        end = min(len(column), begin + BLOCK, max(begin + 1, full))
        yield batch.slice(begin, end - begin)
        begin = end


def _labelled(kind: Kind):
    names = [*(f"x{j}" for j in range(len(kind.monotone))), "y"]

    def run(batches):
        for batch in batches:
            for part in _blocks(batch):
                items = [kind.prepare(v) for v in part.column(1).to_pylist()]
                repeated, size = kind.measure(items).T
                y = np.where(size >= kind.least, repeated / np.maximum(1, size), 0.0)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.float64()) for c in (*kind.features(items)[0].T, y)], names)

    return run


def fit(items: DataFrame, kind: Kind, sample: int = SAMPLE, seed: int = 17) -> tuple[trees.Forest, float]:
    """Trees and cutoff from a sample by hash of about `sample` rows (all of them if there are fewer).

    The cutoff is half of the smallest score of a sampled positive, at most half of the share sought;
    without a sampled positive every item is a candidate.
    """
    n = items.count()
    if n > sample:
        items = items.filter(F.pmod(F.xxhash64(F.lit(seed), kind.key), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    width = len(kind.monotone)
    schema = ", ".join([*(f"x{j} double" for j in range(width)), "y double"])
    rows = items.mapInArrow(_labelled(kind), schema).toPandas().sort_values([*(f"x{j}" for j in range(width)), "y"]).to_numpy()
    x, y = rows[:, :-1], rows[:, -1]
    forest = trees.fit(x, y, kind.monotone)
    positive = y >= kind.share - 1e-9
    if not positive.any():
        return forest, float("-inf")
    return forest, min(float(forest.score(x[positive]).min()), kind.share) / 2


SCORED = "item_id bigint, score double, ruled_out boolean, repeated bigint, size bigint"


def _scored(kind: Kind, forest: trees.Forest | None, cutoff: float):
    """Score and exact counts of the items; only of those that trees or bound admit where there is a forest."""

    def run(batches):
        for batch in batches:
            for part in _blocks(batch):
                items = [kind.prepare(v) for v in part.column(1).to_pylist()]
                chosen = np.arange(len(items))
                score, out = np.full(len(items), np.nan), np.zeros(len(items), bool)
                if forest is not None and items:
                    x, most = kind.features(items)
                    score = forest.score(x)
                    out = ~kind.reached(most, np.array([len(i) if isinstance(i, list) else len(i[0]) for i in items], np.int64))
                    chosen = np.flatnonzero((score >= cutoff) | ~out)
                counts = kind.measure([items[i] for i in chosen])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(chosen)), pa.array(score[chosen]), pa.array(out[chosen]), pa.array(counts[:, 0]), pa.array(counts[:, 1])],
                    ["item_id", "score", "ruled_out", "repeated", "size"],
                )

    return run


def candidates(items: DataFrame, kind: Kind, sample: int = SAMPLE) -> DataFrame:
    """item_id, score, ruled_out, repeated and size of the items that trees or bound admit, measured exactly; one row an item.

    ruled_out: whether the bound alone would have given the item up. Null ids are one item.
    """
    forest, cutoff = fit(items, kind, sample)
    return items.mapInArrow(_scored(kind, forest, cutoff), SCORED).dropDuplicates(["item_id"])


def shares(items: DataFrame, kind: Kind) -> DataFrame:
    """item_kind, item_id, repeated, size and share of every item, measured without a gate; share 0 of an empty one; one row an item."""
    rows = items.mapInArrow(_scored(kind, None, 0.0), SCORED).dropDuplicates(["item_id"])
    return rows.select(F.lit(kind.name).alias("item_kind"), "item_id", "repeated", "size", F.when(F.col("size") > 0, F.col("repeated") / F.col("size")).otherwise(0.0).alias("share"))


def found(items: DataFrame, kind: Kind, sample: int = SAMPLE) -> DataFrame:
    """item_kind and item_id of the items whose share of repeated content reaches the kind's limit."""
    rows = candidates(items, kind, sample)
    return rows.filter(kind.reached(F.col("repeated"), F.col("size"))).select(F.lit(kind.name).alias("item_kind"), "item_id")
