"""Same or almost the same records across splits (problem 1).

1. Every planned conversation becomes a sequence of units (units.py); equal sequences form a class,
   told by a 128-bit digest, and from here on a class stands for its records.
2. Winnowing: of every window of rolling hashes the minimum is the fingerprint. A sequence of n units
   within one edit in eight of another shares at least `least_windows` windows with it.
3. Fingerprints are counted across the splits. One that stands on one side only can't be shared, so a
   sequence keeps its fingerprints of both sides, rarest first, and leaves out as many windows of the
   most frequent ones as it may: fewer than least_windows. A pair within the limit still has a kept
   fingerprint in common (the rarest of those it shares is kept by both), so nothing is lost, and a
   phrase that stands in every record gives no pairs.
   Fingerprints in a percent or more of all sequences are counted beforehand, each exactly and by side,
   and, as far as they may be left out or stand on one side only, are not sent at all. Those that must be
   sent are kept without counting them again and spread over the tasks, so no task counts a row of every record.
   Sequences are paired by fingerprint and band of length, which splits a frequent fingerprint over
   many keys; pairs whose lengths, whose places of the fingerprint or whose counts of units (in 64
   bins) differ by more than the edits allow are dropped.
4. The other candidate pairs are chained and aligned: shared rolling hashes that are
   collinear are fixed points, the gaps between them are aligned by edit distance, and where that
   exceeds the limit the exact edit distance decides.
5. Classes are expanded to pairs of records at the very end.
6. Coverage: the share of a record's units aligned with the most similar record within the limit; of any
   other record the share of its windows whose fingerprint stands on the other side.

Empty conversations (no unit) are no case. Exchanges carry fingerprints or digests; the unit sequences
lie in a table in the shared folder and are read again for the candidates only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.session import work_table

from .lookup import small
from .units import grams, word_units

#: One edit in so many units.
LIMIT = 8
#: Schemes of winnowing: rolling hashes of so many units, windows of so many hashes, and the lengths of the
#: sequences (from, below) that are compared by it. Shorter sequences have fewer whole windows between edits,
#: so the shortest keep every hash. Lengths overlap by an eighth, so that any pair within the limit has one in common.
SCHEMES = ((4, 1, 7, 16), (4, 2, 14, 128), (6, 2, 112, 1 << 62))
#: Seeds of the alignment.
SEED = 4
#: The share of all sequences, and the number of them, that make a fingerprint frequent; fingerprints that a task counts at once.
FREQUENT, FREQUENT_LEAST, CHUNK = 0.01, 20, 2_000_000
#: Sequences of a class that a task sends: one; classes it remembers.
MEMO = 300_000
ROWS = 1_000
#: Bins of the unit counts that tell unlike pairs; fingerprints have 48 bits; positions are told in steps.
BINS, PRINT_BITS, STEP = 64, 48, 8
#: What a fingerprint's row packs into one number: length, allowance, windows it stands for, first place (in
#: steps), scheme, whether it is frequent, whether it must be kept, whether it is on side a. Each field: shift, mask.
FIELDS = {"n": (47, 0xFFFF), "skip": (31, 0xFFFF), "count": (19, 0xFFF), "at": (5, 0x3FFF), "scheme": (3, 3), "often": (2, 1), "forced": (1, 1), "on_a": (0, 1)}
MOST, MOST_COUNT, MOST_AT = 0xFFFF, 0xFFF, 0x3FFF
#: Lower bits of the key of a frequent fingerprint, which spread it.
SPREAD_BITS = 40
#: Lengths of one band differ by a factor of at most this, so those of a pair within the limit lie in neighbouring ones.
BAND = LIMIT / (LIMIT - 1)


def conversation(messages="messages"):
    """The content of all but system messages, in order, one message a line; null content is empty."""
    said = F.filter(messages, lambda m: m["role"].isin("user", "assistant", "tool"))
    return F.array_join(F.transform(said, lambda m: F.coalesce(m["content"], F.lit(""))), "\n")


def least_windows(n: int, gram: int, window: int) -> int:
    """How many windows a sequence of n units shares at least with any other within the limit.

    A pair whose longer one has m >= n units has at most m // 8 edits, and each spoils at most
    gram + window - 1 of the m - (gram + window - 1) + 1 windows.
    """
    span = gram + window - 1
    longest = n * LIMIT // (LIMIT - 1) + 1
    return max(1, min(m - span + 1 - span * (m // LIMIT) for m in range(n, longest + 1)))


def fingerprints(units: np.ndarray, scheme: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct fingerprints, the windows each stands for, and the first of these."""
    gram, window = SCHEMES[scheme][:2]
    h = grams(units, gram)
    if window > 1 and len(h) >= window:
        h = np.lib.stride_tricks.sliding_window_view(h, window).min(axis=1)
    prints, first, counts = np.unique(((h ^ np.uint64(scheme)) & np.uint64((1 << PRINT_BITS) - 1)).view(np.int64), return_index=True, return_counts=True)
    return prints, counts, first


def schemes(n: int) -> list[int]:
    """The schemes by which a sequence of n units is compared; none if only equal ones are within the limit."""
    return [k for k, (_, _, least, below) in enumerate(SCHEMES) if least <= n < below]


def _sequences(key: str):
    import xxhash

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                units = [word_units(t) if t else np.empty(0, np.int64) for t in part.column("text").to_pylist()]
                data = [(u ^ (u >> 32)).astype(np.int32).tobytes() for u in units]
                bins = [np.minimum(np.bincount(u & (BINS - 1), minlength=BINS), 255).astype(np.uint8).tobytes() for u in units]
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), part.column("side"), pa.array([xxhash.xxh3_128_digest(d) for d in data], pa.binary()), pa.array([len(u) for u in units], pa.int32()), pa.array(bins, pa.binary()), pa.array(data, pa.binary())],
                    [key, "side", "class", "n", "bins", "units"],
                )

    return run


def sequences(records: DataFrame, sides: DataFrame, key: str = "record_id") -> DataFrame:
    """A table of key, side, class, n, bins and units of every record that has a side.

    records: key (an integer) and text; sides: key (unique) and side, 'a' or 'b'. Repeated deliveries of
    a record stay as repeated rows here; null keys join nothing and are left out; null text is empty.
    """
    kind = records.schema[key].dataType.simpleString()
    sides = work_table(sides, "sides")
    rows = records.join(small(sides), key).select(key, "side", "text")
    return work_table(rows.mapInArrow(_sequences(key), f"`{key}` {kind}, side string, class binary, n int, bins binary, units binary"), "sequences")


def _each(batches, column: str):
    """Of every sequence and scheme: the column's value, the scheme, the fingerprints and the windows each stands for."""
    for batch in batches:
        for value, data in zip(batch.column(column).to_pylist(), batch.column("units").to_pylist()):
            units = np.frombuffer(data, np.int32).astype(np.int64)
            for k in schemes(len(units)):
                yield value, k, *fingerprints(units, k)[:2]


def _excess(share: float, chunk: int):
    """Of every chunk of sequences the fingerprints in more than `share` of them, and by how many sequences more."""

    def told(found, n):
        prints, counts = np.unique(np.concatenate(found), return_counts=True)
        over = counts - share * n
        return pa.RecordBatch.from_arrays([pa.array(prints[over > 0]), pa.array(over[over > 0])], ["print", "over"])

    def run(batches):
        found, n, size = [], 0, 0
        for batch in batches:
            for data in batch.column("units").to_pylist():
                units = np.frombuffer(data, np.int32).astype(np.int64)
                prints = [fingerprints(units, k)[0] for k in schemes(len(units))]
                found += prints
                n, size = n + 1, size + sum(map(len, prints))
                if size >= chunk:
                    yield told(found, n)
                    found, n, size = [], 0, 0
        if size:
            yield told(found, n)

    return run


def _counted(prints: np.ndarray):
    """In how many sequences of side a, and of both sides, each of the (sorted) fingerprints stands."""

    def run(batches):
        df = {side: np.zeros(len(prints), np.int64) for side in "ab"}
        for side, _, h, _ in _each(batches, "side"):
            at = np.minimum(np.searchsorted(prints, h), len(prints) - 1)
            df[side][at[prints[at] == h]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(prints), pa.array(df["a"]), pa.array(df["a"] + df["b"])], ["print", "in_a", "df"])

    return run


def frequent_prints(seqs: DataFrame, key: str = "record_id", chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of FREQUENT of all sequences, sorted, and their ranks by frequency, -1 if they stand on one side only.

    Every row counts, whatever its key. What stands in a share of all sequences exceeds half of that share
    in some chunks, by half of it or more in all, so these are found where the sequences lie and then counted
    exactly over all of them. At most 2 / FREQUENT times the fingerprints of a mean sequence are counted, half
    as many are frequent, whatever the size of the corpus.
    """
    n = seqs.count()
    least = max(FREQUENT_LEAST, FREQUENT * n)
    none = np.empty(0, np.int64)
    if n < least:
        return none, none
    # sums of fractions are not exact to the last bit, hence one less
    over = seqs.select("units").mapInArrow(_excess(least / n / 2, chunk), "print bigint, over double").groupBy("print").agg(F.sum("over").alias("over"))
    maybe = np.sort(over.filter(F.col("over") >= least / 2 - 1).select("print").toPandas()["print"].to_numpy(np.int64))
    if not len(maybe):
        return none, none
    counts = seqs.select("side", "units").mapInArrow(_counted(maybe), "print bigint, in_a bigint, df bigint").groupBy("print").agg(F.sum("in_a").alias("in_a"), F.sum("df").alias("df"))
    rows = counts.filter(F.col("df") >= least).toPandas().sort_values(["df", "print"])
    prints, in_a, df = (rows[c].to_numpy(np.int64) for c in ("print", "in_a", "df"))
    ranks = np.where((in_a > 0) & (in_a < df), np.arange(len(rows)), -1)
    order = np.argsort(prints)
    return prints[order], ranks[order]


def _known(h: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the fingerprints among the frequent ones, -1 for others; which are frequent and stand on both sides."""
    if not len(frequent):
        return np.full(len(h), -1), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    found = frequent[at] == h
    return np.where(found, at, -1), found & (ranks[at] >= 0)


def _sent(units: np.ndarray, scheme: int, frequent: np.ndarray, ranks: np.ndarray):
    """Fingerprints, counts and first places of a sequence that are sent; their number among the frequent ones, or -1; windows that may still be left out."""
    h, count, first = fingerprints(units, scheme)
    skip = least_windows(len(units), *SCHEMES[scheme][:2]) - 1
    at, often = _known(h, frequent, ranks)
    # of the frequent ones, those of one side can't be shared; the most frequent of the others are left out as far as allowed
    mine = np.flatnonzero(often)
    mine = mine[np.argsort(-ranks[at[mine]], kind="stable")]
    keep = often | (at < 0)
    keep[mine[np.cumsum(count[mine]) <= skip]] = False
    return h[keep], count[keep], first[keep], at[keep], skip - int(count[mine].sum())


def _prints(key: str, frequent: np.ndarray, ranks: np.ndarray):
    def run(batches):
        seen: set = set()
        for batch in batches:
            recs, prints, metas = [], [], []
            for rec, side, cls, data in zip(*(batch.column(c).to_pylist() for c in (key, "side", "class", "units"))):
                if (cls, side) in seen:
                    continue
                if len(seen) >= MEMO:
                    seen.clear()
                seen.add((cls, side))
                units = np.frombuffer(data, np.int32).astype(np.int64)
                for k in schemes(len(units)):
                    h, count, first, number, skip = _sent(units, k, frequent, ranks)
                    # a frequent one goes by its number, below zero, and is spread by record
                    often = number >= 0
                    h = np.where(often, -(((number + 1) << SPREAD_BITS) | (rec & ((1 << SPREAD_BITS) - 1))), h)
                    packed = {
                        "n": min(len(units), MOST),
                        "skip": max(0, min(skip, MOST)),
                        "count": np.minimum(count, MOST_COUNT),
                        "at": np.minimum(first // STEP, MOST_AT),
                        "scheme": k,
                        "often": often,
                        "forced": often | (count > MOST_COUNT),
                        "on_a": side == "a",
                    }
                    meta = np.zeros(len(h), np.int64)
                    for name, (shift, _) in FIELDS.items():
                        meta |= np.asarray(packed[name], np.int64) << shift
                    recs.append(rec)
                    prints.append(h)
                    metas.append(meta)
            yield pa.RecordBatch.from_arrays([pa.array(recs, pa.int64()), pa.array(prints, pa.list_(pa.int64())), pa.array(metas, pa.list_(pa.int64()))], ["rec", "prints", "metas"])

    return run


def _field(name: str) -> Column:
    shift, mask = FIELDS[name]
    return F.shiftright("meta", shift).bitwiseAND(F.lit(mask))


def shared_prints(seqs: DataFrame, key: str = "record_id", frequent: tuple[np.ndarray, np.ndarray] | None = None, coverage: bool = True) -> DataFrame:
    """A table of print, rec, meta and kept of the fingerprints that stand on both sides and are sent.

    kept: whether rec is paired by this one. Without coverage only print, rec and meta of the kept ones.
    """
    prints, ranks = frequent_prints(seqs, key) if frequent is None else frequent
    lists = seqs.select(key, "side", "class", "units").mapInArrow(_prints(key, prints, ranks), "rec bigint, prints array<bigint>, metas array<bigint>")
    rows = lists.select("rec", F.explode(F.arrays_zip("prints", "metas")).alias("x")).select(F.col("x.prints").alias("print"), "rec", F.col("x.metas").alias("meta"))
    # counted in place by a window, so that rows are sent once. The frequent ones that are sent at all stand on both
    # sides and must be kept whatever their count: they are spread by record
    often, of = _field("often") == 1, Window.partitionBy("print")
    both = rows.withColumns({"in_a": F.sum(_field("on_a")).over(of), "df": F.count(F.lit(1)).over(of)}).filter(often | ((F.col("in_a") > 0) & (F.col("in_a") < F.col("df"))))
    number = F.when(F.col("print") < 0, -F.shiftright(-F.col("print"), SPREAD_BITS)).otherwise(F.col("print"))
    both = both.select(number.alias("print"), "rec", "meta", "df", (_field("forced") == 1).alias("forced"), _field("scheme").alias("scheme"))
    # from the most frequent one down, windows are left out while they are within the allowance
    free = Window.partitionBy("rec", "scheme").orderBy("forced", F.col("df").desc(), F.col("print").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("left", F.sum(F.when(F.col("forced"), F.lit(0)).otherwise(_field("count"))).over(free))
    kept = F.col("forced") | (F.col("left") > _field("skip"))
    if not coverage:
        return work_table(both.filter(kept).select("print", "rec", "meta"), "shared")
    return work_table(both.select("print", "rec", "meta", kept.alias("kept")), "shared")


def _windows(key: str, frequent: np.ndarray, ranks: np.ndarray):
    def run(batches):
        for batch in batches:
            rows = [(rec, k, int(count.sum()), int(count[_known(h, frequent, ranks)[1]].sum())) for rec, k, h, count in _each([batch], key)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], ["rec", "scheme", "windows", "often"])

    return run


def containment(seqs: DataFrame, shared: DataFrame, frequent: tuple[np.ndarray, np.ndarray], key: str = "record_id") -> DataFrame:
    """side, class and contained: the share of its windows whose fingerprints stand on the other side, too.

    All windows count, those of frequent fingerprints by the exact counts of both sides, sent or not.
    Sequences too short for windows have no row.
    """
    found = shared.filter(_field("often") == 0).groupBy("rec", _field("scheme").alias("scheme")).agg(F.sum(_field("count")).alias("shared"))
    whole = seqs.select(key, "units").mapInArrow(_windows(key, *frequent), "rec bigint, scheme bigint, windows bigint, often bigint")
    stand = F.coalesce("shared", F.lit(0)) + F.col("often")
    parts = whole.distinct().join(found, ["rec", "scheme"], "left").groupBy("rec").agg(F.max(F.least(F.lit(1.0), F.try_divide(stand, "windows"))).alias("contained"))
    named = seqs.select(F.col(key).alias("rec"), "side", "class").distinct()
    return named.join(parts, "rec").groupBy("side", "class").agg(F.max("contained").alias("contained"))


def candidate_pairs(seqs: DataFrame, key: str = "record_id", shared: DataFrame | None = None) -> DataFrame:
    """class_a (on side a) and class_b of the pairs worth aligning, equal classes left out."""
    kept = shared_prints(seqs, key, coverage=False) if shared is None else shared.filter("kept")
    band = F.floor(F.log(F.greatest(_field("n"), F.lit(1))) / F.lit(math.log(BAND) * (1 + 1e-9))).cast("int")
    one = lambda side, x: kept.filter(_field("on_a") == side).select("print", F.col("rec").alias(f"rec_{x}"), band.alias("band"), *(_field(c).alias(f"{c}_{x}") for c in ("n", "count", "at")))
    near = one(0, "b").withColumn("band", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))))
    longer = F.greatest("n_a", "n_b")
    like = F.abs(F.col("n_a") - F.col("n_b")) * LIMIT <= longer
    # a fingerprint that stands once in each is moved by no more than the edits
    moved = (F.col("count_a") == 1) & (F.col("count_b") == 1) & (longer < MOST) & ((F.abs(F.col("at_a") - F.col("at_b")) - 1) * (STEP * LIMIT) > longer)
    pairs = one(1, "a").join(near, ["print", "band"]).filter(like & ~moved).select("rec_a", "rec_b").distinct()
    classes = seqs.groupBy(F.col(key).alias("rec")).agg(F.first(F.struct("class", "n", "bins")).alias("x"))
    named = lambda x: classes.select(F.col("rec").alias(f"rec_{x}"), *(F.col(f"x.{c}").alias(f"{c}_{x}") for c in ("class", "n", "bins")))
    pairs = pairs.join(named("a"), "rec_a").join(named("b"), "rec_b").filter("class_a <> class_b")
    alike = pairs.select("class_a", "n_a", "bins_a", "class_b", "n_b", "bins_b").mapInArrow(_alike, "class_a binary, class_b binary")
    return alike.distinct()


def _alike(batches):
    """Pairs whose unit counts differ by no more than two for each edit allowed."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int32) for c in ("bins_a", "bins_b"))
        longer = np.maximum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
        keep = pa.array(np.flatnonzero(np.abs(a - b).sum(axis=1) <= 2 * (longer // LIMIT)))
        yield pa.RecordBatch.from_arrays([batch.column("class_a").take(keep), batch.column("class_b").take(keep)], ["class_a", "class_b"])


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edits between the sequences, or most + 1 if there are more; a band of 2 x most + 1 is looked at."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if not len(a) or not len(b):
        return max(len(a), len(b))
    width = 2 * most + 1
    far = np.int64(1 << 40)
    # column k of row i stands for position j = i + k - most of b
    k = np.arange(width)
    row = np.where(k >= most, k - most, far)
    row = np.where(k - most > len(b), far, row)
    padded = np.full(len(b) + 2 * width + len(a), -1, np.int64)
    padded[width : width + len(b)] = b
    for i in range(1, len(a) + 1):
        j = i + k - most
        same = padded[width + i - most - 1 : width + i - most - 1 + width] == a[i - 1]
        best = np.where((j >= 1) & (j <= len(b)), row + ~same, far)
        best[:-1] = np.minimum(best[:-1], row[1:] + 1)
        best = np.where(j == 0, i, best)
        best = np.minimum.accumulate(best - k) + k
        row = np.where((j >= 0) & (j <= len(b)), best, far)
        if row.min() > most:
            return most + 1
    return int(min(row[len(b) - len(a) + most], most + 1))


def chain(a: np.ndarray, b: np.ndarray, n: int = SEED) -> list[tuple[int, int]]:
    """Collinear seeds: the longest run of positions, rising in both, of grams that occur once in each."""
    ha, hb = grams(a, n), grams(b, n)
    ua, ia, ca = np.unique(ha, return_index=True, return_counts=True)
    ub, ib, cb = np.unique(hb, return_index=True, return_counts=True)
    ua, ia, ub, ib = ua[ca == 1], ia[ca == 1], ub[cb == 1], ib[cb == 1]
    _, x, y = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    order = np.argsort(ia[x])
    pa_, pb_ = ia[x][order], ib[y][order]
    if not len(pb_):
        return []
    if (np.diff(pb_) > 0).all():
        return list(zip(pa_.tolist(), pb_.tolist()))
    from bisect import bisect_left

    tails: list[int] = []
    at: list[int] = []
    back = [-1] * len(pb_)
    for i, v in enumerate(pb_.tolist()):
        k = bisect_left(tails, v)
        back[i] = at[k - 1] if k else -1
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out, i = [], at[-1]
    while i >= 0:
        out.append((int(pa_[i]), int(pb_[i])))
        i = back[i]
    return out[::-1]


def align(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(edits, units of the longer that stand in both), edits at most the limit; else (-1, 0).

    Seeds are extended over equal units; what lies between them is aligned within the edits left. That
    gives an upper bound; where it exceeds the limit, the banded distance of the whole decides.
    """
    longer = max(len(a), len(b))
    most = longer // LIMIT
    if abs(len(a) - len(b)) > most:
        return -1, 0
    # each edit spoils at most SEED grams
    ga, gb = np.unique(grams(a, SEED)), np.unique(grams(b, SEED))
    if len(ga) and len(np.intersect1d(ga, gb, assume_unique=True)) < len(ga) - SEED * most:
        return -1, 0
    edits, x, y = 0, 0, 0
    for i, j in [*chain(a, b), (len(a), len(b))]:
        if i < x or j < y:
            # the seed overlaps what is aligned already; it goes on only along the same diagonal
            continue
        if i > x or j > y:
            edits += edit_distance(a[x:i], b[y:j], most - edits)
            if edits > most:
                break
        if i < len(a):
            x, y = i + SEED, j + SEED
            # extension over equal units
            m = min(len(a) - x, len(b) - y)
            unlike = np.flatnonzero(a[x : x + m] != b[y : y + m])
            step = int(unlike[0]) if len(unlike) else m
            x, y = x + step, y + step
        else:
            x, y = i, j
    if edits > most:
        edits = edit_distance(a, b, most)
    return (edits, longer - edits) if edits <= most else (-1, 0)


def _align_rows(batches):
    for batch in batches:
        got = [align(np.frombuffer(a, np.int32).astype(np.int64), np.frombuffer(b, np.int32).astype(np.int64)) for a, b in zip(batch.column("units_a").to_pylist(), batch.column("units_b").to_pylist())]
        keep = [i for i, (e, _) in enumerate(got) if e >= 0]
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("class_a").take(at), batch.column("class_b").take(at), pa.array([got[i][0] for i in keep], pa.int32()), pa.array([got[i][1] for i in keep], pa.int32())],
            ["class_a", "class_b", "edits", "common"],
        )


def similar_classes(seqs: DataFrame, shared: DataFrame | None = None) -> DataFrame:
    """class_a, class_b, edits, common of all pairs across the sides within the limit, equal classes included (0 edits)."""
    pairs = work_table(candidate_pairs(seqs, shared=shared), "candidates")
    needed = pairs.select(F.col("class_a").alias("class")).unionByName(pairs.select(F.col("class_b").alias("class"))).distinct()
    units = seqs.select("class", "units").join(small(work_table(needed, "needed")), "class", "left_semi")
    units = work_table(units.dropDuplicates(["class"]), "units")
    a = units.select(F.col("class").alias("class_a"), F.col("units").alias("units_a"))
    b = units.select(F.col("class").alias("class_b"), F.col("units").alias("units_b"))
    near = pairs.join(a, "class_a").join(b, "class_b").mapInArrow(_align_rows, "class_a binary, class_b binary, edits int, common int")
    same = seqs.filter("n > 0").groupBy("class").agg(F.min("side").alias("lo"), F.max("side").alias("hi"), F.first("n").alias("n")).filter("lo < hi")
    same = same.select(F.col("class").alias("class_a"), F.col("class").alias("class_b"), F.lit(0).alias("edits"), F.col("n").alias("common"))
    return near.unionByName(same)


def members(seqs: DataFrame, key: str = "record_id") -> DataFrame:
    """key, side, class and n, one row a record."""
    return seqs.groupBy(key).agg(F.first("side").alias("side"), F.first("class").alias("class"), F.first("n").alias("n"))


def record_pairs(similar: DataFrame, records: DataFrame, key: str = "record_id") -> DataFrame:
    """The pairs of records of similar classes: <key>_a < <key>_b, side_a's record first or second as its key falls."""
    a = records.filter("side = 'a'").select(F.col("class").alias("class_a"), F.col(key).alias("x"))
    b = records.filter("side = 'b'").select(F.col("class").alias("class_b"), F.col(key).alias("y"))
    both = similar.select("class_a", "class_b").join(a, "class_a").join(b, "class_b")
    return both.select(F.least("x", "y").alias(f"{key}_a"), F.greatest("x", "y").alias(f"{key}_b"))


def class_links(similar: DataFrame, records: DataFrame, contained: DataFrame | None = None, key: str = "record_id") -> DataFrame:
    """One row a record: its class, the number of records on the other side within the limit, and coverage.

    Counted by class, so copies are never expanded into pairs. coverage is the largest share of the
    record's units that stand in a record of the other side within the limit; of a record without link
    what `contained` (see containment) has for it, else 0.
    """
    sizes = records.groupBy("class", "side").agg(F.count(F.lit(1)).alias("copies"))
    of = lambda mine, other, side: (
        similar.select(F.col(mine).alias("class"), F.col(other).alias("other"), "common")
        .join(sizes.filter(F.col("side") != side).select(F.col("class").alias("other"), "copies"), "other")
        .groupBy("class").agg(F.sum("copies").alias("links"), F.max("common").alias("common"))
        .withColumn("side", F.lit(side))
    )
    links = of("class_a", "class_b", "a").unionByName(of("class_b", "class_a", "b"))
    joined = records.join(links, ["class", "side"], "left")
    if contained is None:
        joined = joined.withColumn("contained", F.lit(0.0))
    else:
        joined = joined.join(contained, ["class", "side"], "left")
    aligned = F.when(F.col("n") > 0, F.least(F.lit(1.0), F.coalesce("common", F.lit(0)) / F.col("n"))).otherwise(0.0)
    share = F.when(F.col("links").isNotNull(), aligned).otherwise(F.coalesce("contained", F.lit(0.0)))
    return joined.select(key, "side", F.hex("class").alias("class_id"), F.coalesce("links", F.lit(0)).alias("links"), F.round(share, 6).alias("coverage"))
