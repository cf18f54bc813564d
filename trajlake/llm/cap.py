"""Capping records per contributor (problem 4) by quality-weighted reservoir sampling.

Each record draws an exponential random variate, divided by its score, and a contributor keeps the
records of the `cap` smallest: sampling without replacement with probabilities in proportion to the
scores. Keys are compared by their logarithm, log(score) - log(variate), so scores of any size fit:
scores that fall by e^SURE from one record to the next are further apart than any two variates, and
the draw then gives the records in the order of their scores, exactly. Scores may also stand in tiers;
a better tier weighs infinitely more, so the draw decides within a tier only.

The best keys are kept map-side before the shuffle (Spark's window group limit), so a contributor
that holds a third of all rows sends no more than `cap` rows a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 2^64 as a double: hashes become uniform numbers in (0, 1).
SPAN = 2.0**64


def uniform(seed: int, *columns: Column | str) -> Column:
    """A number in (0, 1) that depends on the columns and the seed only, so a lost task draws it again alike."""
    return (F.xxhash64(F.lit(seed), *columns).cast("double") + 2.0**63 + 1.0) / (SPAN + 2050.0)


#: Logarithms of two variates differ by less: by 44.4 bits of a uniform number's logarithm at most, and 2^-53 at least.
SURE = 50.0


def drawn_key(log_score: Column, seed: int, *columns: Column | str) -> Column:
    """log(score) - log(exponential variate): the larger, the sooner kept. A null or NaN score is never preferred (-inf)."""
    usable = log_score.isNotNull() & ~F.isnan(log_score.cast("double"))
    return F.when(usable, log_score - F.log(-F.log(uniform(seed, *columns)))).otherwise(F.lit(float("-inf")))


def log_of(score: Column) -> Column:
    """The logarithm of a positive score; null for one that is null, NaN, zero or negative."""
    return F.when(~F.isnan(score.cast("double")) & (score > 0), F.log(score))


def sure_order(position: Column) -> Column:
    """Log-scores of records that are to be kept in ascending order of a whole number, whatever they draw."""
    return position.cast("double") * F.lit(-SURE)


def keep_per_contributor(df: DataFrame, contributor: list[str], cap: int, key: str, tier: Column, log_score: Column | None = None, seed: int = 17) -> DataFrame:
    """contributor columns and key of the records that stay: at most `cap` of each contributor.

    df must have one row a key. Null contributors form one contributor. tier: smaller is better, null
    last; log_score: logarithm of the weight within a tier, by default 0, all alike. Ties of the drawn key
    (and keys beyond 2^53 / SURE, where a double can't tell neighbours) go to the smaller key column.
    """
    if cap < 0:
        raise ValueError("cap must not be negative")
    drawn = drawn_key(F.lit(0.0) if log_score is None else log_score, seed, key)
    rows = df.select(*contributor, key, tier.alias("_tier"), drawn.alias("_draw"))
    w = Window.partitionBy(*contributor).orderBy(F.col("_tier").asc_nulls_last(), F.col("_draw").desc(), F.col(key).asc())
    return rows.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= cap).select(*contributor, key)


def share_cap(df: DataFrame, share: float) -> int:
    """The cap that limits a contributor to a share of the records, at least 1; one number comes to the driver."""
    return max(1, int(df.count() * share))


def given_up(df: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Keys of df that don't stay. The anti join is by record, which no contributor can skew."""
    return df.select(key).join(kept.select(key), key, "left_anti")
