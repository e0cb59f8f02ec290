"""Sampling and splitting (K1-K4)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import smallest_n
from shelfcast.session import written


def sample_key(keys: list[str], seed: int) -> Column:
    """A repeatable pseudo-random order: md5 of the row key and the seed."""
    return F.md5(F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


BRACKET = 0.02      # half the width of the digest range in which a fraction's threshold is looked for
ORDERED_KEYS = 100_000


def nth_key(keys: DataFrame, n: int, ordered_keys: int = ORDERED_KEYS) -> tuple[str, int, int]:
    """The n-th smallest (from 1) of the hex digests in column ``_key``: (digest, number of smaller ones, number of equal ones).

    Digits are taken three at a time: at most 4,096 counts show which range holds the rank, until few enough
    keys are left to order."""
    less, prefix = 0, ""
    while True:
        here = keys.where(F.col("_key").startswith(prefix)) if prefix else keys
        ranges = here.groupBy(F.substring("_key", 1, len(prefix) + 3).alias("p")).count().orderBy("p").collect()
        for r in ranges:
            if n <= less + r["count"]:
                break
            less += r["count"]
        prefix, inside = r["p"], r["count"]
        if inside <= ordered_keys or len(prefix) >= 32:
            break
    first = keys.where(F.col("_key").startswith(prefix)).orderBy("_key").limit(n - less)
    same = first.groupBy("_key").count().orderBy(F.desc("_key")).first()
    key = same["_key"]
    return key, n - same["count"], keys.where(F.col("_key") == key).count()


def _up_to(keyed: DataFrame, key: str, less: int, equal: int, n: int) -> DataFrame:
    """The n rows with the smallest keys, given the n-th key; rows with equal keys are interchangeable."""
    if less + equal == n:
        return keyed.where(F.col("_sample_key") <= key)
    return keyed.where(F.col("_sample_key") < key).unionByName(keyed.where(F.col("_sample_key") == key).limit(n - less))


def sample_fraction(df: DataFrame, fraction: float, seed: int = 42, keys: list[str] = ("store", "date"),
                    bracket: float = BRACKET) -> DataFrame:
    """K1: exactly ``int(n * fraction)`` rows without replacement.

    The same rows come back under any partitioning (the order is a digest of the key). Digests are uniform, so the
    threshold lies close to ``fraction`` of their range: one pass over ``df`` counts all rows and those below a narrow range around it
    and writes the digests inside; the threshold is found among these, and a filter is the second pass. A table so small
    that its threshold falls outside the range is searched whole.
    """
    keyed = df.withColumn("_sample_key", sample_key(list(keys), seed))
    lo, hi = (f"{min(max(int(x * 16 ** 8), 0), 16 ** 8):09x}"[-9:] for x in (fraction - bracket, fraction + bracket))
    place = F.concat(F.lit("0"), F.substring("_sample_key", 1, 8))  # nine digits, so the upper end may be 16 ** 8
    seen = Observation(f"sample-{uuid.uuid4().hex}")
    inside = keyed.select(F.col("_sample_key").alias("_key"), place.alias("_place")) \
        .observe(seen, F.count(F.lit(1)).alias("total"), F.count_if(F.col("_place") < lo).alias("below")) \
        .where(F.col("_place").between(lo, hi)).select("_key")
    inside = written(inside, "sample-keys")
    total, below = seen.get["total"], seen.get["below"]
    n = int(total * fraction)
    if n <= 0:
        return df.limit(0)
    if n >= total:
        return df
    if below < n <= below + inside.count():
        key, less, equal = nth_key(inside, n - below)
        return _up_to(keyed, key, below + less, equal, n).drop("_sample_key")
    return smallest_n(keyed, "_sample_key", n, total=total).drop("_sample_key")


def sample_fixed(df: DataFrame, n: int, seed: int = 42, keys: list[str] = ("store", "date"),
                 strict: bool = False) -> DataFrame:
    """K2: ``n`` rows (``strict`` raises when fewer exist; otherwise min(n, rows)).

    Up to 100,000 rows: each partition's smallest digests are merged in one pass, and a filter is the second."""
    if strict:
        from shelfcast.operators.joins import has_at_most
        if has_at_most(df, n - 1):
            raise ValueError(f"cannot take a sample of {n} rows from a smaller table")
    keyed = df.withColumn("_sample_key", sample_key(list(keys), seed))
    if 0 < n <= ORDERED_KEYS:
        first = written(keyed.select(F.col("_sample_key").alias("_key")).orderBy("_key").limit(n + 1), "sample-keys")
        if first.count() <= n:
            return df
        last, after = (r["_key"] for r in first.orderBy(F.desc("_key")).limit(2).collect()[::-1])
        if last < after:
            return keyed.where(F.col("_sample_key") <= last).drop("_sample_key")
    return smallest_n(keyed, "_sample_key", n).drop("_sample_key")


def time_split(df: DataFrame, weeks: int = 6, date_col: str = "date") -> tuple[DataFrame, DataFrame]:
    """K3: cutoff = max(date) - weeks; train before it, validation from it on (both ends in)."""
    cutoff = df.agg(F.date_sub(F.max(date_col), 7 * weeks)).scalar()
    return df.where(F.col(date_col) < cutoff), df.where(F.col(date_col) >= cutoff)


def with_split_flag(df: DataFrame, weeks: int = 6, date_col: str = "date") -> DataFrame:
    cutoff = df.agg(F.date_sub(F.max(date_col), 7 * weeks)).scalar()
    return df.withColumn("is_validation", (F.col(date_col) >= cutoff).cast("int"))
