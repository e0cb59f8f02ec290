"""Exact quantiles and exact-size samples that never hold a large group in one task.

Spark's exact ``percentile`` keeps a value -> count map per group, so its memory grows with the
number of distinct values. Here rows are collapsed to (value, weight) pairs by a partial aggregate (a value repeated a
billion times is one pair) and written once. While a group has more than ``ORDERED_PAIRS`` of them, its pairs are cut
into buckets at approximate quantiles and only the bucket that holds the wanted rank stays, with the weight below it; so
no task orders more pairs than that, and each round reads a ``BUCKETS``-th of the one before. Any cut points give the same exact answer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import written

BUCKETS = 64  # value buckets per group
ORDERED_PAIRS = 1_000_000  # pairs of a group that one task orders


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; the right side's keys are dropped."""
    cond = reduce(lambda a, b: a & b, [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys])
    rest = [F.col(f"r.{c}") for c in right.columns if c not in keys]
    return left.alias("l").join(right.alias("r"), cond, how).select("l.*", *rest)


def value_bucket(cuts: Column, value: Column) -> Column:
    """Number of cut points below ``value``."""
    return F.size(F.filter(F.coalesce(cuts, F.array().cast("array<double>")), lambda c: c < value))


def running_weight(pairs: DataFrame, keys: list[str], value: str, weight: str, buckets: int = BUCKETS) -> DataFrame:
    """``pairs`` (one row per group and value) with ``_before``: the group's weight on smaller values.

    Without ``keys`` the cut points and bucket totals are scalar subqueries (at most ``buckets`` numbers each), so
    nothing is joined on a constant."""
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    points = F.percentile_approx(value, probs, 10 * buckets).cast("array<double>")
    if keys:
        cut = join_null_safe(pairs, pairs.groupBy(*keys).agg(points.alias("_cuts")), keys) \
            .withColumn("_bk", value_bucket(F.col("_cuts"), F.col(value))).drop("_cuts")
    else:
        cut = pairs.withColumn("_cuts", pairs.agg(points).scalar()) \
            .withColumn("_bk", value_bucket(F.col("_cuts"), F.col(value))).drop("_cuts")
    inner = Window.partitionBy(*keys, "_bk").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = cut.withColumn("_in", F.sum(weight).over(inner) - F.col(weight))
    totals = cut.groupBy(*keys, "_bk").agg(F.sum(weight).alias("_w"))
    if keys:
        below = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)  # one row per bucket
        totals = totals.select(*keys, "_bk", F.coalesce(F.sum("_w").over(below), F.lit(0)).alias("_off"))
        out = join_null_safe(numbered, totals, [*keys, "_bk"])
    else:
        below = F.filter("_all", lambda t: t["_bk"] < F.col("_bk"))
        out = numbered.withColumn("_all", totals.agg(F.collect_list(F.struct("_bk", "_w"))).scalar()) \
            .withColumn("_off", F.aggregate(below, F.lit(0).cast("bigint"), lambda a, t: a + t["_w"])).drop("_all")
    return out.withColumn("_before", F.col("_off") + F.col("_in")).drop("_off", "_in", "_bk")


def _narrowed(live: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Of each group's pairs the buckets that hold ranks _k0 and _k1; _off becomes the weight below them."""
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = live.groupBy(*keys).agg(F.percentile_approx("_x", probs, 10 * buckets).alias("_cuts"))
    cut = join_null_safe(live, cuts, keys).withColumn("_bk", value_bucket(F.col("_cuts"), F.col("_x"))).drop("_cuts")
    sums = cut.groupBy(*keys, "_bk").agg(F.sum("_w").alias("_b"), *[F.first(c).alias(c) for c in ("_off", "_k0", "_k1")])
    upto = Window.partitionBy(*keys).orderBy("_bk")  # one row per bucket
    sums = sums.withColumn("_end", F.col("_off") + F.sum("_b").over(upto)).withColumn("_start", F.col("_end") - F.col("_b"))
    kept = sums.filter((F.col("_start") <= F.col("_k1")) & (F.col("_k0") < F.col("_end")))
    kept = kept.withColumn("_low", F.min("_start").over(Window.partitionBy(*keys))).select(*keys, "_bk", "_low")
    return join_null_safe(cut, kept, [*keys, "_bk"]).withColumn("_off", F.col("_low")).drop("_bk", "_low")


def exact_quantiles(df: DataFrame, cols: list[str], q: float = 0.5, by: list[str] | None = None,
                    weight: str | None = None, buckets: int = BUCKETS, ordered_pairs: int = ORDERED_PAIRS) -> DataFrame:
    """Exact linear-interpolated quantile of each of ``cols`` per ``by`` group, all in one pass over ``df``:
    rows (by..., column, quantile). Nulls are ignored; a group without values has no row.

    Matches ``percentile(col, q)`` / pandas ``quantile(q)``: position (n-1)*q, interpolating
    between neighbours. ``weight`` counts each row that many times.
    """
    by = list(by or [])
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_x")) for c in cols]
    w = F.col(weight).cast("bigint") if weight else F.lit(1).cast("bigint")
    cell = F.explode(F.array(*cells)) if len(cells) != 1 else cells[0]  # nothing to spread: the rows stay as they are
    long = df.select(*by, w.alias("_w"), cell.alias("_c")).select(*by, "_w", "_c.*")
    keys = [*by, "column"]
    pairs = long.where(F.col("_x").isNotNull() & (F.col("_w") > 0)).groupBy(*keys, "_x").agg(F.sum("_w").alias("_w"))
    pairs = written(pairs, "quantile-pairs")
    pos = (F.col("_n") - 1) * q
    wanted = pairs.groupBy(*keys).agg(F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_pairs"))
    largest = wanted.agg(F.max("_pairs")).first()[0] or 0
    live = join_null_safe(pairs, wanted.select(
        *keys, F.floor(pos).cast("bigint").alias("_k0"), F.ceil(pos).cast("bigint").alias("_k1"),
        (pos - F.floor(pos)).alias("_frac"), F.lit(0).cast("bigint").alias("_off")), keys)
    while buckets > 1 and largest > max(ordered_pairs, 2):
        live = written(_narrowed(live, keys, buckets), "quantile-pairs")
        before, largest = largest, live.groupBy(*keys).count().agg(F.max("count")).first()[0]
        if largest >= before:
            break
    run = Window.partitionBy(*keys).orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = live.withColumn("_end", F.col("_off") + F.sum("_w").over(run))

    def at(k: str) -> Column:
        return F.max(F.when((F.col("_end") - F.col("_w") <= F.col(k)) & (F.col(k) < F.col("_end")), F.col("_x")))
    found = ranked.groupBy(*keys).agg(at("_k0").alias("_v0"), at("_k1").alias("_v1"), F.first("_frac").alias("_frac"))
    return found.select(*keys, (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")).alias("quantile"))


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, by: list[str] | None = None, name: str = "quantile",
                   weight: str | None = None, buckets: int = BUCKETS, ordered_pairs: int = ORDERED_PAIRS) -> DataFrame:
    """One column's quantile: rows (by..., name); without groups one row, null if there are no values."""
    out = exact_quantiles(df, [col], q, by, weight, buckets, ordered_pairs)
    if by:
        return out.select(*by, F.col("quantile").alias(name))
    return out.agg(F.max("quantile").alias(name))


def exact_median(df: DataFrame, col: str, by: list[str] | None = None, name: str = "median", **kw) -> DataFrame:
    return exact_quantile(df, col, 0.5, by, name, **kw)


ACCURACY = 100_000      # rank error of a bracket: rows / ACCURACY
ORDERED_ROWS = 100_000  # a bracket of up to this many rows is ordered as it is
_HEX = 15               # hex digits of a key that are compared at a time (60 bits)


def smallest_n(df: DataFrame, key: str, n: int, total: int | None = None, ordered_rows: int = ORDERED_ROWS,
               accuracy: int = ACCURACY, _level: int = 0) -> DataFrame:
    """Exactly the ``n`` rows with the smallest string ``key`` (a hex digest).

    Rows below an approximate-rank bracket around rank n are all kept, and only the bracket (about
    8 / accuracy of the rows) is searched again until it is small enough to order. A bracket that
    misses rank n is widened, up to the whole range; one whose rows agree on all compared digits is searched
    by the next digits, and rows with equal keys are interchangeable.
    """
    if n <= 0:
        return df.limit(0)
    total = total if total is not None else df.count()
    if n >= total:
        return df
    if total <= ordered_rows:
        return df.orderBy(F.col(key)).limit(n)
    hashed = df.withColumn("_h", F.conv(F.substring(F.col(key), 1 + _HEX * _level, _HEX), 16, 10).cast("bigint"))

    def counts(lo: int, hi: int) -> tuple[int, int]:
        r = hashed.agg(F.count_if(F.col("_h") < lo).alias("b"), F.count_if(F.col("_h").between(lo, hi)).alias("m")).first()
        return r["b"], r["m"]
    p, margin = n / total, 4.0 / accuracy
    while True:
        if margin < 1:
            lo, hi = hashed.agg(F.percentile_approx("_h", F.array(F.lit(max(0.0, p - margin)), F.lit(min(1.0, p + margin))),
                                                    accuracy)).first()[0]
        else:
            lo, hi = hashed.agg(F.min("_h"), F.max("_h")).first()
        n_below, n_in = counts(lo, hi)
        if n_below <= n <= n_below + n_in:
            break
        margin *= 10
    while 2 * n_in > total and lo < hi:  # hardly narrower: halve the value range, so every level makes progress
        mid = lo + (hi - lo) // 2
        b, m = counts(lo, mid)
        lo, hi, n_below, n_in = (lo, mid, b, m) if n <= b + m else (mid + 1, hi, b + m, n_in - m)
    below = hashed.where(F.col("_h") < lo).drop("_h")
    bracket = hashed.where((F.col("_h") >= lo) & (F.col("_h") <= hi)).drop("_h")
    rest = n - n_below
    if lo == hi:
        if _level >= 2:  # all digits of the digest agree
            return below.unionByName(bracket.limit(rest))
        _level += 1
    return below.unionByName(smallest_n(bracket, key, rest, n_in, ordered_rows, accuracy, _level))
