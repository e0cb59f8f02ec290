"""Mixing sources to target word shares by Pareto order sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, 5, ...; together they get
``share`` times all words; no target exceeds ``cap`` times its source, the excess being reshared
by weight. That water level has a closed form: with sources ordered by cap * size / weight and
the first j of them full, the level is at least (total - cap * size of those) / weight of the
rest, and it is the largest of these values.

Documents: a document's expected copies are proportional to its weight within its source, at most ``cap``, and so that
the source's expected words are its target (the same kind of water level, over the distinct weights). Whole copies are certain. For the rest, documents are ranked by random odds
u / (1 - u) divided by inclusion odds p / (1 - p), u being a digest of the id, and taken in that
order until the source's remaining words are reached (nearest cut). Reruns agree.

The cut is found without sorting a source in one task: ranks are cut into buckets, word sums
per bucket are accumulated, and only the one bucket that holds the cut is ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfcast.llm.common import WORD_RE, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BUCKETS = 4096

#: A document's weight by its words: texts of the usual length count twice.
USUAL = (100, 1000)

ADDED = ["size", "source_size", "target", "copies", "taken"]


def n_words(text: Column) -> Column:
    """Words of a text: white space runs are separators; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def length_weight(size: Column) -> Column:
    """The mix's document weight: 2 from 100 to 1,000 words, else 1."""
    return F.when(size.between(*USUAL), 2.0).otherwise(1.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> with ``target``. One row per source: the windows here are over sources."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    every = W.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]),
                          ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by_ratio = (W.orderBy(cap * F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
                .rowsBetween(W.unboundedPreceding, -1))
    t = sizes.withColumn("weight", weight)
    t = t.withColumn("full", F.coalesce(F.sum("source_size").over(by_ratio), F.lit(0))) \
         .withColumn("full_weight", F.coalesce(F.sum("weight").over(by_ratio), F.lit(0)))
    total, all_weight = F.sum("source_size").over(every), F.sum("weight").over(every)
    t = t.withColumn("level", (total * share - cap * F.col("full")) / (all_weight - F.col("full_weight")))
    return t.select("source", "source_size", F.least(
        F.col("weight") * F.max("level").over(every), (cap * F.col("source_size")).cast("double")).alias("target"))


def unit(id_: Column, seed: str) -> Column:
    """A number in (0, 1) from a digest of the id: 52 bits, moved to the middle of their cell."""
    hex_ = F.substring(F.md5(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(seed))), 1, 13)
    return (F.conv(hex_, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def pareto_mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str | None = None,
               text_col: str = "text", weight_col: str | Column | None = None, weights=WEIGHTS, share: float = SHARE,
               cap: int = CAP, buckets: int = BUCKETS, seed: str = ":mix") -> DataFrame:
    """``docs`` with size, source_size, target (its source's), copies and taken (copies * size).

    A null source is a source of its own. Null and empty texts have size 0 and take nothing; a
    source of such texts has target 0. Equal ranks fall back to id, then size; rows equal in
    both are interchangeable, so repeated rows give the same set of results. A null id is the
    empty id. Input columns named like a result are replaced. An empty table gives an empty result.
    Weights count to two decimals (one row per source and weight is ordered); null and negative ones are 0, and take nothing.
    Each source's taken words miss its target by at most half of one document, unless documents of weight 0
    leave it less than its target.
    """
    named = {c for c in (size_col, weight_col) if isinstance(c, str)}
    rest = [c for c in docs.columns if c.lower() not in ADDED or c in named]
    size = n_words(F.col(text_col)) if size_col is None else F.coalesce(F.col(size_col).cast("long"), F.lit(0))
    g = F.lit(1.0) if weight_col is None else F.greatest(F.coalesce((F.col(weight_col) if isinstance(weight_col, str) else weight_col).cast("double"), F.lit(0.0)), F.lit(0.0))
    g = F.round(g, 2)
    base = docs.select(F.struct(*rest).alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                       size.alias("size"), g.alias("g"))
    sums = base.groupBy("source", "g").agg(F.sum("size").alias("s"))
    sums = written(sums, "mix-sources")
    sizes = sums.groupBy("source").agg(F.sum("s").alias("source_size"))
    heavier = W.partitionBy("source").orderBy(F.desc("g")).rowsBetween(W.unboundedPreceding, -1)  # one row a weight
    lighter = W.partitionBy("source").orderBy(F.desc("g")).rowsBetween(W.currentRow, W.unboundedFollowing)
    full = F.coalesce(F.sum("s").over(heavier), F.lit(0))
    levels = sums.select("source", full.alias("full"), F.sum(F.col("g") * F.col("s")).over(lighter).alias("gs"))
    # one row per source, read back with its true size: Spark broadcasts it while it is small
    targets = source_targets(sizes, weights, share, cap)
    plan = targets.alias("p").join(levels.alias("s"), F.col("p.source").eqNullSafe(F.col("s.source"))) \
        .groupBy("p.source", "source_size", "target").agg(F.coalesce(F.max(F.when(
            F.col("gs") > 0, (F.col("target") - cap * F.col("full")) / F.col("gs"))), F.lit(0.0)).alias("rate"))
    plan = written(plan, "mix-plan")

    def ranked(d: DataFrame) -> DataFrame:
        d = d.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source"))) \
            .select("d.*", "p.source_size", "target", F.least(F.col("rate") * F.col("g"), F.lit(float(cap))).alias("want"))
        d = d.withColumn("whole", F.floor("want").cast("long"))
        p, u = F.col("want") - F.col("whole"), unit(F.col("id"), seed)
        odds = (u / (1 - u)) / (p / (1 - p))
        # within a source ranks are put on an even scale: times the odds of its mean fraction, then to (0, 1)
        mean = F.col("target") / F.col("source_size")
        mean = F.greatest(mean - F.floor(mean), F.lit(1e-9))
        even = odds * (mean / (1 - mean))
        d = d.withColumn("rank", F.when(p > 0, even / (1 + even)).otherwise(1.0))
        return d.withColumn("bucket", F.floor(F.col("rank") * buckets).cast("int"))

    open_ = (F.col("whole") < cap)
    per_bucket = ranked(base).groupBy("source", "bucket").agg(
        F.sum(F.when(open_, F.col("size")).otherwise(0)).alias("words"),
        F.sum(F.col("whole") * F.col("size")).alias("certain"), F.first("target").alias("target"))
    src = W.partitionBy("source")
    before = F.coalesce(F.sum("words").over(src.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    per_bucket = per_bucket.withColumn("need", F.col("target") - F.sum("certain").over(src)).withColumn("before", before)
    # the bucket that holds the cut: the last one that begins below it
    edge = per_bucket.filter(F.col("before") < F.col("need")).groupBy("source").agg(
        F.max_by(F.struct("bucket", "before", "need"), "bucket").alias("edge"))
    edge = written(edge.select("source", "edge.*"), "mix-edges")
    d = ranked(base).alias("d").join(
        edge.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")), "left") \
        .select("d.*", F.col("e.bucket").alias("cut"), "before", "need")
    at_cut = F.coalesce(F.col("bucket") == F.col("cut"), F.lit(False)) & open_
    sure = d.filter(~at_cut).withColumn(
        "extra", F.when(open_ & (F.col("bucket") < F.col("cut")), 1).otherwise(0))
    run = F.coalesce(F.sum("size").over(src.orderBy("rank", "id", "size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    close = d.filter(at_cut).withColumn("run", F.col("before") + run).withColumn(
        "extra", F.when(2 * F.col("run") + F.col("size") <= 2 * F.col("need"), 1).otherwise(0)).drop("run")
    out = sure.unionByName(close).withColumn("copies", F.col("whole") + F.col("extra"))
    keep = [c for c in rest if c.lower() not in ADDED]
    return out.select(*[F.col("row")[c].alias(c) for c in keep], "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


#: The same draw in SQL, with the weights by length.
ORACLE_SQL = f"""
with n as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         (('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':mix'), 1, 13))::bigint + 0.5::double) / 4503599627370496.0::double as u
  from documents),
d as (select *, case when size between {USUAL[0]} and {USUAL[1]} then 2.0::double else 1.0::double end as g from n),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight from s),
f as (select *, coalesce(sum(source_size) over r, 0) as full_size, coalesce(sum(weight) over r, 0) as full_weight
      from w window r as (order by {CAP} * source_size::double / weight, source nulls last
                          rows between unbounded preceding and 1 preceding)),
l as (select *, (sum(source_size) over () * {SHARE}::double - {CAP} * full_size::double) / (sum(weight) over () - full_weight)::double as level from f),
t as (select source, source_size, least(weight * max(level) over (), ({CAP} * source_size)::double) as target from l),
gw as (select source, g, sum(size)::double as s from d group by source, g),
gl as (select source, coalesce(sum(s) over (partition by source order by g desc rows between unbounded preceding and 1 preceding), 0) as full_s,
              sum(g * s) over (partition by source order by g desc rows between current row and unbounded following) as gs from gw),
gr as (select t.source, coalesce(max(case when gs > 0 then (target - {CAP} * full_s) / gs end), 0) as rate
       from t join gl on t.source is not distinct from gl.source group by t.source),
e as (select d.*, t.source_size, t.target, least(rate * g, {CAP}::double) as want
      from d join t on d.source is not distinct from t.source join gr on d.source is not distinct from gr.source),
p as (select *, floor(want)::bigint as whole, want - floor(want) as p from e),
q as (select *, case when p > 0 then (u / (1 - u)) / (p / (1 - p)) else 1e300::double end as rnk from p),
c as (select *, target - sum(whole * size) over (partition by source) as need,
             coalesce(sum(case when whole < {CAP} then size else 0 end) over (
               partition by source order by rnk, doc_id, size rows between unbounded preceding and 1 preceding), 0) as run
      from q)
select doc_id, size, source_size, target,
       ((whole + case when whole < {CAP} and run < need and 2 * run + size <= 2 * need then 1 else 0 end) * size)::bigint as taken
from c
"""
