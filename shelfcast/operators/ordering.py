"""Total orders and dense row ids without a single-task window over all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import running_weight


def global_row_number(df: DataFrame, order_cols: list[str], name: str,
                      partition_col: str | None = None) -> DataFrame:
    """``row_number() over (order by order_cols)`` computed in levels.

    Rows are numbered inside each ``partition_col`` group (the first sort key, a number), and
    each group gets the number of rows in smaller groups. That running count is itself taken in
    value buckets, so no task orders a row per group of the whole table.
    """
    partition_col = partition_col or order_cols[0]
    if order_cols[0] != partition_col:
        raise ValueError("partition_col must be the leading sort key")
    rest = order_cols[1:] or [partition_col]
    inner = Window.partitionBy(partition_col).orderBy(*rest)
    numbered = df.withColumn("_rn", F.row_number().over(inner))
    counts = df.groupBy(partition_col).agg(F.count(F.lit(1)).alias("_n"))
    offsets = running_weight(counts, [], partition_col, "_n").select(partition_col, F.col("_before").alias("_off"))
    # One row per group: AQE turns this into a broadcast join at run time when the
    # materialised offsets are small, and keeps a shuffle join when they are not.
    out = numbered.join(offsets, partition_col)
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("bigint")).drop("_rn", "_off")
