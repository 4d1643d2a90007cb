"""Places of rows in their group's order, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankforge.llm.common import shared_table


def numbered(rows: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``rows`` with ``_pos``, a row's place (from 0) among the rows of its
    ``group``, and ``_n``, their number.  ``group`` is never null.

    Rows are dealt out by ranges of (group, order) and stored with the number of
    their range, so a group with a third of all rows lies in a third of the
    ranges; rows are counted off within their range.  A range begins inside at
    most one group, so what lies before it is a table of at most one row per
    range, and that is broadcast.  Rows alike in group and order are told apart by
    where they were read.
    """
    order = [*order, F.col("_read").asc()]
    dealt = shared_table(rows.withColumn("_read", F.monotonically_increasing_id()).repartitionByRange(F.col(group), *order)
                         .withColumn("_range", F.spark_partition_id()), name)
    counts = dealt.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_in_range"))
    whole = Window.partitionBy(group)                                   # at most a row per range
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # a group within one range is counted there; the others, at most one per range's start, get their counts from here
    split = (counts.select("*", F.count(F.lit(1)).over(whole).alias("_ranges"), F.sum("_in_range").over(earlier).alias("_before"),
                           F.sum("_in_range").over(whole).alias("_all")).filter("_ranges > 1")
             .select(group, "_range", F.coalesce("_before", F.lit(0)).alias("_before"), "_all"))
    own = Window.partitionBy(group, "_range")
    return (dealt.withColumns({"_at": F.row_number().over(own.orderBy(*order)), "_here": F.count(F.lit(1)).over(own)})
            .join(F.broadcast(split), [group, "_range"], "left")
            .withColumns({"_pos": F.col("_at") - 1 + F.coalesce("_before", F.lit(0)), "_n": F.coalesce("_all", F.col("_here"))})
            .select(*rows.columns, F.col("_pos").cast("long"), F.col("_n").cast("long")))
