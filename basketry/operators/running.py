"""Running totals within keys of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import stored


def running_total(rows: DataFrame, key: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same key that come before.

    Rows are dealt into ranges of key and order, so that a key with many rows is spread over tasks: each
    range adds up by itself, and what the ranges before it hold is added from one row a key and range.
    """
    dealt = rows.repartitionByRange(key, *order).withColumns({"range_": F.spark_partition_id(), "value_": value})
    dealt = stored(dealt, "ranges")
    inside = Window.partitionBy("range_", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(key, "range_").agg(F.sum("value_").alias("sum_"))
    earlier = Window.partitionBy(key).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("before_", F.coalesce(F.sum("sum_").over(earlier), F.lit(0))).drop("sum_")
    local = dealt.withColumn("inside_", F.coalesce(F.sum("value_").over(inside), F.lit(0)))
    total = F.col("inside_") + F.col("before_")
    return local.join(totals, [key, "range_"]).withColumn(name, total).drop("range_", "value_", "inside_", "before_")
