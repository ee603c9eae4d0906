"""Order within long groups, without one task for a group: numbers, carried values and neighbours.

A group's rows are cut into stretches of ``width`` of their order key (whole numbers, unique in the group), so no window
holds more than ``width`` rows; what passes from one stretch to the next is one row a stretch, joined back on the stretch,
where the rows already are.  The rows are read twice, so what they are made of should be a scan or a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 50_000


def _cut(df: DataFrame, order: str, width: int) -> DataFrame:
    return df.withColumn("_b", F.floor(F.col(order) / width))


def numbered(df: DataFrame, key: str, order: str, name: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the 1-based place of each row in its group as ``name``."""
    rows = _cut(df, order, width).withColumn("_n", F.row_number().over(Window.partitionBy(key, "_b").orderBy(order)))
    per = rows.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = per.select(key, "_b", (F.sum("_c").over(Window.partitionBy(key).orderBy("_b")) - F.col("_c")).alias("_before"))
    return rows.join(before, [key, "_b"]).withColumn(name, F.col("_before") + F.col("_n")).drop("_b", "_n", "_before")


def carried(df: DataFrame, key: str, order: str, value: Column, name: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the last value that is not null among the rows before each in its group as ``name``."""
    rows = _cut(df, order, width).withColumn("_v", value)
    inside = F.last("_v", ignorenulls=True).over(Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_in", inside)
    last = rows.groupBy(key, "_b").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_last"))
    held = last.select(key, "_b", F.last("_last", ignorenulls=True).over(Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_held"))
    return rows.join(held, [key, "_b"]).withColumn(name, F.coalesce("_in", "_held")).drop("_b", "_v", "_in", "_held")


def neighbours(df: DataFrame, key: str, order: str, value: Column, before: str, after: str, width: int = WIDTH) -> DataFrame:
    """``df`` with the value of the row before and of the row after each in its group; null at the ends."""
    rows = _cut(df, order, width).withColumn("_v", F.struct(value.alias("v")))
    w = Window.partitionBy(key, "_b").orderBy(order)
    rows = rows.withColumns({"_lag": F.lag("_v").over(w), "_lead": F.lead("_v").over(w)})
    edge = rows.groupBy(key, "_b").agg(F.min_by("_v", order).alias("_first"), F.max_by("_v", order).alias("_last"))
    w = Window.partitionBy(key).orderBy("_b")
    held = edge.select(key, "_b", F.lag("_last").over(w).alias("_behind"), F.lead("_first").over(w).alias("_ahead"))
    got = rows.join(held, [key, "_b"])
    return got.withColumns({before: F.coalesce("_lag", "_behind")["v"], after: F.coalesce("_lead", "_ahead")["v"]}).drop("_b", "_v", "_lag", "_lead", "_behind", "_ahead")
