"""Ranks and running sums over whole tables, without a task that holds all rows.

Rows are range-partitioned by Spark and written with the number of their range, so both the sums
of the ranges and the sums within them are of the same ranges, whatever is sampled to find them.
The sums of the ranges, as many as there are shuffle partitions, move the sums within ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataloom.sources.scratch import written

#: Parts in which asked ranks and ranked values meet.
PARTS = 1024


def in_ranges(df: DataFrame, order: list[str], ranges: int | None = None) -> DataFrame:
    """df, written once, with `_range`: a number that never falls in the order of the columns, nulls first."""
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(ranges, *[F.col(f"`{c}`") for c in order]).withColumn("_range", F.spark_partition_id()), "ranges")


def ranked(df: DataFrame, order: list[str], amount: Column, name: str, ranges: int | None = None) -> tuple[DataFrame, int | float]:
    """df with `name`: the sum of `amount` over the rows before, in the order of the columns; and the sum over all rows."""
    rows = in_ranges(df.withColumn("_amount", amount), order, ranges)
    kind = T.LongType() if isinstance(rows.schema["_amount"].dataType, T.IntegralType) else T.DoubleType()
    sums = rows.groupBy("_range").agg(F.sum("_amount").cast(kind).alias("s")).orderBy("_range").collect()
    ahead, total = [], 0
    for r in sums:
        ahead.append((r["_range"], total))
        total += r.s or 0
    table = df.sparkSession.createDataFrame(ahead, T.StructType([T.StructField("_range", T.IntegerType()), T.StructField("_ahead", kind)])) if kind == T.LongType() else df.sparkSession.createDataFrame([(k, float(v)) for k, v in ahead], "_range int, _ahead double")
    inside = F.coalesce(F.sum("_amount").over(Window.partitionBy("_range").orderBy(*[F.col(f"`{c}`") for c in order]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    met = rows.withColumn("_inside", inside).join(F.broadcast(table), "_range")  # one row per range
    return met.withColumn(name, F.col("_ahead") + F.col("_inside")).drop("_range", "_amount", "_inside", "_ahead"), total


def cumulated(df: DataFrame, order: list[str], amount: Column, name: str, ranges: int | None = None) -> DataFrame:
    """df with `name`: the sum of `amount` over the rows before, in the order of the columns."""
    return ranked(df, order, amount, name, ranges)[0]


def at_ranks(ranked: DataFrame, asked: DataFrame, total: int, parts: int = PARTS) -> DataFrame:
    """asked (rank, ...) with the columns of the row of ranked (lo, n, ...) whose ranks lo to lo + n - 1 hold it.

    Ranks meet by the part of [0, total) that they fall into; a row of many ranks stands in each part it covers.
    """
    width = max(1, -(-total // parts))
    part = lambda c: F.floor(c / width).cast("long")
    own = ranked.withColumn("_part", F.explode(F.sequence(part(F.col("lo")), part(F.col("lo") + F.col("n") - 1))))
    met = asked.withColumn("_part", part(F.col("rank"))).join(own, "_part").where("rank >= lo and rank < lo + n")
    return met.drop("_part", "lo", "n")
