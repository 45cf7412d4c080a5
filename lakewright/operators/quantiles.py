"""Exact quantiles of weighted values for columns of any size.

The built-in exact percentile keeps every distinct value of a group in one task. Here each
target rank is instead closed in by histograms: a first one over logarithmic buckets and
then ever finer ones inside the single bucket that holds the rank. Every step is a plain
aggregation that combines before its shuffle, and the brackets kept between the steps are a
handful of rows per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 256
BUCKETS_PER_STEP = 65536
MAX_STEPS = 12


def _log_bucket(v: Column) -> Column:
    size = F.floor(F.log2(F.abs(v)) * BUCKETS_PER_OCTAVE) + 1_000_000
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("bigint") * size)


def _rank_holders(hist: DataFrame, keys: list[str]) -> DataFrame:
    """Of each target's buckets, the one whose cumulative count covers its rank."""
    order = Window.partitionBy(*keys).orderBy("bucket")
    upto = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        hist.withColumn("upto", upto)
        .where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        .withColumn("rank", F.col("rank") - (F.col("upto") - F.col("n")))
    )


def exact_quantiles(
    values: DataFrame, key: str, value: str, weight: str, fractions: list[float]
) -> DataFrame:
    """(key, fraction, quantile): linear interpolation between the two nearest ranks.

    ``key`` identifies a column of a table, so there are few keys; their values may be many.
    """
    spark = values.sparkSession
    v = F.col(value)
    items = values.select(F.col(key).alias("k"), v.alias("v"), F.col(weight).alias("w"))

    first = items.groupBy("k", _log_bucket(F.col("v")).alias("bucket")).agg(
        F.sum("w").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    total = F.sum("n").over(Window.partitionBy("k", "fraction"))
    targets = (
        first.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
        .withColumn("at", (total - 1) * F.col("fraction"))
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))))
        .withColumn("target", F.col("rank"))
    )
    held = _rank_holders(targets, ["k", "fraction", "target"])
    columns = ["k", "fraction", "at", "target", "rank", "low", "high"]
    held = held.select(columns)
    schema = held.schema

    rows = held.collect()  # at most two rows per column and fraction
    for _ in range(MAX_STEPS):
        open_rows = [r for r in rows if r["low"] < r["high"]]
        if not open_rows:
            break
        closed = [r for r in rows if r["low"] == r["high"]]
        brackets = spark.createDataFrame(open_rows, schema)
        inside = items.join(F.broadcast(brackets), "k").where(
            F.col("v").between(F.col("low"), F.col("high"))
        )
        share = (F.col("v") - F.col("low")) / (F.col("high") - F.col("low"))
        hist = inside.groupBy(
            "k", "fraction", "at", "target", "rank",
            F.floor(share * BUCKETS_PER_STEP).alias("bucket"),
        ).agg(F.sum("w").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        rows = closed + _rank_holders(hist, ["k", "fraction", "target"]).select(columns).collect()
    else:
        raise RuntimeError("quantile brackets did not close")

    ends = spark.createDataFrame(rows, schema).groupBy("k", "fraction", "at").agg(
        F.min("low").alias("below"), F.max("low").alias("above")
    )
    step = F.col("at") - F.floor("at")
    return ends.select(
        F.col("k").alias(key),
        "fraction",
        (F.col("below") + (F.col("above") - F.col("below")) * step).alias("quantile"),
    )
