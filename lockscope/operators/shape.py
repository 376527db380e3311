"""Frame helpers that avoid cross joins, global windows and one-task sorts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import group_key, heavy_groups

#: Buckets that a key's rows are spread over, about evenly.
BUCKETS = 128


def one_row(*frames: DataFrame) -> DataFrame:
    """Put one-row summaries side by side: union with NULLs, then keep the values."""
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged.agg(*[F.max(F.col(c)).alias(c) for c in merged.columns])


def _bucketed(rows: DataFrame, value: Column) -> DataFrame:
    """Adds ``_bucket``, which never decreases as ``value`` grows; NaN and then NULL come last.

    Only a ``_group`` with a share of the rows that counts is cut, at quantiles of its own from a sketch that is
    merged before the shuffle. So the limits follow the data, wherever its values lie. All other
    groups are one bucket. Two small jobs run at once for this: they find the heavy groups, at most 1 / SHARE,
    and their limits.
    """
    if rows.select(value).dtypes[0][1] in ("date", "timestamp_ntz"):
        value = value.cast("timestamp")
    keyed = rows.withColumn("_value", value.cast("double"))
    plain = F.col("_value").isNotNull() & ~F.isnan("_value")
    quantiles = F.array(*[F.lit(i / BUCKETS) for i in range(1, BUCKETS)])
    heavy = [r["_group"] for r in heavy_groups(keyed, "_group").collect()]
    if not heavy:
        return keyed.withColumn("_bucket", F.lit(0)).drop("_value")
    limits = (
        keyed.filter(F.col("_group").isin(heavy))
        .groupBy("_group")
        .agg(F.array_distinct(F.percentile_approx(F.when(plain, F.col("_value")), quantiles, F.lit(20 * BUCKETS))).alias("_limits"))
    )
    # computed once: a sketch that is merged in another order may give other limits
    limits = rows.sparkSession.createDataFrame(limits.collect(), limits.schema)
    # how many limits are below, by bisection
    steps = F.array(*[F.lit(1 << k) for k in range(BUCKETS.bit_length() - 1, -1, -1)])
    place = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.coalesce(F.get("_limits", at + step - 1) < F.col("_value"), F.lit(False)), step).otherwise(0),
    )
    cut = F.when(plain, place).otherwise(F.when(F.col("_value").isNull(), BUCKETS + 1).otherwise(BUCKETS))
    bucket = F.when(F.col("_limits").isNotNull(), cut).otherwise(0)
    return keyed.join(F.broadcast(limits), "_group", "left").withColumn("_bucket", bucket).drop("_limits", "_value")


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_no") -> DataFrame:
    """0-based row number inside each key, ordered by ``order``, NULLs last (first column: number or time).

    A key may hold any share of the rows: numbers are given inside (key, bucket) and
    shifted by the count of all lower buckets. Only rows with one and the same first
    order value share a bucket by necessity.
    """
    part = ["_group", "_bucket"]
    bucketed = _bucketed(df.withColumn("_group", group_key(keys)), F.col(order[0]))
    counts = bucketed.groupBy(*part).agg(F.count("*").alias("_n"))
    lower = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*part, F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_below"))
    inside = Window.partitionBy(*part).orderBy(*[F.asc_nulls_last(c) for c in order])
    return (
        bucketed.join(offsets, part)
        .withColumn(name, F.col("_below") + F.row_number().over(inside) - 1)
        .select(*df.columns, name)
    )


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float]
) -> DataFrame:
    """Percentiles with linear interpolation at rank (n-1)*q, one row per key.

    Equal values are counted first; ranks come from bucket totals plus a running count
    inside (key, bucket). ``percentile`` would hold all values of a key in one buffer.
    NaN is the largest value.
    """
    part = ["_group", "_bucket"]
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_group", group_key(keys))
    )
    counted = _bucketed(counted, F.col("_v"))
    totals = counted.groupBy(*part).agg(F.sum("_n").alias("_in_bucket"))
    whole = Window.partitionBy("_group")
    lower = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part,
        F.coalesce(F.sum("_in_bucket").over(lower), F.lit(0)).alias("_below"),
        F.sum("_in_bucket").over(whole).alias("_total"),
    )
    inside = Window.partitionBy(*part).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.join(offsets, part).withColumn("_upto", F.col("_below") + F.sum("_n").over(inside))
    return ranked.groupBy(*keys).agg(*[_at_rank(q).alias(label) for label, q in quantiles.items()])


def _at_rank(quantile: float) -> Column:
    rank = (F.col("_total") - 1) * F.lit(quantile)

    def at(position: Column) -> Column:
        here = (F.col("_upto") - F.col("_n") <= position) & (position < F.col("_upto"))
        return F.max(F.when(here, F.col("_v")))

    weight = F.max(rank - F.floor(rank))
    # no arithmetic at a whole rank: infinity times zero is not a number
    return F.when(weight == 0, at(F.floor(rank))).otherwise(at(F.floor(rank)) * (1 - weight) + at(F.ceil(rank)) * weight)
