"""What differs between two runs' tables, and distinct counts that runs can share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Parts of a table that are compared by one fingerprint each.
BUCKETS = 1024
#: Hashes that a sketch keeps, as a power of two: counts are exact up to that, then within about 2.6 % in 19 of 20 cases.
SKETCH_BITS = 12


def row_bucket(keys: Sequence[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_prints(rows: DataFrame, keys: Sequence[str], fields: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """(bucket, print): one fingerprint per bucket of rows, whatever their order. A run can keep this small table.

    NULL and an empty text differ; the hash of a row tells which of its columns are NULL.
    """
    columns = [*keys, *fields]
    row = F.xxhash64(*columns, F.array(*[F.col(c).isNull() for c in columns]))
    second = F.xxhash64(F.lit(1), row, *columns)
    return rows.groupBy(row_bucket(keys, buckets).alias("bucket")).agg(
        F.struct(
            F.count("*").alias("n"),
            F.sum(row.cast("decimal(38,0)")).alias("sum"),
            F.bit_xor(second).alias("mixed"),
        ).alias("print")
    )


def changed_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """Buckets whose prints differ, or that only one side has."""
    sides = old.select("bucket", F.col("print").alias("was")).join(new.select("bucket", F.col("print").alias("is")), "bucket", "full")
    return sides.filter(~F.col("was").eqNullSafe(F.col("is"))).select("bucket")


def run_difference(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    old_prints: DataFrame | None = None,
    new_prints: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Keys that were added, removed or changed, with ``fields``: map of field -> struct(old, new) as text.

    ``keys`` identify a row and may be NULL. Buckets with equal prints leave both tables before the join,
    so rows that stayed as they were are not shuffled. Prints that the runs have kept need no second
    read; they must be made with the same ``keys``, ``fields`` and ``buckets``.
    """
    was = old_prints if old_prints is not None else bucket_prints(old, keys, fields, buckets)
    now = new_prints if new_prints is not None else bucket_prints(new, keys, fields, buckets)
    differ = changed_buckets(was, now)

    def side(rows: DataFrame, name: str) -> DataFrame:
        marked = rows.select(*keys, *fields, row_bucket(keys, buckets).alias("bucket"))
        touched = marked.join(differ, "bucket", "left_semi")
        return touched.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], F.struct(*fields).alias(name))

    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"_old_{key}").eqNullSafe(F.col(f"_new_{key}"))
    both = side(old, "_old").join(side(new, "_new"), same, "full")
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("key"),
                F.struct(F.col(f"_old.{name}").cast("string").alias("old"), F.col(f"_new.{name}").cast("string").alias("new")).alias("value"),
                (~F.col(f"_old.{name}").eqNullSafe(F.col(f"_new.{name}"))).alias("differs"),
            )
            for name in fields
        ]
    )
    moved = F.transform(F.filter(entries, lambda e: e["differs"]), lambda e: F.struct(e["key"], e["value"]))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    out = both.select(
        *[F.when(F.col("_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(f"_new_{k}")).alias(k) for k in keys],
        change.alias("change"),
        F.map_from_entries(moved).alias("fields"),
    )
    return out.filter((F.col("change") != "changed") | (F.size("fields") > 0))


def distinct_sketches(rows: DataFrame, run: str, value: Column) -> DataFrame:
    """(run, sketch): a theta sketch of each run's distinct values, to be kept and merged later."""
    return rows.groupBy(run).agg(F.theta_sketch_agg(value, SKETCH_BITS).alias("sketch"))


def merge_sketches(*sketches: DataFrame, run: str) -> DataFrame:
    """Sketches of parts of runs as one per run; no row is read again."""
    merged = sketches[0]
    for more in sketches[1:]:
        merged = merged.unionByName(more)
    return merged.groupBy(run).agg(F.theta_union_agg("sketch", SKETCH_BITS).alias("sketch"))


def sketch_overlap(sketches: DataFrame, run: str, pairs: DataFrame) -> DataFrame:
    """Estimates for (first, second) pairs of runs: distinct values of each, of both together, and in common."""
    one = sketches.select(F.col(run).alias("first"), F.col("sketch").alias("a"))
    two = sketches.select(F.col(run).alias("second"), F.col("sketch").alias("b"))
    estimate = F.theta_sketch_estimate
    return pairs.join(one, "first").join(two, "second").select(
        "first",
        "second",
        estimate("a").alias("first_distinct"),
        estimate("b").alias("second_distinct"),
        estimate(F.theta_union("a", "b", SKETCH_BITS)).alias("together"),
        estimate(F.theta_intersection("a", "b")).alias("in_common"),
        estimate(F.theta_difference("b", "a")).alias("only_second"),
    )
