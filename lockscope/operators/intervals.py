"""As-of joins: the last row before each row, and requests of the run that was on when they came."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Seconds of a bucket of requests. A busy root spreads over as many tasks as it has buckets.
BUCKET_SECONDS = 3600


def as_of(
    left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, kept: Sequence[str], bucket: Callable[[Column], Column]
) -> DataFrame:
    """``left`` with ``found``: struct(at, kept) of the last row of ``right`` with the same keys and no later ``at``.

    ``bucket`` cuts ``at`` into ranges and must never fall as ``at`` grows. Rows meet inside (keys, bucket)
    only; what an earlier bucket hands on is its last row, found among one row per bucket. So no
    range is scanned, and one key with any share of the rows is spread over its buckets. NULL keys are
    a key like others. A NULL ``at`` on the left finds nothing, on the right it is never found. Of rows of
    ``right`` at the same place the one with the greatest ``kept`` counts.
    """
    here = left.select(*keys, F.col(at).alias("_at"), bucket(F.col(at)).alias("_bucket"), F.struct(*left.columns).alias("_row"))
    known = right.filter(F.col(at).isNotNull()).select(
        *keys, F.col(at).alias("_at"), bucket(F.col(at)).alias("_bucket"), F.struct(at, *kept).alias("_found")
    )
    touched = here.select(*keys, "_bucket").distinct()
    lasts = known.unionByName(touched, allowMissingColumns=True).groupBy(*keys, "_bucket").agg(F.max("_found").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = lasts.select(*keys, "_bucket", F.last("_last", ignorenulls=True).over(earlier).alias("_found"))
    handed = handed.filter("_found IS NOT NULL AND _bucket IS NOT NULL")
    # handed on first, then by place; a row of the right before a row of the left at the same place
    rows = (
        handed.withColumn("_side", F.lit(0))
        .unionByName(known.withColumn("_side", F.lit(1)), allowMissingColumns=True)
        .unionByName(here.withColumn("_side", F.lit(2)), allowMissingColumns=True)
    )
    place = Window.partitionBy(*keys, "_bucket").orderBy(F.asc_nulls_first("_at"), "_side", "_found")
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("found", F.last("_found", ignorenulls=True).over(upto)).filter("_side = 2")
    return found.select("_row.*", F.when(F.col("_at").isNotNull(), F.col("found")).alias("found"))


def requests_of_runs(
    requests: DataFrame, runs: DataFrame, keys: Sequence[str] = ("profile_id", "dependency_root"), seconds: int = BUCKET_SECONDS
) -> DataFrame:
    """``requests`` (keys, ts, ...) with the ``run_id`` they belong to; NULL outside all runs.

    ``runs``: keys, run_id, started, finished (NULL: still on). A run takes the requests of its root from its
    start on, until it has finished or the next run of the root starts.
    """
    starts = runs.select(*keys, F.col("started").alias("ts"), "finished", "run_id")
    local = dict(requests.dtypes)["ts"] == "timestamp_ntz"

    def bucket(ts: Column) -> Column:
        # a time without zone is never read in one: clocks that are set back would make it fall
        since = F.date_diff(ts, F.lit("1970-01-01")).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
        return F.floor((since if local else F.unix_seconds(ts)) / F.lit(seconds))

    found = as_of(requests, starts, keys, "ts", ["finished", "run_id"], bucket)
    on = F.col("found.finished").isNull() | (F.col("ts") < F.col("found.finished"))
    return found.withColumn("run_id", F.when(on, F.col("found.run_id"))).drop("found")


def run_requests(requests: DataFrame, runs: DataFrame, **options) -> DataFrame:
    """Every run with its ``requests`` and how many were ``served`` (status 200)."""
    counted = requests_of_runs(requests, runs, **options).filter("run_id IS NOT NULL").groupBy("run_id")
    counts = counted.agg(F.count("*").alias("requests"), F.count_if(F.col("status") == 200).alias("served"))
    return runs.join(counts, "run_id", "left").select(
        *runs.columns, F.coalesce("requests", F.lit(0)).alias("requests"), F.coalesce("served", F.lit(0)).alias("served")
    )
