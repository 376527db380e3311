"""Report tables: distributions, timings, warm-up, coverage, runs, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.choices import policy_key
from ..functions.values import first_non_blank, non_blank
from ..functions.versions import absolute_change, relative_change, version_numbers
from .dedup import USABLE
from .results import lookup
from .shape import exact_percentiles, one_row

MIXED = "mixed"


def distribution(rows: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """(value, count); missing values are dropped, or named ``missing``."""
    value = non_blank(F.col(column))
    named = rows.select((F.coalesce(value, F.lit(missing)) if missing else value).alias("value"))
    return named.filter(F.col("value").isNotNull()).groupBy("value").agg(F.count("*").alias("count"))


def category_counts(rows: DataFrame, column: str = "category") -> DataFrame:
    """Counts in report order: most frequent first, then by name."""
    return rows.groupBy(column).agg(F.count("*").alias("count")).orderBy(F.desc("count"), F.asc(column))


def timing_summary(timings: DataFrame, key: str = "stage", value: str = "elapsed_ms") -> DataFrame:
    """count, total, p50, p95, max per stage, NULL stage included; NULL timings are skipped."""
    sums = (
        timings.filter(F.col(value).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("count"), F.sum(value).alias("total"), F.max(value).alias("max"))
    )
    ranks = exact_percentiles(timings, [key], value, {"p50": 0.5, "p95": 0.95}).withColumnRenamed(key, "_key")
    return sums.join(ranks, sums[key].eqNullSafe(ranks["_key"])).drop("_key")


def fetch_summary(statuses: DataFrame) -> DataFrame:
    failed = F.col("status") == "failed"
    return statuses.agg(
        F.coalesce(F.sum("downloaded_bytes"), F.lit(0)).alias("downloaded_bytes"),
        F.count_if(F.col("status") == "reused").alias("reused_count"),
        F.count_if(F.col("status") == "downloaded").alias("downloaded_count"),
        F.count_if(failed).alias("failed_count"),
        F.count_if(F.col("status") == "not_prefetched").alias("not_prefetched_count"),
        F.count_if(failed & F.contains(F.lower("error"), F.lit("integrity"))).alias("integrity_failure_count"),
    )


def warmup_by_manager(warmups: DataFrame) -> DataFrame:
    """Worst status and sums per manager; the policies are ``warmup_by_policy``."""
    return warmups.groupBy("manager").agg(
        F.when(F.bool_and(F.coalesce(F.col("status") == "success", F.lit(False))), "success")
        .otherwise("partial")
        .alias("status"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).alias(c)
            for c in ("cache_bytes", "imported", "failed_count", "elapsed_ms")
        ],
        F.count("*").alias("policy_count"),
    )


def warmup_by_policy(warmups: DataFrame) -> DataFrame:
    key = policy_key(F.col("manager"), F.col("variant"), F.col("version"))
    return warmups.withColumn("policy", key).select(
        "policy", "manager", "variant", "version", "status", "cache_bytes", "imported", "failed_count", "elapsed_ms"
    )


def cache_bytes_by_manager(warmups: DataFrame) -> DataFrame:
    return warmups.groupBy("manager").agg(F.coalesce(F.sum("cache_bytes"), F.lit(0)).alias("cache_bytes"))


def one_or(column: str, several: str | None) -> Column:
    """The only distinct non-NULL value of a group, else ``several``."""
    only = F.min(column) == F.max(column)
    return F.when(only, F.min(column)).otherwise(F.lit(several))


def profile_rollup(roots: DataFrame) -> DataFrame:
    """Manager (or ``mixed``) and version (only when there is exactly one) per profile."""
    version = F.nullif(F.col("version"), F.lit(""))
    return (
        roots.withColumn("version", version)
        .groupBy("profile_id")
        .agg(
            one_or("package_manager", MIXED).alias("package_manager"),
            one_or("version", None).alias("version"),
            F.count("*").alias("root_count"),
        )
    )


def task_counts(tasks: DataFrame) -> DataFrame:
    return tasks.groupBy("repository").agg(F.count("*").alias("task_count"))


def profile_coverage(profiles: DataFrame, tasks: DataFrame) -> DataFrame:
    """Profiles with their number of tasks, 0 when there is none."""
    counts = task_counts(tasks).withColumnRenamed("repository", "profile_id")
    return profiles.join(counts, "profile_id", "left").withColumn(
        "task_count", F.coalesce("task_count", F.lit(0))
    )


def coverage_rate(inputs: DataFrame, discovered: DataFrame) -> DataFrame:
    """Discovered / input; NULL without input."""
    both = one_row(
        inputs.agg(F.count("*").alias("input_profile_count")),
        discovered.agg(F.count("*").alias("discovered_profile_count")),
    )
    return both.withColumn("coverage_rate", F.try_divide("discovered_profile_count", "input_profile_count"))


def package_versions(best: DataFrame) -> DataFrame:
    """Registry document as rows: one per (name, version), with its digests.

    A long table: a package may have any number of versions, so they are not gathered
    into one map.
    """
    return best.select("name", "version", "artifact_id", non_blank(F.col("integrity")).alias("integrity"), "shasum")


def latest_versions(versions: DataFrame) -> DataFrame:
    """``latest`` is the greatest version as text; ``latest_numeric`` compares numbers."""
    return versions.groupBy("name").agg(
        F.count("*").alias("version_count"),
        F.max("version").alias("latest"),
        F.max_by("version", F.struct(version_numbers(F.col("version")), F.col("version"))).alias("latest_numeric"),
    )


def blob_shasum(content: Column, content_sha256: Column) -> Column:
    """sha1 of the blob, or the recorded hash when there is no blob."""
    return F.coalesce(F.sha1(content), content_sha256, F.lit(""))


def request_counts(requests: DataFrame, keys: Sequence[str]) -> DataFrame:
    return requests.groupBy(*keys).agg(
        F.count("*").alias("requests"), F.count_if(F.col("status") == 200).alias("served")
    )


def run_changes(runs: DataFrame, value: str = "value") -> DataFrame:
    """(metric, run_no, value) with the previous and first run and the changes.

    ``runs`` is a summary: its groups hold one row per run.
    """
    w = Window.partitionBy("metric").orderBy("run_no")
    return (
        runs.withColumns({"previous": F.lag(value).over(w), "first": F.first(value).over(w)})
        .withColumn("absolute_change", absolute_change(F.col("previous"), F.col(value)))
        .withColumn("relative_change", relative_change(F.col("previous"), F.col(value)))
    )


def first_run_bytes(initial: Column, previous: Column, current: Column) -> Column:
    """First recorded value: initial run, non-zero previous run, this run."""
    return F.coalesce(initial, F.nullif(previous, F.lit(0)), current, F.lit(0))


def phase_verdict(summary: DataFrame) -> DataFrame:
    """passed only with no failures, all profiles successful and no second-run bytes."""
    conditions = (
        (F.col("failed_discovery_count") == 0)
        & (F.col("resolution_failure_count") == 0)
        & (F.col("prefetch_failure_count") == 0)
        & (F.col("validation_success_count") == F.col("input_profile_count"))
        & (F.col("second_run_bytes") == 0)
    )
    passed = F.coalesce(conditions, F.lit(False))
    return summary.withColumn("verdict", F.when(passed, "passed").otherwise("partial"))


def resolution_counts(resolutions: DataFrame) -> DataFrame:
    return resolutions.agg(
        F.count_if(F.col("exit_code") == 0).alias("resolution_success_count"),
        F.count_if(F.col("exit_code") != 0).alias("resolution_failure_count"),
    )


def failed_statuses(statuses: DataFrame) -> DataFrame:
    return statuses.filter(~F.coalesce(F.col("status").isin(*USABLE), F.lit(False)))


def combine_issues(*stages: DataFrame) -> DataFrame:
    """Issues of several stages; an item listed by two stages counts once."""
    merged = stages[0]
    for stage in stages[1:]:
        merged = merged.unionByName(stage, allowMissingColumns=True)
    return merged.distinct()


def stage_failures(**stages: DataFrame) -> DataFrame:
    """One failure list with a ``stage`` column."""
    merged = None
    for stage, rows in stages.items():
        labelled = rows.withColumn("stage", F.lit(stage))
        merged = labelled if merged is None else merged.unionByName(labelled, allowMissingColumns=True)
    return merged


def in_input_order(rows: DataFrame, positions: DataFrame, key: str, then: str) -> DataFrame:
    """Order by position of the key in the input list, then by ``then``; unknown last."""
    joined = rows.join(positions.select(key, "ord"), key, "left")
    return joined.orderBy(F.asc_nulls_last("ord"), then)


def order_null_as_blank(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.orderBy(*[F.coalesce(F.col(c), F.lit("")) for c in columns])


ROOT_KEY = ("profile_id", "dependency_root")


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str], order: str, kept: Sequence[str]) -> DataFrame:
    """``left`` with the first row of ``right`` for its keys; NULL where there is none."""
    return lookup(left, right.select(*keys, order, *[c for c in kept if c != order]), keys, order, kept)


def validation_table(results: DataFrame, profiles: DataFrame, requests: DataFrame) -> DataFrame:
    """One row per validated root, with the owner and repository of its profile and its outbound requests.

    ``results``: root key, package_manager, profile_status, for each of g1 and g2 status, elapsed_ms and reason
    (``g1_status`` ...), reason, root_elapsed_ms. The first reason counts: the root's own, g1's, g2's.
    Requests are counted before they meet the roots, so a busy root costs no more than any other.
    """
    named = _beside(results, profiles, ["profile_id"], "ord", ["owner", "repo"])
    counts = requests.groupBy(*ROOT_KEY).agg(F.count("*").alias("outbound_request_count"))
    counted = lookup(named, counts, ROOT_KEY, "outbound_request_count", ["outbound_request_count"])
    return counted.select(
        "profile_id",
        "owner",
        "repo",
        "dependency_root",
        "package_manager",
        "profile_status",
        "g1_status",
        "g1_elapsed_ms",
        "g2_status",
        "g2_elapsed_ms",
        "root_elapsed_ms",
        F.coalesce("outbound_request_count", F.lit(0)).alias("outbound_request_count"),
        first_non_blank(F.col("reason"), F.col("g1_reason"), F.col("g2_reason")).alias("reason"),
    )


def resolution_table(resolutions: DataFrame, normalized: DataFrame, results: DataFrame) -> DataFrame:
    """Resolutions with the time that normalizing (``normalize_elapsed_ms``) and validating their root took.

    ``normalized`` and ``results`` may list a root several times: the last normalization (by ``ord``) and the
    first validation count.
    """
    latest = normalized.withColumn("_back", -F.col("ord"))
    timed = _beside(resolutions, latest, ROOT_KEY, "_back", ["normalize_elapsed_ms"])
    return _beside(timed, results, ROOT_KEY, "ord", ["validation_elapsed_ms"])


def project_table(profiles: DataFrame, roots: DataFrame, failures: DataFrame, statuses: DataFrame) -> DataFrame:
    """Profiles with the number of their roots, whether discovery failed, and their validation.

    ``failures`` (profile_id) of discovery; ``statuses``: profile_id, ord, status, elapsed_ms, the last one counts.
    """
    failed = failures.select("profile_id").distinct().withColumn("_failed", F.lit(True))
    counts = roots.groupBy("profile_id").agg(F.count("*").alias("dependency_roots"))
    last = statuses.groupBy("profile_id").agg(F.max_by(F.struct("status", "elapsed_ms"), "ord").alias("_last"))
    joined = profiles
    for side in (failed, counts, last):
        joined = joined.join(side, "profile_id", "left")
    return joined.select(
        *profiles.columns,
        F.coalesce("dependency_roots", F.lit(0)).alias("dependency_roots"),
        F.when(F.col("_failed"), "failed").otherwise("success").alias("discovery_status"),
        F.col("_last.status").alias("validation_status"),
        F.col("_last.elapsed_ms").alias("validation_elapsed_ms"),
    )


def coverage_table(profiles: DataFrame, roots: DataFrame, tasks: DataFrame) -> DataFrame:
    """Discovered profiles with the number of their roots and of the tasks in their repository."""
    counts = roots.groupBy("profile_id").agg(F.count("*").alias("dependency_roots"))
    covered = profile_coverage(profiles, tasks).join(counts, "profile_id", "left")
    return covered.withColumn("dependency_roots", F.coalesce("dependency_roots", F.lit(0))).withColumn(
        "discovery_status", F.lit("success")
    )
