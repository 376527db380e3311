"""Install results per root and profile, misses, and comparison with a baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.specs import is_network_type
from ..functions.values import non_blank
from ..functions.verdicts import SIGN_GROUPS, STATUSES, sign_flags, status_of_severity, status_severity
from .dedup import USABLE
from .shape import one_row

ROOT_KEY = ["profile_id", "dependency_root"]


def flag_roots(roots: DataFrame, refs: DataFrame, name: str) -> DataFrame:
    """True where ``refs`` name the root, or its profile with no root at all.

    A NULL root in ``refs`` stands for every root of the profile. Exact and wildcard
    references are made distinct and looked up by equality, so one profile with very
    many references costs no more than any other.
    """
    exact = refs.filter(F.col("dependency_root").isNotNull()).select(*ROOT_KEY).distinct()
    wild = refs.filter(F.col("dependency_root").isNull()).select("profile_id").distinct()
    return (
        roots.join(exact.withColumn("_exact", F.lit(True)), ROOT_KEY, "left")
        .join(wild.withColumn("_wild", F.lit(True)), "profile_id", "left")
        .withColumn(name, F.coalesce("_exact", "_wild", F.lit(False)))
        .select(*roots.columns, name)
    )


def missed_artifacts(statuses: DataFrame) -> DataFrame:
    """Network artifacts that are not usable, with a reason."""
    usable = F.coalesce(F.col("status").isin(*USABLE), F.lit(False))
    return statuses.filter(is_network_type(F.col("type")) & ~usable).select(
        "artifact_id", F.coalesce(non_blank(F.col("error")), F.lit("CAS artifact unavailable")).alias("reason")
    )


def root_log_flags(
    logs: DataFrame, scratch_prefixes: Sequence[str] = (), reasons: DataFrame | None = None
) -> DataFrame:
    """Sign flags per root from logs (profile_id, dependency_root, phase, stream, text).

    Each log is searched where it is read; only booleans are shuffled. ``reasons``
    (profile_id, dependency_root, reason): the roots' own reasons count like a log.
    """
    flags = sign_flags(F.lower("text"), scratch_prefixes)
    found = logs.select(*ROOT_KEY, *flags)
    if reasons is not None:
        found = found.unionByName(reasons.select(*ROOT_KEY, F.col("reason").alias("text")).select(*ROOT_KEY, *flags))
    return found.groupBy(*ROOT_KEY).agg(*[F.bool_or(name).alias(name) for name in SIGN_GROUPS])


def profile_status(profiles: DataFrame, root_results: DataFrame) -> DataFrame:
    """Success only when every root succeeded; else the worst status; no root: failure."""
    worst = root_results.groupBy("profile_id").agg(
        F.min(status_severity(F.col("status"))).alias("severity"), F.count("*").alias("root_count")
    )
    return profiles.join(worst, "profile_id", "left").select(
        *profiles.columns,
        status_of_severity(F.coalesce("severity", F.lit(2))).alias("status"),
        F.coalesce("root_count", F.lit(0)).alias("root_count"),
    )


def status_counts(results: DataFrame) -> DataFrame:
    """One column per status, zeros kept."""
    return results.agg(*[F.count_if(F.col("status") == s).alias(f"{s}_count") for s in STATUSES])


def all_succeeded(runs: DataFrame) -> DataFrame:
    return runs.agg(F.coalesce(F.bool_and(F.col("status") == "success"), F.lit(False)).alias("all_succeeded"))


def offline_summary(statuses: DataFrame, g1_runs: DataFrame) -> DataFrame:
    """Expected artifacts, misses and verdicts of an install without network."""
    registry = F.col("type") == "registry"
    usable = F.coalesce(F.col("status").isin(*USABLE), F.lit(False))
    per_id = statuses.groupBy("artifact_id").agg(
        F.count_if(registry).alias("registry_rows"),
        F.count_if(is_network_type(F.col("type")) & ~usable).alias("miss_rows"),
    )
    sums = per_id.agg(
        F.coalesce(F.sum("registry_rows"), F.lit(0)).alias("registry_count"),
        F.count_if((F.col("registry_rows") > 0) & (F.col("miss_rows") > 0)).alias("missed_registry"),
        F.coalesce(F.sum("miss_rows"), F.lit(0)).alias("misses"),
    )
    joined = one_row(sums, all_succeeded(g1_runs))
    clean = F.col("misses") == 0
    return joined.select(
        (F.col("registry_count") - F.col("missed_registry")).alias("expected_artifacts"),
        "misses",
        F.when(clean, "success").otherwise("external_artifact_miss").alias("status"),
        F.when(clean & F.col("all_succeeded"), "success").otherwise("partial").alias("g1_status"),
    )


def compare_with_baseline(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Baseline ids with their new status: ``remaining`` or ``resolved_or_reclassified``."""
    change = F.when(F.col("status") == "other_failure", "remaining").otherwise("resolved_or_reclassified")
    return (
        baseline.select("profile_id")
        .distinct()
        .join(current.select("profile_id", "status"), "profile_id")
        .select("profile_id", F.col("status").alias("new_status"), change.alias("change"))
    )


def remaining_ids(baseline: DataFrame, current_failures: DataFrame) -> DataFrame:
    return baseline.select("profile_id").intersect(current_failures.select("profile_id"))


def add_unlisted(listed: DataFrame, others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``listed`` plus the rows of ``others`` whose key is not in it."""
    known = listed.select(*keys).distinct()
    return listed.unionByName(others.join(known, list(keys), "left_anti"), allowMissingColumns=True)


def unmatched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    return left.join(right.select(*keys).distinct(), list(keys), "left_anti")


def first_per_key(rows: DataFrame, keys: Sequence[str], order: str, kept: Sequence[str]) -> DataFrame:
    """First row of each key by ``order``, as a minimum (combines before the shuffle)."""
    return (
        rows.groupBy(*keys)
        .agg(F.min_by(F.struct(*kept), order).alias("_first"))
        .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in kept])
    )


def lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], order: str, kept: Sequence[str]) -> DataFrame:
    """Left join with the first match per composite key; NULL keys match NULL keys."""
    # Renamed keys: the null-safe condition needs to tell the sides apart.
    renamed = first_per_key(right, keys, order, kept).withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"_r_{key}"])
    return left.join(renamed, condition, "left").drop(*[f"_r_{k}" for k in keys])
