"""Cache-warming policies: tool groups, their artifacts, host fit and batches."""

from __future__ import annotations

import io
import json
import tarfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..functions.choices import policy_version
from ..functions.values import non_blank
from ..functions.versions import host_allows
from .dedup import usable_status
from .results import lookup
from .shape import number_rows

# Artifacts per import command.
BATCH_SIZES = {"npm": 100, "bun": 50}
DEFAULT_BATCH_SIZE = 250


def root_policies(roots: DataFrame, resolutions: DataFrame, installed_npm: str = "unknown") -> DataFrame:
    """(profile_id, dependency_root, package_manager, variant, version)."""
    key = ["profile_id", "dependency_root"]
    tools = resolutions.groupBy(*key).agg(
        F.max_by("tool_version", "ord").alias("tool_version"),
        F.max_by("resolved_version", "ord").alias("resolved_version"),
    )
    version = policy_version(
        F.col("package_manager"),
        F.col("variant"),
        F.col("tool_version"),
        F.col("resolved_version"),
        F.col("version"),
        installed_npm,
    )
    return (
        roots.filter(non_blank(F.col("package_manager")).isNotNull())
        .join(tools, key, "left")
        .select(*key, "package_manager", "variant", version.alias("version"))
    )


def policy_artifacts(refs: DataFrame, policies: DataFrame, statuses: DataFrame) -> DataFrame:
    """Distinct (package_manager, variant, version, artifact_id) over usable tarballs."""
    usable = statuses.filter(
        usable_status(F.col("status"), F.col("cas_path")) & F.col("type").isin("registry", "http_tarball")
    ).select("artifact_id")
    return (
        refs.join(usable, "artifact_id", "left_semi")
        .join(policies, ["profile_id", "dependency_root"])
        .select("package_manager", "variant", "version", "artifact_id")
        .distinct()
    )


def cache_roots(roots: DataFrame, warmups: DataFrame, base: str) -> DataFrame:
    """Roots with the cache directory of their policy.

    The first warm-up record (by ``ord``) with the same manager and variant, and the same
    version where the root has one; else the default directory below ``base``.
    """
    usable = warmups.filter(non_blank(F.col("cache_root")).isNotNull())
    policy = ["package_manager", "variant"]
    version = non_blank(F.col("version"))
    exact = lookup(roots, usable.withColumnRenamed("cache_root", "_exact"), [*policy, "version"], "ord", ["_exact"])
    both = lookup(exact, usable.withColumnRenamed("cache_root", "_any"), policy, "ord", ["_any"])
    yarn = (F.col("package_manager") == "yarn") & non_blank(F.col("variant")).isNotNull()
    folder = F.when(yarn, F.concat(F.lit("yarn-"), "variant")).otherwise(F.col("package_manager"))
    default = F.concat_ws("/", F.lit(base), folder, F.coalesce(version, F.lit("unknown")))
    chosen = F.when(version.isNotNull(), F.col("_exact")).otherwise(F.col("_any"))
    return both.withColumn("cache_root", F.coalesce(chosen, default)).drop("_exact", "_any")


def assign_batches(artifacts: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Adds ``batch_no``: fixed-size batches per key in order (first one numeric)."""
    size = F.lit(DEFAULT_BATCH_SIZE)
    for manager, count in BATCH_SIZES.items():
        size = F.when(F.col("package_manager") == manager, count).otherwise(size)
    numbered = number_rows(artifacts, keys, order)
    return numbered.withColumn("batch_no", F.floor(F.col("row_no") / size).cast("bigint")).drop("row_no")


def _manifest_reader(columns: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """gzip tar bytes -> text of the first package.json; NULL when unreadable."""

    def first_manifest(content: bytes) -> str | None:
        try:
            with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as archive:
                for member in archive:
                    if member.name == "package.json" or member.name.endswith("/package.json"):
                        stream = archive.extractfile(member)
                        if stream is None:
                            return None
                        text = stream.read().decode("utf-8", "replace")
                        json.loads(text)
                        return text
        except (OSError, EOFError, tarfile.TarError, ValueError):
            return None
        return None

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, first_manifest(content)) for path, content in batch.itertuples(index=False)]
            yield pd.DataFrame(rows, columns=columns)

    return read


def archive_manifests(blobs: DataFrame) -> DataFrame:
    """(path, manifest): Spark has no tar reader; only the JSON text comes back."""
    return blobs.select("path", "content").mapInPandas(
        _manifest_reader(["path", "manifest"]), "path STRING, manifest STRING"
    )


def host_compatible(manifests: DataFrame, os_names: list[str], cpu_names: list[str]) -> DataFrame:
    """Adds ``compatible`` and ``reason`` from the ``os`` and ``cpu`` lists."""
    value = F.try_parse_json("manifest")
    os_ok = host_allows(F.try_variant_get(value, "$.os", "array<string>"), os_names)
    cpu_ok = host_allows(F.try_variant_get(value, "$.cpu", "array<string>"), cpu_names)
    reason = F.when(~os_ok, f"package os constraint excludes {os_names[0]}").when(
        ~cpu_ok, f"package cpu constraint excludes {cpu_names[0]}"
    )
    return manifests.withColumn("compatible", os_ok & cpu_ok).withColumn("reason", reason)
