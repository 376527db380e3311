"""Global artifact table, dedup metrics and byte counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, functions as F

from ..functions.integrity import artifact_id
from ..functions.specs import is_network_type
from ..functions.values import non_blank
from .shape import one_row

MERGED_FIELDS = {
    "type": "type",
    "name": "name",
    "version": "version",
    "source_url": "resolved_url",
    "source": "source",
    "integrity": "integrity",
    "cache_checksum": "cache_checksum",
    "content_sha256": "content_sha256",
}
USABLE = ("downloaded", "reused")


def with_artifact_id(references: DataFrame) -> DataFrame:
    fields = ("type", "name", "version", "specifier", "integrity", "content_sha256", "resolved_url", "source")
    have = references.columns
    values = [F.col(c) if c in have else F.lit(None).cast("string") for c in fields]
    return references.withColumn("artifact_id", artifact_id(*values))


def _by_identity(rows: DataFrame) -> GroupedData:
    """Groups of one identity each, a number of the identity first.

    Texts are merged by sorting. Identities begin alike (``url:https://``), so a sort by them
    alone compares whole rows, wherever they lie; nearly all numbers differ.
    """
    return rows.groupBy(F.xxhash64("artifact_id").alias("identity_number"), "artifact_id")


def global_artifacts(references: DataFrame, order: str = "ord") -> DataFrame:
    """One row per identity; each field is the first non-empty one in input order.

    ``order`` must rank references (any comparable type, a struct is fine). Only
    algebraic aggregates are used: popular artifacts shrink before the shuffle.
    """
    have = references.columns
    firsts = [
        F.min_by(source, F.when(non_blank(F.col(source)).isNotNull(), F.col(order))).alias(name)
        for name, source in MERGED_FIELDS.items()
        if source in have
    ]
    return _by_identity(references).agg(*firsts, F.count("*").alias("reference_count")).drop("identity_number")


def artifact_state(references: DataFrame, order: str = "ord") -> DataFrame:
    """What a batch of references adds to the artifact table, in a form that can be merged.

    Each field is kept with the place of its first non-empty value: struct(at, value). ``order`` must rank
    the references of all batches, so it cannot be a position inside one batch.
    """
    have = references.columns
    firsts = [
        F.min(F.when(non_blank(F.col(source)).isNotNull(), F.struct(F.col(order).alias("at"), F.col(source).alias("value")))).alias(name)
        for name, source in MERGED_FIELDS.items()
        if source in have
    ]
    return _by_identity(references).agg(*firsts, F.count("*").alias("reference_count")).drop("identity_number")


def merge_artifact_states(*states: DataFrame) -> DataFrame:
    """States of batches as one. The result does not depend on their order, nor on how references were dealt out."""
    merged = states[0]
    for state in states[1:]:
        merged = merged.unionByName(state, allowMissingColumns=True)
    fields = [c for c in merged.columns if c not in ("artifact_id", "reference_count")]
    return _by_identity(merged).agg(
        *[F.min(c).alias(c) for c in fields], F.sum("reference_count").alias("reference_count")
    ).drop("identity_number")


def artifacts_of_state(state: DataFrame) -> DataFrame:
    """The artifact table that ``global_artifacts`` gives for all references together."""
    fields = [c for c in state.columns if c not in ("artifact_id", "reference_count")]
    return state.select("artifact_id", *[F.col(f"{c}.value").alias(c) for c in fields], "reference_count")


def artifact_refs(references: DataFrame) -> DataFrame:
    """Bridge artifact -> (profile, root); replaces a list of references per artifact."""
    return references.select("artifact_id", "profile_id", "dependency_root").distinct()


def dedup_metrics(references: DataFrame, artifacts: DataFrame) -> DataFrame:
    named = non_blank(F.col("name")).isNotNull() & non_blank(F.col("version")).isNotNull()
    size = F.col("size_bytes") if "size_bytes" in references.columns else F.lit(None)
    of_refs = references.agg(
        F.count("*").alias("total_dependency_references"),
        F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes_before_global_dedup"),
    )
    of_names = (
        references.filter(named)
        .select("name", "version")
        .distinct()
        .agg(F.count("*").alias("unique_logical_package_versions"))
    )
    of_artifacts = artifacts.agg(
        F.count("*").alias("unique_immutable_artifacts"),
        F.count_if(is_network_type(F.col("type"))).alias("network_artifact_count"),
    )
    total, unique = F.col("total_dependency_references"), F.col("unique_immutable_artifacts")
    return one_row(of_refs, of_names, of_artifacts).withColumns(
        {
            "duplicate_references_eliminated": total - unique,
            "dedup_ratio": F.coalesce(F.try_divide(total - unique, total), F.lit(0.0)),
        }
    )


def usable_status(status: Column, cas_path: Column) -> Column:
    return F.coalesce(status.isin(*USABLE), F.lit(False)) & non_blank(cas_path).isNotNull()


def dedup_savings(artifacts: DataFrame, statuses: DataFrame) -> DataFrame:
    """Byte columns per artifact; an unknown size is the artifact's ``estimated_bytes``, if it has them."""
    known = statuses.select("artifact_id", "status", "size_bytes", "cas_path", "error")
    size = F.nullif(F.col("size_bytes"), F.lit(0))
    if "estimated_bytes" in artifacts.columns:
        size = F.coalesce(size, F.nullif(F.col("estimated_bytes"), F.lit(0)))
    refs = F.coalesce(F.nullif(F.col("reference_count"), F.lit(0)), F.lit(1))
    columns = [c for c in ("artifact_id", "type", "name", "version") if c in artifacts.columns]
    return artifacts.join(known, "artifact_id", "left").select(
        *columns,
        "status",
        refs.alias("reference_count"),
        size.alias("size_bytes"),
        (size * refs).alias("referenced_bytes"),
        F.when(F.col("status").isin(*USABLE), size).alias("cas_bytes"),
        (size * (refs - 1)).alias("duplicate_savings_bytes"),
        "cas_path",
        "error",
    )


def stored_bytes(statuses: DataFrame) -> DataFrame:
    """Bytes over distinct blobs of usable artifacts."""
    usable = statuses.filter(usable_status(F.col("status"), F.col("cas_path")))
    return (
        usable.groupBy("cas_path")
        .agg(F.max("size_bytes").alias("size_bytes"))
        .agg(F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("stored_bytes"))
    )


def dedup_bytes(artifacts: DataFrame, statuses: DataFrame) -> DataFrame:
    """Bytes before and after dedup, artifacts without bytes, completeness."""
    joined = artifacts.select("artifact_id", "reference_count").join(
        statuses.select("artifact_id", "status", "cas_path", "size_bytes"), "artifact_id", "left"
    )
    usable = usable_status(F.col("status"), F.col("cas_path"))
    refs = F.coalesce(F.nullif(F.col("reference_count"), F.lit(0)), F.lit(1))
    per_blob = (
        joined.withColumn("cas_path", F.when(usable, F.col("cas_path")))
        .groupBy("cas_path")
        .agg(
            F.sum(F.when(F.col("cas_path").isNotNull(), F.col("size_bytes") * refs)).alias("before"),
            F.max(F.when(F.col("cas_path").isNotNull(), F.col("size_bytes"))).alias("after"),
            F.count_if(F.col("cas_path").isNull()).alias("missing"),
        )
    )
    return per_blob.agg(
        F.coalesce(F.sum("before"), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("after"), F.lit(0)).alias("bytes_after"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("missing_count"),
    ).withColumn("complete", F.col("missing_count") == 0)
