"""The version that a manifest's range stands for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.precedence import is_prerelease, key_base, range_bounds, version_key
from .intervals import as_of


def _one(column: Column) -> Column:
    """No finer buckets: a package's versions and distinct ranges are few, whatever the number of references."""
    return F.lit(0)


def latest_matching(wanted: DataFrame, versions: DataFrame) -> DataFrame:
    """Distinct (name, specifier) of ``wanted`` with ``version``, the greatest one of ``versions`` (name, version) in the range.

    Precedence is that of semantic versions, so 1.10.0 is above 1.9.0 and 2.0.0-rc.1 below 2.0.0. An
    interval's greatest version is the last one before its upper end: an as-of join by key instead of a
    range join. ``version`` is NULL when nothing fits or the specifier is no range (``is_range``).
    """
    ranges = wanted.select("name", "specifier").distinct().withColumn("alternatives", range_bounds(F.col("specifier")))
    known = versions.select("name", "version", version_key(F.col("version")).alias("key")).filter("key IS NOT NULL").distinct()
    parts = ranges.select("name", "specifier", F.explode("alternatives").alias("a")).select("name", "specifier", "a.low", "a.high", "a.pre_bases").filter("low < high")
    releases = known.filter(~is_prerelease(F.col("key")))
    best = as_of(_before(parts), _marked(releases), ["name"], "at", ["key", "version"], _one)
    named = parts.select("*", F.explode("pre_bases").alias("base"))
    early = _marked(known.filter(is_prerelease(F.col("key")))).withColumn("base", key_base(F.col("key")))
    best_early = as_of(_before(named), early, ["name", "base"], "at", ["key", "version"], _one)
    fits = [x.filter(F.col("found.key") >= F.col("low")).select("name", "specifier", "found.key", "found.version") for x in (best, best_early)]
    chosen = fits[0].unionByName(fits[1]).groupBy("name", "specifier").agg(F.max_by("version", F.struct("key", "version")).alias("version"))
    same = F.col("name").eqNullSafe(F.col("n_")) & F.col("specifier").eqNullSafe(F.col("s_"))
    return ranges.join(chosen.withColumnsRenamed({"name": "n_", "specifier": "s_"}), same, "left").select(
        "name", "specifier", F.col("alternatives").isNotNull().alias("is_range"), "version"
    )


def _before(rows: DataFrame) -> DataFrame:
    """An end is placed before a version with the same key."""
    return rows.withColumn("at", F.struct(F.col("high").alias("key"), F.lit(0).alias("side")))


def _marked(rows: DataFrame) -> DataFrame:
    return rows.withColumn("at", F.struct("key", F.lit(1).alias("side")))
