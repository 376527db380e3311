"""From roots and files to references: choose the lock, parse it by manager."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import first_non_blank
from .bun import parse_bun
from .manifest import manifests_missing, parse_manifests
from .npm import parse_npm
from .parsed import parsed_columns
from .pnpm import parse_pnpm
from .yarn import parse_yarn

# Fixed values.
LOCK_NAMES = {
    "package-lock.json": "npm",
    "npm-shrinkwrap.json": "npm",
    "pnpm-lock.yaml": "pnpm",
    "yarn.lock": "yarn",
    "bun.lock": "bun",
    "bun.lockb": "bun",
}
PARSERS = {"npm": parse_npm, "pnpm": parse_pnpm, "yarn": parse_yarn, "bun": parse_bun}


def parse_locks(locks: DataFrame) -> DataFrame:
    """PARSED rows of all locks; ``package_manager`` says which parser reads a file.

    Each branch filters on the manager, so store ``files`` partitioned or clustered by
    it: every parser then scans its own part only.
    """
    branches = [parse(locks.filter(F.col("package_manager") == m)) for m, parse in PARSERS.items()]
    known = F.coalesce(F.col("package_manager").isin(*PARSERS), F.lit(False))
    reason = F.concat(F.lit("unsupported package manager: "), F.coalesce("package_manager", F.lit("none")))
    branches.append(locks.filter(~known).select(*parsed_columns(problem=reason)))
    return reduce(DataFrame.unionByName, branches)


def match_resolutions(
    resolutions: DataFrame, profiles: DataFrame, roots: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(matched, unmatched): unmatched rows say whether profile or root is missing."""
    known_profiles = profiles.select("profile_id").distinct().withColumn("has_profile", F.lit(True))
    known_roots = roots.select("profile_id", "dependency_root").distinct().withColumn("has_root", F.lit(True))
    joined = resolutions.join(known_profiles, "profile_id", "left").join(
        known_roots, ["profile_id", "dependency_root"], "left"
    )
    reason = F.when(F.col("has_profile").isNull(), "profile missing from discovery").when(
        F.col("has_root").isNull(), "dependency root missing from discovery"
    )
    judged = joined.withColumn("reason", reason).drop("has_profile", "has_root")
    return judged.filter(F.col("reason").isNull()).drop("reason"), judged.filter(F.col("reason").isNotNull())


def parse_roots(resolutions: DataFrame, roots: DataFrame, files: DataFrame) -> DataFrame:
    """PARSED rows of every resolved root: its lock, its package.json, what is missing.

    Files are parsed where they lie, by their names; only parsed rows and names meet the
    roots, so no content is shuffled. A lock whose name is not one of its manager's, and
    a resolution without a root, give a problem row.
    """
    key = ["profile_id", "dependency_root"]
    known = roots.select(*key, "package_manager", F.lit(True).alias("_known"))
    filename = first_non_blank(F.col("resolved_lockfile"), F.col("source_lockfile"))
    named = resolutions.select(*key, filename.alias("filename"), "classification").join(known, key, "left")
    names = files.select(*key, "filename", F.lit(True).alias("_there")).distinct()
    chosen = named.join(names, [*key, "filename"], "left")
    fits = F.col("package_manager").eqNullSafe(manager_of(F.col("filename")))
    manager = F.coalesce("package_manager", F.lit("none"))
    problem = (
        F.when(F.col("_known").isNull(), "dependency root missing from discovery")
        .when(
            F.col("_there").isNull(),
            F.when(~F.col("classification").eqNullSafe("unsupported_or_manual_review"), "resolved lockfile missing"),
        )
        .when(~F.coalesce(F.col("package_manager").isin(*PARSERS), F.lit(False)), F.concat(F.lit("unsupported package manager: "), manager))
        .when(~fits, F.concat(F.lit("not a lockfile of "), manager))
    )
    judged = chosen.withColumn("_problem", problem)
    problems = judged.filter(F.col("_problem").isNotNull()).select(*parsed_columns(problem=F.col("_problem")))
    wanted = judged.filter(F.col("_known") & F.col("_there") & F.col("_problem").isNull()).select(*key, "filename").distinct()
    locks = files.select(*key, "filename", "content", manager_of(F.col("filename")).alias("package_manager"))
    parsed = parse_locks(locks.filter(F.col("package_manager").isNotNull())).join(wanted, [*key, "filename"], "left_semi")
    of_roots = chosen.filter(F.col("_known")).select(*key).distinct()
    manifests = parse_manifests(files.filter(F.col("filename") == "package.json")).join(of_roots, key, "left_semi")
    return (
        parsed.unionByName(problems)
        .unionByName(manifests)
        .unionByName(manifests_missing(of_roots, files.select(*key, "filename")))
    )


def manager_of(filename: Column) -> Column:
    """The package manager whose lock has this name, else NULL."""
    names = F.create_map(*[F.lit(x) for pair in LOCK_NAMES.items() for x in pair])
    return F.try_element_at(names, F.substring_index(filename, "/", -1))
