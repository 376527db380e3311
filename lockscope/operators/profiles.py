"""Profile index, and the evidence behind what was found about a profile."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions.paths import is_commit, profile_key
from ..functions.specs import split_package_manager
from ..functions.values import non_blank
from .dockerfile import image_tag, version_mentions


def index_profiles(definitions: DataFrame) -> DataFrame:
    """One row per key ``owner__repo.commit8``; the last definition (by ``ord``) wins.

    Definitions without a full commit hash are dropped.
    """
    keyed = definitions.filter(is_commit(F.col("commit"))).withColumn(
        "profile_key", profile_key(F.col("owner"), F.col("repo"), F.col("commit"))
    )
    kept = F.struct(*definitions.columns)
    return keyed.groupBy("profile_key").agg(F.max_by(kept, "ord").alias("p")).select("profile_key", "p.*")


def match_profiles(ids: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(found, failures): ids with their definition, and ids without one."""
    keyed = ids.withColumn("profile_key", F.regexp_replace("profile_id", "^swesmith/", ""))
    joined = keyed.join(index.withColumn("_known", F.lit(True)), "profile_key", "left")
    found = joined.filter("_known").drop("_known", "profile_key")
    failures = joined.filter(F.col("_known").isNull()).select(
        *ids.columns, F.lit("profile not found in official source").alias("error")
    )
    return found, failures


def evidence_rows(instructions: DataFrame, installs: DataFrame, files: DataFrame) -> DataFrame:
    """(profile_id, dependency_root, kind, line, value) of all detectors.

    ``files`` are FILES rows: each known file is evidence, and so is a well-formed
    ``packageManager`` field of a package.json. The root is NULL for whole profiles.
    """

    def rows(frame: DataFrame, kind: str, root: str | None, line: str | None, value: str) -> DataFrame:
        return frame.select(
            "profile_id",
            (F.col(root) if root else F.lit(None)).cast("string").alias("dependency_root"),
            F.lit(kind).alias("kind"),
            (F.col(line) if line else F.lit(None)).cast("int").alias("line"),
            F.col(value).alias("value"),
        )

    base = instructions.filter(F.col("keyword") == "FROM")
    manifests = files.filter(F.col("filename") == "package.json").withColumn(
        "field", split_package_manager(F.get_json_object(F.col("content").cast("string"), "$.packageManager"))
    )
    named = manifests.filter(non_blank(F.col("field.manager")).isNotNull()).withColumn(
        "value", F.concat_ws("@", "field.manager", "field.version")
    )
    parts = [
        rows(base.filter(F.col("value").rlike(image_tag("node"))), "node_image", None, "line", "value"),
        rows(base.filter(F.col("value").rlike(image_tag("bun"))), "bun_image", None, "line", "value"),
        rows(version_mentions(instructions), "package_manager_version", None, "line", "mention"),
        rows(installs, "install_command", "dependency_root", "line", "fragment"),
        rows(named, "package_json_package_manager", "dependency_root", None, "value"),
        rows(files, "dependency_file", "dependency_root", None, "filename"),
    ]
    return reduce(DataFrame.unionByName, parts)
