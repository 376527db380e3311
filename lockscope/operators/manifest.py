"""package.json: dependencies that do not come from a registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.specs import classify_spec
from ..functions.values import json_string, read_json
from .npm import is_broken
from .parsed import FILE_KEY, file_text, parsed_columns

SECTIONS = ("dependencies", "devDependencies", "optionalDependencies", "peerDependencies")
_MANIFEST = "STRUCT<" + ", ".join(f"{s}: MAP<STRING,VARIANT>" for s in SECTIONS) + ">"


def parse_manifests(files: DataFrame) -> DataFrame:
    """PARSED rows of ``package.json`` files; unknown protocols also become issues."""
    texts = files.select(*FILE_KEY, file_text().alias("text"))
    manifest = texts.withColumn("manifest", read_json(F.col("text"), _MANIFEST))
    broken = is_broken("manifest")
    sections = F.array(*[_section(s) for s in SECTIONS])
    entries = F.filter(F.flatten(sections), lambda e: e["type"] != "registry")
    rows = manifest.select(
        *FILE_KEY, F.when(broken, True).alias("broken"), F.posexplode_outer(entries).alias("pos", "e")
    ).filter(F.col("broken") | F.col("e").isNotNull())
    spec, kind = F.col("e.spec"), F.col("e.type")
    return rows.select(
        *parsed_columns(
            pos=F.col("pos"),
            type=kind,
            name=F.col("e.name"),
            specifier=spec,
            optional=F.col("e.section") == "optionalDependencies",
            dev=F.col("e.section") == "devDependencies",
            resolved_url=F.when(kind.isin("git", "http_tarball"), spec),
            source=spec,
            problem=F.when(F.col("broken"), F.lit("invalid package.json")),
        )
    )


def _section(section: str) -> Column:
    pairs = F.coalesce(F.map_entries(F.col(f"manifest.doc.{section}")), F.array())
    named = F.transform(
        pairs,
        lambda p: F.struct(
            F.lit(section).alias("section"),
            p["key"].alias("name"),
            json_string(p["value"]).alias("spec"),
            classify_spec(json_string(p["value"])).alias("type"),
        ),
    )
    return F.filter(named, lambda e: e["spec"].isNotNull())


def manifests_missing(roots: DataFrame, files: DataFrame) -> DataFrame:
    """PARSED problem rows for roots without a package.json."""
    have = files.filter(F.col("filename") == "package.json").select("profile_id", "dependency_root")
    lacking = roots.select("profile_id", "dependency_root").join(
        have, ["profile_id", "dependency_root"], "left_anti"
    )
    return lacking.withColumn("filename", F.lit("package.json")).select(
        *parsed_columns(problem=F.lit("package.json missing"))
    )
