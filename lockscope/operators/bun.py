"""Bun text lockfiles (JSON with comments, bare keys and trailing commas)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.specs import REGISTRY_BASE, classify_spec, registry_url
from ..functions.values import (
    after,
    first_non_blank,
    json_fields,
    json_string,
    non_blank,
    read_json,
    string_map,
    text_of,
    truthy,
)
from .npm import is_broken
from .parsed import FILE_KEY, file_text, parsed_columns

# Strings are kept (group 1); comments and commas before a closing bracket go. The
# possessive forms keep the regex engine's stack flat on long strings.
_COMMENT = r"//[^\n]*+|/\*(?:[^*]++|\*(?!/))*+\*/"
_NOT_JSON = (
    r"""("[^"\\]*+(?:\\.[^"\\]*+)*+"|'[^'\\]*+(?:\\.[^'\\]*+)*+')|"""
    + _COMMENT
    + r"|,(?=(?:\s++|"
    + _COMMENT
    + r")*+[}\]])"
)
_LOCK = "STRUCT<packages: MAP<STRING,VARIANT>>"
_META = ("resolved", "tarball", "optional", "dependencies")
_OPTIONS = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def strict_json(text: Column) -> Column:
    """JSON text without comments and trailing commas."""
    return F.regexp_replace(text, _NOT_JSON, "$1")


def parse_bun(files: DataFrame) -> DataFrame:
    """PARSED rows of ``bun.lock``; a binary ``bun.lockb`` gives one problem row."""
    binary = F.endswith("filename", F.lit(".lockb"))
    texts = files.select(
        *FILE_KEY, binary.alias("binary"), F.when(~binary, strict_json(file_text())).alias("text")
    )
    lock = texts.withColumn("lock", read_json(F.col("text"), _LOCK, **_OPTIONS))
    file_problem = F.when(F.col("binary"), "binary lockfile cannot be read").when(
        is_broken(), "lockfile parse failed"
    )
    rows = lock.select(
        *FILE_KEY,
        file_problem.alias("file_problem"),
        F.posexplode_outer("lock.doc.packages").alias("pos", "key", "entry"),
    ).filter(F.col("key").isNotNull() | F.col("file_problem").isNotNull())

    first = json_string(F.col("entry"), "$[0]")
    strings = F.transform(
        F.try_variant_get("entry", "$", "array<variant>"), lambda x: F.try_variant_get(x, "$", "string")
    )
    digests = F.filter(strings, lambda x: F.startswith(x, F.lit("sha")))
    split = r"^(?s)(.+)@([^@]+)$"
    own = F.coalesce(first.rlike(split), F.lit(False))
    meta = F.col("meta")
    fields = rows.select(
        *FILE_KEY,
        "pos",
        "key",
        "file_problem",
        F.coalesce(first, "key").alias("shown"),
        F.when(own, first).otherwise(F.col("key")).alias("locator"),
        F.when(own, json_fields(F.try_variant_get("entry", "$[2]", "variant"), *_META)).alias("meta"),
        F.try_element_at(digests, F.lit(-1)).alias("integrity"),
    ).withColumns(
        {
            "name": non_blank(F.regexp_extract("locator", split, 1)),
            "version": non_blank(F.regexp_extract("locator", split, 2)),
            "origin": first_non_blank(text_of(meta["resolved"]), text_of(meta["tarball"])),
        }
    )
    shown = F.col("shown")
    kind = (
        F.when(F.contains(shown, F.lit("@workspace:")), "workspace")
        .when(F.contains(shown, F.lit("@github:")) | F.contains(shown, F.lit("@git+")), "git")
        .otherwise(classify_spec(F.col("origin")))
    )
    # the part after the name; a scoped name starts with its own @
    git_locator = F.when(F.col("type") == "git", non_blank(F.regexp_extract(shown, r"^(?s)@?[^@]*@(.*)$", 1)))
    typed = fields.withColumn("type", kind)
    bad_key = F.col("name").isNull() | F.col("version").isNull()
    return typed.select(
        *parsed_columns(
            pos=F.col("pos"),
            type=F.col("type"),
            name=F.col("name"),
            version=F.col("version"),
            optional=truthy(meta["optional"]),
            dev=F.lit(False),
            resolved_url=F.when(F.col("type") == "registry", registry_url(F.col("name"), F.col("version"))).otherwise(
                F.coalesce(git_locator, "origin")
            ),
            integrity=F.col("integrity"),
            source=F.coalesce(git_locator, "origin", F.lit(REGISTRY_BASE)),
            path=F.when(F.col("type") == "workspace", after(shown, "@workspace:")),
            raw_locator=F.col("key"),
            dependencies=string_map(meta["dependencies"]),
            problem=F.coalesce("file_problem", F.when(bad_key, F.lit("unparseable Bun package entry"))),
        )
    )
