"""Common shape of all parser outputs, and the tables cut from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.specs import REGISTRY_BASE, needs_review, registry_url
from ..functions.values import first_non_blank, non_blank
from ..schemas import PARSED_FIELDS

FILE_KEY = ["profile_id", "dependency_root", "filename"]
#: What a Python helper holds of small files before it hands it on.
HELD_ROWS, HELD_CHARS = 10_000, 8 << 20


def parsed_columns(**values: Column) -> list[Column]:
    """File key plus every PARSED column; the ones not given are NULL."""
    return [F.col(k) for k in FILE_KEY] + [
        values.get(name, F.lit(None)).cast(kind).alias(name)
        for name, kind in PARSED_FIELDS.items()
        if name not in FILE_KEY
    ]


def file_text(content: Column | str = "content") -> Column:
    """File content as text; bytes are read as UTF-8."""
    column = F.col(content) if isinstance(content, str) else content
    return column.cast("string")


def input_order(profile_position: Column | None = None) -> Column:
    """A total order of references: profile (by position, if given), root, lock before manifest, place in the file."""
    rank = F.when(F.col("filename") == "package.json", 1).otherwise(0)
    position = profile_position if profile_position is not None else F.lit(None).cast("bigint")
    return F.struct(position.alias("profile"), F.col("profile_id"), F.col("dependency_root"), rank.alias("source"), F.col("filename"), F.col("pos"))


def reference_rows(parsed: DataFrame) -> DataFrame:
    """Good entries, completed: default source, default registry URL."""
    complete_url = F.when(
        (F.col("type") == "registry") & non_blank(F.col("name")).isNotNull() & non_blank(F.col("version")).isNotNull(),
        first_non_blank(F.col("resolved_url"), registry_url(F.col("name"), F.col("version"))),
    ).otherwise(F.col("resolved_url"))
    default_source = first_non_blank(F.col("resolved_url"), F.lit(REGISTRY_BASE))
    return (
        parsed.filter(F.col("problem").isNull())
        .withColumns({"source": F.coalesce("source", default_source), "resolved_url": complete_url})
        .drop("problem")
    )


def issue_rows(parsed: DataFrame) -> DataFrame:
    """Problems, and good entries that need a look by a person."""
    review = needs_review(F.col("type"), F.col("manual_review"))
    return parsed.filter(F.col("problem").isNotNull() | review).select(
        F.lit("manual_review").alias("kind"),
        F.lit("normalize").alias("stage"),
        "profile_id",
        "dependency_root",
        "name",
        first_non_blank(F.col("specifier"), F.col("source"), F.col("raw_locator")).alias("specifier"),
        "type",
        F.coalesce("problem", F.lit("lockfile entry requires manual review")).alias("reason"),
    )
