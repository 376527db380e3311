"""pnpm lockfiles."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.specs import REGISTRY_BASE, classify_spec, registry_url, split_pnpm_locator
from ..functions.values import after, first_non_blank, json_fields, json_string, non_blank, string_map, text_of, truthy
from .parsed import FILE_KEY, HELD_CHARS, HELD_ROWS, file_text, parsed_columns

SECTIONS = ("packages", "snapshots", "patchedDependencies")
_ENTRY = (
    "profile_id STRING, dependency_root STRING, filename STRING, section STRING, pos BIGINT, locator STRING, "
    "entry STRING"
)


def _yaml_reader(
    sections: tuple[str, ...], columns: list[str], rows: int = HELD_ROWS, chars: int = HELD_CHARS
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """YAML text -> (section, position, key, value as JSON). Spark has no YAML reader.

    Files are handed on together, about ``rows`` entries or ``chars`` characters at a time.

    A closure travels with the plan: workers need no copy of this package.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
        held, size = [], 0
        for batch in batches:
            for *key, text in batch.itertuples(index=False):
                out = []
                try:
                    document = yaml.load(text, loader) or {}
                    for section in sections:
                        entries = document.get(section)
                        if isinstance(entries, dict):
                            for pos, (name, value) in enumerate(entries.items()):
                                said = json.dumps(value, default=str)
                                out.append((*key, section, pos, str(name).encode("utf-8", "replace").decode(), said))
                except Exception:  # whatever a file holds, it is that file's problem
                    out = [(*key, "broken", 0, None, None)]
                held.extend(out)
                size += len(text or "")
                if len(held) >= rows or size >= chars:
                    yield pd.DataFrame(held, columns=columns)
                    held, size = [], 0
        yield pd.DataFrame(held, columns=columns)

    return read


def pnpm_entries(files: DataFrame) -> DataFrame:
    """One row per entry of the three sections; ``broken`` marks unreadable files."""
    texts = files.select(*FILE_KEY, file_text().alias("text"))
    rows = texts.mapInPandas(_yaml_reader(SECTIONS, [*FILE_KEY, "section", "pos", "locator", "entry"]), _ENTRY)
    split = rows.withColumns({"value": F.try_parse_json("entry"), "parts": split_pnpm_locator(F.col("locator"))})
    version = F.coalesce("parts.version", json_string(F.col("value"), "$.version"))
    return split.select(*FILE_KEY, "section", "pos", "locator", "value", "parts.name", version.alias("version"))


def parse_pnpm(files: DataFrame) -> DataFrame:
    """PARSED rows: packages, plus problem rows for patches and bad keys."""
    return package_rows(pnpm_entries(files))


def parse_pnpm_with_snapshots(files: DataFrame) -> DataFrame:
    """PARSED rows plus ``snapshot_locator`` and ``snapshot`` (JSON) where one exists."""
    return package_rows(with_snapshots(pnpm_entries(files)), "snapshot_locator", "snapshot")


def package_rows(entries: DataFrame, *extra: str) -> DataFrame:
    patch = F.col("section") == "patchedDependencies"
    opened = entries.filter(F.col("section") != "snapshots").withColumn(
        "e", json_fields(F.col("value"), "resolution", "optional", "dependencies", "path")
    )
    opened = opened.withColumn("r", json_fields(F.col("e.resolution"), "tarball", "directory", "type", "integrity"))
    fields = opened.select(
        *FILE_KEY,
        "section",
        "pos",
        "locator",
        "name",
        "version",
        *[text_of(F.col(f"r.{name}")).alias(name) for name in ("tarball", "directory", "integrity")],
        text_of(F.col("r.type")).eqNullSafe("directory").alias("marked"),
        truthy(F.col("e.optional")).alias("optional"),
        string_map(F.col("e.dependencies")).alias("dependencies"),
        F.coalesce(text_of(F.col("e.path")), text_of(F.col("value"))).alias("patch_path"),
        _is_object(F.col("value")).alias("is_object"),
        *extra,
    )
    version, tarball = F.col("version"), F.col("tarball")
    has_url = non_blank(tarball).isNotNull()
    kind = (
        F.when(patch, "patch")
        .when(F.startswith("locator", F.lit("link:")), "workspace")
        .when(F.col("marked") | non_blank(F.col("directory")).isNotNull(), "local_file")
        .otherwise(classify_spec(first_non_blank(tarball, version)))
    )
    bad_key = non_blank(F.col("name")).isNull() | non_blank(version).isNull() | ~F.col("is_object")
    problem = (
        F.when(F.col("section") == "broken", "lockfile parse failed")
        .when(patch, "patched dependency")
        .when(bad_key, "unparseable pnpm package locator")
    )
    typed = fields.withColumns({"type": kind, "problem": problem})
    kind = F.col("type")
    local_path = F.coalesce(non_blank(F.col("directory")), after(version, ":"))
    return typed.select(
        *parsed_columns(
            pos=F.col("pos"),
            type=F.when(F.col("section") != "broken", kind),
            name=F.col("name"),
            version=version,
            specifier=F.when(patch, F.col("locator")),
            optional=F.col("optional"),
            dev=F.lit(False),
            resolved_url=F.when((kind == "registry") & ~has_url, registry_url(F.col("name"), version)).otherwise(
                tarball
            ),
            integrity=F.col("integrity"),
            source=F.coalesce(tarball, F.lit(REGISTRY_BASE)),
            path=F.when(patch, F.col("patch_path")).when(kind.isin("workspace", "local_file"), local_path),
            raw_locator=F.col("locator"),
            dependencies=F.col("dependencies"),
            problem=F.col("problem"),
        ),
        *extra,
    )


def _is_object(value: Column) -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.lit(False))


def with_snapshots(entries: DataFrame) -> DataFrame:
    """Entries with the first snapshot of the same (file, name, version); later peers lose.

    A window over one package of one file, so every file is read once and no group is
    larger than its file.
    """
    usable = (
        (F.col("section") == "snapshots")
        & non_blank(F.col("name")).isNotNull()
        & non_blank(F.col("version")).isNotNull()
        & _is_object(F.col("value"))
    )
    same = Window.partitionBy(*FILE_KEY, "name", "version")
    shown = F.struct("locator", F.to_json("value").alias("json"))
    first = F.min_by(F.when(usable, shown), F.when(usable, F.col("pos"))).over(same)
    attached = (F.col("section") == "packages") & F.col("_first").isNotNull()
    return (
        entries.withColumn("_first", first)
        .withColumn("snapshot_locator", F.when(attached, F.col("_first.locator")))
        .withColumn("snapshot", F.when(attached, F.col("_first.json")))
        .drop("_first")
    )
