"""Point the URLs inside lockfiles and manifests at local tarballs.

The text of a file stays in its row: URLs are marked in place and the text is cut at
the marks. Only the URLs travel (distinct ones to the ladder, answers back to the row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.values import after_last, json_string, percent_encode, read_json
from .ladder import resolve_urls
from .parsed import FILE_KEY, file_text

# A URL inside text, without the commas and brackets that may follow it.
_URL = r"""(?:https?|git\+https?|git\+ssh|github|gist):[^\s"']*[^\s"',)]"""
# Values of these three keys are taken whole, whatever they look like.
_URL_FIELD = r"""(?<="(?:resolved|tarball|url)":")[^"\\]++"""
_SPEC_VALUE = r"""(?<=:")(?:https?://|git\+|github:|gist:)[^"\\]*+"""
_NEVER = r"(?!)"
MANIFEST_SECTIONS = (
    "dependencies",
    "devDependencies",
    "optionalDependencies",
    "peerDependencies",
    "overrides",
    "resolutions",
)
# Control characters that no lockfile contains: between pieces, and inside a marked one.
_CUT, _SEP = "\u0001\u0002", "\u0003"


def local_url(base_url: str, artifact: Column) -> Column:
    return F.concat(F.lit(f"{base_url}/tarballs/"), percent_encode(artifact), F.lit(".tgz"))


def _mark(
    text: Column, field_pattern: str, text_pattern: str, name: Column | None = None, version: Column | None = None
) -> Column:
    """Put name, version, field value and free URL between marks."""

    def literal(value: Column | None) -> Column:
        return F.regexp_replace(F.coalesce(value, F.lit("")), r"([\\$])", r"\\$1") if value is not None else F.lit("")

    replacement = F.concat(
        F.lit(_CUT), literal(name), F.lit(_SEP), literal(version), F.lit(f"{_SEP}$1{_SEP}$2{_CUT}")
    )
    return F.regexp_replace(text, F.lit(f"({field_pattern})|({text_pattern})"), replacement)


def _replace(marked: DataFrame, artifacts: DataFrame, base_url: str) -> DataFrame:
    """(file key, marked) -> (file key, text, replaced)."""
    cut = marked.select(*FILE_KEY, F.split("marked", _CUT).alias("pieces"))
    odd = F.filter(F.transform("pieces", lambda p, i: F.when(i % 2 == 1, p)), lambda p: p.isNotNull())
    parts = F.split("piece", _SEP)
    is_field = F.get(parts, 2) != ""
    urls = cut.select(*FILE_KEY, F.posexplode(odd).alias("nth", "piece")).select(
        *FILE_KEY,
        "nth",
        F.when(is_field, F.get(parts, 2)).otherwise(F.get(parts, 3)).alias("url"),
        F.when(is_field, F.get(parts, 0)).otherwise("").alias("name"),
        F.when(is_field, F.get(parts, 1)).otherwise("").alias("version"),
    )
    found = resolve_urls(urls, artifacts).select("url", "name", "version", "artifact_id")
    shown = F.coalesce(local_url(base_url, F.col("artifact_id")), "url")
    answers = (
        urls.join(found, ["url", "name", "version"], "left")
        .groupBy(*FILE_KEY)
        .agg(
            F.array_sort(F.collect_list(F.struct("nth", shown.alias("url")))).alias("answers"),
            F.count("artifact_id").alias("replaced"),
        )
    )
    filled = F.transform(
        "pieces",
        lambda p, i: F.when(i % 2 == 1, F.get("answers", F.floor(i / 2).cast("int"))["url"]).otherwise(p),
    )
    return cut.join(answers, FILE_KEY, "left").select(
        *FILE_KEY,
        F.array_join(filled, "").alias("text"),
        F.coalesce("replaced", F.lit(0)).alias("replaced"),
    )


def rewrite_text_locks(files: DataFrame, artifacts: DataFrame, base_url: str) -> DataFrame:
    """Any lockfile as plain text: every URL that an artifact answers is replaced."""
    marked = files.select(*FILE_KEY, _mark(file_text(), _NEVER, _URL).alias("marked"))
    return _replace(marked, artifacts, base_url)


def _quoted(key: Column) -> Column:
    text = F.to_json(F.array(key))
    return F.substring(text, 2, F.length(text) - 2)


def _object_text(members: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def rewrite_json_locks(files: DataFrame, artifacts: DataFrame, base_url: str) -> DataFrame:
    """npm locks: ``resolved``, ``tarball`` and ``url`` also match by the entry's own
    (name, version); other strings match as URLs. Locks without a ``packages`` map and
    unreadable ones go through as text. Output is compact JSON in the order of the file.
    """
    lock = files.select(*FILE_KEY, file_text().alias("text")).select(
        *FILE_KEY,
        "text",
        read_json(F.col("text"), "STRUCT<packages: MAP<STRING,VARIANT>>").alias("lock"),
        read_json(F.col("text"), "MAP<STRING,VARIANT>")["doc"].alias("top"),
    )
    lock = lock.withColumn("packages", F.when(F.col("lock.whole") == 1, F.col("lock.doc.packages"))).drop("lock")

    def entry_text(entry: Column) -> Column:
        path = entry["key"]
        inferred = F.when(F.contains(path, F.lit("node_modules/")), after_last(path, "node_modules/"))
        value = entry["value"]
        name = F.coalesce(json_string(value, "$.name"), inferred)
        body = _mark(F.to_json(value), _URL_FIELD, _URL, name, json_string(value, "$.version"))
        return F.concat(_quoted(path), F.lit(":"), body)

    packages = _object_text(F.transform(F.map_entries("packages"), entry_text))

    def member(entry: Column) -> Column:
        body = F.when(entry["key"] == "packages", packages).otherwise(F.to_json(entry["value"]))
        return F.concat(_quoted(entry["key"]), F.lit(":"), body)

    whole = _object_text(F.transform(F.map_entries("top"), member))
    marked = F.when(F.col("packages").isNotNull(), whole).otherwise(_mark(F.col("text"), _NEVER, _URL))
    return _replace(lock.select(*FILE_KEY, marked.alias("marked")), artifacts, base_url)


def rewrite_manifests(files: DataFrame, artifacts: DataFrame, base_url: str) -> DataFrame:
    """package.json: URL specifiers of six sections. Unreadable files stay as they are."""
    doc = files.select(*FILE_KEY, file_text().alias("text")).withColumn(
        "read", read_json(F.col("text"), "MAP<STRING,VARIANT>")
    )
    doc = doc.withColumn("top", F.when(F.col("read.whole") == 1, F.col("read.doc")))

    def member(entry: Column) -> Column:
        body = F.to_json(entry["value"])
        spec = F.when(entry["key"].isin(*MANIFEST_SECTIONS), _mark(body, _SPEC_VALUE, _NEVER)).otherwise(body)
        return F.concat(_quoted(entry["key"]), F.lit(":"), spec)

    whole = _object_text(F.transform(F.map_entries("top"), member))
    marked = doc.select(*FILE_KEY, F.coalesce(whole, "text").alias("marked"))
    return _replace(marked, artifacts, base_url)
