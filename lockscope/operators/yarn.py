"""Yarn lockfiles, classic and berry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.specs import REGISTRY_BASE, classify_spec, registry_url, split_selector
from ..functions.values import after, before, first_non_blank, strip
from .parsed import FILE_KEY, file_text, parsed_columns

_REVIEWED = ("unknown", "workspace", "local_file", "patch")


def _unquote(value: Column) -> Column:
    plain = strip(value)
    return F.regexp_replace(plain, r"""^(?s)(["'])(.*)\1$""", "$2")


def _indent(line: Column) -> Column:
    return F.length(line) - F.length(F.ltrim(line))


def _field(lines: Column, key: str) -> Column:
    """Last value of ``key``; both ``key value`` and ``key: value`` are written."""
    wanted = F.filter(
        lines, lambda x: F.startswith(x, F.lit(f"{key}: ")) | F.startswith(x, F.lit(f"{key} "))
    )
    line = F.try_element_at(wanted, F.lit(-1))
    value = F.when(F.contains(line, F.lit(": ")) & F.startswith(line, F.lit(f"{key}: ")), after(line, ": "))
    return _unquote(value.otherwise(after(line, " ")))


def parse_yarn(files: DataFrame) -> DataFrame:
    """PARSED rows, one per selector.

    A stanza is a line that does not start with a blank plus the indented lines below
    it, so the text is cut there and no window over lines is needed. Only lines at the
    first indent are fields of the stanza; deeper ones belong to its dependency lists.
    """
    texts = files.select(*FILE_KEY, F.regexp_replace(file_text(), "\r\n?", "\n").alias("text"))
    stanzas = texts.select(*FILE_KEY, F.posexplode(F.split("text", r"\n(?=[^ \n])")).alias("stanza", "piece"))
    lines = F.filter(F.split("piece", "\n"), lambda x: strip(x) != "")
    head = F.rtrim(F.get(F.col("lines"), 0))
    body = F.slice("lines", 2, F.size("lines"))
    first_indent = _indent(F.get(body, 0))
    parsed = (
        stanzas.filter(~F.col("piece").rlike(r"^(?:#|__metadata|\s)") & (F.col("piece") != ""))
        .withColumn("lines", lines)
        .filter(F.endswith(head, F.lit(":")))
        .select(
            *FILE_KEY,
            "stanza",
            F.regexp_replace(head, ":+$", "").alias("head"),
            F.transform(F.filter(body, lambda x: _indent(x) == first_indent), strip).alias("fields"),
        )
        .select(
            *FILE_KEY,
            "stanza",
            *[
                _field(F.col("fields"), key).alias(key)
                for key in ("version", "resolved", "resolution", "integrity", "checksum")
            ],
            F.posexplode(F.split("head", ",")).alias("place", "raw"),
        )
        .filter(F.col("version").isNotNull())
        .withColumn("selector", _unquote(F.col("raw")))
        .withColumn("parts", split_selector(F.col("selector")))
    )
    name = F.coalesce("parts.name", before(F.col("selector"), "@"))
    origin = first_non_blank(F.col("resolved"), F.col("resolution"))
    protocol = F.col("parts.protocol")
    base = classify_spec(origin)
    other_protocol = protocol.isNotNull() & (protocol != "") & (protocol != "npm")
    kind = (
        F.when(F.startswith(origin, F.lit("patch:")) | F.contains(origin, F.lit("@patch:")), "patch")
        .when(F.contains(origin, F.lit("@workspace:")), "workspace")
        .when(other_protocol & (base == "registry"), classify_spec(F.concat(protocol, F.lit(":"))))
        .otherwise(base)
    )
    is_registry = F.col("type") == "registry"
    target = F.when(F.contains("resolution", F.lit("@npm:")), before(F.col("resolution"), "@npm:")).otherwise(
        F.col("name")
    )
    web = F.when(F.col("resolved").rlike("^https?://"), F.col("resolved"))
    typed = parsed.select("*", kind.alias("type"), name.alias("name"), origin.alias("origin"))
    return typed.select(
        *parsed_columns(
            pos=F.shiftleft(F.col("stanza").cast("bigint"), 32) + F.col("place"),
            type=F.col("type"),
            name=F.col("name"),
            version=F.col("version"),
            optional=F.lit(False),
            dev=F.lit(False),
            resolved_url=F.coalesce(web, F.when(is_registry, registry_url(target, F.col("version")))),
            integrity=F.col("integrity"),
            source=F.coalesce("origin", F.lit(REGISTRY_BASE)),
            source_name=F.when(is_registry, target),
            cache_checksum=F.col("checksum"),
            raw_locator=F.col("selector"),
            manual_review=F.when(F.col("type").isin(*_REVIEWED), True),
        )
    )
