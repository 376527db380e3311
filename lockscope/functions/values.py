"""Small building blocks: blank handling, JSON values, URL parts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

WHITESPACE = " \t\r\n\f\v"


def strip(value: Column) -> Column:
    """Trim every kind of blank (``trim`` alone removes only spaces)."""
    return F.btrim(value, F.lit(WHITESPACE))


def non_blank(value: Column) -> Column:
    """The empty string counts as missing."""
    return F.nullif(value, F.lit(""))


def first_non_blank(*values: Column) -> Column:
    return F.coalesce(*[non_blank(v) for v in values])


def before(value: Column, separator: str) -> Column:
    """Text before the first separator, or everything."""
    return F.substring_index(value, separator, 1)


def after_last(value: Column, separator: str) -> Column:
    """Text after the last separator, or everything."""
    return F.substring_index(value, separator, -1)


def after(value: Column, separator: str) -> Column:
    """Text after the first separator, or everything."""
    at = F.instr(value, separator)
    return F.when(at > 0, F.substr(value, at + F.lit(len(separator)))).otherwise(value)


# --- JSON values held as VARIANT -------------------------------------------------


# The JSON reader stops after the first value and ignores what follows it. Texts are
# therefore read inside a wrapper whose last member is only reached by a whole text.


STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def read_json(text: Column, schema: str, **options: str) -> Column:
    """struct(doc, whole): ``doc`` of the given type, ``whole`` is NULL for broken texts.

    JSON is read strictly unless ``options`` allow more.

    A part of another type than the schema says is NULL and spoils nothing else.
    """
    wrapped = F.concat(F.lit('{"doc":'), text, F.lit(',"whole":1}'))
    return F.from_json(wrapped, f"doc {schema}, whole INT", {**STRICT_JSON, **options})


def json_document(text: Column) -> Column:
    """VARIANT of a whole JSON text, else NULL."""
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"whole"]')))
    last = F.try_variant_get(wrapped, "$[1]", "string")
    whole = (last == "whole") & F.try_variant_get(wrapped, "$[2]", "variant").isNull()
    return F.when(whole, F.try_variant_get(wrapped, "$[0]", "variant"))


def json_fields(value: Column, *names: str) -> Column:
    """struct of the named members, each still VARIANT: one look-up pass for all."""
    return F.try_variant_get(value, "$", "struct<" + ",".join(f"`{n}`: variant" for n in names) + ">")


def text_of(value: Column) -> Column:
    """The string in a VARIANT; numbers, booleans and objects give NULL."""
    return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))


def truthy(value: Column) -> Column:
    """True unless the VARIANT is absent, null, false, zero or empty."""
    empty = F.to_json(value).isin("null", "false", "0", "0.0", '""', "[]", "{}")
    return F.coalesce(~empty, F.lit(False))


def string_map(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,string>")


def json_string(value: Column, path: str = "$") -> Column:
    """The string at ``path``; other types give NULL."""
    return text_of(F.try_variant_get(value, path, "variant"))


# --- URL parts -------------------------------------------------------------------
# parse_url rejects many strings found in lockfiles (blanks, braces), so the parts
# are cut with the generic-URI pattern instead.

_AUTHORITY = r"^(?:[^:/?#]+:)?//(?:[^/?#@]*@)?([^/?#:]*)"
_PATH = r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)"


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _AUTHORITY, 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, _PATH, 1)


def url_fragment(url: Column) -> Column:
    """Text after the first ``#``; NULL when there is none or it is empty."""
    return F.when(F.instr(url, "#") > 0, non_blank(after(url, "#")))


def percent_encode(value: Column, keep: str = "") -> Column:
    """RFC 3986 quoting; characters in ``keep`` stay as they are."""
    text = F.url_encode(value)
    for written, wanted in (("+", "%20"), ("%7E", "~"), ("*", "%2A")):
        text = F.replace(text, F.lit(written), F.lit(wanted))
    for char in keep:
        text = F.replace(text, F.lit(f"%{ord(char):02X}"), F.lit(char))
    return text
