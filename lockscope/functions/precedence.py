"""Versions as texts that sort by precedence, and ranges of versions as bounds on these texts.

A key is three numbers of twenty digits and then ``~`` for a release, or ``-`` and the identifiers of a
pre-release. Numbers among these sort by value and before words; a shorter list sorts before a longer one
that it begins. Build metadata does not count.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_VERSION = r"^[v=\s]*(\d+)\.(\d+)\.(\d+)(?:-([0-9A-Za-z.-]+))?(?:\+[0-9A-Za-z.-]+)?\s*$"
_COMPARATOR = r"^(\^|~>?|>=|<=|>|<|=)?[v=]*(\d+|[xX*])(?:\.(\d+|[xX*]))?(?:\.(\d+|[xX*]))?(?:-([0-9A-Za-z.-]+))?(?:\+[0-9A-Za-z.-]+)?$"
_WIDTH = 20
#: Right after a key: below every other key that is greater.
_NEXT = "\x01"
#: Above all keys.
_TOP = "~~"


def _padded(number: Column) -> Column:
    digits = F.regexp_replace(number, "^0+(?=.)", "")
    return F.lpad(digits, _WIDTH, "0")


def _pre_key(pre: Column) -> Column:
    """Identifiers in order; ``!`` ends each, below all their characters."""
    part = lambda x: F.concat(F.when(F.regexp_like(x, F.lit(r"^\d+$")), F.concat(F.lit("0"), _padded(x))).otherwise(F.concat(F.lit("1"), x)), F.lit("!"))
    return F.array_join(F.transform(F.split(pre, r"\."), part), "")


def _key(major: Column, minor: Column, patch: Column, pre: Column) -> Column:
    base = F.concat(_padded(major), _padded(minor), _padded(patch))
    return F.concat(base, F.when(pre != "", F.concat(F.lit("-"), _pre_key(pre))).otherwise(F.lit("~")))


def _groups(text: Column, pattern: str, count: int) -> list[Column]:
    return [F.regexp_extract(text, pattern, k) for k in range(1, count + 1)]


def version_key(version: Column) -> Column:
    """The key of a whole version; NULL for anything else."""
    major, minor, patch, pre = _groups(version, _VERSION, 4)
    return F.when(F.regexp_like(version, F.lit(_VERSION)), _key(major, minor, patch, pre))


def key_base(key: Column) -> Column:
    """The three numbers of a key."""
    return F.left(key, F.lit(3 * _WIDTH))


def is_prerelease(key: Column) -> Column:
    return F.substring(key, 3 * _WIDTH + 1, 1) == "-"


def _up(number: Column) -> Column:
    return (number.cast("decimal(20,0)") + 1).cast("string")


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def _comparator(text: Column) -> Column:
    names = ("sign", "major", "minor", "patch", "pre")
    parts = [g.alias(n) for g, n in zip(_groups(text, _COMPARATOR, 5), names)]
    return F.struct(F.regexp_like(text, F.lit(_COMPARATOR)).alias("known"), *parts)


def _bounds(said: Column) -> Column:
    """struct(low, high, pre_base) of one comparator: low <= key < high; NULL if it is none."""
    sign, pre = said["sign"], said["pre"]
    numbers = [said[n] for n in ("major", "minor", "patch")]
    wild = lambda x: (x == "") | x.isin("x", "X", "*")
    zero = lambda x: F.when(wild(x), F.lit("0")).otherwise(x)
    major, minor, patch = (zero(x) for x in numbers)
    no_major = wild(numbers[0])
    no_minor = no_major | wild(numbers[1])
    no_patch = no_minor | wild(numbers[2])
    minor, patch = F.when(no_minor, F.lit("0")).otherwise(minor), F.when(no_patch, F.lit("0")).otherwise(patch)
    whole = ~no_patch
    here = _key(major, minor, patch, F.when(whole, pre).otherwise(F.lit("")))
    floor = lambda a, b, c: F.concat(_padded(a), _padded(b), _padded(c), F.lit("-"))
    none = F.lit("0")
    above_major, above_minor = floor(_up(major), none, none), floor(major, _up(minor), none)
    # the first version that differs in the last number given
    beyond = F.when(no_minor, above_major).when(no_patch, above_minor).otherwise(F.concat(here, F.lit(_NEXT)))
    caret = (
        F.when((major != "0") | no_minor, above_major)
        .when((minor != "0") | no_patch, above_minor)
        .otherwise(floor(major, minor, _up(patch)))
    )
    tilde = F.when(no_minor, above_major).otherwise(above_minor)
    low = F.when(sign == ">", beyond).when(sign.isin("<", "<="), F.lit("")).otherwise(here)
    high = (
        F.when(sign == "^", caret)
        .when(F.startswith(sign, F.lit("~")), tilde)
        .when(sign.isin(">", ">="), F.lit(_TOP))
        .when(sign == "<", F.when(whole, here).otherwise(floor(major, minor, patch)))
        .otherwise(beyond)
    )
    nothing = no_major & sign.isin("<", ">")
    return F.when(
        said["known"],
        F.struct(
            F.when(no_major, F.lit("")).otherwise(low).alias("low"),
            F.when(nothing, F.lit("")).when(no_major, F.lit(_TOP)).otherwise(high).alias("high"),
            F.when(whole & (pre != ""), key_base(here)).alias("pre_base"),
        ),
    )


def range_bounds(wanted: Column) -> Column:
    """array of struct(low, high, pre_bases, odd): the alternatives of a range as written in a manifest.

    Each alternative is one interval of keys, low <= key < high. A pre-release counts only if a
    comparator of the alternative names a pre-release of the same three numbers (``pre_bases``). NULL when
    some part is not a comparator, as for tags, URLs and paths.
    """
    spans = F.regexp_replace(wanted, r"(\S+)\s+-\s+(\S+)", ">=$1 <=$2")
    joined = F.regexp_replace(spans, r"(\^|~>?|>=|<=|>|<|=)\s+", "$1")

    def interval(part: Column) -> Column:
        said = F.transform(F.filter(F.split(part, r"[\s,]+"), lambda w: w != ""), _comparator)
        return _let(
            F.transform(said, _bounds),
            lambda list_: F.struct(
                F.coalesce(F.array_max(F.transform(list_, lambda b: b["low"])), F.lit("")).alias("low"),
                F.coalesce(F.array_min(F.transform(list_, lambda b: b["high"])), F.lit(_TOP)).alias("high"),
                F.filter(F.transform(list_, lambda b: b["pre_base"]), lambda b: b.isNotNull()).alias("pre_bases"),
                F.exists(list_, lambda b: b.isNull()).alias("odd"),
            ),
        )

    found = F.transform(F.split(joined, r"\|\|"), interval)
    return _let(found, lambda all_: F.when(~F.exists(all_, lambda x: x["odd"]), all_))
