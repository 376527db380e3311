"""Version prefixes, host constraints, run-to-run changes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def version_numbers(value: Column) -> Column:
    """``v1.22.22`` -> [1, 22, 22]; NULL when there is no version."""
    words = F.transform(F.split(value, r"\s+"), lambda w: F.regexp_replace(w, "^v", ""))
    first = F.get(F.filter(words, lambda w: F.left(w, F.lit(1)).between("0", "9")), 0)
    # up to four numbers; what follows the last one does not count
    parts = F.filter(F.split(F.get(F.split(first, "[^0-9.]"), 0), r"\."), lambda p: p != "")
    return F.transform(F.slice(parts, 1, 4), lambda p: p.try_cast("bigint"))


def version_matches(actual: Column, expected: Column) -> Column:
    """Prefix match on numeric parts; no expectation always matches."""
    have, want = version_numbers(actual), version_numbers(expected)
    same = F.slice(have, F.lit(1), F.size(want)) == want
    return F.coalesce(expected == "", F.lit(True)) | F.coalesce(same, F.lit(False))


def host_allows(values: Column, names: list[str]) -> Column:
    """npm ``os``/``cpu`` lists: ``!x`` excludes, other entries must include the host."""
    host = F.array(*[F.lit(n.lower()) for n in names])
    lowered = F.transform(values, F.lower)
    excluded = F.transform(
        F.filter(lowered, lambda v: F.startswith(v, F.lit("!"))), lambda v: F.substr(v, F.lit(2))
    )
    included = F.filter(lowered, lambda v: ~F.startswith(v, F.lit("!")))
    fits = ~F.arrays_overlap(excluded, host) & ((F.size(included) == 0) | F.arrays_overlap(included, host))
    return F.coalesce(fits, F.lit(True))


def absolute_change(first: Column, second: Column) -> Column:
    return second - first


def relative_change(first: Column, second: Column) -> Column:
    return F.try_divide(second - first, first)
