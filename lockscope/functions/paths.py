"""Working directories, ids and other path-like strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: shape of an accepted profile id.
PROFILE_ID_PATTERN = r"^swesmith/[^/]+__[^/]+\.[0-9a-f]{8}$"


def is_profile_id(value: Column) -> Column:
    return value.rlike(PROFILE_ID_PATTERN)


def safe_profile_id(profile_id: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(profile_id, "^swesmith/", ""), "[^A-Za-z0-9._-]+", "_")


def root_directory_name(root: Column) -> Column:
    return F.when(root == ".", "root").otherwise(F.replace(root, F.lit("/"), F.lit("__")))


def profile_key(owner: Column, repo: Column, commit: Column) -> Column:
    return F.concat(owner, F.lit("__"), repo, F.lit("."), F.substring(commit, 1, 8))


def is_commit(value: Column) -> Column:
    return value.rlike("^[0-9a-f]{40}$")


def normal_path(path: Column) -> Column:
    """Collapse ``.``, ``..`` and doubled slashes; the empty path is ``.``."""
    absolute = F.startswith(path, F.lit("/"))
    up = F.lit("..")

    def step(kept: Column, part: Column) -> Column:
        can_pop = (F.size(kept) > 0) & (F.try_element_at(kept, F.lit(-1)) != up)
        return (
            F.when((part == "") | (part == "."), kept)
            .when((part == up) & can_pop, F.slice(kept, F.lit(1), F.size(kept) - 1))
            .when((part == up) & absolute, kept)
            .otherwise(F.concat(kept, F.array(part)))
        )

    parts = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), step)
    joined = F.array_join(parts, "/")
    return (
        F.when(absolute, F.concat(F.lit("/"), joined))
        .when(joined == "", F.lit("."))
        .otherwise(joined)
    )


def relative_workdir(path: Column) -> Column:
    """An absolute directory loses its first segment (the checkout mount point)."""
    normal = normal_path(path)
    rest = F.regexp_replace(normal, "^/[^/]*/?", "")
    return F.when(F.startswith(normal, F.lit("/")), F.when(rest == "", ".").otherwise(rest)).otherwise(normal)


def join_workdir(current: Column, target: Column) -> Column:
    """Result of changing from ``current`` into ``target`` (quotes removed)."""
    clean = F.btrim(F.btrim(target, F.lit(" \t\r\n")), F.lit("\"'"))
    return F.when(F.startswith(clean, F.lit("/")), relative_workdir(clean)).otherwise(
        normal_path(F.concat(current, F.lit("/"), clean))
    )


def _value_of(options: Column, *names: str) -> Column:
    """The word after the first of the named options, blank if there is none."""
    words = F.filter(F.split(options, r"[\s=]+"), lambda w: w != "")
    following = F.transform(words, lambda w, i: F.when(w.isin(*names), F.get(words, i + 1)))
    return F.coalesce(F.get(F.filter(following, lambda w: w.isNotNull()), 0), F.lit(""))


def option_workdir(options: Column, current: Column) -> Column:
    """Directory named by --prefix/--dir/--cwd, -C or a path-like --filter."""
    named = _value_of(options, "--prefix", "--dir", "--cwd")
    short = _value_of(options, "-C")
    filtered = F.btrim(_value_of(options, "--filter"), F.lit("\"'"))
    return (
        F.when(named != "", join_workdir(current, named))
        .when(short != "", join_workdir(current, short))
        .when(filtered.rlike(r"^\.{0,2}/"), join_workdir(current, F.regexp_replace(filtered, r"\.\.\.$", "")))
        .otherwise(current)
    )
