"""Which stored artifact answers a URL? Six rungs, the lowest rung wins.

1 exact source, 2 source without fragment, 3 gist id, 4 GitHub repository,
5 (name, version), 6 tarball file name. Every rung is an equality of a derived key, so
one hash join serves all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.specs import is_network_type, tarball_name_agrees
from ..functions.values import after, after_last, before, first_non_blank, non_blank, url_path
from .dedup import usable_status

_GIST = r"gist\.github\.com/([^#?]+?)(?:\.git)?/?(?:[#?]|$)"
_GITHUB = r"(?<!gist\.)github\.com/([^/#?]+/[^/#?]+?)(?:\.git)?(?:[/#?]|$)"


def _usable(artifacts: DataFrame) -> DataFrame:
    return artifacts.filter(usable_status(F.col("status"), F.col("cas_path"))).withColumn(
        "url", first_non_blank(F.col("source_url"), F.col("source"))
    )


def _candidates(artifacts: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Usable named registry artifacts, and their score without the freshness."""
    usable = _usable(artifacts).filter(
        (F.col("type") == "registry") & F.col("name").isNotNull() & F.col("version").isNotNull()
    )
    score = [
        tarball_name_agrees(F.col("name"), F.col("version"), F.col("url")),
        non_blank(F.col("integrity")).isNotNull(),
        non_blank(F.col("content_sha256")).isNotNull(),
    ]
    return usable, score


def _rank(*score: Column) -> Column:
    return F.struct(*[s.alias(f"s{i}") for i, s in enumerate(score)], (-F.col("ord")).alias("o"))


def best_artifacts(artifacts: DataFrame, prefer_downloaded: bool) -> DataFrame:
    """One usable registry artifact per (name, version): best score, first on ties.

    Score, in order: file name fits, has integrity, has content hash and, where asked
    for, freshly downloaded. A maximum, not a row number: hot packages combine early.
    """
    usable, score = _candidates(artifacts)
    if prefer_downloaded:
        score.append(F.col("status") == "downloaded")
    kept = F.struct("artifact_id", "url", "integrity", "content_sha256", "cas_path", "status")
    return (
        usable.groupBy("name", "version")
        .agg(F.max_by(kept, _rank(*score)).alias("best"), F.min("ord").alias("first_ord"))
        .select("name", "version", "best.*", "first_ord")
    )


def best_of_both(artifacts: DataFrame) -> DataFrame:
    """(name, version, registry_best, install_best, first_ord): both choices of ``best_artifacts`` in one pass."""
    usable, score = _candidates(artifacts)
    fresh = F.col("status") == "downloaded"
    return usable.groupBy("name", "version").agg(
        F.max_by("artifact_id", _rank(*score, fresh)).alias("registry_best"),
        F.max_by("artifact_id", _rank(*score)).alias("install_best"),
        F.min("ord").alias("first_ord"),
    )


def source_keys(artifacts: DataFrame) -> DataFrame:
    """(key, artifact_id, type, first_ord): full and fragment-less sources, last wins."""
    keyed = (
        _usable(artifacts)
        .filter(is_network_type(F.col("type")) & F.col("url").isNotNull())
        .select(
            "artifact_id",
            "type",
            "ord",
            F.explode(F.array_distinct(F.array(F.col("url"), before(F.col("url"), "#")))).alias("key"),
        )
    )
    return (
        keyed.groupBy("key")
        .agg(F.max_by(F.struct("artifact_id", "type"), "ord").alias("last"), F.min("ord").alias("first_ord"))
        .select("key", "last.artifact_id", "last.type", "first_ord")
    )


def ladder_keys(artifacts: DataFrame) -> DataFrame:
    """(rung, key, artifact_id), unique per (rung, key): sources and packages are each computed once."""
    stem = F.concat(after_last(F.col("name"), "/"), F.lit("-"), F.col("version"))
    fits = tarball_name_agrees(F.col("name"), F.col("version"), F.col("url"))
    is_git = F.col("type") == "git"

    def keys(frame: DataFrame, **rungs: Column) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(int(n[1:])).alias("rung"), key.alias("key")) for n, key in rungs.items()])
        wanted = F.filter(entries, lambda e: non_blank(e["key"]).isNotNull())
        return frame.select("artifact_id", "first_ord", F.inline(wanted))

    of_sources = keys(
        source_keys(artifacts),
        r1=F.col("key"),
        r3=F.when(is_git, F.regexp_extract("key", _GIST, 1)),
        r4=F.when(is_git, F.regexp_extract("key", _GITHUB, 1)),
    )
    of_packages = keys(
        best_artifacts(artifacts, prefer_downloaded=False),
        r5=_package_key("name", "version"),
        r6=F.when(fits, stem),
        r7=F.when(fits, _package_key("name", stem)),
    )
    both = of_sources.unionByName(of_packages)
    return both.groupBy("rung", "key").agg(F.min_by("artifact_id", "first_ord").alias("artifact_id"))


def _package_key(name: Column | str, rest: Column | str) -> Column:
    return F.concat_ws("\n", name, rest)


def resolve_urls(urls: DataFrame, artifacts: DataFrame) -> DataFrame:
    """(url, name, version) -> artifact_id and rung, one row per distinct input.

    ``name`` and ``version`` may be ''. Inputs are made distinct first: a URL that
    millions of locks share is looked up once.
    """
    distinct = urls.select("url", "name", "version").distinct()
    url, plain = F.col("url"), before(F.col("url"), "#")
    alias = F.regexp_replace(before(after(url, ":"), "#"), r"\.git$", "")
    path = F.btrim(url_path(plain), F.lit("/"))
    package = F.when(
        F.contains(path, F.lit("/-/")), non_blank(F.regexp_replace(before(path, "/-/"), "^registry/", ""))
    )
    stem = non_blank(F.regexp_extract(after_last(path, "/"), r"^(.*)\.tgz$", 1))
    both_names = (F.col("name") != "") & (F.col("version") != "")

    def rung(rank: int, table: int | Column, key: Column) -> Column:
        number = F.lit(table) if isinstance(table, int) else table
        return F.struct(F.lit(rank).alias("rank"), number.alias("rung"), key.alias("key"))

    tries = F.array(
        rung(1, 1, url),
        rung(2, 1, F.when(plain != url, plain)),
        rung(3, 3, F.when(F.startswith(url, F.lit("gist:")), alias)),
        rung(4, 4, F.when(F.startswith(url, F.lit("github:")), alias)),
        rung(5, 5, F.when(both_names, _package_key("name", "version"))),
        rung(
            6,
            F.when(package.isNull(), 6).otherwise(7),
            F.when(package.isNull(), stem).when(stem.isNotNull(), _package_key(package, stem)),
        ),
    )
    asked = distinct.select(
        "url", "name", "version", F.explode(F.filter(tries, lambda t: t["key"].isNotNull())).alias("t")
    ).select("url", "name", "version", "t.rank", "t.rung", "t.key")
    hits = asked.join(ladder_keys(artifacts), ["rung", "key"])
    return (
        hits.groupBy("url", "name", "version")
        .agg(F.min_by("artifact_id", "rank").alias("artifact_id"), F.min("rank").alias("rank"))
    )
