"""Query registry, table access and text templates."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import apply_runtime_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given parquet tables as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")

    def dealt(self, name: str, *columns: str) -> DataFrame:
        """Narrow rows of a table, dealt out by their first column before each becomes a long text.

        The number of parts is given: adaptive execution would join narrow ones into one task.
        """
        parts = int(self._spark.conf.get("spark.sql.shuffle.partitions"))
        return getattr(self, name).select(*columns).repartition(parts, F.col(columns[0]))


def query(sql: str | None) -> Callable:
    """Register ``fn(tables) -> DataFrame`` under its own name."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_settings(spark)
            return fn(Tables(spark, sf_dir))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def fill(template: str, **values: Column | str) -> Column:
    """Text with ``<name>`` replaced by the column of that name."""
    parts = re.split(r"<(\w+)>", template)
    pieces = []
    for i, part in enumerate(parts):
        if i % 2:
            value = values.get(part, part)
            pieces.append((F.col(value) if isinstance(value, str) else value).cast("string"))
        elif part:
            pieces.append(F.lit(part))
    return F.concat(*pieces)


def pick(index: Column, *choices: str | None) -> Column:
    """The choice at ``index`` modulo their number."""
    options = F.array(*[F.lit(c).cast("string") for c in choices])
    return F.get(options, (index % len(choices)).cast("int"))


def as_files(df: DataFrame, profile: Column, filename: str | Column, content: Column, *more: Column) -> DataFrame:
    name = F.lit(filename) if isinstance(filename, str) else filename
    return df.select(
        profile.cast("string").alias("profile_id"),
        F.lit(".").alias("dependency_root"),
        name.alias("filename"),
        content.alias("content"),
        *more,
    )
