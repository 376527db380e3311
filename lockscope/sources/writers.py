"""Writers: report tables as CSV or JSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_csv_report(rows: DataFrame, path: str, fields: Sequence[str]) -> None:
    """Fixed column list with a header; other columns are left out."""
    rows.select(*fields).write.mode("overwrite").option("header", True).csv(path)


def write_json_report(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def write_json_by_profile(rows: DataFrame, path: str) -> None:
    """One directory per profile. For many profiles prefer one table sorted by profile."""
    rows.write.mode("overwrite").partitionBy("profile_id").json(path)


def write_table(rows: DataFrame, path: str, cluster_by: Sequence[str] = ()) -> None:
    """Parquet, sorted by ``cluster_by`` across files.

    Give enough columns to tell rows apart: a range cut needs different values, so a
    hot first column is spread only by the ones after it.
    """
    if cluster_by:
        rows = rows.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    rows.write.mode("overwrite").parquet(path)
