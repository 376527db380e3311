"""Heavy keys: found by a sketch, dealt out over tasks with the other side copied."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: A key with at least this share of the rows is heavy. So there are at most 1 / SHARE of them.
SHARE = 0.01
#: Keys that the sketch follows: it misjudges a count by a small part of SHARE at most.
TRACKED = 10_000


def group_key(keys: Sequence[str]) -> Column:
    """One never-NULL text for the keys, so that NULL keys are a key like others."""
    return F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")


def heavy_groups(rows: DataFrame, group: str, share: float = SHARE) -> DataFrame:
    """(group, rows): the values of the text column ``group`` with at least ``share`` of the rows, and about how many.

    A frequent-items sketch, merged from all tasks; no key is shuffled. At most 1 / share rows, never NULL.
    """
    top = rows.filter(F.col(group).isNotNull()).agg(
        F.expr(f"approx_top_k(`{group}`, {int(2 / share)}, {TRACKED})").alias("top"), F.count("*").alias("total")
    )
    items = top.select(F.explode("top").alias("x"), "total")
    return items.filter(F.col("x.count") >= F.col("total") * share).select(F.col("x.item").alias(group), F.col("x.count").alias("rows"))


def blank(column: Column) -> Column:
    return F.coalesce(column == "", F.lit(True))


def split_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "left", heavy: DataFrame | None = None, pieces: int = 64, apart: bool = True
) -> DataFrame:
    """``left`` joined with ``right`` on the text column ``key``, with any share of the rows under one key.

    ``heavy``: (key), few rows, for example from ``heavy_groups``. Their rows of the left are dealt out
    over ``pieces`` parts, and their rows of the right, which should be few for each key, are copied to each.
    With ``apart``, NULL and empty keys match nothing and are never shuffled. ``how``: left or inner.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"left or inner, not {how}")
    more = [c for c in right.columns if c != key]
    nothing = blank(F.col(key)) if apart else F.col(key).isNull()
    asked, known = left.filter(~nothing), right.filter(~nothing)
    on = [key]
    if heavy is not None:
        few = F.broadcast(heavy.select(key).distinct().withColumn("_heavy", F.lit(True)))
        dealt = F.when(F.col("_heavy"), F.pmod(F.monotonically_increasing_id(), F.lit(pieces)).cast("int")).otherwise(0)
        copies = F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))
        asked = asked.join(few, key, "left").withColumn("_piece", dealt).drop("_heavy")
        known = known.join(few, key, "left").withColumn("_piece", F.explode(copies)).drop("_heavy")
        on = [key, "_piece"]
    joined = asked.join(known, on, how).select(*left.columns, *more)
    if how == "inner":
        return joined
    kinds = dict(right.dtypes)
    rest = left.filter(nothing).select(*left.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in more])
    return joined.unionByName(rest)
