"""Packing: optimal length buckets from the global histogram, token-budget batches inside each.

Texts are cut into pieces of at most ``max_length`` words, so the histogram has at most that many
rows and fits the driver. Dynamic programming over it finds the bucket lengths with the least
padding. Only ids and lengths are shuffled. Pieces are numbered inside (bucket, slice of ids), and
the slices' counts are added up to numbers inside the bucket: no task sees a whole bucket.

Defined results: null, empty and blank texts have no words and get one row without bucket and batch;
a very long text becomes many pieces; repeated rows are packed each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window as W, functions as F

MAX_LENGTH = 2048
BUCKETS = 8
TOKEN_BUDGET = 16_384
#: Expected pieces in a numbered slice.
SLICE_ROWS = 20_000


def pieces(docs: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """(doc_id, piece, start, n_tokens): runs of at most ``max_length`` words of each text."""
    n = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^ \t-\r]+"))
    counted = docs.select("doc_id", n.cast("long").alias("n"))
    last = F.greatest(F.ceil(F.col("n") / max_length) - 1, F.lit(0)).cast("int")
    cut = counted.select("doc_id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("long") * max_length
    return cut.select("doc_id", "piece", start.alias("start"), F.least(F.lit(max_length), F.col("n") - start).cast("int").alias("n_tokens"))


def bucket_lengths(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """The bucket lengths, at most ``buckets``, that minimise padding; of equal ones, the first found."""
    histogram = sorted((n, c) for n, c in histogram if n > 0)
    if not histogram:
        return []
    length, count = (np.array(x, dtype=np.float64) for x in zip(*histogram))
    pieces_, tokens = (np.concatenate(([0.0], np.cumsum(x))) for x in (count, count * length))
    n = len(length)
    # least[j]: padding of the first j lengths; the last bucket holds the lengths from i to j
    least = np.concatenate(([0.0], length * pieces_[1:] - tokens[1:]))
    choices = [np.zeros(n + 1, dtype=np.int64)]
    for _ in range(min(buckets, n) - 1):
        new, choice = least.copy(), np.zeros(n + 1, dtype=np.int64)
        for j in range(1, n + 1):
            cost = least[:j] + length[j - 1] * (pieces_[j] - pieces_[:j]) - (tokens[j] - tokens[:j])
            choice[j] = int(cost.argmin())
            new[j] = cost[choice[j]]
        least = new
        choices.append(choice)
    bounds, j = [], n
    for choice in reversed(choices):
        if j == 0:
            break
        bounds.append(int(length[j - 1]))
        j = int(choice[j])
    return bounds[::-1]


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET) -> DataFrame:
    """One row per piece: its bucket's length and the number of its batch in the bucket.

    A batch holds at most ``token_budget`` tokens, padding included (one piece if that is longer).
    """
    cut = pieces(docs, max_length)
    histogram = [tuple(r) for r in cut.groupBy("n_tokens").count().collect()]
    bounds = bucket_lengths(histogram, buckets)
    total = sum(c for n, c in histogram if n > 0)
    slices = max(1, -(-total // SLICE_ROWS))
    if not bounds:
        return cut.withColumns({"bucket_length": F.lit(None).cast("int"), "batch": F.lit(None).cast("long")})
    bound = F.lit(None).cast("int")
    for b in reversed(bounds):
        bound = F.when(F.col("n_tokens") <= b, b).otherwise(bound)
    placed = cut.filter("n_tokens > 0").withColumns({"bucket_length": bound, "slice": F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices))})
    counts = placed.groupBy("bucket_length", "slice").agg(F.count("*").alias("rows_"))
    before = W.partitionBy("bucket_length").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("bucket_length", "slice", F.coalesce(F.sum("rows_").over(before), F.lit(0)).alias("offset"))
    nth = F.row_number().over(W.partitionBy("bucket_length", "slice").orderBy("doc_id", "piece"))
    size = F.greatest(F.floor(F.lit(token_budget) / F.col("bucket_length")), F.lit(1))
    numbered = placed.withColumn("nth", nth).join(offsets, ["bucket_length", "slice"])
    columns = ["doc_id", "piece", "start", "n_tokens", "bucket_length"]
    done = numbered.select(*columns, F.floor((F.col("offset") + F.col("nth") - 1) / size).cast("long").alias("batch"))
    empty = cut.filter("n_tokens = 0").select(*columns[:4], F.lit(None).cast("int").alias("bucket_length"), F.lit(None).cast("long").alias("batch"))
    return done.unionByName(empty)
