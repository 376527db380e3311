"""Repeated passages: which windows of fixed length occur again, over all documents.

A window of ``window`` units (words or bytes) is routed by an anchor that depends on its content
alone: the smallest fingerprint among the runs of ``gram`` units that it holds. Equal windows have
equal anchors, so they meet under one key. Consecutive windows with the same anchor are one segment.

1. Every document is cut into segments; only (anchor, document, place) is kept.
2. An anchor that stands in one place only needs no further work. The rest are few.
3. For these, the segments' content is cut out. Equal texts count once, with their smallest id and
   their number, and so do equal segments of different texts, before anything is shuffled by anchor.
4. Distinct segments come to the tasks sorted by anchor. A task fills shards with whole anchors and
   indexes each: this part is the operators' own.

An anchor with more than ``HOT`` distinct segments is dealt out further: its segments are cut into
single windows, and equal windows have equal content, so they are routed by that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import WORD_VISIBLE, grams, range_sums, ranges, signed, slices, stored, text_bytes, words

#: Distinct segments under one anchor that one task takes.
HOT = 2000
#: Windows of a segment, at most, in windows' lengths.
LONGEST = 4
#: Windows cut at once; packed with a fingerprint in 64 bits.
PIECE = 1 << 19
_PLACE = np.uint64((1 << 21) - 1)
SLICE_BYTES = 1 << 20


class Unit:
    """What a text consists of: words or bytes."""

    def __init__(self, kind: str, window: int, gram: int) -> None:
        self.kind, self.window, self.gram = kind, window, gram

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes, the units' fingerprints, their starts and ends in the bytes, and each row's first unit."""
        data, bounds = text_bytes(column)
        if self.kind == "words":
            prints, starts, ends, rows = words(data, bounds, WORD_VISIBLE, lower=False)
            return data, prints, starts, ends, rows
        place = np.arange(len(data) + 1)
        return data, data.astype(np.uint64) + np.uint64(1), place[:-1], place[1:], bounds


def segments(prints: np.ndarray, rows: np.ndarray, unit: Unit) -> tuple[np.ndarray, ...]:
    """(row, first window in the row, windows, anchor, repeats) of the segments of some texts.

    ``repeats``: the anchor stands in several places of the segment.
    """
    found = []
    span = unit.window - unit.gram + 1
    for row, (a, b) in _pieces(rows, unit.window):
        if b - a < unit.window:
            continue  # no window fits
        part = prints[a:b]
        anchors = grams(part, unit.gram)
        packed = (anchors & ~_PLACE) | np.arange(len(anchors), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            packed = np.minimum(packed[:-width], packed[width:])
            width *= 2
        if width < span:
            packed = np.minimum(packed[: len(packed) - (span - width)], packed[span - width :])
        # windows that lie inside one row
        inner = np.maximum(np.minimum(rows[row + 1], b) - np.maximum(rows[row], a) - unit.window + 1, 0)
        starts = ranges(np.maximum(rows[row], a) - a, inner)
        of = np.repeat(row, inner)
        place = (packed[starts] & _PLACE).astype(np.int64)
        anchor = anchors[place]
        if not len(starts):
            continue
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (of[1:] != of[:-1]) | (anchor[1:] != anchor[:-1])
        moved = np.zeros(len(starts), dtype=np.int64)
        moved[1:] = (place[1:] != place[:-1]) & ~new[1:]
        first = np.flatnonzero(new)
        count, repeats = np.diff(np.append(first, len(starts))), np.add.reduceat(moved, first) > 0
        # a periodic text can keep its anchor for very long: such a segment is cut
        parts = -(-count // (LONGEST * unit.window))
        offset = ranges(np.zeros(len(first), dtype=np.int64), parts) * LONGEST * unit.window
        first, count, repeats = (np.repeat(x, parts) for x in (first, count, repeats))
        count = np.minimum(count - offset, LONGEST * unit.window)
        found.append((of[first], starts[first] + a - rows[of[first]] + offset, count, anchor[first], repeats))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty, empty, empty, empty.view(np.uint64), empty > 0
    return tuple(np.concatenate(x) for x in zip(*found))


def _pieces(rows: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, tuple[int, int]]]:
    """Runs of whole rows, or overlapping parts of a long row, of about PIECE units."""
    at, n = 0, len(rows) - 1
    while at < n:
        if rows[at + 1] - rows[at] > PIECE:
            for a in range(rows[at], max(rows[at] + 1, rows[at + 1] - window + 1), PIECE):
                yield np.array([at]), (a, min(a + PIECE + window - 1, rows[at + 1]))
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(rows, rows[at] + PIECE, side="right")) - 1)
        yield np.arange(at, to), (rows[at], rows[to])
        at = to


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _anchored(unit: Unit):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                _, prints, _, _, rows = unit.read(_column(batch, "text"))
                row, start, n, anchor, repeats = segments(prints, rows, unit)
                at = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [_column(batch, "doc_id").take(at), _column(batch, "text_key").take(at), pa.array(signed(anchor)), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(repeats)],
                    names=["doc_id", "text_key", "anchor", "start", "n"] + ["repeats"],
                )

    return run


def _cut(unit: Unit):
    """The content of the listed segments of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                data, prints, starts, ends, rows = unit.read(_column(batch, "text"))
                list_ = _column(batch, "segments")
                per_row = list_.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = list_.flatten()
                anchor, start, n = (flat.field(k).to_numpy() for k in range(3))
                row = np.repeat(np.arange(batch.num_rows), per_row)
                a = rows[row] + start
                b = a + n + unit.window - 1
                content = _fingerprints(prints, a, b)
                for k in range(0, len(row), 4096):
                    part = slice(k, k + 4096)
                    at = pa.array(row[part])
                    body = [data[x:y].tobytes() for x, y in zip(starts[a[part]], ends[b[part] - 1])]
                    yield pa.RecordBatch.from_arrays(
                        [*(_column(batch, c).take(at) for c in ("doc_id", "text_key", "copies")), pa.array(anchor[part]), pa.array(start[part]), pa.array(n[part]), pa.array(signed(content[part])), pa.array(body, pa.binary())],
                        names=["doc_id", "text_key", "copies", "anchor", "start", "n", "content", "body"],
                    )

    return run


def _fingerprints(prints: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """range_sums of many ranges of a long array, without powers of its whole length."""
    found = np.empty(len(a), dtype=np.uint64)
    at = 0
    while at < len(a):
        to = max(at + 1, int(np.searchsorted(b, a[at] + PIECE, side="right")))
        found[at:to] = range_sums(prints[a[at] : b[at:to].max()], a[at:to] - a[at], b[at:to] - a[at])
        at = to
    return found


def _windows(unit: Unit):
    """Single windows of each segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                data, prints, starts, ends, rows = unit.read(_column(part, "body"))
                n = _column(part, "n").to_numpy()
                row = np.repeat(np.arange(part.num_rows), n)
                start = ranges(np.zeros(part.num_rows, dtype=np.int64), n)
                a = rows[row] + start
                content = _fingerprints(prints, a, a + unit.window)
                at = pa.array(row)
                body = [data[x:y].tobytes() for x, y in zip(starts[a], ends[a + unit.window - 1])]
                same = [_column(part, c).take(at) for c in ("doc_id", "text_key", "copies")]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(signed(content)), pa.array(_column(part, "start").to_numpy()[row] + start), pa.array(np.ones(len(a), dtype=np.int64)), pa.array(signed(content)), pa.array(body, pa.binary())],
                    names=["doc_id", "text_key", "copies", "anchor", "start", "n", "content", "body"],
                )

    return run


def shared_segments(docs: DataFrame, unit: Unit, place: Column) -> DataFrame:
    """(doc_id, text_key, copies, anchor, start, n, content, body): segments whose anchor stands in several places.

    ``docs``: doc_id, text_key, text. ``place`` is a number of a segment's place; anchors with two
    different numbers are shared. Equal texts give one row, with the smallest id and their number.
    """
    schema = docs.select("doc_id", "text_key", *[F.lit(0).cast("long").alias(c) for c in ("anchor", "start", "n")], F.lit(True).alias("repeats")).schema
    anchored = stored(docs.mapInArrow(_anchored(unit), schema), "anchors")
    use = anchored.groupBy("anchor").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.max("repeats").alias("repeats")).filter("low <> high or repeats").select("anchor")
    shared = anchored.join(use, "anchor", "left_semi")
    texts = shared.groupBy("text_key", "anchor", "start", "n").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"))
    lists = texts.groupBy("doc_id", "text_key").agg(F.max("copies").alias("copies"), F.sort_array(F.collect_list(F.struct("anchor", "start", "n"))).alias("segments"))
    # by place, so that a long text's ranges are read in order
    lists = lists.withColumn("segments", F.array_sort("segments", lambda x, y: F.when(x["start"] < y["start"], -1).when(x["start"] > y["start"], 1).otherwise(0)))
    lists = lists.withColumnsRenamed({"doc_id": "d_", "text_key": "k_"})
    once = docs.join(lists, docs["doc_id"].eqNullSafe(F.col("d_")) & (docs["text_key"] == F.col("k_"))).select("doc_id", "text_key", "text", "copies", "segments")
    schema = docs.select("doc_id", "text_key", *[F.lit(0).cast("long").alias(c) for c in ("copies", "anchor", "start", "n", "content")], F.lit(b"").alias("body")).schema
    cut = stored(once.mapInArrow(_cut(unit), schema), "segments")
    hot = cut.groupBy("anchor").agg(F.approx_count_distinct("content").alias("distinct")).filter(F.col("distinct") > HOT).select("anchor")
    hot = stored(hot, "hot-anchors")
    if not hot.limit(1).count():
        return cut
    split = cut.join(hot, "anchor", "left_semi").select(*cut.columns).mapInArrow(_windows(unit), schema)
    return stored(cut.join(hot, "anchor", "left_anti").select(*cut.columns).union(split), "segments")


def distinct_segments(cut: DataFrame) -> DataFrame:
    """(anchor, content, n, owner, copies): each distinct segment with its smallest id and its number."""
    return cut.groupBy("anchor", "content", "n").agg(F.min("doc_id").alias("owner"), F.sum("copies").alias("copies"))


def indexed(cut: DataFrame, index: Callable, limit: int) -> DataFrame:
    """(anchor, content, n, first, last): windows, first to last, of distinct segments that ``index`` reports.

    ``index`` takes the bodies, numbers of windows, owners and copies of a shard's segments and
    returns (segment, first, last). A shard holds whole anchors, of about ``limit`` bytes.
    """
    distinct = cut.groupBy("anchor", "content", "n").agg(F.min("doc_id").alias("owner"), F.sum("copies").alias("copies"), F.first("body").alias("body"))

    def shard(rows: pa.Table) -> pa.RecordBatch:
        anchor, content, n, owners, copies = (rows[c].fill_null(0).to_numpy() for c in ("anchor", "content", "n", "owner", "copies"))
        segment, first, last = index(rows["body"].combine_chunks(), n, owners, copies)
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (anchor[segment], content[segment], n[segment], first, last)], names=["anchor", "content", "n", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < 2 * limit:
                continue
            rows = pa.concat_tables(held).combine_chunks()
            bytes_ = np.cumsum(pc.binary_length(rows["body"]).to_numpy())
            anchor = rows["anchor"].to_numpy()
            ends = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1  # the last anchor may go on
            at = 0
            while len(ends):
                full = ends[bytes_[ends - 1] - (bytes_[at - 1] if at else 0) >= limit]
                if not len(full):
                    break
                yield shard(rows.slice(at, int(full[0]) - at))
                at = int(full[0])
                ends = ends[ends > at]
            held, size = [rows.slice(at)], int(bytes_[-1] - (bytes_[at - 1] if at else 0))
        if held and sum(x.num_rows for x in held):
            rows = pa.concat_tables(held).combine_chunks()
            anchor = rows["anchor"].to_numpy()
            bytes_ = np.cumsum(pc.binary_length(rows["body"]).to_numpy())
            ends, at = np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, len(anchor)), 0
            while at < len(anchor):
                full = ends[(ends > at) & (bytes_[ends - 1] - (bytes_[at - 1] if at else 0) >= limit)]
                to = int(full[0]) if len(full) else len(anchor)
                yield shard(rows.slice(at, to - at))
                at = to

    found = distinct.select("anchor", "content", "n", "owner", "copies", "body").repartition("anchor").sortWithinPartitions("anchor")
    return found.mapInArrow(run, "anchor long, content long, n long, first long, last long")


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """The ranges as few disjoint ones, in order."""
    out: list[list[int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def with_ranges(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with ``ranges`` (array of from, to) and ``whole`` (everything goes).

    ``found``: doc_id, text_key, from, to; a row without ``from`` marks the whole text.
    """
    lists = found.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.when(F.col("from").isNotNull(), F.struct("from", "to"))).alias("ranges"), F.max(F.col("from").isNull()).alias("whole")
    )
    lists = lists.select(F.col("doc_id").alias("d_"), F.col("text_key").alias("k_"), "ranges", "whole")
    return docs.join(lists, docs["doc_id"].eqNullSafe(F.col("d_")) & (docs["text_key"] == F.col("k_")), "left").drop("d_", "k_")
