"""Suffix-array dedup: two-stage sorting of a shard's suffixes, then adjacent common prefixes.

A shard's distinct segments (see ``passages``) are one text of bytes, each segment ended by a
separator. A suffix that is smaller than its successor is of type S, else L. Only the S suffixes are
sorted directly: the text from one S place to the next gets a name in its order, and the sequence of
names is sorted by prefix doubling until ``window`` bytes are covered. The L suffixes are induced by
scanning the buckets of first bytes in order: the suffix before a sorted one goes to the end of what
its bucket has so far. The common prefixes of neighbours in the order are computed from the text;
neighbours that share ``window`` bytes are repeats.

Order matters only up to ``window`` bytes; suffixes that agree that far are neighbours in any order.

Defined results: null, empty and short texts lose nothing; texts of any length are used whole; equal
texts of at least ``window`` bytes lose everything, in all rows; the id plays no part in matching
and may be null; other columns are kept by ``suffix_dedup``. Cutting bytes can split a character:
``suffix_dedup`` drops the rest of such a character, the report digests the bytes as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, text_bytes
from .passages import Unit, indexed, merged, shared_segments, with_ranges

WINDOW, GRAM = 400, 100
SHARD_BYTES = 2 << 20
_SYMBOLS = 7  # of 9 bits in a key


def suffix_types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than their successors. ``text`` ends in a separator (0); the last counts as S."""
    n = len(text)
    differs = np.flatnonzero(text[:-1] != text[1:])
    next_ = np.searchsorted(differs, np.arange(n - 1))
    at = differs[np.minimum(next_, len(differs) - 1)] if len(differs) else np.zeros(n - 1, dtype=np.int64)
    rises = text[at] < text[at + 1] if len(differs) else np.zeros(n - 1, dtype=bool)
    smaller = np.append(rises & (next_ < len(differs)), True)
    return smaller


def _names(text: np.ndarray, smaller: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Order-preserving names of the stretches from each S place to the next, both ends included."""
    n, count = len(text), len(places)
    stop = np.append(places[1:], n - 1)
    coded = (text.astype(np.uint64) << np.uint64(1)) | smaller
    name = np.zeros(count, dtype=np.int64)
    live, offset = np.arange(count), 0
    while True:
        key = np.zeros(len(live), dtype=np.uint64)
        for k in range(_SYMBOLS):
            at = places[live] + offset + k
            here = at <= stop[live]
            key = (key << np.uint64(9)) | np.where(here, coded[np.minimum(at, n - 1)] + np.uint64(1), np.uint64(0))
        if offset == 0:
            order = np.argsort(key, kind="stable")
            old = np.zeros(len(live), dtype=np.int64)
        else:
            order = np.lexsort((key, name[live]))
            old = name[live[order]]
        key, who = key[order], live[order]
        new = np.ones(len(who), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (old[1:] != old[:-1])
        # a name is the number of the first place in order: ties can be split later
        first = np.maximum.accumulate(np.where(new, np.arange(len(who)), 0))
        if offset == 0:
            name[who] = first
        else:
            group = np.ones(len(who), dtype=bool)
            group[1:] = old[1:] != old[:-1]
            start = np.maximum.accumulate(np.where(group, np.arange(len(who)), 0))
            name[who] = old + first - start
        offset += _SYMBOLS
        going = stop[live] - places[live] >= offset
        if not going.any():
            return name
        # ends of equal stretches agree, so all of a tie go on together
        live = live[going]


def sort_smaller(text: np.ndarray, smaller: np.ndarray, window: int) -> np.ndarray:
    """The S places in the order of their suffixes, up to at least ``window`` bytes."""
    places = np.flatnonzero(smaller)
    count = len(places)
    rank = _names(text, smaller, places)
    order = np.argsort(rank, kind="stable")
    reach, bits = 1, max(1, int(count + 1).bit_length())
    index = np.arange(count)
    while reach < count:
        # bytes that ``reach`` stretches cover; a tie that covers the window needs no further sorting
        ordered = rank[order]
        tie = np.zeros(count, dtype=bool)
        same = ordered[1:] == ordered[:-1]
        tie[1:] |= same
        tie[:-1] |= same
        ends = places[np.minimum(order + reach, count - 1)]
        if not (tie & (ends - places[order] < window) & (order + reach < count)).any():
            break
        second = np.zeros(count, dtype=np.int64)
        second[: count - reach] = rank[reach:] + 1
        if 3 * bits <= 63:
            packed = (rank << (2 * bits)) | (second << bits) | index
            packed.sort()
            order = packed & ((1 << bits) - 1)
        else:
            order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        new = np.concatenate(([0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        rank = np.empty(count, dtype=np.int64)
        rank[order] = new
        reach *= 2
    return places[order]


def induce(text: np.ndarray, smaller: np.ndarray, sorted_smaller: np.ndarray) -> np.ndarray:
    """All suffixes in order: L suffixes are placed by scanning the buckets from the smallest byte on."""
    heads = text[sorted_smaller]
    cuts = np.searchsorted(heads, np.arange(258))
    arrived: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []

    def send(found: np.ndarray, bucket: int) -> np.ndarray:
        """Hands the L suffixes before the found ones to their buckets; returns those of this bucket."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = text[before]
        here = before[first == bucket]
        before, first = before[first != bucket], first[first != bucket]
        by = np.argsort(first, kind="stable")
        before, first = before[by], first[by]
        bounds = np.flatnonzero(np.concatenate(([True], first[1:] != first[:-1]))) if len(first) else []
        for a, part in zip(bounds, np.split(before, bounds[1:]) if len(first) else []):
            arrived[int(first[a])].append(part)
        return here

    for bucket in range(257):
        queue = arrived[bucket]
        k = 0
        while k < len(queue):
            out.append(queue[k])
            here = send(queue[k], bucket)
            if len(here):
                queue.append(here)
            k += 1
        own = sorted_smaller[cuts[bucket] : cuts[bucket + 1]]
        if len(own):
            out.append(own)
            send(own, bucket)
    return np.concatenate(out)


def suffix_array(text: np.ndarray, window: int) -> np.ndarray:
    """Two-stage sorting of all suffixes, by their first ``window`` bytes at least."""
    smaller = suffix_types(text)
    return induce(text, smaller, sort_smaller(text, smaller, window))


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each place the length of its suffix's common prefix with the suffix before it in order, up to a separator (0).

    Where a suffix and the one before it only go on from the pair one place earlier, the length is that
    pair's less one. All others are compared in the text, eight bytes at a time.
    """
    n = len(text)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    goes_on = np.zeros(n, dtype=bool)
    last = before[:-1]
    goes_on[1:] = (last >= 0) & (before[1:] == last + 1) & (text[:-1] == text[last]) & (text[:-1] != 0)
    ends = np.flatnonzero(text == 0)
    places = np.flatnonzero(~goes_on & (before >= 0))
    others = before[places]
    limit = np.minimum(ends[np.searchsorted(ends, places)] - places, ends[np.searchsorted(ends, others)] - others)
    padded = np.concatenate(((np.maximum(text, 1) - 1).astype(np.uint8), np.zeros(16, dtype=np.uint8)))
    eight = np.ndarray((n + 8,), dtype="<u8", buffer=padded, strides=(1,))
    found, live, done = limit.copy(), np.flatnonzero(limit > 0), 0
    while len(live):
        differ = eight[places[live] + done] ^ eight[others[live] + done]
        ended = differ != 0
        stop = live[ended]
        lowest = differ[ended] & (~differ[ended] + np.uint64(1))
        found[stop] = np.minimum(limit[stop], done + (np.frexp(lowest.astype(np.float64))[1] - 1) // 8)
        done += 8
        live = live[~ended]
        live = live[limit[live] > done]
    first = np.zeros(n, dtype=np.int64)
    first[places] = found
    since = np.maximum.accumulate(np.where(goes_on, 0, np.arange(n)))
    return first[since] - (np.arange(n) - since)


def repeated_windows(window: int):
    """For ``passages.indexed``: windows that stand in several segments, several times in one, or in a repeated one."""

    def index(bodies: pa.Array, n: np.ndarray, owners: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, bounds = text_bytes(bodies)
        count = len(bounds) - 1
        size = np.diff(bounds)
        place = np.arange(len(data)) + np.repeat(np.arange(count), size)
        text = np.zeros(len(data) + count, dtype=np.int64)
        text[place] = data.astype(np.int64) + 1
        order = suffix_array(text, window)
        segment = np.repeat(np.arange(count), size + 1)
        local = np.arange(len(text)) - (bounds[1:] + np.arange(count) - size)[segment]
        # a suffix and the one before it in order stand twice if they share the window
        shares = np.flatnonzero(common_prefixes(text, order)[order] >= window)
        again = np.zeros(len(text), dtype=bool)
        again[order[shares]] = True
        again[order[shares - 1]] = True
        again |= (copies > 1)[segment] & (local + window <= size[segment])
        again &= local < n[segment]
        edge = np.diff(np.concatenate(([0], again.astype(np.int8), [0])))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        return segment[first], local[first], local[last]

    return index


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, from, to) in bytes; without ``from`` the whole text. ``docs``: doc_id, text_key, text."""
    unit = Unit("bytes", window, gram)
    docs = docs.filter("text is not null")
    cut = shared_segments(docs, unit, F.xxhash64("text_key", "start"))
    key = ["anchor", "content", "n"]
    found = indexed(cut, repeated_windows(window), SHARD_BYTES)
    first = cut.select("doc_id", "text_key", "start", *key).join(found, key)
    first = first.select("doc_id", "text_key", (F.col("start") + F.col("first")).alias("from"), (F.col("start") + F.col("last") + window).alias("to"))
    named = docs.filter(F.octet_length("text") >= window).select("doc_id", "text_key", F.md5("text").alias("name"))
    groups = named.groupBy("name").count().filter("count > 1").select("name")
    copies = named.join(groups, "name").select("doc_id", "text_key", F.lit(None).cast("long").alias("from"), F.lit(None).cast("long").alias("to")).distinct()
    return first.union(copies)


def _apply(report: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 * SHARD_BYTES):
                names = batch.schema.names
                column = lambda c: batch.column(names.index(c))  # noqa: E731,B023
                data, bounds = text_bytes(column("text"))
                sizes, removed, spans, digests, texts = np.diff(bounds), [], [], [], []
                for k, (ranges_, all_) in enumerate(zip(column("ranges").to_pylist(), column("whole").to_pylist())):
                    n = int(sizes[k])
                    ranges_ = [(0, n)] if all_ else merged([r["from"] for r in ranges_ or ()], [r["to"] for r in ranges_ or ()])
                    body = data[bounds[k] : bounds[k + 1]]
                    kept, at = [], 0
                    for x, y in [*ranges_, (n, n)]:
                        kept.append(body[at:x].tobytes())
                        at = y
                    left = b"".join(kept)
                    removed.append(sum(y - x for x, y in ranges_))
                    spans.append(len(ranges_))
                    digests.append(hashlib.sha256(left).hexdigest())
                    texts.append(None if report or not column("text")[k].is_valid else left.decode("utf-8", "ignore"))
                if report:
                    numbers = [pa.array(x, pa.int64()) for x in (sizes, removed, spans)]
                    yield pa.RecordBatch.from_arrays([column("doc_id"), *numbers, pa.array(digests, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([column("row"), pa.array(texts, pa.string())], names=["row", "kept_text"])

    return run


def _keyed(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text", *more)


def suffix_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: bytes, bytes removed, runs removed, digest of the rest."""
    keyed = _keyed(docs)
    ready = with_ranges(keyed, repeated_ranges(keyed, window)).select("doc_id", "text", "ranges", "whole")
    return ready.mapInArrow(_apply(True), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def suffix_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without bytes of repeated passages, in all their columns."""
    keyed = _keyed(docs)
    inner = _keyed(docs, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    ready = with_ranges(inner, repeated_ranges(keyed, window)).select("row", "text", "ranges", "whole")
    done = ready.mapInArrow(_apply(False), ready.select("row", F.col("text").alias("kept_text")).schema)
    return done.select(*[F.col("kept_text").alias("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns])
