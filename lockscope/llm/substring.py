"""Substring dedup: FM-index per shard, matching statistics by backward search.

A shard's distinct segments (see ``passages``) become one text of word numbers. Its Burrows-Wheeler
transform is kept as a wavelet matrix: per bit of the numbers a bit vector with counts per 64 places.
All segments are streamed through it from right to left at once. A segment keeps the interval of the
suffixes that begin with its current match; where none of them lies in a document with a smaller id,
the match is shortened to the enclosing interval. So at each word the statistic is the length of the
longest match that starts there and also starts in a document with a smaller id; windows that it
reaches are reported.

Of equal texts only the one with the smallest id is indexed; the others are covered throughout if
they have a window at all.

Defined results: null, empty and short texts lose nothing; texts of any length are used whole; rows
without an id neither lose nor cause anything; rows with the same id are one document (a window is
not removed for standing in another row of its id); other columns are kept by ``substring_dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import POWERS, WORD_VISIBLE, mix, slices, text_bytes, words
from .passages import Unit, distinct_segments, indexed, merged, shared_segments, with_ranges

WINDOW, GRAM = 50, 10
SHARD_BYTES = 2 << 20


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; ``text`` has values from 0."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    bits = max(1, int(n).bit_length())
    order, reach = np.arange(n), 1
    while True:
        second = np.zeros(n, dtype=np.int64)
        second[: n - reach] = rank[reach:] + 1
        if 3 * bits <= 63:
            packed = (rank << (2 * bits)) | (second << bits) | np.arange(n)
            packed.sort()
            order = packed & ((1 << bits) - 1)
        else:
            order = np.lexsort((second, rank))
        a, b = rank[order], second[order]
        new = np.concatenate(([0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        reach *= 2
        if new[-1] == n - 1 or reach >= n:
            return order


class BitVector:
    """Bits with counts per 64 places."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]

    def ones(self, at: np.ndarray) -> np.ndarray:
        """How many ones stand before each place."""
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << rest) - np.uint64(1)))


class FMIndex:
    """Backward search over a text whose suffix order is given."""

    def __init__(self, text: np.ndarray, order: np.ndarray) -> None:
        self.n = len(text)
        transform = text[order - 1]
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.levels, self.zeros = [], []
        self.bits = max(1, int(text.max()).bit_length())
        for bit in reversed(range(self.bits)):
            ones = (transform >> bit) & 1
            self.levels.append(BitVector(ones))
            self.zeros.append(int(len(ones) - ones.sum()))
            transform = np.concatenate((transform[ones == 0], transform[ones == 1]))

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        low = np.zeros(len(at), dtype=np.int64)
        for k, bit in enumerate(reversed(range(self.bits))):
            one = ((symbol >> bit) & 1).astype(bool)
            low_ones, at_ones = self.levels[k].ones(low), self.levels[k].ones(at)
            low = np.where(one, self.zeros[k] + low_ones, low - low_ones)
            at = np.where(one, self.zeros[k] + at_ones, at - at_ones)
        return at - low

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of symbol + match."""
        both = self._rank(np.concatenate((symbol, symbol)), np.concatenate((low, high)))
        start = self.starts[symbol]
        return start + both[: len(low)], start + both[len(low) :]


class Minima:
    """Smallest value of any range, by tables of powers of two."""

    def __init__(self, values: np.ndarray) -> None:
        self.tables = [values]
        width = 1
        while 2 * width <= len(values):
            self.tables.append(np.minimum(self.tables[-1][:-width], self.tables[-1][width:]))
            width *= 2

    def over(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.empty(len(low), dtype=self.tables[0].dtype)
        for k in np.unique(level):
            at = level == k
            found[at] = np.minimum(self.tables[k][low[at]], self.tables[k][high[at] - (1 << k)])
        return found

    def widen(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest interval around [low, high) inside which all neighbours share ``depth`` symbols."""
        low, high = low.copy(), high.copy()
        for k in reversed(range(len(self.tables))):
            step, table = 1 << k, self.tables[k]
            at = low - step + 1
            can = at > 0
            can[can] = table[at[can]] >= depth[can]
            low[can] -= step
            can = high + step <= len(self.tables[0])
            can[can] = table[high[can]] >= depth[can]
            high[can] += step
        return low, high


def common_prefixes(text: np.ndarray, order: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Symbols that neighbours in the suffix order share inside their segments (``room``: symbols to its end).

    Lengths are found by bisection; equal ranges are told by their fingerprints.
    """
    up, _ = POWERS.upto(len(text))
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(text.astype(np.uint64)) * up[: len(text)])))
    a, b = order[:-1], order[1:]
    low, high = np.zeros(len(a), dtype=np.int64), np.minimum(room[a], room[b])
    while (live := np.flatnonzero(low < high)).size:
        middle = (low[live] + high[live] + 1) // 2
        x, y = a[live], b[live]
        same = (sums[x + middle] - sums[x]) * up[y] == (sums[y + middle] - sums[y]) * up[x]
        low[live[same]], high[live[~same]] = middle[same], middle[~same] - 1
    return np.concatenate(([0], low)).astype(np.int32)


def matching_windows(window: int):
    """For ``passages.indexed``: windows of each segment that also start in a document with a smaller id."""

    def index(bodies: pa.Array, n: np.ndarray, owners: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        data, bounds = text_bytes(bodies)
        prints, _, _, rows = words(data, bounds, WORD_VISIBLE, lower=False)
        count = len(rows) - 1
        size = np.diff(rows)
        # each segment ends in a separator of its own while sorting; all are 0 in the index
        of = np.repeat(np.arange(count), size)
        place = np.arange(len(prints)) + of
        numbers = np.unique(prints, return_inverse=True)[1] + 1
        text = np.zeros(len(prints) + count, dtype=np.int64)
        text[place] = numbers
        ends = rows[1:] + np.arange(count)
        sortable = text + count
        sortable[ends] = np.arange(count)
        order = suffix_array(sortable)
        fm = FMIndex(text, order)
        level = np.unique(owners, return_inverse=True)[1]
        least = Minima(np.append(np.repeat(level, size + 1), 0)[order].astype(np.int32))
        room = np.repeat(ends, size + 1) - np.arange(len(text))
        prefixes = Minima(common_prefixes(text, order, room))
        own = level.copy()
        low, high = np.zeros(count, dtype=np.int64), np.full(count, len(text), dtype=np.int64)
        length = np.zeros(count, dtype=np.int64)
        reach = np.zeros(len(text), dtype=bool)
        for step in range(1, int(size.max()) + 1):
            live = np.flatnonzero(size >= step)
            at = ends[live] - step
            lo, hi = fm.extend(text[at], low[live], high[live])
            depth = length[live] + 1
            while True:
                bad = np.flatnonzero((least.over(lo, hi) >= own[live]) & (depth > 0))
                if not len(bad):
                    break
                edge = lambda x: np.where(x < len(text), prefixes.tables[0][np.minimum(x, len(text) - 1)], 0)
                shorter = np.maximum(edge(lo[bad]), edge(hi[bad])).astype(np.int64)
                shorter = np.minimum(shorter, depth[bad] - 1)
                root = shorter <= 0
                lo[bad], hi[bad] = prefixes.widen(lo[bad], hi[bad], np.maximum(shorter, 1))
                lo[bad[root]], hi[bad[root]] = 0, len(text)
                depth[bad] = np.maximum(shorter, 0)
            low[live], high[live], length[live] = lo, hi, depth
            reach[at] = depth >= window
        # runs of windows that belong to the segment's anchor
        begins = ends - size
        local = np.arange(len(text)) - np.repeat(begins, size + 1)
        segment = np.repeat(np.arange(count), size + 1)
        reach &= local < n[segment]
        edge_ = np.diff(np.concatenate(([0], (reach).astype(np.int8), [0])))
        first, last = np.flatnonzero(edge_ == 1), np.flatnonzero(edge_ == -1) - 1
        return segment[first], local[first], local[last]

    return index


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, text_key, from, to) in words; without ``from`` the whole text. ``docs``: doc_id, text_key, text."""
    unit = Unit("words", window, gram)
    docs = docs.filter("doc_id is not null and text is not null")
    cut = shared_segments(docs, unit, F.col("text_key"))
    key = ["anchor", "content", "n"]
    owned = cut.select("doc_id", "text_key", "start", *key).join(distinct_segments(cut).drop("copies"), key)
    later = owned.filter("doc_id > owner").select("doc_id", "text_key", F.col("start").alias("from"), (F.col("start") + F.col("n") + window - 1).alias("to"))
    found = indexed(cut, matching_windows(window), SHARD_BYTES)
    first = owned.filter("doc_id = owner").join(found, key)
    first = first.select("doc_id", "text_key", (F.col("start") + F.col("first")).alias("from"), (F.col("start") + F.col("last") + window).alias("to"))
    # equal texts
    named = docs.select("doc_id", "text_key", F.md5("text").alias("name"))
    groups = named.groupBy("name").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).filter("owner < last")
    copies = named.join(groups, "name").filter("doc_id > owner").select("doc_id", "text_key", F.lit(None).cast("long").alias("from"), F.lit(None).cast("long").alias("to")).distinct()
    return later.union(first).union(copies)


def _apply(window: int, report: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", 4 * SHARD_BYTES):
                names = batch.schema.names
                column = lambda c: batch.column(names.index(c))  # noqa: E731,B023
                texts = column("text")
                data, bounds = text_bytes(texts)
                _, starts, ends, rows = words(data, bounds, WORD_VISIBLE, lower=False)
                n_words, n_removed, digests, kept_texts = np.diff(rows), [], [], []
                for k, (ranges_, all_) in enumerate(zip(column("ranges").to_pylist(), column("whole").to_pylist())):
                    a, n = int(rows[k]), int(n_words[k])
                    ranges_ = [(0, n)] if all_ and n >= window else merged([r["from"] for r in ranges_ or ()], [r["to"] for r in ranges_ or ()])
                    n_removed.append(sum(y - x for x, y in ranges_))
                    if not ranges_ and not report:
                        kept_texts.append(texts[k])
                        continue
                    kept, at = [], 0
                    for x, y in [*ranges_, (n, n)]:
                        kept += [data[starts[w] : ends[w]].tobytes() for w in range(a + at, a + x)]
                        at = y
                    body = b" ".join(kept)
                    kept_texts.append(pa.scalar(body.decode(), texts.type) if not report else None)
                    digests.append(hashlib.sha256(body).hexdigest())
                if report:
                    yield pa.RecordBatch.from_arrays([column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])
                else:
                    yield pa.RecordBatch.from_arrays([column("row"), pa.array([x.as_py() for x in kept_texts], pa.string())], names=["row", "kept_text"])

    return run


def _keyed(docs: DataFrame, *more) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text", *more)


def substring_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: words, words removed, digest of the rest."""
    keyed = _keyed(docs)
    ready = with_ranges(keyed, repeated_ranges(keyed, window)).select("doc_id", "text", "ranges", "whole")
    return ready.mapInArrow(_apply(window, True), "doc_id long, n_words long, n_removed long, kept_sha256 string")


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without words of repeated passages, in all their columns; a text that loses words is joined by single spaces."""
    keyed = _keyed(docs)
    inner = _keyed(docs, F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    ready = with_ranges(inner, repeated_ranges(keyed, window)).select("row", "text", "ranges", "whole")
    done = ready.mapInArrow(_apply(window, False), ready.select("row", F.col("text").alias("kept_text")).schema)
    return done.select(*[F.col("kept_text").alias("text") if c == "text" else F.col(f"row.{c}").alias(c) for c in docs.columns])
