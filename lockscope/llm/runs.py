"""Periodic runs: stretches of words that repeat with a period, found by descending-LCP Kruskal.

A run with period q is a longest stretch in which words q apart are equal; q is its smallest period and
it has ``LEAST_PERIODS`` periods and ``LEAST_WORDS`` words at least.

For the texts of a batch the suffixes (never across documents) are sorted by prefix doubling, and
neighbours in that order are edges weighted by their longest common prefix (LCP). The edges are taken by
decreasing LCP, as in Kruskal's algorithm. Each class of a union-find keeps its positions in order; the
smaller class is put into the larger, and positions that become neighbours at a distance d with an LCP of
at least (``LEAST_PERIODS`` - 1) * d seed a run of period d: the text from the first to the end of the
second's common prefix. A position between two neighbours would share their LCP, so d is the smallest
period; seeds with the same period and end are parts of one run, which the leftmost gives.

Only regions that can hold a run are sorted. A run's words, but for the last period, start groups of
``GRAM`` words that stand again at most one period later. So a region is a stretch of such positions that
is long enough for the smallest distance in it, with the words that its last period can take.

Defined results: a null, empty or blank text has no words and no runs; texts of any length are used
whole; repeated rows each get their rows; a null id is kept, and plants nothing in ``run_report``;
``collapse_runs`` keeps all columns, whatever their names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WORD_VISIBLE, coded_words, grams, mix, ranges, slices, text_bytes

LEAST_PERIODS, LEAST_WORDS = 4, 6
#: Words whose second occurrence marks a place. At most LEAST_WORDS - 1.
GRAM = 5
SLICE_BYTES = 1 << 20


def regions(codes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts, each in one document, that hold all runs."""
    n, turns = len(codes), LEAST_PERIODS - 1
    none = np.empty(0, dtype=np.int64)
    keys = grams(mix(codes.astype(np.uint64) + np.uint64(1)), GRAM)
    document = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    at = np.flatnonzero(document[: len(keys)] == document[GRAM - 1 :]) if len(keys) else none
    # equal keys of different groups only make a region longer
    keys = keys[at] + mix(document[at].astype(np.uint64) + np.uint64(n + 1))
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    gap = np.zeros(n + 1, dtype=np.int64)
    gap[at[order[:-1][same]]] = at[order[1:][same]] - at[order[:-1][same]]
    marked = np.flatnonzero(gap)
    if not len(marked):
        return none, none
    new = np.concatenate(([True], (np.diff(marked) > 1) | (document[marked[1:]] != document[marked[:-1]])))
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(marked)))
    least = np.minimum.reduceat(gap[marked], first)
    use = turns * least <= length + GRAM - 1
    start, length = marked[first[use]], length[use]
    end = start + length + GRAM - 1 + (length + GRAM - 1) // turns
    end = np.minimum(end, rows[document[start] + 1])
    if not len(start):
        return none, none
    reach = np.maximum.accumulate(end)
    apart = np.concatenate(([True], start[1:] >= reach[:-1]))
    return start[apart], reach[np.append(np.flatnonzero(apart)[1:] - 1, len(start) - 1)]


def sorted_suffixes(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and the LCP of each suffix with the next in order. The last symbol must be unique."""
    n = len(text)
    _, rank = np.unique(text, return_inverse=True)
    levels = [np.append(rank, -1).astype(np.int32)]
    width, bits = 1, n.bit_length() + 1
    order = np.argsort(rank, kind="stable")
    while int(levels[-1].max()) < n - 1:
        rank = levels[-1].astype(np.int64)
        after = np.full(n, -1, dtype=np.int64)
        after[: n - width] = rank[width:n]
        key = (rank[:n] << bits) | (after + 1)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n + 1, dtype=np.int32)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        new[n] = -1
        levels.append(new)
        width *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        equal = levels[k][a] == levels[k][b]
        step = equal.astype(np.int64) << k
        common += step
        a = np.minimum(a + step, n)
        b = np.minimum(b + step, n)
    return order, common


def kruskal_seeds(order: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, period, end) of the seeds of runs, from the suffix array and its LCPs."""
    turns = LEAST_PERIODS - 1
    use = np.flatnonzero(common >= GRAM)
    use = use[np.argsort(-common[use], kind="stable")]
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds: list[tuple[int, int, int]] = []

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for x, y, lcp in zip(order[use].tolist(), order[use + 1].tolist(), common[use].tolist()):
        x, y = find(x), find(y)
        large, small = members.get(x) or [x], members.get(y) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        parent[y] = x
        for p in small:
            large.insert(bisect_left(large, p), p)
        members[x] = large
        members.pop(y, None)
        last, moved = len(large) - 1, set(small)
        for p in small:  # neighbours that were in the other class are new
            k = bisect_left(large, p)
            if k and (o := large[k - 1]) not in moved and turns * (p - o) <= lcp and p - o + lcp >= LEAST_WORDS:
                seeds.append((o, p - o, p + lcp))
            if k < last and (o := large[k + 1]) not in moved and turns * (o - p) <= lcp and o - p + lcp >= LEAST_WORDS:
                seeds.append((p, o - p, o + lcp))
    found = np.array(seeds, dtype=np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def document_runs(codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(document, start, length, period) of all runs, by document, start and period. ``rows``: first word of each document."""
    start, end = regions(codes, rows)
    if not len(start):
        return np.empty((0, 4), dtype=np.int64)
    size = end - start
    begin = np.cumsum(size + 1) - (size + 1)  # in the joined regions, each ended by a separator
    text = np.empty(int(size.sum()) + len(size), dtype=np.int64)
    text[ranges(begin, size)] = codes[ranges(start, size)]
    text[begin + size] = codes.max() + 1 + np.arange(len(size))
    at, period, stop = kruskal_seeds(*sorted_suffixes(text))
    by = np.lexsort((at, stop, period))
    at, period, stop = at[by], period[by], stop[by]
    first = np.ones(len(at), dtype=bool)
    first[1:] = (period[1:] != period[:-1]) | (stop[1:] != stop[:-1])
    at, period, stop = at[first], period[first], stop[first]
    region = np.searchsorted(begin, at, side="right") - 1
    place = start[region] + at - begin[region]
    document = np.searchsorted(rows, place, side="right") - 1
    found = np.column_stack((document, place - rows[document], stop - at, period))
    return found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))]


def planted_words(doc_id: int | None, n: int) -> np.ndarray | None:
    """Which original word stands at each place after a period was planted; none for most ids."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    place = np.arange(n)
    place[a:] = a + (place[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return place


def _batch_runs(batch: pa.RecordBatch, planted: bool):
    """Ids, each document's words by number, their source places if a period was planted, and the runs."""
    ids = batch.column(batch.schema.get_field_index("doc_id")).to_pylist()
    data, bounds = text_bytes(batch.column(batch.schema.get_field_index("text")))
    codes, _, _, rows = coded_words(data, bounds, WORD_VISIBLE)
    moved: dict[int, np.ndarray] = {}
    if planted:
        codes = codes.copy()
        for k, i in enumerate(ids):
            if (place := planted_words(i, int(rows[k + 1] - rows[k]))) is not None:
                codes[rows[k] : rows[k + 1]] = codes[rows[k] + place]
                moved[k] = place
    return ids, data, bounds, rows, moved, document_runs(codes, rows)


def _kept(body: bytes, place: np.ndarray | None, runs: np.ndarray) -> bytes:
    """The words that stay, joined by one space: each run keeps its first period."""
    found = body.split()
    if place is not None:
        found = [found[k] for k in place.tolist()]
    if len(runs):
        drop = np.zeros(len(found) + 1, dtype=np.int64)
        np.add.at(drop, runs[:, 1] + runs[:, 3], 1)
        np.add.at(drop, runs[:, 1] + runs[:, 2], -1)
        found = [found[k] for k in np.flatnonzero(np.cumsum(drop)[:-1] == 0).tolist()]
    return b" ".join(found)


def _best(runs: np.ndarray) -> tuple[int, int, int] | tuple[None, None, None]:
    best = None
    for _, start, length, period in runs.tolist():
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    return best or (None, None, None)


def _report(planted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                ids, data, bounds, rows, moved, found = _batch_runs(batch, planted)
                cut = np.searchsorted(found[:, 0], np.arange(len(ids) + 1))
                out = []
                for k, i in enumerate(ids):
                    own = found[cut[k] : cut[k + 1]]
                    start, length, period = _best(own)
                    listed = "".join(f"{s},{n},{q}\n" for _, s, n, q in own.tolist())
                    left = _kept(data[bounds[k] : bounds[k + 1]].tobytes(), moved.get(k), own)
                    milli = None if period is None else 1000 * length // period
                    out.append((i, int(rows[k + 1] - rows[k]), len(own), start, length, period, milli, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left).hexdigest()))
                types = [pa.int64()] * 7 + [pa.string()] * 2
                names = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)

    return run


def _list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            *_, found = _batch_runs(batch, False)
            ids = batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(found[:, 0]))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(found[:, k]) for k in (1, 2, 3))], names=["doc_id", "start", "length", "period"])


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            _, data, bounds, _, _, found = _batch_runs(batch, False)
            cut = np.searchsorted(found[:, 0], np.arange(batch.num_rows + 1))
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            for k in np.flatnonzero(np.diff(cut)).tolist():
                texts[k] = _kept(data[bounds[k] : bounds[k + 1]].tobytes(), None, found[cut[k] : cut[k + 1]]).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def _keyed(docs: DataFrame, id_) -> DataFrame:
    return docs.select(id_.alias("doc_id"), docs["text"].cast("string").alias("text"))


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, start, length, period) of every run, in numbers of words."""
    return _keyed(docs, docs["doc_id"].cast("long")).mapInArrow(_list, "doc_id long, start long, length long, period long")


def collapse_runs(docs: DataFrame) -> DataFrame:
    """The documents with one period of each run; texts without a run stay as they are."""
    inner = _keyed(docs, F.struct(*[docs[c] for c in docs.columns]))
    done = inner.mapInArrow(_collapse, inner.schema)
    return done.select(*[F.col("text") if c == "text" else F.col(f"doc_id.`{c}`").alias(c) for c in docs.columns])


def run_report(docs: DataFrame, planted: bool = False) -> DataFrame:
    """One row per document: its runs, the one with most periods, digests of all runs and of the collapsed text.

    ``planted``: every tenth id, by checksum, is read with a period planted into its words.
    """
    schema = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    return _keyed(docs, docs["doc_id"].cast("long")).mapInArrow(_report(planted), schema)
