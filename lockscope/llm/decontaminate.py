"""Benchmark decontamination: suffix arrays over document shards, searched for every test suffix.

A task cuts its documents into shards, sorts the word suffixes of a shard that can match (those that
begin with a word of the test set) and finds every test suffix by binary search. Hits on one diagonal
are joined into the longest verbatim matches. Documents are never shuffled.

Defined results: null or empty text has no words and no match; a document or item may be of any
length; repeated document rows each get a row; an item without id or words is no test item; repeated
items count once; other columns are kept by ``decontaminate`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WORD_LETTERS, ranges, slices, stored, text_bytes, words

#: Test items travel to the tasks in blocks of about this many bytes; each block is one pass.
ITEM_BLOCK = 8 << 20
SHARD_BYTES = 4 << 20
SHARD_WORDS = 1 << 20

_MATCH = "array<struct<item_id:string,item_start:int,doc_start:int,n_words:int>>"
_ADDED = ("matches", "n_words", "n_hit")


class TestSuffixes:
    """The distinct windows of some test items, as numbers of their vocabulary."""

    def __init__(self, rows: list[tuple[str, str]], window: int) -> None:
        rows = sorted({(str(k), t) for k, t in rows})
        self.items = [k for k, _ in rows]
        data, bounds = text_bytes(pa.array([t for _, t in rows], pa.string()))
        prints, _, _, first = words(data, bounds, WORD_LETTERS, lower=True)
        self.vocabulary, numbers = np.unique(prints, return_inverse=True)
        numbers = numbers + 1
        starts, lengths, items, offsets = [], [], [], []
        for item, (a, b) in enumerate(zip(first[:-1], first[1:])):
            if b > a:
                size = min(window, b - a)
                at = np.arange(a, b - size + 1)
                starts.append(at)
                lengths.append(np.full(len(at), size))
                items.append(np.full(len(at), item))
                offsets.append(at - a)
        join = lambda parts: np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
        starts, lengths, self.item, self.offset = join(starts), join(lengths), join(items), join(offsets)
        table = np.full((len(starts), window), -1, dtype=np.int64)
        for d in range(window):
            some = lengths > d
            table[some, d] = numbers[starts[some] + d]
        # one search for each distinct window; its uses are the places where the items have it
        self.windows, use = np.unique(table, axis=0, return_inverse=True) if len(table) else (table, starts)
        use = use.reshape(-1)
        self.order = np.argsort(use, kind="stable")
        self.uses = np.searchsorted(use[self.order], np.arange(len(self.windows) + 1))
        self.length = (self.windows >= 0).sum(axis=1)
        self.seen = np.zeros(1 << 22, dtype=bool)
        self.seen[(self.vocabulary >> np.uint64(42)).astype(np.int64)] = True

    def number(self, prints: np.ndarray) -> np.ndarray:
        """Vocabulary number of each word; 0 for words that no item has."""
        found = np.zeros(len(prints), dtype=np.int64)
        some = np.flatnonzero(self.seen[(prints >> np.uint64(42)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, prints[some]), len(self.vocabulary) - 1)
        same = self.vocabulary[at] == prints[some]
        found[some[same]] = at[same] + 1
        return found


def suffix_array(numbers: np.ndarray, depth: int) -> np.ndarray:
    """Positions with a number over 0, by their first ``depth`` numbers (prefix doubling)."""
    at = np.flatnonzero(numbers)
    rank = np.concatenate((numbers, np.zeros(depth, dtype=np.int64)))
    if len(at) and numbers.max() >> 20:  # ranks have 20 bits: a shard has fewer words than that
        rank[at] = np.unique(numbers[at], return_inverse=True)[1] + 1
    index = np.arange(len(at), dtype=np.int64)
    order, reach = index, 1
    while reach < depth and len(at):
        packed = (rank[at] << 40) | (rank[at + reach] << 20) | index
        packed.sort()
        order = packed & ((1 << 20) - 1)
        pair = packed >> 20
        rank[at[order]] = 1 + np.concatenate(([0], np.cumsum(pair[1:] != pair[:-1])))
        reach *= 2
    return at[order]


def _bound(text: np.ndarray, suffixes: np.ndarray, tests: TestSuffixes, after: bool) -> np.ndarray:
    """By binary search: how many suffixes come before each window (``after``: or begin with it)."""
    low = np.zeros(len(tests.windows), dtype=np.int64)
    high = np.full(len(tests.windows), len(suffixes), dtype=np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        goes_left = np.full(len(open_), not after)
        same, at = np.arange(len(open_)), suffixes[middle]
        for d in range(tests.windows.shape[1]):
            ours, theirs = tests.windows[open_[same], d], text[at[same] + d]
            less, more = (theirs < ours) & (ours >= 0), (theirs > ours) & (ours >= 0)
            goes_left[same[less]], goes_left[same[more]] = False, True
            same = same[(theirs == ours)]
            if not len(same):
                break
        high[open_[goes_left]] = middle[goes_left]
        low[open_[~goes_left]] = middle[~goes_left] + 1
    return low


def shard_hits(numbers: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Positions in a shard and the test windows that start there."""
    window = tests.windows.shape[1]
    places, found = [], []
    for at in range(0, len(numbers), SHARD_WORDS - 2 * window):
        piece = numbers[at : at + SHARD_WORDS - window]
        own = len(piece) if at + len(piece) == len(numbers) else SHARD_WORDS - 2 * window
        suffixes = suffix_array(piece, 16 if window <= 16 else 1 << (window - 1).bit_length())
        suffixes = suffixes[suffixes < own]
        text = np.concatenate((piece, np.zeros(window, dtype=np.int64)))
        low, high = _bound(text, suffixes, tests, False), _bound(text, suffixes, tests, True)
        places.append(at + suffixes[ranges(low, high - low)])
        found.append(np.repeat(np.arange(len(low)), high - low))
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(found)


def longest_matches(places, found, tests: TestSuffixes):
    """Hits on one diagonal of an item, joined: (item, its word, position, words)."""
    counts = (tests.uses[1:] - tests.uses[:-1])[found]
    uses = tests.order[ranges(tests.uses[:-1][found], counts)]
    place, size = np.repeat(places, counts), np.repeat(tests.length[found], counts)
    item, offset = tests.item[uses], tests.offset[uses]
    order = np.lexsort((place, place - offset, item))
    item, offset, place, size = item[order], offset[order], place[order], size[order]
    new = np.ones(len(item), dtype=bool)
    new[1:] = (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(item)) - 1 if len(first) else first
    return item[first], offset[first], place[first], place[last] - place[first] + size[last] if len(first) else place


def _covered(spans: list[tuple[int, int]]) -> int:
    total, reach = 0, 0
    for start, end in sorted(spans):
        total += max(0, end - max(start, reach))
        reach = max(reach, end)
    return total


def _one_pass(tests: TestSuffixes, text: str, keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text, SHARD_BYTES):
                data, bounds = text_bytes(batch.column(batch.schema.get_field_index(text)))
                prints, _, _, rows = words(data, bounds, WORD_LETTERS, lower=True)
                # a zero after each document keeps matches inside it
                n = batch.num_rows
                of = np.repeat(np.arange(n), np.diff(rows))
                numbers = np.zeros(len(prints) + n, dtype=np.int64)
                numbers[np.arange(len(prints)) + of] = tests.number(prints)
                begins = rows[:-1] + np.arange(n)
                item, offset, place, size = longest_matches(*shard_hits(numbers, tests), tests)
                old = batch.column("matches").to_pylist()
                matches = [list(x or ()) for x in old]
                row = np.searchsorted(begins, place, side="right") - 1
                for r, i, o, p, s in zip(row.tolist(), item.tolist(), offset.tolist(), (place - begins[row]).tolist(), size.tolist()):
                    matches[r].append({"item_id": tests.items[i], "item_start": o, "doc_start": p, "n_words": s})
                for found in matches:
                    found.sort(key=lambda m: (m["doc_start"], m["item_id"], m["item_start"]))
                done = {
                    "matches": pa.array(matches, old_type) if (old_type := batch.schema.field("matches").type) else None,
                    "n_words": pa.array(np.diff(rows), pa.int64()),
                    "n_hit": pa.array([_covered([(m["doc_start"], m["doc_start"] + m["n_words"]) for m in x]) for x in matches], pa.int64()),
                }
                names = [c for c in batch.schema.names if keep_text or c != text]
                yield pa.RecordBatch.from_arrays([done.get(c, batch.column(batch.schema.get_field_index(c))) for c in names], names=names)

    return run


def item_blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """The test items in blocks of about ``block_bytes``, each small enough for the driver and the tasks."""
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = items.filter("item_id is not null and text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) if n > 1 else items
        yield [tuple(r) for r in part.collect()]


def find_matches(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", keep_text: bool = True, block_bytes: int = ITEM_BLOCK) -> DataFrame:
    """``docs`` with ``matches`` (longest verbatim matches and places), ``n_words`` and ``n_hit``.

    A match has at least ``window`` words, or a whole item that is shorter. Existing columns of these
    three names are replaced.
    """
    plain = [c for c in docs.columns if c not in _ADDED]
    start = {"matches": F.lit(None).cast(_MATCH), "n_words": F.lit(0).cast("long"), "n_hit": F.lit(0).cast("long")}
    blocks = item_blocks(items, block_bytes)
    first, second = next(blocks, []), next(blocks, None)
    if second is None:
        df = docs.withColumns(start)
        out = df if keep_text else df.drop(text)
        return df.mapInArrow(_one_pass(TestSuffixes(first, window), text, keep_text), out.schema)
    # one block at a time: what a pass finds is written under the number of the row, then the block is let go
    rows = stored(docs.select(*plain).withColumn("_at", F.monotonically_increasing_id()), "documents")
    kept = rows.select("_at", text).withColumns(start)
    found = None
    for block in chain([first, second], blocks):
        part = kept.mapInArrow(_one_pass(TestSuffixes(block, window), text, False), kept.drop(text).schema)
        part = stored(part.filter("n_hit > 0").select("_at", "matches"), "matches")
        found = part if found is None else found.union(part)
    joined = found.groupBy("_at").agg(F.flatten(F.collect_list("matches")).alias("matches"))
    df = rows.join(joined, "_at", "left")
    out = df.select(*plain, F.col("matches").cast(_MATCH).alias("matches"), start["n_words"].alias("n_words"), start["n_hit"].alias("n_hit"))
    # an empty test set adds no match, puts them in order, and counts the words and the words hit
    last = out if keep_text else out.drop(text)
    return out.mapInArrow(_one_pass(TestSuffixes([], window), text, keep_text), last.schema)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """The documents without any match, in all their columns."""
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    found = find_matches(inner, items, window, keep_text=False)
    return found.filter("n_hit = 0").select("row.*")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10) -> DataFrame:
    """One row per document: words, words hit, the items that hit it."""
    found = find_matches(docs.select("doc_id", "text"), items, window, keep_text=False)
    ids = F.array_sort(F.array_distinct(F.coalesce(F.transform("matches", lambda m: m["item_id"]), F.array().cast("array<string>"))))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["n_words"])), F.lit(0)).cast("long").alias("longest_match"),
    )
