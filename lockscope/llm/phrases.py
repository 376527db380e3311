"""Collocations: phrases that stand together more often than their parts, counted by double-array tries.

A text's pieces (between punctuation and line ends) are split into words; phrases of 2 to ``LONGEST``
words are counted for each language in which they stand ``least`` times.

1. Candidates. Every pair's 58-bit key is counted; the sums of all tasks meet in buckets of keys, as
   runs, not as rows. Keys that reach ``least`` set a bit in a bitmap of ``BITS`` bits, which bounds what
   is sent to the tasks; two phrases with one key or one bit only let more candidates through. Longer phrases are keyed and counted where all their pairs
   pass (Apriori), and the phrases whose own keys reach ``least`` are listed with their words: texts are
   in 64 classes, and a phrase is listed from texts of one class in which it was seen.
2. Counting. Candidates and their single words are dealt into blocks of about ``BLOCK`` phrases by
   their first words. Each block is a double-array trie: a word is three steps of one byte of its
   number. Tries of about ``AT_ONCE`` phrases are broadcast together and held against all texts in one
   pass; a place goes to the trie of its word only. The states of all places advance together, level by
   level, in numpy; accepting states are added by ``bincount``, and the sums of all shards are added by
   Spark. These are the counts that are used: what collisions let through falls out here.
3. Scores. For each cut of a phrase into two parts, floor(2 * ``SCALE`` * a / (l + r)) with the counts
   a of the phrase and l, r of its parts, in decimals of 38 digits; the lowest cut counts. A phrase
   inside a longer one that stands nearly as often is dropped.

Defined results: null, empty and blank texts have no words; a null language is ``und``; a language whose
texts have no phrase gives no row; texts of any length are used whole; repeated rows count each time;
ids and other columns are not read; an empty table gives an empty table; equal scores and counts are
ordered by the bytes of the phrase.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_set, coded_words, mix, signed, slices, stored, text_bytes, words
from .graph import run_bodies

LONGEST, LEAST, TOP = 4, 30, 2000
SCALE = 1_000_000
#: A phrase goes if this share, in hundredths, of its occurrences lies in one longer phrase.
INSIDE = 80
UNKNOWN = "und"
#: Size of the bitmap of keys that may be frequent: 16 MB.
BITS = 1 << 27
#: Phrases in a trie: at most three nodes for each of their words, of 12 bytes.
BLOCK = 1 << 20
#: Phrases whose tries a task holds at once, about 60 bytes each; more phrases are more passes over the texts.
AT_ONCE = 1 << 22
#: Keys that a task holds before it hands on their counts.
HELD = 1 << 21
#: Buckets of keys, at least; a task sums up one at a time.
BUCKETS = 1 << 12
SLICE_BYTES = 1 << 21

_BREAKS = ascii_set((0x0A, 0x0D)) | np.isin(np.arange(256), list(b".,;:!?"))
_LETTERS = ~(_BREAKS | ascii_set((0x09, 0x09), (0x20, 0x20)))
_ANY = np.ones(256, dtype=bool)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] = np.arange(0x61, 0x7B)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_SIX, _CLASS = np.uint64(6), np.uint64(63)


class Words:
    """The words of a batch: codes, distinct words, languages and pieces."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        data, bounds = text_bytes(batch.column(batch.schema.get_field_index("text")))
        data = _LOWER[data]
        self.codes, self.distinct, starts, rows = coded_words(data, bounds, _LETTERS)
        row = np.repeat(np.arange(batch.num_rows), np.diff(rows))
        # never falls, and grows where a piece or a row ends
        self.piece = np.cumsum(_BREAKS[data])[starts] + row
        langs = pc.dictionary_encode(batch.column(batch.schema.get_field_index("lang")).fill_null(UNKNOWN))
        self.langs, self.lang = langs.dictionary, langs.indices.to_numpy()[row]
        self.rows = rows

    def together(self, at: np.ndarray, size: int) -> np.ndarray:
        """Which of the places start ``size`` words of one piece."""
        last = at + size - 1
        return (last < len(self.piece)) & (self.piece[np.minimum(last, len(self.piece) - 1)] == self.piece[at])

    def keys(self, longest: int, hot: np.ndarray | None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, places, keys) of the phrases, those over two words only where ``hot`` has all their pairs."""
        if not len(self.codes):
            return
        prints = words(*text_bytes(self.distinct), _ANY, lower=False)[0][self.codes]
        langs = words(*text_bytes(pc.binary_join_element_wise("l", self.langs.cast(pa.string()), "")), _ANY, lower=False)[0][self.lang]
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(prints)))
        self.kind = np.repeat(mix(sums[self.rows[1:]] - sums[self.rows[:-1]]) & _CLASS, np.diff(self.rows))
        at = np.arange(len(prints))
        at = at[self.together(at, 2)]
        key = mix(mix(mix(langs[at]) * _STEP + prints[at]) * _STEP + prints[at + 1])
        yield 2, at, key >> _SIX
        if longest == 2:
            return
        pair = np.zeros(len(prints) + LONGEST, dtype=bool)
        pair[at] = has_bits(hot, key >> _SIX)
        key, at = key[pair[at]], at[pair[at]]
        for size in range(3, longest + 1):
            use = self.together(at, size) & pair[at + size - 2]
            at = at[use]
            key = mix(key[use] * _STEP + prints[at + size - 1])
            yield size, at, key >> _SIX

    def text(self, at: np.ndarray, size: int) -> pa.Array:
        """The phrases at the given places, as words joined by spaces."""
        parts = [self.distinct.take(pa.array(self.codes[at + k])).cast(pa.large_string()) for k in range(size)]
        return pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))


def has_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    word = bits[((keys >> np.uint64(6)) & np.uint64(len(bits) - 1)).astype(np.int64)]
    return ((word >> (keys & np.uint64(63))) & np.uint64(1)) == 1


class Counts:
    """Sums by key, and the smallest class each was seen in, held up to a number of keys."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, kind: np.ndarray) -> bool:
        """Whether the sums should be handed on."""
        packed = np.sort((keys << _SIX) | kind)
        first = _first(packed)
        self.parts.append((packed[first], np.diff(np.append(first, len(packed)))))
        self.size += len(first)
        if self.size <= HELD:
            return False
        self.parts = [self.sums()]
        self.size = len(self.parts[0][0])
        return self.size > HELD // 2

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        return _summed(*(np.concatenate(x) for x in zip(*self.parts)))

    def drain(self, buckets: int) -> pa.RecordBatch:
        """The sums, one row for each bucket of keys."""
        packed, n = self.sums()
        self.parts, self.size = [], 0
        bucket = ((packed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        used, at = np.unique(bucket, return_index=True)
        bounds = np.append(at, len(packed))
        return pa.RecordBatch.from_arrays([pa.array(used), run_bodies(packed, bounds), run_bodies(n, bounds)], names=["bucket", "keys", "sums"])


def _summed(packed: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, with its smallest class and its sum."""
    order = np.argsort(packed)
    packed, n = packed[order], n[order]
    first = _first(packed)
    return packed[first], np.add.reduceat(n, first) if len(first) else n


def _first(packed: np.ndarray) -> np.ndarray:
    """Where each key starts in sorted keys with classes."""
    keys = packed >> _SIX
    return np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), dtype=bool), keys[1:] != keys[:-1])))


def _count_keys(sizes: range, hot: np.ndarray | None, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts()
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                text = Words(batch)
                for size, at, keys in text.keys(sizes[-1], hot):
                    if size in sizes and counts.add(keys, text.kind[at]):
                        yield counts.drain(buckets)
        yield counts.drain(buckets)

    return run


def _frequent(least: int):
    """Rows sorted by bucket as a stream: the keys that reach ``least`` in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        last, size = None, 0

        def done() -> pa.RecordBatch:
            packed, n = _summed(*map(np.concatenate, zip(*held)))
            packed = packed[n >= least]
            return pa.RecordBatch.from_arrays([pa.array(signed(packed >> _SIX)), pa.array(signed(packed & _CLASS))], names=["key", "kind"])

        for batch in batches:
            keys, sums = batch.column(1), batch.column(2)
            for k, bucket in enumerate(batch.column(0).to_pylist()):
                if held and bucket != last:
                    yield done()
                    held, size = [], 0
                held.append((np.frombuffer(keys[k].as_buffer(), dtype=np.uint64), np.frombuffer(sums[k].as_buffer(), dtype=np.int64)))
                last, size = bucket, size + len(held[-1][0])
                if size > 2 * HELD:
                    held = [_summed(*map(np.concatenate, zip(*held)))]
                    size = 0  # until as many more have come
        if held:
            yield done()

    return run


def _list_phrases(pairs: np.ndarray, seen: np.ndarray):
    """(lang, phrase, key) of the phrases that a text's class has to list, mostly once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[int] = set()
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                text = Words(batch)
                for size, at, keys in text.keys(LONGEST, pairs):
                    use = np.flatnonzero(has_bits(seen, (keys << _SIX) | text.kind[at]))
                    keys, first = np.unique(keys[use], return_index=True)
                    new = [k for k, key in enumerate(keys.tolist()) if key not in told]
                    keys, at = keys[new], at[use[first[new]]]
                    yield pa.RecordBatch.from_arrays([text.langs.take(pa.array(text.lang[at])).cast(pa.string()), text.text(at, size).cast(pa.string()), pa.array(signed(keys))], names=["lang", "phrase", "key"])
                    if len(told) > HELD // 4:
                        told.clear()
                    told.update(keys.tolist())

    return run


def frequent_keys(docs: DataFrame, sizes: range, hot: np.ndarray | None, least: int) -> DataFrame:
    """(key, kind): keys that may stand ``least`` times, with a class of texts that has each."""
    buckets = max(BUCKETS, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    counts = docs.mapInArrow(_count_keys(sizes, hot, buckets), "bucket int, keys binary, sums binary")
    return stored(counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_frequent(least), "key long, kind long"), "phrase-keys")


def bitmap(numbers: DataFrame) -> np.ndarray:
    """The numbers in column ``number`` as bits: at most BITS / 64 rows come to the driver."""
    word = F.shiftrightunsigned("number", 6).bitwiseAND(F.lit(BITS // 64 - 1))
    bit = F.expr("shiftleft(1L, cast(number & 63 as int))")
    found = numbers.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bits = np.zeros(BITS // 64, dtype=np.int64)
    bits[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bits.view(np.uint64)


def candidates(docs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase): all phrases that may stand ``least`` times, and their words."""
    pairs = frequent_keys(docs, range(2, 3), None, least)
    hot_pairs = bitmap(pairs.select(F.col("key").alias("number")))
    hot = pairs.union(frequent_keys(docs, range(3, LONGEST + 1), hot_pairs, least))
    seen = bitmap(hot.select(F.shiftleft("key", 6).bitwiseOR(F.col("kind")).alias("number")))
    listed = docs.mapInArrow(_list_phrases(hot_pairs, seen), "lang string, phrase string, key long")
    listed = stored(listed.distinct().join(hot, "key", "left_semi").select("lang", "phrase"), "phrases")
    single = listed.select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct()
    return stored(listed.union(single), "candidates")


class Trie:
    """A double array: from state s, byte c leads to t = base[s] + c if check[t] == s.

    ``words``: all words of the phrases, and maybe others; their places number them.
    """

    def __init__(self, langs: pa.Array, phrases: pa.Array, words: pa.Array | None = None) -> None:
        self.langs, self.phrases = langs, phrases
        self.roots = pc.unique(langs)
        split = pc.split_pattern(phrases, " ")
        self.words = pc.unique(split.flatten()) if words is None else words
        number = pc.index_in(split.flatten(), self.words).to_numpy().astype(np.int64)
        sizes = pc.list_value_length(split).to_numpy().astype(np.int64)
        begin = np.cumsum(sizes) - sizes
        node = pc.index_in(langs, self.roots).to_numpy().astype(np.int64)
        count, parents, symbols = len(self.roots), [], []
        for depth in range(3 * int(sizes.max())):
            live = np.flatnonzero(sizes > depth // 3)
            symbol = (number[begin[live] + depth // 3] >> (16 - 8 * (depth % 3))) & 255
            edges, child = np.unique((node[live] << 8) | symbol, return_inverse=True)
            parents.append(edges >> 8)
            symbols.append(edges & 255)
            node[live] = count + child
            count += len(edges)
        self._place(count, np.concatenate(parents), np.concatenate(symbols))
        self.accept = np.full(len(self.check), -1, dtype=np.int32)
        self.accept[self.cell[node]] = np.arange(len(phrases))
        self.roots_at = self.cell[: len(self.roots)]
        del self.cell

    def _place(self, count: int, parent: np.ndarray, symbol: np.ndarray) -> None:
        """Cells for all nodes: wide families first, each at the next place that has its cells free; only children fill the gaps."""
        roots = len(self.roots)
        by = np.lexsort((symbol, parent))
        family, first, size = np.unique(parent[by], return_index=True, return_counts=True)
        used = np.zeros(roots + 4 * count + 1024, dtype=bool)
        used[:roots] = True
        base = np.zeros(count, dtype=np.int64)
        at, sorted_ = roots, symbol[by]
        many = np.flatnonzero(size > 1)
        for k in many[np.argsort(-size[many], kind="stable")].tolist():
            own = sorted_[first[k] : first[k] + size[k]]
            while True:
                tried = at + np.flatnonzero(~used[at : at + 512])
                free = tried[~used[tried[:, None] + (own - own[0])].any(axis=1)] if len(tried) else tried
                if len(free):
                    break
                at += 512
                if at + 1024 > len(used):
                    used = np.concatenate((used, np.zeros(len(used), dtype=bool)))
            base[family[k]] = free[0] - own[0]
            used[base[family[k]] + own] = True
        alone = np.flatnonzero(size == 1)
        free = np.flatnonzero(~used[roots:])[: len(alone)] + roots
        if len(free) < len(alone):
            free = np.concatenate((free, len(used) + np.arange(len(alone) - len(free))))
        base[family[alone]] = free - sorted_[first[alone]]
        self.cell = np.zeros(count, dtype=np.int64)
        self.cell[:roots] = np.arange(roots)
        child = roots + np.arange(len(parent))
        self.cell[child] = base[parent] + symbol
        end = int(self.cell.max()) + 1
        # a step leads at most 255 cells down or up from the cells in use
        self.check = np.full(end + 512, -1, dtype=np.int32)
        self.base = np.zeros(end + 512, dtype=np.int32)
        self.check[self.cell[child]] = self.cell[parent]
        self.base[self.cell] = base

    def advance(self, state: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the states that a word leads on, and the new states."""
        live = np.flatnonzero(number >= 0)
        state, number = state[live], number[live]
        for shift in (16, 8, 0):
            to = self.base[state] + ((number >> shift) & 255)
            to = np.where(to < 0, len(self.check) - 1, to)
            go = np.flatnonzero(self.check[to] == state)
            state, number, live = to[go], number[go], live[go]
        return live, state

    def count(self, text: Words, number: np.ndarray, at: np.ndarray, counts: np.ndarray) -> None:
        """Adds each phrase's occurrences that start at the given places. ``number``: of each word, negative where it has none."""
        root = pc.index_in(text.langs.cast(self.roots.type), self.roots).fill_null(-1).to_numpy()[text.lang[at]]
        at, root = at[root >= 0], root[root >= 0]
        state = self.roots_at[root]
        for depth in range(LONGEST):
            use = text.together(at, depth + 1)
            at, state = at[use], state[use]
            live, state = self.advance(state, number[at + depth])
            at = at[live]
            found = self.accept[state]
            counts += np.bincount(found[found >= 0], minlength=len(counts))
            if not len(at):
                break


def _block_of(phrase: Column, blocks: int) -> Column:
    return F.pmod(F.crc32(F.substring_index(phrase, " ", 1).cast("binary")), F.lit(blocks))


def _count_phrases(tries: dict[int, Trie], blocks: int):
    """``tries`` by the numbers of their blocks; they share their words."""
    words_ = next(iter(tries.values())).words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {k: np.zeros(len(trie.phrases), dtype=np.int64) for k, trie in tries.items()}
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                text = Words(batch)
                if not len(text.codes):
                    continue
                number = pc.index_in(text.distinct.cast(pa.large_string()), words_).fill_null(-1).to_numpy().astype(np.int64)[text.codes]
                at = np.flatnonzero(number >= 0)
                if blocks == 1:
                    tries[0].count(text, number, at, counts[0])
                    continue
                own = np.array([zlib.crc32(x) % blocks for x in text.distinct.to_pylist()])[text.codes[at]]
                for k, trie in tries.items():
                    trie.count(text, number, at[own == k], counts[k])
        for k, trie in tries.items():
            some = pa.array(np.flatnonzero(counts[k]))
            yield pa.RecordBatch.from_arrays([trie.langs.take(some).cast(pa.string()), trie.phrases.take(some).cast(pa.string()), pa.array(counts[k]).take(some)], names=["lang", "phrase", "n"])

    return run


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            data, bounds = text_bytes(batch.column(batch.schema.get_field_index("text")))
            inside = _LETTERS[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            begin = bounds[:-1][bounds[:-1] < len(data)]
            first[begin] = inside[begin]
            before = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(first)))[bounds]
            langs = pc.dictionary_encode(batch.column(batch.schema.get_field_index("lang")).fill_null(UNKNOWN))
            n = np.zeros(len(langs.dictionary), dtype=np.int64)
            np.add.at(n, langs.indices.to_numpy(), np.diff(before))
            yield pa.RecordBatch.from_arrays([langs.dictionary.cast(pa.string()), pa.array(n)], names=["lang", "n"])


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(docs["lang"].cast("string").alias("lang"), docs["text"].cast("string").alias("text"))


def phrase_counts(docs: DataFrame, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """(lang, phrase, a): phrases of up to ``LONGEST`` words that stand ``least`` times, and the words they hold."""
    docs = _inputs(docs)
    listed = candidates(docs, least)
    blocks = max(1, -(-listed.count() // block))
    number = _block_of(F.col("phrase"), blocks)
    parts, together = [], max(1, AT_ONCE // block)
    for k in range(0, blocks, together):
        rows = {}
        for own in range(k, min(k + together, blocks)):
            found = listed.filter(number == own).toArrow()
            if found.num_rows:
                rows[own] = [found[c].combine_chunks().cast(pa.large_string()) for c in ("lang", "phrase")]
        if not rows:
            continue
        words_ = pc.unique(pa.chunked_array([pc.unique(pc.split_pattern(phrases, " ").flatten()) for _, phrases in rows.values()]))
        tries = {own: Trie(*row, words_) for own, row in rows.items()}
        sums = docs.mapInArrow(_count_phrases(tries, blocks), "lang string, phrase string, n long")
        parts.append(stored(sums.groupBy("lang", "phrase").agg(F.sum("n").alias("a")).filter(F.col("a") >= least), "phrase-counts"))
    if not parts:
        return listed.select("lang", "phrase", F.lit(None).cast("long").alias("a"))  # no rows
    found = parts[0]
    for part in parts[1:]:
        found = found.union(part)
    return found


def _scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score): each phrase with its lowest cut."""
    words_ = F.split("phrase", " ")
    cuts = counts.withColumn("w", words_).filter("size(w) > 1")
    cuts = cuts.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.expr("array_join(slice(w, 1, k), ' ')").alias("left"), F.expr("array_join(slice(w, k + 1, size(w)), ' ')").alias("right"))
    known = counts.select(F.col("lang").alias("lang_"), F.col("phrase").alias("part"), F.col("a").alias("c"))
    # every part of a phrase that stands often enough stands often enough itself
    cuts = cuts.join(known, (F.col("lang") == F.col("lang_")) & (F.col("left") == F.col("part"))).drop("lang_", "part").withColumnRenamed("c", "l")
    cuts = cuts.join(known, (F.col("lang") == F.col("lang_")) & (F.col("right") == F.col("part"))).drop("lang_", "part").withColumnRenamed("c", "r")
    exact = F.expr(f"(cast({2 * SCALE} as decimal(18, 0)) * cast(a as decimal(19, 0))) div (cast(l as decimal(19, 0)) + cast(r as decimal(19, 0)))")
    lowest = cuts.withColumn("score", exact).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    return lowest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score")


def _inside_longer(counts: DataFrame) -> DataFrame:
    """(lang, phrase, longer): the largest count of a longer phrase that holds the phrase."""
    w = F.split("phrase", " ")
    parts = counts.withColumn("w", w).filter("size(w) > 2")
    sub = F.expr("flatten(transform(sequence(2, size(w) - 1), m -> transform(sequence(1, size(w) - m + 1), s -> array_join(slice(w, s, m), ' '))))")
    return parts.select("lang", F.explode(sub).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST) -> DataFrame:
    """The best ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    counts = phrase_counts(docs, least)
    scored = _scored(counts).join(_inside_longer(counts), ["lang", "phrase"], "left")
    wide = "decimal(38, 0)"
    kept = scored.filter(F.col("longer").isNull() | (F.lit(100).cast(wide) * F.col("longer") < F.lit(INSIDE).cast(wide) * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = _inputs(docs).mapInArrow(_totals, "lang string, n long").groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
