"""Shared tables, byte and word arrays, and 64-bit fingerprints for the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import apply_runtime_settings

_SETTING = "spark.checkpoint.dir"
#: Bytes whose fingerprints are computed at once: a task's arrays stay near 16 times this.
BLOCK = 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15 | 5)
_INVERSE = np.uint64(pow(int(_FACTOR), -1, 1 << 64))
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session may make its own."""
    found = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lockscope-")
        spark.conf.set(_SETTING, found)
    return found.rstrip("/")


#: Rows of text in an Arrow batch. A batch is held several times while it is worked on.
BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> None:
    """Settings for a running session; what the cluster sets itself is kept."""
    apply_runtime_settings(spark)
    if not spark.sparkContext.getConf().contains(_BATCH_SETTING):
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, and safe from lost executors."""
    spark = df.sparkSession
    prepare(spark)
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = x ^ (x >> np.uint64(30))  # an array of its own from here on
    x *= _MIX_1
    x ^= x >> np.uint64(27)
    x *= _MIX_2
    x ^= x >> np.uint64(31)
    return x


_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


class _Powers:
    """Factor^i and factor^-i for i up to n. Made where they are used: they travel empty."""

    def __init__(self) -> None:
        self.up = self.down = np.empty(0, dtype=np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            self.up, self.down = (self._table(f, max(n + 1, BLOCK + 1)) for f in (_FACTOR, _INVERSE))
        return self.up, self.down

    @staticmethod
    def _table(factor: np.uint64, size: int) -> np.ndarray:
        steps = np.full(size, factor, dtype=np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)


POWERS = _Powers()


def prefix_sums(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of value * Factor^place before each place, and Factor^-place."""
    up, down = POWERS.upto(len(values))
    sums = np.empty(len(values) + 1, dtype=np.uint64)
    sums[0] = 0
    np.multiply(values, up[: len(values)], out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums, down


def range_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of values[start:end], equal for equal content wherever it lies."""
    sums, down = prefix_sums(values)
    return mix((sums[ends] - sums[starts]) * down[starts])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows one after the other, and each row's bounds (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or bounds[-1] == bounds[0]:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def ascii_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Which bytes are in the given ranges (both ends included)."""
    table_ = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table_[low : high + 1] = True
    return table_


#: Letters, digits and all that is not ASCII.
WORD_LETTERS = ascii_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
#: All but ASCII white space.
WORD_VISIBLE = ~ascii_set((0x09, 0x0D), (0x20, 0x20))


def words(
    data: np.ndarray, bounds: np.ndarray, letters: np.ndarray, lower: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints, starts and ends (in bytes) of all words, and the first word of each row.

    A word is a longest run of bytes in ``letters`` inside one row. With ``lower``, A-Z count as a-z.
    """
    inside = letters[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    first[begin] = inside[begin]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    final = bounds[1:][bounds[1:] > 0] - 1
    last[final] = inside[final]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    del inside, first, last
    rows = np.searchsorted(starts, bounds)
    symbols = _SYMBOLS.copy()
    if lower:
        symbols[0x41:0x5B] = symbols[0x61:0x7B]
    prints = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):  # whole words, one block of bytes after the other
        base = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        block = symbols[data[base : ends[to - 1]]]
        prints[at:to] = range_sums(block, starts[at:to] - base, ends[at:to] - base)
        at = to
    return prints, starts, ends, rows


def coded_words(data: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Codes of all words (runs of bytes in ``letters`` inside one row), the distinct words, starts, and each row's first word.

    Equal codes are equal words: no fingerprints.
    """
    inside = np.concatenate((letters[data], [False]))
    first = inside[:-1].copy()
    first[1:] &= ~inside[:-2]
    begin = bounds[:-1][bounds[:-1] < len(data)]
    first[begin] = inside[begin]
    last = inside[:-1] & ~inside[1:]
    final = bounds[1:][bounds[1:] > 0] - 1
    last[final] = inside[final]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    offsets = np.concatenate(([0], np.cumsum(ends - starts)))
    body = data[inside[:-1]]
    found = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
    coded = found.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, starts, np.searchsorted(starts, bounds)


def grams(prints: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of ``size`` consecutive values, by their first position."""
    n = len(prints) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    found = np.empty(n, dtype=np.uint64)
    for at in range(0, n, BLOCK):
        part = prints[at : min(at + BLOCK + size - 1, len(prints))]
        sums, down = prefix_sums(part)
        found[at : at + BLOCK] = mix((sums[size:] - sums[:-size]) * down[: len(part) - size + 1])
    return found


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    if not total:
        return np.empty(0, dtype=np.int64)
    offsets = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return offsets + np.arange(total)


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``limit`` bytes of text; a longer row comes alone."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit fingerprints as Spark longs."""
    return values.view(np.int64)
