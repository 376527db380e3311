"""MinHash near-duplicates with SetSketch registers.

A document's set holds the fingerprints of its distinct word shingles. Every element draws rising
values with exponential spacings, each for another register; a register keeps the smallest value on
a logarithmic scale, truncated to 16 bits. Sketches of a union are element-wise maxima, and two sets
agree in a register about as often as their similarity. Bands of register values propose pairs, the
joint likelihood of the register differences dismisses pairs that cannot reach the similarity, and
the full sets decide.

Equal sets are one vertex. Pairs of a band are not all emitted: see ``graph.verified_components``.

Defined results: null, empty and blank texts have an empty set, link with nothing and stay; a text
with fewer words than a shingle is one shingle; texts of any length are used whole; rows that share
an id are one document with several texts; rows without an id link with nothing; other columns are
kept by ``near_dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import WORD_VISIBLE, grams, mix, range_sums, signed, slices, stored, text_bytes, words
from .graph import key_stars, verified_components

REGISTERS, BAND_ROWS = 256, 6
BANDS = REGISTERS // BAND_ROWS
#: Base of the scale, rate of the exponential values, largest register.
BASE, RATE, LARGEST = 1.001, 20.0, 65_535
#: A pair is dismissed if its likelihood at the wanted similarity is this many powers of e below the best.
DISMISS = 24.0
SLICE_BYTES = 2 << 20

_SCHEMA = "doc_id long, n_shingles long, print_1 long, print_2 long, bands array<long>, registers binary"


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """Sorted fingerprints of the distinct shingles of each row."""
    data, bounds = text_bytes(batch.column(batch.schema.get_field_index("text")))
    prints, _, _, rows = words(data, bounds, WORD_VISIBLE, lower=True)
    all_ = grams(prints, size)
    sets = []
    for a, b in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if b - a >= size:
            sets.append(np.unique(all_[a : b - size + 1]))
        elif b > a:
            sets.append(range_sums(prints[a:b], np.array([0]), np.array([b - a])))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers of each set (zeros for an empty one)."""
    m, sizes = REGISTERS, np.array([len(s) for s in sets])
    least = np.full((len(sets), m), np.inf)
    flat = least.reshape(-1)
    of = np.repeat(np.arange(len(sets)), sizes)
    element = mix(np.concatenate(sets) + np.uint64(0x5851F42D4C957F2D)) if len(of) else np.empty(0, dtype=np.uint64)
    value = np.zeros(len(of))
    limit = np.full(len(sets), np.inf)
    for j in range(m):
        if not len(of):
            break
        drawn = mix(element + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        value = value - np.log1p(-((drawn >> np.uint64(11)) * 2.0**-53)) / (RATE * (m - j))
        keep = value < limit[of]
        if not keep.all():
            element, value, of = element[keep], value[keep], of[keep]
        # a permutation of the registers for each element
        low = element & np.uint64(0xFFFFFFFF)
        r = ((low >> np.uint64(8)) | np.uint64(1)) * np.uint64(j) + low & np.uint64(m - 1)
        r ^= r >> np.uint64(4)
        r = r * ((low >> np.uint64(16)) | np.uint64(1)) + (low >> np.uint64(24)) & np.uint64(m - 1)
        r ^= r >> np.uint64(3)
        np.minimum.at(flat, of * m + r.astype(np.int64), value)
        if j < 8 or j % 4 == 0:
            live = np.unique(of)
            limit[live] = least[live].max(axis=1)
    with np.errstate(divide="ignore"):
        scaled = np.floor(1.0 - np.log(least) / np.log(BASE))
    return np.clip(np.where(np.isfinite(least), scaled, 0), 0, LARGEST).astype(np.uint16)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One key per band: its number and its register values."""
    use = registers[:, : BANDS * BAND_ROWS].astype(np.uint64).reshape(len(registers), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), use.shape[:2]).copy()
    for r in range(BAND_ROWS):
        key = mix(key * np.uint64(0xD1B54A32D192ED03) + use[:, :, r])
    return key


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                sets = shingle_sets(batch, size)
                registers = sketches(sets)
                keys = signed(band_keys(registers).reshape(-1))
                n = len(sets)
                sums = [np.array([mix(s + np.uint64(salt)).sum(dtype=np.uint64) for s in sets], dtype=np.uint64) for salt in (1, 0x632BE59BD9B4E019)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(batch.schema.get_field_index("doc_id")),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(signed(sums[0])),
                        pa.array(signed(sums[1])),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(keys)),
                        pa.array([r.tobytes() for r in registers], pa.binary()),
                    ],
                    names=["doc_id", "n_shingles", "print_1", "print_2", "bands", "registers"],
                )

    return run


def _unlike(x: np.ndarray) -> np.ndarray:
    return -np.log(np.maximum(1.0 - x * (BASE - 1.0) / BASE, 1e-300)) / np.log(BASE)


def likelihood_gap(n_a, n_b, larger, smaller, similarity: float) -> np.ndarray:
    """Best log likelihood of a pair less its best one at ``similarity`` or more.

    ``larger`` and ``smaller`` count the registers in which the first is larger or smaller.
    """
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    equal = REGISTERS - larger - smaller
    most = np.minimum(u / v, v / u)

    def value(j):
        p, q = np.maximum(_unlike(u - v * j), 1e-12), np.maximum(_unlike(v - u * j), 1e-12)
        return larger * np.log(p) + smaller * np.log(q) + equal * np.log(np.maximum(1.0 - p - q, 1e-12))

    best, above = np.full(len(u), -np.inf), np.full(len(u), -np.inf)
    for j in np.linspace(0.0, 1.0, 81):
        at = np.minimum(j, most)
        found = value(at)
        best = np.maximum(best, found)
        above = np.where(at >= similarity - 1e-9, np.maximum(above, found), above)
    return best - above


def _likely(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for c in ("ra", "rb"))
                n_a, n_b = (batch.column(c).to_numpy().astype(np.float64) for c in ("na", "nb"))
                gap = likelihood_gap(n_a, n_b, (a > b).sum(axis=1), (a < b).sum(axis=1), similarity)
                yield batch.filter(pa.array(gap <= DISMISS)).select(["a", "b"])

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                sets = shingle_sets(batch, size)
                columns = [batch.column(batch.schema.get_field_index("doc_id")), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "size", "body"])

    return run


def read_sets(bodies: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in bodies]


def confirmed(percent: int):
    """Pairs whose sets reach the similarity: 100 * common >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                a, b = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                common = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
                fits.append(100 * common >= percent * (len(a) + len(b) - common) and len(a) > 0)
            yield batch.filter(pa.array(fits, pa.bool_())).select(["a", "b"])

    return run


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest linked id), kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketched = stored(docs.mapInArrow(_sketch(shingle), _SCHEMA), "sketches")
    same = ["n_shingles", "print_1", "print_2"]
    some = sketched.filter("doc_id is not null and n_shingles > 0")
    groups = some.groupBy(*same).agg(F.min("doc_id").alias("first"))
    chosen = some.join(groups, same).filter("doc_id = first")
    hits = stored(key_stars(chosen.select(F.col("doc_id").alias("id"), "bands")), "hits")
    ids = hits.select(F.col("a").alias("id")).union(hits.select(F.col("b").alias("id"))).distinct()
    of = docs.join(ids, docs["doc_id"] == ids["id"], "left_semi")
    sets = stored(of.mapInArrow(_sets(shingle), "id long, size long, body binary"), "sets")
    known = sketched.join(ids, sketched["doc_id"] == ids["id"], "left_semi").filter("n_shingles > 0").select("doc_id", "n_shingles", "registers")
    known = stored(known, "registers")

    def verify(pairs: DataFrame) -> DataFrame:
        # the member first: the side that many pairs share is joined last, where its rows can be split
        side = lambda x: known.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
        near = pairs.join(side("b"), "b").join(side("a"), "a").filter(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")
        near = near.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(_likely(percent / 100), "a long, b long").distinct()
        full = lambda x: sets.select(F.col("id").alias(x), F.col("body").alias(f"s{x}"))
        full_ = near.join(full("b"), "b").join(full("a"), "a").select("a", "b", "sa", "sb")
        return full_.mapInArrow(confirmed(percent), "a long, b long")

    found = verified_components(hits, verify, sets, read_sets, percent)
    # rows of one id that have different sets are linked by their id
    labelled = some.select("doc_id", *same).join(groups, same).join(found, F.col("first") == F.col("id"), "left")
    labels = labelled.groupBy("doc_id").agg(F.min(F.coalesce("component", "first")).alias("component"))
    out = sketched.select("doc_id", "n_shingles").join(labels, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The documents without the near-duplicates of one with a smaller id, in all their columns."""
    gone = near_duplicates(docs.select("doc_id", "text"), shingle, percent).filter("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
