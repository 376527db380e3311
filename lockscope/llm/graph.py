"""Links between rows: shared keys, distributed union-find, verified similarity components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ranges, stored

HITS = "key long, a long, b long"
#: (bodies, x, y, group) to which of the pairs of bodies x, y are links; of a group one link is enough.
Alike = Callable[[pa.Array, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
#: Rows of a task among which equal keys are looked for before the shuffle.
LOCAL_KEYS = 200_000
#: Buckets of keys, at least; there are more with more shuffle partitions. A task sorts one at a time.
BUCKETS = 1024
_BUCKET = ["bucket", "keys", "ids", "linked"]
#: Set elements of the x and y sides of a block.
X_ELEMENTS, Y_ELEMENTS = 60_000, 400_000
#: Pairs, and matches of elements, of a block that are counted at once.
CELLS = 2_000_000
#: Blocks of at most this many pairs may be compared pair by pair.
PAIRS = 20_000


def _by_key(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """The distinct keys in order, the smallest id of each, and (key, a, b): links from it to the key's other ids."""
    order = np.argsort(keys)
    keys, ids = keys[order], ids[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(first)
    least = np.minimum.reduceat(ids, at) if len(at) else ids
    smallest = np.repeat(least, np.diff(np.append(at, len(keys))))
    other = np.flatnonzero(ids != smallest)
    other = other[np.lexsort((ids[other], keys[other]))]
    new = np.append(True, (keys[other][1:] != keys[other][:-1]) | (ids[other][1:] != ids[other][:-1]))[: len(other)]
    other = other[new]  # an id comes once for each batch that has it
    return keys[at], least, keys[other], smallest[other], ids[other]


def run_bodies(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of 64-bit values as binary."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((8 * bounds).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _local_stars(buckets: int):
    """Rows of one task that share a key meet here: only the smallest id of a key goes on, and the links found.

    What goes on is dealt into buckets by the key, one row for each bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def done() -> Iterator[pa.RecordBatch]:
            ids, keys = (np.concatenate(x) for x in zip(*held))
            keys, ids, key, a, b = _by_key(keys.view(np.uint64), ids)
            bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
            used, at = np.unique(bucket, return_index=True)
            bounds = np.append(at, len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(used), run_bodies(keys, bounds), run_bodies(ids, bounds), pa.nulls(len(used), pa.binary())], names=_BUCKET)
            if len(key):
                # links wait in any bucket, not in that of a hot key
                bounds, any_ = np.array([0, len(key)]), pa.array([int(b[-1]) % buckets], pa.int32())
                yield pa.RecordBatch.from_arrays([any_, *(run_bodies(x, bounds) for x in (key, a, b))], names=_BUCKET)

        for batch in batches:
            keys = batch.column(1)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), keys.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            held.append((ids, keys.flatten().to_numpy(zero_copy_only=False)))
            size += len(ids)
            if size >= LOCAL_KEYS:
                yield from done()
                held, size = [], 0
        if size:
            yield from done()

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket as a stream: every id is linked with the smallest of its key."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    last = None

    def found(*links: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in links], names=["key", "a", "b"])

    for batch in batches:
        columns = [batch.column(c) for c in range(1, 4)]
        for k, bucket in enumerate(batch.column(0).to_pylist()):
            keys, ids, linked = (np.frombuffer(c[k].as_buffer() or b"", dtype=np.int64) for c in columns)
            if len(linked):
                yield found(keys, ids, linked)
                continue
            if held and bucket != last:
                yield found(*_by_key(*map(np.concatenate, zip(*held)))[2:])
                held = []
            held.append((keys, ids))
            last = bucket
    if held:
        yield found(*_by_key(*map(np.concatenate, zip(*held)))[2:])


def key_stars(rows: DataFrame, keyed: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None) -> DataFrame:
    """(key, a, b), a < b: links between the ids that share a key, as stars. ``rows``: id, keys (array of long).

    ``keyed`` makes such batches in the task, from other ``rows``.

    Keys are fingerprints, so the buckets are even: a key of very many ids has been reduced to one
    id for each ``LOCAL_KEYS`` rows of a task before the shuffle.
    """
    buckets = max(BUCKETS, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    stars = _local_stars(buckets)
    local = rows.mapInArrow((lambda batches: stars(keyed(batches))) if keyed else stars, "bucket int, keys binary, ids binary, linked binary")
    return local.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_stars, HITS)


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (a, b), for every id that has an edge.

    Union-find by alternating star steps: every vertex passes its smallest neighbour on, first to
    larger neighbours, then to smaller ones, until only stars around the smallest ids are left.
    """
    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _links_of_block(ids, placed, is_x, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between the x and the y sets of a block in different components, one for each (x, component)."""
    size = np.array([len(s) for s in sets])
    xs, ys = np.flatnonzero(is_x), np.flatnonzero(~is_x)
    element, of = np.concatenate([sets[k] for k in xs]), np.repeat(np.arange(len(xs)), size[xs])
    by = np.argsort(element, kind="stable")
    element, of = element[by], of[by]
    wanted = np.concatenate([sets[k] for k in ys])
    low = np.searchsorted(element, wanted, side="left")
    found = np.searchsorted(element, wanted, side="right") - low
    # of each y: where its elements start, and the matches before it
    start = np.concatenate(([0], np.cumsum(size[ys])))
    before = np.concatenate(([0], np.cumsum(found)))[start]
    links, at = [], 0
    while at < len(ys):
        to = int(np.searchsorted(before, before[at] + CELLS, side="right")) - 1
        to = max(at + 1, min(to, at + CELLS // len(xs), len(ys)))
        y, own = ys[at:to], slice(start[at], start[to])
        row = np.repeat(np.arange(to - at) * len(xs), np.diff(before[at : to + 1]))
        common = np.bincount(row + of[ranges(low[own], found[own])], minlength=(to - at) * len(xs)).reshape(to - at, len(xs))
        fits = (100 * common >= percent * (size[xs] + size[y][:, None] - common)) & (common > 0) & (placed[xs] != placed[y][:, None])
        of_y, of_x = np.nonzero(fits)
        links.append(np.stack([ids[xs[of_x]], placed[y[of_y]], ids[y[of_y]]]))
        at = to
    x, c, y = np.concatenate(links, axis=1)
    by = np.lexsort((y, c, x))
    x, c, y = x[by], c[by], y[by]
    first = np.append(True, (x[1:] != x[:-1]) | (c[1:] != c[:-1]))[: len(x)]
    return list(zip(x[first].tolist(), y[first].tolist()))


def _pairs_of_blocks(ids, placed, is_x, blocks: list[tuple[int, int]], bodies: pa.Array, alike: Alike) -> list[tuple[int, int]]:
    """What ``_links_of_block`` gives, for small blocks at once."""
    xs, ys = [], []
    for a, b in blocks:
        x, y = a + np.flatnonzero(is_x[a:b]), a + np.flatnonzero(~is_x[a:b])
        xs.append(np.repeat(x, len(y)))
        ys.append(np.tile(y, len(x)))
    x, y = np.concatenate(xs), np.concatenate(ys)
    other = placed[x] != placed[y]
    x, y = x[other], y[other]
    if not len(x):
        return []
    of, place = np.unique(placed, return_inverse=True)
    group = x * len(of) + place[y]  # a row and a component
    _, first, number = np.unique(ids, return_index=True, return_inverse=True)
    links = np.flatnonzero(alike(bodies.take(pa.array(first)), number[x], number[y], group))
    links = links[np.unique(group[links], return_index=True)[1]]
    return list(zip(ids[x[links]].tolist(), ids[y[links]].tolist()))


def _block_links(read: Callable[[pa.Array], list[np.ndarray]], percent: int, alike: Alike | None):
    """Rows sorted by block as a stream; a block is worked on when its last row has come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def done(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            blocks = np.stack([rows[c].to_numpy() for c in ("main", "x_block", "y_block")])
            starts = np.flatnonzero(np.append(True, (blocks[:, 1:] != blocks[:, :-1]).any(axis=0)))
            ids, placed, is_x = (rows[c].to_numpy() for c in ("id", "c", "is_x"))
            links = []
            for at, to in _few(starts, rows.num_rows):
                bodies = rows["body"].slice(at, to - at).combine_chunks()
                own = starts[(starts >= at) & (starts < to)]
                few, many = [], []
                for a, b in zip(own, np.append(own[1:], to)):
                    n = int(is_x[a:b].sum())
                    if 0 < n < b - a:
                        (few if alike and n * (b - a - n) <= PAIRS else many).append((a, b))
                if few:
                    run_ = slice(at, to)
                    links += _pairs_of_blocks(ids[run_], placed[run_], is_x[run_], [(a - at, b - at) for a, b in few], bodies, alike)
                if many:
                    sets = read(bodies) if not few else None
                    for a, b in many:
                        links += _links_of_block(ids[a:b], placed[a:b], is_x[a:b], sets[a - at : b - at] if sets else read(bodies.slice(a - at, b - a)), percent)
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            key = [table[c].to_numpy() for c in ("main", "x_block", "y_block")]
            other = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0  # the last block may go on
            first = tuple(k[0] for k in key)
            if held and tuple(held[0][c][0].as_py() for c in ("main", "x_block", "y_block")) != first:
                yield done(pa.concat_tables(held))
                held = []
            if cut:
                yield done(pa.concat_tables([*held, table.slice(0, cut)]))
                held = []
            held.append(table.slice(cut))
        if held:
            yield done(pa.concat_tables(held))

    return run


def _few(starts: np.ndarray, n: int, rows: int = 2000) -> Iterator[tuple[int, int]]:
    """Runs of whole blocks of about ``rows`` rows."""
    at = 0
    while at < n:
        later = starts[starts >= at + rows]
        to = int(later[0]) if len(later) else n
        yield at, to
        at = to


def verified_components(
    hits: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    items: DataFrame,
    read: Callable[[pa.Array], list[np.ndarray]],
    percent: int,
    alike: Alike | None = None,
) -> DataFrame:
    """(id, component) over the links among ids that share a key.

    ``hits``: stored (key, a, b). ``verify``: pairs (a, b) to those that are links. ``items``: (id,
    size, body), where ``read`` turns bodies into sorted sets; ``alike`` compares the pairs of small
    blocks, where an index does not pay.

    First every id is compared with the smallest of its keys: most copies find their component so.
    Ids of a key that are then outside its largest component are compared with all of that component
    and with each other, in blocks of bounded size. A block counts common elements by an index of its
    x sets and hands on one link for each id and component, so no list of pairs is ever made, and only
    ids that are already in one component go uncompared.
    """
    edges = stored(verify(hits.select("a", "b").distinct()), "links")
    found = stored(components(edges), "components")
    members = hits.select("key", F.col("a").alias("id")).union(hits.select("key", F.col("b").alias("id"))).distinct()
    placed = stored(members.join(found, "id", "left").select("key", "id", F.coalesce("component", "id").alias("c")), "members")
    largest = F.max_by("c", F.struct("n", -F.col("c")))
    per_key = placed.groupBy("key", "c").agg(F.count("*").alias("n")).groupBy("key").agg(F.sum("n").alias("n"), F.count("*").alias("parts"), largest.alias("main"))
    # the two ids of a small key have been compared
    open_ = per_key.filter("parts > 1 and n > 2").select("key", "main")
    left = stored(placed.join(open_, "key").filter("c <> main").select("main", "id", "c").distinct(), "left-over")
    if not left.limit(1).count():
        return found
    mains = left.select("main").distinct()
    of_main = mains.join(found.select(F.col("component").alias("main"), "id"), "main").select("main", "id", F.col("main").alias("c"))
    alone = mains.select("main", F.col("main").alias("id"), F.col("main").alias("c"))
    y_all = of_main.union(alone).union(left).distinct()
    sides = left.withColumn("is_x", F.lit(True)).union(y_all.withColumn("is_x", F.lit(False)))
    sized = stored(sides.join(items.select("id", "size"), "id").select("main", "id", "c", "is_x", "size"), "sides")
    blocks = sized.groupBy("main").agg(
        F.ceil(F.sum(F.when(F.col("is_x"), F.col("size"))) / X_ELEMENTS).cast("int").alias("bx"),
        F.ceil(F.sum(F.when(~F.col("is_x"), F.col("size"))) / Y_ELEMENTS).cast("int").alias("by"),
    )
    dealt = sized.join(blocks, "main")
    own = lambda n: F.array(F.pmod(F.xxhash64("id"), F.col(n)).cast("int"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    dealt = dealt.withColumn("x_block", F.explode(F.when(F.col("is_x"), own("bx")).otherwise(every("bx"))))
    dealt = dealt.withColumn("y_block", F.explode(F.when(F.col("is_x"), every("by")).otherwise(own("by"))))
    block = ["main", "x_block", "y_block"]
    full = dealt.select(*block, "id", "c", "is_x").join(items.select("id", "body"), "id").select(*block, "id", "c", "is_x", "body")
    more = full.repartition(*block).sortWithinPartitions(*block).mapInArrow(_block_links(read, percent, alike), "a long, b long")
    return components(found.filter("id <> component").select(F.col("component").alias("a"), F.col("id").alias("b")).union(more))
