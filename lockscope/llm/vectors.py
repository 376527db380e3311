"""Embedding near-duplicates by a robust-pruned flat graph.

Cluster centres are fitted on a bounded sample; every vector goes to the shards of its nearest
``OVERLAP`` centres. In a shard tight clumps are one vertex: each vector belongs to a leader within
``TIGHT`` of the angle that a link allows, so all members of a leader link with each other. A task builds a pruned
neighbour graph over the leaders of its shard; candidates are the nearest ones, the ones that a greedy
search for the vertex comes by, and distant ones. The adjacency lists of a vector are united over its shards.

Then, in every shard, each leader is searched greedily from the medoids (one for each connected part of
the graph), and the search is widened along the edges as long as it finds leaders whose members could be in range.
Only members of leaders that the search has found are compared, in double precision: no link is false,
and what the graph does not lead to is not found. Pairs that share no shard are not compared either. ``exact_links``
counts the true links of the vectors whose id is divisible by a number; the registered query reports
them beside the links found.

Equal vectors are one vertex with a count. A shard of more than ``SHARD_ROWS`` vectors is cut into
blocks and searched by pairs of blocks, so no task holds more than two blocks. A pair is counted in
the first shard that both vectors share.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with
nothing, and so do rows without an id; vectors of different lengths are not compared; rows of equal
vectors link with each other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ranges, stored
from .graph import components

THRESHOLD = 0.95
#: Vectors that the centres are fitted on, at most about so many.
SAMPLE_ROWS = 20_000
SHARD_TARGET, SHARD_ROWS, CENTRES, OVERLAP = 1000, 3000, 4096, 3
DEGREE, POOL, SLACK, BEAM = 24, 48, 1.2, 16
#: Candidates for edges that are drawn without regard to distance.
DISTANT = 8
TIGHT = 0.3
LENGTHS = 64
#: Pairs of members compared at once; queries of the audit held by a task.
PAIRS, AUDIT_BLOCK = 1 << 18, 2000


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centres(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from evenly spaced starting points."""
    sample = unit(sample)
    found = sample[np.linspace(0, len(sample) - 1, min(k, len(sample))).astype(int)]
    for _ in range(rounds):
        nearest = np.concatenate([(sample[a : a + 4096] @ found.T).argmax(axis=1) for a in range(0, len(sample), 4096)])
        sums = np.zeros_like(found)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        found = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), found)
    return found


def _pruned(order: np.ndarray, sims: np.ndarray, vectors: np.ndarray, degree: int) -> np.ndarray:
    """Robust pruning for all vertices at once: candidates from near to far, -1 where none.

    A candidate is dropped when a chosen one is nearer to it, by the factor SLACK, than the vertex is.
    """
    n, pool = order.shape
    far = np.sqrt(np.maximum(2.0 - 2.0 * sims, 0.0))
    alive = order >= 0
    chosen = np.full((n, degree), -1, dtype=np.int64)
    for k in range(degree):
        has = alive.any(axis=1)
        if not has.any():
            break
        pick = alive.argmax(axis=1)
        vertex = np.where(has, order[np.arange(n), pick], -1)
        chosen[:, k] = vertex
        between = np.einsum("nd,npd->np", vectors[np.maximum(vertex, 0)], vectors[np.maximum(order, 0)])
        between = np.sqrt(np.maximum(2.0 - 2.0 * between, 0.0))
        alive &= ~((SLACK * between <= far) & has[:, None])
        alive[np.arange(n)[has], pick[has]] = False
    return chosen


def leaders(vectors: np.ndarray, angle: float, block: int = 512) -> np.ndarray:
    """For each vector one within ``angle`` that leads it; leaders lead themselves."""
    near, of, found = np.cos(angle), np.full(len(vectors), -1, dtype=np.int64), np.empty(0, dtype=np.int64)
    for a in range(0, len(vectors), block):
        part = vectors[a : a + block]
        if len(found):
            sims = part @ vectors[found].T
            best = sims.argmax(axis=1)
            some = sims[np.arange(len(part)), best] >= near
            of[a : a + len(part)][some] = found[best[some]]
        rest = a + np.flatnonzero(of[a : a + len(part)] < 0)
        close = vectors[rest] @ vectors[rest].T >= near
        for k, x in enumerate(rest):
            if of[x] < 0:
                of[rest[close[k] & (of[rest] < 0)]] = x
                of[x] = x
        found = np.concatenate((found, rest[of[rest] == rest]))
    return of


def build_graph(vectors: np.ndarray, block: int = 512) -> np.ndarray:
    """Pruned neighbours of each vector, -1 where there are fewer."""
    n = len(vectors)
    if n < 2:
        return np.full((n, DEGREE), -1, dtype=np.int64)
    pool = min(POOL, n - 1)
    near = np.empty((n, pool), dtype=np.int64)
    for a in range(0, n, block):
        sims = vectors[a : a + block] @ vectors.T
        sims[np.arange(len(sims)), a + np.arange(len(sims))] = -np.inf
        near[a : a + block] = np.argpartition(-sims, pool - 1, axis=1)[:, :pool]
    distant = np.random.default_rng(n).integers(0, n, (n, DISTANT))
    graph = _edges(vectors, np.concatenate((near, distant), axis=1), block)
    entries = medoids(vectors, graph)
    passed = np.concatenate([_beam(vectors, graph, entries, vectors[a : a + block])[0] for a in range(0, n, block)])
    return _edges(vectors, np.concatenate((near, distant, passed), axis=1), block)


def _edges(vectors: np.ndarray, candidates: np.ndarray, block: int) -> np.ndarray:
    """Pruned edges among the candidates (-1: none; some may stand twice), and edges back."""
    n = len(vectors)
    half = np.full((n, DEGREE), -1, dtype=np.int64)
    for a in range(0, n, block):
        near = np.sort(candidates[a : a + block], axis=1)
        own = (a + np.arange(len(near)))[:, None]
        bad = (near < 0) | (near == own)
        bad[:, 1:] |= near[:, 1:] == near[:, :-1]
        got = np.where(bad, -np.inf, np.einsum("nd,npd->np", vectors[a : a + block], vectors[np.maximum(near, 0)]))
        by = np.argsort(-got, axis=1, kind="stable")
        got = np.take_along_axis(got, by, axis=1)
        near = np.where(np.isfinite(got), np.take_along_axis(near, by, axis=1), -1)
        half[a : a + block] = _pruned(near, np.where(np.isfinite(got), got, -1.0), vectors, DEGREE)
    # edges back, as many as there is room for, nearest first
    source, slot = np.nonzero(half >= 0)
    target = half[source, slot]
    closeness = np.einsum("ed,ed->e", vectors[source], vectors[target])
    order = np.lexsort((-closeness, target))
    source, target = source[order], target[order]
    first = np.searchsorted(target, np.arange(n))
    rank = np.arange(len(target)) - first[target]
    back = np.full((n, DEGREE), -1, dtype=np.int64)
    some = rank < DEGREE
    back[target[some], rank[some]] = source[some]
    return np.concatenate((half, back), axis=1)


def medoids(vectors: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """The middle vertex of each connected part of the graph."""
    source, slot = np.nonzero(graph >= 0)
    part = _roots(len(vectors), source, graph[source, slot])
    _, part = np.unique(part, return_inverse=True)
    sums = np.zeros((part.max() + 1, vectors.shape[1]))
    np.add.at(sums, part, vectors)
    order = np.lexsort((-np.einsum("nd,nd->n", vectors, sums[part]), part))
    return order[np.searchsorted(part[order], np.arange(part.max() + 1))]


def _beam(vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest vertices that a greedy search from the entries finds for each row of ``wanted``, and their cosines."""
    q, k = len(wanted), min(BEAM, len(entries))
    beam, sims = np.full((q, BEAM), -1, dtype=np.int64), np.full((q, BEAM), -np.inf)
    start = wanted @ vectors[entries].T
    best = np.argpartition(-start, k - 1, axis=1)[:, :k]
    beam[:, :k], sims[:, :k] = entries[best], np.take_along_axis(start, best, axis=1)
    done = np.zeros((q, BEAM), dtype=bool)
    live = np.arange(q)
    for _ in range(4 * BEAM):
        score = np.where(done[live] | (beam[live] < 0), -np.inf, sims[live])
        pick = score.argmax(axis=1)
        live, pick = live[np.isfinite(score.max(axis=1))], pick[np.isfinite(score.max(axis=1))]
        if not len(live):
            break
        done[live, pick] = True
        near = graph[beam[live, pick]]
        fresh = (near >= 0) & ~(near[:, :, None] == beam[live][:, None, :]).any(axis=2)
        got = np.where(fresh, np.einsum("qd,qrd->qr", wanted[live], vectors[np.maximum(near, 0)]), -np.inf)
        ids, all_, old = np.concatenate((beam[live], near), axis=1), np.concatenate((sims[live], got), axis=1), np.concatenate((done[live], np.zeros_like(fresh)), axis=1)
        # a neighbour may stand twice in a list: keep its first place
        by = np.argsort(ids, axis=1, kind="stable")
        sorted_ids = np.take_along_axis(ids, by, axis=1)
        twice = np.zeros_like(fresh, shape=ids.shape)
        np.put_along_axis(twice, by[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
        all_ = np.where(twice, -np.inf, all_)
        top = np.argsort(-all_, axis=1, kind="stable")[:, :BEAM]
        sims[live], done[live] = np.take_along_axis(all_, top, axis=1), np.take_along_axis(old, top, axis=1)
        beam[live] = np.where(np.isfinite(sims[live]), np.take_along_axis(ids, top, axis=1), -1)
    return beam, sims


def search(vectors: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, threshold: float) -> np.ndarray:
    """For each query (a row number) the rows found in range: greedy beam from the entries, then widened."""
    n, q = len(vectors), len(queries)
    wanted = vectors[queries]
    beam, sims = _beam(vectors, graph, entries, wanted)
    found = np.zeros((q, n), dtype=bool)
    hit = sims >= threshold
    found[np.nonzero(hit)[0], beam[hit]] = True
    found[np.arange(q), queries] = True
    who, where = np.nonzero(found)
    while len(who):
        near = graph[where]
        some = near >= 0
        who, where = np.repeat(who, some.sum(axis=1)), near[some]
        fresh = ~found[who, where]
        pair = np.unique(who[fresh] * n + where[fresh])
        who, where = pair // n, pair % n
        in_range = np.concatenate([np.einsum("ed,ed->e", wanted[who[a : a + 65536]], vectors[where[a : a + 65536]]) for a in range(0, len(who), 65536)] or [np.empty(0)]) >= threshold
        who, where = who[in_range], where[in_range]
        found[who, where] = True
    return found


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def _angles(threshold: float) -> tuple[float, float]:
    """The angle of a link, and how far a member may be from its leader."""
    link = float(np.arccos(threshold))
    return link, TIGHT * link


def _build(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, vectors = group["id"].to_numpy(), unit(_matrix(group["vector"]))
        chosen = np.flatnonzero(leaders(vectors, _angles(threshold)[1]) == np.arange(len(ids)))
        graph = build_graph(vectors[chosen])
        source, slot = np.nonzero(graph >= 0)
        return pa.table({"id": pa.array(ids[chosen[source]], pa.int64()), "near": pa.array(ids[chosen[graph[source, slot]]], pa.int64())})

    return run


def _roots(n: int, source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smallest vertex of each component by label passing with shortcuts."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, source, label[target])
        np.minimum.at(new, target, label[source])
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _united(ids: np.ndarray, of: np.ndarray, lists: list[list[int] | None]) -> tuple[np.ndarray, np.ndarray]:
    """The leaders of a shard, and the united lists of all its vectors as edges between them."""
    chosen = np.flatnonzero(of == np.arange(len(of)))
    number = np.searchsorted(chosen, of)
    sizes = np.array([len(x or ()) for x in lists])
    far = np.array([y for x in lists for y in x or ()], dtype=np.int64)
    at = np.minimum(np.searchsorted(ids, far), len(ids) - 1)
    here = ids[at] == far
    source, target = number[np.repeat(np.arange(len(ids)), sizes)[here]], number[at[here]]
    pair = np.unique(source[source != target] * len(chosen) + target[source != target])
    source, target = pair // len(chosen), pair % len(chosen)
    first = np.searchsorted(source, np.arange(len(chosen)))
    rank = np.arange(len(source)) - first[source]
    graph = np.full((len(chosen), int(rank.max()) + 1 if len(rank) else 1), -1, dtype=np.int64)
    graph[source, rank] = target
    return chosen, graph


def _search(threshold: float):
    link, tight = _angles(threshold)

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        ids, copies = group["id"].to_numpy(), group["copies"].to_numpy()
        vectors = unit(_matrix(group["vector"]))
        of = leaders(vectors, tight)
        chosen, graph = _united(ids, of, group["near"].to_pylist())
        points = vectors[chosen]
        entries = medoids(points, graph)
        one, other = [], []
        for a in range(0, len(chosen), 512):
            queries = np.arange(a, min(a + 512, len(chosen)))
            x, y = np.nonzero(search(points, graph, entries, queries, np.cos(min(np.pi, link + 2 * tight))))
            one.append(x + a)
            other.append(y)
        one, other = np.concatenate(one), np.concatenate(other)
        # a pair found from one side only holds for both
        pair = np.unique(np.concatenate((one * len(chosen) + other, other * len(chosen) + one)))
        one, other = pair // len(chosen), pair % len(chosen)
        apart = np.concatenate([np.einsum("ed,ed->e", points[one[a : a + 65536]], points[other[a : a + 65536]]) for a in range(0, len(one), 65536)])
        sure = (one == other) | (apart >= np.cos(link - 2 * tight) + 1e-12)
        links, joined = _compare(vectors, copies, of, chosen, one, other, sure, _owned(group), threshold)
        root = _roots(len(ids), np.concatenate((np.arange(len(ids)), chosen[one[joined]])), np.concatenate((of, chosen[other[joined]])))
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(ids[root], pa.int64())})

    return run


def _owned(group: pa.Table):
    """Which pairs of rows this task counts: those that share no earlier shard, and of two blocks those across."""
    shards, here = np.array(group["shards"].to_pylist(), dtype=np.int64), group["shard"][0].as_py()
    blocks = group["block"].to_numpy()
    two = len(np.unique(blocks)) > 1 or group["two"][0].as_py()
    mine = np.where(shards < here, shards, -1 - np.arange(shards.shape[1])[None, :])
    theirs = np.where(shards < here, shards, -99)

    def owned(who: np.ndarray, where: np.ndarray) -> np.ndarray:
        own = who != where
        for k in range(mine.shape[1]):
            own &= ~(mine[who, k][:, None] == theirs[where]).any(axis=1)
        return own & (blocks[who] != blocks[where]) if two else own

    return owned


def _compare(vectors, copies, of, chosen, one, other, sure, owned, threshold) -> tuple[np.ndarray, np.ndarray]:
    """Links of each vector, and which of the pairs of leaders have members that link. Members are compared in bounded blocks."""
    members = np.argsort(of, kind="stable")
    begin = np.searchsorted(of[members], chosen)
    size = np.diff(np.append(begin, len(members)))
    links, joined = np.zeros(len(vectors), dtype=np.int64), sure.copy()
    # one row for each member of the first leader, against all members of the second
    rows = np.repeat(np.arange(len(one)), size[one])
    first = members[ranges(begin[one], size[one])]
    upto = np.cumsum(size[other[rows]])
    a = 0
    while a < len(rows):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, side="right")))
        counts = size[other[rows[a:b]]]
        pair, who = np.repeat(rows[a:b], counts), np.repeat(first[a:b], counts)
        where = members[ranges(begin[other[rows[a:b]]], counts)]
        near = sure[pair].copy()
        test = np.flatnonzero(~near)
        for c in range(0, len(test), 65536):
            at = test[c : c + 65536]
            near[at] = np.einsum("ed,ed->e", vectors[who[at]], vectors[where[at]]) >= threshold
        joined[pair[near]] = True
        own = near & owned(who, where)
        links += np.bincount(who[own], copies[where[own]], minlength=len(vectors)).astype(np.int64)
        a = b
    return links, joined


def _assign(found: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                vectors = unit(np.array(batch.column(2).to_pylist(), dtype=np.float64))
                k = min(OVERLAP, len(found))
                sims = vectors @ found.T
                near = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k < len(found) else np.tile(np.arange(k), (len(sims), 1))
                shards = pa.array(np.sort(near, axis=1).tolist(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, shards], names=["id", "copies", "vector", "shards"])

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """(id, vector) of the rows that can link."""
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))


def _links(distinct: DataFrame, threshold: float, total: int) -> DataFrame:
    """(id, links, root) of vectors of one length: links over all shards, a root in each."""
    share = min(1.0, SAMPLE_ROWS / max(1, total))
    sample = distinct.filter(F.pmod(F.xxhash64("vector"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("vector")
    found = centres(np.array([r[0] for r in sample.limit(2 * SAMPLE_ROWS).collect()], dtype=np.float64), min(CENTRES, -(-total // SHARD_TARGET)))
    spread = stored(distinct.mapInArrow(_assign(found), "id long, copies long, vector array<double>, shards array<long>"), "assigned")
    placed = spread.withColumn("shard", F.explode("shards"))
    blocks = placed.groupBy("shard").agg(F.ceil(F.count("*") / SHARD_ROWS).cast("int").alias("blocks"))
    placed = placed.join(blocks, "shard").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    # block b meets every other block once, and itself
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    tasks = placed.withColumns({"low": low, "high": high, "two": low != high})
    task = ["shard", "low", "high"]
    edges = tasks.select(*task, "id", "vector").groupBy(*task).applyInArrow(_build(threshold), "id long, near long")
    united = edges.groupBy("id").agg(F.collect_set("near").alias("near"))
    ready = tasks.select(*task, "two", "block", "id", "copies", "vector", "shards").join(united, "id", "left")
    return ready.groupBy(*task).applyInArrow(_search(threshold), "id long, links long, root long")


def vector_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, audit: int | None = None) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    With ``audit``, ids divisible by it also have ``n_true``, the links that brute force counts.
    """
    usable = _usable(vectors)
    groups = stored(usable.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies")), "vectors")
    lengths = groups.groupBy(F.size("vector").alias("n")).count().limit(LENGTHS + 1).collect()
    if len(lengths) > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} different lengths")
    empty = groups.sparkSession.createDataFrame([], "id long, links long, root long")
    parts = [stored(_links(groups.filter(F.size("vector") == n).select("id", "copies", "vector"), threshold, total), "links") for n, total in lengths]
    links = parts[0] if parts else empty
    for part in parts[1:]:
        links = links.union(part)
    found = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    done = groups.join(counted, "id", "left").join(found, "id", "left")
    done = done.select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    of_rows = usable.join(done, "vector").groupBy("id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id")).join(of_rows, F.col("vec_id") == F.col("id"), "left").drop("id")
    component = F.coalesce("component_id", "vec_id")
    columns = ["vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept")]
    if audit:
        out = out.join(exact_links(vectors, audit, threshold).withColumnRenamed("id", "vec_id"), "vec_id", "left")
        columns.append("n_true")
    return out.select(*columns)


def exact_links(vectors: DataFrame, every: int, threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_true): true links of the vectors whose id is divisible by ``every``, against all rows.

    Queries are taken in blocks of about ``AUDIT_BLOCK``, each held against all vectors in one pass.
    Of rows with one id the one with most links counts.
    """
    usable = _usable(vectors)
    queries = usable.filter(F.col("id") % every == 0)
    blocks = max(1, -(-queries.count() // AUDIT_BLOCK))
    counts = None
    for k in range(blocks):
        part = queries.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k).collect()
        by_length: dict[int, tuple[list, list]] = {}
        for number, r in enumerate(part):
            held = by_length.setdefault(len(r.vector), ([], []))
            held[0].append(number)
            held[1].append(r.vector)
        asked = {n: (np.array(numbers), unit(np.array(rows))) for n, (numbers, rows) in by_length.items()}
        ids = np.array([r.id for r in part], dtype=np.int64)

        def count(batches, asked=asked, ids=ids):
            total = np.zeros(len(ids), dtype=np.int64)
            for batch in batches:
                rows: dict[int, list] = {}
                for v in batch.column(1).to_pylist():
                    rows.setdefault(len(v), []).append(v)
                for n, found in rows.items():
                    if n in asked:
                        numbers, wanted = asked[n]
                        total[numbers] += (unit(np.array(found)) @ wanted.T >= threshold).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ids))), pa.array(ids), pa.array(total)], names=["number", "id", "n"])

        sums = usable.mapInArrow(count, "number long, id long, n long").groupBy("number", "id").agg((F.sum("n") - 1).alias("n"))
        sums = stored(sums.groupBy("id").agg(F.max("n").alias("n_true")), "true-links")
        counts = sums if counts is None else counts.union(sums)
    return counts


def audit_recall(audited: DataFrame) -> float:
    """Share of the true links found, over the rows with ``n_true``."""
    found, true = audited.filter("n_true is not null").agg(F.sum("n_links"), F.sum("n_true")).first()
    return found / true if true else 1.0
