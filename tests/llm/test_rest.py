from __future__ import annotations

import gzip
import hashlib
import itertools
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lockscope.llm import langid, packing, vectors, warc
from lockscope.llm.common import new_path
from lockscope.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


# language ID


def test_held_out_accuracy_and_und(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = spark.createDataFrame([(10**6, None), (10**6 + 1, ""), (10**6 + 2, "12 34 !! – ¡"), (10**6 + 3, "日本")], "doc_id long, text string")
    odd = odd.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.lit(0).cast("long")})
    rows = {r.doc_id: r for r in langid.languages(docs.union(odd.select(docs.columns))).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if rows[i].held_out]
    assert held and all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    assert np.mean([rows[i].lang_pred == truth[i] for i in held]) > 0.99
    assert [rows[10**6 + k].lang_pred for k in range(3)] == ["und"] * 3 and rows[10**6 + 3].lang_pred != "und"
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_mixtures_name_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.learn(docs)
    some = {r.lang: r.text for r in docs.filter("length(text) > 1500").collect()}
    mixed = spark.createDataFrame([(1, some["de"][:900] + " " + some["es"][:900], "x")], "doc_id long, text string, score string")
    (row,) = langid.identify(mixed, model).collect()
    assert {"de", "es"} <= set(row.shares) and abs(sum(row.shares.values()) - 1) < 1e-6 and row.score < 0.7
    assert langid.with_language(docs.withColumn("shares", F.lit(1)), docs).count() == docs.count()


def test_texts_that_no_language_explains(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    r = np.random.default_rng(0)
    noise = [(-1 - k, " ".join("".join(r.choice(list("abcdefghijklmnopqrstuvwxyz"), r.integers(3, 12))) for _ in range(n)), "en") for k, n in enumerate([5, 40, 400])]
    noise += [(-10, "zzzzzzzz qqqqqq xxxxxxx", None), (-11, "日本語の文章です", None)]
    both = docs.union(spark.createDataFrame(noise, docs.schema))
    kept = {x.doc_id for x in langid.with_language(both, docs).select("doc_id").collect()}
    assert kept == {x.doc_id for x in docs.select("doc_id").collect()}


def test_sets_of_many_languages(spark):
    letters = "abcdefghijklmnop"
    word = lambda k, r: "".join(r.choice([letters[2 * k], letters[2 * k + 1]], 6))
    r = np.random.default_rng(2)
    rows = [(k, " ".join(word(k, r) for _ in range(400)), f"l{k}") for k in range(8)]
    model = langid.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = " ".join(word(k, r) for k in range(7) for _ in range(60))
    (row,) = langid.identify(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).collect()
    assert set(row.shares) == {f"l{k}" for k in range(7)} and abs(row.score - 1 / 7) < 0.01


def test_language_without_anything_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[1:4] for r in langid.languages(docs).collect()] == [(False, "und", 0.0)]
    assert langid.languages(docs.limit(0)).count() == 0


def test_mixture_against_brute_force():
    r = np.random.default_rng(0)
    sizes = np.array([30, 1, 200])
    log = np.log(r.dirichlet([0.5] * 3, sizes.sum()))
    got, _ = langid.mixtures(log, sizes)
    for k, (a, b) in enumerate(zip(np.cumsum(sizes) - sizes, np.cumsum(sizes))):
        value = lambda s: np.log(np.maximum(np.exp(log[a:b]) @ s, 1e-300)).sum()  # noqa: E731,B023
        grid = [np.array(s) / 40 for s in itertools.product(range(41), repeat=3) if sum(s) == 40]
        best = max(value(s) - (np.count_nonzero(s) - 1) * 0.5 * np.log(max(2, b - a)) for s in grid)
        mine = value(got[k]) - (np.count_nonzero(got[k]) - 1) * 0.5 * np.log(max(2, b - a))
        assert mine > best - 0.1


# packing


def padding(histogram, bounds):
    return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in histogram if n)


def test_bucket_lengths_are_optimal():
    r = np.random.default_rng(1)
    for k in (1, 2, 3, 5):
        histogram = [(int(n), int(c)) for n, c in zip(r.choice(60, 9, replace=False), r.integers(1, 50, 9))]
        lengths = sorted(n for n, _ in histogram if n)
        best = min(padding(histogram, [*inner, lengths[-1]]) for m in range(k) for inner in itertools.combinations(lengths[:-1], m))
        bounds = packing.bucket_lengths(histogram, k)
        assert len(bounds) <= k and padding(histogram, bounds) == best
    assert packing.bucket_lengths([(0, 5)], 3) == [] == packing.bucket_lengths([], 3)


def test_pieces_and_batches(spark, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 7)
    texts = [None, "", "  \n", "a"] + ["w " * n for n in (1, 5, 9, 10, 11, 25, 30, 31)] * 5 + ["x " * 1000]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, "a", 1)], "doc_id long, text string, batch int")
    rows = packing.pack(docs, max_length=10, buckets=3, token_budget=40).collect()
    for i, text in enumerate(texts):
        own = sorted((r.piece, r.start, r.n_tokens) for r in rows if r.doc_id == i)
        n = len((text or "").split())
        cut = [(k, 10 * k, min(10, n - 10 * k)) for k in range(-(-n // 10))] or [(0, 0, 0)]
        assert own == sorted(cut * (2 if i == 3 else 1))
    batches = {}
    for r in rows:
        assert (r.bucket_length is None) == (r.n_tokens == 0)
        if r.n_tokens:
            assert r.n_tokens <= r.bucket_length
            batches.setdefault((r.bucket_length, r.batch), []).append(r)
    for (length, batch), members in batches.items():
        assert len(members) * length <= 40
        last = batch == max(b for n, b in batches if n == length)
        assert last or len(members) == 40 // length
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(docs.filter("doc_id < 2")).count() == 2


# WARC

BIG = "é" + "payload " * 200
PAGES = [(1, "http://a/1", BIG), (2, None, BIG), (3, "u\r\nX: y", "small"), (4, "", "small"), (5, "u", None), (7, "u", ""), (8, "u", BIG + "!"), (2, None, BIG), (None, "u", BIG), (9, "http://b", "日本" * 200_000)]


def test_round_trip(spark):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, digest string").repartition(3)
    rows = sorted(map(tuple, warc.round_trip(pages).collect()), key=str)
    expected = []
    for page_id, _, html in PAGES:
        b = (html or "").encode()
        again = html == BIG and page_id != 2
        expected.append((page_id, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", 2 if again else None))
    assert rows == sorted(expected, key=str)
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("range_bytes", [37, 1000, 1 << 20])
def test_ranges_own_each_record_once(spark, range_bytes):
    pages = spark.createDataFrame([p for p in PAGES if p[0] and p[0] < 9], "page_id long, url string, html string")
    files = warc.write_archives(pages, new_path(spark, "warc"), file_bytes=600)
    assert files.count() > 1
    rows = warc.read_archives(files, range_bytes=range_bytes).collect()
    assert len(rows) == 8 and all(r.digest_ok for r in rows)
    found = {(int(r.headers["Page-ID"]), r.payload.decode() if r.payload is not None else None) for r in rows if r.record_type == "response"}
    assert found == {(2, BIG), (3, "small"), (4, "small"), (5, ""), (7, ""), (8, BIG + "!")}
    for f in files.collect():
        data = open(f.path.removeprefix("file://"), "rb").read()
        assert len(data) == f.size and gzip.decompress(data).startswith(b"WARC/1.1\r\n")


def test_false_members_are_passed_over():
    record = warc.encode_record(1, "u", b"x", hashlib.sha1(b"x").hexdigest(), None)
    broken = record[:-6] + bytes(6)
    other = gzip.compress(b"no archive")
    data = b"\x1f\x8b\x08junk" + other + broken + record + b"\x1f\x8b"

    class File:
        def read_at(self, n, at):
            return data[at : at + n]

    found = [(at, payload) for at, _, payload in warc.range_records(warc._Bytes(File(), len(data)), 0, len(data))]
    assert found == [(len(data) - 2 - len(record), b"x")]


def test_warc_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    cursor = duck.execute(ORACLES["op10_warc"])
    names = [d[0] for d in cursor.description]
    rows = QUERIES["op10_warc"](spark, SF).select(names).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(cursor.fetchall(), key=str)


# vectors


def brute_vectors(rows, threshold=0.95):
    fine = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            fine.setdefault(i, []).append(np.array(v, dtype=np.float64) / np.linalg.norm(np.array(v, dtype=np.float64)))
    ids = [i for i in fine for _ in fine[i]]
    all_ = [v for i in fine for v in fine[i]]
    close = [[len(a) == len(b) and a @ b >= threshold for b in all_] for a in all_]
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in zip(*np.nonzero(close)):
        x, y = root(ids[a]), root(ids[b])
        parent[max(x, y)] = min(x, y)
    links = {i: max(sum(close[k]) - 1 for k, j in enumerate(ids) if j == i) for i in fine}
    return sorted(((i, links.get(i, 0), root(i) if i in fine else i) for i, _ in rows), key=str)


def cloud(seed, n=400):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, 16))
    rows = []
    for i in range(n):
        v = centres[i % 12] + r.normal(size=16) * r.choice([0.02, 0.15, 0.4])
        rows.append((i, [float(np.float32(x)) for x in v]))
    return rows


def test_vectors_against_brute_force(spark, monkeypatch):
    for name, value in (("SHARD_TARGET", 60), ("SHARD_ROWS", 50)):
        monkeypatch.setattr(vectors, name, value)
    rows = cloud(0)
    rows += [(i + 1000, rows[3][1]) for i in range(70)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 16), (2003, [1.0, None] * 8), (2004, [float("nan")] * 16), (2005, [float("inf")] * 16), (2006, [1.0, 2.0]), (2007, [2.0, 4.0]), (None, rows[3][1])]
    df = spark.createDataFrame([(*r, "s") for r in rows], "vec_id long, embedding array<float>, shard string").repartition(4)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in vectors.vector_duplicates(df).collect()), key=str)
    want = brute_vectors(rows)
    assert len(got) == len(want) and [g[0] for g in got] == [w[0] for w in want]
    assert all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.97 * sum(w[1] for w in want)
    assert np.mean([g[2] == w[2] for g, w in zip(got, want)]) > 0.97
    monkeypatch.setattr(vectors, "AUDIT_BLOCK", 3)
    audited = vectors.vector_duplicates(df, audit=50)
    assert {r.vec_id: r.n_true for r in audited.collect() if r.n_true is not None} == {w[0]: w[1] for w in want if w[0] is not None and w[0] % 50 == 0 and w[0] not in range(2000, 2006)}
    assert 0.9 <= vectors.audit_recall(audited) <= 1.0
    assert vectors.vector_duplicates(df.limit(0)).count() == 0


def clumps(seed, groups, size, inner, outer, dims=64):
    """Groups of distinct close vectors, all around one direction."""
    r = np.random.default_rng(seed)
    middle = vectors.unit(r.normal(size=(1, dims)))
    direction = lambda n: vectors.unit(r.normal(size=(n, dims)))
    near = vectors.unit(middle + outer * direction(groups))
    return vectors.unit(np.repeat(near, size, axis=0) + inner * direction(groups * size))


@pytest.mark.parametrize("shard_rows", [3000, 400])
def test_links_between_tight_groups_of_hundreds(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(vectors, "SHARD_ROWS", shard_rows)
    points = np.concatenate((clumps(0, 8, 100, 0.04, 0.19), clumps(1, 3, 200, 0.01, 0.12)))
    true = points @ points.T >= 0.95
    np.fill_diagonal(true, False)
    group = np.concatenate((np.arange(800) // 100, 8 + np.arange(600) // 200))
    assert (true & (group[:, None] != group[None, :])).sum() > true.sum() / 2
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in vectors.vector_duplicates(df).collect()}
    found, want = np.array([got[i] for i in range(len(points))]), true.sum(axis=1)
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()


def test_links_come_from_the_graph(spark, monkeypatch):
    r = np.random.default_rng(3)
    middle = vectors.unit(r.normal(size=(40, 32)))
    points = vectors.unit(np.repeat(middle, 6, axis=0) + 0.2 * vectors.unit(r.normal(size=(240, 32))))
    ids = np.arange(len(points))
    of = vectors.leaders(points, vectors._angles(0.95)[1])
    group = pa.table({"id": ids, "copies": np.ones(240, dtype=np.int64), "vector": points.tolist(), "shards": [[0]] * 240, "shard": [0] * 240, "block": [0] * 240, "two": [False] * 240})
    edges = vectors._build(0.95)(group)
    near = [[] for _ in ids]
    for x, y in zip(edges["id"].to_pylist(), edges["near"].to_pylist()):
        near[x].append(y)
    links = lambda lists: vectors._search(0.95)(group.append_column("near", pa.array(lists, pa.list_(pa.int64()))))["links"].to_numpy()
    true = (points @ points.T >= 0.95).sum(axis=1) - 1
    assert len(set(of.tolist())) > 200 and (links(near) <= true).all() and links(near).sum() >= 0.99 * true.sum()
    # without edges there are entries only: every part is one vertex
    monkeypatch.setattr(vectors, "BEAM", 1)
    assert links([[]] * 240).sum() < 0.2 * true.sum()


def test_graph_search_finds_what_is_in_range():
    r = np.random.default_rng(0)
    points = vectors.unit(np.array([v for _, v in cloud(5, 900)]))
    graph = vectors.build_graph(points)
    found = vectors.search(points, graph, vectors.medoids(points, graph), np.arange(len(points)), 0.95)
    true = points @ points.T >= 0.95
    assert not (found & ~true).any() and found.sum() >= 0.98 * true.sum()
    assert pa and r
