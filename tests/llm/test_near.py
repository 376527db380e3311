from __future__ import annotations

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lockscope.llm import graph, lines, minhash
from lockscope.llm.common import stored

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def smallest(ids, links):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def similar(sets, percent=80):
    having = {}
    for i, s in enumerate(sets):
        for x in s:
            having.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in having[x] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                yield i, j


def shingles(text, size):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


def brute_documents(docs, size):
    sets = [shingles(t, size) for _, t in docs]
    ids = [i for i, _ in docs]
    found = smallest(ids, [(ids[a], ids[b]) for a, b in similar(sets)])
    return sorted((i, len(s), found[i], found[i] == i) for i, s in zip(ids, sets))


def near_copies(seed):
    """A base with many copies of which some are far from each other, exact copies, and others."""
    r = random.Random(seed)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    docs = []
    for i in range(150):
        text = list(base)
        for _ in range(r.choice([0, 1, 3, 6, 9, 12])):
            text[r.randrange(len(text))] = f"x{r.randrange(9999)}"
        docs.append(" ".join(text))
    docs += docs[5:9] + [docs[5].upper() + " "]
    docs += [" ".join(f"y{r.randrange(5000)}" for _ in range(r.randint(1, 60))) for _ in range(60)]
    docs += [None, "", " \t\n", "one", "One", "one two", "a b " * 3000]
    r.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("size", [2, 5])
def test_documents_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(graph, "X_ELEMENTS", 2000)
    monkeypatch.setattr(graph, "Y_ELEMENTS", 5000)
    docs = near_copies(size)
    df = spark.createDataFrame([(*d, "k") for d in docs], "doc_id long, text string, id string").repartition(6)
    assert sorted(map(tuple, minhash.near_duplicates(df, size).collect())) == brute_documents(docs, size)
    kept = minhash.near_dedup(df, size)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, _, k in brute_documents(docs, size) if k]


def test_documents_with_null_and_repeated_ids(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(None, text), (4, text), (4, text), (9, text + " more"), (4, "quite another text")]
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [(0, 0, True), (4, 4, True), (4, 4, True), (4, 4, True), (9, 4, False)]
    assert minhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_registers_agree_as_often_as_sets_overlap():
    r = np.random.default_rng(0)
    for common in (0.2, 0.5, 0.8):
        agree = []
        for _ in range(60):
            x = r.integers(0, 2**63, 300).astype(np.uint64)
            n = int(300 * common)
            a, b = np.unique(x[: 150 + n // 2]), np.unique(x[150 - n // 2 :])
            got = minhash.sketches([a, b])
            agree.append((got[0] == got[1]).mean())
        assert abs(np.mean(agree) - common) < 0.02


def test_registers_of_a_union_are_maxima_and_bands_have_recall():
    r = np.random.default_rng(1)
    x = np.unique(r.integers(0, 2**63, 900).astype(np.uint64))
    a, b, both = minhash.sketches([x[:600], x[300:], x])
    assert (np.maximum(a, b) == both).all()
    pairs = []
    for _ in range(400):
        x = r.integers(0, 2**63, 100).astype(np.uint64)
        pairs += [np.unique(x[:90]), np.unique(x[10:])]  # similarity 0.8
    registers = minhash.sketches(pairs)
    keys = minhash.band_keys(registers)
    assert all(len(np.intersect1d(keys[k], keys[k + 1])) for k in range(0, len(keys), 2))
    a, b = registers[::2], registers[1::2]
    n = np.full(len(a), 90.0)
    gap = minhash.likelihood_gap(n, n, (a > b).sum(axis=1), (a < b).sum(axis=1), 0.8)
    assert gap.max() < minhash.DISMISS
    other = np.roll(b, 1, axis=0)
    assert minhash.likelihood_gap(n, n, (a > other).sum(axis=1), (a < other).sum(axis=1), 0.8).min() > minhash.DISMISS


def test_components_against_brute_force(spark):
    r = random.Random(3)
    edges = [(r.randrange(400), r.randrange(400)) for _ in range(230)] + [(1000 + k, 1001 + k) for k in range(60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    expected = smallest({x for a, b in edges if a != b for x in (a, b)}, [e for e in edges if e[0] != e[1]])
    assert {r.id: r.component for r in graph.components(df).collect()} == expected
    assert graph.components(df.limit(0)).count() == 0


def test_links_of_repeated_ids_come_once():
    keys, ids = np.array([7, 7, 7, 9, 7, 9], dtype=np.uint64), np.array([3, 5, 5, 1, 3, 2])
    key, a, b = graph._by_key(keys, ids)[2:]
    assert sorted(zip(key.tolist(), a.tolist(), b.tolist())) == [(7, 3, 5), (9, 1, 2)]
    assert all(len(x) == 0 for x in graph._by_key(keys[:0], ids[:0]))


def test_key_stars_connect_all_ids_of_a_key(spark):
    rows = [(i, [7, 100 + i % 5, 1000 + i]) for i in range(300)] + [(1, [7])]
    df = spark.createDataFrame(rows, "id long, keys array<long>").repartition(7)
    found = graph.key_stars(df).collect()
    assert all(r.a < r.b for r in found)
    for key, ids in [(7, range(300))] + [(100 + k, range(k, 300, 5)) for k in range(5)]:
        links = [(r.a, r.b) for r in found if r.key == key]
        assert set(smallest(ids, links).values()) == {min(ids)}
    assert {r.key for r in found} == {7, *range(100, 105)}


def brute_lines(docs, size=lines.SHINGLE):
    place, number = [], {}
    for i, text in sorted(docs):
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" \t\n\v\f\r"):
                place.append((i, k, number.setdefault(line, len(number))))
    sets = [{x[k : k + size] for k in range(len(x) - size + 1)} if len(x) >= size else {x} for x in number]
    found, seen, gone = smallest(range(len(sets)), similar(sets)), set(), {}
    for i, k, n in place:
        if found[n] in seen:
            gone.setdefault(i, set()).add(k)
        seen.add(found[n])
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(i, ())) for i, t in docs}


def test_lines_against_brute_force(spark):
    r = random.Random(2)
    pool = ["".join(r.choice("abcdefg hijklm") for _ in range(r.randint(60, 200))) for _ in range(12)] + ["x", "xy", "é日本語テキスト", "-----"]
    docs = []
    for i in range(60):
        text = []
        for _ in range(r.randint(0, 8)):
            line = r.choice(pool) if r.random() < 0.7 else "".join(r.choice("qrstuvwxyz ") for _ in range(90))
            if r.random() < 0.4 and len(line) > 50:
                at = r.randrange(len(line))
                line = line[:at] + "#" + line[at + 1 :]
            text.append(line)
        docs.append((i, "\n".join(text)))
    docs += [(60, None), (61, ""), (62, "\n \n\t\n"), (63, "z" * 30000)]
    df = spark.createDataFrame([(*d, "g") for d in docs], "doc_id long, text string, gone string").repartition(5)
    done = lines.line_dedup(df)
    assert done.columns == df.columns
    assert {r.doc_id: r.text for r in done.collect()} == brute_lines(docs)
    report = {r.doc_id: r for r in lines.line_report(df).collect()}
    assert (report[62].n_lines, report[63].n_lines, report[60].n_lines) == (0, 1, 0)
    twice = df.union(df.filter("doc_id = 3"))
    assert sorted(r.text for r in lines.line_dedup(twice).filter("doc_id = 3").collect()) == [brute_lines(docs)[3]] * 2
    assert lines.line_dedup(df.limit(0)).count() == 0


def test_real_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert sorted(map(tuple, minhash.near_duplicates(df, 2).collect())) == brute_documents(docs, 2)
    assert {r.doc_id: r.text for r in lines.line_dedup(df).collect()} == brute_lines(docs)


def test_stored_tables_lie_in_the_shared_folder(spark):
    df = stored(spark.range(3).withColumn("x", F.lit("a")), "some")
    assert df.count() == 3 and spark.conf.get("spark.checkpoint.dir").removeprefix("file://") in df.inputFiles()[0]


def test_a_block_is_searched_once_however_many_rows(monkeypatch):
    rng = random.Random(8)
    n = 60
    sets = [np.array(sorted(rng.sample(range(24), rng.randint(0, 20))), dtype=np.uint64) for _ in range(n)]
    ids, placed = np.array(rng.sample(range(1000), n)), np.array([rng.randrange(5) for _ in range(n)])
    is_x = np.array([rng.random() < 0.5 for _ in range(n)])
    plain = {}
    for x in np.flatnonzero(is_x):
        for y in np.flatnonzero(~is_x):
            a, b = set(sets[x].tolist()), set(sets[y].tolist())
            if a & b and 10 * len(a & b) >= 5 * len(a | b) and placed[x] != placed[y]:
                key = (int(ids[x]), int(placed[y]))
                plain[key] = min(plain.get(key, 1000), int(ids[y]))
    assert plain
    searches, search = [], np.searchsorted
    monkeypatch.setattr(graph.np, "searchsorted", lambda *a, **k: searches.append(1) or search(*a, **k))
    found = graph._links_of_block(ids, placed, is_x, sets, 50)
    assert sorted(found) == sorted((x, y) for (x, _), y in plain.items())
    assert len(searches) < 10
    monkeypatch.setattr(graph, "CELLS", 50)
    assert sorted(graph._links_of_block(ids, placed, is_x, sets, 50)) == sorted(found)


def test_lines_of_a_large_batch_are_signed_in_small_arrays():
    text = "\n".join(f"line {i} of a text that is long enough" for i in range(20))
    batch = pa.RecordBatch.from_pydict({"text": [f"{k} {text}" for k in range(2000)]})
    lines.Lines([text])  # makes the tables that are made once
    tracemalloc.start()
    found = list(lines._signed_lines(lines.SHINGLE)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len({x for b in found for x in b.column(0).to_pylist()}) == 19 + 2000
    assert peak < 48 << 20


def test_keys_are_shuffled_in_buckets(spark):
    r = np.random.default_rng(3)
    df = spark.createDataFrame([(i, [int(k) for k in r.integers(-(2**63), 2**63 - 1, 12)] + [5]) for i in range(2000)], "id long, keys array<long>").coalesce(1)
    local = df.mapInArrow(graph._local_stars(16), "bucket int, keys binary, ids binary, linked binary").collect()
    assert len(local) <= 16 + 1  # a row for each bucket, one for the links; not one for each of 26,000 keys
    assert sum(len(x.keys) // 8 for x in local if x.linked is None) == 24_000 + 1
    assert {(x.key, x.a) for x in graph.key_stars(df).collect()} == {(5, 0)}


def test_marks_dismiss_no_similar_pair_and_most_others():
    r = random.Random(5)
    said = ["", "abc", "abcdef", "abcdefg", "z" * 3000] + ["".join(r.choice("abc def") for _ in range(r.randint(1, 400))) for _ in range(40)]
    for line in said[5:]:
        for edits in (1, 3, 8, 20):
            at = [r.randrange(len(line)) for _ in range(edits)]
            said.append("".join("#" if k in at else c for k, c in enumerate(line)))
    sets = [{x[k : k + 6] for k in range(len(x) - 5)} if len(x) >= 6 else {x} for x in said]
    x, y = (v.astype(np.int64) for v in np.triu_indices(len(said), 1))
    plain = np.array([100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in zip(x, y)])
    found = lines.Compared(said, 6, 80)
    assert (found.links(x, y) == plain).all() and plain.sum() > 30
    common, union = found.most(x, y)
    may = 100 * common >= 80 * union
    assert may[plain].all() and may.sum() < 4 * plain.sum()
    group = x * 3 + y % 3
    some = found.links(x, y, group)
    assert not (some & ~plain).any() and set(group[some]) == set(group[plain])


def test_small_blocks_at_once_link_what_single_ones_do(monkeypatch):
    r = random.Random(6)
    pool = ["".join(r.choice("abc def") for _ in range(120)) for _ in range(8)]
    said = [x[:k] + "#" + x[k + 1 :] for x in pool for k in (5, 40, 90, 119)]
    rows = [(m, 0, 0, i, r.randrange(4), side, said[i]) for m in range(6) for i in range(len(said)) for side in (True, False) if r.random() < 0.6]
    table = pa.table(list(zip(*rows)), names=["main", "x_block", "y_block", "id", "c", "is_x", "body"])
    batches = table.to_batches(max_chunksize=37)
    read = lambda bodies: lines.shingle_sets(bodies.to_pylist(), 6)
    alike = lambda bodies, x, y, group: lines.Compared(bodies.to_pylist(), 6, 80).links(x, y, group)

    def linked(alike):
        found = [p for b in graph._block_links(read, 80, alike)(iter(batches)) for p in zip(*(b.column(k).to_pylist() for k in (0, 1)))]
        return {(a, b // 4) for a, b in found}

    assert linked(None) == linked(alike) and len(linked(None)) > 20
    monkeypatch.setattr(graph, "PAIRS", 150)  # some blocks of a run are small, others not
    assert linked(alike) == linked(None)


def test_only_texts_of_proposed_lines_are_stored():
    text = [f"line {i} of a text" for i in range(50)] + ["line 3 of a text", " "]
    batch = pa.RecordBatch.from_pydict({"doc_id": [7], "text_key": [1], "text": ["\n".join(text)]})
    seen = np.zeros(1 << 21, dtype=np.uint64)
    key = lines.Lines(["line 3 of a text"]).prints
    seen[((key >> np.uint64(6)) & np.uint64(len(seen) - 1)).astype(np.int64)] |= np.uint64(1) << (key & np.uint64(63))
    (out,) = lines._placed(seen)(iter([batch]))
    assert out.column(2).to_pylist() == list(range(51))
    assert [x for x in out.column(4).to_pylist() if x is not None] == ["line 3 of a text"]
