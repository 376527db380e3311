from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lockscope.llm import passages, substring, suffixes

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(docs, window):
    """docs: (id, text) rows -> rows of (id, n_words, n_removed, digest)."""
    starts = {}
    for i, text in docs:
        w = WORDS.findall(text or "")
        for k in range(len(w) - window + 1):
            x = tuple(w[k : k + window])
            starts[x] = min(starts.get(x, i), i)
    out = []
    for i, text in docs:
        w, gone = WORDS.findall(text or ""), set()
        for k in range(len(w) - window + 1):
            if starts[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def brute_bytes(docs, window):
    count = {}
    for _, text in docs:
        b = (text or "").encode()
        for k in range(len(b) - window + 1):
            count[b[k : k + window]] = count.get(b[k : k + window], 0) + 1
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, dtype=bool)
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = True
        runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed, n=60):
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "日本", "ß!"]
    passages_ = [[r.choice(vocabulary) for _ in range(r.randint(20, 60))] for _ in range(6)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts += r.choice(passages_) if r.random() < 0.5 else [r.choice(vocabulary) for _ in range(r.randint(1, 40))]
            if parts and r.random() < 0.3:
                parts[r.randrange(len(parts))] = "changed"
        docs.append((i, r.choice([" ", "\n", "  "]).join(parts)))
    docs += [(n, None), (n + 1, ""), (n + 2, "a " * 300), (n + 3, "x" * 500), (n + 4, docs[3][1]), (n + 5, docs[3][1]), (n + 5, docs[3][1])]
    return docs


@pytest.mark.parametrize("hot", [2000, 2])
def test_words_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    docs = corpus(5)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, owner string").repartition(5)
    keyed = substring._keyed(df)
    ready = passages.with_ranges(keyed, substring.repeated_ranges(keyed, 10, 4)).select("doc_id", "text", "ranges", "whole")
    rows = ready.mapInArrow(substring._apply(10, True), "doc_id long, n_words long, n_removed long, kept_sha256 string").collect()
    assert sorted(map(tuple, rows)) == brute_words(docs, 10)


@pytest.mark.parametrize("hot", [2000, 2])
def test_bytes_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(passages, "HOT", hot)
    docs = corpus(6)
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, owner string").repartition(5)
    keyed = suffixes._keyed(df)
    ready = passages.with_ranges(keyed, suffixes.repeated_ranges(keyed, 40, 12)).select("doc_id", "text", "ranges", "whole")
    rows = ready.mapInArrow(suffixes._apply(True), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string").collect()
    assert sorted(map(tuple, rows)) == brute_bytes(docs, 40)


def test_real_tables(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    rows = sorted(map(tuple, substring.substring_report(df).collect()))
    assert rows == brute_words(docs, 50) and sum(r[2] for r in rows)
    rows = sorted(map(tuple, suffixes.suffix_report(df).collect()))
    assert rows == brute_bytes(docs, 400) and sum(r[2] for r in rows)


def test_dedup_keeps_columns_and_defined_results(spark):
    long = " ".join(f"t{k}" for k in range(200))
    rows = [(1, long, "a"), (2, f"start {long} end", "b"), (None, long, "c"), (3, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ranges string")
    done = {r.ranges: r.text for r in substring.substring_dedup(df).collect()}
    assert done == {"a": long, "b": "start end", "c": long, "d": None}
    done = {r.ranges: r.text for r in suffixes.suffix_dedup(df).collect()}
    assert done == {"a": "", "b": "start  end", "c": "", "d": None}
    empty = df.limit(0)
    assert substring.substring_report(empty).count() == suffixes.suffix_report(empty).count() == 0


def test_shard_indexes_against_brute_force():
    r = random.Random(1)
    for _ in range(60):
        window = r.choice([3, 5])
        base = [r.choice("abcde") for _ in range(20)]
        pool = [base[s : s + window + r.randint(0, 9)] for s in range(15)] + [[r.choice("abcde") for _ in range(window + r.randint(0, 9))] for _ in range(5)]
        segments = [list(x) for x in {tuple(x) for x in r.sample(pool, 8) if len(x) >= window}]
        owners = np.array([r.randint(0, 5) for _ in segments])
        n, ones = np.array([len(x) - window + 1 for x in segments]), np.ones(len(segments), dtype=np.int64)
        at = [(i, k, x[k : k + window]) for i, x in enumerate(segments) for k in range(len(x) - window + 1)]
        said = lambda found: {(int(i), k) for i, a, b in zip(*found) for k in range(a, b + 1)}
        found = substring.matching_windows(window)(pa.array([" ".join(x).encode() for x in segments], pa.binary()), n, owners, ones)
        assert said(found) == {(i, k) for i, k, x in at if any(x == y and owners[j] < owners[i] for j, _, y in at)}
        found = suffixes.repeated_windows(window)(pa.array(["".join(x).encode() for x in segments], pa.binary()), n, owners, ones)
        assert said(found) == {(i, k) for i, k, x in at if sum(x == y for _, _, y in at) > 1}
        text = np.frombuffer(b"\0".join("".join(x).encode() for x in segments) + b"\0", dtype=np.uint8)
        assert suffixes.suffix_array(text.astype(np.int64), 1000).tolist() == sorted(range(len(text)), key=lambda i: text.tobytes()[i:])


def test_segments_do_not_depend_on_the_cut(monkeypatch):
    r = np.random.default_rng(0)
    prints = r.integers(0, 4, 400).astype(np.uint64) + np.uint64(1)
    unit, rows = passages.Unit("bytes", 20, 6), np.array([0, 300, 310, 400])
    def windows():
        row, start, n, anchor, _ = passages.segments(prints, rows, unit)
        return {(a, b + k): c for a, b, m, c in zip(row.tolist(), start.tolist(), n.tolist(), anchor.tolist()) for k in range(m)}
    whole = windows()
    assert set(whole) == {(0, k) for k in range(281)} | {(2, k) for k in range(71)}
    monkeypatch.setattr(passages, "PIECE", 64)
    assert windows() == whole


@pytest.mark.parametrize("kind, window, gram", [("words", 50, 10), ("bytes", 400, 100)])
def test_short_runs_of_rows(kind, window, gram):
    unit = passages.Unit(kind, window, gram)
    for total in range(window + 3):
        prints = np.arange(1, total + 1, dtype=np.uint64)
        for cut in {0, 1, total // 2, total} & set(range(total + 1)):
            row, start, n, _, _ = passages.segments(prints, np.array([0, cut, total]), unit)
            got = {(i, a + k) for i, a, m in zip(row.tolist(), start.tolist(), n.tolist()) for k in range(m)}
            assert got == {(i, k) for i, m in enumerate([cut, total - cut]) for k in range(m - window + 1)}


@pytest.mark.parametrize("seed", range(4))
def test_common_prefixes_of_neighbours(seed):
    r = np.random.default_rng(seed)
    parts = [r.integers(1, 4, r.integers(1, 60)) for _ in range(20)]
    parts += [np.tile(parts[k][:7], 9) for k in range(3)] + parts[:6] + [np.concatenate(parts[2:5])]
    text = np.concatenate([np.append(p, 0) for p in parts])
    for order in (suffixes.suffix_array(text, 400), r.permutation(len(text))):
        got = suffixes.common_prefixes(text, order)
        for a, b in zip(order[1:].tolist(), order[:-1].tolist()):
            n = 0
            while text[a + n] and text[a + n] == text[b + n]:
                n += 1
            assert got[a] == n
        assert got[order[0]] == 0
