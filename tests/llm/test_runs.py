from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from lockscope.llm import queries, runs

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            part = words[i : i + length]
            if length >= max(6, 4 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]


def brute_row(doc_id, text, plant):
    w = WORDS.findall(text or "")
    if plant:
        w = planted(doc_id, w)
    found = brute_runs(w)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if found else (None,) * 3
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    kept = " ".join(x for k, x in enumerate(w) if k not in gone)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(listed), sha(kept))


def row(r):
    return (r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def texts(seed, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        vocabulary = ["a", "b", "é", "日本", "x y"][: r.randint(1, 5)]
        w = [r.choice(vocabulary) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            unit = [r.choice(vocabulary + ["c", "d", "e"]) for _ in range(r.randint(1, 7))]
            w += unit * r.randint(1, 7) + unit[: r.randint(0, len(unit))]
        out.append(r.choice([" ", "\n", "\t "]).join(w))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_arrays_against_brute_force(seed):
    docs = [WORDS.findall(t) for t in texts(seed, 120)]
    number = {x: k for k, x in enumerate(sorted({x for d in docs for x in d}))}
    rows = np.concatenate(([0], np.cumsum([len(d) for d in docs])))
    found = runs.document_runs(np.array([number[x] for d in docs for x in d], dtype=np.int64), rows)
    assert [tuple(x) for x in found.tolist()] == [(k, *r) for k, d in enumerate(docs) for r in brute_runs(d)]


def test_regions_are_few(spark):
    codes = np.arange(1000)
    codes[500:540] = np.tile(codes[500:505], 8)
    codes[900:930] = codes[100:130]  # a far repeat is no run
    start, end = runs.regions(codes, np.array([0, 1000]))
    assert len(start) == 1 and start[0] <= 500 and end[0] >= 540 and end[0] - start[0] < 80


def test_report(spark):
    docs = [(i, t) for i, t in enumerate(texts(9, 300))]
    docs += [(500, None), (501, ""), (502, " \n"), (None, "a a a a a a a"), (503, "z " * 5000), (503, "z " * 5000), (504, "p q r " * 3000 + "p q")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    long_ = {503, 504}
    for plant in (False, True):
        got = sorted((row(r) for r in runs.run_report(df, planted=plant).collect() if r.doc_id not in long_), key=key)
        assert got == sorted((brute_row(*d, plant) for d in docs if d[0] not in long_), key=key)
    ends = {r.doc_id: (r.n_runs, r.start, r.length, r.period) for r in runs.run_report(df).collect()}
    assert ends[503] == (1, 0, 5000, 1) and ends[504] == (1, 0, 9002, 3)


def test_list_and_collapse(spark):
    rows = [(1, "u v u v u v u v w", "n"), (None, None, "n"), (2, "no  runs\there", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `start` string")
    assert [tuple(r) for r in runs.periodic_runs(df).collect()] == [(1, 0, 8, 2)]
    done = runs.collapse_runs(df)
    assert done.columns == df.columns
    assert [tuple(r) for r in done.collect()] == [(1, "u v w", "n"), (None, None, "n"), (2, "no  runs\there", None)]
    assert runs.collapse_runs(df.limit(0)).collect() == [] and runs.run_report(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(row(r) for r in queries.QUERIES["op13_periodic_runs"](spark, sf).collect())
    assert len(got) == len(docs)
    short = {d.doc_id: d.text for d in docs if len(d.text or "") < 4000}
    assert [x for x in got if x[0] in short] == sorted(brute_row(i, t, True) for i, t in short.items())
