from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lockscope.llm import queries, simhash


def brute_edit(rows):
    """(id, text) rows with different ids -> id -> edited text."""
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: -r[0])
    out = {}
    for k, (i, t) in enumerate(ordered):
        half = len(t) // 2
        out[i] = t[: len(t) - half] + ordered[(k + 1) % len(ordered)][1][:half]
    return out


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def bits(x):
    return [int(x, 16) >> k & 1 for k in range(128)]


def texts(seed, n):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "日本", "🙂🙂"]
    return [r.choice([None, ""]) if r.random() < 0.05 else " ".join(r.choices(words, k=r.choice([1, 2, 40, 200]))) for _ in range(n)]


@pytest.mark.parametrize("bucket", [3, 7, 512])
def test_next_document_and_edit(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
    r = random.Random(bucket)
    ids = r.sample(range(-50, 10**6), 90) + [2**62, 2**62 + 1, -(2**62)]
    rows = list(zip(ids, texts(bucket, len(ids))))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, bucket string").repartition(4)
    got = {x.doc_id: x for x in simhash.fingerprint_report(df).collect()}
    want = brute_edit(rows)
    assert len(got) == len(rows) and {i: x.edited_sha256 for i, x in got.items()} == {i: sha(t) for i, t in want.items()}
    assert all(got[i].n_chars == len(t or "") for i, t in rows)
    ordered = sorted(got, reverse=True)
    for k, i in enumerate(ordered):
        x, y = got[i], got[ordered[(k + 1) % len(ordered)]]
        assert x.near_next == sum(a == b for a, b in zip(bits(x.fingerprint), bits(y.fingerprint))) / 128
        assert x.near_edited == sum(a == b for a, b in zip(bits(x.fingerprint), bits(x.edited_fingerprint))) / 128
    prints = {i: int(x.fingerprint, 16) for i, x in got.items()}
    assert {i: x.n_near for i, x in got.items()} == {i: sum((prints[i] ^ y).bit_count() <= simhash.RADIUS for y in prints.values()) - 1 for i in prints}
    again = spark.createDataFrame(list(enumerate(want.values())), "doc_id long, text string")
    direct = {x.doc_id: x.fingerprint for x in simhash.fingerprint_report(again).collect()}
    assert [direct[k] for k in range(len(want))] == [got[i].edited_fingerprint for i in want]


def test_votes_against_brute_force(spark):
    rows = [(k, t or "") for k, t in enumerate(texts(5, 40))] + [(100, "  a  b \n a b a b "), (101, "x" * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    listed = df.select("doc_id", simhash.word_list(F.col("text")).alias("words")).select("doc_id", simhash.terms(F.col("words")).alias("t")).collect()
    got = {x.doc_id: (x.high % 2**64, x.low % 2**64) for x in simhash.fingerprints(df).collect()}
    for row in listed:
        want = []
        for half in "ab":
            votes = [sum(t.w if t[half] >> j & 1 else -t.w for t in row.t) for j in range(64)]
            want.append(sum(1 << j for j, v in enumerate(votes) if v > 0))
        assert got[row.doc_id] == tuple(want)


def test_edges(spark):
    rows = [(1, None), (2, " \n"), (3, "same text"), (3, "same text"), (None, "four words are here"), (4, "same text"), (5, "z " * 20000)]
    got = simhash.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {x.doc_id: x for x in got}
    assert len(got) == len(rows) and by[1].fingerprint == by[2].fingerprint == "0" * 32
    assert by[1].n_chars == 0 and by[5].n_chars == 40000 and by[3].fingerprint == by[4].fingerprint
    assert by[4].near_next == 1.0 and by[None].edited_sha256 == sha("four words")
    assert by[1].edited_sha256 == sha("") and by[1].near_edited == 1.0
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.fingerprint_report(empty).collect() == []
    one = simhash.fingerprint_report(spark.createDataFrame([(7, "abcd efgh")], "doc_id long, text string")).first()
    assert one.near_next == 1.0 and one.edited_sha256 == sha("abcd abcd"[:5] + "abcd")


@pytest.mark.parametrize("radius", [0, 3, 6])
def test_radius_against_brute_force(spark, radius):
    r = random.Random(radius)
    prints = {r.getrandbits(128) for _ in range(150)}
    for x in list(prints)[:60]:  # neighbours at all distances, some dense
        for _ in range(r.choice([1, 1, 8])):
            for k in r.sample(range(128), r.randint(1, 9)):
                x ^= 1 << k
            prints.add(x)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    split = lambda x: (signed(x >> 64), signed(x & (1 << 64) - 1))
    df = spark.createDataFrame([split(x) for x in prints] * 2, "high long, low long")
    got = [tuple(x) for x in simhash.within_radius(df, radius).collect()]
    want = [(*min(split(a), split(b)), *max(split(a), split(b)), (a ^ b).bit_count()) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= radius]
    assert sorted(got) == sorted(want) and (want or not radius)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    df = queries.QUERIES["op12_simhash"](spark, sf)
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert df.filter("n_near > 0").count() > 0
    rows = [(d.doc_id, d.text) for d in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {x.doc_id: x for x in df.collect()}
    assert {i: x.edited_sha256 for i, x in got.items()} == {i: sha(t) for i, t in brute_edit(rows).items()}
    long_ = [x for x in got.values() if x.n_chars > 500]
    assert sum(x.near_edited > x.near_next for x in long_) > 0.9 * len(long_)
