from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from lockscope.llm.decontaminate import contamination, decontaminate, find_matches

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return LETTERS.findall(lowered)


def brute(text, items, window=10):
    words, hit, ids = split(text), set(), set()
    known = set(words)
    for item_id, item in items:
        own = split(item)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            for j in range(len(words) - size + 1) if known.issuperset(own[i : i + size]) else ():
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    ids.add(str(item_id))
    digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
    return len(words), len(hit), len(ids), digest, bool(hit)


ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven Twelve"),
    (2, "short item"),
    (10, "a a a a a a a a a a a a"),
    (3, "Ünïcode wörter ünïcode wörter"),
    (4, ""),
    (5, None),
    (6, "..."),
    (1, "One two three four five six seven eight nine ten eleven Twelve"),
]
TEXTS = [
    None,
    "",
    " , ;",
    "x ONE two-three, four five six seven eight nine ten eleven twelve y short! Item z",
    "one two three four five six seven eight nine",
    "a " * 40,
    "ünïcode wörter ünïcode wörter ünïcode wörter",
    "one two three four five six seven eight nine ten. eleven twelve " * 3,
    "item short item short",
]


def test_against_brute_force(spark):
    texts = TEXTS + TEXTS[3:4]
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id long, text string, n_hit string, matches string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = {r.doc_id: r for r in contamination(docs.repartition(3), items).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(text, ITEMS)
    kept = decontaminate(docs, items)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if not brute(t, ITEMS)[4]}


@pytest.mark.parametrize("block_bytes", [1 << 20, 16])
def test_longest_matches_and_item_blocks(spark, block_bytes):
    docs = spark.createDataFrame([(7, TEXTS[3])], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = find_matches(docs, items, block_bytes=block_bytes).select("n_hit", F.inline("matches")).collect()
    assert {tuple(r) for r in found} == {(14, "1", 0, 1, 12), (14, "2", 0, 14, 2)}


def test_real_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    tests = [tuple(r) for r in items.collect()]
    rows = {r.doc_id: r for r in contamination(docs, items).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        r = rows[doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute(text, tests)
    assert any(r.contaminated for r in rows.values())


def test_blocks_of_items_one_at_a_time(spark, monkeypatch):
    from lockscope.llm import decontaminate as module

    r = random.Random(8)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(k, " ".join(r.choices(vocabulary, k=r.choice([1, 3, 10, 14])))) for k in range(40)]
    docs = [(k, " ".join(r.choices(vocabulary, k=60)) + " " + r.choice(items)[1]) for k in range(30)] + [(30, None), (30, ""), (None, items[0][1])]
    df = spark.createDataFrame([(*d, "m") for d in docs], "doc_id long, text string, matches string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    many = module.find_matches(df, tests, block_bytes=200)
    assert many.columns == module.find_matches(df, tests).columns
    key = lambda x: repr(x)
    assert sorted(many.collect(), key=key) == sorted(module.find_matches(df, tests).collect(), key=key)


def test_ranks_past_20_bits():
    import numpy as np

    from lockscope.llm import decontaminate as module

    r = np.random.default_rng(0)
    numbers = r.integers(0, 3_000_000, 5000)
    numbers[2000:2600] = numbers[100:700]
    at = module.suffix_array(numbers, 16)
    padded = np.concatenate((numbers, np.zeros(16, dtype=np.int64)))
    text = [tuple(padded[k : k + 16]) for k in at]
    assert text == sorted(text) and sorted(at.tolist()) == np.flatnonzero(numbers).tolist()


def test_empty_tables_and_small_shards(spark, monkeypatch):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert contamination(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert contamination(some, items).first().contaminated is False


def test_long_text_in_many_pieces():
    import numpy as np

    from lockscope.llm import decontaminate as module

    tests = module.TestSuffixes([("1", " ".join(f"w{i}" for i in range(12)))], 10)
    numbers = np.zeros(300, dtype=np.int64)
    for at in (0, 5 * 13, 95, 250):
        numbers[at : at + 12] = [int(n) for n in tests.number(module.words(*module.text_bytes(module.pa.array([" ".join(f"w{i}" for i in range(12))])), module.WORD_LETTERS, True)[0])]
    whole = sorted(zip(*[x.tolist() for x in module.shard_hits(numbers, tests)]))
    size = module.SHARD_WORDS
    try:
        module.SHARD_WORDS = 64
        assert sorted(zip(*[x.tolist() for x in module.shard_hits(numbers, tests)])) == whole
    finally:
        module.SHARD_WORDS = size
