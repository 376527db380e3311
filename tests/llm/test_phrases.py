from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from lockscope.llm import phrases


def brute(docs, least, top):
    count, total = Counter(), Counter()
    for _, lang, text in docs:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                for i in range(len(w) - m + 1):
                    count[lang, tuple(w[i : i + m])] += 1
    found = {x: a for x, a in count.items() if a >= least and len(x[1]) > 1}
    out = []
    for lang in sorted(total):
        rows = []
        for (g, p), a in found.items():
            if g != lang:
                continue
            inside = any(100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for (h, q), b in found.items() if h == g and len(q) > len(p))
            if inside:
                continue
            cuts = [(2_000_000 * a // (count[g, p[:k]] + count[g, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), count[g, p[:k]], count[g, p[k:]]))
        out += [(lang, n + 1, p.decode(), -a, left, right, total[lang], -s) for n, (s, a, p, left, right) in enumerate(sorted(rows)[:top])]
    return out


def corpus(seed):
    r = random.Random(seed)
    vocabulary = ["The", "the", "cat", "sat", "on", "MAT", "é", "É", "日本", "x\x01y", "dog"]
    fixed = [["new", "york", "city"], ["a", "b", "c", "d", "e"], ["of", "the"]]
    docs = []
    for i in range(150):
        w = []
        for _ in range(r.randint(0, 40)):
            w += r.choice(fixed) if r.random() < 0.4 else [r.choice(vocabulary)]
        text = "".join(x + r.choice([" ", " ", " ", "\t", ". ", "\n", " ,", "  "]) for x in w)
        docs.append((i, r.choice(["en", "en", "de", None, "und", ""]), text))
    return docs + [(900, "fr", None), (901, "fr", ""), (902, "fr", " .\n"), (None, "en", "new york city"), (903, "zz", "once only")]


@pytest.mark.parametrize("seed,top,block", [(1, 2000, 1 << 18), (2, 5, 1 << 18), (3, 2000, 9)])
def test_against_brute_force(spark, monkeypatch, seed, top, block):
    monkeypatch.setattr(phrases, "SLICE_BYTES", 300)
    docs = corpus(seed)
    df = spark.createDataFrame([(*d, "n") for d in docs], "doc_id long, lang string, text string, phrase string").repartition(3)
    monkeypatch.setattr(phrases, "phrase_counts", lambda d, least, f=phrases.phrase_counts: f(d, least, block))
    got = [tuple(r) for r in phrases.collocations(df, top, 6).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert sorted(got) == brute(docs, 6, top)


@pytest.mark.parametrize("at_once,passes", [(1 << 22, 1), (18, None)])
def test_blocks_share_a_pass(spark, monkeypatch, at_once, passes):
    monkeypatch.setattr(phrases, "AT_ONCE", at_once)
    names = []
    monkeypatch.setattr(phrases, "stored", lambda df, name, f=phrases.stored: (names.append(name), f(df, name))[1])
    docs = corpus(6)
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(3)
    monkeypatch.setattr(phrases, "phrase_counts", lambda d, least, f=phrases.phrase_counts: f(d, least, 9))
    got = [tuple(r) for r in phrases.collocations(df, 2000, 6).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert sorted(got) == brute(docs, 6, 2000)
    n = names.count("phrase-counts")
    assert n == passes if passes else n > 1


def test_keys_are_summed_over_drains(spark, monkeypatch):
    monkeypatch.setattr(phrases, "HELD", 64)
    monkeypatch.setattr(phrases, "SLICE_BYTES", 300)
    docs = corpus(7)
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string").repartition(3)
    got = [tuple(r) for r in phrases.collocations(df, 2000, 6).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert sorted(got) == brute(docs, 6, 2000)


def test_collisions_only_add_candidates(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 64)
    docs = corpus(4)
    df = spark.createDataFrame(docs, "doc_id long, lang string, text string")
    got = [tuple(r) for r in phrases.collocations(df, 2000, 6).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()]
    assert sorted(got) == brute(docs, 6, 2000)


def test_scores_past_64_bits(spark):
    rows = [("en", "a b", 9 * 10**17), ("en", "a", 10**18), ("en", "b", 9 * 10**17 + 7)]
    got = phrases._scored(spark.createDataFrame(rows, "lang string, phrase string, a long")).first()
    assert got.score == 2_000_000 * rows[0][2] // (rows[1][2] + rows[2][2])


def test_trie():
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)]
    entries = sorted({(r.choice("de"), " ".join(r.choices(vocabulary, k=r.randint(1, 4)))) for _ in range(4000)})
    trie = phrases.Trie(*(pa.array([e[k] for e in entries], pa.large_string()) for k in range(2)))
    assert len(trie.check) < 40 * len(entries)
    number = {w: k for k, w in enumerate(trie.words.to_pylist())}
    root = dict(zip(trie.roots.to_pylist(), trie.roots_at.tolist()))

    def find(lang, phrase):
        state = np.array([root[lang]])
        for w in phrase.split():
            _, state = trie.advance(state, np.array([number.get(w, -1)]))
            if not len(state):
                return -1
        return trie.accept[state[0]]

    assert [find(*e) for e in entries] == list(range(len(entries)))
    known = set(entries)
    for _ in range(2000):
        e = (r.choice("de"), " ".join(r.choices(vocabulary, k=r.randint(1, 4))))
        assert (find(*e) >= 0) == (e in known)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert phrases.collocations(df).collect() == []
