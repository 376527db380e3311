from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lockscope.llm.pii import KINDS, Model, examples, find_spans, fit, personal_data, redact

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = [(m.start(), KINDS.index(k), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(k, m[0])]
    spans.sort()
    said = ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)
    return *[sum(s[3] == k for s in spans) for k in KINDS], hashlib.sha256(said.encode()).hexdigest(), said


TEXTS = [
    None,
    "",
    "a@b.c_d@e.f x@y z.@-.- a.b+c@d-e.f.g. 😀é me@home.org",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 000255.0.0.1 00.0.0.1000 1.2.3 99999999999999999999.1.1.1",
    "4111 1111 1111 1111, 4111-1111-1111-1112 5500000000000004 3782 822463 10005 0000000000000000000 12",
    "+1 (555) 010-9999 +49.89.1234567 +12 +1--2 +123456789012345 +1234567890123456 +1 (2",
    "1 " * 3000 + "a@b.cd",
    "a" * 30000 + "." * 3000 + " 1.1.1.1" * 700,
    "9" * 9000 + "a@" + "b." * 4000 + "c",
]


def check(rows, texts):
    for i, text in enumerate(texts):
        r = rows[i]
        *counts, digest, said = brute(text)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256] == [*counts, digest]
        assert set(said.split(",")) <= set(r.spans.split(","))


def test_base_spans(spark):
    texts = TEXTS + TEXTS[2:3]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, base string")
    check({r.doc_id: r for r in personal_data(docs).collect()}, texts)
    assert personal_data(docs.limit(0)).count() == 0


def test_real_tables_are_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    df = personal_data(docs)
    rows = {r.doc_id: r for r in df.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    check(rows, [texts[i] for i in range(len(texts))])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Exchange|MapIn", plan)


def test_trees_find_what_strict_patterns_miss(spark):
    strict = [f"tel +1 (555) 0{i:02d}-12{i:02d} thanks" for i in range(99)]
    noise = [f"order {i}-{i + 10}-{i + 20}0 shipped" for i in range(99)]
    missed = ["phone (555) 010-1234 now"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(strict + noise + missed)], "doc_id long, text string")
    model = fit(docs)
    assert model.trees and set(model.thresholds) == {"phone"}
    rows = {r.doc_id: r.spans for r in find_spans(docs, model).collect()}
    assert [(s.start, s.kind) for s in rows[198]] == [(6, "phone")]
    assert all(not rows[i] for i in range(99, 198))


def test_trees_add_the_loose_forms_of_what_strict_patterns_find(spark):
    docs = []
    for i in range(120):
        docs += [f"call +1 (555) 0{i % 90 + 10}-1{i:03d} today", f"mail a{i}@host{i}.org now", f"server ip 10.{i}.3.{i}", f"part {i}-{i + 10}-{i + 20}0 in stock", f"look at page{i}.org and {i}:0:0:0:0:0:0:1"]
    loose = ["phone (555) 010-1234 now", "mail bob at home dot com today", "ip fe80:0:0:0:1:2:3:4"]
    docs += loose + ["phone 12-34-5 now"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    model = fit(df)
    said = {r.doc_id: r for r in find_spans(df, model).collect()}
    assert [[s.kind for s in said[600 + k].spans] for k in range(4)] == [["phone"], ["email"], ["ip"], []]
    assert all(list(said[i].spans) == list(said[i].base) for i in range(600) if i % 5 >= 3)


def test_trees_learn_from_every_document(spark):
    """30,000 documents; all phones stand where a sample of 20,000 by the hash of the text does not look."""
    name = F.col("id").cast("string")
    left_out = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) >= 670_000
    phones = spark.range(900).select(F.concat(F.lit("call +1 (555) 010-"), F.lpad(name, 4, "0")).alias("text")).filter(left_out)
    noise = spark.range(300).select(F.concat(F.lit("order 1-22-"), F.lpad(name, 3, "0"), F.lit(" shipped")).alias("text"))
    docs = phones.union(noise).union(spark.range(30_000).select(F.concat(F.lit("text no "), F.md5(name)).alias("text")))
    # equal examples are counted, none is left out
    found = examples(noise.union(noise))
    assert found.agg(F.sum("weight")).first()[0] == 600 and found.count() <= 2
    model = fit(docs)
    assert model.trees and "phone" in model.thresholds


def test_redact(spark):
    docs = spark.createDataFrame([(1, "é a@b.cd, 1.2.3.4!"), (2, None)], "doc_id long, text string")
    assert [tuple(r) for r in redact(docs, Model([], {})).orderBy("doc_id").collect()] == [(1, "é [email], [ip]!"), (2, None)]
