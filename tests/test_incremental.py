from __future__ import annotations

import functools
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lockscope.functions.precedence import version_key
from lockscope.operators import changes, dedup, intervals, matching, reach

START = datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seconds", [7, 60, 10**6])
def test_requests_of_runs(spark, seconds):
    r = random.Random(seconds)
    at = lambda: START + timedelta(seconds=r.randint(0, 400))
    keys = ["a", "b", None]
    runs = [(r.choice(keys), k, s, s + timedelta(seconds=r.randint(1, 90)) if r.random() < 0.8 else None) for k in range(40) for s in [at()]]
    requests = [(k, r.choice(keys), at() if r.random() < 0.95 else None, 200) for k in range(300)]

    def expected(root, ts):
        before = [x for x in runs if x[0] == root and ts is not None and x[2] <= ts]
        if not before:
            return None
        _, run, _, end = max(before, key=lambda x: (x[2], x[3] is not None, x[3] or START, x[1]))
        return run if end is None or ts < end else None

    kind = "timestamp_ntz" if seconds == 60 else "timestamp"
    asked = spark.createDataFrame(requests, f"id int, root string, ts {kind}, status int")
    known = spark.createDataFrame(runs, f"root string, run_id int, started {kind}, finished {kind}")
    got = intervals.requests_of_runs(asked, known, ["root"], seconds)
    assert got.columns == ["id", "root", "ts", "status", "run_id"]
    assert {x.id: x.run_id for x in got.collect()} == {i: expected(root, ts) for i, root, ts, _ in requests}
    per_run = {x.run_id: x.requests for x in intervals.run_requests(asked, known, keys=["root"], seconds=seconds).collect()}
    want = {k: 0 for k in range(40)}
    for _, root, ts, _ in requests:
        if (run := expected(root, ts)) is not None:
            want[run] += 1
    assert per_run == want


def test_busy_root_is_spread(spark):
    asked = spark.range(20000).select(F.lit("busy").alias("root"), F.timestamp_seconds(F.col("id") * 30).alias("ts"), F.lit(200).alias("status"))
    known = spark.range(300).select(
        F.lit("busy").alias("root"), F.col("id").alias("run_id"), F.timestamp_seconds(F.col("id") * 2000).alias("started"), F.lit(None).cast("timestamp").alias("finished")
    )
    got = intervals.requests_of_runs(asked, known, ["root"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counts = [x["count"] for x in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(counts) == 20000 and max(counts) < 0.3 * 20000
    assert got.filter(F.col("run_id") != F.least(F.floor(F.unix_seconds("ts") / 2000), F.lit(299))).count() == 0
    assert "CartesianProduct" not in got._jdf.queryExecution().toString() and "NestedLoop" not in got._jdf.queryExecution().toString()


def test_merged_states_equal_a_rebuild(spark):
    r = random.Random(1)
    text = lambda *xs: r.choice([None, "", *xs])
    data = [(k, f"a{r.randint(0, 20)}", text("git", "registry"), text("n1", "n2"), text("1", "2"), text("u1", "u2", "u3"), text("s"), text("i1", "i2")) for k in range(400)]
    df = spark.createDataFrame(data, "ord int, artifact_id string, type string, name string, version string, resolved_url string, source string, integrity string")
    whole = rows(dedup.global_artifacts(df))
    one, two = (dedup.artifact_state(df.filter(F.col("ord") % 2 == k)) for k in (0, 1))
    for states in ((one, two), (two, one), (one, two, two.limit(0))):
        merged = dedup.merge_artifact_states(*states)
        assert rows(dedup.artifacts_of_state(merged).select(*dedup.global_artifacts(df).columns)) == whole
    assert rows(dedup.artifacts_of_state(dedup.artifact_state(df.limit(0)))) == []


def test_run_difference(spark, tmp_path):
    r = random.Random(2)
    value = lambda: r.choice([None, "", "x", "y"])
    old = {k: (value(), r.choice([None, 1, 2])) for k in [*range(200), None]}
    new = {k: (v if r.random() < 0.7 else (value(), v[1])) for k, v in old.items() if r.random() < 0.9}
    new.update({k: (value(), 7) for k in range(200, 230)})
    schema = "key int, a string, b int"
    frames = [spark.createDataFrame([(k, *v) for k, v in x.items()], schema) for x in (old, new)]
    want = {}
    for k in {*old, *new}:
        was, now = old.get(k, (None, None)), new.get(k, (None, None))
        fields = {n: (None if x is None else str(x), None if y is None else str(y)) for n, x, y in zip("ab", was, now) if x != y}
        if k not in new or k not in old or fields:
            want[k] = ("added" if k not in old else "removed" if k not in new else "changed", fields)
    for prints in (False, True):
        kept = [changes.bucket_prints(f, ["key"], ["a", "b"], 16) for f in frames] if prints else [None, None]
        got = changes.run_difference(*frames, ["key"], ["a", "b"], *kept, buckets=16)
        assert {x.key: (x.change, {n: tuple(v) for n, v in x.fields.items()}) for x in got.collect()} == want
    assert changes.run_difference(frames[0], frames[0], ["key"], ["a", "b"]).collect() == []


def test_equal_buckets_leave_before_the_join(spark):
    old = spark.range(5000).select(F.col("id").alias("key"), F.lit("v").alias("a"))
    new = old.withColumn("a", F.when(F.col("key") == 77, "w").otherwise("v"))
    prints = [changes.bucket_prints(x, ["key"], ["a"]) for x in (old, new)]
    assert changes.changed_buckets(*prints).count() == 1
    assert [tuple(x) for x in changes.run_difference(old, new, ["key"], ["a"]).select("key", "change").collect()] == [(77, "changed")]


def test_sketches(spark):
    df = spark.range(30000).select((F.col("id") % 2).alias("run"), F.floor(F.col("id") / 2 + (F.col("id") % 2) * 5000).alias("v"))
    parts = [changes.distinct_sketches(df.filter(F.col("v") % 3 == k), "run", F.col("v")) for k in range(3)]
    pairs = spark.createDataFrame([(0, 1)], "first long, second long")
    got = changes.sketch_overlap(changes.merge_sketches(*parts, run="run"), "run", pairs).first()
    exact = {"first_distinct": 15000, "second_distinct": 15000, "together": 20000, "in_common": 10000, "only_second": 5000}
    for name, value in exact.items():
        assert abs(got[name] - value) <= 0.05 * exact["together"], name


# --- versions -----------------------------------------------------------------------


def parse(v):
    m = re.fullmatch(r"[v=\s]*(\d+)\.(\d+)\.(\d+)(?:-([\w.-]+))?(?:\+[\w.-]+)?\s*", v)
    return m and ([int(m[k]) for k in (1, 2, 3)], m[4].split(".") if m[4] else [])


def compare(x, y):
    (a, p), (b, q) = parse(x), parse(y)
    if a != b:
        return -1 if a < b else 1
    if not p or not q:
        return (not p) - (not q)
    for i, j in zip(p, q):
        if i != j:
            if i.isdigit() and j.isdigit():
                if int(i) != int(j):
                    return -1 if int(i) < int(j) else 1
                continue
            if i.isdigit() != j.isdigit():
                return -1 if i.isdigit() else 1
            return -1 if i < j else 1
    return (len(p) > len(q)) - (len(p) < len(q))


VERSIONS = (
    "0.0.1 0.0.2 0.1.0 0.1.9 0.2.0-beta 0.2.0 1.0.0-alpha 1.0.0-alpha.1 1.0.0-alpha.beta 1.0.0-beta 1.0.0-beta.2 1.0.0-beta.11 1.0.0-rc.1 "
    "1.0.0 1.0.1-0 1.2.3 1.2.4-rc.1 1.2.10 1.9.0 1.10.0 2.0.0-rc.1 2.0.0 2.0.0+build 10.0.0 12345678901234567890.0.0 v3.1.4"
).split()


def test_keys_sort_by_precedence(spark):
    df = spark.createDataFrame([(v,) for v in [*VERSIONS, "1.2", "latest", "", "1.2.3.4", None]], "v string")
    keys = {r.v: r.key for r in df.select("v", version_key(F.col("v")).alias("key")).collect()}
    assert [keys[v] for v in ("1.2", "latest", "", "1.2.3.4", None)] == [None] * 5
    for a in VERSIONS:
        for b in VERSIONS:
            assert (keys[a] > keys[b]) - (keys[a] < keys[b]) == compare(a, b), (a, b)


EXPECTED = {
    "^1.2.3": "1.10.0",
    "^0.1.0": "0.1.9",
    "^0.0.1": "0.0.1",
    "^0": "0.2.0",
    "^0.0": "0.0.2",
    "~1.2.3": "1.2.10",
    "~1": "1.10.0",
    "~0.1": "0.1.9",
    "1.2.x": "1.2.10",
    "1": "1.10.0",
    "*": "12345678901234567890.0.0",
    "": "12345678901234567890.0.0",
    "=1.2.3": "1.2.3",
    "1.2.4-rc.1": "1.2.4-rc.1",
    "^1.2.4-rc.0 <1.9": "1.2.10",
    ">=1.2.4-rc.0 <1.2.5": "1.2.4-rc.1",
    ">=2.0.0-rc.0 <2.0.0": "2.0.0-rc.1",
    "<2.0.0": "1.10.0",
    "<2": "1.10.0",
    "<=1.9": "1.9.0",
    ">1.10 <4": "v3.1.4",
    "> 1.2.3 < 1.9.0": "1.2.10",
    "1.0.0 - 1.2": "1.2.10",
    "0.1.x || ~0.0.1": "0.1.9",
    "^5.0.0": None,
    ">2 <1": None,
    "<0.0.0": None,
}


def test_latest_matching(spark):
    wanted = [("p", s) for s in [*EXPECTED, "^1.2.3"]] + [("p", "latest"), ("p", "file:../x"), ("p", None), ("q", "^1.0.0"), (None, "*")]
    versions = [("p", v) for v in VERSIONS if v != "2.0.0+build"] + [("q", "2.0.0"), (None, "1.0.0"), ("p", None), ("p", "junk")]
    got = matching.latest_matching(spark.createDataFrame(wanted, "name string, specifier string"), spark.createDataFrame(versions, "name string, version string"))
    found = {(r.name, r.specifier): (r.is_range, r.version) for r in got.collect()}
    assert {s: found["p", s] for s in EXPECTED} == {s: (True, v) for s, v in EXPECTED.items()}
    assert found["p", "latest"] == found["p", "file:../x"] == found["p", None] == (False, None)
    assert found["q", "^1.0.0"] == (True, None) and found[None, "*"] == (True, "1.0.0") and len(found) == len(set(wanted))


def test_random_ranges(spark):
    r = random.Random(4)
    number = lambda: f"{r.randint(0, 2)}.{r.randint(0, 3)}.{r.randint(0, 3)}"
    versions = sorted({number() + r.choice(["", "", "-rc.1", "-a"]) for _ in range(80)})
    wanted = sorted({f">={number()}{r.choice(['', '-a'])} <{number()}" for _ in range(60)})

    def fits(v, s):
        low, high = (w.lstrip("<>=") for w in s.split())
        nums, pre = parse(v)
        named = [parse(x)[0] for x in (low, high) if parse(x)[1]]
        return compare(v, low) >= 0 and compare(v, high) < 0 and (not pre or nums in named)

    got = matching.latest_matching(
        spark.createDataFrame([("p", s) for s in wanted], "name string, specifier string"), spark.createDataFrame([("p", v) for v in versions], "name string, version string")
    )
    best = lambda s: max((v for v in versions if fits(v, s)), key=functools.cmp_to_key(compare), default=None)
    assert {x.specifier: x.version for x in got.collect()} == {s: best(s) for s in wanted}


def test_reach(spark):
    r = random.Random(3)
    edges = [(r.choice("xy"), f"p{r.randint(0, 12)}", f"p{r.randint(0, 12)}") for _ in range(40)] + [("x", "p1", "p1"), (None, "p1", "p2"), ("x", "p1", None)]
    starts = [("x", "p1"), ("x", "p1"), ("y", "p2"), ("z", "alone"), (None, "p3"), ("y", None)]
    got = reach.reached(spark.createDataFrame(starts, "root string, package string"), spark.createDataFrame(edges, "root string, package string, dependency string"))
    want = {}
    for root, first in [s for s in starts if None not in s]:
        level, depth = {first}, 0
        while level:
            for p in level:
                want.setdefault((root, p), depth)
            level = {d for q, p, d in edges if q == root and p in level and d is not None} - {p for q, p in want if q == root}
            depth += 1
    assert {(x.root, x.package): x.depth for x in got.collect()} == want and got.count() == len(want)
    summary = {x.package: x.roots for x in reach.package_reach(spark.createDataFrame(starts, "root string, package string"), spark.createDataFrame(edges, "root string, package string, dependency string")).collect()}
    assert summary == {p: sum(q == p for _, q in want) for _, p in want}
    none = reach.reached(spark.createDataFrame([], "root string, package string"), spark.createDataFrame(edges, "root string, package string, dependency string"))
    assert none.collect() == []
