from __future__ import annotations

import io
import math
import re
import tarfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from lockscope.operators.audit import import_plan, stale_items
from lockscope.operators.dedup import dedup_bytes, global_artifacts, with_artifact_id
from lockscope.operators.ladder import resolve_urls
from lockscope.operators.locks import parse_roots
from lockscope.operators.policies import archive_manifests, assign_batches, host_compatible
from lockscope.operators.reports import category_counts, in_input_order, order_null_as_blank, phase_verdict
from lockscope.operators.results import flag_roots, offline_summary, profile_status
from lockscope.operators.rewrite import rewrite_json_locks
from lockscope.operators.shape import _bucketed, exact_percentiles, number_rows
from lockscope.functions.integrity import fingerprint

ARTIFACT = (
    "artifact_id string, type string, name string, version string, source_url string, source string, "
    "integrity string, content_sha256 string, status string, cas_path string, ord bigint"
)


def test_artifacts_are_sorted_by_a_number_first(spark):
    """Identities begin alike: a sort by the text alone compares whole rows."""
    df = spark.createDataFrame([(f"url:https://x.example/{i % 3}" if i % 3 else None, f"n{i}", i) for i in range(9)], "artifact_id string, name string, ord bigint")
    out = global_artifacts(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "- Sort [" in line]
    assert sorts and all("xxhash64" in line or "_groupingexpression" in line.split(" ASC")[0] for line in sorts)
    assert out.columns == ["artifact_id", "name", "reference_count"]
    assert {tuple(r) for r in out.collect()} == {(None, "n0", 3), ("url:https://x.example/1", "n1", 3), ("url:https://x.example/2", "n2", 3)}


def test_first_non_empty_and_partition_invariance(spark):
    rows = [(i, "sha512-a" if i % 3 else "sha512-b", "" if i < 40 else f"n{i}", f"v{i % 7}") for i in range(500)]
    df = spark.createDataFrame(rows, "ord bigint, integrity string, name string, version string")
    results = []
    for parts in (1, 7):
        out = global_artifacts(with_artifact_id(df.orderBy(F.rand(3)).repartition(parts)))
        results.append(sorted((r.artifact_id, r.name, r.version, r.reference_count) for r in out.collect()))
    assert results[0] == results[1]
    assert results[0] == [
        ("integrity:sha512-a", "n40", "v1", sum(1 for i in range(500) if i % 3)),
        ("integrity:sha512-b", "n42", "v0", sum(1 for i in range(500) if not i % 3)),
    ]


def test_dedup_bytes(spark):
    artifacts = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1), ("d", 5)], "artifact_id string, reference_count bigint")
    statuses = spark.createDataFrame(
        [("a", "reused", "x", 10), ("b", "downloaded", "x", 10), ("c", "failed", "y", 7)],
        "artifact_id string, status string, cas_path string, size_bytes bigint",
    )
    assert tuple(dedup_bytes(artifacts, statuses).head()) == (50, 10, 2, False)


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(0, 1e6, 3001), "b": rng.integers(0, 20, 1000).astype(float), "c": np.array([4.5])}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("a", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in exact_percentiles(df, ["g"], "v", {"p05": 0.05, "p50": 0.5, "p95": 0.95}).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for label, q in (("p05", 5), ("p50", 50), ("p95", 95)):
            assert np.isclose(got[g][label], np.percentile(vs, q)), (g, label)


def test_row_numbers_with_null_and_hot_keys(spark):
    rows = [("hot" if i % 10 else None, i * 37 % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, o bigint")
    out = number_rows(df, ["k"], ["o"]).collect()
    for key in ("hot", None):
        mine = sorted((r.o, r.row_no) for r in out if r.k == key)
        assert [n for _, n in mine] == list(range(len(mine)))


def test_batches(spark):
    df = spark.range(1001).select(F.col("id").alias("o"), F.lit("npm").alias("package_manager"), F.lit(None).cast("string").alias("v"))
    sizes = assign_batches(df, ["package_manager", "v"], ["o"]).groupBy("batch_no").count().collect()
    assert sorted((r.batch_no, r["count"]) for r in sizes) == [(i, 100) for i in range(10)] + [(10, 1)]


def test_wildcard_roots(spark):
    roots = spark.createDataFrame([("p", "."), ("p", "x"), ("q", "."), ("r", ".")], "profile_id string, dependency_root string")
    refs = spark.createDataFrame([("p", "x"), ("q", None), ("q", "z")], "profile_id string, dependency_root string")
    got = {(r.profile_id, r.dependency_root): r.m for r in flag_roots(roots, refs, "m").collect()}
    assert got == {("p", "."): False, ("p", "x"): True, ("q", "."): True, ("r", "."): False}


def test_profile_status(spark):
    profiles = spark.createDataFrame([("a",), ("b",), ("c",)], "profile_id string")
    results = spark.createDataFrame(
        [("a", "success"), ("b", "success"), ("b", "other_failure"), ("b", "native_or_system_dependency_failure")],
        "profile_id string, status string",
    )
    got = {r.profile_id: r.status for r in profile_status(profiles, results).collect()}
    assert got == {"a": "success", "b": "native_or_system_dependency_failure", "c": "other_failure"}


def test_offline_summary_without_runs(spark):
    statuses = spark.createDataFrame([("a", "registry", "reused"), ("b", "git", "reused")], "artifact_id string, type string, status string")
    none = spark.createDataFrame([], "status string")
    assert tuple(offline_summary(statuses, none).head()) == (1, 0, "success", "partial")


def test_ladder_alias_and_brute_force(spark):
    rows = [("gist", "git", None, None, "git+ssh://git@gist.github.com/fixture.git#deadbeef", None, None, None, "reused", "x", 0)]
    rows += [
        (f"a{i}", "registry", f"@s/p{i % 5}", f"1.{i % 3}.0", f"https://r.example/@s/p{i % 5}/-/p{i % 5}-1.{i % 3}.0.tgz", None,
         "sha512-x" if i % 2 else None, None, "reused" if i % 4 else "failed", "x", i + 1)
        for i in range(40)
    ]
    artifacts = spark.createDataFrame(rows, ARTIFACT)
    urls = [("gist:fixture", "", "")] + [(f"https://m.example/p{a}-1.{b}.0.tgz", "", "") for a in range(6) for b in range(4)]
    asked = spark.createDataFrame(urls, "url string, name string, version string")
    got = {r.url: (r.artifact_id, r["rank"]) for r in resolve_urls(asked, artifacts).collect()}

    best = {}
    for r in rows[1:]:
        if r[8] == "reused":
            key = (r[2], r[3])
            if key not in best or (r[6] is not None) > (best[key][6] is not None):
                best[key] = r
    want = {"gist:fixture": ("gist", 3)}
    for (name, version), r in best.items():
        want[f"https://m.example/{name.split('/')[1]}-{version}.tgz"] = (r[0], 6)
    assert got == want


def test_json_lock_rewrite_scoped(spark, files):
    artifacts = spark.createDataFrame(
        [("fix $1", "registry", "@scope/pkg", "1.2.3", "https://registry.npmjs.org/@scope/pkg/-/pkg-1.2.3.tgz", None, None, "h", "downloaded", "x", 0)],
        ARTIFACT,
    )
    text = (
        '{"lockfileVersion":3,"packages":{"node_modules/@scope/pkg":{"version":"1.2.3",'
        '"resolved":"https://registry.npmjs.org/@scope/pkg/-/pkg-1.2.3.tgz"}}}'
    )
    old = '{"dependencies": {"@scope/pkg": {"resolved": "https://registry.npmjs.org/@scope/pkg/-/pkg-1.2.3.tgz"}}}'
    out = {r.profile_id: r for r in rewrite_json_locks(files("package-lock.json", text, old, "{bad"), artifacts, "http://h:1").collect()}
    local = "http://h:1/tarballs/fix%20%241.tgz"
    assert local in out["p0"].text and out["p0"].replaced == 1
    assert out["p1"].text == old.replace("https://registry.npmjs.org/@scope/pkg/-/pkg-1.2.3.tgz", local)
    assert (out["p2"].text, out["p2"].replaced) == ("{bad", 0)


def test_import_plan_and_reuse(spark):
    artifacts = spark.createDataFrame(
        [("a", None, None, "reused", "x"), ("b", "s", None, "reused", "x"), ("c", "s", None, "reused", "x"), ("d", "s", None, "failed", "x"), ("e", "s", None, "reused", "x")],
        "artifact_id string, integrity string, content_sha256 string, status string, cas_path string",
    )
    covered = spark.createDataFrame([("b", True)], "artifact_id string, covered boolean")
    previous = spark.createDataFrame([("c", "failed")], "artifact_id string, outcome string")
    got = {r.artifact_id: r.verdict for r in import_plan(artifacts, covered, previous).collect()}
    assert got == {"a": "unverifiable", "b": "imported", "c": "failed_before", "e": "pending"}

    items = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "id int, v string")
    state = items.filter("id < 3").withColumn("fingerprint", fingerprint("v"))
    state = state.withColumn("status", F.when(F.col("id") == 1, "success").otherwise("partial"))
    assert sorted(r.id for r in stale_items(items, state, ["id"], ["v"]).collect()) == [2, 3]


def test_archive_manifests(spark):
    def archive(name, text):
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
            info = tarfile.TarInfo(name)
            info.size = len(text)
            tar.addfile(info, io.BytesIO(text))
        return buffer.getvalue()

    blobs = spark.createDataFrame(
        [
            ("ok", archive("package/package.json", b'{"os":["!win32"],"cpu":["x64"]}')),
            ("mac", archive("package/package.json", b'{"os":["darwin"]}')),
            ("odd", archive("package/package.json", b'{"os":"darwin"}')),
            ("none", archive("readme", b"x")),
            ("bad", b"not a tar"),
        ],
        "path string, content binary",
    )
    out = host_compatible(archive_manifests(blobs), ["linux"], ["x64", "x86_64"]).collect()
    assert {r.path: r.compatible for r in out} == {"ok": True, "mac": False, "odd": True, "none": True, "bad": True}


def test_report_order(spark):
    rows = spark.createDataFrame([("b", "2"), ("a", "9"), ("x", "1"), ("b", "1")], "p string, root string")
    positions = spark.createDataFrame([("b", 0), ("a", 1)], "p string, ord bigint")
    ordered = [(r.p, r.root) for r in in_input_order(rows, positions, "p", "root").collect()]
    assert ordered == [("b", "1"), ("b", "2"), ("a", "9"), ("x", "1")]
    blank = spark.createDataFrame([("b",), (None,), ("a",)], "v string")
    assert [r.v for r in order_null_as_blank(blank, "v").collect()] == [None, "a", "b"]
    counted = category_counts(rows.withColumnRenamed("p", "category")).collect()
    assert [(r.category, r["count"]) for r in counted] == [("b", 2), ("a", 1), ("x", 1)]


def test_phase_verdict(spark):
    schema = (
        "failed_discovery_count int, resolution_failure_count int, prefetch_failure_count int, "
        "validation_success_count int, input_profile_count int, second_run_bytes bigint"
    )
    rows = [(0, 0, 0, 5, 5, 0), (0, 0, 0, 4, 5, 0), (0, 0, 0, 5, 5, None), (0, 0, 0, 5, 5, 7)]
    verdicts = [r.verdict for r in phase_verdict(spark.createDataFrame(rows, schema).coalesce(1)).collect()]
    assert verdicts == ["passed", "partial", "partial", "partial"]


def test_numbers_keep_unknown_orders(spark):
    df = spark.createDataFrame([("a", None), ("a", 2.0), ("a", float("nan")), ("a", 1.0), (None, 5.0)], "k string, v double")
    rows = {(r.k, str(r.v)): r.row_no for r in number_rows(df, ["k"], ["v"]).collect()}
    assert rows == {("a", "1.0"): 0, ("a", "2.0"): 1, ("a", "nan"): 2, ("a", "None"): 3, (None, "5.0"): 0}


def test_percentiles_rank_nan_last(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (float("nan"),), (None,)], "v double")
    found = exact_percentiles(df, [], "v", {"p50": 0.5, "p100": 1.0}).first()
    assert found.p50 == 2.5 and math.isnan(found.p100)
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "v double")
    assert tuple(exact_percentiles(df, [], "v", {"p0": 0.0, "p50": 0.5, "p100": 1.0}).first()) == (float("-inf"), 1.0, float("inf"))


@pytest.mark.parametrize("base", [0, 10**15, 1_700_000_000_000_000])
def test_no_bucket_holds_a_large_part(spark, base):
    df = spark.range(1_000_000).select((F.col("id") + base).alias("v"), F.lit("k").alias("_group"))
    largest = _bucketed(df, F.col("v")).groupBy("_bucket").count().agg(F.max("count")).first()[0]
    assert largest < 50_000


def test_unknown_positions_come_last(spark):
    rows = spark.createDataFrame([("x", 1), ("y", 1), ("z", 1)], "k string, n int")
    positions = spark.createDataFrame([("x", 2 * 10**9), ("z", 5)], "k string, ord long")
    assert [r.k for r in in_input_order(rows, positions, "k", "n").collect()] == ["z", "x", "y"]


def test_no_content_is_shuffled(spark):
    key = "profile_id string, dependency_root string"
    resolutions = spark.createDataFrame([], f"{key}, resolved_lockfile string, source_lockfile string, classification string")
    roots = spark.createDataFrame([], f"{key}, package_manager string")
    files = spark.createDataFrame([], f"{key}, filename string, content string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        query = parse_roots(resolutions, roots, files)._jdf.queryExecution()
        said = spark._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(query, "formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*?)\]", said)
    assert exchanges and not any(re.search(r"\bcontent#|\btext#", x) for x in exchanges)
