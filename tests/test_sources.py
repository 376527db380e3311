from __future__ import annotations

import json

import pytest

from lockscope.operators.results import root_log_flags
from lockscope.sources.readers import (
    directory_bytes,
    files_per_root,
    profile_id_problems,
    read_blobs,
    read_cache_index,
    read_candidate_files,
    read_event_log,
    read_event_log_open,
    read_install_logs,
    read_profile_ids,
    read_stage_document,
    read_tasks,
    require_profile_ids,
)
from lockscope.sources.writers import write_csv_report, write_json_by_profile, write_json_report, write_table
from lockscope.operators.audit import read_index_entries


def test_profile_ids(spark, tmp_path):
    good = "swesmith/a__b.01234567"
    (tmp_path / "ok.txt").write_text(f"  {good} \n\n")
    ids = read_profile_ids(spark, str(tmp_path / "ok.txt"))
    assert [r.profile_id for r in require_profile_ids(ids).collect()] == [good]
    (tmp_path / "bad.txt").write_text(f"{good}\n{good}\nnope\n")
    bad = read_profile_ids(spark, str(tmp_path / "bad.txt"))
    assert sorted(r.reason for r in profile_id_problems(bad).collect()) == ["duplicate profile ID", "invalid profile ID"]
    with pytest.raises(Exception, match="profile ID"):
        require_profile_ids(bad).collect()


def test_candidate_files(spark, tmp_path):
    folder = tmp_path / "p1" / "apps__web"
    folder.mkdir(parents=True)
    for name in ("package.json", "yarn.lock", "README.md", "dot.npmrc"):
        (folder / name).write_text(name)
    files = read_candidate_files(spark, str(tmp_path))
    assert {(r.profile_id, r.dependency_root, r.filename, r.size_bytes) for r in files.collect()} == {
        ("p1", "apps/web", "package.json", 12),
        ("p1", "apps/web", "yarn.lock", 9),
        ("p1", "apps/web", ".npmrc", 9),
    }
    row = files_per_root(files).head()
    assert (row.lockfiles, row.manifest_files) == (["yarn.lock"], ["package.json", ".npmrc"])


def test_documents_and_logs(spark, tmp_path):
    (tmp_path / "doc.json").write_text('{\n "a": 1\n}')
    assert read_stage_document(spark, str(tmp_path / "doc.json"), "a INT").head().a == 1
    assert read_stage_document(spark, str(tmp_path / "absent.json"), "a INT").collect() == []
    (tmp_path / "log.jsonl").write_text(json.dumps({"stage": "s", "event": "e", "extra": {"n": 5}}) + "\n")
    assert read_event_log(spark, str(tmp_path / "log.jsonl")).head().event == "e"
    opened = read_event_log_open(spark, str(tmp_path / "log.jsonl"))
    assert opened.selectExpr("variant_get(record, '$.extra.n', 'int') n").head().n == 5


def test_tasks(spark, tmp_path):
    (tmp_path / "tasks.csv").write_text("\ufeffSWE-smith,1,x,t1,repo/a,z\nOther,1,x,t2,repo/a\nSWE-smith,1,x,,repo/a\nSWE-smith,1,x,t3\nSWE-smith,1,x,t4,\nSWE-smith,1,x,t5,,more\n\"SWE-smith\",1,\"a,b\",t6,repo/b\n", encoding="utf-8")
    rows = read_tasks(spark, str(tmp_path / "tasks.csv")).collect()
    assert [(r.task_id, r.repository) for r in rows] == [("t1", "repo/a"), ("t4", ""), ("t5", ""), ("t6", "repo/b")]


def test_blobs_and_index(spark, tmp_path):
    blob = tmp_path / "cas" / "blobs" / "sha256"
    blob.mkdir(parents=True)
    (blob / "ab").write_bytes(b"12345")
    (blob / "cd").write_bytes(b"123")
    assert directory_bytes(spark, str(tmp_path / "cas")).head()["bytes"] == 8
    assert {r.blob_path for r in read_blobs(spark, str(tmp_path / "cas")).collect()} == {"blobs/sha256/ab", "blobs/sha256/cd"}
    index = tmp_path / "index" / "aa" / "bb"
    index.mkdir(parents=True)
    (index / "x").write_text('\nh\t{"key":"k\\tt","integrity":"i"}\nh\t{bad\nh\t[1]\nno tab {"key":"z"}\n')
    entries = read_index_entries(read_cache_index(spark, str(tmp_path / "index"))).collect()
    assert [(r.integrity, r.key) for r in entries] == [("i", "k\tt")]


def test_install_logs(spark, tmp_path):
    folder = tmp_path / "p" / "root"
    folder.mkdir(parents=True)
    (folder / "g1.stdout.log").write_text("One\nTWO")
    (folder / "g2.stderr.log").write_text("Three")
    reasons = spark.createDataFrame([("p", ".", "Why"), ("q", ".", "Only")], "profile_id string, dependency_root string, reason string")
    (folder / "g1.stderr.log").write_text("npm ERESOLVE now")
    reasons = reasons.union(spark.createDataFrame([("r", ".", "Timed OUT")], reasons.schema))
    logs = read_install_logs(spark, str(tmp_path))
    assert {(r.phase, r.stream) for r in logs.collect()} == {("g1", "stdout"), ("g1", "stderr"), ("g2", "stderr")}
    flags = {r.profile_id: r for r in root_log_flags(logs, reasons=reasons).collect()}
    assert flags["p"].failure_lockfile_or_peer_resolution and not flags["p"].timeout
    assert flags["r"].timeout and not flags["q"].timeout


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("p", 1, "x"), ("q", 2, "y")], "profile_id string, n int, extra string")
    write_csv_report(df, str(tmp_path / "csv"), ["n", "profile_id"])
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["n", "profile_id"]
    write_json_report(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    write_json_by_profile(df, str(tmp_path / "parts"))
    assert (tmp_path / "parts" / "profile_id=p").is_dir()
    write_table(df, str(tmp_path / "table"), ["profile_id", "n"])
    assert spark.read.parquet(str(tmp_path / "table")).count() == 2
