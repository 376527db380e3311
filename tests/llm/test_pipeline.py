from __future__ import annotations

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from lockscope.llm import decontaminate, langid, lines, minhash, packing  # noqa: E402
from lockscope.llm.common import stored  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "lines", "near-duplicates", "decontamination", "packing"]
    docs = start = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        kept[name] = docs
        if name != "packing":
            assert docs.columns == start.columns
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert kept["language"].count() == start.count()
    assert minhash.near_duplicates(kept["near-duplicates"], shingle=2).filter("not kept").count() == 0
    assert {tuple(r) for r in kept["lines"].select("doc_id", "text").collect()} == {tuple(r) for r in lines.line_dedup(kept["language"]).select("doc_id", "text").collect()}
    assert kept["lines"].filter("n_chars <> length(text)").count() == 0
    assert decontaminate.contamination(kept["decontamination"], items).filter("contaminated").count() == 0
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in kept["decontamination"].collect()}
    whole = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))
    assert langid and packing


def planted(spark, tmp_path):
    """Clean texts of 40 words, and after them one text for each stage to reject or change."""
    r = random.Random(4)
    words = sorted({w for t in spark.read.parquet(f"{SF}/documents.parquet").filter("lang = 'en'").select("text").limit(50).collect() for w in t.text.lower().split() if w.isalpha()})
    clean = [" ".join(r.choices(words, k=40)) for _ in range(30)]
    item = " ".join(r.choices(words, k=14))
    bad = [
        (100, " ".join("".join(r.choices("bcdfghjklmnpqrstvwxz", k=7)) for _ in range(40))),  # no language
        (101, clean[3]),  # an exact copy
        (102, " ".join(["other", *clean[4].split()[1:]])),  # a near copy
        (103, " ".join(r.choices(words, k=20)) + " " + item + " " + " ".join(r.choices(words, k=9))),  # a benchmark passage
        (104, clean[5] + "\n" + " ".join(r.choices(words, k=40))),  # an earlier line and a new one
        (105, None),
        (106, ""),
    ]
    rows = [(i, t, None if i == 100 else "en", "s", len(t or ""), "x") for i, t in [*enumerate(clean), *bad]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `row` string")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return clean, dict(bad)


def test_stages_reject_what_was_planted(spark, tmp_path):
    clean, bad = planted(spark, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, str(tmp_path)), name)
        left[name] = {r.doc_id: r for r in docs.collect()}
    good = set(range(30))
    assert set(left["language"]) == good | {101, 102, 103, 104}
    lines_left = left["lines"]
    assert all(lines_left[i].text == clean[i] for i in good) and lines_left[101].text == "" and lines_left[104].text == bad[104].split("\n")[1]
    assert all(x.n_chars == len(x.text) and x.row == "x" for x in lines_left.values())
    assert set(left["decontamination"]) >= good and 103 not in left["decontamination"] and 103 in left["near-duplicates"]
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(map(str, docs.collect()))


def test_near_copies_leave_one(spark):
    clean = " ".join(f"word{k}" for k in range(60))
    rows = [(1, clean), (2, clean.replace("word30", "other")), (3, "unlike " + " ".join(f"n{k}" for k in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.one_of_each(spark, docs, SF).collect()} == {1, 3}


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    planted(spark, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    odd = docs.withColumns({c: F.lit("z") for c in ("matches", "shares", "explained", "gone_lines_", "component_id", "kept")})
    for frame in (docs.limit(0), odd):
        for name, stage in corpus_pipeline.STAGES:
            frame = stored(stage(spark, frame, str(tmp_path)), name)
        assert frame.count() >= 0
