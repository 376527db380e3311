"""Plans: files are parsed once, and rows are dealt out before texts are made of them."""

from __future__ import annotations

from lockscope.operators.dockerfile import dockerfile_instructions, install_commands
from lockscope.plans import QUERIES


def test_git_urls_use_all_tasks(spark):
    df = QUERIES["git_urls"](spark, "/root/testdata/sf0.001")
    assert df.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_dockerfiles_are_cut_into_tokens_once(spark):
    files = spark.createDataFrame([("p", "FROM node:18\nRUN cd a && npm ci\n"), ("q", "")], "profile_id string, text string")
    instructions = dockerfile_instructions(files)
    plan = instructions._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert [(r.profile_id, r.line, r.keyword) for r in instructions.orderBy("line").collect()] == [("p", 1, "FROM"), ("p", 2, "RUN")]
    assert [(r.profile_id, r.dependency_root, r.fragment) for r in install_commands(instructions).collect()] == [("p", "a", "npm ci")]
