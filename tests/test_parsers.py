from __future__ import annotations

import gc
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lockscope.operators.bun import parse_bun, strict_json
from lockscope.operators.dockerfile import (
    dockerfile_instructions,
    explicit_versions,
    install_commands,
    install_roots,
    version_mentions,
)
from lockscope.operators.locks import match_resolutions, parse_roots
from lockscope.operators.manifest import parse_manifests
from lockscope.operators.npm import _reader, parse_npm
from lockscope.operators.parsed import FILE_KEY, issue_rows, reference_rows
from lockscope.operators.pnpm import parse_pnpm, parse_pnpm_with_snapshots
from lockscope.operators.yarn import parse_yarn
from lockscope.plans import QUERIES


def rows(df):
    return df.orderBy("profile_id", "pos").collect()


def test_npm_flat(files):
    text = json.dumps(
        {
            "lockfileVersion": 3,
            "packages": {
                "": {},
                "node_modules/foo": {
                    "version": "1.2.3",
                    "resolved": "https://registry.npmjs.org/foo/-/foo-1.2.3.tgz",
                    "integrity": "sha512-abc",
                },
                "node_modules/parent/node_modules/child": {"version": "1.0.0", "inBundle": True},
                "node_modules/@s/x": {"version": "2.0.0", "name": "@t/y", "resolved": False},
                "packages/a": {"version": "0.1.0"},
                "lib/b": {"version": "0.2.0"},
                "node_modules/num": {"version": 1, "resolved": "u"},
                "node_modules/nothing": {"link": False},
                "odd": 5,
            },
        }
    )
    found = rows(parse_npm(files("package-lock.json", text)))
    assert [(r.type, r.name, r.version, r.problem) for r in found] == [
        ("registry", "foo", "1.2.3", None),
        ("local_file", "child", "1.0.0", None),
        ("registry", "@t/y", "2.0.0", None),
        ("workspace", "packages/a", "0.1.0", None),
        ("local_file", "lib/b", "0.2.0", None),
        ("registry", "num", None, "package entry has no parseable version"),
    ]
    assert found[1].resolved_url is None and found[1].path == "node_modules/parent/node_modules/child"
    assert found[2].resolved_url == "https://registry.npmjs.org/@t/y/-/y-2.0.0.tgz"


def test_npm_nested_to_any_depth(files):
    depth = 150
    tree = {"version": "1.0.0"}
    for i in reversed(range(depth)):
        tree = {"version": f"{i}.0.0", "dependencies": {f"d{i + 1}": tree}}
    text = json.dumps({"lockfileVersion": 1, "dependencies": {"d0": tree, "last": {"version": "9.0.0"}}})
    found = rows(parse_npm(files("package-lock.json", text)))
    assert len(found) == depth + 2
    assert found[2].raw_locator == "d0/node_modules/d1/node_modules/d2"
    assert found[-1].name == "last"


@pytest.mark.parametrize("text", ["{bad", "", "[]", '{"packages":{}} x', '{"packages":{}}}', "<<<<<<< HEAD"])
def test_broken_json_is_one_issue(files, text):
    assert [r.problem for r in parse_npm(files("package-lock.json", text)).collect()] == ["lockfile parse failed"]


def test_npm_locks_are_rendered_and_read_once(spark):
    for name in ("lock_npm", "lock_artifacts"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Relation [") == 1 and "from_json" not in plan
        assert plan.count("lower(trim(") == 1  # a locator is made ready once, not for each pattern


def test_npm_reader_leaves_the_collector_on():
    batch = pa.RecordBatch.from_pydict({**dict.fromkeys(FILE_KEY, ["p"] * 3), "text": [b'{"packages":{"a":{"version":"1"}}}', b" {}\n", b"{}\x0b"]})
    seen = []
    for found in _reader(1)(iter([batch])):
        seen.append((found.num_rows, gc.isenabled()))
    assert gc.isenabled() and seen == [(1, False), (1, False), (0, False)]


def test_npm_repeated_path_and_odd_text(files):
    text = '{"packages":{"a":{"version":"1"},"b":{"version":"\\ud800x"},"a":{"version":"2","dependencies":{"x":"^1","y":2}}}}'
    found = rows(parse_npm(files("package-lock.json", text, '{"packages":{"a":{"version":NaN}}}', None)))
    assert [(r.name, r.version, r.dependencies, r.problem) for r in found if r.profile_id == "p0"] == [
        ("a", "2", {"x": "^1", "y": "2"}, None),
        ("b", "?x", None, None),
    ]
    assert [(r.profile_id, r.problem) for r in found[2:]] == [(p, "lockfile parse failed") for p in ("p1", "p2")]


def test_npm_packages_of_wrong_type_falls_back(files):
    text = '{"packages":[1],"dependencies":{"a":{"version":"1.0.0"}}}'
    assert [r.name for r in parse_npm(files("package-lock.json", text)).collect()] == ["a"]


def test_yarn_classic_and_berry(files):
    classic = (
        '# yarn lockfile v1\r\n\r\n"foo@^1.0.0", foo@~1.2:\r\n  version "1.2.3"\r\n'
        '  resolved "https://registry.npmjs.org/foo/-/foo-1.2.3.tgz"\r\n  integrity sha512-abc\r\n'
        '  dependencies:\r\n    version "9.9.9"\r\n'
    )
    berry = (
        '__metadata:\n  version: 6\n\n"foo@npm:^1.0.0":\n  version: 1.2.3\n  resolution: "foo@npm:1.2.3"\n'
        '  checksum: 10c0/abc\n\n"alias@npm:bar@^2.0.0":\n  version: 2.0.0\n  resolution: "bar@npm:2.0.0"\n'
    )
    found = rows(parse_yarn(files("yarn.lock", classic, berry)))
    assert [(r.profile_id, r.name, r.version, r.integrity) for r in found] == [
        ("p0", "foo", "1.2.3", "sha512-abc"),
        ("p0", "foo", "1.2.3", "sha512-abc"),
        ("p1", "foo", "1.2.3", None),
        ("p1", "alias", "2.0.0", None),
    ]
    assert found[2].cache_checksum == "10c0/abc"
    assert (found[3].source_name, found[3].resolved_url) == ("bar", "https://registry.npmjs.org/bar/-/bar-2.0.0.tgz")


def test_pnpm_packages_patches_snapshots(files):
    text = (
        "lockfileVersion: '9.0'\npackages:\n  foo@1.2.3:\n    resolution: {integrity: sha512-abc}\n"
        "  /bar@1.0.0(peer@2.0.0):\n    resolution: {integrity: sha512-b}\n"
        "  web@https://x.example/w.tgz:\n    resolution: {tarball: https://x.example/w.tgz}\n    version: 3.0.0\n"
        "  dir@file:../d:\n    resolution: {directory: ../d, type: directory}\n"
        "patchedDependencies:\n  foo@1.2.3: patches/foo.patch\n"
        "snapshots:\n  foo@1.2.3(a@1):\n    dependencies: {a: '1'}\n  foo@1.2.3(a@2):\n    dependencies: {a: '2'}\n"
    )
    parsed = parse_pnpm_with_snapshots(files("pnpm-lock.yaml", text, "a: ["))
    found = {(r.profile_id, r.raw_locator, r.problem): r for r in parsed.collect()}
    assert found["p0", "/bar@1.0.0(peer@2.0.0)", None].version == "1.0.0"
    assert found["p0", "web@https://x.example/w.tgz", None].type == "http_tarball"
    assert found["p0", "dir@file:../d", None].path == "../d"
    assert found["p0", "foo@1.2.3", "patched dependency"].path == "patches/foo.patch"
    assert ("p1", None, "lockfile parse failed") in found
    attached = reference_rows(parsed).filter("snapshot is not null").collect()
    assert [(r.name, r.snapshot_locator) for r in attached] == [("foo", "foo@1.2.3(a@1)")]


def test_bun(files):
    text = (
        '{ // c, ]\n lockfileVersion: 1, packages: { "foo": ["foo@1.2.3", "", {}, "sha512-abc",],\n'
        ' "@s/g": ["@s/g@git+ssh://git.example/g.git#abc", {}], "w": ["w@workspace:packages/w"], "q": [], }, }'
    )
    found = rows(parse_bun(files("bun.lock", text)))
    assert [(r.type, r.name, r.integrity) for r in found][:1] == [("registry", "foo", "sha512-abc")]
    assert found[1].source == "git+ssh://git.example/g.git#abc"
    assert found[2].path == "packages/w"
    assert found[3].problem == "unparseable Bun package entry"
    binary = parse_bun(files("bun.lockb", "\x00\x01")).collect()
    assert [r.problem for r in binary] == ["binary lockfile cannot be read"]


def test_strict_json_keeps_strings(spark):
    body = "x," * 100_000
    text = '{"a": "// no, }", "b": "' + body + '", /* y */ "c": [1, 2, ], }'
    out = spark.createDataFrame([(text,)], "t string").select(strict_json(F.col("t"))).head()[0]
    assert json.loads(out) == {"a": "// no, }", "b": body, "c": [1, 2]}


def test_manifest(files):
    text = '{"dependencies":{"a":"^1","c":"catalog:z","n":3},"devDependencies":{"d":"file:../x"},"peerDependencies":[]}'
    parsed = parse_manifests(files("package.json", text, "[]"))
    assert sorted((r.name, r.type, r.dev) for r in reference_rows(parsed).collect()) == [
        ("c", "unknown", False),
        ("d", "local_file", True),
    ]
    assert sorted(r.reason for r in issue_rows(parsed).collect()) == [
        "invalid package.json",
        "lockfile entry requires manual review",
    ]


def test_dockerfile_roots_and_versions(spark):
    texts = [
        "FROM registry.example/node:18.4 AS build\nWORKDIR /srv/app\nRUN corepack prepare yarn@3.6.1 --activate; yarn install\nWORKDIR docs\nRUN npm i\n",
        "FROM oven/bun:1.1\nRUN bun install && (cd tools/cli; npm ci)\nRUN yarn --cwd web install --frozen-lockfile\n",
        "FROM node\nRUN npm i --silent -g npm@10 pnpm@8 && npm install -g pnpm@8.15.2\nRUN yarn set version berry\nRUN npm -g pnpm@1; echo npm install -g yarn\n",
    ]
    df = spark.createDataFrame([(f"p{i}", t) for i, t in enumerate(texts)], "profile_id string, text string")
    instructions = dockerfile_instructions(df)
    roots = install_roots(install_commands(instructions)).orderBy("profile_id", "first_place").collect()
    assert [(r.profile_id, r.dependency_root, r.package_manager) for r in roots] == [
        ("p0", "app", "yarn"),
        ("p0", "app/docs", "npm"),
        ("p1", ".", "bun"),
        ("p1", "tools/cli", "npm"),
        ("p1", "web", "yarn"),
    ]
    versions = {(r.profile_id, r.tool): r.version for r in explicit_versions(instructions).collect()}
    assert versions == {
        ("p0", "node"): "18.4",
        ("p0", "yarn"): "3.6.1",
        ("p1", "bun"): "1.1",
        ("p2", "npm"): "10",
        ("p2", "pnpm"): "8.15.2",
        ("p2", "yarn"): "berry",
    }
    said = {(r.line, r.tool): r.mention for r in version_mentions(instructions).filter("profile_id = 'p2'").collect()}
    assert said == {(2, "npm"): "npm i --silent -g npm@10", (2, "pnpm"): "npm install -g pnpm@8.15.2", (3, "yarn"): "yarn set version berry"}


def test_dockerfile_long_continuation(spark):
    text = "RUN a \\\n" + "  && b \\\n" * 20_000 + "  && c\nENV X=1\n"
    df = spark.createDataFrame([("p", text)], "profile_id string, text string")
    found = dockerfile_instructions(df).orderBy("line").collect()
    assert [(r.line, r.keyword) for r in found] == [(1, "RUN"), (20_003, "ENV")]


def test_roots_end_to_end(spark, files):
    lock = '{"packages":{"node_modules/a":{"version":"1.0.0"}}}'
    table = files("package-lock.json", lock, lock).unionByName(files("package.json", '{"dependencies":{"g":"git+https://x.example/g.git"}}'))
    roots = spark.createDataFrame([(f"p{i}", ".", "npm") for i in range(3)], "profile_id string, dependency_root string, package_manager string")
    resolutions = spark.createDataFrame(
        [
            ("p0", ".", "package-lock.json", None, "authoritative_existing"),
            ("p1", ".", None, "package-lock.json", "authoritative_existing"),
            ("p2", ".", "package-lock.json", None, "authoritative_existing"),
            ("p9", ".", "package-lock.json", None, "authoritative_existing"),
            ("p0", "x", "package-lock.json", None, "authoritative_existing"),
        ],
        "profile_id string, dependency_root string, resolved_lockfile string, source_lockfile string, classification string",
    )
    matched, missing = match_resolutions(resolutions, roots, roots)
    assert sorted((r.profile_id, r.reason) for r in missing.collect()) == [
        ("p0", "dependency root missing from discovery"),
        ("p9", "profile missing from discovery"),
    ]
    parsed = parse_roots(matched, roots, table)
    assert sorted((r.profile_id, r.name) for r in reference_rows(parsed).collect()) == [("p0", "a"), ("p0", "g"), ("p1", "a")]
    assert sorted((r.profile_id, r.reason) for r in issue_rows(parsed).collect()) == [
        ("p1", "package.json missing"),
        ("p2", "package.json missing"),
        ("p2", "resolved lockfile missing"),
    ]


def test_round_trip_random_locks(spark, files):
    import random

    rng = random.Random(7)
    names = [f"@s{rng.randint(0, 9)}/p{i}" if i % 3 else f"p{i}" for i in range(200)]
    want = {(n, f"{rng.randint(0, 9)}.{rng.randint(0, 99)}.{i}") for i, n in enumerate(names)}
    npm = json.dumps({"packages": {f"node_modules/{n}": {"version": v} for n, v in want}})
    pnpm = "packages:\n" + "".join(f"  '{n}@{v}':\n    resolution: {{integrity: sha512-x}}\n" for n, v in want)
    yarn = "".join(f'"{n}@^1":\n  version "{v}"\n\n' for n, v in want)
    bun = "{packages: {" + "".join(f'"{n}": ["{n}@{v}", "", {{}}, "sha512-x"],\n' for n, v in want) + "}}"
    for parse, name, text in (
        (parse_npm, "package-lock.json", npm),
        (parse_pnpm, "pnpm-lock.yaml", pnpm),
        (parse_yarn, "yarn.lock", yarn),
        (parse_bun, "bun.lock", bun),
    ):
        got = {(r.name, r.version) for r in reference_rows(parse(files(name, text))).collect()}
        assert got == want, name
