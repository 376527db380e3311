"""Parsers: lock text is rendered from a table row by row, then parsed back.

One row makes one file, so rendering needs no grouping whatever the keys look like.
The SQL side reads the table directly and never sees the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.bun import parse_bun
from ..operators.dockerfile import (
    dockerfile_instructions,
    explicit_versions as tool_versions,
    install_commands as found_installs,
    install_roots,
    manifest_edits as found_edits,
)
from ..operators.locks import parse_locks
from ..operators.manifest import parse_manifests
from ..operators.npm import parse_npm
from ..operators.parsed import issue_rows, reference_rows
from ..operators.profiles import evidence_rows
from ..operators.pnpm import parse_pnpm, parse_pnpm_with_snapshots
from ..operators.yarn import parse_yarn
from .registry import Tables, as_files, fill, pick, query

_REF = ("profile_id", "pos", "type", "name", "version", "resolved_url", "integrity", "source")


def _npm_text() -> Column:
    return fill(
        '{"lockfileVersion":3,"packages":{"":{"name":"app"},'
        '"node_modules/part-<part>":{"version":"<line>.<supp>.0","resolved":'
        '"https://registry.npmjs.org/part-<part>/-/part-<part>-<line>.<supp>.0.tgz","integrity":"sha512-p<part>"},'
        '"node_modules/a/node_modules/@supp/s-<supp>":{"version":"1.<order>.0","optional":true,"resolved":false},'
        '"packages/w-<order>":{"version":"0.<line>.0"},'
        '"node_modules/a/node_modules/b-<part>":{"version":"2.0.0","inBundle":true},'
        '"node_modules/g-<part>":{"version":"3.0.0","resolved":"git+ssh://git@github.com/o/g-<part>.git#<order>"},'
        '"node_modules/w-<order>":{"resolved":"packages/w-<order>","link":true}}}',
        part="l_partkey",
        supp="l_suppkey",
        order="l_orderkey",
        line="l_linenumber",
    )


def _line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    """
    WITH l AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS profile_id,
                      l_orderkey AS o, l_linenumber AS n, l_partkey AS p, l_suppkey AS s FROM lineitem)
    SELECT profile_id, 1 AS pos, 'registry' AS type, 'part-' || p AS name, n || '.' || s || '.0' AS version,
           'https://registry.npmjs.org/part-' || p || '/-/part-' || p || '-' || n || '.' || s || '.0.tgz' AS resolved_url,
           'sha512-p' || p AS integrity,
           'https://registry.npmjs.org/part-' || p || '/-/part-' || p || '-' || n || '.' || s || '.0.tgz' AS source FROM l
    UNION ALL SELECT profile_id, 2, 'registry', '@supp/s-' || s, '1.' || o || '.0',
           'https://registry.npmjs.org/@supp/s-' || s || '/-/s-' || s || '-1.' || o || '.0.tgz', NULL,
           'https://registry.npmjs.org/' FROM l
    UNION ALL SELECT profile_id, 3, 'workspace', 'packages/w-' || o, '0.' || n || '.0', NULL, NULL,
           'packages/w-' || o FROM l
    UNION ALL SELECT profile_id, 4, 'local_file', 'b-' || p, '2.0.0', NULL, NULL,
           'node_modules/a/node_modules/b-' || p FROM l
    UNION ALL SELECT profile_id, 5, 'git', 'g-' || p, '3.0.0',
           'git+ssh://git@github.com/o/g-' || p || '.git#' || o, NULL,
           'git+ssh://git@github.com/o/g-' || p || '.git#' || o FROM l
    """
)
def lock_npm(t: Tables) -> DataFrame:
    rows = t.dealt("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    files = as_files(rows, _line_id(), "package-lock.json", _npm_text())
    return reference_rows(parse_npm(files)).select(*_REF)


@query(
    """
    WITH c AS (SELECT c_custkey AS c, n_nationkey AS n, r_regionkey AS r FROM customer
               JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT CAST(c AS VARCHAR) AS profile_id, 0 AS pos, 'region-' || r AS path, 'region-' || r AS name,
           '1.0.' || r AS version, 'local_file' AS type FROM c
    UNION ALL SELECT CAST(c AS VARCHAR), 1, 'region-' || r || '/node_modules/nation-' || n, 'nation-' || n,
           '2.0.' || n, 'registry' FROM c
    UNION ALL SELECT CAST(c AS VARCHAR), 2,
           'region-' || r || '/node_modules/nation-' || n || '/node_modules/@cust/c-' || c, '@cust/c-' || c,
           '3.0.' || c, 'http_tarball' FROM c
    UNION ALL SELECT CAST(c AS VARCHAR), 3, 'last-' || c, 'last-' || c, '4.0.0', 'local_file' FROM c
    """
)
def lock_npm_v1(t: Tables) -> DataFrame:
    joined = (
        t.dealt("customer", "c_custkey", "c_nationkey")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    text = fill(
        '{"lockfileVersion":1,"dependencies":{"region-<r>":{"version":"1.0.<r>","dependencies":{'
        '"nation-<n>":{"version":"2.0.<n>","requires":{"x":"1"},"dependencies":{"@cust/c-<c>":{"version":"3.0.<c>",'
        '"resolved":"https://files.example/c-<c>.tgz"}}}}},"last-<c>":{"version":"4.0.0"}}}',
        r="r_regionkey",
        n="n_nationkey",
        c="c_custkey",
    )
    files = as_files(joined, F.col("c_custkey"), "package-lock.json", text)
    parsed = parse_npm(files)
    return parsed.select("profile_id", "pos", F.col("raw_locator").alias("path"), "name", "version", "type")


_YARN_CLASSIC = (
    "# THIS IS AN AUTOGENERATED FILE.\n# yarn lockfile v1\n\n\n"
    '"@p/<n>@^1.0.0", "@p/<n>@~1.<size>.0":\n  version "1.<size>.<key>"\n'
    '  resolved "https://registry.yarnpkg.com/@p/<n>/-/<n>-1.<size>.<key>.tgz#abc"\n  integrity sha512-y<key>\n'
    '  dependencies:\n    version "9.9.9"\n    "@x/y" "^1.0.0"\n\n'
    'other-<key>@2:\n  version "2.0.<key>"\n\nbroken-<key>@3:\n  resolved "https://x.example/a.tgz"\n'
)
_YARN_BERRY = (
    '__metadata:\n  version: 6\n\n"@p/<n>@npm:^1.0.0, @p/<n>@npm:~1.<size>.0":\n  version: 1.<size>.<key>\n'
    '  resolution: "real-<key>@npm:1.<size>.<key>"\n  checksum: 10c0/y<key>\n  languageName: node\n\n'
    '"w<key>@workspace:packages/w":\n  version: 0.0.0-use.local\n  resolution: "w<key>@workspace:packages/w"\n\n'
    '"pt@patch:pt@npm%3A1.0.0#./fix.patch":\n  version: 1.0.0\n'
    '  resolution: "pt@patch:pt@npm%3A1.0.0#./fix.patch::version=1.0.0"\n'
)


def _dashed(column: str) -> Column:
    return F.replace(column, F.lit(" "), F.lit("-"))


@query(
    """
    WITH p AS (SELECT p_partkey AS k, replace(p_name, ' ', '-') AS n, p_size AS s FROM part),
    sel AS (SELECT * FROM p, (VALUES (0, '^1.0.0'), (1, NULL)) v(i, r))
    SELECT 'classic' AS variant, CAST(k AS VARCHAR) AS profile_id, 'registry' AS type, '@p/' || n AS name,
           '1.' || s || '.' || k AS version,
           'https://registry.yarnpkg.com/@p/' || n || '/-/' || n || '-1.' || s || '.' || k || '.tgz#abc' AS resolved_url,
           'sha512-y' || k AS integrity, NULL AS cache_checksum,
           '@p/' || n || '@' || coalesce(r, '~1.' || s || '.0') AS selector, false AS review FROM sel
    UNION ALL SELECT 'classic', CAST(k AS VARCHAR), 'registry', 'other-' || k, '2.0.' || k,
           'https://registry.npmjs.org/other-' || k || '/-/other-' || k || '-2.0.' || k || '.tgz', NULL, NULL,
           'other-' || k || '@2', false FROM p
    UNION ALL SELECT 'berry', CAST(k AS VARCHAR), 'registry', '@p/' || n, '1.' || s || '.' || k,
           'https://registry.npmjs.org/real-' || k || '/-/real-' || k || '-1.' || s || '.' || k || '.tgz', NULL,
           '10c0/y' || k,
           CASE i WHEN 0 THEN '"@p/' || n || '@npm:^1.0.0' ELSE '@p/' || n || '@npm:~1.' || s || '.0"' END, false FROM sel
    UNION ALL SELECT 'berry', CAST(k AS VARCHAR), 'workspace', 'w' || k, '0.0.0-use.local', NULL, NULL, NULL,
           'w' || k || '@workspace:packages/w', true FROM p
    UNION ALL SELECT 'berry', CAST(k AS VARCHAR), 'patch', 'pt@patch:pt', '1.0.0', NULL, NULL, NULL,
           'pt@patch:pt@npm%3A1.0.0#./fix.patch', true FROM p
    """
)
def lock_yarn(t: Tables) -> DataFrame:
    parts = t.dealt("part", "p_partkey", "p_name", "p_size")
    rendered = parts.select(
        "p_partkey",
        F.explode(
            F.create_map(
                F.lit("classic"),
                fill(_YARN_CLASSIC, key="p_partkey", n=_dashed("p_name"), size="p_size"),
                F.lit("berry"),
                fill(_YARN_BERRY, key="p_partkey", n=_dashed("p_name"), size="p_size"),
            )
        ).alias("variant", "text"),
    )
    files = rendered.select(
        F.col("p_partkey").cast("string").alias("profile_id"),
        F.col("variant").alias("dependency_root"),
        F.lit("yarn.lock").alias("filename"),
        F.col("text").alias("content"),
    )
    return parse_yarn(files).select(
        F.col("dependency_root").alias("variant"),
        "profile_id",
        "type",
        "name",
        "version",
        "resolved_url",
        "integrity",
        "cache_checksum",
        F.col("raw_locator").alias("selector"),
        F.coalesce("manual_review", F.lit(False)).alias("review"),
    )


_PNPM = (
    "lockfileVersion: '9.0'\n\nsettings:\n  autoInstallPeers: true\n\npackages:\n\n"
    "  '@p/<n>@1.<size>.<key>':\n    resolution: {integrity: sha512-n<key>}\n    engines: {node: '>=10'}\n\n"
    "  /old-<key>@2.0.0(react@18.0.0):\n    resolution: {integrity: sha512-o<key>}\n    optional: true\n\n"
    "  tar-<key>@https://files.example/t-<key>.tgz:\n"
    "    resolution: {tarball: https://files.example/t-<key>.tgz}\n    version: 3.0.<key>\n\n"
    "  dir-<key>@file:local/d:\n    resolution: {directory: local/d, type: directory}\n\n"
    "  bad-<key>:\n    resolution: {integrity: sha512-b}\n\n"
    "patchedDependencies:\n  '@p/<n>@1.<size>.<key>':\n    hash: h<key>\n    path: patches/p<key>.patch\n\n"
    "snapshots:\n\n  '@p/<n>@1.<size>.<key>(react@<size>.0.0)':\n    dependencies:\n      react: <size>.0.0\n\n"
    "  '@p/<n>@1.<size>.<key>(react@99.0.0)':\n    dependencies:\n      react: 99.0.0\n\n"
    "  unknown-<key>@1.0.0: {}\n"
)


def _pnpm_files(t: Tables) -> DataFrame:
    parts = t.dealt("part", "p_partkey", "p_name", "p_size")
    text = fill(_PNPM, key="p_partkey", n=_dashed("p_name"), size="p_size")
    return as_files(parts, F.col("p_partkey"), "pnpm-lock.yaml", text)


@query(
    """
    WITH p AS (SELECT p_partkey AS k, replace(p_name, ' ', '-') AS n, p_size AS s FROM part)
    SELECT CAST(k AS VARCHAR) AS profile_id, 'registry' AS type, '@p/' || n AS name, '1.' || s || '.' || k AS version,
           'https://registry.npmjs.org/@p/' || n || '/-/' || n || '-1.' || s || '.' || k || '.tgz' AS resolved_url,
           'sha512-n' || k AS integrity, NULL AS path, NULL AS problem FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 'registry', 'old-' || k, '2.0.0',
           'https://registry.npmjs.org/old-' || k || '/-/old-' || k || '-2.0.0.tgz', 'sha512-o' || k, NULL, NULL FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 'http_tarball', 'tar-' || k, '3.0.' || k,
           'https://files.example/t-' || k || '.tgz', NULL, NULL, NULL FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 'local_file', 'dir-' || k, 'file:local/d', NULL, NULL, 'local/d', NULL FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 'registry', NULL, NULL, NULL, 'sha512-b', NULL,
           'unparseable pnpm package locator' FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 'patch', '@p/' || n, '1.' || s || '.' || k, NULL, NULL,
           'patches/p' || k || '.patch', 'patched dependency' FROM p
    """
)
def lock_pnpm(t: Tables) -> DataFrame:
    return parse_pnpm(_pnpm_files(t)).select(
        "profile_id", "type", "name", "version", "resolved_url", "integrity", "path", "problem"
    )


@query(
    """
    WITH p AS (SELECT p_partkey AS k, replace(p_name, ' ', '-') AS n, p_size AS s FROM part)
    SELECT CAST(k AS VARCHAR) AS profile_id, '@p/' || n AS name,
           '@p/' || n || '@1.' || s || '.' || k || '(react@' || s || '.0.0)' AS snapshot_locator,
           '{"dependencies":{"react":"' || s || '.0.0"}}' AS snapshot FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), v.x || k, NULL, NULL FROM p, (VALUES ('old-'), ('tar-'), ('dir-')) v(x)
    """
)
def snapshot_attach(t: Tables) -> DataFrame:
    references = reference_rows(parse_pnpm_with_snapshots(_pnpm_files(t)))
    return references.select("profile_id", "name", "snapshot_locator", "snapshot")


_BUN = (
    "// generated\n{\n  lockfileVersion: 1, /* v1 */\n  packages: {\n"
    "    \"@p/<n>\": [\"@p/<n>@1.<size>.<key>\", \"\", { dependencies: { x: '^1', }, }, \"sha512-u<key>\",],\n"
    "    \"web-<key>\": [\"web-<key>@2.0.0\", \"\", { \"tarball\": \"https://files.example/w,<key>.tgz\", \"optional\": true }],\n"
    '    "ws-<key>": ["ws-<key>@workspace:packages/ws"],\n'
    '    "@g/git": ["@g/git@github:own/repo-<key>#<size>", {}, "own-repo"], // pinned ]\n'
    '    "nothing": [],\n  },\n}\n'
)


@query(
    """
    WITH p AS (SELECT p_partkey AS k, replace(p_name, ' ', '-') AS n, p_size AS s FROM part)
    SELECT CAST(k AS VARCHAR) AS profile_id, 0 AS pos, 'registry' AS type, '@p/' || n AS name,
           '1.' || s || '.' || k AS version,
           'https://registry.npmjs.org/@p/' || n || '/-/' || n || '-1.' || s || '.' || k || '.tgz' AS resolved_url,
           'sha512-u' || k AS integrity, NULL AS path, false AS optional, NULL AS problem FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 1, 'http_tarball', 'web-' || k, '2.0.0',
           'https://files.example/w,' || k || '.tgz', NULL, NULL, true, NULL FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 2, 'workspace', 'ws-' || k, 'workspace:packages/ws', NULL, NULL,
           'packages/ws', false, NULL FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 3, 'git', '@g/git', 'github:own/repo-' || k || '#' || s,
           'github:own/repo-' || k || '#' || s, NULL, NULL, false, NULL FROM p
    UNION ALL SELECT CAST(k AS VARCHAR), 4, 'registry', NULL, NULL, NULL, NULL, NULL, false,
           'unparseable Bun package entry' FROM p
    """
)
def lock_bun(t: Tables) -> DataFrame:
    parts = t.dealt("part", "p_partkey", "p_name", "p_size")
    text = fill(_BUN, key="p_partkey", n=_dashed("p_name"), size="p_size")
    return parse_bun(as_files(parts, F.col("p_partkey"), "bun.lock", text)).select(
        "profile_id", "pos", "type", "name", "version", "resolved_url", "integrity", "path", "optional", "problem"
    )


@query(
    """
    WITH p AS (SELECT p_partkey AS k, ['npm', 'pnpm', 'yarn', 'bun', 'cargo'][(p_partkey % 5 + 1)::INT] AS m,
                      p_partkey % 13 = 0 AS broken FROM part)
    SELECT 'reference' AS kind, CAST(k AS VARCHAR) AS profile_id, m AS package_manager, 'pk-' || k AS name,
           '1.0.' || k AS version, NULL AS reason FROM p WHERE m <> 'cargo' AND NOT broken
    UNION ALL SELECT 'issue', CAST(k AS VARCHAR), m, NULL, NULL, 'lockfile parse failed' FROM p
           WHERE m IN ('npm', 'pnpm', 'bun') AND broken
    UNION ALL SELECT 'issue', CAST(k AS VARCHAR), m, NULL, NULL, 'unsupported package manager: cargo' FROM p
           WHERE m = 'cargo'
    """
)
def lock_all(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    manager = pick(key, "npm", "pnpm", "yarn", "bun", "cargo")
    good = (
        F.when(manager == "npm", fill('{"packages":{"node_modules/pk-<k>":{"version":"1.0.<k>"}}}', k=key))
        .when(manager == "pnpm", fill("packages:\n  pk-<k>@1.0.<k>: {}\n", k=key))
        .when(manager == "yarn", fill('pk-<k>@^1:\n  version "1.0.<k>"\n', k=key))
        .otherwise(fill('{packages: {"pk-<k>": ["pk-<k>@1.0.<k>",],}}', k=key))
    )
    text = F.when(key % 13 == 0, "{[ <<<<<<< HEAD").otherwise(good)
    locks = as_files(t.dealt("part", "p_partkey"), key, manager, text, manager.alias("package_manager"))
    parsed = parse_locks(locks)
    manager_of = F.col("filename").alias("package_manager")
    references = reference_rows(parsed).select(
        F.lit("reference").alias("kind"), "profile_id", manager_of, "name", "version", F.lit(None).cast("string").alias("reason")
    )
    problems = parsed.filter(F.col("problem").isNotNull()).select(
        F.lit("issue").alias("kind"), "profile_id", manager_of, "name", "version", F.col("problem").alias("reason")
    )
    return references.unionByName(problems)


@query(
    """
    WITH u AS (SELECT page_id AS k, url AS u FROM pages)
    SELECT CAST(k AS VARCHAR) AS profile_id, 'plain' AS name, u AS specifier,
           'http_tarball' AS type, false AS dev, false AS optional, u AS resolved_url FROM u
    UNION ALL SELECT CAST(k AS VARCHAR), 'vcs', 'git+' || u, CASE WHEN u LIKE 'https:%' THEN 'git' ELSE 'unknown' END,
           true, false, CASE WHEN u LIKE 'https:%' THEN 'git+' || u END FROM u
    UNION ALL SELECT CAST(k AS VARCHAR), 'local', 'file:' || u, 'local_file', false, true, NULL FROM u
    UNION ALL SELECT CAST(k AS VARCHAR), 'member', 'workspace:' || u, 'workspace', false, false, NULL FROM u
    """
)
def manifest_specs(t: Tables) -> DataFrame:
    pages = t.dealt("pages", "page_id", "url")
    text = fill(
        '{"name":"app","dependencies":{"plain":"<u>","range":"^1.0.0","n":5},"devDependencies":{"vcs":"git+<u>"},'
        '"optionalDependencies":{"local":"file:<u>"},"peerDependencies":{"member":"workspace:<u>"}}',
        u="url",
    )
    files = as_files(pages, F.col("page_id"), "package.json", text)
    return reference_rows(parse_manifests(files)).select(
        "profile_id", "name", "specifier", "type", "dev", "optional", "resolved_url"
    )


_DOCKERFILE = (
    "# build image \\\nFROM node:<major>.<nation>-slim\n\nRUN npm install -g pnpm@9.<nation>.0 && corepack prepare yarn@4.<major>.1\n"
    "RUN yarn set version 3.<nation>\nWORKDIR /testbed\nWORKDIR apps/../pkg<nation>\n"
    "RUN --mount=type=cache,target=/x pnpm install \\\n  # note\\\n  --frozen-lockfile \\\n\n"
    "RUN (cd client<key> && npm ci) && npm --prefix /mnt/side i ; make bootstrap\n"
    "RUN pnpm --filter ./web... install | tee log\nRUN sed -i s/a/b/ package.json\nENV A=1\nFROM node:<nation>\n"
)


def _instructions(t: Tables) -> DataFrame:
    customers = t.dealt("customer", "c_custkey", "c_nationkey")
    text = fill(_DOCKERFILE, key="c_custkey", nation="c_nationkey", major=F.col("c_custkey") % 7 + 14)
    return dockerfile_instructions(
        customers.select(F.col("c_custkey").cast("string").alias("profile_id"), text.alias("text"))
    )


@query(
    """
    WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_custkey % 7 + 14 AS m FROM customer)
    SELECT CAST(k AS VARCHAR) AS profile_id, v.line, v.keyword,
           replace(replace(replace(v.value, '<n>', CAST(n AS VARCHAR)), '<m>', CAST(m AS VARCHAR)), '<k>', CAST(k AS VARCHAR)) AS value,
           replace(v.directory, '<n>', CAST(n AS VARCHAR)) AS directory
    FROM c, (VALUES
      (2, 'FROM', 'node:<m>.<n>-slim', '.'),
      (4, 'RUN', 'npm install -g pnpm@9.<n>.0 && corepack prepare yarn@4.<m>.1', '.'),
      (5, 'RUN', 'yarn set version 3.<n>', '.'),
      (6, 'WORKDIR', '/testbed', '.'),
      (7, 'WORKDIR', 'apps/../pkg<n>', '.'),
      (8, 'RUN', '--mount=type=cache,target=/x pnpm install # note --frozen-lockfile', 'pkg<n>'),
      (12, 'RUN', '(cd client<k> && npm ci) && npm --prefix /mnt/side i ; make bootstrap', 'pkg<n>'),
      (13, 'RUN', 'pnpm --filter ./web... install | tee log', 'pkg<n>'),
      (14, 'RUN', 'sed -i s/a/b/ package.json', 'pkg<n>'),
      (15, 'ENV', 'A=1', 'pkg<n>'),
      (16, 'FROM', 'node:<n>', 'pkg<n>')) v(line, keyword, value, directory)
    """
)
def dockerfile_instr(t: Tables) -> DataFrame:
    return _instructions(t).select("profile_id", "line", "keyword", "value", "directory")


@query(
    """
    WITH c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer)
    SELECT CAST(k AS VARCHAR) AS profile_id,
           replace(replace(v.root, '<n>', CAST(n AS VARCHAR)), '<k>', CAST(k AS VARCHAR)) AS dependency_root,
           v.manager AS package_manager, v.line,
           replace(v.fragment, '<k>', CAST(k AS VARCHAR)) AS fragment
    FROM c, (VALUES
      ('pkg<n>', 'pnpm', 8, 'pnpm install # note --frozen-lockfile'),
      ('pkg<n>/client<k>', 'npm', 12, 'npm ci'),
      ('side', 'npm', 12, 'npm --prefix /mnt/side i'),
      ('pkg<n>', NULL, 12, 'make bootstrap'),
      ('pkg<n>/web', 'pnpm', 13, 'pnpm --filter ./web... install')) v(root, manager, line, fragment)
    """
)
def install_commands(t: Tables) -> DataFrame:
    return found_installs(_instructions(t)).select(
        "profile_id", "dependency_root", "package_manager", "line", "fragment"
    )


@query(
    """
    WITH c AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer)
    SELECT CAST(k AS VARCHAR) AS profile_id,
           replace(replace(v.root, '<n>', CAST(n AS VARCHAR)), '<k>', CAST(k AS VARCHAR)) AS dependency_root,
           v.manager AS package_manager, replace(v.commands, '<k>', CAST(k AS VARCHAR)) AS commands
    FROM c, (VALUES
      ('pkg<n>', 'pnpm', 'pnpm install # note --frozen-lockfile | (cd client<k> && npm ci) && npm --prefix /mnt/side i ; make bootstrap'),
      ('pkg<n>/client<k>', 'npm', '(cd client<k> && npm ci) && npm --prefix /mnt/side i ; make bootstrap'),
      ('side', 'npm', '(cd client<k> && npm ci) && npm --prefix /mnt/side i ; make bootstrap'),
      ('pkg<n>/web', 'pnpm', 'pnpm --filter ./web... install | tee log')) v(root, manager, commands)
    """
)
def install_root_rollup(t: Tables) -> DataFrame:
    roots = install_roots(found_installs(_instructions(t)))
    return roots.select(
        "profile_id", "dependency_root", "package_manager", F.array_join("install_commands", " | ").alias("commands")
    )


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS profile_id, 'pkg' || c_nationkey AS dependency_root, 14 AS line,
           'sed -i s/a/b/ package.json' AS command FROM customer
    """
)
def manifest_edits(t: Tables) -> DataFrame:
    return found_edits(_instructions(t)).select("profile_id", "dependency_root", "line", "command")


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS profile_id, 'node' AS tool, CAST(c_nationkey AS VARCHAR) AS version FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'pnpm', '9.' || c_nationkey || '.0' FROM customer
    UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'yarn', '3.' || c_nationkey FROM customer
    """
)
def explicit_versions(t: Tables) -> DataFrame:
    return tool_versions(_instructions(t)).select("profile_id", "tool", "version")


@query(
    """
    WITH c AS (SELECT c_custkey AS k, c_nationkey AS n, c_custkey % 7 + 14 AS m FROM customer),
    v AS (SELECT * FROM (VALUES
      (NULL, 'node_image', 2, 'node:<m>.<n>-slim'),
      (NULL, 'node_image', 16, 'node:<n>'),
      (NULL, 'package_manager_version', 4, 'npm install -g pnpm@9.<n>.0'),
      (NULL, 'package_manager_version', 4, 'corepack prepare yarn@4.<m>.1'),
      (NULL, 'package_manager_version', 5, 'yarn set version 3.<n>'),
      ('pkg<n>', 'install_command', 8, 'pnpm install # note --frozen-lockfile'),
      ('pkg<n>/client<k>', 'install_command', 12, 'npm ci'),
      ('side', 'install_command', 12, 'npm --prefix /mnt/side i'),
      ('pkg<n>', 'install_command', 12, 'make bootstrap'),
      ('pkg<n>/web', 'install_command', 13, 'pnpm --filter ./web... install'),
      ('.', 'package_json_package_manager', NULL, 'pnpm@9.<n>.1'),
      ('.', 'dependency_file', NULL, 'package.json')) x(root, kind, line, value))
    SELECT CAST(k AS VARCHAR) AS profile_id,
           replace(replace(v.root, '<n>', CAST(n AS VARCHAR)), '<k>', CAST(k AS VARCHAR)) AS dependency_root, v.kind, coalesce(v.line, 0) AS line,
           replace(replace(v.value, '<n>', CAST(n AS VARCHAR)), '<m>', CAST(m AS VARCHAR)) AS value FROM c, v
    """
)
def evidence_union(t: Tables) -> DataFrame:
    instructions = _instructions(t)
    manifest = fill('{"packageManager":"pnpm@9.<n>.1+sha1.x"}', n="c_nationkey")
    files = as_files(t.dealt("customer", "c_custkey", "c_nationkey"), F.col("c_custkey"), "package.json", manifest)
    evidence = evidence_rows(instructions, found_installs(instructions), files)
    return evidence.withColumn("line", F.coalesce("line", F.lit(0)))


@query(
    """
    WITH u AS (SELECT page_id AS k, url AS u FROM pages)
    SELECT 'dependency' AS source, CAST(k AS VARCHAR) AS profile_id, 'vcs' AS name, 'git+' || u AS specifier,
           'unknown' AS type, 'lockfile entry requires manual review' AS reason FROM u WHERE u LIKE 'http:%'
    UNION ALL SELECT 'file', CAST(k AS VARCHAR), NULL, NULL, NULL, 'invalid package.json' FROM u WHERE u LIKE 'http:%'
    """
)
def manifest_issues(t: Tables) -> DataFrame:
    pages = t.dealt("pages", "page_id", "url")
    insecure = F.startswith("url", F.lit("http:"))
    good = as_files(
        pages, F.col("page_id"), "package.json", fill('{"dependencies":{"vcs":"git+<u>"}}', u="url")
    )
    cut = F.when(insecure, fill('{"dependencies":{"vcs":"<u>', u="url")).otherwise(F.lit("{}"))
    broken = as_files(pages, F.col("page_id"), "package.json", cut)

    def issues(files: DataFrame, source: str) -> DataFrame:
        return issue_rows(parse_manifests(files)).select(
            F.lit(source).alias("source"), "profile_id", "name", "specifier", "type", "reason"
        )

    return issues(good, "dependency").unionByName(issues(broken, "file"))


@query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS profile_id, CASE WHEN p_partkey % 5 = 1 THEN 's-?' WHEN p_partkey % 5 = 4 THEN 'ok' END AS name,
           CASE WHEN p_partkey % 5 IN (0, 2, 3) THEN 'lockfile parse failed' END AS reason FROM part
    """
)
def bad_locks(t: Tables) -> DataFrame:
    """Single quotes, a lone surrogate, an impossible date, a date as a key: a bad file is an issue, not an end."""
    key = F.col("p_partkey")
    text = pick(
        key,
        '{"lockfileVersion":1,"dependencies":{\'a\':{"version":"1.0.0"}}}',
        '{"lockfileVersion":1,"dependencies":{"s-\\ud800":{"version":"1.0.0"}}}',
        "packages:\n  d@1.0.0:\n    resolution: {integrity: 2020-13-45}\n",
        "packages:\n  d@1.0.0:\n    2020-01-02: x\n",
        "packages:\n  ok@1.0.0: {}\n",
    )
    manager = pick(key, "npm", "npm", "pnpm", "pnpm", "pnpm")
    parsed = parse_locks(as_files(t.dealt("part", "p_partkey"), key, manager, text, manager.alias("package_manager")))
    return parsed.select("profile_id", "name", F.col("problem").alias("reason"))
