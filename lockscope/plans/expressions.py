"""Column expressions over the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.choices import (
    authority_reason,
    choose_manager,
    choose_version,
    json_lock_problem,
    lock_changed as is_changed,
    resolution_class,
    resolver_command,
    retry_flag,
    strict_install,
    yarn_variant as variant_of,
)
from ..functions.integrity import blob_is_valid, blob_path, metadata_name, sri_matches
from ..functions.paths import (
    join_workdir,
    normal_path,
    option_workdir,
    relative_workdir,
    root_directory_name,
    safe_profile_id,
)
from ..functions.specs import classify_spec, git_archive, git_repository, registry_url, split_package_manager
from ..functions.versions import host_allows, version_matches
from ..operators.profiles import index_profiles
from ..operators.reports import distribution
from ..sources.readers import candidate_names, describe_files, profile_id_problems
from .registry import Tables, fill, pick, query


@query(
    """
    WITH v AS (SELECT url, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS i FROM pages),
    c AS (SELECT CASE i WHEN 0 THEN 'http_tarball'
                        WHEN 1 THEN CASE WHEN url LIKE 'https:%' THEN 'git' ELSE 'unknown' END
                        WHEN 2 THEN 'local_file' WHEN 3 THEN 'workspace' WHEN 4 THEN 'patch' WHEN 5 THEN 'registry'
                        WHEN 6 THEN CASE WHEN contains(url, '#') THEN 'git' ELSE 'http_tarball' END
                        WHEN 7 THEN 'registry' ELSE 'unknown' END AS value FROM v)
    SELECT value, count(*) AS count FROM c GROUP BY value
    """
)
def protocol_mix(t: Tables) -> DataFrame:
    def host(name: str) -> Column:
        return F.regexp_replace("url", "^(https?)://[^/]+", f"$1://{name}")

    variants = [
        F.col("url"),
        F.concat(F.lit("git+"), "url"),
        F.concat(F.lit(" FILE:"), "url"),
        F.concat(F.lit("workspace:"), "url"),
        F.concat(F.lit("patch:"), "url"),
        F.concat(F.lit("npm:"), "url"),
        host("user@GitHub.com:443"),
        host("registry.npmjs.org"),
        F.concat(F.lit("catalog:"), "url"),
    ]
    specs = t.dealt("pages", "url").select(F.explode(F.array(*variants)).alias("spec"))
    return distribution(specs.select(classify_spec(F.col("spec")).alias("type")), "type")


@query(
    """
    WITH p AS (SELECT p_partkey AS k, lower(replace(p_brand, '#', '-')) AS b, replace(p_name, ' ', '_') AS n FROM part)
    SELECT k, 'https://registry.npmjs.org/@' || b || '/' || n || '/-/' || n || '-1.' || k || '.0-rc%2B' || k || '%20x.tgz' AS url,
           CASE WHEN k % 3 = 0 THEN 'https://mirror.example/' || n ELSE
           'https://registry.npmjs.org/' || n || '%2A~/-/' || n || '*~-' || k || '.tgz' END AS other FROM p
    """
)
def registry_urls(t: Tables) -> DataFrame:
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("-")))
    scoped = F.concat(F.lit("@"), brand, F.lit("/"), F.col("n"))
    source = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("https://mirror.example/"), F.col("n"))).otherwise("x")
    return t.part.withColumn("n", F.replace("p_name", F.lit(" "), F.lit("_"))).select(
        F.col("p_partkey").alias("k"),
        registry_url(scoped, fill("1.<k>.0-rc+<k> x", k="p_partkey")).alias("url"),
        registry_url(F.concat("n", F.lit("*~")), F.col("p_partkey").cast("string"), source).alias("other"),
    )


@query(
    """
    WITH s AS (SELECT c_custkey AS k, unnest([0, 1, 2, 3, 4, 5, 6]) AS i FROM customer)
    SELECT k, i,
           CASE WHEN i < 4 THEN 'https://codeload.github.com/own' || k || '/repo' || k || '/tar.gz/v' || k
                WHEN i = 4 THEN 'https://codeload.github.com/own' || k || '/repo' || k || '/tar.gz/HEAD'
                WHEN i = 5 THEN 'https://gist.github.com/id' || k || '/archive/c' || k || '.tar.gz' ELSE '' END AS archive_url,
           CASE WHEN i < 4 THEN 'v' || k WHEN i = 4 THEN 'HEAD' WHEN i = 5 THEN 'c' || k ELSE 'v' || k END AS ref,
           CASE WHEN i < 5 THEN 'github:own' || k || '/repo' || k WHEN i = 5 THEN 'gist:id' || k END AS alias,
           CASE i WHEN 0 THEN 'https://github.com/own' || k || '/repo' || k
                  WHEN 1 THEN 'https://git@github.com/own' || k || '/repo' || k || '.git'
                  WHEN 2 THEN 'https://github.com/own' || k || '/repo' || k || '.git'
                  WHEN 3 THEN 'https://www.github.com/own' || k || '/repo' || k || '/'
                  WHEN 4 THEN 'https://github.com/own' || k || '/repo' || k || '.git'
                  WHEN 5 THEN 'https://git@gist.github.com/id' || k || '.git'
                  ELSE 'https://gitlab.com/own' || k || '/repo' || k || '.git' END AS repository_url
    FROM s
    """
)
def git_urls(t: Tables) -> DataFrame:
    spellings = [
        "github:own<k>/repo<k>#v<k>",
        "git+ssh://git@github.com/own<k>/repo<k>.git#v<k>",
        "git://github.com/own<k>/repo<k>.git#v<k>",
        "https://www.github.com/own<k>/repo<k>/#v<k>",
        "git+https://github.com/own<k>/repo<k>.git",
        "git+ssh://git@gist.github.com/id<k>.git#c<k>",
        "git+https://gitlab.com/own<k>/repo<k>.git#v<k>",
    ]
    sources = F.array(*[fill(s, k="c_custkey") for s in spellings])
    customers = t.dealt("customer", "c_custkey")
    rows = customers.select(F.col("c_custkey").alias("k"), F.posexplode(sources).alias("i", "source"))
    split = rows.withColumns({"a": git_archive(F.col("source")), "r": git_repository(F.col("source"))})
    return split.select("k", "i", "a.archive_url", "a.ref", "a.alias", "r.repository_url")


@query(
    """
    WITH p AS (SELECT page_id AS k, rtrim(regexp_replace(regexp_replace(url, '^https?://', ''), '[?#].*$', ''), '/') AS p FROM pages)
    SELECT k, p AS dotted, '/' || p AS absolute, p AS relative, '../' || p AS above, 'sub/' || p AS joined,
           p AS replaced, p AS by_option, 'sub/' || p AS by_filter, replace(p, '/', '__') AS stored FROM p
    """
)
def path_normalise(t: Tables) -> DataFrame:
    bare = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", "")
    rows = t.pages.select(F.col("page_id").alias("k"), F.rtrim(bare, F.lit("/")).alias("p"), bare.alias("q"))
    return rows.select(
        "k",
        normal_path(F.concat(F.lit("./x/../"), F.col("q"))).alias("dotted"),
        normal_path(F.concat(F.lit("/../"), F.replace("q", F.lit("/"), F.lit("//")), F.lit("/."))).alias("absolute"),
        relative_workdir(F.concat(F.lit("/testbed/"), F.col("q"))).alias("relative"),
        normal_path(F.concat(F.lit("a/../../"), F.col("q"))).alias("above"),
        join_workdir(F.lit("sub"), F.concat(F.lit('"'), F.col("p"), F.lit('"'))).alias("joined"),
        join_workdir(F.lit("sub"), F.concat(F.lit("/repo/"), F.col("p"))).alias("replaced"),
        option_workdir(fill(" --prefix /mnt/<p>", p="p"), F.lit("sub")).alias("by_option"),
        option_workdir(fill(" --filter ./<p>...", p="p"), F.lit("sub")).alias("by_filter"),
        root_directory_name(F.col("p")).alias("stored"),
    )


@query(
    """
    WITH i AS (SELECT CASE c_custkey % 7
                        WHEN 3 THEN 'swesmith/own' || c_custkey || '_repo.' || substr(md5(c_name), 1, 8)
                        WHEN 5 THEN 'swesmith/own__r ' || (c_custkey // 14) || '.0123abcd'
                        ELSE 'swesmith/' || c_mktsegment || '__r' || c_custkey || '.' || substr(md5(c_name), 1, 8) END AS id
               FROM customer)
    SELECT id AS profile_id, count(*) AS times,
           CASE WHEN NOT regexp_full_match(id, 'swesmith/[^/]+__[^/]+\\.[0-9a-f]{8}') THEN 'invalid profile ID'
                ELSE 'duplicate profile ID' END AS reason,
           replace(replace(id, 'swesmith/', ''), ' ', '_') AS safe_id
    FROM i GROUP BY id HAVING count(*) > 1 OR NOT regexp_full_match(id, 'swesmith/[^/]+__[^/]+\\.[0-9a-f]{8}')
    """
)
def id_quality(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    values = {"k": key, "s": "c_mktsegment", "h": F.substring(F.md5("c_name"), 1, 8), "d": F.floor(key / 14)}
    ids = t.customer.select(
        F.when(key % 7 == 3, fill("swesmith/own<k>_repo.<h>", **values))
        .when(key % 7 == 5, fill("swesmith/own__r <d>.0123abcd", **values))
        .otherwise(fill("swesmith/<s>__r<k>.<h>", **values))
        .alias("profile_id")
    )
    problems = profile_id_problems(ids)
    return problems.withColumn("safe_id", safe_profile_id(F.col("profile_id")))


@query(
    """
    WITH d AS (SELECT doc_id, ['package.json', '.npmrc', '.yarnrc', '.yarnrc.yml', 'pnpm-workspace.yaml', 'bunfig.toml',
                      '.nvmrc', '.node-version', 'package-lock.json', 'npm-shrinkwrap.json', 'pnpm-lock.yaml', 'yarn.lock',
                      'bun.lock', 'bun.lockb', 'README.md'][(doc_id % 15 + 1)::INT] AS f, text FROM documents)
    SELECT 'p' || doc_id AS profile_id, CASE doc_id % 2 WHEN 0 THEN '.' ELSE 'apps/web' END AS dependency_root,
           f AS filename, sha256(text) AS sha256, octet_length(encode(text)) AS size_bytes
    FROM d WHERE f <> 'README.md'
    """
)
def file_manifest(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    name = pick(key, *candidate_names(), "README.md")
    path = F.concat(F.lit("file:/base/p"), key.cast("string"), F.lit("/"), pick(key, "root", "apps__web"), F.lit("/"), name)
    raw = t.documents.select("doc_id", "text").select(path.alias("path"), F.encode("text", "UTF-8").alias("content"))
    return describe_files(raw).drop("content")


@query(
    """
    SELECT doc_id, doc_id % 7 <> 0 AND doc_id % 11 <> 0 AS matches,
           doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 5 <> 0 AS valid FROM documents
    """
)
def sri_verify(t: Tables) -> DataFrame:
    key, text = F.col("doc_id"), F.col("text")
    algorithm = pick(key, "sha512", "sha256", "sha384", "sha1")
    digest = (
        F.when(key % 4 == 0, F.sha2(text, 512))
        .when(key % 4 == 1, F.sha2(text, 256))
        .when(key % 4 == 2, F.sha2(text, 384))
        .otherwise(F.sha1(text))
    )
    wrong_or_right = F.when(key % 7 == 0, F.reverse(digest)).otherwise(digest)
    encoded = F.regexp_replace(F.base64(F.unhex(wrong_or_right)), "\\s", "")
    body = F.when(key % 11 == 0, F.concat(F.lit("!"), encoded)).otherwise(encoded)
    rows = t.documents.select("doc_id", "text").select(
        key,
        F.encode("text", "UTF-8").alias("content"),
        F.concat(algorithm, F.lit("-"), body, F.lit(" sha1-ignored")).alias("integrity"),
        F.when(key % 5 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.sha2(text, 256)).alias("content_sha256"),
    )
    return rows.select(
        "doc_id",
        sri_matches(F.col("content"), F.col("integrity")).alias("matches"),
        blob_is_valid(F.col("content"), F.col("integrity"), F.col("content_sha256")).alias("valid"),
    )


@query(
    """
    WITH d AS (SELECT doc_id, sha256(text) AS h, 'url:https://x.example/a?b#' || repeat(lang, (doc_id % 90)::INT) AS id FROM documents)
    SELECT doc_id,
           CASE doc_id % 4 WHEN 0 THEN 'blobs/sha256/' || h WHEN 1 THEN 'blobs/sha256/' || h
                           WHEN 2 THEN 'blobs/sha256/' || sha256(id) ELSE 'blobs/sha256/' || sha256(h) END AS path,
           CASE WHEN length(id) > 140
                THEN substr(replace(replace(replace(replace(id, '/', '_'), ':', '_'), '?', '_'), '#', '_'), 1, 64) || '_' || sha256(id)
                ELSE replace(replace(replace(replace(id, '/', '_'), ':', '_'), '?', '_'), '#', '_') END AS metadata FROM d
    """
)
def blob_paths(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    rows = t.documents.select("doc_id", "text", "lang").select(
        key,
        F.sha2("text", 256).alias("h"),
        F.concat(F.lit("url:https://x.example/a?b#"), F.expr("repeat(lang, int(doc_id % 90))")).alias("id"),
    )
    sri = F.when(key % 4 == 0, F.concat(F.lit("sha256-"), F.base64(F.unhex("h")))).when(
        key % 4 != 2, F.concat(F.lit("sha256-"), F.col("h"), F.lit("="))
    )
    content = F.when(key % 4 == 1, F.col("h")).when(key % 4 == 3, F.sha2("h", 256))
    return rows.select(
        "doc_id",
        blob_path(F.col("id"), sri, content).alias("path"),
        metadata_name(F.col("id")).alias("metadata"),
    )


@query(
    """
    SELECT p_partkey AS k,
           CASE p_type WHEN 'PROMO' THEN false WHEN 'SMALL' THEN true WHEN 'LARGE' THEN false WHEN 'MEDIUM' THEN true
                       ELSE true END AS os_ok,
           p_size % 2 = 0 OR p_type = 'MEDIUM' AS cpu_ok FROM part
    """
)
def host_constraint(t: Tables) -> DataFrame:
    words = (
        F.when(F.col("p_type") == "PROMO", F.array(F.lit("!Linux"), F.lit("linux")))
        .when(F.col("p_type") == "SMALL", F.array(F.lit("!win32")))
        .when(F.col("p_type") == "LARGE", F.array(F.lit("darwin"), F.lit("win32")))
        .when(F.col("p_type") == "ECONOMY", F.array(F.lit("LINUX"), F.lit("darwin")))
    )
    cpu = F.when(
        F.col("p_type") != "MEDIUM", F.array(F.when(F.col("p_size") % 2 == 0, F.lit("x64")).otherwise(F.lit("arm64")))
    )
    return t.part.select(
        F.col("p_partkey").alias("k"),
        host_allows(words, ["linux"]).alias("os_ok"),
        host_allows(cpu, ["x64", "x86_64"]).alias("cpu_ok"),
    )


@query(
    """
    WITH v AS (SELECT p_partkey AS k, p_partkey % 30 AS a, p_partkey % 7 AS b, p_size AS c FROM part)
    SELECT k, true AS full_match, true AS prefix, b = 3 AS minor, true AS anything, false AS nothing FROM v
    """
)
def version_match(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    rows = t.part.select(key.alias("k"), (key % 30).alias("a"), (key % 7).alias("b"), F.col("p_size").alias("c"))
    actual = fill("node v<a>.<b>.<c>", a="a", b="b", c="c")
    return rows.select(
        "k",
        version_matches(actual, fill("<a>.<b>.<c>", a="a", b="b", c="c")).alias("full_match"),
        version_matches(actual, fill("v<a>", a="a")).alias("prefix"),
        version_matches(actual, fill("<a>.3", a="a")).alias("minor"),
        version_matches(F.lit("none"), F.lit("")).alias("anything"),
        version_matches(F.lit("none"), actual).alias("nothing"),
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'unresolved merge in the lock'
                          WHEN event_type = 'click' THEN 'invalid JSON' WHEN json_valid(props) THEN NULL
                          ELSE 'invalid JSON' END AS problem FROM events
    """
)
def lock_validity(t: Tables) -> DataFrame:
    text = (
        F.when(F.col("event_type") == "error", F.concat("props", F.lit("\n<<<<<<< HEAD\n")))
        .when(F.col("event_type") == "click", F.concat("props", F.lit(",}")))
        .otherwise(F.col("props"))
    )
    return t.events.select("event_id", json_lock_problem(text).alias("problem"))


@query(
    """
    WITH e AS (SELECT event_id, ['npm', 'pnpm', 'yarn', 'bun', 'cargo'][(event_id % 5 + 1)::INT] AS m, event_type AS t,
                      event_id % 6 = 0 AS no_lock FROM events)
    SELECT event_id, m AS manager,
           CASE WHEN no_lock THEN 'the root has no lock'
                WHEN t = 'view' AND m IN ('npm', 'pnpm', 'yarn') THEN 'strict install: the lock must not change'
                ELSE 'the install command may rewrite the lock' END AS reason,
           CASE WHEN t = 'error' AND m = 'npm' AND NOT no_lock THEN 'unsupported_or_manual_review'
                WHEN t = 'view' AND m IN ('npm', 'pnpm', 'yarn') AND NOT no_lock THEN 'authoritative_existing'
                WHEN m = 'cargo' THEN 'unsupported_or_manual_review'
                WHEN no_lock THEN 'missing_requires_resolution' ELSE 'existing_requires_resolution' END AS classification,
           CASE m WHEN 'npm' THEN 'npm install --package-lock-only --ignore-scripts'
                  WHEN 'pnpm' THEN 'pnpm install --lockfile-only --ignore-scripts'
                  WHEN 'bun' THEN 'bun install --lockfile-only'
                  WHEN 'yarn' THEN CASE WHEN t = 'click' THEN 'yarn install --mode=update-lockfile'
                                        WHEN t = 'signup' THEN 'yarn install --mode=update-lockfile'
                                        ELSE 'yarn install --ignore-scripts' END END AS command
    FROM e
    """
)
def authority_class(t: Tables) -> DataFrame:
    key, kind = F.col("event_id"), F.col("event_type")
    manager = pick(key, "npm", "pnpm", "yarn", "bun", "cargo")
    lockfile = F.when(
        key % 6 != 0, pick(key, "package-lock.json", "pnpm-lock.yaml", "yarn.lock", "bun.lock", "Cargo.lock")
    )
    strict_text = pick(
        key, "npm --prefix client ci", "pnpm i --frozen-lockfile", "yarn install --IMMUTABLE", "bun ci", "cargo build"
    )
    commands = F.array(F.lit("echo start"), F.when(kind == "view", strict_text).otherwise(F.concat(manager, F.lit(" install"))))
    strict = strict_install(manager, commands)
    problem = F.when(kind == "error", F.lit("invalid JSON"))
    variant = F.when(kind == "click", F.lit("berry")).when(kind != "signup", F.lit("classic"))
    return t.events.select(
        "event_id",
        manager.alias("manager"),
        authority_reason(lockfile, strict).alias("reason"),
        resolution_class(manager, lockfile, problem, strict).alias("classification"),
        resolver_command(manager, variant, F.lit("4.1.0")).alias("command"),
    )


@query(
    """
    SELECT doc_id, doc_id % 5 = 0 OR doc_id % 9 = 0 AS changed FROM documents
    """
)
def lock_changed(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    source = F.when(key % 9 != 0, F.sha2("text", 256))
    resolved = F.sha2(F.when(key % 5 == 0, F.concat("text", F.lit("\n"))).otherwise(F.col("text")), 256)
    return t.documents.select("doc_id", "text").select("doc_id", is_changed(source, resolved).alias("changed"))


@query(
    """
    WITH c AS (SELECT 'o' || (c_custkey // 2) AS owner, 'r' || c_nationkey AS repo,
                      CASE WHEN c_custkey % 10 = 0 THEN 'short' ELSE sha1(CAST(c_custkey // 2 AS VARCHAR)) END AS commit,
                      c_custkey, c_mktsegment FROM customer)
    SELECT owner || '__' || repo || '.' || substr(commit, 1, 8) AS profile_key,
           arg_max(c_mktsegment, c_custkey) AS language, max(c_custkey) AS ord
    FROM c WHERE length(commit) = 40 GROUP BY 1
    """
)
def profile_index(t: Tables) -> DataFrame:
    half = F.floor(F.col("c_custkey") / 2).cast("string")
    rows = t.customer.select(
        F.concat(F.lit("o"), half).alias("owner"),
        F.concat(F.lit("r"), F.col("c_nationkey").cast("string")).alias("repo"),
        F.when(F.col("c_custkey") % 10 == 0, "short").otherwise(F.sha1(half)).alias("commit"),
        F.col("c_custkey").alias("ord"),
        F.col("c_mktsegment").alias("language"),
    )
    return index_profiles(rows).select("profile_key", "language", "ord")


@query(
    """
    WITH p AS (SELECT p_partkey AS k, p_size AS s, p_partkey % 6 AS i FROM part)
    SELECT k, CASE i WHEN 0 THEN 'pnpm' WHEN 1 THEN 'yarn' WHEN 2 THEN 'npm' END AS field_manager,
           CASE i WHEN 0 THEN '9.' || s WHEN 1 THEN '4.' || s || '.0' WHEN 2 THEN '10.' || s END AS field_version,
           CASE WHEN s % 10 = 0 THEN 'explicit' WHEN i = 0 THEN '9.' || s END AS version FROM p
    """
)
def version_choice(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    manifest = F.get(
        F.array(
            fill('{"packageManager":"pnpm@9.<s>"}', s="p_size"),
            fill('{"packageManager":"yarn@4.<s>.0+sha224.abc"}', s="p_size"),
            fill('{"packageManager":"npm@10.<s>"}', s="p_size"),
            F.lit('{"packageManager":"deno@2"}'),
            F.lit('{"packageManager":"pnpm"}'),
            F.lit('{"name":"x"}'),
        ),
        (key % 6).cast("int"),
    )
    rows = t.part.select(
        key.alias("k"),
        "p_size",
        split_package_manager(F.get_json_object(manifest, "$.packageManager")).alias("f"),
    )
    explicit = F.when(F.col("p_size") % 10 == 0, F.lit("explicit"))
    return rows.select(
        "k",
        F.col("f.manager").alias("field_manager"),
        F.col("f.version").alias("field_version"),
        choose_version(F.lit("pnpm"), explicit, F.col("f.manager"), F.col("f.version")).alias("version"),
    )


@query(
    """
    SELECT o_orderkey AS k,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'npm'
                WHEN '2-HIGH' THEN 'yarn' WHEN '3-MEDIUM' THEN 'bun' WHEN '4-NOT SPECIFIED' THEN 'pnpm'
                ELSE CASE o_orderstatus WHEN 'F' THEN 'npm' WHEN 'O' THEN 'yarn' END END AS manager FROM orders
    """
)
def priority_choice(t: Tables) -> DataFrame:
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    explicit = F.when(priority == "1-URGENT", "npm").otherwise("")
    field = F.when(priority == "2-HIGH", "yarn")

    def names(*values: str) -> Column:
        return F.array(*[F.lit(v) for v in values])

    files = (
        F.when(priority == "3-MEDIUM", names("package-lock.json", "yarn.lock", "bun.lockb"))
        .when(priority == "4-NOT SPECIFIED", names("yarn.lock", "pnpm-lock.yaml"))
        .when(status == "F", names("npm-shrinkwrap.json"))
        .when(status == "O", names("yarn.lock", "package-lock.json"))
        .otherwise(names("README.md"))
    )
    return t.orders.select(F.col("o_orderkey").alias("k"), choose_manager(explicit, field, files).alias("manager"))


@query(
    """
    SELECT p_partkey AS k, CASE p_partkey % 6 WHEN 0 THEN 'classic' WHEN 1 THEN 'berry' WHEN 2 THEN 'berry'
                           WHEN 3 THEN 'berry' WHEN 4 THEN 'classic' END AS variant FROM part
    """
)
def yarn_variant(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    header = fill("# yarn lockfile v1\n# <n>\n", n="p_name")
    text = F.when(key % 6 == 0, header).when(key % 6 == 1, "a@1:\n").when(key % 6 == 2, fill("# <n>\n__metadata:\n", n="p_name"))
    text = text.when(key % 6 == 4, fill("<n>@1:\n", n="p_name"))
    version = F.when(key % 6 == 0, "4.1.0").when(key % 6 == 1, fill("3.<s>", s="p_size")).when(key % 6 == 4, "1.22.22")
    files = F.when(key % 6 == 3, F.array(F.lit(".yarnrc.yml"))).otherwise(F.array(F.lit("yarn.lock")))
    return t.part.select(key.alias("k"), variant_of(text, version, files).alias("variant"))


@query(
    """
    SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '--legacy-peer-deps' WHEN 1 THEN '--legacy-peer-deps'
                   WHEN 2 THEN '--config.engine-strict=false' WHEN 3 THEN '--config.engine-strict=false'
                   WHEN 4 THEN '--ignore-engines' END AS flag FROM documents
    """
)
def retry_advice(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    seed = pick(
        key,
        "npm ERESOLVE",
        "unable to resolve dependency tree",
        "Unsupported Engine",
        "The ENGINE node is Incompatible",
        "engine is incompatible",
        "ERESOLVE",
        "fine",
    )
    manager = pick(key, "npm", "npm", "pnpm", "pnpm", "yarn", "bun", "npm")
    output = F.concat("text", F.lit("\n"), seed)
    return t.documents.select("doc_id", "text").select("doc_id", retry_flag(manager, output).alias("flag"))
