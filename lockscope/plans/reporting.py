"""Report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.reports import (
    blob_shasum,
    cache_bytes_by_manager,
    combine_issues,
    coverage_rate,
    coverage_table,
    distribution as distribution_of,
    fetch_summary as fetches,
    first_run_bytes,
    in_input_order,
    latest_versions,
    order_null_as_blank,
    package_versions,
    phase_verdict,
    profile_coverage,
    profile_rollup,
    project_table,
    request_counts,
    resolution_counts,
    resolution_table,
    run_changes,
    stage_failures,
    timing_summary as timings,
    validation_table,
    warmup_by_manager as by_manager,
    warmup_by_policy as by_policy,
)
from ..operators.shape import exact_percentiles, number_rows, one_row
from ..functions.choices import retry_command
from ..functions.values import url_host
from ..sources.readers import task_rows
from .outcomes import _order_statuses
from .registry import Tables, fill, pick, query


@query(
    """
    SELECT 'manager' AS report, CASE o_orderpriority WHEN '1-URGENT' THEN 'npm' WHEN '2-HIGH' THEN 'yarn' ELSE 'pnpm' END AS value, count(*) AS count
    FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL
    UNION ALL SELECT 'version', CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown' ELSE o_orderpriority END, count(*) FROM orders GROUP BY ALL
    """
)
def distribution(t: Tables) -> DataFrame:
    priority = F.col("o_orderpriority")
    manager = F.when(priority == "1-URGENT", "npm").when(priority == "2-HIGH", "yarn").otherwise("pnpm")
    rows = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", manager).otherwise("").alias("manager"),
        F.when(priority != "5-LOW", priority).alias("version"),
    )
    return (
        distribution_of(rows, "manager")
        .withColumn("report", F.lit("manager"))
        .unionByName(distribution_of(rows, "version", "unknown").withColumn("report", F.lit("version")))
    )


@query(
    """
    SELECT event_type AS stage, count(*) AS count, round(sum(value), 2) AS total, round(quantile_cont(value, 0.5), 4) AS p50,
           round(quantile_cont(value, 0.95), 4) AS p95, max(value) AS max FROM events WHERE user_id % 10 <> 0 GROUP BY event_type
    """
)
def timing_summary(t: Tables) -> DataFrame:
    """Timings of every tenth user are unknown."""
    rows = t.events.select(
        F.col("event_type").alias("stage"), F.when(F.col("user_id") % 10 != 0, F.col("value")).alias("elapsed_ms")
    )
    result = timings(rows)
    return result.select(
        "stage", "count", F.round("total", 2).alias("total"), F.round("p50", 4).alias("p50"), F.round("p95", 4).alias("p95"), "max"
    )


@query(
    """
    SELECT l_returnflag AS flag, round(quantile_cont(l_extendedprice, 0.25), 3) AS p25, round(quantile_cont(l_extendedprice, 0.5), 3) AS p50,
           round(quantile_cont(l_extendedprice, 0.999), 3) AS p999 FROM lineitem GROUP BY l_returnflag
    """
)
def percentile_hot(t: Tables) -> DataFrame:
    """Exact percentiles where three keys hold all rows."""
    result = exact_percentiles(
        t.lineitem.select(F.col("l_returnflag").alias("flag"), "l_extendedprice"),
        ["flag"],
        "l_extendedprice",
        {"p25": 0.25, "p50": 0.5, "p999": 0.999},
    )
    return result.select("flag", *[F.round(c, 3).alias(c) for c in ("p25", "p50", "p999")])


@query(
    """
    SELECT CAST(sum(floor(o_totalprice)) AS BIGINT) AS downloaded_bytes, count(*) FILTER (o_orderstatus = 'O') AS reused_count,
           count(*) FILTER (o_orderstatus = 'F') AS downloaded_count, count(*) FILTER (o_orderstatus = 'P') AS failed_count,
           0 AS not_prefetched_count, count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH') AS integrity_failure_count FROM orders
    """
)
def fetch_summary(t: Tables) -> DataFrame:
    return fetches(_order_statuses(t))


def _warmups(t: Tables) -> DataFrame:
    """One warm-up record per (manager, variant, version) from suppliers and nations."""
    joined = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    manager = F.when(F.col("n_regionkey") == 0, "npm").when(F.col("n_regionkey") == 1, "yarn").otherwise("pnpm")
    variant = F.when(F.col("n_regionkey") == 1, F.when(F.col("n_nationkey") % 2 == 0, "berry").otherwise("classic"))
    return joined.groupBy(
        manager.alias("manager"), variant.alias("variant"), F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).alias("version")
    ).agg(
        F.when(F.max(F.col("s_suppkey") % 9) == 8, "partial").otherwise("success").alias("status"),
        F.sum(F.floor(F.abs("s_acctbal")).cast("bigint")).alias("cache_bytes"),
        F.count("*").alias("imported"),
        F.count_if(F.col("s_suppkey") % 9 == 8).alias("failed_count"),
        F.sum("s_suppkey").alias("elapsed_ms"),
    )


_WARMUPS = """
    w AS (SELECT CASE n_regionkey WHEN 0 THEN 'npm' WHEN 1 THEN 'yarn' ELSE 'pnpm' END AS manager,
                 CASE WHEN n_regionkey = 1 THEN CASE WHEN n_nationkey % 2 = 0 THEN 'berry' ELSE 'classic' END END AS variant,
                 CASE WHEN n_nationkey % 4 <> 0 THEN n_name END AS version,
                 CASE WHEN max(s_suppkey % 9) = 8 THEN 'partial' ELSE 'success' END AS status,
                 CAST(sum(floor(abs(s_acctbal))) AS BIGINT) AS cache_bytes, count(*) AS imported,
                 count(*) FILTER (s_suppkey % 9 = 8) AS failed_count, CAST(sum(s_suppkey) AS BIGINT) AS elapsed_ms
          FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2, 3)
"""


@query(
    f"""
    WITH {_WARMUPS}
    SELECT manager, CASE WHEN bool_and(status = 'success') THEN 'success' ELSE 'partial' END AS status,
           CAST(sum(cache_bytes) AS BIGINT) AS cache_bytes, CAST(sum(imported) AS BIGINT) AS imported,
           CAST(sum(failed_count) AS BIGINT) AS failed_count, CAST(sum(elapsed_ms) AS BIGINT) AS elapsed_ms,
           count(*) AS policy_count, CAST(sum(cache_bytes) AS BIGINT) AS native_bytes FROM w GROUP BY manager
    """
)
def manager_rollup(t: Tables) -> DataFrame:
    warmups = _warmups(t)
    native = cache_bytes_by_manager(warmups).withColumnRenamed("cache_bytes", "native_bytes")
    return by_manager(warmups).join(native, "manager")


@query(
    f"""
    WITH {_WARMUPS} SELECT concat_ws('@', manager, variant, version) AS policy, * FROM w
    """
)
def policy_rollup(t: Tables) -> DataFrame:
    return by_policy(_warmups(t))


@query(
    """
    SELECT CAST(o_custkey AS VARCHAR) AS profile_id,
           CASE WHEN count(DISTINCT o_orderpriority) = 1 THEN min(o_orderpriority) ELSE 'mixed' END AS package_manager,
           CASE WHEN count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) = 1
                THEN min(CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END) END AS version,
           count(*) AS root_count FROM orders GROUP BY o_custkey
    """
)
def one_or_mixed(t: Tables) -> DataFrame:
    roots = t.orders.select(
        F.col("o_custkey").cast("string").alias("profile_id"),
        F.col("o_orderpriority").alias("package_manager"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("").alias("version"),
    )
    return profile_rollup(roots)


@query(
    """
    WITH c AS (SELECT c_custkey, c_name, c_nationkey,
                      (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = 1997) AS task_count FROM customer)
    SELECT CAST(c_custkey AS VARCHAR) AS profile_id, c_name, task_count FROM c
    """
)
def coverage(t: Tables) -> DataFrame:
    profiles = t.customer.select(F.col("c_custkey").cast("string").alias("profile_id"), "c_name")
    tasks = t.orders.filter(F.year("o_orderdate") == 1997).select(F.col("o_custkey").cast("string").alias("repository"))
    return profile_coverage(profiles, tasks)


@query(
    """
    SELECT (SELECT count(*) FROM documents) AS input_profile_count, (SELECT count(*) FROM labels) AS discovered_profile_count,
           round((SELECT count(*) FROM labels) / (SELECT count(*) FROM documents), 4) AS coverage_rate
    """
)
def coverage_share(t: Tables) -> DataFrame:
    return coverage_rate(t.documents, t.labels).withColumn("coverage_rate", F.round("coverage_rate", 4))


@query(
    """
    WITH r AS (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, CASE WHEN page_id % 4 = 0 THEN 404 ELSE 200 END AS status FROM pages)
    SELECT host, count(*) AS requests, count(*) FILTER (status = 200) AS served FROM r GROUP BY host
    """
)
def request_log(t: Tables) -> DataFrame:
    requests = t.pages.select(
        url_host(F.col("url")).alias("host"), F.when(F.col("page_id") % 4 == 0, 404).otherwise(200).alias("status")
    )
    return request_counts(requests, ["host"])


@query(
    """
    WITH m AS (SELECT o_orderpriority AS metric, year(o_orderdate) * 12 + month(o_orderdate) AS run_no, count(*) AS value FROM orders GROUP BY 1, 2),
    l AS (SELECT *, lag(value) OVER w AS previous, first_value(value) OVER w AS first FROM m WINDOW w AS (PARTITION BY metric ORDER BY run_no))
    SELECT metric, run_no, value, previous::DOUBLE AS previous, first, (value - previous)::DOUBLE AS absolute_change,
           round((value - previous) / nullif(previous, 0), 6) AS relative_change FROM l
    """
)
def run_change(t: Tables) -> DataFrame:
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    runs = t.orders.groupBy(F.col("o_orderpriority").alias("metric"), month.alias("run_no")).agg(F.count("*").alias("value"))
    changes = run_changes(runs).withColumn("relative_change", F.round("relative_change", 6))
    return changes.withColumns({c: F.col(c).cast("double") for c in ("previous", "absolute_change")})


def _versions(t: Tables) -> DataFrame:
    parts = t.part.groupBy(
        F.col("p_brand").alias("name"),
        fill("<s>.0.<r>", s="p_size", r=F.col("p_partkey") % 3).alias("version"),
    ).agg(F.max("p_partkey").alias("k"))
    blob = F.when(F.col("k") % 2 == 0, fill("blob <k>", k="k").cast("binary"))
    return package_versions(
        parts.select(
            "name",
            "version",
            fill("a<k>", k="k").alias("artifact_id"),
            F.when(F.col("k") % 3 == 0, "sha512-x").otherwise("").alias("integrity"),
            blob_shasum(blob, F.when(F.col("k") % 5 == 0, F.lit("recorded"))).alias("shasum"),
        )
    )


_VERSIONS = """
    v AS (SELECT p_brand AS name, p_size || '.0.' || (p_partkey % 3) AS version, max(p_partkey) AS k,
                 any_value(p_size) AS s, any_value(p_partkey % 3) AS r FROM part GROUP BY 1, 2)
"""


@query(
    f"""
    WITH {_VERSIONS}
    SELECT name, version, 'a' || k AS artifact_id, CASE WHEN k % 3 = 0 THEN 'sha512-x' END AS integrity,
           CASE WHEN k % 2 = 0 THEN sha1('blob ' || k) WHEN k % 5 = 0 THEN 'recorded' ELSE '' END AS shasum FROM v
    """
)
def packument(t: Tables) -> DataFrame:
    return _versions(t)


@query(
    f"""
    WITH {_VERSIONS}
    SELECT name, count(*) AS version_count, max(version) AS latest, arg_max(version, s * 10 + r) AS latest_numeric FROM v GROUP BY name
    """
)
def packument_latest(t: Tables) -> DataFrame:
    return latest_versions(_versions(t))


@query(
    """
    SELECT (SELECT count(*) FROM customer) AS input_profile_count,
           (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS failed_discovery_count,
           (SELECT count(*) FROM lineitem WHERE l_linenumber < 6) AS resolution_success_count,
           (SELECT count(*) FROM lineitem WHERE l_linenumber = 6) AS resolution_failure_count,
           (SELECT count(*) FROM orders WHERE o_orderstatus = 'P') AS prefetch_failure_count,
           (SELECT count(*) FROM events WHERE event_type = 'view') AS validation_success_count,
           (SELECT CAST(sum(floor(o_totalprice)) AS BIGINT) FROM orders) AS known_source_bytes,
           (SELECT CAST(sum(floor(o_totalprice)) AS BIGINT) FROM orders WHERE o_orderstatus = 'F') AS first_run_bytes,
           0 AS second_run_bytes, 'partial' AS verdict
    """
)
def run_summary(t: Tables) -> DataFrame:
    number = F.col("l_linenumber")
    resolutions = t.lineitem.select(F.when(number < 6, 0).when(number == 6, 1).alias("exit_code"))
    price = F.floor("o_totalprice").cast("bigint")
    orders = t.orders.agg(
        F.count_if(F.col("o_orderstatus") == "P").alias("prefetch_failure_count"),
        F.sum(price).alias("known_source_bytes"),
        first_run_bytes(F.lit(None).cast("bigint"), F.lit(0).cast("bigint"), F.sum(F.when(F.col("o_orderstatus") == "F", price))).alias(
            "first_run_bytes"
        ),
        F.sum(F.when(F.col("o_totalprice") < 0, price).otherwise(0)).alias("second_run_bytes"),
    )
    parts = one_row(
        t.customer.agg(
            F.count("*").alias("input_profile_count"), F.count_if(F.col("c_acctbal") < 0).alias("failed_discovery_count")
        ),
        resolution_counts(resolutions),
        orders,
        t.events.agg(F.count_if(F.col("event_type") == "view").alias("validation_success_count")),
    )
    return phase_verdict(parts)


@query(
    """
    SELECT DISTINCT 'manual_review' AS kind, CAST(doc_id AS VARCHAR) AS profile_id, CASE WHEN toxic = 1 THEN 'patch' END AS type,
           'reviewed' AS reason FROM labels
    UNION SELECT 'manual_review', CAST(conv_id AS VARCHAR), NULL, role FROM conversations
    """
)
def issue_union(t: Tables) -> DataFrame:
    """The labels arrive twice, from two stages; each item counts once."""
    kind = F.lit("manual_review").alias("kind")
    labels = t.labels.select(
        kind,
        F.col("doc_id").cast("string").alias("profile_id"),
        F.when(F.col("toxic") == 1, "patch").alias("type"),
        F.lit("reviewed").alias("reason"),
    )
    talks = t.conversations.select(kind, F.col("conv_id").cast("string").alias("profile_id"), F.col("role").alias("reason"))
    return combine_issues(labels, labels.select(*reversed(labels.columns)), talks)


@query(
    """
    SELECT 'validation' AS stage, CAST(c_custkey AS VARCHAR) AS item, NULL AS reason FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'prefetch', CAST(o_orderkey AS VARCHAR), 'failed' FROM orders WHERE o_orderstatus = 'P'
    """
)
def failure_union(t: Tables) -> DataFrame:
    customers = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").cast("string").alias("item"))
    orders = t.orders.filter(F.col("o_orderstatus") == "P").select(
        F.col("o_orderkey").cast("string").alias("item"), F.lit("failed").alias("reason")
    )
    return stage_failures(validation=customers, prefetch=orders)


@query(
    """
    SELECT o.o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END AS priority, c.c_custkey::DOUBLE AS ord
    FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c_custkey = o_custkey
    """
)
def ordered_output(t: Tables) -> DataFrame:
    """Input order of the customer, then priority with NULL as ''; unknown customers last."""
    rows = t.orders.select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority")
    )
    positions = t.customer.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_custkey").alias("ord")
    )
    ordered = in_input_order(rows, positions, "o_custkey", "priority")
    return ordered.select("o_orderkey", "priority", F.col("ord").cast("double").alias("ord"))


@query("SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN s_name END AS name FROM supplier")
def ordered_blank(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("name"))
    return order_null_as_blank(rows, "name")


@query(
    """
    SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type
           ORDER BY CASE WHEN event_id % 7 <> 0 THEN ts END NULLS LAST, event_id) - 1 AS row_no FROM events
    """
)
def number_rows_times(t: Tables) -> DataFrame:
    """Numbers by time of day, a seventh of the times unknown."""
    rows = t.events.select("event_id", "event_type", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("at"))
    return number_rows(rows, ["event_type"], ["at", "event_id"]).select("event_id", "event_type", "row_no")


@query(
    """
    SELECT CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority,
           quantile_cont(o_orderkey, 0.5) AS p50, quantile_cont(o_orderkey, 0.95) AS p95, max(o_orderkey) AS top
    FROM orders GROUP BY 1
    """
)
def percentile_far(t: Tables) -> DataFrame:
    """Percentiles of dense numbers far from zero, one key unknown."""
    far = 10**12
    rows = t.orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"),
        (F.col("o_orderkey") + far).alias("value"),
    )
    found = exact_percentiles(rows, ["priority"], "value", {"p50": 0.5, "p95": 0.95, "top": 1.0})
    near = [F.round(F.col(c) - far, 2).alias(c) for c in ("p50", "p95")]
    return found.select("priority", *near, (F.col("top") - far).cast("bigint").alias("top"))


@query(
    """
    SELECT CASE WHEN event_type <> 'click' THEN event_type END AS stage, count(*) AS count,
           round(quantile_cont(value, 0.5), 4) AS p50, max(value) AS max FROM events GROUP BY 1
    """
)
def timing_unknown_stage(t: Tables) -> DataFrame:
    """The timings without a stage are one stage."""
    rows = t.events.select(
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("stage"), F.col("value").alias("elapsed_ms")
    )
    return timings(rows).select("stage", "count", F.round("p50", 4).alias("p50"), "max")


_ROOTS_OF_PARTS = """
    p AS (SELECT DISTINCT s_suppkey AS k, 'own-' || (s_suppkey % 7) AS owner, s_name AS repo FROM supplier WHERE s_suppkey % 10 <> 3),
    res AS (SELECT p_partkey % 150 AS profile, p_partkey AS root, p_partkey % 6 AS kind, p_size AS size FROM part)
"""


def _validated(t: Tables) -> DataFrame:
    """Results of roots: some profiles are unknown, reasons stand in different places."""
    key, kind = F.col("p_partkey"), F.col("p_partkey") % 6
    return t.part.select(
        fill("p-<n>", n=key % 150).alias("profile_id"),
        fill("r-<n>", n=key).alias("dependency_root"),
        F.lit("npm").alias("package_manager"),
        F.when(kind == 0, "success").otherwise("other_failure").alias("profile_status"),
        F.when(kind == 0, "success").otherwise("other_failure").alias("g1_status"),
        F.col("p_size").cast("bigint").alias("g1_elapsed_ms"),
        F.when(kind < 3, "g1 said").alias("g1_reason"),
        F.lit("success").alias("g2_status"),
        (F.col("p_size") * 2).cast("bigint").alias("g2_elapsed_ms"),
        F.when(kind == 3, "g2 said").alias("g2_reason"),
        F.when(kind == 1, "root said").when(kind == 2, "").alias("reason"),
        (F.col("p_size") * 3).cast("bigint").alias("root_elapsed_ms"),
        key.alias("ord"),
    )


@query(
    f"""
    WITH {_ROOTS_OF_PARTS}, req AS (SELECT event_id % 500 AS root, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1)
    SELECT 'p-' || profile AS profile_id, owner, repo, 'r-' || res.root AS dependency_root, 'npm' AS package_manager,
           CASE kind WHEN 0 THEN 'success' ELSE 'other_failure' END AS profile_status,
           CASE kind WHEN 0 THEN 'success' ELSE 'other_failure' END AS g1_status, size::BIGINT AS g1_elapsed_ms, 'success' AS g2_status,
           size::BIGINT * 2 AS g2_elapsed_ms, size::BIGINT * 3 AS root_elapsed_ms, coalesce(n, 0) AS outbound_request_count,
           CASE kind WHEN 0 THEN 'g1 said' WHEN 1 THEN 'root said' WHEN 2 THEN 'g1 said' WHEN 3 THEN 'g2 said' END AS reason
    FROM res LEFT JOIN p ON p.k = profile LEFT JOIN req ON req.root = res.root AND profile = req.root % 150
    """
)
def report_validation(t: Tables) -> DataFrame:
    profiles = t.supplier.filter("s_suppkey % 10 <> 3").select(
        fill("p-<n>", n="s_suppkey").alias("profile_id"), fill("own-<n>", n=F.col("s_suppkey") % 7).alias("owner"), F.col("s_name").alias("repo"), F.col("s_suppkey").alias("ord")
    )
    root = F.col("event_id") % 500
    requests = t.events.filter("event_type = 'error'").select(fill("p-<n>", n=root % 150).alias("profile_id"), fill("r-<n>", n=root).alias("dependency_root"))
    return validation_table(_validated(t), profiles, requests)


@query(
    """
    SELECT 'p-' || (p_partkey % 150) AS profile_id, 'r-' || p_partkey AS dependency_root, 'class-' || (p_partkey % 3) AS classification,
           CASE WHEN p_partkey % 4 = 0 THEN -1 ELSE p_size + CASE WHEN p_partkey % 5 = 0 THEN 100 ELSE 0 END END::BIGINT AS normalize_ms,
           CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE p_size * 3 END::BIGINT AS validation_ms
    FROM part
    """
)
def report_resolutions(t: Tables) -> DataFrame:
    """A fifth of the roots is normalized twice; some are not, and some are not validated."""
    key = F.col("p_partkey")
    results = _validated(t).withColumnRenamed("root_elapsed_ms", "validation_elapsed_ms")
    resolutions = t.part.select(
        fill("p-<n>", n=key % 150).alias("profile_id"), fill("r-<n>", n=key).alias("dependency_root"), fill("class-<n>", n=key % 3).alias("classification")
    )
    once = t.part.filter("p_partkey % 4 <> 0").select(
        fill("p-<n>", n=key % 150).alias("profile_id"), fill("r-<n>", n=key).alias("dependency_root"), F.col("p_size").cast("bigint").alias("normalize_elapsed_ms"), key.alias("ord")
    )
    again = once.filter(F.col("ord") % 5 == 0).withColumns({"normalize_elapsed_ms": F.col("normalize_elapsed_ms") + 100, "ord": F.col("ord") + 10**6})
    table = resolution_table(resolutions, once.unionByName(again), results.filter(F.col("ord") % 3 != 0))
    ms = lambda c: F.coalesce(c, F.lit(-1)).cast("bigint")
    return table.select("profile_id", "dependency_root", "classification", ms("normalize_elapsed_ms").alias("normalize_ms"), ms("validation_elapsed_ms").alias("validation_ms"))


@query(
    """
    WITH r AS (SELECT c_custkey % 130 AS k, count(*) AS n FROM customer GROUP BY 1),
    v AS (SELECT o_custkey % 130 AS k, arg_max(CASE o_orderstatus WHEN 'F' THEN 'success' ELSE 'other_failure' END, o_orderkey) AS status FROM orders
          WHERE o_custkey % 130 <> 5 GROUP BY 1)
    SELECT 'p-' || s_suppkey AS profile_id, s_name AS repo, coalesce(n, 0) AS dependency_roots,
           CASE WHEN s_suppkey % 9 = 0 THEN 'failed' ELSE 'success' END AS discovery_status, v.status AS validation_status
    FROM supplier LEFT JOIN r ON r.k = s_suppkey LEFT JOIN v ON v.k = s_suppkey
    """
)
def report_projects(t: Tables) -> DataFrame:
    name = lambda c: fill("p-<n>", n=c).alias("profile_id")
    profiles = t.supplier.select(name("s_suppkey"), F.col("s_name").alias("repo"))
    failures = t.supplier.filter("s_suppkey % 9 = 0").select(name("s_suppkey")).unionByName(t.supplier.filter("s_suppkey % 18 = 0").select(name("s_suppkey")))
    key = F.col("o_custkey") % 130
    statuses = t.orders.filter(key != 5).select(
        name(key), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("other_failure").alias("status"), F.lit(1).alias("elapsed_ms")
    )
    return project_table(profiles, t.customer.select(name(F.col("c_custkey") % 130)), failures, statuses).drop("validation_elapsed_ms")


@query(
    """
    WITH k AS (SELECT o_orderkey % 200 AS repo, count(*) AS n FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1),
    r AS (SELECT c_custkey % 130 AS k, count(*) AS n FROM customer GROUP BY 1)
    SELECT 'p-' || s_suppkey AS profile_id, coalesce(k.n, 0) AS task_count, coalesce(r.n, 0) AS dependency_roots, 'success' AS discovery_status
    FROM supplier LEFT JOIN k ON k.repo = s_suppkey LEFT JOIN r ON r.k = s_suppkey
    UNION ALL SELECT '', (SELECT count(*) FROM orders WHERE o_orderkey % 3 = 1), 0, 'no repository'
    """
)
def report_coverage(t: Tables) -> DataFrame:
    """Tasks come as lines of a CSV: of another collection, without repository, or cut short."""
    key = F.col("o_orderkey")
    line = (
        F.when(key % 3 == 0, fill('SWE-smith,"a,b",x,t-<k>,p-<r>', k=key, r=key % 200))
        .when(key % 3 == 1, fill("SWE-smith,1,x,t-<k>,", k=key))
        .when(key % 2 == 0, fill("SWE-smith,1,x,t-<k>", k=key))
        .otherwise(fill("Other,1,x,t-<k>,p-<r>", k=key, r=key % 200))
    )
    tasks = task_rows(t.orders.select(line.alias("value")))
    name = lambda c: fill("p-<n>", n=c).alias("profile_id")
    table = coverage_table(t.supplier.select(name("s_suppkey")), t.customer.select(name(F.col("c_custkey") % 130)), tasks)
    lost = tasks.filter("repository = ''").agg(F.count("*").alias("task_count"))
    lost = lost.select(F.lit("").alias("profile_id"), "task_count", F.lit(0).cast("bigint").alias("dependency_roots"), F.lit("no repository").alias("discovery_status"))
    return table.select("profile_id", "task_count", "dependency_roots", "discovery_status").unionByName(lost)


@query(
    """
    SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'npm ci --legacy-peer-deps' WHEN 2 THEN 'pnpm install --config.engine-strict=false'
                   WHEN 4 THEN 'yarn install --ignore-engines' END AS command FROM documents
    """
)
def retry_commands(t: Tables) -> DataFrame:
    key = F.col("doc_id")
    case = key % 7
    manager = pick(key, "npm", "npm", "pnpm", "pnpm", "yarn", "bun", "npm")
    said = pick(key, "npm ERESOLVE", "unable to resolve dependency tree", "Unsupported Engine", "The ENGINE node is Incompatible", "engine is incompatible", "ERESOLVE", "fine")
    words = (
        F.when(case == 0, F.array(F.lit("npm"), F.lit("ci")))
        .when(case == 1, F.array(F.lit("npm"), F.lit("ci"), F.lit("--legacy-peer-deps")))
        .when(case == 3, F.array(F.lit("pnpm"), F.lit("install"), F.lit("--config.engine-strict=false")))
        .otherwise(F.array(manager, F.lit("install")))
    )
    again = retry_command(manager, F.concat("text", F.lit("\n"), said), words)
    return t.documents.select("doc_id", F.array_join(again, " ").alias("command"))
