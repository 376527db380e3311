"""Runs that build on earlier ones: merged tables, differences, requests of a run, versions that fit, reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.changes import distinct_sketches, merge_sketches, run_difference as difference_of, sketch_overlap
from ..operators.dedup import artifact_state, artifacts_of_state, merge_artifact_states
from ..operators.intervals import requests_of_runs, run_requests as requests_per_run
from ..operators.matching import latest_matching as find_latest
from ..operators.reach import package_reach as reach_of
from .dedup import _REFERENCES, document_references
from .registry import Tables, fill, query

_RUNS = """
    e AS (SELECT event_id, ts, event_type, value, CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END AS root FROM events),
    runs AS (SELECT root, event_id AS run_id, ts AS started,
                    CASE WHEN event_id % 100 <> 0 THEN ts + to_minutes(CAST(floor(value) AS INTEGER)) END AS finished
             FROM e WHERE event_id % 20 = 0),
    starts AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY root, started ORDER BY finished DESC NULLS LAST, run_id DESC) = 1),
    requests AS (SELECT event_id, ts, root, CASE WHEN event_type = 'error' THEN 502 ELSE 200 END AS status FROM e WHERE event_id % 20 <> 0),
    of_run AS (SELECT r.event_id, r.status,
                      CASE WHEN s.finished IS NULL OR r.ts < s.finished THEN s.run_id END AS run_id
               FROM requests r ASOF LEFT JOIN starts s ON r.root = s.root AND r.ts >= s.started)
"""


def _requests_and_runs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A third of all requests comes from one root."""
    root = F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    events = t.events.withColumn("root", root)
    took = F.expr("ts + make_dt_interval(0, 0, cast(floor(value) AS int), 0)")
    runs = events.filter("event_id % 20 = 0").select(
        "root", F.col("event_id").alias("run_id"), F.col("ts").alias("started"), F.when(F.col("event_id") % 100 != 0, took).alias("finished")
    )
    status = F.when(F.col("event_type") == "error", 502).otherwise(200)
    return events.filter("event_id % 20 <> 0").select("event_id", "ts", "root", status.alias("status")), runs


@query(f"WITH {_RUNS} SELECT event_id, coalesce(run_id, -1) AS run_id FROM of_run")
def requests_of_run(t: Tables) -> DataFrame:
    requests, runs = _requests_and_runs(t)
    return requests_of_runs(requests, runs, ["root"]).select("event_id", F.coalesce("run_id", F.lit(-1)).alias("run_id"))


@query(
    f"""
    WITH {_RUNS}, c AS (SELECT run_id, count(*) AS n, count(*) FILTER (status = 200) AS ok FROM of_run GROUP BY run_id)
    SELECT runs.run_id, runs.root, coalesce(n, 0) AS requests, coalesce(ok, 0) AS served FROM runs LEFT JOIN c ON c.run_id = runs.run_id
    """
)
def run_requests(t: Tables) -> DataFrame:
    requests, runs = _requests_and_runs(t)
    return requests_per_run(requests, runs, keys=["root"]).select("run_id", "root", "requests", "served")


@query(f"WITH {_REFERENCES} SELECT * FROM a")
def artifacts_merged(t: Tables) -> DataFrame:
    """Three batches of references; the later ones are merged into the table of the first."""
    references = document_references(t)
    batch = [artifact_state(references.filter(F.col("ord") % 3 == k)) for k in range(3)]
    return artifacts_of_state(merge_artifact_states(merge_artifact_states(batch[2], batch[0]), batch[1]))


_ORDER_RUNS = """
    old AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s FROM orders WHERE o_orderkey % 1000 <> 11),
    new AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 1000 IN (7, 8) THEN o_custkey + 1 ELSE o_custkey END AS c,
                   CASE WHEN o_orderkey % 1000 = 8 THEN 'X' WHEN o_orderkey % 1000 <> 9 THEN o_orderstatus END AS s
            FROM orders WHERE o_orderkey % 1000 <> 13)
"""


@query(
    f"""
    WITH {_ORDER_RUNS}
    SELECT coalesce(new.k, old.k) AS item, CASE WHEN old.k IS NULL THEN 'added' WHEN new.k IS NULL THEN 'removed' ELSE 'changed' END AS change,
           concat_ws(',', CASE WHEN old.c IS DISTINCT FROM new.c THEN 'customer' END, CASE WHEN old.s IS DISTINCT FROM new.s THEN 'status' END) AS fields,
           coalesce(CASE WHEN old.s IS DISTINCT FROM new.s THEN coalesce(old.s, '-') || '>' || coalesce(new.s, '-') END, '') AS status_change
    FROM old FULL JOIN new ON old.k = new.k WHERE old.c IS DISTINCT FROM new.c OR old.s IS DISTINCT FROM new.s
    """
)
def run_difference(t: Tables) -> DataFrame:
    plain = t.orders.select(F.col("o_orderkey").alias("item"), F.col("o_custkey").alias("customer"), F.col("o_orderstatus").alias("status"))
    old = plain.filter(F.col("item") % 1000 != 11)
    part = F.col("item") % 1000
    new = plain.filter(part != 13).withColumns(
        {
            "customer": F.when(part.isin(7, 8), F.col("customer") + 1).otherwise(F.col("customer")),
            "status": F.when(part == 8, "X").when(part != 9, F.col("status")),
        }
    )
    found = difference_of(old, new, ["item"], ["customer", "status"])
    said = F.col("fields")["status"]
    moved = F.concat(F.coalesce(said["old"], F.lit("-")), F.lit(">"), F.coalesce(said["new"], F.lit("-")))
    return found.select(
        "item",
        "change",
        F.array_join(F.map_keys("fields"), ",").alias("fields"),
        F.when(said.isNotNull(), moved).otherwise("").alias("status_change"),
    )


@query(
    """
    WITH y AS (SELECT DISTINCT year(o_orderdate) AS run, o_custkey AS c FROM orders),
    n AS (SELECT run, count(*) AS n FROM y GROUP BY run)
    SELECT a.run AS first, b.run AS second, a.n AS first_distinct, b.n AS second_distinct,
           (SELECT count(DISTINCT c) FROM y WHERE run IN (a.run, b.run)) AS together,
           (SELECT count(*) FROM (SELECT c FROM y WHERE run = a.run INTERSECT SELECT c FROM y WHERE run = b.run)) AS in_common,
           true AS estimates_hold
    FROM n a JOIN n b ON b.run = a.run + 1
    """
)
def distinct_overlap(t: Tables) -> DataFrame:
    """Exact counts beside the estimates of merged sketches, which must lie within 10 % (of ``together``)."""
    rows = t.orders.select(F.year("o_orderdate").alias("run"), F.col("o_custkey").alias("value"), F.col("o_orderkey").alias("key"))
    halves = [distinct_sketches(rows.filter(F.col("key") % 2 == k), "run", F.col("value")) for k in (0, 1)]
    runs = rows.select(F.col("run").alias("first")).distinct()
    pairs = runs.select("first", (F.col("first") + 1).alias("second"))
    guessed = sketch_overlap(merge_sketches(*halves, run="run"), "run", pairs)
    seen = rows.select("run", "value").distinct()
    both = seen.select(F.col("run").alias("first"), "value").withColumn("a", F.lit(1)).unionByName(
        seen.select((F.col("run") - 1).alias("first"), "value").withColumn("b", F.lit(1)), allowMissingColumns=True
    )
    pairs_seen = both.groupBy("first", "value").agg(F.count("a").alias("a"), F.count("b").alias("b"))
    exact = pairs_seen.groupBy("first").agg(
        F.sum("a").alias("first_distinct"), F.sum("b").alias("second_distinct"), F.count("*").alias("together"), F.sum(F.col("a") * F.col("b")).alias("in_common")
    )
    counts = ("first_distinct", "second_distinct", "together", "in_common")
    near = F.lit(True)
    for c in counts:
        near = near & (F.abs(F.col(f"guess_{c}") - F.col(c)) <= F.col("together") * 0.1)
    guesses = guessed.select("first", "second", *[F.col(c).alias(f"guess_{c}") for c in counts])
    return exact.join(guesses, "first").select("first", "second", *counts, near.alias("estimates_hold"))


@query(
    """
    WITH v AS (SELECT DISTINCT p_partkey % 40 AS g, p_size % 3 AS a, p_partkey % 13 AS b, p_size % 12 AS c,
                      CASE WHEN p_partkey % 4 = 0 THEN p_size % 11 ELSE -1 END AS pre FROM part),
    w AS (SELECT DISTINCT s_suppkey % 40 AS g, s_suppkey % 3 AS a, s_suppkey % 13 AS b, s_suppkey % 7 AS c, s_suppkey % 6 AS kind FROM supplier),
    r AS (SELECT *, CASE kind WHEN 0 THEN '^' || a || '.' || b || '.' || c WHEN 1 THEN '~' || a || '.' || b
                    WHEN 2 THEN '>=' || a || '.' || b || '.' || c || ' <' || (a + 1) || '.5'
                    WHEN 3 THEN a || '.x || ' || a || '.' || b || '.' || c
                    WHEN 4 THEN '>=' || a || '.' || b || '.' || c || '-rc.2 <9' ELSE 'git+https://x.example/' || b END AS specifier FROM w),
    fit AS (SELECT r.g, r.specifier, v.* EXCLUDE (g) FROM r JOIN v ON v.g = r.g AND CASE kind
        WHEN 0 THEN v.pre < 0 AND [v.a, v.b, v.c] >= [r.a, r.b, r.c] AND CASE WHEN r.a > 0 THEN v.a = r.a WHEN r.b > 0 THEN v.a = 0 AND v.b = r.b ELSE v.a = 0 AND v.b = 0 AND v.c = r.c END
        WHEN 1 THEN v.pre < 0 AND v.a = r.a AND v.b = r.b
        WHEN 2 THEN v.pre < 0 AND [v.a, v.b, v.c] >= [r.a, r.b, r.c] AND [v.a, v.b] < [r.a + 1, 5]
        WHEN 3 THEN v.pre < 0 AND v.a = r.a
        WHEN 4 THEN (v.pre < 0 AND [v.a, v.b, v.c] >= [r.a, r.b, r.c]) OR (v.pre >= 2 AND [v.a, v.b, v.c] = [r.a, r.b, r.c])
        ELSE false END),
    top AS (SELECT g, specifier, arg_max(a || '.' || b || '.' || c || CASE WHEN pre >= 0 THEN '-rc.' || pre ELSE '' END,
                   [a, b, c, CASE WHEN pre < 0 THEN 1 ELSE 0 END, pre]) AS version FROM fit GROUP BY g, specifier)
    SELECT DISTINCT 'pkg-' || r.g AS name, r.specifier, r.kind <> 5 AS is_range, top.version
    FROM r LEFT JOIN top ON top.g = r.g AND top.specifier = r.specifier
    """
)
def latest_matching(t: Tables) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    pre = F.when(key % 4 == 0, fill("-rc.<n>", n=size % 11)).otherwise("")
    versions = t.part.select(
        fill("pkg-<g>", g=key % 40).alias("name"), fill("<a>.<b>.<c><pre>", a=size % 3, b=key % 13, c=size % 12, pre=pre).alias("version")
    )
    key = F.col("s_suppkey")
    parts = {"a": key % 3, "b": key % 13, "c": key % 7, "up": key % 3 + 1}
    kind = key % 6
    written = (
        F.when(kind == 0, fill("^<a>.<b>.<c>", **parts))
        .when(kind == 1, fill("~<a>.<b>", **parts))
        .when(kind == 2, fill(">=<a>.<b>.<c> <<up>.5", **parts))
        .when(kind == 3, fill("<a>.x || <a>.<b>.<c>", **parts))
        .when(kind == 4, fill(">=<a>.<b>.<c>-rc.2 <9", **parts))
        .otherwise(fill("git+https://x.example/<b>", **parts))
    )
    wanted = t.supplier.select(fill("pkg-<g>", g=key % 40).alias("name"), written.alias("specifier"))
    return find_latest(wanted, versions)


@query(
    """
    WITH RECURSIVE e AS (SELECT DISTINCT l_orderkey % 300 AS root, l_partkey % 90 AS p, (l_partkey * 3 + l_suppkey) % 90 AS d
                         FROM lineitem WHERE l_linenumber > 1 AND l_partkey % 7 < 3),
    s AS (SELECT DISTINCT l_orderkey % 300 AS root, l_partkey % 90 AS p FROM lineitem WHERE l_linenumber = 1 AND l_orderkey % 5 = 0),
    reach AS (SELECT root, p FROM s UNION SELECT r.root, e.d FROM reach r JOIN e ON e.root = r.root AND e.p = r.p)
    SELECT 'part-' || r.p AS package, count(*) AS roots, count(s.root) AS direct_roots
    FROM reach r LEFT JOIN s ON s.root = r.root AND s.p = r.p GROUP BY r.p
    """
)
def package_reach(t: Tables) -> DataFrame:
    root = (F.col("l_orderkey") % 300).alias("root")
    name = lambda number: fill("part-<n>", n=number)
    part = F.col("l_partkey")
    edges = t.lineitem.filter((F.col("l_linenumber") > 1) & (part % 7 < 3)).select(
        root, name(part % 90).alias("package"), name((part * 3 + F.col("l_suppkey")) % 90).alias("dependency")
    )
    starts = t.lineitem.filter("l_linenumber = 1 AND l_orderkey % 5 = 0").select(root, name(part % 90).alias("package"))
    return reach_of(starts, edges).select("package", "roots", "direct_roots")
