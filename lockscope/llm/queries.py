"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table
from .decontaminate import contamination
from .langid import languages
from .lines import line_report
from .minhash import near_duplicates
from .packing import pack
from .phrases import collocations
from .pii import personal_data
from .runs import run_report
from .simhash import fingerprint_report
from .substring import substring_report
from .suffixes import suffix_report
from .vectors import vector_duplicates
from .warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


@query
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"))


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "pages"))


ORACLES["op10_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS last FROM p WHERE strlen(h) >= 1000 GROUP BY h)
SELECT p.page_id, strlen(p.h) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN p.page_id < g.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < g.last THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""


@query
def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


@query
def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


@query
def op7_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates(table(spark, sf_dir, "embeddings"), audit=50)


@query
def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_report(table(spark, sf_dir, "documents"))


@query
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_report(table(spark, sf_dir, "documents"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(table(spark, sf_dir, "documents"), planted=True)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_collocations"] = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), word AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w)) AS n FROM word GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM word WHERE len(w) > 0),
gram AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM place, (VALUES (1), (2), (3), (4)) AS sizes(m) WHERE i + m - 1 <= len(w)
), f AS (SELECT lang, m, phrase, count(*) AS a FROM gram GROUP BY lang, m, phrase HAVING count(*) >= 30),
cut AS (
  SELECT f.lang, f.phrase, f.a, string_split(f.phrase, ' ') AS w, k
  FROM f, (VALUES (1), (2), (3)) AS spot(k) WHERE k < f.m
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, x.a AS l, y.a AS r, (2000000::HUGEINT * c.a) // (x.a + y.a) AS score
  FROM cut AS c
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT f.lang, f.a, array_to_string(string_split(f.phrase, ' ')[s:s + m2 - 1], ' ') AS phrase
    FROM f, (VALUES (2), (3)) AS short(m2), (VALUES (1), (2), (3)) AS spot(s) WHERE m2 < f.m AND s + m2 - 1 <= f.m
  ) GROUP BY lang, phrase
)
SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, t.phrase) AS rank,
       t.phrase, a, l, r, total.n::BIGINT AS n, score::BIGINT AS score
FROM lowest AS t JOIN total ON total.lang = t.lang LEFT JOIN longer AS o ON o.lang = t.lang AND o.phrase = t.phrase
WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * a
QUALIFY rank <= 2000
"""


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_report(table(spark, sf_dir, "documents"))
