"""Document fingerprints: SimHash of weighted terms, and all fingerprints within a Hamming radius.

A term is a word of the lower-cased text with the word after it. Two 64-bit hashes of a term vote on 128
bits, for 1 or for 0, as often as the term's word has letters (``HEAVIEST`` at most); a bit is 1 if its
votes for 1 are more than half. Votes are summed in pairs: a number holds the counts of two bits, 32 bits
each, so 64 sums do, and a text of fewer than 2^29 words cannot overflow them.

``within_radius`` cuts the 128 bits into ``radius`` + ``AGREE`` blocks. Two fingerprints at most ``radius``
bits apart agree in ``AGREE`` blocks at least: one table for each choice of so many blocks, keyed by
their bits, brings all such pairs together. Equal fingerprints are one row before that.

``fingerprint_report`` compares each document with the next one by descending id. Ids are cut into
buckets at quantiles; each bucket also gets the first row of the bucket below it, so one shuffle by bucket
puts every document beside its successor and all later steps keep that partitioning.

Everything is columns and SQL functions: no Python runs in the tasks.

Defined results: a null text is an empty one; a text without words has the fingerprint 0; equal texts
have equal fingerprints; texts of any length are used whole; rows with equal ids follow each other by
text, each with its own row; a row with a null id has no next document, which counts as an empty text;
an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import json
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.skew import heavy_groups, split_join
from .common import stored

HALF_BITS = 64
HEAVIEST = 8
#: Rows of a bucket, unless that makes more than BUCKETS of them.
BUCKET_ROWS, BUCKETS = 512, 1 << 16
_GROUP = 256
RADIUS, AGREE = 3, 2

_LANES = (1 << 32) | 1
_EDGE = r"^[\x00-\x20]+"
_GAP = r"[\x00-\x20]+"


def word_list(text: Column) -> Column:
    return F.split(F.regexp_replace(F.lower(text), _EDGE, ""), _GAP)


def terms(words: Column) -> Column:
    """array of (a, b, w): two hashes and the weight of each word with its follower. ``words`` should be a plain column."""
    return F.zip_with(
        words,
        F.slice(words, F.lit(2), F.size(words)),
        lambda x, after: F.struct(
            F.xxhash64(x, after).alias("a"),
            F.xxhash64(F.lit(1), x, after).alias("b"),
            F.least(F.length(x), F.lit(HEAVIEST)).cast("long").alias("w"),
        ),
    )


def _votes(hash_: str, weight: str) -> list[Column]:
    """Sums that hold the votes for 1 of bits j and j + 32."""
    return [F.expr(f"sum((shiftrightunsigned({hash_}, {j}) & {_LANES}L) * {weight})") for j in range(32)]


def _bits(votes: list[str], total: str) -> Column:
    """The 64 bits: 1 where more than half of the votes say so."""
    low = [f"if(({v} & {(1 << 32) - 1}L) * 2 > {total}, shiftleft(1L, {j}), 0L)" for j, v in enumerate(votes)]
    high = [f"if(shiftrightunsigned({v}, 32) * 2 > {total}, shiftleft(1L, {j + 32}), 0L)" for j, v in enumerate(votes)]
    return F.expr(" | ".join(low + high))


def with_simhash(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row for each value of ``keys``: these and the halves ``high`` and ``low`` of the fingerprint.

    Rows with the same keys must have the same text.
    """
    words = rows.select(*keys, word_list(F.col(text)).alias("words"))
    term = words.select(*keys, F.explode_outer(terms(F.col("words"))).alias("t"))
    votes = [v.alias(f"{h}{j}") for h in "ab" for j, v in enumerate(_votes(f"t.{h}", "t.w"))]
    sums = term.groupBy(*keys).agg(F.sum("t.w").alias("total"), *votes)
    half = lambda h: F.coalesce(_bits([f"{h}{j}" for j in range(32)], "total"), F.lit(0).cast("long"))
    return sums.select(*keys, half("a").alias("high"), half("b").alias("low"))


def hexadecimal(high: Column, low: Column) -> Column:
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def likeness(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """Share of equal bits."""
    return 1 - distance(a, b) / (2 * HALF_BITS)


def distance(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    return F.bit_count(a[0].bitwiseXOR(b[0])) + F.bit_count(a[1].bitwiseXOR(b[1]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, high, low) of every row. Equal rows are hashed once for each of them."""
    keyed = docs.select(docs["doc_id"].alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    keyed = keyed.withColumn("name", F.sha2("text", 256))
    rows = keyed.groupBy("doc_id", "name").count()
    hashed = with_simhash(keyed, ["doc_id", "name"], "text")
    same = (hashed["doc_id"].eqNullSafe(rows["doc_id"])) & (hashed["name"] == rows["name"])
    return hashed.join(rows, same).select(hashed["doc_id"], "high", "low", F.explode(F.expr("sequence(1L, count)")).alias("copy")).drop("copy")


def _masks(radius: int) -> list[tuple[int, int]]:
    """The bits of each choice of AGREE blocks, as two longs."""
    count = radius + AGREE
    cuts = [2 * HALF_BITS * k // count for k in range(count + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [(signed(sum(c) >> 64), signed(sum(c) & ((1 << 64) - 1))) for c in combinations(blocks, AGREE)]


def within_radius(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(high, low, other_high, other_low, bits): all pairs of different fingerprints at most ``radius`` bits apart.

    Each pair comes once, the smaller one first. ``prints``: high, low. Documents join by their fingerprint.
    """
    masks = _masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("table"), F.col("high").bitwiseAND(F.lit(h)).alias("h"), F.col("low").bitwiseAND(F.lit(m)).alias("l")) for t, (h, m) in enumerate(masks)])
    rows = prints.select("high", "low").distinct().select("high", "low", F.explode(tables).alias("key")).select("high", "low", "key.*")
    other = rows.select(F.col("high").alias("other_high"), F.col("low").alias("other_low"), *[F.col(c).alias(f"{c}_") for c in ("table", "h", "l")])
    same = (F.col("table") == F.col("table_")) & (F.col("h") == F.col("h_")) & (F.col("l") == F.col("l_"))
    smaller = (F.col("high") < F.col("other_high")) | ((F.col("high") == F.col("other_high")) & (F.col("low") < F.col("other_low")))
    apart = distance((F.col("high"), F.col("low")), (F.col("other_high"), F.col("other_low")))
    found = rows.join(other, same & smaller & (apart <= radius))
    return found.select("high", "low", "other_high", "other_low", apart.alias("bits")).distinct()


def _cuts(ids: DataFrame) -> list[int]:
    """The largest id of each bucket, in order: at most ``BUCKETS`` numbers."""
    n = ids.count()
    count = min(BUCKETS, -(-n // BUCKET_ROWS))
    if not n:
        return []
    shares = F.array(*[F.lit(k / count) for k in range(1, count)])
    near = ids.agg(F.percentile_approx("doc_id", shares, F.lit(max(10_000, 4 * count))).alias("x")).first()[0] if count > 1 else []
    bucket, _ = _placed(sorted(set(near)))
    heads = ids.groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("head")).select("head")
    return sorted(r[0] for r in heads.collect())


def _placed(cuts: list[int]) -> tuple[Column, Column]:
    """How many cuts are below ``doc_id``, and whether it is a cut. Cuts are searched in two steps."""
    if not cuts:
        return F.lit(0), F.lit(False)
    groups = [cuts[k : k + _GROUP] for k in range(0, len(cuts), _GROUP)]
    tops = F.from_json(F.lit(json.dumps([g[-1] for g in groups])), "array<bigint>")
    inner = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    below = lambda list_: F.size(F.filter(list_, lambda x: x < F.col("doc_id")))
    group = below(tops)
    own = F.get(inner, group)
    bucket = F.when(group == len(groups), F.lit(len(cuts))).otherwise(group * _GROUP + below(own))
    return bucket, F.coalesce(F.array_contains(own, F.col("doc_id")), F.lit(False))


def beside_next(docs: DataFrame) -> DataFrame:
    """(bucket, place, ghost, doc_id, text, next): each text with that of the next smaller id; after the last comes the first.

    Partitioned by ``bucket``. Rows with ``ghost`` are copies that only serve as the next of another
    row; they come last in their bucket.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    cuts = _cuts(rows.select("doc_id").filter("doc_id is not null"))
    bucket, head = _placed(cuts)
    loose = -1 - F.pmod(F.xxhash64("text"), F.lit(BUCKETS)).cast("int")
    rows = rows.withColumn("own", F.when(F.col("doc_id").isNull(), loose).otherwise(bucket)).withColumn("head", F.col("doc_id").isNotNull() & head)
    at = lambda b, ghost: F.struct(b.cast("int").alias("bucket"), F.lit(ghost).alias("ghost"))
    copies = F.when(F.col("head"), F.array(at(F.col("own"), False), at((F.col("own") + 1) % max(1, len(cuts)), True))).otherwise(F.array(at(F.col("own"), False)))
    rows = rows.select("doc_id", "text", F.explode(copies).alias("at")).select("at.bucket", "at.ghost", "doc_id", "text")
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("doc_id"), F.xxhash64("text"), "text")
    next_ = F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order))
    return rows.select("bucket", F.row_number().over(order).alias("place"), "ghost", "doc_id", "text", F.coalesce(next_, F.lit("")).alias("next"))


def with_neighbours(rows: DataFrame, radius: int, high: str, low: str, name: str) -> DataFrame:
    """``rows`` with ``name``: how many other rows have a fingerprint at most ``radius`` bits apart.

    Counted by distinct fingerprints. One that many rows have is dealt out when its count is joined to them.
    ``rows`` should be stored: they are read several times.
    """
    classes = stored(rows.groupBy(F.col(high).alias("high"), F.col(low).alias("low")).agg(F.count("*").alias("n")), "classes")
    pairs = within_radius(classes, radius)
    both = pairs.select("high", "low", "other_high", "other_low").union(pairs.select("other_high", "other_low", "high", "low"))
    others = classes.select(F.col("high").alias("other_high"), F.col("low").alias("other_low"), "n")
    more = both.join(others, ["other_high", "other_low"]).groupBy("high", "low").agg(F.sum("n").alias("more"))
    counts = classes.join(more, ["high", "low"], "left")
    key = lambda h, m: hexadecimal(F.col(h), F.col(m)).alias("print_")
    counts = counts.select(key("high", "low"), (F.col("n") - 1 + F.coalesce("more", F.lit(0))).alias(name))
    marked = rows.select("*", key(high, low))
    return split_join(marked, counts, "print_", heavy=heavy_groups(marked, "print_")).drop("print_")


def fingerprint_report(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: its fingerprint, that of its text with the second half replaced by the next one's, and their likeness.

    ``n_near``: how many other documents have a fingerprint at most ``radius`` bits apart.
    """
    half = F.floor(F.col("n_chars") / 2).cast("int")
    start = lambda text, n: F.substring(text, F.lit(1), n)
    edited = F.concat(start(F.col("text"), (F.col("n_chars") - half).cast("int")), start(F.col("next"), half))
    rows = beside_next(docs).withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", edited)
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited"), 256))
    texts = F.array(F.struct(F.lit(False).alias("is_edit"), F.col("text").alias("text")), F.struct(F.lit(True).alias("is_edit"), F.col("edited").alias("text")))
    kept = ["ghost", "doc_id", "n_chars", "edited_sha256"]
    both = rows.select("bucket", "place", *kept, F.explode(texts).alias("x")).select("bucket", "place", *kept, "x.is_edit", "x.text")
    hashed = with_simhash(both, ["bucket", "place", *kept, "is_edit"], "text")
    of = lambda column, edit: F.max(F.when(F.col("is_edit") == edit, F.col(column)))
    sides = {f"{side}_{c}": of(c, edit).alias(f"{side}_{c}") for side, edit in (("own", False), ("edit", True)) for c in ("high", "low")}
    rows = hashed.groupBy("bucket", "place", *kept).agg(*sides.values())
    order = Window.partitionBy("bucket").orderBy("place")
    after = [F.coalesce(F.when(F.col("doc_id").isNotNull(), F.lead(f"own_{c}").over(order)), F.lit(0).cast("long")).alias(f"next_{c}") for c in ("high", "low")]
    rows = stored(rows.select("*", *after).filter(~F.col("ghost")), "fingerprints")
    rows = with_neighbours(rows, radius, "own_high", "own_low", "n_near")
    pair = lambda side: (F.col(f"{side}_high"), F.col(f"{side}_low"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        hexadecimal(*pair("own")).alias("fingerprint"),
        hexadecimal(*pair("edit")).alias("edited_fingerprint"),
        likeness(pair("own"), pair("edit")).alias("near_edited"),
        likeness(pair("own"), pair("next")).alias("near_next"),
        "n_near",
    )
