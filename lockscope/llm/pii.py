"""Personal data: high-recall generators, boosted trees on format and context, calibrated thresholds.

All work is in columns inside one row: documents are not shuffled, exploded or passed to Python.
Generators propose overlapping spans. Strict patterns give the base spans, which always stay. The
trees score the other proposals; a threshold for each kind, chosen on held-out proposals, decides.
Trees and thresholds are turned into column expressions.

The trees are fitted on the proposals of all documents: equal ones are counted together and weigh as
many, so what is fitted grows with the different shapes, not with the corpus. Positive
are base spans rewritten in the forms that only the loose patterns see (plus sign dropped, "@" spelt
out), in their own context. Negative are proposals that overlap no base span and have no word of their
kind before them or fail a check of their kind. Other proposals are unlabelled and teach nothing.
Nothing that decides a base span (plus sign, check digit, byte range) is a feature, so the trees
judge by shape and context; proposals that fail their kind's check are never added.

Defined results: null text is empty; empty text has no span; texts of any length are searched whole;
repeated rows each get a row; without positive or negative examples no span is added.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone")

#: Limits of a feature that the trees choose from. Spark draws them from all rows up to the square of this.
MAX_BINS = 512
#: Least share of held-out examples over a threshold that must be true.
PRECISION = 0.98
#: Fewest held-out examples over a threshold.
SUPPORT = 20

# Possessive groups and look-behind match the same spans as plain greedy patterns, in linear time
# and without recursion.
_LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
BASE = {
    "email": _LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
LOOSE = {
    "email": _LOCAL
    + r"(?:@| ?[(\[{] ?at ?[)\]}] ?| at )[A-Za-z0-9-]++(?:(?:\.| ?[(\[{] ?dot ?[)\]}] ?| dot )[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\])[0-9]{1,3}){3}(?![0-9.])"
    r"|(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9A-Za-z])[0-9]{4}[ ./-]?[0-9]{4}[ ./-]?[0-9]{4}(?:[ ./-]?[0-9]{1,4}){0,2}(?![0-9A-Za-z])",
    "phone": r"(?<![0-9A-Za-z.])(?:\+|00|\()?[0-9]{1,4}(?:[ ()./-]{1,2}[0-9]{2,5}){1,4}(?![0-9A-Za-z])",
}
#: Without this no pattern of the kind can match.
NEEDS = {"email": r"[@]|\bat\b", "ip": r"[.:]", "card": r"[0-9]", "phone": r"[0-9]"}
CONTEXT = {
    "email": r"mail|contact|write|reach|courriel|correo",
    "ip": r"\bip\b|address|server|host|client|login",
    "card": r"card|visa|master|credit|payment|karte|carte|tarjeta",
    "phone": r"phone|tel|call|fax|mobile|cell|anruf|appel|llama",
}
_FORMAT = ("kind", "length", "digits", "letters", "others", "groups", "joined_left", "joined_right")
FEATURES = _FORMAT + tuple(f"near_{k}" for k in KINDS)

_STEP = 256


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda acc, i: acc + value(i))
    return total % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        fits = lambda part: F.coalesce(part.try_cast("int") <= 255, F.lit(False))
        return F.forall(F.split(match, r"\."), fits)
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _plausible(kind: str, match: Column) -> Column:
    """Whether a loose form passes the check of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.contains(":") | _valid("ip", F.regexp_replace(match, r"[\[\]]", ""))
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(7, 15)
    return F.lit(True)


def _disguised(kind: str, match: Column) -> Column:
    """The loose forms of a base span."""
    swap = lambda old, new: F.regexp_replace(match, old, new)
    if kind == "email":
        spelt = lambda at, dot: F.regexp_replace(F.concat(F.substring_index(match, "@", 1), F.lit(at), F.regexp_replace(F.substring_index(match, "@", -1), r"\.", dot)), "^[.]+", "")
        forms = [spelt(" at ", " dot "), spelt(" at ", "."), spelt(" [at] ", " [dot] "), spelt("(at)", "(dot)")]
    elif kind == "ip":
        octets = F.transform(F.split(match, r"\."), lambda x: F.lower(F.conv(x, 10, 16)))
        forms = [swap(r"\.", "[.]"), F.concat(F.lit("2001:db8:0:0:"), F.array_join(octets, ":")), F.concat(F.lit("fe80:0:0:0:"), F.array_join(octets, "c7:"))]
    elif kind == "card":
        forms = [swap("[ -]", "."), swap("[ -]", "/"), F.regexp_extract(match, "^[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}", 0)]
    else:
        forms = [swap(r"^\+", ""), swap(r"^\+", "00"), swap(r"^\+[0-9]{1,3}[ .-]*", "")]
    return F.filter(F.array(*forms), lambda x: x.rlike(f"^(?:{LOOSE[kind]})$"))


def _matches(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """Adds ``name``: (start, end, match, before, after) of each match, in code points.

    Match i starts after i + 1 pieces between matches and i matches. Their lengths are added up in
    steps, so that a text with very many matches takes no quadratic time.
    """
    text = F.col("text_")
    some = text.rlike(needs)
    df = df.withColumn("m_", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("p_", F.when(F.size("m_") > 0, F.split(text, pattern, -1)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn(
        "w_",
        F.transform("m_", lambda m, i: (F.length(m) + F.length(F.get("p_", i))).cast("long")),
    )
    add = lambda a, b: a + b
    total = lambda array, start, n: F.aggregate(F.slice(array, start, n), F.lit(0).cast("long"), add)
    steps = F.sequence(F.lit(0), F.floor(F.size("w_") / _STEP).cast("int"))
    df = df.withColumn("s_", F.transform(steps, lambda k: total("w_", k * _STEP + 1, F.lit(_STEP))))
    df = df.withColumn("o_", F.transform("s_", lambda _, k: total("s_", F.lit(1), k)))

    def span(m: Column, i: Column) -> Column:
        k = F.floor(i / _STEP).cast("int")
        start = F.get("o_", k) + total("w_", k * _STEP + 1, i - k * _STEP) + F.length(F.get("p_", i))
        return F.struct(
            start.alias("start"),
            (start + F.length(m)).alias("end"),
            m.alias("match"),
            F.right(F.get("p_", i), F.lit(32)).alias("before"),
            F.left(F.get("p_", i + 1), F.lit(1)).alias("after"),
        )

    return df.withColumn(name, F.transform("m_", span)).drop("m_", "p_", "w_", "s_", "o_")


def _features(kind: str, c: Column, match: Column | None = None) -> Column:
    """The features of match ``c``, or of ``match`` in its place."""
    match = c["match"] if match is None else match
    count = lambda pattern: F.length(F.regexp_replace(match, pattern, ""))
    near = F.lower(c["before"])
    values = [
        F.lit(KINDS.index(kind)),
        F.length(match),
        count("[^0-9]"),
        count("[^A-Za-z]"),
        count("[A-Za-z0-9]"),
        F.size(F.split(match, "[^A-Za-z0-9]+")),
        F.right(c["before"], F.lit(1)).rlike(r"[\p{L}0-9_]"),
        c["after"].rlike(r"[\p{L}0-9_]"),
        *[near.rlike(CONTEXT[k]) for k in KINDS],
    ]
    return F.array(*[F.coalesce(v.cast("double"), F.lit(0.0)) for v in values])


def proposals(docs: DataFrame, text: str = "text", training: bool = False) -> DataFrame:
    """``docs`` with ``base`` (strict spans) and ``proposed`` (generated spans with features).

    With ``training`` also ``disguised``: kind and features of the loose forms of the strict spans.
    """
    df = docs.withColumn("text_", F.coalesce(F.col(text), F.lit("")))
    for kind in KINDS:
        df = _matches(df, f"b_{kind}", BASE[kind], NEEDS[kind])
        df = _matches(df, f"l_{kind}", LOOSE[kind], NEEDS[kind])

    def base(kind: str) -> Column:
        valid = F.filter(f"b_{kind}", lambda c: _valid(kind, c["match"]))
        return F.transform(valid, lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), c["end"].alias("end"), F.lit(kind).alias("kind")))

    def proposed(kind: str) -> Column:
        shape = lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), c["end"].alias("end"), F.lit(kind).alias("kind"), _plausible(kind, c["match"]).alias("plausible"), _features(kind, c).alias("features"))
        return F.transform(f"l_{kind}", shape)

    def disguised(kind: str) -> Column:
        valid = F.filter(f"b_{kind}", lambda c: _valid(kind, c["match"]))
        shape = lambda c: F.transform(_disguised(kind, c["match"]), lambda m: F.struct(F.lit(kind).alias("kind"), _features(kind, c, m).alias("features")))
        return F.flatten(F.transform(valid, shape))

    # The optimiser must not copy all this into a filter on the results, where it would run per element:
    # it moves no filter below a random value.
    df = df.withColumn("base", F.when(F.rand(0) >= 0, F.array_sort(F.concat(*[base(k) for k in KINDS]))))
    df = df.withColumn("proposed", F.concat(*[proposed(k) for k in KINDS]))
    if training:
        df = df.withColumn("disguised", F.concat(*[disguised(k) for k in KINDS]))
    return df.drop("text_", *[f"{p}_{k}" for p in "bl" for k in KINDS])


def _hits(base: Column | str, c: Column) -> Column:
    return F.exists(base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))


class Model:
    """Boosted trees and thresholds as column expressions; ``trees`` is empty where nothing was learned."""

    def __init__(self, trees: list[tuple[float, list]], thresholds: dict[str, float]) -> None:
        self.trees, self.thresholds = trees, thresholds

    def score(self, features: str) -> str:
        def value(node: list) -> str:
            if len(node) == 1:
                return f"{node[0]!r}D"
            feature, limit, left, right = node
            return f"IF({features}[{feature}] <= {limit!r}D, {value(left)}, {value(right)})"

        return f"1 / (1 + exp(-2 * ({' + '.join(f'{w!r}D * {value(t)}' for w, t in self.trees)})))"

    def selected(self, proposed: str) -> Column:
        """The proposals whose score reaches the threshold of their kind."""
        known = [f"(c.kind = '{k}' AND {limit!r}D <= {self.score('c.features')})" for k, limit in self.thresholds.items()]
        return F.expr(f"filter({proposed}, c -> {' OR '.join(known) or 'false'})")


def _tree(lines: list[str]) -> list:
    """A printed tree as [value] or [feature, limit, left, right]."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return [float(line.split(":")[1])]
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    left = _tree(lines)
    lines.pop(0)  # Else
    return [int(feature), float(limit), left, _tree(lines)]


def read_trees(model: GBTClassificationModel) -> list[tuple[float, list]]:
    found = []
    for tree, weight in zip(model.trees, model.treeWeights):
        lines = [x for x in tree.toDebugString.splitlines() if x.strip().startswith(("If", "Else", "Predict"))]
        found.append((float(weight), _tree(lines)))
    return found


def examples(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, features, label, plausible, held_out, weight): the different examples of all documents and how often they occur."""
    # no word of its own kind before it
    alone = lambda c: F.get(c["features"], F.get(c["features"], F.lit(0)).cast("int") + len(_FORMAT)) == 0
    example = lambda c, label, plausible: F.struct(c["kind"].alias("kind"), c["features"].alias("features"), F.lit(label).alias("label"), plausible.alias("plausible"))
    false = F.filter("proposed", lambda c: (alone(c) | ~c["plausible"]) & ~_hits("base", c))
    found = F.concat(F.transform(false, lambda c: example(c, 0.0, c["plausible"])), F.transform("disguised", lambda c: example(c, 1.0, F.lit(True))))
    held_out = F.pmod(F.xxhash64(text, F.lit(1)), F.lit(4)) == 0
    return (
        proposals(docs.select(text), text, training=True)
        .select(held_out.alias("held_out"), F.explode_outer(found).alias("c"))
        .filter("c is not null")
        .groupBy("c.kind", "c.features", "c.label", "c.plausible", "held_out")
        .agg(F.count("*").cast("double").alias("weight"))
    )


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Trees from the examples of all documents, thresholds from a quarter of the documents held out."""
    rows = examples(docs, text).withColumn("features", array_to_vector("features")).persist()
    try:
        classes = {tuple(r) for r in rows.groupBy("held_out", "label").count().select("held_out", "label").collect()}
        if len(classes) < 4:
            return Model([], {})
        trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7, weightCol="weight", maxBins=MAX_BINS)
        fitted = trees.fit(rows.filter("not held_out"))
        model = Model(read_trees(fitted), {})
        scored = fitted.transform(rows.filter("held_out and plausible"))
        positive = F.element_at(F.from_json(F.to_json(F.struct("probability")), "probability struct<values:array<double>>")["probability"]["values"], 2)
        bins = scored.groupBy("kind", F.floor(positive * 100).alias("bin")).agg(F.sum("weight").alias("n"), F.sum(F.col("label") * F.col("weight")).alias("true")).collect()
        for kind in KINDS:
            n = true = 0
            for b in sorted((b for b in bins if b["kind"] == kind), key=lambda b: -b["bin"]):
                n, true = n + b["n"], true + b["true"]
                if n >= SUPPORT and true >= PRECISION * n:
                    model.thresholds[kind] = b["bin"] / 100
        return model
    finally:
        rows.unpersist()


def find_spans(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (base spans and selected plausible proposals that overlap none)."""
    df = proposals(docs, text)
    added = F.filter(model.selected("proposed"), lambda c: c["plausible"] & ~_hits("base", c))
    plain = F.transform(added, lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind")))
    return df.withColumn("spans", F.array_sort(F.array_union("base", plain))).drop("proposed")


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in square brackets (overlaps: the first span wins)."""
    df = find_spans(docs, model, text)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    body = F.coalesce(F.col(text), F.lit(""))

    def step(acc: Column, s: Column) -> Column:
        piece = F.substring(body, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        grown = F.struct(s["end"].alias("at"), F.concat(acc["out"], piece, F.lit("["), s["kind"], F.lit("]")).alias("out"))
        return F.when(s["start"] >= acc["at"], grown).otherwise(acc)

    rest = lambda acc: F.concat(acc["out"], F.substring(body, (acc["at"] + 1).cast("int"), F.length(body)))
    done = F.aggregate("spans", start, step, rest)
    return df.withColumn(text, F.when(F.col(text).isNotNull(), done)).select(*docs.columns)


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: base spans by kind, their digest, and all spans as text."""
    docs = docs.select("doc_id", "text")
    df = find_spans(docs, fit(docs))
    said = lambda spans: F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return df.select("doc_id", *[of(k) for k in KINDS], F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))
