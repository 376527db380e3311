"""Language ID: each document as a mixture of languages.

Training counts the byte trigrams of all words of every labelled document: a word stands between two
spaces, A-Z count as a-z. The counts of a trigram are added up by Spark; the model has at most
``GRAMS`` of them for each language, which bounds what is sent to the tasks.

A word's likelihood under a language is the product over its trigrams. For each document,
expectation-maximisation over its words estimates the share of each language. The language set is
the one of the k most frequent languages, k = 1, 2, ..., whose likelihood less a penalty of half
the logarithm of the number of words for each further language is largest. The language with the
largest share in that set is predicted; the share is the score. A text that the set explains no better than
trigrams drawn blindly from those seen is not explained: it has a prediction, but ``with_language`` leaves it out.

Defined results: null text, empty text and text without letters give ``und`` with score 0, and so
does every text where nothing was learned; documents without a language or an id are not learned
from; ties go to the first language by name; texts of any length are used whole; repeated rows each
get a row; other columns are ignored. More than ``MAX_LANGUAGES`` labels raise an error.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_set, mix, ranges, slices, text_bytes, words

GRAMS = 1 << 18
MAX_LANGUAGES = 256
UNDETERMINED = "und"
SMOOTHING = 0.5
#: Log of the odds at which a text is rejected: about one in 20,000.
DOUBT = 10.0
ROUNDS, MOVED = 15, 1e-3
SLICE_BYTES = 1 << 20

LETTERS = ascii_set((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def grams_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the byte trigrams of the given words, and how many each word has."""
    counts = ends - starts
    at = ranges(starts, counts)
    padded = np.full(int(counts.sum()) + 2 * len(counts), 0x20, dtype=np.uint8)
    begins = np.cumsum(counts + 2) - (counts + 2)
    letters = data[at]
    padded[ranges(begins + 1, counts)] = letters + 32 * ((letters >= 0x41) & (letters <= 0x5A)).astype(np.uint8)
    middle = ranges(begins, counts)
    code = (padded[middle].astype(np.uint64) << np.uint64(16)) | (padded[middle + 1].astype(np.uint64) << np.uint64(8)) | padded[middle + 2]
    return (mix(code + np.uint64(1)) >> np.uint64(46)).astype(np.int64), counts


def _distinct_words(batch: pa.RecordBatch):
    data, bounds = text_bytes(batch.column(batch.schema.get_field_index("text")))
    prints, starts, ends, rows = words(data, bounds, LETTERS, lower=True)
    _, first, use = np.unique(prints, return_index=True, return_inverse=True)
    return data, starts[first], ends[first], use, rows


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(GRAMS, dtype=np.int64))

    def drained() -> Iterator[pa.RecordBatch]:
        for lang, counts in total.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int64()), pa.array(counts[some])], names=["lang", "gram", "n"])
        total.clear()

    for whole in batches:
        for batch in slices(whole, "text", SLICE_BYTES):
            data, starts, ends, use, rows = _distinct_words(batch)
            grams, counts = grams_of(data, starts, ends)
            langs = batch.column(batch.schema.get_field_index("lang")).to_pylist()
            names = sorted(set(langs))
            of = np.repeat(np.array([names.index(x) for x in langs]), np.diff(rows))
            for k, lang in enumerate(names):
                uses = np.bincount(use[of == k], minlength=len(starts))
                total[lang] += np.bincount(grams, weights=np.repeat(uses, counts), minlength=GRAMS).astype(np.int64)
        if len(total) > 64:
            yield from drained()
    yield from drained()


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Model:
    """Log likelihoods of trigrams: ``table[number of the trigram, language]``; ``seen`` of them were learned from."""

    def __init__(self, languages: list[str], table: np.ndarray, seen: int = 0) -> None:
        self.languages, self.table, self.seen = languages, table, seen


def learn(docs: DataFrame) -> Model:
    """From ``text`` and ``lang`` of all given documents."""
    counts = docs.select("text", F.col("lang").cast("string").alias("lang")).filter("lang is not null and text is not null")
    counts = counts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    languages = sorted(r[0] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} different languages")
    if not languages:
        return Model([], np.zeros((GRAMS, 0), dtype=np.float32))
    found = np.zeros((GRAMS, len(languages)))
    rows = counts.toArrow()
    number = {x: k for k, x in enumerate(languages)}
    of = np.array([number[x] for x in rows["lang"].to_pylist()], dtype=np.int64)
    found[rows["gram"].to_numpy(), of] = rows["n"].to_numpy()
    seen = int((found.sum(axis=1) > 0).sum())
    table = np.log((found + SMOOTHING) / (found.sum(axis=0) + SMOOTHING * (seen + 1)))
    return Model(languages, table.astype(np.float32), seen)


def _em(share: np.ndarray, chance: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages and log likelihood of each document; a share of 0 stays 0."""
    sizes = np.diff(np.append(first, len(doc)))[:, None]
    for _ in range(ROUNDS):
        joint = share[doc] * chance
        joint /= joint.sum(axis=1, keepdims=True)
        new = np.add.reduceat(joint, first, axis=0) / sizes
        moved = np.abs(new - share).max()
        share = new
        if moved < MOVED:
            break
    return share, np.add.reduceat(np.log((share[doc] * chance).sum(axis=1)), first)


def mixtures(log_chance: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the languages in the chosen set of each document, and the penalised log likelihood; ``sizes`` (over 0) gives its words."""
    n_lang = log_chance.shape[1]
    first = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(sizes)), sizes)
    alone = np.add.reduceat(log_chance, first, axis=0)
    top = log_chance.max(axis=1, keepdims=True)
    chance = np.maximum(np.exp(log_chance - top), 1e-30)
    base = np.add.reduceat(top[:, 0], first)
    share, full = _em(np.full((len(sizes), n_lang), 1.0 / n_lang), chance, doc, first)
    order = np.argsort(-share, axis=1, kind="stable")
    best = alone.argmax(axis=1)
    chosen = np.zeros_like(share)
    chosen[np.arange(len(sizes)), best] = 1.0
    penalty = 0.5 * np.log(np.maximum(sizes, 2))
    value = alone[np.arange(len(sizes)), best]
    # no set can gain more than all languages together do
    open_ = full + base - penalty > value
    for k in range(2, n_lang + 1):
        if not open_.any():
            break
        rows = np.flatnonzero(open_)
        part = open_[doc]
        some = np.zeros((len(rows), n_lang))
        np.put_along_axis(some, order[rows, :k], np.take_along_axis(np.maximum(share[rows], 1e-6), order[rows, :k], axis=1), axis=1)
        some /= some.sum(axis=1, keepdims=True)
        own = sizes[rows]
        got, found = _em(some, chance[part], np.repeat(np.arange(len(rows)), own), np.cumsum(own) - own)
        found = found + base[rows] - (k - 1) * penalty[rows]
        better = found > value[rows]
        value[rows[better]] = found[better]
        chosen[rows[better]] = got[better]
        open_ &= full + base - k * penalty > value
    return chosen, value


def _predict(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                data, starts, ends, use, rows = _distinct_words(batch)
                sizes = np.diff(rows)
                texts = batch.column(batch.schema.get_field_index("text"))
                ascii_letter = (data < 0x80) & LETTERS[data]
                _, bounds = text_bytes(texts)
                seen = np.concatenate(([0], np.cumsum(ascii_letter)))
                known = seen[bounds[1:]] > seen[bounds[:-1]]
                for i in np.flatnonzero(~known & (sizes > 0)):
                    known[i] = any(c.isalpha() for c in texts[int(i)].as_py())
                shares = np.zeros((batch.num_rows, max(1, len(model.languages))))
                explained = np.zeros(batch.num_rows, dtype=bool)
                if model.languages and known.any():
                    grams, counts = grams_of(data, starts, ends)
                    each = np.add.reduceat(model.table[grams].astype(np.float64), np.cumsum(counts) - counts, axis=0)
                    words_ = use[np.repeat(known, sizes)]
                    shares[known], value = mixtures(each[words_], sizes[known])
                    trigrams = np.add.reduceat(counts[words_], np.cumsum(sizes[known]) - sizes[known])
                    explained[known] = value + DOUBT > -np.log(max(2, model.seen)) * trigrams
                best = shares.argmax(axis=1)
                pred = [model.languages[k] if s else UNDETERMINED for k, s in zip(best, shares.any(axis=1))]
                names = model.languages
                sets = [{names[k]: float(s[k]) for k in np.flatnonzero(s)} if names else {} for s in shares]
                done = {"lang_pred": pa.array(pred, pa.string()), "score": pa.array(np.minimum(shares.max(axis=1), 1.0)), "shares": pa.array([list(x.items()) for x in sets], pa.map_(pa.string(), pa.float64())), "explained": pa.array(explained)}
                order = [c for c in batch.schema.names if c not in done and c != "text"] + list(done)
                yield pa.RecordBatch.from_arrays([done[c] if c in done else batch.column(batch.schema.get_field_index(c)) for c in order], names=order)

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without its text, with ``lang_pred``, ``score``, ``shares`` (language to share) and ``explained``.

    A text is explained unless trigrams drawn blindly, all that were seen alike, are likelier than the chosen
    languages by more than ``DOUBT``.
    """
    rest = docs.drop("lang_pred", "score", "shares", "explained")
    schema = rest.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "shares": F.lit(None).cast("map<string,double>"), "explained": F.lit(True)}).schema
    return rest.mapInArrow(_predict(model), schema)


def with_language(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The documents, in all their columns, that a language or a mixture of languages explains."""
    inner = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].alias("text"))
    return identify(inner, learn(labelled)).filter((F.col("lang_pred") != UNDETERMINED) & F.col("explained")).select("row.*")


def languages(docs: DataFrame) -> DataFrame:
    """One row per document, learned from the documents that are not held out."""
    marked = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", "lang")
    model = learn(marked.filter("doc_id is not null and not held_out"))
    return identify(marked.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score", F.array_sort(F.map_keys("shares")).alias("languages"))
