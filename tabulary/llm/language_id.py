"""Language identification by hyperdimensional profiles.

A letter is a random vector of +1 and -1. A trigram binds three letter vectors,
each rotated by its place, by multiplication; a text bundles its trigrams by
addition; a language bundles its texts. A text's language is that of the
prototype with the largest cosine.

Bundling is linear, so a text's product with a prototype is the sum of its
trigrams' products, and each distinct trigram is bound once and then kept as one
number per language. The length of a text's bundle is that of a sum of
orthogonal vectors, which random vectors of 1,024 dimensions are but for a few
per cent; it divides all of a text's products alike.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, mix64, slices

DIMENSIONS = 1024
#: Texts a language's prototype is fitted on, about (all, where it has fewer).
TRAINING_TEXTS = 2000
#: Trigrams bound at once, of DIMENSIONS bytes each, and numbers that a worker keeps of trigrams.
BOUND_TRIGRAMS, KEPT_NUMBERS = 2048, 1 << 22
#: Languages that prototypes are made of, at most: a wrong column would fill the driver.
MAX_LANGUAGES = 10_000
_SCALE = 1 << 20


@functools.cache
def _symbols() -> np.ndarray:
    """Code point -> lower-case letter, or 0 for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        if (x := chr(c)).isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def letter_bits(letters: np.ndarray) -> np.ndarray:
    """The letters' random vectors as bits (1 is +1): the same in every process."""
    with np.errstate(over="ignore"):
        seed = np.arange(DIMENSIONS // 64, dtype=np.uint64) + letters.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        return np.unpackbits(mix64(mix64(seed)).view(np.uint8), axis=1)


def trigram_vectors(keys: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 for each trigram: its letters' vectors, rotated by their places, multiplied."""
    letters = np.stack([keys >> 42, keys >> 21 & (1 << 21) - 1, keys & (1 << 21) - 1])
    known, place = np.unique(letters, return_inverse=True)
    bits, place = letter_bits(known), place.reshape(letters.shape)
    # of signs as bits, the product is the exclusive or; two of them leave +1 as 1
    both = np.roll(bits, 2, axis=1)[place[0]] ^ np.roll(bits, 1, axis=1)[place[1]] ^ bits[place[2]]
    return both.astype(np.float32) * 2 - 1


class _Products:
    """Products of the trigrams met so far with the prototypes, up to a limit."""

    def __init__(self, prototypes: np.ndarray) -> None:
        self.prototypes = prototypes.T.astype(np.float32)
        self.limit = KEPT_NUMBERS // max(1, len(prototypes))
        self.keys, self.rows = np.zeros(0, np.int64), np.zeros((0, len(prototypes)), np.float32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Rows for sorted, distinct ``keys``."""
        out = np.empty((len(keys), self.prototypes.shape[1]), np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        old = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        out[old] = self.rows[at[old]]
        new = np.flatnonzero(~old)
        for k in range(0, len(new), BOUND_TRIGRAMS):
            some = new[k : k + BOUND_TRIGRAMS]
            out[some] = trigram_vectors(keys[some]) @ self.prototypes
        if len(new):
            if len(self.keys) + len(new) > self.limit:
                self.keys, self.rows, new = self.keys[:0], self.rows[:0], new[: self.limit]
            joined = np.concatenate([self.keys, keys[new]])
            order = np.argsort(joined, kind="stable")
            self.keys, self.rows = joined[order], np.concatenate([self.rows, out[new]])[order]
        return out


def trigram_counts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, trigram, count), sorted by text; trigrams stay within words, whose edges count as a space."""
    text = data.tobytes().decode("utf-8", "replace")
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[at]
    if place[-1] != len(points):  # bytes that are no UTF-8
        parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])]
        points = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    n = len(at) - 1
    symbol = np.append(np.insert(_symbols()[points], place[:-1], 0), np.uint32(0))
    owner = np.append(np.insert(np.repeat(np.arange(n), np.diff(place)), place[:-1], np.arange(n)), n)
    keep = np.append(True, (symbol[1:] != 0) | (symbol[:-1] != 0))
    symbol, owner = symbol[keep], owner[keep]
    if len(symbol) < 3:
        return (np.zeros(0, np.int64),) * 3
    used, dense = np.unique(symbol, return_inverse=True)
    m = len(used)
    middle = symbol[1:-1] != 0
    code = (dense[:-2][middle] * m + dense[1:-1][middle]) * m + dense[2:][middle]
    pairs, count = np.unique(owner[1:-1][middle] * m**3 + code, return_counts=True)
    doc, code = pairs // m**3, pairs % m**3
    used = used.astype(np.int64)
    return doc, (used[code // (m * m)] << 42) | (used[code // m % m] << 21) | used[code % m], count


def text_lengths(doc: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Lengths of the texts' bundles, as of sums of orthogonal trigrams."""
    return np.sqrt(DIMENSIONS * np.bincount(doc, weights=count.astype(np.float64) ** 2, minlength=n))


@dataclass
class Profiles:
    languages: list[str]
    vectors: np.ndarray  # a row of length 1 per language

    def products(self) -> _Products:
        """A worker's store of trigrams' products with these prototypes."""
        if not hasattr(self, "_products"):
            self._products = _Products(self.vectors)
        return self._products


def fit(docs: DataFrame, doc: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = TRAINING_TEXTS) -> Profiles:
    """Prototypes of the languages in ``docs``, from about ``per_language`` texts of each.

    The sample is the texts whose hashed id lies under the language's share, so
    reruns agree. Rows with a null language or text are left out. Sums are of
    whole numbers, so their order does not matter. The driver gets DIMENSIONS
    numbers per language, of MAX_LANGUAGES at most.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = dict(rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"{lang} has {len(counts)} values; more than {MAX_LANGUAGES} are no languages")
    if not counts:
        return Profiles([], np.zeros((0, DIMENSIONS), np.float32))
    shares = spark.createDataFrame([(k, per_language / n) for k, n in counts.items()], "lang string, share double")
    draw = F.pmod(F.xxhash64(F.lit("profile"), F.coalesce("doc_id", F.lit(-1))), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(shares), "lang").where(draw < F.col("share")).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for part, data, at in slices(batches, "text"):
            doc, key, count = trigram_counts(data, at)
            weight = np.rint(count / np.maximum(text_lengths(doc, count, part.num_rows), 1e-30)[doc] * _SCALE)
            names = np.array(part.column(0).to_pylist(), object)
            for name in set(names):
                own = np.flatnonzero(names[doc] == name)
                keys, place = np.unique(key[own], return_inverse=True)
                total = np.bincount(place, weights=weight[own], minlength=len(keys))
                for k in range(0, len(keys), BOUND_TRIGRAMS):
                    made = total[k : k + BOUND_TRIGRAMS] @ trigram_vectors(keys[k : k + BOUND_TRIGRAMS]).astype(np.float64)  # whole numbers
                    sums[name] = sums.get(name, 0) + np.rint(made).astype(np.int64)
        names = list(sums)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([sums[k] for k in names], pa.list_(pa.int64()))], names=["lang", "sums"])

    parts = map_arrow(sample, run, "lang string, sums array<long>").select("lang", F.posexplode("sums").alias("d", "v"))
    totals = parts.groupBy("lang", "d").agg(F.sum("v").alias("v")).collect()
    languages = sorted({r["lang"] for r in totals})
    at = {k: i for i, k in enumerate(languages)}
    vectors = np.zeros((len(languages), DIMENSIONS))
    for r in totals:
        vectors[at[r["lang"]], r["d"]] = r["v"]
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-30)
    return Profiles(languages, vectors.astype(np.float32))


def predict(docs: DataFrame, profiles: Profiles, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every whole text.

    ``score`` is the cosine with the nearest prototype, 0 to 1. A null text,
    one without letters, or any text where nothing was learned is ``und`` with
    score 0. Equal cosines go to the language first by code point. Repeated
    rows are predicted each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)  # DIMENSIONS numbers per language
    picked = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            names, score = nearest(data, at, shared.value)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return map_arrow(picked, run, f"doc_id {picked.schema[0].dataType.simpleString()}, lang_pred string, score double")


def nearest(data: np.ndarray, at: np.ndarray, profiles: Profiles) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text of a slice."""
    names = np.array([*profiles.languages, "und"], object)
    n = len(at) - 1
    best, score = np.full(n, len(profiles.languages)), np.zeros(n)
    doc, key, count = trigram_counts(data, at)
    if not profiles.languages or not len(doc):
        return names[best], score
    distinct, place = np.unique(key, return_inverse=True)
    products = profiles.products().of(distinct).astype(np.float64)
    sums = np.stack([np.bincount(doc, weights=count * products[place, k], minlength=n) for k in range(products.shape[1])], axis=1)
    some = np.unique(doc)
    best[some] = sums[some].argmax(axis=1)
    score[some] = np.clip(sums[some].max(axis=1) / text_lengths(doc, count, n)[some], 0, 1)
    return names[best], score


def keep_languages(docs: DataFrame, profiles: Profiles, languages: list[str] | None = None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text is in one of ``languages``.

    By default any learned language will do, so only ``und`` goes: null texts
    and texts without letters. No row is moved.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, text):
            names, _ = nearest(data, at, shared.value)
            wanted = names != "und" if languages is None else np.isin(names.astype(str), languages)
            yield part.filter(pa.array(wanted, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
