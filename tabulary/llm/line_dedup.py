"""Line deduplication by winnowing.

Every run of ``SPAN`` words of a text's lines has a hash, whatever line ends or
sentences it crosses, so that a passage may begin and end anywhere. Of each
``WINDOW`` neighbouring hashes the smallest is a fingerprint: two texts that
share a run of ``PASSAGE`` (50) words share one, at the same place of the run.

Places whose fingerprint repeats are joined with the first place that matches,
and the match is extended both ways:

1. A place's reach is all runs of ``PASSAGE`` words in which its fingerprint is
   the smallest hash, taken together. A place whose reach has the words of an
   earlier one's matches it over the whole of it.
2. Of places that have the same fingerprint but not the same reach, the first of
   each reach is extended step by step: each run of ``PASSAGE`` words in its reach
   is joined with the first place that has that run.

Both find runs of ``PASSAGE`` words or more that one earlier place has whole, and
together they find all of them. A text's repeated run is what overlapping
matches cover; it is deleted to the word, so that a passage's first place stays.
Places are joined with first places alone, never with each other: a line that
every document has costs a row for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACED, bit_map, chain, in_map, map_arrow, materialize, ramp, slices, with_bit, words

SPAN, WINDOW = 26, 25
SIDE = WINDOW - 1
PASSAGE = SPAN + SIDE
_NONE = np.iinfo(np.int64).min


def _sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``pick`` over every ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return pick(x[: len(x) - rest], x[rest:])


class Runs:
    """Hashes of runs of words, from those of runs half as long."""

    def __init__(self, hashes: np.ndarray):
        self.level = [hashes]
        while len(self.level) < 7 and len(x := self.level[-1]) > (step := 1 << len(self.level) - 1):
            self.level.append(chain(x[:-step], x[step:]))

    def every(self, width: int) -> np.ndarray:
        """Of ``width`` words from each word on."""
        n = len(self.level[0]) - width + 1
        acc, done = None, 0
        for k in range(len(self.level) - 1, -1, -1):
            if width >> k & 1:
                piece = self.level[k][done : done + n]
                acc = piece if acc is None else chain(acc, piece)
                done += 1 << k
        return acc

    def of(self, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Of each run; ``size`` is less than 128."""
        acc, at = size.astype(np.uint64), start.copy()
        for k in range(len(self.level) - 1, -1, -1):
            own = np.flatnonzero(size >> k & 1)
            acc[own] = chain(acc[own], self.level[k][at[own]])
            at[own] += 1 << k
        return acc


class Places:
    """Fingerprints of the texts of a slice."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        hashes, _, self.first = words(data, at, SPACED)
        n = len(hashes) - PASSAGE + 1
        self.at = np.zeros(0, np.int64)
        if n <= 0:
            self.gram = self.at
            return
        self.runs = Runs(hashes)
        gram = self.runs.every(SPAN).view(np.int64)
        end = np.repeat(self.first[1:], np.diff(self.first))[:n]
        # the smallest hash of each run of PASSAGE words, of those that lie in one text
        self.low = np.where(np.arange(n) + PASSAGE <= end, _sliding(np.minimum, gram, WINDOW), _NONE)
        most = _sliding(np.maximum, np.pad(self.low, SIDE, constant_values=_NONE), WINDOW)
        self.at = np.flatnonzero((gram == most) & (most > _NONE))
        self.gram = gram[self.at]

    def keep(self, wanted: np.ndarray) -> None:
        self.at, self.gram = self.at[wanted], self.gram[wanted]

    def reach(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each place: the first of the runs of PASSAGE words in which it is the smallest, and their number."""
        start = self.at[:, None] - np.arange(SIDE, -1, -1)
        known = np.clip(start, 0, len(self.low) - 1)
        own = (start == known) & (self.low[known] == self.gram[:, None])
        return self.at - SIDE + own.argmax(axis=1), own.sum(axis=1)


def _repeated_fingerprints(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array(Places(data, at).gram)], names=["gram"])

    return map_arrow(texts.select("text"), run, "gram long").groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram")


def _later(places: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The places that are not the first with their keys, and the first of each (keys, ``own``)."""
    place = F.struct("doc_id", "version", "at")
    # written, so that both sides of the join are plain shuffles and Spark can split a key that very many places have
    firsts = materialize(places.groupBy(*keys).agg(F.min(place).alias("own")), "firsts")
    return places.join(firsts, keys).where(place != F.col("own")), firsts


def _of_texts(docs: DataFrame, listed: DataFrame, only: bool = False) -> tuple[DataFrame, np.ndarray]:
    """The rows of ``docs`` that ``listed`` (doc_id, version, ..) has, with its columns, and the bit map that chose them.

    Only texts with a bit in the map are shuffled.
    """
    listed = materialize(listed, "listed")
    seen = bit_map(listed.select(F.xxhash64("doc_id", "version")))
    chosen = with_bit(docs.select("doc_id", "version", "key", "text"), "key", seen)
    return chosen.join(listed.hint("merge"), ["doc_id", "version"], "inner" if only else "left"), seen


def repeated_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, version, lo, hi``: word ranges of ``docs`` (doc_id, version, key, text) that one earlier place has whole, PASSAGE words at least."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_map(_repeated_fingerprints(docs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            places = Places(data, at)
            places.keep(in_map(shared.value, places.gram))
            if not len(places.at):
                continue
            begin, count = places.reach()
            size = count + PASSAGE - 1
            around = chain(places.runs.of(begin, size), (places.at - begin).astype(np.uint64)).view(np.int64)
            text = np.searchsorted(places.first, places.at, "right") - 1
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(own), part.column(1).take(own), pa.array(places.gram), pa.array(around), pa.array((begin - places.first[text]).astype(np.int32)), pa.array(size.astype(np.int32))],
                names=["doc_id", "version", "gram", "around", "at", "size"],
            )

    places = materialize(map_arrow(docs.select("doc_id", "version", "text"), run, "doc_id long, version long, gram long, around long, at int, size int"), "places")
    later, firsts = _later(places, ["gram", "around"])
    whole = later.select("doc_id", "version", F.col("at").alias("lo"), (F.col("at") + F.col("size")).alias("hi"))

    # fingerprints with several reaches
    mixed = materialize(firsts.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "mixed")
    apart = firsts.join(mixed, "gram", "left_semi").select("own.*").groupBy("doc_id", "version").agg(F.collect_set("at").alias("begins"))
    chosen, _ = _of_texts(docs, apart, only=True)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            begins = part.column(3)
            text = np.repeat(np.arange(part.num_rows), np.asarray(begins.value_lengths()))
            places = Places(data, at)
            begin, count = places.reach()
            own = np.isin(begin, np.asarray(begins.flatten()) + places.first[text])
            start = ramp(begin[own], count[own])
            text = np.searchsorted(places.first, start, "right") - 1
            passage = places.runs.of(start, np.full(len(start), PASSAGE)).view(np.int64)
            own = pa.array(text)
            yield pa.RecordBatch.from_arrays([part.column(0).take(own), part.column(1).take(own), pa.array(passage), pa.array((start - places.first[text]).astype(np.int32))], names=["doc_id", "version", "passage", "at"])

    stepped = materialize(map_arrow(chosen.select("doc_id", "version", "text", "begins"), steps, "doc_id long, version long, passage long, at int"), "steps")
    stepped = _later(stepped, ["passage"])[0].select("doc_id", "version", F.col("at").alias("lo"), (F.col("at") + PASSAGE).alias("hi"))
    return whole.unionByName(stepped)


def without(data: np.ndarray, at: np.ndarray, spans: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts of a slice without ``spans`` (text, first word, word behind), their offsets, each text's lines, and those left without a word."""
    _, starts, first = words(data, at, SPACED, hashed=False)
    n = len(starts)
    text, lo, hi = spans
    change = np.bincount(first[text] + lo, minlength=n + 1) - np.bincount(first[text] + hi, minlength=n + 1)
    gone = np.cumsum(change)[:n] > 0
    # a word goes with all up to the next one
    until = np.append(starts[1:], len(data))
    owner = np.repeat(np.arange(len(at) - 1), np.diff(first))
    until = np.minimum(until, at[owner + 1])
    change = np.bincount(starts[gone], minlength=len(data) + 1) - np.bincount(until[gone], minlength=len(data) + 1)
    kept = np.cumsum(change)[: len(data)] == 0
    # lines, by their first words
    before = np.concatenate([[0], np.cumsum(data == 0x0A)])
    line = before[starts]
    head = np.flatnonzero(np.append(True, (line[1:] != line[:-1]) | (owner[1:] != owner[:-1]))[:n])
    empty = np.minimum.reduceat(gone, head) if len(head) else np.zeros(0, bool)
    lines = np.bincount(owner[head], minlength=len(at) - 1)
    removed = np.bincount(owner[head[empty]], minlength=len(at) - 1)
    return data[kept], np.concatenate([[0], np.cumsum(kept)])[at], lines, removed


def count_lines(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many lines of each text have words."""
    if not len(data):
        return np.zeros(len(at) - 1, np.int64)
    cuts = np.unique(np.concatenate([at, np.flatnonzero(data == 0x0A) + 1]))
    some = np.logical_or.reduceat(SPACED[data], cuts[:-1])
    return np.diff(np.concatenate([[0], np.cumsum(some)])[np.searchsorted(cuts, at)])


def dedup_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id, text`` without repeated runs, ``n_lines``, ``n_removed``.

    Every word that lies in a run of ``PASSAGE`` words which an earlier place has
    goes, and no other, with the white space behind it. Earlier is by id, then
    position, also within one text; a later copy of a whole text of that many
    words is left empty. White space and letter case (A-Z) do not matter in the
    comparison; what stays is as it was. ``n_lines`` are the lines that have
    words, ``n_removed`` those of them that have none left.

    A null text stays null, and a row with a null id is neither changed nor
    counted as a first place. Rows with the same id and text are one place, so
    they do not delete each other; rows with the same id and other texts stand in
    the order of their texts' hashes. An empty table gives no rows; other
    columns are ignored.
    """
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("version", F.xxhash64("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "version"))
    spans = repeated_runs(rows.where("doc_id is not null and text is not null"))
    listed = spans.groupBy("doc_id", "version").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))  # within one text
    joined, seen = _of_texts(rows, listed)
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            known = np.asarray(part.column(1).is_valid(), bool)
            spans = part.column(2)
            ranges, owner = spans.flatten(), np.repeat(np.arange(part.num_rows), np.asarray(spans.value_lengths().fill_null(0)))
            left, offsets, lines, removed = without(data, at, (owner, *(np.asarray(ranges.field(k), np.int64) for k in (0, 1))))
            buffers = [pa.py_buffer(np.packbits(known, bitorder="little")), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(left)]
            texts = pa.StringArray.from_buffers(part.num_rows, buffers[1], buffers[2], buffers[0])
            yield pa.RecordBatch.from_arrays([part.column(0), texts, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())], names=["doc_id", "text", "n_lines", "n_removed"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~in_map(shared.value, np.asarray(batch.column(2)))))
            for part, data, at in slices([batch], "text"):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(count_lines(data, at)), pa.array(np.zeros(part.num_rows, np.int64))], names=["doc_id", "text", "n_lines", "n_removed"])

    out = "doc_id long, text string, n_lines long, n_removed long"
    changed = map_arrow(joined.select("doc_id", "text", "spans"), change, out)
    return changed.unionByName(map_arrow(rows.select("doc_id", "text", "key"), count, out))
