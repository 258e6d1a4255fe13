"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document: each block of consecutive texts holds its
own sorted terms, their posting lists (token positions) and the documents'
borders, so no posting is ever shuffled and a frequent term or passage is
spread over all blocks. The test windows go to every block. There, a window
with a term that the block lacks is out at once; for the others the posting
lists are intersected, shifted by the term's offset, from the rarest term on.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, map_arrow, materialize, quoted, slices, utf8, words

#: The test windows are sent to all executors. Above this size they go in several rounds, one at a time.
MAX_QUERY_BYTES = 64 << 20
#: Free positions between the documents of a block.
GAP = 64

_INDEX = "doc_ids binary, firsts binary, lasts binary, terms binary, heads binary, postings binary, nulls binary"


def build_index(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index of ``docs``, a row per block of about 1 MB of text.

    All tokens of all texts are posted. Texts are lower-cased (A-Z) and cut into
    words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; terms are 64-bit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in slices(batches, "text"):
            ids = rows.column(0)
            block = Block.of_texts(data, at)
            parts = (np.asarray(ids.fill_null(0), np.int64), block.firsts, block.lasts, block.terms, block.heads, block.postings, np.asarray(ids.is_null(), bool))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in parts], names=["doc_ids", "firsts", "lasts", "terms", "heads", "postings", "nulls"])

    return map_arrow(docs.select(quoted(doc).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text")), run, _INDEX)


@dataclass
class Block:
    """The index of a slice of texts: the documents' first and last positions, terms, and their posting lists."""

    firsts: np.ndarray
    lasts: np.ndarray
    terms: np.ndarray
    heads: np.ndarray
    postings: np.ndarray

    @staticmethod
    def of_texts(data: np.ndarray, at: np.ndarray) -> Block:
        hashes, _, first = words(data, at, ALNUM)
        counts = np.diff(first)
        # documents are GAP free positions apart, so that no window spans two
        firsts = first[:-1] + GAP * np.arange(1, len(counts) + 1)
        position = np.arange(len(hashes)) + GAP * np.repeat(np.arange(1, len(counts) + 1), counts)
        terms, place, n = np.unique(hashes, return_inverse=True, return_counts=True)
        heads = np.concatenate([[0], np.cumsum(n)])
        return Block(*(x.astype(np.uint32) for x in (firsts, firsts + counts)), terms, heads.astype(np.uint32), position[np.argsort(place, kind="stable")].astype(np.uint32))

    @staticmethod
    def of_row(row: dict) -> tuple[Block, np.ndarray, np.ndarray]:
        """From a row of the index, with the documents' ids, and which of them are null."""
        kinds = {"firsts": np.uint32, "lasts": np.uint32, "terms": np.uint64, "heads": np.uint32, "postings": np.uint32}
        return Block(*(np.frombuffer(row[k], v) for k, v in kinds.items())), np.frombuffer(row["doc_ids"], np.int64), np.frombuffer(row["nulls"], bool)

    def document(self, position: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, position, "right") - 1


class Windows:
    """Windows of the test texts: runs of ``width`` words; a shorter text is one window."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        data, at = utf8(pa.array([t for _, t in items], pa.string()))
        hashes, _, first = words(data, at, ALNUM)
        self.terms, place = np.unique(hashes, return_inverse=True)
        rows: dict[tuple, set[int]] = {}
        for i in range(len(items)):
            own = place[first[i] : first[i + 1]]
            for k in range(max(1, len(own) - width + 1) if len(own) else 0):
                rows.setdefault(tuple(own[k : k + width]), set()).add(i)
        self.items = [list(x) for x in rows.values()]
        self.size = np.array([len(x) for x in rows], np.int64)
        self.place = np.zeros((len(rows), width), np.int64)
        for i, row in enumerate(rows):
            self.place[i, : len(row)] = row
        self.ids = [i for i, _ in items]

    def names(self, document: np.ndarray, window: np.ndarray, n: int) -> list[list[str]]:
        """Ids of the items whose windows are in each of ``n`` documents, sorted as texts."""
        out: list[set[str]] = [set() for _ in range(n)]
        for d, w in np.unique(np.stack([document, window]), axis=1).T if len(document) else ():
            out[d].update("" if self.ids[i] is None else str(self.ids[i]) for i in self.items[w])
        return [sorted(x) for x in out]


def _members(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return keys[at] == wanted


def _nearest(keys: np.ndarray, wanted: np.ndarray, slop: int) -> np.ndarray:
    """Whether a key lies within ``slop`` of each wanted one (keys of a term are far from another's)."""
    at = np.searchsorted(keys, wanted - slop)
    at[at == len(keys)] = 0
    return np.abs(keys[at] - wanted) <= slop


def search_block(block: Block, queries: Windows, slop: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, document, start) of each match in a block; a start is a position.

    A window matches at a start if each of its terms stands within ``slop`` words
    of its own place there, in the same document; with ``slop`` 0 that is the
    exact phrase. Every start within ``slop`` of a place of the rarest term is tried.
    """
    terms, heads, none = block.terms, block.heads, np.zeros(0, np.int64)
    if not len(terms) or not len(queries.terms):
        return none, none, none
    at = np.searchsorted(terms, queries.terms)
    at[at == len(terms)] = 0
    known = terms[at] == queries.terms
    lengths = np.where(known, heads[at + 1].astype(np.int64) - heads[at], 0)
    used = np.arange(queries.place.shape[1]) < queries.size[:, None]
    per = np.where(used, lengths[queries.place], np.iinfo(np.int64).max)
    live = np.flatnonzero(per.min(axis=1) > 0) if len(per) else none
    if not len(live):
        return none, none, none
    by_rarity = np.argsort(per[live], axis=1, kind="stable")
    # one sorted array of (term, position) answers any membership
    keys = (np.repeat(np.arange(len(terms), dtype=np.int64), np.diff(heads.astype(np.int64))) << 32) | block.postings
    rarest = at[queries.place[live, by_rarity[:, 0]]]
    n = per[live, by_rarity[:, 0]]
    which = np.repeat(np.arange(len(live)), n)
    entry = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(heads[rarest].astype(np.int64), n)
    anchor = block.postings[entry].astype(np.int64)
    document = block.document(anchor)
    start = anchor - by_rarity[which, 0]
    if slop:
        shifts = np.arange(-slop, slop + 1)
        start = (start[:, None] + shifts).ravel()
        which, document = np.repeat(which, len(shifts)), np.repeat(document, len(shifts))
    # the first of a document's positions is GAP at least, so that starts stay above 0
    for rank in range(0 if slop else 1, by_rarity.shape[1]):
        if not len(which):
            break
        offset = by_rarity[which, rank]
        window = live[which]
        wanted = (at[queries.place[window, offset]] << 32) + start + offset
        hit = _members(keys, wanted) if slop == 0 else _nearest(keys, wanted, slop)
        hit |= offset >= queries.size[window]
        which, start, document = which[hit], start[hit], document[hit]
    window = live[which]
    if slop:  # a start is found from each place of the rarest term near it
        found = np.unique(np.stack([window, document, start]), axis=1)
        window, document, start = found
    return window, document, start


def _query_rounds(benchmark: DataFrame, item: str, text: str, width: int) -> Iterator[Windows]:
    """The test windows, in rounds of bounded size, read one at a time."""
    batch, size, any_ = [], 0, False
    for i, t in benchmark.select(quoted(item), quoted(text).cast("string")).toLocalIterator():
        batch.append((i, t))
        size += 128 * len(t or "")
        if size > MAX_QUERY_BYTES:
            yield Windows(batch, width)
            batch, size, any_ = [], 0, True
    if batch or not any_:
        yield Windows(batch, width)


def search(index: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = 10, slop: int = 0) -> DataFrame:
    """Matches of every test window: ``doc_id, item_id, first`` (number of the document's word it starts at), ``n_words``.

    With ``slop``, the window's terms may each stand that many words off their
    places, and a match is told for every start that fits; one that lies before
    the document begins is told as 0.
    """
    if slop and width + 2 * slop > GAP:
        raise ValueError(f"width + 2 * slop must not be above {GAP}")
    out = None
    for queries in _query_rounds(benchmark, item, text, width):
        shared = index.sparkSession.sparkContext.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    block, ids, nulls = Block.of_row(row)
                    found = sorted({
                        (d, w, max(0, s - int(block.firsts[d])))
                        for w, d, s in zip(*(x.tolist() for x in search_block(block, shared.value, slop)))
                    })
                    rows = [(None if nulls[d] else int(ids[d]), shared.value.ids[i], s, int(shared.value.size[w])) for d, w, s in found for i in shared.value.items[w]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([None if r[k] is None else (str(r[k]) if k == 1 else r[k]) for r in rows], t) for k, t in enumerate((pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                        names=["doc_id", "item_id", "first", "n_words"],
                    )

        found = map_arrow(index, run, "doc_id long, item_id string, first long, n_words long")
        out = found if out is None else out.unionByName(found)
    return out


def _hit_words(block: Block, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Number of hit words of each document."""
    span = int(block.lasts[-1]) + 1 if len(block.lasts) else 1
    change = np.bincount(start, minlength=span + 1) - np.bincount(start + size, minlength=span + 1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
    return covered[block.lasts] - covered[block.firsts]


def contamination(index: DataFrame, benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = 10) -> DataFrame:
    """Per document of the index: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    A word inside any occurrence of a window is hit. Items with equal ids are
    one item; an item whose id is null counts as one with an empty id. A null
    or empty text has no words and no hits; an item without words has no
    window; an empty benchmark leaves every document clean. Repeated documents
    are judged each. ``index`` is read once per round; give it written.
    """
    rounds = _query_rounds(benchmark, item, text, width)
    first, second = next(rounds), next(rounds, None)
    if second is not None:
        return _many_rounds(index, itertools.chain([first, second], rounds))
    shared = index.sparkSession.sparkContext.broadcast(first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, ids, nulls = Block.of_row(row)
                window, document, start = search_block(block, shared.value)
                n_hit = _hit_words(block, start, shared.value.size[window])
                names = shared.value.names(document, window, len(ids))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64(), mask=nulls),
                        pa.array(block.lasts.astype(np.int64) - block.firsts, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array([len(x) for x in names], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()),
                        pa.array(n_hit > 0, pa.bool_()),
                    ],
                    names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    return map_arrow(index, run, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def _many_rounds(index: DataFrame, rounds: Iterator[Windows]) -> DataFrame:
    """As ``contamination`` for a benchmark too large for one broadcast: each round's hits are written, then joined per document.

    Only hits are shuffled with the documents' names, and one round's windows are held at a time.
    """
    numbered = materialize(index.withColumn("block", F.monotonically_increasing_id()), "index")
    parts = None
    for queries in rounds:
        shared = index.sparkSession.sparkContext.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    block, ids, _ = Block.of_row(row)
                    window, document, start = search_block(block, shared.value)
                    names = shared.value.names(document, window, len(ids))
                    lo = start - block.firsts[document]
                    spans = {d: [] for d in np.unique(document).tolist()}
                    for d, a, n in zip(document.tolist(), lo.tolist(), shared.value.size[window].tolist()):
                        spans[d].append([a, a + n])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["block"]] * len(spans), pa.int64()), pa.array(list(spans), pa.int32()),
                            pa.array(list(spans.values()), pa.list_(pa.list_(pa.int64()))), pa.array([names[d] for d in spans], pa.list_(pa.string())),
                        ],
                        names=["block", "place", "hits", "items"],
                    )

        found = materialize(map_arrow(numbered, run, "block long, place int, hits array<array<long>>, items array<string>"), "hits")
        shared.unpersist()
        parts = found if parts is None else parts.unionByName(found)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, ids, nulls = Block.of_row(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(ids), pa.int64()), pa.array(np.arange(len(ids)), pa.int32()), pa.array(ids, pa.int64(), mask=nulls), pa.array(block.lasts.astype(np.int64) - block.firsts)],
                    names=["block", "place", "doc_id", "n_words"],
                )

    documents = map_arrow(numbered, listed, "block long, place int, doc_id long, n_words long")
    joined = parts.groupBy("block", "place").agg(
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")
    )
    covered = F.aggregate(
        "hits",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, h: F.struct(
            F.greatest(acc["end"], h[1]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), h[1] - F.greatest(acc["end"], h[0]))).alias("n"),
        ),
    )["n"]
    none = F.array().cast("array<string>")
    counted = joined.select("block", "place", covered.alias("n_hit"), "items")
    return documents.join(counted, ["block", "place"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds a window of the benchmark.

    Whole rows come back as they were. Each row is judged by its own text, be its
    id null or repeated, in the index of its block, which its task holds; nothing
    is shuffled or written. A benchmark of several rounds filters row by row, round after round.
    """
    out = docs
    for queries in _query_rounds(benchmark, "item_id", "text", width):
        shared = docs.sparkSession.sparkContext.broadcast(queries)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for part, data, at in slices(batches, text):
                _, document, _ = search_block(Block.of_texts(data, at), shared.value)
                clean = np.ones(part.num_rows, bool)
                clean[document] = False
                yield part.filter(pa.array(clean))

        out = map_arrow(out, run, docs.schema)
    return out
