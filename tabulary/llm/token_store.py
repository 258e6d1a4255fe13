"""Token-id shards with a minimal perfect hash index.

Files of a store, all little-endian:

``shard-N.ids``    ids of the shard's records, one after the other, with no
                   separators, as unsigned integers of 2 bytes (vocabularies of
                   up to 65,536 ids) or 4.
``shard-N.dir``    the records in order: n, then n keys (int64), n flags (null
                   key), and n + 1 offsets (int64, in ids from the shard's start).
``index-N.mph``    minimal perfect hash of a part of the keys: for each key's
                   slot a fingerprint, its shard, and its record there.

Shards follow each other in ascending key order. A key is found in constant
time: its hash names the index part, the part's bit arrays give its slot, the
slot's fingerprint tells foreign keys, and the slot names the record.

Files are written under a name of the task's own and then renamed, so a task
that runs twice, or whose executor is lost, leaves one whole file.
"""

from __future__ import annotations

import functools
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import byte_class, map_arrow, mix64, partitions, ramp, shared_dir, slices, span_hashes

#: Text encoded at once; larger than elsewhere, as a word is encoded once per slice at most.
ENCODE_BYTES = 2 << 20
#: Distinct words, and bytes of them, that a worker keeps the ids of.
KEPT_WORDS, KEPT_BYTES = 1_500_000, 64 << 20
#: Keys per index part, about.
PART_KEYS = 1 << 20


# --- encoding ----------------------------------------------------------------

_GRAPH = byte_class((0x21, 0x7E))
_LETTER = byte_class((0x41, 0x5A), (0x61, 0x7A))
_STOP = byte_class((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))


def safe_cuts(data: np.ndarray, at: np.ndarray, added: tuple[bytes, ...] = ()) -> np.ndarray:
    """Places where a byte-level BPE with the usual word pattern never has a token across.

    These are the texts' starts; a lone space between visible characters
    (ASCII, or two bytes from 0xC3 on: Latin-1 letters); both sides of such a
    lone line feed; and the place between such a letter and ASCII punctuation.
    None lies inside one of the strings ``added``, which are tokens as they are.
    """
    n = len(data)
    latin = np.zeros(n, bool)  # last byte of a two-byte character
    latin[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80)
    sign = latin & ((data == 0x97) | (data == 0xB7))  # multiplication and division
    visible_end = _GRAPH[data] | latin
    visible_start = _GRAPH[data] | (data == 0xC3)
    cut = np.zeros(n, bool)
    if n > 2:
        between = visible_end[:-2] & visible_start[2:]
        cut[1:-1] = between & ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A))
        cut[2:] |= between & (data[1:-1] == 0x0A)
        cut[1:] |= (_LETTER[data[:-1]] | (latin[:-1] & ~sign[:-1])) & _STOP[data[1:]]
    raw = data.tobytes() if added else b""
    for token in added:
        place = raw.find(token)
        while place >= 0:
            cut[place + 1 : place + len(token)] = False
            place = raw.find(token, place + 1)
    # neighbours of another text do not count
    starts = at[:-1][np.diff(at) > 0]
    for shift, kind in ((0, None), (1, 0x0A), (-1, None)):
        near = starts + shift
        near = near[(near >= 0) & (near < n)]
        cut[near] = False
    cut[starts] = True
    return np.flatnonzero(cut)


@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _cuts_words(path: str) -> bool:
    """Whether the file is a byte-level BPE with the usual word pattern and no normaliser, which :func:`safe_cuts` knows."""
    rules = json.loads(_tokenizer(path).to_str())
    cut = rules.get("pre_tokenizer") or {}
    plain = cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space")
    # a token that takes in the white space around it, or wants a word's edge, looks past its own string
    wide = any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in rules.get("added_tokens") or [])
    return bool(plain and not wide and rules.get("normalizer") is None and (rules.get("model") or {}).get("type") == "BPE")


class _Pool:
    """A growing array."""

    def __init__(self, kind: type):
        self.data, self.used = np.zeros(1 << 16, kind), 0

    def add(self, more: np.ndarray) -> int:
        """Append; returns where."""
        at, self.used = self.used, self.used + len(more)
        if self.used > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(self.data), len(more)), self.data.dtype)])
        self.data[at : self.used] = more
        return at


class WordCache:
    """Ids of the words met so far. Words are found by their hashes, and their bytes are compared before ids are used again."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.added = tuple(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())
        self.cuts_words = _cuts_words(path)
        self.clear()

    def clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.words = np.zeros((4, 0), np.int64)  # of each: first id, number of ids, first byte, number of bytes
        self.ids, self.raw = _Pool(np.uint32), _Pool(np.uint8)

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the texts' ids begin in the pool, and how many they are."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
        count = np.fromiter(map(len, ids), np.int64, len(ids))
        at = self.ids.add(np.fromiter((i for x in ids for i in x), np.uint32, int(count.sum())))
        return at + np.cumsum(count) - count, count

    def _learn(self, hashes: np.ndarray, texts: list[bytes]) -> None:
        first, count = self._encode(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        at = self.raw.add(np.frombuffer(b"".join(texts), np.uint8))
        joined = np.concatenate([self.hashes, hashes])
        order = np.argsort(joined, kind="stable")
        self.hashes = joined[order]
        self.words = np.concatenate([self.words, [first, count, at + np.cumsum(size) - size, size]], axis=1)[:, order]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and the number of ids of each text."""
        cuts = safe_cuts(data, at, self.added) if self.cuts_words else at[:-1][np.diff(at) > 0]
        if not len(cuts):
            return np.zeros(0, np.uint32), np.zeros(len(at) - 1, np.int64)
        ends = np.append(cuts[1:], len(data))
        hashes = span_hashes(data, cuts, ends)
        distinct, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.hashes) > KEPT_WORDS or self.raw.used > KEPT_BYTES:
            self.clear()
        guess = np.minimum(np.searchsorted(self.hashes, distinct), max(0, len(self.hashes) - 1))
        new = np.flatnonzero(self.hashes[guess] != distinct) if len(self.hashes) else np.arange(len(distinct))
        if len(new):
            self._learn(distinct[new], [data[cuts[i] : ends[i]].tobytes() for i in sample[new]])
        first, count, spell, size = self.words[:, np.searchsorted(self.hashes, distinct)][:, place]
        odd = self._unlike(data, cuts, ends - cuts, spell, size)
        if len(odd):  # another word has the hash
            first[odd], count[odd] = self._encode([data[cuts[i] : ends[i]].tobytes() for i in odd])
        ids = self.ids.data[ramp(first, count)]
        sums = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(cuts, at)]
        return ids, np.diff(sums)

    def _unlike(self, data: np.ndarray, cuts: np.ndarray, length: np.ndarray, spell: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The words whose bytes are not those kept for their hash."""
        unlike = length != size
        like = np.flatnonzero(~unlike)
        differ = self.raw.data[ramp(spell[like], size[like])] != data[ramp(cuts[like], size[like])]
        if differ.any():
            unlike[like[np.searchsorted(np.cumsum(size[like]), np.flatnonzero(differ), "right")]] = True
        return np.flatnonzero(unlike)


@functools.lru_cache(2)
def _cache(path: str) -> WordCache:
    return WordCache(path)


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The texts' ids with ``end_id`` after each text."""
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    upto = np.cumsum(counts + 1)
    body = np.ones(len(out), bool)
    body[upto - 1] = False
    out[body] = ids
    return out


# --- files -------------------------------------------------------------------


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


class _Writer:
    """A file that appears under its name only when it is whole."""

    def __init__(self, path: str):
        self.fs, self.path = _open(path)
        self.own = f"{self.path}.{uuid.uuid4().hex}"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.stream = self.fs.open_output_stream(self.own)

    def write(self, array: np.ndarray) -> None:
        self.stream.write(np.ascontiguousarray(array).data)

    def close(self) -> None:
        self.stream.close()
        try:
            self.fs.move(self.own, self.path)
        except OSError:  # some file systems do not replace; another run of this task wrote the same file
            if self.fs.get_file_info(self.path).type == fs.FileType.NotFound:
                raise
            self.fs.delete_file(self.own)


def _read(path: str, start: int = 0, size: int | None = None) -> bytes:
    where, name = _open(path)
    with where.open_input_file(name) as f:
        return f.read_at(f.size() - start if size is None else size, start)


# --- minimal perfect hash ----------------------------------------------------


def key_hash(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _spot(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(hashes + np.uint64(level + 1) * np.uint64(0xD1B54A32D192ED03)) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """Levels of bit arrays: a key's slot is the rank of the first set bit it hits.

    On each level, keys that share a spot with no other key get its bit; the
    others go on to the next level, where few are left.
    """

    n: int
    sizes: list[int]
    bits: list[np.ndarray]  # 64 a number
    ranks: list[np.ndarray]  # set bits before each number, and in all
    base: list[int]

    @staticmethod
    def build(hashes: np.ndarray, load: float = 2.0) -> PerfectHash:
        """``hashes``: of distinct keys (equal hashes can't be told apart and raise)."""
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("keys of an index must be distinct")
        out, left = PerfectHash(len(hashes), [], [], [], []), hashes
        while len(left):
            size = max(64, int(load * len(left)))
            spot = _spot(left, len(out.sizes), size)
            count = np.bincount(spot, minlength=size)
            out._level(size, np.packbits(count == 1, bitorder="little"))
            left = left[count[spot] > 1]
        return out

    def _level(self, size: int, packed: np.ndarray) -> None:
        bits = np.concatenate([packed, np.zeros(-len(packed) % 8, np.uint8)]).view("<u8")
        self.base.append(self.base[-1] + int(self.ranks[-1][-1]) if self.ranks else 0)
        self.sizes.append(size)
        self.bits.append(bits)
        self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)]))

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 for some that were not in the set (others get a slot that is not theirs)."""
        out = np.full(len(hashes), -1, np.int64)
        open_ = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            spot = _spot(hashes[open_], level, size)
            bits, bit = self.bits[level][spot >> 6], np.uint64(1) << (spot & 63).astype(np.uint64)
            hit = bits & bit != 0
            before = np.bitwise_count(bits & (bit - np.uint64(1)))
            out[open_[hit]] = (self.base[level] + self.ranks[level][spot >> 6] + before)[hit]
            open_ = open_[~hit]
        return out

    def write(self, to: _Writer) -> None:
        to.write(np.array([self.n, len(self.sizes), *self.sizes], np.int64))
        for bits in self.bits:
            to.write(bits)

    @staticmethod
    def read(raw: bytes) -> tuple[PerfectHash, int]:
        n, levels = np.frombuffer(raw, np.int64, 2)
        sizes = np.frombuffer(raw, np.int64, levels, 16).tolist()
        out, at = PerfectHash(int(n), [], [], [], []), 16 + 8 * int(levels)
        for size in sizes:
            wide = (size + 63) // 64 * 8
            out._level(size, np.frombuffer(raw, np.uint8, wide, at))
            at += wide
        return out, at


# --- the store ---------------------------------------------------------------


@dataclass
class TokenStore:
    """Where the files are; ``starts`` has the ids before each shard, ``lasts`` its last key (None: null)."""

    path: str
    width: int
    shards: list[int]
    starts: list[int]
    lasts: list[int | None]
    parts: int

    @property
    def kind(self) -> type:
        return np.uint16 if self.width == 2 else np.uint32


def _shard_frame(spark, store: TokenStore) -> DataFrame:
    """A task per shard; ids are places in ``store.shards``."""
    n = len(store.shards)
    return spark.range(0, n, 1, max(1, n))


def read_dir(store_path: str, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = _read(f"{store_path}/shard-{shard:06d}.dir")
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    return np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, bool, n, 8 + 8 * n), np.frombuffer(raw, np.int64, n + 1, 8 + 9 * n)


def write(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    doc: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    vocabulary: int = 1 << 16,
) -> TokenStore:
    """Encode every whole text, ``end_id`` behind each, in ascending key order.

    ``tokenizer`` is the path of a byte-level BPE file of the tokenizers
    library, on every machine. A null text is empty, so its record is the end
    id alone. Null keys come first. Rows with equal keys are records of their
    own, side by side in the order of their texts, in one shard or several; an
    empty table makes an empty store. The index maps a key to its first record.
    The driver learns the size and the last key of each shard. Files whose words
    are not those of a plain byte-level BPE are applied to whole texts.
    """
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tokens"
    width = 2 if vocabulary <= 1 << 16 else 4
    rows = docs.select(F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # the texts' beginnings, so that a key that very many rows have is cut as well
    ordered = rows.repartitionByRange(partitions(docs), "doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        out, cache = None, _cache(tokenizer)
        keys, nulls, counts = [], [], []
        for part, data, at in slices(batches, "text", ENCODE_BYTES):
            out = out or _Writer(f"{path}/shard-{shard:06d}.ids")
            ids, n = cache.encode(data, at)
            out.write(with_end(ids, n, end_id).astype(np.uint16 if width == 2 else np.uint32))
            keys.append(np.asarray(part.column(0).fill_null(0), np.int64))
            nulls.append(np.asarray(part.column(0).is_null(), bool))
            counts.append(n + 1)
        if out:
            out.close()
            keys, nulls, counts = np.concatenate(keys), np.concatenate(nulls), np.concatenate(counts)
            folder = _Writer(f"{path}/shard-{shard:06d}.dir")
            for x in (np.array([len(keys)], np.int64), keys, nulls, np.concatenate([[0], np.cumsum(counts)])):
                folder.write(x)
            folder.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([shard], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "ids": pa.array([int(counts.sum())], pa.int64()), "last": pa.array([None if nulls[-1] else int(keys[-1])], pa.int64())})

    sizes = sorted(map(tuple, map_arrow(ordered, run, "shard int, n long, ids long, last long").collect()), key=lambda s: s[0])
    starts = np.concatenate([[0], np.cumsum([s[2] for s in sizes])])[:-1] if sizes else []
    store = TokenStore(path, width, [s[0] for s in sizes], [int(x) for x in starts], [s[3] for s in sizes], max(1, -(-sum(s[1] for s in sizes) // PART_KEYS), min(partitions(docs), sum(s[1] for s in sizes) // 1000)))
    _write_index(spark, store)
    return store


def _key_part(store: TokenStore):
    return F.pmod(F.xxhash64("doc_id"), F.lit(store.parts)).cast("int")


_ENTRY = np.dtype([("print", np.uint32), ("shard", np.int32), ("record", np.int64)])


def _fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (mix64(hashes ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)).astype(np.uint32)


def _write_index(spark, store: TokenStore) -> None:
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                shard = store.shards[i]
                keys, nulls, _ = read_dir(store.path, shard)
                first = np.append(True, keys[1:] != keys[:-1])[: len(keys)] & ~nulls
                keyed = np.flatnonzero(~nulls)[:1]
                first[keyed] = True
                if i and len(keyed) and keys[keyed[0]] == store.lasts[i - 1]:
                    first[keyed] = False  # goes on from the shard before
                at = np.flatnonzero(first)
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(keys[at]), "shard": pa.array(np.full(len(at), shard, np.int32)), "record": pa.array(at.astype(np.int64))})

    rows = map_arrow(_shard_frame(spark, store), entries, "doc_id long, shard int, record long")
    keyed = rows.withColumn("part", _key_part(store))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: dict[int, list[tuple]] = {}
        for batch in batches:
            key, shard, record, part = (np.asarray(c) for c in batch.columns)
            for p in np.unique(part):
                got.setdefault(int(p), []).append((key[part == p], shard[part == p], record[part == p]))
        for p, pieces in got.items():
            key, shard, record = (np.concatenate(x) for x in zip(*pieces))
            hashes = key_hash(key)
            mph = PerfectHash.build(hashes)
            table = np.zeros(len(key), _ENTRY)
            slot = mph.slots(hashes)
            table["print"][slot], table["shard"][slot], table["record"][slot] = _fingerprint(hashes), shard, record
            out = _Writer(f"{store.path}/index-{p:06d}.mph")
            mph.write(out)
            out.write(table.view(np.uint8))
            out.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "n": pa.array([len(key)], pa.int64())})

    map_arrow(keyed.repartition(store.parts, "part"), build, "part int, n long").agg(F.sum("n")).collect()


def locate(keys: DataFrame, store: TokenStore, key: str = "doc_id") -> DataFrame:
    """``doc_id, shard, record`` of the keys that the store has, by its index alone."""
    asked = keys.select(F.col(key).cast("long").alias("doc_id")).where("doc_id is not null").withColumn("part", _key_part(store))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded: dict[int, tuple[PerfectHash, np.ndarray] | None] = {}
        for batch in batches:
            key, part = (np.asarray(c) for c in batch.columns)
            for p in np.unique(part):
                if p not in loaded:
                    where, name = _open(f"{store.path}/index-{p:06d}.mph")
                    if where.get_file_info(name).type == fs.FileType.NotFound:
                        loaded[p] = None
                    else:
                        raw = _read(f"{store.path}/index-{p:06d}.mph")
                        mph, at = PerfectHash.read(raw)
                        loaded[p] = mph, np.frombuffer(raw, _ENTRY, mph.n, at)
                if loaded[p] is None:
                    continue
                mph, table = loaded[p]
                own = key[part == p]
                hashes = key_hash(own)
                slot = mph.slots(hashes)
                ok = slot >= 0
                ok[ok] = table["print"][slot[ok]] == _fingerprint(hashes[ok])
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(own[ok]), "shard": pa.array(table["shard"][slot[ok]]), "record": pa.array(table["record"][slot[ok]])})

    return map_arrow(asked.repartition(store.parts, "part"), run, "doc_id long, shard int, record long")


def fetch(found: DataFrame, store: TokenStore) -> DataFrame:
    """The records that ``locate`` found: ``doc_id, start, n_tokens, ids_crc32``, read from the shards.

    A key with several records gives them all. ``start`` counts the ids of all
    records before this one in the store.
    """
    number = {shard: i for i, shard in enumerate(store.shards)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = _Open(store)
        for batch in batches:
            asked, shards, records = (np.asarray(c) for c in batch.columns)
            rows: list[tuple] = []
            for i in np.lexsort((records, shards)):
                key, shard, record = int(asked[i]), number[int(shards[i])], int(records[i])
                while shard < len(store.shards):
                    keys, nulls, _ = open_.folder(shard)
                    upto = record
                    while upto < len(keys) and keys[upto] == key and not nulls[upto]:
                        upto += 1
                    rows += open_.records(shard, key, range(record, upto))
                    if upto < len(keys):
                        break
                    shard, record = shard + 1, 0
                if len(rows) >= _ROWS_AT_ONCE:
                    yield _record_batch(rows)
                    rows = []
            yield _record_batch(rows)
        open_.close()

    return map_arrow(found.repartition(max(1, len(store.shards)), "shard"), run, _RECORD)


_RECORD = "doc_id long, start long, n_tokens long, ids_crc32 long"
_ROWS_AT_ONCE = 10_000


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])


class _Open:
    """The shard that is being read."""

    def __init__(self, store: TokenStore):
        self.store, self.shard, self.file = store, None, None

    def folder(self, shard: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if shard != self.shard:
            self.close()
            number = self.store.shards[shard]
            where, name = _open(f"{self.store.path}/shard-{number:06d}.ids")
            self.dir, self.file, self.shard = read_dir(self.store.path, number), where.open_input_file(name), shard
        return self.dir

    def records(self, shard: int, key: int | None, which: Iterable[int]) -> list[tuple]:
        offsets = self.folder(shard)[2]
        rows = []
        for r in which:
            lo, hi = int(offsets[r]), int(offsets[r + 1])
            ids = np.frombuffer(self.file.read_at((hi - lo) * self.store.width, lo * self.store.width), self.store.kind)
            rows.append((key, self.store.starts[shard] + lo, hi - lo, zlib.crc32(ids.astype("<u4").data)))
        return rows

    def close(self) -> None:
        if self.file:
            self.file.close()
        self.file = self.shard = None


def unkeyed(spark, store: TokenStore) -> DataFrame:
    """The records with a null key, which no index can hold, as ``fetch`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = _Open(store)
        for batch in batches:
            for i in batch.column(0).to_pylist():
                null = np.flatnonzero(open_.folder(i)[1]).tolist()
                for k in range(0, len(null), _ROWS_AT_ONCE):
                    yield _record_batch(open_.records(i, None, null[k : k + _ROWS_AT_ONCE]))
        open_.close()

    return map_arrow(_shard_frame(spark, store), run, _RECORD)
