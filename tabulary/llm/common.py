"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship

#: Text handled at once in a Python worker; a longer document is a slice of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder that the driver and every executor can reach.

    It lies in ``spark.checkpoint.dir``. Only where the session has no such
    setting and runs in one JVM (tests) is a temporary folder of this machine
    used; a cluster without the setting is refused.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tabulary-")
        spark.conf.set("spark.checkpoint.dir", base)
    where = spark._jvm.org.apache.hadoop.fs.Path(base)
    # a path without a scheme is one of Spark's default file system, which Python would take for a local one
    full = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString()
    full = re.sub(r"^file:/+", "file:///", full)
    return f"{full.rstrip('/')}/tabulary-{uuid.uuid4().hex}"


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow``, with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared folder and read it back."""
    path = f"{shared_dir(df.sparkSession)}/{label}"
    # zstd: snappy's writer leaves native buffers behind in every task until the JVM collects garbage
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._tabulary_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``df`` (or ``running_total``), once nothing reads it any more."""
    path = getattr(df, "_tabulary_path", None)
    if path:
        jvm = df.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def running_total(df: DataFrame, order: list[str], value: str, out: str = "total") -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to this one in ``order``.

    The rows are range-sorted into partitions, whose sums (one number a
    partition, the only thing the driver sees) give each its offset. No key or
    value gathers in a single task. ``order`` must tell all rows apart.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(df), *order).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    offsets, total = [], 0
    for part, s in sorted(ranged.groupBy("_part").agg(F.sum(value)).collect()):
        offsets.append((part, total))
        total += s or 0
    base = spark.createDataFrame(offsets, "_part int, _base long")
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.join(F.broadcast(base), "_part").withColumn(out, F.col("_base") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_part", "_base")
    summed._tabulary_path = ranged._tabulary_path
    return summed


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them, in whatever case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def quoted(name: str):
    """The column of exactly this name."""
    return F.col("`" + name.replace("`", "``") + "`")


def identified(docs: DataFrame, doc: str) -> tuple[DataFrame, str]:
    """``docs`` with a column that tells all rows apart, and its name.

    It sorts by ``doc`` (null last), then by the row's place in its file, which
    is the same whenever and wherever the file is read. What does not come from
    files is written first.
    """
    (name,) = fresh(docs, "_row")
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        docs = materialize(docs, "rows")
    place = [F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    key = F.struct(quoted(doc).isNull().alias("none"), F.coalesce(quoted(doc).cast("long"), F.lit(0)).alias("id"), *place)
    return docs.select("*", key.alias(name)), name


#: Bits of the maps that all executors get (8 MB). A full map lets more rows through
#: to an exact comparison, and changes no result.
MAP_BITS = 1 << 26


def bit_map(values: DataFrame) -> np.ndarray:
    """Bits of the numbers in a DataFrame's only column."""
    bit = F.pmod(F.col(values.columns[0]), F.lit(MAP_BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))
    got = values.groupBy(F.floor(bit / 64).cast("int").alias("cell")).agg(F.bit_or(one).alias("bits")).toArrow()  # at most MAP_BITS / 64 rows
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[got["cell"].to_numpy()] = got["bits"].to_numpy()
    return out


def in_map(seen: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whether the bit map has each number."""
    spot = values % MAP_BITS
    return (seen[spot >> 6].view(np.uint64) >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1


def with_bit(rows: DataFrame, key: str, seen: np.ndarray) -> DataFrame:
    """The rows whose number ``key`` has its bit in the map: those that a join wants, and a few more, without a shuffle."""
    shared = rows.sparkSession.sparkContext.broadcast(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_map(shared.value, np.asarray(batch.column(batch.schema.get_field_index(key))))))

    return map_arrow(rows, run, rows.schema)


def is_member(remainder_of: str, modulus: int, remainder: int):
    """Column: crc32 of the id's text leaves ``remainder`` (false for a null id)."""
    return F.coalesce(F.crc32(F.col(remainder_of).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


# --- texts in Arrow batches -------------------------------------------------


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or column.null_count:
        column = column.fill_null("").cast(pa.large_string())
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``limit`` bytes of text: the rows, their bytes, their offsets."""
    for batch in batches:
        data, at = utf8(batch.column(batch.schema.get_field_index(text)))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
            yield batch.slice(lo, hi - lo), data[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
            lo = hi


def byte_class(*spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for lo, hi in spans:
        out[lo : hi + 1] = True
    return out


#: Bytes of the words ``[^\x20\x09-\x0D]+``; in UTF-8 the byte class is the character class.
SPACED = ~byte_class((0x20, 0x20), (0x09, 0x0D))
#: Bytes of the words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case.
ALNUM = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULT = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Masks for the first k bytes of eight.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer spans are hashed one at a time.
_LONG = 256


def chain(acc: np.ndarray, more: np.ndarray) -> np.ndarray:
    """A hash of the sequence that ``acc`` stands for with ``more`` behind it."""
    with np.errstate(over="ignore"):
        return mix64((acc * _MULT) ^ more)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hashes of the byte spans, with A-Z as a-z if ``lower``.

    Eight bytes at a time go through a bijection of 64 bits, so spans of up to
    eight bytes and of the same length never collide, and no sum over letters
    lets patterns cancel out. Long spans take BLAKE2.
    """
    if lower:
        data = _LOWER[data]
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each byte on
    size = ends - starts
    with np.errstate(over="ignore"):
        out = chain(mix64(size.astype(np.uint64) + _MULT), eight[starts] & _FIRST[np.minimum(size, 8)])
    open_, done = np.flatnonzero((size > 8) & (size <= _LONG)), 8
    while len(open_):
        left = size[open_] - done
        out[open_] = chain(out[open_], eight[starts[open_] + done] & _FIRST[np.minimum(left, 8)])
        open_, done = open_[left > 8], done + 8
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].data, digest_size=8).digest(), "little")
    return out


def ramp(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ..`` (``count[i]`` numbers) of every i, one after the other."""
    upto = np.cumsum(count)
    full = np.flatnonzero(count)
    if not len(full):
        return np.zeros(0, np.int64)
    step = np.ones(int(upto[-1]), np.int64)
    heads = (upto - count)[full]
    step[heads[0]] = first[full[0]]
    step[heads[1:]] = first[full[1:]] - first[full[:-1]] - count[full[:-1]] + 1
    return np.cumsum(step)


def numbered_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """A number for each span, the same for two spans if and only if their bytes are the same."""
    _, sample, place = np.unique(hashes, return_index=True, return_inverse=True)
    size, twin = ends - starts, sample[place]
    if (size == size[twin]).all() and np.array_equal(data[ramp(starts, size)], data[ramp(starts[twin], size)]):
        return place
    known: dict[bytes, int] = {}  # a collision
    return np.array([known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(starts, ends)], np.int64)


def word_spans(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of the texts in a slice begin and end, in bytes."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    edge = np.empty(len(data) + 1, bool)
    edge[0], edge[-1] = inside[0], inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    starts, ends = np.flatnonzero(edge[:-1] & inside), np.flatnonzero(edge[1:] & inside) + 1
    cuts = np.unique(at[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]  # two texts' words that touch
    if len(cuts):
        starts, ends = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([ends, cuts]))
    return starts, ends


def words(data: np.ndarray, at: np.ndarray, kind: np.ndarray, lower: bool = True, hashed: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of the texts in a slice: their hashes, starts (in bytes), and each text's first word.

    The last array has one entry more than texts: text i has the words from
    entry i up to entry i + 1. Without ``hashed``, all hashes are 0.
    """
    starts, ends = word_spans(data, at, kind)
    hashes = span_hashes(data, starts, ends, lower) if hashed else np.zeros(len(starts), np.uint64)
    return hashes, starts, np.searchsorted(starts, at, "left")


def numbered_words(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``words``, but with numbers that only the same word (A-Z as a-z) shares, in this slice."""
    starts, ends = word_spans(data, at, kind)
    data = _LOWER[data]
    return numbered_spans(data, starts, ends, span_hashes(data, starts, ends)), np.searchsorted(starts, at, "left")
