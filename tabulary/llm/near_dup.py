"""Near duplicates by min-max hashing.

A set's signature keeps both the smallest and the largest value under each
permutation, so half as many permutations are evaluated as with minima alone.
Bands of six values (three permutations) name the buckets in which documents
meet; every link is confirmed on the full sets.

Only one document of those with the same set takes part. What happens to the
members of a bucket:

1. each member is compared with the bucket's pivot that it meets most often,
   then with the other pivots where that left it in another component;
2. buckets whose members still lie in several components are gathered by the
   commonest of them. There, each document that is astray from it is compared
   with all others, in blocks of ``BLOCK`` documents, so that no pair of a bucket
   goes unseen, however large the bucket is, and few are seen twice.

Step 1 is linear. Step 2 is linear in the members at home, but grows with the
square of those that are astray, so a large crowd is thinned first: a document
with fewer than 80 % of its shingles in any other of the crowd has no link
there. That leaves the square for what shares more than that and still is no
link, such as very many documents of one template at a similarity just below 0.8.

Pairs are made and judged inside a block, on the words themselves, not on
hashes; only confirmed links leave it.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACED, bit_map, discard, fresh, identified, map_arrow, materialize, mix64, numbered_words, partitions, quoted, slices, utf8, with_bit, words

#: A pair at 0.8 misses all bands with a chance of (1 - 0.8^6)^50 = 2.5e-7.
BANDS, PERMUTATIONS_PER_BAND = 50, 3
#: Documents compared in one task at once.
BLOCK, FAN = 256, 64


def shingle_sets(data: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after the other, and where each text's begin.

    A text of fewer words than ``width`` has its whole sequence as one shingle;
    a text without words has none.
    """
    hashes, _, first = words(data, at, SPACED)
    n = len(at) - 1
    count = np.diff(first)
    with np.errstate(over="ignore"):
        acc = mix64(hashes[: max(0, len(hashes) - width + 1)] + np.uint64(width))
        for j in range(1, width):
            acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(acc)])
    sets = []
    for d in range(n):
        if count[d] >= width:
            sets.append(np.unique(acc[first[d] : first[d + 1] - width + 1]))
        elif count[d]:
            with np.errstate(over="ignore"):
                one = np.array([count[d]], np.uint64)
                for h in hashes[first[d] : first[d + 1]]:
                    one = mix64(one * np.uint64(0xC2B2AE3D27D4EB4F) + h)
            sets.append(one)
        else:
            sets.append(np.zeros(0, np.uint64))
    size = np.array([len(s) for s in sets], np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.concatenate([[0], np.cumsum(size)])


def exact_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """The texts' shingles as sorted numbers; the same number stands for the same words."""
    data, at = utf8(pa.array(texts, pa.large_string()))
    word, first = numbered_words(data, at, SPACED)
    many = int(word.max()) + 1 if len(word) else 1
    number, total = word, many
    for j in range(1, width):  # runs of j words are numbered, then those of j + 1
        n = max(0, len(word) - j)
        distinct, number = np.unique(number[:n] * many + word[j : j + n], return_inverse=True)
        total = len(distinct)
    short: dict[tuple, int] = {}
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= width:
            out.append(np.unique(number[lo : hi - width + 1]))
        elif hi > lo:
            out.append(np.array([short.setdefault(tuple(word[lo:hi].tolist()), total + len(short))]))
        else:
            out.append(np.zeros(0, np.int64))
    return out


@functools.cache
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_24)
    return rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def min_max(sets: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """Minima and maxima under ``n`` permutations: a row of 2n numbers for each (not empty) set."""
    mask, odd = _permutations(n)
    values = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, 2 * n), np.uint32)
    work = np.empty_like(values)
    with np.errstate(over="ignore"):
        for k in range(n):
            np.bitwise_xor(values, mask[k], out=work)
            np.multiply(work, odd[k], out=work)
            out[:, 2 * k] = np.minimum.reduceat(work, bounds[:-1])
            out[:, 2 * k + 1] = np.maximum.reduceat(work, bounds[:-1])
    return out


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit bucket name for each set and band; bands do not share names."""
    rows = signature.reshape(len(signature), bands, -1).astype(np.uint64)
    with np.errstate(over="ignore"):
        key = np.broadcast_to(mix64(np.arange(1, bands + 1, dtype=np.uint64)), rows.shape[:2])
        for r in range(rows.shape[2]):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return key.view(np.int64)


def profiles(docs: DataFrame, width: int, bands: int = BANDS) -> DataFrame:
    """``doc_id, version, n_shingles``, a 128-bit digest of the set (``d1, d2``) and its ``bands``, from (doc_id, version, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            sets, bounds = shingle_sets(data, at, width)
            size = np.diff(bounds)
            some = np.flatnonzero(size)
            d1, d2 = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
            keys = np.zeros((len(some), bands), np.int64)
            if len(some):
                own = np.append(bounds[some], len(sets))
                with np.errstate(over="ignore"):
                    d1[some] = np.add.reduceat(mix64(sets ^ np.uint64(0x8EBC6AF09C88C6E3)), own[:-1])
                    d2[some] = np.add.reduceat(mix64(sets ^ np.uint64(0x589965CC75374CC3)), own[:-1])
                keys = band_keys(min_max(sets, own, bands * PERMUTATIONS_PER_BAND), bands)
            ends = np.cumsum(np.where(size > 0, bands, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0), part.column(1), pa.array(size, pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(keys.ravel())),
                ],
                names=["doc_id", "version", "n_shingles", "d1", "d2", "bands"],
            )

    return map_arrow(docs.select("doc_id", "version", "text"), run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, version long, n_shingles long, d1 long, d2 long, bands array<long>")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """For each left set, the sizes of its intersections with all right sets."""
    joined = np.concatenate(right) if right else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(right)), [len(r) for r in right])
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    for i, x in enumerate(left):
        lo, hi = np.searchsorted(joined, x, "left"), np.searchsorted(joined, x, "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum()))
        yield i, np.bincount(owner[at], minlength=len(right))


def compare(groups: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (``u > v``) among the texts of each group.

    ``groups``: grp, sub, doc, label, side (1 left, 2 right, 3 both), text. Left
    is compared with right wherever the labels differ. Rows of a group must
    come together; a group is small.
    """

    def judge(rows: list[tuple]) -> list[tuple[int, int]]:
        once = {(doc, side): (label, text) for doc, label, side, text in rows}
        own = exact_sets([t for _, t in once.values()], width)
        keys = list(once)
        label = [x for x, _ in once.values()]
        lefts = [i for i, k in enumerate(keys) if k[1] & 1]
        rights = [i for i, k in enumerate(keys) if k[1] & 2]
        sizes, docs, labels = (np.array(x) for x in ([len(own[j]) for j in rights], [keys[j][0] for j in rights], [label[j] for j in rights]))
        out = []
        for i, both in _overlaps([own[i] for i in lefts], [own[j] for j in rights]):
            u, n = keys[lefts[i]][0], len(own[lefts[i]])
            ok = (both > 0) & (100 * both >= percent * (n + sizes - both)) & (labels != label[lefts[i]])
            out += [(max(u, int(v)), min(u, int(v))) for v in docs[ok]]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows):
            links = sorted(set(judge(rows)))
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"])

        now, rows = None, []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for grp, sub, *rest in zip(*columns):
                if (grp, sub) != now and rows:
                    yield done(rows)
                    rows = []
                now = grp, sub
                rows.append(tuple(rest))
        if rows:
            yield done(rows)

    dealt = groups.repartition(partitions(groups), "grp", "sub").sortWithinPartitions("grp", "sub")
    return map_arrow(dealt.select("grp", "sub", "doc", "label", "side", "text"), run, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node that each node of ``links`` (u, v) can reach.

    Large-star and small-star steps in turn, until the links are stars. Each
    step is a minimum per node and a join, never a list of neighbours.
    """
    now = materialize(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
        before = state
        ways = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = ways.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        done, now = now, materialize(small, "links")
        discard(done)


def _thinned(crowd: DataFrame, heavy: DataFrame, used: DataFrame, width: int, percent: int) -> DataFrame:
    """``crowd`` (home, node, label) without those of the homes ``heavy`` that can have no link.

    If u and v are linked, then at least ``percent`` % of u's shingles are in v.
    So a document with fewer of its shingles in any other of its crowd is out.
    """
    packed = crowd.join(heavy, "home", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in slices(batches, "text"):
            sets, bounds = shingle_sets(data, at, width)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(sets.view(np.int64)))], names=["node", "shingles"])

    sets = map_arrow(used.join(packed.select("node").distinct(), "node", "left_semi").select("node", "text"), run, "node long, shingles array<long>")
    spread = packed.select("home", "node").join(sets, "node").select("home", "node", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    common = materialize(spread.groupBy("home", "shingle").agg(F.count("*").alias("m")).where("m > 1").drop("m"), "common")
    shared = spread.join(common, ["home", "shingle"]).groupBy("home", "node", "n").agg(F.count("*").alias("c"))
    kept = shared.where(F.col("c") * 100 >= F.col("n") * percent).select("home", "node")
    thin = materialize(crowd.join(heavy, "home", "left_anti").unionByName(packed.join(kept, ["home", "node"], "left_semi")), "crowd")
    discard(common)
    return thin


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, bands: int = BANDS, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id, kept``.

    Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; a
    document is the set of its ``width``-word shingles. Documents are linked if
    100 * |intersection| >= ``percent`` * |union|. ``component_id`` is the
    smallest id that links reach; ``kept`` says that it is the document's own.

    A null text or one without words has no shingles and no link. A row with a
    null id is linked with nothing, has a null component, and is kept. Rows are
    judged by their texts: repeated rows are in one component, and rows with the
    same id and other texts may be in several. Ids are numbers, or structs that
    sort. An empty table gives no rows. Other columns are ignored.
    """
    own = quoted(doc) if isinstance(docs.schema[doc].dataType, T.StructType) else quoted(doc).cast("long")
    texts = docs.select(own.alias("doc_id"), quoted(text).cast("string").alias("text")).withColumn("version", F.xxhash64("text"))
    known = materialize(profiles(texts, width, bands), "profiles")
    keyed = known.where("doc_id is not null and n_shingles > 0")
    # a class is the rows with the same set; its number is fixed once it is written
    classes = keyed.groupBy("d1", "d2", "n_shingles").agg(F.min(F.struct("doc_id", "version")).alias("own"), F.first("bands").alias("bands"))
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    spread = classes.select("node", "n_shingles", F.explode("bands").alias("key"))
    # aggregates are written before they are joined, so that both sides of a join are plain shuffles and Spark can split a key
    buckets = materialize(spread.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("pivot"), F.min_by("n_shingles", "node").alias("pivot_n")).where("m > 1"), "buckets")
    met = materialize(spread.join(buckets, "key"), "met")
    near = (F.col("n_shingles") * 100 >= F.col("pivot_n") * percent) & (F.col("pivot_n") * 100 >= F.col("n_shingles") * percent)
    stars = materialize(met.where((F.col("node") != F.col("pivot")) & near).groupBy("node", "pivot").agg(F.count("*").alias("times")), "stars")
    wanted = materialize(met.select("node").distinct().join(classes, "node").select("node", "own.*"), "wanted")
    place = F.xxhash64("doc_id", "version")
    chosen = with_bit(texts.where("doc_id is not null").withColumn("place", place), "place", bit_map(wanted.select(place)))
    used = chosen.join(wanted.hint("merge"), ["doc_id", "version"]).groupBy("node").agg(F.first("text").alias("text"))  # rows may repeat
    used = materialize(used, "texts")

    def with_text(rows: DataFrame) -> DataFrame:
        return rows.join(used.withColumnRenamed("node", "doc"), "doc")

    def fanned(pairs: DataFrame) -> DataFrame:
        """Links among (node, pivot, label, pivot_label), FAN members a block."""
        loads = materialize(pairs.groupBy("pivot", "pivot_label").agg(F.ceil(F.count("*") / F.lit(FAN)).cast("long").alias("subs")), "loads")
        members = pairs.join(loads.drop("pivot_label"), "pivot").select(F.col("pivot").alias("grp"), F.pmod(F.xxhash64("node"), F.col("subs")).alias("sub"), F.col("node").alias("doc"), F.col("label"), F.lit(2).alias("side"))
        heads = loads.select(F.col("pivot").alias("grp"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("sub"), F.col("pivot").alias("doc"), F.col("pivot_label").alias("label"), F.lit(1).alias("side"))
        return compare(with_text(members.unionByName(heads)), width, percent)

    def labelled(df: DataFrame, labels: DataFrame, column: str, out: str) -> DataFrame:
        got = labels.select(F.col("node").alias(column), F.col("label").alias(out))
        return df.join(got, column, "left").withColumn(out, F.coalesce(out, column))

    best = materialize(stars.groupBy("node").agg(F.max_by("pivot", F.struct("times", -F.col("pivot"))).alias("pivot")), "best")
    links = materialize(fanned(best.withColumn("label", F.col("node")).withColumn("pivot_label", F.col("pivot"))), "links")
    labels = materialize(components(links), "labels")
    open_ = labelled(labelled(stars.join(best, ["node", "pivot"], "left_anti"), labels, "node", "label"), labels, "pivot", "pivot_label").where("label <> pivot_label")
    links = materialize(links.unionByName(fanned(open_)), "links")
    labels = materialize(components(links), "labels")

    # buckets whose members still lie in several components; one of two members was settled by its pivot
    members = materialize(labelled(met.where("m > 2").select("key", "node"), labels, "node", "label"), "members")
    counted = members.groupBy("key", "label").agg(F.count("*").alias("n"))
    homes = counted.groupBy("key").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("home"), F.count("*").alias("labels"))
    homes = materialize(homes.where("labels > 1").select("key", "home"), "homes")
    # a bucket is at home in its commonest component; documents that meet there in many buckets are compared once
    crowd = materialize(members.join(homes, "key").select("home", "node", "label").distinct(), "crowd")

    def blocks_of(crowd: DataFrame) -> DataFrame:
        strays = F.count(F.when(F.col("label") != F.col("home"), 1))
        return materialize(crowd.groupBy("home").agg(F.ceil(strays / F.lit(BLOCK)).alias("lefts"), F.ceil(F.count("*") / F.lit(BLOCK)).alias("rights")), "sizes")

    sizes = blocks_of(crowd)
    heavy = sizes.where("lefts > 1").select("home")
    if heavy.take(1):
        crowd = _thinned(crowd, heavy, used, width, percent)
        sizes = blocks_of(crowd)
    placed = crowd.join(sizes, "home")
    hashed = F.xxhash64("node")

    def blocks(rows: DataFrame, own: str, other: str, side: int) -> DataFrame:
        """Every row next to each block of the other side."""
        block = F.pmod(hashed, F.col(own))
        met_with = rows.select("home", "node", "label", block.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias("other"))
        left, right = ("own", "other") if side == 1 else ("other", "own")
        return met_with.select(F.col("home").alias("grp"), (F.col(left) * (1 << 31) + F.col(right)).alias("sub"), F.col("node").alias("doc"), "label", F.lit(side).alias("side"))

    # of two documents in different components, one at least is astray from home
    placed = placed.where("lefts > 0")
    placed = blocks(placed.where("label <> home"), "lefts", "rights", 1).unionByName(blocks(placed, "rights", "lefts", 2))
    final = components(links.unionByName(compare(with_text(placed), width, percent)))

    # labels go to the classes first: the only joins by a key that many rows share are plain ones, which Spark can split
    named = materialize(labelled(classes.select("d1", "d2", "n_shingles", "node", F.col("own.doc_id").alias("first")), final, "node", "label"), "named")
    least = materialize(named.groupBy("label").agg(F.min("first").alias("component_id")), "least")
    for done in (buckets, met, stars, wanted, used, best, links, labels, members, homes, crowd, sizes):
        discard(done)
    named = named.join(least, "label").select("d1", "d2", "n_shingles", "component_id")
    rows = known.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id, of those the first in the files.

    Every row counts for itself, whether its id is null or repeats. Whole rows
    come back as they were; rows without words stay (``options`` as above).
    """
    rows, key = identified(docs, doc)
    judged = near_duplicates(rows, doc=key, text=text, **options)
    (gone,) = fresh(rows, "_gone")
    return rows.join(judged.where("not kept").select(F.col("doc_id").alias(gone)), quoted(key) == quoted(gone), "left_anti").drop(key)
