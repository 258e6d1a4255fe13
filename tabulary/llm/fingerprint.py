"""Document fingerprints: a canonical exact digest, in DataFrame functions alone.

Texts are brought to one form (Unicode compatibility composition, full case
folding, white space folded to single spaces), hashed to 128 bits with xxhash,
and grouped by that; inside equal buckets, the canonical bytes are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, materialize, partitions

_LEAST = -(1 << 63)


def canonical(text: Column) -> Column:
    """NFKC of the case-folded text, white space as single spaces, none at the ends; a null is empty.

    Normalisation and folding are ICU's, which Spark ships and the SQL function
    ``reflect`` reaches inside the JVM. ASCII texts are in that form once they
    are lower case.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))

    def nfkc(x: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), x, F.lit(True))

    folded = nfkc(F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), nfkc(text), F.lit(True)))
    form = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(folded)
    return F.trim(F.regexp_replace(form, r"[\s\p{Z}\x1C-\x1F\x85]+", " "))


def digest(form: Column) -> Column:
    """128 bits of a canonical text as 32 hex digits: two xxhash values with different seeds."""
    half = lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")
    return F.concat(half(F.xxhash64(form)), half(F.xxhash64(F.lit("wide"), form)))


def fingerprint(text: Column) -> Column:
    return digest(canonical(text))


def likeness(a: Column, b: Column) -> Column:
    """Of two exact digests: 1 if they are the same, else 0."""
    return F.when(a == b, 1.0).otherwise(0.0)


def with_next(docs: DataFrame, *columns: str) -> DataFrame:
    """``docs`` (key, text, ...) with ``next_<column>`` of the document before it by key, the last wrapping to the first.

    Keys are cut at quantiles into buckets of a shuffle partition's share. Each
    bucket also gets a copy of its follower's first row, so the texts are
    shuffled once and no task sorts them all. The driver gets one key per
    bucket. Rows with equal keys are ordered by their texts' hashes.
    """
    n = 4 * partitions(docs)
    low, high, cuts = docs.agg(F.min("key"), F.max("key"), F.percentile_approx("key", [i / n for i in range(1, n)], 100 * n)).collect()[0]
    if high is None:
        return docs.select("*", *(F.col(c).alias(f"next_{c}") for c in columns))
    # from the largest; bucket k holds the keys from its own bound down to the next one
    bounds = sorted({high, *cuts}, reverse=True)
    step = max(1, int(len(bounds) ** 0.5))
    at_least = lambda array: F.size(F.filter(array, lambda b: b >= F.col("key")))
    coarse = at_least(F.array(*(F.lit(b) for b in bounds[step - 1 :: step])))
    fine = at_least(F.slice(F.array(*(F.lit(b) for b in bounds)), coarse * step + 1, F.lit(step)))
    bucket = coarse * step + fine - 1
    placed = docs.withColumn("_bucket", bucket)
    before = F.when(F.col("key") == high, F.lit(len(bounds) - 1)).otherwise(F.col("_bucket") - 1)
    first = F.col("key") == F.element_at(F.array(*(F.lit(b) for b in bounds)), F.col("_bucket") + 1)
    here = F.struct(F.col("_bucket").alias("b"), F.lit(0).alias("ghost"))
    places = F.when(first, F.array(here, F.struct(before.alias("b"), F.lit(1).alias("ghost")))).otherwise(F.array(here))
    spread = placed.withColumn("_place", F.explode(places)).drop("_bucket").withColumn("_bucket", F.col("_place.b")).withColumn("_ghost", F.col("_place.ghost")).drop("_place")
    order = Window.partitionBy("_bucket").orderBy("_ghost", F.desc("key"), F.xxhash64("text"), "text")
    led = spread.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in columns))
    return led.where("_ghost = 0").drop("_bucket", "_ghost")


def keyed(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, key, text``: a null id is the smallest key, a null text is empty."""
    return docs.select(
        F.col(doc).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc).cast("long"), F.lit(_LEAST)).alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def exact_groups(docs: DataFrame, digests: DataFrame | None = None, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, group_id, copies``: documents with the same canonical bytes share a group.

    ``group_id`` is the group's smallest id; ``key`` is as in :func:`keyed`.
    ``digests`` (key, fingerprint) saves hashing again. Buckets of one document
    need no comparison; the others' texts are fetched and compared with the
    bucket's first; a text that differs (a collision) is grouped by its bytes.
    Repeated rows are copies of each other; an empty table gives no rows.
    """
    rows = keyed(docs, doc, text)
    if digests is None:
        digests = materialize(rows.select("key", fingerprint(F.col("text")).alias("fingerprint")), "digests")
    # aggregates are written before they are joined, so that both sides of a join by fingerprint are plain shuffles
    # and Spark can split a bucket with very many copies
    buckets = materialize(digests.groupBy("fingerprint").agg(F.count("*").alias("copies"), F.min("key").alias("first")), "buckets")
    shared = buckets.where("copies > 1")
    met = digests.select("key", "fingerprint").distinct().join(shared, "fingerprint").select("key", "fingerprint", "first")
    texts = materialize(rows.join(met, "key").select("key", "fingerprint", "first", canonical(F.col("text")).alias("form")).where(digest(F.col("form")) == F.col("fingerprint")), "forms")
    firsts = materialize(texts.where("key = first").groupBy("fingerprint").agg(F.min("form").alias("own")), "firsts")
    same = F.col("form") == F.col("own")
    compared = texts.join(firsts, "fingerprint").select("key", "fingerprint", "first", same.alias("same"), F.when(~same, F.col("form")).alias("form"))
    compared = materialize(compared, "compared")
    equal = compared.where("same").groupBy("key", "fingerprint").agg(F.first("first").alias("group_id"))
    sizes = materialize(compared.where("same").groupBy("fingerprint").agg(F.count("*").alias("copies")), "copies")
    equal = equal.join(sizes, "fingerprint").select("key", "fingerprint", "group_id", "copies")
    odd = compared.where("not same")
    odd_groups = materialize(odd.groupBy("fingerprint", "form").agg(F.min("key").alias("group_id"), F.count("*").alias("copies")), "odd")
    unequal = odd.join(odd_groups, ["fingerprint", "form"]).select("key", "fingerprint", "group_id", "copies").distinct()
    discard(texts)
    alone = buckets.where("copies = 1").select(F.col("first").alias("key"), "fingerprint", F.col("first").alias("group_id"), "copies")
    return alone.unionByName(equal).unionByName(unequal)
