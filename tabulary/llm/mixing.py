"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, identified, materialize, quoted, running_total


def word_count(text: Column) -> Column:
    """Runs of characters other than space, tab and line ends; 0 for a null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sizes: dict, weights: dict, budget: float, epochs: int) -> dict:
    """Shares of ``budget`` in proportion to the weights, none above ``epochs`` times its size.

    What a full source leaves over is shared again among the rest by weight; a
    source of weight 0 gets none of it.
    """
    targets = dict.fromkeys(sizes, 0.0)
    open_, left = set(sizes), float(budget)
    while open_ and left > 0:
        total = sum(weights[s] for s in sorted(open_, key=str))
        if not total:
            break
        full = {s for s in open_ if weights[s] * left / total >= epochs * sizes[s]}
        if not full:
            return targets | {s: weights[s] * left / total for s in open_}
        for s in sorted(full, key=str):
            targets[s] = float(epochs * sizes[s])
            left -= targets[s]
        open_ -= full
    return targets


def ranked_weights(sources: list, cycle: tuple[int, ...] = (1, 2, 3)) -> dict:
    """Weights by the order of the sources' code points, null last."""
    ordered = sorted((s for s in sources if s is not None)) + [None] * (None in sources)
    return {s: cycle[i % len(cycle)] for i, s in enumerate(ordered)}


def mix(
    docs: DataFrame,
    weights: dict | None = None,
    fraction: float = 1.0,
    epochs: int = 3,
    seed: int = 17,
    doc: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per document: ``doc_id, size, source, source_size, target, copies, taken``.

    Within a source, documents stand in the order of a seeded hash. Copy e of
    one has the virtual finish time (e * source size + words up to and with it)
    / source's target. All copies are range-sorted by that time and taken until
    ``fraction`` of all words is reached; as the targets of full sources leave
    less than that, the sum of all targets ends the mix too.

    ``weights`` maps a source to its weight (default: :func:`ranked_weights`).
    Of a source of weight 0 nothing is taken. A null text has size 0, and a document of size 0 is never taken; a null
    source is a source of its own; repeated rows are documents of their own;
    an empty table gives no rows; other columns are ignored. The driver holds
    one number per source.
    """
    spark = docs.sparkSession
    sized = materialize(docs.select(quoted(doc).alias("doc_id"), quoted(source).cast("string").alias("source"), word_count(quoted(text)).alias("size")), "sizes")
    sizes = {s: n for s, n in sized.groupBy("source").agg(F.sum("size")).collect()}
    weights = ranked_weights(list(sizes)) if weights is None else weights
    if missing := set(sizes) - set(weights):
        raise ValueError(f"sources without a weight: {sorted(missing, key=str)}")
    goal = fraction * sum(sizes.values())
    targets = water_fill(sizes, weights, goal, epochs)
    # the largest whole number of words within the sum of the targets, which floats may miss by a hair
    budget = int(min(goal, sum(targets.values())) + 1e-6)
    ranked, before = [], 0
    for rank, s in enumerate(weights):
        if s in sizes:
            ranked.append((s, rank, sizes[s], before, targets[s]))
            before += sizes[s]
    plan = spark.createDataFrame(ranked, "source string, rank int, source_size long, before long, target double")
    if len(ranked) <= 100_000:
        plan = F.broadcast(plan)
    items = (
        sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("rep")).drop("n")
        .withColumn("shuffle", F.xxhash64(F.lit(seed), "doc_id", "rep"))
    )
    joined = items.alias("i").join(plan.alias("p"), F.col("i.source").eqNullSafe(F.col("p.source")))
    placed = joined.select("i.*", "p.rank", "p.source_size", "p.before", "p.target")
    own = ["shuffle", "doc_id", "size", "rep"]
    ranked_rows = running_total(placed, ["rank", *own], "size", "total")
    queued = ranked_rows.withColumn("cum", F.col("total") - F.col("before")).drop("total", "before")
    copies = queued.select("*", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))).alias("epoch")).withColumn(
        "finish",
        F.when(F.col("target") > 0, (F.col("epoch") * F.col("source_size") + F.col("cum")) / F.col("target")),
    )
    # what has no finish time is never taken, and must not use up the budget
    copies = copies.withColumn("queued", F.when(F.col("finish").isNotNull(), F.col("size")).otherwise(F.lit(0)))
    sorted_ = running_total(copies, ["finish", "rank", "epoch", *own], "queued", "reached")
    discard(sized)
    discard(ranked_rows)
    in_ = (F.col("size") > 0) & F.col("finish").isNotNull() & (F.col("reached") <= budget)
    return sorted_.groupBy("doc_id", "source", "size", "rep", "source_size", "target").agg(
        F.count(F.when(in_, 1)).alias("copies"),
        F.sum(F.when(in_, F.col("size")).otherwise(F.lit(0))).cast("long").alias("taken"),
    )


def apply_mix(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The rows of ``docs``, each as often as :func:`mix` takes it (``options`` go there).

    Rows that agree in id, source and size share the copies taken of them, in the
    order of their texts' hashes.
    """
    size, key, copies, many, place, time, value = fresh(docs, "_size", "_key", "_copies", "_many", "_place", "_time", "_hash")
    mixed = mix(docs, doc=doc, text=text, source=source, **options)
    taken = mixed.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias(copies), F.count("*").alias(many)).where(F.col(copies) > 0)
    taken = materialize(taken.select(F.to_json(F.struct("doc_id", "source", "size")).alias(key), copies, many), "taken")
    own = F.struct(quoted(doc).alias("doc_id"), quoted(source).cast("string").alias("source"), F.col(size).alias("size"))
    rows = docs.withColumn(size, word_count(quoted(text))).withColumn(key, F.to_json(own))
    names = [quoted(c) for c in docs.columns]
    if taken.where(F.col(many) > 1).take(1):
        rows, row = identified(docs, doc)
        rows = rows.withColumn(size, word_count(quoted(text))).withColumn(key, F.to_json(own))
        repeated = rows.join(taken.where(F.col(many) > 1), key, "left_semi").select(key, row, F.xxhash64(quoted(text)).alias(value), F.lit(1).alias("one"))
        # numbered by a range sort, as one key may have very many rows
        counted = running_total(repeated, [key, value, row], "one", place)
        before = materialize(counted.groupBy(key).agg((F.min(place) - 1).alias("before")), "before")
        numbered = counted.join(before, key).select(row, (F.col(place) - F.col("before")).alias(place))
        rows = rows.join(numbered, row, "left").withColumn(place, F.coalesce(place, F.lit(1)))
    else:
        rows = rows.withColumn(place, F.lit(1))
    share = F.floor(F.col(copies) / F.col(many)) + F.when(F.col(place) <= F.col(copies) % F.col(many), 1).otherwise(0)
    shared = rows.join(taken.hint("merge"), key).select(*names, share.cast("int").alias(time)).where(F.col(time) > 0)
    return shared.withColumn(time, F.explode(F.sequence(F.lit(1), F.col(time)))).select(*names)
