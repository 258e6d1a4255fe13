import struct

import pytest
import xxhash

from tabulary.llm import mixing

from .helpers import hard_docs, hard_rows, no_docs, words


def test_water_fill():
    sizes = {"a": 100, "b": 10, "c": 1000}
    got = mixing.water_fill(sizes, {"a": 1, "b": 2, "c": 3}, 1110, 3)
    assert got["b"] == 30 and sum(got.values()) == pytest.approx(1110)
    assert got["a"] == pytest.approx(270) and got["c"] == pytest.approx(810)
    assert mixing.water_fill({}, {}, 0, 3) == {}
    assert mixing.water_fill({"a": 5}, {"a": 1}, 100, 3) == {"a": 15.0}


def test_query(spark, sf):
    from tabulary.llm.queries import op9_mixing

    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in op9_mixing(spark, sf).collect()}
    again = {r.doc_id: r for r in op9_mixing(spark, sf).collect()}
    assert got == again and len(got) == len(rows)
    sizes, taken, largest = {}, {}, {}
    for r in rows:
        n = len(words(r.text))
        assert got[r.doc_id].size == n and got[r.doc_id].taken % max(1, n) == 0 and got[r.doc_id].taken <= 3 * n
        sizes[r.source] = sizes.get(r.source, 0) + n
        taken[r.source] = taken.get(r.source, 0) + got[r.doc_id].taken
        largest[r.source] = max(largest.get(r.source, 0), n)
    weights = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))}
    targets = mixing.water_fill(sizes, weights, sum(sizes.values()), 3)
    for r in rows:
        assert got[r.doc_id].source_size == sizes[r.source]
        assert got[r.doc_id].target == pytest.approx(targets[r.source])
    assert sum(taken.values()) <= sum(sizes.values())
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 2 * max(largest.values())


def plain_mix(rows, epochs=3, seed=17):
    """Words taken of each row (id, source, size), by sorting all copies by their virtual finish times."""
    sizes = {}
    for _, s, n in rows:
        sizes[s] = sizes.get(s, 0) + n
    order = sorted(x for x in sizes if x is not None) + [None] * (None in sizes)
    targets = mixing.water_fill(sizes, {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}, sum(sizes.values()), epochs)
    budget = int(min(sum(sizes.values()), sum(targets.values())) + 1e-6)

    def shuffled(doc):
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        for x in (doc, 1):
            h = xxhash.xxh64_intdigest(struct.pack("<q", x), h)
        return h - (1 << 64) if h >> 63 else h

    queue = []
    for s in sizes:
        cum = 0
        for h, doc, n in sorted((shuffled(d), d, n) for d, t, n in rows if t == s):
            cum += n
            queue += [((e * sizes[s] + cum) / targets[s], order.index(s), e, h, doc, n) for e in range(epochs) if targets[s] > 0]
    taken, reached = dict.fromkeys((d for d, _, _ in rows), 0), 0
    for *_, doc, n in sorted(queue):
        reached += n
        if reached <= budget:
            taken[doc] += n
    return taken


def test_which_documents_are_taken(spark, sf):
    from tabulary.llm.queries import op9_mixing

    rows = [(r.doc_id, r.source, len(words(r.text))) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert {r.doc_id: r.taken for r in op9_mixing(spark, sf).collect()} == plain_mix(rows)


def test_applied_copies_in_full(spark, sf):
    """The pipeline's stage: each row as often as the brute force takes it."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in docs.collect()]
    want = plain_mix(rows)
    copies = {d: want[d] // n for d, _, n in rows if want[d]}
    got = mixing.apply_mix(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r["count"] for r in got.groupBy("doc_id").count().collect()} == copies


def test_one_key_of_many_rows(spark):
    """Rows that agree in id, source and size share the copies, and no row is lost or made up."""
    rows = [(1, f"a b {'c' if i % 3 else 'd'}", "x", i) for i in range(50)] + [(2, "a b c d", "y", 99)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _place int")
    got = [tuple(r) for r in mixing.apply_mix(docs).collect()]
    assert len(got) == sum(r.copies for r in mixing.mix(docs).collect())
    times = [got.count(r) for r in rows if r[0] == 1]
    assert set(got) <= set(rows) and max(times) - min(times) <= 1


def test_hard_rows(spark):
    got = mixing.mix(hard_docs(spark)).collect()
    assert len(got) == len(hard_rows())
    total = {}
    for r in hard_rows():
        total[r[3]] = total.get(r[3], 0) + len(words(r[1]))
    for r in got:
        assert r.source_size == total[r.source] and r.taken == r.copies * r.size and r.copies <= 3
    assert mixing.mix(no_docs(spark)).count() == 0


def test_applied_mix_repeats_whole_rows(spark):
    docs = hard_docs(spark)
    out = mixing.apply_mix(docs)
    assert out.columns == docs.columns
    n = sum(r.copies for r in mixing.mix(docs).collect())
    assert out.count() == n
    assert set(map(tuple, out.collect())) <= set(map(tuple, docs.collect()))


def test_given_weights_and_fraction(spark):
    docs = spark.createDataFrame([(i, "a b c d e", "x" if i % 2 else "y") for i in range(400)], "doc_id long, text string, source string")
    got = mixing.mix(docs, weights={"x": 1, "y": 3}, fraction=0.4).groupBy("source").sum("taken").collect()
    assert {r[0]: r[1] for r in got} == {"x": pytest.approx(200, abs=5), "y": pytest.approx(600, abs=5)}


def test_a_weight_of_zero_takes_nothing_from_the_others(spark):
    docs = spark.createDataFrame([(i, f"word{i} of ten " * 5, "abc"[i % 3]) for i in range(90)], "doc_id long, text string, source string")
    taken = {}
    for r in mixing.mix(docs, weights={"a": 0, "b": 1, "c": 1}).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {"a": 0, "b": 675, "c": 675}  # half of 1350 words each
    assert mixing.water_fill({"a": 100, "b": 10}, {"a": 0, "b": 1}, 110, 3) == {"a": 0.0, "b": 30.0}
    taken = {r.source: r.taken for r in mixing.mix(docs.where("doc_id < 2"), weights={"a": 0, "b": 1}).collect()}
    assert taken == {"a": 0, "b": 30}
