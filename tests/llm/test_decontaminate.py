import hashlib
import random

import pytest

from tabulary.llm import decontaminate as dc

from .helpers import alnum_words, hard_docs, hard_rows, no_docs


def plain(docs, items, width=10):
    windows = {}
    for item, text in items:
        w = alnum_words(text)
        for k in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[k : k + width]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = alnum_words(text)
        hit, found = set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (x := tuple(w[k : k + size])) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[x]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_against_plain_python(spark, sf):
    from tabulary.llm.queries import op6_decontaminate

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = sorted(map(tuple, op6_decontaminate(spark, sf).collect()), key=str)
    assert got == plain(docs, items)
    assert any(r[5] for r in got)


ITEMS = [(1, "word0 of the 0 word1"), (2, ""), (3, None), (None, "ÜNÏCODE"), (5, "w100 w101 w102 w103 w104 w105 w106 w107 w108 w109 w110 w111"), (5, "one"), (6, "123")]


def test_hard_rows_also_in_rounds(spark, monkeypatch):
    items = spark.createDataFrame([(*x, "z") for x in ITEMS], "item_id long, text string, doc_id string")
    want = plain([(r[0], r[1]) for r in hard_rows()], ITEMS)
    assert sorted(map(tuple, dc.contamination(dc.build_index(hard_docs(spark)), items).collect()), key=str) == want
    monkeypatch.setattr(dc, "MAX_QUERY_BYTES", 100)
    assert sorted(map(tuple, dc.contamination(dc.build_index(hard_docs(spark)), items).collect()), key=str) == want


def test_no_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert dc.contamination(dc.build_index(no_docs(spark)), some).count() == 0
    assert not any(r.contaminated for r in dc.contamination(dc.build_index(hard_docs(spark)), none).collect())


def test_search_exact_and_near(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "a b x c d e"), (3, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(9, "b c d e")], "item_id long, text string")
    index = dc.build_index(docs)
    assert [tuple(r) for r in dc.search(index, items, width=4).collect()] == [(1, "9", 1, 4)]
    assert {r.doc_id for r in dc.search(index, items, width=4, slop=1).collect()} == {1, 2}


def plain_search(docs, items, width, slop):
    out = set()
    for doc, text in docs:
        w = alnum_words(text)
        where = {}
        for k, x in enumerate(w):
            where.setdefault(x, []).append(k)
        for item, test in items:
            q = alnum_words(test)
            for j in range(max(1, len(q) - width + 1) if q else 0):
                window = q[j : j + width]
                for s in range(-slop, len(w) + slop):
                    if all(any(abs(p - s - k) <= slop for p in where.get(x, ())) for k, x in enumerate(window)):
                        out.add((doc, str(item), max(0, s), len(window)))
    return sorted(out)


@pytest.mark.parametrize("slop", [0, 1, 2, 3])
def test_proximity_against_plain_python(spark, slop):
    """Also at both ends of documents, with few letters so that every order and gap occurs."""
    rng = random.Random(slop)
    docs = [(k, " ".join(rng.choice("abcde") for _ in range(rng.randrange(0, 14)))) for k in range(60)] + [(100, "beta alpha alpha gamma"), (101, "gamma"), (102, "")]
    items = [(1, "alpha beta gamma"), (2, "a b c d"), (3, "e d"), (4, "a a b c e a"), (5, "")]
    index = dc.build_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = sorted({tuple(r) for r in dc.search(index, tests, width=4, slop=slop).collect()})
    assert got == plain_search(docs, items, 4, slop)
    assert any(r[0] == 100 for r in got) == (slop >= 1)


def test_slop_must_stay_within_a_document(spark):
    with pytest.raises(ValueError, match="slop"):
        dc.search(dc.build_index(no_docs(spark)), spark.createDataFrame([], "item_id long, text string"), slop=30)


@pytest.mark.parametrize("size", [1 << 20, 100])
def test_stage_judges_rows_not_ids(spark, monkeypatch, size):
    monkeypatch.setattr(dc, "MAX_QUERY_BYTES", size)
    rows = [(1, "clean text", "x"), (1, "has one word", "y"), (None, "one", "z"), (None, "clean", "v"), (2, None, "w"), (3, "two of them", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _bad string")
    items = spark.createDataFrame([(1, "one"), (2, "two of"), (3, None)], "item_id long, text string")
    left = dc.decontaminate(docs, items)
    assert left.columns == docs.columns and sorted(r._bad for r in left.collect()) == ["v", "w", "x"]


def test_stage_drops_contaminated_rows_only(spark):
    docs = hard_docs(spark)
    items = spark.createDataFrame([(1, "one")], "item_id long, text string")
    left = dc.decontaminate(docs, items)
    assert left.columns == docs.columns
    assert left.count() == docs.count() - 1 and left.where("doc_id = 5").count() == 0
