import random

import pytest

from tabulary.llm import near_dup as nd

from .helpers import hard_docs, hard_rows, no_docs, words


def shingles(text, width):
    w = words(text)
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def plain(rows, width, percent=80):
    """By row: (id, set size, component, kept), over all pairs of distinct sets."""
    sets = [frozenset(shingles(t, width)) for _, t in rows]
    parent = {s: s for (i, _), s in zip(rows, sets) if i is not None and s}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = list(parent)
    for k, a in enumerate(known):
        for b in known[:k]:
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s in parent and i is not None:
            least[find(s)] = min(least.get(find(s), i), i)
    out = []
    for (i, _), s in zip(rows, sets):
        c = None if i is None else least[find(s)] if s else i
        out.append((i, len(s), c, True if i is None else i == c))
    return sorted(out, key=str)


def run(spark, rows, width):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, nd.near_duplicates(docs, width=width).collect()), key=str)


@pytest.mark.parametrize("width", [2, 5])
def test_query_tables(spark, sf, width):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert run(spark, rows, width) == plain(rows, width)


def test_chains_and_a_crowded_bucket(spark, monkeypatch):
    """Near copies of one text, of which many are no link of its own, and chains whose ends are not linked; small blocks."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    monkeypatch.setattr(nd, "FAN", 8)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for k in range(140):
        own = list(base)
        for _ in range(rng.randrange(0, 14)):
            own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((1000 - k, " ".join(own)))
    chain = [f"c{i}" for i in range(100)]
    for k in range(12):
        rows.append((2000 - k, " ".join(chain[k * 4 :] + [f"d{i}" for i in range(k * 4)])))
    assert run(spark, rows, 2) == plain(rows, 2)


def edited(text, k, start=0):
    return " ".join(f"e{i}" if i == start else w for i, w in enumerate(text.split())) + f" tail{k}"


def test_ids_that_repeat_with_other_texts(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, edited(a, 1)), (3, edited(b, 2)), (4, "alone"), (4, a), (4, "alone")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        got = run(spark, order, 2)
        assert got == plain(order, 2)
        assert {r[2] for r in got if r[0] in (2, 3)} == {1}


def test_one_row_of_each_group_stays(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(0, b, 1), (1, a, 2), (1, b, 3), (None, a, 4), (None, "c d e f g", 5), (None, "c d e f g", 6), (7, None, 7), (7, None, 8), (8, a, 9), (1, a, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    got = sorted((str(r.doc_id), r.text) for r in nd.drop_near_duplicates(docs).collect())
    assert got == [("0", b), ("1", a), ("7", None), ("7", None), ("None", "c d e f g")]
    assert nd.drop_near_duplicates(docs).columns == docs.columns


def template(n, share=0.75, size=200):
    """Documents that share three quarters of their shingles, a similarity of 0.6, and are no links."""
    base = [f"t{i}" for i in range(int(size * share))]
    return [(k, " ".join(base + [f"own{k}x{i}" for i in range(size - len(base))])) for k in range(n)]


def test_documents_of_a_template_are_not_all_compared(spark, monkeypatch):
    """Strays of one crowd are thinned before they are compared, and true links among them stay."""
    monkeypatch.setattr(nd, "BLOCK", 16)
    rows = template(300) + [(1000 + k, t + " more") for k, t in template(20)]
    rows = [(i, t) for i, t in rows if i != 5]
    seen = []
    plain_compare = nd.compare

    def counted(groups, width, percent):
        seen.append(groups.count())
        return plain_compare(groups, width, percent)

    monkeypatch.setattr(nd, "compare", counted)
    got = run(spark, rows, 5)
    assert sorted((r[0], r[2]) for r in got if r[0] != r[2]) == sorted((1000 + k, k) for k in range(20) if k != 5)
    assert seen[-1] < 1000  # rows of blocks; several thousand if none were thinned


def test_patterned_words(spark):
    from .test_token_store import thue_morse

    a, b = thue_morse(1024)
    rows = [(1, a), (2, b), (3, f"{a} x"), (4, f"{b} x"), (5, b)]
    assert run(spark, rows, 2) == plain(rows, 2)


def test_sets_are_exact(monkeypatch):
    monkeypatch.setattr("tabulary.llm.common.span_hashes", lambda data, starts, ends, lower=False: (ends - starts).astype("uint64"))
    texts = ["a b c d e", "a b c d f", "B a", "b a", "", "a", "x y z a b c d E"]
    for width in (1, 2, 5):
        sets = [set(s.tolist()) for s in nd.exact_sets(texts, width)]
        want = [shingles(t, width) for t in texts]
        assert [[len(a & b) for b in sets] for a in sets] == [[len(a & b) for b in want] for a in want]


def test_exact_threshold(spark):
    # 8 of 10 shingles shared is a link, 79 of 100 is not
    a, b = "p q r s t u v w x y", "p q r s t u v w x z"
    assert {r[2] for r in run(spark, [(1, a), (2, b)], 2)} == {1}
    c, d = "p q r s t u v w x", "p q r s t u v w z z2"
    assert {r[2] for r in run(spark, [(1, c), (2, d)], 2)} == {1, 2}


def test_hard_rows(spark):
    rows = [(r[0], r[1]) for r in hard_rows()]
    got = sorted(map(tuple, nd.near_duplicates(hard_docs(spark), width=2).collect()), key=str)
    assert got == plain(rows, 2)
    assert nd.near_duplicates(no_docs(spark)).count() == 0


def test_components_of_long_paths(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 90), (95, 90), (95, 100)] + [(1000, 500 + i) for i in range(30)]
    got = {r.node: r.label for r in nd.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 1000: 500, **{500 + i: 500 for i in range(30)}}
