import random
import re

import numpy as np

from tabulary.llm import line_dedup as ld

from .helpers import hard_docs, hard_rows, lower, no_docs, words


def plain(docs):
    """Text, lines and emptied lines by id: every word in a run of 50 that an earlier place has goes, with the white space behind it."""
    first, out = {}, {}
    for d, text in sorted(docs):
        w = [(m.start(), lower(m.group())) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        gone = [False] * len(w)
        for i in range(len(w) - ld.PASSAGE + 1):
            if first.setdefault(tuple(x for _, x in w[i : i + ld.PASSAGE]), (d, i)) != (d, i):
                gone[i : i + ld.PASSAGE] = [True] * ld.PASSAGE
        ends = [a for a, _ in w[1:]] + [len(text)]
        left = text[: w[0][0]] if w else text
        lines = {}
        for (a, _), b, g in zip(w, ends, gone):
            left += "" if g else text[a:b]
            lines.setdefault(text.count("\n", 0, a), []).append(g)
        out[d] = (left, len(lines), sum(map(all, lines.values())))
    return out


def result(docs):
    return {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in ld.dedup_lines(docs).collect()}


def check(spark, docs):
    got, want = result(spark.createDataFrame(docs, "doc_id long, text string")), plain(docs)
    assert got == want
    return got


def test_query(spark, sf):
    from tabulary.llm.queries import op1_line_dedup

    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in op1_line_dedup(spark, sf).collect()}
    assert got == plain(docs)
    assert sum(len(words(t)) for _, t in docs) - sum(len(words(t)) for t, _, _ in got.values()) > 9000


def test_planted_passages(spark):
    rng = random.Random(5)
    sentence = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(2, 9))) + "."
    passage = " ".join(sentence() for _ in range(14))
    short = sentence()
    docs = []
    for d in range(60):
        parts = [sentence() for _ in range(30)]
        if d % 3 == 0:
            parts.insert(rng.randrange(30), passage if d % 2 else passage.upper())
        parts.insert(0, short)
        docs.append((d, rng.choice((" ", "\n")).join(parts)))
    got = check(spark, docs)
    assert sorted(d for d, t in docs if got[d][0] != t) == list(range(3, 60, 3))


def test_passages_anywhere(spark):
    """With long sentences and with none; overlaps, repeats within a text, and first places that differ within a passage."""
    for step in (0, 70, 23):
        rng = random.Random(step)
        fresh = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
        passage = [f"p{k}" for k in range(51)]
        own = {d: fresh(rng.randrange(3, 60)) + passage[d % 2 :] + fresh(rng.randrange(0, 60)) for d in range(10)}
        own[10] = fresh(9) + passage[:49] + fresh(90)  # too short
        own[11] = own[10][20:40] + passage * 2  # twice in one text
        own[12] = own[10][2:30] + own[3] + own[4][1:]
        own[13] = [f"q{k % 7}" for k in range(120)]  # only itself
        # the earliest place of the passage's midst is not that of the whole
        long = fresh(80)
        own[14], own[15], own[16] = fresh(5) + long[20:55] + fresh(30), fresh(7) + long + fresh(3), fresh(8) + long[14:64] + fresh(2)
        if step:
            own = {d: [w + "." if int(w[1:]) % step == 0 else w for w in x] for d, x in own.items()}
        got = check(spark, [(d, ("\n" if d % 2 else " ").join(x)) for d, x in own.items()])
        assert sum(got[d][0].split() != own[d] for d in own) == 13


def test_random_pieces_of_few_texts(spark):
    """Cut and joined pieces, so that every kind of partial overlap occurs."""
    rng = random.Random(11)
    base = [f"b{k}" for k in range(400)]
    docs = []
    for d in range(80):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(380)
            parts += base[a : a + rng.randrange(10, 120)] + [f"x{rng.randrange(3)}"] * rng.randrange(2)
        docs.append((d, " ".join(parts)))
    check(spark, docs)


def test_runs_are_not_stitched_together(spark):
    """Two lines of 30 words, each from another text, are no passage when they stand side by side."""
    a, b = (" ".join(f"{c}{k}" for k in range(30)) for c in "ab")
    docs = [(0, f"x y\n{a}\nz"), (1, f"u v w\n{b}\nq"), (2, f"{a}\n{b}"), (3, f"s\n{a}\n{b}\nt")]
    got = check(spark, docs)
    assert got[2][0] == docs[2][1] and got[3] == ("s\nt", 4, 2)


def test_patterned_words_differ(spark):
    """Words that sums over letters can't tell apart."""
    t = "0"
    while len(t) < 2048:
        t += t.translate(str.maketrans("01", "10"))
    a, b = (x.translate(str.maketrans("01", "ab")) for x in (t, t.translate(str.maketrans("01", "10"))))
    rest = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join([*rest[:25], w, *rest[25:50]])) for k, w in enumerate([a, b, a])]
    got = check(spark, docs)
    assert got[1][0] == docs[1][1] and got[2][0] == ""


def test_hashes_of_runs():
    rng = np.random.default_rng(1)
    words_ = rng.integers(0, 3, 200).astype(np.uint64)
    runs = ld.Runs(words_)
    start, size = rng.integers(0, 100, 2000), rng.integers(1, 75, 2000)
    by_hash, by_words = {}, {}
    for s, n, h in zip(start, size, runs.of(start, size)):
        key = tuple(words_[s : s + n])
        assert by_hash.setdefault(h, key) == key and by_words.setdefault(key, h) == h


def test_hard_rows(spark):
    got = ld.dedup_lines(hard_docs(spark)).collect()
    assert len(got) == len(hard_rows())
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    prose = next(r[1] for r in hard_rows() if r[0] == 1)
    assert [r.text for r in by_id[1]] == [prose, prose]  # the same place twice
    assert by_id[8][0].text == "" and by_id[8][0].n_removed == by_id[8][0].n_lines  # a later copy
    assert by_id[3][0].text is None and by_id[2][0].text == ""
    assert {r.text for r in by_id[None]} == {prose, None}
    assert ld.dedup_lines(no_docs(spark)).count() == 0
