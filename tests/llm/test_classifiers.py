import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabulary.llm import language_id as li
from tabulary.llm import quality as ql
from tabulary.llm.common import utf8

from .helpers import hard_docs, hard_rows, no_docs

SF = "/root/testdata/sf0.01"


def plain_trigrams(text):
    """Counts of letter trigrams; a run of letters has a space at either end."""
    low = lambda c: c.lower() if len(c.lower()) == 1 else c
    runs = "".join(low(c) if c.isalpha() else " " for c in text or "").split(" ")
    out = Counter()
    for run in filter(None, runs):
        letters = [0, *map(ord, run), 0]
        out.update(zip(letters, letters[1:], letters[2:]))
    return out


def plain_vector(a, b, c):
    sign = lambda x: li.letter_bits(np.array([x]))[0].astype(int) * 2 - 1
    return np.roll(sign(a), 2) * np.roll(sign(b), 1) * sign(c)


def plain_nearest(text, profiles):
    """Language, score, and cosine of the text's bundle itself."""
    counts = plain_trigrams(text)
    if not counts:
        return "und", 0.0, 0.0
    bundle = sum(n * plain_vector(*t) for t, n in counts.items())
    products = profiles.vectors.astype(float) @ bundle
    length = np.sqrt(li.DIMENSIONS * sum(n * n for n in counts.values()))
    return profiles.languages[products.argmax()], min(1.0, max(0.0, products.max() / length)), products.max() / np.linalg.norm(bundle)


def test_trigrams_bind():
    keys = np.array([ord("a") << 21 | ord("b"), (ord("a") << 42) | (ord("b") << 21) | ord("c"), 0x4E2D << 42 | 0x6587 << 21 | ord("c")])
    want = [plain_vector(k >> 42, k >> 21 & (1 << 21) - 1, k & (1 << 21) - 1) for k in keys.tolist()]
    assert np.array_equal(li.trigram_vectors(keys), want)
    assert abs(want[0] @ want[1]) < 200  # close to orthogonal


def test_texts_do_not_leak_into_each_other():
    texts = ["abab ABA", "", None, "cd ef", "1 2 !?", "é", "İx straße 中文字"]
    data, at = utf8(pa.array(texts, pa.string()))
    doc, key, count = li.trigram_counts(data, at)
    got = [{(k >> 42, k >> 21 & (1 << 21) - 1, k & (1 << 21) - 1): n for d, k, n in zip(doc.tolist(), key.tolist(), count.tolist()) if d == i} for i in range(len(texts))]
    assert got == [dict(plain_trigrams(t)) for t in texts]


def test_scores_against_plain_numpy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    profiles = li.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.predict(docs, profiles).collect()}
    for r in docs.collect()[:60]:
        lang, score, cosine = plain_nearest((r.text or "")[:], profiles)
        assert got[r.doc_id][0] == lang and got[r.doc_id][1] == pytest.approx(score, abs=1e-4)
        assert score == pytest.approx(cosine, abs=0.15)


def test_prototypes_against_plain_numpy(spark):
    rows = [(1, "one two three", "en"), (2, "un deux trois", "fr"), (3, "two three one", "en"), (4, None, "en"), (5, "1", "fr"), (6, "x", None)]
    profiles = li.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert profiles.languages == ["en", "fr"]
    for name, vector in zip(profiles.languages, profiles.vectors):
        total = 0
        for _, text, lang in rows:
            counts = plain_trigrams(text)
            if lang == name and counts:
                total = total + sum(n * plain_vector(*t) for t, n in counts.items()) / np.sqrt(sum(n * n for n in counts.values()))
        assert np.allclose(vector, total / np.linalg.norm(total), atol=1e-4)
    many = spark.range(li.MAX_LANGUAGES + 1).selectExpr("id as doc_id", "'a' as text", "cast(id as string) as lang")
    with pytest.raises(ValueError, match="languages"):
        li.fit(many)


def test_rich_alphabets_in_bounded_memory():
    """10 MB of random Han letters in one text."""
    import resource

    rng = np.random.default_rng(3)
    text = "".join(map(chr, rng.integers(0x4E00, 0x9FA5, 3_400_000)))
    profiles = li.Profiles(["a", "b"], rng.normal(0, 0.03, (2, li.DIMENSIONS)).astype(np.float32))
    data, at = utf8(pa.array([text], pa.string()))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    names, _ = li.nearest(data, at, profiles)
    assert names[0] in ("a", "b") and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1 << 20  # KB


def test_language_query(spark):
    from tabulary.llm.queries import op10_language_id

    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id][0] for r in held]) > 0.97
    assert {r.lang_pred for r in got} <= {v[0] for v in truth.values()} | {"und"}
    assert {r.doc_id: tuple(r) for r in got} == {r.doc_id: tuple(r) for r in op10_language_id(spark, SF).collect()}


def test_language_hard_rows(spark):
    docs = hard_docs(spark)
    profiles = li.fit(docs)
    got = sorted((str(r.doc_id), r.lang_pred == "und") for r in li.predict(docs, profiles).collect())
    want = sorted((str(r[0]), r[1] is None or not any(c.isalpha() for c in r[1])) for r in hard_rows())
    assert got == want
    kept = li.keep_languages(docs, profiles)
    assert kept.columns == docs.columns and kept.count() == sum(not u for _, u in want)
    assert li.predict(no_docs(spark), profiles).count() == 0
    assert {r.lang_pred for r in li.predict(docs, li.fit(no_docs(spark))).collect()} == {"und"}


def test_quality_query(spark):
    from tabulary.llm.queries import op2_quality

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = op2_quality(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    good = [r.score for r in held if labels[r.doc_id] == 1]
    bad = [r.score for r in held if labels[r.doc_id] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([s >= 0.3 for s in good]) > 0.97 and np.mean([s >= 0.3 for s in bad]) < 0.3


def kind(byte):
    order = [byte == 0x0A, byte < 0x21, byte >= 0x80, 0x61 <= byte <= 0x7A, 0x41 <= byte <= 0x5A, 0x30 <= byte <= 0x39, byte in b",."]
    return [1, 0, 7, 2, 3, 4, 5, 6][[*order, True].index(True)]


def plain_features(text):
    data = (text or "").encode()
    out = [0.0] * ql.N_FEATURES
    if not data:
        return out
    for byte in data:
        out[min(byte, 128)] += 1 / len(data)
    for a, b in zip(data, data[1:]):
        out[129 + kind(a) * 8 + kind(b)] += 1 / len(data)
    out[:193] = np.sqrt(out[:193])
    own, lines = re.findall(rb"[^\x20\x09-\x0D]+", data.lower()), re.findall(rb"[^\n]*\n|[^\n]+$", data)
    if own:
        out[193], out[194] = len(set(own)) / len(own), len(set(own)) / np.sqrt(len(own)) / 20
        out[195], out[196] = min(len(data) / len(own), 40) / 10, np.mean([a == b for a, b in zip(own, own[1:])] or [0])
    out[197] = 1 - len(set(lines)) / len(lines)
    out[198:] = np.log1p(len(own)) / 10, np.log1p(len(lines)) / 10, np.log1p(len(own) / len(lines)) / 5
    return out


def test_quality_scores_against_plain_numpy(spark):
    """Features and score of every document and of the hard rows, from the fitted numbers alone."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    network = ql.fit(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    odd = [(-1, None), (-2, ""), (-3, " \n\n a a\tB9.,;é\n"), (-4, "one"), (-5, "x\ny\nx\ny"), (-6, "\x00\x1f~\x7f"), (-7, "word " * 50_000)]
    rows = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    got = {r.doc_id: r.score for r in ql.score(rows, network).collect()}
    texts = {r.doc_id: r.text for r in rows.collect()}
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        x = np.clip((np.array(plain_features(text)) - network.mean) / network.scale, -8, 8)
        z = sum(w * np.tanh(x @ column + b) for w, column, b in zip(network.w2, network.w1.T, network.b1)) + network.b2
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=2e-5), i


def test_non_negative_risk_separates_without_negatives():
    rng = np.random.default_rng(1)
    make = lambda n, shift: np.pad(rng.normal(shift, 1, (n, 4)), ((0, 0), (0, ql.N_FEATURES - 4)))
    network = ql.train(make(800, 2), np.concatenate([make(560, 2), make(240, -2)]), 0.7)
    assert network.score(make(300, 2)).mean() > 0.85 and network.score(make(300, -2)).mean() < 0.2


def test_quality_hard_rows(spark):
    docs = hard_docs(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (4, 1), (5, 0)], "doc_id long, quality int")
    network = ql.fit(docs, labels)
    got = ql.score(docs, network).collect()
    assert len(got) == len(hard_rows()) and all(0 <= r.score <= 1 for r in got)
    empty = ql.fit(docs, labels.limit(0))
    assert len({r.score for r in ql.score(docs, empty).collect()}) == 1
    assert ql.score(no_docs(spark), network).count() == 0
