import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from tabulary.llm import token_store as ts

from .helpers import LONG, hard_docs, hard_rows, no_docs

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


PLAIN = tokenizers.Tokenizer.from_file(PATH)


def ids(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids


def encoded(texts):
    cache = ts.WordCache(PATH)
    data = "".join(texts).encode()
    at = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    got, n = cache.encode(np.frombuffer(data, np.uint8), at)
    return [x.tolist() for x in np.split(got, np.cumsum(n)[:-1])]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab A1é×²ñÿ.,'s\n\t  !_- 　 \x1c\x85<|>€😀")), max_size=40), min_size=1, max_size=5))
def test_words_encode_as_whole_texts_do(texts):
    assert encoded(texts) == [ids(t) for t in texts]


def test_known_hard_texts():
    texts = ["", "it's 'store' don't", "<|endoftext|> hi", " \n", "a.\nB c", "x² ²3.4", "end ", LONG[:5000], "a  b", "..\n\n.. "]
    assert encoded(texts) == [ids(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", "<|", "a", "B1", " ", "\n", ".", "é", "|>"]), max_size=12).map("".join), min_size=1, max_size=4))
def test_special_tokens_inside_texts(texts):
    from tokenizers import Tokenizer

    assert encoded(["a<|endoftext|>b"]) == [[64, 50256, 65]]
    plain = Tokenizer.from_file(PATH)
    assert encoded(texts) == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    keys = np.arange(n, dtype=np.int64) * 7 - 3
    hashes = ts.key_hash(keys)
    mph = ts.PerfectHash.build(hashes)
    assert sorted(mph.slots(hashes).tolist()) == list(range(n))
    with pytest.raises(ValueError):
        ts.PerfectHash.build(np.array([5, 5], np.uint64))


def plain(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        own = [*ids(t), 0]
        out.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    return sorted(out, key=str)


def test_query(spark, sf):
    from tabulary.llm.queries import op5_token_store

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op5_token_store(spark, sf).collect()), key=str) == plain(rows)


def test_hard_rows(spark):
    from tabulary.llm.queries import token_rows

    assert sorted(map(tuple, token_rows(hard_docs(spark)).collect()), key=str) == plain([(r[0], r[1]) for r in hard_rows()])
    assert token_rows(no_docs(spark)).count() == 0


def test_foreign_keys_are_not_found(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(0, 6000, 2)], "doc_id long, text string")
    store = ts.write(docs, PATH, vocabulary=50_257)
    asked = spark.createDataFrame([(i,) for i in range(6000)], "doc_id long")
    found = ts.fetch(ts.locate(asked, store), store).collect()
    assert sorted(r.doc_id for r in found) == list(range(0, 6000, 2))


def test_wide_ids(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id long, text string")
    store = ts.write(docs, PATH, vocabulary=1 << 20)
    assert store.width == 4
    assert sorted(map(tuple, ts.fetch(ts.locate(docs, store), store).collect())) == plain([(1, "one two"), (2, None)])


def thue_morse(n):
    t = "0"
    while len(t) < n:
        t += t.translate(str.maketrans("01", "10"))
    return [x.translate(str.maketrans("01", "ab")) for x in (t, t.translate(str.maketrans("01", "10")))]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_patterned_words(n):
    """Words that sums over letters can't tell apart."""
    a, b = thue_morse(n)
    assert encoded([a, f"{b} {a}", b]) == [ids(a), ids(f"{b} {a}"), ids(b)]


def test_words_with_the_same_hash(monkeypatch):
    monkeypatch.setattr(ts, "span_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) % np.uint64(3))
    texts = ["one two three four", "two one", "", "four five seven eleven", "one"]
    assert encoded(texts) == [ids(t) for t in texts]


def test_files_with_other_words(tmp_path):
    """A normaliser or another pattern: whole texts are encoded."""
    rules = json.loads(PLAIN.to_str())
    rules["normalizer"] = {"type": "Lowercase"}
    path = str(tmp_path / "lower.json")
    tokenizers.Tokenizer.from_str(json.dumps(rules)).save(path)
    cache = ts.WordCache(path)
    data = np.frombuffer("One TWO three".encode(), np.uint8)
    got, n = cache.encode(data, np.array([0, 7, 7, 13]))
    plain = tokenizers.Tokenizer.from_file(path)
    assert not cache.cuts_words and ts.WordCache(PATH).cuts_words
    assert got.tolist() == plain.encode("One TWO").ids + plain.encode(" three").ids and n[1] == 0


def test_keys_that_many_rows_have(spark):
    """A key, and the null key, over several shards."""
    rows = [(7 if i % 3 else None if i % 2 else i, f"text {i % 50}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    store = ts.write(docs, PATH, vocabulary=50_257)
    assert sum(x == 7 for x in store.lasts) > 1
    got = ts.fetch(ts.locate(docs.select("doc_id").distinct(), store), store).unionByName(ts.unkeyed(spark, store))
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_slices_of_sliced_batches():
    from tabulary.llm.common import slices

    batch = pa.RecordBatch.from_pydict({"text": ["a", None, "ccc", "", "é" * 10]}).slice(1, 4)
    got = [data[at[i] : at[i + 1]].tobytes().decode() for _, data, at in slices([batch], "text", 4) for i in range(len(at) - 1)]
    assert got == ["", "ccc", "", "é" * 10]
