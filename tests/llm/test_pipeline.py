from collections import Counter

import corpus_pipeline as cp

from tabulary.llm.common import materialize
from tabulary.llm.queries import token_rows

from .helpers import hard_docs, no_docs, words
from .test_decontaminate import plain as contaminated
from .test_mixing import plain_mix
from .test_near_dup import plain as components


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in cp.STAGES]
    assert names == ["language_id", "near_dup", "decontaminate", "mixing", "token_store"]
    stages = dict(cp.STAGES)
    after = {}
    for name in names:
        docs = materialize(stages[name](spark, docs, sf), name)
        after[name] = docs
        if name != "token_store":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    start = rows(spark.read.parquet(f"{sf}/documents.parquet"))
    assert rows(after["language_id"]) == {k: t for k, t in start.items() if any(c.isalpha() for c in t)}
    kept = {r[0] for r in components(list(rows(after["language_id"]).items()), 5) if r[3]}
    assert set(rows(after["near_dup"])) == kept
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    clean = {r[0] for r in contaminated(list(rows(after["near_dup"]).items()), items) if not r[5]}
    assert set(rows(after["decontaminate"])) == clean
    left = after["decontaminate"].collect()
    taken = plain_mix([(r.doc_id, r.source, len(words(r.text))) for r in left])
    want = Counter({tuple(r): taken[r.doc_id] // len(words(r.text)) for r in left if taken[r.doc_id]})
    assert Counter(map(tuple, after["mixing"].collect())) == want
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, token_rows(after["mixing"]).collect()))
    assert sorted(map(tuple, cp.run(spark, sf).collect())) == sorted(map(tuple, docs.collect()))


def test_hard_and_no_rows(spark, sf):
    for docs in (hard_docs(spark), no_docs(spark)):
        for name, stage in cp.STAGES:
            docs = materialize(stage(spark, docs, sf), name)
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
