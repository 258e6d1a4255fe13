import hashlib
import re
import unicodedata

from pyspark.sql import functions as F

from tabulary.llm import fingerprint as fp

from .helpers import hard_docs, hard_rows, no_docs


def form(text):
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold())
    return re.sub(r"\s+", " ", folded).strip()


TEXTS = ["Ｆｕｌｌ ﬁ Straße", "é x", "é  X\n", "ΣΑΣ", "a　b c", "ASCII \t Text ", None, "", " ", " x ", "각", "각", "ÅÅÅ"]


def test_one_form_and_one_digest(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", fp.canonical(F.col("t")).alias("c"), fp.fingerprint(F.col("t")).alias("f")).collect()
    for r in rows:
        assert r.c == form(r.t) and re.fullmatch("[0-9a-f]{32}", r.f)
    assert len({r.f for r in rows}) == len({form(t) for t in TEXTS})


def plain(rows):
    """For distinct ids: the query's columns but for the digests themselves."""
    ordered = sorted(rows, reverse=True)
    out = {}
    groups = {}
    for i, t in rows:
        groups[form(t)] = min(groups.get(form(t), i), i)
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        out[i] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), float(form(t) == form(edited)), float(form(t) == form(after)), groups[form(t)])
    return out


def test_query(spark, sf):
    from tabulary.llm.queries import op7_fingerprint

    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = op7_fingerprint(spark, sf)
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.group_id) for r in got.collect()} == plain(rows)


def test_hard_rows(spark, tmp_path):
    from tabulary.llm.queries import op7_fingerprint

    hard_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = op7_fingerprint(spark, str(tmp_path)).collect()
    assert len(got) == len(hard_rows())
    lengths = sorted((str(r[0]), len(r[1] or "")) for r in hard_rows())
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == lengths
    by_form = {}
    for r in got:
        by_form.setdefault(r.fingerprint, set()).add(r.group_id)
    assert all(len(g) == 1 for g in by_form.values())


def test_few_and_no_rows(spark, tmp_path):
    from tabulary.llm.queries import op7_fingerprint

    for name, rows in (("none", []), ("one", [(5, "Only one")]), ("null", [(None, "x"), (None, None)]), ("two", [(1, "abcdef"), (2, "ghi")])):
        spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = op7_fingerprint(spark, f"{tmp_path}/{name}").collect()
        assert len(got) == len(rows)
        if name in ("one", "two"):
            assert {r.doc_id: (r.n_chars, r.edited_sha256, r.near_edited, r.near_next, r.group_id) for r in got} == plain(rows)


def test_buckets_are_compared_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(fp, "digest", lambda form: F.when(form.startswith("a"), "same").otherwise(form))
    docs = spark.createDataFrame([(1, "a one"), (2, "A  ONE"), (3, "a two"), (4, "a two "), (5, "b")], "doc_id long, text string")
    got = {r.key: (r.group_id, r.copies) for r in fp.exact_groups(docs).collect()}
    assert got == {1: (1, 2), 2: (1, 2), 3: (3, 2), 4: (3, 2), 5: (5, 1)}
    assert fp.exact_groups(no_docs(spark)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    from tabulary.llm.queries import op7_fingerprint

    plan = op7_fingerprint(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
