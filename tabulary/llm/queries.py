"""The queries of this subpackage: ``name -> f(spark, sf_dir)``, and the SQL that some can be checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, decontaminate, fingerprint, language_id, line_dedup, mixing, near_dup, oracles, quality, token_store, url_filter
from .common import is_member, materialize, table

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = is_member("doc_id", 5, 0)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    network = quality.fit(docs.where(~held_out), labels)
    scored = quality.score(docs, network)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op4_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_rows(docs)


def token_rows(docs: DataFrame) -> DataFrame:
    """Write the documents' ids, then look every document up and read its record back."""
    import public_tokenizers

    store = token_store.write(docs, public_tokenizers.path("byte_bpe_50k.json"), vocabulary=50_257)
    found = token_store.locate(docs.select("doc_id").distinct(), store)
    return token_store.fetch(found, store).unionByName(token_store.unkeyed(docs.sparkSession, store))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = materialize(decontaminate.build_index(table(spark, sf_dir, "documents")), "index")
    return decontaminate.contamination(index, table(spark, sf_dir, "benchmark"))


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hashed = fingerprint.keyed(docs).withColumn("fingerprint", fingerprint.fingerprint(F.col("text")))
    led = fingerprint.with_next(hashed, "text", "fingerprint")
    third = F.floor(F.length("text") / F.lit(3)).cast("int")
    edited = led.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third)))
    digests = edited.select(
        "doc_id", "key",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint.fingerprint(F.col("edited")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    digests = materialize(digests, "digests")
    groups = fingerprint.exact_groups(docs, digests.select("key", "fingerprint"))
    out = digests.join(groups.select("key", "fingerprint", "group_id"), ["key", "fingerprint"])
    return out.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        fingerprint.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        fingerprint.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
        "group_id",
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    odd = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    examples = chat_format.format_chat(turns)
    loss = F.when(F.col("loss_chars") > 0, chat_format.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars"))).otherwise("")
    read = examples.select(
        "conv_id",
        F.struct("example", loss.alias("loss")).alias("part"),
        F.length("text").cast("long").alias("chars"),
        F.when(F.col("whole"), F.col("text")).alias("full"),
    )
    back = read.groupBy("conv_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["loss"]), "").alias("loss"),
        F.element_at(F.collect_list("full"), 1).alias("full"),
        F.sum("chars").alias("formatted_chars"),
    )
    turns_back = chat_format.read_turns(F.col("full"))
    listed = F.array_join(F.transform(turns_back, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size(turns_back).cast("long").alias("n_turns"),
        F.sha2(listed, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = is_member("doc_id", 3, 1)
    profiles = language_id.fit(docs.where(~held_out))
    return language_id.predict(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality": op2_quality,
    "op3_url_filter": op3_url_filter,
    "op4_near_dup": op4_near_dup,
    "op5_token_store": op5_token_store,
    "op6_decontaminate": op6_decontaminate,
    "op7_fingerprint": op7_fingerprint,
    "op8_chat_format": op8_chat_format,
    "op9_mixing": op9_mixing,
    "op10_language_id": op10_language_id,
}

ORACLE_SQL = {
    "op3_url_filter": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(rh, rp, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), hits AS (
  SELECT page_id, rh || rp AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(rh || rp) DESC) AS k
  FROM parts JOIN rules ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp)
)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts p LEFT JOIN hits h ON p.page_id = h.page_id AND k = 1
""",
    "op8_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), seg AS (
  SELECT *, 4 + length(role) + 2 + length(regexp_replace(text, '(\\*(?:### |</turn>))', '\\\1', 'g')) + 9 AS n FROM t
), run AS (
  SELECT *, sum(n) OVER (PARTITION BY conv_id ORDER BY turn) AS upto,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1 AS final FROM seg
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR final) AS BIGINT) AS formatted_chars
FROM run GROUP BY conv_id
""",
    "op1_line_dedup": r"""
WITH cut AS (
  SELECT doc_id, text, regexp_extract(text, '^[\x20\x09-\x0D]*') AS lead, regexp_extract_all(text, '[^\x20\x09-\x0D]+[\x20\x09-\x0D]*') AS pieces FROM documents
), words AS (
  SELECT doc_id, lead, p, pieces[p] AS piece, translate(regexp_replace(pieces[p], '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word FROM cut, unnest(range(1, len(pieces) + 1)) t(p)
), placed AS (
  SELECT *, coalesce(sum(length(piece) - length(replace(piece, chr(10), ''))) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line FROM words
), listed AS (
  SELECT doc_id, list(word ORDER BY p) AS w FROM words GROUP BY doc_id
), runs AS (
  SELECT doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS run FROM listed, unnest(range(1, len(w) - 48)) t(k)
), later AS (
  SELECT doc_id, k FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS r FROM runs) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, p FROM later, unnest(range(k, k + 50)) t(p)
), marked AS (
  SELECT w.*, g.p IS NOT NULL AS gone FROM placed w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.p = g.p
), texts AS (
  SELECT doc_id, any_value(lead) || coalesce(string_agg(piece, '' ORDER BY p) FILTER (NOT gone), '') AS text FROM marked GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (whole) AS n_removed FROM (SELECT doc_id, line, bool_and(gone) AS whole FROM marked GROUP BY doc_id, line) GROUP BY doc_id
)
SELECT c.doc_id, coalesce(t.text, c.text) AS text, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM cut c LEFT JOIN texts t ON c.doc_id = t.doc_id LEFT JOIN lines l ON c.doc_id = l.doc_id
""",
    "op6_decontaminate": r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), tests AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS x, least(10, len(w)) AS n FROM tests, unnest(range(1, greatest(1, len(w) - 9) + 1)) t(k) WHERE len(w) > 0
), runs AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS x FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(w) - n + 2)) t(k)
), hits AS (
  SELECT doc_id, k, runs.n, item_id FROM runs JOIN windows USING (x, n)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, k, n FROM hits), unnest(range(k, k + n)) t(p) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN items i ON d.doc_id = i.doc_id
""",
    "op4_near_dup": oracles.NEAR_DUP,
    "op9_mixing": oracles.MIXING,
}
