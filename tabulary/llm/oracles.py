"""DuckDB SQL, written out by rule, for queries whose order of documents hangs on a hash or whose groups on all pairs."""

from __future__ import annotations

# The five primes of xxhash's 64-bit form.
P1, P2, P3, P4, P5 = 11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261
_TOP = f"{1 << 64}::UHUGEINT"
#: Spark's seed.
SEED = 42


def _times(x: str, by: int) -> str:
    return f"(({x}) * {by}::UHUGEINT) % {_TOP}"


def _turned(x: str, bits: int) -> str:
    """``x``, a column, rotated to the left."""
    return f"({_times(x, 1 << bits)} + {x} // {1 << (64 - bits)}::UHUGEINT)"


def _mixed(x: str, bits: int) -> str:
    return f"xor({x}, {x} // {1 << bits}::UHUGEINT)"


def xxhash64(source: str, out: str, first: int, columns: list[str]) -> str:
    """Table expressions that give ``out``: ``source`` with ``h``, Spark's xxhash64 of an INT and BIGINT columns, as an unsigned number.

    A number's steps are expressions of their own, as each uses the one before twice.
    """
    steps = [f"SELECT *, xor({(SEED + P5 + 4) % (1 << 64)}::UHUGEINT, {first * P1 % (1 << 64)}::UHUGEINT) AS h, 0::UHUGEINT AS k FROM {source}"]

    def then(h: str, k: str = "k") -> None:
        steps.append(f"SELECT * EXCLUDE (h, k), {h} AS h, {k} AS k FROM {out}{len(steps) - 1}")

    def finish() -> None:
        then(_times(_mixed("h", 33), P2))
        then(_times(_mixed("h", 29), P3))
        then(_mixed("h", 32))

    then(f"({_times(_turned('h', 23), P2)} + {P3}) % {_TOP}")
    finish()
    for column in columns:
        unsigned = f"(({column}::HUGEINT + {1 << 64}) % {1 << 64})::UHUGEINT"
        then(f"(h + {P5 + 8}) % {_TOP}", _times(unsigned, P2))
        then(f"xor(h, {_times(_turned('k', 31), P1)})")
        then(f"({_times(_turned('h', 27), P1)} + {P4}) % {_TOP}")
        finish()
    named = [f"{out}{i} AS ({s})" for i, s in enumerate(steps)]
    return ",\n".join([*named, f"{out} AS (SELECT * EXCLUDE (k) FROM {out}{len(steps) - 1})"])


#: All documents that share a shingle are compared, and links followed to their ends.
NEAR_DUP = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 1], ' ') AS s FROM listed, unnest(range(1, greatest(1, len(w) - 1) + 1)) t(k) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM met JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * common >= 80 * (a.n + b.n - common)
), reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reached.doc_id, links.y FROM reached JOIN links ON reached.other = links.x
), least_id AS (
  SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM least_id LEFT JOIN sizes USING (doc_id)
"""

#: Sources stand in the order in which they fill up: each is full if its share of what those before leave is three times its size.
MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), repeated AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) AS rep FROM sized
), {xxhash64("repeated", "hashed", 17, ["doc_id", "rep"])}, shuffled AS (
  SELECT * EXCLUDE (h), (h::HUGEINT + {1 << 63}) % {1 << 64} AS shuffle FROM hashed
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank, rank % 3 + 1 AS weight FROM totals
), filled AS (
  SELECT *, (SELECT sum(source_size) FROM totals) - 3 * coalesce(sum(source_size) OVER (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remains,
         sum(weight) OVER (ORDER BY source_size::DOUBLE / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight FROM weighted
), judged AS (
  SELECT *, weight * remains >= 3 * source_size * open_weight AS filled_up FROM filled
), open_ AS (
  SELECT max(remains) AS remains, max(open_weight) AS open_weight FROM judged WHERE NOT filled_up
), targets AS (
  SELECT source, source_size, rank, CASE WHEN filled_up THEN 3.0::DOUBLE * source_size ELSE CAST(weight * o.remains AS DOUBLE) / CAST(o.open_weight AS DOUBLE) END AS target FROM judged, open_ o
), budget AS (
  SELECT floor(least(sum(source_size), sum(target)) + 1e-6) AS words FROM targets
), queued AS (
  SELECT s.*, source_size, rank, target, epoch,
         sum(size) OVER (PARTITION BY s.source, epoch ORDER BY shuffle, doc_id, size, rep ROWS UNBOUNDED PRECEDING) AS cum
  FROM shuffled s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source, range(3) e(epoch)
), timed AS (
  SELECT *, CASE WHEN target > 0 THEN CAST(epoch * source_size + cum AS DOUBLE) / target END AS finish FROM queued
), dealt AS (
  SELECT *, sum(size) FILTER (finish IS NOT NULL) OVER (ORDER BY finish, rank, epoch, shuffle, doc_id, size, rep ROWS UNBOUNDED PRECEDING) AS reached FROM timed
)
SELECT doc_id, size, source_size, target, CAST(coalesce(sum(size) FILTER (finish IS NOT NULL AND reached <= words), 0) AS BIGINT) AS taken
FROM dealt, budget GROUP BY doc_id, source, size, rep, source_size, target
"""
