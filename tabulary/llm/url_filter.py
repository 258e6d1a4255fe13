"""URL filter: a trie over reversed host labels and path segments."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: A trie up to this size, pickled, is sent to every executor; more rules than that are joined.
MAX_TRIE_BYTES = 128 << 20

_PATHS, _ENDS, _LONGEST = "/paths", "/ends", "/longest"  # no host label or path segment has a slash in it


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for a null or a text without ``://``."""
    if url is None:
        return "", ""
    _, found, rest = url.partition("://")
    if not found:
        return "", ""
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def build_trie(rules: Iterable[tuple[str, str, str]]) -> dict:
    """``rules``: (host, path, verdict). Of rules that are the same but for the verdict, block stays."""
    root: dict = {}
    for host, path, verdict in rules:
        if not host or verdict not in ("allow", "block"):
            raise ValueError(f"not a rule: {(host, path, verdict)}")
        node = root
        for label in reversed(host.translate(_LOWER).split(".")):
            node = node.setdefault(label, {})
        node = node.setdefault(_PATHS, {})
        *whole, part = path.split("/")
        for segment in whole:
            node = node.setdefault(segment, {})
        ends = node.setdefault(_ENDS, {})
        if ends.get(part, ("", ""))[1] != "block":
            ends[part] = (host.translate(_LOWER) + path, verdict)
            ends[_LONGEST] = max(ends.get(_LONGEST, 0), len(part))
    return root


def look_up(trie: dict, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits, and its verdict; of two as long, the one with the longer host."""
    segments = path.split("/")
    best: tuple[str, str] | None = None
    node: dict | None = trie
    for label in reversed(host.split(".")):
        node = node.get(label)
        if node is None:
            break
        inner = node.get(_PATHS)
        depth = 0
        while inner is not None:
            ends = inner.get(_ENDS, {})
            for n in range(min(len(segments[depth]), ends.get(_LONGEST, -1)), -1, -1):  # the longest beginning of the segment
                found = ends.get(segments[depth][:n])
                if found:
                    if best is None or len(found[0]) >= len(best[0]):
                        best = found
                    break
            if depth + 1 >= len(segments):  # the last segment has no slash behind it
                break
            inner = inner.get(segments[depth])
            depth += 1
    return best


def judge_urls(
    pages: DataFrame,
    rules: Iterable[tuple[str, str, str]],
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule`` (null where none fits) and ``verdict`` of every row.

    A rule fits its host and all subdomains, on paths that start with its own;
    the longest wins, whether it allows or blocks. A null or malformed url has
    an empty host and path, which no rule fits. Only the two named columns are
    read, and every row, repeated ones too, is judged once. Rows do not move
    unless the rules are too many to be sent everywhere.
    """
    rules = list(rules)
    trie = build_trie(rules)
    if len(pickle.dumps(trie)) > MAX_TRIE_BYTES:
        return _joined(pages.select(key, url), rules, key, url, default)
    shared = pages.sparkSession.sparkContext.broadcast(trie)
    picked = pages.select(key, url)
    key_type = picked.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root = shared.value
        for batch in batches:
            parts = [split_url(u) for u in batch.column(1).to_pylist()]
            found = [look_up(root, h, p) for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array([f and f[0] for f in found], pa.string()),
                    pa.array([f[1] if f else default for f in found], pa.string()),
                ],
                names=[key, "host", "path", "rule", "verdict"],
            )

    return map_arrow(picked, run, f"`{key}` {key_type}, host string, path string, rule string, verdict string")


def _joined(pages: DataFrame, rules: list[tuple[str, str, str]], key: str, url: str, default: str) -> DataFrame:
    """As ``judge_urls``, by joins: each distinct url meets the rules of its host's suffixes and path's prefixes.

    A rule is stored under its host and the whole segments of its path; what is
    left of the path is compared after the join.
    """
    spark = pages.sparkSession
    listed = [(h.translate(_LOWER), p[: p.rfind("/") + 1], p, h.translate(_LOWER) + p, v) for h, p, v in rules]
    known = spark.createDataFrame(listed, "_host string, _stem string, _path string, _rule string, _verdict string")
    known = known.groupBy("_host", "_stem", "_path", "_rule").agg(F.max("_verdict").alias("_verdict"))  # block over allow
    rest = F.regexp_extract(F.col("_url"), r"(?s)^.*?://(.*)$", 1)
    urls = pages.select(F.coalesce(F.col(url), F.lit("")).alias("_url")).distinct()
    urls = urls.select("_url", F.translate(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("host"), F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"))

    def ends(text, mark: str, whole):
        """Each part of ``text`` cut at ``mark``, by its number."""
        n = F.size(F.split(text, mark))
        return F.explode(F.transform(F.sequence(F.lit(0), n - 1), whole))

    labels, segments = F.split("host", r"\."), F.split("path", "/")
    tried = urls.select("*", ends(F.col("host"), r"\.", lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")).alias("_host"))
    tried = tried.select("*", ends(F.col("path"), "/", lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(segments, F.lit(1), i), "/"), F.lit("/")))).alias("_stem"))
    hits = tried.join(known, ["_host", "_stem"]).where(F.startswith(F.col("path"), F.col("_path")))
    best = hits.groupBy("_url").agg(F.max_by(F.struct("_rule", "_verdict"), F.struct(F.length("_rule"), F.length("_host"))).alias("_best"))
    judged = urls.join(best, "_url", "left").select("_url", "host", "path", F.col("_best._rule").alias("rule"), F.coalesce("_best._verdict", F.lit(default)).alias("verdict"))
    return pages.withColumn("_url", F.coalesce(F.col(url), F.lit(""))).join(judged, "_url").select(key, judged["host"], judged["path"], judged["rule"], "verdict")
