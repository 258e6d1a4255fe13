"""Plain Python forms of what the operators compute, and rows that are hard to handle."""

import re

_LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, size long, rep long, label string, version long, spans string, bands string, u long, part int, _size string, _key int, _Row string, _gone int, __fired int, node long, version_ long"
PROSE = " ".join(f"word{i % 97} of the {i % 13}" for i in range(60))
LONG = " ".join(f"w{i}" for i in range(120_000))


def lower(text):
    return text.translate(_LOW)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))


def hard_rows():
    """Nulls in any column, empty and very long texts, ties, repeated rows; other columns clash with names used inside."""
    rows = [
        (1, PROSE, "en", "a"), (1, PROSE, "en", "a"), (2, "", "en", "b"), (3, None, None, None), (None, PROSE, "en", "a"), (None, None, None, None),
        (4, LONG, "en", "a"), (5, "One", "en", "b"), (6, "  \n\t ", "fr", "b"), (7, "!!! 123 ???", None, "b"), (8, PROSE.upper(), "fr", None), (9, "é è ê ünïcode \U0001f600 zero\x00byte", "fr", "é"),
    ]
    return [(*r, None if r[1] is None else len(r[1]), 1, 2, 3, "x", 4, None, "y", 5, None, "keep", 6, None, 7, 8, 9, 10) for r in rows]


def hard_docs(spark):
    return spark.createDataFrame(hard_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
