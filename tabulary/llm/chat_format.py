"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the
context, and only that reply is trainable. The whole path is DataFrame
expressions.

Template of a turn::

    ### <role>:\\n<text>\\n</turn>\\n

A control string inside a text (``### `` or ``</turn>``) gets one more
backslash in front of those it already has, so that an unescaped control string
is always the template's own; :func:`unescape` takes that backslash off again.
Within roles, backslashes and line ends are escaped too, so that a role never
leaves its line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "### ", "</turn>"
_CONTROL = r"(?:### |</turn>)"
_TAIL = f"\n{CLOSE}\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{_CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*{_CONTROL})", "$1")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    # cut at doubled backslashes first: those never begin a "\\n"
    parts = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_chat(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    target_role: str = "assistant",
) -> DataFrame:
    """One row per assistant turn, with its context in front.

    Columns: ``conv_id``, ``example`` (from 0), ``n_turns`` (turns in the
    example), ``text``, ``loss_start`` (0-based, in code points) and
    ``loss_chars`` (0: nothing to train on), ``whole`` (the example holds the
    entire conversation). Turns after the last assistant turn come in one more
    example without loss, so that nothing is lost.

    Rows are ordered by turn (null first), then role and text. A null text or
    role is empty, a null conversation id is a conversation like another,
    repeated rows are turns of their own, and an empty table gives no rows.
    Other columns are ignored. Examples are cut from the conversation one at a
    time, so memory follows the conversation, not the expansion.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    escaped = grouped.select(
        "conv_id",
        F.transform("turns", lambda t: t["role"] == target_role).alias("mine"),
        F.transform("turns", lambda t: escape(t["text"])).alias("bodies"),
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), _escape_role(t["role"]), F.lit(":\n"))).alias("heads"),
    )
    joined = escaped.select(
        "conv_id",
        "mine",
        F.transform("bodies", lambda b: F.length(b)).alias("lengths"),
        F.array_join(F.transform(F.arrays_zip("heads", "bodies"), lambda z: F.concat(z["heads"], z["bodies"], F.lit(_TAIL))), "").alias("text"),
        F.aggregate(
            F.transform(F.arrays_zip("heads", "bodies"), lambda z: (F.length(z["heads"]) + F.length(z["bodies"]) + len(_TAIL)).cast("long")),
            F.expr("cast(array() as array<long>)"),
            lambda ends, n: F.concat(ends, F.array(n + F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0)))),
        ).alias("ends"),
    )
    n = F.size("mine")
    picked = joined.withColumn(
        "targets",
        F.filter(F.sequence(F.lit(1), n), lambda i: F.element_at("mine", i) | (i == n)),
    )
    end, length = F.element_at("ends", F.col("last")), F.element_at("lengths", F.col("last"))
    trained = F.element_at("mine", F.col("last"))
    return picked.select("*", F.posexplode("targets").alias("example", "last")).select(
        "conv_id",
        F.col("example").cast("long").alias("example"),
        F.col("last").cast("long").alias("n_turns"),
        F.substring(F.col("text"), F.lit(1), end.cast("int")).alias("text"),
        F.when(trained, end - len(_TAIL) - length).otherwise(F.lit(0)).cast("long").alias("loss_start"),
        F.when(trained, length).otherwise(F.lit(0)).cast("long").alias("loss_chars"),
        (F.col("last") == n).alias("whole"),
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""
    pieces = F.filter(F.split(text, rf"(?<=\n){CLOSE}\n"), lambda p: F.length(p) > 0)

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        head = F.substring(piece, F.lit(1), line - F.lit(1))
        body = F.substring(piece, line + F.lit(1), F.length(piece) - line - F.lit(1))
        return F.struct(
            _unescape_role(F.substring(head, F.lit(len(OPEN) + 1), F.length(head) - F.lit(len(OPEN) + 1))).alias("role"),
            unescape(body).alias("text"),
        )

    return F.transform(pieces, turn)


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """What the mask of an example trains on, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), chars.cast("int")))
