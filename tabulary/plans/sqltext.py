"""SQL text under the interface of column expressions, so that one compiler makes both."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import functions
from pyspark.sql import types as T


def name_text(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _type_text(dtype: T.DataType | str) -> str:
    return dtype if isinstance(dtype, str) else dtype.simpleString()


def _literal_text(x: Any) -> str:
    if x is None:
        return "NULL"
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int):
        return f"{x}" if abs(x) < 1 << 31 else f"{x}L"
    if isinstance(x, float):
        return f"{x!r}D" if x - x == 0 else f"CAST('{x}' AS DOUBLE)"
    if isinstance(x, str):
        # as bytes, so that no setting of the session changes what an escape means
        return f"CAST(X'{x.encode().hex()}' AS STRING)" if set(x) & set("'\\") else f"'{x}'"
    raise TypeError(f"no SQL text for {x!r}")


class Text:
    """An expression as SQL text."""

    def __init__(self, sql: str, label: str | None = None, branches: list[tuple[str, str]] | None = None):
        self.sql, self.label, self.branches = sql, label, branches

    def _call(self, pattern: str, *args: Any) -> Text:
        return Text("(" + pattern.format(self.sql, *(_text(a) for a in args)) + ")")

    def __and__(self, x): return self._call("{} AND {}", x)
    def __or__(self, x): return self._call("{} OR {}", x)
    def __add__(self, x): return self._call("{} + {}", x)
    def __invert__(self): return self._call("NOT {}")
    def __eq__(self, x): return self._call("{} = {}", x)
    def __ne__(self, x): return self._call("{} <> {}", x)
    def __lt__(self, x): return self._call("{} < {}", x)
    def __le__(self, x): return self._call("{} <= {}", x)
    def __gt__(self, x): return self._call("{} > {}", x)
    def __ge__(self, x): return self._call("{} >= {}", x)
    def isNull(self): return self._call("{} IS NULL")
    def isNotNull(self): return self._call("{} IS NOT NULL")

    __hash__ = None

    def isin(self, *values: Any) -> Text:
        values = values[0] if len(values) == 1 and isinstance(values[0], (list, tuple)) else values
        return self._call("{} IN (" + ", ".join("{}" for _ in values) + ")", *values)

    def contains(self, x): return Text(f"contains({self.sql}, {_text(x)})")
    def startswith(self, x): return Text(f"startswith({self.sql}, {_text(x)})")
    def endswith(self, x): return Text(f"endswith({self.sql}, {_text(x)})")
    def rlike(self, x): return Text(f"rlike({self.sql}, {_text(x)})")
    def cast(self, dtype): return Text(f"CAST({self.sql} AS {_type_text(dtype)})")
    def try_cast(self, dtype): return Text(f"try_cast({self.sql} AS {_type_text(dtype)})")
    def alias(self, label): return Text(self.sql, label)

    def when(self, holds: Text, value: Any) -> Text:
        return _case([*self.branches, (holds.sql, _text(value))])

    def otherwise(self, value: Any) -> Text:
        return Text(_case(self.branches).sql[: -len(" END)")] + f" ELSE {_text(value)} END)")


def _text(x: Any) -> str:
    return x.sql if isinstance(x, Text) else _literal_text(x)


def _case(branches: list[tuple[str, str]]) -> Text:
    return Text("(CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in branches) + " END)", branches=branches)


class _TextFunctions:
    """The functions that the compiler uses, by the names that ``pyspark.sql.functions`` has for them."""

    def lit(self, x: Any) -> Text:
        return Text(_literal_text(x))

    def when(self, holds: Text, value: Any) -> Text:
        return _case([(holds.sql, _text(value))])

    def struct(self, *parts: Text) -> Text:
        return Text("named_struct(" + ", ".join(f"{_literal_text(p.label)}, {p.sql}" for p in parts) + ")")

    def to_json(self, x: Text, options: dict[str, str]) -> Text:
        return Text(f"to_json({x.sql}, map({', '.join(_literal_text(s) for pair in options.items() for s in pair)}))")

    def from_json(self, x: Text, dtype: T.DataType) -> Text:
        return Text(f"from_json({x.sql}, {_literal_text(dtype.simpleString())})")

    def __getattr__(self, name: str):
        return lambda *args: Text(f"{name}({', '.join(_text(a) for a in args)})")


text_functions = _TextFunctions()


def functions_of(*parts: Any):
    """The functions for expressions of the parts' kind."""
    return text_functions if any(isinstance(p, Text) for p in parts) else functions


class Staged:
    """Expressions named step by step, each step a SQL function of the values before it.

    Spark puts the arguments of a SQL function into a projection, so a value that
    later steps use often is written once.
    """

    def __init__(self, name: str):
        self.name, self.steps, self.known = name, [], []

    def stage(self, made: Iterable[tuple[str, Text, T.DataType]]) -> list[Text]:
        made = [(n, x, T.StringType() if isinstance(t, T.NullType) else t) for n, x, t in made]
        if made:
            old = [f"{_literal_text(n)}, _s.{name_text(n)}" for n, _ in self.known]
            new = [f"{_literal_text(n)}, CAST({x.sql} AS {t.simpleString()})" for n, x, t in made]
            before = self.struct()
            self.known += [(n, t) for n, _, t in made]
            self.steps.append((before, self.struct(), f"named_struct({', '.join(old + new)})"))
        return [Text(f"_s.{name_text(n)}") for n, _, _ in made]

    def struct(self) -> str:
        return T.StructType([T.StructField(n, t) for n, t in self.known]).simpleString()

    def functions(self, parameters: str, result: str, body: str) -> Iterable[str]:
        """Statements that make the steps and, last, the function itself; ``body`` reads the last step."""
        call = None
        for k, (before, after, text) in enumerate([*self.steps, (self.struct(), result, body)]):
            own = name_text(f"__{self.name}_{k}")
            yield f"CREATE OR REPLACE TEMPORARY FUNCTION {own}({parameters if call is None else f'_s {before}'}) RETURNS {after} RETURN {text}"
            call = f"{own}({call if call is not None else '{}'})"
        self.call = call
