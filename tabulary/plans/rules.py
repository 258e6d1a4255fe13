"""The rule model: decision tables as data.

A rule set has typed inputs, typed outputs, an ordered list of rules (the first
whose condition holds fires), values for when none does, and derived outputs
that may refer to outputs before them.

Conditions and values are nested dicts, so that a rule set can be kept as JSON.

Conditions::

    {"field": "amount", "op": ">", "value": 10}        comparison, see OPERATORS
    {"output": "priority", "op": "in", "value": [..]}  on an output (derived only)
    {"all": [..]}, {"any": [..]}, {"not": ..}          and, or, not

Values: a plain value, or one of::

    {"field": name}  {"output": name}
    {"add"|"subtract"|"multiply"|"divide"|"min"|"max": [value, ..]}
    {"template": "text {name} text"}     of outputs, then fields
    {"if": condition, "then": value, "else": value}
    {"condition": condition}             as a boolean, false where unknown
    {"list": [value, ..]}  {"object": {name: value}}
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from ..errors import RuleEngineError, SchemaInferenceError
from ..rule_types import KINDS, spark_type

OPERATORS = ("==", "!=", "<", "<=", ">", ">=", "in", "not in", "between", "is null", "is not null", "contains", "starts with", "ends with", "matches")
ARITHMETIC = ("add", "subtract", "multiply", "divide", "min", "max")
_REQUIRED = object()


@dataclass(frozen=True)
class Field:
    """An input. ``values`` lists its domain, for those who read the rule."""

    name: str
    kind: str = "string"
    default: Any = None
    values: tuple = ()


@dataclass(frozen=True)
class Output:
    name: str
    kind: str = "string"
    dtype: T.DataType | None = None

    @property
    def type(self) -> T.DataType:
        return self.dtype or spark_type(self.kind)


@dataclass(frozen=True)
class Rule:
    when: dict
    then: dict[str, Any]


@dataclass
class RuleSet:
    name: str
    inputs: list[Field]
    outputs: list[Output]
    rules: list[Rule] = field(default_factory=list)
    default: dict[str, Any] = field(default_factory=dict)
    derived: dict[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        known, made = {f.name for f in self.inputs}, {o.name for o in self.outputs}
        if len(known) < len(self.inputs) or len(made) < len(self.outputs):
            raise RuleEngineError(f"{self.name}: names of inputs and of outputs must differ")
        if not made:
            raise SchemaInferenceError(f"{self.name} declares no outputs")
        for f in self.inputs:
            if f.kind not in KINDS:
                raise RuleEngineError(f"{self.name}: input {f.name} has the unknown type {f.kind}")
        for where, values in [*((f"rule {i}", r.then) for i, r in enumerate(self.rules, 1)), ("default", self.default), ("derived", self.derived)]:
            for name in values:
                if name not in made:
                    raise RuleEngineError(f"{self.name}, {where}: {name} is not an output")
        if both := set(self.derived) & set().union(self.default, *(r.then for r in self.rules)):
            raise RuleEngineError(f"{self.name}: {sorted(both)} are both set by rules and derived")
        for i, rule in enumerate(self.rules, 1):
            for part in (rule.when, *rule.then.values()):
                self._check(part, f"rule {i}", known, set())
        for name, value in self.default.items():
            self._check(value, f"default of {name}", known, set())
        ready = made - set(self.derived)
        for name, value in self.derived.items():
            self._check(value, f"derived {name}", known, ready)
            ready = ready | {name}

    def _check(self, part: Any, where: str, fields: set[str], outputs: set[str]) -> None:
        for node in walk(part):
            if "field" in node and node["field"] not in fields:
                raise RuleEngineError(f"{self.name}, {where}: {node['field']} is not an input")
            if "output" in node and node["output"] not in outputs:
                raise RuleEngineError(f"{self.name}, {where}: output {node['output']} is not known here")
            if "op" in node and node["op"] not in OPERATORS:
                raise RuleEngineError(f"{self.name}, {where}: unknown operator {node['op']}")

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(o.name, o.type, True) for o in self.outputs])

    def comparisons(self) -> int:
        """How many comparisons the conditions of all rules hold."""
        return sum("op" in node for rule in self.rules for node in walk(rule.when))

    @staticmethod
    def from_dict(data: dict) -> RuleSet:
        """Read a definition; ``inputs`` and ``outputs`` may also be named requestSchema and responseSchema."""

        def entries(*names: str) -> list[dict]:
            found = next((data[n] for n in names if data.get(n)), [])
            return [e for e in found if e.get("key") or e.get("name")]

        return RuleSet(
            data.get("name") or data.get("slug") or "rule",
            [Field(e.get("key") or e["name"], e.get("type") or "string", e.get("default"), tuple(e.get("values", ()))) for e in entries("inputs", "requestSchema", "request_schema")],
            [Output(e.get("key") or e["name"], e.get("type") or "string") for e in entries("outputs", "responseSchema", "response_schema")],
            [Rule(r["when"], r["then"]) for r in data.get("rules", [])],
            data.get("default", {}),
            data.get("derived", {}),
        )

    @staticmethod
    def from_json(text: str) -> RuleSet:
        return RuleSet.from_dict(json.loads(text))

    def to_dict(self) -> dict:
        return {
            "name": self.name,
            "inputs": [{"name": f.name, "type": f.kind, "default": f.default, "values": list(f.values)} for f in self.inputs],
            "outputs": [{"name": o.name, "type": o.kind} for o in self.outputs],
            "rules": [{"when": r.when, "then": r.then} for r in self.rules],
            "default": self.default,
            "derived": self.derived,
        }


def walk(part: Any) -> Iterator[dict]:
    """All dicts of a condition or value that stand for something (plain objects are values of their own)."""
    if isinstance(part, dict):
        yield part
        for key, inner in part.items():
            if key == "value" and not isinstance(inner, dict):
                continue
            yield from walk(list(inner.values()) if key == "object" and isinstance(inner, dict) else inner)
    elif isinstance(part, (list, tuple)):
        for inner in part:
            yield from walk(inner)


class Registry:
    """Rule sets by name."""

    def __init__(self, *rulesets: RuleSet, load: Callable[[str], RuleSet] | None = None):
        self._known = {r.name: r for r in rulesets}
        self._load = load

    def add(self, ruleset: RuleSet) -> RuleSet:
        self._known[ruleset.name] = ruleset
        return ruleset

    def get(self, name: str) -> RuleSet:
        if name not in self._known:
            if self._load is None:
                raise SchemaInferenceError(f"no rule is named {name}")
            self._known[name] = self._load(name)
        return self._known[name]

    def names(self) -> list[str]:
        return sorted(self._known)


#: Where ``solve`` looks names up unless given another registry.
registry = Registry()
