"""Rule sets judged row by row in plain Python, as evaluators do; also what tests compare Catalyst with."""

from __future__ import annotations

import math
import re
from typing import Any

from ..functions.coerce import coerce_value
from .rules import RuleSet

_KINDS = {"number": "number", "boolean": "boolean", "string": "string", "date": "date"}


def evaluate_row(ruleset: RuleSet, row: dict[str, Any]) -> dict[str, Any]:
    """Outputs of one row; ``error`` tells of a value that could not be made."""
    fields = {}
    for f in ruleset.inputs:
        x = row.get(f.name)
        if isinstance(x, float) and math.isnan(x):
            x = None
        if x is not None and f.kind in _KINDS and not (f.kind == "number" and isinstance(x, (int, float)) and not isinstance(x, bool)):
            x = coerce_value(x, _KINDS[f.kind])
        fields[f.name] = f.default if x is None else x
    hit = next((r.then for r in ruleset.rules if _holds(r.when, fields, {})), ruleset.default)
    outputs: dict[str, Any] = {}
    try:
        for o in ruleset.outputs:
            if o.name not in ruleset.derived:
                outputs[o.name] = _value(hit.get(o.name), fields, {}, o.name)
        for name, part in ruleset.derived.items():
            outputs[name] = _value(part, fields, outputs, name)
    except _Failed as failed:
        return {"error": str(failed)}
    return outputs


class _Failed(Exception):
    pass


def _holds(part: dict, fields: dict, outputs: dict) -> bool | None:
    if "all" in part:
        found = [_holds(p, fields, outputs) for p in part["all"]]
        return False if False in found else None if None in found else True
    if "any" in part:
        found = [_holds(p, fields, outputs) for p in part["any"]]
        return True if True in found else None if None in found else False
    if "not" in part:
        found = _holds(part["not"], fields, outputs)
        return None if found is None else not found
    x = fields[part["field"]] if "field" in part else outputs[part["output"]]
    op, y = part["op"], part.get("value")
    if op == "is null":
        return x is None
    if op == "is not null":
        return x is not None
    if op in ("in", "not in"):
        if not y:
            return op == "not in"
        return None if x is None else (x in y) == (op == "in")
    if isinstance(y, dict):
        y = _value(y, fields, outputs, "")
    if x is None or y is None:
        return None
    tests = {
        "==": lambda: x == y, "!=": lambda: x != y, "<": lambda: x < y, "<=": lambda: x <= y, ">": lambda: x > y, ">=": lambda: x >= y,
        "between": lambda: y[0] <= x <= y[1], "contains": lambda: y in x, "starts with": lambda: x.startswith(y),
        "ends with": lambda: x.endswith(y), "matches": lambda: re.search(y, x) is not None,
    }
    return tests[op]()


def _value(part: Any, fields: dict, outputs: dict, name: str) -> Any:
    if not isinstance(part, dict):
        return part
    if set(part) == {"field"}:
        return fields[part["field"]]
    if set(part) == {"output"}:
        return outputs[part["output"]]
    if "condition" in part:
        return bool(_holds(part["condition"], fields, outputs))
    if "if" in part:
        return _value(part["then"] if _holds(part["if"], fields, outputs) else part.get("else"), fields, outputs, name)
    if "template" in part:
        both = fields | outputs
        return re.sub(r"\{(\w+)\}", lambda m: "" if both[m[1]] is None else coerce_value(both[m[1]], "string"), part["template"])
    if "list" in part:
        return [_value(p, fields, outputs, name) for p in part["list"]]
    if "object" in part:
        return {k: _value(p, fields, outputs, name) for k, p in part["object"].items()}
    (op, args), = part.items()
    numbers = [coerce_value(_value(p, fields, outputs, name), "number") for p in args]
    if None in numbers:
        return None
    if op in ("min", "max"):
        return min(numbers) if op == "min" else max(numbers)
    out = numbers[0]
    for n in numbers[1:]:
        if op == "divide" and n == 0:
            raise _Failed(f"{name}: division by zero")
        out = out + n if op == "add" else out - n if op == "subtract" else out * n if op == "multiply" else out / n
    return out
