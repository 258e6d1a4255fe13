"""Fields of results and definitions, whatever objects a client library makes of them."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from enum import Enum
from typing import Any


def _told_by(method: str) -> Callable[[Any], Any]:
    """What an object says of itself by a method of that name; nothing if it has none or it fails."""

    def ask(item: Any) -> Any:
        try:
            return getattr(item, method)()
        except Exception:  # noqa: BLE001  objects of any library
            return None

    return ask


def _attributes(item: Any) -> Any:
    known = getattr(item, "__dict__", None)
    return known and {k: v for k, v in known.items() if k[:1] != "_"}


def _visible(item: Any) -> dict[str, Any]:
    """Attributes of the class and properties as well, but no methods."""
    found = {}
    for name in dir(item):
        if name[:1] != "_":
            try:
                value = getattr(item, name)
            except Exception:  # noqa: BLE001  a property may fail
                continue
            if not callable(value):
                found[name] = value
    return found


#: Ways to read an object's fields; the first that gives a mapping counts.
FIELD_WAYS: tuple[Callable[[Any], Any], ...] = (lambda item: item, _told_by("model_dump"), _told_by("dict"), _attributes)


def fields_of(item: Any) -> Mapping | None:
    """An object's fields, by name; None for what has none."""
    return next((got for got in (way(item) for way in FIELD_WAYS) if isinstance(got, Mapping)), None)


def plain(item: Any) -> Any:
    """Nested objects as dicts, lists and plain values."""
    if isinstance(item, Enum):
        return plain(item.value)
    if item is None or isinstance(item, (str, bytes, bool, int, float)):
        return item
    if isinstance(item, (list, tuple, set, frozenset)):
        return [plain(x) for x in item]
    fields = fields_of(item)
    if fields is None or (not fields and not isinstance(item, Mapping)):
        fields = _visible(item)
    return {str(k): plain(v) for k, v in fields.items()}
