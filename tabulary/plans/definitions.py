"""Rule sets from wherever their definitions are kept."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any, Protocol

from ..errors import SchemaInferenceError
from ..functions.shapes import plain
from .rules import RuleSet

_INSTEAD = "an output_schema given to solve needs no definition"


class DefinitionStore(Protocol):
    """Where definitions are kept: a folder, a table, a service."""

    def list(self) -> Any:
        """Entries with a ``slug`` or ``name`` and an ``id``: a list, or an object whose ``data`` is one."""

    def pull(self, id: Any) -> Any:
        """A definition: dicts, or objects with such attributes, or that dump themselves."""


@contextmanager
def _told(what: str) -> Iterator[None]:
    """Whatever fails inside is a SchemaInferenceError that says what was tried."""
    try:
        yield
    except SchemaInferenceError:
        raise
    except Exception as error:
        raise SchemaInferenceError(f"{what}: {type(error).__name__}: {error}; {_INSTEAD}") from error


def read_definition(definition: Any, name: str | None = None) -> RuleSet:
    """A rule set from a definition of any shape; without rules of its own it tells inputs and outputs, for an evaluator."""
    data = plain(definition)
    if not isinstance(data, dict):
        raise SchemaInferenceError(f"{name or 'a definition'} is no object but {type(definition).__name__}")
    return RuleSet.from_dict(data | {"name": name} if name else data)


def loader(store: DefinitionStore) -> Callable[[str], RuleSet]:
    """What a :class:`Registry` loads unknown names with: ``Registry(load=loader(store))``.

    A store that fails, a name or id that is not there, and a definition
    without outputs are each a SchemaInferenceError that says so.
    """

    def load(name: str) -> RuleSet:
        with _told("the list of rules can't be read"):
            listed = plain(store.list())
        entries = listed.get("data") if isinstance(listed, dict) else listed
        same = [e for e in entries or [] if isinstance(e, dict)]
        entry = next((e for key in ("slug", "name") for e in same if e.get(key) == name), None)
        if entry is None:
            raise SchemaInferenceError(f"no rule is named {name}; {_INSTEAD}")
        if entry.get("id") in (None, ""):
            raise SchemaInferenceError(f"the list of rules has no id for {name}; {_INSTEAD}")
        with _told(f"the definition of {name} can't be read"):
            return read_definition(store.pull(entry["id"]), name)

    return load
