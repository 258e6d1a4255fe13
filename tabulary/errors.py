"""Exceptions of the rule engine."""


class RuleEngineError(Exception):
    """Base of all errors that this package raises."""


class SchemaConflictError(RuleEngineError):
    """An output would replace a column and ``on_conflict`` is ``error``."""


class SchemaInferenceError(RuleEngineError):
    """A rule's outputs can't be told from what is known about it."""


class RuleExecutionError(RuleEngineError):
    """A rule failed and ``on_error`` is ``raise``. On executors Spark wraps it."""
