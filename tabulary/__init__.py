"""Decision-table engine and data-preparation operators on PySpark DataFrames."""

from .errors import RuleEngineError, RuleExecutionError, SchemaConflictError, SchemaInferenceError
from .operators import RuleEvaluator, outside_domain, register_native, register_udf, solve
from .plans.definitions import DefinitionStore, loader, read_definition
from .plans.local import evaluate_row
from .plans.rules import Field, Output, Registry, Rule, RuleSet, registry

__version__ = "0.1.0"

__all__ = [
    "DefinitionStore", "Field", "Output", "Registry", "Rule", "RuleEngineError", "RuleEvaluator", "RuleExecutionError", "RuleSet",
    "SchemaConflictError", "SchemaInferenceError", "evaluate_row", "loader", "outside_domain", "read_definition", "register_native", "register_udf", "registry", "solve", "__version__",
]
