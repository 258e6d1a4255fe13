"""Operators: applying rules natively, by evaluator calls, and from SQL."""

from .batched import RuleEvaluator
from .domain import outside_domain
from .solve import ERROR_COLUMN, solve
from .sql_function import local_evaluator, register_native, register_udf

__all__ = ["ERROR_COLUMN", "RuleEvaluator", "local_evaluator", "outside_domain", "register_native", "register_udf", "solve"]
