"""Rule sets that the queries and tests use."""

from __future__ import annotations

from .plans.rules import Field, Output, Rule, RuleSet


def triage(insider: str = "insider_activity") -> RuleSet:
    """Incident triage: priority tiers, whether to report, a risk score, and why."""
    fields = lambda op, name, value: {"field": name, "op": op, "value": value}
    return RuleSet(
        "triage",
        [Field("incident_type"), Field("financial_impact", "number"), Field("customer_harm", "boolean"), Field("parties_affected", "number"), Field("days_open", "number")],
        [Output("priority"), Output("reportable", "boolean"), Output("risk_score", "number"), Output("rationale")],
        [
            Rule({"any": [fields(">", "financial_impact", 5_000_000), fields("==", "incident_type", insider)]}, {"priority": "P1"}),
            Rule({"any": [fields(">", "financial_impact", 1_000_000), {"all": [fields("==", "customer_harm", True), fields(">", "parties_affected", 1000)]}]}, {"priority": "P2"}),
            Rule({"any": [fields(">", "financial_impact", 100_000), fields("==", "customer_harm", True)]}, {"priority": "P3"}),
        ],
        default={"priority": "P4"},
        derived={
            "reportable": {"condition": {"any": [
                {"output": "priority", "op": "in", "value": ["P1", "P2"]},
                {"all": [fields("<=", "days_open", 30), fields("==", "customer_harm", True)]},
            ]}},
            "risk_score": {"min": [100, {"add": [{"divide": [{"field": "financial_impact"}, 200_000]}, {"multiply": [20, {"field": "customer_harm"}]}]}]},
            "rationale": {"template": "tier {priority} for {incident_type}"},
        },
    )


def screening() -> RuleSet:
    """Transactions: allow, review or block."""
    return RuleSet(
        "screening",
        [Field("kind"), Field("amount", "number")],
        [Output("action"), Output("fraud_score", "number"), Output("reason")],
        [
            Rule({"all": [{"field": "amount", "op": ">", "value": 300}, {"field": "kind", "op": "in", "value": ["purchase", "error"]}]}, {"action": "block"}),
            Rule({"any": [{"field": "amount", "op": "between", "value": [150, 300]}, {"all": [{"field": "kind", "op": "starts with", "value": "sign"}, {"not": {"field": "amount", "op": "<=", "value": 50}}]}]}, {"action": "review"}),
        ],
        default={"action": "allow"},
        derived={
            "fraud_score": {"min": [1, {"divide": [{"field": "amount"}, 400]}]},
            "reason": {"template": "{action} {kind}"},
        },
    )


def grid(n: int = 200) -> RuleSet:
    """A wide table: rule i wants a quantity of at least ``50 - i % 50`` and a price under ``1000 + 250 * i``."""
    return RuleSet(
        "grid",
        [Field("quantity", "number"), Field("price", "number")],
        [Output("cell", "number")],
        [
            Rule({"all": [{"field": "quantity", "op": ">=", "value": 50 - i % 50}, {"field": "price", "op": "<", "value": 1000 + 250 * i}]}, {"cell": i})
            for i in range(n)
        ],
        default={"cell": -1},
    )
