import os
from enum import Enum
from types import SimpleNamespace

import pytest

from tabulary import Field, Output, Registry, RuleEvaluator, RuleSet, SchemaInferenceError, evaluate_row, loader, outside_domain, read_definition, register_udf, solve
from tabulary.operators.batched import API_KEY, BASE_URL, Calls


class Kind(Enum):
    NUMBER = "number"


class Dumps:
    def __init__(self, **fields):
        self._fields = fields

    def model_dump(self):
        return self._fields


class Slotted:
    __slots__ = ("key", "type")

    def __init__(self, key, type):
        self.key, self.type = key, type


class Lazy:
    @property
    def response_schema(self):
        return (Slotted("level", "string"), Slotted("score", Kind.NUMBER))

    @property
    def broken(self):
        raise RuntimeError("not asked for")

    request_schema = [{"name": "x", "type": "number", "default": 3}]


DEFINITIONS = {
    "dict": {"requestSchema": [{"key": "x", "type": "number", "default": 3}], "responseSchema": [{"key": "level"}, {"key": "score", "type": "number"}, {"type": "string"}]},
    "snake": {"request_schema": [{"name": "x", "type": "number", "default": 3}], "response_schema": [{"name": "level", "type": None}, {"name": "score", "type": "number"}]},
    "object": SimpleNamespace(requestSchema=[SimpleNamespace(key="x", type="number", default=3)], responseSchema=[SimpleNamespace(key="level", type="string"), SimpleNamespace(key="score", type="number")]),
    "dump": Dumps(requestSchema=[Dumps(key="x", type="number", default=3)], responseSchema=[Dumps(key="level"), Dumps(key="score", type="number")]),
    "lazy": Lazy(),
}


@pytest.mark.parametrize("shape", DEFINITIONS)
def test_definitions_of_every_shape(shape):
    rule = read_definition(DEFINITIONS[shape], shape)
    assert rule.name == shape and rule.inputs == [Field("x", "number", 3)]
    assert rule.outputs == [Output("level"), Output("score", "number")]


class Store:
    def __init__(self, listed, definition=None):
        self.listed, self.definition, self.pulled = listed, definition, []

    def list(self):
        if isinstance(self.listed, Exception):
            raise self.listed
        return self.listed

    def pull(self, id):
        self.pulled.append(id)
        if isinstance(self.definition, Exception):
            raise self.definition
        return self.definition


ENTRY = [{"slug": "other", "id": 1}, SimpleNamespace(slug="r", id=0, name="a rule")]


@pytest.mark.parametrize("store,told", [
    (Store(OSError("no route")), "list of rules can't be read: OSError: no route"),
    (Store([]), "no rule is named r"), (Store(None), "no rule is named r"), (Store(SimpleNamespace(data=None)), "no rule is named r"),
    (Store([{"slug": "r"}]), "has no id for r"),
    (Store(ENTRY, KeyError("gone")), "definition of r can't be read: KeyError"),
    (Store(ENTRY, {}), "declares no outputs"), (Store(ENTRY, {"responseSchema": [{"type": "string"}]}), "declares no outputs"),
    (Store(ENTRY, "text"), "is no object"),
])
def test_what_keeps_a_definition_from_being_read(store, told):
    with pytest.raises(SchemaInferenceError, match=told):
        Registry(load=loader(store)).get("r")


class Given(RuleEvaluator):
    def evaluate(self, rule, rows):
        return [{"level": rule, "score": r["x"] * 2} for r in rows]


def test_a_stored_rule_is_pulled_once_and_solved(spark):
    store = Store(SimpleNamespace(data=ENTRY), DEFINITIONS["object"])
    rules = Registry(load=loader(store))
    df = spark.createDataFrame([(1, 2.0), (2, 5.0)], "id int, x double")
    for _ in range(2):
        got = solve(df, "r", rules=rules, evaluator=Given).orderBy("id").collect()
    assert [(r.level, r.score) for r in got] == [("r", 4.0), ("r", 10.0)] and store.pulled == [0]


def test_one_row():
    rule = RuleSet.from_dict({"inputs": [{"name": "x", "type": "number"}], "outputs": [{"name": "y", "type": "number"}], "default": {"y": {"add": [{"field": "x"}, 1]}}})
    assert evaluate_row(rule, {"x": "4"}) == {"y": 5.0}


class KeyOnly:
    def __init__(self, api_key):
        self.api_key = api_key


def test_settings_of_evaluators(monkeypatch):
    monkeypatch.delenv(API_KEY, raising=False)
    monkeypatch.delenv(BASE_URL, raising=False)
    start = lambda kind, **given: Calls("r", kind, (), **given).start()
    made = start(Given, api_key="k", base_url="http://a", timeout_seconds=5)
    assert (made.api_key, made.base_url, made.timeout_seconds) == ("k", "http://a", 5) and BASE_URL not in os.environ
    assert start(KeyOnly, api_key="k", base_url="http://b").api_key == "k" and os.environ[BASE_URL] == "http://b"
    monkeypatch.setenv(API_KEY, "from outside")
    made = start(Given)
    assert (made.api_key, made.base_url) == ("from outside", "http://b")
    monkeypatch.delenv(BASE_URL)


class Echo(RuleEvaluator):
    def evaluate(self, rule, rows):
        return [{"seen": None if r["big"] is None else str(r["big"])} for r in rows]


def test_sql_udf_keeps_large_integers_next_to_nulls(spark):
    register_udf(spark, "echo_big", "echo", evaluator=Echo, output_schema=RuleSet("echo", [], [Output("seen")]).schema)
    spark.createDataFrame([(1, 9007199254740993), (2, None)], "id int, big bigint").coalesce(1).createOrReplaceTempView("bigs")
    got = spark.sql("SELECT id, echo_big(struct(*)).seen AS seen FROM bigs ORDER BY id").collect()
    assert [r.seen for r in got] == ["9007199254740993", None]


def test_values_outside_their_domain(spark):
    rule = RuleSet("d", [Field("kind", values=("a", "b")), Field("n", "number", default=9, values=(1, 2)), Field("free"), Field("gone", values=("x",))], [Output("o")])
    df = spark.createDataFrame([("a", 1, "z"), ("c", 3, "z"), ("c", None, None), (None, 2, "z")], "k string, n int, free string")
    got = {(r.field, r.value): r.n for r in outside_domain(df, rule, {"k": "kind"}).collect()}
    assert got == {("kind", "c"): 2, ("n", "3"): 1, ("n", "9"): 1}
    assert outside_domain(df, RuleSet("d", [Field("free")], [Output("o")])).columns == ["field", "value", "n"]
    assert outside_domain(df, RuleSet("d", [], [Output("o")])).count() == 0
