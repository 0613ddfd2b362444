"""Compiled contracts against a plain validator of the same rules."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from barloom.functions import contracts

SIGNALS = {
    "$schema": "https://json-schema.org/draft/2020-12/schema", "type": "object", "required": ["date", "stocks"], "additionalProperties": False,
    "properties": {
        "date": {"type": "string", "pattern": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"}, "version": {"type": ["integer", "null"], "minimum": 1},
        "stocks": {"type": "array", "minItems": 1, "maxItems": 3, "items": {
            "type": "object", "required": ["ticker", "score"], "properties": {
                "ticker": {"type": "string", "minLength": 1, "maxLength": 5}, "score": {"type": "number", "minimum": 0, "maximum": 100}, "rating": {"enum": ["BUY", "HOLD", "SELL", None, 1]},
                "notes": {"type": "array", "items": {"type": "object", "required": ["text"], "properties": {"text": {"type": "string"}, "weight": {"exclusiveMinimum": 0, "exclusiveMaximum": 1}}}},
            }}},
    },
}


def plain(x, c, at="$"):
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    number = isinstance(x, (int, float)) and not isinstance(x, bool)
    fits = lambda t: number if t == "number" else number and float(x) % 1 == 0 if t == "integer" else isinstance(x, kinds[t])
    out = []
    if "type" in c:
        names = [c["type"]] if isinstance(c["type"], str) else c["type"]
        out += [] if any(map(fits, names)) else [f"{at}: is not of type {' or '.join(names)}"]
    if "enum" in c and json.dumps(x) not in [json.dumps(e) for e in c["enum"]]:
        out.append(f"{at}: is not one of {', '.join(map(json.dumps, c['enum']))}")
    for k, bad, words in (("minimum", lambda b: x < b, "is less than"), ("maximum", lambda b: x > b, "is greater than"), ("exclusiveMinimum", lambda b: x <= b, "is not above"), ("exclusiveMaximum", lambda b: x >= b, "is not below")):
        if k in c and number and bad(c[k]):
            out.append(f"{at}: {words} {c[k]}")
    for k, bad, words in (("minLength", lambda b: len(x) < b, "is shorter than"), ("maxLength", lambda b: len(x) > b, "is longer than"), ("pattern", lambda b: not re.search(b, x), "does not match")):
        if k in c and isinstance(x, str) and bad(c[k]):
            out.append(f"{at}: {words} {c[k]}")
    if isinstance(x, dict):
        out += [f"{at}: lacks {n}" for n in c.get("required", []) if n not in x]
        for n, part in c.get("properties", {}).items():
            out += plain(x[n], part, f"{at}.{n}") if n in x else []
        if c.get("additionalProperties") is False:
            out += [f"{at}: has {n}" for n in sorted(x) if n not in c.get("properties", {})]
    if isinstance(x, list):
        out += [f"{at}: has {len(x)} items, fewer than {c['minItems']}"] if len(x) < c.get("minItems", 0) else []
        out += [f"{at}: has {len(x)} items, more than {c['maxItems']}"] if len(x) > c.get("maxItems", 99) else []
        for n, e in enumerate(x if "items" in c else []):
            out += plain(e, c["items"], f"{at}[{n}]")
    return out


def test_against_a_plain_validator(spark):
    r = random.Random(3)
    value = lambda: r.choice([None, True, 0, 1, 3.0, 0.5, -2, 101, "", "BUY", "LONGER", "2024-01-02", [], {}, "été"])
    note = lambda: r.choice([{"text": "x", "weight": r.choice([0, 0.5, 1, "1"])}, {"weight": 2}, value()])
    stock = lambda: r.choice([{"ticker": r.choice(["A", "TOOLONG", value()]), "score": r.choice([50, 100.5, value()]), "rating": value(), "notes": [note() for _ in range(r.randrange(3))]}, {"score": value()}, value()])
    docs = [{k: x for k, x in {"date": r.choice(["2024-01-02", value()]), "version": value(), "stocks": r.choice([[stock() for _ in range(r.randrange(5))], value()]), "extra": 1, "another one": 2}.items() if r.random() < 0.8} for _ in range(150)] + [[], "x", 3, None]
    rows = [(n, json.dumps(d, ensure_ascii=False)) for n, d in enumerate(docs)]
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (902, '{"date": '), (903, "{} {}"), (904, "1] [2"), (905, '1} {"b": 2'), (906, "1, 2"), (907, " ")], "id int, doc string")
    got = {x["id"]: x["warnings"] for x in contracts.validated(df, "doc", SIGNALS).collect()}
    for n, d in enumerate(docs):
        assert got[n] == plain(d, SIGNALS), d
    assert all(got[n] == ["$: is not a document"] for n in range(900, 908))
    first = contracts.validated(df, "doc", SIGNALS, keep=2).where("id < 150")
    assert first.where("size(warnings) > 2 or size(warnings) > n_warnings").count() == 0 and first.agg(F.sum("n_warnings")).first()[0] == sum(len(plain(d, SIGNALS)) for d in docs[:150])


def test_what_a_contract_cannot_say_is_refused():
    with pytest.raises(ValueError, match=r"\$\.a\[\]: oneOf"):
        contracts.compiled(None, {"properties": {"a": {"items": {"oneOf": []}}}})


def test_a_value_is_taken_out_of_its_document_once(spark):
    """Each check took its value out of the document anew, at each depth all those above it, too: the expression of three levels had hundreds of such steps."""
    deep = {"type": "object", "required": ["a"], "properties": {"a": {"type": "object", "required": ["b"], "properties": {"b": {"type": "object", "required": ["c"], "properties": {"c": {"type": "integer", "minimum": 2, "maximum": 5}}}}}}}
    df = spark.createDataFrame([('{"a": {"b": {"c": 1}}}',), ('{"a": {"b": {}}}',)], "doc string")
    got = df.select(contracts.compiled(F.col("doc"), deep).alias("w"))
    assert [r["w"] for r in got.collect()] == [["$.a.b.c: is less than 2"], ["$.a.b: lacks c"]]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("parse_?json", plan, re.I)) == 2 and len(re.findall("schema_?of_?variant", plan, re.I)) <= 8  # 24 and 26 before
