"""JSON Schema contracts compiled to expressions over VARIANT: a document's warnings in one projection."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Type names of `schema_of_variant` by the contract's type.
_TYPES = {"object": ("OBJECT",), "array": ("ARRAY",), "string": ("STRING",), "boolean": ("BOOLEAN",), "null": ("VOID",), "number": ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "integer": ("BIGINT",)}
_KNOWN = {"type", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum", "minLength", "maxLength", "pattern", "required", "properties", "items", "minItems", "maxItems", "additionalProperties"}
_NOTES = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}


def _path(name: str) -> str:
    return f"$['{name}']"


def _unsupported(contract: dict, at: str = "$") -> list[str]:
    found = [f"{at}: {k}" for k in contract if k not in _KNOWN | _NOTES]
    if not isinstance(contract.get("additionalProperties", True), bool):
        found.append(f"{at}: additionalProperties as a contract")
    for name, part in contract.get("properties", {}).items():
        found += _unsupported(part, f"{at}.{name}")
    return found + (_unsupported(contract["items"], f"{at}[]") if "items" in contract else [])


def _literal(x) -> str:  # noqa: ANN001
    """A value of a contract as the JSON text that `to_json` of an equal variant gives."""
    import json

    return json.dumps(x, ensure_ascii=False, separators=(",", ":"))


def _let(value: Column, then) -> Column:  # noqa: ANN001
    """then(value), with the value computed once however often it is used there, and only where this is."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _warnings(v: Column, contract: dict, at: Column) -> Column:
    """Array of warnings for a variant that is there."""
    return _let(F.schema_of_variant(v), lambda kind: _found(v, kind, contract, at))


def _found(v: Column, kind: Column, contract: dict, at: Column) -> Column:
    """The warnings of a variant of the kind that `schema_of_variant` gives."""
    is_a = lambda names: F.coalesce(reduce(or_, [F.startswith(kind, F.lit(x)) for n in names for x in _TYPES[n]]), F.lit(False))
    say = lambda broken, text: F.when(broken, F.array(F.concat(at, F.lit(f": {text}"))))
    found: list[Column] = []
    allowed = contract.get("type")
    if allowed is not None:
        names = [allowed] if isinstance(allowed, str) else list(allowed)
        fits = is_a(names)
        if "integer" in names and "number" not in names:  # 3.0 is a whole number, too
            fits = fits | (is_a(["number"]) & (F.try_variant_get(v, "$", "double") % 1 == 0))
        found.append(say(~fits, f"is not of type {' or '.join(names)}"))
    if "enum" in contract or "const" in contract:
        values = contract.get("enum", [contract.get("const")])
        found.append(say(~F.to_json(v).isin([_literal(x) for x in values]), f"is not one of {', '.join(map(_literal, values))}"))
    number, text = F.try_variant_get(v, "$", "double"), F.try_variant_get(v, "$", "string")
    for key, broken, words in (
        ("minimum", lambda x: number < x, "is less than"), ("maximum", lambda x: number > x, "is greater than"), ("exclusiveMinimum", lambda x: number <= x, "is not above"), ("exclusiveMaximum", lambda x: number >= x, "is not below"),
    ):
        if key in contract:
            found.append(say(is_a(["number"]) & broken(float(contract[key])), f"{words} {contract[key]}"))
    for key, broken, words in (
        ("minLength", lambda x: F.length(text) < x, "is shorter than"), ("maxLength", lambda x: F.length(text) > x, "is longer than"), ("pattern", lambda x: ~F.rlike(text, F.lit(x)), "does not match"),
    ):
        if key in contract:
            found.append(say(is_a(["string"]) & broken(contract[key]), f"{words} {contract[key]}"))
    field = lambda name: F.try_variant_get(v, _path(name), "variant")
    for name in contract.get("required", []):
        found.append(say(is_a(["object"]) & field(name).isNull(), f"lacks {name}"))
    for name, part in contract.get("properties", {}).items():
        found.append(F.when(is_a(["object"]), _let(field(name), _field(part, F.concat(at, F.lit(f".{name}"))))))
    if contract.get("additionalProperties") is False:
        names = F.map_keys(F.when(is_a(["object"]), F.try_variant_get(v, "$", "map<string, variant>")))
        more = F.filter(names, lambda n: ~n.isin(list(contract.get("properties", {}))))
        found.append(F.transform(F.array_sort(more), lambda n: F.concat(at, F.lit(": has "), n)))
    if {"items", "minItems", "maxItems"} & contract.keys():
        items = F.when(is_a(["array"]), F.try_variant_get(v, "$", "array<variant>"))
        found.append(_let(items, lambda x: _listed(x, contract, at)))
    return _joined(found)


def _field(contract: dict, at: Column):  # noqa: ANN202
    return lambda x: F.when(x.isNotNull(), _warnings(x, contract, at))


def _listed(items: Column, contract: dict, at: Column) -> Column:
    """The warnings of an array's number of items and of each of them; none for what is no array."""
    found = []
    for key, broken, words in (("minItems", lambda x: F.size(items) < x, "items, fewer than"), ("maxItems", lambda x: F.size(items) > x, "items, more than")):
        if key in contract:
            found.append(F.when(items.isNotNull() & broken(contract[key]), F.array(F.concat(at, F.lit(": has "), F.size(items).cast("string"), F.lit(f" {words} {contract[key]}")))))
    if "items" in contract:
        found.append(F.flatten(F.transform(items, lambda x, n: _warnings(x, contract["items"], F.concat(at, F.lit("["), n.cast("string"), F.lit("]"))))))
    return _joined(found)


def _joined(found: list[Column]) -> Column:
    none = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(f, none) for f in found]) if found else none


def compiled(document: Column, contract: dict) -> Column:
    """The warnings of a JSON text under a contract, in the contract's order: a path and what is wrong there.

    type, enum, const, bounds, lengths, pattern, required, properties, additionalProperties (yes or no), items and their number are compiled, to any depth; a contract that says more is refused, so that nothing is passed
    over in silence. A text that is no JSON, or null, has the one warning `$: is not a document`. A field of JSON null is there; of a repeated field the parser decides. Numbers count by value, so 3.0 is an integer."""
    if more := _unsupported(contract):
        raise ValueError(f"not supported: {'; '.join(more)}")
    # the parser stops at a document's end: within brackets and within braces what follows it is an error
    v = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), document, F.lit("]"))), "$", "array<variant>")
    whole = F.try_parse_json(F.concat(F.lit('{"":'), document, F.lit("}"))).isNotNull()
    bad = F.array(F.lit("$: is not a document"))
    return _let(v, lambda v: F.when(F.coalesce((F.size(v) == 1) & whole, F.lit(False)), _warnings(F.get(v, F.lit(0)), contract, F.lit("$"))).otherwise(bad))


def validated(df: DataFrame, document: str, contract: dict, out: str = "warnings", keep: int | None = None) -> DataFrame:
    """df with the warnings of each row's document; with `keep` only so many of the first ones, and always their number in `n_<out>`."""
    found = df.withColumn(out, compiled(F.col(document), contract))
    found = found.withColumn(f"n_{out}", F.size(out))
    return found if keep is None else found.withColumn(out, F.slice(out, 1, keep))
