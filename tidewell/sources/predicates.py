"""Filters as documents of the kind that remote job services take, and the same filters as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def equals(key: str, value: object) -> dict:
    return {"type": "equals", "key": key, "value": value}


def one_of(key: str, values: list) -> dict:
    return {"type": "in", "key": key, "values": [str(v) for v in values]}


def all_of(*parts: dict) -> dict:
    return {"type": "and", "predicates": list(parts)}


def any_of(*parts: dict) -> dict:
    return {"type": "or", "predicates": list(parts)}


def negated(part: dict) -> dict:
    return {"type": "not", "predicate": part}


def as_column(predicate: dict, columns: dict[str, str] | None = None) -> Column:
    """columns: names by key; a key without one is its own, in lower case."""
    kind = predicate["type"]
    if kind in ("and", "or"):
        parts = [as_column(p, columns) for p in predicate["predicates"]]
        return reduce((lambda a, b: a & b) if kind == "and" else (lambda a, b: a | b), parts, F.lit(kind == "and") if not parts else parts[0])
    if kind == "not":
        return ~as_column(predicate["predicate"], columns)
    if kind not in ("equals", "in"):
        raise ValueError(f"unknown predicate {kind}")
    c = F.col((columns or {}).get(predicate["key"], predicate["key"].lower()))
    if kind == "equals":
        return c == F.lit(predicate["value"])
    return c.cast("string").isin(*map(str, predicate["values"]))
