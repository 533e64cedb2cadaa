"""Node expressions, compiled to Columns over tagged scalars."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import literals as L

Lookup = Callable[[str], Column]
#: Kinds of node. Fixed values.
KINDS = ("focus", "literal", "path", "exists", "if", "concat", "coalesce")


def is_node(x: Any) -> bool:
    return isinstance(x, dict) and isinstance(x.get("type"), str)


def present(v: Column) -> Column:
    """False for no value, empty text and false; any number is present."""
    return F.coalesce(F.when(v["kind"] == "s", F.length(v["s"]) > 0).when(v["kind"] == "b", v["b"]).otherwise(v.isNotNull()), F.lit(False))


def constant(x: Any) -> Column:
    if isinstance(x, bool):
        return L.flag_value(F.lit(x))
    if isinstance(x, int | float):
        return L.number_value(F.lit(float(x)))
    return L.no_value() if x is None else L.text_value(F.lit(x))


def compile_node(node: dict, focus: Column, lookup: Lookup) -> Column:
    """The Column of a node. focus is the value at hand, lookup gives that of a predicate."""
    again = lambda x: compile_node(x, focus, lookup)
    match node:
        case {"type": "focus"}:
            return focus
        case {"type": "literal"}:
            return constant(node.get("value"))
        case {"type": "path", "predicate": predicate}:
            return lookup(predicate)
        case {"type": "exists", "expr": inner}:
            return L.flag_value(present(again(inner)))
        case {"type": "if", "cond": cond, "then": then}:
            return F.when(present(again(cond)), again(then)).otherwise(again(node["else"]) if node.get("else") else L.no_value())
        case {"type": "concat", "args": args}:
            texts = [L.value_text(again(x)) for x in args]
            if not texts:
                return L.no_value()
            return L.text_value(F.when(F.coalesce(*texts).isNotNull(), F.concat(*[F.coalesce(t, F.lit("")) for t in texts])))
        case {"type": "coalesce", "args": args}:
            values = [again(x) for x in args]
            return F.coalesce(*[F.when((v["kind"] != "s") | (v["s"] != ""), v) for v in values], L.no_value())
    raise ValueError(f"unknown node: {node!r}")
