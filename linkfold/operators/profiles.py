"""Shapes: which links make up an instance, and how it is projected."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions.nodes import is_node


@dataclass(frozen=True)
class Flag:
    path: str
    value: str

    @property
    def is_literal(self) -> bool:
        return self.value.startswith("literal:")


@dataclass(frozen=True)
class Field:
    name: str
    path: str
    datatype: str | None = None
    expression: dict | None = field(default=None, hash=False)


@dataclass(frozen=True)
class Profile:
    shape: str
    target_class: str
    native_type: str
    fields: tuple[Field, ...] = ()
    flags: tuple[Flag, ...] = ()
    author_field: str | None = None
    timestamp_field: str | None = None
    id_field: str | None = None


def decoded(target: str | None):
    """A literal URL as a Python value; anything else as it stands."""
    if target is None or not target.startswith("literal:"):
        return target
    kind, sep, body = target.removeprefix("literal://" if target.startswith("literal://") else "literal:").partition(":")
    if not sep:
        return target
    if kind == "string":
        return unquote(body)
    if kind == "json":
        return json.loads(unquote(body))
    if kind == "boolean":
        return unquote(body) == "true"
    if kind == "number":
        return float(body)
    return target


def text_of(target: str | None) -> str | None:
    value = decoded(target)
    return value if isinstance(value, str) or target is None else target


def expression_of(target: str | None) -> dict | None:
    value = decoded(target)
    if isinstance(value, str):
        try:
            value = json.loads(value)
        except ValueError:
            return None
    return value if is_node(value) else None


def shape_links(links: DataFrame) -> DataFrame:
    """The links of a table that shapes are made of; few, whatever the table's size."""
    predicates = [C.NATIVE_TYPE, C.AUTHOR_FIELD, C.TIMESTAMP_FIELD, C.ID_FIELD, C.FIELD, C.EXPRESSION, C.TARGET_CLASS, C.PROPERTY, C.PATH, C.DATATYPE, C.HAS_VALUE]
    return links.filter(F.col("predicate").isin(*predicates))


def parse_profiles(rows: Iterable[tuple[str, str, str]]) -> list[Profile]:
    """Profiles of (source, predicate, target) rows, in order of first appearance of their shapes.

    A shape with a native type is a profile. A property with a fixed value is a flag; one with a path and a field name is a
    field; any other is left out.
    """
    index: dict[str, dict[str, list[str]]] = {}
    for source, predicate, target in rows:
        index.setdefault(source, {}).setdefault(predicate, []).append(target)

    def one(source: str, predicate: str) -> str | None:
        return index.get(source, {}).get(predicate, [None])[0]

    out = []
    for shape in index:
        native = text_of(one(shape, C.NATIVE_TYPE))
        if not native:
            continue
        flags, fields = [], []
        for prop in index[shape].get(C.PROPERTY, []):
            path, value, name = one(prop, C.PATH), one(prop, C.HAS_VALUE), text_of(one(prop, C.FIELD))
            if path and value is not None:
                flags.append(Flag(path, value))
            elif path and name:
                fields.append(Field(name, path, one(prop, C.DATATYPE), expression_of(one(prop, C.EXPRESSION))))
        named = (text_of(one(shape, p)) for p in (C.AUTHOR_FIELD, C.TIMESTAMP_FIELD, C.ID_FIELD))
        out.append(Profile(shape, one(shape, C.TARGET_CLASS) or shape, native, tuple(fields), tuple(flags), *named))
    return out


def collect_profiles(links: DataFrame, order: str = "ord") -> list[Profile]:
    """Profiles of the shapes in a table of links."""
    rows = shape_links(links).orderBy(order).select("source", "predicate", "target").collect()
    return parse_profiles([tuple(r) for r in rows])


def by_native_type(profiles: list[Profile]) -> dict[str, Profile]:
    """The first profile of each native type."""
    return {p.native_type: p for p in reversed(profiles)}


def chat_profile(native_type: str, content_field: str = "body") -> Profile:
    """The profile of chat messages that carry no shape of their own. Its strings are fixed values."""
    return Profile(
        "flux://MessageShape",
        "flux://Message",
        native_type,
        (Field(content_field, "flux://body", C.XSD_STRING),),
        (Flag("flux://entry_type", "flux://has_message"),),
    )
