"""Reading a subset of Turtle into triples.

The subset has @prefix lines, IRIs in angle brackets, prefixed names, double-quoted literals with a datatype, `a`, and lists
of properties and objects. The nine usual prefixes are known undeclared. A statement that cannot be read is left at the next
full stop, wherever that stands. IRIs that start with #, ./ or ../ are put behind the base as they are, and <> is the base.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import PREFIXES, RDF_TYPE
from ..functions.uris import prefix_block
from ..schema import TRIPLES

_SPACE = "\\t\\n\\x0b\\x0c\\r \\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000\\ufeff"
_SKIP = re.compile(r"(?:[ \t\n\r]|#[^\n]*)*")
_TYPE = re.compile(f"a(?=[{_SPACE};.,]|\\Z)")
_IRI = re.compile(r"<([^>]*)>?")
_NAME = re.compile(f"[^{_SPACE};.,\\])]+")
_TEXT = re.compile(r'"((?:[^"\\]|\\.|\\\Z)*)"?', re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)
_PREFIX = re.compile(r"@prefix(?:[ \t\n\r]|#[^\n]*)*([^:]*):?(?:[ \t\n\r]|#[^\n]*)*(?:.([^>]*)>?)?(?:[ \t\n\r]|#[^\n]*)*\.?", re.S)
_DECODED = {"n": "\n", "t": "\t"}

#: What rdf.to_turtle() writes: its head, a subject, and a predicate with its object and what follows it.
_HEAD = prefix_block() + "\n\n"
_SUBJECT = re.compile(r"<([^>]*)> ")
_PAIR = re.compile(r'(a|[a-z0-9]+:[A-Za-z]+|<[^>]*>) (?:<([^>]*)>|"([^"\\]*(?:\\.[^"\\]*)*)"(?:\^\^[a-z0-9]+:[A-Za-z]+)?|([a-z0-9]+:[A-Za-z]+))( ;\n    | \.\n\n| \.\Z)', re.S)


class Triple(NamedTuple):
    subject: str
    predicate: str
    object: str
    object_is_literal: bool
    object_datatype: str | None


class _Reader:
    def __init__(self, text: str, base: str):
        self.text, self.base, self.at = text, base, 0
        self.prefixes = dict(PREFIXES)

    def skip(self) -> str:
        """Pass white space and comments; the next character, empty at the end."""
        self.at = _SKIP.match(self.text, self.at).end()
        return self.text[self.at : self.at + 1]

    def take(self, pattern: re.Pattern):
        if found := pattern.match(self.text, self.at):
            self.at = found.end()
        return found

    def term(self, base: str) -> str | None:
        self.skip()
        if self.take(_TYPE):
            return RDF_TYPE
        if found := self.take(_IRI):
            iri = found[1]
            return base + iri if iri == "" or iri.startswith(("#", "./", "../")) else iri
        if not (found := self.take(_NAME)):
            return None
        prefix, colon, local = found[0].partition(":")
        return self.prefixes[prefix] + local if colon and self.prefixes.get(prefix) else found[0]

    def object(self) -> tuple[str, bool, str | None] | None:
        self.skip()
        if found := self.take(_TEXT):
            value = _ESCAPE.sub(lambda m: _DECODED.get(m[1], m[1]), found[1])
            datatype = None
            if self.text.startswith("^^", self.at):
                self.at += 2
                datatype = self.term("")
            return value, True, datatype
        term = self.term(self.base)
        return (term, False, None) if term else None

    def give_up(self) -> None:
        stop = self.text.find(".", self.at)
        self.at = len(self.text) if stop < 0 else stop + 1

    def statement(self):
        start = self.at
        subject = self.term(self.base)
        if subject is None:
            self.at = max(self.at, start + 1)
            return
        while mark := self.skip():
            if mark == ".":
                self.at += 1
                return
            if mark == ";":
                self.at += 1
                continue
            predicate = self.term(self.base)
            found = None if predicate is None else self.object()
            if found is None:
                self.give_up()
                return
            yield Triple(subject, predicate, *found)
            while self.skip() == ",":
                self.at += 1
                if (found := self.object()) is None:
                    break
                yield Triple(subject, predicate, *found)

    def triples(self):
        while self.skip():
            if self.text.startswith("@prefix", self.at):
                found = self.take(_PREFIX)
                self.prefixes[found[1].strip()] = found[2] or ""
            else:
                yield from self.statement()


def parse(text: str, base: str = "") -> list[Triple]:
    return list(_Reader(text, base).triples())


def parse_with_prefixes(text: str, base: str = "") -> tuple[dict[str, str], list[Triple]]:
    reader = _Reader(text, base)
    out = list(reader.triples())
    return reader.prefixes, out


def _full(iri: str, base: str) -> str:
    return base + iri if iri == "" or iri.startswith(("#", "./", "../")) else iri


def _named(name: str) -> str:
    prefix, _, local = name.partition(":")
    return PREFIXES[prefix] + local if PREFIXES.get(prefix) else name


def read_written(text: str, base: str = "") -> list[tuple[str, str, str]] | None:
    """Subject, predicate and object of each triple that parse() finds, a match for each; None for a text that is not
    in the very form that rdf.to_turtle() writes, which is for parse() to read."""
    if not text.startswith(_HEAD):
        return None
    out, at, end, subject, names = [], len(_HEAD), len(text), None, {"a": RDF_TYPE}
    while at < end:
        if subject is None:
            if not (found := _SUBJECT.match(text, at)):
                return None
            subject, at = _full(found[1], base), found.end()
        if not (found := _PAIR.match(text, at)):
            return None
        name, iri, value, short, stop = found.groups()
        if (predicate := names.get(name)) is None:
            predicate = names[name] = _full(name[1:-1], base) if name[0] == "<" else _named(name)
        if iri is not None:
            object = _full(iri, base)
            if object == "":  # no object, for which parse() gives the statement up
                return None
        elif value is not None:
            object = _ESCAPE.sub(lambda m: _DECODED.get(m[1], m[1]), value) if "\\" in value else value
        else:
            object = _named(short)
        out.append((subject, predicate, object))
        at = found.end()
        if stop != " ;\n    ":
            subject = None
    return out if subject is None else None


def parse_turtle(docs: DataFrame) -> DataFrame:
    """Triples (doc, ord, ...) of docs(doc, turtle); doc is the base. A null text has none."""

    def run(batches):
        for batch in batches:
            rows = [(doc, i, *t) for doc, text in zip(batch.column("doc").to_pylist(), batch.column("turtle").to_pylist(), strict=True) for i, t in enumerate(parse(text or "", doc or ""))]
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=TRIPLES.names)

    return docs.select("doc", "turtle").mapInArrow(run, TRIPLES)


def register(spark: SparkSession, name: str = "parse_turtle") -> None:
    """parse_turtle(text, base) as a table function for SQL."""

    @F.udtf(returnType="ord int, subject string, predicate string, object string, object_is_literal boolean, object_datatype string")
    class ParseTurtle:
        def eval(self, text: str, base: str):
            for i, t in enumerate(parse(text or "", base or "")):
                yield (i, *t)

    spark.udtf.register(name, ParseTurtle)
