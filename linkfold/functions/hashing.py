"""Content addresses. Every function takes the hash as a function from Column to Column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Hash = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


#: Control characters whose escapes in JSON have a letter in them: these are written in lower case by those who hash it.
_LETTERED = [0x0B, 0x0E, 0x0F, *range(0x1A, 0x20)]


def _json(build: Callable[[Callable[[Column], Column]], Column], texts: list[Column]) -> Column:
    """to_json() of what build(clean) makes of texts, with lower-case escapes of control characters.

    clean() puts a noncharacter in the place of such a character, so that it can be told from a backslash in the text.
    """
    away, stand = "".join(map(chr, _LETTERED)), "".join(chr(0xFDD0 + c) for c in _LETTERED)
    plain = F.to_json(build(lambda c: c))
    safe = F.to_json(build(lambda c: F.translate(c, away, stand)))
    for c in _LETTERED:
        safe = F.replace(safe, F.lit(chr(0xFDD0 + c)), F.lit(f"\\u{c:04x}"))
    odd = F.concat_ws("", *texts).rlike("[\\x0B\\x0E\\x0F\\x1A-\\x1F]")
    return F.when(odd, safe).otherwise(plain)


def link_hash(source="source", predicate="predicate", target="target", author="author", timestamp="timestamp", hash: Hash = sha256) -> Column:
    """Identity of a link in the fold: a JSON array in which missing parts are null. The proof is no part of it."""
    parts = [*map(_col, (source, predicate, target, author, timestamp))]
    return hash(_json(lambda clean: F.array(*map(clean, parts)), parts))


def content_hash(source="source", predicate="predicate", target="target", hash: Hash = sha256) -> Column:
    """Identity of what a link says, whoever said it when; missing parts are empty."""
    parts = {k: F.coalesce(_col(c), F.lit("")) for k, c in (("source", source), ("predicate", predicate), ("target", target))}
    return hash(_json(lambda clean: F.struct(*[clean(c).alias(k) for k, c in parts.items()]), [*parts.values()]))


def content_key(source="source", predicate="predicate", target="target", author="author", timestamp="timestamp") -> Column:
    """The readable key of a link, by which its node is named."""
    return F.concat_ws(":", *[F.coalesce(_col(c), F.lit("")) for c in (source, predicate, target, author, timestamp)])


def commit_canonical(additions, removals, previous, author="author", timestamp="timestamp") -> Column:
    """The text that a commit is hashed by. additions and removals are arrays of link hashes; all arrays are sorted, with
    whatever stands in them twice."""
    lists = {"additions": additions, "removals": removals, "previous": previous}
    fields = [F.array_sort(F.coalesce(_col(c), F.array().cast("array<string>"))).alias(k) for k, c in lists.items()]
    texts = {k: F.coalesce(_col(c), F.lit("")) for k, c in (("author", author), ("timestamp", timestamp))}
    return _json(lambda clean: F.struct(*fields, *[clean(c).alias(k) for k, c in texts.items()]), [*texts.values()])


def commit_hash(additions, removals, previous, author="author", timestamp="timestamp", hash: Hash = sha256) -> Column:
    return hash(commit_canonical(additions, removals, previous, author, timestamp))


def revision(heads, hash: Hash = sha256) -> Column:
    """Of an array of head hashes: null for none, the head for one, a digest of the sorted set for more."""
    distinct = F.array_sort(F.array_distinct(_col(heads)))
    return F.when(F.size(distinct) == 1, F.element_at(distinct, 1)).when(F.size(distinct) > 1, hash(F.to_json(distinct)))
