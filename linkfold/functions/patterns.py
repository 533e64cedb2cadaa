"""Classifying links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C


def _text(c) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def detect_pattern(source="source", predicate="predicate", target="target", chat: list[str] | None = None) -> Column:
    """struct(type, contentUri, parentUri, channelUri, mentionedAgent): the first rule that fits says what a link is."""
    s, p, t = map(_text, (source, predicate, target))

    def kind(name: str, **parts: Column) -> Column:
        return F.struct(F.lit(name).alias("type"), *[parts.get(k, F.lit(None).cast("string")).alias(k) for k in ("contentUri", "parentUri", "channelUri", "mentionedAgent")])

    chats = C.CHAT if chat is None else chat
    return (
        F.when((p != "") & p.isin(*chats) if chats else F.lit(False), kind("chat-message", contentUri=t, channelUri=s))
        .when(p.isin(*C.REPLY), kind("reply", contentUri=t, parentUri=s))
        .when(F.contains(F.lower(p), F.lit("mention")), kind("mention", mentionedAgent=t))
        .when(p.isin(*C.REACTION), kind("reaction", contentUri=t))
        .when(p == C.CONTENT, kind("content", contentUri=t))
        .otherwise(kind("unknown"))
    )


def is_excluded(predicate, excluded: list[str]) -> Column:
    return _text(predicate).isin(*excluded) if excluded else F.lit(False)


def is_shape_predicate(predicate) -> Column:
    """True for the predicates that shapes are made of."""
    p = _text(predicate)
    hit = p == C.SHAPE_TYPE
    for x in C.SHAPE_PREFIXES:
        hit = hit | F.startswith(p, F.lit(x))
    return hit


def origin_key(link_hash) -> Column:
    return F.concat(F.lit("link-origin/"), F.col(link_hash) if isinstance(link_hash, str) else link_hash)
