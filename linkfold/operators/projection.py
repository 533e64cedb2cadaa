"""Projecting links to typed records and back."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import literals as L
from ..functions.nodes import compile_node
from .profiles import Profile, by_native_type


def authored(links: DataFrame) -> DataFrame:
    """Links with empty text for missing parts; a missing author or timestamp stays missing."""
    return links.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("source", "predicate", "target")})


def collect_instances(links: DataFrame, profile: Profile, order: str = "ord") -> DataFrame:
    """(base, author, timestamp, properties) for each source that has all flags of the profile.

    The last target of a predicate counts; the author is that of the first flag link (the first link if there are no
    flags); the timestamp is the least that is not empty. Two aggregates: by (source, predicate), which takes most rows away
    before the exchange, then by source.
    """
    is_flag: Column = functools.reduce(lambda a, b: a | b, [(F.col("predicate") == f.path) & (F.col("target") == f.value) for f in profile.flags], F.lit(False))
    first = is_flag if profile.flags else F.lit(True)
    by_predicate = links.groupBy("source", "predicate").agg(
        F.max_by("target", order).alias("target"),
        F.min(F.when(first, F.struct(F.col(order).alias("o"), F.col("author").alias("author")))).alias("first"),
        F.min(F.when(F.col("timestamp") != "", F.col("timestamp"))).alias("timestamp"),
        *[F.max((F.col("predicate") == f.path) & (F.col("target") == f.value)).alias(f"flag{i}") for i, f in enumerate(profile.flags)],
    )
    by_source = by_predicate.groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("predicate", "target"))).alias("properties"),
        F.min("first").alias("first"),
        F.min("timestamp").alias("timestamp"),
        *[F.max(f"flag{i}").alias(f"flag{i}") for i in range(len(profile.flags))],
    )
    for i in range(len(profile.flags)):
        by_source = by_source.filter(f"flag{i}")
    return by_source.select(F.col("source").alias("base"), F.coalesce("first.author", F.lit("")).alias("author"), F.coalesce("timestamp", F.lit("")).alias("timestamp"), "properties")


def project(instances: DataFrame, profile: Profile) -> DataFrame:
    """(base, author, timestamp, native_type, fields): fields is a map from name to scalar, of those that have a value."""
    lookup = lambda predicate: L.decode(F.element_at("properties", F.lit(predicate)))
    entries = []
    for f in profile.fields:
        focus = lookup(f.path)
        value = compile_node(f.expression, focus, lookup) if f.expression else focus
        entries.append(F.struct(F.lit(f.name).alias("key"), value.alias("value")))
    # a later field of the same name replaces an earlier one
    entries = [e for i, e in enumerate(entries) if profile.fields[i].name not in {x.name for x in profile.fields[i + 1 :]}]
    fields = F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull())) if entries else F.create_map().cast("map<string,struct<kind:string,s:string,n:double,b:boolean>>")
    return instances.select("base", F.nullif("author", F.lit("")).alias("author"), F.nullif("timestamp", F.lit("")).alias("timestamp"), F.lit(profile.native_type).alias("native_type"), fields.alias("fields"))


def project_instances(links: DataFrame, profiles: list[Profile], order: str = "ord") -> DataFrame:
    """project() of all profiles; a base that fits several is of the first."""
    parts = [project(collect_instances(links, p, order), p).withColumn("_rank", F.lit(i)) for i, p in enumerate(profiles)]
    every = functools.reduce(DataFrame.unionByName, parts)
    if len(parts) == 1:
        return every.drop("_rank")
    best = every.groupBy("base").agg(F.min_by(F.struct("author", "timestamp", "native_type", "fields"), "_rank").alias("_best"))
    return best.select("base", "_best.*")


def ingest(projections: DataFrame, profile: Profile, container: str | None = None, container_predicate: str = C.HAS_CHILD) -> DataFrame:
    """The links (base, author, timestamp, pos, source, predicate, target) of projections: flags first, then fields, then
    the link from the container. Rows without a base give none."""
    link = lambda s, p, t: F.struct(s.alias("source"), F.lit(p).alias("predicate"), t.alias("target"))
    base = F.col("base")
    parts = [link(base, f.path, F.lit(f.value)) for f in profile.flags]
    for f in profile.fields:
        value = F.element_at("fields", F.lit(f.name))
        parts.append(F.when(value.isNotNull(), link(base, f.path, L.encode_typed(value, F.lit(f.datatype).cast("string")))))
    if container:
        parts.append(link(F.lit(container), container_predicate, base))
    found = F.filter(F.array(*parts), lambda x: x.isNotNull())
    return projections.filter(F.coalesce(base, F.lit("")) != "").select("base", "author", "timestamp", F.posexplode(found).alias("pos", "link")).select("base", "author", "timestamp", "pos", "link.*")


def ingest_native(triples: DataFrame, profiles: list[Profile], container: str | None = None, container_predicate: str = C.HAS_CHILD) -> DataFrame:
    """Links of resources given as triples: the first profile whose class fits a resource says how."""
    first = by_native_type(profiles)
    parts, taken = [], None
    for p in profiles:
        found = from_native(triples, p.native_type)
        if taken is not None:
            found = found.join(taken, "base", "left_anti")
        parts.append(ingest(found, first[p.native_type], container, container_predicate))
        taken = found.select("base") if taken is None else taken.unionByName(found.select("base"))
    return functools.reduce(DataFrame.unionByName, parts)


def to_native(projections: DataFrame) -> DataFrame:
    """Triples (subject, ord, ...) of projections: the type, a triple for each field, author and time."""
    value = lambda e: e["value"]

    def triple(predicate: Column, object: Column, literal: Column, datatype: Column) -> Column:
        return F.struct(predicate.alias("predicate"), object.alias("object"), literal.alias("object_is_literal"), datatype.cast("string").alias("object_datatype"))

    def of_field(e: Column) -> Column:
        uri = L.value_is_uri(value(e))
        return triple(e["key"], L.value_text(value(e)), ~uri, F.when(~uri, L.value_datatype(value(e))))

    none, yes, no = F.lit(None), F.lit(True), F.lit(False)
    head = F.array(triple(F.lit(C.RDF_TYPE), F.col("native_type"), no, none))
    tail = F.array(
        F.when(F.col("author").isNotNull(), triple(F.lit(C.CREATOR), F.col("author"), no, none)),
        F.when(F.col("timestamp").isNotNull(), triple(F.lit(C.CREATED), F.col("timestamp"), yes, F.lit(C.XSD_DATETIME))),
    )
    every = F.concat(head, F.transform(F.map_entries("fields"), of_field), F.filter(tail, lambda x: x.isNotNull()))
    return projections.select(F.col("base").alias("subject"), F.posexplode(every).alias("ord", "t")).select("subject", "ord", "t.*")


def from_native(triples: DataFrame, native_type: str) -> DataFrame:
    """Projections of the subjects that are of this type and have a field; the last triple of a predicate counts."""
    fixed = F.col("predicate").isin(C.RDF_TYPE, C.CREATOR, C.CREATED)
    by_predicate = triples.groupBy("subject", "predicate").agg(
        F.max_by(F.struct("object", "object_is_literal", "object_datatype"), "ord").alias("t"),
        F.max((F.col("predicate") == C.RDF_TYPE) & (F.col("object") == native_type)).alias("typed"),
    )
    value = L.decode_term(F.col("t.object"), F.col("t.object_is_literal"), F.col("t.object_datatype"))
    by_subject = by_predicate.groupBy("subject").agg(
        F.max("typed").alias("typed"),
        F.max(F.when(F.col("predicate") == C.CREATOR, F.col("t.object"))).alias("author"),
        F.max(F.when(F.col("predicate") == C.CREATED, F.col("t.object"))).alias("timestamp"),
        F.map_from_entries(F.collect_list(F.when(~fixed, F.struct(F.col("predicate").alias("key"), value.alias("value"))))).alias("fields"),
    )
    out = by_subject.filter((F.col("subject") != "") & F.col("typed") & (F.size("fields") > 0))
    return out.select(F.col("subject").alias("base"), "author", "timestamp", F.lit(native_type).alias("native_type"), "fields")


def new_resources(links: DataFrame, known: DataFrame) -> DataFrame:
    """The links of those bases of which not every link is known already, by what the links say."""
    seen = known.select("source", "predicate", "target").distinct().withColumn("_known", F.lit(True))
    marked = links.join(seen, ["source", "predicate", "target"], "left")
    fresh = marked.groupBy("base").agg(F.min(F.coalesce("_known", F.lit(False))).alias("_all")).filter("not _all").select("base")
    return links.join(fresh, "base", "left_semi")
