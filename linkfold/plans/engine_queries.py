"""Queries that go through the engine, its tables and folders, and those of the operators that the first module leaves out."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import access, schema
from .. import constants as C
from ..engine import Engine
from ..functions import literals as L
from ..functions import patterns, uris
from ..operators import history, links, projection, rdf
from ..operators.profiles import by_native_type, collect_profiles
from ..settings import parse_settings
from ..sources import pod
from ..sources.tables import Store, shared_folder
from ..sources.turtle import parse_turtle
from . import mapping as M
from .queries import _DELTA, _INSTANCE, _NATIVE, _PROFILE, _TTL, CHAT, COMMITS, LINK, ORACLE, _day_commits, _hash, _proved, _table_turtle, query


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = _folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _full_links(df: DataFrame) -> DataFrame:
    return _proved(df).withColumn("status", F.lit(None).cast("string")).select(*schema.LINK.names)


def _early_and_late(spark, d) -> tuple[DataFrame, DataFrame]:
    commits = _kept(_day_commits(spark, d), "commits")
    early = F.col("timestamp") < "2024-01-15"
    return commits.filter(early), commits.filter(~early)


def _publish(commits: DataFrame, shared: str) -> None:
    pod.publish_commits(commits, f"{shared}/diffs")


# store


@query("store_commits", f"{COMMITS} SELECT commit_hash, parent FROM chain")
def store_commits(spark, d):
    """Commits that are appended twice stand once."""
    early, late = _early_and_late(spark, d)
    store = Store(spark, _folder(spark, "store"))
    for part in (early, early.unionByName(late), late):
        store.append_commits(part)
    return store.commits().select("commit_hash", F.get("previous", F.lit(0)).alias("parent"))


@query("add_commits", f"{COMMITS} SELECT commit_hash, count(*) AS n FROM chain GROUP BY commit_hash")
def add_commits(spark, d):
    early, late = _early_and_late(spark, d)
    return history.add_commits(early, early.unionByName(late)).groupBy("commit_hash").agg(F.count(F.lit(1)).alias("n"))


@query("rebuild_links", ORACLE["fold_links"])
def rebuild_links(spark, d):
    engine = Engine(spark, _folder(spark, "engine"))
    engine.store.append_commits(_day_commits(spark, d))
    return engine.refold().select("link_hash", *LINK)


@query("links_by_target", f"WITH {CHAT} SELECT source, predicate, target FROM chat WHERE target = 'flux://has_message'")
def links_by_target(spark, d):
    engine = Engine(spark, _folder(spark, "engine"))
    engine.store.replace_links(links.with_hash(_full_links(M.chat_links(spark, d))))
    return engine.query("link-pattern", target="flux://has_message").select("source", "predicate", "target")


@query("peers", "SELECT DISTINCT 'did:test:' || role AS did FROM conversations WHERE role <> 'user'")
def peers(spark, d):
    store = Store(spark, _folder(spark, "store"))
    roles = [r.role for r in M._table(spark, d, "conversations").select("role").distinct().collect()]  # a handful
    for role in roles:
        store.set_peer(f"did:test:{role}", {"role": role})
    store.remove_peer("did:test:user")
    return store.peers().select("did")


@query("key_values", "SELECT 'seg/' || c_mktsegment || '/' || c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_name END AS value FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey % 5 <> 0")
def key_values(spark, d):
    """Values by key: put, put again, deleted, and found by a prefix."""
    store, key = Store(spark, _folder(spark, "store")), F.concat(F.lit("seg/"), "c_mktsegment", F.lit("/"), F.col("c_custkey").cast("string")).alias("key")
    customers = M._table(spark, d, "customer")
    store.put_values(customers.select(key, F.col("c_name").alias("value")))
    store.put_values(customers.filter("c_custkey % 3 = 0").select(key, F.lit("new").alias("value")))
    store.put_values(customers.filter("c_custkey % 5 = 0").select(key, F.lit(None).cast("string").alias("value")))
    return store.values("seg/BUILDING/")


@query("build_commits", f"{COMMITS} SELECT 'did:user:' || user_id AS author, day || 'T00:00:00.000Z' AS timestamp, {_hash(chr(39) + '[]' + chr(39))} AS commit_hash FROM numbered")
def build_commits(spark, d):
    """Diffs without parents as commits."""
    diffs = _day_commits(spark, d).drop("commit_hash").withColumn("previous", F.array().cast("array<string>")).withColumn("removals", F.transform("removals", lambda t: t["link"]))
    return history.build_commits(diffs).select("author", "timestamp", "commit_hash")


@query("fold_ties", f"WITH {CHAT} SELECT DISTINCT source, predicate, target, 'c2' AS signature FROM chat")
def fold_ties(spark, d):
    """Links that two commits of one batch add: the greater hash of the commits decides, not the order of rows."""
    chat = links.with_hash(M.chat_links(spark, d)).drop("ord").withColumns({"ord": F.lit(0), "pos": F.lit(0)})
    both = chat.withColumn("commit_hash", F.explode(F.array(F.lit("c2"), F.lit("c1")))).withColumn("signature", F.col("commit_hash"))
    return history.fold_rows(both, chat.limit(0)).select("source", "predicate", "target", "signature")


# replicas


@query("commit_publish", f"WITH {CHAT} SELECT source, predicate, target, author FROM chat WHERE predicate = 'flux://has_message'")
def commit_publish(spark, d):
    """A commit, as others read it from the shared folder."""
    shared = _folder(spark, "pod")
    engine = Engine(spark, _folder(spark, "engine"), shared)
    engine.commit(_full_links(M.chat_links(spark, d).filter("predicate = 'flux://has_message'")), timestamp="2024-01-01T00:00:00.000Z", project=False)
    found = pod.read_commits(pod.resources(spark, f"{shared}/diffs", "diff"))
    return found.select(F.explode("additions").alias("x")).select("x.source", "x.predicate", "x.target", "x.author")


@query("engine_commit", f"WITH {CHAT} SELECT source, predicate, target, author, timestamp FROM chat WHERE predicate = 'flux://has_reply' AND author <> 'did:test:user'")
def engine_commit(spark, d):
    """Links that one commit adds and a later one removes in part."""
    replies = _full_links(M.chat_links(spark, d).filter("predicate = 'flux://has_reply'"))
    engine = Engine(spark, _folder(spark, "engine"))
    engine.commit(replies)
    engine.commit(removals=replies.filter("author = 'did:test:user'"))
    return engine.render().select(*LINK)


def _synced(spark, d, emit=None) -> tuple[Engine, list[DataFrame | None]]:
    early, late = _early_and_late(spark, d)
    shared = _folder(spark, "pod")
    engine = Engine(spark, _folder(spark, "engine"), shared, emit=emit)
    changes = []
    for part in (early, late):
        _publish(part, shared)
        changes.append(engine.sync())
    return engine, changes


@query("sync_incremental", _DELTA)
def sync_incremental(spark, d):
    """What the second of two syncs changes."""
    return _synced(spark, d)[1][1].select("link_hash", "op")


@query("sync_links", ORACLE["fold_links"])
def sync_links(spark, d):
    """The links after two syncs, without a fold of all."""
    return _synced(spark, d)[0].render().select("link_hash", *LINK)


@query("sync_emits", f"SELECT 0 AS sync, 'add' AS op, count(*) AS n FROM ({_DELTA.partition('SELECT link_hash, ' + chr(39) + 'add')[0]} SELECT DISTINCT link_hash FROM b) UNION ALL SELECT 1, op, count(*) FROM ({_DELTA}) GROUP BY op")
def sync_emits(spark, d):
    """One emit for each sync; the links are current when it comes."""
    heard = []
    _synced(spark, d, lambda change: heard.append([(len(heard), r.op, r["count"]) for r in change.groupBy("op").count().collect()]))
    return spark.createDataFrame([row for rows in heard for row in rows], "sync int, op string, n long")


@query("signal", f"SELECT link_hash, 'add' AS op FROM ({ORACLE['fold_links']})")
def signal(spark, d):
    """A push notice starts a full sync."""
    shared = _folder(spark, "pod")
    _publish(_day_commits(spark, d), shared)
    return Engine(spark, _folder(spark, "engine"), shared).handle_signal('{"type": "Update"}').select("link_hash", "op")


def _views(spark, d) -> str:
    shared = _folder(spark, "pod")
    Engine(spark, _folder(spark, "engine"), shared).project_diff(_full_links(M.chat_links(spark, d)), 0)
    return shared


@query("view_sink", f"WITH {_NATIVE} SELECT subject, predicate, object, object_is_literal, object_datatype FROM t")
def view_sink(spark, d):
    """The views of a diff, as they are read again."""
    return parse_turtle(pod.read_views(spark, f"{_views(spark, d)}/views")).select("subject", "predicate", "object", "object_is_literal", "object_datatype")


@query("view_source", f"WITH {CHAT} SELECT source, predicate, target FROM chat WHERE predicate IN ('flux://entry_type', 'flux://body')")
def view_source(spark, d):
    """The links that another replica makes of views."""
    engine = Engine(spark, _folder(spark, "engine"), _views(spark, d))
    engine.ingest_views()
    return engine.render().select("source", "predicate", "target")


@query("sync_modes", "SELECT r_regionkey, CASE r_regionkey % 4 WHEN 0 THEN 'publish-only' WHEN 1 THEN 'subscribe-only' ELSE 'bidirectional' END AS mode, r_regionkey % 4 <> 1 AS publishes, r_regionkey % 4 <> 0 AS subscribes FROM region")
def sync_modes(spark, d):
    """What settings let a replica do; a mode that there is none of is the default."""
    regions = M._table(spark, d, "region").select("r_regionkey").collect()  # five
    read = [(r[0], parse_settings(json.dumps({"syncMode": ("publish-only", "subscribe-only", "bidirectional", "none")[r[0] % 4]}))) for r in regions]
    return spark.createDataFrame([(k, s.syncMode, s.publishes, s.subscribes) for k, s in read], "r_regionkey long, mode string, publishes boolean, subscribes boolean")


_RULE = "a acl:Authorization ;' || chr(10) || '    {who} ;' || chr(10) || '    acl:accessTo <http://pod/' || r_regionkey || '/> ;' || chr(10) || '    acl:default <http://pod/' || r_regionkey || '/> ;' || chr(10) || '    acl:mode {modes} .'"


@query(
    "access_documents",
    f"""SELECT r_regionkey, '@prefix acl: <{C.PREFIXES["acl"]}> .' || chr(10) || '@prefix foaf: <{C.PREFIXES["foaf"]}> .' || chr(10) || chr(10)
    || '<#owner> {_RULE.format(who="acl:agent <did:owner>", modes="acl:Read, acl:Write, acl:Control")} || chr(10) || chr(10)
    || '<#members> {_RULE.format(who="acl:agentGroup <http://pod/members#group>", modes="acl:Read, acl:Write")} AS acl,
    '@prefix vcard: <{C.PREFIXES["vcard"]}> .' || chr(10) || chr(10) || '<#group> a vcard:Group' || (SELECT string_agg(' ;' || chr(10) || '    vcard:hasMember <did:' || n_name || '>', '' ORDER BY n_name) FROM nation WHERE n_regionkey = r_regionkey) || ' .' AS members FROM region""",
)
def access_documents(spark, d):
    """Access rules and members of a container for each region."""
    rows = M._table(spark, d, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list("n_name")).alias("names")).collect()  # 25 names
    out = [(k, access.acl_document(f"http://pod/{k}/", "did:owner", "http://pod/members", "private"), access.members_document([f"did:{n}" for n in names])) for k, names in rows]
    return spark.createDataFrame(out, "r_regionkey long, acl string, members string")


# triples


def _raw(spark, d) -> DataFrame:
    chat = M.chat_links(spark, d)
    return chat.select(F.lit("d").alias("doc"), "ord", F.col("source").alias("subject"), "predicate", F.col("target").alias("object"), F.lit(False).alias("object_is_literal"), F.lit(None).cast("string").alias("object_datatype"))


@query("find_subjects", f"WITH {CHAT} SELECT source AS subject FROM chat WHERE predicate = 'flux://entry_type' AND target = 'flux://has_message'")
def find_subjects(spark, d):
    return rdf.find_subjects(_raw(spark, d), "flux://entry_type", "flux://has_message").select("subject")


@query("by_subject", f"WITH {CHAT} SELECT predicate, target AS object FROM chat WHERE source = 'conv://1'")
def by_subject(spark, d):
    return rdf.by_subject(_raw(spark, d), "conv://1").select("predicate", "object")


@query("resource_subject", f"WITH {_INSTANCE} SELECT CASE WHEN base LIKE '%/0' THEN base ELSE 'doc://' || base END AS doc, base AS subject FROM i")
def resource_subject(spark, d):
    triples = projection.to_native(projection.project_instances(M.chat_links(spark, d), [_PROFILE]))
    return rdf.resource_subject(triples.withColumn("doc", F.when(F.col("subject").endswith("/0"), F.col("subject")).otherwise(F.concat(F.lit("doc://"), "subject"))))


@query("authored_links", f"WITH {CHAT} SELECT CASE WHEN predicate = 'flux://has_reply' THEN '' ELSE source END AS source, predicate, target, author, timestamp FROM chat")
def authored_links(spark, d):
    chat = M.chat_links(spark, d).withColumn("source", F.when(F.col("predicate") != "flux://has_reply", F.col("source")))
    return projection.authored(chat).select(*LINK)


@query("triple_turtle", f"WITH {CHAT} SELECT '<' || source || '> <' || predicate || '> <' || target || '>' AS turtle FROM chat")
def triple_turtle(spark, d):
    return _raw(spark, d).select(rdf.format_triple().alias("turtle"))


@query("links_turtle", f"WITH {CHAT} SELECT source AS doc, {_TTL} || '<' || source || '> ' || string_agg('<' || predicate || '> <' || target || '>', ' ;' || chr(10) || '    ' ORDER BY ord) || ' .' AS turtle FROM chat GROUP BY source")
def links_turtle(spark, d):
    """A document for each source, in raw triples."""
    return rdf.links_to_turtle(M.chat_links(spark, d).withColumn("doc", F.col("source")), "raw-triples")


@query("turtle_links", f"WITH {CHAT} SELECT source, predicate, target, author, timestamp FROM chat")
def turtle_links(spark, d):
    """Links as reified Turtle, a document for each source, read again."""
    chat = _proved(M.chat_links(spark, d)).withColumn("doc", F.concat(F.lit("doc-"), "source"))
    return rdf.turtle_to_links(rdf.links_to_turtle(chat), now="").select(*LINK)


@query("hash_turtle", f"SELECT doc, sha256(turtle) AS turtle_hash, 4::BIGINT AS n FROM ({ORACLE['turtle_serialize']})")
def hash_turtle(spark, d):
    return rdf.parse_with_hash(_table_turtle(spark, d)).groupBy("doc", "turtle_hash").agg(F.count(F.lit(1)).alias("n"))


@query("patches", f"SELECT doc_id, '@prefix solid: <{C.PREFIXES['solid']}> .' || chr(10) || chr(10) || '_:patch solid:inserts {{' || chr(10) || '    ' || replace(text, chr(10), chr(10) || '    ') || chr(10) || '}} .' AS patch FROM documents")
def patches(spark, d):
    return M._table(spark, d, "documents").select("doc_id", rdf.patch(F.col("text"), "inserts").alias("patch"))


# shapes and scalars


def _shapes(spark, d) -> DataFrame:
    """A shape for each nation, of its region's type."""
    n = M._table(spark, d, "nation")
    key = F.col("n_nationkey").cast("string")
    shape, flag, field = (F.concat(F.lit(p), key) for p in ("shape://", "flag://", "field://"))
    native = F.concat(F.lit("literal:string:x%3A%2F%2Fregion%2F"), F.col("n_regionkey").cast("string"))
    rows = [(shape, C.NATIVE_TYPE, native), (shape, C.PROPERTY, flag), (shape, C.PROPERTY, field), (flag, C.PATH, F.lit("x://type")), (flag, C.HAS_VALUE, F.concat(F.lit("x://"), key)), (field, C.PATH, F.lit("x://comment")), (field, C.FIELD, F.concat(F.lit("literal:string:c"), key))]
    every = F.array(*[F.struct(s.alias("source"), F.lit(p).alias("predicate"), t.alias("target")) for s, p, t in rows])
    return n.select((F.col("n_nationkey") * 10).alias("_o"), F.posexplode(every).alias("_k", "l")).select("l.*", (F.col("_o") + F.col("_k")).alias("ord"))


def _profile_rows(spark, profiles) -> DataFrame:
    out = [(p.native_type, p.shape, f.path, f.name, len(p.flags), p.flags[0].value) for p in profiles for f in p.fields]
    return spark.createDataFrame(out, "native_type string, shape string, path string, field string, n_flags long, flag string")


@query("shape_profiles", "SELECT 'x://region/' || n_regionkey AS native_type, 'shape://' || n_nationkey AS shape, 'x://comment' AS path, 'c' || n_nationkey AS field, 1::BIGINT AS n_flags, 'x://' || n_nationkey AS flag FROM nation")
def shape_profiles(spark, d):
    return _profile_rows(spark, collect_profiles(_shapes(spark, d)))


@query("profile_by_type", "SELECT 'x://region/' || n_regionkey AS native_type, 'shape://' || min(n_nationkey) AS shape, 'x://comment' AS path, 'c' || min(n_nationkey) AS field, 1::BIGINT AS n_flags, 'x://' || min(n_nationkey) AS flag FROM nation GROUP BY n_regionkey")
def profile_by_type(spark, d):
    """The first profile of each native type."""
    return _profile_rows(spark, by_native_type(collect_profiles(_shapes(spark, d))).values())


@query("engine_profiles", f"SELECT native_type, count(*) AS n FROM (SELECT 'x://region/' || n_regionkey AS native_type FROM nation UNION ALL SELECT '{_PROFILE.native_type}') GROUP BY native_type")
def engine_profiles(spark, d):
    """The profiles that an engine keeps: those of its links, and that of chats."""
    engine = Engine(spark, _folder(spark, "engine"))
    none = F.lit(None).cast("string")
    shapes = _shapes(spark, d).withColumns({"author": F.lit("did:a"), "timestamp": F.format_string("%08d", "ord"), "proof": F.struct(none.alias("signature"), none.alias("key")), "status": none})
    engine.store.replace_links(links.with_hash(shapes))
    counted = {}
    for p in engine.profiles():
        counted[p.native_type] = counted.get(p.native_type, 0) + 1
    return spark.createDataFrame(list(counted.items()), "native_type string, n long")


@query("is_literal", f"WITH {CHAT} SELECT target, starts_with(target, 'literal:') AS is_literal FROM chat")
def is_literal(spark, d):
    return M.chat_links(spark, d).select("target", L.is_literal("target").alias("is_literal"))


@query("scalars", f"SELECT p_partkey, p_size::VARCHAR AS whole, '{C.XSD_INTEGER}' AS whole_type, p_size || '.5' AS part, '{C.XSD_DECIMAL}' AS part_type, (p_size > 25)::VARCHAR AS flag, '{C.XSD_BOOLEAN}' AS flag_type, p_name AS text, NULL::VARCHAR AS text_type FROM part")
def scalars(spark, d):
    """Scalars of all kinds as text, and the datatypes that they are written with."""
    values = {"whole": L.number_value("p_size"), "part": L.number_value(F.col("p_size") + 0.5), "flag": L.flag_value(F.col("p_size") > 25), "text": L.text_value("p_name")}
    return M._table(spark, d, "part").select("p_partkey", *[c for k, v in values.items() for c in (L.value_text(v).alias(k), L.value_datatype(v).alias(f"{k}_type"))])


@query("decode_terms", "SELECT p_partkey, p_size::DOUBLE AS n, p_size > 25 AS b, p_name AS s FROM part")
def decode_terms(spark, d):
    term = lambda c, kind: L.decode_term(c.cast("string"), F.lit(True), F.lit(kind))
    return M._table(spark, d, "part").select("p_partkey", term(F.col("p_size"), C.XSD_INTEGER)["n"].alias("n"), term(F.col("p_size") > 25, C.XSD_BOOLEAN)["b"].alias("b"), term(F.col("p_name"), C.XSD_STRING)["s"].alias("s"))


@query("pattern_kinds", f"WITH {CHAT} SELECT target, CASE ord % 5 WHEN 0 THEN 'chat-message' WHEN 1 THEN 'reply' WHEN 2 THEN 'mention' WHEN 3 THEN 'reaction' ELSE 'unknown' END AS type, CASE WHEN ord % 5 = 2 THEN target END AS mentioned FROM chat")
def pattern_kinds(spark, d):
    """Links of every kind that a predicate tells."""
    kinds = F.array(*map(F.lit, ("flux://has_message", "sioc://reply_of", "x://Mentions", "emoji://reaction", "z")))
    p = patterns.detect_pattern("source", F.get(kinds, (F.col("ord") % 5).cast("int")), "target")
    return M.chat_links(spark, d).select("target", p["type"].alias("type"), p["mentionedAgent"].alias("mentioned"))


@query("resource_bases", "SELECT page_id, url AS base FROM pages")
def resource_bases(spark, d):
    return M._table(spark, d, "pages").select("page_id", uris.resource_base("url").alias("base"))


@query("base64url", "SELECT p_partkey, rtrim(replace(replace(to_base64(encode(p_name)), '+', '-'), '/', '_'), '=') AS name FROM part")
def base64url(spark, d):
    return M._table(spark, d, "part").select("p_partkey", uris.base64url(F.col("p_name").cast("binary")).alias("name"))
