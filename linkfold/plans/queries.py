"""Queries over the business tables, one for each operator, with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import hashing as H
from ..functions import literals as L
from ..functions import patterns, uris
from ..functions.nodes import compile_node
from ..operators import history, links, projection, rdf
from ..operators.profiles import Field, Flag, Profile, chat_profile
from ..sources.turtle import parse_turtle
from . import mapping as M

LINK = ["source", "predicate", "target", "author", "timestamp"]
QUERIES: dict = {}
ORACLE: dict[str, str] = {}

CHAT = """chat AS (
  WITH c AS (SELECT *, 'msg://' || conv_id || '/' || turn AS msg, 'did:test:' || role AS author,
             '2024-01-01T00:' || lpad(turn::VARCHAR, 2, '0') || ':00.000Z' AS timestamp, (conv_id * 100000 + turn) * 10 AS o FROM conversations)
  SELECT 'conv://' || conv_id AS source, 'flux://has_message' AS predicate, msg AS target, author, timestamp, o AS ord FROM c
  UNION ALL SELECT msg, 'flux://entry_type', 'flux://has_message', author, timestamp, o + 1 FROM c
  UNION ALL SELECT msg, 'flux://body', 'literal:string:' || url_encode(text), author, timestamp, o + 2 FROM c
  UNION ALL SELECT 'msg://' || conv_id || '/' || (turn - 1), 'flux://has_reply', msg, author, timestamp, o + 3 FROM c WHERE turn > 0
)"""
EVENTS = """ev AS (
  SELECT 'user://' || user_id AS source, 'event://' || event_type AS predicate, 'event-id://' || event_id AS target,
         'did:user:' || user_id AS author, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS timestamp, event_id, user_id, ts, event_type FROM events
), eh AS (
  SELECT *, sha256(to_json([source, predicate, target, author, timestamp])::VARCHAR) AS link_hash FROM ev
), el AS (
  SELECT *, last_value(CASE WHEN event_type <> 'error' THEN link_hash END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last FROM eh
), added AS (SELECT * FROM el WHERE event_type <> 'error'),
removed AS (SELECT user_id, ts, last AS link_hash FROM el WHERE event_type = 'error' AND last IS NOT NULL)"""
HASH = "sha256(to_json([source, predicate, target, author, timestamp])::VARCHAR)"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return register


def _steps(where: str = "") -> str:
    return f"""{EVENTS}, step AS (
  SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, list_sort(list(a) FILTER (WHERE a IS NOT NULL)) AS adds, list_sort(list(r) FILTER (WHERE r IS NOT NULL)) AS rems
  FROM (SELECT user_id, ts, link_hash AS a, NULL AS r FROM added UNION ALL SELECT user_id, ts, NULL, link_hash FROM removed) {where} GROUP BY ALL
), numbered AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY day) AS k FROM step)"""


def _json(col: str) -> str:
    return f"CASE WHEN {col} IS NULL OR len({col}) = 0 THEN '[]' ELSE to_json({col})::VARCHAR END"


def _hash(previous: str) -> str:
    return f"""sha256('{{"additions":' || {_json('adds')} || ',"removals":' || {_json('rems')} || ',"previous":' || {previous} || ',"author":"did:user:' || user_id || '","timestamp":"' || day || 'T00:00:00.000Z"}}')"""


COMMITS = f"""WITH RECURSIVE {_steps()}, chain AS (
  SELECT user_id, day, k, NULL::VARCHAR AS parent, {_hash("'[]'")} AS commit_hash FROM numbered WHERE k = 1
  UNION ALL
  SELECT n.user_id, n.day, n.k, c.commit_hash, {_hash("'[\"' || c.commit_hash || '\"]'").replace('user_id', 'n.user_id').replace('adds', 'n.adds').replace('rems', 'n.rems').replace('day', 'n.day')}
  FROM numbered n JOIN chain c ON n.user_id = c.user_id AND n.k = c.k + 1
)"""


# pattern queries


@query("link_pattern_s", f"WITH {CHAT} SELECT source, predicate, target, author, timestamp FROM chat WHERE source = 'msg://1/0'")
def link_pattern_s(spark, d):
    return links.query_links(links.with_hash(M.chat_links(spark, d)), source="msg://1/0").select(*LINK)


@query("link_pattern_sp", f"WITH {CHAT} SELECT source, predicate, target, author, timestamp FROM chat WHERE source = 'conv://1' AND predicate = 'flux://has_message'")
def link_pattern_sp(spark, d):
    return links.query_links(links.with_hash(M.chat_links(spark, d)), source="conv://1", predicate="flux://has_message").select(*LINK)


@query("link_pattern_pt", f"WITH {CHAT} SELECT source, predicate, target, author, timestamp FROM chat WHERE predicate = 'flux://entry_type' AND target = 'flux://has_message'")
def link_pattern_pt(spark, d):
    return links.query_links(links.with_hash(M.chat_links(spark, d)), source="", predicate="flux://entry_type", target="flux://has_message").select(*LINK)


@query("link_pattern_all", f"WITH {CHAT} SELECT DISTINCT source, predicate, target, author, timestamp FROM chat")
def link_pattern_all(spark, d):
    return links.query_links(links.with_hash(M.chat_links(spark, d))).select(*LINK)


@query("link_hash", f"WITH {CHAT} SELECT {HASH} AS link_hash, sha256('{{\"source\":' || to_json(source)::VARCHAR || ',\"predicate\":' || to_json(predicate)::VARCHAR || ',\"target\":' || to_json(target)::VARCHAR || '}}') AS content_hash, source || ':' || predicate || ':' || target || ':' || author || ':' || timestamp AS content_key FROM chat")
def link_hash(spark, d):
    return M.chat_links(spark, d).select(H.link_hash().alias("link_hash"), H.content_hash().alias("content_hash"), H.content_key().alias("content_key"))


@query("link_dedup", "SELECT DISTINCT 'order://' || l_orderkey AS source, 'shop://has_line' AS predicate, 'line://' || l_linenumber AS target FROM lineitem")
def link_dedup(spark, d):
    return links.last_by_hash(links.with_hash(M.order_links(spark, d))).select("source", "predicate", "target")


@query("get_link", f"WITH {CHAT}, h AS (SELECT *, {HASH} AS link_hash FROM chat) SELECT link_hash, source, predicate, target FROM h WHERE link_hash = sha256(to_json(['conv://1', 'flux://has_message', 'msg://1/0', 'did:test:user', '2024-01-01T00:00:00.000Z'])::VARCHAR)")
def get_link(spark, d):
    import hashlib
    import json

    name = hashlib.sha256(json.dumps(["conv://1", "flux://has_message", "msg://1/0", "did:test:user", "2024-01-01T00:00:00.000Z"], separators=(",", ":")).encode()).hexdigest()
    return links.get_link(links.with_hash(M.chat_links(spark, d)), name).select("link_hash", "source", "predicate", "target")


@query("apply_diff", "WITH o AS (SELECT DISTINCT 'order://' || l_orderkey AS source, 'line://' || l_linenumber AS target, l_linenumber AS n FROM lineitem) SELECT source, target FROM o WHERE n NOT IN (2, 3)")
def apply_diff(spark, d):
    rows = links.with_hash(M.order_links(spark, d))
    stored, new, gone = rows.filter("target != 'line://1'"), rows.filter("target in ('line://1', 'line://2')"), rows.filter("target in ('line://2', 'line://3')")
    return links.apply_diff(links.last_by_hash(stored), new, gone).select("source", "target")


@query("excluded_predicates", f"WITH {CHAT} SELECT source, predicate, target FROM chat WHERE predicate NOT IN ('flux://body', 'flux://entry_type')")
def excluded_predicates(spark, d):
    return links.without_predicates(M.chat_links(spark, d), ["flux://body", "flux://entry_type"]).select("source", "predicate", "target")


@query("dual_dup", f"WITH {CHAT}, k AS (SELECT DISTINCT source, predicate, target FROM chat WHERE author = 'did:test:user') SELECT c.source, c.predicate, c.target, (k.source IS NOT NULL) AS is_duplicate FROM chat c LEFT JOIN k USING (source, predicate, target)")
def dual_dup(spark, d):
    chat = M.chat_links(spark, d)
    known = chat.filter("author = 'did:test:user'").select(H.content_hash().alias("content_hash"))
    return links.duplicates(chat, known).select("source", "predicate", "target", "is_duplicate")


@query("origin_filter", f"WITH {CHAT} SELECT source, predicate, target FROM chat WHERE author <> 'did:test:user'")
def origin_filter(spark, d):
    chat = links.with_hash(M.chat_links(spark, d))
    origins = chat.filter("author != 'did:test:system'").select("link_hash", F.when(F.col("author") == "did:test:user", "solid").otherwise("native").alias("origin")).distinct()
    return links.to_publish(chat, origins).select("source", "predicate", "target")


@query("detect_pattern", f"WITH {CHAT} SELECT source, target, CASE WHEN predicate = 'flux://has_message' THEN 'chat-message' WHEN predicate = 'flux://has_reply' THEN 'reply' ELSE 'unknown' END AS type, CASE WHEN predicate IN ('flux://has_message', 'flux://has_reply') THEN target END AS content_uri, CASE WHEN predicate = 'flux://has_message' THEN source END AS channel_uri, CASE WHEN predicate = 'flux://has_reply' THEN source END AS parent_uri FROM chat")
def detect_pattern(spark, d):
    p = patterns.detect_pattern()
    return M.chat_links(spark, d).select("source", "target", p["type"].alias("type"), p["contentUri"].alias("content_uri"), p["channelUri"].alias("channel_uri"), p["parentUri"].alias("parent_uri"))


@query("shape_predicates", f"WITH {CHAT} SELECT count(*) FILTER (WHERE starts_with(predicate, 'sh://') OR starts_with(predicate, 'projection://') OR predicate = 'rdf://type') AS n FROM chat")
def shape_predicates(spark, d):
    return M.chat_links(spark, d).agg(F.count_if(patterns.is_shape_predicate("predicate")).alias("n"))


# history


@query("fold_links", f"WITH {EVENTS} SELECT DISTINCT link_hash, source, predicate, target, author, timestamp FROM added WHERE link_hash NOT IN (SELECT link_hash FROM removed)")
def fold_links(spark, d):
    added, removed = M.event_diffs(spark, d)
    rows = added.select("link_hash", *LINK, F.col("event_id").alias("ord"), F.lit(0).alias("pos"))
    return history.fold_rows(rows, removed).select("link_hash", *LINK)


@query("fold_tombstoned", f"WITH {EVENTS} SELECT DISTINCT link_hash FROM removed")
def fold_tombstoned(spark, d):
    return M.event_diffs(spark, d)[1].select("link_hash").distinct()


_DELTA = f"""WITH {EVENTS}, b AS (
  SELECT link_hash FROM added WHERE ts < TIMESTAMP '2024-01-15' AND link_hash NOT IN (SELECT link_hash FROM removed WHERE ts < TIMESTAMP '2024-01-15')
), a AS (SELECT link_hash FROM added WHERE link_hash NOT IN (SELECT link_hash FROM removed))
SELECT link_hash, 'add' AS op FROM a WHERE link_hash NOT IN (SELECT link_hash FROM b)
UNION ALL SELECT link_hash, 'remove' FROM b WHERE link_hash NOT IN (SELECT link_hash FROM a)"""


@query("fold_delta", _DELTA)
def fold_delta(spark, d):
    added, removed = M.event_diffs(spark, d)
    rows = added.select("link_hash", "ts", F.col("event_id").alias("ord"), F.lit(0).alias("pos"))
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp")
    return history.delta(history.fold_rows(rows.filter(early), removed.filter(early)), history.fold_rows(rows, removed)).select("link_hash", "op")


@query("commit_hash", f"{COMMITS} SELECT user_id, day, commit_hash, parent FROM chain")
def commit_hash(spark, d):
    return M.event_commits(spark, d).select("user_id", "day", "commit_hash", F.get("previous", F.lit(0)).alias("parent"))


@query("dag_heads", f"{COMMITS} SELECT commit_hash FROM chain WHERE commit_hash NOT IN (SELECT parent FROM chain WHERE parent IS NOT NULL)")
def dag_heads(spark, d):
    return history.heads(M.event_commits(spark, d))


@query("dag_revision", f"{COMMITS}, h AS (SELECT commit_hash FROM chain WHERE commit_hash NOT IN (SELECT parent FROM chain WHERE parent IS NOT NULL)) SELECT CASE WHEN count(*) = 1 THEN min(commit_hash) WHEN count(*) > 1 THEN sha256(to_json(list(commit_hash ORDER BY commit_hash))::VARCHAR) END AS revision FROM h")
def dag_revision(spark, d):
    return history.revision(history.heads(M.event_commits(spark, d)))


@query("dag_ancestors", f"{COMMITS}, walk AS (SELECT commit_hash, parent FROM chain WHERE day = '2024-01-10' UNION SELECT c.commit_hash, c.parent FROM walk w JOIN chain c ON c.commit_hash = w.parent) SELECT DISTINCT commit_hash FROM walk")
def dag_ancestors(spark, d):
    commits = history._cut(M.event_commits(spark, d))
    return history.ancestors(commits.filter("day = '2024-01-10'"), history.edges(commits))


@query("head_groups", f"{COMMITS} SELECT user_id, max_by(commit_hash, k) AS revision, 1::BIGINT AS n_heads FROM chain GROUP BY user_id")
def head_groups(spark, d):
    return history.head_groups(M.event_commits(spark, d), "user_id")


# scalars


@query("literal_encode", "SELECT doc_id, 'literal:string:' || url_encode(text) AS encoded, 'literal:number:' || n_chars AS number, 'literal:boolean:' || (n_chars > 1000) AS flag FROM documents")
def literal_encode(spark, d):
    t = M._table(spark, d, "documents")
    return t.select("doc_id", L.encode_text("text").alias("encoded"), L.encode_number("n_chars").alias("number"), L.encode_flag(F.col("n_chars") > 1000).alias("flag"))


@query("literal_decode", "SELECT doc_id, text AS decoded, n_chars::DOUBLE AS number FROM documents")
def literal_decode(spark, d):
    t = M._table(spark, d, "documents").select("doc_id", L.encode_text("text").alias("e"), L.encode_number("n_chars").alias("n"))
    return t.select("doc_id", L.decode("e")["s"].alias("decoded"), L.decode("n")["n"].alias("number"))


@query("encode_typed", "SELECT p_partkey, 'literal:number:' || p_size AS size, 'literal:string:' || url_encode(p_name) AS name, 'literal:boolean:' || (p_size > 25) AS big FROM part")
def encode_typed(spark, d):
    typed = lambda c, t: L.encode_typed(L.text_value(c.cast("string")), F.lit(t))
    return M._table(spark, d, "part").select("p_partkey", typed(F.col("p_size"), C.XSD_INTEGER).alias("size"), typed(F.col("p_name"), C.XSD_INTEGER).alias("name"), typed(F.col("p_size") > 25, C.XSD_BOOLEAN).alias("big"))


def _node(node: dict):
    names = {"name": "p_name", "brand": "p_brand", "size": "p_size"}

    def lookup(p: str):
        if p == "none":
            return L.no_value()
        return L.number_value(names[p]) if p == "size" else L.text_value(names[p])

    return L.value_text(compile_node(node, lookup("name"), lookup))


@query("expr_concat", "SELECT p_partkey, p_brand || '/' || p_size AS v FROM part")
def expr_concat(spark, d):
    node = {"type": "concat", "args": [{"type": "path", "predicate": "brand"}, {"type": "path", "predicate": "none"}, {"type": "literal", "value": "/"}, {"type": "path", "predicate": "size"}]}
    return M._table(spark, d, "part").select("p_partkey", _node(node).alias("v"))


@query("expr_coalesce", "SELECT p_partkey, p_name AS v FROM part")
def expr_coalesce(spark, d):
    node = {"type": "coalesce", "args": [{"type": "path", "predicate": "none"}, {"type": "literal", "value": ""}, {"type": "focus"}]}
    return M._table(spark, d, "part").select("p_partkey", _node(node).alias("v"))


@query("expr_if_exists", "SELECT p_partkey, p_brand AS v, NULL::VARCHAR AS w FROM part")
def expr_if_exists(spark, d):
    cond = lambda p: {"type": "exists", "expr": {"type": "path", "predicate": p}}
    brand = {"type": "path", "predicate": "brand"}
    return M._table(spark, d, "part").select("p_partkey", _node({"type": "if", "cond": cond("size"), "then": brand}).alias("v"), _node({"type": "if", "cond": cond("none"), "then": brand}).alias("w"))


@query("compact_uri", "SELECT p_partkey, 'dcterms:' || p_partkey AS known, 'http://other/' || p_partkey AS other FROM part")
def compact_uri(spark, d):
    key = F.col("p_partkey").cast("string")
    return M._table(spark, d, "part").select("p_partkey", uris.compact_uri(F.concat(F.lit(C.PREFIXES["dcterms"]), key)).alias("known"), uris.compact_uri(F.concat(F.lit("http://other/"), key)).alias("other"))


@query("expand_uri", "SELECT p_partkey, 'http://purl.org/dc/terms/' || p_partkey AS known, 'none:' || p_partkey AS other FROM part")
def expand_uri(spark, d):
    key = F.col("p_partkey").cast("string")
    return M._table(spark, d, "part").select("p_partkey", uris.expand_name(F.concat(F.lit("dcterms:"), key)).alias("known"), uris.expand_name(F.concat(F.lit("none:"), key)).alias("other"))


@query("url_builders", "SELECT s_suppkey, 'http://pod/' || s_suppkey || '/links/' AS links, 'http://pod/' || s_suppkey || '/diffs/diff-x.ttl' AS diff, 'http://pod/' || s_suppkey || '/views/view-x.ttl' AS view, 'http://pod/' || s_suppkey || '/meta.ttl' AS meta, 'http://pod/' || s_suppkey || '/members/index.ttl' AS members, 'http://pod/' || s_suppkey || '/links/.acl' AS acl FROM supplier")
def url_builders(spark, d):
    root, path, x = F.lit("http://pod//"), F.concat(F.lit("/"), F.col("s_suppkey").cast("string"), F.lit("//")), F.lit("x")
    return M._table(spark, d, "supplier").select(
        "s_suppkey",
        uris.links_container(root, path).alias("links"),
        uris.resource(uris.diffs_container(root, path), "diff", x).alias("diff"),
        uris.resource(uris.views_container(root, path), "view", x).alias("view"),
        uris.meta_resource(root, path).alias("meta"),
        uris.members_resource(root, path).alias("members"),
        uris.acl_resource(uris.links_container(root, path)).alias("acl"),
    )


@query("url_extractors", "SELECT page_id, 'h' || page_id AS diff, NULL::VARCHAR AS view, regexp_replace(url, '[?#].*$', '') AS bare, CASE WHEN page_id % 2 = 0 THEN 'http://pod/x' ELSE 'http://pod/c/y' END AS member FROM pages")
def url_extractors(spark, d):
    file = F.concat(F.lit("http://pod/diffs/diff-h"), F.col("page_id").cast("string"), F.lit(".ttl"))
    value = F.when(F.col("page_id") % 2 == 0, F.lit("/x")).otherwise(F.lit("y"))
    return M._table(spark, d, "pages").select("page_id", uris.name_of(file, "diff").alias("diff"), uris.name_of(file, "view").alias("view"), uris.without_query("url").alias("bare"), uris.contained(F.lit("http://pod/c/"), value).alias("member"))


# projection

_PROFILE = chat_profile("http://rdfs.org/sioc/ns#Post", "http://rdfs.org/sioc/ns#content")
_INSTANCE = f"{CHAT}, i AS (SELECT m.source AS base, arg_min(e.author, e.ord) AS author, min(m.timestamp) AS timestamp FROM chat m JOIN chat e ON e.source = m.source AND e.predicate = 'flux://entry_type' GROUP BY m.source)"


@query("collect_instances", f"WITH {_INSTANCE} SELECT base, i.author, i.timestamp, (SELECT target FROM chat c WHERE c.source = base AND predicate = 'flux://body') AS body FROM i")
def collect_instances(spark, d):
    out = projection.collect_instances(M.chat_links(spark, d), _PROFILE)
    return out.select("base", "author", "timestamp", F.element_at("properties", F.lit("flux://body")).alias("body"))


@query("project_instances", f"WITH {_INSTANCE} SELECT base, i.author, i.timestamp, 'http://rdfs.org/sioc/ns#Post' AS native_type, c.text AS content FROM i JOIN conversations c ON base = 'msg://' || conv_id || '/' || turn")
def project_instances(spark, d):
    out = projection.project_instances(M.chat_links(spark, d), [_PROFILE])
    return out.select("base", "author", "timestamp", "native_type", F.element_at("fields", F.lit(_PROFILE.fields[0].name))["s"].alias("content"))


@query("project_priority", f"WITH {_INSTANCE}, r AS (SELECT DISTINCT source FROM chat WHERE predicate = 'flux://has_reply') SELECT base, CASE WHEN r.source IS NOT NULL THEN 'x://Body' ELSE 'x://Any' END AS native_type FROM (SELECT base FROM i UNION SELECT DISTINCT source FROM chat) s LEFT JOIN (SELECT source FROM chat WHERE predicate = 'flux://entry_type' AND source LIKE '%/0') r ON r.source = base")
def project_priority(spark, d):
    chat = M.chat_links(spark, d)
    # those with a first turn's type are of the first profile, all others of the second
    first = chat.withColumn("target", F.when((F.col("predicate") == "flux://entry_type") & ~F.col("source").endswith("/0"), F.lit("other")).otherwise(F.col("target")))
    profiles = [Profile("a", "a", "x://Body", (Field("body", "flux://body"),), (Flag("flux://entry_type", "flux://has_message"),)), Profile("b", "b", "x://Any", (), ())]
    return projection.project_instances(first, profiles).select("base", "native_type")


@query("ingest_links", f"WITH {_INSTANCE} SELECT base AS source, 0 AS pos, 'flux://entry_type' AS predicate, 'flux://has_message' AS target FROM i UNION ALL SELECT base, 1, 'flux://body', 'literal:string:' || url_encode(text) FROM i JOIN conversations ON base = 'msg://' || conv_id || '/' || turn UNION ALL SELECT 'conv://all', 2, 'ad4m://has_child', base FROM i")
def ingest_links(spark, d):
    found = projection.project_instances(M.chat_links(spark, d), [_PROFILE])
    return projection.ingest(found, _PROFILE, container="conv://all").select("source", "pos", "predicate", "target")


_NATIVE = f"""{_INSTANCE}, t AS (
  SELECT base AS subject, 0 AS k, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS predicate, 'http://rdfs.org/sioc/ns#Post' AS object, false AS object_is_literal, NULL::VARCHAR AS object_datatype FROM i
  UNION ALL SELECT base, 1, 'http://rdfs.org/sioc/ns#content', text, NOT (regexp_matches(text, '(?i)^[a-z][a-z0-9+.-]*://') OR starts_with(text, 'did:')), NULL FROM i JOIN conversations ON base = 'msg://' || conv_id || '/' || turn
  UNION ALL SELECT base, 2, 'http://purl.org/dc/terms/creator', author, false, NULL FROM i
  UNION ALL SELECT base, 3, 'http://purl.org/dc/terms/created', timestamp, true, 'http://www.w3.org/2001/XMLSchema#dateTime' FROM i)"""


@query("to_native_triples", f"WITH {_NATIVE} SELECT subject, k AS ord, predicate, object, object_is_literal, object_datatype FROM t")
def to_native_triples(spark, d):
    return projection.to_native(projection.project_instances(M.chat_links(spark, d), [_PROFILE]))


@query("from_native", f"WITH {_INSTANCE} SELECT base, i.author, i.timestamp, text AS content FROM i JOIN conversations ON base = 'msg://' || conv_id || '/' || turn")
def from_native(spark, d):
    triples = projection.to_native(projection.project_instances(M.chat_links(spark, d), [_PROFILE]))
    out = projection.from_native(triples, _PROFILE.native_type)
    return out.select("base", "author", "timestamp", F.element_at("fields", F.lit(_PROFILE.fields[0].name))["s"].alias("content"))


@query("ingest_roundtrip", f"WITH {CHAT} SELECT source, predicate, target FROM chat WHERE predicate IN ('flux://entry_type', 'flux://body')")
def ingest_roundtrip(spark, d):
    triples = projection.to_native(projection.project_instances(M.chat_links(spark, d), [_PROFILE]))
    return projection.ingest_native(triples, [_PROFILE]).select("source", "predicate", "target")


@query("ingest_new", f"WITH {CHAT} SELECT source, predicate, target FROM chat WHERE predicate IN ('flux://entry_type', 'flux://body') AND author <> 'did:test:user'")
def ingest_new(spark, d):
    chat = M.chat_links(spark, d)
    found = projection.ingest_native(projection.to_native(projection.project_instances(chat, [_PROFILE])), [_PROFILE])
    return projection.new_resources(found, chat.filter("author = 'did:test:user'")).select("source", "predicate", "target")


# triples


@query("raw_triples", f"WITH {CHAT} SELECT source AS subject, predicate, target AS object FROM chat")
def raw_triples(spark, d):
    return rdf.raw_triples(M.chat_links(spark, d)).select("subject", "predicate", "object")


def _proved(df: DataFrame) -> DataFrame:
    signed = F.when(F.col("author") == "did:test:user", F.lit("sig")).otherwise(F.lit(""))
    return df.withColumn("proof", F.struct(signed.alias("signature"), F.lit("key").alias("key")))


_REIFIED = f"""{CHAT}, h AS (SELECT *, {HASH} AS doc FROM chat), r AS (
  SELECT doc, unnest([
    struct_pack(k := 0, p := '{C.RDF_TYPE}', o := '{C.LINK}', l := false, d := NULL::VARCHAR), struct_pack(k := 1, p := '{C.RDF_SUBJECT}', o := source, l := false, d := NULL),
    struct_pack(k := 2, p := '{C.RDF_PREDICATE}', o := predicate, l := false, d := NULL), struct_pack(k := 3, p := '{C.RDF_OBJECT}', o := target, l := false, d := NULL),
    struct_pack(k := 4, p := '{C.AUTHOR}', o := author, l := true, d := NULL), struct_pack(k := 5, p := '{C.TIMESTAMP}', o := timestamp, l := true, d := '{C.XSD_DATETIME}'),
    struct_pack(k := 6, p := '{C.SIGNATURE}', o := CASE WHEN author = 'did:test:user' THEN 'sig' END, l := true, d := NULL), struct_pack(k := 7, p := '{C.KEY}', o := 'key', l := true, d := NULL)]) AS t FROM h)"""


@query("reify_triples", f"WITH {_REIFIED} SELECT doc, t.p AS predicate, t.o AS object, t.l AS object_is_literal, t.d AS object_datatype FROM r WHERE t.o IS NOT NULL")
def reify_triples(spark, d):
    return rdf.reify(_proved(M.chat_links(spark, d)), H.link_hash()).select("doc", "predicate", "object", "object_is_literal", "object_datatype")


@query("dereify_links", f"WITH {CHAT} SELECT source, predicate, target, author, timestamp, CASE WHEN author = 'did:test:user' THEN 'sig' ELSE '' END AS signature FROM chat")
def dereify_links(spark, d):
    triples = rdf.reify(_proved(M.chat_links(spark, d)), H.link_hash())
    return rdf.dereify(triples, now="").select(*LINK, F.col("proof.signature").alias("signature"))


@query("graph_lookups", f"WITH {CHAT} SELECT source, min_by(target, ord) AS first, count(*) AS n FROM chat WHERE predicate = 'flux://has_message' GROUP BY source")
def graph_lookups(spark, d):
    t = M.chat_links(spark, d).select(F.col("source").alias("doc"), "ord", F.lit("x").alias("subject"), "predicate", F.col("target").alias("object"))
    first = rdf.get_object(t, "x", "flux://has_message").select(F.col("doc").alias("source"), F.col("object").alias("first"))
    n = rdf.get_objects(t, "x", "flux://has_message").groupBy("doc").agg(F.count(F.lit(1)).alias("n"))
    return first.join(n, F.col("source") == F.col("doc")).select("source", "first", "n")


_TTL = """'@prefix ad4m: <https://ad4m.dev/ontology#> .
@prefix rdf: <http://www.w3.org/1999/02/22-rdf-syntax-ns#> .
@prefix xsd: <http://www.w3.org/2001/XMLSchema#> .
@prefix ldp: <http://www.w3.org/ns/ldp#> .
@prefix acl: <http://www.w3.org/ns/auth/acl#> .
@prefix foaf: <http://xmlns.com/foaf/0.1/> .
@prefix dcterms: <http://purl.org/dc/terms/> .
@prefix vcard: <http://www.w3.org/2006/vcard/ns#> .
@prefix solid: <http://www.w3.org/ns/solid/terms#> .

'"""


@query("turtle_serialize", f"WITH {_INSTANCE} SELECT base AS doc, {_TTL} || '<' || base || '> a <http://rdfs.org/sioc/ns#Post> ;\n    <http://rdfs.org/sioc/ns#content> \"' || replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"') || '\" ;\n    dcterms:creator <' || i.author || '> ;\n    dcterms:created \"' || i.timestamp || '\"^^xsd:dateTime .' AS turtle FROM i JOIN conversations ON base = 'msg://' || conv_id || '/' || turn")
def turtle_serialize(spark, d):
    return _table_turtle(spark, d)


def _table_turtle(spark, d):
    triples = projection.to_native(projection.project_instances(M.chat_links(spark, d), [_PROFILE]))
    return rdf.to_turtle(triples.withColumn("doc", F.col("subject")))


@query("turtle_parse", f"WITH {_NATIVE} SELECT subject, predicate, object, object_is_literal, object_datatype FROM t")
def turtle_parse(spark, d):
    return parse_turtle(turtle_serialize(spark, d)).select("subject", "predicate", "object", "object_is_literal", "object_datatype")


def _day_commits(spark: SparkSession, d: str) -> DataFrame:
    """Commits of the events, in full: one for each user and day."""
    link = F.struct(*LINK, F.struct(F.lit("s").alias("signature"), F.lit("k").alias("key")).alias("proof"), F.lit(None).cast("string").alias("status"))
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    # one window by user: an error finds the event whose link it removes, so no join looks it up; rows are dealt out and
    # sorted before their links are made, to as many tasks as hold the links
    e = M._table(spark, d, "events").select("user_id", "ts", "event_id", "event_type").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "user_id")
    own = F.struct("ts", "event_id", "event_type")
    last = F.last(F.when(F.col("event_type") != "error", own), ignorenulls=True).over(M.before())
    e = e.select("user_id", day, "event_id", F.col("event_type") == "error", F.when(F.col("event_type") == "error", last).otherwise(own).alias("x")).toDF("user_id", "day", "event_id", "error", "x")
    e = e.filter("error is not null and x is not null").select("user_id", "day", "event_id", "error", *M.link_of(F.col("x")))
    e = e.select("user_id", "day", "event_id", "error", H.link_hash().alias("link_hash"), link.alias("link"))
    added, gone = F.when(~F.col("error"), F.struct("event_id", "link", "link_hash")), F.when(F.col("error"), F.struct("link_hash", "link"))
    steps = e.groupBy("user_id", "day").agg(F.sort_array(F.collect_list(added)).alias("a"), F.sort_array(F.collect_list(gone)).alias("g"))
    steps = steps.withColumns({"add_hashes": F.sort_array("a.link_hash"), "remove_hashes": F.col("g.link_hash"), "author": F.concat(F.lit("did:user:"), "user_id"), "timestamp": F.concat("day", F.lit("T00:00:00.000Z"))})
    rows = history.chain_hashes(steps, "user_id", "day", carried=("a", "g"))
    from ..schema import COMMITS as S

    return rows.select(
        "commit_hash",
        F.concat(F.lit("did:user:"), "user_id").alias("author"),
        F.concat("day", F.lit("T00:00:00.000Z")).alias("timestamp"),
        "previous",
        F.col("a.link").cast(S["additions"].dataType).alias("additions"),
        F.col("g").cast(S["removals"].dataType).alias("removals"),
        F.lit(0).cast("long").alias("ord"),
    )


@query("fold_commits", ORACLE["fold_links"])
def fold_commits(spark, d):
    return history.fold(_day_commits(spark, d)).select("link_hash", *LINK)


@query("incremental_delta", _DELTA)
def incremental_delta(spark, d):
    commits = _day_commits(spark, d)
    early = F.col("timestamp") < "2024-01-15"
    return history.incremental_delta(commits.filter(early), commits.filter(~early)).select("link_hash", "op")


@query("commit_turtle_roundtrip", f"{COMMITS} SELECT c.commit_hash, c.parent, coalesce(len(adds), 0)::BIGINT AS n_added, coalesce(len(rems), 0)::BIGINT AS n_removed, c.commit_hash AS rehashed FROM chain c JOIN numbered n ON c.user_id = n.user_id AND c.k = n.k")
def commit_turtle_roundtrip(spark, d):
    """Commits to Turtle, parsed again, and hashed again from what was parsed."""
    back = rdf.commits_from_triples(parse_turtle(rdf.to_turtle(rdf.commit_triples(_day_commits(spark, d)))))
    of = lambda x: H.link_hash(x["source"], x["predicate"], x["target"], x["author"], x["timestamp"])
    again = H.commit_hash(F.transform("additions", of), F.transform("removals", lambda t: t["link_hash"]), "previous")
    return back.select(F.col("doc").alias("commit_hash"), F.get("previous", F.lit(0)).alias("parent"), F.size("additions").cast("long").alias("n_added"), F.size("removals").cast("long").alias("n_removed"), again.alias("rehashed"))


@query("missing_commits", f"{COMMITS} SELECT commit_hash FROM chain WHERE day >= '2024-01-20'")
def missing_commits(spark, d):
    """What a listing names and the store does not have."""
    from ..sources.pod import listing

    commits = M.event_commits(spark, d)
    members = commits.select(F.lit(C.CONTAINS).alias("predicate"), F.concat(F.lit("diff-"), "commit_hash", F.lit(".ttl")).alias("object"))
    found = listing(members, "http://pod/diffs/", "diff").select(F.col("name").alias("commit_hash"))
    return found.join(commits.filter("day < '2024-01-20'").select("commit_hash"), "commit_hash", "left_anti")


from . import engine_queries  # noqa: E402, F401  (it adds its queries to these)
