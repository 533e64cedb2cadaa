import json

import pytest
from pyspark.sql import functions as F

from linkfold import access, constants as C
from linkfold.functions import hashing as H
from linkfold.functions import literals as L
from linkfold.functions import nodes, patterns, uris
from linkfold.settings import parse_settings


def one(spark, *columns):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0])


LINK = ("channel://main", "flux://has_message", "expr://1", "did:key:z6MkTest", "2026-05-02T12:00:00.000Z")


def test_hash_vectors(spark):
    link = lambda t: H.link_hash(*[F.lit(x) for x in (LINK[0], LINK[1], t, *LINK[3:])])
    h1, h2 = one(spark, link("expr://1"), link("expr://2"))
    assert h1 == "e2b9dee82784ead042a858d7f771a4755b174ad2b69c425495d830666879fc83"
    assert h2 == "8131ae8ad4be1d3f55770257a9dfbbacfb0d12dd59c9b960cc5c570404145859"
    none = F.array().cast("array<string>")
    c1 = one(spark, H.commit_hash(F.array(F.lit(h1)), none, none, F.lit(LINK[3]), F.lit(LINK[4])))[0]
    assert c1 == "520a430130423bb1031727e49653c1e48cc6e16550bf3d5a59ae7acd0ea7a74e"
    c2 = one(spark, H.commit_hash(F.array(F.lit(h2)), none, F.array(F.lit(c1)), F.lit(LINK[3]), F.lit(LINK[4])))[0]
    assert c2 == "b65e38a92ebf4c6f219dabd08e50397762dc50fc802fe2170f5558c41ed060de"
    b = "b10e227fe6abe4aba1e3d53a5622e822503df201c13a9b2b77f4602eba99f850"
    r = one(spark, H.revision(F.array(F.lit(c2), F.lit(b))), H.revision(F.array(F.lit(b))), H.revision(none))
    assert r == ["ca8401acef08b9248e4eb1ddae669404aa343a7353d4cbf0ac295836452e01bb", b, None]
    missing = one(spark, H.link_hash(F.lit("a"), F.lit(None).cast("string"), F.lit("b"), F.lit("c"), F.lit("d")), H.link_hash(*map(F.lit, ("a", "", "b", "c", "d"))))
    assert missing[0] != missing[1]


@pytest.mark.parametrize(
    ("n", "text"),
    [(42.0, "42"), (0.0, "0"), (-0.0, "0"), (3.14, "3.14"), (1e7, "10000000"), (1.5e7, "15000000"), (12345678.9, "12345678.9"), (1e21, "1e+21"), (2e22, "2e+22"), (1e20, "100000000000000000000"), (1e-6, "0.000001"), (1.5e-5, "0.000015"), (1e-7, "1e-7"), (-2.5e-9, "-2.5e-9"), (float("inf"), "Infinity"), (float("nan"), "NaN"), (0.001, "0.001"), (-1e7, "-10000000")],
)
def test_number_text(spark, n, text):
    assert one(spark, L.number_text(F.lit(n)))[0] == text


def test_literals(spark):
    assert one(spark, L.encode_text(F.lit("Hello world")), L.encode_text(F.lit("a!b'c(d)e*~é")), L.encode_number(F.lit(42)), L.encode_flag(F.lit(True)), L.encode_json(F.lit('{"a":1}'))) == [
        "literal:string:Hello%20world",
        "literal:string:a%21b%27c%28d%29e%2A~%C3%A9",
        "literal:number:42",
        "literal:boolean:true",
        "literal:json:%7B%22a%22%3A1%7D",
    ]
    value = lambda u: L.value_text(L.decode(F.lit(u).cast("string")))
    assert one(spark, *map(value, ["literal://string:hi%20there", "did:key:z6Mk", "literal:number:42", "literal:number:7up", "literal:number:x", "literal:boolean:yes", "literal:other:x", "literal:string:a+b", "literal:string:%zz", None, "literal:json:null", "literal:json:%22s%22", "literal:json:%5B1%5D"])) == ["hi there", "did:key:z6Mk", "42", "7", "NaN", "false", "literal:other:x", "a+b", None, None, None, "s", "[1]"]
    typed = lambda s, t: L.encode_typed(L.text_value(F.lit(s)), F.lit(t).cast("string"))
    assert one(spark, typed("3.14", C.XSD_DECIMAL), typed("", C.XSD_INTEGER), typed("0x1f", C.XSD_INTEGER), typed("x", C.XSD_INTEGER), typed("true", C.XSD_BOOLEAN), typed("no", C.XSD_BOOLEAN), typed("7", "geo:point"), typed("7", None)) == ["literal:number:3.14", "literal:number:0", "literal:number:31", "literal:string:x", "literal:boolean:true", "literal:string:no", "literal:number:7", "literal:string:7"]
    assert one(spark, L.value_is_uri(L.text_value(F.lit("Http://x"))), L.value_is_uri(L.text_value(F.lit("did:x"))), L.value_is_uri(L.text_value(F.lit("x y"))), L.value_is_uri(L.number_value(F.lit(1)))) == [True, True, False, False]
    assert one(spark, L.value_datatype(L.number_value(F.lit(3.0))), L.value_datatype(L.number_value(F.lit(3.5))), L.value_datatype(L.flag_value(F.lit(True))), L.value_datatype(L.text_value(F.lit("s")))) == [C.XSD_INTEGER, C.XSD_DECIMAL, C.XSD_BOOLEAN, None]


def test_nodes(spark):
    values = {"X": L.text_value(F.lit("X")), "zero": L.number_value(F.lit(0)), "no": L.flag_value(F.lit(False)), "empty": L.text_value(F.lit(""))}
    look = lambda p: values.get(p, L.no_value())
    run = lambda n: one(spark, L.value_text(nodes.compile_node(n, look("X"), look)))[0]
    path, lit = (lambda p: {"type": "path", "predicate": p}), (lambda v: {"type": "literal", "value": v})
    assert run({"type": "concat", "args": [lit("data:"), path("X"), path("none")]}) == "data:X"
    assert run({"type": "concat", "args": [path("none")]}) is None
    assert run({"type": "concat", "args": []}) is None
    assert run({"type": "coalesce", "args": [path("none"), lit(""), lit("fallback")]}) == "fallback"
    for name, there in (("zero", "true"), ("no", "false"), ("empty", "false"), ("none", "false"), ("X", "true")):
        assert run({"type": "exists", "expr": path(name)}) == there
    assert run({"type": "if", "cond": path("no"), "then": lit(1)}) is None
    assert run({"type": "if", "cond": path("zero"), "then": lit(1.5), "else": lit(2)}) == "1.5"
    assert run({"type": "focus"}) == "X"
    with pytest.raises(ValueError):
        run({"type": "other"})


def test_uris(spark):
    s = F.lit
    assert one(spark, uris.compact_uri(s(C.RDF_TYPE)), uris.compact_uri(s("x://y")), uris.expand_name(s("rdf:type")), uris.expand_name(s("no:x")), uris.expand_name(s("plain"))) == ["rdf:type", "x://y", C.RDF_TYPE, "no:x", "plain"]
    for root in ("http://h:1", "http://h:1/", "http://h:1//"):
        for path in ("a/b", "/a/b", "a/b/", "/a/b/"):
            assert one(spark, uris.diffs_container(s(root), s(path)))[0] == "http://h:1/a/b/diffs/"
    assert one(spark, uris.join_path(s("http://h"), s("/")), uris.resource(s("http://h/diffs/"), "diff", s("Q")), uris.name_of(s("http://h/diffs/diff-Q.ttl"), "diff"), uris.name_of(s("http://h/view-Q.ttl"), "diff"), uris.acl_resource(s("http://h/c/"))) == ["http://h/", "http://h/diffs/diff-Q.ttl", "Q", None, "http://h/c/.acl"]
    assert one(spark, *[uris.contained(s("http://h/c/"), s(v)) for v in ("http://o/x", "/r", "l.ttl")]) == ["http://o/x", "http://h/r", "http://h/c/l.ttl"]
    assert one(spark, uris.without_query(s("http://h/p?q#f")), uris.base64url(s("a").cast("binary")), uris.base64url(s("??>").cast("binary"))) == ["http://h/p", "YQ", "Pz8-"]


def test_patterns(spark):
    kind = lambda p, **k: patterns.detect_pattern(F.lit("s"), F.lit(p), F.lit("t"), **k)["type"]
    assert one(spark, kind("flux://has_message"), kind("sioc://reply_of"), kind("x://Mentions"), kind("emoji://reaction"), kind("z"), kind(""), kind("sioc://content_of"), kind("sioc://content_of", chat=["q"]), kind("flux://has_message", chat=[])) == ["chat-message", "reply", "mention", "reaction", "unknown", "unknown", "chat-message", "content", "unknown"]


def test_settings():
    assert parse_settings(None).syncMode == parse_settings("{").syncMode == parse_settings("[1]").syncMode == "bidirectional"
    s = parse_settings(json.dumps({"syncMode": "publish-only", "sync": {"pollIntervalMs": -1, "useEtags": False}, "rendering": {"strategy": "x"}, "dualLanguage": {"excludePredicates": ["p"]}, "batching": 3}))
    assert (s.publishes, s.subscribes, s.sync.pollIntervalMs, s.sync.useEtags, s.rendering.strategy, s.dualLanguage.excludePredicates, s.batching.windowMs) == (True, False, 30000, False, "reified", ["p"], 60000)


def test_access_documents():
    for mode, rules in (("open", 2), ("members-only", 3), ("private", 2)):
        assert access.acl_document("http://c/", "http://o", "http://m", mode).count("a acl:Authorization") == rules
    assert access.members_document([]).endswith("<#group> a vcard:Group .")
    assert access.members_document(["a", "b"]).endswith("<#group> a vcard:Group ;\n    vcard:hasMember <a> ;\n    vcard:hasMember <b> .")
    assert access.headers("PUT", "t", etag="e") == {"Content-Type": "text/turtle", "If-Match": "e", "Authorization": "Bearer t"}
    assert access.headers("GET", etag="e") == {"Accept": "text/turtle", "If-None-Match": "e"}
