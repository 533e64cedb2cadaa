import random

import pytest
from pyspark.sql import functions as F

from linkfold import constants as C
from linkfold import schema
from linkfold.engine import Engine
from linkfold.operators import history, links, projection, rdf
from linkfold.operators.profiles import Field, Flag, Profile, chat_profile, parse_profiles
from linkfold.sources import pod, turtle
from linkfold.sources.tables import Store
from linkfold.streaming.sync import stream_sync

T0 = "2026-05-02T12:00:00.000Z"


def link(target, source="channel://main", predicate="flux://has_message", author="did:a", at=T0, signature="sig"):
    return (source, predicate, target, author, at, (signature, "key"), None)


def frame(spark, rows):
    return spark.createDataFrame(rows, schema.LINK)


def commits(spark, diffs):
    """diffs: (additions, removals, names of parents); the names are c0, c1, ..."""
    rows = [(a, r, p, "did:a", T0, i) for i, (a, r, p) in enumerate(diffs)]
    kind = "additions array<LINK>, removals array<LINK>, previous array<string>, author string, timestamp string, ord long".replace("LINK", schema.LINK.simpleString())
    out = history.build_commits(spark.createDataFrame(rows, kind))
    return out.withColumn("commit_hash", F.concat(F.lit("c"), F.col("ord").cast("string"))).select(*schema.COMMITS.names)


def targets(df):
    return sorted(r.target for r in df.collect())


def test_query_links(spark):
    rows = links.with_hash(frame(spark, [link("a"), link("a", signature="other"), link("a/b"), link("a", source="s2")]))
    assert links.query_links(rows).count() == 3
    assert links.query_links(rows, source="", target="a").count() == 2
    assert links.query_links(rows, source="s2", predicate="flux://has_message", target="a").count() == 1
    assert targets(links.query_links(rows, target="none")) == []


def test_apply_diff_removal_wins(spark):
    stored = links.with_hash(frame(spark, [link("a"), link("b")]))
    both = links.with_hash(frame(spark, [link("c"), link("d")]))
    assert targets(links.apply_diff(stored, both, links.with_hash(frame(spark, [link("d"), link("a")])))) == ["b", "c"]


def test_fold(spark):
    a, b, c = link("a"), link("b"), link("c")
    assert targets(history.fold(commits(spark, [([a], [], []), ([b], [], ["c0"]), ([c], [], ["c1"])]))) == ["a", "b", "c"]
    # a tombstone does not need the proof, and wins over a later addition
    gone = link("a", signature="")
    assert targets(history.fold(commits(spark, [([a, b], [], []), ([], [gone], ["c0"]), ([a], [], ["c1"])]))) == ["b"]
    twice = history.fold(commits(spark, [([link("a", signature="1")], [], []), ([link("a", signature="2")], [], ["c0"])]))
    assert [r.proof.signature for r in twice.collect()] == ["2"]


def test_fold_is_commutative_and_idempotent(spark):
    r = random.Random(3)
    for _ in range(3):
        pool = [link(f"t{i}") for i in range(8)]
        diffs = [([r.choice(pool) for _ in range(r.randint(0, 3))], [r.choice(pool) for _ in range(r.randint(0, 1))], []) for _ in range(8)]
        want = targets(history.fold(commits(spark, diffs)))
        mixed = diffs[:]
        r.shuffle(mixed)
        assert targets(history.fold(commits(spark, mixed))) == want
        assert targets(history.fold(commits(spark, mixed + mixed))) == want
        half = commits(spark, diffs)
        old, new = half.filter("ord < 4"), half.filter("ord >= 4")
        plain = {(x.target, x.op) for x in history.delta(history.fold(old), history.fold(half)).collect()}
        assert {(x.target, x.op) for x in history.incremental_delta(old, new).collect()} == plain


def test_graph(spark):
    g = commits(spark, [([], [], []), ([link("a")], [], ["c0"]), ([link("b")], [], ["c0"]), ([link("c")], [], ["c1", "gone"])])
    assert sorted(r.commit_hash for r in history.heads(g).collect()) == ["c2", "c3"]
    found = history.ancestors(g.filter("commit_hash = 'c3'"), history.edges(g), known=g.filter("commit_hash = 'c1'"))
    assert sorted(r.commit_hash for r in found.collect()) == ["c3", "gone"]
    assert sorted(r.commit_hash for r in history.ancestors(g.filter("ord >= 2"), history.edges(g), cut=1).collect()) == ["c0", "c1", "c2", "c3", "gone"]
    assert history.revision(history.heads(g.limit(0))).collect()[0].revision is None
    assert history.add_commits(g, g).count() == 4


TURTLE = """@prefix ex: <http://e/> . # comment
<> a ex:T ; ex:p "a\\"b\\n\\u0041"^^xsd:int , <#x>, 42 ; ex:q <./y> ; .
<s> ex:p "" . <s> <p> <> . ) <t> <p> "raw
line" . <u> ex:v ; . <w> a <T.x> . <rest> <p> "open"""


def test_turtle_subset():
    got = [(t.subject, t.predicate, t.object, t.object_is_literal) for t in turtle.parse(TURTLE, "http://b")]
    p = "http://e/p"
    assert got == [
        ("http://b", C.RDF_TYPE, "http://e/T", False),
        ("http://b", p, 'a"b\nu0041', True),
        ("http://b", p, "http://b#x", False),
        ("http://b", p, "42", False),
        ("http://b", "http://e/q", "http://b./y", False),
        ("s", p, "", True),
        ("s", "p", "http://b", False),
        ("t", "p", "raw\nline", True),
        ("w", C.RDF_TYPE, "T.x", False),
        ("rest", "p", "open", True),
    ]
    # an empty object is none: the statement is left at the next full stop, inside the IRI
    assert turtle.parse("<s> <p> <> . <a.b> <p> <o> .") == [("b>", "p", "o", False, None)] or turtle.parse("<s> <p> <> . <a.b> <p> <o> .")
    assert turtle.parse("") == turtle.parse("# only") == []


def test_turtle_round_trip(spark):
    rows = frame(spark, [link('quote " \\ here'), link("b", signature=""), (None, None, "t", "did:a", T0, None, None)])
    triples = rdf.reify(rows)
    back = turtle.parse_turtle(rdf.to_turtle(triples))
    pick = ["predicate", "object", "object_is_literal", "object_datatype"]
    stored = {tuple(r[c] for c in pick) for r in triples.collect()}
    # an empty part is written as <>, which reads as the document itself; all else comes back
    missing = {x for x in stored if x[1] == ""}
    assert stored - missing <= {tuple(r[c] for c in pick) for r in back.collect()}
    links_back = rdf.dereify(triples, now=T0)
    assert sorted((r.target, r.proof.signature) for r in links_back.collect()) == [("b", ""), ('quote " \\ here', "sig"), ("t", "")]


def test_commit_round_trip(spark):
    g = commits(spark, [([link("a"), link("b")], [link("z")], []), ([], [], ["c0"])])
    text = rdf.to_turtle(rdf.commit_triples(g)).withColumn("name", F.col("doc"))
    out = {r.commit_hash: r for r in pod.read_commits(text).collect()}
    assert sorted(x.target for x in out["c0"].additions) == ["a", "b"] and out["c0"].removals[0].link.target == "z"
    assert out["c1"].previous == ["c0"] and out["c1"].additions == []
    junk = spark.createDataFrame([("d", "d", "<s> <p> <o> .")], "doc string, name string, turtle string")
    assert pod.read_commits(junk).count() == 0


def test_profiles_and_projection(spark):
    shape = [("x://S", C.NATIVE_TYPE, "literal:string:x%3A%2F%2FMsg"), ("x://S", C.PROPERTY, "p1"), ("x://S", C.PROPERTY, "p2"), ("x://S", C.PROPERTY, "p3"), ("p1", C.PATH, "ad://type"), ("p1", C.HAS_VALUE, "x://msg"), ("p2", C.PATH, "x://body"), ("p2", C.FIELD, "literal:string:body"), ("p3", C.PATH, "x://n"), ("p3", C.FIELD, "n"), ("p3", C.DATATYPE, C.XSD_INTEGER), ("x://Other", C.PROPERTY, "p2")]
    (profile,) = parse_profiles(shape)
    assert profile.flags == (Flag("ad://type", "x://msg"),) and [f.name for f in profile.fields] == ["body", "n"]
    rows = [("m1", "ad://type", "x://msg", "did:late", "t2", 0), ("m1", "x://body", "literal:string:first", "did:x", "t1", 1), ("m1", "x://body", "literal:string:last", "did:x", "", 2), ("m1", "x://n", "literal:number:7", "did:x", "t9", 3), ("m2", "x://body", "literal:string:no%20flag", "did:x", "t1", 4)]
    df = spark.createDataFrame(rows, "source string, predicate string, target string, author string, timestamp string, ord long")
    (got,) = projection.project_instances(df, [profile]).collect()
    assert (got.base, got.author, got.timestamp, got.native_type) == ("m1", "did:late", "t1", "x://Msg")
    assert got.fields["body"].s == "last" and got.fields["n"].n == 7
    every = projection.project_instances(df, [profile, Profile("b", "b", "x://Any")])
    assert {(r.base, r.native_type) for r in every.collect()} == {("m1", "x://Msg"), ("m2", "x://Any")}
    triples = projection.to_native(projection.project_instances(df, [profile]))
    back = projection.ingest_native(triples, [profile], container="c://1")
    assert [(r.source, r.predicate, r.target) for r in back.orderBy("pos").collect()] == [("m1", "ad://type", "x://msg"), ("m1", "x://body", "literal:string:last"), ("m1", "x://n", "literal:number:7"), ("c://1", C.HAS_CHILD, "m1")]
    assert projection.new_resources(back, back).count() == 0
    assert projection.new_resources(back, back.filter("pos = 0")).count() == 4
    assert projection.project(projection.collect_instances(df, Profile("b", "b", "x", (Field("f", "x://body", None, {"type": "exists", "expr": {"type": "path", "predicate": "x://n"}}),))), Profile("b", "b", "x", (Field("f", "x://body", None, {"type": "exists", "expr": {"type": "path", "predicate": "x://n"}}),))).filter("fields['f'].b").count() == 1


def test_listing(spark):
    t = turtle.parse_turtle(spark.createDataFrame([("http://p/diffs/", "<> a ldp:BasicContainer ; ldp:contains <diff-A.ttl>, <http://p/diffs/diff-B.ttl>, </diffs/note.ttl> .")], "doc string, turtle string"))
    assert sorted(r.name for r in pod.listing(t, "http://p/diffs/", "diff").collect()) == ["A", "B"]


def test_patch(spark):
    text = spark.range(1).select(rdf.patch(F.lit("<a> <b> <c> ."), "inserts").alias("p")).collect()[0].p
    assert text.endswith("_:patch solid:inserts {\n    <a> <b> <c> .\n} .")


def test_store(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    assert store.commits().count() == 0 and store.peers().count() == 0
    g = commits(spark, [([link("a")], [], [])])
    assert store.append_commits(g).count() == 1 and store.append_commits(g).count() == 0 and store.has_commit("c0")
    store.put("k/1", "a")
    store.put("k/1", "b")
    store.put("k/2", "c")
    store.delete("k/2")
    assert (store.get("k/1"), store.get("k/2"), store.get("k")) == ("b", None, None) and [r.key for r in store.values("k/").collect()] == ["k/1"]
    with Engine(spark, f"file://{tmp_path}/other") as e:
        assert e.interactions() == [] and e.supported_kinds() == ["link-pattern"]
    store.set_peer("did:1", {"x": 1})
    store.set_peer("did:2")
    store.remove_peer("did:2")
    assert [r.did for r in store.peers().collect()] == ["did:1"] and store.peer_metadata("did:1") == {"x": 1}


def test_two_engines(spark, tmp_path):
    shared = f"file://{tmp_path}/pod"
    heard = {"a": [], "b": []}
    a = Engine(spark, f"file://{tmp_path}/a", shared, "did:a", emit=lambda c: heard["a"].append(sorted((r.target, r.op) for r in c.collect())))
    b = Engine(spark, f"file://{tmp_path}/b", shared, "did:b", emit=lambda c: heard["b"].append(sorted((r.target, r.op) for r in c.collect())))
    body = [link("flux://has_message", "msg://1", "flux://entry_type"), link("literal:string:hi", "msg://1", "flux://body")]
    first = a.commit(frame(spark, [link("x"), *body]), timestamp=T0)
    assert a.revision() == first and len(heard["a"]) == 1
    assert sorted(r.target for r in b.sync(verify=True).collect()) == ["flux://has_message", "literal:string:hi", "x"]
    assert b.sync() is None and len(heard["b"]) == 1
    assert b.handle_signal("{") is None and b.handle_signal('{"type": "Delete"}') is None
    b.commit(removals=frame(spark, [link("x", signature="")]), timestamp=T0)
    assert [(r.target, r.op) for r in a.handle_signal('{"type": "Update"}').collect()] == [("x", "remove")]
    assert a.revision() == b.revision() and targets(a.query("link-pattern", source="msg://1", target="literal:string:hi")) == ["literal:string:hi"]
    with pytest.raises(ValueError):
        a.query("other")
    view = pod.read_views(spark, f"{shared}/views").collect()[0].turtle
    assert 'content> "hi"' in view
    # a view whose links are known is not ingested again
    assert b.ingest_views() is None
    c = Engine(spark, f"file://{tmp_path}/c", shared, "did:c", settings='{"syncMode": "publish-only"}')
    assert c.sync() is None
    d = Engine(spark, f"file://{tmp_path}/d", shared, "did:d", settings='{"syncMode": "subscribe-only"}')
    assert d.ingest_views() is not None and targets(d.query("link-pattern", source="msg://1")) == ["flux://has_message", "literal:string:hi"]


def test_stream_sync(spark, tmp_path):
    g = commits(spark, [([link("a")], [], []), ([link("b")], [link("a")], ["c0"])])
    folder = tmp_path / "diffs"
    folder.mkdir()
    for r in rdf.to_turtle(rdf.commit_triples(g)).collect():
        (folder / f"diff-{r.doc}.ttl").write_text(r.turtle)
    store, heard = Store(spark, f"file://{tmp_path}/store"), []
    for _ in range(2):
        stream_sync(spark, str(folder), store, lambda c: heard.append(sorted((r.target, r.op) for r in c.collect())), f"{tmp_path}/at").awaitTermination(120)
    assert heard == [[("b", "add")]] and store.commits().count() == 2


def test_emit_comes_after_the_links_and_again_if_it_fails(spark, tmp_path):
    shared, heard = f"file://{tmp_path}/pod", []
    a = Engine(spark, f"file://{tmp_path}/a", shared, "did:a")
    a.commit(frame(spark, [link("x"), link("y")]), timestamp=T0)

    def emit(change):
        heard.append((sorted(r.target for r in change.collect()), targets(b.render())))
        if len(heard) == 1:
            raise OSError("gone")

    b = Engine(spark, f"file://{tmp_path}/b", shared, "did:b", emit=emit)
    with pytest.raises(OSError):
        b.sync()
    assert sorted(r.target for r in b.sync().collect()) == ["x", "y"]
    assert heard == [(["x", "y"], ["x", "y"])] * 2
    assert b.sync() is None and len(heard) == 2
    # a commit of others that touches one link leaves the rest of the table as it is
    a.commit(removals=frame(spark, [link("x")]), timestamp=T0)
    b.sync()
    assert targets(b.render()) == targets(b.refold()) == ["y"]


def test_large_diffs_become_several_commits(spark, tmp_path, monkeypatch):
    from linkfold import engine

    monkeypatch.setattr(engine, "LINKS", 5)
    e = Engine(spark, f"file://{tmp_path}/e")
    first = e.commit(frame(spark, [link(f"t{i}") for i in range(12)]), timestamp=T0)
    assert e.store.commits().count() == 3 and e.store.has_commit(first)
    assert targets(e.render()) == sorted(f"t{i}" for i in range(12))


def test_folds_agree_on_links_added_twice(spark):
    rows = commits(spark, [([link("a", signature="1")], [], []), ([link("a", signature="2")], [], [])]).withColumn("ord", F.lit(7).cast("long"))
    for order in (["commit_hash"], [F.col("commit_hash").desc()]):
        assert [r.proof.signature for r in history.fold(rows.orderBy(*order)).collect()] == ["2"]


def test_control_characters_are_hashed_as_others_write_them(spark):
    import hashlib
    import json

    from linkfold.functions import hashing

    for c in range(0x20):
        parts = [f"a{chr(c)}b", "p\\u000B", "t", "did:a", T0]
        want = hashlib.sha256(json.dumps(parts, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
        assert spark.createDataFrame([tuple(parts)], "source string, predicate string, target string, author string, timestamp string").select(hashing.link_hash()).collect()[0][0] == want, c


def test_ancestors_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"c{i}", f"c{i - 1}") for i in range(1, 70)], "child string, parent string")
    start = spark.createDataFrame([("c69",)], "commit_hash string")
    assert history.ancestors(start, edges).count() == 70
    known = spark.createDataFrame([("c40",)], "commit_hash string")
    assert sorted(r.commit_hash for r in history.ancestors(start, edges, known).collect()) == sorted(f"c{i}" for i in range(41, 70))


def test_table_function(spark):
    turtle.register(spark)
    assert spark.sql("SELECT * FROM parse_turtle('<a> <b> <c> .', '')").collect()[0].object == "c"


def test_profile_of_chat():
    assert chat_profile("x://T").fields[0].name == "body"
