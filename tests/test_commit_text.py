"""Commits as text and back, by row, against the way through triples."""

import random

import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from linkfold import constants as C
from linkfold import schema
from linkfold.functions.uris import prefix_block
from linkfold.operators import history, rdf
from linkfold.sources import pod, turtle
from linkfold.sources.tables import Store
from linkfold.streaming import sync

PARTS = ["a", "", None, "x://1", 'say "so"\\', "#frag", "./x", "line\nline", "a b", C.RDF_TYPE, C.PREFIXES["foaf"] + "name", C.PREFIXES["foaf"] + "n/a", "p:q", "a>b", "é", C.COMMIT, "."]


def some_commits(spark, n=120, seed=5):
    r = random.Random(seed)
    part = lambda: r.choice(PARTS)
    link = lambda: (part(), part(), part(), part(), part(), r.choice([None, (part(), part())]), None)
    rows = []
    for i in range(n):
        links = [link() for _ in range(r.randrange(4))]
        adds = links + r.sample(links, r.randrange(len(links) + 1))
        gone = [(r.choice([None, "", "h1", "h2"]), r.choice([None, link()])) for _ in range(r.randrange(3))]
        rows.append((f"c{i}", part(), part(), [r.choice(["p1", "p2", 'p"3', None]) for _ in range(r.randrange(3))], adds, gone, i))
    rows += [("none", "a", "t", None, [], [], 0), ("no-adds", "a", "t", [], None, [], 0)]
    return spark.createDataFrame(rows, schema.COMMITS)


def test_text_by_row_equals_text_by_triples(spark):
    commits = some_commits(spark)
    assert sorted(rdf.commit_turtle(commits).collect()) == sorted(rdf.to_turtle(rdf.commit_triples(commits)).collect())


def odd_texts(spark):
    head, add = prefix_block() + "\n\n", '<#n> rdf:subject <s> ; rdf:predicate <p>, <q> ; rdf:object <o> .'
    texts = [r.turtle for r in rdf.commit_turtle(some_commits(spark)).collect()]
    texts += [None, "", "nonsense", head, head + "<> ad4m:author <> ;\n    a ad4m:DiffCommit .", head + "<> a ad4m:DiffCommit ;\n    ad4m:addition <#n> ;\n    ad4m:removal <#n> .\n\n" + add]
    texts += [f"@prefix z: <{C.PREFIXES['ad4m']}> .\n<d> a z:DiffCommit ; z:author \"x\", \"y\" ; z:addition <n>, <n> .\n" + add.replace("#n", "n"), head + "<#k> a ad4m:DiffCommit .\n\n<> a ad4m:DiffCommit ;\n    ad4m:previous \"p\" ."]
    return spark.createDataFrame([(f"n{i}", None if i == 3 else f"doc://{i}", t) for i, t in enumerate(texts)], "name string, doc string, turtle string")


def test_commits_by_text_equal_commits_by_triples(spark):
    found = odd_texts(spark)
    by_triples = rdf.commits_from_triples(turtle.parse_turtle(found)).join(found.select("doc", F.col("name").alias("commit_hash")), "doc")
    names = [c for c in schema.COMMITS.names if c != "ord"]
    key = lambda r: r.commit_hash
    assert sorted(pod.read_commits(found).select(names).collect(), key=key) == sorted(by_triples.select(names).collect(), key=key)


def test_written_texts_are_read_by_matches(spark):
    read = 0
    for _, doc, text in odd_texts(spark).filter("turtle is not null").collect():
        if (found := turtle.read_written(text, doc or "")) is not None:
            assert found == [t[:3] for t in turtle.parse(text, doc or "")]
            read += 1
    assert read > 20


@pytest.mark.parametrize("seed", [1, 2])
def test_folds_at_once_equal_touched_folds(spark, seed):
    r = random.Random(seed)
    link = lambda: (f"s{r.randrange(6)}", "p", "o", "a", "t", (r.choice("xyz"), "k"), None)
    rows = [([link() for _ in range(r.randrange(3))], [link() for _ in range(r.randrange(2))], [], "a", "t", r.randrange(3)) for _ in range(14)]
    kind = "additions array<LINK>, removals array<LINK>, previous array<string>, author string, timestamp string, ord long".replace("LINK", schema.LINK.simpleString())
    commits = history.build_commits(spark.createDataFrame(rows, kind)).withColumn("commit_hash", F.expr("uuid()")).select(*schema.COMMITS.names).collect()
    old, new = (spark.createDataFrame(x, schema.COMMITS) for x in (commits[:9], commits[9:]))
    touched, before, after = history.touched_folds(old, new)
    folds = history.both_folds(old, new)
    ordered = lambda df: sorted(df.collect())
    assert ordered(folds.select("link_hash")) == ordered(touched)
    for side, want in (("before", before), ("after", after)):
        assert ordered(folds.filter(f"{side} is not null").select("link_hash", f"{side}.*")) == ordered(want)
    assert sorted((x.link_hash, x.op) for x in history.one_sided(folds).collect()) == sorted((x.link_hash, x.op) for x in history.delta(before, after).collect())


def test_known_commits_are_not_read_again(spark, tmp_path, monkeypatch):
    commits = some_commits(spark, 12).filter("previous is not null and additions is not null")
    found = rdf.commit_turtle(commits).select(F.col("doc").alias("name"), F.concat(F.lit("d/"), "doc").alias("doc"), "turtle")
    store, asked = Store(spark, f"file://{tmp_path}/s"), []
    monkeypatch.setattr(sync, "read_commits", lambda f: (asked.append(f.count()), pod.read_commits(f))[1])
    sync.sync_batch(store, found.filter("name != 'c3'"), lambda c: None)
    sync.sync_batch(store, found, lambda c: None)
    assert asked == [11, 1] and store.commits().count() == 12


def plain_commits(n=60, seed=3):
    r = random.Random(seed)
    part = lambda: r.choice(["x://1", "a b", C.PREFIXES["foaf"] + "name", "é", 'say "so"\\', "p:q", None])
    link = lambda: {"source": part(), "predicate": part(), "target": part(), "author": part(), "timestamp": part(), "proof": r.choice([None, {"signature": part(), "key": "k"}]), "status": None}
    rows = []
    for i in range(n):
        adds = [link() for _ in range(r.randrange(5))]
        hashes = [f"h{i}-{k}" for k in range(len(adds))]
        gone = [{"link_hash": f"g{k}", "link": link()} for k in range(r.randrange(3))]
        if i % 10 == 9:  # a node that stands twice, and one without a name
            adds, hashes, gone = [*adds, link(), link()], [*hashes, "h", "h"], [*gone, {"link_hash": None, "link": None}]
        rows.append({"commit_hash": f"c{i}", "author": part(), "timestamp": part(), "previous": [r.choice(["p", 'p"', None]) for _ in range(r.randrange(3))], "hashes": hashes, "additions": adds, "removals": gone})
    kind = to_arrow_schema(T.StructType([*(schema.COMMITS[c] for c in ("commit_hash", "author", "timestamp", "previous", "additions", "removals")), T.StructField("hashes", T.ArrayType(T.StringType()))]))
    return pa.RecordBatch.from_pylist(rows, kind)


@pytest.mark.parametrize("together", [1, 7, 1 << 13])
def test_texts_by_column_equal_texts_by_row(monkeypatch, together):
    monkeypatch.setattr(rdf, "TOGETHER", together)
    batch = plain_commits()
    want, got, odd = [x for names, texts in rdf._texts(batch) for x in zip(names, texts, strict=True)], [], 0
    for part in rdf._parts(batch):
        strange = rdf._odd(part)
        odd += sum(strange.to_pylist())
        plain = part.filter(pc.invert(strange))
        got += zip(plain.column("commit_hash").to_pylist(), rdf._plain_texts(plain).to_pylist(), strict=True)
        got += [x for names, texts in rdf._texts(part.filter(strange)) for x in zip(names, texts, strict=True)]
    assert sorted(got) == sorted(want) and odd == 6


def test_plain_texts_are_read_a_link_at_a_time(spark):
    read = 0
    texts = [x for _, some in rdf._texts(plain_commits(200)) for x in some] + [r.turtle for r in odd_texts(spark).collect() if r.turtle]
    texts += [texts[0] + "\n\n<#add-x> a ad4m:Tombstone .", texts[0] + " ", texts[0].replace("<> a", "<#> a")]
    link = ("s", "p", "o", "a", "t", "sig", "")
    one = rdf._commit_text("a", "t", ["p1", "p2"], ["h1"], [link], ["g1"], [link])
    texts += [one, one.replace("<s>", "<#s>"), one.replace("<s>", "<>"), one.replace('"g1"', '""'), one.replace("#add-h1", "#add-h1 ;\n    ad4m:addition <#add-h2")]
    for text in texts:
        if (found := rdf._plain_commit(text)) is not None:
            assert found == rdf._commit([t[:3] for t in turtle.parse(text, "d")], "d")
            read += 1
    assert rdf._plain_commit(one) == ("a", "t", ["p1", "p2"], [link], [("g1", *link)]) and read > 5


def test_new_commits_are_neither_dealt_out_nor_joined(spark, tmp_path, monkeypatch):
    """F2 sync_emits: texts and rows are written as they are if all are new, and an empty history is not joined."""
    commits = some_commits(spark, 12).filter("previous is not null and additions is not null").withColumn("batch", F.lit("b"))
    commits.write.parquet(f"file://{tmp_path}/kept")
    commits = spark.read.schema(schema.COMMITS).parquet(f"file://{tmp_path}/kept")
    monkeypatch.setattr(pod, "publish", lambda *_: pytest.fail("texts are dealt out"))
    pod.publish_commits(commits, f"file://{tmp_path}/pod/diffs")
    found, some_known = pod.unseen(spark, f"file://{tmp_path}/pod/diffs", "diff", commits.select(F.col("commit_hash").alias("name")).limit(0))
    assert found.count() == 12 and not some_known
    store = Store(spark, f"file://{tmp_path}/s")
    assert store.append_commits(commits).count() == 12 and store.append_commits(commits).count() == 0
    old, new, _ = store.pending()
    plan = history.both_folds(old, new)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Union" in plan and plan.count("] parquet") == 2
    assert not list((tmp_path / "s" / "arrived").iterdir())


def test_only_files_with_unknown_names_are_read(spark, tmp_path):
    folder = f"file://{tmp_path}/a b%20c/diffs"
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "name string")
    for some in (("a", "b"), ("c",), ("d", "e")):
        names(*some).withColumn("turtle", F.lit("t")).coalesce(1).write.mode("append").parquet(folder)
    read = lambda *known: (lambda found: (sorted(r.name for r in found[0].collect()), found[1]))(pod.unseen(spark, folder, "diff", names(*known)))
    assert read() == (["a", "b", "c", "d", "e"], False)
    assert read("a", "b", "c") == (["d", "e"], False)
    assert read("a", "b", "d") == (["c", "d", "e"], True)
    assert read("a", "b", "c", "d", "e", "f") == ([], False)


def test_commits_that_stand_twice_or_are_stored(spark, tmp_path):
    store, commits = Store(spark, f"file://{tmp_path}/s"), some_commits(spark, 6).filter("additions is not null and previous is not null")
    first = commits.filter("ord < 3")
    assert store.append_commits(first.unionByName(first)).count() == 3
    assert sorted(r.commit_hash for r in store.append_commits(commits).collect()) == ["c3", "c4", "c5"]
    assert store.commits().count() == 6 and len(store.pending()[2]) == 2
