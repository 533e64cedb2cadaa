import corpus_pipeline
from pyspark.sql import functions as F

from fixtures import documents
from linkfold.llm.bpe import codec


def test_stages(spark, tmp_path):
    docs = documents(spark)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns
    texts = sorted((r.doc_id, r.text or "") for r in at.collect())
    out = sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert out == [(i, len(codec().encoding.encode_ordinary(t))) for i, t in texts]
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path)).select(*docs.columns) if stage is not corpus_pipeline.tokens else stage(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_near_copies_by_row(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (None, a), (None, c), (None, c), (7, a.upper()), (7, c), (8, b), (8, b), (9, None), (9, ""), (9, "")]
    out = corpus_pipeline.near_copies(spark, documents(spark, [(i, t, "en", "s", 0) for i, t in rows]), "")
    assert out.columns == documents(spark, []).columns
    assert sorted((r.doc_id, r.text or "") for r in out.collect()) == [(3, a), (5, b), (7, c), (9, ""), (9, ""), (9, "")]


def plain_lines(rows, words=4):
    """What lines() keeps of (doc_id, text), for doc_ids that are not null and unique."""
    first, gone = {}, set()
    for i, t in rows:
        parts = (t or "").split("\n") if t is not None else []
        for k in range(len(parts)):
            for n in (1, 2, 3):
                run = tuple(parts[k : k + n])
                if len(run) == n and (n == 3 or (n == 1 and len(run[0]) >= 60) or sum(len(x.encode().split()) for x in run) >= words) and first.setdefault(run, (i, k)) != (i, k):
                    gone |= {(i, j) for j in range(k, k + n)}
    out = []
    for i, t in rows:
        left = [x for k, x in enumerate((t or "").split("\n")) if (i, k) not in gone]
        if t is None or left:
            out.append((i, None if t is None else "\n".join(left)))
    return out


def plain_near(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().encode().split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and group[a] != group[b]:
                x, y = sorted((group[a], group[b]))
                group = [x if g == y else g for g in group]
    return [r for k, r in enumerate(rows) if not sets[k] or group[k] == k]


def test_rows_that_stages_keep(spark, tmp_path):
    """Each stage against a plain version, on the rows that the one before has kept."""
    base = [" ".join(f"{x}{i}" for i in range(30)) for x in "abcdefgh"]
    texts = [*base, base[0] + " more", base[1].upper(), "one line of a footer\n" + base[2], "one line of a footer\nown", None, "", base[3] + "\nvile nasty", "vile nasty words", "just fine\nvile nasty foul"]
    docs = documents(spark, [(i, t, "en", "s", 7) for i, t in enumerate(texts)] + [(100 + i, f"vile nasty text{i} foul" if i % 3 == 0 else f"good clean text{i} here", "en", "s", 7) for i in range(60)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(100 + i, 1, int(i % 3 == 0)) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in at.collect())
    kept = corpus_pipeline.clean(spark, at, str(tmp_path))
    want = [r for r in rows if "vile" not in (r[1] or "")]
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == want
    kept = corpus_pipeline.lines(spark, kept, str(tmp_path))
    want = plain_lines(want)
    got = kept.collect()
    assert sorted(((r.doc_id, r.text) for r in got)) == want and {r.doc_id: r.n_chars for r in got}[10] == len(base[2]) if (10, base[2]) in want else True
    kept = corpus_pipeline.near_copies(spark, kept, str(tmp_path))
    want = plain_near(want)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == want
    bare = kept.drop("n_chars", "lang").withColumn("_row", F.lit("mine"))
    assert corpus_pipeline.lines(spark, bare, str(tmp_path)).columns == corpus_pipeline.near_copies(spark, bare, str(tmp_path)).columns == corpus_pipeline.mix(spark, bare, str(tmp_path)).columns == bare.columns
