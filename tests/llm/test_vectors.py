import numpy as np
import pytest
from pyspark.sql import functions as F

from linkfold.llm import embedding_dedup, topk_search


def vectors(n=300, dim=16, seed=1):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    for i in range(60, n):
        if r.random() < 0.5:
            x[i] = x[r.integers(0, i)] + r.normal(size=dim) * r.choice([0, 0.05, 0.2, 0.35])
    return x.astype(np.float32)


ODD = [(900, None), (901, []), (902, [float("nan")] * 16), (903, [0.0] * 16), (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, [2.0, 4.0]), (907, [float("inf")] * 16)]


@pytest.mark.parametrize("blocks", [1, 4, 16])
def test_links_equal_plain(spark, monkeypatch, blocks):
    x = vectors()
    df = spark.createDataFrame([(i, [float(z) for z in v]) for i, v in enumerate(x)] + ODD, "vec_id long, v array<float>").withColumn("n_links", F.lit("clash"))
    out = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, 0.9, blocks, pack=40).collect()}
    u = x.astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    label = np.arange(len(x))
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(x))])
        if (new == label).all():
            break
        label = new
    for i in range(len(x)):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (near[i].sum(), label[i], label[i] == i)
    for i in (900, 901, 902, 903, 904, 907):
        assert (out[i].n_links, out[i].component_id, out[i].kept) == (0, i, True)
    assert (out[906].n_links, out[906].component_id) == (1, 905)


def test_far_groups_of_vectors_are_passed_over():
    r = np.random.default_rng(9)
    centres = r.normal(size=(16, 16))
    both = [np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True) / 2, 128, 0)[r.permutation(2048)] + r.normal(size=(2048, 16)) * 0.01 for _ in range(2)]
    p, q, looked = embedding_dedup._close(*both, 0.005)
    assert looked < 0.3 * 2048 * 2048
    plain = ((both[0][:, None, :] - both[1][None, :, :]) ** 2).sum(2)
    assert {*zip(p.tolist(), q.tolist(), strict=True)} >= {*zip(*[x.tolist() for x in np.nonzero(plain <= 0.005)], strict=True)}
    assert (plain[p, q] <= 0.0051).all()


def test_links_of_repeated_rows(spark):
    one, two = [1.0] + [0.0] * 7, [0.0] * 7 + [1.0]
    df = spark.createDataFrame([(1, one), (1, one), (1, two), (None, two), (2, one)], "vec_id long, v array<float>")
    out = sorted(((r.vec_id or 0, r.n_links, r.component_id) for r in embedding_dedup.near_duplicates(df).collect()))
    assert out == [(0, 1, 1), (1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize(("k", "block", "span"), [(20, 8, 50), (3, 64, 4096), (400, 16, 100)])
def test_top_k_equals_plain(spark, k, block, span):
    x = np.floor(vectors() * 4)
    x[200:220] = x[10]
    df = spark.createDataFrame([(i, [float(z) for z in v]) for i, v in enumerate(x)] + [r for r in ODD if r[0] not in (903,)] + [(None, [1.0] * 16), (7, [9.0] * 16)], "vec_id long, v array<double>")
    out = topk_search.top_k(df, df.filter(F.col("vec_id") % 10 == 0), k, block, span).collect()
    got = {}
    for r in out:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    everything = {i: v for i, v in enumerate(x)}
    for q in range(0, 300, 10):
        s = sorted(((-int(v @ x[q]), i) for i, v in everything.items() if i != q))[:k]
        assert sorted(got[q]) == [(n + 1, i, -c) for n, (c, i) in enumerate(s)]
    assert topk_search.top_k(df.limit(0), df.limit(0)).count() == 0


def test_most_blocks_of_clustered_vectors_are_skipped():
    r = np.random.default_rng(8)
    centres = r.normal(size=(64, 32)) * 40
    x = np.floor(np.repeat(centres, 64, 0) + r.normal(size=(4096, 32)) * 4)
    queries = x[::20]
    top = topk_search.Top(np.arange(4096)[::20], queries, 20)
    scored = top.look(np.arange(4096), x, 64)
    assert scored < 0.1 * len(queries) * 64
    for i in range(0, len(queries), 37):
        s = sorted((-int(v @ queries[i]), j) for j, v in enumerate(x) if j != 20 * i)[:20]
        assert [(-int(a), int(b)) for a, b in zip(top.score[i], top.found[i], strict=True)] == s
    seeded = topk_search.Top(np.arange(4096)[::20], queries, 20, top.score[:, -1].copy())
    assert seeded.look(np.arange(4096), x, 64) <= scored and (seeded.found == top.found).all()


def test_op6_takes_every_row(spark, tmp_path):
    r = np.random.default_rng(3)
    data = [(int(i), [float(z) for z in r.integers(-4, 5, 4)]) for i in r.integers(0, 45, 120)]
    data += data[:5]
    spark.createDataFrame([(i, [z / 64 for z in v]) for i, v in data], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in topk_search.op6(spark, str(tmp_path)).collect())
    want = []
    for q in {i for i, _ in data if i % 20 == 0}:
        s = sorted((-int(np.dot(a, b)), j) for i, a in data if i == q for j, b in data if j != q)[:20]
        want += [(q, n + 1, j, -c) for n, (c, j) in enumerate(s)]
    assert got == sorted(want)


def test_top_k_sends_the_driver_neither_packs_nor_a_sample_of_every_task(spark):
    df = spark.createDataFrame([(i, [float(z) for z in v]) for i, v in enumerate(np.floor(vectors() * 4))], "vec_id long, v array<double>")
    assert "Broadcast" not in topk_search.top_k(df, df.filter("vec_id % 20 = 0"))._jdf.queryExecution().executedPlan().toString()
    rows = spark.range(0, 40_000, 1, 20).withColumnRenamed("id", "row")
    few, least = topk_search.least_hashes(rows, 100), lambda d: d.orderBy(F.xxhash64("row")).limit(100).collect()
    assert 300 < few.count() < 500 and least(few) == least(rows)
    assert topk_search.least_hashes(rows.limit(399), 100).count() == 399
