"""Near-duplicate vectors by a pigeonhole join over subspaces."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components
from .vectors import finite, packed

#: Subspaces, and vectors of a pack.
BLOCKS, PACK = 4, 2048
#: Vectors of a pack that are passed over together where they are too far.
GROUP = 128
#: Candidates that are verified together.
SLICE = 1 << 16
#: What distances may be off by rounding.
MARGIN = 1e-6
FOUND = "a struct<o:bigint,h:bigint>, b struct<o:bigint,h:bigint>, others long"


def rotation(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Axes (as columns) of greatest variance first, and the variances, from sums over all unit vectors."""

    def run(batches):
        total, n, outer = np.zeros(dim), 0, np.zeros((dim, dim))
        for batch in batches:
            x = _unit(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))
            total, n, outer = total + x.sum(0), n + len(x), outer + x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(([n], total, outer.ravel()))], pa.list_(pa.float64()))], names=["sums"])

    # dim * dim numbers of each task, summed in place: not the vectors
    sums = vectors.select("v").mapInArrow(common.trimmed(run), "sums array<double>").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).orderBy("pos").toArrow()
    sums = sums.column("s").to_numpy()
    n, mean, outer = max(sums[0], 1), sums[1 : dim + 1], sums[dim + 1 :].reshape(dim, dim)
    values, axes = np.linalg.eigh(outer / n - np.outer(mean / n, mean / n))
    return axes[:, ::-1], np.maximum(values[::-1], 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(float)
    scale = np.abs(x).max(1, keepdims=True)
    x = x / np.where(scale > 0, scale, 1)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def near_duplicates(vectors: DataFrame, cosine: float = 0.9, blocks: int = BLOCKS, pack: int = PACK) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of vectors(vec_id, v).

    Two vectors are linked if their cosine, in double precision, is `cosine` (above 0) or more; n_links counts the other
    rows that a row is linked with, component_id is the least vec_id that links lead to. Vectors that are null, empty, zero, or hold
    null or non-finite components are linked with nothing; nor are vectors of unequal lengths. Equal vectors are linked
    with each other and are one node; a null vec_id is never the least but where there is no other. Other columns are
    dropped; an empty table gives one.

    Unit vectors are rotated to their axes of greatest variance and split into `blocks` subspaces. A cosine of c is a
    squared distance of 2 - 2c in all; of it each subspace has a budget in proportion to its variance. A pair within the
    whole budget is within that of one subspace at least, so the range joins of all subspaces find every pair. A range join
    deals vectors into cells of the subspace's first axis as wide as the root of its budget, cells into packs of bounded
    size, and joins packs of the same and of neighbouring cells. Within a pair of packs, groups of vectors that stand
    together are passed over if their centres and radii part them, and distances in the subspace leave the candidates of
    the rest (of vectors without clusters in many dimensions nearly all groups are looked at, as no axis parts them); a candidate that an earlier subspace finds too is its, and the rest are verified by the exact cosine at
    once, so no candidate is ever moved. Links are not moved either: a pair of packs gives, for each of its vectors that has
    links in it, their number and one link to the least vector of its component in that pair. So what it gives grows with
    the vectors, however many of them are near copies of each other.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.when(finite("v") & F.exists("v", lambda x: x != 0), F.col("v")).alias("v"))
    good = rows.filter(F.col("v").isNotNull())
    nodes = good.groupBy("v").agg(F.coalesce(F.min("vec_id"), F.lit((1 << 63) - 1)).alias("node"), F.count(F.lit(1)).alias("n"))
    # rows of one vec_id can have unequal vectors, so the vector's hash is part of the node's name
    nodes = nodes.select("v", F.struct(F.col("node").alias("o"), F.xxhash64("v").alias("h")).alias("node"), "n", F.size("v").alias("dim"))
    nodes = common.written(nodes, "nodes")
    found = None
    for (dim,) in nodes.select("dim").distinct().collect():
        part = _links(nodes.filter(F.col("dim") == dim).select("node.o", "node.h", "n", "v"), dim, cosine, min(blocks, dim), pack)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    found = common.written(found, "vector-links")
    others = found.groupBy(F.col("a").alias("node")).agg(F.sum("others").alias("_others"))
    whole = components(found.filter("b is not null").select("a", "b"))
    told = nodes.select("v", "node", "n").join(others, "node", "left").join(whole, "node", "left")
    told = told.select(F.col("v").alias("_v"), (F.col("n") - 1 + F.coalesce("_others", F.lit(0))).alias("_links"), F.coalesce("component", "node")["o"].alias("_component"))
    out = rows.join(told, rows.v == told["_v"], "left")
    component = F.when(F.col("_component") == (1 << 63) - 1, None).otherwise(F.coalesce("_component", "vec_id"))
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def _links(nodes: DataFrame, dim: int, cosine: float, blocks: int, pack: int) -> DataFrame:
    """(a, b, others) of nodes(o, h, n, v) of one length: others of the n rows of other nodes are linked with a; a and b are
    structs (o, h), and all b (null if there is none) connect what links connect."""
    axes, variances = rotation(nodes, dim)
    edges = [round(dim * b / blocks) for b in range(blocks + 1)]
    total = max(variances.sum(), 1e-12)
    share = np.array([max(variances[i:j].sum() / total, 0.02) for i, j in zip(edges[:-1], edges[1:], strict=True)])
    budget = (2 - 2 * cosine) * share / share.sum() + MARGIN
    width = np.sqrt(budget)

    schema = T.StructType([nodes.schema["o"], nodes.schema["h"], nodes.schema["n"], nodes.schema["v"], T.StructField("block", T.IntegerType()), T.StructField("cell", T.IntegerType())])

    def cells(batches):
        for batch in batches:
            x = _unit(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)) @ axes[:, edges[:-1]]
            for b in range(blocks):
                cell = np.floor(x[:, b] / width[b]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column("o"), batch.column("h"), batch.column("n"), batch.column("v"), pa.array(np.full(len(cell), b, np.int32)), pa.array(cell)], names=schema.names)

    dealt = nodes.mapInArrow(common.trimmed(cells), schema)
    # a cell for each width between -1 and 1 and subspace: a few dozen rows, whatever the input
    counts = {(r["block"], r["cell"]): r["count"] for r in dealt.groupBy("block", "cell").count().collect()}
    if not counts:
        return nodes.sparkSession.createDataFrame([], FOUND)
    many = F.create_map(*[z for (b, c), n in counts.items() for z in (F.lit(f"{b}/{c}"), F.lit(math.ceil(n / pack)))])[F.concat_ws("/", "block", "cell")]
    dealt = dealt.withColumn("chunk", F.pmod(F.xxhash64("o", "h"), many).cast("int"))
    packs = common.written(packed(dealt, ["block", "cell", "chunk"], ["o", "h", "n"], "<f8" if "double" in nodes.schema["v"].dataType.simpleString() else "<f4"), "packs")
    right = packs.select("block", F.explode(F.array("cell", F.col("cell") - 1)).alias("at"), F.col("cell").alias("cell2"), F.col("chunk").alias("chunk2"), F.col("ids").alias("ids2"), F.col("data").alias("data2"))
    pairs = packs.withColumnRenamed("cell", "at").join(right, ["block", "at"]).filter((F.col("cell2") > F.col("at")) | (F.col("chunk2") >= F.col("chunk")))
    kind = "<f8" if "double" in nodes.schema["v"].dataType.simpleString() else "<f4"

    def verify(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                ids, ids2 = (np.frombuffer(batch.column(c)[row].as_buffer(), np.int64).reshape(-1, 3) for c in ("ids", "ids2"))
                x, y = (_unit(np.frombuffer(batch.column(c)[row].as_buffer(), kind).reshape(-1, dim)) for c in ("data", "data2"))
                same = batch.column("cell2")[row].as_py() == batch.column("at")[row].as_py() and batch.column("chunk2")[row].as_py() == batch.column("chunk")[row].as_py()
                block = batch.column("block")[row].as_py()
                xr, yr = x @ axes, y @ axes
                i, j = edges[block], edges[block + 1]
                p, q, _ = _close(xr[:, i:j], yr[:, i:j], budget[block])
                if same:
                    p, q = p[p < q], q[p < q]
                found = []
                for at in range(0, len(p), SLICE):  # a pair of packs of near copies has millions of candidates
                    u, w = p[at : at + SLICE], q[at : at + SLICE]
                    d = xr[u] - yr[w]
                    d *= d
                    by = np.stack([d[:, a:b].sum(1) <= budget[k] for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))], 1)
                    own = by[:, block] & ~by[:, :block].any(1)
                    u, w = u[own], w[own]
                    found.append(at + np.flatnonzero(own)[np.einsum("ij,ij->i", x[u], y[w]) >= cosine])
                good = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield _summed(ids, ids2, p[good], q[good], same)

    return pairs.select("block", "at", "cell2", "chunk", "chunk2", "ids", "data", "ids2", "data2").mapInArrow(common.trimmed(verify), FOUND)


def _grouped(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """An order of rows in which those nearest to one of a few of them, far from each other, stand together; the first of
    every GROUP of them, and each group's centre and radius."""
    nearest, own, at = np.full(len(u), np.inf), np.zeros(len(u), np.int64), 0
    for k in range(len(u) // GROUP):
        d = ((u - u[at]) ** 2).sum(1)
        own, nearest = np.where(d < nearest, k, own), np.minimum(d, nearest)
        at = int(nearest.argmax())
    order = np.argsort(own, kind="stable")
    starts = np.arange(0, len(u), GROUP)
    sizes = np.diff(np.append(starts, len(u)))
    centres = np.add.reduceat(u[order], starts) / sizes[:, None]
    far = np.sqrt(np.maximum.reduceat(((u[order] - np.repeat(centres, sizes, 0)) ** 2).sum(1), starts))
    return order, starts, centres, far


def _close(u: np.ndarray, w: np.ndarray, budget: float) -> tuple[np.ndarray, np.ndarray, int]:
    """The rows p of u and q of w whose squared distance may be within the budget, and how many pairs were looked at.

    Groups that are too far from each other by their centres and radii are passed over. Distances are in single precision,
    with room for its rounding; what is found is looked at again.
    """
    a, a_starts, a_centres, a_far = _grouped(u)
    b, b_starts, b_centres, b_far = _grouped(w)
    gap = np.sqrt(np.maximum(((a_centres[:, None, :] - b_centres[None, :, :]) ** 2).sum(2), 0)) - a_far[:, None] - b_far[None, :]
    meet = gap <= math.sqrt(budget) + 1e-6
    x, y = u[a].astype(np.float32), w[b].astype(np.float32)
    xx, yy = (x * x).sum(1), (y * y).sum(1)
    ps, qs, looked = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    group_of = np.arange(len(y)) // GROUP
    for i, at in enumerate(a_starts.tolist()):
        cols = np.flatnonzero(meet[i][group_of]) if not meet[i].all() else slice(None)
        part = y[cols]
        if len(part):
            rows = slice(at, at + GROUP)
            near = (x[rows] @ part.T) * 2 >= (xx[rows][:, None] + yy[cols][None, :]) - np.float32(budget + 1e-5)
            looked += near.size
            p, q = np.nonzero(near)
            ps.append(a[at + p])
            qs.append(b[q if isinstance(cols, slice) else cols[q]])
    return np.concatenate(ps), np.concatenate(qs), looked


def _summed(ids: np.ndarray, ids2: np.ndarray, p: np.ndarray, q: np.ndarray, same: bool) -> pa.RecordBatch:
    """What a pair of packs gives, from its links p-q: a row for each vector that has any."""
    every = ids if same else np.concatenate((ids, ids2))
    u, w = np.concatenate((p, q if same else q + len(ids))), np.concatenate((q if same else q + len(ids), p))
    others = np.bincount(u, every[w, 2], len(every)).astype(np.int64) if len(u) else np.zeros(len(every), np.int64)
    label = np.arange(len(every))
    while len(u):
        new = label.copy()
        np.minimum.at(new, u, label[w])
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(others)
    node = lambda i, mask=None: pa.StructArray.from_arrays([pa.array(every[i, 0]), pa.array(every[i, 1])], names=["o", "h"], mask=mask)
    return pa.RecordBatch.from_arrays([node(at), node(label[at], pa.array(label[at] == at)), pa.array(others[at])], names=["a", "b", "others"])


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.col("embedding").alias("v")))


#: DuckDB SQL for op9: all pairs, and all that can be reached. For tables in which vec_id is unique.
OP9_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), r AS (
  SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.y, r.c FROM r JOIN l ON r.vec_id = l.x
), n AS (
  SELECT x, count(*) AS n FROM l GROUP BY x
)
SELECT vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(c) AS component_id, vec_id = min(c) AS kept
FROM r LEFT JOIN n ON x = vec_id GROUP BY vec_id
"""
