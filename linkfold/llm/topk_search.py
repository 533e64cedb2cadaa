"""Exact top-k by inner product with block-at-a-time pruning."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .vectors import finite, packed

#: Vectors of a block, of a range that is stored as one row, and ranges that a task goes through with one pack of queries.
BLOCK, RANGE, GROUP = 64, 4096, 8
#: Queries of a pack; vectors that lend their direction to the order of documents (a sample of so many at most).
QUERIES, PIVOTS = 256, 64
#: Blocks of a query that are scored before its bounds are looked at again; vectors of which its first kth score is made.
STEP, SEED = 4, 1024


def ordered(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """rows(id, v) with cell: the pivot of most similar direction, and rank: its similarity in thousandths."""
    schema = T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType())])

    def run(batches):
        for batch in batches:
            x = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            cell = (x @ pivots.T).argmax(1) if len(pivots) else np.zeros(batch.num_rows, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=schema.names)

    return rows.mapInArrow(common.trimmed(run), schema)


def least_hashes(rows: DataFrame, n: int) -> DataFrame:
    """Some four times n of rows(row, ...), the n of least hash among them; all, if there are not more.

    Each task sends what it finds to the driver, n rows at most: of many tasks that would be more than the driver holds.
    """
    share = 4 * n / max(1, rows.count())
    return rows if share >= 1 else rows.filter(F.xxhash64("row") < F.lit(int((share * 2 - 1) * 2**63)))


class Top:
    """The k best candidates so far of each query of a pack. floor: a score that k candidates of each query are known to have."""

    def __init__(self, ids: np.ndarray, matrix: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.q, self.k = ids, matrix, k
        self.score = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor
        self.up, self.down, self.norm = np.maximum(matrix, 0), np.minimum(matrix, 0), np.linalg.norm(matrix, axis=1)

    def least(self, live) -> np.ndarray:
        """What a candidate must score to be of use: an equal score may still win by its smaller id."""
        return np.maximum(self.score[live, -1], self.floor[live])

    def look(self, ids: np.ndarray, matrix: np.ndarray, block: int) -> int:
        """Go through the blocks of one range, STEP of each query's best at a time; how many (query, block) were scored."""
        n = len(ids)
        starts = np.arange(0, n, block)
        most, least = np.maximum.reduceat(matrix, starts), np.minimum.reduceat(matrix, starts)
        bound = self.up @ most.T + self.down @ least.T  # the sums of each dimension's greatest terms
        centres = np.add.reduceat(matrix, starts) / np.diff(np.append(starts, n))[:, None]
        far = np.sqrt(np.maximum.reduceat(((matrix - np.repeat(centres, np.diff(np.append(starts, n)), 0)) ** 2).sum(1), starts))
        # nor more than the centre and the way to the farthest vector; with room for rounding
        bound = np.minimum(bound, (self.q @ centres.T + self.norm[:, None] * far) * (1 + 1e-9) + 1e-6)
        order = np.argsort(-bound, axis=1, kind="stable")
        live, scored = np.arange(len(self.ids)), 0
        for at in range(0, len(starts), STEP):
            live = live[bound[live, order[live, at]] >= self.least(live)]  # bounds fall: all further blocks are below too
            if not len(live):
                break
            own = order[live, at : at + STEP]
            wanted = np.zeros((len(live), len(starts)), bool)
            np.put_along_axis(wanted, own, np.take_along_axis(bound[live], own, 1) >= self.least(live)[:, None], 1)
            for b in np.flatnonzero(wanted.any(0)):
                scored += self._score(live[wanted[:, b]], ids[starts[b] : starts[b] + block], matrix[starts[b] : starts[b] + block])
        return scored

    def _score(self, live: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> int:
        s = self.q[live] @ matrix.T
        s[self.ids[live][:, None] == ids[None, :]] = -np.inf
        better = (s >= self.least(live)[:, None]).any(1)
        live, s = live[better], s[better]
        if len(live):
            scores = np.concatenate((self.score[live], s), 1)
            found = np.concatenate((self.found[live], np.broadcast_to(ids, s.shape)), 1)
            order = np.lexsort((found, -scores), axis=1)[:, : self.k]
            self.score[live], self.found[live] = np.take_along_axis(scores, order, 1), np.take_along_axis(found, order, 1)
        return len(better)

    def rows(self):
        q, at = np.nonzero(np.isfinite(self.score))
        return pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(self.found[q, at]), pa.array(self.score[q, at].astype(np.int64))], names=["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, block: int = BLOCK, span: int = RANGE, repeated: bool = False) -> DataFrame:
    """query_id, rank, vec_id and score: the k greatest inner products of each query with all vectors but that of its own id.

    vectors and queries have (vec_id, v), v an array of whole numbers as doubles, of one length within each (sums below
    2**53 are exact); other lengths are matched among themselves. Ties go to the smaller vec_id; a query has fewer rows
    if there are fewer vectors. Rows without vec_id, and vectors that are null, empty or hold null or non-finite
    components take no part. Rows of one vec_id are one vector, the least; with `repeated` (the rule of OP6_SQL) every row
    takes part, and the query rows of one vec_id are ranked together. An empty table gives an empty one.

    Vectors are put in order of direction and cut into ranges, ranges into blocks. A block's bound for a query is the sum
    over dimensions of the largest term that any of its vectors can add, or what its centre and radius allow if that is
    less. Each query goes through the blocks by its own falling bounds, from the blocks' own matrices, until no bound
    reaches its kth score; a sample of SEED vectors gives it a first one. All queries meet all ranges, pack by pack; what a
    task holds is one pack, one range and the sample. Vectors without any order, as random ones in many dimensions, have
    bounds above all scores: then every block is scored.
    """
    spark = vectors.sparkSession

    def tidy(df):
        df = df.filter(F.col("vec_id").isNotNull() & finite("v"))
        if repeated:
            df = df.select("vec_id", "v", F.monotonically_increasing_id().alias("row"))
        else:
            df = df.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("row", F.col("vec_id"))
        return df.withColumn("dim", F.size("v"))

    vectors, queries = common.written(tidy(vectors), "vectors"), common.written(tidy(queries), "queries")
    out = None
    for (dim,) in vectors.select("dim").distinct().collect():
        x = vectors.filter(F.col("dim") == dim).select("vec_id", "v", "row")
        picked = least_hashes(x, max(SEED, PIVOTS)).orderBy(F.xxhash64("row")).limit(max(SEED, PIVOTS)).collect()
        seeds = np.array([r.vec_id for r in picked], np.int64), np.array([r.v for r in picked], float)
        sample = seeds[1][:PIVOTS]
        pivots = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-9)
        x = common.written(ordered(x, pivots), "ordered")
        counts = {r["cell"]: r["count"] for r in x.groupBy("cell").count().collect()}  # PIVOTS rows at most
        many = {c: -(-n // span) for c, n in counts.items()}
        first = dict(zip(many, np.cumsum([0, *many.values()])[:-1].tolist(), strict=True))
        of = lambda d: F.create_map(*[F.lit(z) for c in d for z in (c, d[c])])[F.col("cell")]
        x = x.withColumn("range", (of(first) + F.pmod(F.xxhash64("row"), of(many))).cast("int"))
        ranges = packed(x, ["range"], ["vec_id"], "<f8").withColumn("group", F.floor(F.col("range") / GROUP).cast("int"))
        groups = -(-sum(many.values()) // GROUP)
        q = queries.filter(F.col("dim") == dim).select("vec_id", "v", "row")
        packs = max(1, -(-q.count() // QUERIES))
        q = packed(q.withColumn("pack", F.pmod(F.xxhash64("row"), F.lit(packs)).cast("int")), ["pack"], ["vec_id"], "<f8")
        q = q.select("pack", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
        # never broadcast: the packs stand once for each group, which no estimate of their size counts
        part = q.hint("merge").join(ranges, "group").select("pack", "group", "q_ids", "q_data", "ids", "data").mapInArrow(common.trimmed(_search(dim, k, block, seeds)), "query_id long, vec_id long, score long")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(dim: int, k: int, block: int, seeds: tuple[np.ndarray, np.ndarray]):
    def floor(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
        """The kth score among the sample, without the query's own rows."""
        if len(seeds[0]) < k:
            return np.full(len(ids), -np.inf)
        s = matrix @ seeds[1].T
        s[ids[:, None] == seeds[0][None, :]] = -np.inf
        return -np.partition(-s, k - 1, axis=1)[:, k - 1]

    def run(batches):
        held, top = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                key = (batch.column("pack")[row].as_py(), batch.column("group")[row].as_py())
                if key != held:
                    if top is not None:
                        yield top.rows()
                    held = key
                    pack = _matrix(batch, row, "q_ids", "q_data", dim)
                    top = Top(*pack, k, floor(*pack))
                top.look(*_matrix(batch, row, "ids", "data", dim), block)
        if top is not None:
            yield top.rows()

    return run


def _matrix(batch, row: int, ids: str, data: str, dim: int):
    return np.frombuffer(batch.column(ids)[row].as_buffer(), np.int64), np.frombuffer(batch.column(data)[row].as_buffer(), "<f8").reshape(-1, dim)


def op6(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = rows.filter(finite("embedding")).select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 64).cast("double")).alias("v"))
    return top_k(rows, rows.filter(F.col("vec_id") % 20 == 0), repeated=True)


#: DuckDB SQL for op6.
OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
