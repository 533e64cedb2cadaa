"""Toxicity scores from weak supervision: voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

import dataclasses

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: The bound on labelled rows that are learnt from, about; which ones, a hash of doc_id decides.
ROWS = 20_000
#: The most features that are looked at, voters that vote, and features of the classifier; rows that make a feature count.
CANDIDATES, VOTERS, FEATURES, SUPPORT = 1 << 15, 256, 4096, 3
#: What is thought of the labels beforehand: how often they say toxic in the clean and in the toxic class, as if seen in so
#: many times the rows.
LABEL, SEEN = (0.01, 0.97), 1.0
#: Twice the information that two voters must share, in nats over all rows, for one to be taken as dependent on the other.
DEPENDENT = 10.0
#: Votes of a row that are counted apart.
COUNTS = 6
#: Lengths, in bytes, of the word beginnings that are patterns beside the words themselves.
BEGINNINGS = (4, 5, 6, 7, 8, 10)


@dataclasses.dataclass(frozen=True)
class Model:
    """A linear classifier: sorted feature hashes with their weights, and a bias. The voters' estimates come along."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    voters: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(0, np.uint64))
    rates: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros((0, 2)))
    parents: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(0, np.int64))


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[ord("0") : ord("9") + 1] = table[ord("a") : ord("z") + 1] = table[128:] = True
    return table


def features(column, wanted: np.ndarray | None = None):
    """For every chunk of rows of a text column: first row, number of rows, and sorted distinct (row, feature hash) pairs.

    Features are the lower-case words (letters, digits, whatever is not ASCII) and their beginnings. With wanted, only
    those in this sorted array, as indices into it.
    """
    import pyarrow.compute as pc

    data, offsets = common.text_buffers(pc.utf8_lower(column))
    letters = _letters()
    if wanted is not None:
        gate = np.zeros(1 << 16, bool)
        gate[wanted >> np.uint64(48)] = True
    for lo, hi in common.chunks(offsets):
        part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        if not len(part):
            yield lo, hi - lo, np.zeros(0, np.int64), np.zeros(0, np.uint64)
            continue
        starts, stops, _ = common.words(part, at, letters)
        row = np.searchsorted(at, starts, side="right") - 1
        rows, hashes = [row], [common.word_hashes(part, starts, stops)]
        for n in BEGINNINGS:
            longer = np.flatnonzero(stops - starts > n)
            rows.append(row[longer])
            hashes.append(common.word_hashes(part, starts[longer], starts[longer] + n))
        row, found = np.concatenate(rows), np.concatenate(hashes)
        if wanted is not None:
            near = np.flatnonzero(gate[found >> np.uint64(48)])
            row, found = row[near], found[near]
            index = np.minimum(np.searchsorted(wanted, found), max(0, len(wanted) - 1))
            near = wanted[index] == found if len(wanted) else np.zeros(0, bool)
            row, found = row[near], index[near].astype(np.uint64)
        order = np.lexsort((found, row))
        row, found = row[order], found[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
        yield lo, hi - lo, row[first], found[first]


def labelled(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> DataFrame:
    """text and toxic of about `rows` labelled documents that are not held out, the same on every run.

    Rows of labels without doc_id or toxic are left out; of several for one doc_id the greatest counts. All documents of a
    labelled doc_id are taken, repeated ones too; those without doc_id never.
    """
    labels = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    found = labels.count()
    share = min(1.0, rows / max(1, found))
    labels = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    # bounded by `rows`, about, so it may be sent to every executor
    return docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("doc_id", "text", "toxic")


def held_out():
    """The rows from which no label is learnt."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = ROWS, candidates: int = CANDIDATES, voters: int = VOTERS, size: int = FEATURES) -> Model:
    """Learn a model from a bounded sample of the labelled rows.

    Lexicon voters are words, pattern voters are word beginnings: those most typical of rows labelled toxic. What explains
    their votes is label_model(); the label is one more voter of it, whose errors are estimated too. The classifier is a
    logistic regression on the posteriors over all chosen features. Null and empty texts have no features; null, repeated
    and conflicting labels are as in labelled(). Without labels of both kinds, or without documents, every score is the
    share of toxic labels. The driver holds the features of `rows` rows that are among the `candidates`.
    """
    import pyarrow as pa

    sample = labelled(docs, labels, rows)

    def counted(batches):
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False) == 1
            for lo, _, row, found in features(batch.column("text")):
                hashes, at = np.unique(found, return_inverse=True)
                n, of_toxic = np.bincount(at, minlength=len(hashes)), np.bincount(at, toxic[lo + row], len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), *[pa.array(x.astype(np.int64)) for x in (of_toxic, n - of_toxic)]], names=["feature", "t", "c"])

    rows_of = {r["toxic"] == 1: r["count"] for r in sample.groupBy((F.col("toxic") == 1).alias("toxic")).count().collect()}
    found = sample.select("text", "toxic").mapInArrow(common.trimmed(counted), "feature long, t long, c long").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    # the order in which learn() takes them, so that none that it would take of all is cut
    odds = F.log((F.col("t") + 0.1) / (rows_of.get(True, 0) + 0.2)) - F.log((F.col("c") + 0.1) / (rows_of.get(False, 0) + 0.2))
    top = found.filter(F.col("t") >= SUPPORT).orderBy((odds > 1.0).desc(), (odds * F.sqrt("t")).desc(), "feature").limit(candidates).select("feature").toPandas()
    wanted = np.sort(top["feature"].to_numpy(np.int64).view(np.uint64))

    def present(batches):
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
            for lo, n, row, index in features(batch.column("text"), wanted):
                ends = np.searchsorted(row, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays([pa.array(toxic[lo : lo + n].astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(index.astype(np.int32)))], names=["toxic", "found"])

    table = sample.select("text", "toxic").mapInArrow(common.trimmed(present), "toxic int, found array<int>").toArrow()
    label = table.column("toxic").to_numpy().astype(float)
    found = table.column("found").combine_chunks()
    found = found if isinstance(found, pa.Array) else pa.concat_arrays(found.chunks)
    row = np.repeat(np.arange(len(label)), np.diff(found.offsets.to_numpy())) if len(label) else np.zeros(0, np.int64)
    return learn(wanted, row, found.flatten().to_numpy(), label, voters, size)


def learn(wanted: np.ndarray, row: np.ndarray, column: np.ndarray, label: np.ndarray, voters: int = VOTERS, size: int = FEATURES) -> Model:
    """The model of a sparse table: features `column` present in rows `row`."""
    n, pos = len(label), float(label.sum())
    prior = min(0.5, pos / (n + 1.0)) if pos else 0.0
    if not pos or pos == n or not len(wanted):
        return Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log((prior + 1e-6) / (1 - prior + 1e-6))))
    in_toxic = np.bincount(column, label[row], len(wanted))
    in_clean = np.bincount(column, 1 - label[row], len(wanted))
    odds = np.log((in_toxic + 0.1) / (pos + 0.2)) - np.log((in_clean + 0.1) / (n - pos + 0.2))
    good = np.flatnonzero((odds > 1.0) & (in_toxic >= SUPPORT))
    good = good[np.argsort(-odds[good] * np.sqrt(in_toxic[good]), kind="stable")[:size]]
    back = np.full(len(wanted), -1)
    back[good] = np.arange(len(good))
    use = back[column] >= 0
    row, column = row[use], back[column[use]]
    m = min(voters, len(good))
    votes = np.zeros((n, m), np.float32)
    votes[row[column < m], column[column < m]] = 1
    posterior, rates, parents = label_model(votes, label)
    weights, bias = regression(row, column, posterior, len(good))
    order = np.argsort(wanted[good])
    return Model(wanted[good][order], weights[order], bias, wanted[good[:m]], rates, parents)


def label_model(votes: np.ndarray, label: np.ndarray, rounds: int = 20) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 per row, the rates of the voters (last: the label) in the two classes, and the voters' parents.

    A generative model of the true class, the votes and the label, estimated by EM. Lexicon and pattern voters vote for
    class 1 or abstain. A tree of the strongest dependences within the classes gives voters parents: their correlations.
    The class tells how many voters vote without their parent (COUNTS and more alike), then which ones: their accuracies;
    and how often a voter votes beside its parent. So a voter adds little beside one that it always votes with, and one
    vote in a text is not what five are. The label XX
    """
    n, m = votes.shape
    share = np.clip(label.mean(), 1e-4, 0.5)
    rates = np.stack([((1 - label) @ votes + 0.05) / ((1 - label).sum() + 1), (label @ votes + 0.05) / (label.sum() + 1)], 1)
    # to start with, what the label says by its prior rates
    p = share * np.where(label > 0, LABEL[1], 1 - LABEL[1])
    p = p / (p + (1 - share) * np.where(label > 0, LABEL[0], 1 - LABEL[0]))
    parents = _parents(votes, p)
    has = np.flatnonzero(parents >= 0)
    with_parent = votes[:, has] * votes[:, parents[has]]
    alone_votes = votes.copy()
    alone_votes[:, has] -= with_parent
    count = np.minimum(alone_votes.sum(1), COUNTS).astype(int)
    told = np.zeros(2)
    for _ in range(rounds):
        share = np.clip(p.mean(), 1e-4, 0.5)
        alone, beside, counts = np.zeros((m, 2)), np.zeros((len(has), 2)), np.zeros((COUNTS + 1, 2))
        for k, q in ((0, 1 - p), (1, p)):
            rates[:, k] = (q @ votes + 0.05) / (q.sum() + 1)
            which = q @ alone_votes + 1
            alone[:, k] = which / which.sum()
            beside[:, k] = (q @ with_parent + rates[has, k]) / ((q @ votes)[parents[has]] + 1)
            counts[:, k] = (np.bincount(count, q, COUNTS + 1) + 1) / (q.sum() + COUNTS + 1)
            told[k] = (q @ label + SEEN * n * LABEL[k]) / (q.sum() + SEEN * n)
        logit = np.log(share / (1 - share)) + np.log(counts[:, 1] / counts[:, 0])[count]
        logit = logit + alone_votes @ np.log(alone[:, 1] / alone[:, 0]) + with_parent @ np.log(beside[:, 1] / beside[:, 0])
        p = _sigmoid(logit + label * np.log(told[1] / told[0]) + (1 - label) * np.log((1 - told[1]) / (1 - told[0])))
    return p, np.vstack([rates, told]), parents


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _parents(votes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The parent of each voter, -1 for none: a spanning forest of greatest mutual information within the classes."""
    n, m = votes.shape
    shared = np.zeros((m, m))
    for q in (1 - p, p):
        size = q.sum() + 1e-9
        one = (q @ votes) / size
        both = (votes * q[:, None].astype(np.float32)).T @ votes / size
        cells = [(both, one[:, None] * one), (one[:, None] - both, one[:, None] * (1 - one)), (one - both, (1 - one)[:, None] * one), (1 - one[:, None] - one + both, (1 - one)[:, None] * (1 - one))]
        shared += size * sum(np.where(x > 1e-9, x * np.log(np.maximum(x, 1e-12) / np.maximum(y, 1e-12)), 0) for x, y in cells)
    parents, best, near, open_ = np.full(m, -1), np.full(m, -1.0), np.full(m, -1), np.ones(m, bool)
    for _ in range(m):
        i = int(np.argmax(np.where(open_, best, -np.inf)))
        open_[i] = False
        if 2 * best[i] >= DEPENDENT:
            parents[i] = near[i]
        closer = shared[i] > best
        best, near = np.where(closer, shared[i], best), np.where(closer, i, near)
    return parents


def regression(row: np.ndarray, column: np.ndarray, goal: np.ndarray, m: int, rounds: int = 300, penalty: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels over a sparse 0/1 table, by Adam on the whole of it."""
    n = len(goal)
    w, b = np.zeros(m), float(np.log((goal.mean() + 1e-4) / (1 - goal.mean() + 1e-4)))
    m1, m2 = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1):
        z = b + np.bincount(row, w[column], n)
        g = _sigmoid(z) - goal
        grad = np.append(np.bincount(column, g[row], m) + penalty * w, g.sum()) / n
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.99 * m2 + 0.01 * grad * grad
        step = 0.1 * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:m], b - step[m]
    return w, float(b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1) and predicted (1 from 0.5 on), from the whole text alone.

    A null or empty text has the score of no feature at all. Columns of these names are replaced; repeated rows are scored
    each; an empty table gives one.
    """
    import pyarrow as pa

    kept = [f for f in docs.schema.fields if f.name.lower() not in ("score", "predicted")]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches):
        for batch in batches:
            z = np.full(batch.num_rows, model.bias)
            for lo, n, row, index in features(batch.column("text"), model.features):
                if len(row):
                    z[lo : lo + n] += np.bincount(row, model.weights[index.astype(np.int64)], n)
            p = _sigmoid(z)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)

    return docs.select(*[f.name for f in kept]).mapInArrow(common.trimmed(run), schema)


def op3(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
