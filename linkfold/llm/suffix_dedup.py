"""Removing byte strings that stand at more than one place, by a distributed merge sort of suffixes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, windows

#: Bytes of a window; bytes that suffixes must share to be compared.
WIDTH, GRAM = 200, 48
#: Up to so many suffixes with one beginning are compared by pairs, more by a sweep: the same windows are found.
PAIRS = 32
#: Different suffixes with one beginning that one task takes; what has more is first split by its next bytes.
KINDS = 1 << 14
#: Suffixes of a sorted run, and about the number that one task merges.
RUN, MERGE = 1 << 15, 1 << 15


def lcp(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the longest common prefix of a and b, of which `known` bytes are known to be equal."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(suffixes: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Sorted suffixes as the length that each shares with the one before it, and the rest."""
    shared, rest, before = [], [], b""
    for s in suffixes:
        n = lcp(before, s)
        shared.append(n)
        rest.append(s[n:])
        before = s
    return shared, rest


class Run:
    """A reader of one front-coded run."""

    __slots__ = ("at", "end", "rest", "shared", "text")

    def __init__(self, at: int, end: int, shared, rest):
        self.at, self.end, self.shared, self.rest, self.text = at, end, shared, rest, b""

    def step(self) -> int:
        """Read the suffix at `at`; what it shares with the one before in its run."""
        n = self.shared[self.at]
        self.text = self.text[:n] + self.rest[self.at]
        return n


def merge(runs: list[Run]):
    """Yields (place, suffix, what it shares with the one yielded before) of all runs in order.

    A loser tree whose players carry what they share with the last winner. Of two players the one that shares more is the
    smaller, without a look at either; only if both share as much are they compared, from there on. So no prefix that is
    known is compared again.
    """
    runs = [r for r in runs if r.at < r.end]
    k = 1
    while k < len(runs):
        k *= 2
    share = [-1] * k  # -1: nothing left
    for i, r in enumerate(runs):
        r.step()
        share[i] = 0

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = share[a], share[b]
        if x != y:
            return (a, b) if x > y else (b, a)
        if x < 0:
            return a, b
        s, t = runs[a].text, runs[b].text
        n = lcp(s, t, x)
        if (s[n : n + 1], a) <= (t[n : n + 1], b):
            share[b] = n
            return a, b
        share[a] = n
        return b, a

    tree, level = [0] * k, list(range(k))
    while len(level) > 1:
        nxt = []
        for i in range(0, len(level), 2):
            w, loser = play(level[i], level[i + 1])
            tree[len(level) // 2 + i // 2] = loser
            nxt.append(w)
        level = nxt
    winner = level[0]
    while runs and share[winner] >= 0:
        r = runs[winner]
        yield r.at, r.text, share[winner]
        r.at += 1
        share[winner] = r.step() if r.at < r.end else -1
        node = (winner + k) // 2
        while node:
            winner, tree[node] = play(winner, tree[node])
            node //= 2


def group_windows(lefts: list[bytes], shares: list[int], bounds: list[tuple[int, int]], width: int) -> list[list[tuple[int, int]]]:
    """For suffixes with one beginning, in order: distances of the anchor from the start of repeated windows.

    lefts are what stands before the anchors, backwards; shares[i] is what suffix i shares with i - 1; bounds are the least
    and greatest distance that the windows of each have. A window at distance d of two places is equal if they share d
    bytes to the left and width - d from the anchor on.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in lefts]
    if len(lefts) > PAIRS:
        return _sweep(lefts, shares, bounds, width, found)
    for i in range(len(lefts)):
        right = 1 << 60
        for j in range(i + 1, len(lefts)):
            right = min(right, shares[j])
            lo, hi = max(width - right, bounds[i][0], bounds[j][0]), min(bounds[i][1], bounds[j][1])
            if lo <= hi and (hi := min(hi, lcp(lefts[i], lefts[j]))) >= lo:
                found[i].append((lo, hi))
                found[j].append((lo, hi))
    return found


def _sweep(lefts: list[bytes], shares: list[int], bounds: list[tuple[int, int]], width: int, found: list[list[tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """group_windows() for many suffixes: for each distance, those alike on both sides are neighbours in both orders."""
    k = len(lefts)
    order = sorted(range(k), key=lefts.__getitem__)
    left = np.array([0] + [lcp(lefts[a], lefts[b]) for a, b in zip(order, order[1:], strict=False)])
    right, limits, rank = np.array(shares), np.array(bounds), np.empty(k, np.int64)
    for d in range(int(limits[:, 0].min()), int(limits[:, 1].max()) + 1):
        rank[order] = np.cumsum(left < d)
        has = np.flatnonzero((limits[:, 0] <= d) & (d <= limits[:, 1]))
        _, at, many = np.unique((np.cumsum(right < width - d) * (k + 1) + rank)[has], return_inverse=True, return_counts=True)
        for i in has[many[at] > 1].tolist():
            found[i].append((d, d))
    return found


def by_merge(candidates: DataFrame, docs: DataFrame, width: int, gram: int) -> DataFrame:
    """The windows (o, key, first, last) of candidates with n = 1 that stand at another candidate too.

    Each task sorts the suffixes that start at the anchors of its documents into runs and front-codes them; the runs are
    dealt out by gram, so suffixes that share their first `gram` bytes meet; each receiver merges its runs.
    """
    deals = max(common.parts(docs.sparkSession), -(-candidates.count() // MERGE))
    located = windows.with_text(candidates, docs, ["first", "last", "anchor", "gram", "n"])
    ids = [T.StructField("o", T.LongType()), T.StructField("key", T.LongType())]
    schema = T.StructType([T.StructField("deal", T.IntegerType()), T.StructField("run", T.LongType()), T.StructField("place", T.IntegerType()), T.StructField("shared", T.IntegerType()), T.StructField("rest", T.BinaryType()), T.StructField("left", T.BinaryType()), *ids, *[T.StructField(c, T.IntegerType()) for c in ("first", "last", "anchor")], T.StructField("only", T.BooleanType())])

    def runs(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        held: list[tuple] = []
        made = 0

        def flush():
            nonlocal made
            held.sort(key=lambda x: (x[0], x[1]))
            columns: list[list] = [[] for _ in schema]
            at = 0
            while at < len(held):
                end = at
                while end < len(held) and held[end][0] == held[at][0]:
                    end += 1
                shared, rest = front_code([x[1] for x in held[at:end]])
                columns[0] += [held[at][0]] * (end - at)
                columns[1] += [(TaskContext.get().partitionId() << 32) + made] * (end - at)
                columns[2] += range(end - at)
                columns[3] += shared
                columns[4] += rest
                for c, values in zip(columns[5:], list(zip(*held[at:end], strict=True))[2:], strict=True):
                    c += values
                at, made = end, made + 1
            held.clear()
            arrow = {"integer": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
            return pa.RecordBatch.from_arrays([pa.array(c, arrow.get(f.dataType.simpleString())) for c, f in zip(columns, schema, strict=True)], names=schema.names)

        for batch in batches:
            for text, found, o, key in zip(batch.column("text").cast(pa.binary()), batch.column("found"), batch.column("o"), batch.column("key"), strict=True):
                raw, o, key = text.as_py(), o.as_py(), key.as_py()
                for s in found.as_py():
                    held.append((s["gram"] % deals, raw[s["anchor"] : s["last"] + width], raw[s["first"] : s["anchor"]][::-1], o, key, s["first"], s["last"], s["anchor"], s["n"] == 1))
                    if len(held) >= RUN:
                        yield flush()
        if held:
            yield flush()

    out = T.StructType([*ids, T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())])

    def merged(table):
        import pyarrow as pa

        # an exchange does not keep the order of rows
        run = table.column("run").to_numpy()
        order = np.lexsort((table.column("place").to_numpy(), run))
        table = table.take(pa.array(order))
        run = run[order]
        edges = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1], [True]))).tolist()
        shared, rest, left = table.column("shared").to_pylist(), table.column("rest").to_pylist(), table.column("left").to_pylist()
        first, last, anchor = (table.column(c).to_numpy().tolist() for c in ("first", "last", "anchor"))
        only = table.column("only").to_pylist()
        places: list[int] = []
        starts: list[int] = []
        ends: list[int] = []

        def close():
            if len(group) > 1:
                for i, spans in zip(group, group_windows([left[i] for i in group], shares, [(anchor[i] - last[i], anchor[i] - first[i]) for i in group], width), strict=True):
                    if only[i]:
                        for lo, hi in spans:
                            places.append(i)
                            starts.append(anchor[i] - hi)
                            ends.append(anchor[i] - lo)

        group: list[int] = []
        shares: list[int] = []
        for at, _, share in merge([Run(a, b, shared, rest) for a, b in zip(edges[:-1], edges[1:], strict=True)]):
            if share < gram:
                close()
                group, shares = [], []
            group.append(at)
            shares.append(share)
        close()
        take = pa.array(places, pa.int64())
        return pa.Table.from_arrays([table.column("o").take(take), table.column("key").take(take), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=out.names)

    dealt = common.written(located.mapInArrow(common.trimmed(runs), schema), "suffix-runs")
    return dealt.groupBy("deal").applyInArrow(merged, out)


def deduplicated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with texts, kept: the bytes that no repeated window covers.

    A window is `width` consecutive bytes of the UTF-8 of one document. It is repeated if the same bytes also start anywhere
    else, in the same document or overlapping too; all its bytes go, in every place. Windows are judged on the input. A
    null or empty text has no bytes; one shorter than a window stays as it is. Rows of equal doc_id and text are two
    places. A null doc_id is an id like any other. Other columns are dropped; an empty table gives an empty one.

    Not every suffix is sorted, but those at the anchors of windows (see windows) that stand at more than one place and
    whose surroundings differ; where all is equal around them, all windows are. All suffixes that share their first `gram`
    bytes meet in one task. A beginning with more than KINDS different surroundings is split by longer ones: by those
    of blocks of its windows, then of single windows, which are counted and not gathered, so that none can fill a task.
    """
    keyed = windows.keyed(docs)
    found = common.written(windows.repeated(windows.all_stretches(keyed, "bytes", width, gram)), "repeated")
    whole, candidates = windows.judged_stretches(found)
    few = by_merge(candidates.filter(F.col("kinds") <= KINDS), keyed, width, gram)
    many = windows.by_window(candidates.filter(F.col("kinds") > KINDS), keyed, "bytes", width, gram)
    out = windows.without(keyed, whole.unionByName(few).unionByName(many), "bytes", width, texts)
    return out.withColumnRenamed("n_tokens", "n_bytes")


def op10(spark, sf_dir: str) -> DataFrame:
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), texts=False)
