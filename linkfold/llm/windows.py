"""Finding every fixed-length window of tokens that stands at more than one place of a corpus.

A window is `width` consecutive tokens (bytes or words) of one document. Each window has an anchor: the place of the least
hash of `gram` consecutive tokens in it, the first such place. Equal windows have their anchors at the same distance, so
only windows with equal grams at their anchors need to be compared, and all windows of a document with one anchor stand
side by side: a stretch, from first to last window. A stretch is written as one row, which is what keeps the exchange small:
about two for each `width - gram` tokens.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Tokens that are looked at together; longer documents go by in slices of so many windows.
SLICE = 1 << 16
_LOW = np.uint64((1 << 22) - 1)


def least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    step = 1
    while step * 2 <= width:
        h = np.minimum(h[:-step], h[step:])
        step *= 2
    return np.minimum(h[: len(h) - (width - step)], h[width - step :]) if width > step else h


def stretches(values: np.ndarray, offsets: np.ndarray, width: int, gram: int):
    """Yields (row, first, last, anchor, gram hash, hash of all tokens of the stretch) as arrays, for rows given by offsets.

    first and last are the first tokens of the first and last window, anchor is the anchor's, all counted from the row's
    start. A row longer than SLICE is cut between windows; a stretch that is cut there is two.
    """
    for lo, hi in common.chunks(offsets, SLICE):
        base, end = int(offsets[lo]), int(offsets[hi])
        for at in range(base, max(base + 1, end - width + 1), 2 * SLICE):
            stop = min(end, at + 2 * SLICE + width - 1)
            if stop - at < width:
                continue
            bounds = np.clip(offsets[lo : hi + 1], at, stop) - at
            spans = common.Spans(_hashed(values[at:stop]))
            n = stop - at
            grams = np.arange(n - gram + 1)
            h = spans.fixed(gram)
            m = least((h & ~_LOW) | grams.astype(np.uint64), width - gram + 1) & _LOW
            row = np.searchsorted(bounds, np.arange(n - width + 1), side="right") - 1
            inside = np.flatnonzero(np.arange(width, n + 1) <= bounds[row + 1])
            if not len(inside):
                continue
            anchor = m[inside].astype(np.int64)
            cut = np.ones(len(inside), bool)
            cut[1:] = (anchor[1:] != anchor[:-1]) | (inside[1:] != inside[:-1] + 1)
            a = np.flatnonzero(cut)
            b = np.append(a[1:], len(inside)) - 1
            first, last, anchor, row = inside[a], inside[b], anchor[a], row[inside[a]]
            back = at - offsets[lo + row]
            yield lo + row, first + back, last + back, anchor + back, h[anchor], spans.spans(first, last + width)


def _hashed(values: np.ndarray) -> np.ndarray:
    """Tokens as 64-bit values: bytes are looked up, words are hashed already."""
    return common.byte_values()[values] if values.dtype == np.uint8 else values


def byte_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    values, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    total = 0
    for lo, hi in common.chunks(offsets):
        part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        starts, stops, rows = common.words(part, at)
        if len(part):
            values.append(common.word_hashes(part, starts, stops))
        counts.append(rows[1:] + total)
        total += len(starts)
    return np.concatenate(values), np.concatenate(counts)


TOKENS = {"bytes": byte_tokens, "words": word_tokens}
_STRETCH = [T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType()), T.StructField("anchor", T.IntegerType()), T.StructField("gram", T.LongType()), T.StructField("whole", T.LongType())]


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, o, key and text. o (doc_id, or a number in place of null) and key (a hash of doc_id and text) name a row; rows
    with equal doc_id and text are alike in every answer, so they may share a name. doc_id must be a whole number."""
    o = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return docs.select("doc_id", o.alias("o"), F.coalesce(F.xxhash64("doc_id", "text"), F.lit(0)).alias("key"), "text")


_NAME = [T.StructField("o", T.LongType()), T.StructField("key", T.LongType())]


#: Of tables of stretches.
STRETCHES = T.StructType([*_NAME, *_STRETCH])


def all_stretches(docs: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    """A row (o, key, first, last, anchor, gram, whole) for each stretch of keyed documents."""
    schema = STRETCHES

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = common.text_buffers(batch.column("text"))
            for lo, hi in common.chunks(offsets, 8 * SLICE):
                values, at = TOKENS[kind](data, offsets[lo : hi + 1])
                for row, first, last, anchor, gr, whole in stretches(values, at, width, gram):
                    take = pa.array(row + lo)
                    out = [batch.column("o").take(take), batch.column("key").take(take)]
                    out += [pa.array(x.astype(np.int32)) for x in (first, last, anchor)] + [pa.array(x.view(np.int64)) for x in (gr, whole)]
                    yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return docs.select("o", "key", "text").mapInArrow(common.trimmed(run), schema)


def judged(found: DataFrame, kept: list[str], weight: Column) -> tuple[DataFrame, DataFrame]:
    """Of rows (o, key, first, last, gram, whole, ...): those repeated as a whole, and those to be looked into.

    Rows of one gram and whole are equal; twice or more, all their windows are repeated. One of each such kind, and all other
    rows, are candidates where their gram has two kinds or more. Candidates come as (kept..., gram, n, kinds): n is the
    weight of the rows like it, so only those with n = 1 need an answer, and kinds tells how many the gram has.
    """
    kinds = found.groupBy("gram", "whole").agg(F.sum(weight).alias("n"), F.min(F.struct(*kept)).alias("one"))
    kinds = common.written(kinds, "kinds")
    whole = found.join(kinds.filter("n > 1").select("gram", "whole"), ["gram", "whole"], "left_semi").select("o", "key", "first", "last")
    mixed = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    return whole, kinds.join(mixed, "gram").select("one.*", "gram", "n", "kinds")


def judged_stretches(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    whole, candidates = judged(found, ["o", "key", "first", "last", "anchor"], F.lit(1))
    return whole, common.written(candidates, "candidates")


def repeated(stretches: DataFrame) -> DataFrame:
    """The stretches whose gram stands at more than one place."""
    more = stretches.groupBy("gram").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("gram")
    return stretches.join(more, "gram", "left_semi")


def with_text(rows: DataFrame, docs: DataFrame, columns: list[str]) -> DataFrame:
    """(o, key, text, found) of docs that have rows, found being a list of their `columns`.

    Documents that share a name all come; what is found of them more than once was repeated before.
    """
    lists = rows.groupBy("o", "key").agg(F.collect_list(F.struct(*columns)).alias("found"))
    return docs.select("o", "key", "text").join(lists, ["o", "key"])


def by_window(candidates: DataFrame, docs: DataFrame, kind: str, width: int, gram: int) -> DataFrame:
    """The windows (o, key, first, last) of candidates with n = 1 that stand at another candidate too.

    The windows of a stretch are dealt into blocks by their distance from the anchor, so equal windows are in blocks of one
    number. What all windows of a block have in common is its core; a block whose core stands at no other stretch has no
    repeated window, and one that is repeated as a whole has no other. Windows are compared in the blocks between: the few
    at which two places begin or cease to be equal.
    """
    step = max(2, math.isqrt(width - gram + 1))
    located = with_text(candidates, docs, ["first", "last", "anchor", "gram", "n"])
    schema = T.StructType([*_NAME, *_STRETCH[:2], *_STRETCH[3:], T.StructField("n", T.LongType()), T.StructField("windows", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            data, offsets = common.text_buffers(batch.column("text"))
            found = batch.column("found")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(found.offsets.to_numpy()))
            every = {c: found.flatten().field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "last", "anchor", "gram", "n")}
            for lo, hi in common.chunks(offsets, 8 * SLICE):
                values, starts = TOKENS[kind](data, offsets[lo : hi + 1])
                a, b = np.searchsorted(owner, [lo, hi])
                ends = np.cumsum(every["last"][a:b] - every["first"][a:b] + width)
                while a < b:  # so many stretches that their tokens are one slice
                    to = a + max(1, int(np.searchsorted(ends, (ends[0] - width) + SLICE)))
                    yield blocks_of(batch, values, starts, owner[a:to], lo, {c: x[a:to] for c, x in every.items()})
                    ends, a = ends[to - a :], to

    def blocks_of(batch, values, starts, owner, lo, col):
        import pyarrow as pa

        size = col["last"] - col["first"] + width
        base = np.cumsum(size) - size  # where each stretch starts among the tokens of this slice
        spans = common.Spans(_hashed(values[np.arange(size.sum()) + np.repeat(starts[owner - lo] + col["first"] - base, size)]))
        # blocks number far // step to near // step of each stretch
        near, far = (col["anchor"] - col["last"]) // step, (col["anchor"] - col["first"]) // step
        many = far - near + 1
        of = np.repeat(np.arange(len(many)), many)
        block = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + near[of]
        anchor, shift = col["anchor"][of], (base - col["first"])[of]
        first, last = np.maximum(col["first"][of], anchor - block * step - step + 1), np.minimum(col["last"][of], anchor - block * step)
        core = spans.spans(anchor - block * step + shift, anchor - block * step - step + 1 + width + shift)
        group = common.pair(common.pair(col["gram"][of].view(np.uint64), core), block.astype(np.uint64))
        whole = common.pair(spans.spans(first + shift, last + width + shift), (anchor - last).astype(np.uint64))
        count = last - first + 1
        w = np.repeat(np.arange(len(count)), count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + (first + shift)[w]
        h = spans.spans(at, at + width) if len(at) else np.zeros(0, np.uint64)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), pa.array(h.view(np.int64)))
        take = pa.array(owner[of])
        out = [batch.column("o").take(take), batch.column("key").take(take), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)), pa.array(group.view(np.int64)), pa.array(whole.view(np.int64)), pa.array(col["n"][of]), lists]
        return pa.RecordBatch.from_arrays(out, names=schema.names)

    blocks = common.written(located.mapInArrow(common.trimmed(run), schema), "blocks")
    whole, mixed = judged(blocks, ["o", "key", "first", "windows"], F.col("n"))
    windows = mixed.select("o", "key", "first", "gram", "n", F.posexplode("windows").alias("i", "window"))
    same = windows.groupBy("gram", "window").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("gram", "window")
    hit = windows.filter("n = 1").join(same, ["gram", "window"], "left_semi").withColumn("at", F.col("first") + F.col("i"))
    return whole.unionByName(hit.select("o", "key", F.col("at").alias("first"), F.col("at").alias("last")))


def without(docs: DataFrame, ranges: DataFrame, kind: str, width: int, texts: bool) -> DataFrame:
    """docs less every token that a window of ranges(o, key, first, last) covers.

    Adds n_tokens, n_removed, n_spans (runs of removed tokens), kept_sha256 and, with texts, kept (words joined by one space,
    or bytes).
    """
    import pyarrow as pa

    lists = ranges.groupBy("o", "key").agg(F.collect_list("first").alias("_first"), F.collect_list("last").alias("_last"))
    d = docs.join(lists, ["o", "key"], "left").select("doc_id", "text", "_first", "_last")
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(c, T.LongType()) for c in ("n_tokens", "n_removed", "n_spans")], T.StructField("kept_sha256", T.StringType()), *([T.StructField("kept", T.BinaryType())] if texts else [])])

    def run(batches):
        for batch in batches:
            n, removed, spans, digests, kept = [], [], [], [], []
            for text, first, last in zip(batch.column("text").cast(pa.binary()), batch.column("_first"), batch.column("_last"), strict=True):
                raw = text.as_py() or b""
                tokens = raw.split() if kind == "words" else raw
                n.append(len(tokens))
                if first.is_valid:
                    edge = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(edge, first.values.to_numpy(), 1)
                    np.add.at(edge, last.values.to_numpy().astype(np.int64) + width, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    removed.append(int(gone.sum()))
                    spans.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()))
                    left = b" ".join([tokens[i] for i in np.flatnonzero(~gone).tolist()]) if kind == "words" else np.frombuffer(raw, np.uint8)[~gone].tobytes()
                else:
                    removed.append(0)
                    spans.append(0)
                    left = b" ".join(tokens) if kind == "words" else raw
                digests.append(common.sha256(left))
                if texts:
                    kept.append(left)
            out = [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n, removed, spans)], pa.array(digests, pa.string()), *([pa.array(kept, pa.binary())] if texts else [])]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return d.mapInArrow(common.trimmed(run), schema)
