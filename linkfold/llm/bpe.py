"""Byte-level BPE encoding and decoding as a reduction over a tree of text halves."""

from __future__ import annotations

import base64
import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

#: The vocabulary used where none is named.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Texts up to so many characters are leaves of the tree.
LEAF = 256
#: Bytes of text, about, whose tokens are held together.
HELD = 1 << 20
#: First width, in characters, of the window that is searched on either side of a join for a place to end at.
WINDOW = 32
#: Places at which public_tokenizers.PATTERN parts two pieces whatever stands around: after a letter what is none, after a
#: digit what is none, and after any other character but white space a digit, white space or (unless it is an apostrophe) a
#: letter. No alternative of the pattern has such a pair in it, and none looks past such an end.
CUT = r"(?<=\p{L})(?=\P{L})|(?<=\p{N})(?=\P{N})|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=\p{L})"


class Codec:
    """Encodes and decodes with the ranks of one vocabulary file.

    Every text longer than a leaf is encoded by halves, which are encoded by halves again. join() is associative: the ids of
    a joined node depend on its text alone, so halves can be reduced in any grouping. Where two nodes meet, a window on both
    sides is encoded again. Each side of it grows until it ends at a cut: a place where the splitting pattern must part two
    pieces whatever stands beyond. Tokens do not cross pieces, so those outside the window stand in the encoding of the
    whole. A side without a cut takes the window to the end of its text; where two nodes meet at a cut there is none.

    A pattern of one's own needs its cuts, as a regular expression; without them every text is one leaf.
    """

    def __init__(self, path: str | None = None, pattern: str | None = None, leaf: int = LEAF, window: int = WINDOW, cut: str | None = None):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.leaf, self.window = max(1, leaf), window
        cut = cut or (CUT if pattern in (None, public_tokenizers.PATTERN) else None)
        self.cut = regex.compile(cut) if cut else None
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for k, v in ranks.items():
            self.bytes[v] = k
        self.sizes = [len(b) for b in self.bytes]
        self.names = [str(i) for i in range(len(self.bytes))]

    def encode(self, text: str) -> list[int]:
        return self._node(text, 0, len(text))

    def _node(self, text: str, start: int, stop: int) -> list[int]:
        if stop - start <= self.leaf or self.cut is None:
            return self.encoding.encode_ordinary(text[start:stop])
        half = (start + stop) // 2
        return self._join(text, start, half, stop, self._node(text, start, half), self._node(text, half, stop))

    def combine(self, left: tuple[str, list[int]], right: tuple[str, list[int]]) -> tuple[str, list[int]]:
        """The node (text, ids) of both texts, one after the other."""
        (a, ai), (b, bi) = left, right
        if not a or not b:
            return left if not b else right
        return a + b, self._join(a + b, 0, len(a), len(a) + len(b), ai, bi)

    def _join(self, text: str, start: int, half: int, stop: int, left: list[int], right: list[int]) -> list[int]:
        """The ids of start:stop from those of both its halves."""
        if self.cut is not None and self.cut.match(text, half, stop):
            return left + right
        lo, hi = self._last_cut(text, start, half), self._first_cut(text, half, stop)
        head = self._tokens(reversed(left), len(text[lo:half].encode()))
        tail = self._tokens(right, len(text[half:hi].encode()))
        return left[: len(left) - head] + self.encoding.encode_ordinary(text[lo:hi]) + right[tail:]

    def _last_cut(self, text: str, start: int, stop: int) -> int:
        """The last cut within start:stop; its start if there is none."""
        width = self.window
        while self.cut is not None and start + 1 < stop:
            lo = max(start + 1, stop - width)
            at = start
            for found in self.cut.finditer(text, lo, stop):
                at = found.start()
            if at > start or lo == start + 1:
                return at
            width *= 2
        return start

    def _first_cut(self, text: str, start: int, stop: int) -> int:
        """The first cut within start:stop; its end if there is none."""
        found = self.cut.search(text, start + 1, stop) if self.cut is not None else None
        return found.start() if found else stop

    def _tokens(self, ids, size: int) -> int:
        """The number of ids, from the first, whose bytes make up size."""
        n = 0
        for i in ids:
            if size <= 0:
                break
            size -= self.sizes[i]
            n += 1
        if size:
            raise AssertionError("a token crosses a place that parts two pieces")
        return n

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of the ids, concatenated up the tree."""
        level = [b"".join([self.bytes[i] for i in ids[k : k + 1024]]) for k in range(0, len(ids), 1024)] or [b""]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0]


@functools.lru_cache(4)
def codec(path: str | None = None, pattern: str | None = None, leaf: int = LEAF, window: int = WINDOW, cut: str | None = None) -> Codec:
    return Codec(path, pattern, leaf, window, cut)


def bpe(docs: DataFrame, path: str | None = None, pattern: str | None = None, leaf: int = LEAF, window: int = WINDOW, ids: bool = True, decoded: bool = True, cut: str | None = None) -> DataFrame:
    """Encode docs.text; adds n_tokens, ids_sha256, decoded_sha256 and, with ids and decoded, the token ids and the decoded
    bytes themselves.

    Columns besides text stay as they are (of the same name as a new one, in any case: the new one replaces it). A null text
    counts as empty: no tokens, digests of the empty string. Repeated rows are encoded each. An empty table gives an empty
    table. A text is held whole, with its ids, by one task. The path of the vocabulary must be readable on every executor.
    """
    new = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    new += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * ids + [T.StructField("decoded", T.BinaryType())] * decoded
    names = [f.name for f in new]
    kept = [f for f in docs.schema.fields if f.name.lower() not in [*names, "text"]]
    schema = T.StructType(kept + new)

    def encoded(batch):
        import hashlib

        import pyarrow as pa

        c = codec(path, pattern, leaf, window, cut)
        name = c.names.__getitem__
        counts, a, b, all_ids, all_bytes = [], [], [], [np.zeros(0, np.int32)], []
        for text in batch.column("text"):
            tokens = c.encode(text.as_py() or "")
            counts.append(len(tokens))
            a.append(hashlib.sha256(",".join(map(name, tokens)).encode()).hexdigest())
            raw = c.decode(tokens)
            b.append(hashlib.sha256(raw).hexdigest())
            if ids:
                all_ids.append(np.array(tokens, np.int32))
            if decoded:
                all_bytes.append(raw)
        out = [batch.column(f.name) for f in kept] + [pa.array(counts, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
        if ids:
            ends = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(all_ids))))
        if decoded:
            out.append(pa.array(all_bytes, pa.binary()))
        return pa.RecordBatch.from_arrays(out, names=schema.names)

    def run(batches):
        for batch in batches:
            # in slices: tokens take several times the memory of their text
            for lo, hi in common.chunks(common.text_buffers(batch.column("text"))[1], HELD):
                yield encoded(batch.slice(lo, hi - lo))

    return docs.select(*[f.name for f in kept], "text").mapInArrow(common.trimmed(run), schema)


def op7(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return bpe(docs, ids=False, decoded=False)
