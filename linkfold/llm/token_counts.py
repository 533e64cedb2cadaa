"""Numbers of greedy word pieces by a longest-match automaton that never builds a piece."""

from __future__ import annotations

import base64
import functools

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

#: The vocabulary used where none is named.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bounds of the memory of words seen: entries, and bytes of an entry.
MEMORY, LONGEST = 1 << 19, 48


class Automaton:
    """A trie over byte strings with failure links that count what they pop.

    goto[node] maps a byte to a child. Where a node has no child for the next byte, the greedy match of what the node
    spells is settled: popped[node] pieces are counted and link[node] is the node of the rest. Every byte leads down once
    and each link shortens the rest, so a word takes time linear in its length. Single bytes that are in no vocabulary
    count as one piece each.
    """

    def __init__(self, vocabulary):
        pieces = {p for p in vocabulary if p} | {bytes([b]) for b in range(256)}
        self.goto: list[dict[int, int]] = [{}]
        final, parent, byte, depth = [False], [0], [0], [0]
        for piece in sorted(pieces):
            node = 0
            for b in piece:
                if (nxt := self.goto[node].get(b)) is None:
                    nxt = len(self.goto)
                    self.goto[node][b] = nxt
                    self.goto.append({})
                    final.append(False)
                    parent.append(node)
                    byte.append(b)
                    depth.append(depth[node] + 1)
                node = nxt
            final[node] = True
        self.popped, self.link = [0] * len(self.goto), [0] * len(self.goto)
        for v in sorted(range(1, len(self.goto)), key=depth.__getitem__):
            if final[v]:
                self.popped[v], self.link[v] = 1, 0
                continue
            n, z, b = self.popped[parent[v]], self.link[parent[v]], byte[v]
            while (nxt := self.goto[z].get(b)) is None:
                n, z = n + self.popped[z], self.link[z]
            self.popped[v], self.link[v] = n, nxt

    def count(self, word: bytes) -> int:
        """The number of pieces that taking the longest piece again and again makes of word."""
        goto, popped, link = self.goto, self.popped, self.link
        node = n = 0
        for b in word:
            while (nxt := goto[node].get(b)) is None:
                n += popped[node]
                node = link[node]
            node = nxt
        while node:
            n += popped[node]
            node = link[node]
        return n


def _pieces(path: str | None) -> list[bytes]:
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f]


@functools.lru_cache(2)
def automaton(path: str | None = None) -> Automaton:
    return Automaton(_pieces(path))


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Add n_words and n_tokens to docs, without its text: greedy longest-match pieces of every word of the whole text.

    Words are [^\\x20\\x09-\\x0D]+, taken as UTF-8 bytes. A null or empty text has 0 of both. Columns besides text stay (a
    column of the same name as a new one is replaced); repeated rows are counted each; an empty table gives an empty table.
    """
    new = [T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("n_words", "n_tokens", "text")]
    schema = T.StructType(kept + new)

    def run(batches):
        import pyarrow as pa

        count = automaton(path).count

        class Memory(dict):
            """Counts of words; those of common words stay for the next ones."""

            def __missing__(self, word):
                n = count(word)
                if len(word) <= LONGEST:
                    if len(self) >= MEMORY:
                        self.clear()
                    self[word] = n
                return n

        known = Memory().__getitem__
        for batch in batches:
            w, t = [], []
            for text in batch.column("text").cast(pa.binary()):
                found = (text.as_py() or b"").split()
                w.append(len(found))
                t.append(sum(map(known, found)))
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(w, pa.int64()), pa.array(t, pa.int64())], names=schema.names)

    return docs.select(*[f.name for f in kept], "text").mapInArrow(common.trimmed(run), schema)


def op5(spark, sf_dir: str) -> DataFrame:
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
