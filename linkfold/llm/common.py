"""Helpers that the operators of this subpackage share: scratch tables, texts as numpy arrays, rolling hashes."""

from __future__ import annotations

import functools
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..workers import trimmed  # noqa: F401  (common.trimmed)

#: Bytes that part words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
#: The same set as a regular expression for Spark SQL and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"

_CHUNK = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where the session names none (tests) a local one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="linkfold-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/linkfold-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it again: the lineage is cut, and a lost executor takes nothing along."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


class Bucketed:
    """A table of the session's warehouse that is dealt and sorted by a key, so that joins by it move the other side alone."""

    def __init__(self, df: DataFrame, key: str):
        self.spark, self.name = df.sparkSession, f"linkfold_{uuid.uuid4().hex}"
        n = parts(self.spark)
        df.repartition(n, key).write.bucketBy(n, key).sortBy(key).option("compression", "zstd").saveAsTable(self.name, format="parquet")
        self.table = self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def dropped(*tables: DataFrame | None) -> None:
    """Remove tables of written() that nothing reads any more."""
    for df in tables:
        if df is not None:
            delete(df.sparkSession, df._written_to)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a path of any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def clean(spark: SparkSession) -> None:
    """Remove all scratch tables of this application; results that have not been read yet become unreadable."""
    delete(spark, f"{shared_dir(spark)}/linkfold-{spark.sparkContext.applicationId}")


def parts(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- hashes -----------------------------------------------------------------


@functools.cache
def byte_values() -> np.ndarray:
    """A random 64-bit value for each byte, the same everywhere."""
    return np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


@functools.cache
def _spaces() -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


@functools.cache
def lower_table() -> np.ndarray:
    """Maps the bytes A-Z to a-z and every other byte to itself."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of two parts that follow each other, from their hashes. mix() stands between any two steps, so no sum of
    products is left that texts of some build (as Thue-Morse words are for polynomials) could make vanish."""
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


class Spans:
    """Hashes of spans of a sequence of 64-bit values, equal for equal content wherever it stands.

    Level k holds the hash of the 2**k values from each place on, made of two hashes of level k - 1.
    """

    def __init__(self, values: np.ndarray):
        self.levels = [mix(values)]

    def level(self, k: int) -> np.ndarray:
        while len(self.levels) <= k:
            half, below = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(pair(below[: max(0, len(below) - half)], below[half:]))
        return self.levels[k]

    def fixed(self, length: int) -> np.ndarray:
        """The hash of `length` values from each place on that has so many."""
        n, out, at = max(0, len(self.levels[0]) - length + 1), None, 0
        for k in reversed(range(length.bit_length())):
            if length >> k & 1:
                part = self.level(k)[at : at + n]
                out = part if out is None else pair(out, part)
                at += 1 << k
        return out

    def spans(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The hashes of start:stop, none of them empty: of two halves that may overlap, and the length."""
        length = stop - start
        top = np.frexp(length.astype(float))[1] - 1
        out = np.zeros(len(start), np.uint64)
        for k in np.unique(top).tolist():
            own, level = top == k, self.level(k)
            out[own] = pair(pair(level[start[own]], level[stop[own] - (1 << k)]), length[own].astype(np.uint64))
        return out


# --- texts ------------------------------------------------------------------


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """A string or binary Arrow column as its bytes and its rows' offsets; null rows are empty."""
    import pyarrow as pa

    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(offsets: np.ndarray, limit: int = _CHUNK):
    """Ranges of whole rows of about limit bytes together; a longer row stands alone."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of rows given by offsets into data, and the index of the first word of each row (and the end).

    letters tells which bytes words are made of; all but white space if it is None.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    solid = letters[data] if letters is not None else ~_spaces()[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(solid & np.concatenate(([True], ~solid[:-1] | first[1:-1])))
    stops = np.flatnonzero(solid & np.concatenate((~solid[1:] | first[1:-1], [True]))) + 1
    return starts, stops, np.searchsorted(starts, offsets)


#: Bytes from which on a word is hashed by itself.
_LONG = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word, none of them empty: eight bytes a step, all words together; long words one by one."""
    import xxhash

    n = stops - starts
    out = mix(n.astype(np.uint64))
    if not len(n):
        return out
    # the eight bytes from every place on
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    live, at = np.flatnonzero(n <= _LONG), 0
    while len(live):
        left = n[live] - at
        out[live] = pair(out[live], eight[starts[live] + at] & keep[np.minimum(left, 8)])
        at += 8
        live = live[left > 8]
    for i in np.flatnonzero(n > _LONG).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : stops[i]].tobytes())
    return out


def sha256(pieces) -> str:
    """Lower-case hex digest of some bytes."""
    import hashlib

    return hashlib.sha256(pieces).hexdigest()
