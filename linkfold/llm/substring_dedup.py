"""Removing word sequences that stand at more than one place, with a log-structured index of fingerprints."""

from __future__ import annotations

import contextlib
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, windows

#: Words of a window; words of the fingerprints by which windows are found.
WIDTH, GRAM = 35, 16
#: Batches that one table is added in, and runs of one level that are compacted into one of the next.
BATCHES, FAN = 4, 3


@contextlib.contextmanager
def _sorted_buckets(spark: SparkSession):
    """Within it, Spark takes the order of bucketed files as given, where a bucket is one file."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class FingerprintIndex:
    """Sorted immutable runs of fingerprints, one more for each batch of documents.

    A run has a row for each stretch of windows (see windows) with its fingerprint, and is stored bucketed and sorted by it,
    a file a bucket, so a new run is merge-joined with each earlier one without another exchange or sort. What they share
    is known to be repeated from then on, in both. When FAN runs are of one level they are merged, bucket by bucket, into
    one of the next level, so each row is written a logarithmic number of times and a batch meets few runs.

    name is that of the tables in the session's warehouse. state() tells what open() needs to go on with them, in another
    session too; drop() removes them. Fingerprints only find windows: stretches are compared by a hash of all their words
    among those of one fingerprint, and windows likewise.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, width: int = WIDTH, gram: int = GRAM, fan: int = FAN, buckets: int | None = None):
        self.spark, self.width, self.gram, self.fan = spark, width, gram, fan
        self.name = name or f"fingerprints_{uuid.uuid4().hex}"
        self.buckets = buckets or common.parts(spark)
        self.runs: list[tuple[int, str]] = []  # (level, table)
        self.shared: list[str] = []
        self.made = 0

    @classmethod
    def open(cls, spark: SparkSession, state: str) -> FingerprintIndex:
        """The index that state() told of; its tables must be in the session's catalog."""
        told = json.loads(state)
        index = cls(spark, told["name"], told["width"], told["gram"], told["fan"], told["buckets"])
        index.runs, index.shared, index.made = [tuple(r) for r in told["runs"]], told["shared"], told["made"]
        return index

    def _table(self) -> str:
        self.made += 1
        return f"{self.name}_{self.made - 1}"

    def _write(self, rows: DataFrame, level: int) -> str:
        table = self._table()
        rows.write.bucketBy(self.buckets, "gram").sortBy("gram").option("compression", "zstd").saveAsTable(table, format="parquet")
        self.runs.append((level, table))
        return table

    def add(self, docs: DataFrame) -> None:
        """Add a batch of keyed documents. Null and short texts have no windows and add nothing; a document that is added
        twice is repeated."""
        earlier = [t for _, t in self.runs]
        found = windows.all_stretches(docs, "words", self.width, self.gram)
        # the same hash of the same number of buckets deals rows to tasks, so a task writes one file
        run = self._write(found.repartition(self.buckets, "gram"), 0)
        with _sorted_buckets(self.spark):
            both = self.spark.table(run).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
            for table in earlier:
                both = both.unionByName(self.meeting(run, table))
            shared = self._table()
            both.distinct().write.option("compression", "zstd").saveAsTable(shared, format="parquet")
        self.shared.append(shared)
        self.compact()

    def meeting(self, run: str, earlier: str) -> DataFrame:
        """The fingerprints of a run that stand in an earlier one: a merge join of two sorted tables."""
        return self.spark.table(run).hint("merge").join(self.spark.table(earlier).select("gram").hint("merge"), "gram", "left_semi").select("gram")

    def compact(self) -> None:
        """Merge the runs of every level that has `fan` of them."""
        while True:
            levels = [level for level, _ in self.runs]
            full = [level for level in sorted(set(levels)) if levels.count(level) >= self.fan]
            if not full:
                return
            old = [t for level, t in self.runs if level == full[0]]
            self.runs = [(level, t) for level, t in self.runs if level != full[0]]
            self._write(self._union(old).repartition(self.buckets, "gram"), full[0] + 1)
            for table in old:
                self.spark.sql(f"DROP TABLE {table}")

    def _union(self, tables: list[str]) -> DataFrame:
        out = self.spark.table(tables[0])
        for table in tables[1:]:
            out = out.unionByName(self.spark.table(table))
        return out

    def repeated(self) -> DataFrame:
        """The stretches, of all batches, whose fingerprint stands at more than one place."""
        if not self.runs:
            return self.spark.createDataFrame([], windows.STRETCHES)
        known = common.written(self._union(self.shared).distinct(), "known")
        parts = [self.spark.table(t).join(known, "gram", "left_semi") for _, t in self.runs]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return common.written(out.select(*windows.STRETCHES.names), "repeated")

    def drop(self) -> None:
        for table in [*(t for _, t in self.runs), *self.shared]:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.runs, self.shared = [], []

    def state(self) -> str:
        """What open() needs, as JSON."""
        return json.dumps({"name": self.name, "runs": self.runs, "shared": self.shared, "made": self.made, "width": self.width, "gram": self.gram, "fan": self.fan, "buckets": self.buckets})


def deduplicated(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, batches: int = BATCHES, texts: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with texts, kept: the words that no repeated window covers.

    A window is `width` consecutive words [^\\x20\\x09-\\x0D]+ of one document. It is repeated if the same words also start
    anywhere else, in the same document too; all its words go, in every place. Windows are judged on the input. A null or
    empty text has no words; one of fewer words than a window stays as it is. Rows of equal doc_id and text are two places.
    A null doc_id is an id like any other. Other columns are dropped; an empty table gives an empty one. A long text goes by
    in slices, but its words are held as 8 bytes each, and as a whole where it is cut.
    """
    keyed = windows.keyed(docs)
    index = FingerprintIndex(docs.sparkSession, width=width, gram=gram)
    try:
        for k in range(batches):
            index.add(keyed.filter(F.pmod(F.xxhash64("key", "o"), F.lit(batches)) == k))
        found = index.repeated()
    finally:
        index.drop()
    return without_repeated(keyed, found, width, gram, texts)


def without_repeated(keyed: DataFrame, found: DataFrame, width: int = WIDTH, gram: int = GRAM, texts: bool = True) -> DataFrame:
    """The result of deduplicated() for keyed documents of an index, from its repeated() stretches."""
    whole, candidates = windows.judged_stretches(found)
    some = windows.by_window(candidates, keyed, "words", width, gram)
    out = windows.without(keyed, whole.unionByName(some), "words", width, texts)
    return out.withColumnRenamed("n_tokens", "n_words").drop("n_spans")


def op4(spark, sf_dir: str) -> DataFrame:
    return deduplicated(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), texts=False)


#: DuckDB SQL for op4: every window by its words. For tables in which doc_id is unique.
OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)
), gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(i, i + 34)) AS i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)
), words AS (
  SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM d
), kept AS (
  SELECT doc_id, count(g.i) AS n, string_agg(word, ' ' ORDER BY words.i) FILTER (WHERE g.i IS NULL) AS left_over
  FROM words LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
