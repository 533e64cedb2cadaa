"""The engine's own tables, as Parquet below one folder."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only where the session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="linkfold-")
        spark.conf.set("spark.checkpoint.dir", found)
    return f"{found.rstrip('/')}/linkfold-{spark.sparkContext.applicationId}"


def clashes(new: DataFrame, known: DataFrame) -> tuple[int, bool]:
    """How many rows new (of one column) has, and whether a value of it stands there twice or in known, or is null."""
    value = lambda df, n: df.toDF("value").select("value", F.lit(n).alias("n"))
    by = value(new, 1).unionByName(value(known, 0)).groupBy("value").agg(F.sum("n").alias("n"), F.min("n").alias("least")).filter("n > 0")
    one = by.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max((F.col("n") > 1) | (F.col("least") == 0) | F.col("value").isNull()), F.lit(False))).collect()[0]
    return one[0], one[1]


class Store:
    """Tables commits, links (the folded view) and peers.

    commits only grows, a batch at a time; `told` names the batches whose change has been emitted. links is written in
    versions: a pointer file names the current one, so a reader never meets a table that is being written. Each version
    is stored twice, in ranges of sources and in ranges of targets, so that a pattern reads the files that can have it.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, name: str, kind: T.StructType) -> DataFrame:
        if not self._exists(name):
            return schema.none(self.spark, kind)
        return self.spark.read.schema(kind).parquet(f"{self.root}/{name}")

    def _exists(self, name: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def commits(self) -> DataFrame:
        return self._read("commits", schema.COMMITS).select(*schema.COMMITS.names)

    def pending(self) -> tuple[DataFrame, DataFrame, list[str]]:
        """The commits whose change has been told, those whose change has not, and the batches of these: few, as one is
        told before the next is taken, unless an emit has failed."""
        every = self._read("commits", T.StructType([*schema.COMMITS.fields, T.StructField("batch", T.StringType())]))
        told = self._read("told", T.StructType([T.StructField("batch", T.StringType())]))
        batches = [r.batch for r in every.select("batch").distinct().join(told, "batch", "left_anti").collect()]
        new = F.col("batch").isin(*batches) if batches else F.lit(False)
        if not self._exists("told"):  # all are new
            return schema.none(self.spark, schema.COMMITS), every.select(*schema.COMMITS.names), batches
        return every.filter(~new).select(*schema.COMMITS.names), every.filter(new).select(*schema.COMMITS.names), batches

    def tell(self, batches: list[str]) -> None:
        self.spark.range(1).select(F.explode(F.array(*map(F.lit, batches))).alias("batch")).coalesce(1).write.mode("append").parquet(f"{self.root}/told")

    def commit_hashes(self) -> DataFrame:
        return self.commits().select("commit_hash")

    def get_commit(self, commit_hash: str) -> DataFrame:
        return self.commits().filter(F.col("commit_hash") == commit_hash)

    def has_commit(self, commit_hash: str) -> bool:
        return not self.get_commit(commit_hash).isEmpty()

    def append_commits(self, new: DataFrame) -> DataFrame:
        """Append those of new that are not stored; they are what is returned. Nothing is left behind if there are none.

        Rows are written beside the table, and their hashes alone are compared. If all are new and stand once, as when a sync
        has left out what is known, the files become a batch as they are; else they are written again without the others.
        """
        batch = uuid.uuid4().hex
        path, at = f"{self.root}/commits/batch={batch}", f"{self.root}/arrived/{batch}"
        new.select(*schema.COMMITS.names).write.parquet(at)
        arrived = self.spark.read.schema(schema.COMMITS).parquet(at)
        rows, again = clashes(arrived.select("commit_hash"), self.commit_hashes())
        if again:
            arrived.dropDuplicates(["commit_hash"]).join(self.commit_hashes(), "commit_hash", "left_anti").select(*schema.COMMITS.names).write.parquet(path)
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = jpath(at).getFileSystem(self.spark._jsc.hadoopConfiguration())
        if rows and not again:
            fs.mkdirs(jpath(path).getParent())
            if not fs.rename(jpath(at), jpath(path)):
                raise OSError(f"{at} could not be moved to {path}")
        else:
            fs.delete(jpath(at), True)
        if not rows or again and self.spark.read.schema(schema.COMMITS).parquet(path).isEmpty():
            fs.delete(jpath(path), True)
            return schema.none(self.spark, schema.COMMITS)
        return self.spark.read.schema(schema.COMMITS).parquet(path)

    def links(self, by: str = "source") -> DataFrame:
        """The links; `by` says which copy of them is read: that in ranges of source or of target."""
        return self._read(f"links/{self._version()}/by-{by}", schema.LINKS)

    def _version(self) -> str:
        rows = self._read("links-version", schema.VERSIONS).orderBy(F.col("at").desc()).limit(1).collect()
        return rows[0].version if rows else "none"

    def replace_links(self, links: DataFrame) -> DataFrame:
        version, rows = uuid.uuid4().hex, self._read("links-version", schema.VERSIONS)
        at = (rows.agg(F.max("at")).collect()[0][0] or 0) + 1
        rows_of = links.select(*schema.LINKS.names)
        for by, order in (("source", ["source", "predicate", "target"]), ("target", ["target", "predicate", "source"])):
            rows_of.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{self.root}/links/{version}/by-{by}")
            rows_of = self.spark.read.schema(schema.LINKS).parquet(f"{self.root}/links/{version}/by-{by}")
        self.spark.range(1).select(F.lit(version).alias("version"), F.lit(at).cast("long").alias("at")).coalesce(1).write.mode("append").parquet(f"{self.root}/links-version")
        return self.links()

    def put_values(self, rows: DataFrame) -> None:
        """Store rows(key, value); a null value deletes its key. Of a key the row put last counts."""
        at = (self._read("values", schema.VALUES).agg(F.max("at")).collect()[0][0] or 0) + 1
        rows.select("key", "value", F.lit(at).cast("long").alias("at")).write.mode("append").parquet(f"{self.root}/values")

    def values(self, prefix: str = "") -> DataFrame:
        """(key, value) of the keys that start with prefix; the scan takes the filter."""
        rows = self._read("values", schema.VALUES).filter(F.startswith("key", F.lit(prefix)))
        last = rows.groupBy("key").agg(F.max_by(F.struct("value"), "at").alias("v"))
        return last.select("key", "v.value").filter("value is not null")

    def put(self, key: str, value: str | None) -> None:
        self.put_values(self.spark.createDataFrame([(key, value)], "key string, value string"))

    def get(self, key: str) -> str | None:
        rows = self.values(key).filter(F.col("key") == key).collect()
        return rows[0].value if rows else None

    def delete(self, key: str) -> None:
        self.put(key, None)

    def peers(self) -> DataFrame:
        """The last row of each peer that is not removed."""
        rows = self._read("peers", T.StructType([*schema.PEERS.fields, T.StructField("at", T.LongType())]))
        last = rows.groupBy("did").agg(F.max_by(F.struct("metadata", "is_local"), "at").alias("p"))
        return last.select("did", "p.*").filter("metadata is not null")

    def set_peer(self, did: str, metadata: dict | None = None, is_local: bool = False) -> None:
        self._peer(did, json.dumps(metadata or {}), is_local)

    def remove_peer(self, did: str) -> None:
        self._peer(did, None, False)

    def _peer(self, did: str, metadata: str | None, is_local: bool) -> None:
        kind = T.StructType([*schema.PEERS.fields, T.StructField("at", T.LongType())])
        at = (self._read("peers", kind).agg(F.max("at")).collect()[0][0] or 0) + 1
        self.spark.createDataFrame([(did, metadata, is_local, at)], kind).coalesce(1).write.mode("append").parquet(f"{self.root}/peers")

    def peer_metadata(self, did: str) -> dict | None:
        rows = self.peers().filter(F.col("did") == did).collect()
        return json.loads(rows[0].metadata) if rows else None
