"""Incremental sync: new resources of a folder, as they arrive, become commits, and the fold's change is emitted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import hashing as H
from ..functions.uris import name_of
from ..operators import history
from ..sources.pod import read_commits
from ..sources.tables import Store

Emit = Callable[[DataFrame], None]


def advance(store: Store, emit: Emit, hash: H.Hash = H.sha256) -> DataFrame | None:
    """Bring the stored links up to date with commits whose change has not been told yet, then emit that change.

    Only hashes that these commits touch are folded again; all other links stay. Links are current when emit is called, and
    a batch counts as told after it: if emit fails, the next call computes the same change and emits it again.
    """
    old, new, batches = store.pending()
    if not batches:
        return None
    path = f"{store.root}/changes/{'-'.join(sorted(batches))[:64]}-folds"
    # the folds of each touched hash, made once for the links and for the change
    history.both_folds(old, new, hash).write.mode("overwrite").parquet(path)
    folds = store.spark.read.parquet(path)
    after = folds.filter("after is not null").select("link_hash", "after.*")
    store.replace_links(store.links().join(folds.select("link_hash"), "link_hash", "left_anti").unionByName(after, allowMissingColumns=True))
    change = history.one_sided(folds)
    some = not change.isEmpty()
    if some:
        emit(change)
    store.tell(batches)
    return change if some else None


def sync_batch(store: Store, found: DataFrame, emit: Emit, hash: H.Hash = H.sha256, verify: bool = False, some_known: bool = True) -> DataFrame | None:
    """Take the commits of resources(name, doc, turtle) that the store does not have, and emit the change if there is any.

    Commits whose ancestors are missing are taken too, as the fold needs no order. With verify, a commit whose content does
    not have the hash it is named by is left out. some_known tells whether found may name commits that the store has.
    """
    known = store.commits()
    # a commit is named by its hash, so what is known is never read
    commits = read_commits(found.join(known.select(F.col("commit_hash").alias("name")), "name", "left_anti") if some_known else found)
    if verify:
        of = lambda x: H.link_hash(x["source"], x["predicate"], x["target"], x["author"], x["timestamp"], hash)
        commits = commits.filter(F.col("commit_hash") == H.commit_hash(F.transform("additions", of), F.transform("removals", lambda t: t["link_hash"]), "previous", hash=hash))
    # arrival has no order within a batch: there the commit's hash decides
    ord0 = known.agg(F.coalesce(F.max("ord"), F.lit(-1))).collect()[0][0]
    store.append_commits(commits.withColumn("ord", F.lit(ord0 + 1).cast("long")))
    return advance(store, emit, hash)


def stream_sync(spark: SparkSession, folder: str, store: Store, emit: Emit, checkpoint: str, hash: H.Hash = H.sha256, verify: bool = False, available_now: bool = True) -> StreamingQuery:
    """sync_batch() of each micro-batch of new commit files in a folder; links follow with each. No watermark: late commits
    always count, and a batch that is run again adds nothing."""
    files = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "diff-*.ttl").load(folder)
    files = files.select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("turtle")).withColumn("name", name_of("doc", "diff"))

    def batch(df: DataFrame, _: int) -> None:
        sync_batch(store, df, emit, hash, verify)

    out = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if available_now else out).start()
