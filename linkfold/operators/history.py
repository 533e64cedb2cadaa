"""History as a graph of immutable commits: building, folding, heads, ancestors, differences.

commits has a row for each commit (see schema.COMMITS). The set of links that it describes is all that was ever added less
all that was ever removed, by link hash; what is removed once cannot come back, so the order of commits does not matter.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions import hashing as H


def additions(commits: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """A row for each added link with its hash, its commit and place."""
    out = commits.select("commit_hash", "ord", F.posexplode("additions").alias("pos", "link")).select("commit_hash", "ord", "pos", "link.*")
    return out.withColumn("link_hash", H.link_hash(hash=hash))


def removals(commits: DataFrame) -> DataFrame:
    """A row for each tombstone: the hash that it removes, and the link that it names."""
    return commits.select("commit_hash", "ord", F.posexplode("removals").alias("pos", "t")).select("commit_hash", "ord", "pos", "t.link_hash", "t.link")


def edges(commits: DataFrame) -> DataFrame:
    return commits.select(F.col("commit_hash").alias("child"), F.explode("previous").alias("parent"))


def build_commits(diffs: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """diffs(additions, removals as links, previous, author, timestamp, ord) as commits with tombstones and hashes."""
    h = lambda x: H.link_hash(x["source"], x["predicate"], x["target"], x["author"], x["timestamp"], hash)
    out = diffs.withColumn("removals", F.transform("removals", lambda x: F.struct(h(x).alias("link_hash"), x.alias("link"))))
    added, gone = F.transform("additions", h), F.transform("removals", lambda t: t["link_hash"])
    return out.withColumn("commit_hash", H.commit_hash(added, gone, "previous", hash=hash))


def add_commits(commits: DataFrame, new: DataFrame) -> DataFrame:
    """commits with those of new whose hash is not stored yet; a hash that is keeps its row."""
    return commits.unionByName(new.dropDuplicates(["commit_hash"]).join(commits.select("commit_hash"), "commit_hash", "left_anti"))


def fold(commits: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """The links that commits describe, one row for each hash. Of several rows the last one counts, by ord, commit and place."""
    return fold_rows(additions(commits, hash), removals(commits))


def fold_rows(added: DataFrame, removed: DataFrame, order: tuple[str, ...] = ("ord", "commit_hash", "pos")) -> DataFrame:
    """The same of rows: removals leave before the aggregate, so what is gone is never grouped. Commits that arrive together
    have one ord; their hashes, on which all replicas agree, then tell which row is the last."""
    left = added.join(removed.select("link_hash"), "link_hash", "left_anti")
    order = [c for c in order if c in added.columns]
    rest = [c for c in added.columns if c not in ("link_hash", *order)]
    last = left.groupBy("link_hash").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_last"))
    return last.select("link_hash", "_last.*")


def tombstoned(commits: DataFrame) -> DataFrame:
    return removals(commits).select("link_hash").distinct()


def delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """What differs between two folds, by hash alone: the rows of after that are new, of before that are gone; op tells.

    One exchange: the rows of both meet by hash, and those of which one side has none are the difference.
    """
    rest = [c for c in before.columns if c != "link_hash"]
    side = lambda df, late: df.select("link_hash", F.struct(*rest).alias("row"), F.lit(late).alias("late"))
    both = side(before, 0).unionByName(side(after, 1)).groupBy("link_hash")
    one = both.agg(F.min("late").alias("_first"), F.max("late").alias("_last"), F.any_value("row").alias("_row")).filter("_first = _last")
    return one.select("link_hash", "_row.*", F.when(F.col("_last") == 1, F.lit("add")).otherwise(F.lit("remove")).alias("op"))


def touched_folds(known: DataFrame, new: DataFrame, hash: H.Hash = H.sha256) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The hashes that the new commits touch, and the folds of these alone before and after them."""
    added, removed = additions(new, hash), removals(new)
    touched = added.select("link_hash").unionByName(removed.select("link_hash")).distinct()
    old_added = additions(known, hash).join(touched, "link_hash", "left_semi")
    old_removed = removals(known).join(touched, "link_hash", "left_semi")
    return touched, fold_rows(old_added, old_removed), fold_rows(old_added.unionByName(added), old_removed.unionByName(removed))


def both_folds(known: DataFrame, new: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """(link_hash, before, after) of each hash that the new commits touch: its rows in the folds without them and with them,
    null where a fold does not have it. touched_folds() in one aggregate; rows are dealt out once, whole, and not
    aggregated before, as most hashes have one row."""
    add = lambda df, late: additions(df, hash).select("link_hash", F.lit(late).alias("late"), F.struct("ord", "commit_hash", "pos").alias("at"), F.struct(*schema.LINK.names).alias("row"))
    gone = lambda df, late: removals(df).select("link_hash", F.lit(late).alias("late"), F.lit(None).alias("at"), F.lit(None).alias("row"))
    rows = add(known, False).unionByName(gone(known, False)).unionByName(add(new, True)).unionByName(gone(new, True))
    added, last = F.col("row").isNotNull(), lambda own: F.max_by(F.when(own, F.col("row")), F.when(own, F.col("at")))
    folds = rows.repartition("link_hash").groupBy("link_hash").agg(F.max("late").alias("_new"), last(added & ~F.col("late")).alias("before"), last(added).alias("after"), F.max(~added & ~F.col("late")).alias("_gone"), F.max(~added).alias("_ever"))
    return folds.filter("_new").select("link_hash", F.when(~F.col("_gone"), F.col("before")).alias("before"), F.when(~F.col("_ever"), F.col("after")).alias("after"))


def one_sided(folds: DataFrame) -> DataFrame:
    """delta() of both_folds()."""
    one = folds.filter(F.col("before").isNull() != F.col("after").isNull())
    return one.select("link_hash", F.coalesce("after", "before").alias("_row"), F.when(F.col("after").isNotNull(), F.lit("add")).otherwise(F.lit("remove")).alias("op")).select("link_hash", "_row.*", "op")


def incremental_delta(known: DataFrame, new: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """delta(fold(known), fold(known + new)) from the hashes alone that the new commits touch."""
    _, before, after = touched_folds(known, new, hash)
    return delta(before, after)


def heads(commits: DataFrame) -> DataFrame:
    """The commits that none names as its parent."""
    return commits.select("commit_hash").distinct().join(edges(commits).select(F.col("parent").alias("commit_hash")), "commit_hash", "left_anti")


def revision(heads: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """One row: the digest of a set of heads (of which there are few: one for each replica that is at work)."""
    return heads.agg(H.revision(F.array_sort(F.collect_set("commit_hash")), hash).alias("revision"))


def head_groups(commits: DataFrame, group: str) -> DataFrame:
    """Revision by group, for tables that hold many histories."""
    e = edges(commits).select(F.col("parent").alias("commit_hash"))
    top = commits.select(group, "commit_hash").distinct().join(e, "commit_hash", "left_anti")
    return top.groupBy(group).agg(H.revision(F.collect_set("commit_hash")).alias("revision"), F.count(F.lit(1)).alias("n_heads"))


def ancestors(starts: DataFrame, edges: DataFrame, known: DataFrame | None = None, rounds: int = 64, cut: int = 8) -> DataFrame:
    """Commits to be reached from starts(commit_hash) by edges(child, parent), the starts included.

    The walk does not pass what is known(commit_hash), whatever may be missing behind it, nor a parent that has no row. A
    round takes as many generations of all starts together as all rounds before it: the edges of twice the length are
    made by joining the edges with themselves. The visited set is written out every `cut` rounds.
    """
    spark = starts.sparkSession
    if known is not None:
        edges = edges.join(known.select(F.col("commit_hash").alias("child")), "child", "left_anti").join(known.select(F.col("commit_hash").alias("parent")), "parent", "left_anti")
    new = starts.select("commit_hash").distinct()
    if known is not None:
        new = new.join(known.select("commit_hash"), "commit_hash", "left_anti")
    seen, steps = _cut(new), _cut(edges.select("child", "parent").distinct())
    for k in range(rounds):
        new = seen.join(steps, seen.commit_hash == steps.child).select(F.col("parent").alias("commit_hash")).distinct()
        frontier = _cut(new.join(seen, "commit_hash", "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
        if k % cut == cut - 1:
            seen = _cut(seen)
        # every commit reached so far lies within 2**k steps; so do those that one more step of twice that length adds
        on = steps.select(F.col("child").alias("parent"), F.col("parent").alias("_far"))
        steps = _cut(steps.join(on, "parent").select("child", F.col("_far").alias("parent")).distinct())
    raise RuntimeError(f"more than 2 ** {rounds} generations: {spark.sparkContext.applicationId}")


def _cut(df: DataFrame) -> DataFrame:
    """df through the shared folder, so that its lineage does not grow."""
    from ..sources.tables import shared_folder

    path = f"{shared_folder(df.sparkSession)}/walk-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chain_hashes(steps: DataFrame, chain: str, order: str, hash: H.Hash = H.sha256, carried: tuple[str, ...] = ()) -> DataFrame:
    """Commit hashes of linear histories: each commit names the one before it in its chain.

    steps has chain, order, add_hashes and remove_hashes (arrays), author and timestamp. A chain is hashed in one pass over
    its ordered steps; a chain is one row, so its length is to be bounded (a user's days, a branch). Columns named by
    carried are given on with the commits of their steps.
    """
    step = F.struct(order, "add_hashes", "remove_hashes", "author", "timestamp", *carried)
    chains = steps.groupBy(chain).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    empty = F.array().cast(f"array<struct<{order}:{steps.schema[order].dataType.simpleString()},commit_hash:string,previous:array<string>>>")

    def extend(done, x):
        before = F.when(F.size(done) > 0, F.array(F.element_at(done, -1)["commit_hash"])).otherwise(F.array().cast("array<string>"))
        h = H.commit_hash(x["add_hashes"], x["remove_hashes"], before, x["author"], x["timestamp"], hash)
        return F.concat(done, F.array(F.struct(x[order].alias(order), h.alias("commit_hash"), before.alias("previous"))))

    if not carried:
        return chains.select(chain, F.inline(F.aggregate("steps", empty, extend)))
    hashed = chains.select(chain, F.col("steps"), F.aggregate("steps", empty, extend).alias("done"))
    rows = hashed.select(chain, F.inline(F.arrays_zip("done", "steps")))
    return rows.select(chain, "done.*", *[F.col(f"steps.{c}").alias(c) for c in carried])
