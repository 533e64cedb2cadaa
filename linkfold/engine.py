"""The engine: a store of commits, its fold, and a folder that replicas share."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schema, ship
from .functions import hashing as H
from .operators import history, links, projection, rdf
from .operators.profiles import Profile, chat_profile, collect_profiles
from .settings import Settings, parse_settings
from .sources import pod
from .sources.tables import Store
from .sources.turtle import parse_turtle
from .streaming.sync import advance, sync_batch

#: Links that one commit holds at most; a larger diff becomes several commits with the same parents.
LINKS = 100_000
#: Query kinds. Fixed values.
KINDS = ("link-pattern",)
#: The profile that is added if none has its native type. Its strings are fixed values.
POST, CONTENT = "http://rdfs.org/sioc/ns#Post", "http://rdfs.org/sioc/ns#content"


class Engine:
    """Commits, folds, queries and syncs.

    emit is called with the change, a DataFrame of links with op 'add' or 'remove', once for each change that is not empty.
    """

    def __init__(self, spark: SparkSession, root: str, shared: str | None = None, author: str = "did:local", settings: str | Settings | None = None, hash: H.Hash = H.sha256, emit: Callable[[DataFrame], None] | None = None):
        self.spark, self.store, self.author, self.hash = spark, Store(spark, root), author, hash
        self.shared = shared.rstrip("/") if shared else None
        self.settings = settings if isinstance(settings, Settings) else parse_settings(settings)
        self.emit = emit or (lambda change: None)
        self._profiles: list[Profile] | None = None
        ship(spark)

    # reading

    def render(self) -> DataFrame:
        return self.store.links()

    def query(self, kind: str, source: str | None = None, predicate: str | None = None, target: str | None = None) -> DataFrame:
        if kind not in KINDS:
            raise ValueError(f"unsupported query kind: {kind}")
        by = "target" if target and not source else "source"
        return links.query_links(self.store.links(by), source, predicate, target, dedup=False)

    def supported_kinds(self) -> list[str]:
        return list(KINDS)

    def heads(self) -> DataFrame:
        return history.heads(self.store.commits())

    def revision(self) -> str | None:
        return history.revision(self.heads(), self.hash).collect()[0].revision

    def profiles(self) -> list[Profile]:
        """Kept until a diff touches shapes."""
        if self._profiles is None:
            found = collect_profiles(self.store.links().withColumn("ord", F.col("timestamp")))
            self._profiles = found if any(p.native_type == POST for p in found) else [*found, chat_profile(POST, CONTENT)]
        return self._profiles

    def interactions(self) -> list[str]:
        """There are none."""
        return []

    def close(self) -> None:
        """Forget what is kept in memory; the tables stay, and a new engine goes on with them."""
        self._profiles = None

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    # writing

    def commit(self, additions: DataFrame | None = None, removals: DataFrame | None = None, timestamp: str | None = None, project: bool = True) -> str:
        """Commit a diff onto the heads; its hash (of a diff of more than LINKS links: the least of its commits'). Publishes
        and projects it if the settings let it. The diff itself is emitted, when the links are up to date."""
        none = schema.none(self.spark, schema.LINK)
        added, removed = ((none if x is None else x).select(*schema.LINK.names) for x in (additions, removals))
        commits = self.store.commits()
        ord0 = commits.agg(F.coalesce(F.max("ord"), F.lit(-1))).collect()[0][0]
        link, empty = F.struct(*schema.LINK.names), F.lit(None).cast(schema.LINK)
        diff = added.select(link.alias("a"), empty.alias("r")).unionByName(removed.select(empty.alias("a"), link.alias("r")))
        parts = max(1, -(-diff.count() // LINKS))
        chunk = F.pmod(F.xxhash64("a", "r"), F.lit(parts)) if parts > 1 else F.lit(0).cast("long")
        gathered = diff.groupBy(chunk.alias("chunk")).agg(F.collect_list("a").alias("additions"), F.collect_list("r").alias("removals"))
        every = self.spark.range(parts).withColumnRenamed("id", "chunk").join(gathered, "chunk", "left")
        lists = {c: F.coalesce(F.col(c), F.array().cast(T.ArrayType(schema.LINK))) for c in ("additions", "removals")}
        heads = F.broadcast(self.heads().agg(F.array_sort(F.collect_set("commit_hash")).alias("previous")))  # one row
        now = timestamp or datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z")
        row = every.withColumns(lists).join(heads, how="cross")
        row = row.withColumns({"author": F.lit(self.author), "timestamp": F.lit(now), "ord": F.lit(ord0 + 1).cast("long")})
        new = self.store.append_commits(history.build_commits(row, self.hash).select(*schema.COMMITS.names))
        name = new.agg(F.min("commit_hash")).collect()[0][0] or ""
        if links.touches_shapes(added, removed):
            self._profiles = None

        def own(change: DataFrame) -> None:
            told = links.with_hash(added, self.hash).withColumn("op", F.lit("add")).unionByName(links.with_hash(removed, self.hash).withColumn("op", F.lit("remove")))
            self.emit(told)

        if advance(self.store, own, self.hash) is None and not diff.isEmpty() and name:
            own(diff)
        if self.shared and self.settings.publishes:
            pod.publish_commits(new, f"{self.shared}/diffs", self.hash)
            if project:
                self.project_diff(added, ord0 + 1)
        return name

    def refold(self) -> DataFrame:
        """Write the fold of all commits as the links table, whatever it holds; commits and syncs do not need it."""
        return self.store.replace_links(history.fold(self.store.commits(), self.hash))

    def project_diff(self, added: DataFrame, at: int) -> DataFrame:
        """Write a view for each instance that the added links make up by themselves; removals change no view."""
        found = projection.project_instances(projection.authored(added).withColumn("ord", F.struct("timestamp", "source", "predicate", "target")), self.profiles())
        triples = projection.to_native(found).withColumn("doc", F.col("subject"))
        turtle = rdf.to_turtle(triples).select(self.hash(F.col("doc")).alias("name"), "turtle", F.lit(at).cast("long").alias("at"))
        pod.write_views(turtle, f"{self.shared}/views")
        return turtle

    # replicas

    def sync(self, verify: bool = False) -> DataFrame | None:
        """Take the commits that others have published; the change, or None."""
        if not self.shared or not self.settings.subscribes:
            return None
        known = self.store.commit_hashes().select(F.col("commit_hash").alias("name"))
        found, some_known = pod.unseen(self.spark, f"{self.shared}/diffs", "diff", known)
        change = sync_batch(self.store, found, self.emit, self.hash, verify, some_known)
        if change is not None and links.touches_shapes(change):
            self._profiles = None
        return change

    full_sync = sync

    def ingest_views(self) -> str | None:
        """Commit the links of views of which not all are known; the commit's hash, or None."""
        triples = parse_turtle(pod.read_views(self.spark, f"{self.shared}/views"))
        subjects = rdf.resource_subject(triples).filter("subject is not null")
        own = triples.join(subjects.withColumnRenamed("subject", "_s"), "doc").filter("subject = _s").drop("_s")
        found = projection.ingest_native(own, self.profiles())
        fresh = projection.new_resources(found, self.store.links())
        now = F.lit(datetime.now(UTC).isoformat(timespec="milliseconds").replace("+00:00", "Z"))
        new = fresh.select("source", "predicate", "target", F.coalesce("author", F.lit(self.author)).alias("author"), F.coalesce("timestamp", now).alias("timestamp"), F.struct(F.lit("").alias("signature"), F.lit("").alias("key")).alias("proof"), F.lit(None).cast("string").alias("status"))
        return None if new.isEmpty() else self.commit(new, project=False)

    def handle_signal(self, message: str) -> DataFrame | None:
        """A push notice: an update or a creation starts a sync; anything else, or what is no JSON, does nothing."""
        try:
            kind = json.loads(message).get("type")
        except (ValueError, AttributeError):
            return None
        return self.sync() if kind in ("Update", "Create") else None
