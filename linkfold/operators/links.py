"""Pattern queries and set operations over links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions.patterns import is_excluded, is_shape_predicate


def with_hash(links: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    return links.withColumn("link_hash", H.link_hash(hash=hash))


def query_links(links: DataFrame, source: str | None = None, predicate: str | None = None, target: str | None = None, dedup: bool = True) -> DataFrame:
    """Links whose parts equal those given; an empty or missing part is not asked for. One row for each link_hash.

    The filters stand below the deduplication, where the scan takes them: rows of one hash agree in all that is asked.
    """
    out = links
    for name, value in (("source", source), ("predicate", predicate), ("target", target)):
        if value:
            out = out.filter(F.col(name) == value)
    return out.dropDuplicates(["link_hash"]) if dedup else out


def get_link(links: DataFrame, link_hash: str) -> DataFrame:
    return links.filter(F.col("link_hash") == link_hash)


def put_links(stored: DataFrame, new: DataFrame) -> DataFrame:
    """stored with new in it; a new row replaces one of its hash."""
    return stored.join(new.select("link_hash").distinct(), "link_hash", "left_anti").unionByName(last_by_hash(new), allowMissingColumns=True)


def last_by_hash(links: DataFrame, order: str | None = None) -> DataFrame:
    """One row for each hash: the last by `order`, or any."""
    if order is None:
        return links.dropDuplicates(["link_hash"])
    rest = [c for c in links.columns if c not in ("link_hash", order)]
    last = links.groupBy("link_hash").agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select("link_hash", "_last.*")


def remove_links(stored: DataFrame, removed: DataFrame) -> DataFrame:
    return stored.join(removed.select("link_hash"), "link_hash", "left_anti")


def apply_diff(stored: DataFrame, additions: DataFrame, removals: DataFrame) -> DataFrame:
    """Additions first, then removals: a link in both is gone."""
    return remove_links(put_links(stored, additions), removals)


def without_predicates(links: DataFrame, excluded: list[str]) -> DataFrame:
    return links.filter(~is_excluded("predicate", excluded))


def duplicates(links: DataFrame, known: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """links with is_duplicate: whether known(content_hash) holds what the link says."""
    seen = known.select("content_hash").distinct().withColumn("_seen", F.lit(True))
    out = links.withColumn("content_hash", H.content_hash(hash=hash)).join(seen, "content_hash", "left")
    return out.withColumn("is_duplicate", F.coalesce("_seen", F.lit(False))).drop("_seen")


def to_publish(links: DataFrame, origins: DataFrame) -> DataFrame:
    """Links that did not come from the pod; origins(link_hash, origin)."""
    out = links.join(origins.select("link_hash", "origin"), "link_hash", "left")
    return out.filter(F.coalesce(F.col("origin") != "solid", F.lit(True))).drop("origin")


def touches_shapes(*links: DataFrame) -> bool:
    """Whether any link of a diff is part of a shape."""
    return any(not x.filter(is_shape_predicate("predicate")).isEmpty() for x in links)
