"""Links and histories made of the business tables, on which the queries run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing as H
from ..functions import literals as L
from ..operators import history


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts) -> F.Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def chat_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of conversations: containment, type, body and reply. One pass, no join: each row gives its links."""
    c = _table(spark, sf_dir, "conversations")
    conv, turn = F.col("conv_id"), F.col("turn")
    message = _text("msg://", conv, "/", turn)
    link = lambda k, s, p, t: F.struct(F.lit(k).alias("k"), s.alias("source"), F.lit(p).alias("predicate"), t.alias("target"))
    every = F.array(
        link(0, _text("conv://", conv), "flux://has_message", message),
        link(1, message, "flux://entry_type", F.lit("flux://has_message")),
        link(2, message, "flux://body", L.encode_text("text")),
        F.when(turn > 0, link(3, _text("msg://", conv, "/", turn - 1), "flux://has_reply", message)),
    )
    stamp = _text("2024-01-01T00:", F.lpad(turn.cast("string"), 2, "0"), ":00.000Z")
    out = c.select(_text("did:test:", F.col("role")).alias("author"), stamp.alias("timestamp"), ((conv * 100000 + turn) * 10).alias("o"), F.explode(F.filter(every, lambda x: x.isNotNull())).alias("l"))
    return out.select("l.source", "l.predicate", "l.target", "author", "timestamp", (F.col("o") + F.col("l.k")).alias("ord"))


def stamp(ts: str | F.Column = "ts") -> F.Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def link_of(event: F.Column) -> list[F.Column]:
    """The link's parts of an event (ts, event_id, event_type) of the user in user_id."""
    return [
        _text("user://", F.col("user_id")).alias("source"),
        _text("event://", event["event_type"]).alias("predicate"),
        _text("event-id://", event["event_id"]).alias("target"),
        _text("did:user:", F.col("user_id")).alias("author"),
        stamp(event["ts"]).alias("timestamp"),
    ]


def event_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        *link_of(F.struct("ts", "event_id", "event_type")),
        "event_id",
        "user_id",
        "ts",
        "event_type",
    )


def before():
    """The events of a user before each of them."""
    return Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)


def event_diffs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Added links of all events but errors; tombstones: an error removes its user's last link before it."""
    e = event_links(spark, sf_dir).withColumn("link_hash", H.link_hash())
    e = e.withColumn("last", F.last(F.when(F.col("event_type") != "error", F.col("link_hash")), ignorenulls=True).over(before()))
    added = e.filter("event_type != 'error'").drop("last")
    removed = e.filter("event_type = 'error' and last is not null").select("user_id", "ts", F.col("last").alias("link_hash"))
    return added, removed


def event_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step of history for each user and day."""
    added, removed = event_diffs(spark, sf_dir)
    both = added.select("user_id", "ts", F.col("link_hash").alias("a"), F.lit(None).cast("string").alias("r")).unionByName(removed.select("user_id", "ts", F.lit(None).cast("string").alias("a"), F.col("link_hash").alias("r")))
    day = F.date_format("ts", "yyyy-MM-dd")
    steps = both.groupBy("user_id", day.alias("day")).agg(F.array_sort(F.collect_list("a")).alias("add_hashes"), F.array_sort(F.collect_list("r")).alias("remove_hashes"))
    return steps.withColumns({"author": _text("did:user:", F.col("user_id")), "timestamp": F.concat("day", F.lit("T00:00:00.000Z"))})


def event_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, day, commit_hash, previous): one chain for each user."""
    return history.chain_hashes(event_steps(spark, sf_dir), "user_id", "day")


def order_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as links; rows that say the same are the same link."""
    li = _table(spark, sf_dir, "lineitem")
    return li.select(
        _text("order://", F.col("l_orderkey")).alias("source"),
        F.lit("shop://has_line").alias("predicate"),
        _text("line://", F.col("l_linenumber")).alias("target"),
        F.lit("did:shop").alias("author"),
        F.lit("2024-01-01T00:00:00.000Z").alias("timestamp"),
    )


def placed_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return o.select(
        _text("order://", F.col("o_orderkey")).alias("source"),
        F.lit("shop://placed_by").alias("predicate"),
        _text("customer://", F.col("o_custkey")).alias("target"),
        F.lit("did:shop").alias("author"),
        stamp("o_orderdate").alias("timestamp"),
    )
