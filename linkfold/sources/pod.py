"""Folders of Turtle resources: commits in diffs/, views in views/. They are listed, read, and added to.

A resource is a file <kind>-<name>.ttl, or a row (name, turtle) of Parquet files beside them, which is what this engine
writes. A name is a content address, so a name that is there is never written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import hashing as H
from ..functions.uris import contained, name_of
from ..operators.rdf import commit_turtle, commits_from_turtle
from ..schema import none
from .tables import clashes

RESOURCES = "name string, turtle string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def resources(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """(name, doc, turtle) of a folder; nothing if there is none."""
    folder = folder.rstrip("/")
    out = none(spark, "name string, doc string, turtle string")
    if _exists(spark, f"{folder}/{kind}-*.ttl"):
        files = spark.read.option("wholetext", True).option("pathGlobFilter", f"{kind}-*.ttl").text(folder)
        files = files.select(name_of(F.input_file_name(), kind).alias("name"), F.input_file_name().alias("doc"), F.col("value").alias("turtle"))
        out = out.unionByName(files.filter("name is not null"))
    if _exists(spark, f"{folder}/*.parquet"):
        out = out.unionByName(_documents(_rows(spark, folder), folder, kind))
    return out


def _documents(rows: DataFrame, folder: str, kind: str) -> DataFrame:
    return rows.select("name", F.concat(F.lit(f"{folder}/{kind}-"), "name", F.lit(".ttl")).alias("doc"), "turtle")


def listing(triples: DataFrame, container: str, kind: str) -> DataFrame:
    """(url, name) of a container's members of a kind, from the triples of its listing."""
    members = triples.filter(F.col("predicate") == C.CONTAINS).select(contained(F.lit(container), "object").alias("url")).distinct()
    return members.withColumn("name", name_of("url", kind)).filter("name is not null")


def read_commits(found: DataFrame) -> DataFrame:
    """Commits (without ord) of resources; what is none, or cannot be read, is left out."""
    return commits_from_turtle(found)


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    if not _exists(spark, f"{folder.rstrip('/')}/*.parquet"):
        return none(spark, RESOURCES)
    return spark.read.schema(RESOURCES).option("pathGlobFilter", "*.parquet").parquet(folder)


def unseen(spark: SparkSession, folder: str, kind: str, known: DataFrame) -> tuple[DataFrame, bool]:
    """resources() without the Parquet files of which known(name) has every name, and whether it may still have some of the
    others' names. Names alone are read for that; the files that the driver hears of are those with something new."""
    if _exists(spark, f"{folder.rstrip('/')}/{kind}-*.ttl") or not _exists(spark, f"{folder.rstrip('/')}/*.parquet"):
        return resources(spark, folder, kind), True
    names = _rows(spark, folder).select("name", F.col("_metadata.file_path").alias("file"))
    had = known.select("name").distinct().withColumn("had", F.lit(1))
    files = names.join(had, "name", "left").groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count("had").alias("n_had")).filter("n_had < n").collect()
    if not files:
        return resources(spark, folder, kind).limit(0), False
    rows = _rows(spark, folder).filter(F.col("_metadata.file_path").isin([f.file for f in files]))
    return _documents(rows, folder.rstrip("/"), kind), any(f.n_had for f in files)


def publish_commits(commits: DataFrame, folder: str, hash: H.Hash = H.sha256) -> None:
    """publish() of the texts of commits, which should be stored: their hashes are compared first, and texts are dealt out
    only if a hash stands twice or is there."""
    turtle = commit_turtle(commits, hash).select(F.col("doc").alias("name"), "turtle")
    if clashes(commits.select("commit_hash"), _rows(commits.sparkSession, folder).select("name"))[1]:
        publish(turtle, folder)
    else:
        turtle.write.mode("append").parquet(folder)


def publish(turtle: DataFrame, folder: str) -> DataFrame:
    """Add (name, turtle) rows to a folder, but those whose name is there."""
    spark = turtle.sparkSession
    there = _rows(spark, folder)
    new = turtle.select("name", "turtle").dropDuplicates(["name"]).join(there.select("name"), "name", "left_anti")
    new.write.mode("append").parquet(folder)
    return new


def write_views(turtle: DataFrame, folder: str) -> None:
    """Views are written over: (name, turtle, at), of which the last of a name counts."""
    turtle.select("name", "turtle", "at").write.mode("append").parquet(folder)


def read_views(spark: SparkSession, folder: str) -> DataFrame:
    """(doc, turtle) of a folder of views."""
    folder = folder.rstrip("/")
    out = none(spark, "doc string, turtle string")
    if _exists(spark, f"{folder}/*.parquet"):
        rows = spark.read.schema(RESOURCES + ", at long").option("pathGlobFilter", "*.parquet").parquet(folder)
        last = rows.groupBy("name").agg(F.max_by("turtle", "at").alias("turtle"))
        out = out.unionByName(last.select(F.concat(F.lit(f"{folder}/view-"), "name", F.lit(".ttl")).alias("doc"), "turtle"))
    if _exists(spark, f"{folder}/view-*.ttl"):
        files = spark.read.option("wholetext", True).option("pathGlobFilter", "view-*.ttl").text(folder)
        out = out.unionByName(files.select(F.input_file_name().alias("doc"), F.col("value").alias("turtle")))
    return out


