"""From raw documents to token counts: STAGES in order, each over all that the one before has kept.

Every stage takes an empty table, null, empty and very long texts, and repeated rows; columns of documents that it does not
need may be null, missing or more. What each gives for such rows is in its docstring. A stage reads texts whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkfold import ship
from linkfold.llm import bpe, line_dedup, minhash_dedup, mixing, toxicity
from linkfold.llm.common import dropped, written

#: Words from which on one or two lines are a run whose repeats go.
WORDS = 4


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from the labels, does not reject.

    Rows are judged each, by their text alone: a null or empty one is judged as a text without features, and repeated rows
    all stay or all go. Without labels of both kinds nothing is rejected, unless most labels say toxic.
    """
    ship(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.select("doc_id", "text"), labels)
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that stand earlier; a document of which nothing is left goes.

    Repeats of one or two lines go too if they have WORDS words. n_chars, if there is one, is counted again where lines
    went. A null or empty text stays as it is; the first place of a line is that of the least doc_id, null being last; rows
    of one doc_id and text are one place, so they stay or lose lines together.
    """
    d = line_dedup.deduplicated(docs, words=WORDS).filter("n_removed < n_lines or n_removed = 0")
    if "n_chars" not in docs.columns:
        return d.select(*docs.columns)
    length = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return d.withColumn("n_chars", length).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, of its least doc_id (null comes last). Rows without words all stay.

    Rows are told apart by number, so a doc_id may have several texts, or repeat, or be null.
    """
    ship(spark)
    rows = written(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("place")), "rows")
    texts = rows.select(F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), "place")
    found = minhash_dedup.near_duplicates(texts, size=5, percent=80, row="place").filter("component is not null")
    found = written(found.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), "place", "component"), "found")
    kept = found.groupBy("component").agg(F.min(F.struct("doc", "place")).alias("kept")).select(F.col("kept.place").alias("place"))
    gone = found.join(kept, "place", "left_anti").select("place")
    return rows.join(gone, "place", "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them: none, once or twice. Those without words are not taken."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents but the text, with the token ids and digests of ids and decoded bytes; null counts as empty."""
    ship(spark)
    return bpe.bpe(docs, decoded=False)


STAGES = [("toxicity", clean), ("line_dedup", lines), ("minhash_dedup", near_copies), ("mixing", mix), ("byte_bpe", tokens)]

#: The model of the first stage is not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what each stage returns is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
        dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
