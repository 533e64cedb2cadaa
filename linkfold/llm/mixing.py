"""Mixing sources to target weights by systematic sampling, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Weights of the sources in code point order, repeating; null comes last.
WEIGHTS = (5.0, 2.0, 1.0)
#: What the mix takes of all words, and the most that it takes of one source, as multiples.
SHARE, MOST = 1.5, 2.0
#: Each source is numbered in strata of similar size, each stratum in so many parts.
STEPS, SALTS = 8, 16


def word_count(text: str = "text") -> Column:
    """Number of words of a text; 0 for null. One word more is put at its end, so that every space stands before a word;
    then every word becomes one letter, with the space before it."""
    whole = F.concat(F.coalesce(F.col(text), F.lit("")), F.lit(" x"))
    return (F.octet_length(F.regexp_replace(whole, r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", "x")) - 1).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes(source, source_size, n) with a target for each source.

    The words to take are dealt by weight; a source takes at most `most` times its size, and what it leaves is dealt
    again by weight. The end of that is known in closed form: with sources in order of cap / weight, those before some
    place take their cap and all others one multiple of their weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_cap = Window.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    t = sizes.withColumn("_weight", F.element_at(wheel, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("_cap", most * F.col("source_size")).withColumn("_all", F.lit(share) * F.sum("source_size").over(Window.partitionBy()))
    t = t.withColumn("_level", (F.col("_all") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_weight").over(rest))
    # the first place where the level stays below the cap; past the last one all take their cap
    t = t.withColumn("_lambda", F.min(F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_weight"), F.col("_level")))).over(Window.partitionBy())["_level"])
    return t.select("source", "source_size", "n", F.least(F.col("_cap"), F.coalesce(F.col("_lambda") * F.col("_weight"), F.col("_cap"))).alias("target"))


def offset(seed: int) -> Column:
    """One number in [0, 1) for each source, the same on every run."""
    key = F.concat(F.lit(f"{seed}/"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / float(1 << 32)


def mixed(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 8, size: str | None = None) -> DataFrame:
    """Add size, source_size, target, copies and taken to docs.

    All documents of a source are expected equally often: r = target / source_size. Numbered within their source they
    stand at r, 2r, 3r, ...; each gives one copy for each integer between its place and the one before, all moved by one
    random offset of the source. So each has floor(r) or ceil(r) copies, and `most` at most. The numbering goes by size,
    in strata of similar size, so that the words taken come near the target, not the copies alone. No task holds a
    source: strata are numbered alone (in SALTS parts by doc_id) and then moved by the rows before them, which their
    counts tell. size names a column that holds the numbers of words, if they have been counted.

    A null text has size 0 and takes nothing. A null source is a source of its own, the last. A source without words has
    target 0. Repeated rows are numbered each; rows of equal size and doc_id go by a hash of all their columns (but maps),
    so only rows that are alike can change places between runs. A null doc_id counts as 0 in the numbering. A text is only
    counted, so it may be of any length. Columns of the same names as the new ones are replaced, in any case; others may
    have any name; an empty table gives an empty table.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in docs.columns if c.lower() not in new]
    plain = [f.name for f in docs.schema.fields if f.name in kept and "map<" not in f.dataType.simpleString()]
    d = docs.select(F.struct(*kept).alias("_row"), F.col("source"), F.col("doc_id"), F.xxhash64(*plain).alias("_hash"), (F.col(size) if size else word_count()).alias("size"))
    d = d.withColumn("_stratum", F.floor(F.log2(F.col("size") + 1.0) * STEPS).cast("int"))
    d = d.withColumn("_salt", F.pmod(F.coalesce(F.col("doc_id"), F.lit(0)), F.lit(SALTS)).cast("int"))
    cells = d.groupBy("source", "_stratum", "_salt").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_size"))
    sizes = cells.groupBy("source").agg(F.sum("_size").cast("long").alias("source_size"), F.sum("_n").alias("n"))
    ahead = Window.partitionBy("source").orderBy("_stratum", "_salt").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    goal = targets(sizes, weights, share, most)
    cells = cells.join(goal, cells.source.eqNullSafe(goal.source)).select(cells.source.alias("_source"), F.col("_stratum").alias("_st"), F.col("_salt").alias("_sa"), "_before", "source_size", "target")
    within = Window.partitionBy("source", "_stratum", "_salt").orderBy("size", "doc_id", "_hash")
    d = d.withColumn("_at", F.row_number().over(within))
    d = d.join(cells, d.source.eqNullSafe(cells._source) & (d._stratum == cells._st) & (d._salt == cells._sa))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    place = F.col("_before") + F.col("_at")
    copies = F.least(F.floor(offset(seed) + rate * place) - F.floor(offset(seed) + rate * (place - 1)), F.lit(int(-(-most // 1)))).cast("long")
    out = d.select("_row", "size", "source_size", "target", copies.alias("copies"))
    return out.select(*[F.col("_row")[c].alias(c) for c in kept], "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of docs (see mixed() for odd rows)."""
    rows = docs.select("doc_id", "source", "text", F.struct("*").alias("_docs_row"))
    m = mixed(rows, **options).filter("copies > 0").select("_docs_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return m.select(*[F.col("_docs_row")[c].alias(c) for c in docs.columns])


def op8(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", word_count().alias("size"))
    return mixed(written(docs, "sizes"), size="size").select("doc_id", "size", "source_size", "target", "taken")


#: DuckDB SQL for op8; the same numbering, written plainly.
OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
         2.0 * source_size::DOUBLE AS cap, 1.5 * sum(source_size) OVER ()::DOUBLE AS everything FROM s
), l AS (
  SELECT *, cap / weight AS reach,
         (everything - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w
), t AS (
  SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, reach) FROM l WHERE level * weight <= cap) * weight, cap)) AS target FROM l
), n AS (
  SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY floor(log2(size + 1.0) * 8), coalesce(doc_id, 0) % 16, size, doc_id) AS place,
         ('0x' || substr(md5('8/' || coalesce('s' || d.source, 'n')), 1, 8))::BIGINT::DOUBLE / 4294967296.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (least(floor(u + rate * place) - floor(u + rate * (place - 1)), 2) * size)::BIGINT AS taken FROM n
"""
