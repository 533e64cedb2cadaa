"""Deleting runs of lines that stand earlier in the corpus, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, written

#: Lines of the shortest run that counts, and characters of a line that counts as a run by itself.
LINES, LONG = 3, 60


def _fingerprints(docs: DataFrame, length: int, long: int, words: int | None) -> DataFrame:
    """(_doc, _text, fingerprint, runs) of docs(_doc, _text, text): a row for each line that is selected.

    Every run of lines that is to be judged selects its line of least hash, the first of equal ones. So equal runs select
    the same line of them, wherever they stand. runs are those that selected this line: it, and the lines that it is
    extended by to both sides. Each has its first line, number of lines, and two hashes of its content.
    """
    count = F.lit(0)
    if words is not None:
        spaces = f"[{''.join(f'\\x{b:02x}' for b in SPACES)}]+"
        count = lambda x: F.least(F.size(F.filter(F.split(x, spaces), lambda w: w != "")), F.lit(words))
    # of xxhash64 alone, another seed would often not part lines that one seed does not
    line = lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.sha2(x, 256)).alias("g"), (F.length(x) >= long).alias("long"), (count(x) if words is not None else count).alias("words"))
    d = docs.filter("text is not null").select("_doc", "_text", F.transform(F.split("text", "\n"), line).alias("_l"))

    def runs(x, p):
        """Of the line x at p (from 0): the runs that it is the least line of."""
        found = []
        for n in range(1, length + 1) if words is not None else sorted({1, length}):
            for back in range(n):
                start = p - back
                part = F.slice("_l", start + 1, n)
                least = F.lit(True)
                for k in range(n):
                    if k != back:
                        other = F.get("_l", start + k)["h"]
                        least = least & ((other > x["h"]) if k < back else (other >= x["h"]))
                counts = F.lit(n == length)
                if n == 1:
                    counts = counts | x["long"]
                if words is not None:
                    counts = counts | (F.aggregate(part["words"], F.lit(0), lambda a, y: a + y) >= words)
                whole = (start >= 0) & (start + n <= F.size("_l"))
                hashes = [F.xxhash64(F.lit(n), part[c]).alias(name) for c, name in (("h", "run"), ("g", "run2"))]
                found.append(F.when(whole & least & counts, F.struct(start.alias("at"), F.lit(n).alias("n"), *hashes)))
        return F.filter(F.array(*found), lambda r: r.isNotNull())

    every = d.select("_doc", "_text", F.inline(F.transform("_l", lambda x, p: F.struct(x["h"].alias("fingerprint"), runs(x, p).alias("runs")))))
    return every.filter(F.size("runs") > 0)


def deduplicated(docs: DataFrame, lines: int = LINES, long: int = LONG, words: int | None = None) -> DataFrame:
    """docs with text less the repeated runs, and n_lines and n_removed.

    A run is `lines` consecutive lines, or one line of `long` characters or more. With `words`, fewer lines are a run as
    well if they have that many words (parted by white space) or more together; with None (the rule of OP2_SQL), repeats
    of one or two shorter lines stay. A run that also stands earlier (in a document of a smaller doc_id, or further up in
    the same one) is deleted where it stands later; longer repeats go whole, as the runs that they are made of. Where runs
    stand is judged on the input.

    Winnowing selects fingerprints (see _fingerprints()). Those that stand once are dropped. The places of the others are
    extended to both sides, to the runs that selected them, and places of equal runs meet in an aggregate that finds the
    first one; no pairs of places are made, so a line of a third of all documents is one group of partial aggregates.

    A null text stays null, with 0 lines. An empty text is one empty line. A text whose lines all go becomes empty. Runs
    are equal if two 64-bit hashes are, of which one is made of SHA-256 of the lines. A null doc_id comes last. Rows of the
    same doc_id and text are one place: the copies of a run at the same line of them all stay or all go. A text is one row,
    of any length. Columns named like a new one are replaced, in any case; others may have any name; an empty table gives
    one.
    """
    kept = docs.drop("n_lines", "n_removed")
    doc = F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))
    keyed = kept.select(F.struct("*").alias("_row"), doc.alias("_doc"), F.xxhash64("text").alias("_text"), F.col("text").alias("_all"))
    places = _fingerprints(keyed.select("_doc", "_text", F.col("_all").alias("text")), lines, long, words)
    repeated = written(places.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1").select("fingerprint"), "fingerprints")
    near = written(places.join(repeated, "fingerprint").select("_doc", "_text", F.inline("runs")), "line-runs")
    first = near.groupBy("run", "run2").agg(F.min(F.struct("_doc", "at")).alias("_first"), F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    later = near.join(first, ["run", "run2"]).filter(F.struct("_doc", "at") > F.col("_first"))
    gone = later.select("_doc", "_text", "at", "n").distinct().groupBy("_doc", "_text")
    gone = gone.agg(F.array_distinct(F.flatten(F.collect_list(F.sequence("at", F.col("at") + F.col("n") - 1)))).alias("_gone"))
    out = keyed.join(gone, (keyed["_doc"] == gone["_doc"]) & keyed["_text"].eqNullSafe(gone["_text"]), "left").select("_row", "_all", "_gone", F.split("_all", "\n").alias("_lines"))
    n_lines = F.when(F.col("_all").isNull(), 0).otherwise(F.size("_lines")).cast("long").alias("n_lines")
    n_removed = F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed")
    left = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    text = F.when(F.size("_gone") > 0, F.array_join(F.transform(left, lambda i: F.get("_lines", i)), "\n")).otherwise(F.col("_all"))
    return out.select(*[text.alias(c) if c.lower() == "text" else F.col("_row")[c].alias(c) for c in kept.columns], n_lines, n_removed)


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    d = deduplicated(docs)
    return d.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: DuckDB SQL for op2: every run of lines by its content, without fingerprints.
OP2_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(generate_series(0, len(x) - 1)) AS pos, unnest(x) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents WHERE text IS NOT NULL)
), r AS (
  SELECT doc_id, pos, 3 AS n, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS run FROM l
  WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
  UNION ALL SELECT doc_id, pos, 1, line FROM l WHERE length(line) >= 60
), f AS (
  SELECT *, row_number() OVER (PARTITION BY n, run ORDER BY doc_id, pos) AS k FROM r WHERE run IS NOT NULL
), g AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + n - 1)) AS pos FROM f WHERE k > 1
)
SELECT d.doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(c, 0)::BIGINT AS n_removed,
       CASE WHEN text IS NOT NULL THEN sha256(coalesce(kept, '')) END AS kept_sha256
FROM documents d
LEFT JOIN (
  SELECT l.doc_id, count(g.pos) AS c, string_agg(line, chr(10) ORDER BY l.pos) FILTER (WHERE g.pos IS NULL) AS kept
  FROM l LEFT JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id
) k ON d.doc_id = k.doc_id
"""
