"""Near-duplicate documents by bottom-k sketches of their shingles, verified on the full sets."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .components import components

#: Values of a sketch.
SKETCH = 64
#: How far an estimate from a sketch may be off, in standard deviations of it.
SIGMAS = 5.0
#: Rounds in which every list tests its sets against one of them.
ROUNDS = 2
#: Ratio of the sizes that one band holds.
BAND = 1.1
_LAST = (1 << 63) - 1


def shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    """Yields (first row, last row, row, hash): sorted distinct shingle hashes of rows of lower-cased words."""
    lower = common.lower_table()
    for lo, hi in common.chunks(offsets):
        part, at = lower[data[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]
        starts, stops, rows = common.words(part, at)
        if not len(starts):
            yield lo, hi, np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        words = common.word_hashes(part, starts, stops)
        n = np.diff(rows)
        many = np.where(n >= size, n - size + 1, np.minimum(n, 1))
        row = np.repeat(np.arange(hi - lo), many)
        first = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + rows[:-1][row]
        h = words[first]
        for k in range(1, size):
            more = np.flatnonzero(first + k < rows[1:][row])
            h[more] = common.pair(h[more], words[first[more] + k])
        h = h.view(np.int64)
        order = np.lexsort((h, row))
        row, h = row[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        yield lo, hi, row[new], h[new]


def _whole(ends: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """Two independent hashes of every set: sums of two mixes of its shingles, mixed again with its size."""
    out = []
    for x in (common.mix(h.view(np.uint64)), common.mix(common.mix(~h.view(np.uint64)))):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x)))
        out.append(common.pair(sums[ends[1:]] - sums[ends[:-1]], np.diff(ends).astype(np.uint64)).view(np.int64))
    return out


def signatures(docs: DataFrame, size: int, sketch: int = SKETCH, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keys, n, h1, h2 and sketch of every row: the size of its set, two hashes of all of it, and its least values."""
    schema = T.StructType([*[docs.schema[c] for c in keys], *[T.StructField(c, T.LongType()) for c in ("n", "h1", "h2")], T.StructField("sketch", T.ArrayType(T.LongType()))])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = common.text_buffers(batch.column("text"))
            for lo, hi, row, h in shingles(data, offsets, size):
                ends = np.searchsorted(row, np.arange(hi - lo + 1))
                n = np.diff(ends)
                few = np.minimum(n, sketch)
                take = np.arange(few.sum()) - np.repeat(np.cumsum(few) - few, few) + np.repeat(ends[:-1], few)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(few))).astype(np.int32)), pa.array(h[take]))
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(lo, hi - lo) for c in keys], pa.array(n), *map(pa.array, _whole(ends, h)), lists], names=schema.names)

    return docs.select(*keys, "text").mapInArrow(common.trimmed(run), schema)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """h1, h2 and all, the whole set, beside the other columns of rows with a text."""
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()), T.StructField("all", T.ArrayType(T.LongType()))])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            data, offsets = common.text_buffers(batch.column("text"))
            for lo, hi, row, h in shingles(data, offsets, size):
                ends = np.searchsorted(row, np.arange(hi - lo + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(h))
                yield pa.RecordBatch.from_arrays([*[batch.column(f.name).slice(lo, hi - lo) for f in kept], *map(pa.array, _whole(ends, h)), lists], names=schema.names)

    return docs.mapInArrow(common.trimmed(run), schema)


def estimate(a: str, b: str, sketch: int = SKETCH) -> Column:
    """Share of the least values of the union of two sets that both hold, from their sketches."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, sketch)
    return F.size(F.array_intersect(least, F.array_intersect(a, b))) / F.size(least)


def _slack(percent: int, sketch: int) -> float:
    share = percent / 100
    return SIGMAS * math.sqrt(share * (1 - share) / sketch)


#: Lengths of runs, and the sizes of the sets that are posted by them.
RUNS = {4: (16, None), 3: (7, 24), 2: (2, 10)}


def lists(classes: DataFrame, percent: int, sketch: int = SKETCH) -> DataFrame:
    """(list, id, n): the inverted lists that a pair must share one of.

    The list of a retained value is split by the values that follow it in the sketch: a run of them names a part. What two
    sketches overlap in is broken into runs by the values that only one of them has. Let d of the u least values of the
    union be such: then some run has (u - d) / (d + 1) values or more. For a similarity of 0.8 and whole sets that is four
    from u = 16 on, three from 6 on, else two, so no pair is lost. For longer sets d is random; no run of four is left with
    a probability of some 1e-6. (Below 0.8, lists are those of single values.)

    Runs whose values all stand in very many sets join what shares a passage and no more. So a run of a set that is not
    whole in its sketch must hold a rare value: one of the first of its sketch, in order of frequency, of which two similar
    sketches share one at least (but for SIGMAS), and usually most.
    """
    every = classes.select("id", F.posexplode("sketch").alias("at", "value"))
    counts = every.groupBy("value").agg(F.count(F.lit(1)).alias("f")).filter("f > 1")
    shared = every.join(counts, "value").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "value", "f"))).alias("v"))
    shared = shared.join(classes.select("id", "n", F.size("sketch").alias("k")), "id")
    first = F.col("k") - math.floor(sketch * (percent / 100 - _slack(percent, sketch))) + 1
    many = (first - (F.col("k") - F.size("v"))).cast("int")  # values of one set only come first in the order
    order = F.array_sort(F.transform("v", lambda x: F.struct(x["f"].alias("f"), x["value"].alias("value"))))
    whole = F.col("n") * 100 <= sketch * percent
    shared = shared.select("id", "n", "v", whole.alias("whole"), F.when(many > 0, F.get(order, F.least(many, F.size("v")) - 1)).alias("rare"))

    def runs(r: int, low: int, high: int | None):
        def run(i):
            part = F.slice("v", i, r)
            rare = F.col("whole") | F.exists(part, lambda x: F.coalesce(F.struct(x["f"].alias("f"), x["value"].alias("value")) <= F.col("rare"), F.lit(False)))
            follow = F.element_at(part, -1)["at"] - F.element_at(part, 1)["at"] == r - 1
            return F.when(follow & rare, F.xxhash64(F.lit(r), part["value"]))

        sized = (F.col("n") >= low) & (F.col("n") <= high) if high else F.col("n") >= low
        return F.when(sized & (F.size("v") >= r), F.transform(F.sequence(F.lit(1), F.size("v") - r + 1), run))

    found = [F.coalesce(runs(r, *sizes), F.array().cast("array<bigint>")) for r, sizes in (RUNS if percent >= 80 else {1: (1, None)}).items()]
    return shared.select("id", "n", F.explode(F.array_distinct(F.concat(*found))).alias("list")).filter("list is not null")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rounds: int = ROUNDS, row: str | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of docs(doc_id, text).

    Words are [^\\x20\\x09-\\x0D]+ after A-Z are lower-cased; the set of a text are its distinct shingles of `size` words, or
    all its words as one if they are fewer. Texts are linked if 100 * intersection >= percent * union of their full sets.
    component_id is the least doc_id that links lead to, and kept tells that it is the row's own. A null or empty text, or
    one without words, has no set and is linked with nothing. Rows of one doc_id with unequal sets are different texts; a
    null doc_id is never the least but where there is no other. Other columns are dropped; an empty table gives one. `row`
    names a column that tells rows apart: it is kept too, with component: the same for the rows of one component alone (a
    component_id may be that of several, where a doc_id is), and null for a row without a set. A shingle is known by a
    64-bit hash, a set as a whole by 128 bits. A text is taken whole: a task holds some 60 bytes for each of its bytes.

    One hash function gives every set its sketch, the least of its hashes in order. Equal sets are one node. Retained
    values make inverted lists (see lists()); nodes overlap if they meet in one.

    In a round, every list tests its nodes against its hub, and no two others: as many tests as the lists have rows, at
    most. The hub is the node that meets most others in all its lists, which in a group of near copies is the text that
    they were made from or the one nearest to it; in other rounds, any. What fits by size and by the estimate from the
    sketch of the union is verified on the full sets.

    Lists with nodes that are still unlinked are judged by their hub h (see leftover()): what each node shares with h
    bounds what two of them can share, but for values that are not in h. So only those pairs are left that share a
    value which h lacks, or that the bound lets pass, not all pairs of a list.
    """
    spark = docs.sparkSession
    keys = ["doc_id"] if row is None else ["doc_id", row]
    named = docs.select(*keys, "text", F.xxhash64("text").alias("_name"))
    rows = common.written(signatures(named, size, keys=(*keys, "_name")), "signatures")
    place = F.struct(F.coalesce("doc_id", F.lit(_LAST)).alias("o"), F.col("_name").alias("name"))
    classes = rows.filter("n > 0").groupBy("h1", "h2").agg(F.min(place).alias("place"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = common.written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    rows, old = common.written(rows.drop("sketch", "_name"), "signatures"), rows
    common.dropped(old)
    posts = common.written(lists(classes, percent), "posts")
    sizes = posts.groupBy("list").agg(F.count(F.lit(1)).alias("_c")).filter("_c > 1")
    posts, old = common.written(posts.join(sizes, "list"), "posts"), posts
    common.dropped(old)
    fame = posts.groupBy("id").agg(F.sum("_c").alias("fame"))
    posts, old = common.written(posts.drop("_c").join(fame, "id"), "posts"), posts
    common.dropped(old)
    # the set of a node is computed again from a text of its least doc_id
    wanted = posts.select("id").distinct().join(classes, "id")
    sketches = common.written(wanted.select("id", "sketch"), "sketches")
    texts = named.select(F.coalesce("doc_id", F.lit(_LAST)).alias("_o"), "_name", "text")
    texts = texts.join(wanted.select(F.col("place.o").alias("_o"), F.col("place.name").alias("_name"), "id"), ["_o", "_name"]).dropDuplicates(["_o", "_name"])
    sets = common.Bucketed(full_sets(texts.select("id", "text"), size).select("id", "all"), "id")
    classes, old = common.written(classes.select("id", "h1", "h2", F.col("place.o").alias("o")), "classes"), classes
    common.dropped(old)
    try:
        whole, links = _components(posts, sets.table, sketches, percent, rounds)
    finally:
        sets.drop()
    final = classes.join(whole.withColumnRenamed("node", "id"), "id", "left") if whole is not None else classes.withColumn("component", F.col("id"))
    final = final.withColumn("component", F.coalesce("component", "id"))
    least = final.groupBy("component").agg(F.min("o").alias("_o"))
    final = common.written(final.join(least, "component").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "_o", "component"), "components")
    common.dropped(classes, posts, sketches, whole, *links)
    out = rows.select(*keys, "n", "h1", "h2")
    out = out.join(final, (out.h1 == final["_h1"]) & (out.h2 == final["_h2"]) & (out.n > 0), "left")
    component = F.when(F.col("n") > 0, F.when(F.col("_o") == _LAST, F.col("doc_id")).otherwise(F.col("_o"))).otherwise(F.col("doc_id"))
    more = [] if row is None else [row, "component"]
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), *more)


def _components(posts: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int, rounds: int) -> tuple[DataFrame | None, list[DataFrame]]:
    """(node, component) of the nodes that links lead to others, None without links; and the tables of links."""
    links, whole = [], None
    for k in range(rounds + 1):
        p = posts.withColumn("component", F.col("id")) if whole is None else posts.join(whole.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        hubs = p.groupBy("list").agg(F.min(F.struct((-F.col("fame") if k != 1 else F.xxhash64("id")).alias("r"), "id", "n", "component")).alias("hub"), F.min("component").alias("_x"), F.max("component").alias("_y"))
        hubs = hubs.filter("_x != _y").select("list", F.col("hub.id").alias("h"), F.col("hub.n").alias("nh"), F.col("hub.component").alias("ch"))
        met = p.join(hubs, "list").filter("id != h").select("id", "n", "component", "h", "nh", "ch").distinct()
        if k < rounds:
            fits = met.filter("component != ch").filter(F.least("n", "nh") * 100 >= F.greatest("n", "nh") * percent)
            new = common.written(verified(fits.select(F.col("id").alias("a"), F.col("h").alias("b")), sets, sketches, percent), "links")
        else:
            new = leftover(met, sets, sketches, percent)
        if new.isEmpty():
            common.dropped(new)
            continue
        links.append(new)
        old, whole = whole, components(_union(links))
        common.dropped(old)
    return whole, links


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def verified(pairs: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough; their sketches are asked first."""
    near = pairs.join(sketches.select(F.col("id").alias("a"), F.col("sketch").alias("_sa")), "a").join(sketches.select(F.col("id").alias("b"), F.col("sketch").alias("_sb")), "b")
    near = near.filter(estimate("_sa", "_sb") >= percent / 100 - _slack(percent, SKETCH)).select("a", "b")
    full = near.join(sets.select(F.col("id").alias("a"), F.col("all").alias("_a")), "a").join(sets.select(F.col("id").alias("b"), F.col("all").alias("_b")), "b")
    full = full.withColumn("_both", F.size(F.array_intersect("_a", "_b")))
    return full.filter(F.col("_both") * 100 >= (F.size("_a") + F.size("_b") - F.col("_both")) * percent).select("a", "b")


def leftover(met: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between nodes that have a hub in common and are in different components.

    met(id, n, component, h, nh, ch) has the nodes of each hub h. Let i be how many values a node shares with h. Two nodes
    u and w share min(i of u, i of w) values of h at most, and besides only values that h lacks. With p = percent, they are
    linked if they share p * (n of u + n of w) / (100 + p) values or more. So either

    - the first number alone is as much. One of them, u, is not in the component of h; then n of w is bounded by what u
      shares with h, which for most u is less than any set that could be linked with it has. Sizes are dealt into bands.
    - or they share values that h lacks. Those lists are short: h stands for all that its nodes have in common. With the
      values of each node in one order, by their number among the nodes of h, the first that two nodes share tells how
      many more they can share; what cannot suffice makes no pair.
    """
    a_set, b_set = sets.select("id", F.col("all").alias("_all")), sets.select(F.col("id").alias("h"), F.col("all").alias("_hub"))
    own = met.join(a_set, "id").join(b_set, "h").withColumn("_more", F.array_except("_all", "_hub"))
    own = common.written(own.select("h", "id", "n", "nh", "component", "ch", (F.col("n") - F.size("_more")).alias("i"), "_more"), "apart")
    direct = own.filter("component != ch").filter(F.col("i") * 100 >= (F.col("n") + F.col("nh") - F.col("i")) * percent).select(F.col("id").alias("a"), F.col("h").alias("b"))

    def side(df: DataFrame, mark: str, *columns: str) -> DataFrame:
        return df.select(*columns, *[F.col(c).alias(c + mark) for c in ("id", "n", "component", "i", "out")])

    def fits(more: Column) -> Column:
        near = F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * percent
        enough = (more + F.least("i1", "i2")) * (100 + percent) >= (F.col("n1") + F.col("n2")) * percent
        # one of the two is out of the hub's component; if both are, the pair is made once
        return (F.col("component1") != F.col("component2")) & near & enough & (~F.col("out2") | (F.col("id1") < F.col("id2")))

    own_out = own.withColumn("out", F.col("component") != F.col("ch"))
    values = own_out.select("h", "id", F.explode("_more").alias("value"), "component")
    counts = values.groupBy("h", "value").agg(F.count(F.lit(1)).alias("f"), F.min("component").alias("_x"), F.max("component").alias("_y")).filter("_x != _y")
    ranked = values.join(counts.select("h", "value", "f"), ["h", "value"]).groupBy("h", "id").agg(F.array_sort(F.collect_list(F.struct("f", "value"))).alias("_v"))
    ranked = ranked.join(own_out.drop("_more"), ["h", "id"]).select("h", "id", "n", "component", "i", "out", F.size("_v").alias("_s"), F.posexplode("_v").alias("_p", "_x"))
    # what a node must share at least, beside values of h, with any set that it can be linked with
    least = F.ceil(F.col("n") * percent / 100 * percent / (100 + percent) + F.col("n") * percent / (100 + percent) - 1e-9) - F.col("i")
    ranked = ranked.withColumn("rest", F.col("_s") - F.col("_p")).filter(F.col("rest") >= least)
    ranked = common.written(ranked.select("h", F.col("_x.value").alias("value"), "id", "n", "component", "i", "out", "rest"), "ranked")
    u, w = side(ranked.filter("out"), "1", "h", "value", F.col("rest").alias("rest1")), side(ranked, "2", "h", "value", F.col("rest").alias("rest2"))
    sharing = u.join(w, ["h", "value"]).filter(fits(F.least("rest1", "rest2")))

    band = lambda n: F.floor(F.log(n.cast("double")) / math.log(BAND)).cast("int")
    most, fewest = F.floor(F.col("i") * (100 + percent) / percent) - F.col("n"), F.greatest(F.lit(1), F.floor(F.col("n") * percent / 100))
    low = own_out.drop("_more").filter("out").filter(most >= fewest).withColumn("band", F.explode(F.sequence(band(fewest), band(most))))
    bounded = side(low, "1", "h", "band").join(side(own_out.withColumn("band", band(F.col("n"))), "2", "h", "band"), ["h", "band"]).filter(fits(F.lit(0)))

    pairs = sharing.select("id1", "id2").unionByName(bounded.select("id1", "id2"))
    pairs = pairs.select(F.least("id1", "id2").alias("a"), F.greatest("id1", "id2").alias("b")).distinct()
    out = common.written(direct.unionByName(verified(pairs, sets, sketches, percent)), "links")
    common.dropped(own, ranked)
    return out


def op1(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), size=2)


#: DuckDB SQL for op1: all pairs that share a shingle, and all that can be reached. For tables in which doc_id is unique.
OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 1], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS i FROM d WHERE len(w) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), b AS (
  SELECT x, y FROM l UNION ALL SELECT y, x FROM l
), r AS (
  SELECT doc_id, doc_id AS c FROM documents UNION SELECT b.y, r.c FROM r JOIN b ON r.doc_id = b.x
)
SELECT doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(c) AS component_id, doc_id = min(c) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""
