"""Links as triples and back, and the text form of triples."""

from __future__ import annotations

import itertools
import os
import re

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ..functions import hashing as H
from ..functions.uris import compact_uri, prefix_block
from ..sources.turtle import parse, parse_turtle, read_written
from ..workers import trimmed


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def _triple(subject: Column, predicate: str, object: Column, literal: bool = False, datatype: str | None = None) -> Column:
    return F.struct(
        subject.alias("subject"),
        F.lit(predicate).alias("predicate"),
        object.alias("object"),
        F.lit(literal).alias("object_is_literal"),
        F.lit(datatype).cast("string").alias("object_datatype"),
    )


def link_triples(node: Column, link: Column, kind: str = C.LINK, head: list[Column] | None = None) -> Column:
    """The array of triples that say what a link (a struct) is; proof parts only if they are not empty."""
    text = lambda x: F.coalesce(x, F.lit(""))
    proof = link["proof"]
    every = [
        _triple(node, C.RDF_TYPE, F.lit(kind)),
        *(head or []),
        _triple(node, C.RDF_SUBJECT, text(link["source"])),
        _triple(node, C.RDF_PREDICATE, text(link["predicate"])),
        _triple(node, C.RDF_OBJECT, text(link["target"])),
        _triple(node, C.AUTHOR, link["author"], True),
        _triple(node, C.TIMESTAMP, link["timestamp"], True, C.XSD_DATETIME),
        F.when(text(proof["signature"]) != "", _triple(node, C.SIGNATURE, proof["signature"], True)),
        F.when(text(proof["key"]) != "", _triple(node, C.KEY, proof["key"], True)),
    ]
    return F.filter(F.array(*every), lambda x: x.isNotNull())


def reify(links: DataFrame, name: Column | None = None) -> DataFrame:
    """Triples (doc, ord, ...) of links; doc is the link's name, its content key if none is given."""
    name = H.content_key() if name is None else name
    link = F.struct("source", "predicate", "target", "author", "timestamp", "proof")
    out = links.select(name.alias("doc"), link.alias("l")).select("doc", F.posexplode(link_triples(F.concat(F.lit("#"), F.col("doc")), F.col("l"))).alias("ord", "t"))
    return out.select("doc", "ord", "t.*")


def raw_triples(links: DataFrame, *keys: str) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return links.select(*keys, text("source").alias("subject"), text("predicate").alias("predicate"), text("target").alias("object"), F.lit(False).alias("object_is_literal"), F.lit(None).cast("string").alias("object_datatype"))


def first_objects(triples: DataFrame, keys: list[str], wanted: dict[str, str]) -> DataFrame:
    """A row for each group of keys with the first object of each wanted predicate; one aggregate, no join."""
    used = triples.filter(F.col("predicate").isin(*wanted.values()))
    return used.groupBy(*keys).agg(*[F.min(F.when(F.col("predicate") == p, F.struct("ord", "object")))["object"].alias(c) for c, p in wanted.items()])


#: Columns of a link and the predicates that hold them.
PARTS = {"source": C.RDF_SUBJECT, "predicate": C.RDF_PREDICATE, "target": C.RDF_OBJECT, "author": C.AUTHOR, "timestamp": C.TIMESTAMP, "signature": C.SIGNATURE, "key": C.KEY}


def dereify(triples: DataFrame, now: str, base: str = "") -> DataFrame:
    """The links of typed nodes that have all three parts. A missing author is the base, a missing time is `now`."""
    typed = triples.filter((F.col("predicate") == C.RDF_TYPE) & (F.col("object") == C.LINK)).groupBy("doc", "subject").agg(F.min("ord").alias("ord"), F.count(F.lit(1)).alias("_times"))
    out = first_objects(triples, ["doc", "subject"], PARTS).join(typed, ["doc", "subject"])
    out = out.filter("source is not null and predicate is not null and target is not null")
    # a node that is typed twice is found twice
    out = out.withColumn("_i", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))))
    empty = lambda c: F.coalesce(c, F.lit(""))
    return out.select("doc", "ord", "source", "predicate", "target", F.coalesce("author", F.lit(f"solid:{base}")).alias("author"), F.coalesce("timestamp", F.lit(now)).alias("timestamp"), F.struct(empty("signature").alias("signature"), empty("key").alias("key")).alias("proof"))


def format_term(uri) -> Column:
    uri = _col(uri)
    short = compact_uri(uri)
    return F.when(short != uri, short).otherwise(F.concat(F.lit("<"), uri, F.lit(">")))


def format_literal(value, datatype) -> Column:
    value, datatype = _col(value), _col(datatype)
    quoted = F.concat(F.lit('"'), F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when((F.coalesce(datatype, F.lit("")) != "") & (datatype != C.XSD_STRING), F.concat(quoted, F.lit("^^"), format_term(datatype))).otherwise(quoted)


def format_pair(predicate="predicate", object="object", literal="object_is_literal", datatype="object_datatype") -> Column:
    p = F.when(_col(predicate) == C.RDF_TYPE, F.lit("a")).otherwise(format_term(predicate))
    return F.concat_ws(" ", p, F.when(_col(literal), format_literal(object, datatype)).otherwise(format_term(object)))


def format_triple() -> Column:
    return F.concat_ws(" ", format_term("subject"), format_pair())


def to_turtle(triples: DataFrame, prefixes: dict[str, str] = C.PREFIXES) -> DataFrame:
    """(doc, turtle): documents in order of the subjects' first triples, each subject with its list of properties."""
    head = prefix_block(prefixes) + ("\n\n" if prefixes else "")
    lines = triples.select("doc", "subject", "ord", format_pair().alias("pair"))
    groups = lines.groupBy("doc", "subject").agg(F.min("ord").alias("ord"), F.array_sort(F.collect_list(F.struct("ord", "pair"))).alias("pairs"))
    block = F.concat(format_term("subject"), F.lit(" "), F.array_join(F.transform("pairs", lambda x: x["pair"]), " ;\n    "), F.lit(" ."))
    docs = groups.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("ord", block.alias("block")))).alias("blocks"))
    return docs.select("doc", F.concat(F.lit(head), F.array_join(F.transform("blocks", lambda x: x["block"]), "\n\n")).alias("turtle"))


def commit_triples(commits: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """Triples (doc, ord, ...) of commits, doc being the commit's hash: the commit, its added links, its tombstones."""
    root = F.lit("")
    h = lambda x: H.link_hash(x["source"], x["predicate"], x["target"], x["author"], x["timestamp"], hash)
    own = F.array(_triple(root, C.RDF_TYPE, F.lit(C.COMMIT)), _triple(root, C.AUTHOR, F.col("author"), True), _triple(root, C.TIMESTAMP, F.col("timestamp"), True, C.XSD_DATETIME))
    parents = F.transform(F.array_sort("previous"), lambda p: _triple(root, C.PREVIOUS, p, True))
    add_node, gone_node = (lambda x: F.concat(F.lit("#add-"), h(x))), (lambda t: F.concat(F.lit("#rm-"), t["link_hash"]))
    adds = F.transform("additions", lambda x: _triple(root, C.ADDITION, add_node(x)))
    gone = F.transform("removals", lambda t: _triple(root, C.REMOVAL, gone_node(t)))
    add_links = F.flatten(F.transform("additions", lambda x: link_triples(add_node(x), x, C.LINK, [_triple(add_node(x), C.LINK_HASH, h(x), True)])))
    gone_links = F.flatten(F.transform("removals", lambda t: link_triples(gone_node(t), t["link"], C.TOMBSTONE, [_triple(gone_node(t), C.REMOVES_HASH, t["link_hash"], True)])))
    return commits.select(F.col("commit_hash").alias("doc"), F.posexplode(F.concat(own, parents, adds, gone, add_links, gone_links)).alias("ord", "t")).select("doc", "ord", "t.*")


#: Characters of the texts, or of those whose commits, a task gives on together.
TEXT = 1 << 22


def commit_turtle(commits: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """(doc, turtle): to_turtle(commit_triples(commits)), each text made of its commit's row alone, without an exchange."""
    h = lambda x: H.link_hash(x["source"], x["predicate"], x["target"], x["author"], x["timestamp"], hash)
    whole = commits.filter("previous is not null and additions is not null and removals is not null")
    rows = whole.select("commit_hash", "author", "timestamp", F.array_sort("previous").alias("previous"), F.transform("additions", h).alias("hashes"), "additions", "removals")

    def run(batches):
        for batch in batches:
            for part in _parts(batch):
                odd = _odd(part)
                plain = part.filter(pa.compute.invert(odd))
                for names, texts in [(plain.column("commit_hash").cast(pa.string()), _plain_texts(plain).cast(pa.string())), *_texts(part.filter(odd))]:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(texts, pa.string())], names=["doc", "turtle"])

    return rows.mapInArrow(trimmed(run), "doc string, turtle string")


#: Links of the commits whose texts are made together.
TOGETHER = 1 << 13


def _parts(batch: pa.RecordBatch):
    """The batch in slices of TOGETHER links at most, or of one row."""
    n = [sum(x) for x in zip(*(pa.compute.list_value_length(batch.column(c)).to_pylist() for c in ("previous", "hashes", "removals")), strict=True)]
    start = size = 0
    for i, more in enumerate(n):
        if size and size + more > TOGETHER:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += more
    if n:
        yield batch.slice(start)


def _texts(batch: pa.RecordBatch):
    """Names and texts of commits, row by row."""
    texts, size, names = [], 0, batch.column("commit_hash").to_pylist()
    lists = [_lists(batch.column(c)) for c in ("previous", "hashes", "additions")]
    gone = batch.column("removals")
    lists += [_cut_up(gone, gone.flatten().flatten()[0].to_pylist()), _cut_up(gone, _links(gone.flatten().flatten()[1]))]
    start = 0
    for i, row in enumerate(zip(batch.column("author").to_pylist(), batch.column("timestamp").to_pylist(), *lists, strict=True)):
        texts.append(_commit_text(*row))
        size += len(texts[-1])
        if size > TEXT or i == len(names) - 1:
            yield names[start : i + 1], texts
            texts, size, start = [], 0, i + 1


def _odd(batch: pa.RecordBatch) -> pa.Array:
    """Whether a commit has a node without a name, or one that stands twice."""
    odd = set()
    for lists, names in ((batch.column("hashes"), batch.column("hashes").flatten()), (batch.column("removals"), batch.column("removals").flatten().flatten()[0])):
        nodes = pa.table({"row": pa.compute.list_parent_indices(lists), "name": names}).group_by(["row", "name"]).aggregate([([], "count_all")])
        strange = pa.compute.or_(pa.compute.greater(nodes["count_all"], 1), pa.compute.is_null(nodes["name"]))
        odd.update(nodes["row"].filter(strange).to_pylist())
    return pa.array([i in odd for i in range(len(batch))], pa.bool_())


def _plain_texts(batch: pa.RecordBatch) -> pa.Array:
    """_commit_text() of all rows at once, by columns; none of them may be odd."""
    pc, w = pa.compute, _WRITTEN
    join = lambda *x: pc.binary_join_element_wise(*x, "")

    def literal(x, datatype=""):
        x = pc.replace_substring(pc.replace_substring(x, "\\", "\\\\"), '"', '\\"')
        return pc.fill_null(join(' "', x, '"' + datatype), "")

    def term(x):
        x = pc.fill_null(x, "")
        out = join("<", x, ">")
        if pc.any(pc.starts_with(x, _COMMON)).as_py():
            for prefix, ns in reversed(C.PREFIXES.items()):
                out = pc.if_else(pc.starts_with(x, ns), join(prefix + ":", pc.utf8_slice_codeunits(x, len(ns))), out)
        return out

    def own(x, predicate):
        return pc.if_else(pc.equal(pc.fill_null(x, ""), ""), "", join(f" ;\n    {w[predicate]}", literal(x)))

    def listed(lists, values):
        """The values of each row behind one another."""
        ends = pc.list_value_length(lists).to_numpy(zero_copy_only=False).cumsum()
        return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, *ends.tolist()], pa.int32()), values), "")

    removals = batch.column("removals").flatten().flatten()
    sides = ((C.LINK, C.ADDITION, C.LINK_HASH, "#add-", batch.column("hashes"), batch.column("hashes").flatten(), batch.column("additions").flatten()), (C.TOMBSTONE, C.REMOVAL, C.REMOVES_HASH, "#rm-", batch.column("removals"), *removals))
    text = [_HEAD, f"<> a {w[C.COMMIT]} ;\n    {w[C.AUTHOR]}", literal(batch.column("author")), f" ;\n    {w[C.TIMESTAMP]}", literal(batch.column("timestamp"), _DATETIME)]
    text.append(listed(batch.column("previous"), join(f" ;\n    {w[C.PREVIOUS]}", literal(batch.column("previous").flatten()))))
    blocks = []
    for kind, named, by, prefix, lists, names, links in sides:
        source, predicate, target, author, timestamp, proof, _ = links.flatten()
        signature, key = proof.flatten()
        text.append(listed(lists, join(f" ;\n    {w[named]} <{prefix}", names, ">")))
        start = (f"\n\n<{prefix}", names, f"> a {w[kind]} ;\n    {w[by]}", literal(names))
        parts = [x for p, c in ((C.RDF_SUBJECT, source), (C.RDF_PREDICATE, predicate), (C.RDF_OBJECT, target)) for x in (f" ;\n    {w[p]} ", term(c))]
        parts += [f" ;\n    {w[C.AUTHOR]}", literal(author), f" ;\n    {w[C.TIMESTAMP]}", literal(timestamp, _DATETIME), own(signature, C.SIGNATURE), own(key, C.KEY), " ."]
        blocks.append(listed(lists, join(*start, *parts)))
    return join(*text, " .", *blocks)


def _links(found: pa.StructArray) -> list[tuple]:
    """(source, predicate, target, author, timestamp, signature, key) of each link."""
    *parts, proof, _ = found.flatten()
    return list(zip(*(x.to_pylist() for x in (*parts, *proof.flatten())), strict=True))


def _cut_up(lists: pa.ListArray, values: list):
    """The values, flat so far, list by list."""
    at = 0
    for n in pa.compute.list_value_length(lists).to_pylist():
        yield values[at : at + n]
        at += n


def _lists(lists: pa.ListArray):
    flat = lists.flatten()
    return _cut_up(lists, _links(flat) if pa.types.is_struct(flat.type) else flat.to_pylist())


def _term_text(uri: str) -> str:
    """format_term()"""
    if uri.startswith(_NAMESPACES):
        for prefix, ns in C.PREFIXES.items():
            if uri.startswith(ns):
                return f"{prefix}:{uri[len(ns):]}"
    return f"<{uri}>"


def _literal_text(value: str | None, datatype: str = "") -> str:
    """format_literal() behind a space; a null adds nothing to its predicate."""
    return "" if value is None else ' "' + value.replace("\\", "\\\\").replace('"', '\\"') + '"' + datatype


_HEAD = prefix_block() + "\n\n"
_NAMESPACES = tuple(C.PREFIXES.values())
_COMMON = os.path.commonprefix(_NAMESPACES)
_WRITTEN = {p: _term_text(p) for p in (C.AUTHOR, C.TIMESTAMP, C.PREVIOUS, C.ADDITION, C.REMOVAL, C.LINK_HASH, C.REMOVES_HASH, C.RDF_SUBJECT, C.RDF_PREDICATE, C.RDF_OBJECT, C.SIGNATURE, C.KEY, C.LINK, C.TOMBSTONE, C.COMMIT)}
_DATETIME = "^^" + _term_text(C.XSD_DATETIME)


def _commit_text(author, timestamp, previous, hashes, additions, removes, removals) -> str:
    """The text of one commit, with the links as _links() gives them: what commit_triples() and to_turtle() say."""
    w, blocks = _WRITTEN, {}
    root = [f"a {w[C.COMMIT]}", w[C.AUTHOR] + _literal_text(author), w[C.TIMESTAMP] + _literal_text(timestamp, _DATETIME)]
    root += [w[C.PREVIOUS] + _literal_text(p) for p in previous]
    for kind, named, by, prefix, names, links in ((C.LINK, C.ADDITION, C.LINK_HASH, "#add-", hashes, additions), (C.TOMBSTONE, C.REMOVAL, C.REMOVES_HASH, "#rm-", removes, removals)):
        for name, (source, predicate, target, by_whom, at, signature, key) in zip(names, links, strict=True):
            if name is None:  # a node without a name is none
                root.append(w[named])
                continue
            node = prefix + name
            root.append(f"{w[named]} <{node}>")
            pairs = blocks.setdefault(node, [])  # a node that stands twice has one block
            pairs += [f"a {w[kind]}", w[by] + _literal_text(name), f"{w[C.RDF_SUBJECT]} {_term_text(source or '')}", f"{w[C.RDF_PREDICATE]} {_term_text(predicate or '')}", f"{w[C.RDF_OBJECT]} {_term_text(target or '')}", w[C.AUTHOR] + _literal_text(by_whom), w[C.TIMESTAMP] + _literal_text(at, _DATETIME)]
            if signature:
                pairs.append(w[C.SIGNATURE] + _literal_text(signature))
            if key:
                pairs.append(w[C.KEY] + _literal_text(key))
    return _HEAD + "\n\n".join([f"{s} " + " ;\n    ".join(p) + " ." for s, p in [("<>", root), *((f"<{n}>", p) for n, p in blocks.items())]])


def commits_from_triples(triples: DataFrame) -> DataFrame:
    """(doc, author, timestamp, previous, additions, removals) of the documents that hold a commit.

    The commit is the document itself if it is typed so (its subject is doc or empty), else the first subject that is.
    Nodes without all three parts are left out, as are tombstones without a hash.
    """
    typed = triples.filter((F.col("predicate") == C.RDF_TYPE) & (F.col("object") == C.COMMIT))
    near = F.when(F.col("subject").isin("") | (F.col("subject") == F.col("doc")), 0).otherwise(1)
    roots = typed.groupBy("doc").agg(F.min(F.struct(near.alias("far"), "ord", "subject"))["subject"].alias("subject"))
    own = triples.join(roots, ["doc", "subject"]).select("doc", "ord", "predicate", "object")
    ordered = lambda p: F.transform(F.array_sort(F.collect_list(F.when(F.col("predicate") == p, F.struct("ord", "object")))), lambda x: x["object"])
    first = lambda p: F.coalesce(F.min(F.when(F.col("predicate") == p, F.struct("ord", "object")))["object"], F.lit(""))
    commit = own.groupBy("doc").agg(first(C.AUTHOR).alias("author"), first(C.TIMESTAMP).alias("timestamp"), ordered(C.PREVIOUS).alias("previous"))
    nodes = first_objects(triples, ["doc", "subject"], PARTS | {"removes": C.REMOVES_HASH}).filter("source is not null and predicate is not null and target is not null")
    empty = lambda c: F.coalesce(c, F.lit(""))
    link = F.struct("source", "predicate", "target", empty("author").alias("author"), empty("timestamp").alias("timestamp"), F.struct(empty("signature").alias("signature"), empty("key").alias("key")).alias("proof"), F.lit(None).cast("string").alias("status"))
    nodes = nodes.select("doc", F.col("subject").alias("object"), "removes", link.alias("link"))
    named = own.filter(F.col("predicate").isin(C.ADDITION, C.REMOVAL)).join(nodes, ["doc", "object"])
    named = named.groupBy("doc").agg(
        F.array_sort(F.collect_list(F.when(F.col("predicate") == C.ADDITION, F.struct("ord", "link")))).alias("adds"),
        F.array_sort(F.collect_list(F.when((F.col("predicate") == C.REMOVAL) & (F.coalesce("removes", F.lit("")) != ""), F.struct("ord", F.struct(F.col("removes").alias("link_hash"), "link").alias("t"))))).alias("gone"),
    )
    out = commit.join(named, "doc", "left")
    from ..schema import COMMITS

    lists = {c: COMMITS[c].dataType for c in ("additions", "removals")}
    return out.select(
        "doc",
        "author",
        "timestamp",
        "previous",
        F.coalesce(F.transform("adds", lambda x: x["link"]), F.array().cast(lists["additions"])).cast(lists["additions"]).alias("additions"),
        F.coalesce(F.transform("gone", lambda x: x["t"]), F.array().cast(lists["removals"])).cast(lists["removals"]).alias("removals"),
    )


def commits_from_turtle(found: DataFrame) -> DataFrame:
    """commits_from_triples() of the texts of found(name, doc, turtle), with commit_hash (the name) instead of doc.

    A commit is one text: each is read once, and its commit made where it is read, so no triple leaves the reader.
    """
    from ..schema import COMMITS

    fields = [f for f in COMMITS.fields if f.name != "ord"]

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for name, doc, text in zip(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("name", "doc", "turtle")), strict=True):
                row = None if doc is None or not text else _plain_commit(text) or _commit(read_written(text, doc) or [t[:3] for t in parse(text, doc)], doc)
                if row:
                    rows.append((name, *row))
                    size += len(text)
                if size > TEXT:
                    yield _commit_batch(rows)
                    rows, size = [], 0
            if rows:
                yield _commit_batch(rows)

    return found.select("name", "doc", "turtle").mapInArrow(trimmed(run), T.StructType(fields))


def _plain(kind: str, by: str, prefix: str) -> re.Pattern:
    """A node as _commit_text() writes it: its name, its hash, and the parts of its link."""
    iri, text = r"<((?!#|\./|\.\./)[^>]+)>", r'"([^"\\]*)"'
    pairs = [f"a {_WRITTEN[kind]}", f"{_WRITTEN[by]} {text}", *(f"{_WRITTEN[p]} {iri}" for p in (C.RDF_SUBJECT, C.RDF_PREDICATE, C.RDF_OBJECT)), f"{_WRITTEN[C.AUTHOR]} {text}", f"{_WRITTEN[C.TIMESTAMP]} {text}{re.escape(_DATETIME)}"]
    own = "".join(rf"(?: ;\n    {_WRITTEN[p]} {text})?" for p in (C.SIGNATURE, C.KEY))
    return re.compile(rf"\n\n<{prefix}([^<>]+)> " + r" ;\n    ".join(pairs) + own + r" \.")


_PLAIN_ADDED, _PLAIN_GONE = _plain(C.LINK, C.LINK_HASH, "#add-"), _plain(C.TOMBSTONE, C.REMOVES_HASH, "#rm-")
_ADDITION, _REMOVAL = f" ;\n    {_WRITTEN[C.ADDITION]} <#add-", f" ;\n    {_WRITTEN[C.REMOVAL]} <#rm-"
_PLAIN_ROOT = re.compile(
    rf"<> a {_WRITTEN[C.COMMIT]} ;\n    {_WRITTEN[C.AUTHOR]} " + r'"([^"\\]*)"' + rf" ;\n    {_WRITTEN[C.TIMESTAMP]} " + r'"([^"\\]*)"' + re.escape(_DATETIME)
    + rf"((?: ;\n    {_WRITTEN[C.PREVIOUS]} " + r'"[^"\\]*")*)' + rf"((?:{_ADDITION}[^<>]+>)*)((?:{_REMOVAL}[^<>]+>)*) \."
)


def _plain_commit(text: str) -> tuple | None:
    """What _commit() finds in a text in the very form that _commit_text() gives to commits without odd characters or
    repeated nodes, one match for each link; None for any other text."""
    if not text.startswith(_HEAD) or not (root := _PLAIN_ROOT.match(text, len(_HEAD))):
        return None
    author, timestamp, previous, *named = root.groups()
    at, found = root.end(), []
    for nodes, mark, pattern in ((named[0], _ADDITION, _PLAIN_ADDED), (named[1], _REMOVAL, _PLAIN_GONE)):
        names = [x[:-1] for x in nodes.split(mark)[1:]]
        if len(set(names)) < len(names):
            return None
        links = []
        for name in names:
            if not (node := pattern.match(text, at)):
                return None
            its, by, *link, signature, key = node.groups()
            if its != name or not by:
                return None
            links.append((*link, signature or "", key or "") if pattern is _PLAIN_ADDED else (by, *link, signature or "", key or ""))
            at = node.end()
        found.append(links)
    return (author, timestamp, previous.split('"')[1::2], *found) if at == len(text) else None


def _commit(triples: list[tuple[str, str, str]], doc: str) -> tuple | None:
    """Author, timestamp, parents, added links and tombstones of the commit that triples hold, by the rules of
    commits_from_triples()."""
    nodes: dict[str, list] = {}
    roots = [None, None]
    for s, p, o in triples:
        nodes.setdefault(s, []).append((p, o))
        if p == C.RDF_TYPE and o == C.COMMIT:
            far = s != "" and s != doc
            if roots[far] is None:
                roots[far] = s
    root = roots[0] if roots[0] is not None else roots[1]
    if root is None:
        return None
    author = timestamp = None
    previous, adds, gone = [], [], []
    for p, o in nodes[root]:
        if p == C.AUTHOR:
            author = o if author is None else author
        elif p == C.TIMESTAMP:
            timestamp = o if timestamp is None else timestamp
        elif p == C.PREVIOUS:
            previous.append(o)
        elif p in (C.ADDITION, C.REMOVAL) and o in nodes:
            first = dict(reversed(nodes[o]))  # of several objects the first one stays
            if C.RDF_SUBJECT in first and C.RDF_PREDICATE in first and C.RDF_OBJECT in first:
                link = tuple(first.get(x, "") for x in PARTS.values())
                if p == C.ADDITION:
                    adds.append(link)
                elif first.get(C.REMOVES_HASH):
                    gone.append((first[C.REMOVES_HASH], *link))
    return author or "", timestamp or "", previous, adds, gone


def _commit_batch(rows: list[tuple]) -> pa.RecordBatch:
    """Commits (name, author, timestamp, parents, added links, tombstones) as columns."""
    text = lambda values: pa.array(values, pa.string())

    def listed(at: int, build) -> pa.Array:
        offsets = pa.array([0, *itertools.accumulate(len(r[at]) for r in rows)], pa.int32())
        return pa.ListArray.from_arrays(offsets, build([x for r in rows for x in r[at]]))

    def links(found: list[tuple]) -> pa.Array:
        source, predicate, target, author, timestamp, signature, key = map(text, zip(*found, strict=True) if found else [[]] * 7)
        proof = pa.StructArray.from_arrays([signature, key], ["signature", "key"])
        return pa.StructArray.from_arrays([source, predicate, target, author, timestamp, proof, pa.nulls(len(found), pa.string())], ["source", "predicate", "target", "author", "timestamp", "proof", "status"])

    def tombstones(found: list[tuple]) -> pa.Array:
        return pa.StructArray.from_arrays([text([x[0] for x in found]), links([x[1:] for x in found])], ["link_hash", "link"])

    columns = [*(text([r[i] for r in rows]) for i in range(3)), listed(3, text), listed(4, links), listed(5, tombstones)]
    return pa.RecordBatch.from_arrays(columns, names=["commit_hash", "author", "timestamp", "previous", "additions", "removals"])


def document_triples(links: DataFrame, strategy: str = "reified", hash: H.Hash = H.sha256) -> DataFrame:
    """Triples of links(doc, ord, link columns): what each document that holds them says, in their order.

    strategy is a rendering strategy of the settings: raw triples, or (any other) a node for each link, named by the hash of
    its content key.
    """
    if strategy == "raw-triples":
        return raw_triples(links, "doc", "ord")
    node = F.concat(F.lit("#link-"), hash(H.content_key()))
    link = F.struct("source", "predicate", "target", "author", "timestamp", "proof")
    out = links.select("doc", F.col("ord").alias("_at"), F.posexplode(link_triples(node, link)).alias("_k", "t"))
    return out.select("doc", (F.col("_at") * 16 + F.col("_k")).alias("ord"), "t.*")


def links_to_turtle(links: DataFrame, strategy: str = "reified", hash: H.Hash = H.sha256) -> DataFrame:
    """(doc, turtle) of links(doc, ord, ...): a document for each doc, be it of one link, a batch, or a diff's additions."""
    return to_turtle(document_triples(links, strategy, hash))


def turtle_to_links(documents: DataFrame, now: str, base: str = "") -> DataFrame:
    """The links of documents(doc, turtle)."""
    return dereify(parse_turtle(documents), now, base)


def hash_turtle(turtle="turtle", hash: H.Hash = H.sha256) -> Column:
    """The content address of a Turtle text."""
    return hash(_col(turtle))


def parse_with_hash(documents: DataFrame, hash: H.Hash = H.sha256) -> DataFrame:
    """The triples of documents(doc, turtle), each with the content address of its document as turtle_hash."""
    return parse_turtle(documents).join(documents.select("doc", hash_turtle(hash=hash).alias("turtle_hash")), "doc")


def find_subjects(triples: DataFrame, predicate: str, object: str) -> DataFrame:
    return triples.filter((F.col("predicate") == predicate) & (F.col("object") == object)).select("doc", "ord", "subject")


def get_objects(triples: DataFrame, subject: str, predicate: str) -> DataFrame:
    return triples.filter((F.col("subject") == subject) & (F.col("predicate") == predicate)).select("doc", "ord", "object")


def get_object(triples: DataFrame, subject: str, predicate: str) -> DataFrame:
    """The first one of each document."""
    return get_objects(triples, subject, predicate).groupBy("doc").agg(F.min_by("object", "ord").alias("object"))


def by_subject(triples: DataFrame, subject: str) -> DataFrame:
    return triples.filter(F.col("subject") == subject)


def resource_subject(triples: DataFrame) -> DataFrame:
    """(doc, subject): the document itself if it is a subject, else its first subject with a type, else null."""
    typed = F.min_by(F.when(F.col("predicate") == C.RDF_TYPE, F.col("subject")), F.when(F.col("predicate") == C.RDF_TYPE, F.col("ord")))
    return triples.groupBy("doc").agg(F.coalesce(F.max(F.when(F.col("subject") == F.col("doc"), F.col("doc"))), typed).alias("subject"))


def patch(turtle: Column, kind: str) -> Column:
    """The body of a patch that inserts or deletes the statements of a Turtle text (kind: inserts or deletes)."""
    indented = F.array_join(F.transform(F.split(turtle, "\n"), lambda x: F.concat(F.lit("    "), x)), "\n")
    return F.concat(F.lit(f"@prefix solid: <{C.PREFIXES['solid']}> .\n\n_:patch solid:{kind} {{\n"), indented, F.lit("\n} ."))
