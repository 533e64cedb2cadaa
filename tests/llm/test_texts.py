import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import SCHEMA, documents, texts
from linkfold.llm import bpe, line_dedup, minhash_dedup, mixing, substring_dedup, suffix_dedup, token_counts, toxicity, windows
from linkfold.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")


def rows(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


# op7


def test_bpe_equals_plain_encoding(spark):
    c = bpe.codec(None, None, 1, 3)
    r = random.Random(3)
    cases = [t or "" for t in texts()] + ["".join(r.choice(" ab'st\n\té1!日  🙂") for _ in range(r.randint(0, 90))) for _ in range(800)]
    for text in cases:
        want = c.encoding.encode_ordinary(text)
        assert c.encode(text) == want
        assert c.decode(want) == text.encode()
    out = rows(bpe.bpe(documents(spark)))
    for i, text in enumerate(texts()):
        ids = c.encoding.encode_ordinary(text or "")
        assert out[i].ids == ids and out[i].n_tokens == len(ids) and out[i].decoded == (text or "").encode()
        assert out[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_combine_is_associative():
    c = bpe.codec(None, None, 5, 2)
    leaf = lambda t: (t, c.encoding.encode_ordinary(t))
    a, b, d = leaf("aaa b's  "), leaf("\n\n x"), leaf("yz  9 1")
    assert c.combine(c.combine(a, b), d) == c.combine(a, c.combine(b, d))


# op5


def test_token_counts_equal_plain_longest_match(spark):
    vocabulary = [b"ab", b"abcd", b"bc", b"cde", b"aaa", b"dd"]
    automaton = token_counts.Automaton(vocabulary)
    known = set(vocabulary) | {bytes([i]) for i in range(256)}
    r = random.Random(5)

    def plain(word, pieces):
        n = at = 0
        while at < len(word):
            at += max(k for k in range(1, 130) if at + k <= len(word) and word[at : at + k] in pieces)
            n += 1
        return n

    for _ in range(3000):
        word = bytes(r.choice(b"abcde") for _ in range(r.randint(0, 15)))
        assert automaton.count(word) == plain(word, known)
    pieces = set(token_counts._pieces(None)) | {bytes([i]) for i in range(256)}
    out = rows(token_counts.token_counts(documents(spark)))
    for i, text in enumerate(texts()):
        found = (text or "").encode().split()
        assert out[i].n_words == len(found)
        assert out[i].n_tokens == sum(plain(w, pieces) for w in found)


# op8


def check_mix(spark, rows_, **options):
    out = mixing.mixed(spark.createDataFrame(rows_, SCHEMA), **options).collect()
    assert len(out) == len(rows_)
    for r in out:
        assert r.size == len(WORD.findall(r.text or "")) and r.taken in (0, r.size, 2 * r.size) and r.target <= 2 * r.source_size + 1e-6
    by = {}
    for r in out:
        by.setdefault(r.source, []).append(r)
    for group in by.values():
        assert sum(r.size for r in group) == group[0].source_size
    return out, by


def test_mixing_targets_and_sampling(spark):
    r = random.Random(7)
    data = [(i, " ".join(["w"] * r.randint(0, 30)), "en", r.choice(["a", "a", "a", "b", "é", None]), 0) for i in range(3000)]
    out, by = check_mix(spark, data)
    everything = sum(x.size for x in out)
    assert sum(g[0].target for g in by.values()) == pytest.approx(1.5 * everything)
    for g in by.values():
        assert abs(sum(x.taken for x in g) - g[0].target) < 0.05 * g[0].target + 60
    # shares by weight 5, 2, 1 where no cap holds
    plain = {}
    left, goal, open_ = 1.5 * everything, {}, dict(zip(sorted(by, key=lambda s: (s is None, s)), [5, 2, 1, 5], strict=True))
    while open_:
        goal = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if goal[s] > 2 * by[s][0].source_size]
        if not over:
            plain |= goal
            break
        for s in over:
            plain[s] = 2 * by[s][0].source_size
            left -= plain[s]
            del open_[s]
    for s, g in by.items():
        assert g[0].target == pytest.approx(plain[s])
    again = {(x.doc_id, x.taken) for x in mixing.mixed(spark.createDataFrame(list(reversed(data)), SCHEMA)).collect()}
    assert again == {(x.doc_id, x.taken) for x in out}
    copies = Counter(x.doc_id for x in mixing.mix(spark.createDataFrame(data, SCHEMA)).collect())
    assert all(copies[x.doc_id] == x.copies for x in out)


def test_mixing_edges(spark):
    check_mix(spark, [(1, None, "en", None, 0), (1, None, "en", None, 0), (None, "a b\x0bc", "en", "x", 0), (2, "", "en", "x", 0)])
    assert mixing.mixed(documents(spark, [])).count() == 0
    clash = documents(spark).withColumn("size", F.lit("?")).withColumn("target", F.lit("?"))
    assert mixing.mixed(clash).columns.count("size") == 1
    # names that the operators use inside stay the caller's
    own = documents(spark, [(1, "a b\nc", "en", "s", 0)])
    for c in ("_row", "_lines", "_doc", "_text", "_gone", "_salt", "_at", "_source", "_copy", "_docs_row", "Size", "N_Lines"):
        own = own.withColumn(c, F.lit("mine"))
    (r,) = line_dedup.deduplicated(own).collect()
    assert (r._lines, r._doc, r._text, r._gone, r._row, r.n_lines, r.text) == ("mine",) * 5 + (2, "a b\nc") and "N_Lines" not in r.asDict()
    (r,) = mixing.mixed(own).collect()
    assert (r._salt, r._at, r._source, r._row, r.size) == ("mine",) * 4 + (3,) and "Size" not in r.asDict()
    assert mixing.mix(own, most=1.0, share=1.0).columns == own.columns


# op2

#: Two lines of one xxhash64.
COLLIDING = "eszycidpyopumzgdpamntyyawoixzhsdkaaauramvgnxaqhyoprhlhvhyojanrud", "zlppedqyyopumzgdpamntyyawoixzhsd!mbR'89<vgnxaqhyoprhlhvhyojanrud"


def plain_lines(data, lines=3, long=60):
    runs = []
    for i, text in sorted(data, key=lambda x: (x[0] is None, x[0] or 0)):
        parts = text.split("\n") if text is not None else []
        runs += [(i, k, lines, tuple(parts[k : k + lines])) for k in range(len(parts) - lines + 1)]
        runs += [(i, k, 1, (x,)) for k, x in enumerate(parts) if len(x) >= long]
    first, gone = {}, set()
    for i, k, n, run in sorted(runs, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        if first.setdefault((n, run), (i, k)) != (i, k):
            gone |= {(i, j) for j in range(k, k + n)}
    return {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in data}


def test_line_dedup_equals_plain(spark):
    r = random.Random(9)
    pool = [f"line {i}" for i in range(6)] + ["L" * 60, "M" * 70, ""]
    data = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 12)))) for i in range(80)] + [(100, None), (101, ""), (None, "line 1\nline 2\nline 3")]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("n_lines", F.lit("clash"))
    out = rows(line_dedup.deduplicated(df))
    want = plain_lines(data)
    for i, text in data:
        assert out[i].text == want[i]
        assert out[i].n_lines == (0 if text is None else len(text.split("\n")))
    assert line_dedup.deduplicated(documents(spark, [])).count() == 0


def test_line_dedup_of_rows_of_one_id(spark):
    same = "\n".join(f"l{i}" for i in range(5))
    out = line_dedup.deduplicated(spark.createDataFrame([(1, same), (1, same), (2, same)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.n_removed) for r in sorted(out)] == [(1, 0), (1, 0), (2, 5)]


def test_line_dedup_of_runs_of_some_words(spark):
    def plain(data, words):
        first, gone = {}, set()
        for i, t in data:
            parts = t.split("\n")
            for k in range(len(parts)):
                for n in (1, 2, 3):
                    run = tuple(parts[k : k + n])
                    if len(run) == n and (n == 3 or (n == 1 and len(run[0]) >= 60) or sum(len(WORD.findall(x)) for x in run) >= words):
                        if first.setdefault(run, (i, k)) != (i, k):
                            gone |= {(i, j) for j in range(k, k + n)}
        return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in data}

    notice, footer = "All rights of this text are reserved here.", "Read more of it on our pages\nHome"
    data = [(1, f"{notice}\none\n{footer}"), (2, f"two\n{footer}\nlast"), (3, f"x\n{notice}\ny\nHome"), (4, "Home\nx\n\n")]
    out = rows(line_dedup.deduplicated(spark.createDataFrame(data, "doc_id long, text string"), words=4))
    assert [out[i].text for i in (2, 3, 4)] == ["two\nlast", "x\ny\nHome", "Home\nx\n\n"]
    r = random.Random(10)
    pool = ["", " ", "a", "b c", "d\te  f", " g h i j ", "k\x0bl m\rn o", "L" * 60, *(f"only {i}" for i in range(40))]
    data += [(i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 9)))) for i in range(5, 90)]
    out = rows(line_dedup.deduplicated(spark.createDataFrame(data, "doc_id long, text string"), words=4))
    assert {i: out[i].text for i, _ in data} == plain(data, 4)


def test_line_dedup_of_frequent_keys(spark):
    r = random.Random(11)
    pool = [*(f"line {i}" for i in range(4)), "L" * 60, "", *(f"only {i}" for i in range(40))]
    data = [(i, "\n".join(r.choice(pool) for _ in range(r.randint(0, 12)))) for i in range(80)]
    out = rows(line_dedup.deduplicated(spark.createDataFrame(data, "doc_id long, text string")))
    assert {i: out[i].text for i, _ in data} == plain_lines(data)


def test_line_dedup_tells_lines_of_one_hash_apart(spark):
    a, b = COLLIDING
    one = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert one.select(F.xxhash64("text")).distinct().count() == 1
    assert {i: r.n_removed for i, r in rows(line_dedup.deduplicated(one)).items()} == {1: 0, 2: 0, 3: 1}


# op4 and op10


def plain_windows(items, width):
    count = Counter(tuple(x[i : i + width]) for x in items for i in range(len(x) - width + 1))
    out = []
    for x in items:
        gone = [False] * len(x)
        for i in range(len(x) - width + 1):
            if count[tuple(x[i : i + width])] > 1:
                gone[i : i + width] = [True] * width
        out.append(gone)
    return out


@pytest.mark.parametrize(("width", "gram", "batches"), [(35, 16, 4), (6, 3, 2), (5, 5, 1)])
def test_substring_dedup_equals_plain(spark, width, gram, batches):
    data = texts(11)
    out = rows(substring_dedup.deduplicated(documents(spark, [(i, t, None, None, None) for i, t in enumerate(data)]), width, gram, batches))
    items = [(t or "").encode().split() for t in data]
    for i, (x, gone) in enumerate(zip(items, plain_windows(items, width), strict=True)):
        kept = b" ".join(w for w, g in zip(x, gone, strict=True) if not g)
        assert (out[i].n_words, out[i].n_removed, out[i].kept) == (len(x), sum(gone), kept)
        assert out[i].kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("width", "gram", "pairs", "kinds"), [(200, 48, 64, 64), (20, 6, 64, 64), (20, 6, 2, 64), (20, 6, 2, 3), (8, 8, 64, 64)])
def test_suffix_dedup_equals_plain(spark, monkeypatch, width, gram, pairs, kinds):
    monkeypatch.setattr(suffix_dedup, "PAIRS", pairs)
    monkeypatch.setattr(suffix_dedup, "KINDS", kinds)
    monkeypatch.setattr(suffix_dedup, "RUN", 50)
    data = texts(12)
    out = rows(suffix_dedup.deduplicated(documents(spark, [(i, t, None, None, None) for i, t in enumerate(data)]), width, gram))
    items = [(t or "").encode() for t in data]
    for i, (x, gone) in enumerate(zip(items, plain_windows(items, width), strict=True)):
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        assert (out[i].n_bytes, out[i].n_removed, out[i].n_spans, out[i].kept) == (len(x), sum(gone), spans, kept)


def test_index_goes_on_in_batches(spark):
    data = [(i, t, None, None, None) for i, t in enumerate(texts(14, 40))]
    docs = windows.keyed(documents(spark, data))
    index = substring_dedup.FingerprintIndex(spark, width=6, gram=3, buckets=4)
    try:
        for k in range(4):
            index.add(docs.filter(F.col("doc_id") % 4 == k))
            index = substring_dedup.FingerprintIndex.open(spark, index.state())
            if k == 1:
                with substring_dedup._sorted_buckets(spark):
                    plan = index.meeting(index.runs[1][1], index.runs[0][1])._jdf.queryExecution().executedPlan().toString()
                assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan, plan
            if k == 2:
                assert [level for level, _ in index.runs] == [1]
        out = rows(substring_dedup.without_repeated(docs, index.repeated(), 6, 3))
    finally:
        index.drop()
    items = [(t or "").encode().split() for _, t, *_ in data]
    assert [out[i].n_removed for i in range(len(items))] == [sum(g) for g in plain_windows(items, 6)]


#: Thue-Morse sequences, which are what sums of powers cannot tell apart.
def morse(n, a, b):
    return [(a, b)[bin(i).count("1") % 2] for i in range(n)]


def test_texts_that_defeat_polynomial_hashes(spark):
    one, two = "".join(morse(1024, "a", "b")), "".join(morse(1024, "b", "a"))
    pair_ = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert all(r.kept for r in minhash_dedup.near_duplicates(pair_, 2).collect())
    same = " ".join(f"w{i}" for i in range(34))
    assert [r.n_removed for r in substring_dedup.deduplicated(spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {two}")], "doc_id long, text string")).collect()] == [0, 0]
    lines_ = spark.createDataFrame([(1, "\n".join(morse(64, "p" * 70, "q" * 70))), (2, "x\ny")], "doc_id long, text string")
    assert rows(line_dedup.deduplicated(lines_))[1].n_removed == 62
    width = 128
    apart = spark.createDataFrame([(1, one[:width] + "#" + "c" * 99), (2, two[:width] + "%" + "d" * 99)], "doc_id long, text string")
    got = rows(suffix_dedup.deduplicated(apart, width, 16))
    want = [sum(g) for g in plain_windows([r.text.encode() for r in apart.orderBy("doc_id").collect()], width)]
    assert [got[1].n_removed, got[2].n_removed] == want


def test_very_long_texts():
    """One text of some megabytes, longer than any slice."""
    r = random.Random(17)
    pool = ["".join(r.choice("abcdefé日") for _ in range(r.randint(1, 9))) for _ in range(3000)]
    text = " ".join(r.choice(pool) for _ in range(250_000)) + " " + "x" * 100_000
    data = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(data)])
    ((lo, hi, row, h),) = minhash_dedup.shingles(data, offsets, 2)
    w = text.split(" ")
    assert (lo, hi) == (0, 1) and len(h) == len(set(zip(w, w[1:], strict=False))) and not row.any()
    seen, tokens = set(), np.frombuffer(bytes(r.randrange(97, 100) for _ in range(600_000)), np.uint8)
    for _, first, last, *_ in windows.stretches(tokens, np.array([0, len(tokens)]), 200, 48):
        for f, e in zip(first.tolist(), last.tolist(), strict=True):
            seen.update(range(f, e + 1))
    assert len(seen) == len(tokens) - 199, "every window is in a stretch"
    c = bpe.codec()
    assert c.encode(text) == c.encoding.encode_ordinary(text)
    assert 0 < token_counts.automaton().count(b"x" * 100_000) <= 100_000


def test_word_hashes_tell_words_apart():
    from linkfold.llm import common

    words_ = sorted({b"x" * k for k in range(1, 200)} | {bytes([i]) + b"y" * k for i in range(33, 127) for k in range(12)} | {b"y" * k + bytes([i]) for i in range(33, 127) for k in range(12)})
    data = np.frombuffer(b" ".join(words_), np.uint8)
    starts, stops, _ = common.words(data, np.array([0, len(data)]))
    h = common.word_hashes(data, starts, stops)
    assert len(h) == len(words_) == len(set(h.tolist()))
    spans = common.Spans(common.byte_values()[data])
    at = np.arange(len(data) - 40)
    for n in (1, 7, 33):
        text = [data[i : i + n].tobytes() for i in at.tolist()]
        assert len(set(text)) == len(set(spans.fixed(n)[at].tolist())) == len(set(spans.spans(at, at + n).tolist()))


def test_dedup_of_equal_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(60))
    twice = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "short")], "doc_id long, text string")
    assert sorted(r.n_removed for r in substring_dedup.deduplicated(twice).collect()) == [0, 60, 60, 60]
    assert sorted(r.n_removed for r in suffix_dedup.deduplicated(twice).collect()) == [0, *[len(text)] * 3]
    assert substring_dedup.deduplicated(documents(spark, [])).count() == 0
    assert suffix_dedup.deduplicated(documents(spark, [])).count() == 0


def test_windows_in_slices(monkeypatch):
    monkeypatch.setattr(windows, "SLICE", 64)
    r = np.random.default_rng(1)
    values = r.integers(0, 3, 700).astype(np.uint64)
    covered = set()
    for _, first, last, anchor, _, _ in windows.stretches(values, np.array([0, 5, 5, 600, 700]), 9, 4):
        for f, e, a in zip(first, last, anchor, strict=True):
            assert f <= a <= f + 5 and e - f <= 5
        covered |= {(int(f), int(e)) for f, e in zip(first, last, strict=True)}
    assert sum(e - f + 1 for f, e in covered) >= 500


def test_merge_of_runs():
    r = random.Random(2)
    for _ in range(100):
        shared, rest, runs, every = [], [], [], []
        for _ in range(r.randint(0, 7)):
            s = sorted(bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(r.randint(0, 9)))
            at = len(shared)
            a, b = suffix_dedup.front_code(s)
            shared, rest, every = shared + a, rest + b, every + s
            runs.append((at, len(shared)))
        out = list(suffix_dedup.merge([suffix_dedup.Run(a, b, shared, rest) for a, b in runs]))
        assert [x[1] for x in out] == sorted(every)
        assert all(b[2] == suffix_dedup.lcp(a[1], b[1]) for a, b in zip(out, out[1:], strict=False))


# op1


def plain_components(sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("size", "percent"), [(2, 80), (5, 80), (1, 60)])
def test_near_duplicates_equal_plain(spark, size, percent):
    data = texts(21, 150)
    lower = {i: i + 32 for i in range(65, 91)}
    sets = []
    for t in data:
        w = WORD.findall((t or "").translate(lower))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    df = documents(spark, [(i, t, None, None, None) for i, t in enumerate(data)]).withColumn("component_id", F.lit("clash"))
    out = rows(minhash_dedup.near_duplicates(df, size, percent))
    want = plain_components(sets, percent)
    for i, s in enumerate(sets):
        assert (out[i].n_shingles, out[i].component_id, out[i].kept) == (len(s), want[i], want[i] == i)


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(5, "A b c"), (5, "a B c"), (3, "a b c"), (None, "a b c"), (None, "q r s"), (4, None), (6, "")], "doc_id long, text string")
    out = minhash_dedup.near_duplicates(df, 2).collect()
    assert Counter((r.doc_id, r.component_id, r.kept) for r in out) == Counter({(5, 3, False): 2, (3, 3, True): 1, (None, 3, False): 1, (None, None, True): 1, (4, 4, True): 1, (6, 6, True): 1})
    assert minhash_dedup.near_duplicates(documents(spark, []), 2).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "a long, b long")
    assert {(r.node, r.component) for r in components(links).collect()} == {(i, 1) for i in range(1, 41)} | {(100, 100), (101, 100)}


# op3


def test_toxicity_on_held_out_rows(spark):
    r = random.Random(4)
    clean = ["alpha", "beta", "gamma", "delta", "words", "here", "Über", "more"]
    bad = ["nastyone", "nastytwo", "vileish", "vilesome"]
    data, labels = [], []
    for i in range(900):
        toxic = r.random() < 0.2
        w = [r.choice(clean) for _ in range(30)] + [r.choice(bad) for _ in range(3 * toxic)]
        r.shuffle(w)
        data.append((i, " ".join(w), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame([*data, (900, None, None, None, None), (901, "", "en", "s", 0)], SCHEMA).withColumn("score", F.lit("clash"))
    labels.append((None, 1, 1))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, table)).withColumn("held", toxicity.held_out()).collect()
    truth = {i: t for i, _, t in labels}
    held = [x for x in out if x.held and x.doc_id < 900]
    assert len(held) > 100
    assert sum(x.predicted == truth[x.doc_id] for x in held) / len(held) > 0.98
    assert all(0 <= x.score <= 1 for x in out) and len(out) == 902


def test_label_model_moves_where_voters_contradict_the_label():
    r = np.random.default_rng(5)
    truth = r.random(4000) < 0.15
    votes = np.where(truth[:, None], r.random((4000, 12)) < 0.4, r.random((4000, 12)) < 0.01).astype(np.float32)
    copies = np.repeat((r.random(4000) < 0.05)[:, None], 8, 1).astype(np.float32)  # eight voters that are one, and say nothing
    label = np.where(r.random(4000) < np.where(truth, 0.1, 0.01), ~truth, truth).astype(float)
    posterior, rates, parents = toxicity.label_model(np.hstack([votes, copies]), label)
    wrong = label != truth
    assert wrong.sum() > 60
    contradicted = truth & wrong & (votes.sum(1) >= 4)
    assert contradicted.sum() > 20 and (posterior > 0.5)[contradicted].mean() > 0.9
    assert ((posterior > 0.5) == truth).mean() > 1 - 0.6 * wrong.mean()
    assert sorted(parents[12:] >= 12) == [False, *[True] * 7], "copies hang on each other"
    plain = np.hstack([votes, copies])
    for k in range(2):  # the rates are those of the true classes
        assert np.abs(rates[:12, k] - plain[truth == k][:, :12].mean(0)).max() < 0.06
    assert abs(rates[-1, 1] - 0.93) < 0.05 and abs(rates[-1, 0] - 0.01) < 0.01


def test_regression_equals_plain_gradient_descent():
    r = np.random.default_rng(6)
    x, goal = (r.random((200, 5)) < 0.3).astype(float), r.random(200)
    row, column = np.nonzero(x)
    w, b = toxicity.regression(row, column, goal, 5, rounds=3000)
    v, c = np.zeros(5), 0.0
    for _ in range(20000):
        g = 1 / (1 + np.exp(-(x @ v + c))) - goal
        v, c = v - 0.5 * (x.T @ g + 0.02 * v) / 200, c - 0.5 * g.sum() / 200
    assert np.allclose(w, v, atol=0.01) and abs(b - c) < 0.01


def test_toxicity_of_repeated_and_nameless_rows(spark):
    data = [(i // 2, "bad words" if i % 4 < 2 else "fine words", "en", "s", 0) for i in range(200)] + [(None, "bad words", None, None, None)] * 2
    table = spark.createDataFrame([(i, 1, int(i % 2 == 0)) for i in range(100)] + [(0, 1, 0), (1, 1, None)], "doc_id long, quality int, toxic int")
    docs = documents(spark, data)
    out = toxicity.score(docs, toxicity.fit(docs, table)).withColumn("held", toxicity.held_out()).collect()
    assert len(out) == len(data) and all(r.held is not None for r in out)
    assert {(r.text, r.predicted) for r in out} == {("bad words", 1), ("fine words", 0)} and len({r.score for r in out}) == 2


def test_toxicity_of_words_that_are_not_frequent(spark):
    data = [(i, "plain words stand here " + (f"bad{i % 5}" if i % 5 < 3 and i % 4 == 0 else "fine"), "en", "s", 0) for i in range(400)]
    docs = documents(spark, data)
    table = spark.createDataFrame([(i, 1, int("bad" in t)) for i, t, *_ in data], "doc_id long, quality int, toxic int")
    every, few = toxicity.fit(docs, table, size=3), toxicity.fit(docs, table, candidates=3, size=3)
    assert len(every.features) == 3
    assert (few.features == every.features).all() and np.allclose(few.weights, every.weights)


def test_toxicity_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.score(documents(spark), toxicity.fit(documents(spark), none)).collect()
    assert all(x.predicted == 0 for x in out)
    assert toxicity.score(documents(spark, []), toxicity.fit(documents(spark, []), none)).count() == 0
