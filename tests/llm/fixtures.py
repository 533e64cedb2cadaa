"""Small tables with the cases that every operator must bear, and plain versions to compare with."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def texts(seed=1, n=60, words=40):
    """Texts of few words, with copies, near copies, shared passages, and texts that are null, empty, blank, long."""
    r = random.Random(seed)
    vocabulary = ["a", "bé", "Ccc", "d,d", "e", "f!", "ggg", "h", "日本", "it's", "K9", "lll"]
    line = lambda k: " ".join(r.choice(vocabulary) for _ in range(k))
    passage = line(30)
    out = [None, "", "  \t\n", "x", "one two", "la " * 300, "z" * 3000, line(2000)]
    while len(out) < n:
        kind = r.random()
        if kind < 0.2 and len(out) > 9:
            out.append(r.choice(out[8:]))
        elif kind < 0.5 and len(out) > 9:
            w = r.choice(out[8:]).split(" ")
            w[r.randrange(len(w))] = "changed"
            out.append(" ".join(w))
        elif kind < 0.7:
            out.append(line(r.randint(0, 20)) + " " + passage + "\n" + line(r.randint(0, 20)))
        else:
            out.append("\n".join(line(r.randint(1, words)) for _ in range(r.randint(1, 6))))
    return out


def documents(spark, rows=None):
    rows = [(i, t, "en", ["s1", "s2", None, "é"][i % 4], 0) for i, t in enumerate(texts())] if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA)
