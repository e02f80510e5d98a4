"""Plain definitions that the operators are compared with."""

import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor sit amet " * 30_000
EDGES = [
    (1, None, "a", "x"),
    (2, "", "a", None),
    (3, "   \n\t ", None, "x"),
    (4, "one two three", "b", "x"),
    (4, "one two three", "b", "x"),
    (None, "One two THREE", "b", "x"),
    (5, LONG, "b", "x"),
    (6, "one two three four five six", None, None),
    (7, "One TWO three four five six", None, None),
]
SCHEMA = "doc_id long, text string, source string, size string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def table(name, folder=SF):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def rows(df):
    return [r.asDict() for r in df.collect()]


def shingle_set(text):
    w = words(text)
    n = min(5, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set()


def brute_components(docs):
    """doc_id -> smallest doc_id of its component, by comparing all documents that share a shingle."""
    sets = {d: shingle_set(t) for d, t in docs}
    parent = {d: d for d in sets}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    where = {}
    for d in ids:
        for s in sets[d]:
            where.setdefault(s, []).append(d)
    seen = set()
    for group in where.values():
        for i, a in enumerate(group):
            for b in group[i + 1 :]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    x, y = len(sets[a] & sets[b]), len(sets[a] | sets[b])
                    if 100 * x >= 75 * y:
                        p, q = sorted((top(a), top(b)))
                        parent[q] = p
    return {d: top(d) for d in ids}, sets
