import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import EDGES, SCHEMA, rows, table

from scorewatch.llm import periodic_runs
from scorewatch.llm.catalog import queries

SF = "/root/testdata/sf0.01"


def brute(words, least=24, times=3):
    """All runs by definition: every period, every maximal stretch, smallest periods only."""
    n, out = len(words), []
    ids = periodic_runs.numbered(words)
    for q in range(1, n // times + 1):
        same = np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(int)
        for i, j in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            length = int(j - i + q)
            if length >= max(least, times * q):
                part = ids[i : i + length]
                if not any((part[d:] == part[:-d]).all() for d in range(1, q)):
                    out.append((int(i), length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_query_against_brute_force(spark):
    got = {r["doc_id"]: r for r in rows(queries()["op13_periodic_runs"](spark, SF))}
    docs = table("documents", SF)
    assert len(got) == len(docs)
    found = 0
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d["text"] or "")
        h, n = zlib.crc32(str(d["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if len(words) > 4000:
            continue  # the definition is quadratic; long texts are compared in the test below
        runs = brute(words)
        r = got[d["doc_id"]]
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *(best or (None,) * 3))
        assert r["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        gone = {i for s, m, q in runs for i in range(s + q, s + m)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        assert r["collapsed_sha256"] == hashlib.sha256(kept.encode()).hexdigest()
        found += len(runs)
    assert found > 50


@pytest.mark.parametrize("least,times", [(24, 3), (4, 3), (6, 2), (1, 2)])
def test_runs_of_small_alphabets(least, times):
    r = random.Random(3)
    found = 0
    for _ in range(600):
        k = r.randint(1, 4)
        words = [r.randrange(k) for _ in range(r.randint(0, 60))]
        if r.random() < 0.5:
            part = [r.randrange(k) for _ in range(r.randint(1, 6))]
            words = words[: r.randint(0, 20)] + part * r.randint(1, 9) + words[: r.randint(0, 10)]
        want = brute(words, least, times)
        assert periodic_runs.runs_of(periodic_runs.numbered(words), least, times) == want, words
        found += len(want)
    assert found


def test_long_texts():
    """Over a million words of the worst shapes, in time that grows with their number."""
    n = 1_000_000
    start = time.time()
    assert periodic_runs.runs_of(np.zeros(n, np.int64)) == [(0, n, 1)]
    assert periodic_runs.runs_of(np.arange(n) % 1000) == [(0, n, 1000)]
    assert periodic_runs.runs_of(np.arange(n)) == []
    a, b = [0], [0, 1]
    while len(b) < 200_000:
        a, b = b, b + a
    assert periodic_runs.runs_of(np.array(b)) and time.time() - start < 180


def test_defined_cases(spark):
    df = spark.createDataFrame(EDGES, SCHEMA).selectExpr("*", "'x' AS period", "'y' AS start", "1 AS words")
    got = rows(periodic_runs.periodic_runs(df, periodic_runs.planted))
    assert got[0].keys() == {c.split()[0] for c in periodic_runs.SCHEMA.split(", ")}
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(e[0] or 0 for e in EDGES)
    by = {r["doc_id"]: r for r in got}
    empty = hashlib.sha256(b"").hexdigest()
    for i in (1, 2, 3):
        assert (by[i]["n_runs"], by[i]["start"], by[i]["runs_sha256"], by[i]["collapsed_sha256"]) == (0, None, empty, empty)
    plain = {r["doc_id"]: r for r in rows(periodic_runs.periodic_runs(df))}
    assert (plain[5]["n_runs"], plain[5]["start"], plain[5]["period"]) == (1, 0, 5)
    assert plain[5]["collapsed_sha256"] == hashlib.sha256(b"lorem ipsum dolor sit amet").hexdigest()
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_collapsed_documents_keep_their_columns(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    got = periodic_runs.collapsed_documents(df)
    assert got.columns == df.columns and got.count() == len(EDGES)
    by = {r["doc_id"]: r["text"] for r in rows(got)}
    assert by[5] == "lorem ipsum dolor sit amet" and by[1] is None and by[3] == "   \n\t " and by[7] == EDGES[8][1]
