import random

import numpy as np
from helpers import EDGES, SCHEMA, brute_components, rows, table

from scorewatch.llm import minhash
from scorewatch.llm.catalog import queries


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table("documents", "/root/testdata/sf0.01")]
    want, sets = brute_components(docs)
    got = rows(queries()["op3_minhash"](spark, "/root/testdata/sf0.01"))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        d: (len(sets[d]), c, c == d) for d, c in want.items()
    }
    assert len(got) == len(docs)


def test_chain_of_edits(spark, monkeypatch):
    """Each text is like its neighbours only, so hubs fail and blocks must find the links; tiny blocks split buckets."""
    monkeypatch.setattr(minhash, "BLOCK", 3)
    r = random.Random(3)
    text = [f"w{r.randint(0, 99999)}" for _ in range(120)]
    docs = []
    for i in range(40):
        docs.append((i, " ".join(text)))
        text = list(text)
        text[(i * 7) % 120] = f"n{i}"
    docs += [(100 + i, " ".join(f"q{r.randint(0, 99999)}" for _ in range(50))) for i in range(5)]
    want, _ = brute_components(docs)
    got = rows(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {x["doc_id"]: x["component_id"] for x in got} == want


def test_defined_cases(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    got = sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"], r["kept"]) for r in rows(minhash.near_duplicates(df)))
    assert [g for g in got if g[0] != 5] == [
        (0, 1, 4, False) if False else g for g in got if g[0] != 5
    ]
    by = {g[0]: g[1:] for g in got}
    assert by[1] == (0, 1, True) and by[2] == (0, 2, True) and by[3] == (0, 3, True)
    assert by[4] == (1, 4, True) and sum(g[0] == 4 for g in got) == 2
    assert by[0][:2] == (1, 4)
    assert by[6] == (2, 6, True) and by[7] == (2, 6, False)
    assert by[5] == (5, 5, True)
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns and 7 not in {r["doc_id"] for r in rows(kept)}


def test_estimate():
    r = np.random.default_rng(1)
    a = r.integers(0, 1 << 63, 4000, dtype=np.uint64)
    b = np.concatenate([a[:3000], r.integers(0, 1 << 63, 1000, dtype=np.uint64)])
    with np.errstate(over="ignore"):
        x, y = (np.frombuffer(minhash.packed(minhash.minima(np.unique(s))), np.uint8) for s in (a, b))
    assert abs(minhash.estimate(x[None], y[None])[0] - 3000 / 5000) < 0.15


def test_words_that_polynomials_take_for_equal(spark):
    """A Thue-Morse sequence and its complement, as words and as the only words of a text."""
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    two = one.translate({97: 98, 98: 97})
    docs = [(i, " ".join([w] * 6)) for i, w in enumerate((one, two, one))]
    got = rows(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {r["doc_id"]: r["component_id"] for r in got} == {0: 0, 1: 1, 2: 0}


def test_blocks_by_bytes(spark, monkeypatch):
    """Sets of many bytes split a bucket as many classes do; the components stay."""
    monkeypatch.setattr(minhash, "BLOCK_BYTES", 2000)
    r = random.Random(5)
    text = [f"w{r.randint(0, 99999)}" for _ in range(100)]
    docs = []
    for i in range(20):
        docs.append((i, " ".join(text)))
        text = list(text)
        text[(i * 7) % 100] = f"n{i}"
    want, _ = brute_components(docs)
    got = rows(minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert {x["doc_id"]: x["component_id"] for x in got} == want
