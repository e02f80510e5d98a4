import hashlib
import random

import numpy as np
import pytest
from helpers import EDGES, SCHEMA, rows, table

from scorewatch.llm import anchors, suffixes
from scorewatch.llm.catalog import queries


def brute(docs):
    """Per document (n_bytes, n_removed, n_spans, sha) from a dictionary of all windows."""
    n, count = suffixes.LENGTH, {}
    data = [(d, (t or "").encode()) for d, t in docs]
    for _, t in data:
        for i in range(len(t) - n + 1):
            w = hash(t[i : i + n])
            count[w] = count.get(w, 0) + 1
    out = []
    for d, t in data:
        cut = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - n + 1):
            if count[hash(t[i : i + n])] > 1:
                cut[i : i + n] = True
        kept = bytes(b for b, c in zip(t, cut) if not c)
        spans = int(((cut[1:] != cut[:-1]) & cut[:-1]).sum())
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table("documents")]
    got = run(queries()["op1_suffix_dedup"](spark, "/root/testdata/sf0.001"))
    assert got == brute(docs)
    assert sum(r[2] for r in got) > 0


def test_made_up_repeats(spark):
    r = random.Random(4)
    say = lambda k: "".join(r.choice("ab é") for _ in range(k))
    shared, line = say(500), "same line again and again " * 12
    docs = [(1, say(300) + shared[100:350] + say(90)), (2, shared), (3, say(40) + shared[:199] + say(400))]
    docs += [(4, line * 3), (5, say(2000)), (6, line[3:260]), (7, shared[250:] + "x" + shared[:260])]
    docs += [(8, "a" * 199), (9, "b" * 200), (10, "c" * 201), (11, None), (12, "")]
    docs += [(20 + i, say(r.randint(0, 300)) + shared[i * 7 : i * 7 + 230] + say(r.randint(0, 300))) for i in range(30)]
    got = run(suffixes.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")))
    assert got == brute(docs)


def test_defined_cases(spark):
    df = spark.createDataFrame([e for e in EDGES if e[0] != 5] + [(5, EDGES[6][1][:5000], "b", "x")] * 2, SCHEMA)
    got = run(suffixes.remove_repeats(df, with_text=True))
    assert len(got) == len(EDGES) + 1
    assert [(g[1], g[2], g[3], g[5]) for g in got if g[0] == 5] == [(5000, 5000, 1, "")] * 2
    assert all(g[2] == 0 for g in got if g[0] != 5)
    assert suffixes.remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("piece", [anchors.PIECE, 700])
def test_equal_windows_share_an_anchor(monkeypatch, piece):
    monkeypatch.setattr(anchors, "PIECE", piece)
    r = np.random.default_rng(2)
    with np.errstate(over="ignore"):
        common = r.integers(97, 100, 260, dtype=np.uint8)
        found = []
        for lead in (0, 37, 555):
            text = np.concatenate([r.integers(97, 100, lead, dtype=np.uint8), common, r.integers(97, 100, 900, dtype=np.uint8)])
            place = {}
            for seed, anchor, first, last, _ in anchors.blocks(text, 200):
                for s, a, f, l in zip(seed, anchor, first, last):
                    assert f <= a <= f + 168 and l <= a
                    place.update({p: (s, a - p) for p in range(f, l + 1)})
            assert sorted(place) == list(range(len(text) - 199))
            found.append([place[lead + i] for i in range(61)])
    assert found[0] == found[1] == found[2]
