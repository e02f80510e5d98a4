import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from helpers import EDGES, LONG, SCHEMA, SF, rows, table

from scorewatch.llm import resampling
from scorewatch.llm.catalog import queries

LOW = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    grams = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10000 for g in grams]


def brute(docs, target):
    own = [features(d["text"]) for d in docs]
    s, t = Counter(b for _, f in own for b in f), Counter(b for d in target for b in features(d["text"])[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in range(10000)]
    out = []
    for d, (n, f) in zip(docs, own):
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{d['doc_id']}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append({"doc_id": d["doc_id"], "n_features": len(f), "weight": weight, "score": score, "rank": None, "n": n})
    enough = sorted((r for r in out if r["n"] >= 20), key=lambda r: (-r["score"], r["doc_id"]))
    for rank, r in enumerate(enough[: 5 * len(enough) // 100], 1):
        r["rank"] = rank
    return sorted([{k: v for k, v in r.items() if k != "n"} for r in out], key=lambda r: r["doc_id"])


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, folder):
    got = sorted(rows(queries()["op11_resampling"](spark, folder)), key=lambda r: r["doc_id"])
    assert got == brute(table("documents", folder), table("benchmark", folder))
    assert any(r["rank"] for r in got)


def test_hash_is_xxhash64_and_checksum_crc32():
    r = random.Random(0)
    raw = bytes(r.randrange(256) for _ in range(3000))
    data = np.frombuffer(raw + bytes(resampling.PAD), np.uint8)
    start = np.array([r.randrange(2800) for _ in range(1000)])
    size = np.array([r.randrange(200) for _ in range(1000)])
    got = resampling.xxhash64(data, start, size)
    assert [int(h) for h in got] == [xxhash.xxh64_intdigest(raw[a : a + n]) for a, n in zip(start, size)]
    got = resampling.crc32(data, start, size)
    assert [int(h) for h in got] == [zlib.crc32(raw[a : a + n]) for a, n in zip(start, size)]


@pytest.mark.parametrize("keys", [1, 3, None])
def test_equal_keys_do_not_merge_ngrams(monkeypatch, keys):
    """Counts by bytes, even where all n-grams, or a third of them, have one key."""
    whole = resampling.xxhash64
    if keys:
        monkeypatch.setattr(resampling, "xxhash64", lambda *a: whole(*a) % np.uint64(keys))
    r = random.Random(1)
    texts = [" ".join(r.choice(("a", "b", "ab", "é", "12345678", "123456789", "x" * 40)) for _ in range(r.randint(0, 40))) for _ in range(20)]
    want = Counter(b for t in texts for b in features(t)[1])
    for batch in (1, 7, 1000):
        total = Counter()
        for _, _, of, t in resampling.interned(pa.array(texts), 3, 10000, batch):
            total.update(t.bucket[t.slot].tolist())
            assert t.count.sum() == len(of) and all((t.slot == s).sum() == t.count[s] for s in set(t.slot.tolist()))
        assert total == want


def test_defined_cases(spark):
    target = spark.createDataFrame([("lorem ipsum dolor", 1), (None, 2)], "text string, rank int")
    docs = spark.createDataFrame(EDGES, SCHEMA).selectExpr("*", "'x' AS rank", "1 AS score", "2 AS weight")
    got = rows(resampling.resample(docs, target, percent=100))
    assert got[0].keys() == {"doc_id", "n_features", "weight", "score", "rank"}
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(e[0] or 0 for e in EDGES)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["n_features"] == by[i]["weight"] == 0 for i in (1, 2, 3))
    n = len(LONG.split())
    assert by[5]["n_features"] == 3 * n - 3 and by[5]["rank"] == 1
    assert [r["rank"] for r in got if r["doc_id"] != 5] == [None] * (len(EDGES) - 1)
    assert by[4]["weight"] == by[None]["weight"]  # case does not count
    assert resampling.resample(docs.limit(0), target).count() == 0
    assert resampling.resample(docs, target.limit(0)).count() == len(EDGES)


def test_ranks_break_ties_by_id_and_number_repeated_rows(spark):
    text = "one two three four five " * 5
    docs = spark.createDataFrame([(i, text) for i in (3, 1, 2, 2, None)], "doc_id long, text string")
    got = rows(resampling.resample(docs, docs, percent=80, seed=0))
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]
    order = sorted(got, key=lambda r: (-r["score"], r["doc_id"] is None, r["doc_id"]))
    assert [r["rank"] for r in order] == [1, 2, 3, 4, None]
