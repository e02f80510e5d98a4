import math
import random
from collections import Counter

import numpy as np
import pytest
from helpers import EDGES, SCHEMA, rows, shingle_set, table, words

from scorewatch.llm import bm25
from scorewatch.llm.catalog import queries

SF = "/root/testdata/sf0.01"


def test_query_against_brute_force(spark):
    """Every document and item that share three quarters of the item's shingles, and no other."""
    items = [(r["item_id"], shingle_set(r["text"])) for r in table("benchmark", SF)]
    want = set()
    for d in table("documents", SF):
        own = shingle_set(d["text"])
        want |= {(d["doc_id"], i) for i, s in items if len(s & own) >= 0.75 * len(s)}
    got = rows(queries()["op5_decontamination"](spark, SF))
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want) > 10
    assert all(r["score"] >= bm25.SCORE and r["overlap"] >= bm25.OVERLAP for r in got)


def test_block_bounds_lose_nothing(monkeypatch):
    """Scores at the threshold against plain BM25 of every passage and item."""
    monkeypatch.setattr(bm25, "ITEM_BLOCK", 3)
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    pick = lambda n: [vocabulary[min(59, int(r.expovariate(0.08)))] for _ in range(n)]
    items = [(i, " ".join(pick(r.randint(1, 12)))) for i in range(20)]
    sets = [set(t.split()) for _, t in items]
    h = lambda t: bm25.word_hashes(np.frombuffer(t.encode(), np.uint8))
    with np.errstate(over="ignore"):
        df = {int(h(w)[0].view(np.int64)): sum(w in s for s in sets) for w in vocabulary}
        mean = sum(len(t.split()) for _, t in items) / 20
        index = bm25.Index.build(items, df, 20, mean)
        for _ in range(60):
            text = pick(r.randint(0, 30))
            if r.random() < 0.5:
                text += r.choice(items)[1].split()[: r.randint(1, 12)]
            numbers = index.numbered(h(" ".join(text)))
            word = np.unique(numbers[numbers >= 0])
            _, item, score = index.search(np.zeros(len(word), int), word, 1, 0.6)
            want = {}
            for i, (_, t) in enumerate(items):
                full = part = 0.0
                for w in sets[i]:
                    n, tf = sum(w in s for s in sets), t.split().count(w)
                    x = math.log(1 + (20 - n + 0.5) / (n + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(t.split()) / mean))
                    full += x
                    part += x * (w in text)
                if part / full >= 0.6 - 1e-9:
                    want[i] = part / full
            assert dict(zip(item.tolist(), score.tolist())) == pytest.approx(want)


@pytest.mark.parametrize("length,longest", [(0, 5), (3, 10), (10, 10), (11, 10), (100, 7), (257, 31)])
def test_passages_hold_every_run(length, longest):
    numbers = np.arange(length)
    passage, word, n = bm25.passages_of(numbers, longest)
    held = {}
    for p, w in zip(passage.tolist(), word.tolist()):
        held.setdefault(p, set()).add(w)
    assert set(held) <= set(range(n))
    for start in range(max(1, length - longest + 1)):
        run = set(range(start, min(length, start + longest)))
        assert any(run <= s for s in held.values()) or not run


def test_defined_cases(spark):
    items = spark.createDataFrame(
        [(1, "one two three four five six."), (1, "one two three four five six."), (2, None), (3, "one two three"), (None, "lorem ipsum dolor sit amet lorem")],
        "item_id long, text string",
    )
    df = spark.createDataFrame(EDGES + [(9, "x One two three four five six. y", "a", "b")], SCHEMA)
    got = sorted(((r["doc_id"] or 0, r["item_id"] or 0) for r in rows(bm25.leaks(df, items))))
    assert (9, 1) in got and (5, 0) in got and got.count((4, 3)) == 2 and (0, 3) in got
    assert not {1, 2, 3} & {d for d, _ in got}
    few = bm25.leaks(df, items, part_words=1)
    assert sorted(((r["doc_id"] or 0, r["item_id"] or 0) for r in rows(few))) == got
    assert bm25.leaks(df.limit(0), items).count() == 0 and bm25.leaks(df, items.limit(0)).count() == 0
    kept = bm25.decontaminated(df, items.where("item_id = 1"))
    assert kept.columns == df.columns and kept.count() == df.count() - 1


def runs(words_, size):
    return {tuple(words_[i : i + size]) for i in range(len(words_) - size + 1)}


def test_short_items_and_parts_against_brute_force(spark):
    """Items of one to eight words, in one part or two, whole, cut, or with another answer, inside longer texts."""
    r = random.Random(8)
    pick = lambda n: [r.choice("abcdefghijklmnopqrstuvwxyz") * 2 for _ in range(n)]
    items, parts = [], []
    for i in range(60):
        q, a = pick(r.choice((0, 0, 1, 2, 3, 4, 5, 7))), pick(r.randint(1, 6))
        text = " ".join([*q[:-1], q[-1] + "?", *a] if q else a)
        items.append((i, text))
        parts.append((words(text), len(q)))
    docs = [(0, "alpha"), (1, None)]
    for i in range(400):
        middle, n = parts[r.randrange(60)]
        middle = r.choice((middle, middle[1:], middle[:n], middle[:n] + pick(3), pick(4) + middle[n:], middle[:-1]))
        docs.append((i + 2, " ".join(pick(r.randint(0, 30)) + middle + pick(r.randint(0, 30)))))
    want = set()
    for d, text in docs:
        w = words(text)
        for (i, _), (item, n) in zip(items, parts):
            question = runs(item[:n], min(5, n)) if n else set()
            answer = runs(item, min(5, len(item))) - question
            found = [len(p & runs(w, len(next(iter(p))))) if p else 0 for p in (question, answer)]
            shares = [f / len(p) for f, p in zip(found, (question, answer)) if p]
            if sum(found) >= 0.75 * (len(question) + len(answer)) and min(shares) >= 0.5:  # all questions end in "?"
                want.add((d, i))
    df, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in rows(bm25.leaks(df, tests))}
    assert got == want and len(want) > 300
    kept = {r["doc_id"] for r in rows(bm25.decontaminated(df, tests))}
    assert kept == {d for d, _ in docs} - {d for d, _ in want}


def test_a_question_with_another_answer_is_no_leak(spark):
    items = spark.createDataFrame(
        [(1, "which of the seven rivers of the old land is the longest one of all? the blue river"), (2, "alpha beta gamma"),
         (3, "what is this? delta epsilon"), (4, "two words. yes it is")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(1, "x which of the seven rivers of the old land is the longest one of all? nobody knows it y"),
         (2, "x which of the seven rivers of the old land is the longest one of all? the blue river y"),
         (3, "so alpha beta gamma is it"), (4, "and what is this? delta epsilon or so"), (5, "here are two words. yes it is so")],
        "doc_id long, text string",
    )
    assert {(r["doc_id"], r["item_id"]) for r in rows(bm25.leaks(docs, items))} == {(2, 1), (3, 2), (4, 3), (5, 4)}
    # a passage that ends in a short sentence is judged as a whole
    passage = spark.createDataFrame([(9, "all of the many words of this passage are here to be found again. So.")], "item_id long, text string")
    copy = spark.createDataFrame([(1, "x all of the many words of this passage are here to be found again. No.")], "doc_id long, text string")
    assert bm25.leaks(copy, passage).count() == 1


def test_low_thresholds_lose_nothing(spark):
    """Below the share that words which are not essential may add: every score of plain BM25 at the threshold is found."""
    r = random.Random(6)
    texts = [" ".join(f"w{min(39, int(r.expovariate(0.1)))}" for _ in range(r.randint(3, 12))) for _ in range(30)]
    sets = [set(t.split()) for t in texts]
    h = lambda t: bm25.word_hashes(np.frombuffer(t.encode(), np.uint8))
    with np.errstate(over="ignore"):
        df = {int(h(f"w{k}")[0].view(np.int64)): sum(f"w{k}" in s for s in sets) for k in range(40)}
        mean = sum(len(t.split()) for t in texts) / 30
        full = bm25.Index.build(list(enumerate(texts)), df, 30, mean, 1e-12)
        index = bm25.Index.build(list(enumerate(texts)), df, 30, mean, min(bm25.REST, 0.1))
        for k in range(40):
            word = index.numbered(h(f"w{k}"))
            word = word[word >= 0]
            found = [x.search(np.zeros(len(word), int), word, 1, 0.1) for x in (index, full)]
            assert found[0][1].tolist() == found[1][1].tolist()
    with pytest.raises(ValueError):
        next(bm25.indexes(spark.createDataFrame([(1, "a")], "item_id long, text string"), score=0.0))


def test_workers_need_not_have_the_package():
    """The driver alone finds the package: broadcasts and functions bring all that tasks use."""
    import pathlib
    import subprocess
    import sys

    root = str(pathlib.Path(__file__).resolve().parents[2])
    code = f"""
import sys; sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from scorewatch.llm import bm25
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
docs = spark.createDataFrame([(1, "x one two three four five six y")], "doc_id long, text string")
items = spark.createDataFrame([(7, "one two three four five six")], "item_id long, text string")
print("FOUND", bm25.leaks(docs, items).collect()[0]["item_id"], bm25.decontaminated(docs, items).count())
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd="/", timeout=300)
    assert "FOUND 7 0" in said.stdout, said.stderr[-2000:]


def test_searches_look_at_few_entries(monkeypatch):
    """Frequent words stand in every block of the index: a search takes as many passages as fit its bound, with the same result."""
    r = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(r.choice(words) for _ in range(30))) for i in range(200)]
    held = [items[i][1].split() for i in (3, 77, 150)]
    docs = [" ".join(sum(([r.choice(words) for _ in range(400)] + h for h in held), [])) for _ in range(3)]
    counts = Counter(h for _, t in items for h in {int(x) for x in bm25.word_hashes(np.frombuffer(t.encode(), np.uint8)).view(np.int64)})
    index = bm25.Index.build(items, counts, len(items), 30)
    views = [np.frombuffer(d.encode(), np.uint8) for d in docs]
    want = list(bm25._found(views, index, bm25.SCORE, bm25.OVERLAP, bm25.PART))
    assert {(f[0], f[1]) for f in want} == {(d, i) for d in range(3) for i in (3, 77, 150)}
    seen, search = [], bm25.Index.search

    def spied(self, passage, word, *rest):
        seen.append((int((self.block_from[word + 1] - self.block_from[word]).sum()), len(set(passage.tolist()))))
        return search(self, passage, word, *rest)

    monkeypatch.setattr(bm25.Index, "search", spied)
    for most in (5000, 1):
        monkeypatch.setattr(bm25, "BATCH_ENTRIES", most)
        seen.clear()
        assert list(bm25._found(views, index, bm25.SCORE, bm25.OVERLAP, bm25.PART)) == want
        assert len(seen) > 5 and all(n <= most or passages == 1 for n, passages in seen)
