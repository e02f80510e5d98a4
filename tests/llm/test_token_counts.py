import random

import public_tokenizers
import pytest
import tokenizers
from helpers import EDGES, LONG, SCHEMA, rows, table

from scorewatch.llm import token_counts
from scorewatch.llm.catalog import queries

SF = "/root/testdata/sf0.01"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_query_against_the_library(spark):
    model = tokenizers.Tokenizer.from_file(BYTE_BPE)
    got = {r["doc_id"]: r for r in rows(queries()["op12_token_counts"](spark, SF))}
    docs = table("documents", SF)
    assert len(got) == len(docs)
    for d in docs:
        text = d["text"] or ""
        n = len(model.encode(text, add_special_tokens=False).ids)
        assert got[d["doc_id"]] == {
            "doc_id": d["doc_id"], "n_bytes": len(text.encode()), "n_tokens": n, "over_limit": n > 512
        }


def test_pieces_count_like_whole_texts(monkeypatch):
    """Texts of awkward characters, cut after every few of them, and their words one by one."""
    with open(BYTE_BPE, "rb") as f:
        count, safe = token_counts.counter("x.json", f.read())
    lengths = token_counts.Lengths(count, safe)
    monkeypatch.setattr(token_counts, "KNOWN", 200)  # forgets in between
    assert safe
    r = random.Random(1)
    signs = ["a", "b", " ", "  ", "\n", "\t", "1", "9", "'s", "'", "é", "中", "\x85", "\xa0", "\x1c", "<|endoftext|>", "<|", "|>",
             "!", "　", "endoftext", "²", "👍", "\r", " '", "\x0b"]
    for _ in range(1500):
        text = "x" + "".join(r.choice(signs) for _ in range(r.randint(0, 60)))
        for size in (1, 5):
            parts = list(token_counts.pieces(text, size))
            assert "".join(parts) == text and sum(count(parts)) == count([text])[0], repr(text)
        assert lengths([text, text[1:]]) == count([text, text[1:]]), repr(text)


@pytest.mark.parametrize("batch_bytes", [4, 64, 1000])
def test_batches_change_nothing(spark, batch_bytes):
    df = spark.createDataFrame([(i, t * 20) for i, t in enumerate(("é x ", "abc1", "a", "\n", "<|endoftext|>", " the end"))], "doc_id long, text string")
    want = rows(token_counts.token_counts(df, BYTE_BPE))
    assert rows(token_counts.token_counts(df, BYTE_BPE, batch_bytes=batch_bytes)) == want
    assert {r["doc_id"]: r["n_tokens"] for r in want}[4] == 20  # special strings are one token each


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_defined_cases(spark, name):
    df = spark.createDataFrame(EDGES, SCHEMA).selectExpr("*", "'x' AS n_tokens", "'y' AS n_bytes")
    path = public_tokenizers.path(name)
    got = rows(token_counts.token_counts(df, path))
    assert got[0].keys() == {"doc_id", "n_bytes", "n_tokens", "over_limit"}
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(e[0] or 0 for e in EDGES)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["n_tokens"] == 0 for i in (1, 2)) and by[1]["n_bytes"] == 0 and not by[1]["over_limit"]
    assert by[5]["n_tokens"] >= 150_000 and by[5]["over_limit"] and by[5]["n_bytes"] == len(LONG)
    assert token_counts.token_counts(df.limit(0), path).count() == 0
