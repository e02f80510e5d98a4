from compare import compare, connect
from helpers import EDGES, SCHEMA, rows

import pytest

from scorewatch.llm import mixing, rules
from scorewatch.llm.catalog import oracle_sql, queries


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, name):
    assert compare(spark, connect("/root/testdata/sf0.001"), name, queries()[name], oracle_sql()[name], "/root/testdata/sf0.001") is None


def test_mix_defined_cases(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    got = rows(mixing.mix(df))
    assert len(got) == len(EDGES)
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - sum(r["size"] for r in got)) <= len(got)
    assert mixing.mix(df.limit(0)).count() == 0
    full = mixing.mixed_documents(df.drop("size"))
    assert full.columns[:3] == ["doc_id", "text", "source"] and {r["text"] for r in rows(full)} <= {e[1] for e in EDGES}


def test_cap_is_reshared(spark):
    docs = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 10), ("b", 1000), ("c", 1000), ("d", 20)])]
    got = {r["doc_id"]: r["target"] for r in rows(mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")))}
    assert got[0] == 30 and got[3] == 60
    assert abs(got[1] - 2 * got[2]) < 1e-6 and abs(sum(got.values()) - 2030) < 1e-6


def test_rules_defined_cases(spark):
    df = spark.createDataFrame(EDGES, SCHEMA)
    got = {r["doc_id"]: r for r in rows(rules.quality(df))}
    assert got[1]["n_words"] == 0 and got[1]["base_failed"]
    assert got[5]["n_words"] == got[5]["n_repeat_words"] == 150_000 and not got[5]["kept"]
    assert rules.quality(df.limit(0)).count() == 0
    assert rules.accepted(df).columns == df.columns


def test_policies_and_ablations(spark):
    good = " ".join(f"word{i}" for i in range(40))
    docs = [(1, good), (2, good + "".join(f" ##{i}" for i in range(20))), (3, "few words"), (4, "x " * 50)]
    book = rules.ledger(spark.createDataFrame(docs, "doc_id long, text string")).cache()
    kept = lambda p: {r["doc_id"] for r in rows(rules.judged(book, p)) if r["kept"]}
    assert kept("base-1") == {1, 2} and kept("web-1") == {1}
    out = {r["rule"]: (r["n_failed"], r["n_only"]) for r in rows(rules.ablations(book, "web-1"))}
    assert out["symbols"] == (1, 1) and out["few_words"] == (1, 1) and out["repeated_windows"][0] == 1


def test_emitted_words_meet_the_targets(spark):
    """Words counted in the emitted texts: 3 copies of a, over one of b, under one of c."""
    docs = [(i, s, f" {s}{i} \n" + " ".join(f"{s}{i}-{k}" for k in range(n - 1)) + "\t", 0)
            for s, many, n in (("a", 5, 7), ("b", 40, 30), ("c", 200, 25)) for i in range(many)]
    df = spark.createDataFrame([(f"{s}{i}", s, t, n) for i, s, t, n in docs], "doc_id string, source string, text string, n_chars int")
    mixed = mixing.mixed_documents(df)
    plan = {r["doc_id"]: r for r in rows(mixed)}
    got = rows(mixing.emitted(mixed))
    assert list(got[0]) == ["doc_id", "source", "text", "n_chars", "repetition"]
    texts, words = {f"{s}{i}": t for i, s, t, _ in docs}, {"a": 0, "b": 0, "c": 0}
    for r in got:
        p, given = plan[r["doc_id"]], texts[r["doc_id"]].split()
        words[r["source"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
        if r["repetition"] < p["whole"]:
            assert r["text"] == texts[r["doc_id"]]
        else:
            assert r["repetition"] == p["whole"]
            assert r["text"].split() == given[p["part_start"] : p["part_start"] + p["part_words"]] and r["text"] in texts[r["doc_id"]]
    targets = {r["source"]: r["target"] for r in plan.values()}
    many = {"a": 5, "b": 40, "c": 200}
    assert targets["a"] == 105 and targets["b"] > 1200 and targets["c"] < 5000
    assert all(abs(words[s] - targets[s]) <= many[s] for s in words)
    assert len(got) == sum(p["whole"] + (p["part_words"] > 0) for p in plan.values())


def test_emitted_edges(spark):
    mixed = mixing.mixed_documents(spark.createDataFrame(EDGES, SCHEMA))
    got = rows(mixing.emitted(mixed))
    assert sum(len(r["text"].split()) for r in got) == sum(r["taken"] for r in rows(mixed))


def test_mix_keeps_columns_of_its_own_names(spark):
    """Columns of the documents that are called like those of the mix stay what they are."""
    text = "one two three four five six seven eight"
    docs = [(i, text, "ab"[i % 2], "mine", 7, "kept", "own") for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, size string, taken int, emitted string, mix_size string")
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == [*df.columns, "mix_mix_size", "source_size", "target", "mix_taken", "whole", "part_words", "part_start", "mix_emitted"]
    got = rows(mixed)
    assert all((r["size"], r["taken"], r["emitted"], r["mix_size"], r["mix_mix_size"]) == ("mine", 7, "kept", "own", 8) for r in got)
    out = mixing.emitted(mixed)
    assert out.columns == [*df.columns, "repetition"]
    assert sum(len(r["text"].split()) for r in rows(out)) == sum(r["mix_taken"] for r in got)


def test_null_ids_draw_by_their_text(spark):
    """A source without ids meets its target to within the rounding of its documents, not all rounded alike."""
    docs = [(None, " ".join(f"w{i}x{k}" for k in range(20)), "a") for i in range(100)] + [(1, "w " * 1000, "b")]
    got = rows(mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string")))
    own = [r for r in got if r["doc_id"] is None]
    assert len({r["taken"] for r in own}) > 1 and abs(sum(r["taken"] for r in own) - own[0]["target"]) < 20
