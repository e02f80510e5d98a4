import hashlib
import random
import re

import pytest
from helpers import EDGES, SCHEMA, rows, table

from scorewatch.llm import crf, licenses, pii, secret_scan
from scorewatch.llm.catalog import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts():
    return {r["doc_id"]: r["text"] for r in table("documents", SF)}


def _sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def test_secret_query(spark, texts):
    got = {r["doc_id"]: r for r in rows(queries()["op7_secret_scan"](spark, SF))}
    assert got.keys() == texts.keys()
    found = 0
    for d, t in texts.items():
        spans = []
        for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", t):
            if len(m[2]) >= 6:
                spans.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
        spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        spans.sort()
        r = got[d]
        assert r["base_sha256"] == _sha([s[2] for s in spans])
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[1] == k for s in spans) for k in range(3)]
        assert {s[2] for s in spans} <= set(r["spans"].split(","))
        found += len(spans)
    assert found > 20
    extra = sum(r["spans"].count("crf:") for r in got.values())
    assert extra < found / 4  # numbers, cards and addresses are no secrets


def test_secret_model_on_held_out_tokens():
    runs = list(secret_scan.made_up_runs(1))
    model = crf.Chain.fit(runs, 3)
    right = wrong = missed = 0
    for rows_, tags in secret_scan.made_up_runs(2):
        for a, b in zip(model.decode(rows_), tags):
            right += a == b != 0
            wrong += a != b and a != 0
            missed += a == 0 != b
    assert right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_chain_is_exact():
    """Viterbi and the likelihood against all paths of a small model."""
    import itertools

    import numpy as np

    r = np.random.default_rng(0)
    model = crf.Chain(r.normal(size=(crf.ROWS, 3)), r.normal(size=(3, 3)))
    tokens = r.integers(0, crf.ROWS, (5, 4))
    score = {}
    for path in itertools.product(range(3), repeat=5):
        full = (0, *path, 0)
        score[path] = sum(model.emission[tokens[i]].sum(0)[path[i]] for i in range(5)) + sum(
            model.transition[a, b] for a, b in zip(full, full[1:])
        )
    assert tuple(model.decode(tokens)) == max(score, key=score.get)
    node, _ = model._marginals(tokens[None])
    p = np.exp(np.array(list(score.values())))
    for i in range(5):
        want = sum(w for path, w in zip(score, p) if path[i] == 1) / p.sum()
        assert abs(node[0, i, 1] - want) < 1e-9


def test_message_passing_is_exact_on_trees():
    import itertools

    import numpy as np

    r = np.random.default_rng(0)
    s = r.normal(size=(3, 3))
    model = crf.SkipChain(r.normal(size=(crf.ROWS, 3)), r.normal(size=(3, 3)), s + s.T)
    nodes = r.integers(0, crf.ROWS, (4, 2))
    chain, skip = np.array([[0, 1], [2, 3]]), np.array([[1, 3]])
    got = np.exp(model.marginals(nodes, chain, skip, rounds=200, damping=0.0, settled=0))
    u = model.emission[nodes].sum(1)
    weight = {
        y: np.exp(
            sum(u[i, y[i]] for i in range(4))
            + sum(model.transition[y[a], y[b]] for a, b in chain)
            + sum(model.agreement[y[a], y[b]] for a, b in skip)
        )
        for y in itertools.product(range(3), repeat=4)
    }
    z = sum(weight.values())
    for i in range(4):
        for k in range(3):
            assert abs(got[i, k] - sum(w for y, w in weight.items() if y[i] == k) / z) < 1e-6


def _luhn(s):
    d = [int(c) for c in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def test_pii_query(spark, texts):
    got = {r["doc_id"]: r for r in rows(queries()["op9_pii"](spark, SF))}
    assert got.keys() == texts.keys()
    total = [0] * 4
    for d, t in texts.items():
        kinds = [
            [m for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
            [m for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) < 256 for p in m[0].split("."))],
            [
                m
                for m in re.finditer(r"[0-9]([ -]?[0-9])+", t)
                if 16 <= len(s := re.sub("[ -]", "", m[0])) <= 19 and _luhn(s)
            ],
            [m for m in re.finditer(r"\+[0-9][ ().0-9-]+[0-9]", t) if 8 <= len(re.findall("[0-9]", m[0])) <= 15],
        ]
        parts = [f"{k}:{m.start()}:{m.end()}" for k, ms in zip(pii.KINDS, kinds) for m in ms]
        r = got[d]
        assert r["base_sha256"] == _sha(parts)
        assert [r[f"n_{k}"] for k in pii.KINDS] == [len(ms) for ms in kinds]
        assert r["spans"].split(",")[: len(parts)] == (parts or [""])[: len(parts)]
        total = [a + len(ms) for a, ms in zip(total, kinds)]
    assert min(total) > 0


def test_distant_repeats_share_labels():
    model = pii.SkipChain.fit(*pii._merged(pii.made_up_graphs()), len(pii.TAGS))
    text = "call me at +1 (212) 555-7713 today. " + "nothing here " * 40 + "and 555-7713 again"
    (base, added), = pii.spans_of([text], model)
    assert [k for k, _, _ in base] == [3]
    assert [text[a:b] for k, a, b in added if k == 3] == ["555-7713"]
    assert pii.mask_text(text, base + added).count("[PHONE]") == 2


def test_license_query(spark, texts):
    got = {r["doc_id"]: r for r in rows(queries()["op4_license_scan"](spark, SF))}
    assert got.keys() == texts.keys()
    hits = 0
    for d, t in texts.items():
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = []
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        r = got[d]
        assert (r["n_words"], r["n_base"]) == (len(w), len(at))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in at}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
        assert ("gpl-3" in r["labels"]) == ("gnu general public license version 3" in " ".join(w))
        hits += len(at)
    assert hits


def test_containment_search_is_exact():
    """Prefix, length and position filters lose no run that meets the threshold."""
    r = random.Random(1)
    vocabulary = [f"t{i}" for i in range(12)]
    for _ in range(300):
        template = [r.choice(vocabulary) for _ in range(r.randint(1, 8))]
        words = [r.choice(vocabulary + ["z"] * 6) for _ in range(r.randint(0, 40))]
        counts = {w: r.randint(0, 9) for w in vocabulary}
        index = licenses.Index([("x", " ".join(template))], counts, 0.7, 0.25)
        tokens, run = set(template), index.templates[0][4]
        best = max((len(tokens & set(words[i : i + run])) / len(tokens) for i in range(len(words))), default=0)
        got = index.search(words).get(0, 0)
        assert got == (best if best >= index.templates[0][3] / len(tokens) else 0)


@pytest.mark.parametrize("operator", [secret_scan.scan, pii.scan, licenses.scan])
def test_defined_cases(spark, operator):
    df = spark.createDataFrame(EDGES, SCHEMA)
    got = rows(operator(df))
    assert sorted((r["doc_id"] or 0) for r in got) == sorted((e[0] or 0) for e in EDGES)
    assert all(not r.get("spans") and not r.get("labels") for r in got)
    assert operator(df.limit(0)).count() == 0


def test_mask_keeps_rows_and_columns(spark):
    df = spark.createDataFrame(EDGES + [(9, "mail x.y@mail1.example.com now", "a", "x")], SCHEMA)
    got = pii.masked(df)
    assert got.columns == df.columns and got.count() == df.count()
    by = {r["doc_id"]: r["text"] for r in rows(got)}
    assert by[9] == "mail [EMAIL] now" and by[1] is None and by[6] == EDGES[7][1]


@pytest.fixture(scope="module")
def made_up_field():
    return pii.SkipChain.fit(*pii._merged(pii.made_up_graphs()), len(pii.TAGS))


@pytest.mark.parametrize(
    "cue, bare, kind",
    [
        ("call me at +1 (212) 555-7713 today. ", "and 2125557713 again. ", "PHONE"),
        ("tel +1 (212) 555-7713 so ", "and 212-555-7713 so ", "PHONE"),
        ("mail a12@mailhost now ", "see a12@mailhost of ", "EMAIL"),
    ],
)
def test_many_occurrences_of_an_entity_cued_once(made_up_field, cue, bare, kind):
    """Cued in the first, a middle or the last place, each of a hundred places is labelled; never cued, none."""
    for cued in (None, 0, 50, 99):
        text = ("nothing here " * 5).join(cue if i == cued else bare for i in range(100))
        base, added = next(pii.spans_of([text], made_up_field))
        assert pii.mask_text(text, base + added).count(f"[{kind}]") == (0 if cued is None else 100)


@pytest.mark.parametrize(
    "one, two, alike",
    [
        ("4111 1111 1111 1111", "4111-1111-1111-1111", True),
        ("030 1234 5678", "030 1234 5678", True),
        ("+12125557713", "(212) 555-7713", True),
        ("+1 (212) 555-7713", "2125557713", True),
        ("(212) 555-7713", "555-7713", True),
        ("a@b.c", "A@b.c", True),
        ("10.0.0.1", "10.0.0.1", True),
        ("(212) 555-7713", "(415) 555-7714", False),
        ("(212) 555-7713", "(415) 555-7713", False),
    ],
)
def test_alike_entities_meet_in_a_hub(one, two, alike):
    text = f"x {one} and then {two} y"
    nodes, _, _, _, hubs = pii.linked(text)
    border = text.index("then")
    meet = {}
    for h, _, k, listens in hubs:
        if listens:
            meet.setdefault(h, set()).add(nodes[k][0] < border)
    assert any(len(s) == 2 for s in meet.values()) == alike


def test_a_hub_of_two_is_a_skip_edge(made_up_field):
    import numpy as np

    r = np.random.default_rng(0)
    nodes = r.integers(0, crf.ROWS, (4, 8))
    chain = np.array([[0, 1], [2, 3]])
    a = made_up_field.marginals(nodes, chain, np.array([[1, 3]]), settled=1e-9)
    b = made_up_field.marginals(nodes, chain, np.zeros((0, 2), int), settled=1e-9, hubs=[(0, 0, 1, 1), (0, 1, 3, 1)])
    assert np.abs(a - b).max() < 1e-6


def test_secrets_known_by_what_is_around_them():
    model = crf.Chain.fit(list(secret_scan.made_up_runs()), 3)
    for line, secret in (
        ("pwd = hunterTwoHunter", "hunterTwoHunter"),
        ("Bearer correct-horse-battery-staple", "correct-horse-battery-staple"),
        ("passphrase: correct horse battery staple", "correct horse battery staple"),
    ):
        text = f"some text here\n{line}\nand more of the text"
        assert [text[a:b] for a, b in secret_scan.method_spans(text, model)] == [secret]
    for plain in ("a state-of-the-art key point", "the key idea of the private garden", "on the getUserName page"):
        assert secret_scan.method_spans(plain, model) == []


def plain_spans(text, model):
    """Every token scored in full, the whole text decoded as one chain."""
    kind, out = secret_scan.file_features(text), []
    tokens = [m.span() for m in secret_scan.TOKEN.finditer(text)]
    tags = model.decode([secret_scan.token_features(text, a, b, kind) for a, b in tokens]) if tokens else []
    for (a, b), tag in zip(tokens, tags):
        if tag == secret_scan.INSIDE and out and not text[out[-1][1] : a].strip():
            out[-1] = (out[-1][0], b)
        elif tag:
            out.append((a, b))
    return out


def test_every_token_may_be_a_secret():
    """A plain word without a digit, a sign or a keyword near it is found where the model says so."""
    import numpy as np

    model = crf.Chain(np.zeros((crf.ROWS, 3)), np.zeros((3, 3)))
    model.emission[:, 0] = 1
    model.emission[crf.feature_rows((None,) * 5 + ("hor",))[5], 1] = 100
    for text in ("the horse runs", "horse", "a\nquiet (horse) here", "one, two horse"):
        a = text.index("horse")
        assert secret_scan.method_spans(text, model) == [(a, a + 5)]


def test_remembered_bounds_lose_nothing(texts):
    import numpy as np

    r, n = random.Random(6), np.random.default_rng(6)
    fitted = crf.Chain.fit(list(secret_scan.made_up_runs()), 3)
    wild = [crf.Chain(n.normal(-0.3 * s, s, (crf.ROWS, 3)) + [s, 0, 0], n.normal(0, 2, (3, 3))) for s in (0.3, 0.6, 1, 1.5)]
    pieces = [
        *["plain", "words", "and", "Words", "of", "text", "x", "aB3", "10.5", "key", "key:", "token", "=", "a=b", "pwd =", "--", "(", ")."],
        *['"quoted"', "end.", "end!?", "| cell |", "é", "«so»", "a,b,c", "1-2-3", "user:name", "x" * 60, "{", ";", "Bearer"],
    ]
    docs = [t or "" for t in texts.values()][:60]
    docs += ["".join(r.choice(pieces) + r.choice([" ", " ", " ", "\n", "  ", " " * 60, ""]) for _ in range(r.randint(0, 40))) for _ in range(150)]
    found = 0
    for model in [fitted, *wild]:
        scan = secret_scan.Scan(model)
        for text in docs:
            want = plain_spans(text[:3000], model)
            assert scan.spans(text[:3000]) == want, text
            found += len(want)
    assert found > 1000


def test_words_after_a_secret_are_none():
    model = crf.Chain.fit(list(secret_scan.made_up_runs()), 3)
    for line in ('pwd = "hT9xQ2mZp4Lk8Vb3Nw6Rt1Yc" next words of it', "Bearer ghp_0123456789abcdefABCDEF0123456789abcd and more"):
        assert [line[a:b] for a, b in secret_scan.method_spans(line, model)] == [max(re.findall(r"\w+", line), key=len)]
