import re

from helpers import SF, brute_components, rows, shingle_set, table, words

import corpus_pipeline
from scorewatch.llm import pii
from scorewatch.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def brute_quality(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, cover = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover.update(x for i in at for x in range(i, i + 8))
    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    n, chars = len(w), sum(map(len, w))
    return not (
        n < 20
        or 100 * len(cover) > 30 * n
        or 10 * len(re.findall(r"[#*$%&|<>]", text)) > n
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or not 2 * n <= chars <= 15 * n
        or 10 * len(re.findall("!!", text)) > n
    )


def test_run_against_brute_force(spark, monkeypatch):
    """One run; what each stage got and gave is compared with plain definitions."""
    seen = []

    def watched(name, stage):
        def call(session, docs, folder):
            out = stored(stage(session, docs, folder), name)
            seen.append((name, rows(docs), rows(out)))
            return out

        return name, call

    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_duplicates", "decontamination", "personal_data", "mixing_sources"
    ]
    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    last = rows(corpus_pipeline.run(spark, SF))
    items = [shingle_set(r["text"]) for r in table("benchmark")]
    for name, before, after in seen:
        given = {r["doc_id"]: r["text"] for r in before}
        have = {r["doc_id"]: r["text"] for r in after}
        assert len(have) == len(after) and have
        if name == "quality_rules":
            want = {d: t for d, t in given.items() if brute_quality(t)}
        elif name == "near_duplicates":
            root, _ = brute_components(given.items())
            want = {d: t for d, t in given.items() if root[d] == d}
        elif name == "decontamination":
            want = {d: t for d, t in given.items() if not any(len(s & shingle_set(t)) >= 0.75 * len(s) for s in items)}
        elif name == "personal_data":
            assert have.keys() == given.keys()
            assert not any(pii.base_spans(t) for t in have.values())
            assert all(have[d] == t for d, t in given.items() if not re.search("[0-9@]", t))
            want = have
        else:
            total = sum(len(words(t)) for t in given.values())
            assert abs(sum(r["taken"] for r in after) - total) <= len(given)
            assert all(0 < r["taken"] <= 3 * r["size"] for r in after)
            assert have.items() <= given.items() and len(last) == len(after)
            continue
        assert have == want, name
        assert list(after[0]) == COLUMNS
