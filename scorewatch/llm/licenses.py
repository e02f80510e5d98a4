"""License notices by an exact containment join between text blocks and templates.

Templates are token sets ordered by global frequency, rarest first (one counting pass over all documents, for the words
of the templates only). A block that holds at least `threshold` of a template must hold one of its first
`n - need + 1` tokens, so only places of those prefix tokens are looked at (prefix filter); blocks with too few words are
passed over (length filter); and a block whose first held prefix token is the k-th can hold at most `n - k` tokens
(positional filter). What is left is counted exactly.

A template's blocks are all runs of consecutive words as long as the template plus `slack`: every such run around a
prefix token is judged, so a notice is found wherever it stands and however it is broken into lines.

Defined cases: a null text is empty: no words, no labels, score 0; a block shorter than its template counts if it holds
enough of it; labels are distinct and sorted; repeated rows and null ids are rows of their own; an empty table gives no
rows. Only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, text_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# label -> notices; fixed wording of well-known licenses
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)
THRESHOLD = 0.9
# A run may be this share longer than its template: room for inserted words.
SLACK = 0.25

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
)


def token_counts(docs: DataFrame, vocabulary) -> dict[str, int]:
    """Occurrences in all documents of the templates' words: counted per batch, then summed; at most one row a word."""
    words = frozenset(vocabulary)

    def count(batches):
        for batch in batches:
            found = Counter()
            for text in batch["text"]:
                found.update(w for w in WORD.findall(text) if w in words)
            if found:
                yield pd.DataFrame({"word": list(found.keys()), "n": list(found.values())})

    rows = docs.select(lower_ascii(text_of()).alias("text")).mapInPandas(count, "word string, n long")
    return {r[0]: r[1] for r in rows.groupBy("word").agg(F.sum("n")).collect()}


class Index:
    """Prefix index of the templates; its size is bounded by them."""

    def __init__(self, templates, counts: dict[str, int], threshold: float, slack: float):
        self.templates = []
        self.prefix: dict[str, list[tuple[int, int]]] = {}
        for t, (label, text) in enumerate(templates):
            words = WORD.findall(text)
            tokens = sorted(set(words), key=lambda w: (counts.get(w, 0), w))
            need = math.ceil(threshold * len(tokens) - 1e-9)
            self.templates.append((label, frozenset(tokens), len(tokens), need, math.floor(len(words) * (1 + slack))))
            for k, w in enumerate(tokens[: len(tokens) - need + 1]):
                self.prefix.setdefault(w, []).append((t, k))

    def search(self, words: list[str]) -> dict[int, float]:
        """Template number -> best containment over all runs, for those that meet the threshold."""
        places: dict[int, list[tuple[int, int]]] = {}
        prefix = self.prefix
        for at, w in enumerate(words):
            if w in prefix:
                for t, k in prefix[w]:
                    places.setdefault(t, []).append((k, at))
        found: dict[int, float] = {}
        for t, spots in places.items():
            _, tokens, n, need, run = self.templates[t]
            best = 0
            if len(words) < need:
                continue
            done = set()
            for k, at in sorted(spots):
                if n - k < need or best == n:
                    break  # later tokens are commoner still: without those before, too few are left
                low, high = max(0, at - run + 1), min(len(words), at + run)
                if (low, high) in done:
                    continue
                done.add((low, high))
                best = max(best, self._best_run(words, tokens, low, high, run, need))
            if best >= need:
                found[t] = best / n
        return found

    @staticmethod
    def _best_run(words, tokens, low, high, run, need) -> int:
        held = [w if w in tokens else None for w in words[low:high]]
        if len(set(held) - {None}) < need:
            return 0
        inside: Counter = Counter()
        best = distinct = 0
        for i, w in enumerate(held):
            if w is not None:
                distinct += inside[w] == 0
                inside[w] += 1
            if i >= run and (old := held[i - run]) is not None:
                inside[old] -= 1
                distinct -= inside[old] == 0
            best = max(best, distinct)
        return best


def phrase_places(words: list[str], phrases) -> list[tuple[int, str]]:
    """(start word, label) wherever a phrase's words stand consecutively."""
    joined = f" {' '.join(words)} "
    out = []
    for phrase, label in phrases:
        target, at, counted, word = f" {phrase} ", -1, 0, 0
        while (at := joined.find(target, at + 1)) >= 0:
            word += joined.count(" ", counted, at)  # blanks since the last place: each is counted once
            counted = at
            out.append((word, label))
    return out


def scan(
    docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, slack: float = SLACK
) -> DataFrame:
    """One row per document: words, phrase places, labels and the best containment."""
    vocabulary = {w for _, text in templates for w in WORD.findall(text)}
    index = Index(templates, token_counts(docs, vocabulary), threshold, slack)

    def rows(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = WORD.findall(text)
                base = phrase_places(words, phrases)
                found = index.search(words)
                base_labels = {label for _, label in base}
                labels = base_labels | {index.templates[t][0] for t in found}
                starts = [at for at, _ in base]
                score = 1.0 if base else max(found.values(), default=0.0)
                out.append(
                    (
                        doc_id,
                        len(words),
                        len(base),
                        min(starts, default=None),
                        max(starts, default=None),
                        ",".join(sorted(base_labels)),
                        ",".join(sorted(labels)),
                        score,
                    )
                )
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])
            yield frame.astype({c: "Int64" for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")})

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lower_ascii(text_of()).alias("text"))
    return whole.mapInPandas(rows, SCHEMA)
