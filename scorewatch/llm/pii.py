"""Personal data by a skip-chain conditional random field, next to fixed patterns.

Nodes are the pieces of a text that hold a digit or an @ (others are outside by constraint, which splits the field
exactly). Neighbouring nodes share a transition potential. Occurrences of an equal or similar entity anywhere in a document
meet in one hub per likeness: the same digits, over neighbouring digit groups too ('4111 1111 1111 1111'), the same last
10 of more digits ('+12125557713', '(212) 555-7713'), the same letters and digits, or the same short address. Every
occurrence gets an agreement message from the most clearly recognised other one, however many there are and however far
away. Loopy sum-product messages over all documents of a batch settle the labels, so an entity recognised in one place
is recognised in its other places.

The field is fitted by pseudo-likelihood on a bounded sample of documents (`sample`, the smallest hashes of doc_id, and at
most `sample_nodes` nodes), labelled by the patterns, with seeded made-up sentences; the driver gets feature rows, never
texts.

Defined cases: a null or empty text has no spans and stays as it is when masked; very long texts are scanned whole;
repeated rows and null ids are rows of their own; an empty table gives no rows; without any sample the made-up sentences
alone fit the field. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Covered, text_of
from .crf import SkipChain, feature_rows

KINDS = ("email", "ip", "card", "phone")
# Possessive and anchored at the start of a run, so that no place is looked at again and again: the same matches.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TAGS = ("outside", *KINDS)
ADDED = tuple(f"crf-{k}" for k in KINDS)
# A node is labelled only if its belief reaches this.
CERTAIN = 0.8
SAMPLE = 4000
SAMPLE_NODES = 20_000
# Documents whose graphs are solved together: bounds the message arrays, not the result.
BATCH_NODES = 50_000

ANCHOR = re.compile(r"[0-9@]")
EDGES = ".,;:!?\"'*#$%&|<>[]{}="


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses: every @, extended to both sides."""
    out, low, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > low and text[begin - 1] in LOCAL:
            begin -= 1
        m = DOMAIN.match(text, at + 1) if begin < at else None
        if m is not None:
            out.append((begin, m.end()))
        low = m.end() if m is not None else at + 1
        at = text.find("@", low)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    out = [(0, a, b) for a, b in emails(text)]
    if ANCHOR.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
                out.append((1, *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((3, *m.span()))
    return out


def nodes_of(text: str) -> list[tuple[int, int]]:
    """Pieces between blanks that hold a digit or @, without signs at their edges."""
    out, at, end = [], 0, len(text)
    while m := ANCHOR.search(text, at):
        begin, stop = m.start(), m.end()
        while begin > at and not text[begin - 1].isspace():
            begin -= 1
        while stop < end and not text[stop].isspace():
            stop += 1
        at = stop
        while begin < stop and text[begin] in EDGES:
            begin += 1
        while stop > begin and text[stop - 1] in EDGES:
            stop -= 1
        out.append((begin, stop))
    return out


CUES = re.compile(r"(?i)(phone|tel|call|mobile|fax)|(mail|contact|write)|(card|visa|account|credit)|(ip|host|server|addr)")


def node_features(text: str, start: int, end: int) -> list[int]:
    piece = text[start:end]
    digits = "".join(c for c in piece if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in piece)
    shape = re.sub("[^\\W\\d_]+", "a", re.sub("[0-9]+", lambda m: "0" * min(len(m[0]), 5), piece[:80]))[:24]
    cue = CUES.search(text[max(0, start - 24) : start])
    return feature_rows(
        (
            shape,
            min(len(digits), 24),
            f"{piece.count('.')}:{letters > 0}",
            f"{'@' in piece}:{'.' in piece.rpartition('@')[2]}",
            16 <= len(digits) <= 19 and not letters and luhn(digits),
            f"{piece[:1] if piece[:1] in '+(' else 'x'}:{')' in piece}",
            cue.lastindex if cue else 0,
            piece.count(".") == 3 and all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) < 256 for p in piece.split(".")),
        )
    )


GROUP = re.compile(r"[+(]*[0-9][0-9()+/.-]*")


def _likeness(piece: str) -> str | None:
    """What equal or similar pieces without enough digits have in common; short pieces but addresses are like nothing."""
    key = "".join(c for c in piece.lower() if c.isalnum())
    if len(key) >= 6:
        return key
    return piece.lower() if "@" in piece or piece.count(".") == 3 else None


def _digits(piece: str) -> str:
    return "".join(c for c in piece if "0" <= c <= "9")


def _occurrences(pieces: list[str], joined: set[int]) -> dict[str, list[tuple[int, int, str | None]]]:
    """Likeness key -> its occurrences (first node, last node, last 10 digits if it has so many with its neighbours).

    Digits are compared over 7 to 19 of them in whole neighbouring groups: as they are, and by the last 10.
    """
    found: dict[str, list[tuple[int, int, str | None]]] = {}
    for j, piece in enumerate(pieces):
        digits, i, keys = _digits(piece), j, {}
        if len(digits) < 7:
            key = _likeness(piece)
            if key is not None:
                keys["a" + key] = j
        ten = None
        while len(digits) <= 19 or i == j:
            if len(digits) >= 7:
                keys.setdefault(digits, i)
            if len(digits) >= 10 and ten is None:
                ten = digits[-10:]
                keys.setdefault(ten, i)
            if i not in joined or not GROUP.fullmatch(pieces[i]) or not GROUP.fullmatch(pieces[i - 1]):
                break
            i -= 1
            digits = _digits(pieces[i]) + digits
        for key, i in keys.items():
            mine = found.setdefault(key, [])
            if not mine or mine[-1][1] < i:  # occurrences do not overlap
                mine.append((i, j, ten))
    return {k: v for k, v in found.items() if len(v) > 1}


def _hubs(found) -> list[tuple[int, int, int, int]]:
    """(hub, occurrence, node, listens). Of a short number that ends several longer ones these only speak."""
    out, occurrence = [], 0
    for hub, (key, places) in enumerate(found.items()):
        longer = {ten for _, _, ten in places if ten is not None} if key.isdigit() and len(key) < 10 else set()
        for i, j, ten in places:
            out += [(hub, occurrence, k, int(len(longer) < 2 or ten is None)) for k in range(i, j + 1)]
            occurrence += 1
    return out


def linked(text: str):
    """(nodes, feature rows, chain edges, skip edges, hubs) of one document; edges as pairs of node numbers.

    Skip edges lead from one occurrence to the next: what the agreement is fitted on.
    """
    nodes = nodes_of(text)
    rows = [node_features(text, a, b) for a, b in nodes]
    chain = [
        (i - 1, i)
        for i in range(1, len(nodes))
        if nodes[i][0] - nodes[i - 1][1] <= 2 and "\n" not in text[nodes[i - 1][1] : nodes[i][0]]
    ]
    near = set(chain)
    found = _occurrences([text[a:b] for a, b in nodes], {b for _, b in chain})
    skip = {(p[1], q[1]) for places in found.values() for p, q in zip(places, places[1:])} - near
    return nodes, rows, chain, sorted(skip), _hubs(found)


def graph(text: str):
    """(nodes, feature rows, chain edges, skip edges) of one document."""
    return linked(text)[:4]


def tagged_graph(text: str):
    nodes, rows, chain, skip = graph(text)
    spans = base_spans(text)
    kinds = [Covered((x, y) for n, x, y in spans if n == k) for k in range(len(KINDS))]
    tags = [next((k + 1 for k, c in enumerate(kinds) if c.meets(a, b)), 0) for a, b in nodes]
    return rows, tags, chain, skip


def made_up(seed: int = 5, n: int = 400):
    """Seeded sentences: personal data as the patterns know it and otherwise, and harmless numbers."""
    r = random.Random(seed)
    d = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    for _ in range(n):
        area = f"({d(3)}) 555-{d(4)}"
        yield f"and +1 {area} the {r.choice(('phone', 'tel', 'call'))} {area} of ", (4, 4, 4, 4, 4)
        name = f"{r.choice('abcdefgh')}{d(2)}"
        yield f"mail {name}@mail{d(1)}.example.com or contact {name}@localhost now ", (1, 1)
        yield f"server {'.'.join(str(r.randint(0, 255)) for _ in range(4))} at {d(2)} with {d(1)}.{d(1)}.{d(1)} ", (2, 0, 0)
        yield f"in {r.randint(1900, 2030)} the {d(5)} and {d(16)} of {d(9)} ", None
        # an entity cued once and found again in another form; the same forms alone or harmless in both places
        bare, harmless = d(10), d(10)
        yield f"call (+1 {bare[:3]}) {bare[3:6]}-{bare[6:]} today, and then {bare} of ", (4, 4, 4, 4)
        yield f"and {r.choice(('', '+1'))}{bare} is the {r.choice(('phone', 'tel', 'call'))} ({bare[:3]}) {bare[3:6]}-{bare[6:]} ", (4, 4, 4)
        yield f"the {harmless} and {d(10)} of {harmless} in {harmless} ", (0, 0, 0, 0)
        handle = f"{r.choice('abcdefgh')}{d(2)}@{r.choice(('mailhost', 'intranet', 'office'))}"
        yield f"contact {handle} now, then see {handle} of ", (1, 1)
        yield f"write {handle} of the ", (1,)
        yield f"see {handle} of the ", (0,)


def made_up_graphs(seed: int = 5):
    for text, wanted in made_up(seed):
        rows, tags, chain, skip = tagged_graph(text)
        if wanted and len(wanted) == len(tags):
            tags = list(wanted)
        yield rows, tags, chain, skip


def _merged(graphs):
    """Several graphs as one: stacked rows, tags and edges with shifted numbers."""
    rows, tags, chain, skip = [], [], [], []
    for r, t, c, s in graphs:
        k = len(rows)
        rows += r
        tags += t
        chain += [(a + k, b + k) for a, b in c]
        skip += [(a + k, b + k) for a, b in s]
    pairs = lambda e: np.array(e, dtype=int).reshape(-1, 2)
    return np.array(rows, dtype=int).reshape(len(rows), -1), np.array(tags, dtype=int), pairs(chain), pairs(skip)


def fit(docs: DataFrame, sample: int = SAMPLE, sample_nodes: int = SAMPLE_NODES) -> SkipChain:
    """The field from at most `sample` documents; graphs are taken in order of hash until `sample_nodes` nodes."""
    order = F.xxhash64(F.lit("pii sample"), "doc_id")
    chosen = docs.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(order, "doc_id").limit(sample)
    texts = docs.join(F.broadcast(chosen), "doc_id", "left_semi").select(text_of().alias("text"))

    def extract(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                rows, tags, chain, skip = tagged_graph(text)
                if 0 < len(rows) <= sample_nodes // 100:  # no one document rules the sample
                    flat = [[x for e in edges for x in e] for edges in (chain, skip)]
                    out.append(([x for r in rows for x in r], tags, *flat))
            if out:
                yield pd.DataFrame(out, columns=["rows", "tags", "chain", "skip"])

    found = texts.mapInPandas(extract, "rows array<int>, tags array<int>, chain array<int>, skip array<int>")
    graphs, taken = list(made_up_graphs()), 0
    key = F.xxhash64("rows", "tags")
    for flat, tags, chain, skip in found.orderBy(key, "rows", "tags").limit(sample).collect():
        taken += len(tags)
        if taken > sample_nodes:
            break
        width = len(flat) // len(tags)
        pairs = lambda e: list(zip(e[::2], e[1::2]))
        graphs.append(([flat[i : i + width] for i in range(0, len(flat), width)], list(tags), pairs(chain), pairs(skip)))
    return SkipChain.fit(*_merged(graphs), len(TAGS))


def method_labels(texts: list[str], model: SkipChain) -> list[list[tuple[int, int, int]]]:
    """Per text its labelled nodes (kind number, start, end), neighbours of one kind joined."""
    graphs = [linked(t) for t in texts]
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    at = 0
    while at < len(graphs):
        stop, size = at, 0
        while stop < len(graphs) and (stop == at or size + len(graphs[stop][0]) <= BATCH_NODES):
            size += len(graphs[stop][0])
            stop += 1
        if size:
            part = graphs[at:stop]
            rows, graph_of, chain, _ = _merged((r, [i] * len(r), c, []) for i, (_, r, c, _, _) in enumerate(part))
            hubs, n, m = [], 0, 0
            for nodes, _, _, _, own in part:
                hubs += [(h + m, o + m, k + n, w) for h, o, k, w in own]
                n, m = n + len(nodes), m + 1 + max((o for _, o, _, _ in own), default=0)
            belief = model.marginals(rows, chain, np.zeros((0, 2), int), hubs=hubs, graph_of=graph_of)
            best = belief.argmax(1)
            sure = belief.max(1) >= np.log(CERTAIN)
            k = 0
            for i, (nodes, _, near, _, _) in enumerate(part, at):
                follows = {b for _, b in near}
                for j, (a, b) in enumerate(nodes):
                    tag = int(best[k + j]) if sure[k + j] else 0
                    if tag:
                        mine = out[i]
                        if j in follows and mine and mine[-1][0] == tag - 1 and mine[-1][2] == nodes[j - 1][1]:
                            mine[-1] = (tag - 1, mine[-1][1], b)
                        else:
                            mine.append((tag - 1, a, b))
                k += len(nodes)
        at = stop
    return out


def spans_of(texts: list[str], model: SkipChain):
    """Per text (base spans, added spans), each (kind number, start, end) by kind, then start."""
    for text, labelled in zip(texts, method_labels(texts, model)):
        base = base_spans(text)
        known = Covered((a, b) for _, a, b in base)
        yield base, sorted(s for s in labelled if not known.meets(s[1], s[2]))


def joined(base, added=()) -> str:
    return ",".join([f"{KINDS[k]}:{a}:{b}" for k, a, b in base] + [f"{ADDED[k]}:{a}:{b}" for k, a, b in added])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def scan(docs: DataFrame, model: SkipChain | None = None) -> DataFrame:
    """One row per document: pattern counts and digest, and all spans. One pass, no shuffle."""
    model = model or fit(docs)

    def rows(batches):
        for batch in batches:
            out = []
            for doc_id, (base, added) in zip(batch["doc_id"], spans_of(list(batch["text"]), model)):
                counts = [sum(k == n for k, _, _ in base) for n in range(4)]
                out.append((doc_id, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(base, added)))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")]).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(rows, SCHEMA)


def mask_text(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named by the first."""
    out, at = [], 0
    merged: list[list[int]] = []
    for a, b, k in sorted((a, b, k) for k, a, b in spans):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b, k])
    for a, b, k in merged:
        out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = b
    return "".join(out) + text[at:]


def masked(docs: DataFrame, model: SkipChain | None = None) -> DataFrame:
    """The documents in their own columns with personal data masked in `text`; n_chars, where there, follows it."""
    model = model or fit(docs)

    @F.pandas_udf(T.StringType())
    def hide(texts: pd.Series) -> pd.Series:
        known = [t if isinstance(t, str) else "" for t in texts]
        new = [mask_text(t, b + a) for t, (b, a) in zip(known, spans_of(known, model))]
        return pd.Series([n if isinstance(t, str) else None for t, n in zip(texts, new)], dtype=object)

    out = docs.withColumn("text", hide("text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
