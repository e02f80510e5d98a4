"""Periodic runs of words by descending-LCP Kruskal.

The suffixes of a text that agree on their first L words form a class. Classes grow as L falls: neighbours in the suffix
array are united by decreasing LCP, with union-find, and every class keeps its positions in order (the smaller one is
merged into the larger). Two positions i < j that become neighbours in a class at LCP = L while j - i <= L seed a run: the
words from i to j + L have period j - i, and it is their smallest (a smaller one would have put another position of the
class between them before). A run's first pair has the run's end at j + L, so the seeds whose pair cannot be extended to
the left are the runs, each once.

A run of `times` periods and `least` words needs an LCP of at least `least * (times - 1) / times`: unions below it are never
made, and a text without two equal stretches of that many words has no run at all. Equal stretches are found by hash, then
ranked exactly by doubling, so a collision costs time but changes nothing.

Texts are searched one by one inside Arrow functions: no shuffle, and a task's memory is bounded by its largest text.

Defined cases: a null or empty text has no words, no runs, and the digests of the empty string; very long texts are
searched whole; repeated rows and null ids are rows of their own (a null id is never planted); an empty table gives no
rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A run has at least so many words, and at least so many periods.
LEAST, TIMES = 24, 3

SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string,"
    " collapsed_sha256 string"
)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def numbered(words: list) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict = {}
    return np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)


def _repeats(ids: np.ndarray, width: int) -> bool:
    """Whether two stretches of `width` words may be equal: no is certain."""
    if len(ids) <= width:
        return False
    # the hash of a stretch of two halves: those of `have` words, then of the last ones needed
    h, have = ids.astype(np.uint64) + np.uint64(1), 1
    with np.errstate(over="ignore"):
        while have < width:
            step = min(have, width - have)
            h = (h[: len(h) - step] * _STEP) ^ (h[step:] + (h[step:] >> np.uint64(31)))
            h ^= h >> np.uint64(29)
            have += step
    h.sort()
    return bool((h[1:] == h[:-1]).any())


def suffix_array(ids: np.ndarray):
    """(suffixes in order, LCP of each with the next) by prefix doubling; ranks of every round give the LCPs."""
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    ranks, width = [rank], 1
    while width < n and rank.max() < n - 1:
        later = np.zeros(n, np.int64)
        later[: n - width] = rank[width:] + 1
        rank = np.unique(rank * (n + 1) + later, return_inverse=True)[1].astype(np.int64)
        ranks.append(rank.astype(np.int32))
        width *= 2
    order = np.argsort(rank, kind="stable")
    a, b = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(max(0, n - 1), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[ranks[k][a[inside]] == ranks[k][b[inside]]]
        for x in (lcp, a, b):
            x[same] += 1 << k
    return order, lcp


def _adjacent(small: list[int], large: list[int]):
    """Neighbours (i, j) in the union of two ordered sets that were not neighbours in either."""
    last = len(small) - 1
    for k, x in enumerate(small):
        at = bisect_left(large, x)
        if at and (not k or small[k - 1] < large[at - 1]):
            yield large[at - 1], x
        if at < len(large) and (k == last or small[k + 1] > large[at]):
            yield x, large[at]


def runs_of(ids: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    lowest = -(-least * (times - 1) // times)
    if not _repeats(ids, lowest):
        return []
    order, lcp = suffix_array(ids)
    edges = np.flatnonzero(lcp >= lowest)
    edges = edges[np.argsort(-lcp[edges], kind="stable")]
    words = ids.tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def top(e: int) -> int:
        root = e
        while (up := parent.get(root, root)) != root:
            root = up
        while parent.get(e, e) != root:
            parent[e], e = root, parent[e]
        return root

    found = []
    for e, height in zip(edges.tolist(), lcp[edges].tolist()):
        a, b = top(e), top(e + 1)
        large = members.pop(a, None) or [int(order[a])]
        small = members.pop(b, None) or [int(order[b])]
        if len(small) > len(large):
            a, b, large, small = b, a, small, large
        for i, j in _adjacent(small, large):
            q = j - i
            if q * (times - 1) <= height and q + height >= least and (not i or words[i - 1] != words[j - 1]):
                found.append((i, q + height, q))
        if len(small) * 32 < len(large):
            for x in small:
                insort(large, x)
        else:
            large.extend(small)
            large.sort()  # two ordered stretches: merged in one pass
        parent[b] = a
        members[a] = large
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs):
    """The run with the greatest length / period, compared exactly; of equals the first, then the shortest period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def collapsed(words: list, runs) -> list:
    """The words without those that a run repeats: of every run its first period stays, unless another run drops it."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    kept = np.cumsum(depth[:-1]) == 0
    return [w for w, keep in zip(words, kept.tolist()) if keep]


def planted(doc_id: int | None, words: list) -> list:
    """One document in ten, by the checksum of its id, continues periodically from some word on: runs that are known."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(docs: DataFrame, prepare=None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per document: its number of runs, its strongest run, and digests of all runs and of the collapsed words.

    prepare: a function of doc_id and the list of words (bytes) that gives the words to search.
    """

    def rows(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                if prepare is not None:
                    words = prepare(doc_id, words)
                runs = runs_of(numbered(words), least, times)
                best = strongest(runs)
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                out.append(
                    (
                        doc_id,
                        len(runs),
                        *(best or (None, None, None)),
                        best and 1000 * best[1] // best[2],
                        hashlib.sha256(listed.encode()).hexdigest(),
                        hashlib.sha256(b" ".join(collapsed(words, runs))).hexdigest(),
                    )
                )
            fields = [c.split() for c in SCHEMA.split(", ")]
            kinds = {"long": pa.int64(), "string": pa.string()}
            columns = list(zip(*out)) if out else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)], [n for n, _ in fields]
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SCHEMA)


def collapsed_documents(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """The documents in their own columns, with the words of `text` collapsed and joined by one space (null stays null).

    A text without runs stays as it is, its white space too.
    """

    @F.udf("string", useArrow=True)
    def collapse(text):
        words = text.encode("utf-8", "surrogatepass").split() if text else []
        runs = runs_of(numbered(words), least, times)
        return b" ".join(collapsed(words, runs)).decode("utf-8", "surrogatepass") if runs else text

    return docs.withColumn("text", collapse("text"))
