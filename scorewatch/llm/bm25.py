"""Benchmark decontamination: BM25 over an inverted index of test items, searched with block-max bounds.

The index holds test items; every passage of every training document is a query. A passage's score for an item is its
BM25 sum over the words they share, divided by the item's score for itself, so one threshold fits all items. Items stand
in blocks of `ITEM_BLOCK`; each word knows, per block, its largest share there. Passages overlap so that any run of words
as long as the longest item lies inside one of them.

A search goes through the passages of a batch of documents at once. Essential words first: an item's rarest words, such
that the others together stay below `REST` and below the threshold, so that no item reaches it without one of them; the largest essential shares of a passage's words in a block, plus what the
other words can add at most, bound every score in that block, and blocks that cannot reach the threshold are skipped.
In the blocks left all items are scored in full. Items at or above the threshold are verified on the document: the share
of the item's five-word shingles found there must reach `overlap`, and where an item asks a question (all sentences but the
last, ending in a question mark) and answers it (the last sentence, with the shingles that lead into it) each must have
`part` of its own found there: a question with another answer is no leak. Items without a question mark there are passages
and judged as a whole. An item or question under five words is one run of its own length, looked for
among all runs of so many words of the document.

Statistics (document frequencies, lengths) cover all items. The index is built in parts of at most `PART_WORDS` words of
test items, and every part is searched with all documents, so its memory does not grow with the number of items.

Defined cases: null and empty texts match nothing; a short item is found wherever its words stand in a row; items without
words are no items; a threshold of 0 or less is refused; equal item rows count once; items with equal texts are found each; repeated document rows are found each;
empty tables give no rows. Of the documents doc_id and text are read, of the items item_id and text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import WORD, discard, lower_ascii, stored, text_of
from .hashing import shingles, texts, word_hashes

K1, B = 1.2, 0.75
# Share of an item's own score at which it is retrieved, and of its shingles at which it counts as leaked.
SCORE, OVERLAP = 0.6, 0.75
# Share of its question's, and of its answer's, shingles that must be there besides.
PART = 0.5
REST = 0.3
ITEM_BLOCK = 16
PART_WORDS = 2_000_000
# Words held at once by a task, and index entries of their passages that are looked at together.
BATCH_WORDS = 1 << 18
BATCH_ENTRIES = 1 << 20
SHINGLE = 5
SENTENCE = re.compile(r"(?<=[.!?])\s+")


@dataclass
class Index:
    """Word hashes, sorted; per word its blocks with the largest essential share; per (word, block) its postings."""

    words: np.ndarray
    block_from: np.ndarray  # word -> first entry of `block`
    block: np.ndarray
    essential: np.ndarray  # largest essential share of the entry
    post_from: np.ndarray  # entry -> first posting
    item: np.ndarray
    share: np.ndarray
    rest: np.ndarray  # per block: what the words that are not essential add at most
    n_blocks: int
    item_ids: list
    longest: int
    questions: list  # (shingle hashes, words per shingle) per item
    answers: list
    asked: list  # whether the item is a question and its answer

    @classmethod
    def build(
        cls, items: list[tuple[object, str]], df: dict[int, int], n_items: int, mean_length: float, most_rest: float = REST
    ) -> Index:
        """items: (item_id, text); df: items that hold a word, by hash, over all items.

        most_rest: what the words that are not essential may add up to; at most the threshold of the searches.
        """
        rows, rest, questions, answers, asked, longest = [], [], [], [], [], 1
        for i, (_, text) in enumerate(items):
            hashes = word_hashes(np.frombuffer(text.encode(), np.uint8))
            longest = max(longest, len(hashes))
            q, a = question_and_answer(text)
            questions.append(q)
            answers.append(a)
            asked.append(is_asked(text))
            words, tf = np.unique(hashes, return_counts=True)
            n = np.array([df.get(int(w.view(np.int64)), 1) for w in words], dtype=float)
            idf = np.log(1 + (n_items - n + 0.5) / (n + 0.5))
            weight = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(hashes) / mean_length))
            share = weight / weight.sum()
            order = np.argsort(-share, kind="stable")
            left = 1 - np.cumsum(share[order])
            needed = int(np.argmax(left < most_rest)) + 1
            essential = np.zeros(len(words), bool)
            essential[order[:needed]] = True
            rest.append(share[~essential].sum())
            rows += list(zip(words.tolist(), [i] * len(words), share.tolist(), essential.tolist()))
        n_blocks = max(1, -(-len(items) // ITEM_BLOCK))
        block_rest = np.zeros(n_blocks)
        np.maximum.at(block_rest, np.arange(len(items)) // ITEM_BLOCK, np.array(rest, dtype=float))
        rows.sort()
        word = np.array([r[0] for r in rows], dtype=np.uint64)
        item = np.array([r[1] for r in rows], dtype=np.int64)
        share = np.array([r[2] for r in rows])
        top = np.where(np.array([r[3] for r in rows], dtype=bool), share, 0.0)
        block = item // ITEM_BLOCK
        new_word = np.concatenate([[True], word[1:] != word[:-1]]) if len(word) else np.zeros(0, bool)
        new_entry = new_word | (np.concatenate([[True], block[1:] != block[:-1]]) if len(word) else new_word)
        entry_at = np.flatnonzero(new_entry)
        return cls(
            word[new_word],
            np.concatenate([np.searchsorted(entry_at, np.flatnonzero(new_word)), [len(entry_at)]]),
            block[entry_at],
            np.maximum.reduceat(top, entry_at) if len(entry_at) else top,
            np.concatenate([entry_at, [len(word)]]),
            item,
            share,
            block_rest,
            n_blocks,
            [i for i, _ in items],
            longest,
            questions,
            answers,
            asked,
        )

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers of the index, -1 for others."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, at, -1)

    def search(self, passage: np.ndarray, word: np.ndarray, n_passages: int, threshold: float):
        """(passage, item, score) at or above the threshold; input: distinct (passage, word) pairs, by passage."""
        entries, source = _ranges(self.block_from, word)
        useful = self.essential[entries] > 0
        cell = passage[source[useful]] * self.n_blocks + self.block[entries[useful]]
        cells, inverse = np.unique(cell, return_inverse=True)
        bound = np.bincount(inverse, weights=self.essential[entries[useful]], minlength=len(cells))
        alive = cells[bound + self.rest[cells % self.n_blocks] >= threshold - 1e-9]
        if not len(alive):
            return np.zeros((0,), int), np.zeros((0,), int), np.zeros(0)
        held = passage[source] * self.n_blocks + self.block[entries]
        at = np.minimum(np.searchsorted(alive, held), len(alive) - 1)
        entries, source = entries[alive[at] == held], source[alive[at] == held]
        posts, of = _ranges(self.post_from, entries)
        n_items = len(self.item_ids)
        pair, inverse = np.unique(passage[source[of]] * n_items + self.item[posts], return_inverse=True)
        score = np.bincount(inverse, weights=self.share[posts], minlength=len(pair))
        hit = score >= threshold - 1e-9
        return pair[hit] // n_items, pair[hit] % n_items, score[hit]


def _slices(index: Index, passage: np.ndarray, word: np.ndarray):
    """Runs of whole passages with at most BATCH_ENTRIES entries of the index, or one passage."""
    ends = np.cumsum(index.block_from[word + 1] - index.block_from[word])
    start = 0
    while start < len(passage):
        stop = int(np.searchsorted(ends, BATCH_ENTRIES + (ends[start - 1] if start else 0), side="right"))
        if stop < len(passage):
            whole = int(np.searchsorted(passage, passage[stop]))
            stop = whole if whole > start else int(np.searchsorted(passage, passage[start], side="right"))
        yield slice(start, stop)
        start = stop


def _ranges(starts: np.ndarray, rows: np.ndarray):
    """All positions starts[r] .. starts[r + 1] - 1 for each r of rows, and the number of the row each is of."""
    size = starts[rows + 1] - starts[rows]
    source = np.repeat(np.arange(len(rows)), size)
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + starts[rows][source], source


def is_asked(text: str) -> bool:
    """Whether the sentence before the last one ends in a question mark."""
    parts = SENTENCE.split(text.strip())
    return len(parts) > 1 and parts[-2].endswith("?")


def question_and_answer(text: str):
    """(shingle hashes, words per shingle) of an item's question, and of the shingles that hold a word of its answer."""
    parts = SENTENCE.split(text.strip())
    hashes = word_hashes(np.frombuffer(text.encode(), np.uint8))
    before = len(word_hashes(np.frombuffer(" ".join(parts[:-1]).encode(), np.uint8)))
    question = shingles(hashes[:before]) if before else np.zeros(0, np.uint64)
    answer = np.setdiff1d(shingles(hashes), question, assume_unique=True)
    return (question, min(SHINGLE, before)), (answer, min(SHINGLE, len(hashes)))


def passages_of(words: np.ndarray, longest: int):
    """Distinct (passage, word) pairs of one document's word numbers (-1: unknown), and the number of passages.

    Passages have `longest + stride` words and start every `stride` words.
    """
    stride = max(8, longest // 2)
    n = max(1, -(-max(0, len(words) - longest) // stride))
    at = np.flatnonzero(words >= 0)
    last = np.minimum(at // stride, n - 1)
    first = np.minimum(np.maximum(0, -(-(at - longest - stride + 1) // stride)), last)
    size = last - first + 1
    ends = np.cumsum(size)
    passage = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size) + np.repeat(first, size)
    return passage, np.repeat(words[at], size), n


def _found(batch_texts, index: Index, score: float, overlap: float, part: float):
    """Rows (text number, item number, score, overlap, question overlap, answer overlap, passages) of leaked items."""
    held, pending, n_pending = [], 0, 0

    def flush():
        nonlocal held, pending, n_pending
        if not held:
            return
        offsets, pairs, total = [], [], 0
        for _, hashes, numbers in held:
            passage, word, n = passages_of(numbers, index.longest)
            offsets.append(total)
            pairs.append((passage + total, word))
            total += n
        passage, word = (np.concatenate(c) for c in zip(*pairs))
        pair = np.unique(passage * len(index.words) + word)
        passage, word = pair // len(index.words), pair % len(index.words)
        parts = [index.search(passage[s], word[s], total, score) for s in _slices(index, passage, word)]
        passage, item, value = (np.concatenate(c) for c in zip(*parts))
        owner = np.searchsorted(offsets, passage, side="right") - 1
        best: dict[tuple[int, int], list] = {}
        for o, i, v in zip(owner.tolist(), item.tolist(), value.tolist()):
            seen = best.setdefault((o, i), [0.0, 0])
            seen[0] = max(seen[0], v)
            seen[1] += 1
        sets: dict[tuple[int, int], np.ndarray] = {}
        for (o, i), (v, times) in sorted(best.items()):
            number, hashes, _ = held[o]
            there, total, shares = 0, 0, []
            for names, size in (index.questions[i], index.answers[i]):
                if len(names) and (o, size) not in sets:
                    sets[o, size] = shingles(hashes, size)
                n = int(np.isin(names, sets[o, size]).sum()) if len(names) else 0
                there, total = there + n, total + len(names)
                shares.append(n / len(names) if len(names) else None)
            if there >= overlap * total and (not index.asked[i] or all(s is None or s >= part for s in shares)):
                yield number, i, v, there / total, *shares, times
        held, pending, n_pending = [], 0, n_pending + 1

    for number, text in enumerate(batch_texts):
        hashes = word_hashes(text)
        numbers = index.numbered(hashes)
        if len(hashes) and (numbers >= 0).any():
            held.append((number, hashes, numbers))
            pending += len(hashes)
            if pending >= BATCH_WORDS:
                yield from flush()
    yield from flush()


FOUND = "doc_id long, item_id long, score double, overlap double, question_overlap double, answer_overlap double, n_passages long"


def indexes(items: DataFrame, part_words: int = PART_WORDS, score: float = SCORE):
    """The index in parts, one at a time, for searches at a threshold of `score` or more."""
    if score <= 0:
        raise ValueError("the threshold must be above 0")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).distinct()
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(f"({WORD})"), F.lit(1))
    rows = stored(rows.withColumn("n_words", F.size(words).cast("long")).where("n_words > 0"), "items")
    n_items, n_words = rows.agg(F.count("*"), F.coalesce(F.sum("n_words"), F.lit(0))).first()
    if not n_items:
        return

    def distinct_words(batches):
        with np.errstate(over="ignore"):
            for batch in batches:
                out = []
                for item, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                    out.append((np.unique(word_hashes(text)).view(np.int64), item))
                if out:
                    counts = [len(h) for h, _ in out]
                    part = np.repeat([p for _, p in out], counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate([h for h, _ in out]), pa.int64()), pa.array(part, pa.int32())], ["word", "part"]
                    )

    n_parts = int(n_words // part_words) + 1
    part = F.pmod(F.xxhash64("text", "item_id"), F.lit(n_parts)).cast("int").alias("part")
    whole, rows = rows, stored(rows.select("item_id", "text", part), "parts")
    discard(whole)
    held = rows.select("part", "text").mapInArrow(distinct_words, "word long, part int")
    held = stored(held, "held")
    counts = held.groupBy("word").agg(F.count("*").alias("n"))
    for p in range(n_parts):
        own = held.where(F.col("part") == p).select("word").distinct()
        df = {r[0]: r[1] for r in counts.join(own, "word", "left_semi").collect()}  # words of one part
        found = rows.where(F.col("part") == p).select("item_id", "text").orderBy("item_id", "text").collect()
        if found:
            with np.errstate(over="ignore"):
                yield Index.build([(r[0], r[1]) for r in found], df, n_items, n_words / n_items, min(REST, score))
    discard(rows)
    discard(held)


def _shared(docs: DataFrame, index: Index):
    """The index as plain arrays, bounded by `part_words`: a broadcast is read where this package need not be."""
    return docs.sparkSession.sparkContext.broadcast(vars(index))


def leaks(
    docs: DataFrame,
    items: DataFrame,
    score: float = SCORE,
    overlap: float = OVERLAP,
    part_words: int = PART_WORDS,
    part: float = PART,
):
    """One row per document and item that it holds: retrieved at `score`, verified at `overlap` and `part`. No shuffle."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for index in indexes(items, part_words, score):
        shared = _shared(docs, index)

        def scan(batches, shared=shared):
            index = Index(**shared.value)
            with np.errstate(over="ignore"):
                for batch in batches:
                    found = list(_found(texts(batch.column(1)), index, score, overlap, part))
                    if found:
                        ids = batch.column(0).take(pa.array([f[0] for f in found]))
                        items = pa.array([index.item_ids[f[1]] for f in found], pa.int64())
                        rest = [pa.array(c, pa.float64()) for c in list(zip(*found))[2:6]]
                        times = pa.array([f[6] for f in found], pa.int64())
                        names = [c.split()[0] for c in FOUND.split(", ")]
                        yield pa.RecordBatch.from_arrays([ids, items, *rest, times], names)

        more = rows.mapInArrow(scan, FOUND)
        out = more if out is None else out.unionByName(more)
    return spark.createDataFrame([], FOUND) if out is None else out


def _leaked(shared, score: float, overlap: float, part: float):
    @F.pandas_udf(T.BooleanType())
    def leaked(column: pd.Series) -> pd.Series:
        with np.errstate(over="ignore"):
            views = (np.frombuffer((t if isinstance(t, str) else "").encode(), np.uint8) for t in column)
            hit = {f[0] for f in _found(views, Index(**shared.value), score, overlap, part)}
        return pd.Series([i in hit for i in range(len(column))], dtype=bool)

    return leaked


def decontaminated(
    docs: DataFrame, items: DataFrame, score: float = SCORE, overlap: float = OVERLAP, part: float = PART
) -> DataFrame:
    """The documents that hold no test item, in their own columns. A filter: no shuffle, no join."""
    for index in indexes(items, score=score):
        docs = docs.where(~_leaked(_shared(docs, index), score, overlap, part)("text"))
    return docs
