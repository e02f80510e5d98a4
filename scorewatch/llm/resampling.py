"""Importance resampling towards a target distribution of hashed word n-grams.

Features are runs of 1 to `longest` consecutive words. Their buckets are counted over the whole corpus and over the target
texts; a bucket's gain is the log ratio of the smoothed shares, a document's weight the sum of the gains of its features,
and the documents with the highest weight plus seeded Gumbel noise are drawn: a draw without replacement in proportion to
exp(weight).

Both passes intern n-grams per batch in an open-addressed NumPy table. The key is the n-gram's xxhash64, computed for all
occurrences of a batch at once; linear probing ends at a free slot or at one whose n-gram has the same key, length and
bytes, so a collision of keys costs a probe and never merges two n-grams. A slot stores its n-gram's bucket and count:
buckets are computed once per distinct n-gram, the first pass adds up counts by bucket, and the second gathers gains
through the slot numbers of the occurrences.

Every task sends at most one count per bucket; counts and gains have `buckets` rows, whatever the input. Ranks come from
range partitions and their sizes (no task sees all rows). Batches are cut at `batch_words` words, inside a long text too,
with the next words looked at and not counted again.

Defined cases: a null or empty text has no features, weight 0; repeated rows and null ids are rows of their own, a null id
draws as the text `null`; ties go to the smaller doc_id, then nulls; an empty target or corpus gives counts of 0; an empty
table gives no rows. Of the documents doc_id and text are read, of the target text only.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, global_index
from .hashing import LOWER, PAD, lanes, texts, xxhash64

BUCKETS = 10_000
LONGEST = 3
SEED = 42
PERCENT = 5
MIN_WORDS = 20
# Words whose n-grams are interned together.
BATCH_WORDS = 1 << 16

# Bytes of words: digits, letters, and all of characters beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
def _crc_tables() -> list[np.ndarray]:
    """Effect of a byte on the checksum after 0 to 7 further bytes (polynomial of zlib's crc32, reflected)."""
    byte = np.arange(256, dtype=np.uint64)
    for _ in range(8):
        byte = np.where(byte & np.uint64(1), (byte >> np.uint64(1)) ^ np.uint64(0xEDB88320), byte >> np.uint64(1))
    out = [byte]
    for _ in range(7):
        last = out[-1]
        out.append(byte[last & np.uint64(255)] ^ (last >> np.uint64(8)))
    return out


CRC = _crc_tables()


def crc32(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of the strings of `size` bytes at `start`, eight bytes a step.

    Without its initial value the checksum ignores zeros in front, so a string's first step holds its odd bytes behind
    zeros; the initial value's effect depends on the length alone and is that of as many zeros.
    """
    eight = lanes(data, "<u8")
    sizes, number = np.unique(size, return_inverse=True)
    value = np.zeros(len(start), np.uint64)

    def step(rows, lane):
        lane ^= value[rows]
        total = CRC[7][lane & np.uint64(255)]
        for k in range(1, 8):
            total ^= CRC[7 - k][(lane >> np.uint64(8 * k)) & np.uint64(255)]
        value[rows] = total

    odd = size & 7
    rows = np.flatnonzero(odd)
    step(rows, eight[start[rows]] << (8 * (8 - odd[rows])).astype(np.uint64))
    at, rows = 0, np.flatnonzero(size >= 8)
    while len(rows):
        step(rows, eight[start[rows] + odd[rows] + at])
        at += 8
        rows = rows[size[rows] - odd[rows] > at]
    return value ^ np.array([zlib.crc32(bytes(n)) for n in sizes.tolist()], np.uint64)[number]


def _equal(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the strings of `size` bytes at `a` and `b` are the same bytes."""
    eight = lanes(data, "<u8")
    same = np.ones(len(a), bool)
    rows, at = np.arange(len(a)), 0
    while len(rows):
        x = eight[a[rows] + at] ^ eight[b[rows] + at]
        left = size[rows] - at
        tail = left < 8
        x[tail] <<= ((8 - left[tail]) * 8).astype(np.uint64)
        same[rows[x != 0]] = False
        rows = rows[(left > 8) & (x == 0)]
        at += 8
    return same


class Table:
    """Open-addressed table of one batch's n-grams: per slot the n-gram's key, place, bucket and count."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, buckets: int):
        n = len(start)
        slots = 1 << max(4, int(2 * n - 1).bit_length())
        key = xxhash64(data, start, size)
        holder = np.full(slots, -1, np.int64)  # the occurrence that stands for the slot
        self.slot = np.empty(n, np.int64)
        mask = slots - 1
        place = (key & np.uint64(mask)).astype(np.int64)
        rows = np.arange(n)
        while len(rows):
            at = place[rows]
            free = holder[at] < 0
            holder[at[free]] = rows[free]  # of several that want it one gets it
            own = holder[at]
            same = (key[own] == key[rows]) & (size[own] == size[rows])
            check = np.flatnonzero(same & (own != rows))
            same[check] = _equal(data, start[own[check]], start[rows[check]], size[rows[check]])
            self.slot[rows[same]] = at[same]
            rows = rows[~same]
            place[rows] = (place[rows] + 1) & mask
        used = np.flatnonzero(holder >= 0)
        self.bucket = np.zeros(slots, np.int64)
        self.bucket[used] = crc32(data, start[holder[used]], size[holder[used]]) % np.uint64(buckets)
        self.count = np.bincount(self.slot, minlength=slots)


def joined_words(batch: list[np.ndarray]):
    """(bytes of all words, lower-cased, one space after each; first byte, end and text number of each word)."""
    sizes = np.array([len(t) + 1 for t in batch], np.int64)
    ends = np.cumsum(sizes)
    flat = np.full(int(ends[-1]) if len(batch) else 0, 0x20, np.uint8)
    for t, end in zip(batch, ends.tolist()):
        flat[end - 1 - len(t) : end - 1] = LOWER[t]
    word = WORD_BYTE[flat]
    before = np.concatenate([[False], word[:-1]])
    owner = np.searchsorted(ends, np.flatnonzero(word & ~before), side="right")
    keep = word | before  # the byte after a word becomes its space
    data = np.where(word, flat, 0x20)[keep].astype(np.uint8)
    last = np.flatnonzero(data == 0x20)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    return np.concatenate([data, np.zeros(PAD, np.uint8)]), first, last, owner


def occurrences(first, last, owner, begin: int, stop: int, longest: int):
    """(start, size, text number) of the n-grams that begin at the words from `begin` to before `stop`."""
    starts, sizes, owners = [], [], []
    for n in range(longest):
        i = np.arange(begin, max(begin, min(stop, len(first) - n)))
        i = i[owner[i] == owner[i + n]]
        starts.append(first[i])
        sizes.append(last[i + n] - first[i])
        owners.append(owner[i])
    return np.concatenate(starts), np.concatenate(sizes), np.concatenate(owners)


def _loads(column, batch_words: int):
    """(first row, texts) of an Arrow column, cut where about `batch_words` words are reached."""
    held, at, size = [], 0, 0
    for row, text in enumerate(texts(column)):
        held.append(text)
        size += len(text)
        if size >= batch_words * 6:
            yield at, held
            held, at, size = [], row + 1, 0
    if held:
        yield at, held


def interned(column, longest: int, buckets: int, batch_words: int):
    """Per batch of n-grams: (first row of its load, words per row, text numbers of the occurrences, table)."""
    for at, held in _loads(column, batch_words):
        data, first, last, owner = joined_words(held)
        for begin in range(0, len(first), batch_words):
            start, size, of = occurrences(first, last, owner, begin, begin + batch_words, longest)
            words = np.bincount(owner[begin : begin + batch_words], minlength=len(held))
            yield at, words, of, Table(data, start, size, buckets)


def bucket_counts(table: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, batch_words: int = BATCH_WORDS):
    """Features per bucket over all texts, on the driver: `buckets` numbers. A task sends one row per bucket at most."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, table in interned(batch.column(0), longest, buckets, batch_words):
                total += np.bincount(table.bucket, weights=table.count, minlength=buckets).astype(np.int64)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held], pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    found = table.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in found.collect():
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the log of its smoothed share in the target over that in the corpus, in thousandths, rounded down."""
    size, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    s, t = corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s_all + size) / ((s + 1) * (t_all + size)))).astype(np.int64)


WEIGHED = "doc_id long, n_features long, weight long, n_words long"


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST, batch_words: int = BATCH_WORDS) -> DataFrame:
    """doc_id, n_features, weight, n_words: one row per document. One pass, no shuffle."""
    buckets = len(gain)
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def rows(batches):
        for batch in batches:
            n = batch.num_rows
            features, weight, words = (np.zeros(n, np.int64) for _ in range(3))
            for at, n_words, of, table in interned(batch.column(1), longest, buckets, batch_words):
                here = slice(at, at + len(n_words))
                words[here] += n_words
                features[here] += np.bincount(of, minlength=len(n_words))
                np.add.at(weight, of + at, shared.value[table.bucket][table.slot])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in (features, weight, words))],
                [c.split()[0] for c in WEIGHED.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, WEIGHED)


def with_noise(table: DataFrame, seed: int = SEED) -> DataFrame:
    """score = weight plus seeded Gumbel noise in thousandths, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return table.withColumn("score", F.col("weight") + noise.cast("long"))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
    longest: int = LONGEST,
    batch_words: int = BATCH_WORDS,
) -> DataFrame:
    """One row per document: n_features, weight, score, and its rank if it is drawn."""
    gain = gains(bucket_counts(docs, buckets, longest, batch_words), bucket_counts(target, buckets, longest, batch_words))
    scratch = Scratch(docs.sparkSession)
    scored = scratch.put(with_noise(weighed(docs, gain, longest, batch_words), seed), "scored")
    enough = F.col("n_words") >= min_words
    drawn = scored.where(enough).count() * percent // 100
    order = (F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features"))
    ranked = global_index(scored.where(enough), *order).withColumn(
        "rank", F.when(F.col("position") < drawn, F.col("position") + 1)
    )
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return ranked.select(columns).unionByName(rest.select(columns))
