"""Exact removal of strings of `LENGTH` = 200 bytes that occur more than once, by prefix doubling over anchored positions.

Literal prefix doubling ranks every byte position and shuffles all of them once per doubling: at 16 bytes a position and
round that is far more than the texts themselves. Here the same naming by growing lengths starts from anchors (see
`anchors`), which equal strings share, and drops what has become unique before the next length:

* length 32: seeds at anchors. A window start whose anchor's seed is unique is unique. One position in 70 is shuffled.
* whole blocks: runs of window starts with one anchor. Blocks with an equal name are repeated as a whole, so only one
  block per name goes on, and only where its seed has blocks of other names too.
* length 158: the bytes that all windows of a quarter of the offsets from the anchor have in common. A quarter whose name
  is unique is unique; one whose covering string (up to 241 bytes) is repeated is repeated as a whole.
* length 200: the windows that are still open, one by one.

Every step names strings with 64-bit hashes, counts the names with a map-side aggregate and joins the repeated ones back;
both sides of a join are plain exchanges, so hot names are split by adaptive execution. Equal texts are told apart from
others by hash and length, and worked on once.

Defined cases: a null text is empty; a text under 200 bytes keeps all; strings are judged on the input, across and within
documents, overlapping occurrences included; repeated rows repeat each other's text; a null doc_id is a row of its own;
an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import SEED, blocks, names, prefix_sums
from .common import Scratch, text_of
from .hashing import mixed, texts

LENGTH = 200
QUARTERS = 4

BLOCK = "key long, name long, text_id long, n_bytes long, anchor long, before int, span int"


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def _batch(columns, schema: pa.Schema):
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    """One row per block of every text."""
    schema = _arrow(BLOCK)

    def cut(batches):
        for batch in batches:
            ids = batch.column(1).to_numpy()
            parts, held = [], 0
            with np.errstate(over="ignore"):
                for text, text_id in zip(texts(batch.column(0)), ids):
                    for seed, anchor, first, last, name in blocks(text, length):
                        n = len(seed)
                        held += n
                        parts.append(
                            (seed.view(np.int64), name.view(np.int64), np.full(n, text_id), np.full(n, len(text)))
                            + (anchor, (anchor - first).astype(np.int32), (last - first).astype(np.int32))
                        )
                        if held > 100_000:
                            yield _batch([np.concatenate(c) for c in zip(*parts)], schema)
                            parts, held = [], 0
            if parts:
                yield _batch([np.concatenate(c) for c in zip(*parts)], schema)

    return docs.select("text", "text_id").mapInArrow(cut, BLOCK)


CONTEXT = "cls long, key long, text_id long, n_bytes long, anchor long, before int, span int, bytes binary"


def _contexts(rows: DataFrame) -> DataFrame:
    """The bytes that the windows of each block cover, from rows (text, text_id, n_bytes, blocks)."""
    schema = _arrow(CONTEXT)

    def cut(batches):
        for batch in batches:
            ids, sizes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            lists = batch.column(3).to_pylist()
            out = []
            for text, text_id, n, found in zip(texts(batch.column(0)), ids, sizes, lists):
                for b in found:
                    first = b["anchor"] - b["before"]
                    part = text[first : first + b["span"] + LENGTH].tobytes()
                    out.append((b["cls"], b["key"], text_id, n, b["anchor"], b["before"], b["span"], part))
                if len(out) > 50_000:
                    yield _batch(list(zip(*out)), schema)
                    out = []
            if out:
                yield _batch(list(zip(*out)), schema)

    return rows.mapInArrow(cut, CONTEXT)


def _flat(column):
    """All bytes of a binary column as one array, and where each row starts in it."""
    _, offsets, data = column.cast(pa.large_binary()).buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at[:-1] - at[0]


def _salted(key: np.ndarray, *parts) -> np.ndarray:
    h = key.view(np.uint64)
    for p in parts:
        h = mixed(h ^ (np.asarray(p).astype(np.uint64) + np.uint64(0x51ED270B)))
    return h


QUARTER = "cls long, core long, hull long, quarter int, low int, high int"


def _quarters(contexts: DataFrame) -> DataFrame:
    """Per block and quarter of the offsets from the anchor: name of the common bytes, and of all bytes covered.

    `low` and `high` are the first and last offset (anchor minus start) that the block has in the quarter.
    """
    schema = _arrow(QUARTER)
    edges = np.linspace(0, LENGTH - SEED + 1, QUARTERS + 1).round().astype(int)

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, key, before, span = (batch.column(c).to_numpy() for c in ("cls", "key", "before", "span"))
            before, span = before.astype(np.int64), span.astype(np.int64)
            with np.errstate(over="ignore"):
                flat, base = _flat(batch.column("bytes"))
                sums = prefix_sums(flat)
                for q in range(QUARTERS):
                    low, high = np.maximum(before - span, edges[q]), np.minimum(before, edges[q + 1] - 1)
                    ok = np.flatnonzero(low <= high)
                    low, high, k, at = low[ok], high[ok], key[ok], (base + before)[ok]
                    core = names(sums, at - edges[q], LENGTH - (edges[q + 1] - 1 - edges[q])) ^ _salted(k, q, 0)
                    hull = names(sums, at - high, LENGTH + high - low) ^ _salted(k, low, high + 1000)
                    quarter = np.full(len(ok), q, np.int32)
                    found = (cls[ok], core.view(np.int64), hull.view(np.int64), quarter, low, high)
                    yield _batch([c.astype(f.type.to_pandas_dtype()) for c, f in zip(found, schema)], schema)

    return contexts.mapInArrow(cut, QUARTER)


WINDOW = "cls long, name long, offset int"


def _windows(rows: DataFrame) -> DataFrame:
    """Names of the open windows, from contexts with `open`, an array of (low, high)."""
    schema = _arrow(WINDOW)

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            cls, key, before = (batch.column(c).to_numpy() for c in ("cls", "key", "before"))
            spans = batch.column("open")
            row = np.repeat(np.arange(len(cls)), spans.value_lengths().to_numpy())
            low, high = (c.to_numpy().astype(np.int64) for c in spans.flatten().flatten())
            size = high - low + 1
            ends = np.cumsum(size)
            offset = np.arange(ends[-1]) - np.repeat(ends - size - low, size)
            row = np.repeat(row, size)
            with np.errstate(over="ignore"):
                flat, base = _flat(batch.column("bytes"))
                found = names(prefix_sums(flat), (base + before)[row] - offset, LENGTH)
                found = mixed(found ^ mixed(key[row].view(np.uint64) + offset.astype(np.uint64)))
            yield _batch([cls[row], found.view(np.int64), offset.astype(np.int32)], schema)

    return rows.select("cls", "key", "before", "bytes", "open").mapInArrow(cut, WINDOW)


def _repeated(rows: DataFrame, name: str) -> DataFrame:
    """Names that blocks of different contents share."""
    found = rows.groupBy(F.col(name).alias("again")).agg(F.min("cls").alias("a"), F.max("cls").alias("b"))
    return found.where("a <> b").select("again", F.col("a").alias("proof"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def merged(starts: np.ndarray, ends: np.ndarray):
    """Maximal runs covered by the given spans, as (starts, ends)."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[new], ends[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(ends) - 1]])]


def _cleaned(rows: DataFrame, with_text: bool) -> DataFrame:
    """doc_id, sizes and digest of what is kept, from rows (doc_id, text, covers)."""
    sql = RESULT + (", text string" if with_text else "")
    schema = _arrow(sql)

    def cut(batches):
        for batch in batches:
            covers = batch.column(2)
            out = []
            for i, text in enumerate(texts(batch.column(1))):
                spans = covers[i].values if covers[i].is_valid else None
                doc_id = batch.column(0)[i].as_py()
                if spans is None:
                    kept, removed, n = text, 0, 0
                else:
                    spans = spans.flatten()
                    a, b = merged(spans[0].to_numpy(), spans[1].to_numpy())
                    bare = np.ones(len(text), bool)
                    for x, y in zip(a, b):
                        bare[x:y] = False
                    kept, n = text[bare], len(a)
                    removed = len(text) - len(kept)
                row = (doc_id, len(text), removed, n, hashlib.sha256(kept.tobytes()).hexdigest())
                out.append(row + ((kept.tobytes().decode("utf-8", "ignore"),) if with_text else ()))
            if out:
                yield _batch(list(zip(*out)), schema)

    return rows.mapInArrow(cut, sql)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the text kept, cut characters dropped): a row per document."""
    s = Scratch(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = rows.withColumn("text_id", F.xxhash64("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    place = ["text_id", "n_bytes", "anchor", "before", "span"]

    anchored = s.put(_anchored(rows, LENGTH), "anchored")
    seeds = s.put(
        anchored.groupBy(F.col("key").alias("seed")).agg(F.count("*").alias("n")).where("n > 1").select("seed"), "seeds"
    )
    # written before it is counted: a join whose rows an aggregate takes as they lie would not be split at hot seeds
    shared = s.put(anchored.join(seeds, F.col("key") == F.col("seed")).select("key", "name", *place), "shared")
    s.drop(anchored, seeds)
    # equal texts have equal blocks: they are counted together from here on
    hits = s.put(shared.groupBy("key", "name", *place).agg(F.count("*").alias("times")), "hits")
    s.drop(shared)
    classes = s.put(
        hits.groupBy("key", "name")
        .agg(F.sum("times").alias("times"), *[F.first(c).alias(c) for c in place])
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    again = s.put(classes.where("times > 1").select(F.col("key").alias("k"), F.col("name").alias("v")), "again")
    whole = s.put(
        hits.join(again, (F.col("key") == F.col("k")) & (F.col("name") == F.col("v"))).select(
            "text_id",
            "n_bytes",
            (F.col("anchor") - F.col("before")).alias("start"),
            (F.col("anchor") - F.col("before") + F.col("span") + LENGTH).alias("end"),
        ),
        "whole",
    )
    s.drop(hits, again)
    several = s.put(classes.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).where("n > 1").select("k"), "several")
    left = s.put(classes.join(several, F.col("key") == F.col("k")).select("cls", "key", *place), "left")
    s.drop(classes, several)

    # one document per text that holds blocks still in doubt
    firsts = rows.groupBy("text_id", "n_bytes").agg(F.min("doc_id").alias("first_doc"))
    wanted = left.groupBy("text_id", "n_bytes").agg(
        F.collect_list(F.struct("cls", "key", "anchor", "before", "span")).alias("blocks")
    )
    wanted = s.put(wanted.join(firsts, ["text_id", "n_bytes"]), "wanted")
    named = wanted.select(F.col("text_id").alias("t"), F.col("n_bytes").alias("b"), "first_doc", "blocks")
    same = (F.col("text_id") == F.col("t")) & (F.col("n_bytes") == F.col("b"))
    holders = rows.join(named, same & F.col("doc_id").eqNullSafe(F.col("first_doc")))
    contexts = s.put(_contexts(holders.select("text", "text_id", "n_bytes", "blocks")), "contexts")
    s.drop(left, wanted)

    quarters = s.put(_quarters(contexts), "quarters")
    cores, hulls = s.put(_repeated(quarters, "core"), "cores"), s.put(_repeated(quarters, "hull"), "hulls")
    alive = s.put(
        quarters.join(cores.select("again"), F.col("core") == F.col("again"))
        .join(hulls.select(F.col("again").alias("covered"), "proof"), F.col("hull") == F.col("covered"), "left")
        .select("cls", "low", "high", F.col("covered").isNotNull().alias("done"), "proof"),
        "alive",
    )
    s.drop(quarters, cores, hulls)
    # one quarter of each repeated name goes on, for those that share only some of its windows
    open_ = alive.where("NOT done OR proof = cls").groupBy("cls").agg(F.collect_list(F.struct("low", "high")).alias("open"))
    windows = s.put(_windows(contexts.join(open_, "cls")), "windows")
    repeated = s.put(_repeated(windows, "name"), "repeated")
    found = windows.join(repeated.select("again"), F.col("name") == F.col("again")).select(
        "cls", F.col("offset").alias("low"), F.col("offset").alias("high")
    )
    found = alive.where("done").select("cls", "low", "high").union(found)
    pieces = found.join(contexts.select("cls", "text_id", "n_bytes", "anchor"), "cls").select(
        "text_id",
        "n_bytes",
        (F.col("anchor") - F.col("high")).alias("start"),
        (F.col("anchor") - F.col("low") + LENGTH).alias("end"),
    )
    covers = s.put(
        whole.union(pieces)
        .groupBy(F.col("text_id").alias("t"), F.col("n_bytes").alias("b"))
        .agg(F.collect_list(F.struct("start", "end")).alias("covers")),
        "covers",
    )
    s.drop(whole, windows, repeated, alive, contexts)
    return _cleaned(rows.join(covers, same, "left").select("doc_id", "text", "covers"), with_text)
