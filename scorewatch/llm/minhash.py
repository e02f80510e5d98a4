"""Near-duplicates by b-bit MinHash: bands propose, packed low bits estimate, full shingle sets decide.

1. Per document: distinct five-word shingles, a fingerprint of the set, `BANDS * BAND_ROWS` minima; the bands are hashes
   of whole minima, the signature packs their `BITS` low bits.
2. Documents with equal sets form one class (map-side minimum); all further work is on classes.
3. Every bucket of a band links its classes to a hub, so a bucket proposes as many pairs as it has members. The order
   that picks hubs differs between bands. Proposals whose collision-corrected estimate is far below the threshold are
   dropped (four and a half standard deviations); the rest is decided on the full sets.
4. Components by alternating large-star and small-star rounds.
5. Buckets that still hold several components are gone through in blocks of about `BLOCK` classes and `BLOCK_BYTES` of sets a side: signatures
   first, then the sets of those with a likely partner in another component, until each such pair is decided or its
   classes are in one component. Blocks of a large bucket are separate groups of rows, and a pair is looked at in the
   first band that it shares only.
6. The links found join the components.

A pair at a similarity of exactly 0.75 is missed by all bands with a probability of 5e-6, more similar ones more rarely.

Defined cases: a null or empty text, or one of blanks, has no shingles, links with nothing and stays; a text under five
words is one shingle; repeated rows and rows with one doc_id share its component; a null doc_id joins the component of
equal sets or has none (component null) and is kept; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch
from .hashing import mixed, shingles, texts, word_hashes

SHINGLE = 5
THRESHOLD = 0.75
BANDS = 32
BAND_ROWS = 4
BITS = 4
# Estimates have a standard deviation of at most 0.045; proposals this far below the threshold are dropped.
MARGIN = 0.2
BLOCK = 1024
BLOCK_BYTES = 64 << 20
# Orders that pick hubs, one after the other over the bands; any values do.
ORDERS = (0x0, 0x2A5D3B9C6E, 0x3C96A5E1D7, 0x15E8C3F49B)

_rng = np.random.default_rng(20240501)
_MUL = _rng.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, BANDS * BAND_ROWS, dtype=np.uint64)

SKETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("fp1", pa.int64()),
        ("fp2", pa.int64()),
        ("bits", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]
)
SKETCH_SQL = "doc_id long, n_shingles long, fp1 long, fp2 long, bits binary, bands array<long>"


def fingerprint(sets: np.ndarray) -> tuple[int, int]:
    """128 bits of a sorted set of hashes."""
    n = np.uint64(len(sets))
    a, b = mixed(sets ^ np.uint64(0x5851F42D4C957F2D)), mixed(sets + np.uint64(0x14057B7EF767814F))
    pair = np.array([a.sum(dtype=np.uint64) + n, b.sum(dtype=np.uint64) ^ n], dtype=np.uint64).view(np.int64)
    return int(pair[0]), int(pair[1])


def minima(sets: np.ndarray) -> np.ndarray:
    out = np.full(len(_MUL), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(sets), 4096):  # a long text is hashed in pieces of its set
        part = sets[at : at + 4096]
        np.minimum(out, (part[None, :] * _MUL[:, None] + _ADD[:, None]).min(1), out=out)
    return out


def packed(minimum: np.ndarray) -> bytes:
    """Low `BITS` = 4 bits of the mixed minima, two to a byte."""
    low = (mixed(minimum) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).tobytes()


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from packed signatures (rows of bytes): share of equal fields, less what chance makes equal."""
    x = a ^ b
    equal = ((x & 0xF0) == 0).sum(-1) + ((x & 0x0F) == 0).sum(-1)
    chance = 1 / (1 << BITS)
    return (equal / (2 * a.shape[-1]) - chance) / (1 - chance)


def _band_keys(minimum: np.ndarray) -> np.ndarray:
    rows = minimum.reshape(BANDS, BAND_ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(BAND_ROWS):
        out = mixed(out + rows[:, i])
    return out.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    def sketch(batches):
        for batch in batches:
            cols = [[] for _ in range(5)]
            with np.errstate(over="ignore"):
                for text in texts(batch.column(1)):
                    s = shingles(word_hashes(text), SHINGLE)
                    m = minima(s) if len(s) else None
                    f1, f2 = fingerprint(s)
                    for c, v in zip(cols, (len(s), f1, f2, packed(m) if len(s) else b"", _band_keys(m) if len(s) else [])):
                        c.append(v)
            arrays = [batch.column(0), *[pa.array(c, type=f.type) for c, f in zip(cols, list(SKETCH)[1:])]]
            yield pa.RecordBatch.from_arrays(arrays, schema=SKETCH)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(sketch, SKETCH_SQL)


def shingle_sets(held: DataFrame) -> DataFrame:
    """cls and its packed sorted set, from rows with doc_id, text, cls, f1, f2; texts of other classes are left out."""

    def sets(batches):
        for batch in batches:
            keys, packs = [], []
            wanted = zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)))
            with np.errstate(over="ignore"):
                for text, (cls, f1, f2) in zip(texts(batch.column(0)), wanted):
                    found = shingles(word_hashes(text), SHINGLE)
                    if fingerprint(found) == (f1, f2):
                        keys.append(cls)
                        packs.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(packs, pa.binary())], ["cls", "set"])

    return held.select("text", "cls", "f1", "f2").mapInArrow(sets, "cls long, set binary")


@F.pandas_udf(T.DoubleType())
def _estimated(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype=float)
    width = BANDS * BAND_ROWS * BITS // 8
    rows = lambda s: np.frombuffer(b"".join(s), np.uint8).reshape(len(s), width)
    return pd.Series(estimate(rows(a), rows(b)))


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= round(100 * THRESHOLD) * (len(a) + len(b) - both)


@F.pandas_udf(T.BooleanType())
def _confirmed(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(a, b)], dtype=bool)


def components(edges: DataFrame) -> DataFrame:
    """node, root for the nodes of (u, v) edges; root is the smallest node of the component.

    Alternating large-star and small-star rounds: each is a minimum per node (map-side) and a join back to the edges,
    so a node with very many neighbours is an ordinary skewed join key.
    """
    s = Scratch(edges.sparkSession)
    e = s.put(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct(), "edges")
    seen = None
    while True:
        state = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if state == seen:
            return e.selectExpr("u AS node", "v AS root").union(e.selectExpr("v AS node", "v AS root").distinct())
        seen = state
        both = s.put(e.union(e.selectExpr("v AS u", "u AS v")), "both")
        low = s.put(both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "low")
        large = both.join(low, F.col("u") == F.col("w")).where("v > u").selectExpr("v AS u", "least(u, m) AS v")
        large = s.put(large.distinct(), "large")
        lower = s.put(large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")), "lower")
        small = large.join(lower, F.col("u") == F.col("w")).where("v <> m").selectExpr("v AS u", "m AS v")
        done, e = e, s.put(small.union(lower.selectExpr("w AS u", "m AS v")).distinct(), "small")
        s.drop(done, both, low, large, lower)


def _grouped(batches, key, work):
    """Feed runs of rows with one key (rows come sorted) to `work`, across batch borders; a run is bounded by blocks."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        keys = held[key].to_numpy()
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1 if len(keys) > 1 else []
        if len(cut):
            edges = [0, *cut]
            done = [held.iloc[a:b] for a, b in zip(edges, edges[1:])]
            held = held.iloc[edges[-1] :]
            yield from filter(lambda x: x is not None and len(x), map(work, done))
    if held is not None and len(held):
        last = work(held)
        if last is not None and len(last):
            yield last


def _sides(part):
    """Row numbers of the two sides of a block; a block against itself has its rows on both."""
    i, j = part["i"].iloc[0], part["j"].iloc[0]
    own = part["own"].to_numpy()
    return (np.arange(len(part)),) * 2 if i == j else (np.flatnonzero(own == i), np.flatnonzero(own == j))


def _likely(part):
    left, right = _sides(part)
    comp = part["root"].to_numpy()
    band = part["band"].iloc[0]
    bands = np.array(part["bands"].tolist(), dtype=np.int64)[:, :band]
    rows = np.frombuffer(b"".join(part["bits"]), np.uint8).reshape(len(part), -1)
    n = part["n_shingles"].to_numpy()
    wanted = np.zeros(len(part), bool)
    for x in left:
        other = right[comp[right] != comp[x]]
        other = other[np.minimum(n[other], n[x]) >= THRESHOLD * np.maximum(n[other], n[x]) - 1e-9]
        if len(other):
            hit = other[estimate(rows[other], rows[x][None]) >= THRESHOLD - MARGIN]
            hit = hit[~(bands[hit] == bands[x]).any(1)]
            wanted[hit] = True
            wanted[x] |= len(hit) > 0
    return part.loc[wanted, ["bucket", "i", "j", "own", "cls", "root", "bits"]]


def _decided(part):
    left, right = _sides(part)
    parent = {r: r for r in part["root"].tolist()}

    def top(r):
        while parent[r] != r:
            parent[r] = parent[parent[r]]
            r = parent[r]
        return r

    root, cls = part["root"].tolist(), part["cls"].tolist()
    sets = [np.frombuffer(s, np.uint64) for s in part["set"]]
    bits = np.frombuffer(b"".join(part["bits"]), np.uint8).reshape(len(part), -1)
    out = []
    for x in left:
        guess = estimate(bits[right], bits[x][None])
        for k in np.argsort(-guess, kind="stable"):
            y = right[k]
            if guess[k] < THRESHOLD - MARGIN:
                break
            a, b = top(root[x]), top(root[y])
            if a != b and _linked(sets[x], sets[y]):
                parent[max(a, b)] = min(a, b)
                out.append((cls[x], cls[y]))
    return pd.DataFrame(out, columns=["u", "v"]) if out else None


def _blocks(rows: DataFrame, work, schema: str) -> DataFrame:
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = ["bucket", "i", "j"]
    dealt = rows.repartition(parts, *key).sortWithinPartitions(*key, "cls")
    return dealt.mapInPandas(lambda batches: _grouped(batches, key, work), schema)


def _pairs_with(pairs: DataFrame, side: DataFrame, column: str) -> DataFrame:
    """Attach `column` of both ends of (u, v) pairs as a and b.

    Merge joins here and wherever texts or sets move: pairs grow with the corpus, so that a plan which broadcasts them
    while they are few would say nothing about the plan at size.
    """
    one = side.select(F.col("cls").alias("u"), F.col(column).alias("a"))
    two = side.select(F.col("cls").alias("v"), F.col(column).alias("b"))
    return pairs.join(one.hint("merge"), "u").join(two.hint("merge"), "v")


def near_duplicates(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document. It reads tables of `scratch`, which may go after it."""
    s = scratch or Scratch(docs.sparkSession)
    sketch = s.put(sketches(docs), "sketches")
    classes = s.put(
        sketch.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy("fp1", "fp2")
        .agg(F.min("doc_id").alias("first_doc"), *[F.first(c).alias(c) for c in ("n_shingles", "bits", "bands")])
        .withColumn("cls", F.monotonically_increasing_id()),
        "classes",
    )
    member = classes.select("cls", F.posexplode("bands").alias("band", "bucket"))
    flip = F.element_at(F.array(*[F.lit(o) for o in ORDERS]), F.col("band") % len(ORDERS) + 1)
    hubs = s.put(
        member.groupBy("bucket", flip.alias("flip"))
        .agg(F.min(F.col("cls").bitwiseXOR(flip)).alias("low"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("bucket").alias("hub_bucket"), F.col("low").bitwiseXOR(F.col("flip")).alias("hub"), "n"),
        "hubs",
    )
    proposed = member.join(hubs, F.col("bucket") == F.col("hub_bucket")).where("cls <> hub")
    pairs = s.put(proposed.selectExpr("greatest(cls, hub) AS u", "least(cls, hub) AS v").distinct(), "proposed")
    likely = s.put(
        _pairs_with(pairs, classes, "bits").where(_estimated("a", "b") >= THRESHOLD - MARGIN).select("u", "v"), "likely"
    )
    s.drop(pairs)

    def sets_of(wanted: DataFrame) -> DataFrame:
        """cls, set for the classes named in `wanted`, made anew from the texts of their first documents."""
        named = s.put(
            classes.join(wanted.select("cls").distinct(), "cls", "left_semi").selectExpr(
                "cls", "first_doc AS doc_id", "fp1 AS f1", "fp2 AS f2"
            ),
            "named",
        )
        held = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(named.hint("merge"), "doc_id")
        found = s.put(shingle_sets(held), "sets")
        if found.count() > named.count():  # rows that repeat a doc_id
            found = s.put(found.dropDuplicates(["cls"]), "single")
        return found

    ends = likely.selectExpr("u AS cls").union(likely.selectExpr("v AS cls"))
    sets = sets_of(ends)
    confirmed = s.put(_pairs_with(likely, sets, "set").where(_confirmed("a", "b")).select("u", "v"), "links")
    s.drop(sets, likely)
    rooted = s.put(components(confirmed), "roots")
    s.drop(confirmed)

    # buckets of three and more that still hold several components
    placed = classes.select("cls", "n_shingles", "bits", "bands").join(
        rooted.withColumnRenamed("node", "cls"), "cls", "left"
    )
    placed = s.put(placed.withColumn("root", F.coalesce("root", "cls")), "placed")
    in_bucket = placed.select("cls", "root", "n_shingles", F.posexplode("bands").alias("band", "bucket"))
    large = hubs.where("n > 2").select("hub_bucket")
    split = s.put(
        in_bucket.join(large, F.col("bucket") == F.col("hub_bucket"), "left_semi")
        .groupBy(F.col("bucket").alias("open_bucket"))
        .agg(
            F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("n"), F.sum("n_shingles").alias("hashes")
        )
        .where("a <> b")
        .select("open_bucket", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("hashes") * 8 / BLOCK_BYTES)).cast("int").alias("blocks")),
        "open",
    )
    s.drop(hubs)
    own = F.pmod(F.xxhash64("cls"), F.col("blocks").cast("long")).cast("int")
    opened = (
        placed.select("*", F.posexplode("bands").alias("band", "bucket"))
        .join(split, F.col("bucket") == F.col("open_bucket"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", "band", "cls", "root", "own", "bits", "bands", "n_shingles",
            F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        )
    )
    waiting = s.put(
        _blocks(opened, _likely, "bucket long, i int, j int, own int, cls long, root long, bits binary"), "waiting"
    )
    sets = sets_of(waiting)
    late = s.put(_blocks(waiting.join(sets.hint("merge"), "cls"), _decided, "u long, v long"), "late")
    s.drop(sets, waiting, split, placed)

    rooted = components(rooted.selectExpr("node AS u", "root AS v").union(late))
    whole = s.put(
        classes.join(rooted.withColumnRenamed("node", "cls"), "cls", "left").select(
            "fp1", "fp2", "first_doc", F.coalesce("root", "cls").alias("root")
        ),
        "whole",
    )
    lowest = s.put(whole.groupBy("root").agg(F.min("first_doc").alias("component_id")), "lowest")
    answer = s.put(whole.join(lowest, "root").select("fp1", "fp2", "component_id"), "answer")
    s.drop(classes, whole, lowest)
    rows = sketch.select("doc_id", "n_shingles", "fp1", "fp2").join(answer, ["fp1", "fp2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents without those that a smaller doc_id of their component stands for."""
    s = Scratch(docs.sparkSession)
    gone = s.put(near_duplicates(docs, s).where("NOT kept").select("doc_id").distinct(), "gone")
    s.drop_others(gone)
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
