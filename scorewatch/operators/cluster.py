"""Population-mix shift: k-means on the train window of every review at once, share of both windows per cluster.

Lloyd's iteration runs for all reviews (`group_cols`) and all starts together: one aggregate per step. Tasks assign their
rows to the nearest centres batch by batch and send one partial sum per review, start and cluster; the sums of a step are
the centres of the next. Reviews whose starts have all settled are no longer read.

Starts are fixed by the data alone, so that any layout of the rows gives the same result and plain SQL can repeat the
steps: start 0 cuts the train rows into k bands by the sum of their standardised features, start i by feature i, at the
borders that cut a normal distribution into equal parts. The centres of the bands are the first centres.
"""

from __future__ import annotations

import sys
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.text import quote
from ..session import BROADCAST_ROWS, discard, join_per_group, pin, stored
from . import rank
from .impute import median_imputed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 3
# Starts tried: the sum of all features, then the features in order.
SEEDS = range(10)
# The reference fit's own bounds: steps, and the sum of squares by which all centres of a start may still move when it stops.
MAX_ITERATIONS = 300
SETTLED = 1e-4
# Centres of the reviews iterated together hold at most so many numbers; further reviews follow.
NUMBERS = 2_000_000
# Rows of one review and window lie together in blocks of about so many bytes.
BLOCK_BYTES = 1 << 20


def borders(k: int) -> list[float]:
    """Where a standard normal distribution falls into k equal parts."""
    return [NormalDist().inv_cdf(i / k) for i in range(1, k)]


def standardised(df: DataFrame, features, group_cols=()) -> tuple[DataFrame, DataFrame]:
    """Rows (review_no, win, features) scaled by the train window's mean and population deviation, and the numbered reviews.

    Constant features are only centred. `review_no` is dense from 0.
    """
    train = [
        f"{agg}(`{f}`) FILTER (WHERE win = 'train') AS `{f}|{name}`"
        for f in features
        for agg, name in (("avg", "m"), ("stddev_pop", "s"))
    ]
    keys = list(group_cols)
    moments = df.groupBy(*keys).agg(*[F.expr(t) for t in train])  # a row per review
    order = ", ".join(f"`{g}`" for g in keys) or "1"
    reviews = pin(moments.selectExpr("*", f"int(row_number() OVER (ORDER BY {order}) - 1) AS review_no"))
    few = not keys or reviews.count() <= BROADCAST_ROWS
    joined = join_per_group(df, reviews, keys, "inner", broadcast=few)
    scaled = [
        f"(`{f}` - `{f}|m`) / CASE WHEN `{f}|s` > 0 THEN `{f}|s` ELSE 1.0D END AS `{f}`" for f in features
    ]
    return joined.selectExpr("review_no", "win", *scaled), reviews.select(*keys, "review_no")


def _blocks(rows: DataFrame, features) -> DataFrame:
    """Rows as blocks of one review and window, feature by feature as bytes of doubles: a step reads whole arrays.

    Rows come sorted by review and window, so that blocks are long.
    """
    features, step = list(features), max(64, BLOCK_BYTES // (8 * max(1, len(features))))

    def cut(batches):
        for batch in batches:
            place = 2 * batch["review_no"].to_numpy().astype(np.int64) + (batch["win"] == "train").to_numpy()
            cells = batch[features].to_numpy(dtype=float)
            order = np.argsort(place, kind="stable")
            out = []
            for every in np.split(order, np.flatnonzero(np.diff(place[order])) + 1):
                for own in np.split(every, range(step, len(every), step)):
                    if len(own):
                        at = int(place[own[0]])
                        out.append((at // 2, at % 2 == 1, len(own), np.ascontiguousarray(cells[own].T).tobytes()))
            if out:
                yield pd.DataFrame(out, columns=["review_no", "train", "n", "cells"])

    return rows.select("review_no", "win", *features).mapInPandas(cut, "review_no int, train boolean, n int, cells binary")


def _nearest(x: np.ndarray, centres: np.ndarray):
    """Cluster and squared distance of each row (columns contiguous); a missing centre is nan and never nearest."""
    best, which = np.full(len(x), np.inf), np.zeros(len(x), np.int64)
    for c, centre in enumerate(centres):
        d = np.zeros(len(x))
        for j, at in enumerate(centre):
            gap = x[:, j] - at
            d += gap * gap
        nearer = d < best  # false for nan
        best = np.where(nearer, d, best)
        which[nearer] = c
    return which, best


def _band(x: np.ndarray, seed: int, k: int) -> np.ndarray:
    score = x.sum(1) / np.sqrt(x.shape[1]) if seed == 0 else x[:, seed - 1]
    return np.searchsorted(np.array(borders(k)), score, side="left")


def _partial_sums(blocks: DataFrame, p: int, centres: dict | None, seeds, k: int, moving: dict | None = None):
    """Sums per review, start and cluster: rows, current rows, squared distances of train rows, and train feature sums.

    centres: review -> starts x clusters x features; None assigns to the bands of the starts. moving: review -> whether
    each start is wanted; all are where it is None. A task adds up the blocks of a review that follow one another.
    """
    seeds = list(seeds)
    names = [f"s{j}" for j in range(p)]

    def sent(review, sums):
        s, c = np.nonzero((sums[:, :, 0] + sums[:, :, 1]) > 0)
        of = sums[s, c]
        found = pd.DataFrame({"review_no": np.full(len(s), review), "seed": s, "cluster": c})
        for i, name in enumerate(("train", "current")):
            found[name] = of[:, i].astype(np.int64)
        return found.assign(**{name: of[:, 2 + i] for i, name in enumerate(("cost", *names))})

    def partial(batches):
        at, sums = None, None
        for batch in batches:
            for row in batch.itertuples():
                review = row.review_no
                if centres is not None and review not in centres:
                    continue
                if review != at:
                    if at is not None:
                        yield sent(at, sums)
                    at, sums = review, np.zeros((len(seeds), k, 3 + p))
                x = np.frombuffer(row.cells, float).reshape(p, row.n).T
                for s, seed in enumerate(seeds):
                    if moving is not None and not moving[review][s]:
                        continue
                    if centres is None:
                        which, far = _band(x, seed, k), np.zeros(len(x))
                    else:
                        which, far = _nearest(x, centres[review][s])
                        which = np.where(np.isfinite(far), which, k)  # of no cluster
                    sums[s, :, 0 if row.train else 1] += np.bincount(which, minlength=k)[:k]
                    if row.train:
                        for i, weights in enumerate((far, *x.T)):
                            sums[s, :, 2 + i] += np.bincount(which, weights=weights, minlength=k)[:k]
        if at is not None:
            yield sent(at, sums)

    schema = "review_no int, seed int, cluster int, train long, current long, cost double, " + ", ".join(f"{n} double" for n in names)
    if centres is not None:  # blocks come sorted by review: settled ones are skipped where the file says so
        blocks = blocks.where(F.col("review_no").between(min(centres), max(centres)))
        if len(centres) <= 1000:
            blocks = blocks.where(F.col("review_no").isin(*centres))
    found = blocks.mapInPandas(partial, schema)
    return found.groupBy("review_no", "seed", "cluster").agg(*[F.sum(n).alias(n) for n in ("train", "current", "cost", *names)])


def _next_centres(sums, p: int, n_seeds: int, k: int) -> dict[int, np.ndarray]:
    """review -> starts x clusters x features from the summed rows; a cluster without train rows has no centre."""
    out: dict[int, np.ndarray] = {}
    for r in sums:
        if r["train"]:
            of = out.setdefault(r["review_no"], np.full((n_seeds, k, p), np.nan))
            of[r["seed"], r["cluster"]] = np.array([r[f"s{j}"] for j in range(p)]) / r["train"]
    return out


def _fitted(train: DataFrame, p: int, seeds, k: int, max_iterations: int) -> dict[int, np.ndarray]:
    """Centres of every review and start after the iteration. The driver holds at most `NUMBERS` numbers."""
    fitted = _next_centres(_partial_sums(train, p, None, seeds, k).collect(), p, len(seeds), k)
    moving = dict(fitted)
    stopped = {review: np.zeros(len(seeds), bool) for review in fitted}
    for _ in range(max_iterations):
        if not moving:
            break
        wanted = {review: ~stopped[review] for review in moving}
        after = _next_centres(_partial_sums(train, p, moving, seeds, k, wanted).collect(), p, len(seeds), k)
        still = {}
        for review, before in moving.items():
            done = stopped[review]
            fitted[review] = now = np.where(done[:, None, None], before, after[review])
            done |= np.nansum((now - before) ** 2, axis=(1, 2)) <= SETTLED
            if not done.all():
                still[review] = now
        moving = still
    return fitted


def cluster_share_shift(
    df: DataFrame,
    features,
    thresholds: Thresholds = Thresholds(),
    k: int = K,
    seeds=SEEDS,
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
    group_cols=(),
    max_iterations: int = MAX_ITERATIONS,
) -> DataFrame:
    """Per review the share of the train and current rows per cluster in percent, and the change in points.

    Missing values take the train median. Of all starts the one with the smallest sum of squared distances is kept;
    clusters are numbered by their centres. A review without train rows has no clusters: its shares are 0.
    """
    features, keys = list(features), list(group_cols)
    seeds = [s for s in seeds if s <= len(features)]
    filled = median_imputed(
        df.select("win", *keys, *features), features, keys, from_window="train", rows_per_bucket=rows_per_bucket
    )
    scaled, reviews = standardised(filled, features, keys)
    blocks = _blocks(scaled.sortWithinPartitions("review_no", "win"), features)
    rows, p = stored(blocks, "standardised"), len(features)  # read once a step
    spark, total = df.sparkSession, reviews.count()
    at_once = max(1, NUMBERS // (len(seeds) * k * max(1, len(features))))
    parts = []
    for first in range(0, total, at_once):
        own = rows if total <= at_once else rows.where(F.col("review_no").between(first, first + at_once - 1))
        centres = _fitted(own.where("train"), p, seeds, k, max_iterations)
        found: dict[int, dict] = {}
        for r in _partial_sums(own, p, centres, seeds, k).collect() if centres else ():
            found.setdefault(r["review_no"], {}).setdefault(r["seed"], []).append(r)
        out = []
        for review, by_seed in found.items():
            best = min(by_seed, key=lambda s: (sum(r["cost"] for r in by_seed[s]), s))
            place = {r["cluster"]: r for r in by_seed[best]}
            order = sorted(range(k), key=lambda c: (np.isnan(centres[review][best, c]).any(), tuple(centres[review][best, c])))
            for number, c in enumerate(order):
                r = place.get(c)
                out.append((review, number, r["train"] if r else 0, r["current"] if r else 0))
        parts.append(pin(spark.createDataFrame(out, "review_no int, cluster int, train long, current long")))
    discard(rows)
    counts = parts[0] if parts else spark.createDataFrame([], "review_no int, cluster int, train long, current long")
    for p in parts[1:]:
        counts = counts.unionAll(p)
    every = reviews.selectExpr("*", f"explode(sequence(0, {k - 1})) AS cluster").join(counts, ["review_no", "cluster"], "left")
    all_of = "OVER (PARTITION BY review_no)"
    shares = every.selectExpr(
        *[f"`{g}`" for g in keys],
        "cluster",
        f"coalesce(try_divide(train, sum(train) {all_of}), 0.0D) * 100.0D AS train_share_pct",
        f"coalesce(try_divide(current, sum(current) {all_of}), 0.0D) * 100.0D AS current_share_pct",
    )
    return shares.selectExpr(
        f"{quote(thresholds.config_version)} AS config_version",
        "*",
        "current_share_pct - train_share_pct AS share_change_pct_points",
    )
