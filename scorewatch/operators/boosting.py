"""The reviewing model of many reviews at once: histogram boosting in one aggregate of gradients per tree level.

Train rows are cut into bins at exact quantiles of their review. For every level of every tree, tasks add up the gradients
and curvatures of their rows by (review, node, feature, bin); the driver gets those sums, picks the splits of all reviews
and hands the nodes to the next pass. Trees are rows of a node table. The gradients are whole numbers (of 2^-24), and rows
are sampled by a hash of their own values, so that the trees are the same for any layout of the rows.

Splits, leaves and sampling follow the reference model of the review: second-order logistic loss, 80 trees of depth 3,
rate 0.06, nine tenths of the rows and of the features per tree.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import number_sql
from ..session import BROADCAST_ROWS, discard, join_per_group, pin, stored
from . import rank
from .drift import long_values
from .impute import median_imputed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
TREES, DEPTH, RATE = 80, 3, 0.06
ROW_SHARE, FEATURE_SHARE = 0.9, 0.9
# Added to a node's curvature, and the least curvature of a child: the reference model's own settings.
PENALTY, LEAST_CHILD = 1.0, 1.0
BINS = 32
UNIT = float(1 << 24)
# Margins are written anew after so many trees; passes in between add the outputs of the trees since.
KEPT_TREES = 16
# Sums that the driver holds for the reviews trained together; further reviews follow.
NUMBERS = 2_000_000
# Numbers that the tasks of a pass send to the driver as they are; more are added up by review first.
SENT = 4_000_000
# Trees up to this depth have at most 128 cells, a byte's worth.
TABLED_DEPTH = 3
# Rows of one review lie together in blocks of about so many bytes.
BLOCK_BYTES = 1 << 20
BLOCK_COLUMNS = ["review_no", "bins", "hashes", "labels", "margins"]
BLOCK_SCHEMA = "review_no int, bins binary, hashes binary, labels binary, margins binary"
NODES = "review_no int, tree int, node int, feature int, cut double, value double, cover double"


def mixed(h: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit hash of hashes and a number."""
    with np.errstate(over="ignore"):
        h = h.astype(np.int64).view(np.uint64) + np.uint64((salt * 0x9E3779B97F4A7C15) % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


@dataclass
class Trees:
    """Trees of one review, nodes in heap order: feature (-1: a leaf), bin of the cut, leaf value, curvature held."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    @classmethod
    def empty(cls, trees: int, depth: int) -> Trees:
        shape = (trees, (2 << depth) - 1)
        return cls(np.full(shape, -1, np.int32), np.zeros(shape), np.zeros(shape), np.zeros(shape))

    def part(self, first: int, end: int) -> Trees:
        return Trees(self.feature[first:end], self.cut[first:end], self.value[first:end], self.cover[first:end])

    def codes(self, tree: int, cells: np.ndarray, depth: int) -> np.ndarray:
        """The turns of each row as bits, the first one highest, 1 for right; a row at or below a cut goes left, and one that
        has stopped in a leaf keeps left. Columns of `cells` should be contiguous."""
        code = np.zeros(len(cells), np.min_scalar_type((1 << depth) - 1))
        for level in range(depth):
            right = np.zeros(len(cells), bool)
            for k in range(1 << level):
                n = (1 << level) - 1 + k
                f = self.feature[tree, n]
                if f >= 0:
                    beyond = cells[:, f] > self.cut[tree, n]
                    right |= beyond & (code == k) if level else beyond
            code = code << 1 | right
        return code

    def ends(self, tree: int, depth: int) -> np.ndarray:
        """Node that the rows of each code reach after `depth` steps: the leaf they stopped in, or a node of that level."""
        node = np.zeros(1, np.int64)
        for _ in range(depth):
            split = self.feature[tree, node] >= 0
            node = np.stack([np.where(split, 2 * node + 1, node), np.where(split, 2 * node + 2, node)], axis=1).ravel()
        return node

    def nodes(self, tree: int, cells: np.ndarray, depth: int) -> np.ndarray:
        """Node that each row reaches after `depth` steps."""
        return self.ends(tree, depth)[self.codes(tree, cells, depth)]

    def outputs(self, tree: int, cells: np.ndarray, depth: int) -> np.ndarray:
        return self.value[tree][self.ends(tree, depth)][self.codes(tree, cells, depth)]

    def margins(self, cells: np.ndarray, depth: int) -> np.ndarray:
        cells, total = np.asfortranarray(cells), np.zeros(len(cells))
        for t in range(len(self.feature)):
            total += self.outputs(t, cells, depth)
        return total


def grid(feature, cut, depth: int, levels):
    """A tree cut into cells, one for every choice of an interval per feature between the tree's own cuts.

    levels: sorted cuts per feature, the tree's among them; a value lies in the interval of as many levels as are below it.
    Returns per feature the number that each interval adds to a row's cell, the node that each cell ends in, and per feature
    (step, intervals, cuts).
    """
    cuts: dict[int, set] = {}
    for n in range((1 << depth) - 1):
        if feature[n] >= 0:
            cuts.setdefault(int(feature[n]), set()).add(float(cut[n]))
    added, axes, size = {}, {}, 1
    for f in sorted(cuts):
        own = sorted(cuts[f])
        rank = np.searchsorted(np.searchsorted(levels[f], own), np.arange(len(levels[f]) + 1))
        added[f], axes[f] = (size * rank).astype(np.uint64), (size, len(own) + 1, own)
        size *= len(own) + 1
    cell, node = np.arange(size), np.zeros(size, np.int64)
    for n in range((1 << depth) - 1):
        if feature[n] >= 0:
            step, count, own = axes[int(feature[n])]
            here = node == n
            node[here] = 2 * n + 1 + (cell[here] // step % count > own.index(float(cut[n])))
    return added, node, axes


@dataclass
class Tables:
    """Trees of one review as tables, eight to a 64-bit number: its bytes are a row's cells, the sum of a number per feature."""

    added: list[dict]  # per eight trees and feature, by interval
    values: list[np.ndarray]  # per tree, by cell

    @classmethod
    def of(cls, grids, values) -> Tables:
        added = []
        for first in range(0, len(grids), 8):
            word: dict = {}
            for k, own in enumerate(grids[first : first + 8]):
                for f, numbers in own.items():
                    word[f] = word.get(f, np.uint64(0)) + (numbers << np.uint64(8 * k))
            added.append(word)
        return cls(added, list(values))

    def sums(self, places, n: int) -> list[np.ndarray]:
        """places: the rows' intervals, by feature."""
        out = []
        for word in self.added:
            total = np.zeros(n, "<u8")
            for f, numbers in word.items():
                total += numbers[places[f]]
            out.append(total)
        return out

    def outputs(self, tree: int, sums) -> np.ndarray:
        return self.values[tree][sums[tree // 8].view(np.uint8)[tree % 8 :: 8]]

    def margins(self, places, n: int) -> np.ndarray:
        sums, total = self.sums(places, n), np.zeros(n)
        for t in range(len(self.values)):
            total += self.outputs(t, sums)
        return total


def levels_of(trees: Trees, p: int) -> list[np.ndarray]:
    """The cuts of every feature, sorted."""
    return [np.unique(trees.cut[trees.feature == f]) for f in range(p)]


def intervals(levels, x: np.ndarray) -> list[np.ndarray]:
    """By feature, the number of levels below each value; missing values lie below all."""
    out = []
    for f, own in enumerate(levels):
        place = np.searchsorted(own, x[:, f])
        out.append(np.where(np.isnan(x[:, f]), 0, place))
    return out


def own_rows(batch: pd.DataFrame, known):
    """(review, its rows of the batch) for the reviews that are known."""
    review = batch["review_no"].to_numpy()
    order = np.argsort(review, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(review[order])) + 1):
        if len(own) and int(review[own[0]]) in known:
            yield int(review[own[0]]), own


def _blocks(rows: DataFrame, features, borders: dict, base: dict) -> DataFrame:
    """Train rows as blocks of one review: bins (feature by feature, a byte each), hashes, labels and margins as bytes.

    A pass over blocks reads whole arrays; rows come sorted by review, so that blocks are long.
    """
    step = max(64, BLOCK_BYTES // (len(features) + 24))  # bytes of a row

    def cut(batches):
        for batch in batches:
            cells, label, hashes = batch[features].to_numpy(dtype=float), batch["label"].to_numpy(), batch["row_hash"].to_numpy()
            out = []
            for review, every in own_rows(batch, borders):
                for own in np.split(every, range(step, len(every), step)):
                    bins = np.zeros((len(features), len(own)), np.int8)
                    for j, b in enumerate(borders[review]):
                        bins[j] = np.searchsorted(b, cells[own, j], side="left")
                    parts = bins, hashes[own].astype(np.int64), label[own].astype(float), np.full(len(own), base[review])
                    out.append((review, *[x.tobytes() for x in parts]))
            if out:
                yield pd.DataFrame(out, columns=BLOCK_COLUMNS)

    return rows.select("review_no", "row_hash", "label", *features).mapInPandas(cut, BLOCK_SCHEMA)


def _block(bins, hashes, labels, margins, p: int):
    """Bins as features x rows, hashes, labels and margins of a block."""
    hashes = np.frombuffer(hashes, np.int64)
    return np.frombuffer(bins, np.int8).reshape(p, len(hashes)), hashes, np.frombuffer(labels, float), np.frombuffer(margins, float)


def _since_margins(since, bins: np.ndarray, depth: int) -> np.ndarray:
    return since.margins(bins, bins.shape[1]) if isinstance(since, Tables) else since.margins(bins.T, depth)


def _with_margins(rows: DataFrame, p: int, since: dict, depth: int) -> DataFrame:
    def add(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples():
                bins, _, _, margin = _block(row.bins, row.hashes, row.labels, row.margins, p)
                out.append((margin + _since_margins(since[row.review_no], bins, depth)).tobytes())
            yield batch.assign(margins=out)

    return rows.mapInPandas(add, rows.schema)


def _held(table: DataFrame) -> RDD:
    """The blocks as tuples that the executors keep between passes, on disk where memory is short."""
    return table.select(*BLOCK_COLUMNS).rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)


def _histogram(
    rows: RDD, tasks: int, p: int, since: dict, growing: dict[int, Trees], wanted: dict, tree: int, level: int, columns, depth
) -> dict[int, np.ndarray]:
    """Per review the sums of gradients and curvatures of the sampled rows in the wanted nodes of the level: 2 x features of
    this tree x nodes x bins.

    A task adds up the blocks of a review that follow one another before it sends their sums.
    """
    first, size, columns = (1 << level) - 1, (1 << level) * BINS, list(columns)

    def add_up(blocks):
        at, sums = None, None
        for review, *block in blocks:
            if review != at:
                if at is not None:
                    yield at, sums
                at, sums = review, np.zeros((2, len(columns), size), np.int64)
            if not wanted[review].any():
                continue
            bins, hashes, label, margin = _block(*block, p)
            chosen = mixed(hashes, SEED + tree) < np.uint64(int(ROW_SHARE * (1 << 64)))
            if level:  # rows of other nodes, and those that have stopped in a leaf, are left out
                code, ends = growing[review].codes(0, bins.T, level), growing[review].ends(0, level)
                chosen &= ((ends >= first) & wanted[review][np.maximum(ends - first, 0)])[code]
            own = np.flatnonzero(chosen)
            cells = bins.take(own, axis=1)
            chance = 1 / (1 + np.exp(-(margin[own] + _since_margins(since[review], cells, depth))))
            gradient = np.rint((chance - label[own]) * UNIT)
            curvature = np.rint(np.maximum(chance * (1 - chance), 1e-6) * UNIT)
            place = code[own].astype(np.int64) * BINS if level else np.int64(0)
            for k, j in enumerate(columns):
                at_bins = place + cells[j]
                for total, weights in zip(sums, (gradient, curvature)):
                    total[k] += np.bincount(at_bins, weights=weights, minlength=size).astype(np.int64)
        if at is not None:
            yield at, sums

    found = rows.mapPartitions(add_up)
    if tasks * len(wanted) * 2 * len(columns) * size > SENT:
        found = found.reduceByKey(lambda a, b: a + b)
    out: dict[int, np.ndarray] = {}
    for review, sums in found.collect():
        out[review] = out[review] + sums if review in out else sums
    return {review: sums.reshape(2, len(columns), -1, BINS) for review, sums in out.items()}


def _split(found: np.ndarray, p: int, columns):
    """Per review and node: (gain, feature, bin, sums of the left child, sums of the node); a gain of 0 or less is no split.

    found: 2 x reviews x nodes x features x bins.
    """
    sums = found / UNIT
    left = sums.cumsum(-1)
    whole = left[:, :, :, columns[0], -1]
    g, h = whole[0][..., None, None], whole[1][..., None, None]
    gl, hl = left
    gr, hr = g - gl, h - hl
    gain = gl**2 / (hl + PENALTY) + gr**2 / (hr + PENALTY) - g**2 / (h + PENALTY)
    used = np.zeros(p, bool)
    used[columns] = True
    gain = np.where((hl >= LEAST_CHILD) & (hr >= LEAST_CHILD) & used[:, None], gain, -1.0)
    flat = gain.reshape(*gain.shape[:2], -1)
    best = flat.argmax(-1)
    feature, cut = best // BINS, best % BINS
    i, k = np.indices(best.shape)
    return np.take_along_axis(flat, best[..., None], -1)[..., 0], feature, cut, left[:, i, k, feature, cut], whole


def _grown(rows: DataFrame, p: int, base: dict[int, float], trees: int, depth: int) -> dict[int, Trees]:
    """All trees of the reviews in `base`, tree by tree and level by level.

    Below the root the smaller child of a split is counted; the other one has the rest of its parent.
    """
    reviews = sorted(base)
    models = {r: Trees.empty(trees, depth) for r in reviews}
    kept, table, blocks = 0, rows, _held(rows)
    levels = [np.arange(BINS - 1, dtype=float)] * p
    grids: dict[int, list] = {r: [] for r in reviews}  # of the trees that the written margins do not hold

    def walked(first: int, end: int):
        if depth > TABLED_DEPTH:
            return {r: m.part(first, end) for r, m in models.items()}
        return {r: Tables.of([g[0] for g in grids[r]], [g[1] for g in grids[r]]) for r in reviews}

    for tree in range(trees):
        if tree - kept == KEPT_TREES:
            table, old, kept = stored(_with_margins(table, p, walked(kept, tree), depth), "margins"), table, tree
            grids = {r: [] for r in reviews}
            blocks.unpersist()
            blocks = _held(table)
            if old is not rows:
                discard(old)
        chosen = np.random.default_rng([SEED, tree]).permutation(p)[: max(1, int(FEATURE_SHARE * p))]
        columns = sorted(chosen.tolist())
        since = walked(kept, tree)
        growing = {r: m.part(tree, tree + 1) for r, m in models.items()}
        sums = np.zeros((2, len(reviews), (2 << depth) - 1))
        wanted, whole_of, held = {r: np.ones(1, bool) for r in reviews}, [], None
        for level in range(depth):
            above, held = held, np.zeros((2, len(reviews), 1 << level, p, BINS), np.int64)
            counted = _histogram(blocks, blocks.getNumPartitions(), p, since, growing, wanted, tree, level, columns, depth)
            for i, r in enumerate(reviews):
                if r in counted:
                    held[:, i][:, :, columns] = counted[r].transpose(0, 2, 1, 3)
            for i, small in whole_of:
                held[:, i, small ^ 1] = above[:, i, small >> 1] - held[:, i, small]
            gain, feature, cut, left, whole = _split(held, p, columns)
            first = (1 << level) - 1
            if not level:
                sums[:, :, 0] = whole[:, :, 0]
            wanted, whole_of = {r: np.zeros(2 << level, bool) for r in reviews}, []
            for i, r in enumerate(reviews):
                for k in range(1 << level):
                    if gain[i, k] > 0:
                        n = first + k
                        models[r].feature[tree, n], models[r].cut[tree, n] = feature[i, k], cut[i, k]
                        sums[:, i, 2 * n + 1], sums[:, i, 2 * n + 2] = left[:, i, k], whole[:, i, k] - left[:, i, k]
                        small = 2 * k + int(2 * left[1, i, k] > whole[1, i, k])
                        wanted[r][small] = True
                        whole_of.append((i, small))
            if not whole_of:
                break
        for i, r in enumerate(reviews):
            models[r].value[tree] = -RATE * sums[0, i] / (sums[1, i] + PENALTY)
            models[r].cover[tree] = sums[1, i]
            if depth <= TABLED_DEPTH:
                added, ends, _ = grid(models[r].feature[tree], models[r].cut[tree], depth, levels)
                grids[r].append((added, models[r].value[tree][ends]))
    blocks.unpersist()
    if table is not rows:
        discard(table)
    return models


@dataclass
class Reviewer:
    """A fitted model per review: `reviews` (keys, review_no, base margin) and `nodes` (rows as in NODES)."""

    reviews: DataFrame
    nodes: DataFrame
    features: list[str]
    group_cols: list[str]
    few: bool
    total: int
    trees: int
    depth: int

    def numbered(self, df: DataFrame) -> DataFrame:
        return join_per_group(df, self.reviews, self.group_cols, "inner", broadcast=self.few)

    def models(self, first: int, end: int) -> dict[int, tuple[float, Trees]]:
        """review -> (base margin, trees with cuts as values) for the reviews from `first` to before `end`."""
        wanted = F.col("review_no").between(first, end - 1)
        base = {r[0]: r[1] for r in self.reviews.where(wanted).select("review_no", "base").collect()}
        out = {r: (b, Trees.empty(self.trees, self.depth)) for r, b in base.items() if b is not None}
        nodes = self.nodes.where(wanted).toArrow().to_pandas()
        for review, own in nodes.groupby("review_no"):
            if review in out:
                at = own["tree"].to_numpy(), own["node"].to_numpy()
                model = out[review][1]
                for name in ("feature", "cut", "value", "cover"):
                    getattr(model, name)[at] = own[name].to_numpy()
        return out

    def ranges(self):
        """Review numbers whose models a task may hold together."""
        size = max(1, NUMBERS // (4 * self.trees * ((2 << self.depth) - 1)))
        return [(a, min(a + size, self.total)) for a in range(0, self.total, size)]


def fit(
    df: DataFrame,
    features,
    target: str,
    group_cols=(),
    entity: str | None = None,
    rows_per_bucket: int = rank.ROWS_PER_BUCKET,
    trees: int = TREES,
    depth: int = DEPTH,
) -> Reviewer:
    """Fit the reviewing model of every review on its train window; missing values take the review's train median.

    A review without train rows has no model: its base margin is null.
    """
    features, keys = list(features), list(group_cols)
    label = f"double(int(coalesce({number_sql(target)}, 0.0D))) AS label"
    others = [f"`{c}`" for c in ([entity] if entity and entity in df.columns and entity not in [*keys, *features] else [])]
    train = median_imputed(
        df.where("win = 'train'").selectExpr(*[f"`{g}`" for g in keys], *others, label, *[f"`{f}`" for f in features]),
        features,
        keys,
        rows_per_bucket=rows_per_bucket,
    )
    train = stored(train.selectExpr("*", f"xxhash64({', '.join([*others, *[f'`{f}`' for f in features]])}) AS row_hash"), "train")
    share = "greatest(1E-6D, least(1D - 1E-6D, avg(label)))"
    order = ", ".join(f"`{g}`" for g in keys) or "1"
    known = train.groupBy(*keys).agg(F.expr(f"CASE WHEN count(*) > 0 THEN ln({share} / (1D - {share})) END AS base"))
    reviews = join_per_group(df.select(*keys).distinct(), known, keys) if keys else known
    reviews = pin(reviews.selectExpr("*", f"int(row_number() OVER (ORDER BY {order}) - 1) AS review_no"))
    total = reviews.count()
    few = not keys or total <= BROADCAST_ROWS
    long_keys = [*keys, "feature"]
    values = long_values(train, features, keys)
    spread = rank.measure(values, long_keys, "value", rows_per_bucket, train, keys, len(features))
    probs = {f"q{i}": (i, BINS) for i in range(1, BINS)}
    quantiles = rank.exact_quantiles(values, long_keys, "value", probs, spread)
    quantiles = pin(join_per_group(quantiles, reviews, keys, "inner").select("review_no", "feature", *probs))
    numbered = join_per_group(train, reviews, keys, "inner", broadcast=few)
    at_once = max(1, NUMBERS // ((1 << depth) * len(features) * BINS))
    parts = []
    for first in range(0, total, at_once):
        wanted = F.col("review_no").between(first, first + at_once - 1)
        borders: dict[int, list] = {}
        for r in quantiles.where(wanted).collect():
            of = borders.setdefault(r["review_no"], [np.zeros(0)] * len(features))
            of[features.index(r["feature"])] = np.unique([r[q] for q in probs])
        base = {r[0]: r[1] for r in reviews.where(wanted).where("base IS NOT NULL").select("review_no", "base").collect()}
        if not base:
            continue
        borders = {r: borders.get(r, [np.zeros(0)] * len(features)) for r in base}
        own = numbered.where(wanted).sortWithinPartitions("review_no")
        rows = stored(_blocks(own, features, borders, base), "bins")
        models = _grown(rows, len(features), base, trees, depth)
        discard(rows)
        flat = []
        for review, m in models.items():
            for t, n in zip(*np.nonzero((m.cover > 0) | (m.value != 0))):
                f = int(m.feature[t, n])
                border = borders[review][f] if f >= 0 else None
                cut = float(border[int(m.cut[t, n])]) if f >= 0 else 0.0
                flat.append((review, int(t), int(n), f, cut, float(m.value[t, n]), float(m.cover[t, n])))
        parts.append(pin(df.sparkSession.createDataFrame(pd.DataFrame(flat, columns=[c.split()[0] for c in NODES.split(", ")]), NODES)))
    discard(train)
    nodes = parts[0] if parts else df.sparkSession.createDataFrame([], NODES)
    for part in parts[1:]:
        nodes = nodes.unionAll(part)
    return Reviewer(reviews, nodes, features, keys, few, total, trees, depth)


def leaves(trees: Trees) -> list[dict]:
    """Every leaf as a box: per split feature on its path an interval and the share of the curvature it keeps."""
    out = []
    for t in range(len(trees.feature)):
        stack = [(0, {})]
        while stack:
            n, box = stack.pop()
            f = int(trees.feature[t, n])
            if f < 0:
                out.append({"value": float(trees.value[t, n]), "box": box})
                continue
            low, high, share = box.get(f, (-np.inf, np.inf, 1.0))
            cut = float(trees.cut[t, n])
            for child, bounds in ((2 * n + 1, (low, min(high, cut))), (2 * n + 2, (max(low, cut), high))):
                kept = share * float(trees.cover[t, child]) / float(trees.cover[t, n])
                stack.append((child, {**box, f: (*bounds, kept)}))
    return out
