"""Feature importance of a boosted-tree reviewer: exact tree attributions, or permutation importance."""

from __future__ import annotations

import sys
from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Thresholds
from ..functions.clean import number_sql
from ..functions.text import quote
from ..session import bounded, checkpoints, join_per_group, shared_path
from . import boosting, rank
from .boosting import TABLED_DEPTH, Tables, grid, intervals, leaves, levels_of, own_rows  # by name: tasks get these, not the module
from .impute import median_imputed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
REPEATS = 5
ROWS_PER_SHUFFLE_BUCKET = 100_000
ROWS_PER_TASK = 50_000
# Reviews whose tables a task holds.
HELD = 64


def _inputs(df: DataFrame, features, extra=()) -> DataFrame:
    vector = f"array({', '.join(f'`{f}`' for f in features)}) AS cells"
    return df.selectExpr(*extra, vector).withColumn("features", array_to_vector("cells")).drop("cells")


def train_reviewer(df: DataFrame, features, target: str, kind: str = "boosted", rows_per_bucket=rank.ROWS_PER_BUCKET):
    """Fit the reviewing model on the train window: boosted trees, or a random forest."""
    train = median_imputed(df.where("win = 'train'"), features, rows_per_bucket=rows_per_bucket)
    label = f"double(int(coalesce({number_sql(target)}, 0.0D))) AS label"
    data = _inputs(train.selectExpr(label, *[f"`{f}`" for f in features]), features, ["label"])
    checkpoints(df.sparkSession)  # boosting cuts its lineage there
    # every tree level is a job: a small window should not be cut into many tiny tasks
    data = data.coalesce(max(1, data.count() // ROWS_PER_TASK))
    if kind == "forest":
        return RandomForestClassifier(numTrees=120, maxDepth=5, seed=SEED).fit(data)
    return GBTClassifier(maxIter=80, maxDepth=3, stepSize=0.06, subsamplingRate=0.9, seed=SEED).fit(data)


# ---------------------------------------------------------------- exact tree attributions


def leaf_table(model: GBTClassificationModel, spark) -> list[dict]:
    """Every leaf as a box: per split feature on its path an interval and the share of training rows it keeps.

    Reads the node table Spark saves with the model: at most trees * 2^(depth + 1) rows, whatever the data size.
    """
    path = shared_path(spark, "reviewer")
    model.save(path)
    weights = list(model.treeWeights)
    trees: dict[int, dict] = {}
    for row in spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    leaves = []
    for tree, nodes in trees.items():
        stack = [(nodes[0], {})]
        while stack:
            node, box = stack.pop()
            if node["leftChild"] < 0:
                leaves.append({"value": 2.0 * weights[tree] * node["prediction"], "box": box})
                continue
            feature, cut = node["split"]["featureIndex"], node["split"]["leftCategoriesOrThreshold"][0]
            low, high, share = box.get(feature, (-np.inf, np.inf, 1.0))
            for child_id, bounds in (
                (node["leftChild"], (low, min(high, cut))),
                (node["rightChild"], (max(low, cut), high)),
            ):
                child = nodes[child_id]
                kept = share * child["rawCount"] / node["rawCount"]
                stack.append((child, {**box, feature: (*bounds, kept)}))
    return leaves


def pack_leaves(leaves: list[dict], n_features: int) -> tuple[float, list[tuple]]:
    """Base margin, and per number of path features the leaves as arrays."""
    base, packed = 0.0, []
    for leaf in leaves:
        base += leaf["value"] * float(np.prod([z for _, _, z in leaf["box"].values()]))
    for m in sorted({len(leaf["box"]) for leaf in leaves} - {0}):
        group = [leaf for leaf in leaves if len(leaf["box"]) == m]
        feature = np.array([list(leaf["box"]) for leaf in group])
        bounds = np.array([list(leaf["box"].values()) for leaf in group], dtype=float)
        value = np.array([leaf["value"] for leaf in group])
        target = [np.eye(n_features)[feature[:, s]] for s in range(m)]
        packed.append((m, feature, bounds[:, :, 0], bounds[:, :, 1], bounds[:, :, 2], value, target))
    return base, packed


def attributions(x: np.ndarray, packed: list[tuple]) -> np.ndarray:
    """Shapley value of every feature on the log-odds margin, rows x features.

    A leaf pays its value when all its path features are met; an absent feature is met with the share of
    training rows it keeps. Within a leaf only its own (at most depth) features play, so the exact value is a
    sum over their few subsets.
    """
    out = np.zeros(x.shape)
    for m, feature, low, high, share, value, target in packed:
        cells = x[:, feature]
        met = ((cells > low) & (cells <= high)).astype(float)
        for s in range(m):
            others = [o for o in range(m) if o != s]
            weight = np.zeros((x.shape[0], len(value)))
            for size in range(m):
                coefficient = factorial(size) * factorial(m - size - 1) / factorial(m)
                for present in combinations(others, size):
                    term = np.full(weight.shape, coefficient)
                    for o in others:
                        term = term * (met[:, :, o] if o in present else share[:, o])
                    weight += term
            out += (value * (met[:, :, s] - share[:, s]) * weight) @ target[s]
    return out


def row_attributions(model, df: DataFrame, features, keep=("entity_id",)) -> DataFrame:
    """Wide table: `keep`, then one attribution column per feature. Rows are streamed in Arrow batches."""
    features, keep = list(features), list(keep)
    packed = pack_leaves(leaf_table(model, df.sparkSession), len(features))[1]

    def explain(batches):
        for batch in batches:
            for start in range(0, len(batch), 2048):
                part = batch.iloc[start : start + 2048]
                values = attributions(part[features].to_numpy(dtype=float), packed)
                yield pd.concat(
                    [part[keep].reset_index(drop=True), pd.DataFrame(values, columns=[f"phi_{f}" for f in features])], axis=1
                )

    inputs = df.select(*keep, *features)
    schema = ", ".join(
        [f"`{k}` {inputs.schema[k].dataType.simpleString()}" for k in keep] + [f"`phi_{f}` double" for f in features]
    )
    return inputs.mapInPandas(explain, schema)


def attributed_rows(reviewer: boosting.Reviewer, df: DataFrame, keep=("entity_id",)) -> DataFrame:
    """Review keys, `keep`, the features and one column phi_<feature> per feature, for rows of all reviews with a model.

    Rows are streamed in Arrow batches; a task holds the trees of as many reviews as fit its bound.
    """
    features = reviewer.features
    own = [*reviewer.group_cols, *[k for k in keep if k not in reviewer.group_cols]]
    rows = reviewer.numbered(df).select("review_no", *own, *[F.expr(f"double(`{f}`) AS `{f}`") for f in features])
    phis = [f"phi_{f}" for f in features]
    schema = ", ".join(
        [*[f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in [*own, *features]], *[f"`{c}` double" for c in phis]]
    )
    out = None
    for first, end in reviewer.ranges():
        part = rows.where(F.col("review_no").between(first, end - 1)).mapInPandas(
            _explaining(reviewer.models(first, end), features, [*own, *features], phis, reviewer.depth), schema
        )
        out = part if out is None else out.unionAll(part)
    return df.sparkSession.createDataFrame([], schema) if out is None else out


class Explained:
    """The attributions of a review's rows: in every tree those of the row's cell, worked out once for each cell."""

    def __init__(self, trees, p: int, depth: int):
        self.levels, self.packed = levels_of(trees, p), None
        if depth > TABLED_DEPTH:  # too many cells
            self.packed = pack_leaves(leaves(trees), p)[1]
            return
        added, tables = [], []
        for t in range(len(trees.feature)):
            own, ends, axes = grid(trees.feature[t], trees.cut[t], depth, self.levels)
            if axes:
                x = np.zeros((len(ends), p))
                for f, (step, count, cuts) in axes.items():
                    x[:, f] = np.append(cuts, np.inf)[np.arange(len(ends)) // step % count]
                added.append(own)
                tables.append(attributions(x, pack_leaves(leaves(trees.part(t, t + 1)), p)[1]))
        self.tables = Tables.of(added, tables)

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(x.shape)
        if self.packed is not None:
            for start in range(0, len(x), 2048):
                out[start : start + 2048] = attributions(x[start : start + 2048], self.packed)
            return out
        sums = self.tables.sums(intervals(self.levels, x), len(x))
        for t in range(len(self.tables.values)):
            out += self.tables.outputs(t, sums)
        return out


def _explaining(models, features, kept, phis, depth: int):
    def explain(batches):
        packs: dict[int, Explained] = {}
        for batch in batches:
            cells, known = batch[features].to_numpy(dtype=float), batch["review_no"].isin(models).to_numpy()
            values = np.zeros(cells.shape)
            for review, rows in own_rows(batch, models):
                if review not in packs:
                    if len(packs) >= HELD:
                        packs.clear()
                    packs[review] = Explained(models[review][1], len(features), depth)
                values[rows] = packs[review].of(cells[rows])
            yield pd.concat([batch[kept].reset_index(drop=True), pd.DataFrame(values, columns=phis)], axis=1)[known]

    return explain


def with_margins(reviewer: boosting.Reviewer, rows: DataFrame) -> DataFrame:
    """Rows (with review_no and the features) with their `margin`, and the `attribution_base` of their review."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema] + ["margin double, attribution_base double"])
    out = None
    for first, end in reviewer.ranges():
        walk = _walking(reviewer.models(first, end), reviewer.features, reviewer.depth)
        part = rows.where(F.col("review_no").between(first, end - 1)).mapInPandas(walk, schema)
        out = part if out is None else out.unionAll(part)
    return rows.sparkSession.createDataFrame([], schema) if out is None else out


def _walking(models, features, depth: int):
    def walk(batches):
        bases: dict[int, float] = {}
        for batch in batches:
            cells, margin, start = batch[features].to_numpy(dtype=float), np.zeros(len(batch)), np.zeros(len(batch))
            for review, own in own_rows(batch, models):
                base, trees = models[review]
                if review not in bases:
                    bases[review] = base + pack_leaves(leaves(trees), len(features))[0]
                margin[own], start[own] = base + trees.margins(cells[own], depth), bases[review]
            yield batch.assign(margin=margin, attribution_base=start)

    return walk


def long_attributions(wide: DataFrame, features, keep=("entity_id",)) -> DataFrame:
    """Rows (keep..., feature, value, attribution) of a table with the features and their attributions side by side."""
    cells = ", ".join(f"{quote(f)}, `{f}`, `phi_{f}`" for f in features)
    return wide.selectExpr(*[f"`{k}`" for k in keep], f"stack({len(features)}, {cells}) AS (feature, value, attribution)")


def ranked_importance(importance: DataFrame, group_cols=()) -> DataFrame:
    """Rank 1..n by importance: one row per feature."""
    partition = ", ".join(f"`{g}`" for g in group_cols) or "1"
    return importance.selectExpr(
        "*",
        f"row_number() OVER (PARTITION BY {partition} ORDER BY mean_abs_shap DESC, feature) AS shap_rank",
        "mean_abs_shap AS mean_abs_shap_value",
    )


def tree_attribution_importance(
    df: DataFrame,
    features,
    target: str,
    entity="entity_id",
    model=None,
    rows_per_bucket=rank.ROWS_PER_BUCKET,
    group_cols=(),
) -> DataFrame:
    """Mean absolute attribution per review and feature over all current rows, ranked.

    model: a `boosting.Reviewer` (fitted here where none is given), or a Spark boosted-tree model of one review.
    """
    features, keys = list(features), list(group_cols)
    current = df.where("win = 'current'")
    if isinstance(model, GBTClassificationModel):
        filled = median_imputed(current, features, rows_per_bucket=rows_per_bucket)
        wide = row_attributions(model, filled, features, [entity])
        means = wide.agg(*[F.expr(f"avg(abs(`phi_{f}`)) AS `{f}`") for f in features])
        return ranked_importance(means.unpivot([], features, "feature", "mean_abs_shap"))
    reviewer = model or boosting.fit(df, features, target, keys, entity, rows_per_bucket)
    wide = attributed_rows(reviewer, median_imputed(current, features, keys, rows_per_bucket=rows_per_bucket), [])
    means = wide.groupBy(*keys).agg(*[F.expr(f"avg(abs(`phi_{f}`)) AS `{f}`") for f in features])
    if keys:  # a review without current rows has importances of 0
        means = join_per_group(reviewer.reviews.where("base IS NOT NULL").select(*keys), means, keys).fillna(0.0, features)
    return ranked_importance(means.unpivot(keys, features, "feature", "mean_abs_shap"), keys)


# ---------------------------------------------------------------- permutation importance


def shuffled_partners(df: DataFrame, features, repeats: int = REPEATS, group_cols=(), entity=()) -> DataFrame:
    """Give every row, per repeat, the feature cells of another random row of its group; each row is handed out once.

    Rows fall into random buckets of equal size and each repeat passes the cells on along its own random order
    of a bucket. One shuffle serves all repeats. Hashes are of the row's own values (`entity` columns too, which tell
    copies apart), so any layout of the rows gives the same pairs.
    """
    keys = [f"`{g}`" for g in group_cols]
    cells = ", ".join(f"`{f}`" for f in features)
    sizes = df.groupBy(*group_cols).agg(F.expr(f"greatest(1, count(*) div {ROWS_PER_SHUFFLE_BUCKET}) AS buckets"))
    sized, few = bounded(sizes, group_cols)
    placed = join_per_group(df, sized, group_cols, "inner", broadcast=few)
    salt = ", ".join(["cells", *[f"`{e}`" for e in entity]])
    placed = placed.selectExpr(*keys, *[f"`{e}`" for e in entity], "buckets", f"array({cells}) AS cells").selectExpr(
        "*", f"pmod(xxhash64({SEED}, {salt}), buckets) AS bucket"
    )
    partners = []
    for r in range(repeats):
        order = f"PARTITION BY {', '.join([*keys, 'bucket'])} ORDER BY xxhash64({SEED + 1 + r}, {salt}), {salt}"
        first = f"first_value(cells) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        partners.append(f"coalesce(lead(cells) OVER ({order}), {first}) AS partner_{r}")
    return placed.selectExpr(*keys, "cells", *partners)


def permutation_importance(
    df: DataFrame,
    features,
    target: str,
    model=None,
    repeats: int = REPEATS,
    rows_per_bucket=rank.ROWS_PER_BUCKET,
    group_cols=(),
    entity: str = "entity_id",
) -> DataFrame:
    """Mean accuracy drop against the model's own predictions when one feature is shuffled, over all current rows.

    A row's trees are walked once; for a shuffled feature only the trees that use it are walked again, and a batch sends
    one count per review, feature and repeat. model: a `boosting.Reviewer`, or a Spark model of one review.
    """
    features, keys = list(features), list(group_cols)
    if model is not None and not isinstance(model, boosting.Reviewer):
        return _permuted_by_model(df, features, model, repeats, rows_per_bucket)
    reviewer = model or boosting.fit(df, features, target, keys, entity, rows_per_bucket)
    current = median_imputed(df.where("win = 'current'"), features, keys, rows_per_bucket=rows_per_bucket)
    own = [entity] if entity in current.columns and entity not in features else []
    rows = reviewer.numbered(current).select("review_no", *own, *[F.expr(f"double(`{f}`) AS `{f}`") for f in features])
    paired = shuffled_partners(rows, features, repeats, ["review_no"], own)
    counts = None
    for first, end in reviewer.ranges():
        part = paired.where(F.col("review_no").between(first, end - 1)).mapInPandas(
            _counting(reviewer.models(first, end), len(features), repeats, reviewer.depth),
            "review_no int, feature_no int, changed long, n long",
        )
        counts = part if counts is None else counts.unionAll(part)
    names = ", ".join(quote(f) for f in features)
    drops = counts.groupBy("review_no", "feature_no").agg(F.expr(f"sum(changed) / (sum(n) * {repeats}D) AS mean_abs_shap"))
    every = reviewer.reviews.where("base IS NOT NULL").selectExpr(
        *[f"`{g}`" for g in keys], "review_no", f"posexplode(array({names})) AS (feature_no, feature)"
    )
    found = every.join(drops, ["review_no", "feature_no"], "left").fillna(0.0, ["mean_abs_shap"])
    return ranked_importance(found.select(*keys, "feature", "mean_abs_shap"), keys)


class Shuffled:
    """The outputs of a review's trees for rows, and for the same rows with one feature's cells exchanged."""

    def __init__(self, trees, p: int, depth: int):
        self.trees, self.depth, self.levels = trees, depth, levels_of(trees, p)
        self.tables = None
        if depth <= TABLED_DEPTH:
            grids = [grid(f, c, depth, self.levels) for f, c in zip(trees.feature, trees.cut)]
            self.tables = Tables.of([g[0] for g in grids], [v[g[1]] for g, v in zip(grids, trees.value)])

    def start(self, x: np.ndarray) -> np.ndarray:
        """Outputs, trees x rows."""
        self.x = np.asfortranarray(x)
        if self.tables is None:
            return np.stack([self.trees.outputs(t, self.x, self.depth) for t in range(len(self.trees.feature))])
        self.places = intervals(self.levels, self.x)
        self.sums = self.tables.sums(self.places, len(x))
        return np.stack([self.tables.outputs(t, self.sums) for t in range(len(self.tables.values))])

    def exchanged(self, j: int, cells: np.ndarray, using):
        """Outputs of the trees in `using`, one after the other, with `cells` as feature j."""
        if self.tables is None:
            y = self.x.copy(order="F")
            y[:, j] = cells
            yield from (self.trees.outputs(t, y, self.depth) for t in using)
            return
        place = np.where(np.isnan(cells), 0, np.searchsorted(self.levels[j], cells))
        sums = [
            total + word[j][place] - word[j][self.places[j]] if j in word else total
            for total, word in zip(self.sums, self.tables.added)
        ]
        yield from (self.tables.outputs(t, sums) for t in using)


def _counting(models, p: int, repeats: int, depth: int):
    def count(batches):
        packs: dict[int, Shuffled] = {}
        for batch in batches:
            cells = np.stack(batch["cells"].to_numpy()) if len(batch) else np.zeros((0, p))
            partners = [np.stack(batch[f"partner_{r}"].to_numpy()) for r in range(repeats)] if len(batch) else []
            out = []
            for review, rows in own_rows(batch, models):
                base, trees = models[review]
                if review not in packs:
                    if len(packs) >= HELD:
                        packs.clear()
                    packs[review] = Shuffled(trees, p, depth)
                outputs = packs[review].start(cells[rows])
                margin = base + outputs.sum(0)
                for j in range(p):
                    using = np.flatnonzero((trees.feature == j).any(1))
                    rest = margin - outputs[using].sum(0)
                    changed = 0
                    for r in range(repeats):
                        if len(using):
                            again = rest + sum(packs[review].exchanged(j, partners[r][rows, j], using), np.zeros(len(rows)))
                            changed += int(((again > 0) != (margin > 0)).sum())
                    out.append((review, j, changed, len(rows)))
            if out:
                yield pd.DataFrame(out, columns=["review_no", "feature_no", "changed", "n"])

    return count


def _permuted_by_model(df: DataFrame, features, model, repeats: int, rows_per_bucket) -> DataFrame:
    """The same for a Spark model: every shuffled row is scored anew."""
    current = median_imputed(df.where("win = 'current'"), features, rows_per_bucket=rows_per_bucket)
    paired = shuffled_partners(current.select(*features), features, repeats)
    # case 0 is the untouched row; case 1 + r * p + j has feature j taken from the partner of repeat r
    cases = ["cells"]
    for r in range(repeats):
        for j in range(len(features)):
            mixed = ", ".join(f"partner_{r}[{j}]" if i == j else f"cells[{i}]" for i in range(len(features)))
            cases.append(f"array({mixed})")
    own = model.transform(paired.withColumn("features", array_to_vector("cells"))).selectExpr(
        "prediction AS own", f"posexplode(array({', '.join(cases[1:])})) AS (case_no, cells)"
    )
    scored = model.transform(own.withColumn("features", array_to_vector("cells"))).selectExpr(
        f"case_no % {len(features)} AS feature_no", "double(prediction <> own) AS changed"
    )
    names = ", ".join(quote(f) for f in features)
    drops = scored.groupBy("feature_no").agg(F.expr("abs(avg(changed)) AS mean_abs_shap"))
    return ranked_importance(drops.selectExpr(f"array({names})[feature_no] AS feature", "mean_abs_shap"))


def label_correlation_importance(df: DataFrame, features, target: str, group_cols=()) -> DataFrame:
    """A cheap stand-in importance: |correlation| of each feature with the target on the train window."""
    y = number_sql(target)
    names = [(f, number_sql(f)) for f in features]
    pairs = [
        # deviations over the rows where both are present, as a correlation takes them
        (f, v, f"CASE WHEN {v} IS NOT NULL THEN {y} END", f"CASE WHEN {y} IS NOT NULL THEN {v} END") for f, v in names
    ]
    wide = df.where("win = 'train'").groupBy(*group_cols).agg(
        *[
            F.expr(
                f"coalesce(abs(try_divide(covar_pop({v}, {y}), stddev_pop({own}) * stddev_pop({other}))), 0.0D) AS `{f}`"
            )
            for f, v, other, own in pairs
        ]
    )
    return ranked_importance(wide.unpivot(list(group_cols), list(features), "feature", "mean_abs_shap"), group_cols)


# ---------------------------------------------------------------- reliability of explanations


def reliability_gate(drift: DataFrame, group_cols=(), thresholds: Thresholds = Thresholds()) -> DataFrame:
    """Whether severe drift of a High-drift feature makes explanations unreliable, and which features do so."""
    t = thresholds
    severe = f"drift_level = 'High' AND (psi >= {t.severe_psi}D OR ks_pvalue < {t.severe_ks_pvalue}D)"
    why = "'PSI or KS p-value crossed configured severe drift gate.'"
    # one struct per severe feature of a review
    gate = drift.groupBy(*group_cols).agg(
        F.expr(f"count_if({severe}) AS severe_features"),
        F.expr(
            f"sort_array(collect_list(CASE WHEN {severe} THEN struct(feature, psi, ks_pvalue, {why} AS reason) END))"
            " AS severe_drift_features"
        ),
    )
    skip = str(t.drift_gate_mode == "skip").lower()
    return gate.selectExpr(
        *[f"`{g}`" for g in group_cols],
        "CASE WHEN severe_features > 0 THEN 'unreliable' ELSE 'reliable' END AS status",
        f"{quote(t.drift_gate_mode)} AS gate_mode",
        f"severe_features > 0 AND {skip} AS should_skip",
        "severe_features",
        "severe_drift_features",
        "CASE WHEN severe_features > 0 THEN 'SHAP outputs are directional only because severe input drift was found.'"
        " ELSE 'No severe drift gate was triggered.' END AS message",
    )
