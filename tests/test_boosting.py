"""Grouped boosting: trees, attributions and permutation importance of several reviews at once."""

import numpy as np
import pytest

from scorewatch.operators import boosting, explain
from scorewatch.operators.impute import median_imputed

FEATURES = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    rows = []
    for g, n in (("x", 400), (None, 300), ("tiny", 3)):
        a, b, c = rng.normal(size=n), rng.normal(size=n), np.round(rng.random(n), 2)
        y = (a * (1 if g == "x" else -1) + 0.5 * b * (c > 0.5) + rng.normal(0, 0.4, n) > 0).astype(int)
        rows += [
            (g, len(rows) + i, "train" if i % 2 else "current", float(a[i]), None if i % 29 == 0 else float(b[i]), float(c[i]), 1.0, int(y[i]))
            for i in range(n)
        ]
    rows.append(("new", -1, "current", 1.0, 1.0, 1.0, 1.0, 1))  # a review without train rows
    schema = "g string, entity_id int, win string, a double, b double, c double, flat double, label int"
    return spark.createDataFrame(rows, schema).cache()


@pytest.fixture(scope="module")
def reviewer(table):
    return boosting.fit(table, FEATURES, "label", ["g"], "entity_id", trees=5)


def _nodes(reviewer):
    return sorted(tuple(r) for r in reviewer.nodes.collect())


def test_first_tree_by_hand(table, reviewer):
    """The root of every first tree against all cuts of all features, on the sampled rows."""
    train = median_imputed(table.where("win = 'train'"), FEATURES, ["g"])
    numbered = reviewer.numbered(train).selectExpr("*", f"xxhash64(entity_id, {', '.join(FEATURES)}) AS h").toPandas()
    chosen = np.random.default_rng([boosting.SEED, 0]).permutation(4)[:3]
    for review, own in numbered.groupby("review_no"):
        base = float(own["base"].iloc[0])
        own = own[boosting.mixed(own["h"].to_numpy(), boosting.SEED) < np.uint64(int(0.9 * (1 << 64)))]
        p = 1 / (1 + np.exp(-base))
        g, h = p - own["label"].to_numpy(), np.full(len(own), max(p * (1 - p), 1e-6))
        best = 0.0
        every = numbered[numbered["review_no"] == review]
        for f in sorted(chosen):
            x = own[FEATURES[f]].to_numpy()
            for cut in np.unique(np.quantile(every[FEATURES[f]], np.arange(1, 32) / 32)):
                left = x <= cut
                if h[left].sum() >= 1 and h[~left].sum() >= 1:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)
                    best = max(best, gain)
        root = reviewer.models(review, review + 1)[review][1]
        f = int(root.feature[0, 0])
        if best <= 1e-6:
            assert f < 0
            continue
        left = own[FEATURES[f]].to_numpy() <= root.cut[0, 0]
        gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left)) - g.sum() ** 2 / (h.sum() + 1)
        assert gain == pytest.approx(best, rel=1e-4) and root.cover[0, 0] == pytest.approx(h.sum(), rel=1e-5)


def test_trees_do_not_depend_on_the_layout(table, reviewer, monkeypatch):
    monkeypatch.setattr(boosting, "KEPT_TREES", 2)
    want = _nodes(reviewer)
    for parts in (1, 13):
        assert _nodes(boosting.fit(table.repartition(parts), FEATURES, "label", ["g"], "entity_id", trees=5)) == want
    monkeypatch.setattr(boosting, "NUMBERS", 1)  # reviews one after the other
    one = boosting.fit(table, FEATURES, "label", ["g"], "entity_id", trees=2)
    assert _nodes(one) == [n for n in want if n[1] < 2] and len(list(one.ranges())) == 4


def test_a_review_alone_has_the_same_trees(table, reviewer):
    alone = boosting.fit(table.where("g = 'x'"), FEATURES, "label", (), "entity_id", trees=5)
    no = reviewer.reviews.where("g = 'x'").first()["review_no"]
    assert [n[1:] for n in _nodes(alone)] == [n[1:] for n in _nodes(reviewer) if n[0] == no]


def test_attributions_add_up(table, reviewer):
    current = median_imputed(table.where("win = 'current'"), FEATURES, ["g"])
    wide = explain.attributed_rows(reviewer, current)
    assert wide.columns == ["g", "entity_id", *FEATURES, *[f"phi_{f}" for f in FEATURES]]
    total = "+".join(f"phi_{f}" for f in FEATURES)
    rows = explain.with_margins(reviewer, reviewer.numbered(wide)).selectExpr(f"abs({total} + attribution_base - margin) AS gap").collect()
    assert len(rows) == 352 and max(r["gap"] for r in rows) < 1e-9
    long = explain.long_attributions(wide, FEATURES, ["g", "entity_id"])
    assert long.columns == ["g", "entity_id", "feature", "value", "attribution"] and long.count() == 4 * 352
    assert long.where("feature = 'flat' AND (value <> 1.0 OR attribution <> 0.0)").count() == 0


def test_importances_of_a_fleet(table, reviewer):
    tree = {(r["g"], r["feature"]): r for r in explain.tree_attribution_importance(table, FEATURES, "label", model=reviewer, group_cols=["g"]).collect()}
    assert {k[0] for k in tree} == {"x", None, "tiny"} and len(tree) == 12
    for g in ("x", None):
        assert tree[g, "a"]["shap_rank"] == 1 and tree[g, "flat"]["mean_abs_shap"] == 0.0
    perm = {(r["g"], r["feature"]): r for r in explain.permutation_importance(table, FEATURES, "label", reviewer, group_cols=["g"]).collect()}
    assert len(perm) == 12 and perm["x", "a"]["shap_rank"] == 1 and 0 < perm["x", "a"]["mean_abs_shap"] < 1
    assert all(perm[g, "flat"]["mean_abs_shap"] == 0.0 for g in ("x", None, "tiny"))


def test_permutation_by_hand(table, reviewer):
    """Counts from the same partners, every shuffled row walked anew; equal for any layout."""
    got = {r["feature"]: r["mean_abs_shap"] for r in explain.permutation_importance(table, FEATURES, "label", reviewer, 2, group_cols=["g"]).where("g = 'x'").collect()}
    again = explain.permutation_importance(table.repartition(9), FEATURES, "label", reviewer, 2, group_cols=["g"]).where("g = 'x'").collect()
    assert {r["feature"]: r["mean_abs_shap"] for r in again} == got
    current = median_imputed(table.where("win = 'current'"), FEATURES, ["g"])
    rows = reviewer.numbered(current).select("review_no", "entity_id", *FEATURES)
    no = reviewer.reviews.where("g = 'x'").first()["review_no"]
    paired = explain.shuffled_partners(rows, FEATURES, 2, ["review_no"], ["entity_id"]).where(f"review_no = {no}").collect()
    base, trees = reviewer.models(no, no + 1)[no]
    x = np.array([r["cells"] for r in paired])
    sign = base + trees.margins(x, 3) > 0
    for j, f in enumerate(FEATURES):
        changed = 0
        for r in range(2):
            y = x.copy()
            y[:, j] = [p[f"partner_{r}"][j] for p in paired]
            changed += ((base + trees.margins(y, 3) > 0) != sign).sum()
        assert got[f] == pytest.approx(changed / (2 * len(x)))


def test_passes_read_blocks(table, reviewer, monkeypatch):
    """A pass reads few rows, each a block of one review; blocks of any length give the same trees."""
    seen, kept = [], boosting.stored

    def spied(df, name="table"):
        out = kept(df, name)
        if name in ("bins", "margins"):
            seen.append((out.columns, out.count(), out.selectExpr("sum(length(margins) / 8)").first()[0]))
        return out

    monkeypatch.setattr(boosting, "stored", spied)
    monkeypatch.setattr(boosting, "KEPT_TREES", 3)
    assert _nodes(boosting.fit(table.coalesce(1), FEATURES, "label", ["g"], "entity_id", trees=5)) == _nodes(reviewer)
    assert len(seen) == 2
    for columns, blocks, rows in seen:
        assert columns == boosting.BLOCK_COLUMNS and rows == 351 and blocks < 40
    monkeypatch.setattr(boosting, "BLOCK_BYTES", 1)  # blocks of 64 rows
    assert _nodes(boosting.fit(table, FEATURES, "label", ["g"], "entity_id", trees=5)) == _nodes(reviewer)


def test_codes_are_the_walk(reviewer):
    """The node of every row against a walk from the root, for all trees and depths; missing cells go left."""
    rng = np.random.default_rng(5)
    cells = rng.normal(size=(200, 4))
    cells[::17, 1] = np.nan
    for _, trees in reviewer.models(0, reviewer.total).values():
        for t in range(5):
            for depth in range(4):
                want = []
                for row in cells:
                    n = 0
                    for _ in range(depth):
                        f = trees.feature[t, n]
                        n = n if f < 0 else 2 * n + (2 if row[f] > trees.cut[t, n] else 1)
                    want.append(n)
                assert trees.nodes(t, cells, depth).tolist() == want
                assert trees.outputs(t, cells, depth).tolist() == trees.value[t][want].tolist()


def test_tables_are_the_walk(reviewer):
    """Outputs and attributions by table against the walk and the sum over leaves; infinite cells too."""
    rng = np.random.default_rng(9)
    cells = rng.normal(size=(300, 4))
    cells[::31, 0], cells[::37, 1] = np.inf, -np.inf
    for _, trees in reviewer.models(0, reviewer.total).values():
        levels = boosting.levels_of(trees, 4)
        cells[: len(levels[0]), 0] = levels[0]  # at the cuts
        grids = [boosting.grid(f, c, 3, levels) for f, c in zip(trees.feature, trees.cut)]
        tables = boosting.Tables.of([g[0] for g in grids], [v[g[1]] for g, v in zip(grids, trees.value)])
        missing = np.where(rng.random(cells.shape) < 0.1, np.nan, cells)
        for x in (cells, missing):
            assert tables.margins(boosting.intervals(levels, x), 300).tolist() == trees.margins(x, 3).tolist()
        finite = np.where(cells == -np.inf, -1e300, cells)
        want = explain.attributions(finite, explain.pack_leaves(boosting.leaves(trees), 4)[1])
        for depth in (3, boosting.TABLED_DEPTH + 1):
            assert np.abs(explain.Explained(trees, 4, depth).of(finite) - want).max() < 1e-12
        assert np.abs(explain.Explained(trees, 4, 3).of(cells) - want).max() < 1e-12  # -inf goes left as in the walk
        for f in range(4):
            new = rng.permutation(cells[:, f])
            outputs = [explain.Shuffled(trees, 4, d) for d in (3, boosting.TABLED_DEPTH + 1)]
            assert (outputs[0].start(cells) == np.stack([trees.outputs(t, cells, 3) for t in range(5)])).all()
            y = cells.copy()
            y[:, f] = new
            got = np.stack(list(outputs[0].exchanged(f, new, range(5))))
            assert (got == np.stack([trees.outputs(t, y, 3) for t in range(5)])).all()


def test_passes_count_the_smaller_child(table, reviewer, monkeypatch):
    """One child of a split is counted, at most half of its curvature; sums added up by review before they are sent change nothing."""
    seen, counted = [], boosting._histogram

    def spied(*args):
        out = counted(*args)
        seen.append((args[7], {r: w.copy() for r, w in args[5].items()}, {r: s[1, 0].sum() for r, s in out.items()}))
        return out

    monkeypatch.setattr(boosting, "_histogram", spied)
    assert _nodes(boosting.fit(table, FEATURES, "label", ["g"], "entity_id", trees=5)) == _nodes(reviewer)
    root = {}
    for level, wanted, sums in seen:
        root = sums if not level else root
        for r, w in wanted.items():
            assert not level or not (w[::2] & w[1::2]).any()
            assert not level or 2 * sums.get(r, 0) <= root[r]
    monkeypatch.setattr(boosting, "SENT", 0)
    assert _nodes(boosting.fit(table, FEATURES, "label", ["g"], "entity_id", trees=5)) == _nodes(reviewer)


def test_deeper_trees_are_walked(table):
    deep = boosting.fit(table, FEATURES, "label", ["g"], "entity_id", trees=3, depth=4)
    current = median_imputed(table.where("win = 'current'"), FEATURES, ["g"])
    wide = explain.attributed_rows(deep, current)
    total = "+".join(f"phi_{f}" for f in FEATURES)
    rows = explain.with_margins(deep, deep.numbered(wide)).selectExpr(f"abs({total} + attribution_base - margin) AS gap").collect()
    assert len(rows) == 352 and max(r["gap"] for r in rows) < 1e-9
