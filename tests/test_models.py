import numpy as np
import pytest

from scorewatch.config import Thresholds
from scorewatch.operators import cluster, collinearity, explain
from scorewatch.operators.impute import median_imputed


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    n = 400
    a, b, c = rng.normal(size=n), rng.normal(size=n), np.round(rng.random(n), 2)
    y = (a + 0.5 * b * (c > 0.5) + rng.normal(0, 0.4, n) > 0).astype(int)
    rows = [
        (i, "train" if i % 2 else "current", float(a[i]), None if i % 29 == 0 else float(b[i]), float(c[i]), 1.0, int(y[i]))
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "entity_id int, win string, a double, b double, c double, flat double, label int").cache()


FEATURES = ["a", "b", "c", "flat"]


@pytest.fixture(scope="module")
def model(table):
    return explain.train_reviewer(table, FEATURES, "label")


def test_attributions_are_efficient(spark, table, model):
    base, packed = explain.pack_leaves(explain.leaf_table(model, spark), len(FEATURES))
    current = median_imputed(table.where("win = 'current'"), FEATURES)
    wide = explain.row_attributions(model, current, FEATURES).toPandas().set_index("entity_id")
    scored = model.transform(explain._inputs(current, FEATURES, ["entity_id"])).select("entity_id", "rawPrediction").collect()
    assert len(scored) == len(wide) == 200
    for r in scored:
        assert wide.loc[r["entity_id"]].sum() + base == pytest.approx(2 * r["rawPrediction"][1], abs=1e-9)


def test_attributions_match_subset_enumeration(spark, model):
    """Shapley values straight from their definition, on the trees walked with path-dependent expectations."""
    from itertools import combinations
    from math import factorial

    leaves = explain.leaf_table(model, spark)
    p = len(FEATURES)

    def value(x, known):
        total = 0.0
        for leaf in leaves:
            v = leaf["value"]
            for f, (low, high, share) in leaf["box"].items():
                v *= float(low < x[f] <= high) if f in known else share
            total += v
        return total

    x = np.array([[0.3, -0.7, 0.4, 1.0], [-1.0, 0.2, 0.9, 1.0]])
    got = explain.attributions(x, explain.pack_leaves(leaves, p)[1])
    for row in range(2):
        for j in range(p):
            others = [o for o in range(p) if o != j]
            phi = 0.0
            for size in range(p):
                for s in combinations(others, size):
                    w = factorial(size) * factorial(p - size - 1) / factorial(p)
                    phi += w * (value(x[row], {*s, j}) - value(x[row], set(s)))
            assert got[row, j] == pytest.approx(phi, abs=1e-9)


def test_importances(table, model):
    tree = {r["feature"]: r for r in explain.tree_attribution_importance(table, FEATURES, "label", model=model).collect()}
    assert tree["flat"]["mean_abs_shap"] == 0.0 and tree["flat"]["shap_rank"] == 4 and tree["a"]["shap_rank"] == 1
    perm = {r["feature"]: r for r in explain.permutation_importance(table, FEATURES, "label", model=model).collect()}
    assert perm["flat"]["mean_abs_shap"] == 0.0 and perm["a"]["shap_rank"] == 1 and 0 < perm["a"]["mean_abs_shap"] < 1


def test_partners_are_permutations(spark, table):
    current = table.where("win = 'current'").select("a", "c")
    # a third of all rows are copies of one row
    copies = current.unionAll(current.limit(1).selectExpr("a", "c", "explode(sequence(1, 100)) AS n").drop("n"))
    before = sorted(tuple(r) for r in copies.collect())
    for r in range(3):
        partner = explain.shuffled_partners(copies, ["a", "c"], 3).selectExpr(f"partner_{r}[0]", f"partner_{r}[1]")
        assert sorted(tuple(x) for x in partner.collect()) == before


def test_forest_can_be_explained_by_permutation(table):
    forest = explain.train_reviewer(table, FEATURES[:2], "label", kind="forest")
    rows = explain.permutation_importance(table, FEATURES[:2], "label", model=forest, repeats=2).collect()
    assert {r["shap_rank"] for r in rows} == {1, 2}


def test_vif(spark):
    rng = np.random.default_rng(2)
    a, c = rng.normal(size=100), rng.normal(size=100)
    b = 0.8 * a + rng.normal(0, 0.2, 100)
    df = spark.createDataFrame([(float(x), float(y), float(z)) for x, y, z in zip(a, b, c)], "a double, b double, c double")
    full = {r["feature"]: r for r in collinearity.feature_vif(df, ["a", "b", "c"]).collect()}
    expected = np.diag(np.linalg.inv(np.corrcoef([a, b, c])))
    assert [full[f]["vif"] for f in "abc"] == pytest.approx(list(expected))
    strict = collinearity.feature_vif(df, ["a", "b", "c"], thresholds=Thresholds(vif_medium=900, vif_high=1000))
    assert {r["vif_risk"] for r in strict.collect()} == {"Low"}
    sensitive = collinearity.feature_vif(df, ["a", "b", "c"], thresholds=Thresholds(vif_medium=1.0, vif_high=1.5))
    assert "High" in {r["vif_risk"] for r in sensitive.collect()}


def test_vif_degenerate(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 7.0, float(i * i % 13)) for i in range(30)], "a double, twice double, flat double, d double")
    got = {r["feature"]: r for r in collinearity.feature_vif(df, ["a", "twice", "flat", "d"]).collect()}
    assert all(got[f]["vif"] == float("inf") and got[f]["vif_risk"] == "High" for f in ("a", "twice", "flat"))
    assert 1.0 <= got["d"]["vif"] < 5 and "inf" in got["flat"]["vif_risk_reason"]
    assert collinearity.feature_vif(df, ["a"]).first()["vif"] == 1.0


def test_cluster_shift(spark):
    rows = [("train", float(i % 3) * 10 + (i % 7) / 100, float(i % 3)) for i in range(90)]
    rows += [("current", 20 + (i % 5) / 100, None if i == 0 else 2.0) for i in range(30)]
    df = spark.createDataFrame(rows, "win string, x double, y double")
    report = cluster.cluster_share_shift(df, ["x", "y"], seeds=range(3)).collect()
    assert len(report) == 3
    assert sum(r["train_share_pct"] for r in report) == pytest.approx(100)
    assert sum(r["current_share_pct"] for r in report) == pytest.approx(100)
    assert sum(r["share_change_pct_points"] for r in report) == pytest.approx(0, abs=1e-9)
    assert sorted(r["train_share_pct"] for r in report) == pytest.approx([100 / 3] * 3)
    assert max(r["current_share_pct"] for r in report) > 95


def test_reliability_gate(spark):
    df = spark.createDataFrame(
        [("x", 0.6, 0.5, "High"), ("y", 0.3, 0.0001, "High"), ("z", 0.9, 0.0, "Low")],
        "feature string, psi double, ks_pvalue double, drift_level string",
    )
    g = explain.reliability_gate(df).first()
    assert g["status"] == "unreliable" and [f["feature"] for f in g["severe_drift_features"]] == ["x", "y"]
    assert not g["should_skip"] and explain.reliability_gate(df, thresholds=Thresholds(drift_gate_mode="skip")).first()["should_skip"]
    calm = explain.reliability_gate(df.where("feature = 'z'")).first()
    assert calm["status"] == "reliable" and calm["severe_drift_features"] == []


def _lloyd(x, k, seeds, steps):
    """Lloyd's iteration from the bands of each start; the cheapest fit, numbered by its centres."""
    best = None
    for s in seeds:
        score = x.sum(1) / np.sqrt(x.shape[1]) if s == 0 else x[:, s - 1]
        which, before = np.searchsorted(cluster.borders(k), score, side="left"), None
        for _ in range(steps):
            centres = np.array([x[which == c].mean(0) if (which == c).any() else np.full(x.shape[1], np.nan) for c in range(k)])
            far = np.nan_to_num(((x[:, None] - centres[None]) ** 2).sum(2), nan=np.inf)
            which = far.argmin(1)
            if before is not None and np.nansum((centres - before) ** 2) <= cluster.SETTLED:
                break
            before = centres
        cost = far.min(1).sum()
        if best is None or cost < best[0]:
            best = (cost, centres)
    return np.array(sorted(best[1].tolist()))


def test_cluster_shift_of_a_fleet(spark, monkeypatch):
    """Every review against its own iteration in numpy, whatever the layout and the number of reviews iterated at once."""
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for g in (None, "a", "b", "c"):
        x = np.concatenate([rng.normal(m, 0.5, (n, 3)) for m, n in ((0, 40), (3, 25), (rng.normal(size=3) * 4, 30))])
        y = np.concatenate([rng.normal(m, 0.5, (n, 3)) for m, n in ((0, 10), (3, 35))])
        rows += [("train", g, *map(float, r)) for r in x] + [("current", g, *map(float, r)) for r in y]
        mean, std = x.mean(0), x.std(0)
        centres = _lloyd((x - mean) / std, 3, range(4), 300)
        shares = []
        for part in (x, y):
            near = (((part - mean) / std)[:, None] - centres[None]) ** 2
            shares.append(np.bincount(near.sum(2).argmin(1), minlength=3) / len(part) * 100)
        for c in range(3):
            want[g, c] = (shares[0][c], shares[1][c])
    rows.append(("current", "new", 1.0, 2.0, 3.0))  # a review without train rows
    df = spark.createDataFrame(rows, "win string, g string, x double, y double, z double")
    for parts, numbers in ((1, 2_000_000), (7, 2_000_000), (4, 1)):
        monkeypatch.setattr(cluster, "NUMBERS", numbers)
        got = cluster.cluster_share_shift(df.repartition(parts), ["x", "y", "z"], group_cols=["g"]).collect()
        assert len(got) == 15
        for r in got:
            expected = want.get((r["g"], r["cluster"]), (0, 0))
            assert (r["train_share_pct"], r["current_share_pct"]) == pytest.approx(expected)


def test_cluster_shift_of_few_points(spark):
    """Fewer different rows than clusters, constants and gaps."""
    df = spark.createDataFrame([("train", 1.0, 5.0), ("train", 1.0, None), ("current", 1.0, 5.0)], "win string, x double, y double")
    got = cluster.cluster_share_shift(df, ["x", "y"]).collect()
    assert sorted(r["train_share_pct"] for r in got) == [0, 0, 100] and sorted(r["current_share_pct"] for r in got) == [0, 0, 100]
    assert all(r["train_share_pct"] == 0 for r in cluster.cluster_share_shift(df.limit(0), ["x", "y"]).collect())


def test_vif_by_blocks(spark, monkeypatch):
    """Blocks of features against the inverse of numpy's correlations, for reviews of different size."""
    monkeypatch.setattr(collinearity, "WIDE", 2)
    monkeypatch.setattr(collinearity, "BLOCK", 4)
    rng = np.random.default_rng(4)
    names, frames = [f"f{i}" for i in range(11)], {}
    for g, n in (("a", 200), (None, 60), ("c", 40)):
        x = rng.normal(size=(n, 11)) @ rng.normal(size=(11, 11)) * 100 + 1e4
        if g == "c":
            x[:, 3] = x[:, 0] + 2 * x[:, 1]  # an exact combination
            x[:, 5] = 7.0
        frames[g] = x
    rows = [(g, *map(float, r)) for g, x in frames.items() for r in x]
    df = spark.createDataFrame(rows, "g string, " + ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["g"], r["feature"]): r["vif"] for r in collinearity.feature_vif(df, names, ["g"]).collect()}
    assert len(got) == 33
    for g in ("a", None):
        want = np.diag(np.linalg.inv(np.corrcoef(frames[g].T)))
        assert [got[g, f] for f in names] == pytest.approx(list(want), rel=1e-6)
    assert all(got["c", f] == float("inf") for f in ("f0", "f1", "f3", "f5"))
    rest = [i for i in range(11) if i not in (0, 5)]  # f0 is left out: the others span the same columns
    want = np.diag(np.linalg.inv(np.corrcoef(frames["c"][:, rest].T)))
    assert [got["c", f"f{i}"] for i in rest if i not in (1, 3)] == pytest.approx([w for i, w in zip(rest, want) if i not in (1, 3)], rel=1e-6)
    alone = {r["feature"]: r["vif"] for r in collinearity.feature_vif(df.where("g = 'a'"), names).collect()}
    assert [alone[f] for f in names] == pytest.approx([got["a", f] for f in names])


def test_vif_of_five_hundred_features(spark):
    """The plan grows with the features, not with their pairs."""
    names = [f"f{i}" for i in range(500)]
    df = spark.range(2000).selectExpr("id", *[f"double(pmod(xxhash64(id, {i}), 9973)) AS f{i}" for i in range(500)])
    got = collinearity.feature_vif(df, names)
    assert len(got._jdf.queryExecution().optimizedPlan().toString()) < 2_000_000
    rows = got.collect()
    assert len(rows) == 500 and all(1.0 <= r["vif"] < 2.0 for r in rows)


def test_cluster_steps_read_blocks(spark, monkeypatch):
    """A step reads few rows, each a block of one review and window, and only starts that still move; any block length gives the same."""
    rng = np.random.default_rng(8)
    rows = [(i % 2, "train" if i % 3 else "current", float(np.round(x, 1)), float(np.round(y, 1))) for i, (x, y) in enumerate(rng.normal(size=(600, 2)))]
    df = spark.createDataFrame(rows, "g int, win string, x double, y double").coalesce(1)
    seen, wanted, kept, sums = [], [], cluster.stored, cluster._partial_sums

    def spied(frame, name="table"):
        out = kept(frame, name)
        seen.append((out.columns, out.count(), out.selectExpr("sum(n)").first()[0], out.where("NOT train").selectExpr("sum(n)").first()[0]))
        return out

    def watched(blocks, p, centres, seeds, k, moving=None):
        if moving is not None:
            wanted.append(sum(int(m.sum()) for m in moving.values()))
            found = {(r["review_no"], r["seed"]) for r in sums(blocks, p, centres, seeds, k, moving).collect()}
            assert found == {(g, s) for g, m in moving.items() for s in np.flatnonzero(m)}
        return sums(blocks, p, centres, seeds, k, moving)

    monkeypatch.setattr(cluster, "stored", spied)
    monkeypatch.setattr(cluster, "_partial_sums", watched)
    want = sorted(map(tuple, cluster.cluster_share_shift(df, ["x", "y"], group_cols=["g"]).collect()))
    assert seen[0][0] == ["review_no", "train", "n", "cells"] and seen[0][1] < 30 and seen[0][2:] == (600, 200)
    assert wanted[0] == 6 and wanted == sorted(wanted, reverse=True) and wanted[-1] < 6
    monkeypatch.setattr(cluster, "BLOCK_BYTES", 1)  # blocks of 64 rows
    assert sorted(map(tuple, cluster.cluster_share_shift(df, ["x", "y"], group_cols=["g"]).collect())) == want
