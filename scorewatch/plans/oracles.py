"""The same results as ANSI-style SQL over the raw tables, for DuckDB. Built independently of the operators."""

from __future__ import annotations

from dataclasses import fields
from statistics import NormalDist

from ..config import PATHS, Thresholds
from ..sources.review_views import (
    FEATURES,
    REVIEW_BASE,
    REVIEW_CONFIGS,
    REVIEW_FEATURES,
    REVIEW_FEEDBACK,
    REVIEW_MODEL_FEEDBACK,
    REVIEW_MODEL_RUNS,
    REVIEW_PREDICTIONS,
    REVIEW_RUNS,
)


def _inverse_correlation() -> list[str]:
    """CTE `vif`: the diagonal of each group's inverse correlation matrix, by sweeping one feature after the other."""
    p = len(FEATURES)
    cells = [(i, j) for i in range(p) for j in range(p)]
    first = ", ".join("1.0 AS a{0}{0}".format(i) if i == j else f"corr({FEATURES[i]}, {FEATURES[j]}) AS a{i}{j}" for i, j in cells)
    out = [f"sweep0 AS (SELECT g, {first} FROM feats WHERE win = 'train' GROUP BY g)"]
    for k in range(p):
        terms = []
        for i, j in cells:
            if i == k and j == k:
                term = f"-1 / a{k}{k}"
            elif i == k or j == k:
                term = f"a{i}{j} / a{k}{k}"
            else:
                term = f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k}"
            terms.append(f"{term} AS a{i}{j}")
        out.append(f"sweep{k + 1} AS (SELECT g, {', '.join(terms)} FROM sweep{k})")
    rows = " UNION ALL ".join(f"SELECT g, '{f}' AS feature, -a{i}{i} AS vif FROM sweep{p}" for i, f in enumerate(FEATURES))
    return [*out, f"vif AS ({rows})"]


def _lerp(lo: str, hi: str, t: str) -> str:
    return f"CASE WHEN {t} >= 0.5 THEN {hi} - ({hi} - {lo}) * (1 - ({t})) ELSE {lo} + ({hi} - {lo}) * ({t}) END"


def _r(expr: str, name: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 6) + 0.0 AS {name}"


def _at_ranks(source: str, positions: str, out: str, keys: str = "g, feature") -> str:
    """CTE `out`: interpolated value of every fractional position, from a numbered source (keys, value, rn)."""
    on = " AND ".join(f"{{0}}.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return (
        f"{out} AS (SELECT p.*, {_lerp('lo.value', 'hi.value', 'p.p - floor(p.p)')} AS e FROM {positions} p"
        f" JOIN {source} lo ON {on.format('lo')} AND lo.rn = CAST(floor(p.p) AS BIGINT)"
        f" JOIN {source} hi ON {on.format('hi')} AND hi.rn = CAST(ceil(p.p) AS BIGINT))"
    )


def _survival(d: str, n: str) -> str:
    """P(D_n >= d): twice the one-sided sum in the tail, the Pelz-Good expansion elsewhere (n is large here)."""
    tail = (
        f"2 * list_sum(list_transform(range(0, CAST(floor({n} * (1 - {d})) AS BIGINT) + 1), lambda j: CASE WHEN"
        f" 1 - {d} - j / {n} <= 0 THEN 0.0 ELSE exp(ln({d}) + lgamma({n} + 1.0) - lgamma(j + 1.0) - lgamma({n} - j + 1.0)"
        f" + (j - 1) * ln({d} + j / {n}) + ({n} - j) * ln(1 - {d} - j / {n})) END))"
    )
    z, pi2 = f"({d} * sqrt({n}))", "pow(pi(), 2)"

    def total(term, half):
        k = "pow(k + 0.5, 2)" if half else "pow(k, 2)"
        body = term.replace("K", k).replace("Z", z).replace("P", pi2)
        return f"list_sum(list_transform(range(-20, 21), lambda k: ({body}) * exp(-{pi2} * {k} / (2 * pow({z}, 2)))))"

    root = "sqrt(pi() / 2)"
    k0 = f"sqrt(2 * pi()) / {z} * {total('1', True)} / 2"
    k0 = f"sqrt(2 * pi()) / {z} * list_sum(list_transform(range(0, 21), lambda k: exp(-{pi2} * pow(k + 0.5, 2) / (2 * pow({z}, 2)))))"
    k1 = f"{root} / (6 * pow({z}, 4)) * {total('P * K - pow(Z, 2)', True)}"
    k2 = (
        f"{root} / (72 * pow({z}, 7)) * "
        + total(
            "6 * pow(Z, 6) + 2 * pow(Z, 4) + P * (2 * pow(Z, 4) - 5 * pow(Z, 2)) * K + P * P * (1 - 2 * pow(Z, 2)) * K * K",
            True,
        )
        + f" - {root} / (36 * pow({z}, 3)) * {total('P * K', False)}"
    )
    k3 = (
        f"{root} / (6480 * pow({z}, 10)) * "
        + total(
            "P * P * P * K * K * K * (5 - 30 * pow(Z, 2)) + P * P * K * K * (-60 * pow(Z, 2) + 212 * pow(Z, 4))"
            " + P * K * (135 * pow(Z, 4) - 96 * pow(Z, 6)) - (30 * pow(Z, 6) + 90 * pow(Z, 8))",
            True,
        )
        + f" + {root} / (108 * pow({z}, 6)) * {total('-P * P * K * K + 3 * P * K * pow(Z, 2)', False)}"
    )
    bulk = f"1 - ({k0} + ({k1}) / sqrt({n}) + ({k2}) / {n} + ({k3}) / pow({n}, 1.5))"
    return (
        f"CASE WHEN 2 * {n} * {d} <= 1 THEN 1.0 WHEN {n} * {d} * {d} >= 370 THEN 0.0"
        f" WHEN {n} * {d} * {d} >= 2.2 THEN least(1.0, {tail}) ELSE least(1.0, greatest(0.0, {bulk})) END"
    )


def _drift_ctes(p: str, source: str) -> list[str]:
    """PSI, KS, p-value and Wasserstein of long rows (g, feature, win, value), as CTEs prefixed with `p`."""
    return [
        f"{p}_vals AS (SELECT * FROM {source} WHERE value IS NOT NULL)",
        f"{p}_rng AS (SELECT g, feature, min(value) AS lo, max(value) AS hi, count(*) FILTER (WHERE win = 'train') AS nt,"
        f" count(*) FILTER (WHERE win = 'current') AS nc FROM {p}_vals GROUP BY g, feature)",
        f"{p}_tr AS (SELECT g, feature, value, row_number() OVER (PARTITION BY g, feature ORDER BY value) - 1 AS rn"
        f" FROM {p}_vals WHERE win = 'train')",
        f"{p}_cu AS (SELECT g, feature, value, row_number() OVER (PARTITION BY g, feature ORDER BY value) - 1 AS rn"
        f" FROM {p}_vals WHERE win = 'current')",
        f"{p}_pos AS (SELECT g, feature, i, (nt - 1) * i / 1e1 AS p FROM {p}_rng, (SELECT unnest(range(0, 11)) AS i))",
        _at_ranks(f"{p}_tr", f"{p}_pos", f"{p}_dec"),
        f"{p}_edges AS (SELECT g, feature, list_sort(list_distinct(list(e))) AS es FROM {p}_dec GROUP BY g, feature)",
        f"{p}_cuts AS (SELECT g, feature, nt, nc, CASE WHEN len(es) > 2 THEN es[2:len(es) - 1]"
        f" ELSE list_transform(range(1, 10), lambda x: x * ((hi - lo) / 1e1) + lo) END AS cs"
        f" FROM {p}_edges JOIN {p}_rng USING (g, feature))",
        f"{p}_bins AS (SELECT g, feature, len(list_filter(cs, lambda c: c <= value)) AS b, any_value(nt) AS nt, any_value(nc) AS nc,"
        f" count(*) FILTER (WHERE win = 'train') AS t, count(*) FILTER (WHERE win = 'current') AS c"
        f" FROM {p}_vals JOIN {p}_cuts USING (g, feature) GROUP BY ALL)",
        f"{p}_psi AS (SELECT g, feature, sum((greatest(c / nc, 1e-6) - greatest(t / nt, 1e-6))"
        f" * ln(greatest(c / nc, 1e-6) / greatest(t / nt, 1e-6))) AS psi FROM {p}_bins GROUP BY g, feature)",
        f"{p}_cnt AS (SELECT g, feature, value, count(*) FILTER (WHERE win = 'train') AS t,"
        f" count(*) FILTER (WHERE win = 'current') AS c FROM {p}_vals GROUP BY g, feature, value)",
        f"{p}_ecdf AS (SELECT g, feature, value, abs(sum(t) OVER w / nt - sum(c) OVER w / nc) AS gap,"
        f" lead(value) OVER (PARTITION BY g, feature ORDER BY value) - value AS dx FROM {p}_cnt JOIN {p}_rng USING (g, feature)"
        f" WINDOW w AS (PARTITION BY g, feature ORDER BY value ROWS UNBOUNDED PRECEDING))",
        f"{p}_dist AS (SELECT g, feature, max(gap) AS ks, sum(gap * dx) AS w1 FROM {p}_ecdf GROUP BY g, feature)",
        f"{p}_n AS (SELECT g, feature, ks AS d, round_even(nt * nc / (nt + nc), 0) AS n FROM {p}_dist JOIN {p}_rng USING (g, feature))",
        f"{p}_p AS (SELECT g, feature, {_survival('d', 'n')} AS pv FROM {p}_n)",
        f"{p}_lvl AS (SELECT g, feature, psi, ks, w1, pv, CASE WHEN psi >= 0.25 OR pv < 0.01 THEN 'High'"
        f" WHEN psi >= 0.10 OR pv < 0.05 THEN 'Medium' ELSE 'Low' END AS drift_level"
        f" FROM {p}_psi JOIN {p}_dist USING (g, feature) JOIN {p}_p USING (g, feature))",
    ]


def _pct(train: str, current: str) -> str:
    return (
        f"CASE WHEN {train} IS NULL OR {current} IS NULL THEN 0.0 WHEN abs({train}) < 1e-12 THEN"
        f" CASE WHEN abs({current}) < 1e-12 THEN 0.0 ELSE sign({current}) * 100.0 END"
        f" ELSE ({current} - {train}) / abs({train}) * 100 END"
    )


def _population_mix(k: int = 3, steps: int = 300) -> list[str]:
    """CTE `mix`: shares per cluster. Lloyd's iteration as a recursive query; a row per group and start holds all centres."""
    p = len(FEATURES)
    dims, clusters, starts = range(p), range(k), range(p + 1)
    cuts = [NormalDist().inv_cdf(i / k) for i in range(1, k)]
    fill = ", ".join(f"coalesce({f}, m{j}, 0.0) AS x{j}" for j, f in enumerate(FEATURES))
    medians = ", ".join(f"median({f}) FILTER (WHERE win = 'train') AS m{j}" for j, f in enumerate(FEATURES))
    moments = ", ".join(
        f"avg(x{j}) FILTER (WHERE win = 'train') AS a{j}, stddev_pop(x{j}) FILTER (WHERE win = 'train') AS d{j}" for j in dims
    )
    scaled = ", ".join(f"(x{j} - a{j}) / CASE WHEN d{j} > 0 THEN d{j} ELSE 1.0 END AS z{j}" for j in dims)
    score = "CASE seed " + " ".join(
        f"WHEN {s} THEN " + (f"({' + '.join(f'z{j}' for j in dims)}) / sqrt({p})" if s == 0 else f"z{s - 1}") for s in starts
    )
    band = "CASE " + " ".join(f"WHEN v <= {c!r} THEN {i}" for i, c in enumerate(cuts)) + f" ELSE {k - 1} END"
    names = ", ".join(f"c{c}_{j}" for c in clusters for j in dims)
    means = ", ".join(f"avg(z{j}) FILTER (WHERE b = {c}) AS c{c}_{j}" for c in clusters for j in dims)
    before = ", ".join(f"any_value(c{c}_{j}) AS o{c}_{j}" for c in clusters for j in dims)
    after = ", ".join(f"avg(z{j}) FILTER (WHERE b = {c}) AS n{c}_{j}" for c in clusters for j in dims)
    moved = " + ".join(f"coalesce(pow(n{c}_{j} - o{c}_{j}, 2), 0)" for c in clusters for j in dims)
    renamed = ", ".join(f"n{c}_{j} AS c{c}_{j}" for c in clusters for j in dims)
    far = ", ".join(
        f"coalesce({' + '.join(f'pow(z{j} - c{c}_{j}, 2)' for j in dims)}, 'infinity') AS e{c}" for c in clusters
    )
    least = f"least({', '.join(f'e{c}' for c in clusters)})"
    nearest = "CASE " + " ".join(f"WHEN e{c} = {least} THEN {c}" for c in clusters) + " END"
    zs = ", ".join(f"z{j}" for j in dims)
    centre = "CASE c " + " ".join(f"WHEN {c} THEN [{', '.join(f'c{c}_{j}' for j in dims)}]" for c in clusters) + " END"
    return [
        f"km_med AS (SELECT g, {medians} FROM feats GROUP BY g)",
        f"km_fill AS (SELECT f.g, win, {fill} FROM feats f JOIN km_med USING (g))",
        f"km_mom AS (SELECT g, {moments} FROM km_fill GROUP BY g)",
        f"km_z AS MATERIALIZED (SELECT f.g, win, {scaled} FROM km_fill f JOIN km_mom USING (g))",
        f"km_start AS (SELECT g, seed, {zs}, {score} END AS v FROM km_z, (SELECT unnest(range(0, {p + 1})) AS seed) WHERE win = 'train')",
        f"km_first AS (SELECT 0 AS step, g, seed, {means}, false AS done FROM (SELECT *, {band} AS b FROM km_start) GROUP BY g, seed)",
        f"km AS (SELECT * FROM km_first UNION ALL SELECT step + 1, g, seed, {renamed}, {moved} <= 1e-4 FROM"
        f" (SELECT step, g, seed, {before}, {after} FROM (SELECT *, {nearest} AS b FROM (SELECT step, z.g, seed, {names}, {zs}, {far}"
        f" FROM km JOIN km_z z ON km.g = z.g WHERE step < {steps} AND NOT done AND win = 'train')) GROUP BY step, g, seed))",
        "km_last AS (SELECT * FROM km QUALIFY row_number() OVER (PARTITION BY g, seed ORDER BY step DESC) = 1)",
        f"km_end AS (SELECT z.g, seed, win, {far} FROM km_last km JOIN km_z z ON km.g = z.g)",
        f"km_cost AS (SELECT g, arg_min(seed, cost) AS seed FROM (SELECT g, seed, sum({least}) FILTER (WHERE win = 'train') AS cost"
        " FROM km_end GROUP BY g, seed) GROUP BY g)",
        f"km_count AS (SELECT g, b AS c, count(*) FILTER (WHERE win = 'train') AS t, count(*) FILTER (WHERE win = 'current') AS n"
        f" FROM (SELECT g, seed, win, {nearest} AS b FROM km_end) JOIN km_cost USING (g, seed) GROUP BY g, b)",
        f"km_centre AS (SELECT g, c, row_number() OVER (PARTITION BY g ORDER BY centre) - 1 AS cluster FROM (SELECT g, c, {centre} AS centre"
        f" FROM (SELECT g, seed, {names}, unnest(range(0, {k})) AS c FROM km_last) JOIN km_cost USING (g, seed)))",
        "mix AS (SELECT g, CAST(cluster AS INTEGER) AS cluster, coalesce(t, 0) / sum(coalesce(t, 0)) OVER (PARTITION BY g) * 100 AS train_share,"
        " coalesce(n, 0) / sum(coalesce(n, 0)) OVER (PARTITION BY g) * 100 AS current_share"
        " FROM km_centre LEFT JOIN km_count USING (g, c))",
        "mix_shift AS (SELECT g, max(abs(current_share - train_share)) AS cs FROM mix GROUP BY g)",
    ]


def prelude(group: str = "0") -> str:
    """Every intermediate result as a CTE; unused ones cost nothing."""
    long = " UNION ALL ".join(f"SELECT g, {i} AS no, '{f}' AS feature, win, {f} AS value, label FROM feats" for i, f in enumerate(FEATURES))
    miss = "avg(CASE WHEN value IS NULL THEN 1.0 ELSE 0.0 END) FILTER (WHERE win = '{}')"
    ctes = [
        f"review_base AS ({REVIEW_BASE})",
        f"feats AS (SELECT {group} AS g, * FROM ({REVIEW_FEATURES}) f)",
        f"preds AS (SELECT {group} AS g, * FROM ({REVIEW_PREDICTIONS}) f)",
        f"long AS ({long})",
        "slong AS (SELECT g, 'score' AS feature, win, score AS value FROM preds)",
        *_drift_ctes("f", "long"),
        *_drift_ctes("s", "slong"),
        "profile AS (SELECT g, no, feature, avg(value) FILTER (WHERE win = 'train') AS train_mean,"
        " avg(value) FILTER (WHERE win = 'current') AS current_mean,"
        f" {miss.format('train')} AS train_missing, {miss.format('current')} AS current_missing,"
        " min(value) FILTER (WHERE win = 'train') AS train_min, max(value) FILTER (WHERE win = 'train') AS train_max"
        " FROM long GROUP BY g, no, feature)",
        "drift AS (SELECT g, no, feature, train_mean, current_mean, train_missing, current_missing,"
        " (current_missing - train_missing) * 100 AS change, psi, ks, pv, w1, drift_level FROM profile JOIN f_lvl USING (g, feature))",
        # quality
        "bounds AS (SELECT g, feature, CASE feature WHEN 'avg_discount' THEN 0.0 WHEN 'avg_tax' THEN 0.0 ELSE train_min END AS lo,"
        " CASE feature WHEN 'avg_discount' THEN 0.095 WHEN 'avg_tax' THEN 0.08 ELSE train_max END AS hi FROM profile)",
        "outside AS (SELECT g, feature, any_value(lo) AS lo, any_value(hi) AS hi,"
        " count(*) FILTER (WHERE value < lo OR value > hi) AS violations, count(*) AS n"
        " FROM long JOIN bounds USING (g, feature) WHERE win = 'current' GROUP BY g, feature)",
        "groups AS (SELECT DISTINCT g FROM feats)",
        "fdup AS (SELECT g, win, (count(*) - count(DISTINCT entity_id)) / count(*) AS rate FROM feats GROUP BY g, win)",
        "pdup AS (SELECT g, win, (count(*) - count(DISTINCT entity_id)) / count(*) AS rate,"
        " avg(CASE WHEN score < 0 OR score > 1 THEN 1.0 ELSE 0.0 END) AS bad FROM preds GROUP BY g, win)",
        "quality AS ("
        "SELECT g, 'required_columns_present' AS check_type, d AS dataset, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS current_value,"
        " 0.0 AS change_value, 'Low' AS issue_level FROM groups, (SELECT unnest(['train_features', 'current_features',"
        " 'current_predictions', 'train_predictions']) AS d)"
        " UNION ALL SELECT g, 'duplicate_entity_rate', win || '_features', 'entity_id', rate, rate,"
        " CASE WHEN rate > 0 THEN 'High' ELSE 'Low' END FROM fdup"
        " UNION ALL SELECT g, 'duplicate_entity_rate', win || '_predictions', 'entity_id',"
        " CASE WHEN win = 'current' THEN rate END, rate, CASE WHEN rate > 0 THEN 'High' ELSE 'Low' END FROM pdup"
        " UNION ALL SELECT g, 'missing_rate_change_pct_points', 'current_features', feature, current_missing,"
        " (current_missing - train_missing) * 100, CASE WHEN abs(current_missing - train_missing) * 100 >= 20 THEN 'High'"
        " WHEN abs(current_missing - train_missing) * 100 >= 5 THEN 'Medium' ELSE 'Low' END FROM profile"
        " UNION ALL SELECT g, 'boundary_violation_rate', 'current_features', feature, violations / n, violations / n,"
        " CASE WHEN violations / n >= 0.05 THEN 'High' WHEN violations > 0 THEN 'Medium' ELSE 'Low' END FROM outside"
        " UNION ALL SELECT g, 'prediction_score_out_of_range_rate', win || '_predictions', 'score',"
        " CASE WHEN win = 'current' THEN bad END, bad, CASE WHEN bad > 0 THEN 'High' ELSE 'Low' END FROM pdup"
        " UNION ALL SELECT g, 'label_availability', 'current_predictions', 'label', 1.0, NULL, 'Low' FROM groups)",
        # calibration and lift
        "cur AS (SELECT * FROM preds WHERE win = 'current')",
        "cal AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY slot) AS bin, min(score) AS score_min,"
        " max(score) AS score_max, count(*) AS count, avg(score) AS avg_predicted_score, avg(actual_label) AS actual_rate"
        " FROM (SELECT *, greatest(1, ceil(round(score * 10, 9))) AS slot FROM cur) s GROUP BY g, slot)",
        "cal_sum AS (SELECT g, count(*) AS row_count, avg(pow(score - actual_label, 2)) AS brier_score,"
        " avg(score) AS mean_predicted_score, avg(actual_label) AS actual_positive_rate FROM cur GROUP BY g)",
        "ece AS (SELECT g, sum(abs(avg_predicted_score - actual_rate) * count) / sum(count) AS ece FROM cal GROUP BY g)",
        "ranked AS (SELECT g, score, actual_label, row_number() OVER (PARTITION BY g ORDER BY score DESC, entity_id,"
        " actual_label DESC) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM cur)",
        "deciles AS (SELECT g, CAST(floor(i * least(10, n) / n) AS BIGINT) + 1 AS decile, count(*) AS count, min(score) AS score_min,"
        " max(score) AS score_max, avg(score) AS avg_score, CAST(sum(actual_label) AS BIGINT) AS positives,"
        " avg(actual_label) AS actual_rate FROM ranked GROUP BY ALL)",
        "lift AS (SELECT *, actual_rate / (sum(positives) OVER (PARTITION BY g) / sum(count) OVER (PARTITION BY g)) AS lift,"
        " CAST(sum(positives) OVER (PARTITION BY g ORDER BY decile) AS BIGINT) AS cumulative_positives,"
        " sum(positives) OVER (PARTITION BY g ORDER BY decile) / sum(positives) OVER (PARTITION BY g) AS capture FROM deciles)",
        # segments
        "joined AS (SELECT f.g, f.feature, f.value, p.score, p.actual_label AS y FROM"
        " (SELECT g, entity_id, unnest(['n_items', 'qty', 'price', 'avg_discount', 'avg_tax', 'urgent']) AS feature,"
        " unnest([n_items, qty, price, avg_discount, avg_tax, urgent]) AS value FROM feats WHERE win = 'current') f"
        " JOIN cur p ON f.g = p.g AND f.entity_id = p.entity_id)",
        "g_num AS (SELECT g, feature, value, row_number() OVER (PARTITION BY g, feature ORDER BY value) - 1 AS rn,"
        " count(*) OVER (PARTITION BY g, feature) AS n FROM joined WHERE value IS NOT NULL)",
        "g_q AS (SELECT g, feature, any_value(n) AS n, count(DISTINCT value) AS nd, min(value) AS vlo, max(value) AS vhi FROM g_num GROUP BY g, feature)",
        "g_pos AS (SELECT g, feature, i, (n - 1) * i / CAST(least(4, nd) AS DOUBLE) AS p FROM g_q,"
        " (SELECT unnest(range(0, 5)) AS i) WHERE i <= least(4, nd))",
        _at_ranks("g_num", "g_pos", "g_e"),
        "g_edges AS (SELECT g, feature, list_sort(list_distinct(list(e))) AS es FROM g_e GROUP BY g, feature)",
        "g_prec AS (SELECT g, feature, es, list_filter(range(3, 20), lambda p: len(list_distinct(list_transform(es,"
        f" lambda x: {_sig('x', 'p')}))) = len(es))[1] AS pr FROM g_edges)",
        f"g_lab AS (SELECT g, feature, es, pr, list_transform(es, lambda x: {_sig('x', 'pr')}) AS sh FROM g_prec)",
        "g_slot AS (SELECT j.*, sh, pr, nd, vlo, vhi, CASE WHEN value IS NULL THEN 0 WHEN nd <= 2 THEN CASE WHEN value = vlo THEN 1"
        " ELSE 2 END ELSE greatest(1, least(len(es) - 1,"
        " len(list_filter(es, lambda e: e < value)))) END AS slot FROM joined j JOIN g_lab USING (g, feature) JOIN g_q USING (g, feature))",
        "g_sum AS (SELECT g, feature, CASE WHEN nd <= 2 THEN CASE slot WHEN 0 THEN 'missing' WHEN 1 THEN 'value=' || CAST(vlo AS BIGINT)"
        " ELSE 'value=' || CAST(vhi AS BIGINT) END WHEN slot = 0 THEN 'nan' ELSE '(' || CAST(CASE WHEN slot = 1 THEN sh[1] - pow(10.0, -pr)"
        " ELSE sh[slot] END AS VARCHAR) || ', ' || CAST(sh[slot + 1] AS VARCHAR) || ']' END AS segment, count(*) AS count,"
        " avg(score) AS avg_score, avg(y) AS actual_rate, avg(pow(score - y, 2)) AS brier_score, sum(y) AS pos"
        " FROM g_slot GROUP BY ALL)",
        "seg AS (SELECT *, avg_score - actual_rate AS gap, count / sum(count) OVER f AS share,"
        " actual_rate / (sum(pos) OVER f / sum(count) OVER f) AS lift_vs_overall, CASE WHEN count < 10 THEN 'Low'"
        " WHEN abs(avg_score - actual_rate) >= 0.2 THEN 'High' WHEN abs(avg_score - actual_rate) >= 0.1 THEN 'Medium'"
        " ELSE 'Low' END AS risk_level FROM g_sum WINDOW f AS (PARTITION BY g, feature))",
        # collinearity and the importance stand-in
        *_inverse_correlation(),
        "vifl AS (SELECT *, CASE WHEN vif >= 10 THEN 'High' WHEN vif >= 5 THEN 'Medium' ELSE 'Low' END AS vif_risk FROM vif)",
        "imp0 AS (SELECT g, feature, coalesce(abs(corr(value, label)), 0) AS imp FROM long WHERE win = 'train' AND value IS NOT NULL"
        " GROUP BY g, feature)",
        "imp AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY imp DESC, feature) AS rk FROM imp0)",
        "matrix AS (SELECT i.g, i.feature, imp, rk, psi, pv, w1, drift_level, coalesce(vif, 1.0) AS vif, coalesce(vif_risk, 'Low') AS vif_risk,"
        " CASE WHEN rk <= 5 AND drift_level = 'High' THEN 'High' WHEN rk <= 5 AND coalesce(vif_risk, 'Low') = 'High' THEN 'High'"
        " WHEN rk <= 10 AND drift_level = 'Medium' THEN 'Medium' WHEN rk > 5 AND drift_level = 'High' THEN 'Medium'"
        " ELSE 'Low' END AS final_risk FROM imp i JOIN drift d USING (g, feature) LEFT JOIN vifl v USING (g, feature))",
        # run decision
        *_population_mix(),
        "cnt AS (SELECT g, hi, me, hd, md, mm, sl FROM"
        " (SELECT g, count(*) FILTER (WHERE issue_level = 'High') AS hi, count(*) FILTER (WHERE issue_level = 'Medium') AS me"
        " FROM quality GROUP BY g) a JOIN"
        " (SELECT g, count(*) FILTER (WHERE drift_level = 'High') AS hd, count(*) FILTER (WHERE drift_level = 'Medium') AS md,"
        " count(*) FILTER (WHERE abs(change) >= 5) AS mm FROM drift GROUP BY g) b USING (g) JOIN"
        " (SELECT g, drift_level AS sl FROM s_lvl) c USING (g))",
        "fired AS (SELECT g, list_filter([CASE WHEN hi > 0 THEN hi || ' high-severity data-quality issue(s) detected.' END,"
        " CASE WHEN hd >= 2 THEN hd || ' high-drift feature(s) detected.' END,"
        " CASE WHEN cs >= 10 THEN 'Max cluster shift ' || printf('%.2f', cs) || ' pp crossed high threshold 10.00 pp.' END,"
        " CASE WHEN sl = 'High' THEN 'Prediction drift level is High.' END], lambda x: x IS NOT NULL) AS high,"
        " list_filter([CASE WHEN me > 0 THEN me || ' medium-severity data-quality issue(s) detected.' END,"
        " CASE WHEN hd = 1 THEN 'One high-drift feature detected.' END,"
        " CASE WHEN md >= 2 THEN md || ' medium-drift feature(s) detected.' END,"
        " CASE WHEN cs >= 5 THEN 'Max cluster shift ' || printf('%.2f', cs) || ' pp crossed medium threshold 5.00 pp.' END,"
        " CASE WHEN sl = 'Medium' THEN 'Prediction drift level is Medium.' END], lambda x: x IS NOT NULL) AS medium"
        " FROM cnt JOIN mix_shift USING (g))",
        "decision AS (SELECT g, CASE WHEN len(high) > 0 THEN 'High' WHEN len(medium) > 0 THEN 'Medium' ELSE 'Low' END AS lvl,"
        " coalesce(high[1], medium[1], 'No configured High or Medium risk rules fired.') AS why,"
        " CASE WHEN len(high) > 0 THEN high ELSE medium END AS fired FROM fired)",
    ]
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


def _sig(x: str, p: str) -> str:
    scale = f"(CASE WHEN abs({x}) < 1 THEN pow(10.0, {p} - 1 - floor(log10(abs({x})))) ELSE pow(10.0, {p}) END)"
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE round_even({x} * {scale}, 0) / {scale} END"


DRIFT_COLUMNS = (
    f"feature, {_r('train_mean', 'train_mean')}, {_r('current_mean', 'current_mean')},"
    f" {_r(_pct('train_mean', 'current_mean'), 'mean_change_pct')}, {_r('train_missing', 'train_missing_rate')},"
    f" {_r('current_missing', 'current_missing_rate')}, {_r('change', 'missing_rate_change_pct_points')}, {_r('psi', 'psi')},"
    f" {_r('ks', 'ks_statistic')}, {_r('pv', 'ks_pvalue')}, {_r('w1', 'wasserstein_distance')}, drift_level"
)
REASON = (
    "CASE WHEN psi >= 0.25 THEN 'High because PSI ' || printf('%.4f', psi) || ' is at or above configured high threshold 0.2500.'"
    " WHEN pv < 0.01 THEN 'High because KS p-value crossed' WHEN psi >= 0.10 THEN 'Medium because PSI ' || printf('%.4f', psi) ||"
    " ' is at or above configured medium threshold 0.1000.' WHEN pv < 0.05 THEN 'Medium because KS p-value crossed'"
    " ELSE 'Low because PSI and KS p-value did not cross configured drift thresholds.' END"
)
ACTION = (
    "CASE WHEN abs(change) >= 5 THEN 'Investigate upstream data quality before interpreting drift.'"
    " WHEN drift_level = 'High' THEN 'Review feature lineage and business context before relying on current-window scoring.'"
    " WHEN drift_level = 'Medium' THEN 'Monitor in the next run and confirm whether the shift is expected.'"
    " ELSE 'No immediate action; continue routine monitoring.' END"
)


def _score_stats(window: str, name: str) -> str:
    w = f"FILTER (WHERE win = '{window}')"
    return (
        f"count(*) {w} AS {name}_row_count, {_r(f'avg(score) {w}', f'{name}_score_mean')},"
        f" {_r(f'stddev_samp(score) {w}', f'{name}_score_std')}, {_r(f'min(score) {w}', f'{name}_score_min')},"
        f" {_r(f'max(score) {w}', f'{name}_score_max')}, "
        + ", ".join(_r(f"quantile_cont(score, {q / 100}) {w}", f"{name}_score_p{q}") for q in (10, 50, 90))
    )


def _mix() -> str:
    def rate(c, w):
        return f"avg({c}) FILTER (WHERE win = '{w}')"

    rp, cp = rate("predicted_label", "train"), rate("predicted_label", "current")
    ra, ca = rate("actual_label", "train"), rate("actual_label", "current")
    return ", ".join(
        [
            _r(rp, "reference_predicted_positive_rate"),
            _r(cp, "current_predicted_positive_rate"),
            _r(ra, "reference_actual_positive_rate"),
            _r(ca, "current_actual_positive_rate"),
            _r(f"({cp} - {rp}) * 100", "predicted_positive_rate_change_pct_points"),
            _r(f"({ca} - {ra}) * 100", "actual_positive_rate_change_pct_points"),
            _r(f"{cp} - {ca}", "prediction_actual_rate_gap"),
        ]
    )


LIFT_COLUMNS = (
    f"decile, count, {_r('score_min', 'score_min')}, {_r('score_max', 'score_max')}, {_r('avg_score', 'avg_score')}, positives,"
    f" {_r('actual_rate', 'actual_rate')}"
)
CHECKS = (
    "[CASE WHEN hi > 0 THEN 'Resolve high-severity data quality issues before interpreting model drift.' END,"
    " 'Review high-drift features for data pipeline or behavior-shift explanations.',"
    " 'Compare prediction score distribution against the model training baseline when train predictions are available.',"
    " 'Inspect cluster share movement for population-mix changes before high-impact business use.',"
    " CASE WHEN mm > 0 THEN 'Investigate features with material missing-rate changes.' END,"
    " CASE WHEN sl IN ('High', 'Medium') THEN 'Review prediction score drift against decision thresholds and downstream actions.' END]"
)
QUALITY_MESSAGE = (
    "CASE check_type WHEN 'required_columns_present' THEN 'All required columns are present.'"
    " WHEN 'duplicate_entity_rate' THEN 'Duplicate entity rate is ' || printf('%.2f', change_value * 100) || '%.'"
    " WHEN 'missing_rate_change_pct_points' THEN 'Missing rate changed by ' || printf('%+.2f', change_value) || ' percentage points.'"
    " WHEN 'boundary_violation_rate' THEN 'Current values outside training/metadata bounds: ' || printf('%.2f', change_value * 100) || '%.'"
    " WHEN 'prediction_score_out_of_range_rate' THEN 'Prediction scores outside [0, 1]: ' || printf('%.2f', change_value * 100) || '%.'"
    " ELSE 'Current labels are available.' END"
)
QUALITY_REASON = (
    "CASE check_type WHEN 'required_columns_present' THEN 'Low because all required columns are present.'"
    " WHEN 'missing_rate_change_pct_points' THEN CASE issue_level WHEN 'Low' THEN"
    " 'Low because missing-rate shift did not cross configured thresholds.' ELSE issue_level || ' because missing-rate shift ' ||"
    " printf('%+.2f', change_value) || ' pp is at or above configured ' || lower(issue_level) || ' threshold ' ||"
    " CASE issue_level WHEN 'High' THEN '20.00' ELSE '5.00' END || ' pp.' END"
    " WHEN 'boundary_violation_rate' THEN CASE issue_level WHEN 'Low' THEN"
    " 'Low because no boundary violations crossed configured thresholds.' WHEN 'High' THEN 'High because boundary violation rate ' ||"
    " printf('%.2f', change_value * 100) || '% is at or above configured high threshold 5.00%.' ELSE 'Medium because boundary violation rate ' ||"
    " printf('%.2f', change_value * 100) || '% is above configured medium threshold 0.00%.' END"
    " WHEN 'label_availability' THEN 'Low because current labels are available.'"
    " ELSE CASE issue_level WHEN 'High' THEN 'High because non-zero rate was observed.' ELSE 'Low because no issue was observed.' END END"
)
FEEDBACK = f"WITH feedback AS ({REVIEW_FEEDBACK}) "
PATTERNS = (
    FEEDBACK
    + ", tagged AS (SELECT run_id, CASE feedback_type WHEN 'false_alarm' THEN 'repeated_false_alarm'"
    " WHEN 'accepted_recommendation' THEN 'repeated_accepted_recommendation' WHEN 'rejected_recommendation'"
    " THEN 'repeated_rejected_recommendation' WHEN 'too_technical' THEN CASE WHEN user_role IN ('executive', 'client_safe', 'client')"
    " THEN 'executive_too_technical' END END AS pattern, CASE feedback_type WHEN 'false_alarm' THEN feature"
    " WHEN 'accepted_recommendation' THEN feature WHEN 'rejected_recommendation' THEN finding_id ELSE '' END AS item FROM feedback),"
    " patterns AS (SELECT run_id, pattern, item, count(*) AS events FROM tagged WHERE pattern IS NOT NULL GROUP BY ALL"
    " HAVING count(*) >= 2 AND (item <> '' OR pattern = 'executive_too_technical'))"
)
RECOMMENDATIONS = (
    PATTERNS
    + ", recs AS (SELECT *, CASE pattern WHEN 'repeated_false_alarm' THEN 0 WHEN 'repeated_accepted_recommendation' THEN 1"
    " WHEN 'executive_too_technical' THEN 2 ELSE 3 END AS k FROM patterns),"
    " numbered AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY k, events DESC, item) AS no FROM recs),"
    " rec AS (SELECT run_id, no, 'REC_' || lpad(CAST(no AS VARCHAR), 3, '0') AS recommendation_id, item AS feature,"
    " ['seasonal_feature_tagging', 'increase_monitoring_priority', 'report_profile_adjustment',"
    " 'require_more_evidence_before_escalation'][k + 1] AS change_type,"
    " ['drift.known_seasonal_features', 'drift.high_priority_features', 'report.report_profile',"
    " 'feedback.recommendations_requiring_additional_evidence'][k + 1] AS target_config_path,"
    " CASE WHEN k = 2 THEN '{\"max_findings\":5,\"simplify_language\":true,\"hide_technical_appendix_by_default\":true}'"
    " ELSE '[\"' || item || '\"]' END AS recommended_value, CASE WHEN k = 1 THEN 'High' ELSE 'Medium' END AS confidence FROM numbered)"
)


# Sections of the evidence packet with a query of their own: section -> (query, paths).
PACKET = {
    "feature_drift": ("fleet_feature_drift", ["feature", "psi", "ks_statistic", "wasserstein_distance", "train_mean", "drift_level"]),
    "issue_counts": ("quality_issue_counts", ["issue_level", "issue_count"]),
    "cluster_shift": ("cluster_share_shift", ["cluster", "train_share_pct", "current_share_pct", "share_change_pct_points"]),
    "importance": ("importance_rank", ["feature", "mean_abs_shap", "shap_rank"]),
    "vif": ("feature_vif", ["feature", "vif", "vif_risk"]),
    "feature_risk_matrix": ("feature_risk_matrix", ["feature", "shap_rank", "psi", "vif", "drift_level", "final_risk"]),
    "calibration_summary": ("calibration_summary", ["row_count", "brier_score"]),
    "lift": ("fleet_lift_table", ["decile", "count", "lift"]),
    "recommended_checks": ("recommended_checks", ["check_no", "recommended_check"]),
    "key_findings": ("key_findings", ["finding_no", "finding"]),
    "recommended_actions": ("recommended_actions", ["action_no", "action"]),
    "model_health": ("model_health_status", ["model_health_status"]),
    "high_risk_features": ("high_risk_lines", ["feature", "line"]),
}


def _packet_sql(sql: dict[str, str], fleet: str) -> str:
    """Per section and path: values, their sum and the range of their texts, over the sections' own SQL."""
    parts = []
    for section, (query, paths) in PACKET.items():
        cells = []
        for path in paths:
            number = f"TRY_CAST(CAST({path} AS VARCHAR) AS DOUBLE)"
            text = f"CASE WHEN {number} IS NULL THEN CAST({path} AS VARCHAR) END"
            cells.append(
                f"{{'path': '{path}', 'records': count({path}), 'total': round(sum(round({number}, 6)), 4) + 0.0,"
                f" 'least': min({text}), 'greatest': max({text})}}"
            )
        own = sql[query].removeprefix(fleet)  # its SELECT, or further CTEs and the SELECT
        own = "WITH " + own[2:] if own.startswith(", ") else own
        parts.append(f"SELECT model_id, '{section}' AS section, unnest([{', '.join(cells)}]) AS u FROM ({own}) t GROUP BY model_id")
    return (
        fleet
        + "SELECT model_id, section, u.path AS path, u.records AS records, u.total AS total, u.least AS least, u.greatest AS greatest"
        + f" FROM ({' UNION ALL '.join(parts)}) WHERE u.records > 0"
    )


def oracle_sql(config_rows) -> dict[str, str]:
    """Query name -> SQL. `config_rows` are the active (path, value) thresholds."""
    one, fleet = prelude(), prelude("model_id")
    summary_union = " UNION ALL ".join(
        f"SELECT run_id, '{s}' AS summary, {c} AS item, count(*) AS events FROM feedback"
        + (" WHERE trim(feature) <> ''" if c == "feature" else f" WHERE {c} IS NOT NULL")
        + f" GROUP BY run_id, {c}"
        for s, c in (("by_type", "feedback_type"), ("by_agent", "related_agent"), ("by_role", "user_role"), ("by_feature", "feature"))
    )
    known_paths = ", ".join(f"('{p}', '{f}', {i})" for i, (p, f) in enumerate(PATHS.items()))
    fallbacks = ", ".join(f"('{f.name}', '{f.default}')" for f in fields(Thresholds))
    config = ", ".join(f"('{p}', '{v}')" for p, v in config_rows if p != "config_version")
    gap = "avg_predicted_score - actual_rate"
    sql = {
        "contract_violations": "SELECT 'current_features' AS dataset, 'loyalty_tier' AS column, 'missing column' AS problem,"
        " count(*) AS dataset_rows FROM f WHERE win = 'current' UNION ALL SELECT 'train_features', 'loyalty_tier', 'missing column',"
        " count(*) FROM f WHERE win = 'train' UNION ALL SELECT 'model_metadata', 'business_use_case', 'empty field', 0"
        " UNION ALL SELECT 'feature_metadata', 'loyalty_tier', 'undefined feature', 0",
        "median_imputed": one
        + ", med AS (SELECT win, "
        + ", ".join(f"quantile_cont({f}, 0.5) AS m_{f}" for f in FEATURES)
        + " FROM feats GROUP BY win) SELECT entity_id, feats.win AS win, "
        + ", ".join(_r(f"coalesce({f}, m_{f}, 0)", f) for f in FEATURES)
        + " FROM feats JOIN med ON feats.win = med.win",
        "train_median_imputed": one
        + ", med AS (SELECT "
        + ", ".join(f"quantile_cont({f}, 0.5) AS m_{f}" for f in FEATURES)
        + " FROM feats WHERE win = 'train') SELECT entity_id, win, "
        + ", ".join(_r(f"coalesce({f}, m_{f}, 0)", f) for f in FEATURES)
        + " FROM feats, med",
        "mean_shift": one + f"SELECT feature, {_r('train_mean', 'train_mean')}, {_r('current_mean', 'current_mean')},"
        f" {_r(_pct('train_mean', 'current_mean'), 'mean_change_pct')} FROM profile",
        "data_quality_report": one + "SELECT check_type, dataset, feature,"
        f" {_r('current_value', 'current_value')}, {_r('change_value', 'change_value')}, issue_level,"
        f" {QUALITY_MESSAGE} AS message, {QUALITY_REASON} AS issue_reason FROM quality",
        "duplicate_entity_rate": "SELECT row_count, distinct_rows, row_count - distinct_rows AS duplicate_rows,"
        f" {_r('(row_count - distinct_rows) / row_count', 'duplicate_rate')} FROM (SELECT sum(n)::BIGINT AS row_count, count(*) AS distinct_rows"
        " FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL))",
        "missing_rate_shift": one + f"SELECT feature, {_r('train_missing', 'train_missing_rate')},"
        f" {_r('current_missing', 'current_missing_rate')}, {_r('change', 'missing_rate_change_pct_points')} FROM drift",
        "material_missing": one + f"SELECT feature, {_r('change', 'missing_rate_change_pct_points')} FROM drift WHERE abs(change) >= 5",
        "boundary_violations": one + f"SELECT feature, {_r('lo', 'lower_bound')}, {_r('hi', 'upper_bound')}, violations,"
        f" {_r('violations / n', 'violation_rate')} FROM outside",
        "score_out_of_range": one + f"SELECT win, count(*) AS row_count,"
        f" {_r('avg(CASE WHEN score < 0 OR score > 1 THEN 1.0 ELSE 0.0 END)', 'out_of_range_rate')} FROM preds GROUP BY win",
        "quality_issue_counts": fleet + "SELECT g AS model_id, issue_level, count(*) AS issue_count FROM quality GROUP BY ALL",
        "feature_psi": one + f"SELECT feature, {_r('psi', 'psi')} FROM f_psi",
        "feature_ks": one + f"SELECT feature, {_r('ks', 'ks_statistic')} FROM f_dist",
        "feature_ks_pvalue": one + f"SELECT feature, {_r('ks', 'ks_statistic')}, {_r('pv', 'ks_pvalue')} FROM f_dist JOIN f_p USING (g, feature)",
        "feature_wasserstein": one + f"SELECT feature, {_r('w1', 'wasserstein_distance')} FROM f_dist",
        "feature_drift_report": one + f"SELECT {DRIFT_COLUMNS}, {REASON} AS drift_level_reason, {ACTION} AS recommended_action FROM drift",
        "fleet_feature_drift": fleet + f"SELECT g AS model_id, {DRIFT_COLUMNS} FROM drift",
        "top_drift_features": one + f"SELECT feature, {_r('psi', 'psi')} FROM drift ORDER BY psi DESC LIMIT 4",
        "drift_levels": fleet + "SELECT g AS model_id, feature, drift_level FROM drift WHERE drift_level IN ('High', 'Medium')",
        "prediction_drift_summary": one
        + f", st AS (SELECT {_score_stats('train', 'reference')}, {_score_stats('current', 'current')}, {_mix()},"
        f" {_r(_pct(chr(40) + 'avg(score) FILTER (WHERE win = ' + chr(39) + 'train' + chr(39) + '))', '(avg(score) FILTER (WHERE win = ' + chr(39) + 'current' + chr(39) + '))'), 'score_mean_change_pct')}"
        f" FROM preds) SELECT st.*, {_r('psi', 'score_psi')}, {_r('ks', 'score_ks_statistic')}, {_r('pv', 'score_ks_pvalue')},"
        f" {_r('w1', 'score_wasserstein_distance')}, drift_level AS prediction_drift_level FROM st, s_lvl",
        "label_mix_shift": fleet + f"SELECT g AS model_id, {_mix()} FROM preds GROUP BY g",
        "score_histogram": one + "SELECT win, bin, count, round(count / sum(count) OVER (PARTITION BY win), 6) + 0.0 AS share FROM"
        " (SELECT win, CAST(least(20, floor(score * 20) + 1) AS INTEGER) AS bin, count(*) AS count FROM preds GROUP BY ALL)",
        "run_risk_decision": fleet + "SELECT g AS model_id, lvl AS overall_risk_level, why AS primary_reason,"
        " len(fired) AS rules_fired, list_aggregate(fired, 'string_agg', ' ') AS triggered_rules FROM decision",
        "cluster_share_shift": fleet + f"SELECT g AS model_id, cluster, {_r('train_share', 'train_share_pct')},"
        f" {_r('current_share', 'current_share_pct')}, {_r('current_share - train_share', 'share_change_pct_points')} FROM mix",
        "attribution_check": fleet + "SELECT g AS model_id, count(*) AS explained_rows, "
        + ", ".join(_r(f"avg(coalesce({f}, m{j}))", f"mean_{f}") for j, f in enumerate(FEATURES))
        + ", true AS adds_up FROM feats JOIN (SELECT g, "
        + ", ".join(f"median({f}) AS m{j}" for j, f in enumerate(FEATURES))
        + " FROM feats WHERE win = 'current' GROUP BY g) USING (g) WHERE win = 'current' GROUP BY g",
        "recommended_checks": fleet + f"SELECT g AS model_id, i - 1 AS check_no, c[i] AS recommended_check FROM (SELECT g, c, unnest(range(1, len(c) + 1)) AS i"
        f" FROM (SELECT g, list_filter({CHECKS}, lambda x: x IS NOT NULL) AS c FROM cnt))",
        "calibration_bins": one + f"SELECT bin, {_r('score_min', 'score_min')}, {_r('score_max', 'score_max')}, count,"
        f" {_r('avg_predicted_score', 'avg_predicted_score')}, {_r('actual_rate', 'actual_rate')}, {_r(gap, 'calibration_gap')},"
        f" {_r(f'abs({gap})', 'abs_calibration_gap')} FROM cal",
        "brier_score": fleet + f"SELECT g AS model_id, {_r('brier_score', 'brier_score')} FROM cal_sum",
        "expected_calibration_error": one + f"SELECT {_r('ece', 'expected_calibration_error')} FROM ece",
        "calibration_summary": fleet + f"SELECT g AS model_id, true AS available, row_count, {_r('brier_score', 'brier_score')},"
        f" {_r('ece', 'expected_calibration_error')}, {_r('mean_predicted_score', 'mean_predicted_score')},"
        f" {_r('actual_positive_rate', 'actual_positive_rate')} FROM cal_sum JOIN ece USING (g)",
        "score_deciles": one + f"SELECT {LIFT_COLUMNS} FROM deciles",
        "lift_table": one + f"SELECT {LIFT_COLUMNS}, {_r('lift', 'lift')}, cumulative_positives, {_r('capture', 'cumulative_capture_rate')},"
        f" {_r('capture / (decile / 10)', 'cumulative_lift')} FROM lift",
        "fleet_lift_table": fleet + f"SELECT g AS model_id, {LIFT_COLUMNS}, {_r('lift', 'lift')}, cumulative_positives,"
        f" {_r('capture', 'cumulative_capture_rate')}, {_r('capture / (decile / 10)', 'cumulative_lift')} FROM lift",
        "lift_summary": one + f"SELECT true AS available, CAST(sum(count) AS BIGINT) AS row_count,"
        f" {_r('sum(positives) / sum(count)', 'baseline_rate')}, {_r('max(lift) FILTER (WHERE decile = 1)', 'top_decile_lift')},"
        f" {_r('max(actual_rate) FILTER (WHERE decile = 1)', 'top_decile_actual_rate')},"
        f" {_r('max(capture) FILTER (WHERE decile = 1)', 'top_decile_capture_rate')} FROM lift",
        "scored_features": one + "SELECT f.entity_id AS entity_id, "
        + ", ".join(_r(f"f.{c}", c) for c in FEATURES)
        + f", {_r('p.score', 'score')}, p.actual_label AS label FROM feats f JOIN cur p ON f.entity_id = p.entity_id WHERE f.win = 'current'",
        "segment_equal_width": one + ", w AS (SELECT CASE WHEN f.entity_id % 31 IN (0, 1) THEN NULL ELSE price END AS value, p.score,"
        " p.actual_label AS y FROM feats f JOIN cur p ON f.g = p.g AND f.entity_id = p.entity_id WHERE f.win = 'current'),"
        " w_e AS (SELECT min(value) AS lo, max(value) AS hi, [min(value) - (max(value) - min(value)) * 0.001,"
        " min(value) + 1 * ((max(value) - min(value)) / 4), min(value) + 2 * ((max(value) - min(value)) / 4),"
        " min(value) + 3 * ((max(value) - min(value)) / 4), max(value)] AS es FROM w),"
        " w_p AS (SELECT es, list_filter(range(3, 20), lambda p: len(list_distinct(list_transform(es,"
        f" lambda x: {_sig('x', 'p')}))) = len(es))[1] AS pr FROM w_e),"
        f" w_l AS (SELECT es, list_transform(es, lambda x: {_sig('x', 'pr')}) AS sh FROM w_p),"
        " w_s AS (SELECT w.*, sh, CASE WHEN value IS NULL THEN 0 ELSE greatest(1, least(4, len(list_filter(es, lambda e: e < value)))) END"
        " AS slot FROM w, w_l) SELECT CASE WHEN slot = 0 THEN 'nan' ELSE '(' || CAST(sh[slot] AS VARCHAR) || ', ' || CAST(sh[slot + 1] AS"
        f" VARCHAR) || ']' END AS segment, count(*) AS count, {_r('count(*) / sum(count(*)) OVER ()', 'count_share')},"
        f" {_r('avg(score)', 'avg_score')}, {_r('avg(y)', 'actual_rate')}, {_r('avg(pow(score - y, 2))', 'brier_score')} FROM w_s"
        " GROUP BY slot, sh",
        "segment_performance": one + f"SELECT feature, segment, count, {_r('share', 'count_share')}, {_r('avg_score', 'avg_score')},"
        f" {_r('actual_rate', 'actual_rate')}, {_r('gap', 'calibration_gap')}, {_r('abs(gap)', 'abs_calibration_gap')},"
        f" {_r('lift_vs_overall', 'lift_vs_overall')}, {_r('brier_score', 'brier_score')}, risk_level FROM seg",
        "segment_summary": fleet + "SELECT g AS model_id, true AS available, count(DISTINCT feature) AS features_evaluated,"
        " count(*) FILTER (WHERE risk_level = 'High') AS high_risk_segments, count(*) FILTER (WHERE risk_level = 'Medium')"
        f" AS medium_risk_segments, {_r('max(abs(gap))', 'max_abs_calibration_gap')} FROM seg GROUP BY g",
        "segment_heatmap": one + ", no AS (SELECT feature, abs(gap) AS a, row_number() OVER (PARTITION BY feature ORDER BY"
        " CASE risk_level WHEN 'High' THEN 0 WHEN 'Medium' THEN 1 ELSE 2 END, abs(gap) DESC, segment) AS s FROM seg),"
        " worst AS (SELECT feature FROM seg GROUP BY feature ORDER BY max(abs(gap)) DESC, feature LIMIT 5) SELECT feature, "
        + ", ".join(_r(f"coalesce(max(a) FILTER (WHERE s = {i}), 0)", f"S{i}") for i in range(1, 6))
        + " FROM no WHERE feature IN (SELECT feature FROM worst) GROUP BY feature",
        "legacy_feedback": "SELECT CASE event_type WHEN 'view' THEN 'helpful' WHEN 'click' THEN 'not_helpful' WHEN 'error' THEN"
        " 'false_alarm' ELSE event_type END AS feedback_type, 'agent_' || CAST(user_id % 3 AS VARCHAR) AS related_agent,"
        " 'analyst' AS user_role, count(*) AS events FROM events GROUP BY ALL",
        "feedback_load": FEEDBACK + "SELECT run_id, coalesce(feedback_type, '') AS feedback_type, feature, '' AS severity,"
        " count(*) AS events FROM feedback GROUP BY ALL",
        "change_log": RECOMMENDATIONS + " SELECT run_id, recommendation_id, CASE change_type"
        " WHEN 'seasonal_feature_tagging' THEN 'Repeated false-alarm feedback for ' || feature || '; review seasonal tagging before suppression.'"
        " WHEN 'increase_monitoring_priority' THEN 'Repeated accepted recommendations for ' || feature || ' support continued monitoring priority.'"
        " WHEN 'report_profile_adjustment' THEN 'Repeated executive or client-safe feedback indicates that report language is too technical.'"
        " ELSE 'Repeated rejection of ' || feature || ' indicates that escalation needs more supporting evidence.' END AS reason,"
        " 'recommended' AS status, 'No changes are applied automatically.' AS note, true AS requires_human_approval FROM rec",
        "table_scan": "SELECT o_orderpriority, count(*) AS orders, true AS reference_absent FROM orders GROUP BY o_orderpriority",
        "archived_reports": one + ", c AS (SELECT model_id, win, count(*) AS n FROM feats GROUP BY model_id, win)"
        " SELECT 'run_a' AS run_id, model_id, win, n FROM c UNION ALL SELECT 'run_b', model_id, win, 2 * n FROM c",
        "nested_reports": one + "SELECT 'run_a' AS run_id, model_id, win, count(*) AS n FROM feats GROUP BY model_id, win",
        "upserted_sections": one + ", c AS (SELECT model_id, win, count(*) AS n FROM feats GROUP BY model_id, win)"
        " SELECT 'other' AS section, model_id, win, n FROM c UNION ALL SELECT 'windows', model_id, win, n FROM c WHERE win = 'current'",
        "positional_scores": one + "SELECT f.entity_id AS row_no, "
        + ", ".join(_r(f"f.{c}", c) for c in FEATURES)
        + f", {_r('p.score', 'score')}, p.actual_label AS label FROM feats f JOIN cur p ON f.entity_id = p.entity_id WHERE f.win = 'current'",
        "segment_order": one + "SELECT feature, segment, row_number() OVER (ORDER BY CASE risk_level WHEN 'High' THEN 0 WHEN 'Medium'"
        " THEN 1 ELSE 2 END, abs(gap) DESC, feature, segment) - 1 AS place FROM seg",
        "same_run_records": FEEDBACK + f"SELECT run_id, count(*) AS records FROM feedback WHERE run_id IN (SELECT run_id FROM"
        f" ({REVIEW_RUNS}) r WHERE validation_auc IS NOT NULL) GROUP BY run_id",
        "overfitting_delta": f"SELECT run_id, {_r('train_auc', 'train_auc')}, {_r('validation_auc', 'validation_auc')},"
        f" {_r('train_auc - validation_auc', 'delta')}, CASE WHEN validation_auc IS NULL THEN 'Not Available' WHEN train_auc - validation_auc"
        " >= 0.07 THEN 'High' WHEN train_auc - validation_auc >= 0.03 THEN 'Medium' ELSE 'Low' END AS risk_level"
        f" FROM ({REVIEW_RUNS}) r",
        "feature_vif": fleet + f"SELECT g AS model_id, feature, {_r('vif', 'vif')}, vif_risk FROM vifl",
        "importance_rank": fleet + f"SELECT g AS model_id, feature, {_r('imp', 'mean_abs_shap')}, rk AS shap_rank FROM imp",
        "reliability_gate": fleet + "SELECT g AS model_id, CASE WHEN n > 0 THEN 'unreliable' ELSE 'reliable' END AS status, 'flag' AS gate_mode,"
        " false AS should_skip, n AS severe_features, coalesce(names, '') AS severe_names FROM (SELECT g, count(*) FILTER (WHERE s) AS n,"
        " string_agg(feature, ',' ORDER BY feature) FILTER (WHERE s) AS names FROM (SELECT g, feature, drift_level = 'High' AND"
        " (psi >= 0.5 OR pv < 0.001) AS s FROM drift) GROUP BY g)",
        "feature_risk_matrix": fleet + f"SELECT g AS model_id, feature, rk AS shap_rank, {_r('imp', 'mean_abs_shap')}, {_r('psi', 'psi')},"
        f" {_r('pv', 'ks_pvalue')}, {_r('w1', 'wasserstein_distance')}, drift_level, {_r('vif', 'vif')}, vif_risk, final_risk FROM matrix",
        "risk_scatter_frame": fleet + f"SELECT g AS model_id, feature, {_r('imp', 'mean_abs_shap')}, rk AS shap_rank, {_r('psi', 'psi')},"
        f" {_r('vif', 'vif')}, final_risk, drift_level, vif_risk, {_r('greatest(1, least(25, vif)) + 6', 'marker_size')} FROM matrix",
        "key_findings": fleet + ", ft AS (SELECT g, 1 AS part, row_number() OVER (PARTITION BY g ORDER BY psi DESC, feature) AS place,"
        " feature || ' is high drift and appears in the feature risk matrix.' AS finding FROM drift WHERE drift_level = 'High'"
        " UNION ALL SELECT g, 2, rk, feature || ' is a high-risk feature because it is model-important and has ' || lower(drift_level)"
        " || ' drift.' FROM matrix WHERE final_risk = 'High' UNION ALL SELECT g, 3, 1, 'Prediction drift is ' || drift_level ||"
        " ' based on score distribution shift and KS p-value.' FROM s_lvl UNION ALL SELECT g, 4, row_number() OVER (PARTITION BY g"
        " ORDER BY vif DESC, feature), 'VIF risk is High for ' || feature || '.' FROM vifl WHERE vif_risk = 'High'"
        " UNION ALL SELECT model_id, 5, 1, 'Train-validation AUC delta indicates ' || CASE WHEN train_auc - validation_auc >= 0.07"
        f" THEN 'high' ELSE 'medium' END || ' overfitting risk.' FROM ({REVIEW_MODEL_RUNS}) r WHERE train_auc - validation_auc >= 0.03)"
        " SELECT g AS model_id, row_number() OVER (PARTITION BY g ORDER BY part, place) AS finding_no, finding FROM ft",
        "recommended_actions": fleet + ", fl AS (SELECT g, bool_or(final_risk = 'High') AS h, bool_or(rk <= 5 AND drift_level = 'High') AS t,"
        " bool_or(vif_risk = 'High') AS v FROM matrix GROUP BY g), al AS (SELECT g, list_filter(list_concat(list_concat(["
        "CASE WHEN h THEN 'Review high-risk feature stability and consider recalibration before activation.' END,"
        " CASE WHEN sl = 'High' THEN 'Run validation before campaign or model activation because prediction drift is High.' END,"
        " CASE WHEN hi + me > 0 THEN 'Review upstream data pipelines for medium or high data-quality issues.' END,"
        f" CASE WHEN v THEN 'Review feature redundancy and consider consolidating high-VIF features.' END], {CHECKS}),"
        " [CASE WHEN t AND NOT h THEN 'Review high-risk feature stability and consider recalibration before activation.' END,"
        " CASE WHEN v THEN 'Review redundancy and consider consolidating high-VIF features.' END]), lambda x: x IS NOT NULL) AS a"
        " FROM cnt JOIN fl USING (g)) SELECT g AS model_id, i - 1 AS action_no, a[i] AS action FROM (SELECT g, a,"
        " unnest(range(1, len(a) + 1)) AS i FROM al)",
        "model_health_status": fleet + "SELECT g AS model_id, CASE WHEN lvl = 'High' OR t THEN 'High Risk' WHEN lvl = 'Medium' OR m >= 2"
        " THEN 'Medium Risk' ELSE 'Low Risk' END AS model_health_status FROM decision JOIN (SELECT g, bool_or(final_risk = 'High' AND rk <= 5"
        " AND drift_level = 'High') AS t, count(*) FILTER (WHERE final_risk = 'Medium') AS m FROM matrix GROUP BY g) USING (g)",
        "top_drivers": fleet + "SELECT g AS model_id, rk AS shap_rank, feature || ' is label correlation rank ' || rk || ' with |correlation| ' ||"
        " printf('%.4f', imp) || '.' AS driver FROM imp WHERE rk <= 5",
        "high_risk_lines": fleet + "SELECT g AS model_id, feature, feature || ': ' || CASE WHEN rk <= 5 AND drift_level = 'High' THEN"
        " 'High because the feature is a top-5 SHAP driver with High drift.' ELSE"
        " 'High because the feature is a top-5 SHAP driver with High VIF risk.' END AS line FROM matrix WHERE final_risk = 'High'",
        "feedback_summary": FEEDBACK + "SELECT run_id, 'total' AS summary, '' AS item, count(*) AS events FROM feedback GROUP BY run_id"
        " UNION ALL " + summary_union,
        "feedback_patterns": PATTERNS + " SELECT * FROM patterns",
        "calibration_recommendations": RECOMMENDATIONS + " SELECT run_id, recommendation_id, change_type, target_config_path, feature,"
        " recommended_value, confidence FROM rec",
        "proposed_config": RECOMMENDATIONS + ", latest AS (SELECT run_id, target_config_path AS path, arg_max(recommended_value, no) AS value"
        f" FROM rec GROUP BY ALL), active AS (SELECT * FROM (VALUES {config}) t(path, value)), runs AS (SELECT run_id FROM ({REVIEW_RUNS}) r),"
        " heads AS (SELECT * FROM (VALUES ('config_version', 'v2_recommended'), ('version', 'v2_recommended'), ('based_on', 'v1'),"
        " ('generated_by', 'scorewatch')) t(path, value)), status AS (SELECT run_id, 'approval_status' AS path, CASE WHEN run_id IN"
        " (SELECT run_id FROM rec) THEN 'pending_human_review' ELSE 'no_changes_recommended' END AS value FROM runs) SELECT run_id, path, value, true AS changed FROM latest UNION ALL SELECT run_id, path, value,"
        " false FROM runs, active WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.run_id = runs.run_id AND l.path = active.path)"
        " UNION ALL SELECT run_id, path, value, false FROM runs, heads UNION ALL SELECT run_id, path, value, false FROM status",
        "human_review": fleet + ", " + (PATTERNS + RECOMMENDATIONS[len(PATTERNS) :]).replace(
            f"WITH feedback AS ({REVIEW_FEEDBACK})", f"feedback AS (SELECT *, model_id AS run_id FROM ({REVIEW_MODEL_FEEDBACK}) m)"
        )
        + " SELECT run_id AS model_id, recommendation_id, change_type, feature, confidence FROM rec UNION ALL"
        " SELECT d.g, 'REC_001', 'human_review', '', 'High' FROM decision d WHERE d.g NOT IN (SELECT run_id FROM feedback)"
        " AND (lvl = 'High' OR d.g IN (SELECT g FROM matrix WHERE final_risk = 'High'))",
        "config_documents": f"WITH docs AS ({REVIEW_CONFIGS}), paths AS (SELECT * FROM (VALUES {known_paths}) t(path, field, place)),"
        f" fallbacks AS (SELECT * FROM (VALUES {fallbacks}) t(field, fallback)),"
        " given AS (SELECT run_id, field, arg_max(v, place) AS v FROM (SELECT run_id, field, place, json_extract_string(config, '$.' || path)"
        " AS v FROM docs, paths) WHERE v IS NOT NULL GROUP BY ALL), act AS (SELECT run_id, field, coalesce(v, CASE WHEN config IS NULL"
        " AND field = 'config_version' THEN 'fallback_defaults' ELSE fallback END) AS value, v IS NOT NULL AS given"
        " FROM (SELECT * FROM docs, fallbacks) d LEFT JOIN given USING (run_id, field)) SELECT run_id, field, round(TRY_CAST(value AS DOUBLE), 6) AS number,"
        " CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text, given FROM act",
        "feature_selection": one + f", cols AS (SELECT column_name AS c, row_number() OVER () AS n, column_type NOT IN ('VARCHAR', 'DATE') AS numeric"
        f" FROM (DESCRIBE WITH review_base AS ({REVIEW_BASE}) {REVIEW_FEATURES})),"
        " pcols AS (SELECT column_name AS c, row_number() OVER () AS n, column_type NOT IN ('VARCHAR', 'DATE') AS numeric"
        f" FROM (DESCRIBE WITH review_base AS ({REVIEW_BASE}) {REVIEW_PREDICTIONS})),"
        " wanted AS (SELECT * FROM (VALUES ('price', 1), ('loyalty_tier', 2), ('win', 3), ('qty', 4)) t(c, n)),"
        " picks AS (SELECT 'review_declared' AS chosen_by, c, w.n FROM wanted w JOIN cols USING (c) WHERE numeric"
        " UNION ALL SELECT 'model_declared', c, w.n FROM wanted w JOIN cols USING (c) WHERE numeric AND c NOT IN ('label', 'entity_id')"
        " UNION ALL SELECT 'review_all', c, n FROM cols WHERE numeric AND c NOT IN ('label', 'entity_id', 'urgent')"
        " UNION ALL SELECT 'model_all', c, n FROM (SELECT c, n FROM cols WHERE numeric UNION ALL SELECT c, 100 + n FROM pcols WHERE numeric"
        " AND c NOT IN (SELECT c FROM cols)) WHERE c NOT IN ('label', 'entity_id', 'model_id', 'predicted_label', 'actual_label')"
        " AND NOT regexp_matches(c, '(_label|_score|_prediction)$')),"
        " counted AS (UNPIVOT (SELECT " + ", ".join(f"CAST(count({c}) AS BIGINT) AS {c}" for c in ("entity_id", "model_id", *FEATURES, "label"))
        + " FROM feats WHERE win = 'train') ON COLUMNS(*) INTO NAME feature VALUE known)"
        " SELECT chosen_by, CAST(row_number() OVER (PARTITION BY chosen_by ORDER BY p.n) - 1 AS INTEGER) AS place, c AS feature,"
        " known AS known_cells FROM picks p LEFT JOIN counted ON counted.feature = c",
        "feedback_intake": FEEDBACK + "SELECT CASE WHEN feedback_type IS NULL THEN 'rejected' ELSE 'accepted' END AS outcome,"
        " coalesce(feedback_type, '') AS feedback_type, count(*) AS events FROM feedback GROUP BY ALL",
    }
    sql["evidence_paths"] = _packet_sql(sql, fleet)
    sql["contract_violations"] = one + sql["contract_violations"].replace(" FROM f WHERE", " FROM feats WHERE")
    return sql
