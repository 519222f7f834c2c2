"""Histogram trees against a plain grower over the collected table."""

import numpy as np
import pytest

from riskframe.operators import trees as tr

FEATURES = ["a", "b", "c", "d"]


def table(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 5, n), rng.integers(0, 2, n), rng.normal(size=n)])
    y = ((x[:, 0] + x[:, 1] - 2 + 2 * x[:, 2] + rng.normal(size=n) * 0.5) > 1).astype(float)
    rows = [(*map(float, r), float(l), float(1.0 + l), i % 3, i) for i, (r, l) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, label double, weight double, fold int, id long").repartition(3).cache()


def plain_tree(bins, g, h, n, s, m, t, depth):
    """(column, bin, left, right) or a leaf's value, grown by trying every split; nodes numbered level by level."""
    out, queue, size = {}, [(0, np.ones(len(g), bool), 0)], 1
    while queue:
        node, rows, level = queue.pop(0)
        value = -g[rows].sum() / (h[rows].sum() + s.penalty) if h[rows].sum() + s.penalty > 0 else 0.0
        best = None
        if level < depth and n[rows].sum() >= s.min_split:
            for c in tr.allowed(s, m, t, node, bins.shape[1]):
                for cut in range(bins[:, c].max() + 1):
                    l = rows & (bins[:, c] <= cut)
                    r = rows & ~l
                    if n[l].sum() < max(s.min_leaf, 1) or n[r].sum() < max(s.min_leaf, 1):
                        continue
                    gain = sum(g[k].sum() ** 2 / (h[k].sum() + s.penalty) for k in (l, r)) - g[rows].sum() ** 2 / (h[rows].sum() + s.penalty)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, c, cut, l, r
        out[node] = (value, None) if best is None else (value, (best[1], best[2], size, size + 1))
        if best is not None:
            queue += [(size, best[3], level + 1), (size + 1, best[4], level + 1)]
            size += 2
    return out


def same(tree, want, scale):
    assert len(tree.column) == len(want)
    for node, (value, split) in want.items():
        assert tree.value[node] == pytest.approx(value * scale, abs=1e-9)
        assert split == ((tree.column[node], tree.bin[node], tree.left[node], tree.right[node]) if tree.column[node] >= 0 else None)


def test_trees_equal_a_plain_grower(spark):
    df = table(spark)
    settings = [tr.Setting("boosting", 3, 3, 0.3, rows=0.7, columns=0.5, fold=1), tr.Setting("boosting", 2, 2, 0.1, min_split=40, min_leaf=15),
                tr.Setting("forest", 3, 4, min_split=10, min_leaf=4, penalty=0.0, fold=0), tr.Setting("forest", 2, 2, penalty=0.0)]
    models = tr.fit(df, FEATURES, settings, weight="weight", bins=16, key="id")
    from pyspark.sql import functions as F

    data = np.array(df.select(*FEATURES, "label", "weight", "fold").collect())
    keys = np.array([r[0] for r in df.select(F.xxhash64("id")).collect()], np.int64).view(np.uint64)
    bins = tr.binned(data[:, :4], models[0].edges)
    y, w = data[:, 4], data[:, 5]
    for m, (s, model) in enumerate(zip(settings, models)):
        assert len(model.trees) == s.trees
        use = data[:, 6] != s.fold if s.fold is not None else np.ones(len(y), bool)
        margin = np.zeros(len(y))
        for t, tree in enumerate(model.trees):
            if s.kind == "boosting":
                rows = use & (tr.uniforms(keys, t) < s.rows)
                p = 1 / (1 + np.exp(-margin))
                g, h, n = p - y, p * (1 - p), np.ones(len(y))
            else:
                n = tr.draws(keys, t)
                rows = use & (n > 0)
                g, h = -w * n * y, w * n
            same(tree, plain_tree(bins[rows], g[rows], h[rows], n[rows], s, m, t, s.depth), s.rate if s.kind == "boosting" else 1.0)
            margin += np.array(tree.value)[tree.node_of(bins)]
        scored = {r["id"]: r["probability"] for r in model.score(df, ["id"]).collect()}
        assert len(scored) == 400 and all(0 <= p <= 1 for p in scored.values())
        ids = [r[0] for r in df.select("id").collect()]
        assert np.mean([(scored[i] >= 0.5) == (l > 0) for i, l in zip(ids, y)]) > 0.75


def test_grid_settings_have_effect():
    a = tr.Setting.of("random_forest", {"n_estimators": 7, "max_depth": None, "min_samples_split": 5, "min_samples_leaf": 2})
    assert (a.trees, a.depth, a.min_split, a.min_leaf, a.kind) == (7, 30, 5, 2, "forest")
    b = tr.Setting.of("gradient_boosting", {"n_estimators": 9, "max_depth": 5, "learning_rate": 0.3, "subsample": 0.8, "colsample_bytree": 0.7}, 2)
    assert (b.trees, b.depth, b.rate, b.rows, b.columns, b.fold) == (9, 5, 0.3, 0.8, 0.7, 2)
    assert tr.allowed(b, 0, 3, 1, 10) == tr.allowed(b, 0, 3, 5, 10) and len(tr.allowed(b, 0, 3, 1, 10)) == 7


def test_draws_are_poisson_and_fixed():
    keys = np.arange(200_000, dtype=np.uint64)
    n = tr.draws(keys, 5)
    assert abs(n.mean() - 1) < 0.01 and abs((n == 0).mean() - np.exp(-1)) < 0.01
    assert (n == tr.draws(keys, 5)).all() and (n != tr.draws(keys, 6)).any()


def test_constant_columns_and_missing_values(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0, 0.0), (1.0, 2.0, 0.0, 1.0)] * 10, "a double, b double, c double, label double")
    model = tr.fit(df, ["a", "b", "c"], [tr.Setting("forest", 1, 3, penalty=0.0)], fold_col=None)[0]
    assert model.trees[0].column == [-1] and 0 <= model.trees[0].value[0] <= 1
    with pytest.raises(Exception, match="impute"):
        tr.fit(df.selectExpr("CASE WHEN label = 1 THEN a END AS a", "b", "c", "label"), ["a", "b", "c"], [tr.Setting("forest", 1, 1)], fold_col=None)


def test_shapley_values_equal_all_coalitions(spark):
    """f(S): known columns decide, unknown ones share by weight; every order of columns."""
    from itertools import combinations
    from math import factorial

    from riskframe.operators import explain as xp

    df = table(spark, 150)
    for setting in (tr.Setting("boosting", 2, 4, 0.3), tr.Setting("forest", 2, 4, penalty=0.0)):
        model = tr.fit(df, FEATURES, [setting], fold_col=None, bins=16, key="id")[0]

        def value(t, x, known, node=0):
            c = t.column[node]
            if c < 0:
                return t.value[node]
            if c in known:
                return value(t, x, known, t.left[node] if x[c] <= t.bin[node] else t.right[node])
            l, r = t.left[node], t.right[node]
            return (t.weight[l] * value(t, x, known, l) + t.weight[r] * value(t, x, known, r)) / (t.weight[l] + t.weight[r])

        got = {}
        for r in xp.shap_trees(df, model, "id").collect():
            got.setdefault(r["id"], {})[r["feature"]] = (r["phi"], r["base"])
        data = np.array(df.select("id", *FEATURES).collect())
        bins = tr.binned(data[:, 1:], model.edges)
        scale = 0.5 if setting.kind == "forest" else 1.0
        margins = model.margins(bins)
        assert len(got) == 150
        for k in range(0, 150, 7):
            f = {s: scale * sum(value(t, bins[k], s) for t in model.trees) for n in range(5) for s in combinations(range(4), n)}
            for j, name in enumerate(FEATURES):
                want = sum(factorial(len(s)) * factorial(3 - len(s)) / 24 * (f[tuple(sorted((*s, j)))] - f[s]) for s in f if j not in s)
                assert got[int(data[k, 0])][name][0] == pytest.approx(want, abs=1e-9)
            mine = got[int(data[k, 0])]
            assert sum(p for p, _ in mine.values()) + mine["a"][1] == pytest.approx(margins[k], abs=1e-9)
            assert mine["a"][1] == pytest.approx(f[()], abs=1e-9)


def test_search_and_few_nodes_at_once(spark, monkeypatch):
    df = table(spark)
    settings = [{"n_estimators": 2, "max_depth": 3, "min_samples_split": k} for k in (2, 100)]
    models, recalls = tr.search(df, FEATURES, "random_forest", settings, key="id", bins=16)
    assert len(models) == 2 * 4 and recalls.count() == 2 * 3
    assert sum(len(t.column) for t in models[0, None].trees) > sum(len(t.column) for t in models[1, None].trees)
    y = {r["id"]: (r["label"], r["fold"]) for r in df.collect()}
    for r in recalls.collect():
        p = {x["id"]: x["probability"] for x in models[r["draw"], r["fold"]].score(df, ["id"]).collect()}
        mine = [i for i, (l, f) in y.items() if l > 0 and f == r["fold"]]
        assert (r["n_positive"], r["n_found"]) == (len(mine), sum(p[i] >= 0.5 for i in mine))
    monkeypatch.setattr(tr, "HELD", 3 * 4 * 16 * 24)
    again = tr.fit(df, FEATURES, [tr.Setting.of("random_forest", settings[0])], weight="weight", bins=16, key="id")[0]
    assert [t.column for t in again.trees] == [t.column for t in models[0, None].trees]


def test_a_node_counts_only_columns_that_may_split_it():
    forest = tr.Setting.of("random_forest", {"n_estimators": 2, "max_depth": 3})
    for node in range(5):
        got = tr.counted(forest, 0, 1, node, 36).tolist()
        assert set(got) == {0, *tr.allowed(forest, 0, 1, node, 36)} and len(got) <= 7


def test_forest_keeps_the_node_of_each_row(spark):
    """The forest of Spark ML moves rows by a level a pass, and is the one that walks from the roots would give."""
    from pyspark.ml import Pipeline

    from riskframe.operators import models as md

    df = table(spark, 150)
    forest = md.estimator("random_forest", {"n_estimators": 4, "max_depth": 4})
    assert forest.getCacheNodeIds()
    grown = [Pipeline(stages=[md.assembler(FEATURES), e]).fit(df).stages[-1].toDebugString.split("\n", 1)[1] for e in (forest, forest.copy().setCacheNodeIds(False))]
    assert grown[0] == grown[1]
