"""Second-order boosting against plain Python, drawing, and the jobs that use it."""

import math
import random

import pytest

from vitalgrid.operators import boosting as B
from vitalgrid.operators.features import Encoder
from vitalgrid.plans import pipeline


def table(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = [rng.choice([None, float("nan"), 0.0, 1.0]) if rng.random() < 0.1 else round(rng.uniform(-3, 3), 2) for _ in range(4)]
        v = [0.0 if a is None or a != a else a for a in x]
        rows.append((*x, int(v[0] + v[1] * v[2] + rng.gauss(0, 0.5) > 0)))
    return rows


NAMES = ["a", "b b", "c", "d"]


def frame(spark, rows):
    return spark.createDataFrame(rows, "a double, `b b` double, c double, d double, y int").repartition(3)


def plain(rows, cuts, p, columns_of):
    """The same algorithm, one split after another, over lists."""
    data = [([0.0 if a is None or a != a else a for a in r[:4]], r[4]) for r in rows]
    margin = [0.0] * len(data)
    trees = []
    for t in range(p.rounds):
        grad = [(1 / (1 + math.exp(-m)) - y, 1 / (1 + math.exp(-m)) * (1 - 1 / (1 + math.exp(-m)))) for m, (_, y) in zip(margin, data)]
        tree = {}

        def part(g, h):
            return g * g / (h + p.reg_lambda)

        def build(node, members, level):
            ga, ha = (sum(grad[i][k] for i in members) for k in (0, 1))
            best = None
            if level < p.depth:
                for f in columns_of(t):
                    for cut in cuts[f]:
                        left = [i for i in members if data[i][0][f] <= cut]
                        gl, hl = (sum(grad[i][k] for i in left) for k in (0, 1))
                        if hl < p.least_child_curvature or ha - hl < p.least_child_curvature:
                            continue
                        gain = round((part(gl, hl) + part(ga - gl, ha - hl) - part(ga, ha)) / 2 - p.gamma, 9)
                        if best is None or gain > best[0]:
                            best = gain, f, cut, left
            if best and best[0] > 0:
                tree[node] = best[1:3]
                rest = set(best[3])
                build(2 * node + 1, best[3], level + 1)
                build(2 * node + 2, [i for i in members if i not in rest], level + 1)
            else:
                w = -p.rate * ga / (ha + p.reg_lambda)
                tree[node] = w
                for i in members:
                    margin[i] += w

        build(0, list(range(len(data))), 0)
        trees.append(tree)
    return trees, margin


def test_equals_plain_python(spark, monkeypatch):
    monkeypatch.setattr(B, "REFRESH", 2)
    rows = table()
    p = B.BoostParams(rounds=5, depth=3, rate=0.3, row_share=1.0, column_share=0.5, gamma=0.01, least_child_curvature=2.0)
    cuts = [[-2.0, -1.0, 0.0, 1.0, 2.0], [-1.5, 0.0, 1.5], [0.0], [-1.0, 1.0]]
    df = frame(spark, rows)
    model = B.train(df, NAMES, "y", p, cuts)
    trees, margin = plain(rows, cuts, p, lambda t: B.drawn_columns(p, t, 4))
    for got, want in zip(model.trees, trees):
        assert {n: (s.feature, s.cut) for n, s in got.splits.items()} == {n: v for n, v in want.items() if isinstance(v, tuple)}
        assert got.leaves == pytest.approx({n: v for n, v in want.items() if not isinstance(v, tuple)}, abs=1e-9)
    scored = model.score(df).select("score", "y").collect()
    assert sorted(r.score for r in scored) == pytest.approx(sorted(1 / (1 + math.exp(-m)) for m in margin), abs=1e-9)
    assert any(len(t.splits) > 1 for t in model.trees)


def test_bins(spark):
    cuts = [-1.0, 0.5, 2.0, 7.0]
    xs = [-5.0, -1.0, -0.9, 0.5, 0.6, 2.0, 6.9, 7.0, 8.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = {r.x: r.b for r in df.select("x", B.bin_of(df.x, cuts).alias("b")).collect()}
    assert got == {x: sum(c < x for c in cuts) for x in xs}
    assert df.select(B.bin_of(df.x, []).alias("b")).distinct().first().b == 0


def test_quantile_cuts_are_within_their_bound(spark):
    df = spark.range(20000).selectExpr("CAST(id * 7919 % 20000 AS DOUBLE) AS a", "CAST(NULL AS DOUBLE) AS n", "CAST(id % 2 AS INT) AS two")
    a, n, two = B.quantile_cuts(df, ["a", "n", "two"], 10)
    assert all(abs(q - i * 2000) <= 4 for i, q in enumerate(a, 1)) and n == [0.0] and two == [0.0, 1.0]


def test_learns_with_drawn_rows_and_columns(spark):
    df = frame(spark, table(1500, 5))
    model = B.train(df, NAMES, "y", B.BoostParams(rounds=15, rate=0.3, depth=3, bins=32))
    rows = model.score(df).select("score", "y").collect()
    assert sum((r.score > 0.5) == (r.y == 1) for r in rows) > 0.85 * len(rows)
    assert B.drawn_columns(B.BoostParams(column_share=0.8), 3, 10) == B.drawn_columns(B.BoostParams(column_share=0.8), 3, 10)
    assert {len(B.drawn_columns(B.BoostParams(column_share=0.8), t, 10)) for t in range(20)} == {8}


def test_no_rows_and_one_class(spark):
    empty = B.train(frame(spark, [])[["a", "b b", "c", "d", "y"]], NAMES, "y", B.BoostParams(rounds=2))
    assert [r.score for r in empty.score(frame(spark, table(3))).collect()] == [0.5] * 3
    one = B.train(frame(spark, [(*r[:4], 1) for r in table(50)]), NAMES, "y", B.BoostParams(rounds=3, row_share=1.0))
    assert all(r.score > 0.5 for r in one.score(frame(spark, table(20))).collect())


def test_histograms_and_not_rows_are_shuffled(spark):
    rows = spark.range(1000).selectExpr("CAST(id % 2 AS INT) AS node", "CAST(id AS DOUBLE) AS g", "0.25D AS h", "CAST(id % 5 AS SMALLINT) AS b0", "CAST(id % 3 AS SMALLINT) AS b1")
    plan = B._best_splits(rows, [0, 1], B.BoostParams())._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(g" in plan, plan
    assert "Python" not in plan and "SinglePartition" not in plan


def test_save_and_serve(spark, tmp_path):
    df = frame(spark, table())
    model = B.train(df, NAMES, "y", B.BoostParams(rounds=2, depth=2))
    B.save(spark, model, str(tmp_path / "m"), Encoder((("Sex", "Male"),), True))
    back, encoder = B.load(spark, str(tmp_path / "m"))
    assert back == model and encoder == Encoder((("Sex", "Male"),), True)
    rows = spark.createDataFrame([("p", 1.0, 2.0, "male")], "`Patient ID` string, a double, c double, Sex string")
    scored = B.serving_scorer(back, ["a", "c", "Sex_Male"], encoder)
    assert pipeline.METHODS == ("trees", "boosted") and callable(scored) and rows.count() == 1
