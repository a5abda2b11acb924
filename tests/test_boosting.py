"""Boosted trees against plain numpy, and when training ends."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from wattline import config as C
from wattline.operators import boosting, model

CONFIG = C.ForecastConfig(
    features=("a", "b", "same", "c d"), target="y", max_iter=4, max_depth=3, step_size=0.3, subsample=1.0, column_share=1.0,
    min_instances=5, l1=0.5, l2=1.5, patience=3,
)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(3000).selectExpr("cast(id % 60 as double) AS a", "cast(id % 7 as int) AS b", "1.0D AS same", "cast(id % 11 as double) / 3 AS `c d`", "id")
    noise = F.pmod(F.xxhash64("id"), F.lit(100)) / 50
    df = df.withColumn("y", F.col("a") / 2 + F.sin("b") * 3 + noise)
    return df.withColumn("y", F.when(F.col("id") % 500 != 3, F.col("y"))).withColumn("a", F.when(F.col("id") % 700 != 5, F.col("a")))


def plain(x, y, c):
    """Predictions after each round; every value of every feature is tried."""
    pred, out = np.full(len(y), y.mean()), []

    def score(g, h):
        return max(abs(g) - c.l1, 0) ** 2 / (h + c.l2)

    def grow(inside, g, depth):
        best = None
        if depth < c.max_depth:
            for f in range(x.shape[1]):
                for v in np.unique(x[inside, f])[1:]:
                    left, right = inside & (x[:, f] < v), inside & (x[:, f] >= v)
                    if min(left.sum(), right.sum()) < c.min_instances:
                        continue
                    gain = (score(g[left].sum(), left.sum()) + score(g[right].sum(), right.sum()) - score(g[inside].sum(), inside.sum())) / 2
                    if gain > 0 and (best is None or round(math.log(gain), 9) > best[0]):
                        best = round(math.log(gain), 9), left, right
        if best is None:
            total = g[inside].sum()
            pred[inside] -= c.step_size * math.copysign(max(abs(total) - c.l1, 0), total) / (inside.sum() + c.l2)
        else:
            grow(best[1], g, depth + 1)
            grow(best[2], g, depth + 1)

    for _ in range(c.max_iter):
        grow(np.ones(len(y), bool), pred - y, 0)
        out.append(pred.copy())
    return out


def test_trees_equal_plain_numpy(spark, rows):
    fitted = boosting.fit(rows, None, CONFIG)
    whole = rows.dropna()
    pdf = boosting.predict(fitted, whole).toPandas()
    want = plain(pdf[list(CONFIG.features)].to_numpy(float), pdf.y.to_numpy(), CONFIG)[-1]
    assert np.abs(pdf.pred.to_numpy() - want).max() < 1e-8
    assert len(fitted.trees) == 4 and all(t.splits for t in fitted.trees)


def test_training_ends_when_no_round_is_better(spark, rows, monkeypatch):
    grown = []
    real = boosting.grow_tree
    monkeypatch.setattr(boosting, "grow_tree", lambda *a: grown.append(1) or real(*a))
    c = replace(CONFIG, max_iter=200, step_size=1.0, max_depth=4, l1=0.0, l2=0.0)
    train, val = rows.where("id % 3 <> 0"), rows.where("id % 3 = 0").withColumn("y", F.col("y") + F.pmod(F.xxhash64("id"), F.lit(7)))
    kept = boosting.fit(train, val, c)
    best = int(np.argmin(kept.errors))
    assert len(kept.errors) == len(grown) == best + 1 + c.patience < 200
    assert len(kept.trees) == best + 1
    whole = val.dropna()
    got = boosting.predict(kept, whole).agg(F.avg(F.abs(F.col("pred") - F.col("y")))).first()[0]
    assert got == pytest.approx(kept.errors[best], rel=1e-9)


def test_shares_of_rows_and_columns(spark, rows):
    c = replace(CONFIG, subsample=0.5, column_share=0.5, max_iter=3)
    one, two = (boosting.fit(rows.repartition(n), None, c) for n in (2, 9))
    assert [t.splits.keys() for t in one.trees] == [t.splits.keys() for t in two.trees]
    assert all(len({s.feature for s in t.splits.values()}) <= 2 for t in one.trees)
    used = sum(s.rows for t in one.trees for n, s in t.splits.items() if n == 1) / 3
    assert 0.4 * 3000 < used < 0.6 * 3000
    assert boosting.chosen_features(range(10), 0.5, 1, 2) == boosting.chosen_features(range(10), 0.5, 1, 2)


def test_bins_at_equal_shares(spark):
    df = spark.range(10_000).selectExpr("cast(id as double) AS a", "cast(id % 3 as double) AS b", "cast(id as double) * 2 AS y")
    edges = boosting.bin_edges(df, ["a", "b"], 16)
    assert edges["b"] == [1.0, 2.0]
    assert edges["a"] == pytest.approx([625.0 * i for i in range(1, 16)], abs=1.5)
    bins = boosting.binned(df, "y", edges)
    counts = {tuple(r.bins): r["count"] for r in bins.groupBy("bins").count().collect()}
    assert len(counts) == 48 and all(207 <= n <= 210 for n in counts.values())
    many = spark.range(5000).selectExpr("cast(id % 300 as double) AS a", "1.0D AS b", "2.0D AS y")
    assert boosting.bin_edges(many, ["b", "a"], 256) == {"b": [], "a": [2.0 * i for i in range(1, 150)]}


def test_saved_trees_and_missing_values(spark, rows, folder):
    fitted = boosting.fit(rows, rows.limit(0), CONFIG)
    fitted.save(spark, f"{folder}/m")
    again = boosting.BoostedTrees.load(spark, f"{folder}/m")
    assert again == fitted
    odd = spark.createDataFrame([(None, None, None, None), (float("nan"), 1, 1.0, 1e300)], "a double, b int, same double, `c d` double")
    assert all(r.pred is not None for r in boosting.predict(again, odd).collect())
    clipped = model.predict(again, odd, lo=0, hi=1).collect()
    assert all(0 <= r.pred <= 1 for r in clipped)


def test_importance_is_the_mean_gain(spark, rows):
    fitted = boosting.fit(rows, None, CONFIG)
    got = {r.feature: r.importance for r in boosting.importance(fitted, spark).collect()}
    assert got["same"] == 0 and sum(got.values()) == pytest.approx(1) and got["a"] > 0.5


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1.0, 5.0)] * 4, "a double, y double")
    c = replace(CONFIG, features=("a",), max_iter=2)
    assert {r.pred for r in boosting.predict(boosting.fit(df, None, c), df).collect()} == {5.0}
    with pytest.raises(ValueError):
        boosting.fit(df.limit(0), None, c)


def test_versions_are_claimed_once(spark, folder):
    ids = [model.next_run_id(spark, folder, "t", "2026-01-01") for _ in range(3)]
    assert [i.split("__")[0] for i in ids] == ["v1", "v2", "v3"]
