"""Boosted regression trees grown by Spark aggregations, with penalties and a stop while training.

Features are cut into bins at quantiles once, into a stored table. A level of a tree is one aggregation of the
gradients by (node, feature, bin); the driver sees one row per open node. Rounds after the stop are never computed.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wattline.config import ForecastConfig
from wattline.session import stored
from wattline.sources.tables import delete, stored_path

ROOT = 1
#: Trees whose part of the prediction is an expression; then rows are stored anew with their prediction.
OPEN_TREES = 3


@dataclass(frozen=True)
class Split:
    """A node of a tree: rows with `feature < cut` go left, to node 2n, the others to 2n + 1. `bin` is the cut's number."""

    feature: str
    bin: int
    cut: float
    gain: float
    rows: int


@dataclass
class Tree:
    """Splits and leaf weights by node number; the root is 1."""

    splits: dict[int, Split] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=dict)

    def value(self, goes_left, leaf, node: int = ROOT) -> Column:
        """The tree as one nested condition: goes_left(split) is a condition, leaf(node) a value."""
        if node not in self.splits:
            return leaf(node)
        below = [self.value(goes_left, leaf, 2 * node + side) for side in (0, 1)]
        return F.when(goes_left(self.splits[node]), below[0]).otherwise(below[1])


@dataclass
class BoostedTrees:
    """Base value and trees; `errors` are the mean absolute errors on the validation rows after each round that was
    grown, of which the best `len(trees)` are kept."""

    features: list[str]
    target: str
    base: float
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)

    def rows(self) -> list[tuple]:
        out = []
        for i, t in enumerate(self.trees):
            out += [(i, n, s.feature, s.bin, s.cut, s.gain, s.rows, None) for n, s in t.splits.items()]
            out += [(i, n, None, None, None, None, None, w) for n, w in t.weights.items()]
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees as a Parquet table of nodes, the rest as one JSON line."""
        nodes = spark.createDataFrame(self.rows(), NODES)
        nodes.coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        about = {"features": self.features, "target": self.target, "base": self.base, "errors": self.errors, "rounds": len(self.trees)}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        about = json.loads(spark.read.text(f"{path}/about").first()[0])
        trees = [Tree() for _ in range(about["rounds"])]
        for r in spark.read.schema(NODES).parquet(f"{path}/nodes").collect():
            if r.feature is None:
                trees[r["round"]].weights[r.node] = r.weight
            else:
                trees[r["round"]].splits[r.node] = Split(r.feature, r["bin"], r.cut, r.gain, r["rows"])
        return cls(about["features"], about["target"], about["base"], trees, about["errors"])


NODES = "round int, node int, feature string, bin int, cut double, gain double, rows long, weight double"


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Ascending lower edges of the bins after the first, by feature: every distinct value but the least where there are
    no more than `bins`, else values at equal shares of the rows, a ten-thousandth of them off at most. A constant feature
    has none.

    One aggregation of sketches; only the values of features that have few are counted exactly. No value is shuffled
    more than once a task.
    """
    columns = {f: F.col(f"`{f}`").cast("double") for f in features}
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    sketch = [F.approx_count_distinct(c).alias(f"n{i}") for i, c in enumerate(columns.values())]
    sketch += [F.percentile_approx(c, shares, F.lit(10_000)).alias(f"q{i}") for i, c in enumerate(columns.values())]
    about = df.agg(*sketch, *[F.min(c).alias(f"m{i}") for i, c in enumerate(columns.values())]).first()
    few = [f for i, f in enumerate(features) if about[f"n{i}"] <= 1.5 * bins]
    out = {f: sorted({v for v in about[f"q{i}"] or () if v > about[f"m{i}"]}) for i, f in enumerate(features) if f not in few}
    if few:
        values = df.select(*[columns[f].alias(f) for f in few]).unpivot([], few, "feature", "value").distinct().collect()  # about features x bins rows
        for f in few:
            own = sorted(r.value for r in values if r.feature == f)
            step = max(1, math.ceil(len(own) / bins))
            out[f] = own[step::step]
    return {f: out[f] for f in features}


def binned(df: DataFrame, target: str, edges: Mapping[str, list[float]]) -> DataFrame:
    """y and bins, the array of bin numbers in the order of `edges`, of the rows without NULL or NaN."""
    names = list(edges)
    rows = df.select(F.col(f"`{target}`").cast("double").alias("y"), *[F.col(f"`{f}`").cast("double").alias(f"_x{i}") for i, f in enumerate(names)]).dropna()
    cut = [i for i, f in enumerate(names) if edges[f]]
    if cut:
        rows = Bucketizer(
            splitsArray=[[-float("inf"), *edges[names[i]], float("inf")] for i in cut],
            inputCols=[f"_x{i}" for i in cut],
            outputCols=[f"_b{i}" for i in cut],
        ).transform(rows)
    number = [F.col(f"_b{i}") if i in cut else F.lit(0.0) for i in range(len(names))]
    return rows.select("y", F.array(*[b.cast("short") for b in number]).alias("bins"))


def soft(gradient: Column, l1: float) -> Column:
    """The gradient brought nearer to 0 by the L1 penalty."""
    return F.signum(gradient) * F.greatest(F.abs(gradient) - l1, F.lit(0.0))


def best_splits(rows: DataFrame, features: Sequence[int], c: ForecastConfig) -> list:
    """One row per node of rows (node, g, bins): gradient and rows of the node, and its best split, if any gains.

    Ties, up to the ninth digit, go to the first feature and the least cut.
    """
    each = F.array(*[F.struct(F.lit(f).alias("f"), F.col("bins")[f].alias("b")) for f in features])
    sums = rows.select("node", "g", F.inline(each)).groupBy("node", "f", "b").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("h"))
    sums = sums.repartition("node")  # a few numbers for each bin; what follows stays there
    whole = Window.partitionBy("node", "f")
    upto = whole.orderBy("b")
    left = sums.select(
        "node", "f", "b",
        F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(whole).alias("g"), F.sum("h").over(whole).alias("h"),
    )
    score = lambda g, h: soft(g, c.l1) * soft(g, c.l1) / (h + c.l2)
    gl, hl, g, h = (F.col(n) for n in ("gl", "hl", "g", "h"))
    gain = (score(gl, hl) + score(g - gl, h - hl) - score(g, h)) / 2
    enough = (hl >= max(c.min_instances, 1)) & (h - hl >= max(c.min_instances, 1))
    tried = left.withColumn("gain", F.when(enough, gain)).withColumn("gain", F.when(F.col("gain") > 0, F.col("gain")))
    order = F.when(F.col("gain").isNotNull(), F.struct(F.round(F.log("gain"), 9), -F.col("f"), -F.col("b")))
    return tried.groupBy("node").agg(
        F.min_by("g", "f").alias("g"), F.min_by("h", "f").alias("h"), F.max_by(F.struct("f", "b", "gl", "hl", "gain"), order).alias("best")
    ).collect()


def grow_tree(rows: DataFrame, edges: Mapping[str, list[float]], features: Sequence[int], c: ForecastConfig) -> Tree:
    """A tree for rows (g, bins), level by level. A leaf's weight is `-soft(g) / (rows + l2)` times the step size."""
    names, tree, sums = list(edges), Tree(), {}

    def weigh(node: int, g: float, h: float) -> None:
        size = max(abs(g) - c.l1, 0.0) / (h + c.l2) if h + c.l2 else 0.0
        tree.weights[node] = -c.step_size * size * (1 if g > 0 else -1)

    at = {f: i for i, f in enumerate(names)}
    open_nodes = {ROOT}
    for depth in range(c.max_depth):
        inside = lambda s: F.col("bins")[at[s.feature]] < s.bin
        node = tree.value(inside, lambda n: F.lit(n if n in open_nodes else None).cast("int"))  # noqa: B023
        found = best_splits(rows.select(node.alias("node"), "g", "bins").where("node IS NOT NULL"), features, c)
        open_nodes = set()
        for r in sorted(found, key=lambda r: r.node):
            sums[r.node] = r.g, r.h
            if r.best is None:
                weigh(r.node, r.g, r.h)
                continue
            name, b = names[r.best.f], r.best.b + 1
            tree.splits[r.node] = Split(name, b, edges[name][b - 1], r.best.gain, r.h)
            sums[2 * r.node] = r.best.gl, r.best.hl
            sums[2 * r.node + 1] = r.g - r.best.gl, r.h - r.best.hl
            open_nodes |= {2 * r.node, 2 * r.node + 1}
        if not open_nodes:
            break
    for n in open_nodes:
        weigh(n, *sums[n])
    if not tree.splits and ROOT not in tree.weights:
        tree.weights[ROOT] = 0.0
    return tree


def leaf_value(tree: Tree, names: Sequence[str]) -> Column:
    at = {f: i for i, f in enumerate(names)}
    return tree.value(lambda s: F.col("bins")[at[s.feature]] < s.bin, lambda n: F.lit(float(tree.weights.get(n, 0.0))))


def chosen_features(names: Sequence[str], share: float, seed: int, number: int) -> list[int]:
    """The features that a tree may use: the same for the same seed and round."""
    k = max(1, round(share * len(names)))
    return sorted(random.Random(f"{seed}|{number}").sample(range(len(names)), k)) if k < len(names) else list(range(len(names)))


def fit(train: DataFrame, val: DataFrame | None, c: ForecastConfig = ForecastConfig()) -> BoostedTrees:
    """Trees for squared error on the rows without NULLs, from their mean on.

    Each tree sees the share `subsample` of the rows (by a hash of their content and the round) and `column_share` of the
    features. With validation rows training ends once `patience` rounds have not brought their mean absolute error below
    the least so far; the rounds up to that one are kept.
    """
    names, spark = list(c.features), train.sparkSession
    need = [F.col(f"`{n}`") for n in dict.fromkeys([*names, c.target])]
    whole = train.select(*need).dropna()
    edges = bin_edges(whole, names, c.bins)
    usable = [i for i, f in enumerate(names) if edges[f]]
    rows = stored(binned(whole, c.target, edges), "bins")
    base, size = rows.agg(F.avg("y"), F.count("y")).first()
    if not size:
        raise ValueError("no training rows without NULLs")
    model = BoostedTrees(names, c.target, float(base))
    rows = rows.withColumn("pred", F.lit(float(base)))
    held = None
    if val is not None:
        held = stored(binned(val.select(*need), c.target, edges), "held").withColumn("pred", F.lit(float(base)))
        if held.isEmpty():
            held = None
    best = 0
    for number in range(c.max_iter):
        pick = F.pmod(F.xxhash64("y", "bins", F.lit(c.seed), F.lit(number)), F.lit(1 << 20)) < round(c.subsample * (1 << 20))
        seen = rows.where(pick) if c.subsample < 1 else rows
        mine = [usable[i] for i in chosen_features(usable, c.column_share, c.seed, number)] if usable else []
        tree = grow_tree(seen.select((F.col("pred") - F.col("y")).alias("g"), "bins"), edges, mine, c) if mine else Tree({}, {ROOT: 0.0})
        model.trees.append(tree)
        value = F.col("pred") + leaf_value(tree, names)
        keep = (number + 1) % OPEN_TREES == 0 and number + 1 < c.max_iter
        rows = advanced(spark, rows, value, keep)
        if held is not None:
            held = advanced(spark, held, value, keep)
            model.errors.append(held.agg(F.avg(F.abs(F.col("pred") - F.col("y")))).first()[0])
            best = min(range(len(model.errors)), key=model.errors.__getitem__)
            if number - best >= c.patience:
                break
    if held is not None and model.errors:
        model.trees = model.trees[: best + 1]
    for table in (rows, held):
        if table is not None:
            delete(spark, stored_path(table))
    return model


def advanced(spark: SparkSession, rows: DataFrame, value: Column, keep: bool) -> DataFrame:
    """rows with a new prediction; `keep` stores them as a table and removes the one before."""
    out = rows.withColumn("pred", value)
    if not keep:
        return out
    before = stored_path(rows)
    out = stored(out, "boosted")
    delete(spark, before)
    return out


def predictions(model: BoostedTrees, df: DataFrame) -> Column:
    """The model's value for the rows of df, from its feature columns; NULL and NaN go right at every split.

    Hundreds of trees are too much for one generated method, so that batches of rows are walked by numpy.
    """
    depth = max((n.bit_length() for t in model.trees for n in t.weights), default=1)
    size, at = 1 << depth, {f: i for i, f in enumerate(model.features)}
    feature, cut, leaf = (np.zeros((len(model.trees), size), kind) for kind in (np.int32, np.float64, np.float64))
    last = np.zeros((len(model.trees), size), bool)
    for i, t in enumerate(model.trees):
        for n, s in t.splits.items():
            feature[i, n], cut[i, n] = at[s.feature], s.cut
        for n, w in t.weights.items():
            leaf[i, n], last[i, n] = w, True
    base = model.base

    @F.pandas_udf("double")
    def walk(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(np.float64, na_value=np.nan) for c in columns])
        out, row = np.full(len(x), base), np.arange(len(x))
        for i in range(len(feature)):
            node = np.ones(len(x), np.int64)
            for _ in range(depth):
                goes_right = ~(x[row, feature[i][node]] < cut[i][node])
                node = np.where(last[i][node], node, np.minimum(2 * node + goes_right, size - 1))
            out += leaf[i][node]
        return pd.Series(out)

    return walk(*[df[f"`{f}`"].cast("double") for f in model.features])


def predict(model: BoostedTrees, df: DataFrame, pred: str = "pred") -> DataFrame:
    return df.withColumn(pred, predictions(model, df))


def importance(model: BoostedTrees, spark: SparkSession, top: int | None = 20) -> DataFrame:
    """Mean gain of the splits on each feature, as shares of one; largest first, one row per feature."""
    gains: dict[str, list[float]] = {f: [] for f in model.features}
    for t in model.trees:
        for s in t.splits.values():
            gains[s.feature].append(s.gain)
    means = {f: sum(g) / len(g) if g else 0.0 for f, g in gains.items()}
    total = sum(means.values()) or 1.0
    rows = spark.createDataFrame([(f, m / total) for f, m in means.items()], "feature string, importance double")
    out = rows.orderBy(F.col("importance").desc(), "feature")
    return out if top is None else out.limit(top)
