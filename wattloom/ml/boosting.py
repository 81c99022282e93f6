"""Boosted regression trees with L1 and L2 terms, grown from second-order histograms.

For squared error a row's gradient is prediction minus label and its curvature 1. A leaf with sums G and H weighs
``-soft(G, alpha) / (H + l2)``, where ``soft`` moves G towards zero by ``alpha`` and stops there, so L1 empties leaves. A split is
worth what it adds to ``soft(G)^2 / (H + l2)`` over both sides.

Features are cut into bins once. Each level of a tree is one aggregate over all rows: gradient and curvature by node, feature and
bin, summed in the tasks first. What comes to the driver is that table (nodes x features x bins, whatever the rows), from which it picks the
splits. Predictions of the trees so far are written to the shared folder every ``WRITE_EVERY`` rounds, so plans stay short and a lost
executor costs few rounds. Rows and columns of a round are drawn by hash, so a model does not depend on partitions.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattloom.ml.features import resolve_columns
from wattloom.operators.columns import quoted
from wattloom.shared import materialize

WRITE_EVERY = 10


def soft(g: float, alpha: float) -> float:
    return np.sign(g) * max(abs(g) - alpha, 0.0)


@dataclass
class BoostedTrees:
    """Trees as heaps: ``feature`` (-1 at a leaf), ``cut`` (values up to it go left) and ``weight`` by tree and node."""

    features: list[str]
    base: float
    step: float
    depth: int
    feature: list[list[int]] = field(default_factory=list)
    cut: list[list[float]] = field(default_factory=list)
    weight: list[list[float]] = field(default_factory=list)

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """Add the prediction to every row; NULL where a feature is NULL or NaN."""
        columns = [F.col(quoted(c)).cast("double") for c in resolve_columns(df, self.features)]
        values = F.array(*columns)
        known = ~F.exists(values, lambda x: x.isNull() | F.isnan(x))
        others = [F.col(quoted(c)) for c in df.columns if c != output]
        return df.select(*others, F.when(known, _sum_of_trees(self, values)).alias(output))

    def importance(self) -> dict[str, int]:
        """How many splits use each feature."""
        used = [f for tree in self.feature for f in tree if f >= 0]
        return {name: used.count(i) for i, name in enumerate(self.features)}


def _node(values: Column, feature: Column, cut: Column, first: Column, depth: int) -> Column:
    """The leaf that a row reaches in the tree whose nodes start at ``first``."""

    def down(here: Column, _: Column) -> Column:
        of = F.get(feature, first + here)
        beyond = (F.get(values, of) > F.get(cut, first + here)).cast("int")
        return F.when(of < 0, here).otherwise(2 * here + 1 + beyond)

    return F.aggregate(F.array_repeat(F.lit(0), depth), F.lit(0), down)


def _sum_of_trees(model: BoostedTrees, values: Column) -> Column:
    if not model.feature:
        return F.lit(model.base)
    flat = lambda lists, kind: F.lit(np.array([x for tree in lists for x in tree], kind))
    feature, cut, weight = flat(model.feature, np.int32), flat(model.cut, np.float64), flat(model.weight, np.float64)
    size = len(model.feature[0])

    def add(total: Column, tree: Column) -> Column:
        return total + model.step * F.get(weight, tree * size + _node(values, feature, cut, tree * size, model.depth))

    return F.aggregate(F.sequence(F.lit(0), F.lit(len(model.feature) - 1)), F.lit(model.base), add)


def _thresholds(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most ``bins - 1`` cuts for each feature, from one scan; all values are told apart where they are few."""
    fine = 4 * bins
    asked = [k / fine for k in range(1, fine)]
    found = rows.agg(*[F.percentile_approx(quoted(c), asked, 10_000).alias(f"_q{i}") for i, c in enumerate(features)]).first()
    cuts = []
    for values in found:
        distinct = sorted(set(values or []))
        if len(distinct) > bins - 1:
            distinct = sorted({distinct[round(k * (len(distinct) - 1) / (bins - 2))] for k in range(bins - 1)})
        cuts.append(distinct)
    return cuts


def train_regularised_trees(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    key: str,
    rounds: int = 600,
    depth: int = 5,
    step: float = 0.1,
    alpha: float = 0.5,
    l2: float = 1.5,
    row_sample: float = 0.85,
    column_sample: float = 0.85,
    min_weight: float = 5.0,
    bins: int = 32,
    seed: int = 42,
) -> BoostedTrees:
    """Trees on the rows without a gap; ``key`` names a row for sampling."""
    names = resolve_columns(train, features)
    whole = train.select(
        F.xxhash64(quoted(key)).alias("_key"), F.col(quoted(label)).cast("double").alias("_y"), *[F.col(quoted(c)).cast("double").alias(c) for c in names]
    ).na.drop()
    cuts = _thresholds(whole, names, bins)
    base = whole.agg(F.avg("_y")).first()[0]
    model = BoostedTrees(names, base or 0.0, step, depth)
    if base is None:
        return model
    bin_of = lambda c, at: sum(((F.col(quoted(c)) > F.lit(x)).cast("int") for x in at), F.lit(0))
    binned = whole.select("_key", "_y", F.array(*[bin_of(c, at) for c, at in zip(names, cuts)]).alias("_bins"), F.lit(base).alias("_sum"))
    rows = materialize(binned, "binned")
    for t in range(rounds):
        chosen = sorted(random.Random(f"{seed}:{t}").sample(range(len(names)), max(1, int(column_sample * len(names)))))
        drawn = F.pmod(F.xxhash64(F.lit(seed), F.lit(t), "_key"), F.lit(1_000_000)) < int(row_sample * 1_000_000)
        feature, at_bin, weight = _grow(rows.where(drawn) if row_sample < 1 else rows, chosen, cuts, depth, alpha, l2, min_weight)
        model.feature.append(feature)
        model.cut.append([cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature, at_bin)])
        model.weight.append(weight)
        leaf = _node(F.col("_bins"), F.lit(np.array(feature, np.int32)), F.lit(np.array(at_bin, np.int32)), F.lit(0), depth)
        rows = rows.withColumn("_sum", F.col("_sum") + step * F.get(F.lit(np.array(weight)), leaf))
        if (t + 1) % WRITE_EVERY == 0 and t + 1 < rounds:
            rows = materialize(rows, "boosted")
    return model


def _grow(
    rows: DataFrame, chosen: list[int], cuts: list[list[float]], depth: int, alpha: float, l2: float, min_weight: float
) -> tuple[list[int], list[int], list[float]]:
    """One tree over ``rows`` (_bins, _y, _sum): feature, bin to cut at, and weight of each node."""
    size = 2 ** (depth + 1) - 1
    feature, at_bin, weight = [-1] * size, [0] * size, [0.0] * size
    score = lambda g, h: np.maximum(np.abs(g) - alpha, 0) ** 2 / np.maximum(h + l2, 1e-300)
    open_nodes = [0]
    for level in range(depth):
        if not open_nodes:
            break
        node = _node(F.col("_bins"), F.lit(np.array(feature, np.int32)), F.lit(np.array(at_bin, np.int32)), F.lit(0), level)
        placed = rows.select(node.alias("node"), (F.col("_sum") - F.col("_y")).alias("g"), "_bins")
        if level:
            placed = placed.where(F.col("node").isin(open_nodes))
        cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.get("_bins", F.lit(f)).alias("bin")) for f in chosen])
        sums = placed.select("node", "g", F.inline(cells)).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.count(F.lit(1)).alias("h")).toPandas()
        following = []
        for n in open_nodes:
            here = sums[sums["node"] == n]
            if here.empty:
                continue
            one = here[here["feature"] == chosen[0]]
            g_all, h_all = one["g"].sum(), one["h"].sum()
            if not level:
                weight[0] = -soft(g_all, alpha) / (h_all + l2)
            best = (1e-9, -1, 0, 0.0, 0.0)
            for f in chosen:
                part = here[here["feature"] == f]
                g, h = np.zeros(len(cuts[f]) + 1), np.zeros(len(cuts[f]) + 1)
                g[part["bin"]], h[part["bin"]] = part["g"], part["h"]
                left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
                gain = score(left_g, left_h) + score(g_all - left_g, h_all - left_h) - score(g_all, h_all)
                gain = np.where((left_h >= min_weight) & (h_all - left_h >= min_weight), gain, -np.inf)
                if len(gain) and gain.max() > best[0] * (1 + 1e-9):
                    b = int(gain.argmax())
                    best = (gain[b], f, b, left_g[b], left_h[b])
            if best[1] < 0:
                continue
            _, feature[n], at_bin[n], left_g, left_h = best
            for child, g, h in ((2 * n + 1, left_g, left_h), (2 * n + 2, g_all - left_g, h_all - left_h)):
                weight[child] = -soft(g, alpha) / (h + l2)
                following.append(child)
        open_nodes = following
    return feature, at_bin, weight
