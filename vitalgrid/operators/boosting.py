"""Boosted trees with second-order leaf weights, grown level by level.

The loss is logistic. Every row has a gradient g = p - y and a curvature h = p (1 - p) at
its margin; a leaf with the sums G and H gets the weight -G / (H + lambda), and a split
gains

    GL^2 / (HL + lambda) + GR^2 / (HR + lambda) - G^2 / (H + lambda)

halved, less ``gamma``. Features are cut into bins once, at quantiles from one scan of
mergeable sketches or at points that the caller names. A level of a tree is one job: rows
find their node by comparisons, every task adds g and h up per node, feature and bin, and
what is shuffled are these histograms, not rows. Splits are found where the histograms are
grouped; one row per node reaches the driver.

Rows are drawn for each tree by a hash of a number they keep, columns once per tree.
Margins are written anew every ``REFRESH`` trees, so that the trees before need not be
walked for every level. Ties of gain (to nine digits) go to the first feature, then the
lowest cut. NULL and NaN count as 0, as in the feature table.
"""

from __future__ import annotations

import json
import random
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from vitalgrid.config import ID_COLUMN, SPLIT_SEED, TARGET_COLUMN
from vitalgrid.functions import fill_number
from vitalgrid.operators.features import Encoder, serving_table
from vitalgrid.operators.scoring import Scorer, logistic
from vitalgrid.session import put_text, read_text, staged

REFRESH = 10
SKETCH_ACCURACY = 10_000  # the rank of a quantile is off by one in so many rows at most


@dataclass(frozen=True)
class BoostParams:
    # Hyper-parameters of the risk classifier.
    rounds: int = 100
    rate: float = 0.1
    depth: int = 5
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = SPLIT_SEED
    # The usual defaults of second-order boosting.
    reg_lambda: float = 1.0
    gamma: float = 0.0
    least_child_curvature: float = 1.0
    bins: int = 64


@dataclass(frozen=True)
class Split:
    """Rows with ``feature`` up to ``cut`` go to node 2n + 1, others to 2n + 2."""

    feature: int
    cut: float
    gain: float


@dataclass(frozen=True)
class Tree:
    """Splits and leaf weights by node; the root is node 0."""

    splits: dict[int, Split]
    leaves: dict[int, float]

    def walk(self, columns: list[Column], node: int = 0) -> Column:
        """The weight of the leaf that a row falls into."""
        split = self.splits.get(node)
        if split is None:
            return F.lit(self.leaves[node])
        below = columns[split.feature] <= F.lit(split.cut)
        return F.when(below, self.walk(columns, 2 * node + 1)).otherwise(self.walk(columns, 2 * node + 2))


@dataclass(frozen=True)
class Boosted:
    features: list[str]
    trees: list[Tree]
    base: float = 0.0

    def margin(self) -> Column:
        columns = [fill_number(F.col(f"`{f}`").cast("double")) for f in self.features]
        return sum((t.walk(columns) for t in self.trees), F.lit(self.base))

    def score(self, table: DataFrame) -> DataFrame:
        """Add the probability of the positive class as ``score``."""
        return table.withColumn("score", logistic(self.margin()))

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "base": self.base, "trees": [asdict(t) for t in self.trees]})

    @staticmethod
    def from_json(text: str) -> Boosted:
        stored = json.loads(text)
        trees = [
            Tree({int(n): Split(**s) for n, s in t["splits"].items()}, {int(n): w for n, w in t["leaves"].items()})
            for t in stored["trees"]
        ]
        return Boosted(stored["features"], trees, stored["base"])


def quantile_cuts(table: DataFrame, features: list[str], bins: int) -> list[list[float]]:
    """Up to ``bins - 1`` different quantiles of each feature, all in one scan."""
    steps = [i / bins for i in range(1, bins)]
    row = table.agg(
        *[
            F.percentile_approx(fill_number(F.col(f"`{f}`").cast("double")), steps, SKETCH_ACCURACY).alias(f"q{i}")
            for i, f in enumerate(features)
        ]
    ).first()
    return [sorted(set(q or [])) for q in row]


def bin_of(x: Column, cuts: list[float], low: int = 0, high: int | None = None) -> Column:
    """How many of the cuts lie below ``x``, by halving."""
    high = len(cuts) if high is None else high
    if low == high:
        return F.lit(low).cast("smallint")
    middle = (low + high) // 2
    return F.when(x <= F.lit(cuts[middle]), bin_of(x, cuts, low, middle)).otherwise(bin_of(x, cuts, middle + 1, high))


def _node_of(splits: dict[int, Split], places: dict[int, int], level: int, node: int = 0, depth: int = 0) -> Column:
    """The node of a row at ``level``, NULL if its path has ended before. ``places`` are
    the cuts' bins, compared with the binned columns."""
    if depth == level:
        return F.lit(node)
    split = splits.get(node)
    if split is None:
        return F.lit(None).cast("int")
    below = F.col(f"b{split.feature}") <= F.lit(places[node])
    deeper = (_node_of(splits, places, level, 2 * node + side, depth + 1) for side in (1, 2))
    return F.when(below, next(deeper)).otherwise(next(deeper))


def _best_splits(rows: DataFrame, columns: list[int], p: BoostParams) -> DataFrame:
    """Per node the best split: gain, feature, bin, and the sums on both sides. ``rows``:
    node, g, h and the binned columns."""
    binned = F.explode(F.array(*[F.struct(F.lit(c).alias("f"), F.col(f"b{c}").alias("b")) for c in columns])).alias("x")
    cells = rows.select("node", "g", "h", binned).groupBy("node", "x.f", "x.b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    # A node and feature have as many cells as bins.
    by_feature = Window.partitionBy("node", "f")
    upto = by_feature.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = cells.select(
        "node", "f", "b", F.sum("g").over(upto).alias("gl"), F.sum("h").over(upto).alias("hl"),
        F.sum("g").over(by_feature).alias("ga"), F.sum("h").over(by_feature).alias("ha"),
    )
    part = lambda g, h: g * g / (h + p.reg_lambda)
    gl, hl, ga, ha = (F.col(c) for c in ("gl", "hl", "ga", "ha"))
    gain = (part(gl, hl) + part(ga - gl, ha - hl) - part(ga, ha)) / 2 - p.gamma
    enough = (hl >= p.least_child_curvature) & (ha - hl >= p.least_child_curvature)
    rated = sums.withColumn("gain", F.when(enough, F.round(gain, 9)))
    first = F.struct(F.coalesce("gain", F.lit(float("-inf"))).alias("gain"), (-F.col("f")).alias("f"), (-F.col("b")).alias("b"))
    return rated.groupBy("node").agg(F.max_by(F.struct("gain", "f", "b", "gl", "hl", "ga", "ha"), first).alias("best")).select("node", "best.*")


def grow(rows: DataFrame, cuts: list[list[float]], columns: list[int], p: BoostParams) -> Tree:
    """One tree over rows with g, h and binned columns."""
    splits: dict[int, Split] = {}
    places: dict[int, int] = {}
    sums: dict[int, tuple[float, float]] = {}
    for level in range(p.depth):
        at = rows.withColumn("node", _node_of(splits, places, level)).where("node IS NOT NULL")
        found = _best_splits(at, columns, p).collect()  # one row per node
        for r in found:
            sums.setdefault(r.node, (r.ga, r.ha))
            # The last bin has no cut behind it.
            if r.gain is not None and r.gain > 0 and r.b < len(cuts[r.f]):
                splits[r.node], places[r.node] = Split(r.f, cuts[r.f][r.b], r.gain), r.b
                sums[2 * r.node + 1] = (r.gl, r.hl)
                sums[2 * r.node + 2] = (r.ga - r.gl, r.ha - r.hl)
        if not any(r.node in splits for r in found):
            break
    leaves = {n: -p.rate * g / (h + p.reg_lambda) for n, (g, h) in sums.items() if n not in splits}
    return Tree(splits, leaves or {0: 0.0})


def drawn_columns(p: BoostParams, tree: int, n: int) -> list[int]:
    k = max(1, round(p.column_share * n))
    return sorted(random.Random(p.seed * 1_000_003 + tree).sample(range(n), k))


def _binned_walk(tree: Tree, cuts: list[list[float]], node: int = 0) -> Column:
    split = tree.splits.get(node)
    if split is None:
        return F.lit(tree.leaves[node])
    below = F.col(f"b{split.feature}") <= F.lit(cuts[split.feature].index(split.cut))
    return F.when(below, _binned_walk(tree, cuts, 2 * node + 1)).otherwise(_binned_walk(tree, cuts, 2 * node + 2))


def train(
    table: DataFrame,
    features: list[str],
    target: str = TARGET_COLUMN,
    params: BoostParams = BoostParams(),
    cuts: list[list[float]] | None = None,
    base: float = 0.0,
) -> Boosted:
    """Fit on a table of numeric features. ``base`` is the margin before the first tree."""
    p = params
    cuts = cuts or quantile_cuts(table, features, p.bins)
    numbers = [fill_number(F.col(f"`{f}`").cast("double")) for f in features]
    rows = table.select(
        F.col(f"`{target}`").cast("double").alias("y"),
        F.lit(base).alias("margin"),
        F.xxhash64(F.monotonically_increasing_id()).alias("row"),
        *[bin_of(x, c).alias(f"b{i}") for i, (x, c) in enumerate(zip(numbers, cuts))],
    )
    rows = staged(rows, "binned")
    trees: list[Tree] = []
    for t in range(p.rounds):
        if t and t % REFRESH == 0:
            grown = sum((_binned_walk(x, cuts) for x in trees[-REFRESH:]), F.col("margin"))
            rows = staged(rows.withColumn("margin", grown), "binned")
        recent = trees[t - t % REFRESH :]
        chance = logistic(sum((_binned_walk(x, cuts) for x in recent), F.col("margin")))
        mine = rows
        if p.row_share < 1:
            mine = rows.where(F.pmod(F.xxhash64("row", F.lit(p.seed), F.lit(t)), F.lit(1 << 20)) < int(p.row_share * (1 << 20)))
        mine = mine.withColumn("p", chance).withColumns({"g": F.col("p") - F.col("y"), "h": F.col("p") * (1 - F.col("p"))})
        trees.append(grow(mine, cuts, drawn_columns(p, t, len(features)), p))
    return Boosted(list(features), trees, base)


def _model_file(path: str) -> str:
    return f"{path.rstrip('/')}/boosted.json"


def save(spark: SparkSession, model: Boosted, path: str, encoder: Encoder) -> None:
    """The model and the levels it was trained with, as one file."""
    put_text(spark, _model_file(path), json.dumps({"model": model.to_json(), "encoder": encoder.to_json()}), replace=True)


def load(spark: SparkSession, path: str) -> tuple[Boosted, Encoder]:
    stored = json.loads(read_text(spark, _model_file(path)))
    return Boosted.from_json(stored["model"]), Encoder.from_json(stored["encoder"])


def serving_scorer(model: Boosted, expected: list[str], encoder: Encoder, key: str = ID_COLUMN) -> Scorer:
    """Raw rows under file column names to ``patient_id`` and ``score``."""

    def scorer(rows: DataFrame) -> DataFrame:
        scored = model.score(serving_table(rows, expected, encoder, keep=(key,)))
        return scored.select(F.col(f"`{key}`").alias("patient_id"), "score")

    return scorer
