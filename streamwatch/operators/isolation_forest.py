"""Isolation forest: trees grown from small samples, scoring in Arrow batches.

Only the samples leave the executors that scan the data. Their size, and so the
size of the model, follows from the parameters and not from the data. A row draws a number for each tree, and a tree takes the rows
with the least; every task keeps the least of its own while it counts its rows, so one read does both, and samples merge as the least of the least.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamwatch.functions.sketches import quantiles, sketch_size, sketched
from streamwatch.functions.values import all_of, finite
from streamwatch.schema import require_columns
from streamwatch.session import checkpoint_root

EULER_GAMMA = 0.5772156649015329
CONTAMINATION = 0.05
MAX_NODES = 2_000_000
#: One over the rank error of the threshold.
THRESHOLD_ACCURACY = 10_000

# `child` is the left child, the right one follows it; a leaf has none (-1).
NODE_SCHEMA = "tree int, node int, feature int, split double, child int, path double, sample int"


def usual_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER_GAMMA) - 2.0 * (n - 1) / n


def _tree_grower(features: Sequence[str], sample_size: int, seed: int):
    """The function that turns the candidates of one tree into its nodes.

    Helpers are nested so that executors need not have this package installed.
    """
    names = list(features)
    # a table, so that executors need no logarithm of their own
    path_of = [usual_path(n) for n in range(sample_size + 1)]
    depth_limit = max(1, math.ceil(math.log2(max(sample_size, 2))))

    def grow(candidates: pd.DataFrame) -> pd.DataFrame:
        tree = int(candidates["tree"].iloc[0])
        chosen = candidates.sort_values(["draw", *names]).head(sample_size)
        data = chosen[names].to_numpy(dtype="float64")
        random = np.random.default_rng([seed, tree])
        nodes = [{}]
        waiting = [(np.arange(len(data)), 0, 0)]
        while waiting:
            rows, depth, node = waiting.pop()
            low, high = data[rows].min(axis=0), data[rows].max(axis=0)
            usable = np.flatnonzero(high > low)
            if depth == depth_limit or len(usable) == 0:
                path = depth + path_of[len(rows)]
                nodes[node] = {"feature": -1, "split": 0.0, "child": -1, "path": path}
                continue
            feature = int(random.choice(usable))
            # below the maximum, so that neither side is empty
            split = random.uniform(low[feature], high[feature])
            split = float(min(split, np.nextafter(high[feature], low[feature])))
            goes_left = data[rows, feature] <= split
            child = len(nodes)
            nodes[node] = {"feature": feature, "split": split, "child": child, "path": 0.0}
            nodes += [{}, {}]
            waiting.append((rows[~goes_left], depth + 1, child + 1))
            waiting.append((rows[goes_left], depth + 1, child))
        out = pd.DataFrame(nodes)
        out.insert(0, "node", np.arange(len(out)))
        out.insert(0, "tree", tree)
        out["sample"] = len(data)
        return out

    return grow


@dataclass(frozen=True)
class IsolationForestModel:
    """A fitted forest: its nodes, and the score above which a row is an anomaly."""

    features: tuple[str, ...]
    nodes: pd.DataFrame
    threshold: float | None = None

    def score(self, spark: SparkSession) -> Column:
        """The anomaly score in (0, 1]; null where a feature is not a number."""
        arrays = spark.sparkContext.broadcast(_scoring_arrays(self.nodes, len(self.features)))

        @F.pandas_udf("double")
        def forest_score(*columns: pd.Series) -> pd.Series:
            forest = arrays.value
            data = np.column_stack([c.to_numpy(dtype="float64") for c in columns])
            if "breaks" in forest:
                place = np.searchsorted(forest["breaks"], data[:, 0], side="left")
                return pd.Series(forest["scores"][place])
            values, at_row = data.T.ravel(), np.arange(len(data))
            total = np.zeros(len(data))
            for root in forest["roots"]:
                at = np.full(len(data), root)
                for _ in range(forest["depth"]):
                    value = values.take(forest["feature"].take(at) * len(data) + at_row)
                    at = forest["child"].take(at) + (value > forest["split"].take(at))
                total += forest["path"].take(at)
            return pd.Series(np.exp2(-total / forest["usual"]))

        inputs = [finite(f) for f in self.features]
        return F.when(all_of([c.isNotNull() for c in inputs]), forest_score(*inputs))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``anomaly_score`` and ``is_anomaly``, on a table or a stream."""
        require_columns(df, self.features)
        if self.threshold is None:
            raise ValueError("the forest has no threshold yet")
        scored = df.withColumn("anomaly_score", self.score(df.sparkSession))
        return scored.withColumn("is_anomaly", F.col("anomaly_score") > self.threshold)

    def save(self, spark: SparkSession, path: str) -> None:
        stored = spark.createDataFrame(self.nodes, NODE_SCHEMA).withColumns(
            {
                "features": F.lit(list(self.features)),
                "threshold": F.lit(self.threshold).cast("double"),
            }
        )
        stored.coalesce(1).write.parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsolationForestModel:
        stored = spark.read.parquet(path)
        first = stored.select("features", "threshold").first()
        nodes = stored.drop("features", "threshold").orderBy("tree", "node").toPandas()
        return cls(tuple(first["features"]), nodes, first["threshold"])


def _scoring_arrays(nodes: pd.DataFrame, n_features: int) -> dict:
    """The forest as flat arrays; a leaf leads to itself, whatever the value."""
    nodes = nodes.sort_values(["tree", "node"], ignore_index=True)
    sizes = nodes.groupby("tree").size()
    offset = nodes["tree"].map(sizes.cumsum() - sizes).to_numpy()
    leaf = nodes["feature"].to_numpy() < 0
    samples = nodes.groupby("tree")["sample"].first()
    forest = {
        "feature": np.where(leaf, 0, nodes["feature"].to_numpy()).astype("int64"),
        "split": np.where(leaf, np.inf, nodes["split"].to_numpy()),
        "child": np.where(leaf, np.arange(len(nodes)), nodes["child"].to_numpy() + offset),
        "path": nodes["path"].to_numpy(),
        "roots": np.flatnonzero(nodes["node"].to_numpy() == 0),
        "depth": max(1, math.ceil(math.log2(max(int(samples.max()), 2)))),
        # sum over the trees, to match the summed path lengths
        "usual": sum(usual_path(int(n)) for n in samples),
    }
    return forest if n_features > 1 else _interval_scores(forest)


def _interval_scores(forest: dict) -> dict:
    """With one feature the score is constant between neighbouring split values."""
    breaks = np.unique(forest["split"][np.isfinite(forest["split"])])
    # one point per interval; an interval includes its upper end
    points = np.append(breaks, np.finfo("float64").max)
    total = np.zeros(len(points))
    for root in forest["roots"]:
        at = np.full(len(points), root)
        for _ in range(forest["depth"]):
            at = forest["child"].take(at) + (points > forest["split"].take(at))
        total += forest["path"].take(at)
    return {"breaks": breaks, "scores": np.exp2(-total / forest["usual"])}


def fit_isolation_forest(
    df: DataFrame,
    features: Sequence[str] = ("Amount",),
    *,
    trees: int = 100,
    sample_size: int = 256,
    contamination: float = CONTAMINATION,
    seed: int = 42,
    max_nodes: int = MAX_NODES,
    draw_by: Sequence[str] | None = None,
) -> IsolationForestModel:
    """Grow the forest, then set the threshold that flags ``contamination`` of ``df``, and no more.

    With ``draw_by``, columns that tell rows apart, the same rows give the same forest however they are partitioned; without it
    draws follow a row's position, so that copies of a row draw each for itself. ``max_nodes`` guards the
    driver's memory: a forest that could have more nodes is refused. ``df`` is read twice.
    """
    require_columns(df, [*features, *(draw_by or ())])
    if trees * (2 * sample_size - 1) > max_nodes:
        raise ValueError(f"more than {max_nodes} nodes: the model would not fit in memory")
    names = [f"__f{i}" for i in range(len(features))]
    if draw_by is None:
        number = F.monotonically_increasing_id()
    else:
        number = F.xxhash64(*draw_by)
    numbered = df.select(number.alias("__row"), *(finite(f).alias(n) for f, n in zip(features, names)))
    usable = numbered.where(all_of([F.col(n).isNotNull() for n in names]))
    rows, draws = _least_draws(usable, names, trees, sample_size, seed)
    if rows < 2:
        raise ValueError("a forest needs at least two rows whose features are numbers")
    grower = _tree_grower(names, min(sample_size, rows), seed)
    grown = draws.groupBy("tree").applyInPandas(grower, NODE_SCHEMA)
    # at most `trees` times `2 * sample_size - 1` rows, checked above
    forest = IsolationForestModel(tuple(features), grown.toPandas())

    scored = df.select(forest.score(df.sparkSession).alias("score"))
    sketch = sketched(scored, [], ["score"], sketch_size(THRESHOLD_ACCURACY))
    # the sketch's error upwards, so that no more than the share is flagged
    rank = min(1.0, 1.0 - contamination + 1 / THRESHOLD_ACCURACY)
    (cut,) = sketch.select(F.get(quantiles("score_sketch", "score_n", [rank]), F.lit(0))).first()
    return IsolationForestModel(forest.features, forest.nodes, cut)


def _least_draws(
    usable: DataFrame, names: Sequence[str], trees: int, sample_size: int, seed: int
) -> tuple[int, DataFrame]:
    """How many rows there are, and per tree the ``sample_size`` rows with the least draws, as (tree, draw, features)."""
    checkpoint_root(usable.sparkSession)
    features = len(names)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def mixed(x: np.ndarray) -> np.ndarray:
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return x ^ (x >> np.uint64(31))

        own = mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & (2**64 - 1)))
        bound = np.full(trees, np.iinfo(np.uint64).max, np.uint64)
        kept = [np.zeros(0, np.int32), np.zeros(0, np.uint64), np.zeros((0, features))]
        new, waiting, count = [], 0, 0

        def least() -> None:
            nonlocal kept, new, waiting
            tree, draws, values = (np.concatenate(parts) for parts in zip(kept, *new))
            order = np.lexsort((*values.T[::-1], draws, tree))
            tree, draws, values = tree[order], draws[order], values[order]
            rank = np.arange(len(tree)) - np.searchsorted(tree, tree)
            full = rank == sample_size - 1
            bound[tree[full]] = draws[full]
            kept, new, waiting = [tree[rank < sample_size], draws[rank < sample_size], values[rank < sample_size]], [], 0

        for batch in batches:
            count += batch.num_rows
            rows = mixed(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            values = np.column_stack([batch.column(1 + k).to_numpy(zero_copy_only=False) for k in range(features)]) if batch.num_rows else np.zeros((0, features))
            for at in range(0, len(rows), 1024):
                draws = mixed(rows[at : at + 1024, None] ^ own)
                place, tree = np.nonzero(draws <= bound)
                new.append((tree.astype(np.int32), draws[place, tree], values[at + place]))
                waiting += len(tree)
                if waiting > 2 * trees * sample_size:
                    least()
        if new:
            least()
        signed = (kept[1] ^ np.uint64(1 << 63)).view(np.int64)
        columns = [np.append(kept[0], -1), np.append(signed, count), *(np.append(kept[2][:, k], 0.0) for k in range(features))]
        kinds = [pa.int32(), pa.int64(), *[pa.float64()] * features]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["tree", "draw", *names])

    schema = ", ".join(["tree int", "draw long", *(f"{name} double" for name in names)])
    told = usable.mapInArrow(draw, schema).checkpoint()
    rows = told.filter("tree < 0").agg(F.coalesce(F.sum("draw"), F.lit(0))).first()[0]
    draws = told.filter("tree >= 0")
    # the least of each slot first, so that no task orders what all tasks told of a tree
    for group in (["tree", "slot"], ["tree"]):
        order = Window.partitionBy(*group).orderBy("draw", *names)
        draws = draws.withColumn("slot", F.pmod("draw", F.lit(64))).withColumn("rank", F.row_number().over(order))
        draws = draws.filter(F.col("rank") <= sample_size)
    return rows, draws.select("tree", "draw", *names)
