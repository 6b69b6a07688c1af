"""Isolation forest (Liu, Ting, Zhou 2008) over DataFrames.

Only the sample of one tree, at most ``max_samples`` rows, is ever in one Python
group; rows are scored in Arrow batches against the node arrays, whose size is fixed by
the number of trees and ``max_samples``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from procrisk import fixed
from procrisk.operators.quantiles import column_quantiles
from procrisk.session import stage

NODE_SCHEMA = (
    "tree_id int, node_id int, feature int, threshold double, "
    "left_id int, right_id int, size long, depth int"
)
_EULER = 0.5772156649015329
# Pool of rows from which the trees draw, as a multiple of all samples together.
_POOL_FACTOR = 4


def expected_path(size: float) -> float:
    """Mean path length of an unsuccessful search among ``size`` points."""
    if size <= 1:
        return 0.0
    if size == 2:
        return 1.0
    return 2.0 * (math.log(size - 1.0) + _EULER) - 2.0 * (size - 1.0) / size


@dataclass(frozen=True)
class Forest:
    """A fitted forest: its nodes (a few tens of thousands of rows), sample size, offset."""

    nodes: pd.DataFrame
    features: list[str]
    sample_size: int
    offset: float

    @property
    def trees(self) -> int:
        return int(self.nodes["tree_id"].max()) + 1


def tree_samples(
    df: DataFrame,
    features: list[str],
    key: list[str],
    rows: int,
    *,
    trees: int = fixed.TREES,
    max_samples: int = fixed.MAX_SAMPLES,
    seed: int = fixed.SEED,
    widen: int = 1,
    draw_by: list[str] | None = None,
) -> DataFrame:
    """``tree_id``, ``draw`` and the features of the sampled rows of every tree.

    Rows are drawn by hashes of ``key`` and ``draw_by`` (the features unless given), so
    partitioning and row order do not matter as long as these columns hold stored values:
    pass the raw columns where the features are computed from sums. Rows that share a key
    are drawn apart; equal rows count once. One hash per row picks the pool; only the pool
    meets all the trees, and Spark keeps the rows of least hash per tree before it shuffles
    them (``WindowGroupLimit``).
    """
    row = list(dict.fromkeys([*key, *(draw_by or features)]))
    wanted = min(max_samples, rows)
    share = min(1.0, widen * _POOL_FACTOR * trees * wanted / rows)
    per_tree = min(1.0, widen * 2 * wanted / (share * rows))
    pool = (
        df.select(*dict.fromkeys([*row, *features]))
        .where(_unit(F.xxhash64(*row, F.lit(seed))) < share)
        .dropDuplicates(row)
    )
    draws = (
        pool.withColumn("tree_id", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("draw", F.xxhash64(*row, "tree_id", F.lit(seed + 1)))
        .where(_unit(F.col("draw")) < per_tree)
    )
    order = Window.partitionBy("tree_id").orderBy("draw", *row)
    return (
        draws.withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= max_samples)
        .select("tree_id", "__rank", *features)
    )


def grow_trees(samples: DataFrame, features: list[str], max_samples: int, seed: int) -> DataFrame:
    """Nodes of one random tree per ``tree_id``."""
    names = list(features)

    # Nested, so that workers need no copy of this package.
    def grow(rows: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        import pandas as pd

        tree = int(rows["tree_id"].iloc[0])
        x = rows.sort_values("__rank")[names].to_numpy(dtype=float)
        random = np.random.default_rng([seed, tree])
        limit = int(np.ceil(np.log2(max(min(max_samples, len(x)), 2))))
        nodes, pending = [], [(0, 0, np.arange(len(x)))]
        count = 1
        while pending:
            node, depth, members = pending.pop()
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            varying = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or not len(varying):
                nodes.append((tree, node, -1, 0.0, -1, -1, len(members), depth))
                continue
            feature = int(random.choice(varying))
            threshold = float(random.uniform(low[feature], high[feature]))
            if threshold >= high[feature]:  # rounding; the right side must not be empty
                threshold = float(low[feature])
            goes_left = x[members, feature] <= threshold
            nodes.append((tree, node, feature, threshold, count, count + 1, len(members), depth))
            pending.append((count, depth + 1, members[goes_left]))
            pending.append((count + 1, depth + 1, members[~goes_left]))
            count += 2
        columns = ["tree_id", "node_id", "feature", "threshold", "left_id", "right_id", "size", "depth"]
        return pd.DataFrame(nodes, columns=columns)

    return samples.groupBy("tree_id").applyInPandas(grow, NODE_SCHEMA)


def fit_forest(
    df: DataFrame,
    features: list[str],
    key: list[str],
    *,
    rows: int | None = None,
    trees: int = fixed.TREES,
    max_samples: int = fixed.MAX_SAMPLES,
    contamination: float = fixed.CONTAMINATION,
    seed: int = fixed.SEED,
    exact_offset: bool = True,
    draw_by: list[str] | None = None,
) -> Forest:
    """Grows the forest from samples (``tree_samples``) and sets its offset to the ``contamination`` quantile of the
    training scores; ``exact_offset=False`` estimates that quantile in one pass."""
    rows = df.count() if rows is None else rows
    if not rows:
        raise ValueError("no rows to train on")
    wanted, widen = min(max_samples, rows), 1
    while True:
        samples = tree_samples(
            df, features, key, rows, trees=trees, max_samples=max_samples, seed=seed, widen=widen,
            draw_by=draw_by,
        )
        nodes = grow_trees(samples, features, max_samples, seed).toPandas()
        roots = nodes.loc[nodes["node_id"] == 0, "size"]
        everything = widen * 2 * wanted >= rows
        if everything or (len(roots) == trees and (roots == wanted).all()):
            break
        widen *= 2
    nodes = nodes.sort_values(["tree_id", "node_id"]).reset_index(drop=True)
    forest = Forest(nodes, list(features), int(roots.max()), 0.0)
    raw = stage(df.select(raw_score(df, forest).alias("score")), "scores")
    if exact_offset:
        offset = column_quantiles(raw, ["score"], contamination).first()["quantile"]
    else:
        offset = raw.agg(F.percentile_approx("score", contamination, 100_000)).first()[0]
    return Forest(nodes, list(features), forest.sample_size, float(offset))


def raw_score(df: DataFrame, forest: Forest) -> Column:
    """Minus two to the power of minus the relative path length: lower is stranger."""
    arrays = _arrays(forest)
    shared = df.sparkSession.sparkContext.broadcast(arrays)
    scale = expected_path(forest.sample_size) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        import numpy as np
        import pandas as pd

        feature, threshold, left, right, length, depth = shared.value
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            row = np.arange(len(x))
            total = np.zeros(len(x))
            for tree in range(len(feature)):
                at = np.zeros(len(x), dtype=np.int32)
                for _ in range(depth):
                    # A leaf leads to itself, so no row has to leave the loop early.
                    below = x[row, feature[tree][at]] <= threshold[tree][at]
                    at = np.where(below, left[tree][at], right[tree][at])
                total += length[tree][at]
            yield pd.Series(-np.exp2(-total / len(feature) / scale))

    # One struct argument arrives as one pandas frame per Arrow batch.
    return score(F.struct(*forest.features))


def decision(df: DataFrame, forest: Forest, out: str = "anomaly_score") -> DataFrame:
    """Adds the score relative to the offset: negative is anomalous."""
    return df.withColumn(out, raw_score(df, forest) - F.lit(forest.offset))


def _arrays(forest: Forest) -> tuple:
    """Node table as one row per tree, padded to the largest tree."""
    nodes, trees = forest.nodes, forest.trees
    width = int(nodes["node_id"].max()) + 1
    place = (nodes["tree_id"].to_numpy(), nodes["node_id"].to_numpy())
    leaf = nodes["feature"].to_numpy() < 0
    own = nodes["node_id"].to_numpy()

    def spread(values, kind):
        array = np.zeros((trees, width), dtype=kind)
        array[place] = values
        return array

    lengths = nodes["depth"].to_numpy() + np.array([expected_path(s) for s in nodes["size"]])
    return (
        spread(np.where(leaf, 0, nodes["feature"]), np.int32),
        spread(nodes["threshold"], float),
        spread(np.where(leaf, own, nodes["left_id"]), np.int32),
        spread(np.where(leaf, own, nodes["right_id"]), np.int32),
        spread(lengths, float),
        int(nodes["depth"].max()),
    )


def _unit(hashed: Column) -> Column:
    """Hash as a number in [0, 1)."""
    return F.pmod(hashed, F.lit(1 << 40)) / F.lit(float(1 << 40))
