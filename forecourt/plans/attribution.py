"""Exact Shapley values of the price trees (path-dependent value function).

The value of a feature set S at a point is the sum over leaves of

    leaf value * product(f in S: point inside the leaf's f-interval)
               * product(f not in S: share of rows that the leaf's f-splits keep)

Features that a leaf's path does not test change nothing at that leaf. So each path carries the total weight of
its feature subsets by size, as the coefficients of product(share_f + inside_f * t) over the path's features; to
take a feature out again is a division by its factor. That costs the square of the path's features, whatever the
number of features in the model. A feature is two inputs of the model, its value and whether it is known; both
belong to it.

A tree compares inputs with thresholds only. The thresholds of a model cut the
input space into cells, and every listing of a cell has the same values. So the
work per listing is to find its cell. The values are computed once per cell that
some listing falls in, and joined back on the cell's number.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from math import factorial, inf

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.plans.pricing import FEATURES, INPUTS, model_inputs, predict_inputs
from forecourt.session import scratch_path, stage

_CELLS_PER_TASK = 2000
_BATCH_POINTS = 128  # bounds a task's memory to points * leaves


@dataclass(frozen=True)
class LeafBoxes:
    """One row per leaf: weighted value and, per input, interval and kept share."""

    value: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray

    def thresholds(self, place: int) -> list[float]:
        cuts = np.concatenate([self.low[:, place], self.high[:, place]])
        return sorted({float(cut) for cut in cuts if np.isfinite(cut)})


def leaf_boxes(spark: SparkSession, model: GBTRegressionModel) -> LeafBoxes:
    """Leaves of a fitted model, from its saved node table (at most rounds * 2^depth leaves)."""
    path = scratch_path(spark, "price_model")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID",
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("prediction"),
        F.col("nodeData.impurityStats")[0].alias("cover"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.try_element_at("nodeData.split.leftCategoriesOrThreshold", F.lit(1)).alias("cut"),
    )
    table, weights = nodes.toPandas(), model.treeWeights

    value, low, high, share = [], [], [], []
    for tree_id, tree in table.groupby("treeID"):
        by_node = tree.set_index("node").to_dict("index")
        open_nodes = [(0, {f: (-inf, inf, 1.0) for f in range(len(INPUTS))})]
        while open_nodes:
            number, box = open_nodes.pop()
            node = by_node[number]
            if node["left"] < 0:
                value.append(node["prediction"] * weights[int(tree_id)])
                for target, part in zip((low, high, share), zip(*box.values())):
                    target.append(part)
                continue
            feature, cut = int(node["feature"]), float(node["cut"])
            bottom, top, kept = box[feature]
            for child, interval in (
                (node["left"], (bottom, min(top, cut))),
                (node["right"], (max(bottom, cut), top)),
            ):
                ratio = by_node[child]["cover"] / node["cover"]
                open_nodes.append((child, {**box, feature: (*interval, kept * ratio)}))
    return LeafBoxes(*(np.asarray(part, dtype=float) for part in (value, low, high, share)))


def value_columns(features: Sequence[str] = FEATURES) -> list[str]:
    return ["base_value", *[f"shap_{name}" for name in features]]


def _explainer(boxes: LeafBoxes, inputs: Sequence[str], names: Sequence[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A mapInPandas function that adds base value and contributions to each row of inputs.

    The first half of the inputs are the features' values, the second whether they are known.
    """
    value, step, count = boxes.value, _BATCH_POINTS, len(inputs) // 2
    # A feature's two inputs are known or unknown together.
    share = boxes.share[:, :count] * boxes.share[:, count:]
    tested = np.isfinite(boxes.low) | np.isfinite(boxes.high)
    tested = tested[:, :count] | tested[:, count:]
    # The features on each leaf's path, padded by one that keeps all rows and holds all points.
    longest = max(1, int(tested.sum(axis=1).max(initial=0)))
    path = np.argsort(~tested, axis=1, kind="stable")[:, :longest]
    leaf = np.arange(len(value))[:, None]
    on_path = tested[leaf, path]
    shares = np.where(on_path, share[leaf, path], 1.0)
    low, high = (np.stack([part[:, :count][leaf, path], part[:, count:][leaf, path]]) for part in (boxes.low, boxes.high))
    chance = [factorial(n) * factorial(longest - n - 1) / factorial(longest) for n in range(longest)]
    base = float((value * share.prod(axis=1)).sum())
    # Leaves by the feature at each place of their path, to add up by feature.
    owner = np.zeros((longest, len(value), count))
    for place in range(longest):
        owner[place, np.arange(len(value)), path[:, place]] = on_path[:, place]

    def contributions(x: np.ndarray) -> np.ndarray:
        inside = np.empty((longest, len(x), len(value)), bool)
        for place in range(longest):
            known, at = x[:, count:][:, path[:, place]], x[:, :count][:, path[:, place]]
            inside[place] = (at > low[0, :, place]) & (at <= high[0, :, place])
            inside[place] &= (known > low[1, :, place]) & (known <= high[1, :, place])
        sums = [np.ones((len(x), len(value)))]
        for place in range(longest):  # the path's features one by one: those without it, and those with it
            with_it = np.zeros_like(sums[0])
            grown = []
            for weight in [*sums, None]:
                without = 0.0 if weight is None else weight * shares[:, place]
                grown.append(without + with_it)
                with_it = 0.0 if weight is None else weight * inside[place]
            sums = grown
        gains = np.zeros((len(x), count))
        for place in range(longest):
            one, zero = inside[place], shares[:, place]
            # Take the feature out: from the top where the point is inside, else all weights are without it.
            rest, total = np.zeros_like(sums[0]), np.zeros_like(sums[0])
            for size in range(longest - 1, -1, -1):
                rest = np.where(one, sums[size + 1] - zero * rest, sums[size] / zero)
                total += chance[size] * rest
            gains += (value * total * (one - zero)) @ owner[place]
        return np.column_stack([np.full(len(x), base), gains])

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[list(inputs)].to_numpy(dtype=float)
            parts = [contributions(x[i : i + step]) for i in range(0, len(x), step)]
            if parts:
                yield batch.assign(**dict(zip(names, np.vstack(parts).T)))

    return explain


def _with_values(df: DataFrame, boxes: LeafBoxes) -> DataFrame:
    schema = ", ".join(
        [f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema]
        + [f"`{name}` double" for name in value_columns()]
    )
    return df.mapInPandas(_explainer(boxes, INPUTS, value_columns()), schema)


def cell_of(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Add ``_cell``: the numbers of thresholds at or above each value, as digits of one number."""
    cell, size = F.lit(0).cast("bigint"), 1
    for name, thresholds in cuts.items():
        if thresholds:
            place = Bucketizer(
                splits=[-inf, *[-t for t in reversed(thresholds)], inf],
                inputCol="_negated",
                outputCol=f"_place_{name}",
            )
            rows = place.transform(rows.withColumn("_negated", -F.col(name).cast("double")))
            cell = cell + F.col(f"_place_{name}").cast("bigint") * size
            size *= len(thresholds) + 1
    return rows.withColumn("_cell", cell).drop("_negated", *[f"_place_{name}" for name in cuts])


def shap_contributions(model: GBTRegressionModel, rows: DataFrame) -> DataFrame:
    """Prediction, base value and one contribution per feature for every row.

    One point per cell present is explained: the least value of each input in it.
    The join meets plain shuffles, so adaptive execution can split a cell that
    holds a large part of the rows; it broadcasts the cells only if they are few.
    """
    boxes = leaf_boxes(rows.sparkSession, model)
    placed = cell_of(rows.withColumns(model_inputs()), {name: boxes.thresholds(i) for i, name in enumerate(INPUTS)})
    points = stage(placed.groupBy("_cell").agg(*[F.min(name).alias(name) for name in INPUTS]), "cells")
    points = points.repartition(max(1, -(-points.count() // _CELLS_PER_TASK)))
    explained = stage(_with_values(predict_inputs(model, points), boxes).drop(*INPUTS), "explained")
    return placed.drop(*INPUTS).join(explained, "_cell").drop("_cell")
