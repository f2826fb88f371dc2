"""Random forest per route with stratified folds; fitted forests become one node table, which scores all routes in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wakeline.functions.scalar import even_grid
from wakeline.ml import tiles, trees
from wakeline.operators import evaluate as ev
from wakeline.operators import split

# Trees, depths (None is unlimited, here the deepest the library grows), leaf sizes,
# features per split, weight of the anomaly class, folds, thresholds.
TREES, DEPTHS, LEAVES, PER_SPLIT = (100, 200), (None, 10, 20), (1, 5), ("sqrt", "log2")
DEEPEST = 30
ANOMALY_WEIGHT = 2.0
FOLDS = 5
TAUS = even_grid(0.0, 1.0, 101)


@dataclass(frozen=True)
class Cell:
    trees: int
    depth: int | None
    leaf: int
    per_split: str


def full_grid() -> list[Cell]:
    return [Cell(*c) for c in product(TREES, DEPTHS, LEAVES, PER_SPLIT)]


def _vectors(df: DataFrame, features: Sequence[str], *keep: str) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="_x").transform(
        df.select(*features, *keep).withColumn("_y", F.col("y_true").cast("double"))
    ).withColumn("_w", F.when(F.col("y_true") == 1, ANOMALY_WEIGHT).otherwise(1.0))


def _fit(vectors: DataFrame, cell: Cell, seed: int) -> RandomForestClassificationModel:
    return RandomForestClassifier(
        featuresCol="_x", labelCol="_y", weightCol="_w", numTrees=cell.trees,
        maxDepth=min(cell.depth or DEEPEST, DEEPEST), minInstancesPerNode=cell.leaf, featureSubsetStrategy=cell.per_split,
        seed=seed, maxMemoryInMB=1024,
    ).fit(vectors)


def _scored(model, vectors: DataFrame, *keep: str) -> DataFrame:
    return model.transform(vectors).select(*keep, F.col("y_true").alias("y"), vector_to_array("probability")[1].alias("score"))


def _best(scores: DataFrame):
    return ev.best_threshold(ev.threshold_scan(scores, TAUS)).first()


def fit_route(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    row_key: str,
    grid: Sequence[Cell] | None = None,
    folds: int = FOLDS,
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[RandomForestClassificationModel, float, float, Cell, list[tuple[Cell, float]]]:
    """Best cell by mean fold F1, refitted on all training rows; tau by F1 on ``test``."""
    grid = list(grid or full_grid())
    dealt = split.folds(train, ["y_true"], folds, row_key, seed)
    vectors = _vectors(dealt, features, "y_true", "fold").persist()

    def fold_f1(task: tuple[Cell, int]) -> float:
        cell, fold = task
        model = _fit(vectors.filter(F.col("fold") != fold), cell, seed)
        return _best(_scored(model, vectors.filter(F.col("fold") == fold)))["f1"]

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(fold_f1, product(grid, range(folds))))
        results = [(cell, sum(scores[i * folds : (i + 1) * folds]) / folds) for i, cell in enumerate(grid)]
        best = max(results, key=lambda r: r[1])[0]
        model = _fit(vectors, best, seed)
    finally:
        vectors.unpersist()
    tau = _best(_scored(model, _vectors(test, features, "y_true")))
    return model, tau["tau"], tau["f1"], best, results


NODE_SCHEMA = "position string, tree int, node long, feature int, threshold double, value double"


def node_table(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of all models saved as ``folder/<position>``, read as one table: ``position, tree, node, feature, threshold, value``.

    Nodes are numbered as :mod:`wakeline.ml.trees` wants them. The value of a leaf is its share of the anomaly class. A tree fits a task,
    as it has fitted the driver when it was grown.
    """
    saved = spark.read.parquet(f"{folder}/*/data")
    stats, split = F.col("nodeData.impurityStats"), F.col("nodeData.split")
    is_leaf = F.col("nodeData.leftChild") < 0
    rows = saved.select(
        F.regexp_extract(F.input_file_name(), r"/([^/]+)/data/[^/]*$", 1).alias("position"), F.col("treeID").alias("tree"), F.col("nodeData.id").alias("id"),
        F.col("nodeData.leftChild").alias("low"), F.col("nodeData.rightChild").alias("high"), F.when(~is_leaf, split["featureIndex"]).alias("feature"),
        F.when(~is_leaf, split["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(is_leaf, stats[1] / (stats[0] + stats[1])).alias("value"),
    )

    def number(tree: pd.DataFrame) -> pd.DataFrame:
        tree = tree.sort_values("id")  # parents come before their children
        node = dict.fromkeys(tree["id"], 1)
        for own, low, high in zip(tree["id"], tree["low"], tree["high"], strict=True):
            if low >= 0:
                node[low], node[high] = 2 * node[own], 2 * node[own] + 1
        return tree.assign(node=list(node.values()))[["position", "tree", "node", "feature", "threshold", "value"]].astype({"feature": "Int32"})

    return rows.groupBy("position", "tree").applyInPandas(number, NODE_SCHEMA)


def score(points: DataFrame, nodes: DataFrame, features: Sequence[str], **options) -> DataFrame:
    """Share of the anomaly class for points of all routes at once, by the node table of their routes' forests (route, ``tree, node,
    feature, threshold, value``); null for a route without one."""
    walked = trees.mean_values(points, tiles.inputs(features), nodes.withColumn("cell", F.lit(0)), [0], "_mean", **options)
    return walked.withColumn("score", F.col("_mean")[0]).drop("_mean")
