"""Fitted tree ensembles as flat node arrays: staged scores, truncation, rebuilt models.

Spark ML's saved form of an ensemble is a table of nodes. Read back as arrays, all
trees are walked together, and one large fit answers for every smaller one:

* a depth limit or a least number of rows for a split only stops a tree's growth,
  so a tree grown without them holds every truncated tree (all features are
  candidates at each split, and inner nodes keep their prediction and count);
* the trees of a forest do not depend on each other, and a boosting round only adds
  to those before it, so the first n of them are the smaller ensemble.

A fitted ensemble is held by the driver and sent to the executors by Spark ML as
well; a forest of unlimited depth grows with the rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daycast.session import scratch_path

#: Rows walked through all trees at once, in (row, tree) pairs.
STEP_PAIRS = 1 << 18


@dataclass
class FlatTrees:
    """Nodes of all trees, one after the other; ``left`` and ``right`` are places in these arrays, -1 at a leaf."""

    prediction: np.ndarray
    rows: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    roots: np.ndarray
    weights: np.ndarray

    def first(self, n: int) -> FlatTrees:
        end = self.roots[n] if n < len(self.roots) else len(self.left)
        return FlatTrees(*(x[:end] for x in (self.prediction, self.rows, self.left, self.right, self.feature, self.threshold)), self.roots[:n], self.weights[:n])

    def values(self, x: np.ndarray, limits=((None, 0),)) -> np.ndarray:
        """(limit, row, tree) predictions for the rows ``x``.

        A limit is (deepest level or None, least rows of a node that may be
        split): the walk ends at the first node that would not have been split under it.
        """
        shape = (len(x), len(self.roots))
        at = np.broadcast_to(self.roots, shape).copy()
        out = np.empty((len(limits), *shape))
        going = np.ones((len(limits), *shape), bool)
        row, depth = np.arange(len(x))[:, None], 0
        while True:
            leaf = self.left[at] < 0
            for j, (deepest, least) in enumerate(limits):
                stop = going[j] & (leaf | (self.rows[at] < least) | (depth == deepest))
                out[j][stop] = self.prediction[at[stop]]
                going[j] &= ~stop
            if not going.any():
                return out
            down = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            at = np.where(leaf, at, down)
            depth += 1

    def kept(self, deepest: int | None, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(kept, cut): nodes that stay under a limit, and those of them that become leaves."""
        kept, cut = np.zeros(len(self.left), bool), np.zeros(len(self.left), bool)
        level, depth = self.roots, 0
        while len(level):
            kept[level] = True
            ends = (self.left[level] < 0) | (self.rows[level] < least) | (depth == deepest)
            cut[level[ends]] = True
            inner = level[~ends]
            level, depth = np.r_[self.left[inner], self.right[inner]], depth + 1
        return kept, cut


def _saved(model) -> str:
    path = scratch_path(SparkSession.active(), f"trees-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    return path


def flat_trees(model: RandomForestRegressionModel | GBTRegressionModel, path: str | None = None) -> FlatTrees:
    """The fitted ensemble's nodes, read from its saved form."""
    spark = SparkSession.active()
    path = path or _saved(model)
    node = F.col("nodeData")
    table = spark.read.parquet(path + "/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("id"), node["prediction"].alias("prediction"), node["rawCount"].alias("rows"),
        node["leftChild"].alias("left"), node["rightChild"].alias("right"), node["split"]["featureIndex"].alias("feature"),
        F.try_element_at(node["split"]["leftCategoriesOrThreshold"], F.lit(1)).alias("threshold"),
    ).orderBy("tree", "id").toArrow()
    weights = {r[0]: r[1] for r in spark.read.parquet(path + "/treesMetadata").select("_1", "_3").collect()}
    got = {name: table.column(name).to_numpy() for name in table.column_names if name != "threshold"}
    threshold = table.column("threshold").fill_null(0.0).to_numpy()
    tree = got["tree"].astype(np.int64)
    roots = np.flatnonzero(np.diff(tree, prepend=-1))
    base = np.repeat(roots, np.diff(np.r_[roots, len(tree)]))
    place = lambda child: np.where(child < 0, -1, child + base)
    return FlatTrees(got["prediction"], got["rows"].astype(np.int64), place(got["left"].astype(np.int64)), place(got["right"].astype(np.int64)),
                     got["feature"].astype(np.int64), threshold, roots, np.array([weights[i] for i in range(len(roots))]))


def node_rows(pipeline: PipelineModel, features) -> DataFrame:
    """The fitted trees of a ``models.scaled_pipeline`` as a table: tree, node, feature, cut, rows, value.

    ``node`` is the path from the root, a letter L (at most ``cut``) or R a level;
    leaves have no feature and cut. Cuts are in the features' own units.
    """
    _, scaler, model = pipeline.stages
    flat, std, mean = flat_trees(model), scaler.std.toArray(), scaler.mean.toArray()
    paths = np.full(len(flat.left), "", object)
    level = flat.roots
    while len(level):
        inner = level[flat.left[level] >= 0]
        for to, letter in ((flat.left, "L"), (flat.right, "R")):
            paths[to[inner]] = paths[inner] + letter
        level = np.r_[flat.left[inner], flat.right[inner]]
    leaf, of = flat.left < 0, np.maximum(flat.feature, 0)
    tree = np.searchsorted(flat.roots, np.arange(len(leaf)), side="right") - 1
    names = np.array(list(features), object)[of]
    cut = flat.threshold * std[of] + mean[of]
    return SparkSession.active().createDataFrame(pa.table({
        "tree": pa.array(tree, pa.int32()), "node": pa.array(paths, pa.string()), "feature": pa.array(names, pa.string(), mask=leaf),
        "cut": pa.array(cut, pa.float64(), mask=leaf), "rows": pa.array(flat.rows, pa.int64()), "value": pa.array(flat.prediction, pa.float64())}))


def truncated(model: RandomForestRegressionModel, deepest: int | None = None, least: int = 0) -> RandomForestRegressionModel:
    """``model`` with every node at level ``deepest`` and every node of fewer than ``least`` rows made a leaf.

    Rows are counted as the tree saw them, bootstrap draws included. The node
    table is rewritten as a Spark job and loaded as a model again.
    """
    spark = SparkSession.active()
    path = _saved(model)
    flat = flat_trees(model, path)
    kept, cut = flat.kept(deepest, least)
    if kept.all():
        return model
    tree = np.repeat(np.arange(len(flat.roots)), np.diff(np.r_[flat.roots, len(flat.left)]))
    old = np.arange(len(flat.left)) - flat.roots[tree]
    # Children come after their parent, so numbers in the old order are an order Spark's reader accepts.
    number = np.cumsum(kept) - 1
    number = number - number[flat.roots[tree]]
    child = lambda to: np.where(cut | (to < 0), -1, number[np.maximum(to, 0)])
    rows = pa.table({"tree": tree[kept], "old": old[kept], "new": number[kept], "cut": cut[kept], "l": child(flat.left)[kept], "r": child(flat.right)[kept]})
    moved = spark.createDataFrame(rows)
    data = spark.read.parquet(path + "/data")
    kind = data.schema["nodeData"].dataType
    n = F.col("nodeData")
    end = F.col("cut")
    split = kind["split"].dataType.simpleString()
    leaf_split = F.struct(F.lit(-1).alias("featureIndex"), F.array().cast("array<double>").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories")).cast(split)
    rebuilt = F.struct(
        F.col("new").cast("int").alias("id"), n["prediction"].alias("prediction"), n["impurity"].alias("impurity"), n["impurityStats"].alias("impurityStats"),
        n["rawCount"].alias("rawCount"), F.when(end, F.lit(-1.0)).otherwise(n["gain"]).alias("gain"),
        F.col("l").cast("int").alias("leftChild"), F.col("r").cast("int").alias("rightChild"), F.when(end, leaf_split).otherwise(n["split"]).alias("split"))
    out = scratch_path(spark, f"trees-{uuid.uuid4().hex}")
    joined = data.join(moved, (F.col("treeID") == F.col("tree")) & (n["id"] == F.col("old")))
    joined.select("treeID", rebuilt.cast(kind).alias("nodeData")).write.parquet(out + "/data")
    spark.read.parquet(path + "/treesMetadata").write.parquet(out + "/treesMetadata")
    spark.read.text(path + "/metadata").coalesce(1).write.text(out + "/metadata")
    return RandomForestRegressionModel.load(out)


def squared_errors(rows: DataFrame, vector_col: str, label_col: str, flat: FlatTrees, limits, sizes, mean: bool) -> dict[tuple[int, int], tuple[int, float]]:
    """{(limit, size): (rows, summed squared error)} of the ensemble's truncations and prefixes on ``rows``, in one pass.

    ``mean``: the prediction is the mean of the first ``size`` trees (a forest);
    otherwise their weighted sum (boosting). Rows without a label are left out.
    """
    limits, sizes = list(limits), list(sizes)
    step = max(1, STEP_PAIRS // max(1, len(flat.roots)))
    columns = [pa.int32(), pa.int32(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((len(limits), len(sizes))), 0
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = batch.column("y").to_numpy(zero_copy_only=False)
                sums = np.cumsum(flat.values(x, limits) * (1.0 if mean else flat.weights), axis=2)
                for j, size in enumerate(sizes):
                    predicted = sums[:, :, size - 1] / (size if mean else 1.0)
                    total[:, j] += ((predicted - y) ** 2).sum(axis=1)
                n += batch.num_rows
        if n:
            i, j = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((i.ravel(), j.ravel(), np.full(total.size, n), total.ravel()), columns)], ["limit", "size", "n", "sse"])

    known = rows.where(F.col(label_col).isNotNull()).select(vector_to_array(vector_col).alias("x"), F.col(label_col).cast("double").alias("y"))
    sums = known.mapInArrow(run, "limit int, size int, n long, sse double").groupBy("limit", "size").agg(F.sum("n").alias("n"), F.sum("sse").alias("sse"))
    return {(r["limit"], sizes[r["size"]]): (r["n"], r["sse"]) for r in sums.collect()}
