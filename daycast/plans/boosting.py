"""Boosted regression trees of many candidates and folds, grown together (M9).

Spark ML's ``GBTRegressor`` fits one model a call with a Spark job a tree level, so
a grid of short series is thousands of jobs that each read a few rows. Here the
same trees are grown for all candidates on all folds at once: one job a level
counts every model's histograms on the blocks of binned rows, adds them up by model
and chooses the splits there; only the chosen splits reach the driver. Where every
fold is one block of at most BLOCK_ROWS rows, there is nothing to add up, and the
same steps run to the end in the tasks that hold the blocks, in one job.

The rules are those of ``GBTRegressor`` with squared error (at most ``maxBins`` bins
whose cuts follow the value counts, variance gain, the first of equal gains, leaves
without gain), and sums are made in row order, so a fold in one block has Spark
ML's trees. There, beyond SPLIT_ROWS rows the cuts come from a random share; here they
always come from the values of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daycast.plans.trees import FlatTrees

#: Beyond so many rows of a fold, the values that its cuts come from are sorted in ranges, not a feature a task.
SPLIT_ROWS = 10_000
#: Rows of a block: the histograms of a block are counted in one task.
BLOCK_ROWS = 20_000
#: Predictions are kept from round to round, and made anew from the binned rows after so many.
REBASE = 25
#: Smaller impurities end growth.
EPSILON = 2.0 ** -52


@dataclass
class _Tree:
    """Nodes in the order they were made; ``cut`` is the last bin of the left child."""

    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    prediction: list[float] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)

    def node(self, n: float, total: float) -> int:
        for values, v in ((self.left, -1), (self.right, -1), (self.feature, 0), (self.cut, 0), (self.prediction, total / n if n else 0.0), (self.rows, int(n))):
            values.append(v)
        return len(self.left) - 1

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of ``bins`` ends in."""
        left, right, feature, cut = (np.array(x, np.int64) for x in (self.left, self.right, self.feature, self.cut))
        at, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while (inner := left[at] >= 0).any():
            at = np.where(inner, np.where(bins[row, feature[at]] <= cut[at], left[at], right[at]), at)
        return at


def value_cuts(value: np.ndarray, count: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` cuts between the sorted distinct values, after about equal numbers of rows."""
    middle = (value[:-1] + value[1:]) / 2.0
    if len(middle) <= most:
        return middle
    stride = count.sum() / (most + 1)
    out, target, seen = [], stride, float(count[0])
    for i, n in enumerate(count[1:].tolist()):
        before, seen = seen, seen + n
        if abs(before - target) < abs(seen - target):
            out.append(middle[i])
            target += stride
    return np.array(out)


def split_cuts(rows: DataFrame, vector_col: str, n: int, max_bins: int) -> list[np.ndarray]:
    """The cuts of every feature, by the rule of :func:`value_cuts` on the values of all ``n`` rows."""
    most = min(max_bins, n) - 1
    counts = rows.select(F.posexplode(vector_to_array(vector_col)).alias("f", "v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
    if n > SPLIT_ROWS:
        return _ranged_cuts(counts, n, most)

    def cuts(table: pa.Table) -> pa.Table:
        table = table.sort_by("v")
        found = value_cuts(table.column("v").to_numpy(), table.column("n").to_numpy(), most)
        return pa.table({"f": pa.array([table.column("f")[0].as_py()], pa.int32()), "cuts": pa.array([found], pa.list_(pa.float64()))})

    found = counts.groupBy("f").applyInArrow(cuts, "f int, cuts array<double>").collect()
    return [np.array(r["cuts"], float) for r in sorted(found, key=lambda r: r["f"])]


def _ranged_cuts(counts: DataFrame, n: int, most: int) -> list[np.ndarray]:
    """:func:`value_cuts` of every feature in ``counts`` (f, v, n) of ``n`` rows, whose values are sorted in ranges.

    A cut follows where the rows counted so far come closest to its target, at least one
    value after the cut before it. So three passes over the ranges do: how many values and rows
    each has, how many values lie before each target, and the values on both sides of the cuts.
    """
    parts = counts.repartitionByRange("f", "v").sortWithinPartitions("f", "v").withColumn("p", F.spark_partition_id()).persist(StorageLevel.MEMORY_AND_DISK)
    targets = np.cumsum(np.full(most, float(n) / (most + 1)))

    def walk(batches: Iterator[pa.RecordBatch], starts: dict):
        """(feature, values before, rows before, values, counts) of the values that follow each other."""
        at = dict(starts)
        for batch in batches:
            p, f, v, c = (batch.column(x).to_numpy() for x in ("p", "f", "v", "n"))
            edges = np.r_[0, np.flatnonzero((np.diff(f) != 0) | (np.diff(p) != 0)) + 1, len(f)]
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                if b > a:
                    key = (int(p[a]), int(f[a]))
                    place, seen = at[key]
                    yield key[1], place, seen, v[a:b], c[a:b]
                    at[key] = place + b - a, seen + int(c[a:b].sum())

    try:
        starts, size, rows = {}, {}, {}
        for p, f, values, held in parts.groupBy("p", "f").agg(F.count(F.lit(1)), F.sum("n")).orderBy("p", "f").collect():
            starts[p, f] = size.get(f, 0), rows.get(f, 0)
            size[f], rows[f] = size.get(f, 0) + values, rows.get(f, 0) + held

        def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, np.ndarray] = {}
            for f, place, seen, _, c in walk(batches, starts):
                upto = seen + np.cumsum(c)
                first = np.searchsorted(upto, targets, side="right")
                # All values before this one are too early; it is itself if its rows end closer to the target than they begin.
                some = np.minimum(first, len(c) - 1)
                late = np.abs(upto[some] - c[some] - targets) >= np.abs(upto[some] - targets)
                first = np.where((first < len(c)) & late, first + 1, first)
                found[f] = found.get(f, 0) + np.maximum(first, 1 if place == 0 else 0)
            for f, count in found.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(most, f, np.int32)), pa.array(np.arange(most, dtype=np.int32)), pa.array(count.astype(np.int64))], ["f", "j", "n"])

        early = {f: np.zeros(most, np.int64) for f in size}
        for f, j, count in parts.mapInArrow(before, "f int, j int, n long").groupBy("f", "j").agg(F.sum("n")).collect():
            early[f][j] = count
        places = {}
        for f, some in early.items():
            after = np.arange(most) + np.maximum.accumulate(some - np.arange(most)) if size[f] - 1 > most else np.arange(1, size[f])
            places[f] = after[after < size[f]]

        def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for f, place, _, v, _ in walk(batches, starts):
                wanted = np.union1d(places[f], places[f] - 1) - place
                wanted = wanted[(wanted >= 0) & (wanted < len(v))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(wanted), f, np.int32)), pa.array(wanted + place), pa.array(v[wanted])], ["f", "place", "v"])

        value = {(f, place): v for f, place, v in parts.mapInArrow(beside, "f int, place long, v double").collect()}
    finally:
        parts.unpersist()
    return [np.array([(value[f, i - 1] + value[f, i]) / 2.0 for i in places[f].tolist()], float) for f in sorted(places)]


def binned(rows: DataFrame, vector_col: str, label_col: str, number: int, cuts: list[np.ndarray]) -> DataFrame:
    """The rows in blocks of at most BLOCK_ROWS: fold, each value's bin, label."""
    kind = np.uint8 if max(map(len, cuts)) < 256 else np.uint16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def block() -> pa.RecordBatch:
            bins, y = (np.concatenate(x) for x in zip(*held))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([bins.tobytes()]), pa.array([y.tobytes()])], ["fold", "bins", "y"])

        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                y = batch.column("y").to_numpy(zero_copy_only=False).astype(float)
                if not np.isfinite(y).all():
                    raise ValueError(f"a training row without a number in {label_col}")
                if n and n + len(y) > BLOCK_ROWS:
                    yield block()
                    held, n = [], 0
                held.append((np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T)], axis=1).astype(kind), y))
                n += len(y)
        if n:
            yield block()

    table = rows.select(vector_to_array(vector_col).alias("x"), F.col(label_col).cast("double").alias("y"))
    return table.mapInArrow(run, "fold int, bins binary, y binary")


def histograms(bins: np.ndarray, label: np.ndarray, slot: np.ndarray, slots: int, width: int) -> np.ndarray:
    """([rows, sum, sum of squares], slot, feature, bin) of the rows whose slot is not negative."""
    some = slot >= 0
    part, y = bins[some], label[some]
    features = bins.shape[1]
    cell = ((slot[some] * features)[:, None] + np.arange(features)) * width + part
    cell, size = cell.ravel(), slots * features * width
    sums = [np.bincount(cell, w, size) for w in (None, np.repeat(y, features), np.repeat(y * y, features))]
    return np.stack(sums).astype(float).reshape(3, slots, features, width)


def _impurity(stats: np.ndarray) -> np.ndarray:
    n, total, squares = stats
    some = np.maximum(n, 1.0)  # without rows the sums are 0
    return (squares - (total * total) / some) / some


def best_splits(sums: np.ndarray, n_cuts: np.ndarray, impurity: np.ndarray | None) -> tuple:
    """Per slot: gain (0 or less: none), feature, cut, the children's statistics, its own. ``impurity``: of the slots, None at a root."""
    upto = sums.cumsum(axis=3)
    left, whole = upto[..., :-1], upto[..., -1:]
    right = whole - left
    slots, features, width = left.shape[1:]
    own = upto[:, :, 0, -1]
    if not n_cuts.any():
        none = np.zeros(slots, np.int64)
        return np.zeros(slots), none, none, own, own, own
    if impurity is None:
        first = int(np.flatnonzero(n_cuts)[0])
        own = left[:, :, first, 0] + right[:, :, first, 0]
        impurity = _impurity(own)
    n = left[0] + right[0]
    gain = impurity[:, None, None] - left[0] / n * _impurity(left) - right[0] / n * _impurity(right)
    allowed = (np.arange(width) < n_cuts[:, None]) & (left[0] >= 1) & (right[0] >= 1) & (gain >= 0.0)
    flat = np.where(allowed, gain, -np.inf).reshape(slots, -1)
    best = flat.argmax(axis=1)
    at, (feature, cut) = np.arange(slots), np.divmod(best, width)
    return flat[at, best], feature, cut, left[:, at, feature, cut], right[:, at, feature, cut], own


def _label(y: np.ndarray, predicted: np.ndarray | None) -> np.ndarray:
    """What the next tree is fitted to: the label, then twice the error."""
    return y if predicted is None else 2.0 * (y - predicted)


def _with_trees(block: tuple, rounds: list[tuple[float, dict]]) -> tuple:
    """The block with its models' predictions after further rounds (weight of each model, tree of each model)."""
    fold, bins, y, predicted = block
    predicted = dict(predicted)
    for trees in rounds:
        for key, (weight, tree) in trees.items():
            if key[0] == fold:
                predicted[key] = predicted.get(key, 0.0) + np.array(tree.prediction)[tree.place(bins)] * weight
    return fold, bins, y, predicted


def _sums(block: tuple, key: tuple, tree: _Tree, nodes: list[int], n_cuts: dict) -> np.ndarray:
    """The histograms of a growing tree's open nodes on one block."""
    fold, bins, y, predicted = block
    slot = np.full(max(1, len(tree.left)), -1)
    slot[nodes] = np.arange(len(nodes))
    at = tree.place(bins) if tree.left else np.zeros(len(bins), np.int64)
    return histograms(bins, _label(y, predicted.get(key)), slot[at], len(nodes), int(n_cuts[fold].max()) + 1)


def _level(blocks: RDD, growing: dict, n_cuts: dict) -> dict:
    """One job: the best splits of every growing model's open nodes. ``growing``: (tree so far, open nodes, their impurities) by model."""

    def count(block: tuple):
        for key, (tree, nodes, _) in growing.items():
            if key[0] == block[0]:
                yield key, _sums(block, key, tree, nodes, n_cuts)

    sums = blocks.flatMap(count).reduceByKey(add, min(len(growing), blocks.getNumPartitions()))
    return dict(sums.map(lambda kv: (kv[0], best_splits(kv[1], n_cuts[kv[0][0]], growing[kv[0]][2]))).collect())


def _round(folds, models: list[dict], number: int, level_of) -> dict:
    """(weight, tree) of every (fold, model) in round ``number``; ``level_of`` gives the best splits of the open nodes."""
    open_ = {(f, i): (_Tree(), [0], None) for f in folds for i, m in enumerate(models) if number < int(m["maxIter"])}
    trees, level = {key: tree for key, (tree, _, _) in open_.items()}, 0
    while open_:
        found, left = level_of(open_), {}
        for key, (tree, nodes, _) in open_.items():
            more, impurities = _split(tree, nodes, found[key], level, int(models[key[1]]["maxDepth"]))
            if more:
                left[key] = (tree, more, impurities)
        open_, level = left, level + 1
    return {key: (1.0 if number == 0 else float(models[key[1]]["stepSize"]), tree) for key, tree in trees.items()}


def _alone(block: tuple, models: list[dict], rounds: int, n_cuts: dict) -> list[dict]:
    """All rounds of a fold that is one block."""
    fold, made = block[0], []
    for r in range(rounds):
        made.append(_round([fold], models, r, lambda open_: {
            key: best_splits(_sums(block, key, tree, nodes, n_cuts), n_cuts[fold], impurity) for key, (tree, nodes, impurity) in open_.items()}))
        block = _with_trees(block, made[-1:])
    return made


def _split(tree: _Tree, nodes: list[int], found: tuple, level: int, depth: int) -> tuple[list[int], np.ndarray]:
    """Adds a level to ``tree``; returns the nodes left open and their impurities."""
    gain, feature, cut, left, right, own = found
    if not tree.left:
        tree.node(*own[:2, 0])
    more, impurities = [], []
    for k, node in enumerate(nodes):
        if not gain[k] > 0:
            continue
        tree.feature[node], tree.cut[node] = int(feature[k]), int(cut[k])
        for side, stats in ((tree.left, left[:, k]), (tree.right, right[:, k])):
            side[node] = child = tree.node(*stats[:2])
            impurity = float(_impurity(stats))
            if level + 1 < depth and abs(impurity) >= EPSILON:
                more.append(child)
                impurities.append(impurity)
    return more, np.array(impurities)


def boosted(folds: dict[int, DataFrame], vector_col: str, label_col: str, models: list[dict], max_bins: int, seed: int) -> dict[tuple[int, int], FlatTrees]:
    """The fitted ensemble of every (fold, place in ``models``); a model has maxIter, stepSize and maxDepth.

    The driver holds the trees, whose size depends on the grid alone, and a level's splits. Nothing is random,
    so ``seed`` changes nothing.
    """
    cuts, tables = {}, []
    for number, rows in folds.items():
        n = rows.count()
        if not n:
            raise ValueError(f"fold {number} has no training row")
        cuts[number] = split_cuts(rows, vector_col, n, max_bins)
        tables.append(binned(rows, vector_col, label_col, number, cuts[number]))
    kind = {f: np.uint8 if max(map(len, c)) < 256 else np.uint16 for f, c in cuts.items()}
    n_cuts = {f: np.array([len(x) for x in c]) for f, c in cuts.items()}
    one = lambda r: (r["fold"], np.frombuffer(r["bins"], kind[r["fold"]]).reshape(-1, len(n_cuts[r["fold"]])), np.frombuffer(r["y"]), {})
    base = reduce(DataFrame.unionByName, tables).rdd.map(one).persist(StorageLevel.MEMORY_AND_DISK)
    longest, rounds, state, old = max(int(m["maxIter"]) for m in models), [], base, None
    try:
        if base.count() == len(folds):
            alone = base.map(lambda block: _alone(block, models, longest, n_cuts)).collect()
            rounds = [{key: made for fold in same for key, made in fold.items()} for same in zip(*alone)]
        for r in range(len(rounds), longest):
            rounds.append(_round(folds, models, r, lambda open_: _level(state, open_, n_cuts)))
            if old is not None:  # the state after it is stored now
                old.unpersist()
            old = state if state is not base else None
            last = rounds[-1:] if (r + 1) % REBASE else list(rounds)
            state = (state if len(last) == 1 else base).map(lambda block, last=last: _with_trees(block, last)).persist(StorageLevel.MEMORY_AND_DISK)
    finally:
        for held in (base, state, old):
            if held is not None:
                held.unpersist()
    return {(f, i): _flat([t[f, i] for t in rounds if (f, i) in t], cuts[f]) for f in folds for i in range(len(models))}


def _flat(trees: list[tuple[float, _Tree]], cuts: list[np.ndarray]) -> FlatTrees:
    sizes = np.array([len(t.left) for _, t in trees])
    roots = np.cumsum(sizes) - sizes
    base = np.repeat(roots, sizes)
    joined = lambda name, kind: np.array([x for _, t in trees for x in getattr(t, name)], kind)
    left, right, feature, cut = (joined(name, np.int64) for name in ("left", "right", "feature", "cut"))
    inner = left >= 0
    threshold = np.array([cuts[f][c] if i else 0.0 for f, c, i in zip(feature.tolist(), cut.tolist(), inner.tolist())])
    return FlatTrees(joined("prediction", float), joined("rows", np.int64), np.where(inner, left + base, -1), np.where(inner, right + base, -1),
                     np.where(inner, feature, -1), threshold, roots, np.array([w for w, _ in trees]))
