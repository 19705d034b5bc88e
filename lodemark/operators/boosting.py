"""Gradient boosting that can go on: one round at a time, Newton leaf values with both penalties, joint classes, a stop by patience.

Spark's own boosters begin anew with every fit, have no penalties on leaf values and fit several classes one against the rest.
Here the features are cut into bins once and kept in blocks of rows, and a level of a round's trees is one pass that sums the
derivatives per bin; the fitted ensemble is a Spark tree ensemble.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.operators.metrics import ranking_metrics
from lodemark.settings import BINARY, MULTICLASS, REGRESSION
from lodemark.sources.scans import Scratch, changed_setting

FEATURES, LABEL, WEIGHT, VALIDATES, MARGINS, TRAIL = "_FEATURES", "_LABEL", "_WEIGHT", "_VALIDATES", "_MARGINS", "_TRAIL"
CHANCES = "_CHANCES"   # class probabilities of the current margins, while rounds grow
STAGE_ROUNDS = 5    # rounds between two writes of the margins; passes between them add up these rounds' trees anew
MAX_BINS = 32       # bins of a feature
SAMPLE_ROWS = 10_000    # rows from which the bins are cut
SAMPLE_VALUES = 4_000_000   # values of them that the driver holds at once
BLOCK_BYTES, BLOCK_ROWS = 2**20, 8_192   # size of a block of rows
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"   # a few blocks; JVM and Python work side by side and hold little
SUMS_BYTES = 2**26  # sums of a pass that come to the driver from all tasks
SMALLEST = 1e-16    # a second derivative is never less
RARE = 1e-6         # share of a class from which its first margin is taken at least


@dataclass(frozen=True)
class BoosterSpec:
    rounds: int = 100
    depth: int = 5
    min_rows: int = 1
    subsample: float = 1.0
    features: str = "all"
    learning_rate: float = 0.1
    reg_lambda: float = 0.0
    reg_alpha: float = 0.0
    metric: str | None = None
    seed: int = 0

    @classmethod
    def of(cls, algorithm: str, params: dict, seed: int, task: str) -> BoosterSpec:
        """The usual parameter names of the two boosters, with their own defaults."""
        p = dict(params)
        depth = p.get("max_depth") or (math.ceil(math.log2(p["num_leaves"])) if "num_leaves" in p else 5)
        share = float(p.get("colsample_bytree", 1.0))
        metric = p.get("eval_metric") or ("aucpr" if algorithm == "xgboost" and task == BINARY else None)
        return cls(int(p.get("n_estimators", 100)), int(depth), int(p.get("min_child_weight", p.get("min_child_samples", 1))),
                   float(p.get("subsample", 1.0)), "all" if share >= 1.0 else str(share), float(p.get("learning_rate", 0.1)),
                   float(p.get("reg_lambda", 1.0 if algorithm == "xgboost" else 0.0)), float(p.get("reg_alpha", 0.0)), metric, seed)


def probabilities(margins: Column, task: str) -> Column:
    """Array of class probabilities (binary: of class 1 alone) from an array of margins."""
    if task == BINARY:
        return F.transform(margins, lambda m: 1 / (1 + F.exp(-m)))
    shares = lambda each: _once(_total(each), lambda total: F.transform(each, lambda e: e / total))
    return _once(F.array_max(margins), lambda top: _once(F.transform(margins, lambda m: F.exp(m - top)), shares))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once a row, however often it is named; within a lambda a plain column would be
    computed again for every element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0.0), lambda a, b: a + b)


def _derivatives(task: str, k: int, classes: int) -> tuple[Column, Column]:
    """First and second derivative of a row's loss by margin k; that of joint classes is raised by K / (K - 1), as all K margins move at once."""
    label = F.col(LABEL)
    if task == REGRESSION:
        return F.col(MARGINS)[k] - label, F.lit(1.0)
    p = 1 / (1 + F.exp(-F.col(MARGINS)[0])) if task == BINARY else F.col(CHANCES)[k]
    hit = label if task == BINARY else (label == k).cast("double")
    return p - hit, F.greatest((1 if task == BINARY else classes / max(classes - 1, 1)) * p * (1 - p), F.lit(SMALLEST))


def _loss(margins: Column, task: str) -> Column:
    """A row's loss: squared error, or minus the logarithm of the probability of its class."""
    label = F.col(LABEL)
    if task == REGRESSION:
        return (margins[0] - label) * (margins[0] - label)
    if task == BINARY:
        return F.greatest(margins[0], F.lit(0.0)) - margins[0] * label + F.log1p(F.exp(-F.abs(margins[0])))
    logsum = _once(F.array_max(margins), lambda top: F.log(_total(F.transform(margins, lambda m: F.exp(m - top)))) + top)
    return logsum - F.element_at(margins, label.cast("int") + 1)


def leaf_value(g: float, h: float, spec: BoosterSpec) -> float:
    """The Newton step with both penalties: 0 where the gradients of a leaf stay within reg_alpha."""
    pull = math.copysign(max(abs(g) - spec.reg_alpha, 0.0), g)
    return -pull / (h + spec.reg_lambda)


def _leaf_steps(tree) -> list[tuple[float, float]]:
    """(mean step, total weight) of a tree's leaves, left to right."""
    out, waiting = [], [tree._java_obj.rootNode()]
    while waiting:
        node = waiting.pop()
        if node.subtreeDepth() == 0:
            out.append((node.prediction(), node.impurityStats().stats()[0]))
        else:
            waiting += [node.rightChild(), node.leftChild()]
    return out


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """(rounds with the least loss before `patience` rounds bring no better one, whether that happened)."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        if k - best >= patience:
            return best + 1, True
    return best + 1, False


# ------------------------------------------------------------------------------------------------- blocks of rows

@dataclass
class Grown:
    """A tree in bins: node i sends a row left if its bin of feature ON[i] is at most CUT[i]; ON is -1 at a leaf. G, H and N are the
    sums of both derivatives and the rows of a node."""

    on: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    sums: list[tuple[float, float, int]] = field(default_factory=lambda: [(0.0, 0.0, 0)])

    def split(self, node: int, on: int, cut: int, gain: float, left: tuple, right: tuple) -> tuple[int, int]:
        below = len(self.on), len(self.on) + 1
        self.on[node], self.cut[node], self.gain[node], (self.left[node], self.right[node]) = on, cut, gain, below
        for sums in (left, right):
            for own, value in ((self.on, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.gain, 0.0), (self.sums, sums)):
                own.append(value)
        return below

    def leaves(self) -> list[int]:
        """The leaves, left to right."""
        out, waiting = [], [0]
        while waiting:
            node = waiting.pop()
            if self.on[node] < 0:
                out.append(node)
            else:
                waiting += [self.right[node], self.left[node]]
        return out

    def node_of(self, bins: np.ndarray) -> np.ndarray:
        """Each row's leaf. Small trees compare whole columns, large ones follow every row."""
        if len(self.on) > 63:
            on, cut, left, right = (np.array(c, np.int32) for c in (self.on, self.cut, self.left, self.right))
            at, rows = np.zeros(bins.shape[1], np.int32), np.arange(bins.shape[1])
            while (inner := on[at] >= 0).any():
                at = np.where(inner, np.where(bins[np.maximum(on[at], 0), rows] <= cut[at], left[at], right[at]), at)
            return at

        def below(node: int):
            if self.on[node] < 0:
                return np.int32(node)
            return np.where(bins[self.on[node]] <= self.cut[node], below(self.left[node]), below(self.right[node]))

        return np.broadcast_to(below(0), bins.shape[1])


@dataclass
class Block:
    """Rows of one block: bins by feature, margins by class; whether they are held."""

    number: int
    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    held: bool
    margins: np.ndarray

    def move(self, trees: Sequence[Grown], moves: Sequence[np.ndarray]) -> None:
        """Margins after a round."""
        for k, (tree, move) in enumerate(zip(trees, moves)):
            self.margins[k] += move[tree.node_of(self.bins)]


BLOCKS = f"BLOCK long, BINS binary, {LABEL} binary, {WEIGHT} binary, {VALIDATES} boolean, {MARGINS} binary, LOSSES array<double>"
BLOCK_FILES = {"parquet.block.size": 2**23, "parquet.page.size.row.check.min": 8, "parquet.enable.dictionary": "false"}  # a row is a block


def _blocks(batch: pa.RecordBatch, classes: int) -> Iterator[Block]:
    """Labels that are small whole numbers have a byte each, weights that are all 1 none."""
    for number, held, *parts in zip(*[batch.column(c) for c in ("BLOCK", VALIDATES, MARGINS, "BINS", LABEL, WEIGHT)]):
        margins, bins, label, weight = (v.as_buffer() for v in parts)
        margins = np.frombuffer(margins).reshape(classes, -1).copy()
        rows = margins.shape[1]
        label = np.frombuffer(label, np.uint8).astype(float) if label.size == rows else np.frombuffer(label)
        weight = np.frombuffer(weight) if weight.size else np.ones(rows)
        yield Block(number.as_py(), np.frombuffer(bins, np.uint8).reshape(-1, rows), label, weight, held.as_py(), margins)


def _block_rows(block: Block, losses: list[float]) -> pa.RecordBatch:
    small = np.isin(block.label, np.arange(256)).all()
    parts = [block.bins, block.label.astype(np.uint8) if small else block.label, block.weight[:0] if (block.weight == 1).all() else block.weight, block.margins]
    bins, label, weight, margins = (pa.array([p.tobytes()], pa.binary()) for p in parts)
    return pa.RecordBatch.from_arrays([pa.array([block.number]), bins, label, weight, pa.array([block.held]), margins, pa.array([losses], pa.list_(pa.float64()))],
                                      names=["BLOCK", "BINS", LABEL, WEIGHT, VALIDATES, MARGINS, "LOSSES"])


def bin_of(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """How many cuts are less than each value; NaN lies above all, as a Spark tree sends it right."""
    return (~(values <= cuts[0])).astype(np.uint8) if len(cuts) == 1 else np.searchsorted(cuts, values).astype(np.uint8)


def cuts_of(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Thresholds between a feature's bins, as Spark's trees take them: halfway between all distinct values if they are few, else
    where the running weight is nearest to equal shares."""
    keep = ~np.isnan(values)
    distinct, at = np.unique(values[keep], return_inverse=True)
    if len(distinct) < 2:
        return np.empty(0)
    with np.errstate(over="ignore", invalid="ignore"):
        halfway = distinct[:-1] / 2 + distinct[1:] / 2
    if len(halfway) >= MAX_BINS:
        running = np.cumsum(np.bincount(at, weights[keep]))
        target = stride = running[-1] / MAX_BINS
        chosen = []
        for i in range(1, len(distinct)):
            if abs(running[i - 1] - target) < abs(running[i] - target):
                chosen.append(i - 1)
                target += stride
        halfway = halfway[chosen]
    return np.unique(halfway[np.isfinite(halfway)])[:MAX_BINS - 1]


def gradients(task: str, margins: np.ndarray, label: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Both derivatives by class and row, as `_derivatives` says them."""
    if task == REGRESSION:
        return margins - label, np.ones_like(margins)
    with np.errstate(over="ignore"):
        if task == BINARY:
            p, hit = 1 / (1 + np.exp(-margins)), label
        else:
            weights = np.exp(margins - margins.max(axis=0))
            p, hit = weights / weights.sum(axis=0), label == np.arange(len(margins))[:, None]
    return p - hit, np.maximum((1 if task == BINARY else classes / max(classes - 1, 1)) * p * (1 - p), SMALLEST)


def losses(task: str, margins: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Each row's loss, as `_loss` says it."""
    if task == REGRESSION:
        return (margins[0] - label) ** 2
    if task == BINARY:
        return np.maximum(margins[0], 0) - margins[0] * label + np.log1p(np.exp(-np.abs(margins[0])))
    top = margins.max(axis=0)
    return np.log(np.exp(margins - top).sum(axis=0)) + top - margins[label.astype(int), np.arange(len(label))]


def best_split(sums: np.ndarray, bins: np.ndarray, min_rows: int, among: np.ndarray | None) -> tuple | None:
    """(feature, bin, gain, sums of the left, sums of the right) of the split that lowers the variance of the steps most, from
    sums of both derivatives and rows by feature and bin; the first of equal ones. None where no split lowers it."""
    g, h, n = (np.cumsum(s, axis=1)[:, :-1] for s in sums)
    rg, rh, rn = (np.cumsum(s[:, ::-1], axis=1)[:, ::-1][:, 1:] for s in sums)
    good = (n >= max(min_rows, 1)) & (rn >= max(min_rows, 1)) & (h > 0) & (rh > 0) & (np.arange(g.shape[1]) < (bins - 1)[:, None])
    if among is not None:
        good &= np.isin(np.arange(len(bins)), among)[:, None]
    if not good.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(good, h * rh / (h + rh) ** 2 * (g / h - rg / rh) ** 2, -1.0)
    f, j = np.unravel_index(np.argmax(gain), gain.shape)
    mean = (g[f, j] + rg[f, j]) / (h[f, j] + rh[f, j])
    if gain[f, j] <= 1e-20 * mean * mean:  # equal steps, but for rounding
        return None
    return int(f), int(j), float(gain[f, j]), (float(g[f, j]), float(h[f, j]), int(n[f, j])), (float(rg[f, j]), float(rh[f, j]), int(rn[f, j]))


class Booster:
    """An ensemble that grows by rounds over rows with FEATURES, LABEL, WEIGHT and VALIDATES, all of them not null.

    `classes` margins are kept per row: one, or one per class with joint softmax gradients. Rows that validate take no part in
    trees and leaf values; their loss after each round is in `losses` (with metric `aucpr` the negated average precision).
    Rows lie in the shared folder in blocks, a byte a feature and their margins, which are written anew every STAGE_ROUNDS rounds:
    no lineage grows with the rounds, a task holds a few blocks whatever the rows are, and a lost executor costs at most
    one pass. Only sums come to the driver, per node and bin of one level. With `start`, models of an earlier fit, growth goes on
    from their margins.
    """

    def __init__(self, data: DataFrame, task: str, classes: int, spec: BoosterSpec, start: Sequence[GBTRegressionModel] = ()):
        self.spark, self.task, self.spec = data.sparkSession, task, spec
        self.classes = classes if task == MULTICLASS else 1
        self.scratch = Scratch(self.spark)
        self.trees: list[list] = [[] for _ in range(self.classes)]      # Spark trees of each class, without their constant
        self.values: list[list[list[float]]] = [[] for _ in range(self.classes)]   # their leaf values, left to right
        self.losses: list[float] = []
        self.start = list(start)
        self.before = self.start[0].getNumTrees - 1 if self.start else 0
        rows = data if WEIGHT in data.columns else data.withColumn(WEIGHT, F.lit(1.0))
        rows = rows if VALIDATES in data.columns else rows.withColumn(VALIDATES, F.lit(False))
        self.data = rows.select(FEATURES, LABEL, WEIGHT, VALIDATES)
        fits = self.data.where(~F.col(VALIDATES))
        self.base, fitting = self._base(fits)
        if not fitting:
            raise ValueError("no rows to fit on")
        self.cuts = self._cuts(fits, fitting)
        self.bins = np.array([len(c) + 1 for c in self.cuts], int)
        self.blocks = self.scratch.write(self._packed(self._with_margins(self.start)), **BLOCK_FILES)

    def _base(self, fits: DataFrame) -> tuple[list[float], int]:
        """(margins of a row of which nothing is known, the rows)."""
        w, y = F.col(WEIGHT), F.col(LABEL)
        if self.task == REGRESSION:
            mean, rows = fits.agg(F.try_divide(F.sum(w * y), F.sum(w)), F.count("*")).first()
            return [float(mean or 0.0)], rows
        found = [r for r in fits.groupBy(LABEL).agg(F.sum(w).alias("w"), F.count("*").alias("n")).collect()]
        if any(r[LABEL] is None or math.isnan(r[LABEL]) for r in found):
            raise ValueError("labels of rows to fit on must not be null")
        sums, rows = {int(r[LABEL]): r["w"] for r in found}, sum(r["n"] for r in found)
        total = sum(sums.values()) or 1.0
        shares = [min(max(sums.get(k, 0.0) / total, RARE), 1 - RARE) for k in range(max(self.classes, 2))]
        if self.task == BINARY:
            return [math.log(shares[1] / (1 - shares[1]))], rows
        return [math.log(s) for s in shares], rows

    def _cuts(self, fits: DataFrame, fitting: int) -> list[np.ndarray]:
        """Each feature's thresholds, from a sample of the rows that fit; the driver holds SAMPLE_VALUES of it at once."""
        x = vector_to_array(FEATURES)
        size = fits.select(F.size(x)).first()[0]
        sample = fits.select(x.alias("X"), F.col(WEIGHT).cast("double").alias("W"))
        if fitting > SAMPLE_ROWS:
            sample = sample.sample(False, SAMPLE_ROWS / fitting, self.spec.seed)
        at_once = max(1, SAMPLE_VALUES // SAMPLE_ROWS)
        sample = self.scratch.write(sample) if size > at_once else sample
        out = []
        for first in range(0, size, at_once):
            found = sample.select(F.slice("X", first + 1, at_once).alias("X"), "W").toArrow()
            wide = found["X"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(found.num_rows, min(at_once, size - first))
            out += [cuts_of(wide[:, f], found["W"].to_numpy()) for f in range(wide.shape[1])]
        return out

    def _with_margins(self, models: Sequence[GBTRegressionModel]) -> DataFrame:
        """The rows with the margins that the models say of them, the first ones without models."""
        rows = self.data
        for k, model in enumerate(models):
            rows = model.copy({model.predictionCol: f"_M{k}"}).transform(rows)
        margins = [F.col(f"_M{k}") for k in range(self.classes)] if models else [F.lit(b) for b in self.base[:self.classes]]
        return rows.select(FEATURES, LABEL, WEIGHT, VALIDATES, F.array(*margins).alias(MARGINS))

    @property
    def rows(self) -> DataFrame:
        """The rows with their margins so far."""
        return self._with_margins(self.models() if self.rounds else [])

    def _packed(self, rows: DataFrame) -> DataFrame:
        cuts, classes, size = self.cuts, self.classes, len(self.cuts)
        most = max(256, min(BLOCK_ROWS, BLOCK_BYTES // (size + 8 * classes + 17)))

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            number = TaskContext.get().partitionId() << 32
            for batch in batches:
                x, margins = (batch.column(c).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, w) for c, w in ((0, size), (4, classes)))
                label, weight, held = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
                label, weight, held = label.astype(float), weight.astype(float), held.astype(bool)
                if not (np.isfinite(label[~held]).all() and (weight[~held] >= 0).all()):
                    raise ValueError("labels and weights of rows to fit on must be finite numbers, weights not negative")
                if not np.isfinite(x[~held]).all():
                    raise ValueError("features of rows to fit on must be finite numbers")
                for whole, some in ((False, np.flatnonzero(~held)), (True, np.flatnonzero(held))):  # a block is held as a whole or not at all
                    for at in range(0, len(some), most):
                        part = some[at:at + most]
                        bins = np.stack([bin_of(x[part, f], cuts[f]) for f in range(size)]) if size else np.empty((0, len(part)), np.uint8)
                        yield _block_rows(Block(number, bins, label[part], weight[part], whole, np.ascontiguousarray(margins[part].T)), [])
                        number += 1

        wide = rows.where(F.col(VALIDATES).isNotNull()).select(
            vector_to_array(FEATURES).alias("X"), F.col(LABEL).cast("double"), F.col(WEIGHT).cast("double"), VALIDATES, MARGINS)
        return wide.mapInArrow(packed, BLOCKS)

    @property
    def rounds(self) -> int:
        return self.before + len(self.trees[0])

    def grow(self, rounds: int) -> None:
        """That many further rounds."""
        while rounds > 0:
            now = min(rounds, STAGE_ROUNDS)
            done: list[tuple[list[Grown], list[np.ndarray]]] = []   # the rounds since the margins were written
            for _ in range(now):
                done.append(self._round(done))
            with changed_setting(self.spark, *BATCH_BYTES):
                before, self.blocks = self.blocks, self.scratch.write(self._moved(done), **BLOCK_FILES)
            self._watch(before, done)
            self.scratch.drop(before)
            rounds -= now

    def _with_chances(self, rows: DataFrame) -> DataFrame:
        """Joint classes only: the chances by the current margins, once a round for all classes."""
        return rows.withColumn(CHANCES, probabilities(F.col(MARGINS), self.task)) if self.task == MULTICLASS else rows

    def _round(self, done: Sequence) -> tuple[list[Grown], list[np.ndarray]]:
        """One more tree per class and how far its nodes move a margin. A level is one pass over the rows, of two sister nodes
        only the smaller one is summed; the other is what is left of their parent."""
        spec, trees = self.spec, [Grown() for _ in range(self.classes)]
        asked, parents = [[(k, 0)] for k in range(self.classes)], {}
        for level in range(spec.depth):
            direct = [min(nodes, key=lambda at: trees[at[0]].sums[at[1]][2]) for nodes in asked]
            found = self._sums(done, trees, direct)
            for nodes, own in zip(asked, direct):
                if level == 0:
                    trees[own[0]].sums[0] = tuple(s.item() for s in found[own][:, -1, 0])
                for other in nodes:
                    if other != own:
                        left = parents[own] - found[own]
                        found[other] = np.where(left[2] > 0, left, 0.0)
            asked, before, parents = [], found, {}
            for (k, node), sums in sorted(before.items()):
                best = best_split(sums[:, :-1], self.bins, spec.min_rows, self._among(k, node))
                if best is not None:
                    below = [(k, b) for b in trees[k].split(node, *best)]
                    if any(trees[k].sums[b][2] >= 2 * max(spec.min_rows, 1) for _, b in below):
                        asked.append(below)
                        parents |= {b: sums for b in below}
            if not asked:
                break
        new = [self._spark_tree(tree) for tree in trees]
        sums = self._leaf_sums(self._leaves(done, trees) if spec.subsample < 1.0 else None, new)
        moves = []
        for k, tree in enumerate(trees):
            self.trees[k].append(new[k].setFeaturesCol(FEATURES).setPredictionCol(f"_P{k}").setLeafCol(f"_L{k}"))
            self.values[k].append([leaf_value(g, h, spec) for g, h in sums[k]])
            moves.append(np.zeros(len(tree.on)))
            moves[k][tree.leaves()] = spec.learning_rate * np.array(self.values[k][-1])
        return trees, moves

    def _among(self, k: int, node: int) -> np.ndarray | None:
        """The features that a node may be split on; None for all."""
        name, size = self.spec.features, len(self.cuts)
        if name in ("all", "auto"):
            return None
        share = {"sqrt": math.sqrt(size), "log2": max(1.0, math.log2(max(size, 1))), "onethird": size / 3}.get(name)
        most = math.ceil(share if share is not None else float(name) * size if "." in name else int(name))
        return None if most >= size else self._random(k, node).choice(size, max(most, 1), replace=False)

    def _random(self, *place: int) -> np.random.Generator:
        return _seeded(self.spec.seed, self.rounds, *place)

    def _sums(self, done: Sequence, trees: Sequence[Grown], asked: Sequence[tuple[int, int]]) -> dict[tuple[int, int], np.ndarray]:
        """Per class and node: the weighted sums of both derivatives and the rows by feature and bin, over the rows that fit. The last
        feature is a single bin, the whole node."""
        task, classes, spec, bins, rounds = self.task, self.classes, self.spec, self.bins, self.rounds
        width = int(bins.sum()) + 1
        starts = np.concatenate([[0], np.cumsum(bins)]).astype(int)
        tasks = 4 * self.spark.sparkContext.defaultParallelism
        at_once = max(1, SUMS_BYTES // (24 * width * tasks))
        size, widest = len(bins), int(bins.max(initial=1))
        pairs = np.flatnonzero(bins == 2)
        others = [f for f in range(size) if bins[f] > 2]
        out = {}
        for first in range(0, len(asked), at_once):
            some = asked[first:first + at_once]

            def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                total = np.zeros((3, len(some), width))
                for batch in batches:
                    for block in _blocks(batch, classes):
                        _add(block, total)
                yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["PART", "SUMS"])

            def _add(block: Block, total: np.ndarray) -> None:
                for earlier in done:
                    block.move(*earlier)
                g, h = gradients(task, block.margins, block.label, classes)
                plain = task == REGRESSION and (block.weight == 1).all()
                for k in {k for k, _ in some}:
                    mine = [i for i, (c, _) in enumerate(some) if c == k]
                    slots = np.full(len(trees[k].on), -1)
                    slots[[some[i][1] for i in mine]] = range(len(mine))
                    slot = slots[trees[k].node_of(block.bins)]
                    use = slot >= 0
                    if spec.subsample < 1.0:
                        use &= _seeded(spec.seed, rounds, k, -1, block.number).random(len(use)) < spec.subsample
                    rows = None if use.all() else np.flatnonzero(use)
                    w, wg, wh = block.weight, g[k] * block.weight, h[k] * block.weight
                    if rows is not None:
                        slot, w, wg, wh = slot[rows], w[rows], wg[rows], wh[rows]
                    whole = total[:, mine]
                    own = np.array([np.bincount(slot, v, len(mine)) for v in (wg, wh, None)])
                    whole[:, :, -1] += own
                    if len(pairs):  # features of two bins: the sums of the upper bin are products of matrices
                        upper = block.bins[pairs] if rows is None else block.bins[pairs][:, rows]
                        columns = np.concatenate([np.where(slot == i, v, 0.0) for v in (wg, wh, 1.0) for i in range(len(mine))]).reshape(3 * len(mine), -1)
                        high = (columns @ upper.T.astype(float)).reshape(3, len(mine), -1)
                        whole[:, :, starts[pairs] + 1] += high
                        whole[:, :, starts[pairs]] += own[:, :, None] - high
                    for f in others:
                        n, key = int(bins[f]), block.bins[f] if rows is None else block.bins[f][rows]
                        key = slot * n + key if len(mine) > 1 else key
                        part = slice(starts[f], starts[f] + n)
                        count = np.bincount(key, minlength=len(mine) * n).reshape(-1, n)
                        whole[0][:, part] += np.bincount(key, wg, len(mine) * n).reshape(-1, n)
                        whole[1][:, part] += count if plain else np.bincount(key, wh, len(mine) * n).reshape(-1, n)
                        whole[2][:, part] += count
                    total[:, mine] = whole

            with changed_setting(self.spark, *BATCH_BYTES):
                parts = self.blocks.where(~F.col(VALIDATES)).coalesce(tasks).mapInArrow(added, "PART int, SUMS binary").collect()
            total = np.zeros((3, len(some), width))
            for part in sorted(parts, key=lambda r: r["PART"]):
                total += np.frombuffer(part["SUMS"]).reshape(total.shape)
            for i, at in enumerate(some):
                out[at] = np.zeros((3, size + 1, widest))   # a feature of one bin splits nothing and is left out
                for f in range(size + 1):
                    n = int(bins[f]) if f < size else 1
                    out[at][:, f, :n] = total[:, i, starts[f]:starts[f] + n]
        return out

    def _moved(self, done: Sequence) -> DataFrame:
        """The blocks with margins after these rounds; LOSSES are the held rows' summed losses after each, their weight and number."""
        task, classes = self.task, self.classes

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in _blocks(batch, classes):
                    lost, known = [], ~np.isnan(block.label)
                    for each in done:
                        block.move(*each)
                        if block.held:
                            lost.append(float((block.weight[known] * losses(task, block.margins[:, known], block.label[known])).sum()))
                    yield _block_rows(block, [*lost, float(block.weight.sum()), float(len(known))] if block.held else [])

        return self.blocks.mapInArrow(moved, BLOCKS)

    def _leaves(self, done: Sequence, trees: Sequence[Grown]) -> DataFrame:
        """Rows with their margins before a round and the place of their leaf in each of its trees."""
        classes = self.classes

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            places = [np.zeros(len(tree.on), np.int32) for tree in trees]
            for place, tree in zip(places, trees):
                place[tree.leaves()] = np.arange(len(tree.leaves()))
            for batch in batches:
                for block in _blocks(batch, classes):
                    for earlier in done:
                        block.move(*earlier)
                    ends = pa.array(np.arange(0, classes * len(block.label) + 1, classes), pa.int32())
                    margins = pa.ListArray.from_arrays(ends, pa.array(block.margins.T.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(v) for v in (block.label, block.weight, np.full(len(block.label), block.held))], margins, *[pa.array(p[t.node_of(block.bins)]) for p, t in zip(places, trees)]],
                        names=[LABEL, WEIGHT, VALIDATES, MARGINS, *[f"_L{k}" for k in range(classes)]])

        kinds = f"{LABEL} double, {WEIGHT} double, {VALIDATES} boolean, {MARGINS} array<double>"
        return self._with_chances(self.blocks.mapInArrow(rows, ", ".join([kinds, *[f"_L{k} int" for k in range(classes)]])))

    def _leaf_sums(self, leaves: DataFrame | None, new: Sequence) -> list[list[tuple[float, float]]]:
        """Per class and leaf, left to right: the weighted sums of both derivatives over the rows that fit. A tree grown on all of
        these rows holds them already, as its steps are -g / h with weights h; only a sampled one needs a pass of its own."""
        if self.spec.subsample >= 1.0:
            return [[(-weight * step, weight) for step, weight in _leaf_steps(tree)] for tree in new]
        sums = [F.struct(F.lit(k).alias("k"), F.col(f"_L{k}").cast("int").alias("leaf"), (d[0] * F.col(WEIGHT)).alias("g"), (d[1] * F.col(WEIGHT)).alias("h"))
                for k in range(self.classes) for d in [_derivatives(self.task, k, self.classes)]]
        found = leaves.where(~F.col(VALIDATES)).select(F.inline(F.array(*sums))).groupBy("k", "leaf").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
        out = [[(0.0, 0.0)] * ((tree.numNodes + 1) // 2) for tree in new]
        for r in found:
            out[r["k"]][r["leaf"]] = r["g"], r["h"]
        return out

    def _watch(self, before: DataFrame, done: Sequence) -> None:
        """Losses of the held rows after each of the last rounds."""
        if self.spec.metric == "aucpr" and self.task == BINARY:
            trail = self.scratch.write(self._trail(before, done))
            for r in range(len(done)):
                value = ranking_metrics(trail.select(LABEL, F.col(TRAIL)[r].alias("_S")), LABEL, "_S").first()["pr_auc"]
                self.losses.append(math.inf if value is None else -value)
            self.scratch.drop(trail)
            return
        *lost, weight, held = self.blocks.where(VALIDATES).agg(*[F.sum(F.col("LOSSES")[r]) for r in range(len(done) + 2)]).first()
        means = [v / (weight or 1.0) if held else math.inf for v in lost]
        self.losses += [math.sqrt(v) for v in means] if self.task == REGRESSION else means

    def _trail(self, before: DataFrame, done: Sequence) -> DataFrame:
        """The held rows' labels and their margins after each of the last rounds, of the one class there is."""
        def trail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block in _blocks(batch, 1):
                    seen = []
                    for each in done:
                        block.move(*each)
                        seen.append(block.margins[0].copy())
                    ends = pa.array(np.arange(0, len(done) * len(block.label) + 1, len(done)), pa.int32())
                    label = pa.array(block.label, mask=np.isnan(block.label))
                    yield pa.RecordBatch.from_arrays([label, pa.ListArray.from_arrays(ends, pa.array(np.stack(seen, axis=1).ravel()))], names=[LABEL, TRAIL])

        return before.where(VALIDATES).mapInArrow(trail, f"{LABEL} double, {TRAIL} array<double>")

    def grow_with_patience(self, patience: int) -> int:
        """Grows until `patience` rounds bring no better loss, or to the most rounds; gives the rounds of the least loss."""
        while True:
            best, stopped = best_round(self.losses, patience) if self.losses else (0, False)
            if stopped or self.rounds >= self.spec.rounds:
                return self.before + best
            self.grow(min(STAGE_ROUNDS, self.spec.rounds - self.rounds))

    def models(self, rounds: int | None = None) -> list[GBTRegressionModel]:
        """One Spark ensemble per class, whose prediction is the margin: a constant and the first `rounds` trees, those of the start included."""
        return [self._model(k, self.rounds if rounds is None else rounds) for k in range(self.classes)]

    def _model(self, k: int, rounds: int) -> GBTRegressionModel:
        """The trees in Spark's own format, with the leaf values put in by a join on the node table."""
        jvm = self.spark.sparkContext._jvm
        if self.start:
            head = [(t._java_obj, w) for t, w in zip(self.start[k].trees, self.start[k].treeWeights)]
        else:
            one = self._spark_tree(Grown())   # a tree of one leaf; it must outlive its use in the JVM
            head = [(one._java_obj, 1.0)]
        new = self.trees[k][:max(rounds - self.before, 0)]
        parts = head + [(t._java_obj, self.spec.learning_rate) for t in new]
        trees = self.spark.sparkContext._gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(parts))
        weights = self.spark.sparkContext._gateway.new_array(jvm.double, len(parts))
        for i, (tree, weight) in enumerate(parts):
            trees[i], weights[i] = tree, float(weight)
        raw = GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(jvm.org.apache.spark.ml.util.Identifiable.randomUID("gbtr"), trees, weights))
        raw = raw.setFeaturesCol(FEATURES).setPredictionCol(f"_MARGIN{k}" if self.task == MULTICLASS else "prediction")
        path = f"{self.scratch.root}/model-{k}-{rounds}"
        raw.write().overwrite().save(f"{path}/raw")
        raw.write().overwrite().save(f"{path}/done")
        nodes = self.spark.read.parquet(f"{path}/raw/data")
        leaves = [(i, j, v) for i, values in enumerate(self.values[k][:len(new)], len(head)) for j, v in enumerate(values)]
        if not self.start:
            leaves.append((0, 0, self.base[k]))
        own = self.spark.createDataFrame(leaves or [(-1, 0, 0.0)], "treeID int, place int, own double")
        # Node numbers run through a tree in pre-order, so a leaf's place is its rank among the tree's leaves.
        places = nodes.where("nodeData.leftChild < 0").groupBy("treeID").agg(F.sort_array(F.collect_list("nodeData.id")).alias("ids"))
        places = places.select("treeID", F.posexplode("ids").alias("place", "id")).join(own, ["treeID", "place"])
        places = places.select("treeID", "id", "own")
        fields = [F.coalesce("own", "nodeData.prediction").alias("prediction") if f == "prediction" else F.col(f"nodeData.{f}").alias(f)
                  for f in nodes.schema["nodeData"].dataType.names]
        joined = nodes.withColumn("id", F.col("nodeData.id")).join(places, ["treeID", "id"], "left")
        joined.select("treeID", F.struct(*fields).alias("nodeData")).write.mode("overwrite").parquet(f"{path}/done/data")
        return GBTRegressionModel.load(f"{path}/done")

    def _spark_tree(self, tree: Grown) -> DecisionTreeRegressionModel:
        """The tree as Spark has it, its steps as predictions and their weights as statistics; no node keeps its variance."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        ml, of_stats = jvm.org.apache.spark.ml, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
        leaf, inner, splits, double = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, jvm.double

        def node(i: int):
            g, h, n = tree.sums[i]
            step = -g / h if h else 0.0
            stats = gateway.new_array(double, 3)
            stats[0], stats[1], stats[2] = float(h), float(-g), float(-g * step)
            told = of_stats(stats, int(n))
            if tree.on[i] < 0:
                return leaf(step, 0.0, told)
            split = splits(tree.on[i], float(self.cuts[tree.on[i]][tree.cut[i]]))
            return inner(step, 0.0, tree.gain[i], node(tree.left[i]), node(tree.right[i]), split, told)

        return DecisionTreeRegressionModel(ml.regression.DecisionTreeRegressionModel(ml.util.Identifiable.randomUID("dtr"), node(0), len(self.cuts)))


def _seeded(seed: int, *place: int) -> np.random.Generator:
    return np.random.default_rng([v % 2**64 for v in (seed, *place)])
