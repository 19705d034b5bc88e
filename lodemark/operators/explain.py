"""Why a row scored as it did: contributions per source feature, and the causes text built from them.

Linear models and the importance fallback are plain column arithmetic. Tree ensembles use path-dependent Shapley
values (Lundberg et al., "Consistent Individualized Feature Attribution for Tree Ensembles"): root-to-leaf paths are
joined level by level into a table in the shared folder; rows stream past few leaves, and blocks of them meet blocks of
many leaves, whose parts are summed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DateType, DoubleType, NumericType, StringType, StructType, TimestampNTZType,
                               TimestampType)

from lodemark.functions.columns import causes_from, col
from lodemark.operators.encode import Contract
from lodemark.sources.scans import Scratch, staged


def feature_means(df: DataFrame, encoded: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(col(c)).alias(c) for c in encoded]).first()
    return {c: float(row[c] or 0.0) for c in encoded}


def centred_contributions(weights: dict[str, float], means: dict[str, float], sources: dict[str, str]) -> dict[str, Column]:
    """Per source feature: Σ weight · (x − mean) over its encoded columns. Weights are coefficients or importances."""
    out: dict[str, Column] = {}
    for name, weight in weights.items():
        term = (col(name) - F.lit(means[name])) * F.lit(float(weight))
        source = sources[name]
        out[source] = out[source] + term if source in out else term
    return out


def feature_importance(df: DataFrame, contributions: dict[str, Column], top: int) -> DataFrame:
    """Mean absolute contribution and mean direction per source feature, strongest first; one aggregate."""
    names = list(contributions)
    stats = df.agg(*[F.struct(F.avg(F.abs(c)).alias("a"), F.avg(c).alias("d")).alias(f"c{i}")
                     for i, c in enumerate(contributions.values())])
    entries = F.array(*[F.struct(F.lit(n).alias("FEATURE"), F.col(f"c{i}.a").alias("MEAN_ABS_CONTRIBUTION"),
                                 F.col(f"c{i}.d").alias("DIRECTION")) for i, n in enumerate(names)])
    return stats.select(F.inline(entries)).orderBy(F.desc("MEAN_ABS_CONTRIBUTION"), "FEATURE").limit(top)


def contribution_rows(explained: DataFrame, keys: Sequence[str], encoded: Sequence[str], contract: DataFrame,
                      suffix: str = "") -> DataFrame:
    """Explanation columns as rows, matched to the contract by name (any case, suffix removed) and summed per source
    feature; only positive sums stay. Rows are summed per key while wide, one column per source feature, and become
    rows afterwards, so a task holds its keys once and not once per encoded column. The contract is bounded when fitted."""
    by_name: dict[str, list[Column]] = {}
    for c in encoded:
        by_name.setdefault(c.upper(), []).append(F.coalesce(col(f"{c}{suffix}"), F.lit(0.0)))
    by_source: dict[str | None, list[Column]] = {}
    for r in contract.select(F.upper("ENCODED_NAME").alias("ENCODED"), F.col("SOURCE_NAME").alias("BASE")).collect():
        by_source.setdefault(r["BASE"], []).extend(by_name.get(r["ENCODED"], ()))
    names = {f"_C{i}": source for i, source in enumerate(by_source or {None: []})}
    wide = explained.select(*[col(k) for k in keys], *[_added(by_source.get(source, [])).alias(n) for n, source in names.items()])
    grouped = wide.groupBy(*[col(k) for k in keys]).agg(*[F.sum(n).alias(n) for n in names])
    entry = lambda source, value: F.struct(F.lit(source).cast("string").alias("BASE"), value.alias("CONTRIB"))
    parts = F.array(*[entry(source, F.col(n)) for n, source in names.items()])
    return grouped.select(*[col(k) for k in keys], F.inline(F.filter(parts, lambda e: e["CONTRIB"] > 0)))


def _added(values: Sequence[Column]) -> Column:
    """The sum in pairs, so that thousands of terms do not nest as deep as they are many."""
    if len(values) < 2:
        return values[0] if values else F.lit(0.0)
    return _added(values[:len(values) // 2]) + _added(values[len(values) // 2:])


def causes_by_key(contributions: DataFrame, keys: Sequence[str], top: int) -> DataFrame:
    """(keys, PROBABLE_CAUSES) from contribution rows; a group holds one entry per source feature."""
    entries = F.collect_list(F.struct((-F.col("CONTRIB")).alias("key"), F.col("BASE").alias("name")))
    grouped = contributions.groupBy(*[col(k) for k in keys]).agg(entries.alias("entries"))
    return grouped.select(*[col(k) for k in keys], causes_from(F.col("entries"), top).alias("PROBABLE_CAUSES"))


def causes_of_array(phi: Column, sources: Sequence[str], top: int) -> Column:
    """Causes text from an array of contributions aligned with `sources`."""
    names = F.array(*[F.lit(s) for s in sources])
    entries = F.transform(phi, lambda v, i: F.struct((-v).alias("key"), F.get(names, i).alias("name")))
    return causes_from(F.filter(entries, lambda e: e["key"] < 0), top)


# --------------------------------------------------------------------------------------------- tree ensembles

LEAVES_AT_ONCE = 20_000        # leaves of a block
FEATURES_AT_ONCE = 500_000     # feature values of a block of rows
CELLS = 4_000_000              # rows × leaves × features held at once while explaining
FEW_LEAVES = 2_000             # leaf values of all ensembles up to which every task holds them all
COMPARISONS = 10               # comparisons whose outcomes are tabled together
PLAIN = NumericType, StringType, BooleanType, DateType, TimestampType, TimestampNTZType, BinaryType   # columns that stream through Python
SIDES = ("FEATURES", "LOW", "HIGH", "KEPT")


@dataclass
class Leaves:
    """Root-to-leaf paths of one ensemble, or of one per class, in the shared folder, and the blocks of each ensemble.

    Columns: ENSEMBLE, BLOCK, TREE, LEAF; per feature on the path the arrays FEATURES (ascending), LOW and HIGH (the interval
    that leads to the leaf) and KEPT (the share of training weight kept); VALUES, one value or one per class.
    """

    table: DataFrame
    blocks: list[int]
    values: int   # in the leaves of all ensembles

    def base(self) -> list[float]:
        """What the ensembles say of a row of which nothing is known, per position of VALUES."""
        chance = F.aggregate("KEPT", F.lit(1.0), lambda a, k: a * k)
        each = self.table.select(F.posexplode(F.transform("VALUES", lambda v: v * chance)).alias("AT", "VALUE"))
        return [r["VALUE"] for r in each.groupBy("AT").agg(F.sum("VALUE").alias("VALUE")).orderBy("AT").collect()]


def read_trees(learners: Sequence, weights: Sequence[Sequence[float]], classes: bool = False) -> Leaves:
    """Leaves of fitted Spark ensembles; with `classes`, a leaf's values are its class shares.

    Models are saved to the shared folder and their node tables read back. Paths grow by one join with the nodes per level, all
    trees together; neither a node nor a path comes to the driver.
    """
    spark = SparkSession.active()
    scratch = Scratch(spark)
    nodes = scratch.write(_nodes(spark, scratch, learners, weights, classes))
    empty = [F.array().cast("array<int>").alias("FEATURES"), *[F.array().cast("array<double>").alias(c) for c in SIDES[1:]]]
    level = scratch.write(nodes.where("ID = 0").select(*nodes.columns, *empty))
    finished = []
    while True:
        finished.append(level.where("LEFT_ID < 0").select("ENSEMBLE", "TREE", F.col("ID").alias("LEAF"), *SIDES, "VALUES"))
        inner = level.where("LEFT_ID >= 0")
        if inner.isEmpty():
            break
        level = scratch.write(_children(inner, nodes))
    paths = finished[0]
    for more in finished[1:]:
        paths = paths.unionByName(more)
    found = {r["ENSEMBLE"]: r["count"] for r in paths.groupBy("ENSEMBLE").count().collect()}
    blocks = [max(1, math.ceil(found[k] / LEAVES_AT_ONCE)) for k in range(len(found))]
    of = F.get(F.array(*[F.lit(b) for b in blocks]), F.col("ENSEMBLE"))
    table = scratch.write(paths.withColumn("BLOCK", F.pmod(F.xxhash64("TREE", "LEAF"), of).cast("int")))
    return Leaves(table, blocks, table.agg(F.sum(F.size("VALUES"))).first()[0])


def _nodes(spark: SparkSession, scratch: Scratch, learners: Sequence, weights: Sequence[Sequence[float]], classes: bool) -> DataFrame:
    """Nodes of all ensembles: children, split, training weight, and the weighted values of a leaf."""
    both = []
    for k, (learner, tree_weights) in enumerate(zip(learners, weights)):
        learner.write().save(f"{scratch.root}/trees-{k}")
        both.append(spark.read.parquet(f"{scratch.root}/trees-{k}/data").select(F.lit(k).alias("ENSEMBLE"), F.col("treeID").alias("TREE"), "nodeData.*"))
    rows = both[0]
    for more in both[1:]:
        rows = rows.unionByName(more)
    per_tree = spark.createDataFrame([(k, t, float(w)) for k, ws in enumerate(weights) for t, w in enumerate(ws)], "ENSEMBLE int, TREE int, WEIGHT double")
    stats = F.col("impurityStats")
    cover = F.aggregate(stats, F.lit(0.0), lambda a, v: a + v) if classes else stats[0]
    values = F.transform(stats, lambda v: F.col("WEIGHT") * v / cover) if classes else F.array(F.col("WEIGHT") * F.col("prediction"))
    return rows.join(per_tree, ["ENSEMBLE", "TREE"]).select(
        "ENSEMBLE", "TREE", F.col("id").alias("ID"), F.col("leftChild").alias("LEFT_ID"), F.col("rightChild").alias("RIGHT_ID"),
        F.col("split.featureIndex").alias("SPLIT_ON"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("THRESHOLD"),
        cover.alias("COVER"), values.alias("VALUES"))


def _children(inner: DataFrame, nodes: DataFrame) -> DataFrame:
    """The next level: both children of every inner node, their paths narrowed by its split. A feature met before keeps its place."""
    sides = F.explode(F.array(F.struct(F.col("LEFT_ID").alias("ID"), F.lit(-math.inf).alias("LOW"), F.col("THRESHOLD").alias("HIGH")),
                              F.struct(F.col("RIGHT_ID").alias("ID"), F.col("THRESHOLD").alias("LOW"), F.lit(math.inf).alias("HIGH"))))
    step = inner.select("ENSEMBLE", "TREE", F.col("SPLIT_ON").alias("ON"), F.col("COVER").alias("WAS"),
                        F.arrays_zip(*SIDES).alias("PATH"), sides.alias("SIDE")).withColumn("ID", F.col("SIDE.ID"))
    share = F.col("COVER") / F.col("WAS")
    old = F.get(F.filter("PATH", lambda e: e["FEATURES"] == F.col("ON")), F.lit(0))
    here = F.struct(F.col("ON").alias("FEATURES"), F.greatest(F.coalesce(old["LOW"], F.lit(-math.inf)), F.col("SIDE.LOW")).alias("LOW"),
                    F.least(F.coalesce(old["HIGH"], F.lit(math.inf)), F.col("SIDE.HIGH")).alias("HIGH"),
                    (F.coalesce(old["KEPT"], F.lit(1.0)) * share).alias("KEPT"))
    path = F.array_sort(F.concat(F.filter("PATH", lambda e: e["FEATURES"] != F.col("ON")), F.array(here)))
    joined = step.join(nodes, ["ENSEMBLE", "TREE", "ID"]).withColumn("PATH", path)
    return joined.select(*nodes.columns, *[F.col(f"PATH.{c}").alias(c) for c in SIDES])


@dataclass
class Paths:
    """Paths with one number of features: leaves × features, and leaves × values."""

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    kept: np.ndarray
    value: np.ndarray

    def some(self, leaves: Sequence[int]) -> Paths:
        return Paths(*[c[leaves] for c in (self.features, self.low, self.high, self.kept, self.value)])


def paths_of(leaves: pa.Table) -> list[Paths]:
    """Rows of a leaf table by the length of their paths; paths without a feature explain nothing and are left out."""
    leaves = leaves.sort_by([("TREE", "ascending"), ("LEAF", "ascending")])
    lengths = np.fromiter((len(f) for f in leaves["FEATURES"]), int, len(leaves))
    out = []
    for d in np.unique(lengths[lengths > 0]):
        same = leaves.filter(pa.array(lengths == d))
        grids = [same[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(same), -1) for c in (*SIDES, "VALUES")]
        out.append(Paths(*grids))
    return out


def shapley_values(x: np.ndarray, paths: Sequence[Paths], pick: np.ndarray | None = None) -> np.ndarray:
    """(rows × features) Shapley values. `pick` chooses the class per row when leaves hold class shares.

    For a leaf with features F on its path, a subset S of them reaches it with weight Π_S reached · Π_{F\\S} kept. The
    subsets are summed by size as coefficients of Π (kept_j + reached_j · t); dividing one factor out gives the sum over
    the subsets without that feature. All of it depends on the outcomes of a few comparisons, so it is done once per outcome for
    a run of leaves and looked up by the rows; leaves with more comparisons than pay for these rows are done row by row.
    """
    return Prepared.of(paths, min(COMPARISONS, max(len(x) // 4, 1).bit_length() - 1), keep=False).explain(x, pick)


@dataclass
class Table:
    """What a run of leaves adds to the Shapley values of its features, by class, feature and the outcomes of the comparisons
    `x <= at` on their paths, read as bits."""

    on: list[tuple[int, float]]
    features: np.ndarray
    values: np.ndarray


@dataclass
class Prepared:
    """Leaves as tables, and those left whose paths have too many comparisons."""

    tables: Iterator[Table] | list[Table]
    rest: list[Paths]

    @classmethod
    def of(cls, paths: Sequence[Paths], most: int, keep: bool = True) -> Prepared:
        runs, rest = [], []
        for same in paths:
            known, wide, mine = set(), [], []
            for i, sides in enumerate(zip(same.features.tolist(), same.low.tolist(), same.high.tolist())):
                on = {(f, at) for f, low, high in zip(*sides) for at in (low, high) if not math.isinf(at)}
                if len(on) > most:
                    wide.append(i)
                    continue
                if len(known | on) > most:
                    runs.append((same, mine, sorted(known)))
                    known, mine = set(), []
                mine.append(i)
                known |= on
            if mine:
                runs.append((same, mine, sorted(known)))
            if wide:
                rest.append(same.some(wide))
        tables = (_table(same.some(run), on) for same, run, on in runs)
        return cls(list(tables) if keep else tables, rest)

    def explain(self, x: np.ndarray, pick: np.ndarray | None) -> np.ndarray:
        columns, out = np.ascontiguousarray(x.T), np.zeros(x.shape[::-1])
        for table in self.tables:
            code = np.zeros(len(x), np.intp)
            for i, (f, at) in enumerate(table.on):
                code |= (columns[f] <= at).astype(np.intp) << i
            for i, f in enumerate(table.features):
                out[f] += table.values[pick, i, code] if pick is not None and len(table.values) > 1 else table.values[-1, i][code]
        out = np.ascontiguousarray(out.T)
        for same in self.rest:
            _add_directly(out, x, same, pick)
        return out


def _table(same: Paths, on: list[tuple[int, float]]) -> Table:
    codes, bit = np.arange(1 << len(on)), {c: i for i, c in enumerate(on)}
    reached = np.ones((len(codes), *same.features.shape), bool)
    for leaf, j in np.ndindex(*same.features.shape):
        f, low, high = int(same.features[leaf, j]), float(same.low[leaf, j]), float(same.high[leaf, j])
        if not math.isinf(low):
            reached[:, leaf, j] &= (codes >> bit[f, low] & 1) == 0
        if not math.isinf(high):
            reached[:, leaf, j] &= (codes >> bit[f, high] & 1) == 1
    met = np.unique(same.features)
    values = np.zeros((same.value.shape[1], len(met), len(codes)))
    for j, total in enumerate(_shares(reached, same.kept)):
        for c in range(len(values)):
            np.add.at(values[c], np.searchsorted(met, same.features[:, j]), (total * same.value[:, c]).T)
    return Table(on, met, values)


def _add_directly(out: np.ndarray, x: np.ndarray, same: Paths, pick: np.ndarray | None) -> None:
    """Adds what leaves with paths of one length say, all of them for a slice of rows after the other."""
    leaves, d = same.features.shape
    step = max(1, CELLS // (leaves * (d + 1)))
    runs = []
    for j in range(d):
        order = np.argsort(same.features[:, j], kind="stable")
        runs.append((order, *np.unique(same.features[order, j], return_index=True)))
    for at in range(0, len(x), step):
        rows = slice(at, at + step)
        value = same.value[:, pick[rows]].T if pick is not None and same.value.shape[1] > 1 else same.value[:, -1]
        seen = x[rows][:, same.features]
        reached = ((same.low == -math.inf) | ~(seen <= same.low)) & ((same.high == math.inf) | (seen <= same.high))
        for (order, features, starts), total in zip(runs, _shares(reached, same.kept)):
            out[rows][:, features] += np.add.reduceat((value * total)[:, order], starts, axis=1)


def _shares(reached: np.ndarray, kept: np.ndarray) -> list[np.ndarray]:
    """Per position on the path: rows × leaves, the feature's share of a leaf value of one."""
    rows, leaves, d = reached.shape
    coef = np.zeros((d + 1, rows, leaves))
    coef[0] = 1.0
    for j in range(d):
        shifted = np.where(reached[:, :, j], coef[:-1], 0.0)
        coef = coef * kept[:, j]
        coef[1:] += shifted
    size_weight = [math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)]
    out = []
    for j in range(d):
        own, hit = kept[:, j], reached[:, :, j]
        total, carry = np.zeros(hit.shape), coef[d]
        for s in range(d - 1, -1, -1):
            total += size_weight[s] * np.where(hit, carry, coef[s] / own)
            carry = coef[s] - own * carry
        out.append((hit - own) * total)
    return out


def tree_contributions(df: DataFrame, leaves: Leaves, contract: Contract, predicted: str | None = None) -> tuple[DataFrame, list[str]]:
    """(the rows with PHI, an array of contributions per source feature, and the source names in order).

    One ensemble: its values, for the class in `predicted` when leaves hold class shares. Several: one per class, and the one of
    the predicted class answers; a row without such a class has zeros. Past few leaves the rows stream, each task with all of
    them. Else rows are written once under a number of their own and every block of rows meets every block of leaves of its
    ensemble in a task of its own, so neither the rows nor the trees need fit into one; the parts of a row are added in the
    order of their blocks.
    """
    encoded, sources = contract.encoded, list(dict.fromkeys(f.source for f in contract.features))
    position = {s: i for i, s in enumerate(sources)}
    fold = np.zeros((len(encoded), len(sources)))
    for i, f in enumerate(contract.features):
        fold[i, position[f.source]] = 1.0
    wide = len(encoded)
    picked = predicted is not None

    def explain(rows: pa.Table, leaf_rows: pa.Table) -> pa.Table:
        x = rows["_X"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), wide)
        pick = rows["_CLASS"].to_numpy() if picked else None
        phi = shapley_values(x, paths_of(leaf_rows), pick) @ fold
        offsets = pa.array(np.arange(0, phi.size + 1, len(sources)), pa.int32())
        return pa.table({"_ROW": rows["_ROW"], "_BLOCK": rows["_BLOCK"], "PHI": pa.ListArray.from_arrays(offsets, pa.array(phi.ravel()))})

    if leaves.values <= FEW_LEAVES and max(leaves.blocks) == 1 and all(isinstance(f.dataType, PLAIN) for f in df.drop("PHI").schema):
        return _streamed(df.drop("PHI"), leaves, encoded, fold, predicted), sources
    held = staged(df.drop("PHI").withColumn("_ROW", F.monotonically_increasing_id()))
    n = held.count()
    parts = max(1, min(n, df.sparkSession.sparkContext.defaultParallelism), math.ceil(n * wide / FEATURES_AT_ONCE))
    kind = col(predicted).cast("int") if picked else F.lit(0)
    several = len(leaves.blocks) > 1
    rows = held.select("_ROW", F.pmod(F.xxhash64("_ROW"), F.lit(parts)).cast("int").alias("_PART"),
                       F.array(*[col(c).cast("double") for c in encoded]).alias("_X"), kind.alias("_CLASS")).where("_CLASS IS NOT NULL")
    rows = rows.withColumn("_ENSEMBLE", F.col("_CLASS") if several else F.lit(0))
    counts = F.get(F.array(*[F.lit(b) for b in leaves.blocks]), F.col("_ENSEMBLE"))
    rows = rows.withColumn("_BLOCK", F.explode(F.sequence(F.lit(0), counts - 1)))
    spread = leaves.table.withColumnsRenamed({"ENSEMBLE": "_ENSEMBLE", "BLOCK": "_BLOCK"}).withColumn(
        "_PART", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    keys = ["_PART", "_ENSEMBLE", "_BLOCK"]
    found = rows.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(explain, "_ROW bigint, _BLOCK int, PHI array<double>")
    if max(leaves.blocks) > 1:
        several_parts = F.array_sort(F.collect_list(F.struct("_BLOCK", "PHI")))
        added = F.aggregate(several_parts, zeros(sources), lambda a, e: F.zip_with(a, e["PHI"], lambda u, v: u + v))
        found = found.groupBy("_ROW").agg(added.alias("PHI"))
    out = held.join(found.select("_ROW", "PHI"), "_ROW", "left")
    return out.select(*[col(c) for c in held.columns if c != "_ROW"], F.coalesce("PHI", zeros(sources)).alias("PHI")), sources


def _streamed(df: DataFrame, leaves: Leaves, encoded: Sequence[str], fold: np.ndarray, predicted: str | None) -> DataFrame:
    """The rows with PHI, where every task holds all leaves: nothing is shuffled, and a task holds one batch of rows."""
    columns = df.columns
    table, several = leaves.table.toArrow(), len(leaves.blocks)
    extra = [F.array(*[col(c).cast("double") for c in encoded]).alias("_X"), (col(predicted).cast("int") if predicted else F.lit(0)).alias("_CLASS")]

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Prepared.of(paths_of(table.filter(pa.compute.equal(table["ENSEMBLE"], k))), COMPARISONS) for k in range(several)]
        for batch in batches:
            x = batch.column(len(columns)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, len(encoded))
            kind = pa.compute.fill_null(batch.column(len(columns) + 1), -1).to_numpy(zero_copy_only=False)
            phi = np.zeros((batch.num_rows, fold.shape[1]))
            for k in range(several):
                rows = np.flatnonzero(kind == k if several > 1 else kind >= 0)
                if len(rows):
                    phi[rows] = ready[k].explain(x[rows], kind[rows] if predicted else None) @ fold
            ends = pa.array(np.arange(0, phi.size + 1, phi.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(columns)], pa.ListArray.from_arrays(ends, pa.array(phi.ravel()))], names=[*columns, "PHI"])

    told = StructType(list(df.schema.fields)).add("PHI", ArrayType(DoubleType()))
    return df.select(*[col(c) for c in columns], *extra).mapInArrow(explain, told)


def zeros(sources: Sequence[str]) -> Column:
    return F.array_repeat(F.lit(0.0), len(sources))
