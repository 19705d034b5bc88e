"""Whole-table order questions without a whole-table sort.

A window ordered over the full table runs in one task. Two tools replace it:

* `order_statistics` answers "which value has rank k" exactly by narrowing histograms: each round counts rows per
  (interval, bin), for all columns and ranks in one aggregate (map-side combined, at most `BINS` and 16 per interval leave a
  task), and keeps only the bins that hold the ranks. No row is shuffled, whatever the skew.
* `running_totals` gives the cumulative sums over a sorted column. Rows are first folded to one per distinct value,
  then cut into contiguous slices of bounded size; each slice is summed on its own and shifted by the total of the
  slices before it. Slice edges come from an approximate quantile, which only affects balance: the result is exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodemark.functions.columns import as_ordinal, as_ordinals, col, shuffled_order, without_nan
from lodemark.operators.joins import salted_join
from lodemark.sources.scans import staged

GRID = 1000             # histogram bins per interval and narrowing round
BINS = 20_000           # bins of all intervals in a round; more than 1,250 intervals still get 16 each
ACCURACY = 20000        # of the approximate quantiles that cut slices
EXACT_ROWS = 250_000    # all intervals together this small are ranked exactly in one aggregate (2 MB of doubles)
SLICE_ROWS = 2_000_000  # rows per slice of a running total
MAX_SLICES = 10_000
LOOKUP_ROWS = 400_000   # a lookup of up to this many distinct values (counted first) is broadcast

RankRule = Callable[[int], int]


@dataclass(frozen=True)
class OrderStatistic:
    value: float   # the value at the rank
    below: int     # rows strictly smaller
    ties: int      # rows equal to it
    rows: int      # non-null rows
    total: int     # all rows


@dataclass
class _Search:
    column: str
    rank: int
    rows: int
    total: int
    low: float
    high: float
    inside: int
    below: int = 0
    found: OrderStatistic | None = None

    def settle(self, value, below, ties):
        self.found = OrderStatistic(float(value), self.below + int(below), int(ties), self.rows, self.total)

    @property
    def interval(self) -> tuple[str, float, float]:
        return self.column, self.low, self.high


def order_statistics(df: DataFrame, wanted: Sequence[tuple[str, RankRule]], of_all: bool = False,
                     exact_rows: int = EXACT_ROWS, grid: int = GRID, written: bool = False) -> list[OrderStatistic | None]:
    """For each (column, rank rule): the value at 1-based ascending rank `rule(n)` among the n non-null rows.

    NULL and NaN are ignored, and an empty column gives None. Pass a negated column for a rank from the top. With `of_all` the
    rule is given the number of all rows. The columns are written once, unless `written` says that `df` is a table already; then
    two jobs up to `exact_rows` rows and two more per further factor of `grid`, however many columns and ranks are asked for.
    """
    if not wanted:
        return []
    columns = list(dict.fromkeys(c for c, _ in wanted))
    data = df.select(*[without_nan(col(c).cast("double")).alias(c) for c in columns])
    data = data if written else staged(data)
    head = data.agg(F.count("*").alias("_TOTAL"), *[
        F.struct(F.count(col(c)).alias("n"), F.min(col(c)).alias("low"), F.max(col(c)).alias("high")).alias(c) for c in columns
    ]).first()

    searches = []
    for name, rule in wanted:
        h = head[name]
        if h["n"] == 0:
            searches.append(None)
            continue
        rank = min(max(int(rule(head["_TOTAL"] if of_all else h["n"])), 1), h["n"])
        searches.append(_Search(name, rank, h["n"], head["_TOTAL"], h["low"], h["high"], h["n"]))

    live = [s for s in searches if s is not None]
    while True:
        for s in live:
            if s.found is None and s.low == s.high:
                s.settle(s.low, 0, s.inside)
        sizes = {s.interval: s.inside for s in live if s.found is None}
        if sum(sizes.values()) <= exact_rows:
            break
        _narrow(data, [i for i, n in sizes.items() if n > exact_rows / len(sizes)], live, grid)
        if sizes == {s.interval: s.inside for s in live if s.found is None}:
            raise ValueError("more rows hold the largest double or infinity than can be ranked exactly")
    _pick_exact(data, [s for s in live if s.found is None])
    return [s and s.found for s in searches]


def _narrow(data: DataFrame, intervals: list[tuple[str, float, float]], searches: list[_Search], grid: int):
    """Cuts all intervals into bins at their approximate quantiles, counts the rows of every bin, and moves each search into
    its bin: one aggregate for the quantiles and one for the counts."""
    each = max(min(grid, 16), min(grid, BINS // len(intervals)))
    names = [f"v{i}" for i in range(len(intervals))]
    inside = data.select(*[F.when((col(c) >= low) & (col(c) <= high), col(c)).alias(name)
                           for name, (c, low, high) in zip(names, intervals)])
    marks = inside.agg(*[F.percentile_approx(n, [k / each for k in range(1, each)], 10 * each).alias(n) for n in names]).first()
    binned = Bucketizer(splitsArray=[_bin_edges(marks[n]) for n in names], inputCols=names,
                        outputCols=[f"b{i}" for i in range(len(names))], handleInvalid="keep").transform(inside)
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(f"b{i}").alias("bin"), F.col(n).alias("value")) for i, n in enumerate(names)])
    bins = (binned.select(F.inline(cells)).where("value IS NOT NULL").groupBy("at", "bin")
            .agg(F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")).collect())
    by_interval: dict[tuple, list] = {i: [] for i in intervals}
    for b in sorted(bins, key=lambda b: (b["at"], b["bin"])):
        by_interval[intervals[b["at"]]].append(b)
    for s in searches:
        passed = 0
        for b in by_interval.get(s.interval, ()) if s.found is None else ():
            if passed + b["rows"] >= s.rank:
                s.below, s.rank = s.below + passed, s.rank - passed
                s.inside, s.low, s.high = b["rows"], b["low"], b["high"]
                break
            passed += b["rows"]


def _bin_edges(marks: list[float]) -> list[float]:
    """A repeated mark is a heavy value: it gets a bin of its own; the last edge keeps a search from standing still."""
    edges = set(marks) | {math.nextafter(m, math.inf) for i, m in enumerate(marks) if i and m == marks[i - 1]}
    edges.add(math.nextafter(marks[-1], math.inf))
    if math.inf in edges:  # only the last bin may hold infinity
        edges.add(math.nextafter(math.inf, 0.0))
    return [-math.inf, *sorted(edges - {-math.inf, math.inf}), math.inf]


def _pick_exact(data: DataFrame, searches: list[_Search]):
    """Ranks the few rows left in each interval; searches in one interval share its sorted array."""
    if not searches:
        return
    spans = {interval: f"held{i}" for i, interval in enumerate(dict.fromkeys(s.interval for s in searches))}
    held = data.agg(*[
        F.sort_array(F.collect_list(F.when((col(c) >= low) & (col(c) <= high), col(c)))).alias(name)
        for (c, low, high), name in spans.items()
    ])
    names = [spans[s.interval] for s in searches]
    valued = held.select("*", *[F.element_at(n, s.rank).alias(f"value{i}") for i, (n, s) in enumerate(zip(names, searches))])
    answers = valued.select(*[
        F.struct(F.col(f"value{i}").alias("value"), (F.array_position(n, F.col(f"value{i}")) - 1).alias("below"),
                 F.size(F.filter(n, _equals(F.col(f"value{i}")))).alias("ties")).alias(f"s{i}")
        for i, n in enumerate(names)
    ]).first()
    for i, s in enumerate(searches):
        s.settle(answers[f"s{i}"]["value"], answers[f"s{i}"]["below"], answers[f"s{i}"]["ties"])


def _equals(value: Column) -> Callable[[Column], Column]:
    return lambda x: x == value


def sliced(df: DataFrame, column: str, edges: Sequence[float], out: str = "SLICE") -> DataFrame:
    """Adds the slice number of a double column: a binary search over sorted edges, on the JVM."""
    if not edges:
        return df.withColumn(out, F.lit(0.0))
    splits = [-math.inf, *edges, math.inf]
    return Bucketizer(splits=splits, inputCol=column, outputCol=out, handleInvalid="keep").transform(df)


def quantile_edges(df: DataFrame, column: str, rows_per_slice: int = SLICE_ROWS,
                   max_slices: int = MAX_SLICES) -> tuple[int, list[float]]:
    """(non-null rows, edges that cut the column into slices of about `rows_per_slice` rows)."""
    n = df.agg(F.count(col(column))).first()[0]
    slices = min(max(math.ceil(n / rows_per_slice), 1), max_slices)
    if slices == 1:
        return n, []
    marks = df.agg(F.percentile_approx(col(column), [i / slices for i in range(1, slices)],
                                       max(ACCURACY, 10 * slices))).first()[0]
    return n, sorted(set(marks))


def running_totals(df: DataFrame, key: str, totals: dict[str, Column], descending: bool = False,
                   rows_per_slice: int = SLICE_ROWS) -> DataFrame:
    """One row per distinct non-null `key` with each total of that key and, as `RUN_<name>`, its running total.

    `totals` maps a name to a sum or count aggregate. The running total includes the row itself. The rows are read once, to
    write one row per distinct value; slices are cut from those.
    """
    direction = -1.0 if descending else 1.0
    keyed = df.withColumn("ORDINAL", as_ordinal(df, key) * direction).where("ORDINAL IS NOT NULL")
    grouped = staged(keyed.groupBy(col(key), "ORDINAL").agg(*[agg.alias(name) for name, agg in totals.items()]))
    _, edges = quantile_edges(grouped, "ORDINAL", rows_per_slice)
    grouped = sliced(grouped, "ORDINAL", edges)

    # a double holds 53 bits: neighbours beyond them share an ordinal and follow by the key itself
    exact = col(key).desc() if descending else col(key).asc()
    here = (Window.partitionBy("SLICE").orderBy("ORDINAL", exact)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = grouped.select("*", *[F.sum(name).over(here).alias(f"RUN_{name}") for name in totals])
    if edges:
        # at most MAX_SLICES rows: one window and a broadcast are safe
        before = Window.orderBy("SLICE").rowsBetween(Window.unboundedPreceding, -1)
        shifts = (grouped.groupBy("SLICE").agg(*[F.sum(name).alias(name) for name in totals])
                  .select("SLICE", *[F.coalesce(F.sum(name).over(before), F.lit(0)).alias(f"SHIFT_{name}")
                                     for name in totals]))
        running = running.join(F.broadcast(shifts), "SLICE").withColumns(
            {f"RUN_{name}": F.col(f"RUN_{name}") + F.col(f"SHIFT_{name}") for name in totals})
    return running.select(col(key), *totals, *[f"RUN_{name}" for name in totals])


def percent_ranks(df: DataFrame, columns: dict[str, str], descending: bool = False,
                  rows_per_slice: int = SLICE_ROWS) -> DataFrame:
    """Adds SQL PERCENT_RANK over the whole table for each (new name → column): (rank − 1) / (rows − 1).

    The columns must not be NULL. All are ranked in one pass over (column, value) cells, once per distinct value: one shuffle
    combines the cells, one brings the distinct values of a slice together. The rows look their values up.
    """
    if not columns:
        return df
    direction = -1.0 if descending else 1.0
    parts, keys = {}, {}
    for i, c in enumerate(columns.values()):
        exact = [p * direction for p in as_ordinals(df, c)]
        keys[i] = [f"_P{i}_0", f"_P{i}_1"]
        parts.update({f"_O{i}": as_ordinal(df, c) * direction, keys[i][0]: exact[0], keys[i][1]: exact[1] if len(exact) > 1 else F.lit(0.0)})
    wide = df.select(*[part.alias(name) for name, part in parts.items()])
    at = range(len(keys))
    head = wide.agg(F.count("*").alias("_N"), *[F.approx_count_distinct(F.struct(*keys[i])).alias(f"d{i}") for i in at]).first()
    slices = min(max(math.ceil(head["_N"] / rows_per_slice), 1), MAX_SLICES)
    edges = {i: [] for i in at}
    if slices > 1:
        marks = wide.agg(*[F.percentile_approx(f"_O{i}", [k / slices for k in range(1, slices)], max(ACCURACY, 10 * slices)).alias(f"m{i}")
                           for i in at]).first()
        edges = {i: sorted(set(marks[f"m{i}"])) for i in at}
    for i in at:
        wide = sliced(wide, f"_O{i}", edges[i], f"_S{i}")
    cells = wide.select(F.inline(F.array(*[F.struct(F.lit(i).alias("AT"), F.col(f"_S{i}").alias("SLICE"), F.col(keys[i][0]).alias("HIGH"),
                                                    F.col(keys[i][1]).alias("LOW")) for i in at])))
    ranks = staged(_ranks_of_cells(cells, slices > 1, max(head["_N"] - 1, 1)))

    out = df.withColumns({name: parts[name] for i in at for name in keys[i]})
    for i, name in enumerate(columns):
        lookup = ranks.where(F.col("AT") == i).select(F.col("HIGH").alias(keys[i][0]), F.col("LOW").alias(keys[i][1]), F.col("SHARE").alias(name))
        if head[f"d{i}"] <= LOOKUP_ROWS:
            out = out.join(F.broadcast(lookup), keys[i])
        else:
            out = salted_join(out, lookup, keys[i])
    return out.select(*[col(c) for c in df.columns], *columns)


def _ranks_of_cells(cells: DataFrame, many_slices: bool, last: int) -> DataFrame:
    """(AT, HIGH, LOW, SHARE): the share of the column's other rows that lie before each distinct value."""
    counts = cells.groupBy("AT", "SLICE", "HIGH", "LOW").agg(F.count("*").alias("ROWS"))
    before = Window.partitionBy("AT", "SLICE").orderBy("HIGH", "LOW").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("AHEAD", F.coalesce(F.sum("ROWS").over(before), F.lit(0)))
    if many_slices:
        # at most MAX_SLICES rows a column: one window each and a broadcast are safe
        earlier = Window.partitionBy("AT").orderBy("SLICE").rowsBetween(Window.unboundedPreceding, -1)
        shifts = cells.groupBy("AT", "SLICE").agg(F.count("*").alias("N")).select(
            "AT", "SLICE", F.coalesce(F.sum("N").over(earlier), F.lit(0)).alias("SHIFT"))
        ranked = ranked.join(F.broadcast(shifts), ["AT", "SLICE"]).withColumn("AHEAD", F.col("AHEAD") + F.col("SHIFT"))
    return ranked.select("AT", "HIGH", "LOW", (F.col("AHEAD") / F.lit(last).cast("double")).alias("SHARE"))


def cutoffs(df: DataFrame, score: str, sizes: dict[str, int]) -> dict[str, float | None]:
    """For each name: the score of the size-th best row, `size` capped by the rows there are."""
    negated = df.select((-col(score)).alias("s"))
    found = order_statistics(negated, [("s", lambda n, size=size: min(size, n)) for size in sizes.values()])
    return {name: None if f is None else 0.0 - f.value for name, f in zip(sizes, found)}


Order = Sequence[tuple[str | Column, str]]


def leading_rows(df: DataFrame, order: Order, size: RankRule) -> DataFrame:
    """The first `size(n)` rows in the given order, e.g. [("score", "desc"), ("id", "asc")].

    Finds the boundary row column by column and keeps the rows on its near side: a plain filter, no sort. Rows equal
    to the boundary in every column are kept together, so end the order with something unique for an exact count.
    """
    return df.where(leading_filter(df, order, size))


def leading_filter(df: DataFrame, order: Order, size: RankRule) -> Column:
    """`leading_rows` as a condition on the rows of `df`. The order may name columns or give double expressions."""
    signed = [part * (-1.0 if way == "desc" else 1.0)
              for by, way in order for part in ([by] if isinstance(by, Column) else as_ordinals(df, by))]
    ordinals = staged(df.select(*[s.alias(f"o{i}") for i, s in enumerate(signed)]))
    bounds, left = [], None
    for i in range(len(signed)):
        scope = ordinals
        for j, b in enumerate(bounds):
            scope = scope.where(F.col(f"o{j}") == F.lit(b))
        rule = size if left is None else (lambda n, left=left: left)
        found = order_statistics(scope, [(f"o{i}", rule)], of_all=True, written=True)[0]
        if left is None:
            left = 0 if found is None else int(size(found.total))
            if left <= 0:
                return F.lit(False)
            if left >= found.total:
                return F.lit(True)
        bounds.append(found.value)
        left -= found.below
        if left >= found.ties:
            break
    keep = signed[len(bounds) - 1] <= F.lit(bounds[-1])
    for i in range(len(bounds) - 2, -1, -1):
        keep = (signed[i] < F.lit(bounds[i])) | ((signed[i] == F.lit(bounds[i])) & keep)
    return keep


def seeded(keys: Sequence[str], seed) -> Order:
    """A repeatable random order over the keys, as the last part of an order."""
    first, second = shuffled_order([col(k) for k in keys], seed)
    return [(first, "asc"), (second, "asc")]


def newest_fraction(df: DataFrame, ts: str, fraction: float, keys: Sequence[str], seed: int) -> DataFrame:
    """The newest share of the rows; rows of one batch share a timestamp, so a seeded order breaks the tie."""
    return leading_rows(df, [(ts, "desc"), *seeded(keys, seed)], lambda n: half_even(n * fraction))


def half_even(x: float) -> int:
    return int(round(x))


def decile(n: int) -> int:
    return max(int(0.10 * n), 1)


def top_decile(df: DataFrame, score: str, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """The best-scored tenth of the rows (at least one)."""
    return leading_rows(df, [(score, "desc"), *seeded(keys, seed)], decile)
