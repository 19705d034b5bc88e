"""Size-aware heavy-light join of word-shingle sets by Jaccard similarity, reduced to connected components.

Every set is one class with its equals. Words of a class's set are put in one global order, rarest first, so that two linked
sets must share an element of their short prefixes. Small sets are met by enumerating the two-element subsets of a
slightly longer prefix, large sets by scanning inverted lists of single elements; the boundary is the one of least cost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import SHINGLE_WORDS, shingle_set
from lodemark.llm.components import components
from lodemark.sources.scans import Scratch

BANDS, BAND_ROWS = 4, 2
PART_TOKENS = 1_000_000
SHORT = np.uint64(24)   # low bits left out where elements are only counted for the order, so that differences fit 32 bits
MAX_FREQUENT = 1 << 20
MAX_BOUNDARY = 64
_MIX = np.random.default_rng(7).integers(1, 2**63, BANDS * BAND_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def class_key(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that a task holds the sets of few texts at a time."""
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [shingle_set(t.as_py()) for t in batch.column(1)]


def _profile(common):
    """Per text: its class, the size of its set, how many of its elements are rare, and its MinHash bands."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_now = common.value
        for batch in _slices(batches):
            sets = _sets(batch)
            bands = []
            for tokens in sets:
                low = (tokens.view(np.uint64)[None, :] * _MIX[:, None]).min(axis=1, initial=np.uint64(2**64 - 1)) if len(tokens) else np.zeros(len(_MIX), np.uint64)
                bands.append((low[::2] * np.uint64(0x9E3779B97F4A7C15) ^ low[1::2]).view(np.int64))
            keys = [class_key(t) if len(t) else None for t in sets]
            rare = [int((common_now.levels_of(t) == 0).sum()) for t in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.int64()), pa.array([len(t) for t in sets], pa.int64()), pa.array(rare, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["id", "class", "n", "rare", "bands"])
    return describe


# ---- how often each element occurs


def _blocks(parts: int):
    """Sorted distinct elements of many sets (upper 40 bits), cut by range into `parts` and stored as differences."""
    def packed_blocks(sets: list[np.ndarray]) -> pa.RecordBatch:
        found, counts = np.unique(np.concatenate([np.empty(0, np.int64), *sets]).view(np.uint64) >> SHORT, return_counts=True)
        part = (found * np.uint64(parts) >> np.uint64(40)).astype(np.int64)
        step = np.diff(found, prepend=found[:1])
        starts = np.flatnonzero(np.diff(part, prepend=-1) | (step >= 2**32))
        rows = []
        for a, b in zip(starts, [*starts[1:], len(found)]):
            more = np.flatnonzero(counts[a:b] > 1)
            rows.append((int(part[a]), int(found[a]), step[a + 1:b].astype(np.uint32).tobytes(), np.stack([more, counts[a:b][more]]).astype(np.uint32).tobytes()))
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "first", "steps", "more"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in _slices(batches):
            sets = _sets(batch)
            held, size = held + sets, size + sum(map(len, sets))
            if size >= PART_TOKENS:
                yield packed_blocks(held)
                held, size = [], 0
        yield packed_blocks(held)
    return cut


def _totals(blocks: pd.DataFrame) -> pd.DataFrame:
    """Elements of one range that occur in four sets or more, with their counts."""
    found, counts = [], []
    for first, steps, more in zip(blocks["first"], blocks["steps"], blocks["more"]):
        steps = np.frombuffer(steps, np.uint32)
        found.append(np.cumsum(np.concatenate([[first], steps]).astype(np.int64)))
        n = np.ones(len(steps) + 1, np.int64)
        at, times = np.frombuffer(more, np.uint32).reshape(2, -1)
        n[at] = times
        counts.append(n)
    found, counts = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(found)
    found, counts = found[order], counts[order]
    starts = np.flatnonzero(np.diff(found, prepend=-1))
    total = np.add.reduceat(counts, starts)
    return pd.DataFrame({"element": found[starts][total >= 4], "n": total[total >= 4]})


@dataclass(frozen=True)
class Frequent:
    """The most frequent elements (sorted, upper 40 bits) and the logarithm of each one's count: later in the global order."""

    elements: np.ndarray
    levels: np.ndarray

    def levels_of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.elements):
            return np.zeros(len(tokens), np.int32)
        short = (tokens.view(np.uint64) >> SHORT).astype(np.int64)
        at = np.minimum(np.searchsorted(self.elements, short), len(self.elements) - 1)
        return np.where(self.elements[at] == short, self.levels[at], 0)

    def order(self, tokens: np.ndarray) -> np.ndarray:
        levels = self.levels_of(tokens)
        return tokens[np.argsort(levels, kind="stable")] if levels.any() else tokens


def frequent(texts: DataFrame, total: int, scratch: Scratch) -> tuple[Frequent, int]:
    """Counts every element of every set; returns the most frequent ones, and the pairs of entries in the lists of the others.

    A task sends its elements as packed blocks by range of value; a range holds about PART_TOKENS elements whatever the
    input. At most MAX_FREQUENT elements reach the driver: the count from which an element is frequent follows from that.
    """
    parts = max(1, min(1 << 16, -(-total // PART_TOKENS)))
    blocks = texts.mapInArrow(_blocks(parts), "part long, first long, steps binary, more binary")
    counts = scratch.write(blocks.groupBy("part").applyInPandas(_totals, "element long, n long"))
    level = F.floor(F.log2("n")).cast("int")
    levels = dict(counts.groupBy(level.alias("level")).count().collect())
    least = next(k for k in range(4, 65) if sum(n for at, n in levels.items() if at >= k) <= MAX_FREQUENT)
    top = counts.where(level >= least).select("element", level.alias("level")).toArrow().sort_by("element")
    met = counts.where(level < least).agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0
    scratch.drop(counts)
    return Frequent(top["element"].to_numpy(), top["level"].to_numpy()), met


# ---- prefixes


def prefix(n: int, percent: int, extra: int = 1) -> int:
    """Elements of the global order of which a set shares `extra` or more with any set linked to it."""
    return min(n, n - (percent * n + 99) // 100 + extra)


def room(n: Column, other: Column, percent: int) -> Column:
    """The last place of the global order (from 0) at which a set of n may hold its first element shared with a set of size
    `other` linked to it: the elements after it must suffice for the overlap. For a subset key, the place less one counts."""
    return n - F.ceil(percent * (n + other) / F.lit(100 + percent))


def boundary(sizes: dict[int, int], percent: int, met: float) -> int:
    """Largest size whose sets enumerate subsets: least sum of subsets made and list entries scanned."""
    def cost(b: int) -> float:
        subsets = sum(c * prefix(n, percent, 2) * (prefix(n, percent, 2) - 1) / 2 for n, c in sizes.items() if n <= b)
        return subsets + sum(c * prefix(n, percent) * (1 + met) for n, c in sizes.items() if 100 * n > percent * b)
    return min(range(MAX_BOUNDARY + 1), key=cost)


def _postings(common, percent: int, light: int):
    """Keys of each set with the class, its size, and the key's place in the global order."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common_now = common.value
        for batch in _slices(batches):
            keys, classes, sizes, places = [np.empty(0, np.int64)], [], [], [np.empty(0, np.int32)]
            for tokens in _sets(batch):
                n = len(tokens)
                if not n:
                    continue
                ordered, mine, place = common_now.order(tokens), [], []
                if 100 * n > percent * light:
                    p = prefix(n, percent)
                    mine.append(ordered[:p])
                    place.append(np.arange(p, dtype=np.int32))
                if n <= light:
                    head = ordered[:prefix(n, percent, 2)].view(np.uint64)
                    a, b = np.triu_indices(len(head), 1)
                    low, high = np.minimum(head[a], head[b]), np.maximum(head[a], head[b])
                    mine.append((low * np.uint64(0x9E3779B97F4A7C15) ^ high * np.uint64(0xD6E8FEB86659FD93)).view(np.int64))
                    place.append((b - 1).astype(np.int32))
                keys += mine
                places += place
                count = sum(map(len, mine))
                classes.append(np.full(count, class_key(tokens)))
                sizes.append(np.full(count, n, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.concatenate([np.empty(0, np.int64), *classes])),
                 pa.array(np.concatenate([np.empty(0, np.int32), *sizes])), pa.array(np.concatenate(places))], names=["key", "class", "n", "pos"])
    return emit


# ---- links


def _fits(a: Column, b: Column, percent: int) -> Column:
    return (100 * a >= percent * b) & (100 * b >= percent * a)


def verified(pairs: DataFrame, texts: DataFrame, owners: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough, by exact intersection. Only needed texts are shingled."""
    needed = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct().join(owners, "class").select("id").distinct()

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            sets = [t for t in _sets(batch) if len(t)]
            yield pa.RecordBatch.from_arrays([pa.array([class_key(t) for t in sets], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["class", "tokens"])

    sets = scratch.write(texts.join(needed, "id").select("id", "text").mapInArrow(shingled, "class long, tokens array<long>"))
    a = sets.select(F.col("class").alias("a"), F.col("tokens").alias("left"))
    b = sets.select(F.col("class").alias("b"), F.col("tokens").alias("right"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b")
    shared = F.size(F.array_intersect("left", "right")).cast("long")
    links = scratch.write(both.where(100 * shared >= percent * (F.size("left") + F.size("right") - shared)).select("a", "b").distinct())
    scratch.drop(sets)
    return links


def _early_pairs(classes: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Each class with the class that has the fewest rare elements among those it shares a band with.

    That is the least edited copy of its group, to which most other copies are similar enough, so a group falls into few parts.
    """
    banded = classes.select("class", "n", "rare", F.posexplode("bands").alias("k", "band"))
    hubs = banded.groupBy("k", "band").agg(F.min(F.struct("rare", "class", "n")).alias("hub"), F.count("*").alias("members"))
    hubs = scratch.write(hubs.where("members > 1"))
    met = banded.join(hubs, ["k", "band"]).where(F.col("class") != F.col("hub.class")).where(_fits(F.col("n"), F.col("hub.n"), percent))
    return met.groupBy(F.col("class").alias("a")).agg(F.min("hub")["class"].alias("b"))


def _cross_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes that share a key, fit in size and lie in different groups.

    Groups that meet under a key are paired first, then their members: classes already linked are never paired. Both sets must
    have room after the key for the overlap that their two sizes ask for.
    """
    c = F.col
    groups = shared.groupBy("key", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.min("pos").alias("pos"))
    left = groups.select("key", c("group").alias("g"), c("low").alias("l1"), c("high").alias("h1"), c("pos").alias("p1"))
    right = groups.select("key", c("group").alias("h"), c("low").alias("l2"), c("high").alias("h2"), c("pos").alias("p2"))
    met = left.join(right, "key").where("g < h").where((100 * c("h1") >= percent * c("l2")) & (100 * c("h2") >= percent * c("l1")))
    met = met.where((c("p1") <= room(c("h1"), c("l2"), percent)) & (c("p2") <= room(c("h2"), c("l1"), percent)))
    one = shared.select("key", c("group").alias("g"), c("class").alias("a"), c("n").alias("n1"), c("pos").alias("p1"))
    two = shared.select("key", c("group").alias("h"), c("class").alias("b"), c("n").alias("n2"), c("pos").alias("p2"))
    # Members of one group without room beside the smallest fitting set of the other are left out before they are paired.
    one = met.select("key", "g", "h", "l2").join(one, ["key", "g"])
    one = one.where(c("p1") <= room(c("n1"), F.greatest(c("l2"), F.ceil(percent * c("n1") / F.lit(100))), percent))
    pairs = one.join(two, ["key", "h"])
    found = pairs.where(_fits(c("n1"), c("n2"), percent))
    found = found.where((c("p1") <= room(c("n1"), c("n2"), percent)) & (c("p2") <= room(c("n2"), c("n1"), percent)))
    return found.select("a", "b").distinct()


def similar_groups(df: DataFrame, id_col: str, text_col: str, percent: int = 75) -> DataFrame:
    """Per row of df: id, n_shingles, component_id, the smallest id reachable by links with Jaccard similarity of percent or more.

    Sets are the distinct five-word shingles of the whole lower-cased text; fewer words are one shingle; a text that is null
    or has no word has an empty set and no link. Rows with equal ids are one node. A row with a null id has no link and
    a null component. An empty table gives an empty one; other columns of df are not looked at.

    1. Rows with equal sets are one class, found by a map-side minimum over a digest of the set.
    2. Each class meets the least edited class of its four MinHash bands; verified links join large groups of copies at once,
       with as many pairs as there are rows. Nothing is decided by a miss here.
    3. Exact candidates: prefixes in rarest-first order, subsets for small sets and inverted lists for large ones. Keys with
       one class are dropped; under a key, only classes of different groups are paired, so a group of copies costs its rows.
    4. Candidates are verified by exact intersection, and the links of both steps give the components.
    """
    scratch = Scratch(df.sparkSession)
    context = df.sparkSession.sparkContext
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kept = texts.where("id IS NOT NULL AND text IS NOT NULL")
    often, met = frequent(kept, (kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 6, scratch)
    common = context.broadcast(often)
    profile = scratch.write(texts.mapInArrow(_profile(common), "id long, class long, n long, rare long, bands array<long>"))
    known = profile.where("class IS NOT NULL AND id IS NOT NULL")
    classes = scratch.write(known.groupBy("class").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "rare", "bands")]))
    owners = classes.select("class", "id")

    early = verified(scratch.write(_early_pairs(classes, percent, scratch)), kept, owners, percent, scratch)
    groups = scratch.write(components(early, scratch))

    sizes = dict(classes.where(F.col("n") < 2 * MAX_BOUNDARY).groupBy("n").count().collect())
    light = boundary(sizes, percent, met / max(profile.agg(F.sum("n")).first()[0] or 1, 1))
    postings = scratch.write(kept.mapInArrow(_postings(common, percent, light), "key long, class long, n int, pos int"))
    lists = postings.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.min(F.col("pos") - room(F.col("n"), F.col("n"), percent)).alias("over"))
    lists = scratch.write(lists.where("low <> high AND over <= 0").select("key"))
    shared = postings.join(lists, "key").join(groups.withColumnRenamed("node", "class"), "class", "left")
    shared = scratch.write(shared.select("key", "class", "n", "pos", F.coalesce("component", "class").alias("group")).distinct())
    scratch.drop(postings, lists)
    pairs = scratch.write(_cross_pairs(shared, percent))
    scratch.drop(shared)
    late = verified(pairs, kept, owners, percent, scratch)

    repeated = known.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("high")).where("a <> high").select("id", "a")
    repeated = known.join(repeated, "id").select("a", F.col("class").alias("b"))
    groups = scratch.write(components(early.unionAll(late).unionAll(repeated), scratch))
    member = profile.select("id", "n", "class").join(groups.withColumnRenamed("node", "class"), "class", "left")
    member = scratch.write(member.select("id", "n", F.coalesce("component", "class").alias("component")))
    lowest = scratch.write(member.where("component IS NOT NULL AND id IS NOT NULL").groupBy("component").agg(F.min("id").alias("lowest")))
    named = member.join(lowest, "component", "left")
    return named.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("lowest", "id")).alias("component_id"))
