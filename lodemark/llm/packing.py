"""Conflict-constrained best-fit packing of documents into bins of fixed capacity."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import packed, unpacked


def best_fit(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[tuple[int, int]]:
    """Bin and offset of each item, placed in the order given.

    Open bins are kept in order of their free room. A bin carries two bitmaps, of the sources and of the duplicate clusters it
    holds; an item fits only where neither has its bit. The search starts at the tightest bin with enough room and goes on to
    its successors until one is compatible; without any, a new bin is opened.
    """
    bit = {k: 1 << n for n, k in enumerate(dict.fromkeys(sources))}
    cluster_bit = {k: 1 << n for n, k in enumerate(dict.fromkeys(clusters))}
    free: list[tuple[int, int]] = []
    held: list[list[int]] = []
    out = []
    for length, source, cluster in zip(lengths, sources, clusters):
        s, c = bit[source], cluster_bit[cluster]
        at = bisect_left(free, (length, -1))
        while at < len(free) and (held[free[at][1]][0] & s or held[free[at][1]][1] & c):
            at += 1
        if at < len(free):
            room, number = free.pop(at)
        else:
            room, number = capacity, len(held)
            held.append([0, 0])
        out.append((number, capacity - room))
        held[number][0] |= s
        held[number][1] |= c
        if room > length:
            insort(free, (room - length, number))
    return out


def pack(df: DataFrame, id_col: str, length: Column, source_col: str, cluster: Column, capacity: int, block_rows: int = 4096,
         seed: int = 0) -> DataFrame:
    """The pieces of df's rows with piece, piece_start, piece_length, bin_block, bin and bin_offset.

    A row of `length` units is cut into full pieces of `capacity`, each alone in a bin, and a rest, which is packed. Rows are
    dealt by a seeded hash into blocks of about block_rows, so a block is a small image of the whole; in each block rests are
    placed longest first, by best fit. No two rests in a bin share a source or a duplicate cluster. Blocks are as many as the
    rows need, so their size does not grow, and a source or a cluster that holds a third of all rows spreads over all of them.
    Bins are numbered within their block.

    A null or zero length gives one empty piece in no bin (null bin). A null source is a source of its own and a null
    cluster conflicts with nothing. Ties go by id, so repeated rows may change places only with each other. An empty table
    gives an empty one; input columns with the name of an output are replaced.
    """
    n = F.greatest(F.coalesce(length, F.lit(0)), F.lit(0)).cast("long")
    rows = df.select(packed(df.columns), n.alias("n"), F.col(f"`{id_col}`").cast("long").alias("id"),
                     F.col(f"`{source_col}`").cast("string").alias("source"), cluster.cast("string").alias("cluster"))
    blocks = max(1, -(-df.count() // block_rows))
    dealt = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("id", F.lit(-1)), "n", "cluster"), F.lit(blocks)).cast("long")
    rows = rows.withColumn("block", dealt)

    def place(block_now: pd.DataFrame) -> pd.DataFrame:
        ordered = block_now.assign(rest=block_now["n"] % capacity)
        ordered = ordered.sort_values(["rest", "id", "cluster"], ascending=[False, True, True], kind="stable")
        some = int((ordered["rest"] > 0).sum())
        clusters = [("row", k) if c is None else c for k, c in enumerate(ordered["cluster"][:some])]
        found = best_fit(ordered["rest"][:some].tolist(), ordered["source"][:some].tolist(), clusters, capacity)
        full = ordered["n"] // capacity
        none = [None] * (len(ordered) - some)
        return ordered.assign(bin=pd.array([b for b, _ in found] + none, "Int64"), offset=pd.array([o for _, o in found] + none, "Int64"),
                              next=1 + max((b for b, _ in found), default=-1) + full.cumsum() - full)[["row", "n", "block", "bin", "offset", "next"]]

    schema = f"row {rows.schema['row'].dataType.simpleString()}, n long, block long, bin long, offset long, next long"
    placed = rows.groupBy("block").applyInPandas(place, schema)
    pieces = F.greatest(F.ceil(F.col("n") / capacity), F.lit(1)).cast("int")
    placed = placed.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1))).withColumn("start", F.col("piece").cast("long") * capacity)
    is_full = F.col("start") + capacity <= F.col("n")
    return unpacked(placed, df.columns, piece=F.col("piece"), piece_start=F.col("start"),
                    piece_length=F.least(F.col("n") - F.col("start"), F.lit(capacity)).cast("long"), bin_block=F.when(F.col("n") > 0, F.col("block")),
                    bin=F.when(is_full, F.col("next") + F.col("piece")).otherwise(F.col("bin")),
                    bin_offset=F.when(is_full, F.lit(0)).otherwise(F.col("offset")).cast("long"))
