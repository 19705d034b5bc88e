"""Proportional stratified interleaving: shards whose source mixture is that of the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodemark.llm.common import gapless_rank, hex_share, packed, unpacked
from lodemark.sources.scans import Scratch


def interleave(df: DataFrame, id_col: str, source_col: str, n_shards: int, seed: int = 0) -> DataFrame:
    """The rows of df with `shard` (0 to n_shards - 1) and `slot` (gapless from 0 within the shard).

    Within each source, rows are ranked by a seeded digest of their id. A row's fractional rank is (rank - u) / rows of its
    source, with u in (0, 1] from a digest of the source's name, so that small sources spread over the whole range too.
    Rows sorted by fractional rank are cut into n_shards runs whose lengths differ by at most one; each holds every
    source in proportion. A source of any size is ranked in many buckets by many tasks.

    A null source is a source of its own; a null id has one digest for all. Rows with equal ids follow in an arbitrary but
    gapless order, so only fully repeated rows may change places between runs. Copies of a text are not kept together.
    An empty table gives an empty one. An input column named shard or slot is replaced.
    """
    scratch = Scratch(df.sparkSession)
    total = df.count()
    source = F.coalesce(F.concat(F.lit("s"), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(f"`{id_col}`").cast("string")))
    keyed = df.select(packed(df.columns), source.alias("source"), digest.alias("digest"), F.col(f"`{id_col}`").alias("id"))
    keyed = keyed.withColumn("share", hex_share(F.col("digest")))
    ranked = gapless_rank(keyed, ["source"], "share", ["digest", "id"], total, counted=keyed.select("source", "share"))
    offset = 1.0 - hex_share(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("source"))))
    sizes = keyed.groupBy("source").agg(F.count("*").alias("n"))
    fractions = ranked.join(sizes, "source").withColumn("fraction", (F.col("rank") - offset) / F.col("n")).drop("rank", "n", "share")
    placed = scratch.write(fractions)
    placed = gapless_rank(placed, [], "fraction", ["digest", "id", "source"], total)
    at = F.col("rank") - 1
    placed = placed.withColumn("shard", F.expr(f"int(((rank - 1) * {n_shards}) div {max(total, 1)})"))
    start = F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")
    return unpacked(placed, df.columns, shard=F.col("shard"), slot=(at - start).cast("long"))
